"""Benchmark decontamination by template canonicalisation.

1. Words (white space and punctuation around them stripped, lower case) become template tokens: runs of numbers (also in
   words), names (capitalised words that are not all capitals, and do not begin a sentence unless they occur as a name, and
   never in lower case, elsewhere in the text) and units (also behind a number without a space) become one typed placeholder
   each, whose words are the slot's value; other words stand for themselves.
2. All windows of ``size`` template tokens of benchmark and documents are hashed and joined on the hash. An item
   shorter than that is one window of its own length. Windows with slots are joined as the literal words too, so that copies
   match whatever they consist of; as templates, windows of an item count only if half their
   words stand for themselves, or half their tokens and half of ``size``. A bit map of fixed size over the benchmark's hashes goes to
   the tasks that read documents, so that windows that cannot join are never sent; the join itself is exact
   in its other steps: it compares the windows' tokens again.
3. Matches of a document and an item at one offset, or at offsets within ``DRIFT`` / 2 tokens in the item's order (words were put in
   or left out), are an alignment. Slot consistency: numbers, names and units of the item must map one to one to values
   in the document. An alignment holds if its consistent windows cover ``coverage`` of the item's words: ``exact`` if all
   values are the same, else ``reworked``.

An item of fewer than ``SHORT`` words says too little to be looked for inside texts ("Paris" stands in many): it matches a document that
consists of it alone.

Defined cases: null texts have no tokens; items without tokens match nothing; items with the same template text count
as one, named by the least item_id; documents with the same id are told apart by their text, and rows with the same
id and text get the same result; null ids are told apart by text too. Other columns are carried in ``rest``.
"""

from __future__ import annotations

import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from harvest.llm._text import U64, WORD, cut, gram_hashes, mix, pieces, rest_of

BITS = 24       # of the bit map: 2 MB, whatever the benchmark's size
EDGE = re.compile(r"^\W+|\W+$")
OTHER_SPACE = re.compile("[\x1c-\x1f]")      # what str.split takes for space in ASCII texts and WORD does not
NUMBER = re.compile(r"[+-]?[\d][\d.,:/]*(st|nd|rd|th|%)?$")
NUMBER_WORDS = frozenset("zero one two three four five six seven eight nine ten eleven twelve thirteen fourteen fifteen sixteen seventeen eighteen "
                         "nineteen twenty thirty forty fifty sixty seventy eighty ninety hundred thousand million billion dozen "
                         "zwei drei vier fünf sechs sieben acht neun zehn elf zwölf hundert tausend deux trois quatre cinq sept huit neuf dix onze douze "
                         "mille dos tres cuatro cinco seis siete ocho nueve diez doce cien mil".split())
GLUED = re.compile(r"([+-]?\d[\d.,]*)([^\W\d_]+|°[cfCF])$")
DRIFT, SHORT = 16, 5
#: Fixed list of units, also behind a number without a space.
UNITS = frozenset("km m cm mm mi mile miles ft foot feet inch inches yd yards kg g mg lb lbs oz ton tons tonnes l ml liter liters litre litres "
                  "gallon gallons s sec second seconds min minute minutes h hr hour hours day days week weeks month months year years "
                  "usd eur gbp dollar dollars euro euros pound pounds cent cents percent mph kph kmh w kw kwh v volts watts hz khz mhz ghz "
                  "kb mb gb tb °c °f celsius fahrenheit degrees".split())
PLAIN, NUM, NAME, UNIT, NOTHING = range(5)
LISTED = {**dict.fromkeys(UNITS, UNIT), **dict.fromkeys(NUMBER_WORDS, NUM)}
PLACE = np.array([0, *(xxhash.xxh64_intdigest(f"<{k}>") for k in ("number", "name", "unit")), 0], np.uint64)


#: What EDGE strips of most words; flags of a word beside its kind.
ASCII_EDGE = "!\"#$%&'()*+,-./:;<=>?@[\\]^`{|}~"
KIND, CAPITAL, ENDS, GLUED_BIT = 7, 8, 16, 32


class Lexer(dict):
    """Number of each word seen of late; for that number, arrays of its word's hash and its flags: kind, whether it is capitalised,
    whether it ends a sentence, and whether it is a number with a unit behind."""

    def __init__(self, room: int = 1 << 19) -> None:
        super().__init__()
        self.word, self.flags = np.zeros(room, np.uint64), np.zeros(room, np.uint8)

    def __missing__(self, word: str) -> int:
        n = len(self)
        if n == len(self.flags):
            self.word, self.flags = (np.concatenate((x, np.zeros_like(x))) for x in (self.word, self.flags))
        if word.isalpha() and word.islower():       # most words
            small, flags = word, LISTED.get(word, PLAIN)
        else:
            bare = core_of(word)
            small, flags = bare.lower(), self.flags_of(word, bare)
        self.word[n] = xxhash.xxh64_intdigest(small.encode("utf-8", "surrogatepass"))
        self.flags[n] = flags
        self[word] = n
        return n

    @staticmethod
    def flags_of(word: str, bare: str) -> int:
        flags, small = NOTHING, bare.lower()
        if bare:
            digit = bare[0].isdigit()
            flags = NUM if digit and NUMBER.match(bare) else LISTED.get(small, PLAIN)
            if flags == PLAIN and bare[0].isupper() and not bare.isupper():
                flags |= CAPITAL
            if digit and (m := GLUED.match(small)) and m[2] in UNITS:
                flags |= GLUED_BIT
        if not word[-1].isalnum() and word.rstrip("\"')]»”").endswith((".", "!", "?", ":")):
            flags |= ENDS
        return flags

    def read(self, text: str | None) -> tuple[list[str], np.ndarray, np.ndarray, np.ndarray]:
        """words, their hashes, token hashes and kinds."""
        if len(self) > 400_000:
            self.clear()
        words = [] if not text else text.split() if text.isascii() and not OTHER_SPACE.search(text) else WORD.findall(text)
        code = np.fromiter(map(self.__getitem__, words), np.int64, len(words))
        flags = self.flags[code]
        if (flags & GLUED_BIT).any():
            words = [x for w, g in zip(words, (flags & GLUED_BIT).tolist()) for x in (parted(w) if g else (w,))]
            code = np.fromiter(map(self.__getitem__, words), np.int64, len(words))
            flags = self.flags[code]
        kind, literal = (flags & KIND).astype(np.int8), self.word[code]
        capital, begins = flags & CAPITAL > 0, np.ones(len(code), bool)
        begins[1:] = flags[:-1] & ENDS > 0
        name = capital & ~begins
        opener = capital & begins
        if opener.any() and name.any():
            name[opener] = np.isin(literal[opener], literal[name]) & ~np.isin(literal[opener], literal[~capital])
        kind[name] = NAME
        hashes = np.where(kind == PLAIN, literal, PLACE[kind])
        real = kind != NOTHING
        if not real.all():
            words = [w for w, r in zip(words, real.tolist()) if r]
            kind, literal, hashes = kind[real], literal[real], hashes[real]
        return words, literal, hashes, kind


def core_of(word: str) -> str:
    """The word without what is no letter or digit at its ends."""
    bare = word.strip(ASCII_EDGE)
    return bare if bare.isalnum() else EDGE.sub("", word)


def core(word: str) -> str:
    return core_of(word).lower()


def parted(word: str) -> tuple[str, str]:
    """A number and the unit behind it."""
    bare = EDGE.sub("", word)
    at = word.index(bare) + GLUED.match(bare).end(1)
    return word[:at], word[at:]


def slots_of(kind: np.ndarray) -> np.ndarray:
    """The first word of each token: a run of words of one placeholder is one. The number of words follows."""
    return np.append(np.flatnonzero(np.concatenate(([True], (kind[1:] != kind[:-1]) | (kind[1:] == PLAIN)))) if len(kind) else [], len(kind)).astype(np.int64)


def templates(words: list[str], kind: np.ndarray, first: np.ndarray, size: int, at: list[int]) -> Iterator[tuple]:
    """place, its first word and the word after its last, template tokens and slot values of the windows at these tokens."""
    for i in at:
        ends = first[i:i + size + 1].tolist()
        parts = [(int(kind[a]), " ".join(map(core, words[a:b]))) for a, b in zip(ends, ends[1:])]
        yield i, ends[0], ends[-1], [f"<{k}>" if k else w for k, w in parts], [w for k, w in parts if k]


def literals(words: list[str], first: np.ndarray, size: int, at: list[int]) -> Iterator[tuple]:
    """The same of the windows at these words, as they are."""
    place = (np.searchsorted(first, at, "right") - 1).tolist()
    for i, p in zip(at, place):
        yield p, i, i + size, list(map(core, words[i:i + size])), []


def counts(flags: np.ndarray, size: int) -> np.ndarray:
    """How many flags are set in each window."""
    n = np.concatenate(([0], np.cumsum(flags)))
    return n[size:] - n[:-size]


WINDOW = "h long, pos int, begin int, end int, tokens array<string>, slots array<string>"
WINDOW_TYPES = (pa.int64(), pa.int32(), pa.int32(), pa.int32(), pa.list_(pa.string()), pa.list_(pa.string()))


def item_windows(benchmark: DataFrame, size: int, item_id: str, text: str) -> DataFrame:
    """item, n (its tokens), item_key and the windows of each distinct template text."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        lexer = Lexer()
        for b in pieces(batches, 500):
            rows = []
            for item, t in zip(b.column("item").to_pylist(), b.column("text").to_pylist()):
                words, literal, hashes, kind = lexer.read(t)
                if not words:
                    continue
                key = xxhash.xxh64_intdigest(" ".join(map(core, words)).encode("utf-8", "surrogatepass")) - (1 << 63)
                first = slots_of(kind)
                k = min(size, len(first) - 1)
                plain = counts(kind[first[:-1]] == PLAIN, k)
                good = (2 * plain >= first[k:] - first[:-k]) | (2 * plain >= max(k, size))
                h = gram_hashes(hashes[first[:-1]], k).view(np.int64)
                rows += [(item, key, len(words), int(h[x[0]]), *x) for x in templates(words, kind, first, k, np.flatnonzero(good).tolist())]
                k = min(size, len(words))
                h = gram_hashes(literal, k).view(np.int64)
                rows += [(item, key, len(words), int(h[x[1]]), *x) for x in literals(words, first, k, np.flatnonzero(counts(kind != PLAIN, k)).tolist())]
            yield pa.RecordBatch.from_arrays([pa.array(x, t) for x, t in zip(zip(*rows) if rows else [()] * 9, (pa.int64(), pa.int64(), pa.int32(), *WINDOW_TYPES))],
                                             ["item", "item_key", "n", "h", "pos", "begin", "end", "tokens", "slots"])

    rows = (benchmark.select(F.col(item_id).cast("long").alias("item"), F.col(text).cast("string").alias("text"))
            .mapInArrow(run, f"item long, item_key long, n int, {WINDOW}"))
    return rows.groupBy("item_key", "pos", "begin", "end", "h").agg(F.min("item").alias("item"), F.first("n").alias("n"), F.first("tokens").alias("tokens"), F.first("slots").alias("slots"))


def matches(docs: DataFrame, items: DataFrame, size: int, coverage: float) -> DataFrame:
    """dk, th, item, kind, covered: the alignments that hold. docs: dk, th, text."""
    spark = docs.sparkSession
    sizes = items.select(F.size("tokens"), F.col("n") < SHORT).distinct().collect()     # at most ``size`` of each kind
    lengths, short_lengths = (sorted(k for k, is_short in sizes if is_short == flag) for flag in (False, True))
    cells = items.select(F.expr(f"shiftrightunsigned(h, {64 - BITS})").alias("c")).distinct().toPandas()["c"].to_numpy()    # at most 2**BITS
    bitmap = np.zeros(1 << BITS, np.bool_)
    bitmap[cells.astype(np.int64)] = True
    shared = spark.sparkContext.broadcast(np.packbits(bitmap))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        lexer, bits = Lexer(), shared.value
        for b in pieces(batches):
            rows = []
            for dk, th, t in zip(b.column("dk").to_pylist(), b.column("th").to_pylist(), b.column("text").to_pylist()):
                words, literal, hashes, kind = lexer.read(t)
                first = slots_of(kind)
                tokens = hashes[first[:-1]]
                for k in lengths if len(words) >= SHORT else short_lengths:
                    if len(words) < k:
                        break
                    h = gram_hashes(tokens, k)
                    rows += [(dk, th, len(words), int(h[x[0]].view(np.int64)), *x) for x in templates(words, kind, first, k, hits(h, bits))]
                    if kind.any():      # without slots, both are the same
                        h = gram_hashes(literal, k)
                        at = [i for i in hits(h, bits) if kind[i:i + k].any()]
                        rows += [(dk, th, len(words), int(h[x[1]].view(np.int64)), *x) for x in literals(words, first, k, at)]
            yield pa.RecordBatch.from_arrays([pa.array(x, t) for x, t in zip(zip(*rows) if rows else [()] * 9, (pa.int64(), pa.int64(), pa.int32(), *WINDOW_TYPES))],
                                             ["dk", "th", "words", "h", "pos", "begin", "end", "tokens", "slots"])

    found = docs.mapInArrow(run, f"dk long, th long, words int, {WINDOW}").drop("begin", "end").distinct()
    items = items.select("h", "item", "item_key", "n", "begin", "end", F.col("pos").alias("item_pos"), F.col("tokens").alias("item_tokens"), F.col("slots").alias("item_slots"))
    offset = F.col("pos") - F.col("item_pos")
    near = F.array(2 * F.floor(offset / DRIFT), 2 * F.floor((offset + DRIFT // 2) / DRIFT) + 1)     # offsets within DRIFT / 2 share one
    pairs = found.join(items, "h").where(f"tokens = item_tokens AND (n >= {SHORT} AND words >= {SHORT} OR n < {SHORT} AND n = words)").drop("words")
    aligned = (pairs.withColumn("near", F.explode(near)).groupBy("dk", "th", "item_key", "near")
               .agg(F.min("item").alias("item"), F.first("n").alias("n"), F.collect_list(F.struct("item_pos", "pos", "begin", "end", "item_slots", "slots")).alias("w")))

    def judge(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in pieces(batches, 500):
            rows = []
            for r in b.to_pylist():
                covered, exact = best(r["w"], r["n"])
                if covered >= coverage * r["n"]:
                    rows.append((r["dk"], r["th"], r["item"], r["item_key"], "exact" if exact else "reworked", covered / r["n"]))
            yield pa.RecordBatch.from_arrays([pa.array(x, t) for x, t in zip(zip(*rows) if rows else [()] * 6, (*(pa.int64(),) * 4, pa.string(), pa.float64()))],
                                             ["dk", "th", "item", "item_key", "kind", "covered"])

    return aligned.mapInArrow(judge, "dk long, th long, item long, item_key long, kind string, covered double")


def hits(h: np.ndarray, bits: np.ndarray) -> list[int]:
    cell = (h >> U64(64 - BITS)).astype(np.int64)
    return np.flatnonzero(bits[cell >> 3] >> (7 - (cell & 7)).astype(np.uint8) & 1).tolist()


def best(found: list[dict], n: int) -> tuple[int, bool]:
    """The largest cover of windows with equal values, at one offset, or at all offsets that rise in the document as in the item."""
    found = sorted(found, key=lambda w: (w["item_pos"], w["pos"], w["begin"]))
    offsets = sorted({w["pos"] - w["item_pos"] for w in found})
    ways = [[w for w in found if w["slots"] == w["item_slots"]], found]
    if len(offsets) > 1:
        ways += [[w for w in found if w["pos"] - w["item_pos"] == o] for o in offsets]
    return max(consistent(way, n) for way in ways)


def consistent(found: list[dict], n: int) -> tuple[int, bool]:
    """How many of the item's tokens lie in windows whose slots map one to one, and whether all values are the same.
    A window that contradicts those before it, or stands before them in the document, is left out."""
    forth: dict[str, str] = {}
    back: dict[str, str] = {}
    covered, exact, at = np.zeros(n, bool), True, 0
    for w in found:
        if w["pos"] < at:
            continue
        pairs = list(zip(w["item_slots"], w["slots"]))
        f, b = dict(forth), dict(back)
        if any(f.setdefault(x, y) != y or b.setdefault(y, x) != x for x, y in pairs):
            continue
        forth, back, at = f, b, w["pos"]
        exact &= all(x == y for x, y in pairs)
        covered[w["begin"]:w["end"]] = True
    return int(covered.sum()), exact


def decontaminate(docs: DataFrame, benchmark: DataFrame, size: int = 8, coverage: float = 0.5, doc_id: str = "doc_id", text: str = "text",
                  item_id: str = "item_id", item_text: str = "text") -> DataFrame:
    """rest (all columns but the text), text, contaminated, n_items, items (least ids, ascending), kind (exact, reworked or
    null) and covered (the largest share of an item): a row for each row of ``docs``."""
    body = F.col(text).cast("string")
    number = F.col(doc_id).cast("long")
    frame = docs.select(F.coalesce(number, F.xxhash64(body)).alias("dk"), F.xxhash64(body).alias("th"), rest_of(docs, text), body.alias("text"))
    held = matches(frame.select("dk", "th", "text"), cut(item_windows(benchmark, size, item_id, item_text)), size, coverage)
    found = (held.groupBy(F.col("dk").alias("mdk"), F.col("th").alias("mth"))
             .agg(F.count_distinct("item_key").alias("n_items"), F.sort_array(F.collect_set("item")).alias("items"),
                  F.min("kind").alias("kind"), F.max("covered").alias("covered")))
    return (frame.join(cut(found), (F.col("dk") == F.col("mdk")) & (F.col("th") == F.col("mth")), "left")
            .select("rest", "text", F.col("mdk").isNotNull().alias("contaminated"), F.coalesce("n_items", F.lit(0)).alias("n_items"), "items", "kind", "covered"))


def digest(found: DataFrame) -> DataFrame:
    return found.select("rest.doc_id", "contaminated", "n_items", "items", "kind", "covered")
