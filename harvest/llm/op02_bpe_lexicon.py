"""BPE encoding and decoding with a minimal acyclic transducer as lexicon.

1. All words of all documents (the pieces that the tokenizer's split pattern makes) are counted; those that make
   at least one in ``share`` of all occurrences are the lexicon, at most ``share`` words by that rule.
2. Each is merged exactly, and the words are compiled, in byte order, into a minimal acyclic automaton that
   shares suffixes as well as prefixes. Transitions carry numbers that add up along a path to the word's
   place in byte order, so one automaton without ids serves as the key; a second array holds the ids.
3. The automaton is flat arrays in one file, which Spark hands to each executor and workers map into memory.
   A transition is found by binary search over (state, byte); all unknown words of a slice walk at once.
4. Words that are not in the lexicon are merged exactly by rank, many at a time in arrays; so the result does
   not depend on the lexicon.

Texts are split in arrays: every code point has a kind (letter, number, white space, other), words begin where the
split pattern says, and the words of a slice become one Arrow array over the texts' own bytes, which is counted, or
encoded as a dictionary, so that Python meets distinct words only. A slice holds about two megabytes, or one longer text.

Decoding looks up the bytes of each id and joins them; bytes that are not UTF-8 become U+FFFD.

Defined cases: null and empty texts give no ids; the added token's string becomes its id, as in the tokenizers
library; an id that the vocabulary does not have raises. Other columns are carried in ``rest``.
"""

from __future__ import annotations

import json
import os
import uuid
from collections.abc import Iterable, Iterator
from functools import lru_cache

import numpy as np
import public_tokenizers
import pyarrow as pa
import pyarrow.compute as pc
import regex
from pyspark import SparkFiles
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from harvest.llm._text import cut, pieces, rest_of

#: A word is frequent if it makes at least one in SHARE of the words; so there are at most SHARE.
SHARE = 1 << 16
#: The kinds of code points that the split pattern (public_tokenizers.PATTERN) tells apart.
KINDS = LETTER, NUMBER, SPACE, OTHER = range(4)
#: What the split pattern takes with an apostrophe that begins a word.
ENDINGS = ("s", "t", "re", "ve", "m", "ll", "d")
NO_PAIR = np.iinfo(np.int64).max
#: Words that a worker remembers besides the lexicon.
REMEMBERED = 250_000
#: Bytes of text that are split at once, and words that are counted at once.
SLICE_BYTES = 1 << 21
SLICE_WORDS = 1 << 21


def slices(batches: Iterable[pa.RecordBatch], column: str) -> Iterator[pa.RecordBatch]:
    """The batches in slices whose texts sum up to at most SLICE_BYTES; a longer text is a slice of its own."""
    for b in batches:
        ends = np.cumsum(pc.fill_null(pc.binary_length(b.column(column)), 0).to_numpy(zero_copy_only=False), dtype=np.int64)
        i = 0
        while i < b.num_rows:
            j = max(i + 1, int(np.searchsorted(ends, SLICE_BYTES + (ends[i - 1] if i else 0), "right")))
            yield b.slice(i, j - i)
            i = j


@lru_cache(maxsize=1)
def kinds() -> np.ndarray:
    """The kind of each code point."""
    every = "".join(chr(c) if not 0xD800 <= c < 0xE000 else "?" for c in range(0x110000))
    out = np.full(len(every), OTHER, np.uint8)
    for kind, pattern in ((LETTER, r"\p{L}+"), (NUMBER, r"\p{N}+"), (SPACE, r"\s+")):
        for m in regex.finditer(pattern, every):
            out[m.start():m.end()] = kind
    return out


def word_begins(code: np.ndarray, edge: np.ndarray) -> np.ndarray:
    """Where words begin in code points of texts that begin at ``edge``, as the split pattern has it: runs of one kind;
    the last of a run of white space stands apart if another kind follows, and a blank joins what follows; an
    apostrophe that begins a word takes one of ENDINGS with it."""
    kind = kinds()[code]
    begin = edge.copy()
    begin[1:] |= kind[1:] != kind[:-1]
    space = kind == SPACE
    last = np.flatnonzero(space[:-1] & ~space[1:] & ~edge[1:])
    begin[last] = True
    begin[last[code[last] == ord(" ")] + 1] = False
    marks = np.flatnonzero((code == ord("'")) & begin)
    for ending in ENDINGS:
        at = marks[marks + len(ending) < len(code)]
        for step, letter in enumerate(ending, 1):
            at = at[(code[at + step] == ord(letter)) & ~edge[at + step]]
        begin[at + 1] = False
        at = at + len(ending) + 1
        begin[at[at < len(code)]] = True
    return begin


def byte_letters() -> dict[str, int]:
    """The letter that stands for each byte in a byte-level vocabulary file: itself where it prints, else from U+0100 on."""
    out, extra = {}, 0
    for b in range(256):
        if 33 <= b <= 126 or 161 <= b <= 172 or 174 <= b:
            out[chr(b)] = b
        else:
            out[chr(256 + extra)] = b
            extra += 1
    return out


class Vocabulary:
    """Tokens as bytes, merge ranks, and the added tokens of a byte-level BPE file."""

    def __init__(self, path: str) -> None:
        with open(path, encoding="utf-8") as f:
            d = json.load(f)
        letters = byte_letters()
        raw = {t: bytes(letters[c] for c in t) for t in d["model"]["vocab"]}
        self.id_of = {raw[t]: i for t, i in d["model"]["vocab"].items()}
        merges = [m.split(" ") if isinstance(m, str) else m for m in d["model"]["merges"]]
        self.merge = {(self.id_of[raw[a]], self.id_of[raw[b]]): (rank, self.id_of[raw[a] + raw[b]]) for rank, (a, b) in enumerate(merges)}
        self.single = [self.id_of[bytes([b])] for b in range(256)]
        self.bytes_of = {i: b for b, i in self.id_of.items()}
        self.added = {t["content"]: t["id"] for t in d["added_tokens"]}
        self.bytes_of |= {i: t.encode() for t, i in self.added.items()}
        pairs = sorted((a << 32 | b, rank, new) for (a, b), (rank, new) in self.merge.items())
        self.pair, self.rank, self.new = (np.array(x, np.int64) for x in zip(*pairs))
        self.first = np.array(self.single, np.int64)
        size = [len(self.bytes_of.get(i, b"")) for i in range(max(self.bytes_of) + 1)]
        self.size = np.array(size, np.int64)
        self.at = np.cumsum(self.size) - self.size
        self.blob = np.frombuffer(b"".join(self.bytes_of.get(i, b"") for i in range(len(size))), np.uint8)
        strings = sorted(self.added, key=len, reverse=True)
        self.special = regex.compile("(" + "|".join(map(regex.escape, strings)) + ")") if strings else None

    def words(self, texts: pa.Array) -> tuple[pa.Array, np.ndarray]:
        """The words of all texts, as one binary array, and how many words end with or before each text. Null is empty;
        added tokens are words of their own."""
        texts = pc.fill_null(texts.cast(pa.string()), "")
        sizes = pc.utf8_length(texts).to_numpy(zero_copy_only=False)
        stop = np.concatenate(([0], np.cumsum(sizes, dtype=np.int64)))
        if not stop[-1]:
            return pa.array([], pa.binary()), np.zeros(len(texts), np.int64)
        _, offsets, data = texts.buffers()
        offsets = np.frombuffer(offsets, np.int32)[texts.offset:texts.offset + len(texts) + 1]
        data = data.slice(int(offsets[0]), int(offsets[-1] - offsets[0]))
        whole = str(data, "utf-8")
        code = np.frombuffer(whole.encode("utf-32-le"), np.uint32)
        edge = np.zeros(len(code) + 1, np.bool_)
        edge[stop] = True
        found = self.specials(whole, stop)
        for a, b in found:
            edge[[a, b]] = True
        begin = word_begins(code, edge[:-1])
        for a, b in found:
            begin[a + 1:b] = False
        first = np.flatnonzero(begin)
        at = first
        if len(data) > len(code):
            width = 1 + (code >= 0x80).astype(np.int32) + (code >= 0x800) + (code >= 0x10000)
            at = (np.cumsum(width, dtype=np.int32) - width)[first]
        at = np.append(at, len(data)).astype(np.int32)
        return pa.Array.from_buffers(pa.binary(), len(first), [None, pa.py_buffer(at), data]), np.searchsorted(first, stop[1:])

    def specials(self, whole: str, stop: np.ndarray) -> list[tuple[int, int]]:
        """Where added tokens stand in texts that end at ``stop``; none reaches from a text into the next."""
        if self.special is None or not self.special.search(whole):
            return []
        ends = stop.tolist()
        return [m.span() for a, b in zip(ends, ends[1:]) for m in self.special.finditer(whole, a, b)]

    def merged(self, words: list[bytes]) -> list[bytes]:
        """The ids of each word as int32 bytes. All words are merged at once: in each round, every word joins its
        pair of least rank wherever it stands, leftmost first, until it has no pair left."""
        out = [b""] * len(words)
        sizes = np.fromiter(map(len, words), np.int64, len(words))
        ids = self.first[np.frombuffer(b"".join(words), np.uint8)]
        word = np.repeat(np.arange(len(words)), sizes)
        rank, new = np.full(len(ids), NO_PAIR), np.zeros(len(ids), np.int64)   # of the pair that begins at each place
        changed = np.arange(len(ids))
        while len(ids):
            changed = changed[changed + 1 < len(ids)]
            key = ids[changed] << 32 | ids[changed + 1]
            at = np.minimum(np.searchsorted(self.pair, key), len(self.pair) - 1)
            found = (self.pair[at] == key) & (word[changed] == word[changed + 1])
            rank[changed] = np.where(found, self.rank[at], NO_PAIR)
            new[changed] = self.new[at]
            begin = np.flatnonzero(np.concatenate(([True], word[1:] != word[:-1])))
            sizes = np.diff(np.append(begin, len(ids)))
            least = np.minimum.reduceat(rank, begin)
            done = least == NO_PAIR
            if done.any():
                flat = ids.astype(np.int32).tobytes()
                for w, i, n in zip(word[begin[done]].tolist(), begin[done].tolist(), sizes[done].tolist()):
                    out[w] = flat[4 * i:4 * (i + n)]
                live = np.repeat(~done, sizes)
                ids, word, rank, new = ids[live], word[live], rank[live], new[live]
                least, sizes = least[~done], sizes[~done]
            if not len(ids):
                break
            chosen = rank == np.repeat(least, sizes)
            # of overlapping places (x x x), every other one from the left
            place = np.arange(len(ids))
            head = np.maximum.accumulate(np.where(chosen & ~np.concatenate(([False], chosen[:-1])), place, -1))
            chosen &= (place - head) % 2 == 0
            ids = np.where(chosen, new, ids)
            stay = ~np.concatenate(([False], chosen[:-1]))
            ids, word, rank, new, chosen = ids[stay], word[stay], rank[stay], new[stay], chosen[stay]
            # pairs that begin or end with a merged token, and the last of each word, which lost its right side
            rank[chosen] = NO_PAIR
            chosen[:-1] |= chosen[1:]
            changed = np.flatnonzero(chosen)
        return out

    def ids(self, words: list[bytes]) -> list[bytes]:
        """The ids of each word, as int32 bytes."""
        out: list[bytes] = []
        for i in range(0, len(words), 8192):    # a few arrays that fit the processor's cache
            out += self.merged(words[i:i + 8192])
        for content, i in self.added.items():
            if content.encode() in words:
                out[words.index(content.encode())] = np.int32(i).tobytes()
        return out

    def text(self, ids: np.ndarray, ends: np.ndarray) -> list[str]:
        """The texts of runs of ids that end at ``ends``."""
        n = self.size[ids]
        stop = np.cumsum(n)
        data = self.blob[np.arange(stop[-1] if len(stop) else 0) + np.repeat(self.at[ids] - (stop - n), n)].tobytes()
        stop = np.concatenate(([0], stop))[ends].tolist()
        return [data[a:b].decode("utf-8", "replace") for a, b in zip([0, *stop], stop)]


@lru_cache(maxsize=2)
def vocabulary(path: str) -> Vocabulary:
    return Vocabulary(path)


def compile_transducer(words: list[bytes]) -> dict[str, np.ndarray]:
    """The minimal acyclic automaton of sorted distinct words, as arrays over its transitions in (state, byte)
    order: key, target, and number, which sums along a path to the word's place. State 0 is the start."""
    register: dict[tuple, int] = {}     # a finished state's (final, transitions) -> its number
    count: list[int] = []               # words that a finished state accepts
    path: list[list] = [[False, []]]    # the unfinished states of the last word: final, [(byte, state)]

    def finish(down_to: int, word: bytes) -> None:
        while len(path) > down_to + 1:
            final, edges = path.pop()
            key = (final, tuple(edges))
            state = register.setdefault(key, len(register))
            if state == len(count):
                count.append(final + sum(count[t] for _, t in edges))
            path[-1][1].append((word[len(path) - 1], state))

    last = b""
    for word in words:
        common = len(os.path.commonprefix((last, word)))
        finish(common, last)
        path += [[False, []] for _ in word[common:]]
        path[-1][0] = True
        last = word
    finish(0, last)
    states = [(path[0][0], tuple(path[0][1])), *register]
    key, target, number = [], [], []
    for s, (final, edges) in enumerate(states):
        below = int(final)
        for byte, t in edges:
            key.append(s << 8 | byte)
            target.append(t + 1)
            number.append(below)
            below += count[t]
    return {"key": np.array(key, np.int64), "target": np.array(target, np.int32), "number": np.array(number, np.int32),
            "final": np.array([f for f, _ in states], np.bool_)}


class Lexicon:
    """The transducer and the ids of its words, mapped from a file."""

    FIELDS = (("key", np.int64), ("target", np.int32), ("number", np.int32), ("ids_at", np.int32), ("ids", np.int32), ("final", np.bool_))

    def __init__(self, path: str) -> None:
        sizes = np.fromfile(path, np.int64, len(self.FIELDS))
        at = sizes.nbytes
        for (name, kind), n in zip(self.FIELDS, sizes.tolist()):
            setattr(self, name, np.memmap(path, kind, "r", at, n) if n else np.empty(0, kind))
            at += n * np.dtype(kind).itemsize

    @classmethod
    def write(cls, path: str, words: Iterable[bytes], ids: Iterable[bytes]) -> None:
        table = dict(zip(words, ids))
        keys = sorted(table)
        data = compile_transducer(keys)
        data["ids"] = np.frombuffer(b"".join(table[k] for k in keys), np.int32)
        data["ids_at"] = np.cumsum([0, *(len(table[k]) // 4 for k in keys)]).astype(np.int32)
        with open(path, "wb") as f:
            np.array([len(data[n]) for n, _ in cls.FIELDS], np.int64).tofile(f)
            for n, kind in cls.FIELDS:
                data[n].astype(kind).tofile(f)

    def places(self, words: list[bytes]) -> np.ndarray:
        """The place of each word, or -1: all words take a step at a time."""
        n = len(words)
        out = np.full(n, -1, np.int64)
        if not n or not len(self.key):
            return out
        lengths = np.fromiter(map(len, words), np.int64, n)
        data = np.frombuffer(b"".join(words), np.uint8)
        at = np.cumsum(lengths) - lengths
        live, state, total, step = np.flatnonzero(lengths), np.zeros(n, np.int64), np.zeros(n, np.int64), 0
        while len(live):
            key = state[live] << 8 | data[at[live] + step]
            edge = np.minimum(np.searchsorted(self.key, key), len(self.key) - 1)
            good = self.key[edge] == key
            live, edge = live[good], edge[good]
            state[live] = self.target[edge]
            total[live] += self.number[edge]
            step += 1
            done = live[lengths[live] == step]
            done = done[self.final[state[done]]]
            out[done] = total[done]
            live = live[lengths[live] > step]
        return out

    def ids_of(self, place: int) -> bytes:
        return self.ids[self.ids_at[place]:self.ids_at[place + 1]].tobytes()


def frequent_words(docs: DataFrame, vocabulary_path: str, share: int, text: str = "text") -> list[bytes]:
    """All words of all documents are counted, a slice of them (a task's, or about SLICE_WORDS words) at a time.
    A word that makes one in ``share`` of all words does so in some slice: a slice hands on such words only, at most
    ``share``, and those that sum up to one in ``share`` of the total are frequent: at most ``share`` again."""
    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        v, waiting = vocabulary(vocabulary_path), []
        for b in slices(batches, text):
            waiting.append(v.words(b.column(0))[0])
            if sum(map(len, waiting)) > SLICE_WORDS:
                yield rows(waiting)
                waiting = []
        yield rows(waiting)

    def rows(waiting: list[pa.Array]) -> pa.RecordBatch:
        found = pc.value_counts(pa.chunked_array(waiting, pa.binary()))
        n = found.field("counts").to_numpy(zero_copy_only=False)
        often = np.flatnonzero((n * share >= n.sum()) & (n > 1))
        words = pa.concat_arrays([found.field("values").take(pa.array(often)), pa.nulls(1, pa.binary())])
        return pa.RecordBatch.from_arrays([words, pa.array(np.append(n[often], n.sum()), pa.int64())], ["word", "n"])

    counts = cut(docs.select(F.col(f"`{text}`").cast("string").alias(text)).mapInArrow(count, "word binary, n long").groupBy("word").agg(F.sum("n").alias("n")))
    total = counts.where("word is null").agg(F.sum("n")).first()[0] or 0
    return [bytes(r.word) for r in counts.where(F.col("word").isNotNull() & (F.col("n") * share >= total)).select("word").collect()]


def build_lexicon(docs: DataFrame, vocabulary_path: str, share: int = SHARE, text: str = "text") -> str:
    """Compile the frequent words and hand the file to all executors; returns its name."""
    v = vocabulary(vocabulary_path)
    added = {t.encode() for t in v.added}
    words = [w for w in frequent_words(docs, vocabulary_path, share, text) if w not in added]
    # Spark's own folder on the driver, kept while the application runs: executors, also new ones, fetch the file from it
    folder = os.path.join(SparkFiles.getRootDirectory(), "made")
    os.makedirs(folder, exist_ok=True)
    made = os.path.join(folder, f"lexicon-{uuid.uuid4().hex}")
    Lexicon.write(made, words, v.merged(words))
    docs.sparkSession.sparkContext.addFile(made)
    return os.path.basename(made)


class Encoder:
    """Encodes texts: words of the lexicon by walking it, others by merging; both are remembered."""

    def __init__(self, v: Vocabulary, lexicon: Lexicon) -> None:
        self.v, self.lexicon = v, lexicon
        self.known: dict[bytes, bytes] = {}

    def learn(self, words: list[bytes]) -> None:
        if len(self.known) > REMEMBERED:
            self.known.clear()
        new = [w for w in words if w not in self.known]
        places = self.lexicon.places(new).tolist()
        self.known.update((w, self.lexicon.ids_of(p)) for w, p in zip(new, places) if p >= 0)
        unseen = [w for w, p in zip(new, places) if p < 0]
        self.known.update(zip(unseen, self.v.ids(unseen)))

    def encode(self, texts: pa.Array) -> pa.ListArray:
        """The ids of each text."""
        words, ends = self.v.words(texts)
        words = words.dictionary_encode()
        distinct, which = words.dictionary.to_pylist(), words.indices.to_numpy(zero_copy_only=False)
        self.learn(distinct)
        ids = [self.known[w] for w in distinct]
        size = np.fromiter(map(len, ids), np.int64, len(ids)) // 4
        first, n = np.cumsum(size) - size, size[which]
        stop = np.concatenate(([0], np.cumsum(n)))
        flat = np.frombuffer(b"".join(ids), np.int32)
        flat = flat[np.arange(stop[-1]) + np.repeat(first[which] - stop[:-1], n)]
        return pa.ListArray.from_arrays(pa.array(stop[np.concatenate(([0], ends))].astype(np.int32)), pa.array(flat))


def decoded(v: Vocabulary, lists: pa.ListArray) -> pa.Array:
    n = pc.fill_null(pc.list_value_length(lists), 0).to_numpy(zero_copy_only=False)
    return pa.array(v.text(lists.flatten().to_numpy(zero_copy_only=False), np.cumsum(n)), pa.string())


def encode(docs: DataFrame, vocabulary_path: str, lexicon: str, text: str = "text", decode_too: bool = False) -> DataFrame:
    """rest (all columns but the text) and ids; with ``decode_too`` also the text that the ids decode to, in the same pass."""
    names = ["rest", "ids", "text"] if decode_too else ["rest", "ids"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        e = None
        for b in slices(batches, "text"):
            e = e or Encoder(vocabulary(vocabulary_path), Lexicon(SparkFiles.get(lexicon)))
            lists = e.encode(b.column("text"))
            yield pa.RecordBatch.from_arrays([b.column("rest"), lists, *([decoded(e.v, lists)] if decode_too else [])], names)

    frame = docs.select(rest_of(docs, text), F.col(text).cast("string").alias("text"))
    return frame.mapInArrow(run, f"rest {dict(frame.dtypes)['rest']}, ids array<int>" + ", text string" * decode_too)


def decode(encoded: DataFrame, vocabulary_path: str) -> DataFrame:
    """rest, ids and the text that the ids stand for."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in pieces(batches, 200):
            lists = b.column("ids")
            yield pa.RecordBatch.from_arrays([b.column("rest"), lists, decoded(vocabulary(vocabulary_path), lists)], ["rest", "ids", "text"])

    return encoded.mapInArrow(run, f"rest {dict(encoded.dtypes)['rest']}, ids array<int>, text string")


def encode_and_decode(docs: DataFrame, vocabulary_path: str | None = None, share: int = SHARE, text: str = "text") -> DataFrame:
    """rest (all columns but the text), ids and the text that they decode to."""
    path = vocabulary_path or public_tokenizers.path("byte_bpe_50k.json")
    return encode(docs, path, build_lexicon(docs, path, share, text), text, decode_too=True)


def digest(found: DataFrame, doc_id: str = "doc_id") -> DataFrame:
    return found.select(F.col(f"rest.{doc_id}").alias("doc_id"), F.size("ids").cast("long").alias("n_tokens"),
                        F.sha2(F.array_join(F.col("ids").cast("array<string>"), ",").cast("binary"), 256).alias("ids_sha256"),
                        F.sha2(F.col("text").cast("binary"), 256).alias("decoded_sha256"))
