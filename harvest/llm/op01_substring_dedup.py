"""Substring dedup by repeated-phrase automata.

A window is 20 consecutive words of one document. A word goes if a window over it has a word sequence
that also starts earlier: in an earlier document, or earlier in the same one. Windows are judged on the
input, not on what is left.

1. Marks (see _passages) find the stretches of text that can repeat at all; documents without one hold no
   repeated phrase and need no automaton. The others' stretches are dealt into shards by mark, so that a
   document meets only the automata that can match it, instead of every document every automaton.
2. Inside a shard the recurring phrases are confirmed: windows that stand in the shard's stretches twice or
   more, counted on their words.
3. The confirmed phrases are compiled into Aho-Corasick automata of a bounded number of phrases. Words
   become single characters for that, so that a phrase can match at word borders only.
4. The shard's stretches stream through the automata in document order. Each hit is an occurrence: the
   first of a phrase stays, all later ones go.

Defined cases: null text has no words; a null id sorts after all others; rows with the same id and text are
one document and get the same result; documents with the same id are ordered by a hash of their text; with
fewer than 20 words nothing goes. Other columns are carried in ``rest`` and cannot clash.
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterator

import ahocorasick
import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from harvest.llm._passages import Piece, Words, covered, keyed, located, marks, packed, spans_of, stretches, unpack

#: Phrases of one automaton, and bytes of distinct text that share it: small ones stay in the processor's cache.
AUTOMATON, ROOM = 20_000, 1 << 16
SURROGATES = range(0xD800, 0xE000)


def letters(texts: list[str]) -> Iterator[str]:
    """Each text with every word as one character, the same for equal words."""
    known: dict[str, str] = {}
    for text in texts:
        out = []
        for w in text.split(" "):
            c = known.get(w)
            if c is None:
                n = len(known) + 1
                c = known[w] = chr(n if n < SURROGATES.start else n + len(SURROGATES))
            out.append(c)
        yield "".join(out)


def confirmed(texts: list[str], several: list[bool], size: int) -> list[str]:
    """The phrases that stand in these texts twice or more, in the order they are met."""
    seen: Counter = Counter()
    for s, twice in zip(texts, several):
        here = [s[i:i + size] for i in range(len(s) - size + 1)]
        seen.update(here)
        if twice:
            seen.update(here)
    return [p for p, n in seen.items() if n > 1]


def automata(phrases: list[str], most: int = AUTOMATON) -> Iterator[ahocorasick.Automaton]:
    for i in range(0, len(phrases), most):
        a = ahocorasick.Automaton()
        for k, p in enumerate(phrases[i:i + most]):
            a.add_word(p, k)
        a.make_automaton()
        yield a


def later_occurrences(pieces: list[Piece], size: int, most: int = AUTOMATON) -> Iterator[tuple]:
    """Of each piece, the windows that have an earlier copy. Pieces come in document order."""
    texts = list(letters([p.text.decode("utf-8", "surrogatepass") for p in pieces]))
    for a in automata(confirmed(texts, [p.several for p in pieces], size), most):
        met = bytearray(len(a))
        for p, s in zip(pieces, texts):
            first = n = 0
            for end, phrase in a.iter(s):
                if not met[phrase]:
                    met[phrase] = 1
                    continue
                at = end - size + 1
                if n and at == first + n:
                    n += 1
                    continue
                if n:
                    yield p, first, n
                first, n = at, 1
            if n:
                yield p, first, n
    for p in pieces:
        if len(p.places) > 1:
            yield p, None, None


def substring_dedup(docs: DataFrame, size: int = 20, gram: int = 8, doc_id: str = "doc_id", text: str = "text",
                    hot: int = 1 << 16, batch_hot: int = 1 << 12, automaton: int = AUTOMATON, room: int = ROOM) -> DataFrame:
    """id, rest (all columns but the text), n_words, n_removed, kept_text: a row for each row of ``docs``."""
    kind = Words(size, gram)
    keys = keyed(docs, doc_id, text)
    store = packed(keys)
    pieces = stretches(store, marks(keys, kind, hot, batch_hot), kind)
    spans = spans_of(located(pieces, lambda group: later_occurrences(group, size, automaton), room))

    def keep(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            zs, found, out = b.column("z"), b.column("spans"), []
            for i in range(b.num_rows):
                tokens = kind.tokens(unpack(zs[i].as_py()))
                gone = covered(len(tokens), size, found[i].as_py())
                left = [t for t, g in zip(tokens, gone.tolist()) if not g] if gone.any() else tokens
                out.append((len(tokens), len(tokens) - len(left), " ".join(left)))
            yield pa.RecordBatch.from_arrays([b.column("id"), b.column("rest"), *(pa.array(x, t) for x, t in zip(zip(*out), (pa.int64(), pa.int64(), pa.string())))],
                                             ["id", "rest", "n_words", "n_removed", "kept_text"])

    rest = dict(store.dtypes)["rest"]
    return (store.join(spans, ["dk", "th"], "left").select("id", "rest", "z", "spans")
            .mapInArrow(keep, f"id long, rest {rest}, n_words long, n_removed long, kept_text string"))


def digest(found: DataFrame) -> DataFrame:
    return found.select(F.col("id").alias("doc_id"), "n_words", "n_removed", F.sha2(F.col("kept_text").cast("binary"), 256).alias("kept_sha256"))
