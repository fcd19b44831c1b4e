"""Suffix-array dedup by longest-previous-factor arrays.

Documents are UTF-8 bytes. A byte goes if a string of 200 bytes over it, inside its document, also starts
elsewhere: anywhere else (``keep_first=False``), or earlier (``keep_first=True``, which keeps the first copy).
Strings are judged on the input; overlapping copies count.

1. Marks (see _passages) leave the stretches of text that can hold a repeated string, and deal them into
   shards by mark: equal strings meet in one shard, as parts of a bounded text.
2. A shard concatenates its distinct stretches in document order and sorts its suffixes to the depth asked
   for (rank by 8 bytes, then by three ranks at a time).
3. In suffix order, the previous and the next smaller position of a suffix give its longest earlier match,
   and the previous and next larger ones its longest later match. Both lengths are needed only up to the
   depth: among suffixes with the same first 200 bytes, which stand together ordered by position, the
   previous smaller and the next larger position are the neighbours, so a factor is long enough where the
   neighbour shares the rank. Only starts whose whole string lies in one stretch count.

Defined cases: null text is empty; a null id sorts after all others; rows with the same id and text are one
document and get the same result; texts shorter than the string lose nothing. Other columns are carried in
``rest`` and cannot clash.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from harvest.llm._passages import Bytes, Piece, covered, keyed, located, marks, packed, spans_of, stretches, unpack

#: Bytes of distinct text that a shard holds at once: three ranks of such a text fit one 64-bit key.
ROOM = 3 << 18


def dense(keys: np.ndarray) -> np.ndarray:
    """The rank of each key among the distinct keys."""
    order = np.argsort(keys)
    s = keys[order]
    rank = np.empty(len(keys), np.uint64)
    rank[order] = np.cumsum(np.concatenate(([False], s[1:] != s[:-1])), dtype=np.uint64)
    return rank


def ahead(rank: np.ndarray, by: int) -> np.ndarray:
    """The value ``by`` places on; 0 beyond the end."""
    out = np.zeros_like(rank)
    out[:max(0, len(rank) - by)] = rank[by:]
    return out


def suffix_ranks(data: np.ndarray, depth: int) -> np.ndarray:
    """The rank of each suffix by its first ``depth`` bytes; bytes beyond the end count as zero."""
    n, have = len(data), min(8, depth)
    padded = np.concatenate((data, np.zeros(8, np.uint8))).astype(np.uint64)
    keys = np.zeros(n, np.uint64)
    for j in range(have):
        keys = keys << np.uint64(8) | padded[j:j + n]
    rank = dense(keys)
    width = max(1, int(n).bit_length())
    while have < depth:
        if 3 * width <= 64:
            to = min(depth, 3 * have)
            last = to - have
            keys = (rank << np.uint64(2 * width)) | (ahead(rank, min(have, last)) << np.uint64(width)) | ahead(rank, last)
        else:
            to = min(depth, 2 * have)
            keys = (rank << np.uint64(32)) | ahead(rank, to - have)
        rank, have = dense(keys), to
    return rank


def factors(data: np.ndarray, starts: np.ndarray, depth: int) -> tuple[np.ndarray, np.ndarray]:
    """For each of the ``starts`` (rising), whether its previous and its next factor reach ``depth``."""
    rank = suffix_ranks(data, depth)[starts]
    order = np.argsort(rank.astype(np.int64) * (len(starts) + 1) + np.arange(len(starts)))
    same = rank[order[1:]] == rank[order[:-1]]
    previous, following = np.zeros(len(starts), bool), np.zeros(len(starts), bool)
    previous[order[1:]] = same
    following[order[:-1]] = same
    return previous, following


def runs(flags: np.ndarray) -> list[tuple[int, int]]:
    edge = np.flatnonzero(np.diff(np.concatenate(([0], flags.astype(np.int8), [0]))))
    return [(int(a), int(b - a)) for a, b in zip(edge[::2], edge[1::2])]


def repeated_strings(pieces: list[Piece], size: int, keep_first: bool) -> Iterator[tuple]:
    """Of each piece, the starts of strings that are to go. Pieces come in document order."""
    if not pieces:
        return
    data = np.frombuffer(b"".join(p.text for p in pieces), np.uint8)
    length = np.array([len(p.text) for p in pieces])
    windows = length - size + 1
    at = np.concatenate(([0], np.cumsum(length)[:-1]))
    base = np.concatenate(([0], np.cumsum(windows)))
    starts = np.arange(base[-1]) + np.repeat(at - base[:-1], windows)
    previous, following = factors(data, starts, size)
    gone = previous if keep_first else previous | following
    any_gone = np.logical_or.reduceat(gone, base[:-1])
    for k, p in enumerate(pieces):
        if p.several and not keep_first:
            yield p, 0, int(windows[k])
        elif any_gone[k]:
            for first, n in runs(gone[base[k]:base[k + 1]]):
                yield p, first, n
        if len(p.places) > 1:
            yield p, None, None


def suffix_dedup(docs: DataFrame, size: int = 200, gram: int = 32, doc_id: str = "doc_id", text: str = "text", keep_first: bool = False,
                 whole_characters: bool = False, hot: int = 1 << 16, batch_hot: int = 1 << 12, room: int = ROOM) -> DataFrame:
    """id, rest (all columns but the text), n_bytes, n_removed, n_spans, kept (binary): a row for each row of ``docs``.
    With ``whole_characters``, what is left of characters that a span cuts goes too, so that ``kept`` is valid UTF-8."""
    kind = Bytes(size, gram)
    keys = keyed(docs, doc_id, text)
    store = packed(keys)
    pieces = stretches(store, marks(keys, kind, hot, batch_hot), kind, keep_first)
    spans = spans_of(located(pieces, lambda group: repeated_strings(group, size, keep_first), room))

    def keep(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            zs, found, out = b.column("z"), b.column("spans"), []
            for i in range(b.num_rows):
                data = kind.tokens(unpack(zs[i].as_py()))
                gone = covered(len(data), size, found[i].as_py())
                left = np.frombuffer(data, np.uint8)[~gone].tobytes() if gone.any() else data
                if whole_characters and gone.any():
                    left = left.decode("utf-8", "ignore").encode()
                out.append((len(data), len(data) - len(left), len(runs(gone)), left))
            yield pa.RecordBatch.from_arrays([b.column("id"), b.column("rest"), *(pa.array(x, t) for x, t in zip(zip(*out), (*(pa.int64(),) * 3, pa.binary())))],
                                             ["id", "rest", "n_bytes", "n_removed", "n_spans", "kept"])

    rest = dict(store.dtypes)["rest"]
    return (store.join(spans, ["dk", "th"], "left").select("id", "rest", "z", "spans")
            .mapInArrow(keep, f"id long, rest {rest}, n_bytes long, n_removed long, n_spans long, kept binary"))


def digest(found: DataFrame) -> DataFrame:
    return found.select(F.col("id").alias("doc_id"), "n_bytes", "n_removed", "n_spans", F.sha2("kept", 256).alias("kept_sha256"))
