"""Bring all places of a repeated passage together, without a row per position.

A *window* is a run of ``size`` consecutive tokens of one document (words or bytes). Its *mark* is
the least 64-bit hash of the ``gram``-token runs inside it, so equal windows have equal marks and
neighbouring windows mostly share one. A *stretch* is a run of consecutive windows with one mark:
every window belongs to exactly one stretch, so what is found for stretches with the same mark is
found for all windows.

    marks()      documents -> one narrow row per stretch; marks that occur once are dropped, the rest
                 is gathered per document, that is per dk and th (a list no longer than the document)
    stretches()  those documents again -> the text of each stretch that is left, routed by its mark;
                 copies inside a batch go as one row
    located()    a shuffle by mark, and a function over groups of stretches that gives spans
    spans_of()   the spans, gathered per document as well

Hashes only route: whether windows are equal is decided on their tokens.

Hot marks. Of a mark that occurs over ``batch_hot`` times in what a task reads, the rows from then on go
straight to their documents, and one summary row a batch informs the others (marks are counted in cells; one that shares
a cell with a frequent mark is treated like it, which costs time and changes nothing). Stretches of a mark with such a
row, or with over ``hot`` rows, are split into their single windows, each routed by a hash of its own
tokens, so that a passage found in a third of all documents is dealt over many tasks and its copies
collapse batch by batch. All paths give the same spans.

Keys. ``dk`` is the document's id, or a hash of its text where the id is null; ``th`` is a hash of its
text. Rows with the same id and text are one document. Documents are ordered by id (nulls last), then ``th``.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import xxhash
import zstandard
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from harvest.llm._text import U64, WORD, gram_hashes, mix, rest_of, window_min

LONGEST = 4096      # windows of a stretch; longer ones are cut
CELL_BITS = 20      # of the counters of a task (8 MB); marks that share one are counted together


class WordCodes(dict):
    """A 64-bit hash for each word seen of late."""

    def __missing__(self, word: str) -> int:
        if len(self) > 200_000:
            self.clear()
        code = self[word] = xxhash.xxh64_intdigest(word.encode("utf-8", "surrogatepass"))
        return code


@dataclass(frozen=True)
class Words:
    """Documents as words."""

    size: int = 20
    gram: int = 8

    def tokens(self, text: str) -> list[str]:
        return WORD.findall(text)

    def codes(self, tokens: list[str], known: WordCodes) -> np.ndarray:
        return np.fromiter(map(known.__getitem__, tokens), np.uint64, len(tokens))

    def piece(self, tokens: list[str], start: int, end: int) -> bytes:
        return " ".join(tokens[start:end]).encode("utf-8", "surrogatepass")


#: A fixed random number for each byte value.
BYTE_CODES = mix(np.arange(1, 257, dtype=np.uint64) * U64(0x9E3779B97F4A7C15))


@dataclass(frozen=True)
class Bytes:
    """Documents as UTF-8 bytes."""

    size: int = 200
    gram: int = 32

    def tokens(self, text: str) -> bytes:
        return text.encode("utf-8", "surrogatepass")

    def codes(self, tokens: bytes, known: WordCodes) -> np.ndarray:
        return BYTE_CODES[np.frombuffer(tokens, np.uint8)]

    def piece(self, tokens: bytes, start: int, end: int) -> bytes:
        return tokens[start:end]


def stretches_of(codes: np.ndarray, size: int, gram: int) -> tuple[np.ndarray, ...]:
    """mark, first window, number of windows and weight of each stretch. The weight is 2 where the
    mark's gram stands at several places inside the stretch, which can then repeat itself."""
    w = size - gram + 1
    grams = gram_hashes(codes, gram)
    if len(grams) < w:
        return (np.empty(0, np.uint64), *(np.empty(0, np.int64),) * 3)
    least = window_min(grams, w)
    edge = np.flatnonzero(least[1:] != least[:-1]) + 1
    starts = np.concatenate(([0], edge))
    ends = np.concatenate((edge, [len(least)]))
    if (ends - starts).max() > LONGEST:
        starts = np.unique(np.concatenate([np.arange(a, b, LONGEST) for a, b in zip(starts, ends)]))
        ends = np.append(starts[1:], len(least))
    inside = np.arange(w)
    twice = np.empty(len(starts), np.int64)
    for i in range(0, len(starts), 4096):
        a, b = starts[i:i + 4096], ends[i:i + 4096] - 1
        twice[i:i + 4096] = (a + grams[a[:, None] + inside].argmin(1)) != (b + grams[b[:, None] + inside].argmin(1))
    return least[starts], starts, ends - starts, 1 + twice


def keyed(docs: DataFrame, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """dk, th, id, rest (all columns but the text) and text (null: empty)."""
    body = F.coalesce(F.col(text).cast("string"), F.lit(""))
    number = F.col(doc_id).cast("long")
    return docs.select(F.coalesce(number, F.xxhash64(body)).alias("dk"), F.xxhash64(body).alias("th"),
                       number.alias("id"), rest_of(docs, text), body.alias("text"))


def packed(docs: DataFrame) -> DataFrame:
    """keyed() with the text compressed, dealt out by dk and th: one shuffle that both joins on them share."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        z = zstandard.ZstdCompressor(level=3)
        for b in batches:
            texts = b.column("text")
            blobs = [z.compress(texts[i].as_py().encode("utf-8", "surrogatepass")) for i in range(b.num_rows)]
            yield pa.RecordBatch.from_arrays([*b.columns[:4], pa.array(blobs, pa.binary())], ["dk", "th", "id", "rest", "z"])

    kinds = dict(docs.dtypes)
    return (docs.mapInArrow(run, f"dk long, th long, id long, rest {kinds['rest']}, z binary")
            .where("dk is not null and th is not null").repartition("dk", "th"))    # the filter that a join would put here, for all who share it


def unpack(z: bytes) -> str:
    return zstandard.ZstdDecompressor().decompress(z).decode("utf-8", "surrogatepass")


def marks(docs: DataFrame, kind: Words | Bytes, hot: int, batch_hot: int) -> DataFrame:
    """dk, th and the list of its stretches (mark, at) whose mark repeats in the corpus.

    ``at`` holds the first window, the number of windows and whether the mark is hot."""
    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known, cells = WordCodes(), np.zeros(1 << CELL_BITS, np.int64)
        for b in batches:
            keys, ths = (b.column(n).to_numpy(zero_copy_only=False) for n in ("dk", "th"))
            texts, found = b.column("text"), []
            for i in range(b.num_rows):
                m, start, n, weight = stretches_of(kind.codes(kind.tokens(texts[i].as_py()), known), kind.size, kind.gram)
                if len(m):
                    found.append((m.view(np.int64), np.full(len(m), keys[i]), np.full(len(m), ths[i]), start << 14 | n << 1, weight))
            if not found:
                continue
            mark, dk, th, at, weight = (np.concatenate(x) for x in zip(*found))
            route = mark.copy()
            cell = (mix(mark.view(np.uint64)) >> U64(64 - CELL_BITS)).astype(np.int64)
            cells += np.bincount(cell, minlength=len(cells))        # over all that the task has read, not over this batch alone
            sure = cells[cell] > batch_hot
            if sure.any():
                known_hot = np.unique(mark[sure])
                route[sure] = mix(dk[sure].view(np.uint64) ^ mix(th[sure].view(np.uint64))).view(np.int64)
                weight[sure] = -1
                k = len(known_hot)
                route, mark = np.concatenate((route, known_hot)), np.concatenate((mark, known_hot))
                dk, th, at = (np.concatenate((x, np.zeros(k, np.int64))) for x in (dk, th, at))
                weight = np.concatenate((weight, np.full(k, -2)))
            yield pa.RecordBatch.from_arrays([pa.array(x) for x in (route, mark, dk, th, at, weight.astype(np.int32))],
                                             ["route", "mark", "dk", "th", "at", "weight"])

    def repeated(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """Rows sorted by mark: keep those of marks that occur twice. weight -1: sure already; -2: a summary. Of the mark that may go on in the
        next batch, rows are held back until it is known to be hot, so never more than ``hot`` and a batch."""
        tail, going_on = None, None
        for b in batches:
            cols = [b.column(n).to_numpy(zero_copy_only=False) for n in ("mark", "dk", "th", "at", "weight")]
            if going_on is not None:
                n = int(np.searchsorted(cols[0], going_on, "right"))
                yield from keep([x[:n] for x in cols], True)
                cols = [x[n:] for x in cols]
                if not len(cols[0]):
                    continue
                going_on = None
            if tail is not None:
                cols = [np.concatenate(x) for x in zip(tail, cols)]
            last = np.searchsorted(cols[0], cols[0][-1])
            yield from keep([x[:last] for x in cols])
            tail = [x[last:] for x in cols]
            if np.maximum(tail[4], 0).sum() > hot or (tail[4] == -2).any():
                yield from keep(tail, True)
                tail, going_on = None, tail[0][0]
        if tail is not None:
            yield from keep(tail)

    def keep(cols: list[np.ndarray], known_hot: bool = False) -> Iterator[pa.RecordBatch]:
        mark, dk, th, at, weight = cols
        if not len(mark):
            return
        first = np.flatnonzero(np.concatenate(([True], mark[1:] != mark[:-1])))
        size = np.diff(np.append(first, len(mark)))
        total = np.add.reduceat(np.maximum(weight, 0), first)
        summary = np.logical_or.reduceat(weight == -2, first) | known_hot
        is_hot = np.repeat(summary | (total > hot), size) | (weight == -1)
        good = (weight != -2) & ((weight == -1) | np.repeat(summary | (total > 1), size))
        yield pa.RecordBatch.from_arrays([pa.array(x) for x in (dk[good], th[good], mark[good], at[good] | is_hot[good])], ["dk", "th", "mark", "at"])

    rows = (docs.select("dk", "th", "text").mapInArrow(scan, "route long, mark long, dk long, th long, at long, weight int")
            .repartition("route").sortWithinPartitions("mark")
            .mapInArrow(repeated, "dk long, th long, mark long, at long"))
    return rows.groupBy("dk", "th").agg(F.collect_list(F.struct("mark", "at")).alias("found"))


def stretches(docs: DataFrame, found: DataFrame, kind: Words | Bytes, keep_first: bool = True) -> DataFrame:
    """route, piece, copies, id, th, start of the first of them, n windows, and spans of windows already
    known to go (``later``): copies inside the batch but the first, or all if ``keep_first`` is false."""
    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            group: dict = {}
            ids, ths, dks = (b.column(n).to_pylist() for n in ("id", "th", "dk"))
            zs, lists = b.column("z"), b.column("found")
            for i in range(b.num_rows):
                tokens = kind.tokens(unpack(zs[i].as_py()))
                here = lists[i].values.flatten()
                for mark, at in zip(here[0].to_pylist(), here[1].to_pylist()):
                    start, n = at >> 14, at >> 1 & 0x1FFF
                    for s, m in ((x, 1) for x in range(start, start + n)) if at & 1 else ((start, n),):
                        piece = kind.piece(tokens, s, s + m + kind.size - 1)
                        route = xxhash.xxh64_intdigest(piece) - (1 << 63) if at & 1 else mark
                        group.setdefault((route, piece), []).append((ids[i] is None, dks[i], ths[i], s, m))
            rows: list = []
            later: list = []
            for (route, piece), places in group.items():
                places = sorted(set(places))
                rows.append((route, piece, len(places), *places[0], False))
                if len(places) > 1:
                    later += [x[1:] for x in places[keep_first:]]
                if len(rows) > 20_000:
                    yield batch(rows)
                    rows = []
            later.sort()
            for dk, th, start, n in joined(later):
                rows.append((xxhash.xxh64_intdigest(b"%d %d" % (dk, start)) - (1 << 63), None, 0, False, dk, th, start, n, True))
            for i in range(0, len(rows), 20_000):
                yield batch(rows[i:i + 20_000])

    def batch(rows: list) -> pa.RecordBatch:
        kinds = (pa.int64(), pa.binary(), pa.int32(), pa.bool_(), pa.int64(), pa.int64(), pa.int64(), pa.int32(), pa.bool_())
        return pa.RecordBatch.from_arrays([pa.array(x, t) for x, t in zip(zip(*rows), kinds)], NAMES)

    return (docs.join(found, ["dk", "th"]).select("dk", "th", "id", "rest", "z", "found")
            .mapInArrow(read, "route long, piece binary, copies int, noid boolean, dk long, th long, start long, n int, later boolean"))


def joined(spans: list[tuple]) -> Iterator[tuple]:
    """Sorted spans (dk, th, start, n), with those that touch made one."""
    now = None
    for dk, th, start, n in spans:
        if now and now[:2] == (dk, th) and start <= now[2] + now[3]:
            now = (dk, th, now[2], max(now[3], start + n - now[2]))
            continue
        if now:
            yield now
        now = (dk, th, start, n)
    if now:
        yield now


NAMES = ["route", "piece", "copies", "noid", "dk", "th", "start", "n", "later"]


@dataclass(slots=True)
class Piece:
    """A distinct piece of a group: its places in document order, and whether it stands at several."""

    text: bytes
    places: list
    several: bool


def located(rows: DataFrame, repeats: Callable[[list[Piece]], Iterator[tuple]], room: int) -> DataFrame:
    """dk, th, start, n: spans of windows. ``repeats`` gets the distinct pieces of whole groups, about ``room``
    bytes of them, and yields (piece, first window, windows) for all windows of the piece's first place
    that are to go, and (piece, None, None) where all its later places are."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        group: dict = {}
        size, now = 0, None
        for b in batches:
            out: list = []
            cols = [b.column(n).to_pylist() for n in NAMES]
            for route, piece, copies, noid, dk, th, start, n, later in zip(*cols):
                if later:
                    out.append((dk, th, start, n))
                    continue
                if route != now and size > room:
                    out += resolve(group)
                    group, size = {}, 0
                now = route
                known = group.get(piece)
                if known is None:
                    known = group[piece] = Piece(piece, [], False)
                    size += len(piece)
                known.places.append((noid, dk, th, start, n))
                known.several |= copies > 1
                if len(out) > 50_000:
                    yield spans(out)
                    out = []
            if out:
                yield spans(out)
        if group:
            yield spans(resolve(group))

    def resolve(group: dict) -> list:
        for p in group.values():
            p.places = sorted(set(p.places))
            p.several |= len(p.places) > 1
        order = sorted(group.values(), key=lambda p: p.places[0])
        out = []
        for p, first, n in repeats(order):
            if first is None:
                out += [(x[1], x[2], x[3], x[4]) for x in p.places[1:]]
            else:
                x = p.places[0]
                out.append((x[1], x[2], x[3] + first, n))
        return list(joined(sorted(out)))

    def spans(out: list) -> pa.RecordBatch:
        cols = list(zip(*out)) or [()] * 4
        return pa.RecordBatch.from_arrays([pa.array(x, pa.int64()) for x in cols], ["dk", "th", "start", "n"])

    return rows.repartition("route").sortWithinPartitions("route").mapInArrow(run, "dk long, th long, start long, n long")


def spans_of(spans: DataFrame) -> DataFrame:
    """The spans of each document, as lists (no longer than it)."""
    return spans.groupBy("dk", "th").agg(F.collect_list(F.struct("start", "n")).alias("spans"))


def covered(length: int, size: int, spans: list | None) -> np.ndarray:
    """Which tokens of a document lie in a window of its spans."""
    edge = np.zeros(length + 1, np.int32)
    for s in spans or ():
        np.add.at(edge, [s["start"], min(length, s["start"] + s["n"] + size - 1)], [1, -1])
    return np.cumsum(edge[:-1]) > 0
