"""SimHash near-dedup with BK-trees.

1. Each document's fingerprint: bit i is 1 if it is set in over half the 64-bit hashes (XXH64, seed 42) of the
   document's word shingles, repeats included.
2. Documents with one fingerprint are a class. Two fingerprints within ``radius`` bits agree in one of
   ``radius`` + 1 parts of their bits, so each class goes into that many shards: one for each (part, value).
   All links stand inside shards.
3. A shard's fingerprints form a BK-tree: the children of a node are keyed by their integer Hamming distance
   to it, and a search follows only edges within the radius of the distance to the node. A large shard is split
   into trees of at most about ``tree`` fingerprints, and its members query each of its trees in slices, so
   that no task gets a whole large shard. Trees and query slices of a task are built and searched together,
   level by level, in arrays: trees never go through the driver and none is sent to a task that does not
   query it, which a broadcast of all trees would do.
4. A task links what its searches find, and emits for each tree and query slice a star per linked group (not
   all pairs). Connected components of the stars are found by alternating large-star and small-star steps.

Defined cases: null and empty texts have no words and fingerprint zero, linked like any other; a null doc_id
takes part, but the smallest id of a component is the smallest that is not null (null if none); rows with one
id are rows like others. Columns other than id and text are not read.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from harvest.llm._text import U64, WORD, cut, pieces

#: Queries that a tree gets in one task, as a multiple of its size.
SLICE = 64

#: A-Z to a-z and nothing else.
LOWER = {c: c + 32 for c in range(ord("A"), ord("Z") + 1)}


def fingerprint(text: str | None, shingle: int = 3, seed: int = 42) -> int:
    words = WORD.findall(text.translate(LOWER)) if text else []
    if not words:
        return 0
    data = " ".join(words).encode("utf-8", "surrogatepass")
    lengths = np.fromiter((len(w) for w in data.split(b" ")), np.int64, len(words))
    ends = np.cumsum(lengths + 1) - 1
    starts = ends - lengths
    k = min(shingle, len(words))
    n = len(words) - k + 1
    view, digest = memoryview(data), xxhash.xxh64_intdigest
    hashes = np.fromiter((digest(view[a:b], seed) for a, b in zip(starts[:n].tolist(), ends[k - 1:].tolist())), np.uint64, n)
    ones = np.zeros(64, np.int64)
    for i in range(0, n, 1 << 15):
        bits = np.unpackbits(hashes[i:i + (1 << 15)].astype("<u8").view(np.uint8).reshape(-1, 8), axis=1, bitorder="little")
        ones += bits.sum(axis=0, dtype=np.int32)
    return int(np.packbits(2 * ones > n, bitorder="little").view("<u8")[0])


def fingerprints(docs: DataFrame, shingle: int = 3, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """id, th (a hash of the text) and fp (the fingerprint as a signed long), a row for each row of ``docs``."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in pieces(batches):
            fps = np.array([fingerprint(t, shingle) for t in b.column("text").to_pylist()], np.uint64)
            yield pa.RecordBatch.from_arrays([b.column("id"), b.column("th"), pa.array(fps.view(np.int64))], ["id", "th", "fp"])

    return (docs.select(F.col(doc_id).cast("long").alias("id"), text_hash(text).alias("th"), F.col(text).cast("string").alias("text"))
            .mapInArrow(run, "id long, th long, fp long"))


def text_hash(text: str) -> Column:
    return F.xxhash64(F.coalesce(F.col(text).cast("string"), F.lit("")))


def distance(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    return np.bitwise_count(a ^ b).astype(np.int64)


class Forest:
    """BK-trees over the rows of ``fp``; rows with the same ``tree`` (rising) are in one tree."""

    def __init__(self, fp: np.ndarray, tree: np.ndarray) -> None:
        self.fp = fp
        first = np.flatnonzero(np.concatenate(([True], tree[1:] != tree[:-1])))
        self.root_of = dict(zip(tree[first].tolist(), first.tolist()))
        at = np.repeat(first, np.diff(np.append(first, len(fp))))     # the node that each row has come to
        rows = np.setdiff1d(np.arange(len(fp)), first)
        parents, keys, children = [], [], []
        while len(rows):
            key = at[rows] * 65 + distance(fp[rows], fp[at[rows]])
            edge, child, which = np.unique(key, return_index=True, return_inverse=True)
            child = rows[child]                                         # the first row of an edge becomes its node
            parents.append(edge // 65)
            keys.append(edge % 65)
            children.append(child)
            at[rows] = child[which]
            rows = rows[rows != child[which]]
        parent = np.concatenate(parents) if parents else np.empty(0, np.int64)
        edge = parent * 65 + (np.concatenate(keys) if keys else np.empty(0, np.int64))
        order = np.argsort(edge)
        self.edge, self.child = edge[order], np.concatenate(children)[order] if children else np.empty(0, np.int64)

    def search(self, fp: np.ndarray, root: np.ndarray, radius: int) -> Iterator[tuple[np.ndarray, np.ndarray]]:
        """(query, row) within the radius, level by level."""
        query, node = np.arange(len(fp)), root
        while len(query):
            d = distance(fp[query], self.fp[node])
            near = d <= radius
            yield query[near], node[near]
            low = np.searchsorted(self.edge, node * 65 + np.maximum(d - radius, 0))
            n = np.searchsorted(self.edge, node * 65 + np.minimum(d + radius, 64), "right") - low
            query = np.repeat(query, n)
            node = self.child[np.repeat(low - np.cumsum(n) + n, n) + np.arange(len(query))]


def link(label: np.ndarray, a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Join the groups of a[i] and b[i]; a label is the least member of its group."""
    while True:
        la, lb = label[a], label[b]
        apart = la != lb
        if not apart.any():
            return label
        a, b, la, lb = a[apart], b[apart], la[apart], lb[apart]
        np.minimum.at(label, np.maximum(la, lb), np.minimum(la, lb))
        while not np.array_equal(label, label[label]):
            label = label[label]


def stars(shards: DataFrame, radius: int, room: int = 1 << 18, block: int = 1 << 12) -> DataFrame:
    """a, b: a star for each group that a tree and its queries link. Rows: shard, tree, fp, member (of the tree,
    or only a query), dealt by (shard, tree)."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tail = None
        for b in batches:
            cols = [b.column(n).to_numpy(zero_copy_only=False) for n in ("tree", "fp", "member")]
            if tail is not None:
                cols = [np.concatenate(x) for x in zip(tail, cols)]
            whole = np.searchsorted(cols[0], cols[0][-1]) if len(cols[0]) > room else 0
            yield from solve(*(x[:whole] for x in cols))
            tail = [x[whole:] for x in cols]
        if tail is not None:
            yield from solve(*tail)

    def solve(tree: np.ndarray, fp: np.ndarray, member: np.ndarray) -> Iterator[pa.RecordBatch]:
        if not len(tree):
            return
        rows = np.flatnonzero(member)
        bits = fp.view(np.uint64)
        forest = Forest(bits[rows], tree[rows])
        root = np.array([forest.root_of.get(t, -1) for t in tree.tolist()])
        asked = np.flatnonzero(root >= 0)
        label = np.arange(len(fp))
        for i in range(0, len(asked), block):
            q = asked[i:i + block]
            for query, node in forest.search(bits[q], root[q], radius):
                label = link(label, q[query], rows[node])
        linked = np.flatnonzero(label != np.arange(len(fp)))
        yield pa.RecordBatch.from_arrays([pa.array(fp[linked]), pa.array(fp[label[linked]])], ["a", "b"])

    return shards.repartition("tree").sortWithinPartitions("tree").mapInArrow(run, "a long, b long").where("a <> b")


def shards(classes: DataFrame, radius: int, tree: int) -> DataFrame:
    """tree, fp, member: the rows of each tree and of those that query it. Shards of one class have no links."""
    parts, width = radius + 1, -(-64 // (radius + 1))
    at = F.explode(F.sequence(F.lit(0), F.lit(parts - 1))).alias("part")
    rows = classes.select("fp", at).select(
        "fp", F.xxhash64("part", F.expr(f"shiftrightunsigned(fp, part * {width}) & {(1 << width) - 1}L")).alias("shard"))
    sizes = rows.groupBy("shard").agg(F.count(F.lit(1)).alias("n")).where("n > 1")
    # the trees of a shard: a member is queried against its own tree and all after it. A tree with many queries is
    # sent to several slices of them
    trees, slices = F.ceil(F.col("n") / tree).cast("int"), F.ceil(F.col("n") / (SLICE * tree)).cast("int")
    rows = rows.join(sizes, "shard").select("fp", "shard", trees.alias("trees"), slices.alias("slices"),
                                            F.pmod(F.xxhash64("fp", F.lit(7)), trees).cast("int").alias("own"))
    rows = rows.select("fp", "shard", "own", "slices", F.explode(F.expr("sequence(own, trees - 1)")).alias("no"))
    rows = rows.select("fp", "shard", "no", (F.col("no") == F.col("own")).alias("member"), F.explode(F.expr(
        "if(no = own, sequence(0, slices - 1), array(cast(pmod(xxhash64(fp, 11), slices) as int)))")).alias("slice"))
    return rows.select(F.xxhash64("shard", "no", "slice").alias("tree"), "fp", "member")


def components(edges: DataFrame) -> DataFrame:
    """node, root: the least node that each node of the edges (a, b) reaches."""
    edges = cut(edges.select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v")).where("u <> v").distinct())
    while True:
        # large star: each node hands its larger neighbours to its least one
        both = edges.union(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
        least = both.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m"))
        large = both.where("v > u").join(least, "u").select(F.col("v").alias("u"), F.col("m").alias("v")).where("u <> v").distinct()
        # small star: each node hands its smaller neighbours and itself to its least one
        least = large.groupBy("u").agg(F.min("v").alias("m"))
        small = (large.join(least, "u").select(F.col("v").alias("u"), F.col("m").alias("v"))
                 .union(least.select("u", F.col("m").alias("v"))).where("u <> v").distinct())
        new = cut(small)
        # finished when every node hangs on a root: no edge goes on from a v
        if new.select(F.col("v").alias("u")).join(new, "u", "left_semi").isEmpty() and \
                new.groupBy("u").agg(F.count(F.lit(1)).alias("n")).where("n > 1").isEmpty():
            return new.select(F.col("u").alias("node"), F.col("v").alias("root")).union(
                new.select(F.col("v").alias("node"), F.col("v").alias("root")).distinct())
        edges = new


def simhash_dedup(docs: DataFrame, shingle: int = 3, radius: int = 2, tree: int = 4096,
                  doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """id, th, fp, root (the least fingerprint of the component) and component_id: a row for each row of ``docs``."""
    rows = cut(fingerprints(docs, shingle, doc_id, text))
    classes = rows.groupBy("fp").agg(F.min("id").alias("least"))
    roots = components(stars(shards(classes.select("fp"), radius, tree), radius))
    named = classes.join(roots, classes.fp == roots.node, "left").select("fp", "least", F.coalesce("root", "fp").alias("root"))
    named = cut(named)
    least = named.groupBy("root").agg(F.min("least").alias("component_id"))
    named = named.join(least, "root").select("fp", "root", "component_id")
    return rows.join(named, "fp").select("id", "th", "fp", "root", "component_id")


def one_of_each(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", **options) -> DataFrame:
    """The rows of ``docs`` that stay if one document of each component does: that of the least id (nulls last), of
    documents with this id the one with the least text hash, and of copies of its row one."""
    found = simhash_dedup(docs, doc_id=doc_id, text=text, **options)
    first = found.groupBy("root").agg(F.min(F.struct(F.col("id").isNull().alias("none"), "id", "th")).alias("k"))
    keep = first.select(F.col("k.id").alias("kid"), F.col("k.th").alias("kth")).distinct()
    rows = docs.select(F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("row"), F.col(doc_id).cast("long").alias("id"), text_hash(text).alias("th"))
    kept = rows.join(keep, (F.col("th") == F.col("kth")) & F.col("id").eqNullSafe(F.col("kid")), "left_semi")
    return kept.dropDuplicates(["id", "th"]).select("row.*")


def digest(found: DataFrame) -> DataFrame:
    return found.select(F.col("id").alias("doc_id"), F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), "component_id")
