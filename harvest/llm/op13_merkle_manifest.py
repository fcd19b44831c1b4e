"""A Merkle manifest of a table, with a proof for each row. Nodes are labelled with nested intervals.

A row's leaf is the SHA-256 of its columns (``leaf_of``). The leaves of one source, in order of id, form a tree: runs
of ``fanout`` nodes become a parent until one node, the subroot, is left; the subroots, in order of source, form the
tree whose top is the root.

Every node carries the interval ``[lo, hi)`` of leaf ranks that it covers. At level L the intervals of one tree start at
multiples of ``fanout ** L``, so the parent of a node lies in the bucket ``lo div fanout ** (L + 1)``, and nodes meet their
parents in an equi-join on (tree, bucket) whose condition is that the parent's interval contains the node's. What the
parent's interval holds outside the node's own is the node's siblings: children that end before it on the left,
children that begin after it on the right. Paths are handed down level by level (each parent has ``fanout`` children
at most, so no key is hot, however large a source), and a leaf needs one join, with the parents of level 1.

Scale: texts are read once and leave as hashes; ranks come from a range sort in which a large source spans many tasks;
level L has ``fanout ** L`` times fewer rows than leaves; each level is cut, so lost executors repeat one level. The driver
sees the largest rank of a source, the number of sources and the root.

Defined cases: null columns hash as ``-``; null ids come first and are never tampered with, the null source is a source and
comes first; rows of one id are ordered by their leaf, repeated rows are leaves of their own; a tree of one leaf has that
leaf as its top; a proof without siblings is the hash of nothing; an empty table has no rows; other columns are ignored.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from harvest.llm._text import cut
from harvest.operators.numbering import consecutive_index

FIELDS = ("doc_id", "source", "lang", "n_chars", "text")
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def leaf_of(values: Sequence[Column]) -> Column:
    """The hash of the values in order, each with its length, so that no two rows are written alike."""
    text = [v.cast("string") for v in values]
    return F.sha2(F.concat(*[F.coalesce(F.concat(F.octet_length(t).cast("string"), F.lit(":"), t), F.lit("-")) for t in text]), 256)


def numbered_leaves(docs: DataFrame, fields: Sequence[str] = FIELDS, doc_id: str = "doc_id", source: str = "source", changed: str = "text") -> DataFrame:
    """doc_id, tree (the source), leaf, forged (the leaf after the tampering, else the leaf), lo and hi (rank of the leaf in its tree)."""
    crc = F.crc32(F.col(doc_id).cast("string").cast("binary"))
    lowered = [F.translate(F.col(c), UPPER, LOWER) if c == changed else F.col(c) for c in fields]
    leaves = docs.select(F.col(doc_id).alias("doc_id"), F.col(source).alias("tree"), leaf_of([F.col(c) for c in fields]).alias("leaf"),
                         F.when(crc % 5 == 0, leaf_of(lowered)).alias("forged"))
    ranked = consecutive_index(leaves, [F.col("doc_id").asc_nulls_first(), "leaf"], ["tree"], name="hi")
    return ranked.select("doc_id", "tree", "leaf", F.coalesce("forged", "leaf").alias("forged"), (F.col("hi") - 1).alias("lo"), "hi")


def levels_for(leaves: DataFrame, fanout: int) -> int:
    """How often runs must become parents until the largest tree has one node."""
    most = leaves.agg(F.max("hi").alias("n")).first()["n"] or 0
    levels = 0
    while fanout ** levels < most:
        levels += 1
    return levels


def bucket(width: int) -> Column:
    return F.expr(f"lo div {width}")


def grow(leaves: DataFrame, fanout: int) -> list[DataFrame]:
    """The nodes of the levels 1, 2, ... of all trees: tree, lo, hi, digest, kids (lo, hi, digest of each child, in order). The last
    level has one node for each tree. A tree that is down to one node passes it on as it is (a parent that starts the tree and has
    one child is the whole tree), so its path gets no step there."""
    nodes, out = leaves.select("tree", "lo", "hi", F.col("leaf").alias("digest")), []
    for level in range(1, levels_for(leaves, fanout) + 1):
        runs = nodes.groupBy("tree", bucket(fanout ** level).alias("at")).agg(F.array_sort(F.collect_list(F.struct("lo", "hi", "digest"))).alias("kids"))
        joined = F.sha2(F.concat_ws("", F.col("kids.digest")), 256)
        parents = runs.select("tree", F.col("kids")[0]["lo"].alias("lo"), F.element_at("kids", -1)["hi"].alias("hi"),
                              F.when((F.col("at") == 0) & (F.size("kids") == 1), F.col("kids")[0]["digest"]).otherwise(joined).alias("digest"), "kids")
        out.append(cut(parents))
        nodes = out[-1].select("tree", "lo", "hi", "digest")
    return out


def step(own: str, parent: str) -> Column:
    """What stands beside a node in its parent's interval, as an array of one struct; of none where the parent is the node passed on."""
    side = lambda keep: F.concat_ws("", F.transform(F.filter(f"{parent}.kids", keep), lambda k: k["digest"]))
    beside = F.struct(side(lambda k: k["hi"] <= F.col(f"{own}.lo")).alias("left"), side(lambda k: k["lo"] >= F.col(f"{own}.hi")).alias("right"))
    passed = (F.col(f"{parent}.lo") == 0) & (F.size(f"{parent}.kids") == 1)
    return F.when(passed, F.array().cast("array<struct<left:string,right:string>>")).otherwise(F.array(beside))


def contained(nodes: DataFrame, parents: DataFrame, width: int) -> DataFrame:
    """Each node (alias c) with the one parent (alias p) of the next level whose interval holds its own."""
    c, p = nodes.withColumn("bucket", bucket(width)).alias("c"), parents.withColumn("bucket", bucket(width)).alias("p")
    return c.join(p, F.expr("c.tree <=> p.tree AND c.bucket = p.bucket AND c.lo >= p.lo AND c.hi <= p.hi"))


def descend(leaves: DataFrame, levels: list[DataFrame], tops: DataFrame | str | None, fanout: int) -> DataFrame:
    """All columns of ``leaves`` with ``top`` (its tree's top node) and ``path`` (left and right siblings, from the leaf's level
    up to the root). ``tops`` has tree, top and path: the path of each tree's top node to the root. Where there is one tree, it is the root."""
    def with_tops(nodes: DataFrame) -> DataFrame:
        if not isinstance(tops, DataFrame):
            return nodes.select("*", F.lit(tops).cast("string").alias("top"), F.array().cast("array<struct<left:string,right:string>>").alias("path"))
        return nodes.alias("c").join(tops.alias("p"), F.expr("c.tree <=> p.tree")).select("c.*", "p.top", "p.path")

    if not levels:      # trees of one leaf
        return with_tops(leaves)
    above = with_tops(levels[-1]).drop("digest")
    for level in range(len(levels) - 1, 0, -1):
        below = contained(levels[level - 1], above, fanout ** (level + 1))
        above = below.select("c.tree", "c.lo", "c.hi", "c.kids", "p.top", F.concat(step("c", "p"), F.col("p.path")).alias("path"))
    return contained(leaves, above, fanout).select(*[f"c.{x}" for x in leaves.columns], "p.top", F.concat(step("c", "p"), F.col("p.path")).alias("path"))


def manifest(docs: DataFrame, fanout: int = 16, **columns) -> DataFrame:
    """doc_id, source, rank, leaf, forged, subroot, root and path (array of left and right siblings, leaf's level first) of each row."""
    leaves = numbered_leaves(docs, **columns)
    levels = grow(leaves, fanout)
    last = levels[-1].select("tree", F.col("digest").alias("top")) if levels else leaves.select("tree", F.col("leaf").alias("top"))
    ranked = consecutive_index(last, [F.col("tree").asc_nulls_first()], name="hi")
    subroots = ranked.select(F.lit(0).alias("tree"), F.col("tree").alias("source"), F.col("top").alias("leaf"), (F.col("hi") - 1).alias("lo"), "hi")
    over = grow(subroots, fanout)
    peak = (over[-1].select("digest") if over else subroots.select(F.col("leaf").alias("digest"))).first()
    root = peak["digest"] if peak else None
    paths = descend(subroots, over, root, fanout)
    tops = cut(paths.select(F.col("source").alias("tree"), F.col("leaf").alias("top"), "path"))
    found = descend(leaves, levels, tops, fanout)
    return found.select("doc_id", F.col("tree").alias("source"), F.col("lo").alias("rank"), "leaf", "forged", F.col("top").alias("subroot"), F.lit(root).alias("root"), "path")


def folded(leaf: Column, path: Column) -> Column:
    """The root that a leaf and its path give."""
    return F.aggregate(path, leaf, lambda node, s: F.sha2(F.concat(s["left"], node, s["right"]), 256))


def proof_hash(path: Column) -> Column:
    return F.sha2(F.concat_ws("", F.transform(path, lambda s: F.concat(s["left"], s["right"]))), 256)


def digest(found: DataFrame) -> DataFrame:
    """Each row's proof, and whether the row, tampered with where its id says so, still folds to the root."""
    out = found.select("doc_id", "leaf", "subroot", "root", proof_hash(F.col("path")).alias("proof_sha256"), folded(F.col("forged"), F.col("path")).alias("folded_root"))
    return out.withColumn("verified", F.col("folded_root") == F.col("root"))


def oracle(fanout: int = 16, levels: int = 6, over: int = 4) -> str:
    """The same result in DuckDB SQL, for up to fanout ** levels rows of a source and fanout ** over sources."""
    crc = ("xor(list_reduce([4294967295::BIGINT] || list_transform(range(length(doc_id::VARCHAR)), lambda i: ascii(substr(doc_id::VARCHAR, (i + 1)::INT, 1))::BIGINT), "
           "lambda a, b: list_reduce([xor(a, b)] || range(8), lambda x, j: CASE WHEN x & 1 = 1 THEN xor(x >> 1, 3988292384::BIGINT) ELSE x >> 1 END)), 4294967295::BIGINT)")
    field = lambda e: f"coalesce(strlen(({e})::VARCHAR) || ':' || ({e})::VARCHAR, '-')"
    row = lambda text: "sha256(" + " || ".join(field(text if c == "text" else c) for c in FIELDS) + ")"
    parts = [f"""h AS (SELECT doc_id, source, {row('text')} AS leaf,
        CASE WHEN {crc} % 5 = 0 THEN {row(f"translate(text, '{UPPER}', '{LOWER}')")} END AS forged FROM documents),
      leaves AS (SELECT doc_id, source, leaf, coalesce(forged, leaf) AS forged, row_number() OVER (PARTITION BY source ORDER BY doc_id NULLS FIRST, leaf) - 1 AS k FROM h),
      a0 AS (SELECT source AS tree, k, leaf AS d FROM leaves)"""]

    def trees(name: str, n: int) -> None:
        for i in range(1, n + 1):
            parts.append(f"""{name}{i} AS (SELECT tree, k // {fanout} AS k,
              CASE WHEN count(*) = 1 AND min(k) = 0 THEN min(d) ELSE sha256(string_agg(d, '' ORDER BY k)) END AS d FROM {name}{i - 1} GROUP BY tree, k // {fanout})""")
        for i in range(n):
            parts.append(f"""{name}s{i} AS (SELECT x.tree, x.k, coalesce(string_agg(y.d, '' ORDER BY y.k) FILTER (y.k < x.k), '') AS l,
              coalesce(string_agg(y.d, '' ORDER BY y.k) FILTER (y.k > x.k), '') AS r, count(*) = 1 AND x.k = 0 AS alone
              FROM {name}{i} x JOIN {name}{i} y ON x.tree IS NOT DISTINCT FROM y.tree AND x.k // {fanout} = y.k // {fanout} GROUP BY x.tree, x.k)""")

    def climb(name: str, n: int, first: str) -> str:
        for i in range(n):
            parts.append(f"""{name}p{i} AS (SELECT f.* REPLACE (CASE WHEN s.alone THEN f.fold ELSE sha256(s.l || f.fold || s.r) END AS fold, f.proof || s.l || s.r AS proof)
              FROM {first} f JOIN {name}s{i} s ON f.tree IS NOT DISTINCT FROM s.tree AND f.k // {fanout ** i} = s.k)""")
            first = f"{name}p{i}"
        return first

    trees("a", levels)
    parts.append("b0 AS (SELECT 0 AS tree, row_number() OVER (ORDER BY tree NULLS FIRST) - 1 AS k, d, tree AS source FROM a%d)" % levels)
    trees("b", over)
    parts.append("start AS (SELECT doc_id, source AS tree, k, leaf, forged AS fold, '' AS proof FROM leaves)")
    last = climb("a", levels, "start")
    parts.append(f"mid AS (SELECT f.doc_id, 0 AS tree, b.k, f.leaf, f.fold, f.proof, b.d AS subroot FROM {last} f JOIN b0 b ON f.tree IS NOT DISTINCT FROM b.source)")
    last = climb("b", over, "mid")
    return f"""WITH {", ".join(parts)}
      SELECT f.doc_id, f.leaf, f.subroot, t.d AS root, sha256(f.proof) AS proof_sha256, f.fold AS folded_root, f.fold = t.d AS verified FROM {last} f JOIN b{over} t ON t.tree = 0"""
