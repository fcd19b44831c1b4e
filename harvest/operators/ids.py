"""Identifier operators: A05 max id, A06 first free id, W04 / P11 id assignment.

Id scheme: dataset id = 3-digit category prefix + 4-digit sequence; row id =
dataset id + 7-digit sequence; file id = record prefix + "file" + n.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from harvest.functions.text import compose_id
from harvest.operators.joins import bounded_broadcast
from harvest.operators.numbering import consecutive_index, running
from harvest.session import checkpoint_dir

ROW_SEQ_WIDTH = 7
DATASET_SEQ_WIDTH = 4


def max_sequence(ids: DataFrame, id_col: str, group_by: Sequence[str] = (),
                 name: str = "max_seq") -> DataFrame:
    """Largest numeric id per group; non-numeric ids are ignored, 0 when none.

    One partial + final hash aggregate; ``try_cast`` skips non-numeric text.
    """
    seq = F.col(id_col).cast("string").try_cast("bigint")
    if group_by:
        return ids.groupBy(*group_by).agg(F.coalesce(F.max(seq), F.lit(0).cast("bigint")).alias(name))
    return ids.agg(F.coalesce(F.max(seq), F.lit(0).cast("bigint")).alias(name))


def first_free_sequence(seqs: DataFrame, seq_col: str, group_by: Sequence[str] = (),
                        name: str = "next_seq", groups: DataFrame | None = None) -> DataFrame:
    """Per group, the smallest s >= 1 not in use (length of the run 1..k, plus 1).

    Exact without any window: the candidates are 1 and every used s + 1; a
    candidate is free when an anti-join against the used set finds nothing;
    the answer is the smallest free candidate. Every join key (group, s) is
    unique, so no key is hot. ``groups`` (optional) lists groups that must
    appear even with no used sequence (answer 1).
    """
    g = list(group_by)
    used = (seqs.select(*g, F.col(seq_col).cast("bigint").alias("_s"))
            .where(F.col("_s") >= 1).distinct())
    base_groups = used.select(*g).distinct()
    if groups is not None:
        base_groups = base_groups.unionByName(groups.select(*g)).distinct()
    cands = (used.select(*g, (F.col("_s") + 1).alias("_c"))
             .unionByName(base_groups.select(*g, F.lit(1).cast("bigint").alias("_c"))))
    cond = [cands["_c"] == used["_s"]] + [cands[c].eqNullSafe(used[c]) for c in g]
    free = cands.join(used, cond, "left_anti")
    if g:
        return free.groupBy(*g).agg(F.min("_c").alias(name))
    return free.agg(F.coalesce(F.min("_c"), F.lit(1).cast("bigint")).alias(name))


def free_intervals(seqs: DataFrame, seq_col: str, group: str) -> DataFrame:
    """The unused numbers >= 1 of each group as intervals (``group``, lo, hi, ahead): hi is NULL for the last one, which has no
    end, and ahead is how many free numbers the group has before lo.

    A free interval begins at 1 or after a used number whose successor is free, and ends before a used number
    whose predecessor is free. Both kinds of edges come from anti-joins on unique keys; in their order each begin is followed by
    its end, and a running sum of ends less begins is the number of free numbers passed. Only the gaps are sorted, not
    the used numbers. The intervals can be stored: ``allocate`` returns what is left of them, so that later allocations
    need no used numbers."""
    used = seqs.select(group, F.col(seq_col).cast("bigint").alias("_s")).where(F.col("_s") >= 1).distinct()
    taken = used.select(F.col(group).alias("_g"), F.col("_s").alias("_t"))
    first = used.select(group).distinct().select(group, F.lit(1).cast("bigint").alias("_e"), F.lit(False).alias("_end"))
    edges = (used.select(group, F.explode(F.array(F.struct((F.col("_s") + 1).alias("_e"), F.lit(False).alias("_end")), F.struct((F.col("_s") - 1).alias("_e"), F.lit(True).alias("_end")))).alias("_x"))
             .select(group, "_x._e", "_x._end").where("_e >= 1").unionByName(first))
    edges = edges.join(taken, edges[group].eqNullSafe(taken["_g"]) & (edges["_e"] == taken["_t"]), "left_anti")
    passed = F.when(F.col("_end"), F.col("_e") + 1).otherwise(-F.col("_e"))
    scanned = running(edges, passed, ["_e", "_end"], [group], "_sum", how="sum", before="_ahead", following={"hi": "_e"})
    return scanned.where(~F.col("_end")).select(group, F.col("_e").alias("lo"), "hi", F.coalesce("_ahead", F.lit(0).cast("bigint")).alias("ahead"))


def allocate(free: DataFrame, requests: DataFrame, group: str, rank_col: str, name: str = "alloc") -> tuple[DataFrame, DataFrame]:
    """Give the request of rank r (1, 2, ... per group) the r-th free number, as issuing the requests one by one, each taking
    the first gap, would. Groups without intervals have all numbers free. Returns the requests with ``name``, and the intervals
    that are left.

    An interval serves the ranks from ``ahead`` + 1 on; those that are asked for, at most as many as there are requests,
    are listed and joined to the requests on (group, rank)."""
    zero = F.lit(0).cast("bigint")
    w = requests.groupBy(group).agg(F.max(F.col(rank_col).cast("bigint")).alias("_k")).alias("w")
    unknown = w.join(free.select(group).distinct().alias("f"), F.expr(f"w.`{group}` <=> f.`{group}`"), "left_anti").select(
        F.col(group), F.lit(1).cast("bigint").alias("lo"), F.lit(None).cast("bigint").alias("hi"), zero.alias("ahead"))
    f = free.select(group, "lo", "hi", "ahead").unionByName(unknown).alias("f")
    served = f.join(w, F.expr(f"f.`{group}` <=> w.`{group}`"), "left").select("f.*", F.coalesce("_k", zero).alias("_k"))
    upto = F.col("ahead") + F.col("hi") - F.col("lo") + 1               # NULL for the interval without an end
    left = served.where(F.col("hi").isNull() | (upto > F.col("_k"))).select(
        group, (F.col("lo") + F.greatest(F.col("_k") - F.col("ahead"), zero)).alias("lo"), "hi", F.greatest(F.col("ahead") - F.col("_k"), zero).alias("ahead"))
    top = F.least(upto, "_k")               # leaves NULL out
    ranks = served.where(F.col("ahead") < top).select(F.col(group).alias("_g"), F.explode(F.sequence(F.col("ahead") + 1, top)).alias("_at"), (F.col("lo") - F.col("ahead") - 1).alias("_shift"))
    got = requests.join(ranks, requests[group].eqNullSafe(ranks["_g"]) & (requests[rank_col].cast("bigint") == ranks["_at"]))
    return got.select(*[requests[c] for c in requests.columns], (F.col("_at") + F.col("_shift")).alias(name)), left


def next_dataset_ids(catalog: DataFrame, prefix_col: str = "prefix",
                     id_col: str = "dataset_id", prefixes: DataFrame | None = None) -> DataFrame:
    """A06 applied to catalog ids: per 3-digit prefix, the first free dataset id.

    Ids that do not start with the prefix, have under 7 digits, or are not all
    digits are ignored; the sequence is everything after the prefix.
    """
    ok = (F.col(id_col).rlike(r"^\d{7,}$") & F.col(id_col).startswith(F.col(prefix_col)))
    seqs = catalog.where(ok).select(prefix_col, F.substring(id_col, 4, 1 << 20).try_cast("bigint").alias("_seq"))
    free = first_free_sequence(seqs, "_seq", [prefix_col], "_next", groups=prefixes)
    return free.select(prefix_col, compose_id(F.col(prefix_col), F.col("_next"), DATASET_SEQ_WIDTH).alias("next_id"))


def assign_ids(df: DataFrame, order_by: Sequence, dataset_col: str | None = None,
               start: DataFrame | None = None, start_col: str = "max_seq",
               start_value: int = 0, seq_name: str = "seq", id_name: str = "row_id") -> DataFrame:
    """Sequential ids in input order, per dataset, continuing after a start.

    ``start`` (optional, needs ``dataset_col``) holds the current max sequence
    per dataset (A05) and is joined on the dataset column (one row per
    dataset). Without a dataset column ``start_value`` is the single offset.
    Row id = dataset id + sequence of 7 digits, or more from 10,000,000 on.
    """
    group = [dataset_col] if dataset_col else []
    numbered = consecutive_index(df, order_by, group, name="_pos")
    if start is not None and group:
        # one row per dataset: broadcast behind a size check, so a dataset with most rows is not one task
        checkpoint_dir(df.sparkSession)
        s = bounded_broadcast(start.select(*group, F.col(start_col).alias("_base")).checkpoint())
        numbered = numbered.join(s, group, "left")
    else:
        numbered = numbered.withColumn("_base", F.lit(int(start_value)).cast("bigint"))
    out = numbered.withColumn(seq_name, F.coalesce(F.col("_base"), F.lit(0)) + F.col("_pos"))
    if dataset_col:
        out = out.withColumn(id_name, compose_id(F.col(dataset_col), F.col(seq_name), ROW_SEQ_WIDTH))
    return out.drop("_pos", "_base")
