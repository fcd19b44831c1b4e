"""Gap-free, skew-safe row numbering (used by W04 ids, O01 positions, W05).

``row_number() OVER (PARTITION BY g ORDER BY o)`` sends a whole group to one
task; without ``PARTITION BY`` it sends the whole table to one task. Instead:

1. range-partition and sort by (group, order) -- a hot group is split across
   many partitions because the order columns take part in the range bounds;
2. tag rows with ``monotonically_increasing_id`` (partition id in the upper
   31 bits, row index within the partition in the lower 33 bits) and cut the
   lineage with a reliable ``checkpoint()`` into ``spark.checkpoint.dir``
   (compressed, see session defaults); the tags are stored with the rows, so
   the numbering never depends on recomputation;
3. count rows per (partition, group) -- at most partitions + groups rows --
   and turn the counts into per-group prefix sums, which are cut from their
   lineage and broadcast behind a size check, so the numbered rows are not
   shuffled again;
4. position = prefix offset + (row index - first row index of the group in
   that partition) + 1.

``running`` is the same scan with a maximum or a sum in place of the count:
the value up to each row inside its part of the group, joined with that of all
parts before it.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from harvest.operators.joins import bounded_broadcast
from harvest.session import checkpoint_dir

def _cols(cs) -> list[Column]:
    return [F.col(c) if isinstance(c, str) else c for c in cs]


def _parts(df: DataFrame, order_by: Sequence, group_by: Sequence[str]) -> DataFrame:
    """``df`` in (group, order) order over all partitions, cut, with ``_mid`` (position) and ``_pid`` (partition)."""
    checkpoint_dir(df.sparkSession)
    tagged = df.orderBy(*[F.col(g).asc_nulls_first() for g in group_by], *_cols(order_by)).withColumn("_mid", F.monotonically_increasing_id())
    return tagged.checkpoint(eager=True).withColumn("_pid", F.shiftright(F.col("_mid"), 33))


def consecutive_index(df: DataFrame, order_by: Sequence, group_by: Sequence[str] = (),
                      name: str = "seq") -> DataFrame:
    """Add ``name`` = 1-based position of each row within its group, in ``order_by`` order.

    ``order_by`` should make rows unique within a group (add the input ordinal
    as the last key) so that the numbering is deterministic.
    """
    group_by = list(group_by)
    tagged = _parts(df, order_by, group_by)
    stats = (tagged.groupBy("_pid", *group_by)
             .agg(F.count(F.lit(1)).alias("_n"), F.min("_mid").alias("_first")))
    w = Window.partitionBy(*group_by).orderBy("_pid").rowsBetween(Window.unboundedPreceding, -1)
    # stats has one row per (partition, group) run: bounded by partitions + groups.
    stats = stats.withColumn("_off", F.coalesce(F.sum("_n").over(w), F.lit(0)))
    # Fresh names on the stats side keep the self-join conditions unambiguous.
    stats = stats.select(F.col("_pid").alias("_spid"), *[F.col(g).alias(f"_sg{i}") for i, g in enumerate(group_by)],
                         (F.col("_off") - F.col("_first") + 1).alias("_shift"))
    stats = bounded_broadcast(stats.checkpoint(eager=True))
    cond = [tagged["_pid"] == stats["_spid"]] + [tagged[g].eqNullSafe(stats[f"_sg{i}"]) for i, g in enumerate(group_by)]
    out = tagged.join(stats, cond, "inner").select(
        tagged["*"], (stats["_shift"] + tagged["_mid"]).alias(name))
    return out.drop("_mid", "_pid")


def running(df: DataFrame, value: Column, order_by: Sequence, group_by: Sequence[str], name: str, how: str = "max",
            before: str | None = None, following: dict[str, str] | None = None) -> DataFrame:
    """Add ``name``: the maximum (or ``how="sum"``) of ``value`` over the rows of the group up to each row in ``order_by`` order,
    NULL values left out; ``before``: the same without the row itself, NULL for the first; ``following``: new column -> column
    whose value in the next row of the group it takes. A prefix scan: windows run inside one partition's part of a
    group, and over one row for each part."""
    group_by, following = list(group_by), following or {}
    over = F.max if how == "max" else F.sum
    tagged = _parts(df.withColumn("_v", value), order_by, group_by)
    part = Window.partitionBy("_pid", *group_by).orderBy("_mid")
    parts = tagged.groupBy("_pid", *group_by).agg(over("_v").alias("_t"), *[F.min_by(c, "_mid").alias(f"_n{i}") for i, c in enumerate(following.values())])
    whole = Window.partitionBy(*group_by).orderBy("_pid")
    parts = parts.select(F.col("_pid").alias("_spid"), *[F.col(g).alias(f"_sg{i}") for i, g in enumerate(group_by)],
                         over("_t").over(whole.rowsBetween(Window.unboundedPreceding, -1)).alias("_c"),
                         *[F.lead(f"_n{i}").over(whole).alias(f"_f{i}") for i in range(len(following))])
    parts = bounded_broadcast(parts.checkpoint(eager=True))
    local = tagged.select("*", over("_v").over(part.rowsBetween(Window.unboundedPreceding, 0)).alias("_l"), over("_v").over(part.rowsBetween(Window.unboundedPreceding, -1)).alias("_b"),
                          F.lead("_mid").over(part).alias("_m"), *[F.lead(c).over(part).alias(f"_x{i}") for i, c in enumerate(following.values())])
    cond = [local["_pid"] == parts["_spid"]] + [local[g].eqNullSafe(parts[f"_sg{i}"]) for i, g in enumerate(group_by)]
    joined = local.join(parts, cond)

    def total(inside: str) -> Column:
        if how == "max":
            return F.greatest(inside, "_c")        # leaves NULLs out
        return F.when(F.col(inside).isNotNull() | F.col("_c").isNotNull(), F.coalesce(inside, F.lit(0)) + F.coalesce("_c", F.lit(0)))

    return joined.select(*[F.col(c) for c in df.columns], total("_l").alias(name), *([total("_b").alias(before)] if before else []),
                         *[F.when(F.col("_m").isNotNull(), F.col(f"_x{i}")).otherwise(F.col(f"_f{i}")).alias(c) for i, c in enumerate(following)])
