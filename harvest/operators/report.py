"""Reports: W05 numbered pages, R01 record profile, A08 load counters."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Observation
from pyspark.sql import functions as F

from harvest.operators.numbering import consecutive_index

AUDIT_COLUMNS = ("created_at", "last_updated_at")


def page_size_for(total: int) -> int:
    """Whole listing when <= 25 rows, 20 per page up to 100, else 50."""
    if total <= 25:
        return max(total, 1)
    return 20 if total <= 100 else 50


def numbered_pages(df: DataFrame, order_by: Sequence, total: int | None = None) -> DataFrame:
    """1-based display number in ``order_by`` order and the page it falls on.
    The page size depends on the row count (one count, a single number)."""
    n = df.count() if total is None else total
    size = page_size_for(n)
    out = consecutive_index(df, order_by, name="display_no")
    return out.withColumn("page_no", (F.floor((F.col("display_no") - 1) / size) + 1).cast("bigint"))


def record_profile(df: DataFrame, id_col: str, id_name: str | None = None,
                   drop: Sequence[str] = AUDIT_COLUMNS) -> DataFrame:
    """(id, field, value) rows -- every column as text, audit columns dropped."""
    values = [c for c in df.columns if c != id_col and c not in set(drop)]
    cast = df.select(id_col, *[F.col(c).cast("string").alias(c) for c in values])
    out = cast.unpivot([id_col], values, "field", "value")
    return out.withColumnRenamed(id_col, id_name) if id_name else out


def observe_counts(df: DataFrame, name: str) -> tuple[DataFrame, Observation]:
    """Count rows as a side effect of the action that writes ``df`` (no extra pass)."""
    obs = Observation(name)
    return df.observe(obs, F.count(F.lit(1)).alias("rows")), obs


def load_counters(rows: DataFrame, incoming: Column, stored: Column, keys: Sequence[str]) -> DataFrame:
    """Downloaded / unique / new / total counts of a load, in one pass over rows flagged as incoming, as stored, or
    as both: counted by distinct row, then by key, then in all, so that a frequent row or key is one row after the
    map-side aggregate. Null keys are equal, as in ``new_rows``."""
    by_row = rows.groupBy(*rows.columns).agg(F.count(F.lit(1)).alias("_n"))
    n = F.col("_n")
    by_key = by_row.groupBy(*keys).agg(F.sum(F.when(incoming, n).otherwise(0)).alias("_in"), F.count_if(incoming).alias("_unique"),
                                       F.sum(F.when(stored, n).otherwise(0)).alias("_stored"))
    new = F.when(F.col("_stored") == 0, F.col("_in")).otherwise(0)
    total = lambda c: F.coalesce(F.sum(c), F.lit(0)).cast("bigint")
    return by_key.agg(total("_in").alias("downloaded"), total("_unique").alias("unique_rows"),
                      total(new).alias("new_rows"), total(F.col("_stored") + new).alias("total_rows"))
