"""Joins that Spark has no single operator for: substring ("contains") joins
without a nested loop, null-safe joins on key lists, size-checked broadcasts.

``contains_join(hay, hay_col, needles, needle_col)`` returns every pair whose
needle is a substring of the hay value. A handful of needles (checked, at most
``LITERAL_NEEDLES``) is looked for in one projection over the hay. More go
through an inverted index of character q-grams: the distinct hay values are
expanded into their distinct grams (as many rows as a value has characters,
however many needle lengths there are); each needle is looked up by the one of
its grams that the fewest values hold, and the candidates are verified with
``contains``. Needles shorter than a gram are looked up whole, among grams of
their length. Every step is an equi-join or an aggregate in the JVM.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

LITERAL_NEEDLES = 64
GRAM = 3
BROADCAST_MAX_BYTES = 64 << 20


def is_small(df: DataFrame, max_rows: int) -> bool:
    """Whether ``df`` has at most ``max_rows`` rows that take at most ``BROADCAST_MAX_BYTES``
    as JSON text (one aggregate over no more rows than that; only two numbers reach the driver)."""
    size = F.sum(F.octet_length(F.to_json(F.struct(*[F.col(f"`{c}`") for c in df.columns]))))
    rows, size = df.limit(max_rows + 1).agg(F.count(F.lit(1)), size).first()
    return rows <= max_rows and (size or 0) <= BROADCAST_MAX_BYTES


def same_keys(keys: Sequence[str], left: str, right: str) -> Column:
    """Equality of all keys of two aliased frames, NULL equal to NULL; still a hash or sort-merge join."""
    return F.expr(" AND ".join(f"{left}.`{k}` <=> {right}.`{k}`" for k in keys))


def _grams(text: Column, size: int) -> Column:
    """The distinct substrings of ``size`` characters."""
    n = F.length(text)
    # one-argument lambda: a second parameter would be read as the element index
    starts = F.transform(F.sequence(F.lit(1), n - size + 1), lambda p: F.substring(text, p, size))
    return F.array_distinct(F.when(n >= size, starts).otherwise(F.array().cast("array<string>")))


def _matches(values: DataFrame, needles: DataFrame, short: Sequence[int], size: int) -> DataFrame:
    """(_value, _needle) of each distinct value and each distinct needle that it contains."""
    texts = F.col("_value")
    postings = values.select("_value", F.explode(F.concat(*[_grams(texts, k) for k in (*short, size)])).alias("_gram"))
    held_by = postings.where(F.length("_gram") == size).groupBy("_gram").agg(F.count(F.lit(1)).alias("_n"))
    long = needles.where(F.length("_needle") >= size)
    # A needle with a gram that no value holds has no match; any other is looked up by its rarest gram.
    grams = long.select("_needle", F.explode(_grams(F.col("_needle"), size)).alias("_gram")).join(held_by, "_gram", "left")
    rarest = (grams.groupBy("_needle").agg(F.min(F.coalesce("_n", F.lit(0))).alias("_least"), F.min_by("_gram", F.struct("_n", "_gram")).alias("_gram"))
              .where("_least > 0").select("_needle", "_gram"))
    lookups = rarest.unionByName(needles.where(F.length("_needle") < size).select("_needle", F.col("_needle").alias("_gram")))
    return postings.join(lookups, "_gram").where(F.contains("_value", F.col("_needle"))).select("_value", "_needle")


def contains_join(hay: DataFrame, hay_col: str, needles: DataFrame, needle_col: str,
                  literal_needles: int | None = None, size: int = GRAM) -> DataFrame:
    """Inner join of ``hay`` and ``needles`` on ``contains(hay_col, needle_col)``, all columns of both.
    Needles must be non-empty strings (an empty needle is in every value)."""
    most = LITERAL_NEEDLES if literal_needles is None else literal_needles
    nd = needles.where(F.col(needle_col).isNotNull() & (F.length(needle_col) > 0))
    distinct = nd.select(F.col(needle_col).alias("_needle")).distinct()
    few = [r[0] for r in distinct.limit(most + 1).collect()] if most else None
    if few is not None and len(few) <= most:
        listed = F.array(*[F.lit(x) for x in sorted(few)]).cast("array<string>")
        found = hay.withColumn("_needle", F.explode(F.filter(listed, lambda x: F.contains(F.col(hay_col), x))))
        return found.join(nd, found["_needle"] == nd[needle_col]).drop("_needle")
    short = [r[0] for r in distinct.select(F.length("_needle").alias("n")).where(F.col("n") < size).distinct().collect()]
    pairs = _matches(hay.select(F.col(hay_col).alias("_value")).where("_value IS NOT NULL").distinct(), distinct, sorted(short), size)
    found = hay.join(pairs, hay[hay_col] == F.col("_value"))
    return found.join(nd, found["_needle"] == nd[needle_col]).drop("_value", "_needle")


EQUI_BROADCAST_MAX_ROWS = 100_000   # config / category rows are a few small fields each


def bounded_broadcast(df: DataFrame, max_rows: int | None = None) -> DataFrame:
    """Mark ``df`` for broadcast (into an equi-join) only after checking its rows
    and bytes; beyond the bound the join strategy is left to the optimizer (AQE
    picks a shuffled join)."""
    bound = EQUI_BROADCAST_MAX_ROWS if max_rows is None else max_rows
    return F.broadcast(df) if is_small(df, bound) else df
