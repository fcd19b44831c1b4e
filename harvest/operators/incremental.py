"""Incremental load: J01 new rows, J02 matched ids, J10/U03/P13 whole-row
difference, U01 batch combination.

Keys are compared as text (``cast(... AS STRING)`` on both sides, before the
join, so they stay equi-join keys) with NULL equal to NULL (``<=>``). Catalyst
turns each ``<=>`` into hash keys, so the plan is a broadcast-hash join when
the stored key set is small (decided at runtime by AQE against the broadcast
threshold) and a sort-merge / shuffled-hash join otherwise.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from harvest.functions.text import key_text


# Types whose native equality equals equality of their text form.
_EXACT_TYPES = ("string", "bigint", "int", "smallint", "tinyint", "boolean", "date", "timestamp", "timestamp_ntz")


def _as_key(df_types: dict, other_types: dict, k: str):
    """The key as compared: native when both sides have the same exact type,
    else its text form (the original compares text)."""
    t = df_types.get(k)
    if t == other_types.get(k) and (t in _EXACT_TYPES or (t or "").startswith("decimal")):
        return F.col(k)
    return key_text(F.col(k))


def _key_frame(df: DataFrame, other: DataFrame, keys: Sequence[str], prefix: str, extra: Sequence = ()) -> DataFrame:
    mine, theirs = dict(df.dtypes), dict(other.dtypes)
    return df.select(*[_as_key(mine, theirs, k).alias(f"{prefix}{i}") for i, k in enumerate(keys)], *extra)


def new_rows(incoming: DataFrame, store: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Incoming rows whose key tuple (compared as text) is absent from the store.

    Duplicates inside the incoming batch are all kept. The stored side is
    reduced to its distinct key tuples first (partial aggregation), so a key
    repeated many times in the store costs one row in the join. Keys of the
    same exact type on both sides are compared natively (same result as text,
    cheaper hashing and smaller shuffle rows).
    """
    keys = list(keys)
    skeys = _key_frame(store, incoming, keys, "_s").distinct()
    mine, theirs = dict(incoming.dtypes), dict(store.dtypes)
    inc = incoming.select("*", *[_as_key(mine, theirs, k).alias(f"_i{i}") for i, k in enumerate(keys)])
    cond = [inc[f"_i{i}"].eqNullSafe(skeys[f"_s{i}"]) for i in range(len(keys))]
    return inc.join(skeys, cond, "left_anti").select(*incoming.columns)


def matched_ids(incoming: DataFrame, store: DataFrame, keys: Sequence[str], id_col: str,
                ord_col: str, incoming_id: str) -> DataFrame:
    """For each incoming row whose key is stored, the stored id (the last
    stored duplicate of the key wins, by ``ord_col``)."""
    keys = list(keys)
    last = (_key_frame(store, incoming, keys, "_s", [F.col(id_col).alias("_id"), F.col(ord_col).alias("_o")])
            .groupBy(*[f"_s{i}" for i in range(len(keys))])
            .agg(F.max_by("_id", "_o").alias(id_col)))
    inc = _key_frame(incoming, store, keys, "_i", [F.col(incoming_id)])
    cond = [inc[f"_i{i}"].eqNullSafe(last[f"_s{i}"]) for i in range(len(keys))]
    return inc.join(last, cond, "inner").select(inc[incoming_id], last[id_col])


def shared_columns(new: DataFrame, existing: DataFrame) -> list[str]:
    """The new batch's columns that the existing rows also have (new order)."""
    have = set(existing.columns)
    return [c for c in new.columns if c in have]


def rows_not_in(new: DataFrame, existing: DataFrame) -> DataFrame:
    """New rows whose values on the shared columns match no existing
    row (NULL equals NULL). A left-anti join, not EXCEPT: duplicates inside the
    new batch are kept."""
    cols = shared_columns(new, existing)
    ex = existing.select(*[F.col(c).alias(f"_e_{c}") for c in cols]).distinct()
    cond = [new[c].eqNullSafe(ex[f"_e_{c}"]) for c in cols]
    return new.join(ex, cond, "left_anti")


def combine_batches(existing: DataFrame, new: DataFrame) -> DataFrame:
    """Existing + truly new rows when both have the same column set, else
    the truly new rows only. Column sets are schema facts, compared on the
    driver; the rows never leave the executors."""
    fresh = rows_not_in(new, existing)
    if set(existing.columns) == set(new.columns):
        return existing.unionByName(fresh)
    return fresh


def incremental_load(incoming: DataFrame, store: DataFrame, keys: Sequence[str],
                     cutoff=None, date_col: str | None = None) -> DataFrame:
    """J01 with the date filter: the incoming batch is cut at ``cutoff`` on its
    date column; the stored side is cut too only when that column is one of the
    keys (Q30) -- otherwise a stored row outside the cutoff would stop matching
    its re-downloaded copy (Q31)."""
    from harvest.operators.quality import date_cutoff, pick_date_column
    if cutoff is None:
        return new_rows(incoming, store, keys)
    col = date_col or pick_date_column(incoming.columns)
    inc = date_cutoff(incoming, cutoff.year, cutoff.month, cutoff.day, date_col=col)
    st = date_cutoff(store, cutoff.year, cutoff.month, cutoff.day, date_col=col) if col in keys else store
    return new_rows(inc, st, keys)
