"""De-duplication family: A02 stats, A03 exact distinct, W01 keep-first,
W02 keep-last, W03 surplus preview.

Rows of a key are in one total order everywhere: by the order column, NULL
ordinals after all others (first of all when the last is kept, as the original's
database orders them), then by ``tie_break`` columns, then by a hash of the
row. What keep-first drops is thus exactly what the preview lists and the
statistics count.

Keep-first / keep-last are written as group aggregates (``min_by`` /
``max_by`` over a struct of the row) rather than a ``row_number`` window:
the aggregate is computed partially on the map side, so a key that holds a
third of all rows is reduced to one row per map task before the shuffle.
NULL key values form one group, as in ``PARTITION BY``.

``keep_first_located`` / ``keep_last_located`` do the same for a table read
from files without moving payloads at all where duplicates, or survivors, are
few: hash aggregates over the keys find the keys with several rows, the rows
of those are ordered by fixed-width columns and their place in the files, and
the result is the table without (or with only) the places found.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from harvest.functions.text import right_chars
from harvest.operators.joins import same_keys
from harvest.operators.numbering import consecutive_index


def row_hash(df: DataFrame) -> Column:
    """A hash of the whole row; the order of last resort among rows of one key."""
    as_text = lambda f: F.to_json(F.struct(F.col(f"`{f.name}`"))) if _needs_text(f.dataType) else F.col(f"`{f.name}`")
    return F.xxhash64(*[as_text(f) for f in df.schema.fields])


def _needs_text(t: T.DataType) -> bool:
    """Whether a type has parts that Spark does not hash (variants, maps)."""
    if isinstance(t, T.StructType):
        return any(_needs_text(f.dataType) for f in t.fields)
    return _needs_text(t.elementType) if isinstance(t, T.ArrayType) else isinstance(t, (T.VariantType, T.MapType))


def _order(df: DataFrame, order_col: str, tie_break: Sequence[str]) -> Column:
    # (is-null, value) never is NULL itself: a NULL ordinal ranks after every
    # value, i.e. last ascending and first descending.
    return F.struct(F.col(order_col).isNull(), F.col(order_col), *[F.col(c) for c in tie_break], row_hash(df).alias("_h"))


def _keep_one(df: DataFrame, keys: Sequence[str], order_col: str, tie_break: Sequence[str], pick) -> DataFrame:
    keys = list(keys)
    rest = [c for c in df.columns if c not in keys]
    packed = F.struct(*[F.col(c) for c in rest])
    agg = df.groupBy(*keys).agg(pick(packed, _order(df, order_col, tie_break)).alias("_row"))
    return agg.select(*[F.col(c) for c in keys], *[F.col("_row")[c].alias(c) for c in rest]).select(*df.columns)


def keep_first(df: DataFrame, keys: Sequence[str], order_col: str, tie_break: Sequence[str] = ()) -> DataFrame:
    """One row per key, the one with the smallest ``order_col``."""
    return _keep_one(df, keys, order_col, tie_break, F.min_by)


def keep_last(df: DataFrame, keys: Sequence[str], order_col: str, tie_break: Sequence[str] = ()) -> DataFrame:
    """One row per key, the one with the largest ``order_col``."""
    return _keep_one(df, keys, order_col, tie_break, F.max_by)


def _places(df: DataFrame) -> DataFrame:
    """The rows of a table read from files, with the place of each: file and position in it."""
    return df.select("*", F.col("_metadata.file_path").alias("_file"), F.col("_metadata.row_index").alias("_row"))


def _located(df: DataFrame, keys: Sequence[str], order_col: str, tie_break: Sequence[str], pick, surplus: bool) -> DataFrame:
    keys, by = list(keys), [c for c in (order_col, *tie_break) if c not in keys]
    rows = _places(df)
    per_key = df.groupBy(*keys).agg(F.count(F.lit(1)).alias("_n"))
    stats = per_key.agg(F.count(F.lit(1)).alias("kept"), F.sum("_n").alias("rows")).first()
    kept, extra = stats["kept"], (stats["rows"] or 0) - stats["kept"]
    several = per_key.where("_n > 1").select(*keys)
    members = rows.select(*keys, *by, "_file", "_row").alias("r").join(several.alias("k"), same_keys(keys, "r", "k"), "left_semi")
    place = F.struct("_file", "_row")
    best = members.groupBy(*keys).agg(pick(place, F.struct(F.col(order_col).isNull(), *[F.col(c) for c in (order_col, *tie_break)], place)).alias("_p")).select("_p._file", "_p._row")
    others = members.select("_file", "_row").join(best, ["_file", "_row"], "left_anti")
    if surplus:
        found = rows.join(others, ["_file", "_row"], "left_semi")
    elif extra <= kept:         # few rows go: the table without them
        found = rows.join(others, ["_file", "_row"], "left_anti")
    else:                       # few rows stay: those of single keys, and the best of each other key
        alone = rows.select(*keys, "_file", "_row").alias("r").join(several.alias("k"), same_keys(keys, "r", "k"), "left_anti").select("_file", "_row")
        found = rows.join(best.unionByName(alone), ["_file", "_row"], "left_semi")
    return found.select(*df.columns)


def keep_first_located(df: DataFrame, keys: Sequence[str], order_col: str, tie_break: Sequence[str] = ()) -> DataFrame:
    """W01 with late materialisation, for a frame read from files. Rows equal in order and tie-break go by their place."""
    return _located(df, keys, order_col, tie_break, F.min_by, False)


def keep_last_located(df: DataFrame, keys: Sequence[str], order_col: str, tie_break: Sequence[str] = ()) -> DataFrame:
    """W02 with late materialisation, for a frame read from files."""
    return _located(df, keys, order_col, tie_break, F.max_by, False)


def surplus_located(df: DataFrame, keys: Sequence[str], order_col: str, tie_break: Sequence[str] = (), keep: str = "first") -> DataFrame:
    """The rows that ``keep_first_located`` (or ``keep_last_located``) leaves out."""
    return _located(df, keys, order_col, tie_break, F.min_by if keep == "first" else F.max_by, True)


def distinct_rows(df: DataFrame, ord_col: str | None = None) -> DataFrame:
    """Exact distinct rows. Column order never matters (rows are compared by
    name). With ``ord_col`` the first occurrence's ordinal is kept, so the
    original order can be restored with ``orderBy(ord_col)``."""
    cols = [c for c in df.columns if c != ord_col]
    if ord_col is None:
        return df.dropDuplicates()
    return df.groupBy(*cols).agg(F.min(ord_col).alias(ord_col))


def duplicate_stats(df: DataFrame, keys: Sequence[str], group_by: Sequence[str] = ()) -> DataFrame:
    """Total rows and surplus rows (rows beyond the first of each key), per group."""
    g = list(group_by)
    per_key = df.groupBy(*g, *[k for k in keys if k not in g]).agg(F.count(F.lit(1)).alias("_n"))
    agg = [F.sum("_n").cast("bigint").alias("total_rows"),
           F.sum(F.col("_n") - 1).cast("bigint").alias("duplicate_rows")]
    return per_key.groupBy(*g).agg(*agg) if g else per_key.agg(*agg)


def surplus_rows(df: DataFrame, keys: Sequence[str], order_col: str, keep: str = "first", tie_break: Sequence[str] = ()) -> DataFrame:
    """Rows a keep-first (or keep-last) de-duplication would delete: of n rows of a key, n - 1.

    Rows of keys that occur once are left out by a hash aggregate; the others are numbered per key in
    the order of the de-duplication (a hot key is spread over many tasks), and all but the first are returned."""
    keys = list(keys)
    several = df.groupBy(*keys).agg(F.count(F.lit(1)).alias("_n")).where("_n > 1").select(*keys)
    members = df.alias("r").join(several.alias("k"), same_keys(keys, "r", "k"), "left_semi").withColumn("_o", _order(df, order_col, tie_break))
    numbered = consecutive_index(members, [F.col("_o").asc() if keep == "first" else F.col("_o").desc()], keys, name="_i")
    return numbered.where("_i > 1").select(*df.columns)


def duplicate_preview(df: DataFrame, keys: Sequence[str], id_col: str, drop: Sequence[str] = (),
                      n: int = 10, tie_break: Sequence[str] = ()) -> DataFrame:
    """Up to n surplus rows ordered by id (NULL ids last); id cut to its last 7 characters,
    service columns dropped. The limit is the feature (a preview)."""
    s = surplus_rows(df, keys, id_col, tie_break=tie_break).orderBy(F.col(id_col).asc_nulls_last(), *tie_break).limit(n)
    keep = [c for c in df.columns if c not in set(drop) and c != id_col]
    return s.select(right_chars(F.col(id_col)).alias(id_col), *keep)


def distinct_records(rows: DataFrame, payload_col: str = "v", ord_col: str = "_ord",
                     group_by: Sequence[str] = ()) -> DataFrame:
    """A03 on raw records: one row per distinct payload, the first occurrence
    kept (its ordinal and position restored by ``orderBy(ord_col)``).

    The payload is a VARIANT object; its JSON text has sorted keys and keeps
    explicit nulls, so key order does not matter while a missing key and a
    NULL value stay different. Known difference: VARIANT stores ``1.0`` and
    ``1`` as the same number, so those two records count as one (typed
    columns keep them apart)."""
    canon = F.to_json(F.col(payload_col)).alias("_canon")
    rest = [c for c in rows.columns if c not in (*group_by, payload_col, ord_col)]
    best = (rows.groupBy(*group_by, canon)
            .agg(F.min_by(F.struct(F.col(ord_col), F.col(payload_col), *[F.col(c) for c in rest]), F.col(ord_col)).alias("_r")))
    return best.select(*group_by, *[F.col("_r")[c].alias(c) for c in (ord_col, payload_col, *rest)])
