"""O01 typed multi-key stable sort, O02 id ordering, O04 latest by time.

A sort spec is a list of ``(column, type)`` with type in ``date_asc``,
``text_asc``, ``number_asc`` (the stored ``sort_keys`` config). Each entry
becomes plain column expressions, so the sort is Spark's range-partitioned
sort; the input ordinal is the last key, which makes it stable.

Total order per type (mixed values never fail):
* ``date_asc``: parsed date, unparseable / NULL first;
* ``text_asc``: rank words (上前一 < 中二 < 下後三) first, then the other text in
  Traditional Chinese collation, NULL as '' ;
* ``number_asc``: numbers ascending, then non-numeric text, then NULL.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from harvest.functions.dates import parse_date
from harvest.functions.text import rank_word, safe_float
from harvest.operators.numbering import consecutive_index

SORT_TYPES = ("date_asc", "text_asc", "number_asc")
TEXT_COLLATION = "zh_Hant_TWN"


def sort_key_columns(col: str, sort_type: str, collation: str | None = TEXT_COLLATION) -> list[Column]:
    c = F.col(col)
    if sort_type == "date_asc":
        return [parse_date(c).asc_nulls_first()]
    if sort_type == "text_asc":
        r = rank_word(c)
        text = F.coalesce(c.cast("string"), F.lit(""))
        if collation:
            text = F.collate(text, collation)
        return [F.when(r.isNull(), F.lit(1)).otherwise(F.lit(0)).asc(), r.asc_nulls_last(), text.asc()]
    if sort_type == "number_asc":
        x = safe_float(c)
        cls = F.when(x.isNotNull(), F.lit(0)).when(c.isNotNull(), F.lit(1)).otherwise(F.lit(2))
        return [cls.asc(), x.asc_nulls_last(), c.cast("string").asc_nulls_last()]
    raise ValueError(f"unknown sort type {sort_type!r}; expected one of {SORT_TYPES}")


def sort_spec_columns(spec: Sequence[Sequence[str]], ord_col: str | None,
                      collation: str | None = TEXT_COLLATION) -> list[Column]:
    out: list[Column] = []
    for col, sort_type in spec:
        out += sort_key_columns(col, sort_type, collation)
    if ord_col:
        out.append(F.col(ord_col).asc())
    return out


def typed_sort(df: DataFrame, spec: Sequence[Sequence[str]], ord_col: str | None = None,
               collation: str | None = TEXT_COLLATION) -> DataFrame:
    """Globally sorted DataFrame (range partitioning + per-partition sort)."""
    return df.orderBy(*sort_spec_columns(spec, ord_col, collation))


def sort_positions(df: DataFrame, spec: Sequence[Sequence[str]], ord_col: str,
                   name: str = "sort_pos", group_by: Sequence[str] = (),
                   collation: str | None = TEXT_COLLATION) -> DataFrame:
    """O01 with the 1-based position exposed (per group when ``group_by``)."""
    return consecutive_index(df, sort_spec_columns(spec, ord_col, collation), group_by, name=name)


def latest_by(df: DataFrame, time_col: str, group_by: Sequence[str] = ()) -> DataFrame:
    """The row with the largest ``time_col`` (per group) via ``max_by``."""
    rest = [c for c in df.columns if c not in group_by]
    packed = F.max_by(F.struct(*[F.col(c) for c in rest]), F.col(time_col)).alias("_r")
    agg = df.groupBy(*group_by).agg(packed) if group_by else df.agg(packed)
    return agg.select(*group_by, *[F.col("_r")[c].alias(c) for c in rest])


def spec_sort_key(fields: Column, spec: Column) -> Column:
    """Per-row sort key for a per-row spec: ``fields`` is a map of field name ->
    text, ``spec`` an ``array<array<string>>`` of ``[field, type]``. Returns an
    array of structs whose lexicographic order is the typed order of
    ``sort_key_columns`` (rank words first, then text in the same collation;
    numbers before text, unparseable dates first), so rows of datasets with
    different specs can share one sort."""
    def key(cls, d=None, n=None, r=None, t=None, s=None):
        return F.struct(cls.alias("c"), (F.lit(None).cast("timestamp_ntz") if d is None else d).alias("d"),
                        (F.lit(None).cast("double") if n is None else n).alias("n"),
                        (F.lit(None).cast("int") if r is None else r).alias("r"),
                        F.collate(F.lit(None).cast("string") if t is None else t, TEXT_COLLATION).alias("t"),
                        (F.lit(None).cast("string") if s is None else s).alias("s"))

    def one(entry):
        name, kind = F.get(entry, 0), F.get(entry, 1)
        v = F.element_at(fields, name)
        d = parse_date(v)
        r = rank_word(v)
        x = safe_float(v)
        date_key = key(F.lit(0), d=d)     # a null field sorts first; the date is parsed once
        text_key = key(F.when(r.isNotNull(), 0).otherwise(1), r=r, t=F.when(r.isNull(), F.coalesce(v, F.lit(""))))
        num_key = key(F.when(x.isNotNull(), 0).when(v.isNotNull(), 1).otherwise(2), n=x, s=F.when(x.isNull(), v))
        return (F.when(kind == "date_asc", date_key).when(kind == "text_asc", text_key)
                .when(kind == "number_asc", num_key))
    return F.transform(F.coalesce(spec, F.array().cast("array<array<string>>")), one)
