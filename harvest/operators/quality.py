"""P01 integrity, P02/P03 date cutoff, P05 load-mode routing, P12 freshness."""

from __future__ import annotations

import datetime as _dt

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from harvest.functions.times import ts_lit
from harvest.functions.dates import parse_date
from harvest.functions.text import CODE_LIST_WORD, SPATIAL_WORD
from harvest.session import checkpoint_dir

# Column-name words that mark a date column, and words that
# mark a dataset without one (checked on the lower-cased column name).
DATE_COLUMN_WORDS = ["date", "日期", "年度", "year", "年份"]
NO_DATE_COLUMN_WORDS = ["crop_uid", "分布圖"]
DEFAULT_CUTOFF = (2025, 1, 1)

# Data category -> 3-digit dataset-id prefix.
CATEGORY_PREFIXES = [
    ("安全飲食", "101"), ("地理圖資", "102"), ("農業旅遊", "103"), ("農糧", "104"),
    ("漁業", "105"), ("畜牧", "106"), ("農民輔導", "107"), ("農業金融", "108"),
    ("動植物防疫檢疫", "109"), ("水土保持", "110"), ("農村再生", "111"), ("造林生產", "112"),
    ("森林經營", "113"), ("農業科技", "114"), ("主計", "115"), ("農業法規", "116"),
    ("農田水利", "117"), ("其他", "118"), ("農業氣象", "119"), ("動物保護", "120"),
]


def pick_date_column(columns: list[str]) -> str | None:
    """First column whose lower-cased name contains a date word; None when a
    no-date word column comes first, or when there is none."""
    for c in columns:
        low = str(c).lower()
        if any(w in low for w in NO_DATE_COLUMN_WORDS):
            return None
        if any(w in low for w in DATE_COLUMN_WORDS):
            return c
    return None


def date_cutoff(df: DataFrame, year: int = DEFAULT_CUTOFF[0], month: int = DEFAULT_CUTOFF[1],
                day: int = DEFAULT_CUTOFF[2], date_col: str | None = None) -> DataFrame:
    """Keep rows whose parsed date is on or after the cutoff.

    Unparseable and NULL dates are dropped; columns are kept. An invalid
    cutoff (year < 1950, month > 12, day > 31) or no date column returns the
    input unchanged. The filter is one codegen predicate next to the scan.
    """
    if int(year) < 1950 or int(month) > 12 or int(day) > 31:
        return df
    col = date_col or pick_date_column(df.columns)
    if col is None:
        return df
    cutoff = _dt.datetime(int(year), int(month), int(day))
    return df.where(parse_date(F.col(col)) >= ts_lit(cutoff))


def category_table(spark) -> DataFrame:
    """The 20-row category -> prefix table (fixed size, safe to broadcast)."""
    return spark.createDataFrame(CATEGORY_PREFIXES, "category string, prefix string")


def _blank(c) -> Column:
    return c.isNull() | (F.trim(c.cast("string")) == "")


def metadata_integrity(meta: DataFrame, categories: DataFrame, required=("api_url", "title", "category",
                                                                        "updated_at_src")) -> DataFrame:
    """P01 + J09: status per metadata record: ``ok`` when every required field
    is non-blank and the category is known (its prefix attached), else
    ``missing`` or ``unknown_category``. Rejects are kept, with their status."""
    from harvest.operators.joins import bounded_broadcast
    cat = bounded_broadcast(categories.select(F.col("category").alias("_cat"), "prefix"))
    j = meta.join(cat, meta["category"] == cat["_cat"], "left").drop("_cat")
    missing = None
    for c in required:
        missing = _blank(F.col(c)) if missing is None else (missing | _blank(F.col(c)))
    status = (F.when(missing, F.lit("missing"))
              .when(F.col("prefix").isNull(), F.lit("unknown_category"))
              .otherwise(F.lit("ok")))
    return j.withColumn("status", status)


def load_mode(title, first_map_url) -> Column:
    """``full`` when the dataset's first row has a non-empty map URL or the
    title names a code list (or a spatial dataset, Q16); else ``incremental``."""
    t = F.coalesce(title, F.lit(""))
    full = ((F.coalesce(first_map_url, F.lit("")) != "")
            | F.contains(t, F.lit(CODE_LIST_WORD)) | F.contains(t, F.lit(SPATIAL_WORD)))
    return F.when(full, F.lit("full")).otherwise(F.lit("incremental"))


def free_dataset_numbers(catalog: DataFrame) -> DataFrame:
    """The unused sequences of each category prefix as intervals (prefix, lo, hi), to be stored and handed on."""
    from harvest.operators.ids import free_intervals
    ok_id = F.col("dataset_id").rlike(r"^\d{7,}$")
    used = catalog.where(ok_id).select(F.substring("dataset_id", 1, 3).alias("prefix"), F.substring("dataset_id", 4, 1 << 20).try_cast("bigint").alias("_n"))
    return free_intervals(used, "_n", "prefix")


def freshness_status(batch: DataFrame, catalog: DataFrame, categories: DataFrame, free: DataFrame | None = None) -> DataFrame:
    """Per incoming metadata record (by title): ``error`` when key fields
    are missing or the category is unknown (Q28), ``new`` when the title is
    not catalogued (gets the next free dataset id of its category, A06),
    ``unchanged`` when the stored update text equals the incoming one (string
    equality), else ``update`` (keeps the stored id). ``free``: the free numbers
    (``free_dataset_numbers``) as they were stored, found from the catalog if not given."""
    return freshness_and_free(batch, catalog, categories, free)[0]


def freshness_and_free(batch: DataFrame, catalog: DataFrame, categories: DataFrame, free: DataFrame | None = None) -> tuple[DataFrame, DataFrame]:
    """``freshness_status``, and the free numbers that are left after it."""
    from harvest.operators.ids import allocate
    from harvest.operators.numbering import consecutive_index
    from harvest.functions.text import compose_id

    checkpoint_dir(batch.sparkSession)
    j = title_outcomes(batch, catalog, categories).select("title", "status", "prefix", "_id").checkpoint()
    known = j.where(F.col("status") != "new").select("title", "status", F.col("_id").alias("dataset_id"))
    new = consecutive_index(j.where(F.col("status") == "new").select("title", "status", "prefix"), ["title"], ["prefix"], name="_r")
    new, left = allocate(free_dataset_numbers(catalog) if free is None else free, new, "prefix", "_r", name="_seq")
    new = new.select("title", "status", compose_id(F.col("prefix"), F.col("_seq"), 4).alias("dataset_id"))
    return known.unionByName(new), left


def title_outcomes(batch: DataFrame, catalog: DataFrame, categories: DataFrame) -> DataFrame:
    """The outcome of each title (A07 counts them): ``title, status, prefix`` and ``_id``, the stored dataset id, if any."""
    checked = metadata_integrity(batch, categories, required=("title", "category", "updated_at_src"))
    # one row per title on both sides: the latest record of the batch (all without a title stay, as errors), and of
    # the catalog the row with the least id
    latest = checked.where("title is not null").groupBy("title").agg(F.max(F.struct("updated_at_src", "status", "prefix")).alias("_r"))
    checked = latest.select("title", "_r.*").unionByName(checked.where("title is null").select("title", "updated_at_src", "status", "prefix"))
    cat = (catalog.groupBy(F.col("title").alias("_t")).agg(F.min(F.struct("dataset_id", "updated_at_src")).alias("_c"))
           .select("_t", F.col("_c.dataset_id").alias("_id"), F.col("_c.updated_at_src").alias("_upd")))
    j = checked.join(cat, checked["title"] == cat["_t"], "left").drop("_t")
    status = (F.when(F.col("status") != "ok", F.lit("error"))
              .when(F.col("_id").isNull(), F.lit("new"))
              .when(F.col("_upd") == F.col("updated_at_src"), F.lit("unchanged"))
              .otherwise(F.lit("update")))
    return j.withColumn("status", status)
