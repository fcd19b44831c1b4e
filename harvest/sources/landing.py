"""Landed JSON pages -> object rows (S01, S02/U02, S04, R02), the page
manifest audit (S03, W06) and crash-resume snapshots (S05, K10, O04, F23).

A landed page is one JSON document per file named ``<dataset>_<skip>.json``,
or a row ``dataset_id, skip, body`` of a page log: files that take as many pages
as fit, so that the number of files follows the bytes and not the pages. Only JSON objects inside a JSON
array become rows; a non-array page or a non-JSON page yields nothing. Rows
carry ``_ord = (skip, pos)`` so that the original page order can be restored
without collecting anything.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from harvest.functions.text import snapshot_time
from harvest.operators.numbering import consecutive_index, running

PAGE_SIZE = 1000                   # fixed page size of the portal API
SNAPSHOT_PREFIX = "interruption_record_"
PAGE_FILE_RE = r"([^/]+)_(\d+)\.json$"
PAGE_LOG = "dataset_id string, skip bigint, body string"
PAGE_LOG_COLUMNS = ("dataset_id", "skip", "body")
PAGE_DIR_DATASET_RE = r"/dataset_id=([^/]+)/"
PAGE_DIR_SKIP_RE = r"/skip=(\d+)/"


def page_address(path: Column) -> tuple[Column, Column]:
    """(dataset id, skip) of a landed page file: from ``dataset_id=<id>/skip=<n>/``
    directories when present, else from a ``<id>_<skip>.json`` file name. Other
    addresses give an empty id and a NULL skip, for the reader to leave out."""
    d_dir, s_dir = F.regexp_extract(path, PAGE_DIR_DATASET_RE, 1), F.regexp_extract(path, PAGE_DIR_SKIP_RE, 1)
    dataset = F.when(d_dir != "", d_dir).otherwise(F.regexp_extract(path, PAGE_FILE_RE, 1))
    skip = F.when(s_dir != "", s_dir).otherwise(F.regexp_extract(path, PAGE_FILE_RE, 2)).try_cast("bigint")
    return dataset, skip


def read_landed_pages(spark: SparkSession, path: str, glob: str | None = None) -> DataFrame:
    """Whole-file text read of landed pages (one JSON document per file)."""
    r = spark.read.option("recursiveFileLookup", "true")
    if glob:
        r = r.option("pathGlobFilter", glob)
    raw = r.text(path, wholetext=True).select(F.col("value").alias("body"), F.col("_metadata.file_path").alias("_path"))
    dataset, skip = page_address(F.col("_path"))
    return raw.select(dataset.alias("dataset_id"), skip.alias("skip"), "body")


def land_pages(pages: DataFrame, path: str) -> None:
    """Append ``(dataset_id, skip, body)`` pages to a page log. Files are filled up to the session's advisory partition
    size; many pages go into one file."""
    pages.select(*PAGE_LOG_COLUMNS).hint("rebalance").write.mode("append").parquet(path)


def read_page_log(spark: SparkSession, path: str) -> DataFrame:
    """The pages of a log; a page that was landed again counts once, as it was landed last."""
    log = spark.read.schema(PAGE_LOG).parquet(path).select(*PAGE_LOG_COLUMNS, F.struct("_metadata.file_modification_time", "_metadata.file_path", "_metadata.row_index").alias("_at"))
    last = log.groupBy("dataset_id", "skip").agg(F.max("_at").alias("_last"))
    return log.alias("p").join(last.alias("l"), F.expr("p.dataset_id <=> l.dataset_id AND p.skip <=> l.skip AND p._at = l._last")).select("p.dataset_id", "p.skip", "p.body")


def object_rows(pages: DataFrame, key_cols: Sequence[str] = ("dataset_id", "skip")) -> DataFrame:
    """One row per JSON object element of each page's JSON array,
    as a VARIANT ``v`` with its position ``pos``."""
    v = F.try_parse_json(F.col("body"))
    arr = F.try_variant_get(v, "$", "array<variant>")
    exploded = pages.select(*key_cols, F.posexplode(arr).alias("pos", "v"))
    return exploded.where(F.schema_of_variant(F.col("v")).startswith("OBJECT"))


def with_order(rows: DataFrame, skip_col: str = "skip", pos_col: str = "pos") -> DataFrame:
    """Attach ``_ord = struct(skip, pos)``; ``orderBy('_ord')`` is the page order."""
    return rows.withColumn("_ord", F.struct(F.col(skip_col), F.col(pos_col)))


def assembled_index(rows: DataFrame, group_by: Sequence[str] = (), name: str = "row_index") -> DataFrame:
    """Gap-free row index in page order (per dataset when grouped)."""
    return consecutive_index(rows, ["skip", "pos"], group_by, name=name)


def read_json_records(spark: SparkSession, path: str, schema=None) -> DataFrame:
    """JSON files holding a list of objects or one object; anything else --
    other elements of a list, other values, text that is not JSON -- gives no
    rows. Without a schema, one is inferred from all objects."""
    v = F.try_parse_json(F.col("value"))
    kind = F.schema_of_variant(v)
    found = F.when(kind.startswith("ARRAY"), F.try_variant_get(v, "$", "array<variant>")).when(kind.startswith("OBJECT"), F.array(v))
    rows = spark.read.text(path, wholetext=True).select(F.explode(found).alias("v"))
    rows = rows.where(F.schema_of_variant("v").startswith("OBJECT"))
    if schema is None:
        kinds = rows.agg(F.schema_of_variant_agg("v")).first()[0] or ""
        if not kinds.startswith("OBJECT<") or kinds == "OBJECT<>":
            return rows.select()
        schema = kinds.replace("OBJECT<", "STRUCT<").replace("VOID", "STRING")
    return rows.select(F.from_json(F.to_json("v"), schema).alias("r")).select("r.*")


def page_manifest(rows: DataFrame, dataset_col: str = "dataset_id", skip_col: str = "skip") -> DataFrame:
    """Rows per landed page (partial aggregation)."""
    return rows.groupBy(dataset_col, skip_col).agg(F.count(F.lit(1)).alias("n_rows"))


def last_live_page(manifest: DataFrame, dataset_col: str = "dataset_id", page_size: int = PAGE_SIZE) -> DataFrame:
    """Per dataset, the largest page offset that still returned rows,
    aligned down to the page size (Q7: a partial last page counts)."""
    live = F.when(F.col("n_rows") > 0, F.col("skip"))
    return manifest.groupBy(dataset_col).agg(
        (F.floor(F.max(live) / page_size) * page_size).cast("bigint").alias("last_skip"))


def page_gaps(manifest: DataFrame, dataset_col: str = "dataset_id") -> DataFrame:
    """Coverage audit of landed pages, in order of offset (pages of one offset: of length): up to where the pages so far
    reach (``covered_to``), the next page's offset, and the gap (> 0: rows never fetched) or overlap (< 0) before it. Pages
    inside a longer one do not move the reach back: it is a running maximum of page ends, scanned without a per-dataset task."""
    m = manifest.select(dataset_col, "skip", "n_rows")
    return (_reach(m, dataset_col).withColumn("gap", F.col("next_skip") - F.col("covered_to"))
            .select(dataset_col, "skip", "n_rows", "covered_to", "next_skip", "gap"))


def _reach(manifest: DataFrame, dataset_col: str) -> DataFrame:
    return running(manifest, F.col("skip") + F.col("n_rows"), ["skip", "n_rows"], [dataset_col], "covered_to", before="reached", following={"next_skip": "skip"})


def page_coverage(manifest: DataFrame, dataset_col: str = "dataset_id") -> DataFrame:
    """Per dataset, the union of its pages' intervals: pages, rows that they returned, offsets covered (each once), offsets
    covered again, and offsets between the first and the last page that none covers."""
    end, new = F.col("skip") + F.col("n_rows"), F.greatest(F.col("skip"), F.coalesce("reached", F.col("skip")))
    r = _reach(manifest.select(dataset_col, "skip", "n_rows"), dataset_col)
    covered, missing = F.greatest(end - new, F.lit(0)), F.greatest(F.col("next_skip") - F.col("covered_to"), F.lit(0))
    return r.groupBy(dataset_col).agg(F.count(F.lit(1)).alias("pages"), F.sum("n_rows").alias("rows_returned"), F.sum(covered).alias("covered"),
                                      (F.sum("n_rows") - F.sum(covered)).alias("covered_again"), F.coalesce(F.sum(missing), F.lit(0)).alias("missing"))


def latest_snapshot(snapshots: DataFrame, dataset_col: str | None = "dataset_id",
                    name_col: str = "file_name") -> DataFrame:
    """The snapshot whose file name carries the newest
    ``yyyyMMdd_HHmmss`` stamp -- per dataset, or overall when ``dataset_col``
    is None (ties broken by file name, then the other columns)."""
    s = snapshots.withColumn("snapshot_ts", snapshot_time(F.col(name_col))).where(F.col("snapshot_ts").isNotNull())
    group = [dataset_col] if dataset_col else []
    rest = [c for c in s.columns if c not in group]
    key = F.struct("snapshot_ts", name_col, *[c for c in rest if c not in ("snapshot_ts", name_col)
                                             and dict(s.dtypes)[c] != "variant"])
    agg = F.max_by(F.struct(*rest), key).alias("_b")
    best = s.groupBy(*group).agg(agg) if group else s.agg(agg)
    return best.where(F.col("_b").isNotNull()).select(*group, *[F.col("_b")[c].alias(c) for c in rest])


def read_snapshots(spark: SparkSession, folder: str) -> DataFrame:
    """K10 files: ``interruption_record_<yyyyMMdd_HHmmss>.json`` holding the
    run's date, dataset name, URL, the offset where it stopped and the rows
    fetched so far. One row per file; the document stays a VARIANT."""
    raw = (spark.read.option("pathGlobFilter", SNAPSHOT_PREFIX + "*.json").text(folder, wholetext=True)
           .select(F.col("_metadata.file_name").alias("file_name"), F.try_parse_json("value").alias("doc")))
    return raw.select("file_name",
                      F.try_variant_get("doc", "$.name", "string").alias("name"),
                      F.try_variant_get("doc", "$.url", "string").alias("url"),
                      F.try_variant_get("doc", "$.date", "string").alias("date"),
                      F.try_variant_get("doc", "$.false_at_skip", "int").alias("resume_skip"),
                      "doc")


def restore_snapshot_rows(snapshots: DataFrame, per_dataset: bool = False) -> DataFrame:
    """Rows of the newest snapshot (overall, as the original restores one
    run, or per dataset name), with their position; non-object elements and a
    non-list record give no rows."""
    latest = latest_snapshot(snapshots, "name" if per_dataset else None)
    arr = F.try_variant_get("doc", "$.interruption_record", "array<variant>")
    rows = latest.select("file_name", "name", "url", "resume_skip", F.posexplode(arr).alias("pos", "v"))
    return rows.where(F.schema_of_variant(F.col("v")).startswith("OBJECT"))
