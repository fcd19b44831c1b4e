"""Sinks and DDL: K01 schema-evolving append, K02 full / per-dataset replace,
K03 JSON snapshot, K08 CSV report, K11 table schemas, K14 keyed layout.

A table rewritten from itself (upsert, replace-by-key) is written to a
directory other than the one it is read from (the caller names the next
version); appends and per-dataset replacement write in place under Spark's
commit protocol.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from harvest.functions.text import clean_column_name

# Catalog-side table schemas (dataset rows are all text plus their ids).
CATALOG_SCHEMA = T.StructType([T.StructField(n, T.StringType()) for n in (
    "dataset_id", "title", "link", "category", "provider", "published", "frequency",
    "updated_at_src", "description", "source", "api_url", "doc_path")] + [
    T.StructField("created_at", T.TimestampNTZType()), T.StructField("last_updated_at", T.TimestampNTZType())])
FILES_SCHEMA = T.StructType([
    T.StructField("file_id", T.StringType(), False), T.StructField("file_path", T.StringType(), False),
    T.StructField("file_name", T.StringType()), T.StructField("file_type", T.StringType()),
    T.StructField("file_size", T.StringType()), T.StructField("upload_date", T.TimestampNTZType()),
    T.StructField("description", T.StringType())])
RECORD_FILES_SCHEMA = T.StructType([T.StructField("record_id", T.StringType(), False),
                                    T.StructField("file_id", T.StringType(), False)])
SORT_CONFIG_SCHEMA = T.StructType([T.StructField("file_name", T.StringType()),
                                   T.StructField("sort_keys", T.ArrayType(T.ArrayType(T.StringType()))),
                                   T.StructField("dataset_id", T.StringType())])
MERGE_CONFIG_SCHEMA = T.StructType([T.StructField("file_name", T.StringType()),
                                    T.StructField("merge_keys", T.ArrayType(T.StringType())),
                                    T.StructField("auto_merge", T.BooleanType()),
                                    T.StructField("dataset_id", T.StringType())])


def clean_columns(df: DataFrame) -> DataFrame:
    """rename columns (space, dot, dash -> underscore); nested values -> JSON text."""
    out = []
    for f in df.schema.fields:
        c = F.col(f"`{f.name}`")
        if isinstance(f.dataType, (T.StructType, T.ArrayType, T.MapType, T.VariantType)):
            c = F.to_json(c)
        out.append(c.alias(clean_column_name(f.name)))
    return df.select(*out)


def evolve_union(store: DataFrame, batch: DataFrame) -> DataFrame:
    """The store plus a drifting batch; the column set is the union, NULL-filled.
    Columns whose types differ become text on both sides."""
    batch = clean_columns(batch)
    have, new = dict(store.dtypes), dict(batch.dtypes)
    drifted = {c for c in have.keys() & new.keys() if have[c] != new[c]}

    def as_text(df: DataFrame) -> DataFrame:
        return df.select(*[F.col(f"`{c}`").cast("string").alias(c) if c in drifted else F.col(f"`{c}`") for c in df.columns])

    return as_text(store).unionByName(as_text(batch), allowMissingColumns=True)


def path_exists(spark: SparkSession, path: str) -> bool:
    p = spark._jvm.org.apache.hadoop.fs.Path(path)
    return p.getFileSystem(spark._jsc.hadoopConfiguration()).exists(p)


def delete_path(spark: SparkSession, path: str) -> None:
    p = spark._jvm.org.apache.hadoop.fs.Path(path)
    p.getFileSystem(spark._jsc.hadoopConfiguration()).delete(p, True)


def read_evolved(spark: SparkSession, path: str) -> DataFrame:
    """A table that was appended to with drifting columns, with all of them (schemas are merged on read)."""
    return spark.read.option("mergeSchema", "true").parquet(path)


def append(df: DataFrame, path: str, partition_by: Sequence[str] = ("dataset_id",)) -> None:
    """One distributed append (``read_evolved`` merges the schemas)."""
    w = df.write.mode("append")
    if partition_by:
        w = w.partitionBy(*partition_by)
    w.parquet(path)


def replace_datasets(df: DataFrame, path: str, partition_by: Sequence[str] = ("dataset_id",)) -> None:
    """Replace only the datasets present in ``df`` (dynamic partition overwrite)."""
    (df.write.mode("overwrite").option("partitionOverwriteMode", "dynamic")
     .partitionBy(*partition_by).parquet(path))


def write_json_snapshot(df: DataFrame, path: str) -> None:
    """JSON lines, UTF-8, NULL fields written out."""
    df.write.mode("overwrite").option("ignoreNullFields", "false").json(path)


def write_csv_report(df: DataFrame, path: str) -> None:
    """CSV report; each file begins with a byte order mark and a header row."""
    df = df.toDF(*["\ufeff" * (i == 0) + c for i, c in enumerate(df.columns)])
    df.write.mode("overwrite").option("header", True).option("encoding", "UTF-8").csv(path)


def write_keyed_layout(spark: SparkSession, df: DataFrame, table: str, keys: Sequence[str],
                       buckets: int, path: str | None = None) -> None:
    """Bucket and sort by the match keys so later joins / de-dup on those
    keys read co-partitioned data without a shuffle, then gather statistics."""
    w = df.write.mode("overwrite").bucketBy(buckets, *keys).sortBy(*keys)
    if path:
        w = w.option("path", path)
    w.saveAsTable(table)
    spark.sql(f"ANALYZE TABLE {table} COMPUTE STATISTICS FOR ALL COLUMNS")


def ensure_table(spark: SparkSession, name: str, schema: T.StructType, path: str | None = None,
                 partition_by: Sequence[str] = ()) -> bool:
    """Create an empty parquet table with ``schema`` when it does not exist.
    Returns True when it was created. Keys are enforced by checks (key_violations),
    not by the storage."""
    from harvest.operators.catalog import quoted
    if spark.catalog.tableExists(quoted(name)):
        return False
    w = spark.createDataFrame([], schema).write.format("parquet")
    if partition_by:
        w = w.partitionBy(*partition_by)
    if path:
        w = w.option("path", path)
    w.saveAsTable(quoted(name))
    return True
