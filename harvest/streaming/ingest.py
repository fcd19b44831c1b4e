"""Incremental, resumable ingest of landed JSON pages with Structured Streaming.

``readStream`` over the landing folder (a page log, or one JSON file per page) ->
``foreachBatch``: objects of each page (S01) -> the refresh of ``plans/refresh.py``: exact copies
go, null-safe anti-join against the keys of the batch's datasets in the store's index (J01), sequential ids
after the stored maximum per dataset (A05 + W04) -> one commit, which notes the stream and the
batch number. ``trigger(availableNow=True)`` processes whatever has landed and stops; the
checkpoint records which files were consumed, so a rerun reads nothing new. ``foreachBatch`` is
at-least-once: a batch that the store has already is left out by its number. The counters of each batch
(rows read, unique, new, in total, per dataset) are stored with its commit (A08).
"""

from __future__ import annotations

import os
from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from harvest.plans.refresh import refresh_store
from harvest.sources.landing import PAGE_LOG, object_rows, page_address
from harvest.store import Store


def _flatten(pages: DataFrame) -> DataFrame:
    """dataset_id, _ord, v: ordinals are offset, position, and where the page stands (a page may be landed twice)."""
    return object_rows(pages, ("dataset_id", "skip", "_at")).select("dataset_id", F.struct("skip", "pos", "_at").alias("_ord"), "v")


def start_ingest(spark: SparkSession, landing_dir: str, store: Store, checkpoint: str,
                 keys: Sequence[str], max_files_per_trigger: int | None = None, after_write=None,
                 glob: str = "*", page_log: bool = False):
    """Start the availableNow ingest; returns the StreamingQuery (call awaitTermination()).

    ``keys``: the fields that identify a row within its dataset. ``after_write(epoch_id)`` runs after a batch
    is stored and before the stream commits it (a hook for failure-injection tests)."""
    reader = spark.readStream.option("pathGlobFilter", glob).option("recursiveFileLookup", "true")
    if max_files_per_trigger:
        reader = reader.option("maxFilesPerTrigger", max_files_per_trigger)
    if page_log:
        pages = reader.schema(PAGE_LOG).parquet(landing_dir).select(
            "dataset_id", "skip", "body", F.concat("_metadata.file_path", F.lit("#"), F.col("_metadata.row_index").cast("string")).alias("_at"))
    else:
        files = reader.format("text").option("wholetext", True).load(landing_dir).select("value", F.col("_metadata.file_path").alias("_at"))
        dataset, skip = page_address(F.col("_at"))
        pages = files.select(dataset.alias("dataset_id"), skip.alias("skip"), F.col("value").alias("body"), "_at")
    stream = pages.where("dataset_id <> '' AND skip IS NOT NULL")        # a file at any other address is no page

    def load_batch(batch: DataFrame, epoch_id: int) -> None:
        fixed = [F.array(*[F.lit(k) for k in keys]).alias("keys"), F.lit(None).cast("string").alias("date_col"), F.lit(None).cast("string").alias("title")]
        configs = batch.select("dataset_id").distinct().select("dataset_id", *fixed)
        refresh_store(_flatten(batch), store, configs, source=(checkpoint, epoch_id), replace=False)
        if after_write is not None:
            after_write(epoch_id)

    return (stream.writeStream.foreachBatch(load_batch)
            .option("checkpointLocation", checkpoint)
            .trigger(availableNow=True)
            .start())


def run_ingest(spark: SparkSession, landing_dir: str, store: Store, checkpoint: str,
               keys: Sequence[str], **kw) -> None:
    q = start_ingest(spark, landing_dir, store, checkpoint, keys, **kw)
    q.awaitTermination()


def default_checkpoint(spark: SparkSession, name: str) -> str:
    """A checkpoint folder under the session's shared ``spark.checkpoint.dir``."""
    from harvest.session import checkpoint_dir
    return os.path.join(checkpoint_dir(spark), "streams", name)
