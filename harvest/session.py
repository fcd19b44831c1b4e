"""Session construction and table access."""

from __future__ import annotations

import os
import tempfile

from pyspark.sql import DataFrame, SparkSession

# Settings that matter at scale: AQE re-plans joins and coalesces shuffle
# partitions at runtime, skew-join splits hot partitions, and the broadcast
# threshold is the single size check that guards every data-dependent join.
DEFAULT_CONF = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.autoBroadcastJoinThreshold": str(32 * 1024 * 1024),
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
    "spark.ui.enabled": "false",
    # Checkpoints (the lineage cuts of gap-free numbering) are written compressed.
    "spark.checkpoint.compress": "true",
}


def scale_conf(input_bytes: int, target_partition_bytes: int = 256 << 20,
               max_partitions: int = 100_000) -> dict:
    """Shuffle sizing for a run that reads about ``input_bytes``: enough initial
    shuffle partitions that each holds ~``target_partition_bytes`` before AQE
    coalesces the small ones, and scan splits of the same size. For 100 TB this
    gives the 100,000-partition cap (~1 GB each before compression effects),
    which AQE then coalesces or splits (skew) at runtime."""
    n = max(200, min(max_partitions, -(-input_bytes // target_partition_bytes)))
    size = f"{target_partition_bytes // (1 << 20)}m"
    return {
        "spark.sql.shuffle.partitions": str(n),
        "spark.sql.adaptive.coalescePartitions.initialPartitionNum": str(n),
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": size,
        "spark.sql.files.maxPartitionBytes": size,
        "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": size,
    }


def get_spark(master: str | None = None, app: str = "harvest",
              shuffle_partitions: int | None = None,
              extra: dict | None = None) -> SparkSession:
    builder = SparkSession.builder.appName(app)
    if master:
        builder = builder.master(master)
    conf = dict(DEFAULT_CONF)
    # An explicitly passed setting wins over the defaults.
    if shuffle_partitions:
        conf["spark.sql.shuffle.partitions"] = str(shuffle_partitions)
    conf.update(extra or {})
    for k, v in conf.items():
        builder = builder.config(k, v)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    checkpoint_dir(spark)
    return spark


def checkpoint_dir(spark: SparkSession) -> str:
    """The shared folder the cluster names in ``spark.checkpoint.dir``.

    A local session that has none (tests) gets a scratch folder; on a cluster it must be set.
    """
    try:
        sc = spark.sparkContext
    except Exception:  # a remote (Connect) session: the server owns its checkpoint dir
        path = spark.conf.get("spark.checkpoint.dir", None)
        if not path:
            raise ValueError("spark.checkpoint.dir is not set: name a folder that driver and executors share")
        return path
    path = sc.getCheckpointDir() or spark.conf.get("spark.checkpoint.dir", None)
    if not path:
        if not sc.master.startswith("local") or sc.master.startswith("local-cluster"):
            raise ValueError("spark.checkpoint.dir is not set: name a folder that driver and executors share")
        path = tempfile.mkdtemp(prefix="harvest-ckpt-")
    if not sc.getCheckpointDir():
        sc.setCheckpointDir(path)
    return sc.getCheckpointDir() or path


def read_table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(os.path.join(sf_dir, f"{name}.parquet"))
