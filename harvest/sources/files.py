"""Document-file inventory (paths, names, sizes) without reading contents."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from harvest.functions.sizes import human_size
from harvest.functions.text import file_base_name, file_stem


def file_inventory(spark: SparkSession, root: str, glob: str = "*.pdf") -> DataFrame:
    """One row per matching file: path, name, stem, byte size, readable size.
    The ``content`` column of the binary-file source is never selected, so
    file bodies are not read."""
    df = (spark.read.format("binaryFile").option("pathGlobFilter", glob)
          .option("recursiveFileLookup", "true").load(root))
    return df.select(F.col("path").alias("file_path"), file_base_name(F.col("path")).alias("file_name"),
                     file_stem(F.col("path")).alias("stem"), F.col("length").alias("bytes"),
                     human_size(F.col("length")).alias("file_size"), F.col("modificationTime").alias("modified"))
