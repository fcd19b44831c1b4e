"""harvest: land, clean and catalogue many open-data tables with Spark.

Every operator is a function ``f(df, ...) -> DataFrame`` that only builds a
lazy plan; nothing pulls data through the driver.
"""

from harvest.session import get_spark, checkpoint_dir, read_table

__all__ = ["get_spark", "checkpoint_dir", "read_table"]
