"""A group holding a third of all rows must not land in one task."""

from pyspark.sql import functions as F

from harvest.operators import dedup, incremental
from harvest.operators.numbering import consecutive_index
from harvest.session import read_table

SF = "/root/testdata/sf0.01"


def _hot(spark):
    li = read_table(spark, SF, "lineitem")
    # a derived key: every third order falls into one hot group
    return li.withColumn("g", F.when(F.pmod("l_orderkey", F.lit(3)) == 0, F.lit(-1)).otherwise(F.col("l_orderkey")))


def test_numbering_spreads_a_hot_group(spark):
    df = _hot(spark)
    total = df.count()
    hot = df.where(F.col("g") == -1).count()
    assert hot > total / 4
    order = ["l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", "l_shipdate", "l_quantity", "l_extendedprice"]
    key = "spark.sql.adaptive.coalescePartitions.enabled"
    old = spark.conf.get(key)
    spark.conf.set(key, "false")                 # see the range bounds, not AQE's merging of tiny partitions
    try:
        sorted_df = df.orderBy("g", *order)
        per_task = [r[1] for r in sorted_df.groupBy(F.spark_partition_id()).count().collect()]
    finally:
        spark.conf.set(key, old)
    assert max(per_task) < 0.6 * hot            # the hot group is split over several range partitions
    out = consecutive_index(df, order, ["g"], name="pos")
    top = out.where(F.col("g") == -1).agg(F.max("pos"), F.countDistinct("pos")).collect()[0]
    assert top[0] == hot and top[1] == hot       # still gap-free within the hot group


def test_keep_first_and_anti_join_aggregate_before_the_shuffle(spark):
    df = _hot(spark)
    plan = dedup.keep_first(df, ["g"], "l_linenumber")._jdf.queryExecution().executedPlan().toString()
    assert "partial_min_by" in plan
    store = df.select("g")
    plan = incremental.new_rows(df, store, ["g"])._jdf.queryExecution().executedPlan().toString()
    assert "HashAggregate" in plan and "Window" not in plan   # stored keys deduplicated map-side
