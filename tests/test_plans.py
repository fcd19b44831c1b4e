"""Plan-shape checks on the registered queries (sf0.001)."""

import pytest

import __spark_entry__ as E

SF = "/root/testdata/sf0.001"


def _plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.mark.parametrize("key", sorted(E.queries()))
def test_no_python_eval_and_no_unexpected_nested_loop(spark, key):
    plan = _plan(E.queries()[key](spark, SF))
    assert "BatchEvalPython" not in plan and "ArrowEvalPython" not in plan
    assert "BroadcastNestedLoopJoin" not in plan and "CartesianProduct" not in plan


@pytest.mark.parametrize("key", ["dedup_first", "merge_last", "dup_stats", "distinct_rows", "incremental_new"])
def test_core_operators_have_no_window(spark, key):
    assert "Window" not in _plan(E.queries()[key](spark, SF))


def test_entry_runs(spark):
    df = E.entry(spark)
    assert df.count() >= 0 and "row_id" in df.columns


def test_keyed_layout_removes_the_shuffle(spark):
    plan = _plan(E.queries()["keyed_dedup"](spark, SF))
    assert "Exchange" not in plan


def test_scale_conf_sizes_partitions():
    from harvest.session import scale_conf
    big = scale_conf(100 * 1024 ** 4)
    assert big["spark.sql.shuffle.partitions"] == "100000" and big["spark.sql.files.maxPartitionBytes"] == "256m"
    assert scale_conf(1024 ** 3)["spark.sql.shuffle.partitions"] == "200"


def test_bounded_broadcast_checks_the_size(spark):
    from harvest.operators.joins import bounded_broadcast
    big = spark.range(0, 50_000).withColumnRenamed("id", "k")
    small = spark.range(0, 10).withColumnRenamed("id", "k")
    hinted = big.join(bounded_broadcast(small), "k")
    assert "BroadcastHashJoin" in _plan(hinted)
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    try:
        unhinted = big.join(bounded_broadcast(small, max_rows=5), "k")   # over the bound: no hint
        assert "BroadcastHashJoin" not in _plan(unhinted)
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", str(32 * 1024 * 1024))
        spark.conf.set("spark.sql.adaptive.enabled", "true")
