"""Every registered query against its DuckDB oracle (the driver's correctness gate)."""

import pytest

import __spark_entry__ as E
from harvest.plans.registry import QUERIES, load_all
from oracle_check import compare, duck

load_all()

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def con():
    return duck(SF)


@pytest.mark.parametrize("key", sorted(QUERIES))
def test_query_matches_oracle(spark, con, key):
    res = compare(spark, con, key, E.queries()[key], E.oracle_sql().get(key), SF)
    assert res["status"] in ("OK", "rows-only"), res


@pytest.mark.parametrize("key", ["catalog_lookup", "catalog_search", "title_file_match"])
def test_substring_joins_by_the_gram_index(spark, con, key, monkeypatch):
    from harvest.operators import joins
    monkeypatch.setattr(joins, "LITERAL_NEEDLES", 0)   # all needles go through the index
    res = compare(spark, con, key, E.queries()[key], E.oracle_sql().get(key), SF)
    assert res["status"] == "OK", res
    plan = E.queries()[key](spark, SF)._jdf.queryExecution().executedPlan().toString()
    assert "NestedLoopJoin" not in plan and "CartesianProduct" not in plan
