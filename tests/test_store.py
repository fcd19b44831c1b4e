"""The store: single commits, outcomes per dataset, key index, totals, moves without rewriting."""

import json
import os

import pytest
from pyspark.sql import functions as F

import __spark_entry__ as E
from harvest.operators.catalog import with_totals
from harvest.plans.refresh import refresh_all, refresh_store
from harvest.store import CommitConflict, Store, key_text, payload_map

SF = "/root/testdata/sf0.001"
CONFIG = "dataset_id string, keys array<string>, date_col string, title string, sort_keys array<array<string>>"
ROWS = [("1010001", 0, '{"id": "a", "n": 1}'), ("1010001", 1, '{"id": "b", "n": 2}'),
        ("1010002", 0, '{"id": "z", "分布圖Url": ""}'), ("1010002", 1, '{"id": "y", "分布圖Url": "http://m"}'),
        ("1010003", 0, '{"id": "c"}'), ("1010003", 1, '{"id": "d"}')]


@pytest.fixture()
def store(spark, tmp_path):
    s = Store(spark, str(tmp_path / "store"), buckets=4)
    yield s
    s.close()


@pytest.fixture()
def configs(spark):
    return spark.createDataFrame([("1010001", ["id"], None, "rows", [["id", "text_asc"]]), ("1010002", ["id"], None, "map", [["id", "text_asc"]]),
                                  ("1010003", ["id"], None, "甲代碼", None)], CONFIG)


def landed(spark, part):
    return spark.createDataFrame(part, "dataset_id string, _ord int, t string").select("dataset_id", "_ord", F.parse_json("t").alias("v"))


def refreshed(spark, store, configs, part, **kw):
    return {r.dataset_id: tuple(r)[1:] for r in refresh_store(landed(spark, part), store, configs, **kw).collect()}


def stored(store):
    return sorted((r.row_id, json.loads(r.record)["id"]) for r in store.rows().collect())


def index(store):
    return sorted(tuple(r) for r in store.known_keys().distinct().collect())


def files(store, *parts):
    return sorted((os.path.join(d, f), os.stat(os.path.join(d, f)).st_mtime_ns) for d, _, fs in os.walk(os.path.join(store.root, *parts)) for f in fs)


def test_refresh_runs_twice(spark, store, configs):
    """Map and code datasets restart at 1, others go on after the stored maximum; a second run adds nothing."""
    first = refreshed(spark, store, configs, ROWS)
    assert first == {"1010001": ("incremental", "updated", 2, 2, 2, 2), "1010002": ("full", "updated", 2, 2, 2, 2), "1010003": ("full", "updated", 2, 2, 2, 2)}
    rows = stored(store)
    assert rows == [("10100010000001", "a"), ("10100010000002", "b"), ("10100020000001", "y"), ("10100020000002", "z"),
                    ("10100030000001", "c"), ("10100030000002", "d")]              # after the sort, the map row is first
    assert refreshed(spark, store, configs, ROWS)["1010001"] == ("incremental", "unchanged", 2, 2, 0, 2) and stored(store) == rows
    again = refreshed(spark, store, configs, [("1010001", 0, '{"id": "0"}'), ("1010001", 5, '{"id": "0"}'), ("1010001", 6, '{"id": "a"}'), ("1010003", 0, '{"id": "e"}')])
    assert again == {"1010001": ("incremental", "updated", 3, 2, 1, 3), "1010003": ("full", "updated", 1, 1, 1, 1)}
    assert stored(store) == sorted([*[x for x in rows if x[0][:7] != "1010003"], ("10100010000003", "0"), ("10100030000001", "e")])


def test_a_dataset_without_keys_is_an_error_and_loses_nothing(spark, store, configs):
    more = [("1010009", i, '{"id": "%d"}' % i) for i in range(4)] + [("1010008", 0, '{"id": "m", "分布圖Url": "u"}')]
    for part in (more[:2] + more[4:] + ROWS, more + ROWS):
        got = refreshed(spark, store, configs, part)
        assert got["1010009"] == ("incremental", "error", len(part) - 7, len(part) - 7, 0, 0) and got["1010008"] == ("full", "updated", 1, 1, 1, 1)
    assert not [r for r in stored(store) if r[0].startswith("1010009")]
    known = configs.unionByName(spark.createDataFrame([("1010009", ["id"], None, "x", None), ("1010008", [], None, "x", None)], CONFIG))
    assert refreshed(spark, store, known, more)["1010009"] == ("incremental", "updated", 4, 4, 4, 4)
    nameless = refreshed(spark, store, known, [(None, 0, '{"id": "x"}'), ("", 0, '{"id": "y", "分布圖Url": "u"}'), ("1010009", 9, '{"id": "9"}')])
    assert {k: v[1] for k, v in nameless.items()} == {None: "error", "": "error", "1010009": "updated"} and store.rows().where("dataset_id is null or dataset_id = ''").count() == 0


def test_cut_dataset_and_empty_batch(spark, store):
    configs = spark.createDataFrame([("1010001", ["id"], "date", "rows", None)], CONFIG)
    import datetime as dt
    old = [("1010001", 0, '{"id": 1, "date": "2020/1/1"}'), ("1010001", 1, '{"id": 2, "date": "?"}')]
    assert refreshed(spark, store, configs, old, cutoff=dt.datetime(2025, 1, 1)) == {"1010001": ("incremental", "unchanged", 2, 2, 0, 0)}
    assert refreshed(spark, store, configs, old[:0]) == {} and store.rows().count() == 0


def test_index_and_totals_equal_the_store(spark, store, configs):
    for part in (ROWS, ROWS[:1] + [("1010001", 7, '{"id": "q", "n": null}')], ROWS):
        refreshed(spark, store, configs, part)
        rebuilt = store.rows().join(configs, "dataset_id").select("dataset_id", key_text(payload_map(F.try_parse_json("record")), F.col("keys")).alias("key"))
        assert index(store) == sorted(tuple(r) for r in rebuilt.distinct().collect())
        recount = store.rows().groupBy("dataset_id").agg(F.count("*"), F.max("seq"))
        assert sorted(map(tuple, store.totals().collect())) == sorted(map(tuple, recount.collect()))
    cat = spark.createDataFrame([("1010001", "t"), ("1019999", "none")], "dataset_id string, title string")
    assert sorted(map(tuple, with_totals(cat, store.totals()).collect())) == [("1010001", "t", 3, 3), ("1019999", "none", 0, 0)]


def test_refresh_reads_keys_only_without_a_shuffle_of_them(spark, store, configs):
    refreshed(spark, store, configs, ROWS)
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    spark.conf.set("spark.sql.shuffle.partitions", "4")
    try:
        known = store.known_keys()
        batch = spark.createDataFrame([("1010001", '["a"]'), ("1010001", '["n"]')], "dataset_id string, k string").repartition(3)
        new = batch.join(known, (batch["dataset_id"] == known["dataset_id"]) & (batch["k"] == known["key"]), "left_anti")
        plan = new._jdf.queryExecution().executedPlan().toString()
        assert [r.k for r in new.collect()] == ['["n"]']
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", str(32 * 1024 * 1024))
        spark.conf.set("spark.sql.shuffle.partitions", "8")
    keys = plan[plan.index("SortMergeJoin"):]
    assert "Bucketed: true" in keys and "record" not in plan
    assert keys.count("Exchange hashpartitioning") == 1, keys            # the batch; the index lies as the join wants it
    out = refresh_all(landed(spark, ROWS), store, configs)
    plan = out._jdf.queryExecution().toString()
    assert "record:string" not in plan and store.root + "/rows" not in plan


def test_changed_key_columns_are_indexed_anew(spark, store, configs):
    refreshed(spark, store, configs, ROWS)
    by_n = configs.withColumn("keys", F.when(F.col("dataset_id") == "1010001", F.array(F.lit("n"))).otherwise(F.col("keys")))
    assert refreshed(spark, store, by_n, [("1010001", 0, '{"id": "new", "n": 2}')])["1010001"] == ("incremental", "unchanged", 1, 1, 0, 2)
    assert [k for k in index(store) if k[0] == "1010001"] == [("1010001", '["1"]'), ("1010001", '["2"]')]
    assert not store.reindex(by_n)


def test_rename_and_delete_rewrite_no_row(spark, store, configs):
    refreshed(spark, store, configs, ROWS)
    before = files(store, "rows")
    assert store.rename("1010001", "1010077") and not store.rename("1010001", "1010077") and not store.rename("1010077", "1010002")
    assert sorted({r.dataset_id for r in store.rows().collect()}) == ["1010002", "1010003", "1010077"]
    assert store.delete(spark.createDataFrame([("1010003",), ("nope",)], "d string")) == 1 and store.delete(spark.createDataFrame([("nope",)], "d string")) == 0
    assert files(store, "rows") == before and len(stored(store)) == 4
    moved = configs.withColumn("dataset_id", F.when(F.col("dataset_id") == "1010001", "1010077").otherwise(F.col("dataset_id")))
    part = [("1010077", 0, '{"id": "a"}'), ("1010077", 1, '{"id": "new"}')]
    assert refreshed(spark, store, moved, part)["1010077"] == ("incremental", "updated", 2, 2, 1, 3)
    assert stored(store)[:2] == [("10100010000001", "a"), ("10100010000002", "b")] and ("10100770000003", "new") in stored(store)
    assert [r.dataset_id for r in store.rows(spark.createDataFrame([("1010002",)], "d string")).distinct().select("dataset_id").distinct().collect()] == ["1010002"]


def test_compact_and_sweep(spark, store, configs):
    for i in range(3):
        refreshed(spark, store, configs, ROWS + [("1010001", 10 + i, '{"id": "x%d"}' % i)])
    rows, keys, totals = stored(store), index(store), sorted(map(tuple, store.totals().collect()))
    assert store.pieces().where("dataset_id = '1010001'").count() == 3
    assert store.compact(over=2) and not store.compact(over=2)
    assert store.pieces().where("dataset_id = '1010001'").count() == 1
    n = len(files(store))
    assert store.sweep() > 0 and len(files(store)) < n and store.sweep() == 0
    assert (stored(store), index(store), sorted(map(tuple, store.totals().collect()))) == (rows, keys, totals)
    again = Store(spark, store.root)
    assert again.buckets == 4 and stored(again) == rows
    assert refreshed(spark, again, configs, ROWS)["1010001"][1] == "unchanged"


@pytest.mark.parametrize("step", ["stage_rows", "stage_keys", "_ledger_written"])
def test_a_refresh_that_breaks_off_changes_nothing(spark, store, configs, step, monkeypatch):
    refreshed(spark, store, configs, ROWS)
    before, keys, version = stored(store), index(store), store.version()
    part = [("1010001", 3, '{"id": "n"}'), ("1010003", 0, '{"id": "other"}')]

    def boom(*_, **__):
        raise RuntimeError("driver lost")

    with monkeypatch.context() as m:
        if step == "_ledger_written":           # all folders are there, the commit file is not
            m.setattr(store, "_fs", _NoCreate(store._fs))
        elif step in ("stage_rows", "stage_keys"):
            real = getattr(Store, step)
            m.setattr(Store, step, lambda self, *a: (real(self, *a), boom()))
        else:
            m.setattr(Store, step, boom)
        with pytest.raises(RuntimeError):
            refreshed(spark, store, configs, part)
    assert (stored(store), index(store), store.version()) == (before, keys, version)
    got = refreshed(spark, store, configs, part)           # run again
    assert got["1010001"] == ("incremental", "updated", 1, 1, 1, 3) and got["1010003"] == ("full", "updated", 1, 1, 1, 1)
    assert ("10100030000001", "other") in stored(store) and len(stored(store)) == 6


class _NoCreate:
    def __init__(self, fs):
        self._real = fs

    def create(self, *_):
        raise RuntimeError("driver lost")

    def __getattr__(self, name):
        return getattr(self._real, name)


def test_of_two_writers_one_fails(spark, store, configs):
    refreshed(spark, store, configs, ROWS)
    version = store.version()
    other = Store(spark, store.root)
    other.rename("1010001", "1010055")
    with pytest.raises(CommitConflict):
        store.commit(store.pieces(version).limit(0), version)
    assert "1010055" in {r.dataset_id for r in store.rows().collect()}


def test_an_ordinal_twice_is_refused(spark, store, configs):
    with pytest.raises(ValueError, match="ordinal"):
        refreshed(spark, store, configs, [("1010001", 0, '{"id": "a"}'), ("1010001", 0, '{"id": "b"}')])
    assert store.version() == 0 and store.rows().count() == 0


def test_batches_are_known_by_number(spark, store, configs):
    assert refreshed(spark, store, configs, ROWS[:2], source=("s", 0))["1010001"][3] == 2
    assert store.last_batch("s") == 0 and store.last_batch("t") is None
    version = store.version()
    refreshed(spark, store, configs, [("1010001", 0, '{"id": "zz"}')], source=("s", 0))
    assert store.version() == version
    assert refreshed(spark, store, configs, [("1010001", 0, '{"id": "zz"}')], source=("s", 1))["1010001"][3] == 1


def test_queries_leave_no_store_behind(spark):
    from harvest.session import checkpoint_dir
    folder = os.path.join(checkpoint_dir(spark).removeprefix("file:"), "harvest")
    names = lambda: {n for n in os.listdir(folder) if n.startswith(("store-", "stream-"))} if os.path.isdir(folder) else set()
    before = names()
    assert E.queries()["store_totals"](spark, SF).count() == 6
    assert names() == before and not [t.name for t in spark.catalog.listTables() if t.name.startswith("harvest_keys_")]


def test_payloads_of_one_small_file_are_made_in_many_tasks(spark, tmp_path):
    """One small file of events is one scan task; payloads are made in as many tasks as a shuffle has, one for each event, odd ones included."""
    import datetime as dt
    import pyarrow as pa
    import pyarrow.parquet as pq
    from harvest.plans.q_load import event_payload_rows
    at = [dt.datetime(2024, 1, 2, 3, 4, 5), None] * 20
    pq.write_table(pa.table({"event_id": pa.array([i // 2 for i in range(40)], pa.int64()), "ts": pa.array(at, pa.timestamp("us")), "user_id": pa.array([None] * 40, pa.int64()),
                             "event_type": ["view", "click", None, "purchase"] * 10, "value": [500.0] * 40, "props": ['{"k": 3}', None] * 20}), str(tmp_path / "events.parquet"))
    rows = event_payload_rows(spark, str(tmp_path))
    assert rows.rdd.getNumPartitions() == int(spark.conf.get("spark.sql.shuffle.partitions"))
    assert sorted(r["_ord"] for r in rows.collect()) == sorted(i // 2 for i in range(40))
