import json
import os

import pytest
from pyspark.sql import functions as F

from harvest.sources.landing import land_pages, read_page_log
from harvest.store import Store
from harvest.streaming.ingest import run_ingest


def _land(d, name, rows):
    with open(os.path.join(d, name), "w") as f:
        f.write(json.dumps(rows))


@pytest.fixture()
def places(spark, tmp):
    landing, ck = os.path.join(tmp, "landing"), os.path.join(tmp, "ck")
    os.makedirs(landing)
    store = Store(spark, os.path.join(tmp, "store"))
    yield landing, store, ck
    store.close()


def _stored(store):
    return sorted((r.dataset_id, json.loads(r.record)["id"], r.seq) for r in store.rows().collect())


def test_ingest_is_incremental_and_resumable(spark, places):
    landing, store, ck = places
    _land(landing, "ds1_0.json", [{"id": 1, "v": "a"}, {"id": 2, "v": "b"}, 5])
    _land(landing, "ds1_1000.json", [{"id": 3, "v": "c"}])
    _land(landing, "stray.json", [{"id": 99}])
    run_ingest(spark, landing, store, ck, ["id"])
    assert _stored(store) == [("ds1", 1, 1), ("ds1", 2, 2), ("ds1", 3, 3)]
    assert [tuple(r)[1:] for r in store.outcomes().collect()] == [("incremental", "updated", 3, 3, 3, 3)]
    run_ingest(spark, landing, store, ck, ["id"])                  # nothing new landed
    assert store.rows().count() == 3
    _land(landing, "ds1_2000.json", [{"id": 3, "v": "c"}, {"id": 4, "v": "d"}])   # re-download + one new row
    run_ingest(spark, landing, store, ck, ["id"])
    assert [x[1:] for x in _stored(store)] == [(1, 1), (2, 2), (3, 3), (4, 4)]


def test_replay_after_injected_failure_and_schema_drift(spark, places):
    landing, store, ck = places
    _land(landing, "ds9_0.json", [{"id": 1, "v": "a"}, {"id": 2, "v": "b"}])

    def boom(epoch_id):
        raise RuntimeError("executor lost after the write")

    with pytest.raises(Exception):
        run_ingest(spark, landing, store, ck, ["id"], after_write=boom)
    version = store.version()
    assert store.rows().count() == 2          # stored, but the stream never committed the batch
    run_ingest(spark, landing, store, ck, ["id"])            # the batch is replayed ...
    assert store.rows().count() == 2 and store.version() == version          # ... and known by its number
    _land(landing, "ds9_1000.json", [{"id": 3, "v": "c", "extra": {"x": 1}}])   # a new field appears
    run_ingest(spark, landing, store, ck, ["id"])
    rows = {json.loads(r.record)["id"]: r for r in store.rows().collect()}
    assert sorted(rows) == [1, 2, 3] and '"extra"' in rows[3].record
    assert sorted(r.seq for r in rows.values()) == [1, 2, 3]


def test_keys_are_scoped_by_dataset(spark, places):
    landing, store, ck = places
    _land(landing, "dsA_0.json", [{"id": 1}, {"id": 2}])
    run_ingest(spark, landing, store, ck, ["id"])
    _land(landing, "dsB_0.json", [{"id": 1}])          # same key value, other dataset: new
    _land(landing, "dsA_1000.json", [{"id": 2}, {"id": 3}])
    run_ingest(spark, landing, store, ck, ["id"])
    assert _stored(store) == [("dsA", 1, 1), ("dsA", 2, 2), ("dsA", 3, 3), ("dsB", 1, 1)]


def test_known_keys_are_read_by_dataset(spark, places):
    """A batch reads the index of its own datasets; beyond PRUNE_MAX_DATASETS by a semi-join."""
    from harvest.plans import refresh
    known = spark.createDataFrame([("1010001", "a"), ("0990003", "b")], "dataset_id string, key string")
    ids = spark.createDataFrame([("0990003",)], "dataset_id string")
    for bound in (1000, 0):
        before, refresh.PRUNE_MAX_DATASETS = refresh.PRUNE_MAX_DATASETS, bound
        try:
            assert [tuple(r) for r in refresh._of_datasets(known, ids).collect()] == [("0990003", "b")]
        finally:
            refresh.PRUNE_MAX_DATASETS = before


def test_page_log(spark, places):
    """100,000 pages in few files; a page that is landed again counts as it was landed last; streamed like files."""
    landing, store, ck = places
    pages = spark.range(100_000).select(F.concat(F.lit("d"), F.col("id") % 10).alias("dataset_id"), (F.floor(F.col("id") / 10) * 1000).cast("long").alias("skip"),
                                        F.concat(F.lit('[{"id": '), F.col("id").cast("string"), F.lit("}]")).alias("body")).repartition(200)
    land_pages(pages, landing)
    names = [n for n in os.listdir(landing) if n.endswith(".parquet")]
    assert len(names) <= 100
    land_pages(spark.createDataFrame([("d0", 0, '[{"id": "again"}]'), ("d0", 0, '[{"id": "again"}]'), ("d0", 1, "no JSON")], "dataset_id string, skip long, body string"), landing)
    log = read_page_log(spark, landing)
    assert log.count() == 100_001 and [r.body for r in log.where("dataset_id = 'd0' AND skip = 0").collect()] == ['[{"id": "again"}]']
    run_ingest(spark, landing, store, ck, ["id"], page_log=True, glob="*.parquet")
    totals = {r.dataset_id: (r.row_count, r.max_seq) for r in store.totals().collect()}
    assert totals == {f"d{k}": (10_000 + (k == 0),) * 2 for k in range(10)}
    got = {r.dataset_id: (r.downloaded, r.unique_rows, r.new_rows) for r in store.outcomes().collect()}
    assert got["d0"] == (10_002, 10_001, 10_001) and got["d1"] == (10_000,) * 3
