import json
import os

from pyspark.sql import functions as F

from harvest.sinks import evolve_union, write_csv_report, write_json_snapshot, write_keyed_layout
from harvest.sources import landing
from harvest.sources.files import file_inventory
from harvest.sources.pages import page_metadata

PORTAL = """<html><head><title>農產品價格 - 農業資料開放平臺</title></head><body>
<div class="data-title-wrapper"><span>瀏覽次數 10</span><span>資料更新日期：無</span><span><b>資料更新日期</b>：2025/03/04 05:06:07</span></div>
<div class="data-search data-content"><div class="search-input"><label class="label">無關</label></div>
<div class="search-input"><p>skip me</p></div></div>
<div class="data-search data-content">
<div class="search-input"><label class="label">資料分類</label></div><div class="search-input"><p>農糧</p></div>
<div class="search-input"><span class="label">資料評分</span></div><div class="search-input"><p>5</p></div>
<div class="search-input"><label class="label bold">提供單位</label></div><div class="search-input wide"><a href="/org">農業部</a></div>
<div class="search-input"><span class="labelled">不是標籤</span></div><div class="search-input"><p>x</p></div>
<div class="search-input"><label class="label">資料分類</label></div><div class="search-input"><p>漁業</p></div>
<div class="search-input"><label class="label">資料介接</label></div><div class="search-input"><a href="/api/v1/data?x=1">JSON</a></div>
</div></body></html>"""


def test_portal_page_fields(spark):
    pages = spark.createDataFrame([(1, "https://data.example.gov/ds/9", PORTAL),
                                   (2, "https://x/y", "<title>t</title><span>nothing</span>")],
                                  "page_id long, url string, html string")
    got = {r.page_id: r for r in page_metadata(pages).collect()}
    p = got[1]
    assert p.title == "農產品價格" and p.category == "漁業" and p.provider == "農業部"   # last label wins
    assert p.api_url == "https://data.example.gov/api/v1/data?x=1"
    assert p.updated_at_src == "2025/03/04 05:06:07" and p.complete
    assert got[2].updated_at_src is None and not got[2].complete


def test_landed_pages_shapes(spark, tmp):
    d = os.path.join(tmp, "landing")
    os.makedirs(d)
    bodies = {"ds1_0.json": json.dumps([{"a": 1}, 2, "x", None, {"a": 2, "b": [1]}]),
              "ds1_1000.json": json.dumps({"a": 3}), "ds1_2000.json": "not json", "ds2_0.json": "[]"}
    for n, b in bodies.items():
        with open(os.path.join(d, n), "w") as f:
            f.write(b)
    pages = landing.read_landed_pages(spark, d)
    rows = landing.object_rows(pages).select("dataset_id", "skip", "pos", F.try_variant_get("v", "$.a", "int")).collect()
    assert sorted(tuple(r) for r in rows) == [("ds1", 0, 0, 1), ("ds1", 0, 4, 2)]
    m = spark.createDataFrame([("d", 0, 10), ("d", 1000, 1000), ("d", 2000, 0), ("e", 0, 0)],
                              "dataset_id string, skip long, n_rows long")
    assert dict(landing.last_live_page(m).collect()) == {"d": 1000, "e": None}
    with open(os.path.join(tmp, "one.json"), "w") as f:
        f.write(json.dumps({"k": 1}))
    assert landing.read_json_records(spark, os.path.join(tmp, "one.json")).count() == 1
    for name, text in (("list", '[{"k": 2, "x": {"y": null}}, 5, "junk", null, {"k": 3}]'), ("bad", "not json"), ("value", "7"), ("nothing", "")):
        with open(os.path.join(tmp, f"{name}.json"), "w") as f:
            f.write(text)
    some = landing.read_json_records(spark, [os.path.join(tmp, f"{n}.json") for n in ("one", "list", "bad", "value", "nothing")])
    assert sorted(r.k for r in some.collect()) == [1, 2, 3]
    typed = landing.read_json_records(spark, [os.path.join(tmp, f"{n}.json") for n in ("list", "bad")], "k int")
    assert sorted(tuple(r) for r in typed.collect()) == [(2,), (3,)]
    assert landing.read_json_records(spark, os.path.join(tmp, "bad.json")).count() == 0


def test_sinks_round_trip(spark, tmp):
    store = spark.createDataFrame([(1, "a")], "id long, v string")
    batch = spark.createDataFrame([(2, "b", 1.5)], "id long, `v` string, `new col` double")
    out = evolve_union(store, batch)
    assert out.columns == ["id", "v", "new_col"] and out.count() == 2
    drifted = evolve_union(store, spark.createDataFrame([(3, 7)], "id long, v long"))     # text meets a number: text
    assert sorted(tuple(r) for r in drifted.collect()) == [(1, "a"), (3, "7")]
    write_json_snapshot(out, os.path.join(tmp, "snap"))
    back = spark.read.json(os.path.join(tmp, "snap"))
    assert back.count() == 2 and "new_col" in back.columns
    write_csv_report(out, os.path.join(tmp, "csv"))
    assert spark.read.option("header", True).csv(os.path.join(tmp, "csv")).count() == 2
    parts = [p for p in os.listdir(os.path.join(tmp, "csv")) if p.startswith("part")]
    assert all(open(os.path.join(tmp, "csv", p), "rb").read().startswith(b"\xef\xbb\xbfid,") for p in parts)
    write_keyed_layout(spark, out, "layout_t", ["id"], 4, path=os.path.join(tmp, "layout"))
    assert spark.table("layout_t").count() == 2
    spark.sql("DROP TABLE layout_t")


def test_file_inventory(spark, tmp):
    d = os.path.join(tmp, "docs")
    os.makedirs(d)
    with open(os.path.join(d, "a.pdf"), "wb") as f:
        f.write(b"x" * 2048)
    with open(os.path.join(d, "b.txt"), "wb") as f:
        f.write(b"y")
    rows = file_inventory(spark, d).collect()
    assert [(r.file_name, r.stem, r.bytes, r.file_size) for r in rows] == [("a.pdf", "a", 2048, "2.00 KB")]


def test_table_level_catalog(spark, tmp):
    from harvest.operators import catalog
    t = catalog.table_for
    spark.createDataFrame([(1,)], "x int").write.mode("overwrite").option("path", tmp + "/t1").saveAsTable(t("1010001"))
    spark.createDataFrame([(1,)], "x int").write.mode("overwrite").option("path", tmp + "/t2").saveAsTable(t("1010001", True))
    assert catalog.table_exists(spark, t("1010001")) and catalog.table_columns(spark, t("1010001")) == ["x"]
    names = {r.table_name for r in catalog.existing_tables(spark).collect()}
    assert {"1010001", "1010001_processed"} <= names
    assert catalog.rename_dataset_tables(spark, "1010001", "1010009")
    assert catalog.table_exists(spark, t("1010009", True)) and not catalog.table_exists(spark, t("1010001"))
    assert not catalog.rename_dataset_tables(spark, "1010009", "1010009")
    catalog.drop_dataset_tables(spark, "1010009", processed_only=True)
    assert catalog.table_exists(spark, t("1010009")) and not catalog.table_exists(spark, t("1010009", True))
    catalog.drop_dataset_tables(spark, "1010009")
    assert not catalog.table_exists(spark, t("1010009"))


def test_replace_datasets_and_observed_counts(spark, tmp):
    from harvest.operators.report import observe_counts
    from harvest.sinks import append, replace_datasets
    path = os.path.join(tmp, "rows")
    append(spark.createDataFrame([("a", 1), ("a", 2), ("b", 3)], "dataset_id string, x int"), path)
    replace_datasets(spark.createDataFrame([("a", 9)], "dataset_id string, x int"), path)   # K02: only dataset a
    got = sorted((r.dataset_id, r.x) for r in spark.read.parquet(path).collect())
    assert got == [("a", 9), ("b", 3)]
    df, obs = observe_counts(spark.createDataFrame([(1,), (2,)], "x int"), "load")
    df.write.format("noop").mode("overwrite").save()
    assert obs.get["rows"] == 2


def test_ensure_table_creates_once(spark, tmp):
    from harvest.sinks import FILES_SCHEMA, ensure_table
    assert ensure_table(spark, "ds_files_t", FILES_SCHEMA, path=os.path.join(tmp, "files"))
    assert not ensure_table(spark, "ds_files_t", FILES_SCHEMA)
    assert spark.table("ds_files_t").columns[:2] == ["file_id", "file_path"]
    spark.sql("DROP TABLE ds_files_t")


def test_snapshot_restore(spark, tmp):
    d = os.path.join(tmp, "hand")
    os.makedirs(d)
    docs = {"interruption_record_20250101_000000.json": {"date": "2025/01/01 00:00:00", "name": "a", "url": "u",
                                                         "false_at_skip": 3000, "interruption_record": [{"x": 1}]},
            "interruption_record_20250301_120000.json": {"date": "2025/03/01 12:00:00", "name": "b", "url": "u2",
                                                         "false_at_skip": 1000,
                                                         "interruption_record": [{"x": 2}, 5, {"x": 3}]},
            "interruption_record_bad.json": {"name": "c"}, "other.json": {"name": "d"}}
    for n, doc in docs.items():
        with open(os.path.join(d, n), "w") as f:
            f.write(json.dumps(doc))
    snaps = landing.read_snapshots(spark, d)
    assert snaps.count() == 3                     # the glob keeps snapshot files only
    rows = landing.restore_snapshot_rows(snaps).select("name", "resume_skip", "pos",
                                                       F.try_variant_get("v", "$.x", "int")).collect()
    assert sorted(tuple(r) for r in rows) == [("b", 1000, 0, 2), ("b", 1000, 2, 3)]
    per = landing.restore_snapshot_rows(snaps, per_dataset=True).select("name").distinct().collect()
    assert sorted(r.name for r in per) == ["a", "b"]


def test_portal_fields_by_structure(spark):
    """Divs inside a value, elements between label and value, labels without a value, references, pieces of text."""
    def field(label, value, between=""):
        return (f'<div class="row"><div><span class="x label">{label}</span>{between}</div>'
                f'<div class="search-input">{value}</div></div>')
    html = ('<title>甲 <b> 乙 </b>&#20013;&#x6587;&copy;&amp;lt;&unknown;&#xD800;</title><div class="data-title-wrapper"><div><i>x</i></div>'
            '<span>資料更新日期：<b>2025/01/02 03:04:05</b></span></div><div class="data-search data-content">'
            + field("資料分類", "<div><div>x</div></div><p>糧食</p>") + field("提供單位", "<div><p>農糧 <b>署</b></p></div>", "<i>?</i>")
            + '<div><span class="label">資料描述</span></div>' + field("更新頻率", "<em>none</em>") + "<p>outside</p>"
            + field("資料介接", '<div><a href="../api/x.json">x</a></div>') + "</div>")
    r = page_metadata(spark.createDataFrame([("http://h/p/q/r.html", html)], "url string, html string")).first()
    assert (r.title, r.category, r.provider, r.description, r.frequency) == ("甲乙中文©&lt;&unknown;&#xD800;", "糧食", "農糧署", None, None)
    assert r.api_url == "http://h/p/api/x.json" and r.updated_at_src == "2025/01/02 03:04:05" and r.complete


def _orders(path, n):
    import datetime as dt
    import os
    import pyarrow as pa
    import pyarrow.parquet as pq
    day = dt.datetime(1996, 2, 29, 1, 2, 3)
    pq.write_table(pa.table({"o_orderkey": pa.array(range(n), pa.int64()), "o_custkey": pa.array([None if i == 5 else i + 9 for i in range(n)], pa.int64()),
                             "o_orderstatus": [("F", "O", "P", None)[i % 4] for i in range(n)], "o_totalprice": [1.0] * n, "o_orderdate": pa.array([day] * n, pa.timestamp("us")),
                             "o_orderpriority": ["1-URGENT"] * n}), os.path.join(path, "orders.parquet"))


def test_portal_pages_are_dealt_over_tasks_and_read_once(spark, tmp_path):
    """One small file of orders is one scan task; its pages are read in as many tasks as a shuffle has, and no pattern is repeated for each use of its result."""
    from harvest.plans.q_sources import portal_metadata, portal_pages
    from harvest.sources.pages import page_metadata
    _orders(tmp_path, 40)
    pages = portal_pages(spark, str(tmp_path))
    assert pages.rdd.getNumPartitions() == int(spark.conf.get("spark.sql.shuffle.partitions"))
    import contextlib
    import io
    text = io.StringIO()
    with contextlib.redirect_stdout(text):
        page_metadata(pages).explain("extended")
    optimized = text.getvalue().split("== Optimized Logical Plan ==")[1].split("== Physical Plan ==")[0]
    assert 1 <= optimized.count("<a\\s[^>]*?href") <= 2          # the page's first link, and the one of the API field
    got = {r["page_id"]: r for r in portal_metadata(spark, str(tmp_path)).collect()}
    assert len(got) == 40
    assert got[22]["description"] == "deep" and got[23]["description"] == "中<23>"
    assert got[7]["provider"] == "Clerk &Co" and got[8]["provider"] == "Clerk 17" and got[8]["frequency"] == "daily"
    assert got[6]["api_url"] == "http://portal.example/list/api/6.json?x=1" and got[6]["first_link"] == "http://portal.example/home/index.html"
    assert got[6]["updated_at_src"] == "1996/02/29 01:02:03" and got[10]["updated_at_src"] is None
