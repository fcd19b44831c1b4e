"""Source queries: landed JSON pages built from events, page audit, snapshots, HTML pages."""

from __future__ import annotations

from pyspark.sql import functions as F

from harvest.plans.registry import register
from harvest.session import read_table
from harvest.sources import landing, pages as page_src

PAGE = 1000


def landed_bodies(spark, sf):
    """Events landed as JSON pages of 1000 event ids: for every page an array
    body (its events' props objects plus junk elements), an object body (a
    rate-limit reply) and a non-JSON body. A page holds at most 1000 rows."""
    ev = read_table(spark, sf, "events")
    page = F.floor(F.col("event_id") / PAGE).cast("int")
    grouped = ev.groupBy(page.alias("page")).agg(
        F.array_sort(F.collect_list(F.struct("event_id", "props"))).alias("_e"))
    body = F.concat(F.lit("["), F.array_join(F.transform("_e", lambda x: x["props"]), ","),
                    F.lit(',7,"junk",null,[1]]'))
    arrays = grouped.select(F.lit("events").alias("dataset_id"), (F.col("page") * PAGE).alias("skip"), body.alias("body"))
    objects = grouped.select(F.lit("events").alias("dataset_id"), (F.col("page") * PAGE + 1).alias("skip"),
                             F.lit('{"error":"rate limited"}').alias("body"))
    broken = grouped.select(F.lit("events").alias("dataset_id"), (F.col("page") * PAGE + 2).alias("skip"),
                            F.lit("<html>busy</html>").alias("body"))
    return arrays.unionByName(objects).unionByName(broken)


_BODIES_SQL = """(
  SELECT CAST(floor(event_id / 1000) AS INTEGER) * 1000 AS skip,
         '[' || string_agg(props, ',' ORDER BY event_id) || ',7,"junk",null,[1]]' AS body
  FROM events GROUP BY floor(event_id / 1000)
  UNION ALL SELECT DISTINCT CAST(floor(event_id / 1000) AS INTEGER) * 1000 + 1, '{"error":"rate limited"}' FROM events
  UNION ALL SELECT DISTINCT CAST(floor(event_id / 1000) AS INTEGER) * 1000 + 2, '<html>busy</html>' FROM events)"""

_OBJECTS_SQL = f"""(
  SELECT skip, pos - 1 AS pos, e FROM (
    SELECT skip, unnest(CAST(CAST(body AS JSON) AS JSON[])) AS e,
           unnest(generate_series(1, CAST(json_array_length(CAST(body AS JSON)) AS BIGINT))) AS pos
    FROM {_BODIES_SQL} b WHERE json_valid(body) AND json_type(CAST(body AS JSON)) = 'ARRAY') x
  WHERE json_type(e) = 'OBJECT')"""


@register("json_object_rows", f"""
SELECT 'events' AS dataset_id, skip, CAST(pos AS INTEGER) AS pos, CAST(json_extract(e, '$.k') AS INTEGER) AS k
FROM {_OBJECTS_SQL} o""")
def json_object_rows(spark, sf):
    rows = landing.object_rows(landed_bodies(spark, sf))
    return rows.select("dataset_id", "skip", "pos", F.try_variant_get("v", "$.k", "int").alias("k"))


@register("page_assembly", f"""
SELECT skip, CAST(pos AS INTEGER) AS pos, CAST(json_extract(e, '$.k') AS INTEGER) AS k,
       row_number() OVER (ORDER BY skip, pos) AS row_index
FROM {_OBJECTS_SQL} o""")
def page_assembly(spark, sf):
    rows = landing.object_rows(landed_bodies(spark, sf))
    rows = rows.select("skip", "pos", F.try_variant_get("v", "$.k", "int").alias("k"))
    return landing.assembled_index(rows)


def event_manifest(spark, sf):
    """Landed pages per event type (1000 event ids per page), plus the empty
    page each dataset's last probe returned."""
    ev = read_table(spark, sf, "events")
    m = ev.groupBy(F.col("event_type").alias("dataset_id"),
                   (F.floor(F.col("event_id") / PAGE) * PAGE).cast("bigint").alias("skip")) \
        .agg(F.count(F.lit(1)).alias("n_rows"))
    probe = m.groupBy("dataset_id").agg((F.max("skip") + PAGE).alias("skip")) \
        .select("dataset_id", "skip", F.lit(0).cast("bigint").alias("n_rows"))
    return m.unionByName(probe)


_MANIFEST_SQL = """(
  SELECT event_type AS dataset_id, CAST(floor(event_id / 1000) * 1000 AS BIGINT) AS skip, count(*) AS n_rows
  FROM events GROUP BY 1, 2
  UNION ALL
  SELECT event_type, CAST(max(floor(event_id / 1000) * 1000) + 1000 AS BIGINT), 0 FROM events GROUP BY 1)"""


@register("last_live_page", f"""
SELECT dataset_id, CAST(floor(max(CASE WHEN n_rows > 0 THEN skip END) / 1000) * 1000 AS BIGINT) AS last_skip
FROM {_MANIFEST_SQL} m GROUP BY dataset_id""")
def last_live_page(spark, sf):
    return landing.last_live_page(event_manifest(spark, sf))


# As event_manifest, with pages of mixed length: of every seven, one returned 10,999 rows, and one was landed twice, cut short the first time.
_MIXED_SQL = f"""(
  SELECT dataset_id, skip, CASE WHEN skip // 1000 % 7 = 3 AND n_rows > 0 THEN 10999 WHEN n_rows > 0 THEN 1000 ELSE 0 END AS n_rows FROM {_MANIFEST_SQL} m WHERE skip // 1000 % 3 <> 1
  UNION ALL SELECT dataset_id, skip, 400 FROM {_MANIFEST_SQL} m WHERE skip // 1000 % 7 = 5 AND skip // 1000 % 3 <> 1)"""


def mixed_manifest(spark, sf):
    m = event_manifest(spark, sf).withColumn("page", F.floor(F.col("skip") / PAGE)).where("page % 3 <> 1")
    n = F.when((F.col("page") % 7 == 3) & (F.col("n_rows") > 0), 10_999).when(F.col("n_rows") > 0, PAGE).otherwise(0).cast("bigint")
    short = m.where("page % 7 = 5").select("dataset_id", "skip", F.lit(400).cast("bigint").alias("n_rows"))
    return m.select("dataset_id", "skip", n.alias("n_rows")).unionByName(short)


_REACH_SQL = f"""SELECT *, max(skip + n_rows) OVER (PARTITION BY dataset_id ORDER BY skip, n_rows ROWS UNBOUNDED PRECEDING) AS covered_to,
  max(skip + n_rows) OVER (PARTITION BY dataset_id ORDER BY skip, n_rows ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) AS reached,
  lead(skip) OVER (PARTITION BY dataset_id ORDER BY skip, n_rows) AS next_skip FROM {_MIXED_SQL} x"""


@register("page_gaps", f"SELECT dataset_id, skip, n_rows, covered_to, next_skip, next_skip - covered_to AS gap FROM ({_REACH_SQL}) r")
def page_gaps(spark, sf):
    return landing.page_gaps(mixed_manifest(spark, sf))


@register("page_coverage", f"""
SELECT dataset_id, count(*) AS pages, CAST(sum(n_rows) AS BIGINT) AS rows_returned,
  CAST(sum(greatest(skip + n_rows - greatest(skip, COALESCE(reached, skip)), 0)) AS BIGINT) AS covered,
  CAST(sum(n_rows) - sum(greatest(skip + n_rows - greatest(skip, COALESCE(reached, skip)), 0)) AS BIGINT) AS covered_again,
  CAST(COALESCE(sum(greatest(next_skip - covered_to, 0)), 0) AS BIGINT) AS missing
FROM ({_REACH_SQL}) r GROUP BY dataset_id""")
def page_coverage(spark, sf):
    return landing.page_coverage(mixed_manifest(spark, sf))


@register("latest_snapshot", """
SELECT dataset_id, file_name, resume_skip, snapshot_ts FROM (
  SELECT event_type AS dataset_id,
         'interruption_record_' || strftime(ts, '%Y%m%d_%H%M%S') || '.json' AS file_name,
         CAST(floor(event_id / 1000) * 1000 AS BIGINT) AS resume_skip,
         CAST(date_trunc('second', ts) AS TIMESTAMP) AS snapshot_ts,
         row_number() OVER (PARTITION BY event_type ORDER BY date_trunc('second', ts) DESC,
           'interruption_record_' || strftime(ts, '%Y%m%d_%H%M%S') || '.json' DESC,
           floor(event_id / 1000) DESC) AS rn
  FROM events) t WHERE rn = 1""")
def latest_snapshot(spark, sf):
    """Snapshot files named by time, one per event; newest per dataset wins."""
    ev = read_table(spark, sf, "events")
    snaps = ev.select(F.col("event_type").alias("dataset_id"),
                      F.concat(F.lit(landing.SNAPSHOT_PREFIX), F.date_format("ts", "yyyyMMdd_HHmmss"),
                               F.lit(".json")).alias("file_name"),
                      (F.floor(F.col("event_id") / PAGE) * PAGE).cast("bigint").alias("resume_skip"))
    return landing.latest_snapshot(snaps)


_RESOLVE_SQL = """CASE WHEN href IS NULL THEN NULL
  WHEN regexp_matches(href, '^[A-Za-z][A-Za-z0-9+.-]*:') THEN href
  WHEN starts_with(href, '//') THEN regexp_extract(url, '^([A-Za-z][A-Za-z0-9+.-]*):', 1) || ':' || href
  WHEN starts_with(href, '/') THEN regexp_extract(url, '^([A-Za-z][A-Za-z0-9+.-]*://[^/?#]*)', 1) || href
  WHEN href = '' THEN url
  WHEN starts_with(href, '?') THEN regexp_extract(url, '^([^?#]*)', 1) || href
  WHEN starts_with(href, '#') THEN regexp_extract(url, '^([^#]*)', 1) || href
  WHEN regexp_extract(regexp_extract(url, '^([^?#]*)', 1), '^[A-Za-z][A-Za-z0-9+.-]*://[^/]*(/.*)?$', 1) = ''
    THEN regexp_extract(url, '^([^?#]*)', 1) || '/' || href
  ELSE regexp_extract(regexp_extract(url, '^([^?#]*)', 1), '^(.*/)', 1) || href END"""


def _text_sql(x: str) -> str:
    s = "t"
    for ent, ch in (("&lt;", "<"), ("&gt;", ">"), ("&quot;", '"'), ("&#39;", "''"), ("&apos;", "''"),
                    ("&nbsp;", " "), ("&amp;", "&")):
        s = f"replace({s}, '{ent}', '{ch}')"
    return (f"array_to_string(list_transform(string_split_regex({x}, '<[^>]*>'), "
            f"lambda t: regexp_replace({s}, '^\\s+|\\s+$', '', 'g')), '')")


@register("page_metadata", f"""
SELECT page_id, url,
  regexp_replace({_text_sql("NULLIF(regexp_extract(html, '(?is)<title[^>]*>(.*?)</title>', 1), '')")},
                 '\\s*-\\s*農業資料開放平臺\\s*', '', 'g') AS title,
  {_text_sql("NULLIF(regexp_extract(html, '(?is)<h1[^>]*>(.*?)</h1>', 1), '')")} AS heading,
  {_RESOLVE_SQL} AS first_link,
  CAST(NULL AS VARCHAR) AS category, CAST(NULL AS VARCHAR) AS provider, CAST(NULL AS VARCHAR) AS published,
  CAST(NULL AS VARCHAR) AS frequency, CAST(NULL AS VARCHAR) AS description, CAST(NULL AS VARCHAR) AS source,
  CAST(NULL AS VARCHAR) AS api_url, CAST(NULL AS VARCHAR) AS updated_at_src, false AS complete
FROM (SELECT *, NULLIF(regexp_extract(html, '(?is)<a\\s[^>]*?href\\s*=\\s*["'']([^"'']*)["'']', 1), '') AS href
      FROM pages) p""")
def page_metadata(spark, sf):
    """S10 over the landed pages (these pages carry no portal fields, so the
    portal columns are NULL and ``complete`` is false; see the unit fixture)."""
    return page_src.page_metadata(read_table(spark, sf, "pages"))


def _portal_field(label, value):
    return f'<div class="row"><div><span class="x label">{label}</span></div><div class="search-input">{value}</div></div>'


def portal_pages(spark, sf):
    """A portal page for each order: a decoy block before the real one, divs inside values, values without a tag, labels without a value, a
    rating, divs that never end, character references, relative links, the update time in the title block, elsewhere, or missing."""
    # A short row becomes a page that takes thousands of times longer to read: rows are dealt evenly over the tasks, however few files they come from.
    o = read_table(spark, sf, "orders").repartition(int(spark.conf.get("spark.sql.shuffle.partitions")))
    key = F.col("o_orderkey")
    k, stamp = key.cast("string"), F.date_format("o_orderdate", "yyyy/MM/dd HH:mm:ss")
    block = '<div class="data-search data-content">'
    span = F.concat(F.lit("<span>資料更新日期：<b>"), stamp, F.lit("</b></span>"))
    wrapper = F.concat(F.lit('<div class="data-title-wrapper"><div><i>t</i></div>'), F.when(key % 5 > 1, span).otherwise(F.lit("")), F.lit("</div>"))
    values = F.format_string(
        _portal_field("資料分類", "<p>%s</p>") + _portal_field("提供單位", "%s") + _portal_field("資料評分", "<p>5</p>") + _portal_field("上架日期", "<p> %s </p>") + "%s"
        + _portal_field("資料描述", "%s") + _portal_field("原始資料來源", "<p></p>") + _portal_field("資料介接", '<div><a href="../api/%s.json?x=1">x</a></div>'),
        F.col("o_orderpriority"), F.when(key % 7 == 0, "<div><div>x</div></div><p>Clerk &amp; <b>Co</b></p>").otherwise(F.concat(F.lit("<p>Clerk "), F.col("o_custkey").cast("string"), F.lit("</p>"))),
        F.date_format("o_orderdate", "yyyy/MM/dd"),
        F.when(F.col("o_orderstatus") == "F", _portal_field("更新頻率", '<a href="#">daily</a>')).when(F.col("o_orderstatus") == "O", _portal_field("更新頻率", "<em>none</em>"))
        .otherwise('<div><span class="label">更新頻率</span></div>'),
        F.when(key % 11 == 0, "<div>" * 50 + "<p>deep</p>").otherwise(F.concat(F.lit("<p>&#20013;&lt;"), k, F.lit("&gt;</p>"))), k)
    html = F.concat(F.lit("<title>Order "), k, F.lit(' - 農業資料開放平臺</title><a href="/home/./x/../index.html">home</a>'), wrapper, F.lit("<h1>Order <b>"), k, F.lit("</b></h1>"),
                    F.when(key % 3 == 0, block + _portal_field("資料分類", "<p>decoy</p>") + "</div>").otherwise(""), F.lit(block), values, F.lit("</div>"),
                    F.when(key % 5 == 1, span).otherwise(F.lit("")))
    return o.select(F.col("o_orderkey").alias("page_id"), F.concat(F.lit("http://portal.example/list/"), k, F.lit("/view.html")).alias("url"), html.alias("html"))


@register("portal_metadata", """
SELECT o_orderkey AS page_id, 'http://portal.example/list/' || o_orderkey || '/view.html' AS url, 'Order ' || o_orderkey AS title, 'Order' || o_orderkey AS heading,
  'http://portal.example/home/index.html' AS first_link, o_orderpriority AS category,
  CASE WHEN o_orderkey % 7 = 0 THEN 'Clerk &Co' ELSE 'Clerk ' || o_custkey END AS provider, strftime(o_orderdate, '%Y/%m/%d') AS published,
  CASE WHEN o_orderstatus = 'F' THEN 'daily' END AS frequency, CASE WHEN o_orderkey % 11 = 0 THEN 'deep' ELSE '中<' || o_orderkey || '>' END AS description, '' AS source,
  'http://portal.example/list/api/' || o_orderkey || '.json?x=1' AS api_url,
  CASE WHEN o_orderkey % 5 > 0 THEN strftime(o_orderdate, '%Y/%m/%d %H:%M:%S') END AS updated_at_src, o_orderkey % 5 > 0 AS complete
FROM orders""")
def portal_metadata(spark, sf):
    """S10 + F11 + F12 + F13 on portal pages rendered from the orders: all fields of the metadata record."""
    return page_src.page_metadata(portal_pages(spark, sf))


@register("stream_ingest", """
SELECT event_type AS dataset_id, CAST(event_id AS VARCHAR) AS event_id,
       row_number() OVER (PARTITION BY event_type ORDER BY event_id) AS seq,
       event_type || lpad(CAST(row_number() OVER (PARTITION BY event_type ORDER BY event_id) AS VARCHAR), CAST(greatest(7, length(CAST(row_number() OVER (PARTITION BY event_type ORDER BY event_id) AS VARCHAR))) AS INTEGER), '0') AS row_id
FROM events""")
def stream_ingest(spark, sf):
    """T01 end to end: events are landed as JSON pages (one for each event type and 1000-id page) in a page log
    under the shared checkpoint folder, a Structured Streaming query (file source, availableNow, checkpointed)
    ingests them -- objects of each page, anti-join against the store's key index, ids after the stored
    maximum, one commit a batch -- and the store is returned."""
    import os
    import uuid
    from harvest.session import checkpoint_dir
    from harvest.sinks import delete_path
    from harvest.store import Store
    from harvest.streaming.ingest import run_ingest
    root = os.path.join(checkpoint_dir(spark), "harvest", f"stream-{uuid.uuid4().hex}")
    ev = read_table(spark, sf, "events")
    page = (F.floor(F.col("event_id") / PAGE) * PAGE).cast("bigint")
    grouped = ev.groupBy(F.col("event_type").alias("dataset_id"), page.alias("skip")).agg(
        F.array_sort(F.collect_list(F.struct("event_id", "user_id", "ts", "value"))).alias("_e"))
    pages = grouped.select("dataset_id", "skip", F.to_json(F.transform("_e", lambda e: F.struct(
        e["event_id"], e["user_id"], F.date_format(e["ts"], "yyyy/MM/dd HH:mm:ss").alias("ts"), e["value"]))).alias("body"))
    store = Store(spark, os.path.join(root, "store"))
    try:
        landing.land_pages(pages, os.path.join(root, "landing"))
        run_ingest(spark, os.path.join(root, "landing"), store, os.path.join(root, "ck"), ["event_id"], page_log=True)
        return store.rows().select("dataset_id", F.get_json_object("record", "$.event_id").alias("event_id"), "seq", "row_id").checkpoint()
    finally:
        store.close()
        delete_path(spark, root)
