"""Catalog, metadata and upsert queries over the test tables."""

from __future__ import annotations

import datetime as _dt
import os
import uuid

from pyspark.sql import functions as F

from harvest.functions.times import ts_lit
from harvest.functions.text import compose_id, processed_name
from harvest.operators import catalog as cat_ops
from harvest.operators import quality, upsert
from harvest.plans.registry import register
from harvest.plans.sqltext import human_size_sql
from harvest.session import read_table

NOW = _dt.datetime(2025, 6, 1, 0, 0, 0)          # fixed "now" of the test upserts
BEFORE = _dt.datetime(2025, 1, 1, 0, 0, 0)       # audit time of the stored rows


# ------------------------------------------------------------------ catalog
def nation_catalog(spark, sf):
    """Catalog: one dataset per nation; id 101 + 4-digit nation key; category = region."""
    n = read_table(spark, sf, "nation")
    r = read_table(spark, sf, "region")
    return (n.join(r, n["n_regionkey"] == r["r_regionkey"])
            .select(compose_id(F.lit("101"), F.col("n_nationkey"), 4).alias("dataset_id"),
                    F.col("n_name").alias("title"), F.lower("r_name").alias("category"),
                    F.col("n_nationkey").cast("bigint").alias("ord")))


CATALOG_SQL = """(SELECT '101' || lpad(CAST(n_nationkey AS VARCHAR), 4, '0') AS dataset_id, n_name AS title,
   lower(r_name) AS category, CAST(n_nationkey AS BIGINT) AS ord
 FROM nation JOIN region ON n_regionkey = r_regionkey)"""


def supplier_rows(spark, sf):
    s = read_table(spark, sf, "supplier")
    return s.select("s_suppkey", compose_id(F.lit("101"), F.col("s_nationkey"), 4).alias("dataset_id"))


@register("catalog_counts", f"""
SELECT c.dataset_id, c.title, c.category, c.ord, COALESCE(n.row_count, 0) AS row_count
FROM {CATALOG_SQL} c LEFT JOIN (
  SELECT '101' || lpad(CAST(s_nationkey AS VARCHAR), 4, '0') AS dataset_id, count(*) AS row_count
  FROM supplier GROUP BY 1) n ON c.dataset_id = n.dataset_id""")
def catalog_counts(spark, sf):
    return cat_ops.catalog_counts(nation_catalog(spark, sf), supplier_rows(spark, sf))


def processed_ids(spark, sf):
    c = read_table(spark, sf, "customer").where(F.col("c_acctbal") < 0)
    return c.select(compose_id(F.lit("101"), F.col("c_nationkey"), 4).alias("dataset_id")).distinct()


@register("catalog_listing", f"""
SELECT c.title, c.category, c.dataset_id, COALESCE(n.row_count, 0) AS row_count,
       c.dataset_id IN (SELECT '101' || lpad(CAST(c_nationkey AS VARCHAR), 4, '0') FROM customer WHERE c_acctbal < 0) AS has_processed
FROM {CATALOG_SQL} c LEFT JOIN (
  SELECT '101' || lpad(CAST(s_nationkey AS VARCHAR), 4, '0') AS dataset_id, count(*) AS row_count
  FROM supplier GROUP BY 1) n ON c.dataset_id = n.dataset_id
ORDER BY c.dataset_id""")
def catalog_listing(spark, sf):
    counted = cat_ops.catalog_counts(nation_catalog(spark, sf), supplier_rows(spark, sf))
    return cat_ops.catalog_listing(counted, processed_ids(spark, sf))


def supplier_idents(spark, sf):
    s = read_table(spark, sf, "supplier")
    a = s.select(compose_id(F.lit("101"), F.col("s_suppkey"), 4).alias("ident"))
    b = s.select(F.concat(F.lit("ON_"), F.col("s_nationkey").cast("string")).alias("ident"))
    return a.unionByName(b).distinct()


_IDENTS_SQL = """(SELECT '101' || lpad(CAST(s_suppkey AS VARCHAR), 4, '0') AS ident FROM supplier
  UNION SELECT 'ON_' || CAST(s_nationkey AS VARCHAR) FROM supplier)"""


@register("catalog_lookup", f"""
SELECT h.dataset_id, h.ident, c.title, c.category, c.ord FROM (
  SELECT ident, dataset_id, row_number() OVER (PARTITION BY ident ORDER BY prio, ord) AS rn FROM (
    SELECT ident, dataset_id, 0 AS prio, ord FROM {_IDENTS_SQL} i JOIN {CATALOG_SQL} c ON c.dataset_id = i.ident
    UNION ALL
    SELECT ident, dataset_id, 1 AS prio, ord FROM {_IDENTS_SQL} i JOIN {CATALOG_SQL} c ON strpos(c.title, i.ident) > 0) u
) h JOIN {CATALOG_SQL} c USING (dataset_id) WHERE h.rn = 1""")
def catalog_lookup(spark, sf):
    return cat_ops.catalog_lookup(nation_catalog(spark, sf), supplier_idents(spark, sf))


def search_keywords(spark, sf):
    s = read_table(spark, sf, "supplier")
    r = read_table(spark, sf, "region")
    return (s.select(F.concat(F.lit("Nation_"), F.col("s_nationkey").cast("string")).alias("keyword"))
            .unionByName(s.select(compose_id(F.lit("101"), F.col("s_suppkey"), 4).alias("keyword")))
            .unionByName(r.select(F.concat(F.lower("r_name"), F.lit("!")).alias("keyword")))
            .distinct())


@register("catalog_search", f"""
WITH kw AS (
  SELECT keyword, lower(trim(regexp_replace(keyword, '[^A-Za-z0-9_\\s]', '', 'g'))) AS k FROM (
    SELECT 'Nation_' || CAST(s_nationkey AS VARCHAR) AS keyword FROM supplier
    UNION SELECT '101' || lpad(CAST(s_suppkey AS VARCHAR), 4, '0') FROM supplier
    UNION SELECT lower(r_name) || '!' FROM region) x),
hits AS (
  SELECT kw.keyword, c.*, (c.title = kw.k OR c.dataset_id = kw.k) AS exact
  FROM kw JOIN {CATALOG_SQL} c
    ON kw.k <> '' AND (c.title = kw.k OR c.dataset_id = kw.k OR strpos(lower(c.title), kw.k) > 0
       OR strpos(c.dataset_id, kw.k) > 0 OR strpos(c.category, kw.k) > 0)),
firsts AS (
  SELECT keyword, dataset_id, title, category, exact FROM (
    SELECT *, row_number() OVER (PARTITION BY keyword ORDER BY ord) AS rn FROM hits WHERE exact) t WHERE rn = 1)
SELECT * FROM firsts
UNION ALL
SELECT keyword, dataset_id, title, category, exact FROM hits
WHERE NOT exact AND keyword NOT IN (SELECT keyword FROM firsts)""")
def catalog_search(spark, sf):
    return cat_ops.catalog_search(nation_catalog(spark, sf), search_keywords(spark, sf))


@register("catalog_category", f"""
SELECT c.dataset_id, c.title, c.category, c.ord FROM {CATALOG_SQL} c
WHERE c.category = (SELECT lower(r_name) FROM region WHERE r_regionkey = 2) ORDER BY c.dataset_id""")
def catalog_category(spark, sf):
    """The datasets of one category (the category named by region 2), ordered by id."""
    name = read_table(spark, sf, "region").where(F.col("r_regionkey") == 2).select(F.lower("r_name").alias("category"))
    return cat_ops.category_datasets(nation_catalog(spark, sf), name).select("dataset_id", "title", "category", "ord")


@register("row_text_search", """
SELECT * FROM customer c WHERE strpos(lower(CAST(to_json(c) AS VARCHAR)), 'furniture') > 0""")
def row_text_search(spark, sf):
    return cat_ops.row_text_search(read_table(spark, sf, "customer"), "FURNITURE")


# ---------------------------------------------------------------- reconcile
def table_names(spark, sf):
    c = read_table(spark, sf, "customer")
    s = read_table(spark, sf, "supplier")
    raw = c.select(compose_id(F.lit("101"), F.col("c_nationkey") + 5, 4).alias("table_name"))
    proc = s.select(processed_name(compose_id(F.lit("101"), F.col("s_nationkey") + 10, 4)).alias("table_name"))
    return raw.unionByName(proc).distinct()


_RECONCILE_SQL = f"""
WITH t1 AS (SELECT dataset_id AS id, title, true AS in_catalog FROM {CATALOG_SQL} c),
t2 AS (SELECT DISTINCT '101' || lpad(CAST(c_nationkey + 5 AS VARCHAR), 4, '0') AS id, true AS in_raw FROM customer),
t3 AS (SELECT DISTINCT '101' || lpad(CAST(s_nationkey + 10 AS VARCHAR), 4, '0') AS id,
         '101' || lpad(CAST(s_nationkey + 10 AS VARCHAR), 4, '0') || '_processed' AS processed_name,
         true AS in_processed FROM supplier),
j AS (SELECT COALESCE(t1.title, '') AS title, COALESCE(t1.id, t2.id, t3.id, '') AS dataset_id,
         COALESCE(t3.processed_name, '') AS processed_name,
         COALESCE(t1.in_catalog, false) AS in_catalog, COALESCE(t2.in_raw, false) AS in_raw,
         COALESCE(t3.in_processed, false) AS in_processed
      FROM t1 FULL JOIN t2 ON t1.id = t2.id FULL JOIN t3 ON COALESCE(t1.id, t2.id) = t3.id)"""


@register("reconcile", _RECONCILE_SQL + " SELECT * FROM j")
def reconcile(spark, sf):
    return cat_ops.reconcile(nation_catalog(spark, sf), table_names(spark, sf))


@register("orphan_entries", _RECONCILE_SQL + " SELECT * FROM j WHERE in_catalog AND NOT in_raw AND NOT in_processed")
def orphan_entries(spark, sf):
    return cat_ops.orphan_entries(reconcile(spark, sf))


def customer_rows(spark, sf):
    c = read_table(spark, sf, "customer")
    return c.select("c_custkey", "c_name", compose_id(F.lit("101"), F.col("c_nationkey"), 4).alias("dataset_id"))


def both_frames(parent, rows, key, name):
    """The catalog and the rows that hang on it, one below the other."""
    return (parent.select(F.lit("parent").alias("frame"), F.lit(None).cast("bigint").alias("row_key"), F.col("title").alias("name"), "dataset_id")
            .unionByName(rows.select(F.lit("rows").alias("frame"), F.col(key).cast("bigint").alias("row_key"), F.col(name).alias("name"), "dataset_id")))


@register("cascade_delete", f"""
SELECT 'parent' AS frame, CAST(NULL AS BIGINT) AS row_key, c.title AS name, c.dataset_id FROM {CATALOG_SQL} c
WHERE c.category <> 'africa'
UNION ALL
SELECT 'rows', CAST(c_custkey AS BIGINT), c_name, '101' || lpad(CAST(c_nationkey AS VARCHAR), 4, '0') AS dataset_id
FROM customer WHERE c_nationkey NOT IN (SELECT n_nationkey FROM nation WHERE n_regionkey = 0)""")
def cascade_delete(spark, sf):
    catalog = nation_catalog(spark, sf)
    doomed = catalog.where(F.col("category") == "africa")
    out = cat_ops.cascade_delete(catalog, {"rows": (customer_rows(spark, sf), "dataset_id")}, doomed)
    return both_frames(out["parent"], out["rows"], "c_custkey", "c_name")


@register("rekey", f"""
SELECT 'parent' AS frame, CAST(NULL AS BIGINT) AS row_key, c.title AS name,
  CASE WHEN c.dataset_id = '1010003' THEN '1010099' ELSE c.dataset_id END AS dataset_id FROM {CATALOG_SQL} c
UNION ALL
SELECT 'rows', CAST(s_suppkey AS BIGINT), NULL, CASE WHEN dataset_id = '1010003' THEN '1010099' ELSE dataset_id END AS dataset_id
FROM (SELECT s_suppkey, '101' || lpad(CAST(s_nationkey AS VARCHAR), 4, '0') AS dataset_id FROM supplier) t""")
def rekey(spark, sf):
    catalog = nation_catalog(spark, sf)
    out = cat_ops.rekey({"catalog": (catalog, "dataset_id"), "rows": (supplier_rows(spark, sf), "dataset_id")},
                        "1010003", "1010099", catalog.select("dataset_id"))
    return both_frames(out["catalog"], out["rows"].withColumn("_name", F.lit(None).cast("string")), "s_suppkey", "_name")


@register("key_violations", """
SELECT 'duplicate_key' AS kind, to_json({'l_orderkey': l_orderkey, 'l_linenumber': l_linenumber})::VARCHAR AS key,
       count(*) AS n_rows
FROM lineitem GROUP BY l_orderkey, l_linenumber HAVING count(*) > 1
UNION ALL
SELECT 'orphan', CAST(l_partkey AS VARCHAR), count(*) FROM lineitem
WHERE l_partkey NOT IN (SELECT p_partkey FROM part WHERE p_size > 5) GROUP BY l_partkey""")
def key_violations(spark, sf):
    li = read_table(spark, sf, "lineitem")
    parts = read_table(spark, sf, "part").where(F.col("p_size") > 5)
    return cat_ops.key_violations(li, ["l_orderkey", "l_linenumber"], parts, "l_partkey", "p_partkey")


@register("dataset_tables", f"""
SELECT '101' || lpad(CAST(n_nationkey AS VARCHAR), 4, '0') AS dataset_id, title, has_table, has_processed, CASE WHEN has_table THEN 3 END AS n_columns FROM (
  SELECT n_nationkey, n_name AS title, n_nationkey IN (SELECT s_nationkey FROM supplier) AND n_regionkey = 1 AS has_table,
         n_nationkey IN (SELECT s_nationkey FROM supplier WHERE s_acctbal < 0) AND n_regionkey = 1 AS has_processed FROM nation) t""")
def dataset_tables(spark, sf):
    """S07 + S12 + J06: the tables of one region's datasets are made (raw, and processed where a supplier is in debt), listed in the session's
    catalog, described, set against the catalog of datasets and dropped again."""
    from harvest.session import checkpoint_dir
    from harvest.sinks import delete_path
    root = os.path.join(checkpoint_dir(spark), "harvest", f"tables-{uuid.uuid4().hex}")
    rows = read_table(spark, sf, "supplier").join(read_table(spark, sf, "nation").where("n_regionkey = 1"), F.col("s_nationkey") == F.col("n_nationkey"))
    rows = rows.select(compose_id(F.lit("101"), F.col("s_nationkey"), 4).alias("dataset_id"), "s_suppkey", "s_name", "s_acctbal").checkpoint()
    made = []
    try:
        for processed, part in ((False, rows), (True, rows.where("s_acctbal < 0"))):
            for r in part.select("dataset_id").distinct().collect():          # five datasets of the region at most
                made.append((r.dataset_id, processed))
                part.where(F.col("dataset_id") == r.dataset_id).drop("dataset_id").write.option("path", os.path.join(root, cat_ops.table_for(*made[-1]))).saveAsTable(cat_ops.table_for(*made[-1]))
        names = cat_ops.existing_tables(spark)
        columns = spark.createDataFrame([(i, len(cat_ops.table_columns(spark, cat_ops.table_for(i)))) for i, p in made if not p and cat_ops.table_exists(spark, cat_ops.table_for(i))],
                                        "dataset_id string, n_columns int")
        found = cat_ops.reconcile(nation_catalog(spark, sf), names).where("in_catalog").select("dataset_id", "title", F.col("in_raw").alias("has_table"), F.col("in_processed").alias("has_processed"))
        return found.join(columns, "dataset_id", "left").checkpoint()
    finally:
        for dataset_id, processed in made:
            cat_ops.drop_dataset_tables(spark, dataset_id, processed_only=processed)
        delete_path(spark, root)


@register("export_roundtrip", """
SELECT 'json' AS kind, c_custkey, c_name, CASE WHEN c_acctbal >= 0 THEN c_mktsegment END AS segment FROM customer
UNION ALL SELECT 'csv', c_custkey, c_name, CASE WHEN c_acctbal >= 0 THEN c_mktsegment END FROM customer""")
def export_roundtrip(spark, sf):
    """K03 + K08: a JSON snapshot and a CSV report (byte order mark, header) of the customers, read back; NULL fields survive both."""
    from harvest.session import checkpoint_dir
    from harvest.sinks import delete_path, write_csv_report, write_json_snapshot
    root = os.path.join(checkpoint_dir(spark), "harvest", f"export-{uuid.uuid4().hex}")
    c = read_table(spark, sf, "customer").select("c_custkey", "c_name", F.when(F.col("c_acctbal") >= 0, F.col("c_mktsegment")).alias("segment"))
    schema = "c_custkey bigint, c_name string, segment string"
    try:
        write_json_snapshot(c, os.path.join(root, "json"))
        write_csv_report(c, os.path.join(root, "csv"))
        back = spark.read.schema(schema).json(os.path.join(root, "json")).select(F.lit("json").alias("kind"), "*")
        return back.unionByName(spark.read.schema(schema).option("header", True).csv(os.path.join(root, "csv")).select(F.lit("csv").alias("kind"), "*")).checkpoint()
    finally:
        delete_path(spark, root)


# ------------------------------------------------------------------- files
def page_files(spark, sf):
    p = read_table(spark, sf, "pages")
    lang = F.regexp_extract("url", r"^[a-z]+://[^/]+/([a-z]+)/", 1)
    return p.select(F.concat(F.lit("f"), F.col("page_id").cast("string")).alias("file_id"),
                    F.concat(F.lit("/srv/pages/"), F.col("page_id").cast("string"), F.lit(".html")).alias("file_path"),
                    lang.alias("file_type"),
                    F.concat(F.lit("r"), F.floor(F.col("page_id") / 10).cast("string")).alias("record_id"))


_PAGE_FILES_SQL = """(SELECT 'f' || CAST(page_id AS VARCHAR) AS file_id,
   '/srv/pages/' || CAST(page_id AS VARCHAR) || '.html' AS file_path,
   regexp_extract(url, '^[a-z]+://[^/]+/([a-z]+)/', 1) AS file_type,
   'r' || CAST(floor(page_id / 10) AS BIGINT) AS record_id, url FROM pages)"""


@register("related_files", f"""
SELECT f.record_id, f.file_id, f.file_path, f.file_type FROM {_PAGE_FILES_SQL} f
WHERE f.record_id IN (SELECT 'r' || CAST(n_nationkey AS VARCHAR) FROM nation) AND f.file_type = 'en'""")
def related_files(spark, sf):
    pf = page_files(spark, sf)
    bridge = pf.select("record_id", "file_id")
    files = pf.select("file_id", "file_path", "file_type")
    records = read_table(spark, sf, "nation").select(F.concat(F.lit("r"), F.col("n_nationkey").cast("string")))
    return cat_ops.related_files(bridge, files, records, "en").select("record_id", "file_id", "file_path", "file_type")


@register("insert_if_absent", f"""
SELECT record_id, file_id FROM {_PAGE_FILES_SQL} f WHERE strpos(url, '?') = 0
UNION
SELECT record_id, file_id FROM {_PAGE_FILES_SQL} f""")
def insert_if_absent(spark, sf):
    p = read_table(spark, sf, "pages").select("page_id", "url")
    pf = page_files(spark, sf).join(p, F.concat(F.lit("f"), F.col("page_id").cast("string")) == F.col("file_id"))
    store = pf.where(~F.col("url").contains("?")).select("record_id", "file_id")
    batch = pf.select("record_id", "file_id")
    return upsert.insert_if_absent(store, batch)


def _doc_files(spark, sf):
    part = read_table(spark, sf, "part")
    name = F.concat(F.replace(F.col("p_brand"), F.lit("#"), F.lit("")), F.lit("_"), F.col("p_type"),
                    F.lit("_"), F.col("p_partkey").cast("string"), F.lit(".pdf"))
    return part.select(name.alias("file_name"), F.concat(F.lit("/docs/"), name).alias("file_path"))


@register("title_file_match", """
WITH f AS (SELECT replace(p_brand, '#', '') || '_' || p_type || '_' || CAST(p_partkey AS VARCHAR) || '.pdf' AS file_name FROM part),
t AS (SELECT DISTINCT p_brand AS title, replace(regexp_replace(p_brand, '[^A-Za-z0-9_]', '', 'g'), '圖', '') AS clean FROM part)
SELECT title, file_name, CASE WHEN file_name IS NOT NULL THEN '/docs/' || file_name END AS file_path FROM (
  SELECT t.title, f.file_name, row_number() OVER (PARTITION BY t.title ORDER BY f.file_name) AS rn
  FROM t LEFT JOIN f ON strpos(f.file_name, t.clean) > 0 OR strpos(f.file_name, t.title) > 0) x
WHERE rn = 1""")
def title_file_match(spark, sf):
    titles = read_table(spark, sf, "part").select(F.col("p_brand").alias("title")).distinct()
    return cat_ops.title_file_match(titles, _doc_files(spark, sf))


# ---------------------------------------------------------------- metadata
def order_metadata(spark, sf):
    """Orders as landed metadata records: one dataset per order."""
    o = read_table(spark, sf, "orders")
    cats = [c for c, _ in quality.CATEGORY_PREFIXES] + ["未知分類"]
    cat_arr = F.array(*[F.lit(c) for c in cats])
    title = F.concat(F.lit("order "), F.col("o_orderkey").cast("string"),
                     F.when(F.col("o_orderpriority") == "1-URGENT", F.lit(" 代碼")).otherwise(F.lit("")))
    return o.select(
        "o_orderkey", title.alias("title"),
        F.get(cat_arr, F.pmod(F.col("o_custkey"), F.lit(len(cats))).cast("int")).alias("category"),
        F.when(F.col("o_orderstatus") != "P", F.concat(F.lit("https://data.example/api/"),
                                                        F.col("o_orderkey").cast("string"))).alias("api_url"),
        F.date_format("o_orderdate", "yyyy/MM/dd HH:mm:ss").alias("updated_at_src"),
        "o_orderdate", "o_orderstatus")


_CATS = ", ".join(f"'{c}'" for c, _ in quality.CATEGORY_PREFIXES) + ", '未知分類'"
_CAT_VALUES = ", ".join(f"('{c}', '{p}')" for c, p in quality.CATEGORY_PREFIXES)
_ORDER_META_SQL = f"""(SELECT o_orderkey,
   'order ' || CAST(o_orderkey AS VARCHAR) || CASE WHEN o_orderpriority = '1-URGENT' THEN ' 代碼' ELSE '' END AS title,
   [{_CATS}][(o_custkey % 21) + 1] AS category,
   CASE WHEN o_orderstatus <> 'P' THEN 'https://data.example/api/' || CAST(o_orderkey AS VARCHAR) END AS api_url,
   strftime(o_orderdate, '%Y/%m/%d %H:%M:%S') AS updated_at_src, o_orderdate, o_orderstatus FROM orders)"""
_CATEGORIES_SQL = f"(SELECT * FROM (VALUES {_CAT_VALUES}) v(category, prefix))"


@register("metadata_integrity", f"""
SELECT m.o_orderkey, m.title, m.category, k.prefix,
  CASE WHEN m.api_url IS NULL OR trim(m.api_url) = '' OR m.title IS NULL OR trim(m.title) = ''
         OR m.category IS NULL OR trim(m.category) = '' OR m.updated_at_src IS NULL OR trim(m.updated_at_src) = ''
       THEN 'missing' WHEN k.prefix IS NULL THEN 'unknown_category' ELSE 'ok' END AS status
FROM {_ORDER_META_SQL} m LEFT JOIN {_CATEGORIES_SQL} k ON m.category = k.category""")
def metadata_integrity(spark, sf):
    m = order_metadata(spark, sf)
    out = quality.metadata_integrity(m, quality.category_table(spark))
    return out.select("o_orderkey", "title", "category", "prefix", "status")


def stored_metadata(spark, sf):
    """Catalog of datasets seen before 1998: even sequences per category (gaps at the odd ones);
    fulfilled orders have a different stored update time."""
    m = quality.metadata_integrity(order_metadata(spark, sf), quality.category_table(spark))
    m = m.where((F.col("o_orderdate") < ts_lit(_dt.datetime(1998, 1, 1)))
                & (F.col("status") == "ok"))
    from harvest.operators.numbering import consecutive_index
    m = consecutive_index(m, ["o_orderkey"], ["prefix"], name="_r")
    upd = F.when(F.col("o_orderstatus") == "F", F.concat(F.col("updated_at_src"), F.lit(" (old)"))) \
        .otherwise(F.col("updated_at_src"))
    return m.select(compose_id(F.col("prefix"), F.col("_r") * 2, 4).alias("dataset_id"), "title",
                    "category", upd.alias("updated_at_src"))


_STORED_META_SQL = f"""(SELECT k.prefix || lpad(CAST(2 * row_number() OVER (PARTITION BY k.prefix ORDER BY m.o_orderkey) AS VARCHAR), CAST(greatest(4, length(CAST(2 * row_number() OVER (PARTITION BY k.prefix ORDER BY m.o_orderkey) AS VARCHAR))) AS INTEGER), '0') AS dataset_id,
   m.title, m.category,
   CASE WHEN m.o_orderstatus = 'F' THEN m.updated_at_src || ' (old)' ELSE m.updated_at_src END AS updated_at_src
 FROM {_ORDER_META_SQL} m JOIN {_CATEGORIES_SQL} k ON m.category = k.category
 WHERE m.o_orderdate < TIMESTAMP '1998-01-01 00:00:00' AND m.api_url IS NOT NULL)"""


@register("freshness_status", f"""
WITH b AS (SELECT m.*, k.prefix FROM {_ORDER_META_SQL} m LEFT JOIN {_CATEGORIES_SQL} k ON m.category = k.category),
s AS {_STORED_META_SQL},
st AS (SELECT b.title, b.prefix, s.dataset_id,
   CASE WHEN b.prefix IS NULL THEN 'error' WHEN s.dataset_id IS NULL THEN 'new'
        WHEN s.updated_at_src = b.updated_at_src THEN 'unchanged' ELSE 'update' END AS status
   FROM b LEFT JOIN s ON b.title = s.title),
used AS (SELECT substr(dataset_id, 1, 3) AS prefix, CAST(substr(dataset_id, 4) AS BIGINT) AS n FROM s),
req AS (SELECT title, prefix, row_number() OVER (PARTITION BY prefix ORDER BY title) AS r FROM st WHERE status = 'new'),
lim AS (SELECT prefix, count(*) + COALESCE((SELECT max(n) FROM used u WHERE u.prefix = req.prefix), 0) AS top FROM req GROUP BY prefix),
free AS (SELECT prefix, g AS n, row_number() OVER (PARTITION BY prefix ORDER BY g) AS r FROM (
   SELECT lim.prefix, unnest(generate_series(1, lim.top)) AS g FROM lim) x
   WHERE NOT EXISTS (SELECT 1 FROM used u WHERE u.prefix = x.prefix AND u.n = x.g))
SELECT title, status, dataset_id FROM st WHERE status <> 'new'
UNION ALL
SELECT req.title, 'new', req.prefix || lpad(CAST(free.n AS VARCHAR), CAST(greatest(4, length(CAST(free.n AS VARCHAR))) AS INTEGER), '0') FROM req JOIN free USING (prefix, r)""")
def freshness_status(spark, sf):
    return quality.freshness_status(order_metadata(spark, sf), stored_metadata(spark, sf),
                                    quality.category_table(spark))


@register("refresh_summary", f"""
WITH b AS (SELECT m.*, k.prefix FROM {_ORDER_META_SQL} m LEFT JOIN {_CATEGORIES_SQL} k ON m.category = k.category),
s AS {_STORED_META_SQL}
SELECT status, count(*) AS n_datasets FROM (
  SELECT CASE WHEN b.prefix IS NULL THEN 'error' WHEN s.dataset_id IS NULL THEN 'new'
        WHEN s.updated_at_src = b.updated_at_src THEN 'unchanged' ELSE 'update' END AS status
  FROM b LEFT JOIN s ON b.title = s.title) t GROUP BY status""")
def refresh_summary(spark, sf):
    """Datasets per outcome (titles stay in the freshness listing; no list column)."""
    st = quality.title_outcomes(order_metadata(spark, sf), stored_metadata(spark, sf), quality.category_table(spark))
    return st.groupBy("status").agg(F.count(F.lit(1)).alias("n_datasets"))


# --------------------------------------------------------------- load mode
@register("load_mode_apply", f"""
WITH m AS {_ORDER_META_SQL},
rows AS (SELECT l_orderkey, l_linenumber, l_partkey, l_shipdate,
            CASE WHEN l_returnflag = 'R' THEN 'http://map.example/' || CAST(l_partkey AS VARCHAR) END AS map_url,
            row_number() OVER (PARTITION BY l_orderkey ORDER BY l_linenumber, l_partkey, l_shipdate) AS pos
         FROM lineitem),
first AS (SELECT l_orderkey, map_url FROM rows WHERE pos = 1),
mode AS (SELECT m.o_orderkey, CASE WHEN COALESCE(f.map_url, '') <> '' OR strpos(m.title, '代碼') > 0
              OR strpos(m.title, '空間') > 0 THEN 'full' ELSE 'incremental' END AS mode
         FROM m JOIN first f ON f.l_orderkey = m.o_orderkey)
SELECT r.l_orderkey, r.l_linenumber, r.l_partkey, mode.mode FROM rows r JOIN mode ON r.l_orderkey = mode.o_orderkey
WHERE mode.mode = 'full' OR (r.l_shipdate >= TIMESTAMP '1998-01-01 00:00:00' AND NOT EXISTS (
  SELECT 1 FROM lineitem s WHERE s.l_shipdate < TIMESTAMP '1998-01-01 00:00:00' AND s.l_orderkey = r.l_orderkey
    AND s.l_linenumber = r.l_linenumber AND s.l_partkey = r.l_partkey))""")
def load_mode_apply(spark, sf):
    """P05 + K02: route each dataset, then take all rows (full replace) or only
    the new rows (incremental anti-join)."""
    from harvest.operators.incremental import new_rows
    li = read_table(spark, sf, "lineitem").select(
        "l_orderkey", "l_linenumber", "l_partkey", "l_shipdate",
        F.when(F.col("l_returnflag") == "R", F.concat(F.lit("http://map.example/"),
                                                      F.col("l_partkey").cast("string"))).alias("map_url"))
    first = (li.groupBy("l_orderkey")
             .agg(F.min_by("map_url", F.struct("l_linenumber", "l_partkey", "l_shipdate")).alias("first_map")))
    meta = order_metadata(spark, sf).select(F.col("o_orderkey").alias("l_orderkey"), "title")
    mode = meta.join(first, "l_orderkey").select("l_orderkey", quality.load_mode(F.col("title"), F.col("first_map")).alias("mode"))
    rows = li.join(mode, "l_orderkey")
    cut = ts_lit(_dt.datetime(1998, 1, 1))
    full = rows.where(F.col("mode") == "full")
    inc = rows.where((F.col("mode") == "incremental") & (F.col("l_shipdate") >= cut))
    store = li.where(F.col("l_shipdate") < cut)
    inc = new_rows(inc, store, ["l_orderkey", "l_linenumber", "l_partkey"])
    return full.unionByName(inc).select("l_orderkey", "l_linenumber", "l_partkey", "mode")


@register("load_counters", """
WITH inc AS (SELECT * FROM lineitem WHERE l_shipdate >= TIMESTAMP '1997-01-01 00:00:00'),
st AS (SELECT * FROM lineitem WHERE l_shipdate < TIMESTAMP '1998-01-01 00:00:00'),
new AS (SELECT * FROM inc i WHERE NOT EXISTS (SELECT 1 FROM st s WHERE s.l_orderkey = i.l_orderkey
          AND s.l_linenumber = i.l_linenumber AND s.l_partkey = i.l_partkey))
SELECT (SELECT count(*) FROM inc) AS downloaded, (SELECT count(*) FROM (SELECT DISTINCT * FROM inc) d) AS unique_rows,
       (SELECT count(*) FROM new) AS new_rows, (SELECT count(*) FROM st) + (SELECT count(*) FROM new) AS total_rows""")
def load_counters(spark, sf):
    """Downloaded / unique / new / total counters of one load, as one row."""
    from harvest.operators.report import load_counters as counters
    li = read_table(spark, sf, "lineitem")
    incoming = F.col("l_shipdate") >= ts_lit(_dt.datetime(1997, 1, 1))
    stored = F.col("l_shipdate") < ts_lit(_dt.datetime(1998, 1, 1))
    return counters(li, incoming, stored, ["l_orderkey", "l_linenumber", "l_partkey"])


# ------------------------------------------------------------------ config
def part_configs(spark, sf):
    p = read_table(spark, sf, "part")
    keys = F.when(F.col("p_size") > 45, F.concat(F.lit('[["'), F.col("p_type"), F.lit('"')))  \
        .otherwise(F.concat(F.lit('[["'), F.col("p_type"), F.lit('","text_asc"],["p_size","number_asc"]]')))
    return p.select(F.col("p_brand").alias("file_name"), keys.alias("sort_keys"), F.col("p_partkey").alias("ord"))


@register("config_decode", """
SELECT p_partkey,
  CASE WHEN p_size > 45 THEN NULL ELSE 2 END AS n_keys,
  CASE WHEN p_size > 45 THEN NULL ELSE p_type END AS first_col,
  CASE WHEN p_size > 45 THEN '[["' || p_type || '"' END AS undecoded
FROM part""")
def config_decode(spark, sf):
    """Decode the JSON text of sort-key configs; text that does not
    decode is kept as text in ``undecoded``."""
    from harvest.functions.text import parse_json_list
    c = part_configs(spark, sf)
    dec = parse_json_list(F.col("sort_keys"))
    return c.select(F.col("ord").alias("p_partkey"),
                    F.when(dec.isNotNull(), F.size(dec)).alias("n_keys"),
                    F.get(F.get(dec, 0), 0).alias("first_col"),
                    F.when(dec.isNull(), F.col("sort_keys")).alias("undecoded"))


@register("config_lookup", """
SELECT file_name, arg_min(sort_keys, p_partkey) AS first_keys, arg_max(sort_keys, p_partkey) AS last_keys FROM (
  SELECT p_brand AS file_name, p_partkey,
    CASE WHEN p_size > 45 THEN '[["' || p_type || '"'
         ELSE '[["' || p_type || '","text_asc"],["p_size","number_asc"]]' END AS sort_keys FROM part) t
GROUP BY file_name""")
def config_lookup(spark, sf):
    """Per dataset name, the first and the last stored config."""
    c = part_configs(spark, sf)
    return c.groupBy("file_name").agg(F.min_by("sort_keys", "ord").alias("first_keys"), F.max_by("sort_keys", "ord").alias("last_keys"))


# ------------------------------------------------------------------ upserts
def customer_store(spark, sf):
    c = read_table(spark, sf, "customer")
    return c.select(F.col("c_custkey").cast("string").alias("dataset_id"), F.col("c_name").alias("title"),
                    F.col("c_mktsegment").alias("category"),
                    ts_lit(BEFORE).alias("created_at"),
                    ts_lit(BEFORE).alias("last_updated_at"))


def customer_batch(spark, sf):
    c = read_table(spark, sf, "customer")
    changed = c.where(F.col("c_acctbal") > 8000).select(
        F.col("c_custkey").cast("string").alias("dataset_id"), F.upper("c_name").alias("title"),
        F.when(F.col("c_mktsegment") != "AUTOMOBILE", F.col("c_mktsegment")).alias("category"),
        F.concat(F.lit("nation "), F.col("c_nationkey").cast("string")).alias("provider"))
    new = c.where(F.col("c_acctbal") < -900).select(
        (F.col("c_custkey") + 100000).cast("string").alias("dataset_id"), F.col("c_name").alias("title"),
        F.col("c_mktsegment").alias("category"), F.lit("new").alias("provider"))
    return changed.unionByName(new)


@register("upsert_metadata", """
WITH s AS (SELECT CAST(c_custkey AS VARCHAR) AS dataset_id, c_name AS title, c_mktsegment AS category FROM customer),
b AS (SELECT CAST(c_custkey AS VARCHAR) AS dataset_id, upper(c_name) AS title,
        CASE WHEN c_mktsegment <> 'AUTOMOBILE' THEN c_mktsegment END AS category,
        'nation ' || CAST(c_nationkey AS VARCHAR) AS provider FROM customer WHERE c_acctbal > 8000
      UNION ALL
      SELECT CAST(c_custkey + 100000 AS VARCHAR), c_name, c_mktsegment, 'new' FROM customer WHERE c_acctbal < -900)
SELECT s.dataset_id, s.title, s.category, TIMESTAMP '2025-01-01 00:00:00' AS created_at,
       TIMESTAMP '2025-01-01 00:00:00' AS last_updated_at, CAST(NULL AS VARCHAR) AS provider
FROM s WHERE s.dataset_id NOT IN (SELECT dataset_id FROM b)
UNION ALL
SELECT b.dataset_id, b.title, b.category,
       CASE WHEN s.dataset_id IS NULL THEN TIMESTAMP '2025-06-01 00:00:00' ELSE TIMESTAMP '2025-01-01 00:00:00' END,
       TIMESTAMP '2025-06-01 00:00:00', b.provider
FROM b LEFT JOIN s ON s.dataset_id = b.dataset_id""")
def upsert_metadata(spark, sf):
    return upsert.upsert(customer_store(spark, sf), customer_batch(spark, sf), "dataset_id", now=NOW)


@register("replace_by_key", """
SELECT c_custkey, c_name, c_acctbal FROM customer WHERE c_acctbal < 5000
  AND c_custkey NOT IN (SELECT c_custkey FROM customer WHERE c_acctbal BETWEEN 4000 AND 6000)
UNION ALL
SELECT c_custkey, upper(c_name), c_acctbal FROM customer WHERE c_acctbal BETWEEN 4000 AND 6000""")
def replace_by_key(spark, sf):
    c = read_table(spark, sf, "customer")
    store = c.where(F.col("c_acctbal") < 5000).select("c_custkey", "c_name", "c_acctbal")
    batch = c.where(F.col("c_acctbal").between(4000, 6000)).select("c_custkey", F.upper("c_name").alias("c_name"),
                                                                   "c_acctbal")
    return upsert.replace_by_key(store, batch, "c_custkey")


@register("upsert_config", f"""
WITH cat AS {CATALOG_SQL},
cfg AS (SELECT s_suppkey, CASE WHEN s_acctbal > 5000 THEN n_name END AS title,
          'NATION_' || CAST(s_nationkey + 1 AS VARCHAR) AS file_name,
          '[["s_acctbal","number_asc"]]' AS sort_keys
        FROM supplier JOIN nation ON s_nationkey = n_nationkey),
att AS (SELECT DISTINCT cfg.*, cat.dataset_id FROM cfg JOIN cat ON cfg.title = cat.title OR cfg.file_name = cat.title),
b AS (SELECT dataset_id, title, file_name, sort_keys FROM (
        SELECT *, row_number() OVER (PARTITION BY dataset_id ORDER BY s_suppkey DESC) AS rn FROM att) t WHERE rn = 1),
s AS (SELECT dataset_id, title, title AS file_name, '[]' AS sort_keys FROM cat WHERE category = 'asia')
SELECT * FROM s WHERE dataset_id NOT IN (SELECT dataset_id FROM b)
UNION ALL SELECT dataset_id, title, file_name, sort_keys FROM b""")
def upsert_config(spark, sf):
    """K05 + J07: config rows get their dataset id by title or file name, then
    are upserted by id (last supplier wins)."""
    s = read_table(spark, sf, "supplier")
    n = read_table(spark, sf, "nation")
    cfg = s.join(n, s["s_nationkey"] == n["n_nationkey"]).select(
        "s_suppkey", F.when(F.col("s_acctbal") > 5000, F.col("n_name")).alias("title"),
        F.concat(F.lit("NATION_"), (F.col("s_nationkey") + 1).cast("string")).alias("file_name"),
        F.lit('[["s_acctbal","number_asc"]]').alias("sort_keys"))
    catalog = nation_catalog(spark, sf)
    attached = upsert.attach_dataset_ids(cfg, catalog)
    store = catalog.where(F.col("category") == "asia").select(
        "dataset_id", "title", F.col("title").alias("file_name"), F.lit("[]").alias("sort_keys"))
    return upsert.upsert(store, attached, "dataset_id", ord_col="s_suppkey", audit=False)


@register("upsert_files", f"""
WITH pf AS {_PAGE_FILES_SQL},
files AS (SELECT file_type || 'file' || CAST(CAST(substr(file_id, 2) AS BIGINT) AS VARCHAR) AS file_id,
   CASE WHEN strpos(url, '#') > 0 THEN 'pages/' || substr(file_id, 2) || '.html' ELSE file_path END AS file_path,
   substr(file_id, 2) AS file_name, 'html' AS file_type, '1 KB' AS file_size,
   TIMESTAMP '2025-01-01 00:00:00' AS upload_date, 'old' AS description
   FROM pf WHERE strpos(url, '?') = 0),
batch AS (SELECT '/srv/pages/' || CAST(page_id AS VARCHAR) || '.html' AS file_path,
   regexp_extract(url, '^[a-z]+://[^/]+/([a-z]+)/', 1) AS prefix, length(html) AS bytes, 'page ' || CAST(page_id AS VARCHAR) AS description
   FROM pages WHERE strpos(url, '#') > 0 OR strpos(url, '?') > 0),
hit AS (SELECT b.*, COALESCE(fa.file_id, fr.file_id) AS file_id FROM batch b
   LEFT JOIN files fa ON fa.file_path = b.file_path
   LEFT JOIN files fr ON fr.file_path = substr(b.file_path, length('/srv/') + 1)),
used AS (SELECT regexp_extract(file_id, '^(.*)file([0-9]+)$', 1) AS prefix,
   CAST(regexp_extract(file_id, '^(.*)file([0-9]+)$', 2) AS BIGINT) AS n FROM files),
req AS (SELECT *, row_number() OVER (PARTITION BY prefix ORDER BY file_path) AS r FROM hit WHERE file_id IS NULL),
lim AS (SELECT prefix, count(*) + COALESCE((SELECT max(n) FROM used u WHERE u.prefix = req.prefix), 0) AS top FROM req GROUP BY prefix),
free AS (SELECT prefix, g AS n, row_number() OVER (PARTITION BY prefix ORDER BY g) AS r FROM (
   SELECT lim.prefix, unnest(generate_series(1, lim.top)) AS g FROM lim) x
   WHERE NOT EXISTS (SELECT 1 FROM used u WHERE u.prefix = x.prefix AND u.n = x.g)),
sz AS (SELECT *, {human_size_sql("bytes")} AS size_text FROM hit)
SELECT f.* FROM files f WHERE f.file_id NOT IN (SELECT file_id FROM hit WHERE file_id IS NOT NULL)
UNION ALL
SELECT f.file_id, sz.file_path, f.file_name, f.file_type, sz.size_text, TIMESTAMP '2025-06-01 00:00:00', sz.description
FROM sz JOIN files f ON f.file_id = sz.file_id
UNION ALL
SELECT req.prefix || 'file' || CAST(free.n AS VARCHAR), req.file_path,
  regexp_extract(req.file_path, '([^/]*)\\.html$', 1), 'page', sz.size_text, TIMESTAMP '2025-06-01 00:00:00', req.description
FROM req JOIN free USING (prefix, r) JOIN sz ON sz.file_path = req.file_path""")
def upsert_files(spark, sf):
    p = read_table(spark, sf, "pages")
    lang = F.regexp_extract("url", r"^[a-z]+://[^/]+/([a-z]+)/", 1)
    files = p.where(~F.col("url").contains("?")).select(
        F.concat(lang, F.lit("file"), F.col("page_id").cast("string")).alias("file_id"),
        F.when(F.col("url").contains("#"), F.concat(F.lit("pages/"), F.col("page_id").cast("string"), F.lit(".html")))
        .otherwise(F.concat(F.lit("/srv/pages/"), F.col("page_id").cast("string"), F.lit(".html"))).alias("file_path"),
        F.col("page_id").cast("string").alias("file_name"), F.lit("html").alias("file_type"),
        F.lit("1 KB").alias("file_size"), ts_lit(BEFORE).alias("upload_date"),
        F.lit("old").alias("description"))
    batch = p.where(F.col("url").contains("#") | F.col("url").contains("?")).select(
        F.concat(F.lit("/srv/pages/"), F.col("page_id").cast("string"), F.lit(".html")).alias("file_path"),
        lang.alias("prefix"), F.lit("page").alias("file_type"), F.length("html").cast("bigint").alias("file_size"),
        F.concat(F.lit("page "), F.col("page_id").cast("string")).alias("description"))
    return upsert.upsert_files(files, batch, "/srv", now=NOW)


@register("delete_by_keyword", f"""
WITH hits AS (SELECT dataset_id FROM {CATALOG_SQL} c
              WHERE c.title = 'nation_1' OR c.dataset_id = 'nation_1' OR strpos(lower(c.title), 'nation_1') > 0
                 OR strpos(c.dataset_id, 'nation_1') > 0 OR strpos(c.category, 'nation_1') > 0)
SELECT 'parent' AS frame, CAST(NULL AS BIGINT) AS row_key, c.title AS name, c.dataset_id FROM {CATALOG_SQL} c
WHERE c.dataset_id NOT IN (SELECT dataset_id FROM hits)
UNION ALL
SELECT 'rows', CAST(c_custkey AS BIGINT), c_name, '101' || lpad(CAST(c_nationkey AS VARCHAR), 4, '0') AS dataset_id
FROM customer WHERE '101' || lpad(CAST(c_nationkey AS VARCHAR), 4, '0') NOT IN (SELECT dataset_id FROM hits)""")
def delete_by_keyword(spark, sf):
    """K13 by keyword: the datasets a search for 'Nation_1' finds (every fuzzy hit:
    NATION_1 and NATION_10..19) are deleted with their rows."""
    cat = nation_catalog(spark, sf)
    doomed = cat_ops.datasets_matching(cat, keyword="Nation_1")
    out = cat_ops.cascade_delete(cat, {"rows": (customer_rows(spark, sf), "dataset_id")}, doomed)
    return both_frames(out["parent"], out["rows"], "c_custkey", "c_name")
