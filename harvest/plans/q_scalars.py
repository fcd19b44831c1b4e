"""Scalar-function and reshape queries: names, URLs, sizes, numbering, profiles."""

from __future__ import annotations

from pyspark.sql import functions as F

from harvest.functions.times import ts_lit
from harvest.functions import text as T
from harvest.functions.sizes import human_size
from harvest.functions.urls import page_url, replace_url_params
from harvest.operators import report
from harvest.plans.registry import register
from harvest.plans.sqltext import human_size_sql
from harvest.session import read_table


def part_titles(spark, sf):
    """Part names dressed as portal titles: 4-byte and CJK characters in front
    (their count varies with the size), the site suffix behind."""
    p = read_table(spark, sf, "part")
    name = F.concat(F.repeat(F.lit("𠀀"), F.pmod("p_size", F.lit(7))), F.repeat(F.lit("農"), F.pmod("p_size", F.lit(11))),
                    F.col("p_name"), F.lit(" "), F.col("p_brand"), F.lit(" 農地空間圖"), F.lit(T.SITE_SUFFIX))
    return p.select("p_partkey", name.alias("title"))


def _fit_sql(s: str, room: str) -> str:
    out = "''"
    for k in range(1, T.MAX_NAME_CHARS + 1):
        out = f"CASE WHEN strlen(left({s}, {k})) <= {room} THEN left({s}, {k}) ELSE {out} END"
    return out


_TITLE_SQL = ("repeat('𠀀', p_size % 7) || repeat('農', p_size % 11) || p_name || ' ' || p_brand"
              " || ' 農地空間圖' || ' - 農業資料開放平臺'")
_CLEAN_SQL = (f"regexp_replace(replace(replace({_TITLE_SQL}, ' - 農業資料開放平臺', ''), '農地空間圖', ''),"
              " '[^\\p{L}\\p{N}_]', '', 'g')")
_BASE_SQL = f"({_TITLE_SQL} || '.pdf')"
_EXT_SQL = f"regexp_extract({_BASE_SQL}, '^\\.*[^.].*(\\.[^.]*)$', 1)"
_STEM_SQL = f"left({_BASE_SQL}, length({_BASE_SQL}) - length({_EXT_SQL}))"


@register("clean_names", f"""
SELECT p_partkey, {_TITLE_SQL} AS title,
  CASE WHEN length({_CLEAN_SQL}) > 21 THEN {_fit_sql(_CLEAN_SQL, "63")} ELSE {_CLEAN_SQL} END AS table_name,
  CASE WHEN length({_STEM_SQL}) > 21 THEN {_fit_sql(_STEM_SQL, f"(63 - strlen({_EXT_SQL}))")} || {_EXT_SQL}
       ELSE {_BASE_SQL} END AS file_name
FROM part""")
def clean_names(spark, sf):
    t = part_titles(spark, sf)
    path = F.concat(F.lit("/docs/"), F.col("title"), F.lit(".pdf"))
    return t.select("p_partkey", "title", T.clean_table_name("title").alias("table_name"),
                    T.truncate_file_name(path).alias("file_name"))


NEW_PARAMS = {"page": "1", "lang": "zh tw"}


def _enc(x: str) -> str:
    return f"replace(url_encode({x}), '%20', '+')"


_URL_SQL = f"""
WITH u AS (
  SELECT page_id, url,
    regexp_extract(url, '^([^#]*)', 1) AS bf,
    regexp_extract(url, '^[^#]*#(.*)$', 1) AS frag FROM pages),
q AS (
  SELECT page_id, url, frag, regexp_extract(bf, '^([^?]*)', 1) AS base,
    list_filter(list_transform(string_split(regexp_extract(bf, '^[^?]*\\?(.*)$', 1), '&'),
        lambda p: {{'k': url_decode(regexp_extract(p, '^([^=]*)=', 1)), 'v': url_decode(regexp_extract(p, '^[^=]*=(.*)$', 1)),
              'ok': strpos(p, '=') > 0 AND regexp_extract(p, '^[^=]*=(.*)$', 1) <> ''}}),
        lambda s: s.ok) AS pairs FROM u),
n AS (
  SELECT *, list_transform(pairs, lambda s: s.k) AS ks FROM q),
m AS (
  SELECT *, list_concat(list_filter(ks, lambda k, i: list_position(ks, k) = i),
                        list_filter(['page', 'lang'], lambda k: NOT list_contains(ks, k))) AS names FROM n),
e AS (
  SELECT page_id, url, base, frag,
    array_to_string(flatten(list_transform(names, lambda nm:
      CASE WHEN nm = 'page' THEN ['page=' || {_enc("'1'")}]
           WHEN nm = 'lang' THEN ['lang=' || {_enc("'zh tw'")}]
           ELSE list_transform(list_filter(pairs, lambda s: s.k = nm), lambda s: {_enc('nm')} || '=' || {_enc('s.v')}) END)), '&') AS qs
  FROM m)
SELECT page_id, url,
  base || CASE WHEN qs <> '' THEN '?' || qs ELSE '' END || CASE WHEN frag <> '' THEN '#' || frag ELSE '' END AS new_url,
  url || CASE WHEN strpos(url, '?') > 0 THEN '&' ELSE '?' END || '$skip=' || CAST(page_id * 1000 AS VARCHAR) AS page_url
FROM e"""


@register("url_params", _URL_SQL)
def url_params(spark, sf):
    p = read_table(spark, sf, "pages")
    return p.select("page_id", "url", replace_url_params("url", NEW_PARAMS).alias("new_url"),
                    page_url(F.col("url"), F.col("page_id") * 1000).alias("page_url"))


@register("human_size", f"""
SELECT doc_id, n_chars, {human_size_sql("n_chars")} AS size_text,
  {human_size_sql("n_chars * 1000003")} AS size_text_m,
  {human_size_sql("n_chars * 1073741827")} AS size_text_t
FROM documents""")
def human_size_q(spark, sf):
    d = read_table(spark, sf, "documents")
    return d.select("doc_id", "n_chars", human_size("n_chars").alias("size_text"),
                    human_size(F.col("n_chars") * 1000003).alias("size_text_m"),
                    human_size(F.col("n_chars") * 1073741827).alias("size_text_t"))


@register("numbered_pages", """
WITH c AS (SELECT c_custkey, c_name, row_number() OVER (ORDER BY c_custkey) AS display_no,
                  count(*) OVER () AS total FROM customer)
SELECT c_custkey, display_no,
  CAST((display_no - 1) // CASE WHEN total <= 25 THEN total WHEN total <= 100 THEN 20 ELSE 50 END + 1 AS BIGINT) AS page_no,
  CASE WHEN length(c_name) > 15 THEN left(c_name, 15) || '...' ELSE c_name END AS name_short
FROM c""")
def numbered_pages(spark, sf):
    c = read_table(spark, sf, "customer").select("c_custkey", "c_name")
    out = report.numbered_pages(c, ["c_custkey"])
    return out.select("c_custkey", "display_no", "page_no", T.ellipsis("c_name").alias("name_short"))


@register("record_profile", """
SELECT n_nationkey, field, value FROM (
  SELECT n_nationkey, n_name, CAST(n_regionkey AS VARCHAR) AS n_regionkey FROM nation
) UNPIVOT (value FOR field IN (n_name, n_regionkey))""")
def record_profile(spark, sf):
    return report.record_profile(read_table(spark, sf, "nation"), "n_nationkey")


@register("scan_limit", "SELECT * FROM region ORDER BY r_regionkey LIMIT 3")
def scan_limit(spark, sf):
    """First n rows of a table in a stated order (the limit is the feature)."""
    return read_table(spark, sf, "region").orderBy("r_regionkey").limit(3)


@register("append_evolve", """
SELECT event_id, ts, user_id, event_type, CAST(NULL AS DOUBLE) AS event_value, CAST(NULL AS VARCHAR) AS props_json
FROM events WHERE ts < TIMESTAMP '2024-01-21 00:00:00'
UNION ALL
SELECT event_id, ts, user_id, event_type, value, '{"k":' || CAST(CAST(json_extract(props, '$.k') AS BIGINT) AS VARCHAR) || '}'
FROM events WHERE ts >= TIMESTAMP '2024-01-21 00:00:00'""")
def append_evolve(spark, sf):
    """Append a batch whose columns drift from the store:
    names are cleaned, a nested value is stored as JSON text, and columns
    missing on either side are filled with NULL."""
    from harvest.sinks import evolve_union
    ev = read_table(spark, sf, "events")
    cut = ts_lit("2024-01-21 00:00:00")
    store = ev.where(F.col("ts") < cut).select("event_id", "ts", "user_id", "event_type")
    batch = ev.where(F.col("ts") >= cut).select(
        "event_id", "ts", "user_id", "event_type", F.col("value").alias("event value"),
        F.from_json("props", "struct<k:bigint>").alias("props.json"))
    return evolve_union(store, batch)


@register("wide_ids", """
WITH s AS (SELECT row_number() OVER (ORDER BY o_orderkey) AS n FROM orders),
     t AS (SELECT n + 9990 AS d, n + 9999990 AS r FROM s)
SELECT CAST(d AS BIGINT) AS d, '101' || lpad(CAST(d AS VARCHAR), CAST(greatest(4, length(CAST(d AS VARCHAR))) AS INTEGER), '0') AS dataset_id,
       '1010003' || lpad(CAST(r AS VARCHAR), CAST(greatest(7, length(CAST(r AS VARCHAR))) AS INTEGER), '0') AS row_id FROM t""")
def wide_ids(spark, sf):
    """Sequences that cross 9,999 and 9,999,999 keep all their digits, so ids stay distinct."""
    from harvest.functions.text import compose_id
    from harvest.operators.numbering import consecutive_index
    n = consecutive_index(read_table(spark, sf, "orders").select("o_orderkey"), ["o_orderkey"], name="n").select("n")
    return n.select((F.col("n") + 9990).alias("d"), compose_id(F.lit("101"), F.col("n") + 9990, 4).alias("dataset_id"),
                    compose_id(F.lit("1010003"), F.col("n") + 9_999_990, 7).alias("row_id"))
