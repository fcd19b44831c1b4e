"""Load-path queries: dates, cutoff, incremental anti-join, ids, de-dup, sort."""

from __future__ import annotations

import os
import uuid
from contextlib import contextmanager

from pyspark.sql import functions as F

from harvest.functions.text import MAP_URL_FIELD
from harvest.functions.times import ts_lit
from harvest.functions.dates import parse_date
from harvest.operators import dedup, ids, incremental, ordering
from harvest.operators.quality import date_cutoff
from harvest.plans import inputs
from harvest.plans.inputs import LANDED_EVENTS_SQL, STORED_EVENTS_SQL
from harvest.plans.registry import register
from harvest.session import read_table

# Identity key of a landed event within its dataset (keys never match across datasets).
EVENT_KEYS = ["dataset_id", "user_id", "kind", "ts"]


# --------------------------------------------------------------------- dates
def rendered_orders(spark, sf):
    """o_orderdate rendered as text in one of eight landed formats (chosen per row)."""
    o = read_table(spark, sf, "orders")
    d = F.col("o_orderdate")
    roc = (F.year(d) - 1911).cast("string")
    fmt = F.pmod(F.col("o_orderkey"), F.lit(8))
    text = (F.when(fmt == 0, F.date_format(d, "yyyy/M/d"))
            .when(fmt == 1, F.date_format(d, "yyyy-MM-dd"))
            .when(fmt == 2, F.date_format(d, "yyyyMMdd"))
            .when(fmt == 3, F.concat_ws("/", roc, F.month(d).cast("string"), F.dayofmonth(d).cast("string")))
            .when(fmt == 4, F.concat_ws(".", F.lpad(roc, 3, "0"), F.date_format(d, "MM"), F.date_format(d, "dd")))
            .when(fmt == 5, F.concat(F.lpad(roc, 3, "0"), F.date_format(d, "MMdd")))
            .when(fmt == 6, F.date_format(d, "yyyy/MM/dd HH:mm:ss"))
            .otherwise(F.date_format(d, "yyyy-M")))
    return o.select("o_orderkey", "o_orderstatus", text.alias("date_text"))


RENDERED_ORDERS_SQL = """
  SELECT o_orderkey, o_orderstatus, o_orderdate,
    CASE o_orderkey % 8
      WHEN 0 THEN strftime(o_orderdate, '%Y/%-m/%-d')
      WHEN 1 THEN strftime(o_orderdate, '%Y-%m-%d')
      WHEN 2 THEN strftime(o_orderdate, '%Y%m%d')
      WHEN 3 THEN CAST(year(o_orderdate) - 1911 AS VARCHAR) || '/' || CAST(month(o_orderdate) AS VARCHAR) || '/' || CAST(day(o_orderdate) AS VARCHAR)
      WHEN 4 THEN lpad(CAST(year(o_orderdate) - 1911 AS VARCHAR), 3, '0') || '.' || strftime(o_orderdate, '%m.%d')
      WHEN 5 THEN lpad(CAST(year(o_orderdate) - 1911 AS VARCHAR), 3, '0') || strftime(o_orderdate, '%m%d')
      WHEN 6 THEN strftime(o_orderdate, '%Y/%m/%d %H:%M:%S')
      ELSE strftime(o_orderdate, '%Y-%-m') END AS date_text,
    CASE WHEN o_orderkey % 8 = 7 THEN date_trunc('month', o_orderdate) ELSE o_orderdate END AS expected
  FROM orders"""


@register("parse_dates", f"""
SELECT o_orderkey, date_text, CAST(expected AS TIMESTAMP) AS parsed
FROM ({RENDERED_ORDERS_SQL}) r""")
def parse_dates(spark, sf):
    r = rendered_orders(spark, sf)
    return r.select("o_orderkey", "date_text", parse_date("date_text").alias("parsed"))


@register("date_cutoff", f"""
SELECT o_orderkey, o_orderstatus, date_text
FROM ({RENDERED_ORDERS_SQL}) r WHERE expected >= TIMESTAMP '1998-01-01 00:00:00'""")
def date_cutoff_q(spark, sf):
    return date_cutoff(rendered_orders(spark, sf), 1998, 1, 1)


# --------------------------------------------------------------- incremental
_NEW_EVENTS_SQL = f"""
SELECT i.dataset_id, i.event_id, i.user_id, i.kind, i.ts, i.value, i.event_date
FROM ({LANDED_EVENTS_SQL}) i
WHERE CAST(i.ts AS DATE) >= DATE '2024-01-11'
  AND NOT EXISTS (SELECT 1 FROM ({STORED_EVENTS_SQL}) s
                  WHERE s.dataset_id = i.dataset_id
                    AND CAST(s.user_id AS VARCHAR) IS NOT DISTINCT FROM CAST(i.user_id AS VARCHAR)
                    AND s.kind IS NOT DISTINCT FROM i.kind
                    AND s.ts IS NOT DISTINCT FROM i.ts)"""


def new_events(spark, sf):
    incoming = date_cutoff(inputs.landed_events(spark, sf), *inputs.EVENTS_CUTOFF, date_col="event_date")
    return incremental.new_rows(incoming, inputs.stored_events(spark, sf), EVENT_KEYS)


@register("incremental_new", _NEW_EVENTS_SQL)
def incremental_new(spark, sf):
    return new_events(spark, sf)


@register("incremental_existing", f"""
SELECT i.event_id, s.seq
FROM ({LANDED_EVENTS_SQL}) i JOIN ({STORED_EVENTS_SQL}) s
  ON s.dataset_id = i.dataset_id AND CAST(s.user_id AS VARCHAR) IS NOT DISTINCT FROM CAST(i.user_id AS VARCHAR)
 AND s.kind IS NOT DISTINCT FROM i.kind AND s.ts IS NOT DISTINCT FROM i.ts""")
def incremental_existing(spark, sf):
    return incremental.matched_ids(inputs.landed_events(spark, sf), inputs.stored_events(spark, sf),
                                   EVENT_KEYS, "seq", "event_id", "event_id")


def refresh_load(spark, sf):
    """Flagship: landed batch -> date parse + cutoff -> incremental anti-join -> ids."""
    new = new_events(spark, sf)
    start = ids.max_sequence(inputs.stored_events(spark, sf), "seq", ["dataset_id"])
    return ids.assign_ids(new, ["event_id"], "dataset_id", start=start)


register("refresh_load", f"""
WITH n AS ({_NEW_EVENTS_SQL}),
m AS (SELECT dataset_id, max(seq) AS top FROM ({STORED_EVENTS_SQL}) s GROUP BY dataset_id),
x AS (SELECT n.*, COALESCE(m.top, 0) + row_number() OVER (PARTITION BY n.dataset_id ORDER BY n.event_id) AS seq
      FROM n LEFT JOIN m ON n.dataset_id = m.dataset_id)
SELECT *, dataset_id || lpad(CAST(seq AS VARCHAR), CAST(greatest(7, length(CAST(seq AS VARCHAR))) AS INTEGER), '0') AS row_id FROM x""")(refresh_load)


@register("assign_ids", """
SELECT event_id, event_type, row_number() OVER (PARTITION BY event_type ORDER BY event_id) AS seq,
       event_type || lpad(CAST(row_number() OVER (PARTITION BY event_type ORDER BY event_id) AS VARCHAR), CAST(greatest(7, length(CAST(row_number() OVER (PARTITION BY event_type ORDER BY event_id) AS VARCHAR))) AS INTEGER), '0') AS row_id
FROM events""")
def assign_ids_q(spark, sf):
    ev = read_table(spark, sf, "events").select("event_id", "event_type")
    return ids.assign_ids(ev, ["event_id"], "event_type")


@register("next_ids", """
WITH used AS (SELECT DISTINCT c_mktsegment, c_custkey AS s FROM customer WHERE c_acctbal >= 0 AND c_custkey >= 1),
ranked AS (SELECT c_mktsegment, s, row_number() OVER (PARTITION BY c_mktsegment ORDER BY s) AS rn FROM used)
SELECT c_mktsegment, CAST(count(*) FILTER (WHERE s = rn) + 1 AS BIGINT) AS next_seq, max(s) AS max_seq
FROM ranked GROUP BY c_mktsegment""")
def next_ids(spark, sf):
    c = read_table(spark, sf, "customer").where(F.col("c_acctbal") >= 0)
    free = ids.first_free_sequence(c, "c_custkey", ["c_mktsegment"])
    top = ids.max_sequence(c.where(F.col("c_custkey") >= 1), "c_custkey", ["c_mktsegment"])
    return free.join(top, "c_mktsegment")


@register("free_numbers", """
WITH used AS (SELECT DISTINCT c_mktsegment AS g, c_custkey AS n FROM customer WHERE c_acctbal >= 5000 AND c_custkey >= 1),
req AS (SELECT c_mktsegment AS g, c_custkey, row_number() OVER (PARTITION BY c_mktsegment ORDER BY c_custkey) AS r FROM customer WHERE c_acctbal < 0),
top AS (SELECT g, max(n) + (SELECT count(*) FROM customer) AS top FROM used GROUP BY g),
free AS (SELECT g, n, row_number() OVER (PARTITION BY g ORDER BY n) AS r FROM (SELECT g, unnest(generate_series(1, top)) AS n FROM top) x
  WHERE NOT EXISTS (SELECT 1 FROM used u WHERE u.g = x.g AND u.n = x.n))
SELECT req.g AS segment, req.c_custkey, free.n AS given FROM req JOIN free USING (g, r)""")
def free_numbers(spark, sf):
    """A06 with stored intervals: the free numbers are found once; two batches of requests (even and odd ranks' halves) are served one
    after the other, the second from what the first left."""
    c = read_table(spark, sf, "customer").select(F.col("c_mktsegment").alias("segment"), "c_custkey", "c_acctbal")
    free = ids.free_intervals(c.where("c_acctbal >= 5000"), "c_custkey", "segment")
    ranked = ids.consecutive_index(c.where("c_acctbal < 0").select("segment", "c_custkey"), ["c_custkey"], ["segment"], name="r")
    half = ranked.groupBy("segment").agg(F.floor(F.max("r") / 2).alias("half"))
    ranked = ranked.join(half, "segment").checkpoint()
    first, left = ids.allocate(free, ranked.where("r <= half"), "segment", "r", name="given")
    second, _ = ids.allocate(left.checkpoint(), ranked.where("r > half").withColumn("r", F.col("r") - F.col("half")), "segment", "r", name="given")
    return first.unionByName(second).select("segment", "c_custkey", "given")


# -------------------------------------------------------------------- de-dup
@register("dedup_first", """
SELECT event_id, ts, user_id, event_type, value, props FROM (
  SELECT *, row_number() OVER (PARTITION BY user_id, event_type ORDER BY event_id) AS rn FROM events) t
WHERE rn = 1""")
def dedup_first(spark, sf):
    return dedup.keep_first(read_table(spark, sf, "events"), ["user_id", "event_type"], "event_id")


@register("merge_last", """
SELECT event_id, ts, user_id, event_type, value, props FROM (
  SELECT *, row_number() OVER (PARTITION BY user_id, event_type ORDER BY event_id DESC) AS rn FROM events) t
WHERE rn = 1""")
def merge_last(spark, sf):
    return dedup.keep_last(read_table(spark, sf, "events"), ["user_id", "event_type"], "event_id")


@register("dup_stats", """
SELECT event_type, CAST(sum(n) AS BIGINT) AS total_rows, CAST(sum(n - 1) AS BIGINT) AS duplicate_rows
FROM (SELECT event_type, user_id, count(*) AS n FROM events GROUP BY event_type, user_id) t
GROUP BY event_type""")
def dup_stats(spark, sf):
    return dedup.duplicate_stats(read_table(spark, sf, "events"), ["user_id"], ["event_type"])


@register("dup_preview", """
SELECT right(CAST(event_id AS VARCHAR), 7) AS event_id, ts, user_id, event_type, value FROM (
  SELECT *, row_number() OVER (PARTITION BY user_id, event_type ORDER BY event_id) AS rn FROM events) t
WHERE rn > 1 ORDER BY t.event_id LIMIT 10""")
def dup_preview(spark, sf):
    return dedup.duplicate_preview(read_table(spark, sf, "events"), ["user_id", "event_type"],
                                   "event_id", drop=["props"])


# Ordinals with gaps and ties: every seventh event has none, the others share one with up to ten events.
_ORDINALS_SQL = """(SELECT *, CASE WHEN event_id % 7 <> 0 THEN CAST(floor(event_id / 10) AS BIGINT) END AS ordinal,
  CASE WHEN event_type <> 'error' THEN event_type END AS kind FROM events)"""


def ordinal_events(spark, sf):
    ordinal = F.when(F.col("event_id") % 7 != 0, F.floor(F.col("event_id") / 10).cast("bigint"))
    return read_table(spark, sf, "events").select("*", ordinal.alias("ordinal"), F.when(F.col("event_type") != "error", F.col("event_type")).alias("kind"))


@register("dedup_ties", f"""
SELECT 'first' AS kept, event_id, user_id, kind, ordinal FROM (
  SELECT *, row_number() OVER (PARTITION BY user_id, kind ORDER BY ordinal NULLS LAST, event_id) AS rn FROM {_ORDINALS_SQL} e) t WHERE rn = 1
UNION ALL
SELECT 'last', event_id, user_id, kind, ordinal FROM (
  SELECT *, row_number() OVER (PARTITION BY user_id, kind ORDER BY ordinal DESC NULLS FIRST, event_id DESC) AS rn FROM {_ORDINALS_SQL} e) t WHERE rn = 1
UNION ALL
SELECT 'surplus', event_id, user_id, kind, ordinal FROM (
  SELECT *, row_number() OVER (PARTITION BY user_id, kind ORDER BY ordinal NULLS LAST, event_id) AS rn FROM {_ORDINALS_SQL} e) t WHERE rn > 1""")
def dedup_ties(spark, sf):
    """W01 + W02 + W03 with NULL keys, NULL ordinals and ordinals that repeat: first rows, last rows, and what keeping the first deletes."""
    ev, args = ordinal_events(spark, sf), (["user_id", "kind"], "ordinal")
    cols = ["event_id", "user_id", "kind", "ordinal"]
    parts = (("first", dedup.keep_first(ev, *args, tie_break=["event_id"])), ("last", dedup.keep_last(ev, *args, tie_break=["event_id"])),
             ("surplus", dedup.surplus_rows(ev, *args, tie_break=["event_id"])))
    out = [df.select(F.lit(kept).alias("kept"), *cols) for kept, df in parts]
    return out[0].unionByName(out[1]).unionByName(out[2])


@register("dedup_located", """
SELECT side, event_id, ts, user_id, event_type, value, props FROM (
  SELECT *, 'first' AS side, row_number() OVER (PARTITION BY user_id, event_type ORDER BY event_id) AS rn FROM events) t WHERE rn = 1
UNION ALL
SELECT 'surplus', event_id, ts, user_id, event_type, value, props FROM (
  SELECT *, row_number() OVER (PARTITION BY user_id, event_type ORDER BY event_id) AS rn FROM events) t WHERE rn > 1
UNION ALL
SELECT 'last', event_id, ts, user_id, event_type, value, props FROM (
  SELECT *, row_number() OVER (PARTITION BY ts ORDER BY event_id DESC) AS rn FROM events) t WHERE rn = 1""")
def dedup_located(spark, sf):
    """W01 + W02 + W03 with late materialisation: rows chosen by their place in the files, payloads read once more by place."""
    ev = read_table(spark, sf, "events")
    args = (["user_id", "event_type"], "event_id")
    parts = (("first", dedup.keep_first_located(ev, *args)), ("surplus", dedup.surplus_located(ev, *args)), ("last", dedup.keep_last_located(ev, ["ts"], "event_id")))
    out = [df.select(F.lit(side).alias("side"), *ev.columns) for side, df in parts]
    return out[0].unionByName(out[1]).unionByName(out[2])


@register("distinct_rows", "SELECT DISTINCT * FROM lineitem")
def distinct_rows(spark, sf):
    li = read_table(spark, sf, "lineitem")
    again = li.select(*reversed(li.columns))
    return dedup.distinct_rows(li.unionByName(again))


@register("distinct_texts", """
SELECT text, min(doc_id) AS first_doc_id, count(*) AS copies FROM documents GROUP BY text""")
def distinct_texts(spark, sf):
    d = read_table(spark, sf, "documents")
    return d.groupBy("text").agg(F.min("doc_id").alias("first_doc_id"), F.count(F.lit(1)).alias("copies"))


# ------------------------------------------------------------ set difference
def _orders_sides(spark, sf):
    o = read_table(spark, sf, "orders").withColumn(
        "o_orderpriority", F.when(F.col("o_orderpriority") != "5-LOW", F.col("o_orderpriority")))
    existing = o.where(F.col("o_orderdate") < ts_lit(inputs.ORDERS_SPLIT))
    new = o.where(F.col("o_orderdate") >= ts_lit(inputs.ORDERS_OVERLAP))
    return existing, new


_ORDERS_NULLED = """(SELECT o_orderkey, o_custkey, o_orderstatus, o_totalprice, o_orderdate,
  CASE WHEN o_orderpriority <> '5-LOW' THEN o_orderpriority END AS o_orderpriority FROM orders)"""


@register("new_rows_except", f"""
SELECT n.*, 'b2' AS batch FROM {_ORDERS_NULLED} n
WHERE n.o_orderdate >= TIMESTAMP '1997-01-01 00:00:00'
  AND NOT EXISTS (SELECT 1 FROM {_ORDERS_NULLED} e WHERE e.o_orderdate < TIMESTAMP '1998-01-01 00:00:00'
    AND e.o_orderkey IS NOT DISTINCT FROM n.o_orderkey AND e.o_custkey IS NOT DISTINCT FROM n.o_custkey
    AND e.o_orderstatus IS NOT DISTINCT FROM n.o_orderstatus AND e.o_totalprice IS NOT DISTINCT FROM n.o_totalprice
    AND e.o_orderdate IS NOT DISTINCT FROM n.o_orderdate AND e.o_orderpriority IS NOT DISTINCT FROM n.o_orderpriority)""")
def new_rows_except(spark, sf):
    existing, new = _orders_sides(spark, sf)
    return incremental.rows_not_in(new.withColumn("batch", F.lit("b2")), existing)


@register("combine_batches", f"""
SELECT * FROM {_ORDERS_NULLED} e WHERE e.o_orderdate < TIMESTAMP '1998-01-01 00:00:00'
UNION ALL
SELECT * FROM {_ORDERS_NULLED} n WHERE n.o_orderdate >= TIMESTAMP '1998-01-01 00:00:00'""")
def combine_batches(spark, sf):
    existing, new = _orders_sides(spark, sf)
    return incremental.combine_batches(existing, new)


# ---------------------------------------------------------------------- sort
@register("typed_sort", """
SELECT p_partkey, p_type, p_size, row_number() OVER (ORDER BY p_type, p_size, p_partkey) AS sort_pos FROM part""")
def typed_sort(spark, sf):
    p = read_table(spark, sf, "part").select("p_partkey", "p_type", "p_size")
    return ordering.sort_positions(p, [["p_type", "text_asc"], ["p_size", "number_asc"]], "p_partkey")


# ------------------------------------------------------- whole-catalog jobs
def event_payload_rows(spark, sf):
    """Every event as a row of dataset ``event_type`` with a VARIANT payload."""
    # The payloads take far longer to make and read than the rows to move: rows are dealt evenly over the tasks, however few files they come from.
    ev = read_table(spark, sf, "events").repartition(int(spark.conf.get("spark.sql.shuffle.partitions")))
    k = F.get_json_object("props", "$.k").cast("bigint")
    map_url = F.when(F.col("event_type") == "view", F.concat(F.lit("http://m/"), F.col("event_id").cast("string"))) \
        .when((F.col("event_type") == "purchase") & (F.col("value") > 400),
              F.concat(F.lit("http://m/"), F.col("event_id").cast("string")))
    payload = F.struct(F.col("event_id"), F.col("user_id"), F.date_format("ts", "yyyy/MM/dd HH:mm:ss").alias("ts"),
                       F.col("value"), k.alias("k"), map_url.alias(MAP_URL_FIELD))
    return ev.select(F.col("event_type").alias("dataset_id"), F.col("event_id").alias("_ord"), "ts",
                     F.parse_json(F.to_json(payload)).alias("v"))


def event_configs(spark, sf):
    """One config row per dataset (event type), derived from the data."""
    t = read_table(spark, sf, "events").select(F.col("event_type").alias("dataset_id")).distinct()
    short = F.length("dataset_id") <= 5
    return t.select(
        "dataset_id",
        F.when(short, F.array(F.lit("user_id"), F.lit("ts"))).otherwise(F.array(F.lit("event_id"))).alias("keys"),
        F.when(F.col("dataset_id") == "click", F.lit("ts")).alias("date_col"),
        F.concat("dataset_id", F.when(F.col("dataset_id").isin("signup", "view"), F.lit(" 代碼"))
                 .otherwise(F.lit(""))).alias("title"),
        F.when(short, F.array(F.lit("user_id"))).otherwise(F.array(F.lit("k"))).alias("dedup_keys"),
        F.when(short, F.array(F.array(F.lit("ts"), F.lit("date_asc")), F.array(F.lit("value"), F.lit("number_asc"))))
        .otherwise(F.array(F.array(F.lit("k"), F.lit("number_asc")), F.array(F.lit("user_id"), F.lit("number_asc"))))
        .alias("sort_keys"),
        F.when(F.col("dataset_id").isin("purchase", "signup"), F.array(F.lit("user_id")))
        .when(F.col("dataset_id") == "view", F.array(F.lit("k"))).alias("merge_keys"),
        F.when(F.col("dataset_id").isin("purchase", "view"), F.lit(True)).alias("auto_merge"))


_EV_SQL = """(SELECT event_type AS dataset_id, event_id AS _ord, user_id, ts, value,
   strftime(ts, '%Y/%m/%d %H:%M:%S') AS ts_text, CAST(json_extract(props, '$.k') AS BIGINT) AS k,
   CASE WHEN event_type = 'view' THEN 'http://m/' || CAST(event_id AS VARCHAR)
        WHEN event_type = 'purchase' AND value > 400 THEN 'http://m/' || CAST(event_id AS VARCHAR) END AS map_url
 FROM events)"""


# Per-dataset sort spec of the test configs, in SQL: short type names sort by
# (ts, value), the others by (k, user_id); landing order breaks ties.
_SPEC_ORDER_SQL = ("CASE WHEN length({t}.dataset_id) <= 5 THEN date_trunc('second', {t}.ts) END, "
                   "CASE WHEN length({t}.dataset_id) <= 5 THEN {t}.value END, "
                   "CASE WHEN length({t}.dataset_id) > 5 THEN {t}.k END, "
                   "CASE WHEN length({t}.dataset_id) > 5 THEN {t}.user_id END, {t}._ord")


_REFRESH_SQL = f"""
WITH r AS (SELECT * FROM {_EV_SQL} e
           WHERE dataset_id <> 'click' OR date_trunc('second', ts) >= TIMESTAMP '2024-01-11 00:00:00'),
s AS (SELECT *, _ord + 1 AS seq FROM {_EV_SQL} e WHERE ts < TIMESTAMP '2024-01-21 00:00:00'),
first AS (SELECT dataset_id, m FROM (SELECT r.dataset_id, COALESCE(r.map_url, '') AS m,
            row_number() OVER (PARTITION BY r.dataset_id ORDER BY {_SPEC_ORDER_SQL.format(t="r")}) AS rn FROM r) t WHERE rn = 1),
mode AS (SELECT f.dataset_id, CASE WHEN f.m <> '' OR f.dataset_id IN ('signup', 'view') THEN 'full' ELSE 'incremental' END AS mode
         FROM first f),
full_rows AS (SELECT r.dataset_id, r._ord, 'full' AS mode,
                row_number() OVER (PARTITION BY r.dataset_id ORDER BY {_SPEC_ORDER_SQL.format(t="r")}) AS seq
              FROM r JOIN mode USING (dataset_id) WHERE mode.mode = 'full'),
inc AS (SELECT r.* FROM r JOIN mode USING (dataset_id) WHERE mode.mode = 'incremental'
          AND NOT EXISTS (SELECT 1 FROM s WHERE s.dataset_id = r.dataset_id AND (
            CASE WHEN length(r.dataset_id) <= 5 THEN s.user_id = r.user_id AND s.ts_text = r.ts_text
                 ELSE s._ord = r._ord END))),
top AS (SELECT dataset_id, max(seq) AS top FROM s GROUP BY dataset_id),
inc_rows AS (SELECT inc.dataset_id, inc._ord, 'incremental' AS mode,
               COALESCE(top.top, 0) + row_number() OVER (PARTITION BY inc.dataset_id ORDER BY {_SPEC_ORDER_SQL.format(t="inc")}) AS seq
             FROM inc LEFT JOIN top USING (dataset_id))"""
_ROW_ID_SQL = "u.dataset_id || lpad(CAST(seq AS VARCHAR), CAST(greatest(7, length(CAST(seq AS VARCHAR))) AS INTEGER), '0') AS row_id"


def record_fields():
    """The fields of a stored record, read back from its JSON text."""
    return [F.get_json_object("record", f"$.{name}").cast(kind).alias(f"rec_{name}")
            for name, kind in (("event_id", "bigint"), ("user_id", "bigint"), ("ts", "string"), ("value", "double"), ("k", "bigint"))]


@register("refresh_all", f"""{_REFRESH_SQL},
u AS (SELECT * FROM full_rows UNION ALL SELECT * FROM inc_rows)
SELECT u.dataset_id, u._ord, mode, seq, {_ROW_ID_SQL}, e._ord AS rec_event_id, e.user_id AS rec_user_id,
  e.ts_text AS rec_ts, e.value AS rec_value, e.k AS rec_k
FROM u JOIN {_EV_SQL} e ON e._ord = u._ord""")
def refresh_all_q(spark, sf):
    """Lifecycle 3.1 over every dataset at once (see harvest.plans.refresh), against a store's key index and ledger."""
    from harvest.plans.refresh import refresh_all
    rows, configs = event_payload_rows(spark, sf), event_configs(spark, sf)
    with event_store(spark, sf) as store:
        out = refresh_all(rows.drop("ts"), store, configs, cutoff=F_CUTOFF)
        return out.select("dataset_id", "_ord", "mode", "seq", "row_id", *record_fields()).checkpoint()


@contextmanager
def event_store(spark, sf):
    """A store in the shared folder that holds the events before STORE_BEFORE; deleted at the end."""
    from harvest.plans.refresh import load_store
    from harvest.session import checkpoint_dir
    from harvest.store import Store
    store = Store(spark, os.path.join(checkpoint_dir(spark), "harvest", f"store-{uuid.uuid4().hex}"))
    try:
        stored = event_payload_rows(spark, sf).where(F.col("ts") < ts_lit(inputs.STORE_BEFORE)).withColumn("seq", F.col("_ord") + 1)
        load_store(store, stored, event_configs(spark, sf))
        yield store
    finally:
        store.remove()


_STORED_SQL = f"""{_REFRESH_SQL},
u AS (SELECT dataset_id, _ord, seq FROM full_rows UNION ALL SELECT dataset_id, _ord, seq FROM inc_rows
      UNION ALL SELECT dataset_id, _ord, seq FROM s WHERE dataset_id NOT IN (SELECT dataset_id FROM mode WHERE mode = 'full'))"""


@register("refresh_store", f"""{_STORED_SQL}
SELECT u.dataset_id, seq, {_ROW_ID_SQL}, e._ord AS rec_event_id, e.user_id AS rec_user_id,
  e.ts_text AS rec_ts, e.value AS rec_value, e.k AS rec_k
FROM u JOIN {_EV_SQL} e ON e._ord = u._ord""")
def refresh_store_q(spark, sf):
    """Lifecycle 3.1 with its writes (K01, K02, P05): the landed rows are refreshed into a store
    twice, and the stored table is returned; the second run finds nothing new."""
    from harvest.plans.refresh import refresh_store
    rows, configs = event_payload_rows(spark, sf), event_configs(spark, sf)
    with event_store(spark, sf) as store:
        for _ in range(2):
            refresh_store(rows.drop("ts"), store, configs, cutoff=F_CUTOFF)
        return store.rows().select("dataset_id", "seq", "row_id", *record_fields()).checkpoint()


# Rows that are landed twice: purchases of even value. Datasets without key columns: signups (a code list) and errors.
_LANDED_TWICE_SQL = "dataset_id = 'purchase' AND CAST(floor(value) AS BIGINT) % 2 = 0"


@register("refresh_status", f"""{_REFRESH_SQL},
d AS (SELECT dataset_id, count(*) AS unique_rows, CAST(count(*) FILTER ({_LANDED_TWICE_SQL}) AS BIGINT) AS twice FROM {_EV_SQL} e GROUP BY dataset_id),
n AS (SELECT dataset_id, count(*) AS n FROM (SELECT dataset_id FROM full_rows UNION ALL SELECT dataset_id FROM inc_rows) x GROUP BY dataset_id),
t AS (SELECT dataset_id, count(*) AS n FROM s GROUP BY dataset_id),
o AS (SELECT d.dataset_id, COALESCE(mode.mode, 'incremental') AS mode, unique_rows + twice AS downloaded, unique_rows, COALESCE(n.n, 0) AS fresh, COALESCE(t.n, 0) AS stored
      FROM d LEFT JOIN mode USING (dataset_id) LEFT JOIN n USING (dataset_id) LEFT JOIN t USING (dataset_id))
SELECT run, dataset_id, mode, CASE WHEN dataset_id = 'error' THEN 'error' WHEN new_rows > 0 THEN 'updated' ELSE 'unchanged' END AS status, downloaded, unique_rows, new_rows,
       CASE WHEN mode = 'full' AND new_rows > 0 THEN new_rows ELSE stored + CASE WHEN dataset_id = 'error' THEN 0 ELSE fresh END END AS total_rows
FROM (SELECT o.*, run, CASE WHEN dataset_id = 'error' OR (run = 2 AND mode <> 'full') THEN 0 ELSE fresh END AS new_rows FROM o, (VALUES (1), (2)) v(run)) x""")
def refresh_status(spark, sf):
    """A07 + A08: the outcome of each dataset in two refreshes of the same landed rows, some of them landed twice; one dataset has no key
    columns and is not compared, another has none and is replaced."""
    from harvest.plans.refresh import refresh_store
    rows = event_payload_rows(spark, sf).drop("ts")
    value = F.try_variant_get("v", "$.value", "double")
    twice = rows.where((F.col("dataset_id") == "purchase") & (F.floor(value) % 2 == 0)).withColumn("_ord", F.col("_ord") + (1 << 40))
    configs = event_configs(spark, sf).withColumn("keys", F.when(~F.col("dataset_id").isin("signup", "error"), F.col("keys")))
    out = None
    with event_store(spark, sf) as store:
        for run in (1, 2):
            got = refresh_store(rows.unionByName(twice), store, configs, cutoff=F_CUTOFF).select(F.lit(run).alias("run"), "*")
            out = got if out is None else out.unionByName(got)
        return out.checkpoint()


_TOTALS_SQL = f"""{_STORED_SQL},
moved AS (SELECT CASE WHEN dataset_id = 'click' THEN 'clicks' ELSE dataset_id END AS dataset_id, _ord, seq, {_ROW_ID_SQL} FROM u WHERE dataset_id <> 'error')"""


@register("store_moves", f"""{_TOTALS_SQL}
SELECT m.dataset_id, m.seq, m.row_id, m._ord AS rec_event_id FROM moved m""")
def store_moves(spark, sf):
    """K12 + K13 on the store: a refresh, then a dataset renamed, another deleted, the rest merged into one piece each; rows keep their ids."""
    with moved_store(spark, sf) as store:
        return store.rows().select("dataset_id", "seq", "row_id", F.get_json_object("record", "$.event_id").cast("bigint").alias("rec_event_id")).checkpoint()


@register("store_totals", f"""{_TOTALS_SQL}
SELECT e.dataset_id, COALESCE(count(m.seq), 0) AS row_count, COALESCE(max(m.seq), 0) AS max_seq
FROM (SELECT DISTINCT event_type AS dataset_id FROM events UNION SELECT 'clicks') e LEFT JOIN moved m USING (dataset_id) GROUP BY e.dataset_id""")
def store_totals(spark, sf):
    """S08 + A01 + A05: row counts and largest sequences of all datasets, from the ledger; datasets without rows have 0."""
    from harvest.operators.catalog import with_totals
    named = read_table(spark, sf, "events").select(F.col("event_type").alias("dataset_id")).distinct()
    ids_ = named.unionByName(spark.createDataFrame([("clicks",)], "dataset_id string"))
    with moved_store(spark, sf) as store:
        return with_totals(ids_, store.totals()).checkpoint()


@contextmanager
def moved_store(spark, sf):
    from harvest.plans.refresh import refresh_store
    with event_store(spark, sf) as store:
        refresh_store(event_payload_rows(spark, sf).drop("ts"), store, event_configs(spark, sf), cutoff=F_CUTOFF)
        store.rename("click", "clicks")
        store.delete(spark.createDataFrame([("error",)], "dataset_id string"))
        store.compact(over=1)
        store.sweep()
        yield store


F_CUTOFF = __import__("datetime").datetime(*inputs.EVENTS_CUTOFF)


@register("dedup_all", f"""
WITH s1 AS (SELECT * FROM (
    SELECT e.*, row_number() OVER (PARTITION BY dataset_id,
       CASE WHEN length(dataset_id) <= 5 THEN CAST(user_id AS VARCHAR) ELSE CAST(k AS VARCHAR) END ORDER BY _ord) AS rn
    FROM {_EV_SQL} e) t WHERE rn = 1),
s2 AS (SELECT * FROM (
    SELECT s1.*, row_number() OVER (PARTITION BY dataset_id, user_id ORDER BY _ord DESC) AS rn2
    FROM s1 WHERE dataset_id = 'purchase') t WHERE rn2 = 1)
SELECT dataset_id, _ord AS row_id FROM s1 WHERE dataset_id <> 'purchase'
UNION ALL SELECT dataset_id, _ord FROM s2""")
def dedup_all_q(spark, sf):
    """Lifecycle 3.2 over every dataset at once: keep-first on each dataset's
    sort keys, then keep-last on merge keys where the merge is switched on
    (purchase); signup has no decision (NULL), view is a code list (skipped)."""
    from harvest.plans.refresh import dedup_all
    rows = event_payload_rows(spark, sf).select("dataset_id", F.col("_ord").alias("row_id"), "v")
    cfg = event_configs(spark, sf).select("dataset_id", F.col("dedup_keys").alias("keys"), "merge_keys",
                                           "auto_merge", "title")
    return dedup_all(rows, cfg).select("dataset_id", "row_id")


@register("keyed_dedup", """
SELECT event_id, ts, user_id, event_type, value, props FROM (
  SELECT *, row_number() OVER (PARTITION BY user_id, event_type ORDER BY event_id) AS rn FROM events) t
WHERE rn = 1""")
def keyed_dedup(spark, sf):
    """K14 + W01: events laid out bucketed and sorted by the match keys (the
    index of the original, re-aimed), then de-duplicated: the aggregate reads
    co-partitioned buckets, so it needs no shuffle."""
    import os
    import uuid
    from harvest.session import checkpoint_dir
    from harvest.sinks import write_keyed_layout
    tag = uuid.uuid4().hex[:12]
    name = f"harvest_layout_{tag}"
    path = os.path.join(checkpoint_dir(spark), "harvest", f"layout-{tag}")
    buckets = int(spark.conf.get("spark.sql.shuffle.partitions"))     # session.scale_conf sizes it from the input
    write_keyed_layout(spark, read_table(spark, sf, "events"), name, ["user_id", "event_type"], buckets, path=path)
    return dedup.keep_first(spark.table(name), ["user_id", "event_type"], "event_id")


@register("distinct_records", """
SELECT min(event_id) AS _ord FROM events GROUP BY user_id, event_type, CAST(json_extract(props, '$.k') AS BIGINT)""")
def distinct_records_q(spark, sf):
    """A03 on raw records: each event landed as a JSON object (fields in two
    different orders, depending on the event), distinct by content with the
    first occurrence kept."""
    ev = read_table(spark, sf, "events")
    k = F.get_json_object("props", "$.k").cast("bigint")
    one = F.to_json(F.struct(F.col("user_id"), F.col("event_type"), k.alias("k")))
    other = F.to_json(F.struct(k.alias("k"), F.col("event_type"), F.col("user_id")))
    text = F.when(F.pmod(F.col("event_id"), F.lit(2)) == 0, one).otherwise(other)   # key order varies
    rows = ev.select(F.col("event_id").alias("_ord"), F.parse_json(text).alias("v"))
    return dedup.distinct_records(rows).select("_ord")


@register("incremental_keyed_cut", f"""
SELECT i.event_id FROM ({LANDED_EVENTS_SQL}) i
WHERE CAST(i.ts AS DATE) >= DATE '2024-01-11'
  AND NOT EXISTS (SELECT 1 FROM ({STORED_EVENTS_SQL}) s
                  WHERE CAST(s.ts AS DATE) >= DATE '2024-01-11'
                    AND s.dataset_id = i.dataset_id AND s.user_id = i.user_id AND s.event_date = i.event_date)""")
def incremental_keyed_cut(spark, sf):
    """J01 with the date filter when the date column is part of the key (Q30):
    both sides are cut at the cutoff before the anti-join."""
    incoming = inputs.landed_events(spark, sf)
    store = inputs.stored_events(spark, sf)
    new = incremental.incremental_load(incoming, store, ["dataset_id", "user_id", "event_date"],
                                       cutoff=F_CUTOFF, date_col="event_date")
    return new.select("event_id")
