"""Inputs the test queries derive from the driver's tables.

Every derived input is computed by Spark from the whole table (no id
subsets, no sampling); the SQL oracle derives the same inputs in SQL.
"""

from __future__ import annotations

import datetime as _dt

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from harvest.functions.times import ts_lit
from harvest.session import read_table

# Fixed split points of the test scenarios.
STORE_BEFORE = _dt.datetime(2024, 1, 21)      # events already stored: ts before this
EVENTS_CUTOFF = (2024, 1, 11)                 # date filter applied to the landed batch
ORDERS_SPLIT = _dt.datetime(1998, 1, 1)       # orders stored before / arriving from
ORDERS_OVERLAP = _dt.datetime(1997, 1, 1)     # re-downloaded orders start here


def landed_events(spark: SparkSession, sf: str) -> DataFrame:
    """Events as a landed batch: the event type is NULL for errors (a NULL key
    part), and the date arrives as ROC-calendar text ``yyy/M/d``. Each event
    belongs to a dataset (prefix 101, sequence = length of its type name)."""
    ev = read_table(spark, sf, "events")
    return ev.select(
        F.concat(F.lit("101"), F.lpad(F.length("event_type").cast("string"), 4, "0")).alias("dataset_id"),
        "event_id", "user_id",
        F.when(F.col("event_type") != "error", F.col("event_type")).alias("kind"),
        "ts", "value",
        F.concat_ws("/", (F.year("ts") - 1911).cast("string"), F.month("ts").cast("string"),
                    F.dayofmonth("ts").cast("string")).alias("event_date"))


def stored_events(spark: SparkSession, sf: str) -> DataFrame:
    """The store: landed events before STORE_BEFORE, with their stored sequence."""
    return (landed_events(spark, sf).where(F.col("ts") < ts_lit(STORE_BEFORE))
            .withColumn("seq", F.col("event_id") + 1))


LANDED_EVENTS_SQL = """
  SELECT '101' || lpad(CAST(length(event_type) AS VARCHAR), 4, '0') AS dataset_id, event_id, user_id,
         CASE WHEN event_type <> 'error' THEN event_type END AS kind,
         ts, value,
         CAST(year(ts) - 1911 AS VARCHAR) || '/' || CAST(month(ts) AS VARCHAR) || '/' || CAST(day(ts) AS VARCHAR) AS event_date
  FROM events"""

STORED_EVENTS_SQL = f"""
  SELECT *, event_id + 1 AS seq FROM ({LANDED_EVENTS_SQL}) le WHERE ts < TIMESTAMP '2024-01-21 00:00:00'"""
