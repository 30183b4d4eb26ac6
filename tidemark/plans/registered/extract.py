"""Incremental extract and landing."""

from __future__ import annotations

from datetime import timedelta

from pyspark.sql import functions as F
from pyspark.sql import types as T

from ...sinks import land_increment as land
from ...sources import read_delimited
from ..incremental import (FrameSource, TableBookmarks, bookmark_advance as advance, extract_full as full,
                           extract_since as since, read_bookmark, run_incremental)
from .registry import NOON, fresh, query, table

MIDDLE = "1998-01-01 00:00:00"
LATE = "2000-06-30 00:00:00"


@query("SELECT * FROM orders")
def extract_full(spark, sf):
    return full(table(spark, sf, "orders"))


@query(f"SELECT * FROM orders WHERE o_orderdate > TIMESTAMP '{MIDDLE}' AND o_orderdate <= TIMESTAMP '{LATE}'")
def extract_since(spark, sf):
    return since(table(spark, sf, "orders"), "o_orderdate", MIDDLE, LATE)


BOOKMARKS = """SELECT 'customer' AS table_name, '1970-01-01 00:00:00' AS last_value
    UNION ALL SELECT 'events', CAST(MAX(ts) AS VARCHAR) FROM events"""


@query(BOOKMARKS + " UNION ALL SELECT 'orders', CAST(MAX(o_orderdate) AS VARCHAR) FROM orders")
def bookmark_advance(spark, sf):
    """One source moves on, the rows of the others stay."""
    seeds = spark.range(1).select(F.explode(F.array(F.lit("customer"), F.lit("orders"))).alias("table_name"),
                                  F.lit("1970-01-01 00:00:00").alias("last_value"))
    events = table(spark, sf, "events").agg(F.max("ts").cast("string").alias("last_value"))
    marks = seeds.unionByName(events.select(F.lit("events").alias("table_name"), "last_value"))
    newest = table(spark, sf, "orders").agg(F.max("o_orderdate").cast("string").alias("last_value"))
    return advance(marks, "orders", newest)


@query("SELECT * FROM orders WHERE o_orderdate > (SELECT MAX(o_orderdate) - INTERVAL 30 DAY FROM orders)")
def extract_after_bookmark(spark, sf):
    """The bookmark is looked up first; a source without one starts at 1970."""
    orders = table(spark, sf, "orders")
    marks = orders.agg((F.max("o_orderdate") - F.expr("INTERVAL 30 DAYS")).cast("string").alias("last_value")).select(
        F.lit("orders").alias("table_name"), "last_value")
    assert read_bookmark(marks, "events", "1970-01-01 00:00:00") == "1970-01-01 00:00:00"
    return since(orders, "o_orderdate", read_bookmark(marks, "orders"))


@query("SELECT *, DATE '2026-01-15' AS ingest_date FROM conversations")
def land_csv(spark, sf):
    """Landing as CSV with a header."""
    landing, rows = fresh(spark, "landing-csv"), table(spark, sf, "conversations")
    land(rows, landing, fmt="csv", at=NOON)
    shape = T.StructType([*rows.schema, T.StructField("ingested_at", T.StringType()), T.StructField("ingest_date", T.DateType())])
    return read_delimited(spark, landing, schema=shape).drop("ingested_at")


@query(f"""SELECT *, CASE WHEN o_orderdate <= TIMESTAMP '{MIDDLE}' THEN 'first' ELSE 'second' END AS batch_id,
    DATE '2026-01-15' AS ingest_date FROM orders""")
def land_increment(spark, sf):
    orders, landing = table(spark, sf, "orders"), fresh(spark, "landing")
    land(since(orders, "o_orderdate", None, MIDDLE), landing, batch="first", at=NOON)
    land(since(orders, "o_orderdate", MIDDLE), landing, batch="second", at=NOON)
    return spark.read.parquet(landing).drop("ingested_at")


@query(f"""SELECT o_orderkey, o_orderdate, o_totalprice,
    CASE WHEN o_orderdate <= TIMESTAMP '{MIDDLE}' THEN 'orders::' || (
        SELECT CAST(MAX(o_orderdate) AS VARCHAR) FROM orders WHERE o_orderdate <= TIMESTAMP '{MIDDLE}')
    ELSE 'orders:' || (
        SELECT CAST(MAX(o_orderdate) AS VARCHAR) FROM orders WHERE o_orderdate <= TIMESTAMP '{MIDDLE}')
        || ':' || (SELECT CAST(MAX(o_orderdate) AS VARCHAR) FROM orders) END AS batch_id FROM orders""", name="run_incremental")
def incremental_runs(spark, sf):
    """Full load of the rows there were, the newer rows next, and a run that finds nothing."""
    orders, landing = table(spark, sf, "orders"), fresh(spark, "incremental")
    marks = TableBookmarks(spark, fresh(spark, "bookmarks"))
    early = FrameSource(since(orders, "o_orderdate", None, MIDDLE), "o_orderdate")
    late = FrameSource(orders, "o_orderdate")
    run_incremental("orders", early, marks, landing, now=NOON)
    run_incremental("orders", late, marks, landing, now=NOON)
    run_incremental("orders", late, marks, landing, now=NOON)
    return spark.read.parquet(landing).select("o_orderkey", "o_orderdate", "o_totalprice", "batch_id")


START_US = 1_700_000_000_000_000


@query("SELECT event_id, user_id, event_type, value FROM events")
def run_incremental_other_zone(spark, sf):
    """The bookmark of instants is read in another time zone than it was written in; nothing is lost."""
    events = table(spark, sf, "events").select("event_id", "user_id", "event_type", "value")
    first, last = events.agg(F.min("event_id"), F.max("event_id")).first()
    # a microsecond an id; the rows of the second run all come after those of the first, however far the ids reach
    step = F.coalesce(F.col("event_id") - F.lit(first), F.lit(0))
    late_step = F.when(F.col("event_id") % 3 == 0, 0).otherwise((last or 0) - (first or 0) + 1)
    early = events.filter("event_id % 3 = 0").withColumn("changed", F.timestamp_micros(START_US + step))
    late = events.withColumn("changed", F.timestamp_micros(START_US + step + late_step))
    landing, marks = fresh(spark, "zones"), TableBookmarks(spark, fresh(spark, "zone-bookmarks"))
    zone = spark.conf.get("spark.sql.session.timeZone")
    try:
        for run_zone, rows in (("Asia/Tokyo", early), ("America/New_York", late)):
            spark.conf.set("spark.sql.session.timeZone", run_zone)
            run_incremental("events", FrameSource(rows, "changed"), marks, landing, now=NOON)
    finally:
        spark.conf.set("spark.sql.session.timeZone", zone)
    return spark.read.parquet(landing).select("event_id", "user_id", "event_type", "value")


class _DyingBookmarks(TableBookmarks):
    def advance(self, *args) -> None:
        raise RuntimeError("died after landing")


@query("SELECT *, DATE '2026-01-15' AS ingest_date FROM orders")
def land_batch_twice(spark, sf):
    """A run dies between landing and bookmark; the next, a day later and with more rows, takes its place."""
    orders, landing, marks = table(spark, sf, "orders"), fresh(spark, "landing-twice"), fresh(spark, "twice-bookmarks")

    def source(upto):
        return FrameSource(since(orders, "o_orderdate", None, upto), "o_orderdate")

    run_incremental("orders", source(MIDDLE), TableBookmarks(spark, marks), landing, now=NOON, replace=True)
    try:
        run_incremental("orders", source(LATE), _DyingBookmarks(spark, marks), landing, now=NOON, replace=True)
    except RuntimeError:
        run_incremental("orders", source(None), TableBookmarks(spark, marks), landing, now=NOON + timedelta(days=1), replace=True)
    return spark.read.parquet(landing).drop("ingested_at", "batch", "batch_id")
