"""Compaction, clustering, partitioned publishing."""

from __future__ import annotations

from pyspark.sql import functions as F

from ...functions import fill_default
from ...operators import (compact_files as compact, partition_advice as advise, partition_counts as counts, publish_partitioned as publish,
                          zorder_layout as zorder)
from ..change_table import ChangeTable
from .registry import fresh, query, table


def _scattered(spark, sf):
    """Lineitem as many small files."""
    path = fresh(spark, "scattered")
    table(spark, sf, "lineitem").repartition(24).write.parquet(path)
    return path


@query("SELECT * FROM lineitem")
def compact_files(spark, sf):
    return compact(spark, _scattered(spark, sf), fresh(spark, "compact"))


@query("SELECT * FROM lineitem")
def zorder_layout(spark, sf):
    return zorder(spark, _scattered(spark, sf), fresh(spark, "zorder"), ["l_partkey", "l_shipdate"],
                  target_bytes=1 << 20)


@query("SELECT l_suppkey, COUNT(*) AS cnt FROM lineitem WHERE l_suppkey = 7 GROUP BY l_suppkey")
def zorder_lookup(spark, sf):
    """Clustered by one column; a filter on it reads few row groups."""
    lines = zorder(spark, f"{sf}/lineitem.parquet", fresh(spark, "zorder-one"), ["l_suppkey"], target_bytes=1 << 20)
    return counts(lines.filter("l_suppkey = 7"), "l_suppkey")


@query("SELECT * FROM orders")
def optimize_small_appends(spark, sf):
    """Twenty small commits folded into one folder."""
    orders = table(spark, sf, "orders")
    t = ChangeTable.create(spark, fresh(spark, "small-appends"), orders.schema)
    for i in range(20):
        t.append(orders.filter(F.col("o_orderkey") % 20 == i))
    t.optimize()
    return t.current()


@query("SELECT * FROM orders WHERE o_orderkey % 10 <> 0")
def optimize_zorder(spark, sf):
    orders = table(spark, sf, "orders")
    t = ChangeTable.create(spark, fresh(spark, "optimize-zorder"), orders)
    t.delete("o_orderkey % 10 = 0")
    t.optimize(zorder_by=["o_custkey", "o_orderdate"])
    return t.current()


@query("""SELECT event_id, user_id, event_type, value,
    COALESCE(CASE WHEN event_id % 3 = 0 THEN 'web' END, 'unknown') AS source_system,
    CAST(ts AS DATE) AS event_date FROM events""")
def publish_partitioned(spark, sf):
    events = table(spark, sf, "events").select(
        "event_id", "user_id", "event_type", "value",
        F.when(F.col("event_id") % 3 == 0, "web").alias("source_system"), F.to_date("ts").alias("event_date"))
    return publish(fill_default(events, "source_system", "unknown"), fresh(spark, "silver"), ["event_date"])


@query("""SELECT event_type, user_id, COUNT(*) AS cnt FROM events
    WHERE ts >= TIMESTAMP '2024-01-10 00:00:00' AND ts < TIMESTAMP '2024-01-12 00:00:00' GROUP BY 1, 2""")
def partition_pruned_read(spark, sf):
    """A filter on the partition column opens only the folders it names."""
    events = table(spark, sf, "events").withColumn("event_date", F.to_date("ts"))
    silver = publish(events, fresh(spark, "pruned"), ["event_date"])
    return counts(silver.filter("event_date BETWEEN DATE '2024-01-10' AND DATE '2024-01-11'"),
                  "event_type", "user_id")


@query("SELECT CAST(o_orderdate AS DATE) AS order_date, COUNT(*) AS cnt FROM orders GROUP BY 1")
def partition_counts(spark, sf):
    orders = table(spark, sf, "orders").select(F.to_date("o_orderdate").alias("order_date"))
    return counts(orders, "order_date").orderBy("order_date")


@query("SELECT o_orderstatus, COUNT(*) AS cnt FROM orders GROUP BY 1")
def partition_by_status(spark, sf):
    silver = publish(table(spark, sf, "orders"), fresh(spark, "by-status"), ["o_orderstatus"])
    return counts(silver, "o_orderstatus")


@query("SELECT event_id, user_id, event_type, value, '00' || (event_id % 10) AS shard FROM events")
def publish_text_partition(spark, sf):
    """Text of digits in folder names comes back as that text."""
    events = table(spark, sf, "events").select(
        "event_id", "user_id", "event_type", "value", F.concat(F.lit("00"), F.col("event_id") % 10).alias("shard"))
    return publish(events, fresh(spark, "text-partition"), ["shard"])


@query("""SELECT event_id, user_id, event_type, value, CAST(ts AS DATE) AS event_date, TRUE AS files_did_not_grow
    FROM events""")
def optimize_partitioned_zorder(spark, sf):
    """Clustering inside each day does not multiply the files of a table partitioned by day."""
    events = table(spark, sf, "events").select("event_id", "user_id", "event_type", "value", F.to_date("ts").alias("event_date"))
    t = ChangeTable.create(spark, fresh(spark, "optimize-days"), events, partition_by=["event_date"])
    before = t.detail().first()["num_files"]
    t.optimize(zorder_by=["user_id", "event_type"])
    return t.current().withColumn("files_did_not_grow", F.lit(t.detail().first()["num_files"] <= before))


@query("SELECT event_id, user_id, event_type, value, '00' || (event_id % 10) AS shard, CAST(ts AS DATE) AS event_date FROM events")
def compact_partitioned(spark, sf):
    """Compaction of day folders with shards named in zero-padded text: no value changes."""
    events = table(spark, sf, "events").select("event_id", "user_id", "event_type", "value", F.concat(F.lit("00"), F.col("event_id") % 10).alias("shard"),
                                               F.to_date("ts").alias("event_date"))
    path = fresh(spark, "many-shards")
    publish(events, path, ["shard", "event_date"])
    return compact(spark, path, fresh(spark, "compact-shards"))


@query("""SELECT 'event_type' AS candidate, TRUE AS folders_close, TRUE AS share_close, FALSE AS advised UNION ALL SELECT 'event_date', TRUE, TRUE, TRUE
    UNION ALL SELECT 'user_id', TRUE, TRUE, FALSE""")
def partition_advice(spark, sf):
    """Folders and hot shares estimated in one pass over events, held against the exact counts (within 5 %)."""
    events = table(spark, sf, "events").withColumn("event_date", F.to_date("ts"))
    columns = ["event_type", "event_date", "user_id"]
    # folders of about two bytes for every event at least: types and days qualify, users do not
    told = advise(events.drop("props"), columns, target_bytes=16 * events.count())
    exact = None
    for c in columns:
        per = events.groupBy(F.col(c).cast("string").alias("v")).count().agg(
            F.lit(c).alias("candidate"), F.count("*").alias("n"), (F.max("count") / F.sum("count")).alias("share"))
        exact = per if exact is None else exact.unionByName(per)
    close = lambda a, b: F.abs(F.col(a) / F.col(b) - 1) <= 0.05
    return told.join(exact, "candidate").select("candidate", close("folders", "n").alias("folders_close"), close("hot_share", "share").alias("share_close"), "advised")
