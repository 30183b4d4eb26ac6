"""History, time travel, diff, restore, clones, expiry."""

from __future__ import annotations

from datetime import timedelta

from pyspark.sql import functions as F

from ..change_table import ChangeTable
from ..maintained import MaintainedCounts
from .registry import (ORDERS_V3, ORDERS_V4, fresh, hour, orders_clone, orders_versions, query, table)


@query(ORDERS_V4)
def snapshot_current(spark, sf):
    """By name: a view over the latest version, read with SQL."""
    orders_versions(spark, sf).create_view("orders_now")
    return spark.sql("SELECT * FROM orders_now")


@query("SELECT * FROM orders WHERE FALSE")
def create_empty(spark, sf):
    return orders_versions(spark, sf).at_version(0)


@query("SELECT * FROM orders")
def snapshot_at_version(spark, sf):
    return orders_versions(spark, sf).at_version(2)


@query(ORDERS_V3)
def snapshot_at_timestamp(spark, sf):
    return orders_versions(spark, sf).at_timestamp(hour(3) + timedelta(minutes=30))


@query("""SELECT o_orderstatus, COUNT(*) AS orders FROM (
    SELECT CASE WHEN o_orderstatus = 'F' THEN 'X' ELSE o_orderstatus END AS o_orderstatus
    FROM orders WHERE NOT (o_totalprice < 50000)) GROUP BY o_orderstatus""")
def snapshot_rollup(spark, sf):
    """A query on a snapshot reads only its own columns of the change sets."""
    return orders_versions(spark, sf).current().groupBy("o_orderstatus").agg(F.count("*").alias("orders"))


@query("""SELECT 0 AS version, 'CREATE TABLE' AS operation, CAST(0 AS BIGINT) AS rows_added, CAST(0 AS BIGINT) AS rows_removed
    UNION ALL SELECT 1, 'WRITE', COUNT(*), 0 FROM orders WHERE o_orderkey % 2 = 0
    UNION ALL SELECT 2, 'WRITE', COUNT(*), 0 FROM orders WHERE o_orderkey % 2 <> 0
    UNION ALL SELECT 3, 'UPDATE', COUNT(*), COUNT(*) FROM orders WHERE o_orderstatus = 'F'
    UNION ALL SELECT 4, 'DELETE', 0, COUNT(*) FROM orders WHERE o_totalprice < 50000""")
def table_history(spark, sf):
    return orders_versions(spark, sf).history().select("version", "operation", "rows_added", "rows_removed")


@query("SELECT 0 AS min_version, 4 AS max_version FROM orders LIMIT 1")
def version_range(spark, sf):
    return orders_versions(spark, sf).version_range()


@query("""SELECT 4 AS version, COUNT(*) AS num_rows, 4 AS num_segments, TRUE AS has_files FROM orders
    WHERE NOT (o_totalprice < 50000)""")
def table_detail(spark, sf):
    return orders_versions(spark, sf).detail().select(
        "version", "num_rows", "num_segments",
        ((F.col("num_files") > 0) & (F.col("size_bytes") > 0)).alias("has_files"))


@query(f"({ORDERS_V4}) EXCEPT SELECT * FROM orders")
def diff_added(spark, sf):
    return orders_versions(spark, sf).diff(2, 4)[0]


@query(f"SELECT * FROM orders EXCEPT ({ORDERS_V4})")
def diff_removed(spark, sf):
    return orders_versions(spark, sf).diff(2, 4)[1]


@query(f"({ORDERS_V4}) EXCEPT ALL SELECT * FROM orders")
def diff_added_bag(spark, sf):
    return orders_versions(spark, sf).diff(2, 4, bag=True)[0]


@query("SELECT * FROM orders WHERE o_orderkey % 2 = 0")
def restore_version(spark, sf):
    """Rows are added and others deleted, then the first version is restored by a commit of its own."""
    t = orders_clone(spark, sf, 1)
    orders = table(spark, sf, "orders")
    t.append(orders.filter("o_orderkey % 2 <> 0"))
    t.delete("o_totalprice < 50000")
    t.restore(0)
    return t.current()


@query("SELECT * FROM orders")
def delete_then_restore(spark, sf):
    """All orders of the busiest customer are deleted, then the version before is restored."""
    t = orders_clone(spark, sf, 2)
    busiest = t.current().groupBy("o_custkey").count().orderBy(F.desc("count"), "o_custkey").first()
    t.delete(F.col("o_custkey") == busiest["o_custkey"])
    t.restore(t.version - 1)
    return t.current()


@query("SELECT * FROM orders WHERE o_orderkey <> (SELECT MIN(o_orderkey) FROM orders WHERE o_orderkey >= 7)")
def delete_one_row(spark, sf):
    """One row of the whole table goes; what is written is its address."""
    t = orders_clone(spark, sf, 2)
    key = t.current().filter("o_orderkey >= 7").agg(F.min("o_orderkey")).first()[0]
    t.delete(F.col("o_orderkey") == key)
    return t.current()


@query("""SELECT o_orderkey, o_orderstatus AS before, CASE WHEN o_totalprice < 60000 THEN 'B'
    ELSE CASE WHEN o_orderstatus = 'F' THEN 'A' ELSE o_orderstatus END END AS after FROM orders""")
def two_updates_before_after(spark, sf):
    t = orders_clone(spark, sf, 2)
    t.update("o_orderstatus = 'F'", {"o_orderstatus": "A"})
    t.update("o_totalprice < 60000", {"o_orderstatus": "B"})
    before = t.at_version(0).select("o_orderkey", F.col("o_orderstatus").alias("before"))
    after = t.at_version(2).select("o_orderkey", F.col("o_orderstatus").alias("after"))
    return before.join(after, "o_orderkey")


@query("""SELECT o_orderkey, o_custkey, CASE WHEN o_custkey BETWEEN 5 AND 100 THEN 'S' ELSE o_orderstatus END
    AS o_orderstatus, o_totalprice, o_orderdate, o_orderpriority FROM orders
    WHERE o_orderpriority NOT IN ('1-URGENT', '5-LOW')""")
def update_between_delete_in(spark, sf):
    t = orders_clone(spark, sf, 2)
    t.update("o_custkey BETWEEN 5 AND 100", {"o_orderstatus": "S"})
    t.delete(F.col("o_orderpriority").isin("1-URGENT", "5-LOW"))
    return t.current()


@query("SELECT * FROM orders WHERE o_orderstatus = 'O'")
def overwrite_commit(spark, sf):
    t = orders_clone(spark, sf)
    t.overwrite(table(spark, sf, "orders").filter("o_orderstatus = 'O'"))
    return t.current()


@query("""SELECT * FROM orders WHERE o_orderkey % 2 = 0
    UNION ALL SELECT * FROM orders WHERE o_totalprice > 200000""")
def append_rows(spark, sf):
    t = orders_clone(spark, sf, 1)
    t.append(table(spark, sf, "orders").filter("o_totalprice > 200000"))
    return t.current()


@query("SELECT * FROM orders")
def clone_shallow(spark, sf):
    """The source changes after the clone was taken; the clone does not."""
    source = orders_clone(spark, sf, 2)
    clone = source.clone_shallow(fresh(spark, "shallow"))
    source.delete("o_orderkey % 3 = 0")
    return clone.current()


@query(ORDERS_V3)
def clone_deep(spark, sf):
    return orders_versions(spark, sf).clone_deep(fresh(spark, "deep"), 3).current()


@query("SELECT * FROM orders WHERE o_orderkey % 2 = 0")
def backup_version(spark, sf):
    return orders_versions(spark, sf).backup(fresh(spark, "backup"), 1).current()


@query(ORDERS_V4)
def snapshot_after_expire(spark, sf):
    t = orders_versions(spark, sf).clone_deep(fresh(spark, "expire"), 2)
    t.update("o_orderstatus = 'F'", {"o_orderstatus": "X"})
    t.delete("o_totalprice < 50000")
    t.expire(0, force=True)
    return t.current()


@query("""SELECT o_orderstatus, year(o_orderdate) AS y, COUNT(*) AS cnt, SUM(o_custkey) AS sum_o_custkey FROM (
      SELECT * REPLACE (CASE WHEN o_totalprice < 50000 THEN 'C' ELSE o_orderstatus END AS o_orderstatus) FROM orders WHERE o_orderkey % 5 <> 0)
    GROUP BY 1, 2""")
def partition_counts_incremental(spark, sf):
    """Counts by status and year, brought along through insert, update, delete and restore from the changes alone."""
    orders = table(spark, sf, "orders").withColumn("y", F.year("o_orderdate").cast("bigint"))
    t = ChangeTable.create(spark, fresh(spark, "counted"), orders.filter("o_orderkey % 2 = 0"))
    counts = MaintainedCounts(t, fresh(spark, "counts"), ["o_orderstatus", "y"], ["o_custkey"])
    counts.refresh()
    t.append(orders.filter("o_orderkey % 2 <> 0"))
    counts.refresh()
    t.update("o_totalprice < 50000", {"o_orderstatus": "C"})
    t.delete("o_orderkey % 5 = 0")
    counts.refresh()
    t.delete("o_orderkey % 7 = 0")
    counts.refresh()
    t.restore(t.version - 1)
    return counts.refresh().withColumn("sum_o_custkey", F.col("sum_o_custkey").cast("decimal(38,0)"))
