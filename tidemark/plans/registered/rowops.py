"""Row changes, merges, quality rules, schema rules."""

from __future__ import annotations

from pyspark.sql import functions as F

from ...functions import derive_amount, parse_times, stamp_ingest as stamp
from ...operators import (active_rows, amount_consistent, append_evolve, check_constraints,
                          constraint_violations, delete_where, enforce_schema, key_difference, latest_per_key,
                          merge_newer_wins, set_minus, uncastable_rows, update_where)
from ...operators import merge_upsert as upsert
from ...streaming import merge_stream as stream_merge
from ..change_table import ChangeTable
from .registry import (NEW_KEYS, NOON, ORDERS_V3, customer_changes, customer_changes_sql, fresh, merge_sql, query,
                       table)

CUSTOMER = "SELECT * FROM customer"
BATCH = customer_changes_sql()
SECOND = customer_changes_sql(5, 13, 2_000_000)


@query(merge_sql(CUSTOMER, BATCH))
def merge_upsert(spark, sf):
    customer = table(spark, sf, "customer")
    return upsert(customer, customer_changes(customer), "c_custkey")


@query(merge_sql(CUSTOMER, BATCH, "s.c_acctbal > t.c_acctbal"), name="merge_newer_wins")
def merge_newer_wins_by_balance(spark, sf):
    customer = table(spark, sf, "customer")
    return merge_newer_wins(customer, customer_changes(customer), "c_custkey", "c_acctbal")


@query(merge_sql(merge_sql(CUSTOMER, BATCH, "s.c_acctbal > t.c_acctbal"), SECOND,
                 "s.c_acctbal > t.c_acctbal"))
def merge_sequence(spark, sf):
    """Two batches, one after the other, into a versioned table."""
    customer = table(spark, sf, "customer")
    t = ChangeTable.create(spark, fresh(spark, "merge-sequence"), customer)
    t.merge(customer_changes(customer), "c_custkey", "s.c_acctbal > t.c_acctbal")
    t.merge(customer_changes(customer, 5, 13, 2_000_000), "c_custkey", "s.c_acctbal > t.c_acctbal")
    return t.current()


@query(merge_sql(CUSTOMER, BATCH))
def merge_into_table(spark, sf):
    customer = table(spark, sf, "customer")
    t = ChangeTable.create(spark, fresh(spark, "merge-table"), customer)
    t.merge(customer_changes(customer), "c_custkey")
    return t.current()


@query(merge_sql(CUSTOMER, BATCH))
def merge_stream(spark, sf):
    """The change batch arrives as files and is merged by a stream that stops at the end."""
    customer = table(spark, sf, "customer")
    inbox = fresh(spark, "merge-inbox")
    batch = customer_changes(customer)
    batch.write.parquet(inbox)
    t = ChangeTable.create(spark, fresh(spark, "merge-stream"), customer)
    changes = spark.readStream.schema(batch.schema).parquet(inbox)
    stream_merge(changes, t, "c_custkey", fresh(spark, "merge-checkpoint")).awaitTermination()
    return t.current()


STEPS_SQL = """SELECT c_custkey, c_name, c_nationkey, c_acctbal + CASE
      WHEN c_custkey % 3 = 0 AND c_custkey % 2 = 0 THEN 40 WHEN c_custkey % 3 = 0 THEN 30 ELSE 0 END AS c_acctbal, c_mktsegment FROM customer
    UNION ALL SELECT c_custkey + 1000000, c_name, c_nationkey, c_acctbal + 20, c_mktsegment FROM customer WHERE c_custkey % 5 = 0"""


def _steps(customer, steps: str):
    """Changes of some customers, numbered: step n is a balance n times 10 higher."""
    return customer.selectExpr("*", f"explode({steps}) AS step").withColumn("c_acctbal", F.col("c_acctbal") + F.col("step") * 10)


@query(STEPS_SQL)
def merge_stream_out_of_order(spark, sf):
    """Several changes of a key in one micro-batch, and older ones in the next: the greatest step counts."""
    customer, inbox = table(spark, sf, "customer"), fresh(spark, "steps-inbox")
    old, new = customer.filter("c_custkey % 3 = 0"), customer.filter("c_custkey % 5 = 0").withColumn("c_custkey", F.col("c_custkey") + NEW_KEYS)
    for batch in (_steps(old, "array(3, 2)"), _steps(old, "if(c_custkey % 2 = 0, array(1, 4), array(1))"), _steps(new, "array(1, 2, 0)"),
                  _steps(new, "array(1)")):
        batch.coalesce(1).write.mode("append").parquet(inbox)
    t = ChangeTable.create(spark, fresh(spark, "steps"), customer)
    changes = spark.readStream.schema(batch.schema).option("maxFilesPerTrigger", 1).parquet(inbox)
    stream_merge(changes, t, "c_custkey", fresh(spark, "steps-checkpoint"), order="step").awaitTermination()
    return t.current()


@query(STEPS_SQL)
def merge_repeated_keys(spark, sf):
    """The same changes in one table merge."""
    customer = table(spark, sf, "customer")
    old, new = customer.filter("c_custkey % 3 = 0"), customer.filter("c_custkey % 5 = 0").withColumn("c_custkey", F.col("c_custkey") + NEW_KEYS)
    t = ChangeTable.create(spark, fresh(spark, "repeated-keys"), customer)
    t.merge(_steps(old, "if(c_custkey % 2 = 0, array(3, 2, 1, 4), array(3, 2, 1))").unionByName(_steps(new, "array(1, 2, 0)")), "c_custkey", order="step")
    return t.current()


@query(merge_sql(CUSTOMER, BATCH, "s.c_custkey % 2 = 0"))
def merge_source_only_condition(spark, sf):
    """The condition is on a column that only the source has."""
    customer = table(spark, sf, "customer")
    t = ChangeTable.create(spark, fresh(spark, "merge-condition"), customer)
    t.merge(customer_changes(customer).withColumn("apply", F.col("c_custkey") % 2 == 0), "c_custkey", "s.apply")
    return t.current()


@query("""SELECT l_orderkey, l_linenumber, l_partkey, l_suppkey, l_quantity, l_discount,
    CASE WHEN l_suppkey % 3 = 0 THEN 'S' ELSE l_returnflag END AS l_returnflag FROM lineitem""")
def merge_hot_keys(spark, sf):
    """A target without a unique key: each source row updates many target rows."""
    lineitem = table(spark, sf, "lineitem").select(
        "l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", "l_quantity", "l_discount", "l_returnflag")
    flags = table(spark, sf, "supplier").filter("s_suppkey % 3 = 0").select(
        F.col("s_suppkey").alias("l_suppkey"), F.lit("S").alias("flag"))
    rest = [c for c in lineitem.columns if c not in ("l_suppkey", "l_returnflag")]
    t = ChangeTable.create(spark, fresh(spark, "merge-hot"), lineitem)
    t.merge(flags.withColumnRenamed("flag", "l_returnflag"), "l_suppkey", evolve=True)
    return t.current().select("l_suppkey", "l_returnflag", *rest)


@query(ORDERS_V3, name="update_where")
def update_where_status(spark, sf):
    return update_where(table(spark, sf, "orders"), "o_orderstatus = 'F'", {"o_orderstatus": "X"})


@query("SELECT * FROM orders WHERE (o_totalprice < 50000) IS NOT TRUE", name="delete_where")
def delete_where_cheap(spark, sf):
    return delete_where(table(spark, sf, "orders"), "o_totalprice < 50000")


@query("SELECT * FROM customer WHERE NOT (c_acctbal < 0)")
def soft_delete_current(spark, sf):
    """Soft deletes arrive as changed rows; the active view leaves them out."""
    customer = table(spark, sf, "customer").withColumn("is_deleted", F.lit(False))
    gone = customer.filter("c_acctbal < 0").withColumn("is_deleted", F.lit(True))
    return active_rows(upsert(customer, gone, "c_custkey"), "is_deleted").drop("is_deleted")


@query("""SELECT event_id, ts, user_id, event_type, value FROM (
    SELECT *, ROW_NUMBER() OVER (PARTITION BY user_id ORDER BY ts DESC, event_id DESC) AS n FROM events)
    WHERE n = 1""", name="latest_per_key")
def latest_per_user(spark, sf):
    events = table(spark, sf, "events").select("event_id", "ts", "user_id", "event_type", "value")
    return latest_per_key(events, "user_id", ["ts", "event_id"])


@query("""SELECT l_orderkey, l_linenumber, l_quantity, l_discount FROM lineitem
    WHERE l_quantity > 0 AND l_discount <= 0.08""", name="check_constraints")
def check_constraints_split(spark, sf):
    rows = table(spark, sf, "lineitem").select("l_orderkey", "l_linenumber", "l_quantity", "l_discount")
    return check_constraints(rows, RULES)


RULES = {"positive_qty": "l_quantity > 0", "modest_discount": "l_discount <= 0.08"}


@query("""SELECT l_orderkey, l_linenumber, l_quantity, l_discount, 'modest_discount' AS violated
    FROM lineitem WHERE NOT (l_discount <= 0.08)""", name="constraint_violations")
def constraint_violations_named(spark, sf):
    rows = table(spark, sf, "lineitem").select("l_orderkey", "l_linenumber", "l_quantity", "l_discount")
    return constraint_violations(rows, RULES).withColumn("violated", F.array_join("violated", ","))


@query("""SELECT l_orderkey, l_linenumber, l_quantity, l_discount FROM lineitem
    WHERE l_quantity > 0 AND l_discount <= 0.08""")
def constrained_table(spark, sf):
    """The rules stored with the table; the rows that break none go in, the others are refused."""
    rows = table(spark, sf, "lineitem").select("l_orderkey", "l_linenumber", "l_quantity", "l_discount")
    t = ChangeTable.create(spark, fresh(spark, "constrained"), rows.schema,
                           not_null=["l_orderkey"], checks=RULES)
    t.append(check_constraints(rows, RULES))
    return t.current()


PLANTED = "l_quantity * l_tax + CASE WHEN l_orderkey % 17 = 0 THEN 1.0 ELSE 0.0 END"


@query(f"""SELECT l_orderkey, l_linenumber, l_quantity, l_tax FROM lineitem
    WHERE ABS({PLANTED} - l_quantity * l_tax) > 0.005""")
def check_amount_consistency(spark, sf):
    rows = table(spark, sf, "lineitem").withColumn("amount", F.expr(PLANTED))
    rule = {"amount": amount_consistent("l_quantity", "l_tax", "amount")}
    return constraint_violations(rows, rule).select("l_orderkey", "l_linenumber", "l_quantity", "l_tax")


@query("""SELECT l_orderkey, l_linenumber,
    CASE WHEN l_orderkey % 13 = 0 THEN 'many' ELSE CAST(l_quantity AS VARCHAR) END AS l_quantity
    FROM lineitem WHERE TRY_CAST(CASE WHEN l_orderkey % 13 = 0 THEN 'many'
        ELSE CAST(l_quantity AS VARCHAR) END AS DOUBLE) IS NULL""", name="enforce_schema")
def enforce_schema_report(spark, sf):
    rows = table(spark, sf, "lineitem").select("l_orderkey", "l_linenumber", F.when(
        F.col("l_orderkey") % 13 == 0, "many").otherwise(F.col("l_quantity").cast("string")).alias("l_quantity"))
    return uncastable_rows(rows, "l_quantity", "double")


@query("""SELECT l_orderkey, CAST(l_quantity AS INTEGER) AS l_quantity, l_tax, CAST(NULL AS VARCHAR) AS l_comment
    FROM lineitem""")
def enforce_schema_align(spark, sf):
    """Rows cast into a declared shape; a column they lack reads NULL."""
    from pyspark.sql import types as T
    shape = T.StructType.fromDDL("l_orderkey bigint, l_quantity int, l_tax double, l_comment string")
    return enforce_schema(table(spark, sf, "lineitem").select("l_tax", "l_quantity", "l_orderkey"), shape)


@query("""SELECT *, CAST(NULL AS DOUBLE) AS discount FROM orders WHERE o_orderkey % 2 = 0
    UNION ALL SELECT *, o_totalprice * 0.1 FROM orders WHERE o_orderkey % 2 <> 0""", name="append_evolve")
def append_evolve_discount(spark, sf):
    orders = table(spark, sf, "orders")
    return append_evolve(orders.filter("o_orderkey % 2 = 0"), orders.filter("o_orderkey % 2 <> 0")
                         .withColumn("discount", F.col("o_totalprice") * 0.1))


@query("""SELECT *, CAST(NULL AS VARCHAR) AS source_system FROM orders WHERE o_orderkey % 2 = 0
    UNION ALL SELECT *, 'landing' FROM orders WHERE o_orderkey % 2 <> 0""")
def append_evolve_table(spark, sf):
    orders = table(spark, sf, "orders")
    t = ChangeTable.create(spark, fresh(spark, "evolve"), orders.filter("o_orderkey % 2 = 0"))
    t.append(orders.filter("o_orderkey % 2 <> 0").withColumn("source_system", F.lit("landing")), evolve=True)
    return t.current()


@query("SELECT l_orderkey, l_linenumber, l_quantity * l_extendedprice AS amount FROM lineitem", name="derive_amount")
def derive_amount_of_lines(spark, sf):
    lines = table(spark, sf, "lineitem")
    return derive_amount(lines, "l_quantity", "l_extendedprice").select("l_orderkey", "l_linenumber", "amount")


@query("""SELECT CAST(event_id AS INTEGER) AS event_id, CAST(ts AS DATE) AS event_date, user_id, event_type,
    value, CAST(user_id AS INTEGER) * value AS amount FROM events""")
def ctas_bronze(spark, sf):
    events = table(spark, sf, "events")
    bronze = events.select(
        F.col("event_id").cast("int").alias("event_id"), F.to_date("ts").alias("event_date"), "user_id",
        "event_type", "value", (F.col("user_id").cast("int") * F.col("value")).alias("amount"))
    return ChangeTable.create(spark, fresh(spark, "bronze"), bronze).current()


@query("""SELECT o_orderkey, CAST(o_orderdate AS DATE) AS order_day, o_orderdate AS order_time,
    CASE WHEN o_orderkey % 9 <> 0 THEN CAST(o_orderdate AS DATE) END AS tolerant FROM orders""")
def parse_dates(spark, sf):
    """Text to dates and timestamps; in ``tolerant`` every ninth text is no date."""
    day = F.date_format("o_orderdate", "yyyy-MM-dd")
    text = table(spark, sf, "orders").select(
        "o_orderkey", day.alias("order_day"), F.date_format("o_orderdate", "yyyy-MM-dd HH:mm:ss").alias("order_time"),
        F.when(F.col("o_orderkey") % 9 == 0, F.lit("soon")).otherwise(day).alias("tolerant"))
    typed = parse_times(text, ["order_day"], ["order_time"])
    return parse_times(typed, ["tolerant"], strict=False).withColumn(
        "order_time", F.col("order_time").cast("timestamp_ntz"))


@query("SELECT event_id, DATE '2026-01-15' AS ingest_date, TRUE AS stamped FROM events")
def stamp_ingest(spark, sf):
    events = stamp(table(spark, sf, "events").select("event_id"), NOON)
    return events.select("event_id", "ingest_date", F.col("ingested_at").isNotNull().alias("stamped"))


@query("""SELECT c_custkey, c_name, c_acctbal, FALSE AS is_deleted FROM customer""")
def soft_delete_undone(spark, sf):
    """The flag is set for some customers and taken back, as two merges of changed rows."""
    customer = table(spark, sf, "customer").select("c_custkey", "c_name", "c_acctbal", F.lit(False).alias("is_deleted"))
    t = ChangeTable.create(spark, fresh(spark, "soft-delete"), customer)
    some = customer.filter("c_acctbal < 0")
    t.merge(some.withColumn("is_deleted", F.lit(True)), "c_custkey")
    t.merge(some, "c_custkey")
    return t.current()


@query("SELECT c_custkey FROM customer EXCEPT SELECT o_custkey FROM orders")
def missing_keys(spark, sf):
    """Keys of a full list that the other side does not have: customers without any order."""
    return set_minus(table(spark, sf, "customer").select("c_custkey"),
                     table(spark, sf, "orders").select(F.col("o_custkey").alias("c_custkey")))


@query("""SELECT o_orderkey, o_custkey, o_totalprice, TRUE AS read_little FROM orders
    WHERE o_orderkey BETWEEN 1000 AND 1030 OR o_orderkey = (SELECT MAX(o_orderkey) FROM orders)""")
def hard_deletes_found(spark, sf):
    """The source lost rows without a trace; checksums of key ranges find which, and few rows are read for it."""
    landed = table(spark, sf, "orders")
    last = landed.agg(F.max("o_orderkey")).first()[0]
    source = landed.filter(~F.col("o_orderkey").between(1000, 1030) & (F.col("o_orderkey") != last))
    found = key_difference(landed, source, "o_orderkey", ["o_custkey", "o_totalprice"], narrow=64)
    keys = sum(hi - lo + 1 for lo, hi in found.ranges)
    return found.only_left.withColumn("read_little", F.lit(keys <= 256)).unionByName(found.only_right.withColumn("read_little", F.lit(False)))


@query("SELECT count(*) AS c FROM lineitem")
def table_count(spark, sf):
    return table(spark, sf, "lineitem").agg(F.count("*").alias("c"))


@query("SELECT o_orderkey, o_totalprice FROM orders ORDER BY o_totalprice DESC, o_orderkey LIMIT 5")
def topk_orders(spark, sf):
    return (table(spark, sf, "orders").select("o_orderkey", "o_totalprice")
            .orderBy(F.desc("o_totalprice"), "o_orderkey").limit(5))
