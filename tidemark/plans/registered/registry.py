"""Where the registered queries are kept, and the inputs they share."""

from __future__ import annotations

from collections.abc import Callable
from datetime import datetime, timedelta, timezone

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ...session import scratch_dir
from ..change_table import ChangeTable

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}


def query(sql: str, name: str | None = None):
    """Register a function, under its own name by default; ``sql`` is the same result in plain SQL."""
    def keep(fn):
        QUERIES[name or fn.__name__] = fn
        ORACLES[name or fn.__name__] = sql
        return fn
    return keep


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def fresh(spark: SparkSession, label: str) -> str:
    """A path in the scratch folder that does not exist yet."""
    return f"{scratch_dir(spark, label)}/t"


# ---------------------------------------------------------------------- orders in versions

T0 = datetime(2024, 1, 1)
NOON = datetime(2026, 1, 15, 12, tzinfo=timezone.utc)    # the same day in most time zones


def hour(n: int) -> datetime:
    """Commit time of version ``n`` of the shared orders table."""
    return T0 + timedelta(hours=n)


_shared: dict[tuple[str, str], str] = {}


def orders_versions(spark: SparkSession, sf_dir: str) -> ChangeTable:
    """Orders in five versions. Built once per application and only read afterwards.

    0 created empty, 1 even keys, 2 odd keys too, 3 status F becomes X, 4 cheap ones deleted.
    """
    key = (spark.sparkContext.applicationId, sf_dir)
    if key not in _shared:
        orders = table(spark, sf_dir, "orders")
        path = fresh(spark, "orders-versions")
        t = ChangeTable.create(spark, path, orders.schema, at=hour(0))
        t.append(orders.filter("o_orderkey % 2 = 0"), at=hour(1))
        t.append(orders.filter("o_orderkey % 2 <> 0"), at=hour(2))
        t.update("o_orderstatus = 'F'", {"o_orderstatus": "X"}, at=hour(3))
        t.delete("o_totalprice < 50000", at=hour(4))
        _shared[key] = path
    return ChangeTable(spark, _shared[key])


def orders_clone(spark: SparkSession, sf_dir: str, version: int | None = None) -> ChangeTable:
    """A cheap private copy of the shared table, for queries that change it."""
    return orders_versions(spark, sf_dir).clone_shallow(fresh(spark, "orders-clone"), version)


ORDERS_V3 = """SELECT o_orderkey, o_custkey,
    CASE WHEN o_orderstatus = 'F' THEN 'X' ELSE o_orderstatus END AS o_orderstatus,
    o_totalprice, o_orderdate, o_orderpriority FROM orders"""
ORDERS_V4 = ORDERS_V3 + " WHERE NOT (o_totalprice < 50000)"


# ---------------------------------------------------------------------- customer changes

NEW_KEYS = 1_000_000


def customer_changes(customer: DataFrame, every: int = 7, new_every: int = 11,
                     new_from: int = NEW_KEYS) -> DataFrame:
    """Changed balances for every 7th customer (up for even ones, else down) and some new customers."""
    step = F.when(F.col("c_custkey") % (2 * every) == 0, F.lit(100.0)).otherwise(F.lit(-100.0))
    changed = customer.filter(F.col("c_custkey") % every == 0).withColumn(
        "c_acctbal", F.col("c_acctbal") + step)
    new = customer.filter(F.col("c_custkey") % new_every == 0).withColumn(
        "c_custkey", F.col("c_custkey") + new_from)
    return changed.unionByName(new)


def customer_changes_sql(every: int = 7, new_every: int = 11, new_from: int = NEW_KEYS) -> str:
    return f"""SELECT c_custkey, c_name, c_nationkey,
        c_acctbal + CASE WHEN c_custkey % {2 * every} = 0 THEN 100.0 ELSE -100.0 END AS c_acctbal,
        c_mktsegment FROM customer WHERE c_custkey % {every} = 0
      UNION ALL SELECT c_custkey + {new_from}, c_name, c_nationkey, c_acctbal, c_mktsegment
        FROM customer WHERE c_custkey % {new_every} = 0"""


def merge_sql(target: str, source: str, condition: str = "TRUE") -> str:
    """MERGE of customer rows as a full join."""
    take = f"t.c_custkey IS NULL OR (s.c_custkey IS NOT NULL AND ({condition}))"
    picked = ", ".join(f"CASE WHEN {take} THEN s.{c} ELSE t.{c} END AS {c}" for c in (
        "c_custkey", "c_name", "c_nationkey", "c_acctbal", "c_mktsegment"))
    return f"SELECT {picked} FROM ({target}) t FULL JOIN ({source}) s ON t.c_custkey = s.c_custkey"
