from datetime import date, datetime

import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemark.errors import ConstraintViolation, MergeCardinalityError, SchemaMismatch
from tidemark.functions import (add_missing, derive_amount, evolved, fill_default, fits, parse_times,
                                stamp_ingest)
from tidemark.operators import (active_rows, amount_consistent, append_evolve, bag_minus, check_constraints,
                                constraint_violations, delete_where, enforce_schema, latest_per_key,
                                merge_newer_wins, merge_upsert, set_minus, uncastable_rows, update_where)
from tidemark.operators import diff

CUSTOMER = ("customer_id string, first_name string, last_name string, email string, city string, "
            "is_active boolean, last_modified_ts timestamp")


def ts(text):
    return datetime.fromisoformat(text)


@pytest.fixture
def customers(spark):
    return spark.createDataFrame([
        ("C-01", "Lena", "Frost", "lena@example.com", "Oslo", True, ts("2026-01-01 10:00:00")),
        ("C-02", "Omar", "Vale", "omar@example.com", "Lima", True, ts("2026-01-01 11:00:00")),
        ("C-03", "Nora", "Stone", "nora@example.com", "Bern", True, ts("2026-01-01 12:00:00"))], CUSTOMER)


@pytest.fixture
def batch(spark):
    return spark.createDataFrame([
        ("C-02", "Omar", "Vale", "omar_new@example.com", "Lima", True, ts("2026-01-02 09:00:00")),
        ("C-03", "Nora", "Stone", "nora@example.com", "Cairo", True, ts("2026-01-02 09:05:00")),
        ("C-04", "Kim", "Jones", "kim@example.com", "Oslo", True, ts("2026-01-02 09:10:00")),
        ("C-01", "Lena", "Frost", "lena@example.com", "Oslo", False, ts("2026-01-02 09:20:00"))], CUSTOMER)


def test_newer_wins(customers, batch, rows):
    out = merge_newer_wins(customers, batch, "customer_id", "last_modified_ts")
    assert rows(out, "customer_id", "email", "city", "is_active") == [
        ("C-01", "lena@example.com", "Oslo", False), ("C-02", "omar_new@example.com", "Lima", True),
        ("C-03", "nora@example.com", "Cairo", True), ("C-04", "kim@example.com", "Oslo", True)]
    assert active_rows(out.withColumn("gone", ~F.col("is_active")), "gone").count() == 3


def test_older_and_equal_changes_lose(customers, batch, rows):
    merged = merge_newer_wins(customers, batch, "customer_id", "last_modified_ts")
    again = merge_newer_wins(merged, customers, "customer_id", "last_modified_ts")
    assert rows(again) == rows(merged)
    assert rows(merge_newer_wins(merged, batch.withColumn("city", F.lit("X")), "customer_id",
                                 "last_modified_ts")) == rows(merged)


def test_second_batch(spark, customers, batch, rows):
    one = merge_newer_wins(customers, batch, "customer_id", "last_modified_ts")
    second = spark.createDataFrame([
        ("C-04", "Kim", "Jones", "kim@example.com", "Quito", True, ts("2026-01-03 00:00:00")),
        ("C-06", "Ida", "Roth", "ida@example.com", "Bern", True, ts("2026-01-03 00:00:00"))], CUSTOMER)
    two = merge_newer_wins(one, second, "customer_id", "last_modified_ts")
    assert two.count() == 5
    assert rows(two.filter("customer_id >= 'C-04'"), "customer_id", "city") == [("C-04", "Quito"), ("C-06", "Bern")]


@pytest.mark.parametrize("limit", [0, 1_000_000])
def test_merge_rules(spark, rows, monkeypatch, limit):
    monkeypatch.setattr("tidemark.operators.sizes.BROADCAST_ROWS", limit)
    shape = "k int, j string, v int"
    target = spark.createDataFrame([(1, "a", 1), (1, "a", 2), (2, None, 3), (None, "a", 4)], shape)
    source = spark.createDataFrame([(1, "a", 9), (2, None, 9), (None, "a", 9), (5, "b", 9), (5, "b", 9)], shape)
    assert rows(merge_upsert(target, source, ["k", "j"])) == sorted(
        [(1, "a", 9), (1, "a", 9), (2, None, 3), (None, "a", 4),
         (2, None, 9), (None, "a", 9), (5, "b", 9), (5, "b", 9)], key=repr)
    with pytest.raises(MergeCardinalityError):
        merge_upsert(target, spark.createDataFrame([(1, "a", 5), (1, "a", 6)], shape), ["k", "j"])


def test_merge_condition_that_is_null_keeps_the_row(spark, rows):
    target = spark.createDataFrame([(1, None)], "k int, v int")
    source = spark.createDataFrame([(1, 5)], "k int, v int")
    assert rows(merge_newer_wins(target, source, "k", "v")) == [(1, None)]


def test_small_source_does_not_shuffle_the_target(spark):
    target = spark.range(100_000).selectExpr("id * 7 % 100003 k", "id v")
    source = spark.range(10).selectExpr("id k", "-id v")
    plan = merge_upsert(target, source, "k")._jdf.queryExecution().executedPlan().toString()
    assert "BroadcastHashJoin" in plan and "SortMergeJoin" not in plan
    # the one shuffle is that of the few matched keys
    assert plan.count("Exchange hashpartitioning") == 1


def test_update_and_delete(spark, rows):
    df = spark.createDataFrame([(1, "A"), (2, None), (3, "C")], "id int, s string")
    assert rows(update_where(df, "s = 'A'", {"s": "Z", "id": F.col("id") + 10})) == [(11, "Z"), (2, None), (3, "C")]
    assert rows(delete_where(df, F.col("s") != "C")) == [(2, None), (3, "C")]
    assert rows(delete_where(df, "id BETWEEN 2 AND 3")) == [(1, "A")]
    assert update_where(df, "true", {"id": 5}).schema["id"].dataType == T.IntegerType()
    with pytest.raises(ValueError):
        update_where(df, "true", {"nope": 1})


def test_differences(spark, rows):
    a = spark.createDataFrame([(1, None), (1, None), (2, "b"), (2, "b"), (2, "b"), (3, "c")], "i int, s string")
    b = spark.createDataFrame([(1, None), (2, "b"), (4, "d")], "i int, s string")
    assert rows(set_minus(a, b)) == [(3, "c")]
    assert rows(set_minus(b, a)) == [(4, "d")]
    assert rows(bag_minus(a, b)) == rows(a.exceptAll(b))
    assert rows(set_minus(a, b)) == rows(a.subtract(b))
    assert rows(bag_minus(a, a)) == []


def test_hot_row_is_repeated_in_slices(spark, monkeypatch):
    monkeypatch.setattr(diff, "COPIES_PER_SLICE", 10)
    a = spark.range(1).selectExpr("7 AS x", "explode(sequence(1, 95)) AS n").drop("n")
    out = bag_minus(a, spark.createDataFrame([(7,)], "x int"))
    assert out.count() == 94 and out.distinct().count() == 1
    assert out.select(F.spark_partition_id()).distinct().count() > 1


def test_latest_per_key(spark, rows):
    df = spark.createDataFrame([("a", 1, 1), ("a", 3, 1), ("a", 3, 2), ("b", None, 1), (None, 1, 1)],
                               "k string, t int, n int")
    out = latest_per_key(df, "k", ["t", "n"])
    assert rows(out) == sorted([("a", 3, 2), ("b", None, 1), (None, 1, 1)], key=repr)
    plan = out._jdf.queryExecution().executedPlan().toString()
    assert "WindowGroupLimit" in plan


def test_constraints(spark, rows):
    df = spark.createDataFrame([("O-1", 1, 10.0), ("O-2", -1, 10.0), (None, 2, 0.0), ("O-4", None, 5.0)],
                               "order_id string, quantity int, price double")
    rules = {"positive_qty": "quantity > 0", "positive_price": "price > 0"}
    assert rows(check_constraints(df, rules, ["order_id"])) == [("O-1", 1, 10.0)]
    bad = constraint_violations(df, rules, ["order_id"])
    assert rows(bad, "order_id", "violated") == sorted(
        [("O-2", ["positive_qty"]), (None, ["order_id NOT NULL", "positive_price"]),
         ("O-4", ["positive_qty"])], key=repr)
    assert check_constraints(df, rules, null_passes=True).count() == 2
    with pytest.raises(ConstraintViolation):
        check_constraints(df, rules, on_violation="raise")
    amounts = spark.createDataFrame([(3, 0.1, 0.3), (3, 0.1, 0.31)], "quantity int, price double, amount double")
    assert rows(check_constraints(amounts, {"a": amount_consistent()}), "amount") == [(0.3,)]


def test_store_assignment_rules():
    assert fits(T.LongType(), T.IntegerType()) and fits(T.IntegerType(), T.DoubleType())
    assert fits(T.DateType(), T.TimestampType()) and fits(T.IntegerType(), T.StringType())
    assert not fits(T.StringType(), T.IntegerType()) and not fits(T.IntegerType(), T.BooleanType())
    assert not fits(T.ArrayType(T.StringType()), T.ArrayType(T.LongType()))
    assert fits(T.StructType().add("a", T.LongType()), T.StructType().add("a", T.IntegerType()))


def test_enforce_and_evolve(spark, rows):
    shape = T.StructType.fromDDL("a int, b string")
    df = spark.createDataFrame([("x", 1)], "b string, a bigint")
    assert rows(enforce_schema(df, shape)) == [(1, "x")]
    for wrong in (df.withColumn("a", F.lit("q")), df.withColumn("c", F.lit(1))):
        with pytest.raises(SchemaMismatch):
            enforce_schema(wrong, shape)
    assert evolved(shape, T.StructType.fromDDL("c int, a int")).names == ["a", "b", "c"]
    assert rows(append_evolve(enforce_schema(df, shape), df.withColumn("c", F.lit(2)))) == sorted(
        [(1, "x", None), (1, "x", 2)], key=repr)
    texts = spark.createDataFrame([("1",), ("one",), (None,)], "q string")
    assert rows(uncastable_rows(texts, "q", "int")) == [("one",)]


def test_column_helpers(spark, rows):
    df = spark.createDataFrame([(2, 499.0, None), (1, 10.0, "web")], "quantity bigint, price double, source string")
    assert rows(derive_amount(df), "amount") == [(10.0,), (998.0,)]
    assert rows(fill_default(df, "source", "unknown"), "source") == [("unknown",), ("web",)]
    assert rows(fill_default(df.drop("source"), "source", "unknown"), "source") == [("unknown",), ("unknown",)]
    assert add_missing(df, {"x": "int", "price": "int"}).schema["x"].dataType == T.IntegerType()
    stamped = stamp_ingest(df, datetime(2026, 1, 2, 3))
    assert rows(stamped, "ingest_date") == [(date(2026, 1, 2),), (date(2026, 1, 2),)]


def test_parse_times(spark, rows):
    df = spark.createDataFrame([("2026-01-01", "2026-01-01 10:00:00"), ("soon", "never")], "d string, t string")
    assert rows(parse_times(df, ["d"], ["t"], strict=False)) == sorted(
        [(date(2026, 1, 1), datetime(2026, 1, 1, 10)), (None, None)], key=repr)
    with pytest.raises(Exception, match="CAST_INVALID_INPUT"):
        parse_times(df, ["d"]).collect()


def test_union_source_scans_the_target_twice(spark, path):
    p = path()
    spark.range(1000).selectExpr("id k", "id v").write.parquet(p)
    target = spark.read.parquet(p)
    one, two = spark.range(5).selectExpr("id k", "id v"), spark.range(2000, 2005).selectExpr("id k", "id v")
    plan = merge_upsert(target, one.unionByName(two), "k")._jdf.queryExecution().executedPlan().toString()
    assert plan.count("FileScan parquet") == 2
