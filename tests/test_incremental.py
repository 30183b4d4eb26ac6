import re
from datetime import datetime, timezone

import pytest
from pyspark.sql import functions as F

from tidemark.operators import latest_per_key
from tidemark.plans import (FrameSource, JdbcSource, TableBookmarks, bookmark_advance, extract_since, read_bookmark,
                            run_incremental)
from tidemark.plans.incremental import BOOKMARK_SCHEMA
from tidemark.sinks import land_increment
from tidemark.sources.jdbc import Split, as_table, high_water_sql, window_predicate

SOURCE = "client string, place string, closed boolean, changed timestamp"
NOW = datetime(2026, 2, 1, 12, tzinfo=timezone.utc)


def at(minute):
    return datetime(2026, 1, 1, 10, minute)


@pytest.fixture
def source(spark):
    def build(*changes):
        base = {"k-1x": ("Oslo", False, at(0)), "k-2x": ("Lima", False, at(1)), "k-3x": ("Turin", False, at(2))}
        for key, *values in changes:
            base[key] = tuple(values)
        return FrameSource(spark.createDataFrame([(k, *v) for k, v in base.items()], SOURCE), "changed")
    return build


@pytest.fixture
def marks(spark, path):
    return TableBookmarks(spark, path("marks"))


def test_runs_follow_the_bookmark(spark, source, marks, path, rows):
    landing = path("landing")
    run = lambda s: run_incremental("customers", s, marks, landing, now=NOW)
    first = run(source())
    assert (first.lo, first.hi, first.landed) == (None, "2026-01-01 10:02:00+00:00", 3)
    idle = run(source())
    assert idle.landed == 0 and not idle.advanced
    assert marks.get("customers") == "2026-01-01 10:02:00+00:00"
    assert run(source(("k-1x", "Oslo - Harbour", False, at(5)))).landed == 1
    gone = run(source(("k-1x", "Oslo - Harbour", False, at(5)), ("k-2x", "Lima", True, at(6))))
    assert (gone.landed, gone.hi) == (1, "2026-01-01 10:06:00+00:00")
    landed = spark.read.parquet(landing)
    assert landed.count() == 5
    latest = latest_per_key(landed, "client", ["changed", "ingested_at"])
    assert rows(latest, "client", "place", "closed") == [
        ("k-1x", "Oslo - Harbour", False), ("k-2x", "Lima", True), ("k-3x", "Turin", False)]
    assert latest.schema["ingest_date"].dataType.simpleString() == "date"


def test_other_bookmarks_stay(spark, source, marks, path, rows):
    marks.advance("orders", "2020-01-01 00:00:00", NOW)
    marks.advance("parts", "2021-01-01 00:00:00", NOW)
    run_incremental("customers", source(), marks, path("landing"), now=NOW)
    assert rows(marks.table.current(), "table_name", "last_value") == [
        ("customers", "2026-01-01 10:02:00+00:00"), ("orders", "2020-01-01 00:00:00"), ("parts", "2021-01-01 00:00:00")]


def test_untimed_rows_are_reported(spark, marks, path):
    df = spark.createDataFrame([("k-1x", "Oslo", False, None), ("k-2x", "Quito", False, None)], SOURCE)
    out = run_incremental("customers", FrameSource(df, "changed"), marks, path("landing"), now=NOW)
    assert (out.landed, out.untimed, out.hi, out.advanced) == (2, 2, None, False)
    assert marks.get("customers") is None
    marks.advance("customers", "2026-01-01 00:00:00", NOW)
    out = run_incremental("customers", FrameSource(df, "changed"), marks, path("landing"), now=NOW)
    assert (out.landed, out.untimed) == (0, 2)
    assert marks.get("customers") == "2026-01-01 00:00:00"


def test_first_load_takes_untimed_rows_too(spark, marks, path):
    df = spark.createDataFrame([("k-1x", "Oslo", False, None), ("k-2x", "Quito", False, at(1))], SOURCE)
    out = run_incremental("customers", FrameSource(df, "changed"), marks, path("landing"), now=NOW)
    assert (out.landed, out.hi) == (2, "2026-01-01 10:01:00+00:00")


def test_default_bookmark_and_overlap(spark, source, marks, path):
    landing = path("landing")
    out = run_incremental("customers", source(), marks, landing, default="1970-01-01 00:00:00", now=NOW)
    assert out.landed == 3
    # a row of the bookmark's own second that was committed late
    late = source(("k-9x", "Late", False, at(2)))
    assert run_incremental("customers", late, marks, landing, now=NOW).landed == 0
    again = run_incremental("customers", late, marks, landing, overlap="2026-01-01 10:01:30", now=NOW)
    assert again.landed == 2 and again.hi == "2026-01-01 10:02:00+00:00"


def test_extract_since_bounds(spark, source, rows):
    df = source().df
    assert rows(extract_since(df, "changed", "2026-01-01 10:00:00", "2026-01-01 10:02:00"), "client") == [
        ("k-2x",), ("k-3x",)]
    assert extract_since(df, "changed", None).count() == 3


def test_extract_filter_reaches_the_scan(spark, source, path):
    p = path("parquet")
    source().df.write.parquet(p)
    plan = extract_since(spark.read.parquet(p), "changed", "2026-01-01 10:00:30")._jdf.queryExecution().toString()
    assert "GreaterThan(changed" in plan


def test_read_bookmark(spark):
    marks = spark.createDataFrame([("customers", "2026-02-11 08:47:30", None), ("empty", None, None)], BOOKMARK_SCHEMA)
    assert read_bookmark(marks, "customers") == "2026-02-11 08:47:30"
    assert read_bookmark(marks, "absent") is None
    assert read_bookmark(marks, "empty", "1970-01-01 00:00:00") == "1970-01-01 00:00:00"
    typed = spark.createDataFrame([("customers", datetime(1970, 1, 1))], "table_name string, changed timestamp_ntz")
    assert read_bookmark(typed, "customers", value="changed") == "1970-01-01 00:00:00"


def test_bookmark_advance(spark, rows):
    marks = spark.createDataFrame([("a", "1", None), ("b", "2", None)], BOOKMARK_SCHEMA)
    new = lambda v: spark.createDataFrame([(v, NOW)], "last_value string, updated_at timestamp")
    assert rows(bookmark_advance(marks, "b", new("9")), "table_name", "last_value") == [("a", "1"), ("b", "9")]
    assert rows(bookmark_advance(marks, "c", new("9")), "table_name", "last_value") == [("a", "1"), ("b", "2"), ("c", "9")]
    assert rows(bookmark_advance(marks, "b", new(None)), "table_name", "last_value") == [("a", "1"), ("b", "2")]


def test_landing_formats(spark, source, path):
    df, csv = source().df, path("csv")
    assert land_increment(df, csv, fmt="csv", at=NOW) == 3
    assert land_increment(df.limit(0), csv, fmt="csv", at=NOW) == 0
    back = spark.read.option("header", True).csv(csv)
    assert back.count() == 3 and "ingest_date" in back.columns
    with pytest.raises(ValueError):
        land_increment(df, csv, fmt="orc")
    empty = path("empty")
    assert land_increment(df.filter(F.lit(False)), empty) == 0
    with pytest.raises(Exception, match="PATH_NOT_FOUND"):
        spark.read.parquet(empty)


def test_jdbc_texts():
    assert as_table("SELECT * FROM t;") == "(SELECT * FROM t) q"
    assert window_predicate("c", "2026-01-01", "2026-01-02") == "c > '2026-01-01' AND c <= '2026-01-02'"
    assert window_predicate("c", None, None) == "1 = 1"
    assert window_predicate("c", "o'clock", None) == "c > 'o''clock'"
    assert high_water_sql("t", "c", None) == "SELECT MAX(c) AS hi, COUNT(c) AS n, COUNT(*) - COUNT(c) AS n_null FROM t"
    assert high_water_sql("t", "c", "5").endswith("FROM t WHERE c > '5' OR c IS NULL")
    assert Split("id", "1", "9", 4).options() == {
        "partitionColumn": "id", "lowerBound": "1", "upperBound": "9", "numPartitions": "4"}


def test_jdbc_rows_text(spark):
    src = JdbcSource(spark, {}, "orders", "changed")
    assert src.rows_sql("a", "b") == "SELECT * FROM orders WHERE changed > 'a' AND changed <= 'b'"
    assert src.rows_sql(None, "b") == "SELECT * FROM orders WHERE changed IS NULL OR changed <= 'b'"
    assert src.rows_sql(None, None) == "SELECT * FROM orders WHERE 1 = 1"


def test_high_water_sql_counts(spark):
    """The text given to databases, checked on a view."""
    spark.createDataFrame([(1,), (5,), (7,), (None,)], "c int").createOrReplaceTempView("hw")
    assert tuple(spark.sql(high_water_sql("hw", "c", None)).first()) == (7, 3, 1)
    assert tuple(spark.sql(high_water_sql("hw", "c", "4")).first()) == (7, 2, 1)
    assert tuple(spark.sql(high_water_sql("hw", "c", "7")).first()) == (None, 0, 1)


def test_a_bookmark_is_read_in_any_session_zone(spark, marks, path):
    rows = lambda n: spark.range(n).selectExpr("id", "timestamp_seconds(1770000000 + id * 60) changed")
    zone = spark.conf.get("spark.sql.session.timeZone")
    try:
        landed = []
        for n, where in ((5, "UTC"), (12, "America/New_York"), (20, "Asia/Tokyo")):
            spark.conf.set("spark.sql.session.timeZone", where)
            landed.append(run_incremental("r", FrameSource(rows(n), "changed"), marks, path("landing"), now=NOW).landed)
        assert landed == [5, 7, 8]
    finally:
        spark.conf.set("spark.sql.session.timeZone", zone)


def test_overlap_is_compared_by_value_and_the_bookmark_never_moves_back(spark, marks, path):
    rows = lambda n: FrameSource(spark.range(n).selectExpr("id", "id changed"), "changed")
    landing = path("landing")
    assert run_incremental("n", rows(13), marks, landing, now=NOW).hi == "12"
    again = run_incremental("n", rows(12), marks, landing, overlap="9", now=NOW)
    assert (again.landed, again.hi, marks.get("n")) == (2, "12", "12")


def test_sources_advance_side_by_side(spark, marks):
    other = TableBookmarks(spark, marks.table.path)
    marks.advance("one", "1", NOW)
    other.advance("two", "2", NOW)
    marks.advance("one", "3", NOW)
    assert (other.get("one"), marks.get("two")) == ("3", "2")


@pytest.mark.parametrize("fmt", ["parquet", "csv"])
def test_a_batch_landed_again_takes_its_own_place(spark, path, rows, fmt):
    from tidemark.sinks import land_batch
    shape, landing = "k int, v string", path("landing")
    monday, tuesday = (datetime(2026, 1, d, 12, tzinfo=timezone.utc) for d in (12, 13))

    def land(items, batch, at):
        return land_batch(spark.createDataFrame(items, shape), landing, batch, fmt=fmt, at=at)

    def found():
        kind = shape + ", ingested_at string, ingest_date date, batch string"
        reader = spark.read.schema(kind)
        got = reader.parquet(landing) if fmt == "parquet" else reader.option("header", True).csv(landing)
        return rows(got.selectExpr("k", "v", "cast(ingest_date as string)"))

    assert land([(1, "a"), (2, "b")], "src:/2024-01-01 00:00", monday) == 2
    assert land([(3, "c")], "src:/2024-01-01 00:01", monday) == 1
    assert land([(1, "a"), (2, "B"), (4, "d")], "src:/2024-01-01 00:00", tuesday) == 3
    assert land([], "src:/2024-01-01 00:00", tuesday) == 0
    assert found() == [(1, "a", "2026-01-12"), (2, "B", "2026-01-12"), (3, "c", "2026-01-12"), (4, "d", "2026-01-12")]


def test_batch_folders_differ():
    from tidemark.sinks.files import batch_folder
    names = [batch_folder(b) for b in ("a:b", "a-b", "a/b", "", "x" * 300, "x" * 301, "é")]
    assert len(set(names)) == len(names) and all(re.fullmatch("[A-Za-z0-9-]+", n) for n in names)
