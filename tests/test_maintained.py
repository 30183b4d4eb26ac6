"""Counts kept from changes, key differences by checksums, key ranges of merges."""

import random

import pytest
from pyspark.sql import functions as F

from tidemark import ChangeTable
from tidemark.operators import key_difference, merge_upsert, sizes
from tidemark.operators.merge import checked_source
from tidemark.plans.maintained import MaintainedCounts

SHAPE = "k int, g string, v bigint"


def recount(t, rows):
    return rows(t.current().groupBy("g").agg(F.count("*").alias("cnt"), F.sum("v").cast("decimal(38,0)").alias("sum_v")))


def test_counts_follow_every_statement(spark, path, rows):
    t = ChangeTable.create(spark, path(), spark.createDataFrame([(i, "abc"[i % 3], i) for i in range(60)] + [(99, None, None)], SHAPE))
    counts = MaintainedCounts(t, path("counts"), ["g"], ["v"])
    assert rows(counts.refresh()) == recount(t, rows)
    steps = [lambda: t.append(spark.createDataFrame([(200, "d", 5), (201, None, 7), (0, "a", 0)], SHAPE)),
             lambda: t.update("k % 4 = 0", {"g": "e"}), lambda: t.delete("g = 'c'"),
             lambda: t.merge(spark.createDataFrame([(1, "z", 1), (500, "z", 2)], SHAPE), "k"), lambda: t.restore(1), lambda: t.optimize(full=True),
             lambda: t.overwrite(spark.createDataFrame([(1, "q", 1)], SHAPE)), lambda: t.delete("true")]
    for i, step in enumerate(steps):
        step()
        if i != 1:          # once two statements are taken together
            assert rows(counts.refresh()) == recount(t, rows)
    assert counts.versions()[-1] == t.version and counts.refresh().count() == 0


def test_counts_read_the_changes_only(spark, path):
    t = ChangeTable.create(spark, path(), spark.createDataFrame([(i, "a", i) for i in range(100)], SHAPE))
    first = set(t.current().inputFiles())
    t.append(spark.createDataFrame([(1000, "b", 1)], SHAPE))
    came, went = t.changed_rows(0, 1)
    assert not first & set(came.inputFiles()) and went.isEmpty() and came.count() == 1
    with pytest.raises(TypeError, match="exactly"):
        MaintainedCounts(ChangeTable.create(spark, path(), "k int, x double"), path(), ["k"], ["x"])


@pytest.mark.parametrize("fanout, narrow", [(64, 1024), (4, 8), (2, 1)])
def test_key_difference_is_that_of_sets(spark, rows, fanout, narrow):
    rng = random.Random(fanout)
    left = [(rng.randint(-5000, 5000) if rng.random() < .98 else None, rng.choice("ab")) for _ in range(800)]
    right = [r for r in left if r[0] is None or not 100 <= r[0] <= 160] + [(7001, "x"), (7001, "x"), (-9000, "y")]
    right[5] = (right[5][0], "changed")
    one, other = (spark.createDataFrame(x, "k bigint, v string") for x in (left, right))
    found = key_difference(one, other, "k", ["v"], fanout, narrow)
    assert rows(found.only_left) == sorted(set(left) - set(right), key=repr)
    assert rows(found.only_right) == sorted(set(right) - set(left), key=repr)
    same = key_difference(one, one, "k", ["v"], fanout, narrow)
    assert same.only_left.isEmpty() and same.only_right.isEmpty()


def test_key_difference_reads_narrow_ranges(spark):
    one = spark.range(1_000_000)
    found = key_difference(one, one.filter("id not in (77, 500000)"), "id")
    assert sum(hi - lo + 1 for lo, hi in found.ranges) <= 2048 and {r[0] for r in found.only_left.collect()} == {77, 500_000}
    empty = key_difference(one.limit(0), spark.range(3), "id")
    assert empty.only_right.count() == 3 and key_difference(one.limit(0), one.limit(0), "id").ranges == []


def test_merge_reads_the_key_ranges_of_its_source(spark, path, rows):
    folder = path()
    spark.range(100_000).selectExpr("id as k", "'old' as v").write.parquet(folder)
    target = spark.read.parquet(folder)
    source = spark.createDataFrame([(5, "new"), (7, "new"), (1_000_001, "new"), (None, "null")], "k long, v string")
    src = checked_source(target, source, "k")
    assert src.ranges["k"][0][0] == 5 and src.ranges["k"][-2][1] == 7 and src.ranges["k"][-1] == (1_000_001, 1_000_001)
    plan = src.may_match(target)._jdf.queryExecution().toString()
    assert "GreaterThanOrEqual(k,5)" in plan.partition("PushedFilters: ")[2]
    out = merge_upsert(target, source, "k")
    assert out.count() == 100_002 and rows(out.filter("v <> 'old'")) == sorted([(5, "new"), (7, "new"), (1_000_001, "new"), (None, "null")], key=repr)


@pytest.mark.parametrize("kind, values", [("date", ["DATE'2024-01-01'", "DATE'2024-01-05'"]), ("timestamp", ["TIMESTAMP'2024-03-31 02:30:00'", "TIMESTAMP'2024-10-27 02:30:00'"]),
                                          ("string", ["'b'", "'é'"]), ("double", ["1.5d", "double('nan')"]), ("decimal(9,2)", ["1.50", "-3.25"])])
def test_ranges_of_any_key_type_lose_no_match(spark, rows, kind, values):
    target = spark.sql(" UNION ALL ".join(f"SELECT CAST({v} AS {kind}) AS k, 0 AS v" for v in values) + f" UNION ALL SELECT CAST(NULL AS {kind}), 0")
    source = spark.sql(" UNION ALL ".join(f"SELECT CAST({v} AS {kind}) AS k, {i + 1} AS v" for i, v in enumerate(values)))
    assert sorted(r["v"] for r in merge_upsert(target, source, "k").collect()) == [0, 1, 2]


@pytest.mark.parametrize("condition", [None, "s.v > t.v", "s.extra = 1"])
def test_a_large_source_reads_the_table_once_and_gives_the_same(spark, path, rows, monkeypatch, condition):
    rng = random.Random(3)
    target = spark.createDataFrame([(rng.randint(0, 40), "t", rng.randint(0, 9)) for _ in range(120)] + [(None, "t", 1)], SHAPE)
    source = spark.createDataFrame([(k, "s", rng.randint(0, 9), k % 2) for k in range(20, 60)] + [(None, "s", 1, 1)], SHAPE + ", extra int")
    results = []
    for limit in (sizes.BROADCAST_ROWS, 3):
        monkeypatch.setattr(sizes, "BROADCAST_ROWS", limit)
        t = ChangeTable.create(spark, path(), target)
        t.merge(source if condition == "s.extra = 1" else source.drop("extra"), "k", condition)
        t.merge(spark.createDataFrame([(k, k) for k in range(30, 70)], "k int, v bigint"), "k", evolve=True)
        results.append(rows(t.current()))
    assert results[0] == results[1]


def test_refresh_reads_new_commits_only(spark, path):
    t = ChangeTable.create(spark, path("t"), "k int")
    other = ChangeTable(spark, t.path)
    t.append(spark.createDataFrame([(1,)], "k int"))
    known = other._log[0]
    assert other.refresh().version == 1 and other._log[0] is known
    assert other.refresh().version == 1 and len(other._log) == 2
