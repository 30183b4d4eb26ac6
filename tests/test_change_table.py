import random
from collections import Counter
from datetime import datetime, timedelta

import pytest
from pyspark.sql import functions as F

from tidemark import ChangeTable
from tidemark.errors import (CommitConflict, ConstraintViolation, MergeCardinalityError,
                             RetentionTooShort, SchemaMismatch, VersionExpired, VersionNotFound)

SCORES = "id int, name string, score int"


def scores(spark, *items):
    return spark.createDataFrame(list(items), SCORES)


@pytest.fixture
def travel(spark, path):
    """River gauges in five versions, one hour apart: create, insert, delete, merge, update."""
    t0 = datetime(2026, 1, 1)
    at = lambda n: t0 + timedelta(hours=n)
    t = ChangeTable.create(spark, path("travel"), SCORES, at=at(0))
    t.append(scores(spark, (11, "Elbe", 140), (12, "Oder", 95), (15, "Main", 210), (20, "Saale", 60)), at=at(1))
    t.delete("score < 80", at=at(2))
    t.merge(scores(spark, (12, "Oder", 118), (31, "Inn", 305), (15, "Main", 199)), "id", at=at(3))
    t.update("id > 14", {"score": F.col("score") + 1}, at=at(4))
    return t


STATES = {
    0: [],
    1: [(11, "Elbe", 140), (12, "Oder", 95), (15, "Main", 210), (20, "Saale", 60)],
    2: [(11, "Elbe", 140), (12, "Oder", 95), (15, "Main", 210)],
    3: [(11, "Elbe", 140), (12, "Oder", 118), (15, "Main", 199), (31, "Inn", 305)],
    4: [(11, "Elbe", 140), (12, "Oder", 118), (15, "Main", 200), (31, "Inn", 306)],
}


def test_every_version_reads_back(travel, rows):
    for v, state in STATES.items():
        assert rows(travel.at_version(v)) == state
    assert rows(travel.current()) == STATES[4]


def test_each_statement_on_a_table_of_parcels(spark, path, rows):
    ddl = "parcel string, kilos double, depot string"
    t = ChangeTable.create(spark, path(), ddl)
    t.append(spark.createDataFrame([("p9", 2.5, "north"), ("p4", 0.75, "west"), ("p6", 11.0, None), ("p2", 4.0, "west")], ddl))
    t.merge(spark.createDataFrame([("p6", 10.5, "east"), ("p1", 1.0, "north")], ddl), "parcel")
    t.delete("depot = 'west' AND kilos < 1")
    t.update("kilos > 4", {"depot": F.concat("depot", F.lit("-heavy"))})
    assert rows(t.at_version(2)) == [("p1", 1.0, "north"), ("p2", 4.0, "west"), ("p4", 0.75, "west"), ("p6", 10.5, "east"), ("p9", 2.5, "north")]
    assert rows(t.at_version(3)) == [("p1", 1.0, "north"), ("p2", 4.0, "west"), ("p6", 10.5, "east"), ("p9", 2.5, "north")]
    assert rows(t.current()) == [("p1", 1.0, "north"), ("p2", 4.0, "west"), ("p6", 10.5, "east-heavy"), ("p9", 2.5, "north")]


def test_predicates_of_statements_reach_the_scan(spark, path):
    t = ChangeTable.create(spark, path(), spark.range(50).selectExpr("int(id) id", "'x' name", "int(id % 5) score"), partition_by=["score"])
    rows = t._live(t.version).filter("score = 2 AND id = 7")
    plan = rows._jdf.queryExecution().executedPlan().toString()
    assert "EqualTo(id,7)" in plan and "score" in plan.split("PartitionFilters: [")[1].split("]")[0]
    assert t.delete("score = 2 AND id = 7") and t.current().count() == 49


def test_merge_condition_on_a_column_of_the_source_alone(spark, path, rows):
    t = ChangeTable.create(spark, path(), "`a.key` int, name string")
    t.append(spark.createDataFrame([(1, "one"), (2, "two")], "`a.key` int, name string"))
    changes = spark.createDataFrame([(1, "uno", 5), (2, "due", 3), (4, "quattro", 1)], "`a.key` int, name string, seq int")
    t.merge(changes, "a.key", "s.seq > 4")
    assert rows(t.current()) == [(1, "uno"), (2, "two"), (4, "quattro")]


def test_reopened_table_sees_the_same(spark, travel, rows):
    again = ChangeTable(spark, travel.path)
    assert again.version == 4
    assert rows(again.current()) == STATES[4]


def test_history_and_range(travel, rows):
    got = rows(travel.history(), "version", "operation", "rows_added", "rows_removed", "readable")
    assert got == [(0, "CREATE TABLE", 0, 0, True), (1, "WRITE", 4, 0, True), (2, "DELETE", 0, 1, True),
                   (3, "MERGE", 3, 2, True), (4, "UPDATE", 2, 2, True)]
    assert rows(travel.version_range()) == [(0, 4)]


def test_timestamp_travel(travel, rows):
    at = lambda **k: datetime(2026, 1, 1) + timedelta(**k)
    assert rows(travel.at_timestamp(at(hours=2))) == STATES[2]
    assert rows(travel.at_timestamp(at(hours=2, minutes=59))) == STATES[2]
    assert rows(travel.at_timestamp(at(days=9))) == STATES[4]
    with pytest.raises(VersionNotFound):
        travel.at_timestamp(at(seconds=-1))


def test_unknown_version(travel):
    for v in (-1, 5):
        with pytest.raises(VersionNotFound):
            travel.at_version(v)


def test_commit_times_go_forward(spark, travel):
    with pytest.raises(ValueError):
        travel.delete("id = 2", at=datetime(2025, 1, 1))


def test_diff(travel, rows):
    added, removed = travel.diff(1, 4)
    assert rows(added) == [(12, "Oder", 118), (15, "Main", 200), (31, "Inn", 306)]
    assert rows(removed) == [(12, "Oder", 95), (15, "Main", 210), (20, "Saale", 60)]
    back_added, back_removed = travel.diff(4, 1)
    assert (rows(back_added), rows(back_removed)) == (rows(removed), rows(added))
    same = travel.diff(3, 3)
    assert rows(same[0]) == rows(same[1]) == []


def test_diff_is_set_or_bag(spark, path, rows):
    t = ChangeTable.create(spark, path(), scores(spark, (1, "A", 1), (2, "B", 2)))
    t.append(scores(spark, (1, "A", 1), (1, "A", 1), (3, "C", 3), (3, "C", 3)))
    t.delete("id = 2")
    added, removed = t.diff(0, 2)
    assert (rows(added), rows(removed)) == ([(3, "C", 3)], [(2, "B", 2)])
    added, removed = t.diff(0, 2, bag=True)
    assert rows(added) == [(1, "A", 1), (1, "A", 1), (3, "C", 3), (3, "C", 3)]
    assert rows(removed) == [(2, "B", 2)]


@pytest.mark.parametrize("limit", [0, 1])
def test_diff_beyond_broadcast_limit(spark, travel, path, rows, monkeypatch, limit):
    monkeypatch.setattr("tidemark.plans.change_table.BROADCAST_ROWS", limit)
    test_diff(travel, rows)
    test_diff_is_set_or_bag(spark, path, rows)


def test_restore_is_a_new_version(travel, rows):
    assert travel.restore(1) == 5
    assert rows(travel.current()) == STATES[1]
    for v, state in STATES.items():
        assert rows(travel.at_version(v)) == state
    travel.restore(4)
    assert rows(travel.current()) == STATES[4]


def test_restore_brings_the_schema_back(spark, path, rows):
    t = ChangeTable.create(spark, path(), scores(spark, (1, "A", 1)))
    t.append(scores(spark, (1, "A", 1)).withColumn("source", F.lit("web")), evolve=True)
    assert t.columns == ["id", "name", "score", "source"]
    assert rows(t.current()) == [(1, "A", 1, "web"), (1, "A", 1, None)]
    t.restore(0)
    assert t.columns == ["id", "name", "score"]
    assert rows(t.current()) == [(1, "A", 1)]
    t.restore(1)
    assert rows(t.current()) == [(1, "A", 1, "web"), (1, "A", 1, None)]
    t.restore(0)
    with pytest.raises(SchemaMismatch):
        t.append(scores(spark, (9, "Z", 9)).withColumn("source", F.lit(7)), evolve=True)


def test_delete_then_restore(spark, path, rows):
    t = ChangeTable.create(spark, path(), scores(spark, (1, "A", 1), (1, "A", 1), (2, "B", 2)))
    t.delete("name = 'A'")
    assert rows(t.current()) == [(2, "B", 2)]
    t.restore(t.version - 1)
    assert rows(t.current()) == [(1, "A", 1), (1, "A", 1), (2, "B", 2)]


def test_bronze_flow_keeps_duplicates(spark, path, rows):
    data = [("R-1", "C-01", "2026-01-01", "DELIVERED", 1, 499.0),
            ("R-2", "C-02", "2026-01-01", "CANCELLED", 2, 299.0),
            ("R-3", "C-01", "2026-01-02", "PLACED", 1, 999.0)]
    frame = spark.createDataFrame(data, "order_id string, customer_id string, d string, status string, "
                                        "quantity bigint, price double").withColumn("d", F.to_date("d"))
    t = ChangeTable.create(spark, path(), frame)
    with pytest.raises(SchemaMismatch):
        t.append(frame.withColumn("quantity", F.lit("many")))
    assert t.version == 0
    t.append(frame.withColumn("source_system", F.lit("landing")), evolve=True)
    assert t.current().count() == 6
    t.update("order_id = 'R-3'", {"status": "DELIVERED"})
    assert t.history().filter("version = 2").first()["rows_removed"] == 2
    t.delete("status = 'CANCELLED'")
    assert t.current().count() == 4
    t.restore(0)
    assert rows(t.current(), "order_id", "status") == [
        ("R-1", "DELIVERED"), ("R-2", "CANCELLED"), ("R-3", "PLACED")]


def test_null_predicate_touches_nothing(spark, path, rows):
    t = ChangeTable.create(spark, path(), scores(spark, (1, None, 1), (2, "B", 2)))
    t.update("name = 'B'", {"score": F.col("score") + 1})
    t.delete("name = 'A'")
    assert rows(t.current()) == [(1, None, 1), (2, "B", 3)]
    t.delete("name <> 'X'")
    assert rows(t.current()) == [(1, None, 1)]


def test_overwrite(travel, spark, rows):
    travel.overwrite(scores(spark, (7, "G", 7)))
    assert rows(travel.current()) == [(7, "G", 7)]
    assert rows(travel.at_version(4)) == STATES[4]


def test_merge_rules(spark, path, rows):
    t = ChangeTable.create(spark, path(), scores(spark, (1, "A", 10), (1, "A", 11), (2, "B", 20), (None, "N", 0)))
    t.merge(scores(spark, (1, "new", 50), (2, "old", 5), (None, "M", 1), (3, "C", 1), (3, "C", 1)),
            "id", "s.score > t.score")
    assert rows(t.current()) == sorted([(1, "new", 50), (1, "new", 50), (2, "B", 20), (None, "N", 0),
                                        (None, "M", 1), (3, "C", 1), (3, "C", 1)], key=repr)
    before = t.version
    with pytest.raises(MergeCardinalityError):
        t.merge(scores(spark, (2, "x", 1), (2, "y", 2)), "id")
    assert t.version == before


def test_merge_twice_is_merge_once(travel, spark, rows):
    batch = scores(spark, (3, "C", 301), (9, "I", 9))
    travel.merge(batch, "id")
    once = rows(travel.current())
    travel.merge(batch, "id")
    assert rows(travel.current()) == once


def test_merge_with_new_and_missing_columns(spark, path, rows):
    t = ChangeTable.create(spark, path(), scores(spark, (1, "A", 10)))
    with pytest.raises(SchemaMismatch):
        t.merge(spark.createDataFrame([(1, 5)], "id int, score int"), "id")
    t.merge(spark.createDataFrame([(1, 5, "x"), (2, 6, "y")], "id int, score int, tag string"), "id", evolve=True)
    assert rows(t.current()) == [(1, "A", 5, "x"), (2, None, 6, "y")]


def test_constraints_refuse_and_write_nothing(spark, path, rows):
    ddl = "order_id string, quantity int, price double, amount double"
    t = ChangeTable.create(spark, path(), ddl, not_null=["order_id"],
                           checks={"positive_qty": "quantity > 0", "positive_price": "price > 0"})
    t.append(spark.createDataFrame([("O-1", 1, 10.0, 10.0)], ddl))
    for bad, name in ((("R-9", -1, 10.0, -10.0), "positive_qty"), ((None, 1, 1.0, 1.0), "order_id NOT NULL"),
                      (("O-N", None, 1.0, None), "positive_qty")):
        with pytest.raises(ConstraintViolation, match=name):
            t.append(spark.createDataFrame([bad], ddl))
    with pytest.raises(ConstraintViolation):
        t.update("order_id = 'O-1'", {"quantity": 0})
    assert t.version == 1 and rows(t.current()) == [("O-1", 1, 10.0, 10.0)]
    t.delete("order_id = 'O-1'")
    assert rows(t.current()) == []


def test_null_passes_switch(spark, path, rows):
    t = ChangeTable.create(spark, path(), "q int", checks={"pos": "q > 0"}, null_passes=True)
    t.append(spark.createDataFrame([(None,), (1,)], "q int"))
    assert t.current().count() == 2


def test_partitioned_table(spark, path, rows):
    t = ChangeTable.create(spark, path(), scores(spark, (1, "A", 10), (2, "B", 20), (3, None, 30)),
                           partition_by=["name"])
    t.update("id = 1", {"name": "B"})
    t.merge(scores(spark, (2, "C", 21), (4, "A", 4)), "id")
    expect = [(1, "B", 10), (2, "C", 21), (3, None, 30), (4, "A", 4)]
    assert rows(t.current()) == expect
    assert "PartitionFilters: [isnotnull(name" in t.current().filter("name = 'B'")._jdf.queryExecution().toString()
    t.optimize(full=True)
    assert rows(t.current()) == expect


def small_appends(spark, path, n=20):
    ddl = "order_id int, amount int, status string"
    t = ChangeTable.create(spark, path(), ddl)
    for i in range(1, n + 1):
        t.append(spark.createDataFrame([(i, i * 10, "CREATED")], ddl))
    return t


def test_small_files_fold_into_one(spark, path, rows):
    t = small_appends(spark, path)
    before, bag = t.detail().first(), rows(t.current())
    assert before["num_segments"] == 20 and before["num_rows"] == 20
    t.optimize()
    after = t.detail().first()
    assert (after["num_files"], after["num_rows"]) == (1, 20)
    assert before["num_files"] >= 20
    assert rows(t.current()) == bag
    t.update("order_id BETWEEN 5 AND 10", {"status": "SHIPPED"})
    t.delete(F.col("order_id").isin(1, 2, 3))
    assert rows(t.current().groupBy("status").count()) == [("CREATED", 11), ("SHIPPED", 6)]
    assert t.at_version(7).count() == 7
    t.restore(20)
    assert rows(t.current()) == bag
    # addresses survive the fold, so the restore moved only what had changed since
    assert t.history().filter("operation = 'RESTORE'").first()["rows_added"] == 9


def test_partial_fold_leaves_a_big_base(spark, path, rows):
    base = spark.range(9000).selectExpr("int(id) id", "'x' name", "int(id) score")
    t = ChangeTable.create(spark, path(), base)
    t.append(scores(spark, (20_000, "n", 1), (20_001, "n", 2)))
    t.delete("id IN (3, 20000)")
    t.update("id = 5", {"name": "five"})
    bag = rows(t.current())
    v = t.optimize(target_bytes=30_000)     # the base's files are larger than half of that
    assert t.history().filter(f"version = {v}").first()["params"]["folded"] == "3"
    assert rows(t.current()) == bag
    t.update("id = 5", {"name": "again"})
    t.optimize()
    assert t.current().filter("id = 5").first()["name"] == "again"
    assert t.current().count() == len(bag)
    t.optimize(full=True)
    assert t.detail().first()["num_segments"] == 1
    assert t.current().count() == len(bag)


def test_a_base_of_small_files_is_folded(spark, path, rows):
    t = ChangeTable.create(spark, path(), spark.range(1000).selectExpr("int(id) id", "'x' name", "int(id) score").repartition(20))
    t.append(scores(spark, (2000, "n", 1)))
    assert t.detail().first()["num_files"] >= 21
    t.optimize()
    assert t.detail().first()["num_files"] <= 3 and t.current().count() == 1001


def test_clustering_stays_within_partitions(spark, path, rows):
    """Thirty partition values, thirty files: clustering must not multiply them."""
    base = spark.range(3000).selectExpr("int(id) id", "concat('Customer#', lpad(id * 7 % 3000, 9, '0')) name", "int(id % 30) score")
    t = ChangeTable.create(spark, path(), base, partition_by=["score"])
    before = t.detail().first()["num_files"]
    bag = rows(t.current())
    t.optimize(zorder_by=["id", "name"])
    assert t.detail().first()["num_files"] <= max(before, 60) and rows(t.current()) == bag


def test_text_with_a_common_prefix_counts_in_full(spark):
    from tidemark.operators.layout import z_bits, z_value
    df = spark.range(4000).selectExpr("concat('Customer#00000', lpad(id, 9, '0')) name", "id % 7 other", "id")
    placed, z = z_value(df, ["name", "other"], files=64)
    ids = placed.select("name", *z).distinct().select(*z).distinct().count()
    assert ids == 32 * 7 and z_bits(2, 400_000) >= 11 and len(z_value(df, ["name", "other", "id"] * 6, files=64)[1]) == 2


@pytest.mark.parametrize("columns", [["id"], ["id", "score"], ["name", "score"]])
def test_zorder_keeps_the_rows(spark, path, rows, columns):
    base = spark.range(500).selectExpr("int(id) id", "concat('n', id % 7) name", "int(id * 37 % 101) score")
    t = ChangeTable.create(spark, path(), base)
    t.delete("id % 5 = 0")
    bag = rows(t.current())
    t.optimize(zorder_by=columns, target_bytes=2000)
    assert rows(t.current()) == bag
    assert t.detail().first()["num_files"] > 1


def test_shallow_clone_is_independent(travel, spark, path, rows):
    c = travel.clone_shallow(path("clone"), 3)
    assert rows(c.current()) == STATES[3]
    travel.delete("true")
    c.update("id = 12", {"score": 1})
    c.delete("id IN (11, 31)")
    c.append(scores(spark, (44, "Ilz", 8)))
    assert rows(c.current()) == [(12, "Oder", 1), (15, "Main", 199), (44, "Ilz", 8)]
    assert rows(travel.current()) == []
    grandchild = c.clone_shallow(path("clone"))
    grandchild.delete("id = 44")
    assert rows(grandchild.current()) == [(12, "Oder", 1), (15, "Main", 199)]
    assert c.version == 3
    c.restore(0)
    assert rows(c.current()) == STATES[3]
    c.optimize(full=True)
    assert rows(c.current()) == STATES[3]


def test_deep_clone_and_backup(travel, path, rows):
    d, b = travel.clone_deep(path("deep")), travel.backup(path("backup"), 1)
    travel.expire(0, force=True)
    assert rows(d.current()) == STATES[4]
    assert rows(b.current()) == STATES[1]


def test_expire(travel, rows):
    with pytest.raises(RetentionTooShort):
        travel.expire(1)
    now = datetime(2026, 1, 1, 3, 30)
    assert travel.expire(1, force=True, now=now) == 2
    with pytest.raises(VersionExpired):
        travel.at_version(1)
    with pytest.raises(VersionExpired):
        travel.restore(1)
    assert rows(travel.at_version(2)) == STATES[2]
    assert rows(travel.at_version(3)) == STATES[3]
    assert rows(travel.current()) == STATES[4]
    kept = travel.expire(0, force=True)
    assert rows(travel.current()) == STATES[4] == rows(travel.at_version(kept))
    with pytest.raises(VersionExpired):
        travel.at_version(4)
    assert travel.detail().first()["num_segments"] == 1
    assert travel.history().count() == travel.version + 1
    travel.delete("id < 15")
    assert rows(travel.current()) == [(15, "Main", 200), (31, "Inn", 306)]


def test_default_expiry_keeps_a_young_table(spark, path, rows):
    t = small_appends(spark, path, 3)
    assert t.expire() == 0
    assert t.at_version(2).count() == 2


def test_expire_removes_the_folders(travel, spark, tmp_path):
    import os
    data = os.path.join(travel.path, "data")
    before = len(os.listdir(data))
    travel.expire(0, force=True)
    assert before == 4 and len(os.listdir(data)) == 1


def test_second_writer_is_refused(spark, travel, rows):
    other = ChangeTable(spark, travel.path)
    travel.delete("id < 15")
    with pytest.raises(CommitConflict):
        other.delete("id = 31")
    assert rows(other.refresh().current()) == [(15, "Main", 200), (31, "Inn", 306)]


def test_unnamed_folder_is_ignored(spark, travel, rows):
    scores(spark, (66, "X", 6)).write.parquet(f"{travel.path}/data/_seg=9-dead/_w=1")
    assert rows(ChangeTable(spark, travel.path).current()) == STATES[4]


def test_many_removed_rows_shuffle_instead_of_broadcast(spark, path, monkeypatch, rows):
    t = ChangeTable.create(spark, path(), spark.range(300).selectExpr("int(id) id"))
    t.delete("id < 100")
    broadcast = rows(t.current())
    monkeypatch.setattr("tidemark.plans.change_table.BROADCAST_ROWS", 10)
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        assert "SortMergeJoin" in t.current()._jdf.queryExecution().toString()
        assert rows(t.current()) == broadcast
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")


def test_folders_older_than_any_removal_skip_the_join(spark, path):
    t = ChangeTable.create(spark, path(), spark.range(50).selectExpr("int(id) id"))
    t.append(spark.range(50, 60).selectExpr("int(id) id"))
    t.delete("id = 55")
    plan = t.current()._jdf.queryExecution().optimizedPlan().toString()
    assert plan.startswith("Union") and plan.count("Join LeftAnti") == 1
    assert t.current().count() == 59


def test_versions_across_a_replacement(travel, spark, rows):
    travel.overwrite(scores(spark, (11, "Elbe", 140), (7, "Ruhr", 7)))
    assert travel.history().filter("version = 5").first()["rows_removed"] == 4
    added, removed = travel.diff(4, 5)
    assert rows(added) == [(7, "Ruhr", 7)]
    assert rows(removed) == STATES[4][1:]
    added, removed = travel.diff(4, 5, bag=True)
    assert (rows(added), len(rows(removed))) == ([(7, "Ruhr", 7)], 3)
    travel.update("id = 7", {"score": 8})
    travel.restore(2)
    assert rows(travel.current()) == STATES[2]
    assert rows(travel.at_version(6)) == [(11, "Elbe", 140), (7, "Ruhr", 8)]
    travel.restore(6)
    assert rows(travel.current()) == [(11, "Elbe", 140), (7, "Ruhr", 8)]


def test_overwrite_of_a_shallow_clone(travel, spark, path, rows):
    c = travel.clone_shallow(path("clone"))
    c.overwrite(scores(spark, (5, "E", 5)))
    c.append(scores(spark, (6, "F", 6)))
    assert rows(c.current()) == [(5, "E", 5), (6, "F", 6)]
    assert rows(c.at_version(0)) == STATES[4]
    assert rows(travel.current()) == STATES[4]


def test_merge_computes_its_source_once(spark, path, rows):
    t = ChangeTable.create(spark, path(), scores(spark, (1, "A", 1), (2, "B", 2)))
    shaky = spark.range(1, 4).select(F.col("id").cast("int").alias("id"), F.uuid().alias("name"),
                                     F.lit(0).alias("score"))
    t.merge(shaky, "id")
    assert rows(t.current().groupBy("id").count()) == [(1, 1), (2, 1), (3, 1)]
    import os
    assert os.listdir(f"{t.path}/staging") == []


def test_merge_ignores_columns_the_table_lacks(travel, spark, rows):
    travel.merge(scores(spark, (31, "Inn", 300)).withColumn("more", F.lit(1)), "id")
    assert rows(travel.current()) == [*STATES[4][:3], (31, "Inn", 300)]


def test_merge_without_staging(travel, spark, rows):
    travel.merge(scores(spark, (31, "Inn", 300)), "id", stage=False)
    assert rows(travel.current()) == [*STATES[4][:3], (31, "Inn", 300)]


def test_merge_beyond_the_broadcast_limit(spark, path, rows, monkeypatch):
    monkeypatch.setattr("tidemark.operators.sizes.BROADCAST_ROWS", 0)
    test_merge_rules(spark, path, rows)


def test_one_key_in_a_third_of_the_rows(spark, path):
    base = spark.range(3000).selectExpr("int(if(id % 3 = 0, 7, id + 10)) id", "'x' name", "int(id) score")
    t = ChangeTable.create(spark, path(), base)
    t.merge(scores(spark, (7, "hot", 0), (5, "new", 0)), "id")
    assert t.current().filter("name = 'hot'").count() == 1000
    assert t.current().count() == 3001


@pytest.mark.parametrize("seed", [1, 2])
def test_random_statements_against_a_list_of_rows(spark, path, rows, seed):
    """Any mix of statements, checked at every version against plain Python lists."""
    rnd = random.Random(seed)
    t = ChangeTable.create(spark, path(), SCORES)
    model, states = [], [[]]
    draw = lambda: (rnd.randrange(6), rnd.choice("AB"), rnd.randrange(4))
    for _ in range(14):
        kind = rnd.choice(["append", "append", "update", "delete", "merge", "restore", "optimize", "overwrite"])
        k = rnd.randrange(6)
        if kind == "append":
            new = [draw() for _ in range(4)]
            t.append(scores(spark, *new))
            model = model + new
        elif kind == "update":
            t.update(f"id = {k}", {"score": F.col("score") + 1})
            model = [(i, n, s + 1) if i == k else (i, n, s) for i, n, s in model]
        elif kind == "delete":
            t.delete(f"score = {k}")
            model = [r for r in model if r[2] != k]
        elif kind == "merge":
            batch = {i: (i, "M", rnd.randrange(4)) for i in (k, k + 1, 7)}
            t.merge(scores(spark, *batch.values()), "id", "s.score >= t.score")
            there = {r[0] for r in model}
            model = [batch[r[0]] if r[0] in batch and batch[r[0]][2] >= r[2] else r for r in model]
            model += [r for i, r in batch.items() if i not in there]
        elif kind == "restore":
            v = rnd.randrange(len(states))
            t.restore(v)
            model = list(states[v])
        elif kind == "optimize":
            t.optimize(full=rnd.random() < 0.5)
        else:
            new = [draw() for _ in range(3)]
            t.overwrite(scores(spark, *new))
            model = new
        states.append(list(model))
        assert rows(t.current()) == sorted(model, key=repr), kind
    for v in rnd.sample(range(len(states)), 6):
        assert rows(t.at_version(v)) == sorted(states[v], key=repr)
    older, newer = sorted(rnd.sample(range(len(states)), 2))
    added, removed = t.diff(older, newer)
    assert rows(added) == sorted(set(states[newer]) - set(states[older]), key=repr)
    assert rows(removed) == sorted(set(states[older]) - set(states[newer]), key=repr)
    bag_added, bag_removed = t.diff(older, newer, bag=True)
    assert rows(bag_added) == sorted((Counter(states[newer]) - Counter(states[older])).elements(), key=repr)
    assert rows(bag_removed) == sorted((Counter(states[older]) - Counter(states[newer])).elements(), key=repr)
    t.expire(0, force=True)
    assert rows(t.current()) == sorted(model, key=repr)


def test_filters_and_columns_reach_every_scan(spark, path):
    base = spark.range(100).selectExpr("int(id) id", "'x' name", "int(id) score")
    t = ChangeTable.create(spark, path(), base)
    t.append(scores(spark, (200, "n", 1)))
    t.delete("id = 3")
    plan = t.current().filter("id = 200").select("score")._jdf.queryExecution().executedPlan().toString()
    scans = [line for line in plan.splitlines() if "FileScan" in line]
    assert sorted(line.split("ReadSchema: ")[1] for line in scans) == [
        "struct<_src:int,_rid:bigint>", "struct<id:int,score:int,_src:int,_rid:bigint>"]
    assert all("EqualTo(id,200)" in line for line in scans if "score" in line)


def test_merge_reads_only_keys_of_the_table(spark, path, monkeypatch):
    from tidemark.operators import merge
    base = spark.range(100).selectExpr("int(id) id", "'x' name", "int(id) score")
    t = ChangeTable.create(spark, path(), base)
    live = t._live(0)
    src = merge.checked_source(live, scores(spark, (1, "a", 1)), "id")
    changes = t._merge_changes(live, src, "s.score > t.score", t.schema, set())
    plan = changes._jdf.queryExecution().executedPlan().toString()
    reads = [line.split("ReadSchema: ")[1] for line in plan.splitlines() if "FileScan" in line]
    assert sorted(reads) == ["struct<id:int,score:int,_src:int,_rid:bigint>", "struct<id:int>"]


def test_column_names(spark, path, rows):
    t = ChangeTable.create(spark, path(), "`a.b` int, Name string")
    t.append(spark.createDataFrame([(1, "x"), (2, "y")], "`a.b` int, NAME string"))
    t.update("`a.b` = 1", {"Name": "z"})
    t.merge(spark.createDataFrame([(9, "q")], "`a.b` int, name string"), "Name")
    assert t.columns == ["a.b", "Name"]
    assert rows(t.current()) == [(1, "z"), (2, "y"), (9, "q")]
    assert rows(t.diff(1, 3)[0]) == [(1, "z"), (9, "q")]
    t.restore(1)
    assert rows(t.current()) == [(1, "x"), (2, "y")]
    for ddl in ("_w int", "_RID int", "a int, A int"):
        with pytest.raises(SchemaMismatch):
            ChangeTable.create(spark, path(), ddl)


def test_optimize_leaves_a_tidy_table_alone(spark, path):
    t = ChangeTable.create(spark, path(), spark.range(1000).selectExpr("id").coalesce(1))
    v = t.optimize()
    assert t.history().filter(f"version = {v}").first()["params"]["folded"] == "0"
    assert t.current().count() == 1000


def test_view_by_name(spark, travel, rows):
    travel.create_view("travel_then", 2)
    travel.create_view("travel_now")
    assert rows(spark.sql("SELECT * FROM travel_then")) == STATES[2]
    assert rows(spark.sql("SELECT * FROM travel_now")) == STATES[4]


def test_nested_columns(spark, path, rows):
    df = spark.sql("SELECT 1 AS id, array(1, 2) AS a, map('k', 1) AS m, named_struct('x', 1.5D) AS s")
    t = ChangeTable.create(spark, path(), df)
    t.append(df.withColumn("id", F.lit(2)))
    t.merge(df.withColumn("a", F.array(F.lit(9))), "id")
    assert rows(t.current(), "id", "a", "m", "s.x") == [(1, [9], {"k": 1}, 1.5), (2, [1, 2], {"k": 1}, 1.5)]


def test_a_fold_past_the_broadcast_limit_does_not_join_in_the_writing_tasks(spark, path, rows, monkeypatch):
    """The sort of the join ran under ``coalesce``: one task sorted the whole table."""
    seen = []
    plain = ChangeTable._write
    monkeypatch.setattr(ChangeTable, "_write", lambda self, changes, *a, **k: (
        seen.append(changes._jdf.queryExecution().optimizedPlan().toString()), plain(self, changes, *a, **k))[1])
    monkeypatch.setattr("tidemark.plans.change_table.BROADCAST_ROWS", 10)
    t = ChangeTable.create(spark, path(), spark.range(300).selectExpr("int(id) id"))
    t.delete("id < 100")
    bag = rows(t.current())
    t.optimize(full=True)
    fold = seen[-1]
    assert "LeftAnti" in fold and "Repartition 1, false" not in fold
    assert rows(t.current()) == bag and t.detail().first()["num_files"] == 1


def test_a_clustering_sorts_in_bounded_tasks(spark, path, rows, monkeypatch):
    """A task sorted a whole target file, which takes ten times its size in memory."""
    t = ChangeTable.create(spark, path(), spark.range(20_000).selectExpr("id", "id * 37 % 1009 other"))
    bag = rows(t.current())
    monkeypatch.setattr("tidemark.operators.layout.SORT_BYTES", 40_000, raising=False)
    t.optimize(zorder_by=["id", "other"])
    made = t.detail().first()["num_files"]
    assert made > 2 and rows(t.current()) == bag
    t.optimize()            # files of that size are not small
    assert t.detail().first()["num_files"] == made


@pytest.mark.parametrize("hot", [0.0, 0.8])
def test_clustering_cuts_only_large_partition_values(spark, path, rows, monkeypatch, hot):
    """More sorting tasks than one cut partition values in two, and so multiplied the files."""
    base = spark.range(20_000).selectExpr("id", "id * 37 % 1009 other", f"if(id < {int(20_000 * hot)}, 0, id % 10) part")
    t = ChangeTable.create(spark, path(), base, partition_by=["part"])
    bag = rows(t.current())
    t.optimize(zorder_by=["id", "other"], target_bytes=t.detail().first()["size_bytes"] // 5)
    files = t.detail().first()["num_files"]
    assert rows(t.current()) == bag and (files == 10 if not hot else 10 < files <= 25)
