import importlib
import random
import time
from datetime import date, datetime, timedelta

import pytest

from tidemark import ChangeTable
from tidemark.streaming import merge_stream

SHAPE = "k int, v int"


def test_stream_merges_each_file_once(spark, path, rows):
    inbox, check = path("inbox"), path("check")
    t = ChangeTable.create(spark, path("table"), spark.createDataFrame([(1, 1), (2, 2)], SHAPE))

    def arrive(*items):
        spark.createDataFrame(list(items), SHAPE).coalesce(1).write.mode("append").parquet(inbox)

    def run():
        changes = spark.readStream.schema(SHAPE).option("maxFilesPerTrigger", 1).parquet(inbox)
        merge_stream(changes, t, "k", check, matched_when="s.v > t.v").awaitTermination()
        return rows(t.refresh().current())

    arrive((2, 20), (3, 30))
    assert run() == [(1, 1), (2, 20), (3, 30)]
    assert run() == [(1, 1), (2, 20), (3, 30)]
    arrive((3, 29), (4, 40))
    arrive((4, 41))
    assert run() == [(1, 1), (2, 20), (3, 30), (4, 41)]
    assert t.history().filter("operation = 'MERGE'").count() == 3


def test_replayed_batch_is_skipped(spark, path, rows):
    inbox = path("inbox")
    t = ChangeTable.create(spark, path("table"), SHAPE)
    spark.createDataFrame([(1, 1)], SHAPE).write.parquet(inbox)
    changes = spark.readStream.schema(SHAPE).parquet(inbox)
    for check in (path("check"), path("check")):   # the second run has lost its checkpoint
        merge_stream(changes, t, "k", check).awaitTermination()
    assert t.refresh().version == 1


def steps(n):
    """Changes of a few keys with a time, some without, in random order and batches."""
    rng = random.Random(n)
    items = [(k, i, datetime(2024, 1, 1) + timedelta(seconds=rng.randrange(10 ** 6)) if rng.random() < .9 else None) for i, k in enumerate(rng.choices(range(6), k=60))]
    cuts = sorted(rng.sample(range(1, 60), 5))
    return items, [items[a:b] for a, b in zip([0, *cuts], [*cuts, 60])]


@pytest.mark.parametrize("seed", [1, 2])
def test_changes_out_of_order_end_as_one_sorted_batch(spark, path, rows, seed):
    items, batches = steps(seed)
    shape, inbox, check = "k int, v int, at timestamp", path("inbox"), path("check")
    t = ChangeTable.create(spark, path("table"), spark.createDataFrame([(1, -1), (77, -1)], SHAPE))

    def run():
        changes = spark.readStream.schema(shape).option("maxFilesPerTrigger", 1).parquet(inbox)
        merge_stream(changes, t, "k", check, order="at").awaitTermination()

    for i, batch in enumerate(batches):
        spark.createDataFrame(batch, shape).coalesce(1).write.mode("append").parquet(inbox)
        if i == 2:
            run()           # the state outlives the query
    spark.createDataFrame([(None, 5, None), (None, 6, None)], shape).coalesce(1).write.mode("append").parquet(inbox)
    run()
    newest = {}
    for k, v, at in items:
        if at is not None and (k not in newest or at > newest[k][0]):
            newest[k] = (at, v)
    expected = {1: -1, 77: -1} | {k: v for k, (_, v) in newest.items()}
    assert rows(t.refresh().current()) == sorted([*expected.items(), (None, 5), (None, 6)], key=repr)


def test_ties_and_several_order_columns(spark, path, rows):
    shape, inbox = "k int, v int, day date, n string", path("inbox")
    day = date(2024, 5, 1)
    for batch in ([(1, 1, day, "b"), (1, 2, day, "a"), (2, 1, None, "z")], [(1, 3, day, "b"), (1, 4, None, "z"), (2, 2, day, None)], [(1, 5, day, "bb")]):
        spark.createDataFrame(batch, shape).coalesce(1).write.mode("append").parquet(inbox)
    t = ChangeTable.create(spark, path("table"), SHAPE)
    changes = spark.readStream.schema(shape).option("maxFilesPerTrigger", 1).parquet(inbox)
    merge_stream(changes, t, "k", path("check"), order=["day", "n"]).awaitTermination()
    assert rows(t.refresh().current()) == [(1, 5), (2, 2)]


def test_a_stream_with_ttl_goes_on(spark, path, rows):
    inbox, shape = path("inbox"), SHAPE + ", n int"
    spark.createDataFrame([(1, 1, 5), (1, 2, 7)], shape).write.parquet(inbox)
    t = ChangeTable.create(spark, path("table"), SHAPE)
    with pytest.raises(ValueError, match="once=False"):
        merge_stream(spark.readStream.schema(shape).parquet(inbox), t, "k", path("check"), order="n", ttl="1 day")
    running = merge_stream(spark.readStream.schema(shape).parquet(inbox), t, "k", path("check"), order="n", ttl="1 day", once=False)
    try:
        for _ in range(120):
            if t.refresh().version:
                break
            time.sleep(0.5)
    finally:
        running.stop()
    assert rows(t.current()) == [(1, 2)]


def test_table_merge_with_order(spark, path, rows):
    t = ChangeTable.create(spark, path("table"), spark.createDataFrame([(1, 1), (2, 2)], SHAPE))
    source = spark.createDataFrame([(1, 10, 1), (1, 30, 3), (1, 20, 2), (None, 5, 1), (None, 6, 1), (3, 7, None), (3, 8, 0)], SHAPE + ", step int")
    t.merge(source, "k", order="step")
    assert rows(t.current()) == sorted([(1, 30), (2, 2), (3, 8), (None, 5), (None, 6)], key=repr)


def test_ordered_changes_run_no_python_per_key(spark, path, rows, monkeypatch):
    """A call of Python for every key and batch took most of the time; kept orders outlive a fold and a replay."""
    module = importlib.import_module("tidemark.streaming.merge_stream")
    monkeypatch.setattr(module, "newest_changes", None)
    monkeypatch.setattr(module.SeenOrders, "FOLD_EVERY", 2)
    shape, inbox, check = SHAPE + ", n int", path("inbox"), path("check")
    t = ChangeTable.create(spark, path("table"), SHAPE)

    def arrive(*items):
        spark.createDataFrame(list(items), shape).coalesce(1).write.mode("append").parquet(inbox)

    def run():
        changes = spark.readStream.schema(shape).option("maxFilesPerTrigger", 1).parquet(inbox)
        merge_stream(changes, t, "k", check, order="n").awaitTermination()
        return rows(t.refresh().current())

    arrive((1, 10, 5), (1, 11, 7), (2, 20, 1))
    arrive((1, 12, 6), (2, 21, 1), (3, 30, None))
    arrive((1, 13, 7), (2, 22, 2), (3, 31, 0), (None, 9, 1))
    assert run() == sorted([(1, 11), (2, 22), (3, 31), (None, 9)], key=repr)

    plain, dead = ChangeTable.merge, []

    def dying(self, *args, **kwargs):
        if "orders-seen" in self.path and not dead:
            dead.append(1)
            raise RuntimeError("died between the two commits")
        return plain(self, *args, **kwargs)

    monkeypatch.setattr(ChangeTable, "merge", dying)
    arrive((1, 14, 8), (2, 23, 1))
    with pytest.raises(Exception, match="died between"):
        run()
    assert run() == sorted([(1, 14), (2, 22), (3, 31), (None, 9)], key=repr)
    assert t.history().filter("operation = 'MERGE'").count() == 4
