"""Merge a stream of change files into a versioned table."""

from __future__ import annotations

import uuid
from collections.abc import Iterator, Sequence
from datetime import datetime, timedelta, timezone

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQuery
from pyspark.sql.streaming.state import GroupState, GroupStateTimeout

from ..functions.schema import quoted
from ..operators import merge
from ..operators.layout import orderable
from ..operators.sizes import BROADCAST_ROWS
from ..plans.change_table import ChangeTable
from ..session import hadoop_path

def _sortable(field: T.StructField, name: str) -> list[Column]:
    """Two columns without NULL that together sort like a column in which NULL comes first."""
    plain = orderable(field)
    if isinstance(field.dataType, (T.FloatType, T.DoubleType)):
        plain = plain.cast("double")
    elif isinstance(field.dataType, T.DecimalType) and field.dataType.scale:
        raise TypeError(f"order column {field.name}: give a whole number, a double, a time or text")
    elif not isinstance(field.dataType, T.StringType):
        plain = plain.cast("bigint")
    empty = F.lit("") if isinstance(field.dataType, T.StringType) else F.lit(0)
    return [plain.isNotNull().cast("int").alias(f"{name}_set"), F.coalesce(plain, empty).alias(f"{name}_value")]


def newest_changes(changes: DataFrame, on: str | Sequence[str], order: str | Sequence[str],
                   ttl: str | None = None) -> DataFrame:
    """The stream's changes that are newer, by ``order``, than all seen before under their key.

    Each micro-batch gives at most one row per key, the greatest in ``order`` (several columns
    break ties; a NULL is before all else). The greatest order so far is kept per key in the
    query's state, so a change that arrives late is dropped in whatever batch it comes. An
    equal order does not replace. ``ttl`` ("30 days") forgets keys unchanged for that long;
    without it the state holds every key. Rows with a NULL in the key pass as they are.

    For streams into any sink. It calls Python once a key and batch; :func:`merge_stream` does
    the same by joins (:class:`SeenOrders`).
    """
    on, order = ([x] if isinstance(x, str) else list(x) for x in (on, order))
    marks = [c for i, name in enumerate(order) for c in _sortable(changes.schema[name], f"_o{i}")]
    marked = changes.select("*", *marks)
    names = [c for i in range(len(order)) for c in (f"_o{i}_set", f"_o{i}_value")]
    kinds = [marked.schema[c] for c in names]
    state_type = T.StructType([T.StructField(f.name, f.dataType) for f in kinds])
    width = len(changes.columns)
    wait = None if ttl is None else int(pd.Timedelta(ttl).total_seconds() * 1000)

    def newest(key: tuple, parts: Iterator[pd.DataFrame], state: GroupState) -> Iterator[pd.DataFrame]:
        if state.hasTimedOut:
            state.remove()
            return
        best, last = None, tuple(state.get) if state.exists else None
        for part in parts:
            top = part.sort_values(names, kind="stable").iloc[[-1]]
            at = tuple(x.item() if hasattr(x, "item") else x for x in top[names].iloc[0])
            if last is None or at > last:
                best, last = top, at
        if wait is not None:
            state.setTimeoutDuration(wait)
        if best is not None:
            state.update(last)
            yield best.iloc[:, :width]

    whole = F.lit(True)
    for k in on:
        whole = whole & F.col(quoted(k)).isNotNull()
    timeout = GroupStateTimeout.NoTimeout if wait is None else GroupStateTimeout.ProcessingTimeTimeout
    kept = marked.filter(whole).groupBy(*map(quoted, on)).applyInPandasWithState(newest, changes.schema, state_type, "append", timeout)
    return kept.unionByName(changes.filter(~whole))


class SeenOrders:
    """The greatest order merged so far of every key, kept in a table of its own below the checkpoint.

    A batch is cut down to the greatest change per key and held against the kept orders by
    one join; no Python runs per key.
    """
    FOLD_EVERY = 20     # batches between two folds of the kept orders

    def __init__(self, changes: DataFrame, table: ChangeTable, on: str | Sequence[str], order: str | Sequence[str],
                 path: str, ttl: str | None = None):
        self.table, self.path, self.ttl = table, path, ttl
        self.on, order = ([x] if isinstance(x, str) else list(x) for x in (on, order))
        self.marks = [c for i, name in enumerate(order) for c in _sortable(changes.schema[name], f"_o{i}")]
        self.names = [c for i in range(len(order)) for c in (f"_o{i}_set", f"_o{i}_value")]
        self.columns = [*map(quoted, changes.columns)]
        kinds = changes.select(*map(quoted, self.on), *self.marks).schema
        self.schema = T.StructType([*(T.StructField(f.name, f.dataType) for f in kinds), T.StructField("_at", T.TimestampType())])
        self.seen: ChangeTable | None = None

    def open(self) -> ChangeTable:
        if self.seen is None:
            spark = self.table.spark
            self.seen = ChangeTable(spark, self.path) if ChangeTable.exists(spark, self.path) else ChangeTable.create(spark, self.path, self.schema)
        return self.seen.refresh()

    def _judged(self, rows: DataFrame, seen: ChangeTable) -> DataFrame:
        """The greatest change per key, whether it is newer than all before (``_new``), and the orders to keep."""
        newest = merge.newest_per_key(rows, self.on, self.names)
        known = seen.current().select(*map(quoted, self.on), *[F.col(c).alias(f"_was{c}") for c in self.names])
        if rows.count() <= BROADCAST_ROWS:
            known = known.join(F.broadcast(rows.select(*map(quoted, self.on)).distinct()), self.on, "left_semi")
        both = newest.alias("s").join(known.alias("t"), merge._same_key(self.on), "left_outer")
        was = F.struct(*[F.col(f"t._was{c}") for c in self.names])
        first = F.col(f"t._was{self.names[0]}").isNull()
        new = first | (F.struct(*[F.col(f"s.{c}") for c in self.names]) > was)
        return both.select(*[F.col(f"s.{c}") for c in self.columns], new.alias("_new"), *[
            F.when(new, F.col(f"s.{c}")).otherwise(F.col(f"t._was{c}")).alias(c) for c in self.names])

    def merge(self, batch: DataFrame, number: int, matched_when: str | None, params: dict) -> None:
        """Merge what is new in a batch, then keep its orders.

        The orders are committed last: a batch that died in between is judged by the same
        orders when it is replayed, and its rows are not merged twice.
        """
        spark, seen, now = self.table.spark, self.open(), datetime.now(timezone.utc)
        if seen.has_commit("MERGE", **params):
            return
        folder = f"{self.table.path}/staging/{uuid.uuid4().hex}"
        try:
            marked = batch.select("*", *self.marks)
            marked.write.parquet(f"{folder}/batch")
            if self.ttl is not None and seen.version:
                seen.delete(F.col("_at") < F.lit(now - timedelta(seconds=pd.Timedelta(self.ttl).total_seconds())))
            judged = self._judged(spark.read.schema(marked.schema).parquet(f"{folder}/batch"), seen)
            judged.write.parquet(f"{folder}/judged")
            judged = spark.read.schema(judged.schema).parquet(f"{folder}/judged")
            if not self.table.has_commit("MERGE", **params):
                self.table.merge(judged.filter("_new").select(*self.columns), self.on, matched_when, stage=False, params=params)
            # with a time to live, a key that came again is kept longer even if its change was old
            kept = judged.filter(merge._all_set(self.on)).filter(F.lit(self.ttl is not None) | F.col("_new"))
            seen.merge(kept.select(*map(quoted, self.on), *self.names, F.lit(now).alias("_at")), self.on, stage=False, params=params)
            if number % self.FOLD_EVERY == self.FOLD_EVERY - 1:
                seen.expire(0, force=True)
        finally:
            p, fs = hadoop_path(spark, folder)
            fs.delete(p, True)


def merge_stream(changes: DataFrame, table: ChangeTable, on: str | Sequence[str], checkpoint: str, *,
                 matched_when: str | None = None, order: str | Sequence[str] | None = None, ttl: str | None = None,
                 stream: str = "merge", once: bool = True) -> StreamingQuery:
    """Start merging micro-batches; with ``once`` it stops when the input is used up.

    Exactly once: each commit records the stream name and batch number, and a batch that
    is replayed after a failure is skipped when its commit is already there.

    Without ``order`` a batch may hold one change per key, and changes are taken in the order
    of the batches. With it they may come repeatedly and late: of each key the change greatest
    in ``order`` counts (several columns break ties; a NULL is before all else; an equal order
    does not replace), and the table ends as after one batch sorted by ``order``. The orders
    seen are kept in the checkpoint (:class:`SeenOrders`); a stream started on a new one begins
    anew. ``ttl`` ("30 days") forgets keys that did not come for that long.
    """
    if ttl is not None and once:
        # keys are forgotten by the clock, between the batches of a stream that goes on
        raise ValueError("ttl needs a stream that goes on (once=False)")
    seen = None if order is None else SeenOrders(changes, table, on, order, f"{checkpoint.rstrip('/')}/orders-seen", ttl)

    def apply(batch: DataFrame, number: int) -> None:
        table.refresh()
        params = {"stream": stream, "batch": number}
        if seen is not None:
            seen.merge(batch, number, matched_when, params)
        elif not table.has_commit("MERGE", **params):
            table.merge(batch, on, matched_when, params=params)

    writer = changes.writeStream.foreachBatch(apply).option("checkpointLocation", checkpoint)
    if once:
        writer = writer.trigger(availableNow=True)
    return writer.start()
