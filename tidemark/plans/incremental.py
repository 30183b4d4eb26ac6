"""Incremental extract: bookmark, window, landing, bookmark advance.

One run reads the rows with ``lo < change time <= hi``. ``lo`` is the bookmark and ``hi``
is fixed by one aggregate before any row is read, so rows that arrive during the run
fall wholly into the next one. The bookmark moves last: a run that dies before that is
repeated, and either ``replace`` takes away what the dead run landed, or
:func:`~tidemark.operators.latest_per_key` or a merge makes repeats harmless.
Hard deletes at the source leave no change time and do not show; compare key lists
with ``set_minus`` for those.
"""

from __future__ import annotations

from dataclasses import dataclass
from datetime import datetime, timezone
from decimal import Decimal

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..errors import CommitConflict
from ..functions.columns import bookmark_text, bookmark_value

from ..operators.latest import latest_per_key
from ..operators.merge import merge_upsert
from ..sinks.files import land_batch, land_increment
from ..sinks.jdbc import write_jdbc
from ..sources.jdbc import as_table, high_water_sql, jdbc_split, read_jdbc, window_predicate
from .change_table import ChangeTable

# fixed values: the columns of bookmark tables that jobs already write
BOOKMARK_SCHEMA = T.StructType([
    T.StructField("table_name", T.StringType(), False),
    T.StructField("last_value", T.StringType(), True),
    T.StructField("updated_at", T.TimestampType(), True),
])


# ---------------------------------------------------------------------- rows of a window

def extract_full(df: DataFrame) -> DataFrame:
    """First load: every row, also those without a change time."""
    return df


def extract_since(df: DataFrame, column: str, lo: str | None, hi: str | None = None) -> DataFrame:
    """Rows with ``lo < column <= hi``; the bounds are text in the bookmark's format.

    The text becomes a literal of the column's own type, so the filter reaches the scan.
    """
    kind = df.schema[column].dataType
    if lo is not None:
        df = df.filter(F.col(column) > bookmark_value(lo, kind))
    if hi is not None:
        df = df.filter(F.col(column) <= bookmark_value(hi, kind))
    return df


@dataclass(frozen=True)
class Window:
    hi: str | None      # greatest change time, as text
    rows: int           # rows with a change time above the bookmark
    untimed: int        # rows without a change time: only a first load reads them


@dataclass(frozen=True)
class FrameSource:
    """Any frame with a change-time column."""
    df: DataFrame
    column: str

    def window(self, lo: str | None) -> Window:
        c = F.col(self.column)
        kind = self.df.schema[self.column].dataType
        newer = F.lit(True) if lo is None else c > bookmark_value(lo, kind)
        row = self.df.filter(newer | c.isNull()).agg(
            bookmark_text(F.max(c), kind).alias("hi"), F.count(c).alias("n"),
            F.count(F.when(c.isNull(), 1)).alias("n_null")).first()
        return Window(row["hi"], row["n"], row["n_null"])

    def rows(self, lo: str | None, hi: str | None) -> DataFrame:
        if lo is None:
            full = extract_full(self.df)
            return full if hi is None else full.filter(
                F.col(self.column).isNull()
                | (F.col(self.column) <= bookmark_value(hi, self.df.schema[self.column].dataType)))
        return extract_since(self.df, self.column, lo, hi)


@dataclass(frozen=True)
class JdbcSource:
    """A database table; bounds and rows are computed by the database.

    With ``split_column`` (numeric, date or timestamp, best the indexed key) the rows of a
    window are read by ``parts`` tasks over even ranges between the least and greatest
    value in that window; without it one task reads them all.
    """
    spark: SparkSession
    connection: dict
    table: str
    column: str
    split_column: str | None = None
    parts: int = 16

    def window(self, lo: str | None) -> Window:
        row = read_jdbc(self.spark, self.connection, as_table(
            high_water_sql(self.table, self.column, lo))).select(
            bookmark_text(F.col("hi")).alias("hi"), "n", "n_null").first()
        return Window(row["hi"], row["n"], row["n_null"])

    def rows_sql(self, lo: str | None, hi: str | None) -> str:
        inside = window_predicate(self.column, lo, hi)
        if lo is None and hi is not None:
            inside = f"{self.column} IS NULL OR {inside}"
        return f"SELECT * FROM {self.table} WHERE {inside}"

    def rows(self, lo: str | None, hi: str | None) -> DataFrame:
        wanted = as_table(self.rows_sql(lo, hi))
        split = None
        if self.split_column is not None:
            split = jdbc_split(self.spark, self.connection, wanted, self.split_column, self.parts)
        return read_jdbc(self.spark, self.connection, wanted, split)


def comes_before(one: str, other: str) -> bool:
    """Whether bookmark text ``one`` is less than ``other``: as numbers, as times, else as text."""
    for kind in (Decimal, _instant):
        try:
            return kind(one) < kind(other)
        except (ValueError, ArithmeticError):
            continue
    return one < other


def _instant(text: str) -> datetime:
    t = datetime.fromisoformat(text)
    return t if t.tzinfo else t.replace(tzinfo=timezone.utc)


# ---------------------------------------------------------------------- bookmarks

def read_bookmark(bookmarks: DataFrame, name: str, default: str | None = None,
                  value: str = "last_value") -> str | None:
    """Last value of one source as text, or ``default`` when it has no row. Read errors surface."""
    row = bookmarks.filter(F.col("table_name") == name).select(
        bookmark_text(F.col(value), bookmarks.schema[value].dataType)).first()
    return default if row is None or row[0] is None else row[0]


def bookmark_advance(bookmarks: DataFrame, name: str, new_value: DataFrame,
                     value: str = "last_value") -> DataFrame:
    """``bookmarks`` with the row of ``name`` set from the one-row frame ``new_value``.

    A NULL new value (no row had a change time) leaves the old row as it is.
    """
    fresh = new_value.select(F.lit(name).alias("table_name"), *[
        F.col(c).cast(bookmarks.schema[c].dataType) for c in bookmarks.columns if c != "table_name"]
    ).filter(F.col(value).isNotNull())
    return merge_upsert(bookmarks, fresh, "table_name")


class TableBookmarks:
    """Bookmarks in a versioned table: each advance is one commit, so it can be audited."""

    def __init__(self, spark: SparkSession, path: str):
        self.spark = spark
        self.table = (ChangeTable(spark, path) if ChangeTable.exists(spark, path)
                      else ChangeTable.create(spark, path, BOOKMARK_SCHEMA))

    def get(self, name: str, default: str | None = None) -> str | None:
        return read_bookmark(self.table.refresh().current(), name, default)

    def advance(self, name: str, value: str, at: datetime, tries: int = 10) -> None:
        """Set one source's row. Jobs for other sources may commit meanwhile; then it is tried again."""
        own = F.col("table_name") == name
        for left in reversed(range(tries)):
            try:
                if self.table.refresh().current().filter(own).isEmpty():
                    self.table.append(self.spark.createDataFrame([(name, value, at)], BOOKMARK_SCHEMA))
                else:
                    self.table.update(own, {"last_value": value, "updated_at": at})
                return
            except CommitConflict:
                if not left:
                    raise


class JdbcBookmarks:
    """Bookmarks in a database table: an advance appends a row, the latest row of a source counts.

    Nothing is emptied or rewritten, so a crash loses no bookmark. ``value`` and ``stamp``
    name the columns; where both are one column, the change time itself tells the latest.
    """

    def __init__(self, spark: SparkSession, connection: dict, table: str, value: str = "last_value",
                 stamp: str = "updated_at"):
        self.spark, self.connection, self.table, self.value, self.stamp = spark, connection, table, value, stamp

    def latest(self, rows: DataFrame) -> DataFrame:
        """One row per source: the one with the greatest stamp, then value."""
        return latest_per_key(rows, ["table_name"], list(dict.fromkeys([self.stamp, self.value])))

    def row(self, name: str, value: str, at: datetime) -> DataFrame:
        kind = "timestamp" if self.stamp == self.value else "string"
        out = self.spark.range(1).select(F.lit(name).alias("table_name"), F.lit(value).cast(kind).alias(self.value))
        return out if self.stamp == self.value else out.withColumn(self.stamp, F.lit(at).cast("timestamp"))

    def get(self, name: str, default: str | None = None) -> str | None:
        rows = read_jdbc(self.spark, self.connection, self.table).filter(F.col("table_name") == name)
        return read_bookmark(self.latest(rows), name, default, self.value)

    def advance(self, name: str, value: str, at: datetime) -> None:
        write_jdbc(self.row(name, value, at), self.connection, self.table, mode="append")


# ---------------------------------------------------------------------- one run

@dataclass(frozen=True)
class Outcome:
    lo: str | None
    hi: str | None
    landed: int
    untimed: int

    @property
    def advanced(self) -> bool:
        return self.landed > 0 and self.hi is not None


def run_incremental(name: str, source: FrameSource | JdbcSource, bookmarks, landing: str, *,
                    fmt: str = "parquet", default: str | None = None,
                    overlap: str | None = None, now: datetime | None = None, replace: bool = False) -> Outcome:
    """Land what changed at ``source`` since its bookmark and advance the bookmark.

    With ``replace`` a batch is named after the source and the bookmark it starts from, and
    takes the place of what a run from the same bookmark landed before it died: what lies in
    the landing is then each change once, however often runs were repeated.

    No bookmark and no ``default`` means a full load. ``overlap`` reads again from an
    earlier bound, for sources whose change times are coarse; downstream must then be keyed.
    """
    now = now or datetime.now(timezone.utc)
    lo = bookmarks.get(name, default)
    start = overlap if overlap is not None and lo is not None and comes_before(overlap, lo) else lo
    seen = source.window(start)
    if seen.rows == 0 and not (lo is None and seen.untimed):
        return Outcome(lo, lo, 0, seen.untimed)
    batch = f"{name}:{start or ''}:{seen.hi or ''}"
    rows = source.rows(start, seen.hi)
    if replace:
        landed = land_batch(rows, landing, f"{name}:{start or ''}", fmt=fmt, at=now, batch_id=batch)
    else:
        landed = land_increment(rows, landing, fmt=fmt, batch=batch, at=now, known_rows=True)
    hi = lo if seen.hi is None or (lo is not None and comes_before(seen.hi, lo)) else seen.hi
    if landed and hi is not None and hi != lo:      # a bookmark never moves back
        bookmarks.advance(name, hi, now)
    return Outcome(lo, hi, landed, seen.untimed)
