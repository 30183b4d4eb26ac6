"""JDBC reads, split over tasks when bounds are known.

The driver jar of the database must be on Spark's class path. ``connection`` holds the
reader options (url, user, password, driver, fetchsize, ...); pass secrets from the
deployment, never from code.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


@dataclass(frozen=True)
class Split:
    """Reads ``parts`` ranges of a numeric, date or timestamp column in parallel."""
    column: str
    lower: str
    upper: str
    parts: int

    def options(self) -> dict[str, str]:
        return {"partitionColumn": self.column, "lowerBound": str(self.lower),
                "upperBound": str(self.upper), "numPartitions": str(self.parts)}


def as_table(sql: str, alias: str = "q") -> str:
    """A query in the form the ``dbtable`` option takes."""
    return f"({sql.strip().rstrip(';')}) {alias}"


def quoted(text: str) -> str:
    return "'" + text.replace("'", "''") + "'"


def window_predicate(column: str, lo: str | None, hi: str | None) -> str:
    """SQL text for ``lo < column <= hi``, with open ends where a bound is None."""
    parts = [f"{column} > {quoted(lo)}"] if lo is not None else []
    parts += [f"{column} <= {quoted(hi)}"] if hi is not None else []
    return " AND ".join(parts) or "1 = 1"


def high_water_sql(table: str, column: str, lo: str | None) -> str:
    """One row: greatest change time above ``lo``, how many rows, how many without a time."""
    seen = f"CASE WHEN {window_predicate(column, lo, None)} THEN {column} END"
    if lo is None:
        seen = column
    where = "" if lo is None else f" WHERE {window_predicate(column, lo, None)} OR {column} IS NULL"
    return (f"SELECT MAX({seen}) AS hi, COUNT({seen}) AS n, "
            f"COUNT(*) - COUNT({column}) AS n_null FROM {table}{where}")


def read_jdbc(spark: SparkSession, connection: dict[str, str], table: str,
              split: Split | None = None, **options) -> DataFrame:
    """A table, or a query wrapped by :func:`as_table`.

    Times without a zone stay so: bounds written from them are text in the database's own terms.
    """
    reader = spark.read.format("jdbc").option("preferTimestampNTZ", "true").options(**connection).options(**options)
    if split is not None:
        reader = reader.options(**split.options())
    return reader.option("dbtable", table).load()


def jdbc_split(spark: SparkSession, connection: dict[str, str], table: str, column: str,
               parts: int) -> Split | None:
    """Even ranges over ``column`` from one MIN/MAX query; None for an empty table."""
    sql = f"SELECT MIN({column}) AS lo, MAX({column}) AS hi FROM {table}"
    row = read_jdbc(spark, connection, as_table(sql)).select(
        F.col("lo").cast("string"), F.col("hi").cast("string")).first()
    if row is None or row[0] is None:
        return None
    return Split(column, row[0], row[1], parts)


def read_jdbc_since(spark: SparkSession, connection: dict[str, str], table: str, column: str,
                    lo: str | None, hi: str | None = None, split: Split | None = None) -> DataFrame:
    """Rows with ``lo < column <= hi``; the filter runs in the database."""
    sql = f"SELECT * FROM {table} WHERE {window_predicate(column, lo, hi)}"
    return read_jdbc(spark, connection, as_table(sql), split)
