"""Catalog tables: managed (dropping deletes the files) and external (files stay)."""

from __future__ import annotations

from collections.abc import Iterable, Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions.schema import quoted


def create_schema(spark: SparkSession, name: str) -> None:
    spark.sql(f"CREATE SCHEMA IF NOT EXISTS {name}")


def create_managed(df: DataFrame, name: str, *, partition_by: Sequence[str] = ()) -> DataFrame:
    df.write.format("parquet").mode("overwrite").partitionBy(*partition_by).saveAsTable(name)
    return df.sparkSession.table(name)


def register_external(spark: SparkSession, name: str, path: str, fmt: str = "parquet",
                      schema: T.StructType | None = None, partition_by: Sequence[str] = (), **options) -> DataFrame:
    """Name the files at ``path``. Partition folders below it are found again.

    Give ``schema`` (and ``partition_by``) where the text of folder names would be taken for
    another type, such as the text 007 for a number.
    """
    given = {"path": path, **{k: str(v) for k, v in options.items()}}
    listed = ", ".join(f"'{k}' '{v}'" for k, v in given.items())
    columns = "" if schema is None else "(" + ", ".join(f"{quoted(f.name)} {f.dataType.simpleString()}" for f in schema) + ") "
    parts = f" PARTITIONED BY ({', '.join(map(quoted, partition_by))})" if schema is not None and partition_by else ""
    spark.sql(f"CREATE TABLE {name} {columns}USING {fmt} OPTIONS ({listed}){parts}")
    if any(c.isPartition for c in spark.catalog.listColumns(name)):
        spark.sql(f"ALTER TABLE {name} RECOVER PARTITIONS")
    return spark.table(name)


def drop_table(spark: SparkSession, name: str) -> None:
    spark.sql(f"DROP TABLE IF EXISTS {name}")


def describe_kv(spark: SparkSession, name: str, keys: Iterable[str]) -> DataFrame:
    """Chosen entries of the table description as (key, value)."""
    entry = F.trim("col_name")
    return (spark.sql(f"DESCRIBE EXTENDED {name}").filter(entry.isin(list(keys)))
            .select(entry.alias("key"), F.col("data_type").alias("value")))
