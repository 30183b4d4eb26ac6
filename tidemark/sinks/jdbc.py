"""JDBC sink."""

from __future__ import annotations

from pyspark.sql import DataFrame


def write_jdbc(df: DataFrame, connection: dict[str, str], table: str, *, mode: str = "overwrite",
               keep_definition: bool = True, **options) -> None:
    """Write a frame to a database table.

    ``df`` must not read the table it overwrites: the overwrite empties it before the
    rows are computed. ``keep_definition`` empties the table in place of dropping it, so
    that its keys and column types survive.
    """
    (df.write.format("jdbc").options(**connection).options(**options)
     .option("dbtable", table).option("truncate", str(keep_definition).lower())
     .mode(mode).save())
