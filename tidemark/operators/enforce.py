"""Schema enforcement and evolution on plain frames."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions.schema import align, check_assignable, evolved


def enforce_schema(df: DataFrame, wanted: T.StructType) -> DataFrame:
    """``df`` in the declared shape, or ``SchemaMismatch`` before any row is read."""
    check_assignable(df.schema, wanted)
    return align(df, wanted)


def uncastable_rows(df: DataFrame, column: str, kind: str) -> DataFrame:
    """Rows whose text in ``column`` is no ``kind``: why an append would be refused."""
    return df.filter(F.col(column).isNotNull() & F.col(column).try_cast(kind).isNull())


def append_evolve(table: DataFrame, rows: DataFrame) -> DataFrame:
    """``rows`` appended, their new columns added at the end; old rows read NULL there."""
    shape = evolved(table.schema, rows.schema)
    check_assignable(rows.schema, shape)
    return align(table, shape).unionByName(align(rows, shape))
