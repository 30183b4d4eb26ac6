"""Exact size of a frame, measured before anything is broadcast."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions.schema import quoted

# A side is broadcast only below both limits; above them the join shuffles.
BROADCAST_ROWS = 1_000_000
BROADCAST_BYTES = 64 * 1024 * 1024

_FIXED = (T.NumericType, T.BooleanType, T.DateType, T.TimestampType, T.TimestampNTZType)


@dataclass(frozen=True)
class Size:
    rows: int
    bytes: int | None      # None: a nested column, whose width is not measured

    @property
    def broadcastable(self) -> bool:
        return (self.bytes is not None and self.rows <= BROADCAST_ROWS
                and self.bytes <= BROADCAST_BYTES)


def row_bytes(schema: T.StructType):
    """Bytes of one row as a Column, or None when a column has no measurable width."""
    fixed, parts = 8, []
    for field in schema:
        if isinstance(field.dataType, _FIXED):
            fixed += 16
        elif isinstance(field.dataType, (T.StringType, T.BinaryType)):
            fixed += 16
            parts.append(F.coalesce(F.octet_length(quoted(field.name)).cast("bigint"), F.lit(0)))
        else:
            return None
    total = F.lit(fixed).cast("bigint")
    for part in parts:
        total = total + part
    return total
