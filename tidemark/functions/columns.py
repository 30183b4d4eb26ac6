"""Column helpers of the extract and bronze steps."""

from __future__ import annotations

import re
from collections.abc import Sequence
from datetime import datetime

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T


def derive_amount(df: DataFrame, quantity: str = "quantity", price: str = "price",
                  into: str = "amount") -> DataFrame:
    """Add quantity x price as a double."""
    return df.withColumn(into, F.col(quantity).cast("double") * F.col(price).cast("double"))


def stamp_ingest(df: DataFrame, at: datetime | None = None) -> DataFrame:
    """Add ``ingested_at`` and the ``ingest_date`` it falls on.

    Pass ``at`` when a batch is scanned by more than one job: ``current_timestamp`` is
    fixed per job only, so two jobs would stamp the same row differently.
    """
    stamp = F.current_timestamp() if at is None else F.lit(at).cast("timestamp")
    return df.withColumn("ingested_at", stamp).withColumn("ingest_date", F.to_date("ingested_at"))


def parse_times(df: DataFrame, dates: Sequence[str] = (), timestamps: Sequence[str] = (),
                strict: bool = True) -> DataFrame:
    """Turn text columns into dates and timestamps.

    Text that is no time fails the query when ``strict``, else it becomes NULL.
    """
    to = (lambda c, kind: c.cast(kind)) if strict else (lambda c, kind: c.try_cast(kind))
    return df.withColumns({c: to(F.col(c), "date") for c in dates}
                          | {c: to(F.col(c), "timestamp") for c in timestamps})


def fill_default(df: DataFrame, column: str, default) -> DataFrame:
    """NULL becomes ``default``; a column that is missing altogether counts as NULL."""
    if column not in df.columns:
        return df.withColumn(column, F.lit(default))
    return df.withColumn(column, F.coalesce(F.col(column), F.lit(default)))


def bookmark_text(value: Column, kind: T.DataType | None = None) -> Column:
    """A change time as bookmark text. Keeps microseconds, drops a zero fraction.

    A timestamp (an instant) is written in UTC with its offset, whatever the time zone of
    the session; a timestamp without zone and any other type is its plain text.
    """
    if isinstance(kind, T.TimestampType):
        start = F.lit("1970-01-01 00:00:00").cast("timestamp_ntz")
        return F.concat(F.timestamp_add("MICROSECOND", F.unix_micros(value), start).cast("string"), F.lit(UTC))
    return value.cast("string")


UTC = "+00:00"


def bookmark_value(text: str, kind: T.DataType) -> Column:
    """The literal of a column's type for bookmark text. An instant without an offset is UTC."""
    if isinstance(kind, T.TimestampType) and not re.search(r"([+-]\d\d:?\d\d|Z)$", text):
        text += UTC if ":" in text else " 00:00:00" + UTC
    return F.lit(text).cast(kind)
