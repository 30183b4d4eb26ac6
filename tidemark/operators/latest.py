"""Last change per key from an append-only landing."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F


def latest_per_key(df: DataFrame, on: str | Sequence[str], order: str | Sequence[str]) -> DataFrame:
    """Keep, per key, the row greatest in ``order`` (several columns break ties).

    Spark cuts each map task down to one row per key before the shuffle (the
    window group limit), so a key holding a third of the rows costs no more than another.
    """
    on = [on] if isinstance(on, str) else list(on)
    order = [order] if isinstance(order, str) else list(order)
    newest = Window.partitionBy(*on).orderBy(*[F.col(c).desc_nulls_last() for c in order])
    return df.withColumn("_rank", F.row_number().over(newest)).filter("_rank = 1").drop("_rank")
