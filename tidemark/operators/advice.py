"""Which column to partition a table by, estimated before anything is written."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.schema import quoted
from .layout import TARGET_FILE_BYTES
from .sizes import row_bytes

HEAVY = 4096            # values the heavy-hitter sketch keeps count of
LEAST_FILE_SHARE = 1 / 8    # of the target size; folders below it make more files than bytes are worth


def partition_advice(df: DataFrame, candidates: Sequence[str], target_bytes: int = TARGET_FILE_BYTES,
                     error: float = 0.01) -> DataFrame:
    """One row per candidate column: candidate, folders, hot_share, folder_bytes, rows, advised.

    One pass and one row per task: distinct values by a HyperLogLog sketch of the relative
    ``error``, the most frequent value by a heavy-hitter sketch, the bytes from the widths of
    the rows as they are in memory (files come out smaller by their compression). NULL is a
    folder of its own. ``advised`` is the column of most folders whose mean is at least an
    eighth of ``target_bytes``; where none is, it is no column, for partitions would only make
    small files. A frame with a nested column has no width: give ``df`` without it.
    """
    width = row_bytes(df.schema)
    if width is None:
        raise TypeError("leave out nested columns: their width is not measured")
    facts = [F.count("*").alias("rows"), F.coalesce(F.sum(width), F.lit(0)).alias("bytes")]
    for i, c in enumerate(candidates):
        col = F.col(quoted(c)).cast("string")
        facts += [F.approx_count_distinct(col, error).alias(f"d{i}"), F.max(col.isNull().cast("long")).alias(f"null{i}"), F.sum(col.isNull().cast("long")).alias(f"nulls{i}"),
                  F.call_function("approx_top_k", col, F.lit(1), F.lit(HEAVY)).alias(f"top{i}")]
    found = df.agg(*facts)
    per_column = F.array(*[F.struct(
        F.lit(c).alias("candidate"), (F.col(f"d{i}") + F.coalesce(F.col(f"null{i}"), F.lit(0))).alias("folders"),
        F.greatest(F.coalesce(F.get(f"top{i}", F.lit(0))["count"], F.lit(0)), F.coalesce(F.col(f"nulls{i}"), F.lit(0))).alias("hot"))
        for i, c in enumerate(candidates)])
    out = found.select("rows", "bytes", F.explode(per_column).alias("c")).select(
        "c.candidate", "c.folders", F.try_divide(F.col("c.hot"), F.col("rows")).alias("hot_share"), F.try_divide(F.col("bytes"), F.col("c.folders")).alias("folder_bytes"), "rows")
    good = F.coalesce(F.col("folder_bytes"), F.lit(0)) >= target_bytes * LEAST_FILE_SHARE
    rows = out.withColumn("good", good).collect()       # one row per candidate
    best = max((r for r in rows if r["good"]), key=lambda r: (r["folders"], r["candidate"]), default=None)
    advised = F.lit(False) if best is None else F.col("candidate") == best["candidate"]
    return df.sparkSession.createDataFrame(rows, out.withColumn("good", good).schema).drop("good").withColumn("advised", advised)
