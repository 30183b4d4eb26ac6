"""Difference of two frames, as sets or as bags.

Both sides are tagged, stacked and grouped by all columns: one shuffle with map-side
combine. A row with millions of copies reaches the shuffle as one row per task, and
no join is needed, so there is nothing to skew.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.schema import quoted

# A row is emitted in slices of this many copies, so no task has to write a hot row alone.
COPIES_PER_SLICE = 10_000


def set_minus(left: DataFrame, right: DataFrame) -> DataFrame:
    """Distinct rows of ``left`` that ``right`` does not have (NULL equals NULL)."""
    cols = [*map(quoted, left.columns)]
    both = left.withColumn("_in_right", F.lit(0)).unionByName(
        right.select(*cols).withColumn("_in_right", F.lit(1)))
    # a row seen only on the left has the maximum tag 0
    return both.groupBy(*cols).agg(F.max("_in_right").alias("_in_right")).filter(
        "_in_right = 0").select(*cols)


def repeat_rows(df: DataFrame, times: str) -> DataFrame:
    """Each row ``times`` times over, hot rows spread over many tasks."""
    cols = [quoted(c) for c in df.columns if c != times]
    few = df.filter(F.col(times) <= COPIES_PER_SLICE).select(
        *cols, F.explode(F.sequence(F.lit(1), F.col(times))).alias("_copy"))
    slices = df.filter(F.col(times) > COPIES_PER_SLICE).select(
        *cols, times, F.explode(F.sequence(
            F.lit(0), F.floor((F.col(times) - 1) / COPIES_PER_SLICE))).alias("_slice"))
    share = F.least(F.lit(COPIES_PER_SLICE).cast("bigint"),
                    F.col(times) - F.col("_slice") * COPIES_PER_SLICE)
    # a stated number of partitions: the adaptive planner would merge these few small rows
    # back into one task, which then had to write all the copies
    spark = df.sparkSession
    tasks = max(int(spark.conf.get("spark.sql.shuffle.partitions")), spark.sparkContext.defaultParallelism)
    many = slices.withColumn("_share", share).repartition(tasks, *cols, "_slice").select(
        *cols, F.explode(F.sequence(F.lit(1).cast("bigint"), F.col("_share"))).alias("_copy"))
    return few.select(*cols).unionByName(many.select(*cols))


def bag_minus(left: DataFrame, right: DataFrame) -> DataFrame:
    """Rows of ``left`` less those of ``right``, copy by copy."""
    cols = [*map(quoted, left.columns)]
    both = left.withColumn("_n", F.lit(1).cast("bigint")).unionByName(
        right.select(*cols).withColumn("_n", F.lit(-1).cast("bigint")))
    counted = both.groupBy(*cols).agg(F.sum("_n").alias("_n")).filter("_n > 0")
    return repeat_rows(counted, "_n")
