"""Zone maps: the least and greatest value of columns in every file, to read only files that can matter.

A map is one aggregate over the columns named, grouped by the file a row lies in, and is kept
as a small Parquet table next to the files it tells about. A lookup takes from it the files
whose ranges meet the one asked for and opens no other; what it reads is filtered as always,
so a stale map can cost rows only where files were changed in place, which nothing here does.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.schema import quoted
from .layout import read_folder


def file_zones(rows: DataFrame, columns: Sequence[str]) -> DataFrame:
    """file, rows and for each column <column>_min, <column>_max, <column>_nulls, for frames read from files.

    One pass over the named columns; a task holds one row per file it reads, so the shuffle
    carries a row per file and task. NaN is the greatest number, as in comparisons.
    """
    facts = [F.count("*").alias("rows")]
    for c in columns:
        col = F.col(quoted(c))
        facts += [F.min(col).alias(f"{c}_min"), F.max(col).alias(f"{c}_max"), F.count(F.when(col.isNull(), 1)).alias(f"{c}_nulls")]
    return rows.groupBy(F.col("_metadata.file_path").alias("file")).agg(*facts)


@dataclass(frozen=True)
class Chosen:
    rows: DataFrame
    files: int          # files that are opened
    of: int             # files in the map


class ZoneMap:
    """The zones of a Parquet folder, written at ``at`` once and read from there."""

    def __init__(self, spark: SparkSession, path: str, at: str):
        self.spark, self.path, self.at = spark, path.rstrip("/"), at

    @classmethod
    def build(cls, spark: SparkSession, path: str, at: str, columns: Sequence[str]) -> ZoneMap:
        out = cls(spark, path, at)
        rows, _ = read_folder(spark, path)
        file_zones(rows, columns).write.mode("overwrite").parquet(at)
        return out

    def zones(self) -> DataFrame:
        return self.spark.read.parquet(self.at)

    def between(self, **ranges: tuple) -> Chosen:
        """Rows with each named column in its closed range (lo, hi); None is no bound.

        Only names of files are collected, no more than Spark itself lists to plan a read.
        """
        zones, rows = self.zones(), read_folder(self.spark, self.path)[0]
        hit = wanted = F.lit(True)
        for c, (lo, hi) in ranges.items():
            col, kind = F.col(quoted(c)), rows.schema[c].dataType
            if lo is not None:
                bound = F.lit(lo).cast(kind)
                hit, wanted = hit & (F.col(quoted(f"{c}_max")) >= bound), wanted & (col >= bound)
            if hi is not None:
                bound = F.lit(hi).cast(kind)
                hit, wanted = hit & (F.col(quoted(f"{c}_min")) <= bound), wanted & (col <= bound)
        files = [r["file"] for r in zones.filter(hit).select("file").collect()]
        if files:
            found = self.spark.read.schema(rows.schema).option("basePath", self.path).parquet(*files)
        else:
            found = rows.limit(0)
        return Chosen(found.filter(wanted), len(files), zones.count())
