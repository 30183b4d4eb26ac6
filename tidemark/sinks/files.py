"""File sinks and the landing of extracted rows."""

from __future__ import annotations

import hashlib
import re
from collections.abc import Sequence
from datetime import datetime

from pyspark.sql import DataFrame, Observation
from pyspark.sql import functions as F

from ..functions.columns import stamp_ingest
from ..session import hadoop_path
from ..sources.files import CSV_WRITER


def write_delimited(df: DataFrame, path: str, *, mode: str = "overwrite", header: bool = True,
                    single_file: bool = False) -> None:
    """CSV folder. ``single_file`` funnels everything through one task: small results only."""
    out = df.coalesce(1) if single_file else df
    out.write.mode(mode).options(**CSV_WRITER).option("header", header).csv(path)


def write_parquet(df: DataFrame, path: str, *, mode: str = "overwrite",
                  partition_by: Sequence[str] = ()) -> None:
    df.write.mode(mode).partitionBy(*partition_by).parquet(path)


def write_json(df: DataFrame, path: str, *, mode: str = "overwrite") -> None:
    df.write.mode(mode).json(path)


def land_increment(df: DataFrame, path: str, *, fmt: str = "parquet", batch: str | None = None,
                   at: datetime | None = None, header: bool = True, known_rows: bool = False) -> int:
    """Append one batch below ``ingest_date=...``; returns the rows written.

    ``batch`` is kept as ``batch_id``, so that a batch landed twice after a crash can be
    told apart. Nothing is written for an empty batch; ``known_rows`` spares the look for a
    first row when the caller knows that there is one. The rows are counted while they are
    written, so the source is read once.
    """
    if fmt not in ("parquet", "csv"):
        raise ValueError("fmt is 'parquet' or 'csv'")
    if not known_rows and df.isEmpty():
        return 0
    seen = Observation()
    stamped = stamp_ingest(df, at)
    if batch is not None:
        stamped = stamped.withColumn("batch_id", F.lit(batch))
    writer = (stamped.observe(seen, F.count(F.lit(1)).alias("n"))
              .write.mode("append").partitionBy("ingest_date"))
    if fmt == "csv":
        writer.options(**CSV_WRITER).option("header", header).csv(path)
    else:
        writer.parquet(path)
    return seen.get["n"]


def batch_folder(batch: str) -> str:
    """A folder name for a batch: readable, safe on any file system, different for different batches."""
    return f"{re.sub('[^A-Za-z0-9]+', '-', batch).strip('-')[:48]}-{hashlib.sha256(batch.encode()).hexdigest()[:12]}"


def land_batch(df: DataFrame, path: str, batch: str, *, fmt: str = "parquet", at: datetime | None = None,
               header: bool = True, batch_id: str | None = None) -> int:
    """Land a batch in a folder of its own, in the place of what was landed under its name before.

    The rows go to ``ingest_date=.../batch=...`` by dynamic partition overwrite, so a batch
    that is landed again, after a crash or on purpose, leaves one copy and no other batch is
    touched. It keeps the date of its first landing, by which the folder is found again; the
    exact time is in ``ingested_at``. Nothing is written for an empty batch, and nothing is
    taken away. ``batch_id`` is kept in a column where given. Returns the rows written.
    """
    if fmt not in ("parquet", "csv"):
        raise ValueError("fmt is 'parquet' or 'csv'")
    spark, folder = df.sparkSession, batch_folder(batch)
    pattern, fs = hadoop_path(spark, f"{path}/ingest_date=*/batch={folder}")
    before = sorted(s.getPath().getParent().getName().partition("=")[2] for s in fs.globStatus(pattern) or ())
    seen = Observation()
    stamped = stamp_ingest(df, at).withColumn("batch", F.lit(folder))
    if batch_id is not None:
        stamped = stamped.withColumn("batch_id", F.lit(batch_id))
    if before:
        stamped = stamped.withColumn("ingest_date", F.lit(before[0]).cast("date"))
    writer = (stamped.observe(seen, F.count(F.lit(1)).alias("n")).write.mode("overwrite")
              .option("partitionOverwriteMode", "dynamic").partitionBy("ingest_date", "batch"))
    if fmt == "csv":
        writer.options(**CSV_WRITER).option("header", header).csv(path)
    else:
        writer.parquet(path)
    return seen.get["n"]
