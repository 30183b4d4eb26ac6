"""What the operators share: staged tables, spreading small inputs, Arrow columns as Python lists."""

from __future__ import annotations

import contextlib
import hashlib
from collections.abc import Iterator
from pathlib import Path

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..session import hadoop_path, scratch_dir


# Rows go to Python in batches of 10000 by Spark's default, whatever their size. A batch is held
# several times over: as vectors and as a message in the executor, as both again in Python.
BATCH_BYTES = 4 << 20
BATCH_SETTING = "spark.sql.execution.arrow.maxBytesPerBatch"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


@contextlib.contextmanager
def small_batches(spark: SparkSession) -> Iterator[None]:
    """Jobs run here send Python batches of about BATCH_BYTES, or of one larger row; a limit that the session sets stays."""
    if BATCH_SETTING in spark.conf.getAll:
        yield
        return
    spark.conf.set(BATCH_SETTING, BATCH_BYTES)
    try:
        yield
    finally:
        spark.conf.unset(BATCH_SETTING)


def staged(df: DataFrame, label: str) -> DataFrame:
    """``df`` written to the shared scratch folder and read again: lineage ends here."""
    path = f"{scratch_dir(df.sparkSession, label)}/t"
    df.write.parquet(path)
    out = df.sparkSession.read.schema(df.schema).parquet(path)
    out.staged_at = path
    return out


def staged_in_small_batches(df: DataFrame, label: str) -> DataFrame:
    """Like :func:`staged`, for rows that are large or bring long texts."""
    with small_batches(df.sparkSession):
        return staged(df, label)


def release(*tables: DataFrame) -> None:
    """Delete staged tables that nothing reads any more; what was made of them is staged itself."""
    for df in tables:
        path, fs = hadoop_path(df.sparkSession, df.staged_at)
        fs.delete(path, True)


def importable(spark: SparkSession) -> None:
    """Let Python workers import this package from where the driver has it, also outside PYTHONPATH."""
    root, env = str(Path(__file__).resolve().parents[2]), spark.sparkContext.environment
    if root not in env.get("PYTHONPATH", "").split(":"):
        env["PYTHONPATH"] = ":".join(filter(None, [root, env.get("PYTHONPATH")]))


def spread(df: DataFrame) -> DataFrame:
    """Give every core a share of an input of fewer partitions than cores.

    A larger input is left as it is read; then this costs no shuffle.
    """
    importable(df.sparkSession)
    cores = df.sparkSession.sparkContext.defaultParallelism
    return df if df.rdd.getNumPartitions() >= cores else df.repartition(cores)


def spread_files(df: DataFrame) -> DataFrame:
    """Like :func:`spread`, by the number of files that ``df`` is read from."""
    cores = df.sparkSession.sparkContext.defaultParallelism
    return df.repartition(cores) if 0 < len(df.inputFiles()) < cores else df


def id_text(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Id and text alone, so that no other column can clash with an operator's own."""
    return docs.select(F.col(quoted(id_col)).alias("doc_id"), F.col(quoted(text_col)).cast("string").alias("text"))


def quoted(name: str) -> str:
    return "`" + name.replace("`", "``") + "`"


def free_name(columns: list[str], name: str) -> str:
    """``name``, with underscores added until it clashes with none of ``columns`` in either case."""
    taken = {c.lower() for c in columns}
    while name.lower() in taken:
        name += "_"
    return name


def crc_mod(col: Column, m: int) -> Column:
    """The CRC-32 of a value as text, modulo ``m``; null for null."""
    return F.crc32(col.cast("string").cast("binary")) % m


def texts(batch: pa.RecordBatch, name: str = "text") -> list[str]:
    """A text column as strings; null counts as empty."""
    return [x or "" for x in batch.column(name).to_pylist()]


def sha256_hex(data: bytes) -> str:
    return hashlib.sha256(data).hexdigest()
