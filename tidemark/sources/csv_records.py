"""CSV with line breaks inside quotes, read by as many tasks as the file has splits.

With quotes doubled inside quotes, a line break ends a record exactly where the number of
quote marks before it in the file is even. One narrow pass counts the marks of every split;
their running sum over a file tells each split whether it begins inside a quoted field. Then
every split puts its own records together. Only the pieces of records that cross a split
travel: they are gathered by the split in which their record began.
"""

from __future__ import annotations

from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.window import Window

from ..functions.schema import quoted
from .files import CSV_READER

_PIECES = "file string, block bigint, n bigint, place int, record string"
_WHOLE, _HEAD, _TAIL = 0, 1, 2      # a record of the split, what belongs to one begun before, one that goes on
BATCH_CHARS = 4 << 20


def _lines(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.option("lineSep", "\n").text(path).select(
        F.col("_metadata.file_path").alias("file"), F.col("_metadata.file_block_start").alias("block"), "value")


def _split_parity(lines: DataFrame) -> DataFrame:
    """file, block, inside: whether the split begins within quotes. A row per split."""
    marks = F.length("value") - F.length(F.translate("value", '"', ""))
    blocks = lines.groupBy("file", "block").agg(F.sum(marks).alias("marks"))
    before = Window.partitionBy("file").orderBy("block").rowsBetween(Window.unboundedPreceding, -1)
    return blocks.select("file", "block", (F.pmod(F.coalesce(F.sum("marks").over(before), F.lit(0)), F.lit(2)) == 1).alias("inside"))


def csv_records(spark: SparkSession, path: str) -> DataFrame:
    """file, block, n, record: the text of every record, whole, without its line break.

    ``block`` and ``n`` say in which split it begins, and as which record there. Blank records
    are left out. A quote that is never closed makes the rest of its file one record, as it
    does for any reader.
    """
    lines = _lines(spark, path)
    parity = _split_parity(lines)
    def gather(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        at, held, open_, place, n = None, [], False, _WHOLE, 0
        out: list[tuple] = []
        size = 0

        def put(last: bool) -> None:
            nonlocal held, place, size, n
            text = "\n".join(held)
            out.append((*at, n, _HEAD if place == _HEAD else _TAIL if last and open_ else _WHOLE, text))
            size += len(text)
            held, place, n = [], _WHOLE, n + 1

        def flushed() -> pa.RecordBatch:
            nonlocal out, size
            columns, out, size = list(zip(*out)), [], 0
            return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, (pa.string(), pa.int64(), pa.int64(), pa.int32(), pa.string()))],
                                              ["file", "block", "n", "place", "record"])

        for batch in batches:
            for file, block, value, inside in zip(*(batch.column(c).to_pylist() for c in ("file", "block", "value", "inside"))):
                if (file, block) != at:
                    if held:
                        put(True)
                    at, open_, n = (file, block), inside, 0
                    place = _HEAD if inside else _WHOLE
                held.append(value)
                if value.count('"') % 2:
                    open_ = not open_
                if not open_:
                    put(False)
                if size >= BATCH_CHARS:
                    yield flushed()
        if held:
            put(True)
        if out:
            yield flushed()

    # the lines keep their order in the task that reads their split, so the parity is brought to them:
    # a row per split, of which the driver holds a list to plan the read
    told = lines.join(F.broadcast(parity), ["file", "block"]).select("file", "block", "value", "inside")
    pieces = told.mapInArrow(gather, _PIECES)
    whole = pieces.filter(F.col("place") == _WHOLE).select("file", "block", "n", "record")
    # at most two a split: what came in belongs to the last record that was left open before
    before = Window.partitionBy("file").orderBy("block", "place").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    crossing = pieces.filter(F.col("place") != _WHOLE).withColumn("home", F.last(F.when(F.col("place") == _TAIL, F.col("block")), ignorenulls=True).over(before))
    parts = crossing.groupBy("file", "home").agg(F.sort_array(F.collect_list(F.struct("block", "n", "record"))).alias("parts"))
    joined = parts.select("file", F.col("home").alias("block"), F.col("parts")[0]["n"].alias("n"),
                          F.array_join(F.transform("parts", lambda p: p["record"]), "\n").alias("record"))
    return whole.unionByName(joined).withColumn("record", F.regexp_replace("record", "\r$", "")).filter(F.length("record") > 0)


def read_split_csv(spark: SparkSession, path: str, schema: T.StructType | str | None = None, *, header: bool = True,
                   sep: str = ",") -> DataFrame:
    """CSV whose quoted fields may hold line breaks, in the library's dialect, one task per split.

    Without a schema the columns are text, named as in the header. The order of the rows is
    not kept.
    """
    if schema is None:
        names = spark.read.options(**CSV_READER).option("header", header).option("sep", sep).csv(path).columns
        schema = T.StructType([T.StructField(n, T.StringType()) for n in names])
    elif isinstance(schema, str):
        schema = T.StructType.fromDDL(schema)
    records = csv_records(spark, path)
    if header:
        records = records.filter((F.col("block") > 0) | (F.col("n") > 0))
    ddl = ", ".join(f"{quoted(f.name)} {f.dataType.simpleString()}" for f in schema)
    return records.select(F.from_csv("record", ddl, {**CSV_READER, "sep": sep}).alias("row")).select("row.*")
