"""File layout: inventory, compaction, z-order clustering, partitioned publishing."""

from __future__ import annotations

import json
import re
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions.schema import quoted
from ..session import hadoop_path

# fixed value: the usual target of lakehouse compaction
TARGET_FILE_BYTES = 268_435_456
# Stored bytes that one task sorts when rows are clustered; in memory they take about ten times as much.
SORT_BYTES = 64 * 1024 * 1024


def file_inventory(spark: SparkSession, paths: str | Sequence[str]) -> DataFrame:
    """Files below ``paths`` with length and time. Lists names only, opens no file."""
    paths = [paths] if isinstance(paths, str) else list(paths)
    return (spark.read.format("binaryFile").option("recursiveFileLookup", "true").load(paths)
            .select("path", "length", "modificationTime"))


def largest_file(spark: SparkSession, paths: str | Sequence[str]) -> DataFrame:
    return file_inventory(spark, paths).orderBy(F.desc("length"), "path").limit(1)


def folder_size(spark: SparkSession, path: str) -> tuple[int, int]:
    """(bytes, files) below a path, markers such as _SUCCESS included."""
    p, fs = hadoop_path(spark, path)
    summary = fs.getContentSummary(p)
    return summary.getLength(), summary.getFileCount()


def data_files(spark: SparkSession, paths: Sequence[str]) -> list[tuple[int, int, int]]:
    """(bytes, files, folders with files) of the Parquet files below each path ``.../name=value``, all of one name."""
    found = (spark.read.format("binaryFile").option("recursiveFileLookup", "true").option("pathGlobFilter", "*.parquet")
             .load(list(paths)).select("path", "length"))
    # the folder of a file is found by its own name, not by trying every folder on every file
    names = [p.rstrip("/").rpartition("/")[2] for p in paths]
    key = F.regexp_extract("path", "/(" + re.escape(names[0].partition("=")[0]) + "=[^/]*)/", 1)
    folder = F.regexp_extract("path", "^(.*)/", 1)
    sums = {r["n"]: (r["bytes"], r["files"], r["folders"]) for r in found.groupBy(key.alias("n")).agg(
        F.sum("length").alias("bytes"), F.count("*").alias("files"), F.count_distinct(folder).alias("folders")).collect()}
    return [sums.get(n, (0, 0, 0)) for n in names]


def _file_count(spark: SparkSession, path: str, target_bytes: int) -> int:
    return max(1, -(-folder_size(spark, path)[0] // target_bytes))


def read_folder(spark: SparkSession, path: str) -> tuple[DataFrame, list[str]]:
    """A Parquet folder and its partition columns, outermost first.

    Spark guesses the type of a partition column from the folder names. The guess is kept
    where every name is just what the type's value is written as, so that no value changes;
    else the column is the text of the names (``007`` stays ``007``).
    """
    found = spark.read.parquet(path).schema
    below = F.regexp_extract_all("path", F.lit("/([^/=]+=[^/]*)(?=/)"), 1)
    names = (file_inventory(spark, path).select(F.explode(F.array_distinct(below)).alias("name")).distinct()
             .select(F.substring_index("name", "=", 1).alias("column"), F.expr("substr(name, instr(name, '=') + 1)").alias("value")))
    guessed = {f.name: f.dataType for f in found}
    # folders above the path itself have such names too, but give no column of the table
    same = F.lit(True)
    for c, kind in guessed.items():
        if not isinstance(kind, (T.ArrayType, T.MapType, T.StructType, T.BinaryType)):
            text = F.col("value")
            same = F.when(F.col("column") == c, text.try_cast(kind).cast("string").eqNullSafe(text)).otherwise(same)
    missing = F.col("value") == "__HIVE_DEFAULT_PARTITION__"
    exact = {r["column"]: r["exact"] for r in names.groupBy("column").agg(F.min(missing | same).alias("exact")).collect()}
    tail = [f.name for f in found if f.name in exact]
    parts = [c for c in tail if c in found.names[len(found) - len(tail):]]
    kept = [T.StructField(f.name, T.StringType()) if f.name in parts and not exact[f.name] else f for f in found]
    return spark.read.schema(T.StructType(kept)).parquet(path), parts


def compact_files(spark: SparkSession, path: str, into: str,
                  target_bytes: int = TARGET_FILE_BYTES) -> DataFrame:
    """Rewrite a Parquet folder into files of about ``target_bytes``; partition folders stay.

    Without partitions nothing is shuffled: ``coalesce`` lets one task read several of the
    small inputs. With them, rows are gathered by partition, hot ones over several tasks.
    """
    rows, parts = read_folder(spark, path)
    shape = rows.schema
    if parts:
        rows = rows.hint("rebalance", *map(quoted, parts))
    else:
        rows = rows.coalesce(_file_count(spark, path, target_bytes))
    rows.write.mode("overwrite").partitionBy(*parts).parquet(into)
    return spark.read.schema(shape).parquet(into)


# ---------------------------------------------------------------------- z-order

_WORD = 62      # bits of a z-value in one bigint
_CUT_ROWS = 16  # sampled rows behind each cut
_CHUNK_RANKS = 1000     # quantiles of a large partition value, from which the cuts between its files are taken


def orderable(field: T.StructField) -> Column:
    """A value of a type with JSON literals that sorts like the column."""
    col, kind = F.col(f"`{field.name}`"), field.dataType
    if isinstance(kind, T.DateType):
        return F.unix_date(col)
    if isinstance(kind, T.TimestampType):
        return F.unix_micros(col)
    if isinstance(kind, T.TimestampNTZType):
        return F.timestamp_diff("MICROSECOND", F.lit("1970-01-01").cast("timestamp_ntz"), col)
    if isinstance(kind, T.BooleanType):
        return col.cast("int")
    if isinstance(kind, (T.NumericType, T.StringType)):
        return F.when(~F.isnan(col), col) if isinstance(kind, T.FractionalType) and not isinstance(kind, T.DecimalType) else col
    return col.cast("string")


def z_bits(columns: int, files: int) -> int:
    """Bits per column: cells for eight times the files, at least 16 ranges of each column."""
    return max(4, -(-(files * 8).bit_length() // columns))


def _sketch_kind(kind: T.DataType) -> str | None:
    """Which quantile sketch takes the orderable values of a type."""
    if isinstance(kind, (T.FloatType, T.DoubleType, T.DecimalType)):
        return "double"
    return "bigint" if isinstance(kind, T.IntegralType) else None


def value_cuts(values: DataFrame, bits: int) -> list[list]:
    """Quantiles of each column that cut it into ``2 ** bits`` ranges of about as many rows.

    Numbers and times give them by mergeable sketches, in one aggregate over all of them;
    nothing but the cuts reaches the driver. For other types, such as text, a sample of whole
    values is taken, which grows with the number of ranges and not with the table.
    """
    ranges = 1 << bits
    kinds = [_sketch_kind(f.dataType) for f in values.schema]
    # the error of a rank is about 1.3 % at k = 200, and falls with k
    k = min(65535, max(200, 8 * ranges))
    ranks = F.array(*[F.lit(i / ranges) for i in range(1, ranges)])
    sketch = {"bigint": (F.kll_sketch_agg_bigint, F.kll_sketch_get_quantile_bigint), "double": (F.kll_sketch_agg_double, F.kll_sketch_get_quantile_double)}
    aggregates = []
    for f, kind in zip(values.schema, kinds):
        if kind:
            col = F.col(f.name).cast(kind)
            if kind == "double":
                col = F.when(~F.isnan(col) & (F.abs(col) < float("inf")), col)
            make, quantiles = sketch[kind]
            aggregates.append(F.when(F.count(col) > 0, quantiles(make(col, F.lit(k)), ranks)).alias(f.name))
    found = values.agg(*aggregates).first() if aggregates else {}
    cuts = [list(found[f.name] or ()) if kind else [] for f, kind in zip(values.schema, kinds)]
    others = [f.name for f, kind in zip(values.schema, kinds) if not kind]
    if others:
        wanted, total = _CUT_ROWS << bits, values.count()
        texts = values.select(*others)
        sample = (texts if total <= wanted else texts.sample(min(1.0, 1.2 * wanted / total), 11)).collect()
        for i, f in enumerate(values.schema):
            if f.name in others:
                own = sorted(r[f.name] for r in sample if r[f.name] is not None)
                cuts[i] = [own[j * len(own) >> bits] for j in range(1, ranges)] if own else []
    return cuts


def z_value(df: DataFrame, columns: Sequence[str], files: int = 1, into: str = "_z") -> tuple[DataFrame, list[str]]:
    """Add bigints that together interleave the bits of each column's range id, and name them.

    A range id is the number of cuts at or below the whole value. The cuts are quantiles of
    the column's own values (:func:`value_cuts`); only the layout depends on them. A value far
    more frequent than a range takes up several cuts, so a skewed column is split as finely
    as an even one.
    """
    fields = [df.schema[c] for c in columns]
    bits = z_bits(len(fields), files)
    names = [f"_n{i}" for i in range(len(fields))]
    values = df.select(*[orderable(f).alias(n) for f, n in zip(fields, names)])
    edges = [F.from_json(F.lit(json.dumps(cuts, default=str)), f"array<{f.dataType.simpleString()}>")
             for cuts, f in zip(value_cuts(values, bits), values.schema)]
    df = df.withColumns({n: orderable(f) for f, n in zip(fields, names)})
    df = df.withColumns({f"_z{i}": F.lit(0) for i in range(len(fields))})
    for bit in reversed(range(bits)):       # bisection, one projection per bit
        df = df.withColumns({
            f"_z{i}": F.when(F.col(f"_n{i}") >= F.get(edges[i], F.col(f"_z{i}") + ((1 << bit) - 1)),
                             F.col(f"_z{i}") + (1 << bit)).otherwise(F.col(f"_z{i}"))
            for i in range(len(fields))})
    ordered = [(i, bit) for bit in reversed(range(bits)) for i in range(len(fields))]
    words = {}
    for at in range(0, len(ordered), _WORD):
        z = F.lit(0).cast("bigint")
        for i, bit in ordered[at:at + _WORD]:
            z = F.shiftleft(z, 1).bitwiseOR(F.shiftright(F.col(f"_z{i}"), bit).bitwiseAND(F.lit(1)).cast("bigint"))
        words[f"{into}_{at // _WORD}"] = z
    return df.withColumns(words).drop(*names, *[f"_z{i}" for i in range(len(fields))]), list(words)


def cluster(df: DataFrame, columns: Sequence[str], files: int, tie: Sequence[str], within: Sequence[str] = ()) -> DataFrame:
    """Range-partition by one column or by the z-value of several, inside each value of ``within``.

    ``tie`` columns differ between rows that agree on the clustering columns. They let
    the range partitioner cut through a hot value instead of giving it one task. Values of
    ``within`` are cut only when they hold more rows than one of ``files``, so that the tasks
    add no files to a partition that fits one.
    """
    if not within:
        if len(columns) == 1:
            return df.repartitionByRange(files, *columns, *tie).sortWithinPartitions(*columns)
        placed, z = z_value(df, columns, files)
        return placed.repartitionByRange(files, *z, *tie).sortWithinPartitions(*z).drop(*z)
    placed, z = z_value(df, columns, files)
    placed = _in_chunks(placed, z[0], files, tie, within)
    parts = [quoted(c) for c in within]
    # no tie here: a chunk goes to one task as a whole
    return placed.repartitionByRange(files, *parts, "_chunk").sortWithinPartitions(*parts, "_chunk", *z).drop("_chunk", *z)


def _in_chunks(df: DataFrame, z: str, files: int, tie: Sequence[str], within: Sequence[str]) -> DataFrame:
    """Add ``_chunk``: 0 for values of ``within`` that fit one file, else ranges of ``z`` of about a file's rows.

    Rows of a ``z`` that takes up several chunks are dealt over them by ``tie``.
    """
    counts = df.groupBy(*map(quoted, within)).agg(F.count("*").alias("_n"))
    total = counts.agg(F.sum("_n")).first()[0] if files > 1 else 0
    large = counts.filter(F.col("_n") * files > total).select(
        *[F.col(quoted(c)).alias(f"_w{i}") for i, c in enumerate(within)], F.ceil(F.col("_n") * files / F.lit(total or 1)).cast("int").alias("_k"))
    if not total or large.isEmpty():
        return df.withColumn("_chunk", F.lit(0))
    same = F.lit(True)
    for i, c in enumerate(within):
        same = same & F.col(f"_w{i}").eqNullSafe(F.col(quoted(c)))
    keys = [f"_w{i}" for i in range(len(within))]
    # at most a row for each file: the cuts of a large value, thinned out of one list of quantiles
    ranks = F.array(*[F.lit(i / _CHUNK_RANKS) for i in range(1, _CHUNK_RANKS)])
    cuts = df.join(F.broadcast(large), same).groupBy(*keys, "_k").agg(F.percentile_approx(F.col(z), ranks, F.lit(10_000)).alias("_q")).select(
        *keys, F.transform(F.sequence(F.lit(1), F.col("_k") - 1), lambda i: F.get("_q", F.floor(i * _CHUNK_RANKS / F.col("_k")).cast("int") - 1)).alias("_cuts"))
    low = F.size(F.filter("_cuts", lambda x: x < F.col(z)))
    high = F.size(F.filter("_cuts", lambda x: x <= F.col(z)))
    chunk = F.when(F.col("_cuts").isNull(), 0).otherwise(low + F.pmod(F.xxhash64(*tie), high - low + 1).cast("int"))
    return df.join(F.broadcast(cuts), same, "left_outer").withColumn("_chunk", chunk).drop(*keys, "_cuts")


def zorder_layout(spark: SparkSession, path: str, into: str, columns: Sequence[str],
                  target_bytes: int = TARGET_FILE_BYTES) -> DataFrame:
    """Rewrite a Parquet folder clustered by ``columns``; partition folders stay, ties break by row position."""
    files = _file_count(spark, path, min(target_bytes, SORT_BYTES))
    rows, parts = read_folder(spark, path)
    shape = rows.schema
    placed = rows.select("*", F.xxhash64("_metadata.file_path", "_metadata.row_index").alias("_tie"))
    cluster(placed, columns, files, ["_tie"], parts).drop("_tie").write.mode("overwrite").partitionBy(*parts).parquet(into)
    return spark.read.schema(shape).parquet(into)


def refuse_empty_text(df: DataFrame, partition_by: Sequence[str]) -> DataFrame:
    """Fail on an empty text in a partition column: as a folder name it would come back as NULL."""
    text = [c for c in partition_by if isinstance(df.schema[c].dataType, T.StringType)]
    return df.withColumns({c: F.when(F.col(f"`{c}`") == "", F.raise_error(F.lit(f"empty text in partition column {c}")))
                           .otherwise(F.col(f"`{c}`")) for c in text})


def publish_partitioned(df: DataFrame, path: str, partition_by: Sequence[str],
                        mode: str = "overwrite") -> DataFrame:
    """Write partition folders with few files each, hot partitions split over tasks."""
    refuse_empty_text(df, partition_by).hint("rebalance", *partition_by).write.mode(mode).partitionBy(
        *partition_by).parquet(path)
    # the types of the folders' values are known: inference would turn the text '007' into 7
    shape = [f for f in df.schema if f.name not in partition_by] + [df.schema[c] for c in partition_by]
    return df.sparkSession.read.schema(T.StructType(shape)).parquet(path)


def partition_counts(df: DataFrame, *columns: str | Column) -> DataFrame:
    return df.groupBy(*columns).agg(F.count("*").alias("cnt"))
