"""File sources. Any path Spark can open works: cloud store, volume or local folder."""

from __future__ import annotations

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions.schema import quoted
from ..session import scratch_dir

# One dialect for writing and reading: quotes are doubled, blanks belong to the text, an empty
# field is NULL and a quoted empty field is the empty text. The reader's mark for NULL is no text.
CSV_DIALECT = {"quote": '"', "escape": '"', "ignoreLeadingWhiteSpace": "false", "ignoreTrailingWhiteSpace": "false"}
CSV_READER = {**CSV_DIALECT, "nullValue": "\x00null\x00", "emptyValue": ""}
CSV_WRITER = {**CSV_DIALECT, "nullValue": "", "emptyValue": '""'}


def read_delimited(spark: SparkSession, path: str, *, header: bool = True, infer: bool = True,
                   schema: T.StructType | str | None = None, sep: str = ",",
                   multiline: bool = True) -> DataFrame:
    """CSV by content, whatever the file extension.

    Inference reads the whole input once more before the query does. Give ``schema`` on
    large inputs. ``infer=False`` leaves every column text. Quoted line breaks are read as
    such, so a file is one task's work; ``multiline=False`` splits large files that have none, and
    :func:`~tidemark.sources.csv_records.read_split_csv` those that have. ``read_inferred_once``
    infers types without reading twice.
    """
    reader = spark.read.options(**CSV_READER).option("header", header).option("sep", sep).option("multiLine", multiline)
    if schema is not None:
        return reader.schema(schema).csv(path)
    return reader.option("inferSchema", infer).csv(path)


# Types a text column may turn out to have, narrowest first, and what the text must look like. The
# pattern says what the type's reader would take; try_cast then refuses what is out of range.
_INFERRED = [("int", "^[+-]?[0-9]+$"), ("bigint", "^[+-]?[0-9]+$"), ("double", r"^[+-]?([0-9]+\.?[0-9]*|\.[0-9]+)([eE][+-]?[0-9]+)?$"),
             ("date", "^[0-9]{4}-[0-9]{2}-[0-9]{2}$"),
             ("timestamp", r"^[0-9]{4}-[0-9]{2}-[0-9]{2}([T ][0-9]{2}:[0-9]{2}(:[0-9]{2}(\.[0-9]{1,6})?)?(Z|[+-][0-9]{2}:[0-9]{2})?)?$"),
             ("boolean", "^(?i:true|false)$")]


def read_inferred_once(spark: SparkSession, path: str, *, header: bool = True, sep: str = ",", multiline: bool = True) -> DataFrame:
    """CSV with inferred types, for which the files are opened and parsed once.

    The columns are read as text and written to the scratch folder as Parquet. While that is
    written, it is counted for every column and type which values the type would refuse; the
    first type that refuses none is the column's. What is read back is columnar, and only the
    columns asked for are converted. A column without any value is text.
    """
    text = read_delimited(spark, path, header=header, infer=False, sep=sep, multiline=multiline)
    staged = f"{scratch_dir(spark, 'inferred')}/t"
    seen = Observation()
    counts = []
    for i, name in enumerate(text.columns):
        col = F.col(quoted(name))
        counts.append(F.count(col).alias(f"n{i}"))
        counts += [F.count(F.when(col.isNotNull() & ~F.coalesce(col.rlike(shape) & col.try_cast(kind).isNotNull(), F.lit(False)), 1)).alias(f"n{i}_{kind}")
                   for kind, shape in _INFERRED]
    text.observe(seen, *counts).write.parquet(staged)
    got = seen.get
    back = spark.read.schema(text.schema).parquet(staged)
    kinds = [next((k for k, _ in _INFERRED if not got[f"n{i}_{k}"]), "string") if got[f"n{i}"] else "string" for i in range(len(text.columns))]
    return back.select(*[F.col(quoted(n)).cast(k).alias(n) for n, k in zip(text.columns, kinds)])


def read_parquet_dir(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.parquet(path)


def read_json_lines(spark: SparkSession, path: str, schema: T.StructType | str | None = None) -> DataFrame:
    reader = spark.read
    if schema is not None:
        reader = reader.schema(schema)
    return reader.json(path)


def read_text_lines(spark: SparkSession, path: str) -> DataFrame:
    """One row per line in ``value``."""
    return spark.read.option("lineSep", "\n").text(path)
