"""Which rows may go into which declared columns.

The rules are those of ANSI store assignment in Spark: widening and numeric
narrowing are allowed (an overflow fails while writing), anything may become text,
dates and timestamps convert, but text never turns into a number by itself.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..errors import SchemaMismatch


def quoted(name: str) -> str:
    """A column name that may hold dots or backticks, as text for ``select`` or ``col``."""
    return "`" + name.replace("`", "``") + "`"


def by_name(schema: T.StructType) -> dict[str, T.StructField]:
    """Columns by lower-case name; names that differ in case only are refused, as Spark does."""
    out = {f.name.lower(): f for f in schema}
    if len(out) != len(schema):
        raise SchemaMismatch(f"column names repeat in {schema.names}")
    return out


_TIMES = (T.DateType, T.TimestampType, T.TimestampNTZType)


def fits(given: T.DataType, wanted: T.DataType) -> bool:
    """Whether a value of type ``given`` may be stored as ``wanted``."""
    if given == wanted or isinstance(given, T.NullType):
        return True
    if isinstance(given, T.NumericType) and isinstance(wanted, T.NumericType):
        return True
    if isinstance(given, _TIMES) and isinstance(wanted, _TIMES):
        return True
    if isinstance(wanted, T.StringType):
        return isinstance(given, T.AtomicType)
    if isinstance(given, T.ArrayType) and isinstance(wanted, T.ArrayType):
        return fits(given.elementType, wanted.elementType)
    if isinstance(given, T.MapType) and isinstance(wanted, T.MapType):
        return fits(given.keyType, wanted.keyType) and fits(given.valueType, wanted.valueType)
    if isinstance(given, T.StructType) and isinstance(wanted, T.StructType):
        return len(given) == len(wanted) and all(
            g.name == w.name and fits(g.dataType, w.dataType) for g, w in zip(given, wanted))
    return False


def check_assignable(given: T.StructType, wanted: T.StructType) -> None:
    """Raise :class:`SchemaMismatch` unless ``given`` may be appended to ``wanted``."""
    known = by_name(wanted)
    for name, field in by_name(given).items():
        if name not in known:
            raise SchemaMismatch(f"column {field.name} is not in the table")
        if not fits(field.dataType, known[name].dataType):
            raise SchemaMismatch(
                f"column {field.name}: {field.dataType.simpleString()} cannot be stored as "
                f"{known[name].dataType.simpleString()}")


def evolved(wanted: T.StructType, given: T.StructType) -> T.StructType:
    """``wanted`` with the new columns of ``given`` added, nullable, at the end."""
    known = by_name(wanted)
    extra = [T.StructField(f.name, f.dataType, True) for name, f in by_name(given).items() if name not in known]
    return T.StructType(list(wanted) + extra)


def align(df: DataFrame, wanted: T.StructType) -> DataFrame:
    """Cast and order ``df`` by name into ``wanted``; missing columns become NULL."""
    if [(f.name, f.dataType) for f in df.schema] == [(f.name, f.dataType) for f in wanted]:
        return df
    have = by_name(df.schema)
    out = []
    for field in wanted:
        own = have.get(field.name.lower())
        if own is None:
            out.append(F.lit(None).cast(field.dataType).alias(field.name))
        elif own.dataType == field.dataType:
            out.append(F.col(quoted(field.name)).alias(field.name))
        else:
            out.append(F.col(quoted(field.name)).cast(field.dataType).alias(field.name))
    return df.select(*out)


def add_missing(df: DataFrame, columns: dict[str, str]) -> DataFrame:
    """Add each absent column of ``columns`` (name to type) as NULL."""
    return df.withColumns({
        name: F.lit(None).cast(kind) for name, kind in columns.items() if name not in df.columns})
