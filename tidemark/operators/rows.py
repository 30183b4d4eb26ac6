"""UPDATE and DELETE on a frame: a predicate that is NULL leaves the row alone."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.schema import quoted


def condition(predicate: Column | str) -> Column:
    return F.expr(predicate) if isinstance(predicate, str) else predicate


def value(v) -> Column:
    """A Column stays as it is, anything else is a literal."""
    return v if isinstance(v, Column) else F.lit(v)


def holds(predicate: Column | str) -> Column:
    """TRUE only where the predicate is TRUE, never NULL."""
    return F.coalesce(condition(predicate), F.lit(False))


def update_where(df: DataFrame, predicate: Column | str, assign: dict) -> DataFrame:
    """Set columns of the rows that satisfy ``predicate``.

    All right-hand sides see the row as it was. The result keeps the column types.
    """
    unknown = set(assign) - set(df.columns)
    if unknown:
        raise ValueError(f"no such column: {sorted(unknown)}")
    hit = holds(predicate)
    return df.select(*[
        F.when(hit, value(assign[f.name]).cast(f.dataType)).otherwise(F.col(quoted(f.name))).alias(f.name)
        if f.name in assign else F.col(quoted(f.name))
        for f in df.schema])


def delete_where(df: DataFrame, predicate: Column | str) -> DataFrame:
    """Drop the rows that satisfy ``predicate``."""
    p = condition(predicate)
    return df.filter(~p | p.isNull())


def active_rows(df: DataFrame, deleted_flag: str) -> DataFrame:
    """Rows not soft-deleted; an unset flag counts as active."""
    return df.filter(~F.coalesce(F.col(deleted_flag).cast("boolean"), F.lit(False)))
