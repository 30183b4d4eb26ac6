"""Which keys two copies of a table do not share, found by checksums of key ranges.

Both sides are cut into the same ranges of the key. Where count and checksum of a range agree
its rows are not looked at again; a range that differs is cut again, until it is narrow. Only
then are its rows read and compared. A source that lost a few rows is thus read as sums, by
queries its own engine can answer, and in a few narrow ranges.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass
from functools import reduce
from operator import or_

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.schema import quoted
from .diff import set_minus

FANOUT = 64             # parts a differing range is cut into
NARROW = 1024           # keys in a range that is read as it is
MOST_RANGES = 256       # differing ranges beyond which cutting them further would not save reading


@dataclass(frozen=True)
class KeyDifference:
    only_left: DataFrame
    only_right: DataFrame
    ranges: list[tuple[int, int]]       # closed key ranges that were read and compared


def _inside(key: Column, ranges: Sequence[tuple[int, int]]) -> Column:
    return reduce(or_, [(key >= lo) & (key <= hi) for lo, hi in ranges], F.lit(False))


def _sums(df: DataFrame, key: str, columns: Sequence[str], ranges: Sequence[tuple[int, int]], width: int) -> DataFrame:
    """Rows and checksum of each part of ``ranges``: parts begin at multiples of ``width``. Map-side combined."""
    col = F.col(quoted(key))
    part = col - F.pmod(col, F.lit(width))
    rows = df.filter(_inside(col, ranges)).select(part.cast("bigint").alias("part"), F.xxhash64(*map(quoted, columns)).cast("decimal(38,0)").alias("h"))
    return rows.groupBy("part").agg(F.count("*").alias("n"), F.sum("h").alias("h"))


def key_difference(left: DataFrame, right: DataFrame, key: str, columns: Sequence[str] | None = None,
                   fanout: int = FANOUT, narrow: int = NARROW) -> KeyDifference:
    """Rows of each side (``columns``, the key alone by default) that the other does not have.

    ``key`` is a whole number on both sides. Rows with a NULL key are compared as they are.
    Equal checksums of 64-bit hash sums are taken for equal rows. Copies of a row count in the
    checksums, but a row both sides have is in no result, however often. Every level costs one
    aggregate per side; what comes back are the parts that differ, at most ``fanout`` times
    ``MOST_RANGES`` rows.
    """
    columns = [key, *(c for c in columns or () if c != key)]
    left, right = (d.select(*map(quoted, columns)) for d in (left, right))
    col = F.col(quoted(key))
    bounds = [d.agg(F.min(col).cast("bigint"), F.max(col).cast("bigint")).first() for d in (left, right)]
    known = [b for b in bounds if b[0] is not None]
    ranges: list[tuple[int, int]] = []
    if known:
        lo, hi = min(b[0] for b in known), max(b[1] for b in known)
        ranges, width = [(lo, hi)], hi - lo + 1
        while width > narrow and len(ranges) <= MOST_RANGES:
            width = max(1, -(-width // fanout))
            one, other = (_sums(d, key, columns, ranges, width) for d in (left, right))
            both = one.withColumnsRenamed({"n": "n1", "h": "h1"}).join(other.withColumnsRenamed({"n": "n2", "h": "h2"}), "part", "full")
            differ = both.filter(~(F.col("n1").eqNullSafe(F.col("n2")) & F.col("h1").eqNullSafe(F.col("h2"))))
            parts = sorted(r["part"] for r in differ.select("part").collect())
            ranges = [(max(p, lo), min(p + width - 1, hi)) for p in parts]
            if not ranges:
                break
    wanted = _inside(col, ranges) | col.isNull()
    mine, theirs = left.filter(wanted), right.filter(wanted)
    return KeyDifference(set_minus(mine, theirs), set_minus(theirs, mine), ranges)
