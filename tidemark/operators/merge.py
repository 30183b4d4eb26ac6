"""MERGE: update the matched rows, insert the source rows that match nothing.

Rules: a NULL key matches nothing, so such source rows are inserted; a matched row
whose extra condition is not TRUE stays as it is and is not inserted; two source rows
on one target row are an error; neither side needs a unique key otherwise.

Shape of the plans, with a target far larger than the source:

* One aggregate over the source alone gives its exact size, tells whether any key
  repeats, and gives the ranges its keys lie in. The target is looked at for repeats only when
  there are any, and is always read within those ranges, which reach its scan.
* A source of checked small size is broadcast, so the target streams past it without
  a shuffle. Beyond the limit both sides shuffle on the key. Matching is an inner or a
  left outer join with the target on the left, the shapes whose hot target partition
  the adaptive skew join can split; a full outer join could not be split.
* Inserts are found against target keys that are de-duplicated on the map side first, so a key
  that fills a third of the target arrives as one row per task.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass, field
from functools import reduce
from operator import or_

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..errors import MergeCardinalityError
from ..functions.schema import quoted
from .latest import latest_per_key
from .sizes import Size, row_bytes

_HIT = "_hit"


def _keys(on: str | Sequence[str]) -> list[str]:
    return [on] if isinstance(on, str) else list(on)


def _all_set(on: list[str]) -> Column:
    out = F.lit(True)
    for k in on:
        out = out & F.col(quoted(k)).isNotNull()
    return out


def _same_key(on: list[str]) -> Column:
    out = F.lit(True)
    for k in on:
        out = out & (F.col(f"t.{quoted(k)}") == F.col(f"s.{quoted(k)}"))
    return out


@dataclass(frozen=True)
class Source:
    """A merge source that has been measured and found free of double matches."""
    rows: DataFrame
    on: list[str]
    size: Size
    ranges: dict[str, list[tuple]] = field(default_factory=dict)    # key column -> closed ranges that hold its values

    def may_match(self, target: DataFrame) -> DataFrame:
        """``target`` within the key ranges of the source: a filter that reaches the scan."""
        for c, ranges in self.ranges.items():
            kind = target.schema[c].dataType
            if kind == self.rows.schema[c].dataType:
                col = F.col(quoted(c))
                target = target.filter(reduce(or_, [(col >= _bound(lo, kind)) & (col <= _bound(hi, kind)) for lo, hi in ranges], F.lit(False)))
        return target

    @property
    def maybe_broadcast(self) -> DataFrame:
        return F.broadcast(self.rows) if self.size.broadcastable else self.rows


def _bound(value, kind: T.DataType) -> Column:
    """A collected bound as a literal; instants are kept as microseconds, which no time zone changes."""
    return F.timestamp_micros(F.lit(value)) if isinstance(kind, T.TimestampType) else F.lit(value).cast(kind)


def _ranged(source: DataFrame, on: list[str]) -> list[T.StructField]:
    """Key columns of a type that has ranges worth a filter."""
    kinds = (T.IntegralType, T.DateType, T.TimestampType)
    return [f for f in (source.schema[c] for c in on) if isinstance(f.dataType, kinds) or f.dataType == T.StringType()]


def _magnitude(fields: list[T.StructField]) -> Column:
    """A number of a row's first whole-number key by sign and length, so that far-off keys stand apart."""
    for f in fields:
        if isinstance(f.dataType, T.IntegralType):
            col = F.col(quoted(f.name)).cast("double")
            return F.when(col.isNotNull(), (F.signum(col) * F.floor(F.log2(F.abs(col) + 1) + 1)).cast("int"))
    return F.lit(0)


def _joined(ranges: list[tuple], step: int | None) -> list[tuple]:
    """Ranges in order, those that touch or overlap as one."""
    out: list[tuple] = []
    for lo, hi in sorted(ranges):
        if out and (lo <= out[-1][1] or step and lo <= out[-1][1] + step):
            out[-1] = (out[-1][0], max(out[-1][1], hi))
        else:
            out.append((lo, hi))
    return out


def checked_source(target: DataFrame, source: DataFrame, on: str | Sequence[str]) -> Source:
    """Measure ``source`` and refuse it if two of its rows match one target row."""
    on = _keys(on)
    width = row_bytes(source.schema)
    per_key = source.groupBy(*map(quoted, on)).agg(
        F.count("*").alias("n"),
        F.sum(width if width is not None else F.lit(0)).alias("b"))
    ranged = _ranged(source, on)
    values = {f.name: F.unix_micros(F.col(quoted(f.name))) if isinstance(f.dataType, T.TimestampType) else F.col(quoted(f.name)) for f in ranged}
    # a row for each magnitude of the key, at most 129: its least and greatest key make one range
    parts = per_key.filter(_all_set(on)).groupBy(_magnitude(ranged).alias("m")).agg(
        F.sum("n").alias("rows"), F.sum("b").alias("bytes"), F.max("n").alias("most"),
        *[f(v).alias(f"{name}{i}") for i, v in enumerate(values.values()) for f, name in ((F.min, "lo"), (F.max, "hi"))])
    unset = per_key.filter(~_all_set(on)).agg(F.lit(None).cast("int").alias("m"), F.sum("n").alias("rows"), F.sum("b").alias("bytes"), F.lit(0).cast("long").alias("most"),
                                              *[F.lit(None).cast(parts.schema[f"{name}{i}"].dataType).alias(f"{name}{i}") for i in range(len(values)) for name in ("lo", "hi")])
    found = parts.unionByName(unset).collect()
    rows, size = (sum(r[c] or 0 for r in found) for c in ("rows", "bytes"))
    ranges = {f.name: _joined([(r[f"lo{i}"], r[f"hi{i}"]) for r in found if r[f"lo{i}"] is not None], 1 if isinstance(f.dataType, T.IntegralType) else None)
              for i, f in enumerate(ranged)}
    if max((r["most"] for r in found), default=0) > 1:
        repeated = per_key.filter((F.col("n") > 1) & _all_set(on)).select(*map(quoted, on))
        if not target.select(*map(quoted, on)).join(repeated, on, "left_semi").isEmpty():
            raise MergeCardinalityError(f"several source rows match one target row on {on}")
    return Source(source, on, Size(rows, None if width is None else size), ranges)


def newest_per_key(source: DataFrame, on: str | Sequence[str], order: str | Sequence[str]) -> DataFrame:
    """One row per key, the greatest in ``order``; rows with a NULL in the key stay, for they match nothing."""
    on = _keys(on)
    return latest_per_key(source.filter(_all_set(on)), on, order).unionByName(source.filter(~_all_set(on)))


def unmatched(target: DataFrame, source: Source) -> DataFrame:
    """Source rows whose key is not in the target (NULL keys included).

    Written as an outer join that keeps the rows without a partner: Spark pushes an anti
    join below a union in the source, and would then scan the target once per branch.
    """
    keys = source.may_match(target.select(*map(quoted, source.on)))
    rows = source.rows
    if source.size.broadcastable:
        # reduce the target to the few keys the source asks for, without a shuffle
        keys = keys.join(F.broadcast(rows.select(*map(quoted, source.on))), source.on, "left_semi")
    else:
        # NULL keys never match: keep them out of the shuffle, where they would share a partition
        rows = rows.filter(_all_set(source.on))
    partner = keys.distinct().withColumn(_HIT, F.lit(True))
    new = rows.join(partner, source.on, "left_outer").filter(F.col(_HIT).isNull()).select(*map(quoted, rows.columns))
    if source.size.broadcastable:
        return new
    return new.unionByName(source.rows.filter(~_all_set(source.on)))


def matched_pairs(target: DataFrame, source: Source, matched_when: str | None) -> DataFrame:
    """``t``/``s`` pairs to update. Refer to columns as ``t.x`` and ``s.x``."""
    pairs = source.may_match(target).alias("t").join(source.maybe_broadcast.alias("s"), _same_key(source.on), "inner")
    return pairs if matched_when is None else pairs.filter(F.expr(matched_when))


def matched_addresses(target: DataFrame, source: Source, matched_when: str | None, address: list[str]) -> DataFrame:
    """The key and address of every matched target row, and whether it is to be updated (``_hit``).

    For a source too large to broadcast: staged, it gives updates and inserts by joins with
    the source alone, so the target is read and shuffled once.
    """
    hit = F.lit(True) if matched_when is None else F.coalesce(F.expr(matched_when), F.lit(False))
    pairs = source.may_match(target).alias("t").join(source.rows.alias("s"), _same_key(source.on), "inner")
    return pairs.select(*[F.col(f"t.{quoted(c)}").alias(c) for c in [*source.on, *address]], hit.alias(_HIT))


def merge_upsert(target: DataFrame, source: DataFrame, on: str | Sequence[str],
                 matched_when: str | None = None) -> DataFrame:
    """The whole table after the merge. ``source`` must have the columns of ``target``.

    Further columns of the source take part in ``matched_when`` only.
    """
    own = {c.lower() for c in target.columns}
    more = [c for c in source.columns if c.lower() not in own] if matched_when is not None else []
    src = checked_source(target, source.select(*map(quoted, [*target.columns, *more])), on)
    flagged = src.maybe_broadcast.withColumn(_HIT, F.lit(True))
    hit = F.col(f"s.{_HIT}")
    if matched_when is not None:
        hit = hit & F.expr(matched_when)
    kept = target.alias("t").join(flagged.alias("s"), _same_key(src.on), "left_outer").select(*[
        F.when(F.coalesce(hit, F.lit(False)), F.col(f"s.{quoted(f.name)}").cast(f.dataType))
        .otherwise(F.col(f"t.{quoted(f.name)}")).alias(f.name) for f in target.schema])
    return kept.unionByName(unmatched(target, src).select(*map(quoted, target.columns)))


def merge_newer_wins(target: DataFrame, source: DataFrame, on: str | Sequence[str],
                     order: str) -> DataFrame:
    """Upsert in which a matched row is replaced only by a strictly newer one."""
    return merge_upsert(target, source, on, f"s.{order} > t.{order}")
