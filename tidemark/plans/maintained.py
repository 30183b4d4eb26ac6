"""Counts and sums of a versioned table, kept up to date from what changed."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions.schema import quoted
from ..session import hadoop_path
from .change_table import ChangeTable


class MaintainedCounts:
    """Rows (``cnt``) and sums of whole-number or decimal columns by group, stored below ``path``.

    :meth:`refresh` adds the signed counts of the rows that came and went since the stored
    version, so it reads the change sets in between and the stored groups, not the table.
    Inserts, updates, deletes, merges and restores all are such rows; after an overwrite both
    versions are read whole. Sums of floating point numbers are refused, for what is taken
    off again would leave rounding behind. A group without rows is no longer there.
    """

    def __init__(self, table: ChangeTable, path: str, by: Sequence[str], sums: Sequence[str] = ()):
        for c in sums:
            if not isinstance(table.schema[c].dataType, (T.IntegralType, T.DecimalType)):
                raise TypeError(f"sums of {c} cannot be kept exactly")
        self.table, self.path, self.by, self.sums = table, path.rstrip("/"), list(by), list(sums)

    def versions(self) -> list[int]:
        p, fs = hadoop_path(self.table.spark, f"{self.path}/version=*/_SUCCESS")
        return sorted(int(s.getPath().getParent().getName().partition("=")[2]) for s in fs.globStatus(p) or ())

    def stored(self) -> DataFrame:
        """The groups as last refreshed."""
        return self.table.spark.read.parquet(f"{self.path}/version={self.versions()[-1]}")

    def _signed(self, rows: DataFrame, sign: int) -> DataFrame:
        return rows.select(*map(quoted, self.by), F.lit(sign).cast("bigint").alias("cnt"), *[
            (F.col(quoted(c)) * sign).cast("decimal(38,%d)" % getattr(self.table.schema[c].dataType, "scale", 0)).alias(f"sum_{c}") for c in self.sums])

    def refresh(self) -> DataFrame:
        """Bring the stored groups to the table's latest version and read them."""
        self.table.refresh()
        known, now = self.versions(), self.table.version
        if known and known[-1] == now:
            return self.stored()
        if known:
            came, went = self.table.changed_rows(known[-1], now)
            parts = self.stored().unionByName(self._signed(came, 1)).unionByName(self._signed(went, -1))
        else:
            parts = self._signed(self.table.current(), 1)
        groups = parts.groupBy(*map(quoted, self.by)).agg(
            F.sum("cnt").alias("cnt"), *[F.sum(f"sum_{c}").cast(parts.schema[f"sum_{c}"].dataType).alias(f"sum_{c}") for c in self.sums])
        groups.filter("cnt <> 0").write.mode("overwrite").parquet(f"{self.path}/version={now}")
        return self.stored()
