"""NOT NULL and CHECK rules on rows.

A rule that comes out NULL counts as broken, as a stored constraint does in a
lakehouse table; ``null_passes`` gives the reading of standard SQL instead.
"""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..errors import ConstraintViolation


def _broken(rule: str | Column, null_passes: bool) -> Column:
    cond = F.expr(rule) if isinstance(rule, str) else rule
    return ~F.coalesce(cond, F.lit(null_passes))


def broken_rules(checks: dict[str, str | Column], not_null: Iterable[str] = (),
                 null_passes: bool = False) -> Column:
    """Names of the rules a row breaks, as an array."""
    names = [F.when(F.col(c).isNull(), F.lit(f"{c} NOT NULL")) for c in not_null]
    names += [F.when(_broken(r, null_passes), F.lit(n)) for n, r in checks.items()]
    return F.array_compact(F.array(*names)) if names else F.array().cast("array<string>")


def constraint_violations(df: DataFrame, checks: dict[str, str | Column],
                          not_null: Iterable[str] = (), null_passes: bool = False) -> DataFrame:
    """The refused rows with the names of the rules they break in ``violated``."""
    return df.withColumn("violated", broken_rules(checks, not_null, null_passes)).filter(
        F.size("violated") > 0)


def check_constraints(df: DataFrame, checks: dict[str, str | Column],
                      not_null: Iterable[str] = (), null_passes: bool = False,
                      on_violation: str = "split") -> DataFrame:
    """The rows that keep every rule; ``on_violation="raise"`` refuses the whole frame."""
    if on_violation == "raise":
        if not constraint_violations(df, checks, not_null, null_passes).isEmpty():
            raise ConstraintViolation(f"rows break one of {list(not_null) + list(checks)}")
        return df
    if on_violation != "split":
        raise ValueError("on_violation is 'split' or 'raise'")
    return df.filter(F.size(broken_rules(checks, not_null, null_passes)) == 0)


def guarded(column: Column, checks: dict[str, str], not_null: Iterable[str],
            null_passes: bool, only_if: Column | None = None) -> Column:
    """``column``, unless the row breaks a rule: then the running write fails.

    The check rides along with the write, so it costs no pass of its own.
    """
    if not checks and not not_null:
        return column
    broken = broken_rules(checks, not_null, null_passes)
    refuse = F.size(broken) > 0
    if only_if is not None:
        refuse = only_if & refuse
    message = F.concat(F.lit("CONSTRAINT_VIOLATED: "), F.array_join(broken, ", "))
    return F.when(refuse, F.raise_error(message).cast("int")).otherwise(column)


def amount_consistent(quantity: str = "quantity", price: str = "price", amount: str = "amount",
                      tolerance: float = 0.005) -> str:
    """The rule ``amount = quantity * price`` with room for double rounding."""
    return f"abs({amount} - {quantity} * {price}) <= {tolerance}"
