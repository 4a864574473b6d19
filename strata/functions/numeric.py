"""Deterministic numeric helpers.

Money columns carry two decimals; averages and shares of them land exactly on
half points (x.xx5) often enough that "round the double" differs between
engines.  These helpers round in exact integer arithmetic (decimal(38,0) and
integral division; half away from zero), identical everywhere.  Sums of cents are
decimal(38,0), so they neither overflow a bigint nor depend on the order of rows.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

_D = "decimal(38,0)"


#: type of cent amounts and of their sums
CENTS = "decimal(38,0)"


def cents(c: Column) -> Column:
    """Two-decimal money value as an exact whole number of cents."""
    return F.round(c * 100).cast("decimal(28,0)")


def money_sum(c: Column) -> Column:
    """Exact sum of a two-decimal column (aggregate); null without values."""
    return F.sum(cents(c)).cast("double") / F.lit(100.0)


def ratio_round(num: Column, den: Column, scale: int) -> Column:
    """round(num / den, scale), half away from zero, for integer num/den ≥ 0 den.

    Null when den is 0 or null.
    """
    m = 10 ** scale
    a = F.abs(num).cast(_D)
    d = F.nullif(den, F.lit(0)).cast(_D)
    q = F.call_function("div", a * F.lit(2 * m).cast(_D) + d, d * F.lit(2).cast(_D))
    return F.signum(num) * q / F.lit(float(m))


def money_avg(c: Column, scale: int = 2) -> Column:
    """Exact mean of a two-decimal column rounded to ``scale`` (≥2) decimals (aggregate)."""
    if scale < 2:
        raise ValueError("scale must be >= 2")
    return ratio_round(F.sum(cents(c)), F.count(c) * 100, scale)


def int_avg(c: Column, scale: int) -> Column:
    """Exact mean of an integer column rounded to ``scale`` decimals (aggregate)."""
    return ratio_round(F.sum(c.cast("bigint")), F.count(c), scale)
