"""Exact rounding helpers: round a ratio of integers half away from zero.

Rounding a double (``round(avg(x) / 1000.0, 1)``) depends on the binary value and on
the engine's rounding of the decimal text; rounding the exact ratio of integer sums
does not, so results are the same on any partitioning and in any engine.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


WIDE = "decimal(38,0)"


def _c(x) -> Column:
    if isinstance(x, Column):
        return x
    return F.col(x) if isinstance(x, str) else F.lit(x)


def _whole_div(a: Column, b: Column) -> Column:
    """Floor division of a non-negative whole number by a positive one, in decimals of 38 digits."""
    a, b = a.cast(WIDE), b.cast(WIDE)
    return ((a - F.pmod(a, b)) / b).cast(WIDE)


def int_div(a, b) -> Column:
    """Exact floor division of a non-negative integer by a positive one (BIGINT)."""
    return _whole_div(_c(a), _c(b)).cast("bigint")


def _rounded(num, den) -> Column:
    n, d = _c(num).cast(WIDE), _c(den).cast(WIDE)
    mag = _whole_div(F.abs(n) * 2 + d, d * 2)
    return F.when(n < 0, -mag).otherwise(mag)


def round_ratio_units(num, den) -> Column:
    """``round(num / den)`` as BIGINT, half away from zero; ``den`` > 0, both whole numbers."""
    return _rounded(num, den).cast("bigint")


def round_ratio(num, den, scale: int) -> Column:
    """``round(num / den, scale)`` as DOUBLE, computed exactly from whole numbers of up to 38 digits in between."""
    factor = 10 ** scale
    return _rounded(_c(num).cast(WIDE) * F.lit(factor), den).cast("double") / F.lit(float(factor))


def round_ratio_sql(num: str, den: str, scale: int) -> str:
    """DuckDB twin of ``round_ratio`` (``//`` on non-negative integers is exact)."""
    factor = 10 ** scale
    n = f"(CAST({num} AS HUGEINT) * {factor})"
    d = f"CAST({den} AS HUGEINT)"
    mag = f"((abs({n}) * 2 + {d}) // ({d} * 2))"
    return f"(CAST(CASE WHEN {n} < 0 THEN -{mag} ELSE {mag} END AS DOUBLE) / CAST({factor} AS DOUBLE))"
