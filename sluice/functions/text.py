"""Text column helpers shared by the report and prompt builders."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from sluice.functions.numeric import int_div


def fixed_text(x: Column, digits: int) -> Column:
    """Fixed-point text of a double with ``digits`` decimals (like ``f"{x:.{d}f}"``).

    Rounds ``|x| * 10^d + 0.5`` down in double arithmetic, which every IEEE engine
    computes identically, then prints the integer units; no locale, no exponent.
    """
    scale = 10 ** digits
    units = F.floor(F.abs(x) * F.lit(float(scale)) + F.lit(0.5)).cast("bigint")
    sign = F.when(x < 0, F.lit("-")).otherwise(F.lit(""))
    if digits == 0:
        return F.concat(sign, units.cast("string"))
    frac = F.lpad(F.pmod(units, F.lit(scale)).cast("string"), digits, "0")
    return F.concat(sign, int_div(units, F.lit(scale)).cast("string"), F.lit("."), frac)


def fixed_text_sql(x: str, digits: int) -> str:
    scale = 10 ** digits
    units = f"CAST(floor(abs({x}) * CAST({scale} AS DOUBLE) + 0.5) AS BIGINT)"
    sign = f"CASE WHEN {x} < 0 THEN '-' ELSE '' END"
    if digits == 0:
        return f"({sign} || CAST({units} AS VARCHAR))"
    return (f"({sign} || CAST({units} // {scale} AS VARCHAR) || '.' || "
            f"lpad(CAST({units} % {scale} AS VARCHAR), {digits}, '0'))")
