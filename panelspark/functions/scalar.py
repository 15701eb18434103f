"""Scalar column builders used by the panel variables and the report tables."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def col(c: str | Column) -> Column:
    return F.col(c) if isinstance(c, str) else c


def same_sign(a: str | Column, b: str | Column) -> Column:
    """1 if sign(a) == sign(b) (two zeros count as equal), 0 otherwise, NULL if either is NULL."""
    return (F.signum(col(a)) == F.signum(col(b))).cast("int")


def flag(cond: Column) -> Column:
    """Boolean -> 0/1, NULL stays NULL."""
    return cond.cast("int")


def safe_div(a: str | Column, b: str | Column) -> Column:
    """Division that yields NULL for a zero or NULL divisor instead of raising under ANSI."""
    return F.try_divide(col(a), col(b))


def is_finite(c: str | Column) -> Column:
    """Not NULL, not NaN, not +-inf."""
    x = col(c)
    return x.isNotNull() & ~F.isnan(x) & (F.abs(x) < F.lit(float("inf")))


def sic2(sic: str | Column) -> Column:
    """Two-digit SIC: floor(sic / 100)."""
    return F.floor(col(sic) / 100).cast("int")


def keep_industries(sic: str | Column) -> Column:
    """Known SIC outside financials (SIC2 60-69) and utilities (SIC2 49)."""
    s2 = sic2(sic)
    return col(sic).isNotNull() & ~s2.between(60, 69) & (s2 != 49)


def thousands(c: str | Column) -> Column:
    """Integer with thousands separators, e.g. 12,345."""
    return F.format_number(col(c).cast("double"), 0)


def paren_thousands(c: str | Column) -> Column:
    """"(12,345)" or the empty string for NULL."""
    return F.when(col(c).isNull(), F.lit("")).otherwise(F.concat(F.lit("("), thousands(c), F.lit(")")))


def percent(c: str | Column, decimals: int = 2) -> Column:
    """Share as a percent string with ``decimals`` places, e.g. 41.27%."""
    return F.concat(F.format_number(col(c) * 100, decimals), F.lit("%"))


def fixed(c: str | Column, decimals: int = 3) -> Column:
    """Fixed decimals, e.g. 0.123."""
    return F.format_number(col(c), decimals)


def decade_label(year: str | Column) -> Column:
    """Decade bucket of a year: "1970 - 1979" ... "2010 - 2019", "2020+"; NULL before 1970."""
    y = col(year)
    lab = F.lit(None).cast("string")
    for start in (2010, 2000, 1990, 1980, 1970):
        lab = F.when(y.between(start, start + 9), F.lit(f"{start} - {start + 9}")).otherwise(lab)
    return F.when(y >= 2020, F.lit("2020+")).otherwise(lab)


def group_label(*cols: str | Column, sep: str = " / ") -> Column:
    """Join labels into one group name, e.g. "Positive SUE / Same Sign" (X16)."""
    return F.concat_ws(sep, *[col(c) for c in cols])
