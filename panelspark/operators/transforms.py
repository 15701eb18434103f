"""Robust column transforms: winsorize, truncate, standardize, n-tiles and quantile bins.

Statistics come from exact, distributed aggregates (``quantiles``) and return as one
row per group, joined back. No unpartitioned window ever touches the data rows.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from panelspark.operators.quantiles import QSpec, null_safe, quantiles, rank_rows


def _attach(df: DataFrame, stats: DataFrame, by: list[str]) -> DataFrame:
    """``stats`` (one row per group) beside the rows of its group, NULL being a group like any other.
    Without groups it is one row; with groups AQE picks broadcast or shuffle from the real size."""
    if not by:
        return df.crossJoin(F.broadcast(stats))
    keys = [f"_by{i}" for i in range(len(by))]
    stats = stats.select(*[F.col(b).alias(k) for b, k in zip(by, keys)], *[c for c in stats.columns if c not in by])
    return df.join(stats, null_safe(by, keys), how="left").drop(*keys)


def cut_points(df: DataFrame, cols: list[str], lower: float | None, upper: float | None,
               rule: str | tuple[str, str] = ("lower", "higher"), by: list[str] | None = None) -> DataFrame:
    """Per group: ``{col}__lo`` / ``{col}__hi`` = quantiles at ``lower`` / ``upper``."""
    r_lo, r_hi = (rule, rule) if isinstance(rule, str) else rule
    specs = []
    for c in cols:
        if lower is not None:
            specs.append(QSpec(c, float(lower), r_lo, f"{c}__lo"))
        if upper is not None:
            specs.append(QSpec(c, float(upper), r_hi, f"{c}__hi"))
    return quantiles(df, specs, by)


def winsorize(df: DataFrame, cols: list[str] | str, lower: float | None = 0.01, upper: float | None = 0.99,
              rule: str | tuple[str, str] = ("lower", "higher"), by: list[str] | None = None) -> DataFrame:
    """Clip each column to its own quantile cuts; NULLs stay NULL.

    Python reference: ``rule=("lower", "higher")`` at (0.01, 0.99). R reference
    ``winsorize_x(x, cuts=c(a, b))``: ``rule="type2", lower=a, upper=1-b``; pass ``None``
    for a one-sided cut.
    """
    cols = [cols] if isinstance(cols, str) else list(cols)
    by = list(by or [])
    out = _attach(df, cut_points(df, cols, lower, upper, rule, by), by)
    repl = {}
    for c in cols:
        v = F.col(c)
        if upper is not None:
            v = F.when(v >= F.col(f"{c}__hi"), F.col(f"{c}__hi")).otherwise(v)
        if lower is not None:
            v = F.when(v <= F.col(f"{c}__lo"), F.col(f"{c}__lo")).otherwise(v)
        # least/greatest would turn a NULL into the cut: keep NULLs explicitly
        repl[c] = F.when(F.col(c).isNull(), F.lit(None)).otherwise(v).cast(df.schema[c].dataType)
    helpers = [f"{c}__{s}" for c in cols for s in ("lo", "hi") if f"{c}__{s}" in out.columns]
    return out.withColumns(repl).select(*df.columns)


def truncate(df: DataFrame, cols: list[str] | str, lower: float | None = 0.01, upper: float | None = 0.99,
             rule: str | tuple[str, str] = "type2", by: list[str] | None = None) -> DataFrame:
    """Set values at or beyond the cuts to NULL (the cut values themselves too, T10)."""
    cols = [cols] if isinstance(cols, str) else list(cols)
    by = list(by or [])
    out = _attach(df, cut_points(df, cols, lower, upper, rule, by), by)
    repl = {}
    for c in cols:
        drop = F.lit(False)
        if upper is not None:
            drop = drop | (F.col(c) >= F.col(f"{c}__hi"))
        if lower is not None:
            drop = drop | (F.col(c) <= F.col(f"{c}__lo"))
        repl[c] = F.when(F.coalesce(drop, F.lit(False)), F.lit(None)).otherwise(F.col(c)).cast(df.schema[c].dataType)
    return out.withColumns(repl).select(*df.columns)


def standardize(df: DataFrame, cols: list[str] | str, by: list[str] | None = None,
                suffix: str = "") -> DataFrame:
    """(x - mean) / sample sd over non-NULL values; one aggregate joined back."""
    cols = [cols] if isinstance(cols, str) else list(cols)
    by = list(by or [])
    aggs = []
    for c in cols:
        aggs += [F.avg(c).alias(f"{c}__mu"), F.stddev_samp(c).alias(f"{c}__sd")]
    stats = df.groupBy(*by).agg(*aggs) if by else df.agg(*aggs)
    out = _attach(df, stats, by)
    new = {f"{c}{suffix}": F.try_divide(F.col(c) - F.col(f"{c}__mu"), F.col(f"{c}__sd")) for c in cols}
    return out.withColumns(new).select(*df.columns, *[k for k in new if k not in df.columns])


def ntile(df: DataFrame, col: str, n: int, out: str, by: list[str] | None = None,
          tiebreak: list[str] | None = None) -> DataFrame:
    """Rank-based n-tiles (dplyr ``ntile`` / SQL NTILE): the first ``len % n`` bins get one
    extra row; NULL values get a NULL bin. Ties are broken by ``tiebreak`` (W5)."""
    by = list(by or [])
    valid = df.filter(F.col(col).isNotNull())
    ranked = rank_rows(valid, [col, *(tiebreak or [])], by=by, rank="_r", size="_len")
    r, ln = F.col("_r"), F.col("_len")
    larger = ln % n
    lsize = F.ceil(ln / n)
    ssize = F.floor(ln / n)
    thresh = lsize * larger
    bin_ = F.when(r <= thresh, F.floor((r + lsize - 1) / lsize)).otherwise(
        F.floor((r - thresh + ssize - 1) / ssize) + larger).cast("int")
    binned = ranked.withColumn(out, bin_).select(*df.columns, out)
    nulls = df.filter(F.col(col).isNull()).withColumn(out, F.lit(None).cast("int"))
    return binned.unionByName(nulls)


def qcut(df: DataFrame, col: str, n: int, out: str, by: list[str] | None = None,
         rule: str = "linear") -> DataFrame:
    """Quantile-break bins 1..n (polars ``qcut``): breaks at i/n, right-closed bins;
    NULL values get NULL (W6)."""
    by = list(by or [])
    specs = [QSpec(col, i / n, rule, f"_brk{i}") for i in range(1, n)]
    brk = quantiles(df, specs, by)
    withb = _attach(df, brk, by)
    above = sum((F.col(col) > F.col(f"_brk{i}")).cast("int") for i in range(1, n))
    return withb.withColumn(out, F.when(F.col(col).isNotNull(), (F.lit(1) + above).cast("int"))).select(
        *df.columns, out)
