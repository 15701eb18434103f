"""Period-key lags (J3, J4) and gaps in months.

Lags are looked up by explicit fiscal keys, not by position, so reporting gaps never
shift a value onto the wrong quarter. The lookup side is de-duplicated with ``distinct``,
whose partial aggregation collapses repeated rows before any shuffle (a key holding a
third of the rows never travels whole to one task); the join then shuffles only the
de-duplicated lookup, and AQE splits a skewed key on the panel side.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def prior_quarter_keys(year: str, qtr: str) -> tuple[Column, Column]:
    """(lag_fyear, lag_fqtr): Q1 wraps to Q4 of the previous year."""
    lag_q = F.when(F.col(qtr) == 1, F.lit(4)).otherwise(F.col(qtr) - 1).cast("int")
    lag_y = F.when(F.col(qtr) == 1, F.col(year) - 1).otherwise(F.col(year)).cast("int")
    return lag_y, lag_q


def period_lookup(df: DataFrame, lookup: DataFrame, entity: str, year: str, qtr: str,
                  values: dict[str, str], periods_back: int = 1, null_safe: bool = False,
                  key_names: tuple[str, str] | None = None) -> DataFrame:
    """Left-join values of the period ``periods_back`` quarters earlier (1 = prior quarter,
    4 = same quarter last year) from ``lookup`` on (entity, year, quarter).

    ``values`` maps lookup column -> output name. Derived key columns are added to the
    output (``lag_fyear``/``lag_fqtr`` for 1, ``lag4_fyearq`` for 4, or ``key_names``).
    ``null_safe=True`` matches NULL keys to each other (dplyr joins), default SQL semantics.
    """
    if periods_back == 1:
        ky, kq = key_names or ("lag_fyear", "lag_fqtr")
        lag_y, lag_q = prior_quarter_keys(year, qtr)
        out = df.withColumns({ky: lag_y, kq: lag_q})
    elif periods_back == 4:
        ky, kq = (key_names or ("lag4_fyearq", qtr))
        out = df.withColumn(ky, (F.col(year) - 1).cast("int"))
    else:
        raise ValueError("periods_back must be 1 or 4")
    lk = [f"_lk_{entity}", f"_lk_{year}", f"_lk_{qtr}"]
    look = (lookup.select(F.col(entity).alias(lk[0]), F.col(year).alias(lk[1]), F.col(qtr).alias(lk[2]),
                          *[F.col(src).alias(dst) for src, dst in values.items()])
            .distinct())
    lkeys = [entity, ky, kq]
    cond = None
    for a, b in zip(lkeys, lk):
        c = out[a].eqNullSafe(look[b]) if null_safe else out[a] == look[b]
        cond = c if cond is None else cond & c
    return out.join(look, on=cond, how="left").drop(*lk)


def gap_months(later: str, earlier: str, mode: str = "round") -> Column:
    """Months between two dates: ``round`` = round(days / 30.44) (Python), ``whole`` = floor of
    months_between (R whole months). Halves cannot occur for integer day counts."""
    if mode == "round":
        return F.round(F.datediff(F.col(later), F.col(earlier)) / 30.44, 0).cast("int")
    if mode == "whole":
        return F.floor(F.months_between(F.col(later), F.col(earlier))).cast("int")
    raise ValueError("mode must be 'round' or 'whole'")
