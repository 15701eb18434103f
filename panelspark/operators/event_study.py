"""Event-window returns: buy-and-hold abnormal returns (A4, C4) and cumulative paths.

Plan shape at scale (event days ~ 10^7-10^8, daily returns ~ 10^8-10^11 rows):
event days are filtered to the wanted offsets first, then shuffle-joined with the
returns on (entity, date) (both sides hash-partitioned on the pair, so a hot entity is
spread over its dates); the market series has one row per trading day and is broadcast.
The BHAR aggregate is partial (map-side), so only one row per (entity, event) per task
crosses the second shuffle.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F


def window_returns(event_days: DataFrame, returns: DataFrame, market: DataFrame, entity: str,
                   event_col: str, ret_entity: str = "permno", ret_date: str = "dlycaldt",
                   ret: str = "dlyret", mkt_date: str = "dlycaldt", mkt: str = "dlytotret",
                   lo: int | None = None, hi: int | None = None, date: str = "date") -> DataFrame:
    """(entity, event, offset, date, ret, vwretd): event days joined to stock and market returns.

    Inner joins on both sides, as in the reference: a day missing in either series drops.
    """
    ev = event_days.select(entity, event_col, "offset", date)
    if lo is not None:
        ev = ev.filter(F.col("offset") >= lo)
    if hi is not None:
        ev = ev.filter(F.col("offset") <= hi)
    r = returns.select(F.col(ret_entity).alias(entity), F.col(ret_date).alias(date), F.col(ret).alias("ret"))
    m = market.select(F.col(mkt_date).alias(date), F.col(mkt).alias("vwretd"))
    # market: one row per trading day, bounded by the calendar span -> broadcast
    return ev.join(r, on=[entity, date], how="inner").join(F.broadcast(m), on=date, how="inner")


def bhar(window_rets: DataFrame, entity: str, event_col: str, ret: str = "ret", mkt: str = "vwretd",
         out: str = "bhar", n_col: str = "n_days") -> DataFrame:
    """BHAR = prod(1+ret) - prod(1+mkt) per event; ``n_days`` counts every joined row.

    NULL returns are skipped in the product but still counted (T2); an all-NULL product
    is the empty product 1. Never exp(sum(log)): ret = -1 must give 0, not vanish.
    """
    gross = F.coalesce(F.product(F.lit(1.0) + F.col(ret)), F.lit(1.0))
    gross_m = F.coalesce(F.product(F.lit(1.0) + F.col(mkt)), F.lit(1.0))
    return (window_rets.groupBy(entity, event_col)
            .agg((gross - gross_m).alias(out), F.count("*").alias(n_col)))


def cumulative_bhar(window_rets: DataFrame, entity: str, event_col: str, ret: str = "ret",
                    mkt: str = "vwretd", na: str = "skip") -> DataFrame:
    """Running compounded returns per event by offset: cum_ret, cum_mkt, bhar_cum.

    ``na="skip"``: a NULL input gives NULL at that row and is skipped afterwards (polars
    ``cum_prod``); ``na="propagate"``: NULL from the first NULL on (R ``cumprod``).
    """
    w = (Window.partitionBy(entity, event_col).orderBy("offset")
         .rowsBetween(Window.unboundedPreceding, Window.currentRow))

    def running(c: str):
        prod = F.product(F.lit(1.0) + F.col(c)).over(w) - 1.0
        if na == "propagate":
            seen_null = F.sum(F.col(c).isNull().cast("int")).over(w) > 0
            return F.when(seen_null, F.lit(None).cast("double")).otherwise(prod)
        return F.when(F.col(c).isNotNull(), prod)

    out = (window_rets.withColumn("cum_ret", running(ret)).withColumn("cum_mkt", running(mkt))
           .withColumn("bhar_cum", F.col("cum_ret") - F.col("cum_mkt")))
    return out


def event_bhar(events: DataFrame, calendar: DataFrame, returns: DataFrame, market: DataFrame,
               entity: str, event_col: str, window: tuple[int, int] = (-1, 1),
               expand: tuple[int, int] = (-5, 5), min_days: int | None = None,
               on_collision: str = "drop", **ret_cols) -> DataFrame:
    """C3 + C4: calendar-mapped windows, then BHAR over ``window``; optional completeness filter."""
    from panelspark.operators.calendar import event_windows

    days = event_windows(events, calendar, entity, event_col, lo=expand[0], hi=expand[1],
                         on_collision=on_collision)
    rets = window_returns(days, returns, market, entity, event_col, lo=window[0], hi=window[1], **ret_cols)
    out = bhar(rets, entity, event_col)
    if min_days is not None:
        out = out.filter(F.col("n_days") >= min_days)
    return out
