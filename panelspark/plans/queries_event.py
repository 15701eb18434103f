"""Registered queries: trading calendar, as-of mapping, event windows, BHAR."""

from __future__ import annotations

import uuid

from pyspark.sql import functions as F

from panelspark.operators import calendar as cal
from panelspark.operators import event_study as es
from panelspark.operators.quality import sort_all
from panelspark.plans import bindings as B
from panelspark.plans.registry import register
from panelspark.session import ensure_checkpoint_dir
from panelspark.sources.layout import open_bucketed, write_bucketed

# The stand-alone event study: urgent-order dates per entity, [-5, +5] windows, BHAR on [-1, +1].

_EVENTS_SQL = """
mapped AS (
    SELECT e.permno, e.rdq, c.td
    FROM (SELECT permno, rdq, greatest(rdq, (SELECT min(date) FROM calendar)) AS key FROM event_keys) e
    ASOF JOIN calendar c ON c.date >= e.key
),
uniq AS (
    SELECT permno, td, min(rdq) AS rdq FROM mapped GROUP BY permno, td HAVING count(*) = 1
),
event_days AS (
    SELECT u.permno, u.rdq, u.td, o.offset, u.td + o.offset AS rel_td, c.date
    FROM uniq u, (SELECT unnest(range(-5, 6)) AS "offset") o, calendar c
    WHERE c.td = u.td + o.offset
),
window_rets AS (
    SELECT d.permno, d.rdq, d.offset, d.date, r.dlyret AS ret, m.dlytotret AS vwretd
    FROM event_days d
    JOIN daily_returns r ON r.permno = d.permno AND r.dlycaldt = d.date
    JOIN market_index m ON m.dlycaldt = d.date
)"""


def _std_events(spark, sf_dir):
    returns = B.daily_returns(spark, sf_dir)
    calendar = cal.trading_calendar(returns)
    events = B.event_keys(spark, sf_dir)
    return returns, calendar, events


def _event_days(spark, sf_dir):
    returns, calendar, events = _std_events(spark, sf_dir)
    days = cal.event_windows(events, calendar, "permno", "rdq", lo=-5, hi=5)
    return returns, days


def _window_rets(spark, sf_dir, lo=None, hi=None):
    returns, days = _event_days(spark, sf_dir)
    return es.window_returns(days, returns, B.market_index(spark, sf_dir), "permno", "rdq", lo=lo, hi=hi)


@register("trading_calendar", "SELECT td, date FROM calendar")
def q_trading_calendar(spark, sf_dir):
    return cal.trading_calendar(B.daily_returns(spark, sf_dir))


@register("asof_forward", """
SELECT e.permno, e.rdq, c.date AS rdq_td_date, c.td
FROM (SELECT permno, rdq, greatest(rdq, (SELECT min(date) FROM calendar)) AS key FROM event_keys) e
ASOF LEFT JOIN calendar c ON c.date >= e.key""")
def q_asof_forward(spark, sf_dir):
    returns, calendar, events = _std_events(spark, sf_dir)
    return cal.asof_forward(events, calendar, "rdq", out_date="rdq_td_date").select(
        "permno", "rdq", "rdq_td_date", "td")


@register("event_window", f"""WITH {_EVENTS_SQL.strip()} SELECT permno, rdq, td, "offset", rel_td, date FROM event_days""")
def q_event_window(spark, sf_dir):
    return _event_days(spark, sf_dir)[1]


@register("event_window_keep_collisions", """
WITH mapped AS (
    SELECT e.permno, e.rdq, c.td
    FROM (SELECT permno, rdq, greatest(rdq, (SELECT min(date) FROM calendar)) AS key FROM event_keys) e
    ASOF JOIN calendar c ON c.date >= e.key
)
SELECT m.permno, m.rdq, m.td, o.offset, m.td + o.offset AS rel_td, c.date
FROM mapped m, (SELECT unnest(range(-1, 2)) AS "offset") o
LEFT JOIN calendar c ON c.td = m.td + o.offset""")
def q_event_window_keep(spark, sf_dir):
    returns, calendar, events = _std_events(spark, sf_dir)
    return cal.event_windows(events, calendar, "permno", "rdq", lo=-1, hi=1, on_collision="keep", how="left")


@register("bhar_window", f"""WITH {_EVENTS_SQL.strip()}
SELECT permno, rdq, product(1 + ret) - product(1 + vwretd) AS bhar, count(*) AS n_days
FROM window_rets WHERE "offset" BETWEEN -1 AND 1 GROUP BY permno, rdq""", floats=["bhar"])
def q_bhar_window(spark, sf_dir):
    rets = _window_rets(spark, sf_dir, -1, 1)
    return es.bhar(rets, "permno", "rdq")


@register("bhar_bucketed", f"""WITH {_EVENTS_SQL.strip()}
SELECT permno, rdq, product(1 + ret) - product(1 + vwretd) AS bhar, count(*) AS n_days
FROM window_rets WHERE "offset" BETWEEN -1 AND 1 GROUP BY permno, rdq""", floats=["bhar"])
def q_bhar_bucketed(spark, sf_dir):
    """BHAR over returns stored by (entity, date) in the shared folder."""
    path = f"{ensure_checkpoint_dir(spark).rstrip('/')}/layout-{uuid.uuid4().hex}/returns"
    write_bucketed(B.daily_returns(spark, sf_dir), path, ["permno", "dlycaldt"])
    returns = open_bucketed(spark, path)
    days = cal.event_windows(B.event_keys(spark, sf_dir), cal.trading_calendar(returns), "permno", "rdq", lo=-5, hi=5)
    return es.bhar(es.window_returns(days, returns, B.market_index(spark, sf_dir), "permno", "rdq", lo=-1, hi=1), "permno", "rdq")


@register("bhar_complete", f"""WITH {_EVENTS_SQL.strip()}
SELECT * FROM (
  SELECT permno, rdq, product(1 + ret) - product(1 + vwretd) AS bhar, count(*) AS n_days
  FROM window_rets WHERE "offset" BETWEEN -1 AND 1 GROUP BY permno, rdq) WHERE n_days = 3""", floats=["bhar"])
def q_bhar_complete(spark, sf_dir):
    return q_bhar_window(spark, sf_dir).filter(F.col("n_days") == 3)


@register("cum_bhar", f"""WITH {_EVENTS_SQL.strip()}
SELECT permno, rdq, date, "offset", ret, vwretd, cum_ret, cum_mkt, cum_ret - cum_mkt AS bhar_cum FROM (
  SELECT *, product(1 + ret) OVER w - 1 AS cum_ret, product(1 + vwretd) OVER w - 1 AS cum_mkt
  FROM window_rets
  WINDOW w AS (PARTITION BY permno, rdq ORDER BY "offset" ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW))""",
          floats=["ret", "vwretd", "cum_ret", "cum_mkt", "bhar_cum"])
def q_cum_bhar(spark, sf_dir):
    rets = _window_rets(spark, sf_dir)
    return es.cumulative_bhar(rets, "permno", "rdq").select(
        "permno", "rdq", "date", "offset", "ret", "vwretd", "cum_ret", "cum_mkt", "bhar_cum")


@register("car_summary", f"""WITH {_EVENTS_SQL.strip()},
cum AS (
  SELECT *, product(1 + ret) OVER w - product(1 + vwretd) OVER w AS bhar_cum
  FROM window_rets
  WINDOW w AS (PARTITION BY permno, rdq ORDER BY "offset" ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW)),
reg AS (
  SELECT permno, rdq, product(1 + ret) - product(1 + vwretd) AS bhar
  FROM window_rets WHERE "offset" BETWEEN -1 AND 1 GROUP BY permno, rdq HAVING count(*) = 3)
SELECT CASE WHEN reg.bhar > 0 THEN 'Positive' ELSE 'Negative' END AS sign_dir,
       CASE WHEN permno % 2 = 1 THEN 'Odd' ELSE 'Even' END AS flag_lbl, "offset",
       avg(bhar_cum) AS mean_bhar, stddev_samp(bhar_cum) / sqrt(count(*)) AS se, count(*) AS n
FROM cum JOIN reg USING (permno, rdq)
WHERE reg.bhar <> 0
GROUP BY ALL""", floats=["mean_bhar", "se"])
def q_car_summary(spark, sf_dir):
    """C10 on the stand-alone events: sign of the [-1,1] BHAR x an entity flag x offset."""
    from panelspark.operators.tables import car_summary

    rets = _window_rets(spark, sf_dir)
    cum = es.cumulative_bhar(rets, "permno", "rdq")
    reg = es.bhar(rets.filter(F.col("offset").between(-1, 1)), "permno", "rdq").filter("n_days = 3")
    labels = reg.select("permno", "rdq",
                        F.when(F.col("bhar") > 0, "Positive").when(F.col("bhar") < 0, "Negative").alias("sign_dir"),
                        F.when(F.col("permno") % 2 == 1, "Odd").otherwise("Even").alias("flag_lbl"))
    return car_summary(cum, labels, ["permno", "rdq"], "sign_dir", "flag_lbl")


# The same operators on a second, independent series: users' daily mean event values.
_USER_SQL = _EVENTS_SQL.replace("event_keys", "user_events").replace("calendar", "user_calendar").replace(
    "daily_returns", "user_returns").replace("market_index", "user_market")


@register("user_bhar_window", f"""WITH {_USER_SQL.strip()}
SELECT permno, rdq, product(1 + ret) - product(1 + vwretd) AS bhar, count(*) AS n_days
FROM window_rets WHERE "offset" BETWEEN -1 AND 1 GROUP BY permno, rdq""", floats=["bhar"])
def q_user_bhar_window(spark, sf_dir):
    returns = B.user_returns(spark, sf_dir)
    return es.event_bhar(B.user_events(spark, sf_dir), cal.trading_calendar(returns), returns,
                         B.user_market(spark, sf_dir), "permno", "rdq", window=(-1, 1), expand=(-5, 5))


@register("event_window_guarded", """WITH mapped AS (SELECT e.permno, e.rdq, c.td
  FROM (SELECT *, greatest(rdq, (SELECT min(date) FROM calendar)) AS key FROM event_keys
        WHERE rdq <= (SELECT max(date) - 5 FROM calendar)) e ASOF JOIN calendar c ON c.date >= e.key),
days AS (SELECT *, td + "offset" AS rel_td FROM mapped, (SELECT unnest(range(-5, 6)) AS "offset"))
SELECT permno, rdq, days.td, "offset", rel_td, date FROM days LEFT JOIN calendar c ON c.td = rel_td
WHERE (permno, days.td) IN (SELECT permno, td FROM mapped GROUP BY ALL HAVING count(*) = 1)""")
def q_event_window_guarded(spark, sf_dir):
    """Windows of the events at least five calendar days before the end, days beyond the calendar kept
    without a date, sorted by every column (F9, O2)."""
    _, calendar, events = _std_events(spark, sf_dir)
    return sort_all(cal.event_windows(events, calendar, "permno", "rdq", how="left", guard_calendar_days=True))
