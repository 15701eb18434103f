"""Hand-written fixtures for the semantic traps T1-T12 and the key operators (NULL paths live here:
the driver tables have no NULLs in orders, lineitem or events)."""

import datetime as dt
import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from panelspark.functions.scalar import is_finite, safe_div, same_sign
from panelspark.operators import calendar as cal
from panelspark.operators import event_study as es
from panelspark.operators.linking import range_join
from panelspark.operators.periods import gap_months, period_lookup
from panelspark.operators.quality import (drop_duplicate_keys, duplicate_rows, duplicate_summary,
                                          keep_latest)
from panelspark.operators.transforms import standardize, truncate, winsorize

D = dt.date


def _calendar(spark, days):
    rets = spark.createDataFrame([(1, d, 0.0) for d in days], "permno int, dlycaldt date, dlyret double")
    return cal.trading_calendar(rets)


def test_calendar_dense_numbering(spark):
    days = [D(2024, 1, 5), D(2024, 1, 8), D(2024, 1, 2), D(2024, 1, 3)]
    got = _calendar(spark, days).orderBy("td").collect()
    assert [(r.td, r.date) for r in got] == list(enumerate(sorted(days), start=1))


def test_asof_forward_weekend_and_edges(spark):
    c = _calendar(spark, [D(2024, 1, 5), D(2024, 1, 8), D(2024, 1, 9)])
    ev = spark.createDataFrame([(1, D(2024, 1, 6)), (1, D(2024, 1, 1)), (1, D(2024, 1, 9)), (1, D(2024, 1, 10))],
                               "permno int, rdq date")
    got = {r.rdq: (r.td, r.rdq_td_date) for r in cal.asof_forward(ev, c, "rdq", out_date="rdq_td_date").collect()}
    assert got[D(2024, 1, 6)] == (2, D(2024, 1, 8))     # Saturday -> Monday (forward)
    assert got[D(2024, 1, 1)] == (1, D(2024, 1, 5))     # before the calendar -> first day
    assert got[D(2024, 1, 9)] == (3, D(2024, 1, 9))     # exact day
    assert got[D(2024, 1, 10)] == (None, None)          # after the last day -> NULL


def test_t1_collisions_dropped_or_kept(spark):
    c = _calendar(spark, [D(2024, 1, d) for d in (3, 4, 5, 8, 9, 10)])
    # Saturday and Sunday events of one entity both map to Monday the 8th
    ev = spark.createDataFrame([(1, D(2024, 1, 6)), (1, D(2024, 1, 7)), (2, D(2024, 1, 6))], "permno int, rdq date")
    drop = cal.event_windows(ev, c, "permno", "rdq", lo=-1, hi=1)
    assert {r.permno for r in drop.collect()} == {2}
    keep = cal.event_windows(ev, c, "permno", "rdq", lo=-1, hi=1, on_collision="keep")
    assert keep.filter("permno = 1").count() == 6


def test_t6_window_edges_inner_and_left(spark):
    c = _calendar(spark, [D(2024, 1, d) for d in (2, 3, 4)])
    ev = spark.createDataFrame([(1, D(2024, 1, 2))], "permno int, rdq date")
    inner = cal.event_windows(ev, c, "permno", "rdq", lo=-2, hi=2)
    assert sorted(r.offset for r in inner.collect()) == [0, 1, 2]   # negative td vanish, no overflow
    left = cal.event_windows(ev, c, "permno", "rdq", lo=-2, hi=2, how="left")
    assert sorted((r.offset, r.date) for r in left.collect())[:2] == [(-2, None), (-1, None)]


def test_f9_guard_drops_events_near_calendar_end(spark):
    c = _calendar(spark, [D(2024, 1, d) for d in (2, 3, 4, 5)])
    ev = spark.createDataFrame([(1, D(2024, 1, 2)), (2, D(2024, 1, 5))], "permno int, rdq date")
    got = cal.event_windows(ev, c, "permno", "rdq", lo=-1, hi=1, guard_calendar_days=True)
    assert {r.permno for r in got.collect()} == {1}


def test_t2_null_and_minus_one_returns(spark):
    rows = [(1, D(2024, 1, 1), 0, 0.10, 0.0), (1, D(2024, 1, 1), 1, None, 0.0), (1, D(2024, 1, 1), 2, 0.10, 0.0),
            (2, D(2024, 1, 1), 0, None, 0.01), (2, D(2024, 1, 1), 1, None, 0.01),
            (3, D(2024, 1, 1), 0, -1.0, 0.0), (3, D(2024, 1, 1), 1, 0.10, 0.0)]
    df = spark.createDataFrame(rows, "permno int, rdq date, offset int, ret double, vwretd double")
    got = {r.permno: (r.bhar, r.n_days) for r in es.bhar(df, "permno", "rdq").collect()}
    assert got[1][0] == pytest.approx(1.1 * 1.1 - 1.0) and got[1][1] == 3    # NULL counts, acts as 0 %
    assert got[2][0] == pytest.approx(1.0 - 1.01 ** 2) and got[2][1] == 2    # all NULL -> empty product 1
    assert got[3][0] == pytest.approx(0.0 - 1.0)                             # -1 wipes out the position


def test_w4_cumulative_null_modes(spark):
    rows = [(1, D(2024, 1, 1), o, r, 0.0) for o, r in ((0, 0.1), (1, None), (2, 0.1))]
    df = spark.createDataFrame(rows, "permno int, rdq date, offset int, ret double, vwretd double")
    skip = {r.offset: r.cum_ret for r in es.cumulative_bhar(df, "permno", "rdq").collect()}
    assert skip[0] == pytest.approx(0.1) and skip[1] is None and skip[2] == pytest.approx(0.21)
    prop = {r.offset: r.cum_ret for r in es.cumulative_bhar(df, "permno", "rdq", na="propagate").collect()}
    assert prop[0] == pytest.approx(0.1) and prop[1] is None and prop[2] is None


def test_q1_null_keys_form_a_group(spark):
    df = spark.createDataFrame([("a", 2020, None, 1.0), ("a", 2020, None, 2.0), ("a", 2020, 1, 3.0),
                                ("b", 2020, 2, 4.0)], "gvkey string, fyearq int, fqtr int, v double")
    got = sorted(r.v for r in drop_duplicate_keys(df, ["gvkey", "fyearq", "fqtr"]).collect())
    assert got == [3.0, 4.0]
    dup = duplicate_rows(df, ["gvkey", "fyearq", "fqtr"])
    assert sorted(r.v for r in dup.collect()) == [1.0, 2.0] and dup.columns[:3] == ["gvkey", "fyearq", "fqtr"]
    s = duplicate_summary(df, ["gvkey", "fyearq", "fqtr"]).first()
    assert (s.groups, s.rows, s.extra) == (1, 2, 1)


def test_q2_t7_keep_latest_with_tiebreak(spark):
    df = spark.createDataFrame([(1, D(2024, 2, 1), D(2023, 12, 31), "a", 10), (1, D(2024, 2, 1), D(2023, 9, 30), "a", 20),
                                (2, D(2024, 2, 1), D(2023, 12, 31), "a", 10), (2, D(2024, 2, 1), D(2023, 12, 31), "b", 5)],
                               "permno int, rdq date, datadate date, gvkey string, siccd int")
    got = {r.permno: (r.datadate, r.gvkey) for r in keep_latest(df, ["permno", "rdq"], "datadate",
                                                                 ["gvkey", "siccd"]).collect()}
    assert got == {1: (D(2023, 12, 31), "a"), 2: (D(2023, 12, 31), "b")}


def test_j1_j2_validity_ranges(spark):
    panel = spark.createDataFrame([("g1", D(2020, 1, 1)), ("g1", D(2020, 6, 30)), ("g1", D(2021, 1, 1)),
                                   ("g2", D(2020, 3, 1)), ("g3", D(2020, 3, 1))], "gvkey string, rdq date")
    links = spark.createDataFrame([("g1", 10, D(2020, 1, 1), D(2020, 6, 30)), ("g1", 11, D(2020, 6, 30), None),
                                   ("g2", 20, D(2020, 4, 1), D(2020, 5, 1))],
                                  "gvkey string, permno int, linkdt date, linkenddt date")
    inner = range_join(panel, links, ["gvkey"], "rdq", "linkdt", "linkenddt", right_cols=["permno"])
    got = sorted((r.rdq, r.permno) for r in inner.collect())
    # both bounds inclusive, open end -> far future, overlapping links fan out
    assert got == [(D(2020, 1, 1), 10), (D(2020, 6, 30), 10), (D(2020, 6, 30), 11), (D(2021, 1, 1), 11)]
    left = range_join(panel, links, ["gvkey"], "rdq", "linkdt", "linkenddt", how="left", right_cols=["permno"])
    assert left.filter("gvkey = 'g2'").first().permno is None          # out of range kept with NULL (J2)
    drop = range_join(panel, links, ["gvkey"], "rdq", "linkdt", "linkenddt", how="left", unmatched="drop",
                      right_cols=["permno"])
    assert drop.filter("gvkey = 'g2'").count() == 0 and drop.filter("gvkey = 'g3'").count() == 1   # J2b
    names = spark.createDataFrame([(10, None, None, 2834)], "permno int, namedt date, nameenddt date, siccd int")
    p2 = spark.createDataFrame([(10, D(1999, 1, 1))], "permno int, rdq date")
    j = range_join(p2, names, ["permno"], "rdq", "namedt", "nameenddt", how="left", open_end=None,
                   null_start_matches=True, right_cols=["siccd"])
    assert j.first().siccd == 2834                                       # NULL start matches any date


def test_j3_j4_period_keys_and_t5_nulls(spark):
    rows = [("a", 2020, 1, 1.0), ("a", 2019, 4, 2.0), ("a", 2019, 1, 3.0), ("a", 2021, 1, 4.0),
            ("b", 2020, None, 5.0), ("b", 2020, None, 6.0)]
    df = spark.createDataFrame(rows, "gvkey string, fyearq int, fqtr int, v double")
    prev = period_lookup(df, df, "gvkey", "fyearq", "fqtr", {"v": "v_lag1"}, 1)
    got = {(r.fyearq, r.fqtr): r.v_lag1 for r in prev.filter("gvkey = 'a'").collect()}
    assert got[(2020, 1)] == 2.0 and got[(2021, 1)] is None            # Q1 wraps to Q4 of last year; gap -> NULL
    seas = period_lookup(df, df, "gvkey", "fyearq", "fqtr", {"v": "v_lag4"}, 4)
    got4 = {(r.fyearq, r.fqtr): r.v_lag4 for r in seas.filter("gvkey = 'a'").collect()}
    assert got4[(2020, 1)] == 3.0 and got4[(2021, 1)] == 1.0
    # NULL quarter: SQL semantics never match; null-safe matches NULL to NULL (fans out over both rows)
    assert seas.filter("gvkey = 'b'").filter(F.col("v_lag4").isNotNull()).count() == 0


def test_x12_gap_months_modes(spark):
    df = spark.createDataFrame([(D(2021, 2, 28), D(2020, 2, 29)), (D(2020, 12, 31), D(2019, 12, 31)),
                                (D(2020, 9, 30), D(2019, 12, 31)), (D(2021, 3, 31), D(2019, 12, 31))], "a date, b date")
    got = [(r.p, r.w) for r in df.select(gap_months("a", "b").alias("p"), gap_months("a", "b", "whole").alias("w")).collect()]
    assert got == [(12, 12), (12, 12), (9, 9), (15, 15)]


def test_x2_x7_t3_scalar_semantics(spark):
    df = spark.createDataFrame([(0.0, 0.0, 1.0, 0.0), (1.0, -2.0, 1.0, 2.0), (None, 1.0, 1.0, 1.0)],
                               "a double, b double, x double, y double")
    got = df.select(same_sign("a", "b").alias("s"), safe_div("x", "y").alias("d"),
                    is_finite(safe_div("x", "y")).alias("f")).collect()
    assert [r.s for r in got] == [1, 0, None]                          # two zeros count as the same sign
    assert got[0].d is None and not got[0].f and got[1].d == 0.5         # x/0 -> NULL, not an error (ANSI)


def test_w7_winsorize_keeps_nulls_and_hits_cuts(spark):
    vals = [float(i) for i in range(1, 101)] + [None]
    df = spark.createDataFrame([(i, v) for i, v in enumerate(vals)], "id int, x double")
    w = {r.id: r.x for r in winsorize(df, "x", 0.05, 0.95).collect()}
    # lower: index floor(99*0.05)=4 -> 5.0 ; higher: ceil(99*0.95)=95 -> 96.0
    assert w[0] == 5.0 and w[99] == 96.0 and w[50] == 51.0 and w[100] is None
    t2 = {r.id: r.x for r in winsorize(df, "x", 0.05, 0.95, rule="type2").collect()}
    # type 2 with n*p whole: mean of neighbours -> 5.5 and 95.5
    assert t2[0] == 5.5 and t2[99] == 95.5


def test_t10_truncate_removes_cut_values(spark):
    df = spark.createDataFrame([(i, float(i)) for i in range(1, 101)], "id int, x double")
    t = {r.id: r.x for r in truncate(df, "x", 0.01, 0.99, rule="lower").collect()}
    # lower rule: cuts v[0]=1 and v[98]=99 -> both cut values themselves become NULL
    assert t[1] is None and t[99] is None and t[100] is None and t[2] == 2.0


def test_w9_standardize(spark):
    df = spark.createDataFrame([(1.0,), (2.0,), (3.0,), (None,)], "x double")
    got = sorted((r.x_std for r in standardize(df, "x", suffix="_std").collect()), key=lambda v: (v is None, v))
    assert got[:3] == pytest.approx([-1.0, 0.0, 1.0]) and got[3] is None


def test_long_ranges_take_two_bins(spark):
    from panelspark.operators.linking import range_bins
    rnd = np.random.default_rng(3)
    starts = rnd.integers(-4000, 20000, 500)
    spans = (2.0 ** rnd.uniform(0, 15, 500)).astype(int)
    day = lambda n: D(1970, 1, 1) + dt.timedelta(days=int(n))
    rows = [(i, day(a), day(a + b) if i % 5 else None) for i, (a, b) in enumerate(zip(starts, spans))]
    r = spark.createDataFrame(rows + [(900, None, None), (901, day(9), day(3))], "rid int, _rstart date, _rend date")
    bins = range_bins(r, 30, linking_far(), True).collect()
    per = {}
    for b in bins:
        per.setdefault(b.rid, []).append(b)
    assert set(per) == {*range(500), 900} and max(map(len, per.values())) == 2 and len(per[900]) == 1
    for i, a, b in rows:
        first, last = ((d - D(1970, 1, 1)).days // 30 for d in (a, b or linking_far()))
        wide = 1 << per[i][0]._level
        assert last - first + 1 <= wide < max(2 * (last - first + 1), 2)
        assert {x._bin for x in per[i]} == {first // wide, last // wide}


def test_open_ended_ranges_and_a_hot_key(spark):
    """A third of the rows on one key whose ranges never end; nothing but the join's rows comes out."""
    left = spark.range(3000).selectExpr("id", "if(id % 3 = 0, 7, id) AS k", "date_add(DATE'1990-01-01', cast(id % 900 AS int)) AS d")
    right = spark.range(40).selectExpr("7L AS k", "date_add(DATE'1990-01-01', cast(id * 25 AS int)) AS s", "CAST(NULL AS date) AS e", "id AS rid")
    for how, unmatched in (("inner", "keep"), ("left", "keep"), ("left", "drop")):
        got = [range_join(left, right, ["k"], "d", "s", "e", how=how, unmatched=unmatched, right_cols=["rid"], bucket_days=b)
               for b in (None, 30)]
        assert got[0].columns == got[1].columns and got[0].exceptAll(got[1]).count() == got[1].exceptAll(got[0]).count() == 0
        assert got[1].count() > 3000


def test_bucketed_range_join_equals_plain(spark):
    import random
    rnd = random.Random(5)
    base = D(2000, 1, 1)
    rows = [(rnd.randint(0, 4), None if rnd.random() < 0.05 else base + dt.timedelta(days=rnd.randint(0, 3000)))
            for _ in range(400)]
    left = spark.createDataFrame([(i, k, d) for i, (k, d) in enumerate(rows)], "id int, k int, d date")
    ranges = []
    for j in range(120):
        s = None if rnd.random() < 0.05 else base + dt.timedelta(days=rnd.randint(0, 3000))
        e = None if rnd.random() < 0.1 else (s or base) + dt.timedelta(days=rnd.randint(0, 500))
        ranges.append((rnd.randint(0, 5), s, e, j))
    right = spark.createDataFrame(ranges, "k int, s date, e date, rid int")
    for how, nsm, oe in (("inner", False, linking_far()), ("left", True, None), ("left", False, linking_far())):
        plain = range_join(left, right, ["k"], "d", "s", "e", how=how, null_start_matches=nsm, open_end=oe,
                           right_cols=["rid"])
        binned = range_join(left, right, ["k"], "d", "s", "e", how=how, null_start_matches=nsm, open_end=oe,
                            right_cols=["rid"], bucket_days=90)
        a = sorted((r.id, r.rid if r.rid is not None else -1) for r in plain.collect())
        b = sorted((r.id, r.rid if r.rid is not None else -1) for r in binned.collect())
        assert a == b, (how, nsm)


def linking_far():
    from panelspark.operators.linking import FAR_FUTURE
    return FAR_FUTURE


def test_counts_of_successive_key_drops(spark):
    """One chain of aggregations counts what dropping key by key leaves; NULL keys form a group, a hot key is one."""
    from panelspark.operators.quality import drop_duplicate_keys, successive_drop_counts

    rnd = random.Random(5)
    rows = [(rnd.choice([None, *range(40)]), rnd.choice([None, 1, 2, 3]), rnd.choice([None, *range(60)])) for _ in range(200)]
    rows += [(7, 1, 7)] * 100 + [(None, None, None)] * 2 + [(1000 + i, 1, 2000) for i in range(3)] + [(5000, 1, 5000), (8000, 1, 1), (8000, 2, 1)]
    df = spark.createDataFrame(rows, "a int, b int, c int")
    steps = [["a", "b"], ["a", "c"], ["c"]]
    want, left = [df.count()], df
    for keys in steps:
        left = drop_duplicate_keys(left, keys)
        want.append(left.count())
    assert all(x > y for x, y in zip(want, want[1:])), want
    assert list(successive_drop_counts(df, steps).first()) == want
    assert list(successive_drop_counts(df.limit(0), steps).first()) == [0, 0, 0, 0]
