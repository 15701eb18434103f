"""General as-of join against pandas, with ties, missing keys and a key that spans partitions."""

import numpy as np
import pandas as pd
import pytest

from panelspark.operators.asof import asof_join


@pytest.mark.parametrize("direction", ["backward", "forward"])
@pytest.mark.parametrize("exact", [True, False])
def test_asof_equals_pandas(spark, direction, exact):
    rng = np.random.default_rng(6)
    day = lambda n: pd.Timestamp("2020-01-01") + pd.to_timedelta(rng.integers(0, 400, n), unit="D")
    # key 1 holds most rows and is spread over all partitions; key 9 has no facts, key 8 no rows
    left = pd.DataFrame({"k": rng.choice([1, 1, 1, 1, 2, 3, 9], 900), "at": day(900), "row": np.arange(900)})
    right = pd.DataFrame({"k": rng.choice([1, 1, 2, 3, 8], 60), "seen": day(60), "v": rng.integers(0, 99, 60)})
    facts = right.groupby(["k", "seen"], as_index=False).v.max().sort_values("seen")
    want = pd.merge_asof(left.sort_values("at"), facts.assign(at=facts.seen), on="at", by="k", direction=direction, allow_exact_matches=exact)
    got = asof_join(spark.createDataFrame(left).repartition(5), spark.createDataFrame(right), ["k"], "at", "seen", ["v"], direction, exact).toPandas()
    assert len(got) == 900
    both = got.merge(want, on="row", suffixes=("", "_w"))
    assert (both.seen.isna() == both.seen_w.isna()).all() and both.seen.isna().any()
    assert (both.seen.fillna(pd.Timestamp(0)) == both.seen_w.fillna(pd.Timestamp(0))).all() and (both.v.fillna(-1) == both.v_w.fillna(-1)).all()


def test_asof_keeps_rows_without_key_or_time(spark):
    left = spark.createDataFrame([(1, 5, "a"), (None, 5, "b"), (1, None, "c"), (1, 5, "a")], "k int, d int, name string").selectExpr("k", "date_add(DATE '2020-01-01', d) AS at", "name")
    right = spark.createDataFrame([(1, 3, 10), (1, 3, 11), (None, 1, 12), (1, None, 13)], "k int, d int, v int").selectExpr("k", "date_add(DATE '2020-01-01', d) AS seen", "v")
    got = sorted((r.name, r.v) for r in asof_join(left, right, ["k"], "at", "seen", ["v"]).collect() if r.v is not None)
    assert got == [("a", 11), ("a", 11)] and asof_join(left, right, ["k"], "at", "seen", ["v"]).count() == 4
    assert asof_join(left, right.limit(0), ["k"], "at", "seen", ["v"]).where("v IS NOT NULL").count() == 0
