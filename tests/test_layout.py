"""Bucketed storage: same rows, no exchange on the stored side of the event join, staged replacement."""

import datetime as dt

import pytest

from panelspark.operators import event_study as es
from panelspark.sources.layout import open_bucketed, write_bucketed

DAY = dt.date(2020, 1, 1)


def _returns(spark, n=400):
    rows = [(1 if i % 3 == 0 else i % 17, DAY + dt.timedelta(days=i), i / 1000) for i in range(n)]  # entity 1 holds a third
    return spark.createDataFrame([*rows, (None, DAY, 0.5), (3, None, None)], "permno int, dlycaldt date, dlyret double")


@pytest.fixture
def no_broadcast(spark):
    # small test tables would be broadcast, which hides the shuffle in question
    old = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    yield
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", old)


def test_event_join_reads_stored_returns_without_exchange(spark, tmp_path, no_broadcast):
    returns, path = _returns(spark), f"{tmp_path}/returns"
    write_bucketed(returns, path, ["permno", "dlycaldt"])
    stored = open_bucketed(spark, path)
    assert sorted(map(str, stored.collect())) == sorted(map(str, returns.collect()))
    days = returns.selectExpr("permno", "dlycaldt AS rdq", "0 AS offset", "dlycaldt AS date").where("permno < 5")
    market = returns.selectExpr("dlycaldt", "0.001D AS dlytotret").where("dlycaldt IS NOT NULL").distinct()

    def joined(source):
        return es.window_returns(days, source, market, "permno", "rdq")

    def exchanges(df):
        return df._jdf.queryExecution().executedPlan().toString().count("Exchange hashpartitioning(permno")

    assert sorted(map(str, joined(stored).collect())) == sorted(map(str, joined(returns).collect()))
    assert exchanges(joined(returns)) == 2 and exchanges(joined(stored)) == 1
    sizes = [r[0] for r in stored.selectExpr("input_file_name() AS f").groupBy("f").count().select("count").collect()]
    assert max(sizes) < 400 / 3  # the hot entity lies in several buckets


def test_failed_write_keeps_the_stored_table(spark, tmp_path):
    path = f"{tmp_path}/returns"
    write_bucketed(_returns(spark, 10), path, ["permno"], buckets=4)
    broken = _returns(spark, 10).selectExpr("permno", "dlycaldt", "raise_error('stop') AS dlyret")
    with pytest.raises(Exception, match="stop"):
        write_bucketed(broken, path, ["permno"], buckets=4)
    assert open_bucketed(spark, path).count() == 12
    assert [p.name for p in tmp_path.iterdir()] == ["returns"]
    write_bucketed(_returns(spark, 3).limit(0), path, ["permno"], buckets=2)  # empty: replaced, no rows
    assert open_bucketed(spark, path).count() == 0
    with pytest.raises(ValueError):
        write_bucketed(_returns(spark, 3), path, ["nobody"])
    with pytest.raises(ValueError):
        open_bucketed(spark, str(tmp_path))
