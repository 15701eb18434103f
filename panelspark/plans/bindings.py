"""Roles played by the driver tables (orders, lineitem, part) in the event-study pipeline.

Each binding is a plain DataFrame derivation of whole tables; the number of entities is half the
number of suppliers, so every role grows with the input. A trading period is an ISO week, dated by
its Monday: about 1,200 line items per entity over some 360 weeks keep the series dense at every
scale factor. ``panelspark.plans.oracle`` holds the same derivations as DuckDB SQL; the two must
stay in step (the correctness gate compares them).

Role                 source      meaning
panel_raw            orders      filings: orders per firm, quarter and late-filing flag, with duplicate keys
links                orders      validity-range link gvkey -> permno (overlapping, some open-ended)
name_history         part        dated SIC codes per permno, contiguous ranges of whole days
daily_returns        lineitem    (permno, trading week, return)
market_index         lineitem    value-weighted market return per trading week
event_keys           orders      (permno, event date) of all orders, for the stand-alone windows
reg_panel            lineitem    a large analysis panel for transforms, tables and regressions
user_returns         events      a second daily series: (user, day, mean value / 1000), a cross-check
user_events          events      (user, day) of error events, the second set of event dates
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

TABLES = ("region", "nation", "customer", "supplier", "part", "orders", "lineitem",
          "events", "documents", "embeddings", "pages", "benchmark", "labels", "conversations")

# Fixed values of the synthetic roles (must equal the SQL twins in oracle.py)
NAME_HISTORY_START = "1995-01-01"
NAME_HISTORY_SPAN_DAYS = 2700
LINK_DAYS = 120
FIRM_CUSTOMERS = 5  # customers whose orders make up one firm's filings


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def _with_entities(df: DataFrame, spark: SparkSession, sf_dir: str) -> DataFrame:
    """Adds ``_ne``, the number of entities: one aggregated row, so the broadcast has a proven bound."""
    n = table(spark, sf_dir, "supplier").agg(F.greatest(F.expr("count(*) div 2"), F.lit(1)).alias("_ne"))
    return df.crossJoin(F.broadcast(n))


def _firm() -> Column:
    return F.expr(f"o_custkey div {FIRM_CUSTOMERS}")


def panel_raw(spark: SparkSession, sf_dir: str) -> DataFrame:
    o = table(spark, sf_dir, "orders")
    d = F.to_date("o_orderdate")
    # every 19th order closes the previous quarter: a fiscal-year change, so (gvkey, datadate) repeats
    filings = o.groupBy(_firm().cast("string").alias("gvkey"), F.year(d).cast("int").alias("fyearq"),
                        F.quarter(d).cast("int").alias("fqtr"), F.to_date(F.trunc(d, "quarter")).alias("_q"),
                        (F.col("o_orderkey") % 19 == 0).alias("_late")).agg(
        F.min("o_orderkey").alias("_k"), F.max("o_totalprice").alias("_price"))
    datadate = F.last_day(F.add_months("_q", F.when(F.col("_late"), F.lit(-1)).otherwise(F.lit(2))))
    return filings.select(
        "gvkey",
        datadate.alias("datadate"),
        "fyearq",
        "fqtr",
        F.date_add(datadate, (F.lit(20) + F.col("_k") % 60).cast("int")).alias("rdq"),
        (F.col("_price") / 1000).alias("saleq"),
        # earnings move with sales plus a filing-specific part, so their changes can disagree in sign
        (F.col("_price") / 1000 - 250 + ((F.col("_k") % 7) - 3).cast("double") * 20.0).alias("ibq"),
        (F.lit(1) + F.col("_k") % 50).cast("double").alias("cshoq"),
        (F.col("_price") / 10000).alias("prccq"),
    )


def links(spark: SparkSession, sf_dir: str) -> DataFrame:
    o = _with_entities(table(spark, sf_dir, "orders"), spark, sf_dir)
    d = F.to_date("o_orderdate")
    return o.select(
        _firm().cast("string").alias("gvkey"),
        (_firm() % F.col("_ne")).cast("int").alias("lpermno"),
        F.when(F.col("o_orderstatus") == "F", "LC").when(F.col("o_orderstatus") == "O", "LU")
        .otherwise("NR").alias("linktype"),
        F.when(F.col("o_orderpriority").isin("1-URGENT", "2-HIGH", "3-MEDIUM"), "P")
        .when(F.col("o_orderpriority") == "4-NOT SPECIFIED", "C").otherwise("J").alias("linkprim"),
        d.alias("linkdt"),
        F.when(F.col("o_orderkey") % 7 == 0, F.lit(None).cast("date"))
        .otherwise(F.date_add(d, LINK_DAYS)).alias("linkenddt"),
    )


def name_history(spark: SparkSession, sf_dir: str) -> DataFrame:
    p = _with_entities(table(spark, sf_dir, "part"), spark, sf_dir)
    # parts per entity do not depend on the scale factor: about 40 ranges of some 67 days each
    slots = p.agg(F.max(F.expr("p_partkey div _ne + 1")).alias("_ns"))
    start = F.lit(NAME_HISTORY_START).cast("date")
    first = f"CAST((p_partkey div _ne) * {NAME_HISTORY_SPAN_DAYS} div _ns AS INT)"
    after = f"CAST((p_partkey div _ne + 1) * {NAME_HISTORY_SPAN_DAYS} div _ns AS INT)"
    return p.crossJoin(F.broadcast(slots)).select(
        (F.col("p_partkey") % F.col("_ne")).cast("int").alias("permno"),
        F.date_add(start, F.expr(first)).alias("namedt"),
        F.date_add(start, F.expr(after) - 1).alias("nameenddt"),
        (F.lit(100) + (F.col("p_partkey") * 37) % 9900).cast("int").alias("siccd"),
    )


def _weekly_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "lineitem").withColumn("dlycaldt", F.trunc(F.to_date("l_shipdate"), "week"))


def daily_returns(spark: SparkSession, sf_dir: str) -> DataFrame:
    return (_with_entities(_weekly_lines(spark, sf_dir), spark, sf_dir)
            .groupBy((F.col("l_suppkey") % F.col("_ne")).cast("int").alias("permno"), "dlycaldt")
            .agg((F.avg("l_discount") - F.avg("l_tax")).alias("dlyret")))


def market_index(spark: SparkSession, sf_dir: str) -> DataFrame:
    return (_weekly_lines(spark, sf_dir).groupBy("dlycaldt")
            .agg((F.sum(F.col("l_extendedprice") * F.col("l_discount")) / F.sum("l_extendedprice")
                  - F.avg("l_tax")).alias("dlytotret")))


def event_keys(spark: SparkSession, sf_dir: str) -> DataFrame:
    o = _with_entities(table(spark, sf_dir, "orders"), spark, sf_dir)
    return o.select((F.col("o_custkey") % F.col("_ne")).cast("int").alias("permno"),
                    F.to_date("o_orderdate").alias("rdq")).distinct()


def reg_panel(spark: SparkSession, sf_dir: str) -> DataFrame:
    li = table(spark, sf_dir, "lineitem")
    sue = F.col("l_discount") - 0.05
    same = (F.col("l_linenumber") % 2).cast("int")
    return li.select(
        F.col("l_orderkey").alias("obs_id"),
        F.col("l_linenumber").alias("obs_line"),
        F.col("l_partkey").alias("obs_part"),
        F.col("l_suppkey").alias("obs_supp"),
        F.col("l_suppkey").cast("int").alias("permno"),
        (F.lit(100) + (F.col("l_partkey") * 37) % 9900).cast("int").alias("siccd"),
        F.year("l_shipdate").cast("int").alias("fyearq"),
        (F.lit(1) + F.col("l_partkey") % 12).cast("double").alias("ff12num"),
        sue.alias("sue"),
        same.alias("same_sign"),
        (F.col("l_returnflag") == "R").cast("int").alias("loss"),
        F.ln("l_extendedprice").alias("log_mve"),
        ((F.col("l_tax") - 0.04) + 0.5 * sue * (1 + same) + 0.001 * (F.col("l_quantity") - 25)).alias("bhar"),
    )


def user_returns(spark: SparkSession, sf_dir: str) -> DataFrame:
    e = table(spark, sf_dir, "events")
    return (e.groupBy(F.col("user_id").alias("permno"), F.to_date("ts").alias("dlycaldt"))
            .agg((F.avg("value") / 1000).alias("dlyret")))


def user_market(spark: SparkSession, sf_dir: str) -> DataFrame:
    e = table(spark, sf_dir, "events")
    return e.groupBy(F.to_date("ts").alias("dlycaldt")).agg((F.avg("value") / 1000).alias("dlytotret"))


def user_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    e = table(spark, sf_dir, "events")
    return (e.filter(F.col("event_type") == "error")
            .select(F.col("user_id").alias("permno"), F.to_date("ts").alias("rdq")).distinct())
