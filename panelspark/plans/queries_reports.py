"""Registered queries: tables as a reader sees them, with counts, shares and statistics as text
(X15, X16, C12-C14)."""

from __future__ import annotations

from pyspark.sql import functions as F

from panelspark.functions.scalar import fixed, group_label, paren_thousands, percent, thousands
from panelspark.operators import tables as T
from panelspark.plans import bindings as B
from panelspark.plans.queries_stats import _DECADE_SQL
from panelspark.plans.registry import register


@register("freq_decade_text", f"""
SELECT coalesce(Year, 'Total') AS Year, format('{{:,}}', count(*)) AS firm_quarters, format('{{:,}}', sum(same_sign)::BIGINT) AS flag_quarters,
       printf('%.2f%%', 100 * avg(same_sign)) AS pct_flag, '(' || format('{{:,}}', count(*) - sum(same_sign)::BIGINT) || ')' AS others
FROM (SELECT {_DECADE_SQL} AS Year, same_sign FROM reg_panel) GROUP BY ROLLUP (Year)""")
def q_freq_decade_text(spark, sf_dir):
    """The frequency table of C13 with thousands separators, percentages and bracketed counts."""
    t = T.freq_by_decade(B.reg_panel(spark, sf_dir), "fyearq", "same_sign")
    return t.select("Year", thousands("firm_quarters").alias("firm_quarters"), thousands("flag_quarters").alias("flag_quarters"),
                    percent("pct_flag").alias("pct_flag"), paren_thousands(F.col("firm_quarters") - F.col("flag_quarters")).alias("others"))


@register("year_means_text", """
SELECT fyearq, format('{:,}', count(*)) AS n, printf('%.3f', avg(bhar)) AS bhar, printf('%.3f', avg(log_mve)) AS log_mve,
       printf('%.2f%%', 100 * avg(loss)) AS losses, CASE WHEN count(*) FILTER (WHERE bhar < -0.05) = 0 THEN ''
       ELSE '(' || format('{:,}', count(*) FILTER (WHERE bhar < -0.05)) || ')' END AS far_below
FROM reg_panel GROUP BY fyearq""")
def q_year_means_text(spark, sf_dir):
    """Means per year with three decimals; the bracketed count is empty where there is none."""
    g = B.reg_panel(spark, sf_dir).groupBy("fyearq").agg(
        F.count("*").alias("_n"), F.avg("bhar").alias("_b"), F.avg("log_mve").alias("_m"), F.avg("loss").alias("_l"),
        F.nullif(F.count(F.when(F.col("bhar") < -0.05, 1)), F.lit(0)).alias("_f"))
    return g.select("fyearq", thousands("_n").alias("n"), fixed("_b").alias("bhar"), fixed("_m").alias("log_mve"),
                    percent("_l").alias("losses"), paren_thousands("_f").alias("far_below"))


@register("group_labels", """
SELECT concat_ws(' / ', CASE sign(sue) WHEN 1 THEN 'Positive SUE' WHEN -1 THEN 'Negative SUE' END,
                 if(same_sign = 1, 'Same Sign', 'Different Sign')) AS label, count(*) AS n, avg(bhar) AS mean_bhar
FROM reg_panel GROUP BY label""", ["mean_bhar"])
def q_group_labels(spark, sf_dir):
    """Groups named by their direction and flag; rows without a direction carry the flag's name alone."""
    direction = F.when(F.col("sue") > 0, "Positive SUE").when(F.col("sue") < 0, "Negative SUE")
    flag = F.when(F.col("same_sign") == 1, "Same Sign").otherwise("Different Sign")
    return B.reg_panel(spark, sf_dir).groupBy(group_label(direction, flag).alias("label")).agg(F.count("*").alias("n"), F.avg("bhar").alias("mean_bhar"))
