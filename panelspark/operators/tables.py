"""Report tables as DataFrames: descriptives, correlations, frequencies, cross-tabs, the
figure datasets (A5-A18, C7-C10, C13, C14, C16).

Every statistic is a distributed aggregate (one ``agg`` pass for moments, exact
quantiles from ``quantiles``); only the finished small table is ever collected.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from panelspark.functions.scalar import decade_label, thousands
from panelspark.operators.quantiles import BROADCAST_STATE_ROWS, QSpec, cell_offsets, quantiles, value_cells
from panelspark.operators.transforms import qcut
from panelspark.session import reliable_checkpoint


def descriptives(df: DataFrame, variables: list[str], labels: dict[str, str] | None = None,
                 p_rule: str = "nearest", median_rule: str = "linear") -> DataFrame:
    """One row per variable over its non-NULL values: Variable, N, Mean, SD, Min, P25, Median, P75, Max.

    Defaults follow the Python reference (P25/P75 ``nearest``, median ``linear``); pass
    ``p_rule="linear"`` (R type 7) for R/Stata-style quartiles.
    """
    labels = labels or {}
    moments = df.agg(*[e for v in variables for e in (
        F.count(v).alias(f"{v}__N"), F.avg(v).alias(f"{v}__Mean"), F.stddev_samp(v).alias(f"{v}__SD"),
        F.min(v).cast("double").alias(f"{v}__Min"), F.max(v).cast("double").alias(f"{v}__Max"))])
    qs = quantiles(df, [QSpec(v, q, r, f"{v}__{name}") for v in variables
                        for q, r, name in ((0.25, p_rule, "P25"), (0.5, median_rule, "Median"),
                                           (0.75, p_rule, "P75"))])
    wide = moments.crossJoin(qs)
    stats = ["N", "Mean", "SD", "Min", "P25", "Median", "P75", "Max"]
    rows = [F.struct(F.lit(labels.get(v, v)).alias("Variable"), F.lit(i).alias("_order"),
                     *[F.col(f"{v}__{s}").cast("long" if s == "N" else "double").alias(s) for s in stats])
            for i, v in enumerate(variables)]
    return wide.select(F.explode(F.array(*rows)).alias("r")).select("r.*").orderBy("_order").drop("_order")


def safe_corr(a: str, b: str):
    """Pairwise-complete Pearson correlation that is NULL (not an ANSI error) for a constant column."""
    both = F.col(a).isNotNull() & F.col(b).isNotNull()
    x, y = F.when(both, F.col(a).cast("double")), F.when(both, F.col(b).cast("double"))
    return F.try_divide(F.covar_samp(x, y), F.stddev_samp(x) * F.stddev_samp(y))


def pearson_matrix(df: DataFrame, cols: list[str], names: dict[str, str] | None = None) -> DataFrame:
    """Pairwise-complete Pearson matrix: one row per variable, one column per variable.

    One ``agg`` with k(k-1)/2 ``corr`` columns (``corr`` skips rows where either side is NULL).
    """
    names = names or {}
    pairs = {(a, b): safe_corr(a, b) for i, a in enumerate(cols) for b in cols[i + 1:]}
    one = df.agg(*[c.alias(f"{a}__{b}") for (a, b), c in pairs.items()]) if pairs else df.agg(F.count(F.lit(1)))
    return _square(one, cols, names, lambda a, b: f"{a}__{b}" if (a, b) in pairs else f"{b}__{a}")


def _square(one: DataFrame, cols: list[str], names: dict[str, str], key, lower_key=None) -> DataFrame:
    rows = []
    for i, a in enumerate(cols):
        vals = []
        for j, b in enumerate(cols):
            if a == b:
                v = F.lit(1.0)
            elif lower_key is not None and j < i:
                v = F.col(lower_key(a, b))
            else:
                v = F.col(key(a, b))
            vals.append(v.cast("double").alias(names.get(b, b)))
        rows.append(F.struct(F.lit(names.get(a, a)).alias("variable"), F.lit(i).alias("_order"), *vals))
    return one.select(F.explode(F.array(*rows)).alias("r")).select("r.*").orderBy("_order").drop("_order")


def average_ranks(df: DataFrame, cols: list[str]) -> DataFrame:
    """Adds ``{c}__rk`` (average rank, 1-based, ties share their mean, NULL stays NULL) for every column.

    Rows are reduced to (column, value, count) by one aggregation (ties collapse map-side) and range
    partitioned; rank(v) = #(x < v) + (#(x = v) + 1) / 2 comes from the counts of earlier partitions
    and a running count inside each. The ranks return by value: broadcast where counted to be few,
    otherwise a shuffle join in which AQE splits a hot value.
    """
    cells = value_cells(df, cols, [])
    offsets = cell_offsets(cells, []).select(F.col("_c").alias("_oc"), F.col("_pid").alias("_op"), "_off")
    w = Window.partitionBy("_c", "_pid").orderBy("_v").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    ranks = (cells.filter(F.col("_cnt") > 0)
             .join(offsets, (F.col("_c") == F.col("_oc")) & (F.col("_pid") == F.col("_op")))
             .select("_c", "_v", (F.col("_off") + F.sum("_cnt").over(w) - F.col("_cnt") + (F.col("_cnt") + 1) / 2.0)
                     .alias("_rk")))
    ranks = reliable_checkpoint(ranks)
    distinct = {r["_c"]: r["n"] for r in ranks.groupBy("_c").agg(F.count(F.lit(1)).alias("n")).collect()}
    out = df
    for i, c in enumerate(cols):
        r = ranks.filter(F.col("_c") == i).select(F.col("_v").alias(f"_x{i}"), F.col("_rk").alias(f"{c}__rk"))
        r = F.broadcast(r) if distinct.get(i, 0) <= BROADCAST_STATE_ROWS else r
        out = out.join(r, on=F.col(c).cast("double") == F.col(f"_x{i}"), how="left").drop(f"_x{i}")
    return out


def pearson_spearman(df: DataFrame, cols: list[str], row_key: list[str],
                     names: dict[str, str] | None = None) -> DataFrame:
    """Pearson above the diagonal, Spearman below (A17). Spearman uses rows complete in all
    ``cols`` (listwise); the Pearson part is pairwise-complete."""
    names = names or {}
    complete = df
    for c in cols:
        complete = complete.filter(F.col(c).isNotNull())
    ranked = average_ranks(complete.select(*row_key, *cols), cols)
    pear = {(a, b): safe_corr(a, b) for i, a in enumerate(cols) for b in cols[i + 1:]}
    spear = {(a, b): safe_corr(f"{a}__rk", f"{b}__rk") for i, a in enumerate(cols) for b in cols[i + 1:]}
    p = df.agg(*[c.alias(f"p__{a}__{b}") for (a, b), c in pear.items()])
    s = ranked.agg(*[c.alias(f"s__{a}__{b}") for (a, b), c in spear.items()])
    return _square(p.crossJoin(s), cols, names, lambda a, b: f"p__{a}__{b}",
                   lower_key=lambda a, b: f"s__{b}__{a}")


def freq_by_decade(df: DataFrame, year: str, flag: str) -> DataFrame:
    """Year bucket, Firm-Quarters, flag count, flag share, plus a "Total" row (A8 + A9 via rollup)."""
    lab = df.withColumn("Year", decade_label(year))
    out = (lab.rollup("Year").agg(F.count(F.lit(1)).alias("firm_quarters"),
                                  F.sum(flag).cast("long").alias("flag_quarters"),
                                  F.avg(flag).alias("pct_flag"), F.grouping("Year").alias("_g")))
    return out.select(F.when(F.col("_g") == 1, F.lit("Total")).otherwise(F.col("Year")).alias("Year"),
                      "firm_quarters", "flag_quarters", "pct_flag")


def crosstab(df: DataFrame, row: str, col: str, values: list) -> DataFrame:
    """Counts by row x col with row percentages and a total row (A10):
    row, n_<v>..., total, pct_<v>... . Conditional counts inside one rollup keep it one pass
    (a pivot cannot follow a rollup)."""
    cnt = [F.count(F.when(F.col(col) == F.lit(v), 1)).alias(f"n_{v}") for v in values]
    agg = df.rollup(row).agg(*cnt, F.count(F.lit(1)).alias("total"), F.grouping(row).alias("_g"))
    sel = [F.when(F.col("_g") == 1, F.lit("Total")).otherwise(F.col(row).cast("string")).alias(row)]
    sel += [f"n_{v}" for v in values] + ["total"]
    sel += [(F.col(f"n_{v}") * 100.0 / F.col("total")).alias(f"pct_{v}") for v in values]
    return agg.select(*sel)


def flag_frequency(df: DataFrame, flag: str) -> DataFrame:
    """Rows per value of a flag, NULL a value of its own (A14): flag, n, pct of all rows. One
    aggregate; only its few rows meet in the window that adds them up."""
    agg = df.groupBy(flag).agg(F.count(F.lit(1)).alias("n"))
    return agg.select(flag, "n", (F.col("n") * 100.0 / F.sum("n").over(Window.partitionBy())).alias("pct"))


def formatted_counts(df: DataFrame, cols: list[str]) -> DataFrame:
    """variable, count: non-NULL values with thousands separators (A18); a column without any
    value shows the number of rows."""
    n = df.agg(F.count(F.lit(1)).alias("_n"), *[F.count(c).alias(f"_c{i}") for i, c in enumerate(cols)])
    text = [F.struct(F.lit(c).alias("variable"), thousands(F.when(F.col(f"_c{i}") > 0, F.col(f"_c{i}")).otherwise(F.col("_n"))).alias("count"))
            for i, c in enumerate(cols)]
    return n.select(F.inline(F.array(*text)))


def group_rate(df: DataFrame, group: str | list[str], flag: str, out: str = "rate") -> DataFrame:
    """Mean of a 0/1 flag per group (A5); ``sort_rank`` orders groups by that mean."""
    groups = [group] if isinstance(group, str) else list(group)
    agg = df.groupBy(*groups).agg(F.avg(flag).alias(out), F.count(F.lit(1)).alias("n"))
    return agg


def flag_rate_by_industry(df: DataFrame, industry: str = "FF12", flag: str = "same_sign") -> DataFrame:
    """Share of the flag per industry with its rank (ascending share); small output."""
    from pyspark.sql import Window
    agg = group_rate(df, industry, flag, "pct_same_sign")
    # one row per industry (a dozen): ordering them on one partition is fine
    return agg.withColumn("sort_rank", F.row_number().over(Window.orderBy("pct_same_sign", industry)))


def flag_rate_year_size(df: DataFrame, year: str = "fyearq", size: str = "mve", flag: str = "same_sign",
                        n: int = 5, method: str = "qcut", tiebreak: list[str] | None = None) -> DataFrame:
    """Flag share by year x size quintile (``qcut`` breaks as Python, or ``ntile`` ranks as R)."""
    if method == "qcut":
        binned = qcut(df, size, n, "size_qnt", by=[year])
    else:
        from panelspark.operators.transforms import ntile
        binned = ntile(df, size, n, "size_qnt", by=[year], tiebreak=tiebreak)
    return (binned.filter(F.col("size_qnt").isNotNull()).groupBy(year, "size_qnt")
            .agg(F.avg(flag).alias("pct_same_sign"), F.count(F.lit(1)).alias("n")))


def decile_means(df: DataFrame, x: str = "sue", y: str = "bhar", n: int = 10) -> DataFrame:
    """Mean of ``y`` and count per quantile bin of ``x``."""
    return (qcut(df, x, n, "bin").groupBy("bin")
            .agg(F.avg(y).alias(f"mean_{y}"), F.count(F.lit(1)).alias("n")))


def car_summary(cum: DataFrame, labels: DataFrame, keys: list[str], dir_col: str, flag_col: str,
                value: str = "bhar_cum") -> DataFrame:
    """Mean, standard error (sd / sqrt(all rows)) and n of cumulative BHAR per
    (direction, flag, offset); rows whose direction is NULL are dropped (A6, T11)."""
    j = cum.join(labels.select(*keys, dir_col, flag_col), on=keys, how="inner").filter(F.col(dir_col).isNotNull())
    return j.groupBy(dir_col, flag_col, "offset").agg(
        F.avg(value).alias("mean_bhar"),
        (F.stddev_samp(value) / F.sqrt(F.count(F.lit(1)))).alias("se"),
        F.count(F.lit(1)).alias("n"))


def sample_identifiers(regdata: DataFrame) -> DataFrame:
    """Identifiers of the final sample sorted by (gvkey, rdq)."""
    return regdata.select("gvkey", "permno", "rdq", "datadate", "fyearq", "fqtr").orderBy("gvkey", "rdq")


def identifier_summary(regdata: DataFrame) -> DataFrame:
    """C16 summary: rows, distinct gvkey, rdq range."""
    return regdata.agg(F.count(F.lit(1)).alias("n_rows"), F.countDistinct("gvkey").alias("n_gvkey"),
                       F.min("rdq").alias("rdq_min"), F.max("rdq").alias("rdq_max"))
