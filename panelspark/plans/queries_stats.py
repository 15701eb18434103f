"""Registered queries: transforms, quantiles, tables, correlations and regressions on the
analysis panel (``reg_panel``, one row per line item) and on the pipeline output."""

from __future__ import annotations

from pyspark.sql import functions as F

from panelspark.functions import industry
from panelspark.operators import regression as R
from panelspark.operators import tables as T
from panelspark.operators import transforms as W
from panelspark.operators.quantiles import QSpec, quantiles
from panelspark.plans import bindings as B
from panelspark.plans.dense_sql import coefficients_sql, dense_ols_sql, fit_stats_sql, t_table_sql, table_sql
from panelspark.plans.queries_panel import FF12_NAME_SQL
from panelspark.plans.jobs import MODELS, SHOWN_TERMS, model_markers
from panelspark.plans.registry import register

ROW_KEY = ["obs_id", "obs_line", "obs_part", "obs_supp"]
VARS = ["bhar", "sue", "same_sign", "loss", "log_mve"]
EPS4 = "4.440892098500626e-16"


def _q(x: float) -> str:
    return f"CAST({x!r} AS DOUBLE)"


def _pick(r: str) -> str:
    return f"max(CASE WHEN r = {r} THEN v END)"


def _value_sql(q: float, rule: str) -> str:
    """Quantile value over a ranked group (columns v, r 0-based, n) — the same rules as ST1."""
    h = f"((n - 1) * {_q(q)})"
    if rule == "lower":
        return _pick(f"floor({h})")
    if rule == "higher":
        return _pick(f"ceil({h})")
    if rule == "nearest":
        return _pick(f"floor({h} + 0.5)")
    if rule == "linear":
        lo, hi = _pick(f"floor({h})"), _pick(f"least(floor({h}) + 1, n - 1)")
        return f"({lo} + ({h} - floor({h})) * ({hi} - {lo}))"
    if rule == "type2":
        m = f"(n * {_q(q)})"
        j = f"floor({m} + {EPS4})"
        lo = f"least(greatest(CASE WHEN {m} > {j} THEN {j} ELSE {j} - 1 END, 0), n - 1)"
        hi = f"least(greatest({j}, 0), n - 1)"
        return f"(CASE WHEN {m} > {j} THEN {_pick(lo)} ELSE ({_pick(lo)} + {_pick(hi)}) / 2.0 END)"
    raise ValueError(rule)


def cuts_sql(src: str, col: str, specs: list[tuple[float, str, str]], by: list[str] | None = None) -> str:
    """SELECT by..., <alias> ... : exact quantiles of ``col`` by explicit ranks."""
    by = by or []
    part = f"PARTITION BY {', '.join(by)} " if by else ""
    bsel = "".join(f"{b}, " for b in by)
    vals = ", ".join(f"{_value_sql(q, rule)} AS {alias}" for q, rule, alias in specs)
    return (f"SELECT {bsel}{vals} FROM (SELECT {bsel}{col} AS v, "
            f"row_number() OVER ({part}ORDER BY {col}) - 1 AS r, count(*) OVER ({part.strip()}) AS n "
            f"FROM {src} WHERE {col} IS NOT NULL) GROUP BY {bsel}n")


def _panel(spark, sf_dir):
    return B.reg_panel(spark, sf_dir)


# ---- winsorize / truncate / standardize ------------------------------------------------------

@register("winsorize_lower_higher", f"""WITH
c1 AS ({cuts_sql('reg_panel', 'sue', [(0.01, 'lower', 'lo'), (0.99, 'higher', 'hi')])}),
c2 AS ({cuts_sql('reg_panel', 'log_mve', [(0.01, 'lower', 'lo'), (0.99, 'higher', 'hi')])})
SELECT obs_id, obs_line, obs_part, obs_supp,
  CASE WHEN sue IS NULL THEN NULL WHEN sue >= c1.hi THEN c1.hi WHEN sue <= c1.lo THEN c1.lo ELSE sue END AS sue,
  CASE WHEN log_mve IS NULL THEN NULL WHEN log_mve >= c2.hi THEN c2.hi WHEN log_mve <= c2.lo THEN c2.lo
       ELSE log_mve END AS log_mve
FROM reg_panel, c1, c2""", ["sue", "log_mve"])
def q_winsorize(spark, sf_dir):
    return W.winsorize(_panel(spark, sf_dir), ["sue", "log_mve"]).select(*ROW_KEY, "sue", "log_mve")


@register("winsorize_type2", f"""WITH c AS ({cuts_sql('reg_panel', 'bhar', [(0.01, 'type2', 'lo'), (0.99, 'type2', 'hi')])})
SELECT obs_id, obs_line, obs_part, obs_supp,
  CASE WHEN bhar IS NULL THEN NULL WHEN bhar >= c.hi THEN c.hi WHEN bhar <= c.lo THEN c.lo ELSE bhar END AS bhar
FROM reg_panel, c""", ["bhar"])
def q_winsorize_type2(spark, sf_dir):
    return W.winsorize(_panel(spark, sf_dir), "bhar", 0.01, 0.99, rule="type2").select(*ROW_KEY, "bhar")


@register("winsorize_by_year", f"""WITH c AS ({cuts_sql('reg_panel', 'bhar', [(0.05, 'lower', 'lo'), (0.95, 'higher', 'hi')], ['fyearq'])})
SELECT p.obs_id, p.obs_line, p.obs_part, p.obs_supp, p.fyearq,
  CASE WHEN bhar IS NULL THEN NULL WHEN bhar >= c.hi THEN c.hi WHEN bhar <= c.lo THEN c.lo ELSE bhar END AS bhar
FROM reg_panel p JOIN c ON p.fyearq = c.fyearq""", ["bhar"])
def q_winsorize_by_year(spark, sf_dir):
    return W.winsorize(_panel(spark, sf_dir), "bhar", 0.05, 0.95, by=["fyearq"]).select(*ROW_KEY, "fyearq", "bhar")


@register("winsorize_one_sided", f"""WITH c AS ({cuts_sql('reg_panel', 'bhar', [(0.99, 'type2', 'hi')])})
SELECT obs_id, obs_line, obs_part, obs_supp, CASE WHEN bhar IS NULL THEN NULL WHEN bhar >= c.hi THEN c.hi ELSE bhar END AS bhar
FROM reg_panel, c""", ["bhar"])
def q_winsorize_one_sided(spark, sf_dir):
    return W.winsorize(_panel(spark, sf_dir), "bhar", None, 0.99, rule="type2").select(*ROW_KEY, "bhar")


@register("truncate", f"""WITH c AS ({cuts_sql('reg_panel', 'bhar', [(0.01, 'type2', 'lo'), (0.99, 'type2', 'hi')])})
SELECT obs_id, obs_line, obs_part, obs_supp, CASE WHEN bhar >= c.hi OR bhar <= c.lo THEN NULL ELSE bhar END AS bhar
FROM reg_panel, c""", ["bhar"])
def q_truncate(spark, sf_dir):
    return W.truncate(_panel(spark, sf_dir), "bhar", 0.01, 0.99).select(*ROW_KEY, "bhar")


@register("standardize", """
SELECT obs_id, obs_line, obs_part, obs_supp, (log_mve - avg(log_mve) OVER ()) / stddev_samp(log_mve) OVER () AS log_mve_std FROM reg_panel""",
          ["log_mve_std"])
def q_standardize(spark, sf_dir):
    return W.standardize(_panel(spark, sf_dir), "log_mve", suffix="_std").select(*ROW_KEY, "log_mve_std")


@register("standardize_by_year", """
SELECT obs_id, obs_line, obs_part, obs_supp, fyearq, (bhar - avg(bhar) OVER w) / stddev_samp(bhar) OVER w AS bhar_std
FROM reg_panel WINDOW w AS (PARTITION BY fyearq)""", ["bhar_std"])
def q_standardize_by_year(spark, sf_dir):
    return W.standardize(_panel(spark, sf_dir), "bhar", by=["fyearq"], suffix="_std").select(
        *ROW_KEY, "fyearq", "bhar_std")


# ---- n-tiles and quantile bins ---------------------------------------------------------------

@register("ntile_global", """
SELECT obs_id, obs_line, obs_part, obs_supp, CAST(ntile(10) OVER (ORDER BY log_mve, obs_id, obs_line, obs_part, obs_supp) AS INTEGER) AS decile FROM reg_panel""")
def q_ntile_global(spark, sf_dir):
    return W.ntile(_panel(spark, sf_dir), "log_mve", 10, "decile", tiebreak=ROW_KEY).select(*ROW_KEY, "decile")


@register("ntile_by_year", """
SELECT obs_id, obs_line, obs_part, obs_supp, fyearq,
       CAST(ntile(5) OVER (PARTITION BY fyearq ORDER BY log_mve, obs_id, obs_line, obs_part, obs_supp) AS INTEGER) AS size_qnt
FROM reg_panel""")
def q_ntile_by_year(spark, sf_dir):
    return W.ntile(_panel(spark, sf_dir), "log_mve", 5, "size_qnt", by=["fyearq"], tiebreak=ROW_KEY).select(
        *ROW_KEY, "fyearq", "size_qnt")


def _qcut_sql(n: int, by: list[str] | None = None) -> str:
    specs = [(i / n, "linear", f"b{i}") for i in range(1, n)]
    above = " + ".join(f"CAST(log_mve > c.b{i} AS INTEGER)" for i in range(1, n))
    join = " JOIN c ON " + " AND ".join(f"p.{b} = c.{b}" for b in by) if by else ", c"
    bsel = "".join(f"p.{b}, " for b in by or [])
    return (f"WITH c AS ({cuts_sql('reg_panel', 'log_mve', specs, by)}) SELECT p.*, "
            f"CASE WHEN log_mve IS NULL THEN NULL ELSE CAST(1 + {above} AS INTEGER) END AS bin "
            f"FROM reg_panel p{join}")


def _qcut_out(n: int, by: list[str] | None = None) -> str:
    cols = ", ".join(["obs_id", "obs_line", "obs_part", "obs_supp", *(by or []), "bin"])
    return f"SELECT {cols} FROM ({_qcut_sql(n, by)})"


@register("qcut_global", _qcut_out(10))
def q_qcut_global(spark, sf_dir):
    return W.qcut(_panel(spark, sf_dir), "log_mve", 10, "bin").select(*ROW_KEY, "bin")


@register("qcut_by_year", _qcut_out(5, ["fyearq"]))
def q_qcut_by_year(spark, sf_dir):
    return W.qcut(_panel(spark, sf_dir), "log_mve", 5, "bin", by=["fyearq"]).select(*ROW_KEY, "fyearq", "bin")


_QSPECS = [(q, r, f"{r}_{str(q).replace('.', '_')}") for q in (0.0, 0.01, 0.25, 0.5, 0.75, 0.99, 1.0)
           for r in ("lower", "higher", "nearest", "linear", "type2")]


@register("quantile_rules", cuts_sql("reg_panel", "bhar", _QSPECS, ["fyearq"]), [a for _, _, a in _QSPECS])
def q_quantile_rules(spark, sf_dir):
    return quantiles(_panel(spark, sf_dir), [QSpec("bhar", q, r, a) for q, r, a in _QSPECS], by=["fyearq"])


# ---- descriptive tables ----------------------------------------------------------------------

def _desc_sql() -> str:
    parts = []
    for i, v in enumerate(VARS):
        c = cuts_sql("reg_panel", v, [(0.25, "nearest", "p25"), (0.5, "linear", "med"), (0.75, "nearest", "p75")])
        parts.append(f"""SELECT '{v}' AS Variable, m.*, c.* FROM
          (SELECT count({v}) AS N, avg({v}) AS Mean, stddev_samp({v}) AS SD, CAST(min({v}) AS DOUBLE) AS Min,
                  CAST(max({v}) AS DOUBLE) AS Max FROM reg_panel) m, ({c}) c""")
    body = " UNION ALL ".join(parts)
    return f"SELECT Variable, N, Mean, SD, Min, p25 AS P25, med AS Median, p75 AS P75, Max FROM ({body})"


@register("descriptives", _desc_sql(), ["Mean", "SD", "Min", "P25", "Median", "P75", "Max"])
def q_descriptives(spark, sf_dir):
    return T.descriptives(_panel(spark, sf_dir), VARS)


def _corr_sql(spearman: bool) -> str:
    src = "reg_panel"
    if spearman:
        ranks = ", ".join(f"rank() OVER (ORDER BY {v}) + (count(*) OVER (PARTITION BY {v}) - 1) / 2.0 AS {v}_rk"
                          for v in VARS)
        src = f"(SELECT *, {ranks} FROM reg_panel)"
    rows = []
    for i, a in enumerate(VARS):
        cells = []
        for j, b in enumerate(VARS):
            if i == j:
                cells.append(f"CAST(1.0 AS DOUBLE) AS {b}")
            elif spearman and j < i:
                cells.append(f"corr({a}_rk, {b}_rk) AS {b}")
            else:
                cells.append(f"corr({a}, {b}) AS {b}")
        rows.append(f"SELECT '{a}' AS variable, {', '.join(cells)} FROM {src}")
    return " UNION ALL ".join(rows)


@register("pearson_matrix", _corr_sql(False), VARS)
def q_pearson(spark, sf_dir):
    return T.pearson_matrix(_panel(spark, sf_dir), VARS)


@register("pearson_spearman", _corr_sql(True), VARS)
def q_pearson_spearman(spark, sf_dir):
    return T.pearson_spearman(_panel(spark, sf_dir), VARS, ROW_KEY)


_DECADE_SQL = """CASE WHEN fyearq >= 2020 THEN '2020+' WHEN fyearq BETWEEN 2010 AND 2019 THEN '2010 - 2019'
  WHEN fyearq BETWEEN 2000 AND 2009 THEN '2000 - 2009' WHEN fyearq BETWEEN 1990 AND 1999 THEN '1990 - 1999'
  WHEN fyearq BETWEEN 1980 AND 1989 THEN '1980 - 1989' WHEN fyearq BETWEEN 1970 AND 1979 THEN '1970 - 1979' END"""


@register("freq_decade_total", f"""
SELECT coalesce(Year, 'Total') AS Year, count(*) AS firm_quarters, CAST(sum(same_sign) AS BIGINT) AS flag_quarters,
       avg(same_sign) AS pct_flag
FROM (SELECT {_DECADE_SQL} AS Year, same_sign FROM reg_panel) GROUP BY ROLLUP (Year)""", ["pct_flag"])
def q_freq_decade(spark, sf_dir):
    return T.freq_by_decade(_panel(spark, sf_dir), "fyearq", "same_sign")


@register("crosstab_pct", f"""
SELECT coalesce(Year, 'Total') AS Year, CAST(count(*) FILTER (WHERE same_sign = 0) AS BIGINT) AS n_0,
       CAST(count(*) FILTER (WHERE same_sign = 1) AS BIGINT) AS n_1, count(*) AS total,
       count(*) FILTER (WHERE same_sign = 0) * 100.0 / count(*) AS pct_0,
       count(*) FILTER (WHERE same_sign = 1) * 100.0 / count(*) AS pct_1
FROM (SELECT {_DECADE_SQL} AS Year, same_sign FROM reg_panel) GROUP BY ROLLUP (Year)""", ["pct_0", "pct_1"])
def q_crosstab(spark, sf_dir):
    from panelspark.functions.scalar import decade_label
    df = _panel(spark, sf_dir).withColumn("Year", decade_label("fyearq"))
    return T.crosstab(df, "Year", "same_sign", [0, 1])


_FLAG = "CASE l_returnflag WHEN 'R' THEN 1 WHEN 'A' THEN 0 END"


@register("flag_frequency", f"""
SELECT flag, count(*) AS n, count(*) * 100.0 / (SELECT count(*) FROM lineitem) AS pct
FROM (SELECT CAST({_FLAG} AS INTEGER) AS flag FROM lineitem) GROUP BY flag""", ["pct"])
def q_flag_frequency(spark, sf_dir):
    return T.flag_frequency(B.table(spark, sf_dir, "lineitem").select(F.expr(_FLAG).cast("int").alias("flag")), "flag")


@register("formatted_counts", f"""
SELECT 'flag' AS variable, format('{{:,}}', count({_FLAG})) AS count FROM lineitem
UNION ALL SELECT 'rows', format('{{:,}}', count(l_orderkey)) FROM lineitem
UNION ALL SELECT 'nothing', format('{{:,}}', count(*)) FROM lineitem""")
def q_formatted_counts(spark, sf_dir):
    df = B.table(spark, sf_dir, "lineitem").select(
        F.expr(_FLAG).alias("flag"), F.col("l_orderkey").alias("rows"), F.lit(None).cast("boolean").alias("nothing"))
    return T.formatted_counts(df, ["flag", "rows", "nothing"])


@register("flag_rate_by_industry", f"""
SELECT FF12, pct_same_sign, n, CAST(row_number() OVER (ORDER BY pct_same_sign, FF12) AS INTEGER) AS sort_rank FROM (
  SELECT {FF12_NAME_SQL} AS FF12, avg(same_sign) AS pct_same_sign, count(*) AS n FROM reg_panel GROUP BY 1)""",
          ["pct_same_sign"])
def q_flag_rate_by_industry(spark, sf_dir):
    df = _panel(spark, sf_dir).select("same_sign", *industry.ff12("siccd"))
    return T.flag_rate_by_industry(df).withColumn("sort_rank", F.col("sort_rank").cast("int"))


@register("flag_rate_year_size", f"""WITH b AS ({_qcut_sql(5, ['fyearq'])})
SELECT fyearq, bin AS size_qnt, avg(same_sign) AS pct_same_sign, count(*) AS n
FROM b WHERE bin IS NOT NULL GROUP BY 1, 2""", ["pct_same_sign"])
def q_flag_rate_year_size(spark, sf_dir):
    return T.flag_rate_year_size(_panel(spark, sf_dir), size="log_mve")


@register("flag_rate_year_size_ntile", """
SELECT fyearq, size_qnt, avg(same_sign) AS pct_same_sign, count(*) AS n FROM (
  SELECT fyearq, same_sign, CAST(ntile(5) OVER (PARTITION BY fyearq ORDER BY log_mve, obs_id, obs_line, obs_part, obs_supp) AS INTEGER)
         AS size_qnt FROM reg_panel) GROUP BY 1, 2""", ["pct_same_sign"])
def q_flag_rate_year_size_ntile(spark, sf_dir):
    return T.flag_rate_year_size(_panel(spark, sf_dir), size="log_mve", method="ntile", tiebreak=ROW_KEY)


@register("decile_means", f"""WITH b AS ({_qcut_sql(10).replace('log_mve', 'sue')})
SELECT bin, avg(bhar) AS mean_bhar, count(*) AS n FROM b WHERE bin IS NOT NULL GROUP BY 1""", ["mean_bhar"])
def q_decile_means(spark, sf_dir):
    return T.decile_means(_panel(spark, sf_dir), "sue", "bhar", 10).filter(F.col("bin").isNotNull())


# ---- regressions -----------------------------------------------------------------------------

def _coef_frame(spark, fit, cols=("term", "estimate", "std_error")):
    return fit.coef_frame(spark).select(*cols)


_SIMPLE_SQL = """WITH s AS (SELECT regr_slope(bhar, sue) AS b, regr_intercept(bhar, sue) AS a, count(*) AS n,
  regr_sxx(bhar, sue) AS sxx, avg(sue) AS mx FROM reg_panel),
e AS (SELECT sum((bhar - a - b * sue) * (bhar - a - b * sue)) AS sse FROM reg_panel, s)
SELECT 'Intercept' AS term, a AS estimate, sqrt(sse / (n - 2) * (1.0 / n + mx * mx / sxx)) AS std_error FROM s, e
UNION ALL SELECT 'sue', b, sqrt(sse / (n - 2) / sxx) FROM s, e"""


@register("ols_simple", _SIMPLE_SQL, sig=["estimate", "std_error"])
def q_ols_simple(spark, sf_dir):
    return _coef_frame(spark, R.ols(_panel(spark, sf_dir), "bhar", ["sue"]))


@register("ols_interaction", """WITH g AS (SELECT same_sign, regr_slope(bhar, sue) AS b, regr_intercept(bhar, sue) AS a
  FROM reg_panel GROUP BY same_sign),
z AS (SELECT * FROM g WHERE same_sign = 0), o AS (SELECT * FROM g WHERE same_sign = 1)
SELECT 'Intercept' AS term, z.a AS estimate FROM z UNION ALL SELECT 'sue', z.b FROM z
UNION ALL SELECT 'same_sign', o.a - z.a FROM z, o UNION ALL SELECT 'sue:same_sign', o.b - z.b FROM z, o""", ["estimate"])
def q_ols_interaction(spark, sf_dir):
    return _coef_frame(spark, R.ols(_panel(spark, sf_dir), "bhar", ["sue*same_sign"]), ("term", "estimate"))


@register("ols_one_fe", """
SELECT 'sue' AS term, regr_slope(bhar - avg(bhar) OVER w, sue - avg(sue) OVER w) AS estimate
FROM reg_panel WINDOW w AS (PARTITION BY fyearq)""".replace(
    "regr_slope(bhar - avg(bhar) OVER w, sue - avg(sue) OVER w)", "regr_slope(yd, xd)").replace(
    "FROM reg_panel WINDOW w AS (PARTITION BY fyearq)",
    "FROM (SELECT bhar - avg(bhar) OVER w AS yd, sue - avg(sue) OVER w AS xd FROM reg_panel "
    "WINDOW w AS (PARTITION BY fyearq))"), ["estimate"])
def q_ols_one_fe(spark, sf_dir):
    return _coef_frame(spark, R.ols(_panel(spark, sf_dir), "bhar", ["sue"], absorb=["fyearq"]), ("term", "estimate"))


@register("ols_entity_fe", """
SELECT 'sue' AS term, regr_slope(yd, xd) AS estimate,
       sqrt((regr_syy(yd, xd) - regr_sxy(yd, xd) * regr_sxy(yd, xd) / regr_sxx(yd, xd))
            / (count(*) - 1 - count(DISTINCT obs_part)) / regr_sxx(yd, xd)) AS std_error
FROM (SELECT obs_part, bhar - avg(bhar) OVER w AS yd, sue - avg(sue) OVER w AS xd FROM reg_panel
      WINDOW w AS (PARTITION BY obs_part))""", sig=["estimate", "std_error"])
def q_ols_entity_fe(spark, sf_dir):
    return _coef_frame(spark, R.ols(_panel(spark, sf_dir), "bhar", ["sue"], absorb=["obs_part"], fixef_k="full"))


def _cluster_sql(clusters: list[str]) -> str:
    """Two-parameter (intercept, sue) CRV1 errors; two dimensions use V1 + V2 - V12 with G = min."""
    meats = []
    for name, keys in ([("m1", [clusters[0]])] + ([("m2", [clusters[1]]), ("m12", clusters)] if len(clusters) == 2
                                                   else [])):
        k = ", ".join(keys)
        meats.append(f"""{name} AS (SELECT count(*) AS g, sum(s0 * s0) AS a00, sum(s0 * s1) AS a01, sum(s1 * s1) AS a11
          FROM (SELECT sum(e) AS s0, sum(sue * e) AS s1 FROM r GROUP BY {k}))""")
    if len(clusters) == 2:
        msum = ("(m1.a00 + m2.a00 - m12.a00) AS a00, (m1.a01 + m2.a01 - m12.a01) AS a01, "
                "(m1.a11 + m2.a11 - m12.a11) AS a11, least(m1.g, m2.g) AS g FROM m1, m2, m12")
    else:
        msum = "m1.a00, m1.a01, m1.a11, m1.g FROM m1"
    return f"""SELECT term, estimate, CASE WHEN var >= 0 THEN sqrt(var) END AS std_error FROM (
WITH s AS (SELECT regr_slope(bhar, sue) AS b, regr_intercept(bhar, sue) AS a, count(*) AS n,
  sum(sue) AS sx, sum(sue * sue) AS sxx FROM reg_panel),
r AS (SELECT p.*, bhar - s.a - s.b * sue AS e FROM reg_panel p, s),
{', '.join(meats)},
m AS (SELECT {msum}),
v AS (SELECT (m.g / (m.g - 1.0)) * ((s.n - 1.0) / (s.n - 2.0)) / power(s.n * s.sxx - s.sx * s.sx, 2) AS c,
        s.*, m.a00, m.a01, m.a11 FROM s, m)
SELECT 'Intercept' AS term, a AS estimate, c * (sxx * sxx * a00 - 2 * sxx * sx * a01 + sx * sx * a11) AS var FROM v
UNION ALL SELECT 'sue', b, c * (sx * sx * a00 - 2 * sx * n * a01 + n * n * a11) FROM v)"""


@register("cluster_oneway", _cluster_sql(["permno"]), sig=["estimate", "std_error"])
def q_cluster_oneway(spark, sf_dir):
    return _coef_frame(spark, R.ols(_panel(spark, sf_dir), "bhar", ["sue"], cluster=["permno"]))


@register("cluster_twoway", _cluster_sql(["permno", "fyearq"]), sig=["estimate", "std_error"])
def q_cluster_twoway(spark, sf_dir):
    return _coef_frame(spark, R.ols(_panel(spark, sf_dir), "bhar", ["sue"], cluster=["permno", "fyearq"]))


_STD = "(SELECT *, (log_mve - avg(log_mve) OVER ()) / stddev_samp(log_mve) OVER () AS log_mve_std FROM reg_panel)"
_MODEL_SQL = {name: dense_ols_sql("bhar", [":".join(t) for t in R.expand_terms(m["terms"])], m.get("absorb", []), ["permno", "fyearq"], _STD)
              for name, m in MODELS.items()}


@register("ols_two_fe", coefficients_sql(_MODEL_SQL["Two-Way FE"]), ["p_value"], sig=["estimate", "std_error", "t_stat"])
def q_ols_two_fe(spark, sf_dir):
    fit = R.ols(_panel(spark, sf_dir), "bhar", ["sue*same_sign"], absorb=["fyearq", "ff12num"],
                cluster=["permno", "fyearq"])
    return fit.coef_frame(spark)


def regression_models(spark, df, cluster=("permno", "fyearq")):
    cols = ["bhar", "sue", "same_sign", "loss", "log_mve", "fyearq", "ff12num", *cluster]
    df = W.standardize(df.select(*dict.fromkeys(cols)), "log_mve", suffix="_std")
    # five models read the same narrow panel: keep it once (recomputed from lineage if lost)
    df = df.persist()
    try:
        return R.ols_models(df, "bhar", MODELS, cluster=list(cluster))
    finally:
        df.unpersist()


@register("cluster_nested_fe", "SELECT term, estimate, std_error FROM (" + dense_ols_sql("bhar", ["sue", "same_sign"], ["fyearq"], ["fyearq"], "reg_panel", "nested") + ")",
          sig=["estimate", "std_error"])
def q_cluster_nested_fe(spark, sf_dir):
    """Errors clustered by the absorbed year, whose levels then count as one parameter (ST7)."""
    return _coef_frame(spark, R.ols(_panel(spark, sf_dir), "bhar", ["sue", "same_sign"], absorb=["fyearq"], cluster=["fyearq"], fixef_k="nested"))


@register("regression_table", table_sql(_MODEL_SQL, SHOWN_TERMS, model_markers(MODELS)))
def q_regression_table(spark, sf_dir):
    fits = regression_models(spark, _panel(spark, sf_dir))
    return R.regression_table(spark, fits, SHOWN_TERMS, markers=model_markers(MODELS))


@register("regression_fit_stats", fit_stats_sql(_MODEL_SQL), sig=["r2", "r2_within"])
def q_regression_fit_stats(spark, sf_dir):
    return R.fit_table(spark, regression_models(spark, _panel(spark, sf_dir)))


_ERC_SQL = """
SELECT fyearq, same_sign, regr_slope(bhar, sue) AS estimate, regr_intercept(bhar, sue) AS intercept,
       regr_count(bhar, sue) AS n,
       CASE WHEN regr_count(bhar, sue) > 2 THEN sqrt((regr_syy(bhar, sue) - regr_sxy(bhar, sue) * regr_sxy(bhar, sue)
            / regr_sxx(bhar, sue)) / ((regr_count(bhar, sue) - 2) * regr_sxx(bhar, sue))) END AS std_error
FROM reg_panel GROUP BY fyearq, same_sign"""


@register("erc_by_group", _ERC_SQL, ["estimate", "intercept", "std_error"])
def q_erc_by_group(spark, sf_dir):
    return R.group_slopes(_panel(spark, sf_dir), "bhar", "sue", ["fyearq", "same_sign"]).select(
        "fyearq", "same_sign", "estimate", "intercept", "n", "std_error")


@register("erc_ci", f"""SELECT e.*, estimate - t * std_error AS conf_low, estimate + t * std_error AS conf_high
FROM ({_ERC_SQL}) e LEFT JOIN ({t_table_sql("SELECT count(*) - 2 AS df FROM reg_panel GROUP BY fyearq, same_sign HAVING count(*) > 2", [0.95])}) q ON q.df = e.n - 2""",
          sig=["estimate", "intercept", "std_error", "conf_low", "conf_high"])
def q_erc_ci(spark, sf_dir):
    return R.group_slopes(_panel(spark, sf_dir), "bhar", "sue", ["fyearq", "same_sign"])


@register("fama_macbeth", """
SELECT same_sign, avg(b) AS mean, stddev_samp(b) / sqrt(count(b)) AS std_error, count(b) AS periods FROM (
  SELECT fyearq, same_sign, regr_slope(bhar, sue) AS b FROM reg_panel GROUP BY 1, 2) GROUP BY same_sign""",
          ["mean", "std_error"])
def q_fama_macbeth(spark, sf_dir):
    slopes = R.group_slopes(_panel(spark, sf_dir), "bhar", "sue", ["fyearq", "same_sign"])
    return R.fama_macbeth(slopes, by=["same_sign"])


@register("singletons_dropped", """SELECT * EXCLUDE (i, n, before) FROM (WITH RECURSIVE core AS (
  SELECT 0 AS i, o_orderkey AS id, o_custkey AS entity, o_orderdate::DATE AS day, count(*) OVER () AS n, NULL::BIGINT AS before FROM orders
  UNION ALL
  SELECT i + 1, id, entity, day, count(*) OVER (), n
  FROM (SELECT *, count(*) OVER (PARTITION BY entity) AS a, count(*) OVER (PARTITION BY day) AS b FROM core)
  WHERE a > 1 AND b > 1 AND n IS DISTINCT FROM before)
SELECT * FROM core WHERE i = (SELECT max(i) FROM core))""")
def q_singletons_dropped(spark, sf_dir):
    """Orders left when customers and days with a single order go, again and again until none is left (ST8)."""
    orders = B.table(spark, sf_dir, "orders").select(F.col("o_orderkey").alias("id"), F.col("o_custkey").alias("entity"), F.to_date("o_orderdate").alias("day"))
    return R.drop_singletons(orders, ["entity", "day"]).select("id", "entity", "day")
