"""DuckDB twins of the regressions, written without the library's algebra: every fixed effect is a set
of dummy columns, the normal equations are swept column by column in a recursive query, standard errors come from
the scores of all columns, and Student's t from Simpson's rule."""

from __future__ import annotations


def t_mass_sql(t: str, df: str, parts: int = 400) -> str:
    """P(|T| <= t) as an expression: Simpson's rule on cos^(df-1) up to atan(t / sqrt(df))."""
    a = f"atan(({t}) / sqrt({df}))"
    weight = f"CASE WHEN i IN (0, {parts}) THEN 1 WHEN i % 2 = 1 THEN 4 ELSE 2 END"
    area = f"list_sum(list_transform(range(0, {parts + 1}), lambda i: ({weight}) * power(cos({a} * i / {parts}), ({df}) - 1))) * {a} / {3 * parts}"
    return f"(2 / sqrt(pi()) * exp(lgamma((({df}) + 1) / 2.0) - lgamma(({df}) / 2.0)) * {area})"


def t_table_sql(dfs: str, levels: list[float]) -> str:
    """(df, level, t): quantiles of the degrees of freedom that ``dfs`` (a SELECT of df) lists, by bisection."""
    rows = ", ".join(f"({x!r}::DOUBLE)" for x in levels)
    return f"""SELECT df, level, hi AS t FROM (WITH RECURSIVE b AS (
  SELECT df, level, 0.0::DOUBLE AS lo, 4096.0::DOUBLE AS hi, 0 AS round FROM (SELECT DISTINCT df::DOUBLE AS df FROM ({dfs})), (VALUES {rows}) l(level)
  UNION ALL
  SELECT df, level, CASE WHEN low THEN (lo + hi) / 2 ELSE lo END, CASE WHEN low THEN hi ELSE (lo + hi) / 2 END, round + 1
  FROM (SELECT *, {t_mass_sql('(lo + hi) / 2', 'df')} < level AS low FROM b WHERE round < 60))
SELECT * FROM b WHERE round = 60)"""


def dense_ols_sql(y: str, terms: list[str], effects: list[str], clusters: list[str], src: str, count_effects: str = "none") -> str:
    """SELECT of ``term, estimate, std_error, df_t, nobs, r2, r2_within, place`` for one model.

    ``count_effects`` as the library's ``fixef_k``; "nested" here means that all effects are nested.
    """
    effects_sql = [f"SELECT o, '0 {e}=' || {e} AS c, 1.0::DOUBLE AS v FROM o" for e in effects] or ["SELECT o, '0 Intercept' AS c, 1.0::DOUBLE AS v FROM o"]
    terms_sql = [f"SELECT o, '{i + 1} {t}' AS c, ({t.replace(':', '*')})::DOUBLE AS v FROM o" for i, t in enumerate(terms)]
    dims = [[c] for c in clusters] + ([clusters] if len(clusters) == 2 else [])
    meats = " UNION ALL ".join(
        f"SELECT {-1 if i == 2 else 1} AS sign, {i} AS dim, count(*) AS groups, j, sum(s * s) AS v FROM (SELECT j, sum(s) AS s FROM score GROUP BY j, {', '.join(d)}) GROUP BY j"
        for i, d in enumerate(dims))
    shown = "NOT starts_with(c, '0 ')" if effects else "true"
    levels = " + ".join(f"(SELECT count(DISTINCT {e}) FROM o)" for e in effects) or "0"
    extra = {"none": "0" if effects else "0", "full": f"{levels} - {len(effects) - 1}" if effects else "0", "nested": "1"}[count_effects]
    return f"""SELECT * FROM (WITH RECURSIVE o AS (SELECT row_number() OVER () AS o, * FROM {src}),
z AS ({' UNION ALL '.join(effects_sql + terms_sql)}),
cols AS (SELECT c, CAST(row_number() OVER (ORDER BY c) AS INTEGER) AS k FROM (SELECT DISTINCT c FROM z)),
wide AS (SELECT o, k, v FROM z JOIN cols USING (c) UNION ALL SELECT o, (SELECT CAST(count(*) + 1 AS INTEGER) FROM cols), {y} FROM o),
ks AS (SELECT DISTINCT k FROM wide),
cross_sum AS (SELECT a.k AS i, b.k AS j, sum(a.v * b.v) AS v FROM wide a JOIN wide b USING (o) GROUP BY a.k, b.k),
grid AS (SELECT a.k AS i, b.k AS j, coalesce(x.v, 0.0) AS v FROM ks a CROSS JOIN ks b LEFT JOIN cross_sum x ON x.i = a.k AND x.j = b.k),
lines AS (SELECT i, list_concat(list(v ORDER BY j), list(CASE WHEN i = j THEN 1.0::DOUBLE ELSE 0.0::DOUBLE END ORDER BY j)) AS r, max(CASE WHEN i = j THEN v END) AS d FROM grid GROUP BY i),
sweep AS (
  SELECT 1 AS k, list(r ORDER BY i) AS m, list(d ORDER BY i) AS d, []::DOUBLE[] AS used, []::DOUBLE[] AS left_ FROM lines
  UNION ALL
  SELECT k + 1, CASE WHEN m[k][k] <= 1e-9 * d[k] THEN m ELSE
      list_transform(m, lambda line, i: CASE WHEN i = k THEN list_transform(line, lambda x: x / m[k][k])
        ELSE list_transform(line, lambda x, j: x - line[k] / m[k][k] * m[k][j]) END) END,
    d, list_append(used, CASE WHEN m[k][k] <= 1e-9 * d[k] THEN 0.0 ELSE 1.0 END), list_append(left_, m[len(m)][len(m)])
  FROM sweep WHERE k < len(m)),
done AS (SELECT m, used, len(m) AS y FROM sweep WHERE k = len(m)),
start AS (SELECT list_append(left_, m[len(m)][len(m)]) AS left_, m[len(m)][len(m)] AS sse FROM sweep WHERE k = len(m)),
sol AS (SELECT c, k, used[k] * m[k][y] AS b, used[k] AS kept FROM cols, done),
inv AS (SELECT a.c AS j, b.k, a.kept * b.kept * m[a.k][y + b.k] AS v FROM sol a, sol b, done WHERE a.{shown.replace('NOT starts_with(c', 'kept > 0 AND NOT starts_with(a.c') if effects else 'kept > 0'}),
res AS (SELECT o, any_value({y}) - sum(v * b) AS e, {', '.join(f'any_value(o.{c}) AS {c}' for c in clusters)} FROM o JOIN wide USING (o) JOIN sol USING (k) GROUP BY o),
score AS (SELECT inv.j, {', '.join(f'res.{c}' for c in clusters)}, sum(wide.v * res.e * inv.v) AS s
          FROM wide JOIN res USING (o) JOIN inv ON inv.k = wide.k GROUP BY inv.j, {', '.join(f'res.{c}' for c in clusters)}),
meat AS ({meats}),
tot AS (SELECT count(*) AS n, sum({y} * {y}) - sum({y}) * sum({y}) / count(*) AS sst FROM o),
small AS (SELECT min(groups) AS g FROM meat WHERE dim < 2),
par AS (SELECT count(DISTINCT j) + {extra} AS kx FROM inv),
spread AS (SELECT j, sum(sign * v) AS v FROM meat GROUP BY j)
SELECT substr(c, 3) AS term, b AS estimate, CASE WHEN v >= 0 THEN sqrt(v * g / (g - 1.0) * (n - 1.0) / (n - kx)) END AS std_error, g - 1 AS df_t, n AS nobs,
       1 - sse / sst AS r2, {f"1 - sse / left_[(SELECT count(*) + 1 FROM cols WHERE starts_with(c, '0 '))]" if effects else 'NULL::DOUBLE'} AS r2_within, k AS place
FROM sol JOIN spread ON spread.j = sol.c, tot, small, par, start)"""


def coefficients_sql(model: str) -> str:
    """``term, estimate, std_error, t_stat, p_value`` of a ``dense_ols_sql`` model."""
    return f"""SELECT term, estimate, std_error, estimate / std_error AS t_stat,
       CASE WHEN std_error > 0 THEN 1 - {t_mass_sql('abs(estimate / std_error)', 'df_t')} END AS p_value FROM ({model})"""


def fit_stats_sql(models: dict[str, str]) -> str:
    return " UNION ALL ".join(f"SELECT DISTINCT '{name}' AS model, nobs, r2, r2_within FROM ({sql})" for name, sql in models.items())


def table_sql(models: dict[str, str], keep: list[str], markers: dict[str, list[str]]) -> str:
    """The long regression table: ``model, row, value, row_order``."""
    parts = []
    for at, (name, sql) in enumerate(models.items()):
        rows = [f"SELECT '{t}' AS row, coalesce((SELECT format('{{:.3f}}', estimate) || CASE WHEN p_value < 0.01 THEN '***' WHEN p_value < 0.05 THEN '**' "
                f"WHEN p_value < 0.1 THEN '*' ELSE '' END FROM c WHERE term = '{t}'), '') AS value, {2 * i} AS row_order UNION ALL "
                f"SELECT '{t} (t)', coalesce((SELECT '(' || format('{{:.2f}}', t_stat) || ')' FROM c WHERE term = '{t}'), ''), {2 * i + 1}" for i, t in enumerate(keep)]
        order = 2 * len(keep)
        for label, marks in markers.items():
            rows.append(f"SELECT '{label}', '{marks[at]}', {order}")
            order += 1
        rows.append(f"SELECT DISTINCT 'N', format('{{:,}}', nobs), {order} FROM d")
        rows.append(f"SELECT DISTINCT 'R2', format('{{:.3f}}', r2), {order + 1} FROM d")
        rows.append(f"SELECT DISTINCT 'R2 Within', coalesce(format('{{:.3f}}', r2_within), ''), {order + 2} FROM d")
        parts.append(f"SELECT '{name}' AS model, row, value, CAST(row_order AS INTEGER) AS row_order FROM (WITH d AS ({sql}), c AS ({coefficients_sql('SELECT * FROM d')}) {' UNION ALL '.join(rows)})")
    return " UNION ALL ".join(parts)
