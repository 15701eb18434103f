"""Linear regression with interactions, absorbed fixed effects and clustered errors (ST3-ST11).

Passes over the data for all models of one FE set (distributed aggregates):

1. global means (centring keeps the sums of products accurate at scale);
2. per fixed-effect cell (one row per combination of FE levels, e.g. year x industry):
   counts, sums and cross-products of the centred variables of all models. The FEs are absorbed on
   the cell table by one distributed method at every size (``absorb_cells``);
   Frisch-Waugh-Lovell turns it into the FE-demeaned Gram matrix, of which each model solves its block;
3. residual scores x~_i e_i of all models summed per intersection of the cluster dimensions (one
   shuffle); one-way meats are sums over that table, so two-way clustering needs no
   second pass over the rows.
"""

from __future__ import annotations

import math
from collections.abc import Callable
from dataclasses import dataclass, field
from statistics import NormalDist

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from panelspark.session import reliable_checkpoint


BROADCAST_CELLS = 100_000    # most rows of the cell table that are sent to every task


@dataclass
class Fit:
    coef: pd.DataFrame          # term, estimate, std_error, t_stat, p_value
    stats: dict                 # nobs, r2, r2_within, k, n_clusters, df_t
    vcov: np.ndarray
    terms: list[str]
    dropped: list[str] = field(default_factory=list)

    def coef_frame(self, spark: SparkSession, model: str | None = None) -> DataFrame:
        pdf = self.coef.copy().astype(object).where(self.coef.notna(), None)
        if model is not None:
            pdf.insert(0, "model", model)
        return spark.createDataFrame(pdf)


# ---- distributions (driver scalars only; no SciPy here) -------------------------------------

def _betacf(a: float, b: float, x: float) -> float:
    tiny, qab, qap, qam = 1e-300, a + b, a + 1.0, a - 1.0
    c, d = 1.0, 1.0 - qab * x / qap
    d = 1.0 / (d if abs(d) > tiny else tiny)
    h = d
    for m in range(1, 400):
        m2 = 2 * m
        aa = m * (b - m) * x / ((qam + m2) * (a + m2))
        d = 1.0 + aa * d
        d = 1.0 / (d if abs(d) > tiny else tiny)
        c = 1.0 + aa / c
        c = c if abs(c) > tiny else tiny
        h *= d * c
        aa = -(a + m) * (qab + m) * x / ((a + m2) * (qap + m2))
        d = 1.0 + aa * d
        d = 1.0 / (d if abs(d) > tiny else tiny)
        c = 1.0 + aa / c
        c = c if abs(c) > tiny else tiny
        de = d * c
        h *= de
        if abs(de - 1.0) < 3e-16:
            break
    return h


def betainc(a: float, b: float, x: float) -> float:
    """Regularized incomplete beta I_x(a, b)."""
    if x <= 0.0:
        return 0.0
    if x >= 1.0:
        return 1.0
    lbt = math.lgamma(a + b) - math.lgamma(a) - math.lgamma(b) + a * math.log(x) + b * math.log1p(-x)
    if x < (a + 1.0) / (a + b + 2.0):
        return math.exp(lbt) * _betacf(a, b, x) / a
    return 1.0 - math.exp(lbt) * _betacf(b, a, 1.0 - x) / b


def t_sf2(t: float, df: float) -> float:
    """Two-sided p-value P(|T| > |t|) for Student's t."""
    if not np.isfinite(t) or df <= 0:
        return float("nan")
    return betainc(df / 2.0, 0.5, df / (df + t * t))


def t_ppf(p: float, df: float) -> float:
    """Quantile of Student's t (bisection on the two-sided tail)."""
    if df <= 0:
        return float("nan")
    tail = 2.0 * (1.0 - p) if p > 0.5 else 2.0 * p
    lo, hi = 0.0, 1e6
    for _ in range(200):
        mid = (lo + hi) / 2.0
        if t_sf2(mid, df) > tail:
            lo = mid
        else:
            hi = mid
    q = (lo + hi) / 2.0
    return q if p > 0.5 else -q


# ---- design ------------------------------------------------------------------------------------

def expand_terms(terms: list) -> list[tuple[str, ...]]:
    """Formula terms -> columns: "a*b" = a + b + a:b; tuples are interactions; order kept, no repeats."""
    out: list[tuple[str, ...]] = []

    def add(t):
        if t not in out:
            out.append(t)

    for t in terms:
        if isinstance(t, tuple):
            add(tuple(t))
        elif "*" in t:
            parts = [p.strip() for p in t.split("*")]
            for p in parts:
                add((p,))
            add(tuple(parts))
        elif ":" in t:
            add(tuple(p.strip() for p in t.split(":")))
        else:
            add((t,))
    return out


def _name(t: tuple[str, ...]) -> str:
    return ":".join(t)


def _sel_independent(xtx: np.ndarray, tol: float = 1e-10) -> list[int]:
    """Columns kept in order; a column whose residual variance given earlier kept ones is ~0 is dropped."""
    keep: list[int] = []
    for j in range(xtx.shape[0]):
        if xtx[j, j] <= 0:
            continue
        if keep:
            a = xtx[np.ix_(keep, keep)]
            b = xtx[np.ix_(keep, [j])]
            resid = xtx[j, j] - (b.T @ np.linalg.pinv(a) @ b).item()
        else:
            resid = xtx[j, j]
        if resid > tol * xtx[j, j]:
            keep.append(j)
    return keep


# ---- fixed effects ------------------------------------------------------------------------------

def absorb_cells(cells: DataFrame, fes: list[str], p: int, tol: float = 1e-10, rounds: int = 2000) -> DataFrame:
    """The cell table (``fes``, ``_n``, sums ``_s0..``) with ``_g0..``: what the fixed effects explain of each variable.

    One FE explains its level means. Of several, the one with most levels is eliminated and the
    normal equations of the others' levels are solved by conjugate gradients, preconditioned by
    their diagonal, for all variables side by side. Vectors over levels and cells stay distributed; the driver
    sees a few sums per round. A round is a join and a partial aggregate per FE, whatever the size. Ends when every variable's
    residual has fallen by ``tol``; sums of products of what is left are then exact to ``tol`` squared.
    Raises if ``rounds`` do not suffice.
    """
    v = range(p)
    if len(fes) == 1:
        return reliable_checkpoint(cells.selectExpr("*", *[f"_s{i} / _n AS _g{i}" for i in v]))
    cells = reliable_checkpoint(cells)
    counts = cells.agg(*[F.count_distinct(f).alias(f) for f in fes]).first()
    big = max(fes, key=lambda f: counts[f])
    rest = [f for f in fes if f != big]
    slim = cells.select(*fes, "_n", *[f"_s{i}" for i in v])
    # means of the eliminated FE's levels, and what they leave to the others
    mean = slim.groupBy(big).agg(F.expr("sum(_n) AS _m"), *[F.expr(f"sum(_s{i}) / sum(_n) AS _b{i}") for i in v])
    left = slim.join(mean, big)
    state = {f: reliable_checkpoint(left.groupBy(f).agg(
        F.expr("if(sum(_n - _n * _n / _m) > 1e-9 * sum(_n), sum(_n - _n * _n / _m), sum(_n)) AS _w"), *[F.expr(f"sum(_s{i} - _n * _b{i}) AS r{i}") for i in v])
        .selectExpr("*", *[f"0D AS x{i}" for i in v], *[f"r{i} / _w AS d{i}" for i in v])) for f in rest}

    def on_cells(tables: dict[str, DataFrame], name: str) -> DataFrame:
        """Cells with ``_q0..``: the sum over the FEs of their levels' values."""
        out = slim
        for k, (f, t) in enumerate(tables.items()):
            out = out.join(t.selectExpr(f, *[f"{name}{i} AS _v{k}_{i}" for i in v]), f)
        return out.selectExpr(*fes, "_n", *[f"_s{i}" for i in v], *[" + ".join(f"_v{k}_{i}" for k in range(len(tables))) + f" AS _q{i}" for i in v])

    def dots(tables: list[DataFrame], pairs: dict[str, str]) -> dict[str, float]:
        got: dict[str, float] = dict.fromkeys(pairs, 0.0)
        union = None
        for t in tables:
            part = t.agg(*[F.expr(f"sum({c}) AS {k}") for k, c in pairs.items()])
            union = part if union is None else union.unionByName(part)
        for row in union.collect():
            for k in pairs:
                got[k] += row[k] or 0.0
        return got

    first = None
    for _ in range(rounds):
        spread = on_cells(state, "d")
        centre = spread.groupBy(big).agg(*[F.expr(f"sum(_n * _q{i}) / sum(_n) AS _c{i}") for i in v])
        moved = spread.join(centre, big)
        state = {f: reliable_checkpoint(t.join(moved.groupBy(f).agg(
            *[F.expr(f"sum(_n * (_q{i} - _c{i})) AS a{i}") for i in v]), f)) for f, t in state.items()}
        got = dots(list(state.values()), {f"{k}{i}": e for i in v for k, e in (
            ("rr", f"r{i} * r{i} / _w"), ("da", f"d{i} * a{i}"), ("ra", f"r{i} * a{i} / _w"), ("aa", f"a{i} * a{i} / _w"))})
        first = first or [got[f"rr{i}"] for i in v]
        step = [got[f"rr{i}"] / got[f"da{i}"] if got[f"da{i}"] > 0 and got[f"rr{i}"] > tol * tol * first[i] else 0.0 for i in v]
        rho = [got[f"rr{i}"] - 2 * step[i] * got[f"ra{i}"] + step[i] ** 2 * got[f"aa{i}"] for i in v]
        turn = [max(rho[i], 0.0) / got[f"rr{i}"] if step[i] else 0.0 for i in v]
        state = {f: t.selectExpr(f, "_w", *[f"r{i} - {_number(step[i])} * a{i} AS r{i}" for i in v], *[f"x{i} + {_number(step[i])} * d{i} AS x{i}" for i in v],
                                 *[f"(r{i} - {_number(step[i])} * a{i}) / _w + {_number(turn[i])} * d{i} AS d{i}" for i in v]) for f, t in state.items()}
        if all(not step[i] or rho[i] <= tol * tol * first[i] for i in v):
            break
    else:
        raise RuntimeError(f"fixed effects {fes} did not settle in {rounds} rounds")
    spread = on_cells(state, "x")
    own = spread.groupBy(big).agg(*[F.expr(f"sum(_s{i} - _n * _q{i}) / sum(_n) AS _c{i}") for i in v])
    fitted = spread.join(own, big).selectExpr(*fes, *[f"_q{i} + _c{i} AS _g{i}" for i in v])
    return reliable_checkpoint(cells.join(fitted, fes))


def _number(x: float) -> str:
    """A double literal in SQL."""
    return f"({float(x)!r}D)"


def drop_singletons(df: DataFrame, absorb: list[str]) -> DataFrame:
    """Repeatedly drop rows alone in some FE level (ST8), until a round drops none.

    Each round is a group count and a semi join per FE on a reliable checkpoint, so the lineage
    does not grow with the number of rounds.
    """
    n = df.count()
    while True:
        for fe in absorb:
            keep = df.groupBy(fe).agg(F.count(F.lit(1)).alias("_c")).filter("_c > 1").select(fe)
            df = df.join(keep, on=fe, how="left_semi")
        df = reliable_checkpoint(df)
        left = df.count()
        if left == n:
            return df
        n = left


def nested_effects(df: DataFrame, absorb: list[str], cluster: list[str]) -> list[str]:
    """The FEs of which every level lies in one value of some cluster dimension."""
    out = []
    for f in absorb:
        levels = df.groupBy(f).agg(*[F.min(c).alias(f"_lo{i}") for i, c in enumerate(cluster)], *[F.max(c).alias(f"_hi{i}") for i, c in enumerate(cluster)])
        row = levels.agg(*[F.bool_and(F.col(f"_lo{i}") == F.col(f"_hi{i}")).alias(f"_in{i}") for i in range(len(cluster))]).first()
        if any(row):
            out.append(f)
    return out


# ---- estimation ---------------------------------------------------------------------------------

def _complete(df: DataFrame, used: list[str]) -> Column:
    """Rows with a value in every used column; NaN counts as missing, like NULL."""
    kinds = dict(df.dtypes)
    ok = F.lit(True)
    for c in used:
        ok = ok & F.col(c).isNotNull()
        if kinds[c] in ("double", "float"):
            ok = ok & ~F.isnan(c)
    return ok


def _pairs(n: int) -> list[tuple[int, int]]:
    return [(a, b) for a in range(n) for b in range(a, n)]


def _symmetric(row, name: str, n: int) -> np.ndarray:
    out = np.zeros((n, n))
    for a, b in _pairs(n):
        out[a, b] = out[b, a] = row[f"{name}{a}_{b}"] or 0.0
    return out


def ols(df: DataFrame, y: str, terms: list, absorb: list[str] | None = None,
        cluster: list[str] | None = None, **options) -> Fit:
    """One model of ``ols_models``."""
    return ols_models(df, y, {"": {"terms": terms, "absorb": absorb}}, cluster, **options)[""]


def ols_models(df: DataFrame, y: str, models: dict[str, dict], cluster: list[str] | None = None, singletons: bool = False,
               cluster_df: str = "min", fixef_k: str = "none", repair: bool = False) -> dict[str, Fit]:
    """OLS of ``y`` for several models ``{name: {"terms": [...], "absorb": [...]}}`` with CRV1
    errors by ``cluster`` (one or two dimensions: V = V1 + V2 - V12). No cluster: iid errors.

    Models that absorb the same FEs share their passes: one Gram matrix over all their terms, of which each
    model solves its own block, and one aggregate of all their scores. A model whose complete
    rows differ from those of its companions is fitted by itself. Rows with a NULL or NaN in any used column are
    dropped first.

    Small-sample factor (N-1)/(N-K) * G/(G-1); ``cluster_df="min"`` uses the smallest G
    for every term, ``"conventional"`` each term's own G. ``fixef_k="none"`` counts only the
    slopes in K when FEs are absorbed (the intercept counts when none are); ``"full"`` also
    counts every FE level less one per extra FE dimension; ``"nested"`` is ``"full"`` with an FE whose levels lie each in one
    cluster counted as one parameter. A two-way covariance can be indefinite: a negative variance gives no
    standard error, or with ``repair`` the negative eigenvalues are set to zero.
    """
    cluster = list(cluster or [])
    if len(cluster) > 2:
        raise ValueError("one or two cluster dimensions")
    if fixef_k not in ("none", "full", "nested"):
        raise ValueError("fixef_k must be 'none', 'full' or 'nested'")
    groups: dict[tuple[str, ...], dict[str, list]] = {}
    for name, spec in models.items():
        groups.setdefault(tuple(spec.get("absorb") or []), {})[name] = expand_terms(spec["terms"])
    used = {key: {m: sorted({c for t in tt for c in t} | {y} | set(key) | set(cluster)) for m, tt in group.items()} for key, group in groups.items()}
    if not singletons and any(len(group) > 1 for group in groups.values()):
        # models with other complete rows than their group are fitted alone
        whole = {key: sorted({c for u in own.values() for c in u}) for key, own in used.items()}
        asked = [(key, m) for key, own in used.items() for m in own]
        row = df.agg(*[F.count_if(_complete(df, used[key][m])).alias(f"m{i}") for i, (key, m) in enumerate(asked)],
                     *[F.count_if(_complete(df, u)).alias(f"g{i}") for i, u in enumerate(whole.values())]).first()
        total = {key: row[f"g{i}"] for i, key in enumerate(whole)}
        alone = [(key, m) for i, (key, m) in enumerate(asked) if row[f"m{i}"] != total[key]]
    else:
        alone = [(key, m) for key, own in used.items() if singletons and len(own) > 1 for m in own]
    parts = [(key, {m: tt for m, tt in group.items() if (key, m) not in alone}) for key, group in groups.items()]
    parts += [(key, {m: groups[key][m]}) for key, m in alone]
    fits = {}
    for key, group in parts:
        if group:
            fits.update(_fit_group(df, y, group, list(key), cluster, singletons, cluster_df, fixef_k, repair))
    return {name: fits[name] for name in models}


def _fit_group(df, y, group, absorb, cluster, singletons, cluster_df, fixef_k, repair) -> dict[str, Fit]:
    """The models of one FE set over the same rows: means, sums of products by FE cell, scores by cluster."""
    tt = list(dict.fromkeys(t for terms in group.values() for t in terms))
    xexpr = []
    for t in tt:
        e = F.col(t[0]).cast("double")
        for c in t[1:]:
            e = e * F.col(c).cast("double")
        xexpr.append(e)
    used = sorted({c for t in tt for c in t} | {y} | set(absorb) | set(cluster))
    base = df.select(*used)
    base = base.filter(_complete(base, used))
    if singletons and absorb:
        base = drop_singletons(base, absorb)
    fes, cl = [f"_fe{i}" for i in range(len(absorb))], [f"_cl{i}" for i in range(len(cluster))]
    vars_ = ["_y", *[f"_x{j}" for j in range(len(tt))]]
    p = len(vars_)
    data = base.select(F.col(y).cast("double").alias("_y"), *[e.alias(f"_x{j}") for j, e in enumerate(xexpr)],
                       *[F.col(a).alias(f) for a, f in zip(absorb, fes)], *[F.col(c).alias(f) for c, f in zip(cluster, cl)])

    # pass 1: n and means; centring keeps the sums of products accurate
    m = data.agg(F.count(F.lit(1)).alias("n"), *[F.avg(v).alias(v) for v in vars_]).first()
    n = int(m["n"])
    if n == 0:
        raise ValueError("no complete rows")
    mu = np.array([m[v] for v in vars_], dtype=float)
    cen = data.selectExpr(*[f"{v} - {_number(mu[i])} AS {v}" for i, v in enumerate(vars_)], *fes, *cl)

    # pass 2: sums of products by FE cell, less what the FEs explain (Frisch-Waugh-Lovell)
    prods = [F.expr(f"sum({vars_[a]} * {vars_[b]}) AS _p{a}_{b}") for a, b in _pairs(p)]
    counts: list[int] = []
    nested: list[str] = []
    if fes:
        cells = cen.groupBy(*fes).agg(F.count(F.lit(1)).alias("_n"), *[F.sum(v).alias(f"_s{i}") for i, v in enumerate(vars_)], *prods)
        cells = absorb_cells(cells, fes, p)
        row = cells.agg(*[F.expr(f"sum(_p{a}_{b}) AS _p{a}_{b}") for a, b in _pairs(p)],
                        *[F.expr(f"sum(_p{a}_{b} - _s{a} * _g{b} - _g{a} * _s{b} + _n * _g{a} * _g{b}) AS _w{a}_{b}") for a, b in _pairs(p)],
                        *[F.count_distinct(f).alias(f"_L{f}") for f in fes if fixef_k != "none"]).first()
        full, within = _symmetric(row, "_p", p), _symmetric(row, "_w", p)
        if fixef_k != "none":
            counts = [int(row[f"_L{f}"]) for f in fes]
        if fixef_k == "nested" and cluster:
            nested = nested_effects(cen, fes, cl)
        explained = cells.select(*fes, *[f"_g{i}" for i in range(p)])
        # few cells mean hot join keys: they go to every task; many are joined by a shuffle, split by AQE where skewed
        scored = cen.join(F.broadcast(explained) if cells.count() <= BROADCAST_CELLS else explained, fes)
        tilde = [f"{v} - _g{i} AS _t{i}" for i, v in enumerate(vars_)]
    else:
        full = within = _symmetric(cen.agg(*prods).first(), "_p", p)
        scored, tilde = cen, [f"{v} AS _t{i}" for i, v in enumerate(vars_)]

    # each model solves its block of the Gram matrix
    solved = {}
    for k, (name, terms) in enumerate(group.items()):
        at = np.array([1 + tt.index(t) for t in terms], dtype=int)
        keep = at[_sel_independent(within[np.ix_(at, at)])] if len(at) else at
        beta = np.linalg.solve(within[np.ix_(keep, keep)], within[keep, 0]) if len(keep) else np.zeros(0)
        sse = float(within[0, 0] - beta @ within[keep, 0])
        resid = " - ".join(["_t0", *[f"_t{j} * {_number(b)}" for j, b in zip(keep, beta)]]) + f" AS _e{k}"
        solved[name] = keep, beta, sse, resid, [f"_e{k}"] * (not fes) + [f"_t{j} * _e{k}" for j in keep]

    # pass 3: scores of all models by cluster, their products summed per dimension in one action
    meats: dict[str, list] = {name: [] for name in group}
    sizes: list[int] = []
    if cluster:
        score = [(name, q, c) for name, (*_, columns) in solved.items() for q, c in enumerate(columns)]
        # one step each for the demeaned variables and the residuals, so that no expression is repeated per score
        inter = scored.selectExpr(*cl, *tilde).selectExpr("*", *[s[3] for s in solved.values()])
        inter = inter.groupBy(*cl).agg(*[F.expr(f"sum({c}) AS _sc{i}") for i, (_, _, c) in enumerate(score)])
        place = {name: [i for i, s in enumerate(score) if s[0] == name] for name in group}

        def meat_row(tab: DataFrame, tag: int) -> DataFrame:
            return tab.agg(F.lit(tag).alias("_tag"), F.count(F.lit(1)).alias("_G"),
                           *[F.expr(f"sum(_sc{own[a]} * _sc{own[b]}) AS _m{k}_{a}_{b}") for k, own in enumerate(place.values()) for a, b in _pairs(len(own))])

        tabs = [inter] if len(cl) == 1 else [inter.groupBy(c).agg(*[F.expr(f"sum(_sc{i}) AS _sc{i}") for i in range(len(score))]) for c in cl] + [inter]
        union = meat_row(tabs[0], 0)
        for tag, tab in enumerate(tabs[1:], 1):
            union = union.unionByName(meat_row(tab, tag))
        rows = sorted(union.collect(), key=lambda r: r["_tag"])
        sizes = [int(r["_G"]) for r in rows]
        for k, (name, own) in enumerate(place.items()):
            meats[name] = [_symmetric(r, f"_m{k}_", len(own)) for r in rows]

    fits = {}
    for name, terms in group.items():
        keep, beta, sse, _, _ = solved[name]
        kx = len(keep)
        names = [_name(tt[j - 1]) for j in keep]
        if fes:
            bread_in = within[np.ix_(keep, keep)]
            K = kx if fixef_k == "none" else kx + sum(counts) - (len(counts) - 1) - sum(counts[fes.index(f)] - 1 for f in nested)
            shown = names
        else:
            bread_in = np.zeros((kx + 1, kx + 1))
            bread_in[0, 0] = n
            bread_in[1:, 1:] = within[np.ix_(keep, keep)]
            K = kx + 1
            shown = ["Intercept", *names]
        bread = np.linalg.inv(bread_in) if bread_in.size else bread_in
        if cluster:
            n_clusters = sizes[:len(cluster)]
            adj = (n - 1) / (n - K) if n > K else float("nan")
            V = np.zeros_like(bread)
            for tag, meat in enumerate(meats[name]):
                G = min(n_clusters) if cluster_df == "min" else sizes[tag]
                V += (-1.0 if tag == 2 else 1.0) * (G / (G - 1) if G > 1 else float("nan")) * adj * (bread @ meat @ bread)
            df_t = min(n_clusters) - 1
        else:
            V, df_t, n_clusters = (sse / (n - K) if n > K else float("nan")) * bread, n - K, []
        est = np.concatenate([[] if fes else [mu[0] - mu[keep] @ beta], beta])
        if not fes:
            # back to the uncentred intercept: a = a_c - mu_x' b  (a_c = 0 in centred data)
            T = np.eye(kx + 1)
            T[0, 1:] = -mu[keep]
            V = T @ V @ T.T
        if repair and V.size and np.isfinite(V).all():
            values, vectors = np.linalg.eigh((V + V.T) / 2)
            if values.min() < 0:
                V = (vectors * np.maximum(values, 0)) @ vectors.T
        dv = np.diag(V)
        se = np.where(dv >= 0, np.sqrt(np.abs(dv)), np.nan)
        tstat = np.divide(est, se, out=np.full_like(est, np.nan), where=se > 0)
        coef = pd.DataFrame({"term": shown, "estimate": est, "std_error": se, "t_stat": tstat, "p_value": [t_sf2(float(t), df_t) for t in tstat]})
        sst = float(full[0, 0])
        stats = {"nobs": n, "r2": 1.0 - sse / sst if sst > 0 else float("nan"),
                 "r2_within": 1.0 - sse / within[0, 0] if fes and within[0, 0] > 0 else float("nan"),
                 "k": K, "n_clusters": n_clusters, "df_t": df_t, "sse": sse}
        fits[name] = Fit(coef, stats, V, shown, [_name(t) for t in terms if 1 + tt.index(t) not in keep])
    return fits


def fit_table(spark: SparkSession, fits: dict[str, Fit]) -> DataFrame:
    """Tidy fit statistics: model, nobs, r2, r2_within."""
    rows = [(m, int(f.stats["nobs"]), float(f.stats["r2"]),
             None if math.isnan(f.stats["r2_within"]) else float(f.stats["r2_within"])) for m, f in fits.items()]
    return spark.createDataFrame(rows, "model string, nobs long, r2 double, r2_within double")


def stars(p: float, levels: tuple[float, float, float] = (0.01, 0.05, 0.1)) -> str:
    if p is None or math.isnan(p):
        return ""
    return "***" if p < levels[0] else "**" if p < levels[1] else "*" if p < levels[2] else ""


def _share(x: float) -> str:
    return "" if math.isnan(x) else f"{x:.3f}"


FIT_ROWS = {"N": lambda f: f"{int(f.stats['nobs']):,}", "R2": lambda f: _share(f.stats["r2"]),
            "R2 Within": lambda f: _share(f.stats["r2_within"])}


def regression_table(spark: SparkSession, fits: dict[str, Fit], keep: list[str],
                     markers: dict[str, list[str]] | None = None, labels: dict[str, str] | None = None,
                     fit_rows: dict[str, Callable[[Fit], str]] | None = None) -> DataFrame:
    """Long table (model, row, value, row_order): coefficient with stars, "(t)" below it,
    marker rows (FE / Controls), then the fit rows (ST10): ``fit_rows`` names them and says how a fit
    is written in each (U4), by default N, R2 and R2 within. Pivot on model to typeset."""
    labels = labels or {}
    rows = []
    for mi, (model, f) in enumerate(fits.items()):
        order = 0
        for term in keep:
            hit = f.coef[f.coef["term"] == term]
            lab = labels.get(term, term)
            if len(hit):
                r = hit.iloc[0]  # without a standard error the t line stays empty
                rows.append((model, lab, f"{r.estimate:.3f}{stars(r.p_value)}", order))
                rows.append((model, f"{lab} (t)", "" if math.isnan(r.t_stat) else f"({r.t_stat:.2f})", order + 1))
            else:
                rows.append((model, lab, "", order))
                rows.append((model, f"{lab} (t)", "", order + 1))
            order += 2
        for name, vals in (markers or {}).items():
            rows.append((model, name, vals[mi] if mi < len(vals) else "", order))
            order += 1
        for name, text in (FIT_ROWS if fit_rows is None else fit_rows).items():
            rows.append((model, name, text(f), order))
            order += 1
    return spark.createDataFrame(rows, "model string, row string, value string, row_order int")


def t_quantile(df: Column, level: float, nodes: int = 32, steps: int = 12) -> Column:
    """t with P(|T| <= t) = ``level`` for Student's t with ``df`` degrees of freedom, as an expression.

    With t = sqrt(df) tan(a), P is 2 G / sqrt(pi) times the integral of cos^(df-1) from 0 to a,
    where G = gamma((df+1)/2) / gamma(df/2). The integral is a Gauss-Legendre sum, G an asymptotic series
    shifted by 16, and a is found by Newton steps from a normal approximation below the root
    (P is concave in a, so the steps rise to it).
    """
    df = df.cast("double")
    x, w = np.polynomial.legendre.leggauss(nodes)
    rule = F.array(*[F.struct(F.lit(float((u + 1) / 2)).alias("x"), F.lit(float(v / 2)).alias("w")) for u, v in zip(x, w)])
    half, shift = df / 2, 16
    h = half + shift
    series = F.sqrt(h) * (1 - 1 / (8 * h) + 1 / (128 * h ** 2) + 5 / (1024 * h ** 3) - 21 / (32768 * h ** 4) - 399 / (262144 * h ** 5))
    g = F.aggregate(F.sequence(F.lit(0), F.lit(shift - 1)), series, lambda acc, j: acc * (half + j) / (half + j + 0.5))
    scale = 2 * g / math.sqrt(math.pi)
    z = NormalDist().inv_cdf(0.5 + level / 2)
    start = F.atan((z + (z ** 3 + z) / (4 * df)) / F.sqrt(df))

    def newton(a: Column, _: Column) -> Column:
        area = F.aggregate(rule, F.lit(0.0), lambda acc, r: acc + r["w"] * F.pow(F.cos(a * r["x"]), df - 1)) * a
        return a - (scale * area - level) / (scale * F.pow(F.cos(a), df - 1))

    return F.sqrt(df) * F.tan(F.aggregate(F.sequence(F.lit(1), F.lit(steps)), start, newton))


def group_slopes(df: DataFrame, y: str, x: str, by: list[str], level: float = 0.95) -> DataFrame:
    """Simple regression of y on x within each group (ST6): slope, intercept, n, std_error
    (iid), and the ``level`` confidence interval with t(n-2). One aggregate with the built-in
    ``regr_*`` functions and a column expression for the t quantile."""
    g = (df.filter(F.col(x).isNotNull() & F.col(y).isNotNull())
         .groupBy(*by).agg(F.regr_slope(y, x).alias("estimate"), F.regr_intercept(y, x).alias("intercept"),
                           F.regr_count(y, x).alias("n"), F.regr_sxx(y, x).alias("_sxx"),
                           F.regr_syy(y, x).alias("_syy"), F.regr_sxy(y, x).alias("_sxy")))
    se = F.sqrt(F.try_divide(F.col("_syy") - F.try_divide(F.col("_sxy") * F.col("_sxy"), F.col("_sxx")),
                             (F.col("n") - 2).cast("double") * F.col("_sxx")))
    g = g.withColumn("std_error", F.when(F.col("n") > 2, se)).drop("_sxx", "_syy", "_sxy")

    g = g.withColumn("_tq", F.when(F.col("n") > 2, t_quantile(F.col("n") - 2, level)))
    return (g.withColumn("conf_low", F.col("estimate") - F.col("_tq") * F.col("std_error"))
            .withColumn("conf_high", F.col("estimate") + F.col("_tq") * F.col("std_error")).drop("_tq"))


def fama_macbeth(slopes: DataFrame, value: str = "estimate", by: list[str] | None = None) -> DataFrame:
    """Average of per-period coefficients and its standard error sd / sqrt(T) (ST11)."""
    by = list(by or [])
    aggs = [F.avg(value).alias("mean"), (F.stddev_samp(value) / F.sqrt(F.count(value))).alias("std_error"),
            F.count(value).alias("periods")]
    return slopes.groupBy(*by).agg(*aggs) if by else slopes.agg(*aggs)
