"""Regression against dense numpy: FE via dummies, CRV1 one- and two-way by hand."""

import numpy as np
import pandas as pd
import pytest

from panelspark.operators import regression as R


def _data(n=400, seed=0):
    rng = np.random.default_rng(seed)
    df = pd.DataFrame({"f1": rng.integers(0, 6, n), "f2": rng.integers(0, 4, n), "c1": rng.integers(0, 15, n),
                       "x": rng.normal(size=n), "z": rng.integers(0, 2, n)})
    df["y"] = 0.5 * df.x - 0.3 * df.z + 0.2 * df.x * df.z + 0.1 * df.f1 - 0.2 * df.f2 + rng.normal(size=n)
    return df


def _crv(X, e, groups):
    meat = np.zeros((X.shape[1], X.shape[1]))
    for g in np.unique(groups):
        s = (X[groups == g] * e[groups == g, None]).sum(0)
        meat += np.outer(s, s)
    return meat


def test_two_fe_two_way_cluster_matches_dummies(spark):
    pdf = _data()
    fit = R.ols(spark.createDataFrame(pdf), "y", ["x*z"], absorb=["f1", "f2"], cluster=["c1", "f1"])
    D = pd.get_dummies(pdf[["f1", "f2"]].astype(str), drop_first=False).to_numpy(float)
    X = np.column_stack([pdf.x, pdf.z, pdf.x * pdf.z])
    full = np.column_stack([X, D])
    beta_full, *_ = np.linalg.lstsq(full, pdf.y.to_numpy(), rcond=None)
    e = pdf.y.to_numpy() - full @ beta_full
    # FWL: residualise X on the dummies
    P = D @ np.linalg.pinv(D)
    Xt = X - P @ X
    bread = np.linalg.inv(Xt.T @ Xt)
    n, k = len(pdf), 3
    g1, g2 = pdf.c1.nunique(), pdf.f1.nunique()
    G = min(g1, g2)
    inter = pdf.c1.astype(str) + "_" + pdf.f1.astype(str)
    meat = _crv(Xt, e, pdf.c1.to_numpy()) + _crv(Xt, e, pdf.f1.to_numpy()) - _crv(Xt, e, inter.to_numpy())
    V = G / (G - 1) * (n - 1) / (n - k) * bread @ meat @ bread
    assert fit.coef.estimate.to_numpy() == pytest.approx(beta_full[:3], rel=1e-8, abs=1e-10)
    # an indefinite two-way covariance gives NaN standard errors on both sides
    assert fit.coef.std_error.to_numpy() == pytest.approx(np.sqrt(np.diag(V)), rel=1e-8, nan_ok=True)
    sst_w = ((pdf.y - P @ pdf.y) ** 2).sum()
    assert fit.stats["r2_within"] == pytest.approx(1 - (e ** 2).sum() / sst_w, rel=1e-9)


def test_no_fe_iid_and_intercept(spark):
    pdf = _data(200, 1)
    fit = R.ols(spark.createDataFrame(pdf), "y", ["x"])
    X = np.column_stack([np.ones(len(pdf)), pdf.x])
    b, *_ = np.linalg.lstsq(X, pdf.y, rcond=None)
    e = pdf.y - X @ b
    V = (e @ e) / (len(pdf) - 2) * np.linalg.inv(X.T @ X)
    assert list(fit.coef.term) == ["Intercept", "x"]
    assert fit.coef.estimate.to_numpy() == pytest.approx(b, rel=1e-9)
    assert fit.coef.std_error.to_numpy() == pytest.approx(np.sqrt(np.diag(V)), rel=1e-9)


def test_collinear_term_dropped(spark):
    pdf = _data(100, 2)
    pdf["x2"] = 2 * pdf.x
    fit = R.ols(spark.createDataFrame(pdf), "y", ["x", "x2"], absorb=["f1"])
    assert fit.dropped == ["x2"] and list(fit.coef.term) == ["x"]


def test_t_distribution_helpers():
    assert R.t_sf2(1.959963984540054, 1e9) == pytest.approx(0.05, rel=1e-6)
    assert R.t_ppf(0.975, 10) == pytest.approx(2.2281388519649385, rel=1e-9)
    assert R.t_sf2(2.2281388519649385, 10) == pytest.approx(0.05, rel=1e-9)


def test_expand_terms():
    assert R.expand_terms(["sue*same_sign", "sue*loss"]) == [("sue",), ("same_sign",), ("sue", "same_sign"),
                                                            ("loss",), ("sue", "loss")]


def test_group_slopes_ci(spark):
    pdf = _data(300, 4)
    got = R.group_slopes(spark.createDataFrame(pdf), "y", "x", ["z"]).toPandas().set_index("z")
    for z, sub in pdf.groupby("z"):
        X = np.column_stack([np.ones(len(sub)), sub.x])
        b, *_ = np.linalg.lstsq(X, sub.y, rcond=None)
        e = sub.y - X @ b
        se = np.sqrt((e @ e) / (len(sub) - 2) * np.linalg.inv(X.T @ X)[1, 1])
        assert got.loc[z, "estimate"] == pytest.approx(b[1], rel=1e-9)
        assert got.loc[z, "conf_high"] - got.loc[z, "estimate"] == pytest.approx(R.t_ppf(0.975, len(sub) - 2) * se,
                                                                                 rel=1e-7)


def test_singletons_removed_iteratively(spark):
    rows = [(1, "a", "x", 1.0, 0.5), (2, "a", "x", 2.0, 0.1), (3, "a", "y", 3.0, 0.9), (4, "b", "y", 4.0, 0.3),
            (5, "c", "z", 5.0, 0.2), (6, "a", "x", 1.5, 0.7)]
    df = spark.createDataFrame(rows, "id int, f1 string, f2 string, y double, x double")
    kept = sorted(r.id for r in R.drop_singletons(df, ["f1", "f2"]).collect())
    # c/z are singletons; dropping b leaves y with one row (id 3), which then goes too
    assert kept == [1, 2, 6]


def test_large_fe_block_elimination_matches_dense(spark):
    rng = np.random.default_rng(11)
    n = 1500
    pdf = pd.DataFrame({"firm": rng.integers(0, 300, n), "year": rng.integers(0, 12, n),
                        "ind": rng.integers(0, 5, n), "x": rng.normal(size=n)})
    pdf["y"] = 0.7 * pdf.x + 0.01 * pdf.firm + 0.1 * pdf.year + rng.normal(size=n)
    fit = R.ols(spark.createDataFrame(pdf), "y", ["x"], absorb=["firm", "year", "ind"], cluster=["firm"])
    D = pd.get_dummies(pdf[["firm", "year", "ind"]].astype(str)).to_numpy(float)
    full = np.column_stack([pdf.x, D])
    b, *_ = np.linalg.lstsq(full, pdf.y.to_numpy(), rcond=None)
    assert fit.coef.estimate.iloc[0] == pytest.approx(b[0], rel=1e-8)
    e = pdf.y.to_numpy() - full @ b
    xt = pdf.x.to_numpy() - D @ np.linalg.lstsq(D, pdf.x.to_numpy(), rcond=None)[0]
    meat = sum(((xt[pdf.firm == g] * e[pdf.firm == g]).sum()) ** 2 for g in np.unique(pdf.firm))
    G = pdf.firm.nunique()
    V = G / (G - 1) * (n - 1) / (n - 1) * meat / (xt @ xt) ** 2
    assert fit.coef.std_error.iloc[0] == pytest.approx(np.sqrt(V), rel=1e-7)


def test_nan_rows_are_dropped_like_null(spark):
    rows = [(1.0, 1.0), (2.0, 2.0), (float("nan"), 3.0), (4.0, 4.0), (7.0, float("nan")), (6.5, 6.0)]
    clean = [r for r in rows if r[0] == r[0] and r[1] == r[1]]
    fits = [R.ols(spark.createDataFrame(x, "y double, x double"), "y", ["x"]) for x in (rows, clean)]
    assert str(fits[0]) == str(fits[1])


def test_singletons_peel_to_nothing_in_a_chain(spark):
    chain = spark.createDataFrame([(i // 2, (i + 1) // 2) for i in range(30)], "a int, b int")
    assert R.drop_singletons(chain, ["a", "b"]).count() == 0


def plain_absorb(groups, values):
    """Least-squares fit of level effects, by conjugate gradients on the stacked dummies in numpy."""
    sizes = [g.max() + 1 for g in groups]
    offs = np.concatenate([[0], np.cumsum(sizes)])
    count = np.concatenate([np.bincount(g, minlength=s) for g, s in zip(groups, sizes)])

    def down(v):
        return np.concatenate([np.bincount(g, weights=v, minlength=s) for g, s in zip(groups, sizes)])

    def up(u):
        return sum(u[o:o + s][g] for g, s, o in zip(groups, sizes, offs))

    u, r = np.zeros(len(count)), down(values)
    z = r / count
    d, rho, first = z, r @ z, r @ z
    while rho > 1e-26 * first:
        ad = down(up(d))
        step = rho / (d @ ad)
        u, r = u + step * d, r - step * ad
        z = r / count
        rho, old = r @ z, rho
        d = z + rho / old * d
    return up(u)


def test_sparsely_connected_fixed_effects(spark, monkeypatch):
    """Two FEs whose levels meet about twice each: few rounds, slopes and errors as by a plain solve."""
    rng = np.random.default_rng(5)
    n, levels = 27_000, 9_000
    f, g, c = rng.integers(0, levels, n), rng.integers(0, levels, n), rng.integers(0, 400, n)
    f, g = np.unique(f, return_inverse=True)[1], np.unique(g, return_inverse=True)[1]
    x = rng.normal(size=n) + rng.normal(size=levels)[f]
    y = 0.7 * x + rng.normal(size=levels)[f] - 2 * rng.normal(size=levels)[g] + rng.normal(size=n)
    df = spark.createDataFrame(pd.DataFrame({"f": f, "g": g, "c": c, "x": x, "y": y})).repartition(4)
    made = []
    real = R.reliable_checkpoint
    monkeypatch.setattr(R, "reliable_checkpoint", lambda d: made.append(1) or real(d))
    fit = R.ols(df, "y", ["x"], absorb=["f", "g"], cluster=["c"])
    assert len(made) - 3 < 50  # one per round, and three before and after
    yt, xt = y - plain_absorb([f, g], y), x - plain_absorb([f, g], x)
    beta = (xt @ yt) / (xt @ xt)
    score = np.bincount(c, weights=xt * (yt - beta * xt))
    want = np.sqrt(400 / 399 * (n - 1) / (n - 1) * (score @ score)) / (xt @ xt)
    assert fit.coef.estimate[0] == pytest.approx(beta, rel=1e-9)
    assert fit.coef.std_error[0] == pytest.approx(want, rel=1e-7)


def test_models_of_one_fe_set_equal_single_fits(spark):
    pdf = _data(500, 8)
    pdf.loc[pdf.index[:7], "x"] = np.nan
    pdf["w"] = pdf.x * 0 + np.arange(len(pdf)) % 7
    pdf["v"] = np.where(np.arange(len(pdf)) % 50 == 0, np.nan, pdf.w)
    df = spark.createDataFrame(pdf)
    models = {"a": {"terms": ["x"]}, "b": {"terms": ["x*z"], "absorb": ["f1"]}, "c": {"terms": ["x*z", "w"], "absorb": ["f1", "f2"]},
              "d": {"terms": ["x"], "absorb": ["f1", "f2"]}, "e": {"terms": ["x", "v"], "absorb": ["f1"]}, "f": {"terms": ["x*z"]}}
    for cluster in (["c1", "f1"],):
        both = R.ols_models(df, "y", models, cluster=cluster)
        assert list(both) == list(models)
        for name, spec in models.items():
            one = R.ols(df, "y", spec["terms"], absorb=spec.get("absorb"), cluster=cluster)
            pd.testing.assert_frame_equal(both[name].coef, one.coef, rtol=1e-8)
            assert both[name].stats["nobs"] == one.stats["nobs"] and both[name].stats["r2"] == pytest.approx(one.stats["r2"], rel=1e-10)
    assert both["e"].stats["nobs"] < both["b"].stats["nobs"] == 493


def test_nested_effects_count_once(spark):
    """An FE inside the clusters counts as one parameter, others by their levels."""
    pdf = _data(600, 9)
    pdf["firm"] = pdf.c1 * 5 + np.arange(len(pdf)) % 5
    df = spark.createDataFrame(pdf)
    D = pd.get_dummies(pdf[["firm", "f1"]].astype(str)).to_numpy(float)
    full = np.column_stack([pdf.x, D])
    b, *_ = np.linalg.lstsq(full, pdf.y.to_numpy(), rcond=None)
    e = pdf.y.to_numpy() - full @ b
    xt = pdf.x.to_numpy() - D @ np.linalg.lstsq(D, pdf.x.to_numpy(), rcond=None)[0]
    meat = sum((xt[pdf.c1 == g] @ e[pdf.c1 == g]) ** 2 for g in np.unique(pdf.c1))
    G, n, firms, f1 = pdf.c1.nunique(), len(pdf), pdf.firm.nunique(), pdf.f1.nunique()
    for kind, k in (("none", 1), ("full", 1 + firms + f1 - 1), ("nested", 1 + 1 + f1 - 1)):
        fit = R.ols(df, "y", ["x"], absorb=["firm", "f1"], cluster=["c1"], fixef_k=kind)
        assert fit.stats["k"] == k
        assert fit.coef.std_error[0] == pytest.approx(np.sqrt(G / (G - 1) * (n - 1) / (n - k) * meat) / (xt @ xt), rel=1e-8)
    assert R.nested_effects(df, ["firm", "f1"], ["c1", "f2"]) == ["firm"]


def test_indefinite_covariance_can_be_repaired(spark):
    for seed in range(30):
        pdf = _data(60, 100 + seed)
        df = spark.createDataFrame(pdf)
        plain = R.ols(df, "y", ["x*z"], cluster=["f1", "f2"])
        values, vectors = np.linalg.eigh(plain.vcov)
        if values.min() < -1e-9:
            break
    fixed = R.ols(df, "y", ["x*z"], cluster=["f1", "f2"], repair=True)
    assert fixed.vcov == pytest.approx((vectors * np.maximum(values, 0)) @ vectors.T, abs=1e-12)
    assert np.linalg.eigvalsh(fixed.vcov).min() > -1e-12 and fixed.coef.std_error.notna().all()


def test_fixed_effect_with_600000_levels(spark):
    from pyspark.sql import functions as F
    df = spark.range(1_200_000).select((F.col("id") % 600_000).alias("firm"), F.rand(1).alias("x"), F.rand(2).alias("e"))
    df = df.withColumn("y", 2 * F.col("x") + F.col("firm") % 97 + F.col("e"))
    fit = R.ols(df, "y", ["x"], absorb=["firm"])
    assert fit.stats["nobs"] == 1_200_000 and fit.coef.estimate[0] == pytest.approx(2.0, abs=0.01)


def test_fit_rows_are_the_callers(spark):
    from panelspark.operators.regression import ols_models, regression_table
    df = spark.range(200).selectExpr("cast(id AS double) AS x", "id % 7 + 2.0D * id AS y", "id % 5 AS g")
    fits = ols_models(df, "y", {"a": dict(terms=["x"]), "b": dict(terms=["x"], absorb=["g"])}, cluster=[])
    rows = {"cases": lambda f: f"n={int(f.stats['nobs'])}", "within": lambda f: "-" if np.isnan(f.stats["r2_within"]) else "yes"}
    got = {(r["model"], r["row"]): r["value"] for r in regression_table(spark, fits, ["x"], fit_rows=rows).collect()}
    assert got["a", "cases"] == "n=200" and (got["a", "within"], got["b", "within"]) == ("-", "yes") and ("a", "N") not in got
    assert ("a", "N") in {(r["model"], r["row"]) for r in regression_table(spark, fits, ["x"]).collect()}
