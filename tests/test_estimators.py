"""Estimator identities against numpy on small unbalanced panels."""

import math

import numpy as np
import pytest

from panora.functions.dist import betainc, f_sf, t_ppf, t_sf2
from panora.operators.estimate import areg, fit_many, grid, margins, ols, parse_terms, within


def _panel(seed=0, n_ent=12, periods=6, drop=0.25, singleton=True):
    rng = np.random.default_rng(seed)
    rows = []
    for e in range(n_ent):
        a = rng.normal()
        for t in range(1, periods + 1):
            if rng.random() < drop:
                continue
            x1 = rng.normal() + 0.3 * a
            x2 = rng.normal()
            y = 1.0 + 2.0 * x1 - 0.5 * x2 + a + 0.2 * t + rng.normal() * (1 + abs(x1))
            rows.append((e, t, float(x1), float(x2), float(y), float(e % 2)))
    if singleton:
        rows.append((n_ent, 3, 0.4, -0.2, 1.7, 1.0))
    return rows


def _frame(spark, rows):
    return spark.createDataFrame(rows, "e int, t int, x1 double, x2 double, y double, g double")


def _hc(X, y, k_extra=0):
    n, k = X.shape
    b = np.linalg.lstsq(X, y, rcond=None)[0]
    e = y - X @ b
    XtXi = np.linalg.inv(X.T @ X)
    meat = (X * e[:, None]).T @ (X * e[:, None])
    V_hc1 = n / (n - k) * XtXi @ meat @ XtXi
    V_cl = (e @ e) / (n - k) * XtXi
    return b, V_hc1, V_cl, e


def test_ols_matches_numpy(spark):
    rows = _panel()
    df = _frame(spark, rows)
    a = np.array(rows)
    X = np.column_stack([a[:, 2], a[:, 3], np.ones(len(a))])
    b, V1, Vc, _ = _hc(X, a[:, 4])
    f_cl = ols(df, "y", ["x1", "x2"], vce="classic")
    f_hc = ols(df, "y", ["x1", "x2"], vce="robust")
    assert np.allclose(f_cl.coef, b, atol=1e-9)
    assert np.allclose(np.sqrt(np.diag(f_cl.vcov)), np.sqrt(np.diag(Vc)), rtol=1e-8)
    assert np.allclose(np.sqrt(np.diag(f_hc.vcov)), np.sqrt(np.diag(V1)), rtol=1e-8)
    assert f_cl.df_r == len(a) - 3


def _lsdv(a, cols, time_fe=False):
    ents = sorted(set(a[:, 0].astype(int)))
    D = np.column_stack([(a[:, 0] == e).astype(float) for e in ents])
    parts = [a[:, c] for c in cols]
    if time_fe:
        ts = sorted(set(a[:, 1].astype(int)))[1:]
        parts += [(a[:, 1] == t).astype(float) for t in ts]
    X = np.column_stack(parts + [D])
    return X, len(ents)


def test_areg_equals_dummy_regression(spark):
    rows = _panel(1)
    df = _frame(spark, rows)
    a = np.array(rows)
    X, G = _lsdv(a, [2, 3])
    b, V1, _, e = _hc(X, a[:, 4])
    fit = areg(df, "y", ["x1", "x2"], absorb="e")
    n = len(a)
    assert fit.n_groups == G and fit.df_r == n - G - 2
    assert np.allclose(fit.coef[:2], b[:2], atol=1e-9)
    assert np.allclose(np.sqrt(np.diag(fit.vcov))[:2], np.sqrt(np.diag(V1))[:2], rtol=1e-8)
    ybar, xbar = a[:, 4].mean(), a[:, 2:4].mean(axis=0)
    assert abs(fit.coef[2] - (ybar - xbar @ b[:2])) < 1e-9
    tss = ((a[:, 4] - ybar) ** 2).sum()
    assert abs(fit.r2 - (1 - (e @ e) / tss)) < 1e-9


def test_two_way_unbalanced_equals_dummies(spark):
    rows = _panel(2, drop=0.3)
    df = _frame(spark, rows)
    a = np.array(rows)
    X, G = _lsdv(a, [2, 3], time_fe=True)
    b, V1, _, _ = _hc(X, a[:, 4])
    fit = areg(df, "y", ["x1", "x2", "i.t"], absorb="e")
    T = len(set(a[:, 1].astype(int)))
    assert fit.df_r == len(a) - G - 2 - (T - 1)
    k = 2 + T - 1
    assert np.allclose(fit.coef[:k], b[:k], atol=1e-8)
    assert np.allclose(np.sqrt(np.diag(fit.vcov))[:k], np.sqrt(np.diag(V1))[:k], rtol=1e-7)


def test_within_classic(spark):
    rows = _panel(3)
    df = _frame(spark, rows)
    a = np.array(rows)
    X, G = _lsdv(a, [2])
    b, _, Vc, _ = _hc(X, a[:, 4])
    fit = within(df, "y", ["x1"], "e")
    assert abs(fit.coef[0] - b[0]) < 1e-9
    assert abs(math.sqrt(fit.vcov[0, 0]) - math.sqrt(Vc[0, 0])) < 1e-9 * (1 + math.sqrt(Vc[0, 0]))
    assert fit.names == ["x1"]


def test_collinear_term_omitted(spark):
    rows = _panel(4)
    df = _frame(spark, rows)
    fit = areg(df, "y", ["x1", "g", "x2"], absorb="e")  # g is constant within entity
    rows_ = {r[2]: r for r in fit.table_rows()}
    assert rows_["g"][10] is True and rows_["g"][3] == 0.0
    ref = areg(df, "y", ["x1", "x2"], absorb="e")
    assert abs(rows_["x1"][3] - ref.coef[0]) < 1e-9 and abs(rows_["x2"][3] - ref.coef[1]) < 1e-9
    assert fit.k == 2 and fit.df_r == ref.df_r


def test_grid_equals_separate_fits(spark):
    rows = _panel(5)
    df = _frame(spark, rows)
    fits = grid(df, ["y", "x2"], ["g"], lambda o, m: ["x1", f"x1#{m}"], absorb="e")
    for f in fits:
        single = areg(df, f.depvar, f.terms, absorb="e")
        assert np.allclose(f.coef, single.coef, atol=1e-9)
        assert np.allclose(f.vcov, single.vcov, atol=1e-9)


def test_margins_saturated_are_cell_means(spark):
    rows = _panel(6, drop=0.0, singleton=False)
    df = _frame(spark, rows)
    fit = ols(df, "y", ["g##i.t"], vce="robust")
    got = {(t, g): m for t, g, m, *_ in margins(df, fit, {"t": [1, 2, 3], "g": [0.0, 1.0]})}
    a = np.array(rows)
    for (t, g), m in got.items():
        sel = (a[:, 1] == t) & (a[:, 5] == g)
        assert abs(m - a[sel, 4].mean()) < 1e-8


def test_wald_matches_formula(spark):
    rows = _panel(7)
    df = _frame(spark, rows)
    fit = areg(df, "y", ["x1", "x2"], absorb="e", tests=[("both", ["x1", "x2"])])
    b, V = fit.coef[:2], fit.vcov[:2, :2]
    f = float(b @ np.linalg.solve(V, b)) / 2
    assert abs(fit.tests[0]["f"] - f) < 1e-9 * f
    assert abs(fit.f - f) < 1e-9 * f  # overall F = joint test of all slopes


def test_parse_terms():
    names = [t.name for t in parse_terms(["a##b", "i.t", "c.x#i.t"], {"t": [1, 2, 3]})]
    assert names == ["a", "b", "a#b", "2.t", "3.t", "x#2.t", "x#3.t"]


def test_distribution_tails():
    assert abs(t_sf2(2.0, 10) - 0.073388) < 1e-6
    assert abs(t_ppf(0.975, 10) - 2.228139) < 1e-6
    assert abs(f_sf(3.0, 2, 20) - 0.072538) < 1e-6
    assert abs(betainc(2.0, 3.0, 0.4) - 0.5248) < 1e-4


def test_date_and_string_factor_levels(spark):
    import datetime as dt
    rows = _panel(8, drop=0.0, singleton=False)
    base = dt.date(2020, 1, 1)
    df = spark.createDataFrame([(e, base + dt.timedelta(days=t), f"g'{t % 3}", x1, y) for e, t, x1, _, y, _ in rows],
                               "e int, d date, s string, x1 double, y double")
    f1 = areg(df, "y", ["x1", "i.d"], absorb="e")
    f2 = areg(df, "y", ["x1", "i.s"], absorb="e")
    assert f1.names[0] == "x1" and len(f1.names) == 2 + 5 and f2.df_r > 0


def test_replicated_panel_same_slopes(spark):
    from pyspark.sql import functions as F
    rows = _panel(9)
    df = _frame(spark, rows)
    big = df.withColumn("r", F.explode(F.sequence(F.lit(0), F.lit(9)))) \
        .select((F.col("e") + F.col("r") * 1000).cast("int").alias("e"), "t", "x1", "x2", "y", "g")
    small = areg(df, "y", ["x1", "x2", "i.t"], absorb="e")
    large = areg(big, "y", ["x1", "x2", "i.t"], absorb="e")
    assert np.allclose(small.coef[:2], large.coef[:2], atol=1e-9)
    assert large.n_groups == 10 * small.n_groups and large.n == 10 * small.n
    assert abs(small.r2 - large.r2) < 1e-9


def test_event_study_group_path(spark):
    from panora.operators.estimate import event_study
    rows = _panel(10, drop=0.0, singleton=False)
    df = _frame(spark, rows)
    from pyspark.sql import functions as F
    df = df.withColumn("t0", F.when(F.col("e") % 3 == 0, None).otherwise(F.lit(3))) \
           .withColumn("b1", F.coalesce((F.col("t") - F.col("t0") == -1).cast("int"), F.lit(0))) \
           .withColumn("a0", F.coalesce((F.col("t") - F.col("t0") == 0).cast("int"), F.lit(0)))
    fit, path = event_study(df, "y", ["b1", "a0"], absorb="e", group="g", event_times=[-1, 0])
    ref = areg(df, "y", ["b1", "a0", "b1#g", "a0#g"], absorb="e")
    got = {(s, t): c for s, t, _, c, *_ in path}
    assert abs(got[("base", 0)] - ref.coef[1]) < 1e-9 and abs(got[("diff", -1)] - ref.coef[2]) < 1e-9


def test_pearson_and_welch_p_values(spark):
    from panora.operators.profile import pearson, welch_test
    xs = [1.0, 2.0, 3.0, 4.0, 5.0, 6.0, 7.0, 8.0, 9.0, 10.0]
    ys = [2.0, 1.0, 4.0, 3.0, 7.0, 5.0, 6.0, 9.0, 8.0, 10.0]
    df = spark.createDataFrame(list(zip(xs, ys)), "x double, y double")
    r = np.corrcoef(xs, ys)[0, 1]
    t = r * math.sqrt(8 / (1 - r * r))
    row = [q for q in pearson(df, ["x", "y"]).collect() if q.var1 == "x" and q.var2 == "y"][0]
    assert abs(row.r - r) < 1e-12 and abs(row.p - t_sf2(t, 8)) < 1e-12 and row.n == 10
    g = spark.createDataFrame([(1, v) for v in [5.1, 4.9, 6.2, 5.8, 6.0]] + [(0, v) for v in [4.1, 4.4, 3.9, 4.8]],
                              "grp int, v double")
    w = welch_test(g, "grp", ["v"]).first()
    a, b = np.array([5.1, 4.9, 6.2, 5.8, 6.0]), np.array([4.1, 4.4, 3.9, 4.8])
    s1, s2 = a.var(ddof=1) / 5, b.var(ddof=1) / 4
    tt = (a.mean() - b.mean()) / math.sqrt(s1 + s2)
    dfw = (s1 + s2) ** 2 / (s1 ** 2 / 4 + s2 ** 2 / 3)
    assert abs(w.t - tt) < 1e-9 and abs(w.df - dfw) < 1e-9 and abs(w.p - t_sf2(tt, dfw)) < 1e-12
