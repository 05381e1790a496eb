"""Two absorbed effects: dummy regressions as the check, on every route."""

import contextlib
import datetime as dt
import io

import numpy as np
import pytest
from pyspark.sql import functions as F

from panora.operators import effects
from panora.operators import estimate as E

SCHEMA = "e int, t int, x1 double, x2 double, y double, g double"


def panel(seed=0, entities=9, periods=7, drop=0.35, apart=False):
    rng = np.random.default_rng(seed)
    rows = []
    for e in range(entities):
        for t in range(1, periods + 1):
            if rng.random() < drop or (apart and (e < 4) != (t < 4)):
                continue
            for _ in range(rng.integers(1, 3)):           # some cells hold two rows
                x1, x2 = rng.normal(size=2) + 0.3 * e
                y = 1 + 2 * x1 - 0.5 * x2 + e + 0.2 * t * t + rng.normal() * (1 + abs(x1))
                rows.append((e, 2 * t, float(x1), float(x2), float(y), float(e % 2)))
    return rows


def dummies(rows, vce, x=(2, 3), y=4, bases=None):
    """Slopes, constant, their variances, df, rank of the effects and the period effects of the
    regression on all indicators (minimum base periods left out)."""
    a = np.array(rows, float)
    es, ts = sorted(set(a[:, 0])), sorted(set(a[:, 1]))
    bases = bases or [ts[0]]
    kept = [t for t in ts if t not in bases]
    n = len(a)
    # entity effects as deviations with weighted mean 0: the constant is that of areg
    D = np.column_stack([a[:, 0] == e for e in es]).astype(float)
    X = np.column_stack([a[:, list(x)], *[(a[:, 1] == t).astype(float) for t in kept], D])
    b = np.linalg.lstsq(X, a[:, y], rcond=None)[0]
    r = a[:, y] - X @ b
    rank = np.linalg.matrix_rank(X)
    P = np.linalg.pinv(X)                               # rows: influence of every coefficient
    nx = len(x)
    cons = a[:, y].mean() - a[:, list(x)].mean(axis=0) @ b[:nx] - sum((a[:, 1] == t).mean() * b[nx + i] for i, t in enumerate(kept))
    pc = np.full(n, 1 / n) - a[:, list(x)].mean(axis=0) @ P[:nx] - sum((a[:, 1] == t).mean() * P[nx + i] for i, t in enumerate(kept))
    A = np.vstack([P[:nx], pc])
    df = n - rank
    V = n / df * (A * r ** 2) @ A.T if vce == "robust" else r @ r / df * A @ A.T
    return np.append(b[:nx], cons), V, df, dict(zip(kept, b[nx:nx + len(kept)])), r


ROUTES = {"matrix": {}, "swapped": {}, "gradients": {"DENSE_LEVELS": 3}, "one matrix a pass": {"DENSE_CELLS": 1}}


@pytest.mark.parametrize("route, vce", [("matrix", "robust"), ("matrix", "classic"), ("swapped", "robust"),
                                        ("swapped", "classic"), ("gradients", "robust"), ("one matrix a pass", "classic")])
def test_equals_dummy_regression(spark, monkeypatch, route, vce):
    for k, v in ROUTES[route].items():
        monkeypatch.setattr(effects, k, v)
    rows = panel(1, *((4, 15) if route == "swapped" else (9, 7)))
    df = spark.createDataFrame(rows, SCHEMA)
    b, V, df_r, periods, r = dummies(rows, vce)
    fit = E.areg(df, "y", ["x1", "x2"], absorb="e", vce=vce, time="t")
    assert fit.coef == pytest.approx(b, rel=1e-8) and fit.vcov == pytest.approx(V, rel=1e-7, abs=1e-12)
    assert fit.df_r == df_r and fit.names == ["x1", "x2", "_cons"]
    listed = E.areg(df, "y", ["x1", "x2", "i.t"], absorb="e", vce=vce)
    assert (fit.n, fit.n_groups, fit.df_r, fit.k) == (listed.n, listed.n_groups, listed.df_r, listed.k)
    for what in ("r2", "r2_adj", "r2_within", "rmse"):
        assert getattr(fit, what) == pytest.approx(getattr(listed, what), rel=1e-9)
    if route != "gradients":
        assert dict(fit.effects) == pytest.approx({2: 0.0, **periods}, rel=1e-7, abs=1e-9)


@pytest.mark.parametrize("route", ["matrix", "swapped", "gradients"])
def test_panel_in_two_unconnected_parts(spark, monkeypatch, route):
    for k, v in ROUTES[route].items():
        monkeypatch.setattr(effects, k, v)
    rows = panel(2, 9, 15 if route == "swapped" else 7, 0.1, apart=True)
    df = spark.createDataFrame(rows, SCHEMA)
    last = max(r[1] for r in rows)
    b, V, df_r, _, _ = dummies(rows, "robust", bases=[2, last])
    fit = E.areg(df, "y", ["x1", "x2"], absorb="e", time="t")
    assert fit.df_r == df_r
    assert fit.coef == pytest.approx(b, rel=1e-8) and fit.vcov == pytest.approx(V, rel=1e-7, abs=1e-12)


@pytest.mark.parametrize("route", ["matrix", "swapped"])
def test_terms_that_period_effects_hold(spark, route):
    """As with listed periods: the term comes first and a period is left out for it."""
    rows = panel(3, *((4, 15) if route == "swapped" else (9, 7)))
    df = spark.createDataFrame(rows, SCHEMA).withColumn("late", (F.col("t") > 6).cast("double")).withColumn("trend", F.col("t") * 0.1)
    for terms in (["x1", "late", "g"], ["x1", "trend", "late"]):
        fit, listed = (E.areg(df, "y", [*terms, *more], absorb="e", time=time) for more, time in (([], "t"), (["i.t"], None)))
        k = len(terms)
        assert fit.omitted[:k] == listed.omitted[:k] and (fit.df_r, fit.k) == (listed.df_r, listed.k)
        assert fit.coef == pytest.approx(np.append(listed.coef[:k], listed.coef[-1]), rel=1e-7, abs=1e-9)
        at = [*range(k), len(listed.coef) - 1]
        assert fit.vcov == pytest.approx(listed.vcov[np.ix_(at, at)], rel=1e-6, abs=1e-10)
    many = E.fit_many(df, [("a", "y", ["x1"]), ("b", "y", ["x1", "late"])], absorb="e", time="t")
    assert [f.model_id for f in many] == ["a", "b"] and many[0].coef == pytest.approx(
        E.areg(df, "y", ["x1"], "e", time="t").coef, rel=1e-9) and not many[1].omitted[1]
    assert len(many[1].effects) == len(many[0].effects)


def test_row_width_does_not_depend_on_periods(spark):
    """The plan of both passes has as many columns for 4 periods as for 300."""
    def width(periods):
        df = spark.createDataFrame([(e, t, float(e * t % 7), float(e + t * t % 5)) for e in range(6) for t in range(periods)],
                                   "e int, t int, x double, y double")
        z = E._z_columns(E.parse_terms(["x"]), ["y"], [0.0, 0.0])
        assert len(z) == 2
        d = E._two_way(df, ["y"], E.parse_terms(["x"]), "e", "t", [0.0, 0.0], (6, periods)).rows
        out = io.StringIO()
        with contextlib.redirect_stdout(out):
            d.explain("formatted")
        return len(d.columns), max(len(line.split(",")) for line in out.getvalue().splitlines() if line.startswith("Output"))
    assert width(8) == width(300)


@pytest.mark.parametrize("entities", [5, 40])
def test_six_thousand_periods(spark, entities):
    rng = np.random.default_rng(5)
    T = 6_000
    keep = rng.random((entities, T)) < 0.5
    x = rng.normal(size=(entities, T)) + 0.2 * np.arange(entities)[:, None]
    y = 2 * x + np.arange(entities)[:, None] + np.sin(np.arange(T) / 50) + rng.normal(size=(entities, T))
    es, ts = np.nonzero(keep)
    df = spark.createDataFrame(list(zip(es.tolist(), ts.tolist(), x[keep].tolist(), y[keep].tolist())),
                               "e int, t int, x double, y double")
    fit = E.areg(df, "y", ["x", "i.t"], absorb="e")           # too many levels to be listed
    assert fit.time == "t" and fit.names == ["x", "_cons"]
    # demeaned by period, entities as indicators
    n_t = np.bincount(ts, minlength=T)

    def swept(v):
        return v - (np.bincount(ts, v, T) / np.maximum(n_t, 1))[ts]
    X = np.column_stack([swept(x[keep]), *[swept((es == e).astype(float)) for e in range(1, entities)]])
    yy = swept(y[keep])
    b = np.linalg.lstsq(X, yy, rcond=None)[0]
    r = yy - X @ b
    df_r = len(es) - (n_t > 0).sum() - X.shape[1]
    A = np.linalg.pinv(X)[0]
    assert fit.df_r == df_r and fit.coef[0] == pytest.approx(b[0], rel=1e-9)
    assert fit.vcov[0, 0] == pytest.approx(len(es) / df_r * (A ** 2 * r ** 2).sum(), rel=1e-7)


def test_dates_strings_and_within(spark):
    rows = panel(6)
    df = spark.createDataFrame([(f"e{r[0]}", dt.date(2020, 1, 1) + dt.timedelta(days=r[1]), *r[2:]) for r in rows],
                               "e string, t date, x1 double, x2 double, y double, g double")
    b, V, df_r, _, _ = dummies(rows, "classic")
    fit = E.within(df, "y", ["x1", "x2"], "e", time="t", effect="twoways")
    assert fit.names == ["x1", "x2"] and fit.df_r == df_r
    assert fit.coef == pytest.approx(b[:2], rel=1e-8) and fit.vcov == pytest.approx(V[:2, :2], rel=1e-8)
    assert fit.effects[0] == (dt.date(2020, 1, 3), 0.0)


def gaps(spark):
    rows = panel(7, 12, 8, 0.2)
    df = spark.createDataFrame(rows, SCHEMA)
    nan = F.lit(float("nan"))
    return df.withColumn("y2", F.when(F.col("t") > 4, F.col("y") + F.col("x2"))) \
        .withColumn("y3", F.when(F.col("x1") > 0.5, F.col("y")).otherwise(nan)) \
        .withColumn("m1", F.when(F.col("e") != 3, F.col("x2"))).withColumn("m2", F.col("g") + F.col("x1"))


@pytest.mark.parametrize("time, vce", [(None, "robust"), ("t", "robust"), ("t", "classic")])
def test_grid_over_gaps_equals_separate_fits(spark, time, vce):
    df = gaps(spark)
    fits = E.grid(df, ["y", "y2", "y3"], ["m1", "m2"], lambda o, m: ["x1", f"x1#{m}"], absorb="e", vce=vce, time=time,
                  tests=lambda s: [("both", s[2])])
    assert len({f.n for f in fits}) > 3
    for f in fits[::2] if vce == "robust" else fits[1::4]:
        o, m = f.model_id.split("|")
        one = E.areg(df, o, ["x1", f"x1#{m}"], "e", vce, time=time, tests=[("both", ["x1", f"x1#{m}"])])
        assert (f.n, f.n_groups, f.df_r, f.k) == (one.n, one.n_groups, one.df_r, one.k)
        assert f.coef == pytest.approx(one.coef, rel=1e-8) and f.vcov == pytest.approx(one.vcov, rel=1e-6, abs=1e-10)
        for what in ("r2", "r2_adj", "r2_within", "rmse", "f"):
            assert getattr(f, what) == pytest.approx(getattr(one, what), rel=1e-7)
        assert f.tests[0]["f"] == pytest.approx(one.tests[0]["f"], rel=1e-7)


def test_grid_over_gaps_on_the_other_routes(spark, monkeypatch):
    df = gaps(spark)
    make = lambda o, m: ["x1", f"x1#{m}"]
    want = E.grid(df, ["y", "y2"], ["m1", "m2"], make, absorb="e", time="t")
    got = E.grid(df, ["y", "y2"], ["m1", "m2"], make, absorb="t", time="e")       # more entities than periods: swapped
    for a, b in zip(want, got):
        assert a.coef[:2] == pytest.approx(b.coef[:2], rel=1e-8) and a.vcov[0, 0] == pytest.approx(b.vcov[0, 0], rel=1e-7)
    monkeypatch.setattr(E, "SAMPLE_BITS", 1)
    for a, b in zip(want, E.grid(df, ["y", "y2"], ["m1", "m2"], make, absorb="e", time="t")):
        assert a.coef == pytest.approx(b.coef, rel=1e-8) and a.vcov == pytest.approx(b.vcov, rel=1e-7, abs=1e-12)
    monkeypatch.setattr(effects, "DENSE_LEVELS", 3)
    b = E.grid(df, ["y"], ["m1"], make, absorb="e", time="t")[0]
    assert want[0].coef == pytest.approx(b.coef, rel=1e-8)


def test_nan_is_missing_in_a_grid(spark):
    """y2 is NaN on a quarter of the rows: models of y1 keep all of theirs."""
    df = spark.createDataFrame([(e, float(e * t % 5 + t), float(t + e % 3), float("nan") if t == 1 else float(t * e))
                                for e in range(50) for t in range(4)], "e int, m1 double, y1 double, y2 double")
    fits = {f.depvar: f for f in E.grid(df, ["y1", "y2"], ["m1"], lambda o, m: [m], absorb="e")}
    assert fits["y1"].n == E.areg(df, "y1", ["m1"], "e").n == 200 and fits["y2"].n == 150


def test_no_complete_rows(spark):
    df = spark.createDataFrame([(1, 1, None, 2.0)], "e int, t int, x double, y double")
    for time in (None, "t"):
        with pytest.raises(E.EmptySampleError):
            E.areg(df, "y", ["x"], "e", time=time)
    with pytest.raises(E.EmptySampleError):
        E.ols(df, "y", ["x"])
    with pytest.raises(E.EmptySampleError):
        E.grid(df, ["y"], ["x"], lambda o, m: [m], absorb="e")
