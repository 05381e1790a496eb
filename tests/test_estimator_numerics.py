"""Numerical stability of the estimators: absorbed terms, shifted data, grids
with different samples, the merge of partial sums."""

import numpy as np
import pytest
from pyspark.sql import functions as F

from panora.operators import estimate as E


@pytest.fixture(scope="module")
def panel(spark):
    rng = np.random.default_rng(4)
    rows = []
    for e in range(60):
        for t in range(10):
            x = float(rng.normal() + 0.1 * e)
            rows.append((e, t, 0.1 * (e % 7 + 1), x, float(2 * x + 0.3 * e + rng.normal())))
    df = spark.createDataFrame(rows, "e int, t int, z double, x double, y double")
    return df.cache()


@pytest.mark.parametrize("terms", [["z", "x"], ["x", "z"]])
def test_entity_constant_term_is_omitted(panel, terms):
    fit = E.areg(panel, "y", terms, "e")
    alone = E.areg(panel, "y", ["x"], "e")
    rows = {r[2]: r for r in fit.table_rows()}
    assert rows["z"][-1] and not rows["x"][-1]
    assert fit.k == 1 and fit.df_r == alone.df_r
    want = {r[2]: r for r in alone.table_rows()}
    for term in ("x", "_cons"):
        assert rows[term][3:5] == pytest.approx(want[term][3:5], rel=1e-9)


@pytest.mark.parametrize("absorb", [None, "e"])
@pytest.mark.parametrize("vce", ["robust", "classic"])
def test_shifts_change_neither_r2_nor_se(panel, absorb, vce):
    fit = lambda df: E.fit_many(df, [("m", "y", ["x"])], absorb=absorb, vce=vce)[0]
    want = fit(panel)
    for df in (panel.withColumn("y", F.col("y") + 1e8), panel.withColumn("x", F.col("x") + 1e8)):
        got = fit(df)
        assert got.r2 == pytest.approx(want.r2, rel=1e-7)
        assert got.coef[0] == pytest.approx(want.coef[0], rel=1e-7)
        assert got.vcov[0, 0] == pytest.approx(want.vcov[0, 0], rel=1e-7)


def test_grid_passes_do_not_grow_with_samples(panel, monkeypatch):
    """One landed base, one Gram and one meat pass, however many listwise samples there are."""
    df = panel.withColumn("y1", F.when(F.col("t") > 0, F.col("y"))) \
        .withColumn("y2", F.when(F.col("t") < 8, F.col("y"))) \
        .withColumn("m1", F.col("e") % 2).withColumn("m2", F.col("e") % 3)
    landed, passes = [], []
    cut, summed = E.cut_lineage, E._summed
    monkeypatch.setattr(E, "cut_lineage", lambda *a, **k: landed.append(1) or cut(*a, **k))
    monkeypatch.setattr(E, "_summed", lambda *a, **k: passes.append(1) or summed(*a, **k))
    fits = E.grid(df, ["y", "y1", "y2"], ["m1", "m2"], lambda o, m: ["x", f"x#{m}"], absorb="e")
    assert len(landed) == 1 and len(passes) == 2 and len(fits) == 6
    monkeypatch.undo()
    for f in fits:
        o, m = f.model_id.split("|")
        one = E.areg(df, o, ["x", f"x#{m}"], "e")
        assert f.n == one.n and f.coef == pytest.approx(one.coef, rel=1e-9)
        assert f.vcov == pytest.approx(one.vcov, rel=1e-7, abs=1e-12)


def test_partial_sums_send_one_row_per_partition(spark, panel):
    df = panel.repartition(40)
    for i in range(30):
        df = df.withColumn(f"c{i}", F.sin(F.col("x") * (i + 1)))
    cols = [f"c{i}" for i in range(30)]
    g, s, n = E.moments(df, cols, cols, use_pandas=True)
    g2, s2, n2 = E.moments(df, cols, cols, use_pandas=False)
    assert n == n2 and g == pytest.approx(g2, abs=1e-8) and s == pytest.approx(s2, abs=1e-8)
    got = E._summed(df.select("x"), lambda it: [sum(1 for _ in it) and 1.0, 1.0], 2)
    assert got[1] == 40  # one vector per partition
