"""Column expressions of the t distribution against the driver's scalar functions."""

import math

import pytest
from pyspark.sql import functions as F

from panora.functions import dist
from panora.functions.tails import stars, t_quantile, t_two_sided
from panora.operators.profile import pearson, welch_test


def test_tails_and_quantiles(spark):
    rows = [(float(t), float(n)) for n in (1, 2, 3, 7.5, 30, 400, 50_000, 2_000_000)
            for t in (0, 1e-6, 0.3, -1.7, 1.75, 2.2, 5, -12, 300)]
    got = spark.createDataFrame(rows, "t double, df double").select("t", "df", t_two_sided(F.col("t"), F.col("df")).alias("p")).collect()
    for r in got:
        assert r.p == pytest.approx(dist.t_sf2(r.t, r.df), rel=1e-6, abs=1e-12), r
    dfs = spark.createDataFrame([(1.0,), (4.0,), (60.0,), (30000.0,)], "df double")
    for level in (0.95, 0.995):
        for r in dfs.select("df", t_quantile(level, F.col("df")).alias("q")).collect():
            assert r.q == pytest.approx(dist.t_ppf(level, r.df), rel=1e-7)


def test_values_without_a_tail(spark):
    df = spark.createDataFrame([(None, 3.0), (float("nan"), 3.0), (1.0, None), (0.0, 0.0), (1.0, -2.0), (float("inf"), 3.0)],
                               "t double, df double")
    assert [r[0] for r in df.select(t_two_sided(F.col("t"), F.col("df"))).collect()] == [None] * 5 + [0.0]
    marks = spark.createDataFrame([(0.2,), (0.09,), (0.04,), (0.001,), (None,)], "p double").select(stars(F.col("p")))
    assert [r[0] for r in marks.collect()] == ["", "*", "**", "***", ""]


def test_comparisons_with_and_without_variation(spark):
    df = spark.createDataFrame([(i % 2, float(i * i % 7), 3.0) for i in range(30)], "g int, x double, c double")
    r = {x.variable: x for x in welch_test(df, "g", ["x", "c"]).collect()}
    assert r["x"].p == pytest.approx(dist.t_sf2(r["x"].t, r["x"].df), rel=1e-9)
    assert r["c"].p is None
    assert welch_test(df.limit(0), "g", ["x"]).first().p is None
    p = {(x.var1, x.var2): x for x in pearson(df.withColumn("g", F.col("g") * 1.0), ["g", "x", "c"]).collect()}
    x = p["g", "x"]
    assert x.p == pytest.approx(dist.t_sf2(x.r * math.sqrt(28 / (1 - x.r ** 2)), 28), rel=1e-9)
    assert p["g", "g"].p == 0 and p["g", "c"].p is None
    assert {x.p for x in pearson(df.select("x", "c").limit(2), ["x", "c"]).collect() if x.var1 != x.var2} == {None}
