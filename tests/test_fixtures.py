"""Hand-made fixtures with known answers (FIXTURES.md part C)."""

import datetime as dt

import pytest
from pyspark.sql import functions as F

from panora.functions.clean import coerce_numeric
from panora.functions.dates import date_from_parts, week_block
from panora.operators.aggregate import FUNCS, winsorize
from panora.operators.design import event_dummies, post
from panora.operators.joins import align, join, merge_m1
from panora.operators.window import flag, locf, time_lag, xtile, xtile_cuts


def test_null_keys_match(spark):
    left = spark.createDataFrame([(1, None, 10), (2, 1, 20)], "k int, w int, a int")
    right = spark.createDataFrame([(1, None, 5), (3, 1, 6)], "k int, w int, b int")
    assert align(left, right, keys=["k", "w"]).count() == 3
    assert join(left, right, ["k", "w"], "full").count() == 3
    assert left.join(right, ["k", "w"], "full").count() == 4  # plain USING keeps NULLs apart
    assert align(left, right, keys=["k", "w"], null_keys="drop").count() == 2


@pytest.mark.parametrize("chunk", [0, None, 2])
def test_locf_gap(spark, chunk):
    df = spark.createDataFrame([(1, t, x) for t, x in [(1, 5.0), (2, None), (3, None), (4, 7.0), (5, None)]]
                               + [(2, 1, None), (2, 2, 3.0)], "e int, t int, x double")
    out = {(r.e, r.t): r.x for r in locf(df, "e", "t", ["x"], chunk=chunk).collect()}
    assert [out[(1, t)] for t in range(1, 6)] == [5, 5, 5, 7, 7]
    assert out[(2, 1)] is None and out[(2, 2)] == 3.0


def test_time_lag_gap(spark):
    df = spark.createDataFrame([(1, 1, 5.0), (1, 2, 6.0), (1, 4, 7.0)], "e int, t int, x double")
    out = {r.t: r.L1_x for r in time_lag(df, "e", "t", ["x"]).collect()}
    assert out == {1: None, 2: 5.0, 4: None}


def test_xtile_ties(spark):
    df = spark.createDataFrame([(None if v is None else float(v),) for v in [1, 1, 1, 2, 3, 4, None]],
                               "x double")
    assert xtile_cuts(df, "x", 4) == [1.0, 1.5, 3.0]
    got = sorted((r.x, r.q) for r in xtile(df, "x", 4, "q").collect() if r.x is not None)
    assert [q for _, q in got] == [1, 1, 1, 3, 3, 4]
    assert [r.q for r in xtile(df, "x", 4, "q").collect() if r.x is None] == [None]


def test_xtile_even(spark):
    df = spark.createDataFrame([(v,) for v in [1.0, 2.0, 3.0, 4.0]], "x double")
    assert xtile_cuts(df, "x", 4) == [1.5, 2.5, 3.5]
    assert sorted(r.q for r in xtile(df, "x", 4, "q").collect()) == [1, 2, 3, 4]


def test_stata_missing_flags(spark):
    df = spark.createDataFrame([(4,), (2,), (None,)], "q int")
    r = df.select(flag("q", "==", 4).alias("a"), flag("q", ">", 2).alias("b"),
                  flag("q", "==", 4, missing="stata").alias("c"),
                  flag("q", ">", 2, missing="stata").alias("d")).collect()
    assert [x.a for x in r] == [1, 0, None] and [x.b for x in r] == [1, 0, None]
    assert [x.c for x in r] == [1, 0, 0] and [x.d for x in r] == [1, 0, 1]


def test_week_block(spark):
    days = [dt.date(2020, 1, 7), dt.date(2020, 1, 8), dt.date(2020, 12, 31), dt.date(2021, 1, 1)]
    df = spark.createDataFrame([(d,) for d in days], "d date")
    assert [r.w for r in df.select(week_block("d").alias("w")).collect()] == [1, 2, 53, 1]


def test_bad_dates(spark):
    df = spark.createDataFrame([(2020, 2, 31), (2020, None, 1), (2020, 2, 29)], "y int, m int, d int")
    got = [r.x for r in df.select(date_from_parts("y", "m", "d").alias("x")).collect()]
    assert got == [None, None, dt.date(2020, 2, 29)]


def test_dirty_numbers(spark):
    df = spark.createDataFrame([("NA",), (".",), (" 1.5",), ("abc",), ("$1,200",)], "v string")
    got = [r.v for r in coerce_numeric(df, ["v"], ignore=("$", ",")).collect()]
    assert got == [None, None, 1.5, None, 1200.0]


def test_winsorize(spark):
    df = spark.createDataFrame([(1, float(v)) for v in [1, 2, 3, 4, 100]]
                               + [(2, float(v)) for v in [5, 5, 5, 9]] + [(3, 42.0)], "g int, x double")
    whole = sorted(r.x for r in winsorize(df.filter("g = 1"), ["x"]).collect())
    assert whole[:4] == [1, 2, 3, 4] and abs(whole[4] - 5.9652) < 1e-9
    by = {(r.g, r.x) for r in winsorize(df, ["x"], by=["g"]).collect()}
    assert (2, 9.0) in by and (3, 42.0) in by  # MAD = 0 and singleton untouched


def test_merge_dup_right_raises(spark):
    m = spark.createDataFrame([(1, "a")], "k int, v string")
    u = spark.createDataFrame([(1, "x"), (1, "y")], "k int, w string")
    with pytest.raises(ValueError):
        merge_m1(m, u, "k")


def test_merge_status_and_left_wins(spark):
    m = spark.createDataFrame([(1, "a"), (2, "b"), (None, "n")], "k int, v string")
    u = spark.createDataFrame([(1, "X"), (3, "Z"), (None, "N")], "k int, v string")
    got = {(r.k, r.v, r._merge) for r in merge_m1(m, u, "k").collect()}
    assert got == {(1, "a", 3), (2, "b", 1), (3, "Z", 2), (None, "n", 3)}


def test_never_treated(spark):
    df = spark.createDataFrame([(1, 3, None), (2, 3, 2)], "e int, t int, t0 int")
    d = event_dummies(df.withColumn("tre", post("t", "t0")), "t", "t0", 2, 2)
    r = {x.e: x for x in d.collect()}
    assert r[1].tre == 0 and all(r[1][c] == 0 for c in ["b2", "b1", "a0", "a1", "a2"])
    assert r[2].tre == 1 and r[2].a1 == 1 and r[2].a0 == 0


def test_all_null_group(spark):
    df = spark.createDataFrame([(1, None), (1, None), (2, 3.0)], "g int, x double")
    r = {x.g: x for x in df.groupBy("g").agg(FUNCS["sum"](F.col("x")).alias("s"),
                                             F.avg("x").alias("m"), F.max("x").alias("mx")).collect()}
    assert r[1].s == 0 and r[1].m is None and r[1].mx is None


@pytest.mark.parametrize("method", ["map", "distributed"])
def test_quantile_methods_agree(spark, method):
    from panora.operators.profile import stata_percentiles
    df = spark.createDataFrame([(None if v is None else float(v),) for v in [1, 1, 1, 2, 3, 4, None]], "x double")
    assert xtile_cuts(df, "x", 4, method) == [1.0, 1.5, 3.0]
    w = spark.createDataFrame([(1, float(v)) for v in [1, 2, 3, 4, 100]]
                              + [(2, float(v)) for v in [5, 5, 5, 9]] + [(3, 42.0)], "g int, x double")
    by = sorted((r.g, r.x) for r in winsorize(w, ["x"], by=["g"], method=method).collect())
    assert abs(by[4][1] - 5.9652) < 1e-9 and (2, 9.0) in by and (3, 42.0) in by
    big = spark.range(0, 1001).select((F.col("id") % 7).cast("double").alias("x"))
    assert stata_percentiles(big, ["x"], [0.1, 0.5, 0.9], method)["x"] == [0.0, 3.0, 6.0]


def test_sort_and_positions(spark):
    from panora.operators.reshape import sort, sort_position, top_k
    df = spark.createDataFrame([(i, float(v)) for i, v in enumerate([5, 3, 5, 1, 9, 3])], "k int, v double")
    got = [tuple(r) for r in sort(df, "v", "k", desc=[True, False]).collect()]
    assert got == [(4, 9.0), (0, 5.0), (2, 5.0), (1, 3.0), (5, 3.0), (3, 1.0)]
    for method in ("map", "distributed"):
        pos = {r.k: r.position for r in sort_position(df, "v", desc=True, tiebreak=["k"], method=method).collect()}
        assert pos == {4: 1, 0: 2, 2: 3, 1: 4, 5: 5, 3: 6}
    assert [r.k for r in top_k(df, 2, "v", tiebreak=["k"]).collect()] == [4, 0]


def test_align_uniqueness_check(spark):
    a = spark.createDataFrame([(1, 1.0), (1, 2.0)], "k int, x double")
    b = spark.createDataFrame([(1, 5.0)], "k int, y double")
    with pytest.raises(ValueError):
        align(a, b, keys=["k"], check=True)
    fan = align(a, b, keys=["k"], unique=False)
    assert sorted((r.x, r.y) for r in fan.collect()) == [(1.0, 5.0), (2.0, 5.0)]


def test_first_per_key_ties_are_deterministic(spark):
    from panora.functions.clean import first_per_key
    df = spark.createDataFrame([(1, 5, "b"), (1, 5, "a"), (1, 6, "c"), (2, 1, "z")], "k int, t int, v string")
    for parts in (1, 3):
        got = sorted(tuple(r) for r in first_per_key(df.repartition(parts), ["k"], ["t"]).collect())
        assert got == [(1, 5, "a"), (2, 1, "z")]


def test_panel_wrapper(spark):
    from panora.operators.design import Panel
    df = spark.createDataFrame([(1, 1, 5.0), (1, 2, None), (1, 4, 7.0), (2, 2, 1.0)], "e int, t int, x double")
    p = Panel(df, "e", "t")
    lagged = {(r.e, r.t): r.L1_x for r in p.lag(["x"]).df.collect()}
    assert lagged[(1, 2)] == 5.0 and lagged[(1, 4)] is None
    bal = p.balance().locf(["x"])
    got = {(r.e, r.t): r.x for r in bal.df.collect()}
    assert got[(1, 3)] == 5.0 and got[(2, 1)] is None and got[(2, 4)] == 1.0
    s = p.structure().first()
    assert s.n_entities == 2 and s.n_periods == 3 and s.balanced == 0
