"""NULL groups, keys and order values are values like any other (M6)."""

import datetime as dt
from functools import reduce

import pytest
from pyspark.sql import functions as F

from panora.functions.clean import to_number
from panora.functions.dates import PERIODS, date_from_parts
from panora.operators import aggregate as A
from panora.operators import design, joins, profile, quantiles, reshape, window

ROWS = [("a", 1.0), ("a", 3.0), ("a", 8.0), (None, 2.0), (None, 4.0), (None, 1000.0), (None, 3.0), ("b", 5.0)]


@pytest.fixture(scope="module")
def df(spark):
    return spark.createDataFrame([(i, g, x) for i, (g, x) in enumerate(ROWS)], "i int, g string, x double")


def rows(d, *cols):
    return sorted((tuple(r) for r in d.select(*cols).collect()), key=repr)


def test_median_routes_agree_on_null_groups(df):
    want = rows(quantiles.median_table(df, "x", ["g"], method="map"), "g", "median")
    assert rows(quantiles.median_table(df, "x", ["g"], method="distributed"), "g", "median") == want
    assert (None, 3.5) in want
    for m in ("map", "distributed"):
        got = A.aggregate(df, "g", [("m", "median", "x"), ("s", "sum", "x")], method=m)
        assert (None, 3.5, 1009.0) in rows(got, "g", "m", "s")


def test_shares_rollups_and_clipping_keep_the_null_group(df):
    share = A.share_within(df.withColumn("h", F.col("x") > 3), ["g", "h"], ["g"])
    assert sum(r.n for r in share.collect()) == len(ROWS)
    assert (None, 1009.0, 4) in rows(A.rollup(df, "g", {"sum": ["x"]}), "g", "x_sum", "n")
    for m in ("map", "distributed"):
        clipped = {r.i: r.x for r in A.winsorize(df, ["x"], ["g"], method=m).collect()}
        assert len(clipped) == len(ROWS) and clipped[5] < 10
        box = {r.g: r for r in profile.box_stats(df, "x", ["g"], method=m).collect()}
        assert box[None].n == 4 and box[None].n_outliers == 1


def test_windows_keep_the_null_group(df):
    for m in ("map", "distributed"):
        got = window.group_stat(df, "g", {"top": ("max", "x"), "mid": ("median", "x")}, method=m)
        assert {(r.top, r.mid) for r in got.collect() if r.g is None} == {(1000.0, 3.5)}
    flagged = design.ever_treated(df.withColumn("f", (F.col("x") == 1000).cast("int")), "g", "f")
    assert {r.ever_treated for r in flagged.collect() if r.g is None} == {1}
    last = window.latest(df, "i", "g")
    assert sorted(r.i for r in last.collect()) == [2, 6, 7]


def test_carry_forward_routes_agree_on_a_null_entity(spark):
    d = spark.createDataFrame([(None, t, v) for t, v in enumerate([1.0, None, None, None, 5.0, None, None])]
                              + [("a", 0, None), ("a", 6, 2.0)], "e string, t int, v double")
    want = rows(window.locf(d, "e", "t", ["v"], chunk=0), "e", "t", "v")
    assert rows(window.locf(d, "e", "t", ["v"], chunk=2), "e", "t", "v") == want
    assert (None, 3, 1.0) in want


def test_lag_refuses_duplicates_and_ignores_null_periods(spark):
    d = spark.createDataFrame([(None, 1, 1.0), (None, 2, 2.0), ("a", None, 3.0), ("a", None, 4.0)],
                              "e string, t int, v double")
    got = {(r.e, r.t): r.L1_v for r in window.time_lag(d, "e", "t", ["v"]).collect()}
    assert got[(None, 2)] == 1.0 and got[("a", None)] is None
    with pytest.raises(ValueError, match="repeated"):
        window.time_lag(d.union(d.limit(1)), "e", "t", ["v"])


def test_positions_put_null_values_last(spark):
    d = spark.createDataFrame([(1, 5.0), (2, None), (3, 1.0), (4, None)], "i int, v double")
    for method in ("map", "distributed"):
        got = reshape.sort_position(d, "v", tiebreak=["i"], method=method)
        assert [r.i for r in got.orderBy("position").collect()] == [3, 1, 2, 4]
        assert sorted(r.position for r in got.collect()) == [1, 2, 3, 4]


def test_mm_merge_pairs_null_keys_and_null_order_values(spark):
    left = spark.createDataFrame([(None, 1, "l1"), (None, 2, "l2"), ("k", 1, "l3")], "k string, o int, a string")
    right = spark.createDataFrame([(None, 1, "r1"), (None, None, "r2"), (None, 3, "r3")], "k string, p int, b string")
    got = rows(joins.merge_mm(left, right, "k", ["o"], ["p"]), "k", "a", "b")
    assert got == sorted([(None, "l1", "r1"), (None, "l2", "r3"), (None, "l2", "r2"), ("k", "l3", None)], key=repr)


def test_joins_match_null_keys_unless_told_otherwise(spark):
    d = spark.createDataFrame([(None, 1.0), ("a", 2.0)], "k string, x double")
    xw = spark.createDataFrame([(None, "t0", 0.5), ("a", "t1", 1.0)], "k string, to string, w double")
    assert rows(joins.crosswalk(d, xw, "k", "to"), "k", "to") == [("a", "t1"), (None, "t0")]
    assert joins.crosswalk(d, xw, "k", "to", null_keys="drop").count() == 1
    only = d.filter("k is null").select("k")
    assert joins.restrict(d, only, "k").count() == 1 and joins.restrict(d, only, "k", null_keys="drop").count() == 0
    assert {r.member for r in joins.membership_flag(d, only, "k").collect() if r.k is None} == {1}
    assert {r.in_s for r in joins.coverage_flags(d, {"s": only}, "k").collect() if r.k is None} == {1}


@pytest.mark.parametrize("null_keys", ["match", "drop"])
def test_align_of_repeated_keys_streams_its_matches(spark, null_keys):
    """A full outer join holds all pairs of a key at once; the chain must not use one, and give its rows."""
    a = spark.createDataFrame([(1, 10), (1, 11), (1, 11), (2, 1), (None, 7), (None, 8)], "k int, a int")
    b = spark.createDataFrame([(1, 5), (1, 6), (3, 2), (3, 2), (None, 9)], "k int, b int")
    c = spark.createDataFrame([(3, 50), (4, 51), (4, 51), (None, 52)], "k int, c int")
    got = joins.align(a, b, c, keys=["k"], null_keys=null_keys)
    frames = [f.filter("k IS NOT NULL") if null_keys == "drop" else f for f in (a, b, c)]
    want = reduce(lambda x, y: joins.join(x, y, ["k"], "full"), frames)
    assert got.columns == want.columns and rows(got, *want.columns) == rows(want, *want.columns)
    assert "FullOuter" not in got._jdf.queryExecution().optimizedPlan().toString()


@pytest.mark.parametrize("null_keys", ["match", "drop"])
@pytest.mark.parametrize("small_table", [0, 100])
def test_align_joins_keys_with_many_pairs_in_blocks(spark, monkeypatch, null_keys, small_table):
    for name, value in {"HEAVY": 5, "BLOCK": 2, "TASK_PAIRS": 8, "SMALL_TABLE": small_table}.items():
        monkeypatch.setattr(joins, name, value, raising=False)
    # key 1 is repeated everywhere, with rows that come twice; 2 lacks in b, 3 in a, 4 has few pairs, 5 stands in c only
    a = spark.createDataFrame([(i // 2, 1) for i in range(9)] + [(7, 2), (8, 2), (9, 2)] + [(0, 4)] + [(i, None) for i in range(4)], "a int, k int")
    b = spark.createDataFrame([(1, i // 2, "x") for i in range(7)] + [(3, i, "y") for i in range(5)] + [(4, 1, "z"), (4, 2, None), (None, 3, "n"), (None, 3, "n")],
                              "k int, b int, s string")
    c = spark.createDataFrame([(k, k * 10 + i) for k in (1, 2, 3, 5) for i in range(3)] + [(None, 1), (None, 2)], "k int, c int")
    frames = [f.filter("k IS NOT NULL") if null_keys == "drop" else f for f in (a, b, c)]
    for n in (2, 3):
        want = reduce(lambda x, y: joins.join(x, y, ["k"], "full"), frames[:n])
        for unique in (None, False):
            got = joins.align(*(a, b, c)[:n], keys=["k"], null_keys=null_keys, unique=unique)
            assert got.columns == want.columns and got.schema.simpleString() == want.schema.simpleString()
            assert rows(got, *want.columns) == rows(want, *want.columns)


def test_align_spreads_the_pairs_of_a_key(spark, monkeypatch):
    """One key with many rows on both sides is the work of many tasks, however small the inputs are."""
    monkeypatch.setattr(joins, "BLOCK", 50, raising=False)
    monkeypatch.setattr(joins, "TASK_PAIRS", 10_000, raising=False)
    a = spark.range(600, numPartitions=1).select(F.lit(1).alias("k"), F.col("id").alias("a"))
    b = spark.range(400, numPartitions=1).select(F.lit(1).alias("k"), F.col("id").alias("b"))
    got = joins.align(a, b, keys=["k"])
    per_task = [r["count"] for r in got.groupBy(F.spark_partition_id()).count().collect()]
    assert sum(per_task) == 600 * 400 and max(per_task) < 0.25 * 600 * 400
    assert got.agg(F.count_distinct("a", "b")).first()[0] == 600 * 400


def test_align_never_drops_repeated_keys(spark):
    a = spark.createDataFrame([(1, 10), (1, 11), (2, 1)], "k int, a int")
    b = spark.createDataFrame([(1, 5)], "k int, b int")
    assert rows(joins.align(a, b, keys=["k"]), "k", "a", "b") == [(1, 10, 5), (1, 11, 5), (2, 1, None)]
    with pytest.raises(ValueError, match="not unique"):
        joins.align(a, b, keys=["k"], check=True)


def test_weighted_summary_weights_every_statistic(spark):
    d = spark.createDataFrame([(1.0, 1.0), (2.0, 9.0)], "x double, w double")
    r = profile.summarize(d, ["x"], weight="w").collect()[0]
    assert r["mean"] == pytest.approx(1.9) and r["sum"] == pytest.approx(19.0)
    assert r["variance"] == pytest.approx(2 * 0.09) and r["sd"] == pytest.approx((2 * 0.09) ** 0.5)


def test_balance_steps_over_dates(spark):
    d = spark.createDataFrame([("a", dt.date(2020, 1, 30)), ("b", dt.date(2020, 2, 2))], "e string, t date")
    assert joins.balance(d, "e", "t").count() == 8
    assert joins.fill_balanced(d.withColumn("x", F.lit(1)), "e", "t").filter("x is not null").count() == 2


def test_dirty_text_becomes_null(spark):
    d = spark.createDataFrame([(x,) for x in ["12d", "NaN", "Infinity", "1e3", " -4.5 ", ".5", "", None]], "s string")
    assert [r[0] for r in d.select(to_number("s")).collect()] == [None, None, None, 1000.0, -4.5, 0.5, None, None]
    p = spark.createDataFrame([("2020", "abc", "1"), ("2020", "2", "29"), ("2020", "2", "30")], "y string, m string, d string")
    assert [r[0] for r in p.select(date_from_parts("y", "m", "d")).collect()] == [None, dt.date(2020, 2, 29), None]


def test_week_keys_can_tell_years_apart(spark):
    d = spark.createDataFrame([("a", dt.date(2020, 1, 1), 1.0), ("a", dt.date(2021, 1, 1), 2.0)], "e string, t date, x double")
    assert A.resample(d, "e", "t", to="year_week", mean=["x"]).count() == 2
    assert d.select(PERIODS["year_week"]("t")).first()[0] == "2020-W01"


def test_bucket_size_is_bounded_as_values_grow(spark, monkeypatch):
    monkeypatch.setattr(quantiles, "BUCKET_ROWS", 100)
    for n in (300, 3000, 12000):
        values = spark.range(n).select((F.col("id") % 3).alias("g"), F.col("id").alias("x"), F.lit(1).alias("__c"))
        sizes = [r["count"] for r in quantiles.bucketed(values, ["g"], "x").groupBy("__b").count().collect()]
        assert sum(sizes) == n and max(sizes) <= 400
    d = spark.range(3001).select((F.col("id") * 7919 % 3001).cast("double").alias("x"))
    assert quantiles.median_table(d, "x", method="distributed").first()[0] == 1500.0
