"""Cases of missing, off-grid, infinite and hot values that once gave wrong answers."""

import contextlib
import datetime as dt
import io
import random

import pytest
from pyspark.sql import functions as F

from panora.functions.clean import coerce_numeric, first_per_key
from panora.operators import aggregate as A
from panora.operators import joins, ordering, profile, quantiles, reshape, window
from panora.operators.reshape import LevelError


def rows(df, *cols):
    return sorted((tuple(r) for r in df.select(*(cols or df.columns)).collect()), key=repr)


def plan(df):
    out = io.StringIO()
    with contextlib.redirect_stdout(out):
        df.explain("formatted")
    return out.getvalue()


@pytest.fixture(params=[250_000, 7])
def part_rows(request, monkeypatch):
    monkeypatch.setattr(ordering, "PART_ROWS", request.param)


def test_numbers_along_any_order(spark, part_rows):
    rng = random.Random(1)
    data = [(rng.choice("ab" * 20 + "c"), rng.choice(["x", "y", None]), dt.date(2020, 1, rng.randint(1, 4)), i) for i in range(120)]
    data += [("hot", "same", dt.date(2020, 1, 1), 7)] * 60 + [(None, "z", None, 1), (None, "z", None, 2)]
    df = spark.createDataFrame(data, "k string, s string, d date, i int").repartition(5)
    got = ordering.number_rows(df, ["s", ("d", True), "i"], ["k"], "p")
    last = dt.date(1, 1, 1)
    want = {}
    for k in {r[0] for r in data}:
        own = sorted((r for r in data if r[0] == k), key=lambda r: (r[1] is None, r[1] or "", r[2] is None,
                                                                   -(r[2] or last).toordinal(), r[3]))
        want[k] = list(enumerate(own, 1))
    assert sorted(((r.p, tuple(r)[:4]) for r in got.collect()), key=repr) == sorted((x for v in want.values() for x in v), key=repr)
    whole = ordering.number_rows(df, [F.col("s").desc(), F.col("i").asc_nulls_first()], (), "p")
    assert sorted(r.p for r in whole.collect()) == list(range(1, len(data) + 1))
    assert [r.s for r in whole.orderBy("p").collect()][0] == "z"


def test_no_part_is_much_larger_than_asked(spark, monkeypatch):
    monkeypatch.setattr(ordering, "PART_ROWS", 100)
    df = spark.range(3000).select(F.lit("one key").alias("k"), F.lit("one value").alias("s"))
    _, parts, _ = ordering.in_parts(df, ["k"], ["s"])
    sizes = [r["count"] for r in parts.groupBy("__part").count().collect()]
    assert sum(sizes) == 3000 and max(sizes) <= 300


def test_carry_forward_of_any_period(spark, part_rows):
    rng = random.Random(2)
    for values in (list(range(40)), [dt.date(2020, 1, 1) + dt.timedelta(days=i) for i in range(40)], [f"p{i:02}" for i in range(40)]):
        data = [(e, t, rng.choice([None, 1.5, 2.5]), rng.choice([None, "a"])) for e in (1, 2, None) for t in values if rng.random() < 0.8]
        data += [(1, None, 9.0, None)]
        kind = {int: "int", dt.date: "date", str: "string"}[type(values[0])]
        df = spark.createDataFrame(data, f"e int, t {kind}, v double, w string").repartition(4)
        want = []
        for e in (1, 2, None):
            last = [None, None]
            for r in sorted((r for r in data if r[0] == e), key=lambda r: (r[1] is None, r[1] if r[1] is not None else values[0])):
                last = [x if x is not None else y for x, y in zip(r[2:], last)]
                want.append((e, r[1], *last))
        for chunk in (None, 0):
            assert rows(window.locf(df, "e", "t", ["v", "w"], chunk=chunk)) == sorted(want, key=repr)


def test_nothing_is_carried_from_a_missing_period(spark):
    df = spark.createDataFrame([(1, None, 9.0), (1, 1, None), (1, 2, 3.0)], "e int, t int, v double")
    for chunk in (None, 0, 64):
        assert rows(window.locf(df, "e", "t", ["v"], chunk=chunk)) == [(1, 1, None), (1, 2, 3.0), (1, None, 9.0)]


def test_chunks_of_a_group(spark, part_rows):
    df = spark.createDataFrame([("hot", i % 50) for i in range(500)] + [("b", 1), ("b", None)], "g string, v int").repartition(6)
    got = A.collect_chunks(df, "g", "v", 64, "l").orderBy("g", "chunk").collect()
    assert [len(r.l) for r in got if r.g == "hot"] == [64] * 7 + [52] and [r.l for r in got if r.g == "b"] == [[1]]
    joined = [v for r in got if r.g == "hot" for v in r.l]
    assert joined == A.collect_values(df.filter("g = 'hot'"), "g", "v", "l").first().l


# ---------------------------------------------------------------------------- skeletons
def test_rows_off_the_grid_stay(spark):
    df = spark.createDataFrame([("a", 1, 1.0), ("a", 2, 2.0), ("a", 4, 4.0), ("a", None, 5.0), ("b", 3, 3.0)], "e string, t int, v double")
    got = joins.fill_balanced(df, "e", "t", step=2, status="s")
    assert rows(got) == [("a", 1, 1.0, 3), ("a", 2, 2.0, 2), ("a", 3, None, 1), ("a", 4, 4.0, 2), ("a", None, 5.0, 2),
                         ("b", 1, None, 1), ("b", 3, 3.0, 3)]
    assert joins.fill_balanced(df, "e", "t", step=2).columns == ["e", "t", "v"]


@pytest.mark.parametrize("days, freq, n", [
    (["2020-01-01", "2020-03-01", "2020-06-01"], "month", 6), (["2020-01-31", "2020-02-29", "2020-04-30"], "month", 4),
    (["2020-01-01", "2020-10-01"], "quarter", 4), (["2019-05-01", "2022-05-01"], "year", 4),
    (["2020-01-01", "2020-01-15", "2020-01-22"], "week", 4), (["2020-01-01", "2020-01-04"], "day", 4), (["2020-01-05"], "week", 1)])
def test_calendar_steps(spark, days, freq, n):
    df = spark.createDataFrame([("a", dt.date.fromisoformat(d)) for d in days] + [("b", None)], "e string, t date")
    assert joins.frequency(df, "t") == freq
    got = joins.fill_balanced(df, "e", "t", status="s")
    assert got.filter("e = 'a'").count() == n and got.filter("s = 2").count() == 1      # b's row without a date
    assert got.filter("e = 'a' AND s = 3").count() == len(days)
    assert joins.balance(df, "e", "t", span="entity").count() == n
    assert joins.balance(df.limit(0), "e", "t").count() == 0


# ---------------------------------------------------------------------------- pivots
def test_pivots_lose_no_row(spark):
    df = spark.createDataFrame([(1, "a", 1.0), (1, "b", 2.0), (2, "z", 4.0), (2, None, 8.0)], "i int, k string, v double")
    for make in (lambda rest: reshape.wide_cast(df, ["i"], ["k"], [["a", "b"]], ["v"], rest=rest),
                 lambda rest: reshape.long_to_wide(df, ["i"], "k", ["v"], ["a", "b"], agg="sum", rest=rest),
                 lambda rest: reshape.status_matrix(df, "i", "k", "v", ["a", "b"], rest=rest),
                 lambda rest: A.crosstab(df, "i", "k", ["a", "b"], rest=rest)):
        with pytest.raises(LevelError):
            make("raise")
        assert len(make("drop").columns) == 3
    wide = reshape.wide_cast(df, ["i"], ["k"], [["a", "b"]], ["v"], rest="cell")
    assert rows(wide) == [(1, 1.0, 2.0, 0.0), (2, 0.0, 0.0, 12.0)]
    assert rows(A.crosstab(df, "i", "k", ["a", "b"], rest="cell")) == [(1, 1, 1, 0), (2, 0, 0, 2)]
    found = reshape.status_matrix(df.filter("k IS NOT NULL"), "i", "k", "v", max_times=3)
    assert found.columns == ["i", "ta", "tb", "tz"]
    with pytest.raises(LevelError):
        reshape.status_matrix(df, "i", "k", "v", max_times=2)
    dated = spark.createDataFrame([(1, dt.date(2020, 1, 1), 1.0), (1, None, 2.0)], "i int, k date, v double")
    assert reshape.long_to_wide(dated, ["i"], "k", ["v"], [dt.date(2020, 1, 1)], rest="cell").columns == ["i", "v_2020-01-01", "v_rest"]


# ---------------------------------------------------------------------------- profile
def test_profile_of_awkward_columns(spark):
    df = spark.createDataFrame([(None, 5.0, 1.0, 2 ** 62), (1, 5.0, 2.0, 2 ** 62 + 1), (2, 5.0, float("inf"), None)],
                               "e int, k double, x double, w long")
    r = {(p.var1, p.var2): p.r for p in profile.pearson(df.limit(2), ["k", "x"]).collect()}
    assert r["k", "x"] is None and r["x", "x"] == 1.0
    assert profile.spearman(df, ["k", "x"]).count() == 4
    book = {b.variable: b for b in profile.codebook(df, ["k", "w"]).collect()}
    assert book["w"].n_distinct == 2 and book["w"].n_missing == 1 and book["k"].n_distinct == 1
    empty = profile.codebook(df.limit(0), ["k"]).first()
    assert empty.n_total == 0 and empty.p50 is None
    bins = profile.histogram(df, "x", bins=2).collect()
    assert sorted((b.bin, b.lo, b.n) for b in bins if b.bin is not None) == [(0, 1.0, 1), (1, 1.5, 1)]
    assert [(b.lo, b.n) for b in bins if b.bin is None] == [(float("inf"), 1)]
    assert profile.participation_patterns(df.limit(0), "k", "e").count() == 0
    full = profile.describe(df, ["k", "w"], fast=False, method="distributed").collect()
    assert {f.variable: f.median for f in full}["k"] == 5.0


def test_value_counts_are_one_scan_without_expand(spark):
    df = spark.createDataFrame([(i, float(i % 7)) for i in range(50)], "a int, b double")
    seen = []
    cut = profile.cut_lineage
    profile.cut_lineage = lambda d, **k: seen.append(plan(d)) or cut(d, **k)
    try:
        out = profile.codebook(df, ["a", "b"])
    finally:
        profile.cut_lineage = cut
    assert len(seen) == 1 and "Expand" not in seen[0] and seen[0].count("Exchange (") == 1
    assert {r.variable: (r.p25, r.p50, r.n_distinct) for r in out.collect()} == {"a": (12.0, 24.5, 50), "b": (1.0, 3.0, 7)}


def test_patterns_of_long_panels(spark):
    rng = random.Random(4)
    have = {e: sorted(rng.sample(range(200), 90)) for e in range(6)}
    have[6] = have[0]
    df = spark.createDataFrame([(e, t) for e, ts in have.items() for t in ts] + [(9, None)], "e int, t int")
    lo, hi = min(min(v) for v in have.values()), max(max(v) for v in have.values())
    want = {}
    for ts in have.values():
        p = "".join("1" if t in ts else "." for t in range(lo, hi + 1))
        want[p] = want.get(p, 0) + 1
    got = profile.participation_patterns(df, "e", "t")
    assert {r.pattern: r.n_entities for r in got.collect()} == want and "collect_set" not in plan(got)


def test_xtsum_joins_no_rows(spark):
    df = spark.createDataFrame([(1, 1.0), (1, 3.0), (None, 10.0), (None, 14.0), (2, None)], "e int, x double")
    r = profile.xtsum(df, "e", ["x"]).first()
    assert (r.n_obs, r.n_entities, r.overall_mean) == (4, 2, 7.0)
    assert r.within_sd == pytest.approx((10 / 3) ** 0.5) and (r.within_min, r.within_max) == (5.0, 9.0)
    assert r.overall_sd == pytest.approx((110 / 3) ** 0.5) and r.between_sd == pytest.approx(5 * 2 ** 0.5)


# ---------------------------------------------------------------------------- others
def test_missing_and_infinite_values(spark):
    df = spark.createDataFrame([(1, None, "null"), (1, 1, "one"), (2, None, "only")], "k int, o int, v string")
    assert rows(first_per_key(df, ["k"], ["o"]), "k", "v") == [(1, "one"), (2, "only")]
    text = spark.createDataFrame([("1e400",), ("1e308",), ("-1e999",), ("5",)], "x string")
    assert [r.x for r in coerce_numeric(text).collect()] == [None, 1e308, None, 5.0]
    g = spark.createDataFrame([("a", 1.0), ("b", None)], "g string, x double")
    for method in ("map", "distributed"):
        assert rows(quantiles.median_table(g, "x", ["g"], "m", method)) == [("a", 1.0), ("b", None)]
    days = spark.createDataFrame([("e", dt.date(2020, 1, 1), 1.0), ("e", dt.date(2021, 1, 1), 3.0)], "e string, t date, x double")
    assert A.resample(days, "e", "t", mean=["x"]).count() == 2


def test_align_leaves_no_cached_copy(spark):
    a = spark.createDataFrame([(1, "x"), (None, "y")], "k int, a string")
    b = spark.createDataFrame([(1, 2.0), (3, 4.0)], "k int, b double")
    before = spark.sparkContext._jsc.getPersistentRDDs().size()
    assert rows(joins.align(a, b, keys=["k"])) == [(1, "x", 2.0), (3, None, 4.0), (None, "y", None)]
    assert rows(joins.align(a, b, keys=["k"], drop_null="k")) == [(1, "x", 2.0), (3, None, 4.0)]
    assert spark.sparkContext._jsc.getPersistentRDDs().size() == before
