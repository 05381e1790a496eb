"""Op 2, 8 and 9 against brute force and SQL."""

import math
import random
from collections import Counter

import duckdb
import numpy as np
import pytest
from pyspark.sql import functions as F

from panora.llm import ann, queries, sql, topk, url_filter
from tests.llm.helpers import folder
from tests.oracle_check import rows_of

VECTORS = "vec_id long, embedding array<float>, label int, id long, v string, block long"


def awkward(spark, n=700, dim=8, seed=1):
    """Clusters, copies, null and non-finite vectors, short ones, clashing columns."""
    rng = np.random.default_rng(seed)
    centres = rng.normal(size=(12, dim))
    m = centres[rng.integers(0, 12, n)] + 0.3 * rng.normal(size=(n, dim))
    m /= np.linalg.norm(m, axis=1, keepdims=True)
    rows = [(i, [float(np.float32(x)) for x in v]) for i, v in enumerate(m)]
    hot = rows[20][1]
    rows += [(n + i, hot) for i in range(250)]                         # one vector, many ids
    rows += [(3000, None), (3001, [1.0, None] + [0.0] * (dim - 2)), (3002, [float("nan")] * dim),
             (3003, [float("inf")] * dim), (None, hot), (3100, [0.0] * dim), (3150, [0.5, 0.5]), (3200, [])]
    rows += [rows[3]] * 3                                              # repeated rows
    return spark.createDataFrame([(i, v, 1, 7, "x", 2) for i, v in rows], VECTORS)


def plain(df):
    return [(r.vec_id, list(r.embedding)) for r in df.collect() if r.vec_id is not None and r.embedding is not None
            and all(x is not None and np.isfinite(x) for x in r.embedding)]


def padded(rows, dim=8):
    return np.array([v + [0.0] * (dim - len(v)) for _, v in rows])


# ---- exact top-k -----------------------------------------------------------------------
@pytest.mark.parametrize("bins,rows,spare", [(256, 2048, 32), (4, 64, 0)])
def test_topk_equals_brute_force(spark, monkeypatch, bins, rows, spare):
    monkeypatch.setattr(topk, "BINS", bins)
    monkeypatch.setattr(topk, "ROWS_PER_BLOCK", rows)
    monkeypatch.setattr(topk, "SPARE", spare)
    df = awkward(spark)
    known = plain(df)
    m = np.floor(256 * padded(known)).astype(int)
    ids = np.array([i for i, _ in known])
    want = Counter()
    for at in np.flatnonzero(ids % 50 == 0):
        s = m @ m[at]
        order = [j for j in np.lexsort((ids, -s)) if ids[j] != ids[at]][:5]
        want.update((int(ids[at]), r + 1, int(ids[j]), int(s[j])) for r, j in enumerate(order))
    assert Counter(map(tuple, topk.search(df, F.col("id") % 50 == 0, 5).collect())) == want


def test_topk_by_shuffle_gives_the_same(spark, monkeypatch):
    df = awkward(spark, 300)
    want = sorted(map(tuple, topk.search(df, F.col("id") % 50 == 0, 5).collect()))
    monkeypatch.setattr(topk, "BROADCAST_BYTES", -1)
    monkeypatch.setattr(topk, "ROWS_PER_BLOCK", 64)
    monkeypatch.setattr(topk, "ROW_BLOCKS_PER_TASK", 2)
    assert sorted(map(tuple, topk.search(df, F.col("id") % 50 == 0, 5).collect())) == want


def test_topk_of_large_components_few_rows_and_empty_tables(spark):
    df = spark.createDataFrame([(0, [1e300]), (1, [1e300]), (2, [-1e300]), (50, [3.0])], "vec_id long, embedding array<double>")
    got = {(r.query_id, r.vec_id): r.score for r in topk.search(df, F.col("id") % 50 == 0, 5).collect()}
    assert got[(0, 1)] == topk.LARGEST and got[(0, 2)] == -topk.LARGEST and len(got) == 6
    assert topk.search(df.limit(0), F.col("id") % 50 == 0, 5).count() == 0
    assert topk.search(df.filter("vec_id = 1"), F.col("id") % 50 == 0, 5).count() == 0


def whole_topk(known, k=5, step=50, scale=256):
    """Brute force in Python's integers."""
    m = [(i, [math.floor(scale * x) for x in v]) for i, v in known]
    for i, v in m:
        if i % step == 0:
            near = sorted((-sum(a * b for a, b in zip(v, w)), j) for j, w in m if j != i)
            yield from ((i, r + 1, j, -s) for r, (s, j) in enumerate(near[:k]))


def test_topk_of_scores_that_crowd_one_bin(spark, monkeypatch):
    """Intervals nest: scores above the chosen bin must not be counted in the next pass again."""
    monkeypatch.setattr(topk, "SPARE", 0)
    rng = np.random.default_rng(3)
    known = [(i, (1 + 0.01 * rng.normal(size=4)).tolist()) for i in range(1200)]
    df = spark.createDataFrame(known, "vec_id long, embedding array<double>")
    assert sorted(map(tuple, topk.search(df, F.col("id") % 50 == 0, 5).collect())) == sorted(whole_topk(known))


def test_topk_of_scores_up_to_the_range_of_a_long(spark):
    """Scores beyond 2**61 are exact, too."""
    size = 3e6
    rng = np.random.default_rng(4)
    known = [(i, (size * rng.uniform(-1, 1, 8)).tolist()) for i in range(100)] + [(150, [size * 2] * 6), (151, [size / 20] * 6), (152, [0.1])]
    want = sorted(whole_topk(known))
    assert max(s for *_, s in want) > 2 ** 61
    df = spark.createDataFrame(known, "vec_id long, embedding array<double>")
    assert sorted(map(tuple, topk.search(df, F.col("id") % 50 == 0, 5).collect())) == want


def test_topk_equals_sql(spark, tmp_path):
    rng = np.random.default_rng(2)
    df = spark.createDataFrame([(i, rng.normal(size=6).tolist()) for i in range(400)], "vec_id long, embedding array<float>")
    at = folder(tmp_path, embeddings=df)
    con = duckdb.connect()
    con.execute(f"CREATE VIEW embeddings AS SELECT * FROM read_parquet('{at}/embeddings.parquet/*.parquet')")
    res = con.execute(sql.TOPK)
    out = queries.op9_topk(spark, at)
    assert rows_of(out.columns, [tuple(r) for r in out.collect()]) == rows_of([d[0] for d in res.description], res.fetchall())


# ---- approximate neighbours ---------------------------------------------------------------
def nearest(known, k, step):
    m, ids = padded(known), np.array([i for i, _ in known])
    for at in np.flatnonzero(ids % step == 0):
        s = m @ m[at]
        yield int(ids[at]), s, [j for j in np.lexsort((ids, -s)) if ids[j] != ids[at]][:k]


def test_ann_recall_and_exact_scores(spark, monkeypatch):
    monkeypatch.setattr(ann, "SHARD", 256)
    df = awkward(spark).dropDuplicates(["vec_id"])
    known = [(i, v) for i, v in plain(df) if any(v)]
    ids = np.array([i for i, _ in known])
    got = {}
    for r in ann.search(df, F.col("id") % 20 == 0, 20).collect():
        got.setdefault(r.query_id, []).append(r)
    hit = total = 0
    for q, s, order in nearest(known, 20, 20):
        rows = sorted(got[q], key=lambda r: r["rank"])
        assert [r["rank"] for r in rows] == list(range(1, 21)) and q not in [r.vec_id for r in rows]
        assert [(-r.score, r.vec_id) for r in rows] == sorted((-r.score, r.vec_id) for r in rows)
        for r in rows:
            assert r.score == pytest.approx(s[np.flatnonzero(ids == r.vec_id)[0]], abs=1e-12)
        hit += len({r.vec_id for r in rows} & set(ids[order].tolist()))
        total += 20
    assert set(got) == {int(i) for i in ids if i % 20 == 0} and hit / total >= 0.9


def test_ann_repeats_of_one_id_hide_no_other_id(spark):
    rng = np.random.default_rng(4)
    hot = [1.0] * 4
    rows = [(0, [1.0, 1.0, 1.0, 0.9])] + [(5, hot)] * 30 + [(i, hot) for i in range(6, 31) if i != 20] \
        + [(100 + i, (0.1 * rng.normal(size=4)).tolist()) for i in range(50)]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<double>")
    got = sorted((r["rank"], r.vec_id) for r in ann.search(df, F.col("id") == 0, 20).collect())
    assert got == list(enumerate([i for i in range(5, 31) if i != 20][:20], 1))


def test_ann_by_shuffle_gives_the_same(spark, monkeypatch):
    df = awkward(spark, 400)
    want = sorted(map(tuple, ann.search(df, F.col("id") % 20 == 0, 5).collect()))
    monkeypatch.setattr(ann, "BROADCAST_BYTES", -1)
    assert sorted(map(tuple, ann.search(df, F.col("id") % 20 == 0, 5).collect())) == want


def test_ann_of_few_rows_and_empty_tables(spark):
    df = spark.createDataFrame([(0, [1.0, 0.0]), (1, [1.0, 1.0]), (2, [0.0, 0.0])], "vec_id long, embedding array<float>")
    assert list(map(tuple, ann.search(df, F.col("id") == 0, 20).collect())) == [(0, 1, 1, 1.0)]
    assert ann.search(df.limit(0), F.col("id") == 0, 20).count() == 0
    assert ann.search(df, F.col("id") == 7, 20).count() == 0


# ---- url rules -----------------------------------------------------------------------------
URLS = [
    None, "", "no scheme", "http://", "http:///en/1", "http://EXAMPLE.org/en/1", "https://a.example.org/es/x?y#z",
    "https://notexample.org/es/x", "x://org/", "x://org", "x://org?/", "x://a..org/q", "x://.org/", "x://org./",
    "http://user@example.org/es/", "http://example.org:80/es/", "ftp://É.example.org/es/é", "a://b.com/fr/ff", "a://com/de/",
    "a://b.com/de?x", "a://b.com/fr", "http://x.com//fr/", "http://h.net/a://c.org/", "x://ORG/A",
]


def test_rules_equal_sql_on_awkward_urls(spark, tmp_path):
    rng = random.Random(3)
    hosts = ["org", "example.org", "a.example.org", "b.com", "com", "x.net", "EXAMPLE.org"]
    urls = URLS + [f"http://{rng.choice(hosts)}/{rng.choice(['en/1', 'en/12', 'es/', 'fr/q', 'de/', ''])}{rng.choice(['', '?a', '#b'])}"
                   for _ in range(400)] + ["http://a.example.org/en/17"] * 300
    df = spark.createDataFrame([(None if i == 3 else i, u, "h", "x", 1) for i, u in enumerate(urls)] + [(9, URLS[9], "h", "x", 1)] * 2,
                               "page_id long, url string, html string, host string, row int")
    at = folder(tmp_path, pages=df)
    con = duckdb.connect()
    con.execute(f"CREATE VIEW pages AS SELECT * FROM read_parquet('{at}/pages.parquet/*.parquet')")
    res = con.execute(sql.url_filter(queries.URL_RULES))
    out = queries.op2_url_filter(spark, at)
    assert "Python" not in out._jdf.queryExecution().toString()
    assert rows_of(out.columns, [tuple(r) for r in out.collect()]) == rows_of([d[0] for d in res.description], res.fetchall())


def test_deeply_nested_rules_equal_brute_force(spark):
    rng = random.Random(4)
    hosts = ["com", "a.com", "b.a.com", "c.b.a.com", "org", "a.org", "net"]
    rules = [(rng.choice(hosts), "/" + "".join(rng.choices("xy", k=rng.randint(0, 5))), rng.choice(["allow", "block"])) for _ in range(60)]
    rules += [("com", None, "block"), (None, "/", "allow"), ("", "/", "allow"), ("a.com", "/x", None), ("org", "/", "allow"), ("org", "/", "block")]
    urls = [(i, f"http://{rng.choice(['', 'z.'])}{rng.choice(hosts)}/{''.join(rng.choices('xyz', k=rng.randint(0, 7)))}") for i in range(300)]
    table = spark.createDataFrame(rules, "host string, path string, verdict string")
    got = {r.page_id: (r.rule, r.verdict) for r in
           url_filter.judged(spark.createDataFrame(urls, "page_id long, url string"), table, default="block").collect()}
    for i, u in urls:
        host, _, path = u.removeprefix("http://").partition("/")
        fits = [(len(h + (p or "")), len(h), h + (p or ""), v) for h, p, v in rules if h and v
                and (host == h or host.endswith("." + h)) and ("/" + path).startswith(p or "")]
        assert got[i] == (max(fits)[2:] if fits else (None, "block")), (u, fits)


def test_no_pages_and_no_rules(spark):
    pages = spark.createDataFrame([(1, "http://a.org/x")], "page_id long, url string")
    none = url_filter.rules_table(spark, [])
    assert [tuple(r) for r in url_filter.judged(pages, none).collect()] == [(1, "a.org", "/x", None, "allow")]
    rules = url_filter.rules_table(spark, queries.URL_RULES)
    assert url_filter.judged(pages.limit(0), rules).count() == 0
