"""Ranked search against a plain scan of all documents."""

import math
import random
import re
from collections import Counter

import pytest

from panora.llm import lexical
from panora.llm.queries import op13_lexical_search
from tests.llm.helpers import ODD_TEXTS, folder, no_docs, odd_docs, prose

ITEMS = "item_id long, text string, doc_id string, score int"
TERM = re.compile("[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+")


def terms(text):
    return TERM.findall("".join(c.lower() if "A" <= c <= "Z" else c for c in text or ""))


def plain(docs, items, k=10):
    own = [(d, Counter(terms(t))) for d, t in docs]
    own = [(d, c) for d, c in own if c]
    n, total = len(own), sum(sum(c.values()) for _, c in own)
    df = Counter(t for _, c in own for t in c)
    out = []
    for item, text in items:
        asked = set(terms(text))
        ranked = []
        for d, c in own:
            m = 10 + 90 * sum(c.values()) * n // total
            score = sum(math.floor(1000 * math.log((2 * n + 2) / (2 * df[t] + 1))) * (10 ** 9 * c[t] // (1000 * c[t] + 8 * m))
                        for t in asked if t in c)
            if score > 0:
                ranked.append((-score, d is None, d))
        out += [(item, r, None if none else d, -s) for r, (s, none, d) in enumerate(sorted(ranked, key=lambda x: (*x[:2], x[2] or 0))[:k], 1)]
    return sorted(out, key=repr)


def got(df):
    return sorted((tuple(r) for r in df.collect()), key=repr)


def asked(spark, rows):
    return spark.createDataFrame([(i, t, "x", 1) for i, t in rows], ITEMS)


@pytest.fixture(scope="module")
def docs(spark):
    return odd_docs(spark)


QUERIES = [(1, "the re an ing"), (2, None), (3, ""), (4, "THE the The re"), (5, "unknown words only zzz"), (6, "日本語 テスト a"),
           (7, "word foo"), (None, "x y z of to"), (1, "the re an ing"), (9, "ñ" * 100 + " 12 ab12"), (1, "que de la")]


@pytest.mark.parametrize("block_docs, visit", [(4096, 32), (2, 1), (1, 3)])
def test_plain_scan(spark, docs, monkeypatch, block_docs, visit):
    monkeypatch.setattr(lexical, "BLOCK_DOCS", block_docs)
    monkeypatch.setattr(lexical, "VISIT_ROWS", visit)
    rows = [(r.doc_id, r.text) for r in docs.collect()]
    assert got(lexical.search(docs, asked(spark, QUERIES))) == plain(rows, QUERIES)


def test_query_blocks(spark, docs, monkeypatch):
    monkeypatch.setattr(lexical, "QUERY_BLOCK_BYTES", 40)
    rows = [(r.doc_id, r.text) for r in docs.collect()]
    assert got(lexical.search(docs, asked(spark, QUERIES), k=3)) == plain(rows, QUERIES, 3)


def test_many_documents_of_one_length_and_many_ties(spark):
    rng = random.Random(8)
    rows = [(i, " ".join(rng.choices("abcdefgh", k=12))) for i in range(3000)] + [(7, "a a a a")] * 500
    df = spark.createDataFrame(rows, "doc_id long, text string").repartition(7)
    items = [(i, " ".join(rng.sample("abcdefgh", 3))) for i in range(20)]
    assert got(lexical.search(df, asked(spark, items))) == plain(rows, items)


def test_no_rows(spark, docs):
    assert lexical.search(no_docs(spark), asked(spark, QUERIES)).count() == 0
    out = lexical.search(docs, asked(spark, []))
    assert out.count() == 0 and out.columns == ["item_id", "rank", "doc_id", "score"]


def test_terms_of_long_texts_in_slices(monkeypatch):
    texts = [*(t or "" for t in ODD_TEXTS), prose(random.Random(9), 3000), "x" * 300 + " y"]
    monkeypatch.setattr(lexical, "SLICE_BYTES", 100)
    for t in texts:
        assert lexical.term_counts(t) == {k.encode(): v for k, v in Counter(terms(t)).items()}


def test_bounds_hold_and_skip_strata(spark):
    """No document of a stratum beats its bound, and sorted visits leave strata out."""
    rng = random.Random(10)
    rows = [(i, prose(rng, rng.choice([5, 20, 80, 300]))) for i in range(400)]
    df = spark.createDataFrame(rows, "doc_id long, text string")
    vocabulary = {t: i for i, t in enumerate(sorted({t.encode() for _, x in rows for t in terms(x)}))}
    freqs = lexical._frequencies(df, vocabulary)
    n, total = 400, sum(len(terms(x)) for _, x in rows)
    index = lexical._stratified(freqs, n, total).collect()
    assert sorted(d for r in index for d in r.docs) == list(range(400))
    strata = [lexical.Stratum(*r, len(vocabulary)) for r in index]
    visited = 0
    for _ in range(20):
        own = rng.sample(range(len(vocabulary)), 6)
        weights = [rng.randint(1, 5000) for _ in own]
        bounds = [sum(int(s.top[t]) * w for t, w in zip(own, weights)) for s in strata]
        best = lexical.Best(10)
        for b, s in sorted(zip(bounds, strata), key=lambda x: -x[0]):
            scores = s.scores(own, weights)
            assert scores.max(initial=0) <= b
            if b >= best.bar:
                visited += 1
            best.offer(scores, s.docs)
    assert visited < 0.9 * 20 * len(strata)


def test_query(spark, tmp_path, docs):
    sf = folder(tmp_path, documents=docs, benchmark=asked(spark, QUERIES))
    rows = [(r.doc_id, r.text) for r in docs.collect()]
    assert got(op13_lexical_search(spark, sf)) == plain(rows, QUERIES)
