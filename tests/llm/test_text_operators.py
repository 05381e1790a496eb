"""Op 1, 5, 6, 7 and the pipeline against brute force."""

import random
import re
from collections import Counter, defaultdict

import duckdb
import numpy as np
import pytest
import xxhash
from pyspark.sql import functions as F

import corpus_pipeline
from panora.llm import mixing, pii, quality, queries, simhash, sql
from panora.llm.common import landed
from tests.llm.helpers import folder, no_docs, odd_docs, prose, sha
from tests.oracle_check import rows_of


# ---- personal data ------------------------------------------------------------------
def luhn(digits):
    total = 0
    for i, c in enumerate(reversed(digits)):
        x = int(c) * (1 + i % 2)
        total += x - 9 if x > 9 else x
    return total % 10 == 0


def base_spans(text):
    t, out = text or "", []
    out += [(m.start(), 0, m.end()) for m in re.finditer(r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+", t)]
    out += [(m.start(), 1, m.end()) for m in re.finditer(r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)", t)
            if all(int(x) <= 255 for x in m[0].split("."))]
    for m in re.finditer(r"[0-9]([\x20-]?[0-9])+", t):
        d = re.sub("[^0-9]", "", m[0])
        if 12 <= len(d) <= 19 and luhn(d):
            out.append((m.start(), 2, m.end()))
    out += [(m.start(), 3, m.end()) for m in re.finditer(r"\+[0-9][\x20().0-9-]+[0-9]", t)
            if 9 <= len(re.sub("[^0-9]", "", m[0])) <= 15]
    return sorted(out)


PRIVATE = [
    "a@b.c_d@e.f x", "😀😀 j.doe@x.org, +1 (555) 444-3333 and 4111 1111 1111 1111.", "1.2.3.4.5.6.7.8 999.1.1.1 0001.002.3.4",
    "4111-1111-1111-1112 4111111111111111111111", "+49 30 1234567 +1 2 3", "a" * 50000 + "@b.co", "1 " * 30000,
    "x@y " * 5, "1.2.3 4.5.6.7 256.1.1.1", "+" * 1000 + "1 23456789", "é@ü.de foo@bar.é a@-.-", "12 34-56 7890123456-",
    "n\n4619646426088949\n+1 (486) 555-3535", "(" * 20000 + "1" * 40000, "a@b.c " * 700, "٣٤ 4111111111111111",
]


@pytest.fixture(scope="module")
def private(spark, tmp_path_factory):
    rng = random.Random(3)
    chars = list("0123456789") * 3 + list(" -.+@()ab\n😀é")
    noise = ["".join(rng.choices(chars, k=rng.randint(5, 300))) for _ in range(300)]
    cards = [f"pay with card 4111111111111{n:03d} now" for n in range(1000)]
    docs = odd_docs(spark, PRIVATE + noise + cards)
    return docs, folder(tmp_path_factory.mktemp("private"), documents=docs)


def test_base_spans_equal_the_plain_patterns(spark, private):
    docs, at = private
    want = Counter()
    for r in docs.collect():
        b = base_spans(r.text)
        text = ",".join(f"{pii.KINDS[k]}:{a}:{e}" for a, k, e in b)
        want[(r.doc_id, *(sum(k == i for _, k, _ in b) for i in range(4)), sha(text))] += 1
    got = queries.op1_pii(spark, at).collect()
    assert Counter(tuple(r)[:6] for r in got) == want
    for r in got:   # base spans stay; spans are sorted
        spans = [s.split(":") for s in r.spans.split(",") if s]
        assert sum(k in pii.KINDS[:4] for k, _, _ in spans) == r.n_email + r.n_ip + r.n_card + r.n_phone
        assert [(int(a), pii.KINDS.index(k)) for k, a, _ in spans] == sorted((int(a), pii.KINDS.index(k)) for k, a, _ in spans)


def test_redaction_replaces_every_span(spark, private):
    docs, _ = private
    docs = docs.filter("doc_id is not null").dropDuplicates(["doc_id"])
    model = pii.fit(pii.candidates(docs))
    spans = {r.doc_id: [(s.start, s.kind, s.end) for s in r.s] for r in
             pii.detect(pii.candidates(docs), model).select("doc_id", F.col("__pii_spans").alias("s")).collect()}
    texts = {r.doc_id: r.text for r in docs.collect()}
    got = pii.redact(docs, model)
    assert got.columns == docs.columns
    for r in got.collect():
        merged = []
        for a, k, b in spans[r.doc_id]:
            if merged and merged[-1][2] > a:
                merged[-1] = (merged[-1][0], merged[-1][1], max(merged[-1][2], b))
            else:
                merged.append((a, k, b))
        want = texts[r.doc_id]
        for a, k, b in reversed(merged):
            want = want[:a] + f"[{pii.KINDS[k].upper()}]" + want[b:]
        assert r.text == want and (not merged or r.n_chars == len(want))


def test_trees_add_what_looks_like_personal_data():
    # a format that is nearly always valid, one that is rarely, cues that do not matter
    cells = [((1, 5, 0, 0, 0, 0, 0, c), 400, 2) for c in range(3)] + [((1, 2, 3, 0, 0, 1, 0, c), 1, 300) for c in range(3)]
    model = pii.train(cells)
    assert model.plain((1, 5, 0, 0, 0, 0, 0, 1)) >= model.thresholds[5] > model.plain((1, 2, 3, 0, 0, 1, 0, 1))
    assert pii.train([((0,) * 8, 0, 50)]).thresholds == {}


def test_column_score_equals_the_plain_score(spark):
    rng = random.Random(6)
    cells = [(tuple(rng.randrange(n) for n in pii.FEATURES.values()), rng.randint(0, 9), rng.randint(0, 9)) for _ in range(200)]
    model = pii.train(cells)
    df = spark.createDataFrame([(list(f),) for f, _, _ in cells], "f array<int>")
    for r in df.select("f", model.score(F.col("f")).alias("s")).collect():
        assert r.s == pytest.approx(model.plain(tuple(r.f)))


def test_a_failed_check_that_looks_valid_is_added(spark):
    docs = spark.createDataFrame([(i, f"card 4111 1111 1111 1111 a{i}") for i in range(400)] + [(999, "card 4111 1111 1111 1112 b")],
                                 "doc_id long, text string")
    c = pii.candidates(docs)
    spans = pii.detect(c, pii.fit(c)).filter("doc_id = 999").select(pii.shown(F.col("__pii_spans"))).first()[0]
    assert spans == "number_like:5:24"


@pytest.mark.parametrize("n", [8, 300])
def test_national_phone_numbers_are_added_and_order_numbers_are_not(spark, n):
    texts = [f"please call (555) 444-{3000 + i} now" for i in range(n)] + [f"some (555) 444-{5000 + i} here" for i in range(n)] \
        + [f"order 2024/{12345678 + i} x" for i in range(n)] + [f"card 4111 1111 1111 1111 a{i}" for i in range(n)]
    c = pii.candidates(spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string"))
    got = pii.detect(c, pii.fit(c)).select("doc_id", pii.shown(F.col("__pii_spans")).alias("s")).collect()
    want = ["number_like:13:26", "number_like:6:19", "", "card:5:24"]
    assert {r.doc_id: r.s for r in got} == {i: want[i // n] for i in range(4 * n)}


def test_personal_data_of_an_empty_table(spark):
    assert pii.redact(no_docs(spark)).count() == 0


# ---- quality ------------------------------------------------------------------------
def good_and_bad(spark, n=1500):
    rng = random.Random(8)
    rows, labels = [], []
    for i in range(n):
        good = rng.random() < 0.7
        text = prose(rng, rng.randint(5, 200)).capitalize() + "."
        if not good:
            text = re.sub(" ", lambda m: rng.choice(["$$$ ", "*** ", " | "]), text)
        rows.append((i, text))
        labels.append((i, int(good)))
    return (spark.createDataFrame(rows, "doc_id long, text string"),
            spark.createDataFrame(labels, "doc_id long, quality int"))


def test_held_out_accuracy(spark):
    docs, labels = good_and_bad(spark)
    model = quality.fit(docs, labels)
    got = quality.score(docs, model).join(labels, "doc_id").withColumn("held", quality.held_out()).collect()
    held = [r for r in got if r.held]
    assert 200 < len(held) < 400 and all(0 <= r.score <= 1 for r in got)
    assert np.mean([(r.score >= quality.THRESHOLD) == (r.quality == 1) for r in held]) > 0.97


def test_held_out_labels_are_never_read(spark):
    docs, labels = good_and_bad(spark, 400)
    other = labels.withColumn("quality", F.when(quality.held_out(), 1 - F.col("quality")).otherwise(F.col("quality")))
    scores = lambda lab: sorted(map(tuple, quality.score(docs, quality.fit(docs, lab)).collect()))
    assert scores(labels) == scores(other)


def test_pairs_learn_what_features_alone_cannot():
    rng = np.random.default_rng(1)
    x = rng.random((4000, 3))
    y = ((x[:, 0] > 0.5) ^ (x[:, 1] > 0.5)).astype(float)
    model = quality.train(x, y)
    assert model.pair_cuts and ((model.score(x) > 0.5) == y).mean() > 0.9


def test_quality_of_awkward_tables(spark):
    docs = odd_docs(spark)
    labels = spark.createDataFrame([(1, 1), (1, 0), (None, 1), (4, None), (12, 1)], "doc_id long, quality int")
    for lab in (labels, labels.limit(0)):
        model = quality.fit(docs, lab)
        assert quality.score(docs, model).count() == docs.count()
    assert {round(r.score, 6) for r in quality.score(docs, quality.fit(docs, labels.limit(0))).collect()} == {0.5}
    kept = quality.keep_good(docs, model, 0.0)
    assert kept.schema == docs.schema and sorted(map(str, kept.collect())) == sorted(map(str, docs.collect()))
    assert quality.score(no_docs(spark), model).count() == 0


# ---- SimHash -------------------------------------------------------------------------
def fingerprint(text):
    words = re.findall(r"[^\x20\x09-\x0D]+", re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))
    k = min(3, len(words))
    h = [xxhash.xxh64_intdigest(" ".join(words[i:i + k]).encode(), seed=42) for i in range(len(words) - k + 1)] if words else []
    return sum(1 << b for b in range(64) if 2 * sum(x >> b & 1 for x in h) > len(h))


def groups(values, max_bits):
    """Smallest index reachable over values within max_bits."""
    a = np.array(values, np.uint64)
    near = np.bitwise_count(a[:, None] ^ a[None, :]) <= max_bits
    label = np.arange(len(a))
    while True:
        new = np.where(near, label[None, :], len(a)).min(axis=1)
        if (new == label).all():
            return label
        label = new


def test_components_equal_brute_force(spark):
    rng = random.Random(9)
    originals = [prose(rng, 300) for _ in range(6)]
    near = []
    for t in originals:
        for _ in range(4):
            words = t.split()
            words[rng.randrange(len(words))] = "changed"
            near.append(" ".join(words))
    docs = odd_docs(spark, originals + near)
    rows = docs.collect()
    prints = [fingerprint(r.text) for r in rows]
    label = groups(prints, 2)
    first = defaultdict(list)
    for r, g in zip(rows, label):
        if r.doc_id is not None:
            first[g].append(r.doc_id)
    want = Counter((r.doc_id, f"{p:016x}", min(first[g], default=None)) for r, p, g in zip(rows, prints, label))
    got = simhash.components(docs).select("doc_id", F.lpad(F.lower(F.hex("fp")), 16, "0"), "component_id").collect()
    assert Counter(map(tuple, got)) == want
    kept = simhash.dedup(docs)
    assert kept.columns == docs.columns and kept.count() == len(set(label.tolist()))
    assert len(set(groups([fingerprint(r.text) for r in kept.collect()], 2).tolist())) == len(set(label.tolist()))


@pytest.mark.parametrize("max_bits,max_node", [(2, 8192), (2, 16), (1, 16), (3, 64)])
def test_trie_join_finds_every_link(spark, max_bits, max_node):
    rng = np.random.default_rng(10)
    values = set()
    for base in rng.integers(0, 2**63, 25, dtype=np.uint64):
        for _ in range(25):
            x = int(base)
            for k in rng.integers(0, 64, rng.integers(0, 4)):
                x ^= 1 << int(k)
            values.add(x)
    hot = 0x123456789ABCDEF
    values |= {hot ^ (1 << i) ^ (1 << j) for i in range(30) for j in range(i)}   # one crowded node
    values = sorted(values)
    label = groups(values, max_bits)
    signed = np.array(values, np.uint64).view(np.int64).tolist()
    df = spark.createDataFrame([(x,) for x in signed], "fp long")
    reached = {r.node: r.label for r in simhash.connected(simhash.links(df, max_bits, max_node)).collect()}
    got, want = defaultdict(set), defaultdict(set)
    for x, g in zip(signed, label):
        got[reached.get(x, x)].add(x)
        want[g].add(x)
    assert sorted(map(sorted, got.values())) == sorted(map(sorted, want.values()))


def test_long_chains_connect(spark):
    edges = spark.createDataFrame([(i, i + 1) for i in range(60)] + [(i, i) for i in range(5)] + [(200, 100)], "u long, v long")
    got = {r.node: r.label for r in simhash.connected(edges).collect()}
    assert got == {**{i: 0 for i in range(1, 61)}, 200: 100}


def test_near_duplicates_of_an_empty_table(spark):
    assert simhash.components(no_docs(spark)).count() == 0
    assert simhash.dedup(no_docs(spark)).count() == 0


# ---- mixing --------------------------------------------------------------------------
def duck(tables):
    con = duckdb.connect()
    for name, path in tables.items():
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM read_parquet('{path}/*.parquet')")
    return con


def test_mixing_equals_sql_on_awkward_rows(spark, tmp_path):
    at = folder(tmp_path, documents=odd_docs(spark))
    df = queries.op7_mixing(spark, at)
    res = duck({"documents": f"{at}/documents.parquet"}).execute(sql.mixing())
    cols = [d[0] for d in res.description]
    assert sorted(cols) == sorted(df.columns)
    assert rows_of(df.columns, [tuple(r) for r in df.collect()]) == rows_of(cols, res.fetchall())


def test_budgets_fill_siblings_before_ancestors(spark):
    def docs(lang, source, n):
        return [(f"{lang}{source}{i}", "w " * 10, lang, source) for i in range(n)]
    rows = docs("en", "src0", 100) + docs("en", "src1", 2) + docs("de", "src0", 10) + docs("en", "src5", 100)
    df = spark.createDataFrame([(i, *r[1:]) for i, r in enumerate(rows)], "doc_id long, text string, lang string, source string")
    weights = {"domain": {"web": 1, "books": 1}, "lang": {"en": 1, "de": 1}, "source": {}}
    plan = {(r.domain, r.lang, r.source): r.budget for r in
            mixing.leaves(landed(mixing.entries_of(df), "e"), weights, 1200, 1).collect()}
    # web and books get 600 each; de can give 100 of its 300, so en takes 500; there
    # src1 can give 20 of its 250, so src0 takes 480
    assert plan == {("web", "de", "src0"): 100, ("web", "en", "src1"): 20, ("web", "en", "src0"): 480, ("books", "en", "src5"): 600}
    taken = mixing.budgeted(df, weights, 1200, 1).collect()
    per = defaultdict(int)
    for r in taken:
        per[(r.domain, r.lang, r.source)] += (r.times - 1) * r.tokens + r.last_take
    assert per == plan


def test_epochs_repeat_whole_sources(spark):
    df = spark.createDataFrame([(i, "a b c", "en", "src0") for i in range(10)], "doc_id long, text string, lang string, source string")
    got = mixing.mixed(df, budget=45, max_epochs=3)
    assert got.columns == df.columns and got.count() == 15
    assert Counter(Counter(r.doc_id for r in got.collect()).values()) == {1: 5, 2: 5}
    same = spark.createDataFrame([(1, "a b c", "en", "src0")] * 10, df.schema)     # repeated rows
    assert mixing.mixed(same, budget=15, max_epochs=3).count() == 5
    assert mixing.mixed(same, budget=45, max_epochs=3).count() == 15
    assert mixing.mixed(no_docs(spark)).count() == 0


@pytest.mark.parametrize("ids,budget", [(10, 46), (10, 14), (1, 46), (1, 14), (1, 28)])
def test_mixed_takes_exactly_the_budget(spark, ids, budget):
    text = "  a\tbb\n c "
    docs = spark.createDataFrame([(i % ids, text, "en", "src0", len(text)) for i in range(10)],
                                 "doc_id long, text string, lang string, source string, n_chars long")
    rows = mixing.mixed(docs, budget=budget, max_epochs=3).collect()
    assert sum(len(r.text.split()) for r in rows) == budget
    assert all(r.n_chars == len(r.text) for r in rows)
    short = [r.text for r in rows if r.text != text]
    assert short == [{1: "  a", 2: "  a\tbb"}[budget % 3]]


# ---- pipeline -------------------------------------------------------------------------
def test_stages_chain_and_take_effect(spark, tmp_path):
    docs, labels = good_and_bad(spark, 600)
    docs = docs.withColumns({"lang": F.lit("en"), "source": F.concat(F.lit("src"), F.col("doc_id") % 20), "n_chars": F.length("text")})
    docs = docs.unionByName(docs.limit(40).withColumn("doc_id", F.col("doc_id") + 5000)) \
        .withColumn("text", F.when(F.col("doc_id") % 9 == 0, F.concat("text", F.lit(" me@mail.example.com."))).otherwise(F.col("text")))
    at = folder(tmp_path, documents=docs, labels=labels)
    columns = docs.columns
    assert [n for n, _ in corpus_pipeline.STAGES] == ["quality", "near_duplicates", "personal_data", "mixing", "packing"]
    rows, kept = spark.read.parquet(f"{at}/documents.parquet"), {}
    for name, stage in corpus_pipeline.STAGES[:-1]:
        rows = landed(stage(spark, rows, at), "stage")
        assert rows.columns == columns
        kept[name] = rows.count()
    assert kept["quality"] < docs.count() and kept["near_duplicates"] < kept["quality"]
    assert kept["personal_data"] == kept["near_duplicates"]
    assert rows.filter("text like '%@%'").count() == 0 and rows.filter("text like '%[EMAIL]%'").count() > 0
    out = corpus_pipeline.run(spark, at)
    assert out.columns[:3] == ["doc_id", "start", "length"] and out.count() >= kept["mixing"]


def test_pipeline_of_empty_tables(spark, tmp_path):
    labels = spark.createDataFrame([], "doc_id long, quality int, toxic int")
    docs = spark.createDataFrame([], "doc_id long, text string, lang string, source string, n_chars long")
    at = folder(tmp_path, documents=docs, labels=labels)
    assert corpus_pipeline.run(spark, at).count() == 0


def test_pipeline_copes_with_awkward_rows(spark, tmp_path):
    labels = spark.createDataFrame([(i, i % 2, 0) for i in range(30)], "doc_id long, quality int, toxic int")
    at = folder(tmp_path, documents=odd_docs(spark), labels=labels)
    assert corpus_pipeline.run(spark, at).count() > 0
