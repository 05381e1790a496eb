"""Rows, nodes and texts that hold a large share of the work: equal results, spread over tasks."""

import random
import time

from pyspark.sql import functions as F

from panora.llm import mixing, pii, simhash, token_files
from panora.session import scratch_path


def test_many_spans_in_one_text(spark):
    """Every span of a long text at its place; the time grows with the spans, not with their square."""
    def run(texts):
        df = spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "doc_id long, text string").coalesce(1)
        start = time.time()
        out = pii.redact(df, pii.Model()).collect()
        return {r.doc_id: r.text for r in out}, time.time() - start
    unit = "a1.b@x.org 10.0.0.7 +49 30 1234567 "
    run([unit])
    n = 1200
    many, slow = run([unit * n * 10])
    few, quick = run([unit * n] * 10)
    assert many[0] == few[0] * 10 and few[0] == "[EMAIL] [IP] [PHONE] " * n
    assert slow < 3 * quick + 5


def test_overlapping_spans_across_strides(spark, monkeypatch):
    rng = random.Random(3)
    rows = []
    for i in range(30):
        base = sorted((s, k, s + rng.randint(1, 9)) for s, k in {(rng.randint(0, 300), rng.randint(0, 3)) for _ in range(40)})
        more = [(s, rng.choice([4, 5]), s + rng.randint(1, 12)) for s in rng.sample(range(300), 40)]
        rows.append((i, base, more))
    span = "array<struct<start:int,kind:int,end:int>>"
    df = spark.createDataFrame(rows, f"i int, __pii_base {span}, m {span}").withColumn(
        "__pii_more", F.transform("m", lambda c: F.struct(c["start"].alias("start"), c["kind"].alias("kind"), c["end"].alias("end"),
                                                          F.array(F.lit(0)).alias("f"))))
    class All:
        thresholds = {4: 0.0, 5: 0.0}

        def score(self, f):
            return F.lit(1.0)
    monkeypatch.setattr(pii, "STRIDE", 7)
    for r in pii.detect(df, All()).collect():
        _, base, more = rows[r.i]
        free = [c for c in more if not any(b[0] < c[2] and c[0] < b[2] for b in base)]
        assert [tuple(s) for s in r["__pii_spans"]] == sorted(base + free)


def test_a_wide_star_and_a_chain(spark):
    star = spark.range(1, 20_001).select(F.lit(0).cast("long").alias("u"), F.col("id").alias("v"))
    chain = spark.range(30_000, 30_040).select(F.col("id").alias("u"), (F.col("id") + 1).alias("v"))
    got = simhash.connected(star.unionByName(chain).unionByName(star.limit(5)))
    assert {r.label: r["count"] for r in got.groupBy("label").count().collect()} in (
        {0: 20_000, 30_000: 40}, {0: 20_001, 30_000: 41})


def test_one_document_on_most_rows_is_written_by_many_tasks(spark, monkeypatch):
    monkeypatch.setattr(token_files, "PART_BYTES", 20_000)
    rows = [(7, "the same words of one document again")] * 6_000 + [(None, None)] * 3_000 + [(i, f"text {i}") for i in range(50)]
    df = spark.createDataFrame(rows, "doc_id long, text string").repartition(6)
    out = scratch_path(spark, "hot-tokens")
    token_files.write_tokens(df, out)
    parts = [r.n for r in spark.read.parquet(f"{out}/segments").groupBy("part").agg(F.sum("n_ids").alias("n")).collect()]
    assert len(parts) > 4 and max(parts) < 0.5 * sum(parts)
    read = token_files.read_tokens(spark, out).orderBy("start").collect()
    assert len(read) == len(rows) and [r.start for r in read] == [sum(x.n_tokens for x in read[:i]) for i in range(0, 5)] + [
        r.start for r in read[5:]]
    at = 0
    for r in read:
        assert r.start == at
        at += r.n_tokens


def test_a_row_that_stands_for_very_many_copies(spark, monkeypatch):
    monkeypatch.setattr(mixing, "RUN", 100)
    df = spark.createDataFrame([(1, "one two three", "en", "src0")] * 999 + [(2, "four five", "en", "src0")] * 3,
                               "doc_id long, text string, lang string, source string")
    out = mixing.mixed(df, budget=2_000)
    assert out.agg(F.sum(F.size(F.split("text", " ")))).first()[0] == 2_000


def test_of_rows_alike_in_id_and_text_one_fixed_row_stays(spark):
    df = spark.createDataFrame([(1, "same text here", "de", i) for i in range(40)], "doc_id long, text string, lang string, n int")
    for parts in (1, 5):
        assert [tuple(r) for r in simhash.dedup(df.repartition(parts)).collect()] == [(1, "same text here", "de", 0)]
