"""Ranked lexical search on a length-stratified index.

Documents of one length normaliser m form a stratum.  Inside a stratum each term's
postings stand by term frequency tf, so that a posting's impact, which depends on
(tf, m) alone, is computed once per tf.  A stratum's bound for a query adds up, over the query's terms,
weight times the impact of the term's largest tf there; a task visits its strata in
descending order of their bounds and stops at the first one below the k-th best score it has.

1. one pass over whole texts lands each document's length and the frequencies of the
   terms that queries ask for;
2. sums over that table give N, L and the document frequencies;
3. the documents are dealt to their strata (a stratum of many documents to several blocks
   of about ``BLOCK_DOCS``) and each block is written as one index row;
4. the queries search all index rows; a task keeps k rows a query, which are ranked at last.

Queries are distinct texts, taken in blocks of bounded size, each block with passes of its own; only a
block's terms and weights are sent to the executors.

Defined results: terms are runs of ASCII letters, digits and characters beyond ASCII, A-Z
lower-cased; null and termless texts have no terms: such documents rank nowhere, such items get
no rows.  Every row is a document of its own (repeated rows rank separately; null ids
come last among equal scores); every item row gets its ranking, repeated ones too.  Empty
tables give no rows; extra columns are ignored.
"""

from __future__ import annotations

import math
import re

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_type

from panora.llm.common import SUB_ROWS, drop_landed, landed, ship

TERM = re.compile(rb"[0-9a-z\x80-\xff]+")
SLICE_BYTES = 1 << 20        # of a text, looked at at once
BLOCK_DOCS = 4096            # documents of an index row, about
QUERY_BLOCK_BYTES = 8 << 20  # query text handled by one set of passes
VISIT_ROWS = 32              # index rows a task holds at once
SCALE = 1_000_000_000


def term_counts(text: str | None) -> dict[bytes, int]:
    """Occurrences of every term of a whole text, slice by slice."""
    from collections import Counter

    data = (text or "").encode("utf-8", "surrogatepass").lower()     # bytes: A-Z only
    if len(data) <= SLICE_BYTES:
        return Counter(TERM.findall(data))
    counts: Counter = Counter()
    at = 0
    gap = re.compile(rb"[^0-9a-z\x80-\xff]")
    while at < len(data):
        cut = gap.search(data, min(at + SLICE_BYTES, len(data)))
        to = cut.start() if cut else len(data)
        counts.update(TERM.findall(data, at, to))
        at = to
    return counts


def impact(tf, m):
    """The share of a term's weight that tf occurrences in a document of normaliser m earn."""
    return (SCALE * tf) // (1000 * tf + 8 * m)


def weight(n: int, df: int) -> int:
    return math.floor(1000 * math.log((2 * n + 2) / (2 * df + 1)))


# --------------------------------------------------------------------------- index
def _frequencies(docs: DataFrame, vocabulary: dict[bytes, int]) -> DataFrame:
    """(doc_id, n, terms, tfs): length and frequencies of the asked terms, both
    as little-endian int32 and ordered by term; documents without terms are left out."""
    ship(docs.sparkSession)
    sent = docs.sparkSession.sparkContext.broadcast(vocabulary)
    schema = f"doc_id {docs.schema['doc_id'].dataType.simpleString()}, n long, terms binary, tfs binary"

    def run(batches):
        import numpy as np
        import pyarrow as pa

        known = sent.value
        for whole in batches:
            for i in range(0, whole.num_rows, SUB_ROWS):
                b = whole.slice(i, SUB_ROWS)
                keep, lengths, terms, tfs = [], [], [], []
                for row, text in enumerate(b.column(1)):
                    counts = term_counts(text.as_py())
                    if not counts:
                        continue
                    own = sorted((known[t], c) for t, c in counts.items() if t in known)
                    pair = np.array(own, "<i4").reshape(-1, 2)
                    keep.append(row)
                    lengths.append(sum(counts.values()))
                    terms.append(pair[:, 0].tobytes())
                    tfs.append(pair[:, 1].tobytes())
                yield pa.RecordBatch.from_arrays(
                    [b.column(0).take(pa.array(keep, pa.int64())), pa.array(lengths, pa.int64()),
                     pa.array(terms, pa.binary()), pa.array(tfs, pa.binary())], names=["doc_id", "n", "terms", "tfs"])
    return docs.select("doc_id", F.col("text").cast("string")).mapInArrow(run, schema)


def _document_frequencies(freqs: DataFrame, size: int) -> list[tuple[int, int]]:
    """(term, documents that hold it): one row per term of the block reaches the driver."""
    def run(batches):
        import numpy as np
        import pyarrow as pa

        held = np.zeros(size, np.int64)
        for b in batches:
            for t in b.column(0):
                held[np.frombuffer(t.as_buffer(), "<i4")] += 1
        some = np.flatnonzero(held)
        yield pa.RecordBatch.from_arrays([pa.array(some.astype(np.int32)), pa.array(held[some])], names=["term", "df"])

    counted = freqs.select("terms").mapInArrow(run, "term int, df long")
    return [(r.term, r.df) for r in counted.groupBy("term").agg(F.sum("df").alias("df")).collect()]


def _stratified(freqs: DataFrame, n: int, total: int) -> DataFrame:
    """Index rows (m, docs, terms, tfs, starts, places): the documents of one block of
    the stratum m, and per (term, tf), in this order, the places of its documents."""
    numbered = freqs.withColumn("m", F.expr(f"10L + (CAST(90 AS DECIMAL(38,0)) * n * {n}BD) div {total}BD"))
    # a table of its own: a join with it is broadcast by its real size, or split where one m is frequent
    sizes = landed(numbered.groupBy("m").agg(F.ceil(F.count(F.lit(1)) / BLOCK_DOCS).alias("blocks")), "lexical-strata")
    dealt = (numbered.withColumn("row", F.monotonically_increasing_id()).join(sizes, "m")
             .withColumn("block", F.pmod(F.xxhash64("row"), F.col("blocks"))))
    ordered = dealt.select("m", "block", "doc_id", "terms", "tfs").repartition("m", "block") \
        .sortWithinPartitions("m", "block")
    kind = freqs.schema["doc_id"].dataType
    form = to_arrow_type(kind)

    def run(batches):
        import numpy as np
        import pyarrow as pa
        from itertools import groupby

        def rows():
            for b in batches:
                yield from zip(*(b.column(i) for i in range(5)))

        for (m, _), group in groupby(rows(), key=lambda r: (r[0].as_py(), r[1].as_py())):
            docs, terms, tfs, sizes = [], [], [], []
            for r in group:                # about BLOCK_DOCS documents
                docs.append(r[2].as_py())
                terms.append(np.frombuffer(r[3].as_py(), "<i4"))
                tfs.append(np.frombuffer(r[4].as_py(), "<i4"))
                sizes.append(len(terms[-1]))
            place = np.repeat(np.arange(len(docs), dtype=np.int32), sizes)
            term, tf = np.concatenate(terms), np.concatenate(tfs)
            order = np.lexsort((place, tf, term))
            term, tf, place = term[order], tf[order], place[order]
            new = np.flatnonzero(np.concatenate(([True], (term[1:] != term[:-1]) | (tf[1:] != tf[:-1])))) \
                if len(term) else np.zeros(0, np.int64)
            yield pa.RecordBatch.from_arrays(
                [pa.array([m], pa.int64()), pa.array([docs], pa.list_(form)),
                 *[pa.array([x.astype("<i4").tobytes()], pa.binary()) for x in (term[new], tf[new], new, place)]],
                names=["m", "docs", "terms", "tfs", "starts", "places"])

    return ordered.mapInArrow(run, f"m long, docs array<{kind.simpleString()}>, terms binary, tfs binary, starts binary, places binary")


class Stratum:
    """An index row, opened: postings, impacts, and the largest impact of every term."""

    def __init__(self, m, docs, terms, tfs, starts, places, size):
        import numpy as np

        self.docs = docs
        groups, tfs, starts = (np.frombuffer(x, "<i4") for x in (terms, tfs, starts))
        self.places = np.frombuffer(places, "<i4")
        lengths = np.diff(np.append(starts, len(self.places)))
        values, which = np.unique(tfs, return_inverse=True)
        per_tf = np.array([impact(int(v), m) for v in values], np.int64)      # once per tf
        impacts = per_tf[which] if len(values) else np.zeros(0, np.int64)
        self.impacts = np.repeat(impacts, lengths)
        # a term's groups stand side by side, the largest tf last
        last = np.flatnonzero(np.append(groups[1:] != groups[:-1], True)) if len(groups) else np.zeros(0, np.int64)
        first = np.append(0, last[:-1] + 1) if len(last) else last
        self.top = np.zeros(size, np.int64)
        self.top[groups[last]] = impacts[last]
        self.start = np.zeros(size, np.int64)
        self.stop = np.zeros(size, np.int64)
        self.start[groups[last]] = starts[first] if len(last) else 0
        self.stop[groups[last]] = (starts + lengths)[last] if len(last) else 0

    def scores(self, terms, weights):
        """The query's score of every document of the row."""
        import numpy as np

        out = np.zeros(len(self.docs), np.int64)
        spans = [(self.start[t], self.stop[t], w) for t, w in zip(terms, weights) if self.stop[t] > self.start[t]]
        if sum(int(w) for *_, w in spans) * 1_000_000 < 2 ** 53:      # an impact is below 10**6: sums of doubles are exact
            if spans:
                at = np.concatenate([self.places[a:b] for a, b, _ in spans])
                by = np.concatenate([self.impacts[a:b] * w for a, b, w in spans])
                out = np.bincount(at, by, len(self.docs)).astype(np.int64)
            return out
        for a, b, w in spans:                 # a document occurs once per term
            out[self.places[a:b]] += self.impacts[a:b] * w
        return out


class Best:
    """The k best (score, id) pairs so far, higher scores first, then smaller ids, null ids last."""

    def __init__(self, k: int):
        self.k, self.rows = k, []

    @property
    def bar(self) -> int:
        """Scores below this cannot enter."""
        return self.rows[-1][0] if len(self.rows) == self.k else 1

    def offer(self, scores, docs) -> None:
        import numpy as np

        at = np.flatnonzero(scores >= self.bar)
        if len(at) > 4 * self.k:              # the k-th score raises the bar first
            bar = np.partition(scores[at], len(at) - self.k)[len(at) - self.k]
            at = at[scores[at] >= bar]
        if len(at):
            rows = self.rows + [(int(scores[i]), docs[i]) for i in at]
            self.rows = sorted(rows, key=lambda r: (-r[0], r[1] is None, r[1]))[:self.k]


def _searched(index: DataFrame, queries: list[tuple[int, list[int]]], weights: list[int], k: int) -> DataFrame:
    """(query, doc_id, score): at least the k best documents of every query."""
    ship(index.sparkSession)
    size = len(weights)
    sent = index.sparkSession.sparkContext.broadcast((queries, weights))
    kind = index.schema["docs"].dataType.elementType
    form = to_arrow_type(kind)

    def run(batches):
        import numpy as np
        import pyarrow as pa

        queries, weights = sent.value
        w = np.array(weights, np.int64)
        flat = np.concatenate([np.array(t, np.int64) for _, t in queries])
        starts = np.cumsum([0, *[len(t) for _, t in queries[:-1]]])
        terms = [np.array(t, np.int64) for _, t in queries]
        best = [Best(k) for _ in queries]

        def visit(strata):
            bounds = np.array([np.add.reduceat(s.top[flat] * w[flat], starts) for s in strata])
            for q, found in enumerate(best):
                for i in np.argsort(-bounds[:, q], kind="stable"):
                    if bounds[i, q] < found.bar:
                        break
                    found.offer(strata[i].scores(terms[q], w[terms[q]]), strata[i].docs)

        held = []
        for b in batches:
            for row in zip(*(b.column(i) for i in range(6))):
                held.append(Stratum(*(x.as_py() for x in row), size))
                if len(held) == VISIT_ROWS:
                    visit(held)
                    held = []
        if held:
            visit(held)
        out = [(queries[q][0], doc, score) for q, found in enumerate(best) for score, doc in found.rows]
        if out:
            q, d, s = zip(*out)
            yield pa.RecordBatch.from_arrays([pa.array(q, pa.int32()), pa.array(d, form), pa.array(s, pa.int64())],
                                             names=["query", "doc_id", "score"])
    return index.mapInArrow(run, f"query int, doc_id {kind.simpleString()}, score long")


def search(docs: DataFrame, items: DataFrame, k: int = 10) -> DataFrame:
    """(item_id, rank, doc_id, score): the k best documents of every item row."""
    spark = docs.sparkSession
    docs = docs.select("doc_id", "text")
    items = items.select("item_id", F.coalesce(F.col("text").cast("string"), F.lit("")).alias("text"),
                         F.sha2(F.coalesce(F.col("text").cast("string"), F.lit("")), 256).alias("key"))
    texts = landed(items.groupBy("key").agg(F.first("text").alias("text")), "lexical-queries")
    size = texts.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    blocks = max(1, -(-size // QUERY_BLOCK_BYTES))
    ranked = None
    for block in range(blocks):
        own = texts.filter(F.pmod(F.xxhash64("key"), F.lit(blocks)) == block).collect()   # about QUERY_BLOCK_BYTES
        found = _ranked(docs, [(r.key, sorted(term_counts(r.text))) for r in own], k)
        if found is not None:
            ranked = found if ranked is None else ranked.unionByName(found)
    if ranked is None:
        ranked = spark.createDataFrame([], f"key string, rank int, doc_id {docs.schema['doc_id'].dataType.simpleString()}, "
                                           "score long")
    return items.select("item_id", "key").join(ranked, "key").select("item_id", "rank", "doc_id", "score")


def _ranked(docs: DataFrame, queries: list[tuple[str, list[bytes]]], k: int) -> DataFrame | None:
    """(key, rank, doc_id, score) of one block of queries."""
    queries = [(key, terms) for key, terms in queries if terms]
    if not queries:
        return None
    vocabulary = {t: i for i, t in enumerate(sorted({t for _, terms in queries for t in terms}))}
    freqs = landed(_frequencies(docs, vocabulary), "lexical-terms")
    n, total = freqs.agg(F.count(F.lit(1)), F.sum("n")).first()
    if not n:
        return None
    held = dict(_document_frequencies(freqs, len(vocabulary)))
    weights = [weight(n, held.get(i, 0)) for i in range(len(vocabulary))]
    index = landed(_stratified(freqs, n, total), "lexical-index")
    drop_landed(freqs)
    numbered = [(i, [vocabulary[t] for t in terms]) for i, (_, terms) in enumerate(queries)]
    best = _searched(index, numbered, weights, k)
    by_score = Window.partitionBy("query").orderBy(F.col("score").desc(), F.col("doc_id").asc_nulls_last())
    top = best.withColumn("rank", F.row_number().over(by_score)).filter(F.col("rank") <= k)
    keys = docs.sparkSession.createDataFrame([(i, key) for i, (key, _) in enumerate(queries)], "query int, key string")
    return top.join(keys, "query").select("key", "rank", "doc_id", "score")
