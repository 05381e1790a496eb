"""Exact top-k by distributed histogram selection.

All queries are scored against all rows, block by block.  In every pass each
task counts its scores per query in the bins of an interval that is known to hold the
k-th highest score; the counts are added up over the corpus, and the bin that
holds the k-th score becomes the next interval.  A bin's width is a power of the number
of bins, so intervals nest and no score above a bin is counted again.  Once an interval is
one score wide (or holds few enough scores), a last pass keeps what reaches it, at most k rows per
query and block pair, and ties go to the smaller id.

Components are whole numbers ``floor(scale * x)``, kept as doubles, which hold them
exactly; scores are exact whole numbers.  Nothing is gathered: a pass moves at most one short histogram per query
and block pair.

Defined results: vectors (or ids) that are null or hold null or non-finite components take
no part; shorter vectors count as filled up with zeros; a score beyond
+-(2**63 - 1), the range of a long, counts as that; every row is a
candidate of its own (repeated rows appear repeatedly), but rows with the query's own
id are not; an empty table gives no rows; extra columns are ignored.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from panora.llm.common import drop_landed, landed, ship
from panora.llm.vectors import matrix, same_width, to_blocks, usable

SCALE = 256
BINS = 256
ROWS_PER_BLOCK = 2048
QUERIES_PER_BLOCK = 512
#: an interval that holds at most this many scores more than needed ends the search
SPARE = 32
#: query blocks are sent to every executor up to this size, beyond it they are joined by shuffle
BROADCAST_BYTES = 64 << 20
ROW_BLOCKS_PER_TASK = 16
#: scores beyond this count as this
LARGEST = (1 << 63) - 1


def _whole(scale: float):
    def prepare(m):
        import numpy as np

        with np.errstate(over="ignore"):
            return np.nan_to_num(np.floor(m * scale)).astype("<f8")  # infinite products: the largest double
    return prepare


def scores(q, x):
    """Inner products of matrices of whole numbers: by doubles where these are exact, else
    by int64, else by Python's integers."""
    import numpy as np

    q, x = same_width(q, x)
    with np.errstate(over="ignore", invalid="ignore"):
        # no partial sum of a pair is larger
        most = np.outer(abs(q).max(axis=1, initial=0), abs(x).max(axis=1, initial=0)) * q.shape[1]
        s, far = q @ x.T, most >= 2 ** 53
    if not far.any():
        return s.astype(np.int64)
    s = np.where(far, 0, s).astype(np.int64)
    part = np.ix_(far.any(axis=1), far.any(axis=0))
    a, b = q[far.any(axis=1)], x[far.any(axis=0)]
    if most[part].max() < 2 ** 62:
        s[part] = a.astype(np.int64) @ b.T.astype(np.int64)
    else:
        whole = np.vectorize(int, otypes=[object])
        s[part] = np.clip(whole(a) @ whole(b).T, -LARGEST, LARGEST).astype(np.int64)
    return s


def _pairs(rows: DataFrame, queries: DataFrame) -> DataFrame:
    """Every row block beside every query block: an equi-join on the query
    block's number.  Small query sets are broadcast after a check of their size; others
    are dealt out so that a task meets a bounded number of row blocks."""
    numbers = queries.select("block").distinct()
    size, count = queries.agg(F.sum(F.octet_length("data") + F.octet_length("ids") * 4), F.count("block")).first()
    left = rows.select(F.col("block").alias("row_block"), F.col("n").alias("rn"), F.col("ids").alias("rids"),
                       F.col("data").alias("rdata"))
    listed = [r.block for r in numbers.collect()] if size <= BROADCAST_BYTES else None
    if listed is not None:
        left = left.withColumn("block", F.explode(F.array(*[F.lit(b).cast("long") for b in listed])))
        return left.join(F.broadcast(queries), "block")
    deals = max(1, -(-rows.count() // ROW_BLOCKS_PER_TASK))
    deal = F.pmod(F.xxhash64("row_block"), F.lit(deals))
    left = left.withColumn("deal", deal)
    each = queries.withColumn("deal", F.explode(F.sequence(F.lit(0).cast("long"), F.lit(deals - 1).cast("long"))))
    return each.join(left, "deal")


def _histograms(bins: int):
    """Block pair -> (block, q, low, n): counts in the bins of the query's interval, named
    by their lowest scores, from the top down to the bin in which this pair alone has enough."""
    def run(batches):
        import numpy as np
        import pyarrow as pa

        for b in batches:
            for r in b.to_pylist():
                q, x = matrix(r["data"], r["n"], "<f8"), matrix(r["rdata"], r["rn"], "<f8")
                own, ids = np.frombuffer(r["ids"], "<i8"), np.frombuffer(r["rids"], "<i8")
                lo, width, need = (np.array(r[c], np.int64) for c in ("lo", "width", "need"))
                s = scores(q, x)
                i, j = np.nonzero((s >= lo[:, None]) & (ids != own[:, None]) & (need > 0)[:, None])
                # distances from lo reach 2**64: unsigned
                at = (s[i, j] - lo[i]).view(np.uint64) // width[i].view(np.uint64)
                i, at = i[at < bins], at[at < bins].astype(np.int64)
                n = np.bincount(i * bins + at, minlength=r["n"] * bins).reshape(r["n"], bins)
                above = np.cumsum(n[:, ::-1], axis=1)[:, ::-1] - n
                qi, bi = np.nonzero((n > 0) & (above < need[:, None]))
                yield pa.RecordBatch.from_arrays(
                    [pa.array(np.full(len(qi), r["block"])), pa.array(qi.astype(np.int32)),
                     pa.array(lo[qi] + bi * width[qi]), pa.array(n[qi, bi])], names=["block", "q", "low", "n"])
    return run


def _narrowed(state: DataFrame, counted: DataFrame, bins: int) -> DataFrame:
    """(block, q, lo, width, need) -> the next interval: the bin that holds the
    score sought; ``need`` 0 marks an interval that is final."""
    # at most ``bins`` rows per query
    down = Window.partitionBy("block", "q").orderBy(F.col("low").desc())
    hit = counted.withColumn("upto", F.sum("n").over(
        down.rowsBetween(Window.unboundedPreceding, Window.currentRow))) \
        .join(state.filter("need > 0"), ["block", "q"]) \
        .filter("need <= upto and need > upto - n") \
        .select("block", "q", F.col("low").alias("lo1"), "width",
                "n", (F.col("need") - (F.col("upto") - F.col("n"))).alias("need1"))
    hit = hit.withColumn("need1", F.when((F.col("width") == 1) | (F.col("n") - F.col("need1") <= SPARE), 0)
                         .otherwise(F.col("need1"))).drop("n", "width")
    # without a hit there are fewer than k candidates, and all are taken
    return state.join(hit, ["block", "q"], "left").select(
        "block", "q", F.coalesce("lo1", "lo").alias("lo"),
        F.when(F.coalesce("need1", F.lit(0)) > 0, F.expr(f"width div {bins}"))
        .otherwise(F.col("width")).alias("width"), F.coalesce("need1", F.lit(0)).cast("long").alias("need"))


def _best(k: int):
    """Block pair -> the k best of it that reach the query's bound."""
    def run(batches):
        import numpy as np
        import pyarrow as pa

        for b in batches:
            for r in b.to_pylist():
                q, x = matrix(r["data"], r["n"], "<f8"), matrix(r["rdata"], r["rn"], "<f8")
                own, ids = np.frombuffer(r["ids"], "<i8"), np.frombuffer(r["rids"], "<i8")
                lo = np.array(r["lo"], np.int64)
                s = scores(q, x)
                i, j = np.nonzero((s >= lo[:, None]) & (ids != own[:, None]))
                v = s[i, j]
                order = np.lexsort((ids[j], ~v, i))       # ~v falls as v rises, without overflow
                i, j, v = i[order], j[order], v[order]
                first = np.searchsorted(i, np.arange(r["n"]))
                keep = np.arange(len(i)) - first[i] < k
                i, j, v = i[keep], j[keep], v[keep]
                yield pa.RecordBatch.from_arrays(
                    [pa.array(np.full(len(i), r["block"])), pa.array(i.astype(np.int32)), pa.array(own[i]),
                     pa.array(ids[j]), pa.array(v)], names=["block", "q", "query_id", "vec_id", "score"])
    return run


def _longest(batches):
    import numpy as np
    import pyarrow as pa

    top = 0.0
    for b in batches:
        for n, d in zip(b.column(0).to_pylist(), b.column(1).to_pylist()):
            m = matrix(d, n, "<f8")
            with np.errstate(over="ignore"):
                top = max(top, float((m * m).sum(axis=1).max(initial=0)))
    yield pa.RecordBatch.from_arrays([pa.array([top])], names=["top"])


def search(vectors: DataFrame, is_query: Column, k: int, scale: float = SCALE, id_col: str = "vec_id",
           vec_col: str = "embedding") -> DataFrame:
    """``query_id, rank, vec_id, score`` of the k best of every query
    (``is_query``: a condition on ``id``)."""
    spark = vectors.sparkSession
    ship(spark)
    rows = usable(vectors, id_col, vec_col)
    blocks = to_blocks(rows, ROWS_PER_BLOCK, _whole(scale), "row-blocks")
    queries = to_blocks(rows, QUERIES_PER_BLOCK, _whole(scale), "query-blocks", is_query)
    longest = blocks.select("n", "data").mapInArrow(_longest, "top double").agg(F.max("top")).first()[0]  # squared
    if longest is None or queries.isEmpty():
        return spark.createDataFrame([], "query_id long, rank int, vec_id long, score long")
    # no score is larger than the square of the longest row
    bound = int(longest * 1.000001) + 1 if longest < 2.0 ** 62 else LARGEST
    width = 1
    while width * BINS < 2 * bound + 1:
        width *= BINS
    columns = ["block", "n", "ids", "data", "rn", "rids", "rdata"]
    state = queries.select("block", F.explode(F.sequence(F.lit(0), F.col("n") - 1)).alias("q")).select(
        "block", "q", F.lit(-bound).cast("long").alias("lo"),
        F.lit(width).cast("long").alias("width"), F.lit(k).cast("long").alias("need"))
    while True:
        # per block at most QUERIES_PER_BLOCK entries
        lists = state.groupBy("block").agg(F.array_sort(F.collect_list(F.struct("q", "lo", "width", "need"))).alias("s")) \
            .select("block", "s.lo", "s.width", "s.need")
        ready = landed(queries.join(lists, "block"), "query-bounds")
        if not state.filter("need > 0").take(1):
            break
        counted = _pairs(blocks, ready).select(*columns, "lo", "width", "need") \
            .mapInArrow(_histograms(BINS), "block long, q int, low long, n long") \
            .groupBy("block", "q", "low").agg(F.sum("n").alias("n"))
        state = landed(_narrowed(state, counted, BINS), "bounds")
        drop_landed(ready)
    best = _pairs(blocks, ready).select(*columns, "lo") \
        .mapInArrow(_best(k), "block long, q int, query_id long, vec_id long, score long")
    by = Window.partitionBy("block", "q").orderBy(F.col("score").desc(), "vec_id")
    return best.withColumn("rank", F.row_number().over(by)).filter(F.col("rank") <= k) \
        .select("query_id", "rank", "vec_id", "score")
