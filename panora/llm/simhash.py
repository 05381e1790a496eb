"""SimHash near-duplicates by a binary-trie self-join.

``fingerprints`` gives every document a 64-bit SimHash of its word shingles.
``components`` links different fingerprints at up to ``max_bits`` differing
bits and returns connected components.

The self-join walks a binary trie against itself: node pairs go down
together, each pair carries its number of differing bits, and a pair over the
budget is pruned with everything below it.  To deal the work out, the trie is
built in ``max_bits + 1`` bit orders, each with another block of bits on top;
two fingerprints within the budget agree in at least one block (pigeonhole), so
in that order they lie under one node below the top block, and the walk starts
at such nodes only.  A node that holds more than ``max_node`` fingerprints is
opened again the same way over its remaining bits, so no task holds an
unbounded group; once few bits remain, a node is small by itself.  Inside a node, links
become a spanning forest (at most one row per fingerprint): no pair
list is ever written, and no link between components is lost.

Defined results: null or empty text (no words) has fingerprint zero, linked
like any other; a null ``doc_id`` takes part, but never names a component (which is
null if all its members are); repeated rows share their fingerprint; an empty
table gives no rows; extra columns are ignored by ``components`` and kept by ``dedup``.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from panora.llm.common import arrow_map, drop_landed, landed, ship

SHINGLE_WORDS = 3
MAX_BITS = 2
SEED = 42
#: most fingerprints under one start node; larger ones are opened further
MAX_NODE = 8192
#: hashes whose bits are counted at once
CHUNK = 1 << 16


def _fingerprint(text: str | None, words_per_shingle: int) -> int:
    from itertools import repeat

    import numpy as np
    import xxhash

    words = (text or "").encode().lower().split()  # bytes: ASCII case and white space only
    if not words:
        return 0
    k = min(words_per_shingle, len(words))
    hashes = np.fromiter(map(xxhash.xxh64_intdigest,
                             map(b" ".join, zip(*(words[i:] for i in range(k)))), repeat(SEED)),
                         np.uint64, len(words) - k + 1)
    ones = np.zeros(64, np.int64)
    for i in range(0, len(hashes), CHUNK):
        part = hashes[i:i + CHUNK].astype("<u8").view(np.uint8)
        ones += np.unpackbits(part, bitorder="little").reshape(-1, 64).sum(axis=0, dtype=np.int64)
    return int(np.packbits(2 * ones > len(hashes), bitorder="little").view("<i8")[0])


def fingerprints(docs: DataFrame, words_per_shingle: int = SHINGLE_WORDS) -> DataFrame:
    """``doc_id, text_hash, fp`` of every row (``text_hash`` tells rows with
    one doc_id and different texts apart)."""
    def run(batch):
        import pyarrow as pa

        fp = [_fingerprint(t, words_per_shingle) for t in batch.column(1).to_pylist()]
        return pa.RecordBatch.from_arrays([batch.column(0), batch.column(2), pa.array(fp, pa.int64())],
                                          names=["doc_id", "text_hash", "fp"])
    text = F.col("text").cast("string")
    return arrow_map(docs.select(F.col("doc_id").cast("long").alias("doc_id"), text.alias("text"),
                                 F.xxhash64(text).alias("text_hash")),
                     run, "doc_id long, text_hash long, fp long")


# the trie walk ---------------------------------------------------------------------
def walk(values, top: int, max_bits: int):
    """Index pairs of sorted distinct uint64 ``values`` that agree in their
    ``top`` highest bits and differ in 1 to ``max_bits`` others.

    A trie node is a range of the sorted values; all pairs of one depth are
    expanded together."""
    import numpy as np

    head = values >> np.uint64(64 - top) if top else np.zeros(len(values), np.uint64)
    cut = np.flatnonzero(np.diff(head)) + 1
    lo, hi = np.r_[0, cut], np.r_[cut, len(values)]
    many = hi - lo > 1
    own = np.stack([lo[many], hi[many]])           # a node against itself
    pair = np.zeros((5, 0), np.int64)              # two nodes: a, b, differing bits
    left, right = [], []
    for depth in range(top, 64):
        if not own.size and not pair.size:
            break
        ones = np.r_[0, np.cumsum((values >> np.uint64(63 - depth)) & np.uint64(1)).astype(np.int64)]

        def middle(a, b):
            return b - (ones[b] - ones[a])

        lo, hi = own
        mid = middle(lo, hi)
        split = (lo < mid) & (mid < hi)
        new = [np.stack([lo, mid, mid, hi, np.ones_like(lo)])[:, split]]
        halves = np.concatenate([np.stack([lo, mid]), np.stack([mid, hi])], axis=1)
        own = halves[:, halves[1] - halves[0] > 1]
        a0, a1, b0, b1, d = pair
        am, bm = middle(a0, a1), middle(b0, b1)
        new += [np.stack([a0, am, b0, bm, d]), np.stack([am, a1, bm, b1, d]),
                np.stack([a0, am, bm, b1, d + 1]), np.stack([am, a1, b0, bm, d + 1])]
        pair = np.concatenate(new, axis=1)
        a0, a1, b0, b1, d = pair
        pair = pair[:, (a0 < a1) & (b0 < b1) & (d <= max_bits)]
        single = (pair[1] - pair[0] == 1) & (pair[3] - pair[2] == 1)
        if single.any():                           # two leaves: compare the rest at once
            i, j = pair[0, single], pair[2, single]
            near = np.bitwise_count(values[i] ^ values[j]) <= max_bits
            left.append(i[near])
            right.append(j[near])
            pair = pair[:, ~single]
    if not left:
        return np.zeros(0, np.int64), np.zeros(0, np.int64)
    return np.concatenate(left), np.concatenate(right)


def forest(n: int, i, j):
    """Smallest index that links reach, for each of n items."""
    import numpy as np

    label = np.arange(n)
    while True:
        low = np.minimum(label[i], label[j])
        new = label.copy()
        for at in (i, j, label[i], label[j]):
            np.minimum.at(new, at, low)
        new = new[new]
        if (new == label).all():
            return label
        label = new


def _linked(max_bits: int):
    """Rows (path, top, v, fp) sorted by path and start node, all rows of a node in
    one task -> (u, v) of a spanning forest of each node's links."""
    def edges(path_rows):
        import numpy as np

        top, v, fp = path_rows
        order = np.argsort(v, kind="stable")
        v, fp = v[order], fp[order]
        i, j = walk(v, top, max_bits)
        label = forest(len(v), i, j)
        at = np.flatnonzero(label != np.arange(len(v)))
        return fp[at], fp[label[at]]

    def run(batches):
        import numpy as np
        import pyarrow as pa

        held: list = []          # rows of the path at hand that are not finished
        path = None

        def finish(upto=None):
            """Walk the held rows, but keep those of the last start node back."""
            v = np.concatenate([x[1] for x in held]).view(np.uint64)
            fp = np.concatenate([x[2] for x in held])
            top, keep = held[0][0], len(v)
            if upto is not None:
                head = v >> np.uint64(64 - top) if top else v & np.uint64(0)
                keep = int(np.searchsorted(head, head[-1]))
            u, w = edges((top, v[:keep], fp[:keep])) if keep else (fp[:0], fp[:0])
            held[:] = [(top, v[keep:].view(np.int64), fp[keep:])] if keep < len(v) else []
            return pa.RecordBatch.from_arrays([pa.array(u), pa.array(w)], names=["u", "v"])

        for b in batches:
            names = np.asarray(b.column(0).to_pylist(), dtype=object)
            tops = b.column(1).to_numpy(zero_copy_only=False)
            v, fp = (b.column(k).to_numpy(zero_copy_only=False) for k in (2, 3))
            cut = [0, *(np.flatnonzero(names[1:] != names[:-1]) + 1).tolist(), len(names)]
            for s, e in zip(cut, cut[1:]):
                if s == e:
                    continue
                if held and names[s] != path:
                    yield finish()
                path = names[s]
                held.append((int(tops[s]), v[s:e], fp[s:e]))
                if sum(len(x[1]) for x in held) > 8 * MAX_NODE:
                    yield finish(upto=True)
        if held:
            yield finish()
    return run


def _opened(rows: DataFrame, used: int, blocks: int) -> tuple[DataFrame, int]:
    """Rows (path, v, fp) whose top ``used`` bits are fixed -> for every block
    of the remaining bits, the row with that block rotated to their top; and
    how many bits are fixed then at least."""
    left = 64 - used
    width = [left // blocks + (b < left % blocks) for b in range(blocks)]
    out, shift = [], 0
    for b in range(blocks):
        v = F.col("v")
        if shift:
            kept = F.bitwise_not(F.shiftrightunsigned(F.lit(-1).cast("long"), used)) if used \
                else F.lit(0).cast("long")
            low = F.lit(-1).cast("long") if not used else F.shiftrightunsigned(F.lit(-1).cast("long"), used)
            turned = F.shiftleft(v, shift).bitwiseAND(low).bitwiseOR(
                F.shiftrightunsigned(v.bitwiseAND(low), left - shift))
            v = v.bitwiseAND(kept).bitwiseOR(turned)
        out.append(F.struct(F.concat(F.col("path"), F.lit(str(b))).alias("path"),
                            F.lit(used + width[b]).alias("top"), v.alias("v")))
        shift += width[b]
    return rows.select("fp", F.explode(F.array(*out)).alias("o")).select("o.path", "o.top", "o.v", "fp"), \
        used + min(width)


def links(nodes: DataFrame, max_bits: int = MAX_BITS, max_node: int = MAX_NODE) -> DataFrame:
    """Spanning links ``u, v`` between different fingerprints (column ``fp``,
    distinct) at up to ``max_bits`` differing bits."""
    ship(nodes.sparkSession)
    rows = nodes.select(F.lit("").alias("path"), F.col("fp").alias("v"), "fp")
    used, done = 0, []
    while True:
        rows, used = _opened(rows, used, max_bits + 1)
        rows = rows.withColumn("node", F.expr("shiftrightunsigned(v, 64 - top)"))
        # 2**(64 - used) fingerprints at most lie under one node
        if 1 << (64 - used) <= max_node:
            done.append(rows)
            break
        crowded = rows.groupBy("path", "node").count().filter(F.col("count") > max_node).select("path", "node")
        crowded = landed(crowded, "nodes")
        if crowded.isEmpty():
            done.append(rows)
            break
        done.append(rows.join(crowded, ["path", "node"], "left_anti"))
        rows = landed(rows.join(crowded, ["path", "node"], "left_semi")
                      .select("path", "v", "fp"), "crowded")
    rows = reduce(DataFrame.unionByName, (d.select("path", "node", "top", "v", "fp") for d in done))
    return (rows.repartition("path", "node").sortWithinPartitions("path", "node")
            .select("path", "top", "v", "fp").mapInArrow(_linked(max_bits), "u long, v long"))


def connected(edges: DataFrame) -> DataFrame:
    """``node, label`` for every node of undirected ``edges`` (u, v): the smallest
    node reached.  Large-star / small-star rounds, each landed; a node's edges are
    pre-aggregated to their minimum, never gathered."""
    edges = landed(edges.filter("u != v").select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v"))
                   .distinct(), "edges")
    before = None
    while True:
        state = edges.agg(F.count(F.lit(1)), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first()
        if state == before or state[0] == 0:
            return edges.select(F.col("u").alias("node"), F.col("v").alias("label"))
        before = state
        both = edges.unionByName(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
        # minima are tables of their own: a join with one is broadcast by its size or, where a node has very many
        # edges, split (beside an unfinished aggregate neither is possible)
        least = landed(both.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m")), "least")
        large = landed(both.filter("v > u").join(least, "u").select(F.col("v").alias("u"), F.col("m").alias("v")), "edges")
        low = landed(large.groupBy("u").agg(F.min("v").alias("m")), "least")
        hooked = large.join(low, "u")
        small = hooked.filter("v != m").select(F.greatest("v", "m").alias("u"), F.least("v", "m").alias("v")) \
            .unionByName(low.select("u", F.col("m").alias("v")))
        older, edges = edges, landed(small.filter("u != v").distinct(), "edges")
        for table in (older, least, large, low):
            drop_landed(table)


def components(docs: DataFrame, words_per_shingle: int = SHINGLE_WORDS, max_bits: int = MAX_BITS,
               max_node: int = MAX_NODE) -> DataFrame:
    """``doc_id, text_hash, fp, component_id, keep_id, keep_hash`` of every row:
    the last two name the row that stands for the component (smallest doc_id,
    nulls last, then smallest text hash)."""
    prints = landed(fingerprints(docs, words_per_shingle), "prints")
    first = F.struct(F.col("doc_id").isNull().alias("none"), "doc_id", "text_hash")
    nodes = landed(prints.groupBy("fp").agg(F.min(first).alias("first")), "nodes")
    label = connected(links(nodes.select("fp"), max_bits, max_node))
    named = nodes.join(label, nodes.fp == label.node, "left") \
        .select("fp", "first", F.coalesce("label", "fp").alias("label"))
    lead = named.groupBy("label").agg(F.min("first").alias("lead"))
    ids = named.join(lead, "label").select(F.col("fp").alias("fp0"), "lead")
    return prints.join(ids, prints.fp == ids.fp0).select(
        "doc_id", "text_hash", "fp", F.col("lead.doc_id").alias("component_id"),
        F.col("lead.doc_id").alias("keep_id"), F.col("lead.text_hash").alias("keep_hash"))


def dedup(docs: DataFrame, **options) -> DataFrame:
    """``docs`` with one row of each component (all its columns as they were)."""
    keep = components(docs, **options).select(F.col("keep_id").alias("__keep_id"),
                                              F.col("keep_hash").alias("__keep_hash")).distinct()
    rows = docs.withColumn("__text_hash", F.xxhash64(F.col("text").cast("string")))
    same = rows["doc_id"].cast("long").eqNullSafe(keep["__keep_id"]) & (rows["__text_hash"] == keep["__keep_hash"])
    rows = rows.join(keep, same, "left_semi")
    # of rows alike in doc_id and text the one whose other columns come first
    rest = [c for c in docs.columns if c not in ("doc_id", "text")]
    chosen = rows.groupBy("doc_id", "__text_hash").agg(F.min(F.struct(*[F.col(f"`{c}`") for c in rest], "text")).alias("r"))
    return chosen.select(*[F.col("doc_id") if c == "doc_id" else F.col(f"r.`{c}`").alias(c) for c in docs.columns])
