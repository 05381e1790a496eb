"""Token-id files: frequency-ranked ids in byte-aligned variable-length coding
with separate control bytes, decoded by numpy table lookup.

``write_tokens`` encodes whole texts and writes, in ascending ``doc_id`` order,
a dataset of two Parquet tables under one folder:

* ``ranks``    (rank, token): ids by falling frequency over the whole corpus;
* ``segments`` (part, segment, n_ids, payload): ``payload`` is the file format
  below; (part, segment) ascending is the order of documents.

Payload, all little-endian: ``PFVB``, u4 version 1, u8 documents, u8 ids,
null flags (u1 per document), document ids (i8), ids per document (u8), control
bytes, data bytes.  A control byte holds four 2-bit fields, lowest first:
bytes of a rank less one.  Data bytes are the ranks' low bytes.

Spark's committers write the dataset, so a lost executor only repeats its
tasks, and any Hadoop file system can hold it.

Defined results: null text is an empty text (only the end id); a null
``doc_id`` comes first; rows with one ``doc_id`` stand in order of
(ids' crc32, number of ids); repeated rows are written once per row; an empty table gives an
empty dataset; extra columns are ignored.
"""

from __future__ import annotations

import struct
import zlib

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from panora.llm.common import SUB_ROWS, arrow_map, drop_landed, landed, ship, tokenizer_path
from panora.llm.tokens import encoder
from panora.session import scratch_path

END_ID = 1
#: a segment is closed once it holds this many ids (one document is never cut)
SEGMENT_IDS = 1 << 18
#: bytes of ids per range partition
PART_BYTES = 32 << 20
#: most rows of segment starts that are sent to every executor
BROADCAST_SEGMENTS = 200_000
MAGIC, VERSION = b"PFVB", 1


# the code ----------------------------------------------------------------------
def encode_ranks(ranks) -> tuple[bytes, bytes]:
    """Ranks (uint32) -> control bytes, data bytes."""
    import numpy as np

    code = (ranks > 0xFF).astype(np.uint8) + (ranks > 0xFFFF) + (ranks > 0xFFFFFF)
    low = ranks.astype("<u4").view(np.uint8).reshape(-1, 4)
    data = low[np.arange(4) <= code[:, None]]
    fields = np.zeros(-(-len(code) // 4) * 4, np.uint8)
    fields[:len(code)] = code
    control = (fields.reshape(-1, 4) << np.array([0, 2, 4, 6], np.uint8)).sum(axis=1).astype(np.uint8)
    return control.tobytes(), data.tobytes()


def length_table():
    """Control byte -> bytes of its four ranks."""
    import numpy as np

    return ((np.arange(256)[:, None] >> np.array([0, 2, 4, 6])) & 3).astype(np.uint8) + 1


def decode_ranks(control: bytes, data: bytes, n: int):
    """The inverse: lengths by table lookup, then one gather per byte place."""
    import numpy as np

    lengths = length_table()[np.frombuffer(control, np.uint8)].reshape(-1)[:n].astype(np.int64)
    starts = np.cumsum(lengths) - lengths
    raw = np.frombuffer(data, np.uint8)
    out = np.zeros(n, np.uint32)
    for k in range(int(lengths.max(initial=0))):
        has = np.flatnonzero(lengths > k)
        out[has] |= raw[starts[has] + k].astype(np.uint32) << np.uint32(8 * k)
    return out


def to_payload(doc_ids: list, counts: list[int], ranks) -> bytes:
    import numpy as np

    control, data = encode_ranks(ranks)
    return b"".join([MAGIC, struct.pack("<IQQ", VERSION, len(doc_ids), len(ranks)),
                     bytes(d is None for d in doc_ids), np.array([d or 0 for d in doc_ids], "<i8").tobytes(),
                     np.array(counts, "<u8").tobytes(), control, data])


def from_payload(payload: bytes):
    """-> document ids, ids per document, ranks."""
    import numpy as np

    version, docs, n = struct.unpack_from("<IQQ", payload, 4)
    if payload[:4] != MAGIC or version != VERSION:
        raise ValueError("not a token file of this version")
    at = 24
    null = np.frombuffer(payload, np.uint8, docs, at)
    ids = np.frombuffer(payload, "<i8", docs, at + docs)
    counts = np.frombuffer(payload, "<u8", docs, at + 9 * docs)
    at += 17 * docs
    split = at + -(-n // 4)
    ranks = decode_ranks(payload[at:split], payload[split:], n)
    return [None if z else int(i) for z, i in zip(null, ids)], counts.tolist(), ranks


# writing and reading -------------------------------------------------------------
def _tokenised(path: str, end_id: int, added_tokens: bool):
    import pyarrow as pa

    def run(batch):
        enc = encoder(path, added_tokens)
        end = end_id.to_bytes(2 if enc.code == "H" else 4, "little")
        ids = [x + end for x in enc.encode([t or "" for t in batch.column(1).to_pylist()])]
        return pa.RecordBatch.from_arrays(
            [batch.column(0), pa.array([zlib.crc32(x) for x in ids], pa.int64()),
             pa.array([len(x) for x in ids], pa.int64()), pa.array(ids, pa.binary())],
            names=["doc_id", "tie", "n_bytes", "ids"])
    return run


def _counted(dtype: str, size: int):
    def run(batches):
        import numpy as np
        import pyarrow as pa

        total = np.zeros(size, np.int64)
        for b in batches:
            for i in range(0, b.num_rows, SUB_ROWS):
                ids = b"".join(b.column(0).slice(i, SUB_ROWS).to_pylist())
                total += np.bincount(np.frombuffer(ids, dtype), minlength=size)
        at = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(at), pa.array(total[at])], names=["token", "n"])
    return run


def _segments(rank_of, dtype: str):
    """Sorted documents of a range partition -> segments."""
    def run(batches):
        import numpy as np
        import pyarrow as pa
        from pyspark import TaskContext

        part, number = TaskContext.get().partitionId(), 0
        docs: list = []
        ids: list[bytes] = []
        held = 0

        def close():
            ranks = rank_of[np.frombuffer(b"".join(ids), dtype)]
            w = np.dtype(dtype).itemsize
            payload = to_payload(docs, [len(x) // w for x in ids], ranks)
            return pa.RecordBatch.from_arrays(
                [pa.array([part], pa.int64()), pa.array([number], pa.int64()),
                 pa.array([len(ranks)], pa.int64()), pa.array([payload], pa.binary())],
                names=["part", "segment", "n_ids", "payload"])

        for b in batches:
            for d, x in zip(b.column(0).to_pylist(), b.column(1).to_pylist()):
                docs.append(d)
                ids.append(x)
                held += len(x)
                if held >= SEGMENT_IDS * np.dtype(dtype).itemsize:
                    yield close()
                    docs, ids, held, number = [], [], 0, number + 1
        if docs:
            yield close()
    return run


def write_tokens(docs: DataFrame, out: str, path: str | None = None, end_id: int = END_ID,
                 added_tokens: bool = False) -> str:
    """Encode every whole text and write the dataset under ``out`` (``added_tokens``:
    strings of the file's added tokens are their ids)."""
    import numpy as np

    path = path or tokenizer_path("word_bpe_49k.json")
    spark, enc = docs.sparkSession, encoder(path, added_tokens)
    size, dtype = max(enc.size, end_id + 1), enc.dtype
    docs = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    held = landed(arrow_map(docs, _tokenised(path, end_id, added_tokens), "doc_id long, tie long, n_bytes long, ids binary"),
                  "tokens")
    counts = held.select("ids").mapInArrow(_counted(dtype, size), "token long, n long") \
        .groupBy("token").agg(F.sum("n").alias("n")).collect()  # at most one row per vocabulary entry
    tokens = [r.token for r in sorted(counts, key=lambda r: (-r.n, r.token))]
    spark.createDataFrame([(i, t) for i, t in enumerate(tokens)], "rank long, token long") \
        .coalesce(1).write.parquet(f"{out}/ranks")
    rank_of = np.zeros(size, np.uint32)
    rank_of[tokens] = np.arange(len(tokens))
    total = held.agg(F.sum("n_bytes")).first()[0] or 0
    parts = max(1, -(-total // PART_BYTES))
    # rows alike in everything are told apart by their place in the landed table, so that one document on
    # a third of the rows is written by many tasks
    along = [F.col("doc_id").asc_nulls_first(), F.col("tie"), F.col("n_bytes"), F.col("row")]
    (held.withColumn("row", F.monotonically_increasing_id()).repartitionByRange(parts, *along)
     .sortWithinPartitions(*along)
     .select("doc_id", "ids").mapInArrow(_segments(rank_of, dtype),
                                         "part long, segment long, n_ids long, payload binary")
     .write.option("compression", "none").parquet(f"{out}/segments"))
    drop_landed(held)
    return out


def read_tokens(spark: SparkSession, out: str) -> DataFrame:
    """``doc_id, start, n_tokens, ids`` of every document of a dataset (ids as
    little-endian unsigned 32 bit, ``start`` counted over the whole dataset)."""
    ship(spark)
    ranks = spark.read.parquet(f"{out}/ranks").collect()  # vocabulary-bounded
    token_of = [r.token for r in sorted(ranks, key=lambda r: r.rank)]

    def run(batches):
        import numpy as np
        import pyarrow as pa

        table = np.array(token_of, "<u4")
        for b in batches:
            for part, seg, payload in zip(*(b.column(i).to_pylist() for i in range(3))):
                docs, counts, ranks = from_payload(payload)
                ids, ends = table[ranks].tobytes(), np.cumsum(np.array(counts, np.int64))
                starts = ends - counts
                yield pa.RecordBatch.from_arrays(
                    [pa.array([part] * len(docs), pa.int64()), pa.array([seg] * len(docs), pa.int64()),
                     pa.array(docs, pa.int64()), pa.array(starts), pa.array(counts, pa.int64()),
                     pa.array([ids[4 * a:4 * z] for a, z in zip(starts, ends)], pa.binary())],
                    names=["part", "segment", "doc_id", "inside", "n_tokens", "ids"])

    segments = spark.read.schema("part long, segment long, n_ids long, payload binary") \
        .parquet(f"{out}/segments")
    docs = segments.select("part", "segment", "payload").mapInArrow(
        run, "part long, segment long, doc_id long, inside long, n_tokens long, ids binary")
    meta = segments.select("part", "segment", "n_ids")
    before = Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)  # one row per range partition
    parts = meta.groupBy("part").agg(F.sum("n_ids").alias("n")) \
        .select("part", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("p0"))
    inner = Window.partitionBy("part").orderBy("segment").rowsBetween(Window.unboundedPreceding, -1)
    starts = meta.withColumn("s0", F.coalesce(F.sum("n_ids").over(inner), F.lit(0))).join(parts, "part") \
        .select("part", "segment", (F.col("s0") + F.col("p0")).alias("base"))
    starts = landed(starts, "starts")
    if starts.count() <= BROADCAST_SEGMENTS:
        starts = F.broadcast(starts)  # three numbers a row; beyond that size, a shuffled join
    return docs.join(starts, ["part", "segment"]).select(
        "doc_id", (F.col("base") + F.col("inside")).alias("start"), "n_tokens", "ids")


def token_files(docs: DataFrame, **options) -> DataFrame:
    """Write to a fresh folder of the shared scratch space and read back."""
    spark = docs.sparkSession
    return read_tokens(spark, write_tokens(docs, scratch_path(spark, "token-files"), **options))
