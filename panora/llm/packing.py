"""Packing documents into training sequences: first-fit decreasing over a
tournament tree of bin capacities, run independently in randomised groups.

Each document's ids (plus an end id) are cut into pieces of at most
``capacity``; a piece goes to a random group of bounded size, so no group
grows with the corpus, with one document, or with repeated rows.  Inside a
group, first-fit decreasing places the pieces; gaps that remain are then
filled from the emptiest sequences by cutting their pieces, so that all but
one sequence of a group are full.

Defined results: null text is an empty text (its only id is the end id); a
null ``doc_id`` stays null; repeated rows are packed once per row; ties in
size go by (doc_id, start, ids); an empty table gives no pieces; extra columns are ignored.
"""

from __future__ import annotations

import zlib

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from panora.llm.common import arrow_map, tokenizer_path
from panora.llm.tokens import encoder

CAPACITY = 2048
END_ID = 1
#: text bytes per group: a group holds at most this many ids (a byte-level
#: piece has at least one byte) plus one end id per document
GROUP_BYTES = 4 << 20
#: bytes counted for a document besides its text, so that empty ones are bounded too
DOC_BYTES = 64

PIECES = "doc_id long, start long, length long, doc_tokens long, grp long, ids binary"
PACKED = "doc_id long, start long, length long, doc_tokens long, sequence_id long, offset long, ids binary"


class Bins:
    """Bins of equal capacity; a tournament tree of the largest free room
    below each node finds the first bin that fits in O(log bins)."""

    def __init__(self, bins: int, capacity: int):
        self.leaves = 1 << max(0, bins - 1).bit_length()
        self.room = [capacity] * (2 * self.leaves)

    def place(self, size: int) -> int:
        room, node = self.room, 1
        while node < self.leaves:
            node *= 2
            if room[node] < size:
                node += 1
        room[node] -= size
        at = node - self.leaves
        while node > 1:
            node //= 2
            best = max(room[2 * node], room[2 * node + 1])
            if room[node] == best:
                break
            room[node] = best
        return at


def first_fit_decreasing(sizes: list[int], capacity: int) -> list[list[int]]:
    """Bins as lists of item numbers; ``sizes`` must be in decreasing order."""
    tree, bins = Bins(len(sizes), capacity), []
    for i, size in enumerate(sizes):
        b = tree.place(size)
        if b == len(bins):
            bins.append([])
        bins[b].append(i)
    return bins


def top_up(bins: list[list[tuple]], capacity: int) -> list[list[tuple]]:
    """Fill gaps from the emptiest bins; items are (item, from, to) ranges.
    At most one bin stays partly filled."""
    fill = [sum(b - a for _, a, b in x) for x in bins]
    order = sorted(range(len(bins)), key=lambda i: (-fill[i], i))
    i, j = 0, len(order) - 1
    while i < j:
        to, donor = order[i], order[j]
        gap = capacity - fill[to]
        if gap == 0:
            i += 1
            continue
        item, a, b = bins[donor].pop()
        take = min(gap, b - a)
        bins[to].append((item, a, a + take))
        if a + take < b:
            bins[donor].append((item, a + take, b))
        fill[to] += take
        fill[donor] -= take
        if fill[donor] == 0:
            j -= 1
    return [x for x in bins if x]


def _cut(path: str, groups: int, capacity: int, end_id: int, seed: int, added_tokens: bool):
    """Batch of (doc_id, text) -> pieces.  The group depends on the piece's
    content, the task and how often the task has met that content, so a
    recomputed task deals its pieces out alike and copies spread."""
    import pyarrow as pa

    seen: dict[int, int] = {}

    def cut(batch):
        from pyspark import TaskContext

        enc, task = encoder(path, added_tokens), TaskContext.get().partitionId()
        w = 2 if enc.code == "H" else 4
        end = end_id.to_bytes(w, "little")
        texts = [t or "" for t in batch.column(1).to_pylist()]
        rows = []
        for doc, ids in zip(batch.column(0).to_pylist(), enc.encode(texts)):
            ids += end
            n = len(ids) // w
            for a in range(0, n, capacity):
                part = ids[a * w:(a + capacity) * w]
                key = zlib.crc32(f"{doc}:{a}:{n}".encode(), zlib.crc32(part))
                nth = seen[key] = seen.get(key, -1) + 1
                deal = zlib.crc32(f"{seed}:{task}:{nth}:{key}".encode())
                # two crc32 give 64 bits, so many groups are dealt evenly
                deal = deal << 32 | zlib.crc32(b"%d" % key, deal ^ 0x9E3779B9)
                rows.append((doc, a, len(part) // w, n, deal % groups, part))
        cols = list(zip(*rows)) or [()] * 6
        return pa.RecordBatch.from_arrays(
            [pa.array(c, t) for c, t in zip(cols, [pa.int64()] * 5 + [pa.binary()])],
            names=["doc_id", "start", "length", "doc_tokens", "grp", "ids"])
    return cut


def _packed(table, capacity: int, width: int):
    """One group's pieces -> their places."""
    import numpy as np
    import pyarrow as pa

    cols = [table.column(c).to_pylist() for c in ("doc_id", "start", "length", "doc_tokens", "grp", "ids")]
    items = sorted(zip(*cols), key=lambda r: (-r[2], r[0] is not None, r[0] or 0, r[1], r[5]))
    full = sum(r[2] == capacity for r in items)
    bins = [[(i, 0, capacity)] for i in range(full)]
    loose = first_fit_decreasing([r[2] for r in items[full:]], capacity)
    bins += top_up([[(full + i, 0, items[full + i][2]) for i in b] for b in loose], capacity)
    out = []
    for s, x in enumerate(bins):
        offset = 0
        for i, a, b in x:
            doc, start, _, tokens, grp, ids = items[i]
            wide = np.frombuffer(ids, f"<u{width}")[a:b].astype("<u4").tobytes()
            out.append((doc, start + a, b - a, tokens, grp << 32 | s, offset, wide))
            offset += b - a
    cols = list(zip(*out)) or [()] * 7
    return pa.Table.from_arrays(
        [pa.array(c, t) for c, t in zip(cols, [pa.int64()] * 6 + [pa.binary()])],
        names=["doc_id", "start", "length", "doc_tokens", "sequence_id", "offset", "ids"])


def pack(docs: DataFrame, path: str | None = None, capacity: int = CAPACITY, end_id: int = END_ID,
         group_bytes: int = GROUP_BYTES, seed: int = 0, added_tokens: bool = False) -> DataFrame:
    """Pieces of all documents with their place: ``doc_id, start, length,
    doc_tokens, sequence_id, offset, ids`` (little-endian unsigned 32 bit).
    ``added_tokens``: strings of the file's added tokens are their ids."""
    path = path or tokenizer_path("byte_bpe_50k.json")
    docs = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    total = docs.agg(F.sum(F.coalesce(F.octet_length("text"), F.lit(0)) + F.lit(DOC_BYTES))).first()[0] or 0
    groups = max(1, -(-total // group_bytes))
    width = 2 if encoder(path, added_tokens).code == "H" else 4
    pieces = arrow_map(docs, _cut(path, groups, capacity, end_id, seed, added_tokens), PIECES)
    return pieces.groupBy("grp").applyInArrow(lambda t: _packed(t, capacity, width), PACKED)
