"""Token counts by greedy longest match, without building pieces.

Words are runs without ASCII white space.  A word, with one space before it, is cut
greedily: each piece is the longest vocabulary entry at its place.  A trie of
the vocabulary is turned into an automaton: where a node has no way on, its
failure link names the node for what is left over once the pieces that are
certain by then are popped, and their number is stored with the link.  So every byte is read
once, whatever the vocabulary, and only numbers are added up.

Each Python worker keeps a bounded table of word counts; words outside it are read
by the automaton.

Defined results: null or empty text has no words and no tokens; a word that cannot be
cut (a byte the vocabulary lacks) counts as one token; null doc_ids, repeated rows and ties
are counted row by row; an empty table gives no rows; extra columns are ignored.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from panora.llm.common import arrow_map, tokenizer_path

#: words remembered per worker, and the longest of them
CACHE_WORDS, CACHE_BYTES = 600_000, 48


class Automaton:
    """Vocabulary (byte strings) -> greedy piece counts."""

    def __init__(self, vocabulary):
        way: dict[int, int] = {}                # node << 8 | byte -> node
        ends = {0: False}
        for entry in vocabulary:
            node = 0
            for byte in entry:
                node = way.setdefault(node << 8 | byte, len(way) + 1)
            if entry:
                ends[node] = True
        fail, popped = [-1] * (len(way) + 1), [0] * (len(way) + 1)
        below: dict[int, list] = {}
        for key, child in way.items():
            below.setdefault(key >> 8, []).append((key & 255, child))
        layer = [0]
        while layer:                            # parents before children
            deeper = []
            for node in layer:
                for byte, child in below.get(node, ()):
                    if ends.get(child):
                        fail[child], popped[child] = 0, 1
                    elif node:
                        z, n = fail[node], popped[node]
                        while z >= 0 and (z << 8 | byte) not in way:
                            z, n = fail[z], n + popped[z]
                        if z >= 0:
                            fail[child], popped[child] = way[z << 8 | byte], n
                    deeper.append(child)
            layer = deeper
        self.way, self.fail, self.popped = way, fail, popped

    def count(self, word: bytes) -> int:
        """Pieces of one word; 1 if it cannot be cut."""
        way, fail, popped, node, n = self.way, self.fail, self.popped, 0, 0
        for byte in word:
            to = way.get(node << 8 | byte)
            while to is None:
                n += popped[node]
                node = fail[node]
                if node < 0:
                    return 1
                to = way.get(node << 8 | byte)
            node = to
        while node:
            n += popped[node]
            node = fail[node]
            if node < 0:
                return 1
        return n


class _Counts(dict):
    def __init__(self, automaton: Automaton):
        super().__init__()
        self.automaton = automaton

    def __missing__(self, word: bytes) -> int:
        n = self.automaton.count(b" " + word)
        if len(word) <= CACHE_BYTES and len(self) < CACHE_WORDS:
            self[word] = n
        return n


def byte_vocabulary(path: str) -> list[bytes]:
    """Entries of a byte-level vocabulary file as bytes."""
    import json

    with open(path, encoding="utf-8") as f:
        model = json.load(f)["model"]
    # such files show a byte as itself where it is printable, else as the next
    # free character from U+0100 on
    plain = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    odd = [b for b in range(256) if b not in set(plain)]
    byte_of = {chr(b): b for b in plain} | {chr(0x100 + i): b for i, b in enumerate(odd)}
    return [bytes(byte_of[c] for c in s) for s in model["vocab"] if all(c in byte_of for c in s)]


_KEPT: dict[str, _Counts] = {}


def counts(path: str) -> _Counts:
    """The worker's counter of one vocabulary (kept between tasks)."""
    if path not in _KEPT:
        _KEPT.clear()
        _KEPT[path] = _Counts(Automaton(byte_vocabulary(path)))
    return _KEPT[path]


def token_counts(docs: DataFrame, path: str | None = None) -> DataFrame:
    """``doc_id, n_words, n_tokens`` of every whole text."""
    path = path or tokenizer_path("byte_bpe_50k.json")

    def run(batch):
        import pyarrow as pa

        get = counts(path).__getitem__
        words = [(t or "").encode().split() for t in batch.column(1).to_pylist()]
        return pa.RecordBatch.from_arrays(
            [batch.column(0), pa.array([len(w) for w in words], pa.int64()),
             pa.array([sum(map(get, w)) for w in words], pa.int64())], names=["doc_id", "n_words", "n_tokens"])
    return arrow_map(docs.select(F.col("doc_id").cast("long").alias("doc_id"),
                                 F.col("text").cast("string").alias("text")),
                     run, "doc_id long, n_words long, n_tokens long")
