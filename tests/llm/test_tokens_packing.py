"""Op 3, 4 and 10 against the tokenizers library and brute force."""

import random
import zlib
from collections import Counter, defaultdict

import numpy as np
import pytest
from tokenizers import Tokenizer

from panora.llm import packing, token_files
from panora.llm.tokens import Encoder
from panora.llm.wordpiece import Automaton, byte_vocabulary, token_counts
from tests.llm.helpers import BYTES, ODD_TEXTS, WORDS, no_docs, odd_docs, prose


def library(path):
    t = Tokenizer.from_file(path)
    t.encode_special_tokens = True
    return lambda s: t.encode(s or "", add_special_tokens=False).ids


@pytest.mark.parametrize("path", [BYTES, WORDS])
@pytest.mark.parametrize("room", [0, 50, 10**6])
def test_cached_encoding_equals_the_library(path, room):
    enc, want = Encoder(path, cache_entries=room), library(path)
    rng = random.Random(1)
    odd = "ab é\nÇ'ß 1\t., \xa0\x1fʼnśİ日😀  "
    texts = [t or "" for t in ODD_TEXTS] + [prose(rng, 60) for _ in range(10)] \
        + ["".join(rng.choices(odd, k=rng.randint(1, 40))) for _ in range(600)]
    for _ in range(2):
        for t, ids in zip(texts, enc.encode(texts)):
            assert np.frombuffer(ids, enc.dtype).tolist() == want(t), repr(t)
    assert len(enc.cache) <= room


@pytest.mark.parametrize("path", [BYTES, WORDS])
def test_closing_marks_and_line_feeds_make_no_new_chunks(path):
    enc, want = Encoder(path), library(path)
    words = [a + b for a in ("lor", "ip", "thé", "Dol", "wh") for b in ("em", "sum", "or", "ität")]
    text = " ".join(f"{w} {w}. {w}, {w}!! {w}\n{w};" for w in words)
    assert np.frombuffer(enc.encode([text])[0], enc.dtype).tolist() == want(text)
    assert len(enc.cache) <= 2 * len(words) + 10   # words after a space, words after a line feed, marks


@pytest.mark.parametrize("path", [BYTES, WORDS])
@pytest.mark.parametrize("text", [
    "a\0. b", "\0a. b\nc", "a.\n\nb. c", "a.\x85\nb", "x', y's. z).'' w", "a_. 1. ², é! \u1e9e. b", "</w>. </, w> Ġa. b",
    "word. " * 9000, "\nA. b", "İx. Ⱥb, ǅ! <|ENDOFTEXT|>. b", "日本. 日,  x", ". , ! ", "a。 b. 　\nc"])
def test_marks_and_odd_characters_equal_the_library(path, text):
    for room in (0, 10**6):
        enc = Encoder(path, cache_entries=room)
        assert [np.frombuffer(x, enc.dtype).tolist() for x in enc.encode([text, text])] == [library(path)(text)] * 2


# ---- packing ------------------------------------------------------------------------
def test_tournament_tree_is_first_fit():
    rng = random.Random(2)
    for _ in range(60):
        cap = rng.randint(5, 40)
        sizes = sorted((rng.randint(1, cap) for _ in range(rng.randint(1, 60))), reverse=True)
        bins, room = [], []
        for i, s in enumerate(sizes):       # first fit, plainly
            b = next((b for b, r in enumerate(room) if r >= s), None)
            if b is None:
                bins.append([])
                room.append(cap)
                b = len(bins) - 1
            bins[b].append(i)
            room[b] -= s
        assert packing.first_fit_decreasing(sizes, cap) == bins
        topped = packing.top_up([[(i, 0, sizes[i]) for i in b] for b in bins], cap)
        fill = [sum(b - a for _, a, b in x) for x in topped]
        assert sum(f < cap for f in fill) <= 1 and max(fill) <= cap and sum(fill) == sum(sizes)


@pytest.mark.parametrize("group_bytes", [2000, 4 << 20])
def test_every_id_lies_in_exactly_one_piece(spark, group_bytes):
    docs = odd_docs(spark)
    rows = packing.pack(docs, BYTES, capacity=64, group_bytes=group_bytes).collect()
    want = Counter()
    ids_of = library(BYTES)
    texts = defaultdict(list)
    for r in docs.collect():
        ids = ids_of(r.text) + [1]
        texts[r.doc_id].append(ids)
        want.update((r.doc_id, len(ids), i, x) for i, x in enumerate(ids))
    got = Counter()
    places = defaultdict(list)
    for r in rows:
        ids = np.frombuffer(r.ids, "<u4").tolist()
        assert len(ids) == r.length > 0
        got.update((r.doc_id, r.doc_tokens, r.start + i, x) for i, x in enumerate(ids))
        places[r.sequence_id].append((r.offset, r.length))
    assert got == want
    for p in places.values():               # gapless from 0
        end = 0
        for offset, length in sorted(p):
            assert offset == end
            end += length
        assert end <= 64
    padding = sum(64 - sum(n for _, n in p) for p in places.values())
    groups = len({s >> 32 for s in places})
    assert padding < 64 * groups            # one open sequence per group at most


def test_packing_does_not_depend_on_row_order(spark):
    docs = odd_docs(spark).coalesce(1)
    key = lambda d: sorted(map(tuple, packing.pack(d, BYTES, capacity=128).collect()), key=repr)
    assert key(docs) == key(docs.orderBy("n_chars", "doc_id").coalesce(1))


def test_packing_an_empty_table(spark):
    assert packing.pack(no_docs(spark), BYTES).count() == 0


# ---- token files ----------------------------------------------------------------------
def test_code_round_trip():
    rng = np.random.default_rng(3)
    for n in (0, 1, 3, 4, 5, 1000):
        ranks = (rng.integers(0, 1 << 32, n, dtype=np.uint64) >> rng.integers(0, 33, n).astype(np.uint64)).astype(np.uint32)
        control, data = token_files.encode_ranks(ranks)
        assert len(control) == -(-n // 4)
        assert token_files.decode_ranks(control, data, n).tolist() == ranks.tolist()
    docs, counts, ranks = token_files.from_payload(token_files.to_payload([None, -5, 9], [1, 2, 3], np.arange(6, dtype=np.uint32)))
    assert (docs, counts, ranks.tolist()) == ([None, -5, 9], [1, 2, 3], list(range(6)))
    with pytest.raises(ValueError):
        token_files.from_payload(b"XXXX" + bytes(40))


def test_frequent_tokens_take_one_byte(spark, tmp_path):
    out = token_files.write_tokens(odd_docs(spark), str(tmp_path / "t"), path=WORDS)
    ranks = {r.token: r.rank for r in spark.read.parquet(f"{out}/ranks").collect()}
    ids = Counter(i for r in odd_docs(spark).collect() for i in library(WORDS)(r.text) + [1])
    order = sorted(ids, key=lambda t: (-ids[t], t))
    assert [ranks[t] for t in order] == list(range(len(order)))


@pytest.mark.parametrize("segment,part", [(1 << 18, 32 << 20), (50, 3000)])
def test_files_hold_every_document_in_order(spark, tmp_path, monkeypatch, segment, part):
    monkeypatch.setattr(token_files, "SEGMENT_IDS", segment)
    monkeypatch.setattr(token_files, "PART_BYTES", part)
    docs = odd_docs(spark)
    got = token_files.token_files(docs, path=WORDS).collect()
    ids_of = library(WORDS)
    want = Counter((r.doc_id, np.array(ids_of(r.text) + [1], "<u4").tobytes()) for r in docs.collect())
    assert Counter((r.doc_id, bytes(r.ids)) for r in got) == want
    got.sort(key=lambda r: r.start)
    end = 0
    for r in got:
        assert r.start == end and r.n_tokens == len(r.ids) // 4
        end += r.n_tokens
    known = [r.doc_id for r in got]
    assert known[0] is None and known[1:] == sorted(known[1:])


def test_files_of_an_empty_table(spark):
    assert token_files.token_files(no_docs(spark), path=WORDS).count() == 0


# ---- token counts ---------------------------------------------------------------------
def greedy(vocabulary, word):
    n = i = 0
    while i < len(word):
        j = next((j for j in range(len(word), i, -1) if word[i:j] in vocabulary), None)
        if j is None:
            return 1
        n, i = n + 1, j
    return n


def test_automaton_equals_greedy_longest_match():
    rng = random.Random(4)
    for _ in range(200):
        v = {bytes(rng.choices(b"abc", k=rng.randint(1, 5))) for _ in range(rng.randint(1, 12))}
        a = Automaton(v)
        for _ in range(40):
            w = bytes(rng.choices(b"abc", k=rng.randint(0, 14)))
            assert a.count(w) == greedy(v, w)


def test_token_counts_of_whole_texts(spark):
    v = set(byte_vocabulary(BYTES))
    docs = odd_docs(spark)
    want = Counter()
    for r in docs.collect():
        words = (r.text or "").encode().split()
        want[(r.doc_id, len(words), sum(greedy(v, b" " + w) for w in words))] += 1
    assert Counter(map(tuple, token_counts(docs, BYTES).collect())) == want
    assert token_counts(no_docs(spark), BYTES).count() == 0


def test_crc_is_of_little_endian_ids(spark):
    from pyspark.sql import functions as F
    r = packing.pack(spark.createDataFrame([(1, "abc")], "doc_id long, text string"), BYTES) \
        .select("ids", F.crc32("ids").alias("c")).first()
    assert r.c == zlib.crc32(bytes(r.ids))
