"""Strings of added tokens against the library's plain call."""

import random
import zlib

import numpy as np
import pytest
from tokenizers import Tokenizer

import corpus_pipeline
from panora.llm import queries
from panora.llm.tokens import Encoder
from tests.llm.helpers import BYTES, ODD_TEXTS, WORDS, folder, odd_docs, prose

MARKED = ["a <|endoftext|> b", "<|endoftext|>", "x<|startoftext|><|endoftext|>y ", "a  <|endoftext|>\n\nb",
          "<|<|endoftext|>|>", "<|ENDOFTEXT|> <|endoftext", "é <|startoftext|>日本 it's<|endoftext|>'s"]


def plain(path):
    t = Tokenizer.from_file(path)
    return lambda s: t.encode(s or "", add_special_tokens=False).ids


@pytest.mark.parametrize("path", [BYTES, WORDS])
@pytest.mark.parametrize("room", [0, 10**6])
def test_ids_equal_the_plain_call(path, room):
    enc, want, rng = Encoder(path, room, added_tokens=True), plain(path), random.Random(2)
    parts = list("ab é\nÇ'1\t.İ日😀  ") + ["<|endoftext|>", "<|startoftext|>", "<|", "|>", "<|EndOfText|>"]
    texts = [t or "" for t in ODD_TEXTS] + MARKED + [prose(rng, 40) + "<|endoftext|>" + prose(rng, 40)] \
        + ["".join(rng.choices(parts, k=rng.randint(1, 30))) for _ in range(600)]
    for t, ids in zip(texts, enc.encode(texts)):
        assert np.frombuffer(ids, enc.dtype).tolist() == want(t), repr(t)


def test_queries_and_the_pipeline_give_the_plain_calls_ids(spark, tmp_path):
    docs = odd_docs(spark, MARKED).filter("doc_id is not null").dropDuplicates(["doc_id"])
    at, texts = folder(tmp_path, documents=docs), {r.doc_id: r.text for r in docs.collect()}

    def crc(ids):
        return zlib.crc32(np.array(ids, "<u4").tobytes())
    want = {d: [*plain(BYTES)(t), 1] for d, t in texts.items()}
    for rows in (queries.op4_packing(spark, at).collect(),
                 corpus_pipeline.packing_stage(spark, docs, at).collect()):
        for r in rows:
            assert r.doc_tokens == len(want[r.doc_id])
            assert r.ids_crc32 == crc(want[r.doc_id][r.start:r.start + r.length])
    got = {r.doc_id: (r.n_tokens, r.ids_crc32) for r in queries.op10_token_files(spark, at).collect()}
    want = {d: [*plain(WORDS)(t), 1] for d, t in texts.items()}
    assert got == {d: (len(ids), crc(ids)) for d, ids in want.items()}
