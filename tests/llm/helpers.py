"""Small tables with awkward rows, shared by the tests of this folder."""

import hashlib
import os
import random

from panora.llm.common import tokenizer_path

BYTES = tokenizer_path("byte_bpe_50k.json")
WORDS = tokenizer_path("word_bpe_49k.json")

#: texts every operator must cope with
ODD_TEXTS = [
    None, "", " ", "\n", "a", "a  b", " lead", "trail ", "Hello world's end.\n\nfoo \n bar", "x y z\xa0 w",
    "İstanbul J̌ test ǰ", "<|endoftext|> a <|endoftext|>", "日本語 テスト 12 ab12 don't DON'T", "a\tb c\r\nd",
    "é ́x", "Σας ΣΑΣ ΑΣ", "\x1c a\x1cb", "ñ" * 100, "a" * 5000, "1 23 456 7", "é,é. É!", "𝒳 😀 😀a", "word " * 3000,
]

DOCS = "doc_id long, text string, lang string, source string, n_chars long, __at0_doc_id string, label int"


def prose(rng: random.Random, words: int) -> str:
    pool = ["tion", "the", "re", "an", "er", "ing", "of", "to", "was", "in", "que", "de", "la"]
    return " ".join("".join(rng.choices(pool, k=rng.randint(1, 3))) for _ in range(words))


def odd_docs(spark, extra=()):
    """Null ids and texts, repeated rows, clashing extra columns, long texts."""
    rng = random.Random(5)
    texts = [*ODD_TEXTS, *(prose(rng, rng.randint(1, 400)) for _ in range(40)), *extra]
    rows = [(None if i == 7 else i, t, None if i % 11 == 0 else "en", None if i % 13 == 0 else f"src{i % 7}",
             None if t is None else len(t), "x", 1) for i, t in enumerate(texts)]
    rows += rows[-3:] * 3 + [rows[5]] * 4           # repeated rows
    rows += [(3, prose(rng, 30), "de", "src0", 1, "y", 0)]   # one id, another text
    return spark.createDataFrame(rows, DOCS)


def no_docs(spark):
    return spark.createDataFrame([], DOCS)


def folder(tmp_path, **tables):
    """Tables written as a test-data folder."""
    for name, df in tables.items():
        df.write.parquet(os.path.join(tmp_path, f"{name}.parquet"))
    return str(tmp_path)


def sha(text: str) -> str:
    return hashlib.sha256(text.encode()).hexdigest()
