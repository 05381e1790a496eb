"""The corpus pipeline: quality classifier, SimHash near-duplicates, personal
data, mixing to target weights, packing.

Each stage is ``(spark, docs, sf_dir) -> DataFrame``; all but the last return the
columns of ``documents``.  ``run`` writes every stage's result as a Parquet table in the
shared scratch folder and reads it back as the next one's documents.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from panora.llm import mixing, pii, quality, simhash
from panora.llm.common import landed, table, tokenizer_path
from panora.llm.packing import pack


def quality_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents whose quality score is at least the classifier's threshold."""
    model = quality.fit(docs, table(spark, sf_dir, "labels"))
    return quality.keep_good(docs, model, quality.THRESHOLD)


def near_duplicate_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of every group linked by SimHash (3-word shingles, 2 bits)."""
    return simhash.dedup(docs, words_per_shingle=3, max_bits=2)


def personal_data_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Personal data replaced by the name of its kind."""
    return pii.redact(docs)


def mixing_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents as often as the target weights take them."""
    return mixing.mixed(docs)


def packing_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of training sequences."""
    packed = pack(docs, tokenizer_path("byte_bpe_50k.json"), added_tokens=True)
    return packed.select("doc_id", "start", "length", F.crc32("ids").alias("ids_crc32"), "doc_tokens",
                         "sequence_id", "offset")


STAGES = [
    ("quality", quality_stage),
    ("near_duplicates", near_duplicate_stage),
    ("personal_data", personal_data_stage),
    ("mixing", mixing_stage),
    ("packing", packing_stage),
]

#: the classifier and the fingerprints are beyond SQL: every stage and the final pieces are compared with plain Python
#: versions in tests/llm/test_plain_pipeline.py
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = landed(stage(spark, docs, sf_dir), f"stage-{name}")
    return STAGES[-1][1](spark, docs, sf_dir)
