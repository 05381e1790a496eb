"""The registered queries of this subpackage and their SQL.  Each is a thin
view of its operator: the digest columns are derived from its real output."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from panora.llm import ann, conversation, lexical, mixing, pii, quality, sql, topk, url_filter
from panora.llm.common import landed, table, tokenizer_path
from panora.llm.main_text import extract
from panora.llm.packing import pack
from panora.llm.simhash import components
from panora.llm.token_files import token_files
from panora.llm.wordpiece import token_counts

QUERIES: dict = {}
SQL: dict = {}


def op1_pii(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    # spans and features only: the text is read once
    found = landed(pii.candidates(docs).drop("text"), "pii")
    spans = pii.detect(found, pii.fit(found))
    counts = [pii.count(F.col("__pii_base"), k).alias(f"n_{k}") for k in pii.KINDS[:4]]
    return spans.select("doc_id", *counts, F.sha2(pii.shown(F.col("__pii_base")), 256).alias("base_sha256"),
                        pii.shown(F.col("__pii_spans")).alias("spans"))


#: the rules of the registered query: host, path, verdict
URL_RULES = [("org", "/", "allow"), ("example.org", "/es/", "block"), ("example.org", "/en/1", "block"),
             ("com", "/fr/", "allow"), ("com", "/de/", "block")]


def op2_url_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    return url_filter.judged(table(spark, sf_dir, "pages"), url_filter.rules_table(spark, URL_RULES))


def op3_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return token_counts(table(spark, sf_dir, "documents"), tokenizer_path("byte_bpe_50k.json"))


def op4_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    packed = pack(table(spark, sf_dir, "documents"), tokenizer_path("byte_bpe_50k.json"), added_tokens=True)
    return packed.select("doc_id", "start", "length", F.crc32("ids").alias("ids_crc32"), "doc_tokens",
                         "sequence_id", "offset")


def op7_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    taken = mixing.budgeted(table(spark, sf_dir, "documents"))
    return taken.select("doc_id", "domain", "lang", "source", "tokens", "copies", "times", "last_take")


def op8_ann(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ann.search(table(spark, sf_dir, "embeddings"), F.col("id") % 20 == 0, k=20)


def op9_topk(spark: SparkSession, sf_dir: str) -> DataFrame:
    return topk.search(table(spark, sf_dir, "embeddings"), F.col("id") % 50 == 0, k=5, scale=256)


def op10_token_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    read = token_files(table(spark, sf_dir, "documents"), path=tokenizer_path("word_bpe_49k.json"), added_tokens=True)
    return read.select("doc_id", "start", "n_tokens", F.crc32("ids").alias("ids_crc32"))


def op5_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    model = quality.fit(docs, table(spark, sf_dir, "labels"))
    return quality.score(docs, model).select(
        "doc_id", quality.held_out().alias("held_out"), "score",
        (F.col("score") >= quality.THRESHOLD).cast("int").alias("predicted"))


def op6_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = components(table(spark, sf_dir, "documents"), words_per_shingle=3, max_bits=2)
    return found.select("doc_id", F.lpad(F.lower(F.hex("fp")), 16, "0").alias("fingerprint"), "component_id")


def op11_main_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    return extract(table(spark, sf_dir, "pages"))


def op12_conversation_repair(spark: SparkSession, sf_dir: str) -> DataFrame:
    given = table(spark, sf_dir, "conversations")
    return conversation.repaired(conversation.damaged(given), given)


def op13_lexical_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    return lexical.search(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"), k=10)


QUERIES["op5_quality"] = op5_quality
QUERIES["op6_simhash"] = op6_simhash
QUERIES["op1_pii"] = op1_pii
QUERIES["op2_url_filter"] = op2_url_filter
SQL["op2_url_filter"] = sql.url_filter(URL_RULES)
QUERIES["op3_token_counts"] = op3_token_counts
QUERIES["op4_packing"] = op4_packing
QUERIES["op7_mixing"] = op7_mixing
SQL["op7_mixing"] = sql.mixing()
QUERIES["op8_ann"] = op8_ann
QUERIES["op9_topk"] = op9_topk
SQL["op9_topk"] = sql.TOPK
QUERIES["op10_token_files"] = op10_token_files
QUERIES["op11_main_text"] = op11_main_text
QUERIES["op12_conversation_repair"] = op12_conversation_repair
QUERIES["op13_lexical_search"] = op13_lexical_search
SQL["op13_lexical_search"] = sql.LEXICAL
