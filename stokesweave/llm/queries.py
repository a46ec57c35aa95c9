"""Registered queries of the text operators, and their SQL where SQL can express them."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from stokesweave.llm import bottom_k, byte_bpe, conversations, divergence, html_mincut, language_id, licenses, line_dedup, ngram_lm, packing, simhash, topk, toxicity
from stokesweave.llm.common import table

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}


def query(fn: Callable[[SparkSession, str], DataFrame]) -> Callable[[SparkSession, str], DataFrame]:
    QUERIES[fn.__name__] = fn
    return fn


@query
def op1_html_extraction(spark: SparkSession, sf_dir: str) -> DataFrame:
    return html_mincut.extract(table(spark, sf_dir, "pages"))


@query
def op2_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.pack(table(spark, sf_dir, "documents"), public_tokenizers.path("byte_bpe_50k.json"))


@query
def op3_license_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = licenses.scan(table(spark, sf_dir, "documents"))
    return found.drop("spans")


@query
def op4_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    # the share of its SQL: documents of more than half boilerplate keep it
    return line_dedup.remove_boilerplate(table(spark, sf_dir, "documents"), most_removed=0.5).select("doc_id", "text", "n_lines", "n_removed")


@query
def line_dedup_own_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    return line_dedup.remove_boilerplate(table(spark, sf_dir, "documents")).select("doc_id", "text", "n_lines", "n_removed")


ORACLES["op4_line_dedup"] = line_dedup.oracle()


@query
def op5_simhash_neardup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return simhash.near_duplicates(table(spark, sf_dir, "documents"))


@query
def op6_fingerprints(spark: SparkSession, sf_dir: str) -> DataFrame:
    return bottom_k.edited_likeness(table(spark, sf_dir, "documents"))


@query
def op7_byte_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    return byte_bpe.encode_digest(table(spark, sf_dir, "documents"), public_tokenizers.path("byte_bpe_multi_50k.tiktoken"), public_tokenizers.PATTERN)


@query
def op8_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    labels = table(spark, sf_dir, "labels").select("doc_id", "toxic")
    model = toxicity.train(docs, labels.filter(~toxicity.held_out()))
    return toxicity.score(docs, model).select("doc_id", toxicity.held_out().alias("held_out"), "score", "predicted", "worst_sentence", "sentence_score")


@query
def op9_exact_topk(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = topk.integer_vectors(table(spark, sf_dir, "embeddings"))
    return topk.top_k(rows.filter(F.col("key") % 20 == 0), rows)


@query
def op10_lm_scoring(spark: SparkSession, sf_dir: str) -> DataFrame:
    scored = ngram_lm.score(table(spark, sf_dir, "documents"))
    return scored.select("doc_id", "n_words", (F.round("log_score", 4) + F.lit(0.0)).alias("log_score"))


@query
def lm_scoring_three_words(spark: SparkSession, sf_dir: str) -> DataFrame:
    scored = ngram_lm.score(table(spark, sf_dir, "documents"), order=3)
    return scored.select("doc_id", "n_words", (F.round("log_score", 4) + F.lit(0.0)).alias("log_score"))


ORACLES["op10_lm_scoring"] = ngram_lm.oracle()


@query
def op11_source_divergence(spark: SparkSession, sf_dir: str) -> DataFrame:
    return divergence.audit(table(spark, sf_dir, "documents"))


ORACLES["op11_source_divergence"] = divergence.oracle()


@query
def op12_conversation_repair(spark: SparkSession, sf_dir: str) -> DataFrame:
    return conversations.repair(table(spark, sf_dir, "conversations"))


@query
def op13_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    found = language_id.identify(docs, language_id.train(docs), spans=False)
    return found.select("doc_id", toxicity.held_out("doc_id", 4, 2).alias("held_out"), "lang_pred", "score")
