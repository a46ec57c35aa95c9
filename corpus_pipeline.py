"""A training-corpus pipeline over ``documents``: toxicity, line dedup, near-duplicates, packing."""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from stokesweave.llm import line_dedup, packing, simhash, toxicity
from stokesweave.session import Stages


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the multiple-instance model, learned from labelled documents outside the held-out fold, does not call toxic."""
    labels = spark.read.parquet(f"{sf_dir}/labels.parquet").select("doc_id", "toxic")
    model = toxicity.train(docs, labels.filter(~toxicity.held_out()))
    return toxicity.keep_clean(docs, model)


def drop_boilerplate(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without the lines that stand on ten or more sites."""
    cleaned = line_dedup.remove_boilerplate(docs)
    return cleaned.select(*[F.length("text").cast(docs.schema[c].dataType).alias(c) if c == "n_chars" else F.col(c) for c in docs.columns])


def drop_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near-duplicates: five-word shingles, similarity 0.8 or more."""
    return simhash.keep_one(docs, simhash.similar_groups(docs, width=5, similarity=0.8))


def pack_sequences(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of the remaining documents in sequences of 2048 tokens."""
    return packing.pack(docs, public_tokenizers.path("byte_bpe_50k.json"))


STAGES = [
    ("toxicity", drop_toxic),
    ("line_dedup", drop_boilerplate),
    ("simhash_neardup", drop_near_duplicates),
    ("packing", pack_sequences),
]


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages in order, each written to the shared folder before the next reads it and removed after that."""
    stages, docs = Stages(), spark.read.parquet(f"{sf_dir}/documents.parquet")
    for _, stage in STAGES[:-1]:
        kept = stages.cut(stage(spark, docs, sf_dir))
        stages.drop(docs)
        docs = kept
    return STAGES[-1][1](spark, docs, sf_dir)


#: SQL can express neither the learned classifier nor the packing; tests hold the stages against brute force
ORACLE_SQL = None
