"""A corpus from raw documents: the stages in order, each a function of (spark, docs, sf_dir)."""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession

from assayflow.llm import mixing, pii, sentencepiece, simhash, toxicity
from assayflow.llm.common import staged, table
from assayflow.llm.queries import label_weights


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Without the documents that the toxicity model rejects."""
    return toxicity.keep_clean(docs, toxicity.fit(docs, table(spark, sf_dir, "labels")))


def drop_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near-duplicates, that with the smallest doc_id."""
    return simhash.keep_first(docs)


def mask_personal_data(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Personal data replaced by their kinds."""
    return pii.mask(docs, pii.fit(docs))


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Each document as often as the mix takes it."""
    return mixing.mixed_documents(docs, label_weights(spark, sf_dir))


def encode_pieces(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """doc_id, n_tokens, ids and lossless of every document."""
    return sentencepiece.round_trip(docs, sentencepiece.Model.load(public_tokenizers.path("piece_bpe_32k.model")))


STAGES = [
    ("toxicity", drop_toxic),
    ("simhash_near_dedup", drop_near_duplicates),
    ("personal_data", mask_personal_data),
    ("source_mix", mix_sources),
    ("sentencepiece", encode_pieces),
]

#: Compression lengths, fitted weights and a segmentation are beyond SQL; tests hold the stages against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages, each written as Parquet in the shared folder and reread as the next one's input."""
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        docs, _ = staged(stage(spark, docs, sf_dir), f"corpus-{name}")
    return docs
