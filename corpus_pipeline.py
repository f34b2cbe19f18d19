"""The corpus pipeline: documents in, token ids out, in five stages.

Every stage takes all that its predecessor kept. All but the last return the
columns of ``documents``.
"""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession

from skylog.llm import bpe, exact_dedup, mixing, probminhash, toxicity
from skylog.llm.common import materialise, table

# Chunks whose ids a worker keeps, in each of two generations; it holds what the stages before have left there too.
KEPT = 100_000

Stage = Callable[[SparkSession, DataFrame, str], DataFrame]


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents not predicted toxic by a model that the labelled ones among them train."""
    model = toxicity.train(toxicity.learning_rows(docs, table(spark, sf_dir, "labels")))
    return toxicity.drop_toxic(docs, model)


def drop_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of documents with equal text the one with the largest id stays."""
    return exact_dedup.drop_duplicates(docs)


def drop_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of documents that links of 0.8 or more join, the one with the smallest id stays."""
    return probminhash.one_of_each(docs)


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Each document as often as its source's target weight asks for."""
    return mixing.mix(docs)


def encode(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """A line per mixed document: ``doc_id, n_tokens, ids_sha256, decoded_sha256, ids``."""
    return bpe.round_trip_digests(docs, public_tokenizers.path("word_bpe_49k.json"), keep_ids=True, kept=KEPT)


STAGES: list[tuple[str, Stage]] = [
    ("toxicity", drop_toxic),
    ("exact dedup", drop_copies),
    ("near dedup", drop_near_copies),
    ("mixing", mix_sources),
    ("bpe", encode),
]

# A learned score, near duplicates and BPE are beyond SQL; tests/llm holds the stages against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages on ``documents``, each written to the shared folder and read again by the next."""
    docs = table(spark, sf_dir, "documents")
    for place, (name, stage) in enumerate(STAGES):
        docs = stage(spark, docs, sf_dir)
        if place < len(STAGES) - 1:
            docs = materialise(docs, "stage-" + name.replace(" ", "-"))
    return docs
