"""A corpus pipeline over ``documents``: each stage takes what its predecessor kept."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from spanledger.llm.bpe import bpe_round_trip
from spanledger.llm.common import table
from spanledger.llm.mixing import MixTarget, mixed_documents
from spanledger.llm.quality import keep_quality
from spanledger.llm.secret_scan import redact_secrets
from spanledger.llm.simhash import keep_one_of_each
from spanledger.session import materialize

#: No document is lost to the mix: the largest source is taken once, the smallest at most one and a half times.
MIX = MixTarget(max_epochs=1.5, least_epochs=1.0)


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the classifier accepts."""
    return keep_quality(docs, table(spark, sf_dir, "labels"))


def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near duplicates."""
    return keep_one_of_each(docs)


def secrets(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, their secrets replaced by marks."""
    return redact_secrets(docs)


def mixing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents as often as the tempered weights of their sources say."""
    return mixed_documents(docs, MIX)


def encode(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """BPE ids of every remaining document, decoded again as a proof of the round trip."""
    return bpe_round_trip(docs)


STAGES = [
    ("quality classifier", quality),
    ("near duplicates", near_dedup),
    ("secrets", secrets),
    ("mixing", mixing),
    ("bpe", encode),
]

# the classifier, XXH64 fingerprints and BPE have no SQL form
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = materialize(stage(spark, docs, sf_dir), name.replace(" ", "-"))
    return STAGES[-1][1](spark, docs, sf_dir)
