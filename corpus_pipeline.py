"""From raw documents to training sequences: rules, near-duplicates, secrets, mix, packing."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from millrace.llm.mixing import mixed_documents
from millrace.llm.packing import pack
from millrace.llm.quality_rules import good_documents
from millrace.llm.secrets import redact
from millrace.llm.shared import discard, noted, stored, table
from millrace.llm.simhash import one_per_group


def quality_rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the base rules or the learned list reject go."""
    return good_documents(docs, table(spark, sf_dir, "labels"))


def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document stays of each group whose fingerprints are linked, as op9 links them."""
    return one_per_group(docs)


def secret_scans(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Secrets are masked; every document stays."""
    return redact(docs)


def mixing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Each document as often as the mix takes it."""
    return mixed_documents(docs)


def packing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The pieces of all sequences."""
    return pack(docs)


STAGES = [
    ("quality rules", quality_rules),
    ("SimHash near-dedup", near_dedup),
    ("secret scans", secret_scans),
    ("mixing", mixing),
    ("packing", packing),
]

#: No SQL: stages learn, hash bit by bit and tokenize. Tested against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``, each reading what the one before has written.

    When a stage's result is written, what it was read from and what it stored on the way go.
    """
    docs, before = table(spark, sf_dir, "documents"), []
    for name, stage in STAGES:
        with noted() as made:
            docs = stored(stage(spark, docs, sf_dir), f"pipeline-{name.replace(' ', '-')}")
        discard(spark, before + made[:-1])
        before = made[-1:]
    return docs
