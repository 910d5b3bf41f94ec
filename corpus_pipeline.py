"""A corpus pipeline over ``documents``.

Quality rules drop documents, near-duplicates keep one document of a group,
secrets are masked in the texts, and packing cuts what is left into training
sequences. Each stage takes (spark, docs, sf_dir) and works on all rows its
predecessor kept. ``ORACLE_SQL`` is None: SQL can express neither the
fingerprints nor the fitted decisions, so tests hold the stages against
brute-force versions.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from lakeloom.llm.packing import digests, pack_documents
from lakeloom.llm.quality import assess
from lakeloom.llm.secret_scan import redact_secrets
from lakeloom.llm.simhash import drop_near_duplicates
from lakeloom.llm.storage import materialize


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return assess(docs).filter("kept").select("row.*")


def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return drop_near_duplicates(docs)


def mask_secrets(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return redact_secrets(docs)


def packed(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return digests(pack_documents(docs))


STAGES: list[tuple[str, Callable[[SparkSession, DataFrame, str], DataFrame]]] = [
    ("quality rules", quality),
    ("simhash near-dedup", near_dedup),
    ("secret scans", mask_secrets),
    ("packing", packed),
]

ORACLE_SQL: str | None = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``; each is written and read again."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for k, (_, stage) in enumerate(STAGES):
        docs = stage(spark, docs, sf_dir)
        if k < len(STAGES) - 1:
            docs = materialize(docs, f"stage{k}")
    return docs
