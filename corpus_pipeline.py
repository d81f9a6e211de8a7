"""The corpus pipeline: quality rules, near-duplicates, benchmark contamination, secrets, packing.

Each stage takes (spark, docs, sf_dir), works on all documents the stage before it kept, and
returns the columns of `documents`; the last one returns the packing. `run` writes each stage's
result to the shared checkpoint folder and reads it back as the next one's input.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from tidemark.llm import decontaminate, minhash, packing, quality_rules, secret_scan
from tidemark.llm.common import cut_lineage, documents


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the rules' votes reject go."""
    return quality_rules.keep_good(docs)


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each component of near copies stays."""
    return minhash.keep_one(docs)


def benchmark(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold a benchmark passage go."""
    return decontaminate.drop_contaminated(docs, documents(spark, sf_dir, "benchmark"))


def secrets(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Secrets are replaced in the texts."""
    return secret_scan.redact(docs)


def packing_plan(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of the texts that are left with their sequences and offsets."""
    return packing.pack(docs)


STAGES = [
    ("quality rules", quality),
    ("near-duplicates", near_duplicates),
    ("benchmark contamination", benchmark),
    ("secrets", secrets),
    ("packing", packing_plan),
]

ORACLE_SQL = None     # learned quality votes, minhash and tokenizing have no SQL form


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = documents(spark, sf_dir)
    for i, (_, stage) in enumerate(STAGES):
        docs = stage(spark, docs, sf_dir)
        if i + 1 < len(STAGES):
            docs = cut_lineage(docs)
    return docs
