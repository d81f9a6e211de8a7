"""Registry of the queries over the driver tables.

Each entry pairs a Spark builder `(spark, sf_dir) -> DataFrame` with an ANSI SQL text
that DuckDB runs over the same Parquet tables (views named after the tables). Entries
without SQL are checked against a brute-force computation in the tests instead.
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession

Builder = Callable[[SparkSession, str], DataFrame]


@dataclass
class Entry:
    key: str
    build: Builder
    sql: str | None
    headline: bool = False


REGISTRY: dict[str, Entry] = {}


def query(key: str, sql: str | None = None, headline: bool = False):
    def deco(fn: Builder) -> Builder:
        if key in REGISTRY:
            raise KeyError(f"duplicate query key {key}")
        REGISTRY[key] = Entry(key, fn, sql.strip() if sql else None, headline)
        return fn
    return deco


def load_all() -> dict[str, Entry]:
    # importing the modules registers their queries
    from tidemark.plans import (q_changes, q_commits, q_joins, q_ods, q_projection,  # noqa: F401
                                q_quality, q_relational, q_sources)
    return REGISTRY
