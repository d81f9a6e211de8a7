"""Reading landed tables, two-path loads, constant lookups and typed empty tables."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

DRIVER_TABLES = ("region", "nation", "customer", "supplier", "part", "orders", "lineitem", "events",
                 "documents", "embeddings", "pages", "benchmark", "labels", "conversations")


def read_source(spark: SparkSession, root: str, name: str) -> DataFrame:
    """Scan a landed Parquet table (A1). Projection and filters applied later are pushed
    into the scan by Catalyst (ReadSchema / PushedFilters)."""
    return spark.read.parquet(f"{root.rstrip('/')}/{name}.parquet")


def register_views(spark: SparkSession, root: str, names: Sequence[str] = DRIVER_TABLES) -> None:
    for n in names:
        read_source(spark, root, n).createOrReplaceTempView(n)


def load(target_exists: bool, delta_df: DataFrame, history_df: DataFrame) -> DataFrame:
    """Two-path load (A2): the history backfill when the target is absent, the delta when
    it exists. Both paths must produce the same columns; the result is aligned by name."""
    if set(delta_df.columns) != set(history_df.columns):
        raise ValueError("two-path load: history and delta column sets differ: "
                         f"{sorted(set(delta_df.columns) ^ set(history_df.columns))}")
    chosen = delta_df if target_exists else history_df
    return chosen.select(*delta_df.columns)


def table_exists(spark: SparkSession, name_or_path: str) -> bool:
    """Whether the target exists (the two-path decision): a catalog table name, or a path
    checked through Spark so that any cluster file system works."""
    if "/" in name_or_path:
        from tidemark.sources.sinks import table_path_exists
        return table_path_exists(spark, name_or_path)
    return spark.catalog.tableExists(name_or_path)


INLINE_ROWS = 10_000


def lookup_values(spark: SparkSession, rows: Sequence[tuple], schema: StructType | str) -> DataFrame:
    """Inline constant table (A3): its length is known, and it is broadcast if that is small."""
    rows = list(rows)
    table = spark.createDataFrame(rows, schema)
    return F.broadcast(table) if len(rows) <= INLINE_ROWS else table


def empty_table(spark: SparkSession, schema: StructType | str) -> DataFrame:
    """Typed empty table."""
    return spark.createDataFrame([], schema)
