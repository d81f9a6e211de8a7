"""Exact distinct counts that are kept and merged instead of recounted.

A load's keys become bitmaps: key k sets bit k % 32768 of bitmap k / 32768, one row of 4 KB per
bitmap that has a key. The bitmaps of a new load are OR-ed into the kept ones, so the count over all
loads is exact and only the new load is read. For integer keys that are dense (row numbers, order
and customer numbers); widely scattered keys would cost up to 4 KB each. A key's rows are combined
map side, so a hot key ships one row per task; Spark sorts for these aggregates, as their buffers are
binary, so a single count over one table is better taken with COUNT(DISTINCT). NULL keys are not
counted, as there.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

PART, BITS = "BITMAP_NO", "BITMAP"


def key_bitmaps(df: DataFrame, key: str, by: list[str] = ()) -> DataFrame:
    """The bitmaps of a load's keys: one row per bitmap number, per group if `by` names columns."""
    k = F.col(key).cast("bigint")
    return df.filter(k.isNotNull()).groupBy(*by, F.bitmap_bucket_number(k).alias(PART)).agg(
        F.bitmap_construct_agg(F.bitmap_bit_position(k)).alias(BITS))


def merge_bitmaps(kept: DataFrame, new: DataFrame, by: list[str] = ()) -> DataFrame:
    """The bitmaps of both; rows of either may be missing."""
    return kept.unionByName(new).groupBy(*by, PART).agg(F.bitmap_or_agg(BITS).alias(BITS))


def distinct_count(bitmaps: DataFrame, by: list[str] = (), name: str = "DISTINCT_KEYS") -> DataFrame:
    """One row (per group) with the number of distinct keys."""
    n = F.coalesce(F.sum(F.bitmap_count(BITS)), F.lit(0)).cast("bigint").alias(name)
    return bitmaps.groupBy(*by).agg(n) if by else bitmaps.agg(n)
