"""Join helpers: bounded lookups, star joins, one-row scalars, semi/anti joins.

Broadcast policy: no file is broadcast by a hint; the planner knows the files' sizes. Only an
inline constant table of known length is. One-row aggregates are attached as scalar
subqueries, not joins.
Every join is left to the planner: AQE reads the real shuffle sizes and turns a
sort-merge join into a broadcast join only when the built side fits
`spark.sql.adaptive.autoBroadcastJoinThreshold`, and splits skewed partitions otherwise.
"""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def attach_scalar(df: DataFrame, one_row: DataFrame) -> DataFrame:
    """Attach the columns of a one-row relation (a global aggregate) to every row.

    Expressed as one scalar subquery returning a struct: Spark evaluates the aggregate
    once and hands the value to every task, with no join at all (the reference's
    `(SELECT MAX(...))` / `JOIN ... ON 1=1` with a one-row CTE). Spark enforces the bound:
    a subquery returning more than one row fails the query instead of multiplying rows."""
    cols = one_row.columns
    s = one_row.select(F.struct(*[F.col(c) for c in cols]).alias("_scalar")).scalar()
    return df.select("*", *[s.getField(c).alias(c) for c in cols])


def lookup(df: DataFrame, lk: DataFrame, on, how: str = "left") -> DataFrame:
    """Left lookup join."""
    return df.join(lk, on, how)


def star_join(driving: DataFrame, sources: Sequence[tuple[DataFrame, object]]) -> DataFrame:
    """Driving table LEFT JOIN each source on its key (J3): (df, on), where `on` may name several
    columns (a composite key). Sources sharing the driving key reuse one hash partitioning."""
    out = driving
    for src, on in sources:
        out = lookup(out, src, on, "left")
    return out


def _distinct_keys(keys: DataFrame, on) -> DataFrame:
    """One row per key, made map side first: the right side of a semi or anti join cannot be
    split, so a hot key must not arrive there with all its rows."""
    return keys.select(*([on] if isinstance(on, str) else on)).distinct()


def semi(df: DataFrame, keys: DataFrame, on) -> DataFrame:
    return df.join(_distinct_keys(keys, on), on, "left_semi")


def anti(df: DataFrame, keys: DataFrame, on) -> DataFrame:
    return df.join(_distinct_keys(keys, on), on, "left_anti")


def not_in(df: DataFrame, col: str, other: DataFrame, other_col: str) -> DataFrame:
    """SQL `col NOT IN (SELECT other_col ...)` including its NULL rule: any NULL on the
    right empties the result, and a NULL on the left never qualifies (J14)."""
    right = other.select(F.col(other_col).alias("_ni"))
    nulls = right.agg(F.count(F.when(F.col("_ni").isNull(), 1)).alias("_right_nulls"))
    base = df.filter(F.col(col).isNotNull()).join(right.distinct(), F.col(col) == F.col("_ni"), "left_anti")
    return (attach_scalar(base, nulls).filter(F.col("_right_nulls") == 0).drop("_right_nulls"))


def key_condition(left: DataFrame, right: DataFrame, pairs: Sequence[tuple[str, str]]) -> Column:
    return reduce(lambda a, b: a & b, [left[a] == right[b] for a, b in pairs])
