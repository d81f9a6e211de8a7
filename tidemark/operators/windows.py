"""Skew-safe ordered neighbours: the previous / next row of the same key.

`lag` / `lead` over `Window.partitionBy(key).orderBy(...)` send every row of a key to
one task, so a key holding a third of the table is processed by one core. `neighbours`
computes the same values without that concentration:

1. a global range sort on (key, order): Spark's range partitioner samples the sort key,
   so a hot key is cut into several balanced partitions;
2. inside each range partition the previous / next row is a window over the partition
   id ordered by the row's position (partitions are balanced by construction);
3. the first and last row of every partition take their neighbour from the adjacent
   non-empty partition through an edge table with one row per partition (its size is
   bounded by the partition count, not by the data), joined as a broadcast.
A neighbour is kept only when it has the same key. The sorted layout is written once
(a table in the shared checkpoint folder) so positions stay fixed if tasks are retried.

`running` gives running sums, maxima and minima per key in the same layout, as a segmented prefix
scan: each partition runs over its own part of a key, and what the earlier partitions hold of
the partition's first key (the running values of their last rows, one row per partition) is
added. `any_hot` measures whether a key is long enough to need either.
"""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tidemark.sources.sinks import cut_lineage


#: rows of one key that a task may well take in a window
HOT_ROWS = 1_000_000


def any_hot(df: DataFrame, keys: Sequence[str], bound: int = HOT_ROWS) -> bool:
    """Whether a key has more than `bound` rows: one pass over the key columns, counted map side."""
    return df.groupBy(*keys).agg(F.count(F.lit(1)).alias("n")).filter(F.col("n") > bound).limit(1).count() > 0


def lay_out(df: DataFrame, keys: Sequence[str], order: Sequence[str], partitions: int | None = None) -> DataFrame:
    """The staged rows in (keys, order), dealt over range partitions, with `_pid` (ascending in that
    order) and `_seq`, the row's place."""
    # without `partitions`, adaptive execution sizes the range partitions by the data
    dealt = df.repartitionByRange(partitions, *keys, *order) if partitions else df.repartitionByRange(*keys, *order)
    return cut_lineage(dealt.sortWithinPartitions(*keys, *order)
                       .withColumn("_pid", F.spark_partition_id())
                       .withColumn("_seq", F.monotonically_increasing_id()))


_FOLD = {"sum": (F.sum, lambda a, b: F.coalesce(a + b, a, b)), "max": (F.max, F.greatest), "min": (F.min, F.least)}


def running(df: DataFrame, keys: Sequence[str], order: Sequence[str], folds: dict[str, tuple[str, object]],
            partitions: int | None = None) -> DataFrame:
    """Add a running value per key in `order` (ascending, NULLS FIRST, up to the row itself) for each
    name -> (kind, column) in `folds`, kind `sum`, `max` or `min`. Equal to a window over
    Window.partitionBy(keys).orderBy(order) with ROWS from the start, without bringing a key's rows together;
    rows that agree in keys and order come in some order, as in the window."""
    keys = list(keys)
    srt = lay_out(df.select("*", *[c.alias(f"_x_{n}") if not isinstance(c, str) else F.col(c).alias(f"_x_{n}")
                                   for n, (_, c) in folds.items()]), keys, order, partitions)
    own = Window.partitionBy("_pid", *keys).orderBy("_seq").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    inner = cut_lineage(srt.select(*df.columns, "_pid", "_seq", *[_FOLD[k][0](f"_x_{n}").over(own).alias(f"_r_{n}")
                                                                  for n, (k, _) in folds.items()]))
    # one row per partition: its first key, and its last key with what the partition holds of it
    ends = inner.groupBy("_pid").agg(F.min("_seq").alias("_fs"), F.max("_seq").alias("_ls"))
    key = F.struct(*keys)
    held = [F.col(f"_r_{n}") for n in folds]
    none = [F.lit(None).cast(inner.schema[f"_r_{n}"].dataType).alias(f"_r_{n}") for n in folds]
    firsts = inner.join(F.broadcast(ends.select(F.col("_fs").alias("_seq"))), "_seq", "left_semi").select(
        "_pid", key.alias("_k"), F.lit(0).alias("_last"), *none)
    lasts = inner.join(F.broadcast(ends.select(F.col("_ls").alias("_seq"))), "_seq", "left_semi").select(
        "_pid", key.alias("_k"), F.lit(1).alias("_last"), *held)
    before = Window.partitionBy("_k").orderBy("_pid", "_last").rowsBetween(Window.unboundedPreceding, -1)
    carried = (firsts.unionByName(lasts).select("_pid", "_k", "_last", *[
        _FOLD[k][0](f"_r_{n}").over(before).alias(f"_b_{n}") for n, (k, _) in folds.items()])
        .filter("_last = 0").drop("_last"))
    j = inner.join(F.broadcast(carried), "_pid", "left")
    same = F.col("_k").eqNullSafe(key)
    return j.select(*df.columns, *[F.when(same, _FOLD[k][1](F.col(f"_b_{n}"), F.col(f"_r_{n}"))).otherwise(F.col(f"_r_{n}")).alias(n)
                                   for n, (k, _) in folds.items()])


def neighbours(df: DataFrame, keys: Sequence[str], order: Sequence[str], cols: Sequence[str],
               partitions: int | None = None, prefix_prev: str = "PREV_", prefix_next: str = "NEXT_") -> DataFrame:
    """Add PREV_<c> / NEXT_<c> for every c in `cols`: the value on the previous / next
    row of the same key in `order` (ascending, NULLS FIRST, like a window's default)."""
    keys, order, cols = list(keys), list(order), list(cols)
    carried = list(dict.fromkeys(keys + cols))
    srt = lay_out(df, keys, order, partitions)

    w = Window.partitionBy("_pid").orderBy("_seq")
    inner = srt.select(
        "*",
        *[F.lag(c).over(w).alias(f"_lp_{c}") for c in carried],
        *[F.lead(c).over(w).alias(f"_ln_{c}") for c in carried],
        F.lag("_seq").over(w).isNull().alias("_is_first"),
        F.lead("_seq").over(w).isNull().alias("_is_last"))

    # edge rows without sorting the data: a hash aggregate finds each partition's first and
    # last position (one row per partition), broadcast semi joins pick those rows out
    ends = srt.groupBy("_pid").agg(F.min("_seq").alias("_fs"), F.max("_seq").alias("_ls"))
    edge_row = F.struct(*[F.col(c) for c in carried])
    firsts = (srt.join(F.broadcast(ends.select(F.col("_fs").alias("_seq"))), "_seq", "left_semi")
              .select("_pid", edge_row.alias("_first")))
    lasts = (srt.join(F.broadcast(ends.select(F.col("_ls").alias("_seq"))), "_seq", "left_semi")
             .select("_pid", edge_row.alias("_last")))
    ew = Window.orderBy("_pid")      # one row per partition: a bounded, single-task window
    edges = firsts.join(lasts, "_pid").select(
        "_pid", F.lag("_last").over(ew).alias("_before"), F.lead("_first").over(ew).alias("_after"))

    j = inner.join(F.broadcast(edges), "_pid", "left")
    same_prev = reduce(lambda a, b: a & b, [F.col(f"_before.{k}").eqNullSafe(F.col(k)) for k in keys])
    same_next = reduce(lambda a, b: a & b, [F.col(f"_after.{k}").eqNullSafe(F.col(k)) for k in keys])
    same_lp = reduce(lambda a, b: a & b, [F.col(f"_lp_{k}").eqNullSafe(F.col(k)) for k in keys])
    same_ln = reduce(lambda a, b: a & b, [F.col(f"_ln_{k}").eqNullSafe(F.col(k)) for k in keys])
    out = []
    for c in cols:
        prev = (F.when(F.col("_is_first"), F.when(same_prev, F.col(f"_before.{c}")))
                .otherwise(F.when(same_lp, F.col(f"_lp_{c}"))))
        nxt = (F.when(F.col("_is_last"), F.when(same_next, F.col(f"_after.{c}")))
               .otherwise(F.when(same_ln, F.col(f"_ln_{c}"))))
        out += [prev.alias(f"{prefix_prev}{c}"), nxt.alias(f"{prefix_next}{c}")]
    return j.select(*df.columns, *out)
