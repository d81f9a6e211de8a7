"""Latest-row selection, content-duplicate purge and CDC change-log resolution.

Scale notes
* `latest_per_key` is `row_number() = 1` over a key window; Catalyst plans it as a
  partial `WindowGroupLimit` before the shuffle, so every map task ships at most one
  row per key: a hot key costs one row per input partition, not a third of the table.
* `purge_duplicates` keeps `rank() = 1` per content hash (a map-side partial
  WindowGroupLimit, so a hot group of copies ships only its top rows) plus the rows the
  reference cannot delete (NULL in an exclude column); no join back.
* `cdc_resolve` pre-aggregates rename records to the largest log id per before-key and
  removes renamed-away keys with one anti join on that (one row per key on both sides),
  so no key set is collected or broadcast unchecked.
"""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidemark.functions.literals import lit
from tidemark.operators.joins import attach_scalar


def _listify(x) -> list:
    return [x] if isinstance(x, (str, Column)) else list(x)


def order_desc(cols: Sequence[str], nulls_first: bool = True) -> list[Column]:
    """DESC ordering; nulls_first=True reproduces the warehouse default (trap T1)."""
    return [F.col(c).desc_nulls_first() if nulls_first else F.col(c).desc_nulls_last() for c in cols]


def latest_per_key(df: DataFrame, keys, order: Sequence[str], tiebreak: Sequence[str] = (),
                   nulls_first: bool = True) -> DataFrame:
    """Keep the latest row per key (W1): ROW_NUMBER() OVER (PARTITION BY keys
    ORDER BY order DESC [NULLS FIRST], tiebreak DESC) = 1.

    A tie-break is required whenever the order columns can tie (trap T5)."""
    keys = _listify(keys)
    w = Window.partitionBy(*keys).orderBy(*order_desc(list(order) + list(tiebreak), nulls_first))
    return (df.withColumn("_rn", F.row_number().over(w))
              .filter(F.col("_rn") == 1)
              .drop("_rn"))


def purge_duplicates(df: DataFrame, exclude: Sequence[str], hash_col: str = "_content_hash") -> DataFrame:
    """Drop older copies of the same content.

    Content = md5 over all columns but `exclude` (NULL -> 'NULL', no separator). Within a
    content hash, rows are ranked by the exclude columns DESC NULLS FIRST; rows ranked
    below the top are removed, except rows with a NULL in any exclude column (the
    reference deletes by tuple equality, which never matches NULL). Ties at the top stay.

    Plan: the kept rows are {rank = 1 and no NULL} + {any NULL}, two disjoint sets. The
    first is a `rank() = 1` filter, which Spark runs as a map-side partial
    WindowGroupLimit (a hot group of copies ships only its top rows per map task); the
    second is a plain filter. No join back and no sort aggregate."""
    from tidemark.functions.hashing import content_hash

    exclude = list(exclude)
    h = content_hash(df, exclude)
    hashed = df.select("*", h.alias(hash_col))
    w = Window.partitionBy(hash_col).orderBy(*order_desc(exclude, nulls_first=True))
    any_null = reduce(lambda a, b: a | b, [F.col(c).isNull() for c in exclude])
    top = (hashed.withColumn("_rk", F.rank().over(w)).filter(F.col("_rk") == 1)
           .filter(~any_null).select(*df.columns))
    return top.unionByName(df.filter(any_null))


def duplicates_removed(df: DataFrame, exclude: Sequence[str]) -> DataFrame:
    """The rows `purge_duplicates` deletes (for audit counts)."""
    kept = purge_duplicates(df, exclude)
    return df.exceptAll(kept)


def cdc_resolve(log: DataFrame, keys, before_keys, ts: str, log_id: str,
                change_flag: Column, mark=None, keyed: bool = True,
                tiebreak: Sequence[str] | None = None) -> DataFrame:
    """Resolve a CDC change log to the latest after-image per key.

    1. keep log rows with ts >= mark (mark None = everything),
    2. latest row per key by ts DESC NULLS FIRST (tie-break: log id DESC),
    3. drop keys that were renamed away: a PK-change record whose before-image key equals
       the key and whose log id is >= the kept row's id. With keyed=False the reference's
       unkeyed form is reproduced: the record's id is compared with the smallest kept id.
    Rows with a NULL key part are dropped (the reference's IN / CONCAT_WS semantics).
    """
    keys, before_keys = _listify(keys), _listify(before_keys)
    if len(keys) != len(before_keys):
        raise ValueError(f"cdc_resolve: {len(keys)} key columns but {len(before_keys)} before-image key columns")
    src = log if mark is None else log.filter(F.col(ts) >= lit(mark))
    dedup = latest_per_key(src, keys, [ts], tiebreak if tiebreak is not None else [log_id])
    dedup = dedup.filter(reduce(lambda a, b: a & b, [F.col(k).isNotNull() for k in keys]))
    changes = src.filter(change_flag).select(
        *[F.col(b).alias(f"_bk{i}") for i, b in enumerate(before_keys)],
        F.col(log_id).alias("_chg_id"))
    if keyed:
        # "some rename of this key has id >= the kept id" <=> max(rename id) >= kept id:
        # pre-aggregate the renames per before-key (partial aggregation, so a hot before-key
        # costs one row per map task) and anti join one row per key
        top = changes.groupBy(*[f"_bk{i}" for i in range(len(keys))]).agg(F.max("_chg_id").alias("_chg_id"))
        cond = [dedup[k] == top[f"_bk{i}"] for i, k in enumerate(keys)]
        cond.append((top["_chg_id"] >= dedup[log_id]) | dedup[log_id].isNull())
        return dedup.join(top, reduce(lambda a, b: a & b, cond), "left_anti")
    # unkeyed: a rename suppresses its before key when its id >= min(kept id) (or a kept id
    # is NULL, or nothing was kept); one-row scalar, no cartesian product
    stats = dedup.agg(F.min(log_id).alias("_min_id"),
                      (F.count(F.lit(1)) - F.count(log_id)).alias("_null_ids"),
                      F.count(F.lit(1)).alias("_n"))
    renamed = (attach_scalar(changes, stats)
                      .filter((F.col("_chg_id") >= F.col("_min_id")) | (F.col("_null_ids") > 0)
                              | (F.col("_n") == 0))
                      .select(*[f"_bk{i}" for i in range(len(keys))]).distinct())
    cond = [dedup[k] == renamed[f"_bk{i}"] for i, k in enumerate(keys)]
    return dedup.join(renamed, reduce(lambda a, b: a & b, cond), "left_anti")
