"""MERGE-style table maintenance as pure functions (target, source) -> new target.

Plain Parquet has no MERGE/UPDATE/DELETE, so every operation returns the complete new
target as a lazy plan; `sources.sinks.write_staged` writes it to a new directory and swaps.
Each result carries an `_action` column (insert / update / delete / unchanged) that the
audit counts (A13) read; `drop_action` removes it before writing.

Plans: the upsert is a left join of the target with the (small, staged) source plus an
anti join on the key column for the inserts, so a small batch never shuffles the target;
delete-marking and tombstones are anti/semi joins plus a `when`; nothing is collected
on the driver.
"""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.functions.literals import lit
from tidemark.operators.joins import attach_scalar

ACTION = "_action"


def _listify(x) -> list:
    return [x] if isinstance(x, str) else list(x)


def drop_action(df: DataFrame) -> DataFrame:
    return df.drop(ACTION)


def assert_unique_source(source: DataFrame, key) -> DataFrame:
    """Rows of `source` whose key occurs more than once (trap T9); empty = fit to merge."""
    keys = _listify(key)
    keyed = source.filter(reduce(lambda a, b: a & b, [F.col(k).isNotNull() for k in keys]))   # NULL never matches
    return keyed.groupBy(*keys).count().filter(F.col("count") > 1)


def _before(a: Sequence, b: Sequence):
    """a < b as tuples; unknown (a NULL part) counts as not before."""
    out, same = F.lit(False), F.lit(True)
    for x, y in zip(a, b):
        out, same = out | (same & (x < y)), same & (x == y)
    return F.coalesce(out, F.lit(False))


def merge_upsert(target: DataFrame, source: DataFrame, key, no_update: Sequence[str] = (),
                 gate: str | None = "HASH_CHANGE", update_cols: Sequence[str] | None = None,
                 op_col: str = "OPERATION_TYPE", check_unique: bool = True,
                 stage_source: bool = True, order_cols: Sequence[str] = (),
                 on_schema_change: str = "append_new_columns") -> DataFrame:
    """Hash-gated upsert.

    matched and gate differs (NULL never differs)  -> update every column except the key,
        `no_update` and `op_col` from the source (or only `update_cols`);
        op_col = 'DELETE' if the source says DELETE else 'UPDATE'
    matched, gate equal                             -> unchanged
    target only                                     -> unchanged
    source only                                     -> inserted as is
    gate=None is the ungated form: every matched row is updated.
    order_cols (capture time, log id): a source row that comes before the target row in this
    order never updates it, so a late file or a replay cannot bring an older image back.
    check_unique=True first runs one aggregate over the staged source and raises when a key
    occurs twice (trap T9: a duplicated source key would multiply the target's rows).
    on_schema_change (`sinks.evolve`): new source columns are added to the target and types widened
    ('append_new_columns'), refused ('fail') or left out ('ignore'). A target column that the
    source lacks keeps its value on update and is NULL on insert.

    Plan: `target LEFT JOIN source` for the existing rows plus `source LEFT ANTI target`
    (key column only) for the inserts, instead of one full outer join. When the source
    batch is small it is broadcast and the target is not shuffled at all; otherwise only
    the target's key column is shuffled for the anti join. stage_source=True writes the
    batch once first (a table in the shared checkpoint folder), so its exact size is known to the planner and
    it is not recomputed for the two joins.
    """
    keys = _listify(key)
    from tidemark.sources.sinks import cut_lineage, evolve
    if stage_source:
        source = cut_lineage(source)
    if check_unique:
        dup = assert_unique_source(source, keys).limit(1).collect()
        if dup:
            raise ValueError(f"merge source has duplicate keys, e.g. {dup[0].asDict()}")
    target, source, missing = evolve(target, source, on_schema_change)
    no_update = [*no_update, *missing]
    cols = target.columns
    s = source.select(*[F.col(c).alias(f"s__{c}") for c in cols], F.lit(True).alias("_s"))
    cond = reduce(lambda a, b: a & b, [target[k] == s[f"s__{k}"] for k in keys])
    j = target.join(s, cond, "left")
    matched = F.col("_s").isNotNull()
    if gate is None:
        do_update = matched
    else:
        do_update = matched & F.coalesce(F.col(gate) != F.col(f"s__{gate}"), F.lit(False))
    if order_cols:
        do_update = do_update & ~_before([F.col(f"s__{c}") for c in order_cols], [F.col(c) for c in order_cols])
    if update_cols is None:
        upd = [c for c in cols if c not in set(no_update) | {op_col} | set(keys)]
    else:
        upd = list(update_cols)
    out = []
    for c in cols:
        if c == op_col:
            new = F.when(F.col(f"s__{c}") == F.lit("DELETE"), F.lit("DELETE")).otherwise(F.lit("UPDATE"))
        elif c in upd:
            new = F.col(f"s__{c}")
        else:
            new = F.col(c)
        out.append(F.when(do_update, new).otherwise(F.col(c)).alias(c))
    existing = j.select(*out, F.when(do_update, F.lit("update")).otherwise(F.lit("unchanged")).alias(ACTION))
    inserts = (source.join(target.select(*keys), keys, "left_anti")
               .select(*cols, F.lit("insert").alias(ACTION)))
    return existing.unionByName(inserts)


def delete_insert(target: DataFrame, source: DataFrame, key, on_schema_change: str = "append_new_columns") -> DataFrame:
    """delete+insert (E2): drop target rows whose key is in the source, insert the source."""
    from tidemark.sources.sinks import evolve
    keys = _listify(key)
    target, source, _ = evolve(target, source, on_schema_change)
    kept = target.join(source.select(*keys).distinct(), keys, "left_anti")
    return (kept.withColumn(ACTION, F.lit("unchanged"))
                .unionByName(source.select(*target.columns).withColumn(ACTION, F.lit("insert"))))


def append(target: DataFrame, source: DataFrame, on_schema_change: str = "append_new_columns") -> DataFrame:
    """Append-only sink (A7): plain INSERT ... SELECT, by column name."""
    from tidemark.sources.sinks import evolve
    target, source, _ = evolve(target, source, on_schema_change)
    return (target.withColumn(ACTION, F.lit("unchanged"))
                  .unionByName(source.select(*target.columns).withColumn(ACTION, F.lit("insert"))))


def upsert(target: DataFrame, source: DataFrame, key, strategy: str = "merge", **kw) -> DataFrame:
    """Strategy selector (A8): 'merge', 'delete+insert' or 'scd+merge'; others raise."""
    if strategy == "merge":
        return merge_upsert(target, source, key, **kw)
    if strategy == "delete+insert":
        return delete_insert(target, source, key, **kw)
    if strategy == "scd+merge":
        from tidemark.operators.scd import scd_merge
        return scd_merge(target, source, key, **kw)
    raise ValueError(f"unknown incremental strategy {strategy!r}: "
                     "expected 'merge', 'delete+insert' or 'scd+merge'")


def merge_counts(merged: DataFrame) -> DataFrame:
    """DML counts of a merge result (A13): one row with inserted / updated / deleted
    (an SCD close-out is an UPDATE of the closed row).
    A fresh load (no `_action` column: the table was created by this run) counts every
    row as inserted."""
    if ACTION not in merged.columns:
        merged = merged.withColumn(ACTION, F.lit("insert"))
    a = F.col(ACTION)
    return merged.agg(
        F.count(F.when(a == "insert", 1)).cast("bigint").alias("rows_inserted"),
        F.count(F.when(a.isin("update", "close"), 1)).cast("bigint").alias("rows_updated"),
        F.count(F.when(a == "delete", 1)).cast("bigint").alias("rows_deleted"),
        F.count(F.lit(1)).cast("bigint").alias("rows_total"))


def mark_deleted(target: DataFrame, staging: DataFrame, keys, ts_col: str = "STG_INSERT_TIMESTAMP",
                 op_col: str = "OPERATION_TYPE", del_col: str = "SRC_DEL_IND",
                 action_col: str = "SRC_ACTION_CD", upd_ts: str = "ODS_UPDATE_TIMESTAMP",
                 upd_batch: str = "ODS_UPD_BATCH_ID") -> DataFrame:
    """Soft-delete by snapshot absence.

    A target row whose key is absent from the latest staging load (rows with
    ts = max(ts)) and that is not already DELETE becomes DELETE / 'Y' / 'D', with the
    update timestamp and batch set to the target's current maxima. String keys are
    compared trimmed."""
    keys = _listify(keys)
    latest_ts = staging.agg(F.max(ts_col).alias("_max_ts"))
    latest = (attach_scalar(staging.select(*keys, ts_col), latest_ts)
              .filter(F.col(ts_col) == F.col("_max_ts")).select(*keys))
    maxima = target.agg(F.max(upd_batch).alias("_mb"), F.max(upd_ts).alias("_mt"))
    # keys of the latest load, normalised like the target's (trimmed strings), one row each
    ttypes = dict(target.dtypes)
    present = latest.select(*[(F.trim(F.col(k)) if ttypes[k] == "string" else F.col(k)).alias(f"_p{i}")
                              for i, k in enumerate(keys)]).distinct().withColumn("_present", F.lit(True))
    cond = reduce(lambda a, b: a & b,
                  [(F.trim(target[k]) if ttypes[k] == "string" else target[k]) == present[f"_p{i}"]
                   for i, k in enumerate(keys)])
    lab = attach_scalar(target.join(present, cond, "left"), maxima)
    hit = F.col("_present").isNull() & F.coalesce(F.col(op_col) != F.lit("DELETE"), F.lit(False))
    out = []
    for c in target.columns:
        new = {op_col: F.lit("DELETE"), del_col: F.lit("Y"), action_col: F.lit("D"),
               upd_ts: F.col("_mt"), upd_batch: F.col("_mb")}.get(c)
        out.append(F.when(hit, new).otherwise(F.col(c)).alias(c) if new is not None else F.col(c))
    return lab.select(*out, F.when(hit, F.lit("delete")).otherwise(F.lit("unchanged")).alias(ACTION))


def propagate_deletes(dim: DataFrame, deleted_src: DataFrame, key: str, flag_col: str = "IS_DELETED") -> DataFrame:
    """Flag every dimension row whose key has a deleted source row."""
    keys = deleted_src.select(F.col(key)).distinct().withColumn("_gone", F.lit(True))
    j = dim.join(keys, key, "left")
    return j.select(*[F.when(F.col("_gone"), F.lit(True)).otherwise(F.col(c)).alias(c) if c == flag_col
                      else F.col(c) for c in dim.columns])


def tombstone_renamed(target: DataFrame, renamed_keys: DataFrame, key: str, run_ts,
                      batch: int, order_cols: Sequence[str] = ()) -> DataFrame:
    """Mark target rows whose key was renamed away as deleted before the merge.

    `renamed_keys` holds the key of each PK-change record's before image. The load time
    goes to the ODS update columns; the source time column is left alone (trap T8).
    order_cols (capture time, log id, in both frames): a target row that is as new as the
    key's last rename, or newer, stays; the key was used again."""
    if order_cols:
        hits = renamed_keys.groupBy(F.col(key).alias("_rk")).agg(F.max(F.struct(*order_cols)).alias("_r"))
    else:
        hits = renamed_keys.select(F.col(key).alias("_rk")).distinct().withColumn("_r", F.lit(True))
    j = target.join(hits, target[key] == hits["_rk"], "left")
    hit = F.col("_r").isNotNull()
    if order_cols:
        hit = hit & ~_before([F.col("_r")[c] for c in order_cols], [F.col(c) for c in order_cols]) \
            & ~F.coalesce(reduce(lambda a, b: a & b, [F.col("_r")[c] == F.col(c) for c in order_cols]), F.lit(False))
    repl = {"SRC_ACTION_CD": F.lit("D"), "SRC_DEL_IND": F.lit("Y"),
            "ODS_UPD_BATCH_ID": F.lit(batch).cast("bigint"),
            "ODS_UPDATE_TIMESTAMP": lit(run_ts).cast("timestamp_ntz"),
            "OPERATION_TYPE": F.lit("DELETE")}
    out = [F.when(hit, repl[c]).otherwise(F.col(c)).alias(c) if c in repl else F.col(c)
           for c in target.columns]
    return j.select(*out, F.when(hit, F.lit("delete")).otherwise(F.lit("unchanged")).alias(ACTION))
