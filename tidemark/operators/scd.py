"""Slowly changing dimensions (types 1, 2 and 6) as DataFrame rewrites.

Dimension columns used here: the key, tracked attributes, HASH_SCD2, HASH_SCD1,
EFF_DT, DISC_DT (9999-12-31 = open), IS_CURRENT, INS_BATCH_ID, UPD_BATCH_ID.

`scd_merge` applies the reference's MERGE + close-out + type-1 + type-6 statements in
one lazy plan:
  * dim LEFT JOIN source on the key (source is unique per key) labels every existing
    version with its fate (keep / intra-day overwrite / close / type-1 overwrite);
  * a per-key aggregate over a narrow projection (key, dates, SCD2 hash) joined to the
    source decides which source rows are inserted (partial aggregation, skew safe), so
    the wide join is evaluated once and the second pass reads four columns;
  * type-6 change detection is a global one-row aggregate, attached as a scalar.
Decision table (d = source batch day = first 8 digits of INS_BATCH_ID):
  new key                      -> insert with EFF_DT 1900-01-01
  open row, d <= EFF_DT, (d = EFF_DT or inserted on the run day), hash2 differs
                               -> overwrite every column in place
  open row EFF_DT < d, hash2 differs -> insert new version, close old at run date - 1
  key without open row         -> insert new version
  hash2 equal, hash1 differs   -> overwrite every column of the open row (type 1)
  late source (d < EFF_DT, hash2 differs, not inserted today) -> no change by default;
      late_closeout=True reproduces the reference closing the open row
"""

from __future__ import annotations

import datetime as _dt
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidemark.operators.joins import attach_scalar
from tidemark.operators.merge import ACTION

OPEN_DATE = _dt.date(9999, 12, 31)
NEW_KEY_DATE = _dt.date(1900, 1, 1)


def _batch_day(c) -> Column:
    return F.to_date(F.substring(F.col(c).cast("string"), 1, 8), "yyyyMMdd")


def scd_init(src: DataFrame, as_of: _dt.date, batch: int) -> DataFrame:
    """Initial load (E7): every row open and current from the run date."""
    return src.select(
        "*",
        F.lit(as_of).alias("EFF_DT"), F.lit(OPEN_DATE).alias("DISC_DT"),
        F.lit(True).alias("IS_CURRENT"),
        F.lit(batch).cast("bigint").alias("INS_BATCH_ID"),
        F.lit(batch).cast("bigint").alias("UPD_BATCH_ID"))


def scd_merge(dim: DataFrame, src: DataFrame, key: str, as_of: _dt.date, batch: int,
              late_closeout: bool = False, preserve: Sequence[str] = (),
              type6: Sequence[str] = (), hash2: str = "HASH_SCD2", hash1: str = "HASH_SCD1",
              stage_source: bool = True, check_unique: bool = True,
              on_schema_change: str = "append_new_columns") -> DataFrame:
    """SCD 1/2/6 merge of a source batch into a dimension (E3-E6). Returns the new
    dimension with an `_action` column. `preserve` lists columns a type-1 / intra-day
    overwrite keeps from the target (default: none, as in the reference).

    stage_source=True writes the source batch once (a table in the shared checkpoint
    folder), as the reference stages its temp table before the MERGE: the batch is read
    several times below, and its exact size lets AQE broadcast it when it is small.
    check_unique=True (one aggregate over the batch) fails when it holds a key twice (trap T9).
    on_schema_change (`sinks.evolve`): new source columns are added to the dimension and types
    widened, or refused, or left out. A column that the source lacks keeps its value in place and
    is NULL in new versions.

    Only open rows can change, so only they go through the join with the batch; closed history
    is passed on as it is."""
    from tidemark.sources.sinks import cut_lineage, evolve
    if stage_source:
        src = cut_lineage(src)
    if check_unique:
        from tidemark.operators.merge import assert_unique_source
        dup = assert_unique_source(src, [key]).limit(1).collect()
        if dup:
            raise ValueError(f"SCD source has duplicate keys, e.g. {dup[0].asDict()}")
    dim, src, missing = evolve(dim, src, on_schema_change)
    preserve = [*preserve, *missing]
    cols = dim.columns
    opened = F.lit(OPEN_DATE)
    run_day = F.lit(as_of)
    s = src.select(*[F.col(c).alias(f"s__{c}") for c in cols], F.lit(True).alias("_s"))
    still_open = dim.filter(F.col("DISC_DT") == opened)
    closed = dim.filter(~F.coalesce(F.col("DISC_DT") == opened, F.lit(False))).withColumn(ACTION, F.lit("unchanged"))
    j = still_open.join(s, still_open[key] == s[f"s__{key}"], "left")

    is_open = F.col("DISC_DT") == opened
    has_src = F.col("_s").isNotNull()
    d = _batch_day("s__INS_BATCH_ID")
    h2_diff = F.coalesce(F.col(hash2) != F.col(f"s__{hash2}"), F.lit(False))
    h1_diff = F.coalesce(F.col(hash1) != F.col(f"s__{hash1}"), F.lit(False)) if hash1 in cols else F.lit(False)
    matched = has_src & is_open & (d <= F.col("EFF_DT"))
    inserted_today = _batch_day("INS_BATCH_ID") == run_day
    intraday = matched & ((d == F.col("EFF_DT")) | inserted_today) & h2_diff
    late = matched & ~((d == F.col("EFF_DT")) | inserted_today) & h2_diff
    close = has_src & is_open & h2_diff & ~intraday & ~matched
    if late_closeout:
        close = close | late
    type1 = has_src & is_open & ~h2_diff & h1_diff

    fate = (F.when(intraday, F.lit("intraday")).when(close, F.lit("close"))
            .when(type1, F.lit("type1")).otherwise(F.lit("keep")))
    labelled = j.select("*", fate.alias("_fate"))

    def overwritten(c: str) -> Column:
        if c in preserve:
            return F.col(c)
        return F.col(f"s__{c}")

    out = []
    for c in cols:
        e = F.when(F.col("_fate").isin("intraday", "type1"), overwritten(c))
        if c == "DISC_DT":
            e = e.when(F.col("_fate") == "close", F.date_sub(run_day, 1))
        elif c == "IS_CURRENT":
            e = e.when(F.col("_fate") == "close", F.lit(False))
        elif c == "UPD_BATCH_ID":
            e = e.when(F.col("_fate") == "close", F.lit(batch).cast("bigint"))
        out.append(e.otherwise(F.col(c)).alias(c))
    act = (F.when(F.col("_fate") == "keep", F.lit("unchanged"))
           .when(F.col("_fate") == "close", F.lit("close")).otherwise(F.lit("update")))
    existing = labelled.select(*out, act.alias(ACTION)).unionByName(closed)

    # Per key: does any open row match (d <= EFF_DT), does any open row carry the source
    # hash. Computed from narrow projections (key, dates, hash) so the wide join above is
    # evaluated once; the aggregate is partial (map side), so a hot key ships one row per
    # map task, and the small source side lets AQE broadcast it at runtime.
    nd = dim.select(key, "DISC_DT", "EFF_DT", hash2)
    ns = src.select(F.col(key).alias(f"s__{key}"), _batch_day("INS_BATCH_ID").alias("_sd"),
                    F.col(hash2).alias("_sh2"))
    nj = nd.join(ns, nd[key] == ns[f"s__{key}"], "inner")
    n_open = F.col("DISC_DT") == opened
    per_key = nj.groupBy(key).agg(
        F.max(F.when(n_open & (F.col("_sd") <= F.col("EFF_DT")), 1).otherwise(0)).alias("_any_matched"),
        F.max(F.when(n_open & ~F.coalesce(F.col(hash2) != F.col("_sh2"), F.lit(False)), 1).otherwise(0))
         .alias("_same_open"))
    ins = src.join(per_key, key, "left")
    new_key = F.col("_any_matched").isNull()
    new_version = (F.col("_any_matched") == 0) & (F.col("_same_open") == 0)
    inserts = ins.filter(new_key | new_version).select(
        *[F.when(new_key, F.lit(NEW_KEY_DATE)).otherwise(F.col(c)).alias(c) if c == "EFF_DT"
          else F.col(c) for c in cols],
        F.lit("insert").alias(ACTION))
    merged = existing.unionByName(inserts)
    if type6:
        merged = scd6_propagate(merged, key, type6, src=src, before=dim)
    return merged


def scd6_changed(before: DataFrame, src: DataFrame, key: str, cols: Sequence[str]) -> list[str]:
    """The listed columns whose value differs (NULL = '') between the source and the current row of
    any key."""
    cols = [c for c in cols if c in before.columns and c in src.columns]
    if not cols:
        return []
    row = _type6_flags(before, src, key, cols).first()
    return [c for c in cols if row[f"_chg_{c}"] == 1]


def _type6_flags(before: DataFrame, src: DataFrame, key: str, cols: Sequence[str]) -> DataFrame:
    """One row: 1 per column that changed."""
    cur = before.filter(F.col("IS_CURRENT") == F.lit(True)).select(key, *[F.col(c).alias(f"c__{c}") for c in cols])
    return src.select(key, *cols).join(cur, key, "inner").agg(
        *[F.max(F.when(F.coalesce(F.col(c).cast("string"), F.lit("")) != F.coalesce(F.col(f"c__{c}").cast("string"), F.lit("")), 1)
                .otherwise(0)).alias(f"_chg_{c}") for c in cols])


def scd6_propagate(dim: DataFrame, key: str, cols: Sequence[str], src: DataFrame | None = None,
                   before: DataFrame | None = None, stage: bool = True) -> DataFrame:
    """Type 6 (E6): find which listed columns changed anywhere between the source and the
    current rows (NULL = ''), then copy the open row's value of only those columns onto
    every closed row of the key. Without `src` every listed column is propagated."""
    cols = list(cols)
    if src is not None and before is not None:
        flags = _type6_flags(before, src, key, cols)
    else:
        flags = dim.limit(0).agg(*[F.lit(1).alias(f"_chg_{c}") for c in cols])
    opened = F.lit(OPEN_DATE)
    # The open row's value, NULL included, for keys that have an open row; with several open rows
    # (a Q32 violation) the largest value is taken. Partial aggregates and a join instead of a
    # window over each key's whole history; the dimension is staged because both sides read it.
    if stage:
        from tidemark.sources.sinks import cut_lineage
        dim = cut_lineage(dim)
    curr = dim.filter(F.col("DISC_DT") == opened).groupBy(F.col(key).alias("_k")).agg(
        F.lit(True).alias("_has_open"), *[F.max(c).alias(f"o__{c}") for c in cols])
    j = attach_scalar(dim.join(curr, dim[key] == curr["_k"], "left"), flags)
    out = []
    for c in dim.columns:
        if c in cols:
            take = (F.col(f"_chg_{c}") == 1) & (F.col("DISC_DT") != opened) & F.coalesce("_has_open", F.lit(False))
            out.append(F.when(take, F.col(f"o__{c}")).otherwise(F.col(c)).alias(c))
        else:
            out.append(F.col(c))
    return j.select(*out)


def scd2_from_history(daily: DataFrame, key: str, day: str, scd2_hash: str,
                      keep: Sequence[str], skew_safe: bool | str = False) -> DataFrame:
    """Full history build in one pass.

    `daily` has at most one row per (key, day) (collapse intra-day changes first).
    A version starts on a day whose SCD2 hash differs from the previous day's; the
    version's attributes come from its last day (type-1 columns overwritten in place);
    DISC_DT is the next version's EFF_DT - 1, open versions end 9999-12-31.

    A version is a contiguous run of days, so no aggregation is needed: on the last
    day of each run, the run's start is the running max of change days and the next
    version starts on the next day. Every window shares one partitioning and one sort
    on (key, day).

    A key's rows in the windows are bounded by its days. skew_safe=True is for orders finer than a
    day: the same values come from `windows.neighbours` and `windows.running` (range sort and
    prefix scan), so no task takes a whole key; 'auto' does so if a key is measured to have more
    than `windows.HOT_ROWS` rows."""
    if skew_safe == "auto":
        from tidemark.operators.windows import any_hot
        daily = daily.transform(_staged)
        skew_safe = any_hot(daily, [key])
    if skew_safe:
        return _history_scan(daily, key, day, scd2_hash, keep)
    w = Window.partitionBy(key).orderBy(day)
    marked = daily.select(
        "*", F.coalesce(F.col(scd2_hash) != F.lag(scd2_hash).over(w), F.lit(True)).alias("_chg"))
    runs = marked.select(
        "*",
        F.max(F.when(F.col("_chg"), F.col(day))).over(w).alias("_start"),
        F.sum(F.col("_chg").cast("int")).over(w).alias("_ver"),
        F.lead("_chg").over(w).alias("_next_chg"),
        F.lead(day).over(w).alias("_next_day"))
    last = runs.filter(F.coalesce(F.col("_next_chg"), F.lit(True)))
    disc = F.coalesce(F.date_sub(F.col("_next_day"), 1), F.lit(OPEN_DATE))
    return last.select(key, *keep, F.col("_start").alias("EFF_DT"), disc.alias("DISC_DT"),
                       F.col("_ver").cast("int").alias("VERSION_NUM"))


def _staged(df: DataFrame) -> DataFrame:
    from tidemark.sources.sinks import cut_lineage
    return cut_lineage(df)


def _history_scan(daily: DataFrame, key: str, day: str, scd2_hash: str, keep: Sequence[str]) -> DataFrame:
    """`scd2_from_history` without a window over a key."""
    from tidemark.operators.windows import neighbours, running
    rows = daily.select(key, F.col(day).alias("_day"), F.col(scd2_hash).alias("_h2"), F.lit(1).alias("_one"),
                        F.struct(*keep).alias("_keep"))
    near = neighbours(rows, [key], ["_day"], ["_day", "_h2", "_one"])
    changed = F.coalesce(F.col("_h2") != F.col("PREV__h2"), F.lit(True))
    ends = F.col("NEXT__one").isNull() | F.coalesce(F.col("NEXT__h2") != F.col("_h2"), F.lit(True))
    run = running(near.select(key, "_day", "_keep", "NEXT__day", changed.alias("_chg"), ends.alias("_end")), [key], ["_day"],
                  {"_start": ("max", F.when(F.col("_chg"), F.col("_day"))), "_ver": ("sum", F.col("_chg").cast("int"))})
    disc = F.coalesce(F.date_sub(F.col("NEXT__day"), 1), F.lit(OPEN_DATE))
    return run.filter("_end").select(key, *[F.col(f"_keep.`{c}`").alias(c) for c in keep], F.col("_start").alias("EFF_DT"),
                                     disc.alias("DISC_DT"), F.col("_ver").cast("int").alias("VERSION_NUM"))


def backfill_dim(history: DataFrame, lookup: DataFrame | None, key: str, lookup_key: str,
                 columns: Sequence[tuple], spec, exclude_ids: Sequence = ()) -> DataFrame:
    """One-off history migration into a dimension.

    `history` already carries EFF_DT / DISC_DT per version; the lookup enriches it (LEFT
    JOIN on key = lookup_key, optionally leaving `exclude_ids` unenriched), `columns`
    renames / casts / truncates (see functions.expr.project), then the surrogate key
    (key, EFF_DT), the SCD1 / SCD2 / full hashes from `spec` are added, the source
    validity dates are kept and OPERATION_TYPE is 'HISTORICAL'."""
    from tidemark.functions.expr import project
    from tidemark.functions.hashing import hash_full, hash_scd1, hash_scd2, surrogate_key

    src = history
    if lookup is not None:
        lk = lookup
        if exclude_ids:
            lk = lk.filter(~F.col(lookup_key).isin(list(exclude_ids)))
        src = src.join(lk, src[key] == lk[lookup_key], "left")
    shaped = project(src, list(columns) + [("EFF_DT", "EFF_DT", None, None), ("DISC_DT", "DISC_DT", None, None)])
    return shaped.select(
        surrogate_key(key, "EFF_DT").alias(f"{key}_SK"), "*",
        (F.col("DISC_DT") == F.lit(OPEN_DATE)).alias("IS_CURRENT"),
        hash_scd2(spec).alias("HASH_SCD2"), hash_scd1(spec).alias("HASH_SCD1"), hash_full(spec).alias("HASH_FULL"),
        F.lit("HISTORICAL").alias("OPERATION_TYPE"))
