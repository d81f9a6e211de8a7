"""Sinks: staged overwrite, schema evolution, contracts, run audit and event log.

Parquet tables cannot be overwritten while being read, so a new version of a table is
written to a fresh directory and then published by appending to the table's versions log
(`write_staged`); all of it goes through Spark jobs, so it works on the cluster's shared
file system. A failed or lost executor only retries tasks of the write job; readers
never see a half-written table.
"""

from __future__ import annotations

import datetime as _dt
import uuid
from collections.abc import Sequence
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemark.functions.literals import lit
from tidemark.session import checkpoint_dir
from tidemark.sources import commits
from tidemark.sources.commits import BUCKET_COL, with_bucket  # noqa: F401 - part of this module's interface


VERSIONS = "_versions"
VERSION_LOG = "path string, published_at timestamp_ntz, stream string, epoch bigint"


def _join(root: str, *parts: str) -> str:
    return "/".join([root.rstrip("/"), *parts])


def write_staged(df: DataFrame, table_dir: str, partition_by: Sequence[str] = (),
                 mode: str = "overwrite", stream: str | None = None, epoch: int | None = None) -> str:
    """Full rebuild sink (A4): write the new version to `<table_dir>/v-<time>-<uuid>`, then
    publish it by appending one row to the table's `_versions` log. Both steps are Spark
    jobs, so this works on any file system the cluster uses; each job's commit makes its
    files appear whole, so readers see either the previous or the new version, never a
    half-written one. `stream` and `epoch` name the micro-batch that the version holds
    (`last_epoch` reads them). Returns the new version's path."""
    spark = df.sparkSession
    stamp = _dt.datetime.now(_dt.timezone.utc).replace(tzinfo=None)
    version = _join(table_dir, f"v-{stamp.strftime('%Y%m%d%H%M%S%f')}-{uuid.uuid4().hex[:12]}")
    w = df.write.mode(mode)
    if partition_by:
        w = w.partitionBy(*partition_by)
    w.parquet(version)
    (spark.createDataFrame([(version, stamp, stream, epoch)], VERSION_LOG)
     .write.mode("append").parquet(_join(table_dir, VERSIONS)))
    return version


def _try_read(spark: SparkSession, path: str, schema=None) -> DataFrame | None:
    from pyspark.errors import AnalysisException
    try:
        reader = spark.read.schema(schema) if schema is not None else spark.read
        return reader.parquet(path)
    except AnalysisException:            # the path does not exist (yet)
        return None


def read_current(spark: SparkSession, table_dir: str) -> DataFrame | None:
    """The latest published version of a table written by `write_staged` (None if none)."""
    log = _try_read(spark, _join(table_dir, VERSIONS), VERSION_LOG)
    if log is None:
        return None
    latest = log.orderBy(F.col("published_at").desc(), F.col("path").desc()).limit(1).collect()
    return spark.read.parquet(latest[0]["path"]) if latest else None


def last_epoch(spark: SparkSession, table_dir: str, stream: str) -> int | None:
    """The last micro-batch of `stream` that was published to the table (None: none)."""
    log = _try_read(spark, _join(table_dir, VERSIONS), VERSION_LOG)
    return None if log is None else log.filter(F.col("stream") == stream).agg(F.max("epoch")).first()[0]


def _files(spark: SparkSession, path: str):
    """Hadoop file system and path: works on whatever store the path names."""
    p = spark._jvm.org.apache.hadoop.fs.Path(path)
    return p.getFileSystem(spark._jsc.hadoopConfiguration()), p


def remove_staged(spark: SparkSession, older_than: _dt.timedelta = _dt.timedelta(days=1)) -> int:
    """Delete tables that `cut_lineage` left under `<checkpoint>/tables` longer ago than
    `older_than` (choose more than the longest run that may still read them). Their number."""
    fs, root = _files(spark, _join(checkpoint_dir(spark), "tables"))
    if not fs.exists(root):
        return 0
    limit = _dt.datetime.now().timestamp() - older_than.total_seconds()
    old = [s.getPath() for s in fs.listStatus(root) if s.getModificationTime() / 1000 < limit]
    for p in old:
        fs.delete(p, True)
    return len(old)


def vacuum(spark: SparkSession, table_dir: str, keep: int = 2) -> int:
    """Delete the data of all versions of a `write_staged` table but the `keep` published last,
    and of versions that were never published before those. The versions log stays whole, as
    one small row per version. The number of versions deleted."""
    log = _try_read(spark, _join(table_dir, VERSIONS), VERSION_LOG)
    if log is None or keep < 1:
        return 0
    last = [r["path"].rstrip("/").rsplit("/", 1)[1] for r in
            log.filter("path IS NOT NULL").orderBy(F.col("published_at").desc(), F.col("path").desc()).limit(keep).collect()]
    fs, root = _files(spark, table_dir)
    gone = [s.getPath() for s in fs.listStatus(root)
            if s.getPath().getName().startswith("v-") and s.getPath().getName() < min(last) and s.getPath().getName() not in last]
    for p in gone:
        fs.delete(p, True)
    return len(gone)


def table_path_exists(spark: SparkSession, path: str) -> bool:
    """Whether a Parquet table exists at `path`, asked through Spark (any file system)."""
    return _try_read(spark, path) is not None


def cut_lineage(df: DataFrame) -> DataFrame:
    """Materialise `df` as a Parquet table in the shared folder named by
    spark.checkpoint.dir and read it back: the lineage is cut (a lost executor re-reads
    files instead of recomputing the plan), the copy is columnar and compressed, and the
    planner sees its real size, so a small staged input is broadcast without guessing."""
    spark = df.sparkSession
    path = _join(checkpoint_dir(spark), "tables", f"t-{uuid.uuid4().hex}")
    df.write.mode("errorifexists").parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def conform(target: DataFrame, source: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Append-new-columns schema evolution (A9): the target gains the source's new
    columns (NULL), the source gains the target's missing ones, and shared columns are
    widened to the common type that Spark's own union resolves, so no value is narrowed
    (string meets string: anything else is turned into its text). Types without a common
    one fail. Returns (target, source) with identical schemas."""
    tt, st = dict(target.dtypes), dict(source.dtypes)
    text = [c for c in tt if c in st and tt[c] != st[c] and "string" in (tt[c], st[c])]
    target = target.withColumns({c: F.col(c).cast("string") for c in text})
    source = source.withColumns({c: F.col(c).cast("string") for c in text})
    common = target.limit(0).unionByName(source.limit(0), allowMissingColumns=True).schema

    def shaped(df):
        return df.select(*[(F.col(f.name) if f.name in df.columns else F.lit(None)).cast(f.dataType).alias(f.name)
                           for f in common.fields])

    return shaped(target), shaped(source)


def evolve(target: DataFrame, source: DataFrame, on_schema_change: str) -> tuple[DataFrame, DataFrame, list[str]]:
    """What a merge does about columns and types that differ (A9): (target, source, columns that the
    source lacks).

    'append_new_columns': both sides get all columns and the wider type of each (`conform`).
    'fail': a new source column or another type raises. 'ignore': new source columns are left out."""
    source = source.drop("_action")
    have, come = dict(target.dtypes), dict(source.dtypes)
    new = [c for c in come if c not in have and not c.startswith("_action")]
    other = [c for c in come if c in have and c != "_action" and come[c] != have[c]]
    missing = [c for c in have if c not in come and c != "_action"]
    if on_schema_change not in ("append_new_columns", "fail", "ignore"):
        raise ValueError(f"unknown on_schema_change {on_schema_change!r}")
    if on_schema_change == "fail" and (new or other):
        raise ValueError(f"schema change: new columns {new}, other types {other}")
    if on_schema_change == "append_new_columns" and (new or other or missing):
        target, source = conform(target, source)
    return target, source, missing


def contract_breaches(df: DataFrame, schema: T.StructType) -> list[tuple[str, str, str, str]]:
    """(column, breach, declared, found) of every missing column, extra column, different type,
    and column whose place among the shared ones differs. From the schema alone, no job."""
    declared = {f.name: f.dataType.simpleString() for f in schema.fields}
    found = dict(df.dtypes)
    out = [(c, "missing", t, "-") for c, t in declared.items() if c not in found]
    out += [(c, "extra", "-", t) for c, t in found.items() if c not in declared]
    out += [(c, "type", t, found[c]) for c, t in declared.items() if c in found and found[c] != t]
    want, have = [c for c in declared if c in found], [c for c in df.columns if c in declared]
    out += [(c, "order", str(want.index(c)), str(have.index(c))) for c in want if want.index(c) != have.index(c)]
    return out


def contract_violations(df: DataFrame, schema: T.StructType) -> DataFrame:
    """All breaches of a contract as rows (column, breach, declared, found, n): those of the schema,
    and per non-nullable column the number of NULLs (breach `null`, only if there are any)."""
    rows = [(*b, None) for b in contract_breaches(df, schema)]
    kind = "column string, breach string, declared string, found string, n bigint"
    listed = df.sparkSession.createDataFrame(rows, kind)
    req = [f.name for f in schema.fields if not f.nullable and f.name in df.columns]
    if not req:
        return listed
    counts = df.agg(*[F.count(F.when(F.col(f"`{c}`").isNull(), 1)).alias(c) for c in req])
    nulls = counts.select(F.explode(F.array(*[F.struct(F.lit(c).alias("column"), F.col(f"`{c}`").alias("n"))
                                              for c in req])).alias("x")).select(
        "x.column", F.lit("null").alias("breach"), F.lit("not null").alias("declared"), F.lit("null").alias("found"),
        "x.n").filter("n > 0")
    return listed.unionByName(nulls)


def enforce_contract(df: DataFrame, schema: T.StructType) -> tuple[DataFrame, DataFrame]:
    """Enforce a declared contract (A10): names, order and types must be as declared (any
    breach fails, naming all of them), plus a one-row count of NULLs in every non-nullable
    column. `contract_breaches` lists the breaches without failing."""
    breaches = contract_breaches(df, schema)
    if breaches:
        raise ValueError("contract: " + "; ".join(f"{b}: {c} (declared {e}, found {f})" for c, b, e, f in breaches))
    shaped = df.select(*[F.col(f.name).cast(f.dataType).alias(f.name) for f in schema.fields])
    req = [f.name for f in schema.fields if not f.nullable]
    counts = shaped.agg(*[F.count(F.when(F.col(c).isNull(), 1)).cast("bigint").alias(c) for c in req]) \
        if req else shaped.limit(0).agg(F.lit(0).alias("none"))
    return shaped, counts


# The run-audit table's columns and types, in the reference's order
# (bare NUMBER = DECIMAL(38,0)).
AUDIT_SCHEMA = T.StructType([
    T.StructField("model_execution_id", T.StringType()),
    T.StructField("unique_id", T.StringType()),
    T.StructField("invocation_id", T.StringType()),
    T.StructField("generated_at", T.TimestampNTZType()),
    T.StructField("created_at", T.TimestampNTZType()),
    T.StructField("name", T.StringType()),
    T.StructField("message", T.StringType()),
    T.StructField("status", T.StringType()),
    T.StructField("resource_type", T.StringType()),
    T.StructField("execution_time", T.DoubleType()),
    T.StructField("execute_started_at", T.TimestampNTZType()),
    T.StructField("execute_completed_at", T.TimestampNTZType()),
    T.StructField("compile_started_at", T.TimestampNTZType()),
    T.StructField("compile_completed_at", T.TimestampNTZType()),
    T.StructField("rows_affected", T.DecimalType(38, 0)),
    T.StructField("rows_inserted", T.DecimalType(38, 0)),
    T.StructField("rows_updated", T.DecimalType(38, 0)),
    T.StructField("rows_deleted", T.DecimalType(38, 0)),
    T.StructField("full_refresh", T.BooleanType()),
    T.StructField("compiled_code", T.StringType()),
    T.StructField("failures", T.DecimalType(38, 0)),
    T.StructField("query_id", T.StringType()),
    T.StructField("thread_id", T.StringType()),
    T.StructField("materialization", T.StringType()),
    T.StructField("adapter_response", T.StringType()),
])


def append_run_audit(audit: DataFrame, rows: DataFrame, as_of: _dt.datetime, keep_days: int = 60) -> DataFrame:
    """Run audit (A12): drop existing rows created before as_of - keep_days (a timestamp
    comparison, not a date one), then append the new rows. As in the reference, the
    clean-up runs before the insert, so the new rows are always kept."""
    cutoff = lit(as_of).cast("timestamp_ntz") - F.expr(f"INTERVAL {int(keep_days)} DAYS")
    kept = audit.filter(F.col("created_at") >= cutoff)
    return kept.unionByName(rows.select(*audit.columns))


def audit_row(merged: DataFrame, name: str, invocation_id: str, started: _dt.datetime, completed: _dt.datetime,
              status: str = "success", message: str | None = None, full_refresh: bool = False,
              materialization: str = "incremental", resource_type: str = "model") -> DataFrame:
    """The audit row of a finished step (A12): identity, status and timings, and the DML counts of
    the merge result (`merge_counts`). A failed step has no counts."""
    from tidemark.operators.merge import merge_counts
    return _audit_row(merge_counts(merged) if status == "success" else _no_counts(merged.sparkSession), name, invocation_id,
                      started, completed, status, message, full_refresh, materialization, resource_type)


COUNTS = "rows_inserted bigint, rows_updated bigint, rows_deleted bigint"


def _no_counts(spark: SparkSession) -> DataFrame:
    return spark.createDataFrame([(None, None, None)], COUNTS)


def run_step(spark: SparkSession, audit_dir: str, step, name: str, invocation_id: str, **kw):
    """Run `step()` and append its audit row (A12) to the table at `audit_dir`, whatever happens: status
    'success' with the DML counts that the step's commit observed while writing (`commits.rewrite`
    returns them; a step that returns None changed nothing), or 'error' with the message, and then
    the exception goes on. Returns what the step returned."""
    now = lambda: _dt.datetime.now(_dt.timezone.utc).replace(tzinfo=None)
    started, result, failure = now(), None, None
    try:
        result = step()
    except Exception as e:  # noqa: BLE001 - recorded, then raised again
        failure = e
    found = (result or {}).get("counts", {}) if isinstance(result, dict) or result is None else {}
    counts = _no_counts(spark) if failure else spark.createDataFrame(
        [tuple(found.get(c, 0) for c in ("rows_inserted", "rows_updated", "rows_deleted"))], COUNTS)
    row = _audit_row(counts, name, invocation_id, started, now(), "error" if failure else "success",
                     None if failure is None else str(failure)[:2000], **kw)
    row.write.mode("append").parquet(audit_dir)
    if failure is not None:
        raise failure
    return result


def _audit_row(n: DataFrame, name: str, invocation_id: str, started: _dt.datetime, completed: _dt.datetime, status: str,
               message: str | None = None, full_refresh: bool = False, materialization: str = "incremental",
               resource_type: str = "model") -> DataFrame:
    stamp = lambda t: lit(t).cast("timestamp_ntz")
    known = {
        "model_execution_id": F.md5(F.lit(f"{name}|{invocation_id}")), "unique_id": F.lit(f"{resource_type}.{name}"),
        "invocation_id": F.lit(invocation_id), "generated_at": stamp(completed), "created_at": stamp(completed),
        "name": F.lit(name), "message": F.lit(message), "status": F.lit(status), "resource_type": F.lit(resource_type),
        "execution_time": F.lit((completed - started).total_seconds()), "execute_started_at": stamp(started),
        "execute_completed_at": stamp(completed), "full_refresh": F.lit(full_refresh),
        "rows_affected": F.col("rows_inserted") + F.col("rows_updated") + F.col("rows_deleted"),
        "rows_inserted": F.col("rows_inserted"), "rows_updated": F.col("rows_updated"),
        "rows_deleted": F.col("rows_deleted"), "failures": F.lit(0 if status == "success" else 1),
        "materialization": F.lit(materialization),
    }
    return n.select(*[known.get(f.name, F.lit(None)).cast(f.dataType).alias(f.name) for f in AUDIT_SCHEMA.fields])


# The event-log columns and the four event kinds written around a run.
EVENT_SCHEMA = T.StructType([
    T.StructField("event_name", T.StringType()), T.StructField("event_timestamp", T.TimestampNTZType()),
    T.StructField("event_schema", T.StringType()), T.StructField("event_model", T.StringType()),
    T.StructField("event_user", T.StringType()), T.StructField("event_target", T.StringType()),
    T.StructField("event_is_full_refresh", T.BooleanType()), T.StructField("invocation_id", T.StringType()),
    T.StructField("query_id", T.StringType()),
])

EVENT_KINDS = ("run started", "run completed", "model deployment started", "model deployment completed")


def log_event(log: DataFrame, spark: SparkSession, name: str, ts: _dt.datetime, schema: str = None,
              model: str = None, user: str = None, target: str = None, full_refresh: bool = False,
              invocation_id: str = None, query_id: str = None) -> DataFrame:
    """Event log append (A14): one row per event. A log table missing some of these
    columns is widened first (`conform`), like the reference's create-or-alter step."""
    row = spark.createDataFrame([(name, ts, schema, model, user, target, bool(full_refresh), invocation_id,
                                  query_id)], EVENT_SCHEMA)
    log, row = conform(log, row)
    return log.unionByName(row)


def union_all(frames: Sequence[DataFrame]) -> DataFrame:
    return reduce(lambda a, b: a.unionByName(b), frames)


def write_bucketed(df: DataFrame, table_dir: str, key, buckets: int, **kw) -> None:
    """Initial write of a table stored by key bucket, as one commit (`commits.create`)."""
    commits.create(df, table_dir, key, buckets, **kw)


def read_bucketed(spark: SparkSession, table_dir: str, **kw) -> DataFrame | None:
    """The table as its newest commit left it; `version=` or `as_of=` read an older one."""
    return commits.read(spark, table_dir, **kw)


def rewrite_buckets(spark: SparkSession, table_dir: str, source: DataFrame, key, buckets: int, merge_fn,
                    extra_keys: DataFrame | None = None, pre=None, **kw) -> dict | None:
    """Apply `merge_fn(current_rows, staged_source) -> new_rows` to the buckets a batch touches, in one
    commit (`commits.rewrite`): untouched buckets are neither read nor rewritten, and readers see
    the old table or the new one, never a mixture."""
    return commits.rewrite(spark, table_dir, source, merge_fn, key, buckets, extra_keys, pre, **kw)


def upsert_bucketed(spark: SparkSession, table_dir: str, source: DataFrame, key, buckets: int,
                    extra_keys: DataFrame | None = None, pre=None, stream: str | None = None,
                    epoch: int | None = None, **merge_kw) -> dict | None:
    """Hash-gated upsert (`merge_upsert`) that rewrites only the touched key buckets."""
    from tidemark.operators.merge import merge_upsert
    return rewrite_buckets(spark, table_dir, source, key, buckets,
                           lambda cur, src: merge_upsert(cur, src, key, **merge_kw), extra_keys, pre,
                           stream=stream, epoch=epoch)


def scd_merge_bucketed(spark: SparkSession, table_dir: str, source: DataFrame, key: str, buckets: int,
                       as_of, batch: int, type6: Sequence[str] = (), **scd_kw) -> dict | None:
    """SCD 1/2/6 merge (`scd_merge`) that rewrites only the touched key buckets. Type 6 decides its
    columns from the batch, whose keys all lie in touched buckets; the open rows' values of these
    columns are copied there and in the buckets whose version entry says that closed rows differ
    from open ones (all buckets for a column whose divergence is not kept yet). In all others
    the copies would change nothing."""
    from tidemark.operators.scd import scd6_changed, scd6_propagate, scd_merge

    def also(current, staged, entry):
        changed = scd6_changed(current, staged, key, type6)
        marked = [int(b) for b, held in entry["buckets"].items()
                  if any(held.get("diverged", {}).get(c, True) for c in changed)]
        return (marked, lambda rows: scd6_propagate(rows, key, changed)) if changed else ((), None)

    return rewrite_buckets(spark, table_dir, source, key, buckets,
                           lambda cur, src: scd_merge(cur, src, key, as_of, batch, **scd_kw),
                           also=also if type6 else None, diverge=type6)
