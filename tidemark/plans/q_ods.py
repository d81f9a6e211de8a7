"""Registered queries: bronze ODS loads.

CDC kind: the first load resolves the log up to CDC_FIRST_LOAD (history path); the
second run tombstones renamed keys, takes the log from the target's watermark minus
3 minutes, resolves it, hashes it and upserts it gated by HASH_CHANGE.
Snapshot kind: staging loads are purged of content copies, the first load takes the
loads before 2001, the second run takes the delta, dedups, merges and marks keys
absent from the latest load as deleted.
"""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.functions.literals import lit
from tidemark.functions.expr import trim_string
from tidemark.functions.hashing import hash_change, hash_full, surrogate_key
from tidemark.operators.dedup import cdc_resolve, latest_per_key, purge_duplicates
from tidemark.operators.delta import delta, watermark_value
from tidemark.operators.merge import (ACTION, delete_insert, drop_action, mark_deleted, merge_counts,
                                      merge_upsert, tombstone_renamed)
from tidemark.operators.ods import OdsLoad, load_ods
from tidemark.plans import sqlgen as Q
from tidemark.plans import standins as S
from tidemark.plans.registry import query
from tidemark.sources.sinks import audit_row, cut_lineage
from tidemark.sources.tables import load
from tidemark.spec import TableSpec

CDC_HIST_BATCH = 20240122000000000

# The audit and lineage column names of an ODS table.
CDC_SPEC = TableSpec(
    columns=("ODS_PK", "ODS_COMPOSITE_KEY", "USER_KEY", "EVENT_TYPE", "AMOUNT", "SRC_CREATE_DTM",
             "SRC_LAST_UPDATE_DTM", "SRC_ACTION_CD", "SRC_DEL_IND", "ODS_INS_BATCH_ID", "ODS_UPD_BATCH_ID",
             "ODS_INSERT_TIMESTAMP", "ODS_UPDATE_TIMESTAMP", "OPERATION_TYPE"),
    natural_keys=("USER_KEY", "ODS_COMPOSITE_KEY"),
    audit=("SRC_CREATE_DTM", "SRC_LAST_UPDATE_DTM", "ODS_INS_BATCH_ID", "ODS_UPD_BATCH_ID",
           "ODS_INSERT_TIMESTAMP", "ODS_UPDATE_TIMESTAMP", "OPERATION_TYPE"),
)
CDC_COLS = list(CDC_SPEC.columns) + ["HASH_CHANGE", "HASH_FULL"]
CDC_NO_UPDATE = ["ODS_INS_BATCH_ID", "ODS_INSERT_TIMESTAMP", "SRC_CREATE_DTM"]


# ----------------------------------------------------------------------------- CDC, Spark

def _cdc_key(c):
    return surrogate_key(trim_string(F.col(c).cast("string")))


def ods_transform(resolved: DataFrame, batch: int, run_ts: dt.datetime) -> DataFrame:
    deleted = F.trim(F.col("CAPTURE_ACTION")) == F.lit("D")
    ts = lit(run_ts)
    shaped = resolved.select(
        _cdc_key("USER_KEY").alias("ODS_PK"),
        F.substring(trim_string(F.col("USER_KEY").cast("string")), 1, 50).alias("ODS_COMPOSITE_KEY"),
        "USER_KEY", trim_string("EVENT_TYPE").alias("EVENT_TYPE"), "AMOUNT",
        F.col("CAPTURE_TS").alias("SRC_CREATE_DTM"), F.col("CAPTURE_TS").alias("SRC_LAST_UPDATE_DTM"),
        F.trim(F.col("CAPTURE_ACTION")).alias("SRC_ACTION_CD"),
        F.when(deleted, F.lit("Y")).otherwise(F.lit("N")).alias("SRC_DEL_IND"),
        F.lit(batch).cast("bigint").alias("ODS_INS_BATCH_ID"), F.lit(batch).cast("bigint").alias("ODS_UPD_BATCH_ID"),
        ts.alias("ODS_INSERT_TIMESTAMP"), ts.alias("ODS_UPDATE_TIMESTAMP"),
        F.when(deleted, F.lit("DELETE")).otherwise(F.lit("INSERT")).alias("OPERATION_TYPE"))
    return shaped.select("*", hash_change(CDC_SPEC).alias("HASH_CHANGE"), hash_full(CDC_SPEC).alias("HASH_FULL"))


def _resolve(log, mark, keyed=True):
    return cdc_resolve(log, "USER_KEY", "BEFORE_KEY", "CAPTURE_TS", "LOG_ID",
                       F.col("PRIMARY_KEY_CHANGE") == F.lit("Y"), mark=mark, keyed=keyed)


def cdc_history_ods(spark, sf) -> DataFrame:
    log = S.cdc_log(spark, sf).filter(F.col("CAPTURE_TS") < lit(S.CDC_FIRST_LOAD))
    return ods_transform(_resolve(log, None), CDC_HIST_BATCH, S.CDC_FIRST_LOAD)


def cdc_mark(ods0: DataFrame):
    return watermark_value(ods0, "SRC_LAST_UPDATE_DTM", overlap_minutes=3)


def _renamed(log: DataFrame) -> DataFrame:
    return log.filter(F.col("PRIMARY_KEY_CHANGE") == "Y").select(_cdc_key("BEFORE_KEY").alias("ODS_PK"))


def cdc_tombstoned(spark, sf, ods0, mark) -> DataFrame:
    log = S.cdc_log(spark, sf).filter(F.col("CAPTURE_TS") >= lit(mark))
    return tombstone_renamed(ods0, _renamed(log), "ODS_PK", S.CDC_RUN, S.CDC_BATCH)


CDC_LOAD = OdsLoad(key="ODS_PK", resolve=lambda rows: _resolve(rows, None), shape=ods_transform,
                   source_ts="CAPTURE_TS", target_ts="SRC_LAST_UPDATE_DTM", no_update=CDC_NO_UPDATE,
                   renamed_keys=_renamed)


def cdc_second_run(spark, sf) -> DataFrame:
    """The stored first load, then the second run through `load_ods`."""
    return load_ods(CDC_LOAD, S.cdc_log(spark, sf), cut_lineage(cdc_history_ods(spark, sf)), S.CDC_BATCH, S.CDC_RUN)


# ----------------------------------------------------------------------------- CDC, SQL

def _sql_resolve(name: str, where: str, keyed: bool = True) -> str:
    if keyed:
        cond = "c.BEFORE_KEY = d.USER_KEY AND (c.LOG_ID >= d.LOG_ID OR d.LOG_ID IS NULL)"
        body = (f"SELECT d.* FROM {name}_dd d WHERE d.USER_KEY IS NOT NULL AND NOT EXISTS ("
                f"SELECT 1 FROM {name}_src c WHERE c.PRIMARY_KEY_CHANGE = 'Y' AND {cond})")
    else:
        body = (f"SELECT d.* FROM {name}_dd d WHERE d.USER_KEY IS NOT NULL AND d.USER_KEY NOT IN ("
                f"SELECT c.BEFORE_KEY FROM {name}_src c WHERE c.PRIMARY_KEY_CHANGE = 'Y' AND c.BEFORE_KEY IS NOT NULL AND ("
                f"c.LOG_ID >= (SELECT min(LOG_ID) FROM {name}_dd WHERE USER_KEY IS NOT NULL)"
                f" OR (SELECT count(*) - count(LOG_ID) FROM {name}_dd WHERE USER_KEY IS NOT NULL) > 0"
                f" OR (SELECT count(*) FROM {name}_dd WHERE USER_KEY IS NOT NULL) = 0))")
    return f"""{name}_src AS (SELECT * FROM cdc_log {where}),
{name}_dd AS (
  SELECT * FROM {name}_src
  QUALIFY row_number() OVER (PARTITION BY USER_KEY ORDER BY CAPTURE_TS DESC NULLS FIRST, LOG_ID DESC NULLS FIRST) = 1
),
{name} AS ({body})"""


def _sql_transform(name: str, src: str, batch: int, run_ts: dt.datetime) -> str:
    ts = f"TIMESTAMP '{run_ts.isoformat(sep=' ')}'"
    key = Q.trim_string("CAST(USER_KEY AS VARCHAR)")
    chg = Q.md5_concat(CDC_SPEC.change_columns(), "|")
    full = Q.md5_concat(CDC_SPEC.full_columns(), "|")
    return f"""{name}_x AS (
  SELECT md5(coalesce(CAST({key} AS VARCHAR), '')) AS ODS_PK,
         substr({key}, 1, 50) AS ODS_COMPOSITE_KEY, USER_KEY,
         {Q.trim_string('EVENT_TYPE')} AS EVENT_TYPE, AMOUNT,
         CAPTURE_TS AS SRC_CREATE_DTM, CAPTURE_TS AS SRC_LAST_UPDATE_DTM,
         trim(CAPTURE_ACTION) AS SRC_ACTION_CD,
         CASE WHEN trim(CAPTURE_ACTION) = 'D' THEN 'Y' ELSE 'N' END AS SRC_DEL_IND,
         CAST({batch} AS BIGINT) AS ODS_INS_BATCH_ID, CAST({batch} AS BIGINT) AS ODS_UPD_BATCH_ID,
         {ts} AS ODS_INSERT_TIMESTAMP, {ts} AS ODS_UPDATE_TIMESTAMP,
         CASE WHEN trim(CAPTURE_ACTION) = 'D' THEN 'DELETE' ELSE 'INSERT' END AS OPERATION_TYPE
  FROM {src}
),
{name} AS (SELECT *, {chg} AS HASH_CHANGE, {full} AS HASH_FULL FROM {name}_x)"""


SQL_CDC_BASE = f"""WITH {S.SQL_CDC_LOG},
{_sql_resolve("hist", f"WHERE CAPTURE_TS < TIMESTAMP '{S.CDC_FIRST_LOAD.isoformat(sep=' ')}'")},
{_sql_transform("ods0", "hist", CDC_HIST_BATCH, S.CDC_FIRST_LOAD)},
mark AS (SELECT coalesce(max(SRC_LAST_UPDATE_DTM) - INTERVAL 3 MINUTE, TIMESTAMP '1900-01-01') AS m FROM ods0)"""

_RUN_TS = f"TIMESTAMP '{S.CDC_RUN.isoformat(sep=' ')}'"
_BEFORE_PK = f"md5(coalesce(CAST({Q.trim_string('CAST(BEFORE_KEY AS VARCHAR)')} AS VARCHAR), ''))"

SQL_TOMB = f"""renamed AS (
  SELECT DISTINCT {_BEFORE_PK} AS ODS_PK FROM cdc_log
  WHERE PRIMARY_KEY_CHANGE = 'Y' AND CAPTURE_TS >= (SELECT m FROM mark)
),
tomb AS (
  SELECT o.ODS_PK, o.ODS_COMPOSITE_KEY, o.USER_KEY, o.EVENT_TYPE, o.AMOUNT, o.SRC_CREATE_DTM, o.SRC_LAST_UPDATE_DTM,
         CASE WHEN r.ODS_PK IS NOT NULL THEN 'D' ELSE o.SRC_ACTION_CD END AS SRC_ACTION_CD,
         CASE WHEN r.ODS_PK IS NOT NULL THEN 'Y' ELSE o.SRC_DEL_IND END AS SRC_DEL_IND,
         o.ODS_INS_BATCH_ID,
         CASE WHEN r.ODS_PK IS NOT NULL THEN CAST({S.CDC_BATCH} AS BIGINT) ELSE o.ODS_UPD_BATCH_ID END AS ODS_UPD_BATCH_ID,
         o.ODS_INSERT_TIMESTAMP,
         CASE WHEN r.ODS_PK IS NOT NULL THEN {_RUN_TS} ELSE o.ODS_UPDATE_TIMESTAMP END AS ODS_UPDATE_TIMESTAMP,
         CASE WHEN r.ODS_PK IS NOT NULL THEN 'DELETE' ELSE o.OPERATION_TYPE END AS OPERATION_TYPE,
         o.HASH_CHANGE, o.HASH_FULL,
         CASE WHEN r.ODS_PK IS NOT NULL THEN 'delete' ELSE 'unchanged' END AS MERGE_ACTION
  FROM ods0 o LEFT JOIN renamed r ON o.ODS_PK = r.ODS_PK
)"""

SQL_CDC_RUN = f"""{SQL_CDC_BASE},
{SQL_TOMB},
{_sql_resolve("res", "WHERE CAPTURE_TS >= (SELECT m FROM mark)")},
{_sql_transform("delta_ods", "res", S.CDC_BATCH, S.CDC_RUN)},
tgt AS (SELECT * EXCLUDE (MERGE_ACTION) FROM tomb),
upserted AS (
{Q.upsert("tgt", "delta_ods", CDC_COLS, "ODS_PK", CDC_NO_UPDATE)}
)"""


@query("cdc_resolve", headline=True, sql=f"""{SQL_CDC_BASE},
{_sql_resolve("res", "WHERE CAPTURE_TS >= (SELECT m FROM mark)")}
SELECT * FROM res""")
def q_cdc_resolve(spark, sf):
    mark = cdc_mark(cdc_history_ods(spark, sf))
    return _resolve(S.cdc_log(spark, sf), mark)


@query("cdc_resolve_unkeyed", sql=f"""{SQL_CDC_BASE},
{_sql_resolve("res", "WHERE CAPTURE_TS >= (SELECT m FROM mark)", keyed=False)}
SELECT * FROM res""")
def q_cdc_resolve_unkeyed(spark, sf):
    mark = cdc_mark(cdc_history_ods(spark, sf))
    return _resolve(S.cdc_log(spark, sf), mark, keyed=False)


@query("tombstone_renamed", sql=f"""{SQL_CDC_BASE},
{SQL_TOMB}
SELECT * FROM tomb""")
def q_tombstone(spark, sf):
    ods0 = cut_lineage(cdc_history_ods(spark, sf))
    return cdc_tombstoned(spark, sf, ods0, cdc_mark(ods0)).withColumnRenamed(ACTION, "MERGE_ACTION")


@query("cdc_to_ods", headline=True, sql=SQL_CDC_RUN + "\nSELECT * FROM upserted")
def q_cdc_to_ods(spark, sf):
    return cdc_second_run(spark, sf).withColumnRenamed(ACTION, "MERGE_ACTION")


@query("merge_hash_gated", sql=SQL_CDC_RUN + "\nSELECT * FROM upserted WHERE MERGE_ACTION <> 'unchanged'")
def q_merge_gated(spark, sf):
    return q_cdc_to_ods(spark, sf).filter(F.col("MERGE_ACTION") != "unchanged")


@query("merge_ungated", sql=f"""{SQL_CDC_RUN.replace('upserted AS', 'gated AS')},
upserted AS (
{Q.upsert("tgt", "delta_ods", CDC_COLS, "ODS_PK", CDC_NO_UPDATE, gate=None)}
)
SELECT * FROM upserted""")
def q_merge_ungated(spark, sf):
    ods0 = cut_lineage(cdc_history_ods(spark, sf))
    mark = cdc_mark(ods0)
    tomb = drop_action(cdc_tombstoned(spark, sf, ods0, mark))
    delta_ods = ods_transform(_resolve(S.cdc_log(spark, sf), mark), S.CDC_BATCH, S.CDC_RUN)
    return merge_upsert(tomb, delta_ods, "ODS_PK", no_update=CDC_NO_UPDATE, gate=None) \
        .withColumnRenamed(ACTION, "MERGE_ACTION")


@query("merge_action_counts", sql=SQL_CDC_RUN + """
SELECT CAST(count(*) FILTER (WHERE MERGE_ACTION = 'insert') AS BIGINT) AS rows_inserted,
       CAST(count(*) FILTER (WHERE MERGE_ACTION = 'update') AS BIGINT) AS rows_updated,
       CAST(count(*) FILTER (WHERE MERGE_ACTION = 'delete') AS BIGINT) AS rows_deleted,
       CAST(count(*) AS BIGINT) AS rows_total
FROM upserted""")
def q_merge_counts(spark, sf):
    return merge_counts(cdc_second_run(spark, sf))


@query("run_audit", sql=SQL_CDC_RUN + f""",
n AS (SELECT count(*) FILTER (WHERE MERGE_ACTION = 'insert') AS i, count(*) FILTER (WHERE MERGE_ACTION = 'update') AS u FROM upserted)
SELECT md5('cdc_to_ods|{S.CDC_BATCH}') AS model_execution_id, 'model.cdc_to_ods' AS unique_id, 'success' AS status,
       CAST(90.5 AS DOUBLE) AS execution_time, TIMESTAMP '{S.CDC_RUN + dt.timedelta(seconds=90.5)}' AS execute_completed_at,
       CAST(i + u AS DECIMAL(38,0)) AS rows_affected, CAST(i AS DECIMAL(38,0)) AS rows_inserted,
       CAST(u AS DECIMAL(38,0)) AS rows_updated, CAST(0 AS DECIMAL(38,0)) AS rows_deleted, CAST(0 AS DECIMAL(38,0)) AS failures FROM n""")
def q_run_audit(spark, sf):
    """The audit row of the CDC load, built from its merge result."""
    row = audit_row(cdc_second_run(spark, sf), "cdc_to_ods", str(S.CDC_BATCH), S.CDC_RUN, S.CDC_RUN + dt.timedelta(seconds=90.5))
    return row.select("model_execution_id", "unique_id", "status", "execution_time", "execute_completed_at", "rows_affected",
                      "rows_inserted", "rows_updated", "rows_deleted", "failures")


@query("delete_insert", sql=f"""{SQL_CDC_RUN},
di AS (
  SELECT t.*, 'unchanged' AS MERGE_ACTION FROM tgt t WHERE t.ODS_PK NOT IN (SELECT ODS_PK FROM delta_ods)
  UNION ALL SELECT *, 'insert' AS MERGE_ACTION FROM delta_ods
)
SELECT * FROM di""")
def q_delete_insert(spark, sf):
    ods0 = cut_lineage(cdc_history_ods(spark, sf))
    mark = cdc_mark(ods0)
    tomb = drop_action(cdc_tombstoned(spark, sf, ods0, mark))
    delta_ods = ods_transform(_resolve(S.cdc_log(spark, sf), mark), S.CDC_BATCH, S.CDC_RUN)
    return delete_insert(tomb, delta_ods, "ODS_PK").withColumnRenamed(ACTION, "MERGE_ACTION")


@query("two_path_load", sql=f"""{SQL_CDC_BASE},
{_sql_resolve("res", "WHERE CAPTURE_TS >= (SELECT m FROM mark)")},
{_sql_transform("delta_ods", "res", S.CDC_BATCH, S.CDC_RUN)}
SELECT *, 'history' AS LOAD_PATH FROM ods0
UNION ALL SELECT *, 'delta' AS LOAD_PATH FROM delta_ods""")
def q_two_path(spark, sf):
    ods0 = cut_lineage(cdc_history_ods(spark, sf))
    delta_ods = ods_transform(_resolve(S.cdc_log(spark, sf), cdc_mark(ods0)), S.CDC_BATCH, S.CDC_RUN)
    first = load(False, delta_ods, ods0).withColumn("LOAD_PATH", F.lit("history"))
    nxt = load(True, delta_ods, ods0).withColumn("LOAD_PATH", F.lit("delta"))
    return first.unionByName(nxt)


@query("capture_ts", sql="""
WITH stamped AS (
  SELECT event_id, strftime(ts, '%Y%m%d%H%M%S') || lpad(CAST(millisecond(ts) % 1000 AS VARCHAR), 3, '0') || '000'
           AS CAPTURE_STAMP
  FROM events
)
SELECT event_id, CAPTURE_STAMP,
       strptime(substr(CAPTURE_STAMP, 1, 14), '%Y%m%d%H%M%S')
         + to_milliseconds(CAST(substr(CAPTURE_STAMP, 15, 3) AS INTEGER)) AS CAPTURE_TS
FROM stamped""")
def q_capture_ts(spark, sf):
    from tidemark.functions.expr import capture_stamp, parse_capture_ts
    e = S.t(spark, sf, "events").select("event_id", F.concat(capture_stamp("ts"), F.lit("000")).alias("CAPTURE_STAMP"))
    return e.select("event_id", "CAPTURE_STAMP", parse_capture_ts("CAPTURE_STAMP").alias("CAPTURE_TS"))


# ----------------------------------------------------------------------------- snapshot kind

SNAP_SPEC = TableSpec(
    columns=("ODS_PK", "ENTITY_KEY", "STATUS", "PRIORITY", "AMOUNT", "SYS_LAST_UPDATE_DTM", "STG_INSERT_TIMESTAMP",
             "SRC_DEL_IND", "SRC_ACTION_CD", "ODS_INS_BATCH_ID", "ODS_UPD_BATCH_ID", "ODS_INSERT_TIMESTAMP",
             "ODS_UPDATE_TIMESTAMP", "OPERATION_TYPE"),
    natural_keys=("ENTITY_KEY",),
    audit=("SYS_LAST_UPDATE_DTM", "STG_INSERT_TIMESTAMP", "SRC_DEL_IND", "SRC_ACTION_CD", "ODS_INS_BATCH_ID",
           "ODS_UPD_BATCH_ID", "ODS_INSERT_TIMESTAMP", "ODS_UPDATE_TIMESTAMP", "OPERATION_TYPE"),
)
SNAP_COLS = list(SNAP_SPEC.columns) + ["HASH_CHANGE", "HASH_FULL"]
PURGE_EXCLUDE = ["STG_INSERT_TIMESTAMP", "SYS_LAST_UPDATE_DTM", "SRC_ORDERKEY", "AMOUNT"]
SNAP_FIRST_CUT = dt.datetime(2001, 1, 1)
SNAP_RUN1 = dt.datetime(2000, 12, 31, 6, 0, 0)
SNAP_BATCH1 = 20001231060000000
SNAP_RUN2 = dt.datetime(2001, 12, 31, 6, 0, 0)
SNAP_BATCH2 = 20011231060000000


def snap_transform(rows: DataFrame, batch: int, run_ts: dt.datetime) -> DataFrame:
    ts = lit(run_ts)
    shaped = rows.select(
        surrogate_key(trim_string(F.col("ENTITY_KEY").cast("string"))).alias("ODS_PK"), "ENTITY_KEY",
        trim_string("STATUS").alias("STATUS"), trim_string("PRIORITY").alias("PRIORITY"), "AMOUNT",
        "SYS_LAST_UPDATE_DTM", "STG_INSERT_TIMESTAMP", F.lit("N").alias("SRC_DEL_IND"), F.lit("I").alias("SRC_ACTION_CD"),
        F.lit(batch).cast("bigint").alias("ODS_INS_BATCH_ID"), F.lit(batch).cast("bigint").alias("ODS_UPD_BATCH_ID"),
        ts.alias("ODS_INSERT_TIMESTAMP"), ts.alias("ODS_UPDATE_TIMESTAMP"), F.lit("INSERT").alias("OPERATION_TYPE"))
    return shaped.select("*", hash_change(SNAP_SPEC).alias("HASH_CHANGE"), hash_full(SNAP_SPEC).alias("HASH_FULL"))


def purged_staging(spark, sf) -> DataFrame:
    return purge_duplicates(S.staging_loads(spark, sf), PURGE_EXCLUDE)


def purged_staging_table(spark, sf) -> DataFrame:
    """The reference purges the staging table in place before the load; here the purged
    staging is written once (a table in the shared checkpoint folder) and every later
    step reads that copy instead of recomputing the purge."""
    return cut_lineage(purged_staging(spark, sf))


def snap_first(spark, sf, stg: DataFrame | None = None) -> DataFrame:
    stg = stg if stg is not None else purged_staging(spark, sf)
    stg = stg.filter(F.col("STG_INSERT_TIMESTAMP") < lit(SNAP_FIRST_CUT))
    return snap_transform(latest_per_key(stg, "ENTITY_KEY", ["SYS_LAST_UPDATE_DTM"], ["SRC_ORDERKEY"]),
                          SNAP_BATCH1, SNAP_RUN1)


def _snap_latest(rows: DataFrame) -> DataFrame:
    return latest_per_key(rows, "ENTITY_KEY", ["SYS_LAST_UPDATE_DTM"], ["SRC_ORDERKEY"])


SNAP_LOAD = OdsLoad(key="ODS_PK", resolve=_snap_latest, shape=snap_transform, source_ts="STG_INSERT_TIMESTAMP",
                    target_ts="STG_INSERT_TIMESTAMP", no_update=("ODS_INS_BATCH_ID", "ODS_INSERT_TIMESTAMP"),
                    snapshot_keys=("ENTITY_KEY",))


def snap_second(spark, sf) -> DataFrame:
    stg = purged_staging_table(spark, sf)
    ods0 = cut_lineage(snap_first(spark, sf, stg))
    return load_ods(SNAP_LOAD, stg, ods0, SNAP_BATCH2, SNAP_RUN2).withColumnRenamed(ACTION, "DELETE_ACTION")


def _sql_purge() -> str:
    content = [c for c in ["ENTITY_KEY", "SRC_ORDERKEY", "STATUS", "PRIORITY", "AMOUNT", "SYS_LAST_UPDATE_DTM",
                           "STG_INSERT_TIMESTAMP"] if c not in PURGE_EXCLUDE]
    order = ", ".join(f"{c} DESC NULLS FIRST" for c in PURGE_EXCLUDE)
    nonnull = " AND ".join(f"{c} IS NOT NULL" for c in PURGE_EXCLUDE)
    return f"""{S.SQL_STAGING},
ranked AS (
  SELECT *, rank() OVER (PARTITION BY {Q.md5_concat(content, '', 'NULL')} ORDER BY {order}) AS rk FROM staging
),
purged AS (
  SELECT ENTITY_KEY, SRC_ORDERKEY, STATUS, PRIORITY, AMOUNT, SYS_LAST_UPDATE_DTM, STG_INSERT_TIMESTAMP
  FROM ranked WHERE NOT (rk > 1 AND {nonnull})
)"""


def _sql_snap_transform(name: str, src: str, batch: int, run_ts: dt.datetime) -> str:
    ts = f"TIMESTAMP '{run_ts.isoformat(sep=' ')}'"
    key = Q.trim_string("CAST(ENTITY_KEY AS VARCHAR)")
    return f"""{name}_x AS (
  SELECT md5(coalesce(CAST({key} AS VARCHAR), '')) AS ODS_PK, ENTITY_KEY,
         {Q.trim_string('STATUS')} AS STATUS, {Q.trim_string('PRIORITY')} AS PRIORITY, AMOUNT,
         SYS_LAST_UPDATE_DTM, STG_INSERT_TIMESTAMP, 'N' AS SRC_DEL_IND, 'I' AS SRC_ACTION_CD,
         CAST({batch} AS BIGINT) AS ODS_INS_BATCH_ID, CAST({batch} AS BIGINT) AS ODS_UPD_BATCH_ID,
         {ts} AS ODS_INSERT_TIMESTAMP, {ts} AS ODS_UPDATE_TIMESTAMP, 'INSERT' AS OPERATION_TYPE
  FROM {src}
  QUALIFY row_number() OVER (PARTITION BY ENTITY_KEY ORDER BY SYS_LAST_UPDATE_DTM DESC NULLS FIRST,
                                                     SRC_ORDERKEY DESC NULLS FIRST) = 1
),
{name} AS (SELECT *, {Q.md5_concat(SNAP_SPEC.change_columns(), '|')} AS HASH_CHANGE,
                  {Q.md5_concat(SNAP_SPEC.full_columns(), '|')} AS HASH_FULL FROM {name}_x)"""


SQL_SNAP = f"""WITH {_sql_purge()},
first_rows AS (SELECT * FROM purged WHERE STG_INSERT_TIMESTAMP < TIMESTAMP '{SNAP_FIRST_CUT.isoformat(sep=' ')}'),
{_sql_snap_transform("ods0", "first_rows", SNAP_BATCH1, SNAP_RUN1)},
smark AS (SELECT coalesce(max(STG_INSERT_TIMESTAMP) - INTERVAL 3 MINUTE, TIMESTAMP '1900-01-01') AS m FROM ods0),
delta_rows AS (SELECT * FROM purged WHERE STG_INSERT_TIMESTAMP >= (SELECT m FROM smark)),
{_sql_snap_transform("src", "delta_rows", SNAP_BATCH2, SNAP_RUN2)},
merged AS (
{Q.upsert("ods0", "src", SNAP_COLS, "ODS_PK", ["ODS_INS_BATCH_ID", "ODS_INSERT_TIMESTAMP"])}
),
latest AS (SELECT DISTINCT ENTITY_KEY FROM purged WHERE STG_INSERT_TIMESTAMP = (SELECT max(STG_INSERT_TIMESTAMP) FROM purged)),
maxima AS (SELECT max(ODS_UPD_BATCH_ID) AS mb, max(ODS_UPDATE_TIMESTAMP) AS mt FROM merged),
flagged AS (
  SELECT m.*, (NOT EXISTS (SELECT 1 FROM latest l WHERE l.ENTITY_KEY = m.ENTITY_KEY)
               AND coalesce(m.OPERATION_TYPE <> 'DELETE', false)) AS hit
  FROM merged m
),
marked AS (
  SELECT ODS_PK, ENTITY_KEY, STATUS, PRIORITY, AMOUNT, SYS_LAST_UPDATE_DTM, STG_INSERT_TIMESTAMP,
         CASE WHEN hit THEN 'Y' ELSE SRC_DEL_IND END AS SRC_DEL_IND,
         CASE WHEN hit THEN 'D' ELSE SRC_ACTION_CD END AS SRC_ACTION_CD,
         ODS_INS_BATCH_ID,
         CASE WHEN hit THEN (SELECT mb FROM maxima) ELSE ODS_UPD_BATCH_ID END AS ODS_UPD_BATCH_ID,
         ODS_INSERT_TIMESTAMP,
         CASE WHEN hit THEN (SELECT mt FROM maxima) ELSE ODS_UPDATE_TIMESTAMP END AS ODS_UPDATE_TIMESTAMP,
         CASE WHEN hit THEN 'DELETE' ELSE OPERATION_TYPE END AS OPERATION_TYPE,
         HASH_CHANGE, HASH_FULL,
         CASE WHEN hit THEN 'delete' ELSE 'unchanged' END AS DELETE_ACTION, MERGE_ACTION
  FROM flagged
)"""


@query("purge_content_dups", sql=f"WITH {_sql_purge()}\nSELECT * FROM purged")
def q_purge(spark, sf):
    return purged_staging(spark, sf)


@query("snapshot_to_ods", headline=True, sql=SQL_SNAP + "\nSELECT * FROM marked")
def q_snapshot_to_ods(spark, sf):
    return snap_second(spark, sf)


@query("mark_deleted", sql=SQL_SNAP + "\nSELECT * FROM marked WHERE DELETE_ACTION = 'delete'")
def q_mark_deleted(spark, sf):
    return snap_second(spark, sf).filter(F.col("DELETE_ACTION") == "delete")


# ----------------------------------------------------------------------------- API-extract kind
# An API extract lands full records with created / modified stamps and a deleted flag.
# Stand-in: orders as account records (ID = o_custkey, CREATEDDATE = the customer's first
# order time, SYSTEMMODSTAMP = the order time, ISDELETED = fulfilled). The first load takes
# records modified before 2001; the second run takes SYSTEMMODSTAMP >= max(target) with no
# overlap, keeps the latest record per ID, derives the action code and flags, hashes and
# upserts with only the insert timestamp protected (trap T14: the insert batch id is not).

API_SPEC = TableSpec(
    columns=("ODS_PK", "ID", "STATUS", "PRIORITY", "AMOUNT", "IS_DELETED_FLAG", "CREATEDDATE", "SYSTEMMODSTAMP",
             "SRC_ACTION_CD", "SRC_DEL_IND", "ODS_INS_BATCH_ID", "ODS_UPD_BATCH_ID", "ODS_INSERT_TIMESTAMP",
             "ODS_UPDATE_TIMESTAMP", "OPERATION_TYPE"),
    natural_keys=("ID",),
    audit=("CREATEDDATE", "SYSTEMMODSTAMP", "SRC_ACTION_CD", "SRC_DEL_IND", "ODS_INS_BATCH_ID", "ODS_UPD_BATCH_ID",
           "ODS_INSERT_TIMESTAMP", "ODS_UPDATE_TIMESTAMP", "OPERATION_TYPE"),
)
API_COLS = list(API_SPEC.columns) + ["HASH_CHANGE", "HASH_FULL"]
API_FIRST_CUT = dt.datetime(2001, 1, 1)
API_RUN1, API_BATCH1 = dt.datetime(2001, 1, 1, 6, 0, 0), 20010101060000000
API_RUN2, API_BATCH2 = dt.datetime(2001, 9, 1, 6, 0, 0), 20010901060000000


def api_extract(spark, sf) -> DataFrame:
    o = S.t(spark, sf, "orders")
    created = o.groupBy(F.col("o_custkey").alias("ID")).agg(F.min("o_orderdate").alias("CREATEDDATE"))
    rec = o.select(F.col("o_custkey").alias("ID"), F.col("o_orderkey").alias("REC_ID"),
                   F.col("o_orderstatus").alias("STATUS"), F.col("o_orderpriority").alias("PRIORITY"),
                   F.col("o_totalprice").cast("decimal(18,2)").alias("AMOUNT"),
                   (F.col("o_orderstatus") == "F").alias("ISDELETED"), F.col("o_orderdate").alias("SYSTEMMODSTAMP"))
    return rec.join(created, "ID", "left")


def api_transform(rows: DataFrame, batch: int, run_ts: dt.datetime) -> DataFrame:
    from tidemark.functions.expr import action_code
    ts = lit(run_ts)
    deleted = F.col("ISDELETED") == F.lit(True)
    shaped = rows.select(
        surrogate_key(trim_string(F.col("ID").cast("string"))).alias("ODS_PK"), "ID", "STATUS", "PRIORITY", "AMOUNT",
        F.when(deleted, F.lit(1)).otherwise(F.lit(0)).alias("IS_DELETED_FLAG"),
        "CREATEDDATE", "SYSTEMMODSTAMP",
        action_code("ISDELETED", "CREATEDDATE", "SYSTEMMODSTAMP").alias("SRC_ACTION_CD"),
        F.when(deleted, F.lit("Y")).otherwise(F.lit("N")).alias("SRC_DEL_IND"),
        F.lit(batch).cast("bigint").alias("ODS_INS_BATCH_ID"), F.lit(batch).cast("bigint").alias("ODS_UPD_BATCH_ID"),
        ts.alias("ODS_INSERT_TIMESTAMP"), ts.alias("ODS_UPDATE_TIMESTAMP"),
        F.when(deleted, F.lit("DELETE")).otherwise(F.lit("INSERT")).alias("OPERATION_TYPE"))
    return shaped.select("*", hash_change(API_SPEC).alias("HASH_CHANGE"), hash_full(API_SPEC).alias("HASH_FULL"))


API_LOAD = OdsLoad(key="ODS_PK", resolve=lambda rows: latest_per_key(rows, "ID", ["SYSTEMMODSTAMP"], ["REC_ID"]),
                   shape=api_transform, source_ts="SYSTEMMODSTAMP", target_ts="SYSTEMMODSTAMP",
                   overlap_minutes=0, no_update=("ODS_INSERT_TIMESTAMP",))      # `>=` max, no overlap


def _sql_api_transform(name: str, src: str, batch: int, run_ts: dt.datetime) -> str:
    ts = f"TIMESTAMP '{run_ts.isoformat(sep=' ')}'"
    key = Q.trim_string("CAST(ID AS VARCHAR)")
    return f"""{name}_x AS (
  SELECT md5(coalesce(CAST({key} AS VARCHAR), '')) AS ODS_PK, ID, STATUS, PRIORITY, AMOUNT,
         CASE WHEN ISDELETED = true THEN 1 ELSE 0 END AS IS_DELETED_FLAG, CREATEDDATE, SYSTEMMODSTAMP,
         CASE WHEN ISDELETED = true THEN 'D' WHEN CREATEDDATE = SYSTEMMODSTAMP THEN 'I'
              WHEN CREATEDDATE <> SYSTEMMODSTAMP THEN 'U' ELSE 'I' END AS SRC_ACTION_CD,
         CASE WHEN ISDELETED = true THEN 'Y' ELSE 'N' END AS SRC_DEL_IND,
         CAST({batch} AS BIGINT) AS ODS_INS_BATCH_ID, CAST({batch} AS BIGINT) AS ODS_UPD_BATCH_ID,
         {ts} AS ODS_INSERT_TIMESTAMP, {ts} AS ODS_UPDATE_TIMESTAMP,
         CASE WHEN ISDELETED = true THEN 'DELETE' ELSE 'INSERT' END AS OPERATION_TYPE
  FROM {src}
  QUALIFY row_number() OVER (PARTITION BY ID ORDER BY SYSTEMMODSTAMP DESC NULLS FIRST, REC_ID DESC NULLS FIRST) = 1
),
{name} AS (SELECT *, {Q.md5_concat(API_SPEC.change_columns(), '|')} AS HASH_CHANGE,
                  {Q.md5_concat(API_SPEC.full_columns(), '|')} AS HASH_FULL FROM {name}_x)"""


@query("api_to_ods", sql=f"""WITH api AS (
  SELECT o.o_custkey AS ID, o.o_orderkey AS REC_ID, o.o_orderstatus AS STATUS, o.o_orderpriority AS PRIORITY,
         CAST(o.o_totalprice AS DECIMAL(18,2)) AS AMOUNT, o.o_orderstatus = 'F' AS ISDELETED,
         o.o_orderdate AS SYSTEMMODSTAMP, c.CREATEDDATE
  FROM orders o LEFT JOIN (SELECT o_custkey, min(o_orderdate) AS CREATEDDATE FROM orders GROUP BY o_custkey) c
    ON o.o_custkey = c.o_custkey
),
first_rows AS (SELECT * FROM api WHERE SYSTEMMODSTAMP < TIMESTAMP '{API_FIRST_CUT.isoformat(sep=' ')}'),
{_sql_api_transform("ods0", "first_rows", API_BATCH1, API_RUN1)},
delta_rows AS (SELECT * FROM api WHERE SYSTEMMODSTAMP >= (SELECT coalesce(max(SYSTEMMODSTAMP), TIMESTAMP '1900-01-01') FROM ods0)),
{_sql_api_transform("src", "delta_rows", API_BATCH2, API_RUN2)},
merged AS (
{Q.upsert("ods0", "src", API_COLS, "ODS_PK", ["ODS_INSERT_TIMESTAMP"])}
)
SELECT * FROM merged""")
def q_api_to_ods(spark, sf):
    api = cut_lineage(api_extract(spark, sf))
    first = api.filter(F.col("SYSTEMMODSTAMP") < lit(API_FIRST_CUT))
    ods0 = cut_lineage(drop_action(load_ods(API_LOAD, first, None, API_BATCH1, API_RUN1)))
    return load_ods(API_LOAD, api, ods0, API_BATCH2, API_RUN2).withColumnRenamed(ACTION, "MERGE_ACTION")
