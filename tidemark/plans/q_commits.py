"""Registered queries over stored bucketed tables: whole commits, evolution, statistics, type 6 on buckets,
digest reconciliation and the prefix-scan form of the history build (A5, A6, A9, A13, E6, E8, P18, G2, Q9, W5).

Each query writes a bucketed table into the shared checkpoint folder, runs its batches as commits and
returns what a reader of the table then sees.
"""

from __future__ import annotations

import datetime as dt
import uuid

from pyspark.sql import functions as F

from tidemark.functions.literals import lit
from tidemark.operators.merge import drop_action, tombstone_renamed
from tidemark.plans import q_changes as C
from tidemark.plans import q_ods as O
from tidemark.plans import standins as S
from tidemark.plans.registry import query
from tidemark.session import checkpoint_dir
from tidemark.sources import commits, sinks

BUCKETS = 32


def _folder(spark, name: str) -> str:
    return f"{checkpoint_dir(spark).rstrip('/')}/tables/{name}-{uuid.uuid4().hex}"


# ----------------------------------------------------------------------------- CDC upsert, evolution

def _cdc_table(spark, sf) -> str:
    """The ODS table after its history load, stored without the column AMOUNT and with the user key
    as a 32-bit integer: the second run brings the column and the wider type."""
    path = _folder(spark, "ods")
    first = O.cdc_history_ods(spark, sf).drop("AMOUNT").withColumn("USER_KEY", F.col("USER_KEY").cast("int"))
    sinks.write_bucketed(first, path, "ODS_PK", BUCKETS, stats=["SRC_LAST_UPDATE_DTM"],
                         digest=["HASH_CHANGE", "OPERATION_TYPE"])
    return path


def _cdc_commit(spark, sf) -> tuple[str, dict]:
    """The second run as one commit; the table's folder and the commit's entry."""
    path = _cdc_table(spark, sf)
    # the watermark comes from the version file: no row of the target is read for it
    mark = commits.watermark(spark, path, "SRC_LAST_UPDATE_DTM", default=dt.datetime(1900, 1, 1)) - dt.timedelta(minutes=3)
    log = S.cdc_log(spark, sf)
    rows = O.ods_transform(O._resolve(log, mark), S.CDC_BATCH, S.CDC_RUN)
    renamed = O._renamed(log.filter(F.col("CAPTURE_TS") >= lit(mark)))
    entry = sinks.upsert_bucketed(
        spark, path, rows, "ODS_PK", BUCKETS, extra_keys=renamed, no_update=O.CDC_NO_UPDATE,
        pre=lambda cur: drop_action(tombstone_renamed(cur, renamed, "ODS_PK", S.CDC_RUN, S.CDC_BATCH)))
    return path, entry


NO_AMOUNT = "CASE WHEN MERGE_ACTION = 'unchanged' THEN NULL ELSE AMOUNT END AS AMOUNT"


@query("bucket_commit_upsert", sql=O.SQL_CDC_RUN + f"""
SELECT * EXCLUDE (MERGE_ACTION) REPLACE ({NO_AMOUNT}) FROM upserted""")
def bucket_commit_upsert(spark, sf):
    path, _ = _cdc_commit(spark, sf)
    return sinks.read_bucketed(spark, path)


@query("bucket_commit_as_of", sql=O.SQL_CDC_BASE + """
SELECT * EXCLUDE (AMOUNT) REPLACE (CAST(USER_KEY AS INTEGER) AS USER_KEY) FROM ods0""")
def bucket_commit_as_of(spark, sf):
    """The table as it was before the second run, read after it."""
    path, entry = _cdc_commit(spark, sf)
    return sinks.read_bucketed(spark, path, version=entry["version"] - 1)


@query("bucket_commit_statistics", sql=O.SQL_CDC_RUN + """
SELECT CAST(count(*) FILTER (WHERE MERGE_ACTION = 'insert') AS BIGINT) AS rows_inserted,
       CAST(count(*) FILTER (WHERE MERGE_ACTION = 'update') AS BIGINT) AS rows_updated,
       CAST(count(*) AS BIGINT) AS table_rows, max(SRC_LAST_UPDATE_DTM) AS watermark FROM upserted""")
def bucket_commit_statistics(spark, sf):
    """Counts observed while the commit wrote its rows, and the table's row count and watermark, from the
    version file alone."""
    path, entry = _cdc_commit(spark, sf)
    row = (entry["counts"]["rows_inserted"], entry["counts"]["rows_updated"], commits.row_count(spark, path),
           commits.watermark(spark, path, "SRC_LAST_UPDATE_DTM"))
    return spark.createDataFrame([row], "rows_inserted bigint, rows_updated bigint, table_rows bigint, watermark timestamp_ntz")


@query("bucket_reconcile", sql=O.SQL_CDC_RUN + """
SELECT coalesce(a.ODS_PK, b.ODS_PK) AS ODS_PK,
       CASE WHEN b.ODS_PK IS NULL THEN 'left_only' WHEN a.ODS_PK IS NULL THEN 'right_only' ELSE 'changed' END AS SIDE
FROM ods0 a FULL JOIN upserted b ON a.ODS_PK = b.ODS_PK
WHERE a.ODS_PK IS NULL OR b.ODS_PK IS NULL OR a.HASH_CHANGE IS DISTINCT FROM b.HASH_CHANGE
   OR a.OPERATION_TYPE IS DISTINCT FROM b.OPERATION_TYPE""")
def bucket_reconcile(spark, sf):
    """The layer before and after the second run, by the digests of its buckets; only unlike ones are read."""
    path, entry = _cdc_commit(spark, sf)
    return commits.reconcile(spark, (path, entry["version"] - 1), (path, None))


# ----------------------------------------------------------------------------- type 6 on buckets

@query("bucket_commit_type6", sql=C.SQL_SCD6.replace("SELECT h.* REPLACE", "SELECT h.* EXCLUDE (MERGE_ACTION) REPLACE").replace(
    "SELECT h.* FROM", "SELECT h.* EXCLUDE (MERGE_ACTION) FROM"))
def bucket_commit_type6(spark, sf):
    path = _folder(spark, "dim")
    sinks.write_bucketed(C.dim_after_run1(spark, sf), path, "ENTITY_KEY", BUCKETS, diverge=["PRIORITY"])
    sinks.scd_merge_bucketed(spark, path, C.scd6_source(spark, sf), "ENTITY_KEY", BUCKETS, S.D2, S.BATCH2, type6=["PRIORITY"])
    return sinks.read_bucketed(spark, path)


# ----------------------------------------------------------------------------- prefix scan

@query("history_prefix_scan", sql=f"WITH {S.sql_dim_history('dim', None, S.BATCH2)} SELECT * FROM dim")
def history_prefix_scan(spark, sf):
    """The history build without a window over a key."""
    return S.dim_history(spark, sf, None, S.BATCH2, skew_safe=True)
