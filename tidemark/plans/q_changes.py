"""Registered queries: dedup, SCD history and merges."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import functions as F

from tidemark.operators.dedup import latest_per_key
from tidemark.operators.merge import ACTION
from tidemark.operators.scd import scd_init, scd_merge
from tidemark.plans import standins as S
from tidemark.plans.registry import query

ORDER_COLS = ["o_orderkey", "o_custkey", "o_orderstatus", "o_totalprice", "o_orderdate", "o_orderpriority"]


# ----------------------------------------------------------------------------- W1

@query("dedup_latest", headline=True, sql="""
SELECT o_orderkey, o_custkey, o_orderstatus, o_totalprice, o_orderdate, o_orderpriority
FROM orders
QUALIFY row_number() OVER (PARTITION BY o_custkey
                           ORDER BY o_orderdate DESC NULLS FIRST, o_orderkey DESC NULLS FIRST) = 1
""")
def dedup_latest(spark, sf):
    o = S.t(spark, sf, "orders").select(*ORDER_COLS)
    return latest_per_key(o, "o_custkey", ["o_orderdate"], ["o_orderkey"])


# ----------------------------------------------------------------------------- E8 / E7

DIM_OUT = S.DIM_COLS + ["VERSION_NUM"]


@query("scd2_from_history", headline=True, sql=f"""
WITH {S.sql_dim_history("dim", None, S.BATCH2)}
SELECT * FROM dim
""")
def scd2_from_history(spark, sf):
    return S.dim_history(spark, sf, None, S.BATCH2)


@query("scd_init", sql=f"""
WITH {S.sql_snapshot_source("src", None, S.BATCH1, stamp_day=S.D1)}
SELECT ENTITY_KEY, STATUS, PRIORITY, PRICE_BAND, HASH_SCD2, HASH_SCD1,
       DATE '{S.D1}' AS EFF_DT, DATE '9999-12-31' AS DISC_DT, true AS IS_CURRENT,
       CAST({S.BATCH1} AS BIGINT) AS INS_BATCH_ID, CAST({S.BATCH1} AS BIGINT) AS UPD_BATCH_ID
FROM src
""")
def q_scd_init(spark, sf):
    src = S.snapshot_source(spark, sf, None, S.BATCH1, stamp_day=S.D1).select(
        "ENTITY_KEY", "STATUS", "PRIORITY", "PRICE_BAND", "HASH_SCD2", "HASH_SCD1")
    return scd_init(src, S.D1, S.BATCH1)


# ----------------------------------------------------------------------------- E3-E6

def sql_scd_merge(dim: str, src: str, run_day: dt.date, batch: int, late_closeout: bool = False,
                  p: str = "") -> str:
    """Oracle CTEs `{p}merged`: the statements of the SCD merge one after the other, each over
    the table the one before left (MERGE, then close-out, then type-1 overwrite), unlike the
    one-pass decision table of `operators.scd`."""
    cols = ", ".join(S.DIM_COLS)
    s_cols = ", ".join(f"s.{c}" for c in S.DIM_COLS)
    new_cols = ", ".join("DATE '1900-01-01'" if c == "EFF_DT" else f"s.{c}" for c in S.DIM_COLS)
    day = f"DATE '{run_day.isoformat()}'"
    opened = "DISC_DT = DATE '9999-12-31'"

    def batch_day(c: str) -> str:
        return f"CAST(strptime(substr(CAST({c} AS VARCHAR), 1, 8), '%Y%m%d') AS DATE)"

    sd = batch_day("s.INS_BATCH_ID")
    matched = f"s.ENTITY_KEY = d.ENTITY_KEY AND d.{opened} AND {sd} <= d.EFF_DT"
    same_day = f"({sd} = d.EFF_DT OR {batch_day('d.INS_BATCH_ID')} = {day}) AND d.HASH_SCD2 <> s.HASH_SCD2"
    spared = "" if late_closeout else f" AND NOT {sd} <= m.EFF_DT"
    return f"""
{p}merge1 AS (
  SELECT {s_cols}, 'update' AS MERGE_ACTION FROM {dim} d JOIN {src} s ON {matched} AND {same_day}
  UNION ALL
  SELECT {cols}, 'unchanged' FROM {dim} d WHERE NOT EXISTS (SELECT 1 FROM {src} s WHERE {matched} AND {same_day})
  UNION ALL
  SELECT {new_cols}, 'insert' FROM {src} s WHERE NOT EXISTS (SELECT 1 FROM {dim} d WHERE d.ENTITY_KEY = s.ENTITY_KEY)
  UNION ALL
  SELECT {s_cols}, 'insert' FROM {src} s
  WHERE EXISTS (SELECT 1 FROM {dim} d WHERE d.ENTITY_KEY = s.ENTITY_KEY)
    AND NOT EXISTS (SELECT 1 FROM {dim} d WHERE {matched})
    AND NOT EXISTS (SELECT 1 FROM {dim} d WHERE d.ENTITY_KEY = s.ENTITY_KEY AND d.{opened} AND d.HASH_SCD2 = s.HASH_SCD2)
),
{p}ended AS (
  SELECT m.*, s.ENTITY_KEY IS NOT NULL AS ends FROM {p}merge1 m
  LEFT JOIN {src} s ON s.ENTITY_KEY = m.ENTITY_KEY AND m.{opened} AND m.HASH_SCD2 <> s.HASH_SCD2{spared}
),
{p}closed AS (
  SELECT * EXCLUDE (ends) REPLACE (
    CASE WHEN ends THEN CAST({day} - INTERVAL 1 DAY AS DATE) ELSE DISC_DT END AS DISC_DT,
    CASE WHEN ends THEN false ELSE IS_CURRENT END AS IS_CURRENT,
    CASE WHEN ends THEN CAST({batch} AS BIGINT) ELSE UPD_BATCH_ID END AS UPD_BATCH_ID,
    CASE WHEN ends THEN 'close' ELSE MERGE_ACTION END AS MERGE_ACTION) FROM {p}ended
),
{p}merged AS (
  SELECT * FROM {p}closed m WHERE NOT EXISTS (SELECT 1 FROM {src} s
    WHERE s.ENTITY_KEY = m.ENTITY_KEY AND m.{opened} AND s.HASH_SCD2 = m.HASH_SCD2 AND s.HASH_SCD1 <> m.HASH_SCD1)
  UNION ALL
  SELECT {s_cols}, 'update' FROM {p}closed m JOIN {src} s
    ON s.ENTITY_KEY = m.ENTITY_KEY AND m.{opened} AND s.HASH_SCD2 = m.HASH_SCD2 AND s.HASH_SCD1 <> m.HASH_SCD1
)""".strip()


def dim_after_run1(spark, sf):
    """The dimension as stored after the first run (a table, so it is materialised)."""
    from tidemark.sources.sinks import cut_lineage
    return cut_lineage(S.dim_history(spark, sf, S.D1, S.BATCH1).select(*S.DIM_COLS))


def _merge_d2(spark, sf, data: dt.date | None = None):
    """The second run, stamped D2: the latest state of all orders, or of those up to `data`."""
    src = S.snapshot_source(spark, sf, data, S.BATCH2, stamp_day=S.D2)
    return scd_merge(dim_after_run1(spark, sf), src, "ENTITY_KEY", S.D2, S.BATCH2)


def merge_prefix(data: dt.date | None = None) -> str:
    return (f"WITH {S.sql_dim_history('dim', S.D1, S.BATCH1)},\n"
            f"{S.sql_snapshot_source('src', data, S.BATCH2, stamp_day=S.D2)},\n"
            f"{sql_scd_merge('dim', 'src', S.D2, S.BATCH2)}\n")


MERGE_PREFIX = merge_prefix()


@query("scd2_merge", headline=True, sql=MERGE_PREFIX + "SELECT * FROM merged")
def scd2_merge(spark, sf):
    return _merge_d2(spark, sf).withColumnRenamed(ACTION, "MERGE_ACTION")


@query("scd2_closeout", sql=MERGE_PREFIX + "SELECT * FROM merged WHERE MERGE_ACTION = 'close'")
def scd2_closeout(spark, sf):
    m = _merge_d2(spark, sf).withColumnRenamed(ACTION, "MERGE_ACTION")
    return m.filter(F.col("MERGE_ACTION") == "close")


@query("scd1_overwrite", sql=MERGE_PREFIX + "SELECT * FROM merged WHERE MERGE_ACTION = 'update'")
def scd1_overwrite(spark, sf):
    m = _merge_d2(spark, sf).withColumnRenamed(ACTION, "MERGE_ACTION")
    return m.filter(F.col("MERGE_ACTION") == "update")


# Source rows of one priority carry no value, so the NULL of an open row reaches its history.
NO_PRIORITY = "4-NOT SPECIFIED"


SQL_SCD6 = f"""WITH {S.sql_dim_history('dim', S.D1, S.BATCH1)},
{S.sql_snapshot_source('src0', None, S.BATCH2, stamp_day=S.D2)},
src AS (SELECT * REPLACE (nullif(PRIORITY, '{NO_PRIORITY}') AS PRIORITY) FROM src0),
{sql_scd_merge('dim', 'src', S.D2, S.BATCH2)},
flags AS (
  SELECT coalesce(bool_or(coalesce(s.PRIORITY, '') <> coalesce(c.PRIORITY, '')), false) AS chg
  FROM src s JOIN dim c ON s.ENTITY_KEY = c.ENTITY_KEY WHERE c.IS_CURRENT
),
curr AS (SELECT ENTITY_KEY, PRIORITY FROM merged WHERE DISC_DT = DATE '9999-12-31')
SELECT h.* FROM merged h, flags
WHERE NOT chg OR DISC_DT = DATE '9999-12-31' OR h.ENTITY_KEY NOT IN (SELECT ENTITY_KEY FROM curr)
UNION ALL
SELECT h.* REPLACE (c.PRIORITY AS PRIORITY) FROM merged h JOIN curr c ON h.ENTITY_KEY = c.ENTITY_KEY, flags
WHERE chg AND h.DISC_DT <> DATE '9999-12-31'
"""


def scd6_source(spark, sf):
    return S.snapshot_source(spark, sf, None, S.BATCH2, stamp_day=S.D2) \
        .withColumn("PRIORITY", F.nullif("PRIORITY", F.lit(NO_PRIORITY)))


@query("scd6_propagate", sql=SQL_SCD6)
def q_scd6(spark, sf):
    dim = dim_after_run1(spark, sf)
    return scd_merge(dim, scd6_source(spark, sf), "ENTITY_KEY", S.D2, S.BATCH2, type6=["PRIORITY"]).withColumnRenamed(ACTION, "MERGE_ACTION")


# ----------------------------------------------------------------------------- E3 on later runs
# The dimension after the D2 run is merged again: a second batch of the same day, for which the
# first one held the orders up to MID only (the intra-day overwrite), and a batch whose data day
# lies before the open rows (a late source), run one day later, once with the default and once
# reproducing the close-out. The runs of each query together read every order.

SAME_DAY_BATCH = 20020101120000000
LATE_DATA = dt.date(1998, 6, 1)           # late data, stamped with its own day
LATE_BATCH = 19980601060000000
NEXT_RUN = dt.date(2002, 1, 2)
NEXT_BATCH = 20020102060000000


def dim_after_run2(spark, sf, data: dt.date | None = None):
    from tidemark.sources.sinks import cut_lineage
    return cut_lineage(_merge_d2(spark, sf, data).drop(ACTION))


def run3_prefix(data: dt.date | None = None) -> str:
    return merge_prefix(data).rstrip() + ",\ndim2 AS (SELECT * EXCLUDE (MERGE_ACTION) FROM merged),\n"


@query("scd2_intraday", sql=run3_prefix(S.MID)
       + S.sql_snapshot_source("src3", None, SAME_DAY_BATCH, stamp_day=S.D2) + ",\n"
       + sql_scd_merge("dim2", "src3", S.D2, SAME_DAY_BATCH, p="r3_") + "\nSELECT * FROM r3_merged")
def scd2_intraday(spark, sf):
    src = S.snapshot_source(spark, sf, None, SAME_DAY_BATCH, stamp_day=S.D2)
    return scd_merge(dim_after_run2(spark, sf, S.MID), src, "ENTITY_KEY", S.D2, SAME_DAY_BATCH) \
        .withColumnRenamed(ACTION, "MERGE_ACTION")


def _late(spark, sf, closeout):
    src = S.snapshot_source(spark, sf, LATE_DATA, LATE_BATCH)
    return scd_merge(dim_after_run2(spark, sf), src, "ENTITY_KEY", NEXT_RUN, NEXT_BATCH,
                     late_closeout=closeout).withColumnRenamed(ACTION, "MERGE_ACTION")


@query("scd2_late_source", sql=run3_prefix()
       + S.sql_snapshot_source("src3", LATE_DATA, LATE_BATCH) + ",\n"
       + sql_scd_merge("dim2", "src3", NEXT_RUN, NEXT_BATCH, p="r3_") + "\nSELECT * FROM r3_merged")
def scd2_late_source(spark, sf):
    return _late(spark, sf, False)


@query("scd2_late_closeout", sql=run3_prefix()
       + S.sql_snapshot_source("src3", LATE_DATA, LATE_BATCH) + ",\n"
       + sql_scd_merge("dim2", "src3", NEXT_RUN, NEXT_BATCH, late_closeout=True, p="r3_")
       + "\nSELECT * FROM r3_merged")
def scd2_late_closeout(spark, sf):
    return _late(spark, sf, True)
