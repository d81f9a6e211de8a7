"""Stand-in inputs derived from the driver tables, in Spark and as SQL CTEs.

Mapping of the reference's concepts onto the driver tables:
  versioned entity     orders by o_custkey, one daily state per (customer, order date)
                       (latest order of the day wins: intra-day changes collapse)
  SCD2 / SCD1 columns  STATUS = o_orderstatus / PRIORITY = o_orderpriority and
                       PRICE_BAND = floor(o_totalprice / 100000)
  snapshot at day D    latest order per customer with o_orderdate <= D
  CDC change log       events: after key user_id, capture time ts, log id event_id,
                       'D' when event_type = 'error', PK change when event_type = 'signup'
                       with the before-image key in props $.k
  staging loads        orders, one load per order year (STG_INSERT_TIMESTAMP = Jan 1st)
The first dimension run holds the orders up to D1; every later run reads the whole table, so
the runs together cover every order. D2 lies past the last order date and only stamps the run.
"""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.functions.literals import lit
from tidemark.functions.expr import batch_id
from tidemark.functions.hashing import md5_concat, surrogate_key
from tidemark.operators.dedup import latest_per_key
from tidemark.operators.scd import OPEN_DATE, scd2_from_history
from tidemark.sources.tables import read_source

# Fixed run positions of the scenario.
D1 = dt.date(1998, 1, 1)          # first dimension run: orders up to this day
D2 = dt.date(2002, 1, 1)          # second dimension run: all orders, stamped with this day
RUN1 = dt.datetime(1998, 1, 1, 6, 0, 0)
RUN2 = dt.datetime(2002, 1, 1, 6, 0, 0)
BATCH1 = 19980101060000000
BATCH2 = 20020101060000000
MID = dt.date(1999, 1, 1)         # a day inside the data, for checks and deltas as of a day
CDC_FIRST_LOAD = dt.datetime(2024, 1, 22, 0, 0, 0)   # first (history) load of the CDC target
CDC_RUN = dt.datetime(2024, 2, 1, 0, 0, 0)
CDC_BATCH = 20240201000000000

DIM_COLS = ["ENTITY_SK", "ENTITY_KEY", "STATUS", "PRIORITY", "PRICE_BAND", "HASH_SCD2", "HASH_SCD1",
            "EFF_DT", "DISC_DT", "IS_CURRENT", "INS_BATCH_ID", "UPD_BATCH_ID"]


def t(spark: SparkSession, sf: str, name: str) -> DataFrame:
    return read_source(spark, sf, name)


# ----------------------------------------------------------------------------- entity history

def _entity_cols():
    return [F.col("o_custkey").alias("ENTITY_KEY"),
            F.col("o_orderdate").cast("date").alias("SNAP_DT"),
            F.col("o_orderstatus").alias("STATUS"),
            F.col("o_orderpriority").alias("PRIORITY"),
            F.floor(F.col("o_totalprice") / 100000).cast("int").alias("PRICE_BAND"),
            F.col("o_orderkey").alias("SRC_ORDERKEY")]


def _with_scd_hashes(df: DataFrame) -> DataFrame:
    return df.select("*", md5_concat(["STATUS"], "||").alias("HASH_SCD2"),
                     md5_concat(["PRIORITY", "PRICE_BAND"], "||").alias("HASH_SCD1"))


def daily_states(spark, sf, cutoff: dt.date | None = None) -> DataFrame:
    o = t(spark, sf, "orders")
    if cutoff is not None:
        o = o.filter(F.col("o_orderdate") <= lit(dt.datetime.combine(cutoff, dt.time())))
    # The daily collapse is partitioned by (key, day) on purpose: its partial top-1 runs
    # map side, so a hot key reaches the key-partitioned history windows as at most one
    # row per day (bounded by the calendar, not by the data volume).
    e = o.select(*_entity_cols())
    daily = latest_per_key(e, ["ENTITY_KEY", "SNAP_DT"], ["SRC_ORDERKEY"])
    return _with_scd_hashes(daily)


def dim_history(spark, sf, cutoff: dt.date | None = None, batch: int = BATCH1, skew_safe: bool | str = False) -> DataFrame:
    v = scd2_from_history(daily_states(spark, sf, cutoff), "ENTITY_KEY", "SNAP_DT", "HASH_SCD2",
                          ["STATUS", "PRIORITY", "PRICE_BAND", "HASH_SCD2", "HASH_SCD1"], skew_safe=skew_safe)
    return v.select(
        surrogate_key("ENTITY_KEY", "EFF_DT").alias("ENTITY_SK"), "ENTITY_KEY", "STATUS", "PRIORITY",
        "PRICE_BAND", "HASH_SCD2", "HASH_SCD1", "EFF_DT", "DISC_DT",
        (F.col("DISC_DT") == F.lit(OPEN_DATE)).alias("IS_CURRENT"),
        F.lit(batch).cast("bigint").alias("INS_BATCH_ID"), F.lit(batch).cast("bigint").alias("UPD_BATCH_ID"),
        "VERSION_NUM")


def snapshot_source(spark, sf, day: dt.date | None, batch: int, stamp_day: dt.date | None = None) -> DataFrame:
    """Dimension source rows: the latest state per customer as of `day` (None: of the whole
    table), stamped as a run on `stamp_day` (default `day`): EFF_DT and the surrogate key use
    the stamp day."""
    stamp = stamp_day or day
    o = t(spark, sf, "orders")
    if day is not None:
        o = o.filter(F.col("o_orderdate") <= lit(dt.datetime.combine(day, dt.time())))
    e = o.select(*_entity_cols(), F.col("o_orderdate").alias("_od"))
    snap = _with_scd_hashes(latest_per_key(e, ["ENTITY_KEY"], ["_od"], ["SRC_ORDERKEY"]))
    return snap.select(
        surrogate_key("ENTITY_KEY", F.lit(stamp)).alias("ENTITY_SK"), "ENTITY_KEY", "STATUS", "PRIORITY",
        "PRICE_BAND", "HASH_SCD2", "HASH_SCD1", F.lit(stamp).alias("EFF_DT"), F.lit(OPEN_DATE).alias("DISC_DT"),
        F.lit(True).alias("IS_CURRENT"), F.lit(batch).cast("bigint").alias("INS_BATCH_ID"),
        F.lit(batch).cast("bigint").alias("UPD_BATCH_ID"))


SQL_DAILY = """
daily{n} AS (
  SELECT o_custkey AS ENTITY_KEY, CAST(o_orderdate AS DATE) AS SNAP_DT, o_orderstatus AS STATUS,
         o_orderpriority AS PRIORITY, CAST(FLOOR(o_totalprice / 100000) AS INTEGER) AS PRICE_BAND,
         o_orderkey AS SRC_ORDERKEY,
         md5(coalesce(CAST(o_orderstatus AS VARCHAR), '')) AS HASH_SCD2,
         md5(coalesce(CAST(o_orderpriority AS VARCHAR), '') || '||' ||
             coalesce(CAST(CAST(FLOOR(o_totalprice / 100000) AS INTEGER) AS VARCHAR), '')) AS HASH_SCD1
  FROM orders {where}
  QUALIFY row_number() OVER (PARTITION BY o_custkey, CAST(o_orderdate AS DATE)
                             ORDER BY o_orderkey DESC NULLS FIRST) = 1
),
marked{n} AS (
  SELECT *, coalesce(HASH_SCD2 <> lag(HASH_SCD2) OVER (PARTITION BY ENTITY_KEY ORDER BY SNAP_DT), true) AS chg
  FROM daily{n}
),
grouped{n} AS (
  SELECT *, CAST(sum(CAST(chg AS INTEGER)) OVER (PARTITION BY ENTITY_KEY ORDER BY SNAP_DT
                                                 ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS INTEGER) AS ver
  FROM marked{n}
),
versions{n} AS (
  SELECT ENTITY_KEY, ver, min(SNAP_DT) AS EFF_DT,
         arg_max(STATUS, SNAP_DT) AS STATUS, arg_max(PRIORITY, SNAP_DT) AS PRIORITY,
         arg_max(PRICE_BAND, SNAP_DT) AS PRICE_BAND, arg_max(HASH_SCD2, SNAP_DT) AS HASH_SCD2,
         arg_max(HASH_SCD1, SNAP_DT) AS HASH_SCD1
  FROM grouped{n} GROUP BY ENTITY_KEY, ver
),
{name} AS (
  SELECT md5(coalesce(CAST(ENTITY_KEY AS VARCHAR), '') || '-' || coalesce(CAST(EFF_DT AS VARCHAR), '')) AS ENTITY_SK,
         ENTITY_KEY, STATUS, PRIORITY, PRICE_BAND, HASH_SCD2, HASH_SCD1, EFF_DT,
         coalesce(lead(EFF_DT) OVER (PARTITION BY ENTITY_KEY ORDER BY EFF_DT) - 1, DATE '9999-12-31') AS DISC_DT,
         (coalesce(lead(EFF_DT) OVER (PARTITION BY ENTITY_KEY ORDER BY EFF_DT) - 1, DATE '9999-12-31')
            = DATE '9999-12-31') AS IS_CURRENT,
         CAST({batch} AS BIGINT) AS INS_BATCH_ID, CAST({batch} AS BIGINT) AS UPD_BATCH_ID,
         CAST(ver AS INTEGER) AS VERSION_NUM
  FROM versions{n}
)"""


def sql_dim_history(name: str = "dim", cutoff: dt.date | None = None, batch: int = BATCH1, n: str = "") -> str:
    where = "" if cutoff is None else f"WHERE o_orderdate <= TIMESTAMP '{cutoff.isoformat()} 00:00:00'"
    return SQL_DAILY.format(n=n or name, where=where, name=name, batch=batch).strip()


def sql_snapshot_source(name: str, day: dt.date | None, batch: int, stamp_day: dt.date | None = None) -> str:
    stamp = stamp_day or day
    where = "" if day is None else f"WHERE o_orderdate <= TIMESTAMP '{day.isoformat()} 00:00:00'"
    return f"""
{name} AS (
  SELECT md5(coalesce(CAST(o_custkey AS VARCHAR), '') || '-' || '{stamp.isoformat()}') AS ENTITY_SK,
         o_custkey AS ENTITY_KEY, o_orderstatus AS STATUS, o_orderpriority AS PRIORITY,
         CAST(FLOOR(o_totalprice / 100000) AS INTEGER) AS PRICE_BAND,
         md5(coalesce(CAST(o_orderstatus AS VARCHAR), '')) AS HASH_SCD2,
         md5(coalesce(CAST(o_orderpriority AS VARCHAR), '') || '||' ||
             coalesce(CAST(CAST(FLOOR(o_totalprice / 100000) AS INTEGER) AS VARCHAR), '')) AS HASH_SCD1,
         DATE '{stamp.isoformat()}' AS EFF_DT, DATE '9999-12-31' AS DISC_DT, true AS IS_CURRENT,
         CAST({batch} AS BIGINT) AS INS_BATCH_ID, CAST({batch} AS BIGINT) AS UPD_BATCH_ID
  FROM orders {where}
  QUALIFY row_number() OVER (PARTITION BY o_custkey ORDER BY o_orderdate DESC NULLS FIRST,
                                                           o_orderkey DESC NULLS FIRST) = 1
)""".strip()


# ----------------------------------------------------------------------------- CDC log

def cdc_log(spark, sf) -> DataFrame:
    e = t(spark, sf, "events")
    signup = F.col("event_type") == F.lit("signup")
    return e.select(
        F.col("user_id").alias("USER_KEY"),
        F.when(signup, F.get_json_object("props", "$.k").cast("bigint")).otherwise(F.col("user_id"))
         .alias("BEFORE_KEY"),
        F.col("ts").alias("CAPTURE_TS"),
        F.col("event_id").alias("LOG_ID"),
        F.when(F.col("event_type") == F.lit("error"), F.lit("D")).otherwise(F.lit("U")).alias("CAPTURE_ACTION"),
        F.when(signup, F.lit("Y")).otherwise(F.lit("N")).alias("PRIMARY_KEY_CHANGE"),
        F.col("event_type").alias("EVENT_TYPE"),
        F.col("value").cast("decimal(18,2)").alias("AMOUNT"))


SQL_CDC_LOG = """
cdc_log AS (
  SELECT user_id AS USER_KEY,
         CASE WHEN event_type = 'signup' THEN CAST(json_extract_string(props, '$.k') AS BIGINT) ELSE user_id END AS BEFORE_KEY,
         ts AS CAPTURE_TS, event_id AS LOG_ID,
         CASE WHEN event_type = 'error' THEN 'D' ELSE 'U' END AS CAPTURE_ACTION,
         CASE WHEN event_type = 'signup' THEN 'Y' ELSE 'N' END AS PRIMARY_KEY_CHANGE,
         event_type AS EVENT_TYPE, CAST(value AS DECIMAL(18,2)) AS AMOUNT
  FROM events
)""".strip()


# ----------------------------------------------------------------------------- staging loads

def staging_loads(spark, sf) -> DataFrame:
    """orders as a snapshot staging table: one load per order year."""
    o = t(spark, sf, "orders")
    return o.select(
        F.col("o_custkey").alias("ENTITY_KEY"), F.col("o_orderkey").alias("SRC_ORDERKEY"),
        F.col("o_orderstatus").alias("STATUS"), F.col("o_orderpriority").alias("PRIORITY"),
        F.col("o_totalprice").cast("decimal(18,2)").alias("AMOUNT"),
        F.col("o_orderdate").alias("SYS_LAST_UPDATE_DTM"),
        F.date_trunc("year", F.col("o_orderdate")).cast("timestamp_ntz").alias("STG_INSERT_TIMESTAMP"))


SQL_STAGING = """
staging AS (
  SELECT o_custkey AS ENTITY_KEY, o_orderkey AS SRC_ORDERKEY, o_orderstatus AS STATUS,
         o_orderpriority AS PRIORITY, CAST(o_totalprice AS DECIMAL(18,2)) AS AMOUNT,
         o_orderdate AS SYS_LAST_UPDATE_DTM,
         CAST(date_trunc('year', o_orderdate) AS TIMESTAMP) AS STG_INSERT_TIMESTAMP
  FROM orders
)""".strip()


def batch_literal(ts: dt.datetime):
    return batch_id(lit(ts))
