"""Registered queries: aggregates, sorts/limits, set operations, changed keys, lifecycle
facts and hashes (G1-G8, S1-S3, U1-U3, K1-K3, F1-F2, H1-H5, C3, A15)."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import functions as F

from tidemark.functions.literals import lit
from tidemark.functions.hashing import (
    NO_SCD2_TAGGED, PACKAGE_NULL_TOKEN, hash_change, hash_full, hash_scd1, hash_scd2, surrogate_key,
)
from tidemark.operators.delta import KeySource, changed_keys, enrich_with_retry, incremental_star, with_reprocess
from tidemark.operators.joins import star_join
from tidemark.operators.lifecycle import LifecycleSpec, dq_score, lifecycle_events
from tidemark.operators.merge import propagate_deletes
from tidemark.plans import standins as S
from tidemark.plans.q_joins import SQL_ROLLUP, order_rollup, star_left_join
from tidemark.plans.registry import query
from tidemark.sources.sinks import cut_lineage
from tidemark.spec import TableSpec


@query("rollup_child", sql=f"WITH {SQL_ROLLUP} SELECT * FROM rollup")
def rollup_child(spark, sf):
    return order_rollup(spark, sf)


@query("table_counts", sql="""
SELECT 'orders' AS TABLE_NAME, CAST(count(*) AS BIGINT) AS ROW_COUNT, max(o_orderdate) AS MAX_TS FROM orders
UNION ALL SELECT 'lineitem', CAST(count(*) AS BIGINT), max(l_shipdate) FROM lineitem
UNION ALL SELECT 'events', CAST(count(*) AS BIGINT), max(ts) FROM events
UNION ALL SELECT 'customer', CAST(count(*) AS BIGINT), CAST(NULL AS TIMESTAMP) FROM customer""")
def table_counts(spark, sf):
    parts = [("orders", "o_orderdate"), ("lineitem", "l_shipdate"), ("events", "ts"), ("customer", None)]
    out = None
    for name, ts in parts:
        df = S.t(spark, sf, name)
        mx = F.max(ts) if ts else F.lit(None).cast("timestamp_ntz")
        a = df.agg(F.lit(name).alias("TABLE_NAME"), F.count(F.lit(1)).cast("bigint").alias("ROW_COUNT"),
                   mx.alias("MAX_TS"))
        out = a if out is None else out.unionByName(a)
    return out


DIM_FULL = f"WITH {S.sql_dim_history('dim', None, S.BATCH2)}"


@query("conditional_counts", sql=DIM_FULL + """
SELECT CAST(count(*) AS BIGINT) AS TOTAL_ROWS,
       CAST(count(*) FILTER (WHERE IS_CURRENT) AS BIGINT) AS CURRENT_ROWS,
       CAST(count(*) FILTER (WHERE NOT IS_CURRENT) AS BIGINT) AS HISTORICAL_ROWS,
       CAST(count(HASH_SCD2) AS BIGINT) AS HASH_SCD2_POPULATED,
       CAST(count(DISTINCT HASH_SCD1) AS BIGINT) AS DISTINCT_HASH_SCD1,
       CAST(sum(CASE WHEN STATUS = 'F' THEN 1 ELSE 0 END) AS BIGINT) AS FULFILLED_VERSIONS,
       CAST(count(DISTINCT ENTITY_KEY) AS BIGINT) AS KEYS
FROM dim""")
def conditional_counts(spark, sf):
    d = S.dim_history(spark, sf, None, S.BATCH2)
    return d.agg(F.count(F.lit(1)).cast("bigint").alias("TOTAL_ROWS"),
                 F.count_if(F.col("IS_CURRENT")).cast("bigint").alias("CURRENT_ROWS"),
                 F.count_if(~F.col("IS_CURRENT")).cast("bigint").alias("HISTORICAL_ROWS"),
                 F.count("HASH_SCD2").cast("bigint").alias("HASH_SCD2_POPULATED"),
                 F.countDistinct("HASH_SCD1").cast("bigint").alias("DISTINCT_HASH_SCD1"),
                 F.sum(F.when(F.col("STATUS") == "F", 1).otherwise(0)).cast("bigint").alias("FULFILLED_VERSIONS"),
                 F.countDistinct("ENTITY_KEY").cast("bigint").alias("KEYS"))


@query("version_listing", sql=DIM_FULL + """
SELECT ENTITY_KEY, VERSION_NUM, EFF_DT, DISC_DT, IS_CURRENT, STATUS, PRIORITY FROM dim
ORDER BY ENTITY_KEY, EFF_DT""")
def version_listing(spark, sf):
    d = S.dim_history(spark, sf, None, S.BATCH2)
    return d.select("ENTITY_KEY", "VERSION_NUM", "EFF_DT", "DISC_DT", "IS_CURRENT", "STATUS", "PRIORITY") \
        .orderBy("ENTITY_KEY", "EFF_DT")


@query("sample_current", sql=DIM_FULL + """
SELECT ENTITY_KEY, STATUS, PRIORITY, EFF_DT FROM dim WHERE IS_CURRENT AND STATUS = 'O'
ORDER BY EFF_DT DESC, ENTITY_KEY LIMIT 10""")
def sample_current(spark, sf):
    d = S.dim_history(spark, sf, None, S.BATCH2)
    return (d.filter(F.col("IS_CURRENT") & (F.col("STATUS") == "O"))
             .select("ENTITY_KEY", "STATUS", "PRIORITY", "EFF_DT")
             .orderBy(F.col("EFF_DT").desc(), F.col("ENTITY_KEY")).limit(10))


@query("latest_one", sql="""
SELECT event_id, ts, user_id, event_type FROM events ORDER BY ts DESC NULLS FIRST, event_id DESC LIMIT 1""")
def latest_one(spark, sf):
    e = S.t(spark, sf, "events").select("event_id", "ts", "user_id", "event_type")
    return e.orderBy(F.col("ts").desc_nulls_first(), F.col("event_id").desc()).limit(1)


# ----------------------------------------------------------------------------- K1-K3

FIRST_RUN = dt.datetime(2001, 1, 1)   # position of the target's previous run


def first_run_target(spark, sf):
    """The customer-level target as written by the previous run: per customer, the
    latest order time and the latest ship time it had absorbed (its per-source marks)."""
    o = S.t(spark, sf, "orders").filter(F.col("o_orderdate") < lit(FIRST_RUN))
    li = S.t(spark, sf, "lineitem")
    lo = o.groupBy("o_custkey").agg(F.max("o_orderdate").alias("LAST_ORDER_TS"))
    ls = (li.join(o.select(F.col("o_orderkey").alias("l_orderkey"), "o_custkey"), "l_orderkey")
          .groupBy("o_custkey").agg(F.max("l_shipdate").alias("LAST_SHIP_TS")))
    return (S.t(spark, sf, "customer").select(F.col("c_custkey").alias("o_custkey"))
            .join(lo, "o_custkey", "left").join(ls, "o_custkey", "left")
            .withColumn("LAST_SUPPLY_TS", F.lit(None).cast("timestamp_ntz")))


SQL_CHANGED = f"""target AS (
  SELECT c.c_custkey, lo.LAST_ORDER_TS, ls.LAST_SHIP_TS, CAST(NULL AS TIMESTAMP) AS LAST_SUPPLY_TS
  FROM customer c
  LEFT JOIN (SELECT o_custkey, max(o_orderdate) AS LAST_ORDER_TS FROM orders
             WHERE o_orderdate < TIMESTAMP '{FIRST_RUN}' GROUP BY o_custkey) lo ON c.c_custkey = lo.o_custkey
  LEFT JOIN (SELECT o.o_custkey, max(l.l_shipdate) AS LAST_SHIP_TS FROM lineitem l JOIN orders o ON l.l_orderkey = o.o_orderkey
             WHERE o.o_orderdate < TIMESTAMP '{FIRST_RUN}' GROUP BY o.o_custkey) ls ON c.c_custkey = ls.o_custkey
),
changed AS (
  SELECT o_custkey AS CUST_KEY FROM orders WHERE o_orderdate > (SELECT max(LAST_ORDER_TS) FROM target)
  UNION
  SELECT o.o_custkey FROM lineitem l JOIN orders o ON l.l_orderkey = o.o_orderkey
  WHERE l.l_shipdate > (SELECT max(LAST_SHIP_TS) FROM target)
  UNION
  SELECT s_suppkey FROM supplier WHERE CAST(NULL AS TIMESTAMP) > (SELECT max(LAST_SUPPLY_TS) FROM target)
)"""


def _changed(spark, sf):
    from tidemark.operators.delta import target_mark
    o = S.t(spark, sf, "orders")
    li = S.t(spark, sf, "lineitem")
    tgt = first_run_target(spark, sf)
    bridge = o.select(F.col("o_orderkey").alias("l_orderkey"), "o_custkey")
    branches = [
        KeySource(o, [F.col("o_custkey").alias("CUST_KEY")], "o_orderdate", target_mark(tgt, "LAST_ORDER_TS")),
        KeySource(li, [F.col("o_custkey").alias("CUST_KEY")], "l_shipdate", target_mark(tgt, "LAST_SHIP_TS"),
                  bridge=(bridge, ["l_orderkey"])),
        # a source whose mark in the target is NULL contributes nothing (strict `>` against NULL)
        KeySource(S.t(spark, sf, "supplier").withColumn("_ts", F.lit(None).cast("timestamp_ntz")),
                  [F.col("s_suppkey").alias("CUST_KEY")], "_ts", target_mark(tgt, "LAST_SUPPLY_TS")),
    ]
    return changed_keys(branches, strict=True)


@query("changed_keys", sql=f"WITH {SQL_CHANGED} SELECT CUST_KEY FROM changed")
def q_changed_keys(spark, sf):
    return _changed(spark, sf)


@query("incremental_star", sql=f"""
WITH {SQL_CHANGED}, {SQL_ROLLUP},
line_rollup AS (
  SELECT o.o_custkey, CAST(count(*) AS BIGINT) AS LINE_COUNT, sum(CAST(l.l_quantity AS DECIMAL(18,2))) AS TOTAL_QTY
  FROM lineitem l JOIN orders o ON l.l_orderkey = o.o_orderkey GROUP BY o.o_custkey
)
SELECT c.c_custkey, c.c_name, r.ORDER_COUNT, r.LAST_ORDER_DATE, r.TOTAL_PRICE, lr.LINE_COUNT,
       CAST(lr.TOTAL_QTY AS DECIMAL(38,2)) AS TOTAL_QTY, n.n_name
FROM (SELECT * FROM customer WHERE c_custkey IN (SELECT CUST_KEY FROM changed)) c
LEFT JOIN (SELECT * FROM rollup WHERE o_custkey IN (SELECT CUST_KEY FROM changed)) r ON c.c_custkey = r.o_custkey
LEFT JOIN (SELECT * FROM line_rollup WHERE o_custkey IN (SELECT CUST_KEY FROM changed)) lr ON c.c_custkey = lr.o_custkey
LEFT JOIN nation n ON c.c_nationkey = n.n_nationkey""")
def q_incremental_star(spark, sf):
    """K2: the driving table and every customer-keyed source are semi-joined to the changed
    keys before the star join and before they are aggregated."""
    keys = cut_lineage(_changed(spark, sf).withColumnRenamed("CUST_KEY", "c_custkey"))
    c = S.t(spark, sf, "customer").select("c_custkey", "c_name", "c_nationkey")
    changed = S.t(spark, sf, "orders").join(keys.withColumnRenamed("c_custkey", "o_custkey"), "o_custkey", "left_semi")
    r = order_rollup(spark, sf, changed).withColumnRenamed("o_custkey", "c_custkey") \
        .select("c_custkey", "ORDER_COUNT", "LAST_ORDER_DATE", "TOTAL_PRICE")
    # lines of the changed customers' orders only: keys -> orders -> lines, then the aggregate
    o = changed.select(F.col("o_orderkey").alias("l_orderkey"), F.col("o_custkey").alias("c_custkey"))
    li = S.t(spark, sf, "lineitem").join(o.select("l_orderkey"), "l_orderkey", "left_semi").groupBy("l_orderkey").agg(
        F.count(F.lit(1)).alias("_lines"), F.sum(F.col("l_quantity").cast("decimal(18,2)")).alias("_qty"))
    lr = li.join(o, "l_orderkey").groupBy("c_custkey").agg(
        F.sum("_lines").cast("bigint").alias("LINE_COUNT"), F.sum("_qty").cast("decimal(38,2)").alias("TOTAL_QTY"))
    star = incremental_star(c, [(r, ["c_custkey"]), (lr, ["c_custkey"])], keys, ["c_custkey"], stage_keys=False)
    n = S.t(spark, sf, "nation").select(F.col("n_nationkey").alias("c_nationkey"), "n_name")
    return star.join(n, "c_nationkey", "left").select(
        "c_custkey", "c_name", "ORDER_COUNT", "LAST_ORDER_DATE", "TOTAL_PRICE", "LINE_COUNT", "TOTAL_QTY", "n_name")


@query("enrich_reprocess", sql=f"""
WITH first_run AS (
  SELECT c.c_custkey, r.FIRST_ORDER_DATE
  FROM customer c LEFT JOIN (SELECT o_custkey, min(o_orderdate) AS FIRST_ORDER_DATE FROM orders
                             WHERE o_orderdate <= TIMESTAMP '{S.D1} 00:00:00' GROUP BY o_custkey) r
    ON c.c_custkey = r.o_custkey
), new_keys AS (
  SELECT DISTINCT o_custkey AS c_custkey FROM orders WHERE o_orderdate > TIMESTAMP '{S.MID} 00:00:00'
), pending AS (
  SELECT DISTINCT f.c_custkey FROM first_run f
  WHERE f.FIRST_ORDER_DATE IS NULL AND f.c_custkey IN (SELECT o_custkey FROM orders)
    AND f.c_custkey NOT IN (SELECT c_custkey FROM new_keys)
)
SELECT c_custkey, 'NEW' AS PROCESS_TYPE, 'orders' AS LINEAGE FROM new_keys
UNION ALL SELECT c_custkey, 'REPROCESS', 'orders,customer' FROM pending""")
def q_enrich_reprocess(spark, sf):
    o = S.t(spark, sf, "orders")
    first = (o.filter(F.col("o_orderdate") <= lit(dt.datetime.combine(S.D1, dt.time())))
             .groupBy(F.col("o_custkey").alias("c_custkey")).agg(F.min("o_orderdate").alias("FIRST_ORDER_DATE")))
    target = S.t(spark, sf, "customer").select("c_custkey").join(first, "c_custkey", "left")
    delta_keys = o.filter(F.col("o_orderdate") > lit(dt.datetime.combine(S.MID, dt.time()))) \
        .select(F.col("o_custkey").alias("c_custkey"))
    keys = with_reprocess(delta_keys, target, "c_custkey", "FIRST_ORDER_DATE", o, "o_custkey", "c_custkey")
    # dynamic lineage text: the second table is named only when its lookup matched (P25)
    lineage = F.concat(F.lit("orders"), F.when(F.col("PROCESS_TYPE") == "REPROCESS", F.lit(",customer"))
                       .otherwise(F.lit("")))
    return keys.select("c_custkey", "PROCESS_TYPE", lineage.alias("LINEAGE"))


# Customers (lookup key: their nation, unknown where the balance is negative) were first loaded
# when the lookup held the nations of regions 0 and 1 only.
@query("enrich_retry", sql=f"""
WITH source AS (SELECT c_custkey, c_name, CASE WHEN c_acctbal >= 0 THEN c_nationkey END AS NATION_KEY FROM customer),
target AS (SELECT c_custkey, NATION_KEY, n_name AS NATION FROM source LEFT JOIN nation ON NATION_KEY = n_nationkey AND n_regionkey < 2),
new_keys AS (SELECT DISTINCT o_custkey AS c_custkey FROM orders WHERE o_orderdate > TIMESTAMP '{S.MID} 00:00:00'),
keys AS (
  SELECT c_custkey, 'NEW' AS PROCESS_TYPE FROM new_keys
  UNION ALL
  SELECT c_custkey, 'REPROCESS' FROM target
  WHERE NATION IS NULL AND NATION_KEY IN (SELECT n_nationkey FROM nation) AND c_custkey NOT IN (SELECT c_custkey FROM new_keys)
)
SELECT s.c_custkey, s.c_name, s.NATION_KEY, n.n_name, k.PROCESS_TYPE,
       CASE WHEN n.n_nationkey IS NULL THEN 'customer' ELSE 'customer,nation' END AS LINEAGE
FROM source s JOIN keys k USING (c_custkey) LEFT JOIN nation n ON s.NATION_KEY = n.n_nationkey""")
def q_enrich_retry(spark, sf):
    nation = S.t(spark, sf, "nation")
    source = S.t(spark, sf, "customer").select(
        "c_custkey", "c_name", F.when(F.col("c_acctbal") >= 0, F.col("c_nationkey")).alias("NATION_KEY"))
    known = nation.filter(F.col("n_regionkey") < 2).select(F.col("n_nationkey").alias("NATION_KEY"), F.col("n_name").alias("NATION"))
    target = source.join(known, "NATION_KEY", "left").select("c_custkey", "NATION_KEY", "NATION")
    delta_keys = S.t(spark, sf, "orders").filter(F.col("o_orderdate") > lit(dt.datetime.combine(S.MID, dt.time()))) \
        .select(F.col("o_custkey").alias("c_custkey"))
    keys = with_reprocess(delta_keys, target, "c_custkey", "NATION", nation, "n_nationkey", "NATION_KEY")
    return enrich_with_retry(source, keys, "c_custkey", nation, "NATION_KEY", "n_nationkey", ["n_name"],
                             names=("customer", "nation"))


# A star on a two-column key (order, supplier) with eleven branches: eight measures on the key
# itself, two dimensions of its parts, and one reached through a bridge (supplier -> nation).
STAR_FLAGS = ("R", "A", "N")
STAR_STATES = ("O", "F")
_STAR_CELLS = [(f, st) for f in STAR_FLAGS for st in STAR_STATES]


@query("star_composite", sql=f"""
WITH k AS (SELECT DISTINCT l_orderkey, l_suppkey FROM lineitem),
{", ".join(f"b{i} AS (SELECT l_orderkey, l_suppkey, CAST(count(*) AS BIGINT) AS LINES_{f}{st} FROM lineitem WHERE l_returnflag = '{f}' AND l_linestatus = '{st}' GROUP BY ALL)" for i, (f, st) in enumerate(_STAR_CELLS))},
ship AS (SELECT l_orderkey, l_suppkey, max(l_shipdate) AS LAST_SHIP FROM lineitem GROUP BY ALL),
qty AS (SELECT l_orderkey, l_suppkey, CAST(sum(CAST(l_quantity AS DECIMAL(18,2))) AS DECIMAL(28,2)) AS QTY FROM lineitem GROUP BY ALL)
SELECT k.*, {", ".join(f"LINES_{f}{st}" for f, st in _STAR_CELLS)}, LAST_SHIP, QTY, o_orderstatus, s_name, n_name
FROM k {" ".join(f"LEFT JOIN b{i} USING (l_orderkey, l_suppkey)" for i in range(len(_STAR_CELLS)))}
LEFT JOIN ship USING (l_orderkey, l_suppkey) LEFT JOIN qty USING (l_orderkey, l_suppkey)
LEFT JOIN orders ON o_orderkey = l_orderkey LEFT JOIN supplier ON s_suppkey = l_suppkey LEFT JOIN nation ON n_nationkey = s_nationkey""")
def q_star_composite(spark, sf):
    li = S.t(spark, sf, "lineitem").select("l_orderkey", "l_suppkey", "l_returnflag", "l_linestatus", "l_shipdate", "l_quantity")
    key = ["l_orderkey", "l_suppkey"]
    cells = [li.filter((F.col("l_returnflag") == f) & (F.col("l_linestatus") == st)).groupBy(*key)
             .agg(F.count(F.lit(1)).alias(f"LINES_{f}{st}")) for f, st in _STAR_CELLS]
    ship = li.groupBy(*key).agg(F.max("l_shipdate").alias("LAST_SHIP"))
    qty = li.groupBy(*key).agg(F.sum(F.col("l_quantity").cast("decimal(18,2)")).alias("QTY"))
    orders = S.t(spark, sf, "orders").select(F.col("o_orderkey").alias("l_orderkey"), "o_orderstatus")
    bridge = (S.t(spark, sf, "supplier").select(F.col("s_suppkey").alias("l_suppkey"), "s_name", F.col("s_nationkey").alias("n_nationkey"))
              .join(S.t(spark, sf, "nation").select("n_nationkey", "n_name"), "n_nationkey", "left").drop("n_nationkey"))
    # every branch on the composite key is grouped and joined in the same hash partitioning
    return star_join(li.select(*key).distinct(), [*[(b, key) for b in cells], (ship, key), (qty, key),
                                                  (orders, "l_orderkey"), (bridge, "l_suppkey")])


# ----------------------------------------------------------------------------- F1, F2

LIFE_SPEC = LifecycleSpec(key="ENTITY_KEY", eff="EFF_DT", status="EMPLOYEE_STATUS", job="PRIORITY",
                          division="PRICE_BAND", supervisor="STATUS", hire_date="HIRE_DATE", sk="ENTITY_SK",
                          source_system="SOURCE_SYSTEM", data_source="DIM_ENTITY")


def lifecycle_input(spark, sf):
    """The fact reads the dimension's non-deleted rows (P20): deletes are propagated to
    every version of a key (C3) and the fact drops those keys (trap T19)."""
    from tidemark.functions.expr import active_only
    d = cut_lineage(active_only(deleted_dim(spark, sf), "IS_DELETED"))     # read for the rows and the hire dates
    first = d.groupBy("ENTITY_KEY").agg(F.min("EFF_DT").alias("HIRE_DATE"))      # map-side, no key window
    status = F.when(F.col("STATUS") == "F", F.lit("TERM")).when(F.col("STATUS") == "P", F.lit("LOA")) \
        .otherwise(F.lit("ACTIVE"))
    return d.select("*", status.alias("EMPLOYEE_STATUS"), F.lit("ORDERS").alias("SOURCE_SYSTEM")) \
        .join(first, "ENTITY_KEY", "left")


def lifecycle(spark, sf):
    return lifecycle_events(lifecycle_input(spark, sf), LIFE_SPEC, batch=S.BATCH2, run_ts=S.RUN2)


# The events as rules over a version (v), its predecessor (p, none: first version) and the key's
# first version (f). The event labels in order of precedence, the tenure bands and
# the divisors.
LIFE_EVENTS = (
    ("HIRE", "p.VERSION_NUM IS NULL"),
    ("TERMINATION", "v.STATE = 'TERM' AND p.STATE <> 'TERM'"),
    ("LOA", "v.STATE = 'LOA' AND p.STATE <> 'LOA'"),
    ("RETURN", "p.STATE = 'LOA' AND v.STATE = 'ACTIVE'"),
    ("ORG_TRANSFER", "v.PRICE_BAND <> p.PRICE_BAND"),
    ("ROLE_CHANGE", "v.PRIORITY <> p.PRIORITY"),
    ("PROFILE_UPDATE", "true"),
)
LIFE_BANDS = "(0, 364, '<1 year'), (365, 1094, '1-3 years'), (1095, 1824, '3-5 years'), (1825, 1000000, '5+ years')"
_EVENT = "coalesce(" + ", ".join(f"CASE WHEN {test} THEN '{label}' END" for label, test in LIFE_EVENTS) + ")"
_STAMP = f"CAST({S.BATCH2} AS DECIMAL(18,0))"
_LOADED = f"TIMESTAMP '{S.RUN2.isoformat(sep=' ')}'"

SQL_LIFE = DIM_FULL + f""",
gone AS (SELECT o_custkey FROM (SELECT o_custkey, arg_max(o_orderstatus, (o_orderdate, o_orderkey)) AS s FROM orders GROUP BY o_custkey)
         WHERE s = 'F'),
version AS (
  SELECT *, CASE STATUS WHEN 'F' THEN 'TERM' WHEN 'P' THEN 'LOA' ELSE 'ACTIVE' END AS STATE FROM dim ANTI JOIN gone ON o_custkey = ENTITY_KEY
),
life AS (
  SELECT md5(concat(v.ENTITY_KEY, '-', v.EFF_DT)) AS LIFECYCLE_SK, v.ENTITY_SK AS EMPLOYEE_SK,
    v.ENTITY_KEY AS EMPLOYEE_EIN, v.EFF_DT AS EVENT_DATE, {_EVENT} AS EVENT_TYPE,
    CAST(extract(year FROM v.EFF_DT) AS INTEGER) AS EVENT_FISCAL_YEAR,
    CAST(extract(quarter FROM v.EFF_DT) AS INTEGER) AS EVENT_QUARTER,
    CAST(extract(month FROM v.EFF_DT) AS INTEGER) AS EVENT_MONTH,
    CAST(v.EFF_DT - f.EFF_DT AS INTEGER) AS TENURE_DAYS,
    CAST(round((v.EFF_DT - f.EFF_DT) / 30.44, 1) AS DECIMAL(10,1)) AS TENURE_MONTHS,
    CAST(round((v.EFF_DT - f.EFF_DT) / 365.25, 2) AS DECIMAL(10,2)) AS TENURE_YEARS, b.label AS TENURE_BAND,
    CAST(v.EFF_DT - p.EFF_DT AS INTEGER) AS DAYS_SINCE_LAST_EVENT,
    v.STATE = 'TERM' AND p.STATE IS DISTINCT FROM 'TERM' AS IS_TERMINATION,
    p.PRIORITY AS PREV_JOB_CODE, v.PRIORITY AS NEW_JOB_CODE,
    coalesce(v.PRIORITY > p.PRIORITY, false) AS IS_PROMOTION, coalesce(v.PRIORITY < p.PRIORITY, false) AS IS_LATERAL,
    p.PRICE_BAND AS PREV_DIVISION_NUMBER, v.PRICE_BAND AS NEW_DIVISION_NUMBER,
    coalesce(v.PRICE_BAND <> p.PRICE_BAND, false) AS IS_DIVISION_CHANGE,
    p.STATUS AS PREV_SUPERVISOR_EIN, v.STATUS AS NEW_SUPERVISOR_EIN, CAST(NULL AS BOOLEAN) AS IS_VOLUNTARY_TERM,
    CAST(NULL AS VARCHAR) AS TERM_REASON_CODE, CAST(NULL AS VARCHAR) AS TERM_REASON_DESC,
    CAST(100 AS DECIMAL(5,2)) AS DQ_SCORE, 'PASSED' AS DQ_STATUS,     -- no version lacks a key, a date or a surrogate key
    {_STAMP} AS INS_BATCH_ID, {_STAMP} AS UPD_BATCH_ID, 'ORDERS' AS SOURCE_SYSTEM, 'DIM_ENTITY' AS PRIMARY_DATA_SOURCE,
    {_LOADED} AS CDM_INSERT_TIMESTAMP, {_LOADED} AS CDM_UPDATE_TIMESTAMP,
    md5(concat_ws('|', v.ENTITY_KEY, v.EFF_DT, v.PRIORITY, v.PRICE_BAND, v.STATUS, v.STATE)) AS HASH_CHANGE,
    md5(concat_ws('|', v.ENTITY_KEY, v.EFF_DT, v.ENTITY_SK, v.PRIORITY, v.PRICE_BAND, v.STATUS, v.STATE, f.EFF_DT)) AS HASH_FULL,
    'INSERT' AS OPERATION_TYPE
  FROM version v
  JOIN version f ON f.ENTITY_KEY = v.ENTITY_KEY AND f.VERSION_NUM = 1
  LEFT JOIN version p ON p.ENTITY_KEY = v.ENTITY_KEY AND p.VERSION_NUM = v.VERSION_NUM - 1
  JOIN (VALUES {LIFE_BANDS}) b(lo, hi, label) ON v.EFF_DT - f.EFF_DT BETWEEN lo AND hi
)"""


@query("lifecycle_events", headline=True, sql=SQL_LIFE + "\nSELECT * FROM life")
def q_lifecycle(spark, sf):
    return lifecycle(spark, sf)


@query("tenure_measures", sql=SQL_LIFE + """
SELECT EMPLOYEE_EIN, EVENT_DATE, TENURE_DAYS, TENURE_MONTHS, TENURE_YEARS, TENURE_BAND, DAYS_SINCE_LAST_EVENT FROM life""")
def q_tenure(spark, sf):
    return lifecycle(spark, sf).select("EMPLOYEE_EIN", "EVENT_DATE", "TENURE_DAYS", "TENURE_MONTHS", "TENURE_YEARS",
                                       "TENURE_BAND", "DAYS_SINCE_LAST_EVENT")


@query("event_flags", sql=SQL_LIFE + """
SELECT EMPLOYEE_EIN, EVENT_DATE, EVENT_TYPE, IS_TERMINATION, IS_PROMOTION, IS_LATERAL, IS_DIVISION_CHANGE FROM life""")
def q_event_flags(spark, sf):
    return lifecycle(spark, sf).select("EMPLOYEE_EIN", "EVENT_DATE", "EVENT_TYPE", "IS_TERMINATION", "IS_PROMOTION",
                                       "IS_LATERAL", "IS_DIVISION_CHANGE")


@query("dq_score", sql=f"""
WITH {SQL_ROLLUP},
open_orders AS (SELECT o_custkey, CAST(count(*) AS BIGINT) AS OPEN_ORDERS FROM orders WHERE o_orderstatus = 'O' GROUP BY o_custkey)
SELECT c.c_custkey, r.ORDER_COUNT, oo.OPEN_ORDERS,
       CAST(CASE WHEN c.c_custkey IS NOT NULL AND r.ORDER_COUNT IS NOT NULL AND oo.OPEN_ORDERS IS NOT NULL
                 THEN 100.00 ELSE 0.00 END AS DECIMAL(5,2)) AS DQ_SCORE,
       CASE WHEN c.c_custkey IS NOT NULL AND r.ORDER_COUNT IS NOT NULL AND oo.OPEN_ORDERS IS NOT NULL
            THEN 'PASSED' ELSE 'FAILED' END AS DQ_STATUS
FROM customer c LEFT JOIN rollup r ON c.c_custkey = r.o_custkey LEFT JOIN open_orders oo ON c.c_custkey = oo.o_custkey""")
def q_dq_score(spark, sf):
    s = star_left_join(spark, sf).select("c_custkey", "ORDER_COUNT", "OPEN_ORDERS")
    return dq_score(s, ["c_custkey", "ORDER_COUNT", "OPEN_ORDERS"])


# ----------------------------------------------------------------------------- H1-H5

_NULLED = "CASE WHEN c_nationkey < 10 THEN NULL ELSE c_mktsegment END"


@query("surrogate_key", sql=f"""
SELECT c_custkey, md5(coalesce(CAST(c_custkey AS VARCHAR), '') || '-' || coalesce(CAST(c_nationkey AS VARCHAR), '')
                      || '-' || coalesce(CAST({_NULLED} AS VARCHAR), '')) AS CUSTOMER_SK
FROM customer""")
def q_surrogate_key(spark, sf):
    c = S.t(spark, sf, "customer")
    nulled = F.when(F.col("c_nationkey") < 10, F.lit(None)).otherwise(F.col("c_mktsegment"))
    return c.select("c_custkey", surrogate_key("c_custkey", "c_nationkey", nulled).alias("CUSTOMER_SK"))


@query("surrogate_key_nulltoken", sql=f"""
SELECT c_custkey, md5(coalesce(CAST(c_custkey AS VARCHAR), '{PACKAGE_NULL_TOKEN}') || '-' ||
                      coalesce(CAST(c_nationkey AS VARCHAR), '{PACKAGE_NULL_TOKEN}') || '-' ||
                      coalesce(CAST({_NULLED} AS VARCHAR), '{PACKAGE_NULL_TOKEN}')) AS CUSTOMER_SK
FROM customer""")
def q_surrogate_key_nulltoken(spark, sf):
    c = S.t(spark, sf, "customer")
    nulled = F.when(F.col("c_nationkey") < 10, F.lit(None)).otherwise(F.col("c_mktsegment"))
    return c.select("c_custkey", surrogate_key("c_custkey", "c_nationkey", nulled, null_token=PACKAGE_NULL_TOKEN)
                    .alias("CUSTOMER_SK"))


ORDER_SPEC = TableSpec(
    columns=("ORDER_PK", "o_orderkey", "o_custkey", "o_orderstatus", "PRICE", "o_orderdate", "o_orderpriority",
             "LOAD_TS"),
    natural_keys=("o_orderkey",), audit=("LOAD_TS",))


@query("hash_change", sql="""
WITH x AS (
  SELECT md5(CAST(o_orderkey AS VARCHAR)) AS ORDER_PK, o_orderkey, o_custkey, o_orderstatus,
         CAST(o_totalprice AS DECIMAL(18,2)) AS PRICE, o_orderdate, o_orderpriority, o_orderdate AS LOAD_TS
  FROM orders
)
SELECT o_orderkey,
  md5(coalesce(CAST(o_custkey AS VARCHAR), '') || '|' || coalesce(CAST(o_orderstatus AS VARCHAR), '') || '|' ||
      coalesce(CAST(PRICE AS VARCHAR), '') || '|' || coalesce(CAST(o_orderdate AS VARCHAR), '') || '|' ||
      coalesce(CAST(o_orderpriority AS VARCHAR), '')) AS HASH_CHANGE
FROM x""")
def q_hash_change(spark, sf):
    return _order_hashes(spark, sf).select("o_orderkey", "HASH_CHANGE")


@query("hash_full", sql="""
WITH x AS (
  SELECT md5(CAST(o_orderkey AS VARCHAR)) AS ORDER_PK, o_orderkey, o_custkey, o_orderstatus,
         CAST(o_totalprice AS DECIMAL(18,2)) AS PRICE, o_orderdate, o_orderpriority
  FROM orders
)
SELECT o_orderkey,
  md5(coalesce(CAST(ORDER_PK AS VARCHAR), '') || '|' || coalesce(CAST(o_orderkey AS VARCHAR), '') || '|' ||
      coalesce(CAST(o_custkey AS VARCHAR), '') || '|' || coalesce(CAST(o_orderstatus AS VARCHAR), '') || '|' ||
      coalesce(CAST(PRICE AS VARCHAR), '') || '|' || coalesce(CAST(o_orderdate AS VARCHAR), '') || '|' ||
      coalesce(CAST(o_orderpriority AS VARCHAR), '')) AS HASH_FULL
FROM x""")
def q_hash_full(spark, sf):
    return _order_hashes(spark, sf).select("o_orderkey", "HASH_FULL")


def _order_hashes(spark, sf):
    o = S.t(spark, sf, "orders")
    x = o.select(F.md5(F.col("o_orderkey").cast("string")).alias("ORDER_PK"), "o_orderkey", "o_custkey",
                 "o_orderstatus", F.col("o_totalprice").cast("decimal(18,2)").alias("PRICE"), "o_orderdate",
                 "o_orderpriority", F.col("o_orderdate").alias("LOAD_TS"))
    return x.select("*", hash_change(ORDER_SPEC).alias("HASH_CHANGE"), hash_full(ORDER_SPEC).alias("HASH_FULL"))


ORDER_SCD_SPEC = TableSpec(columns=("ORDER_KEY", "STATUS", "PRIORITY", "PRICE_BAND"), scd2=("STATUS",),
                           scd1=("PRIORITY", "PRICE_BAND"))


@query("hash_scd", sql=f"""
SELECT o_orderkey AS ORDER_KEY, md5(coalesce(o_orderstatus, '')) AS HASH_SCD2,
       md5(coalesce(o_orderpriority, '') || '||' || coalesce(CAST(CAST(floor(o_totalprice / 100000) AS INTEGER) AS VARCHAR), '')) AS HASH_SCD1,
       md5('{NO_SCD2_TAGGED}') AS HASH_UNTAGGED FROM orders""")
def q_hash_scd(spark, sf):
    o = S.t(spark, sf, "orders").select(
        F.col("o_orderkey").alias("ORDER_KEY"), F.col("o_orderstatus").alias("STATUS"),
        F.col("o_orderpriority").alias("PRIORITY"), F.floor(F.col("o_totalprice") / 100000).cast("int").alias("PRICE_BAND"))
    return o.select("ORDER_KEY", hash_scd2(ORDER_SCD_SPEC).alias("HASH_SCD2"), hash_scd1(ORDER_SCD_SPEC).alias("HASH_SCD1"),
                    hash_scd2(TableSpec(columns=("ORDER_KEY",))).alias("HASH_UNTAGGED"))


# ----------------------------------------------------------------------------- C3, A15

def deleted_dim(spark, sf):
    """The full-history dimension with IS_DELETED propagated from the source (C3): a key
    whose latest order is fulfilled counts as deleted at the source."""
    from tidemark.plans.q_changes import dedup_latest
    d = S.dim_history(spark, sf, None, S.BATCH2).withColumn("IS_DELETED", F.lit(False))
    deleted = dedup_latest(spark, sf).filter(F.col("o_orderstatus") == "F") \
        .select(F.col("o_custkey").alias("ENTITY_KEY"))
    return propagate_deletes(d, deleted, "ENTITY_KEY")


@query("propagate_deletes", sql=DIM_FULL + """,
latest AS (
  SELECT o_custkey, o_orderstatus FROM orders
  QUALIFY row_number() OVER (PARTITION BY o_custkey ORDER BY o_orderdate DESC NULLS FIRST, o_orderkey DESC NULLS FIRST) = 1
)
SELECT d.ENTITY_SK, d.ENTITY_KEY, d.EFF_DT, d.DISC_DT, d.IS_CURRENT,
       CASE WHEN EXISTS (SELECT 1 FROM latest l WHERE l.o_custkey = d.ENTITY_KEY AND l.o_orderstatus = 'F')
            THEN true ELSE false END AS IS_DELETED
FROM dim d""")
def q_propagate_deletes(spark, sf):
    return deleted_dim(spark, sf).select("ENTITY_SK", "ENTITY_KEY", "EFF_DT", "DISC_DT", "IS_CURRENT", "IS_DELETED")


@query("dim_backfill", sql=DIM_FULL + f"""
SELECT md5(coalesce(CAST(d.ENTITY_KEY AS VARCHAR), '') || '-' || coalesce(CAST(d.EFF_DT AS VARCHAR), '')) AS ENTITY_KEY_SK,
       d.ENTITY_KEY, substr(c.c_name, 1, 25) AS CUSTOMER_NAME, c.c_mktsegment AS SEGMENT, d.STATUS, d.PRIORITY,
       d.EFF_DT, d.DISC_DT, d.DISC_DT = DATE '9999-12-31' AS IS_CURRENT,
       md5(coalesce(CAST(d.STATUS AS VARCHAR), '')) AS HASH_SCD2,
       md5(coalesce(CAST(c.c_mktsegment AS VARCHAR), '') || '||' || coalesce(CAST(d.PRIORITY AS VARCHAR), '')) AS HASH_SCD1,
       md5(coalesce(CAST(d.ENTITY_KEY AS VARCHAR), '') || '|' || coalesce(CAST(substr(c.c_name, 1, 25) AS VARCHAR), '') || '|' ||
           coalesce(CAST(c.c_mktsegment AS VARCHAR), '') || '|' || coalesce(CAST(d.STATUS AS VARCHAR), '') || '|' ||
           coalesce(CAST(d.PRIORITY AS VARCHAR), '')) AS HASH_FULL,
       'HISTORICAL' AS OPERATION_TYPE
FROM dim d LEFT JOIN customer c ON d.ENTITY_KEY = c.c_custkey""")
def q_dim_backfill(spark, sf):
    from tidemark.operators.scd import backfill_dim
    d = S.dim_history(spark, sf, None, S.BATCH2)
    c = S.t(spark, sf, "customer")
    spec = TableSpec(columns=("ENTITY_KEY", "CUSTOMER_NAME", "SEGMENT", "STATUS", "PRIORITY"),
                     scd2=("STATUS",), scd1=("PRIORITY", "SEGMENT"))
    cols = [("ENTITY_KEY", "ENTITY_KEY", None, None), ("c_name", "CUSTOMER_NAME", "string", 25),
            ("c_mktsegment", "SEGMENT", None, None), ("STATUS", "STATUS", None, None),
            ("PRIORITY", "PRIORITY", None, None)]
    return backfill_dim(d, c, "ENTITY_KEY", "c_custkey", cols, spec)

