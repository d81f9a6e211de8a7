"""Registered queries: sources and sinks."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemark.functions.literals import lit
from tidemark.operators.merge import ACTION, append
from tidemark.plans import standins as S
from tidemark.plans.q_joins import star_left_join
from tidemark.plans.registry import query
from tidemark.sources.sinks import AUDIT_SCHEMA, append_run_audit, conform, contract_violations
from tidemark.sources.tables import lookup_values

# Inline status lookup (code, label, sort order).
STATUS_ROWS = [("F", "Fulfilled", 1), ("O", "Open", 2), ("P", "Partial", 3)]


@query("values_lookup", sql="""
WITH lk AS (SELECT * FROM (VALUES ('F', 'Fulfilled', 1), ('O', 'Open', 2), ('P', 'Partial', 3)) AS v(STATUS_CODE, STATUS_LABEL, SORT_ORDER))
SELECT o.o_orderkey, o.o_orderstatus, lk.STATUS_LABEL, CAST(lk.SORT_ORDER AS INTEGER) AS SORT_ORDER
FROM orders o LEFT JOIN lk ON o.o_orderstatus = lk.STATUS_CODE""")
def values_lookup(spark, sf):
    lk = lookup_values(spark, STATUS_ROWS, "STATUS_CODE string, STATUS_LABEL string, SORT_ORDER int")
    o = S.t(spark, sf, "orders").select("o_orderkey", "o_orderstatus")
    return o.join(lk, o.o_orderstatus == lk.STATUS_CODE, "left").select(
        "o_orderkey", "o_orderstatus", "STATUS_LABEL", "SORT_ORDER")


@query("append_only", sql=f"""
SELECT o_orderkey, o_custkey, o_orderdate, 'unchanged' AS MERGE_ACTION FROM orders WHERE o_orderdate <= TIMESTAMP '{S.D1} 00:00:00'
UNION ALL
SELECT o_orderkey, o_custkey, o_orderdate, 'insert' FROM orders WHERE o_orderdate > TIMESTAMP '{S.D1} 00:00:00'""")
def append_only(spark, sf):
    o = S.t(spark, sf, "orders").select("o_orderkey", "o_custkey", "o_orderdate")
    cut = lit(dt.datetime.combine(S.D1, dt.time()))
    return append(o.filter(F.col("o_orderdate") <= cut), o.filter(F.col("o_orderdate") > cut)) \
        .withColumnRenamed(ACTION, "MERGE_ACTION")


@query("schema_append", sql="""
SELECT c_custkey AS PARTY_KEY, c_name AS PARTY_NAME, CAST(c_nationkey AS BIGINT) AS NATION_KEY,
       CAST(c_acctbal AS DECIMAL(18,2)) AS BALANCE, TIMESTAMP '2025-01-01 06:30:00' AS LOADED,
       CAST(c_custkey AS BIGINT) AS SEQ, CAST(NULL AS VARCHAR) AS ADDRESS
FROM customer
UNION ALL
SELECT s_suppkey, s_name, CAST(s_nationkey AS BIGINT), CAST(floor(s_acctbal) AS DECIMAL(18,2)),
       CAST(DATE '2025-01-02' AS TIMESTAMP), CAST(s_suppkey % 1000 AS BIGINT), s_name FROM supplier""")
def schema_append(spark, sf):
    target = S.t(spark, sf, "customer").select(F.col("c_custkey").alias("PARTY_KEY"),
                                               F.col("c_name").alias("PARTY_NAME"),
                                               F.col("c_nationkey").cast("int").alias("NATION_KEY"),
                                               F.col("c_acctbal").cast("decimal(18,2)").alias("BALANCE"),
                                               lit(dt.datetime(2025, 1, 1, 6, 30)).alias("LOADED"),
                                               F.col("c_custkey").cast("bigint").alias("SEQ"))
    source = S.t(spark, sf, "supplier").select(F.col("s_suppkey").alias("PARTY_KEY"),
                                               F.col("s_name").alias("PARTY_NAME"),
                                               F.col("s_nationkey").cast("bigint").alias("NATION_KEY"),  # wider
                                               F.floor("s_acctbal").cast("int").alias("BALANCE"),          # narrower
                                               F.lit(dt.date(2025, 1, 2)).alias("LOADED"),                 # narrower
                                               (F.col("s_suppkey") % 1000).cast("smallint").alias("SEQ"),  # narrower
                                               F.col("s_name").alias("ADDRESS"))                           # new
    t2, s2 = conform(target, source)
    return t2.unionByName(s2)


CONTRACT = T.StructType([
    T.StructField("c_custkey", T.LongType(), False),
    T.StructField("ORDER_COUNT", T.LongType(), False),
    T.StructField("LINE_COUNT", T.LongType(), True),
    T.StructField("OPEN_ORDERS", T.LongType(), False),
    T.StructField("TOTAL_PRICE", T.DecimalType(18, 2), True),
    T.StructField("REGION_KEY", T.IntegerType(), True),
])


@query("contract_violations", sql="""
WITH rollup AS (SELECT o_custkey, CAST(count(*) AS BIGINT) AS ORDER_COUNT FROM orders GROUP BY o_custkey),
open_orders AS (SELECT o_custkey, CAST(count(*) AS BIGINT) AS OPEN_ORDERS FROM orders WHERE o_orderstatus = 'O' GROUP BY o_custkey),
s AS (
  SELECT c.c_custkey, r.ORDER_COUNT, oo.OPEN_ORDERS
  FROM customer c LEFT JOIN rollup r ON c.c_custkey = r.o_custkey LEFT JOIN open_orders oo ON c.c_custkey = oo.o_custkey
)
SELECT * FROM (VALUES
  ('REGION_KEY', 'missing', 'int', '-', CAST(NULL AS BIGINT)), ('n_name', 'extra', '-', 'string', NULL),
  ('TOTAL_PRICE', 'type', 'decimal(18,2)', 'decimal(38,2)', NULL),
  ('LINE_COUNT', 'order', '2', '3', NULL), ('OPEN_ORDERS', 'order', '3', '2', NULL)) t("column", breach, declared, found, n)
UNION ALL SELECT 'ORDER_COUNT', 'null', 'not null', 'null', count(*) FROM s WHERE ORDER_COUNT IS NULL HAVING count(*) > 0
UNION ALL SELECT 'OPEN_ORDERS', 'null', 'not null', 'null', count(*) FROM s WHERE OPEN_ORDERS IS NULL HAVING count(*) > 0""")
def q_contract_violations(spark, sf):
    """The star table, with some columns left out, against a contract it breaks in every way."""
    star = star_left_join(spark, sf).select("c_custkey", "n_name", "ORDER_COUNT", "OPEN_ORDERS", "LINE_COUNT", "TOTAL_PRICE")
    return contract_violations(star, CONTRACT)


AUDIT_AS_OF = dt.datetime(2001, 8, 1)
AUDIT_CUT = dt.datetime(2001, 6, 30)


def _audit_rows(df):
    """Orders as executed steps: one audit row per order, created at the order date."""
    n = F.lit(None)
    return df.select(
        F.col("o_orderkey").cast("string").alias("model_execution_id"),
        F.concat(F.lit("model.orders."), F.col("o_orderkey").cast("string")).alias("unique_id"),
        F.col("o_custkey").cast("string").alias("invocation_id"),
        F.col("o_orderdate").alias("generated_at"), F.col("o_orderdate").alias("created_at"),
        F.lit("orders").alias("name"), n.cast("string").alias("message"),
        F.when(F.col("o_orderstatus") == "F", F.lit("success")).otherwise(F.lit("error")).alias("status"),
        F.lit("model").alias("resource_type"), F.lit(0.0).alias("execution_time"),
        F.col("o_orderdate").alias("execute_started_at"), F.col("o_orderdate").alias("execute_completed_at"),
        n.cast("timestamp_ntz").alias("compile_started_at"), n.cast("timestamp_ntz").alias("compile_completed_at"),
        F.lit(1).cast("decimal(38,0)").alias("rows_affected"), F.lit(1).cast("decimal(38,0)").alias("rows_inserted"),
        F.lit(0).cast("decimal(38,0)").alias("rows_updated"), F.lit(0).cast("decimal(38,0)").alias("rows_deleted"),
        F.lit(False).alias("full_refresh"), n.cast("string").alias("compiled_code"),
        F.lit(0).cast("decimal(38,0)").alias("failures"), n.cast("string").alias("query_id"),
        n.cast("string").alias("thread_id"), F.lit("incremental").alias("materialization"),
        n.cast("string").alias("adapter_response"))


@query("retention_purge", sql=f"""
SELECT CAST(o_orderkey AS VARCHAR) AS model_execution_id,
       CASE WHEN o_orderstatus = 'F' THEN 'success' ELSE 'error' END AS status, o_orderdate AS created_at
FROM orders
WHERE o_orderdate <= TIMESTAMP '{AUDIT_CUT}' AND o_orderdate >= TIMESTAMP '{AUDIT_AS_OF}' - INTERVAL 60 DAY
UNION ALL
SELECT CAST(o_orderkey AS VARCHAR), CASE WHEN o_orderstatus = 'F' THEN 'success' ELSE 'error' END, o_orderdate
FROM orders WHERE o_orderdate > TIMESTAMP '{AUDIT_CUT}'""")
def retention_purge(spark, sf):
    o = S.t(spark, sf, "orders")
    cut = lit(AUDIT_CUT)
    audit = _audit_rows(o.filter(F.col("o_orderdate") <= cut)).to(AUDIT_SCHEMA)
    new = _audit_rows(o.filter(F.col("o_orderdate") > cut)).to(AUDIT_SCHEMA)
    kept = append_run_audit(audit, new, AUDIT_AS_OF, keep_days=60)
    return kept.select("model_execution_id", "status", "created_at")
