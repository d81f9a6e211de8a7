"""Registered queries: joins.

Broadcast is explicit only for nation / region (fixed 25 / 5 row domains) and one-row
aggregates; every other join is planned by Catalyst and re-planned by AQE from
runtime sizes.
"""

from __future__ import annotations

from pyspark.sql import functions as F

from tidemark.functions.expr import pad_left
from tidemark.operators.joins import anti, attach_scalar, lookup, not_in, semi, star_join
from tidemark.plans import sqlgen as Q
from tidemark.plans import standins as S
from tidemark.plans.registry import query


@query("join_inner", sql="""
SELECT o.o_orderkey, o.o_custkey, c.c_name, c.c_mktsegment
FROM orders o JOIN customer c ON o.o_custkey = c.c_custkey""")
def join_inner(spark, sf):
    o = S.t(spark, sf, "orders").select("o_orderkey", "o_custkey")
    c = S.t(spark, sf, "customer").select("c_custkey", "c_name", "c_mktsegment")
    return o.join(c, o.o_custkey == c.c_custkey, "inner").drop("c_custkey")


@query("join_left_lookup", sql="""
SELECT c.c_custkey, c.c_nationkey, n.n_name FROM customer c LEFT JOIN nation n ON c.c_nationkey = n.n_nationkey""")
def join_left_lookup(spark, sf):
    c = S.t(spark, sf, "customer").select("c_custkey", "c_nationkey")
    n = S.t(spark, sf, "nation").select(F.col("n_nationkey").alias("c_nationkey"), "n_name")
    return lookup(c, n, "c_nationkey", "left")


def order_rollup(spark, sf, orders=None):
    """G1: pre-aggregate the one-to-many side before the star join (partial aggregation)."""
    o = orders if orders is not None else S.t(spark, sf, "orders")
    return o.groupBy("o_custkey").agg(
        F.count(F.lit(1)).cast("bigint").alias("ORDER_COUNT"),
        F.min("o_orderdate").alias("FIRST_ORDER_DATE"), F.max("o_orderdate").alias("LAST_ORDER_DATE"),
        F.sum(F.col("o_totalprice").cast("decimal(18,2)")).cast("decimal(38,2)").alias("TOTAL_PRICE"))


SQL_ROLLUP = """rollup AS (
  SELECT o_custkey, CAST(count(*) AS BIGINT) AS ORDER_COUNT, min(o_orderdate) AS FIRST_ORDER_DATE,
         max(o_orderdate) AS LAST_ORDER_DATE, sum(CAST(o_totalprice AS DECIMAL(18,2))) AS TOTAL_PRICE
  FROM orders GROUP BY o_custkey
)"""


@query("star_left_join", headline=True, sql=f"""
WITH {SQL_ROLLUP},
open_orders AS (SELECT o_custkey, CAST(count(*) AS BIGINT) AS OPEN_ORDERS FROM orders WHERE o_orderstatus = 'O' GROUP BY o_custkey),
line_rollup AS (
  SELECT o.o_custkey, CAST(count(*) AS BIGINT) AS LINE_COUNT, sum(CAST(l.l_quantity AS DECIMAL(18,2))) AS TOTAL_QTY
  FROM lineitem l JOIN orders o ON l.l_orderkey = o.o_orderkey GROUP BY o.o_custkey
)
SELECT c.c_custkey, c.c_name, n.n_name, r.r_name, ro.ORDER_COUNT, ro.FIRST_ORDER_DATE, ro.LAST_ORDER_DATE,
       ro.TOTAL_PRICE, oo.OPEN_ORDERS, lr.LINE_COUNT, lr.TOTAL_QTY
FROM customer c
LEFT JOIN rollup ro ON c.c_custkey = ro.o_custkey
LEFT JOIN open_orders oo ON c.c_custkey = oo.o_custkey
LEFT JOIN line_rollup lr ON c.c_custkey = lr.o_custkey
LEFT JOIN nation n ON c.c_nationkey = n.n_nationkey
LEFT JOIN region r ON n.n_regionkey = r.r_regionkey""")
def star_left_join(spark, sf):
    c = S.t(spark, sf, "customer").select(F.col("c_custkey").alias("KEY"), "c_custkey", "c_name", "c_nationkey")
    o = S.t(spark, sf, "orders")
    # one pass over orders feeds both order measures; a customer without open orders gets
    # NULL, as from a separate filtered aggregate
    ro = o.groupBy(F.col("o_custkey").alias("KEY")).agg(
        F.count(F.lit(1)).cast("bigint").alias("ORDER_COUNT"),
        F.min("o_orderdate").alias("FIRST_ORDER_DATE"), F.max("o_orderdate").alias("LAST_ORDER_DATE"),
        F.sum(F.col("o_totalprice").cast("decimal(18,2)")).cast("decimal(38,2)").alias("TOTAL_PRICE"),
        F.nullif(F.count_if(F.col("o_orderstatus") == "O"), F.lit(0)).cast("bigint").alias("OPEN_ORDERS"))
    # lines are pre-aggregated per order (partial aggregation map side) before they meet
    # the orders, then rolled up per customer: the join sees one row per order, not per line
    li = S.t(spark, sf, "lineitem").groupBy("l_orderkey").agg(
        F.count(F.lit(1)).alias("_lines"), F.sum(F.col("l_quantity").cast("decimal(18,2)")).alias("_qty"))
    lr = (li.join(o.select(F.col("o_orderkey").alias("l_orderkey"), "o_custkey"), "l_orderkey")
          .groupBy(F.col("o_custkey").alias("KEY"))
          .agg(F.sum("_lines").cast("bigint").alias("LINE_COUNT"),
               F.sum("_qty").cast("decimal(38,2)").alias("TOTAL_QTY")))
    n = S.t(spark, sf, "nation").select(F.col("n_nationkey").alias("c_nationkey"), "n_name", "n_regionkey")
    r = S.t(spark, sf, "region").select(F.col("r_regionkey").alias("n_regionkey"), "r_name")
    # the customer-keyed sources share one hash partitioning on KEY
    out = star_join(c, [(ro, "KEY"), (lr, "KEY"), (n, "c_nationkey"), (r, "n_regionkey")])
    return out.select("c_custkey", "c_name", "n_name", "r_name", "ORDER_COUNT", "FIRST_ORDER_DATE",
                      "LAST_ORDER_DATE", "TOTAL_PRICE", "OPEN_ORDERS", "LINE_COUNT", "TOTAL_QTY")


@query("join_left_filtered", sql="""
SELECT c.c_custkey, o.o_orderkey FROM customer c
LEFT JOIN orders o ON c.c_custkey = o.o_custkey AND o.o_orderstatus = 'F'""")
def join_left_filtered(spark, sf):
    c = S.t(spark, sf, "customer").select("c_custkey")
    o = S.t(spark, sf, "orders").filter(F.col("o_orderstatus") == "F").select("o_orderkey", "o_custkey")
    return c.join(o, c.c_custkey == o.o_custkey, "left").select("c_custkey", "o_orderkey")


@query("join_normalised_key", sql=f"""
SELECT p.p_partkey, p.p_brand, s.s_suppkey, s.s_name
FROM part p LEFT JOIN supplier s
  ON {Q.pad_left("trim(split_part(p.p_brand, '#', 2))", 3)} = {Q.pad_left("s.s_suppkey", 3)}""")
def join_normalised_key(spark, sf):
    p = S.t(spark, sf, "part").select(
        "p_partkey", "p_brand",
        pad_left(F.trim(F.split_part(F.col("p_brand"), F.lit("#"), F.lit(2))), 3).alias("_k"))
    s = S.t(spark, sf, "supplier").select(
        "s_suppkey", "s_name", pad_left("s_suppkey", 3).alias("_k"))
    return p.join(s, "_k", "left").select("p_partkey", "p_brand", "s_suppkey", "s_name")


@query("join_chained", sql="""
SELECT l.l_orderkey, l.l_linenumber, s.s_name, n.n_name, r.r_name
FROM lineitem l
LEFT JOIN supplier s ON l.l_suppkey = s.s_suppkey
LEFT JOIN nation n ON s.s_nationkey = n.n_nationkey
LEFT JOIN region r ON n.n_regionkey = r.r_regionkey""")
def join_chained(spark, sf):
    li = S.t(spark, sf, "lineitem").select("l_orderkey", "l_linenumber", "l_suppkey")
    s = S.t(spark, sf, "supplier").select(F.col("s_suppkey").alias("l_suppkey"), "s_name", "s_nationkey")
    n = S.t(spark, sf, "nation").select(F.col("n_nationkey").alias("s_nationkey"), "n_name", "n_regionkey")
    r = S.t(spark, sf, "region").select(F.col("r_regionkey").alias("n_regionkey"), "r_name")
    j = lookup(li, s, "l_suppkey", "left")
    j = lookup(j, n, "s_nationkey", "left")
    j = lookup(j, r, "n_regionkey", "left")
    return j.select("l_orderkey", "l_linenumber", "s_name", "n_name", "r_name")


@query("join_multi_role", sql="""
SELECT l.l_orderkey, l.l_linenumber, cn.n_name AS CUSTOMER_NATION, sn.n_name AS SUPPLIER_NATION,
       an.n_name AS SUPPLIER_AFRICA_NATION
FROM lineitem l
JOIN orders o ON l.l_orderkey = o.o_orderkey
JOIN customer c ON o.o_custkey = c.c_custkey
LEFT JOIN supplier s ON l.l_suppkey = s.s_suppkey
LEFT JOIN nation cn ON c.c_nationkey = cn.n_nationkey
LEFT JOIN nation sn ON s.s_nationkey = sn.n_nationkey
LEFT JOIN (SELECT * FROM nation WHERE n_regionkey = 0) an ON s.s_nationkey = an.n_nationkey""")
def join_multi_role(spark, sf):
    li = S.t(spark, sf, "lineitem").select("l_orderkey", "l_linenumber", "l_suppkey")
    o = S.t(spark, sf, "orders").select(F.col("o_orderkey").alias("l_orderkey"), "o_custkey")
    c = S.t(spark, sf, "customer").select(F.col("c_custkey").alias("o_custkey"), "c_nationkey")
    s = S.t(spark, sf, "supplier").select(F.col("s_suppkey").alias("l_suppkey"), "s_nationkey")
    nation = S.t(spark, sf, "nation")
    cn = nation.select(F.col("n_nationkey").alias("c_nationkey"), F.col("n_name").alias("CUSTOMER_NATION"))
    sn = nation.select(F.col("n_nationkey").alias("s_nationkey"), F.col("n_name").alias("SUPPLIER_NATION"))
    an = nation.filter(F.col("n_regionkey") == 0).select(
        F.col("n_nationkey").alias("s_nationkey"), F.col("n_name").alias("SUPPLIER_AFRICA_NATION"))
    j = li.join(o, "l_orderkey").join(c, "o_custkey")
    j = lookup(j, s, "l_suppkey", "left")
    for role in (cn, sn, an):
        j = lookup(j, role, [x for x in role.columns if x.endswith("nationkey")], "left")
    return j.select("l_orderkey", "l_linenumber", "CUSTOMER_NATION", "SUPPLIER_NATION", "SUPPLIER_AFRICA_NATION")


@query("join_self_roles", sql="""
WITH ends AS (SELECT o_custkey, min(o_orderkey) AS FIRST_KEY, max(o_orderkey) AS LAST_KEY FROM orders GROUP BY o_custkey)
SELECT c.c_custkey, f.o_orderdate AS FIRST_ORDER_DATE, f.o_orderstatus AS FIRST_STATUS,
       l.o_orderdate AS LAST_ORDER_DATE, l.o_orderstatus AS LAST_STATUS
FROM customer c
LEFT JOIN ends e ON c.c_custkey = e.o_custkey
LEFT JOIN orders f ON e.FIRST_KEY = f.o_orderkey
LEFT JOIN orders l ON e.LAST_KEY = l.o_orderkey""")
def join_self_roles(spark, sf):
    c = S.t(spark, sf, "customer").select("c_custkey")
    o = S.t(spark, sf, "orders")
    ends = o.groupBy(F.col("o_custkey").alias("c_custkey")).agg(
        F.min("o_orderkey").alias("FIRST_KEY"), F.max("o_orderkey").alias("LAST_KEY"))
    f = o.select(F.col("o_orderkey").alias("FIRST_KEY"), F.col("o_orderdate").alias("FIRST_ORDER_DATE"),
                 F.col("o_orderstatus").alias("FIRST_STATUS"))
    last = o.select(F.col("o_orderkey").alias("LAST_KEY"), F.col("o_orderdate").alias("LAST_ORDER_DATE"),
                    F.col("o_orderstatus").alias("LAST_STATUS"))
    j = c.join(ends, "c_custkey", "left").join(f, "FIRST_KEY", "left").join(last, "LAST_KEY", "left")
    return j.select("c_custkey", "FIRST_ORDER_DATE", "FIRST_STATUS", "LAST_ORDER_DATE", "LAST_STATUS")


@query("semi_join_keys", sql="""
SELECT c_custkey, c_name FROM customer c
WHERE c_custkey IN (SELECT o_custkey FROM orders WHERE o_orderstatus = 'P')
  AND (c_custkey, c_nationkey) IN (SELECT o.o_custkey, c2.c_nationkey FROM orders o JOIN customer c2 ON o.o_custkey = c2.c_custkey)
  AND EXISTS (SELECT 1 FROM orders o WHERE o.o_custkey = c.c_custkey AND o.o_orderpriority = '1-URGENT')""")
def semi_join_keys(spark, sf):
    c = S.t(spark, sf, "customer")
    o = S.t(spark, sf, "orders")
    p = o.filter(F.col("o_orderstatus") == "P").select(F.col("o_custkey").alias("c_custkey"))
    pairs = o.join(c.select(F.col("c_custkey").alias("o_custkey"), "c_nationkey"), "o_custkey") \
        .select(F.col("o_custkey").alias("c_custkey"), "c_nationkey")
    urgent = o.filter(F.col("o_orderpriority") == "1-URGENT").select(F.col("o_custkey").alias("c_custkey"))
    out = semi(semi(semi(c, p, "c_custkey"), pairs, ["c_custkey", "c_nationkey"]), urgent, "c_custkey")
    return out.select("c_custkey", "c_name")


@query("semi_join_bridge", sql="""
SELECT c_custkey FROM customer
WHERE c_custkey IN (SELECT o_custkey FROM orders WHERE o_orderkey IN (SELECT l_orderkey FROM lineitem WHERE l_returnflag = 'R' AND l_quantity >= 49))""")
def semi_join_bridge(spark, sf):
    c = S.t(spark, sf, "customer").select("c_custkey")
    li = S.t(spark, sf, "lineitem").filter((F.col("l_returnflag") == "R") & (F.col("l_quantity") >= 49)) \
        .select(F.col("l_orderkey").alias("o_orderkey"))
    o = semi(S.t(spark, sf, "orders").select("o_orderkey", "o_custkey"), li, "o_orderkey")
    return semi(c, o.select(F.col("o_custkey").alias("c_custkey")), "c_custkey")


@query("anti_join_missing", sql="""
SELECT c.c_custkey, 'NO_PARTIAL_ORDERS' AS REASON FROM customer c
WHERE NOT EXISTS (SELECT 1 FROM orders o WHERE o.o_custkey = c.c_custkey AND o.o_orderstatus = 'P')
UNION ALL
SELECT p.p_partkey AS c_custkey, 'PART_NEVER_RETURNED_IN_BULK' AS REASON FROM part p
WHERE p.p_partkey NOT IN (SELECT l_partkey FROM lineitem WHERE l_returnflag = 'R' AND l_quantity >= 45)""")
def anti_join_missing(spark, sf):
    c = S.t(spark, sf, "customer").select("c_custkey")
    o = S.t(spark, sf, "orders").filter(F.col("o_orderstatus") == "P").select(F.col("o_custkey").alias("c_custkey"))
    a = anti(c, o, "c_custkey").withColumn("REASON", F.lit("NO_PARTIAL_ORDERS"))
    p = S.t(spark, sf, "part").select("p_partkey")
    bulk = S.t(spark, sf, "lineitem").filter((F.col("l_returnflag") == "R") & (F.col("l_quantity") >= 45))
    b = not_in(p, "p_partkey", bulk, "l_partkey") \
        .select(F.col("p_partkey").alias("c_custkey"), F.lit("PART_NEVER_RETURNED_IN_BULK").alias("REASON"))
    return a.unionByName(b)


@query("scalar_subquery", sql="""
SELECT o_orderkey, o_orderdate, (SELECT max(o_orderdate) FROM orders) AS LAST_ORDER_DATE
FROM orders WHERE o_orderdate >= (SELECT max(o_orderdate) FROM orders) - INTERVAL 30 DAY""")
def scalar_subquery(spark, sf):
    o = S.t(spark, sf, "orders").select("o_orderkey", "o_orderdate")
    m = o.agg(F.max("o_orderdate").alias("LAST_ORDER_DATE"))
    j = attach_scalar(o, m)
    return j.filter(F.col("o_orderdate") >= F.col("LAST_ORDER_DATE") - F.expr("INTERVAL 30 DAYS"))


@query("in_subquery_case", sql="""
SELECT c_custkey,
       CASE WHEN c_custkey IN (SELECT o_custkey FROM orders WHERE o_orderstatus = 'P' AND o_orderpriority = '1-URGENT')
            THEN 'Y' ELSE 'N' END AS HAS_URGENT_PARTIAL
FROM customer""")
def in_subquery_case(spark, sf):
    c = S.t(spark, sf, "customer").select("c_custkey")
    keys = (S.t(spark, sf, "orders")
            .filter((F.col("o_orderstatus") == "P") & (F.col("o_orderpriority") == "1-URGENT"))
            .select(F.col("o_custkey").alias("c_custkey")).distinct().withColumn("_hit", F.lit(True)))
    return c.join(keys, "c_custkey", "left").select(
        "c_custkey", F.when(F.col("_hit").isNotNull(), F.lit("Y")).otherwise(F.lit("N")).alias("HAS_URGENT_PARTIAL"))

