"""Registered queries: data-quality and reconciliation checks.

Each check runs over whole tables or over frames Spark derives from them: the SCD
checks over the merged dimension and over order-level versions, the lifecycle checks
over the lifecycle fact, the format checks over text extracted from documents.
"""

from __future__ import annotations

import datetime as dt

from pyspark.sql import functions as F

from tidemark.functions.literals import lit
from tidemark.operators import dq
from tidemark.operators.merge import ACTION
from tidemark.plans import standins as S
from tidemark.plans.q_changes import MERGE_PREFIX, _merge_d2
from tidemark.plans.q_joins import star_left_join
from tidemark.plans.q_projection import _RAW_POST_SQL, _raw_post
from tidemark.plans.q_relational import SQL_LIFE, lifecycle, q_propagate_deletes
from tidemark.plans.registry import query
from tidemark.sources.sinks import cut_lineage


def merged_dim(spark, sf):
    """The dimension as stored after the second run: the checks read the table, not the merge."""
    return cut_lineage(_merge_d2(spark, sf).drop(ACTION))


def order_versions(spark, sf):
    """One version per order (no intra-day collapse): ties on the order date give
    versions that end before they start, which Q3 reports. A customer's orders are not
    bounded by the calendar, so the next order comes from the skew-safe `neighbours`
    (range sort) instead of a per-customer window."""
    from tidemark.operators.windows import neighbours
    o = S.t(spark, sf, "orders").select(F.col("o_custkey").alias("ENTITY_KEY"), F.col("o_orderkey").alias("ORDER_KEY"),
                                        F.col("o_orderdate").cast("date").alias("EFF_DT"), "o_orderdate")
    v = neighbours(o, ["ENTITY_KEY"], ["o_orderdate", "ORDER_KEY"], ["EFF_DT"])
    disc = F.coalesce(F.date_sub(F.col("NEXT_EFF_DT"), 1), F.lit(dt.date(9999, 12, 31)))
    return v.select("ENTITY_KEY", "ORDER_KEY", "EFF_DT", disc.alias("DISC_DT"),
                    (disc == F.lit(dt.date(9999, 12, 31))).alias("IS_CURRENT"))


SQL_VERSIONS = """versions AS (
  SELECT ENTITY_KEY, ORDER_KEY, EFF_DT, DISC_DT, DISC_DT = DATE '9999-12-31' AS IS_CURRENT FROM (
    SELECT o_custkey AS ENTITY_KEY, o_orderkey AS ORDER_KEY, CAST(o_orderdate AS DATE) AS EFF_DT,
           coalesce(lead(CAST(o_orderdate AS DATE)) OVER (PARTITION BY o_custkey ORDER BY o_orderdate, o_orderkey) - 1,
                    DATE '9999-12-31') AS DISC_DT
    FROM orders)
)"""

SQL_DIM_D1 = f"WITH {S.sql_dim_history('dim1', S.D1, S.BATCH1)}"


# ------------------------------------------------------------------ SCD integrity

@query("dq_dup_disc", sql=f"""WITH {SQL_VERSIONS}
SELECT ENTITY_KEY, DISC_DT, CAST(count(*) AS BIGINT) AS N FROM versions GROUP BY ENTITY_KEY, DISC_DT HAVING count(*) > 1""")
def q_dup_disc(spark, sf):
    return dq.dup_disc(order_versions(spark, sf), "ENTITY_KEY")


@query("dq_eff_gt_disc", sql=f"WITH {SQL_VERSIONS} SELECT * FROM versions WHERE DISC_DT < EFF_DT")
def q_eff_gt_disc(spark, sf):
    return dq.eff_after_disc(order_versions(spark, sf))


SQL_MERGED_LEAD = MERGE_PREFIX + """,
g AS (SELECT * EXCLUDE (MERGE_ACTION), lead(EFF_DT) OVER (PARTITION BY ENTITY_KEY ORDER BY EFF_DT) AS NEXT_EFF_DT FROM merged)"""


@query("dq_gaps", sql=SQL_MERGED_LEAD + """
SELECT ENTITY_KEY, EFF_DT, DISC_DT, IS_CURRENT, NEXT_EFF_DT, 'gap' AS VARIANT FROM g
WHERE NEXT_EFF_DT IS NOT NULL AND datediff('day', DISC_DT, NEXT_EFF_DT) > 1
UNION ALL
SELECT ENTITY_KEY, EFF_DT, DISC_DT, IS_CURRENT, NEXT_EFF_DT, 'as_written' FROM g
WHERE NEXT_EFF_DT IS NOT NULL AND (NEXT_EFF_DT <= DISC_DT OR datediff('day', NEXT_EFF_DT, DISC_DT) > 1)""")
def q_gaps(spark, sf):
    m = merged_dim(spark, sf)
    cols = ["ENTITY_KEY", "EFF_DT", "DISC_DT", "IS_CURRENT", "NEXT_EFF_DT"]
    return dq.gap_variants(m, "ENTITY_KEY").select(*cols, "VARIANT")       # one pass for both variants


# The merge leaves no overlap and no wrong flag, so faults are planted in its result: closed rows
# of one priority run on for 400 days, and rows of another have their flag turned round.
RUNS_ON, TURNED = "1-URGENT", "5-LOW"
SQL_FAULTY = MERGE_PREFIX + f""",
faulty AS (SELECT ENTITY_KEY, EFF_DT,
    CASE WHEN PRIORITY = '{RUNS_ON}' AND DISC_DT <> DATE '9999-12-31' THEN DISC_DT + 400 ELSE DISC_DT END AS DISC_DT,
    CASE WHEN PRIORITY = '{TURNED}' THEN NOT IS_CURRENT ELSE IS_CURRENT END AS IS_CURRENT FROM merged)"""


def faulty_dim(spark, sf):
    open_ = F.col("DISC_DT") == F.lit(dt.date(9999, 12, 31))
    return merged_dim(spark, sf).select(
        "ENTITY_KEY", "EFF_DT",
        F.when((F.col("PRIORITY") == RUNS_ON) & ~open_, F.date_add("DISC_DT", 400)).otherwise(F.col("DISC_DT")).alias("DISC_DT"),
        F.when(F.col("PRIORITY") == TURNED, ~F.col("IS_CURRENT")).otherwise(F.col("IS_CURRENT")).alias("IS_CURRENT"))


@query("dq_overlaps", sql=SQL_FAULTY + """
SELECT ENTITY_KEY, EFF_DT, DISC_DT, NEXT_EFF_DT FROM (
  SELECT *, lead(EFF_DT) OVER (PARTITION BY ENTITY_KEY ORDER BY EFF_DT) AS NEXT_EFF_DT FROM faulty) WHERE NEXT_EFF_DT <= DISC_DT""")
def q_overlaps(spark, sf):
    return dq.overlaps(faulty_dim(spark, sf), "ENTITY_KEY").select("ENTITY_KEY", "EFF_DT", "DISC_DT", "NEXT_EFF_DT")


@query("dq_is_current", sql=SQL_FAULTY + """
SELECT ENTITY_KEY, EFF_DT, DISC_DT, IS_CURRENT FROM faulty WHERE IS_CURRENT <> (DISC_DT = DATE '9999-12-31')""")
def q_is_current(spark, sf):
    return dq.is_current_mismatch(faulty_dim(spark, sf)).select("ENTITY_KEY", "EFF_DT", "DISC_DT", "IS_CURRENT")


@query("scd_integrity", sql=SQL_MERGED_LEAD + """
SELECT ENTITY_KEY AS KEY, DISC_DT AS EFF_DT, DISC_DT, 'DUPLICATE_DISC_DT' AS ERROR FROM merged
  GROUP BY ENTITY_KEY, DISC_DT HAVING count(*) > 1
UNION ALL SELECT ENTITY_KEY, EFF_DT, DISC_DT, 'EFF_DT_AFTER_DISC_DT' FROM merged WHERE DISC_DT < EFF_DT
UNION ALL SELECT ENTITY_KEY, EFF_DT, DISC_DT, 'GAP_IN_HISTORY' FROM g
  WHERE NEXT_EFF_DT IS NOT NULL AND datediff('day', DISC_DT, NEXT_EFF_DT) > 1
UNION ALL SELECT ENTITY_KEY, EFF_DT, DISC_DT, 'OVERLAPPING_DATES' FROM g
  WHERE NEXT_EFF_DT IS NOT NULL AND NEXT_EFF_DT <= DISC_DT
UNION ALL SELECT ENTITY_KEY, EFF_DT, DISC_DT, 'IS_CURRENT_MISMATCH' FROM merged
  WHERE (DISC_DT = DATE '9999-12-31' AND IS_CURRENT <> true) OR (DISC_DT <> DATE '9999-12-31' AND IS_CURRENT = true)""")
def q_scd_integrity(spark, sf):
    return dq.scd_integrity(merged_dim(spark, sf), "ENTITY_KEY")


@query("dq_attr_changes", sql=f"""WITH {S.sql_dim_history('dim', None, S.BATCH2)},
v AS (SELECT PRIORITY, lag(PRIORITY) OVER (PARTITION BY ENTITY_KEY ORDER BY EFF_DT) AS prev FROM dim)
SELECT CAST(count(*) FILTER (WHERE prev IS NOT NULL AND PRIORITY <> prev) AS BIGINT) AS CHANGE_COUNT FROM v""")
def q_attr_changes(spark, sf):
    return dq.attr_changes(S.dim_history(spark, sf, None, S.BATCH2), "ENTITY_KEY", "PRIORITY")


@query("dq_one_current", sql=f"""WITH {S.sql_dim_history('dim', None, S.BATCH2)},
latest AS (
  SELECT o_custkey, o_orderstatus FROM orders
  QUALIFY row_number() OVER (PARTITION BY o_custkey ORDER BY o_orderdate DESC NULLS FIRST, o_orderkey DESC NULLS FIRST) = 1
),
pd AS (
  SELECT d.ENTITY_KEY, d.IS_CURRENT,
         EXISTS (SELECT 1 FROM latest l WHERE l.o_custkey = d.ENTITY_KEY AND l.o_orderstatus = 'F') AS IS_DELETED
  FROM dim d
)
SELECT ENTITY_KEY, CAST(sum(CASE WHEN IS_CURRENT AND NOT IS_DELETED THEN 1 ELSE 0 END) AS BIGINT) AS N
FROM pd GROUP BY ENTITY_KEY HAVING sum(CASE WHEN IS_CURRENT AND NOT IS_DELETED THEN 1 ELSE 0 END) <> 1""")
def q_one_current(spark, sf):
    d = q_propagate_deletes(spark, sf)
    return dq.exactly_one(d, "ENTITY_KEY", F.col("IS_CURRENT") & ~F.col("IS_DELETED"))


# ------------------------------------------------------------------ column checks

@query("dq_boolean_binary", sql="""
SELECT vec_id AS ID, CAST(label AS BIGINT) AS VALUE, 'embeddings.label' AS CHECKED FROM embeddings
WHERE label IS NOT NULL AND label NOT IN (0, 1)
UNION ALL SELECT doc_id, CAST(quality AS BIGINT), 'labels.quality' FROM labels WHERE quality IS NOT NULL AND quality NOT IN (0, 1)
UNION ALL SELECT doc_id, CAST(toxic AS BIGINT), 'labels.toxic' FROM labels WHERE toxic IS NOT NULL AND toxic NOT IN (0, 1)""")
def q_boolean_binary(spark, sf):
    e = dq.boolean_binary(S.t(spark, sf, "embeddings"), "label").select(
        F.col("vec_id").alias("ID"), F.col("label").cast("bigint").alias("VALUE"), F.lit("embeddings.label").alias("CHECKED"))
    lab = S.t(spark, sf, "labels")
    q = dq.boolean_binary(lab, "quality").select(F.col("doc_id").alias("ID"), F.col("quality").cast("bigint").alias("VALUE"),
                                                 F.lit("labels.quality").alias("CHECKED"))
    t = dq.boolean_binary(lab, "toxic").select(F.col("doc_id").alias("ID"), F.col("toxic").cast("bigint").alias("VALUE"),
                                               F.lit("labels.toxic").alias("CHECKED"))
    return e.unionByName(q).unionByName(t)


FRESH_AS_OF = dt.date(2002, 1, 1)


@query("dq_freshness", sql=f"""
SELECT LAST_LOAD FROM (SELECT CAST(max(o_orderdate) AS DATE) AS LAST_LOAD FROM orders)
WHERE LAST_LOAD < DATE '{FRESH_AS_OF}' - INTERVAL 30 DAY""")
def q_freshness(spark, sf):
    return dq.freshness(S.t(spark, sf, "orders"), "o_orderdate", 30, FRESH_AS_OF)


FUTURE_AS_OF = dt.datetime(2001, 6, 1)


@query("dq_date_not_future", sql=f"""
SELECT l_orderkey, l_linenumber, l_shipdate FROM lineitem
WHERE l_shipdate IS NOT NULL AND l_shipdate > TIMESTAMP '{FUTURE_AS_OF}'""")
def q_date_not_future(spark, sf):
    li = S.t(spark, sf, "lineitem").select("l_orderkey", "l_linenumber", "l_shipdate")
    return dq.date_not_future(li, "l_shipdate", FUTURE_AS_OF)


EMAIL_TOKEN = r"([^ ]+@[^ ]+)"
PHONE_TOKEN = r"([0-9(][0-9() -]{8,}[0-9])"


@query("dq_formats", sql=f"""
WITH emails AS (SELECT unnest(regexp_extract_all(text, '{EMAIL_TOKEN}', 1)) AS v FROM documents),
phones AS (SELECT unnest(regexp_extract_all(text, '{PHONE_TOKEN}', 1)) AS v FROM documents),
posts AS (SELECT {_RAW_POST_SQL} AS v FROM customer)
SELECT 'ein_format' AS CHECK_NAME, r_name AS VALUE FROM region
  WHERE r_name IS NOT NULL AND NOT regexp_matches(r_name, '{dq.ID_PATTERN}')
UNION ALL SELECT 'email_format', v FROM emails WHERE v <> '' AND NOT regexp_matches(v, '{dq.EMAIL_PATTERN}')
UNION ALL SELECT 'middle_initial_format', split_part(p_name, ' ', 1) FROM part
  WHERE split_part(p_name, ' ', 1) IS NOT NULL AND NOT regexp_matches(split_part(p_name, ' ', 1), '{dq.MIDDLE_INITIAL_PATTERN}')
UNION ALL SELECT 'phone_format', v FROM phones WHERE v <> '' AND NOT regexp_matches(v, '{dq.PHONE_PATTERN}')
UNION ALL SELECT 'postal_code_format', v FROM posts WHERE v IS NOT NULL AND NOT regexp_matches(v, '{dq.POSTAL_PATTERN}')""")
def q_formats(spark, sf):
    # every e-mail and phone of every document, both kinds from one scan
    tokens = F.array(*[F.struct(F.lit(n).alias("CHECK_NAME"), F.lit(p).alias("_p"),
                                F.regexp_extract_all("text", F.lit(t), F.lit(1)).alias("_v"))
                       for n, p, t in (("email_format", dq.EMAIL_PATTERN, EMAIL_TOKEN),
                                       ("phone_format", dq.PHONE_PATTERN, PHONE_TOKEN))])
    found = (S.t(spark, sf, "documents").select(F.explode(tokens).alias("x"))
             .select("x.CHECK_NAME", "x._p", F.explode("x._v").alias("VALUE"))
             .filter(~F.expr("VALUE RLIKE _p")).select("CHECK_NAME", "VALUE"))
    region = S.t(spark, sf, "region").select(F.col("r_name").alias("VALUE"))
    words = S.t(spark, sf, "part").select(F.split_part(F.col("p_name"), F.lit(" "), F.lit(1)).alias("VALUE"))
    posts = S.t(spark, sf, "customer").select(_raw_post().alias("VALUE"))
    out = found
    for name, df, pat in (("ein_format", region, dq.ID_PATTERN), ("middle_initial_format", words, dq.MIDDLE_INITIAL_PATTERN),
                          ("postal_code_format", posts, dq.POSTAL_PATTERN)):
        out = out.unionByName(dq.pattern_mismatch(df, "VALUE", pat).select(F.lit(name).alias("CHECK_NAME"), "VALUE"))
    return out


@query("dq_self_reference", sql="""
SELECT l_orderkey, l_linenumber, l_partkey, l_suppkey FROM lineitem
WHERE l_partkey IS NOT NULL AND l_suppkey IS NOT NULL AND l_partkey = l_suppkey""")
def q_self_reference(spark, sf):
    li = S.t(spark, sf, "lineitem").select("l_orderkey", "l_linenumber", "l_partkey", "l_suppkey")
    return dq.self_reference(li, "l_partkey", "l_suppkey")


@query("dq_positive", sql="""
SELECT c_custkey AS KEY, c_acctbal AS VALUE, 'customer.c_acctbal' AS CHECKED FROM customer WHERE c_acctbal IS NOT NULL AND c_acctbal <= 0
UNION ALL SELECT s_suppkey, s_acctbal, 'supplier.s_acctbal' FROM supplier WHERE s_acctbal IS NOT NULL AND s_acctbal <= 0
UNION ALL SELECT l_orderkey, l_discount, 'lineitem.l_discount' FROM lineitem WHERE l_discount < 0""")
def q_positive(spark, sf):
    c = dq.positive_values(S.t(spark, sf, "customer"), "c_acctbal").select(
        F.col("c_custkey").alias("KEY"), F.col("c_acctbal").alias("VALUE"), F.lit("customer.c_acctbal").alias("CHECKED"))
    s = dq.positive_values(S.t(spark, sf, "supplier"), "s_acctbal").select(
        F.col("s_suppkey").alias("KEY"), F.col("s_acctbal").alias("VALUE"), F.lit("supplier.s_acctbal").alias("CHECKED"))
    li = dq.non_negative(S.t(spark, sf, "lineitem"), "l_discount").select(
        F.col("l_orderkey").alias("KEY"), F.col("l_discount").alias("VALUE"), F.lit("lineitem.l_discount").alias("CHECKED"))
    return c.unionByName(s).unionByName(li)


@query("dq_status_consistency", sql=f"""WITH {S.sql_dim_history('dim', None, S.BATCH2)},
s AS (
  SELECT ENTITY_KEY, EFF_DT, CASE STATUS WHEN 'F' THEN 'TERMINATED' WHEN 'O' THEN 'ACTIVE' ELSE 'LEAVE' END AS EMP_STATUS,
         CASE WHEN IS_CURRENT THEN NULL ELSE DISC_DT END AS END_DT
  FROM dim
)
SELECT * FROM s
WHERE (EMP_STATUS = 'TERMINATED' AND END_DT IS NULL)
   OR (EMP_STATUS = 'ACTIVE' AND END_DT IS NOT NULL AND END_DT <= DATE '{S.MID}')""")
def q_status_consistency(spark, sf):
    d = S.dim_history(spark, sf, None, S.BATCH2)
    s = d.select("ENTITY_KEY", "EFF_DT",
                 F.when(F.col("STATUS") == "F", F.lit("TERMINATED")).when(F.col("STATUS") == "O", F.lit("ACTIVE"))
                 .otherwise(F.lit("LEAVE")).alias("EMP_STATUS"),
                 F.when(F.col("IS_CURRENT"), F.lit(None)).otherwise(F.col("DISC_DT")).alias("END_DT"))
    return dq.status_consistency(s, "EMP_STATUS", "END_DT", S.MID)


@query("dq_date_order", sql="""
SELECT l.l_orderkey, l.l_linenumber, o.o_orderdate, l.l_shipdate
FROM lineitem l JOIN orders o ON l.l_orderkey = o.o_orderkey
WHERE o.o_orderdate IS NOT NULL AND l.l_shipdate IS NOT NULL AND l.l_shipdate <= o.o_orderdate""")
def q_date_order(spark, sf):
    li = S.t(spark, sf, "lineitem").select("l_orderkey", "l_linenumber", "l_shipdate")
    o = S.t(spark, sf, "orders").select(F.col("o_orderkey").alias("l_orderkey"), "o_orderdate")
    return dq.date_order(li.join(o, "l_orderkey"), "o_orderdate", "l_shipdate")


ACCEPTED_PRIORITIES = ("1-URGENT", "2-HIGH", "3-MEDIUM", "4-NOT SPECIFIED")


@query("dq_accepted_values", sql=f"""
SELECT 'us_state_code' AS CHECK_NAME, p_partkey AS KEY, upper(substr(p_type, 1, 2)) AS VALUE FROM part
WHERE substr(p_type, 1, 2) IS NOT NULL AND upper(upper(substr(p_type, 1, 2))) NOT IN ({", ".join(f"'{s}'" for s in dq.STATE_CODES)})
UNION ALL
SELECT 'order_priority', o_orderkey, o_orderpriority FROM orders
WHERE o_orderpriority IS NOT NULL AND o_orderpriority NOT IN ({", ".join(f"'{s}'" for s in ACCEPTED_PRIORITIES)})""")
def q_accepted_values(spark, sf):
    p = S.t(spark, sf, "part").select(F.col("p_partkey").alias("KEY"), F.upper(F.substring("p_type", 1, 2)).alias("VALUE"))
    a = dq.accepted_values(p, "VALUE", dq.STATE_CODES, case_insensitive=True).select(
        F.lit("us_state_code").alias("CHECK_NAME"), "KEY", "VALUE")
    o = S.t(spark, sf, "orders").select(F.col("o_orderkey").alias("KEY"), F.col("o_orderpriority").alias("VALUE"))
    b = dq.accepted_values(o, "VALUE", ACCEPTED_PRIORITIES).select(F.lit("order_priority").alias("CHECK_NAME"), "KEY", "VALUE")
    return a.unionByName(b)


@query("dq_not_null", sql="""
WITH open_orders AS (SELECT o_custkey, CAST(count(*) AS BIGINT) AS OPEN_ORDERS FROM orders WHERE o_orderstatus = 'O' GROUP BY o_custkey),
line_rollup AS (
  SELECT o.o_custkey, CAST(count(*) AS BIGINT) AS LINE_COUNT FROM lineitem l JOIN orders o ON l.l_orderkey = o.o_orderkey
  GROUP BY o.o_custkey)
SELECT c.c_custkey, oo.OPEN_ORDERS, lr.LINE_COUNT
FROM customer c LEFT JOIN open_orders oo ON c.c_custkey = oo.o_custkey LEFT JOIN line_rollup lr ON c.c_custkey = lr.o_custkey
WHERE c.c_custkey IS NULL OR oo.OPEN_ORDERS IS NULL OR lr.LINE_COUNT IS NULL""")
def q_not_null(spark, sf):
    s = star_left_join(spark, sf).select("c_custkey", "OPEN_ORDERS", "LINE_COUNT")
    return dq.not_null(s, ["c_custkey", "OPEN_ORDERS", "LINE_COUNT"])


@query("dq_unique", sql="""
SELECT o_custkey, CAST(count(*) AS BIGINT) AS n FROM orders GROUP BY o_custkey HAVING count(*) > 1""")
def q_unique(spark, sf):
    return dq.duplicates(S.t(spark, sf, "orders"), ["o_custkey"])


@query("dq_referential", sql="""
SELECT l.doc_id, l.quality, l.toxic FROM labels l WHERE NOT EXISTS (SELECT 1 FROM documents d WHERE d.doc_id = l.doc_id)
UNION ALL
SELECT e.vec_id, NULL, NULL FROM embeddings e WHERE NOT EXISTS (SELECT 1 FROM pages p WHERE p.page_id = e.vec_id)""")
def q_referential(spark, sf):
    lab = dq.referential(S.t(spark, sf, "labels"), S.t(spark, sf, "documents"), "doc_id", "doc_id")
    emb = dq.referential(S.t(spark, sf, "embeddings"), S.t(spark, sf, "pages"), "vec_id", "page_id").select(
        F.col("vec_id").alias("doc_id"), F.lit(None).cast("int").alias("quality"), F.lit(None).cast("int").alias("toxic"))
    return lab.select("doc_id", "quality", "toxic").unionByName(emb)


@query("dq_contains", sql="""
SELECT p_partkey, p_name, p_type FROM part WHERE NOT (lower(p_name) LIKE '%' || lower(p_type) || '%')""")
def q_contains(spark, sf):
    p = S.t(spark, sf, "part").select("p_partkey", "p_name", "p_type")
    return dq.contains_parts(p, "p_name", ["p_type"])


# ------------------------------------------------------------------ reconciliation

@query("recon_missing_keys", sql=SQL_DIM_D1 + """
SELECT DISTINCT o_custkey AS ENTITY_KEY, 'MISSING_IN_TARGET' AS STATUS FROM orders
WHERE o_custkey IS NOT NULL AND NOT EXISTS (SELECT 1 FROM dim1 d WHERE d.ENTITY_KEY = orders.o_custkey)""")
def q_missing_keys(spark, sf):
    src = S.t(spark, sf, "orders").select(F.col("o_custkey").alias("ENTITY_KEY"))
    return dq.missing_keys(src, S.dim_history(spark, sf, S.D1, S.BATCH1), "ENTITY_KEY")


@query("recon_row_count", sql=SQL_DIM_D1 + """
SELECT * FROM (
  SELECT (SELECT CAST(count(DISTINCT o_custkey) AS BIGINT) FROM orders) AS SOURCE_COUNT,
         (SELECT CAST(count(DISTINCT ENTITY_KEY) AS BIGINT) FROM dim1) AS TARGET_COUNT)
  t(SOURCE_COUNT, TARGET_COUNT)
CROSS JOIN LATERAL (SELECT SOURCE_COUNT - TARGET_COUNT AS DIFFERENCE)
WHERE DIFFERENCE <> 0""")
def q_row_count(spark, sf):
    src = S.t(spark, sf, "orders").select(F.col("o_custkey").alias("ENTITY_KEY"))
    return dq.row_count_recon(src, S.dim_history(spark, sf, S.D1, S.BATCH1), "ENTITY_KEY")


@query("recon_pk_count", sql=SQL_DIM_D1 + """
SELECT CAST(count(*) AS BIGINT) AS MISSING_COUNT FROM (SELECT DISTINCT o_custkey FROM orders) a
WHERE a.o_custkey NOT IN (SELECT ENTITY_KEY FROM dim1)""")
def q_pk_count(spark, sf):
    stage = S.t(spark, sf, "orders").select("o_custkey").distinct()
    ods = S.dim_history(spark, sf, S.D1, S.BATCH1).select("ENTITY_KEY")
    return dq.pk_count_not_in(stage, ods, "o_custkey", "ENTITY_KEY")


@query("recon_deduped_counts", sql=SQL_DIM_D1 + """
SELECT * FROM (
  SELECT (SELECT CAST(count(*) AS BIGINT) FROM (SELECT o_custkey FROM orders
            QUALIFY row_number() OVER (PARTITION BY o_custkey ORDER BY o_orderdate DESC NULLS FIRST, o_orderkey DESC NULLS FIRST) = 1)) AS SOURCE_COUNT,
         (SELECT CAST(count(*) AS BIGINT) FROM dim1 WHERE IS_CURRENT) AS TARGET_COUNT)
WHERE SOURCE_COUNT <> TARGET_COUNT""")
def q_deduped_counts(spark, sf):
    tgt = S.dim_history(spark, sf, S.D1, S.BATCH1).filter(F.col("IS_CURRENT"))
    return dq.deduped_counts(S.t(spark, sf, "orders"), tgt, "o_custkey", ["o_orderdate"], ["o_orderkey"])


# ------------------------------------------------------------------ lifecycle checks

@query("dq_one_event", sql=SQL_LIFE + """
SELECT EMPLOYEE_EIN, CAST(sum(CASE WHEN EVENT_TYPE = 'TERMINATION' THEN 1 ELSE 0 END) AS BIGINT) AS N FROM life
GROUP BY EMPLOYEE_EIN HAVING sum(CASE WHEN EVENT_TYPE = 'TERMINATION' THEN 1 ELSE 0 END) <> 1""")
def q_one_event(spark, sf):
    return dq.exactly_one(lifecycle(spark, sf), "EMPLOYEE_EIN", F.col("EVENT_TYPE") == "TERMINATION")


# The fact has no such faults, so they are planted: every role change counts as lateral too, and
# events of the first quarter carry their tenure in whole years.
@query("dq_exclusive", sql=SQL_LIFE + """
SELECT EMPLOYEE_EIN, EVENT_DATE FROM life WHERE IS_PROMOTION AND (IS_LATERAL OR EVENT_TYPE = 'ROLE_CHANGE')""")
def q_exclusive(spark, sf):
    life = lifecycle(spark, sf).withColumn("IS_LATERAL", F.col("IS_LATERAL") | (F.col("EVENT_TYPE") == "ROLE_CHANGE"))
    return dq.exclusive_flags(life, "IS_PROMOTION", "IS_LATERAL").select("EMPLOYEE_EIN", "EVENT_DATE")


@query("dq_tolerance", sql=SQL_LIFE + """
SELECT EMPLOYEE_EIN, EVENT_DATE, TENURE_DAYS, TENURE_YEARS FROM (
  SELECT * REPLACE (CAST(CASE WHEN EVENT_QUARTER = 1 THEN floor(TENURE_YEARS) ELSE TENURE_YEARS END AS DECIMAL(10,2)) AS TENURE_YEARS)
  FROM life) WHERE abs(CAST(TENURE_YEARS AS DOUBLE) - TENURE_DAYS / 365.25) > 0.01""")
def q_tolerance(spark, sf):
    life = lifecycle(spark, sf).withColumn("TENURE_YEARS", F.when(
        F.col("EVENT_QUARTER") == 1, F.floor("TENURE_YEARS")).otherwise(F.col("TENURE_YEARS")).cast("decimal(10,2)"))
    chk = life.select("*", (F.col("TENURE_DAYS") / F.lit(365.25)).alias("_years"),
                      F.col("TENURE_YEARS").cast("double").alias("_ty"))
    return dq.tolerance(chk, "_ty", "_years", 0.01).select("EMPLOYEE_EIN", "EVENT_DATE", "TENURE_DAYS", "TENURE_YEARS")


@query("dq_range", sql=SQL_LIFE + """
SELECT EMPLOYEE_EIN, EVENT_DATE, EVENT_FISCAL_YEAR, EVENT_QUARTER, EVENT_MONTH FROM life
WHERE NOT (EVENT_FISCAL_YEAR BETWEEN 1996 AND 2100) OR NOT (EVENT_QUARTER BETWEEN 1 AND 4) OR NOT (EVENT_MONTH BETWEEN 1 AND 12)""")
def q_range(spark, sf):
    life = lifecycle(spark, sf).select("EMPLOYEE_EIN", "EVENT_DATE", "EVENT_FISCAL_YEAR", "EVENT_QUARTER", "EVENT_MONTH")
    return dq.any_out_of_range(life, [("EVENT_FISCAL_YEAR", 1996, 2100), ("EVENT_QUARTER", 1, 4), ("EVENT_MONTH", 1, 12)])


@query("dq_flag_consistency", sql=SQL_LIFE + """
SELECT EMPLOYEE_EIN, EVENT_DATE, EVENT_TYPE, IS_TERMINATION FROM life
WHERE (IS_TERMINATION = true AND NOT coalesce(EVENT_TYPE = 'TERMINATION', false))
   OR (IS_TERMINATION = false AND coalesce(EVENT_TYPE = 'TERMINATION', false))""")
def q_flag_consistency(spark, sf):
    life = lifecycle(spark, sf)
    return dq.flag_consistency(life, "IS_TERMINATION", F.col("EVENT_TYPE") == "TERMINATION").select(
        "EMPLOYEE_EIN", "EVENT_DATE", "EVENT_TYPE", "IS_TERMINATION")


# ------------------------------------------------------------------ model table (Q42)

MODEL_AS_OF = dt.datetime(2024, 2, 1)


def model_table(spark, sf):
    """Model-coefficient rows built from the embeddings table, one per label: the
    division levels start with the label, whose coefficient is the label's smallest
    vector id (zero only for the label holding vector 0); the service levels start
    with 'all', whose coefficient is always 0."""
    e = S.t(spark, sf, "embeddings")
    g = e.groupBy("label").agg(F.min("vec_id").alias("_min"), F.max("vec_id").alias("_max"))
    lvl = F.col("label").cast("string")
    return g.select(
        "label",
        (lit(dt.datetime(2024, 1, 1)) + F.make_interval(days=(F.col("_max") % 60).cast("int"))).alias("TRAINED_AT"),
        F.array(lvl, F.lit("other")).alias("DIVISION_XLEVELS"),
        F.create_map(lvl, F.col("_min").cast("double")).alias("DIVISION_COEF"),
        F.array(F.lit("all")).alias("SERVICE_XLEVELS"),
        F.create_map(F.lit("all"), F.lit(0.0)).alias("SERVICE_COEF"))


SQL_MODEL = f"""
WITH g AS (SELECT label, min(vec_id) AS mn, max(vec_id) AS mx FROM embeddings GROUP BY label),
m AS (SELECT label, TIMESTAMP '2024-01-01 00:00:00' + to_days(CAST(mx % 60 AS INTEGER)) AS TRAINED_AT,
             CAST(label AS VARCHAR) AS DIV_LEVEL, CAST(mn AS DOUBLE) AS DIV_BASE,
             'all' AS SRV_LEVEL, CAST(0.0 AS DOUBLE) AS SRV_BASE FROM g),
c AS (SELECT count(*) AS row_count, max(TRAINED_AT) AS max_trained_at FROM m)
SELECT '{dq.ROW_COUNT}' AS FAILURE, CAST(row_count AS VARCHAR) AS DETAILS FROM c WHERE row_count <> 1
UNION ALL SELECT '{dq.STALE}', CAST(max_trained_at AS VARCHAR) FROM c
  WHERE max_trained_at IS NULL OR max_trained_at < TIMESTAMP '{MODEL_AS_OF}' - INTERVAL 30 DAY
UNION ALL SELECT 'division{dq.BASELINE}', DIV_LEVEL FROM m WHERE DIV_BASE IS NULL OR DIV_BASE <> 0
UNION ALL SELECT 'service{dq.BASELINE}', SRV_LEVEL FROM m WHERE SRV_BASE IS NULL OR SRV_BASE <> 0"""


@query("dq_model_coefficients", sql=SQL_MODEL)
def q_model_coefficients(spark, sf):
    return dq.model_coefficients(model_table(spark, sf), "TRAINED_AT",
                                 [("division", "DIVISION_XLEVELS", "DIVISION_COEF"),
                                  ("service", "SERVICE_XLEVELS", "SERVICE_COEF")],
                                 MODEL_AS_OF, 30)


@query("dq_model_variant", sql=SQL_MODEL)
def q_model_variant(spark, sf):
    """The same check on a model table whose levels and coefficients are stored as VARIANT."""
    m = model_table(spark, sf)
    cols = ["DIVISION_XLEVELS", "DIVISION_COEF", "SERVICE_XLEVELS", "SERVICE_COEF"]
    return dq.model_coefficients(m.withColumns({c: F.to_variant_object(c) for c in cols}), "TRAINED_AT",
                                 [("division", "DIVISION_XLEVELS", "DIVISION_COEF"),
                                  ("service", "SERVICE_XLEVELS", "SERVICE_COEF")],
                                 MODEL_AS_OF, 30)


# ------------------------------------------------------------------ suite summary

@query("dq_summary", sql=f"""WITH {SQL_VERSIONS},
c AS (
  SELECT 'eff_gt_disc' AS CHECK_NAME, CAST((SELECT count(*) FROM versions WHERE DISC_DT < EFF_DT) AS BIGINT) AS FAILURES
  UNION ALL SELECT 'positive_acctbal', CAST((SELECT count(*) FROM customer WHERE c_acctbal <= 0) AS BIGINT)
  UNION ALL SELECT 'unique_orderkey', CAST((SELECT count(*) FROM (SELECT o_orderkey FROM orders GROUP BY o_orderkey HAVING count(*) > 1)) AS BIGINT)
  UNION ALL SELECT 'name_missing', CAST((SELECT count(*) FROM customer WHERE c_name IS NULL) AS BIGINT)
  UNION ALL SELECT 'negative_discount', CAST((SELECT count(*) FROM lineitem WHERE l_discount < 0) AS BIGINT)
  UNION ALL SELECT 'self_reference', CAST((SELECT count(*) FROM lineitem WHERE l_partkey = l_suppkey) AS BIGINT)
),
r AS (SELECT CHECK_NAME, FAILURES, CASE WHEN FAILURES = 0 THEN 'pass' ELSE 'warn' END AS STATUS FROM c)
SELECT CAST(count(*) FILTER (WHERE STATUS = 'pass') AS BIGINT) AS PASS_COUNT,
       CAST(count(*) FILTER (WHERE STATUS = 'warn') AS BIGINT) AS WARN_COUNT,
       CAST(count(*) FILTER (WHERE STATUS = 'error') AS BIGINT) AS ERROR_COUNT,
       CAST(count(*) FILTER (WHERE STATUS = 'fail') AS BIGINT) AS FAIL_COUNT,
       CAST(count(*) AS BIGINT) AS TOTAL
FROM r""")
def q_summary(spark, sf):
    checks = [
        ("eff_gt_disc", lambda: dq.eff_after_disc(order_versions(spark, sf))),
        ("unique_orderkey", lambda: dq.duplicates(S.t(spark, sf, "orders"), ["o_orderkey"])),
    ]
    row_checks = [
        (S.t(spark, sf, "customer"), [("positive_acctbal", F.col("c_acctbal") <= 0), ("name_missing", F.col("c_name").isNull())]),
        (S.t(spark, sf, "lineitem"), [("self_reference", F.col("l_partkey") == F.col("l_suppkey")),
                                      ("negative_discount", F.col("l_discount") < 0)]),
    ]
    return dq.summary(dq.run_suite(checks, row_checks=row_checks))
