"""Plan-shape regressions: the skew and shuffle properties the README claims."""

import datetime as dt

from pyspark.sql import functions as F

from tidemark.operators.dedup import cdc_resolve, latest_per_key, purge_duplicates
from tidemark.operators.joins import attach_scalar
from tidemark.operators.merge import merge_upsert


def physical(df) -> str:
    """The final (AQE re-optimised) physical plan: run the Dataset's own execution."""
    df.collect()
    plan = df._jdf.queryExecution().executedPlan().toString()
    return plan.split("== Initial Plan ==")[0]


def hot_rows(spark, n=3000):
    # one key holds a third of all rows
    rows = [(0 if i % 3 == 0 else i, i, dt.datetime(2025, 1, 1) + dt.timedelta(seconds=i)) for i in range(n)]
    return spark.createDataFrame(rows, "K long, ID long, TS timestamp_ntz")


def test_latest_per_key_limits_map_side(spark):
    df = hot_rows(spark)
    out = latest_per_key(df, "K", ["TS"], ["ID"])
    plan = physical(out)
    assert "WindowGroupLimit" in plan and "Partial" in plan
    rows = {r["K"]: r["ID"] for r in out.collect()}
    assert rows[0] == 2997 and len(rows) == 2001


def test_purge_limits_copies_map_side_without_join(spark):
    df = hot_rows(spark).select(F.lit("same").alias("V"), "TS", "ID")
    out = purge_duplicates(df, ["TS", "ID"])
    plan = physical(out)
    assert "WindowGroupLimit" in plan and "Partial" in plan and "Join" not in plan
    assert [r["ID"] for r in out.collect()] == [2999]


def test_cdc_resolve_pre_aggregates_renames(spark):
    log = hot_rows(spark).select("K", F.lit(0).cast("long").alias("BK"), "TS", "ID",
                                 F.when(F.col("K") != 0, "Y").otherwise("N").alias("PKC"))
    out = cdc_resolve(log, "K", "BK", "TS", "ID", F.col("PKC") == "Y")
    assert "partial_max" in physical(out)
    # key 0 was renamed away by the later rename records (ids above its kept id 2997)
    assert 0 not in {r["K"] for r in out.collect()}


def test_no_cross_join_in_scalar_attach(spark):
    df = spark.range(100)
    out = attach_scalar(df, df.agg(F.max("id").alias("mx")))
    plan = physical(out)
    assert "CartesianProduct" not in plan and "BroadcastNestedLoopJoin" not in plan
    assert out.filter(F.col("mx") == 99).count() == 100


def test_upsert_broadcasts_small_batch_without_shuffling_target(spark):
    tgt = spark.range(20000).select(F.col("id").alias("K"), F.lit("v").alias("V"), F.lit("h").alias("HASH_CHANGE"),
                                    F.lit("INSERT").alias("OPERATION_TYPE"))
    src = spark.createDataFrame([(5, "w", "h2", "INSERT"), (20001, "n", "h3", "INSERT")], tgt.schema)
    out = merge_upsert(tgt, src, "K", stage_source=True)
    plan = physical(out)
    assert "BroadcastHashJoin" in plan and "SortMergeJoin" not in plan
    acts = {r["K"]: r["_action"] for r in out.filter(F.col("_action") != "unchanged").collect()}
    assert acts == {5: "update", 20001: "insert"}
