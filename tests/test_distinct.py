"""Kept bitmaps against COUNT(DISTINCT)."""

import os
import random

from pyspark.sql import functions as F

from tidemark.operators.distinct import distinct_count, key_bitmaps, merge_bitmaps


def test_merged_loads_equal_the_recount(spark, scratch):
    """NULLs, negative and far keys, repeats, a hot key, an empty load; groups that only one load has."""
    rng = random.Random(6)
    rows = [(i % 3, None if i % 11 == 0 else rng.choice([7, 7, rng.randrange(100_000), -rng.randrange(50), 2**40 + i % 5]), i % 4)
            for i in range(4000)] + [(9, 1, 3)]
    df = spark.createDataFrame(rows, "G int, K bigint, LOAD int").repartition(6)
    want = {r["G"]: r["n"] for r in df.groupBy("G").agg(F.countDistinct("K").alias("n")).collect()}
    kept = None
    for load in (0, 1, 2, 3, 4):
        new = key_bitmaps(df.filter(F.col("LOAD") == load), "K", ["G"])
        path = os.path.join(scratch, f"b{load}")
        (new if kept is None else merge_bitmaps(kept, new, ["G"])).write.parquet(path)
        kept = spark.read.parquet(path)
    assert {r["G"]: r["DISTINCT_KEYS"] for r in distinct_count(kept, ["G"]).collect()} == want
    whole = distinct_count(key_bitmaps(df, "K")).first()[0]
    assert whole == df.agg(F.countDistinct("K")).first()[0]
    assert distinct_count(key_bitmaps(df.filter("false"), "K")).first()[0] == 0


def test_the_second_load_reads_the_new_load_only(spark, scratch):
    old, new, bits = (os.path.join(scratch, x) for x in ("old", "new", "bits"))
    spark.range(1000).withColumnRenamed("id", "K").write.parquet(old)
    spark.range(500, 1500).withColumnRenamed("id", "K").write.parquet(new)
    key_bitmaps(spark.read.parquet(old), "K").write.parquet(bits)
    merged = distinct_count(merge_bitmaps(spark.read.parquet(bits), key_bitmaps(spark.read.parquet(new), "K")))
    assert merged.first()[0] == 1500
    files = {os.path.dirname(f.removeprefix("file://")) for f in merged.inputFiles()}
    assert files == {new, bits}
    plan = merged._jdf.queryExecution().executedPlan().toString()
    assert "partial_bitmap_construct_agg" in plan
