"""Column functions (FIXTURES §5), hashes, DQ checks, lifecycle rules, sinks and streaming."""

import datetime as dt
import hashlib
import os

import pytest
from pyspark.sql import functions as F

from tidemark.functions import expr as X
from tidemark.functions.hashing import content_hash, surrogate_key
from tidemark.operators import dq
from tidemark.operators.joins import not_in
from tidemark.operators.lifecycle import LifecycleSpec, lifecycle_events
from tidemark.sources import commits, sinks
from tidemark.sources.tables import empty_table, load, lookup_values


def one_col(spark, values, typ="string"):
    return spark.createDataFrame([(v,) for v in values], f"v {typ}")


def test_trim_string_spaces_only(spark):
    r = one_col(spark, ["  a   b  ", "\ta  b\t"]).select(X.trim_string("v").alias("o")).collect()
    assert [x["o"] for x in r] == ["a b", "\ta b\t"]


def test_postal_split_cases(spark):
    vals = ["12345-6789", "123456789", "12345 6789", "12345-", "12345", "K1A 0B1", None, ""]
    df = one_col(spark, vals)
    code, suf = X.postal_split("v")
    got = [(r["c"], r["s"]) for r in df.select(code.alias("c"), suf.alias("s")).collect()]
    assert got == [("12345", "6789"), ("12345", "6789"), ("12345", "6789"), ("12345", ""), ("12345", ""),
                   ("K1A 0B1", ""), ("", ""), ("", "")]


def test_country_norm(spark):
    code, name = X.country_norm("v")
    got = [(r["c"], r["n"]) for r in one_col(spark, ["U.S.A.", "us", "United States", "CA"])
           .select(code.alias("c"), name.alias("n")).collect()]
    assert got[:3] == [("USA", "UNITED STATES OF AMERICA")] * 3 and got[3] == ("CA", "CA")


def test_date_check(spark):
    df = one_col(spark, [20240131, 0, None, 20241399, 19391231], "int")
    r = df.select(X.date_check("v").alias("a"), X.date_check("v", bad="low").alias("b"),
                  X.date_check("v", bad="high", min_year=1940).alias("c")).collect()
    assert [x["a"] for x in r] == [dt.date(2024, 1, 31), None, None, None, dt.date(1939, 12, 31)]
    assert r[1]["b"] == dt.date(1700, 1, 1) and r[4]["c"] == dt.date(4000, 12, 31)


def test_capture_ts_and_batch_id(spark):
    r = one_col(spark, ["20250102030405678999"]).select(X.parse_capture_ts("v").alias("t")).collect()[0]
    assert r["t"] == dt.datetime(2025, 1, 2, 3, 4, 5, 678000)
    b = spark.range(1).select(X.batch_id(F.lit(dt.datetime(2025, 1, 2, 3, 4, 5, 678000))).alias("b")).collect()[0]
    assert b["b"] == 20250102030405678


def test_surrogate_key_matches_md5(spark):
    r = spark.createDataFrame([(1, None)], "a int, b string").select(
        surrogate_key("a", "b").alias("k"), surrogate_key("a", "b", null_token="N").alias("n")).collect()[0]
    assert r["k"] == hashlib.md5(b"1-").hexdigest() and r["n"] == hashlib.md5(b"1-N").hexdigest()


def test_content_hash_has_no_separator(spark):
    df = spark.createDataFrame([("a", "bc"), ("ab", "c")], "x string, y string")
    assert df.select(content_hash(df, []).alias("h")).distinct().count() == 1


def test_concat_strict_null(spark):
    r = spark.createDataFrame([("a", None)], "x string, y string").select(X.concat_strict(" ", "x", "y").alias("o"))
    assert r.collect()[0]["o"] is None


def test_not_in_null_rule(spark):
    left = one_col(spark, ["a", "b", None])
    assert sorted(r["v"] for r in not_in(left, "v", one_col(spark, ["a"]), "v").collect()) == ["b"]
    assert not_in(left, "v", one_col(spark, ["a", None]), "v").count() == 0


def test_gap_variants(spark):
    d = spark.createDataFrame([("A", dt.date(2024, 1, 1), dt.date(2024, 1, 10)), ("A", dt.date(2024, 1, 20), dt.date(9999, 12, 31)),
                               ("B", dt.date(2024, 1, 1), dt.date(2024, 1, 10)), ("B", dt.date(2024, 1, 5), dt.date(9999, 12, 31))],
                              "K string, EFF_DT date, DISC_DT date")
    assert {r["K"] for r in dq.gaps(d, "K").collect()} == {"A"}
    assert {r["K"] for r in dq.gaps(d, "K", as_written=True).collect()} == {"B"}
    assert {r["K"] for r in dq.overlaps(d, "K").collect()} == {"B"}


def test_formats_anchored(spark):
    df = one_col(spark, ["12345", "12345-67890", "K1A 0B1", "x12345"])
    assert sorted(r["v"] for r in dq.pattern_mismatch(df, "v", dq.POSTAL_PATTERN).collect()) == ["12345-67890", "x12345"]


def test_run_suite_and_summary(spark):
    df = one_col(spark, [0, 1, 2], "int")
    res = dq.run_suite([("bin", lambda: dq.boolean_binary(df, "v")), ("pos", lambda: dq.positive_values(df, "v"))])
    rows = {r["CHECK_NAME"]: (r["FAILURES"], r["STATUS"]) for r in res.collect()}
    assert rows == {"bin": (1, "warn"), "pos": (1, "warn")}
    s = dq.summary(res).collect()[0]
    assert s["WARN_COUNT"] == 2 and s["TOTAL"] == 2


@pytest.mark.parametrize("days,band", [(364, "<1 year"), (365, "1-3 years"), (1094, "1-3 years"),
                                       (1095, "3-5 years"), (1824, "3-5 years"), (1825, "5+ years")])
def test_tenure_band_boundaries(spark, days, band):
    hire = dt.date(2010, 1, 1)
    rows = [("E", "SK", hire, "ACTIVE", "J1", 1, hire), ("E", "SK2", hire + dt.timedelta(days=days), "ACTIVE", "J1", 1, hire)]
    dim = spark.createDataFrame(rows, "EIN string, SK string, EFF_DT date, ST string, JOB string, DIV int, HIRE date")
    spec = LifecycleSpec(key="EIN", eff="EFF_DT", status="ST", job="JOB", division="DIV", supervisor=None,
                         hire_date="HIRE", sk="SK")
    out = sorted(lifecycle_events(dim, spec).collect(), key=lambda r: r["EVENT_DATE"])
    assert out[1]["TENURE_BAND"] == band and out[1]["TENURE_DAYS"] == days


def test_lifecycle_rule_order(spark):
    base = dt.date(2020, 1, 1)
    seq = [("ACTIVE", "J1", 1), ("LOA", "J1", 1), ("ACTIVE", "J1", 1), ("ACTIVE", "J1", 2), ("ACTIVE", "J2", 2),
           ("ACTIVE", "J2", 2), ("TERM", "J2", 2)]
    rows = [("E", f"s{i}", base + dt.timedelta(days=30 * i), s, j, d, base) for i, (s, j, d) in enumerate(seq)]
    dim = spark.createDataFrame(rows, "EIN string, SK string, EFF_DT date, ST string, JOB string, DIV int, HIRE date")
    spec = LifecycleSpec(key="EIN", eff="EFF_DT", status="ST", job="JOB", division="DIV", supervisor=None,
                         hire_date="HIRE", sk="SK")
    got = [r["EVENT_TYPE"] for r in sorted(lifecycle_events(dim, spec).collect(), key=lambda r: r["EVENT_DATE"])]
    assert got == ["HIRE", "LOA", "RETURN", "ORG_TRANSFER", "ROLE_CHANGE", "PROFILE_UPDATE", "TERMINATION"]


def test_staged_write_and_swap(spark, scratch):
    tbl = os.path.join(scratch, "t")
    sinks.write_staged(spark.range(3), tbl)
    v2 = sinks.write_staged(spark.range(5), tbl)
    assert sinks.read_current(spark, tbl).count() == 5 and v2.startswith(tbl)


def test_conform_and_contract(spark):
    a = spark.createDataFrame([(1, "x")], "id int, v string")
    b = spark.createDataFrame([(2, "y", 1.5)], "id bigint, v string, extra double")
    a2, b2 = sinks.conform(a, b)
    assert a2.schema == b2.schema and dict(a2.dtypes)["id"] == "bigint"
    from pyspark.sql import types as T
    schema = T.StructType([T.StructField("id", T.LongType(), False), T.StructField("v", T.StringType(), False)])
    more = a2.unionByName(spark.createDataFrame([(3, None, None)], a2.schema)).drop("extra")
    shaped, counts = sinks.enforce_contract(more, schema)
    assert shaped.columns == ["id", "v"] and counts.collect()[0]["v"] == 1


def test_audit_retention_boundaries(spark):
    as_of = dt.datetime(2025, 3, 1, 12, 0)
    names = [f.name for f in sinks.AUDIT_SCHEMA.fields]
    assert len(names) == 25

    def rows(days, prefix):
        out = []
        for d in days:
            r = dict.fromkeys(names)
            r.update(model_execution_id=f"{prefix}{d}", status="success", created_at=as_of - dt.timedelta(days=d))
            out.append(tuple(r[n] for n in names))
        return spark.createDataFrame(out, sinks.AUDIT_SCHEMA)

    kept = sorted(r["model_execution_id"] for r in
                  sinks.append_run_audit(rows((59, 60, 61), "old"), rows((61,), "new"), as_of, 60).collect())
    # existing rows older than 60 days go; the new batch is appended after the clean-up
    assert kept == ["new61", "old59", "old60"]


def test_sources_helpers(spark):
    lk = lookup_values(spark, [("A", 1)], "k string, v int")
    assert lk.count() == 1 and empty_table(spark, "a int").count() == 0
    h, d = spark.createDataFrame([(1,)], "a int"), spark.createDataFrame([(2,)], "a int")
    assert load(False, d, h).collect()[0]["a"] == 1 and load(True, d, h).collect()[0]["a"] == 2
    with pytest.raises(ValueError):
        load(True, spark.createDataFrame([(1,)], "b int"), h)
    log = spark.createDataFrame([], sinks.EVENT_SCHEMA)
    log = sinks.log_event(log, spark, "run started", dt.datetime(2025, 1, 1), model="m")
    assert log.count() == 1


def test_streaming_cdc_driver(spark, scratch):
    from tidemark.functions.hashing import md5_concat
    from tidemark.streaming.cdc_stream import start_cdc_stream
    src = os.path.join(scratch, "log")
    tgt = os.path.join(scratch, "ods")
    schema = "K string, BK string, TS timestamp_ntz, ID bigint, PKC string, V string"
    spark.createDataFrame([("A", "A", dt.datetime(2025, 1, 1), 1, "N", "a1"),
                           ("B", "B", dt.datetime(2025, 1, 1), 2, "N", "b1")], schema).write.parquet(src + "/p1")

    def transform(df, batch):
        return df.select("K", "V", md5_concat(["V"], "|").alias("HASH_CHANGE"),
                         F.lit("INSERT").alias("OPERATION_TYPE"), F.lit(batch).cast("bigint").alias("BATCH"))

    def run():
        q = start_cdc_stream(spark, src + "/*", spark.createDataFrame([], schema).schema, tgt, ["K"], ["BK"], "TS", "ID",
                             lambda: F.col("PKC") == "Y", transform, "K", no_update=["BATCH"], name="t_stream", buckets=None)
        q.awaitTermination(120)

    run()
    spark.createDataFrame([("C", "A", dt.datetime(2025, 1, 2), 3, "Y", "a1"),
                           ("B", "B", dt.datetime(2025, 1, 2), 4, "N", "b2")], schema).write.parquet(src + "/p2")
    run()
    out = {r["K"]: r["V"] for r in sinks.read_current(spark, tgt).collect()}
    assert out == {"A": "a1", "B": "b2", "C": "a1"}


def test_streaming_tombstones_renamed_keys(spark, scratch):
    from tidemark.functions.hashing import md5_concat
    from tidemark.streaming.cdc_stream import start_cdc_stream
    src, tgt = os.path.join(scratch, "log"), os.path.join(scratch, "ods")
    schema = "K string, BK string, TS timestamp_ntz, ID bigint, PKC string, V string"
    ddl = spark.createDataFrame([], schema).schema
    spark.createDataFrame([("A", "A", dt.datetime(2025, 1, 1), 1, "N", "a1")], schema).write.parquet(src + "/p1")

    def transform(df, batch):
        return df.select("K", "V", md5_concat(["V"], "|").alias("HASH_CHANGE"),
                         F.lit("INSERT").alias("OPERATION_TYPE"), F.lit("N").alias("SRC_DEL_IND"),
                         F.lit("I").alias("SRC_ACTION_CD"), F.lit(batch).cast("bigint").alias("ODS_UPD_BATCH_ID"),
                         F.lit(None).cast("timestamp_ntz").alias("ODS_UPDATE_TIMESTAMP"))

    def run():
        start_cdc_stream(spark, src + "/*", ddl, tgt, ["K"], ["BK"], "TS", "ID", lambda: F.col("PKC") == "Y",
                         transform, "K", name="t_tomb", buckets=None,
                         renamed_keys=lambda b: b.filter(F.col("PKC") == "Y").select(F.col("BK").alias("K")),
                         tombstone_ts=lambda e: dt.datetime(2025, 1, 3)).awaitTermination(120)

    run()
    spark.createDataFrame([("C", "A", dt.datetime(2025, 1, 2), 2, "Y", "a1")], schema).write.parquet(src + "/p2")
    run()
    out = {r["K"]: r["OPERATION_TYPE"] for r in sinks.read_current(spark, tgt).collect()}
    assert out == {"A": "DELETE", "C": "INSERT"}


def test_date_order_sentinels_and_contains_nulls(spark):
    rows = [(dt.date(2020, 1, 1), dt.date(2019, 1, 1)), (dt.date(1900, 1, 1), dt.date(1899, 1, 1)),
            (dt.date(9999, 12, 31), dt.date(9999, 12, 31))]
    df = spark.createDataFrame(rows, "HIRE date, TERM date")
    assert dq.date_order(df, "HIRE", "TERM").count() == 3
    assert dq.date_order(df, "HIRE", "TERM", dt.date(1900, 1, 1), dt.date(9999, 12, 31)).count() == 1
    names = spark.createDataFrame([("Ann Lee", "ann", "LEE"), ("Ann Lee", None, "Kim"), ("Bo Wu", "al", "wu")],
                                  "FULL string, F string, L string")
    assert [r["FULL"] for r in dq.contains_parts(names, "FULL", ["F", "L"]).collect()] == ["Bo Wu"]


def test_upsert_bucketed_rewrites_only_touched_buckets(spark, scratch):
    tbl = os.path.join(scratch, "bucketed")
    base = spark.range(2000).select(F.col("id").alias("K"), F.lit("a").alias("V"), F.lit("h").alias("HASH_CHANGE"),
                                    F.lit("INSERT").alias("OPERATION_TYPE"))
    sinks.write_bucketed(base, tbl, "K", 32)
    before = commits.head(spark, tbl)["buckets"]
    src = spark.createDataFrame([(7, "b", "h2", "INSERT"), (5000, "n", "h9", "INSERT"), (9, "a", "h", "INSERT")],
                                base.schema)
    sinks.upsert_bucketed(spark, tbl, src, "K", 32)
    out = sinks.read_bucketed(spark, tbl)
    got = {r["K"]: (r["V"], r["OPERATION_TYPE"]) for r in out.filter(F.col("K").isin(7, 9, 5000)).collect()}
    assert out.count() == 2001 and got == {7: ("b", "UPDATE"), 9: ("a", "INSERT"), 5000: ("n", "INSERT")}
    touched = {r[0] for r in sinks.with_bucket(src, "K", 32).select("_bucket").collect()}
    after = commits.head(spark, tbl)["buckets"]
    assert {b for b in after if after[b] != before.get(b)} == {str(b) for b in touched}   # untouched buckets keep their files


def test_streaming_bucketed_target(spark, scratch):
    from tidemark.functions.hashing import md5_concat
    from tidemark.streaming.cdc_stream import start_cdc_stream
    src, tgt = os.path.join(scratch, "log"), os.path.join(scratch, "ods")
    schema = "K string, BK string, TS timestamp_ntz, ID bigint, PKC string, V string"
    ddl = spark.createDataFrame([], schema).schema
    spark.createDataFrame([("A", "A", dt.datetime(2025, 1, 1), 1, "N", "a1"), ("B", "B", dt.datetime(2025, 1, 1), 2, "N", "b1")],
                          schema).write.parquet(src + "/p1")

    def transform(df, batch):
        return df.select("K", "V", md5_concat(["V"], "|").alias("HASH_CHANGE"),
                         F.lit("INSERT").alias("OPERATION_TYPE"), F.lit("N").alias("SRC_DEL_IND"),
                         F.lit("I").alias("SRC_ACTION_CD"), F.lit(batch).cast("bigint").alias("ODS_UPD_BATCH_ID"),
                         F.lit(None).cast("timestamp_ntz").alias("ODS_UPDATE_TIMESTAMP"))

    def run():
        start_cdc_stream(spark, src + "/*", ddl, tgt, ["K"], ["BK"], "TS", "ID", lambda: F.col("PKC") == "Y",
                         transform, "K", name="t_bucketed", buckets=8,
                         renamed_keys=lambda b: b.filter(F.col("PKC") == "Y").select(F.col("BK").alias("K")),
                         tombstone_ts=lambda e: dt.datetime(2025, 1, 3)).awaitTermination(120)

    run()
    spark.createDataFrame([("C", "A", dt.datetime(2025, 1, 2), 3, "Y", "a1"), ("B", "B", dt.datetime(2025, 1, 2), 4, "N", "b2")],
                          schema).write.parquet(src + "/p2")
    run()
    out = {r["K"]: (r["V"], r["OPERATION_TYPE"]) for r in sinks.read_bucketed(spark, tgt).collect()}
    assert out == {"A": ("a1", "DELETE"), "B": ("b2", "UPDATE"), "C": ("a1", "INSERT")}


@pytest.mark.parametrize("buckets", [None, 8])
def test_streaming_epoch_and_overlap(spark, scratch, buckets):
    """Without order columns: a replayed epoch changes nothing, because the commit records it; log rows that
    come twice within the overlap are dropped by their id."""
    from tidemark.functions.hashing import md5_concat
    from tidemark.session import checkpoint_dir
    from tidemark.streaming.cdc_stream import start_cdc_stream
    src, tgt, name = os.path.join(scratch, "log"), os.path.join(scratch, "ods"), "t_epoch" + scratch[-6:]
    schema = "K string, BK string, TS timestamp_ntz, ID bigint, PKC string, V string"
    ddl = spark.createDataFrame([], schema).schema
    seen = []

    def transform(df, batch):
        seen.append((batch, df.count()))
        return df.select("K", "V", md5_concat(["V"], "|").alias("HASH_CHANGE"), F.lit("INSERT").alias("OPERATION_TYPE"))

    def run():
        start_cdc_stream(spark, src + "/*", ddl, tgt, ["K"], ["BK"], "TS", "ID", lambda: F.col("PKC") == "Y",
                         transform, "K", name=name, buckets=buckets, overlap="3 minutes").awaitTermination(120)

    def put(n, *rows):
        spark.createDataFrame(list(rows), schema).coalesce(1).write.parquet(f"{src}/p{n}")

    def state():
        df = sinks.read_bucketed(spark, tgt) if buckets else sinks.read_current(spark, tgt)
        return {r["K"]: r["V"] for r in df.collect()}

    at = dt.datetime(2025, 1, 1, 12)
    put(1, ("A", "A", at, 1, "N", "a1"), ("B", "B", at, 2, "N", "b1"))
    run()
    # the overlap delivers id 2 once more, with id 3 as new
    put(2, ("B", "B", at, 2, "N", "again"), ("A", "A", at + dt.timedelta(minutes=1), 3, "N", "a3"))
    run()
    assert state() == {"A": "a3", "B": "b1"} and [n for _, n in seen] == [2, 1]
    done = (commits.last_epoch if buckets else sinks.last_epoch)(spark, tgt, name)
    assert done == seen[-1][0]
    # the driver is lost after the commit of the last epoch: its checkpoint entry goes, the epoch runs again
    log = os.path.join(checkpoint_dir(spark).removeprefix("file:"), f"stream-{name}", "commits")
    for f in os.listdir(log):
        if (number := f.removeprefix(".").split(".")[0]).isdigit() and int(number) >= done:
            os.remove(os.path.join(log, f))
    before = commits.head(spark, tgt)["version"] if buckets else sinks.read_current(spark, tgt).inputFiles()
    run()
    assert state() == {"A": "a3", "B": "b1"}
    assert before == (commits.head(spark, tgt)["version"] if buckets else sinks.read_current(spark, tgt).inputFiles())


@pytest.mark.parametrize("buckets", [None, 8])
def test_streaming_replay_and_late_files(spark, scratch, buckets):
    """A key is renamed away and used again in one batch; the epoch is replayed, and an older file
    lands late: the newest row stays live."""
    from tidemark.functions.hashing import md5_concat
    from tidemark.streaming.cdc_stream import start_cdc_stream
    src, tgt = os.path.join(scratch, "log"), os.path.join(scratch, "ods")
    schema = "K string, BK string, TS timestamp_ntz, ID bigint, PKC string, V string"
    ddl = spark.createDataFrame([], schema).schema

    def day(n):
        return dt.datetime(2025, 1, n)

    def transform(df, batch):
        return df.select("K", "V", "TS", "ID", md5_concat(["V"], "|").alias("HASH_CHANGE"),
                         F.lit("INSERT").alias("OPERATION_TYPE"), F.lit("N").alias("SRC_DEL_IND"),
                         F.lit("I").alias("SRC_ACTION_CD"), F.lit(batch).cast("bigint").alias("ODS_UPD_BATCH_ID"),
                         F.lit(None).cast("timestamp_ntz").alias("ODS_UPDATE_TIMESTAMP"))

    def run(name):
        start_cdc_stream(spark, src + "/*", ddl, tgt, ["K"], ["BK"], "TS", "ID", lambda: F.col("PKC") == "Y",
                         transform, "K", name=name, buckets=buckets, order_cols=["TS", "ID"],
                         renamed_keys=lambda b: b.filter(F.col("PKC") == "Y").select(F.col("BK").alias("K"), "TS", "ID"),
                         tombstone_ts=lambda e: day(9)).awaitTermination(120)

    def state():
        df = sinks.read_bucketed(spark, tgt) if buckets else sinks.read_current(spark, tgt)
        return {r["K"]: (r["V"], r["OPERATION_TYPE"], r["SRC_DEL_IND"]) for r in df.collect()}

    spark.createDataFrame([("A", "A", day(1), 1, "N", "a1"), ("B", "B", day(3), 5, "N", "b3")], schema).write.parquet(src + "/p1")
    run("t_replay" + scratch[-6:])
    spark.createDataFrame([("C", "A", day(2), 2, "Y", "a1"), ("A", "A", day(2), 3, "N", "a2")], schema).write.parquet(src + "/p2")
    run("t_replay" + scratch[-6:])
    want = {"A": ("a2", "UPDATE", "N"), "B": ("b3", "INSERT", "N"), "C": ("a1", "INSERT", "N")}
    assert state() == want
    # a stream of another name starts over: every file once more, as after a lost checkpoint
    run("t_again" + scratch[-6:])
    assert state() == want
    spark.createDataFrame([("B", "B", day(1), 4, "N", "b1"), ("X", "A", day(1), 0, "Y", "x")], schema).write.parquet(src + "/p3")
    run("t_replay" + scratch[-6:])
    assert state() == want | {"X": ("x", "INSERT", "N")}


def test_published_epoch_is_skipped(spark, scratch):
    tbl = os.path.join(scratch, "t")
    df = spark.range(3)
    sinks.write_staged(df, tbl)
    assert sinks.last_epoch(spark, tbl, "s") is None
    sinks.write_staged(df, tbl, stream="s", epoch=4)
    sinks.write_staged(df, tbl, stream="other", epoch=9)
    assert sinks.last_epoch(spark, tbl, "s") == 4


def test_vacuum_and_staged_clean_up(spark, scratch):
    tbl = os.path.join(scratch, "t")
    for i in range(1, 5):
        sinks.write_staged(spark.range(i), tbl)
    assert sinks.vacuum(spark, tbl, keep=2) == 2 and sinks.read_current(spark, tbl).count() == 4
    assert len([d for d in os.listdir(tbl) if d.startswith("v-")]) == 2 and sinks.vacuum(spark, tbl, keep=2) == 0
    sinks.cut_lineage(spark.range(2))
    assert sinks.remove_staged(spark, dt.timedelta(days=1)) == 0


def test_conform_never_narrows(spark):
    from decimal import Decimal as D
    t = spark.createDataFrame([(D("12.75"), dt.datetime(2025, 1, 1, 6), 5_000_000_000, 1.5, "x")],
                              "d decimal(18,2), ts timestamp_ntz, b bigint, f double, s string")
    s = spark.createDataFrame([(7, dt.date(2025, 1, 2), 3, 2, 9, "new")], "d int, ts date, b smallint, f int, s int, n string")
    a, b = sinks.conform(t, s)
    assert a.schema == b.schema and a.columns == ["d", "ts", "b", "f", "s", "n"]
    x, y = a.collect()[0], b.collect()[0]
    assert (x["d"], x["ts"], x["b"], x["f"], x["s"], x["n"]) == (D("12.75"), dt.datetime(2025, 1, 1, 6), 5_000_000_000, 1.5, "x", None)
    assert (y["d"], y["ts"], y["b"], y["f"], y["s"], y["n"]) == (D("7"), dt.datetime(2025, 1, 2), 3, 2.0, "9", "new")


def test_contract_breaches(spark):
    from pyspark.sql import types as T
    schema = T.StructType([T.StructField("a", T.LongType(), False), T.StructField("b", T.StringType()),
                           T.StructField("c", T.IntegerType())])
    df = spark.createDataFrame([("x", None, 1.0), ("y", 2, 1.0)], "b string, a bigint, z double")
    got = sorted(map(tuple, sinks.contract_violations(df, schema).collect()), key=str)
    assert got == sorted([("c", "missing", "int", "-", None), ("z", "extra", "-", "double", None), ("a", "order", "0", "1", None),
                          ("b", "order", "1", "0", None), ("a", "null", "not null", "null", 1)], key=str)
    with pytest.raises(ValueError, match="extra: z"):
        sinks.enforce_contract(df, schema)
    typed = spark.createDataFrame([(1, "x", "3")], "a bigint, b string, c string")
    assert [tuple(r) for r in sinks.contract_violations(typed, schema).collect()] == [("c", "type", "int", "string", None)]


def test_checkpoint_folder_is_needed_on_a_cluster():
    from types import SimpleNamespace
    from tidemark.session import checkpoint_dir
    fake = SimpleNamespace(conf=SimpleNamespace(get=lambda k, d=None: None),
                           sparkContext=SimpleNamespace(getCheckpointDir=lambda: None, master="yarn"))
    with pytest.raises(RuntimeError, match="spark.checkpoint.dir"):
        checkpoint_dir(fake)


def test_keys_are_padded_but_never_cut(spark):
    df = spark.createDataFrame([("7",), ("1000",), ("123456789",), (None,)], "k string")
    assert [r[0] for r in df.select(X.pad_left("k", 3)).collect()] == ["007", "1000", "123456789", None]


def test_event_log_widens_old_table(spark):
    old = spark.createDataFrame([("run started", dt.datetime(2025, 1, 1))], "event_name string, event_timestamp timestamp_ntz")
    log = sinks.log_event(old, spark, "model deployment completed", dt.datetime(2025, 1, 2), schema="ODS",
                          model="ODS_T", full_refresh=True, query_id="q1")
    assert log.count() == 2 and "query_id" in log.columns
    r = log.filter("event_name = 'model deployment completed'").collect()[0]
    assert r["event_is_full_refresh"] is True and r["event_model"] == "ODS_T"


def test_geo_point_and_corrected_address(spark):
    from decimal import Decimal as D
    geo = spark.createDataFrame([(D("45.5"), D("-73.6")), (D("91"), D("10")), (None, D("10")), (D("-90"), D("180"))],
                                "LAT decimal(11,6), LON decimal(11,6)")
    pts = [r["p"] for r in geo.select(X.geo_point("LAT", "LON").alias("p")).collect()]
    assert pts[0] is not None and pts[1] is None and pts[2] is None and pts[3] is not None
    addr = spark.createDataFrame([("1 Main", "Apt 2", "Bldg 3", "N", None, None, None),
                                  ("  ", "Apt 2", "Bldg 3", "N", None, None, None),
                                  (None, " ", "Bldg 3", "N", None, None, None),
                                  ("1 Main", "", "Bldg 3", "N", None, None, None),
                                  ("x", "y", "z", "Y", "V1", "V2", "V3")],
                                 "L1 string, L2 string, L3 string, OK string, V1 string, V2 string, V3 string")
    a1, a2, a3 = X.corrected_address("L1", "L2", "L3", "OK", "V1", "V2", "V3")
    got = [(r["a"], r["b"], r["c"]) for r in addr.select(a1.alias("a"), a2.alias("b"), a3.alias("c")).collect()]
    assert got == [("1 Main", "Apt 2", "Bldg 3"), ("Apt 2", "Bldg 3", ""), ("Bldg 3", "", ""),
                   ("1 Main", "Bldg 3", ""), ("V1", "V2", "V3")]


def test_model_coefficient_cases(spark):
    import datetime as _d
    schema = "TRAINED_AT timestamp_ntz, DX array<string>, DC map<string,double>, SX array<string>, SC map<string,double>"
    as_of = _d.datetime(2025, 3, 1)
    good = (_d.datetime(2025, 2, 20), ["base", "b"], {"base": 0.0, "b": 1.2}, ["s0"], {"s0": 0.0})
    bl = [("division", "DX", "DC"), ("service", "SX", "SC")]

    def issues(rows):
        df = spark.createDataFrame(rows, schema)
        return sorted(r["FAILURE"] for r in dq.model_coefficients(df, "TRAINED_AT", bl, as_of, 30).collect())

    assert issues([]) == ["row_count_not_1", "trained_at_stale_or_null"]           # 0 rows
    assert issues([good]) == []                                                      # 1 good row
    assert issues([good, good]) == ["row_count_not_1"]                              # 2 rows
    stale = (_d.datetime(2025, 1, 1),) + good[1:]
    assert issues([stale]) == ["trained_at_stale_or_null"]
    bad = (good[0], ["x"], {"base": 0.0}, ["s0"], {"s0": 0.5})                      # missing / non-zero
    assert issues([bad]) == ["division_baseline_missing_or_nonzero", "service_baseline_missing_or_nonzero"]


def test_variant_parse_is_tolerant(spark):
    """Broken JSON, wrong types and missing paths give NULL; nested values and numbers in text are read."""
    rows = [(1, '{"k": 3, "a": {"b": [1, 2.5]}}'), (2, '{"k": 3'), (3, '{"k": "x"}'), (4, None), (5, "[1, 2]"), (6, '{"k": "7"}'), (7, "")]
    v = spark.createDataFrame(rows, "id int, p string").select("id", X.parse_variant("p").alias("v"))
    got = {r["id"]: (r["k"], r["b"], r["broken"]) for r in v.select(
        "id", X.variant_value("v", "$.k", "int").alias("k"), X.variant_value("v", "$.a.b[1]", "double").alias("b"),
        F.col("v").isNull().alias("broken")).collect()}
    assert got == {1: (3, 2.5, False), 2: (None, None, True), 3: (None, None, False), 4: (None, None, True),
                   5: (None, None, False), 6: (7, None, False), 7: (None, None, True)}
