"""Hash specs (H3-H5), changed keys (K1), enrichment retry (K3), append (A7), backfill."""

import datetime as dt
import hashlib

from pyspark.sql import functions as F

from tidemark.functions.hashing import hash_change, hash_full, hash_scd1, hash_scd2
from tidemark.operators.delta import ALL_ROWS, KeySource, changed_keys, target_mark, with_reprocess
from tidemark.operators.merge import ACTION, append
from tidemark.operators.scd import backfill_dim
from tidemark.spec import TableSpec


def md5(s):
    return hashlib.md5(s.encode()).hexdigest()


def test_hash_specs(spark):
    spec = TableSpec(columns=("ROW_PK", "K", "A", "B", "LOAD_TS"), natural_keys=("K",), audit=("LOAD_TS",),
                     scd1=("B",), scd2=("A",))
    df = spark.createDataFrame([("pk", "k1", "x", None, dt.datetime(2025, 1, 1))],
                               "ROW_PK string, K string, A string, B string, LOAD_TS timestamp_ntz")
    r = df.select(hash_change(spec).alias("c"), hash_full(spec).alias("f"), hash_scd1(spec).alias("s1"),
                  hash_scd2(spec).alias("s2")).collect()[0]
    assert r["c"] == md5("x|")                     # keys, audit and *_PK excluded; NULL -> ''
    assert r["f"] == md5("pk|k1|x|")               # only audit excluded
    assert r["s1"] == md5("") and r["s2"] == md5("x")
    none = TableSpec(columns=("K",))
    assert df.select(hash_scd2(none)).collect()[0][0] == md5("NO_SCD2_COLUMNS_TAGGED")


def test_changed_keys_marks(spark):
    src = spark.createDataFrame([(1, dt.datetime(2025, 1, 1)), (2, dt.datetime(2025, 1, 5)), (2, dt.datetime(2025, 1, 6))],
                                "K long, TS timestamp_ntz")
    tgt = spark.createDataFrame([(dt.datetime(2025, 1, 2),)], "MARK timestamp_ntz")
    empty = spark.createDataFrame([], "MARK timestamp_ntz")
    other = spark.createDataFrame([(7,)], "K long")
    keys = changed_keys([
        KeySource(src, [F.col("K")], "TS", target_mark(tgt, "MARK")),
        KeySource(src, [F.col("K")], "TS", target_mark(empty, "MARK")),   # NULL mark: nothing
        KeySource(other, [F.col("K")], None, ALL_ROWS),                   # no watermark: all rows
    ])
    assert sorted(r["K"] for r in keys.collect()) == [2, 7]


def test_with_reprocess_new_wins(spark):
    delta_keys = spark.createDataFrame([("E1",), ("E2",)], "EIN string")
    target = spark.createDataFrame([("E2", None, "u2"), ("E3", None, "u3"), ("E4", None, "u9"), ("E5", 5, "u5")],
                                   "EIN string, USER_ID int, NET string")
    lookup = spark.createDataFrame([("u2",), ("u3",), ("u5",)], "USER_CODE string")
    out = {r["EIN"]: r["PROCESS_TYPE"] for r in
           with_reprocess(delta_keys, target, "EIN", "USER_ID", lookup, "USER_CODE", "NET").collect()}
    assert out == {"E1": "NEW", "E2": "NEW", "E3": "REPROCESS"}


def test_append_by_name(spark):
    t = spark.createDataFrame([(1, "a")], "K int, V string")
    s = spark.createDataFrame([("b", 2)], "V string, K int")
    out = sorted((r["K"], r["V"], r[ACTION]) for r in append(t, s).collect())
    assert out == [(1, "a", "unchanged"), (2, "b", "insert")]


def test_backfill_dim(spark):
    hist = spark.createDataFrame([(1, "O", dt.date(2020, 1, 1), dt.date(2020, 12, 31)),
                                  (1, "F", dt.date(2021, 1, 1), dt.date(9999, 12, 31)),
                                  (2, "O", dt.date(2020, 1, 1), dt.date(9999, 12, 31))],
                                 "K long, ST string, EFF_DT date, DISC_DT date")
    lk = spark.createDataFrame([(1, "Ann Lee Longname"), (2, "Bo")], "ID long, NAME string")
    spec = TableSpec(columns=("K", "NAME", "ST"), scd2=("ST",), scd1=("NAME",))
    out = backfill_dim(hist, lk, "K", "ID", [("K", "K", None, None), ("NAME", "NAME", "string", 5), ("ST", "ST", None, None)],
                       spec, exclude_ids=[2])
    rows = sorted(out.collect(), key=lambda r: (r["K"], r["EFF_DT"]))
    assert [r["NAME"] for r in rows] == ["Ann L", "Ann L", None]       # truncated; id 2 not enriched
    assert [r["IS_CURRENT"] for r in rows] == [False, True, True]
    assert rows[0]["K_SK"] == md5("1-2020-01-01") and {r["OPERATION_TYPE"] for r in rows} == {"HISTORICAL"}
    assert rows[1]["HASH_SCD2"] == md5("F")


def test_incremental_star_semi_joins_every_source(spark):
    from tidemark.operators.delta import incremental_star
    drv = spark.createDataFrame([(1, "a"), (2, "b"), (3, "c")], "K int, NAME string")
    s1 = spark.createDataFrame([(1, 10), (2, 20), (3, 30)], "K int, X int")
    s2 = spark.createDataFrame([(2, "x2"), (3, "x3")], "K int, Y string")
    keys = spark.createDataFrame([(2,), (3,), (3,), (9,)], "K int")        # duplicates and unknown keys
    out = sorted(tuple(r) for r in incremental_star(drv, [(s1, ["K"]), (s2, ["K"])], keys, ["K"]).collect())
    assert out == [(2, "b", 20, "x2"), (3, "c", 30, "x3")]                 # one row per changed driving key


def test_dq_score_and_cdc_delete_flags(spark):
    import decimal
    from tidemark.operators.lifecycle import dq_score
    from tidemark.plans.q_ods import ods_transform
    df = spark.createDataFrame([(1, "a"), (None, "b"), (3, None)], "K int, V string")
    got = sorted((r["K"] or 0, r["DQ_SCORE"], r["DQ_STATUS"]) for r in dq_score(df, ["K", "V"]).collect())
    assert got == [(0, decimal.Decimal("0.00"), "FAILED"), (1, decimal.Decimal("100.00"), "PASSED"),
                   (3, decimal.Decimal("0.00"), "FAILED")]
    log = spark.createDataFrame([(7, dt.datetime(2024, 1, 5), " D ", "click", decimal.Decimal("1.00")),
                                 (8, dt.datetime(2024, 1, 5), "U", "view", decimal.Decimal("2.00"))],
                                "USER_KEY long, CAPTURE_TS timestamp_ntz, CAPTURE_ACTION string, EVENT_TYPE string, "
                                "AMOUNT decimal(18,2)")
    rows = {r["USER_KEY"]: r for r in ods_transform(log, 1, dt.datetime(2024, 2, 1)).collect()}
    assert (rows[7]["SRC_ACTION_CD"], rows[7]["SRC_DEL_IND"], rows[7]["OPERATION_TYPE"]) == ("D", "Y", "DELETE")
    assert (rows[8]["SRC_DEL_IND"], rows[8]["OPERATION_TYPE"]) == ("N", "INSERT")


def test_enrich_with_retry_goes_back_to_the_source(spark):
    from tidemark.operators.delta import enrich_with_retry, with_reprocess
    source = spark.createDataFrame([(1, "x"), (2, "y"), (3, None), (4, "z"), (5, "x")], "K int, L string")
    target = spark.createDataFrame([(1, "x", "X"), (2, "y", None), (3, None, None), (4, "z", None)], "K int, L string, NAME string")
    lookup = spark.createDataFrame([("x", "X"), ("y", "Y")], "CODE string, NAME string")
    delta = spark.createDataFrame([(5,), (5,)], "K int")
    keys = with_reprocess(delta, target, "K", "NAME", lookup, "CODE", "L")
    out = enrich_with_retry(source, keys, "K", lookup, "L", "CODE", ["NAME"], names=("src", "lk"))
    assert sorted(map(tuple, out.collect())) == [(2, "y", "Y", "REPROCESS", "src,lk"), (5, "x", "X", "NEW", "src,lk")]


def test_audit_row_of_a_step(spark):
    import datetime as dt
    from tidemark.sources.sinks import AUDIT_SCHEMA, audit_row
    merged = spark.createDataFrame([("insert",), ("insert",), ("update",), ("close",), ("unchanged",)], "_action string")
    t0, t1 = dt.datetime(2025, 1, 1, 6), dt.datetime(2025, 1, 1, 6, 0, 30)
    ok = audit_row(merged, "m", "run1", t0, t1)
    assert [f.dataType for f in ok.schema] == [f.dataType for f in AUDIT_SCHEMA] and ok.columns == AUDIT_SCHEMA.names
    r = ok.collect()[0]
    assert (r["rows_inserted"], r["rows_updated"], r["rows_deleted"], r["rows_affected"], r["execution_time"]) == (2, 2, 0, 4, 30.0)
    bad = audit_row(merged, "m", "run1", t0, t1, status="error", message="no").collect()[0]
    assert bad["rows_inserted"] is None and bad["failures"] == 1 and bad["message"] == "no"


def test_run_suite_counts_row_checks_of_a_table_in_one_scan(spark):
    from pyspark.sql import functions as F
    from tidemark.operators import dq
    df = spark.createDataFrame([(1, None), (None, "x"), (-1, "y")], "a int, b string")
    got = dq.run_suite([("dups", lambda: dq.duplicates(df, ["a"]))],
                       row_checks=[(df, [("a_neg", F.col("a") < 0), ("b_null", F.col("b").isNull()), ("none", F.col("a") > 9)])])
    assert sorted(map(tuple, got.collect())) == [("a_neg", 1, "warn"), ("b_null", 1, "warn"), ("dups", 0, "pass"), ("none", 0, "pass")]
