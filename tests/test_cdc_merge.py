"""CDC resolve cases (FIXTURES §4), hash-gated upsert, delete marking, tombstones, purge."""

import datetime as dt

import pandas as pd
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from tidemark.operators.dedup import cdc_resolve, latest_per_key, purge_duplicates
from tidemark.operators.merge import (ACTION, delete_insert, mark_deleted, merge_counts, merge_upsert,
                                      propagate_deletes, tombstone_renamed)

LOG = "K string, BK string, TS timestamp_ntz, ID bigint, ACT string, PKC string, V string"


def t(h, m=0):
    return dt.datetime(2025, 1, 1, h, m)


def resolve(spark, rows, mark=None, keyed=True):
    df = spark.createDataFrame(rows, LOG)
    out = cdc_resolve(df, "K", "BK", "TS", "ID", F.col("PKC") == "Y", mark=mark, keyed=keyed)
    return {r["K"]: r.asDict() for r in out.collect()}


def test_insert_update_delete(spark):
    rows = [("A", "A", t(1), 1, "I", "N", "a1"), ("A", "A", t(2), 2, "U", "N", "a2"),
            ("B", "B", t(1), 3, "I", "N", "b1"), ("B", "B", t(3), 4, "D", "N", "b1")]
    r = resolve(spark, rows)
    assert r["A"]["V"] == "a2" and r["B"]["ACT"] == "D"


def test_rename_removes_old_key(spark):
    rows = [("A", "A", t(1), 1, "I", "N", "x"), ("B", "A", t(2), 2, "U", "Y", "x")]
    assert set(resolve(spark, rows)) == {"B"}


def test_rename_then_new_a_survives(spark):
    rows = [("A", "A", t(1), 1, "I", "N", "x"), ("B", "A", t(2), 2, "U", "Y", "x"),
            ("A", "A", t(3), 3, "I", "N", "new")]
    r = resolve(spark, rows)
    assert set(r) == {"A", "B"} and r["A"]["V"] == "new"


def test_rename_tie_on_id_removes(spark):
    # the rename record's id equals the kept row's id: >= removes the key
    rows = [("A", "A", t(1), 5, "I", "N", "x"), ("B", "A", t(1), 5, "U", "Y", "x")]
    assert "A" not in resolve(spark, rows)


def test_record_before_watermark_ignored(spark):
    rows = [("A", "A", t(1), 1, "I", "N", "old"), ("A", "A", t(5), 2, "U", "N", "new"),
            ("C", "C", t(1), 3, "I", "N", "c")]
    r = resolve(spark, rows, mark=t(4))
    assert set(r) == {"A"} and r["A"]["V"] == "new"


def test_null_key_dropped_and_null_ts_preferred(spark):
    rows = [(None, None, t(1), 1, "I", "N", "n"), ("A", "A", t(9), 2, "I", "N", "late"),
            ("A", "A", None, 3, "U", "N", "nullts")]
    r = resolve(spark, rows)
    assert set(r) == {"A"} and r["A"]["V"] == "nullts"   # DESC NULLS FIRST (trap T1)


def test_composite_keys(spark):
    df = spark.createDataFrame(
        [("1", "10", "1", "10", t(1), 1, "N"), ("1", "11", "1", "10", t(2), 2, "Y"), ("2", None, "2", None, t(1), 3, "N")],
        "C string, A string, BC string, BA string, TS timestamp_ntz, ID bigint, PKC string")
    out = cdc_resolve(df, ["C", "A"], ["BC", "BA"], "TS", "ID", F.col("PKC") == "Y")
    assert sorted((r["C"], r["A"]) for r in out.collect()) == [("1", "11")]


def test_unkeyed_variant_overdeletes(spark):
    # A rename suppresses its before key whenever any kept id is smaller
    rows = [("A", "A", t(1), 10, "I", "N", "x"), ("Z", "Z", t(1), 1, "I", "N", "z"),
            ("B", "A", t(2), 5, "U", "Y", "x"), ("A", "A", t(3), 20, "U", "N", "y")]
    keyed = resolve(spark, rows)
    unkeyed = resolve(spark, rows, keyed=False)
    assert "A" in keyed and "A" not in unkeyed


TGT = "K string, V string, HASH_CHANGE string, OPERATION_TYPE string, INS_BATCH bigint, SRC_DEL_IND string"


def test_merge_gated_ungated_and_no_update(spark):
    tgt = spark.createDataFrame([("A", "a", "h1", "INSERT", 1, "N"), ("B", "b", "h2", "INSERT", 1, "N")], TGT)
    src = spark.createDataFrame([("A", "a", "h1", "INSERT", 2, "N"), ("B", "bb", "h3", "DELETE", 2, "Y"),
                                 ("C", "c", "h4", "INSERT", 2, "N")], TGT)
    out = {r["K"]: r.asDict() for r in merge_upsert(tgt, src, "K", no_update=["INS_BATCH"]).collect()}
    assert out["A"][ACTION] == "unchanged" and out["A"]["INS_BATCH"] == 1
    assert out["B"]["V"] == "bb" and out["B"]["OPERATION_TYPE"] == "DELETE" and out["B"]["INS_BATCH"] == 1
    assert out["C"][ACTION] == "insert" and out["C"]["OPERATION_TYPE"] == "INSERT"
    ung = {r["K"]: r.asDict() for r in merge_upsert(tgt, src, "K", gate=None).collect()}
    assert ung["A"][ACTION] == "update" and ung["A"]["OPERATION_TYPE"] == "UPDATE"
    c = merge_counts(merge_upsert(tgt, src, "K")).collect()[0]
    assert (c["rows_inserted"], c["rows_updated"], c["rows_total"]) == (1, 1, 3)


def test_deleted_row_with_same_hash_stays_deleted(spark):
    # A deletion mark bypasses the hash, so an identical comeback does not revive it
    tgt = spark.createDataFrame([("A", "a", "h1", "DELETE", 1, "Y")], TGT)
    src = spark.createDataFrame([("A", "a", "h1", "INSERT", 2, "N")], TGT)
    r = merge_upsert(tgt, src, "K").collect()[0]
    assert r["OPERATION_TYPE"] == "DELETE" and r[ACTION] == "unchanged"


def test_delete_insert(spark):
    tgt = spark.createDataFrame([("A", "a", "h1", "INSERT", 1, "N"), ("B", "b", "h2", "INSERT", 1, "N")], TGT)
    src = spark.createDataFrame([("A", "z", "h9", "INSERT", 2, "N")], TGT)
    out = {r["K"]: r["V"] for r in delete_insert(tgt, src, "K").collect()}
    assert out == {"A": "z", "B": "b"}


ODS = ("K string, OPERATION_TYPE string, SRC_DEL_IND string, SRC_ACTION_CD string, "
       "ODS_UPDATE_TIMESTAMP timestamp_ntz, ODS_UPD_BATCH_ID bigint")


def test_mark_deleted_latest_snapshot_trimmed_keys(spark):
    ods = spark.createDataFrame([
        ("A", "INSERT", "N", "I", t(1), 1), ("B ", "INSERT", "N", "I", t(2), 2),
        ("C", "DELETE", "Y", "D", t(1), 1), ("D", "UPDATE", "N", "U", t(3), 3)], ODS)
    stg = spark.createDataFrame([(" A", t(5)), ("B", t(5)), ("D", t(4))], "K string, STG_INSERT_TIMESTAMP timestamp_ntz")
    out = {r["K"]: r.asDict() for r in mark_deleted(ods, stg, "K").collect()}
    assert out["A"]["OPERATION_TYPE"] == "INSERT" and out["B "]["OPERATION_TYPE"] == "INSERT"
    assert out["C"][ACTION] == "unchanged"                          # already deleted: untouched
    d = out["D"]                                                    # absent from the latest load
    assert (d["OPERATION_TYPE"], d["SRC_DEL_IND"], d["SRC_ACTION_CD"]) == ("DELETE", "Y", "D")
    assert d["ODS_UPDATE_TIMESTAMP"] == t(3) and d["ODS_UPD_BATCH_ID"] == 3


def test_tombstone_and_propagate(spark):
    ods = spark.createDataFrame([("A", "INSERT", "N", "I", t(1), 1), ("B", "INSERT", "N", "I", t(1), 1)], ODS)
    renamed = spark.createDataFrame([("A",)], "K string")
    out = {r["K"]: r.asDict() for r in tombstone_renamed(ods, renamed, "K", t(9), 99).collect()}
    assert out["A"]["OPERATION_TYPE"] == "DELETE" and out["A"]["ODS_UPD_BATCH_ID"] == 99
    assert out["B"]["OPERATION_TYPE"] == "INSERT"
    dim = spark.createDataFrame([("A", False), ("A", False), ("B", False)], "K string, IS_DELETED boolean")
    flagged = propagate_deletes(dim, renamed, "K").collect()
    assert sorted((r["K"], r["IS_DELETED"]) for r in flagged) == [("A", True), ("A", True), ("B", False)]


def test_purge_keeps_top_and_null_exclude_rows(spark):
    rows = [("x", t(3), 3), ("x", t(2), 2), ("x", None, 1), ("y", t(1), 1), ("y", t(1), 1)]
    df = spark.createDataFrame(rows, "V string, TS timestamp_ntz, B bigint")
    kept = sorted((r["V"], r["TS"], r["B"]) for r in purge_duplicates(df, ["TS", "B"]).collect())
    # NULL sorts first in DESC, so the NULL row is the top of 'x' and the others are purged
    assert kept == [("x", None, 1), ("y", t(1), 1), ("y", t(1), 1)]


@settings(max_examples=15, deadline=None)
@given(st.lists(st.tuples(st.integers(0, 4), st.integers(0, 6), st.integers(0, 1000)), min_size=1, max_size=40,
                unique_by=lambda x: x[2]))
def test_latest_per_key_matches_brute_force(spark, rows):
    df = spark.createDataFrame(rows, "K int, O int, T int")
    got = sorted(tuple(r) for r in latest_per_key(df, "K", ["O"], ["T"]).collect())
    pdf = pd.DataFrame(rows, columns=["K", "O", "T"]).sort_values(["O", "T"], ascending=False)
    want = sorted(tuple(int(x) for x in r) for r in pdf.groupby("K").head(1).itertuples(index=False))
    assert got == want


def test_merge_rejects_duplicate_source_keys(spark):
    import pytest
    tgt = spark.createDataFrame([("A", "a", "h1", "INSERT", 1, "N")], TGT)
    src = spark.createDataFrame([("B", "b", "h2", "INSERT", 2, "N"), ("B", "c", "h3", "INSERT", 2, "N")], TGT)
    with pytest.raises(ValueError):
        merge_upsert(tgt, src, "K", check_unique=True)


def test_active_only_and_recent(spark):
    from tidemark.functions.expr import active_only, recent
    df = spark.createDataFrame([("a", False, t(1)), ("b", True, dt.datetime(2010, 1, 1))],
                               "K string, IS_DELETED boolean, TS timestamp_ntz")
    assert [r["K"] for r in active_only(df, "IS_DELETED").collect()] == ["a"]
    assert [r["K"] for r in recent(df, "TS", 8, dt.date(2025, 6, 1)).collect()] == ["a"]


def test_merge_counts_fresh_table(spark):
    fresh = spark.createDataFrame([("A",), ("B",)], "K string")
    c = merge_counts(fresh).collect()[0]
    assert (c["rows_inserted"], c["rows_updated"], c["rows_total"]) == (2, 0, 2)


def test_cdc_resolve_rejects_mismatched_keys(spark):
    import pytest
    df = spark.createDataFrame([], LOG)
    with pytest.raises(ValueError):
        cdc_resolve(df, ["K", "V"], ["BK"], "TS", "ID", F.col("PKC") == "Y")
