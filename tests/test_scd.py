"""SCD merge decision table (one test per case), type 1 / type 6, history build."""

import datetime as dt

import pytest
from pyspark.sql import functions as F

from tidemark.functions.hashing import md5_concat
from tidemark.operators.merge import ACTION
from tidemark.operators.scd import OPEN_DATE, scd2_from_history, scd6_propagate, scd_init, scd_merge

RUN = dt.date(2025, 3, 10)
RUN_BATCH = 20250310060000000
OLD_BATCH = 20250101060000000
SCHEMA = ("EIN string, JOB_CODE string, CITY string, HASH_SCD2 string, HASH_SCD1 string, EFF_DT date, "
          "DISC_DT date, IS_CURRENT boolean, INS_BATCH_ID bigint, UPD_BATCH_ID bigint")


def _h(v):
    import hashlib
    return hashlib.md5((v or "").encode()).hexdigest()


def row(ein, job, city, eff, disc=OPEN_DATE, cur=None, batch=OLD_BATCH):
    cur = (disc == OPEN_DATE) if cur is None else cur
    return (ein, job, city, _h(job), _h(city), eff, disc, cur, batch, batch)


def src(spark, rows, batch=RUN_BATCH, eff=RUN):
    return spark.createDataFrame([(e, j, c, _h(j), _h(c), eff, OPEN_DATE, True, batch, batch) for e, j, c in rows],
                                 SCHEMA)


def dim(spark, rows):
    return spark.createDataFrame(rows, SCHEMA)


def by_key(df, key):
    return sorted([r.asDict() for r in df.filter(F.col("EIN") == key).collect()], key=lambda r: r["EFF_DT"])


def test_new_key_inserted_with_1900(spark):
    out = scd_merge(dim(spark, [row("A", "J1", "X", dt.date(2024, 1, 1))]), src(spark, [("B", "J1", "X")]),
                    "EIN", RUN, RUN_BATCH)
    b = by_key(out, "B")
    assert len(b) == 1 and b[0]["EFF_DT"] == dt.date(1900, 1, 1) and b[0][ACTION] == "insert"
    assert b[0]["DISC_DT"] == OPEN_DATE and b[0]["IS_CURRENT"]


def test_changed_older_row_opens_version_and_closes_old(spark):
    out = scd_merge(dim(spark, [row("A", "J1", "X", dt.date(2024, 1, 1))]), src(spark, [("A", "J2", "X")]),
                    "EIN", RUN, RUN_BATCH)
    a = by_key(out, "A")
    assert len(a) == 2
    assert a[0]["DISC_DT"] == RUN - dt.timedelta(days=1) and a[0]["IS_CURRENT"] is False
    assert a[0]["UPD_BATCH_ID"] == RUN_BATCH and a[0]["JOB_CODE"] == "J1"
    assert a[1]["EFF_DT"] == RUN and a[1]["JOB_CODE"] == "J2" and a[1]["IS_CURRENT"]


def test_unchanged_no_version(spark):
    d = dim(spark, [row("A", "J1", "X", dt.date(2024, 1, 1))])
    out = scd_merge(d, src(spark, [("A", "J1", "X")]), "EIN", RUN, RUN_BATCH)
    a = by_key(out, "A")
    assert len(a) == 1 and a[0][ACTION] == "unchanged" and a[0]["EFF_DT"] == dt.date(2024, 1, 1)


def test_type1_overwrites_all_columns(spark):
    out = scd_merge(dim(spark, [row("A", "J1", "X", dt.date(2024, 1, 1))]), src(spark, [("A", "J1", "Y")]),
                    "EIN", RUN, RUN_BATCH)
    a = by_key(out, "A")
    assert len(a) == 1 and a[0]["CITY"] == "Y"
    # reference behaviour: the update list is every column, EFF_DT moves to the run date
    assert a[0]["EFF_DT"] == RUN and a[0]["INS_BATCH_ID"] == RUN_BATCH


def test_type1_preserve_keeps_eff_dt(spark):
    out = scd_merge(dim(spark, [row("A", "J1", "X", dt.date(2024, 1, 1))]), src(spark, [("A", "J1", "Y")]),
                    "EIN", RUN, RUN_BATCH, preserve=["EFF_DT", "INS_BATCH_ID"])
    a = by_key(out, "A")
    assert a[0]["CITY"] == "Y" and a[0]["EFF_DT"] == dt.date(2024, 1, 1) and a[0]["INS_BATCH_ID"] == OLD_BATCH


def test_intraday_overwrites_in_place(spark):
    # the open row was opened today (EFF_DT = run date): a second change the same day overwrites it
    d = dim(spark, [row("A", "J1", "X", dt.date(2024, 1, 1), RUN - dt.timedelta(days=1), False),
                    row("A", "J2", "X", RUN, batch=RUN_BATCH)])
    out = scd_merge(d, src(spark, [("A", "J3", "X")]), "EIN", RUN, RUN_BATCH)
    a = by_key(out, "A")
    assert len(a) == 2 and a[1]["JOB_CODE"] == "J3" and a[1]["IS_CURRENT"] and a[1][ACTION] == "update"


def test_reopened_key_gets_new_version(spark):
    d = dim(spark, [row("A", "J1", "X", dt.date(2024, 1, 1), dt.date(2024, 6, 30), False)])
    out = scd_merge(d, src(spark, [("A", "J1", "X")]), "EIN", RUN, RUN_BATCH)
    a = by_key(out, "A")
    assert len(a) == 2 and a[1]["EFF_DT"] == RUN and a[1][ACTION] == "insert"


def test_late_source_skips_closeout_by_default(spark):
    # source batch day (2025-03-01) is before the open row's EFF_DT and not today
    d = dim(spark, [row("A", "J1", "X", dt.date(2025, 3, 5), batch=20250305060000000)])
    late = src(spark, [("A", "J9", "X")], batch=20250301060000000, eff=dt.date(2025, 3, 1))
    out = scd_merge(d, late, "EIN", RUN, RUN_BATCH)
    a = by_key(out, "A")
    assert len(a) == 1 and a[0]["IS_CURRENT"] and a[0]["JOB_CODE"] == "J1"
    out2 = scd_merge(d, late, "EIN", RUN, RUN_BATCH, late_closeout=True)
    a2 = by_key(out2, "A")
    assert len(a2) == 1 and a2[0]["IS_CURRENT"] is False   # the reference loses the current row


def test_first_day_change_on_1900_row_opens_version(spark):
    # A 1900 row is never intra-day, so a later change opens a version
    d = dim(spark, [row("A", "J1", "X", dt.date(1900, 1, 1), batch=RUN_BATCH)])
    out = scd_merge(d, src(spark, [("A", "J2", "X")]), "EIN", RUN, RUN_BATCH)
    a = by_key(out, "A")
    assert len(a) == 2 and a[0]["DISC_DT"] == RUN - dt.timedelta(days=1)


def test_merge_twice_equals_once(spark):
    d = dim(spark, [row("A", "J1", "X", dt.date(2024, 1, 1)), row("B", "J1", "X", dt.date(2024, 1, 1))])
    s = src(spark, [("A", "J2", "X"), ("B", "J1", "Y"), ("C", "J1", "X")])
    once = scd_merge(d, s, "EIN", RUN, RUN_BATCH).drop(ACTION)
    twice = scd_merge(once, s, "EIN", RUN, RUN_BATCH).drop(ACTION)
    assert sorted(map(tuple, once.collect())) == sorted(map(tuple, twice.collect()))


def test_nextday_scenario_two_rows_scd2_one_row_scd1(spark):
    # Backdated target; SCD2 change -> 2 rows, SCD1-only change -> 1 row
    d = dim(spark, [row("A", "J1", "X", RUN - dt.timedelta(days=1)), row("B", "J1", "X", RUN - dt.timedelta(days=1))])
    out = scd_merge(d, src(spark, [("A", "J2", "X"), ("B", "J1", "Z")]), "EIN", RUN, RUN_BATCH)
    assert len(by_key(out, "A")) == 2 and len(by_key(out, "B")) == 1


def test_scd6_copies_null_and_leaves_keys_without_open_row(spark):
    d = dim(spark, [row("A", "J1", "Rome", dt.date(2020, 1, 1), dt.date(2021, 1, 1)), row("A", "J2", None, dt.date(2021, 1, 2)),
                    row("B", "J1", "Oslo", dt.date(2020, 1, 1), dt.date(2021, 1, 1))])
    out = scd6_propagate(d, "EIN", ["CITY"])
    assert [r["CITY"] for r in by_key(out, "A")] == [None, None]      # the open row's NULL is its value
    assert [r["CITY"] for r in by_key(out, "B")] == ["Oslo"]          # nothing to copy from


def test_duplicate_source_keys_fail_by_default(spark):
    with pytest.raises(ValueError, match="duplicate keys"):
        scd_merge(dim(spark, [row("A", "J1", "Rome", dt.date(2020, 1, 1))]), src(spark, [("A", "J2", "x"), ("A", "J3", "y")]),
                  "EIN", RUN, RUN_BATCH)


def test_runs_together_read_every_order(spark):
    """The second run's batch holds a state for every customer, taken from the whole table."""
    from tidemark.plans import standins as S
    from tests.conftest import SF_SMALL
    o = S.t(spark, SF_SMALL, "orders")
    assert o.agg(F.max("o_orderdate")).first()[0].date() < S.D2
    got = S.snapshot_source(spark, SF_SMALL, None, S.BATCH2, stamp_day=S.D2)
    last = o.groupBy("o_custkey").agg(F.max(F.struct("o_orderdate", "o_orderkey", "o_orderstatus")).alias("x"))
    j = got.join(last, got["ENTITY_KEY"] == last["o_custkey"], "full")
    assert j.filter(~F.col("STATUS").eqNullSafe(F.col("x.o_orderstatus"))).count() == 0
    assert got.count() == o.select("o_custkey").distinct().count()


def test_scd6_copies_current_value_to_history(spark):
    d = dim(spark, [row("A", "J1", "X", dt.date(2024, 1, 1), dt.date(2024, 12, 31), False),
                    row("A", "J2", "Y", dt.date(2025, 1, 1))])
    out = scd6_propagate(d, "EIN", ["CITY"])
    assert {r["CITY"] for r in by_key(out, "A")} == {"Y"}


def test_scd_init(spark):
    s = spark.createDataFrame([("A", "J1")], "EIN string, JOB_CODE string")
    r = scd_init(s, RUN, RUN_BATCH).collect()[0]
    assert r["EFF_DT"] == RUN and r["DISC_DT"] == OPEN_DATE and r["IS_CURRENT"]


def test_history_build_obeys_integrity(spark):
    rows = [("A", dt.date(2024, 1, d), s, p) for d, s, p in
            [(1, "O", "1"), (2, "O", "2"), (3, "F", "2"), (5, "F", "3"), (9, "O", "3")]]
    daily = spark.createDataFrame(rows, "K string, D date, S string, P string") \
        .withColumn("H2", md5_concat(["S"], "||"))
    v = sorted(scd2_from_history(daily, "K", "D", "H2", ["S", "P"]).collect(), key=lambda r: r["EFF_DT"])
    assert [(r["S"], r["P"], r["EFF_DT"].day, r["DISC_DT"]) for r in v] == [
        ("O", "2", 1, dt.date(2024, 1, 2)), ("F", "3", 3, dt.date(2024, 1, 8)), ("O", "3", 9, OPEN_DATE)]


@pytest.mark.parametrize("bad", ["merge", "delete+insert"])
def test_upsert_strategies_exist(spark, bad):
    from tidemark.operators.merge import upsert
    t = spark.createDataFrame([("A", "x", "h1", "INSERT")], "K string, V string, HASH_CHANGE string, OPERATION_TYPE string")
    s = spark.createDataFrame([("A", "y", "h2", "INSERT")], t.schema)
    assert upsert(t, s, "K", strategy=bad).count() == 1


def test_upsert_unknown_strategy_raises(spark):
    from tidemark.operators.merge import upsert
    t = spark.createDataFrame([("A",)], "K string")
    with pytest.raises(ValueError):
        upsert(t, t, "K", strategy="append")


def test_merge_counts_include_closeouts(spark):
    from tidemark.operators.merge import merge_counts
    out = scd_merge(dim(spark, [row("A", "J1", "X", dt.date(2024, 1, 1))]), src(spark, [("A", "J2", "X"), ("B", "J1", "X")]),
                    "EIN", RUN, RUN_BATCH)
    c = merge_counts(out).collect()[0]
    assert (c["rows_inserted"], c["rows_updated"], c["rows_deleted"]) == (2, 1, 0)


def test_scd_merge_rejects_duplicate_source_keys(spark):
    with pytest.raises(ValueError):
        scd_merge(dim(spark, [row("A", "J1", "X", dt.date(2024, 1, 1))]), src(spark, [("A", "J2", "X"), ("A", "J3", "X")]),
                  "EIN", RUN, RUN_BATCH, check_unique=True)
