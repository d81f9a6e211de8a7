"""Bucketed tables: whole commits, two writers, evolution, statistics, type 6, counts."""

import datetime as dt
import os

import pytest
from pyspark.sql import functions as F

from tests.conftest import SF_SMALL
from tidemark.operators.merge import append, delete_insert, drop_action, merge_counts, merge_upsert
from tidemark.operators.scd import scd_merge
from tidemark.plans import standins as S
from tidemark.sources import commits, sinks

SCHEMA = "K bigint, V string, N int, HASH_CHANGE string, OPERATION_TYPE string"


def table(spark, scratch, rows=400, buckets=16, **kw):
    path = os.path.join(scratch, "t")
    df = spark.range(rows).select(F.col("id").alias("K"), F.lit("a").alias("V"), F.col("id").cast("int").alias("N"),
                                  F.lit("h").alias("HASH_CHANGE"), F.lit("INSERT").alias("OPERATION_TYPE"))
    sinks.write_bucketed(df, path, "K", buckets, **kw)
    return path


def batch(spark, *rows, schema=SCHEMA):
    return spark.createDataFrame(list(rows), schema)


def state(df):
    return {r["K"]: r["V"] for r in df.collect() if r["V"] != "a"}


def held(spark, path):
    return {b: x["commit"] for b, x in commits.head(spark, path)["buckets"].items()}


def test_new_and_wider_columns_reach_the_table(spark, scratch):
    """EXTRA survives, N is widened, buckets that the batch does not touch keep their files and are read cast."""
    path = table(spark, scratch)
    before = held(spark, path)
    src = batch(spark, (7, "b", 2**40, "h2", "INSERT", "x7"), (5000, "n", 5, "h9", "INSERT", "x5"),
                schema="K bigint, V string, N bigint, HASH_CHANGE string, OPERATION_TYPE string, EXTRA string")
    sinks.upsert_bucketed(spark, path, src, "K", 16)
    out = sinks.read_bucketed(spark, path)
    assert dict(out.dtypes)["N"] == "bigint" and out.columns[-1] == "EXTRA" and out.count() == 401
    assert {r["K"]: (r["N"], r["EXTRA"]) for r in out.filter("EXTRA IS NOT NULL").collect()} == {7: (2**40, "x7"), 5000: (5, "x5")}
    assert out.filter("K <> 7").filter("K < 400 AND N = K AND EXTRA IS NULL").count() == 399
    after = held(spark, path)
    touched = {str(r[0]) for r in sinks.with_bucket(src, "K", 16).select("_bucket").collect()}
    assert {b for b in before if before[b] != after[b]} == touched
    # a batch of the old form still fits, and leaves the values of the columns that it lacks
    sinks.upsert_bucketed(spark, path, batch(spark, (7, "c", 1, "h3", "INSERT"), (6000, "m", 2, "h", "INSERT")), "K", 16)
    got = {r["K"]: (r["V"], r["N"], r["EXTRA"]) for r in sinks.read_bucketed(spark, path).filter("K IN (7, 6000)").collect()}
    assert got == {7: ("c", 1, "x7"), 6000: ("m", 2, None)}


def test_merges_take_new_columns(spark):
    """Every merge path appends new columns; 'fail' and 'ignore' are the other two choices."""
    tgt = batch(spark, (1, "a", 1, "h", "INSERT"), (2, "a", 2, "h", "INSERT"))
    src = batch(spark, (2, "b", 3, "g", "INSERT", 1.5), (3, "c", 4, "g", "INSERT", 2.5),
                schema=SCHEMA.replace("N int", "N bigint") + ", EXTRA double")
    for out in (merge_upsert(tgt, src, "K"), delete_insert(tgt, src, "K"), append(tgt.filter("K = 1"), src)):
        got = {r["K"]: (r["V"], r["N"], r["EXTRA"]) for r in drop_action(out).collect()}
        assert got == {1: ("a", 1, None), 2: ("b", 3, 1.5), 3: ("c", 4, 2.5)} and dict(out.dtypes)["N"] == "bigint"
    with pytest.raises(ValueError, match="EXTRA"):
        merge_upsert(tgt, src, "K", on_schema_change="fail")
    assert "EXTRA" not in merge_upsert(tgt, src, "K", on_schema_change="ignore").columns
    with pytest.raises(ValueError, match="unknown"):
        merge_upsert(tgt, src, "K", on_schema_change="sync")


def test_scd_merge_takes_new_columns(spark):
    dim = spark.createDataFrame(
        [(1, "p", "r", "h2", "h1", dt.date(2020, 1, 1), dt.date(9999, 12, 31), True, 20200101000000, 20200101000000),
         (2, "p", "r", "h2", "h1", dt.date(2020, 1, 1), dt.date(9999, 12, 31), True, 20200101000000, 20200101000000)],
        "K int, A string, B string, HASH_SCD2 string, HASH_SCD1 string, EFF_DT date, DISC_DT date, IS_CURRENT boolean, "
        "INS_BATCH_ID bigint, UPD_BATCH_ID bigint")
    src = spark.createDataFrame(
        [(1, "q", "x2", "h1", dt.date(2020, 2, 1), dt.date(9999, 12, 31), True, 20200201000000, 20200201000000, "new")],
        "K bigint, A string, HASH_SCD2 string, HASH_SCD1 string, EFF_DT date, DISC_DT date, IS_CURRENT boolean, "
        "INS_BATCH_ID bigint, UPD_BATCH_ID bigint, EXTRA string")
    out = scd_merge(dim, src, "K", dt.date(2020, 2, 1), 20200201000000)
    got = sorted((r["K"], r["A"], str(r["B"]), r["DISC_DT"].year, str(r["EXTRA"])) for r in out.collect())
    assert got == [(1, "p", "r", 2020, "None"), (1, "q", "None", 9999, "new"), (2, "p", "r", 9999, "None")]


def test_a_job_that_ends_before_the_commit_changes_nothing(spark, scratch, monkeypatch):
    """All files of the batch are written, the version file is not: readers see the old table; the batch
    repeated later goes through, and vacuum removes the files that no version names."""
    path = table(spark, scratch)
    src = batch(spark, *[(k, "z", k, "hz", "INSERT") for k in range(0, 400, 3)])
    real = commits._publish
    monkeypatch.setattr(commits, "_publish", lambda *a: (_ for _ in ()).throw(SystemExit("driver lost")))
    with pytest.raises(SystemExit):
        sinks.upsert_bucketed(spark, path, src, "K", 16)
    assert state(sinks.read_bucketed(spark, path)) == {} and commits.row_count(spark, path) == 400
    monkeypatch.setattr(commits, "_publish", real)
    sinks.upsert_bucketed(spark, path, src, "K", 16)
    assert state(sinks.read_bucketed(spark, path)) == {k: "z" for k in range(0, 400, 3)}
    folders = len(os.listdir(os.path.join(path, "_data")))
    assert commits.vacuum(spark, path, keep=2, older_than=dt.timedelta(0)) == 1 and folders == 3
    assert state(commits.read(spark, path, version=0)) == {}
    assert commits.vacuum(spark, path, keep=1, older_than=dt.timedelta(0)) in (0, 1)
    assert sinks.read_bucketed(spark, path).count() == 400 and commits.read(spark, path, version=0) is None


def two_writers(spark, path, mine, other):
    """`other` is committed while the merge of `mine` runs."""
    runs = []

    def merge(cur, src):
        if len(runs) < len(other):
            sinks.upsert_bucketed(spark, path, batch(spark, *other[len(runs)]), "K", 16)
        runs.append(1)
        return merge_upsert(cur, src, "K")

    entry = sinks.rewrite_buckets(spark, path, batch(spark, *mine), "K", 16, merge)
    return entry, len(runs)


def test_a_second_writer_of_other_buckets_is_kept(spark, scratch):
    path = table(spark, scratch)
    bucket = {r["K"]: r["_bucket"] for r in sinks.with_bucket(spark.range(400).toDF("K"), "K", 16).collect()}
    far = next(k for k in range(400) if bucket[k] != bucket[1])
    entry, runs = two_writers(spark, path, [(1, "mine", 1, "m", "INSERT")], [[(far, "other", 1, "o", "INSERT")]])
    assert runs == 1 and entry["version"] == 2
    assert state(sinks.read_bucketed(spark, path)) == {1: "mine", far: "other"}


def test_a_second_writer_of_the_same_bucket_makes_the_merge_run_again(spark, scratch):
    path = table(spark, scratch)
    entry, runs = two_writers(spark, path, [(1, "mine", 1, "m", "INSERT")], [[(1, "other", 1, "o", "INSERT"), (401, "more", 1, "o", "INSERT")]])
    assert runs == 2 and state(sinks.read_bucketed(spark, path)) == {1: "mine", 401: "more"}
    with pytest.raises(commits.CommitConflict):
        two_writers(spark, path, [(1, "late", 1, "l", "INSERT")], [[(1, f"o{i}", 1, f"o{i}", "INSERT")] for i in range(9)])
    assert state(sinks.read_bucketed(spark, path))[1] == "o3"


def test_older_versions_are_read_by_number_and_time(spark, scratch):
    path = table(spark, scratch)
    sinks.upsert_bucketed(spark, path, batch(spark, (1, "b", 1, "h2", "INSERT")), "K", 16)
    between = dt.datetime.fromisoformat(commits.head(spark, path)["at"])
    sinks.upsert_bucketed(spark, path, batch(spark, (1, "c", 1, "h3", "INSERT")), "K", 16)
    assert [state(commits.read(spark, path, version=v)).get(1) for v in range(3)] == [None, "b", "c"]
    assert state(commits.read(spark, path, as_of=between)) == {1: "b"}
    assert commits.read(spark, path, as_of=dt.datetime(2000, 1, 1)) is None and commits.read(spark, path, version=9) is None
    sinks.write_bucketed(batch(spark, (9, "whole", 9, "h", "INSERT")), path, "K", 16)
    assert state(sinks.read_bucketed(spark, path)) == {9: "whole"} and state(commits.read(spark, path, version=2)) == {1: "c"}
    with pytest.raises(ValueError, match="bucketed by"):
        sinks.upsert_bucketed(spark, path, batch(spark, (1, "b", 1, "h", "INSERT")), "V", 16)


def test_the_watermark_is_kept_with_the_buckets(spark, scratch):
    """Equal to the aggregate after an update that lowers the maximum, a widened type and a vacuum; NULLs aside."""
    path = table(spark, scratch, stats=["N", "V"])

    def check():
        want = sinks.read_bucketed(spark, path).agg(F.max("N"), F.min("N"), F.max("V")).first()
        assert (commits.watermark(spark, path, "N"), commits.watermark(spark, path, "N", largest=False),
                commits.watermark(spark, path, "V")) == tuple(want)
        return want[0]

    assert check() == 399
    sinks.upsert_bucketed(spark, path, batch(spark, (399, "b", None, "h2", "INSERT"), (398, "b", 3, "h2", "INSERT")), "K", 16)
    assert check() == 397
    wide = batch(spark, (5, "b", 2**41, "h2", "INSERT"), (6, "b", 9, "h2", "INSERT"), schema=SCHEMA.replace("N int", "N bigint"))
    sinks.upsert_bucketed(spark, path, wide, "K", 16)
    assert check() == 2**41
    commits.vacuum(spark, path, keep=1, older_than=dt.timedelta(0))
    assert check() == 2**41
    with pytest.raises(KeyError):
        commits.watermark(spark, path, "HASH_CHANGE")
    empty = os.path.join(scratch, "e")
    sinks.write_bucketed(batch(spark).filter("false"), empty, "K", 4, stats=["N"])
    assert commits.watermark(spark, empty, "N", default=-1) == -1 and sinks.read_bucketed(spark, empty).count() == 0
    sinks.upsert_bucketed(spark, empty, batch(spark, (1, "x", 8, "h", "INSERT")), "K", 4)
    assert commits.watermark(spark, empty, "N") == 8


def test_counts_are_taken_while_writing(spark, scratch):
    path = table(spark, scratch)
    src = batch(spark, (1, "b", 1, "h2", "INSERT"), (2, "a", 2, "h", "INSERT"), (900, "n", 1, "h", "INSERT"))
    entry = sinks.upsert_bucketed(spark, path, src, "K", 16)
    want = merge_counts(merge_upsert(commits.read(spark, path, version=0), src, "K")).first().asDict()
    counts = entry["counts"]
    assert {c: counts[c] for c in commits.ACTIONS} == {c: want[c] for c in commits.ACTIONS}
    assert commits.row_count(spark, path) == want["rows_total"] == 401


def test_type6_rewrites_only_buckets_that_differ(spark, scratch):
    """A propagation in buckets equals the whole-table form over several runs; buckets whose closed rows
    agree with their open ones keep their files."""
    path = os.path.join(scratch, "dim")
    whole = S.dim_history(spark, SF_SMALL, S.D1, S.BATCH1).select(*S.DIM_COLS)
    sinks.write_bucketed(whole, path, "ENTITY_KEY", 16, diverge=["PRIORITY"])
    days = [dt.date(1998, 6, 1), dt.date(1999, 1, 1), dt.date(2000, 1, 1)]
    # run 1 holds few keys with a changed priority: its propagation reaches all buckets that differ
    for i, day in enumerate(days):
        batch_id = int(day.strftime("%Y%m%d") + "060000000")
        src = S.snapshot_source(spark, SF_SMALL, day, batch_id)
        src = src.filter("ENTITY_KEY % 50 = 1") if i == 0 else src
        before = held(spark, path)
        marked = {b for b, x in commits.head(spark, path)["buckets"].items() if x["diverged"]["PRIORITY"]}
        whole = sinks.cut_lineage(drop_action(scd_merge(whole, src, "ENTITY_KEY", day, batch_id, type6=["PRIORITY"])))
        sinks.scd_merge_bucketed(spark, path, src, "ENTITY_KEY", 16, day, batch_id, type6=["PRIORITY"])
        got = sinks.read_bucketed(spark, path).select(*S.DIM_COLS)
        assert sorted(map(tuple, got.collect()), key=str) == sorted(map(tuple, whole.collect()), key=str)
        touched = {str(r[0]) for r in sinks.with_bucket(src, "ENTITY_KEY", 16).select("_bucket").distinct().collect()}
        after = held(spark, path)
        assert {b for b in after if after[b] != before[b]} == touched | marked
        assert not any(x["diverged"]["PRIORITY"] for x in commits.head(spark, path)["buckets"].values())


def test_type6_reads_all_buckets_without_marks(spark, scratch):
    """A table written without divergence marks: the first propagation rewrites every bucket and adds them."""
    rows = [(k, "new" if opened else "old", "h2", "h1", dt.date(2020, 1, 1) if opened else dt.date(2019, 1, 1),
             dt.date(9999, 12, 31) if opened else dt.date(2019, 12, 31), opened, 20190101000000, 1) for k in range(40) for opened in (True, False)]
    dim = spark.createDataFrame(rows, "K bigint, A string, HASH_SCD2 string, HASH_SCD1 string, EFF_DT date, DISC_DT date, "
                                      "IS_CURRENT boolean, INS_BATCH_ID bigint, UPD_BATCH_ID bigint")
    path = os.path.join(scratch, "d")
    sinks.write_bucketed(dim, path, "K", 8)
    src = spark.createDataFrame([(3, None, "h2", "h1x", dt.date(2020, 3, 1), dt.date(9999, 12, 31), True, 20200301000000, 1)], dim.schema)
    sinks.scd_merge_bucketed(spark, path, src, "K", 8, dt.date(2020, 3, 1), 20200301000000, type6=["A"])
    got = {(r["K"], r["IS_CURRENT"]): r["A"] for r in sinks.read_bucketed(spark, path).collect()}
    assert got == {(k, o): None if k == 3 else "new" for k in range(40) for o in (True, False)}
    assert commits.head(spark, path)["diverge"] == ["A"]


def test_reconciliation_reads_unlike_buckets_only(spark, scratch, monkeypatch):
    """Equal to a full outer join; buckets with equal digests are not read; order, files and a widened type do not matter."""
    left, right = os.path.join(scratch, "l"), os.path.join(scratch, "r")
    rows = [(k, f"v{k % 7}", k if k % 5 else None) for k in range(300)]
    kind = "K bigint, V string, N int"
    other = [r for r in rows if r[0] != 17] + [(1000, "n", 1), (1001, None, None)]
    other = [(k, "changed", n) if k in (5, 250) else (k, v, None) if k == 33 else (k, v, n) for k, v, n in other]
    sinks.write_bucketed(spark.createDataFrame(rows, kind), left, "K", 32, digest=["V", "N"])
    sinks.write_bucketed(spark.createDataFrame(other[::-1], kind.replace("N int", "N bigint")).repartition(5), right, "K", 32, digest=["V", "N"])
    read = []
    real = commits._rows
    monkeypatch.setattr(commits, "_rows", lambda s, d, e, b=None: (read.append(set(b)), real(s, d, e, b))[1])
    got = {(r["K"], r["SIDE"]) for r in commits.reconcile(spark, (left, None), (right, None)).collect()}
    assert got == {(17, "left_only"), (1000, "right_only"), (1001, "right_only"), (5, "changed"), (250, "changed"), (33, "changed")}
    keys = spark.createDataFrame([(k,) for k, _ in got], "K bigint")
    unlike = {r["_bucket"] for r in sinks.with_bucket(keys, "K", 32).collect()}
    assert read == [unlike, unlike] and len(unlike) < 32
    assert commits.reconcile(spark, (left, None), (left, None)).count() == 0 and read[-1] == set()
    with pytest.raises(ValueError, match="digest"):
        commits.reconcile(spark, (left, None), (table(spark, scratch), None))
    with pytest.raises(ValueError, match="no such"):
        commits.reconcile(spark, (left, 9), (right, None))


def test_every_step_leaves_an_audit_row(spark, scratch):
    """Counts of the commit for a step that went through, zeros for one that touched nothing, an error row for one that failed."""
    path, audit = table(spark, scratch), os.path.join(scratch, "audit")
    src = batch(spark, (1, "b", 1, "h2", "INSERT"), (900, "n", 1, "h", "INSERT"))
    sinks.run_step(spark, audit, lambda: sinks.upsert_bucketed(spark, path, src, "K", 16), "ods", "run1")
    sinks.run_step(spark, audit, lambda: sinks.upsert_bucketed(spark, path, src.filter("false"), "K", 16), "ods", "run2")
    twice = src.unionByName(src)
    with pytest.raises(ValueError, match="duplicate"):
        sinks.run_step(spark, audit, lambda: sinks.upsert_bucketed(spark, path, twice, "K", 16), "ods", "run3")
    rows = {r["invocation_id"]: r for r in spark.read.parquet(audit).collect()}
    got = {k: (r["status"], r["rows_inserted"], r["rows_updated"], r["rows_deleted"], r["failures"]) for k, r in rows.items()}
    assert got == {"run1": ("success", 1, 1, 0, 0), "run2": ("success", 0, 0, 0, 0), "run3": ("error", None, None, None, 1)}
    assert "duplicate" in rows["run3"]["message"] and rows["run1"]["rows_affected"] == 2
    assert spark.read.parquet(audit).schema.names == sinks.AUDIT_SCHEMA.names and sinks.read_bucketed(spark, path).count() == 401
