"""Skew-safe neighbours against the plain key window, with a hot key."""

import datetime as dt
import random

from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import Window
from pyspark.sql import functions as F

from tidemark.operators.windows import neighbours


def reference(df, keys, order, cols):
    w = Window.partitionBy(*keys).orderBy(*order)
    return df.select("*", *[F.lag(c).over(w).alias(f"PREV_{c}") for c in cols],
                     *[F.lead(c).over(w).alias(f"NEXT_{c}") for c in cols])


def rows_of(df):
    rows = [tuple(r) for r in df.select(sorted(df.columns)).collect()]
    return sorted(rows, key=lambda t: tuple((x is None, 0 if x is None else x) for x in t))


def test_hot_key_matches_window(spark):
    rnd = random.Random(7)
    rows = [(0 if i % 3 == 0 else rnd.randint(1, 200), i, rnd.randint(0, 50)) for i in range(3000)]
    df = spark.createDataFrame(rows, "K long, T long, V long")
    got = neighbours(df, ["K"], ["T"], ["T", "V"], partitions=16)
    assert rows_of(got) == rows_of(reference(df, ["K"], ["T"], ["T", "V"]))
    # the hot key really is spread over several range partitions
    spread = (df.repartitionByRange(16, "K", "T").withColumn("p", F.spark_partition_id())
              .filter("K = 0").select("p").distinct().count())
    assert spread > 1


@settings(max_examples=10, deadline=None)
@given(st.lists(st.tuples(st.integers(0, 3), st.integers(0, 10 ** 6), st.integers(-5, 5)), min_size=1, max_size=60,
                unique_by=lambda x: (x[0], x[1])))
def test_neighbours_property(spark, rows):
    df = spark.createDataFrame(rows, "K long, T long, V long")
    got = neighbours(df, ["K"], ["T"], ["V"], partitions=5)
    assert rows_of(got) == rows_of(reference(df, ["K"], ["T"], ["V"]))


def test_gap_checks_skew_safe_equal(spark):
    import datetime as dt
    from tidemark.operators import dq
    base = dt.date(2020, 1, 1)
    rows = [(k, base + dt.timedelta(days=d * 3), base + dt.timedelta(days=d * 3 + (1 if d % 4 else 5)))
            for k in range(4) for d in range(0, 40 if k == 0 else 5)]
    dim = spark.createDataFrame(rows, "K long, EFF_DT date, DISC_DT date")
    for fn in (dq.gaps, dq.overlaps):
        assert rows_of(fn(dim, "K")) == rows_of(fn(dim, "K", skew_safe=True))


def test_lifecycle_skew_safe_equal(spark):
    from tidemark.operators.lifecycle import lifecycle_events
    from tidemark.plans.q_relational import LIFE_SPEC, lifecycle_input
    dim = lifecycle_input(spark, "/root/testdata/sf0.001")
    assert rows_of(lifecycle_events(dim, LIFE_SPEC)) == rows_of(lifecycle_events(dim, LIFE_SPEC, skew_safe=True))


def test_integrity_checks_agree_with_and_without_key_windows(spark):
    from tidemark.operators import dq
    rng = random.Random(3)
    rows = []
    for k in range(40):
        day = 0
        for _ in range(rng.randrange(1, 12) if k else 400):          # key 0 holds most rows
            day += rng.randrange(1, 5)
            end = dt.date(9999, 12, 31) if rng.random() < 0.1 else dt.date(2020, 1, 1) + dt.timedelta(days=day + rng.randrange(-2, 6))
            rows.append((k, dt.date(2020, 1, 1) + dt.timedelta(days=day), end, rng.random() < 0.3, rng.choice("ab")))
    dim = spark.createDataFrame(rows, "K int, EFF_DT date, DISC_DT date, IS_CURRENT boolean, V string")
    plain, safe = (sorted(map(tuple, dq.scd_integrity(dim, "K", skew_safe=s).collect())) for s in (False, True))
    assert plain == safe and len(plain) > 50
    a, b = (dq.attr_changes(dim, "K", "V", skew_safe=s).collect()[0][0] for s in (False, True))
    assert a == b


def test_running_equals_the_window(spark):
    """A hot key over several partitions, keys that end at partition edges, NULLs in keys and values."""
    from tidemark.operators.windows import any_hot, running
    rng = random.Random(4)
    rows = [(None if k == 3 else k, i, None if rng.random() < .2 else rng.randrange(50))
            for k, n in ((0, 900), (1, 1), (2, 7), (3, 40), (4, 1), (5, 130)) for i in range(n)]
    df = spark.createDataFrame(rows, "K int, O int, V int").repartition(5)
    w = Window.partitionBy("K").orderBy("O").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    want = df.select("*", F.sum("V").over(w).alias("S"), F.max("V").over(w).alias("M"), F.min("V").over(w).alias("L"))
    for partitions in (1, 3, 11):
        got = running(df, ["K"], ["O"], {"S": ("sum", "V"), "M": ("max", "V"), "L": ("min", "V")}, partitions)
        assert rows_of(got) == rows_of(want)
    assert any_hot(df, ["K"], 899) and not any_hot(df, ["K"], 900)


def test_history_scan_equals_the_windows(spark):
    """The history build in both forms, with a hot key, NULL hashes and single-day keys; no window over a key."""
    from tidemark.operators import windows
    from tidemark.operators.scd import scd2_from_history
    rng = random.Random(9)
    rows = [(k, dt.date(2000, 1, 1) + dt.timedelta(days=3 * i), rng.choice(["a", "b", None]), rng.randrange(9))
            for k, n in ((1, 700), (2, 1), (3, 30), (4, 2)) for i in range(n)]
    daily = spark.createDataFrame(rows, "K int, D date, H string, V int").repartition(4)
    plain = scd2_from_history(daily, "K", "D", "H", ["V", "H"])
    safe = scd2_from_history(daily, "K", "D", "H", ["V", "H"], skew_safe=True)
    assert plain.columns == safe.columns and rows_of(plain) == rows_of(safe)
    for line in safe._jdf.queryExecution().optimizedPlan().toString().splitlines():
        assert "Window" not in line or "_pid" in line or "_k" in line
    assert rows_of(scd2_from_history(daily, "K", "D", "H", ["V", "H"], skew_safe="auto")) == rows_of(plain)
    assert not windows.any_hot(daily, ["K"])
