"""Data-quality and reconciliation checks (Q1-Q42).

Every check returns the violating rows (empty = pass), like a SQL test that selects
failures. `run_suite` turns a list of checks into one row per check
(name, failures, status) with a single aggregation per check; `summary` gives the
status counts of a result table (G7). All checks are filters, aggregates, anti joins
or shared windows: nothing is collected.
"""

from __future__ import annotations

import datetime as _dt
from collections.abc import Callable, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidemark.functions.expr import variant_value
from tidemark.functions.literals import lit
from tidemark.operators.joins import attach_scalar, not_in

OPEN_DATE = _dt.date(9999, 12, 31)

# The format patterns of the reference's checks, anchored as whole-string
# matches (trap T3), and its accepted state / province codes.
ID_PATTERN = r"^[A-Za-z0-9]{1,15}\z"
EMAIL_PATTERN = r"^[a-zA-Z0-9._%+-]+@[a-zA-Z0-9.-]+\.[a-zA-Z]{2,}\z"
MIDDLE_INITIAL_PATTERN = r"^[A-Za-z]\z"
PHONE_PATTERN = r"^[0-9]{3}-?[0-9]{3}-?[0-9]{4}\z|^\([0-9]{3}\)[0-9]{3}-?[0-9]{4}\z|^[0-9]{10}\z"
POSTAL_PATTERN = r"^[0-9]{5}(-[0-9]{4})?\z|^[A-Za-z][0-9][A-Za-z] ?[0-9][A-Za-z][0-9]\z"
STATE_CODES = (
    "AL", "AK", "AZ", "AR", "CA", "CO", "CT", "DE", "FL", "GA",
    "HI", "ID", "IL", "IN", "IA", "KS", "KY", "LA", "ME", "MD",
    "MA", "MI", "MN", "MS", "MO", "MT", "NE", "NV", "NH", "NJ",
    "NM", "NY", "NC", "ND", "OH", "OK", "OR", "PA", "RI", "SC",
    "SD", "TN", "TX", "UT", "VT", "VA", "WA", "WV", "WI", "WY",
    "DC", "PR", "VI", "AS", "GU", "MP", "QC", "ON", "AB",
)


def _c(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


# ------------------------------------------------------------------ column checks

def boolean_binary(df, col):                      # Q1, Q30
    return df.filter(_c(col).isNotNull() & ~_c(col).isin(0, 1))


def pattern_mismatch(df, col, pattern):           # Q12-Q14, Q16, Q18, Q28
    return df.filter(_c(col).isNotNull() & ~_c(col).rlike(pattern))


def date_not_future(df, col, as_of):              # Q11
    return df.filter(_c(col).isNotNull() & (_c(col) > lit(as_of)))


def positive_values(df, col):                     # Q17
    return df.filter(_c(col).isNotNull() & (_c(col) <= 0))


def non_negative(df, col):                        # Q40
    return df.filter(_c(col) < 0)


def self_reference(df, a, b):                     # Q15, Q31
    return df.filter(_c(a).isNotNull() & _c(b).isNotNull() & (_c(a) == _c(b)))


def date_order(df, start, end, start_sentinel=None, end_sentinel=None):   # Q20, Q34
    """end <= start, both set; the sentinel-aware form (Q34) ignores rows whose end is the
    open sentinel (9999-12-31) or whose start is the unknown sentinel (1900-01-01)."""
    cond = _c(start).isNotNull() & _c(end).isNotNull() & (_c(end) <= _c(start))
    if end_sentinel is not None:
        cond = cond & (_c(end) != F.lit(end_sentinel))
    if start_sentinel is not None:
        cond = cond & (_c(start) != F.lit(start_sentinel))
    return df.filter(cond)


def status_consistency(df, status, end, as_of, ended="TERMINATED", active="ACTIVE"):   # Q19
    return df.filter(((_c(status) == ended) & _c(end).isNull())
                     | ((_c(status) == active) & _c(end).isNotNull() & (_c(end) <= lit(as_of))))


def accepted_values(df, col, values, case_insensitive=False):   # Q21, Q35
    v = F.upper(_c(col)) if case_insensitive else _c(col)
    return df.filter(_c(col).isNotNull() & ~v.isin(list(values)))


def not_null(df, cols):                           # Q22
    return df.filter(reduce(lambda a, b: a | b, [_c(c).isNull() for c in cols]))


def contains_parts(df, full, parts):              # Q27: ILIKE '%part%' per part
    """The full value must contain every part, case-insensitively (parts act as LIKE
    patterns, so % and _ inside them are wildcards); rows with a NULL are not checked."""
    set_ = reduce(lambda a, b: a & b, [_c(full).isNotNull()] + [_c(p).isNotNull() for p in parts])
    conds = [~F.ilike(_c(full), F.concat(F.lit("%"), _c(p), F.lit("%"))) for p in parts]
    return df.filter(set_ & reduce(lambda a, b: a | b, conds))


def exclusive_flags(df, a, b):                    # Q38
    return df.filter((_c(a) == F.lit(True)) & (_c(b) == F.lit(True)))


def tolerance(df, a, b, tol):                     # Q39
    return df.filter(F.abs(_c(a) - _c(b)) > F.lit(tol))


def value_range(df, col, lo, hi):                 # Q41
    return df.filter(~_c(col).between(lo, hi))


def flag_consistency(df, flag_col, condition: Column):   # Q36: flag <=> condition
    cond = F.coalesce(condition, F.lit(False))
    return df.filter(((_c(flag_col) == F.lit(True)) & ~cond) | ((_c(flag_col) == F.lit(False)) & cond))


# ------------------------------------------------------------------ key checks

def duplicates(df, keys):                         # Q23, G4
    return df.groupBy(*keys).agg(F.count(F.lit(1)).cast("bigint").alias("n")).filter(F.col("n") > 1)


def referential(child, parent, child_key, parent_key):   # Q24
    return child.join(parent.select(F.col(parent_key).alias("_pk")).distinct(),
                      _c(child_key) == F.col("_pk"), "left_anti")


def missing_keys(src, tgt, key, label="MISSING_IN_TARGET"):   # Q25
    return (src.select(key).filter(F.col(key).isNotNull()).distinct()
            .join(tgt.select(key).distinct(), key, "left_anti")
            .withColumn("STATUS", F.lit(label)))


def row_count_recon(src, tgt, key):               # Q26 / G3
    a = src.agg(F.countDistinct(key).cast("bigint").alias("SOURCE_COUNT"))
    b = tgt.agg(F.countDistinct(key).cast("bigint").alias("TARGET_COUNT"))
    j = attach_scalar(a, b)
    return (j.select("SOURCE_COUNT", "TARGET_COUNT",
                     (F.col("SOURCE_COUNT") - F.col("TARGET_COUNT")).alias("DIFFERENCE"))
             .filter(F.col("DIFFERENCE") != 0))


def pk_count_not_in(stage, ods, key_s, key_o):    # Q9: always one row
    missing = not_in(stage, key_s, ods, key_o)
    return missing.agg(F.count(F.lit(1)).cast("bigint").alias("MISSING_COUNT"))


def deduped_counts(src, tgt, key, order, tiebreak=()):   # Q10
    from tidemark.operators.dedup import latest_per_key
    a = latest_per_key(src, key, order, tiebreak).agg(F.count(F.lit(1)).cast("bigint").alias("SOURCE_COUNT"))
    b = tgt.agg(F.count(F.lit(1)).cast("bigint").alias("TARGET_COUNT"))
    return attach_scalar(a, b).filter(F.col("SOURCE_COUNT") != F.col("TARGET_COUNT"))


def exactly_one(df, key, condition: Column, name="N"):   # Q32, Q37
    return (df.groupBy(key).agg(F.sum(F.when(condition, 1).otherwise(0)).cast("bigint").alias(name))
              .filter(F.col(name) != 1))


def freshness(df, col, days, as_of):              # Q7
    last = df.agg(F.max(_c(col)).cast("date").alias("LAST_LOAD"))
    return last.filter(F.col("LAST_LOAD") < F.date_sub(F.lit(as_of), days))


# ------------------------------------------------------------------ SCD integrity

def dup_disc(dim, key, disc="DISC_DT"):           # Q2
    return (dim.groupBy(key, disc).agg(F.count(F.lit(1)).cast("bigint").alias("N"))
               .filter(F.col("N") > 1))


def eff_after_disc(dim, eff="EFF_DT", disc="DISC_DT"):   # Q3
    return dim.filter(F.col(disc) < F.col(eff))


def _with_next_eff(dim, key, eff, skew_safe):
    if skew_safe:
        from tidemark.operators.windows import neighbours
        return neighbours(dim, [key], [eff], [eff], prefix_prev="_PREV_").drop(f"_PREV_{eff}") \
            .withColumnRenamed(f"NEXT_{eff}", "NEXT_EFF_DT")
    w = Window.partitionBy(key).orderBy(eff)
    return dim.select("*", F.lead(eff).over(w).alias("NEXT_EFF_DT"))


def gaps(dim, key, eff="EFF_DT", disc="DISC_DT", as_written=False, skew_safe=False):   # Q4
    """LEAD(EFF_DT) per key. Default: a true gap, next - disc > 1 day.
    as_written=True reproduces the reference: `next <= disc OR disc - next > 1`, whose
    second branch is implied by the first, so only overlaps are reported.
    skew_safe=True takes the next version from `operators.windows.neighbours` (range sort)
    instead of a per-key window, for dimensions with very long histories per key."""
    v = _with_next_eff(dim, key, eff, skew_safe)
    n, d = F.col("NEXT_EFF_DT"), F.col(disc)
    if as_written:
        bad = n.isNotNull() & ((n <= d) | (F.datediff(d, n) > 1))
    else:
        bad = n.isNotNull() & (F.datediff(n, d) > 1)
    return v.filter(bad)


def gap_variants(dim, key, eff="EFF_DT", disc="DISC_DT", skew_safe=False):
    """Both forms of `gaps` from one pass: a row per hit with its VARIANT (gap / as_written)."""
    v = _with_next_eff(dim, key, eff, skew_safe)
    n, d = F.col("NEXT_EFF_DT"), F.col(disc)
    hits = F.array(F.when(F.datediff(n, d) > 1, F.lit("gap")),
                   F.when((n <= d) | (F.datediff(d, n) > 1), F.lit("as_written")))
    return v.select("*", F.explode(F.array_compact(hits)).alias("VARIANT"))


def any_out_of_range(df, ranges):
    """Rows with any (column, low, high) out of its range, once each."""
    return df.filter(reduce(lambda a, b: a | b, [_c(c).isNotNull() & ~_c(c).between(lo, hi) for c, lo, hi in ranges]))


def overlaps(dim, key, eff="EFF_DT", disc="DISC_DT", skew_safe=False):    # Q33
    v = _with_next_eff(dim, key, eff, skew_safe)
    return v.filter(F.col("NEXT_EFF_DT").isNotNull() & (F.col("NEXT_EFF_DT") <= F.col(disc)))


def is_current_mismatch(dim, disc="DISC_DT", cur="IS_CURRENT", both=True):   # Q5, Q29
    open_ = F.col(disc) == F.lit(OPEN_DATE)
    bad = open_ & (F.col(cur) != F.lit(True))
    if both:
        bad = bad | (~open_ & (F.col(cur) == F.lit(True)))
    return dim.filter(bad)


def attr_changes(dim, key, col, eff="EFF_DT", skew_safe=False):    # Q6: a count, always one row
    if skew_safe:
        from tidemark.operators.windows import neighbours
        v = neighbours(dim.select(key, eff, col), [key], [eff], [col], prefix_prev="_P_", prefix_next="_N_") \
            .withColumn("_prev", F.col(f"_P_{col}"))
    else:
        w = Window.partitionBy(key).orderBy(eff)
        v = dim.select(F.col(col), F.lag(col).over(w).alias("_prev"))
    return v.agg(F.count(F.when(F.col("_prev").isNotNull() & (F.col(col) != F.col("_prev")), 1))
                 .cast("bigint").alias("CHANGE_COUNT"))


def scd_integrity(dim, key, eff="EFF_DT", disc="DISC_DT", cur="IS_CURRENT", skew_safe=False):   # Q8
    """Q2-Q5 in one pass over the dimension: both windows (key ordered by EFF_DT for LEAD,
    key + DISC_DT for the duplicate count) are satisfied by one hash partitioning on the
    key, and each row emits its error labels through one explode. A duplicate DISC_DT
    group is reported once, like the GROUP BY of the reference.
    skew_safe=True, for dimensions with very long histories per key, takes the next version
    from the range-sort `neighbours` and the duplicates from a map-side aggregate."""
    k, e, d = F.col(key), F.col(eff), F.col(disc)
    if skew_safe:
        v = _with_next_eff(dim.select(key, eff, disc, cur), key, eff, True)
        open_, n = d == F.lit(OPEN_DATE), F.col("NEXT_EFF_DT")
        errors = F.array(F.when(d < e, F.lit("EFF_DT_AFTER_DISC_DT")),
                         F.when(F.datediff(n, d) > 1, F.lit("GAP_IN_HISTORY")), F.when(n <= d, F.lit("OVERLAPPING_DATES")),
                         F.when(open_ != F.col(cur), F.lit("IS_CURRENT_MISMATCH")))
        rows = v.select(k.alias("KEY"), e.alias("EFF_DT"), d.alias("DISC_DT"), F.explode(F.array_compact(errors)).alias("ERROR"))
        dup = dup_disc(dim, key, disc).select(k.alias("KEY"), d.alias("EFF_DT"), d.alias("DISC_DT"),
                                              F.lit("DUPLICATE_DISC_DT").alias("ERROR"))
        return rows.unionByName(dup)
    w_eff = Window.partitionBy(key).orderBy(eff)
    w_disc = Window.partitionBy(key, disc)
    v = dim.select(k.alias("KEY"), e.alias("_eff"), d.alias("_disc"), F.col(cur).alias("_cur"),
                   F.lead(eff).over(w_eff).alias("_next"),
                   F.count(F.lit(1)).over(w_disc).alias("_n_disc"),
                   F.row_number().over(w_disc.orderBy(eff)).alias("_rn_disc"))
    open_ = F.col("_disc") == F.lit(OPEN_DATE)
    n = F.col("_next")
    errors = F.array(
        F.when((F.col("_n_disc") > 1) & (F.col("_rn_disc") == 1), F.lit("DUPLICATE_DISC_DT")),
        F.when(F.col("_disc") < F.col("_eff"), F.lit("EFF_DT_AFTER_DISC_DT")),
        F.when(n.isNotNull() & (F.datediff(n, F.col("_disc")) > 1), F.lit("GAP_IN_HISTORY")),
        F.when(n.isNotNull() & (n <= F.col("_disc")), F.lit("OVERLAPPING_DATES")),
        F.when((open_ & (F.col("_cur") != F.lit(True))) | (~open_ & (F.col("_cur") == F.lit(True))),
               F.lit("IS_CURRENT_MISMATCH")))
    hits = v.select("*", F.explode(F.array_compact(errors)).alias("ERROR"))
    eff_out = F.when(F.col("ERROR") == "DUPLICATE_DISC_DT", F.col("_disc")).otherwise(F.col("_eff"))
    return hits.select("KEY", eff_out.alias("EFF_DT"), F.col("_disc").alias("DISC_DT"), "ERROR")


# The failure labels of the model check.
ROW_COUNT, STALE, BASELINE = "row_count_not_1", "trained_at_stale_or_null", "_baseline_missing_or_nonzero"


def model_coefficients(df, trained_at, baselines, as_of, max_age_days=30):   # Q42
    """Single-row model table check; one row per failure (FAILURE, DETAILS):
    'row_count_not_1' when the table does not hold exactly one row,
    'trained_at_stale_or_null' when max(trained_at) is NULL or older than max_age_days,
    '<name>_baseline_missing_or_nonzero' per row and per (name, levels, coefficients)
    in `baselines` when the coefficient of the first level is missing, not numeric or not 0.
    Levels and coefficients are an array and a map, or VARIANT values of these forms.
    All from one aggregate and plain filters."""
    kinds = dict(df.dtypes)
    stats = df.agg(F.count(F.lit(1)).alias("_n"), F.max(trained_at).alias("_mx"))
    parts = [
        stats.filter(F.col("_n") != 1).select(F.lit(ROW_COUNT).alias("FAILURE"),
                                              F.col("_n").cast("string").alias("DETAILS")),
        stats.filter(F.col("_mx").isNull()
                     | (F.col("_mx") < lit(as_of) - F.expr(f"INTERVAL {int(max_age_days)} DAYS")))
             .select(F.lit(STALE).alias("FAILURE"), F.col("_mx").cast("string").alias("DETAILS")),
    ]
    for name, levels, coef in baselines:
        first = (variant_value(levels, "$[0]", "string") if kinds[levels] == "variant"
                 else F.try_element_at(F.col(levels), F.lit(1)))
        base = (variant_value(coef, F.concat(F.lit("$['"), first, F.lit("']")), "double") if kinds[coef] == "variant"
                else F.try_element_at(F.col(coef), first).try_cast("double"))
        parts.append(df.filter(base.isNull() | (base != 0))
                       .select(F.lit(name + BASELINE).alias("FAILURE"),
                               first.cast("string").alias("DETAILS")))
    return reduce(lambda a, b: a.unionByName(b), parts)


# ------------------------------------------------------------------ suite

def run_suite(checks: Sequence[tuple[str, Callable[[], DataFrame]]], severity: str = "warn",
              row_checks: Sequence[tuple[DataFrame, Sequence[tuple[str, Column]]]] = ()) -> DataFrame:
    """One row per check: (CHECK_NAME, FAILURES, STATUS).

    `row_checks` lists, per table, the checks that look at one row at a time as (name, violated)
    conditions: all checks of a table are counted in one scan. `checks` are frames of violations
    (checks that group or join); each is counted by its own aggregate."""
    counts = [fn().agg(F.count(F.lit(1)).cast("bigint").alias("FAILURES")).select(F.lit(name).alias("CHECK_NAME"), "FAILURES")
              for name, fn in checks]
    for df, tests in row_checks:
        one = df.agg(*[F.count_if(F.coalesce(bad, F.lit(False))).alias(name) for name, bad in tests])
        counts.append(one.select(F.explode(F.array(*[F.struct(F.lit(n).alias("CHECK_NAME"), F.col(n).alias("FAILURES"))
                                                     for n, _ in tests])).alias("x")).select("x.*"))
    status = F.when(F.col("FAILURES") == 0, F.lit("pass")).otherwise(F.lit(severity))
    return reduce(lambda a, b: a.unionByName(b), counts).withColumn("STATUS", status)


KNOWN_STATUSES = ("pass", "warn", "error", "fail")


def summary(results: DataFrame, status="STATUS", time_col: str | None = None) -> DataFrame:
    """Status summary (G7): counts per known status, the total and total time. Unknown
    statuses count only in the total."""
    s = F.col(status)
    aggs = [F.count(F.when(s == k, 1)).cast("bigint").alias(f"{k.upper()}_COUNT") for k in KNOWN_STATUSES]
    aggs.append(F.count(F.lit(1)).cast("bigint").alias("TOTAL"))
    if time_col:
        aggs.append(F.sum(time_col).alias("TOTAL_TIME"))
    return results.agg(*aggs)
