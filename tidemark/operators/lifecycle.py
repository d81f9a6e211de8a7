"""Lifecycle event fact derived from dimension versions (F1) and the row DQ score (F2).

One shared WindowSpec (key ordered by EFF_DT) feeds every LAG and the ROW_NUMBER, so
Spark sorts each key's versions once.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidemark.functions.hashing import md5_concat, surrogate_key
from tidemark.functions.literals import lit

# Status codes and labels of the event rules.
TERM_CODES = ("TERM", "T")
LOA_CODE = "LOA"
EVENT_TYPES = ("HIRE", "TERMINATION", "LOA", "RETURN", "ORG_TRANSFER", "ROLE_CHANGE", "PROFILE_UPDATE")
TENURE_BANDS = ("<1 year", "1-3 years", "3-5 years", "5+ years")
DAYS_PER_MONTH = 30.44
DAYS_PER_YEAR = 365.25


@dataclass(frozen=True)
class LifecycleSpec:
    key: str = "EMPLOYEE_EIN"
    eff: str = "EFF_DT"
    status: str = "EMPLOYEE_STATUS"
    job: str = "JOB_CODE"
    division: str = "DIVISION_NUMBER"
    supervisor: str | None = "SUPERVISOR_EIN"
    hire_date: str = "HIRE_DATE"
    sk: str = "EMPLOYEE_SK"
    source_system: str | None = None      # column with the source system's name
    data_source: str = "DIM_EMPLOYEE"                # fixed value: name of the dimension read


def _u(c: Column) -> Column:
    return F.upper(F.trim(c))


def _previous_versions(dim: DataFrame, spec: LifecycleSpec, skew_safe: bool) -> DataFrame:
    """Previous version's status / job / division / date and whether the row is the first
    version of its key: one shared key window, or the range-sort `neighbours`."""
    src = {"PREV_STATUS": spec.status, "PREV_JOB": spec.job, "PREV_DIV": spec.division,
           "PREV_EVENT_DATE": spec.eff}
    if spec.supervisor:
        src["PREV_SUP"] = spec.supervisor
    if skew_safe:
        from tidemark.operators.windows import neighbours
        cols = list(dict.fromkeys(list(src.values()) + ["_ONE"]))
        n = neighbours(dim.withColumn("_ONE", F.lit(1)), [spec.key], [spec.eff], cols,
                       prefix_prev="_P_", prefix_next="_N_")
        return n.select(*dim.columns, *[F.col(f"_P_{c}").alias(a) for a, c in src.items()],
                        F.when(F.col("_P__ONE").isNull(), 1).otherwise(2).alias("_VERSION_SEQ"))
    w = Window.partitionBy(spec.key).orderBy(spec.eff)
    return dim.select("*", *[F.lag(c).over(w).alias(a) for a, c in src.items()],
                      F.row_number().over(w).alias("_VERSION_SEQ"))


def lifecycle_events(dim: DataFrame, spec: LifecycleSpec = LifecycleSpec(), skew_safe: bool = False,
                     batch: int | None = None, run_ts=None) -> DataFrame:
    """Compare every version with the previous one of the same key and label it. `batch` and
    `run_ts` stamp the rows (both lineage pairs of a new fact row are equal).
    skew_safe=True takes the previous version from `operators.windows.neighbours`
    (range sort) instead of a per-key window, for keys with very long histories."""
    st, job, div = F.col(spec.status), F.col(spec.job), F.col(spec.division)
    v = _previous_versions(dim, spec, skew_safe)
    pst = F.col("PREV_STATUS")
    pjob, pdiv = F.col("PREV_JOB"), F.col("PREV_DIV")
    event = (F.when(F.col("_VERSION_SEQ") == 1, F.lit("HIRE"))
             .when(_u(st).isin(*TERM_CODES) & (pst.isNull() | ~_u(pst).isin(*TERM_CODES)), F.lit("TERMINATION"))
             .when((_u(st) == LOA_CODE) & (pst.isNull() | (_u(pst) != LOA_CODE)), F.lit("LOA"))
             .when((_u(pst) == LOA_CODE) & ~_u(st).isin(LOA_CODE, *TERM_CODES), F.lit("RETURN"))
             .when(div != pdiv, F.lit("ORG_TRANSFER"))
             .when(job != pjob, F.lit("ROLE_CHANGE"))
             .otherwise(F.lit("PROFILE_UPDATE")))
    eff = F.col(spec.eff)
    tenure = F.datediff(eff, F.col(spec.hire_date))
    band = (F.when(tenure < 365, F.lit(TENURE_BANDS[0])).when(tenure < 1095, F.lit(TENURE_BANDS[1]))
            .when(tenure < 1825, F.lit(TENURE_BANDS[2])).otherwise(F.lit(TENURE_BANDS[3])))
    is_term = F.when(F.upper(st).isin(*TERM_CODES) & (pst.isNull() | ~F.upper(pst).isin(*TERM_CODES)),
                     F.lit(True)).otherwise(F.lit(False))
    sup = F.col(spec.supervisor) if spec.supervisor else F.lit(None)
    stamp, loaded = F.lit(batch).cast("decimal(18,0)"), lit(run_ts).cast("timestamp_ntz") if run_ts else F.lit(None).cast("timestamp_ntz")
    hashed = [spec.key, spec.eff, spec.job, spec.division, *([spec.supervisor] if spec.supervisor else []), spec.status]
    ok = F.col(spec.key).isNotNull() & eff.isNotNull() & F.col(spec.sk).isNotNull()
    cols = [
        surrogate_key(spec.key, spec.eff).alias("LIFECYCLE_SK"),
        F.col(spec.sk).alias("EMPLOYEE_SK"),
        F.col(spec.key).alias("EMPLOYEE_EIN"),
        eff.cast("date").alias("EVENT_DATE"),
        event.alias("EVENT_TYPE"),
        F.year(eff).cast("int").alias("EVENT_FISCAL_YEAR"),
        F.quarter(eff).cast("int").alias("EVENT_QUARTER"),
        F.month(eff).cast("int").alias("EVENT_MONTH"),
        tenure.cast("int").alias("TENURE_DAYS"),
        F.round(tenure / F.lit(DAYS_PER_MONTH), 1).cast("decimal(10,1)").alias("TENURE_MONTHS"),
        F.round(tenure / F.lit(DAYS_PER_YEAR), 2).cast("decimal(10,2)").alias("TENURE_YEARS"),
        band.alias("TENURE_BAND"),
        F.datediff(eff, F.col("PREV_EVENT_DATE")).cast("int").alias("DAYS_SINCE_LAST_EVENT"),
        is_term.alias("IS_TERMINATION"),
        pjob.alias("PREV_JOB_CODE"),
        job.alias("NEW_JOB_CODE"),
        F.coalesce(job > pjob, F.lit(False)).alias("IS_PROMOTION"),
        F.coalesce(job < pjob, F.lit(False)).alias("IS_LATERAL"),
        pdiv.cast("int").alias("PREV_DIVISION_NUMBER"),
        div.cast("int").alias("NEW_DIVISION_NUMBER"),
        F.coalesce(div != pdiv, F.lit(False)).alias("IS_DIVISION_CHANGE"),
        (F.col("PREV_SUP") if spec.supervisor else F.lit(None)).cast("string").alias("PREV_SUPERVISOR_EIN"),
        sup.cast("string").alias("NEW_SUPERVISOR_EIN"),
        # not known to the dimension
        F.lit(None).cast("boolean").alias("IS_VOLUNTARY_TERM"),
        F.lit(None).cast("string").alias("TERM_REASON_CODE"), F.lit(None).cast("string").alias("TERM_REASON_DESC"),
        F.when(ok, F.lit(100.00)).otherwise(F.lit(0.00)).cast("decimal(5,2)").alias("DQ_SCORE"),
        F.when(ok, F.lit("PASSED")).otherwise(F.lit("FAILED")).alias("DQ_STATUS"),
        stamp.alias("INS_BATCH_ID"), stamp.alias("UPD_BATCH_ID"),
        (F.col(spec.source_system) if spec.source_system else F.lit(None)).cast("string").alias("SOURCE_SYSTEM"),
        F.lit(spec.data_source).alias("PRIMARY_DATA_SOURCE"),
        loaded.alias("CDM_INSERT_TIMESTAMP"), loaded.alias("CDM_UPDATE_TIMESTAMP"),
        md5_concat(hashed, "|").alias("HASH_CHANGE"),
        md5_concat([*hashed[:2], spec.sk, *hashed[2:], spec.hire_date], "|").alias("HASH_FULL"),
        F.lit("INSERT").alias("OPERATION_TYPE"),
    ]
    return v.select(*cols)


def dq_score(df: DataFrame, required: list[str]) -> DataFrame:
    """Row DQ score (F2): 100 / PASSED when every required column is set, else 0 / FAILED."""
    ok = F.lit(True)
    for c in required:
        ok = ok & F.col(c).isNotNull()
    return df.select("*", F.when(ok, F.lit(100.00)).otherwise(F.lit(0.00)).cast("decimal(5,2)").alias("DQ_SCORE"),
                     F.when(ok, F.lit("PASSED")).otherwise(F.lit("FAILED")).alias("DQ_STATUS"))
