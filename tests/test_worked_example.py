"""Worked example: two-source incremental customer model (FIXTURES §1, cases a-e).

Composes changed keys with per-source marks taken from the target (K1), semi-joins of
both sources to them (K2), the inner join + primary-address filter (P20), the
null-token surrogate key and change hash (H2) and the hash-gated upsert (E1)."""

import datetime as dt

from pyspark.sql import functions as F

from tidemark.functions.hashing import PACKAGE_NULL_TOKEN, surrogate_key
from tidemark.functions.literals import lit
from tidemark.operators.delta import KeySource, changed_keys, target_mark
from tidemark.operators.merge import ACTION, drop_action, merge_upsert

CUST = "CUSTOMER_ID int, FIRST_NAME string, LAST_NAME string, PHONE string, UPDATED_AT timestamp_ntz"
ADDR = "ADDRESS_ID int, CUSTOMER_ID int, CITY string, IS_PRIMARY boolean, UPDATED_AT timestamp_ntz"
T0, T1, T2 = dt.datetime(2025, 1, 1), dt.datetime(2025, 2, 1), dt.datetime(2025, 3, 1)
BUSINESS = ["FIRST_NAME", "LAST_NAME", "PHONE", "CITY", "IS_PRIMARY"]


def build(customers, addresses, target, batch_ts):
    """One run of the model. target None = first (full) load."""
    if target is not None:
        fallback = lit(dt.datetime(1900, 1, 1))
        keys = changed_keys([
            KeySource(customers, [F.col("CUSTOMER_ID")], "UPDATED_AT",
                      F.coalesce(target_mark(target, "CUSTOMER_UPDATED_AT"), fallback)),
            KeySource(addresses, [F.col("CUSTOMER_ID")], "UPDATED_AT",
                      F.coalesce(target_mark(target, "ADDRESS_UPDATED_AT"), fallback)),
        ])
        customers = customers.join(keys, "CUSTOMER_ID", "left_semi")
        addresses = addresses.join(keys, "CUSTOMER_ID", "left_semi")
    c = customers.withColumnRenamed("UPDATED_AT", "CUSTOMER_UPDATED_AT")
    a = addresses.withColumnRenamed("UPDATED_AT", "ADDRESS_UPDATED_AT")
    j = c.join(a, "CUSTOMER_ID", "inner").filter(F.col("IS_PRIMARY") == F.lit(True))
    src = j.select(
        surrogate_key("CUSTOMER_ID", "ADDRESS_ID", null_token=PACKAGE_NULL_TOKEN).alias("CUSTOMER_ADDRESS_PK"),
        "*", surrogate_key(*BUSINESS, null_token=PACKAGE_NULL_TOKEN).alias("HASH_CHANGE"),
        lit(batch_ts).alias("CDM_INSERT_TIMESTAMP"), lit(batch_ts).alias("CDM_UPDATE_TIMESTAMP"),
        F.lit("INSERT").alias("OPERATION_TYPE"))
    if target is None:
        return src.withColumn(ACTION, F.lit("insert"))
    return merge_upsert(target, src.select(*target.columns), "CUSTOMER_ADDRESS_PK",
                        no_update=["CDM_INSERT_TIMESTAMP"], check_unique=True)


def actions(df):
    return {r["CUSTOMER_ID"]: r[ACTION] for r in df.collect() if r[ACTION] != "unchanged"}


def test_two_source_incremental(spark):
    cust0 = [(i, f"F{i}", f"L{i}", f"555-000{i}", T0) for i in range(1, 6)]
    addr0 = [(i, i, f"City{i}", True, T0) for i in range(1, 6)] + [(10 + i, i, f"Work{i}", False, T0) for i in range(1, 6)]
    first = build(spark.createDataFrame(cust0, CUST), spark.createDataFrame(addr0, ADDR), None, T0)
    assert first.count() == 5                                    # (a) one row per customer, primary only
    target = drop_action(first).cache()

    cust1 = [r if r[0] != 2 else (2, "F2", "L2", "555-9999", T1) for r in cust0]          # (c) phone only
    cust1 = [r if r[0] != 5 else (5, "F5x", "L5", "555-0005", T1) for r in cust1]         # (d) customer side
    addr1 = [r if r[0] != 1 else (1, 1, "NewCity1", True, T1) for r in addr0]             # (b) address only
    addr1 = [r if r[0] != 3 else (3, 3, "NewCity3", True, T1) for r in addr1]             # (c) address only
    addr1 = [r if r[0] != 5 else (5, 5, "NewCity5", True, T1) for r in addr1]             # (d) address side
    addr1 = [r if r[0] != 14 else (14, 4, "Work4b", False, T1) for r in addr1]            # non-primary change
    second = build(spark.createDataFrame(cust1, CUST), spark.createDataFrame(addr1, ADDR), target, T1)
    assert actions(second) == {1: "update", 2: "update", 3: "update", 5: "update"}
    row5 = [r for r in second.collect() if r["CUSTOMER_ID"] == 5][0]
    assert (row5["FIRST_NAME"], row5["CITY"]) == ("F5x", "NewCity5")
    assert row5["CDM_INSERT_TIMESTAMP"] == T0 and row5["CDM_UPDATE_TIMESTAMP"] == T1   # no-update column kept
    target2 = drop_action(second).cache()

    third = build(spark.createDataFrame(cust1, CUST), spark.createDataFrame(addr1, ADDR), target2, T2)
    assert actions(third) == {}                                   # (e) re-run without change: no updates
    assert third.count() == 5
