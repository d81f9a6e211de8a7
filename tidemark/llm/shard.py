"""Sharding by a Feistel permutation of global row numbers (native DataFrame functions only).

Rows are numbered 0..N-1 in the order (doc_id, text CRC, size), NULL first, rows that agree in
all three in any order (they are interchangeable). A keyed Feistel network over the mixed-radix
pair (row div b, row mod b), a*b >= N, permutes the numbers; a result outside 0..N-1 is walked
on through the network until it falls inside (cycle walking), so the map is a permutation of
0..N-1. Place p goes to shard p mod S, slot p div S: the shards' counts differ by at most one
(law `rows`), slots have no gaps, and shard and slot of a row follow from its number and the
seed alone, without a look at other rows.

Edge cases: NULL text counts 0 bytes (size 1, CRC 0), NULL doc_id sorts first and is kept,
repeated rows each get a place of their own, an empty table gives an empty result, columns
other than the id and the text are ignored. The law puts equal texts in different shards if
their numbers say so; only the counts are balanced.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.llm.common import narrow, number_rows

ROUNDS = 6
WALKS = 16
PRIME = 2147483647        # 2**31 - 1: products of two residues stay below 2**62


def round_keys(seed: int) -> list[tuple[int, int]]:
    """(multiplier, addend) of each round, derived from the seed."""
    out, x = [], seed % PRIME + 1
    for _ in range(ROUNDS):
        x = x * 48271 % PRIME
        a = x
        x = x * 48271 % PRIME
        out.append((a, x))
    return out


def radix(n: int) -> tuple[int, int]:
    """a, b with a*b >= n and a*b - n < a: hardly any walk is needed."""
    a = max(1, math.isqrt(max(n, 1) - 1) + 1)
    return a, max(1, -(-max(n, 1) // a))


def _mixed(x: Column, key: Column) -> Column:
    t = (x * key["m"] + key["c"]) % F.lit(PRIME)
    return F.shiftright(t * t % F.lit(PRIME), 3)


def permute(row: Column, n: int, seed: int) -> Column:
    """The place of row number `row` under the permutation of 0..n-1, as a Column.

    One pass through the network keeps (l, r) in Z_a x Z_b; odd rounds change l, even ones r.
    The walk re-enters the network while the value is >= n: at most a - 1 values lie outside,
    so for n <= 225 WALKS passes always end inside, and for larger n a row still outside has
    probability below (1/sqrt(n))**WALKS; `shard_rows` walks on if there is one."""
    a, b = radix(n)
    keys = F.array(*[F.struct(F.lit(m).cast("bigint").alias("m"), F.lit(c).cast("bigint").alias("c"),
                              F.lit(i % 2 == 0).alias("left")) for i, (m, c) in enumerate(round_keys(seed))])

    def step(s: Column, key: Column) -> Column:
        return F.struct(
            F.when(key["left"], (s["l"] + _mixed(s["r"], key)) % F.lit(a)).otherwise(s["l"]).alias("l"),
            F.when(key["left"], s["r"]).otherwise((s["r"] + _mixed(s["l"], key)) % F.lit(b)).alias("r"))

    def once(x: Column) -> Column:
        start = F.struct(((x - x % F.lit(b)) / F.lit(b)).cast("bigint").alias("l"), (x % F.lit(b)).alias("r"))
        return F.aggregate(keys, start, step, lambda s: s["l"] * F.lit(b) + s["r"])

    return F.aggregate(F.sequence(F.lit(1), F.lit(WALKS)), F.lit(n).cast("bigint"),
                       lambda at, i: F.when((i > 1) & (at < F.lit(n)), at)
                       .otherwise(once(F.when(i == 1, row).otherwise(at))))


def shard_rows(docs: DataFrame, shards: int = 8, seed: int = 20240607, id_col: str = "doc_id",
               text_col: str = "text") -> DataFrame:
    """doc_id, size, text_crc32, law, shard, slot, grown_shard (NULL: the law is `rows`)."""
    rows = narrow(docs, **{id_col: "bigint", text_col: "string"}).select(
        F.col(id_col).alias("doc_id"),
        (F.coalesce(F.octet_length(text_col), F.lit(0)) + 1).cast("bigint").alias("size"),
        F.crc32(F.coalesce(F.col(text_col), F.lit("")).cast("binary")).alias("text_crc32"))
    numbered = number_rows(rows, ["doc_id", "text_crc32", "size"])
    n = numbered.count()
    placed = numbered.withColumn("place", permute(F.col("row_no"), n, seed))
    while n > 225:            # the tail of the walk; practically never entered
        left = placed.filter(F.col("place") >= n).limit(1).count()
        if not left:
            break
        placed = placed.withColumn("place", F.when(F.col("place") >= n, permute(F.col("place"), n, seed))
                                   .otherwise(F.col("place")))
    return placed.select(
        "doc_id", "size", "text_crc32", F.lit("rows").alias("law"),
        (F.col("place") % shards).cast("int").alias("shard"),
        F.floor(F.col("place") / shards).cast("bigint").alias("slot"),
        F.lit(None).cast("int").alias("grown_shard"))
