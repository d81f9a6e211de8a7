"""Helpers shared by the corpus operators: narrow input frames, staged tables, global row
numbers, connected components and numpy word hashing for whole texts."""

from __future__ import annotations

import os

import numpy as np
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tidemark.sources.sinks import cut_lineage

BROADCAST_ROWS = 200_000
BROADCAST_SIZE = 8 << 20
ROW_BITS = 33     # monotonically_increasing_id keeps the row's place in its partition in 33 bits


def documents(spark: SparkSession, sf_dir: str, table: str = "documents") -> DataFrame:
    importable(spark)
    return spark.read.parquet(f"{sf_dir}/{table}.parquet")


def importable(spark: SparkSession) -> None:
    """Put the folder that holds this package on the Python workers' path (where it is not
    installed there; on a cluster ship the package with --py-files or install it)."""
    root = os.path.dirname(os.path.dirname(os.path.dirname(os.path.abspath(__file__))))
    environment = spark.sparkContext.environment
    have = [p for p in environment.get("PYTHONPATH", "").split(os.pathsep) if p]
    if root not in have:
        environment["PYTHONPATH"] = os.pathsep.join([root, *have])


def narrow(docs: DataFrame, **casts: str) -> DataFrame:
    """Only the named columns of `docs`, cast: extra columns, whatever their names, are left
    behind before the operator adds its own."""
    return docs.select(*[F.col(f"`{c}`").cast(t).alias(c) for c, t in casts.items()])


def text_key(text) -> Column:
    """16 bytes that stand for a text (NULL as empty): verdicts that follow from the text alone are
    joined back to the documents by it, whatever their order and partitions."""
    return F.unhex(F.md5(F.coalesce(text.cast("string"), F.lit("")).cast("binary")))


def few(df: DataFrame, bound: int = BROADCAST_ROWS, size: Column | None = None) -> DataFrame:
    """The staged `df`, sent to all tasks if it is measured to have at most `bound` rows, and, where
    its rows grow with the texts, at most BROADCAST_SIZE elements or bytes as `size` counts them
    per row; beyond that the same join shuffles."""
    df = cut_lineage(df)
    n, total = df.agg(F.count(F.lit(1)), F.coalesce(F.sum(F.lit(0) if size is None else size), F.lit(0))).first()
    return F.broadcast(df) if n <= bound and total <= BROADCAST_SIZE else df


def packed(docs: DataFrame, **more: Column) -> DataFrame:
    """The input rows in a struct `_in`, so that no column of theirs clashes with `more`."""
    return docs.select(F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("_in"),
                       *[c.alias(name) for name, c in more.items()])


def unpacked(df: DataFrame, columns: list[str]) -> DataFrame:
    return df.select(*[F.col(f"_in.`{c}`").alias(c) for c in columns])


BATCH_BYTES = "spark.sql.execution.arrow.maxBytesPerBatch"
SMALL, LARGE = "4m", "16m"


def in_arrow(df: DataFrame, work, schema: str, batch: str = SMALL) -> DataFrame:
    """`mapInArrow` with bounded memory: batches of `batch` where the session has Spark's default of
    64 MB (whatever the length of the texts), and freed memory goes back to the system when a
    task ends, because Spark keeps the worker for the next one. Spark reads the size of the
    batches when the plan runs, so the session keeps the setting of the last call; a size that the
    session sets itself is left alone."""
    conf = df.sparkSession.conf
    if conf.get(BATCH_BYTES) in ("67108864b", SMALL, LARGE):
        conf.set(BATCH_BYTES, batch)

    def run(batches):
        import pyarrow as pa
        pa.set_memory_pool(pa.system_memory_pool())     # its freed memory can be given back
        try:
            yield from work(batches)
        finally:
            give_back()

    return df.mapInArrow(run, schema)


def give_back() -> None:
    """Hand freed memory back to the system, and drop tables that grew with the longest text."""
    import pyarrow as pa
    _POW.clear()
    pa.default_memory_pool().release_unused()
    try:
        import ctypes
        ctypes.CDLL("libc.so.6").malloc_trim(0)
    except (OSError, AttributeError):       # another C library: nothing to trim
        pass


def smallest(df: DataFrame, by: Column, n: int, total: int, *ties) -> DataFrame:
    """About the `n` rows (at most) with the smallest hashes `by`. Rows beyond twice the share of n
    in `total` are left out before the sort, so the task that merges the parts reads a few
    times n rows, whatever the number of partitions."""
    spread = F.pmod(by, F.lit(1 << 32))
    share = min(1.0, 2.0 * n / max(total, 1))
    return df.filter(spread <= F.lit(int(share * (1 << 32)))).orderBy(spread, *ties).limit(n)


def number_rows(df: DataFrame, order: list[str], name: str = "row_no") -> DataFrame:
    """Add the global row number (from 0) in the order of the columns `order`, NULL first.

    A range sort deals the rows out (ties are split by the row's place in the input, so one
    key with a third of all rows does not meet in one task), each task numbers its own rows
    while the sorted table is staged, and the tasks' row counts are summed up. Only one row
    per task reaches the one-partition window and the broadcast."""
    tied = df.withColumn("_tie", F.monotonically_increasing_id())
    keys = [F.col(c).asc_nulls_first() for c in order] + [F.col("_tie")]
    placed = cut_lineage(tied.repartitionByRange(*keys).sortWithinPartitions(*keys).drop("_tie")
                         .withColumn("_at", F.monotonically_increasing_id()))
    placed = (placed.withColumn("_task", F.shiftright("_at", ROW_BITS))
              .withColumn("_at", F.col("_at").bitwiseAND(F.lit((1 << ROW_BITS) - 1))))
    before = Window.orderBy("_task").rowsBetween(Window.unboundedPreceding, -1)
    offsets = (placed.groupBy("_task").agg(F.count(F.lit(1)).alias("_n"))
               .select("_task", F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_before")))
    return (placed.join(F.broadcast(offsets), "_task")
            .withColumn(name, F.col("_before") + F.col("_at")).drop("_task", "_before", "_at"))


def components(edges: DataFrame, a: str = "a", b: str = "b", max_rounds: int = 60) -> DataFrame:
    """Connected components of an undirected edge list: (node, root), root the smallest node.

    Alternating large-star / small-star rounds; each is a partial aggregate and a join, so a
    node with very many edges is pre-aggregated and its join side can be split. Every round
    is a staged table; the loop ends when a round leaves the edges as they were."""
    cur = cut_lineage(edges.select(F.greatest(a, b).alias("u"), F.least(a, b).alias("v"))
                      .filter("u <> v").distinct())

    def state(df):
        r = df.agg(F.count(F.lit(1)).alias("n"), F.sum(F.xxhash64("u", "v").cast("decimal(20,0)")).alias("h")).first()
        return r["n"], r["h"]

    last = state(cur)
    for _ in range(max_rounds):
        if last[0] == 0:
            break
        both = cur.unionByName(cur.select(F.col("v").alias("u"), F.col("u").alias("v")))
        low = both.groupBy("u").agg(F.min("v").alias("m"))
        large = (both.join(low, "u").filter("v > u")
                 .select(F.col("v").alias("u"), F.least("u", "m").alias("v")).distinct())
        low = large.groupBy("u").agg(F.min("v").alias("m"))
        small = (large.join(low, "u").filter("v <> m").select(F.col("v").alias("u"), F.col("m").alias("v"))
                 .unionByName(low.select("u", F.col("m").alias("v"))).distinct())
        cur = cut_lineage(small)
        now = state(cur)
        if now == last:
            break
        last = now
    else:
        raise RuntimeError(f"components did not settle in {max_rounds} rounds")
    return (cur.select(F.col("u").alias("node"), F.col("v").alias("root"))
            .unionByName(cur.select(F.col("v").alias("node"), F.col("v").alias("root")).distinct()))


# ---- numpy hashing of whole texts -------------------------------------------------------

_ODD = np.uint64(0x9E3779B97F4A7C15)
_BASE = 0xD6E8FEB86659FD93


def mix64(x: np.ndarray) -> np.ndarray:
    """Finalise 64-bit hashes (xor-shift-multiply)."""
    x = x ^ (x >> np.uint64(32))
    x = x * np.uint64(0xD6E8FEB86659FD93)
    x = x ^ (x >> np.uint64(29))
    x = x * np.uint64(0xFF51AFD7ED558CCD)
    return x ^ (x >> np.uint64(32))


_BYTE = mix64(np.arange(1, 257, dtype=np.uint64) * _ODD)
_SEP = np.zeros(256, bool)
_SEP[[0x20, 0x09, 0x0A, 0x0B, 0x0C, 0x0D]] = True
_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[65:91] += 32
_POW = {}


def _powers(n: int):
    """BASE**i and BASE**-i (mod 2**64) for i < n, grown by doubling."""
    if _POW.get("n", 0) < n:
        size = 1 << max(14, int(n - 1).bit_length())
        inverse = pow(_BASE, -1, 1 << 64)
        up, down = np.ones(size, np.uint64), np.ones(size, np.uint64)
        have = 1
        while have < size:                       # b**(have+i) = b**have * b**i
            up[have:2 * have] = up[:have] * np.uint64(pow(_BASE, have, 1 << 64))
            down[have:2 * have] = down[:have] * np.uint64(pow(inverse, have, 1 << 64))
            have *= 2
        _POW.update(n=size, up=up, down=down)
    return _POW["up"], _POW["down"]


def word_hashes(data: np.ndarray, lower: bool = False):
    """64-bit hashes of the words (runs of bytes other than space and 0x09-0x0D) of one text
    given as UTF-8 bytes, with their byte starts and ends. A hash is a polynomial over the
    word's bytes taken from prefix sums, so no Python object is made per word."""
    if len(data) == 0:
        e = np.zeros(0, np.int64)
        return np.zeros(0, np.uint64), e, e
    if lower:
        data = _LOWER[data]
    word = ~_SEP[data]
    edge = np.diff(word.astype(np.int8), prepend=np.int8(0), append=np.int8(0))
    starts, ends = np.flatnonzero(edge == 1), np.flatnonzero(edge == -1)
    up, down = _powers(len(data) + 1)
    prefix = np.zeros(len(data) + 1, np.uint64)
    np.cumsum(_BYTE[data] * up[:len(data)], out=prefix[1:])
    return mix64((prefix[ends] - prefix[starts]) * down[starts]), starts, ends


def window_hashes(words: np.ndarray, k: int) -> np.ndarray:
    """Hashes of all runs of k consecutive words (empty if there are fewer)."""
    n = len(words) - k + 1
    if n <= 0:
        return np.zeros(0, np.uint64)
    h = np.zeros(n, np.uint64)
    for i in range(k):
        h = h * np.uint64(0x9FB21C651E98DF25) + words[i:i + n]
    return mix64(h)
