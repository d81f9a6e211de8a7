"""Token ids in directly addressable codes.

An id is cut into chunks of 8 bits, lowest first. Level 0 holds the first chunk of every id,
level k the next chunk of those ids that go on. Beside each level lies a bitmap saying which
ids go on, and a rank directory (ones before each block of 512 bits), so the place of an id's
next chunk on the level above is a rank, and any token is read with a few look-ups, without
decoding its neighbours.

File format: a Parquet table of segments written by Spark (so the files appear whole, on any
store Spark writes to, and a lost executor only repeats its task), one row per run of documents
in ascending id order: task, segment, tokens before it in the task, document ids and lengths, and
`codes`, the bytes described at `pack_ids`.

Edge cases: a NULL or empty text is the end id alone; NULL ids come first; rows with the same id
are ordered by text CRC, then by place in the input, and each keeps its own row; an empty table
writes an empty table; other columns are ignored. A document is never split over segments.
"""

from __future__ import annotations

import uuid
import zlib

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tidemark.llm import tokens
from tidemark.llm.common import LARGE, in_arrow, narrow
from tidemark.session import checkpoint_dir

BLOCK = 512                   # bits per rank block
SEGMENT = 1 << 18             # tokens after which a segment is closed
MAGIC = b"DAC1"
SEGMENTS = ("task bigint, segment int, before bigint, n_tokens bigint, doc_ids array<bigint>, "
            "lengths array<bigint>, codes binary")


def pack_ids(ids: np.ndarray) -> bytes:
    """MAGIC, levels (u4), then per level: count (u8), chunks (u1 each), bitmap (count bits,
    little-endian, padded to 64), ranks (u4 per block of 512 bits). All little-endian."""
    levels = []
    rest = ids.astype(np.uint32)
    while True:
        more = rest > 0xFF
        bits = np.packbits(more, bitorder="little")
        bits = np.concatenate([bits, np.zeros(-len(bits) % 64, np.uint8)])
        ones = np.bitwise_count(bits.reshape(-1, BLOCK // 8)).sum(1, dtype=np.uint32)
        ranks = (np.cumsum(ones) - ones).astype("<u4")
        levels.append(np.array([len(rest)], "<u8").tobytes() + (rest & 0xFF).astype(np.uint8).tobytes()
                      + bits.tobytes() + ranks.tobytes())
        rest = rest[more] >> np.uint32(8)
        if not len(rest):
            break
    return MAGIC + np.array([len(levels)], "<u4").tobytes() + b"".join(levels)


class Codes:
    """Random access to the ids of one segment's `codes`."""

    def __init__(self, data: bytes):
        if data[:4] != MAGIC:
            raise ValueError("not a DAC1 segment")
        at = 8
        self.levels = []
        for _ in range(int(np.frombuffer(data, "<u4", 1, 4)[0])):
            n = int(np.frombuffer(data, "<u8", 1, at)[0])
            nbits = -(-n // BLOCK) * (BLOCK // 8)
            chunks = np.frombuffer(data, np.uint8, n, at + 8)
            bits = np.frombuffer(data, np.uint8, nbits, at + 8 + n)
            ranks = np.frombuffer(data, "<u4", nbits * 8 // BLOCK, at + 8 + n + nbits)
            self.levels.append((chunks, bits, ranks))
            at += 8 + n + nbits + 4 * len(ranks)

    def __len__(self) -> int:
        return len(self.levels[0][0])

    def __getitem__(self, i: int) -> int:
        if not 0 <= i < len(self):
            raise IndexError(i)
        value = shift = 0
        for chunks, bits, ranks in self.levels:
            value |= int(chunks[i]) << shift
            if not bits[i >> 3] >> (i & 7) & 1:
                return value
            block = i // BLOCK
            ones = int(np.bitwise_count(bits[block * 64:i >> 3]).sum())
            ones += (int(bits[i >> 3]) & ((1 << (i & 7)) - 1)).bit_count()
            i, shift = int(ranks[block]) + ones, shift + 8
        return value

    def slice(self, start: int, stop: int) -> np.ndarray:
        """Ids start..stop-1: one rank per level, then a run of chunks."""
        out = np.zeros(stop - start, np.uint32)
        where, lo, n = np.arange(stop - start), start, stop - start
        for level, (chunks, bits, ranks) in enumerate(self.levels):
            out[where] |= chunks[lo:lo + n].astype(np.uint32) << np.uint32(8 * level)
            span = bits[lo >> 3:(lo + n + 7) >> 3]
            more = np.unpackbits(span, bitorder="little")[lo & 7:(lo & 7) + n].astype(bool)
            where = where[more]
            if not len(where):
                break
            block = lo // BLOCK
            ones = int(np.bitwise_count(bits[block * 64:lo >> 3]).sum())
            ones += (int(bits[lo >> 3]) & ((1 << (lo & 7)) - 1)).bit_count()
            lo, n = int(ranks[block]) + ones, len(where)
        return out


def _write(path: str, end_id: int, segment: int):
    def run(batches):
        from pyspark import TaskContext
        task, enc = TaskContext.get().partitionId(), tokens.encoder(path)
        held: list[np.ndarray] = []
        docs: list = []
        lengths: list[int] = []
        before, number, size = 0, 0, 0

        def row():
            return pa.RecordBatch.from_arrays([
                pa.array([task], pa.int64()), pa.array([number], pa.int32()), pa.array([before], pa.int64()),
                pa.array([size], pa.int64()), pa.array([docs], pa.list_(pa.int64())),
                pa.array([lengths], pa.list_(pa.int64())), pa.array([pack_ids(np.concatenate(held))], pa.binary())],
                ["task", "segment", "before", "n_tokens", "doc_ids", "lengths", "codes"])

        for batch in batches:
            names = batch.column(0).to_pylist()
            for first, ids, at in enc.encode_column(batch.column(1), end_id):
                lo = 0
                while lo < len(at) - 1:      # documents until the segment is full
                    hi = min(len(at) - 1, max(lo + 1, int(np.searchsorted(at, at[lo] + segment - size))))
                    held.append(ids[at[lo]:at[hi]])
                    docs += names[first + lo:first + hi]
                    lengths += np.diff(at[lo:hi + 1]).tolist()
                    size += int(at[hi] - at[lo])
                    lo = hi
                    if size >= segment:
                        yield row()
                        before, number, held, docs, lengths, size = before + size, number + 1, [], [], [], 0
        if docs:
            yield row()
    return run


def write(docs: DataFrame, folder: str | None = None, path: str | None = None, end_id: int = 0,
          segment: int = SEGMENT, id_col: str = "doc_id", text_col: str = "text") -> str:
    """Tokenize, append the end id, and write the segments in ascending id order; the folder.

    A range sort of the texts deals documents of one id over tasks if need be."""
    folder = folder or f"{checkpoint_dir(docs.sparkSession)}/tokens/t-{uuid.uuid4().hex}"
    rows = (narrow(docs, **{id_col: "bigint", text_col: "string"})
            .withColumn("_crc", F.crc32(F.coalesce(F.col(text_col), F.lit("")).cast("binary")))
            .withColumn("_tie", F.monotonically_increasing_id()))
    keys = [F.col(id_col).asc_nulls_first(), F.col("_crc"), F.col("_tie")]
    (rows.repartitionByRange(*keys).sortWithinPartitions(*keys).select(id_col, text_col)
     .transform(in_arrow, _write(path or tokens.default_path(), end_id, segment), SEGMENTS, LARGE)
     .write.mode("errorifexists").parquet(folder))
    return folder


def _read(batches):
    for batch in batches:
        cols = {n: batch.column(i) for i, n in enumerate(batch.schema.names)}
        for k in range(batch.num_rows):
            codes = Codes(cols["codes"][k].as_py())
            lengths = np.array(cols["lengths"][k].as_py(), np.int64)
            ends = np.cumsum(lengths)
            flat = codes.slice(0, len(codes)).astype(tokens.ID)
            crcs = [zlib.crc32(flat[e - n:e].tobytes()) for e, n in zip(ends, lengths)]
            yield pa.RecordBatch.from_arrays([
                pa.array(cols["doc_ids"][k].as_py(), pa.int64()),
                pa.array(cols["first"][k].as_py() + ends - lengths, pa.int64()),
                pa.array(lengths, pa.int64()), pa.array(crcs, pa.int64())],
                ["doc_id", "start", "n_tokens", "ids_crc32"])


def read(spark, folder: str) -> DataFrame:
    """Read the files back: per document its id, the tokens of all documents before it, its
    number of tokens and the CRC of its ids."""
    table = spark.read.schema(SEGMENTS).parquet(folder)
    before = Window.orderBy("task").rowsBetween(Window.unboundedPreceding, -1)
    # one row per writing task
    tasks = (table.groupBy("task").agg(F.sum("n_tokens").alias("n"))
             .select("task", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("earlier")))
    return (table.join(F.broadcast(tasks), "task")
            .select((F.col("earlier") + F.col("before")).alias("first"), "doc_ids", "lengths", "codes")
            .transform(in_arrow, _read, "doc_id bigint, start bigint, n_tokens bigint, ids_crc32 bigint"))
