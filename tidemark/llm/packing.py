"""Best-fit packing planned on the length histogram.

Texts are tokenized, an end id is added, and a document longer than a sequence is cut into
pieces of the full length, the remainder first. Best-fit decreasing then runs over the counts
of the lengths, not over the pieces: sequences with the same free space form one group, and a
step fills a whole group, or places all pieces left of a length. The plan's size depends on the
capacity alone (a few thousand entries at 1024), whatever the number of documents. Pieces are
ranked within their length and take the places planned for that rank by a join on the length.

Edge cases: a NULL or empty text is the end id alone; NULL ids and repeated rows are packed like
any other row (pieces of rows with the same id are told apart by their place in the input); an
empty table gives an empty result; columns other than the id and the text are ignored.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.llm import tokens
from tidemark.llm.common import cut_lineage, in_arrow, narrow, number_rows

CAPACITY = 1024
END_ID = 2


def plan(histogram: dict[int, int], capacity: int = CAPACITY) -> list[tuple[int, int, int, int, int, int]]:
    """Best-fit decreasing over counts. Entries (length, rank0, n, sequence0, offset, each):
    the pieces of this length with ranks rank0 .. rank0+n-1 go `each` to a sequence, from
    sequence0 on and from `offset` on in each of them.

    The best fit for a piece is the open sequence with the least room that still holds it;
    after it has taken the piece it is again the best fit for the next one of the length, as
    long as it has room, so a sequence takes room // length pieces at once."""
    free: dict[int, list[tuple[int, int]]] = {}        # room -> [(first sequence, how many)]
    out, made = [], 0
    for length in sorted(histogram, reverse=True):
        left, rank = histogram[length], 0
        if not 0 < length <= capacity:
            raise ValueError(f"length {length} outside 1..{capacity}")
        while left:
            room = min((r for r in free if r >= length), default=capacity)
            each = room // length
            if room in free:
                first, n = free[room].pop()
                if not free[room]:
                    del free[room]
            else:
                first, n = made, -(-left // each)
                made += n
            whole = min(n, left // each)
            for start, count, per in ((first, whole, each), (first + whole, 1, left - whole * each)):
                if start >= first + n or count == 0 or not 0 < per <= each:
                    continue
                out.append((length, rank, count * per, start, capacity - room, per))
                rank, left, n, first = rank + count * per, left - count * per, n - count, start + count
                if room - per * length:
                    free.setdefault(room - per * length, []).append((start, count))
            if n:
                free.setdefault(room, []).append((first, n))
    return out


def _pieces(path: str, end_id: int, capacity: int, with_ids: bool):
    def run(batches):
        enc = tokens.encoder(path)
        for batch in batches:
            docs = batch.column(0).to_pylist()
            for first, ids, at in enc.encode_column(batch.column(1), end_id):
                sizes = np.diff(at)
                count = -(-sizes // capacity)
                doc = np.repeat(np.arange(len(sizes)), count)
                piece = np.arange(len(doc)) - np.repeat(np.cumsum(count) - count, count)
                head = sizes - (count - 1) * capacity           # the first piece is the short one
                start = np.where(piece == 0, 0, head[doc] + (piece - 1) * capacity)
                length = np.where(piece == 0, head[doc], capacity)
                parts = [ids[a:a + n].tobytes() for a, n in zip((at[doc] + start).tolist(), length.tolist())]
                cols = [pa.array([docs[first + d] for d in doc.tolist()], pa.int64()), pa.array(piece.astype(np.int32)),
                        pa.array(start, pa.int64()), pa.array(length, pa.int64()),
                        pa.array([tokens.crc(x) for x in parts], pa.int64())]
                if with_ids:
                    cols.append(pa.array(parts, pa.binary()))
                yield pa.RecordBatch.from_arrays(
                    cols, ["doc_id", "piece", "start", "length", "ids_crc32", "ids"][:len(cols)])
    return run


def pieces(docs: DataFrame, path: str, end_id: int = END_ID, capacity: int = CAPACITY, with_ids: bool = False,
           id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Token pieces of at most `capacity` ids; `with_ids` adds them (little-endian uint32)."""
    schema = "doc_id bigint, piece int, start bigint, length bigint, ids_crc32 bigint" + ", ids binary" * with_ids
    return narrow(docs, **{id_col: "bigint", text_col: "string"}).transform(in_arrow, 
        _pieces(path, end_id, capacity, with_ids), schema)


def pack(docs: DataFrame, path: str | None = None, end_id: int = END_ID, capacity: int = CAPACITY,
         with_ids: bool = False, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per piece with its sequence_id and offset; sequences are filled from 0 without gaps."""
    spark = docs.sparkSession
    cut = cut_lineage(pieces(docs, path or tokens.default_path(), end_id, capacity, with_ids, id_col, text_col))
    # at most `capacity` rows
    histogram = {r["length"]: r["n"] for r in cut.groupBy("length").agg(F.count(F.lit(1)).alias("n")).collect()}
    first, before = {}, 0
    for length in sorted(histogram):
        first[length], before = before, before + histogram[length]
    ranked = number_rows(cut, ["length", "doc_id", "piece", "start"])
    # bounded by the capacity: every step ends a group or a length, and each opens at most two groups
    steps = [(length, first[length] + rank, n, seq, offset, each)
             for length, rank, n, seq, offset, each in plan(histogram, capacity)]
    if len(steps) > 64 * capacity:
        raise AssertionError("the plan outgrew its bound")
    planned = spark.createDataFrame(steps, "length bigint, r0 bigint, n bigint, s0 bigint, o0 bigint, each bigint")
    at = F.col("row_no") - F.col("r0")
    return (ranked.join(F.broadcast(planned), "length")
            .filter((F.col("row_no") >= F.col("r0")) & (F.col("row_no") < F.col("r0") + F.col("n")))
            .select(*[c for c in cut.columns],
                    (F.col("s0") + (at - at % F.col("each")) / F.col("each")).cast("bigint").alias("sequence_id"),
                    (F.col("o0") + at % F.col("each") * F.col("length")).cast("bigint").alias("offset")))
