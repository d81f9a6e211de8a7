"""Removal of lines that repeat across documents, by a range sort and compressed keep bitmaps.

Every line with a key of at least LEAST code points gives a record of its key's 128-bit hash, its
document and its place. The records are range-partitioned by (hash, document, place) and sorted,
so a line that a third of all documents hold is dealt over many partitions by its documents. Each
partition is one stream: the first record of a hash names the first document, later records of
other documents lose their line. What a partition cannot tell is whether its first hash began
before it: the lines of that hash in the first document seen there stay open until the partitions'
last hashes (one row each) are known.

The dropped places of a document become a bitmap of the lines that stay, packed and compressed;
bitmaps, not texts, are the operator's result. `remove` applies them to the texts.

Documents are told apart by id; a row is named by its id and a 64-bit hash of its text, because
the verdict follows from these two.

Edge cases: a NULL or empty text is one empty line; short keys and lines without a key stay;
repeats within one document stay; rows with the same id are one document (none of them loses a
line to another) but give a result row each; rows with a NULL id are one document that comes after
all others; an empty table gives an empty result; other columns are ignored.
"""

from __future__ import annotations

import hashlib
import zlib
from itertools import compress

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.llm.common import cut_lineage, few, in_arrow, narrow

LEAST = 10
STRIP = b" \t\n\x0b\x0c\r"
LAST = (1 << 63) - 1          # stands for a NULL id
RECORD = "hi bigint, lo bigint, doc bigint, row bigint, place int, n_lines int"
ORDER = ["hi", "lo", "doc", "row", "place"]
OPEN, DROPPED, EDGE = 0, 1, 2


def key(line: bytes) -> bytes:
    return line.strip(STRIP).lower()          # bytes: only A-Z


def _long(k: bytes, least: int) -> bool:
    return len(k) >= least and (len(k) >= 4 * least or len(k.decode()) >= least)


def _records(least: int):
    """One record per line with a key: hash, document, row, place, lines of the row."""
    def run(batches):
        for batch in batches:
            hashes, counts, places, sizes = [], [], [], []
            for text in batch.column(2):
                lines = text.as_py().encode().split(b"\n")
                keys = [(i, k) for i, k in enumerate(map(key, lines)) if _long(k, least)]
                hashes += [hashlib.blake2b(k, digest_size=16).digest() for _, k in keys]
                places += [i for i, _ in keys]
                counts.append(len(keys))
                sizes.append(len(lines))
            h = np.frombuffer(b"".join(hashes), np.int64).reshape(-1, 2)
            at = pa.array(np.repeat(np.arange(len(counts)), counts))
            yield pa.RecordBatch.from_arrays(
                [pa.array(h[:, 0]), pa.array(h[:, 1]), batch.column(0).take(at), batch.column(1).take(at),
                 pa.array(places, pa.int32()), pa.array(sizes, pa.int32()).take(at)],
                ["hi", "lo", "doc", "row", "place", "n_lines"])
    return run


def _first_occurrences(batches):
    """A partition's sorted records -> lines to drop, the lines that stay open, and its last hash
    with the first document that it saw of it."""
    first_key = now = doc_of_now = None       # the partition's first hash, the running one and its document
    for batch in batches:
        if not batch.num_rows:
            continue
        hi, lo, doc = (batch.column(i).to_numpy() for i in range(3))
        new = np.ones(len(hi), bool)
        new[1:] = (hi[1:] != hi[:-1]) | (lo[1:] != lo[:-1])
        new[0] = now != (hi[0], lo[0])
        if first_key is None:
            first_key = (hi[0], lo[0])
        since = np.maximum.accumulate(np.where(new, np.arange(len(hi)), -1))
        first = np.where(since >= 0, doc[since], 0 if doc_of_now is None else doc_of_now)
        dropped = doc > first
        open_ = ~dropped & (hi == first_key[0]) & (lo == first_key[1])
        told = batch.append_column("told", pa.array(np.where(dropped, DROPPED, OPEN).astype(np.int32)))
        yield told.filter(pa.array(dropped | open_))
        now, doc_of_now = (hi[-1], lo[-1]), first[-1]
    if now is not None:
        yield pa.RecordBatch.from_arrays(
            [pa.array([x], pa.int64()) for x in (*now, doc_of_now, 0)] + [pa.array([x], pa.int32()) for x in (0, 0, EDGE)],
            ["hi", "lo", "doc", "row", "place", "n_lines", "told"])


def _bitmaps(batches):
    """Dropped places -> zlib-compressed packed bits (little-endian), 1 for a line that stays."""
    for batch in batches:
        out, n = [], []
        for size, places in zip(batch.column(2).to_pylist(), batch.column(3)):
            keep = np.ones(size, bool)
            keep[np.asarray(places.values)] = False
            out.append(zlib.compress(np.packbits(keep, bitorder="little").tobytes()))
            n.append(size - int(keep.sum()))
        yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), batch.column(2), pa.array(n, pa.int32()),
                                          pa.array(out, pa.binary())], ["doc", "row", "n_lines", "n_dropped", "keep"])


def kept_lines(bitmap: bytes, n_lines: int) -> np.ndarray:
    """The bitmap as booleans."""
    return np.unpackbits(np.frombuffer(zlib.decompress(bitmap), np.uint8), count=n_lines, bitorder="little").astype(bool)


def _cut(batches):
    """The lines that stay, joined: digest and text."""
    for batch in batches:
        texts = [b"\n".join(compress(lines := t.as_py().encode().split(b"\n"), kept_lines(k, len(lines)).tolist()))
                 for t, k in zip(batch.column(3), batch.column(2).to_pylist())]
        yield pa.RecordBatch.from_arrays(
            [batch.column(0), batch.column(1), pa.array([hashlib.sha256(t).hexdigest() for t in texts]),
             pa.array([t.decode() for t in texts], pa.string())], ["doc", "row", "kept", "kept_text"])


def _input(docs: DataFrame, id_col: str, text_col: str) -> DataFrame:
    text = F.coalesce(F.col(text_col), F.lit(""))
    return narrow(docs, **{id_col: "bigint", text_col: "string"}).select(
        F.col(id_col).alias("doc_id"), F.coalesce(F.col(id_col), F.lit(LAST)).alias("doc"),
        F.xxhash64(text).alias("row"), text.alias("text"))


def bitmaps(docs: DataFrame, least: int = LEAST, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Staged doc (the id, LAST for NULL), row (xxhash64 of the text), n_lines, n_dropped, keep: the
    rows that lose a line, with the compressed bitmap of those that stay (`kept_lines`)."""
    rows = _input(docs, id_col, text_col)
    lines = rows.select("doc", "row", "text").transform(in_arrow, _records(least), RECORD)
    told = cut_lineage(lines.repartitionByRange(*ORDER).sortWithinPartitions(*ORDER).transform(
        in_arrow, _first_occurrences, RECORD + ", told int"))
    # one row per partition that holds records
    edges = told.filter(F.col("told") == EDGE).groupBy("hi", "lo").agg(F.min("doc").alias("first"))
    late = told.filter(F.col("told") == OPEN).join(F.broadcast(edges), ["hi", "lo"]).filter("doc > first")
    lost = told.filter(F.col("told") == DROPPED).select("doc", "row", "n_lines", "place").unionByName(
        late.select("doc", "row", "n_lines", "place"))
    # a group holds no more than the places of one text
    return cut_lineage(lost.groupBy("doc", "row", "n_lines").agg(F.collect_set("place").alias("places"))
                       .transform(in_arrow, _bitmaps, "doc bigint, row bigint, n_lines int, n_dropped int, keep binary"))


def remove(docs: DataFrame, least: int = LEAST, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """doc_id, n_lines, n_dropped, kept_sha256, and kept_text: the lines that stay of a text that lost
    some, joined by a line end (NULL: nothing lost)."""
    rows = _input(docs, id_col, text_col)
    keep = bitmaps(docs, least, id_col, text_col)
    # only the texts that lose a line are read whole; the bitmaps go to the scan if they are measured to be small
    small = few(keep.select("doc", "row", "keep"), size=F.octet_length("keep"))
    cut = cut_lineage(rows.join(small, ["doc", "row"]).select("doc", "row", "keep", "text")
                      .transform(in_arrow, _cut, "doc bigint, row bigint, kept string, kept_text string")
                      .dropDuplicates(["doc", "row"]))
    told = rows.select("doc_id", "doc", "row", F.size(F.split("text", "\n")).cast("bigint").alias("n_lines"),
                       F.sha2("text", 256).alias("digest"))
    lost = keep.select("doc", "row", "n_dropped").join(cut, ["doc", "row"])
    return told.join(lost, ["doc", "row"], "left").select(
        "doc_id", "n_lines", F.coalesce("n_dropped", F.lit(0)).cast("bigint").alias("n_dropped"),
        F.coalesce("kept", "digest").alias("kept_sha256"), "kept_text")
