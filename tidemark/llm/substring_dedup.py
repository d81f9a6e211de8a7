"""Removal of repeated passages by seed and extend.

Seeds: every text is fingerprinted by winnowing. Of the hashes of all runs of SEED words, the
smallest of each LENGTH - SEED + 1 consecutive ones is an anchor, so any passage of LENGTH words
that two documents share has an anchor in common. Anchors found in one document only are
dropped; the others are the seeds joined back to their documents.

Extension: a shared passage of at least LENGTH words around a seed is a chain of windows of
LENGTH words, each holding a seed, that step by one word to the left and to the right. Instead
of walking each pair of documents (a passage in a third of all documents would make a pair for
each two of them), every window that holds a seed is a key, and the smallest document id per key
tells at once whether an earlier document goes on in the same way. Chains of such windows are the
maximal repeats (`repeats` in the result, word positions); a document loses the words they
cover, the smallest document keeps them. A key is a 64-bit hash of the window's words; among n
windows that hold a shared seed about n**2 / 2**65 pairs agree by chance.

Texts with the same words are one class: only the class's smallest document is compared, the
others lose all their words (if there are LENGTH of them).

Edge cases: a NULL text has no words; texts shorter than LENGTH words lose nothing; windows that
repeat within one document only are kept; rows with the same id are one document in the
comparison (neither is smaller) but give a result row each, and a row among them that is a copy
of a smaller document leaves the others as they are (rows are told apart by id and a hash of the
text); NULL ids come after all others, among
themselves in the order of the texts' CRCs; an empty table gives an empty result; other columns
are ignored.
"""

from __future__ import annotations

import hashlib

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.llm.common import cut_lineage, in_arrow, narrow, window_hashes, word_hashes

LENGTH = 13
SEED = 5
NO_ID = (1 << 63) - 1         # less a text's CRC: stands for a NULL id in comparisons
BROADCAST_ROWS = 200_000      # ids sent to a scan, if so few are measured


def anchors(words: np.ndarray, length: int = LENGTH, seed: int = SEED):
    """Winnowed anchors of a text's word hashes: their hashes and places, each place once."""
    g = window_hashes(words, seed)
    w = length - seed + 1
    if len(g) < w:
        return g[:0], np.zeros(0, np.int64)
    views = np.lib.stride_tricks.sliding_window_view(g, w)
    at = np.unique(views.argmin(1) + np.arange(len(views)))
    return g[at], at


def _texts(column: pa.Array):
    """The UTF-8 bytes of each text of an Arrow string column, without copies."""
    column = column.cast(pa.large_string()) if not pa.types.is_large_string(column.type) else column
    n = len(column)
    offsets = np.frombuffer(column.buffers()[1], np.int64, n + 1, column.offset * 8)
    data = np.frombuffer(column.buffers()[2], np.uint8) if column.buffers()[2] else np.zeros(0, np.uint8)
    for i in range(n):
        yield data[offsets[i]:offsets[i + 1]]


def _signed(x: np.ndarray) -> np.ndarray:
    return x.view(np.int64)


def _first_pass(batches):
    """Per row: the words' number, class key and digest."""
    for batch in batches:
        n_words, keys, digests = [], [], []
        for data in _texts(batch.column(3)):
            words = data.tobytes().split()
            joined = b" ".join(words)
            n_words.append(len(words))
            keys.append(hashlib.blake2b(joined, digest_size=16).digest())
            digests.append(hashlib.sha256(joined).hexdigest())
        yield pa.RecordBatch.from_arrays([
            *batch.columns[:3], pa.array(n_words, pa.int64()), pa.array(keys, pa.binary()),
            pa.array(digests, pa.string())], ["doc", "doc_id", "row", "n_words", "key", "digest"])


def _anchor_pass(length, seed):
    def run(batches):
        for batch in batches:
            hashes, docs = [], []
            for doc, data in zip(batch.column(0).to_pylist(), _texts(batch.column(1))):
                h = np.unique(anchors(word_hashes(data)[0], length, seed)[0])
                hashes.append(h)
                docs.append(np.full(len(h), doc, np.int64))
            yield pa.RecordBatch.from_arrays([
                pa.array(_signed(np.concatenate(hashes)) if hashes else [], pa.int64()),
                pa.array(np.concatenate(docs) if docs else [], pa.int64())], ["h", "doc"])
    return run


def _window_pass(length, seed):
    """Keys of the windows that hold a seed."""
    def run(batches):
        for batch in batches:
            hashes, docs = [], []
            for doc, data, seeds in zip(batch.column(0).to_pylist(), _texts(batch.column(1)), batch.column(2)):
                words = word_hashes(data)[0]
                h, at = anchors(words, length, seed)
                at = at[np.isin(h, np.array(seeds.values, np.int64).view(np.uint64))]
                wins = window_hashes(words, length)
                mark = np.zeros(len(wins) + 1, np.int32)       # a seed at p lies in windows p-8 .. p
                np.add.at(mark, np.maximum(at - (length - seed), 0), 1)
                np.add.at(mark, np.minimum(at, len(wins) - 1) + 1, -1)
                hashes.append(np.unique(wins[np.cumsum(mark[:-1]) > 0]))
                docs.append(np.full(len(hashes[-1]), doc, np.int64))
            yield pa.RecordBatch.from_arrays([
                pa.array(_signed(np.concatenate(hashes)) if hashes else [], pa.int64()),
                pa.array(np.concatenate(docs) if docs else [], pa.int64())], ["h", "doc"])
    return run


def _cut_pass(length):
    """Take the words covered by repeated windows out of the texts."""
    def run(batches):
        for batch in batches:
            cols: list[list] = [[] for _ in range(5)]
            for data, hs in zip(_texts(batch.column(1)), batch.column(2)):
                words = data.tobytes().split()
                starts = np.flatnonzero(np.isin(window_hashes(word_hashes(data)[0], length),
                                                np.array(hs.values, np.int64).view(np.uint64)))
                gone = np.zeros(len(words) + 1, np.int32)
                np.add.at(gone, starts, 1)
                np.add.at(gone, starts + length, -1)
                keep = np.cumsum(gone[:-1]) == 0
                left = b" ".join([w for w, k in zip(words, keep.tolist()) if k])
                edge = np.flatnonzero(np.diff(keep, prepend=True, append=True)).reshape(-1, 2).tolist()
                for c, v in zip(cols, (hashlib.sha256(b" ".join(words)).hexdigest(), len(words) - int(keep.sum()),
                                       hashlib.sha256(left).hexdigest(), left.decode(),
                                       [{"start": a, "end": b} for a, b in edge])):
                    c.append(v)
            span = pa.list_(pa.struct([("start", pa.int32()), ("end", pa.int32())]))
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), *[pa.array(c, t) for c, t in
                                    zip(cols, (pa.string(), pa.int64(), pa.string(), pa.string(), span))]],
                ["doc", "digest", "n_cut", "kept", "kept_text", "repeats"])
    return run


def _input(docs: DataFrame, id_col: str, text_col: str) -> DataFrame:
    text = F.coalesce(F.col(text_col), F.lit(""))
    return narrow(docs, **{id_col: "bigint", text_col: "string"}).select(
        F.coalesce(F.col(id_col), F.lit(NO_ID) - F.crc32(text.cast("binary"))).alias("doc"),
        F.col(id_col).alias("doc_id"), F.xxhash64(text).alias("row"), text.alias("text"))


def _only(docs: DataFrame, ids: DataFrame, how: str) -> DataFrame:
    """Semi or anti join on the columns of `ids`. They go to the scan if they are measured to be few;
    beyond that the same join shuffles."""
    ids = cut_lineage(ids.distinct())
    return docs.join(F.broadcast(ids) if ids.count() <= BROADCAST_ROWS else ids, ids.columns, how)


def repeats(docs: DataFrame, length: int = LENGTH, seed: int = SEED) -> DataFrame:
    """(doc, hs): per document the keys of its windows that an earlier document has too. `docs`
    has doc (no NULL) and text. A document's group holds no more than its own windows."""
    found = docs.select("doc", "text").transform(in_arrow, _anchor_pass(length, seed), "h bigint, doc bigint")
    # counts are staged before they are joined back: both sides of the join are then shuffles of
    # their own, and the rows of a hot anchor, window or class can be split over tasks
    shared = cut_lineage(found.groupBy("h").agg(F.min("doc").alias("lo"), F.max("doc").alias("hi"))
                         .filter("lo <> hi").select("h"))
    seeds = cut_lineage(found.join(shared, "h").groupBy("doc").agg(F.collect_set("h").alias("seeds")))
    texts = _only(docs.select("doc", "text"), seeds.select("doc"), "left_semi")
    windows = cut_lineage(texts.join(seeds, "doc").select("doc", "text", "seeds")
                          .transform(in_arrow, _window_pass(length, seed), "h bigint, doc bigint"))
    first = cut_lineage(windows.groupBy("h").agg(F.min("doc").alias("lo"), F.max("doc").alias("hi"))
                        .filter("lo <> hi").select("h", "lo"))
    return windows.join(first, "h").filter("doc > lo").groupBy("doc").agg(F.collect_set("h").alias("hs"))


def remove(docs: DataFrame, length: int = LENGTH, seed: int = SEED, id_col: str = "doc_id",
           text_col: str = "text") -> DataFrame:
    """doc_id, n_words, n_removed, kept_sha256, kept_text: the kept words of a text that lost some,
    joined by a space (NULL: nothing lost), and repeats: the removed runs as places of their first
    word and the word behind their last (NULL likewise)."""
    rows = _input(docs, id_col, text_col)
    told = cut_lineage(rows.transform(in_arrow, 
        _first_pass, "doc bigint, doc_id bigint, row bigint, n_words bigint, key binary, digest string"))
    classes = cut_lineage(told.groupBy("key").agg(F.min("doc").alias("first")))
    told = cut_lineage(told.join(classes, "key").withColumn("copy", F.col("doc") > F.col("first")))
    singles = _only(rows, told.filter("copy").select("doc", "row"), "left_anti")
    gone = cut_lineage(repeats(singles, length, seed))
    texts = _only(singles.select("doc", "text"), gone.select("doc"), "left_semi")
    cut = (texts.join(gone, "doc").select("doc", "text", "hs")
           .transform(in_arrow, _cut_pass(length), "doc bigint, digest string, n_cut bigint, kept string, kept_text string, "
                      "repeats array<struct<start:int,end:int>>")
           .dropDuplicates(["doc", "digest"]))
    whole = F.col("copy") & (F.col("n_words") >= length)       # a later copy loses every word
    return told.join(cut, ["doc", "digest"], "left").select(
        "doc_id", "n_words",
        F.when(whole, F.col("n_words")).otherwise(F.coalesce("n_cut", F.lit(0))).cast("bigint").alias("n_removed"),
        F.when(whole, F.sha2(F.lit(""), 256)).otherwise(F.coalesce("kept", "digest")).alias("kept_sha256"),
        F.when(whole, F.lit("")).otherwise(F.col("kept_text")).alias("kept_text"),
        F.when(whole, F.array(F.struct(F.lit(0).alias("start"), F.col("n_words").cast("int").alias("end"))))
        .otherwise(F.col("repeats")).alias("repeats"))
