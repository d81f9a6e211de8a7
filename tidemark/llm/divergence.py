"""Divergence of the sources of each language from each other, on run-length columns.

1. Terms are counted per (language, source) within Arrow batches with numpy and summed by Spark;
   terms in fewer than MIN_DOCS documents of a language are dropped.
2. The vocabulary of a language is reordered so that equal counts stand together: by the counts in
   its LEAD largest sources, then by the total. Its places are cut into blocks of BLOCK terms.
3. Every source's column of a block is run-length encoded: where runs of equal values end, and
   their values. A column without any count is one run.
4. For each pair of columns the run boundaries are intersected; within a piece both values are
   constant, so |p - q| times the piece's length is added. Sources are dealt into tiles of TILE
   columns, so a task holds two tiles of one block, whatever the number of sources or terms.

The values are integers throughout: p is a quotient of decimals in Spark, sums are 64-bit.

Part `pair` is by its definition a row for each ordered pair of sources of a language; the pieces
behind it never leave the tasks. Part `term` ranks the terms that a source has more often than its
language, a partial top list per task first.

Edge cases: NULL text, lang and source are read as ''; a source without any kept term takes part
with counts of 0; a language without kept terms gives pairs of value 0 and no terms; a language
with one source gives no pairs; every input row is a document of its own, whatever its id; ties in
value are ranked by the item's bytes; an empty table gives an empty result; other columns are
ignored.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidemark.llm.common import LARGE, cut_lineage, few, in_arrow, narrow, number_rows

MIN_DOCS = 30
SCALE, PRIOR = 1_000_000_000, 5
TOP = 50
LEAD = 16                     # sources whose counts order the vocabulary
BLOCK = 1 << 14
TILE = 32
PIECE = 8 << 20               # bytes of text whose terms are numbered at once
NO_TERM = 0x20

_LETTERS = np.full(256, NO_TERM, np.uint8)
_LETTERS[0x41:0x5B] = np.arange(0x61, 0x7B)
_LETTERS[0x61:0x7B] = np.arange(0x61, 0x7B)
_LETTERS[0x80:] = np.arange(0x80, 0x100)


def _letters(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """The texts' bytes with A-Z lower-cased and a space for every byte outside terms, and where
    each text starts and ends."""
    column = pc.fill_null(column.cast(pa.large_string()), "")
    at = np.frombuffer(column.buffers()[1], np.int64, len(column) + 1, column.offset * 8)
    data = np.frombuffer(column.buffers()[2] or b"", np.uint8)[at[0]:at[-1]]
    return _LETTERS[data], at - at[0]


def _ranges(data: np.ndarray, at: np.ndarray):
    """(first text, last text, from, to): slices of about PIECE bytes, cut between texts, or at a
    space within a text that is longer."""
    doc, lo = 0, 0
    while doc < len(at) - 1:
        if at[doc + 1] - lo > PIECE:                   # a long text: up to its next space
            space = np.flatnonzero(data[lo + PIECE:at[doc + 1]] == NO_TERM)
            hi = lo + PIECE + int(space[0]) if len(space) else int(at[doc + 1])
            yield doc, doc, lo, hi
            lo = hi
            doc += hi == at[doc + 1]
        else:
            last = max(doc, int(np.searchsorted(at, lo + PIECE, "right")) - 2)
            yield doc, last, lo, int(at[last + 1])
            doc, lo = last + 1, int(at[last + 1])


def _counts(batches):
    """(lang, source, term, n, df): occurrences and documents, summed within slices of a batch."""
    for batch in batches:
        langs, sources = (batch.column(i).dictionary_encode() for i in (0, 1))
        group = langs.indices.to_numpy().astype(np.int64) * len(sources.dictionary) + sources.indices.to_numpy()
        data, at = _letters(batch.column(2))
        open_doc, open_terms = -1, set()               # the terms of a long text's earlier slices
        for first, last, lo, hi in _ranges(data, at):
            ends = np.clip(at[first:last + 2], lo, hi) - lo
            texts = pa.LargeStringArray.from_buffers(last - first + 1, pa.py_buffer(ends), pa.py_buffer(data[lo:hi]))
            cut = pc.ascii_split_whitespace(texts)
            doc = first + np.repeat(np.arange(last - first + 1), np.diff(cut.offsets.to_numpy()))
            words = cut.flatten().dictionary_encode()
            codes, terms = words.indices.to_numpy().astype(np.int64), words.dictionary
            real = pc.binary_length(terms).to_numpy() > 0
            doc, codes = doc[real[codes]], codes[real[codes]]
            pairs, n = np.unique(doc * len(terms) + codes, return_counts=True)
            doc, codes = pairs // max(len(terms), 1), pairs % max(len(terms), 1)
            new = np.ones(len(doc), bool)
            if at[first + 1] - at[first] > PIECE:      # count the text once per term
                names = terms.take(pa.array(codes)).to_pylist()
                if open_doc != first:
                    open_doc, open_terms = first, set()
                new = np.array([x not in open_terms for x in names], bool)
                open_terms.update(names)
            keys, where = np.unique(group[doc] * len(terms) + codes, return_inverse=True)
            of, codes = keys // max(len(terms), 1), keys % max(len(terms), 1)
            yield pa.RecordBatch.from_arrays([
                langs.dictionary.take(pa.array(of // len(sources.dictionary))),
                sources.dictionary.take(pa.array(of % len(sources.dictionary))),
                terms.take(pa.array(codes)).cast(pa.string()),
                pa.array(np.bincount(where, n, len(keys)).astype(np.int64)),
                pa.array(np.bincount(where, new, len(keys)).astype(np.int64))], ["lang", "source", "term", "n", "df"])


def _p(count: str, total: str, v: str) -> Column:
    """1 + floor(SCALE * (count + PRIOR) / (total + PRIOR * v)), exact."""
    return F.expr(f"1 + (CAST({SCALE} AS decimal(10,0)) * (CAST({count} AS decimal(19,0)) + {PRIOR})) "
                  f"div (CAST({total} AS decimal(19,0)) + CAST({PRIOR} AS decimal(1,0)) * CAST({v} AS decimal(18,0)))")


def _columns(batches):
    """Run-length encode (a, tile, lang_no, block, size, p0, cells): ends and values of the runs."""
    for batch in batches:
        ends, values = [], []
        for size, zero, cells in zip(batch.column(4).to_pylist(), batch.column(5).to_pylist(), batch.column(6)):
            dense = np.full(size, zero or 0, np.int64)
            if cells.is_valid and len(cells.values):
                at, p = cells.values.flatten()
                dense[at.to_numpy()] = p.to_numpy()
            stop = np.flatnonzero(np.diff(dense, append=dense[-1] + 1 if size else 0) != 0)[:size] + 1
            ends.append(stop.astype(np.int32))
            values.append(dense[stop - 1])
        yield pa.RecordBatch.from_arrays(
            [*batch.columns[:4], pa.array(ends, pa.list_(pa.int32())), pa.array(values, pa.list_(pa.int64()))],
            ["a", "tile", "lang_no", "block", "ends", "vals"])


def run_distance(ends_a: np.ndarray, a: np.ndarray, ends_b: np.ndarray, b: np.ndarray) -> int:
    """Sum of |a - b| over all places of two run-length columns of the same length."""
    stops = np.union1d(ends_a, ends_b)
    if not len(stops):
        return 0
    gap = np.abs(a[np.searchsorted(ends_a, stops)] - b[np.searchsorted(ends_b, stops)])
    return int((gap * np.diff(stops, prepend=0)).sum())


def _pairs(key, table):
    """All pairs of columns between two tiles of a block (or within one), a before b."""
    left, right = key[2].as_py(), key[3].as_py()
    rows = [(a, tile, np.asarray(e.values), np.asarray(v.values)) for a, tile, e, v in zip(
        table.column("a").to_pylist(), table.column("tile").to_pylist(), table.column("ends"), table.column("vals"))]
    out = [(x[0], y[0], run_distance(*x[2:], *y[2:])) for x in rows if x[1] == left
           for y in rows if y[1] == right and x[0] < y[0]]
    return pa.table({"a": pa.array([o[0] for o in out], pa.int64()), "b": pa.array([o[1] for o in out], pa.int64()),
                     "f": pa.array([o[2] for o in out], pa.int64())})


def _vocabulary(cells: DataFrame, groups: DataFrame) -> DataFrame:
    """Staged lang, term, total, at: the terms' places within their language, reordered."""
    w = Window.partitionBy("lang").orderBy(F.col("total").desc(), "source")
    lead = few(groups.select("lang", "source", "total", F.row_number().over(w).alias("slot"))
               .filter(F.col("slot") <= LEAD).drop("total"))
    counted = cells.join(lead, ["lang", "source"], "left").groupBy("lang", "term").agg(
        F.sum("n").alias("total"),
        F.array(*[F.coalesce(F.sum(F.when(F.col("slot") == i + 1, F.col("n"))), F.lit(0)) for i in range(LEAD)]).alias("lead"))
    placed = number_rows(counted, ["lang", "lead", "total", "term"])
    starts = few(placed.groupBy("lang").agg(F.min("row_no").alias("start")))
    return cut_lineage(placed.join(starts, "lang").select("lang", "term", "total", (F.col("row_no") - F.col("start")).alias("at")))


def audit(docs: DataFrame, min_docs: int = MIN_DOCS, top: int = TOP, text_col: str = "text", lang_col: str = "lang",
          source_col: str = "source") -> DataFrame:
    """lang, source, part, item, value, rank: distances to the other sources (`pair`), and the `top`
    terms in which a source exceeds its language (`term`)."""
    rows = narrow(docs, **{lang_col: "string", source_col: "string", text_col: "string"}).select(
        *[F.coalesce(F.col(c), F.lit("")).alias(n) for c, n in ((lang_col, "lang"), (source_col, "source"), (text_col, "text"))])
    counts = cut_lineage(rows.transform(in_arrow, _counts, "lang string, source string, term string, n bigint, df bigint", LARGE)
                         .groupBy("lang", "source", "term").agg(F.sum("n").alias("n"), F.sum("df").alias("df")))
    kept = cut_lineage(counts.groupBy("lang", "term").agg(F.sum("df").alias("df")).filter(F.col("df") >= min_docs)
                       .select("lang", "term"))
    cells = cut_lineage(counts.join(kept, ["lang", "term"]).select("lang", "source", "term", "n"))
    # one row per source: all that occur, with or without terms
    sums = cells.groupBy("lang", "source").agg(F.sum("n").alias("total"))
    groups = cut_lineage(rows.select("lang", "source").distinct().join(sums, ["lang", "source"], "left")
                         .withColumn("total", F.coalesce("total", F.lit(0))))
    vocab = _vocabulary(cells, groups)
    langs = cut_lineage(groups.groupBy("lang").agg(F.sum("total").alias("lang_total")).join(
        vocab.groupBy("lang").agg(F.count(F.lit(1)).alias("v")), "lang", "left").withColumn("v", F.coalesce("v", F.lit(0))))
    numbered = number_rows(groups, ["lang", "source"], "a")
    firsts = numbered.groupBy("lang").agg(F.min("a").alias("lang_no"), F.count(F.lit(1)).alias("n_sources"))
    groups = cut_lineage(numbered.join(firsts, "lang").join(langs, "lang").withColumn(
        "tile", F.expr(f"(a - lang_no) div {TILE}")))
    # p of the source and q of the language for every count; the join's other sides have one row per term and per source
    named = few(groups.select("lang", "source", "a", "lang_total", F.col("total").alias("group_total"), "v"))
    valued = cut_lineage(cells.join(vocab, ["lang", "term"]).join(named, ["lang", "source"]).select(
        "lang", "source", "a", "term", "at", _p("n", "group_total", "v").alias("p"),
        _p("total", "lang_total", "v").alias("q")))

    # a cell list is bounded by the block
    cell = F.struct(F.expr(f"CAST(at % {BLOCK} AS int)").alias("at"), "p")
    lists = valued.groupBy("a", F.expr(f"at div {BLOCK}").alias("block")).agg(F.collect_list(cell).alias("cells"))
    blocks = F.greatest(F.lit(0), F.expr(f"(v - 1) div {BLOCK}"))
    every = groups.filter("n_sources > 1").select(
        "a", "tile", "lang_no", "v", "n_sources", F.when(F.col("v") > 0, _p("0", "total", "v")).alias("p0"),
        F.explode(F.sequence(F.lit(0).cast("bigint"), blocks)).alias("block"))
    columns = every.join(lists, ["a", "block"], "left").select(
        "a", "tile", "lang_no", "block", F.least(F.lit(BLOCK), F.col("v") - F.col("block") * BLOCK).cast("int").alias("size"),
        "p0", "cells").transform(in_arrow, _columns, "a bigint, tile bigint, lang_no bigint, block bigint, ends array<int>, vals array<bigint>")
    tiles = groups.groupBy("lang_no").agg((F.max("tile") + 1).alias("n_tiles"))
    dealt = columns.join(tiles, "lang_no").select("*", F.explode(F.sequence(F.lit(0).cast("bigint"), F.col("n_tiles") - 1)).alias("other"))
    parts = (dealt.groupBy("lang_no", "block", F.least("tile", "other").alias("left"), F.greatest("tile", "other").alias("right"))
             .applyInArrow(_pairs, "a bigint, b bigint, f bigint"))
    sums = cut_lineage(parts.groupBy("a", "b").agg(F.sum("f").alias("value")))
    both = sums.unionByName(sums.select(F.col("b").alias("a"), F.col("a").alias("b"), "value"))
    names = few(groups.select("a", "lang", "source"))
    pair = (both.join(names, "a").join(names.select(F.col("a").alias("b"), F.col("source").alias("item")), "b")
            .select("lang", "source", F.lit("pair").alias("part"), "item", "value"))
    order = Window.partitionBy("lang", "source").orderBy(F.col("value").desc(), "item")
    term = valued.filter("p > q").select("lang", "source", F.lit("term").alias("part"), F.col("term").alias("item"),
                                         (F.col("p") - F.col("q")).alias("value"))
    return pair.withColumn("rank", F.row_number().over(order)).unionByName(
        term.withColumn("rank", F.row_number().over(order)).filter(F.col("rank") <= top))
