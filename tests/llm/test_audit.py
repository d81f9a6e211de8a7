"""Divergence audit, Merkle manifest and line removal against brute force."""

import random

import duckdb
import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from tests.conftest import SF_SMALL
from tests.llm import brute
from tests.llm.test_operators import EDGE, PROSE, empty, frame, rows
from tidemark.llm import common, divergence, line_dedup, manifest

FIELDS = ["doc_id", "source", "lang", "n_chars", "text"]


@pytest.fixture(scope="module", autouse=True)
def workers(spark):
    common.importable(spark)


def table(spark, data):
    """(rows as tuples of FIELDS, frame with clashing columns)."""
    if data == "small":
        got = duckdb.sql(f"SELECT {', '.join(FIELDS)} FROM '{SF_SMALL}/documents.parquet'").fetchall()
    else:
        langs = ["en", None, "", "de", "é", "EN"]
        got = [(d, f"s{i % 3}" if i % 5 else None, langs[i % 6], len(t) if t and i % 2 else None, t)
               for i, (d, t) in enumerate(EDGE)]
        got += [got[0], got[0], got[7], (2**62 + 1, "s", "en", 2**60, "Big Id"), (-5, "s", "zz", 0, "ALONE")]
    df = spark.createDataFrame(got, "doc_id bigint, source string, lang string, n_chars bigint, text string")
    for c in ("a", "at", "n", "df", "p", "q", "tile", "block", "idx", "tree", "node", "leaf", "row", "doc", "place", "keep"):
        df = df.withColumn(c, F.lit("clash"))
    return got, df.repartition(5)


@pytest.mark.parametrize("data", ["small", "edge"])
def test_divergence(spark, data):
    got, df = table(spark, data)
    for least, top in ((30, 50), (2, 3)):
        want = brute.divergence([(r[4], r[2], r[1]) for r in got], least, top)
        found = sorted(map(tuple, divergence.audit(df, least, top).select("lang", "source", "part", "item", "value", "rank").collect()))
        assert found == want


def test_divergence_over_blocks_and_tiles(spark, monkeypatch):
    """Many blocks and tiles, a hot source, ties, and a language without any kept term."""
    rng = random.Random(3)
    docs = []
    for i in range(400):
        words = [f"{'abcdefghij'[int(rng.random() ** 2 * 10)]}{'klmnopqr'[rng.randrange(8)]}" for _ in range(rng.randrange(60))]
        docs.append((i, f"s{0 if i % 3 == 0 else rng.randrange(9)}", "en" if i % 4 else "de", None, " ".join(words)))
    docs += [(900 + i, f"t{i}", "xx", None, f"only{'abc'[i]} 123") for i in range(3)] + [(990, "one", "yy", None, None)]
    for name, value in (("BLOCK", 7), ("TILE", 2), ("LEAD", 2), ("PIECE", 50)):
        monkeypatch.setattr(divergence, name, value)
    df = spark.createDataFrame(docs, "doc_id bigint, source string, lang string, n_chars bigint, text string").repartition(4)
    found = sorted(map(tuple, divergence.audit(df, 5, 4).select("lang", "source", "part", "item", "value", "rank").collect()))
    assert found == brute.divergence([(r[4], r[2], r[1]) for r in docs], 5, 4)
    assert sum(r[0] == "xx" and r[2] == "pair" and r[4] == 0 for r in found) == 6
    assert divergence.audit(df.filter("false")).count() == 0


def test_terms_of_long_texts_in_slices(monkeypatch):
    """Slices of a text count it once per term; a term is never cut."""
    monkeypatch.setattr(divergence, "PIECE", 64)
    texts = ["short Words", "long " * 100 + "Word é" * 20, None, "", "x" * 300, "a b"]
    batch = pa.record_batch([pa.array(["en"] * 6), pa.array(["s"] * 3 + ["t"] * 3), pa.array(texts)], ["lang", "source", "text"])
    n, df = {}, {}
    for out in divergence._counts([batch]):
        for r in out.to_pylist():
            k = (r["source"], r["term"])
            n[k], df[k] = n.get(k, 0) + r["n"], df.get(k, 0) + r["df"]
    assert df == {k: 1 for k in df} and n["s", "long"] == 100 and n["t", "x" * 300] == 1
    assert {k for k in n if k[0] == "s"} == {("s", w) for t in texts[:3] for w in brute.TERM.findall(brute.lower(t or ""))}


def test_run_distance_equals_dense_columns():
    rng = np.random.default_rng(1)
    for size in (0, 1, 5, 200):
        dense = [np.repeat(rng.integers(0, 4, size), rng.integers(1, 4, size))[:size] for _ in range(2)]
        runs = []
        for d in dense:
            ends = np.flatnonzero(np.diff(d, append=d[-1] + 1 if size else 0) != 0)[:size] + 1
            runs += [ends, d[ends - 1]]
        assert divergence.run_distance(*runs) == int(np.abs(dense[0] - dense[1]).sum())


@pytest.mark.parametrize("data", ["small", "edge"])
def test_manifest(spark, data):
    got, df = table(spark, data)
    assert rows(manifest.manifest(df)) == brute.merkle(got)
    assert manifest.manifest(df.filter("false")).count() == 0


def test_manifest_over_several_superblocks(spark):
    """Superblocks of 8 leaves: four layers in the hot language, one in a small one; proofs lead to the root."""
    docs = [(i, "s", "en" if i < 530 else f"l{i % 11}", i, f"Text {i}" if i % 7 else "same TEXT") for i in range(600)]
    df = spark.createDataFrame(docs, "doc_id bigint, source string, lang string, n_chars bigint, text string").repartition(6)
    found = manifest.manifest(df, with_path=True, high=1).collect()
    assert sorted([tuple(r)[:7] for r in found], key=str) == brute.merkle(docs)
    assert all(manifest.fold(r["leaf"], r["places"], r["siblings"]) == r["root"] for r in found)
    assert {len(r["places"]) for r in found if r["doc_id"] < 530} == {6}      # 530 -> 67 -> 9 -> 2 -> 1, and 12 -> 2 -> 1


def test_a_changed_row_changes_the_root(spark):
    got, df = table(spark, "edge")
    root = {r["root"] for r in manifest.manifest(df).collect()}
    for column, value in (("text", "other"), ("n_chars", "7"), ("source", "x"), ("lang", "de")):
        one = df.withColumn(column, F.when(F.col("doc_id") == 6, F.lit(value)).otherwise(F.col(column)))
        assert {r["root"] for r in manifest.manifest(one).collect()} != root, column


@pytest.mark.parametrize("data", ["small", "edge"])
def test_line_dedup(spark, data):
    got, df = table(spark, data)
    docs = [(r[0], r[4]) for r in got]
    found = line_dedup.remove(df)
    assert rows(found, "doc_id", "n_lines", "n_dropped", "kept_sha256") == brute.line_dedup(docs)
    assert line_dedup.remove(empty(spark)).count() == 0


def test_line_dedup_cases(spark):
    """Stripping and cases, short keys, repeats within a document, repeated ids with unlike texts, NULL ids."""
    docs = [(1, "One long line\nshort\n\n"), (2, "\t one LONG line \r\nshort\nown line of two\nown line of two"),
            (3, "own line of two"), (3, "other text\nOWN line of two\n" + "é" * 9), (4, "é" * 9 + "\n" + "é" * 10),
            (5, "É" * 10 + "\n" + "é" * 10), (None, "One long line\nnull line one"), (None, "null line one"),
            (6, "\n".join(["a hot line here"] * 3)), (7, "a hot line here\n" + PROSE), (7, "a hot line here\n" + PROSE), (8, PROSE)]
    found = line_dedup.remove(frame(spark, docs))
    assert rows(found, "doc_id", "n_lines", "n_dropped", "kept_sha256") == brute.line_dedup(docs)
    texts = {r["doc_id"]: r["kept_text"] for r in found.collect()}
    assert texts[2] == "short\nown line of two\nown line of two" and texts[1] is None and texts[8] == ""


@pytest.mark.parametrize("partitions", [1, 40])
def test_line_dedup_hot_line_over_partitions(spark, partitions):
    """A line in every document is dealt over many range partitions; its first document is found all the same."""
    rng = random.Random(5)
    docs = [(i * 3 + 100, "\n".join(["the one hot line"] * rng.randrange(1, 4) + [f"own line {i % 50} of the text"] * (i % 3)))
            for i in range(500)]
    spark.conf.set("spark.sql.shuffle.partitions", partitions)
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        df = frame(spark, docs, 7)
        kept = line_dedup.bitmaps(df).collect()
        assert rows(line_dedup.remove(df), "doc_id", "n_lines", "n_dropped", "kept_sha256") == brute.line_dedup(docs)
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", 8)
        spark.conf.unset("spark.sql.adaptive.coalescePartitions.enabled")
    assert all(int(line_dedup.kept_lines(r["keep"], r["n_lines"]).sum()) == r["n_lines"] - r["n_dropped"] for r in kept)
    assert 100 not in {r["doc"] for r in kept} and len(kept) == 499


def test_line_dedup_with_many_bitmaps(spark, monkeypatch):
    """Beyond the broadcast bound the join shuffles, with the same result."""
    got, df = table(spark, "small")
    monkeypatch.setattr(common, "BROADCAST_SIZE", -1)
    assert rows(line_dedup.remove(df), "doc_id", "n_lines", "n_dropped", "kept_sha256") == brute.line_dedup([(r[0], r[4]) for r in got])
