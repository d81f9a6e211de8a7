"""The registered queries against DuckDB, and the pipeline against the operators one by one."""

import duckdb
import pytest

import corpus_pipeline
from tests.conftest import SF_SMALL
from tests.llm import brute
from tests.llm.test_operators import EDGE, frame
from tidemark.llm import decontaminate, queries, sql

TABLES = ["documents", "benchmark", "labels"]


@pytest.mark.parametrize("name", sorted(queries.ORACLES))
def test_oracle(spark, name):
    con = duckdb.connect()
    for t in TABLES:
        con.sql(f"CREATE VIEW {t} AS SELECT * FROM '{SF_SMALL}/{t}.parquet'")
    want = con.sql(queries.ORACLES[name])
    got = queries.QUERIES[name](spark, SF_SMALL)
    assert sorted(got.columns) == sorted(want.columns)
    cols = sorted(got.columns)
    assert sorted((tuple(r[c] for c in cols) for r in got.collect()), key=str) == sorted(
        want.select(", ".join(cols)).fetchall(), key=str)


def test_proximity_counts_equal_sql(spark):
    """n_near of the report against its SQL, over the whole small table."""
    con = duckdb.connect()
    for t in TABLES:
        con.sql(f"CREATE VIEW {t} AS SELECT * FROM '{SF_SMALL}/{t}.parquet'")
    docs, items = (spark.read.parquet(f"{SF_SMALL}/{t}.parquet") for t in ("documents", "benchmark"))
    got = sorted(map(tuple, decontaminate.report(docs, items, near=True).select("doc_id", "n_items", "n_near").collect()))
    assert got == sorted(con.sql(f"SELECT doc_id, n_items, n_near FROM ({sql.proximity()})").fetchall())
    assert sum(n for _, _, n in got) > 0


def test_every_operator_is_registered():
    assert sorted(int(n[2:].split("_")[0]) for n in queries.QUERIES) == list(range(1, 14))


def test_pipeline(spark):
    docs = spark.read.parquet(f"{SF_SMALL}/documents.parquet")
    items = duckdb.sql(f"SELECT item_id, text FROM '{SF_SMALL}/benchmark.parquet'").fetchall()
    columns, before = docs.columns, [(r["doc_id"], r["text"]) for r in docs.collect()]
    stages = dict(corpus_pipeline.STAGES)
    assert list(stages) == ["quality rules", "near-duplicates", "benchmark contamination", "secrets", "packing"]
    for name, stage in corpus_pipeline.STAGES[:-1]:
        out = stage(spark, docs, SF_SMALL)
        assert out.columns == columns, name
        docs = corpus_pipeline.cut_lineage(out)
        after = [(r["doc_id"], r["text"]) for r in docs.collect()]
        if name == "quality rules":
            assert {d for d, t in before if not brute.quality(t)[-1]} >= {d for d, _ in after}
        elif name == "near-duplicates":
            groups = brute.near(before)
            assert sorted(d for d, _ in after) == sorted(d for d, (n, c) in groups.items() if d == c)
        elif name == "benchmark contamination":
            assert sorted(after) == sorted((d, t) for d, t in before if not brute.contamination(t, items)[-1])
        else:
            assert sorted(d for d, _ in after) == sorted(d for d, _ in before)
            assert all(brute.secrets(t)[:3] == (0, 0, 0) for _, t in after)
        before = after
    whole = corpus_pipeline.run(spark, SF_SMALL)
    assert {r["doc_id"] for r in whole.select("doc_id").distinct().collect()} == {d for d, _ in before}
    step = stages["packing"](spark, docs, SF_SMALL)
    cols = ["doc_id", "piece", "start", "length", "ids_crc32"]
    assert sorted(map(tuple, whole.select(cols).collect())) == sorted(map(tuple, step.select(cols).collect()))


def test_pipeline_edge_cases(spark, tmp_path):
    """NULLs in every column, empty and very long texts, repeated rows, clashing columns, and empty tables."""
    long = " ".join(f"word{i % 9973} of{i % 7}" for i in range(60_000))
    rows = [(d, t, None if i % 3 else "en", None if i % 4 else "s", None) for i, (d, t) in enumerate(EDGE)]
    rows += [(500, long, "en", "s", len(long)), (None, long, None, None, None), (500, long, "en", "s", len(long))]
    docs = frame(spark, [r[:2] for r in rows])
    for name, table in (("full", docs), ("none", docs.filter("false"))):
        folder = tmp_path / name
        table.write.parquet(str(folder / "documents.parquet"))
        spark.createDataFrame([("b", "unrelated benchmark words that no document holds at all, not even one of them here")],
                              "item_id string, text string").write.parquet(str(folder / "benchmark.parquet"))
        out = corpus_pipeline.run(spark, str(folder)).collect()
        if name == "none":
            assert out == []
        else:
            ids = {r["doc_id"] for r in out}
            assert 500 in ids and ids <= {d for d, *_ in rows}
            whole = {(r["doc_id"], r["piece"]) for r in out}
            assert len(whole) == len(out) and sum(r["length"] for r in out if r["doc_id"] == 500) > 100_000
            places = sorted((r["sequence_id"], r["offset"], r["length"]) for r in out)
            assert all(o + n <= 1024 and (a != s or o + n == p) for (s, o, n), (a, p, _) in zip(places, places[1:]))
