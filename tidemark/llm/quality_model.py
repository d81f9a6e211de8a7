"""Quality classifier as a sparse rule ensemble.

Shallow trees are grown on labelled rows over text statistics; every path from a root to an inner
node or leaf is a conjunctive rule; a lasso logistic regression over the rules (as 0/1 columns)
keeps a few of them; and the kept rules become one Spark column expression, so scoring is a
projection over the statistics without Python.

The trees and weights are fitted on at most MAX_ROWS labelled rows (those with the smallest
hashes of the id) whose id is not held out; statistics and scores cover all documents.

Edge cases: a NULL or empty text has zero statistics and is scored by them; without labelled rows,
or with labels of one class only, the score is the share of good labels (0.5 if there is none);
repeated rows and NULL ids give a result row each (NULL ids are not held out); labels for unknown
documents are not used; an empty table gives an empty result; other columns are ignored.
"""

from __future__ import annotations

import re

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.llm.common import cut_lineage, smallest
from tidemark.llm.quality_rules import statistics

MAX_ROWS = 20_000
TREES, DEPTH = 24, 3
LASSO = 0.002
THRESHOLD = 0.7

#: the statistics rules are made of, as SQL over the columns of `statistics`
STATS = {
    "log_words": "ln(1 + n_words)",
    "word_length": "word_chars / greatest(n_words, 1)",
    "symbols": "n_symbols / greatest(word_chars, 1)",
    "bangs": "n_bangs / greatest(word_chars, 1)",
    "upper": "n_upper / greatest(word_chars, 1)",
    "dup_lines": "n_dup_lines / greatest(n_lines, 1)",
    "repeats": "n_repeat_words / greatest(n_words, 1)",
    "line_words": "n_words / greatest(n_lines, 1)",
    "distinct": "n_distinct / greatest(n_words, 1)",
    "digits": "n_digits / greatest(word_chars, 1)",
    "stops": "n_stops / greatest(n_words, 1)",
    "pipes": "n_pipes / greatest(n_words, 1)",
}


def held_out(doc_id: Column) -> Column:
    return F.coalesce(F.crc32(doc_id.cast("string").cast("binary")) % 4 == 2, F.lit(False))


def paths(tree: str) -> set[tuple[tuple[int, bool, float], ...]]:
    """Conditions (statistic, at most?, threshold) of every path in a printed tree, by indent."""
    out, stack = set(), []
    for line in tree.splitlines():
        m = re.match(r"(\s+)(?:If|Else) \(feature (\d+) (<=|>) ([-+.\deE]+)\)", line)
        if m:
            depth = len(m[1])
            stack = [x for x in stack if x[0] < depth] + [(depth, (int(m[2]), m[3] == "<=", float(m[4])))]
            out.add(tuple(sorted(c for _, c in stack)))
    return out


def condition(rule) -> str:
    names = list(STATS)
    return " AND ".join(f"{names[f]} {'<=' if low else '>'} {cut!r}D" for f, low, cut in rule)


def fit(rows: DataFrame, label: str, seed: int = 7) -> tuple[float, list[tuple[float, str]]]:
    """Intercept and (weight, condition) of the rules kept. `rows` has the STATS and the label."""
    from pyspark.ml.classification import LogisticRegression, RandomForestClassifier
    from pyspark.ml.feature import VectorAssembler

    rows = cut_lineage(rows)
    counts = {r["y"]: r["n"] for r in rows.groupBy(F.col(label).alias("y")).agg(F.count(F.lit(1)).alias("n")).collect()}
    if len(counts) < 2:
        share = counts.get(1, 0) / sum(counts.values()) if counts else 0.5
        return {0.0: -20.0, 1.0: 20.0}.get(share, 0.0), []
    table = VectorAssembler(inputCols=list(STATS), outputCol="x").transform(
        rows.withColumn("y", F.col(label).cast("double")))
    forest = RandomForestClassifier(featuresCol="x", labelCol="y", numTrees=TREES, maxDepth=DEPTH, maxBins=64,
                                    featureSubsetStrategy="onethird", subsamplingRate=0.7, seed=seed).fit(table)
    rules = sorted(set().union(*[paths(t.toDebugString) for t in forest.trees]))
    flags = rows.select(F.col(label).cast("double").alias("y"),
                        *[F.expr(f"CAST({condition(r)} AS DOUBLE)").alias(f"r{i}") for i, r in enumerate(rules)])
    flags = VectorAssembler(inputCols=flags.columns[1:], outputCol="x").transform(flags).select("x", "y")
    model = LogisticRegression(featuresCol="x", labelCol="y", elasticNetParam=1.0, regParam=LASSO, maxIter=100,
                               standardization=True).fit(flags)
    weights = model.coefficients.toArray().tolist()
    return float(model.intercept), [(w, condition(r)) for w, r in zip(weights, rules) if w]


def compiled(intercept: float, rules: list[tuple[float, str]]) -> Column:
    """The score as a Column over STATS."""
    total = F.lit(intercept)
    for weight, test in rules:
        total = total + F.when(F.expr(test), F.lit(weight)).otherwise(F.lit(0.0))
    return 1 / (1 + F.exp(-total))


def score(docs: DataFrame, labels: DataFrame, max_rows: int = MAX_ROWS, threshold: float = THRESHOLD,
          label: str = "quality", id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """doc_id, held_out, score, predicted."""
    stats = cut_lineage(statistics(docs, id_col, text_col, more=True).select(
        "doc_id", *[F.coalesce(F.expr(e).cast("double"), F.lit(0.0)).alias(n) for n, e in STATS.items()]))
    known = (labels.select(F.col(f"`{id_col}`").cast("bigint").alias("doc_id"), F.col(f"`{label}`").cast("int").alias("_y"))
             .filter(F.col("_y").isin(0, 1) & ~held_out(F.col("doc_id"))))
    rows = cut_lineage(stats.join(known, "doc_id"))
    chosen = smallest(rows, F.xxhash64("doc_id"), max_rows, rows.count(), *stats.columns, "_y")
    intercept, rules = fit(chosen.drop("doc_id"), "_y")
    value = compiled(intercept, rules)
    return stats.select("doc_id", held_out(F.col("doc_id")).alias("held_out"), value.alias("score")).withColumn(
        "predicted", (F.col("score") >= threshold).cast("int"))
