"""Merkle manifest of a dataset, with inclusion proofs, by cogrouped subtree exchange.

Leaves are hashed where the rows are read (no text is shuffled), ordered by a range sort and dealt
into superblocks of FANOUT**LEVELS consecutive leaves of a language.

Up: a superblock hands on only its top node; the tops are the next layer's nodes, until a language
has one node, its subroot. The subroots, in the order of the languages, are the nodes of a last
tree in the same way, its top is the root.

Down: a node's outer path (the siblings outside its superblock, level by level up to the root) is
known once its superblock's top has one. Layer by layer the nodes are cogrouped by superblock with
the top's outer path in `applyInPandas`; the task redoes the superblock's few levels and puts its
siblings before the outer ones. On the leaves' layer the same task finishes the proofs and folds
them: the leaf (or the tampered one) and its siblings are hashed up to the root. A task never
holds more than one superblock's rows and one outer path; a path has at most FANOUT - 1 siblings
a level.

Edge cases: NULL fields are hashed as `-`; a NULL id comes before all others of its language and is
never tampered with; a NULL language is a language of its own and comes first; rows that share
language and id are ordered by their leaves (equal rows have equal leaves, so each of them gets a
row and the result does not depend on their order); an empty table gives an empty result; other
columns are ignored.
"""

from __future__ import annotations

import hashlib

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.llm.common import cut_lineage, few, importable, narrow, number_rows

FANOUT, LEVELS = 8, 3
HEX = 64                      # characters of a digest
PATH = "places array<int>, siblings array<string>"


def digest(text: str) -> str:
    return hashlib.sha256(text.encode()).hexdigest()


def levels(nodes: list[str], n: int, high: int) -> list[list[str]]:
    """The nodes of a superblock and the levels above them: `high` of them, or, if the superblock is
    all of its tree's `n` nodes, as many as leave one."""
    out = [nodes]
    while len(out[-1]) > 1 if n <= FANOUT ** high else len(out) <= high:
        low = out[-1]
        out.append([digest("".join(low[i:i + FANOUT])) for i in range(0, len(low), FANOUT)])
    return out


def path(tree: list[list[str]], i: int) -> tuple[list[int], list[str]]:
    """Per level below the top: the node's place in its run, and the run's other nodes, joined."""
    places, siblings = [], []
    for level in tree[:-1]:
        lo = i - i % FANOUT
        places.append(i - lo)
        siblings.append("".join(level[lo:i] + level[i + 1:lo + FANOUT]))
        i //= FANOUT
    return places, siblings


def fold(node: str, places: list[int], siblings: list[str]) -> str:
    """The top that a node and the siblings on its way lead to."""
    for at, others in zip(places, siblings):
        node = digest(others[:at * HEX] + node + others[at * HEX:])
    return node


def _field(c: Column) -> Column:
    text = c.cast("string")
    return F.coalesce(F.concat(F.octet_length(text).cast("string"), F.lit(":"), text), F.lit("-"))


def lower_ascii(text: Column) -> Column:
    """A-Z lower-cased, all other characters as they are."""
    upper = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
    return F.when(F.octet_length(text) == F.char_length(text), F.lower(text)).otherwise(
        F.translate(text, upper, upper.lower()))


def leaves(docs: DataFrame) -> DataFrame:
    """Staged doc_id, lang, leaf, and changed: the leaf of the row with its text tampered with (NULL
    where it is not). Digests as 32 bytes."""
    rows = narrow(docs, doc_id="bigint", source="string", lang="string", n_chars="bigint", text="string")

    def leaf(text: Column) -> Column:
        return F.unhex(F.sha2(F.concat(*[_field(F.col(c)) for c in ("doc_id", "source", "lang", "n_chars")],
                                       _field(text)), 256))

    hit = F.col("text").isNotNull() & (F.crc32(F.col("doc_id").cast("string").cast("binary")) % 3 == 0)
    return cut_lineage(rows.select("doc_id", "lang", leaf(F.col("text")).alias("leaf"),
                                   F.when(hit, leaf(lower_ascii(F.col("text")))).alias("changed")))


def _block(high: int) -> Column:
    return F.expr(f"idx div {FANOUT ** high}").alias("block")


def _up(nodes: DataFrame, high: int) -> DataFrame:
    """The next layer: tree, idx, n, node. `nodes` has tree, idx, n (nodes of the tree in this
    layer) and node (32 bytes)."""
    def top(key, pdf):
        pdf = pdf.sort_values("idx")
        n = int(pdf["n"].iloc[0])
        node = levels([bytes(x).hex() for x in pdf["node"]], n, high)[-1][0]
        return pd.DataFrame({"tree": [key[0]], "idx": [key[1]], "n": [-(-n // FANOUT ** high)], "node": [bytes.fromhex(node)]})

    return cut_lineage(nodes.groupBy("tree", _block(high)).applyInPandas(
        top, "tree bigint, idx bigint, n bigint, node binary"))


def _layers(nodes: DataFrame, high: int) -> list[DataFrame]:
    """All layers of the trees, the last one with a node per tree."""
    most = nodes.agg(F.max("n")).first()[0] or 1
    out = [nodes]
    while most > 1:
        out.append(_up(out[-1], high))
        most = -(-most // FANOUT ** high)
    return out


def _down(nodes: DataFrame, outer: DataFrame, high: int) -> DataFrame:
    """(tree, idx, places, siblings) of the nodes; `outer` has those of the layer above."""
    def join(key, own, above):
        own = own.sort_values("idx")
        tree = levels([bytes(x).hex() for x in own["node"]], int(own["n"].iloc[0]), high)
        places, siblings = list(above["places"].iloc[0]), list(above["siblings"].iloc[0])
        paths = [path(tree, i) for i in range(len(own))]
        return pd.DataFrame({"tree": own["tree"].to_numpy(), "idx": own["idx"].to_numpy(),
                             "places": [p + places for p, _ in paths], "siblings": [s + siblings for _, s in paths]})

    return cut_lineage(nodes.groupBy("tree", _block(high)).cogroup(
        outer.withColumnRenamed("idx", "block").groupBy("tree", "block")).applyInPandas(
        join, f"tree bigint, idx bigint, {PATH}"))


def _finish(rows: DataFrame, outer: DataFrame, root: str, with_path: bool, high: int) -> DataFrame:
    """Proofs of the leaves joined with their superblocks' outer paths, and folded."""
    def prove(key, own, above):
        own = own.sort_values("idx")
        leaf = [bytes(x).hex() for x in own["node"]]
        tree = levels(leaf, int(own["n"].iloc[0]), high)
        up, outside = list(above["places"].iloc[0]), list(above["siblings"].iloc[0])
        tail = "".join(outside)
        proofs, folded, paths = [], [], []
        for i, (node, changed) in enumerate(zip(leaf, own["changed"])):
            places, siblings = path(tree, i)
            proofs.append(digest("".join(siblings) + tail))
            folded.append(fold(node if changed is None else bytes(changed).hex(), places + up, siblings + outside))
            paths.append((places + up, siblings + outside))
        out = {"doc_id": own["doc_id"].to_numpy(), "leaf": leaf,
               "subroot": above["subroot"].iloc[0], "root": root, "proof_sha256": proofs, "folded_root": folded,
               "verified": [x == root for x in folded]}
        if with_path:
            out |= {"places": [p for p, _ in paths], "siblings": [s for _, s in paths]}
        return pd.DataFrame(out)

    # ids pass as text: pandas has no integer column with NULLs
    schema = ("doc_id string, leaf string, subroot string, root string, proof_sha256 string, folded_root string, "
              "verified boolean" + f", {PATH}" * with_path)
    done = (rows.withColumn("doc_id", F.col("doc_id").cast("string")).groupBy("tree", _block(high))
            .cogroup(outer.groupBy("tree", "block")).applyInPandas(prove, schema))
    return done.withColumn("doc_id", F.col("doc_id").cast("bigint"))


def manifest(docs: DataFrame, with_path: bool = False, high: int = LEVELS) -> DataFrame:
    """doc_id, leaf, subroot, root, proof_sha256, folded_root, verified per row; `with_path` adds the
    proof itself: `places` and `siblings` per level, for `fold`. A superblock is `high` levels high."""
    spark = docs.sparkSession
    importable(spark)
    placed = number_rows(leaves(docs), ["lang", "doc_id", "leaf"])
    # one row per language
    trees = cut_lineage(number_rows(placed.groupBy("lang").agg(F.min("row_no").alias("start"), F.count(F.lit(1)).alias("n")),
                                    ["lang"], "tree"))
    named = few(trees)
    rows = cut_lineage(placed.join(named, placed["lang"].eqNullSafe(named["lang"])).select(
        "tree", (F.col("row_no") - F.col("start")).alias("idx"), "n", F.col("leaf").alias("node"), "doc_id", "changed"))
    layers = _layers(rows.select("tree", "idx", "n", "node"), high)
    subroots = layers[-1].select(F.col("tree").alias("idx"), "node")
    total = trees.count()
    if not total:
        return spark.createDataFrame([], _finish(rows, rows.select("tree", F.col("idx").alias("block")), "", with_path, high).schema)
    forest = _layers(subroots.select(F.lit(0).cast("bigint").alias("tree"), "idx", F.lit(total).cast("bigint").alias("n"), "node"), high)
    top = forest[-1].select(F.lower(F.hex("node")).alias("x"), "tree", "idx").first()       # one row
    none = spark.createDataFrame([(0, 0, [], [])], f"tree bigint, idx bigint, {PATH}")
    outer = none
    for layer in reversed(forest[:-1]):
        outer = _down(layer, outer, high)
    # a language's path starts at its subroot; its layers pass it down
    outer = outer.select(F.col("idx").alias("tree"), F.lit(0).cast("bigint").alias("idx"), "places", "siblings")
    for layer in reversed(layers[1:-1]):
        outer = _down(layer, outer, high)
    tops = few(subroots.select(F.col("idx").alias("tree"), F.lower(F.hex("node")).alias("subroot")))
    return _finish(rows, outer.withColumnRenamed("idx", "block").join(tops, "tree"), top["x"], with_path, high)
