"""Near-duplicates by MinHash with sequential Bayesian verification.

1. Every text gets the set of its distinct 5-word shingles (64-bit hashes), a key of the set and
   a signature of BANDS * ROWS minimum hashes. Rows with the same set form a class; only classes
   are compared.
2. Classes that agree in a band share a bucket. Within a bucket, pairs are compared batch by batch
   of signature rows; after each batch a pair is dropped if, by its matches so far, the posterior
   probability of a similarity of THRESHOLD or more is below MISS.
3. Buckets hand on a spanning forest of the surviving pairs, most similar first, not all of them;
   the forest's pairs are verified on the full shingle sets and the links give first components.
4. Buckets that still hold several components get their members' full sets, and every surviving
   pair between components is verified inside the bucket, so no link that would join two
   components is left out; only links that do join some are handed on. The components of all
   links are the result.

A bucket of more than BLOCK classes is split into blocks, and each pair of blocks is compared in a
task of its own; no pair is emitted that the signatures rule out. Chance of missing a link at
the threshold: (1 - 0.85**ROWS)**BANDS, about 1e-5, plus MISS per batch.

Edge cases: a text with fewer than five words is one shingle; a text without words (or NULL) has
no shingles, is linked with nothing and is its own component; rows with the same text are one
class but keep a result row each; NULL ids: such rows take part, the component is named by the
smallest id that is not NULL (NULL if there is none), and they are kept only in that case; an
empty table gives an empty result; other columns are ignored by `groups`, carried by `keep_one`.
"""

from __future__ import annotations

import hashlib
import math

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.llm.common import (
    components, cut_lineage, few, in_arrow, mix64, narrow, packed, text_key, unpacked, window_hashes, word_hashes,
)
from tidemark.llm.substring_dedup import _texts

SHINGLE, THRESHOLD = 5, 0.85
ROWS, BANDS, BATCH = 6, 24, 24
HASHES = ROWS * BANDS
MISS = 1e-6
BLOCK = 512
PAIRS = 1 << 16             # pairs compared at once in a task
BROADCAST_ROWS = 200_000


def shingles(data: np.ndarray, k: int = SHINGLE) -> np.ndarray:
    """Sorted distinct shingle hashes of a text's UTF-8 bytes, A-Z lower-cased."""
    words = word_hashes(data, lower=True)[0]
    if len(words) == 0:
        return words
    return np.unique(window_hashes(words, min(k, len(words))))


def _family(n: int):
    x = mix64(np.arange(1, 2 * n + 1, dtype=np.uint64) * np.uint64(0xA0761D6478BD642F))
    return x[:n], x[n:] | np.uint64(1)


_XOR, _MUL = _family(HASHES)


def signature(s: np.ndarray) -> np.ndarray:
    """16 bits of each of HASHES minimum hashes; the set is taken in slices of bounded size."""
    low = np.full(HASHES, np.uint64(0xFFFFFFFFFFFFFFFF))
    for i in range(0, len(s), 1024):
        np.minimum(low, ((s[i:i + 1024, None] ^ _XOR) * _MUL).min(0), out=low)
    return (mix64(low) >> np.uint64(48)).astype(np.uint16)


def _features(batches):
    for batch in batches:
        n, keys, sigs = [], [], []
        for data in _texts(batch.column(2)):
            s = shingles(data)
            n.append(len(s))
            keys.append(hashlib.blake2b(s.tobytes(), digest_size=16).digest() if len(s) else None)
            sigs.append(signature(s).tobytes() if len(s) else None)
        yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), pa.array(n, pa.int64()),
                                          pa.array(keys, pa.binary()), pa.array(sigs, pa.binary())],
                                         ["tkey", "doc_id", "n_shingles", "key", "sig"])


def _fixed(column: pa.Array, width: int, dtype) -> np.ndarray:
    """A binary column without NULLs whose values all have `width` bytes, as a matrix."""
    return np.frombuffer(b"".join(column.to_pylist()), dtype).reshape(len(column), width // np.dtype(dtype).itemsize)


def _bands(batches):
    for batch in batches:
        sig = _fixed(batch.column(1), 2 * HASHES, np.uint16).astype(np.uint64).reshape(-1, BANDS, ROWS)
        h = np.broadcast_to(np.arange(1, BANDS + 1, dtype=np.uint64), sig.shape[:2]).copy()
        for i in range(ROWS):
            h = mix64(h * np.uint64(0x9FB21C651E98DF25) + sig[:, :, i])
        yield pa.RecordBatch.from_arrays([
            pa.array(h.reshape(-1).view(np.int64), pa.int64()), batch.column(0).take(pa.array(
                np.repeat(np.arange(len(sig)), BANDS)))], ["band", "key"])


def least_matches(threshold: float, miss: float, batch: int = BATCH) -> list[tuple[int, int]]:
    """(hashes compared, least matches to go on): with a uniform prior the posterior after m
    matches of n is Beta(m+1, n-m+1), and its tail beyond t is a binomial sum."""
    out = []
    for n in range(batch, HASHES + 1, batch):
        def tail(m, n=n):
            return sum(math.comb(n + 1, j) * threshold ** j * (1 - threshold) ** (n + 1 - j) for j in range(m + 1))
        out.append((n, next(m for m in range(n + 1) if tail(m) >= miss)))
    return out


def _holds(x: np.ndarray, y: np.ndarray, percent: int) -> bool:
    """100 * |x n y| >= percent * |x u y| for sorted distinct hashes."""
    both = len(np.intersect1d(x, y, assume_unique=True))
    return 100 * both >= percent * (len(x) + len(y) - both)


def _bucket_pairs(threshold: float, miss: float, forest: bool):
    """Rows sorted by bucket (band, lo, hi) with side, key, n, sig and comp -> pairs (a, b): a
    spanning forest of the pairs that survive the signatures, or (`forest` off, rows with the
    full set) links that join components."""
    steps = least_matches(threshold, miss)
    percent = round(threshold * 100)

    def survivors(g, alone, side, n, comp, sig):
        out, held, size = [], [], 0

        def sift():
            i, j = (np.concatenate([h[x] for h in held]) for x in (0, 1))
            hits = np.zeros(len(i), np.int32)
            done = 0
            for upto, least in steps:
                hits += (sig[i, done:upto] == sig[j, done:upto]).sum(1, dtype=np.int32)
                go = hits >= least
                i, j, hits, done = i[go], j[go], hits[go], upto
            out.append((i, j, hits))

        for d in range(1, len(g)):
            i = np.flatnonzero(g[:-d] == g[d:])
            if not len(i):
                break
            j = i + d
            low, high = np.minimum(n[i], n[j]), np.maximum(n[i], n[j])
            ok = (alone[i] | (side[i] != side[j])) & (comp[i] != comp[j]) & (100 * low >= percent * high)
            if ok.any():
                held.append((i[ok], j[ok]))
                size += int(ok.sum())
            if size >= PAIRS:
                sift()
                held, size = [], 0
        if held:
            sift()
        if not out:
            return np.zeros(0, int), np.zeros(0, int), np.zeros(0, int)
        return tuple(np.concatenate([o[x] for o in out]) for x in range(3))

    def joining(i, j, hits, label, ok):
        """Pairs, most matches first, that pass `ok` and join two sets of labels."""
        root: dict[int, int] = {}

        def find(x):
            while root.get(x, x) != x:
                root[x] = x = root.get(root[x], root[x])
            return x

        pick = []
        order = np.argsort(-hits, kind="stable")
        for k, x, y in zip(order.tolist(), i[order].tolist(), j[order].tolist()):
            a, b = find(label[x]), find(label[y])
            if a != b and ok(x, y):
                root[a] = b
                pick.append(k)
        return i[pick], j[pick]

    def work(table: pa.Table):
        col = {c: table.column(c).combine_chunks() for c in table.column_names}
        ids = np.stack([col[c].to_numpy() for c in ("band", "lo", "hi")])
        g = np.concatenate([[0], np.cumsum((ids[:, 1:] != ids[:, :-1]).any(0))])
        comp = col["comp"].to_pylist()
        number = {c: i for i, c in enumerate(dict.fromkeys(comp))}
        comp = [number[c] for c in comp]
        i, j, hits = survivors(g, ids[1] == ids[2], col["side"].to_numpy(), col["n"].to_numpy(),
                               np.array(comp), _fixed(col["sig"], 2 * HASHES, np.uint16))
        if forest:          # each bucket by itself: its forest does not lean on the other buckets' pairs
            label = list(range(len(comp)))
            i, j = joining(i, j, hits, label, lambda x, y: True)
        else:
            sets: dict[int, np.ndarray] = {}

            def full(x):
                if x not in sets:
                    sets[x] = np.frombuffer(col["set"][x].as_py(), np.uint64)
                return sets[x]

            i, j = joining(i, j, hits, comp, lambda x, y: _holds(full(x), full(y), percent))
        keys = col["key"]
        return pa.RecordBatch.from_arrays([keys.take(pa.array(i)), keys.take(pa.array(j))], ["a", "b"])

    def run(batches):
        held: list[pa.RecordBatch] = []
        for batch in batches:
            held.append(batch)
            table = pa.Table.from_batches(held)
            last = tuple(table.column(c)[-1].as_py() for c in ("band", "lo", "hi"))
            ids = np.stack([table.column(c).to_numpy() for c in ("band", "lo", "hi")])
            cut = int(np.flatnonzero((ids != np.array(last)[:, None]).any(0))[-1]) + 1 \
                if (ids != np.array(last)[:, None]).any() else 0
            if cut:                                  # the last bucket may go on in the next batch
                yield work(table.slice(0, cut))
                held = table.slice(cut).combine_chunks().to_batches()
        if held:
            yield work(pa.Table.from_batches(held))
    return run


def _members(classes: DataFrame) -> DataFrame:
    """Staged (band, lo, hi, side, key): the buckets with several classes, in blocks."""
    bands = classes.select("key", "sig").transform(in_arrow, _bands, "band bigint, key binary")
    # staged, so the join with it has shuffles on both sides and a hot bucket can be split
    sizes = cut_lineage(bands.groupBy("band").agg(F.count(F.lit(1)).alias("m")).filter("m > 1"))
    blocks = F.ceil(F.col("m") / BLOCK)
    mine = F.pmod(F.xxhash64("key"), blocks)
    rows = bands.join(sizes, "band").select("band", "key", mine.alias("mine"), F.explode(
        F.sequence(F.lit(0).cast("bigint"), blocks - 1)).alias("other"))
    return cut_lineage(rows.select("band", F.least("mine", "other").alias("lo"), F.greatest("mine", "other").alias("hi"),
                                   (F.col("mine") > F.col("other")).cast("int").alias("side"), "key"))


def _in_buckets(rows: DataFrame, threshold: float, miss: float, forest: bool) -> DataFrame:
    """Distinct pairs (a, b), a < b, that the buckets hand on."""
    pairs = (rows.repartition("band", "lo", "hi").sortWithinPartitions("band", "lo", "hi")
             .transform(in_arrow, _bucket_pairs(threshold, miss, forest), "a binary, b binary"))
    return pairs.select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")).distinct()


def _candidates(members: DataFrame, classes: DataFrame, threshold: float, miss: float) -> DataFrame:
    """The buckets' spanning forests."""
    rows = members.join(classes.select("key", "n", "sig"), "key").select(
        "band", "lo", "hi", "side", "key", "n", "sig", F.col("key").alias("comp"))
    return _in_buckets(rows, threshold, miss, True)


def _between(members: DataFrame, classes: DataFrame, comp: DataFrame, rows: DataFrame, threshold: float,
             miss: float) -> DataFrame:
    """Staged links between components (`comp`: key, comp), from the buckets that hold several."""
    labelled = members.join(comp, "key")
    open_ = cut_lineage(labelled.groupBy("band", "lo", "hi").agg(F.min("comp").alias("x"), F.max("comp").alias("y"))
                        .filter("x <> y").select("band", "lo", "hi"))
    inside = cut_lineage(labelled.join(open_, ["band", "lo", "hi"]))
    texts = _texts_of(inside.select("key").distinct(), classes, rows)
    sets = texts.transform(in_arrow, _set_of, "key binary, set binary")
    full = (inside.join(classes.select("key", "n", "sig"), "key").join(cut_lineage(sets), "key")
            .select("band", "lo", "hi", "side", "key", "n", "sig", "comp", "set"))
    return cut_lineage(_in_buckets(full, threshold, miss, False))


def _keyed(batches):
    for batch in batches:
        keys = []
        for data in _texts(batch.column(0)):
            s = shingles(data)
            keys.append(hashlib.blake2b(s.tobytes(), digest_size=16).digest() if len(s) else b"")
        yield pa.RecordBatch.from_arrays([pa.array(keys, pa.binary()), batch.column(0)], ["key", "text"])


def _verify(percent: int):
    """Pairs with 100 * |A n B| >= percent * |A u B| on the full sets."""
    def run(batches):
        last_key, last = None, None
        for batch in batches:
            ok = []
            for key, x, y in zip(batch.column(0).to_pylist(), _texts(batch.column(2)), _texts(batch.column(3))):
                if key != last_key:
                    last_key, last = key, shingles(x)
                ok.append(_holds(last, shingles(y), percent))
            yield batch.select(["a", "b"]).filter(pa.array(ok, pa.bool_()))
    return run


def _set_of(batches):
    for batch in batches:
        yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(
            [shingles(data).tobytes() for data in _texts(batch.column(1))], pa.binary())], ["key", "set"])


def _texts_of(keys: DataFrame, classes: DataFrame, rows: DataFrame) -> DataFrame:
    """Staged (key, text): one text of each class in `keys`. The ids of the classes' smallest
    documents go to the scan if they are measured to be few; beyond that the join shuffles."""
    ids = few(keys.join(classes, "key").select(F.col("rep").alias("doc_id")).distinct(), BROADCAST_ROWS)
    found = rows.join(ids, rows["doc_id"].eqNullSafe(ids["doc_id"]), "left_semi")
    return cut_lineage(found.select("text").transform(in_arrow, _keyed, "key binary, text string")
                       .join(keys, "key", "left_semi").dropDuplicates(["key"]))


def _links(pairs: DataFrame, classes: DataFrame, rows: DataFrame, threshold: float) -> DataFrame:
    """The pairs that hold on the full shingle sets, staged."""
    ends = pairs.select(F.col("a").alias("key")).unionByName(pairs.select(F.col("b").alias("key"))).distinct()
    texts = _texts_of(ends, classes, rows)
    both = (pairs.join(texts.select(F.col("key").alias("a"), F.col("text").alias("ta")), "a")
            .join(texts.select(F.col("key").alias("b"), F.col("text").alias("tb")), "b"))
    return cut_lineage(both.select("a", "b", "ta", "tb").transform(in_arrow, _verify(round(100 * threshold)),
                                                                    "a binary, b binary"))


def _grouped(rows: DataFrame, threshold: float, miss: float) -> DataFrame:
    """Staged tkey, doc_id, n_shingles, root (of the class's component; NULL without shingles)
    and component_id. `rows` has tkey (binary, may be NULL), doc_id and text."""
    feats = cut_lineage(rows.select("tkey", "doc_id", "text").transform(in_arrow, 
        _features, "tkey binary, doc_id bigint, n_shingles bigint, key binary, sig binary"))
    classes = cut_lineage(feats.filter(F.col("key").isNotNull()).groupBy("key").agg(
        F.min("doc_id").alias("rep"), F.first("n_shingles").alias("n"), F.first("sig").alias("sig")))
    members = _members(classes)
    pairs = cut_lineage(_candidates(members, classes, threshold, miss))
    found = cut_lineage(components(_links(pairs, classes, rows, threshold)))
    comp = classes.select("key").join(found.withColumnRenamed("node", "key"), "key", "left").select(
        "key", F.coalesce("root", "key").alias("comp"))
    more = _between(members, classes, comp, rows, threshold, miss)
    if more.limit(1).count():
        found = cut_lineage(components(
            more.unionByName(found.select(F.col("node").alias("a"), F.col("root").alias("b")))))
    named = classes.select("key", "rep").join(found.withColumnRenamed("node", "key"), "key", "left").select(
        "key", "rep", F.coalesce("root", "key").alias("root"))
    names = named.groupBy("root").agg(F.min("rep").alias("component_id"))
    of = cut_lineage(named.select("key", "root").join(names, "root").select("key", "root", "component_id"))
    return cut_lineage(feats.select("tkey", "doc_id", "n_shingles", "key").join(of, "key", "left").select(
        "tkey", "doc_id", "n_shingles", "root",
        F.when(F.col("key").isNull(), F.col("doc_id")).otherwise(F.col("component_id")).alias("component_id")))


def groups(docs: DataFrame, threshold: float = THRESHOLD, miss: float = MISS, id_col: str = "doc_id",
           text_col: str = "text") -> DataFrame:
    """doc_id, n_shingles, component_id, kept."""
    rows = narrow(docs, **{id_col: "bigint", text_col: "string"}).select(
        F.lit(None).cast("binary").alias("tkey"), F.col(id_col).alias("doc_id"),
        F.coalesce(F.col(text_col), F.lit("")).alias("text"))
    return _grouped(rows, threshold, miss).select(
        "doc_id", "n_shingles", "component_id", F.col("doc_id").eqNullSafe(F.col("component_id")).alias("kept"))


def keep_one(docs: DataFrame, threshold: float = THRESHOLD, miss: float = MISS, id_col: str = "doc_id",
             text_col: str = "text") -> DataFrame:
    """The input with one row of each component: the one with the smallest id, the first of those
    that share it. Texts without words all stay."""
    text, doc_id = F.col(f"`{text_col}`").cast("string"), F.col(f"`{id_col}`").cast("bigint")
    rows = docs.select(text_key(text).alias("tkey"), doc_id.alias("doc_id"), F.coalesce(text, F.lit("")).alias("text"))
    placed = _grouped(rows, threshold, miss).filter(F.col("root").isNotNull())
    first = cut_lineage(placed.groupBy("root").agg(
        F.min(F.struct(F.col("doc_id").isNull().alias("n"), "doc_id", "tkey")).alias("x"))
        .select("root", F.col("x.doc_id").alias("id"), F.col("x.tkey").alias("tk")))
    stays = F.col("doc_id").eqNullSafe(F.col("id")) & (F.col("tkey") == F.col("tk"))
    judged = placed.join(first, "root").select("doc_id", "tkey", stays.alias("stays"))
    gone = few(judged.filter("NOT stays").select(F.col("doc_id").alias("d"), "tkey").distinct())
    left = packed(docs, _id=doc_id, _key=text_key(text))
    left = left.join(gone, (left["_key"] == gone["tkey"]) & left["_id"].eqNullSafe(gone["d"]), "left_anti")
    # rows that agree in id and text are one document: the first of them stays
    twice = cut_lineage(judged.filter("stays").groupBy(F.col("doc_id").alias("d"), "tkey").count().filter("count > 1"))
    if twice.limit(1).count():
        same = (left["_key"] == twice["tkey"]) & left["_id"].eqNullSafe(twice["d"])
        left = left.join(twice, same, "left_anti").unionByName(
            left.join(twice, same, "left_semi").dropDuplicates(["_id", "_key"]))
    return unpacked(left, docs.columns)
