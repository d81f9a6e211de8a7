"""Benchmark decontamination by a positional inverted index (native DataFrame functions only).

The training texts' words are stored as postings (term, document, position) for the terms the
test windows are looked up by. Every test window (13 consecutive words, or a whole shorter item)
is looked up from its rarest terms: each of its LOOKUPS rarest words, by document frequency in
the corpus, has a postings list, the lists are adjusted by the word's offset in the window to the
place where the window would start, and intersected on (document, start). What is left is
compared with the document's words in full, so the reported matches are exact phrases.
`proximity` reports items whose rarest terms lie near each other in any order.

The words of all texts are staged once. Postings are kept for the looked-up terms only; they are
rare by choice, and a term found very often is counted with partial aggregates and joined with skew
splitting. The looked-up terms, and the documents with a candidate place, are sent to the scan if
they are measured below BROADCAST_ROWS; beyond that the same join shuffles.

Edge cases: NULL texts have no words; an item without words has no windows; equal windows of
several items count for each of them; repeated rows (also of one id) are matched row by row, each
input row gives a result row; NULL ids are kept; empty tables give clean results; other columns
are ignored by `report` and carried by `drop_contaminated`.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.llm.common import cut_lineage, few, narrow, packed, text_key, unpacked

WINDOW = 13
LOOKUPS = 2
SLOP, TERMS = 30, 3            # `proximity`: within so many words, so many of the rarest words
BROADCAST_ROWS = 100_000
#: word separators after lower-casing; upper-case letters are word characters before it
SPLIT = r"[\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+"
#: characters beyond ASCII that `lower` would change
OTHER_UPPER = r"[[\p{IsUppercase}\p{Lt}]&&[^A-Z]]"
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def words(text: Column) -> Column:
    """Words of a text, A-Z lower-cased. `lower` is used where it changes nothing else."""
    t = F.coalesce(text, F.lit(""))
    low = F.when(t.rlike(OTHER_UPPER), F.translate(t, UPPER, LOWER)).otherwise(F.lower(t))
    return F.array_remove(F.split(low, SPLIT), "")


def _rows(docs: DataFrame, id_col: str, text_col: str, key: bool = False) -> DataFrame:
    """Staged: _row, doc_id, n_words, w (words); with `key` the text's `text_key` as _key."""
    cols = [F.monotonically_increasing_id().alias("_row"), F.col(f"`{id_col}`").cast("bigint").alias("doc_id"),
            words(F.col(f"`{text_col}`").cast("string")).alias("w")]
    if key:
        cols.append(text_key(F.col(f"`{text_col}`")).alias("_key"))
    return cut_lineage(docs.select(*cols).withColumn("n_words", F.size("w").cast("bigint")))


def _small(df: DataFrame, n: int) -> DataFrame:
    """A broadcast side if its measured size allows, the plain side otherwise."""
    return F.broadcast(df) if n <= BROADCAST_ROWS else df


def windows(items: DataFrame, item_id: str = "item_id", text_col: str = "text", size: int = WINDOW) -> DataFrame:
    """Distinct windows of the test items with the items they come from: win (array), items."""
    w = narrow(items, **{item_id: "string", text_col: "string"}).select(
        F.col(item_id).alias("item_id"), words(F.col(text_col)).alias("w")).filter(F.size("w") > 0)
    one = w.select("item_id", "w", F.explode(F.sequence(F.lit(0), F.greatest(F.size("w") - size, F.lit(0)))).alias("i"))
    return (one.select("item_id", F.slice("w", F.col("i") + 1, size).alias("win"))
            .groupBy("win").agg(F.collect_set("item_id").alias("items"))
            .select(F.xxhash64("win").alias("win_id"), "win", "items"))


def postings(rows: DataFrame, terms: DataFrame, n_terms: int) -> DataFrame:
    """The positional index restricted to `terms`: term, _row, pos."""
    return rows.select("_row", F.posexplode("w").alias("pos", "term")).join(_small(terms, n_terms), "term")


def lengths(rows: DataFrame, wins: DataFrame) -> DataFrame:
    """Staged term, length: how long the postings lists of the windows' words are. Words that the
    corpus lacks have none."""
    vocabulary = cut_lineage(wins.select(F.explode("win").alias("term")).distinct())
    seen = rows.select(F.explode("w").alias("term")).join(_small(vocabulary, vocabulary.count()), "term")
    return cut_lineage(seen.groupBy("term").agg(F.count(F.lit(1)).alias("length")))


def lookups(wins: DataFrame, counts: DataFrame, per_window: int, whole: bool = True) -> DataFrame:
    """Staged win_id, n, term, off: the rarest words of each window, by the length of their
    postings lists. `whole`: a window with a word that the corpus lacks cannot occur and is left
    out; otherwise one with too few known words is."""
    term_of = wins.select("win_id", F.size("win").alias("n"), F.posexplode("win").alias("off", "term"))
    ranked = (term_of.join(counts, "term").groupBy("win_id", "n").agg(      # a window's words per group
        F.count(F.lit(1)).alias("known"), F.array_sort(F.collect_list(F.struct("length", "term", "off"))).alias("all")))
    enough = F.col("known") >= (F.col("n") if whole else F.least(F.col("n"), F.lit(per_window)))
    return cut_lineage(ranked.filter(enough)
                       .select("win_id", "n", F.explode(F.slice("all", 1, per_window)).alias("x"))
                       .select("win_id", "n", F.col("x.term").alias("term"), F.col("x.off").alias("off")))


def matches(rows: DataFrame, wins: DataFrame, counts: DataFrame, per_window: int = LOOKUPS) -> DataFrame:
    """Exact occurrences: _row, start, n, items."""
    look = lookups(wins, counts, per_window)
    terms = look.select("term").distinct()
    index = postings(rows, terms, terms.count())
    places = cut_lineage(
        index.join(look, "term").select("_row", "win_id", "n", (F.col("pos") - F.col("off")).alias("start"))
        .filter("start >= 0").groupBy("_row", "win_id", "n", "start").agg(F.count(F.lit(1)).alias("hits"))
        .filter(F.col("hits") == F.least(F.col("n"), F.lit(per_window)))
        .groupBy("_row").agg(F.collect_list(F.struct("win_id", "start", "n")).alias("places")))
    cut = (rows.select("_row", "w").join(_small(places, places.count()), "_row")
           .select("_row", F.explode(F.transform("places", lambda x: F.struct(
               x["win_id"].alias("win_id"), x["start"].alias("start"),
               F.slice(F.col("w"), x["start"] + 1, x["n"]).alias("win")))).alias("x")).select("_row", "x.*"))
    return (cut.join(wins, ["win_id", "win"]).select("_row", "start", F.size("win").alias("n"), "items"))


def report(docs: DataFrame, items: DataFrame, size: int = WINDOW, id_col: str = "doc_id",
           text_col: str = "text", item_id: str = "item_id", near: bool = False, slop: int = SLOP,
           terms: int = TERMS) -> DataFrame:
    """Per document: n_words, n_hit (words inside an occurrence), n_items, items_sha256, contaminated.
    `near` adds n_near, the items with a `proximity` match, at several times the cost."""
    rows = _rows(docs, id_col, text_col)
    wins, counts = _prepared(rows, items, size, text_col, item_id)
    if not near:
        return _report(rows, wins, counts).drop("_row")
    near = (_near(rows, wins, counts, slop, terms).select("_row", F.explode("items").alias("item")).distinct()
            .groupBy("_row").agg(F.count(F.lit(1)).alias("n_near")))
    return (_report(rows, wins, counts).join(near, "_row", "left")
            .withColumn("n_near", F.coalesce("n_near", F.lit(0)).cast("bigint")).drop("_row"))


def _prepared(rows: DataFrame, items: DataFrame, size: int, text_col: str, item_id: str) -> tuple[DataFrame, DataFrame]:
    wins = cut_lineage(windows(items, item_id, text_col, size))
    return wins, lengths(rows, wins)


def _report(rows: DataFrame, wins: DataFrame, counts: DataFrame) -> DataFrame:
    hit = matches(rows, wins, counts)
    # per document: occurrences sorted by start, joined to covered words; items as a sorted list
    per = hit.groupBy("_row").agg(F.array_sort(F.collect_set(F.struct("start", "n"))).alias("at"),
                                  F.array_sort(F.array_distinct(F.flatten(F.collect_set("items")))).alias("items"))
    covered = F.aggregate(
        "at", F.struct(F.lit(0).alias("end"), F.lit(0).alias("n")),
        lambda acc, x: F.struct(F.greatest(acc["end"], x["start"] + x["n"]).alias("end"),
                                (acc["n"] + F.greatest(F.lit(0), x["start"] + x["n"] - F.greatest(acc["end"], x["start"]))
                                 ).alias("n")), lambda acc: acc["n"])
    per = per.select("_row", covered.cast("bigint").alias("n_hit"), "items")
    base = rows.drop("w")
    n_hit = F.coalesce(F.col("n_hit"), F.lit(0))
    return base.join(per, "_row", "left").select(
        *base.columns, n_hit.cast("bigint").alias("n_hit"),
        F.coalesce(F.size("items"), F.lit(0)).cast("bigint").alias("n_items"),
        F.sha2(F.coalesce(F.array_join("items", ","), F.lit("")), 256).alias("items_sha256"),
        ((n_hit > 0) & (20 * n_hit >= F.col("n_words"))).alias("contaminated"))


def proximity(docs: DataFrame, items: DataFrame, slop: int = SLOP, terms: int = TERMS, size: int = WINDOW,
              id_col: str = "doc_id", text_col: str = "text", item_id: str = "item_id") -> DataFrame:
    """(doc_id, item_id, start, span): the `terms` rarest words of a window of the item, in any
    order, within `slop` words of the document; the nearest place per document and item. Words that
    the corpus lacks are passed over, so an item with an altered word is found by its others."""
    rows = _rows(docs, id_col, text_col)
    wins, counts = _prepared(rows, items, size, text_col, item_id)
    return (_near(rows, wins, counts, slop, terms).withColumn("item_id", F.explode("items"))
            .groupBy("_row", "item_id").agg(F.min(F.struct("span", "start")).alias("s"))
            .join(rows.select("_row", "doc_id"), "_row")
            .select("doc_id", "item_id", F.col("s.start").alias("start"), F.col("s.span").alias("span")))


def _near(rows: DataFrame, wins: DataFrame, counts: DataFrame, slop: int, terms: int) -> DataFrame:
    """_row, items, start, span: places with all of a window's rarest words. Windows with the same rarest
    words are looked up once. A range of 2 * slop words holds any such place, and blocks of that
    size, overlapping by half, keep the search linear in the postings."""
    of = lookups(wins, counts, terms, False).groupBy("win_id").agg(F.array_sort(F.collect_set("term")).alias("terms"))
    sets = cut_lineage(of.join(wins.select("win_id", F.explode("items").alias("item")), "win_id")
                       .groupBy("terms").agg(F.collect_set("item").alias("items")))
    look = sets.select("terms", F.size("terms").alias("need"), F.explode("terms").alias("term"))
    vocabulary = cut_lineage(look.select("term").distinct())
    index = postings(rows, vocabulary, vocabulary.count()).withColumn(
        "block", F.explode(F.array(F.floor(F.col("pos") / slop), F.floor(F.col("pos") / slop) - 1)))
    near = (index.join(look, "term")
            .groupBy("_row", "block", "terms", "need").agg(F.collect_list(F.struct("pos", "term")).alias("at"))
            .filter(F.size(F.array_distinct(F.col("at.term"))) == F.col("need")).withColumn("at", F.array_sort("at")))
    # smallest range from each posting on that holds all needed terms
    spans = F.transform("at", lambda x, i: F.struct(
        F.aggregate(F.filter("at", lambda y: (y["pos"] >= x["pos"])),
                    F.struct(F.array().cast("array<string>").alias("seen"), F.lit(None).cast("int").alias("end")),
                    lambda acc, y: F.struct(
                        F.array_union(acc["seen"], F.array(y["term"])).alias("seen"),
                        F.when(F.size(F.array_union(acc["seen"], F.array(y["term"]))) > F.size(acc["seen"]),
                               y["pos"]).otherwise(acc["end"]).alias("end")),
                    lambda acc: F.when(F.size(acc["seen"]) == F.col("need"), acc["end"] - x["pos"] + 1)).alias("span"),
        x["pos"].alias("start")))
    best = near.select("_row", "terms", F.explode(F.filter(spans, lambda s: s["span"] <= slop)).alias("s"))
    return best.join(sets, "terms").select("_row", "items", F.col("s.start").alias("start"), F.col("s.span").alias("span"))


def drop_contaminated(docs: DataFrame, items: DataFrame, size: int = WINDOW, id_col: str = "doc_id",
                      text_col: str = "text", item_id: str = "item_id") -> DataFrame:
    """The input rows that are not contaminated, with all their columns. The verdict follows from
    the text, so the contaminated texts' keys are taken out of the input."""
    rows = _rows(docs, id_col, text_col, key=True)
    bad = _report(rows, *_prepared(rows, items, size, text_col, item_id)).filter("contaminated").select("_key").distinct()
    all_ = packed(docs, _key=text_key(F.col(f"`{text_col}`")))
    return unpacked(all_.join(few(bad, BROADCAST_ROWS), "_key", "left_anti"), docs.columns)
