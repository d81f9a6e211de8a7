"""Quality rules as weak supervision (native DataFrame functions only).

Each rule looks at text statistics and votes good (+1), bad (-1) or abstains (0). The vote
patterns are counted over all documents (at most 3**rules rows, whatever the corpus size), and
expectation-maximisation on the counted patterns estimates, per rule, how often it votes good
or bad given the hidden class, and the share of good documents. A document is kept if the
posterior probability of "good" reaches the threshold, so a single failing rule does not
reject it. Documents failing the base checks are rejected in any case.

Edge cases: NULL text and texts without words have no words, fail the base check (n_words < 20)
and still vote; an empty table gives an empty result; NULL ids and repeated rows are kept as they
are, one result row per input row; other columns of the input are ignored by `judge` and carried
by `keep_good`. Ties at the threshold are kept.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.llm.common import cut_lineage, few, packed, text_key, unpacked

SEPARATORS = [" ", "\t", "\n", "\x0b", "\x0c", "\r"]
SYMBOLS = list("#*$%&|<>")
WINDOW = 8
ROUNDS = 12
MIN_POSTERIOR = 0.5
#: P(vote | good), P(vote | bad) before any text is seen, and the weight of that belief.
START = {("g", "+"): 0.90, ("g", "-"): 0.005, ("g", "0"): 0.095, ("b", "+"): 0.60, ("b", "-"): 0.30, ("b", "0"): 0.10}
PRIOR_SHARE = 0.3

#: rule -> (statistic, good if below, bad if from): values between them abstain; and the
#: other way round for rules whose statistic should be large.
BELOW = {
    "symbols": ("n_symbols / greatest(n_words, 1)", 0.02, 0.10),
    "dup_lines": ("n_dup_lines / greatest(n_lines, 1)", 0.10, 0.40),
    "repeats": ("n_repeat_words / greatest(n_words, 1)", 0.05, 0.30),
    "upper": ("n_upper / greatest(word_chars, 1)", 0.20, 0.40),
    "bangs": ("n_bangs / greatest(n_words, 1)", 0.10, 0.50),
}
ABOVE = {
    "length": ("n_words", 50, 20),
    "letters": ("(word_chars - n_symbols - n_bangs) / greatest(word_chars, 1)", 0.95, 0.92),
}
WORD_LENGTH = ("word_chars / greatest(n_words, 1)", 3.0, 12.0, 2.0, 20.0)
RULES = [*BELOW, *ABOVE, "word_length"]


def _count(text: Column, chars: list[str]) -> Column:
    """Occurrences of single characters: what `replace` takes away. All are ASCII, so bytes
    and characters agree."""
    return sum((F.octet_length(text) - F.octet_length(F.replace(text, F.lit(c))) for c in chars[1:]),
               F.octet_length(text) - F.octet_length(F.replace(text, F.lit(chars[0]))))


def statistics(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", more: bool = False,
               key: bool = False) -> DataFrame:
    """One row of text statistics per document: doc_id, n_words, word_chars, n_symbols, n_lines,
    n_dup_lines, n_repeat_words, n_upper, n_bangs; with `more` also n_distinct, n_digits, n_stops,
    n_pipes; with `key` the text's `text_key` as _key."""
    kept = ["_key"] if key else []
    extra = ["n_distinct", "n_digits", "n_stops", "n_pipes"] if more else []
    text = F.coalesce(F.col(f"`{text_col}`").cast("string"), F.lit(""))
    base = docs.select(
        F.col(f"`{id_col}`").cast("bigint").alias("doc_id"), text.alias("t"),
        F.array_remove(F.split(text, r"[\x20\x09-\x0D]+"), "").alias("w"),
        *([text_key(F.col(f"`{text_col}`")).alias("_key")] if key else []))
    ws = base.select(
        "doc_id", "t", *kept,
        F.size("w").cast("bigint").alias("n_words"),
        (F.char_length("t") - _count(F.col("t"), SEPARATORS)).cast("bigint").alias("word_chars"),
        _count(F.col("t"), SYMBOLS).cast("bigint").alias("n_symbols"),
        _count(F.col("t"), ["!", "?"]).cast("bigint").alias("n_bangs"),
        F.length(F.regexp_replace("t", "[^A-Z]+", "")).cast("bigint").alias("n_upper"),
        *([F.size(F.array_distinct("w")).cast("bigint").alias("n_distinct"),
           _count(F.col("t"), list("0123456789")).cast("bigint").alias("n_digits"),
           _count(F.col("t"), [".", ","]).cast("bigint").alias("n_stops"),
           _count(F.col("t"), ["|"]).cast("bigint").alias("n_pipes")] if more else []),
        F.filter(F.split("t", "\n"), lambda x: F.length(F.translate(x, "".join(SEPARATORS), "")) > 0).alias("lines"),
        F.transform("w", lambda x: F.xxhash64(x)).alias("h"))
    # a hash per window of 8 words, from the words' hashes
    windows = ws.select(
        "*", F.when(F.size("h") >= WINDOW, F.transform(
            F.sequence(F.lit(0), F.size("h") - WINDOW),
            lambda i: F.xxhash64(*[F.get("h", i + k) for k in range(WINDOW)])))
        .otherwise(F.array().cast("array<bigint>")).alias("g"))
    found = windows.select("*", (F.size("g") > F.size(F.array_distinct("g"))).alias("again"))
    # starts of windows found twice or more, in order: equal neighbours after sorting (hash, place)
    sorted_ = found.select(
        "*", F.when(F.col("again"), F.array_sort(F.transform(
            "g", lambda x, i: F.struct(x.alias("x"), i.alias("i"))))).alias("s"))
    starts = sorted_.select(
        "*", F.when(F.col("again"), F.array_sort(F.transform(
            F.filter("s", lambda e, i: (F.get("s", i - 1)["x"].eqNullSafe(e["x"]) & (i > 0))
                     | F.get("s", i + 1)["x"].eqNullSafe(e["x"])), lambda e: e["i"]))).alias("p"))
    covered = F.when(F.col("again"), F.aggregate(
        F.transform("p", lambda x, i: F.least(F.coalesce(F.get("p", i + 1) - x, F.lit(WINDOW)), F.lit(WINDOW))),
        F.lit(0), lambda a, x: a + x)).otherwise(0)
    return starts.select(
        "doc_id", "n_words", "word_chars", "n_symbols", F.size("lines").cast("bigint").alias("n_lines"),
        (F.size("lines") - F.size(F.array_distinct("lines"))).cast("bigint").alias("n_dup_lines"),
        covered.cast("bigint").alias("n_repeat_words"), "n_upper", "n_bangs", *extra, *kept)


def votes_sql() -> dict[str, str]:
    """rule -> SQL giving 1 (good), -1 (bad) or 0 (abstain) from the statistics."""
    out = {}
    for name, (stat, good, bad) in BELOW.items():
        out[name] = f"CASE WHEN {stat} < {good} THEN 1 WHEN {stat} >= {bad} THEN -1 ELSE 0 END"
    for name, (stat, good, bad) in ABOVE.items():
        out[name] = f"CASE WHEN {stat} >= {good} THEN 1 WHEN {stat} < {bad} THEN -1 ELSE 0 END"
    stat, lo, hi, low, high = WORD_LENGTH
    out["word_length"] = (f"CASE WHEN {stat} >= {lo} AND {stat} < {hi} THEN 1 "
                          f"WHEN {stat} < {low} OR {stat} >= {high} THEN -1 ELSE 0 END")
    return out


def pattern_expr() -> Column:
    """The votes as one string of +, -, 0 in the order of RULES."""
    sql = votes_sql()
    return F.concat(*[F.when(F.expr(sql[r]) == 1, "+").when(F.expr(sql[r]) == -1, "-").otherwise("0") for r in RULES])


def fit(patterns: list[tuple[str, int]], rounds: int = ROUNDS):
    """EM over counted vote patterns: P(vote | class) per rule and P(good). The patterns are
    at most 3**len(RULES) pairs (bounded by the number of rules, not by the corpus).

    Junk comes in several kinds, each seen by other rules, so a plain fit may take one kind as
    the hidden class "bad" and the rest as good. START, as a Dirichlet prior with the weight of a
    share of the corpus, holds the classes to their meaning: a bad vote is rare in good texts."""
    n = sum(c for _, c in patterns)
    prior = 0.9
    weight = PRIOR_SHARE * n
    p = {(r, *kv): q for r in range(len(RULES)) for kv, q in START.items()}
    for _ in range(rounds if n else 0):
        good = {s: posterior(s, prior, p) for s, _ in patterns}
        total = math.fsum(c * good[s] for s, c in patterns)
        for r in range(len(RULES)):
            for v in "+-0":
                hit = [(s, c) for s, c in patterns if s[r] == v]
                p[r, "g", v] = (math.fsum(c * good[s] for s, c in hit) + weight * START["g", v]) / (total + weight)
                p[r, "b", v] = ((math.fsum(c * (1 - good[s]) for s, c in hit) + weight * START["b", v])
                                / (n - total + weight))
        prior = (total + 0.9 * weight) / (n + weight)
    return prior, p


def posterior(s: str, prior: float, p: dict) -> float:
    g = math.log(prior) + sum(math.log(p[r, "g", v]) for r, v in enumerate(s))
    b = math.log(1 - prior) + sum(math.log(p[r, "b", v]) for r, v in enumerate(s))
    return 1 / (1 + math.exp(min(700.0, b - g)))


def judge(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text",
          min_posterior: float = MIN_POSTERIOR, key: bool = False) -> DataFrame:
    """Statistics, votes (`pattern`), quality_prob, base_failed and kept per document."""
    voted = cut_lineage(statistics(docs, id_col, text_col, key=key).withColumn("pattern", pattern_expr()))
    counts = [(r["pattern"], r["n"]) for r in
              voted.groupBy("pattern").agg(F.count(F.lit(1)).alias("n")).orderBy("pattern").collect()]
    prior, p = fit(counts)
    log_odds = F.lit(math.log(prior) - math.log(1 - prior))
    for i in range(len(RULES)):
        at = F.substring("pattern", i + 1, 1)
        lift = [math.log(p[i, "g", v]) - math.log(p[i, "b", v]) for v in "+-0"]
        log_odds = log_odds + F.when(at == "+", lift[0]).when(at == "-", lift[1]).otherwise(lift[2])
    base_failed = (F.col("n_words") < 20) | (100 * F.col("n_repeat_words") > 30 * F.col("n_words"))
    return (voted.withColumn("quality_prob", 1 / (1 + F.exp(-log_odds)))
            .withColumn("base_failed", base_failed)
            .withColumn("kept", ~base_failed & (F.col("quality_prob") >= min_posterior)))


def keep_good(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text",
              min_posterior: float = MIN_POSTERIOR) -> DataFrame:
    """The input rows that are kept, with all their columns. A verdict follows from the text, so
    the rejected texts' keys are taken out of the input."""
    bad = judge(docs, id_col, text_col, min_posterior, key=True).filter("NOT kept").select("_key").distinct()
    rows = packed(docs, _key=text_key(F.col(f"`{text_col}`")))
    return unpacked(rows.join(few(bad), "_key", "left_anti"), docs.columns)
