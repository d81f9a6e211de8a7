"""Secret scan with corpus-wide ownership frequency (native DataFrame functions only).

Candidates are the base kinds (assign, access, hex) and, as `other`, wider forms: bearer values,
web tokens, vendor-prefixed keys, passwords in URLs, and long strings mixing cases and digits.
The hash of each candidate value is counted over the whole corpus by distinct repositories and
distinct owners. A value held by at most `max_owners` owners in at most `max_repos` repositories
looks live; one found with more of either is a widely copied example. Base spans are always reported; `other` spans only if live.

Positions come from the built-in regular expressions: the matches (`regexp_extract_all`) and the
text between them (`split`) alternate, so the running sum of their lengths gives every start.

Edge cases: a NULL or empty text has no spans; a NULL owner or repository counts as one unknown
owner or repository; repeated rows are scanned one by one (each input row gives a result row) and
count once as owner and repository; an empty table gives an empty result; other columns of the
input are ignored by `scan` and carried by `redact`.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.llm.common import cut_lineage, few, packed, text_key

# The base kinds' patterns. A run of [0-9a-f] or of [A-Z0-9] after AKIA is matched
# whole, so the least lengths may stand in the pattern; `assign` is filtered on group 2.
ASSIGN = r"""((?i:password|passwd|secret|token|api_?key))["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)"""
ACCESS = r"AKIA[A-Z0-9]{16,}"
HEX = r"[0-9a-f]{24,}"
KINDS = ["assign", "access", "hex", "other"]
OTHER = (r"(?i:bearer)\x20+[A-Za-z0-9._~+/-]{20,}"
         r"|eyJ[A-Za-z0-9_-]{8,}\.[A-Za-z0-9_-]{8,}\.[A-Za-z0-9_-]{8,}"
         r"|(?:ghp_|gho_|glpat-|sk-|sk_live_|xoxb-|xoxp-)[A-Za-z0-9_-]{16,}"
         r"|://[A-Za-z0-9._%-]+:[^\x20\x09-\x0D:/@]{6,}@"
         r"|[A-Za-z0-9+/_-]{32,}")
MIXED_ONLY = r"^[A-Za-z0-9+/_-]+$"
#: a vendor-prefixed key in a value, not inside a word ("task-", "disk_live_")
VENDOR = r"(?:ghp_|gho_|glpat-|sk-|sk_live_|xoxb-|xoxp-)[A-Za-z0-9_-]{16,}"
VENDOR_FIRST, VENDOR_INSIDE = "^" + VENDOR, "[^A-Za-z0-9]" + VENDOR
MAX_OWNERS = 2
MAX_REPOS = 10


def found(text: Column, pattern: str, kind: int, group: int = 0) -> Column:
    """All matches as array<struct<s, k, e, v>>: code point start, kind, end, value."""
    whole = F.regexp_extract_all(text, F.lit(pattern), F.lit(0))
    value = F.regexp_extract_all(text, F.lit(pattern), F.lit(group)) if group else whole
    between = F.split(text, pattern, -1)
    lengths = F.zip_with(F.zip_with(between, whole, lambda a, b: F.struct(F.length(a).alias("gap"), b.alias("m"))),
                         value, lambda a, v: F.struct(a["gap"].alias("gap"), F.length(a["m"]).alias("n"),
                                                      v.alias("v")))
    empty = F.expr("CAST(array() AS array<struct<s:int,k:int,e:int,v:string>>)")

    def placed(found: Column) -> Column:
        ends = running(F.transform(found, lambda x: x["gap"] + x["n"]), lambda a, b: a + b)
        return F.zip_with(found, ends, lambda x, before: F.struct(
            (before + x["gap"]).alias("s"), F.lit(kind).alias("k"), (before + x["gap"] + x["n"]).alias("e"), x["v"].alias("v")))

    return F.when(text.rlike(pattern), bound(F.filter(lengths, lambda x: x["n"].isNotNull()), placed)).otherwise(empty)


STEP = 128          # elements of an array that are taken together by `running`
CHUNK = 4096        # characters of a text that `redact` takes together


def bound(value: Column, use) -> Column:
    """`use(value)` with the value computed once."""
    return F.get(F.transform(F.array(value), use), F.lit(0))


def running(values: Column, op) -> Column:
    """For each element of an integer array what `op` makes of 0 and all elements before it. Arrays
    that grow by one element are copied each time, so this is done per STEP elements, and once more
    over the steps' results."""
    zero = F.lit(0)

    def within(step: Column, before: Column) -> Column:
        first = F.struct(before.alias("at"), F.expr("CAST(array() AS array<int>)").alias("out"))
        return F.aggregate(step, first, lambda a, x: F.struct(
            op(a["at"], x).alias("at"), F.concat(a["out"], F.array(a["at"])).alias("out")), lambda a: a["out"])

    def cut(all_: Column) -> Column:
        return F.when(F.size(all_) == 0, F.expr("CAST(array() AS array<array<int>>)")).otherwise(F.transform(
            F.sequence(zero, F.floor((F.size(all_) - 1) / STEP).cast("int")), lambda b: F.slice(all_, b * STEP + 1, F.lit(STEP))))

    def joined(steps: Column) -> Column:
        sums = F.transform(steps, lambda x: F.aggregate(x, zero, op))
        before = bound(sums, lambda t: F.transform(t, lambda _, i: F.aggregate(F.slice(t, 1, i), zero, op)))
        return F.flatten(F.zip_with(steps, before, within))

    return bound(values, lambda v: bound(cut(v), joined))


def candidates(text: Column) -> Column:
    """All candidate spans of a text, base kinds first. Long strings must mix cases and digits unless
    they hold a vendor-prefixed key."""
    assign = F.filter(found(text, ASSIGN, 0, 2), lambda x: F.length(x["v"]) >= 6)
    def vendor(x):       # at the start of the value the character before it counts
        alone = (x["s"] == 0) | ~F.substring(text, x["s"], F.lit(1)).rlike("[A-Za-z0-9]")
        return x["v"].rlike(VENDOR_INSIDE) | (x["v"].rlike(VENDOR_FIRST) & alone)

    other = F.filter(found(text, OTHER, 3), lambda x: ~x["v"].rlike(MIXED_ONLY) | (
        x["v"].rlike("[A-Z]") & x["v"].rlike("[a-z]") & x["v"].rlike("[0-9]")) | vendor(x))
    return F.concat(assign, found(text, ACCESS, 1), found(text, HEX, 2), other)


def _candidate_rows(docs: DataFrame, id_col: str, text_col: str, owner_col: str, repo_col: str,
                    key: bool) -> DataFrame:
    """Staged: _row, doc_id, owner, repo, spans (hash instead of value); with `key` the text's
    `text_key` as _row, and only texts with spans."""
    text = F.coalesce(F.col(f"`{text_col}`").cast("string"), F.lit(""))
    cols = [(text_key(text) if key else F.monotonically_increasing_id()).alias("_row"), F.col(f"`{id_col}`").alias("doc_id"),
            F.coalesce(F.col(f"`{owner_col}`").cast("string"), F.lit("")).alias("owner"),
            F.coalesce(F.col(f"`{repo_col}`").cast("string"), F.lit("")).alias("repo"),
            F.transform(candidates(text), lambda x: F.struct(
                x["s"].alias("s"), x["k"].alias("k"), x["e"].alias("e"),
                F.sha2(x["v"], 256).alias("v"))).alias("spans")]
    found = docs.select(*cols)
    return cut_lineage(found.filter(F.size("spans") > 0) if key else found)


def ownership(rows: DataFrame) -> DataFrame:
    """(v, n_owners, n_repos) per candidate hash. Both counts go through a distinct on two columns
    first, so a value found in a third of all documents is spread before it is counted."""
    one = rows.select("owner", "repo", F.explode("spans").alias("x")).select(F.col("x.v").alias("v"), "owner", "repo")
    owners = one.select("v", "owner").distinct().groupBy("v").agg(F.count(F.lit(1)).alias("n_owners"))
    repos = one.select("v", "repo").distinct().groupBy("v").agg(F.count(F.lit(1)).alias("n_repos"))
    # staged: the join with it then has shuffles on both sides, and a hot value can be split
    return cut_lineage(owners.join(repos, "v"))


def _judged(rows: DataFrame, max_owners: int, max_repos: int, unique: bool = True) -> DataFrame:
    """(_row, told) for rows with candidates; spans sorted by start, then kind, with `live` and both counts;
    `other` spans that are not live are gone. Rows that share a _row (not `unique`) have the same spans."""
    some = rows.filter(F.size("spans") > 0)
    one = ((some if unique else some.dropDuplicates(["_row"])).select("_row", F.explode("spans").alias("x"))
           .select("_row", F.col("x.v").alias("v"), "x"))
    told = (one.join(ownership(rows), "v")
            .withColumn("live", (F.col("n_owners") <= max_owners) & (F.col("n_repos") <= max_repos)))
    return (told.groupBy("_row").agg(F.array_sort(F.collect_list(F.struct(
        F.col("x.s").alias("s"), F.col("x.k").alias("k"), F.col("x.e").alias("e"), "live", "n_owners", "n_repos"))).alias("all"))
        .select("_row", F.filter("all", lambda x: (x["k"] < 3) | x["live"]).alias("told")))


def _joined(spans: Column) -> Column:
    name = F.array(*[F.lit(k) for k in KINDS])
    return F.array_join(F.transform(spans, lambda x: F.concat_ws(
        ":", F.get(name, x["k"]), x["s"].cast("string"), x["e"].cast("string"))), ",")


def scan(docs: DataFrame, max_owners: int = MAX_OWNERS, id_col: str = "doc_id", text_col: str = "text",
         owner_col: str = "source", repo_col: str = "doc_id", max_repos: int = MAX_REPOS) -> DataFrame:
    """Per document: counts and digest of the base spans, all spans, how many spans look live
    (n_live) or hold a widely copied value (n_copied), and the owners and repositories of each
    span's value (`owners` and `repos`, in the order of `spans`)."""
    rows = _candidate_rows(docs, id_col, text_col, owner_col, repo_col, False)
    none = F.expr("CAST(array() AS array<struct<s:int,k:int,e:int,live:boolean,n_owners:bigint,n_repos:bigint>>)")
    some = rows.filter(F.size("spans") > 0).select("_row", "doc_id").join(_judged(rows, max_owners, max_repos), "_row")
    all_ = (some.select("doc_id", "told")
            .unionByName(rows.filter(F.size("spans") == 0).select("doc_id", none.alias("told"))))

    def n(test):
        return F.size(F.filter("told", test)).cast("bigint")

    def of(kind):
        return n(lambda x: x["k"] == kind).alias(f"n_{KINDS[kind]}")

    return all_.select(
        "doc_id", of(0), of(1), of(2),
        F.sha2(_joined(F.filter("told", lambda x: x["k"] < 3)), 256).alias("base_sha256"),
        _joined(F.col("told")).alias("spans"),
        n(lambda x: x["live"]).alias("n_live"), n(lambda x: ~x["live"]).alias("n_copied"),
        F.col("told.n_owners").alias("owners"), F.col("told.n_repos").alias("repos"))


def redact(docs: DataFrame, max_owners: int = MAX_OWNERS, id_col: str = "doc_id", text_col: str = "text",
           owner_col: str = "source", repo_col: str = "doc_id", max_repos: int = MAX_REPOS) -> DataFrame:
    """The input with every reported span replaced: [SECRET] if one of the spans it overlaps looks
    live, [EXAMPLE] otherwise. Texts without spans stay as they are; n_chars, if there, follows."""
    rows = _candidate_rows(docs, id_col, text_col, owner_col, repo_col, True)
    text = F.col(f"_in.`{text_col}`").cast("string")
    mark = {True: F.lit("[SECRET]"), False: F.lit("[EXAMPLE]")}

    def groups(spans: Column) -> Column:
        """Overlapping spans as one, in order: start, end, live."""
        ends = running(F.transform(spans, lambda x: x["e"]), lambda a, b: F.greatest(a, b))
        firsts = bound(ends, lambda e: F.filter(F.transform(spans, lambda x, i: F.when(
            (i == 0) | (x["s"] >= F.get(e, i)), i + 1)), lambda i: i.isNotNull()))
        one = bound(firsts, lambda f: F.transform(f, lambda i, n: F.slice(
            spans, i, F.coalesce(F.get(f, n + 1), F.size(spans) + 1) - i)))
        return F.transform(one, lambda g: F.struct(
            F.get(g, F.lit(0))["s"].alias("s"), F.array_max(F.transform(g, lambda x: x["e"])).alias("e"),
            F.exists(g, lambda x: x["live"]).alias("live")))

    def part(chunks: Column, lo: Column, hi: Column) -> Column:
        """The characters lo .. hi-1 of the text, without counting from its start."""
        first = F.floor(lo / CHUNK).cast("int")
        some = F.array_join(F.slice(chunks, first + 1, F.floor(F.greatest(hi - 1, lo) / CHUNK).cast("int") - first + 1), "")
        return F.when(hi > lo, F.substring(some, lo - first * CHUNK + 1, hi - lo)).otherwise("")

    def put(chunks: Column, spans: Column) -> Column:
        pieces = F.transform(spans, lambda x, i: F.concat(
            part(chunks, F.coalesce(F.get(spans, i - 1)["e"], F.lit(0)), x["s"]),
            F.when(x["live"], mark[True]).otherwise(mark[False])))
        last = F.element_at(spans, -1)["e"]
        return F.concat(F.array_join(pieces, ""), part(chunks, last, F.length(text)))

    done = bound(F.regexp_extract_all(text, F.lit(f"(?s).{{1,{CHUNK}}}"), F.lit(0)),
                 lambda chunks: bound(groups(F.col("told")), lambda spans: put(chunks, spans)))
    told = few(_judged(rows, max_owners, max_repos, unique=False).withColumnRenamed("_row", "_key"), size=F.size("told"))
    both = (packed(docs, _key=text_key(F.col(f"`{text_col}`"))).join(told, "_key", "left")
            .select("_in", F.when(F.col("told").isNull(), text).otherwise(done).alias("_new")))

    def out(c):
        if c == text_col:
            return F.col("_new").alias(c)
        if c == "n_chars":
            return F.when(F.col("_new").eqNullSafe(text), F.col("_in.n_chars")).otherwise(
                F.length("_new")).cast(docs.schema["n_chars"].dataType).alias(c)
        return F.col(f"_in.`{c}`").alias(c)

    return both.select(*[out(c) for c in docs.columns])
