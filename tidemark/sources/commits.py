"""Bucketed tables whose commits are whole: a batch rewrites the key buckets it touches, or nothing.

    <table>/_data/_commit=<id>/_bucket=<n>/   the rows of bucket n as commit <id> wrote them
    <table>/_commits/<version>.json           which commit holds each bucket, from this version on

A merge writes the touched buckets into a folder of its own and then publishes one small file by a
rename that fails if the version exists. Before that rename readers see the old buckets, after
it the new ones; a job that ends between two buckets leaves files that no version names (`vacuum`
removes them). Of two writers the later one finds its version taken: if the other one touched
other buckets, its entry is redone on top of that version, otherwise the merge runs again.

A version file holds, per bucket, the commit, the row count, the least and largest value of the
columns named in `stats`, a digest of the columns named in `digest`, and for the columns named in
`diverge` whether some key's closed rows differ from its open row. So it is bounded by the number of buckets, whatever the rows. The
schemas of the commits are kept too: a bucket written before a column was added or widened is
read under its own schema and cast to the table's newest one, without being rewritten.

Valid for merges whose result for a key depends on that key's rows only.
"""

from __future__ import annotations

import datetime as _dt
import json
import uuid
from collections.abc import Callable, Sequence

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

BUCKET_COL = "_bucket"
COMMIT_COL = "_commit"
OPEN_DATE = _dt.date(9999, 12, 31)


class CommitConflict(RuntimeError):
    """Other writers changed the same buckets, as often as the merge was retried."""


# ---- files -------------------------------------------------------------------------------

def _join(root: str, *parts: str) -> str:
    return "/".join([root.rstrip("/"), *parts])


def _fs(spark: SparkSession, path: str):
    p = spark._jvm.org.apache.hadoop.fs.Path(path)
    return p.getFileSystem(spark._jsc.hadoopConfiguration()), p


def _versions(spark: SparkSession, table_dir: str) -> list[int]:
    fs, folder = _fs(spark, _join(table_dir, "_commits"))
    if not fs.exists(folder):
        return []
    names = [s.getPath().getName() for s in fs.listStatus(folder)]
    return sorted(int(n[:-5]) for n in names if n.endswith(".json") and n[:-5].isdigit())


def _load(spark: SparkSession, table_dir: str, version: int) -> dict:
    fs, path = _fs(spark, _join(table_dir, "_commits", f"{version:012d}.json"))
    stream = fs.open(path)
    try:
        return json.loads(spark._jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8"))
    finally:
        stream.close()


def _publish(spark: SparkSession, table_dir: str, entry: dict) -> bool:
    """Write the version file; False if another writer has published this version."""
    folder = _join(table_dir, "_commits")
    fs, made = _fs(spark, _join(folder, f"_new-{uuid.uuid4().hex}"))
    out = fs.create(made, False)
    out.write(bytearray(json.dumps(entry).encode()))
    out.close()
    jvm = spark._jvm
    context = jvm.org.apache.hadoop.fs.FileContext.getFileContext(made.toUri(), spark._jsc.hadoopConfiguration())
    options = spark.sparkContext._gateway.new_array(jvm.org.apache.hadoop.fs.Options.Rename, 0)
    _, path = _fs(spark, _join(folder, f"{entry['version']:012d}.json"))
    try:
        context.rename(made, path, options)
        return True
    except Exception as e:  # noqa: BLE001 - the Java class tells a taken version from other errors
        fs.delete(made, False)
        if "FileAlreadyExistsException" in str(e) or "already exists" in str(e):
            return False
        raise


def head(spark: SparkSession, table_dir: str, version: int | None = None, as_of: _dt.datetime | None = None) -> dict | None:
    """The newest version's entry, that of `version`, or the last one published up to `as_of` (UTC)."""
    known = _versions(spark, table_dir)
    if version is not None:
        return _load(spark, table_dir, version) if version in known else None
    for v in reversed(known):
        entry = _load(spark, table_dir, v)
        if as_of is None or _dt.datetime.fromisoformat(entry["at"]) <= as_of:
            return entry
    return None


def last_epoch(spark: SparkSession, table_dir: str, stream: str) -> int | None:
    """The last micro-batch of `stream` that the table holds."""
    entry = head(spark, table_dir)
    return None if entry is None else entry["epochs"].get(stream)


# ---- reading -----------------------------------------------------------------------------

def _schema(text: str) -> T.StructType:
    return T.StructType.fromJson(json.loads(text))


def _cast(df: DataFrame, schema: T.StructType) -> DataFrame:
    """The columns of `schema`, cast; those that `df` lacks are NULL."""
    have = dict(df.dtypes)
    return df.select(*[(F.col(f"`{f.name}`") if f.name in have else F.lit(None)).cast(f.dataType).alias(f.name)
                       for f in schema.fields], F.col(BUCKET_COL))


def _rows(spark: SparkSession, table_dir: str, entry: dict, buckets: Sequence[int] | None = None) -> DataFrame:
    """The rows of the buckets (all), with BUCKET_COL. Only their folders are listed and read."""
    newest = _schema(entry["schemas"][entry["schema"]])
    wanted = entry["buckets"] if buckets is None else {str(b): entry["buckets"][str(b)] for b in buckets if str(b) in entry["buckets"]}
    by_schema: dict[str, list[str]] = {}
    for bucket, held in sorted(wanted.items(), key=lambda x: int(x[0])):
        by_schema.setdefault(entry["commits"][held["commit"]], []).append(
            _join(table_dir, "_data", f"{COMMIT_COL}={held['commit']}", f"{BUCKET_COL}={bucket}"))
    parts = []
    for name, paths in by_schema.items():
        own = T.StructType([*_schema(entry["schemas"][name]).fields, T.StructField(COMMIT_COL, T.StringType()),
                            T.StructField(BUCKET_COL, T.IntegerType())])
        df = spark.read.schema(own).option("basePath", _join(table_dir, "_data")).parquet(*paths)
        parts.append(_cast(df, newest))
    if not parts:
        return _cast(spark.createDataFrame([], T.StructType([*newest.fields, T.StructField(BUCKET_COL, T.IntegerType())])), newest)
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out


def read(spark: SparkSession, table_dir: str, version: int | None = None, as_of: _dt.datetime | None = None) -> DataFrame | None:
    """The table (without the bucket column), as it is, as `version` left it, or as it was at `as_of`."""
    entry = head(spark, table_dir, version, as_of)
    return None if entry is None else _rows(spark, table_dir, entry).drop(BUCKET_COL)


# ---- statistics --------------------------------------------------------------------------

def watermark(spark: SparkSession, table_dir: str, column: str, default=None, largest: bool = True):
    """The largest (or least) value of a column kept in `stats`, without reading a row. `default` if
    there is none."""
    entry = head(spark, table_dir)
    if entry is None:
        return default
    if column not in entry["stats"]:
        raise KeyError(f"{column} is not among the columns with statistics: {entry['stats']}")
    found = [b["stats"][column][int(largest)] for b in entry["buckets"].values()
             if column in b["stats"] and b["stats"][column][int(largest)] is not None]
    if not found:
        return default
    kind = _schema(entry["schemas"][entry["schema"]])[column].dataType
    # one value per bucket; Spark compares them as the column's type
    pick = (F.max if largest else F.min)(F.col("v").cast(kind))
    return spark.createDataFrame([(v,) for v in found], "v string").agg(pick).first()[0]


def row_count(spark: SparkSession, table_dir: str) -> int:
    """The table's rows, from the version file."""
    entry = head(spark, table_dir)
    return 0 if entry is None else sum(b["n"] for b in entry["buckets"].values())


def _row_hash(df: DataFrame, cols: Sequence[str]) -> Column:
    """A 64-bit hash of the values as text (so that a widened type hashes alike); absent columns are NULL."""
    return F.xxhash64(*[(F.col(f"`{c}`").cast("string") if c in df.columns else F.lit(None).cast("string")) for c in cols])


def reconcile(spark: SparkSession, left: tuple[str, int | None], right: tuple[str, int | None]) -> DataFrame:
    """Compare two tables, or two versions of one (folder, version or None for the newest), stored with
    the same key, buckets and `digest` columns: the key columns and SIDE ('left_only', 'right_only',
    'changed') of the rows that differ. Keys occur once on each side.

    Row counts and digests of the buckets come from the version files; a digest is the xor of the
    rows' hashes and their sum, so it does not depend on their order. Only buckets that are
    unlike are read; buckets held by the same commit are alike without looking."""
    entries = [head(spark, d, v) for d, v in (left, right)]
    if any(e is None for e in entries):
        raise ValueError("no such table or version")
    a, b = entries
    if (a["key"], a["n_buckets"], a["digest"]) != (b["key"], b["n_buckets"], b["digest"]) or not a["digest"]:
        raise ValueError("the tables differ in key, buckets or digest columns, or keep no digest")

    def mark(e, bucket):
        held = e["buckets"].get(bucket)
        return None if held is None else (held["n"], held["digest"])

    unlike = sorted(int(x) for x in {*a["buckets"], *b["buckets"]} if mark(a, x) != mark(b, x))
    keys = a["key"]

    def side(e, folder, name):
        rows = _rows(spark, folder, e, unlike)
        return rows.select(*[F.col(k).alias(f"{name}_{i}") for i, k in enumerate(keys)], _row_hash(rows, e["digest"]).alias(f"{name}_h"))

    x, y = side(a, left[0], "l"), side(b, right[0], "r")
    on = None
    for i in range(len(keys)):
        same = x[f"l_{i}"].eqNullSafe(y[f"r_{i}"])
        on = same if on is None else on & same
    told = (F.when(F.col("r_h").isNull(), F.lit("left_only")).when(F.col("l_h").isNull(), F.lit("right_only"))
            .when(F.col("l_h") != F.col("r_h"), F.lit("changed")))
    return (x.join(y, on, "full_outer").withColumn("SIDE", told).filter(F.col("SIDE").isNotNull())
            .select(*[F.coalesce(f"l_{i}", f"r_{i}").alias(k) for i, k in enumerate(keys)], "SIDE"))


def _measured(written: DataFrame, stats: Sequence[str], diverge: Sequence[str], key: Sequence[str],
              digest: Sequence[str]) -> dict[int, dict]:
    """Per bucket (at most the table's number of buckets): rows, least and largest values, a digest of
    the rows, and the columns in which closed rows differ from the open row of their key."""
    have = [c for c in stats if c in written.columns]
    texts = [F.struct(F.min(c).cast("string").alias("lo"), F.max(c).cast("string").alias("hi")).alias(f"s{i}")
             for i, c in enumerate(have)]
    hashed = _row_hash(written, [*key, *digest]) if digest else F.lit(0).cast("bigint")
    sums = [F.concat_ws(":", F.bit_xor("_h").cast("string"), F.sum(F.col("_h").cast("decimal(38,0)")).cast("string")).alias("d")]
    out = {r[BUCKET_COL]: {"n": r["n"], "stats": {c: [r[f"s{i}"]["lo"], r[f"s{i}"]["hi"]] for i, c in enumerate(have)},
                           **({"digest": r["d"]} if digest else {})}
           for r in written.withColumn("_h", hashed).groupBy(BUCKET_COL).agg(F.count(F.lit(1)).alias("n"), *texts, *sums).collect()}
    cols = [c for c in diverge if c in written.columns and "DISC_DT" in written.columns]
    if cols:
        opened = F.col("DISC_DT") == F.lit(OPEN_DATE)
        shut = ~F.coalesce(opened, F.lit(False))

        def differs(i: int) -> Column:
            some = F.col(f"a{i}") | F.coalesce(F.col(f"lo{i}") != F.col(f"v{i}"), F.lit(False)) \
                | F.coalesce(F.col(f"hi{i}") != F.col(f"v{i}"), F.lit(False))
            return F.col("_open") & F.when(F.col(f"v{i}").isNull(), F.col(f"lo{i}").isNotNull()).otherwise(some)

        per_key = written.groupBy(BUCKET_COL, *key).agg(
            F.coalesce(F.bool_or(opened), F.lit(False)).alias("_open"), *[e for i, c in enumerate(cols) for e in (
                F.max(F.when(opened, F.col(c))).alias(f"v{i}"), F.min(F.when(shut, F.col(c))).alias(f"lo{i}"),
                F.max(F.when(shut, F.col(c))).alias(f"hi{i}"),
                F.coalesce(F.bool_or(shut & F.col(c).isNull()), F.lit(False)).alias(f"a{i}"))])
        for r in per_key.groupBy(BUCKET_COL).agg(*[F.bool_or(differs(i)).alias(f"d{i}") for i in range(len(cols))]).collect():
            out[r[BUCKET_COL]]["diverged"] = {c: bool(r[f"d{i}"]) for i, c in enumerate(cols)}
    return out


# ---- writing -----------------------------------------------------------------------------

def with_bucket(df: DataFrame, key, buckets: int) -> DataFrame:
    """Add the storage bucket of each row: pmod(xxhash64(key...), buckets)."""
    keys = [key] if isinstance(key, str) else list(key)
    return df.withColumn(BUCKET_COL, F.pmod(F.xxhash64(*[F.col(k) for k in keys]), F.lit(buckets)).cast("int"))


#: DML counts that are taken while the rows are written
ACTIONS = {"rows_inserted": ("insert",), "rows_updated": ("update", "close"), "rows_deleted": ("delete",)}


def _write(df: DataFrame, table_dir: str) -> tuple[str, dict]:
    """Write rows (with BUCKET_COL and, maybe, `_action`) into a commit folder of their own. The rows
    of a bucket are brought together first, a bucket with a hot key is split again by size. The
    counts are observed behind that shuffle, in the writing tasks, each counted once."""
    commit = uuid.uuid4().hex
    action = F.col("_action") if "_action" in df.columns else F.lit("insert")
    seen = Observation()
    (df.hint("rebalance", BUCKET_COL)
     .observe(seen, F.count(F.lit(1)).alias("rows_total"),
              *[F.count(F.when(action.isin(*names), 1)).alias(n) for n, names in ACTIONS.items()])
     .drop("_action").write.mode("errorifexists").partitionBy(BUCKET_COL)
     .parquet(_join(table_dir, "_data", f"{COMMIT_COL}={commit}")))
    return commit, dict(seen.get)


def _entry(version: int, base: dict | None, commit: str, schema: T.StructType, placed: dict[int, dict],
           touched: Sequence[int], **more) -> dict:
    """The version after `commit` has replaced the buckets `touched`."""
    schema = T.StructType([T.StructField(f.name, f.dataType) for f in schema.fields])      # files may hold NULLs later
    text = json.dumps(json.loads(schema.json()), sort_keys=True)
    schemas = dict(base["schemas"]) if base else {}
    name = next((k for k, v in schemas.items() if v == text), None) or f"s{len(schemas)}"
    schemas[name] = text
    buckets = {b: x for b, x in (base["buckets"] if base else {}).items() if int(b) not in set(touched)}
    buckets |= {str(b): {"commit": commit, **x} for b, x in placed.items()}
    used = {x["commit"] for x in buckets.values()}
    commits = {c: s for c, s in ((base["commits"] if base else {}) | {commit: name}).items() if c in used}
    return {**(base or {}), "version": version, "at": _dt.datetime.now(_dt.timezone.utc).replace(tzinfo=None).isoformat(),
            "schema": name, "schemas": schemas, "commits": commits, "buckets": buckets, "touched": sorted(touched), **more}


def create(df: DataFrame, table_dir: str, key, buckets: int, stats: Sequence[str] = (), diverge: Sequence[str] = (),
           digest: Sequence[str] = (), stream: str | None = None, epoch: int | None = None) -> dict:
    """Write a table's first version, or replace all of its rows by `df` in one commit. `stats`,
    `diverge` and `digest` name the columns whose statistics, divergence and digests are kept from
    then on."""
    spark = df.sparkSession
    keys = [key] if isinstance(key, str) else list(key)
    df = df.drop(BUCKET_COL, "_action")
    commit, counts = _write(with_bucket(df, keys, buckets), table_dir)
    own = T.StructType([*df.schema.fields, T.StructField(BUCKET_COL, T.IntegerType())])
    placed = _measured(spark.read.schema(own).parquet(_join(table_dir, "_data", f"{COMMIT_COL}={commit}")), stats, diverge, keys, digest)
    while True:
        old = head(spark, table_dir)
        epochs = (old["epochs"] if old else {}) | ({stream: epoch} if stream else {})
        entry = _entry(old["version"] + 1 if old else 0, None, commit, df.schema, placed, [], key=keys, n_buckets=buckets,
                       stats=list(stats), diverge=list(diverge), digest=list(digest), epochs=epochs, counts=counts)
        if _publish(spark, table_dir, entry):
            return entry


def rewrite(spark: SparkSession, table_dir: str, source: DataFrame, merge_fn: Callable, key=None, buckets: int | None = None,
            extra_keys: DataFrame | None = None, pre: Callable | None = None, also: Callable | None = None,
            diverge: Sequence[str] = (), retries: int = 3, stream: str | None = None,
            epoch: int | None = None) -> dict | None:
    """Apply `merge_fn(current_rows, staged_source) -> new_rows` to the buckets a batch touches, in
    one commit. Returns the version's entry (its `counts` are the DML counts of the rewritten
    buckets), or None if the batch touches nothing.

    The batch is staged once; its distinct buckets (at most the table's number of buckets) choose the
    folders to read. The columns and types that `merge_fn` returns are the table's from then on; the
    other buckets are read under them. `extra_keys` (a frame with the key columns) adds buckets, `pre(current)`
    transforms the touched rows before the merge, and `also(current, staged, entry)` names further
    buckets and a step `rows -> rows` that follows the merge there and on the touched ones.
    `diverge` adds columns to those whose divergence is kept."""
    from tidemark.sources.sinks import cut_lineage
    first = head(spark, table_dir)
    if first is None:
        raise ValueError(f"no bucketed table at {table_dir}")
    keys = [key] if isinstance(key, str) else list(key or first["key"])
    n = buckets or first["n_buckets"]
    if keys != first["key"] or n != first["n_buckets"]:
        raise ValueError(f"the table is bucketed by {first['key']} into {first['n_buckets']}, not by {keys} into {n}")
    staged = cut_lineage(with_bucket(source, keys, n))
    ids = staged.select(BUCKET_COL)
    if extra_keys is not None:
        ids = ids.unionByName(with_bucket(extra_keys.select(*keys), keys, n).select(BUCKET_COL))
    own = sorted(r[0] for r in ids.distinct().collect())
    if not own:
        return None
    for _ in range(retries + 1):
        base = head(spark, table_dir)
        current, batch = _rows(spark, table_dir, base, own).drop(BUCKET_COL), staged.drop(BUCKET_COL)
        more, after = also(current, batch, base) if also else ((), None)
        more = sorted(set(more) - set(own))
        merged = merge_fn(pre(current) if pre else current, batch)
        if more:
            rest = _cast(_rows(spark, table_dir, base, more), T.StructType([f for f in merged.schema.fields if f.name != "_action"]))
            merged = merged.unionByName(rest.drop(BUCKET_COL).withColumn("_action", F.lit("unchanged")))
        if after:
            merged = after(merged)
        commit, counts = _write(with_bucket(merged, keys, n), table_dir)
        schema = T.StructType([f for f in merged.schema.fields if f.name != "_action"])
        written = spark.read.schema(T.StructType([*schema.fields, T.StructField(BUCKET_COL, T.IntegerType())])).parquet(
            _join(table_dir, "_data", f"{COMMIT_COL}={commit}"))
        kept = list(dict.fromkeys([*base["diverge"], *diverge]))
        placed = _measured(written, base["stats"], kept, keys, base["digest"])
        touched = sorted({*own, *more})
        while True:
            epochs = base["epochs"] | ({stream: epoch} if stream else {})
            entry = _entry(base["version"] + 1, base, commit, schema, placed, touched, epochs=epochs, counts=counts, diverge=kept)
            if _publish(spark, table_dir, entry):
                return entry
            now = head(spark, table_dir)
            others = [_load(spark, table_dir, v) for v in range(base["version"] + 1, now["version"] + 1)]
            # a version without `touched` replaced everything; a changed schema changes what to write
            if any(not o["touched"] or set(o["touched"]) & set(touched) or o["schema"] != base["schema"] for o in others):
                break
            base = now
    raise CommitConflict(f"{table_dir}: other writers changed the buckets of this batch {retries + 1} times")


def vacuum(spark: SparkSession, table_dir: str, keep: int = 2, older_than: _dt.timedelta = _dt.timedelta(hours=1)) -> int:
    """Delete version files but the `keep` newest, and the commit folders that none of those names and
    that are older than `older_than` (a running merge writes a folder before its version exists).
    The number of folders deleted."""
    known = _versions(spark, table_dir)
    if not known or keep < 1:
        return 0
    named = {b["commit"] for v in known[-keep:] for b in _load(spark, table_dir, v)["buckets"].values()}
    limit = _dt.datetime.now().timestamp() - older_than.total_seconds()
    for v in known[:-keep]:
        fs, path = _fs(spark, _join(table_dir, "_commits", f"{v:012d}.json"))
        fs.delete(path, False)
    fs, data = _fs(spark, _join(table_dir, "_data"))
    gone = [s.getPath() for s in fs.listStatus(data) if s.getPath().getName().split("=")[-1] not in named
            and s.getModificationTime() / 1000 < limit]
    for p in gone:
        fs.delete(p, True)
    return len(gone)
