"""Watermark deltas and changed-key sets.

The watermark is a one-row global aggregate of the target. `delta` evaluates it once
and filters the source with a literal, which lets Parquet skip row groups by their
min/max statistics (the reference inlines the same literal at compile time).
`delta_lazy` keeps it inside the plan as an attached scalar instead.
"""

from __future__ import annotations

import datetime as _dt
from collections.abc import Sequence
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.functions.literals import lit
from tidemark.operators.joins import attach_scalar

DEFAULT_MARK = _dt.datetime(1900, 1, 1)


def watermark_value(target: DataFrame | None, tgt_ts: str, overlap_minutes: int = 3,
                    default=DEFAULT_MARK):
    """max(target.tgt_ts) - overlap, or `default` when the target is absent or empty."""
    if target is None:
        return default
    row = target.agg(F.max(tgt_ts).alias("m")).first()
    if row is None or row["m"] is None:
        return default
    m = row["m"]
    if isinstance(m, _dt.datetime):
        return m - _dt.timedelta(minutes=overlap_minutes)
    return m


def delta(source: DataFrame, target: DataFrame | None, src_ts: str, tgt_ts: str,
          overlap_minutes: int = 3, strict: bool = False, default=DEFAULT_MARK) -> DataFrame:
    """Rows of `source` at or past the target's watermark (P18); strict uses `>`."""
    mark = watermark_value(target, tgt_ts, overlap_minutes, default)
    c = F.col(src_ts)
    return source.filter(c > lit(mark) if strict else c >= lit(mark))


def delta_lazy(source: DataFrame, target: DataFrame, src_ts: str, tgt_ts: str,
               overlap_minutes: int = 3, strict: bool = False, default=DEFAULT_MARK) -> DataFrame:
    """Same as `delta` but with the watermark kept in the plan as a one-row scalar."""
    mark = target.agg(F.coalesce(F.max(tgt_ts) - F.expr(f"INTERVAL {int(overlap_minutes)} MINUTES"),
                                 lit(default)).alias("_mark"))
    c = F.col(src_ts)
    j = attach_scalar(source, mark)
    return j.filter(c > F.col("_mark") if strict else c >= F.col("_mark")).drop("_mark")


def delta_any(joined: DataFrame, marks: Sequence[tuple[str, object]]) -> DataFrame:
    """Keep a joined row if any side is newer than its own mark.
    Each mark names its own (source column, literal mark) pair (trap T17)."""
    preds = [F.coalesce(F.col(c) > lit(m), F.lit(False)) for c, m in marks]
    return joined.filter(reduce(lambda a, b: a | b, preds))


ALL_ROWS = object()   # a changed-key branch without a watermark: every row counts


def target_mark(target: DataFrame, col: str) -> Column:
    """`(SELECT MAX(col) FROM target)` as a scalar subquery: evaluated once, no join."""
    return target.agg(F.max(col)).scalar()


@dataclass
class KeySource:
    """One branch of a changed-key union: a source, its key expressions (aliased to
    the output key names), its update column and its mark: a literal, a Column such as
    `target_mark(target, col)` (the target column holding this source's watermark),
    None (no mark known), or ALL_ROWS (the branch has no watermark)."""
    df: DataFrame
    keys: Sequence[Column]
    ts: str | None
    mark: object
    bridge: tuple[DataFrame, Sequence[str]] | None = None


def changed_keys(branches: Sequence[KeySource], strict: bool = True) -> DataFrame:
    """UNION DISTINCT of the keys each source changed past its own watermark (K1).
    A branch with a bridge maps its rows to the output key through a join first.
    A NULL mark selects nothing in strict mode (the reference's `> (SELECT MAX ...)`
    against an empty target). The distinct is a partial aggregation, so each branch
    ships at most one row per key and map task."""
    parts = []
    for b in branches:
        if b.mark is ALL_ROWS:
            parts.append((b.df.join(b.bridge[0], list(b.bridge[1]), "inner") if b.bridge else b.df).select(*b.keys))
            continue
        c = F.col(b.ts)
        if b.mark is None:
            pred = F.lit(False) if strict else F.lit(True)
        else:
            m = lit(b.mark)
            pred = F.coalesce(c > m if strict else c >= m, F.lit(False))
        rows = b.df.filter(pred)
        if b.bridge is not None:
            bdf, on = b.bridge
            rows = rows.join(bdf, list(on), "inner")
        parts.append(rows.select(*b.keys))
    return reduce(lambda a, b: a.unionByName(b), parts).distinct()


def incremental_star(driving: DataFrame, sources: Sequence[tuple[DataFrame, Sequence[str]]],
                     keys: DataFrame, key_cols: Sequence[str], stage_keys: bool = True) -> DataFrame:
    """Semi-join the driving table and each source to the changed keys, then star LEFT
    JOIN on the key (K2). stage_keys=True writes the key set once (a key-only table in the
    shared checkpoint folder) since every branch reads it; its real size then decides
    whether the semi joins broadcast it. It is never broadcast on an estimate."""
    if stage_keys:
        from tidemark.sources.sinks import cut_lineage
        keys = cut_lineage(keys)
    drv = driving.join(keys, list(key_cols), "left_semi")
    out = drv
    for src, on in sources:
        out = out.join(src.join(keys, list(key_cols), "left_semi"), list(on), "left")
    return out


def with_reprocess(delta_keys: DataFrame, target: DataFrame, key: str, lookup_col: str,
                   lookup: DataFrame, lookup_key: str, target_lookup_key: str) -> DataFrame:
    """Enrichment retry (K3): keys from the delta (NEW) plus target keys whose lookup
    column is still NULL while the lookup now has a row for them (REPROCESS).
    A key in both is kept once, tagged NEW (trap T9)."""
    new = delta_keys.select(key).distinct().withColumn("PROCESS_TYPE", F.lit("NEW"))
    pending = (target.filter(F.col(lookup_col).isNull())
               .join(lookup.select(F.col(lookup_key).alias(target_lookup_key)).distinct(),
                     target_lookup_key, "left_semi")
               .select(key).distinct()
               .join(new.select(key), key, "left_anti")
               .withColumn("PROCESS_TYPE", F.lit("REPROCESS")))
    return new.unionByName(pending)


def enrich_with_retry(source: DataFrame, keys: DataFrame, key: str, lookup: DataFrame, source_lookup_key: str,
                      lookup_key: str, lookup_cols: Sequence[str], lineage: str = "LINEAGE",
                      names: tuple[str, str] = ("source", "lookup")) -> DataFrame:
    """Second half of the enrichment retry (K3): the keys of `with_reprocess` go back to the
    source for their rows, which are enriched again. The lookup's key may differ from the
    target's; NULL lookup keys match nothing. `lineage` names both tables where the lookup
    matched, only the source where it did not (P25)."""
    lk = lookup.select(F.col(lookup_key).alias("_lk"), *lookup_cols, F.lit(True).alias("_hit"))
    rows = source.join(keys.select(key, "PROCESS_TYPE"), key)
    out = rows.join(lk, rows[source_lookup_key] == lk["_lk"], "left")
    text = F.concat(F.lit(names[0]), F.when(F.col("_hit"), F.lit("," + names[1])).otherwise(F.lit("")))
    return out.select(*source.columns, *lookup_cols, "PROCESS_TYPE", text.alias(lineage))
