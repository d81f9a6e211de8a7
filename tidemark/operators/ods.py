"""Loading an ODS table from a change log, snapshots or an API extract.

One function for the three kinds; a `OdsLoad` says how they differ:
  change log   rows since the target's watermark less an overlap are resolved to the latest image
               per key, keys renamed away are tombstoned first
  snapshot     rows of the loads since the watermark, latest per key, and keys absent from the
               latest load are marked as deleted after the merge
  API extract  rows from the watermark on, latest per key
The target is expected to be a stored table: its watermark and the merge both read it.
"""

from __future__ import annotations

import datetime as _dt
from collections.abc import Callable, Sequence
from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.functions.literals import lit
from tidemark.operators.delta import watermark_value
from tidemark.operators.merge import ACTION, drop_action, mark_deleted, merge_upsert, tombstone_renamed


@dataclass(frozen=True)
class OdsLoad:
    """key: the target's key. resolve(rows): the latest row per key. shape(rows, batch, run_ts):
    the target's columns with lineage and hashes. source_ts / target_ts: the columns of the
    watermark; a row counts from the mark less `overlap_minutes` on (`strict`: after it).
    renamed_keys(rows): target keys renamed away (change logs). snapshot_keys: keys compared with
    the latest load, whose stamp is `source_ts` (snapshots)."""
    key: str
    resolve: Callable[[DataFrame], DataFrame]
    shape: Callable[[DataFrame, int, _dt.datetime], DataFrame]
    source_ts: str
    target_ts: str
    overlap_minutes: int = 3
    strict: bool = False
    no_update: Sequence[str] = ()
    gate: str | None = "HASH_CHANGE"
    renamed_keys: Callable[[DataFrame], DataFrame] | None = None
    snapshot_keys: Sequence[str] = ()


def since_mark(load: OdsLoad, source: DataFrame, target: DataFrame) -> DataFrame:
    """The source rows that the target's watermark leaves to be loaded."""
    mark = lit(watermark_value(target, load.target_ts, load.overlap_minutes))
    ts = F.col(load.source_ts)
    return source.filter(ts > mark if load.strict else ts >= mark)


def load_ods(load: OdsLoad, source: DataFrame, target: DataFrame | None, batch: int,
             run_ts: _dt.datetime) -> DataFrame:
    """The new target with `_action` (insert / update / unchanged); for snapshots the actions of
    the merge are in MERGE_ACTION and those of the delete marking in `_action`."""
    if target is None:
        return load.shape(load.resolve(source), batch, run_ts).withColumn(ACTION, F.lit("insert"))
    new = since_mark(load, source, target)
    current = target
    if load.renamed_keys is not None:
        current = drop_action(tombstone_renamed(target, load.renamed_keys(new), load.key, run_ts, batch))
    rows = load.shape(load.resolve(new), batch, run_ts)
    merged = merge_upsert(current, rows, load.key, no_update=load.no_update, gate=load.gate)
    if not load.snapshot_keys:
        return merged
    # delete marking runs on the written table: it takes the maxima of what the merge left
    from tidemark.sources.sinks import cut_lineage
    merged = cut_lineage(merged.withColumnRenamed(ACTION, "MERGE_ACTION"))
    return mark_deleted(merged, source, list(load.snapshot_keys), load.source_ts)
