"""Micro-batch CDC driver: readStream -> foreachBatch(resolve -> upsert) -> staged table.

The reference polls its change log every 30 minutes and keeps a 3-minute overlap; the
Spark form is a Structured Streaming query over the landed log files:

  * each micro-batch is resolved with `cdc_resolve` (latest image per key, renamed-away
    keys removed), shaped by the caller's `transform`, and upserted into the current
    version of the target with `merge_upsert` (hash gated);
  * the new target version is written to a fresh directory and published through the
    table's versions log (`write_staged`), so a failed batch leaves the previous version intact;
  * the batch id used for lineage columns is derived from the epoch id, so a replayed epoch
    (after an executor or driver loss) produces the same rows. A version records its epoch, in
    the versions log or in the bucket commit, and an epoch that is published already is skipped. With
    `order_cols` (capture time and log id as target columns), rows and renames older than the
    target row change nothing, so a log file that lands late cannot bring back an older image.
  * `overlap` (say "3 minutes") is the reference's overlap between polls: log rows that come twice
    within it are dropped by their log id before they reach a batch, with bounded state. Rows
    later than that behind the newest capture time are dropped too, as the poll does; without
    `overlap` every row is taken.
The query checkpoint lives in the shared checkpoint folder, never on local disk.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery
from pyspark.sql.types import StructType

from tidemark.operators.dedup import cdc_resolve
from tidemark.operators.merge import drop_action, merge_upsert, tombstone_renamed
from tidemark.session import checkpoint_dir
from tidemark.sources import commits
from tidemark.sources.sinks import last_epoch, read_current, upsert_bucketed, write_bucketed, write_staged


def start_cdc_stream(spark: SparkSession, source_dir: str, schema: StructType, target_dir: str,
                     keys: Sequence[str], before_keys: Sequence[str], ts: str, log_id: str,
                     change_flag: Callable[[], Column], transform: Callable[[DataFrame, int], DataFrame],
                     merge_key: str, no_update: Sequence[str] = (), gate: str | None = "HASH_CHANGE",
                     name: str = "cdc", available_now: bool = True,
                     processing_time: str | None = None,
                     renamed_keys: Callable[[DataFrame], DataFrame] | None = None,
                     tombstone_ts: Callable[[int], object] | None = None,
                     buckets: int | None = 64, order_cols: Sequence[str] = (),
                     overlap: str | None = None) -> StreamingQuery:
    """Start the streaming load. `transform(resolved, batch_id)` shapes resolved log rows
    into target rows (keys, attributes, lineage and hash columns).

    `renamed_keys(batch)` (optional) maps the batch's PK-change records to target keys
    (column `merge_key`); those target rows are tombstoned before the upsert, like the
    reference's pre-hook (C6). `tombstone_ts(batch_id)` gives the load time written on
    them.

    buckets=N (default) stores the target partitioned by key bucket (sinks.write_bucketed) and
    rewrites only the buckets a micro-batch touches (sinks.upsert_bucketed); buckets=None
    publishes a full new version per batch, for readers that need one whole version.

    `order_cols` names the target columns that hold the capture time and the log id, in this
    order; `renamed_keys` then returns them too. Without them a late older file wins."""
    ckpt = checkpoint_dir(spark).rstrip("/") + f"/stream-{name}"

    def apply_batch(batch: DataFrame, epoch_id: int) -> None:
        if batch.isEmpty():
            return
        done = (commits.last_epoch if buckets else last_epoch)(batch.sparkSession, target_dir, name)
        if done is not None and epoch_id <= done:
            return                           # published before the driver was lost
        resolved = cdc_resolve(batch, list(keys), list(before_keys), ts, log_id, change_flag())
        rows = transform(resolved, int(epoch_id))
        if buckets:
            _apply_bucketed(batch, rows, int(epoch_id))
            return
        current = read_current(batch.sparkSession, target_dir)
        if current is not None and renamed_keys is not None:
            # deterministic per epoch (a replay writes the same values): the caller's load
            # time, else the batch's latest capture time (one-row aggregate)
            load_ts = (tombstone_ts(int(epoch_id)) if tombstone_ts
                       else batch.agg(F.max(ts)).first()[0])
            current = drop_action(tombstone_renamed(current, renamed_keys(batch), merge_key, load_ts,
                                                    int(epoch_id), order_cols))
        new = rows if current is None else drop_action(
            merge_upsert(current, rows, merge_key, no_update=no_update, gate=gate, order_cols=order_cols))
        write_staged(new, target_dir, stream=name, epoch=int(epoch_id))

    def _apply_bucketed(batch: DataFrame, rows: DataFrame, epoch: int) -> None:
        sess = batch.sparkSession
        if commits.head(sess, target_dir) is None:
            write_bucketed(rows, target_dir, merge_key, buckets, stream=name, epoch=epoch)
            return
        extra, pre = None, None
        if renamed_keys is not None:
            extra = renamed_keys(batch)
            load_ts = tombstone_ts(epoch) if tombstone_ts else batch.agg(F.max(ts)).first()[0]

            def pre(cur):
                return drop_action(tombstone_renamed(cur, extra, merge_key, load_ts, epoch, order_cols))
        upsert_bucketed(sess, target_dir, rows, merge_key, buckets, extra_keys=extra, pre=pre,
                        stream=name, epoch=epoch, no_update=no_update, gate=gate, order_cols=order_cols)

    rows = spark.readStream.schema(schema).parquet(source_dir)
    if overlap:
        # a watermark needs an instant; only differences between capture times matter here
        rows = (rows.withColumn("_event_time", F.col(ts).cast("timestamp")).withWatermark("_event_time", overlap)
                .dropDuplicatesWithinWatermark([log_id]).drop("_event_time"))
    writer = (rows.writeStream.queryName(name).foreachBatch(apply_batch)
              .option("checkpointLocation", ckpt))
    if available_now:
        writer = writer.trigger(availableNow=True)
    elif processing_time:
        writer = writer.trigger(processingTime=processing_time)
    return writer.start()
