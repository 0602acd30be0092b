"""Streaming queries: clean, process and store in one pass, running statistics, live views."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from fleetgauge.operators import clean, process, stats
from fleetgauge.operators.fanout import fan_out
from fleetgauge.operators.ordered import MAX_GROUP_ROWS
from fleetgauge.operators.recent import newer_only
from fleetgauge.sources.keyed import KeyedTable, latest_wins
from fleetgauge.sources.store import Store
from fleetgauge.sources.table import write_batch


def clean_and_process(messages: DataFrame, config: DataFrame, validate: bool = True) -> DataFrame:
    """Messages to scored rows in one narrow stage; refused messages keep their reason and the outcome ``error``."""
    cleaned = clean.clean_messages(messages, validate=validate).drop("processed_at")
    marked = cleaned.withColumn("type_error", F.col("type_error") | F.col("reject_reason").isNotNull())
    return process.process_readings(marked, config)


def start(stream: DataFrame, checkpoint: str, on_batch, once: bool = False, name: str | None = None) -> StreamingQuery:
    """Run ``on_batch(rows, batch_id)`` per micro-batch; ``once`` stops after what is there now."""
    writer = stream.writeStream.option("checkpointLocation", checkpoint).foreachBatch(on_batch)
    if name:
        writer = writer.queryName(name)
    return (writer.trigger(availableNow=True) if once else writer).start()


def start_pipeline(
    messages: DataFrame, config: DataFrame, checkpoint: str, store: str, rejects: str | None = None,
    alerts: str | None = None, outcomes: str | None = None, validate: bool = True, once: bool = False,
) -> StreamingQuery:
    """Clean, process and store a message stream.

    Each micro-batch is computed once and written to: the readings table, refused messages, anomalous rows and
    outcome counts. Every write replaces the folder of its batch, so a repeated batch leaves no duplicates.
    """

    def write(rows: DataFrame, batch_id: int) -> None:
        rows = rows.persist()
        try:
            write_batch(process.for_store(process.published(rows)), store, batch_id)
            if rejects:
                refused = rows.filter(F.col("outcome") == "error").select(
                    "value", "arrival_seq", "ingest_ts", F.coalesce("reject_reason", F.lit("invalid record")).alias("reason")
                )
                write_batch(refused, rejects, batch_id, ("batch_id",))
            if alerts:
                write_batch(process.for_store(process.alerts(rows)), alerts, batch_id)
            if outcomes:
                counts = rows.groupBy("tenant_id", "outcome").agg(F.count(F.lit(1)).alias("messages"))
                write_batch(counts, outcomes, batch_id, ("batch_id",))
        finally:
            rows.unpersist()

    return start(clean_and_process(messages, config, validate), checkpoint, write, once)


def start_store(messages: DataFrame, config: DataFrame, checkpoint: str, store: Store, validate: bool = True, once: bool = False) -> StreamingQuery:
    """Clean, process and append a message stream to a versioned store, each micro-batch once, also after compactions."""

    def append(rows: DataFrame, batch_id: int) -> None:
        store.append(process.for_store(process.published(rows)), batch_id, "stream")

    return start(clean_and_process(messages, config, validate), checkpoint, append, once)


def running_global_stats(processed: DataFrame) -> DataFrame:
    """Global statistics as a stateful aggregate; write it in ``complete`` or ``update`` mode."""
    return stats.global_stats(processed)


def start_fan_out(rows: DataFrame, subscribers: DataFrame, checkpoint: str, path: str, once: bool = False) -> StreamingQuery:
    """Deliver each row to its viewers' folder."""

    def deliver(batch: DataFrame, batch_id: int) -> None:
        write_batch(fan_out(batch, subscribers), path, batch_id, ("subscriber_id", "batch_id"))

    return start(rows, checkpoint, deliver, once)


def start_newer_only(
    rows: DataFrame, checkpoint: str, path: str, newest_path: str, keys: tuple[str, ...] = ("tenant_id",),
    seq: str = "arrival_seq", ts: str = "ts", once: bool = False, max_rows: int = MAX_GROUP_ROWS,
) -> StreamingQuery:
    """Keep rows newer than all earlier ones of their group, across micro-batches.

    The newest time per group is a keyed table, of which a micro-batch reads and writes the buckets of its groups; the batch
    itself is filtered like a table, so a busy group is cut in chunks instead of passing through one state.
    """
    named = [f"`{k}` {rows.schema[k].dataType.simpleString()}" for k in keys]
    schema = ", ".join([*named, f"newest {rows.schema[ts].dataType.simpleString()}"])

    def keep(batch: DataFrame, batch_id: int) -> None:
        table = KeyedTable(batch.sparkSession, newest_path, schema, keys)
        if table.committed(batch_id):
            return
        batch = batch.persist()
        try:
            here = batch.groupBy(*keys).agg(F.max(ts).alias("newest")).filter(F.col("newest").isNotNull())
            buckets = [r["_bucket"] for r in table.bucketed(here).select("_bucket").distinct().collect()]
            before = table.read(buckets=buckets)
            fresh = newer_only(batch, keys, seq, ts, max_rows)
            known = before.select(*[F.col(k).alias(f"_known_{k}") for k in keys], F.col("newest").alias("_seen"))
            same = [fresh[k].eqNullSafe(known[f"_known_{k}"]) for k in keys]
            kept = fresh.join(known, same, "left").filter(F.col("_seen").isNull() | (F.col(ts) > F.col("_seen")))
            write_batch(kept.select(*batch.columns), path, batch_id, ("batch_id",))
            table.upsert(here, batch_id, latest_wins(keys, "newest"))
        finally:
            batch.unpersist()

    return start(rows, checkpoint, keep, once)

