"""Registered queries that run as streams over the whole events table and must end up with the batch result."""

from __future__ import annotations

import uuid

from pyspark.sql import functions as F

from fleetgauge import schemas
from fleetgauge.operators import monitor, process, usage
from fleetgauge.operators.fanout import subscribers_with_default
from fleetgauge.plans import data, lifecycle, monitoring, statistics
from fleetgauge.plans.registry import ORACLE, query
from fleetgauge.session import shared_dir
from fleetgauge.sources import table
from fleetgauge.streaming import feeds, pipeline, state, windows


def _events(spark, sf_dir):
    schema = spark.read.parquet(f"{sf_dir}/events.parquet").schema
    # A pattern takes a single file and a folder of part files alike; a plain path must be a folder.
    return spark.readStream.schema(schema).parquet(f"{sf_dir}/events.parque[t]")


def _folder(spark) -> str:
    return f"{shared_dir(spark)}/fleetgauge-{uuid.uuid4().hex}"


def _scored(spark, sf_dir):
    rows = data.readings_of(_events(spark, sf_dir))
    return data.plain(process.process_readings(rows, schemas.tenant_config(spark), now=F.col("ts")))


@query(data.on_clean("""
SELECT arrival_seq AS row_key, device_id, temperature, humidity, is_anomaly, anomaly_score, tenant_id,
  date_trunc('second', ingest_ts) AS created_at, CAST(ingest_ts AS DATE) AS created_date,
  date_trunc('second', coalesce(CAST(replace(replace(timestamp_text, 'T', ' '), 'Z', '') AS TIMESTAMP), ingest_ts))
    AS timestamp
FROM pipeline WHERE outcome IN ('normal', 'anomaly')""", data.PIPELINE))
def stream_store(spark, sf_dir):
    """Raw text through clean, process and store; the result is the stored table."""
    out = _folder(spark)
    messages = data.raw_messages_of(data.readings_of(_events(spark, sf_dir)))
    run = pipeline.start_pipeline(
        messages, schemas.tenant_config(spark), f"{out}/checkpoint", f"{out}/table", f"{out}/rejects", once=True
    )
    run.awaitTermination()
    return table.read_table(spark, f"{out}/table")


@query(data.on_processed(
    """SELECT tenant_id, device_id, metric, count, total / count AS avg, min, max, last_seen,
  unnest(readings) AS reading, generate_subscripts(readings, 1) - 1 AS position
FROM (SELECT *, list_reduce(list_reverse(readings), lambda a, x: a + x) AS total FROM (
  SELECT tenant_id, device_id, metric, count(*) AS count, list(CAST(value AS DOUBLE) ORDER BY arrival_seq) AS readings,
    CAST(min(value) AS DOUBLE) AS min, CAST(max(value) AS DOUBLE) AS max, arg_max(ts, arrival_seq) AS last_seen
  FROM last GROUP BY tenant_id, device_id, metric))""",
    statistics._LONG.replace("FROM stored", "FROM exact").replace("arrival_seq,", "arrival_seq, ts,"),
    statistics._LAST.format("tenant_id, device_id"),
))
def stream_device_state(spark, sf_dir):
    """Per-device windows kept as streaming state, read back from the written changes."""
    out = _folder(spark)
    changes = state.device_state(data.readings_of(_events(spark, sf_dir)))

    def write(rows, batch_id):
        table.write_batch(rows, f"{out}/state", batch_id, ("batch_id",))

    run = (
        changes.writeStream.outputMode("update").option("checkpointLocation", f"{out}/checkpoint")
        .foreachBatch(write).trigger(availableNow=True).start()
    )
    run.awaitTermination()
    parts = state.newest_parts(spark.read.parquet(f"{out}/state"))
    merged = state.merge_device_state(parts)
    return merged.select(
        "tenant_id", "device_id", "metric", "count", "avg", "min", "max", "last_seen",
        F.posexplode("readings").alias("position", "reading"),
    ).withColumn("position", F.col("position").cast("bigint"))


@query(data.on_processed(" UNION ALL ".join(statistics._global(m) for m in schemas.METRICS)))
def stream_global_stats(spark, sf_dir):
    """Global statistics as a stateful aggregate."""
    out = _folder(spark)
    running = pipeline.running_global_stats(data.exact(process.published(_scored(spark, sf_dir))))

    def write(rows, batch_id):
        table.write_batch(rows, f"{out}/stats", batch_id, ("batch_id",))

    run = (
        running.writeStream.outputMode("complete").option("checkpointLocation", f"{out}/checkpoint")
        .foreachBatch(write).trigger(availableNow=True).start()
    )
    run.awaitTermination()
    versions = spark.read.parquet(f"{out}/stats")
    newest = versions.groupBy("metric").agg(F.max_by(F.struct("count", "sum", "min", "max", "avg"), "batch_id").alias("s"))
    return data.plain(newest.select("metric", "s.*"))


@query(data.on_processed("""
SELECT s.subscriber_id, r.arrival_seq, r.tenant_id FROM stored r
JOIN subscribers s ON s.tenant_id = r.tenant_id OR s.tenant_id = 'all'""", data.SUBSCRIBERS))
def stream_fanout(spark, sf_dir):
    """Rows delivered to their viewers' folders."""
    out = _folder(spark)
    rows = process.published(_scored(spark, sf_dir)).select("arrival_seq", "tenant_id")
    viewers = subscribers_with_default(data.subscribers(spark, sf_dir))
    pipeline.start_fan_out(rows, viewers, f"{out}/checkpoint", f"{out}/delivered", once=True).awaitTermination()
    return spark.read.parquet(f"{out}/delivered").select("subscriber_id", "arrival_seq", "tenant_id")


@query(data.on_processed("""
SELECT arrival_seq, tenant_id, measured_at FROM (
  SELECT *, max(measured_at) OVER (PARTITION BY tenant_id ORDER BY arrival_seq ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)
    AS newest FROM stored)
WHERE newest IS NULL OR measured_at > newest"""))
def stream_newer_only(spark, sf_dir):
    """Late points dropped across micro-batches."""
    out = _folder(spark)
    rows = process.published(_scored(spark, sf_dir)).select("arrival_seq", "tenant_id", "measured_at")
    pipeline.start_newer_only(
        rows, f"{out}/checkpoint", f"{out}/kept", f"{out}/newest", ts="measured_at", once=True
    ).awaitTermination()
    return spark.read.parquet(f"{out}/kept").select("arrival_seq", "tenant_id", "measured_at")


def _fed(spark, rows, part, parts, out, run):
    """The rows come in several files, chosen by ``part``; the query is started anew for each and goes on where it was."""
    kept = f"{out}/rows"
    rows.withColumn("_part", part.cast("int")).write.partitionBy("_part").parquet(kept)
    for i in range(parts):
        spark.read.schema(f"{feeds.ddl(rows, rows.columns)}, _part INT").parquet(kept).filter(F.col("_part") == i).drop("_part").write.mode(
            "append").parquet(f"{out}/live")
        run(spark.readStream.schema(rows.schema).parquet(f"{out}/live")).awaitTermination()


def _thirds(ts):
    """First, second and last ten days; every 17th row comes one part later than its time says."""
    day = F.dayofyear(ts)
    own = F.when(day <= 10, 0).when(day <= 20, 1).otherwise(2)
    return F.least(own + F.when(F.col("arrival_seq") % 17 == 0, 1).otherwise(0), F.lit(2))


def _window_counts(spark, sf_dir, keys, seconds, rows):
    out = _folder(spark)
    names = tuple(keys)
    _fed(spark, rows.select("arrival_seq", "ts", *names), _thirds(F.col("ts")), 3, out, lambda stream: windows.start_window_counts(
        stream, f"{out}/checkpoint", f"{out}/counts", names, "ts", seconds, 86_400, once=True))
    return windows.window_counts(spark, f"{out}/counts", keys)


@query(ORACLE["rate_limit_minutes"])
def stream_minute_usage(spark, sf_dir):
    """Messages per tenant and minute of event time, on a stream with restarts and rows that come days late."""
    counts = _window_counts(spark, sf_dir, {"tenant_id": "STRING"}, 60, process.published(data.processed(spark, sf_dir)))
    return usage.rate_of_minutes(counts.withColumnRenamed("window_start", "minute"), lifecycle._limits(spark, sf_dir))


@query(ORACLE["daily_quota"])
def stream_daily_quota(spark, sf_dir):
    """Daily and monthly usage against the quota, from hourly windows of a stream."""
    counts = _window_counts(spark, sf_dir, {"tenant_id": "STRING"}, 3600, process.published(data.processed(spark, sf_dir)))
    daily = counts.groupBy("tenant_id", F.to_date("window_start").alias("day")).agg(F.sum("messages").alias("daily_usage"))
    return usage.quota_of_days(daily, lifecycle._limits(spark, sf_dir))


@query(data.on_processed("""
SELECT tenant_id, outcome, date_trunc('hour', ts) AS window_start, count(*) AS messages FROM processed GROUP BY ALL"""))
def stream_outcome_hours(spark, sf_dir):
    """Messages per tenant, outcome and hour of event time."""
    return _window_counts(spark, sf_dir, {"tenant_id": "STRING", "outcome": "STRING"}, 3600, data.processed(spark, sf_dir))


@query(ORACLE["stream_device_state"])
def stream_device_windows(spark, sf_dir):
    """Per-device windows as expiring list and value state, read from the state of the last micro-batch."""
    out = _folder(spark)
    rows = state.device_windows(data.readings_of(_events(spark, sf_dir)), idle_ms=7 * 86_400_000)
    state.start_windows(rows, f"{out}/checkpoint", once=True).awaitTermination()
    merged = state.merge_device_state(state.device_windows_now(spark, f"{out}/checkpoint"))
    return merged.select(
        "tenant_id", "device_id", "metric", "count", "avg", "min", "max", "last_seen",
        F.posexplode("readings").alias("position", "reading"),
    ).withColumn("position", F.col("position").cast("bigint"))


@query(ORACLE["device_rolling"])
def stream_device_rolling(spark, sf_dir):
    """The statistics of its device right after each reading, across micro-batches."""
    out = _folder(spark)
    rows = data.stored(spark, sf_dir).select("arrival_seq", "tenant_id", "device_id", "ts", *schemas.METRICS)
    kept = feeds.rolling_table(spark, f"{out}/state", value="DECIMAL(18,4)")
    day = F.dayofyear("ts")
    _fed(spark, rows, F.when(day <= 10, 0).when(day <= 20, 1).otherwise(2), 3, out, lambda stream: feeds.start_device_rolling(
        stream, f"{out}/checkpoint", kept, f"{out}/rolling", once=True))
    return data.plain(spark.read.parquet(f"{out}/rolling").drop("batch_id"))


@query(ORACLE["tenant_changes"])
def stream_tenant_changes(spark, sf_dir):
    """The change feed in three parts, out of order, folded in a keyed table."""
    out = _folder(spark)
    kept = feeds.tenant_changes_table(spark, f"{out}/state")
    _fed(spark, lifecycle.changes(spark, sf_dir), F.pmod(F.xxhash64("change_seq"), F.lit(3)), 3, out, lambda stream: feeds.start_tenant_changes(
        stream, f"{out}/checkpoint", kept, once=True))
    return feeds.tenants_now(data.managed_tenants(spark, sf_dir), kept)


@query(ORACLE["counter_rate"])
def stream_counter_rate(spark, sf_dir):
    """Rates of the message counters over samples that arrive in three parts."""
    out = _folder(spark)
    kept = feeds.samples_table(spark, f"{out}/state")
    rows = monitor.select_series(monitoring.samples(spark, sf_dir, monitor.MESSAGES), monitor.MESSAGES)
    day = F.dayofyear("ts")
    _fed(spark, rows, F.when(day <= 10, 0).when(day <= 20, 1).otherwise(2), 3, out, lambda stream: feeds.start_counter_growth(
        stream, f"{out}/checkpoint", kept, f"{out}/growth", monitoring.RANGE_S, once=True))
    return feeds.rate(spark, f"{out}/growth", ("status",), monitoring.RANGE_S)
