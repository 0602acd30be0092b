"""Registered queries: global, tenant and device statistics."""

from __future__ import annotations

from pyspark.sql import functions as F

from fleetgauge import schemas
from fleetgauge.operators import stats, tenants
from fleetgauge.plans import data
from fleetgauge.plans.registry import query

AVG = data.AVG

_TENANT_STATS = f"""
SELECT tenant_id, count(DISTINCT device_id) AS device_count, count(*) AS total_records,
  CAST(sum(CASE WHEN is_anomaly THEN 1 ELSE 0 END) AS BIGINT) AS anomaly_count,
  coalesce({AVG.format('temperature')}, 0) AS avg_temperature, coalesce({AVG.format('humidity')}, 0) AS avg_humidity
FROM stored GROUP BY tenant_id"""


@query(data.on_processed(_TENANT_STATS))
def tenant_stats(spark, sf_dir):
    return stats.tenant_stats(data.stored(spark, sf_dir))


@query(data.on_processed(f"SELECT * FROM ({_TENANT_STATS}) WHERE tenant_id = 'tenant3'"))
def stats_of_one_tenant(spark, sf_dir):
    return stats.stats_of_tenant(data.stored(spark, sf_dir), "tenant3")


@query(data.on_processed(f"""
SELECT id AS tenant_id, coalesce(device_count, 0) AS device_count, coalesce(total_records, 0) AS total_records,
  coalesce(anomaly_count, 0) AS anomaly_count, coalesce(avg_temperature, 0) AS avg_temperature,
  coalesce(avg_humidity, 0) AS avg_humidity
FROM tenants LEFT JOIN ({_TENANT_STATS}) AS s ON s.tenant_id = replace(id, 't-', 'tenant')""", data.TENANTS))
def stats_of_listed_tenants(spark, sf_dir):
    """Every managed tenant, zeros where it sent nothing."""
    numbered = data.stored(spark, sf_dir).withColumn("tenant_id", F.regexp_replace("tenant_id", "^tenant", "t-"))
    listed = data.managed_tenants(spark, sf_dir).select(F.col("id").alias("tenant_id"))
    return stats.tenant_stats(numbered, listed)


def _global(metric: str) -> str:
    return f"""
SELECT '{metric}' AS metric, count({metric}) AS count, CAST(sum({metric}) AS DOUBLE) AS sum,
  CAST(min({metric}) AS DOUBLE) AS min, CAST(max({metric}) AS DOUBLE) AS max, {AVG.format(metric)} AS avg FROM stored"""


@query(data.on_processed(" UNION ALL ".join(_global(m) for m in schemas.METRICS)))
def global_stats(spark, sf_dir):
    return data.plain(stats.global_stats(data.stored(spark, sf_dir)))


_LONG = """long AS (
  SELECT tenant_id, device_id, arrival_seq, 'temperature' AS metric, temperature AS value FROM stored
  WHERE temperature IS NOT NULL
  UNION ALL SELECT tenant_id, device_id, arrival_seq, 'humidity', humidity FROM stored WHERE humidity IS NOT NULL)"""

_LAST = """last AS (
  SELECT * FROM long
  QUALIFY row_number() OVER (PARTITION BY {0}, metric ORDER BY arrival_seq DESC) <= 100)"""

_WINDOW = f"""count(*) AS count, {AVG.format('value')} AS avg, CAST(min(value) AS DOUBLE) AS min,
  CAST(max(value) AS DOUBLE) AS max"""


@query(data.on_processed(
    f"SELECT tenant_id, device_id, metric, {_WINDOW} FROM last GROUP BY ALL", _LONG, _LAST.format("tenant_id, device_id")))
def device_last_n_stats(spark, sf_dir):
    return data.plain(stats.device_window_stats(data.stored(spark, sf_dir)).drop("readings"))


@query(data.on_processed("""
SELECT tenant_id, device_id, metric, CAST(value AS DOUBLE) AS reading,
  row_number() OVER (PARTITION BY tenant_id, device_id, metric ORDER BY arrival_seq) - 1 AS position FROM last""",
    _LONG, _LAST.format("tenant_id, device_id")))
def device_last_n_readings(spark, sf_dir):
    windows = stats.device_window_stats(data.stored(spark, sf_dir))
    return data.plain(windows.select(
        "tenant_id", "device_id", "metric", F.posexplode("readings").alias("position", "reading")
    ).withColumn("position", F.col("position").cast("bigint")))


_SHARED = "SELECT * REPLACE (concat('device-', CAST(user_id % 21 AS VARCHAR)) AS device_id) FROM stored"


@query(data.on_processed(
    f"SELECT device_id, metric, {_WINDOW} FROM last GROUP BY ALL",
    f"shared AS ({_SHARED})", _LONG.replace("FROM stored", "FROM shared"), _LAST.format("device_id")))
def device_shared_windows(spark, sf_dir):
    """Keyed by device name alone: equal names of different tenants share a window."""
    name = F.concat(F.lit("device-"), (F.col("user_id") % 21).cast("string"))
    rows = data.stored(spark, sf_dir).withColumn("device_id", name)
    return data.plain(stats.device_window_stats(rows, ("device_id",)).drop("readings"))


_ROLL = """
  SELECT tenant_id, device_id, arrival_seq, metric, value, count(value) OVER w AS count, sum(value) OVER w AS sum,
    min(value) OVER w AS min, max(value) OVER w AS max
  FROM long
  WINDOW w AS (PARTITION BY tenant_id, device_id, metric ORDER BY arrival_seq ROWS BETWEEN 99 PRECEDING AND CURRENT ROW)"""


@query(data.on_processed(f"""
SELECT * REPLACE (CAST(value AS DOUBLE) AS value, CAST(sum AS DOUBLE) AS sum, CAST(min AS DOUBLE) AS min,
  CAST(max AS DOUBLE) AS max), CAST(sum AS DOUBLE) / count AS avg FROM ({_ROLL})""", _LONG))
def device_rolling(spark, sf_dir):
    return data.plain(stats.device_rolling(data.stored(spark, sf_dir)))


@query(data.on_processed("""
SELECT s.arrival_seq, t.avg AS temperature_avg, t.min AS temperature_min, t.max AS temperature_max,
  h.avg AS humidity_avg, h.min AS humidity_min, h.max AS humidity_max
FROM stored s
LEFT JOIN rolled t ON t.arrival_seq = s.arrival_seq AND t.metric = 'temperature'
LEFT JOIN rolled h ON h.arrival_seq = s.arrival_seq AND h.metric = 'humidity'""", _LONG, f"""rolled AS (
  SELECT arrival_seq, metric, CAST(sum AS DOUBLE) / count AS avg, CAST(min AS DOUBLE) AS min, CAST(max AS DOUBLE) AS max
  FROM ({_ROLL}))"""))
def device_stats_enriched(spark, sf_dir):
    rows = stats.with_device_stats(data.stored(spark, sf_dir))
    return rows.select("arrival_seq", *[
        F.col(f"{m}_stats.{s}").alias(f"{m}_{s}") for m in schemas.METRICS for s in ("avg", "min", "max")
    ])


@query(data.on_processed("""
SELECT tenant_id, device_id, arg_max(measured_at, arrival_seq) AS last_seen FROM stored GROUP BY ALL"""))
def device_last_seen(spark, sf_dir):
    return stats.device_last_seen(data.stored(spark, sf_dir), ts="measured_at")


@query(data.on_processed("SELECT tenant_id, count(*) AS records FROM stored GROUP BY 1"))
def tenant_record_counts(spark, sf_dir):
    return stats.tenant_record_counts(data.stored(spark, sf_dir))


@query(data.on_clean("""
SELECT count(*) FILTER (WHERE outcome IN ('normal', 'anomaly')) AS processed_count,
  count(*) FILTER (WHERE outcome NOT IN ('normal', 'anomaly')) AS error_count,
  max(ingest_ts) FILTER (WHERE outcome IN ('normal', 'anomaly')) AS last_processed FROM pipeline""", data.PIPELINE))
def processing_status(spark, sf_dir):
    return stats.processing_status(data.pipeline(spark, sf_dir))


@query(data.on_clean("SELECT outcome, count(*) AS messages FROM pipeline GROUP BY 1", data.PIPELINE))
def outcome_counts(spark, sf_dir):
    return stats.outcome_counts(data.pipeline(spark, sf_dir))


@query(data.on_clean("""
SELECT tenant_id, count(*) AS messages FROM pipeline WHERE outcome IN ('normal', 'anomaly') GROUP BY 1""", data.PIPELINE))
def tenant_message_counts(spark, sf_dir):
    return stats.tenant_message_counts(data.pipeline(spark, sf_dir))


_BOUNDS = ", ".join(f"({b}E0)" for b in schemas.LATENCY_BOUNDS) + ", (CAST('Infinity' AS DOUBLE))"


@query(data.on_processed(f"""
SELECT tenant_id, CAST(le AS VARCHAR) AS le, count(*) FILTER (WHERE latency_seconds <= bounds.le) AS cumulative_count
FROM stored CROSS JOIN (VALUES {_BOUNDS}) AS bounds(le) GROUP BY tenant_id, bounds.le""".replace(
    "CAST(le AS VARCHAR)", "CASE WHEN isinf(bounds.le) THEN '+Inf' ELSE CAST(bounds.le AS VARCHAR) END")))
def latency_histogram(spark, sf_dir):
    rows = stats.latency_histogram(data.stored(spark, sf_dir))
    text = F.when(F.col("le") == float("inf"), "+Inf").otherwise(F.col("le").cast("string"))
    return rows.withColumn("le", text)


@query(data.sql("SELECT count(*) AS tenants, count(*) FILTER (WHERE active) AS active_tenants FROM tenants", data.TENANTS))
def tenant_counts(spark, sf_dir):
    return tenants.tenant_counts(data.managed_tenants(spark, sf_dir))
