"""Registered queries: counter rates, quantiles and gauges over metric samples derived from the scored rows."""

from __future__ import annotations

from pyspark.sql import functions as F

from fleetgauge import schemas
from fleetgauge.operators import monitor
from fleetgauge.plans import data
from fleetgauge.plans.registry import query

# Hourly samples and windows of a day, because the events are minutes apart.
EVERY = "1 hour"
RANGE_S = 86_400


def samples(spark, sf_dir, *metrics):
    """The named metrics, or all."""
    rows = data.pipeline(spark, sf_dir).withColumn("timestamp", F.col("ingest_ts"))
    pod = F.concat(F.lit("processing-engine-"), (F.col("arrival_seq") % 3).cast("string"))
    return monitor.metric_samples(data.exact(rows), EVERY, "ingest_ts", pod=pod, metrics=metrics or None)


_BOUNDS = ", ".join(f"({b}E0)" for b in schemas.LATENCY_BOUNDS)

SAMPLES = f"""hours AS (
  SELECT date_trunc('hour', ingest_ts) + INTERVAL 1 HOUR AS ts, concat('processing-engine-', CAST(arrival_seq % 3 AS VARCHAR)) AS pod,
    tenant_id, CASE WHEN outcome IN ('normal', 'anomaly') THEN outcome ELSE 'error' END AS status, latency_seconds
  FROM pipeline),
steps AS (
  SELECT ts, '{monitor.MESSAGES}' AS metric, NULL AS tenant_id, status, pod, NULL::DOUBLE AS le, count(*)::DOUBLE AS step
  FROM hours GROUP BY ALL
  UNION ALL
  SELECT ts, unnest(['{monitor.TENANT_MESSAGES}', '{monitor.RECORDS}', '{monitor.LATENCY}_count']), tenant_id, NULL, pod, NULL,
    count(*) FROM hours WHERE status <> 'error' GROUP BY ts, tenant_id, pod
  UNION ALL
  SELECT ts, '{monitor.LATENCY}_sum', tenant_id, NULL, pod, NULL, sum(CAST(latency_seconds AS DECIMAL(18,4)))::DOUBLE
  FROM hours WHERE status <> 'error' GROUP BY ALL
  UNION ALL
  SELECT ts, '{monitor.LATENCY}_bucket', tenant_id, NULL, pod, bounds.le, count(*) FILTER (WHERE latency_seconds <= bounds.le)
  FROM hours CROSS JOIN (VALUES {_BOUNDS}, (CAST('Infinity' AS DOUBLE))) AS bounds(le) WHERE status <> 'error' GROUP BY ALL),
samples AS (
  SELECT ts, metric, tenant_id, status, 'processing-engine' AS job, pod, le,
    sum(step) OVER (PARTITION BY metric, tenant_id, status, pod, le ORDER BY ts ROWS UNBOUNDED PRECEDING) AS value FROM steps),
pairs AS (
  SELECT *, lag(value) OVER s AS prev, lag(ts) OVER s AS prev_ts, time_bucket(INTERVAL 1 DAY, ts) AS window_start FROM samples
  WINDOW s AS (PARTITION BY metric, tenant_id, status, pod, le ORDER BY ts)),
grown AS (
  SELECT *, CASE WHEN value >= prev THEN value - prev ELSE value END AS g FROM pairs WHERE prev_ts >= window_start)"""


def on_samples(body: str) -> str:
    return data.on_clean(body, data.PIPELINE, SAMPLES)


@query(on_samples(f"""
SELECT metric, tenant_id, status, job, pod, CASE WHEN isinf(le) THEN '+Inf' ELSE CAST(le AS VARCHAR) END AS le, ts,
  round(value, 3) AS value FROM samples"""))
def metric_samples(spark, sf_dir):
    rows = samples(spark, sf_dir)
    le = F.when(F.col("le") == float("inf"), "+Inf").otherwise(F.col("le").cast("string"))
    return rows.withColumn("le", le).withColumn("value", F.round("value", 3))


@query(on_samples(f"""
SELECT status, window_start, window_start + INTERVAL 1 DAY AS window_end, sum(g) / {RANGE_S}.0E0 AS rate
FROM grown WHERE metric = '{monitor.MESSAGES}' GROUP BY ALL"""))
def counter_rate(spark, sf_dir):
    counters = monitor.select_series(samples(spark, sf_dir, monitor.MESSAGES), monitor.MESSAGES)
    return monitor.rate(counters, ("status",), RANGE_S)


@query(on_samples(f"""
SELECT tenant_id, window_start, window_start + INTERVAL 1 DAY AS window_end, sum(g) / {RANGE_S}.0E0 AS rate
FROM grown WHERE metric = '{monitor.TENANT_MESSAGES}' GROUP BY ALL"""))
def tenant_rate(spark, sf_dir):
    counters = monitor.select_series(samples(spark, sf_dir, monitor.TENANT_MESSAGES), monitor.TENANT_MESSAGES)
    return monitor.rate(counters, ("tenant_id",), RANGE_S)


@query(on_samples(f"""
SELECT tenant_id, window_start, window_start + INTERVAL 1 DAY AS window_end, CASE WHEN total <= 0 THEN NULL
    WHEN isinf(le) THEN prev_le
    ELSE coalesce(prev_le, 0) + (le - coalesce(prev_le, 0)) * ((total * 0.95E0 - coalesce(below, 0)) / nullif(cum - coalesce(below, 0), 0))
    END AS quantile
FROM (SELECT *, row_number() OVER (PARTITION BY tenant_id, window_start ORDER BY le) AS hit FROM (
  SELECT tenant_id, window_start, le, cum, lag(le) OVER b AS prev_le, lag(cum) OVER b AS below,
    max(cum) OVER (PARTITION BY tenant_id, window_start) AS total
  FROM (SELECT tenant_id, window_start, le, sum(g) AS cum FROM grown WHERE metric = '{monitor.LATENCY}_bucket'
        GROUP BY ALL)
  WINDOW b AS (PARTITION BY tenant_id, window_start ORDER BY le)) WHERE cum >= total * 0.95E0)
WHERE hit = 1"""))
def histogram_p95(spark, sf_dir):
    return monitor.histogram_quantile(samples(spark, sf_dir, f"{monitor.LATENCY}_bucket"), 0.95, range_s=RANGE_S)


@query(on_samples(f"""
SELECT window_start, window_start + INTERVAL 1 DAY AS window_end,
  coalesce(sum(g) FILTER (WHERE status = 'error'), 0) / nullif(sum(g), 0) * 100.0E0 AS error_percent
FROM grown WHERE metric = '{monitor.MESSAGES}' GROUP BY ALL"""))
def error_percent(spark, sf_dir):
    return monitor.error_percent(samples(spark, sf_dir, monitor.MESSAGES), range_s=RANGE_S)


@query(on_samples(f"""
SELECT job, pod, window_start, window_start + INTERVAL 1 DAY AS window_end,
  coalesce(sum(g) FILTER (WHERE status = 'error'), 0) / nullif(sum(g), 0) * 100.0E0 AS error_percent
FROM grown WHERE metric = '{monitor.MESSAGES}' GROUP BY ALL"""))
def error_percent_by_job(spark, sf_dir):
    rows = samples(spark, sf_dir, monitor.MESSAGES)
    return monitor.error_percent(rows, by=("job", "pod"), range_s=RANGE_S)


_LATEST = """(SELECT * FROM samples
  QUALIFY row_number() OVER (PARTITION BY metric, tenant_id, status, pod, le ORDER BY ts DESC) = 1)"""


@query(on_samples(f"SELECT status, sum(value) AS value FROM {_LATEST} WHERE metric = '{monitor.MESSAGES}' GROUP BY 1"))
def latest_by_status(spark, sf_dir):
    return monitor.latest_sum(monitor.select_series(samples(spark, sf_dir, monitor.MESSAGES), monitor.MESSAGES), ("status",))


@query(on_samples(f"SELECT tenant_id, sum(value) AS value FROM {_LATEST} WHERE metric = '{monitor.TENANT_MESSAGES}' GROUP BY 1"))
def latest_by_tenant(spark, sf_dir):
    counters = monitor.select_series(samples(spark, sf_dir, monitor.TENANT_MESSAGES), monitor.TENANT_MESSAGES)
    return monitor.latest_sum(counters, ("tenant_id",))


@query(on_samples(f"""
SELECT tenant_id, sum(CAST(value AS DECIMAL(28,6))) FILTER (WHERE metric LIKE '%_sum')::DOUBLE
  / sum(value) FILTER (WHERE metric LIKE '%_count') AS mean_latency
FROM {_LATEST} WHERE metric IN ('{monitor.LATENCY}_sum', '{monitor.LATENCY}_count') GROUP BY 1"""))
def mean_latency(spark, sf_dir):
    return monitor.mean_latency(samples(spark, sf_dir, f"{monitor.LATENCY}_sum", f"{monitor.LATENCY}_count"))


@query(on_samples(f"""
SELECT pod, sum(value) / 1048576.0E0 AS value FROM {_LATEST}
WHERE metric = '{monitor.RECORDS}' AND job = 'processing-engine' GROUP BY 1"""))
def gauge_by_pod(spark, sf_dir):
    gauges = monitor.select_series(samples(spark, sf_dir, monitor.RECORDS), monitor.RECORDS)
    return monitor.scaled(monitor.latest_sum(monitor.match_label(gauges, "job", "processing-engine.*"), ("pod",)))


@query(on_samples(f"""
SELECT ts, pod, value FROM samples WHERE metric = '{monitor.TENANT_MESSAGES}' AND tenant_id = 'tenant3'"""))
def series_selection(spark, sf_dir):
    series = samples(spark, sf_dir, monitor.TENANT_MESSAGES)
    series = monitor.select_series(series, monitor.TENANT_MESSAGES, tenant_id="tenant3")
    return series.select("ts", "pod", "value")


@query(on_samples("SELECT DISTINCT tenant_id FROM samples WHERE tenant_id IS NOT NULL"))
def label_values(spark, sf_dir):
    return monitor.label_values(samples(spark, sf_dir), "tenant_id")


@query(on_samples(f"SELECT pod, tenant_id, value FROM {_LATEST} WHERE metric = '{monitor.RECORDS}'"))
def last_value(spark, sf_dir):
    last = monitor.latest(monitor.select_series(samples(spark, sf_dir, monitor.RECORDS), monitor.RECORDS))
    return last.select("pod", "tenant_id", "value")


@query(on_samples("SELECT tenant_id, count(DISTINCT pod) AS pods FROM samples WHERE tenant_id IS NOT NULL GROUP BY 1"))
def pods_per_tenant(spark, sf_dir):
    return monitor.pods_per_tenant(samples(spark, sf_dir))
