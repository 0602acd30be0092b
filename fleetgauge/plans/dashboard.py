"""Registered queries: pages, recent rows, charts, running values, fan-out."""

from __future__ import annotations

from pyspark.sql import functions as F

from fleetgauge.functions import scoring
from fleetgauge.operators import recent
from fleetgauge.operators.fanout import fan_out, subscribers_with_default
from fleetgauge.plans import data
from fleetgauge.plans.registry import query

AVG = data.AVG
_ROW = ["arrival_seq", "tenant_id", "device_id", "ts", "measured_at", "temperature", "humidity", "is_anomaly"]
_ROW_SQL = """arrival_seq, tenant_id, device_id, ts, measured_at, CAST(temperature AS DOUBLE) AS temperature,
  CAST(humidity AS DOUBLE) AS humidity, is_anomaly"""


def _rows(spark, sf_dir):
    return data.stored(spark, sf_dir).select(*_ROW)


@query(data.on_processed(f"""
SELECT {_ROW_SQL} FROM stored WHERE tenant_id = 'tenant1'
ORDER BY measured_at DESC, arrival_seq DESC LIMIT 50 OFFSET 25"""))
def tenant_page(spark, sf_dir):
    return data.plain(recent.tenant_page(_rows(spark, sf_dir), "tenant1", 50, 25, "measured_at", "arrival_seq"))


@query(data.on_processed(f"""
SELECT {_ROW_SQL} FROM stored WHERE tenant_id = 'tenant1'
ORDER BY measured_at DESC, arrival_seq DESC LIMIT 100"""))
def tenant_page_bad_limit(spark, sf_dir):
    """An unusable limit or offset falls back to the default."""
    return data.plain(recent.tenant_page(_rows(spark, sf_dir), "tenant1", -5, -1, "measured_at", "arrival_seq"))


@query(data.on_processed(f"""
SELECT {_ROW_SQL} FROM stored WHERE tenant_id = 'tenant3' AND device_id = 'device-8'
ORDER BY measured_at DESC, arrival_seq DESC LIMIT 30"""))
def device_page(spark, sf_dir):
    rows = recent.device_page(_rows(spark, sf_dir), "tenant3", "device-8", 30, "measured_at", "arrival_seq")
    return data.plain(rows)


@query(data.on_processed(f"""
SELECT {_ROW_SQL} FROM stored
WHERE measured_at >= TIMESTAMP '2024-01-10 06:00:00' AND measured_at < TIMESTAMP '2024-01-12 00:00:00'"""))
def rows_in_range(spark, sf_dir):
    start, end = (F.lit(t).cast("timestamp_ntz") for t in ("2024-01-10 06:00:00", "2024-01-12 00:00:00"))
    return data.plain(recent.rows_between(_rows(spark, sf_dir), start, end, "measured_at"))


_RECENT = f"recent AS (SELECT {_ROW_SQL} FROM stored ORDER BY arrival_seq DESC LIMIT 100)"


@query(data.on_processed("SELECT * FROM recent", _RECENT))
def recent_buffer(spark, sf_dir):
    return data.plain(recent.recent_buffer(_rows(spark, sf_dir)))


@query(data.on_processed("SELECT * FROM recent WHERE tenant_id = 'tenant4'", _RECENT))
def recent_then_tenant(spark, sf_dir):
    return data.plain(recent.recent_of_tenant(_rows(spark, sf_dir), "tenant4"))


@query(data.on_processed(f"""
SELECT {AVG.format('temperature')} AS avg_temperature, {AVG.format('humidity')} AS avg_humidity,
  count(*) AS total_readings, arg_max(measured_at, arrival_seq) AS last_reading
FROM (SELECT * FROM stored ORDER BY arrival_seq DESC LIMIT 100)"""))
def recent_summary(spark, sf_dir):
    return recent.recent_summary(_rows(spark, sf_dir), ts="measured_at")


@query(data.on_processed(f"""
SELECT {_ROW_SQL} FROM stored
QUALIFY row_number() OVER (PARTITION BY tenant_id ORDER BY measured_at DESC, arrival_seq DESC) = 1"""))
def latest_row(spark, sf_dir):
    return data.plain(recent.latest_rows(_rows(spark, sf_dir), ts="measured_at")).select(*_ROW)


@query(data.on_processed("""
SELECT arrival_seq, CASE WHEN user_id % 7 = 0 THEN '' ELSE tenant_id END AS tenant_id FROM stored
WHERE user_id % 7 = 0 OR tenant_id = 'tenant2'"""))
def viewer_rows(spark, sf_dir):
    tenant = F.when(F.col("user_id") % 7 == 0, "").otherwise(F.col("tenant_id"))
    rows = data.stored(spark, sf_dir).select("arrival_seq", tenant.alias("tenant_id"))
    return recent.shown_to_viewer(rows, "tenant2")


_NEWER = """newer AS (
  SELECT * FROM (SELECT *, max(measured_at) OVER (PARTITION BY tenant_id ORDER BY arrival_seq
                           ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) AS newest FROM stored)
  WHERE newest IS NULL OR measured_at > newest)"""
_POINTS = """points AS (
  SELECT tenant_id, device_id, arrival_seq, measured_at, 'temperature' AS metric, temperature AS value FROM {0}
  WHERE temperature IS NOT NULL
  UNION ALL SELECT tenant_id, device_id, arrival_seq, measured_at, 'humidity', humidity FROM {0}
  WHERE humidity IS NOT NULL)"""


@query(data.on_processed(f"SELECT {_ROW_SQL} FROM newer", _NEWER))
def newer_only(spark, sf_dir):
    return data.plain(recent.newer_only(_rows(spark, sf_dir), ts="measured_at"))


@query(data.on_processed("""
SELECT tenant_id, arrival_seq, measured_at, metric, CAST(value AS DOUBLE) AS value FROM points
QUALIFY row_number() OVER (PARTITION BY tenant_id, metric ORDER BY arrival_seq DESC) <= 20""",
    _NEWER, _POINTS.format("newer")))
def chart_last_20(spark, sf_dir):
    fresh = recent.newer_only(_rows(spark, sf_dir), ts="measured_at")
    return data.plain(recent.chart_series(fresh, ts="measured_at"))


@query(data.on_processed("""
SELECT arrival_seq, measured_at, metric, CAST(value AS DOUBLE) AS value FROM points
QUALIFY row_number() OVER (PARTITION BY metric ORDER BY arrival_seq DESC) <= 10""", _POINTS.format("stored")))
def chart_last_10(spark, sf_dir):
    return data.plain(recent.device_chart_series(_rows(spark, sf_dir), ts="measured_at"))


@query(data.on_processed("""
SELECT metric, measured_at, arrival_seq, CAST(value AS DOUBLE) AS value,
  row_number() OVER (PARTITION BY metric ORDER BY measured_at, arrival_seq) AS position FROM points""",
    "page AS (SELECT * FROM stored WHERE tenant_id = 'tenant1' ORDER BY measured_at DESC, arrival_seq DESC LIMIT 100)",
    _POINTS.format("page")))
def chart_initial_load(spark, sf_dir):
    """A page turned into one oldest-first series per metric."""
    from pyspark.sql.window import Window

    page = recent.tenant_page(_rows(spark, sf_dir), "tenant1", ts="measured_at", tie="arrival_seq")
    series = recent.chronological(page, "measured_at", "arrival_seq")
    # A page has at most 100 rows.
    position = F.row_number().over(Window.partitionBy("metric").orderBy("measured_at", "arrival_seq")).cast("bigint")
    return data.plain(series.withColumn("position", position))


@query(data.on_processed(f"""
SELECT {_ROW_SQL}, CAST(round(temperature, 1) AS DOUBLE) AS shown FROM stored
QUALIFY row_number() OVER (PARTITION BY tenant_id ORDER BY arrival_seq DESC) <= 20"""))
def timeline(spark, sf_dir):
    rows = recent.timeline(_rows(spark, sf_dir))
    return data.plain(rows.withColumn("shown", scoring.display(F.col("temperature"))))


@query(data.on_processed("""
SELECT arrival_seq, tenant_id,
  CAST(sum(temperature) OVER w AS DOUBLE) / nullif(count(temperature) OVER w, 0) AS running_avg_temperature,
  CAST(sum(humidity) OVER w AS DOUBLE) / nullif(count(humidity) OVER w, 0) AS running_avg_humidity,
  count(*) OVER w AS running_total
FROM stored WINDOW w AS (PARTITION BY tenant_id ORDER BY arrival_seq ROWS UNBOUNDED PRECEDING)"""))
def running_average(spark, sf_dir):
    marked = recent.running_average(_rows(spark, sf_dir))
    return marked.select("arrival_seq", "tenant_id", "running_avg_temperature", "running_avg_humidity", "running_total")


@query(data.on_processed("""
SELECT s.subscriber_id, r.arrival_seq, r.tenant_id FROM stored r
JOIN subscribers s ON s.tenant_id = r.tenant_id OR s.tenant_id = 'all'""", data.SUBSCRIBERS))
def fanout(spark, sf_dir):
    viewers = subscribers_with_default(data.subscribers(spark, sf_dir))
    return fan_out(data.stored(spark, sf_dir).select("arrival_seq", "tenant_id"), viewers)
