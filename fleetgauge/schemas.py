"""Table schemas (as DDL text) and the preset dimension tables."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

# Envelope of a landed or consumed message. ``offset`` grows within a partition.
ENVELOPE = "key STRING, value STRING, partition INT, offset BIGINT, ingest_ts TIMESTAMP"

READINGS = (
    "device_id STRING, tenant_id STRING, ts TIMESTAMP, temperature DOUBLE, humidity DOUBLE, arrival_seq BIGINT"
)

STAT = "STRUCT<avg: DOUBLE, min: DOUBLE, max: DOUBLE>"
PROCESSED = (
    "device_id STRING, temperature DOUBLE, humidity DOUBLE, timestamp TIMESTAMP, processed_at TIMESTAMP, "
    f"is_anomaly BOOLEAN, anomaly_score DOUBLE, tenant_id STRING, temperature_stats {STAT}, humidity_stats {STAT}"
)

SENSOR_DATA = (
    "row_key BIGINT, device_id STRING, temperature DOUBLE, humidity DOUBLE, timestamp TIMESTAMP, "
    "is_anomaly BOOLEAN, anomaly_score DOUBLE, created_at TIMESTAMP, tenant_id STRING, created_date DATE"
)

TENANTS = (
    "id STRING, name STRING, api_key STRING, tier STRING, active BOOLEAN, created_at TIMESTAMP, "
    "quota_limit INT, rate_limit INT, sampling_rate DOUBLE, retention_days INT"
)

METRIC_SAMPLES = (
    "ts TIMESTAMP, metric STRING, tenant_id STRING, status STRING, job STRING, pod STRING, le DOUBLE, value DOUBLE"
)

# Metrics of a reading, window lengths and defaults.
METRICS = ("temperature", "humidity")
DEFAULT_TENANT = "default"
DEVICE_WINDOW = 100
RECENT_ROWS = 100
PAGE_ROWS = 100
CHART_POINTS = 20
SMALL_CHART_POINTS = 10
TIMELINE_ROWS = 20
DEFAULT_ANOMALY_THRESHOLD = 2.0
DEFAULT_SAMPLING_RATE = 1.0
DEFAULT_RETENTION_DAYS = 60

# Tenant -> (anomaly threshold, sampling rate) used while processing.
ENGINE_TENANTS = [("tenant1", 3.0, 1.0), ("tenant2", 2.5, 0.5), ("default", 2.0, 1.0)]

# Tenant -> days kept in the store.
STORAGE_RETENTION = [("tenant1", 90), ("tenant2", 30)]

# Tier -> sampling rate, anomaly threshold, daily quota, rate per minute, days kept.
TIERS = [
    ("free", 0.5, 1.0, 5000, 20, 7),
    ("standard", 0.8, 0.8, 50000, 100, 30),
    ("premium", 1.0, 0.5, 500000, 1000, 90),
]
DEFAULT_TIER = "standard"

# The managed tenants that exist from the start.
MANAGED_TENANTS = [
    ("tenant1", "Free Tier Test", "test-key-1", "free", True, None, 5000, 20, 0.5, 7),
    ("tenant2", "Standard Tier Test", "test-key-2", "standard", True, None, 50000, 100, 0.8, 30),
    ("tenant3", "Premium Tier Test", "test-key-3", "premium", True, None, 500000, 1000, 1.0, 90),
]

# Upper bounds of the latency histogram, in seconds (the usual client-library defaults).
LATENCY_BOUNDS = [0.005, 0.01, 0.025, 0.05, 0.1, 0.25, 0.5, 1.0, 2.5, 5.0, 10.0]


def literal_rows(spark: SparkSession, rows: list[tuple], ddl: str) -> DataFrame:
    """A small table written into the plan itself, so that no Python process is needed to produce it."""
    fields = [part.split() for part in ddl.split(", ")]
    args = {f"v{i}_{j}": v for i, row in enumerate(rows) for j, v in enumerate(row)}
    values = ", ".join(f"({', '.join(f':v{i}_{j}' for j in range(len(fields)))})" for i in range(len(rows)))
    columns = ", ".join(f"CAST({name} AS {kind}) AS {name}" for name, kind in fields)
    return spark.sql(f"SELECT {columns} FROM VALUES {values} AS t({', '.join(n for n, _ in fields)})", args)


def tenant_config(spark: SparkSession, rows=ENGINE_TENANTS) -> DataFrame:
    return literal_rows(spark, rows, "tenant_id STRING, anomaly_threshold DOUBLE, sampling_rate DOUBLE")


def retention_policies(spark: SparkSession, rows=STORAGE_RETENTION) -> DataFrame:
    return literal_rows(spark, rows, "tenant_id STRING, days INT")


def tiers(spark: SparkSession, rows=TIERS) -> DataFrame:
    return literal_rows(
        spark, rows,
        "tier STRING, sampling_rate DOUBLE, anomaly_threshold DOUBLE, quota_limit INT, rate_limit INT, "
        "retention_days INT",
    )


def managed_tenants(spark: SparkSession, rows=MANAGED_TENANTS) -> DataFrame:
    return literal_rows(spark, rows, TENANTS)
