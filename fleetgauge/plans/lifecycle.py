"""Registered queries: keys, tiers, tenants, retention, usage, analytics."""

from __future__ import annotations

from pyspark.sql import functions as F

from fleetgauge import schemas
from fleetgauge.operators import analytics, process, retention, stats, tenants, usage, validate
from fleetgauge.plans import data
from fleetgauge.plans.registry import query
from fleetgauge.sources import table

AVG = data.AVG

# A request per event: some without a key, some with a key nobody has.
_REQUESTS = """requests AS (
  SELECT event_id, CASE event_type WHEN 'signup' THEN '' WHEN 'error' THEN concat('lost-', CAST(user_id AS VARCHAR))
         ELSE concat('key-', CAST(user_id AS VARCHAR)) END AS api_key FROM events)"""


def _requests(spark, sf_dir):
    user = F.col("user_id").cast("string")
    key = (
        F.when(F.col("event_type") == "signup", "").when(F.col("event_type") == "error", F.concat(F.lit("lost-"), user))
        .otherwise(F.concat(F.lit("key-"), user))
    )
    return data.table(spark, sf_dir, "events").select("event_id", key.alias("api_key"))


@query(data.sql("""
SELECT event_id, api_key, status, CASE WHEN status = 'ok' THEN id END AS tenant_id,
  CASE WHEN status = 'ok' THEN tier END AS tier, CASE WHEN status = 'ok' THEN sampling_rate END AS sampling_rate,
  CASE WHEN status = 'ok' THEN CASE tier WHEN 'free' THEN 1.0E0 WHEN 'standard' THEN 0.8E0 WHEN 'premium' THEN 0.5E0
       ELSE 0.8E0 END END AS anomaly_threshold,
  CASE WHEN status = 'ok' THEN retention_days END AS retention_days
FROM (SELECT r.event_id, r.api_key, t.*EXCLUDE (api_key),
        CASE WHEN r.api_key = '' THEN 'missing' WHEN t.id IS NULL THEN 'unknown' WHEN NOT t.active THEN 'inactive'
             ELSE 'ok' END AS status
      FROM requests r LEFT JOIN tenants t ON t.api_key = r.api_key)""", data.TENANTS, _REQUESTS))
def api_key_status(spark, sf_dir):
    return tenants.api_key_status(_requests(spark, sf_dir), data.managed_tenants(spark, sf_dir))


@query(data.sql("SELECT event_id, api_key FROM requests WHERE api_key IN (SELECT api_key FROM tenants)", data.TENANTS, _REQUESTS))
def known_key_requests(spark, sf_dir):
    keys = data.managed_tenants(spark, sf_dir).select(F.concat(F.lit(" "), "api_key", F.lit(" ")).alias("api_key"))
    return validate.with_known_key(_requests(spark, sf_dir), keys)


@query(data.sql("""
SELECT event_id, api_key FROM requests WHERE api_key NOT IN (SELECT api_key FROM tenants)""", data.TENANTS, _REQUESTS))
def unknown_key_requests(spark, sf_dir):
    return validate.with_unknown_key(_requests(spark, sf_dir), data.managed_tenants(spark, sf_dir))


_TIERS = ", ".join(f"('{t}', {s}E0, {a}E0, {q}, {r}, {d})" for t, s, a, q, r, d in schemas.TIERS)


@query(data.sql(f"""
SELECT id, t.tier, x.tier AS config_tier, x.sampling_rate, x.anomaly_threshold, x.quota_limit, x.rate_limit, x.retention_days
FROM (SELECT id, tier FROM tenants) t
JOIN (VALUES {_TIERS}) AS x(tier, sampling_rate, anomaly_threshold, quota_limit, rate_limit, retention_days)
  ON x.tier = CASE WHEN lower(t.tier) IN ('free', 'standard', 'premium') THEN lower(t.tier) ELSE 'standard' END""", data.TENANTS))
def tier_config(spark, sf_dir):
    named = data.managed_tenants(spark, sf_dir).select("id", "tier")
    return tenants.with_tier_config(named, schemas.tiers(spark))


@query(data.sql("SELECT * FROM tenants WHERE id = 't-7'", data.TENANTS))
def tenant_lookup(spark, sf_dir):
    return tenants.find_tenant(data.managed_tenants(spark, sf_dir), "t-7")


@query(data.on_readings("""
SELECT arrival_seq, concat('t-', CAST(user_id AS VARCHAR)) AS tenant_id FROM readings
WHERE concat('t-', CAST(user_id AS VARCHAR)) IN (SELECT id FROM tenants)""", data.TENANTS))
def rows_of_known_tenants(spark, sf_dir):
    rows = data.readings(spark, sf_dir).select(
        "arrival_seq", F.concat(F.lit("t-"), F.col("user_id").cast("string")).alias("tenant_id")
    )
    return tenants.of_known_tenants(rows, data.managed_tenants(spark, sf_dir))


# Change feed from the events: signup creates, error deletes, everything else updates the user's tenant.
_CHANGES = """changes AS (
  SELECT event_id AS change_seq, concat('t-', CAST(user_id AS VARCHAR)) AS id,
    CASE event_type WHEN 'signup' THEN 'create' WHEN 'error' THEN 'delete' ELSE 'update' END AS op,
    concat('name-', CAST(event_id AS VARCHAR)) AS name,
    CASE WHEN event_type = 'view' THEN '' ELSE concat('new-', CAST(event_id AS VARCHAR)) END AS api_key,
    event_type AS tier, value > 50 AS active, date_trunc('second', ts) AS created_at,
    CAST(event_id % 100 AS INTEGER) AS quota_limit, CAST(event_id % 10 AS INTEGER) AS rate_limit,
    value AS sampling_rate, CAST(event_id % 30 AS INTEGER) AS retention_days FROM events),
bases AS (SELECT * FROM changes WHERE op <> 'update'
          QUALIFY row_number() OVER (PARTITION BY id ORDER BY change_seq DESC) = 1),
start AS (
  SELECT t.*, CAST(-1 AS BIGINT) AS since FROM tenants t WHERE t.id NOT IN (SELECT id FROM bases)
  UNION ALL
  SELECT id, name, api_key, tier, active, created_at, quota_limit, rate_limit, sampling_rate, retention_days, change_seq
  FROM bases WHERE op = 'create'),
later AS (SELECT c.* FROM changes c JOIN start s ON s.id = c.id AND c.change_seq > s.since AND c.op = 'update'),
upd AS (SELECT * FROM later QUALIFY row_number() OVER (PARTITION BY id ORDER BY change_seq DESC) = 1),
keyed AS (SELECT * FROM later WHERE api_key <> '' QUALIFY row_number() OVER (PARTITION BY id ORDER BY change_seq DESC) = 1)"""


@query(data.sql("""
SELECT s.id, CASE WHEN u.id IS NULL THEN s.name ELSE u.name END AS name, coalesce(k.api_key, s.api_key) AS api_key,
  CASE WHEN u.id IS NULL THEN s.tier ELSE u.tier END AS tier, CASE WHEN u.id IS NULL THEN s.active ELSE u.active END AS active,
  s.created_at, CASE WHEN u.id IS NULL THEN s.quota_limit ELSE u.quota_limit END AS quota_limit,
  CASE WHEN u.id IS NULL THEN s.rate_limit ELSE u.rate_limit END AS rate_limit,
  CASE WHEN u.id IS NULL THEN s.sampling_rate ELSE u.sampling_rate END AS sampling_rate,
  CASE WHEN u.id IS NULL THEN s.retention_days ELSE u.retention_days END AS retention_days
FROM start s LEFT JOIN upd u ON u.id = s.id LEFT JOIN keyed k ON k.id = s.id""", data.TENANTS, _CHANGES))
def tenant_changes(spark, sf_dir):
    return tenants.apply_changes(data.managed_tenants(spark, sf_dir), changes(spark, sf_dir))


def changes(spark, sf_dir):
    """The change feed that ``_CHANGES`` describes."""
    kind = F.col("event_type")
    number = F.col("event_id").cast("string")
    return data.table(spark, sf_dir, "events").select(
        F.col("event_id").alias("change_seq"),
        F.concat(F.lit("t-"), F.col("user_id").cast("string")).alias("id"),
        F.when(kind == "signup", "create").when(kind == "error", "delete").otherwise("update").alias("op"),
        F.concat(F.lit("name-"), number).alias("name"),
        F.when(kind == "view", "").otherwise(F.concat(F.lit("new-"), number)).alias("api_key"),
        kind.alias("tier"),
        (F.col("value") > 50).alias("active"),
        F.date_trunc("second", "ts").cast("timestamp").alias("created_at"),
        (F.col("event_id") % 100).cast("int").alias("quota_limit"),
        (F.col("event_id") % 10).cast("int").alias("rate_limit"),
        F.col("value").alias("sampling_rate"),
        (F.col("event_id") % 30).cast("int").alias("retention_days"),
    )


_EXPIRED = f"""aged AS (
  SELECT *, ts < TIMESTAMP '{data.AS_OF}' - to_days(CASE tenant_id WHEN 'tenant1' THEN 10 WHEN 'tenant2' THEN 20
                                                   ELSE {data.POLICY_DEFAULT} END) AS expired FROM stored)"""


def _retention(fn, spark, sf_dir):
    as_of = F.lit(data.AS_OF).cast("timestamp_ntz")
    return fn(data.stored(spark, sf_dir), data.policies(spark), as_of, data.POLICY_DEFAULT, "ts")


@query(data.on_processed("SELECT arrival_seq, tenant_id, ts FROM aged WHERE NOT expired", _EXPIRED))
def retention_survivors(spark, sf_dir):
    return _retention(retention.survivors, spark, sf_dir).select("arrival_seq", "tenant_id", "ts")


@query(data.on_processed("SELECT tenant_id, count(*) AS deleted FROM aged WHERE expired GROUP BY 1", _EXPIRED))
def retention_deleted_counts(spark, sf_dir):
    return _retention(retention.deleted_counts, spark, sf_dir)


@query(data.on_processed("""
SELECT tenant_id, count(*) AS records FROM stored WHERE tenant_id NOT IN ('tenant1', 'tenant2') GROUP BY 1"""))
def tenants_without_policy(spark, sf_dir):
    return stats.tenant_record_counts(retention.without_policy(data.stored(spark, sf_dir), data.policies(spark)))


@query(data.on_processed("""
SELECT arrival_seq AS row_key, device_id, tenant_id FROM stored
WHERE arrival_seq NOT IN (SELECT event_id FROM events WHERE event_type IN ('view', 'click'))"""))
def dedup_append(spark, sf_dir):
    """Every row arrives twice; views and clicks are stored already."""
    rows = process.for_store(data.stored(spark, sf_dir), created_at=F.col("processed_at"))
    before = data.table(spark, sf_dir, "events").filter(F.col("event_type").isin("view", "click"))
    fresh = table.new_rows(rows.unionAll(rows), before.select(F.col("event_id").alias("row_key")))
    return fresh.select("row_key", "device_id", "tenant_id")


# Limits per tenant taken from the tenants with the same number.
_LIMITS = """limits AS (
  SELECT replace(id, 't-', 'tenant') AS tenant_id, quota_limit, CAST(1 AS INTEGER) AS rate_limit FROM tenants)"""


def _limits(spark, sf_dir):
    number = F.regexp_replace("id", "^t-", "tenant")
    return data.managed_tenants(spark, sf_dir).select(
        number.alias("tenant_id"), "quota_limit", F.lit(1).alias("rate_limit")
    )


_DAILY = """daily AS (
  SELECT d.*, coalesce(d.daily_usage > l.quota_limit, false) AS quota_exceeded FROM (
    SELECT tenant_id, CAST(ts AS DATE) AS day, count(*) AS daily_usage,
      CAST(sum(count(*)) OVER (PARTITION BY tenant_id, date_trunc('month', CAST(ts AS DATE)) ORDER BY CAST(ts AS DATE)) AS BIGINT)
        AS monthly_usage
    FROM stored GROUP BY tenant_id, CAST(ts AS DATE)) d
  LEFT JOIN limits l ON l.tenant_id = d.tenant_id)"""


@query(data.on_processed("SELECT * FROM daily", data.TENANTS, _LIMITS, _DAILY))
def daily_quota(spark, sf_dir):
    return usage.daily_usage(data.stored(spark, sf_dir), _limits(spark, sf_dir))


@query(data.on_processed("""
SELECT replace(t.id, 't-', 'tenant') AS tenant_id, t.quota_limit, coalesce(u.daily_usage, 0) AS daily_usage,
  coalesce(u.monthly_usage, 0) AS monthly_usage, coalesce(u.quota_exceeded, false) AS quota_exceeded
FROM tenants t LEFT JOIN (SELECT * FROM daily WHERE day = DATE '2024-01-15') u
  ON u.tenant_id = replace(t.id, 't-', 'tenant')""", data.TENANTS, _LIMITS, _DAILY))
def tenant_quota(spark, sf_dir):
    """Usage of one day for every tenant; zeros for silent ones."""
    limits = _limits(spark, sf_dir)
    day = usage.daily_usage(data.stored(spark, sf_dir), limits).filter(F.col("day") == F.lit("2024-01-15").cast("date"))
    return stats.with_tenants(day.drop("day"), limits.drop("rate_limit"))


@query(data.on_processed("""
SELECT m.*, coalesce(m.messages > l.rate_limit, false) AS rate_exceeded FROM (
  SELECT tenant_id, date_trunc('minute', ts) AS minute, count(*) AS messages FROM stored GROUP BY ALL) m
LEFT JOIN limits l ON l.tenant_id = m.tenant_id""", data.TENANTS, _LIMITS))
def rate_limit_minutes(spark, sf_dir):
    return usage.minute_usage(data.stored(spark, sf_dir), _limits(spark, sf_dir))


@query(data.on_processed("""
SELECT arrival_seq, coalesce(nth > l.rate_limit, false) AS over_limit FROM (
  SELECT arrival_seq, tenant_id, row_number() OVER (PARTITION BY tenant_id, date_trunc('minute', ts) ORDER BY arrival_seq)
    AS nth FROM stored) r
LEFT JOIN limits l ON l.tenant_id = r.tenant_id""", data.TENANTS, _LIMITS))
def rows_over_rate_limit(spark, sf_dir):
    marked = usage.over_rate_rows(data.stored(spark, sf_dir), _limits(spark, sf_dir))
    return marked.select("arrival_seq", "over_limit")


@query(data.on_clean("""
SELECT tenant_id, count(*) AS message_count, CAST(sum(CASE WHEN is_anomaly THEN 1 ELSE 0 END) AS BIGINT) AS anomaly_count,
  sum(CASE WHEN is_anomaly THEN 1 ELSE 0 END) / CAST(count(*) AS DOUBLE) AS anomaly_rate,
  CAST(sum(CAST(latency_seconds AS DECIMAL(18,4))) AS DOUBLE) / count(*) AS avg_latency,
  count(DISTINCT device_id) AS device_count, CAST(sum(strlen(value)) AS BIGINT) AS processed_data
FROM pipeline WHERE outcome IN ('normal', 'anomaly') GROUP BY 1""", data.PIPELINE))
def tenant_usage(spark, sf_dir):
    rows = data.exact(process.published(data.pipeline(spark, sf_dir)))
    return usage.tenant_usage_stats(rows)


@query(data.on_processed(f"""
SELECT t.tenant_id, average, maximum, minimum, t.count, coalesce(a.listed, 0) AS listed,
  coalesce(a.newest, -1) AS newest, coalesce(a.score_sum, 0) AS score_sum
FROM (SELECT tenant_id, {AVG.format('temperature')} AS average, CAST(max(temperature) AS DOUBLE) AS maximum,
        CAST(min(temperature) AS DOUBLE) AS minimum, count(temperature) AS count FROM stored GROUP BY 1) t
LEFT JOIN (SELECT tenant_id, count(*) AS listed, max(arrival_seq) AS newest, sum(anomaly_score) AS score_sum
           FROM (SELECT * FROM stored WHERE is_anomaly
                 QUALIFY row_number() OVER (PARTITION BY tenant_id ORDER BY arrival_seq DESC) <= 100)
           GROUP BY 1) a ON a.tenant_id = t.tenant_id"""))
def analytics_result(spark, sf_dir):
    result = data.plain(analytics.analytics_result(data.stored(spark, sf_dir), ts="measured_at"))
    score = F.aggregate("anomalies", F.lit(0.0), lambda a, x: a + x["anomaly_score"])
    return result.select(
        "tenant_id", "average", "maximum", "minimum", "count", F.size("anomalies").cast("bigint").alias("listed"),
        F.coalesce(F.try_element_at("anomalies", F.lit(1))["arrival_seq"], F.lit(-1)).alias("newest"), score.alias("score_sum"),
    )


@query(data.on_processed("""
SELECT tenant_id, arrival_seq, device_id, measured_at, CAST(temperature AS DOUBLE) AS value, anomaly_score FROM stored
WHERE is_anomaly"""))
def analytics_anomalies(spark, sf_dir):
    """Every anomaly of every tenant, as rows; ``analytics_result`` shows the newest of them."""
    rows = analytics.tenant_anomalies(data.stored(spark, sf_dir))
    return data.plain(rows).select(
        "tenant_id", "arrival_seq", "device_id", "measured_at", F.col("temperature").alias("value"), "anomaly_score"
    )


@query(data.on_processed("SELECT arrival_seq, tenant_id, device_id, anomaly_score FROM stored WHERE is_anomaly"))
def alerts(spark, sf_dir):
    rows = process.alerts(data.stored(spark, sf_dir))
    return rows.select("arrival_seq", "tenant_id", "device_id", "anomaly_score")
