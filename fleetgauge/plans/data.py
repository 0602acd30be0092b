"""Readings, raw messages and dimensions derived from the given tables, for Spark and as SQL.

The given tables hold no sensor readings, so they are derived row by row from ``events``: user -> tenant and device,
value and the number in props -> temperature and humidity, event_id -> arrival number. Every event becomes one reading.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from fleetgauge import schemas
from fleetgauge.operators import process
from fleetgauge.operators.clean import clean_messages
from fleetgauge.operators.lookup import computed_once
from fleetgauge.streaming.pipeline import clean_and_process

AS_OF = "2024-02-01 00:00:00"
# Short policies, so that retention deletes part of the 30 days of events.
POLICIES = [("tenant1", 10), ("tenant2", 20)]
POLICY_DEFAULT = 15
SUBSCRIBER_ALL_FROM = 20


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def readings_of(events: DataFrame) -> DataFrame:
    k = F.col("k")
    events = computed_once(events.withColumn("k", F.get_json_object("props", "$.k")), ["k"])
    shift = F.when(F.col("event_type") == "signup", 60.0).otherwise(15.0)
    return events.select(
        F.col("event_id").alias("arrival_seq"),
        "user_id",
        F.concat(F.lit("tenant"), (F.col("user_id") % 5).cast("string")).alias("tenant_id"),
        F.concat(F.lit("device-"), (F.col("user_id") % 20).cast("string")).alias("device_id"),
        "ts",
        # Readings are measured up to 99 minutes before they arrive.
        (F.col("ts") - F.make_dt_interval(mins=k.cast("int"))).alias("measured_at"),
        F.when(F.col("event_type") != "error", F.col("value") - shift).alias("temperature"),
        F.when(F.col("event_type") != "view", k.cast("double") * 1.25 - 10.0).alias("humidity"),
        (k.cast("double") / 100.0).alias("latency_seconds"),
    )


def readings(spark: SparkSession, sf_dir: str) -> DataFrame:
    return readings_of(table(spark, sf_dir, "events"))


READINGS = """readings AS (
  SELECT event_id AS arrival_seq, user_id,
         concat('tenant', CAST(user_id % 5 AS VARCHAR)) AS tenant_id,
         concat('device-', CAST(user_id % 20 AS VARCHAR)) AS device_id,
         ts, ts - to_minutes(CAST(json_extract_string(props, '$.k') AS BIGINT)) AS measured_at,
         CASE WHEN event_type <> 'error' THEN value - CASE WHEN event_type = 'signup' THEN 60.0E0 ELSE 15.0E0 END END
           AS temperature,
         CASE WHEN event_type <> 'view' THEN CAST(json_extract_string(props, '$.k') AS DOUBLE) * 1.25E0 - 10.0E0 END
           AS humidity,
         CAST(json_extract_string(props, '$.k') AS DOUBLE) / 100.0E0 AS latency_seconds
  FROM events)"""


def exact(df: DataFrame) -> DataFrame:
    """Metrics as decimals, so that sums do not depend on the order of addition."""
    names = [c for c in (*schemas.METRICS, "latency_seconds") if c in df.columns]
    return df.withColumns({c: F.col(c).cast("decimal(18,4)") for c in names})


def plain(df: DataFrame) -> DataFrame:
    """Decimals back to doubles for the result."""
    return df.select(*[F.col(c).cast("double").alias(c) if t.startswith("decimal") else F.col(c) for c, t in df.dtypes])


EXACT = """exact AS (
  SELECT * REPLACE (CAST(temperature AS DECIMAL(18,4)) AS temperature, CAST(humidity AS DECIMAL(18,4)) AS humidity,
                    CAST(latency_seconds AS DECIMAL(18,4)) AS latency_seconds)
  FROM processed)"""

# Average of a decimal column: exact sum, one division.
AVG = "CAST(sum({0}) AS DOUBLE) / nullif(count({0}), 0)"


def raw_messages_of(source: DataFrame) -> DataFrame:
    """JSON text with every kind of defect the cleaning rules know."""
    r = source.withColumn("event_id", F.col("arrival_seq"))
    part = F.expr
    text = F.concat(
        F.lit("{"),
        part("""CASE WHEN event_id % 20 = 3 THEN '' WHEN event_id % 40 = 11 THEN '"device_id":"",'
                WHEN event_id % 40 = 31 THEN '"device_id":123,' ELSE concat('"device_id":"', device_id, '",') END"""),
        part("""CASE WHEN event_id % 60 = 13 THEN '"sensor_id":7,'
                WHEN event_id % 4 = 0 THEN concat('"sensor_id":"s-', CAST(user_id AS STRING), '",') ELSE '' END"""),
        part("""CASE event_id % 5 WHEN 0 THEN ''
                WHEN 1 THEN concat('"timestamp":', CAST(1704067200 + event_id AS STRING), ',')
                WHEN 2 THEN '"timestamp":"not-a-time",' WHEN 3 THEN '"timestamp":null,'
                ELSE concat('"timestamp":"2024-01-', lpad(CAST(1 + event_id % 28 AS STRING), 2, '0'), 'T00:00:00Z",')
                END"""),
        part("""CASE WHEN temperature IS NULL THEN ''
                ELSE concat('"temperature":', CAST(CAST(temperature AS DECIMAL(10,4)) AS STRING), ',') END"""),
        part("""CASE WHEN humidity IS NULL THEN '' WHEN event_id % 30 = 9 THEN '"humidity":"n/a",'
                ELSE concat('"humidity":', CAST(CAST(humidity AS DECIMAL(10,4)) AS STRING), ',') END"""),
        part("""concat('"tenant_id":"', tenant_id, '"}')"""),
    )
    value = F.when(F.col("event_id") % 50 == 7, F.lit("{bad json")).otherwise(text)
    rows = r.select("arrival_seq", value.alias("value"), F.col("ts").cast("timestamp").alias("ingest_ts"), "latency_seconds")
    return computed_once(rows, ["value"])


def raw_messages(spark: SparkSession, sf_dir: str) -> DataFrame:
    return raw_messages_of(readings(spark, sf_dir))


RAW = """raw AS (
  SELECT arrival_seq, ts AS ingest_ts, latency_seconds,
    CASE WHEN arrival_seq % 50 = 7 THEN '{bad json' ELSE concat('{',
      CASE WHEN arrival_seq % 20 = 3 THEN '' WHEN arrival_seq % 40 = 11 THEN '"device_id":"",'
           WHEN arrival_seq % 40 = 31 THEN '"device_id":123,' ELSE concat('"device_id":"', device_id, '",') END,
      CASE WHEN arrival_seq % 60 = 13 THEN '"sensor_id":7,'
           WHEN arrival_seq % 4 = 0 THEN concat('"sensor_id":"s-', CAST(user_id AS VARCHAR), '",') ELSE '' END,
      CASE arrival_seq % 5 WHEN 0 THEN ''
           WHEN 1 THEN concat('"timestamp":', CAST(1704067200 + arrival_seq AS VARCHAR), ',')
           WHEN 2 THEN '"timestamp":"not-a-time",' WHEN 3 THEN '"timestamp":null,'
           ELSE concat('"timestamp":"2024-01-', lpad(CAST(1 + arrival_seq % 28 AS VARCHAR), 2, '0'), 'T00:00:00Z",')
           END,
      CASE WHEN temperature IS NULL THEN ''
           ELSE concat('"temperature":', CAST(CAST(temperature AS DECIMAL(10,4)) AS VARCHAR), ',') END,
      CASE WHEN humidity IS NULL THEN '' WHEN arrival_seq % 30 = 9 THEN '"humidity":"n/a",'
           ELSE concat('"humidity":', CAST(CAST(humidity AS DECIMAL(10,4)) AS VARCHAR), ',') END,
      '"tenant_id":"', tenant_id, '"}') END AS value
  FROM readings)"""

# Typed and checked form of the raw messages.
CLEAN = """parsed AS (
  SELECT *, json_type(j, '$.device_id') AS dk, json_type(j, '$.sensor_id') AS sk, json_type(j, '$.timestamp') AS tk,
         json_type(j, '$.temperature') AS ck, json_type(j, '$.humidity') AS hk, json_type(j, '$.tenant_id') AS nk
  FROM (SELECT *, CASE WHEN json_valid(value) THEN value END AS j FROM raw)),
typed AS (
  SELECT *,
    CASE WHEN dk = 'VARCHAR' THEN json_extract_string(j, '$.device_id') END AS device_id,
    CASE WHEN sk = 'VARCHAR' THEN json_extract_string(j, '$.sensor_id') END AS sensor_id,
    CASE WHEN nk = 'VARCHAR' THEN json_extract_string(j, '$.tenant_id') END AS tenant_id,
    CASE WHEN tk = 'VARCHAR' AND regexp_full_match(json_extract_string(j, '$.timestamp'),
           '\\d{4}-\\d{2}-\\d{2}T\\d{2}:\\d{2}:\\d{2}([.,]\\d+)?(Z|[+-]\\d{2}:\\d{2})')
         THEN json_extract_string(j, '$.timestamp') END AS good_text,
    CASE WHEN ck IN ('DOUBLE', 'BIGINT', 'UBIGINT') THEN CAST(json_extract_string(j, '$.temperature') AS DOUBLE) END
      AS temperature,
    CASE WHEN hk IN ('DOUBLE', 'BIGINT', 'UBIGINT') THEN CAST(json_extract_string(j, '$.humidity') AS DOUBLE) END
      AS raw_humidity
  FROM parsed),
clean AS (
  SELECT *,
    CASE WHEN j IS NULL THEN 'invalid JSON'
         WHEN dk IS NULL AND sk IS NULL THEN 'missing required field: device_id or sensor_id'
         WHEN dk IS NOT NULL AND (dk <> 'VARCHAR' OR device_id = '') THEN 'device_id must be a non-empty string'
         WHEN sk IS NOT NULL AND (sk <> 'VARCHAR' OR sensor_id = '') THEN 'sensor_id must be a non-empty string'
         WHEN tk = 'VARCHAR' AND good_text IS NULL
           THEN 'timestamp must be RFC3339 string or Unix timestamp number' END AS reason,
    CASE WHEN tk IS NULL THEN NULL WHEN good_text IS NOT NULL THEN good_text
         WHEN tk IN ('DOUBLE', 'BIGINT', 'UBIGINT')
           THEN strftime(make_timestamp(CAST(trunc(CAST(json_extract_string(j, '$.timestamp') AS DOUBLE)) AS BIGINT)
                                        * 1000000), '%Y-%m-%dT%H:%M:%SZ')
         ELSE strftime(ingest_ts, '%Y-%m-%dT%H:%M:%SZ') END AS timestamp_text,
    CASE WHEN raw_humidity < 0 THEN 0.0E0 WHEN raw_humidity > 100 THEN 100.0E0 ELSE raw_humidity END AS humidity,
    coalesce(temperature < -50 OR temperature > 60, false) AS temperature_warning,
    greatest(1.0E0 - CASE WHEN dk IS NULL THEN 0.1E0 ELSE 0 END - CASE WHEN sk IS NULL THEN 0.1E0 ELSE 0 END
             - CASE WHEN tk IS NULL THEN 0.1E0 ELSE 0 END
             - CASE WHEN temperature < -50 OR temperature > 60 THEN 0.2E0 ELSE 0 END, 0) AS quality_score,
    coalesce(dk NOT IN ('VARCHAR', 'NULL'), false) OR coalesce(nk NOT IN ('VARCHAR', 'NULL'), false)
      OR coalesce(ck NOT IN ('DOUBLE', 'BIGINT', 'UBIGINT', 'NULL'), false)
      OR coalesce(hk NOT IN ('DOUBLE', 'BIGINT', 'UBIGINT', 'NULL'), false) AS type_error
  FROM typed)"""


def _score_sql(source: str, error: str) -> str:
    return f"""
  SELECT *, CASE WHEN {error} THEN 'error' WHEN NOT kept THEN 'sampled_out' WHEN is_anomaly THEN 'anomaly'
                 ELSE 'normal' END AS outcome
  FROM (SELECT *, anomaly_score >= CASE tenant_id WHEN 'tenant1' THEN 3.0E0 WHEN 'tenant2' THEN 2.5E0 ELSE 2.0E0 END
                    AS is_anomaly,
               tenant_id <> 'tenant2' OR draw <= 0.5E0 AS kept
        FROM (SELECT *, (CASE WHEN temperature > 30 OR temperature < 10 THEN 1.0E0 ELSE 0.0E0 END
                         + CASE WHEN humidity > 80 OR humidity < 20 THEN 1.0E0 ELSE 0.0E0 END) AS anomaly_score,
                     (CAST(('0x' || substr(md5(CAST(arrival_seq AS VARCHAR)), 1, 8)) AS BIGINT) % 1000000) / 1000000.0E0
                       AS draw
              FROM {source}))"""


# Typed readings scored with the engine's tenant settings.
PROCESSED = f"processed AS ({_score_sql('readings', 'false')})"

# The whole path from raw text: cleaned, checked, scored.
PIPELINE = f"""pipeline AS ({_score_sql(
    "(SELECT * REPLACE (coalesce(nullif(tenant_id, ''), 'default') AS tenant_id) FROM clean)",
    "reason IS NOT NULL OR type_error OR coalesce(device_id, '') = ''")})"""


def processed(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = readings(spark, sf_dir)
    return process.process_readings(rows, schemas.tenant_config(spark), now=F.col("ts"))


def stored(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Published rows with exact metrics; event time and creation time are the event's own."""
    return exact(process.published(processed(spark, sf_dir)))


STORED = "stored AS (SELECT * FROM exact WHERE outcome IN ('normal', 'anomaly'))"


def cleaned(spark: SparkSession, sf_dir: str, **options) -> DataFrame:
    return clean_messages(raw_messages(spark, sf_dir), **options)


def pipeline(spark: SparkSession, sf_dir: str) -> DataFrame:
    return clean_and_process(raw_messages(spark, sf_dir), schemas.tenant_config(spark))


def policies(spark: SparkSession) -> DataFrame:
    return schemas.retention_policies(spark, POLICIES)


def managed_tenants(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One tenant per customer; segment -> tier, balance -> active."""
    c = table(spark, sf_dir, "customer")
    tier = (
        F.when(F.col("c_mktsegment") == "BUILDING", "free")
        .when(F.col("c_mktsegment") == "MACHINERY", "premium")
        .when(F.col("c_mktsegment") == "HOUSEHOLD", "gold")
        .otherwise("STANDARD")
    )
    return c.select(
        F.concat(F.lit("t-"), F.col("c_custkey").cast("string")).alias("id"),
        F.col("c_name").alias("name"),
        F.concat(F.lit("key-"), F.col("c_custkey").cast("string")).alias("api_key"),
        tier.alias("tier"),
        (F.col("c_acctbal") > 0).alias("active"),
        F.lit("2023-12-01 00:00:00").cast("timestamp").alias("created_at"),
        (F.col("c_nationkey") * 10).cast("int").alias("quota_limit"),
        (F.col("c_nationkey") + 1).cast("int").alias("rate_limit"),
        F.lit(0.5).alias("sampling_rate"),
        (F.col("c_nationkey") + 7).cast("int").alias("retention_days"),
    )


TENANTS = """tenants AS (
  SELECT concat('t-', CAST(c_custkey AS VARCHAR)) AS id, c_name AS name,
         concat('key-', CAST(c_custkey AS VARCHAR)) AS api_key,
         CASE c_mktsegment WHEN 'BUILDING' THEN 'free' WHEN 'MACHINERY' THEN 'premium' WHEN 'HOUSEHOLD' THEN 'gold'
              ELSE 'STANDARD' END AS tier,
         c_acctbal > 0 AS active, TIMESTAMP '2023-12-01 00:00:00' AS created_at,
         CAST(c_nationkey * 10 AS INTEGER) AS quota_limit, CAST(c_nationkey + 1 AS INTEGER) AS rate_limit,
         0.5E0 AS sampling_rate, CAST(c_nationkey + 7 AS INTEGER) AS retention_days
  FROM customer)"""


def subscribers(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One viewer per nation; the last few listen to every tenant, one names none."""
    key = F.col("n_nationkey")
    tenant = (
        F.when(key == 0, "").when(key >= SUBSCRIBER_ALL_FROM, "all")
        .otherwise(F.concat(F.lit("tenant"), (key % 5).cast("string")))
    )
    return table(spark, sf_dir, "nation").select(F.col("n_name").alias("subscriber_id"), tenant.alias("tenant_id"))


SUBSCRIBERS = f"""subscribers AS (
  SELECT n_name AS subscriber_id, CASE WHEN n_nationkey = 0 THEN 'default' WHEN n_nationkey >= {SUBSCRIBER_ALL_FROM} THEN 'all'
         ELSE concat('tenant', CAST(n_nationkey % 5 AS VARCHAR)) END AS tenant_id FROM nation)"""


def sql(body: str, *ctes: str) -> str:
    return "WITH " + ",\n".join(ctes) + "\n" + body


def on_readings(body: str, *more: str) -> str:
    return sql(body, READINGS, *more)


def on_clean(body: str, *more: str) -> str:
    return sql(body, READINGS, RAW, CLEAN, *more)


def on_processed(body: str, *more: str) -> str:
    return sql(body, READINGS, PROCESSED, EXACT, STORED, *more)
