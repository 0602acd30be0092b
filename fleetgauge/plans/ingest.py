"""Registered queries: parsing, cleaning, checks, scoring, outcomes."""

from __future__ import annotations

import uuid

from pyspark.sql import functions as F

from fleetgauge import schemas
from fleetgauge.functions import documents, scoring, timestamps
from fleetgauge.operators import clean, process, quality, validate
from fleetgauge.plans import data
from fleetgauge.plans.registry import query
from fleetgauge.session import shared_dir
from fleetgauge.sources import messages


@query(data.on_readings("""
SELECT arrival_seq, temperature, CASE WHEN humidity < 0 THEN 0.0E0 WHEN humidity > 100 THEN 100.0E0 ELSE humidity END
         AS humidity, coalesce(temperature < -50 OR temperature > 60, false) AS temperature_warning FROM readings"""))
def clean_humidity_clamp(spark, sf_dir):
    r = data.readings(spark, sf_dir)
    return r.select(
        "arrival_seq",
        scoring.clean_value("temperature", F.col("temperature")).alias("temperature"),
        scoring.clean_value("humidity", F.col("humidity")).alias("humidity"),
        scoring.temperature_warning(F.col("temperature")).alias("temperature_warning"),
    )


@query(data.on_clean("SELECT arrival_seq, timestamp_text FROM clean WHERE j IS NOT NULL"))
def normalize_timestamp(spark, sf_dir):
    return data.cleaned(spark, sf_dir).filter("is_json").select("arrival_seq", "timestamp_text")


@query(data.on_clean("SELECT arrival_seq, round(quality_score, 6) AS quality_score FROM clean WHERE j IS NOT NULL"))
def quality_score(spark, sf_dir):
    rows = data.cleaned(spark, sf_dir).filter("is_json")
    return rows.select("arrival_seq", F.round("quality_score", 6).alias("quality_score"))


@query(data.on_clean("SELECT arrival_seq, reason AS reject_reason FROM clean"))
def validate_required(spark, sf_dir):
    return data.cleaned(spark, sf_dir).select("arrival_seq", "reject_reason")


@query(data.on_clean("SELECT coalesce(reason, 'ok') AS reason, count(*) AS messages FROM clean GROUP BY 1"))
def reject_counts(spark, sf_dir):
    return clean.reject_counts(data.cleaned(spark, sf_dir))


@query(data.on_clean("SELECT arrival_seq, value, reason AS reject_reason FROM clean WHERE reason IS NOT NULL"))
def quarantine(spark, sf_dir):
    return clean.rejected(data.cleaned(spark, sf_dir)).select("arrival_seq", "value", "reject_reason")


@query(data.on_clean("""
SELECT CASE WHEN j IS NULL THEN 'invalid JSON' ELSE 'ok' END AS reason, count(*) AS messages FROM clean GROUP BY 1"""))
def unvalidated_counts(spark, sf_dir):
    """The topic path, which cleans without checking required fields."""
    return clean.reject_counts(data.cleaned(spark, sf_dir, validate=False))


@query(data.on_clean("""
SELECT arrival_seq, value, device_id AS key FROM clean
WHERE j IS NOT NULL AND dk IS NOT NULL AND NOT (dk = 'VARCHAR' AND device_id = '')"""))
def ingest_accepted(spark, sf_dir):
    accepted = clean.accepted_at_ingest(data.raw_messages(spark, sf_dir))
    return accepted.select("arrival_seq", "value", "key")


@query(data.on_clean("""
SELECT arrival_seq, device_id, sensor_id, tenant_id, temperature, humidity, temperature_warning, type_error
FROM clean WHERE reason IS NULL"""))
def clean_typed(spark, sf_dir):
    return clean.accepted(data.cleaned(spark, sf_dir)).select(
        "arrival_seq", "device_id", "sensor_id", "tenant_id", "temperature", "humidity", "temperature_warning", "type_error"
    )


@query(data.on_clean("""
SELECT arrival_seq, concat('{',
  CASE dk WHEN 'VARCHAR' THEN concat('"device_id":"', device_id, '",') WHEN 'UBIGINT' THEN '"device_id":123,' ELSE '' END,
  CASE sk WHEN 'VARCHAR' THEN concat('"sensor_id":"', sensor_id, '",') WHEN 'UBIGINT' THEN '"sensor_id":7,' ELSE '' END,
  '"tenant_id":"', tenant_id, '",',
  CASE WHEN timestamp_text IS NULL THEN '' ELSE concat('"timestamp":"', timestamp_text, '",') END,
  CASE WHEN temperature IS NULL THEN '' ELSE concat('"temperature":', CAST(temperature AS VARCHAR), ',') END,
  CASE WHEN hk IS NULL THEN '' WHEN humidity IS NULL THEN '"humidity":"n/a",'
       ELSE concat('"humidity":', CAST(humidity AS VARCHAR), ',') END,
  '"processed_at":"', strftime(ingest_ts, '%Y-%m-%dT%H:%M:%SZ'), '",',
  '"quality_score":', CAST(round(quality_score, 6) AS VARCHAR), '}') AS message
FROM clean WHERE j IS NOT NULL"""))
def clean_json(spark, sf_dir):
    rows = data.cleaned(spark, sf_dir).filter("is_json")
    return rows.select("arrival_seq", clean.to_clean_json(rows).alias("message"))


@query(data.on_clean("""
SELECT arrival_seq, j IS NULL OR type_error OR coalesce(tk NOT IN ('VARCHAR', 'NULL'), false)
         OR coalesce(tk = 'VARCHAR' AND good_text IS NULL, false) AS type_error,
       device_id, tenant_id, temperature, raw_humidity AS humidity,
       CAST(replace(replace(good_text, 'T', ' '), 'Z', '') AS TIMESTAMP) AS ts
FROM clean"""))
def decode_raw(spark, sf_dir):
    """Decoding without cleaning first: numeric timestamps spoil the record."""
    return clean.decode_readings(data.raw_messages(spark, sf_dir)).select(
        "arrival_seq", "type_error", "device_id", "tenant_id", "temperature", "humidity", "ts"
    )


@query(data.on_processed("SELECT arrival_seq, anomaly_score FROM processed"))
def anomaly_score(spark, sf_dir):
    r = data.readings(spark, sf_dir)
    return r.select("arrival_seq", scoring.anomaly_score(F.col("temperature"), F.col("humidity")).alias("anomaly_score"))


@query(data.on_processed("SELECT arrival_seq, tenant_id, anomaly_score, is_anomaly FROM processed"))
def anomaly_flags(spark, sf_dir):
    return data.processed(spark, sf_dir).select("arrival_seq", "tenant_id", "anomaly_score", "is_anomaly")


@query(data.on_processed("SELECT arrival_seq, tenant_id FROM processed WHERE kept"))
def sampled(spark, sf_dir):
    kept = data.processed(spark, sf_dir).filter(F.col("outcome") != "sampled_out")
    return kept.select("arrival_seq", "tenant_id")


@query(data.on_processed("""
SELECT arrival_seq, outcome, measured_at AS timestamp, date_trunc('second', ts) AS created_at FROM processed"""))
def processed_rows(spark, sf_dir):
    rows = data.readings(spark, sf_dir).withColumn("arrived", F.col("ts")).withColumn("ts", F.col("measured_at"))
    out = process.process_readings(rows, schemas.tenant_config(spark), now=F.col("arrived"))
    return out.select(
        "arrival_seq", "outcome", "timestamp", timestamps.cut_to_second(F.col("processed_at")).alias("created_at")
    )


@query(data.on_clean("SELECT arrival_seq, tenant_id, outcome FROM pipeline", data.PIPELINE))
def message_outcomes(spark, sf_dir):
    return data.pipeline(spark, sf_dir).select("arrival_seq", "tenant_id", "outcome")


@query(data.on_clean("""
SELECT arrival_seq, CASE WHEN type_error OR coalesce(tenant_id, '') = '' THEN 'error' WHEN NOT kept THEN 'sampled_out'
  WHEN coalesce(device_id, '') = '' OR temperature IS NULL OR humidity IS NULL THEN 'error'
  WHEN is_anomaly THEN 'anomaly' ELSE 'normal' END AS outcome
FROM pipeline WHERE j IS NOT NULL""", data.PIPELINE))
def strict_outcomes(spark, sf_dir):
    rows = data.cleaned(spark, sf_dir, validate=False).filter("is_json").drop("processed_at")
    out = process.process_readings(rows, schemas.tenant_config(spark), profile="strict")
    return out.select("arrival_seq", "outcome")


_CHECKS = """
SELECT '{0}' AS profile, coalesce(CASE {1} END, 'ok') AS reason, count(*) AS messages
FROM clean WHERE j IS NOT NULL GROUP BY 2"""
_DEVICE = "WHEN coalesce(device_id, '') = '' THEN 'device_id is required'"
_TENANT = "WHEN coalesce(tenant_id, '') = '' THEN 'tenant_id is required'"
_METRICS = "WHEN temperature IS NULL OR humidity IS NULL THEN 'temperature and humidity are required'"
_CONTRACT = (
    "WHEN coalesce(length(device_id), 0) NOT BETWEEN 1 AND 100 THEN 'device_id length' "
    "WHEN temperature NOT BETWEEN -273.15 AND 1000 THEN 'temperature out of range' "
    "WHEN raw_humidity NOT BETWEEN 0 AND 100 THEN 'humidity out of range'"
)
_PROFILES = {
    "engine": _DEVICE, "strict": f"{_TENANT} {_DEVICE} {_METRICS}", "dashboard": f"{_DEVICE} {_METRICS} {_TENANT}",
    "store": f"{_DEVICE} {_TENANT}",
}


@query(data.on_clean(" UNION ALL ".join(_CHECKS.format(p, rules) for p, rules in _PROFILES.items())))
def record_checks(spark, sf_dir):
    """All record checks in one pass over the messages."""
    rows = data.cleaned(spark, sf_dir, validate=False).filter("is_json")
    reasons = F.array(*[
        F.struct(F.lit(p).alias("profile"), F.coalesce(validate.reason(p, rows.columns), F.lit("ok")).alias("reason"))
        for p in _PROFILES
    ])
    return rows.select(F.inline(reasons)).groupBy("profile", "reason").agg(F.count(F.lit(1)).alias("messages"))


@query(data.on_clean(f"""
SELECT arrival_seq, CASE {_CONTRACT} END AS reject_reason FROM clean WHERE j IS NOT NULL"""))
def contract_check(spark, sf_dir):
    rows = clean.decode_readings(data.raw_messages(spark, sf_dir))
    return validate.check(rows.filter("is_json"), "contract").select("arrival_seq", "reject_reason")


@query(data.on_processed("""
SELECT arrival_seq, concat('{"device_id":"', device_id, '",',
  CASE WHEN temperature IS NULL THEN '' ELSE concat('"temperature":', CAST(temperature AS VARCHAR), ',') END,
  CASE WHEN humidity IS NULL THEN '' ELSE concat('"humidity":', CAST(humidity AS VARCHAR), ',') END,
  '"timestamp":"', strftime(ts, '%Y-%m-%dT%H:%M:%SZ'), '","processed_at":"', strftime(ts, '%Y-%m-%dT%H:%M:%SZ'), '",',
  CASE WHEN is_anomaly THEN '"is_anomaly":true,' ELSE '' END,
  CASE WHEN anomaly_score = 0 THEN '' ELSE concat('"anomaly_score":', CAST(anomaly_score AS VARCHAR), ',') END,
  '"tenant_id":"', tenant_id, '"}') AS message
FROM stored"""))
def processed_json(spark, sf_dir):
    rows = data.stored(spark, sf_dir)
    return rows.select("arrival_seq", process.to_processed_json(rows).alias("message"))


@query(data.on_processed("""
SELECT arrival_seq, device_id, tenant_id, CAST(temperature AS DOUBLE) AS temperature, CAST(humidity AS DOUBLE) AS humidity,
  CASE WHEN is_anomaly THEN true END AS is_anomaly, nullif(anomaly_score, 0) AS anomaly_score,
  date_trunc('second', ts) AS timestamp FROM stored"""))
def decode_stored_message(spark, sf_dir):
    """Processed JSON read back: a zero score comes back as null."""
    rows = data.stored(spark, sf_dir)
    read = process.decode_processed(rows.select("arrival_seq", process.to_processed_json(rows).alias("value")))
    return read.filter(~F.col("type_error")).drop("type_error")


@query(data.on_processed("""
SELECT arrival_seq AS row_key, device_id, CAST(temperature AS DOUBLE) AS temperature, CAST(humidity AS DOUBLE) AS humidity,
  date_trunc('second', ts) AS timestamp, is_anomaly, anomaly_score, date_trunc('second', ts) AS created_at, tenant_id,
  CAST(ts AS DATE) AS created_date FROM stored"""))
def stored_rows(spark, sf_dir):
    return process.for_store(data.stored(spark, sf_dir), created_at=F.col("processed_at"))


_FLAGS = ("device_id", "dk"), ("sensor_id", "sk"), ("timestamp", "tk"), ("temperature", "ck"), ("humidity", "hk"), ("tenant_id", "nk")


@query(data.on_clean(f"""
SELECT arrival_seq, ({' + '.join(f'CASE WHEN {k} IS NULL THEN 0 ELSE 1 END' for _, k in _FLAGS)}) / 6.0E0 AS completeness,
  1 - (CASE WHEN temperature_warning THEN 1 ELSE 0 END + CASE WHEN raw_humidity < 0 OR raw_humidity > 100 THEN 1 ELSE 0 END)
      / 2.0E0 AS accuracy,
  CASE WHEN type_error THEN 0.0E0 ELSE 1.0E0 END AS consistency,
  concat_ws(',', {', '.join(f"CASE WHEN {k} IS NULL THEN 'missing_{n}' END" for n, k in _FLAGS)},
    CASE WHEN temperature_warning THEN 'temperature_implausible' END,
    CASE WHEN raw_humidity < 0 OR raw_humidity > 100 THEN 'humidity_clamped' END,
    CASE WHEN type_error THEN 'wrong_type' END) AS flags,
  concat_ws(',', CASE WHEN tk IS NOT NULL THEN 'normalize_timestamp' END,
    CASE WHEN raw_humidity < 0 OR raw_humidity > 100 THEN 'clamp_humidity' END, 'quality_score') AS applied_rules
FROM clean WHERE j IS NOT NULL"""))
def quality_report(spark, sf_dir):
    report = quality.quality_report(data.cleaned(spark, sf_dir).filter("is_json"))
    return report.select(
        "arrival_seq", "completeness", "accuracy", "consistency",
        F.array_join("flags", ",").alias("flags"), F.array_join("applied_rules", ",").alias("applied_rules"),
    )


@query(data.on_clean("""
SELECT arrival_seq, round(quality_score, 6) AS quality_score, quality_score < 0.75 AS too_low FROM clean WHERE j IS NOT NULL"""))
def low_quality(spark, sf_dir):
    rows = quality.below_quality(data.cleaned(spark, sf_dir).filter("is_json"), 0.75)
    return rows.select("arrival_seq", F.round("quality_score", 6).alias("quality_score"), "too_low")


@query(data.on_clean("SELECT arrival_seq, json_valid(value) AS is_valid FROM raw"))
def json_validity(spark, sf_dir):
    return data.raw_messages(spark, sf_dir).select("arrival_seq", documents.is_valid("value").alias("is_valid"))


@query(data.on_clean("""
SELECT device_id, sensor_id, temperature, humidity, reason AS reject_reason, count(*) AS messages FROM clean GROUP BY ALL"""))
def landed_messages(spark, sf_dir):
    """Readings landed as lines of text files, read back and cleaned; lines have no number of their own."""
    landing = f"{shared_dir(spark)}/fleetgauge-{uuid.uuid4().hex}"
    data.raw_messages(spark, sf_dir).select("value").write.text(landing)
    cleaned = clean.clean_messages(messages.read_landing(spark, landing))
    columns = ["device_id", "sensor_id", "temperature", "humidity", "reject_reason"]
    return cleaned.groupBy(*columns).agg(F.count(F.lit(1)).alias("messages"))
