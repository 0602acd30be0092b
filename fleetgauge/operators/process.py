"""Readings to processed records: tenant settings, sampling, anomaly score, outcome."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from fleetgauge import schemas
from fleetgauge.functions import documents as D
from fleetgauge.functions import scoring, timestamps
from fleetgauge.operators import validate
from fleetgauge.operators.lookup import computed_once, join_dimension

OUTCOMES = ("normal", "anomaly", "error", "sampled_out")


def with_tenant_config(df: DataFrame, config: DataFrame) -> DataFrame:
    """Add ``anomaly_threshold`` and ``sampling_rate``; tenants without settings get the defaults."""
    dim = config.select("tenant_id", F.col("anomaly_threshold").alias("_t"), F.col("sampling_rate").alias("_r"))
    return join_dimension(df, dim, "tenant_id").select(
        *df.columns,
        F.coalesce("_t", F.lit(schemas.DEFAULT_ANOMALY_THRESHOLD)).alias("anomaly_threshold"),
        F.coalesce("_r", F.lit(schemas.DEFAULT_SAMPLING_RATE)).alias("sampling_rate"),
    )


def process_readings(
    df: DataFrame,
    config: DataFrame,
    row_key: str = "arrival_seq",
    profile: str = "engine",
    now: Column | None = None,
) -> DataFrame:
    """Score every reading and give it an ``outcome``; nothing is dropped.

    Columns in: device_id, tenant_id, ts, temperature, humidity, ``row_key`` and, if decoded from JSON,
    ``type_error``. ``engine`` checks the device before sampling, ``strict`` samples before it checks the fields.
    """
    if now is None:
        now = F.col("ingest_ts") if "ingest_ts" in df.columns else F.current_timestamp()
    settled = df
    if profile == "engine":
        settled = df.withColumn("tenant_id", scoring.default_tenant(F.col("tenant_id")))
    settled = with_tenant_config(settled, config).withColumn(
        "_reason", validate.reason(profile, df.columns)
    )
    broken = F.col("type_error") if "type_error" in df.columns else F.lit(False)
    refused = F.col("_reason").isNotNull()
    sampled_out = ~scoring.kept_by_sampling(F.col(row_key), F.col("sampling_rate"))
    score = scoring.anomaly_score(F.col("temperature"), F.col("humidity"))
    is_anomaly = score >= F.col("anomaly_threshold")
    if profile == "engine":
        gate = F.when(broken | refused, "error").when(sampled_out, "sampled_out")
    else:
        gate = F.when(broken | (F.col("_reason") == "tenant_id is required"), "error")
        gate = gate.when(sampled_out, "sampled_out").when(refused, "error")
    outcome = gate.when(is_anomaly, "anomaly").otherwise("normal")
    return settled.select(
        *[c for c in settled.columns if c not in ("_reason", "type_error", "anomaly_threshold", "sampling_rate")],
        score.alias("anomaly_score"),
        is_anomaly.alias("is_anomaly"),
        F.coalesce("ts", now.cast("timestamp")).alias("timestamp"),
        now.cast("timestamp").alias("processed_at"),
        outcome.alias("outcome"),
    )


def published(df: DataFrame) -> DataFrame:
    """Rows that leave the engine."""
    return df.filter(F.col("outcome").isin("normal", "anomaly"))


def alerts(df: DataFrame) -> DataFrame:
    """Anomalous rows only."""
    return df.filter(F.col("outcome") == "anomaly")


def to_processed_json(df: DataFrame) -> Column:
    """Processed record as JSON: null metrics, a false flag, a zero score and an empty tenant are left out."""
    columns = [
        F.col("device_id"),
        F.col("temperature"),
        F.col("humidity"),
        timestamps.format_rfc3339(F.col("timestamp")).alias("timestamp"),
        timestamps.format_rfc3339(F.col("processed_at")).alias("processed_at"),
        F.nullif(F.col("is_anomaly"), F.lit(False)).alias("is_anomaly"),
        F.nullif(F.col("anomaly_score"), F.lit(0.0)).alias("anomaly_score"),
        F.nullif(F.col("tenant_id"), F.lit("")).alias("tenant_id"),
    ]
    columns += [F.col(c) for c in ("temperature_stats", "humidity_stats") if c in df.columns]
    return F.to_json(F.struct(*columns))


def decode_processed(df: DataFrame, value: str = "value") -> DataFrame:
    """Processed JSON back to columns, as the store reads it; omitted fields are null.

    ``type_error`` marks texts that are no record, or hold a value of the wrong type or a timestamp that is no RFC 3339
    time: the store takes none of them.
    """
    texts, numbers, flag = ("device_id", "tenant_id", "timestamp"), ("temperature", "humidity", "anomaly_score"), "is_anomaly"
    names = (*texts, *numbers, flag)
    rest = [c for c in df.columns if c != value]
    kinds = {n: F.col(f"_kinds.{n}") for n in names}
    fits = F.col("_r").isNotNull()
    for n in names:
        right = D.is_string(kinds[n]) if n in texts else D.is_number(kinds[n]) if n in numbers else kinds[n].eqNullSafe("BOOLEAN")
        fits = fits & (right | D.absent_or_null(kinds[n]))
    read = (
        df.select(*rest, D.members(F.try_parse_json(value), names).alias("_r"))
        .withColumn("_kinds", F.struct(*[D.kind(F.col(f"_r.{n}")).alias(n) for n in names]))
        .select(
            *rest,
            *[D.text(F.col(f"_r.{n}"), kinds[n]).alias(n) for n in ("device_id", "tenant_id")],
            *[D.number(F.col(f"_r.{n}"), kinds[n]).alias(n) for n in ("temperature", "humidity")],
            F.when(kinds[flag] == "BOOLEAN", F.col(f"_r.{flag}").try_cast("boolean")).alias(flag),
            D.number(F.col("_r.anomaly_score"), kinds["anomaly_score"]).alias("anomaly_score"),
            D.text(F.col("_r.timestamp"), kinds["timestamp"]).alias("_text"),
            fits.alias("_fits"),
        )
        .withColumn("timestamp", timestamps.parse_rfc3339(F.col("_text")))
        .withColumn("type_error", ~F.col("_fits") | (F.col("_text").isNotNull() & F.col("timestamp").isNull()))
        .drop("_text", "_fits")
    )
    return computed_once(read, [c for c in read.columns if c not in rest])


def check_for_store(df: DataFrame) -> DataFrame:
    """Decoded records with ``reject_reason``: null for those that the store takes."""
    why = F.when(F.col("type_error"), "invalid record").otherwise(validate.reason("store", df.columns))
    return df.select(*[c for c in df.columns if c != "type_error"], why.alias("reject_reason"))


def for_store(df: DataFrame, row_key: str = "arrival_seq", created_at: Column | None = None) -> DataFrame:
    """Rows of the stored table: whole seconds, a null flag as false, and the day the row was created."""
    if created_at is None:
        created_at = F.col("ingest_ts") if "ingest_ts" in df.columns else F.current_timestamp()
    created = timestamps.cut_to_second(created_at.cast("timestamp"))
    return df.select(
        F.col(row_key).cast("bigint").alias("row_key"),
        "device_id",
        F.col("temperature").cast("double").alias("temperature"),
        F.col("humidity").cast("double").alias("humidity"),
        timestamps.cut_to_second(F.coalesce("timestamp", created)).alias("timestamp"),
        F.coalesce("is_anomaly", F.lit(False)).alias("is_anomaly"),
        F.col("anomaly_score").cast("double").alias("anomaly_score"),
        created.alias("created_at"),
        "tenant_id",
        F.to_date(created).alias("created_date"),
    )
