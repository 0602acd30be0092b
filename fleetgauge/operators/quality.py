"""Quality report of cleaned messages."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from fleetgauge.functions import documents as D
from fleetgauge.functions import scoring

# Keys a complete message has.
EXPECTED_KEYS = ("device_id", "sensor_id", "timestamp", "temperature", "humidity", "tenant_id")


def _present(key: str) -> Column:
    return F.coalesce(F.map_contains_key("fields", key), F.lit(False))


def quality_report(df: DataFrame) -> DataFrame:
    """Add completeness, accuracy, consistency, ``flags`` and ``applied_rules`` to ``clean_messages`` rows.

    Completeness is the share of expected keys present, accuracy the share of the two value rules kept, consistency 1
    unless a known field has the wrong type.
    """
    raw = F.try_variant_get(F.try_element_at("fields", F.lit("humidity")), "$", "double")
    numeric = D.is_number(F.schema_of_variant(F.try_element_at("fields", F.lit("humidity"))))
    base = df.withColumn("_clamped", numeric & scoring.outside(raw, scoring.HUMIDITY_RANGE))
    flags = [F.when(~_present(k), F.lit(f"missing_{k}")) for k in EXPECTED_KEYS]
    flags += [
        F.when(F.col("temperature_warning"), F.lit("temperature_implausible")),
        F.when(F.col("_clamped"), F.lit("humidity_clamped")),
        F.when(F.col("type_error"), F.lit("wrong_type")),
    ]
    rules = [
        F.when(_present("timestamp"), F.lit("normalize_timestamp")),
        F.when(F.col("_clamped"), F.lit("clamp_humidity")),
        F.lit("quality_score"),
    ]
    complete = sum((F.when(_present(k), 1).otherwise(0) for k in EXPECTED_KEYS), F.lit(0))
    broken = F.col("temperature_warning").cast("int") + F.col("_clamped").cast("int")
    return base.select(
        *df.columns,
        (complete / F.lit(len(EXPECTED_KEYS))).alias("completeness"),
        (1 - broken / 2).alias("accuracy"),
        F.when(F.col("type_error"), 0.0).otherwise(1.0).alias("consistency"),
        F.array_compact(F.array(*flags)).alias("flags"),
        F.array_compact(F.array(*rules)).alias("applied_rules"),
    )


def below_quality(df: DataFrame, min_score: float) -> DataFrame:
    """Add ``too_low`` for rows to refuse."""
    return df.withColumn("too_low", F.col("quality_score") < min_score)
