"""Sensor rules: value limits, quality score, anomaly score, sampling draw."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from fleetgauge import schemas

# Limits of the rules below.
TEMPERATURE_PLAUSIBLE = (-50.0, 60.0)
HUMIDITY_RANGE = (0.0, 100.0)
TEMPERATURE_NORMAL = (10.0, 30.0)
HUMIDITY_NORMAL = (20.0, 80.0)
MISSING_KEY_PENALTY = 0.1
IMPLAUSIBLE_PENALTY = 0.2
TIER_THRESHOLDS = {"free": 1.0, "standard": 0.8, "premium": 0.5}
OTHER_TIER_THRESHOLD = 0.8
DRAW_STEPS = 1_000_000


def outside(value: Column, limits: tuple[float, float]) -> Column:
    """Strictly outside the limits; false for null."""
    low, high = limits
    return F.coalesce((value < low) | (value > high), F.lit(False))


def clamp_humidity(value: Column) -> Column:
    low, high = (F.lit(bound) for bound in HUMIDITY_RANGE)
    return F.when(value < low, low).when(value > high, high).otherwise(value)


def temperature_warning(value: Column) -> Column:
    return outside(value, TEMPERATURE_PLAUSIBLE)


def clean_value(sensor: str, value: Column) -> Column:
    """Only humidity is changed; other sensors keep their value."""
    return clamp_humidity(value) if sensor == "humidity" else value


def quality_score(keys_present: list[Column], temperature: Column) -> Column:
    """1.0 less a penalty per absent key and one for an implausible temperature, never below 0."""
    score = F.lit(1.0)
    for present in keys_present:
        score = score - F.when(present, 0.0).otherwise(MISSING_KEY_PENALTY)
    score = score - F.when(temperature_warning(temperature), IMPLAUSIBLE_PENALTY).otherwise(0.0)
    return F.greatest(score, F.lit(0.0))


def anomaly_score(temperature: Column, humidity: Column) -> Column:
    """One point per metric outside its normal range."""
    def points(value, limits):
        return F.when(outside(value, limits), 1.0).otherwise(0.0)

    return points(temperature, TEMPERATURE_NORMAL) + points(humidity, HUMIDITY_NORMAL)


def tier_threshold(tier: Column) -> Column:
    """Threshold by tier name, case-sensitive."""
    threshold = F.lit(None).cast("double")
    for name, value in TIER_THRESHOLDS.items():
        threshold = F.when(tier == name, value).otherwise(threshold)
    return F.coalesce(threshold, F.lit(OTHER_TIER_THRESHOLD))


def sampling_draw(row_key: Column) -> Column:
    """A number in {0, ..., 999999}/1e6 that depends on the row only, so a re-run keeps the same rows."""
    head = F.substring(F.md5(row_key.cast("string")), 1, 8)
    return (F.conv(head, 16, 10).cast("bigint") % DRAW_STEPS) / F.lit(float(DRAW_STEPS))


def kept_by_sampling(row_key: Column, rate: Column) -> Column:
    return (rate >= 1.0) | (sampling_draw(row_key) <= rate)


def default_tenant(tenant_id: Column) -> Column:
    return F.coalesce(F.nullif(tenant_id, F.lit("")), F.lit(schemas.DEFAULT_TENANT))


def display(value: Column) -> Column:
    """One decimal, for display only."""
    return F.round(value, 1)


def mean(value: Column) -> Column:
    """Sum over count, null without values. Exact up to the last division when ``value`` is a decimal."""
    return F.try_divide(F.sum(value).cast("double"), F.count(value))
