"""Record checks on typed readings. A check is the name of a profile; the first broken rule gives the reason."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from fleetgauge.operators.lookup import join_dimension

# Limits of the interface contract.
CONTRACT_TEMPERATURE = (-273.15, 1000.0)
CONTRACT_HUMIDITY = (0.0, 100.0)
CONTRACT_DEVICE_LENGTH = (1, 100)
CONTRACT_LATITUDE = (-90.0, 90.0)
CONTRACT_LONGITUDE = (-180.0, 180.0)


def _missing(name: str) -> Column:
    return F.coalesce(F.col(name) == "", F.lit(True))


def _range(name: str, limits: tuple[float, float]) -> Column:
    return F.coalesce(~F.col(name).between(*limits), F.lit(False))


def reason(profile: str, columns: list[str]) -> Column:
    """Reason column of a profile: ``engine``, ``strict``, ``dashboard``, ``store`` or ``contract``."""
    if profile == "engine":
        rules = [(_missing("device_id"), "device_id is required")]
    elif profile == "strict":
        rules = [
            (_missing("tenant_id"), "tenant_id is required"),
            (_missing("device_id"), "device_id is required"),
            (F.col("temperature").isNull() | F.col("humidity").isNull(), "temperature and humidity are required"),
        ]
    elif profile == "dashboard":
        rules = [
            (_missing("device_id"), "device_id is required"),
            (F.col("temperature").isNull() | F.col("humidity").isNull(), "temperature and humidity are required"),
            (_missing("tenant_id"), "tenant_id is required"),
        ]
    elif profile == "store":
        rules = [(_missing("device_id"), "device_id is required"), (_missing("tenant_id"), "tenant_id is required")]
    elif profile == "contract":
        rules = [
            (F.coalesce(~F.length("device_id").between(*CONTRACT_DEVICE_LENGTH), F.lit(True)), "device_id length"),
            (_range("temperature", CONTRACT_TEMPERATURE), "temperature out of range"),
            (_range("humidity", CONTRACT_HUMIDITY), "humidity out of range"),
        ]
        for name, limits in (("lat", CONTRACT_LATITUDE), ("lng", CONTRACT_LONGITUDE)):
            if name in columns:
                rules.append((_range(name, limits), f"{name} out of range"))
    else:
        raise ValueError(f"unknown profile {profile!r}")
    first = F.lit(None).cast("string")
    for broken, text in reversed(rules):
        first = F.when(broken, text).otherwise(first)
    return first


def check(df: DataFrame, profile: str) -> DataFrame:
    """Add ``reject_reason``; keep every row."""
    return df.withColumn("reject_reason", reason(profile, df.columns))


def with_known_key(df: DataFrame, keys: DataFrame) -> DataFrame:
    """Rows whose ``api_key`` is among the keys; the list may hold blanks and repeats."""
    return join_dimension(df, _distinct_keys(keys), "api_key", "left_semi")


def with_unknown_key(df: DataFrame, keys: DataFrame) -> DataFrame:
    return join_dimension(df, _distinct_keys(keys), "api_key", "left_anti")


def _distinct_keys(keys: DataFrame) -> DataFrame:
    trimmed = keys.select(F.trim("api_key").alias("api_key"))
    return trimmed.filter(F.col("api_key") != "").distinct()
