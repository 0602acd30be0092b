"""Usage against quota and rate limits, and per-tenant usage statistics."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from fleetgauge.functions.scoring import mean
from fleetgauge.operators.lookup import join_dimension
from fleetgauge.operators.ordered import MAX_GROUP_ROWS, running


def daily_usage(df: DataFrame, limits: DataFrame, ts: str = "ts") -> DataFrame:
    """Messages per tenant and UTC day, the month's total so far and whether the day's quota is exceeded.

    ``limits``: tenant_id, quota_limit. Tenants without a limit never exceed it.
    """
    day = F.to_date(F.col(ts)).alias("day")
    return quota_of_days(df.groupBy("tenant_id", day).agg(F.count(F.lit(1)).alias("daily_usage")), limits)


def quota_of_days(daily: DataFrame, limits: DataFrame) -> DataFrame:
    """``daily_usage`` from counts that are there already: tenant_id, day, daily_usage."""
    # At most 31 rows per tenant and month are left here.
    month = Window.partitionBy("tenant_id", F.trunc("day", "month")).orderBy("day")
    so_far = daily.withColumn(
        "monthly_usage", F.sum("daily_usage").over(month.rowsBetween(Window.unboundedPreceding, 0))
    )
    joined = join_dimension(so_far, limits.select("tenant_id", "quota_limit"), "tenant_id")
    return joined.select(
        "tenant_id", "day", "daily_usage", "monthly_usage",
        F.coalesce(F.col("daily_usage") > F.col("quota_limit"), F.lit(False)).alias("quota_exceeded"),
    )


def minute_usage(df: DataFrame, limits: DataFrame, ts: str = "ts", seconds: int = 60) -> DataFrame:
    """Messages per tenant and minute and whether they exceed ``rate_limit``."""
    start = F.window(ts, f"{seconds} seconds")["start"].alias("minute")
    return rate_of_minutes(df.groupBy("tenant_id", start).agg(F.count(F.lit(1)).alias("messages")), limits)


def rate_of_minutes(counts: DataFrame, limits: DataFrame) -> DataFrame:
    """``minute_usage`` from counts that are there already: tenant_id, minute, messages."""
    joined = join_dimension(counts, limits.select("tenant_id", "rate_limit"), "tenant_id")
    return joined.select(
        "tenant_id", "minute", "messages",
        F.coalesce(F.col("messages") > F.col("rate_limit"), F.lit(False)).alias("rate_exceeded"),
    )


def over_rate_rows(
    df: DataFrame, limits: DataFrame, ts: str = "ts", seq: str = "arrival_seq", seconds: int = 60,
    max_rows: int = MAX_GROUP_ROWS,
) -> DataFrame:
    """Add ``over_limit``: the row came after ``rate_limit`` others of its tenant in the same minute."""
    minute = df.withColumn("_minute", F.floor(F.unix_seconds(F.col(ts).cast("timestamp")) / seconds)).withColumn(
        "_one", F.lit(1)
    )
    counted = running(minute, ["tenant_id", "_minute"], seq, {"_nth": ("count", "_one")}, max_rows=max_rows)
    joined = join_dimension(counted, limits.select("tenant_id", "rate_limit"), "tenant_id")
    return joined.select(
        *df.columns, F.coalesce(F.col("_nth") > F.col("rate_limit"), F.lit(False)).alias("over_limit")
    )


def tenant_usage_stats(df: DataFrame, latency: str = "latency_seconds", raw: str = "value") -> DataFrame:
    """Messages, anomalies and their rate, mean latency, devices and bytes of raw text per tenant."""
    anomalies = F.sum(F.col("is_anomaly").cast("int"))
    return df.groupBy("tenant_id").agg(
        F.count(F.lit(1)).alias("message_count"),
        anomalies.alias("anomaly_count"),
        (anomalies / F.count(F.lit(1))).alias("anomaly_rate"),
        mean(F.col(latency)).alias("avg_latency"),
        F.count_distinct("device_id").alias("device_count"),
        F.sum(F.octet_length(raw)).alias("processed_data"),
    )
