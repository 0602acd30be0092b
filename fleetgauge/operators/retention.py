"""Retention per tenant: rows older than the tenant's days, or the default, are removed."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from fleetgauge import schemas
from fleetgauge.operators.lookup import join_dimension


def cutoff(as_of: Column, days: Column) -> Column:
    return as_of - F.make_dt_interval(days)


def mark_expired(
    df: DataFrame, policies: DataFrame, as_of: Column, default_days: int = schemas.DEFAULT_RETENTION_DAYS,
    created: str = "created_at",
) -> DataFrame:
    """Add ``expired``: created strictly before ``as_of`` less the days of the tenant."""
    days = policies.select("tenant_id", F.col("days").cast("int").alias("_days"))
    joined = join_dimension(df, days, "tenant_id")
    limit = cutoff(as_of, F.coalesce("_days", F.lit(default_days)))
    return joined.select(*df.columns, (F.col(created) < limit).alias("expired"))


def survivors(df, policies, as_of, default_days=schemas.DEFAULT_RETENTION_DAYS, created="created_at") -> DataFrame:
    return mark_expired(df, policies, as_of, default_days, created).filter(~F.col("expired")).drop("expired")


def deleted_counts(df, policies, as_of, default_days=schemas.DEFAULT_RETENTION_DAYS, created="created_at") -> DataFrame:
    """Rows to delete per tenant."""
    gone = mark_expired(df, policies, as_of, default_days, created).filter("expired")
    return gone.groupBy("tenant_id").agg(F.count(F.lit(1)).alias("deleted"))


def without_policy(df: DataFrame, policies: DataFrame) -> DataFrame:
    """Rows of tenants that the policy table does not name."""
    return join_dimension(df, policies.select("tenant_id").distinct(), "tenant_id", "left_anti")
