"""Tenant dimension: keys, tiers, lookups and applied changes."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from fleetgauge import schemas
from fleetgauge.functions.scoring import tier_threshold
from fleetgauge.operators.lookup import join_dimension


def api_key_status(requests: DataFrame, tenants: DataFrame) -> DataFrame:
    """Add ``status`` (ok, missing, unknown, inactive) and, for ok, the settings of the key's tenant."""
    dim = tenants.select(
        "api_key",
        F.col("id").alias("_id"), F.col("tier").alias("_tier"), F.col("sampling_rate").alias("_rate"),
        F.col("retention_days").alias("_days"), F.col("active").alias("_active"),
    )
    joined = join_dimension(requests, dim, "api_key")
    status = (
        F.when(F.coalesce(F.col("api_key") == "", F.lit(True)), "missing")
        .when(F.col("_id").isNull(), "unknown")
        .when(~F.col("_active"), "inactive")
        .otherwise("ok")
    )
    checked = joined.withColumn("status", status)

    def if_ok(column):
        return F.when(F.col("status") == "ok", column)

    return checked.select(
        *requests.columns,
        "status",
        if_ok(F.col("_id")).alias("tenant_id"),
        if_ok(F.col("_tier")).alias("tier"),
        if_ok(F.col("_rate")).alias("sampling_rate"),
        if_ok(tier_threshold(F.col("_tier"))).alias("anomaly_threshold"),
        if_ok(F.col("_days")).alias("retention_days"),
    )


def find_tenant(tenants: DataFrame, tenant_id: str) -> DataFrame:
    return tenants.filter(F.col("id") == tenant_id)


def of_known_tenants(df: DataFrame, tenants: DataFrame) -> DataFrame:
    """Rows whose tenant exists."""
    return join_dimension(df, tenants.select(F.col("id").alias("tenant_id")).distinct(), "tenant_id", "left_semi")


def with_tier_config(df: DataFrame, tiers: DataFrame, tier: str = "tier") -> DataFrame:
    """Add the settings of the tier in any letter case; an unknown tier gets those of the standard one."""
    settings = [c for c in tiers.columns if c != "tier"]
    names = tiers.select(F.col("tier").alias("_name"), F.col("tier").alias("config_tier"))
    named = join_dimension(df.withColumn("_name", F.lower(F.col(tier))), names, "_name").drop("_name")
    named = named.withColumn("config_tier", F.coalesce("config_tier", F.lit(schemas.DEFAULT_TIER)))
    dim = tiers.select(F.col("tier").alias("config_tier"), *settings)
    return join_dimension(named, dim, "config_tier").select(*df.columns, "config_tier", *settings)


def tenant_counts(tenants: DataFrame) -> DataFrame:
    return tenants.agg(F.count(F.lit(1)).alias("tenants"), F.count_if("active").alias("active_tenants"))


def apply_changes(current: DataFrame, changes: DataFrame) -> DataFrame:
    """The tenant table after a feed of changes.

    ``changes`` has the tenant columns plus ``change_seq`` and ``op``: create replaces the row, update keeps id and
    created_at, and the old api_key when the new one is empty, delete removes it; an update of a missing tenant does
    nothing. The latest change of each kind decides, so one aggregate per tenant is enough, however long its history.
    """
    return settle(current, change_summary(changes))


def change_summary(changes: DataFrame) -> DataFrame:
    """Per tenant the latest create or delete, the latest update and the latest update that gives a key.

    Summaries of any parts of a feed, in any order and with repeats, merge to that of the whole: see ``merge_summaries``.
    """
    columns = [c for c in changes.columns if c not in ("id", "change_seq", "op")]
    row = F.struct(*columns)
    is_update = F.col("op") == "update"
    gives_key = is_update & (F.coalesce("api_key", F.lit("")) != "")
    seq = F.col("change_seq")
    return changes.groupBy("id").agg(
        F.max_by(F.struct("change_seq", "op", row.alias("row")), F.when(~is_update, seq)).alias("base"),
        F.max_by(F.struct("change_seq", row.alias("row")), F.when(is_update, seq)).alias("update"),
        F.max_by(F.struct("change_seq", "api_key"), F.when(gives_key, seq)).alias("key"),
    )


def merge_summaries(old: DataFrame, new: DataFrame) -> DataFrame:
    """One summary per tenant from two tables of summaries."""
    both = old.unionByName(new.select(*old.columns))
    kinds = [F.max_by(kind, F.col(f"{kind}.change_seq")).alias(kind) for kind in ("base", "update", "key")]
    return both.groupBy("id").agg(*kinds)


def settle(current: DataFrame, latest: DataFrame) -> DataFrame:
    """The tenant table after the changes that a summary stands for."""
    columns = [c for c in current.columns if c != "id"]
    held = current.select("id", F.lit(True).alias("_held"), F.struct(*columns).alias("_old"))
    both = held.join(latest, "id", "full_outer")
    no_base = F.col("base").isNull()
    since = F.coalesce(F.col("base.change_seq"), F.lit(-(2**63)))
    # Of the rows that exist, those with a base were created by it.
    start = F.struct(*[F.when(no_base, F.col(f"_old.{c}")).otherwise(F.col(f"base.row.{c}")).alias(c) for c in columns])
    exists = F.when(no_base, F.col("_held").isNotNull()).otherwise(F.col("base.op") == "create")
    updated = F.coalesce(F.col("update.change_seq") > since, F.lit(False))
    rekeyed = F.coalesce(F.col("key.change_seq") > since, F.lit(False))
    settled = both.filter(exists).select("id", start.alias("s"), updated.alias("u"), rekeyed.alias("k"), "update", "key")
    out = [F.col("id")]
    for c in columns:
        if c == "created_at":
            out.append(F.col("s.created_at"))
        elif c == "api_key":
            out.append(F.when(F.col("k"), F.col("key.api_key")).otherwise(F.col("s.api_key")).alias(c))
        else:
            out.append(F.when(F.col("u"), F.col(f"update.row.{c}")).otherwise(F.col(f"s.{c}")).alias(c))
    return settled.select(*out)
