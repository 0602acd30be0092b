"""Running, tenant, device and outcome statistics over processed or stored rows."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from fleetgauge import schemas
from fleetgauge.functions.scoring import mean
from fleetgauge.operators.lookup import join_dimension
from fleetgauge.operators.ordered import MAX_GROUP_ROWS, first_rows, rolling_rows


DEVICE_PARTS = 8


def by_metric(df: DataFrame, keep: list[str], metrics=schemas.METRICS) -> DataFrame:
    """One row per reading and non-null metric: ``keep`` columns, ``metric``, ``value``."""
    return df.select(*keep, *metrics).unpivot(keep, list(metrics), "metric", "value").filter(F.col("value").isNotNull())


def global_stats(df: DataFrame, metrics=schemas.METRICS) -> DataFrame:
    """Count, sum, min, max and average of each metric over all tenants; one pass, one small final row."""
    wide = df.agg(
        *[
            F.struct(
                F.count(m).alias("count"), F.sum(m).alias("sum"), F.min(m).alias("min"), F.max(m).alias("max"),
                mean(F.col(m)).alias("avg"),
            ).alias(m)
            for m in metrics
        ]
    )
    rows = F.array(*[F.struct(F.lit(m).alias("metric"), *[F.col(m)[k].alias(k) for k in _STATS]) for m in metrics])
    return wide.select(F.inline(rows))


_STATS = ("count", "sum", "min", "max", "avg")


def device_window_stats(
    df: DataFrame,
    keys: tuple[str, ...] = ("tenant_id", "device_id"),
    seq: str = "arrival_seq",
    n: int = schemas.DEVICE_WINDOW,
    parts: int = DEVICE_PARTS,
) -> DataFrame:
    """Per device and metric, the last ``n`` readings in arrival order with their average, minimum and maximum.

    Each device is first cut to ``n`` rows in each of ``parts`` parts, so a busy one is not left to one task. Pass ``("device_id",)`` to let equal device names of two tenants share one window.
    """
    group = [*keys, "metric"]
    last = first_rows(by_metric(df, [*keys, seq]), group, [F.desc(seq)], n, parts, seq)
    in_order = F.sort_array(F.collect_list(F.struct(seq, "value")))
    return last.groupBy(*group).agg(
        F.count("value").alias("count"),
        mean(F.col("value")).alias("avg"),
        F.min("value").alias("min"),
        F.max("value").alias("max"),
        in_order["value"].alias("readings"),
    )


def device_rolling(
    df: DataFrame,
    keys: tuple[str, ...] = ("tenant_id", "device_id"),
    seq: str = "arrival_seq",
    n: int = schemas.DEVICE_WINDOW,
    max_rows: int = MAX_GROUP_ROWS,
) -> DataFrame:
    """For every non-null reading, the statistics of its device and metric right after it arrived."""
    rows = rolling_rows(
        by_metric(df, [*keys, seq]),
        [*keys, "metric"],
        seq,
        n,
        {"count": F.count("value"), "sum": F.sum("value"), "min": F.min("value"), "max": F.max("value")},
        max_rows,
    )
    return rows.withColumn("avg", F.col("sum").cast("double") / F.col("count"))


def with_device_stats(
    df: DataFrame,
    keys: tuple[str, ...] = ("tenant_id", "device_id"),
    seq: str = "arrival_seq",
    n: int = schemas.DEVICE_WINDOW,
) -> DataFrame:
    """Add ``temperature_stats`` and ``humidity_stats`` to every row, null where the row lacks the metric."""
    stat = F.struct(*[F.col(c).cast("double").alias(c) for c in ("avg", "min", "max")])
    wide = (
        device_rolling(df, keys, seq, n)
        .groupBy(*keys, seq)
        .agg(*[F.max(F.when(F.col("metric") == m, stat)).alias(f"{m}_stats") for m in schemas.METRICS])
    )
    on, added = [*keys, seq], [f"{m}_stats" for m in schemas.METRICS]
    wide = wide.select(*[F.col(k).alias(f"_own_{k}") for k in on], *added)
    same = [df[k].eqNullSafe(wide[f"_own_{k}"]) for k in on]
    return df.join(wide, same, "left").select(*[df[c] for c in df.columns], *added)


def device_last_seen(
    df: DataFrame, keys: tuple[str, ...] = ("tenant_id", "device_id"), seq: str = "arrival_seq", ts: str = "ts"
) -> DataFrame:
    """Event time of the reading that arrived last, which need not be the latest event time."""
    return df.groupBy(*keys).agg(F.max_by(ts, seq).alias("last_seen"))


def _tenant_aggregates() -> list:
    return [
        F.count_distinct("device_id").alias("device_count"),
        F.count(F.lit(1)).alias("total_records"),
        F.coalesce(F.sum(F.col("is_anomaly").cast("int")), F.lit(0)).alias("anomaly_count"),
        F.coalesce(mean(F.col("temperature")), F.lit(0.0)).alias("avg_temperature"),
        F.coalesce(mean(F.col("humidity")), F.lit(0.0)).alias("avg_humidity"),
    ]


def tenant_stats(df: DataFrame, tenants: DataFrame | None = None) -> DataFrame:
    """Devices, rows, anomalies and averages per tenant.

    With a ``tenants`` table (``tenant_id``) the result has one row per listed tenant, zeros where it has no data.
    """
    stats = df.groupBy("tenant_id").agg(*_tenant_aggregates())
    if tenants is None:
        return stats
    listed = tenants.select("tenant_id").distinct().join(stats, "tenant_id", "left")
    return listed.select(
        "tenant_id",
        *[F.coalesce(c, F.lit(0).cast(t)).alias(c) for c, t in stats.dtypes if c != "tenant_id"],
    )


def stats_of_tenant(df: DataFrame, tenant_id: str) -> DataFrame:
    """The statistics of one tenant as exactly one row, zeros for a tenant without data."""
    return (
        df.filter(F.col("tenant_id") == tenant_id)
        .agg(*_tenant_aggregates())
        .select(F.lit(tenant_id).alias("tenant_id"), "*")
    )


def tenant_record_counts(df: DataFrame) -> DataFrame:
    return df.groupBy("tenant_id").agg(F.count(F.lit(1)).alias("records"))


def processing_status(df: DataFrame) -> DataFrame:
    """Processed and failed counts (sampled-out rows count as failed) and the last processing time."""
    done = F.col("outcome").isin("normal", "anomaly")
    return df.agg(
        F.count_if(done).alias("processed_count"),
        F.count_if(~done).alias("error_count"),
        F.max(F.when(done, F.col("processed_at"))).alias("last_processed"),
    )


def outcome_counts(df: DataFrame) -> DataFrame:
    return df.groupBy("outcome").agg(F.count(F.lit(1)).alias("messages"))


def tenant_message_counts(df: DataFrame) -> DataFrame:
    """Messages that left the engine, per tenant."""
    done = df.filter(F.col("outcome").isin("normal", "anomaly"))
    return done.groupBy("tenant_id").agg(F.count(F.lit(1)).alias("messages"))


def latency_histogram(
    df: DataFrame, latency: str = "latency_seconds", by: tuple[str, ...] = ("tenant_id",), bounds=schemas.LATENCY_BOUNDS
) -> DataFrame:
    """Cumulative counts per upper bound ``le``, with +Inf; one pass without a window."""
    wide = df.filter(F.col(latency).isNotNull()).groupBy(*by).agg(
        *[F.count_if(F.col(latency) <= b).alias(f"_b{i}") for i, b in enumerate(bounds)],
        F.count(F.lit(1)).alias("_all"),
    )
    rows = [
        F.struct(F.lit(float(b)).alias("le"), F.col(f"_b{i}").alias("cumulative_count")) for i, b in enumerate(bounds)
    ]
    rows.append(F.struct(F.lit(float("inf")).alias("le"), F.col("_all").alias("cumulative_count")))
    return wide.select(*by, F.inline(F.array(*rows)))


def with_tenants(stats: DataFrame, tenants: DataFrame) -> DataFrame:
    """Every tenant with its usage or statistics row; missing numbers become 0 and missing flags false."""
    joined = join_dimension(tenants, stats, "tenant_id")
    out = []
    for name, kind in stats.dtypes:
        if name == "tenant_id":
            continue
        if kind in ("int", "bigint", "double"):
            out.append(F.coalesce(name, F.lit(0).cast(kind)).alias(name))
        elif kind == "boolean":
            out.append(F.coalesce(name, F.lit(False)).alias(name))
        else:
            out.append(F.col(name))
    return joined.select(*tenants.columns, *out)
