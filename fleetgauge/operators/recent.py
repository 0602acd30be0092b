"""Recent rows, pages, charts and running values as a dashboard shows them."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from fleetgauge import schemas
from fleetgauge.functions.scoring import mean
from fleetgauge.operators.ordered import MAX_GROUP_ROWS, first_rows, running
from fleetgauge.operators.stats import by_metric

# Few tenants may hold all rows: top lists per tenant are cut in this many parts first.
TENANT_SALTS = 32


def tenant_rows(df: DataFrame, tenant_id: str) -> DataFrame:
    return df.filter(F.col("tenant_id") == tenant_id)


def device_rows(df: DataFrame, tenant_id: str, device_id: str) -> DataFrame:
    return df.filter((F.col("tenant_id") == tenant_id) & (F.col("device_id") == device_id))


def rows_between(df: DataFrame, start, end, ts: str = "timestamp") -> DataFrame:
    """Rows with start <= time < end."""
    return df.filter((F.col(ts) >= F.lit(start)) & (F.col(ts) < F.lit(end)))


def shown_to_viewer(df: DataFrame, tenant_id: str) -> DataFrame:
    """Rows without a tenant, or of the chosen one."""
    tenant = F.nullif(F.col("tenant_id"), F.lit(""))
    return df.filter(tenant.isNull() | (tenant == tenant_id))


def tenant_page(
    df: DataFrame, tenant_id: str, limit: int = schemas.PAGE_ROWS, offset: int = 0, ts: str = "timestamp",
    tie: str = "row_key",
) -> DataFrame:
    """Newest rows of a tenant. A limit below 1 or a negative offset falls back to the default."""
    limit = limit if limit > 0 else schemas.PAGE_ROWS
    page = tenant_rows(df, tenant_id).orderBy(F.desc(ts), F.desc(tie))
    return page.offset(offset).limit(limit) if offset > 0 else page.limit(limit)


def device_page(
    df: DataFrame, tenant_id: str, device_id: str, limit: int = schemas.PAGE_ROWS, ts: str = "timestamp",
    tie: str = "row_key",
) -> DataFrame:
    limit = limit if limit > 0 else schemas.PAGE_ROWS
    return device_rows(df, tenant_id, device_id).orderBy(F.desc(ts), F.desc(tie)).limit(limit)


def recent_buffer(df: DataFrame, seq: str = "arrival_seq", n: int = schemas.RECENT_ROWS) -> DataFrame:
    """The rows that arrived last, over all tenants, newest first."""
    return df.orderBy(F.desc(seq)).limit(n)


def recent_of_tenant(
    df: DataFrame, tenant_id: str, seq: str = "arrival_seq", n: int = schemas.RECENT_ROWS
) -> DataFrame:
    """The tenant's rows among the last ``n`` of all tenants: the limit comes before the filter."""
    return tenant_rows(recent_buffer(df, seq, n), tenant_id)


def recent_summary(
    df: DataFrame, seq: str = "arrival_seq", ts: str = "ts", n: int = schemas.RECENT_ROWS
) -> DataFrame:
    """Averages, row count and time of the newest row over the recent buffer."""
    return recent_buffer(df, seq, n).agg(
        *[mean(F.col(m)).alias(f"avg_{m}") for m in schemas.METRICS],
        F.count(F.lit(1)).alias("total_readings"),
        F.max_by(ts, seq).alias("last_reading"),
    )


def latest_rows(df: DataFrame, keys: tuple[str, ...] = ("tenant_id",), ts: str = "ts", tie: str = "arrival_seq") -> DataFrame:
    """The newest row of each group as one aggregate, combined before the shuffle."""
    rest = [c for c in df.columns if c not in keys]
    newest = df.groupBy(*keys).agg(F.max_by(F.struct(*rest), F.struct(ts, tie)).alias("_row"))
    return newest.select(*keys, "_row.*")


def chronological(df: DataFrame, ts: str = "timestamp", tie: str = "row_key") -> DataFrame:
    """A page turned round for a chart: one row per metric value, oldest first."""
    return by_metric(df, [ts, tie]).orderBy(F.asc("metric"), F.asc(ts), F.asc(tie))


def newer_only(
    df: DataFrame, keys: tuple[str, ...] = ("tenant_id",), seq: str = "arrival_seq", ts: str = "ts",
    max_rows: int = MAX_GROUP_ROWS,
) -> DataFrame:
    """Drop rows that are not newer than every row that arrived before them."""
    marked = running(df, list(keys), seq, {"_newest": ("max", ts)}, include_current=False, max_rows=max_rows)
    return marked.filter(F.col("_newest").isNull() | (F.col(ts) > F.col("_newest"))).drop("_newest")


def chart_series(
    df: DataFrame, keys: tuple[str, ...] = ("tenant_id",), seq: str = "arrival_seq", ts: str = "ts",
    n: int = schemas.CHART_POINTS, salts: int = TENANT_SALTS,
) -> DataFrame:
    """Last ``n`` points of each metric per group; feed it ``newer_only`` rows for a live chart."""
    return first_rows(by_metric(df, [*keys, seq, ts]), [*keys, "metric"], [F.desc(seq)], n, salts, seq)


def device_chart_series(
    df: DataFrame, seq: str = "arrival_seq", ts: str = "ts", n: int = schemas.SMALL_CHART_POINTS
) -> DataFrame:
    """Small overview chart: last ``n`` points of each metric over all rows that name a device."""
    named = df.filter(F.col("device_id").isNotNull() & (F.col("device_id") != ""))
    return chart_series(named, (), seq, ts, n)


def running_average(
    df: DataFrame, keys: tuple[str, ...] = ("tenant_id",), seq: str = "arrival_seq", max_rows: int = MAX_GROUP_ROWS
) -> DataFrame:
    """After each row: exact average of each metric so far and the number of rows so far."""
    sums = {f"_s_{m}": ("sum", m) for m in schemas.METRICS}
    counts = {f"_n_{m}": ("count", m) for m in schemas.METRICS}
    rows = df.withColumn("_one", F.lit(1))
    marked = running(rows, list(keys), seq, {**sums, **counts, "running_total": ("count", "_one")}, max_rows=max_rows)

    def average(metric: str) -> Column:
        return F.try_divide(F.col(f"_s_{metric}").cast("double"), F.col(f"_n_{metric}"))

    return marked.select(
        *df.columns, *[average(m).alias(f"running_avg_{m}") for m in schemas.METRICS], "running_total"
    )


def timeline(
    df: DataFrame, keys: tuple[str, ...] = ("tenant_id",), seq: str = "arrival_seq", n: int = schemas.TIMELINE_ROWS,
    salts: int = TENANT_SALTS,
) -> DataFrame:
    """The ``n`` rows of each group that arrived last."""
    return first_rows(df, list(keys), [F.desc(seq)], n, salts, seq)
