"""Monitoring queries over a table of metric samples (see ``schemas.METRIC_SAMPLES``).

``rate`` follows the usual counter rule, resets included, over the samples inside each window; the value is not
extrapolated to the window's edges.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from fleetgauge import schemas

LABELS = ("metric", "tenant_id", "status", "job", "pod", "le")
MESSAGES = "process_messages_total"
TENANT_MESSAGES = "tenant_messages_processed"
LATENCY = "tenant_processing_latency_seconds"
RECORDS = "records_by_tenant"


def metric_samples(
    processed: DataFrame, every: str = "1 minute", ts: str = "timestamp", latency: str = "latency_seconds",
    job: str = "processing-engine", pod: Column | None = None, bounds=schemas.LATENCY_BOUNDS,
    metrics: tuple[str, ...] | None = None,
) -> DataFrame:
    """Counters, a latency histogram and a row gauge as they stand at the end of each interval with messages.

    Rows are first counted per interval and labels, so the running totals work on that small table. ``metrics`` builds
    only the named ones.
    """
    pod = F.lit(f"{job}-0") if pod is None else pod
    done = processed.withColumn("pod", pod).withColumn("ts", F.window(ts, every)["end"])
    status = F.when(F.col("outcome").isin("normal", "anomaly"), F.col("outcome")).otherwise("error")
    published = F.col("outcome").isin("normal", "anomaly")
    per_interval = done.groupBy("ts", "pod", "tenant_id", status.alias("status")).agg(
        F.count(F.lit(1)).alias("n"),
        F.sum(latency).cast("double").alias("latency_sum"),
        F.count(latency).alias("latency_count"),
        *[F.count_if(F.col(latency) <= b).alias(f"b{i}") for i, b in enumerate(bounds)],
    )
    ok = F.col("status") != "error"
    null = F.lit(None)

    def sample(metric, value, tenant=null, status=null, le=null, when=None):
        if metrics is not None and metric not in metrics:
            return None
        s = F.struct(
            F.lit(metric).alias("metric"), tenant.cast("string").alias("tenant_id"),
            status.cast("string").alias("status"), le.cast("double").alias("le"), value.cast("double").alias("value"),
        )
        return s if when is None else F.when(when, s)

    tenant = F.col("tenant_id")
    samples = [
        sample(MESSAGES, F.col("n"), status=F.col("status")),
        sample(TENANT_MESSAGES, F.col("n"), tenant=tenant, when=ok),
        sample(RECORDS, F.col("n"), tenant=tenant, when=ok),
        sample(f"{LATENCY}_sum", F.col("latency_sum"), tenant=tenant, when=ok),
        sample(f"{LATENCY}_count", F.col("latency_count"), tenant=tenant, when=ok),
        sample(f"{LATENCY}_bucket", F.col("latency_count"), tenant=tenant, le=F.lit(float("inf")), when=ok),
    ]
    samples += [
        sample(f"{LATENCY}_bucket", F.col(f"b{i}"), tenant=tenant, le=F.lit(float(b)), when=ok)
        for i, b in enumerate(bounds)
    ]
    samples = [s for s in samples if s is not None]
    if not samples:
        raise ValueError(f"none of the metrics {metrics} is known")
    long = per_interval.select("ts", "pod", F.inline(F.array_compact(F.array(*samples))))
    series = ["metric", "tenant_id", "status", "pod", "le"]
    steps = long.groupBy("ts", *series).agg(F.sum("value").alias("value"))
    so_far = Window.partitionBy(*series).orderBy("ts").rowsBetween(Window.unboundedPreceding, 0)
    return steps.select(
        "ts", "metric", "tenant_id", "status", F.lit(job).alias("job"), "pod", "le",
        F.sum("value").over(so_far).alias("value"),
    )


def select_series(samples: DataFrame, metric: str, **labels: str) -> DataFrame:
    """Samples of a metric with the given label values."""
    out = samples.filter(F.col("metric") == metric)
    for name, value in labels.items():
        out = out.filter(F.col(name) == value)
    return out


def match_label(samples: DataFrame, label: str, pattern: str) -> DataFrame:
    """Label matches the pattern from start to end."""
    return samples.filter(F.col(label).rlike(f"^(?:{pattern})$"))


def _increases(samples: DataFrame, range_s: int, step_s: int) -> DataFrame:
    """Per series and window, the counter's increase between samples inside the window.

    Every sample joins the range/step windows it lies in; a group is one series in one window, so it is no longer
    than the window over the sampling interval.
    """
    labels = [c for c in LABELS if c in samples.columns]
    placed = samples.select(
        *labels, "ts", "value", F.window("ts", f"{range_s} seconds", f"{step_s} seconds").alias("w")
    )
    prev = F.lag("value").over(Window.partitionBy(*labels, "w").orderBy("ts"))
    grown = F.when(F.col("value") >= F.col("_prev"), F.col("value") - F.col("_prev")).otherwise(F.col("value"))
    return (
        placed.withColumn("_prev", prev)
        .filter(F.col("_prev").isNotNull())
        .groupBy(*labels, "w")
        .agg(F.sum(grown).alias("increase"))
    )


def increase(
    samples: DataFrame, by: tuple[str, ...] = (), range_s: int = 60, step_s: int | None = None
) -> DataFrame:
    """Sum over series of the counters' increase, per window and ``by`` labels."""
    grown = _increases(samples, range_s, step_s or range_s)
    return grown.groupBy(*by, F.col("w.start").alias("window_start"), F.col("w.end").alias("window_end")).agg(
        F.sum("increase").alias("increase")
    )


def rate(
    samples: DataFrame, by: tuple[str, ...] = (), range_s: int = 60, step_s: int | None = None
) -> DataFrame:
    """Sum over series of the per-second rate, per window and ``by`` labels."""
    grown = increase(samples, by, range_s, step_s)
    return grown.withColumn("rate", F.col("increase") / F.lit(float(range_s))).drop("increase")


def quantile_of_buckets(buckets: DataFrame, q: float, by: list[str], value: str = "value") -> DataFrame:
    """Quantile from cumulative bucket values (``le``), linear inside a bucket.

    The +Inf bucket answers with the last finite bound; no messages give null.
    """
    # One row per bound: a group is as small as the list of bounds.
    ordered = Window.partitionBy(*by).orderBy("le")
    whole = ordered.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    marked = buckets.select(
        *by, "le", F.col(value).alias("_cum"),
        F.lag("le").over(ordered).alias("_prev_le"), F.lag(value).over(ordered).alias("_prev_cum"),
        F.last(value).over(whole).alias("_total"),
    )
    rank = F.col("_total") * q
    hit = marked.groupBy(*by).agg(
        F.min_by(F.struct("le", "_cum", "_prev_le", "_prev_cum", "_total"), F.when(F.col("_cum") >= rank, F.col("le"))).alias("b")
    )
    low, below = F.coalesce("b._prev_le", F.lit(0.0)), F.coalesce("b._prev_cum", F.lit(0.0))
    inside = low + (F.col("b.le") - low) * F.try_divide(F.col("b._total") * q - below, F.col("b._cum") - below)
    answer = (
        F.when(F.col("b._total") <= 0, None)
        .when(F.col("b.le") == float("inf"), F.col("b._prev_le"))
        .otherwise(inside)
    )
    return hit.select(*by, answer.alias("quantile"))


def histogram_quantile(
    samples: DataFrame, q: float, metric: str = LATENCY, by: tuple[str, ...] = ("tenant_id",), range_s: int = 300,
    step_s: int | None = None,
) -> DataFrame:
    """Quantile of a histogram metric from the growth of its buckets, per window and ``by`` labels.

    All buckets of a window grow over the same range, so their increases give the quantile of their rates.
    """
    buckets = increase(select_series(samples, f"{metric}_bucket"), (*by, "le"), range_s, step_s)
    return quantile_of_buckets(buckets, q, [*by, "window_start", "window_end"], "increase")


def error_percent(
    samples: DataFrame, metric: str = MESSAGES, by: tuple[str, ...] = (), range_s: int = 60, step_s: int | None = None
) -> DataFrame:
    """Share of errors among all messages per window and ``by`` labels; null without messages."""
    grown = increase(select_series(samples, metric), (*by, "status"), range_s, step_s)
    errors = F.sum(F.when(F.col("status") == "error", F.col("increase")).otherwise(0.0))
    return grown.groupBy(*by, "window_start", "window_end").agg(
        (F.try_divide(errors, F.sum("increase")) * 100.0).alias("error_percent")
    )


def latest(samples: DataFrame) -> DataFrame:
    """Last non-null value of every series."""
    labels = [c for c in LABELS if c in samples.columns]
    return samples.filter(F.col("value").isNotNull()).groupBy(*labels).agg(F.max_by("value", "ts").alias("value"))


def latest_sum(samples: DataFrame, by: tuple[str, ...] = ()) -> DataFrame:
    """Sum over series of their last value, per ``by`` labels."""
    return latest(samples).groupBy(*by).agg(F.sum("value").alias("value"))


def mean_latency(samples: DataFrame, metric: str = LATENCY, by: tuple[str, ...] = ("tenant_id",)) -> DataFrame:
    """Total observed latency over the number of observations; totals are added up in whole microseconds."""
    last = latest(samples.filter(F.col("metric").isin(f"{metric}_sum", f"{metric}_count")))

    def total(suffix):
        value = F.when(F.col("metric") == f"{metric}_{suffix}", F.col("value"))
        return F.sum(value.cast("decimal(28,6)")).cast("double")

    return last.groupBy(*by).agg(F.try_divide(total("sum"), total("count")).alias("mean_latency"))


def scaled(samples: DataFrame, divisor: float = 1024.0 * 1024.0) -> DataFrame:
    return samples.withColumn("value", F.col("value") / F.lit(divisor))


def label_values(samples: DataFrame, label: str) -> DataFrame:
    return samples.filter(F.col(label).isNotNull()).select(label).distinct()


def pods_per_tenant(samples: DataFrame) -> DataFrame:
    """Number of different pods that report a tenant."""
    return samples.filter(F.col("tenant_id").isNotNull()).groupBy("tenant_id").agg(
        F.count_distinct("pod").alias("pods")
    )
