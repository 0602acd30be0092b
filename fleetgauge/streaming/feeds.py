"""Streams whose state is a keyed table: tenant changes, rolling device statistics and the growth of counters.

Every micro-batch first writes what it gives out, in folders that a repeated batch replaces, and then upserts its state, which
a repeated batch leaves alone: a batch that is run again gives out the same rows, or is skipped once its state is committed.
Only the buckets that a batch touches are read and written.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery
from pyspark.sql.window import Window

from fleetgauge import schemas
from fleetgauge.operators import monitor, tenants
from fleetgauge.operators.ordered import MAX_GROUP_ROWS, first_rows, rolling_rows
from fleetgauge.operators.stats import by_metric
from fleetgauge.sources.keyed import BUCKETS, KeyedTable
from fleetgauge.sources.table import write_batch
from fleetgauge.streaming.pipeline import start


def ddl(df: DataFrame, columns: list[str]) -> str:
    return ", ".join(f"`{c}` {df.schema[c].dataType.simpleString()}" for c in columns)


# Tenant changes


def tenant_changes_table(spark: SparkSession, path: str, schema: str = schemas.TENANTS, buckets: int = BUCKETS) -> KeyedTable:
    """Where the summary of a change feed is kept; ``schema`` is that of the tenant table."""
    empty = spark.createDataFrame([], f"{schema}, change_seq BIGINT, op STRING")
    summary = tenants.change_summary(empty)
    return KeyedTable(spark, path, ddl(summary, summary.columns), ("id",), buckets)


def start_tenant_changes(changes: DataFrame, checkpoint: str, table: KeyedTable, once: bool = False) -> StreamingQuery:
    """Fold a feed of changes in the summaries of the tenants it names.

    The order of the changes is that of ``change_seq``, so they may arrive in any order and again.
    """

    def fold(batch: DataFrame, batch_id: int) -> None:
        table.upsert(tenants.change_summary(batch), batch_id, tenants.merge_summaries)

    return start(changes, checkpoint, fold, once)


def tenants_now(current: DataFrame, table: KeyedTable) -> DataFrame:
    """The tenant table ``current`` after all changes folded so far."""
    return tenants.settle(current, table.read())


# Rolling device statistics


def rolling_table(
    spark: SparkSession, path: str, keys: dict[str, str] | None = None, seq: str = "arrival_seq", value: str = "DOUBLE", buckets: int = BUCKETS
) -> KeyedTable:
    """Where the last readings of each device and metric are kept; ``keys`` maps the key columns to their types."""
    keys = {"tenant_id": "STRING", "device_id": "STRING"} if keys is None else keys
    named = ", ".join(f"`{k}` {t}" for k, t in keys.items())
    return KeyedTable(spark, path, f"{named}, metric STRING, `{seq}` BIGINT, value {value}", (*keys, "metric"), buckets)


def start_device_rolling(
    readings: DataFrame, checkpoint: str, table: KeyedTable, path: str, seq: str = "arrival_seq", n: int = schemas.DEVICE_WINDOW,
    once: bool = False, max_rows: int = MAX_GROUP_ROWS,
) -> StreamingQuery:
    """For every non-null reading of a stream, the statistics of its device and metric right after it arrived.

    A micro-batch is taken after the last ``n - 1`` readings that each of its devices had before it, and windowed like a batch: a
    busy device is cut in blocks and never sits in one state. A reading numbered below ones of an earlier batch counts where
    its number puts it among those kept; rows given out before are not changed.
    """
    group = [k for k in table.keys if k != "metric"]

    def roll(batch: DataFrame, batch_id: int) -> None:
        if table.committed(batch_id):
            return
        long = by_metric(batch, [*group, seq]).select(*group, "metric", seq, "value").persist()
        try:
            buckets = [r["_bucket"] for r in table.bucketed(long).select("_bucket").distinct().collect()]
            before = table.read(buckets=buckets).withColumn("_new", F.lit(False))
            both = before.unionByName(long.withColumn("_new", F.lit(True)))
            aggregates = {"count": F.count("value"), "sum": F.sum("value"), "min": F.min("value"), "max": F.max("value")}
            rows = rolling_rows(both, list(table.keys), seq, n, aggregates, max_rows)
            out = rows.filter("_new").drop("_new").withColumn("avg", F.col("sum").cast("double") / F.col("count"))
            write_batch(out, path, batch_id, ("batch_id",))

            def last(old: DataFrame, new: DataFrame) -> DataFrame:
                return first_rows(old.unionByName(new), list(table.keys), [F.desc(seq)], n - 1, 8, seq)

            table.upsert(long, batch_id, last)
        finally:
            long.unpersist()

    return start(readings, checkpoint, roll, once)


# Growth of counters

SERIES = [c for c in monitor.LABELS]


def samples_table(spark: SparkSession, path: str, buckets: int = BUCKETS) -> KeyedTable:
    """Where the last sample of each series is kept."""
    columns = [part for part in schemas.METRIC_SAMPLES.split(", ") if part.split()[0] in (*SERIES, "ts", "value")]
    return KeyedTable(spark, path, ", ".join(columns), tuple(SERIES), buckets)


def start_counter_growth(
    samples: DataFrame, checkpoint: str, table: KeyedTable, path: str, range_s: int = 60, step_s: int | None = None,
    once: bool = False,
) -> StreamingQuery:
    """Growth of counters per series and window, resets included, over a stream of samples.

    Growth from one sample to the next counts in every window that holds both, once, whichever micro-batches they came in. The
    samples of a series arrive in the order of their time; one that does not goes to ``late`` below ``path``, with its batch.
    """
    step = step_s or range_s

    def grow(batch: DataFrame, batch_id: int) -> None:
        if table.committed(batch_id):
            return
        own = batch.filter(F.col("value").isNotNull()).select(*SERIES, F.col("ts").cast("timestamp").alias("ts"), "value").persist()
        try:
            buckets = [r["_bucket"] for r in table.bucketed(own).select("_bucket").distinct().collect()]
            known = table.read(buckets=buckets)
            last = known.select(*[F.col(c).alias(f"_{c}") for c in SERIES], F.col("ts").alias("_seen"))
            same = [own[c].eqNullSafe(last[f"_{c}"]) for c in SERIES]
            marked = own.join(last, same, "left").select(own["*"], (F.col("ts") <= F.col("_seen")).alias("_late"))
            late = F.coalesce("_late", F.lit(False))
            fresh = marked.filter(~late).drop("_late")
            # A series has few samples in one micro-batch: one for each scrape.
            order = Window.partitionBy(*SERIES).orderBy("ts")
            both = known.select(*SERIES, "ts", "value", F.lit(False).alias("_new")).unionByName(fresh.withColumn("_new", F.lit(True)))
            pairs = both.withColumns({"_prev": F.lag("value").over(order), "_prev_ts": F.lag("ts").over(order)}).filter("_new AND _prev_ts IS NOT NULL")
            grown = F.when(F.col("value") >= F.col("_prev"), F.col("value") - F.col("_prev")).otherwise(F.col("value"))
            placed = pairs.withColumn("increase", grown).withColumn("w", F.window("ts", f"{range_s} seconds", f"{step} seconds"))
            inside = placed.filter(F.col("_prev_ts") >= F.col("w.start"))
            sums = inside.groupBy(*SERIES, "w").agg(F.sum("increase").alias("increase"))
            out = sums.select(*SERIES, F.col("w.start").alias("window_start"), F.col("w.end").alias("window_end"), "increase")
            write_batch(out, f"{path}/growth", batch_id, ("batch_id",))
            write_batch(marked.filter(late).drop("_late"), f"{path}/late", batch_id, ("batch_id",))

            def newest(old: DataFrame, new: DataFrame) -> DataFrame:
                rows = old.unionByName(new.select(*old.columns))
                return rows.groupBy(*SERIES).agg(F.max_by(F.struct("ts", "value"), "ts").alias("_s")).select(*SERIES, "_s.*").select(*old.columns)

            table.upsert(fresh, batch_id, newest)
        finally:
            own.unpersist()

    return start(samples, checkpoint, grow, once)


def growth(spark: SparkSession, path: str, by: tuple[str, ...] = ()) -> DataFrame:
    """Sum over series of the growth so far, per window and ``by`` labels: what ``monitor.increase`` gives for a table."""
    labels = ", ".join(p for p in schemas.METRIC_SAMPLES.split(", ") if p.split()[0] in SERIES)
    rows = spark.read.schema(f"{labels}, window_start TIMESTAMP, window_end TIMESTAMP, increase DOUBLE, batch_id BIGINT").parquet(f"{path}/growth")
    return rows.groupBy(*by, "window_start", "window_end").agg(F.sum("increase").alias("increase"))


def rate(spark: SparkSession, path: str, by: tuple[str, ...] = (), range_s: int = 60) -> DataFrame:
    return growth(spark, path, by).withColumn("rate", F.col("increase") / F.lit(float(range_s))).drop("increase")
