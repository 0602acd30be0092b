"""Event-time windows on streams, with a watermark, and late rows kept on the side.

``windowed`` is the engine's own stateful aggregate: windows come out once the watermark has passed them, and later rows
vanish. ``start_window_counts`` keeps them: the open windows and the newest event time are one small versioned table, so a
micro-batch costs as much as its rows and the windows open at the time. A window is closed when it ends at or before the
newest event time less the allowed delay; a row whose window was closed by an earlier micro-batch is late.

Below ``path``: ``closed`` holds windows once they are final, ``open`` the others, ``late`` the rows that came too late, with
their window, and rows without an event time, which have none.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from fleetgauge.sources.table import write_batch
from fleetgauge.sources.versions import Versions
from fleetgauge.streaming.pipeline import start

COUNT = "messages"


def windowed(rows: DataFrame, keys: tuple[str, ...], ts: str, every: str, delay: str) -> DataFrame:
    """Rows per key and window of a stream; final windows in ``append`` mode, changes in ``update`` mode."""
    stamped = rows.withColumn("_ts", F.col(ts).cast("timestamp")).withWatermark("_ts", delay)
    counted = stamped.groupBy(F.window("_ts", every).alias("w"), *keys).agg(F.count(F.lit(1)).alias(COUNT))
    return counted.select(*keys, F.col("w.start").alias("window_start"), COUNT)


def _schema(rows: DataFrame, keys: tuple[str, ...]) -> str:
    return ", ".join([*[f"`{k}` {rows.schema[k].dataType.simpleString()}" for k in keys], f"window_start TIMESTAMP, {COUNT} BIGINT"])


def _count(rows: DataFrame, keys: tuple[str, ...]) -> DataFrame:
    return rows.groupBy(*keys, "window_start").agg(F.count(F.lit(1)).alias(COUNT))


def _sum(counts: DataFrame, keys: tuple[str, ...]) -> DataFrame:
    return counts.groupBy(*keys, "window_start").agg(F.sum(COUNT).alias(COUNT))


def _instant(us: int) -> Column:
    return F.timestamp_micros(F.lit(us))


def start_window_counts(
    rows: DataFrame, checkpoint: str, path: str, keys: tuple[str, ...], ts: str = "ts", seconds: int = 60,
    delay_s: int = 600, once: bool = False,
) -> StreamingQuery:
    """Count the rows of a stream per key and window of event time; read the counts with ``window_counts``.

    A batch's closed windows and late rows replace its folders and are written before the open windows are switched, so a
    batch that is run again writes the same or, once it is committed, nothing.
    """
    schema = _schema(rows, keys)

    def count(batch: DataFrame, batch_id: int) -> None:
        state = Versions(batch.sparkSession, f"{path}/open", schema)
        version = state.newest()
        if version.batches.get("stream", -1) >= batch_id:
            return
        stamped = batch.withColumn("_ts", F.col(ts).cast("timestamp"))
        placed = stamped.withColumn(
            "window_start", F.timestamp_seconds(F.floor(F.unix_seconds("_ts") / seconds) * seconds)
        ).persist()
        try:
            newest = placed.agg(F.max(F.unix_micros("_ts"))).first()[0]
            before = version.notes.get("newest_us")
            after = max((t for t in (before, newest) if t is not None), default=None)
            end = F.col("window_start") + F.make_dt_interval(secs=F.lit(seconds))
            late = F.col("window_start").isNull()
            if before is not None:
                late = late | (end <= _instant(before - delay_s * 1_000_000))
            on_time = _count(placed.filter(~late), keys)
            merged = _sum(state.rows(version).unionByName(on_time), keys).persist()
            final = end <= _instant(after - delay_s * 1_000_000) if after is not None else F.lit(False)
            write_batch(placed.filter(late).drop("_ts"), f"{path}/late", batch_id, ("batch_id",))
            write_batch(merged.filter(final), f"{path}/closed", batch_id, ("batch_id",))
            state.commit(lambda _: merged.filter(~final), "stream", batch_id, notes={} if after is None else {"newest_us": after})
            merged.unpersist()
        finally:
            placed.unpersist()
        state.forget(2, 3600.0)

    return start(rows, checkpoint, count, once)


def late_rows(spark: SparkSession, path: str, schema: str) -> DataFrame:
    """The rows that came after their window was closed, as they arrived, with their window and batch."""
    return spark.read.schema(f"{schema}, window_start TIMESTAMP, batch_id BIGINT").parquet(f"{path}/late")


def window_counts(spark: SparkSession, path: str, keys: dict[str, str], late: bool = True, open_windows: bool = True) -> DataFrame:
    """Counts per key and window; ``keys`` maps the key columns to their types.

    With ``late`` rows and open windows the counts are those of all rows that have an event time; without both, what was final
    when it was written.
    """
    schema = ", ".join([*[f"`{k}` {t}" for k, t in keys.items()], f"window_start TIMESTAMP, {COUNT} BIGINT"])
    names = tuple(keys)
    counts = spark.read.schema(f"{schema}, batch_id BIGINT").parquet(f"{path}/closed").drop("batch_id")
    if open_windows:
        state = Versions(spark, f"{path}/open", schema)
        counts = counts.unionByName(state.rows(state.newest()))
    if late:
        behind = late_rows(spark, path, ", ".join(f"`{k}` {t}" for k, t in keys.items())).filter(F.col("window_start").isNotNull())
        counts = counts.unionByName(_count(behind, names))
    return _sum(counts, names)
