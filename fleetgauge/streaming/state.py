"""Per-device state of the last readings, cut in parts so that one busy device does not sit in one task."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StatefulProcessor, StatefulProcessorHandle, StreamingQuery
from pyspark.sql.streaming.state import GroupState, GroupStateTimeout
from pyspark.sql.types import DoubleType, LongType, StructField, StructType

from fleetgauge import schemas
from fleetgauge.operators.stats import by_metric

STATE_PARTS = 8


def device_state(
    readings: DataFrame,
    keys: tuple[str, ...] = ("tenant_id", "device_id"),
    seq: str = "arrival_seq",
    ts: str = "ts",
    n: int = schemas.DEVICE_WINDOW,
    parts: int = STATE_PARTS,
    idle_hours: int | None = None,
) -> DataFrame:
    """Stream of changed state parts: keys, metric, part, the part's last ``n`` readings by arrival number.

    A device's readings are spread over ``parts`` states by a hash of the arrival number, as the numbers of one device
    may all fall in one topic partition. A reading without a time counts as seen now. The last ``n`` of the device are among
    the last ``n`` of its parts, so ``merge_device_state`` restores the exact window. ``idle_hours`` forgets devices
    that stopped sending; it is for queries that run all the time, as a timeout keeps an ``availableNow`` run from ending.
    """
    long = by_metric(readings, [*keys, seq, ts]).withColumn("part", F.pmod(F.xxhash64(seq), F.lit(parts)).cast("int"))
    seen = F.coalesce(F.col(ts).cast("timestamp"), F.current_timestamp())
    long = long.select(*keys, "metric", "part", seq, seen.alias("ts"), "value")
    group = [*keys, "metric", "part"]
    out_schema = ", ".join([f"{k} STRING" for k in keys]) + (
        ", metric STRING, part INT, seqs ARRAY<BIGINT>, readings ARRAY<DOUBLE>, last_seq BIGINT, last_seen TIMESTAMP"
    )
    timeout = GroupStateTimeout.ProcessingTimeTimeout if idle_hours else GroupStateTimeout.NoTimeout

    def update(key: tuple, batches: Iterator[pd.DataFrame], state: GroupState) -> Iterator[pd.DataFrame]:
        if state.hasTimedOut:
            state.remove()
            return
        seqs, values, last_seq, last_us = ([], [], -1, 0)
        if state.exists:
            seqs, values, last_seq, last_us = state.get
        seqs, values = np.asarray(seqs, dtype="int64"), np.asarray(values, dtype="float64")
        for batch in batches:
            seqs = np.concatenate([seqs, batch[seq].to_numpy("int64")])
            values = np.concatenate([values, batch["value"].to_numpy("float64")])
            seqs, first = np.unique(seqs, return_index=True)
            seqs, values = seqs[-n:], values[first][-n:]
            newest = int(batch[seq].to_numpy().argmax())
            if int(batch[seq].iloc[newest]) > last_seq:
                last_seq = int(batch[seq].iloc[newest])
                last_us = int(pd.Timestamp(batch["ts"].iloc[newest]).value // 1000)
        state.update((seqs.tolist(), values.tolist(), last_seq, last_us))
        if idle_hours:
            state.setTimeoutDuration(idle_hours * 3_600_000)
        yield pd.DataFrame(
            {
                **{name: [part] for name, part in zip(group, key)},
                "seqs": [seqs.tolist()],
                "readings": [values.tolist()],
                "last_seq": [last_seq],
                "last_seen": [pd.Timestamp(last_us * 1000)],
            }
        )

    return long.groupBy(*group).applyInPandasWithState(
        update, out_schema, "seqs ARRAY<BIGINT>, readings ARRAY<DOUBLE>, last_seq BIGINT, last_us BIGINT", "update",
        timeout,
    )


def newest_parts(
    changes: DataFrame, keys: tuple[str, ...] = ("tenant_id", "device_id"), version: str = "batch_id"
) -> DataFrame:
    """The last version of every part from the written changes, which carry the batch that wrote them as ``version``.

    A late batch may change a part without raising its highest arrival number, so only the batch tells versions apart.
    """
    group = [*keys, "metric", "part"]
    rest = [c for c in changes.columns if c not in (*group, version)]
    return changes.groupBy(*group).agg(F.max_by(F.struct(*rest), version).alias("_p")).select(*group, "_p.*")


def merge_device_state(
    parts: DataFrame, keys: tuple[str, ...] = ("tenant_id", "device_id"), n: int = schemas.DEVICE_WINDOW
) -> DataFrame:
    """Device statistics from the state parts; at most parts x n readings per device and metric meet here."""
    group = [*keys, "metric"]
    pairs = F.arrays_zip(F.col("seqs"), F.col("readings"))
    gathered = parts.groupBy(*group).agg(
        F.slice(F.sort_array(F.flatten(F.collect_list(pairs)), asc=False), 1, n).alias("_last"),
        F.max_by("last_seen", "last_seq").alias("last_seen"),
    )
    values = F.col("_last")["readings"]
    total = F.aggregate(values, F.lit(0.0), lambda a, x: a + x)
    return gathered.select(
        *group,
        F.size("_last").cast("bigint").alias("count"),
        (total / F.size("_last")).alias("avg"),
        F.array_min(values).alias("min"),
        F.array_max(values).alias("max"),
        F.reverse(values).alias("readings"),
        "last_seen",
    )


def last_readings(n: int, seq: str, idle_ms: int | None) -> StatefulProcessor:
    """The last ``n`` readings of a part of a device as list state, and the newest arrival as value state.

    Both are forgotten ``idle_ms`` after the part's last change, by the state's own expiry: no timer keeps a run from ending.
    """

    # Inside a function, so that it travels to the workers whole and they need not have this package.
    class LastReadings(StatefulProcessor):
        def init(self, handle: StatefulProcessorHandle) -> None:
            reading = StructType([StructField("seq", LongType()), StructField("value", DoubleType())])
            arrival = StructType([StructField("last_seq", LongType()), StructField("last_us", LongType())])
            self.readings = handle.getListState("readings", reading, idle_ms)
            self.arrival = handle.getValueState("arrival", arrival, idle_ms)

        def handleInputRows(self, key: tuple, rows: Iterator[pd.DataFrame], timer_values) -> Iterator[pd.DataFrame]:
            held = list(self.readings.get()) if self.readings.exists() else []
            seqs, values = np.array([r[0] for r in held], "int64"), np.array([r[1] for r in held], "float64")
            last_seq, last_us = self.arrival.get() if self.arrival.exists() else (None, None)
            for batch in rows:
                own = batch[seq].to_numpy("int64")
                seqs, values = np.concatenate([seqs, own]), np.concatenate([values, batch["value"].to_numpy("float64")])
                seqs, first = np.unique(seqs, return_index=True)
                seqs, values = seqs[-n:], values[first][-n:]
                newest = int(own.argmax())
                if last_seq is None or int(own[newest]) > last_seq:
                    last_seq, last_us = int(own[newest]), int(pd.Timestamp(batch["ts"].iloc[newest]).value // 1000)
            self.readings.put(list(zip(seqs.tolist(), values.tolist(), strict=True)))
            self.arrival.update((last_seq, last_us))
            yield pd.DataFrame({"parts_changed": [1]})

        def close(self) -> None:
            pass

    return LastReadings()


def device_windows(
    readings: DataFrame, keys: tuple[str, ...] = ("tenant_id", "device_id"), seq: str = "arrival_seq", ts: str = "ts",
    n: int = schemas.DEVICE_WINDOW, parts: int = STATE_PARTS, idle_ms: int | None = None,
) -> DataFrame:
    """Per-device windows of a stream as expiring state; one row per changed part comes out.

    Parts are as in ``device_state``. The windows are read from the checkpoint with ``device_windows_now``: only their newest
    version is kept there, so reading them costs what they hold and not how often they changed. Start it with ``start_windows``.
    """
    long = by_metric(readings, [*keys, seq, ts]).withColumn("part", F.pmod(F.xxhash64(seq), F.lit(parts)).cast("int"))
    seen = F.coalesce(F.col(ts).cast("timestamp"), F.current_timestamp())
    long = long.select(*keys, "metric", "part", seq, seen.alias("ts"), "value")
    return long.groupBy(*keys, "metric", "part").transformWithStateInPandas(
        last_readings(n, seq, idle_ms), "parts_changed INT", "update", "ProcessingTime"
    )


#: Expiring state needs RocksDB; and as expiry is a kind of timer, batches without data would never end.
WINDOW_CONF = {
    "spark.sql.streaming.stateStore.providerClass": "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider",
    "spark.sql.streaming.noDataMicroBatches.enabled": "false",
}


def start_windows(windows: DataFrame, checkpoint: str, once: bool = False) -> StreamingQuery:
    """Run ``device_windows``; ``once`` stops after what is there now. The settings it needs hold for this query only."""
    spark = windows.sparkSession
    before = {key: spark.conf.get(key, None) for key in WINDOW_CONF}
    for key, value in WINDOW_CONF.items():
        spark.conf.set(key, value)
    try:
        writer = windows.writeStream.outputMode("update").option("checkpointLocation", checkpoint).format("noop")
        return (writer.trigger(availableNow=True) if once else writer).start()
    finally:
        for key, value in before.items():
            spark.conf.unset(key) if value is None else spark.conf.set(key, value)


def device_windows_now(spark: SparkSession, checkpoint: str, keys: tuple[str, ...] = ("tenant_id", "device_id")) -> DataFrame:
    """The parts of all device windows as the last finished micro-batch left them, for ``merge_device_state``."""
    group = [*keys, "metric", "part"]

    def variable(name: str, column: str) -> tuple[DataFrame, Column]:
        """The state variable and its value; one that expires is kept as (value, expiry)."""
        kept = spark.read.format("statestore").option("path", checkpoint).option("stateVarName", name).load()
        if set(kept.schema[column].dataType.fieldNames()) != {"value", "ttlExpirationMs"}:
            return kept, F.col(column)
        alive = F.col(column)["ttlExpirationMs"] > F.unix_millis(F.current_timestamp())
        return kept.filter(alive), F.col(column)["value"]

    lists, item = variable("readings", "list_element")
    values, last = variable("arrival", "value")
    rows = lists.select(*[F.col("key")[k].alias(k) for k in group], item["seq"].alias("seq"), item["value"].alias("value"))
    windows = rows.groupBy(*group).agg(F.sort_array(F.collect_list(F.struct("seq", "value"))).alias("_r"))
    arrivals = values.select(
        *[F.col("key")[k].alias(f"_{k}") for k in group], last["last_seq"].alias("last_seq"), F.timestamp_micros(last["last_us"]).alias("last_seen")
    )
    same = [windows[k].eqNullSafe(arrivals[f"_{k}"]) for k in group]
    return windows.join(arrivals, same).select(*group, F.col("_r")["seq"].alias("seqs"), F.col("_r")["value"].alias("readings"), "last_seq", "last_seen")
