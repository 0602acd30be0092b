"""The topic reader and writer against a stand-in with the columns and options of the Kafka connector, of one process's files."""

import json

import pytest
from pyspark.sql import functions as F

from fleetgauge import schemas
from fleetgauge.operators import clean, process
from fleetgauge.sources import messages
from fleetgauge.sources.store import Store
from fleetgauge.streaming import pipeline

# The columns that the connector reads.
TOPIC = "key BINARY, value BINARY, topic STRING, partition INT, offset BIGINT, timestamp TIMESTAMP, timestampType INT"


def stand_in():
    """Defined inside a function, so that it travels to the workers whole."""
    import datetime as dt
    import json
    import os
    import zlib

    from pyspark.sql.datasource import (DataSource, DataSourceReader, DataSourceStreamWriter, DataSourceWriter, InputPartition,
                                        SimpleDataSourceStreamReader, WriterCommitMessage)

    columns, partitions = TOPIC, 4

    def lines(options, topic):
        folder = os.path.join(options["stub.path"], topic)
        rows, seen = [], {}
        for name in sorted(os.listdir(folder)) if os.path.isdir(folder) else []:
            with open(os.path.join(folder, name)) as f:
                for line in f:
                    key, value = json.loads(line)
                    p = zlib.crc32((key or "").encode()) % partitions
                    seen[p] = seen.get(p, -1) + 1
                    rows.append((key and key.encode(), value.encode(), topic, p, seen[p], dt.datetime(2024, 3, 1) + dt.timedelta(seconds=len(rows)), 0))
        return rows

    def append(options, rows, name):
        folder = os.path.join(options["stub.path"], options["topic"])
        os.makedirs(folder, exist_ok=True)
        with open(os.path.join(folder, name + "-" + str(os.getpid()) + str(len(os.listdir(folder))).zfill(6)), "w") as f:
            for r in rows:
                assert set(r.asDict()) == {"key", "value"}
                f.write(json.dumps([r.key, r.value]) + "\n")
        return WriterCommitMessage()

    class Reader(DataSourceReader):
        def __init__(self, options):
            assert options["startingoffsets"] == "earliest" and options["kafka.bootstrap.servers"] == "nowhere:1"
            self.options = dict(options)

        def partitions(self):
            return [InputPartition(0)]

        def read(self, partition):
            yield from lines(self.options, self.options["subscribe"])

    class StreamReader(SimpleDataSourceStreamReader):
        def __init__(self, options):
            self.options = dict(options)

        def initialOffset(self):
            return {"n": 0}

        def read(self, start):
            rows = lines(self.options, self.options["subscribe"])[start["n"] :]
            return iter(rows), {"n": start["n"] + len(rows)}

        def readBetweenOffsets(self, start, end):
            return iter(lines(self.options, self.options["subscribe"])[start["n"] : end["n"]])

        def commit(self, end):
            pass

    class Writer(DataSourceWriter):
        def __init__(self, options):
            self.options = dict(options)

        def write(self, rows):
            return append(self.options, list(rows), "b")

    class StreamWriter(DataSourceStreamWriter):
        def __init__(self, options):
            self.options = dict(options)

        def write(self, rows):
            return append(self.options, list(rows), "s")

        def commit(self, messages, batch_id):
            pass

        def abort(self, messages, batch_id):
            pass

    class Topics(DataSource):
        @classmethod
        def name(cls):
            return "topics_of_files"

        def schema(self):
            return columns

        def reader(self, schema):
            return Reader(self.options)

        def simpleStreamReader(self, schema):
            return StreamReader(self.options)

        def writer(self, schema, overwrite):
            return Writer(self.options)

        def streamWriter(self, schema, overwrite):
            return StreamWriter(self.options)

    return Topics


@pytest.fixture(scope="module")
def connector(spark):
    spark.dataSource.register(stand_in())
    return "topics_of_files"


def raw(spark, n=60):
    rows = []
    for i in range(n):
        body = {"device_id": f"d{i % 5}", "tenant_id": "tenant3", "temperature": 15 + i % 30, "humidity": 40.5, "timestamp": 1709294400 + i}
        rows.append(("{bad" if i % 20 == 7 else json.dumps(body), f"d{i % 5}" if i % 6 else None))
    return spark.createDataFrame(rows, "value STRING, device_id STRING").coalesce(1)


def test_batch_write_and_read(spark, connector, tmp_path):
    options = {"connector": connector, "stub.path": str(tmp_path)}
    sent = messages.to_messages(raw(spark), F.col("value"))
    assert messages.write_topic(sent, "nowhere:1", messages.RAW_TOPIC, **options) is None
    got = messages.read_topic(spark, "nowhere:1", streaming=False, **options)
    assert dict(got.dtypes) == dict(spark.createDataFrame([], f"{schemas.ENVELOPE}, arrival_seq BIGINT").dtypes)
    rows = got.collect()
    assert sorted((r.key or "", r.value) for r in rows) == sorted((r.key or "", r.value) for r in sent.collect())
    assert len({r.arrival_seq for r in rows}) == 60 and all(r.arrival_seq == r.offset * 6 + r.partition for r in rows)


def test_the_whole_way_from_topic_to_topic_to_store(spark, connector, tmp_path):
    """Raw topic, cleaned, clean topic with keys kept, scored, stored: each step a stream of its own, restarted once."""
    options = {"connector": connector, "stub.path": str(tmp_path / "topics")}
    store, config = Store(spark, str(tmp_path / "store")), schemas.tenant_config(spark)

    def run():
        source = messages.read_topic(spark, "nowhere:1", messages.RAW_TOPIC, **options)
        cleaned = clean.accepted(clean.clean_messages(source))
        out = messages.to_messages(cleaned, clean.to_clean_json(cleaned), "key")
        messages.write_topic(out, "nowhere:1", messages.CLEAN_TOPIC, str(tmp_path / "cp1"), once=True, **options).awaitTermination()
        again = messages.read_topic(spark, "nowhere:1", messages.CLEAN_TOPIC, **options)
        pipeline.start_store(again, config, str(tmp_path / "cp2"), store, once=True).awaitTermination()

    for _ in range(2):
        messages.write_topic(messages.to_messages(raw(spark), F.col("value")), "nowhere:1", messages.RAW_TOPIC, **options)
        run()
    run()
    kept = messages.read_topic(spark, "nowhere:1", messages.CLEAN_TOPIC, streaming=False, **options)
    assert kept.count() == 114 and kept.filter("key IS NULL").count() == raw(spark).filter("device_id IS NULL AND value <> '{bad'").count() * 2
    assert store.read().count() == 114 and store.read().select("row_key").distinct().count() == 114
    batch = process.process_readings(clean.accepted(clean.clean_messages(kept)).drop("processed_at"), config)
    assert store.read().filter("is_anomaly").count() == process.alerts(batch).count()
