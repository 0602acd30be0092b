"""The stored table, retention in place, and streams: equal to batch, restartable, without duplicates."""

import datetime as dt
import json

import pytest
from pyspark.sql import functions as F

from fleetgauge import schemas
from fleetgauge.operators import clean, process, recent, stats
from fleetgauge.sources import messages, table
from fleetgauge.streaming import pipeline, state

T0 = dt.datetime(2024, 3, 1, 12, 0)


def stored(spark, rows):
    """rows: (key, tenant, created_at)"""
    df = spark.createDataFrame(rows, "row_key BIGINT, tenant_id STRING, created_at TIMESTAMP")
    return df.select(
        "row_key", F.lit("d").alias("device_id"), F.lit(20.0).alias("temperature"), F.lit(50.0).alias("humidity"),
        F.col("created_at").alias("timestamp"), F.lit(False).alias("is_anomaly"), F.lit(0.0).alias("anomaly_score"),
        "created_at", "tenant_id", F.to_date("created_at").alias("created_date"),
    )


def keys(df):
    return sorted(r[0] for r in df.select("row_key").collect())


def test_append_ignores_replays(spark, tmp_path):
    path = str(tmp_path / "t")
    table.append(spark, stored(spark, [(1, "a", T0), (1, "a", T0), (2, "å/测 试", T0)]), path, 0)
    table.append(spark, stored(spark, [(2, "å/测 试", T0), (3, "a", T0 + dt.timedelta(days=1))]), path, 1)
    table.append(spark, stored(spark, [(3, "a", T0 + dt.timedelta(days=1))]), path, 1)
    assert keys(table.read_table(spark, path)) == [1, 2, 3]
    assert keys(recent.tenant_rows(table.read_table(spark, path), "å/测 试")) == [2]


def test_append_keeps_what_the_batch_stored_before(spark, tmp_path):
    path = str(tmp_path / "t")
    table.append(spark, stored(spark, [(1, "a", T0)]), path, 0)
    table.append(spark, stored(spark, [(3, "a", T0)]), path, 1)
    table.append(spark, stored(spark, [(3, "a", T0), (4, "a", T0)]), path, 1)
    assert keys(table.read_table(spark, path)) == [1, 3, 4]


def test_retention_of_rows_without_a_tenant(spark, tmp_path):
    path, as_of = str(tmp_path / "t"), dt.datetime(2024, 6, 1, 12)
    edge = as_of - dt.timedelta(days=schemas.DEFAULT_RETENTION_DAYS)
    ages = [dt.timedelta(seconds=1), dt.timedelta(seconds=-1), dt.timedelta(days=3), dt.timedelta(days=-3)]
    table.write_batch(stored(spark, [(i, None, edge + age) for i, age in enumerate(ages)]), path, 0)
    counts = table.apply_retention(spark, path, schemas.retention_policies(spark), as_of)
    assert [tuple(r) for r in counts.collect()] == [(None, 2)]
    assert keys(table.read_table(spark, path)) == [0, 2]


def test_store_takes_no_undecodable_message(spark):
    good = '{"device_id":"d","tenant_id":"t","temperature":1.5,"timestamp":"2024-03-01T00:00:00Z","is_anomaly":true}'
    bad = ['{bad', '', '[]', '{"device_id":"d","tenant_id":"t","temperature":"hot"}', '{"device_id":"d","tenant_id":"t","timestamp":5}',
           '{"device_id":7,"tenant_id":"t"}', '{"device_id":"d"}', None]
    rows = spark.createDataFrame(list(enumerate([good, *bad])), "arrival_seq BIGINT, value STRING")
    checked = {r.arrival_seq: r for r in process.check_for_store(process.decode_processed(rows)).collect()}
    assert [i for i, r in checked.items() if r.reject_reason is None] == [0]
    assert (checked[0].temperature, checked[0].is_anomaly, checked[7].reject_reason) == (1.5, True, "tenant_id is required")


def test_topic_with_more_partitions_than_stated_stops(spark):
    rows = spark.createDataFrame([(6, 0)], "partition INT, offset BIGINT")
    with pytest.raises(Exception, match="more than 6 partitions"):
        rows.select(messages.arrival_seq()).collect()
    assert rows.select(messages.arrival_seq(12)).first()[0] == 6


def test_late_batch_and_missing_time_in_device_state(spark, tmp_path):
    schema = "tenant_id STRING, device_id STRING, arrival_seq BIGINT, ts TIMESTAMP, temperature DOUBLE, humidity DOUBLE"
    live = str(tmp_path / "live")
    for seqs in ([5], [1, 2]):
        rows = [("t", "d", s, None if s == 2 else T0, float(s), None) for s in seqs]
        spark.createDataFrame(rows, schema).coalesce(1).write.mode("append").parquet(live)
        changes = state.device_state(spark.readStream.schema(schema).parquet(live), n=20, parts=1)
        (
            changes.writeStream.outputMode("update").option("checkpointLocation", str(tmp_path / "cp"))
            .foreachBatch(lambda rows, i: table.write_batch(rows, str(tmp_path / "state"), i, ("batch_id",)))
            .trigger(availableNow=True).start().awaitTermination()
        )
    got = state.merge_device_state(state.newest_parts(spark.read.parquet(str(tmp_path / "state"))), n=20)
    assert [tuple(r) for r in got.select("metric", "count", "readings").collect()] == [("temperature", 3, [1.0, 2.0, 5.0])]


def test_newer_only_of_a_null_key_across_batches(spark, tmp_path):
    schema, live = "arrival_seq BIGINT, tenant_id STRING, ts TIMESTAMP", str(tmp_path / "live")
    for seq, late in ((1, 0), (2, -60), (3, 60)):
        spark.createDataFrame([(seq, None, T0 + dt.timedelta(seconds=late))], schema).write.mode("append").parquet(live)
        pipeline.start_newer_only(
            spark.readStream.schema(schema).parquet(live), str(tmp_path / "cp"), str(tmp_path / "kept"),
            str(tmp_path / "newest"), once=True,
        ).awaitTermination()
    assert sorted(r[0] for r in spark.read.parquet(str(tmp_path / "kept")).select("arrival_seq").collect()) == [1, 3]


def test_tenant_filter_selects_folders(spark, tmp_path):
    path = str(tmp_path / "t")
    table.write_batch(stored(spark, [(1, "a", T0), (2, "b", T0)]), path, 0)
    plan = recent.tenant_rows(table.read_table(spark, path), "a")._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(tenant_id" in plan


@pytest.mark.parametrize("as_of", [dt.datetime(2024, 6, 1), dt.datetime(2024, 6, 1, 7, 30)])
def test_retention_in_place(spark, tmp_path, as_of):
    path = str(tmp_path / "t")
    rows, expected, key = [], [], 0
    for tenant, days in (("tenant1", 90), ("tenant2", 30), ("tenant 9/x", 60)):
        edge = as_of - dt.timedelta(days=days)
        for offset, keep in ((-86400 * 3, False), (-1, False), (0, True), (1, True), (86400 * 2, True)):
            key += 1
            rows.append((key, tenant, edge + dt.timedelta(seconds=offset)))
            expected += [key] if keep else []
    df = stored(spark, rows)
    table.write_batch(df.filter("row_key % 2 = 0"), path, 0)
    table.write_batch(df.filter("row_key % 2 = 1"), path, 1)
    counts = table.apply_retention(spark, path, schemas.retention_policies(spark), as_of)
    assert {r.tenant_id: r.deleted for r in counts.collect()} == {"tenant1": 2, "tenant2": 2, "tenant 9/x": 2}
    assert keys(table.read_table(spark, path)) == expected
    again = table.apply_retention(spark, path, schemas.retention_policies(spark), as_of)
    assert again.count() == 0 and keys(table.read_table(spark, path)) == expected
    assert not [p for p in (tmp_path / "t").iterdir() if p.name.startswith("_staging")]


def envelopes(folder, start, count, tenant="tenant3"):
    folder.mkdir(exist_ok=True)
    lines = []
    for i in range(start, start + count):
        body = {"device_id": f"d{i % 3}", "tenant_id": tenant, "temperature": 20 + i % 40, "humidity": 50 + i % 45,
                "timestamp": 1709294400 + (i * 37) % 1000}
        value = "{bad" if i % 17 == 0 else json.dumps(body)
        lines.append(json.dumps({"key": f"d{i % 3}", "value": value, "partition": i % 6, "offset": i // 6,
                                 "ingest_ts": (T0 + dt.timedelta(seconds=i)).isoformat() + "Z"}))
    (folder / f"{start:06d}.json").write_text("\n".join(lines))


def test_pipeline_restart_leaves_no_duplicates(spark, tmp_path):
    landing, out = tmp_path / "in", tmp_path / "out"
    envelopes(landing, 0, 100)
    envelopes(landing, 100, 100)

    def run():
        stream = messages.read_envelopes(spark, str(landing), streaming=True, files_per_trigger=1)
        pipeline.start_pipeline(
            stream, schemas.tenant_config(spark), str(out / "cp"), str(out / "t"), str(out / "rejects"),
            str(out / "alerts"), str(out / "outcomes"), once=True,
        ).awaitTermination()

    run()
    envelopes(landing, 200, 100)
    run()
    run()
    batch = pipeline.clean_and_process(messages.read_envelopes(spark, str(landing)), schemas.tenant_config(spark))
    wanted = process.for_store(process.published(batch))
    got = table.read_table(spark, str(out / "t"))
    columns = wanted.columns
    assert sorted(map(tuple, got.select(*columns).collect())) == sorted(map(tuple, wanted.collect()))
    assert spark.read.parquet(str(out / "rejects")).count() == batch.filter("outcome = 'error'").count() == 18
    assert spark.read.parquet(str(out / "alerts")).count() == batch.filter("outcome = 'anomaly'").count() > 0
    assert spark.read.parquet(str(out / "outcomes")).agg(F.sum("messages")).first()[0] == 300


def test_a_repeated_batch_replaces_itself(spark, tmp_path):
    path = str(tmp_path / "t")
    rows = stored(spark, [(1, "a", T0), (2, "b", T0)])
    table.write_batch(rows, path, 5)
    table.write_batch(rows, path, 5)
    assert keys(table.read_table(spark, path)) == [1, 2]


def typed_files(spark, folder, parts):
    schema = "arrival_seq BIGINT, tenant_id STRING, device_id STRING, ts TIMESTAMP, temperature DOUBLE, humidity DOUBLE"
    rows = [
        (i, f"t{i % 2}", f"d{i % 4}", T0 + dt.timedelta(seconds=(i * 53) % 700), float(i % 91), None if i % 5 == 0 else float(i % 83))
        for i in range(900)
    ]
    for p in range(parts):
        spark.createDataFrame(rows[p::parts], schema).coalesce(1).write.mode("append").parquet(folder)
    return schema, spark.createDataFrame(rows, schema)


def test_device_state_equals_batch(spark, tmp_path):
    folder = str(tmp_path / "in")
    schema, whole = typed_files(spark, folder, 3)
    stream = spark.readStream.schema(schema).option("maxFilesPerTrigger", 1).parquet(folder)
    changes = state.device_state(stream, n=20, parts=4)
    (
        changes.writeStream.outputMode("update").option("checkpointLocation", str(tmp_path / "cp"))
        .foreachBatch(lambda rows, i: table.write_batch(rows, str(tmp_path / "state"), i, ("batch_id",)))
        .trigger(availableNow=True).start().awaitTermination()
    )
    parts = state.newest_parts(spark.read.parquet(str(tmp_path / "state")))
    got = state.merge_device_state(parts, n=20)
    expected = stats.device_window_stats(whole, n=20)
    columns = ["tenant_id", "device_id", "metric", "count", "min", "max", "readings"]
    assert sorted(map(tuple, got.select(*columns).collect())) == sorted(map(tuple, expected.select(*columns).collect()))


def test_newer_only_across_batches(spark, tmp_path):
    folder = tmp_path / "in"
    schema, whole = typed_files(spark, str(folder), 1)
    ordered_files = [whole.filter(f"arrival_seq >= {a} AND arrival_seq < {a + 300}") for a in (0, 300, 600)]
    live = str(tmp_path / "live")
    for part in ordered_files:
        part.coalesce(1).write.mode("append").parquet(live)
        stream = spark.readStream.schema(schema).parquet(live)
        pipeline.start_newer_only(
            stream, str(tmp_path / "cp"), str(tmp_path / "kept"), str(tmp_path / "newest"), once=True, max_rows=50
        ).awaitTermination()
    got = sorted(r[0] for r in spark.read.parquet(str(tmp_path / "kept")).select("arrival_seq").collect())
    assert got == sorted(r[0] for r in recent.newer_only(whole).select("arrival_seq").collect())


def test_landing_files(spark, tmp_path):
    (tmp_path / "a.jsonl").write_text('{"device_id":"x","timestamp":5}\n{bad\n')
    rows = clean.clean_messages(messages.read_landing(spark, str(tmp_path)))
    assert sorted((r.device_id, r.reject_reason) for r in rows.collect() if r.device_id) == [("x", None)]
    stream = messages.read_landing(spark, str(tmp_path), streaming=True)
    assert clean.clean_messages(stream).isStreaming


def test_topic_messages_keep_their_key(spark):
    df = clean.clean_messages(
        spark.createDataFrame([("k", '{"device_id":"x"}')], "key STRING, value STRING").withColumn("ingest_ts", F.lit(T0))
    )
    out = messages.to_messages(df, clean.to_clean_json(df), "key").first()
    assert out.key == "k" and json.loads(out.value)["device_id"] == "x"
