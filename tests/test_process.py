"""Scoring, sampling, tenants, retention, usage and fan-out on small literal tables."""

import datetime as dt
import json

import pytest
from pyspark.sql import functions as F

from fleetgauge import schemas
from fleetgauge.operators import lookup, process, retention, stats, tenants, usage, validate
from fleetgauge.operators.analytics import analytics_result, tenant_anomalies
from fleetgauge.operators.fanout import fan_out, subscribers_with_default

READ = "arrival_seq BIGINT, tenant_id STRING, device_id STRING, ts TIMESTAMP, temperature DOUBLE, humidity DOUBLE"
T0 = dt.datetime(2024, 1, 1, 10, 0)


def readings(spark, rows):
    return spark.createDataFrame(rows, READ)


def test_scores_and_thresholds(spark):
    cases = [(25.5, 60.0, 0), (35.0, 80.0, 1), (35.0, 81.0, 2), (30.0, 80.0, 0), (10.0, 20.0, 0), (None, 85.0, 1), (None, None, 0)]
    rows, expected = [], []
    for tenant in ("tenant1", "tenant3"):
        for t, h, score in cases:
            rows.append((2 * len(rows), tenant, "d", T0, t, h))
            expected.append((score, tenant == "tenant3" and score == 2))
    out = process.process_readings(readings(spark, rows), schemas.tenant_config(spark)).orderBy("arrival_seq").collect()
    assert [(r.anomaly_score, r.is_anomaly) for r in out] == expected
    assert [r.outcome for r in out] == ["anomaly" if a else "normal" for _, a in expected]


def test_config_defaults_and_missing_device(spark):
    rows = [(1, "", "d", T0, 35.0, 81.0), (2, None, "d", None, 35.0, 81.0), (3, "tenantX", "", T0, 1.0, 1.0), (4, "t", None, T0, 1.0, 1.0)]
    out = process.process_readings(readings(spark, rows), schemas.tenant_config(spark), now=F.lit("2024-02-01").cast("timestamp"))
    out = out.orderBy("arrival_seq").collect()
    assert [r.tenant_id for r in out] == ["default", "default", "tenantX", "t"]
    assert [r.outcome for r in out] == ["anomaly", "anomaly", "error", "error"]
    assert out[1].timestamp == dt.datetime(2024, 2, 1)


def test_sampling_is_repeatable_and_close_to_the_rate(spark):
    df = spark.range(20_000).select(
        F.col("id").alias("arrival_seq"), F.lit("tenant2").alias("tenant_id"), F.lit("d").alias("device_id"),
        F.lit(T0).alias("ts"), F.lit(20.0).alias("temperature"), F.lit(50.0).alias("humidity"),
    )
    def kept():
        out = process.published(process.process_readings(df, schemas.tenant_config(spark)))
        return {r[0] for r in out.select("arrival_seq").collect()}
    first = kept()
    assert first == kept() and 0.48 < len(first) / 20_000 < 0.52
    status = stats.processing_status(process.process_readings(df, schemas.tenant_config(spark))).first()
    assert status.processed_count == len(first) and status.error_count == 20_000 - len(first)


def test_processed_json_omits_empty_values(spark):
    rows = [(1, "t", "d", T0, None, 50.0), (2, "t", "d", T0, 35.0, 81.0)]
    df = process.process_readings(readings(spark, rows), schemas.tenant_config(spark), now=F.lit(T0))
    texts = [json.loads(r[0]) for r in df.orderBy("arrival_seq").select(process.to_processed_json(df)).collect()]
    stamp = "2024-01-01T10:00:00Z"
    assert texts[0] == {"device_id": "d", "humidity": 50.0, "timestamp": stamp, "processed_at": stamp, "tenant_id": "t"}
    assert texts[1]["is_anomaly"] is True and texts[1]["anomaly_score"] == 2.0


def test_global_and_device_stats(spark):
    rows = [(i, "t", "d", T0, 20.0 + 5 * i, 50.0 + 10 * i) for i in range(3)]
    got = {r.metric: tuple(r)[1:] for r in stats.global_stats(readings(spark, rows)).collect()}
    assert got == {"temperature": (3, 75.0, 20.0, 30.0, 25.0), "humidity": (3, 180.0, 50.0, 70.0, 60.0)}
    empty = stats.global_stats(readings(spark, [])).collect()
    assert [(r["count"], r["min"], r["avg"]) for r in empty] == [(0, None, None)] * 2
    many = [(i, "t", "d", T0, float(i), None) for i in range(250)]
    last = stats.device_window_stats(readings(spark, many)).collect()
    assert [(r.metric, r["min"], r["max"], r["avg"]) for r in last] == [("temperature", 150.0, 249.0, 199.5)]
    assert last[0].readings == [float(i) for i in range(150, 250)]


def test_last_seen_follows_arrival(spark):
    rows = [(1, "t", "d", T0 + dt.timedelta(minutes=2), 1.0, 1.0), (2, "t", "d", T0 + dt.timedelta(minutes=1), 1.0, 1.0)]
    assert stats.device_last_seen(readings(spark, rows)).first().last_seen == T0 + dt.timedelta(minutes=1)


def test_tenant_stats(spark):
    rows = [(1, "t", "001", T0, 20.0, 50.0), (2, "t", "001", T0, 25.0, 60.0), (3, "t", "002", T0, 30.0, 70.0)]
    df = readings(spark, rows).withColumn("is_anomaly", F.lit(False))
    assert tuple(stats.stats_of_tenant(df, "t").first()) == ("t", 2, 3, 0, 25.0, 60.0)
    assert tuple(stats.stats_of_tenant(df, "nobody").first()) == ("nobody", 0, 0, 0, 0.0, 0.0)


def test_retention_boundaries(spark):
    as_of = dt.datetime(2024, 6, 1)
    rows, second = [], dt.timedelta(seconds=1)
    for tenant, days in (("tenant1", 90), ("tenant2", 30), ("tenant9", 60)):
        edge = as_of - dt.timedelta(days=days)
        rows += [(tenant, edge, True), (tenant, edge - second, False), (tenant, edge + second, True)]
    df = spark.createDataFrame(rows, "tenant_id STRING, created_at TIMESTAMP, keep BOOLEAN")
    kept = retention.survivors(df, schemas.retention_policies(spark), F.lit(as_of)).collect()
    assert len(kept) == 6 and all(r.keep for r in kept)
    gone = {r.tenant_id: r.deleted for r in retention.deleted_counts(df, schemas.retention_policies(spark), F.lit(as_of)).collect()}
    assert gone == {"tenant1": 1, "tenant2": 1, "tenant9": 1}
    none = schemas.retention_policies(spark).limit(0)
    assert retention.deleted_counts(df, none, F.lit(as_of)).agg(F.sum("deleted")).first()[0] == 4


def test_keys_and_tiers(spark):
    known = schemas.managed_tenants(spark)
    idle = known.filter("id = 'tenant1'").select(
        *[F.lit(False).alias(c) if c == "active" else F.lit("inactive-api-key").alias(c) if c == "api_key" else c for c in known.columns]
    )
    asked = spark.createDataFrame([("test-key-1",), ("invalid-key",), ("",), (None,), ("inactive-api-key",)], "api_key STRING")
    rows = {r.api_key: r for r in tenants.api_key_status(asked, known.unionByName(idle)).collect()}
    assert {k: r.status for k, r in rows.items()} == {
        "test-key-1": "ok", "invalid-key": "unknown", "": "missing", None: "missing", "inactive-api-key": "inactive"
    }
    assert (rows["test-key-1"].anomaly_threshold, rows["test-key-1"].tenant_id) == (1.0, "tenant1")
    assert rows["inactive-api-key"].tenant_id is None
    named = spark.createDataFrame([("FREE",), ("gold",), (None,)], "tier STRING")
    got = {r.tier: r.config_tier for r in tenants.with_tier_config(named, schemas.tiers(spark)).collect()}
    assert got == {"FREE": "free", "gold": "standard", None: "standard"}


def test_known_keys_are_trimmed_and_deduplicated(spark):
    keys = spark.createDataFrame([(" a ",), ("a",), ("",)], "api_key STRING")
    asked = spark.createDataFrame([("a",), ("b",), ("",)], "api_key STRING")
    assert [r[0] for r in validate.with_known_key(asked, keys).collect()] == ["a"]
    assert sorted(r[0] for r in validate.with_unknown_key(asked, keys).collect()) == ["", "b"]


def test_tenant_changes(spark):
    cols = "id STRING, name STRING, api_key STRING, tier STRING, active BOOLEAN, created_at TIMESTAMP, quota_limit INT, rate_limit INT, sampling_rate DOUBLE, retention_days INT"
    def row(i, name, key):
        return (i, name, key, "free", True, T0, 1, 1, 0.5, 7)
    current = spark.createDataFrame([row("a", "A", "ka"), row("b", "B", "kb"), row("c", "C", "kc"), row("d", "D", "kd")], cols)
    later = T0 + dt.timedelta(days=1)
    def change(seq, op, i, name, key):
        return (seq, op, i, name, key, "premium", False, later, 2, 2, 1.0, 90)
    feed = [
        change(1, "update", "a", "A1", "new"), change(2, "update", "a", "A2", ""),
        change(3, "delete", "b", "", ""),
        change(4, "delete", "c", "", ""), change(5, "create", "c", "C1", "kc1"), change(6, "update", "c", "C2", None),
        change(7, "update", "zz", "none", "x"),
        change(8, "create", "e", "E", "ke"), change(9, "delete", "e", "", ""),
        change(10, "update", "d", "D1", "late"), change(11, "delete", "d", "", ""), change(12, "update", "d", "D2", "y"),
    ]
    out = {r.id: r for r in tenants.apply_changes(current, spark.createDataFrame(feed, f"change_seq BIGINT, op STRING, {cols}")).collect()}
    assert set(out) == {"a", "c"}
    assert (out["a"].name, out["a"].api_key, out["a"].created_at, out["a"].tier) == ("A2", "new", T0, "premium")
    assert (out["c"].name, out["c"].api_key, out["c"].created_at) == ("C2", "kc1", later)


def test_fan_out(spark):
    viewers = spark.createDataFrame([("a", "tenant1"), ("b", "tenant2"), ("c", "all"), ("d", None)], "subscriber_id STRING, tenant_id STRING")
    viewers = subscribers_with_default(viewers)
    rows = spark.createDataFrame([(1, "tenant1"), (2, "tenant2"), (3, ""), (4, "tenant9"), (5, "default"), (6, None), (7, "all")], "arrival_seq BIGINT, tenant_id STRING")
    got = {}
    for r in fan_out(rows, viewers).collect():
        got.setdefault(r.arrival_seq, []).append(r.subscriber_id)
    assert {k: sorted(v) for k, v in got.items()} == {1: ["a", "c"], 2: ["b", "c"], 4: ["c"], 5: ["c", "d"], 7: ["c"]}


def test_large_dimension_is_salted(spark, monkeypatch):
    fact = spark.range(1000).select(F.col("id").alias("arrival_seq"), (F.when(F.col("id") < 900, 1).otherwise(F.col("id"))).alias("k"))
    dim = spark.range(0, 2000, 2).select(F.col("id").alias("k"), (F.col("id") * 10).alias("x")).unionByName(spark.createDataFrame([(1, 7)], "k BIGINT, x BIGINT"))
    for how in ("left", "inner", "left_semi", "left_anti"):
        small = sorted(map(tuple, lookup.join_dimension(fact, dim, "k", how).collect()), key=repr)
        large = lookup.join_dimension(fact, dim, "k", how, max_broadcast_rows=10)
        assert sorted(map(tuple, large.collect()), key=repr) == small
    assert not lookup.is_bounded(dim, 10) and lookup.is_bounded(dim, 1001)


def test_usage(spark):
    rows = [(i, "t", "d", T0 + dt.timedelta(seconds=10 * i), 1.0, 1.0) for i in range(12)]
    df = readings(spark, rows)
    limits = spark.createDataFrame([("t", 11, 4)], "tenant_id STRING, quota_limit INT, rate_limit INT")
    assert [tuple(r)[2:] for r in usage.daily_usage(df, limits).collect()] == [(12, 12, True)]
    assert [(r.messages, r.rate_exceeded) for r in usage.minute_usage(df, limits).orderBy("minute").collect()] == [(6, True), (6, True)]
    over = [r.arrival_seq for r in usage.over_rate_rows(df, limits).filter("over_limit").orderBy("arrival_seq").collect()]
    assert over == [4, 5, 10, 11]


def test_analytics_lists_newest_and_keeps_all_rows(spark):
    rows = [(i, "t", "d", T0, 35.0, 90.0) for i in range(30)]
    df = process.process_readings(readings(spark, rows), schemas.tenant_config(spark))
    result = analytics_result(df, newest=5).first()
    assert [a.arrival_seq for a in result.anomalies] == [29, 28, 27, 26, 25] and result["count"] == 30
    assert tenant_anomalies(df).count() == 30


def test_device_stats_enrichment(spark):
    rows = [(1, "t", "d", T0, 10.0, None), (2, "t", "d", T0, 20.0, 40.0)]
    out = stats.with_device_stats(readings(spark, rows)).orderBy("arrival_seq").collect()
    assert out[0].humidity_stats is None and out[0].temperature_stats.avg == 10.0
    assert out[1].temperature_stats.avg == pytest.approx(15.0) and out[1].humidity_stats.max == 40.0
