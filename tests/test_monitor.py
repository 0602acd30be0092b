import datetime as dt

import pytest
from pyspark.sql import functions as F

from fleetgauge.operators import monitor

SAMPLE = "ts TIMESTAMP, metric STRING, tenant_id STRING, status STRING, pod STRING, le DOUBLE, value DOUBLE"
T0 = dt.datetime(2024, 1, 1)


def test_rate_with_reset(spark):
    rows = [(T0 + dt.timedelta(seconds=s), "m", "t", "ok", "p", None, float(v)) for s, v in ((0, 10), (20, 20), (40, 5), (60, 15))]
    df = spark.createDataFrame(rows, SAMPLE)
    got = monitor.rate(df, ("status",), 120).collect()
    assert [(r.status, r.rate) for r in got] == [("ok", 25 / 120)]
    sliding = monitor.rate(df, (), 120, 60).orderBy("window_start").collect()
    assert [r.rate for r in sliding] == [15 / 120, 25 / 120]


def test_quantile(spark):
    inf = float("inf")
    rows = [("t", 0.1, 50.0), ("t", 0.5, 90.0), ("t", 1.0, 100.0), ("t", inf, 100.0), ("z", 0.1, 0.0), ("z", inf, 0.0), ("o", 0.1, 1.0), ("o", inf, 100.0)]
    df = spark.createDataFrame(rows, "tenant_id STRING, le DOUBLE, value DOUBLE")
    got = {r.tenant_id: r["quantile"] for r in monitor.quantile_of_buckets(df, 0.95, ["tenant_id"]).collect()}
    assert got["t"] == pytest.approx(0.75) and got["z"] is None and got["o"] == 0.1


def test_error_percent(spark):
    rows = []
    for status, total in (("error", 3), ("normal", 7), ("anomaly", 2)):
        rows += [(T0, monitor.MESSAGES, None, status, "p", None, 0.0), (T0 + dt.timedelta(seconds=30), monitor.MESSAGES, None, status, "p", None, float(total))]
    got = monitor.error_percent(spark.createDataFrame(rows, SAMPLE)).first()
    assert got.error_percent == pytest.approx(25.0)
    still = spark.createDataFrame([(T0 + dt.timedelta(seconds=s), monitor.MESSAGES, None, "normal", "p", None, 5.0) for s in (0, 30)], SAMPLE)
    assert monitor.error_percent(still).first().error_percent is None


def test_label_match_is_anchored(spark):
    df = spark.createDataFrame([("processing-engine-1",), ("my-processing-engine",)], "pod STRING")
    assert [r.pod for r in monitor.match_label(df, "pod", "processing-engine.*").collect()] == ["processing-engine-1"]


def test_latest_skips_nulls_and_scales(spark):
    rows = [(T0, "g", "t", None, "p", None, 1048576.0), (T0 + dt.timedelta(seconds=9), "g", "t", None, "p", None, None)]
    got = monitor.scaled(monitor.latest_sum(spark.createDataFrame(rows, SAMPLE), ("pod",)))
    assert [tuple(r) for r in got.collect()] == [("p", 1.0)]
    assert monitor.latest(spark.createDataFrame(rows, SAMPLE)).filter(F.col("value").isNull()).count() == 0


def test_error_percent_by_label(spark):
    rows = []
    for pod, status, total in (("p", "error", 1), ("p", "normal", 3), ("q", "normal", 5)):
        rows += [(T0 + dt.timedelta(seconds=s), monitor.MESSAGES, None, status, pod, None, float(v)) for s, v in ((0, 0), (30, total))]
    got = monitor.error_percent(spark.createDataFrame(rows, SAMPLE), by=("pod",)).collect()
    assert {r.pod: r.error_percent for r in got} == {"p": 25.0, "q": 0.0}


def test_only_named_metrics_are_built(spark):
    rows = [(T0, "t", "normal", 0.2), (T0, "t", "error", 0.4)]
    done = spark.createDataFrame(rows, "timestamp TIMESTAMP, tenant_id STRING, outcome STRING, latency_seconds DOUBLE")
    whole = monitor.metric_samples(done)
    one = monitor.metric_samples(done, metrics=(monitor.MESSAGES,))
    assert sorted(map(tuple, one.collect()), key=repr) == sorted(map(tuple, monitor.select_series(whole, monitor.MESSAGES).collect()), key=repr)
    with pytest.raises(ValueError):
        monitor.metric_samples(done, metrics=("other",))
