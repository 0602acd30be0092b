"""The chunked form of ordered operators gives what one window over the whole group gives."""

import random

import pytest
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from fleetgauge.operators import ordered, recent, stats


@pytest.fixture(scope="module")
def skewed(spark):
    """One group with most rows, gaps and bursts in the arrival numbers, null values and a null key."""
    rng = random.Random(7)
    rows, seq = [], 0
    for i in range(3000):
        seq += rng.choice([1, 1, 1, 2, 500 if i % 400 == 0 else 1])
        key = rng.choice(["hot", "hot", "hot", "warm", None, f"cold{rng.randrange(30)}"])
        value = None if rng.random() < 0.1 else float(rng.randrange(1000)) / 4
        rows.append((seq, key, value, rng.randrange(100_000)))
    return spark.createDataFrame(rows, "seq BIGINT, k STRING, v DOUBLE, t BIGINT").repartition(7).cache()


def same(a, b):
    assert sorted(map(tuple, a.collect()), key=repr) == sorted(map(tuple, b.collect()), key=repr)


@pytest.mark.parametrize("max_rows", [10, 64, 500])
@pytest.mark.parametrize("keys", [["k"], []])
def test_running(skewed, keys, max_rows):
    aggs = {"s": ("sum", "v"), "n": ("count", "v"), "hi": ("max", "t"), "lo": ("min", "t")}
    for current in (True, False):
        whole = ordered.running(skewed, keys, "seq", aggs, current)
        cut = ordered.running(skewed, keys, "seq", aggs, current, max_rows)
        same(cut, whole)


@pytest.mark.parametrize("max_rows", [10, 37, 600])
@pytest.mark.parametrize("keys", [["k"], []])
def test_rolling(skewed, keys, max_rows):
    aggs = {"n": F.count("v"), "s": F.sum("v"), "lo": F.min("v"), "first": F.first("seq")}
    window = Window.partitionBy(*keys).orderBy("seq").rowsBetween(-9, 0)
    expected = skewed.select("*", *[a.over(window).alias(n) for n, a in aggs.items()])
    same(ordered.rolling_rows(skewed, keys, "seq", 10, aggs, max_rows), expected)


def test_chunks_are_bounded(skewed):
    _, hot = ordered.split_hot(skewed, ["k"], "seq", 100)
    assert hot.groupBy("k", "_chunk").count().agg(F.max("count")).first()[0] <= 100
    assert hot.select("k").distinct().count() == 3  # hot, warm and the null key


def test_many_hot_groups_join_without_a_list(skewed, monkeypatch):
    whole = ordered.running(skewed, ["k"], "seq", {"s": ("sum", "v")})
    monkeypatch.setattr(ordered, "MAX_LISTED_GROUPS", 1)
    same(ordered.running(skewed, ["k"], "seq", {"s": ("sum", "v")}, max_rows=40), whole)


def test_frame_must_fit_a_chunk(skewed):
    with pytest.raises(ValueError):
        ordered.rolling_rows(skewed, ["k"], "seq", 100, {"n": F.count("v")}, 10)


def test_first_rows_in_parts(skewed):
    plain = ordered.first_rows(skewed, ["k"], [F.desc("seq")], 15)
    same(ordered.first_rows(skewed, ["k"], [F.desc("seq")], 15, 8, "seq"), plain)
    assert plain.groupBy("k").count().agg(F.max("count")).first()[0] == 15


def test_group_limit_before_the_shuffle(skewed):
    plan = ordered.first_rows(skewed, ["k"], [F.desc("seq")], 15)._jdf.queryExecution().executedPlan().toString()
    assert plan.index("row_number(), 15, Final") < plan.index("Exchange") < plan.index("row_number(), 15, Partial")


def test_dashboard_operators_in_chunks(spark, skewed):
    df = skewed.select(
        F.col("seq").alias("arrival_seq"), F.coalesce("k", F.lit("none")).alias("tenant_id"), F.lit("d").alias("device_id"),
        F.timestamp_seconds(F.col("t")).alias("ts"), F.col("v").alias("temperature"), (F.col("v") / 2).alias("humidity"),
    )
    same(recent.newer_only(df, max_rows=25), recent.newer_only(df))
    same(recent.running_average(df, max_rows=25), recent.running_average(df))
    same(stats.device_rolling(df, n=12, max_rows=25), stats.device_rolling(df, n=12))
