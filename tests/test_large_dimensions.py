"""Queries whose tenants or sessions are too many for a broadcast: the same rows, and nothing collected on the driver."""

import datetime as dt

import pytest
from pyspark.sql import functions as F

from compare import connect, difference
from fleetgauge.operators import fanout, lookup
from fleetgauge.plans.catalog import ORACLE, QUERIES

T0 = dt.datetime(2024, 1, 15)
NAMES = [
    "daily_quota",
    "rows_of_known_tenants",
    "rows_over_rate_limit",
    "stream_daily_quota",
    "known_key_requests",
    "rate_limit_minutes",
    "stream_minute_usage",
    "tenant_quota",
    "unknown_key_requests",
    "fanout_sessions",
]


@pytest.fixture(scope="module")
def tables(spark, tmp_path_factory):
    path = tmp_path_factory.mktemp("tables")
    customers = [(i, f"c{i}", i % 3, 10.0 * (i - 5), "BUILDING") for i in range(60)]
    kinds = ("view", "click", "signup", "error")
    events = [(i, T0 + dt.timedelta(seconds=7 * i), (0 if i % 2 else i) % 90, kinds[i % 4], 20.0 + i % 50, f'{{"k": {i % 100}}}') for i in range(400)]
    spark.createDataFrame(customers, "c_custkey BIGINT, c_name STRING, c_nationkey INT, c_acctbal DOUBLE, c_mktsegment STRING").coalesce(
        1).write.parquet(f"{path}/customer.parquet")
    spark.createDataFrame(events, "event_id BIGINT, ts TIMESTAMP_NTZ, user_id BIGINT, event_type STRING, value DOUBLE, props STRING").coalesce(
        1).write.parquet(f"{path}/events.parquet")
    spark.range(600).selectExpr("id AS o_orderkey", "id % 60 AS o_custkey").coalesce(1).write.parquet(f"{path}/orders.parquet")
    con = connect(str(path.parent / "none"))
    for name in ("customer", "events", "orders"):
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM read_parquet('{path}/{name}.parquet/*.parquet')")
    return str(path), con


@pytest.mark.parametrize("name", NAMES)
def test_large_dimension_is_not_collected(spark, tables, monkeypatch, name):
    path, con = tables
    monkeypatch.setattr(lookup, "is_bounded", lambda *_: False)
    df = QUERIES[name](spark, path)
    assert "Broadcast" not in df._jdf.queryExecution().executedPlan().toString()
    assert difference(df, con, ORACLE[name]) is None


def test_sessions_are_repeated_only_where_bins_are_few(spark, monkeypatch):
    def at(minutes):
        return T0 + dt.timedelta(minutes=minutes)

    sessions = [(f"s{i}", "ab"[i % 2], at(50 * i), at(50 * i + 40)) for i in range(200)]
    sessions += [(f"e{i}", "a", at(i), None) for i in range(3)] + [(f"x{i}", "all", at(10 * i), at(10 * i + 5)) for i in range(4)]
    rows = [(i, "abc"[i % 3], at(31 * i)) for i in range(300)]
    want = sorted((s, i) for i, tenant, ts in rows for s, of, since, until in sessions
                  if of in (tenant, "all") and since <= ts and (until is None or ts < until))
    joined = []

    def salted(df, dim, on, how, **options):
        joined.append((df, dim, options.get("salts", F.lit(lookup.SALTS))))
        return lookup.join_dimension(df, dim, on, how, max_broadcast_rows=0, **options)

    monkeypatch.setattr(fanout, "join_dimension", salted)
    got = fanout.fan_out_live(
        spark.createDataFrame(rows, "i BIGINT, tenant_id STRING, ts TIMESTAMP"),
        spark.createDataFrame(sessions, "subscriber_id STRING, tenant_id STRING, since TIMESTAMP, until TIMESTAMP"),
    )
    assert sorted((r.subscriber_id, r.i) for r in got.collect()) == want and len(want) > 300
    offered, filed, salts = joined[0]
    assert filed.agg(F.sum(salts)).first()[0] <= 2 * 200 + lookup.SALTS * (3 + 2 * 4)
    # A row asks for two lengths of its own tenant's sessions and for one of those for all.
    assert offered.count() == 3 * 300
