"""Streams with their own state: equal to the batch result on any cutting, after restarts, with late rows and repeats."""

import datetime as dt
import math
import random
import time
from fractions import Fraction

import pytest
from pyspark.sql import functions as F

from fleetgauge import schemas
from fleetgauge.operators import exact, fanout, lookup, monitor, stats, tenants
from fleetgauge.sources.keyed import KeyedTable, latest_wins
from fleetgauge.streaming import feeds, state, windows

T0 = dt.datetime(2024, 3, 1, 12, 0)
READING = "arrival_seq BIGINT, tenant_id STRING, device_id STRING, ts TIMESTAMP, temperature DOUBLE, humidity DOUBLE"


def at(seconds):
    return None if seconds is None else T0 + dt.timedelta(seconds=seconds)


def rows_of(df):
    return sorted(map(repr, map(tuple, df.select(*sorted(df.columns)).collect())))


def feed(spark, folder, schema, batches, run):
    """Each batch is one more file; the query is started anew for each."""
    for rows in batches:
        spark.createDataFrame(rows, schema).coalesce(1).write.mode("append").parquet(folder)
        run(spark.readStream.schema(schema).parquet(folder))


WINDOWED = "k STRING, ts TIMESTAMP"
KEYS = {"k": "STRING"}


def counted(spark, tmp_path, batches, delay_s=120):
    path = str(tmp_path / "out")
    feed(spark, str(tmp_path / "in"), WINDOWED, batches, lambda s: windows.start_window_counts(
        s, str(tmp_path / "cp"), path, ("k",), delay_s=delay_s, once=True).awaitTermination())
    return path


def test_window_counts_with_late_rows_and_restarts(spark, tmp_path):
    batches = [
        [("a", at(5)), ("a", at(50)), ("b", at(70)), (None, at(10))],
        [("a", at(400)), ("b", at(400)), ("a", at(59))],  # 59: its window is still open, as only 70 was seen before
        [("a", at(30)), ("a", None), ("b", at(390)), ("b", at(279)), ("c", at(285))],  # before 400 - 120 = 280: windows up to 240 are closed
    ]
    path = counted(spark, tmp_path, batches)
    late = windows.late_rows(spark, path, WINDOWED).collect()
    assert sorted((r.k, r.ts) for r in late if r.ts) == [("a", at(30))] and [r.k for r in late if r.ts is None] == ["a"]
    whole = {}
    for k, ts in (r for b in batches for r in b):
        if ts:
            w = ts.replace(second=0)
            whole[k, w] = whole.get((k, w), 0) + 1
    got = {(r.k, r.window_start): r.messages for r in windows.window_counts(spark, path, KEYS).collect()}
    assert got == whole
    final = {(r.k, r.window_start): r.messages for r in windows.window_counts(spark, path, KEYS, late=False, open_windows=False).collect()}
    assert final == {("a", at(0)): 3, ("b", at(60)): 1, (None, at(0)): 1}


def test_closed_windows_are_those_of_the_engine(spark, tmp_path):
    rng = random.Random(5)
    batches = [[(rng.choice("ab"), at(600 * i + rng.randint(-500, 600))) for _ in range(40)] for i in range(4)]
    path = counted(spark, tmp_path, batches, 200)
    feed(spark, str(tmp_path / "in2"), WINDOWED, batches, lambda s: windows.windowed(s, ("k",), "ts", "60 seconds", "200 seconds").writeStream.option(
        "checkpointLocation", str(tmp_path / "cp2")).outputMode("append").format("parquet").option("path", str(tmp_path / "native")).trigger(availableNow=True).start().awaitTermination())
    ours = windows.window_counts(spark, path, KEYS, late=False, open_windows=False)
    assert rows_of(ours) == rows_of(spark.read.parquet(str(tmp_path / "native"))) and ours.count() > 20
    assert windows.late_rows(spark, path, WINDOWED).count() > 5


def test_a_repeated_window_batch_changes_nothing(spark, tmp_path):
    path = counted(spark, tmp_path, [[("a", at(5))], [("a", at(500))]])
    before = rows_of(windows.window_counts(spark, path, KEYS))
    for name in ("1", ".1.crc"):
        (tmp_path / "cp" / "commits" / name).unlink(missing_ok=True)
    stream = spark.readStream.schema(WINDOWED).parquet(str(tmp_path / "in"))
    windows.start_window_counts(stream, str(tmp_path / "cp"), path, ("k",), delay_s=120, once=True).awaitTermination()
    assert rows_of(windows.window_counts(spark, path, KEYS)) == before


def test_expiring_device_windows(spark, tmp_path):
    cp = str(tmp_path / "cp")

    def run(stream, idle_ms=None):
        state.start_windows(state.device_windows(stream, n=4, parts=2, idle_ms=idle_ms), cp, once=True).awaitTermination()

    rows = [(i, f"t{i % 2}" if i % 9 else None, f"d{i % 3}", at(i) if i % 5 else None, float(i), None if i % 4 else float(i)) for i in range(90)]
    feed(spark, str(tmp_path / "in"), READING, [rows[60:], rows[:30], rows[30:60] + rows[:5]], run)
    got = state.merge_device_state(state.device_windows_now(spark, cp), n=4)
    want = stats.device_window_stats(spark.createDataFrame(rows, READING), n=4)
    columns = ["tenant_id", "device_id", "metric", "count", "min", "max", "avg", "readings"]
    assert rows_of(got.select(*columns)) == rows_of(want.select(*columns))
    assert spark.conf.get("spark.sql.streaming.noDataMicroBatches.enabled") == "true"


def test_idle_devices_are_forgotten_in_a_run_that_ends(spark, tmp_path):
    cp = str(tmp_path / "cp")

    def run(stream):
        state.start_windows(state.device_windows(stream, n=4, parts=1, idle_ms=3000), cp, once=True).awaitTermination()
        time.sleep(3.5)

    feed(spark, str(tmp_path / "in"), READING, [[(1, "t", "old", at(0), 1.0, None)], [(2, "t", "new", at(1), 2.0, None)]], run)
    assert state.device_windows_now(spark, cp).count() == 0
    spark.createDataFrame([(3, "t", "old", at(2), 3.0, None)], READING).write.mode("append").parquet(str(tmp_path / "in"))
    state.start_windows(state.device_windows(spark.readStream.schema(READING).parquet(str(tmp_path / "in")), n=4, parts=1, idle_ms=60_000), cp, once=True).awaitTermination()
    now = state.merge_device_state(state.device_windows_now(spark, cp), n=4).collect()
    assert [(r.device_id, r.readings) for r in now] == [("old", [3.0])]


@pytest.mark.parametrize("max_rows", [10, 1_000_000])
def test_rolling_windows_across_micro_batches(spark, tmp_path, max_rows):
    rows = [(i, None if i % 11 == 0 else "t", f"d{(i * i) % 3}" if i % 4 else "busy", at(i), float(i % 17), None if i % 3 else i / 2) for i in range(240)]
    table, path = feeds.rolling_table(spark, str(tmp_path / "state"), buckets=4), str(tmp_path / "out")
    feed(spark, str(tmp_path / "in"), READING, [rows[:10], rows[10:150], rows[150:151], rows[151:]], lambda s: feeds.start_device_rolling(
        s, str(tmp_path / "cp"), table, path, n=7, once=True, max_rows=max_rows).awaitTermination())
    want = stats.device_rolling(spark.createDataFrame(rows, READING), n=7)
    assert rows_of(spark.read.parquet(path).select(*want.columns)) == rows_of(want)
    assert table.read().count() <= 6 * 2 * 6


SAMPLES = schemas.METRIC_SAMPLES


def counters():
    rows = []
    for pod, resets in (("p0", ()), ("p1", (7, 20)), (None, (13,))):
        value = 0.0
        for i in range(30):
            value = 0.5 if i in resets else value + (i * 7) % 5
            rows.append((at(i * 23), "m", "t", None, "job", pod, None, value))
    return sorted(rows, key=lambda r: (r[0], r[5] or ""))


@pytest.mark.parametrize(("range_s", "step_s", "cuts"), [(60, None, [0, 90]), (60, None, [0, 1, 30, 31, 90]), (120, 40, [0, 45, 90])])
def test_counter_growth_on_any_split_in_time(spark, tmp_path, range_s, step_s, cuts):
    rows = counters()
    table, path = feeds.samples_table(spark, str(tmp_path / "state"), buckets=2), str(tmp_path / "out")
    feed(spark, str(tmp_path / "in"), SAMPLES, [rows[a:b] for a, b in zip(cuts, cuts[1:])], lambda s: feeds.start_counter_growth(
        s, str(tmp_path / "cp"), table, path, range_s, step_s, once=True).awaitTermination())
    want = monitor.rate(spark.createDataFrame(rows, SAMPLES), ("pod",), range_s, step_s)
    assert rows_of(feeds.rate(spark, path, ("pod",), range_s)) == rows_of(want)


def test_late_samples_are_kept_aside(spark, tmp_path):
    rows = counters()
    table, path = feeds.samples_table(spark, str(tmp_path / "state")), str(tmp_path / "out")
    feed(spark, str(tmp_path / "in"), SAMPLES, [rows[:60], rows[30:33], rows[60:]], lambda s: feeds.start_counter_growth(
        s, str(tmp_path / "cp"), table, path, once=True).awaitTermination())
    assert spark.read.parquet(f"{path}/late").count() == 3
    assert rows_of(feeds.rate(spark, path, ("pod",))) == rows_of(monitor.rate(spark.createDataFrame(rows, SAMPLES), ("pod",)))


def test_tenant_changes_in_any_order(spark, tmp_path):
    rng = random.Random(2)
    schema = f"{schemas.TENANTS}, change_seq BIGINT, op STRING"
    changes = [(f"t{rng.randint(0, 7)}", f"n{i}", rng.choice(["", f"k{i}", None]), "free", bool(i % 2), at(i), i, i, i / 2, i, i, rng.choice(["create", "update", "update", "delete"]))
               for i in range(120)]
    current = spark.createDataFrame([(f"t{i}", "old", f"key{i}", "free", True, T0, 1, 1, 1.0, 1) for i in range(4)], schemas.TENANTS)
    cut = changes[:]
    rng.shuffle(cut)
    table = feeds.tenant_changes_table(spark, str(tmp_path / "state"), buckets=4)
    feed(spark, str(tmp_path / "in"), schema, [cut[:50], cut[50:53], cut[30:120]], lambda s: feeds.start_tenant_changes(
        s, str(tmp_path / "cp"), table, once=True).awaitTermination())
    want = tenants.apply_changes(current, spark.createDataFrame(changes, schema))
    assert rows_of(feeds.tenants_now(current, table)) == rows_of(want)


def test_an_upsert_writes_only_the_buckets_it_touches(spark, tmp_path):
    table = KeyedTable(spark, str(tmp_path / "k"), "id STRING, seq BIGINT", ("id",), 8)
    merge = latest_wins(("id",), "seq")

    def put(rows, batch):
        return table.upsert(spark.createDataFrame(rows, table.schema), batch, merge)

    assert put([(f"k{i}", 1) for i in range(40)] + [(None, 1)], 0)
    segments = {r.bucket: r.segment for r in table.versions.rows(table.versions.newest()).collect()}
    assert put([("k3", 0), ("k3", 5), (None, 2)], 1) and not put([("k4", 9)], 1)
    after = {r.bucket: r.segment for r in table.versions.rows(table.versions.newest()).collect()}
    assert 1 <= sum(segments[b] != after[b] for b in segments) <= 2 and set(segments) == set(after)
    got = {r.id: r.seq for r in table.read().collect()}
    assert got == {**{f"k{i}": 1 for i in range(40)}, "k3": 5, None: 2}
    assert put([], 2) and table.read().count() == 41
    assert table.upsert(spark.createDataFrame([("k3", 1)], table.schema), 3, lambda old, new: old.limit(0)) and table.read().count() < 41


def test_sessions_that_come_and_go(spark):
    rng = random.Random(3)
    sessions = []
    for i in range(60):
        start = rng.randint(-4000, 4000)
        length = rng.choice([0, 1, 59, 60, 61, 119, 3600, 100_000, None])
        sessions.append((f"s{i}", rng.choice(["a", "b", "all"]), at(start), None if length is None else at(start + length)))
    sessions += [("s0", "a", at(0), at(100)), ("bad", "a", at(10), at(5)), ("no start", "a", None, at(5)), ("none", None, at(0), None)]
    rows = [(i, rng.choice(["a", "b", "c", "", "all", None]), at(rng.randint(-6000, 6000))) for i in range(150)] + [(200, "a", None)]
    # Times at the very edges of sessions.
    rows += [(300 + i, "a", s[2]) for i, s in enumerate(sessions[:30])] + [(400 + i, "a", s[3]) for i, s in enumerate(sessions[:30])]
    want = sorted((s[0], i) for i, tenant, ts in rows for s in sessions
                  if tenant and ts and s[2] and s[1] in (tenant, "all") and s[2] <= ts and (s[3] is None or ts < s[3]))
    got = fanout.fan_out_live(
        spark.createDataFrame(rows, "i BIGINT, tenant_id STRING, ts TIMESTAMP"),
        spark.createDataFrame(sessions, "subscriber_id STRING, tenant_id STRING, since TIMESTAMP, until TIMESTAMP"),
    )
    assert sorted((r.subscriber_id, r.i) for r in got.collect()) == want and len(want) > 500
    none = spark.createDataFrame([], "subscriber_id STRING, tenant_id STRING, since TIMESTAMP, until TIMESTAMP")
    assert fanout.fan_out_live(spark.createDataFrame(rows, "i BIGINT, tenant_id STRING, ts TIMESTAMP"), none).count() == 0


NASTY = [0.1, -0.1, 1e308, -1e308, 1e308, 5e-324, 2.0**-1022, 1.5, -0.0, 2.0**24, 2.0**48 - 1, 1 / 3, -1e16, 1.0, 1e16, 2.0**-24, 123456.789e-30, math.pi * 1e100]


def test_limbs_make_up_every_value(spark):
    rng = random.Random(8)
    values = NASTY + [rng.uniform(-1, 1) * 2.0 ** rng.randint(-1070, 1023) for _ in range(500)] + [2.0**k for k in range(-1074, 1024, 7)]
    rows = spark.createDataFrame([(v,) for v in values], "v DOUBLE").select("v", exact.limbs(F.col("v")).alias("l")).collect()
    for r in rows:
        assert sum(Fraction(x.limb) * Fraction(2) ** (exact.LIMB_BITS * x.grid) for x in r.l) == Fraction(r.v)
        assert all(abs(x.limb) < 1 << exact.LIMB_BITS for x in r.l)


def test_exact_sums_on_any_partitioning(spark):
    rng = random.Random(9)
    rows = [(f"g{i % 3}" if i % 5 else None, rng.uniform(-1e6, 1e6) * 10.0 ** rng.randint(-12, 12), rng.choice([None, 0.1, -0.3])) for i in range(3000)]
    rows += [("cancel", v, None) for v in NASTY] + [("nan", math.nan, math.inf), ("inf", math.inf, -math.inf), ("inf", 1.0, math.inf), ("big", 1e308, 1.0), ("big", 1e308, 2.0)]
    df = spark.createDataFrame(rows, "g STRING, a DOUBLE, b DOUBLE")
    results = [rows_of(exact.exact_stats(df.repartition(n), ["g"], ["a", "b"])) for n in (1, 4, 32)]
    assert results[0] == results[1] == results[2]
    got = {(r.g, r.name): r for r in exact.exact_stats(df, ["g"], ["a", "b"]).collect()}
    for g in {r[0] for r in rows if r[0] not in ("nan", "inf", "big")}:
        for j, name in ((1, "a"), (2, "b")):
            own = [r[j] for r in rows if r[0] == g and r[j] is not None]
            r = got[g, name]
            assert r["count"] == len(own)
            if own:
                total = sum(map(Fraction, own), Fraction(0))
                assert r["sum"] == float(total) and r["mean"] == float(total / len(own)) and r["min"] == min(own)
            else:
                assert r["sum"] is None and r["mean"] is None
    assert got["big", "a"]["sum"] == math.inf and got["big", "a"]["mean"] == 1e308
    assert got["inf", "a"]["sum"] == math.inf and math.isnan(got["inf", "b"]["sum"]) and math.isnan(got["nan", "a"]["sum"])


def test_limb_sums_merge(spark):
    df = spark.range(1000).select((F.col("id") % 3).alias("g"), (F.col("id") * 0.1).alias("a"))
    parts = exact.merge_limbs(exact.limb_sums(df.filter("id < 321"), ["g"], ["a"]), exact.limb_sums(df.filter("id >= 321"), ["g"], ["a"]))
    assert rows_of(parts) == rows_of(exact.limb_sums(df, ["g"], ["a"]))


def test_wide_dimensions_are_not_broadcast(spark):
    wide = spark.range(100).select(F.col("id").alias("k"), F.repeat(F.lit("x"), 1000).alias("v"))
    assert lookup.is_bounded(wide) and not lookup.is_bounded(wide, max_bytes=50_000) and not lookup.is_bounded(wide, max_rows=99)
    plan = lookup.join_dimension(spark.range(5).select(F.col("id").alias("k")), wide, "k")
    assert plan.count() == 5
