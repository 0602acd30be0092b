"""The versioned store: all of a change or nothing, replays, compaction, retention, pages and device lookups."""

import datetime as dt

import pytest
from pyspark.sql import functions as F

from fleetgauge import schemas
from fleetgauge.operators import recent, retention
from fleetgauge.sources.store import Store
from fleetgauge.sources.versions import Conflict, Folder

T0 = dt.datetime(2024, 3, 1, 12, 0)


def readings(spark, start, stop, days=6, tenants=3, devices=40):
    """Rows spread over days and tenants; event times lie up to 3 hours before the creation time, some are equal."""
    r = spark.range(start, stop, 1, 2).withColumnRenamed("id", "row_key")
    created = F.lit(T0).cast("timestamp") + F.make_dt_interval(F.pmod("row_key", F.lit(days)).cast("int"), F.lit(0), F.pmod(F.col("row_key") * 7, F.lit(600)).cast("int"))
    tenant = F.concat(F.lit("t"), F.pmod("row_key", F.lit(tenants)).cast("string"))
    return r.select(
        "row_key", F.concat(F.lit("d"), F.pmod(F.xxhash64("row_key"), F.lit(devices)).cast("string")).alias("device_id"),
        F.lit(1.5).alias("temperature"), F.lit(None).cast("double").alias("humidity"),
        (created - F.make_dt_interval(mins=F.pmod(F.col("row_key") * 13, F.lit(180)).cast("int"))).alias("timestamp"),
        F.lit(False).alias("is_anomaly"), F.lit(0.0).alias("anomaly_score"), created.alias("created_at"),
        F.when(F.col("row_key") % 50 != 49, tenant).alias("tenant_id"), F.to_date(created).alias("created_date"),
    )


def rows_of(df):
    return sorted(map(repr, map(tuple, df.select(*sorted(df.columns)).collect())))


def filled(spark, path, batches=4, size=300):
    store = Store(spark, str(path))
    for i in range(batches):
        assert store.append(readings(spark, i * size, (i + 1) * size), i)
    return store, readings(spark, 0, batches * size)


def test_appends_and_replays(spark, tmp_path):
    store, whole = filled(spark, tmp_path / "s", 3)
    assert rows_of(store.read()) == rows_of(whole)
    assert not store.append(readings(spark, 300, 600), 1) and not store.append(readings(spark, 0, 5), 2)
    assert store.append(readings(spark, 900, 910), 0, writer="other")
    assert store.append(readings(spark, 890, 920), 1, writer="other", only_new=True)
    assert store.append(readings(spark, 920, 920), 2, writer="other")
    again = readings(spark, 920, 925)
    assert store.append(again.unionAll(again), 3, writer="other")
    assert rows_of(store.read()) == rows_of(readings(spark, 0, 925))
    assert rows_of(store.read(tenant_id="t1")) == rows_of(readings(spark, 0, 925).filter("tenant_id = 't1'"))


def test_an_empty_store(spark, tmp_path):
    store = Store(spark, str(tmp_path / "s"))
    assert store.read().count() == store.page("t0").count() == store.device_page("t0", "d").count() == 0
    assert store.compact(dt.date(2030, 1, 1)) == 0 and store.vacuum() == 0
    assert store.retain(schemas.retention_policies(spark), T0).count() == 0


def test_compaction_keeps_rows_and_ignores_replays(spark, tmp_path):
    store, whole = filled(spark, tmp_path / "s")
    before, day = store.leaves().count(), (T0 + dt.timedelta(days=3)).date()
    closed = store.leaves().filter(F.col("created_date") < F.lit(day)).count()
    assert store.compact(day, file_rows=150) == closed
    assert rows_of(store.read()) == rows_of(whole)
    assert store.leaves().count() == before - closed + closed // 4
    assert not store.append(readings(spark, 900, 1200), 3) and rows_of(store.read()) == rows_of(whole)
    assert store.compact(day) == 0
    assert store.append(readings(spark, 5000, 5001), 4) and store.compact(dt.date(2030, 1, 1)) > 0
    assert rows_of(store.read()) == rows_of(whole.unionAll(readings(spark, 5000, 5001)))
    assert store.leaves().filter("NOT compacted").count() == 0


def test_compacted_files_come_near_the_target(spark, tmp_path):
    store = Store(spark, str(tmp_path / "s"))
    for i in range(8):
        store.append(readings(spark, i * 500, (i + 1) * 500, days=1, tenants=1), i)
    store.compact(dt.date(2030, 1, 1), file_rows=1000)
    segment = store.leaves().filter("tenant_id = 't0'").first().segment
    rows = spark.read.parquet(f"{tmp_path}/s/data/segment={segment}").filter("tenant_id = 't0'")
    sizes = [r["n"] for r in rows.groupBy(F.input_file_name().alias("f")).agg(F.count(F.lit(1)).alias("n")).collect()]
    assert 3 <= len(sizes) <= 6 and max(sizes) <= 2000 and sum(sizes) == 3920


@pytest.mark.parametrize("as_of", [dt.datetime(2024, 4, 1, 12, 5), dt.datetime(2024, 4, 2), dt.datetime(2023, 1, 1), dt.datetime(2030, 1, 1)])
def test_retention_in_one_step(spark, tmp_path, as_of):
    store, whole = filled(spark, tmp_path / "s")
    store.compact((T0 + dt.timedelta(days=2)).date())
    policies = schemas.retention_policies(spark, [("t0", 30), ("t1", 28), ("absent", 1)])
    seen = []
    deleted = store.retain(policies, as_of, 31, before_publish=lambda: seen.append(rows_of(store.read())))
    now = F.lit(as_of).cast("timestamp")
    assert rows_of(store.read()) == rows_of(retention.survivors(whole, policies, now, 31))
    assert rows_of(deleted) == rows_of(retention.deleted_counts(whole, policies, now, 31))
    assert all(s == rows_of(whole) for s in seen) and bool(seen) == (as_of.year > 2023)
    assert store.retain(policies, as_of, 31).count() == 0


def test_a_reader_keeps_its_version(spark, tmp_path):
    store, whole = filled(spark, tmp_path / "s", 2)
    version = store.versions.newest()
    store.compact(dt.date(2030, 1, 1))
    store.retain(schemas.retention_policies(spark), dt.datetime(2030, 1, 1))
    assert rows_of(store.read(version)) == rows_of(whole) and store.read().count() == 0


def test_writers_that_meet(spark, tmp_path):
    store, whole = filled(spark, tmp_path / "s", 2)
    late = []

    def meanwhile():
        if not late:
            late.append(store.append(readings(spark, 600, 700), 2))

    assert store.compact(dt.date(2030, 1, 1), before_publish=meanwhile) > 0 and late == [True]
    assert rows_of(store.read()) == rows_of(readings(spark, 0, 700))
    store.append(readings(spark, 700, 800), 3)
    expired = []

    def emptied():
        if not expired:
            expired.append(store.retain(schemas.retention_policies(spark), dt.datetime(2030, 1, 1)).count())

    with pytest.raises(Conflict):
        store.compact(dt.date(2030, 1, 1), before_publish=emptied)
    assert store.read().count() == 0


def test_a_taken_name_is_not_published(spark, tmp_path):
    folder = Folder(spark, str(tmp_path))
    assert folder.publish("v1", "a") and not folder.publish("v1", "b")
    assert folder.read("v1") == "a" and [n for n in folder.names() if not n.startswith(".")] == ["v1"]


def test_vacuum_removes_only_what_no_version_names(spark, tmp_path):
    store, whole = filled(spark, tmp_path / "s", 3)
    store.compact(dt.date(2030, 1, 1))
    assert store.vacuum(keep=2, min_age_s=0) == 0
    assert store.vacuum(keep=1) == 0
    assert store.vacuum(keep=1, min_age_s=0) == 3
    assert rows_of(store.read()) == rows_of(whole) and not store.append(readings(spark, 0, 9), 2)
    names = [n for n in Folder(spark, f"{tmp_path}/s/_versions").names() if not n.startswith(".")]
    assert len(names) == 2


@pytest.mark.parametrize("compacted", [False, True])
def test_every_page_by_seeking(spark, tmp_path, compacted):
    store, whole = filled(spark, tmp_path / "s", 3)
    if compacted:
        store.compact(dt.date(2030, 1, 1))
    size, after, pages = 70, None, 0
    while True:
        got = store.page("t1", size, after).collect()
        want = recent.tenant_page(whole, "t1", size, pages * size).collect()
        assert [r.row_key for r in got] == [r.row_key for r in want]
        if not got:
            break
        after, pages = (got[-1].timestamp, got[-1].row_key), pages + 1
    assert pages == -(-whole.filter("tenant_id = 't1'").count() // size)


def test_a_deep_page_reads_only_the_days_it_needs(spark, tmp_path):
    store = Store(spark, str(tmp_path / "s"))
    for i in range(3):
        store.append(readings(spark, i * 2000, (i + 1) * 2000, days=40), i)
    store.compact(dt.date(2030, 1, 1))
    after = (T0 + dt.timedelta(days=20), 0)
    days = [r.created_date for r in store.leaves_of_page("t1", 60, after).collect()]
    assert len(days) <= 4 and all(abs((d - after[0].date()).days) <= 3 for d in days)
    assert store.leaves_of_page("t1", 60).count() <= 3
    plan = store.page("t1", 60, after)._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(tenant_id" in plan


def scanned(df):
    """Rows that the scans of the stored data gave out, after row groups and pages were skipped."""
    df.collect()
    plan = df._jdf.queryExecution().executedPlan()
    plan = plan.finalPhysicalPlan() if plan.getClass().getSimpleName() == "AdaptiveSparkPlanExec" else plan
    todo, total = [plan], 0
    while todo:
        node = todo.pop()
        name = node.getClass().getSimpleName()
        if name == "FileSourceScanExec" and "device_id" in node.toString():
            total += node.metrics().apply("numOutputRows").value()
        inner = [node.plan()] if name.endswith("QueryStageExec") else [node.child()] if name == "ReusedExchangeExec" else []
        children = node.children()
        todo += inner + [children.apply(i) for i in range(children.size())]
    return total


def test_a_device_is_found_in_few_row_groups(spark, tmp_path):
    store = Store(spark, str(tmp_path / "s"))
    for i in range(4):
        store.append(readings(spark, i * 5000, (i + 1) * 5000, days=2, tenants=1, devices=500), i)
    whole = readings(spark, 0, 20_000, days=2, tenants=1, devices=500)
    assert scanned(store.device_page("t0", "d77")) >= 15_000
    store.compact(dt.date(2030, 1, 1), row_group_rows=500)
    page = store.device_page("t0", "d77")
    assert [r.row_key for r in page.collect()] == [r.row_key for r in recent.device_page(whole, "t0", "d77").collect()]
    assert 0 < scanned(page) <= 0.12 * 20_000
    assert scanned(store.device_page("t0", "nobody")) <= 0.05 * 20_000
