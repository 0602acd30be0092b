"""The stored readings under one list of live leaves: appends, compaction, retention and paged reads.

A leaf is the rows of one tenant and creation day that one write made: a folder
``data/segment=<write>/tenant_id=<tenant>/created_date=<day>``. The list of live leaves, with their row counts and the range of
their times, is the table's version (see ``versions``). A write makes a new segment and then switches the list, so readers see
all of a change or nothing, and a change that stops half-way leaves only a segment that nothing names.

* A batch that its writer has committed before adds nothing, also after its leaves were compacted.
* ``compact`` joins the leaves of closed days in files of about ``file_rows`` rows, sorted by device with a Bloom filter, so a
  device is found in few row groups. Small days share a task, large ones are cut by device and time.
* ``retain`` drops leaves by their times without reading them; only leaves that hold a cutoff are written anew.
* ``page`` seeks by (time, key): the list tells which leaves can hold the page, and no other is read.

The list holds one row for each leaf and is rewritten by every change, so compact often enough that it stays small; the names of
its live segments pass the driver, as the names of their files do in any read.
"""

from __future__ import annotations

import datetime as dt
import uuid

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from fleetgauge import schemas
from fleetgauge.operators import retention
from fleetgauge.operators.lookup import join_dimension
from fleetgauge.operators.recent import device_page, tenant_page
from fleetgauge.sources.table import first_per_key
from fleetgauge.sources.versions import Conflict, Version, Versions, vacuum

LEAVES = (
    "segment STRING, tenant_id STRING, created_date DATE, rows BIGINT, first_ts TIMESTAMP, last_ts TIMESTAMP, "
    "first_created TIMESTAMP, last_created TIMESTAMP, compacted BOOLEAN"
)
KEY = ("segment", "tenant_id", "created_date")
FILE_ROWS = 1_000_000
ROW_GROUP_ROWS = 50_000
DEVICES_PER_FILE = 20_000
#: Segments and lists younger than this are never removed: their writer may not have published them yet.
MIN_AGE_S = 24 * 3600.0


def _same(left: DataFrame, right: DataFrame, keys: tuple[str, ...] = KEY) -> Column:
    match = left[keys[0]].eqNullSafe(right[keys[0]]) if keys[0] != "segment" else left["segment"] == right["segment"]
    for k in keys[1:]:
        match = match & left[k].eqNullSafe(right[k])
    return match


class Store:
    """The readings stored below ``path``."""

    def __init__(self, spark: SparkSession, path: str):
        self.spark, self.path = spark, path.rstrip("/")
        self.versions = Versions(spark, self.path, LEAVES)

    # Reading

    def leaves(self, version: Version | None = None) -> DataFrame:
        return self.versions.rows(version or self.versions.newest())

    def read(self, version: Version | None = None, tenant_id: str | None = None, leaves: DataFrame | None = None) -> DataFrame:
        """The rows of a version, of one tenant or of given leaves; filters select folders and reach the Parquet scan."""
        leaves = self.leaves(version) if leaves is None else leaves
        if tenant_id is not None:
            leaves = leaves.filter(F.col("tenant_id") == tenant_id)
        rows = self._rows_of(leaves).drop("segment")
        return rows if tenant_id is None else rows.filter(F.col("tenant_id") == tenant_id)

    def _rows_of(self, leaves: DataFrame) -> DataFrame:
        """Rows of the leaves, with their segment."""
        names = [r["segment"] for r in leaves.select("segment").distinct().collect()]
        schema = f"{schemas.SENSOR_DATA}, segment STRING"
        if not names:
            return self.spark.createDataFrame([], schema)
        data = f"{self.path}/data"
        rows = self.spark.read.schema(schema).option("basePath", data).parquet(*[f"{data}/segment={n}" for n in names])
        return rows.join(leaves.select(*KEY), _same(rows, leaves), "left_semi")

    def page(
        self, tenant_id: str, limit: int = schemas.PAGE_ROWS, after: tuple[dt.datetime, int] | None = None,
        version: Version | None = None,
    ) -> DataFrame:
        """The tenant's newest rows, or those that follow ``after`` (timestamp and row_key of the last row of a page)."""
        limit = limit if limit > 0 else schemas.PAGE_ROWS
        rows = self.read(leaves=self.leaves_of_page(tenant_id, limit, after, version), tenant_id=tenant_id)
        if after is not None:
            ts, key = F.lit(after[0]).cast("timestamp"), F.lit(after[1])
            rows = rows.filter((F.col("timestamp") <= ts) & ((F.col("timestamp") < ts) | (F.col("row_key") < key)))
        return tenant_page(rows, tenant_id, limit)

    def leaves_of_page(
        self, tenant_id: str, limit: int, after: tuple[dt.datetime, int] | None = None, version: Version | None = None
    ) -> DataFrame:
        """The leaves that can hold rows of a page.

        Leaves that end before the page's start are taken by their first time, newest first, until they hold ``limit`` rows:
        the page begins at or after the first time of the last one taken, so leaves that end earlier are left out.
        """
        own = self.leaves(version).filter(F.col("tenant_id") == tenant_id)
        whole = own
        if after is not None:
            start = F.lit(after[0]).cast("timestamp")
            own = own.filter(F.col("first_ts") <= start)
            whole = own.filter(F.col("last_ts") < start)
        # One row per leaf of one tenant: as many as it has days once they are compacted.
        newest = Window.orderBy(F.desc("first_ts"), "segment", "created_date").rowsBetween(Window.unboundedPreceding, 0)
        enough = whole.withColumn("_held", F.sum("rows").over(newest)).filter(F.col("_held") >= limit)
        bound = enough.agg(F.max("first_ts")).first()[0]
        return own if bound is None else own.filter(F.col("last_ts") >= F.lit(bound).cast("timestamp"))

    def device_page(self, tenant_id: str, device_id: str, limit: int = schemas.PAGE_ROWS, version: Version | None = None) -> DataFrame:
        """The newest rows of a device. In compacted days its few row groups are found by range and Bloom filter."""
        return device_page(self.read(version, tenant_id), tenant_id, device_id, limit)

    # Writing

    def _write(self, rows: DataFrame, compacted: bool = False, files: int | None = None, row_group_rows: int = ROW_GROUP_ROWS) -> str:
        """Write a segment; its leaves come to light only with the next version."""
        segment = uuid.uuid4().hex
        if files is None:
            out = rows.hint("rebalance", "tenant_id", "created_date")
        else:
            by = ["tenant_id", "created_date", "device_id", "timestamp", "row_key"]
            out = rows.repartitionByRange(files, *by).sortWithinPartitions(*by)
        writer = out.write.partitionBy("tenant_id", "created_date")
        if compacted:
            writer = (
                writer.option("parquet.bloom.filter.enabled#device_id", "true")
                .option("parquet.bloom.filter.expected.ndv#device_id", str(DEVICES_PER_FILE))
                .option("parquet.block.row.count.limit", str(row_group_rows))
                .option("parquet.page.row.count.limit", str(min(20_000, row_group_rows)))
            )
        writer.parquet(f"{self.path}/data/segment={segment}")
        return segment

    def _leaves_of(self, segment: str, compacted: bool) -> DataFrame:
        """The leaves of a segment just written; none if no row was."""
        data = f"{self.path}/data"
        rows = self.spark.read.schema(f"{schemas.SENSOR_DATA}, segment STRING").option("basePath", data).parquet(f"{data}/segment={segment}")
        found = rows.groupBy(*KEY).agg(
            F.count(F.lit(1)).alias("rows"), F.min("timestamp").alias("first_ts"), F.max("timestamp").alias("last_ts"),
            F.min("created_at").alias("first_created"), F.max("created_at").alias("last_created"),
        )
        return found.withColumn("compacted", F.lit(compacted))

    def append(self, rows: DataFrame, batch_id: int, writer: str = "batch", only_new: bool = False) -> bool:
        """Add a batch; false if the writer has committed this batch or a later one, and nothing is added.

        Of rows with one key the first is kept. ``only_new`` leaves out keys stored already on the days of the batch, for
        sources that deliver a row again in another batch.
        """
        if self.versions.committed(writer, batch_id):
            return False
        out = first_per_key(rows)
        if only_new:
            first, last = rows.agg(F.min("created_date"), F.max("created_date")).first()
            day = F.col("created_date")
            stored = self.read(leaves=self.leaves().filter(day.between(F.lit(first), F.lit(last)) | day.isNull()))
            out = out.join(stored.select("row_key"), "row_key", "left_anti").select(*rows.columns)
        segment = self._write(out)
        added = self._leaves_of(segment, False)
        return self.versions.commit(lambda live: live.unionByName(added), writer, batch_id)

    def _replace(self, old: DataFrame, new: DataFrame | None, before_publish=None) -> None:
        """Switch leaves for others, if all of them are still live."""
        gone = old.select(*KEY)
        count = gone.count()

        def change(live: DataFrame) -> DataFrame:
            if live.join(gone, _same(live, gone), "left_semi").count() != count:
                raise Conflict("leaves to replace are no longer live")
            rest = live.join(gone, _same(live, gone), "left_anti")
            return rest if new is None else rest.unionByName(new)

        self.versions.commit(change, before_publish=before_publish)

    def compact(self, before: dt.date, file_rows: int = FILE_ROWS, row_group_rows: int = ROW_GROUP_ROWS, before_publish=None) -> int:
        """Join the leaves of days before ``before`` in sorted files; returns how many leaves were joined.

        Days of one compacted leaf are left alone, so a day is written again only when a batch has added to it.
        """
        version = self.versions.newest()
        leaves = self.leaves(version).filter(F.col("created_date") < F.lit(before))
        days = leaves.groupBy("tenant_id", "created_date").agg(F.bool_and("compacted").alias("_done"), F.count(F.lit(1)).alias("_n"))
        open_days = days.filter(~(F.col("_done") & (F.col("_n") == 1)))
        # Kept in a table, so that the leaves replaced are the leaves read.
        chosen = self._kept(leaves.join(open_days, _same(leaves, open_days, ("tenant_id", "created_date")), "left_semi"))
        total, number = chosen.agg(F.sum("rows"), F.count(F.lit(1))).first()
        if not number:
            return 0
        segment = self._write(self._rows_of(chosen).drop("segment"), True, -(-total // file_rows), row_group_rows)
        self._replace(chosen, self._leaves_of(segment, True), before_publish)
        return number

    def _kept(self, leaves: DataFrame) -> DataFrame:
        path = f"{self.path}/_versions/list-{uuid.uuid4().hex}"
        leaves.write.parquet(path)
        return self.spark.read.schema(leaves.schema).parquet(path)

    def retain(
        self, policies: DataFrame, as_of: dt.datetime, default_days: int = schemas.DEFAULT_RETENTION_DAYS, before_publish=None
    ) -> DataFrame:
        """Remove expired rows in one step; returns the deleted count per tenant. ``as_of`` is in UTC."""
        now = F.lit(as_of).cast("timestamp")
        leaves = self.leaves(self.versions.newest())
        days = policies.select("tenant_id", F.col("days").cast("int").alias("_days"))
        limit = retention.cutoff(now, F.coalesce("_days", F.lit(default_days)))
        aged = join_dimension(leaves, days, "tenant_id").withColumn("_limit", limit).filter(F.col("first_created") < F.col("_limit"))
        aged = self._kept(aged.select(*leaves.columns, (F.col("last_created") < F.col("_limit")).alias("_whole")))
        edges = aged.filter(~F.col("_whole"))
        added = None
        if not edges.isEmpty():
            stay = retention.survivors(self._rows_of(edges).drop("segment"), policies, now, default_days)
            added = self._leaves_of(self._write(stay, True, max(1, -(-edges.agg(F.sum("rows")).first()[0] // FILE_ROWS))), True)
        counts = aged.select("tenant_id", F.col("rows").alias("_n"))
        if added is not None:
            counts = counts.unionAll(added.select("tenant_id", -F.col("rows")))
        deleted = counts.groupBy("tenant_id").agg(F.sum("_n").alias("deleted")).filter(F.col("deleted") > 0)
        deleted = self._kept(deleted)
        if not aged.isEmpty():
            self._replace(aged, added, before_publish)
        return deleted

    def vacuum(self, keep: int = 2, min_age_s: float = MIN_AGE_S) -> int:
        """Remove versions but the newest ``keep``, and segments none of these names; returns how many segments went."""
        return vacuum(self.versions, f"{self.path}/data", keep, min_age_s)
