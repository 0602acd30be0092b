"""The stored readings table: Parquet partitioned by tenant, creation day and the batch that wrote the rows."""

from __future__ import annotations

import datetime as dt
import uuid
from urllib.parse import unquote

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from fleetgauge import schemas
from fleetgauge.operators import retention

PARTITIONS = ("tenant_id", "created_date", "batch_id")

# Fixed value: the folder name that stands for a null (or empty) partition value.
NULL_FOLDER = "__HIVE_DEFAULT_PARTITION__"


def read_table(spark: SparkSession, path: str) -> DataFrame:
    """The whole table; filters on tenant_id and created_date select folders, the rest reach the Parquet scan."""
    return _with_batch(spark, path).drop("batch_id")


def _with_batch(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.schema(f"{schemas.SENSOR_DATA}, batch_id BIGINT").parquet(path)


def write_batch(rows: DataFrame, path: str, batch_id: int, partitions=PARTITIONS) -> None:
    """Write the rows of one batch; writing the same batch again replaces it.

    ``rebalance`` lets the engine split a tenant's large day over many files and pack small days together.
    """
    out = rows.withColumn("batch_id", F.lit(batch_id).cast("bigint"))
    (
        out.hint("rebalance", *[c for c in partitions if c != "batch_id"])
        .write.mode("overwrite")
        .option("partitionOverwriteMode", "dynamic")
        .partitionBy(*partitions)
        .parquet(path)
    )


def first_per_key(rows: DataFrame, key: str = "row_key", seq: str = "row_key") -> DataFrame:
    """One row per key. Copies of a key are merged before the shuffle, so a heavily repeated key is cheap."""
    rest = [c for c in rows.columns if c != key]
    if key == seq:
        return rows.groupBy(key).agg(F.first(F.struct(*rest)).alias("_r")).select(key, "_r.*").select(*rows.columns)
    kept = rows.groupBy(key).agg(F.min_by(F.struct(*rest), seq).alias("_r"))
    return kept.select(key, "_r.*").select(*rows.columns)


def new_rows(rows: DataFrame, stored: DataFrame, key: str = "row_key") -> DataFrame:
    """Rows whose key is neither repeated here nor stored already. Restrict ``stored`` to the days that can clash."""
    return first_per_key(rows, key).join(stored.select(key), key, "left_anti")


def append(spark: SparkSession, rows: DataFrame, path: str, batch_id: int) -> None:
    """Append rows that may be replays of stored ones; stored rows stay, whatever batch they came with.

    Read back are the days from the first to the last in ``rows``, and rows without a day. What the batch has stored
    before is written again with its new rows, because a batch's folders are replaced.
    """
    if not _exists(spark, path):
        write_batch(first_per_key(rows), path, batch_id)
        return
    first, last = rows.agg(F.min("created_date"), F.max("created_date")).first()
    day = F.col("created_date")
    stored = _with_batch(spark, path).filter(day.between(F.lit(first), F.lit(last)) | day.isNull())
    own = stored.filter(F.col("batch_id") == batch_id).select(*rows.columns)
    write_batch(new_rows(rows, stored).unionByName(own), path, batch_id)


def _fs(spark: SparkSession, path: str):
    jvm = spark._jvm
    hadoop = jvm.org.apache.hadoop.fs.Path(path)
    return hadoop.getFileSystem(spark._jsc.hadoopConfiguration()), hadoop


def _exists(spark: SparkSession, path: str) -> bool:
    fs, p = _fs(spark, path)
    return fs.exists(p)


def _partition_folders(spark: SparkSession, path: str) -> list[tuple[str | None, dt.date, str]]:
    """(tenant, day, folder) of every tenant day: names only, no data is read. Rows without a day never expire."""
    fs, _ = _fs(spark, path)
    found = fs.globStatus(spark._jvm.org.apache.hadoop.fs.Path(f"{path}/tenant_id=*/created_date=*")) or []
    out = []
    for status in found:
        folder = status.getPath()
        tenant, day = (unquote(p.getName().split("=", 1)[1]) for p in (folder.getParent(), folder))
        if day != NULL_FOLDER:
            out.append((None if tenant == NULL_FOLDER else tenant, dt.date.fromisoformat(day), folder.toString()))
    return out


def apply_retention(
    spark: SparkSession, path: str, policies: DataFrame, as_of: dt.datetime,
    default_days: int = schemas.DEFAULT_RETENTION_DAYS,
) -> DataFrame:
    """Delete expired rows in place and return the deleted count per tenant.

    ``as_of`` is in UTC. Days that end before a tenant's cutoff are dropped as folders; only the day that holds the
    cutoff is rewritten, through a staging folder. Rows without a tenant follow the default. A run that stops half-way
    can be repeated; one whose kept and expired rows do not add up to those read stops before it deletes anything.
    """
    tenants = _partition_folders(spark, path)
    listed = spark.createDataFrame(
        tenants, "tenant_id STRING, created_date DATE, folder STRING"
    ) if tenants else spark.createDataFrame([], "tenant_id STRING, created_date DATE, folder STRING")
    now = F.lit(as_of).cast("timestamp")
    limit = retention.cutoff(now, F.coalesce("days", F.lit(default_days)))
    plan = (
        listed.join(policies.select("tenant_id", F.col("days").cast("int").alias("days")), "tenant_id", "left")
        .withColumn("edge", F.to_date(limit))
        .filter(F.col("created_date") <= F.col("edge"))
        .select("tenant_id", "created_date", "folder", (F.col("created_date") < F.col("edge")).alias("whole"))
        .collect()
    )
    touched = [r["created_date"] for r in plan]
    table = read_table(spark, path).filter(F.col("created_date") <= (max(touched) if touched else dt.date.min))
    counts = retention.deleted_counts(table, policies, now, default_days).collect()

    edges = [r for r in plan if not r["whole"]]
    fs, _ = _fs(spark, path)
    if edges:
        staging = f"{path}/_staging_{uuid.uuid4().hex}"
        wanted = spark.createDataFrame(
            [(r["tenant_id"], r["created_date"]) for r in edges], "tenant_id STRING, created_date DATE"
        )
        stored = _with_batch(spark, path).filter(F.col("created_date").isin(sorted({r["created_date"] for r in edges})))
        same = stored["tenant_id"].eqNullSafe(wanted["tenant_id"]) & (stored["created_date"] == wanted["created_date"])
        rows = stored.join(wanted, same, "left_semi")
        retention.survivors(rows, policies, now, default_days).write.partitionBy(*PARTITIONS).parquet(staging)
        staged = _with_batch(spark, staging)
        gone = retention.deleted_counts(rows, policies, now, default_days).agg(F.coalesce(F.sum("deleted"), F.lit(0)))
        if staged.count() + gone.first()[0] != rows.count():
            fs.delete(spark._jvm.org.apache.hadoop.fs.Path(staging), True)
            raise RuntimeError("kept and expired rows do not add up to the rows read; nothing was deleted")
        left = {
            (r["tenant_id"], r["created_date"], r["batch_id"]) for r in staged.select(*PARTITIONS).distinct().collect()
        }
        staged.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy(*PARTITIONS).parquet(path)
        for r in edges:
            _drop_batches(spark, fs, r, left)
        fs.delete(spark._jvm.org.apache.hadoop.fs.Path(staging), True)
    for r in plan:
        if r["whole"]:
            fs.delete(spark._jvm.org.apache.hadoop.fs.Path(r["folder"]), True)
    return spark.createDataFrame(counts, "tenant_id STRING, deleted BIGINT")


def _drop_batches(spark, fs, edge, left) -> None:
    """Remove the batches of a rewritten day that kept no row."""
    folder = spark._jvm.org.apache.hadoop.fs.Path(edge["folder"])
    for status in fs.listStatus(folder):
        batch = int(status.getPath().getName().split("=", 1)[1])
        if (edge["tenant_id"], edge["created_date"], batch) not in left:
            fs.delete(status.getPath(), True)
