"""A table of rows by key, cut in buckets by a hash of the key; an upsert writes only the buckets it touches.

The live bucket folders are listed in versions (see ``versions``): a reader sees an upsert whole or not at all, and a batch that its
writer has committed before changes nothing.
"""

from __future__ import annotations

import uuid
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from fleetgauge.sources.versions import Conflict, Version, Versions, vacuum

BUCKETS = 32
LIST = "bucket INT, segment STRING"


class KeyedTable:
    """Rows of the given schema (DDL) below ``path``, in buckets by ``keys``; null keys are keys like others."""

    def __init__(self, spark: SparkSession, path: str, schema: str, keys: tuple[str, ...], buckets: int = BUCKETS):
        self.spark, self.path, self.schema, self.keys, self.buckets = spark, path.rstrip("/"), schema, keys, buckets
        self.versions = Versions(spark, self.path, LIST)

    def bucketed(self, rows: DataFrame) -> DataFrame:
        return rows.withColumn("_bucket", F.pmod(F.xxhash64(*self.keys), F.lit(self.buckets)).cast("int"))

    def read(self, version: Version | None = None, buckets: list[int] | None = None) -> DataFrame:
        """All rows of a version, or those of some buckets."""
        live = self.versions.rows(version or self.versions.newest())
        if buckets is not None:
            live = live.filter(F.col("bucket").isin(buckets))
        # At most one folder per bucket.
        folders = [f"{self.path}/data/segment={r['segment']}/_bucket={r['bucket']}" for r in live.collect()]
        if not folders:
            return self.spark.createDataFrame([], self.schema)
        return self.spark.read.schema(self.schema).parquet(*folders)

    def committed(self, batch_id: int, writer: str = "stream") -> bool:
        return self.versions.committed(writer, batch_id)

    def upsert(
        self, rows: DataFrame, batch_id: int, merge: Callable[[DataFrame, DataFrame], DataFrame], writer: str = "stream"
    ) -> bool:
        """Replace the rows of every touched bucket by ``merge(old rows, new rows)``, which keeps each row's key.

        Buckets without new rows are not read or written. False if the writer has committed the batch or a later one.
        """
        version = self.versions.newest()
        if version.batches.get(writer, -1) >= batch_id:
            return False
        touched = sorted(r["_bucket"] for r in self.bucketed(rows).select("_bucket").distinct().collect())
        merged = self.bucketed(merge(self.read(version, touched), rows))
        segment = uuid.uuid4().hex
        merged.hint("rebalance", "_bucket").write.partitionBy("_bucket").parquet(f"{self.path}/data/segment={segment}")
        # A bucket that lost all its rows has no folder.
        written = self.spark.read.schema(f"{self.schema}, _bucket INT").parquet(f"{self.path}/data/segment={segment}")
        held = [r["_bucket"] for r in written.select("_bucket").distinct().collect()]
        added = self.spark.createDataFrame([(b, segment) for b in held], LIST)
        before = {(r["bucket"], r["segment"]) for r in self.versions.rows(version).filter(F.col("bucket").isin(touched)).collect()}

        def change(live: DataFrame) -> DataFrame:
            now = {(r["bucket"], r["segment"]) for r in live.filter(F.col("bucket").isin(touched)).collect()}
            if now != before:
                raise Conflict("another writer has changed a bucket")
            return live.filter(~F.col("bucket").isin(touched)).unionByName(added)

        return self.versions.commit(change, writer, batch_id)

    def vacuum(self, keep: int = 2, min_age_s: float = 3600.0) -> int:
        return vacuum(self.versions, f"{self.path}/data", keep, min_age_s)


def latest_wins(key: tuple[str, ...], by: str) -> Callable[[DataFrame, DataFrame], DataFrame]:
    """A merge that keeps for each key the row with the highest ``by``, whatever the order of batches."""

    def merge(old: DataFrame, new: DataFrame) -> DataFrame:
        both = old.unionByName(new.select(*old.columns))
        rest = [c for c in both.columns if c not in key]
        kept = both.groupBy(*key).agg(F.max_by(F.struct(*rest), F.struct(F.col(by).isNotNull(), by)).alias("_r"))
        return kept.select(*key, "_r.*").select(*both.columns)

    return merge
