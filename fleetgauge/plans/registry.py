"""Where the registered queries are collected."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from fleetgauge.session import configure

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}
ORACLE: dict[str, str] = {}


def query(sql: str | None = None) -> Callable[[Query], Query]:
    """Register a function under its own name, with the SQL that must give the same rows."""

    def add(fn: Query) -> Query:
        def run(spark: SparkSession, sf_dir: str) -> DataFrame:
            return without_zone(fn(configure(spark), sf_dir))

        run.__name__ = fn.__name__
        QUERIES[fn.__name__] = run
        if sql is not None:
            ORACLE[fn.__name__] = sql
        return fn

    return add


def without_zone(df: DataFrame) -> DataFrame:
    """Instants as UTC wall-clock times."""
    return df.select(
        *[F.col(f"`{c}`").cast("timestamp_ntz").alias(c) if t == "timestamp" else F.col(f"`{c}`") for c, t in df.dtypes]
    )
