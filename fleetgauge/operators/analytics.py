"""Analytics summary of a tenant: aggregates of one metric and its newest anomalies."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from fleetgauge.functions.scoring import mean
from fleetgauge.operators.ordered import first_rows
from fleetgauge.operators.recent import TENANT_SALTS


def tenant_anomalies(df: DataFrame) -> DataFrame:
    """All anomalous rows, as rows: the whole list of a tenant has no bound."""
    return df.filter(F.col("is_anomaly"))


def analytics_result(
    df: DataFrame, metric: str = "temperature", newest: int = 100, seq: str = "arrival_seq", ts: str = "ts"
) -> DataFrame:
    """Average, max, min and count per tenant with its ``newest`` anomalies, newest first."""
    totals = df.groupBy("tenant_id").agg(
        mean(F.col(metric)).alias("average"), F.max(metric).alias("maximum"), F.min(metric).alias("minimum"),
        F.count(metric).alias("count"),
    )
    top = first_rows(tenant_anomalies(df), ["tenant_id"], [F.desc(seq)], newest, TENANT_SALTS, seq)
    item = F.struct(F.col(seq), "device_id", F.col(ts), F.col(metric).alias("value"), "anomaly_score")
    listed = top.groupBy("tenant_id").agg(F.sort_array(F.collect_list(item), asc=False).alias("anomalies"))
    return totals.join(listed, "tenant_id", "left").withColumn("anomalies", F.coalesce("anomalies", F.array()))
