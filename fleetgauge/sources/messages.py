"""Message sources and sinks. Batch and stream readers return the same columns: ``schemas.ENVELOPE`` + arrival_seq."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from fleetgauge import schemas

# Topic names and the number of partitions a topic has by default.
RAW_TOPIC = "sensor-data"
CLEAN_TOPIC = "sensor-data-clean"
PROCESSED_TOPIC = "processed-data"
TOPIC_PARTITIONS = 6


def arrival_seq(partitions: int = TOPIC_PARTITIONS) -> Column:
    """A unique number per message that grows with the offset of its partition.

    ``partitions`` is the topic's number of partitions or more; a message of a partition beyond it stops the query,
    as its number would be that of another message.
    """
    beyond = F.raise_error(F.concat(F.lit(f"topic has more than {partitions} partitions: "), F.col("partition").cast("string")))
    return F.when(F.col("partition") < partitions, F.col("offset") * F.lit(partitions) + F.col("partition")).otherwise(
        beyond.cast("bigint")
    )


def read_landing(spark: SparkSession, path: str, streaming: bool = False, files_per_trigger: int | None = None):
    """Plain text files, one JSON reading per line. The file time stands in for the arrival time."""
    reader = spark.readStream if streaming else spark.read
    if streaming and files_per_trigger:
        reader = reader.option("maxFilesPerTrigger", files_per_trigger)
    return reader.text(path).select("value", F.col("_metadata.file_modification_time").alias("ingest_ts"))


def read_envelopes(
    spark: SparkSession, path: str, streaming: bool = False, partitions: int = TOPIC_PARTITIONS,
    files_per_trigger: int | None = None, file_format: str = "json",
) -> DataFrame:
    """Replayed topic: files that hold key, value, partition, offset and ingest_ts."""
    reader = (spark.readStream if streaming else spark.read).schema(schemas.ENVELOPE)
    if streaming and files_per_trigger:
        reader = reader.option("maxFilesPerTrigger", files_per_trigger)
    return reader.format(file_format).load(path).withColumn("arrival_seq", arrival_seq(partitions))


def read_topic(
    spark: SparkSession, servers: str, topic: str = RAW_TOPIC, streaming: bool = True,
    partitions: int = TOPIC_PARTITIONS, connector: str = "kafka", **options: str,
) -> DataFrame:
    """A Kafka topic from its oldest offset; where to continue is kept in the query's checkpoint.

    ``connector`` names the format; one with the same columns and options can stand in for Kafka.
    """
    reader = (spark.readStream if streaming else spark.read).format(connector).options(
        **{"kafka.bootstrap.servers": servers, "subscribe": topic, "startingOffsets": "earliest", **options}
    )
    return reader.load().select(
        F.col("key").cast("string").alias("key"), F.col("value").cast("string").alias("value"), "partition", "offset",
        F.col("timestamp").alias("ingest_ts"),
    ).withColumn("arrival_seq", arrival_seq(partitions))


def to_messages(df: DataFrame, value: Column, key: str = "device_id") -> DataFrame:
    """Key and JSON text as a topic sink takes them; messages keep their key at every stage."""
    return df.select(F.col(key).cast("string").alias("key"), value.alias("value"))


def write_topic(
    messages: DataFrame, servers: str, topic: str, checkpoint: str | None = None, connector: str = "kafka", once: bool = False,
    **options: str,
):
    """Append to a Kafka topic: a started query for a stream, None for a batch."""
    settings = {"kafka.bootstrap.servers": servers, "topic": topic, **options}
    if not messages.isStreaming:
        messages.write.format(connector).mode("append").options(**settings).save()
        return None
    writer = messages.writeStream.format(connector).options(**settings).option("checkpointLocation", checkpoint)
    return (writer.trigger(availableNow=True) if once else writer).start()
