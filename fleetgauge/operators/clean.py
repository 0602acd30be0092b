"""Raw JSON messages to clean, typed readings."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from fleetgauge.functions import documents as D
from fleetgauge.functions import scoring, timestamps
from fleetgauge.operators.lookup import computed_once

# Reasons a message is refused, in the words of the service.
BAD_JSON = "invalid JSON"
NO_ID = "missing required field: device_id or sensor_id"
BAD_DEVICE = "device_id must be a non-empty string"
BAD_SENSOR = "sensor_id must be a non-empty string"
BAD_TIMESTAMP = "timestamp must be RFC3339 string or Unix timestamp number"

_TEXTS = ("device_id", "sensor_id", "tenant_id", "timestamp")
_NUMBERS = ("timestamp", "temperature", "humidity")
_TYPED = ("device_id", "sensor_id", "tenant_id", "timestamp", "temperature", "humidity")
_KNOWN = ("timestamp", "temperature", "humidity", "processed_at", "quality_score")


def parse_messages(df: DataFrame, value: str = "value") -> DataFrame:
    """Parse each text once and add what the rules ask about.

    ``doc`` (VARIANT), ``is_json``, the JSON type of each known key as ``<key>_kind``, its value as ``<key>_text`` or
    ``<key>_number`` where it has that type, and the instant of an RFC 3339 timestamp as ``timestamp_instant``. Only an
    object, or a JSON null standing for an empty one, is a record. Text that is not JSON gives null.
    """
    known = (
        df.withColumn("doc", F.try_parse_json(value))
        .withColumn("_known", D.members(F.col("doc"), _TYPED))
        .select("*", *[D.kind(F.col(f"_known.{n}")).alias(f"{n}_kind") for n in _TYPED])
    )
    is_record = F.col("doc").isNotNull() & (F.col("_known").isNotNull() | F.is_variant_null("doc"))
    valued = known.select(
        *[c for c in known.columns if c != "_known"],
        is_record.alias("is_json"),
        *[D.text(F.col(f"_known.{n}"), F.col(f"{n}_kind")).alias(f"{n}_text") for n in _TEXTS],
        *[D.number(F.col(f"_known.{n}"), F.col(f"{n}_kind")).alias(f"{n}_number") for n in _NUMBERS],
    ).withColumn("timestamp_instant", timestamps.parse_rfc3339(F.col("timestamp_text")))
    return computed_once(valued, [c for c in valued.columns if c not in df.columns])


def required_fields_reason() -> Column:
    """The first rule a parsed message breaks, null when it breaks none."""
    def bad_id(name):
        return F.col(f"{name}_kind").isNotNull() & F.coalesce(F.col(f"{name}_text") == "", F.lit(True))

    return (
        F.when(~F.col("is_json"), BAD_JSON)
        .when(F.col("device_id_kind").isNull() & F.col("sensor_id_kind").isNull(), NO_ID)
        .when(bad_id("device_id"), BAD_DEVICE)
        .when(bad_id("sensor_id"), BAD_SENSOR)
        .when(F.col("timestamp_text").isNotNull() & F.col("timestamp_instant").isNull(), BAD_TIMESTAMP)
    )


def ingest_accepts() -> Column:
    """Accepted at the front door: the device_id key is there and is not the empty string."""
    return F.col("is_json") & F.col("device_id_kind").isNotNull() & F.coalesce(F.col("device_id_text") != "", F.lit(True))


def accepted_at_ingest(df: DataFrame, value: str = "value") -> DataFrame:
    """Messages that pass the front door, with the topic key: device_id if it is a string, else null."""
    parsed = parse_messages(df, value)
    return parsed.filter(ingest_accepts()).select(
        *[c for c in df.columns if c != "key"],
        F.col("device_id_text").alias("key"),
    )


def clean_messages(df: DataFrame, value: str = "value", validate: bool = True, now: Column | None = None) -> DataFrame:
    """Clean every message; nothing is dropped, a refused one carries ``reject_reason``.

    ``now`` stands in for unusable timestamps; by default the ``ingest_ts`` column if there is one, else the
    current time. With ``validate`` false only text that is no JSON record is refused.
    """
    if now is None:
        now = F.col("ingest_ts") if "ingest_ts" in df.columns else F.current_timestamp()
    parsed = parse_messages(df, value).withColumn("_now", now.cast("timestamp"))
    has_timestamp = F.col("timestamp_kind").isNotNull()
    ts = F.coalesce("timestamp_instant", timestamps.from_epoch_seconds(F.col("timestamp_number")), "_now")
    as_text = F.when(F.col("timestamp_instant").isNotNull(), F.col("timestamp_text")).otherwise(timestamps.format_rfc3339(ts))
    keys = [F.col(f"{name}_kind").isNotNull() for name in ("device_id", "sensor_id", "timestamp")]
    wrong_type = ~_fits(("device_id", "tenant_id"), ("temperature", "humidity"))
    return parsed.select(
        *df.columns,
        "is_json",
        (required_fields_reason() if validate else F.when(~F.col("is_json"), BAD_JSON)).alias("reject_reason"),
        *[F.col(f"{name}_text").alias(name) for name in ("device_id", "sensor_id", "tenant_id")],
        F.when(has_timestamp, ts).alias("ts"),
        F.when(has_timestamp, as_text).alias("timestamp_text"),
        F.col("temperature_number").alias("temperature"),
        scoring.clamp_humidity(F.col("humidity_number")).alias("humidity"),
        scoring.temperature_warning(F.col("temperature_number")).alias("temperature_warning"),
        scoring.quality_score(keys, F.col("temperature_number")).alias("quality_score"),
        F.col("_now").alias("processed_at"),
        wrong_type.alias("type_error"),
        D.as_fields(F.col("doc")).alias("fields"),
    )


def _fits(texts: tuple[str, ...], numbers: tuple[str, ...]) -> Column:
    """Every named key is absent, null or of its type."""
    ok = F.lit(True)
    for names, test in ((texts, D.is_string), (numbers, D.is_number)):
        for name in names:
            ok = ok & (test(F.col(f"{name}_kind")) | D.absent_or_null(F.col(f"{name}_kind")))
    return ok


def to_clean_json(df: DataFrame) -> Column:
    """The clean message as JSON text: known fields rewritten, every other field as it came."""
    def entry(name, value, present):
        return F.when(present, F.struct(F.lit(name).alias("key"), value.alias("value")))

    def rewritten(name, value, number):
        """The cleaned number, or the value as it came when it is no number."""
        original = F.try_element_at("fields", F.lit(name))
        chosen = F.when(number.isNotNull(), number.cast("variant")).otherwise(original)
        return entry(name, chosen, original.isNotNull())

    fields = F.coalesce("fields", F.map_from_arrays(F.array().cast("array<string>"), F.array().cast("array<variant>")))
    rest = F.map_filter(fields, lambda k, _: ~k.isin(*_KNOWN))
    changed = F.array_compact(
        F.array(
            entry("timestamp", F.col("timestamp_text").cast("variant"), F.col("timestamp_text").isNotNull()),
            rewritten("temperature", F.col("temperature"), F.col("temperature")),
            rewritten("humidity", F.col("humidity"), F.col("humidity")),
            entry("processed_at", timestamps.format_rfc3339(F.col("processed_at")).cast("variant"), F.lit(True)),
            entry("quality_score", F.round("quality_score", 6).cast("variant"), F.lit(True)),
        )
    )
    return F.to_json(F.map_concat(rest, F.map_from_entries(changed)))


def accepted(df: DataFrame) -> DataFrame:
    return df.filter(F.col("reject_reason").isNull()).drop("reject_reason")


def rejected(df: DataFrame) -> DataFrame:
    return df.filter(F.col("reject_reason").isNotNull())


def reject_counts(df: DataFrame) -> DataFrame:
    """Messages per reason; accepted ones count under ``ok``."""
    return df.groupBy(F.coalesce("reject_reason", F.lit("ok")).alias("reason")).agg(F.count(F.lit(1)).alias("messages"))


def decode_readings(df: DataFrame, value: str = "value") -> DataFrame:
    """JSON text to typed readings without cleaning; ``type_error`` marks records that do not fit.

    A value of the wrong type, a numeric timestamp or a text that is no RFC 3339 time spoils the whole record. ``lat`` and
    ``lng`` are the numbers in ``location``.
    """
    place = D.members(D.members(F.col("doc"), ("location",))["location"], ("lat", "lng"))
    parsed = parse_messages(df, value).withColumn("_place", place)
    ok = (
        F.col("is_json")
        & _fits(("device_id", "tenant_id", "timestamp"), ("temperature", "humidity"))
        & (F.col("timestamp_text").isNull() | F.col("timestamp_instant").isNotNull())
    )
    return parsed.select(
        *df.columns,
        F.col("device_id_text").alias("device_id"),
        F.col("tenant_id_text").alias("tenant_id"),
        F.col("timestamp_instant").alias("ts"),
        F.col("temperature_number").alias("temperature"),
        F.col("humidity_number").alias("humidity"),
        *[D.number(F.col(f"_place.{n}"), D.kind(F.col(f"_place.{n}"))).alias(n) for n in ("lat", "lng")],
        "is_json",
        (~ok).alias("type_error"),
    )
