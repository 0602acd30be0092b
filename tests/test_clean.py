"""Cleaning and checking rules on single messages."""

import json

import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from fleetgauge.functions import documents, scoring, timestamps
from fleetgauge.operators import clean, quality, validate

NOW = "2024-02-01T12:00:00Z"


def messages(spark, values):
    rows = [(i, v if isinstance(v, (str, type(None))) else json.dumps(v)) for i, v in enumerate(values)]
    df = spark.createDataFrame(rows, "arrival_seq BIGINT, value STRING")
    return df.withColumn("ingest_ts", F.lit(NOW).cast("timestamp"))


def cleaned(spark, values, **options):
    return clean.clean_messages(messages(spark, values), **options).orderBy("arrival_seq").collect()


REQUIRED = [
    ({"device_id": "boiler-a", "temperature": 18.25}, None),
    ({"sensor_id": "hum-7", "humidity": 60.0}, None),
    ({"device_id": "d", "sensor_id": "s"}, None),
    ({"temperature": 18.25}, clean.NO_ID),
    ({"device_id": ""}, clean.BAD_DEVICE),
    ({"device_id": 123}, clean.BAD_DEVICE),
    ({"device_id": None}, clean.BAD_DEVICE),
    ({"sensor_id": ""}, clean.BAD_SENSOR),
    ({"device_id": "d", "sensor_id": 5}, clean.BAD_SENSOR),
    ({"device_id": "d", "timestamp": "2021-02-07T04:05:06Z"}, None),
    ({"device_id": "d", "timestamp": 1700000125.0}, None),
    ({"device_id": "d", "timestamp": "soon after noon"}, clean.BAD_TIMESTAMP),
    ({"device_id": "d", "timestamp": "2021-14-07T04:05:06Z"}, clean.BAD_TIMESTAMP),
    ({"device_id": "d"}, None),
    ({"device_id": "d", "timestamp": True}, None),
    ({}, clean.NO_ID),
    ("null", clean.NO_ID),
    ("{bad", clean.BAD_JSON),
    ("[1]", clean.BAD_JSON),
    ('"text"', clean.BAD_JSON),
    ("", clean.BAD_JSON),
    (None, clean.BAD_JSON),
]


def test_json_validity(spark):
    df = spark.createDataFrame([("{}",), ("null",), ("[1]",), ("{bad",), ("",)], "value STRING")
    assert [r[0] for r in df.select(documents.is_valid("value")).collect()] == [True, True, True, False, False]


def test_required_fields(spark):
    rows = cleaned(spark, [v for v, _ in REQUIRED])
    assert [r.reject_reason for r in rows] == [reason for _, reason in REQUIRED]


def test_topic_path_only_refuses_bad_json(spark):
    rows = cleaned(spark, [v for v, _ in REQUIRED], validate=False)
    assert [r.reject_reason for r in rows] == [r if r == clean.BAD_JSON else None for _, r in REQUIRED]


TIMES = [
    ("2021-02-07T04:05:06Z", "2021-02-07T04:05:06Z"),
    (1700000125.0, "2023-11-14T22:15:25Z"),
    (1700000125, "2023-11-14T22:15:25Z"),
    (1700000125.9, "2023-11-14T22:15:25Z"),
    (-0.5, "1970-01-01T00:00:00Z"),
    ("later", NOW),
    (None, NOW),
    (True, NOW),
    (1e300, NOW),
    ("2021-02-07", NOW),
    ("2021-02-07T04:05:06", NOW),
    ("2021-02-07 04:05:06Z", NOW),
    ("2021-02-07T04:05:06.123+02:00", "2021-02-07T04:05:06.123+02:00"),
]


def test_timestamps(spark):
    rows = cleaned(spark, [{"device_id": "d", "timestamp": t} for t, _ in TIMES])
    assert [r.timestamp_text for r in rows] == [text for _, text in TIMES]
    assert cleaned(spark, [{"device_id": "d"}])[0].timestamp_text is None


def test_timestamps_do_not_depend_on_the_session_zone(spark):
    spark.conf.set("spark.sql.session.timeZone", "America/New_York")
    try:
        rows = cleaned(spark, [{"device_id": "d", "timestamp": t} for t, _ in TIMES])
        assert [r.timestamp_text for r in rows] == [text for _, text in TIMES]
    finally:
        spark.conf.set("spark.sql.session.timeZone", "UTC")


def test_sensor_values(spark):
    given_values = [("temperature", 18.25), ("temperature", -60.0), ("humidity", 60.0), ("humidity", 150.0),
                    ("humidity", -10.0), ("humidity", "x")]
    rows = cleaned(spark, [{"device_id": "d", name: v} for name, v in given_values])
    assert [r.temperature for r in rows] == [18.25, -60.0, None, None, None, None]
    assert [r.humidity for r in rows] == [None, None, 60.0, 100.0, 0.0, None]
    assert [r.temperature_warning for r in rows] == [False, True, False, False, False, False]
    assert [r.type_error for r in rows] == [False] * 5 + [True]


QUALITY = [
    ({"device_id": "d", "sensor_id": "s", "timestamp": 1, "temperature": 18.25, "humidity": 60}, 1.0),
    ({"device_id": "d", "timestamp": 1, "temperature": 18.25}, 0.9),
    ({"device_id": "d", "temperature": 18.25}, 0.8),
    ({"device_id": "d", "temperature": -60}, 0.6),
    ({"device_id": "d"}, 0.8),
    ({"device_id": "d", "timestamp": None}, 0.9),
    ({"temperature": -60}, 0.5),
    ({"device_id": "d", "temperature": "hot"}, 0.8),
]


def test_quality(spark):
    rows = cleaned(spark, [v for v, _ in QUALITY])
    assert [r.quality_score for r in rows] == pytest.approx([q for _, q in QUALITY], abs=1e-9)


def test_unknown_fields_pass_through(spark):
    message = {"device_id": "d", "location": {"lat": 1.5, "lng": 2}, "pressure": 1013.25, "humidity": 150, "tags": [1, "a"],
               "raw_reading": None, "temperature": "hot", "timestamp": 1700000125}
    df = clean.clean_messages(messages(spark, [message]))
    out = json.loads(df.select(clean.to_clean_json(df)).first()[0])
    assert out == {**message, "humidity": 100.0, "timestamp": "2023-11-14T22:15:25Z", "processed_at": NOW, "quality_score": 0.9}


def test_repeated_key_takes_the_last(spark):
    assert cleaned(spark, ['{"device_id":"a","device_id":"b"}'])[0].device_id == "b"


def test_large_and_non_ascii_values(spark):
    name, large = "device-special-chars-åäö-测试", "x" * 100_000
    df = clean.clean_messages(messages(spark, [{"device_id": name, "large_field": large}]))
    out = json.loads(df.select(clean.to_clean_json(df)).first()[0])
    assert (out["device_id"], out["large_field"]) == (name, large)


def test_ingest_key(spark):
    values = [{"device_id": "a"}, {"device_id": ""}, {"device_id": 5}, {"device_id": None}, {"x": 1}, "{bad"]
    rows = clean.accepted_at_ingest(messages(spark, values)).orderBy("arrival_seq").collect()
    assert [(r.arrival_seq, r.key) for r in rows] == [(0, "a"), (2, None), (3, None)]


def test_decode_spoils_the_whole_record(spark):
    values = [
        {"device_id": "d", "timestamp": "2021-02-07T04:05:06Z", "temperature": 1}, {"device_id": "d", "timestamp": 5},
        {"device_id": "d", "temperature": "1"}, {"device_id": 1}, {"device_id": "d", "timestamp": None, "humidity": None},
        {"device_id": "d", "tenant_id": []}, "[]", "{bad", {"device_id": "d", "timestamp": "yesterday"},
    ]
    rows = clean.decode_readings(messages(spark, values)).orderBy("arrival_seq").collect()
    assert [r.type_error for r in rows] == [False, True, True, True, False, True, True, True, True]


def test_profiles(spark):
    rows = [("d", "t", 1.0, 2.0), (None, "t", 1.0, 2.0), ("d", "", 1.0, 2.0), ("d", "t", None, 2.0), ("", "", None, None)]
    df = spark.createDataFrame(rows, "device_id STRING, tenant_id STRING, temperature DOUBLE, humidity DOUBLE")
    device, tenant, metrics = "device_id is required", "tenant_id is required", "temperature and humidity are required"
    expected = {
        "engine": [None, device, None, None, device],
        "strict": [None, device, tenant, metrics, tenant],
        "dashboard": [None, device, tenant, metrics, device],
        "store": [None, device, tenant, None, device],
    }
    for profile, reasons in expected.items():
        assert [r.reject_reason for r in validate.check(df, profile).collect()] == reasons
    with pytest.raises(ValueError):
        validate.check(df, "other")


def test_quality_report_and_floor(spark):
    df = quality.quality_report(clean.clean_messages(messages(spark, [{"device_id": "d", "humidity": 150, "temperature": 99}])))
    row = quality.below_quality(df, 0.7).first()
    assert row.completeness == pytest.approx(0.5) and row.accuracy == 0.0 and row.consistency == 1.0
    assert row.flags == ["missing_sensor_id", "missing_timestamp", "missing_tenant_id", "temperature_implausible", "humidity_clamped"]
    assert row.applied_rules == ["clamp_humidity", "quality_score"] and row.too_low


def test_epoch_seconds(spark):
    df = spark.sql("SELECT TIMESTAMP '2023-11-14 22:15:25.9Z' AS ts")
    cut, epoch = df.select(timestamps.cut_to_second(F.col("ts")).cast("string"), timestamps.to_epoch_seconds(F.col("ts"))).first()
    assert (cut, epoch) == ("2023-11-14 22:15:25", 1700000125)


SCALARS = st.one_of(st.none(), st.booleans(), st.integers(-200, 200), st.floats(-1e6, 1e6), st.text(max_size=8))
RECORDS = st.dictionaries(
    st.sampled_from(["device_id", "sensor_id", "tenant_id", "timestamp", "temperature", "humidity", "other"]), SCALARS, max_size=7
)


@settings(max_examples=8, deadline=None, suppress_health_check=list(HealthCheck))
@given(st.lists(RECORDS, min_size=20, max_size=40))
def test_cleaning_properties(spark, records):
    df = clean.clean_messages(messages(spark, [json.dumps(r) for r in records]))
    df = df.withColumn("score", scoring.anomaly_score(F.col("temperature"), F.col("humidity")))
    rows = df.select("reject_reason", "humidity", "quality_score", "score").collect()
    assert len(rows) == len(records)
    for r in rows:
        assert r.humidity is None or 0.0 <= r.humidity <= 100.0
        assert 0.0 <= r.quality_score <= 1.0
        assert r.score in (0.0, 1.0, 2.0)
    assert clean.accepted(df).count() + clean.rejected(df).count() == len(records)


def test_contract_reads_the_location(spark):
    cases = [
        ('{"device_id":"d","location":{"lat":90.5,"lng":1}}', "lat out of range"),
        ('{"device_id":"d","location":{"lat":1,"lng":-181}}', "lng out of range"),
        ('{"device_id":"d","location":{"lat":-90,"lng":180}}', None),
        ('{"device_id":"d","location":"here"}', None),
        ('{"device_id":"d","temperature":1001}', "temperature out of range"),
        ('{"device_id":"d","humidity":100.5}', "humidity out of range"),
        ('{"device_id":""}', "device_id length"),
        ('{"device_id":"d"}', None),
    ]
    rows = clean.decode_readings(messages(spark, [text for text, _ in cases]))
    checked = validate.check(rows, "contract").orderBy("arrival_seq").collect()
    assert [r.reject_reason for r in checked] == [why for _, why in cases]
