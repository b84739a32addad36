from datetime import datetime
from types import SimpleNamespace

import pytest
from pyspark.sql import functions as F, types as T

from roadpulse.functions.calendar import calendar_features, legacy_calendar_features
from roadpulse.functions.envelope import decode, encode, parse_time
from roadpulse.operators import ingest
from roadpulse.schemas import OBSERVATION, TOPIC_ROW
from roadpulse.session import fresh_dir, session_settings, shared_dir
from roadpulse.sources.topics import DirectoryTopics, KafkaTopics

HEADERS = TOPIC_ROW["headers"].dataType


def flatten(spark, headers):
    schema = T.StructType([T.StructField("headers", HEADERS), T.StructField("value", T.BinaryType())])
    return ingest.flatten_frames(spark.createDataFrame([(headers, b"x")], schema)).collect()


def test_headers(spark):
    assert flatten(spark, None) == []
    assert flatten(spark, [("location", b"here")]) == []
    assert flatten(spark, [("cam_id", b"\xff\xfe")]) == []
    assert flatten(spark, [("cam_id", b"")]) == []
    (row,) = flatten(spark, [("cam_id", b"a"), ("cam_id", b"b"), ("location", "Đường".encode())])
    assert (row.cam_id, row.location, row.timestamp, bytes(row.value)) == ("b", "Đường", None, b"x")


@pytest.mark.parametrize("text, cam_id, volume", [
    ("{bad", None, None),
    ('{"cam_id":"a","traffic_volume":"7"}', "a", None),
    ('{"cam_id":"a","traffic_volume":7.5}', "a", None),
    (None, None, None),
    ('{"cam_id":"a","traffic_volume":5,"detail":{"car":5}}', "a", 5),
])
def test_decode(spark, text, cam_id, volume):
    row = decode(spark.createDataFrame([(text,)], "value string"), OBSERVATION).first()
    assert (row.cam_id, row.traffic_volume) == (cam_id, volume)


def test_bad_records_are_split_off(spark):
    at = '"timestamp":"2025-01-01T00:00:30.123456+00:00"'
    texts = ["{bad", None, '{"cam_id":"",%s}' % at, '{"cam_id":"a","timestamp":"None"}',
             '{"cam_id":"a",%s,"traffic_volume":"many"}' % at, '{"cam_id":"a",%s,"traffic_volume":3}' % at]
    messages = spark.createDataFrame(list(enumerate(texts)), "n int, value string")
    good, bad = ingest.split_bad_records(messages, keep=["n"])
    assert {r.n: r.bad_reason for r in bad.collect()} == {
        0: "malformed", 1: "no_camera", 2: "no_camera", 3: "bad_time"}
    assert {r.n: r.traffic_volume for r in good.collect()} == {4: None, 5: 3}


def test_time_parsing_never_fails(spark):
    rows = spark.createDataFrame([("2025-01-01T00:00:30.123456+00:00",), ("garbage",), ("None",)], "x string")
    got = [r.t for r in rows.select(parse_time(F.col("x")).alias("t")).collect()]
    assert got == [datetime(2025, 1, 1, 0, 0, 30, 123456), None, None]


def test_encode_leaves_nulls_out_and_names_the_zone(spark):
    with session_settings(spark, {"spark.sql.session.timeZone": "Asia/Ho_Chi_Minh"}):
        rows = spark.sql("SELECT 'k' AS k, timestamp'2025-01-01 20:00:00' AS ts, "
                         "cast(null AS string) AS n, 2.0D AS v, true AS b")
        row = encode(rows, "k", ["ts", "n", "v", "b"]).first()
    assert (row.key, row.value) == ("k", '{"ts":"2025-01-01T20:00:00.000+07:00","v":2.0,"b":true}')


def test_calendar(spark):
    with session_settings(spark, {"spark.sql.session.timeZone": "Asia/Ho_Chi_Minh"}):
        row = spark.sql("SELECT timestamp'2025-01-01 20:00:00' AS ts")
        ours = row.select(*[c.alias(n) for n, c in calendar_features(F.col("ts")).items()]).first()
        legacy = row.select(*[c.alias(n) for n, c in legacy_calendar_features(F.col("ts")).items()]).first()
    assert ours.dayofweek == 2 and legacy.dayofweek == 5
    assert ours.hour_sin == pytest.approx(-0.8660254) and ours.hour_cos == pytest.approx(0.5)
    assert legacy.hour_sin == pytest.approx(0.70710678) and legacy.hour_cos == pytest.approx(0.70710678)


def test_frame_messages_give_the_time_in_utc(spark):
    with session_settings(spark, {"spark.sql.session.timeZone": "Asia/Ho_Chi_Minh"}):
        frames = spark.sql("SELECT 'a' AS cam_id, 'here' AS location, timestamp'2025-01-01 07:00:00.5' AS timestamp, "
                           "cast('x' AS binary) AS value")
        (row,) = ingest.flatten_frames(ingest.frame_messages(frames)).collect()
    assert row.timestamp == "2025-01-01T00:00:00.500000+00:00"


def test_topic_round_trip(spark):
    topics = DirectoryTopics(spark, fresh_dir(spark, "topics"))
    topics.publish(spark.createDataFrame([("k", "v1")], "key string, value string").coalesce(1), "one")
    topics.publish(spark.createDataFrame([("k", "v2", 7)], "key string, value string, offset long"), "two")
    rows = topics.read(["one", "two"])
    assert rows.schema.fieldNames() == TOPIC_ROW.fieldNames()
    assert {(bytes(r.value), r.topic, r.offset) for r in rows.collect()} == {(b"v1", "one", None), (b"v2", "two", 7)}
    # called as a broker's stream is
    assert topics.stream("one", starting="earliest", per_trigger=5, headers=True, tolerate_loss=True).isStreaming
    with pytest.raises(ValueError):
        topics.stream("one", starting="latest")


def test_kafka_options(spark):
    kafka = KafkaTopics(spark, "broker:9092", **{"compression.type": "lz4"})
    assert kafka.source_options("a", group="g")["groupIdPrefix"] == "g"
    options = kafka.source_options(["a", "b"], starting="earliest", per_trigger=50, headers=True, tolerate_loss=True)
    assert options == {
        "kafka.bootstrap.servers": "broker:9092", "kafka.compression.type": "lz4", "subscribe": "a,b",
        "startingOffsets": "earliest", "maxOffsetsPerTrigger": "50", "includeHeaders": "true",
        "failOnDataLoss": "false"}


def test_shared_folder(spark):
    def session(**settings):
        return SimpleNamespace(conf=SimpleNamespace(get=lambda name, *default: settings.get(name, *default)))

    assert shared_dir(session(**{"spark.checkpoint.dir": "hdfs:///shared/"})) == "hdfs:///shared"
    assert shared_dir(session(**{"spark.sql.warehouse.dir": "hdfs:///warehouse"})) == "hdfs:///warehouse/_intermediate"
    assert fresh_dir(spark, "x").startswith(spark.conf.get("spark.checkpoint.dir"))
