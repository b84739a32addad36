import json
import random
from datetime import datetime, timedelta

import pytest
from pyspark.sql import functions as F

from roadpulse.functions.envelope import decode
from roadpulse.operators import model, serving
from roadpulse.operators.detections import COUNTER_CONFIDENCE
from roadpulse.operators.features import FeatureSpec
from roadpulse.operators.ingest import cap_frame_rate, cap_frame_rate_stream, decode_observations, frame_messages
from roadpulse.operators.scoring import observe, score_frames
from roadpulse.operators.serving import locate
from roadpulse.operators.windows import average_volume, closed_windows
from roadpulse.schemas import AGGREGATE, FORECAST
from roadpulse.session import fresh_dir
from roadpulse.sources.files import stream_parquet
from roadpulse.sources.registry import camera_list, registry
from roadpulse.sources.topics import DirectoryTopics
from roadpulse.streaming import jobs
from roadpulse.streaming.upsert import ServingTable, bucket_of
from tests.detectors import VectorDetector
from tests.test_features import training_table

DAY = datetime(2025, 1, 1)
HISTORY, FORECASTS = "traffic-aggregated", "traffic-forecast"


def observations(*rows):
    return [json.dumps({"cam_id": c, "location": "x", "timestamp": f"2025-01-01T{t}+00:00", "traffic_volume": v})
            for c, t, v in rows]


BATCHES = [
    observations(("a", "00:00:10", 4), ("a", "00:00:50", 6), ("b", "00:00:20", None)),
    observations(("a", "00:01:05", 8)),
    observations(("a", "00:00:59", 100)),
    observations(("a", "00:01:30", 2)),
    observations(("a", "00:00:30", 999), ("a", "00:07:00", 1)),
    observations(("a", "00:20:00", 1)),
]


class Pipe:
    """Topics and checkpoints below one new directory."""

    def __init__(self, spark):
        self.spark = spark
        self.root = fresh_dir(spark, "pipe")
        self.topics = DirectoryTopics(spark, f"{self.root}/topics")

    def publish(self, topic, values, **columns):
        df = self.spark.createDataFrame([(v,) for v in values], "value string").coalesce(1)
        self.topics.publish(df.withColumn("key", F.lit(None).cast("string")).withColumns(columns), topic)

    def run(self, df, topic, trigger="available now", **how):
        query = jobs.start(self.topics.writer(df, topic), df, f"{self.root}/checkpoint-{topic}", trigger,
                           state_partitions=2, **how)
        query.awaitTermination()

    def averages(self):
        rows = decode(self.topics.read(HISTORY), AGGREGATE).collect()
        return sorted((r.start_time, r.cam_id, r.avg_traffic_volume) for r in rows)


def at(minute):
    return DAY + timedelta(minutes=minute)


@pytest.mark.parametrize("rocksdb", [False, True])
def test_watermark_over_batches(spark, rocksdb):
    pipe = Pipe(spark)
    for batch in BATCHES:
        pipe.publish("traffic-raw", batch)
    stream = pipe.topics.stream("traffic-raw", per_trigger=1)
    pipe.run(jobs.aggregate(stream), HISTORY, rocksdb=rocksdb)
    assert pipe.averages() == [(at(0), "a", 277.25), (at(0), "b", None), (at(1), "a", 5.0), (at(7), "a", 1.0)]


def test_restart_adds_no_window_twice(spark):
    pipe = Pipe(spark)
    for batch in BATCHES:
        pipe.publish("traffic-raw", batch)
        pipe.run(jobs.aggregate(pipe.topics.stream("traffic-raw")), HISTORY)
    windows = [(start, cam) for start, cam, _ in pipe.averages()]
    assert windows == [(at(0), "a"), (at(0), "b"), (at(1), "a"), (at(7), "a")]
    before = pipe.averages()
    pipe.run(jobs.aggregate(pipe.topics.stream("traffic-raw")), HISTORY)
    assert pipe.averages() == before


def test_stream_equals_batch_of_closed_windows(spark):
    rng = random.Random(3)
    times = sorted(rng.randrange(3 * 3600) for _ in range(400))
    rows = [(f"c{rng.randrange(3)}", f"{t // 3600:02}:{t // 60 % 60:02}:{t % 60:02}", rng.randrange(50)) for t in times]
    pipe = Pipe(spark)
    for i in range(0, 400, 100):
        pipe.publish("traffic-raw", observations(*rows[i:i + 100]))
    pipe.run(jobs.aggregate(pipe.topics.stream("traffic-raw", per_trigger=1)), HISTORY)
    events = decode_observations(pipe.topics.read("traffic-raw"))
    whole = closed_windows(average_volume(events), events, "10 seconds")
    want = sorted((r.start_time, r.cam_id, r.avg_traffic_volume) for r in whole.collect())
    assert pipe.averages() == want and want


def test_frames_to_forecasts(spark):
    """The three jobs in a row, on two cameras with a frame every 20 seconds."""
    pipe = Pipe(spark)
    frames = spark.range(120).select(
        F.concat(F.lit("cam_"), F.col("id") % 2).alias("cam_id"), F.lit("x").alias("location"),
        F.timestamp_seconds(F.lit(1735689600) + F.floor(F.col("id") / 2) * 20).alias("timestamp"),
        F.encode(F.lit("[0,0.9,0.9,0,0,0.9,0,0.1]"), "UTF-8").alias("value"))
    pipe.topics.publish(frame_messages(frames).coalesce(1), "traffic-volume")
    pipe.run(jobs.monitor(pipe.topics.stream("traffic-volume"), VectorDetector(), workers=2), "traffic-raw")
    first = decode_observations(pipe.topics.read("traffic-raw")).first()
    assert first.detail == {"bicycle": 1, "car": 1, "bus": 1} and first.traffic_volume == 3
    pipe.run(jobs.aggregate(pipe.topics.stream("traffic-raw")), HISTORY)
    averages = pipe.averages()
    assert len(averages) == 2 * 19 and {v for _, _, v in averages} == {3.0}
    fitted = model.train(training_table(spark), trees=2)
    pipe.run(jobs.forecast(pipe.topics.stream(HISTORY), fitted), FORECASTS)
    rows = decode(pipe.topics.read(FORECASTS), FORECAST).collect()
    # The last average ends at 00:19, so windows up to 00:18 are closed.
    assert {r.base_time_t for r in rows} == {at(m) for m in range(2, 19)} and len(rows) == 34
    assert {r.is_padded for r in rows if r.base_time_t < at(6)} == {True}
    assert {r.is_padded for r in rows if r.base_time_t >= at(6)} == {False}


def test_interval_trigger(spark):
    pipe = Pipe(spark)
    pipe.publish("traffic-raw", BATCHES[0] + BATCHES[5])
    df = jobs.aggregate(pipe.topics.stream("traffic-raw"))
    query = jobs.start(pipe.topics.writer(df, HISTORY), df, f"{pipe.root}/checkpoint", "1 second", state_partitions=2)
    try:
        query.processAllAvailable()
    finally:
        query.stop()
    assert pipe.averages() == [(at(0), "a", 5.0), (at(0), "b", None)]


def test_chained_in_one_query_the_windows_shift(spark):
    """Why the jobs keep a topic between them: the time of a window is a microsecond before its end."""
    pipe = Pipe(spark)
    pipe.publish("traffic-raw", observations(("a", "00:00:10", 4)))
    batch = decode_observations(pipe.topics.read("traffic-raw"))
    ends = batch.groupBy(F.window("timestamp", "1 minute")).count().select(F.window_time("window").alias("end_time"))
    first = ends.select(F.min(F.window("end_time", "5 minutes", "1 minute")["end"])).first()[0]
    ours = average_volume(batch).select(F.min(F.window("end_time", "5 minutes", "1 minute")["end"])).first()[0]
    assert ours - first == timedelta(minutes=1)


def test_console_counter(spark):
    """The counter: a map per frame on the console, with nothing kept between runs."""
    pipe = Pipe(spark)
    pipe.publish("traffic-volume", ["[0,0.9,0,0,0,0,0,0]", "broken"])
    scored = score_frames(pipe.topics.stream("traffic-volume").select("value"), VectorDetector())
    counts = observe(scored, COUNTER_CONFIDENCE, undecodable="empty").select("detail")
    query = jobs.start(jobs.console(counts), counts, None, "available now")
    query.awaitTermination()
    assert query.exception() is None and query.lastProgress["numInputRows"] == 2


def history_message(minute, value, cam="a", location="x"):
    return json.dumps({"start_time": at(minute).isoformat() + "Z", "end_time": at(minute + 1).isoformat() + "Z",
                       "cam_id": cam, "location": location, "avg_traffic_volume": value})


def forecast_message(minute, value, cam="a"):
    return json.dumps({"prediction_timestamp": at(minute).isoformat() + "Z", "base_time_t": at(minute - 5).isoformat() + "Z",
                       "cam_id": cam, "current_volume": 1.0, "predicted_volume": value, "is_padded": False})


CAMERAS = [{"camera_id": "a", "location": "Gate"}, {"camera_id": "z", "location": "Yard", "source": "z.mp4"}]


def documents(table_or_entries, spark):
    cameras = registry(spark, CAMERAS)
    rows = (table_or_entries.documents(cameras) if isinstance(table_or_entries, ServingTable)
            else serving.camera_documents(table_or_entries, cameras))
    return {r.cam_id: (r.location, [(h.start_time, h.avg_traffic_volume) for h in r.history],
                       [(f.prediction_timestamp, f.predicted_volume) for f in r.forecast]) for r in rows.collect()}


def merged(spark, messages, limits=(30, 288)):
    rows = [(topic, value, i) for i, (topic, value) in enumerate(messages)]
    df = spark.createDataFrame(rows, "topic string, value string, offset long").withColumn("timestamp", F.lit(DAY))
    return serving.merge_entries(serving.serving_entries(df, HISTORY, FORECASTS), *limits)


def test_serving_lists(spark):
    messages = [(HISTORY, history_message(m, v)) for m, v in ((0, 1.0), (2, 3.0), (1, 2.0), (0, 9.0))]
    messages += [(FORECASTS, forecast_message(m, 5.0)) for m in (3, 4)]
    messages += [(FORECASTS, forecast_message(3, 7.0, "new")), (HISTORY, "{bad"), (HISTORY, '{"cam_id":"a"}'),
                 (HISTORY, history_message(0, 1.0, "")), ("other", history_message(9, 9.0))]
    got = documents(merged(spark, messages, (2, 288)), spark)
    assert got == {
        "a": ("x", [(at(1), 2.0), (at(2), 3.0)], [(at(4), 5.0)]),
        "new": ("Unknown", [], [(at(3), 7.0)]),
        "z": ("Yard", [], []),
    }
    assert camera_list(registry(spark, CAMERAS)).collect()[1].asDict() == {"id": "z", "location": "Yard"}


def test_last_message_gives_the_location_even_if_its_row_is_cut(spark):
    messages = [(HISTORY, history_message(m, 1.0)) for m in (5, 6)] + [(HISTORY, history_message(0, 1.0, location="y"))]
    assert documents(merged(spark, messages, (2, 288)), spark)["a"][0] == "y"


def plain_serving(messages, limits):
    """The same, message by message in plain Python."""
    state = {}
    for topic, value in messages:
        data = json.loads(value)
        history, ahead = state.setdefault(data["cam_id"], ({}, {}))
        if topic == HISTORY:
            history[data["start_time"]] = data["avg_traffic_volume"]
            for key in sorted(history)[:-limits[0]]:
                del history[key]
        else:
            ahead[data["prediction_timestamp"]] = data["predicted_volume"]
            for key in sorted(ahead)[:-limits[1]]:
                del ahead[key]
    return {(cam, kind): sorted(part.values()) for cam, parts in state.items()
            for kind, part in zip(("history", "forecast"), parts) if part}


def test_all_at_once_equals_one_by_one(spark):
    rng = random.Random(11)
    messages = []
    for i in range(400):
        cam = rng.choice("aab")
        messages.append((HISTORY, history_message(rng.randrange(15), float(i), cam)) if rng.random() < .5
                        else (FORECASTS, forecast_message(rng.randrange(15), float(i), cam)))
    entries = merged(spark, messages, (4, 7))
    got = {}
    for r in entries.filter("kind IN ('history', 'forecast')").collect():
        got.setdefault((r.cam_id, r.kind), []).append(r.avg_traffic_volume if r.kind == "history" else r.predicted_volume)
    assert {k: sorted(v) for k, v in got.items()} == plain_serving(messages, (4, 7))
    assert serving.merge_entries(entries, 4, 7).exceptAll(entries).count() == 0


def test_serving_table_over_batches_replays_and_generations(spark):
    pipe = Pipe(spark)
    for i, (minute, value) in enumerate(((0, 1.0), (1, 2.0), (0, 9.0), (2, 3.0), (3, 4.0))):
        pipe.publish(HISTORY, [history_message(minute, value)], offset=F.lit(i))
    pipe.publish(FORECASTS, [forecast_message(9, 5.0)])
    table = ServingTable(spark, f"{pipe.root}/serving", HISTORY, FORECASTS, buckets=4)
    stream = pipe.topics.stream([HISTORY, FORECASTS], per_trigger=1)
    jobs.start(table.writer(stream), stream, f"{pipe.root}/checkpoint", "available now").awaitTermination()
    want = {"a": ("x", [(at(0), 9.0), (at(1), 2.0), (at(2), 3.0), (at(3), 4.0)], [(at(9), 5.0)]), "z": ("Yard", [], [])}
    assert documents(table, spark) == want

    # The last batch once more changes nothing, be it done or broken off before its text was written.
    last = table._done()[-1]
    entries = table.entries().collect()
    messages = pipe.topics.read(HISTORY).filter("offset = 4")
    table.upsert(messages, int(last.split("-")[1]))
    assert table.entries().collect() == entries
    table.batches.delete(last)
    table.upsert(messages, int(last.split("-")[1]))
    assert documents(table, spark) == want and table._done()[-1] == last

    # A fresh checkpoint reads all again, on top of the old state.
    again = ServingTable(spark, f"{pipe.root}/serving", HISTORY, FORECASTS, generation=1)
    stream = pipe.topics.stream([HISTORY, FORECASTS])
    jobs.start(again.writer(stream), stream, f"{pipe.root}/checkpoint-new", "available now").awaitTermination()
    assert documents(again, spark) == want and again._newest()["buckets"] == 4


def _cameras_in_other_buckets(buckets, n):
    found = {}
    for k in range(1000):
        found.setdefault(bucket_of(f"c{k}", buckets), f"c{k}")
    return list(found.values())[:n]


def history_rows(spark, *cams, minute=0, value=1.0):
    rows = [(HISTORY, history_message(minute, value, cam), minute) for cam in cams]
    return spark.createDataFrame(rows, "topic string, value string, offset long").withColumn("timestamp", F.lit(DAY))


def test_an_upsert_writes_the_buckets_of_its_cameras(spark):
    table = ServingTable(spark, fresh_dir(spark, "serving"), HISTORY, FORECASTS, buckets=16)
    cams = _cameras_in_other_buckets(16, 5)
    table.upsert(history_rows(spark, *cams), 0)
    table.upsert(history_rows(spark, *cams[:2], minute=1, value=2.0), 1)
    second = table._done()[1]
    written = [n for n in table.data.child(second).names() if n.startswith("bucket=")]
    assert written == sorted(f"bucket={bucket_of(c, 16)}" for c in cams[:2])
    assert sorted(table._newest()["files"].values()) == [table._done()[0]] * 3 + [second] * 2
    got = documents(table, spark)
    assert got[cams[0]][1] == [(at(0), 1.0), (at(1), 2.0)] and got[cams[4]][1] == [(at(0), 1.0)]
    # a batch without messages of a camera is a batch too
    table.upsert(history_rows(spark, ""), 2)
    assert documents(table, spark) == got and len(table._done()) == 3


def test_files_go_by_age_and_a_reader_outlives_ten_batches(spark):
    path = fresh_dir(spark, "serving")
    table = ServingTable(spark, path, HISTORY, FORECASTS, buckets=2)
    cams = _cameras_in_other_buckets(2, 2)
    table.upsert(history_rows(spark, *cams), 0)
    reader = table.entries()
    for batch in range(1, 11):
        table.upsert(history_rows(spark, cams[0], minute=batch), batch)
    assert len(table._done()) == 11 and reader.filter("kind = 'history'").count() == 2

    # Once the texts are old, only what the newest names stays: the untouched bucket from the first batch.
    ServingTable(spark, path, HISTORY, FORECASTS, keep_seconds=-60).upsert(history_rows(spark, cams[0], minute=20), 11)
    assert len(table._done()) == 1
    kept = {n: [b for b in table.data.child(n).names() if b.startswith("bucket=")] for n in table.data.names()}
    assert {b for bs in kept.values() for b in bs} == {"bucket=0", "bucket=1"} and len(kept) == 2
    got = documents(table, spark)
    assert [m for m, _ in got[cams[0]][1]] == [at(m) for m in (*range(11), 20)] and got[cams[1]][1] == [(at(0), 1.0)]


def test_the_document_of_one_camera_reads_one_bucket(spark):
    table = ServingTable(spark, fresh_dir(spark, "serving"), HISTORY, FORECASTS, buckets=8)
    table.upsert(history_rows(spark, "a", "b", "c"), 0)
    cameras = registry(spark, CAMERAS)
    every = {r.cam_id: r for r in table.documents(cameras).collect()}
    for cam in ("a", "b", "z"):
        assert [r for r in table.document(cam, cameras).collect()] == [every[cam]]
    assert table.document("nobody", cameras).count() == 0
    one = table.document("a", cameras)
    plan = one._jdf.queryExecution().toString()
    assert "Join" not in plan
    assert {f.split("/bucket=")[1].split("/")[0] for f in one.inputFiles()} == {str(bucket_of("a", 8))}


def test_newest_times_are_cut_before_the_shuffle(spark):
    entries = serving.serving_entries(history_rows(spark, "a"), HISTORY, FORECASTS)
    plan = serving.newest_entries(entries, 3, 3)._jdf.queryExecution().executedPlan().toString()
    assert "WindowGroupLimit" in plan and "dense_rank" in plan and plan.count("Exchange hashpartitioning") == 1


def test_chart_points(spark):
    entries = merged(spark, [(HISTORY, history_message(0, 1.0)), (FORECASTS, forecast_message(9, 5.0))])
    docs = serving.camera_documents(entries, registry(spark, CAMERAS))
    got = {(r.cam_id, r.series, r.x, r.y) for r in serving.chart_series(docs).collect()}
    assert got == {("a", "history", at(1), 1.0), ("a", "forecast", at(9), 5.0)}


def test_rate_cap_keeps_the_first_of_a_slot(spark):
    rows = [("a", 0.1, 1), ("a", 0.9, 2), ("a", 1.0, 3), ("b", 0.5, 4), ("a", 1.4, 5), ("a", 1.6, 6)]
    df = spark.createDataFrame([(c, DAY + timedelta(seconds=s), n) for c, s, n in rows],
                               "cam_id string, timestamp timestamp, n int")
    assert {r.n for r in cap_frame_rate(df, 1).collect()} == {1, 3, 4}
    assert {r.n for r in cap_frame_rate(df, 2).collect()} == {1, 2, 3, 4, 6}


def test_one_frame_per_slot_over_many_batches(spark, tmp_path):
    """Four frames of one slot of ten minutes, each in a batch of its own, and one of the next slot."""
    source, out = str(tmp_path / "in"), str(tmp_path / "out")
    start = datetime(2025, 1, 1)
    for seconds in (5, 120, 300, 540, 700):
        (spark.createDataFrame([("c", start + timedelta(seconds=seconds))], "cam_id string, timestamp timestamp")
         .coalesce(1).write.mode("append").parquet(source))
    frames = stream_parquet(spark, source, "cam_id string, timestamp timestamp", per_trigger=1)
    capped = cap_frame_rate_stream(frames, fps=1 / 600)
    writer = capped.writeStream.format("parquet").option("path", out)
    jobs.start(writer, capped, str(tmp_path / "checkpoint"), "available now", state_partitions=2).awaitTermination()
    got = sorted(r.timestamp for r in spark.read.parquet(out).collect())
    assert got == [start + timedelta(seconds=s) for s in (5, 700)]


def test_a_job_must_use_the_lags_of_its_model(spark):
    with pytest.raises(ValueError):
        jobs.forecast(None, None, FeatureSpec(lag_step="5 minutes"), slide="1 minute")
    assert FeatureSpec(lag_step="5 minutes").history == "25 minutes" and FeatureSpec().history == "5 minutes"


def test_a_camera_that_is_registered_twice_doubles_nothing(spark):
    twice = spark.createDataFrame([("c", "b"), ("c", "a")], "camera_id string, location string")
    rows = locate(spark.createDataFrame([("c", None)], "cam_id string, location string"), twice).collect()
    assert [(r.cam_id, r.location) for r in rows] == [("c", "a")]
