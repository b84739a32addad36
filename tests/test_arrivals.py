"""Topics by place and size, screening, loss, counting and backfill."""

import json
from datetime import datetime, timedelta

import pytest
from pyspark.errors import StreamingQueryException
from pyspark.sql import functions as F

from roadpulse.functions.headers import header_text, make_headers
from roadpulse.operators.detections import COUNTER_CONFIDENCE
from roadpulse.operators.scoring import decodable, vehicle_counter
from roadpulse.plans.detector import StripeDetector
from roadpulse.session import fresh_dir, ship_package
from roadpulse.sources.files import backfill_frames
from roadpulse.sources.paths import Folder
from roadpulse.sources.topics import DirectoryTopics
from roadpulse.streaming import inspection, jobs
from roadpulse.streaming.screening import Screen
from tests.test_detections import CountingDetector
from tests.test_streaming import BATCHES, HISTORY, Pipe, observations

RAW = "traffic-raw"


def numbers(spark, *values):
    return spark.createDataFrame([("k", str(v), v) for v in values], "key string, value string, offset long").coalesce(1)


def collect(pipe, stream, name):
    """What a stream gives up to now, batch by batch."""
    batches = []
    rows = stream.select("offset")
    jobs.start(rows.writeStream.foreachBatch(lambda df, _: batches.append(sorted(r.offset for r in df.collect()))), rows,
               f"{pipe.root}/checkpoint-{name}", "available now").awaitTermination()
    return batches


def test_latest_is_after_the_group_first_asked(spark):
    pipe = Pipe(spark)
    pipe.topics.publish(numbers(spark, 1, 2), RAW)
    assert collect(pipe, pipe.topics.stream(RAW, starting="latest", group="a"), "a") in ([], [[]])
    pipe.topics.publish(numbers(spark, 3), RAW)
    assert sum(collect(pipe, pipe.topics.stream(RAW, starting="latest", group="a"), "a"), []) == [3]
    # another group starts where it first asks; the place holds without a checkpoint, and whatever is asked later
    late = pipe.topics.stream(RAW, starting="latest", group="b")
    pipe.topics.publish(numbers(spark, 4), RAW)
    assert sum(collect(pipe, late, "b"), []) == [4]
    assert sum(collect(pipe, pipe.topics.stream(RAW, starting="earliest", group="a"), "a-again"), []) == [3, 4]
    assert sum(collect(pipe, pipe.topics.stream(RAW, starting="earliest", group="c"), "c"), []) == [1, 2, 3, 4]
    assert sum(collect(pipe, pipe.topics.stream(RAW), "none"), []) == [1, 2, 3, 4]


def test_latest_of_a_topic_without_messages_is_all_that_comes(spark):
    pipe = Pipe(spark)
    Folder(spark, pipe.topics.path(RAW)).make()
    stream = pipe.topics.stream(RAW, starting="latest", group="a")
    pipe.topics.publish(numbers(spark, 1), RAW)
    assert sum(collect(pipe, stream, "a"), []) == [1]


@pytest.mark.parametrize("how", [{"starting": "latest"}, {"starting": "tomorrow", "group": "a"}])
def test_places_that_are_none(spark, how):
    with pytest.raises(ValueError):
        Pipe(spark).topics.stream(RAW, **how)


def test_a_limit_of_messages_per_trigger(spark):
    pipe = Pipe(spark)
    topics = DirectoryTopics(spark, f"{pipe.root}/limited", messages_per_file=5)
    topics.publish(numbers(spark, *range(23)), RAW)
    batches = collect(pipe, topics.stream(RAW, per_trigger=10), "limited")
    assert [len(b) for b in batches if b] == [10, 10, 3] or max(map(len, batches)) <= 10
    assert sorted(sum(batches, [])) == list(range(23))
    # the writer of a stream keeps to it as well
    df = topics.stream(RAW).select(F.col("key"), F.col("value"), "offset")
    jobs.start(topics.writer(df, "copy"), df, f"{pipe.root}/checkpoint-copy", "available now").awaitTermination()
    assert max(map(len, collect(pipe, topics.stream("copy", per_trigger=5), "copied"))) <= 5


def test_publishing_once(spark):
    topics = DirectoryTopics(spark, fresh_dir(spark, "once"))
    topics.publish_once(numbers(spark, 1, 2), RAW, "first")
    topics.publish_once(numbers(spark, 7), RAW, "first")
    assert sorted(r.offset for r in topics.read(RAW).collect()) == [1, 2]
    # broken off after the first of two files was moved: the rest of the same files follows, whatever is given now
    staged = Folder(spark, f"{topics.root}/_staged/{RAW}").child("second")
    topics.publish(numbers(spark, 3).unionByName(numbers(spark, 4)).repartition(2, "offset"), "aside")
    files = [n for n in Folder(spark, topics.path("aside")).names() if n.startswith("part-")]
    assert len(files) == 2
    for k, name in enumerate(files):
        into, new = (Folder(spark, topics.path(RAW)), f"second-{name}") if k == 0 else (staged, name)
        Folder(spark, topics.path("aside")).move(name, into, new)
    staged.write("_SUCCESS", "")
    topics.publish_once(numbers(spark, 8, 9), RAW, "second")
    assert sorted(r.offset for r in topics.read(RAW).collect()) == [1, 2, 3, 4]


def forget(spark, checkpoint, batch):
    commits = Folder(spark, f"{checkpoint}/commits")
    commits.delete(str(batch))
    commits.delete(f".{batch}.crc")


def test_bad_messages_go_aside_with_their_reason(spark):
    pipe = Pipe(spark)
    good = observations(("a", "00:00:10", 4), ("a", "00:00:50", 6))
    pipe.publish(RAW, [good[0], "{bad"], offset=F.lit(1))
    pipe.publish(RAW, [good[1], '{"cam_id":"","timestamp":"2025-01-01T00:00:00+00:00"}'], offset=F.lit(2))
    marked = spark.createDataFrame([("k", '{"cam_id":"a","timestamp":"None"}', 3)], "key string, value string, offset long")
    pipe.topics.publish(marked.withColumn("headers", make_headers(site=F.lit("north"))), RAW)
    screen = Screen(pipe.topics, "usable", "bad")

    def run():
        messages = pipe.topics.stream(RAW, per_trigger=1)
        jobs.start(screen.writer(messages), messages, f"{pipe.root}/checkpoint", "available now").awaitTermination()

    for again in (None, 2, 0):
        if again is not None:
            last = max(int(n) for n in Folder(spark, f"{pipe.root}/checkpoint/commits").names() if n.isdigit())
            forget(spark, f"{pipe.root}/checkpoint", last)
        run()
        assert sorted(r.value.decode() for r in pipe.topics.read("usable").collect()) == sorted(good)
        assert {(r.offset, r.bad_reason) for r in screen.bad_records().collect()} == {(1, "malformed"), (2, "no_camera"), (3, "bad_time")}
        assert screen.bad_records().count() == 3
    site = pipe.topics.read("bad").filter("offset = 3").select(header_text(F.col("headers"), "site").alias("s"), F.col("key").cast("string").alias("k")).first()
    assert (site.s, site.k) == ("north", "k")
    # the usable topic feeds the averaging job
    pipe.run(jobs.aggregate(pipe.topics.stream("usable")), HISTORY)
    assert pipe.topics.read("usable").schema == pipe.topics.read(RAW).schema


@pytest.mark.parametrize("tolerate", [True, False])
def test_a_listed_file_that_is_gone(spark, tolerate):
    """The file of the second batch goes between the listing and the reading."""
    pipe = Pipe(spark)
    for k in (1, 2, 3):
        pipe.topics.publish_once(numbers(spark, k), RAW, f"part-{k}")
    topic, seen = Folder(spark, pipe.topics.path(RAW)), []

    def keep(rows, batch_id):
        for name in topic.names():
            if batch_id == 1 and name.startswith("part-2-"):
                topic.delete(name)
        seen.extend(r.offset for r in rows.collect())

    rows = pipe.topics.stream(RAW, per_trigger=1, tolerate_loss=tolerate).select("offset")
    query = jobs.start(rows.writeStream.foreachBatch(keep), rows, f"{pipe.root}/checkpoint", "available now")
    if tolerate:
        query.awaitTermination()
        assert seen == [1, 3]
    else:
        with pytest.raises(StreamingQueryException):
            query.awaitTermination()
        assert seen == [1]


def payloads(spark, *values):
    return spark.createDataFrame([(k, None if v is None else v.encode()) for k, v in enumerate(values)], "offset long, value binary")


def image(**at):
    numbers = [0.0] * 64
    for place, value in at.items():
        numbers[int(place[1:])] = value
    return json.dumps(numbers)


def test_counts_as_a_column(spark):
    ship_package(spark)
    rows = payloads(spark, image(p8=.9, p23=.5, p40=.39, p63=.4), "broken", None, "[1]", image(p0=.9))
    got = rows.withColumn("counts", vehicle_counter(StripeDetector())("value")).orderBy("offset").collect()
    assert [r.counts for r in got] == [{"bicycle": 1, "car": 1, "truck": 1}, {}, {}, {}, {}]
    assert [r.d for r in rows.select(decodable(StripeDetector())("value").alias("d"), "offset").orderBy("offset").collect()] == [True, False, False, False, True]
    assert rows.limit(0).select(vehicle_counter(StripeDetector())("value")).collect() == []
    same = jobs.count(rows, StripeDetector(), COUNTER_CONFIDENCE, keep=["offset"])
    assert same.columns == ["offset", "counts"] and same.filter("cardinality(counts) = 3").count() == 1


def test_a_counter_without_checkpoint_starts_anew(spark):
    pipe = Pipe(spark)
    pipe.topics.publish(payloads(spark, image(p8=.9)).withColumn("key", F.lit("k")), "traffic-volume")
    for _ in range(2):
        counted = jobs.count(pipe.topics.stream("traffic-volume"), StripeDetector())
        query = jobs.start(jobs.console(counted), counted, None, "available now")
        query.awaitTermination()
        assert query.lastProgress["numInputRows"] == 1


def test_sub_batches_of_the_column_function(spark):
    rows = payloads(spark, *["x"] * 7).coalesce(1)
    counts = vehicle_counter(OneByOne(), sub_batch=3, classes={1: "one", 3: "three"})
    got = [r.c for r in rows.select(counts("value").alias("c")).collect()]
    assert sorted(map(str, got)) == sorted(map(str, [{"three": 1}] * 6 + [{"one": 1}]))


class OneByOne(CountingDetector):
    """The size of its batch as the class of each image."""

    def load(self):
        return "model"


def test_backfill_of_several_cameras(spark, tmp_path):
    for folder, names in (("north", ("1", "2")), ("south", ("1", "bad"))):
        (tmp_path / folder).mkdir()
        for name in names:
            (tmp_path / folder / f"{name}.json").write_text("broken" if name == "bad" else image(p8=.9))
    (tmp_path / "north" / "not-asked.json").write_text(image())
    asked = [(f"file:{tmp_path}/{f}/{n}.json", f"cam_{f}", f) for f, n in (("north", "1"), ("north", "2"), ("south", "1"), ("south", "bad"), ("south", "gone"))]
    asked.append(asked[0])
    table = spark.createDataFrame(asked, "path string, cam_id string, location string")
    ship_package(spark)
    sent, rejected = backfill_frames(table, [f"{tmp_path}/north", f"{tmp_path}/south"], decodable(StripeDetector()), F.lit(datetime(2025, 1, 1)))
    rows = sent.select("path", F.col("key").cast("string").alias("key"), header_text(F.col("headers"), "location").alias("location"),
                       header_text(F.col("headers"), "timestamp").alias("at")).collect()
    assert sorted((r.path.split("/")[-2:], r.key, r.location) for r in rows) == [
        (["north", "1.json"], "cam_north", "north")] * 2 + [(["north", "2.json"], "cam_north", "north"), (["south", "1.json"], "cam_south", "south")]
    assert {r["at"] for r in rows} == {"2025-01-01T00:00:00.000000+00:00"}
    assert sorted((r.path.split("/")[-1], r.reason) for r in rejected.collect()) == [("bad.json", "undecodable"), ("gone.json", "missing")]
    # the contents are not shuffled
    plan = sent._jdf.queryExecution().executedPlan().toString()
    assert "BroadcastHashJoin" in plan and "Exchange hashpartitioning" not in plan


def test_counts_of_batches(spark):
    """The batches of the watermark test: the late 999 has its window closed two batches before."""
    pipe = Pipe(spark)
    for batch in [*BATCHES, observations(("a", "00:00:05", 5), ("a", "00:21:00", 7))]:
        pipe.publish(RAW, batch)
    counted = inspection.count_written(jobs.aggregate(inspection.count_arrivals(pipe.topics.stream(RAW, per_trigger=1))))
    listener = inspection.BatchCounts()
    spark.streams.addListener(listener)
    try:
        query = jobs.start(pipe.topics.writer(counted, HISTORY), counted, f"{pipe.root}/checkpoint", "available now", state_partitions=2)
        query.awaitTermination()
        rows = listener.of(query)
    finally:
        spark.streams.removeListener(listener)
    assert [r[:3] for r in rows] == [(0, 3, 0), (1, 1, 0), (2, 1, 0), (3, 1, 0), (4, 2, 0), (5, 1, 0), (6, 2, 1), (7, 0, 0)]
    assert [r[3] for r in rows] == [0, 0, 0, 0, 2, 1, 1, 0] and sum(r[3] for r in rows) == len(pipe.averages())


def test_state_of_a_checkpoint_and_of_the_next_generation(spark):
    pipe = Pipe(spark)
    for batch in BATCHES:
        pipe.publish(RAW, batch)

    def run(number, topic):
        df = jobs.aggregate(pipe.topics.stream(RAW, per_trigger=1))
        jobs.start(pipe.topics.writer(df, topic), df, inspection.generation(f"{pipe.root}/checkpoint", number), "available now", state_partitions=2).awaitTermination()

    def windows(number, batch=None):
        rows = inspection.open_windows(spark, inspection.generation(f"{pipe.root}/checkpoint", number), batch)
        return {(r.cam_id, r.window.start) for r in rows.collect()}

    run(0, "first")
    day = datetime(2025, 1, 1)
    assert windows(0) == {("a", day + timedelta(minutes=20))}
    assert windows(0, 0) == {("a", day), ("b", day)}
    run(0, "first")  # nothing new, nothing again
    before = pipe.topics.read("first").count()
    run(1, "second")
    assert windows(1) == windows(0) and pipe.topics.read("second").count() == before == pipe.topics.read("first").count()
