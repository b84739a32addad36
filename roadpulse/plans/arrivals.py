"""Queries on how messages arrive: bad ones, late ones, lost ones, new ones only, and images from files."""

import math

from pyspark.sql import functions as F

from roadpulse.functions.collections import map_total
from roadpulse.operators import ingest, scoring
from roadpulse.plans import tables
from roadpulse.plans.batch import TOPICS, partly_broken
from roadpulse.plans.detector import StripeDetector
from roadpulse.plans.results import clean, counts_text
from roadpulse.plans.streams import run
from roadpulse.session import fresh_dir
from roadpulse.sources.files import backfill_frames, list_files, stream_parquet, write_texts, written
from roadpulse.sources.paths import Folder
from roadpulse.sources.topics import DirectoryTopics
from roadpulse.streaming import inspection, jobs
from roadpulse.streaming.screening import Screen

PARTS = 4
FRAMES = "traffic-volume"
LATEST_FILES = 100  # of a whole table, about


def _part(time):
    """Which of four parts an event of January belongs to, eight days each."""
    return F.least(F.lit(PARTS - 1), F.floor((F.dayofmonth(time) - 1) / 8)).cast("int")


def _forget_batch(spark, checkpoint: str, batch_id: int) -> None:
    """A checkpoint as it is when a batch was planned and its end was not noted."""
    commits = Folder(spark, f"{checkpoint}/commits")
    for name in (str(batch_id), f".{batch_id}.crc"):
        commits.delete(name)


def _raw_topic(spark, messages):
    """A topic of messages with `event_id` and `ts`, published in four parts in order of time."""
    root = fresh_dir(spark, "arrivals")
    topics = DirectoryTopics(spark, f"{root}/topics")
    rows = messages.withColumn("offset", F.col("event_id")).withColumn("__part", _part("ts"))
    for part in range(PARTS):
        topics.publish_once(rows.filter(F.col("__part") == part).repartition(1, "__part"), "traffic-raw", f"part-{part}")
    return topics, root


def _observation_messages(spark, sf_dir):
    observed = tables.observations(spark, sf_dir)
    return ingest.encode_observations(observed, keep=["event_id", F.col("timestamp").alias("ts")])


def bad_record_stream(spark, sf_dir):
    """Four batches told apart on arrival; the last one runs twice."""
    times = tables.events(spark, sf_dir).select("event_id", "ts")
    topics, root = _raw_topic(spark, partly_broken(spark, sf_dir).join(times, "event_id"))
    screen = Screen(topics, "usable", "bad")
    for again in (False, True):
        if again:
            _forget_batch(spark, f"{root}/checkpoint", PARTS - 1)
        messages = topics.stream("traffic-raw", per_trigger=1)
        jobs.start(screen.writer(messages), messages, f"{root}/checkpoint", "available now").awaitTermination()
    good = topics.read("usable").select(F.col("offset").alias("event_id"), F.lit("").alias("bad_reason"))
    return good.unionByName(screen.bad_records().select(F.col("offset").alias("event_id"), "bad_reason"))


def counter_stream(spark, sf_dir):
    """Counts of each frame of a topic of bare payloads, by a query that keeps no checkpoint."""
    root = fresh_dir(spark, "counter")
    topics = DirectoryTopics(spark, f"{root}/topics")
    bare = tables.vector_frames(spark, sf_dir).select(F.lit(None).cast("string").alias("key"), "value", "offset")
    topics.publish(bare, FRAMES)
    counted = jobs.count(topics.stream(FRAMES), StripeDetector(), keep=["offset"])

    def keep(rows, batch_id):
        rows.write.mode("overwrite").parquet(f"{root}/counts/{batch_id}")

    jobs.start(counted.writeStream.foreachBatch(keep), counted, None, "available now").awaitTermination()
    rows = spark.read.schema(counted.schema).parquet(f"{root}/counts/*")
    return rows.select("offset", counts_text(F.col("counts")).alias("counts"), map_total(F.col("counts")).alias("total"))


def batch_score_workers(spark, sf_dir):
    """Frames scored by a detector in tasks, in batches of 20 images, with the model loaded once per worker."""
    frames = ingest.flatten_frames(tables.vector_frames(spark, sf_dir), keep=["offset"])
    rows = scoring.observe(scoring.score_frames(frames, StripeDetector(), spark.sparkContext.defaultParallelism))
    return rows.select("offset", "cam_id", "location", counts_text(F.col("detail")).alias("detail"), "traffic_volume")


def latest_start_stream(spark, sf_dir):
    """A stream that starts at the latest message sees what is published from then on, also while it is down.

    A larger table comes in larger files and batches, not in more of them: each batch goes over the list of all files.
    """
    root = fresh_dir(spark, "latest")
    per_file = max(1000, math.ceil(tables.events(spark, sf_dir).count() / LATEST_FILES))
    topics = DirectoryTopics(spark, f"{root}/topics", messages_per_file=per_file)
    rows = _observation_messages(spark, sf_dir).withColumn("offset", F.col("event_id"))
    for part in range(PARTS):
        topics.publish(rows.filter(_part("ts") == part), "traffic-raw")
        if part in (1, 3):  # down while the third part comes
            stream = topics.stream("traffic-raw", starting="latest", group="averages", per_trigger=4 * per_file)
            new = stream.select(F.col("offset").alias("event_id"), F.col("key").cast("string").alias("cam_id"))
            run(new.writeStream.format("parquet").option("path", f"{root}/new"), new, f"{root}/checkpoint")
    return spark.read.schema("event_id bigint, cam_id string").parquet(f"{root}/new")


def lost_files_stream(spark, sf_dir):
    """The file of the second batch goes after that batch was listed; the others arrive all the same."""
    topics, root = _raw_topic(spark, _observation_messages(spark, sf_dir))
    topic = Folder(spark, topics.path("traffic-raw"))

    def keep(rows, batch_id):
        for name in topic.names() if batch_id == 1 else ():
            if name.startswith("part-1-"):
                topic.delete(name)
        rows.write.mode("overwrite").parquet(f"{root}/seen/{batch_id}")

    seen = topics.stream("traffic-raw", per_trigger=1, tolerate_loss=True).select(F.col("offset").alias("event_id"))
    jobs.start(seen.writeStream.foreachBatch(keep), seen, f"{root}/checkpoint", "available now").awaitTermination()
    return spark.read.schema("event_id bigint").parquet(f"{root}/seen/*")


def _event_parts(spark, sf_dir, late: bool):
    """Events in a file for each part; with `late`, the first event of each camera once more in the third and fourth."""
    path = fresh_dir(spark, "events")
    events = tables.events(spark, sf_dir)
    if late:
        first = events.groupBy((F.col("user_id") % tables.CAMERAS).alias("camera")).agg(
            F.min_by(F.struct(*events.columns), F.struct("ts", "event_id")).alias("e")).select("e.*")
    for part in range(PARTS):
        rows = events.filter(_part("ts") == part)
        if late and part >= 2:
            rows = rows.unionByName(first)
        rows.repartition(1, F.lit(0)).write.mode("append").parquet(path)
    return stream_parquet(spark, path, tables.EVENTS_SCHEMA, per_trigger=1)


def _averages(spark, sf_dir, events):
    observed = tables.observe_events(inspection.count_arrivals(events), tables.registry(spark, sf_dir))
    return inspection.count_written(jobs.aggregate(ingest.encode_observations(observed), "1 hour"))


def late_rows_stream(spark, sf_dir):
    """Rows in, late and written of each batch of the averaging job."""
    root = fresh_dir(spark, "late")
    topics = DirectoryTopics(spark, f"{root}/topics")
    averages = _averages(spark, sf_dir, _event_parts(spark, sf_dir, late=True))
    counts = inspection.BatchCounts()
    spark.streams.addListener(counts)
    try:
        query = jobs.start(topics.writer(averages, TOPICS[0]), averages, f"{root}/checkpoint", "available now",
                           state_partitions=spark.sparkContext.defaultParallelism)
        query.awaitTermination()
        rows = counts.of(query)
    finally:
        spark.streams.removeListener(counts)
    return spark.createDataFrame(rows, "batch bigint, arrived bigint, late bigint, written bigint")


def restart_from_scratch_stream(spark, sf_dir):
    """Windows that are open at the end, in the state of a query and in that of its second generation."""
    root = fresh_dir(spark, "generations")
    topics = DirectoryTopics(spark, f"{root}/topics")
    events = _event_parts(spark, sf_dir, late=False)
    held = []
    for number in (0, 1):
        checkpoint = inspection.generation(f"{root}/checkpoint", number)
        averages = jobs.aggregate(ingest.encode_observations(tables.observe_events(events, tables.registry(spark, sf_dir))), "1 hour")
        run(topics.writer(averages, f"{TOPICS[0]}-{number}"), averages, checkpoint)
        windows = inspection.open_windows(spark, checkpoint)
        held.append(windows.select(F.lit(number).alias("generation"), "cam_id", F.col("window.start").alias("window_start")))
    return clean(held[0].unionByName(held[1]))


def image_backfill(spark, sf_dir):
    """Every vector as an image file, asked for with some files that are not there, for all cameras in one call."""
    root = fresh_dir(spark, "images")
    frames = tables.vector_frames(spark, sf_dir)
    named = frames.select(F.col("key").cast("string").alias("cam_id"), F.col("offset").alias("vec_id"), F.col("value").cast("string").alias("value"))
    write_texts(named, ["cam_id", "vec_id"], f"{root}/images")
    listed = (list_files(spark, f"{root}/images", contents=False)
              .select("path", F.regexp_extract("path", "cam_id=([^/]+)", 1).alias("cam_id"), F.regexp_extract("path", "vec_id=([0-9]+)", 1).cast("bigint").alias("vec_id")))
    gone = (spark.read.parquet(f"{sf_dir}/embeddings.parquet").filter("label = 5")
            .select(F.concat(F.lit(f"{root}/images/no-"), "vec_id").alias("path"), tables.camera_id(F.col("vec_id") % tables.CAMERAS).alias("cam_id"), "vec_id"))
    asked = written(listed.unionByName(gone).withColumn("location", F.concat(F.lit("at "), "cam_id")), "asked")
    sent, rejected = backfill_frames(asked, f"{root}/images", scoring.decodable(StripeDetector()))
    taken = ingest.flatten_frames(sent, keep=["path"]).select(
        F.regexp_extract("path", "vec_id=([0-9]+)", 1).cast("bigint").alias("vec_id"), "cam_id", "location", F.lit("sent").alias("outcome"))
    return taken.unionByName(rejected.select("vec_id", "cam_id", "location", F.col("reason").alias("outcome")))


QUERIES = {f.__name__: f for f in (
    bad_record_stream, counter_stream, batch_score_workers, latest_start_stream, lost_files_stream, late_rows_stream,
    restart_from_scratch_stream, image_backfill,
)}
