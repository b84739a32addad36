"""Queries that run streaming jobs to the end of the given tables."""

import math

from pyspark.sql import functions as F

from roadpulse.functions.envelope import decode
from roadpulse.operators import ingest
from roadpulse.operators.scoring import observe, spread
from roadpulse.operators.serving import serving_entries
from roadpulse.plans import tables
from roadpulse.plans.batch import TOPICS, document_rows
from roadpulse.plans.results import clean, counts_text, history_text
from roadpulse.schemas import AGGREGATE
from roadpulse.session import fresh_dir
from roadpulse.sources.files import stream_parquet
from roadpulse.sources.topics import DirectoryTopics
from roadpulse.streaming import jobs
from roadpulse.streaming.upsert import ServingTable


def run(writer, df, checkpoint):
    """Run a query over all input there is; state is spread over the cores."""
    cores = df.sparkSession.sparkContext.defaultParallelism
    jobs.start(writer, df, checkpoint, "available now", state_partitions=cores).awaitTermination()


PARTS, TASK_ROWS = 4, 2_000_000
FILE_MESSAGES = 250_000  # of a topic, parsed by one task


def _arriving(spark, sf_dir):
    """The events as a stream of parts in order of time, one for each micro-batch.

    Comes twice: when half of the parts are there, and when all are, for a query that ends and starts again
    from its checkpoint. The first event comes once more with the last part, far too late.
    """
    events = spark.read.schema(tables.EVENTS_SCHEMA).parquet(f"{sf_dir}/events.parquet")
    at = F.col("ts").cast("timestamp").cast("double")
    found = events.agg(F.percentile_approx(at, F.lit([k / PARTS for k in range(1, PARTS)])).alias("marks"), F.count(F.lit(1)).alias("n")).first()
    part = sum((F.when(at > m, 1).otherwise(0) for m in found.marks or []), F.lit(0))
    late = events.orderBy("ts", "event_id").limit(1).withColumn("value", F.col("value") + 1_000_000)
    files = max(1, math.ceil(found.n / PARTS / TASK_ROWS))  # of each part, which is one micro-batch all the same
    path = fresh_dir(spark, "events")
    for k in range(PARTS):
        rows = events.filter(part == k)
        rows = rows.unionByName(late) if k == PARTS - 1 else rows
        rows.repartition(files).write.mode("append").parquet(path)
        if k in (PARTS // 2 - 1, PARTS - 1):
            yield stream_parquet(spark, path, tables.EVENTS_SCHEMA, per_trigger=files)


def _aggregated(spark, sf_dir):
    """Topics below a new directory, with the hourly averages of the event stream in one of them."""
    root = fresh_dir(spark, "stream")
    topics = DirectoryTopics(spark, f"{root}/topics")
    for events in _arriving(spark, sf_dir):
        observed = tables.observe_events(events, tables.registry(spark, sf_dir))
        averages = jobs.aggregate(ingest.encode_observations(observed), "1 hour")
        run(topics.writer(averages, TOPICS[0]), averages, f"{root}/checkpoint-aggregated")
    return topics, root


def tumbling_avg_stream(spark, sf_dir):
    topics, _ = _aggregated(spark, sf_dir)
    return clean(decode(topics.read(TOPICS[0]), AGGREGATE))


def sliding_history_stream(spark, sf_dir):
    """Averages and histories as two queries with a topic between them."""
    topics, root = _aggregated(spark, sf_dir)
    lists = jobs.history(topics.stream(TOPICS[0]), "5 hours", "1 hour")
    run(lists.writeStream.format("parquet").option("path", f"{root}/histories"), lists, f"{root}/checkpoint-history")
    rows = spark.read.parquet(f"{root}/histories")
    return clean(rows.select("window_start", "window_end", "cam_id", history_text(F.col("history")).alias("history")))


def monitor_stream(spark, sf_dir):
    """Frames of a topic, spread over tasks, into observation messages of another."""
    root = fresh_dir(spark, "stream")
    topics = DirectoryTopics(spark, f"{root}/topics")
    topics.publish(tables.vector_frames(spark, sf_dir), "traffic-volume")
    workers = spark.sparkContext.defaultParallelism
    frames = spread(ingest.flatten_frames(topics.stream("traffic-volume", per_trigger=50)), workers)
    scored = frames.withColumn("detections", tables.striped_detections(F.col("value"))).drop("value")
    observed = ingest.encode_observations(observe(scored))
    run(topics.writer(observed, "traffic-raw"), observed, f"{root}/checkpoint-monitor")
    rows = ingest.decode_observations(topics.read("traffic-raw"))
    return clean(rows.select("cam_id", "location", "timestamp", counts_text(F.col("detail")).alias("detail"),
                             "traffic_volume"))


def frame_rate_cap_stream(spark, sf_dir):
    """Slots in which a frame was let through, at one per camera in ten minutes."""
    root = fresh_dir(spark, "stream")
    for events in _arriving(spark, sf_dir):
        observed = tables.observe_events(events, tables.registry(spark, sf_dir))
        capped = ingest.cap_frame_rate_stream(observed, fps=1 / 600)
        run(capped.writeStream.format("parquet").option("path", f"{root}/capped"), capped, f"{root}/checkpoint-cap")
    rows = spark.read.parquet(f"{root}/capped")
    return clean(rows.select("cam_id", F.window("timestamp", "10 minutes")["start"].alias("slot")))


def _published(spark, sf_dir):
    """Topics of the serving messages, in parts in order of offset, and the number of files of a part in each topic."""
    root = fresh_dir(spark, "stream")
    topics = DirectoryTopics(spark, f"{root}/topics")
    events, places = tables.events(spark, sf_dir), tables.registry(spark, sf_dir)
    found = events.agg(F.percentile_approx("event_id", F.lit([k / PARTS for k in range(1, PARTS)])).alias("marks"), F.count(F.lit(1)).alias("n")).first()
    bound = found.marks or []
    files = max(1, math.ceil(found.n / PARTS / FILE_MESSAGES))
    for low, high in zip([None, *bound], [*bound, None]):
        keep = (F.col("event_id") > low if low is not None else F.lit(True)) & (F.col("event_id") <= high if high is not None else F.lit(True))
        # events are dealt to the files, as they are smaller than their messages
        messages = tables.serving_messages((events.filter(keep) if bound else events).repartition(files), places)
        for topic in TOPICS:
            topics.publish(messages.filter(F.col("topic") == topic), topic)
    return topics, root, files


def topic_dispatch(spark, sf_dir):
    """One stream over two topics, told apart by topic."""
    topics, root, _ = _published(spark, sf_dir)
    entries = serving_entries(topics.stream(TOPICS), *TOPICS).select("cam_id", "kind", "time_key")
    run(entries.writeStream.format("parquet").option("path", f"{root}/entries"), entries, f"{root}/checkpoint-entries")
    rows = spark.read.parquet(f"{root}/entries")
    return clean(rows.groupBy("cam_id", "kind").agg(F.count(F.lit(1)).alias("n"), F.max("time_key").alias("last_time")))


def serving_upsert_stream(spark, sf_dir):
    """The serving table kept by a stream over both topics, in a micro-batch for each part, be it of many files."""
    topics, root, files = _published(spark, sf_dir)
    messages = topics.stream(TOPICS, per_trigger=files)
    table = ServingTable(spark, f"{root}/serving", *TOPICS)
    run(table.writer(messages), messages, f"{root}/checkpoint-serving")
    return document_rows(table.documents(tables.registry(spark, sf_dir)))


QUERIES = {f.__name__: f for f in (
    tumbling_avg_stream, sliding_history_stream, monitor_stream, frame_rate_cap_stream, topic_dispatch,
    serving_upsert_stream,
)}
