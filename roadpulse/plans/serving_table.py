"""Queries on what is held of each camera: the serving table's buckets, and state of a stream."""

from functools import reduce

from pyspark.sql import DataFrame, functions as F

from roadpulse.operators.serving import camera_documents, serving_entries
from roadpulse.plans import tables
from roadpulse.plans.batch import TOPICS, document_rows
from roadpulse.session import fresh_dir
from roadpulse.sources.topics import DirectoryTopics
from roadpulse.streaming import jobs
from roadpulse.streaming.keyed_state import camera_lists, held_entries
from roadpulse.streaming.upsert import ServingTable

# One camera with messages, one that is registered only, and one that is neither.
ASKED = ("cam_003", "cam_012", "cam_999")


def camera_document(spark, sf_dir):
    """Single cameras' documents out of a table of all messages, each from its own bucket."""
    messages = tables.serving_messages(tables.events(spark, sf_dir), tables.registry(spark, sf_dir))
    table = ServingTable(spark, fresh_dir(spark, "serving"), *TOPICS)
    table.upsert(messages, 0)
    cameras = tables.registry(spark, sf_dir)
    return document_rows(reduce(DataFrame.unionByName, [table.document(cam, cameras) for cam in ASKED]))


def serving_state_stream(spark, sf_dir):
    """The cameras' lists as state of a stream that ends and starts again; the rows are read from the state."""
    root = fresh_dir(spark, "state")
    topics = DirectoryTopics(spark, f"{root}/topics")
    messages = tables.serving_messages(tables.events(spark, sf_dir), tables.registry(spark, sf_dir))
    middle = messages.agg(F.percentile_approx("offset", 0.5).alias("m")).first().m or 0
    for part in (F.col("offset") <= middle, F.col("offset") > middle):
        for topic in TOPICS:
            topics.publish(messages.filter(part & (F.col("topic") == topic)), topic)
        states = camera_lists(serving_entries(topics.stream(TOPICS), *TOPICS))
        jobs.start(states.writeStream.format("noop"), states, f"{root}/checkpoint", "available now",
                   state_partitions=spark.sparkContext.defaultParallelism, rocksdb=True, mode="update").awaitTermination()
    return document_rows(camera_documents(held_entries(spark, f"{root}/checkpoint"), tables.registry(spark, sf_dir)))


QUERIES = {f.__name__: f for f in (camera_document, serving_state_stream)}
