"""Observation messages told apart on arrival: usable ones to one topic, bad ones with their reason to another."""

from pyspark.sql import DataFrame, functions as F
from pyspark.sql.streaming import DataStreamWriter

from roadpulse.functions.headers import header_text, make_headers
from roadpulse.operators.ingest import check_observations
from roadpulse.sources.topics import DirectoryTopics

_KEPT = ("key", "value", "headers", "offset", "sent")


class Screen:
    """Two topics from each micro-batch. A repeated batch adds nothing to either.

    Messages go on as they came, key, value, headers and offset; a bad one has its reason as one more header.
    """

    def __init__(self, topics: DirectoryTopics, good: str, bad: str):
        self.topics, self.good, self.bad = topics, good, bad

    def split(self, messages: DataFrame, batch_id: int) -> None:
        checked = check_observations(messages.withColumnRenamed("timestamp", "sent"), keep=_KEPT)
        checked = checked.select(*_KEPT[:-1], F.col("sent").alias("timestamp"), "bad_reason").persist()  # parsed once for both
        try:
            reason = make_headers(bad_reason=F.col("bad_reason"))
            no_headers = F.array().cast(checked.schema["headers"].dataType)
            bad = checked.withColumn("headers", F.concat(F.coalesce("headers", no_headers), reason))
            self.topics.publish_once(checked.filter("bad_reason IS NULL").drop("bad_reason"), self.good, f"{batch_id:012d}")
            self.topics.publish_once(bad.filter("bad_reason IS NOT NULL").drop("bad_reason"), self.bad, f"{batch_id:012d}")
        finally:
            checked.unpersist()

    def writer(self, messages: DataFrame) -> DataStreamWriter:
        return messages.writeStream.foreachBatch(self.split)

    def bad_records(self) -> DataFrame:
        """Key, value and offset of the bad messages so far, and why they are bad."""
        return self.topics.read(self.bad).select(
            F.col("key").cast("string").alias("key"), F.col("value").cast("string").alias("value"), "offset",
            header_text(F.col("headers"), "bad_reason").alias("bad_reason"))
