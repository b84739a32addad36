"""The serving table: merged entries of all cameras in buckets, kept by a stream.

    <path>/batches/<generation>-<batch>    a text: the buckets, and the batch that last wrote each
    <path>/data/<generation>-<batch>/bucket=<b>/

A micro-batch merges its messages with the entries of the buckets they fall into and writes those buckets
only; the other buckets stay where earlier batches have put them. The text is written last and makes the
batch visible. A batch that has its text is done, so a repeated one changes nothing; one that broke off
writes its folder anew. Files that only outdated texts name go when these are older than `keep_seconds`, so a
reader has that long, however many batches come meanwhile.

A query with a fresh checkpoint counts batches from 0 again: give it a higher `generation` to go on from
the old state. The table has one writer; that takes the place of a lock.
"""

import itertools
import json
import time
import zlib

from pyspark.sql import Column, DataFrame, SparkSession, functions as F, types as T
from pyspark.sql.streaming import DataStreamWriter

from roadpulse.operators.serving import (
    FORECAST_LIMIT, HISTORY_LIMIT, camera_document, camera_documents, merge_entries, serving_entries,
)
from roadpulse.sources.paths import Folder

BUCKETS = 64


class ServingTable:
    """`buckets` holds for a new table; one that is there keeps its own number."""

    def __init__(self, spark: SparkSession, path: str, history_topic: str, forecast_topic: str,
                 history_limit: int = HISTORY_LIMIT, forecast_limit: int = FORECAST_LIMIT,
                 generation: int = 0, buckets: int = BUCKETS, keep_seconds: float = 3600):
        self.spark = spark
        self.path = path.rstrip("/")
        self.topics = (history_topic, forecast_topic)
        self.limits = (history_limit, forecast_limit)
        self.generation = generation
        self.buckets = buckets
        self.keep_seconds = keep_seconds
        self.batches = Folder(spark, f"{self.path}/batches")
        self.data = Folder(spark, f"{self.path}/data")

    def upsert(self, messages: DataFrame, batch_id: int) -> None:
        name = f"{self.generation:06d}-{batch_id:012d}"
        done = self._done()
        if name in done:
            return
        older = [n for n in done if n < name]
        state = self._state(older[-1]) if older else {"buckets": self.buckets, "files": {}, "schema": None}
        entries = serving_entries(messages, *self.topics).withColumn("bucket", _bucket(F.col("cam_id"), state["buckets"]))
        entries = entries.persist()  # read for the list of buckets, for its last messages, and for its lists
        try:
            touched = [r.bucket for r in entries.select("bucket").distinct().collect()]  # at most all buckets
            if touched:
                entries = entries.drop("bucket")
                if held := [b for b in touched if str(b) in state["files"]]:
                    entries = entries.unionByName(self._entries(state, held))
                merged = merge_entries(entries, *self.limits)
                state["schema"] = merged.schema.json()
                placed = merged.withColumn("bucket", _bucket(F.col("cam_id"), state["buckets"]))
                (placed.repartition(min(len(touched), self._tasks()), "bucket")
                 .write.mode("overwrite").partitionBy("bucket").parquet(f"{self.data.path}/{name}"))
                state["files"] |= {str(b): name for b in touched}
        finally:
            entries.unpersist()
        self.batches.make()
        self.batches.write(name, json.dumps(state))
        self._clean(name)

    def writer(self, messages: DataFrame) -> DataStreamWriter:
        return messages.writeStream.foreachBatch(self.upsert)

    def entries(self) -> DataFrame:
        state = self._newest()
        return self._entries(state, state["files"])

    def documents(self, registry: DataFrame) -> DataFrame:
        return camera_documents(self.entries(), registry)

    def document(self, cam_id: str, registry: DataFrame) -> DataFrame:
        """The document of one camera; no row if it is neither registered nor heard of. Reads one bucket."""
        state = self._newest()
        return camera_document(self._entries(state, [bucket_of(cam_id, state["buckets"])]), registry, cam_id)

    def _entries(self, state: dict, buckets) -> DataFrame:
        paths = [f"{self.data.path}/{state['files'][str(b)]}/bucket={b}" for b in buckets if str(b) in state["files"]]
        schema = T.StructType.fromJson(json.loads(state["schema"])) if state["schema"] else None
        if not paths:
            if schema is None:
                raise ValueError(f"nothing was written to {self.path} yet")
            return self.spark.createDataFrame([], schema)
        return self.spark.read.schema(schema).parquet(*paths)

    def _newest(self) -> dict:
        done = self._done()
        if not done:
            raise ValueError(f"no batch in {self.path}")
        return self._state(done[-1])

    def _done(self) -> list[str]:
        return [n for n in self.batches.names() if not n.startswith(".")]

    def _state(self, name: str) -> dict:
        return json.loads(self.batches.read(name))

    def _tasks(self) -> int:
        return int(self.spark.conf.get("spark.sql.shuffle.partitions"))

    def _clean(self, newest: str) -> None:
        """Texts before the newest one go by age, oldest first, and with them the files that no other text names."""
        since = (time.time() - self.keep_seconds) * 1000
        changed = self.batches.modified()
        done = self._done()
        old = list(itertools.takewhile(lambda n: n < newest and changed[n] < since, done))
        if not old:
            return
        # the batch of a bucket only grows from text to text, so what the first of the others does not name none does
        kept = self._state(done[len(old)])["files"]
        gone = {(b, n) for o in old for b, n in self._state(o)["files"].items() if kept.get(b) != n}
        for b, n in gone:
            self.data.delete(f"{n}/bucket={b}")
        for n in {n for _, n in gone}:
            if not any(x.startswith("bucket=") for x in self.data.child(n).names()):
                self.data.delete(n)
        for o in old:
            self.batches.delete(o)


def _bucket(cam_id: Column, buckets: int) -> Column:
    return (F.crc32(cam_id.cast("binary")) % buckets).cast("int")


def bucket_of(cam_id: str, buckets: int) -> int:
    return zlib.crc32(cam_id.encode()) % buckets
