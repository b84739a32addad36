"""Topics: Kafka, or directories of Parquet files with the same row shape."""

import json
from collections.abc import Iterable
from functools import reduce

from pyspark.sql import DataFrame, SparkSession, functions as F
from pyspark.sql.streaming import DataStreamWriter

from roadpulse.schemas import TOPIC_ROW
from roadpulse.sources.paths import Folder


def _as_list(topics: str | Iterable[str]) -> list[str]:
    return [topics] if isinstance(topics, str) else list(topics)


class KafkaTopics:
    """Topics of a Kafka cluster; needs the spark-sql-kafka connector on the class path."""

    def __init__(self, spark: SparkSession, servers: str, **client_options: str):
        self.spark = spark
        self.options = {"kafka.bootstrap.servers": servers}
        self.options |= {f"kafka.{k}": v for k, v in client_options.items()}

    def source_options(self, topics, starting: str | None = None, per_trigger: int | None = None,
                       headers: bool = False, tolerate_loss: bool = False, group: str | None = None) -> dict[str, str]:
        options = dict(self.options, subscribe=",".join(_as_list(topics)))
        if starting:
            options["startingOffsets"] = starting
        if per_trigger:
            options["maxOffsetsPerTrigger"] = str(per_trigger)
        if headers:
            options["includeHeaders"] = "true"
        if tolerate_loss:
            options["failOnDataLoss"] = "false"
        if group:  # here the query's checkpoint keeps the place
            options["groupIdPrefix"] = group
        return options

    def stream(self, topics, **how) -> DataFrame:
        return self.spark.readStream.format("kafka").options(**self.source_options(topics, **how)).load()

    def read(self, topics, **how) -> DataFrame:
        return self.spark.read.format("kafka").options(**self.source_options(topics, **how)).load()

    def writer(self, messages: DataFrame, topic: str) -> DataStreamWriter:
        return messages.writeStream.format("kafka").options(**self.options).option("topic", topic)

    def publish(self, messages: DataFrame, topic: str) -> None:
        messages.write.format("kafka").options(**self.options).option("topic", topic).save()


class DirectoryTopics:
    """One directory of Parquet files per topic.

    With `messages_per_file` no file that is published has more messages, so that a limit of messages per
    trigger can be kept, which counts files otherwise.
    """

    def __init__(self, spark: SparkSession, root: str, messages_per_file: int | None = None):
        self.spark = spark
        self.root = root.rstrip("/")
        self.messages_per_file = messages_per_file

    def path(self, topic: str) -> str:
        return f"{self.root}/{topic}"

    def stream(self, topics, starting: str | None = None, per_trigger: int | None = None, headers: bool = True,
               tolerate_loss: bool = False, group: str | None = None) -> DataFrame:
        """Called as the streams of a broker are.

        `starting` is "earliest", as if left out, or "latest": messages published after `group` first asked for the
        topic. A group keeps its place, also before its query has a checkpoint, and whatever it asks for later.
        Headers are always there, and files that go missing are passed over only if loss is tolerated.
        """
        if starting not in (None, "earliest", "latest"):
            raise ValueError(f"a topic starts at its earliest or latest message, not at {starting}")
        if starting == "latest" and not group:
            raise ValueError("to start at the latest message a stream needs a group, which keeps the place")
        reader = self.spark.readStream.schema(TOPIC_ROW)
        if per_trigger:
            reader = reader.option("maxFilesPerTrigger", max(1, per_trigger // (self.messages_per_file or 1)))
        reader = reader.option("ignoreMissingFiles", tolerate_loss)
        # One source per topic, so that each honours the commit log of the query writing to it.
        return reduce(DataFrame.unionByName, [self._from(reader, t, starting, group) for t in _as_list(topics)])

    def _from(self, reader, topic: str, starting: str | None, group: str | None) -> DataFrame:
        rows = reader.parquet(self.path(topic))
        place = self._place(topic, starting, group) if group else None
        if not place:
            return rows
        # Spark drops files by these conditions when it plans a batch, and opens none of the earlier ones.
        time, name = F.col("_metadata.file_modification_time"), F.col("_metadata.file_name")
        return rows.filter((time > F.timestamp_millis(F.lit(place["time"]))) |
                           ((time == F.timestamp_millis(F.lit(place["time"]))) & ~name.isin(place["names"])))

    def _place(self, topic: str, starting: str | None, group: str) -> dict | None:
        """The last file before a group's first message: its time, and all names of that time."""
        places, name = Folder(self.spark, f"{self.root}/_places"), f"{group}-{topic}"
        if not places.exists(name):
            files = {n: at for n, at in Folder(self.spark, self.path(topic)).modified().items() if n[0] not in "._"}
            last = max(files.values(), default=0)
            place = {"time": last, "names": [n for n, at in files.items() if at == last]} if starting == "latest" and files else None
            places.make()
            places.write(name, json.dumps(place))
        return json.loads(places.read(name))

    def read(self, topics) -> DataFrame:
        reader = self.spark.read.schema(TOPIC_ROW)
        return reduce(DataFrame.unionByName, [reader.parquet(self.path(t)) for t in _as_list(topics)])

    def writer(self, messages: DataFrame, topic: str) -> DataStreamWriter:
        return _topic_rows(messages, topic).writeStream.format("parquet").options(**self._sizes()).option("path", self.path(topic))

    def publish(self, messages: DataFrame, topic: str) -> None:
        _topic_rows(messages, topic).write.mode("append").options(**self._sizes()).parquet(self.path(topic))

    def publish_once(self, messages: DataFrame, topic: str, name: str) -> None:
        """Publish under a name, such as that of a micro-batch; what was published under it is not published again.

        The files are written aside and moved into the topic one by one. If that breaks off, the next call
        moves the rest of the same files, so readers see each message once.
        """
        done, staged = Folder(self.spark, f"{self.root}/_published/{topic}"), Folder(self.spark, f"{self.root}/_staged/{topic}")
        if done.exists(name):
            return
        files = staged.child(name)
        if not files.exists("_SUCCESS"):
            _topic_rows(messages, topic).write.mode("overwrite").options(**self._sizes()).parquet(files.path)
        target = Folder(self.spark, self.path(topic))
        target.make()
        for file in files.names():
            if file.startswith("part-"):
                files.move(file, target, f"{name}-{file}")
        done.make()
        done.write(name, "")
        staged.delete(name)

    def _sizes(self) -> dict:
        return {"maxRecordsPerFile": self.messages_per_file} if self.messages_per_file else {}


def _topic_rows(messages: DataFrame, topic: str) -> DataFrame:
    """Topic rows; `offset` and `timestamp` may be given, as the producer's own.

    Partition, offset and type of time are a broker's; they are null where the producer gives none.
    """
    given = set(messages.columns)
    filled = {
        "headers": F.lit(None),
        "topic": F.lit(topic),
        "partition": F.lit(None),
        "offset": F.lit(None),
        "timestamp": F.current_timestamp(),
        "timestampType": F.lit(None),
    }
    columns = []
    for field in TOPIC_ROW:
        column = F.col(field.name) if field.name in given else filled[field.name]
        columns.append(column.cast(field.dataType).alias(field.name))
    return messages.select(*columns)
