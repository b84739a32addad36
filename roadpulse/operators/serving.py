"""The view per camera: recent history, forecasts still ahead, location.

Messages become entries: kind, cam_id, time_key, the record's fields and the order of the message.
Entries of one kind, camera and time are versions of each other. Merging adds two kinds without a
time, one entry per camera each: "place", the last message that gave a location, and "heard", the
last message of all.
"""

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window, functions as F, types as T

from roadpulse.functions.envelope import decode
from roadpulse.operators.ingest import has_camera
from roadpulse.schemas import AGGREGATE, FORECAST

# Sizes of the lists per camera, and texts of their documents.
HISTORY_LIMIT = 30
FORECAST_LIMIT = 288
WAITING = "Waiting for data..."
UNKNOWN = "Unknown"

_FORECAST_ONLY = [f for f in FORECAST if f.name != "cam_id"]
_MESSAGE = T.StructType([*AGGREGATE.fields, *_FORECAST_ONLY])
_HISTORY_FIELDS = [f for f in AGGREGATE.fieldNames() if f != "cam_id"]
_FORECAST_FIELDS = [f.name for f in _FORECAST_ONLY]


def serving_entries(messages: DataFrame, history_topic: str, forecast_topic: str,
                    order: Sequence[str] = ("offset", "timestamp")) -> DataFrame:
    """Entries of the messages of two topics; messages without camera or time are left out.

    Messages are versions in the given order: that of arrival in a partition, which is where all messages
    of a camera are; clocks of producers may run backwards. Equal ones go by what they hold.
    """
    kind = F.when(F.col("topic") == history_topic, "history").when(F.col("topic") == forecast_topic, "forecast")
    seq = F.struct(*order, F.xxhash64("value").alias("tie"))
    keyed = (messages.select(kind.alias("kind"), "value", seq.alias("seq"))
             .filter(F.col("kind").isNotNull())
             .withColumn("updated_at", F.current_timestamp()))

    def time_of(record):
        return F.when(F.col("kind") == "history", record["start_time"]).otherwise(record["prediction_timestamp"])

    rows = decode(keyed, _MESSAGE, keep=["kind", "seq", "updated_at"],
                  where=lambda record: has_camera(record) & time_of(record).isNotNull())
    time = F.when(F.col("kind") == "history", F.col("start_time")).otherwise(F.col("prediction_timestamp"))
    return rows.withColumn("time_key", time)


def latest_wins(entries: DataFrame, keys: Sequence[str], order: Sequence[str] = ("seq",)) -> DataFrame:
    """The last version of each key. Spark cuts copies before the shuffle, so many copies are no hot spot."""
    versions = Window.partitionBy(*keys).orderBy(*[F.desc(c) for c in order])
    return entries.withColumn("__rank", F.row_number().over(versions)).filter("__rank = 1").drop("__rank")


def newest_entries(entries: DataFrame, history_limit: int = HISTORY_LIMIT,
                   forecast_limit: int = FORECAST_LIMIT) -> DataFrame:
    """The newest history and forecast entries of each camera, each in its last version.

    The cut to the newest times comes before the versions are told apart. Spark applies it in each task
    ahead of the only shuffle, so a task sends no more than a camera's newest times.
    """
    own = F.when(F.col("kind") == "history", history_limit).otherwise(forecast_limit)
    by_time = Window.partitionBy("kind", "cam_id").orderBy(F.desc("time_key"))
    newest = (entries.filter("kind IN ('history', 'forecast')")
              .withColumn("__rank", F.dense_rank().over(by_time))
              .filter(f"__rank <= {max(int(history_limit), int(forecast_limit))}")
              .filter(F.col("__rank") <= own)
              .drop("__rank"))
    return latest_wins(newest, ["kind", "cam_id", "time_key"])


def last_messages(entries: DataFrame) -> DataFrame:
    """"place" and "heard" of each camera, from all its messages, in whatever times they are about."""
    located = F.col("kind").isin("history", "place") & F.col("location").isNotNull()
    last = entries.groupBy("cam_id").agg(
        F.max_by(F.struct(F.lit("place").alias("kind"), "seq", "updated_at", "location"), F.when(located, F.col("seq"))).alias("place"),
        F.max_by(F.struct(F.lit("heard").alias("kind"), "seq", "updated_at", F.lit(None).cast("string").alias("location")), "seq").alias("heard"))
    rows = last.select("cam_id", F.inline(F.array_compact(F.array("place", "heard"))))
    return rows.select(*[F.col(f.name) if f.name in rows.columns else F.lit(None).cast(f.dataType).alias(f.name)
                         for f in entries.schema])


def merge_entries(entries: DataFrame, history_limit: int = HISTORY_LIMIT,
                  forecast_limit: int = FORECAST_LIMIT) -> DataFrame:
    """The newest entries of each camera, and its last messages.

    Merging in parts or all at once, and merging again, gives the same entries.
    """
    return newest_entries(entries, history_limit, forecast_limit).unionByName(last_messages(entries))


def camera_states(entries: DataFrame) -> DataFrame:
    """Per camera with messages: its last reported location, and when it was last heard of."""
    located = F.col("kind").isin("history", "place") & F.col("location").isNotNull()
    return entries.groupBy("cam_id").agg(
        F.max_by("location", F.when(located, F.col("seq"))).alias("location"),
        F.max("updated_at").alias("last_updated"),
    )


def _registered(registry: DataFrame) -> DataFrame:
    """One location for each camera, also if its id is registered twice: the least, as a table has no first row."""
    return registry.groupBy(F.col("camera_id").alias("cam_id")).agg(F.min("location").alias("__registered"))


def locate(messages: DataFrame, registry: DataFrame, reported: str = "location") -> DataFrame:
    """Location of each row: as reported, else registered, else unknown.

    The plan leaves it to Spark to broadcast the registry, which it does by size.
    """
    known = _registered(registry)
    place = F.coalesce(reported, "__registered", F.lit(UNKNOWN))
    return messages.join(known, "cam_id", "left").withColumn("location", place).drop("__registered")


def seed_registered(states: DataFrame, registry: DataFrame, keep: Sequence[Column] = ()) -> DataFrame:
    """Camera states with every registered camera, heard of or not."""
    return states.join(_registered(registry), "cam_id", "full").select("cam_id", *_heading(), *keep)


def _heading() -> list[Column]:
    return [F.coalesce("location", "__registered", F.lit(UNKNOWN)).alias("location"),
            F.coalesce(F.col("last_updated").cast("string"), F.lit(WAITING)).alias("last_updated")]


def last_history_end(history: DataFrame) -> DataFrame:
    """End of the newest history row per camera."""
    return history.groupBy("cam_id").agg(F.max_by("end_time", "start_time").alias("last_end"))


def future_forecasts(entries: DataFrame) -> DataFrame:
    """Forecasts later than their camera's newest history row; all of them where there is no history.

    `entries` are merged ones, so a camera has no more of them than the limits of the merge.
    """
    start = F.when(F.col("kind") == "history", F.col("start_time"))
    last_end = F.max_by("end_time", start).over(Window.partitionBy("cam_id"))
    return (entries.filter("kind IN ('history', 'forecast')")
            .withColumn("__last_end", last_end)
            .filter("kind = 'forecast' AND (__last_end IS NULL OR prediction_timestamp > __last_end)")
            .drop("__last_end"))


def camera_documents(entries: DataFrame, registry: DataFrame) -> DataFrame:
    """One row per camera: location, last update, history and future forecasts, oldest first.

    `entries` are merged ones, so the lists are bounded by the limits of the merge.
    """
    return seed_registered(entries.groupBy("cam_id").agg(*_document_parts()), registry, _lists())


def camera_document(entries: DataFrame, registry: DataFrame, cam_id: str) -> DataFrame:
    """The row of one camera, or none if it is neither registered nor heard of.

    `entries` are merged ones, of this camera and maybe others. The registration is one more entry, so the
    document needs no join.
    """
    own = entries.filter(F.col("cam_id") == cam_id)
    known = _registered(registry.filter(F.col("camera_id") == cam_id)).select(
        "cam_id", F.lit("registered").alias("kind"), F.col("__registered").alias("location"))
    registered = F.max(F.when(F.col("kind") == "registered", F.col("location"))).alias("__registered")
    found = own.unionByName(known, allowMissingColumns=True).groupBy("cam_id").agg(*_document_parts(), registered)
    return found.select("cam_id", *_heading(), *_lists())


def _document_parts() -> list[Column]:
    is_place = F.col("kind") == "place"
    return [
        F.array_sort(F.collect_list(F.when(F.col("kind") == "history", F.struct(*_HISTORY_FIELDS)))).alias("history"),
        F.array_sort(F.collect_list(F.when(F.col("kind") == "forecast", F.struct(*_FORECAST_FIELDS)))).alias("forecast"),
        F.max(F.when(is_place, F.col("location"))).alias("location"),
        F.max("updated_at").alias("last_updated"),
    ]


def _lists() -> list[Column]:
    """History and future forecasts of a document, empty where there are none."""
    last_end = F.try_element_at("history", F.lit(-1))["end_time"]
    ahead = F.filter("forecast", lambda f: last_end.isNull() | (f["prediction_timestamp"] > last_end))
    history_type = T.ArrayType(T.StructType([AGGREGATE[f] for f in _HISTORY_FIELDS]))
    forecast_type = T.ArrayType(T.StructType([FORECAST[f] for f in _FORECAST_FIELDS]))
    return [F.coalesce("history", F.array().cast(history_type)).alias("history"),
            F.coalesce(ahead, F.array().cast(forecast_type)).alias("forecast")]


def chart_series(documents: DataFrame) -> DataFrame:
    """Chart points (series, x, y) per camera from its document."""
    def points(name, items, x, y):
        return F.transform(items, lambda i: F.struct(F.lit(name).alias("series"), i[x].alias("x"), i[y].alias("y")))

    every = F.concat(points("history", F.col("history"), "end_time", "avg_traffic_volume"),
                     points("forecast", F.col("forecast"), "prediction_timestamp", "predicted_volume"))
    return documents.select("cam_id", F.inline(every))
