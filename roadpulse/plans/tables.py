"""The given tables seen as traffic data."""

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from roadpulse.functions.envelope import encode
from roadpulse.operators.ingest import frame_messages
from roadpulse.operators.windows import average_volume

CAMERAS = 8
EVENTS_SCHEMA = ("event_id bigint, ts timestamp_ntz, user_id bigint, event_type string, value double, props string")
CLASS_OF_EVENT = {"signup": 1, "view": 2, "click": 3, "purchase": 5, "error": 7}


def camera_id(number: Column) -> Column:
    return F.concat(F.lit("cam_"), F.lpad(number.cast("string"), 3, "0"))


def events(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.read.schema(EVENTS_SCHEMA).parquet(f"{sf_dir}/events.parquet")


def registry(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Nations as registered cameras."""
    nation = spark.read.parquet(f"{sf_dir}/nation.parquet")
    return nation.select(camera_id(F.col("n_nationkey")).alias("camera_id"), F.col("n_name").alias("location"),
                         F.lit(None).cast("string").alias("source"))


def observe_events(rows: DataFrame, places: DataFrame, keep=()) -> DataFrame:
    """Events, of the table or of a stream, as observations."""
    known = places.select(F.col("camera_id").alias("cam_id"), "location")
    return (rows.select(
                "event_id", camera_id(F.col("user_id") % CAMERAS).alias("cam_id"),
                F.col("ts").cast("timestamp").alias("timestamp"),
                F.floor("value").cast("int").alias("traffic_volume"), *keep)
            .join(known, "cam_id", "left")
            .withColumn("location", F.coalesce("location", F.lit("Unknown"))))


def observations(spark: SparkSession, sf_dir: str) -> DataFrame:
    return observe_events(events(spark, sf_dir), registry(spark, sf_dir))


def hourly_averages(spark: SparkSession, sf_dir: str) -> DataFrame:
    return average_volume(observations(spark, sf_dir), "1 hour")


def detections(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Events as detected boxes: the event type gives the class, the value the confidence."""
    rows = events(spark, sf_dir)
    class_id = F.coalesce(*[F.when(F.col("event_type") == name, c) for name, c in CLASS_OF_EVENT.items()])
    return rows.select(frame_id(rows).alias("frame_id"), class_id.alias("class_id"),
                       F.col("event_type").alias("class_name"), (F.col("value") / 500).alias("conf"))


def frame_id(rows: DataFrame) -> Column:
    return F.concat_ws("/", camera_id(F.col("user_id") % CAMERAS), F.date_format("ts", "yyyy-MM-dd HH"))


def frames(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One frame per camera and hour with events."""
    rows = events(spark, sf_dir)
    return (rows.groupBy(frame_id(rows).alias("frame_id"))
            .agg(F.max("ts").alias("taken_at"), F.max(camera_id(F.col("user_id") % CAMERAS)).alias("cam_id")))


def sensor_history(spark: SparkSession, sf_dir: str) -> DataFrame:
    return events(spark, sf_dir).select(
        F.col("event_id").alias("dyna_id"), F.lit("state").alias("type"), F.col("ts").cast("timestamp").alias("time"),
        (F.col("user_id") % CAMERAS).cast("int").alias("entity_id"), F.col("value").alias("traffic_flow"))


def vector_frames(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Embeddings as frame messages, one a second over the cameras; the payloads of one label are broken."""
    vectors = spark.read.parquet(f"{sf_dir}/embeddings.parquet")
    payload = F.when(F.col("label") == 3, F.lit("broken")).otherwise(F.to_json("embedding"))
    shaped = vectors.select(
        F.col("vec_id").alias("offset"), camera_id(F.col("vec_id") % CAMERAS).alias("cam_id"),
        F.concat(F.lit("label_"), F.col("label").cast("string")).alias("location"),
        F.timestamp_seconds(F.col("vec_id") + F.lit(1_704_067_200)).alias("timestamp"),
        F.encode(payload, "UTF-8").alias("value"))
    return frame_messages(shaped, keep=["offset"])


def striped_detections(value: Column) -> Column:
    """Boxes of a payload that is a JSON array of 64 numbers: the maxima of its eight stripes; null for another payload."""
    numbers = F.from_json(value.cast("string"), "array<float>")
    stripes = F.transform(F.sequence(F.lit(0), F.lit(7)), lambda i: F.struct(
        i.alias("class_id"), F.array_max(F.slice(numbers, i * 8 + 1, 8)).cast("double").alias("conf")))
    return F.when(F.size(numbers) == 64, stripes)


def serving_messages(rows: DataFrame, places: DataFrame) -> DataFrame:
    """An hourly average and a forecast message per event; later events replace earlier ones."""
    observed = observe_events(rows, places)
    start = F.date_trunc("hour", "timestamp")
    base = observed.withColumn("start_time", start).withColumn(
        "end_time", F.col("start_time") + F.expr("INTERVAL 1 HOUR"))
    order = [F.col("event_id").alias("offset"), F.col("timestamp")]
    history = encode(base, "cam_id", [
        "start_time", "end_time", "cam_id", "location",
        F.col("traffic_volume").cast("double").alias("avg_traffic_volume")], order)
    hours = F.floor(F.minute("timestamp") / 10).cast("int")
    ahead = F.col("start_time") + F.make_dt_interval(hours=hours, mins=F.lit(5))
    forecast = encode(base, "cam_id", [
        ahead.alias("prediction_timestamp"), F.col("start_time").alias("base_time_t"), "cam_id",
        F.col("traffic_volume").cast("double").alias("current_volume"),
        (F.col("traffic_volume") + 1).cast("double").alias("predicted_volume"),
        (F.col("traffic_volume") == 20).alias("is_padded")], order)
    return (history.withColumn("topic", F.lit("traffic-aggregated"))
            .unionByName(forecast.withColumn("topic", F.lit("traffic-forecast"))))
