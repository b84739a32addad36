"""Frames and observations as they arrive."""

from pyspark.sql import Column, DataFrame, Window, functions as F, types as T

from roadpulse.functions.envelope import CORRUPT, decode, encode, parse_time
from roadpulse.functions.headers import header_text, make_headers
from roadpulse.schemas import OBSERVATION


def flatten_frames(frames: DataFrame, keep=()) -> DataFrame:
    """Camera id, location and time text from the headers, next to the payload; frames of no camera are left out."""
    headers = F.col("headers")
    flat = frames.select(
        *keep,
        *[header_text(headers, name).alias(name) for name in ("cam_id", "location", "timestamp")],
        "value",
    )
    return flat.filter(F.col("cam_id") != "")


def frame_messages(frames: DataFrame, payload: str = "value", keep=()) -> DataFrame:
    """Keyed frame messages with the camera's metadata in the headers; the time is UTC."""
    utc = F.to_utc_timestamp(F.col("timestamp"), F.current_timezone())
    headers = make_headers(
        cam_id=F.col("cam_id"),
        location=F.col("location"),
        timestamp=F.date_format(utc, "yyyy-MM-dd'T'HH:mm:ss.SSSSSS'+00:00'"),
    )
    return frames.select(F.encode("cam_id", "UTF-8").alias("key"), F.col(payload).alias("value"),
                         headers.alias("headers"), *keep)


def has_camera(record: Column) -> Column:
    return record["cam_id"] != ""


def decode_observations(messages: DataFrame, keep=(), detail: bool = True) -> DataFrame:
    """Observations of known cameras, with a parsed event time; without `detail` the counts per class are not parsed."""
    schema = OBSERVATION if detail else T.StructType([f for f in OBSERVATION if f.name != "detail"])
    rows = decode(messages, schema, keep=keep, where=has_camera)
    return rows.withColumn("timestamp", parse_time(F.col("timestamp")))


def check_observations(messages: DataFrame, keep=()) -> DataFrame:
    """Decoded observations with the column `bad_reason`, null for a usable row.

    A volume of the wrong type is a null volume, not a bad record: averages pass over it.
    """
    rows = decode(messages, OBSERVATION, keep=keep, with_corrupt=True)
    text_fields = F.coalesce(*[F.col(f.name).cast("string") for f in OBSERVATION if f.name != "detail"])
    time = parse_time(F.col("timestamp"))
    reason = (
        F.when(F.col(CORRUPT).isNotNull() & text_fields.isNull(), "malformed")
        .when(F.coalesce(F.col("cam_id"), F.lit("")) == "", "no_camera")
        .when(time.isNull(), "bad_time")
    )
    return (rows.withColumn("bad_reason", reason)
            .withColumn("timestamp", time)
            .drop(CORRUPT))


def split_bad_records(messages: DataFrame, keep=()) -> tuple[DataFrame, DataFrame]:
    """Usable observations, and the bad ones with their reason."""
    checked = check_observations(messages, keep)
    good = checked.filter(F.col("bad_reason").isNull()).drop("bad_reason")
    bad = checked.filter(F.col("bad_reason").isNotNull())
    return good, bad


def encode_observations(observations: DataFrame, keep=()) -> DataFrame:
    """Key and JSON value of observations whose `timestamp` is an instant or text."""
    fields = [F.col(f.name) for f in OBSERVATION if f.name in observations.columns]
    if dict(observations.dtypes)["timestamp"] != "string":
        text = F.date_format("timestamp", "yyyy-MM-dd'T'HH:mm:ss.SSSSSSXXX").alias("timestamp")
        fields = [text if f.name == "timestamp" else F.col(f.name)
                  for f in OBSERVATION if f.name in observations.columns]
    return encode(observations, "cam_id", fields, keep)


def _slot(time: str, fps: float):
    """Number of the 1/fps slot that an instant lies in."""
    micros = round(1_000_000 / fps)
    return F.expr(f"unix_micros({time}) div {micros}L")


def cap_frame_rate(frames: DataFrame, fps: float = 1.0, time: str = "timestamp", tie: str | None = None) -> DataFrame:
    """The first frame of each camera in each slot of 1/fps seconds."""
    order = [F.col(time)] + ([F.col(tie)] if tie else [])
    per_slot = Window.partitionBy("cam_id", "__slot").orderBy(*order)
    return (frames.withColumn("__slot", _slot(time, fps))
            .withColumn("__rank", F.row_number().over(per_slot))
            .filter("__rank = 1")
            .drop("__slot", "__rank"))


def cap_frame_rate_stream(frames: DataFrame, fps: float = 1.0, time: str = "timestamp",
                          delay: str = "10 seconds") -> DataFrame:
    """One frame of each camera per slot, the first to arrive.

    The watermark follows the ends of slots, so the state of a slot lives until `delay` after its end,
    however long it is; a frame of a slot that ended more than `delay` before is late.
    """
    micros = round(1_000_000 / fps)
    end = F.timestamp_micros((F.col("__slot") + 1) * micros)
    return (frames.withColumn("__slot", _slot(time, fps))
            .withColumn("__end", end)
            .withWatermark("__end", delay)
            .dropDuplicatesWithinWatermark(["cam_id", "__slot"])
            .drop("__slot", "__end"))
