"""The streaming jobs. Each turns messages of one topic into messages of the next.

The stages run as separate queries with a durable topic between them: chained inside one query,
the second window would see times one microsecond before the window ends.
"""

from pyspark.ml import PipelineModel
from pyspark.sql import DataFrame
from pyspark.sql.streaming import DataStreamWriter, StreamingQuery

from roadpulse.functions.envelope import decode, encode
from roadpulse.operators.features import FeatureSpec, serving_features
from roadpulse.operators.forecast import forecasts
from roadpulse.operators.ingest import decode_observations, encode_observations, flatten_frames
from roadpulse.operators.detections import COUNTER_CONFIDENCE
from roadpulse.operators.scoring import Detector, observe, score_frames, vehicle_counter
from roadpulse.operators.windows import average_volume, volume_history
from roadpulse.schemas import AGGREGATE, FORECAST
from roadpulse.session import fresh_dir, session_settings, ship_package

ROCKSDB = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"


def monitor(frames: DataFrame, detector: Detector, workers: int | None = None, **how) -> DataFrame:
    """Frame messages to observation messages."""
    observed = observe(score_frames(flatten_frames(frames), detector, workers), **how)
    return encode_observations(observed)


def count(frames: DataFrame, detector: Detector, min_conf: float = COUNTER_CONFIDENCE, keep=()) -> DataFrame:
    """The plain counter: a map of counts for each frame message, with or without headers; empty for a bad payload."""
    ship_package(frames.sparkSession)
    return frames.select(*keep, vehicle_counter(detector, min_conf)("value").alias("counts"))


def aggregate(messages: DataFrame, window: str = "1 minute", delay: str | None = "10 seconds") -> DataFrame:
    """Observation messages to messages of window averages."""
    averages = average_volume(decode_observations(messages, detail=False), window, delay)
    return encode(averages, "cam_id", AGGREGATE.fieldNames())


def history(messages: DataFrame, length: str = "5 minutes", slide: str = "1 minute",
            delay: str | None = "1 minute") -> DataFrame:
    """Messages of window averages to history lists."""
    return volume_history(decode(messages, AGGREGATE), length, slide, delay)


def forecast(messages: DataFrame, model: PipelineModel, spec: FeatureSpec = FeatureSpec(),
             length: str | None = None, slide: str | None = None, delay: str | None = "1 minute",
             require_latest: bool = False) -> DataFrame:
    """Messages of window averages to forecast messages, over the windows that the model's spec names."""
    length, slide = length or spec.history, slide or spec.lag_step
    if slide != spec.lag_step:
        raise ValueError(f"the model has learned lags of {spec.lag_step}, not of {slide}")
    features = serving_features(history(messages, length, slide, delay), spec, require_latest)
    return encode(forecasts(features, model, spec), "cam_id", FORECAST.fieldNames())


def console(df: DataFrame) -> DataStreamWriter:
    """Print each micro-batch in full."""
    return df.writeStream.format("console").option("truncate", "false")


def start(writer: DataStreamWriter, df: DataFrame, checkpoint: str | None, trigger: str | None = None,
          state_partitions: int | None = None, rocksdb: bool = False, mode: str = "append") -> StreamingQuery:
    """Start a query, in append mode or another.

    `trigger` is an interval such as "10 seconds", "available now", or None for back to back batches.
    `state_partitions` holds for the life of the checkpoint. `rocksdb` keeps state off the heap. Without a
    checkpoint the query keeps its place for this run only, in the shared folder, and starts anew the next time.
    """
    writer = writer.outputMode(mode).option("checkpointLocation", checkpoint or fresh_dir(df.sparkSession, "unkept"))
    if trigger == "available now":
        writer = writer.trigger(availableNow=True)
    elif trigger:
        writer = writer.trigger(processingTime=trigger)
    settings = {}
    if state_partitions:
        settings["spark.sql.shuffle.partitions"] = state_partitions
    if rocksdb:
        settings["spark.sql.streaming.stateStore.providerClass"] = ROCKSDB
    with session_settings(df.sparkSession, settings):
        return writer.start()
