"""Batch scoring of frame payloads with a pluggable detector."""

import functools
from collections import Counter
from collections.abc import Iterator, Mapping
from typing import Any, Protocol

import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F, types as T

from roadpulse.operators.detections import COUNTER_CONFIDENCE, DEFAULT_CONFIDENCE, VEHICLE_CLASSES, count_in_array
from roadpulse.functions.collections import map_total
from roadpulse.schemas import DETECTIONS
from roadpulse.session import ship_package

_ARROW_DETECTIONS = pa.list_(pa.struct([("class_id", pa.int32()), ("conf", pa.float64())]))


class Detector(Protocol):
    """What a detector must offer. It is hashable, since workers keep the loaded model by it."""

    def load(self) -> Any:
        """The model; called once per Python worker."""

    def decode(self, payload: bytes) -> Any | None:
        """The image of a payload, or None if it cannot be decoded."""

    def detect(self, model: Any, images: list) -> list[list[tuple[int, float]]]:
        """(class id, confidence) of every box, per image."""


@functools.lru_cache(maxsize=4)
def _loaded(detector: Detector) -> Any:
    return detector.load()


def score_frames(frames: DataFrame, detector: Detector, workers: int | None = None,
                 sub_batch: int = 20, spread_by: tuple[str, ...] = ("cam_id", "timestamp")) -> DataFrame:
    """The frames without their payload, with `detections`: null where the payload cannot be decoded.

    `workers` spreads the frames over that many tasks, by camera, time and payload, so that one busy camera
    uses all of them, with or without times, and a repeated task sees the same frames.
    """
    kept = [c for c in frames.columns if c != "value"]
    schema = T.StructType([*[frames.schema[c] for c in kept], T.StructField("detections", DETECTIONS)])

    def run(batches):
        model = _loaded(detector)
        for batch in batches:
            found = [None] * batch.num_rows
            payloads = batch.column("value")
            for start in range(0, batch.num_rows, sub_batch):
                rows, images = [], []
                for row in range(start, min(start + sub_batch, batch.num_rows)):
                    payload = payloads[row].as_py()
                    image = None if payload is None else detector.decode(payload)
                    if image is not None:
                        rows.append(row)
                        images.append(image)
                if images:
                    for row, boxes in zip(rows, detector.detect(model, images)):
                        found[row] = [{"class_id": c, "conf": p} for c, p in boxes]
            columns = [batch.column(c) for c in kept]
            yield pa.RecordBatch.from_arrays([*columns, pa.array(found, _ARROW_DETECTIONS)],
                                             names=[*kept, "detections"])

    ship_package(frames.sparkSession)
    if workers:
        frames = spread(frames, workers, spread_by)
    return frames.select(*kept, "value").mapInArrow(run, schema)


def vehicle_counter(detector: Detector, min_conf: float = COUNTER_CONFIDENCE, sub_batch: int = 20,
                    classes: Mapping = VEHICLE_CLASSES):
    """A column function from payloads to maps of counts per label; an empty map for a payload that cannot be decoded.

    Works on Arrow batches, with the model loaded once per worker.
    """
    @F.pandas_udf(T.MapType(T.StringType(), T.IntegerType()))
    def counts(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        model = _loaded(detector)
        for payloads in batches:
            out = [{} for _ in range(len(payloads))]
            for start in range(0, len(payloads), sub_batch):
                images = [(row, None if payload is None else detector.decode(bytes(payload)))
                          for row, payload in enumerate(payloads.iloc[start:start + sub_batch], start)]
                images = [(row, image) for row, image in images if image is not None]
                if images:
                    for (row, _), boxes in zip(images, detector.detect(model, [image for _, image in images])):
                        out[row] = dict(Counter(classes[c] for c, p in boxes if c in classes and p >= min_conf))
            yield pd.Series(out)

    return counts


def decodable(detector: Detector):
    """A column function that tells whether payloads can be decoded."""
    @F.pandas_udf(T.BooleanType())
    def told(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        for payloads in batches:
            yield pd.Series([payload is not None and detector.decode(bytes(payload)) is not None for payload in payloads], dtype=bool)

    return told


def spread(frames: DataFrame, workers: int, by: tuple[str, ...] = ("cam_id", "timestamp")) -> DataFrame:
    return frames.repartition(workers, *by, F.xxhash64("value"))


def observe(scored: DataFrame, min_conf: float = DEFAULT_CONFIDENCE, undecodable: str = "drop",
            classes=VEHICLE_CLASSES) -> DataFrame:
    """Scored frames to observations.

    `undecodable` is "drop" (no row for such a frame) or "empty" (a row with volume 0).
    """
    if undecodable not in ("drop", "empty"):
        raise ValueError(f"undecodable: {undecodable}")
    if undecodable == "drop":
        scored = scored.filter(F.col("detections").isNotNull())
    boxes = F.coalesce(F.col("detections"), F.array().cast(DETECTIONS))
    return (scored.withColumn("detail", count_in_array(boxes, min_conf, classes))
            .withColumn("traffic_volume", map_total(F.col("detail")))
            .drop("detections"))
