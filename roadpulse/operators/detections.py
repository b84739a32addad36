"""Detections to counts per class, volumes per frame, and observations."""

from collections.abc import Mapping

from pyspark.sql import Column, DataFrame, functions as F

from roadpulse.functions.collections import map_total, positive_entries

# Class ids of the COCO data set that count as vehicles.
VEHICLE_CLASSES = {1: "bicycle", 2: "car", 3: "motorcycle", 5: "bus", 7: "truck"}

# Least confidence of a detection in the monitoring job, and in the plain counter.
DEFAULT_CONFIDENCE = 0.25
COUNTER_CONFIDENCE = 0.4


def keep_vehicles(detections: DataFrame, min_conf: float = DEFAULT_CONFIDENCE,
                  classes: Mapping = VEHICLE_CLASSES, by: str = "class_id") -> DataFrame:
    """Detections of an allowed class with enough confidence. `classes` maps ids, or names, to labels."""
    return detections.filter(F.col(by).isin(*classes) & (F.col("conf") >= min_conf))


def count_classes(detections: DataFrame, min_conf: float = DEFAULT_CONFIDENCE,
                  classes: Mapping = VEHICLE_CLASSES, by: str = "class_id",
                  frame: str = "frame_id") -> DataFrame:
    """Per frame with a vehicle: `detail`, the positive counts per label, and `traffic_volume`.

    One counter per label, so that the counts combine before the shuffle and need no list.
    """
    labels = sorted(set(classes.values()))
    ids = {label: [k for k, v in classes.items() if v == label] for label in labels}
    counters = [F.count_if(F.col(by).isin(*ids[label])).cast("int").alias(label) for label in labels]
    counted = keep_vehicles(detections, min_conf, classes, by).groupBy(frame).agg(*counters)
    entries = [c for label in labels for c in (F.lit(label), F.col(label))]
    return (counted.select(frame, positive_entries(F.create_map(*entries)).alias("detail"))
            .withColumn("traffic_volume", map_total(F.col("detail"))))


def attach_counts(frames: DataFrame, counts: DataFrame, frame: str = "frame_id") -> DataFrame:
    """Every frame with its counts: volume 0 and an empty map where nothing was counted."""
    empty = F.expr("cast(map() as map<string, int>)")
    return (frames.join(counts, frame, "left")
            .withColumn("detail", F.coalesce("detail", empty))
            .withColumn("traffic_volume", F.coalesce("traffic_volume", F.lit(0))))


def count_in_array(detections: Column, min_conf: float = DEFAULT_CONFIDENCE,
                   classes: Mapping = VEHICLE_CLASSES) -> Column:
    """Positive counts per label from a frame's own detections array; no shuffle."""
    def count(class_id):
        return F.size(F.filter(detections, lambda d: (d["class_id"] == class_id) & (d["conf"] >= min_conf)))

    entries = [c for class_id, label in classes.items() for c in (F.lit(label), count(class_id))]
    return positive_entries(F.create_map(*entries))


def frame_report(counted: DataFrame, address: Column, at: Column, keep=()) -> DataFrame:
    """A JSON record per frame: time, address, total and counts per class."""
    record = F.struct(at.alias("timestamp"), address.alias("address"),
                      F.col("traffic_volume").alias("traffic volume"), F.col("detail"))
    return counted.select(*keep, F.to_json(record).alias("report"))
