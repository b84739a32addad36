"""The camera registry, a small dimension table."""

from collections.abc import Iterable, Mapping

from pyspark.sql import DataFrame, SparkSession

from roadpulse.schemas import REGISTRY


def registry(spark: SparkSession, cameras: Iterable[Mapping[str, str]]) -> DataFrame:
    """Registry from the `cameras` list of a job's configuration; the first entry of a camera counts."""
    names, first = REGISTRY.fieldNames(), {}
    for camera in cameras:
        first.setdefault(camera.get("camera_id"), camera)
    return spark.createDataFrame([tuple(c.get(n) for n in names) for c in first.values()], REGISTRY)


def camera_list(cameras: DataFrame) -> DataFrame:
    """One row per registered camera: id and location."""
    return cameras.selectExpr("camera_id AS id", "location")
