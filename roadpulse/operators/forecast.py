"""Forecast records from scored feature rows."""

from pyspark.ml import PipelineModel
from pyspark.sql import DataFrame, functions as F

from roadpulse.operators.features import FeatureSpec


def forecasts(features: DataFrame, model: PipelineModel, spec: FeatureSpec = FeatureSpec()) -> DataFrame:
    """Score feature rows, of a table or a stream, and shape them as forecasts."""
    return forecast_rows(model.transform(features), spec)


def forecast_rows(scored: DataFrame, spec: FeatureSpec = FeatureSpec(), prediction: str = "prediction") -> DataFrame:
    return scored.select(
        (F.col("base_time_t") + F.expr(f"INTERVAL {spec.horizon}")).alias("prediction_timestamp"),
        "base_time_t",
        "cam_id",
        F.col("t").alias("current_volume"),
        F.col(prediction).alias("predicted_volume"),
        "is_padded",
    )
