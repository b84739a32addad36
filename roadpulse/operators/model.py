"""Gradient-boosted forecast model: training, evaluation, storage, scoring."""

import json
from dataclasses import asdict

from pyspark.ml import Pipeline, PipelineModel
from pyspark.ml.feature import VectorAssembler
from pyspark.ml.regression import GBTRegressor
from pyspark.sql import DataFrame, SparkSession, functions as F

from roadpulse.operators.features import FEATURES, FeatureSpec


def forecaster(trees: int = 100, step: float = 0.1, depth: int = 5, bins: int = 32, seed: int = 42) -> Pipeline:
    """Assembler and boosted trees. Rows with a null feature are skipped, not fatal."""
    assembler = VectorAssembler(inputCols=FEATURES, outputCol="features", handleInvalid="skip")
    trees = GBTRegressor(featuresCol="features", labelCol="target", maxIter=trees, stepSize=step,
                         maxDepth=depth, maxBins=bins, lossType="squared", seed=seed)
    return Pipeline(stages=[assembler, trees])


def train(rows: DataFrame, **how) -> PipelineModel:
    return forecaster(**how).fit(rows)


def regression_metrics(scored: DataFrame, label: str = "target", prediction: str = "prediction") -> DataFrame:
    """One row: n, rmse and r2, in a single pass."""
    error = F.pow(F.col(label) - F.col(prediction), F.lit(2.0))
    complete = scored.dropna(subset=[label, prediction])
    sums = complete.agg(F.count(F.lit(1)).alias("n"), F.sum(error).alias("sse"), F.var_pop(label).alias("var"))
    return sums.select("n", F.sqrt(F.expr("sse / nullif(n, 0)")).alias("rmse"),
                       F.expr("1 - sse / nullif(var * n, 0)").alias("r2"))


def save_model(model: PipelineModel, path: str, spec: FeatureSpec = FeatureSpec()) -> None:
    """The pipeline model, replacing one that is there, with its feature spec beside the stages."""
    model.write().overwrite().save(path)
    spark = SparkSession.active()
    spark.createDataFrame([(json.dumps(asdict(spec)),)], "value string").coalesce(1).write.text(f"{path}/feature_spec")


def load_model(path: str) -> PipelineModel:
    """The saved model; an error here should end the job, as no forecast can be right without it."""
    return PipelineModel.load(path)


def load_spec(path: str) -> FeatureSpec:
    spark = SparkSession.active()
    return FeatureSpec(**json.loads(spark.read.text(f"{path}/feature_spec").first()["value"]))
