"""Queries that train and apply the forecast model."""

from pyspark.sql import functions as F

from roadpulse.functions.envelope import decode
from roadpulse.operators import features, forecast, model, sampling
from roadpulse.plans import streams, tables
from roadpulse.plans.batch import TOPICS
from roadpulse.plans.results import clean
from roadpulse.operators.windows import volume_history
from roadpulse.schemas import FORECAST
from roadpulse.session import fresh_dir
from roadpulse.sources import files
from roadpulse.streaming import jobs


#: Volumes to learn, by day: trees fit a step of one feature exactly, so each forecast is known.
WEEKEND, WEEKDAY = 30.0, 60.0
#: The averages that are served are hourly ones.
SPEC = features.FeatureSpec(lag_step="1 hour")


def _training_table(spark, sf_dir, target="target"):
    """The training sample, with the volume to learn, as a table that the many passes of the training read."""
    rows = features.training_features(tables.sensor_history(spark, sf_dir), SPEC, tie="dyna_id", keep=["dyna_id", "time"])
    rows = files.written(rows, "training-rows")
    sample = sampling.sample_preferring(rows, 2000, F.col("target") < 150, ["dyna_id"])
    return files.written(sample.withColumn("target", F.col(target) if isinstance(target, str) else target), "training")


def _train_and_save(spark, table):
    # Rows overlap with their neighbours in time, so a random split would test on what was trained on.
    train, test = sampling.split_by_time(table, 0.8, "time")
    path = fresh_dir(spark, "model")
    model.save_model(model.train(train), path, SPEC)
    return path, test


_paths: dict[tuple[str, str], str] = {}


def _saved_model(spark, sf_dir):
    """Path of the model for the forecasting queries, trained once per application, as for a deployed job."""
    key = (spark.sparkContext.applicationId, sf_dir)
    if key not in _paths:
        volume = F.when(F.col("dayofweek") >= 5, WEEKEND).otherwise(WEEKDAY)
        _paths[key] = _train_and_save(spark, _training_table(spark, sf_dir, volume))[0]
    return _paths[key]


def gbt_train_eval(spark, sf_dir):
    """A model of the measured flow on held-out rows, beside the forecast that the next value is the last one."""
    path, test = _train_and_save(spark, _training_table(spark, sf_dir))
    fitted = model.load_model(path)
    learned = model.regression_metrics(fitted.transform(test)).select(F.col("n").alias("scored"), F.col("rmse").alias("gbt_rmse"))
    trees = fitted.stages[-1].trees
    naive = model.regression_metrics(test.withColumn("prediction", F.col("t")))
    # both sides are a single row
    return naive.join(learned, F.col("n") == F.col("scored")).select(
        "n", F.round("rmse", 4).alias("last_value_rmse"), F.round("r2", 4).alias("last_value_r2"),
        (F.col("gbt_rmse") < F.col("rmse")).alias("beats_last_value"), F.lit(len(trees)).alias("trees"),
        F.lit(all(tree.numNodes > 1 for tree in trees)).alias("every_tree_splits"))


def gbt_forecast(spark, sf_dir):
    path = _saved_model(spark, sf_dir)
    fitted, spec = model.load_model(path), model.load_spec(path)
    history = volume_history(tables.hourly_averages(spark, sf_dir), spec.history, spec.lag_step)
    return clean(forecast.forecasts(features.serving_features(history, spec), fitted, spec))


def stream_forecast(spark, sf_dir):
    """Events to averages to forecasts, as two streaming queries with a topic between them."""
    path = _saved_model(spark, sf_dir)
    topics, root = streams._aggregated(spark, sf_dir)
    messages = jobs.forecast(topics.stream(TOPICS[0]), model.load_model(path), model.load_spec(path))
    streams.run(topics.writer(messages, TOPICS[1]), messages, f"{root}/checkpoint-forecast")
    return clean(decode(topics.read(TOPICS[1]), FORECAST))


QUERIES = {f.__name__: f for f in (gbt_train_eval, gbt_forecast, stream_forecast)}
