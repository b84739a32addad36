import random
from datetime import datetime, timedelta

import pandas as pd
import pytest
from pyspark.ml.evaluation import RegressionEvaluator
from pyspark.sql import functions as F

from roadpulse.functions.collections import map_total, newest_padded, positive_entries
from roadpulse.operators import features, forecast, lags, model, sampling
from roadpulse.operators.lags import lag_lead
from roadpulse.operators.windows import volume_history
from roadpulse.schemas import TRAINING_ROW
from roadpulse.session import fresh_dir
from roadpulse.sources import files

START = datetime(2025, 1, 1)


def test_padding(spark):
    rows = spark.createDataFrame([(list(map(float, range(1, n + 1))),) for n in (0, 2, 5, 7)], "v array<double>")
    got = [r[0] for r in rows.select(newest_padded(F.col("v"))).collect()]
    assert got == [[20.0] * 5, [20, 20, 20, 1, 2], [1, 2, 3, 4, 5], [3, 4, 5, 6, 7]]
    assert all(len(p) == 5 for p in got)


def test_map_expressions(spark):
    row = spark.sql("SELECT map('a', 2, 'b', 0) AS m").select(
        positive_entries(F.col("m")), map_total(F.col("m")), map_total(F.expr("cast(map() AS map<string,int>)"))).first()
    assert tuple(row) == ({"a": 2}, 2, 0)


def averages(spark, rows):
    at = [(START + timedelta(minutes=m - 1), START + timedelta(minutes=m), c, loc, v) for m, c, loc, v in rows]
    return spark.createDataFrame(at, "start_time timestamp, end_time timestamp, cam_id string, location string, "
                                     "avg_traffic_volume double")


def test_one_average_lies_in_five_windows(spark):
    rows = volume_history(averages(spark, [(5, "a", "x", 1.0)])).orderBy("window_end").collect()
    assert [r.window_end for r in rows] == [START + timedelta(minutes=m) for m in range(6, 11)]
    assert [r.window_start for r in rows] == [START + timedelta(minutes=m) for m in range(1, 6)]


def test_lags_of_a_window(spark):
    rows = averages(spark, [(2, "a", "x", 9.0), (1, "a", "x", 7.0), (3, "a", "x", None)])
    got = {r.base_time_t: r for r in features.padded_lags(volume_history(rows)).collect()}
    third = got[START + timedelta(minutes=3)]
    assert (third.t, third.t1, third.t2, third.t3, third.t4) == (9, 7, 20, 20, 20)
    assert third.n_observed == 2 and third.is_padded
    latest = features.padded_lags(volume_history(rows), require_latest=True)
    assert {r.base_time_t for r in latest.collect()} == {START + timedelta(minutes=2), START + timedelta(minutes=3)}


def test_padded_flag_counts_rows_unless_legacy(spark):
    full = averages(spark, [(m, "a", "x", 20.0) for m in range(1, 6)])
    history = volume_history(full)
    at_six = F.col("base_time_t") == F.lit(START + timedelta(minutes=6))
    assert not features.padded_lags(history).filter(at_six).first().is_padded
    spec = features.FeatureSpec(legacy_padded_flag=True)
    assert features.padded_lags(history, spec).filter(at_six).first().is_padded


def test_training_rows(spark):
    rows = [(1, "s", START + timedelta(minutes=5 * i), 9, float(i + 1)) for i in range(7)]
    history = spark.createDataFrame(rows, "dyna_id long, type string, time timestamp, entity_id int, traffic_flow double")
    got = features.training_features(history)
    assert got.columns == features.TRAINING_COLUMNS
    assert [f.dataType for f in got.schema] == [f.dataType for f in TRAINING_ROW]
    assert sorted((r.t, r.t1, r.t2, r.t3, r.t4, r.target) for r in got.collect()) == [
        (5, 4, 3, 2, 1, 6), (6, 5, 4, 3, 2, 7)]


@pytest.mark.parametrize("seed", range(4))
def test_lags_across_spans_match_one_sort(spark, seed):
    """A series with most of the rows, a sparse one, spans with one row, and equal times."""
    rng = random.Random(seed)
    rows = [("hot", rng.randrange(40) * 60, i) for i in range(300)]
    rows += [("sparse", rng.randrange(20) * 3600, 1000 + i) for i in range(25)]
    rows += [("single", 5, 2000)]
    table = pd.DataFrame(rows, columns=["s", "sec", "n"]).sort_values(["s", "sec", "n"])
    by_series = table.groupby("s")["n"]
    for k in range(1, 5):
        table[f"lag_{k}"] = by_series.shift(k)
    table["lead_1"], table["lead_2"] = by_series.shift(-1), by_series.shift(-2)
    want = {r[2]: tuple(None if pd.isna(x) else int(x) for x in r[3:]) for r in table.itertuples(index=False)}

    df = spark.createDataFrame([(s, START + timedelta(seconds=t), n) for s, t, n in rows],
                               "s string, at timestamp, n int")
    for rows in (1, 3, 40, 1000, None):
        got = lag_lead(df, "s", ["at", "n"], "n", 4, 2, span_rows=rows)
        names = ["lag_1", "lag_2", "lag_3", "lag_4", "lead_1", "lead_2"]
        assert {r.n: tuple(r[c] for c in names) for r in got.collect()} == want


def test_spans_hold_about_as_many_rows_each(spark):
    """A burst of hours, one of a second, and a quiet tail: all spans are about as deep, and lags are right."""
    burst = [START + timedelta(milliseconds=20 * i) for i in range(20_000)]
    second = [START + timedelta(hours=5, microseconds=i) for i in range(5_000)]
    quiet = [START + timedelta(hours=9, minutes=i) for i in range(20_000)]
    rows = [("a", at, i) for i, at in enumerate(burst + second + quiet)] + [("b", START, 0), (None, START, 0)]
    df = spark.createDataFrame(rows, "s string, at timestamp, n int")
    spans = lags._with_spans(df, "s", "at", 2000).filter("s = 'a'").groupBy("__span").agg(F.count(F.lit(1)).alias("n")).collect()
    assert max(r.n for r in spans) <= 4000 and len(spans) <= 2 * 45_000 / 2000
    got = lag_lead(df, "s", ["at"], "n", 2, 1, span_rows=2000).filter("s = 'a'").collect()
    assert len(got) == 45_000 and all(r.lag_2 == (r.n - 2 if r.n > 1 else None) and r.lead_1 == (r.n + 1 if r.n < 44_999 else None) for r in got)


def test_gaps_empty_lags(spark):
    df = spark.createDataFrame([("s", START + timedelta(seconds=t), t) for t in (0, 60, 600)],
                               "s string, at timestamp, n int")
    for limit in (1, None):
        rows = lag_lead(df, "s", ["at"], "n", 2, 1, span_rows=limit, max_gap_seconds=300)
        got = {r.n: (r.lag_1, r.lag_2, r.lead_1) for r in rows.collect()}
        assert got == {0: (None, None, 60), 60: (0, None, None), 600: (None, 0, None)}


def test_few_rows_meet_in_the_last_sort_of_a_sample(spark):
    df = spark.range(200_000).repartition(20)
    picked = sampling.sample_exact(df, 50, ["id"])
    key = sampling.sample_key(["id"], 42)
    assert {r.id for r in picked.collect()} == {r.id for r in df.orderBy(key).limit(50).collect()}
    plan = picked._jdf.queryExecution().optimizedPlan().toString()
    assert "scalar-subquery" in plan and "substring" in plan


def test_samples(spark):
    df = spark.range(500).withColumn("target", F.col("id").cast("double"))
    picked = sampling.sample_preferring(df, 120, F.col("target") < 100, ["id"])
    ids = {r.id for r in picked.collect()}
    assert len(ids) == 120 and set(range(100)) <= ids
    again = {r.id for r in sampling.sample_preferring(df.repartition(7), 120, F.col("target") < 100, ["id"]).collect()}
    assert again == ids
    assert sampling.sample_preferring(df, 1000, F.col("target") < 100, ["id"]).count() == 500
    other = {r.id for r in sampling.sample_exact(df, 120, ["id"], seed=1).collect()}
    assert len(other) == 120 and other != {r.id for r in sampling.sample_exact(df, 120, ["id"], seed=2).collect()}


def test_splits_are_complete_and_apart(spark):
    df = spark.range(2000).withColumn("time", F.timestamp_seconds("id"))
    for train, test in (sampling.split_by_hash(df, 0.8, ["id"]), sampling.split_random(df),
                        sampling.split_by_time(df, 0.8, "time")):
        a, b = {r.id for r in train.collect()}, {r.id for r in test.collect()}
        assert not a & b and len(a | b) == 2000 and 1500 < len(a) < 1700


def training_table(spark, n=300):
    rng = random.Random(5)
    rows = [tuple(rng.random() * 50 for _ in range(5)) + (0.5, 0.5, i % 7, float(i % 50)) for i in range(n)]
    return spark.createDataFrame(rows, TRAINING_ROW)


def test_metrics_match_the_evaluator(spark):
    scored = training_table(spark).withColumn("prediction", F.col("t"))
    ours = model.regression_metrics(scored).first()
    for name in ("rmse", "r2"):
        theirs = RegressionEvaluator(labelCol="target", predictionCol="prediction", metricName=name).evaluate(scored)
        assert ours[name] == pytest.approx(theirs)
    empty = model.regression_metrics(scored.limit(0)).first()
    assert (empty.n, empty.rmse, empty.r2) == (0, None, None)


def test_model_is_saved_with_its_features(spark):
    path = fresh_dir(spark, "model")
    spec = features.FeatureSpec(lag_step="5 minutes")
    for _ in range(2):  # a second save replaces the first
        model.save_model(model.train(training_table(spark), trees=2), path, spec)
    assert model.load_spec(path) == spec
    loaded = model.load_model(path)
    rows = features.serving_features(volume_history(averages(spark, [(1, "a", "x", 7.0)])))
    with_null = rows.unionByName(rows.limit(1).withColumn("t4", F.lit(None).cast("double")))
    got = forecast.forecasts(with_null, loaded, spec).collect()
    assert len(got) == 5
    assert all(r.prediction_timestamp - r.base_time_t == timedelta(minutes=5) for r in got)
    with pytest.raises(Exception):
        model.load_model(path + "-none")


def test_csv_and_report(spark, tmp_path):
    path = str(tmp_path / "rows")
    files.write_csv(training_table(spark, 20), path)
    assert files.read_csv(spark, path, TRAINING_ROW).count() == 20
    assert files.read_csv(spark, path).schema["t"].dataType.typeName() == "double"
    text = tmp_path / "s.dyna"
    text.write_text("dyna_id,type,time,entity_id,traffic_flow\n0,state,2018-01-01T00:05:00Z,3,12.5\n1,state,bad,3,1\n")
    rows = files.read_sensor_history(spark, str(text)).orderBy("dyna_id").collect()
    assert [(r.time, r.entity_id, r.traffic_flow) for r in rows] == [(datetime(2018, 1, 1, 0, 5), 3, 12.5), (None, 3, 1)]
    scored = training_table(spark).withColumn("prediction", F.col("t"))
    files.write_report(model.regression_metrics(scored), str(tmp_path / "report"))
    assert spark.read.json(str(tmp_path / "report")).columns == ["n", "r2", "rmse"]
