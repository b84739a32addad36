"""Queries over tables."""

from pyspark.sql import functions as F

from roadpulse.functions.calendar import calendar_features, legacy_calendar_features
from roadpulse.functions.envelope import decode, encode
from roadpulse.functions.headers import make_headers
from roadpulse.operators import detections as det, features, forecast, ingest, model, sampling, scoring, serving
from roadpulse.operators.windows import average_volume, volume_history
from roadpulse.plans import tables
from roadpulse.plans.results import clean, counts_text, forecast_text, history_text, plain_times
from roadpulse.schemas import FORECAST
from roadpulse.session import fresh_dir
from roadpulse.sources import files
from roadpulse.sources.registry import camera_list as registered_cameras
from roadpulse.sources.topics import DirectoryTopics

TOPICS = ("traffic-aggregated", "traffic-forecast")


# Messages

def obs_decode(spark, sf_dir):
    messages = ingest.encode_observations(tables.observations(spark, sf_dir), keep=["event_id"])
    decoded = ingest.decode_observations(messages, keep=["event_id"])
    return clean(decoded.drop("detail"))


def header_flatten(spark, sf_dir):
    """Frames where some events give no camera header, and some give the location twice."""
    rows = tables.observe_events(tables.events(spark, sf_dir), tables.registry(spark, sf_dir),
                                 keep=["event_type", "props"])
    text = F.date_format("timestamp", "yyyy-MM-dd'T'HH:mm:ss.SSSSSS")
    usual = make_headers(cam_id=F.col("cam_id"), location=F.col("location"), timestamp=text)
    nameless = make_headers(location=F.col("location"), timestamp=text)
    twice = F.concat(usual, make_headers(location=F.lit("moved")))
    frames = rows.select(
        F.col("event_id").alias("offset"), F.encode("props", "UTF-8").alias("value"),
        F.when(F.col("event_type") == "error", nameless).when(F.col("event_type") == "view", twice)
        .otherwise(usual).alias("headers"))
    flat = ingest.flatten_frames(frames, keep=["offset"])
    return flat.select("offset", "cam_id", "location", F.col("timestamp").alias("taken_at"),
                       F.length("value").alias("n_bytes"))


def partly_broken(spark, sf_dir):
    """Observation messages that are broken in a way that depends on the event's type."""
    rows = tables.observe_events(tables.events(spark, sf_dir), tables.registry(spark, sf_dir), keep=["event_type"])
    whole = ingest.encode_observations(rows, keep=["event_id", "event_type"])
    kind = F.col("event_type")
    broken = (F.when(kind == "signup", F.lit("{bad"))
              .when(kind == "view", F.regexp_replace("value", '"timestamp":"[^"]*"', '"timestamp":"None"'))
              .when(kind == "click", F.regexp_replace("value", '"cam_id":"[^"]*"', '"cam_id":""'))
              .when(kind == "purchase", F.regexp_replace("value", '"traffic_volume":[0-9]+', '"traffic_volume":"many"')))
    return whole.withColumn("value", F.coalesce(broken, F.col("value")))


def bad_record_split(spark, sf_dir):
    """All messages, those that cannot be used with their reason."""
    checked = ingest.check_observations(partly_broken(spark, sf_dir), keep=["event_id"])
    return clean(checked.select("event_id", "cam_id", "timestamp", "traffic_volume",
                                F.coalesce("bad_reason", F.lit("")).alias("bad_reason")))


def bad_record_counts(spark, sf_dir):
    _, bad = ingest.split_bad_records(partly_broken(spark, sf_dir), keep=["event_id"])
    return bad.groupBy("bad_reason").agg(F.count(F.lit(1)).alias("n"))


def observation_json(spark, sf_dir):
    rows = tables.observations(spark, sf_dir)
    text = F.date_format("timestamp", "yyyy-MM-dd'T'HH:mm:ss.SSSSSS")
    return ingest.encode_observations(rows.withColumn("timestamp", text), keep=["event_id"])


def average_json(spark, sf_dir):
    averages = plain_times(tables.hourly_averages(spark, sf_dir))
    rows = averages.withColumn("avg_traffic_volume", F.floor("avg_traffic_volume"))
    stamped = rows.withColumns({c: F.date_format(c, "yyyy-MM-dd'T'HH:mm:ss") for c in ("start_time", "end_time")})
    return encode(stamped, "cam_id", stamped.columns)


# Windows and features

def tumbling_avg(spark, sf_dir):
    return clean(tables.hourly_averages(spark, sf_dir))


def tumbling_avg_1min(spark, sf_dir):
    return clean(average_volume(tables.observations(spark, sf_dir)))


def _history(spark, sf_dir):
    return volume_history(tables.hourly_averages(spark, sf_dir), "5 hours", "1 hour")


def sliding_history(spark, sf_dir):
    rows = _history(spark, sf_dir)
    return clean(rows.select("window_start", "window_end", "cam_id", history_text(F.col("history")).alias("history")))


def sliding_history_5min(spark, sf_dir):
    rows = volume_history(average_volume(tables.observations(spark, sf_dir)))
    return clean(rows.select("window_start", "window_end", "cam_id", history_text(F.col("history")).alias("history")))


def padded_lags(spark, sf_dir):
    return clean(features.padded_lags(_history(spark, sf_dir)))


def padded_lags_latest(spark, sf_dir):
    spec = features.FeatureSpec(lag_step="1 hour", legacy_padded_flag=True)
    return clean(features.padded_lags(_history(spark, sf_dir), spec, require_latest=True))


def _calendar(spark, sf_dir, make):
    rows = tables.observations(spark, sf_dir)
    return clean(rows.select("event_id", *[c.alias(n) for n, c in make(F.col("timestamp")).items()]))


def calendar(spark, sf_dir):
    return _calendar(spark, sf_dir, calendar_features)


def calendar_legacy(spark, sf_dir):
    return _calendar(spark, sf_dir, legacy_calendar_features)


def forecast_features(spark, sf_dir):
    return clean(features.serving_features(_history(spark, sf_dir)))


def naive_forecast(spark, sf_dir):
    """Forecast records that predict the current volume, encoded and decoded."""
    scored = features.serving_features(_history(spark, sf_dir)).withColumn("prediction", F.col("t"))
    records = forecast.forecast_rows(scored)
    return clean(decode(encode(records, "cam_id", FORECAST.fieldNames()), FORECAST))


# Detections

def class_counts(spark, sf_dir):
    counted = det.count_classes(tables.detections(spark, sf_dir), min_conf=0.1)
    return counted.select("frame_id", counts_text(F.col("detail")).alias("detail"), "traffic_volume")


def class_counts_by_name(spark, sf_dir):
    names = {name: det.VEHICLE_CLASSES[i] for name, i in tables.CLASS_OF_EVENT.items() if i in (2, 3)}
    counted = det.count_classes(tables.detections(spark, sf_dir), 0.2, names, by="class_name")
    return counted.select("frame_id", counts_text(F.col("detail")).alias("detail"), "traffic_volume")


def frame_volumes(spark, sf_dir):
    counted = det.count_classes(tables.detections(spark, sf_dir))
    frames = tables.frames(spark, sf_dir).select("frame_id", "cam_id")
    rows = det.attach_counts(frames, counted)
    return rows.select("frame_id", "cam_id", counts_text(F.col("detail")).alias("detail"), "traffic_volume")


def frame_reports(spark, sf_dir):
    counted = det.count_classes(tables.detections(spark, sf_dir), min_conf=0.1)
    rows = det.attach_counts(tables.frames(spark, sf_dir), counted)
    at = F.date_format("taken_at", "yyyy-MM-dd'T'HH:mm:ss")
    return det.frame_report(rows, F.col("cam_id"), at, keep=["frame_id"])


def _scored(spark, sf_dir):
    flat = ingest.flatten_frames(tables.vector_frames(spark, sf_dir), keep=["offset"])
    return flat.withColumn("detections", tables.striped_detections(F.col("value"))).drop("value")


def batch_score(spark, sf_dir):
    rows = scoring.observe(_scored(spark, sf_dir))
    return rows.select("offset", "cam_id", "location", counts_text(F.col("detail")).alias("detail"), "traffic_volume")


def batch_score_keep_undecodable(spark, sf_dir):
    rows = scoring.observe(_scored(spark, sf_dir), det.COUNTER_CONFIDENCE, undecodable="empty")
    return rows.select("offset", "cam_id", "location", counts_text(F.col("detail")).alias("detail"), "traffic_volume")


def frame_rate_cap(spark, sf_dir):
    rows = ingest.cap_frame_rate(tables.observations(spark, sf_dir), tie="event_id")
    return clean(rows.select("event_id", "cam_id", "timestamp"))


def frame_rate_cap_sparse(spark, sf_dir):
    """At most one frame per camera in ten minutes."""
    rows = ingest.cap_frame_rate(tables.observations(spark, sf_dir), fps=1 / 600, tie="event_id")
    return clean(rows.select("event_id", "cam_id", "timestamp"))


# Training data


def _training_rows(spark, sf_dir):
    return features.training_features(tables.sensor_history(spark, sf_dir), tie="dyna_id",
                                      keep=["dyna_id", "entity_id", "time"])


def train_features(spark, sf_dir):
    return clean(_training_rows(spark, sf_dir))


def train_features_gap(spark, sf_dir):
    """Lags across more than half an hour per step count as missing."""
    rows = features.training_features(tables.sensor_history(spark, sf_dir), tie="dyna_id",
                                      keep=["dyna_id", "entity_id", "time"], max_gap_seconds=1800)
    return clean(rows)


def distinct_sensors(spark, sf_dir):
    return tables.sensor_history(spark, sf_dir).select("entity_id").distinct()


def target_bands(spark, sf_dir):
    rows = _training_rows(spark, sf_dir)
    preferred = F.col("target") < 150
    return rows.agg(F.count_if(preferred).alias("preferred"), F.count_if(~preferred).alias("others"))


def _training_sample(spark, sf_dir, threshold):
    # the sampler reads its rows for their counts and again for themselves; the lags are made once
    rows = files.written(_training_rows(spark, sf_dir), "training-rows")
    return sampling.sample_preferring(rows, 2000, F.col("target") < threshold, ["dyna_id"])


def train_sample(spark, sf_dir):
    return clean(_training_sample(spark, sf_dir, 150).select("dyna_id", *features.TRAINING_COLUMNS))


def train_sample_topped_up(spark, sf_dir):
    """Too few targets lie below 5, so others fill the sample."""
    return clean(_training_sample(spark, sf_dir, 5).select("dyna_id", *features.TRAINING_COLUMNS))


def exact_sample(spark, sf_dir):
    rows = sampling.sample_exact(tables.sensor_history(spark, sf_dir), 1000, ["dyna_id"], seed=7)
    return rows.select("dyna_id", "entity_id", "traffic_flow")


def preview(spark, sf_dir):
    rows = tables.sensor_history(spark, sf_dir).orderBy("time", "dyna_id").limit(5)
    return plain_times(rows.select("dyna_id", "time", "entity_id", "traffic_flow"))


def hash_split(spark, sf_dir):
    parts = sampling.split_by_hash(tables.sensor_history(spark, sf_dir), 0.8, ["dyna_id"])
    train, test = [p.select("dyna_id", F.lit(n).alias("part")) for p, n in zip(parts, ("train", "test"))]
    return train.unionByName(test)


def time_split(spark, sf_dir):
    parts = sampling.split_by_time(tables.sensor_history(spark, sf_dir), 0.8, "time")
    train, test = [p.select("dyna_id", F.lit(n).alias("part")) for p, n in zip(parts, ("train", "test"))]
    return train.unionByName(test)


def random_split(spark, sf_dir):
    """The parts of the seeded split: together the table, apart from each other, and near their shares."""
    train, test = [p.select("dyna_id", F.lit(n).alias("train")) for p, n in
                   zip(sampling.split_random(tables.sensor_history(spark, sf_dir)), (1, 0))]
    rows = train.unionByName(test).groupBy("dyna_id").agg(F.count(F.lit(1)).alias("n"), F.sum("train").alias("train"))
    share = F.sum("train") / F.sum("n")
    # four standard deviations of a share of 0.8
    near = F.abs(share - 0.8) <= 4 * F.sqrt(F.lit(0.16) / F.sum("n"))
    return rows.agg(F.count(F.lit(1)).alias("rows"), F.sum("n").alias("in_parts"), near.alias("train_is_near_its_share"))


def training_csv(spark, sf_dir):
    """The training sample written as CSV and read back with inferred types."""
    path = fresh_dir(spark, "training-csv")
    files.write_csv(_training_sample(spark, sf_dir, 150).select(*features.TRAINING_COLUMNS), path)
    return clean(files.read_csv(spark, path))


def rmse_r2(spark, sf_dir):
    """The forecast that the next value is the current one, scored on all training rows."""
    rows = _training_rows(spark, sf_dir).withColumn("prediction", F.col("t"))
    return model.regression_metrics(rows).select("n", *[F.round(c, 4).alias(c) for c in ("rmse", "r2")])


def evaluation_report(spark, sf_dir):
    """The same, written as a report and read back."""
    path = fresh_dir(spark, "report")
    files.write_report(rmse_r2(spark, sf_dir), path)
    return spark.read.schema("n bigint, rmse double, r2 double").json(path)


def sensor_csv(spark, sf_dir):
    """Sensor history written as CSV and read back."""
    path = fresh_dir(spark, "sensor-csv")
    rows = tables.sensor_history(spark, sf_dir)
    text = F.date_format("time", "yyyy-MM-dd'T'HH:mm:ss.SSSSSSXXX")
    files.write_csv(rows.withColumn("time", text), path)
    return plain_times(files.read_sensor_history(spark, path))


# Serving

def _messages(spark, sf_dir):
    return tables.serving_messages(tables.events(spark, sf_dir), tables.registry(spark, sf_dir))


def _entries(spark, sf_dir):
    return serving.serving_entries(_messages(spark, sf_dir), *TOPICS)


def _history_entries(spark, sf_dir):
    history = _messages(spark, sf_dir).filter(F.col("topic") == TOPICS[0])
    return serving.serving_entries(history, *TOPICS)


def latest_wins(spark, sf_dir):
    rows = serving.latest_wins(_history_entries(spark, sf_dir), ["cam_id", "start_time"])
    return clean(rows.select("cam_id", "start_time", "end_time", "location", "avg_traffic_volume",
                             F.col("seq.offset").alias("offset")))


def newest_n(spark, sf_dir):
    rows = serving.newest_entries(_entries(spark, sf_dir))
    volume = F.coalesce("avg_traffic_volume", "predicted_volume").alias("volume")
    return clean(rows.select("kind", "cam_id", "time_key", volume))


def last_history_end(spark, sf_dir):
    return clean(serving.last_history_end(_history_entries(spark, sf_dir)))


def future_forecasts(spark, sf_dir):
    rows = serving.future_forecasts(serving.newest_entries(_entries(spark, sf_dir)))
    return clean(rows.select("cam_id", "prediction_timestamp", "base_time_t", "current_volume",
                             "predicted_volume", "is_padded"))


def _documents(spark, sf_dir):
    return serving.camera_documents(serving.merge_entries(_entries(spark, sf_dir)), tables.registry(spark, sf_dir))


def document_rows(documents):
    return documents.select("cam_id", "location", (F.col("last_updated") == serving.WAITING).alias("waiting"),
                            history_text(F.col("history")).alias("history"),
                            forecast_text(F.col("forecast")).alias("forecast"))


def camera_view(spark, sf_dir):
    return document_rows(_documents(spark, sf_dir))


def camera_list(spark, sf_dir):
    return registered_cameras(tables.registry(spark, sf_dir))


def chart_series(spark, sf_dir):
    return clean(serving.chart_series(_documents(spark, sf_dir)))


def registry_lookup(spark, sf_dir):
    """Regions as the registry of five cameras; events of one type report a location of their own."""
    region = spark.read.parquet(f"{sf_dir}/region.parquet")
    known = region.select(tables.camera_id(F.col("r_regionkey")).alias("camera_id"), F.col("r_name").alias("location"))
    rows = tables.observe_events(tables.events(spark, sf_dir), tables.registry(spark, sf_dir), keep=["event_type"])
    rows = rows.withColumn("location", F.when(F.col("event_type") == "view", F.col("location")))
    return serving.locate(rows, known).select("event_id", "cam_id", "location")


def registry_seed(spark, sf_dir):
    states = serving.camera_states(_entries(spark, sf_dir))
    rows = serving.seed_registered(states, tables.registry(spark, sf_dir))
    return rows.select("cam_id", "location", (F.col("last_updated") == serving.WAITING).alias("waiting"))


# Topics

def publish_frames(spark, sf_dir):
    """Frames published to a topic and read back from it."""
    topics = DirectoryTopics(spark, fresh_dir(spark, "topics"))
    topics.publish(tables.vector_frames(spark, sf_dir), "traffic-volume")
    flat = ingest.flatten_frames(topics.read("traffic-volume"), keep=["offset", "topic"])
    return flat.select("offset", "topic", "cam_id", "location", (F.length("value") == 6).alias("broken"))


QUERIES = {f.__name__: f for f in (
    obs_decode, header_flatten, bad_record_split, bad_record_counts, observation_json, average_json,
    tumbling_avg, tumbling_avg_1min, sliding_history, sliding_history_5min, padded_lags, padded_lags_latest,
    forecast_features, naive_forecast, class_counts, class_counts_by_name, frame_volumes, frame_reports,
    batch_score, batch_score_keep_undecodable, frame_rate_cap, frame_rate_cap_sparse, train_features,
    train_features_gap, distinct_sensors, target_bands, train_sample, train_sample_topped_up, exact_sample, preview,
    hash_split, random_split, time_split, training_csv, rmse_r2, evaluation_report, sensor_csv, latest_wins, newest_n, last_history_end, future_forecasts,
    camera_view, camera_list, chart_series, registry_lookup, registry_seed, publish_frames,
)} | {"calendar_features": calendar, "calendar_legacy": calendar_legacy}
