"""The queries in SQL over the given tables, written apart from the Spark code."""

CAM = "'cam_' || lpad(cast(user_id % 8 AS varchar), 3, '0')"

OBS = f"""obs AS (
  SELECT event_id, {CAM} AS cam_id, coalesce(n_name, 'Unknown') AS location, ts AS "timestamp",
         cast(floor(value) AS integer) AS traffic_volume, event_type, props
  FROM events LEFT JOIN nation ON n_nationkey = user_id % 8)"""


# Parts of eight days.
PART = "least(3, (day(ts) - 1) // 8)"


def averages(width: str) -> str:
    return f"""avgs AS (
  SELECT time_bucket(INTERVAL '{width}', "timestamp") AS start_time,
         time_bucket(INTERVAL '{width}', "timestamp") + INTERVAL '{width}' AS end_time,
         cam_id, location, avg(traffic_volume) AS avg_traffic_volume
  FROM obs GROUP BY ALL)"""


def history(step: str, source: str = "avgs") -> str:
    """Windows of five steps, each shifted by one step, over the averages' end times."""
    return f"""hist AS (
  SELECT end_time + i * INTERVAL '{step}' - 5 * INTERVAL '{step}' AS window_start,
         end_time + i * INTERVAL '{step}' AS window_end, cam_id,
         list(avg_traffic_volume ORDER BY end_time, location, avg_traffic_volume) AS vols,
         list(end_time ORDER BY end_time, location, avg_traffic_volume) AS ends
  FROM {source}, (SELECT unnest(range(1, 6)) AS i)
  GROUP BY ALL)"""


def number(x: str) -> str:
    return f"cast(cast(round({x} * 1000) AS bigint) AS varchar)"


HIST_TEXT = f"""array_to_string(list_transform(range(1, len(ends) + 1),
    lambda i: strftime(ends[i], '%Y-%m-%d %H:%M') || '=' || {number('vols[i]')}), ';')"""

LAGS = """lags AS (
  SELECT window_end AS base_time_t, cam_id, ends, cast(len(vols) AS integer) AS n_observed,
         list_concat(list_transform(range(greatest(5 - len(vols), 0)), lambda y: 20.0::double), vols)[-5:] AS p
  FROM hist)"""

LAG_COLUMNS = """base_time_t, cam_id, round(p[5], 6) + 0.0 AS t, round(p[4], 6) + 0.0 AS t1, round(p[3], 6) + 0.0 AS t2,
       round(p[2], 6) + 0.0 AS t3, round(p[1], 6) + 0.0 AS t4, n_observed"""


def calendar(ts: str) -> str:
    hour = f"(extract(hour FROM {ts}) + extract(minute FROM {ts}) / 60.0::double)"
    return f"""round(sin({hour} * (2 * pi() / 24)), 6) + 0.0 AS hour_sin,
       round(cos({hour} * (2 * pi() / 24)), 6) + 0.0 AS hour_cos,
       cast(isodow({ts}) - 1 AS integer) AS dayofweek"""


BOXES = f"""boxes AS (
  SELECT {CAM} || '/' || strftime(ts, '%Y-%m-%d %H') AS frame_id,
         CASE event_type WHEN 'signup' THEN 'bicycle' WHEN 'view' THEN 'car' WHEN 'click' THEN 'motorcycle'
                         WHEN 'purchase' THEN 'bus' WHEN 'error' THEN 'truck' END AS label,
         value / 500 AS conf, ts, {CAM} AS cam_id
  FROM events)"""


def counted(condition: str) -> str:
    return f"""per_class AS (
  SELECT frame_id, label, count(*) AS n FROM boxes WHERE {condition} GROUP BY ALL),
counted AS (
  SELECT frame_id, string_agg(label || '=' || n, ';' ORDER BY label) AS detail,
         string_agg('"' || label || '":' || n, ',' ORDER BY label) AS pairs,
         cast(sum(n) AS integer) AS traffic_volume
  FROM per_class GROUP BY frame_id)"""


FRAMES = "frames AS (SELECT frame_id, max(ts) AS taken_at, max(cam_id) AS cam_id FROM boxes GROUP BY frame_id)"


def scored(threshold: float) -> str:
    """Boxes are the eight stripes of eight numbers; their maximum is the confidence."""
    return f"""stripes AS (
  SELECT vec_id, s AS class_id, list_max(embedding[s * 8 + 1 : s * 8 + 8]) AS conf
  FROM embeddings, (SELECT unnest(range(8)) AS s) WHERE label <> 3),
hits AS (
  SELECT vec_id, CASE class_id WHEN 1 THEN 'bicycle' WHEN 2 THEN 'car' WHEN 3 THEN 'motorcycle'
                               WHEN 5 THEN 'bus' WHEN 7 THEN 'truck' END AS label
  FROM stripes WHERE class_id IN (1, 2, 3, 5, 7) AND cast(conf AS double) >= {threshold}),
detail AS (
  SELECT vec_id, string_agg(label || '=1', ';' ORDER BY label) AS detail,
         cast(count(*) AS integer) AS traffic_volume
  FROM hits GROUP BY vec_id)"""


SCORED_COLUMNS = """SELECT vec_id AS "offset", 'cam_' || lpad(cast(vec_id % 8 AS varchar), 3, '0') AS cam_id,
       'label_' || label AS location, coalesce(detail, '') AS detail, coalesce(traffic_volume, 0) AS traffic_volume
FROM embeddings LEFT JOIN detail USING (vec_id)"""


def training(condition: str = "true") -> str:
    """Lags and lead along each sensor; `condition` decides which rows are complete."""
    return f"""shifted AS (
  SELECT event_id AS dyna_id, cast(user_id % 8 AS integer) AS entity_id, ts AS "time", value AS t,
         lag(value, 1) OVER w AS t1, lag(value, 2) OVER w AS t2, lag(value, 3) OVER w AS t3,
         lag(value, 4) OVER w AS t4, lead(value, 1) OVER w AS target,
         lag(ts, 1) OVER w AS s1, lag(ts, 2) OVER w AS s2, lag(ts, 3) OVER w AS s3, lag(ts, 4) OVER w AS s4,
         lead(ts, 1) OVER w AS s5
  FROM events WINDOW w AS (PARTITION BY user_id % 8 ORDER BY ts, event_id)),
rows_ AS (
  SELECT dyna_id, entity_id, "time", t, t1, t2, t3, t4, {calendar('"time"')}, target
  FROM shifted WHERE t4 IS NOT NULL AND target IS NOT NULL AND ({condition}))"""


TRAIN_ROUNDED = "t, t1, t2, t3, t4, hour_sin, hour_cos, dayofweek, target"

ENTRIES = """obs_hours AS (SELECT *, date_trunc('hour', "timestamp") AS start_time FROM obs),
history_entries AS (
  SELECT event_id, "timestamp", cam_id, location, start_time, start_time + INTERVAL 1 HOUR AS end_time,
         cast(traffic_volume AS double) AS avg_traffic_volume
  FROM obs_hours),
forecast_entries AS (
  SELECT event_id, "timestamp", cam_id, start_time AS base_time_t,
         start_time + to_hours(cast(extract(minute FROM "timestamp") // 10 AS integer)) + INTERVAL 5 MINUTE AS prediction_timestamp,
         cast(traffic_volume AS double) AS current_volume, cast(traffic_volume + 1 AS double) AS predicted_volume,
         traffic_volume = 20 AS is_padded
  FROM obs_hours),
last_history AS (
  SELECT * FROM history_entries
  QUALIFY row_number() OVER (PARTITION BY cam_id, start_time ORDER BY event_id DESC, "timestamp" DESC) = 1),
last_forecast AS (
  SELECT * FROM forecast_entries
  QUALIFY row_number() OVER (PARTITION BY cam_id, prediction_timestamp ORDER BY event_id DESC, "timestamp" DESC) = 1),
kept_history AS (
  SELECT * FROM last_history
  QUALIFY row_number() OVER (PARTITION BY cam_id ORDER BY start_time DESC) <= 30),
kept_forecast AS (
  SELECT * FROM last_forecast
  QUALIFY row_number() OVER (PARTITION BY cam_id ORDER BY prediction_timestamp DESC) <= 288),
last_end AS (SELECT cam_id, max_by(end_time, start_time) AS last_end FROM kept_history GROUP BY cam_id),
future AS (
  SELECT kept_forecast.* FROM kept_forecast LEFT JOIN last_end USING (cam_id)
  WHERE last_end IS NULL OR prediction_timestamp > last_end),
registered AS (
  SELECT 'cam_' || lpad(cast(n_nationkey AS varchar), 3, '0') AS cam_id, n_name AS place FROM nation),
heard AS (SELECT cam_id, max_by(location, ("timestamp", event_id)) AS location FROM history_entries GROUP BY cam_id),
states AS (
  SELECT cam_id, coalesce(location, place, 'Unknown') AS location, heard.cam_id IS NULL AS waiting
  FROM heard FULL JOIN registered USING (cam_id))"""

VIEW = f"""WITH {OBS}, {ENTRIES},
h AS (SELECT cam_id, string_agg(strftime(end_time, '%Y-%m-%d %H:%M') || '=' || {number('avg_traffic_volume')}, ';'
                                ORDER BY start_time) AS history FROM kept_history GROUP BY cam_id),
f AS (SELECT cam_id, string_agg(strftime(prediction_timestamp, '%Y-%m-%d %H:%M') || '=' ||
                                {number('predicted_volume')}, ';' ORDER BY prediction_timestamp) AS forecast
      FROM future GROUP BY cam_id)
SELECT cam_id, location, waiting, coalesce(history, '') AS history, coalesce(forecast, '') AS forecast
FROM states LEFT JOIN h USING (cam_id) LEFT JOIN f USING (cam_id)"""

AVG_COLUMNS = "start_time, end_time, cam_id, location, round(avg_traffic_volume, 6) + 0.0 AS avg_traffic_volume"

# Windows a stream has closed once all events are in.
CLOSED = """closed AS (
  SELECT * FROM avgs WHERE end_time <= (SELECT max("timestamp") FROM obs) - INTERVAL 10 SECOND)"""
CLOSED_HIST = """closed_hist AS (
  SELECT * FROM hist WHERE window_end <= (SELECT max(end_time) FROM closed) - INTERVAL 1 MINUTE)"""

METRICS = f"""WITH {training()}
SELECT count(*) AS n, round(sqrt(avg(pow(target - t, 2))), 4) AS rmse,
       round(1 - sum(pow(target - t, 2)) / (count(*) * var_pop(target)), 4) AS r2 FROM rows_"""

LEARNED = """SELECT base_time_t + INTERVAL 5 MINUTE AS prediction_timestamp, base_time_t, cam_id, round(p[5], 6) + 0.0 AS current_volume,
       CASE WHEN isodow(base_time_t) >= 6 THEN 30.0::double ELSE 60.0::double END AS predicted_volume, n_observed < 5 AS is_padded
FROM lags"""

SQL = {
    "obs_decode": f'WITH {OBS} SELECT event_id, cam_id, location, "timestamp", traffic_volume FROM obs',
    "header_flatten": f"""WITH {OBS}
SELECT event_id AS "offset", cam_id, CASE WHEN event_type = 'view' THEN 'moved' ELSE location END AS location,
       strftime("timestamp", '%Y-%m-%dT%H:%M:%S.%f') AS taken_at, cast(length(props) AS integer) AS n_bytes
FROM obs WHERE event_type <> 'error'""",
    "bad_record_split": f"""WITH {OBS}
SELECT event_id, CASE event_type WHEN 'signup' THEN NULL WHEN 'click' THEN '' ELSE cam_id END AS cam_id,
       CASE WHEN event_type IN ('signup', 'view') THEN NULL ELSE "timestamp" END AS "timestamp",
       CASE WHEN event_type IN ('signup', 'purchase') THEN NULL ELSE traffic_volume END AS traffic_volume,
       CASE event_type WHEN 'signup' THEN 'malformed' WHEN 'view' THEN 'bad_time' WHEN 'click' THEN 'no_camera'
                       ELSE '' END AS bad_reason
FROM obs""",
    "bad_record_counts": """SELECT CASE event_type WHEN 'signup' THEN 'malformed' WHEN 'view' THEN 'bad_time'
         ELSE 'no_camera' END AS bad_reason, count(*) AS n
FROM events WHERE event_type IN ('signup', 'view', 'click') GROUP BY 1""",
    "observation_json": f"""WITH {OBS}
SELECT event_id, cam_id AS key, '{{"cam_id":"' || cam_id || '","location":"' || location || '","timestamp":"' ||
       strftime("timestamp", '%Y-%m-%dT%H:%M:%S.%f') || '","traffic_volume":' || traffic_volume || '}}' AS value
FROM obs""",
    "average_json": f"""WITH {OBS}, {averages('1 hour')}
SELECT cam_id AS key, '{{"start_time":"' || strftime(start_time, '%Y-%m-%dT%H:%M:%S') || '","end_time":"' ||
       strftime(end_time, '%Y-%m-%dT%H:%M:%S') || '","cam_id":"' || cam_id || '","location":"' || location ||
       '","avg_traffic_volume":' || cast(floor(avg_traffic_volume) AS bigint) || '}}' AS value
FROM avgs""",
    "tumbling_avg": f"WITH {OBS}, {averages('1 hour')} SELECT {AVG_COLUMNS} FROM avgs",
    "tumbling_avg_1min": f"WITH {OBS}, {averages('1 minute')} SELECT {AVG_COLUMNS} FROM avgs",
    "sliding_history": f"""WITH {OBS}, {averages('1 hour')}, {history('1 hour')}
SELECT window_start, window_end, cam_id, {HIST_TEXT} AS history FROM hist""",
    "sliding_history_5min": f"""WITH {OBS}, {averages('1 minute')}, {history('1 minute')}
SELECT window_start, window_end, cam_id, {HIST_TEXT} AS history FROM hist""",
    "padded_lags": f"""WITH {OBS}, {averages('1 hour')}, {history('1 hour')}, {LAGS}
SELECT {LAG_COLUMNS}, n_observed < 5 AS is_padded FROM lags""",
    "padded_lags_latest": f"""WITH {OBS}, {averages('1 hour')}, {history('1 hour')}, {LAGS}
SELECT {LAG_COLUMNS}, p[1] = 20.0 AS is_padded FROM lags WHERE list_max(ends) = base_time_t - INTERVAL 1 HOUR""",
    "calendar_features": f"WITH {OBS} SELECT event_id, {calendar('\"timestamp\"')} FROM obs",
    "calendar_legacy": f"""WITH {OBS}, shifted AS (
  SELECT event_id, extract(hour FROM "timestamp" + INTERVAL 7 HOUR) AS h,
         extract(dow FROM "timestamp" + INTERVAL 7 HOUR) AS d FROM obs)
SELECT event_id, round(sin(h * (2 * pi() / 24)), 6) + 0.0 AS hour_sin,
       round(cos(h * (2 * pi() / 24)), 6) + 0.0 AS hour_cos, cast(d + 1 AS integer) AS dayofweek
FROM shifted""",
    "forecast_features": f"""WITH {OBS}, {averages('1 hour')}, {history('1 hour')}, {LAGS}
SELECT {LAG_COLUMNS}, n_observed < 5 AS is_padded, {calendar('base_time_t')} FROM lags""",
    "naive_forecast": f"""WITH {OBS}, {averages('1 hour')}, {history('1 hour')}, {LAGS}
SELECT base_time_t + INTERVAL 5 MINUTE AS prediction_timestamp, base_time_t, cam_id,
       round(p[5], 6) + 0.0 AS current_volume, round(p[5], 6) + 0.0 AS predicted_volume, n_observed < 5 AS is_padded
FROM lags""",
    "class_counts": f"WITH {BOXES}, {counted('conf >= 0.1')} SELECT frame_id, detail, traffic_volume FROM counted",
    "class_counts_by_name": f"""WITH {BOXES}, {counted("conf >= 0.2 AND label IN ('car', 'motorcycle')")}
SELECT frame_id, detail, traffic_volume FROM counted""",
    "frame_volumes": f"""WITH {BOXES}, {FRAMES}, {counted('conf >= 0.25')}
SELECT frame_id, cam_id, coalesce(detail, '') AS detail, coalesce(traffic_volume, 0) AS traffic_volume
FROM frames LEFT JOIN counted USING (frame_id)""",
    "frame_reports": f"""WITH {BOXES}, {FRAMES}, {counted('conf >= 0.1')}
SELECT frame_id, '{{"timestamp":"' || strftime(taken_at, '%Y-%m-%dT%H:%M:%S') || '","address":"' || cam_id ||
       '","traffic volume":' || coalesce(traffic_volume, 0) || ',"detail":{{' || coalesce(pairs, '') || '}}}}' AS report
FROM frames LEFT JOIN counted USING (frame_id)""",
    "batch_score": f"WITH {scored(0.25)} {SCORED_COLUMNS} WHERE label <> 3",
    "batch_score_keep_undecodable": f"WITH {scored(0.4)} {SCORED_COLUMNS}",
    "frame_rate_cap": f"""WITH {OBS} SELECT event_id, cam_id, "timestamp" FROM obs
QUALIFY row_number() OVER (PARTITION BY cam_id, epoch_us("timestamp") // 1000000
                           ORDER BY "timestamp", event_id) = 1""",
    "frame_rate_cap_sparse": f"""WITH {OBS} SELECT event_id, cam_id, "timestamp" FROM obs
QUALIFY row_number() OVER (PARTITION BY cam_id, epoch_us("timestamp") // 600000000
                           ORDER BY "timestamp", event_id) = 1""",
    "train_features": f"WITH {training()} SELECT * FROM rows_",
    "train_features_gap": "WITH " + training(
        " AND ".join(f'epoch_us("time") - epoch_us(s{k}) <= {k} * 1800000000::bigint' for k in range(1, 5))
        + ' AND epoch_us(s5) - epoch_us("time") <= 1800000000') + " SELECT * FROM rows_",
    "distinct_sensors": "SELECT DISTINCT cast(user_id % 8 AS integer) AS entity_id FROM events",
    "target_bands": f"""WITH {training()}
SELECT count(*) FILTER (target < 150) AS preferred, count(*) FILTER (target >= 150) AS others FROM rows_""",
    "train_sample": f"""WITH {training()} SELECT dyna_id, {TRAIN_ROUNDED} FROM rows_
ORDER BY target >= 150, md5('42|' || dyna_id), dyna_id LIMIT 2000""",
    "train_sample_topped_up": f"""WITH {training()} SELECT dyna_id, {TRAIN_ROUNDED} FROM rows_
ORDER BY target >= 5, md5('42|' || dyna_id), dyna_id LIMIT 2000""",
    "exact_sample": """SELECT event_id AS dyna_id, cast(user_id % 8 AS integer) AS entity_id, value AS traffic_flow
FROM events ORDER BY md5('7|' || event_id), event_id LIMIT 1000""",
    "preview": """SELECT event_id AS dyna_id, ts AS "time", cast(user_id % 8 AS integer) AS entity_id,
       value AS traffic_flow FROM events ORDER BY ts, event_id LIMIT 5""",
    "hash_split": """SELECT event_id AS dyna_id, CASE WHEN
       cast('0x' || substr(md5('42|' || event_id), 1, 8) AS bigint) / 4294967296.0::double < 0.8::double
       THEN 'train' ELSE 'test' END AS part FROM events""",
    "time_split": """WITH cut AS (SELECT min(epoch_us(ts)) + cast(floor(0.8::double *
         cast(max(epoch_us(ts)) - min(epoch_us(ts)) AS double)) AS bigint) AS cut FROM events)
SELECT event_id AS dyna_id, CASE WHEN epoch_us(ts) <= cut THEN 'train' ELSE 'test' END AS part FROM events, cut""",
    "random_split": """SELECT count(*) AS "rows", count(*) AS in_parts, true AS train_is_near_its_share FROM events""",
    "training_csv": f"""WITH {training()}, picked AS (
  SELECT * FROM rows_ ORDER BY target >= 150, md5('42|' || dyna_id), dyna_id LIMIT 2000)
SELECT {TRAIN_ROUNDED} FROM picked""",
    "rmse_r2": METRICS,
    "evaluation_report": METRICS,
    "sensor_csv": """SELECT event_id AS dyna_id, 'state' AS type, ts AS "time",
       cast(user_id % 8 AS integer) AS entity_id, value AS traffic_flow FROM events""",
    "latest_wins": f"""WITH {OBS}, {ENTRIES}
SELECT cam_id, start_time, end_time, location, avg_traffic_volume, event_id AS "offset" FROM last_history""",
    "newest_n": f"""WITH {OBS}, {ENTRIES}
SELECT 'history' AS kind, cam_id, start_time AS time_key, avg_traffic_volume AS volume FROM kept_history
UNION ALL
SELECT 'forecast', cam_id, prediction_timestamp, predicted_volume FROM kept_forecast""",
    "last_history_end": f"""WITH {OBS}, {ENTRIES}
SELECT cam_id, max_by(end_time, start_time) AS last_end FROM history_entries GROUP BY cam_id""",
    "future_forecasts": f"""WITH {OBS}, {ENTRIES}
SELECT cam_id, prediction_timestamp, base_time_t, current_volume, predicted_volume, is_padded FROM future""",
    "camera_view": VIEW,
    "camera_list": """SELECT 'cam_' || lpad(cast(n_nationkey AS varchar), 3, '0') AS id, n_name AS location
FROM nation""",
    "chart_series": f"""WITH {OBS}, {ENTRIES}
SELECT cam_id, 'history' AS series, end_time AS x, avg_traffic_volume AS y FROM kept_history
UNION ALL
SELECT cam_id, 'forecast', prediction_timestamp, predicted_volume FROM future""",
    "registry_lookup": f"""WITH {OBS}
SELECT event_id, cam_id, coalesce(CASE WHEN event_type = 'view' THEN location END, r_name, 'Unknown') AS location
FROM obs LEFT JOIN region ON cam_id = 'cam_' || lpad(cast(r_regionkey AS varchar), 3, '0')""",
    "registry_seed": f"WITH {OBS}, {ENTRIES} SELECT cam_id, location, waiting FROM states",
    "publish_frames": """SELECT vec_id AS "offset", 'traffic-volume' AS topic,
       'cam_' || lpad(cast(vec_id % 8 AS varchar), 3, '0') AS cam_id, 'label_' || label AS location,
       label = 3 AS broken FROM embeddings""",
    "tumbling_avg_stream": f"WITH {OBS}, {averages('1 hour')}, {CLOSED} SELECT {AVG_COLUMNS} FROM closed",
    "sliding_history_stream": f"""WITH {OBS}, {averages('1 hour')}, {CLOSED}, {history('1 hour', 'closed')}, {CLOSED_HIST}
SELECT window_start, window_end, cam_id, {HIST_TEXT} AS history FROM closed_hist""",
    "monitor_stream": f"WITH {scored(0.25)} {SCORED_COLUMNS} WHERE label <> 3".replace(
        'vec_id AS "offset"', "to_timestamp(vec_id + 1704067200) AT TIME ZONE 'UTC' AS \"timestamp\""),
    "frame_rate_cap_stream": f"""WITH {OBS}
SELECT DISTINCT cam_id, time_bucket(INTERVAL 10 MINUTE, "timestamp") AS slot FROM obs""",
    "topic_dispatch": f"""WITH {OBS}, {ENTRIES}
SELECT cam_id, 'history' AS kind, count(*) AS n, max(start_time) AS last_time FROM history_entries GROUP BY cam_id
UNION ALL
SELECT cam_id, 'forecast', count(*), max(prediction_timestamp) FROM forecast_entries GROUP BY cam_id""",
    "bad_record_stream": """SELECT event_id, CASE event_type WHEN 'signup' THEN 'malformed' WHEN 'view' THEN 'bad_time'
       WHEN 'click' THEN 'no_camera' ELSE '' END AS bad_reason FROM events""",
    "counter_stream": f"""WITH {scored(0.4)} SELECT vec_id AS "offset", coalesce(detail, '') AS counts,
       coalesce(traffic_volume, 0) AS total FROM embeddings LEFT JOIN detail USING (vec_id)""",
    "batch_score_workers": f"WITH {scored(0.25)} {SCORED_COLUMNS} WHERE label <> 3",
    "latest_start_stream": f"SELECT event_id, {CAM} AS cam_id FROM events WHERE {PART} >= 2",
    "lost_files_stream": f"SELECT event_id FROM events WHERE {PART} <> 1",
    "late_rows_stream": f"""WITH {OBS}, {averages('1 hour')}, batches AS (
  SELECT cast(unnest(range(5)) AS bigint) AS batch),
marks AS (
  SELECT batch, (SELECT max(ts) FROM events WHERE {PART} < batch) - INTERVAL 10 SECOND AS mark,
         (SELECT max(ts) FROM events WHERE {PART} < batch - 1) - INTERVAL 10 SECOND AS before FROM batches),
cameras AS (SELECT count(DISTINCT user_id % 8) AS n FROM events)
SELECT batch, (SELECT count(*) FROM events WHERE {PART} = batch) + CASE WHEN batch IN (2, 3) THEN n ELSE 0 END AS arrived,
       CASE WHEN batch IN (2, 3) THEN n ELSE 0 END AS late,
       (SELECT count(*) FROM avgs WHERE end_time <= mark AND (before IS NULL OR end_time > before)) AS written
FROM marks, cameras""",
    "restart_from_scratch_stream": f"""WITH {OBS}, {averages('1 hour')}
SELECT cast(generation AS integer) AS generation, cam_id, start_time AS window_start
FROM avgs, (SELECT unnest(range(2)) AS generation)
WHERE end_time > (SELECT max(ts) FROM events) - INTERVAL 10 SECOND""",
    "image_backfill": """WITH asked AS (
  SELECT vec_id, CASE label WHEN 3 THEN 'undecodable' ELSE 'sent' END AS outcome FROM embeddings
  UNION ALL
  SELECT vec_id, 'missing' FROM embeddings WHERE label = 5)
SELECT vec_id, 'cam_' || lpad(cast(vec_id % 8 AS varchar), 3, '0') AS cam_id,
       'at cam_' || lpad(cast(vec_id % 8 AS varchar), 3, '0') AS location, outcome FROM asked""",
    "serving_upsert_stream": VIEW,
    "serving_state_stream": VIEW,
    "camera_document": f"SELECT * FROM ({VIEW}) WHERE cam_id IN ('cam_003', 'cam_012', 'cam_999')",
    "gbt_train_eval": f"""WITH {training()}, picked AS (
  SELECT * FROM rows_ ORDER BY target >= 150, md5('42|' || dyna_id), dyna_id LIMIT 2000),
cut AS (SELECT min(epoch_us("time")) + floor((max(epoch_us("time")) - min(epoch_us("time"))) * 0.8::double) AS last FROM picked),
held AS (SELECT picked.* FROM picked, cut WHERE epoch_us("time") > cut.last)
SELECT count(*) AS n, round(sqrt(avg(pow(target - t, 2))), 4) AS last_value_rmse,
       round(1 - sum(pow(target - t, 2)) / (count(*) * var_pop(target)), 4) AS last_value_r2,
       true AS beats_last_value, 100 AS trees, true AS every_tree_splits FROM held""",
    "gbt_forecast": f"""WITH {OBS}, {averages('1 hour')}, {history('1 hour')}, {LAGS}
{LEARNED}""",
    "stream_forecast": f"""WITH {OBS}, {averages('1 hour')}, {CLOSED}, {history('1 hour', 'closed')}, {CLOSED_HIST}, {LAGS.replace('FROM hist', 'FROM closed_hist')}
{LEARNED}""",
}
