"""Entries of cameras as state of a stream."""

import random

import pytest
from pyspark.sql import functions as F

from roadpulse.operators import serving
from roadpulse.session import fresh_dir
from roadpulse.streaming import jobs
from roadpulse.streaming.keyed_state import camera_lists, held_entries
from tests.test_streaming import (
    FORECASTS, HISTORY, Pipe, at, documents, forecast_message, history_message, history_rows, plain_serving,
)


def run(pipe, limits=(30, 288), **source):
    """All that there is, one batch for each file; the last lists of each camera as the stream gave them."""
    out = fresh_dir(pipe.spark, "lists")

    def keep(rows, batch_id):
        rows.withColumn("batch", F.lit(batch_id)).write.mode("overwrite").parquet(f"{out}/{batch_id}")

    entries = serving.serving_entries(pipe.topics.stream([HISTORY, FORECASTS], **source), HISTORY, FORECASTS)
    states = camera_lists(entries, *limits)
    jobs.start(states.writeStream.foreachBatch(keep), states, f"{pipe.root}/checkpoint", "available now", state_partitions=2,
               rocksdb=True, mode="update").awaitTermination()
    rows = pipe.spark.read.parquet(f"{out}/*").collect()
    return {r.cam_id: r for r in sorted(rows, key=lambda r: r.batch)}


def test_state_through_restarts_equals_all_at_once(spark):
    rng = random.Random(12)
    messages = []
    for i in range(300):
        cam = rng.choice("aab")
        messages.append((HISTORY, history_message(rng.randrange(15), float(i), cam, rng.choice("xyz"))) if rng.random() < .5
                        else (FORECASTS, forecast_message(rng.randrange(15), float(i), cam)))
    limits = (4, 7)
    pipe = Pipe(spark)
    for start in range(0, 300, 100):
        for topic in (HISTORY, FORECASTS):
            own = [(v, start + i) for i, (t, v) in enumerate(messages[start:start + 100]) if t == topic]
            df = spark.createDataFrame(own, "value string, offset long").withColumn("key", F.lit(None).cast("string"))
            pipe.topics.publish(df.coalesce(1), topic)
        lists = run(pipe, limits)
    want = plain_serving(messages, limits)
    held = held_entries(spark, f"{pipe.root}/checkpoint")
    got = {}
    for r in held.collect():
        if r.kind in ("history", "forecast"):
            got.setdefault((r.cam_id, r.kind), []).append(r.avg_traffic_volume if r.kind == "history" else r.predicted_volume)
    assert {k: sorted(v) for k, v in got.items()} == want
    # what the stream gives is what the state holds, in order of time
    for cam, row in lists.items():
        assert sorted(h.avg_traffic_volume for h in row.history) == want[cam, "history"] and len(row.forecast) == limits[1]
        assert [h.start_time for h in row.history] == sorted(h.start_time for h in row.history)
    rows = [(t, v, i) for i, (t, v) in enumerate(messages)]
    df = spark.createDataFrame(rows, "topic string, value string, offset long").withColumn("timestamp", F.lit(at(0)))
    merged = serving.merge_entries(serving.serving_entries(df, HISTORY, FORECASTS), *limits)
    assert documents(held, spark) == documents(merged, spark)


def test_a_batch_touches_the_cameras_it_has(spark):
    pipe = Pipe(spark)
    pipe.topics.publish(history_rows(spark, "a", "b").withColumn("key", F.lit("")), HISTORY)
    pipe.topics.publish(history_rows(spark, "other").limit(0).withColumn("key", F.lit("")), FORECASTS)
    assert set(run(pipe)) == {"a", "b"}
    pipe.topics.publish(history_rows(spark, "b", minute=1, value=2.0).withColumn("key", F.lit("")), HISTORY)
    lists = run(pipe)
    assert set(lists) == {"b"} and [h.avg_traffic_volume for h in lists["b"].history] == [1.0, 2.0]
    first = held_entries(spark, f"{pipe.root}/checkpoint", batch_id=0)
    assert first.filter("kind = 'history'").count() == 2
    assert held_entries(spark, f"{pipe.root}/checkpoint").filter("kind = 'history'").count() == 3


@pytest.mark.parametrize("order", [(0, 1), (1, 0)])
def test_a_later_offset_wins_in_whatever_order_it_comes(spark, order):
    pipe = Pipe(spark)
    for k in order:
        pipe.publish(HISTORY, [history_message(0, float(k), location="xy"[k])], offset=F.lit(k))
    pipe.publish(FORECASTS, [forecast_message(9, 5.0)])
    row = run(pipe, per_trigger=1)["a"]
    assert [h.avg_traffic_volume for h in row.history] == [1.0] and row.location == "y"
