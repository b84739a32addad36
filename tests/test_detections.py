import json
from dataclasses import dataclass

import pytest
from pyspark.sql import functions as F

from roadpulse.operators import detections as det
from roadpulse.operators.scoring import observe, score_frames
from tests.detectors import VectorDetector
from roadpulse.sources.files import read_image_frames

BOXES = [("f1", 2, .9), ("f1", 2, .3), ("f1", 5, .2), ("f1", 0, .9)]


def counted(spark, min_conf, undecodable):
    boxes = spark.createDataFrame(BOXES, "frame_id string, class_id int, conf double")
    frames = spark.createDataFrame([("f1", True), ("f2", True), ("f3", False)], "frame_id string, decoded boolean")
    if undecodable == "drop":
        frames = frames.filter("decoded")
    rows = det.attach_counts(frames, det.count_classes(boxes, min_conf))
    return {r.frame_id: (r.detail, r.traffic_volume) for r in rows.collect()}


def test_counts_per_frame(spark):
    assert counted(spark, 0.25, "drop") == {"f1": ({"car": 2}, 2), "f2": ({}, 0)}
    assert counted(spark, 0.4, "empty") == {"f1": ({"car": 1}, 1), "f2": ({}, 0), "f3": ({}, 0)}


def test_class_names_may_share_a_label(spark):
    boxes = spark.createDataFrame([("f", "van", .9), ("f", "lorry", .9), ("f", "cat", .9)],
                                  "frame_id string, name string, conf double")
    row = det.count_classes(boxes, classes={"van": "truck", "lorry": "truck"}, by="name").first()
    assert (row.detail, row.traffic_volume) == ({"truck": 2}, 2)


def test_report(spark):
    rows = spark.sql("SELECT map('car', 2) AS detail, 2 AS traffic_volume")
    text = det.frame_report(rows, F.lit("Test"), F.lit("2025-01-01T00:00:00")).first().report
    assert json.loads(text) == {"timestamp": "2025-01-01T00:00:00", "address": "Test", "traffic volume": 2,
                                "detail": {"car": 2}}


@dataclass(frozen=True)
class CountingDetector:
    """Reports the number of images it is given at once as the class, and checks the model is loaded once."""

    def load(self):
        assert not getattr(CountingDetector, "loaded", False)
        CountingDetector.loaded = True
        return "model"

    def decode(self, payload):
        return None if payload == b"bad" else payload

    def detect(self, model, images):
        assert model == "model"
        return [[(len(images), 1.0)] for _ in images]


def frames(spark, payloads):
    rows = [(f"c{i % 2}", f"t{i}", p) for i, p in enumerate(payloads)]
    return spark.createDataFrame(rows, "cam_id string, timestamp string, value binary").coalesce(1)


def test_sub_batches_and_one_model_per_worker(spark):
    payloads = [b"bad" if i in (3, 50) else b"ok" for i in range(51)]
    rows = score_frames(frames(spark, payloads), CountingDetector(), sub_batch=20).collect()
    sizes = [r.detections[0].class_id if r.detections else None for r in rows]
    assert sizes == [19] * 3 + [None] + [19] * 16 + [20] * 20 + [10] * 10 + [None]


def test_undecodable_frames(spark):
    payloads = [b"[0.1,0.9,0.2,0.5,0,0,0,0]", b"broken", None, b"[0,0,0,0,0,0,0,0]"]
    scored = score_frames(frames(spark, payloads), VectorDetector(), workers=3)

    def volumes(policy):
        return {r.timestamp: (r.traffic_volume, r.detail) for r in observe(scored, undecodable=policy).collect()}

    first = (2, {"bicycle": 1, "motorcycle": 1})
    assert volumes("drop") == {"t0": first, "t3": (0, {})}
    assert volumes("empty") == {"t0": first, "t1": (0, {}), "t2": (0, {}), "t3": (0, {})}
    with pytest.raises(ValueError):
        observe(scored, undecodable="other")


def test_no_frames_keep_the_schema(spark):
    rows = observe(score_frames(frames(spark, [b"x"]).filter("cam_id = 'none'"), VectorDetector()))
    assert rows.count() == 0
    assert rows.columns == ["cam_id", "timestamp", "detail", "traffic_volume"]


def test_image_files_that_are_missing_are_skipped(spark, tmp_path):
    (tmp_path / "a.jpg").write_bytes(b"A")
    (tmp_path / "b.jpg").write_bytes(b"B")
    paths = [str(tmp_path / n) for n in ("a.jpg", "none.jpg", "b.jpg")]
    got = read_image_frames(spark, paths, "cam_000", "here").collect()
    assert sorted(bytes(r.value) for r in got) == [b"A", b"B"]
    assert {bytes(h.value) for r in got for h in r.headers if h.key == "cam_id"} == {b"cam_000"}
    assert read_image_frames(spark, paths[1:2], "cam_000", "here").count() == 0
