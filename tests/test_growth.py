"""Queries on larger tables: no more batches, and no more rows for one camera's task."""

import json
import os
import random
from urllib.parse import urlparse

import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from roadpulse.llm.components import components
from roadpulse.plans import arrivals, streams
from roadpulse.session import fresh_dir
from roadpulse.sources import files
from roadpulse.sources.paths import Folder
from roadpulse.streaming.keyed_state import _cut


def _tables(spark, path, n):
    spark.range(n).select(
        F.col("id").alias("event_id"), F.expr("timestamp_ntz '2024-01-01 00:00:00' + make_dt_interval(0, 0, 0, id % 2000000)").alias("ts"),
        (F.col("id") % 16).alias("user_id"), F.lit("view").alias("event_type"), F.lit(1.5).alias("value"), F.lit("{}").alias("props"),
    ).write.parquet(f"{path}/events.parquet")
    spark.sql("SELECT 1L AS n_nationkey, 'here' AS n_name").write.parquet(f"{path}/nation.parquet")
    return str(path)


def test_a_larger_table_comes_in_larger_files(spark, tmp_path, monkeypatch):
    class Seen(Exception):
        pass

    def topics(spark, root, messages_per_file):
        raise Seen(messages_per_file)

    monkeypatch.setattr(arrivals, "DirectoryTopics", topics)
    for n, per_file in ((5_000, 1_000), (1_000_000, 10_000)):
        with pytest.raises(Seen) as seen:
            arrivals.latest_start_stream(spark, _tables(spark, tmp_path / str(n), n))
        assert seen.value.args == (per_file,)


def test_a_part_of_many_files_is_one_batch(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(streams, "FILE_MESSAGES", 10)
    path = _tables(spark, tmp_path, 100)
    topics, _, per_part = streams._published(spark, path)
    assert per_part == 3
    for topic in streams.TOPICS:
        assert len([n for n in Folder(spark, topics.path(topic)).names() if n.startswith("part-")]) == 3 * streams.PARTS
        assert sorted(r.offset for r in topics.read(topic).collect()) == list(range(100))


def test_a_task_sends_only_entries_that_may_be_held():
    rng, limits = random.Random(1), {"history": 3, "forecast": 5}
    rows = [{"cam_id": f"cam_{rng.randrange(2)}", "kind": rng.choice(list(limits)), "time_key": rng.randrange(40), "offset": rng.randrange(-1, 5000),
             "sent": rng.randrange(3), "tie": k, "location": rng.choice([None, "here", "there"])} for k in range(6000)]
    table = pa.Table.from_pylist(rows)
    sent = pa.Table.from_batches(list(_cut(limits)(iter(table.to_batches(max_chunksize=500)))), table.schema).to_pylist()

    def version(row):
        return row["offset"], row["sent"], row["tie"]

    def held(given):
        out = {}
        for cam in ("cam_0", "cam_1"):
            own = sorted((r for r in given if r["cam_id"] == cam), key=version)
            for kind, limit in limits.items():
                last = {r["time_key"]: version(r) for r in own if r["kind"] == kind}
                out[cam, kind] = sorted(last.items())[-limit:]
            out[cam, "place"] = [(version(r), r["location"]) for r in own if r["kind"] == "history" and r["location"]][-1]
            out[cam, "heard"] = version(own[-1])
        return out

    assert held(sent) == held(rows) and len(sent) <= 2 * (3 + 5 + 2)
    assert list(_cut(limits)(iter([]))) == []


def test_files_are_read_in_a_bounded_number_of_tasks(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(files, "FILE_TASKS", 1)
    spark.range(200).select(F.col("id").cast("string").alias("value"), "id").repartition(1).write.partitionBy("id").text(f"{tmp_path}/images")
    listed = files.list_files(spark, f"{tmp_path}/images", pathGlobFilter="part-*")
    assert listed.rdd.getNumPartitions() == spark.sparkContext.defaultParallelism
    assert sorted(int(r.content) for r in listed.collect()) == list(range(200))


VECTORS = [(k, [k / 100] * 64, k % 7) for k in range(60)] + [(3, [.5] * 64, 2), (4, None, 4), (5, [.5] * 64, None), (61, None, 5)]


def _vectors(spark, path):
    spark.createDataFrame(VECTORS, "vec_id bigint, embedding array<float>, label int").repartition(3).write.parquet(f"{path}/embeddings.parquet")
    return str(path)


def test_image_files_need_no_folder_of_their_own(spark, tmp_path, monkeypatch):
    class Seen(Exception):
        pass

    def backfill(asked, folder, decodes):
        raise Seen(folder, asked.collect())

    monkeypatch.setattr(arrivals, "backfill_frames", backfill)
    with pytest.raises(Seen) as seen:
        arrivals.image_backfill(spark, _vectors(spark, tmp_path))
    folder, asked = seen.value.args
    walked = list(os.walk(urlparse(folder).path))
    found = {f"file:{at}/{name}" for at, _, names in walked for name in names}
    assert found == {r.path for r in asked if "/no-" not in r.path} and len(found) == 61
    # folders of tasks and cameras, but not of vectors, and each of them is listed with one call
    assert len([at for at, _, names in walked if names]) <= 8 * files.LOCAL_TASKS * spark.sparkContext.defaultParallelism
    assert not any("vec_id" in at for at, _, _ in walked)


def test_image_backfill_with_repeated_and_missing_values(spark, tmp_path, monkeypatch):
    """Vectors of one number share a file, which then holds several images and is none; the same in a store that only Spark reads."""
    path = _vectors(spark, tmp_path)

    def outcomes():
        return sorted((r.vec_id, r.cam_id, r.location, r.outcome) for r in arrivals.image_backfill(spark, path).collect())

    got = outcomes()
    alone = {k: "sent" for k, _, _ in VECTORS} | {k: "undecodable" for k in (3, 5, 61)} | {k: "undecodable" for k, _, label in VECTORS if label == 3}
    alone[4] = "sent"  # the line of the other is empty
    asked = [*alone.items(), *((k, "missing") for k, _, label in VECTORS if label == 5)]
    assert got == sorted((k, f"cam_{k % 8:03}", f"at cam_{k % 8:03}", outcome) for k, outcome in asked)
    monkeypatch.setattr(files, "_local_path", lambda spark, path: None)
    assert outcomes() == got


def test_texts_of_keys(spark, tmp_path):
    rows = [("a", 1, "x"), ("a", 1, None), ("a", 2, "y\u00e9"), (None, 3, "z"), ("b/c", None, "")]
    frame = spark.createDataFrame(rows, "cam string, id long, value string").repartition(5)
    for _ in range(2):  # a task that runs again writes the same files
        files.write_texts(frame, ["cam", "id"], f"file:{tmp_path}/texts")
    found = {"/".join(os.path.join(at, name).split("/")[-2:]): open(os.path.join(at, name), "rb").read() for at, _, names in os.walk(tmp_path) for name in names}
    assert sorted(found.pop("cam=a/id=1.txt").splitlines()) == [b"", b"x"]
    assert found == {"cam=a/id=2.txt": "y\u00e9\n".encode(), "cam=__HIVE_DEFAULT_PARTITION__/id=3.txt": b"z\n", "cam=b%2Fc/id=__HIVE_DEFAULT_PARTITION__.txt": b"\n"}


def test_local_files_are_listed_as_by_spark(spark, tmp_path):
    for name in ("a.json", "sub/b c%.json", "sub/x=1/deep/_y=2/c.json", "_hidden", ".hidden", "_skipped/d.json", ".skipped/e.json", "f._COPYING_", "sub/empty"):
        (tmp_path / name).parent.mkdir(parents=True, exist_ok=True)
        (tmp_path / name).write_text("" if name.endswith("empty") else name)
    os.symlink(tmp_path / "a.json", tmp_path / "sub" / "link.json")
    os.symlink(tmp_path / "gone", tmp_path / "sub" / "dangling")
    folders = [str(tmp_path), f"file://{tmp_path}/sub/", f"{tmp_path}"]
    theirs = spark.read.format("binaryFile").option("recursiveFileLookup", True).load(folders).select("path", "modificationTime", "length")
    ours = files.list_files(spark, folders, contents=False)
    assert ours.schema == theirs.schema
    assert sorted(map(tuple, ours.collect())) == sorted(map(tuple, theirs.collect())) and ours.count() == 4
    assert ours.rdd.getNumPartitions() == files.LOCAL_TASKS * spark.sparkContext.defaultParallelism
    pattern = files.list_files(spark, f"{tmp_path}/s*", contents=False)
    assert pattern.columns == ours.columns and pattern.count() == 3


def test_only_what_is_asked_for_is_read(spark, tmp_path, monkeypatch):
    """Contents are read after the join, in parts of bounded size."""
    monkeypatch.setattr(files, "HELD_BYTES", 300)
    (tmp_path / "images").mkdir()
    for k in range(10):
        (tmp_path / "images" / f"{k}.json").write_text(json.dumps([k] * 64))
    with open(tmp_path / "images" / "not-asked", "wb") as large:
        large.truncate(3 << 30)  # more than a value may hold
    asked = spark.createDataFrame([(f"file:{tmp_path}/images/{k}.json", f"cam_{k}", "here", k) for k in (1, 1, 2, 3, 11)], "path string, cam_id string, location string, n int")
    sent, rejected = files.backfill_frames(asked, str(tmp_path / "images"), lambda content: F.length(content) > 0)
    assert sorted(json.loads(r.value)[0] for r in sent.collect()) == [1, 1, 2, 3]
    assert [(r.n, r.reason) for r in rejected.collect()] == [(11, "missing")]


def test_components_keep_one_round_on_disk(spark):
    shared = Folder(spark, fresh_dir(spark, "x").rpartition("/")[0])
    before = set(shared.names())
    chain = spark.range(40).selectExpr("id as a", "id + 1 as b")
    assert {(r.node, r.component) for r in components(chain, "a", "b").collect()} == {(k, 0) for k in range(41)}
    assert len([n for n in set(shared.names()) - before if n.startswith("edges-")]) == 1
