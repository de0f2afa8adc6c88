"""Incremental = batch: pending rounds and streaming sessions."""

import os
import time

from pyspark.sql import functions as F

from framecut.operators.merge import merge_same_label
from framecut.operators.normalize import normalize
from framecut.operators.sessions import session_summary, session_window_summary
from framecut.plans import jobs
from framecut.sources import fixtures
from framecut.sources.sinks import current_documents
from framecut.sources.tables import Inputs
from framecut.streaming.pending import new_task_version, pending_stream, run_round
from framecut.streaming.sessions import stream_detections, stream_sessions
from tests.conftest import SF001

DET = "media_id string, class_id long, time_start long, time_end long, object_img string, detection_id string"
TASK = "video_id string, status int"


def _ignore(ids):
    pass


def _open(spark, root):
    """Inputs that are read from ``root`` at every call."""
    def opened() -> Inputs:
        labels = spark.createDataFrame([(1, "1", "a", "x"), (2, "2", "b", "y")],
                                       "class_id long, class_type string, class1_name string, class2_name string")
        videos = spark.createDataFrame(
            [(v, "n", "c", "k", "r", "2024", "u.mp4") for v in "vw"],
            "videoId string, videoName string, category string, classify string, area string, releaseTime string, "
            "originalUrl string")
        return Inputs({"face": spark.read.schema(DET).parquet(f"{root}/face")}, labels, videos,
                      tasks=spark.read.schema(TASK).parquet(f"{root}/tasks"))
    return opened


def _add(spark, root, detections=(), tasks=(), mode="append"):
    if detections:
        spark.createDataFrame(list(detections), DET).coalesce(1).write.mode(mode).parquet(f"{root}/face")
    if tasks:
        spark.createDataFrame(list(tasks), TASK).coalesce(1).write.mode("append").parquet(f"{root}/tasks")


def _same_as_batch(spark, docs, opened, job=jobs.clips_union):
    batch = job(opened())
    got = current_documents(spark, docs).select(*batch.columns)
    assert sorted(map(repr, got.collect())) == sorted(map(repr, batch.collect()))
    return got


def test_round_then_rerun_replaces(spark, scratch):
    inp = fixtures.inputs(spark, SF001)
    docs, tasks_out = os.path.join(scratch, "docs"), os.path.join(scratch, "tasks1")
    n1 = run_round(lambda: inp, docs, new_task_version(lambda: inp.tasks, tasks_out), scratch)
    pending_ids = inp.tasks.where("status = 0").select("video_id")
    assert n1 == jobs.clips_all(inp, video_ids=pending_ids).count() > 0
    after = spark.read.parquet(tasks_out)
    assert after.where("status = 0").count() == 0
    assert after.count() == inp.tasks.count()
    assert run_round(lambda: inp, docs, _ignore, scratch) == n1
    assert current_documents(spark, docs).count() == n1


def test_rounds_equal_batch(spark, scratch):
    """Processing the videos in two rounds gives the same clips as one batch."""
    inp = fixtures.inputs(spark, SF001)
    all_ids = inp.tasks.select("video_id")
    t1 = all_ids.select("video_id", (F.abs(F.hash("video_id")) % 2).cast("int").alias("status"))
    t2 = all_ids.select("video_id", (1 - F.abs(F.hash("video_id")) % 2).cast("int").alias("status"))
    docs = os.path.join(scratch, "docs")
    for t in (t1, t2):
        run_round(lambda: Inputs(inp.detections, inp.labels, inp.videos, inp.scenes, t), docs, _ignore, scratch)
    batch = jobs.clips_all(inp).select("clip_id")
    got = current_documents(spark, docs).select("clip_id")
    assert got.count() == batch.count()
    assert got.exceptAll(batch).count() == 0


def test_changed_detections_and_images_replace_the_documents(spark, scratch):
    opened, docs = _open(spark, scratch), scratch + "/docs"
    first = [("v", 1, 5_000, 9_000, "i", "1"), ("w", 2, 0, 8_000, "k", "2")]
    _add(spark, scratch, first, [("v", 0), ("w", 0)])
    run_round(opened, docs, _ignore, scratch, jobs.clips_union)
    _same_as_batch(spark, docs, opened)
    _add(spark, scratch, [("v", 1, 8_000, 12_000, "j", "3")])
    run_round(opened, docs, _ignore, scratch, jobs.clips_union)
    _same_as_batch(spark, docs, opened)
    _add(spark, scratch, [("v", 1, 5_000, 9_000, "new", "1")], mode="overwrite")  # w has no clip any more
    run_round(opened, docs, _ignore, scratch, jobs.clips_union)
    left = _same_as_batch(spark, docs, opened)
    assert {r["string_vid"] for r in left.collect()} == {"v"}


def test_a_task_that_arrives_during_a_round_stays_pending(spark, scratch):
    opened = _open(spark, scratch)
    _add(spark, scratch, [("v", 1, 5_000, 9_000, "i", "1"), ("w", 2, 0, 8_000, "k", "2")], [("v", 0)])

    def job(inp, p, video_ids):
        _add(spark, scratch, tasks=[("w", 0)])
        return jobs.multi_v1(inp, p, video_ids)

    out = scratch + "/tasks_out"
    mark = new_task_version(lambda: spark.read.schema(TASK).parquet(scratch + "/tasks"), out)
    assert run_round(opened, scratch + "/docs", mark, scratch, job) == 1
    assert sorted(tuple(r) for r in spark.read.parquet(out).collect()) == [("v", 1), ("w", 0)]


def test_stream_reads_what_lands_after_its_start(spark, scratch):
    opened, docs, marked, counts = _open(spark, scratch), scratch + "/docs", [], []
    _add(spark, scratch, [("v", 1, 5_000, 9_000, "i", "1")], [("v", 0)])
    q = pending_stream(spark, opened, scratch + "/tasks", docs, scratch + "/ckpt",
                       lambda ids: marked.extend(r["video_id"] for r in ids.collect()), scratch, jobs.clips_union,
                       trigger={"processingTime": "1 second"}, on_round=lambda epoch, n: counts.append(n))
    try:
        until = time.time() + 300
        while not counts and q.isActive and time.time() < until:
            time.sleep(0.5)
        assert marked == ["v"]
        _add(spark, scratch, [("w", 2, 0, 8_000, "k", "2")], [("w", 0)])
        while len(counts) < 2 and q.isActive and time.time() < until:
            time.sleep(0.5)
    finally:
        q.stop()
    assert marked == ["v", "w"]
    assert counts == [2, 2]
    _same_as_batch(spark, docs, opened)


def test_stream_sessions_subset_of_batch(spark, scratch):
    inp = fixtures.inputs(spark, SF001)
    det = normalize(inp.detections, inp.labels)
    src = os.path.join(scratch, "det")
    det.write.parquet(src)
    stream = spark.readStream.schema(det.schema).parquet(src)
    q = (stream_sessions(stream, 10000, "1 minute").writeStream.format("memory")
         .queryName("fc_sessions").outputMode("append").trigger(availableNow=True).start())
    q.awaitTermination(300)
    got = {tuple(r) for r in spark.sql("SELECT video_id, cluster_b, cluster_e, n_members FROM fc_sessions").collect()}
    batch = {tuple(r) for r in session_summary(det, 10000, "max")
             .select("video_id", "cluster_b", "cluster_e", "n_members").collect()}
    assert got and got <= batch


def test_a_job_sees_files_added_since_the_last_one(spark, scratch):
    """Nothing is kept between jobs of a session: the same path, opened
    again, gives every kind of clip of a video that arrived meanwhile."""
    opened = _open(spark, scratch)
    _add(spark, scratch, [("v", 1, 5_000, 9_000, "i", "1")], [("v", 0)])
    seen = lambda: {(r.kind, r.string_vid) for r in jobs.clips_union(opened()).collect()}
    assert {v for _, v in seen()} == {"v"}
    _add(spark, scratch, [("w", 2, 0, 8_000, "k", "2")])
    assert seen() == {(k, v) for k in ("single", "multi") for v in "vw"}


def test_a_file_delivered_twice_adds_nothing_to_the_stream(spark, scratch):
    """Streamed ingest joins the labels, drops what comes again and rejects what batch rejects: its sessions are those
    of the batch over the file."""
    schema = DET.replace("detection_id string", "detection_id long")
    rows = [("v", 1, b, b + 4_000, f"i{b}", k) for k, b in enumerate(range(0, 90_000, 9_000))]
    rows += [("w", 2, -500, 3_000, "n", 49), ("w", 2, 30_000, 31_000, "j", 50), ("w", 7, 32_000, 33_000, "j", 51), ("w", 1, 40_000, 20_000, "j", 52)]
    end = [("z", 1, 900_000, 900_001, "e", 99)]  # moves the watermark past everything else
    labels = spark.createDataFrame(
        [(1, "1", "a", "x"), (2, "2", "b", "y")], "class_id long, class_type string, class1_name string, class2_name string")
    for part in (rows, rows, end):
        spark.createDataFrame(part, schema).coalesce(1).write.mode("append").parquet(f"{scratch}/in")
    stream = spark.readStream.schema(schema).option("maxFilesPerTrigger", 1).parquet(f"{scratch}/in")
    q = (stream_sessions(stream_detections({"face": stream}, labels), 10_000).writeStream.format("memory")
         .queryName("fc_twice").outputMode("append").trigger(availableNow=True).start())
    q.awaitTermination(300)
    got = sorted(map(tuple, spark.sql("SELECT video_id, cluster_b, cluster_e, n_members, labels FROM fc_twice").collect()))
    det = normalize({"face": spark.createDataFrame(rows, schema)}, labels)
    want = sorted(map(tuple, session_window_summary(det, 10_000).select(
        "video_id", "cluster_b", "cluster_e", "n_members", "labels").collect()))
    assert got == want and len(want) == 3
