"""Ingest: ids of any kind, order of the tables, pushed-down video filter, sink safety."""

from __future__ import annotations

import pytest
from pyspark.sql import functions as F

from framecut.operators.normalize import for_videos, label_detections, normalize, rejected_counts, split_valid
from framecut.plans import jobs
from framecut.sources import fixtures, sinks
from framecut.sources.tables import Inputs, detection_scan
from tests.conftest import SF001

DET = "media_id string, class_id long, time_start long, time_end long, object_img string, detection_id string"


def _inputs(spark, tables):
    labels = spark.createDataFrame([(1, "1", "a", "x"), (2, "2", "b", None)],
                                   "class_id long, class_type string, class1_name string, class2_name string")
    videos = spark.createDataFrame([("v", "n", "c", "k", "r", "2024", "u.mp4")],
                                   "videoId string, videoName string, category string, classify string, area string, "
                                   "releaseTime string, originalUrl string")
    return Inputs({k: spark.createDataFrame(v, DET) for k, v in tables.items()}, labels, videos)


def test_text_and_missing_ids_keep_every_clip(spark):
    rows = [("v", 1, 0, 10_000, "i", "abc"), ("v", 1, 5_000, 20_000, "j", None)]
    inp = _inputs(spark, {"face": rows})
    assert jobs.clips_single(inp).count() == 1
    assert jobs.clips_multi(inp).count() == 1
    assert detection_scan(spark.createDataFrame(rows, DET).drop("detection_id"), "s").where("detection_id is null").count() == 0


def test_result_does_not_depend_on_table_order(spark):
    a, b = [("v", 1, 10_000, 30_000, "i", "7")], [("v", 1, 10_000, 12_000, "j", "7")]
    one = jobs.clips_single(_inputs(spark, {"face": a, "object": b})).collect()
    two = jobs.clips_single(_inputs(spark, {"object": b, "face": a})).collect()
    assert one == two


def test_null_labels_and_negative_begins(spark):
    rows = [("v", 2, 0, 10_000, "i", "1"), ("v", 1, -500, 5_000, "j", "2"), ("v", 1, 50, 20, "k", "3"),
            (None, 1, 0, 1, "l", "4"), ("v", 1, None, 1, "m", "5")]
    inp = _inputs(spark, {"face": rows})
    det = normalize(inp.detections, inp.labels)
    assert det.count() == 2
    assert jobs.multi_clusters(det).collect()[0]["members"].__len__() == 2
    assert jobs.single_clips(det).collect()[0]["ad_seat_b_time"] == 0
    counts = {r["reason"]: r["n_rows"] for r in rejected_counts(inp.detections, inp.labels).collect()}
    assert counts == {"null_label": 1, "ends_before_begin": 1, "null_video": 1, "null_offset": 1}
    _, bad = split_valid(label_detections(detection_scan(inp.detections["face"], "face"), inp.labels))
    assert {r["reason"] for r in bad.collect()} == {"ends_before_begin", "null_video", "null_offset"}


def test_video_filter_reaches_the_scan(spark):
    inp = fixtures.inputs(spark, SF001)
    det = normalize(inp.detections, inp.labels)
    ids = inp.videos.limit(3).selectExpr("videoId AS video_id")
    plan = for_videos(det, ids)._jdf.queryExecution().executedPlan().toString()
    assert "SortMergeJoin" not in plan and "LeftSemi, BuildRight" in plan
    listed = for_videos(det, ["1", "2"])
    assert "SortMergeJoin" not in listed._jdf.queryExecution().executedPlan().toString()
    want = for_videos(det, spark.createDataFrame([("1",), ("2",)], "video_id string"))
    assert sorted(map(repr, listed.collect())) == sorted(map(repr, want.collect()))


def test_sink_raises_on_a_bad_target_and_writes_an_id_once(spark, scratch):
    docs = spark.createDataFrame([("a", "single"), ("a", "single"), ("b", "multi")], "clip_id string, kind string")
    target = scratch + "/docs"
    sinks.append_new(docs, target)
    sinks.append_new(docs, target)
    assert spark.read.parquet(target).count() == 2
    with pytest.raises(Exception):
        sinks.append_new(docs, target, fmt="no_such_format")
    spark.range(2).write.parquet(scratch + "/other")
    with pytest.raises(Exception):
        sinks.append_new(docs, scratch + "/other")


def test_rejects_are_counted_in_the_pass_that_reads(spark):
    """One scan gives the documents and a number for every reason."""
    from pyspark.sql import Observation
    from framecut.plans.catalog import _dirty_inputs
    inp = _dirty_inputs(spark, SF001)
    inp.detections = inp.detections.withColumn("class_id", F.when(F.col("detection_id") % 9 == 0, 99).otherwise(F.col("class_id")))
    seen = Observation("rejects")
    docs = jobs.clips_detections(inp, rejects=seen)
    got = docs.select("clip_id").collect()
    want = {r["reason"]: r["n_rows"] for r in rejected_counts(inp.detections, inp.labels).collect()}
    assert {k: n for k, n in seen.get.items() if n} == want and want["unknown_class"] > 0
    assert sorted(got) == sorted(jobs.clips_detections(inp).select("clip_id").collect())
