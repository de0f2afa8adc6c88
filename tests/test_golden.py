"""Hand-computed mini-cases (FIXTURES.md section 4)."""

import pytest
from pyspark.sql import functions as F

from framecut.operators.merge import merge_same_label, pad
from framecut.operators.scenes import contained_in_scenes, top_labels, screen_time
from framecut.operators.segment import segment
from framecut.operators.sessions import session_summary, session_window_summary
from framecut.params import Params
from framecut.plans import jobs
from framecut.sources.tables import Inputs

SCHEMA = ("video_id string, class3_name string, ad_seat_b_time long, ad_seat_e_time long, "
          "ad_seat_img string, detection_id long, class2_name string, class_type_id string, source string")


def det(spark, rows):
    full = [(r[0], r[1], r[2], r[3], r[4] if len(r) > 4 else f"img{i}", i, "l2", "1", "face")
            for i, r in enumerate(rows)]
    return spark.createDataFrame(full, SCHEMA)


def spans(df, b="ad_seat_b_time", e="ad_seat_e_time"):
    return sorted((r[b], r[e]) for r in df.collect())


@pytest.mark.parametrize("bucket", [60_000, 1_000, None])
def test_g1_g2_pad_merge_touching(spark, bucket):
    d = det(spark, [("v", "L", 10000, 60000), ("v", "L", 12000, 13000), ("v", "L", 30000, 31000)])
    m = merge_same_label(d, 0, 4000, "last", bucket_ms=bucket)
    assert spans(m) == [(6000, 17000), (26000, 35000)]
    assert spans(merge_same_label(d, 0, 4000, "max", bucket_ms=bucket)) == [(6000, 64000)]
    assert spans(pad(m, 3000)) == [(3000, 20000), (23000, 38000)]
    assert spans(pad(merge_same_label(d, 0, 4000, "max", bucket_ms=bucket), 3000)) == [(3000, 67000)]


def test_g3_pad_floor(spark):
    d = det(spark, [("v", "L", 1000, 2000)])
    m = merge_same_label(d, 0, 4000)
    assert spans(m) == [(0, 6000)]
    assert spans(pad(m, 3000)) == [(0, 9000)]


@pytest.mark.parametrize("bucket", [60_000, 500])
def test_g4_g5_merge_near_inclusive(spark, bucket):
    assert spans(merge_same_label(det(spark, [("v", "L", 0, 1000), ("v", "L", 11000, 12000)]), 10000,
                                  bucket_ms=bucket)) == [(0, 12000)]
    assert spans(merge_same_label(det(spark, [("v", "L", 0, 1000), ("v", "L", 11001, 12000)]), 10000,
                                  bucket_ms=bucket)) == [(0, 1000), (11001, 12000)]


def test_g6_touching_after_padding(spark):
    d = det(spark, [("v", "L", 10000, 11000), ("v", "L", 19000, 20000)])
    assert spans(merge_same_label(d, 0, 4000)) == [(6000, 24000)]


def _sessions(spark, rows, reach, bucket=60_000):
    d = det(spark, rows)
    s = session_summary(d, 10000, reach, bucket_ms=bucket)
    return sorted((r.cluster_b, r.cluster_e, r.labels) for r in s.collect())


@pytest.mark.parametrize("bucket", [60_000, 3_000])
def test_g7_sessions(spark, bucket):
    rows = [("v", "A", 0, 1000), ("v", "B", 5000, 60000), ("v", "C", 30000, 31000)]
    assert _sessions(spark, rows, "last", bucket) == [(0, 60000, "A|B"), (30000, 31000, "C")]
    assert _sessions(spark, rows, "max", bucket) == [(0, 60000, "A|B|C")]
    sw = session_window_summary(det(spark, rows), 10000)
    assert [(r.cluster_b, r.cluster_e, r.labels) for r in sw.collect()] == [(0, 60000, "A|B|C")]


def test_g8_first_end_counts(spark):
    rows = [("v", "A", 0, 50000), ("v", "B", 20000, 21000), ("v", "C", 55000, 56000)]
    assert _sessions(spark, rows, "last") == [(0, 56000, "A|B|C")]


def test_session_gap_inclusive(spark):
    rows = [("v", "A", 0, 1000), ("v", "B", 11000, 12000)]
    assert _sessions(spark, rows, "last") == [(0, 12000, "A|B")]
    assert _sessions(spark, rows, "max") == [(0, 12000, "A|B")]
    sw = session_window_summary(det(spark, rows), 10000)
    assert [(r.cluster_b, r.cluster_e) for r in sw.collect()] == [(0, 12000)]


def _inputs(spark, rows, types=None, videos=None, scenes=None):
    d = spark.createDataFrame(
        [(r[0], r[1], r[2], r[3], r[4] if len(r) > 4 else f"img{i}", i, "face") for i, r in enumerate(rows)],
        "media_id string, class_id long, time_start long, time_end long, object_img string, "
        "detection_id long, source string")
    labels = spark.createDataFrame(types or [(1, "1", "thing", "L"), (2, "4", "person", "M"),
                                             (3, "9", "odd", "U"), (4, "2", "place", "a,b")],
                                   "class_id long, class_type string, class1_name string, class2_name string")
    v = spark.createDataFrame(videos or [("v", "name", "cat", "style", None, "2024", "http://v/v.mp4"),
                                         ("w", "name2", "cat", "style", "area", "2024", "http://v/w.ts")],
                              "videoId string, videoName string, category string, classify string, "
                              "area string, releaseTime string, originalUrl string")
    sc = spark.createDataFrame(scenes or [("v", 0, 100)], "media_id string, story_start long, story_end long")
    return Inputs(detections=d, labels=labels, videos=v, scenes=sc)


def test_g9_min_length_multi(spark):
    short = jobs.clips_multi(_inputs(spark, [("v", 1, 100, 900)]))
    assert short.count() == 0
    kept = jobs.clips_multi(_inputs(spark, [("v", 1, 100, 1100)]))
    assert [r.string_time for r in kept.collect()] == ["100_1100"]


def test_g10_min_length_single(spark):
    docs = jobs.clips_single(_inputs(spark, [("v", 1, 100, 900)]))
    assert [(r.string_time, r.string_time_long) for r in docs.collect()] == [("0_7900", "7900")]


def test_g11_strict_containment(spark):
    inp = _inputs(spark, [("v", 1, 0, 50), ("v", 1, 1, 100), ("v", 1, 1, 99)])
    from framecut.operators.normalize import normalize
    pairs = contained_in_scenes(normalize(inp.detections, inp.labels), inp.scenes)
    assert [(r.ad_seat_b_time, r.ad_seat_e_time) for r in pairs.collect()] == [(1, 99)]


def test_g12_ranking_scope(spark):
    rows = []
    for v in ("v", "w"):
        for k in range(8):
            rows.append((v, f"L{k}", "1", 10 * (k + 1) + (1 if v == "w" else 0)))
    st = spark.createDataFrame(
        [(v, 0, 100, t, l, "l2", tot, 1, "img", 1, 2, 0.1) for v, l, t, tot in rows],
        "video_id string, story_start long, story_end long, class_type_id string, class3_name string, "
        "class2_name string, totaltime long, n_detections long, ad_seat_img string, ad_seat_b_time long, "
        "ad_seat_e_time long, appear_rate double")
    assert top_labels(st, 10, "scene").count() == 10
    assert top_labels(st, 10, "video_scene").count() == 16


def test_g13_segmentation_per_video(spark):
    d = det(spark, [("v", "A", 0, 10), ("v", "B", 5, 15)])
    seg = segment(d, bucket_ms=7)
    got = sorted((r.frag_b, r.frag_e, r.class3_name) for r in seg.collect())
    assert got == [(0, 5, "A"), (5, 10, "A"), (5, 10, "B"), (10, 15, "B")]


def test_g14_attributes_of_merge(spark):
    d = det(spark, [("v", "L", 0, 1000, "img1"), ("v", "L", 2000, 3000, "img2")])
    m = merge_same_label(d, 10000).collect()
    assert [(r.ad_seat_b_time, r.ad_seat_e_time, r.ad_seat_img, r.n_detections) for r in m] == [(0, 3000, "img1", 2)]


def test_g15_duplicate_labels_in_cluster(spark):
    rows = [("v", "L", 0, 1000), ("v", "M", 9000, 10000), ("v", "L", 15000, 16000)]
    assert _sessions(spark, rows, "last") == [(0, 16000, "L|M|L")]


def test_g16_g17_null_list_element_and_scalar(spark):
    inp = _inputs(spark, [("v", 1, 100, 5000, None)])
    single = jobs.clips_single(inp).collect()[0]
    assert single.string_class_img_list == [None]
    assert single.string_media_area_name is None
    multi = jobs.clips_multi(inp).collect()[0]
    assert multi.string_class_img_list == [None]
    from framecut.operators.documents import to_json_lines
    js = to_json_lines(jobs.clips_single(inp)).collect()[0].json
    assert '"string_class_img_list":[null]' in js and "string_media_area_name" not in js


def test_g18_unknown_type(spark):
    inp = _inputs(spark, [("v", 3, 100, 5000)])
    d = jobs.clips_multi(inp, version=3).collect()[0]
    assert d.string_class3_list == ["U"]
    assert d.string_man_list == [] and d.string_object_list == []


def test_g19_label_with_comma(spark):
    inp = _inputs(spark, [("v", 4, 10, 20)])
    d = jobs.clips_scene(inp).collect()[0]
    assert d.string_class3_list == ["a,b"] and d.string_sence_list == ["a,b"]


def test_g20_pending_without_clips_marked_done(spark):
    from framecut.streaming.pending import mark_processed
    tasks = spark.createDataFrame([("v", 0), ("x", 0), ("w", 1)], "video_id string, status int")
    ids = tasks.where("status = 0").select("video_id")
    got = sorted(tuple(r) for r in mark_processed(tasks, ids).collect())
    assert got == [("v", 1), ("w", 1), ("x", 1)]


def test_rejected_rows_side_output(spark):
    from framecut.operators.normalize import label_detections, split_valid
    inp = _inputs(spark, [("v", 1, 100, 50), ("v", 1, 0, 10), (None, 1, 0, 10)])
    ok, bad = split_valid(label_detections(inp.detections, inp.labels))
    assert ok.count() == 1 and bad.count() == 2


def test_for_videos_filters_every_kind(spark):
    inp = _inputs(spark, [("v", 1, 10, 20), ("w", 1, 10, 20)], scenes=[("v", 0, 100), ("w", 0, 100)])
    ids = spark.createDataFrame([("w",)], "video_id string")
    docs = jobs.clips_all(inp, video_ids=ids)
    assert {r.string_vid for r in docs.collect()} == {"w"}
