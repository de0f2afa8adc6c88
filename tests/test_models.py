"""Spark operators against the Python models on random intervals, with
bucket widths small enough that groups span many buckets."""

import random

import pytest

from framecut.operators.merge import merge_same_label
from framecut.operators.segment import segment
from framecut.operators.sessions import assign_sessions, session_summary, session_window_summary
from tests.models import merge_model, segment_model, session_model

SCHEMA = "video_id string, class3_name string, ad_seat_b_time long, ad_seat_e_time long, detection_id long"


def random_rows(seed, n=400, videos=4, labels=3, span=200_000):
    rnd = random.Random(seed)
    rows = []
    for i in range(n):
        b = rnd.choice([rnd.randrange(0, span), rnd.randrange(0, 6000), (rnd.randrange(0, span) // 5000) * 5000])
        e = b + rnd.choice([0, rnd.randrange(0, 3000), rnd.randrange(0, 40000), 10000])
        rows.append((f"v{rnd.randrange(videos)}", f"L{rnd.randrange(labels)}", b, e, i))
    # exact copies and equal begins
    rows += [(v, l, b, e, 10_000 + k) for k, (v, l, b, e, _) in enumerate(rows[:40])]
    return rows


@pytest.mark.parametrize("seed", [1, 2])
@pytest.mark.parametrize("reach", ["last", "max"])
@pytest.mark.parametrize("gap,pad", [(0, 4000), (10000, 0)])
@pytest.mark.parametrize("bucket", [7_000, 60_000])
def test_merge_matches_model(spark, seed, reach, gap, pad, bucket):
    rows = random_rows(seed)
    df = spark.createDataFrame(rows, SCHEMA)
    got = {(r.video_id, r.class3_name, r.ad_seat_b_time, r.ad_seat_e_time, r.detection_id, r.n_detections)
           for r in merge_same_label(df, gap, pad, reach, bucket_ms=bucket).collect()}
    assert got == merge_model(rows, gap, pad, reach)


@pytest.mark.parametrize("seed", [3, 4])
@pytest.mark.parametrize("reach", ["last", "max"])
@pytest.mark.parametrize("bucket", [5_000, 60_000])
def test_sessions_match_model(spark, seed, reach, bucket):
    rows = random_rows(seed)
    df = spark.createDataFrame(rows, SCHEMA)
    got = {tuple(r) for r in session_summary(df, 10000, reach, bucket_ms=bucket)
           .select("video_id", "cluster_b", "cluster_e", "n_members", "labels").collect()}
    assert got == session_model(rows, 10000, reach)


@pytest.mark.parametrize("seed", [5, 6])
def test_session_window_equals_max(spark, seed):
    rows = random_rows(seed)
    df = spark.createDataFrame(rows, SCHEMA)
    got = {tuple(r) for r in session_window_summary(df, 10000)
           .select("video_id", "cluster_b", "cluster_e", "n_members", "labels").collect()}
    assert got == session_model(rows, 10000, "max")


@pytest.mark.parametrize("seed", [7, 8])
@pytest.mark.parametrize("bucket", [3_000, 60_000])
def test_segments_match_model(spark, seed, bucket):
    rows = random_rows(seed, n=150)
    df = spark.createDataFrame(rows, SCHEMA)
    got = {(r.video_id, r.frag_b, r.frag_e, r.detection_id) for r in segment(df, bucket_ms=bucket).collect()}
    assert got == segment_model(rows)


def test_merge_max_idempotent(spark):
    rows = random_rows(9)
    df = spark.createDataFrame(rows, SCHEMA)
    once = merge_same_label(df, 10000, 0, "max")
    twice = merge_same_label(once.select("video_id", "class3_name", "ad_seat_b_time", "ad_seat_e_time",
                                         "detection_id"), 10000, 0, "max")
    a = {(r.video_id, r.class3_name, r.ad_seat_b_time, r.ad_seat_e_time) for r in once.collect()}
    b = {(r.video_id, r.class3_name, r.ad_seat_b_time, r.ad_seat_e_time) for r in twice.collect()}
    assert a == b


def test_clusters_partition_input(spark):
    rows = random_rows(10)
    df = spark.createDataFrame(rows, SCHEMA)
    s = assign_sessions(df, 10000, "last", 5000)
    assert s.count() == len(rows)
    assert s.select("detection_id").distinct().count() == len(rows)
