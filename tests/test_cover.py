"""Scenes as few aligned blocks, and segmentation without a join: plans and edge cases."""

import random

import pytest

from framecut.operators.ordered import block_cover
from framecut.operators.scenes import contained_in_scenes
from framecut.operators.segment import segment
from framecut.plans.catalog import QUERIES
from pyspark.sql import functions as F
from tests.conftest import SF01
from tests.models import segment_model

DETECTION = "video_id string, detection_id long, source int, ad_seat_b_time long, ad_seat_e_time long"
SCENE = "media_id string, story_start long, story_end long"
YEAR = 365 * 24 * 3600 * 1000


def test_cover_holds_every_bucket_once(spark):
    draw = random.Random(1)
    spans = [(a, a + draw.choice([0, 1, 5, 40, 700])) for a in (draw.randint(-500, 500) for _ in range(60))]
    rows = spark.createDataFrame(spans, "b long, e long").select("b", "e", block_cover("b", "e", 1).alias("c"))
    for b, e, cover in rows.collect():
        held = [k for level, block in cover for k in range(block << 2 * level, (block + 1) << 2 * level)]
        assert sorted(held) == list(range(b, e + 1))


def test_a_scene_of_a_year_is_few_rows(spark):
    spans = [(7, YEAR + 12_345), (-YEAR, YEAR), (0, 2 ** 63 - 1), (-(2 ** 62), 2 ** 62)]
    sizes = [r.n for r in spark.createDataFrame(spans, "b long, e long")
             .select(F.size(block_cover("b", "e", 60_000)).alias("n")).collect()]
    assert max(sizes[:2]) < 100 and max(sizes) <= 6 * 24


@pytest.mark.parametrize("bucket", [10, 60_000])
def test_containment_equals_all_pairs(spark, bucket):
    draw = random.Random(2)
    det = [(draw.choice("ab"), i, 1, b, b + draw.randint(0, 300)) for i in range(300) for b in [draw.randint(-50, 5000)]]
    scenes = [(draw.choice("ab"), s, s + draw.choice([-5, 0, 1, 60, 900, 4000])) for s in
              (draw.randint(-60, 5000) for _ in range(80))] + [("a", 0, 2 ** 62), ("b", None, 5), ("b", 5, None), (None, 0, 9)]
    got = contained_in_scenes(spark.createDataFrame(det, DETECTION), spark.createDataFrame(scenes, SCENE), bucket)
    want = sorted((v, i, s, t) for v, i, _, b, e in det for w, s, t in scenes
                  if v == w and None not in (s, t) and s < t and s < b and e < t)
    assert sorted(tuple(r) for r in got.select("video_id", "detection_id", "story_start", "story_end").collect()) == want


def test_containment_without_scenes_or_detections(spark):
    det, scenes = spark.createDataFrame([("a", 1, 1, 5, 6)], DETECTION), spark.createDataFrame([("a", 0, 9)], SCENE)
    assert contained_in_scenes(det, scenes.limit(0)).count() == 0
    assert contained_in_scenes(det.limit(0), scenes).count() == 0
    assert contained_in_scenes(det, scenes).count() == 1


def test_copies_and_long_intervals_are_segmented(spark):
    rows = [("v", "L", 0, 500, 1), ("v", "L", 0, 500, 2), ("v", "L", 0, 500, 3), ("v", "L", 33, 33, 4),
            ("v", "M", -20, 499, 5), ("v", "M", 120, 121, 6), ("w", "M", 120, 121, 7)]
    det = spark.createDataFrame(rows, "video_id string, class3_name string, ad_seat_b_time long, ad_seat_e_time long, "
                                "detection_id long")
    got = [(r.video_id, r.frag_b, r.frag_e, r.detection_id) for r in segment(det, bucket_ms=10).collect()]
    assert len(got) == len(set(got)) and set(got) == segment_model(rows)
    twice = segment(det.unionByName(det), bucket_ms=10)
    assert sorted((r.video_id, r.frag_b, r.frag_e, r.detection_id) for r in twice.collect()) == sorted(got * 2)


def test_segmentation_reads_its_intervals_once(spark):
    txt = QUERIES["segment_labels"](spark, SF01)._jdf.queryExecution().executedPlan().toString()
    assert txt.count("events.parquet") == 1 and "SortMergeJoin" not in txt
