"""Merged intervals kept as islands of media-time slots: rounds equal one merge."""

import random

import pytest

from pyspark.sql import functions as F

from framecut.operators.merge import merge_same_label
from framecut.sources.store import append_detections, read_slots, slots_of
from framecut.streaming.islands import add_detections, merged_intervals, refresh

DET = ("video_id string, class2_name string, class_type_id string, class3_name string, ad_seat_b_time long, "
       "ad_seat_e_time long, ad_seat_img string, detection_id long, source string")


def _rows(rng, n, first=0):
    out = []
    for i in range(first, first + n):
        b = rng.randrange(-3_000, 40_000)
        out.append((rng.choice("vvvw"), "l2", "1", rng.choice(("a", "b", None)), b, b + rng.randrange(0, 6_000), f"i{i}", i,
                    rng.choice(("face", "object"))))
    return out


def _as_rows(df):
    return sorted(map(repr, df.select(sorted(df.columns)).collect()))


@pytest.mark.parametrize("gap, pad_ms, reach, bucket", [(900, 0, "last", 5_000), (0, 4_000, "last", 3_000), (900, 0, "max", 4_000)])
def test_rounds_equal_one_merge(spark, scratch, gap, pad_ms, reach, bucket):
    rng = random.Random(gap + pad_ms)
    rows = _rows(rng, 90)
    rounds = [rows[:40], rows[40:41], rows[41:]]
    for some in rounds:
        add_detections(spark.createDataFrame(some, DET), scratch, gap, pad_ms, reach, bucket)
    want = merge_same_label(spark.createDataFrame(rows, DET), gap, pad_ms, reach, bucket_ms=bucket)
    assert _as_rows(merged_intervals(spark, scratch, gap, reach)) == _as_rows(want)
    only = merged_intervals(spark, scratch, gap, reach, ["w"])
    assert _as_rows(only) == _as_rows(want.where("video_id = 'w'"))
    refresh(slots_of(spark.createDataFrame(rows[:9], DET), bucket), scratch, gap, pad_ms, reach, bucket)
    assert _as_rows(merged_intervals(spark, scratch, gap, reach)) == _as_rows(want)


def test_a_late_detection_joins_two_stored_islands(spark, scratch):
    row = lambda i, b, e: ("v", "l2", "1", "a", b, e, f"i{i}", i, "face")
    add_detections(spark.createDataFrame([row(1, 0, 20_000), row(2, 170_000, 180_000)], DET), scratch, 10_000)
    assert merged_intervals(spark, scratch, 10_000).count() == 2
    add_detections(spark.createDataFrame([row(3, 30_000, 165_000)], DET), scratch, 10_000)
    got = merged_intervals(spark, scratch, 10_000).collect()
    assert [(r["ad_seat_b_time"], r["ad_seat_e_time"], r["n_detections"], r["ad_seat_img"]) for r in got] == [(0, 180_000, 3, "i1")]


def test_a_round_reads_the_partitions_of_its_slots(spark, scratch):
    rows = spark.createDataFrame(_rows(random.Random(1), 300), DET)
    append_detections(rows, scratch + "/det", 1_000)
    some = slots_of(rows.where("detection_id in (3, 4)"), 1_000)
    found = read_slots(spark, scratch + "/det", some)
    plan = found._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [_part" in plan and "SortMergeJoin" not in plan and found.columns == rows.columns
    assert _as_rows(found) == _as_rows(rows.join(some, (rows.video_id == some.video_id) & (
        some._slot == F.expr("greatest(floor(ad_seat_b_time / 1000), 0)")), "left_semi"))
