"""Sessions of long videos, and lists of many members."""

import random

from pyspark.sql import functions as F

from framecut.functions.lists import label_to_image
from framecut.operators.sessions import assign_sessions, sessions

ROWS = "video_id string, class3_name string, ad_seat_b_time long, ad_seat_e_time long, detection_id long"


def _fold(rows, gap):
    """Cluster start of every row, by the reference's fold."""
    out, reach, start = {}, None, None
    for b, e, i in sorted((r[2], r[3], r[4]) for r in rows):
        if reach is None or b - reach > gap:
            start, reach = b, e
        else:
            reach = max(b, reach)
        out[i] = start
    return out


def test_one_video_of_100000_run_heads(spark):
    """Most heads open a cluster of their own; every thousandth interval is long and holds some dozens."""
    n, gap = 100_000, 10_000
    rows = spark.range(n).select(
        F.lit("v").alias("video_id"), F.lit("x").alias("class3_name"), (F.col("id") * 11_001).alias("ad_seat_b_time"),
        (F.col("id") * 11_001 + F.when(F.col("id") % 1000 == 0, 400_000).otherwise(500)).alias("ad_seat_e_time"),
        F.col("id").alias("detection_id"))
    want = _fold([(0, 0, i * 11_001, i * 11_001 + (400_000 if i % 1000 == 0 else 500), i) for i in range(n)], gap)
    got = assign_sessions(rows, gap).select("detection_id", "cluster_start").collect()
    assert {r[0]: r[1] for r in got} == want


def test_chains_of_overlapping_heads(spark):
    """Ends that reach over later heads without a break: clusters are slices of one chain."""
    rng = random.Random(6)
    rows, at = [], -5_000
    for i in range(1500):
        at += rng.choice((3_000, 9_999, 10_000, 10_001, 14_000, 25_000))
        rows.append((rng.choice("vw"), "x", at, at + rng.choice((0, 1_000, 30_000, 90_000)), i))
    table = spark.createDataFrame(rows, ROWS)
    for bucket in (4_000, 60_000):
        got = {r["detection_id"]: r["cluster_start"] for r in assign_sessions(table, 10_000, bucket_ms=bucket).collect()}
        assert got == _fold([r for r in rows if r[0] == "v"], 10_000) | _fold([r for r in rows if r[0] == "w"], 10_000)


def test_sessions_shuffle_by_bucket_and_by_video_only(spark):
    table = spark.createDataFrame([("v", "x", 0, 1, 1)], ROWS)
    txt = sessions(table, 10_000)._jdf.queryExecution().executedPlan().toString()
    assert txt.count("Exchange hashpartitioning") == 2 and "Join" not in txt


def test_label_to_image_keeps_the_last_of_each_label(spark):
    rng = random.Random(8)
    members = [(k, k, "1", rng.choice(("a", "b", "c", None)), "l2", f"i{k}" if k % 7 else None) for k in range(300)]
    df = spark.createDataFrame([(members,), ([],), ([(0, 0, "1", None, "l2", "x")],)],
                               "m array<struct<b:long,i:long,t:string,n:string,n2:string,img:string>>")
    got = [r[0] for r in df.select(label_to_image(F.col("m"))).collect()]
    assert got == [{n: i for *_, n, _, i in members if n is not None}, {}, {}]
