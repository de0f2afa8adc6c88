"""
number of shuffle partitions, the input row order or the bucket width;
clusters partition their input; fragments tile without overlap."""

from pyspark.sql import functions as F

from framecut.operators.normalize import normalize
from framecut.operators.segment import segment
from framecut.params import Params
from framecut.plans import jobs
from framecut.sources import fixtures
from tests.conftest import SF001


def _rows(df):
    return sorted(tuple(str(x) for x in r) for r in df.collect())


def _docs(spark, inp, p=Params()):
    single = jobs.clips_single(inp, p).select("string_vid", "string_time", "string_class3_list")
    multi = jobs.clips_multi(inp, p).select("string_vid", "string_time", "string_class3_list")
    return _rows(single) + _rows(multi)


def test_independent_of_partitions_order_and_bucket_width(spark):
    inp = fixtures.inputs(spark, SF001)
    base = _docs(spark, inp)
    shuffled = inp.detections.orderBy(F.rand(7)).repartition(5)
    inp2 = fixtures.Inputs(shuffled, inp.labels, inp.videos, inp.scenes, inp.tasks)
    old = spark.conf.get("spark.sql.shuffle.partitions")
    try:
        spark.conf.set("spark.sql.shuffle.partitions", "3")
        assert _docs(spark, inp2) == base
        assert _docs(spark, inp2, Params(bucket_ms=2_000)) == base
        assert _docs(spark, inp2, Params(bucket_ms=10 ** 12)) == base
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", old)


def test_clusters_partition_merged_intervals(spark):
    inp = fixtures.inputs(spark, SF001)
    det = normalize(inp.detections, inp.labels)
    clusters = jobs.multi_clusters(det, Params(min_clip_ms=0))
    members = clusters.select(F.explode("members").alias("m")).select("m.i")
    from framecut.operators.merge import merge_same_label
    merged = merge_same_label(det, Params().gap_ms)
    assert members.count() == merged.count()
    assert members.distinct().count() == merged.count()


def test_fragments_do_not_overlap(spark):
    inp = fixtures.inputs(spark, SF001)
    det = normalize(inp.detections, inp.labels)
    frags = segment(det).select("video_id", "frag_b", "frag_e").distinct()
    from pyspark.sql import Window
    w = Window.partitionBy("video_id").orderBy("frag_b")
    bad = frags.withColumn("pe", F.lag("frag_e").over(w)).where(F.col("pe") > F.col("frag_b"))
    assert bad.count() == 0
    assert frags.where(F.col("frag_e") <= F.col("frag_b")).count() == 0
