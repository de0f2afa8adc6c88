"""Plan shape checks: what the physical plans must (not) contain."""

from framecut.plans.catalog import QUERIES
from tests.conftest import SF01


def plan(spark, name):
    df = QUERIES[name](spark, SF01)
    return df._jdf.queryExecution().executedPlan().toString() + df._jdf.queryExecution().optimizedPlan().toString()


def test_topk_has_partial_group_limit(spark):
    df = QUERIES["scene_topk"](spark, SF01)
    txt = df._jdf.queryExecution().sparkPlan().toString()
    assert "WindowGroupLimit" in txt and "Partial" in txt


def test_no_python_in_default_paths(spark):
    for name in ("clips_single", "clips_multi_v2", "clips_scene", "sessions_last", "segments"):
        txt = plan(spark, name)
        for bad in ("BatchEvalPython", "ArrowEvalPython", "FlatMapGroupsInPandas", "MapInPandas"):
            assert bad not in txt, (name, bad)


def test_scan_prunes_columns_and_pushes_filters(spark):
    df = QUERIES["pad_intervals"](spark, SF01)
    txt = df._jdf.queryExecution().executedPlan().toString()
    assert "props" not in txt  # unused column never read
    assert "PushedFilters: [IsNotNull(user_id)" in txt


def test_labels_broadcast_not_detections(spark):
    df = QUERIES["pad_intervals"](spark, SF01)
    txt = df._jdf.queryExecution().sparkPlan().toString()
    assert "BroadcastHashJoin" in txt and "BuildRight" in txt


def test_building_an_ordered_scan_starts_no_job(spark):
    """Merges, sessions and segments are parts of one plan: nothing runs, and
    nothing is persisted, before the caller's action."""
    from framecut.operators.merge import merge_same_label
    from framecut.operators.segment import segment
    from framecut.operators.sessions import session_summary
    rows = spark.createDataFrame([("v", "L", 0, 1000, 1)], "video_id string, class3_name string, "
                                 "ad_seat_b_time long, ad_seat_e_time long, detection_id long")
    status, group = spark.sparkContext.statusTracker(), "building-an-ordered-scan"
    spark.sparkContext.setJobGroup(group, group)
    try:
        merged = merge_same_label(rows, 10000)
        built = [merged, segment(merged), session_summary(merged, 10000, "last"), session_summary(merged, 10000, "max")]
        plans = [d._jdf.queryExecution().executedPlan().toString() for d in built]
        assert not list(status.getJobIdsForGroup(group))
    finally:
        spark.sparkContext.setLocalProperty("spark.jobGroup.id", None)
    assert not any("InMemoryTableScan" in p for p in plans)


def test_single_path_has_two_row_level_exchanges(spark):
    """Copies per begin, rows per bucket, then one row per local island: no
    other exchange of the detections."""
    df = QUERIES["merge_touching_last"](spark, SF01)
    lines = df._jdf.queryExecution().executedPlan().toString().split("\n")
    video = [l for l in lines if "Exchange hashpartitioning(video_id" in l and "class3_name" in l]
    assert len(video) == 3
    assert sum("_bk" in l or "ad_seat_b_time" in l for l in video) == 2


def test_cluster_conf_scales_partitions_with_input():
    from framecut.session import cluster_conf
    small = cluster_conf(10 ** 6, cores=8)
    big = cluster_conf(100 * 1024 ** 4, cores=8000)
    assert small["spark.sql.shuffle.partitions"] == "16"
    assert big["spark.sql.shuffle.partitions"] == "64000"
    assert "spark.checkpoint.dir" not in big


def test_label_dimension_without_statistics_is_broadcast_after_count(spark):
    """A label table whose size Spark cannot estimate (like a JDBC read) is
    broadcast after the row-count check, never joined by shuffling the
    detections on class_id."""
    from framecut.operators.normalize import label_detections
    from framecut.sources import fixtures
    inp = fixtures.inputs(spark, SF01)
    lab = inp.labels
    no_stats = spark.createDataFrame(spark.sparkContext.parallelize(lab.collect()), lab.schema)
    txt = label_detections(inp.detections, no_stats)._jdf.queryExecution().sparkPlan().toString()
    assert "BroadcastHashJoin" in txt and "SortMergeJoin" not in txt


def test_merge_combines_copies_before_the_first_shuffle(spark):
    """Copies of a detection (one key may hold a third of all rows) are
    combined map-side: the detections' first exchange sits on a partial
    aggregate, not on the raw scan.  (The first row's attributes are a
    struct with strings, so Spark plans a sort-based aggregate.)"""
    df = QUERIES["merge_touching_last"](spark, SF01)
    lines = df._jdf.queryExecution().executedPlan().toString().split("\n")
    firsts = [i for i, l in enumerate(lines)
              if "Exchange hashpartitioning(video_id" in l and "ad_seat_b_time" in l]
    assert firsts
    for i in firsts:
        assert "Aggregate" in lines[i + 1] and "partial_" in lines[i + 1], lines[i + 1]


def test_single_and_multi_clips_share_one_ordered_scan(spark):
    """Detections are read and shuffled once for both kinds: what differs
    starts above the last exchange of the scan, which the second kind reuses."""
    from framecut.plans import jobs
    from framecut.sources import fixtures
    docs = jobs.clips_detections(fixtures.inputs(spark, SF01))
    docs.collect()
    txt = docs._jdf.queryExecution().executedPlan().toString()
    final = txt.split("== Initial Plan ==")[0]
    assert final.count("events.parquet") == 1 and "ReusedExchange" in final


def test_repeated_videos_do_not_multiply_documents(spark):
    from dataclasses import replace
    from framecut.plans import jobs
    from framecut.sources import fixtures
    inp = fixtures.inputs(spark, SF01)
    twice = replace(inp, videos=inp.videos.unionByName(inp.videos))
    docs = jobs.clips_all(twice)
    assert docs.count() == jobs.clips_all(inp).count() == docs.select("clip_id").distinct().count()
