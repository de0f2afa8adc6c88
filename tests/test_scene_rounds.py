"""Scene clips kept up to date round by round, with a ranking shared by all videos."""

import random

from pyspark.sql import functions as F

from framecut.operators.normalize import for_videos
from framecut.params import Params
from framecut.plans import jobs
from framecut.sources import fixtures
from framecut.sources.tables import Inputs
from framecut.streaming.pending import current_clips, run_round
from framecut.streaming.scenes import current_scenes, update_scenes
from tests.conftest import SF001

DET = "media_id string, class_id long, time_start long, time_end long, object_img string, detection_id long, source string"


def _inputs(spark, detections, videos, scenes):
    labels = spark.createDataFrame([(c, str(c % 5), f"l2_{c % 3}", f"label{c}") for c in range(6)],
                                   "class_id long, class_type string, class1_name string, class2_name string")
    table = spark.createDataFrame([(v, f"name {v}", "c", "k", "r", "2024", "u.mp4") for v in videos],
                                  "videoId string, videoName string, category string, classify string, area string, "
                                  "releaseTime string, originalUrl string")
    return Inputs(spark.createDataFrame(detections, DET), labels, table,
                  spark.createDataFrame(scenes, "media_id string, story_start long, story_end long"))


def _detections(rng, videos, first_id=0):
    return [(v, rng.randrange(6), b := rng.randrange(0, 30_000), b + rng.randrange(1, 9_000), f"img{first_id + k}{v}",
             first_id + k, rng.choice(("face", "object"))) for v in videos for k in range(14)]


def _ids(spark, videos):
    return spark.createDataFrame([(v,) for v in videos], "video_id string")


def _same(spark, store, inp, p):
    batch = jobs.clips_scene(inp, p, tagged=True)
    got = current_scenes(spark, store).select(*batch.columns)
    assert sorted(map(repr, got.collect())) == sorted(map(repr, batch.collect()))


def test_rounds_in_any_order_equal_one_batch(spark, scratch):
    """Every round sees the detections of its own videos only; videos are ranked against all others, leave the first
    ranks, change, and come back without a scene."""
    p, rng = Params(top_k=4), random.Random(4)
    videos = [f"v{k}" for k in range(7)]
    det = _detections(rng, videos)
    scenes = [(v, s, s + 10_000) for v in videos for s in (0, 10_000, 20_000)]
    inp = _inputs(spark, det, videos, scenes)

    def only(some, rows, at=scenes):
        return _inputs(spark, [r for r in rows if r[0] in some], videos, [s for s in at if s[0] in some])

    for n, order in enumerate(([["v0", "v1"], ["v2"], ["v3", "v4", "v5"], ["v6"]], [["v6", "v3"], ["v5", "v4", "v2"], ["v1", "v0"]])):
        store = f"{scratch}/s{n}"
        for group in order:
            update_scenes(only(group, det), _ids(spark, group), store, p)
        _same(spark, store, inp, p)
    # v2 takes over, v0 loses its detections, v5 its scenes
    changed = [r for r in det if r[0] not in ("v0", "v2")]
    changed += [("v2", c, s + 10 * c, s + 9_900, f"big{s}", 900 + s + c, "face") for c in range(6) for s in (0, 10_000)]
    left = [s for s in scenes if s[0] != "v5"]
    update_scenes(only(["v0", "v2", "v5"], changed, left), _ids(spark, ["v0", "v2", "v5"]), store, p)
    _same(spark, store, _inputs(spark, changed, videos, left), p)
    # and the same round again changes nothing
    update_scenes(only(["v0", "v2", "v5"], changed, left), _ids(spark, ["v0", "v2", "v5"]), store, p)
    _same(spark, store, _inputs(spark, changed, videos, left), p)


def test_pending_rounds_with_a_scene_store_equal_the_batch(spark, scratch):
    inp = fixtures.inputs(spark, SF001)
    for k in range(2):
        tasks = inp.tasks.select("video_id", (F.abs(F.hash("video_id")) % 2 != k).cast("int").alias("status"))
        run_round(lambda: Inputs(inp.detections, inp.labels, inp.videos, inp.scenes, tasks), f"{scratch}/docs",
                  lambda ids: None, scratch, scene_store=f"{scratch}/scenes")
    batch = jobs.clips_all(inp)
    got = current_clips(spark, f"{scratch}/docs", f"{scratch}/scenes").select(*batch.columns)
    as_rows = lambda df: sorted(map(repr, df.collect()))
    assert as_rows(got) == as_rows(batch)


def test_a_round_reads_its_own_detections_only(spark):
    """The restriction to the round's videos is a broadcast semi join right above the scan."""
    inp = fixtures.inputs(spark, SF001)
    det = for_videos(jobs.detections(inp), _ids(spark, ["1", "2"]))
    plan = det._jdf.queryExecution().executedPlan().toString()
    assert "LeftSemi" in plan and "SortMergeJoin" not in plan
