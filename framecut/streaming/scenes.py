"""W1/W2 in rounds: scene clips kept up to date as videos arrive and change.

With ``scope='scene'`` the labels of a scene are ranked over all videos with
the same scene bounds, so a video of a round can push labels of other videos
out of a top ten, or let them back in.  Recomputing that from detections would
read them all.  Instead the screen times per (video, scene, label) are stored
by round, and a round

1. computes the screen times of its own videos from their detections only,
2. finds the scene bounds these videos touch, now or before,
3. ranks these bounds from the stored screen times as they were and as they
   become, and
4. publishes the scene clips of its own videos and of every other video whose
   labels among the first ``k`` changed.

What is read of other videos is their stored screen times, a row per label and
scene, never their detections.  The clips are published before the screen
times: a round that fails in between finds the same changes when repeated.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from framecut.functions.intervals import range_label
from framecut.operators import documents as D
from framecut.operators.normalize import broadcast_checked, known_videos
from framecut.operators.scenes import LABEL_COLS, SCENE_KEYS, contained_in_scenes, fold_scene, screen_time, top_labels
from framecut.params import Params
from framecut.plans.jobs import detections
from framecut.sources.sinks import current, next_round, publish, replace_keys, write_version
from framecut.sources.tables import Inputs

BOUNDS = ["story_start", "story_end"]
#: What a scene clip shows of a ranked label.
SHOWN = [*SCENE_KEYS, *LABEL_COLS, "ad_seat_img"]


def _round_screen_time(inp: Inputs, ids: DataFrame, p: Params) -> DataFrame:
    """The screen times of the round's videos, from their own detections and scenes."""
    scenes = inp.scenes.join(broadcast_checked(ids.select(F.col("video_id").alias("media_id"))), "media_id", "left_semi")
    return known_videos(screen_time(contained_in_scenes(detections(inp, ids), scenes, p.bucket_ms)), inp.videos)


def update_scenes(inp: Inputs, ids: DataFrame, store: str, p: Params = Params()) -> int:
    """One round over the videos ``ids`` (distinct ``video_id``); returns the
    number of scene clips published, those of other videos included."""
    spark, screen, clips = ids.sparkSession, f"{store}/screen", f"{store}/clips"
    this = next_round(spark, screen)
    write_version(_round_screen_time(inp, ids, p), screen, this)
    new = spark.read.parquet(f"{screen}/documents").where(F.col("round") == this).drop("round")
    old = current(spark, screen)
    old = new.limit(0) if old is None else old.select(*new.columns)
    own = broadcast_checked(ids.select("video_id"))
    own_rows = old.join(own, "video_id", "left_semi").unionByName(new)
    touched = broadcast_checked(own_rows.select(*BOUNDS).distinct())
    stays = old.join(own, "video_id", "left_anti")

    def ranked(rows: DataFrame) -> DataFrame:
        return top_labels(rows.join(touched, BOUNDS, "left_semi"), p.top_k, p.scope)

    before, after = ranked(old), ranked(stays.unionByName(new))
    shown = before.select(*SHOWN, F.lit(-1).alias("n")).unionByName(after.select(*SHOWN, F.lit(1).alias("n")))
    changed = shown.groupBy(*SHOWN).agg(F.sum("n").alias("n")).where(F.col("n") != 0)
    keys = changed.select(*SCENE_KEYS).unionByName(own_rows.select(*SCENE_KEYS)).distinct()
    docs = D.scene_documents(fold_scene(after.join(keys, list(SCENE_KEYS), "left_semi")), inp.videos, tagged=True)
    docs = D.with_clip_id(docs, "scene").withColumn("kind", F.lit("scene"))
    named = keys.select(F.col("video_id").alias("string_vid"), range_label(*BOUNDS).alias("string_time"))
    written = replace_keys(docs, named, clips)
    publish(ids.select("video_id"), screen, this)
    return written


def current_scenes(spark: SparkSession, store: str) -> DataFrame | None:
    """The scene clips of all rounds so far (None before the first)."""
    return current(spark, f"{store}/clips")
