"""Scene clips.

The containment join is an equi-join on (video, block of media time) with
the strict containment as a residual: a scene is cut into few aligned blocks,
some 6 a level and levels of 1, 4, 16, ... minutes, a detection probes the
block of its begin at each level up to the highest of any scene.  A pair meets at one
block only.  A video with many scenes is then never compared scene by scene
with all of its detections, and neither a scene of a year nor one with a
corrupt end becomes more than some 100 rows.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from framecut.operators.ordered import block_cover, block_of, highest_level
from framecut.params import BUCKET_MS, TOP_K

B, E, ID = "ad_seat_b_time", "ad_seat_e_time", "detection_id"
SCENE_KEYS = ("video_id", "story_start", "story_end")
LABEL_COLS = ("class_type_id", "class3_name", "class2_name")


def contained_in_scenes(det: DataFrame, scenes: DataFrame, bucket_ms: int = BUCKET_MS) -> DataFrame:
    """Detection x scene where ``begin > story_start and end <
    story_end`` (strict), on the same video."""
    sc = scenes.select(F.col("media_id").alias("video_id"), "story_start", "story_end")
    sc = sc.where(F.col("story_end") > F.col("story_start"))
    blocks = sc.select("*", F.inline(block_cover("story_start", "story_end", bucket_ms)))
    # the highest level of any scene: a subquery of the plan, not a job of its own
    top = sc.agg(F.max(highest_level("story_start", "story_end", bucket_ms))).scalar()
    levels = F.explode(F.sequence(F.lit(0), F.coalesce(top, F.lit(0))))
    probes = det.select("*", levels.alias("level")).withColumn("block", block_of(B, bucket_ms, "level"))
    j = probes.join(blocks, ["video_id", "level", "block"])
    return j.where((F.col(B) > F.col("story_start")) & (F.col(E) < F.col("story_end"))).drop("level", "block")


def screen_time(pairs: DataFrame) -> DataFrame:
    """Per (video, scene, label) the summed length of its
    detections (overlaps count twice), the first detection's image and times
    (first by (begin, detection_id)), and the share of the scene."""
    first = F.min_by(F.struct(F.col("ad_seat_img"), F.col(B), F.col(E)), F.struct(*(c for c in (B, ID, "source") if c in pairs.columns)))
    g = pairs.groupBy(*SCENE_KEYS, *LABEL_COLS).agg(
        F.sum(F.col(E) - F.col(B)).cast("bigint").alias("totaltime"),
        first.alias("_first"),
        F.count(F.lit(1)).cast("bigint").alias("n_detections"),
    )
    return g.select(
        *SCENE_KEYS, *LABEL_COLS, "totaltime", "n_detections",
        F.col("_first.ad_seat_img").alias("ad_seat_img"),
        F.col(f"_first.{B}").alias(B), F.col(f"_first.{E}").alias(E),
        (F.col("totaltime").cast("double") / (F.col("story_end") - F.col("story_start")).cast("double")).alias("appear_rate"),
    )


def top_labels(st: DataFrame, k: int = TOP_K, scope: str = "scene") -> DataFrame:
    """``row_number`` by screen time, keep ``rank <= k``.

    ``scope='scene'`` ranks within the scene bounds over all videos (the
    reference); ``'video_scene'`` within one video's scene.  Ties are broken by
    video and label so the result is deterministic.  Spark plans a partial
    ``WindowGroupLimit`` before the shuffle, so at most k rows per scene bounds
    leave each map task even when every video shares the same bounds.
    """
    if scope == "scene":
        part = ["story_start", "story_end"]
    elif scope == "video_scene":
        part = list(SCENE_KEYS)
    else:
        raise ValueError(f"scope must be 'scene' or 'video_scene', not {scope!r}")
    w = Window.partitionBy(*part).orderBy(F.col("totaltime").desc(), "video_id", *LABEL_COLS)
    return st.withColumn("rank", F.row_number().over(w)).where(F.col("rank") <= k)


def fold_scene(top: DataFrame) -> DataFrame:
    """One row per (video, scene) with the sets of labels (as (type, name)
    pairs), images and level-2 labels, each sorted."""
    tag = F.struct(F.col("class_type_id").alias("t"), F.col("class3_name").alias("n"))
    return top.groupBy(*SCENE_KEYS).agg(
        F.array_sort(F.collect_set(F.when(F.col("class3_name").isNotNull(), tag))).alias("tags"),
        F.array_sort(F.collect_set("ad_seat_img")).alias("imgs"),
        F.array_sort(F.collect_set("class2_name")).alias("class2s"),
    )
