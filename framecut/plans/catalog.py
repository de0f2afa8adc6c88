"""The registered queries: one callable ``(spark, sf_dir) -> DataFrame`` per
operator or job, all reading the test tables through ``sources.fixtures``.

Documents are returned flat so that results can be compared by value:
lists become ``'|'``-joined text in list order, the label -> image map
``label=image`` pairs; every computed column is aliased.
"""

from __future__ import annotations

import uuid
from dataclasses import replace
from typing import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from framecut.operators import documents as D
from framecut.operators import normalize as N
from framecut.operators.merge import merge_same_label, pad
from framecut.operators.scenes import contained_in_scenes, screen_time, top_labels
from framecut.operators.segment import segment
from framecut.operators.sessions import session_summary, session_window_summary
from framecut.params import Params
from framecut.plans import jobs
from framecut.sources import fixtures
from framecut.sources.tables import pending_tasks
from framecut.session import ensure_checkpoint_dir
from framecut.streaming.clusters import END_MS, keyed_state, stream_clusters
from framecut.streaming.islands import add_detections, merged_intervals
from framecut.streaming.pending import mark_processed
from framecut.streaming.scenes import current_scenes, update_scenes

B, E = "ad_seat_b_time", "ad_seat_e_time"
Query = Callable[[SparkSession, str], DataFrame]

# --- fixed values (query parameters) -----------------------------------------
# market segment whose videos are recomputed on demand in clips_for_videos
REQUEST_SEGMENT = "AUTOMOBILE"
# per-video top-k of scene_topk_per_video (a scene has at most 5 labels per
# video in the fixtures, so 10 would never cut)
TOPK_PER_VIDEO = 3
# groups in which the videos of clips_scene_rounds arrive
SCENE_ROUNDS = 3
# ------------------------------------------------------------------------------


def flat(df: DataFrame) -> DataFrame:
    """Lists -> '|'-joined text, maps -> sorted 'key=value' text."""
    cols: list[Column] = []
    for f in df.schema.fields:
        t = f.dataType.typeName()
        if t == "array":
            cols.append(F.concat_ws("|", F.col(f.name)).alias(f.name))
        elif t == "map":
            ent = F.array_sort(F.map_entries(F.col(f.name)))
            cols.append(F.concat_ws("|", F.transform(ent, lambda x: F.concat_ws("=", x["key"], x["value"])))
                        .alias(f.name))
        else:
            cols.append(F.col(f.name))
    return df.select(*cols)


def _inputs(spark, sf):
    return fixtures.inputs(spark, sf)


def _narrow(spark, sf):
    inp = _inputs(spark, sf)
    return N.normalize(inp.detections, inp.labels)


def _dirty_inputs(spark, sf):
    """The fixtures with null labels and videos, negative begins, ends before
    begins, null offsets and ids that repeat across sources."""
    inp = _inputs(spark, sf)
    n = F.col("detection_id")
    det = inp.detections.select(
        F.when(n % 19 == 0, None).otherwise(F.col("media_id")).alias("media_id"),
        F.when(n % 11 == 0, 6).when(n % 29 == 0, 7).otherwise(F.col("class_id")).cast("bigint").alias("class_id"),
        F.when(n % 13 == 0, -1000).otherwise(F.col("time_start")).cast("bigint").alias("time_start"),
        F.when(n % 17 == 0, -2000).when(n % 23 == 0, None).otherwise(F.col("time_end")).cast("bigint").alias("time_end"),
        "object_img", F.floor(n / 4).cast("bigint").alias("detection_id"), "source")
    extra = inp.labels.sparkSession.createDataFrame(
        [(6, "2", "place", None), (7, "9", "odd", "odd")],
        "class_id bigint, class_type string, class1_name string, class2_name string")
    return replace(inp, detections=det, labels=inp.labels.unionByName(extra))


def clips_multi_dirty(spark, sf):
    return flat(jobs.clips_multi(_dirty_inputs(spark, sf), version=2))


def clips_single_dirty(spark, sf):
    return flat(jobs.clips_single(_dirty_inputs(spark, sf)))


def clips_scene_dirty(spark, sf):
    return flat(jobs.clips_scene(_dirty_inputs(spark, sf)))


def clips_union_v2(spark, sf):
    """Q5: single and multi v2 documents together."""
    return jobs.clips_union(_inputs(spark, sf)).select("kind", "clip_id", "string_vid", "string_time")


def clips_all_for_videos(spark, sf):
    """Q9: all kinds for the requested videos."""
    inp = _inputs(spark, sf)
    ids = inp.videos.where(F.col("category") == REQUEST_SEGMENT).select(F.col("videoId").alias("video_id"))
    return jobs.clips_all(inp, video_ids=ids).select("kind", "clip_id", "string_vid", "string_time")


def rejected_counts(spark, sf):
    inp = _dirty_inputs(spark, sf)
    return N.rejected_counts(inp.detections, inp.labels)


def rejected_counts_all(spark, sf):
    """The dirty detections, some of them also of an unknown class or video."""
    inp = _dirty_inputs(spark, sf)
    at = F.regexp_extract("object_img", "[0-9]+", 0).cast("bigint")
    det = (inp.detections.withColumn("class_id", F.when(at % 31 == 0, 99).otherwise(F.col("class_id")).cast("bigint"))
           .withColumn("media_id", F.when(at % 37 == 0, "nobody").otherwise(F.col("media_id"))))
    return N.rejected_counts(det, inp.labels, inp.videos)


def known_types_dirty(spark, sf):
    """P9 where it bites: null labels and types outside 1..4."""
    inp = _dirty_inputs(spark, sf)
    return N.known_types(N.enrich(inp.detections, inp.labels, inp.videos))


def _known(df, spark, sf):
    """Keep rows of videos present in the video table (checked on the
    operator's output, which is smaller than its input)."""
    return N.known_videos(df, fixtures.inputs(spark, sf).videos)


def _enriched(spark, sf):
    inp = _inputs(spark, sf)
    return N.enrich(inp.detections, inp.labels, inp.videos)


def detections_union(spark, sf):
    return N.unify_sources(fixtures.detection_tables(spark, sf))


def detections_enriched(spark, sf):
    inp = _inputs(spark, sf)
    return N.enrich(fixtures.detection_tables(spark, sf), inp.labels, inp.videos)


def detections_pending(spark, sf):
    return N.pending(_enriched(spark, sf), _inputs(spark, sf).tasks)


def detections_exclude_suffix(spark, sf):
    return N.exclude_suffix(_enriched(spark, sf), _inputs(spark, sf).videos, ".ts")


def detections_known_types(spark, sf):
    return N.known_types(_enriched(spark, sf))


def pad_intervals(spark, sf):
    p = Params()
    return _known(pad(_narrow(spark, sf), p.pad_ms), spark, sf).select(
        "video_id", "class3_name", "detection_id", B, E)


def _merge(gap, pad_ms, reach):
    def q(spark, sf):
        return _known(merge_same_label(_narrow(spark, sf), gap_ms=gap, pad_ms=pad_ms, reach=reach), spark, sf)
    return q


def clips_single(spark, sf):
    return flat(jobs.clips_single(_inputs(spark, sf)))


def clips_single_typed(spark, sf):
    return flat(jobs.clips_single(_inputs(spark, sf), typed=True))


def _requested(inp):
    """The videos of the request segment, as a DataFrame of ids."""
    return inp.videos.where(F.col("category") == REQUEST_SEGMENT).select(F.col("videoId").alias("video_id"))


def detections_for_video(spark, sf):
    return N.for_videos(_enriched(spark, sf), _requested(_inputs(spark, sf)))


def clips_for_videos(spark, sf):
    inp = _inputs(spark, sf)
    return flat(jobs.clips_single(inp, video_ids=_requested(inp)))


def _touching(spark, sf):
    p = Params()
    return merge_same_label(_narrow(spark, sf), gap_ms=0, pad_ms=p.pad_ms, reach=p.reach)


def segments(spark, sf):
    seg = _known(segment(_touching(spark, sf)), spark, sf)
    lab = F.array_sort(F.collect_list(F.struct("class3_name", "detection_id")))
    return seg.groupBy("video_id", "frag_b", "frag_e").agg(
        F.count(F.lit(1)).cast("bigint").alias("n_active"),
        F.concat_ws("|", F.transform(lab, lambda x: x["class3_name"])).alias("labels"))


def segment_labels(spark, sf):
    return _known(segment(_touching(spark, sf)), spark, sf).select("video_id", "frag_b", "frag_e", "class3_name",
                                                "detection_id", "ad_seat_img")


def _near(spark, sf, reach):
    return merge_same_label(_narrow(spark, sf), gap_ms=Params().gap_ms, pad_ms=0, reach=reach)


def sessions_last(spark, sf):
    return _known(session_summary(_near(spark, sf, "last"), Params().gap_ms, "last"), spark, sf)


def sessions_max(spark, sf):
    return _known(session_summary(_near(spark, sf, "max"), Params().gap_ms, "max"), spark, sf)


def sessions_window(spark, sf):
    return _known(session_window_summary(_near(spark, sf, "max"), Params().gap_ms), spark, sf)


def _multi(version):
    def q(spark, sf):
        return flat(jobs.clips_multi(_inputs(spark, sf), version=version))
    return q


def scene_containment(spark, sf):
    inp = _inputs(spark, sf)
    pairs = N.known_videos(contained_in_scenes(N.normalize(inp.detections, inp.labels), inp.scenes), inp.videos)
    return pairs.select("video_id", "story_start", "story_end", "detection_id", "class3_name", B, E)


def _screen(spark, sf):
    inp = _inputs(spark, sf)
    return N.known_videos(screen_time(contained_in_scenes(N.normalize(inp.detections, inp.labels), inp.scenes)),
                          inp.videos)


def scene_screen_time(spark, sf):
    return _screen(spark, sf)


def _topk(k, scope):
    def q(spark, sf):
        return top_labels(_screen(spark, sf), k, scope).select(
            "video_id", "story_start", "story_end", "class_type_id", "class3_name", "class2_name",
            "totaltime", F.col("rank").cast("bigint").alias("rank"))
    return q


def clips_scene(spark, sf):
    return flat(jobs.clips_scene(_inputs(spark, sf)))


def clips_scene_tagged(spark, sf):
    return flat(jobs.clips_scene(_inputs(spark, sf), tagged=True))


def clips_all(spark, sf):
    docs = jobs.clips_all(_inputs(spark, sf))
    return docs.select("kind", "clip_id", "string_vid", "string_time",
                       F.concat_ws("|", "string_class3_list").alias("labels"), "resourceId")


def clips_scene_rounds(spark, sf):
    """Q7 in rounds: the videos arrive in three groups, and the scene clips
    that are current after the last round are those of one batch."""
    inp = _inputs(spark, sf)
    ids = inp.videos.select(F.col("videoId").alias("video_id")).distinct()
    store = f"{ensure_checkpoint_dir(spark)}/scene-rounds-{uuid.uuid4().hex}"
    for k in range(SCENE_ROUNDS):
        update_scenes(inp, ids.where(F.pmod(F.hash("video_id"), F.lit(SCENE_ROUNDS)) == k), store)
    return flat(current_scenes(spark, store).drop("kind", "clip_id"))


def merge_rounds(spark, sf):
    """I3 in rounds: detections arrive in two halves that interleave; the
    intervals folded from the stored islands are those of one merge."""
    store, gap = f"{ensure_checkpoint_dir(spark)}/merge-rounds-{uuid.uuid4().hex}", Params().gap_ms
    det = _narrow(spark, sf)
    for k in range(2):
        add_detections(det.where(F.col("detection_id") % 2 == k), store, gap)
    return _known(merged_intervals(spark, store, gap), spark, sf)


def sessions_last_stream(spark, sf):
    """I6 on a stream: the merged intervals arrive as one file stream, then a
    late one of another video moves the watermark past all of them."""
    root = f"{ensure_checkpoint_dir(spark)}/sessions-stream-{uuid.uuid4().hex}"
    near = _near(spark, sf, "last")
    last = spark.range(1).select(*(F.lit({"video_id": "end of stream", "ad_seat_b_time": END_MS, "ad_seat_e_time": END_MS,
                                          "detection_id": 0}.get(f.name)).cast(f.dataType).alias(f.name)
                                   for f in near.schema.fields))
    for arrived in (near, last):
        arrived.write.mode("append").parquet(f"{root}/in")
        found = stream_clusters(spark.readStream.schema(near.schema).parquet(f"{root}/in"), Params().gap_ms)
        with keyed_state(spark):
            run = (found.writeStream.format("parquet").option("path", f"{root}/out")
                   .option("checkpointLocation", f"{root}/state").trigger(availableNow=True).start())
        run.awaitTermination()
    return _known(spark.read.parquet(f"{root}/out"), spark, sf)


def _twice(videos):
    """Every video also under another name and area."""
    return videos.unionByName(videos.withColumn("videoName", F.concat("videoName", F.lit(" again")))
                              .withColumn("area", F.lit("ELSEWHERE")))


def clips_duplicate_videos(spark, sf):
    """A video table that repeats its ids multiplies no document."""
    inp = _inputs(spark, sf)
    return flat(jobs.clips_single(replace(inp, videos=_twice(inp.videos))))


def duplicate_videos(spark, sf):
    return N.assert_unique_videos(_twice(_inputs(spark, sf).videos))


def clip_counts(spark, sf):
    docs = jobs.clips_all(_inputs(spark, sf))
    return docs.groupBy("kind").agg(F.count(F.lit(1)).cast("bigint").alias("n_clips"))


def clips_json(spark, sf):
    docs = jobs.clips_all(_inputs(spark, sf))
    return D.to_json_lines(docs.drop("kind", "clip_id"))


def tasks_after_round(spark, sf):
    inp = _inputs(spark, sf)
    processed = pending_tasks(inp.tasks).select("video_id")
    return mark_processed(inp.tasks, processed)


QUERIES: dict[str, Query] = {
    "detections_union": detections_union,
    "detections_enriched": detections_enriched,
    "detections_pending": detections_pending,
    "detections_exclude_suffix": detections_exclude_suffix,
    "detections_known_types": detections_known_types,
    "detections_for_video": detections_for_video,
    "pad_intervals": pad_intervals,
    "merge_touching_last": _merge(0, Params().pad_ms, "last"),
    "merge_touching_max": _merge(0, Params().pad_ms, "max"),
    "merge_near_last": _merge(Params().gap_ms, 0, "last"),
    "merge_near_max": _merge(Params().gap_ms, 0, "max"),
    "clips_single": clips_single,
    "clips_single_typed": clips_single_typed,
    "clips_for_videos": clips_for_videos,
    "segments": segments,
    "segment_labels": segment_labels,
    "sessions_last": sessions_last,
    "sessions_max": sessions_max,
    "sessions_window": sessions_window,
    "clips_single_dirty": clips_single_dirty,
    "clips_multi_dirty": clips_multi_dirty,
    "clips_scene_dirty": clips_scene_dirty,
    "known_types_dirty": known_types_dirty,
    "rejected_counts": rejected_counts,
    "rejected_counts_all": rejected_counts_all,
    "clips_union_v2": clips_union_v2,
    "clips_all_for_videos": clips_all_for_videos,
    "clips_multi_v1": _multi(1),
    "clips_multi_v2": _multi(2),
    "clips_multi_v3": _multi(3),
    "scene_containment": scene_containment,
    "scene_screen_time": scene_screen_time,
    "scene_topk": _topk(Params().top_k, "scene"),
    "scene_topk_per_video": _topk(TOPK_PER_VIDEO, "video_scene"),
    "clips_scene": clips_scene,
    "clips_scene_tagged": clips_scene_tagged,
    "clips_all": clips_all,
    "clips_scene_rounds": clips_scene_rounds,
    "merge_rounds": merge_rounds,
    "sessions_last_stream": sessions_last_stream,
    "clips_duplicate_videos": clips_duplicate_videos,
    "duplicate_videos": duplicate_videos,
    "clip_counts": clip_counts,
    "clips_json": clips_json,
    "tasks_after_round": tasks_after_round,
}
