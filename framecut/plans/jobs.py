"""Q1-Q9: the clip jobs as DataFrame compositions.

``load -> normalize -> clips_single | clips_multi | clips_scene ->
documents``; each arrow is a ``DataFrame -> DataFrame`` function, run
by the caller's action; nothing is persisted on the way.  ``video_ids`` (a list, or a
DataFrame of ``video_id``) restricts every kind to the requested videos (T5).
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Observation
from pyspark.sql import functions as F

from framecut.operators import documents as D
from framecut.operators.merge import merge_kinds, merge_same_label, pad
from framecut.operators.normalize import for_videos, known_videos, labelled, normalize
from framecut.operators.scenes import contained_in_scenes, fold_scene, screen_time, top_labels
from framecut.operators.sessions import cluster_bounds, cluster_members, sessions
from framecut.params import Params
from framecut.sources.tables import Inputs

B, E = "ad_seat_b_time", "ad_seat_e_time"


def detections(inp: Inputs, video_ids: DataFrame | list[str] | None = None,
               rejects: Observation | None = None) -> DataFrame:
    det = normalize(inp.detections, inp.labels, rejects)
    return for_videos(det, video_ids) if video_ids is not None else det


def single_clips(det: DataFrame, p: Params = Params()) -> DataFrame:
    """I1 -> I2 -> I5 -> P7: one clip per merged interval of one label.

    After merging, the intervals of one (video, label) are disjoint, so the
    reference's per-label sweep gives exactly one fragment per interval."""
    return _single(merge_same_label(labelled(det), gap_ms=0, pad_ms=p.pad_ms, reach=p.reach, bucket_ms=p.bucket_ms), p)


def _single(merged: DataFrame, p: Params) -> DataFrame:
    clips = pad(merged, p.context_ms)
    clips = clips.where(F.col(E) - F.col(B) >= p.min_clip_ms)
    return clips.select("video_id", B, E, F.array(D.member_struct()).alias("members"))


def multi_clusters(det: DataFrame, p: Params = Params()) -> DataFrame:
    """I3 -> I6 -> A7/A10 -> P7: one row per cluster with its members."""
    return _multi(merge_same_label(det, gap_ms=p.gap_ms, pad_ms=0, reach=p.reach, bucket_ms=p.bucket_ms), p)


def _multi(merged: DataFrame, p: Params) -> DataFrame:
    begin, end = cluster_bounds()
    cl = sessions(merged, p.gap_ms, p.reach, D.member_struct(), p.bucket_ms).select(
        "video_id", begin.alias(B), end.alias(E), cluster_members().alias("members"))
    return cl.where(F.col(E) - F.col(B) >= p.min_clip_ms)


def scene_folds(inp: Inputs, det: DataFrame, p: Params = Params(),
                video_ids: DataFrame | list[str] | None = None) -> DataFrame:
    """J5 -> A4 -> W1/W2 -> A6.  ``det`` must be all detections when
    ``p.scope='scene'``: the ranking then compares all videos that share the
    scene bounds, so a video restriction is applied to the ranked rows, and a
    clip of a video is the same whether it is computed alone or in a batch."""
    pairs = contained_in_scenes(det, inp.scenes, p.bucket_ms)
    st = known_videos(screen_time(pairs), inp.videos)
    top = top_labels(st, p.top_k, p.scope)
    if video_ids is not None:
        top = for_videos(top, video_ids)
    return fold_scene(top)


def _scene_detections(inp: Inputs, p: Params, video_ids: DataFrame | list[str] | None) -> DataFrame:
    return detections(inp, None if p.scope == "scene" else video_ids)


def clips_single(inp: Inputs, p: Params = Params(), typed: bool = False,
                 video_ids: DataFrame | list[str] | None = None) -> DataFrame:
    """Q1/Q2 (D1), or the typed form of Q8."""
    return D.single_documents(single_clips(detections(inp, video_ids), p), inp.videos, typed)


def clips_multi(inp: Inputs, p: Params = Params(), version: int = 2,
                video_ids: DataFrame | list[str] | None = None) -> DataFrame:
    """Q3 (v1), Q5 (v2), Q8 (v3)."""
    return D.multi_documents(multi_clusters(detections(inp, video_ids), p), inp.videos, version)


def clips_scene(inp: Inputs, p: Params = Params(), tagged: bool = False,
                video_ids: DataFrame | list[str] | None = None) -> DataFrame:
    """Q7 (D6) and the scene part of Q8 (D7).  Unlike the reference, a video
    restriction applies to the scene part as well (to its output)."""
    folds = scene_folds(inp, _scene_detections(inp, p, video_ids), p, video_ids)
    return D.scene_documents(folds, inp.videos, tagged)


def _by_kind(parts: dict[str, DataFrame]) -> DataFrame:
    """Documents of several kinds in one DataFrame, with ``kind`` and ``clip_id``."""
    out = None
    for kind, docs in parts.items():
        part = D.with_clip_id(docs, kind).withColumn("kind", F.lit(kind))
        out = part if out is None else out.unionByName(part, allowMissingColumns=True)
    return out


def clips_detections(inp: Inputs, p: Params = Params(), video_ids: DataFrame | list[str] | None = None,
                     version: int = 3, typed: bool = True, rejects: Observation | None = None) -> DataFrame:
    """The single and multi-label documents (of Q8 by default) from one ordered
    scan of the detections; ``rejects`` counts in it what is left out."""
    touching, near = merge_kinds(detections(inp, video_ids, rejects), p.pad_ms, p.gap_ms, p.reach, p.bucket_ms)
    return _by_kind({"single": D.single_documents(_single(touching, p), inp.videos, typed),
                     "multi": D.multi_documents(_multi(near, p), inp.videos, version)})


def clips_all(inp: Inputs, p: Params = Params(), video_ids: DataFrame | list[str] | None = None,
              rejects: Observation | None = None) -> DataFrame:
    """Q8 / Q9 (U3): typed single clips, multi v3 and tagged scene clips in one
    DataFrame with a ``kind`` column and a stable ``clip_id``.  Single and
    multi-label clips share one ordered scan of the detections; the scene part
    reads them again, as a second scan of pruned columns costs less than
    another shuffle of all detections."""
    scene = _by_kind({"scene": clips_scene(inp, p, tagged=True, video_ids=video_ids)})
    return clips_detections(inp, p, video_ids, rejects=rejects).unionByName(scene, allowMissingColumns=True)


def multi_v1(inp: Inputs, p: Params = Params(), video_ids: DataFrame | list[str] | None = None) -> DataFrame:
    """Q4: multi-label documents of the first form with their ``kind`` and ``clip_id``."""
    return D.with_clip_id(clips_multi(inp, p, 1, video_ids), "multi").withColumn("kind", F.lit("multi"))


def clips_union(inp: Inputs, p: Params = Params(), version: int = 2,
                video_ids: DataFrame | list[str] | None = None) -> DataFrame:
    """Q5 / Q6: single-label and multi-label documents in one DataFrame with
    their ``kind`` and ``clip_id``."""
    return clips_detections(inp, p, video_ids, version, typed=False)
