"""Union, star join and the row filters of the ingest step.

U1 is written factored: the narrow detection tables are unioned first and
the dimensions joined once, instead of joining inside every union branch.
Video attributes are joined late (once per clip) by the clip jobs; here the
detections are only checked against the video table.
"""

from __future__ import annotations

from typing import Mapping

from pyspark.sql import Column, DataFrame, Observation
from pyspark.sql import functions as F

from framecut import params as P
from framecut import schemas
from framecut.sources.tables import detection_scan, pending_tasks, playable_videos

B = "ad_seat_b_time"
#: Parts in which a video's detections are dealt when they meet a long list of ids.
VIDEO_SLOTS = 8


def unify_sources(tables: Mapping[str, DataFrame] | DataFrame) -> DataFrame:
    """S2 + U1: the detection tables as one DataFrame with a ``source`` column,
    duplicates kept (``UNION ALL``)."""
    if isinstance(tables, DataFrame):
        return tables
    out = None
    for source, df in tables.items():
        part = df if "source" in df.columns else detection_scan(df, source)
        out = part if out is None else out.unionByName(part)
    return out


def broadcast_checked(dim: DataFrame, max_rows: int = P.MAX_BROADCAST_ROWS) -> DataFrame:
    """``dim`` marked for broadcast when it has at most ``max_rows`` rows
    (counted on at most ``max_rows + 1`` rows); otherwise unchanged, and the
    join is planned by Spark (shuffle, or a broadcast chosen by AQE from the
    measured size)."""
    n = dim.limit(max_rows + 1).count()
    return F.broadcast(dim) if n <= max_rows else dim


def label_detections(det: DataFrame, labels: DataFrame, keep_unknown: bool = False) -> DataFrame:
    """J1 + P1: detection x label dimension (inner, on ``class_id``), renamed to
    the narrow unified layout.  ``keep_unknown`` keeps detections of unknown
    classes, with null labels, and adds ``known_class``.  The label dimension is broadcast after a row
    count check: read over JDBC its size is unknown to Spark, and a shuffle
    of all detections on ``class_id`` (a few hot keys) must not happen."""
    lab = broadcast_checked(labels).select(
        "class_id",
        F.col("class1_name").alias("class2_name"),
        F.col("class_type").alias("class_type_id"),
        F.col("class2_name").alias("class3_name"),
        F.lit(True).alias("_known"),
    )
    known = [F.coalesce("_known", F.lit(False)).alias("known_class")] if keep_unknown else []
    return det.join(lab, "class_id", "left" if keep_unknown else "inner").select(
        F.col("media_id").alias("video_id"),
        "class2_name", "class_type_id", "class3_name",
        F.col("time_start").alias("ad_seat_b_time"),
        F.col("time_end").alias("ad_seat_e_time"),
        F.col("object_img").alias("ad_seat_img"),
        "detection_id", "source", *known,
    )


def video_attributes(videos: DataFrame) -> DataFrame:
    """S4 projected for the documents: one row per video (J3).  Of several
    rows of a video the least in this order of columns counts, as a whole;
    ``assert_unique_videos`` reports such videos."""
    fields = F.struct(
        F.col("videoName").alias("media_name"),
        F.col("category").alias("drama_name"),
        F.col("classify").alias("drama_type_name"),
        F.col("area").alias("media_area_name"),
    )
    return (videos.groupBy(F.col("videoId").alias("video_id")).agg(F.min(fields).alias("_v"))
            .select("video_id", "_v.*"))


def known_videos(det: DataFrame, videos: DataFrame) -> DataFrame:
    """J2 without the attributes: keep detections whose video exists."""
    return det.join(videos.select(F.col("videoId").alias("video_id")), "video_id", "left_semi")


def reject_reason() -> Column:
    """Why the interval operators cannot take a row (null: they can).

    A null label is kept (multi-label and scene clips carry it; the
    single-label job, which groups by label, rejects it itself), and so is a
    negative begin (padding floors it at 0)."""
    return (F.when(F.col("video_id").isNull(), "null_video")
            .when(F.col("ad_seat_b_time").isNull() | F.col("ad_seat_e_time").isNull(), "null_offset")
            .when(F.col("ad_seat_e_time") < F.col("ad_seat_b_time"), "ends_before_begin"))


def split_valid(det: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Rows that the interval operators can take, and the rest with a ``reason``."""
    reason = reject_reason()
    # the same condition as a conjunction, which reaches the scan
    ok = (F.col("video_id").isNotNull() & F.col("ad_seat_b_time").isNotNull() & F.col("ad_seat_e_time").isNotNull()
          & (F.col("ad_seat_e_time") >= F.col("ad_seat_b_time")))
    return det.where(ok), det.withColumn("reason", reason).where(F.col("reason").isNotNull())


def labelled(det: DataFrame) -> DataFrame:
    """Rows with a label, for operators that group by it."""
    return det.where(F.col("class3_name").isNotNull())


#: Why a row, or a part of its use, is missing from the clips.
REASONS = ("null_video", "null_offset", "ends_before_begin", "unknown_class", "null_label", "unknown_type", "unknown_video")


def _reasons(known_video: Column | None = None) -> dict[str, Column]:
    """Condition of every reason, over ``label_detections(keep_unknown=True)``.

    A row is rejected for the first of its own faults, or else because its
    class is unknown.  Rows that are not rejected count under null label
    (rejected by single-label clips only), unknown label type (in no typed
    list) and unknown video (no document), whichever apply."""
    own = reject_reason()
    ok = own.isNull() & F.col("known_class")
    out = {r: F.coalesce(own == r, F.lit(False)) for r in REASONS[:3]}
    out["unknown_class"] = own.isNull() & ~F.col("known_class")
    out["null_label"] = ok & F.col("class3_name").isNull()
    out["unknown_type"] = ok & ~F.coalesce(F.col("class_type_id").isin(*P.KNOWN_TYPES), F.lit(False))
    if known_video is not None:
        out["unknown_video"] = ok & ~known_video
    return out


def rejected_counts(det: Mapping[str, DataFrame] | DataFrame, labels: DataFrame,
                    videos: DataFrame | None = None) -> DataFrame:
    """Data quality of the input: (reason, n_rows), see ``_reasons``; unknown
    videos only when ``videos`` is given."""
    narrow = label_detections(unify_sources(det), labels, keep_unknown=True)
    known = None
    if videos is not None:
        ids = videos.select(F.col("videoId").alias("video_id"), F.lit(True).alias("_video")).distinct()
        narrow = narrow.join(broadcast_checked(ids), "video_id", "left")
        known = F.coalesce("_video", F.lit(False))
    found = F.array(*(F.when(c, F.lit(r)) for r, c in _reasons(known).items()))
    return (narrow.select(F.explode(F.filter(found, lambda r: r.isNotNull())).alias("reason")).groupBy("reason")
            .agg(F.count(F.lit(1)).cast("bigint").alias("n_rows")))


def normalize(det: Mapping[str, DataFrame] | DataFrame, labels: DataFrame,
              rejects: Observation | None = None) -> DataFrame:
    """The narrow, valid detections (``rejected_counts`` counts the rest).

    With ``rejects``, the rows are counted per reason in the pass that reads
    them: after the caller's action ``rejects.get`` has a number for every
    reason but the unknown videos.  The filters then stand above the count and
    not in the scan.

    Detections of videos missing from the video table are dropped later, where
    it is cheapest: the per-video clip jobs join the video attributes (inner)
    once per clip, and the scene job checks the videos on the per-label screen
    times before ranking across videos.  So the raw detections are never
    shuffled for this check."""
    if rejects is None:
        return split_valid(label_detections(unify_sources(det), labels))[0]
    narrow = label_detections(unify_sources(det), labels, keep_unknown=True)
    counted = narrow.observe(rejects, *(F.count(F.when(c, F.lit(1))).alias(r) for r, c in _reasons().items()))
    return split_valid(counted.where("known_class").drop("known_class"))[0]


def enrich(det: Mapping[str, DataFrame] | DataFrame, labels: DataFrame, videos: DataFrame,
           with_release_date: bool = False) -> DataFrame:
    """J1 + J2 + P2: the full unified detection (11 columns in the reference
    order, plus ``detection_id`` and ``source``).

    The reference joins the video table a second time (J3); with a unique
    ``videoId`` that join changes nothing, so it is not repeated.
    """
    narrow = label_detections(unify_sources(det), labels)
    attrs = video_attributes(videos)
    extra = []
    if with_release_date:
        attrs = attrs.join(videos.groupBy(F.col("videoId").alias("video_id"))
                           .agg(F.min("releaseTime").alias("media_release_date")), "video_id")
        extra = ["media_release_date"]
    out = narrow.join(attrs, "video_id")
    return out.select(*schemas.UNIFIED_COLUMNS, *extra, "detection_id", "source")


def assert_unique_videos(videos: DataFrame) -> DataFrame:
    """J3 check: video ids that occur more than once (the reference would
    multiply their detections).  Returns the offending ids with their number of
    rows and of different rows; empty when clean."""
    return (videos.groupBy("videoId").agg(
        F.count(F.lit(1)).alias("n_rows"),
        F.count_distinct(F.struct(*videos.columns)).alias("n_different")).where(F.col("n_rows") > 1))


def pending(det: DataFrame, tasks: DataFrame) -> DataFrame:
    """S7 + P4 + J4: detections of videos with a pending task (semi join, so a
    duplicate task row never multiplies detections)."""
    return for_videos(det, pending_tasks(tasks))


def for_videos(det: DataFrame, video_ids: DataFrame | list[str]) -> DataFrame:
    """Detections of the requested videos (never string-built SQL).

    A list of ids becomes a filter that reaches the scan.  A DataFrame of
    ``video_id`` is broadcast after a row count check, so detections are
    filtered where they are read; a longer one is joined by a shuffle.

    That shuffle deals the detections by video and media time, and the ids to
    each of the slots.  Dealt by video alone, a hot video would be one task's,
    and every later step that groups by video and more would be planned into
    the same task, with the sorts of all of them, and once per kind of clip."""
    if not isinstance(video_ids, DataFrame):
        return det.where(F.col("video_id").isin(list(video_ids)))
    ids = video_ids.select("video_id").distinct()
    checked = broadcast_checked(ids)
    if checked is not ids or B not in det.columns:
        return det.join(checked, "video_id", "left_semi")
    slot = F.coalesce(F.pmod(F.floor(F.col(B) / P.BUCKET_MS), F.lit(VIDEO_SLOTS)), F.lit(0)).cast("int")
    slots = F.explode(F.sequence(F.lit(0), F.lit(VIDEO_SLOTS - 1))).alias("_slot")
    return (det.withColumn("_slot", slot).join(ids.select("video_id", slots), ["video_id", "_slot"], "left_semi")
            .drop("_slot"))


def exclude_suffix(det: DataFrame, videos: DataFrame, suffix: str = ".ts") -> DataFrame:
    """P8 + P10: drop detections of videos whose address ends with ``suffix``."""
    bad = playable_videos(videos).where(F.col("media_addr").endswith(F.lit(suffix))).select("video_id")
    return det.join(bad, "video_id", "left_anti")


def known_types(det: DataFrame, types=P.KNOWN_TYPES) -> DataFrame:
    """Label type in 1..4."""
    return det.where(F.col("class_type_id").isin(*types))
