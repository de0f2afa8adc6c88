"""Clip documents, and a stable clip id.

Every document is built from one ``members`` array per clip: the detections
(or merged intervals) of the clip as structs ``(b, i, t, n, n2, img)`` =
(begin, detection_id, label type, level-3 label, level-2 label, image),
sorted by (begin, detection_id).  Lists keep duplicates and null elements;
field names are the reference's, including the spelling ``sence``.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from framecut import params as P
from framecut.functions.intervals import duration, range_label
from framecut.functions.lists import field, label_to_image, typed
from framecut.operators.normalize import video_attributes

B, E, ID = "ad_seat_b_time", "ad_seat_e_time", "detection_id"

TYPED_ORDER = ("4", "1", "3", "2")  # man, object, action, sence


def member_struct() -> Column:
    return F.struct(F.col(B).alias("b"), F.col(ID).alias("i"), F.col("class_type_id").alias("t"),
                    F.col("class3_name").alias("n"), F.col("class2_name").alias("n2"),
                    F.col("ad_seat_img").alias("img"))


_field, _typed, _label_to_img = field, typed, label_to_image


def _header(b: str, e: str) -> list[Column]:
    return [
        F.col("video_id").alias("string_vid"),
        F.col("media_name"),
        F.col("drama_name").alias("string_drama_name"),
        F.col("drama_type_name").alias("string_drama_type_name"),
        F.col("media_area_name").alias("string_media_area_name"),
        range_label(b, e).alias("string_time"),
    ]


def _typed_lists(members: Column, with_level2_and_img: bool = False) -> list[Column]:
    cols = [_typed(members, c).alias(f"string_{P.TYPED_LIST_NAMES[c]}_list") for c in TYPED_ORDER]
    if with_level2_and_img:
        cols += [_typed(members, c, "n2").alias(f"string_{P.TYPED_LIST_NAMES[c]}2_list") for c in TYPED_ORDER]
        cols += [_typed(members, c, "img").alias(f"string_{P.TYPED_LIST_NAMES[c]}_img_list") for c in TYPED_ORDER]
    return cols


def with_video(clips: DataFrame, videos: DataFrame) -> DataFrame:
    """The video-level fields, joined once per clip."""
    return clips.join(video_attributes(videos), "video_id")


def single_documents(clips: DataFrame, videos: DataFrame, typed: bool = False) -> DataFrame:
    """D1 (``typed=False``) / D2: one document per clip row with columns
    video_id, begin, end and ``members``."""
    c = with_video(clips, videos)
    m = F.col("members")
    cols = _header(B, E) + [
        duration(B, E).cast("string").alias("string_time_long"),
        _field(m, "n").alias("string_class3_list"),
    ]
    if typed:
        cols += _typed_lists(m)
    cols += [
        _field(m, "n2").alias("string_class2_list"),
        _field(m, "img").alias("string_class_img_list"),
        _label_to_img(m).alias("string_class3_to_img"),
        _field(m, "img").alias("string_frame_img_list"),
    ]
    if typed:
        cols.append(F.lit(P.RESOURCE_VIDEO).alias("resourceId"))
    return c.select(*cols)


def multi_documents(clusters: DataFrame, videos: DataFrame, version: int = 2) -> DataFrame:
    """D3 (v1: per type level-3, level-2 and image lists), D4 (v2: unified
    lists) and D5 (v3: unified + typed level-3 lists) from clusters with
    video_id, begin, end and ``members``."""
    c = with_video(clusters, videos)
    m = F.col("members")
    cols = _header(B, E) + [duration(B, E).cast("string").alias("string_time_long")]
    if version == 1:
        cols += _typed_lists(m, with_level2_and_img=True)
    elif version in (2, 3):
        cols.append(_field(m, "n").alias("string_class3_list"))
        if version == 3:
            cols += _typed_lists(m)
        cols += [_field(m, "n2").alias("string_class2_list"),
                 _field(m, "img").alias("string_class_img_list"),
                 F.lit(P.RESOURCE_VIDEO).alias("resourceId")]
    else:
        raise ValueError("version must be 1, 2 or 3")
    return c.select(*cols)


def scene_documents(folded: DataFrame, videos: DataFrame, tagged: bool = False) -> DataFrame:
    """D6 / D7 (``tagged``: with ``resourceId='2'``) from ``fold_scene``."""
    c = with_video(folded, videos)
    tags = F.col("tags")
    cols = _header("story_start", "story_end") + [
        duration("story_start", "story_end").cast("string").alias("string_long"),
        F.transform(tags, lambda x: x["n"]).alias("string_class3_list"),
    ]
    cols += [F.transform(F.filter(tags, lambda x: x["t"] == F.lit(code)), lambda x: x["n"])
             .alias(f"string_{P.TYPED_LIST_NAMES[code]}_list") for code in TYPED_ORDER]
    cols += [F.col("class2s").alias("string_class2_list"), F.col("imgs").alias("string_class_img_list")]
    if tagged:
        cols.append(F.lit(P.RESOURCE_SCENE).alias("resourceId"))
    return c.select(*cols)


def with_clip_id(docs: DataFrame, kind: str | Column) -> DataFrame:
    """K1: a stable id, so that writing the same clip twice can be detected:
    sha2 of kind, video, time range and the level-3 labels."""
    k = F.lit(kind) if isinstance(kind, str) else kind
    lists = (["string_class3_list"] if "string_class3_list" in docs.columns
             else [f"string_{P.TYPED_LIST_NAMES[c]}_list" for c in TYPED_ORDER])  # D3 has typed lists only
    labels = [F.coalesce(F.array_join(c, "\x1e"), F.lit("")) for c in lists]
    key = F.concat_ws("\x1f", k, F.col("string_vid"), F.col("string_time"), *labels)
    return docs.withColumn("clip_id", F.sha2(key, 256))


def to_json_lines(docs: DataFrame) -> DataFrame:
    """one JSON text per document (null scalars left out, null list
    elements kept)."""
    return docs.select(F.to_json(F.struct(*docs.columns)).alias("json"))
