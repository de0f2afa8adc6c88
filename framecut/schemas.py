"""Input and output schemas.

Times are media offsets in whole milliseconds (``bigint``); every other
dimension attribute is a string, as in the source tables.
"""

from __future__ import annotations

from pyspark.sql import types as T

DETECTION = T.StructType([
    T.StructField("media_id", T.StringType()),
    T.StructField("class_id", T.LongType()),
    T.StructField("time_start", T.LongType()),
    T.StructField("time_end", T.LongType()),
    T.StructField("object_img", T.StringType()),
    # total order of detections and tie-break everywhere
    T.StructField("detection_id", T.LongType()),
    # behavior / face / object / scene
    T.StructField("source", T.StringType()),
])

LABEL = T.StructType([
    T.StructField("class_id", T.LongType()),
    T.StructField("class_type", T.StringType()),
    T.StructField("class1_name", T.StringType()),
    T.StructField("class2_name", T.StringType()),
])

VIDEO = T.StructType([
    T.StructField("videoId", T.StringType()),
    T.StructField("videoName", T.StringType()),
    T.StructField("category", T.StringType()),
    T.StructField("classify", T.StringType()),
    T.StructField("area", T.StringType()),
    T.StructField("releaseTime", T.StringType()),
    T.StructField("originalUrl", T.StringType()),
])

SCENE = T.StructType([
    T.StructField("media_id", T.StringType()),
    T.StructField("story_start", T.LongType()),
    T.StructField("story_end", T.LongType()),
])

TASK = T.StructType([
    T.StructField("video_id", T.StringType()),
    T.StructField("status", T.IntegerType()),
])

DETECTION_SOURCES = ("behavior", "face", "object", "scene")

# The unified detection, in this column order.
UNIFIED_COLUMNS = (
    "video_id", "media_name", "drama_name", "drama_type_name", "media_area_name",
    "class2_name", "class_type_id", "class3_name", "ad_seat_b_time", "ad_seat_e_time",
    "ad_seat_img",
)

# Video attributes carried into documents.
VIDEO_ATTRS = ("media_name", "drama_name", "drama_type_name", "media_area_name")

# Narrow detection used by the clip operators: the video attributes are joined
# once per clip at the end instead of being carried through every shuffle.
NARROW_COLUMNS = (
    "video_id", "class2_name", "class_type_id", "class3_name",
    "ad_seat_b_time", "ad_seat_e_time", "ad_seat_img", "detection_id", "source",
)


def check_columns(df, schema: T.StructType, what: str) -> None:
    """Check by name that ``df`` has the columns of ``schema``."""
    missing = [f.name for f in schema.fields if f.name not in df.columns]
    if missing:
        raise ValueError(f"{what}: missing columns {missing}")
