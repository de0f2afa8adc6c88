"""Inputs derived from the driver's test tables (see FIXTURES.md section 3).

One user is a video, one event a detection, one second since 2024-01-01
counts as one millisecond of media time and ``value * 1000`` is the length
in ms.  Event types are the labels.  Every input is computed by Spark from
the test tables, so its size follows theirs.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from framecut import schemas
from framecut.sources.tables import (Inputs, detection_scan, label_scan, scene_scan,
                                     task_scan, video_scan)

# --- fixed values (fixture definition) --------------------------------------
EPOCH = "2024-01-01 00:00:00"
EVENT_TYPE_CLASS = [("click", 1), ("error", 2), ("purchase", 3), ("signup", 4)]
OTHER_CLASS = 5
# class_id, class_type, class1_name, class2_name
LABEL_ROWS = [
    (1, "1", "thing", "click"),
    (2, "2", "place", "error"),
    (3, "3", "deed", "purchase"),
    (4, "4", "person", "signup"),
    (5, "1", "thing", "view"),
]
SOURCE_BY_ID_MOD4 = ["behavior", "face", "object", "scene"]
SCENE_MS = 432_000
SCENES_PER_VIDEO = 6
# -----------------------------------------------------------------------------


_TABLES: dict[tuple[int, str], DataFrame] = {}


def _table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """The test table, read (file listing, footers) once per session, like
    a table registered in a catalog; the returned DataFrame is a lazy plan,
    no data is cached."""
    path = f"{sf_dir.rstrip('/')}/{name}.parquet"
    key = (id(spark._jsparkSession), path)
    df = _TABLES.get(key)
    if df is None:
        df = _TABLES[key] = spark.read.parquet(path)
    return df


def _offset_ms(col: str = "ts"):
    return F.expr(f"timestampdiff(SECOND, TIMESTAMP_NTZ'{EPOCH}', {col})").cast("bigint")


def _class_id():
    expr = F.when(F.lit(False), F.lit(None))
    for name, cid in EVENT_TYPE_CLASS:
        expr = expr.when(F.col("event_type") == name, F.lit(cid))
    return expr.otherwise(F.lit(OTHER_CLASS)).cast("bigint")


def _source():
    m = F.col("event_id") % 4
    expr = F.when(m == 0, SOURCE_BY_ID_MOD4[0])
    for i in (1, 2):
        expr = expr.when(m == i, SOURCE_BY_ID_MOD4[i])
    return expr.otherwise(SOURCE_BY_ID_MOD4[3])


def detections(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All detections in one scan, with their ``source`` column."""
    ev = _table(spark, sf_dir, "events")
    start = _offset_ms("ts")
    return ev.select(
        F.col("user_id").cast("string").alias("media_id"),
        _class_id().alias("class_id"),
        start.alias("time_start"),
        (start + F.floor(F.col("value") * 1000).cast("bigint")).alias("time_end"),
        F.concat(F.lit("img_"), F.col("event_id").cast("string"), F.lit(".jpg")).alias("object_img"),
        F.col("event_id").cast("bigint").alias("detection_id"),
        _source().alias("source"),
    )


def detection_tables(spark: SparkSession, sf_dir: str) -> dict[str, DataFrame]:
    """The four detection tables of the reference layout (behavior, face,
    object, scene), each a filtered view of ``events``."""
    det = detections(spark, sf_dir)
    return {s: detection_scan(det.where(F.col("source") == s).drop("source"), s)
            for s in schemas.DETECTION_SOURCES}


def labels(spark: SparkSession) -> DataFrame:
    """The label dimension as an inline table: a local relation whose size
    Spark knows, so the join with the detections broadcasts it."""
    rows = ", ".join(f"({cid}, '{t}', '{c1}', '{c2}')" for cid, t, c1, c2 in LABEL_ROWS)
    cols = ", ".join(f.name for f in schemas.LABEL.fields)
    return label_scan(spark.sql(f"SELECT * FROM VALUES {rows} AS t({cols})"))


def videos(spark: SparkSession, sf_dir: str) -> DataFrame:
    c = _table(spark, sf_dir, "customer")
    n = _table(spark, sf_dir, "nation")
    key = F.col("c_custkey").cast("string")
    v = c.join(n, c.c_nationkey == n.n_nationkey).select(
        key.alias("videoId"),
        F.col("c_name").alias("videoName"),
        F.col("c_mktsegment").alias("category"),
        F.concat(F.lit("style_"), (F.col("c_custkey") % 3).cast("string")).alias("classify"),
        F.col("n_name").alias("area"),
        F.lit("2024").alias("releaseTime"),
        F.concat(F.lit("http://v/"), key,
                 F.when(F.col("c_custkey") % 7 == 0, F.lit(".ts")).otherwise(F.lit(".mp4"))).alias("originalUrl"),
    )
    return video_scan(v)


def scenes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Six scenes per video seen in the events, same bounds for every video."""
    ev = _table(spark, sf_dir, "events")
    v = ev.select(F.col("user_id").cast("string").alias("media_id")).distinct()
    k = F.explode(F.sequence(F.lit(0), F.lit(SCENES_PER_VIDEO - 1))).alias("k")
    s = v.select("media_id", k).select(
        "media_id",
        (F.col("k").cast("bigint") * SCENE_MS).alias("story_start"),
        ((F.col("k").cast("bigint") + 1) * SCENE_MS).alias("story_end"),
    )
    return scene_scan(s)


def tasks(spark: SparkSession, sf_dir: str) -> DataFrame:
    ev = _table(spark, sf_dir, "events")
    t = ev.select("user_id").distinct().select(
        F.col("user_id").cast("string").alias("video_id"),
        F.when(F.col("user_id") % 3 == 0, 1).otherwise(0).alias("status"),
    )
    return task_scan(t)


_INPUTS: dict[tuple[int, str], Inputs] = {}


def inputs(spark: SparkSession, sf_dir: str) -> Inputs:
    """The five derived inputs; built once per session and directory."""
    key = (id(spark._jsparkSession), sf_dir.rstrip("/"))
    if key not in _INPUTS:
        _INPUTS[key] = _build_inputs(spark, sf_dir)
    return _INPUTS[key]


def _build_inputs(spark: SparkSession, sf_dir: str) -> Inputs:
    return Inputs(
        detections=detections(spark, sf_dir),
        labels=labels(spark),
        videos=videos(spark, sf_dir),
        scenes=scenes(spark, sf_dir),
        tasks=tasks(spark, sf_dir),
    )
