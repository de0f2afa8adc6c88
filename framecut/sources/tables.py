"""Readers for the five inputs: detections, labels, videos, scenes, tasks.

Connection options always come from the caller; nothing is read from files
in this package.  JDBC reads are partitioned when the caller names a numeric
column and its bounds, so a large table is read by many tasks instead of one.
"""

from __future__ import annotations

from dataclasses import dataclass
from typing import Mapping

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from framecut import schemas


@dataclass
class Inputs:
    """Everything the clip jobs read.  ``scenes`` and ``tasks`` are optional."""

    detections: DataFrame
    labels: DataFrame
    videos: DataFrame
    scenes: DataFrame | None = None
    tasks: DataFrame | None = None


def read_jdbc(spark: SparkSession, url: str, table: str, *, user: str | None = None,
              password: str | None = None, driver: str | None = None,
              partition_column: str | None = None, lower_bound: int | None = None,
              upper_bound: int | None = None, num_partitions: int | None = None,
              fetch_size: int = 10_000, extra: Mapping[str, str] | None = None) -> DataFrame:
    """A table over JDBC.  With ``partition_column`` the scan is split into
    ``num_partitions`` range reads; filters and projections are pushed to the
    database by Spark."""
    r = spark.read.format("jdbc").option("url", url).option("dbtable", table)
    r = r.option("fetchsize", str(fetch_size))
    for k, v in (("user", user), ("password", password), ("driver", driver)):
        if v is not None:
            r = r.option(k, v)
    if partition_column is not None:
        if None in (lower_bound, upper_bound, num_partitions):
            raise ValueError("partitioned JDBC read needs lower_bound, upper_bound, num_partitions")
        r = (r.option("partitionColumn", partition_column)
             .option("lowerBound", str(lower_bound))
             .option("upperBound", str(upper_bound))
             .option("numPartitions", str(num_partitions)))
    for k, v in (extra or {}).items():
        r = r.option(k, v)
    return r.load()


def read_table(spark: SparkSession, path: str, fmt: str = "parquet",
               options: Mapping[str, str] | None = None) -> DataFrame:
    """Any file-based batch source (parquet, orc, json, csv...)."""
    return spark.read.format(fmt).options(**(options or {})).load(path)


def row_id(df: DataFrame) -> Column:
    """The numeric ``detection_id``; for text ids, null ids and tables without
    the column a hash of the row, so that an order by it is never null."""
    given = F.col("detection_id").cast("string") if "detection_id" in df.columns else F.lit(None).cast("string")
    return F.coalesce(given.try_cast("bigint"), F.xxhash64(
        given, *(F.col(c).cast("string") for c in ("media_id", "class_id", "time_start", "time_end", "object_img"))))


def detection_scan(df: DataFrame, source: str) -> DataFrame:
    """Project one detection table to the common columns, cast the
    offsets once (``try_cast``: bad text becomes null and is rejected later)
    and tag it with its source."""
    cols = [
        F.col("media_id").cast("string").alias("media_id"),
        F.col("class_id").try_cast("bigint").alias("class_id"),
        F.col("time_start").try_cast("bigint").alias("time_start"),
        F.col("time_end").try_cast("bigint").alias("time_end"),
        F.col("object_img").cast("string").alias("object_img"),
        row_id(df).alias("detection_id"),
        F.lit(source).alias("source"),
    ]
    return df.select(*cols)


def label_scan(df: DataFrame) -> DataFrame:
    """S3: the label dimension."""
    return df.select(
        F.col("class_id").cast("bigint").alias("class_id"),
        F.col("class_type").cast("string").alias("class_type"),
        F.col("class1_name").cast("string").alias("class1_name"),
        F.col("class2_name").cast("string").alias("class2_name"),
    )


def video_scan(df: DataFrame) -> DataFrame:
    """The video dimension."""
    schemas.check_columns(df, schemas.VIDEO, "videos")
    return df.select(*[F.col(f.name).cast("string").alias(f.name) for f in schemas.VIDEO.fields])


def playable_videos(videos: DataFrame) -> DataFrame:
    """``videoId as video_id, originalUrl as media_addr`` (read once, from
    the same video DataFrame)."""
    return videos.select(F.col("videoId").alias("video_id"), F.col("originalUrl").alias("media_addr"))


def scene_scan(df: DataFrame) -> DataFrame:
    """Scene intervals, several per video."""
    return df.select(
        F.col("media_id").cast("string").alias("media_id"),
        F.col("story_start").try_cast("bigint").alias("story_start"),
        F.col("story_end").try_cast("bigint").alias("story_end"),
    )


def task_scan(df: DataFrame) -> DataFrame:
    return df.select(F.col("video_id").cast("string").alias("video_id"),
                     F.col("status").cast("int").alias("status"))


def pending_tasks(tasks: DataFrame) -> DataFrame:
    """``status = 0``; on a JDBC source the predicate is pushed down."""
    return tasks.where(F.col("status") == 0)
