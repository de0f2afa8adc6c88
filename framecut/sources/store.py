"""A detection store laid out for rounds: by video and media-time slot.

Normalised detections lie in Parquet files partitioned by a hash of (video,
slot), sorted by video and begin inside a file.  The slot is the bucket of the
begin, 0 for negative begins.  A hot video is spread over the partitions by its
slots.  A round names the (video, slot) pairs it needs; the partitions they lie in, at most ``PARTS`` numbers, become a
partition filter of the scan, row-group statistics skip most of the rest, and
a semi join keeps the pairs themselves.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from framecut.operators.normalize import broadcast_checked
from framecut.operators.ordered import bucket_of
from framecut.params import BUCKET_MS

B = "ad_seat_b_time"
#: Partitions of a store.
PARTS = 64
PART, SLOT = "_part", "_slot"


def slot_of(t: str | Column, bucket_ms: int = BUCKET_MS) -> Column:
    return F.greatest(bucket_of(t, bucket_ms), F.lit(0))


def _part(parts: int) -> Column:
    return F.pmod(F.xxhash64("video_id", SLOT), F.lit(parts)).cast("int")


def slots_of(det: DataFrame, bucket_ms: int = BUCKET_MS) -> DataFrame:
    """The distinct (video_id, ``_slot``) that detections lie in."""
    return det.select("video_id", slot_of(B, bucket_ms).alias(SLOT)).distinct()


def append_detections(det: DataFrame, path: str, bucket_ms: int = BUCKET_MS, parts: int = PARTS) -> None:
    """Add normalised detections to the store."""
    placed = det.withColumn(SLOT, slot_of(B, bucket_ms)).withColumn(PART, _part(parts))
    (placed.repartition(PART).sortWithinPartitions(PART, "video_id", B)
     .write.mode("append").partitionBy(PART).parquet(path))


def read_slots(spark: SparkSession, path: str, slots: DataFrame, parts: int = PARTS) -> DataFrame:
    """The stored detections of (video_id, ``_slot``) pairs, without the columns of the layout."""
    wanted = slots.select("video_id", SLOT).distinct().withColumn(PART, _part(parts))
    named = sorted(r[0] for r in wanted.select(PART).distinct().collect())  # at most ``parts`` numbers
    stored = spark.read.parquet(path).where(F.col(PART).isin(named))
    return stored.join(broadcast_checked(wanted), ["video_id", SLOT, PART], "left_semi").drop(SLOT, PART)
