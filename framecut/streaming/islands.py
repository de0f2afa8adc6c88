"""I2 / I3 in rounds: merged intervals from stored islands of media-time buckets.

Merging runs in two steps: islands inside a bucket, then islands of a
(video, label) from its buckets' islands.  The result of the first step is
kept as a table, replaced by (video, slot of media time).  A round with new
detections

1. appends them to the detection store,
2. reads the stored detections of the slots they touch, and of no others,
3. publishes the islands of those slots anew.

The merged intervals are folded from the stored islands, a few rows a video.
A late detection that joins two stored islands is found like any other: its
bucket is recomputed, and the fold sees the new ends.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from framecut.operators.merge import LABEL_KEYS, fold_merge, local_merge
from framecut.operators.normalize import for_videos
from framecut.operators.ordered import BK
from framecut.params import BUCKET_MS
from framecut.sources.sinks import current, next_round, publish, write_version
from framecut.sources.store import SLOT, append_detections, read_slots, slots_of


def add_detections(new: DataFrame, store: str, gap_ms: int, pad_ms: int = 0, reach: str = "last",
                   bucket_ms: int = BUCKET_MS) -> None:
    """One round: ``new`` (normalised detections) joins the store, and the
    islands of the slots it touches are published.  ``gap_ms``, ``pad_ms``,
    ``reach`` and ``bucket_ms`` belong to the store and stay the same.

    A round that fails before it publishes leaves the islands as they were;
    repeat it with ``refresh`` for the same detections, which are stored."""
    append_detections(new, f"{store}/detections", bucket_ms)
    refresh(slots_of(new, bucket_ms), store, gap_ms, pad_ms, reach, bucket_ms)


def refresh(slots: DataFrame, store: str, gap_ms: int, pad_ms: int = 0, reach: str = "last",
            bucket_ms: int = BUCKET_MS) -> None:
    """Publish the islands of (video_id, ``_slot``) pairs from the stored detections.

    Padding moves a begin to an earlier slot, by ``pad_ms`` at most: the slots
    that far before are published too, and what lies that far after is read."""
    spark, islands = slots.sparkSession, f"{store}/islands"
    far = -(-pad_ms // bucket_ms)
    slot = F.col(SLOT)
    replaced = slots.select("video_id", F.explode(
        F.sequence(F.greatest(slot - far, F.lit(0)), slot)).alias(SLOT)).distinct()
    read = replaced.select("video_id", F.explode(F.sequence(slot, slot + far)).alias(SLOT))
    local = local_merge(read_slots(spark, f"{store}/detections", read), gap_ms, pad_ms, reach, LABEL_KEYS, bucket_ms)
    local = local.withColumn(SLOT, F.greatest(BK, F.lit(0)))
    this = next_round(spark, islands)
    write_version(local.join(replaced, ["video_id", SLOT], "left_semi"), islands, this)
    publish(replaced, islands, this)


def merged_intervals(spark: SparkSession, store: str, gap_ms: int, reach: str = "last",
                     video_ids: DataFrame | list[str] | None = None) -> DataFrame:
    """The merged intervals of all detections added so far, as ``merge_same_label`` gives them."""
    local = current(spark, f"{store}/islands")
    if local is None:
        raise FileNotFoundError(f"no detections were added at {store}")
    local = local.drop(SLOT)
    return fold_merge(for_videos(local, video_ids) if video_ids is not None else local, gap_ms, reach)
