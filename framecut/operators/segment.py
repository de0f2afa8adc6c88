"""Sweep segmentation.

Cut the media time of a group (by default a video) at every begin and end;
each fragment between two consecutive cut points carries the intervals
active over all of it.  Fragments with nothing active (gaps) and zero-length
fragments are not produced.

Spark form: an interval becomes one row per media-time bucket it touches and
sees the cut points of that bucket (window per group and bucket); what the
last fragment of a bucket runs on to is the first cut point of a later bucket
that the interval touches (window per group, begin and end).  The intervals
are read once and joined with nothing.
"""

from __future__ import annotations

from typing import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from framecut.operators.ordered import bucket_of, bucket_span
from framecut.params import BUCKET_MS

B, E = "ad_seat_b_time", "ad_seat_e_time"


def segment(iv: DataFrame, by: Sequence[str] = ("video_id",), bucket_ms: int = BUCKET_MS) -> DataFrame:
    """Fragment x active interval: one row per fragment and interval that
    covers it (``begin <= frag_b and end >= frag_e``), with all interval
    columns kept.  An interval without length cuts but covers nothing.

    Intervals with the same begin and end see the same cut points, so the
    second window needs no identity of a row, and copies keep their number.  A
    window partition of the first holds the intervals that touch a bucket:
    after merging at most labels x (bucket / gap + 1)."""
    by = list(by)
    touched = iv.withColumn("_bk", F.explode(bucket_span(B, E, bucket_ms)))
    cuts = F.filter(F.array(B, E), lambda t: bucket_of(t, bucket_ms) == F.col("_bk"))
    seen = F.collect_set(cuts).over(Window.partitionBy(*by, "_bk"))
    own = F.array_sort(F.filter(F.array_distinct(F.flatten("_seen")), lambda t: t.between(F.col(B), F.col(E))))
    pieces = touched.withColumn("_seen", seen).withColumn("_at", own).drop("_seen")
    later = Window.partitionBy(*by, B, E).orderBy(F.col("_bk").desc()).rangeBetween(Window.unboundedPreceding, -1)
    following = F.concat(F.slice("_at", F.lit(2), F.size("_at")), F.array("_then"))
    pairs = F.filter(F.arrays_zip(F.col("_at").alias("frag_b"), F.col("_next").alias("frag_e")),
                     lambda f: f["frag_b"].isNotNull() & f["frag_e"].isNotNull())
    return (pieces.withColumn("_then", F.min(F.get("_at", F.lit(0))).over(later))
            .withColumn("_next", following)
            .select(*by, F.inline(pairs), *(c for c in iv.columns if c not in by)))
