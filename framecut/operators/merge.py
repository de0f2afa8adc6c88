"""Padding and merging detections of one label."""

from __future__ import annotations

from typing import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from framecut.functions.intervals import padded_begin, padded_end
from framecut.operators.ordered import LOCAL, fold_islands, local_islands
from framecut.params import BUCKET_MS

B, E, ID = "ad_seat_b_time", "ad_seat_e_time", "detection_id"
#: Stands for a null label while rows are grouped by it (no label holds a NUL).
NO_LABEL = "\u0000"
LABEL_KEYS = ("video_id", "class3_name")


def pad(df: DataFrame, pad_ms: int, b: str = B, e: str = E) -> DataFrame:
    """Widen by ``pad_ms`` on each side, begin floored at 0."""
    if not pad_ms:
        return df
    return df.withColumn(b, padded_begin(b, pad_ms)).withColumn(e, padded_end(e, pad_ms))


def merge_same_label(det: DataFrame, gap_ms: int | Column, pad_ms: int = 0, reach: str = "last",
                     keys: Sequence[str] = LABEL_KEYS, bucket_ms: int = BUCKET_MS) -> DataFrame:
    """I2 (``pad_ms=4000, gap_ms=0``) and I3 (``pad_ms=0, gap_ms=10000``).

    Rows of one (video, label) are taken in (begin, detection_id, source) order; a row
    joins the open interval when ``begin - reach <= gap``.  With
    ``reach='last'`` (the reference fold) the reach is the end of the previous
    row, and the merged end is the end of the last row; with ``reach='max'``
    it is the running maximum.  Begin = the first begin; the other attributes
    come from the first row.  ``n_detections`` counts the merged rows.
    """
    return fold_merge(local_merge(det, gap_ms, pad_ms, reach, keys, bucket_ms), gap_ms, reach, keys)


def local_merge(det: DataFrame, gap_ms: int | Column, pad_ms: int = 0, reach: str = "last",
                keys: Sequence[str] = LABEL_KEYS, bucket_ms: int = BUCKET_MS) -> DataFrame:
    """The merged intervals inside every media-time bucket, the input of ``fold_merge``."""
    keys = list(keys)
    x = pad(det, pad_ms)
    if "class3_name" in keys:  # rows without label are a group of their own
        x = x.withColumn("class3_name", F.coalesce("class3_name", F.lit(NO_LABEL)))
    by_id = F.struct(*(c for c in (ID, "source") if c in x.columns))
    attrs = [c for c in x.columns if c not in (*keys, B, E)]
    # one row per (group, begin): copies and equal begins are combined map-side;
    # inside such a tie no row can break (end >= begin, gap >= 0)
    g = x.groupBy(*keys, B).agg(
        F.min_by(F.struct(*attrs), by_id).alias("_row"),
        F.max_by(F.col(E), by_id).alias("_e_last"),
        F.max(E).alias("_e_max"),
        F.count(F.lit(1)).alias("_n"),
    )
    end = "_e_last" if reach == "last" else "_e_max"
    return local_islands(g, keys, B, end, gap_ms, reach, bucket_ms,
                         [F.min_by("_row", B).alias("_row"), F.sum("_n").alias("_n")])


def fold_merge(local: DataFrame, gap_ms: int | Column, reach: str = "last",
               keys: Sequence[str] = LABEL_KEYS) -> DataFrame:
    """Merged intervals of whole groups from those of their buckets."""
    merged = fold_islands(
        local, keys, gap_ms, reach, head="_head",
        final=[F.min_by("_row", LOCAL).alias("_row"),
               (F.max_by("_lend", LOCAL) if reach == "last" else F.max("_lend")).alias(E),
               F.sum("_n").alias("n_detections")])
    out = merged.select(*keys, F.col("_head").alias(B), E, "_row.*", "n_detections")
    return out.withColumn("class3_name", F.nullif("class3_name", F.lit(NO_LABEL))) if "class3_name" in keys else out


def merge_kinds(det: DataFrame, pad_ms: int, gap_ms: int, reach: str = "last",
                bucket_ms: int = BUCKET_MS) -> tuple[DataFrame, DataFrame]:
    """I1 + I2 and I3 in one ordered scan: (touching intervals of padded,
    labelled detections, near intervals of all detections).

    Every detection is read once and becomes a row per kind; kind is one of
    the scan's keys, padding and gap follow from it.  Both results hang on the
    same shuffled islands: they are told apart by ``_kind``, which comes out of
    the fold, so that no filter sinks below the exchange and makes it two."""
    single, multi = F.lit("single"), F.lit("multi")
    padded = F.struct(single.alias("kind"), padded_begin(B, pad_ms).alias(B), padded_end(E, pad_ms).alias(E))
    plain = F.struct(multi.alias("kind"), F.col(B).alias(B), F.col(E).alias(E))
    kinds = F.when(F.col("class3_name").isNull(), F.array(plain)).otherwise(F.array(padded, plain))
    rows = det.select(*(c for c in det.columns if c not in (B, E)), F.explode(kinds).alias("_k"))
    rows = rows.select("*", "_k.*").drop("_k").withColumn("_kind", F.col("kind"))
    merged = merge_same_label(rows, F.when(F.col("kind") == single, 0).otherwise(gap_ms), reach=reach,
                              keys=("kind", *LABEL_KEYS), bucket_ms=bucket_ms)
    return tuple(merged.where(F.col("_kind") == k).drop("kind", "_kind") for k in (single, multi))
