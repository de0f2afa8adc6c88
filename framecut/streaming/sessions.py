"""Streaming sessions (I6 with ``reach='max'``) over a detection stream.

Media offsets are used as event time (``timestamp_millis(begin)``); each
detection keeps a session open until ``end + gap``.  The watermark is global
over the stream: detections that arrive after the watermark has passed them
are dropped as late, so recomputing whole pending videos (``pending``) stays
the default path; this is the low-latency alternative.
"""

from __future__ import annotations

from typing import Mapping

from pyspark.sql import DataFrame

from framecut.functions.intervals import media_time
from framecut.operators.normalize import normalize
from framecut.operators.sessions import EVENT_TIME, session_windows
from framecut.params import GAP_MS

B, E, ID = "ad_seat_b_time", "ad_seat_e_time", "detection_id"


def stream_detections(det: Mapping[str, DataFrame] | DataFrame, labels: DataFrame,
                      watermark: str = "1 minute") -> DataFrame:
    """S2 / U1 / J1 on a stream: the valid narrow detections of streaming
    detection tables, joined with the static label dimension (broadcast after
    its row-count check).  A detection that comes again, as when a file is
    delivered twice, is dropped: one row per (source, detection_id) within the
    watermark, whose state Spark forgets behind it."""
    rows = normalize(det, labels).withColumn(EVENT_TIME, media_time(B))
    return rows.withWatermark(EVENT_TIME, watermark).dropDuplicatesWithinWatermark(["source", ID])


def stream_sessions(det: DataFrame, gap_ms: int = GAP_MS, watermark: str = "1 minute",
                    label: str = "class3_name") -> DataFrame:
    """Sessions per video from a streaming (or batch) DataFrame of narrow
    detections; append mode emits a session once the watermark passes it.
    Rows of ``stream_detections`` bring their event time and watermark along."""
    if EVENT_TIME not in det.columns:
        det = det.withColumn(EVENT_TIME, media_time(B)).withWatermark(EVENT_TIME, watermark)
    return session_windows(det, gap_ms, label)
