"""Interval column expressions on ms offsets."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


#: Event time of media offset 0, in ms since 1970.
MEDIA_EPOCH_MS = 1_000_000_000_000


def _c(x: str | Column) -> Column:
    return F.col(x) if isinstance(x, str) else x


def padded_begin(b: str | Column, pad_ms: int) -> Column:
    """``max(0, b - pad)``."""
    return F.greatest(_c(b) - F.lit(pad_ms), F.lit(0).cast("bigint"))


def padded_end(e: str | Column, pad_ms: int) -> Column:
    return _c(e) + F.lit(pad_ms)


def duration(b: str | Column, e: str | Column) -> Column:
    """Length in ms."""
    return _c(e) - _c(b)


def range_label(b: str | Column, e: str | Column) -> Column:
    """``"begin_end"``."""
    return F.concat_ws("_", _c(b).cast("string"), _c(e).cast("string"))


def media_time(b: str | Column) -> Column:
    """A media offset in ms used as event time (streaming sessions).  Offset 0
    lies ``MEDIA_EPOCH_MS`` after 1970, where a stream's watermark begins: an
    event time at or before it would be late from the start, and begins may be
    0 or negative."""
    return F.timestamp_millis(_c(b) + F.lit(MEDIA_EPOCH_MS))


def gap_interval(b: str | Column, e: str | Column, gap_ms: int) -> Column:
    """Per-row session gap ``end - begin + gap`` as an interval string for
    ``session_window``."""
    return F.concat((_c(e) - _c(b) + F.lit(gap_ms)).cast("string"), F.lit(" milliseconds"))
