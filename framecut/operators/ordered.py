"""Ordered scans over media time that do not put a whole video's rows in one task.

A window ``partitionBy(video)`` would send every row of a hot video to one
task.  Here the rows of a group are cut into media-time buckets of
``width`` ms.  Row-level windows run per (group, bucket) and reduce the rows
of a bucket, in the same partitioning, to one row per local island; a second
step of the same kind runs per group over these few rows.  A local island
starts more than ``gap`` after the end before it, so their number is bounded
by media time.  The callers first reduce their input to one row per
(group, t) where copies can occur, so a bucket holds at most ``width`` of them.

Nothing is persisted, counted or joined back: a scan is one part of its
caller's plan, and building it starts no job.

All functions need the group keys and ``t`` to be non-null.
"""

from __future__ import annotations

from typing import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

#: A block of a level holds ``2 ** COVER_BITS`` blocks of the level below.
COVER_BITS = 2

BK = "_bk"
LOCAL = "_local"


def bucket_of(t: str | Column, width: int) -> Column:
    c = F.col(t) if isinstance(t, str) else t
    return F.floor(c / F.lit(width)).cast("bigint")


def with_head(df: DataFrame, keys: Sequence[str], t: str, end: str, gap: int | Column, reach: str, head: str) -> DataFrame:
    """Adds ``head``: the ``t`` of the first row of the island of each row
    (one window partition per combination of ``keys``)."""
    w = Window.partitionBy(*keys).orderBy(t)
    prev = (F.lag(end).over(w) if reach == "last"
            else F.max(end).over(w.rowsBetween(Window.unboundedPreceding, -1)))
    d = df.withColumn("_brk", prev.isNull() | (F.col(t) - prev > gap))
    upto_here = w.rowsBetween(Window.unboundedPreceding, 0)
    return d.withColumn(head, F.max(F.when(F.col("_brk"), F.col(t))).over(upto_here)).drop("_brk")


def islands(df: DataFrame, keys: Sequence[str], t: str, end: str, gap: int | Column, reach: str, width: int,
            partial: Sequence[Column], final: Sequence[Column], head: str = "head") -> DataFrame:
    """Gaps and islands, folded: one row (keys, ``head``, ``final``) per
    island; ``head`` is the ``t`` of its first row.

    ``reach='last'``: a row opens an island when it is the first of its group
    or ``t - end(previous row) > gap``.
    ``reach='max'``: ... or ``t - max(end of all earlier rows) > gap``.
    Both boundaries are inclusive: a gap of exactly ``gap`` still joins.

    ``partial`` aggregates the rows of a local island; ``final`` aggregates
    those results, with ``_local`` (the local island's first ``t``) as their
    order.  Rows may share a ``t`` when their order cannot matter: with
    ``reach='max'`` (if end >= t), or when ``end`` is ``t`` itself.
    """
    local = local_islands(df, keys, t, end, gap, reach, width, partial)
    return fold_islands(local, keys, gap, reach, final, head)


def local_islands(df: DataFrame, keys: Sequence[str], t: str, end: str, gap: int | Column, reach: str, width: int,
                  partial: Sequence[Column]) -> DataFrame:
    """The first step of ``islands``: one row (keys, bucket, ``_local``,
    ``_lend``, ``partial``) per island of a bucket.  A bucket's rows depend on
    the bucket's input only, so they can be stored and replaced by bucket."""
    if reach not in ("last", "max"):
        raise ValueError(f"reach must be 'last' or 'max', not {reach!r}")
    keys = list(keys)
    rows = with_head(df.withColumn(BK, bucket_of(t, width)), [*keys, BK], t, end, gap, reach, LOCAL)
    return rows.groupBy(*keys, BK, LOCAL).agg(
        (F.max_by(end, t) if reach == "last" else F.max(end)).alias("_lend"), *partial)


def fold_islands(local: DataFrame, keys: Sequence[str], gap: int | Column, reach: str, final: Sequence[Column],
                 head: str = "head") -> DataFrame:
    """The second step of ``islands``: islands of a group from those of its buckets."""
    keys = list(keys)
    return with_head(local, keys, LOCAL, "_lend", gap, reach, head).groupBy(*keys, head).agg(*final)


def bucket_span(b: str, e: str, width: int) -> Column:
    """The buckets an interval [b, e] touches, as an array (for range joins)."""
    return F.sequence(bucket_of(b, width), bucket_of(e, width))


def _shift(name: str, x: Column, bits: Column) -> Column:
    return F.call_function(name, x, bits)


def block_cover(b: str, e: str, width: int) -> Column:
    """The buckets an interval [b, e] touches as few aligned blocks: an array
    of (level, block), where a block holds ``2 ** COVER_BITS`` blocks of the
    level below.  Every bucket lies in exactly one of them.  At most
    ``2 * (2 ** COVER_BITS - 1)`` blocks a level, whatever the length."""
    lo, hi = bucket_of(b, width), bucket_of(e, width)

    def full(level: Column) -> tuple[Column, Column]:
        """First and last block of a level that lies inside lo..hi."""
        bits = level * COVER_BITS
        size = _shift("shiftleft", F.lit(1).cast("bigint"), bits)
        return _shift("shiftright", lo + size - 1, bits), _shift("shiftright", hi + 1, bits) - 1

    def run(first: Column, last: Column) -> Column:
        return F.when(first <= last, F.sequence(first, last)).otherwise(F.array().cast("array<bigint>"))

    def of_level(level: Column) -> Column:
        (first, last), (above, top) = full(level), full(level + 1)
        outside = F.concat(run(first, F.shiftleft(above, COVER_BITS) - 1), run(F.shiftleft(top + 1, COVER_BITS), last))
        return F.transform(F.when(above <= top, outside).otherwise(run(first, last)),
                           lambda k: F.struct(level.alias("level"), k.alias("block")))

    return F.flatten(F.transform(F.sequence(F.lit(0), highest_level(b, e, width)), of_level))


def highest_level(b: str, e: str, width: int) -> Column:
    """The highest level at which ``block_cover`` of [b, e] can have a block."""
    buckets = bucket_of(e, width) - bucket_of(b, width) + 1
    return F.floor((F.length(F.bin(buckets)) - 1) / COVER_BITS).cast("int")


def block_of(t: str, width: int, level: str) -> Column:
    """The block of a level that holds the bucket of ``t``."""
    return _shift("shiftright", bucket_of(t, width), F.col(level) * COVER_BITS)
