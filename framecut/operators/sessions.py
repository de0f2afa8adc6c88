"""Cluster all labels of a video into sessions.

Rows are taken in (begin, detection_id) order.  A cluster is opened by a row
with reach := its end; the next row joins when ``begin - reach <= gap``.

* ``reach='last'`` (reference): on a join, reach := max(begin, reach).  So the
  ends of later members never hold the cluster open; only the end of the
  cluster's first row and the begins count.  This is computed in steps that
  share one shuffle by video: runs (``begin - previous begin <= gap`` always
  joins); chains of runs (a run head beyond every earlier head's end opens a
  cluster whatever happened before); and inside a chain a fold over its heads:
  a head joins the open cluster when ``head.begin - first.end <= gap``.  A
  chain is a stretch that heads' ends overlap without a break, as a rule one
  run; only its heads are folded, and clusters are slices of it.
* ``reach='max'``: reach is the running max of the ends (plain islands).
* ``session_window``: the same clusters as ``'max'`` with Spark's session
  window and a per-row gap of ``end - begin + gap``; this is the form that
  also runs on a stream.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from framecut.functions.intervals import gap_interval, media_time
from framecut.operators.ordered import islands, with_head
from framecut.params import BUCKET_MS

B, E, ID = "ad_seat_b_time", "ad_seat_e_time", "detection_id"
START = "cluster_start"
#: Media time as event time.
EVENT_TIME = "_ts"


def _clusters(runs: DataFrame, gap_ms: int) -> DataFrame:
    """The clusters of ``reach='last'`` from runs (video_id, _run, _items)."""
    # the end that counts for a head is the one of its first row
    heads = runs.withColumn("_e_first", F.array_min("_items")["e"])
    chains = (with_head(heads, ["video_id"], "_run", "_e_first", gap_ms, "max", "_chain")
              .groupBy("video_id", "_chain").agg(F.array_sort(F.collect_list(F.struct(
                  F.col("_run").alias("b"), F.col("_e_first").alias("e"), F.col("_items").alias("items")))).alias("_hs")))
    start = F.struct(F.col("_chain").alias("b"), F.lit(1).alias("at"))
    init = F.struct(F.lit(None).cast("bigint").alias("reach"), F.lit(1).alias("at"),
                    F.array().cast("array<struct<b:bigint,at:int>>").alias("starts"))

    def step(acc, x):
        joins = acc["reach"].isNotNull() & (x["b"] - acc["reach"] <= F.lit(gap_ms))
        opened = F.struct(x["b"].alias("b"), acc["at"].alias("at"))
        return F.struct(F.when(joins, acc["reach"]).otherwise(x["e"]).alias("reach"), (acc["at"] + 1).alias("at"),
                        F.when(joins, acc["starts"]).otherwise(F.array_append(acc["starts"], opened)).alias("starts"))

    folded = F.aggregate(F.transform("_hs", lambda h: F.struct(h["b"].alias("b"), h["e"].alias("e"))), init, step,
                         lambda acc: acc["starts"])
    begun = chains.withColumn("_starts", F.when(F.size("_hs") == 1, F.array(start)).otherwise(folded))
    after = F.slice(F.transform("_starts", lambda s: s["at"]), F.lit(2), F.size("_starts"))
    parts = begun.withColumn("_parts", F.arrays_zip(F.col("_starts").alias("s"), after.alias("next")))
    cluster = F.transform("_parts", lambda p: F.struct(
        p["s"]["b"].alias(START),
        F.flatten(F.transform(F.slice("_hs", p["s"]["at"], F.coalesce(p["next"], F.size("_hs") + 1) - p["s"]["at"]),
                              lambda h: h["items"])).alias("_items")))
    return parts.select("video_id", F.inline(cluster))


def sessions(m: DataFrame, gap_ms: int, reach: str = "last", member: Column | None = None,
             bucket_ms: int = BUCKET_MS) -> DataFrame:
    """One row per cluster of ``m`` (intervals with video_id, begin, end,
    detection_id; end >= begin): video_id, ``cluster_start`` (the begin of its
    first row), ``_items``: an array of (b, i, source, e, m), one per row, with
    ``member`` (default: all columns of ``m``) as ``m``.

    The rows of a local run travel as one list, so no row is joined back.
    Rows with equal begins never break among themselves here (the running max
    and the begin comparison do not depend on their order)."""
    if reach not in ("last", "max"):
        raise ValueError(f"reach must be 'last' or 'max', not {reach!r}")
    source = F.col("source") if "source" in m.columns else F.lit(None).cast("string")
    item = F.struct(F.col(B).alias("b"), F.col(ID).alias("i"), source.alias("source"), F.col(E).alias("e"),
                    (F.struct(*m.columns) if member is None else member).alias("m"))
    x = m.select("video_id", F.col(B).alias("_b"), F.col(E).alias("_e"), item.alias("_item"))
    end, head = ("_b", "_run") if reach == "last" else ("_e", START)
    runs = islands(x, ["video_id"], "_b", end, gap_ms, reach, bucket_ms, head=head,
                   partial=[F.collect_list("_item").alias("_items")],
                   final=[F.flatten(F.collect_list("_items")).alias("_items")])
    if reach == "max":
        return runs
    return _clusters(runs, gap_ms)


def assign_sessions(m: DataFrame, gap_ms: int, reach: str = "last",
                    bucket_ms: int = BUCKET_MS) -> DataFrame:
    """The rows of ``m`` with the ``cluster_start`` of their cluster."""
    return (sessions(m, gap_ms, reach, None, bucket_ms)
            .select(START, F.explode("_items").alias("_item")).select("_item.m.*", START))


def cluster_bounds() -> list[Column]:
    """Begin and end of a cluster, from its items."""
    return [F.array_min(F.transform("_items", lambda x: x["b"])), F.array_max(F.transform("_items", lambda x: x["e"]))]


def cluster_members() -> Column:
    """The members of a cluster in their order."""
    return F.array_sort(F.transform("_items", lambda x: x["m"]))


def _members(label: str):
    return F.array_sort(F.collect_list(F.struct(F.col(B).alias("b"), F.col(ID).alias("i"),
                                                F.col(label).alias("v"))))


def session_window_summary(m: DataFrame, gap_ms: int, label: str = "class3_name") -> DataFrame:
    """``reach='max'`` clusters through ``session_window`` on media time used
    as event time: each row spans [begin, end + gap).  Same output as
    ``session_summary``; Spark merges sessions partially before the shuffle,
    but the partial groups are keyed by each row's own window, so a video's
    sessions merge in one task; batch jobs use the bucketed ``reach='max'``."""
    return session_windows(m.withColumn(EVENT_TIME, media_time(B)), gap_ms, label)


def session_windows(m: DataFrame, gap_ms: int, label: str = "class3_name") -> DataFrame:
    """The sessions of batch or streaming rows that have their ``EVENT_TIME``."""
    return (m.groupBy("video_id", F.session_window(EVENT_TIME, gap_interval(B, E, gap_ms)).alias("_sw"))
            .agg(F.min(B).alias("cluster_b"), F.max(E).alias("cluster_e"),
                 F.count(F.lit(1)).cast("bigint").alias("n_members"),
                 F.concat_ws("|", F.transform(_members(label), lambda x: x["v"])).alias("labels"))
            .drop("_sw"))


def session_summary(m: DataFrame, gap_ms: int, reach: str = "last", label: str = "class3_name",
                    bucket_ms: int = BUCKET_MS) -> DataFrame:
    """One row per cluster: begin, end, member count and the member labels in
    (begin, detection_id) order."""
    member = F.struct(F.col(B).alias("b"), F.col(ID).alias("i"), F.col(label).alias("v"))
    begin, end = cluster_bounds()
    return sessions(m, gap_ms, reach, member, bucket_ms).select(
        "video_id", begin.alias("cluster_b"), end.alias("cluster_e"),
        F.size("_items").cast("bigint").alias("n_members"),
        F.concat_ws("|", F.transform(cluster_members(), lambda x: x["v"])).alias("labels"))
