"""I6 on a stream with ``reach='last'``: the clusters of the default session
fold, emitted as the watermark passes them.

``session_window`` cannot express this fold, because a member's end does not
keep a cluster open.  A stateful processor per video holds

* the rows that may still be overtaken by an earlier one (begin at or after
  the watermark),
* the open cluster: begin, end, reach and number of members, and its labels
  as a list state that is only appended to, so folding does not rewrite them.

A timer fires when the watermark has passed the earliest waiting row: rows
before the watermark are folded in the order of the batch fold.  Another one
fires when the watermark lies beyond the reach by more than the gap: no later
row can join, so the cluster is emitted and its state is dropped.

Every call of a state is a round trip to the JVM, and every column costs pandas
a conversion per video.  A row travels and waits as one JSON text, a cluster
leaves as one text; rows and labels are stored as one list element per batch,
and a timer's number of calls does not depend on how many it folds.

A video's state is one micro-batch, the watermark's delay and its open cluster.
Rows behind the watermark are dropped as late, as in ``stream_sessions``.
Clusters wait for the watermark: the last ones of a stream come out only when
a later detection (of any video) moves it.

A begin more than ``END_MS`` either side of 0 is no media offset.  One such
row would push the watermark past everything else and does not fit the
nanoseconds of pandas, so it is kept out before the watermark is taken (rows
that bring their watermark along have taken it already).
"""

from __future__ import annotations

import json
from contextlib import contextmanager
from itertools import groupby

import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StatefulProcessor

from framecut.functions.intervals import MEDIA_EPOCH_MS, media_time
from framecut.operators.sessions import EVENT_TIME
from framecut.params import GAP_MS

B, E, ID = "ad_seat_b_time", "ad_seat_e_time", "detection_id"
ROWS = "rows array<string>"
FIELDS = ("b", "e", "i", "source", "label")
OPEN = "b long, e long, reach long, n long"
#: 139 years in ms.
END_MS = 1 << 42
CLUSTER = "video_id string, cluster string"
STORE = "spark.sql.streaming.stateStore.providerClass"
ROCKSDB = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"


@contextmanager
def keyed_state(spark: SparkSession):
    """Queries started inside keep their state in RocksDB, as timers need."""
    before = spark.conf.get(STORE)
    spark.conf.set(STORE, ROCKSDB)
    try:
        yield
    finally:
        spark.conf.set(STORE, before)


def _nulls_first(*values):
    return tuple((v is not None, v) for v in values)


class LastReach(StatefulProcessor):
    """The fold of one video at a time."""

    def __init__(self, gap_ms: int):
        self.gap = gap_ms

    def init(self, handle) -> None:
        self.handle = handle
        self.waiting = handle.getListState("waiting", ROWS)
        self.open = handle.getValueState("open", OPEN)
        self.labels = handle.getListState("labels", "label array<string>")

    def close(self) -> None:
        pass

    def _wake(self, media_ms: int) -> None:
        """A timer for when the watermark has passed a media time."""
        self.handle.registerTimer(MEDIA_EPOCH_MS + media_ms + 1)

    def handleInputRows(self, key, rows, timerValues):
        new, first = [], []
        for part in rows:
            if len(part):
                new.append((part["row"].tolist(),))
                first.append(min(part["b"].tolist()))
        if new:
            self.waiting.appendList(new)
            self._wake(min(first))
        return iter(())

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo):
        passed = timerValues.getCurrentWatermarkInMs() - MEDIA_EPOCH_MS
        rows = [(*map(json.loads(text).get, FIELDS), text) for stored in self.waiting.get() for text in stored[0]]
        due = sorted((r for r in rows if r[0] < passed), key=lambda r: (r[0], _nulls_first(*r[2:4]), r[1], _nulls_first(r[4])))
        stored = self.open.get()
        now = None if stored is None else tuple(stored)
        held = now is not None  # the open cluster has labels in the state
        done, names = [], []
        for b, same in groupby(due, key=lambda r: r[0]):  # equal begins never part
            same = list(same)
            last = max(r[1] for r in same)
            if now is not None and b - now[2] <= self.gap:
                now = (now[0], max(now[1], last), max(b, now[2]), now[3] + len(same))
            else:
                if now is not None:
                    done.append(self._finish(now, names, held))
                    names, held = [], False
                now = (b, last, same[0][1], len(same))
            names += [r[4] for r in sorted(same, key=lambda r: _nulls_first(r[2], r[4]))]
        if now is not None and passed - now[2] > self.gap:
            done.append(self._finish(now, names, held))
            now, names = None, []
        self._keep(now, names, rows, due, passed, stored is not None)
        if done:
            yield pd.DataFrame({"video_id": key[0], "cluster": done})

    def _finish(self, cluster, names, held) -> str:
        """The text of a cluster nothing can join; the labels held for it leave the state."""
        kept = []
        if held:
            kept = [v for stored in self.labels.get() for v in stored[0]]
            self.labels.clear()
        return f"{cluster[0]} {cluster[1]} {cluster[3]} " + "|".join(v for v in kept + names if v is not None)

    def _keep(self, now, names, rows, due, passed, stored) -> None:
        if due:
            later = [r for r in rows if r[0] >= passed]
            if later:
                self.waiting.put([([r[5] for r in later],)])
                self._wake(min(r[0] for r in later))
            else:
                self.waiting.clear()
        if now is None:
            if stored:
                self.open.clear()
            return
        self.open.update(now)
        if names:
            self.labels.appendList([(names,)])
        self._wake(now[2] + self.gap)


def stream_clusters(det: DataFrame, gap_ms: int = GAP_MS, watermark: str = "1 minute",
                    label: str = "class3_name") -> DataFrame:
    """Clusters per video of a streaming DataFrame of narrow detections, in the
    columns of ``session_summary(reach='last')``; append mode.  Start the query
    inside ``keyed_state``.  Rows of ``stream_detections`` bring their event
    time and watermark along."""
    det = det.where(F.col(B).between(-END_MS, END_MS))
    if EVENT_TIME not in det.columns:
        det = det.withColumn(EVENT_TIME, media_time(B)).withWatermark(EVENT_TIME, watermark)
    source = F.col("source") if "source" in det.columns else F.lit(None).cast("string")
    fields = (F.col(B), F.col(E), F.col(ID).cast("long"), source, F.col(label))
    row = F.to_json(F.struct(*(c.alias(name) for c, name in zip(fields, FIELDS))))
    rows = det.select("video_id", F.col(B).alias("b"), row.alias("row"), EVENT_TIME)
    found = rows.groupBy("video_id").transformWithStateInPandas(
        LastReach(gap_ms), outputStructType=CLUSTER, outputMode="append", timeMode="EventTime")
    part = F.split("cluster", " ", 4)
    return found.select("video_id", part[0].cast("long").alias("cluster_b"), part[1].cast("long").alias("cluster_e"),
                        part[2].cast("long").alias("n_members"), part[3].alias("labels"))
