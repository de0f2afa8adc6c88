"""Work of a step that must not grow with what one video or one list of ids holds."""

import json

import pandas as pd
from pyspark.sql import functions as F

from framecut import params as P
from framecut.operators.normalize import for_videos
from framecut.streaming.clusters import LastReach

GAP = 10_000


class _State:
    """A list or value state that counts its calls."""

    def __init__(self, calls):
        self.calls, self.held = calls, []

    def _call(self):
        self.calls.append(1)

    def exists(self):
        self._call()
        return bool(self.held)

    def clear(self):
        self._call()
        self.held = []

    def appendList(self, rows):
        self._call()
        self.held += rows

    def put(self, rows):
        self._call()
        self.held = list(rows)

    def update(self, value):
        self._call()
        self.held = [value]


class _List(_State):
    def get(self):
        self._call()
        return iter(self.held)


class _Value(_State):
    def get(self):
        self._call()
        return self.held[0] if self.held else None


class _Handle:
    def __init__(self):
        self.calls = []

    def getListState(self, name, schema):
        return _List(self.calls)

    def getValueState(self, name, schema):
        return _Value(self.calls)

    def registerTimer(self, ms):
        self.calls.append(1)


class _Watermark:
    def __init__(self, media_ms):
        self.ms = media_ms

    def getCurrentWatermarkInMs(self):
        from framecut.functions.intervals import MEDIA_EPOCH_MS
        return MEDIA_EPOCH_MS + self.ms


def _calls(n):
    """State calls and rows of a timer that folds ``n`` clusters of a video."""
    rows = pd.DataFrame({"b": [k * 20_000 for k in range(n)]})
    rows["e"], rows["i"], rows["source"], rows["label"] = rows["b"] + 1, range(n), "face", "a"
    rows["row"] = [json.dumps(r) for r in rows.to_dict("records")]
    fold, handle = LastReach(GAP), _Handle()
    fold.init(handle)
    list(fold.handleInputRows(("v",), iter([rows]), None))
    out = list(fold.handleExpiredTimer(("v",), _Watermark((n - 1) * 20_000 + 2), None))
    return len(handle.calls), sum(len(part) for part in out)


def test_a_timer_calls_the_state_as_often_for_many_clusters_as_for_few():
    few, many = _calls(3), _calls(200)
    assert few[1] == 2 and many[1] == 199  # the last one may still grow
    assert many[0] == few[0] <= 8


def test_a_long_list_of_ids_does_not_deal_detections_by_video_alone(spark):
    det = spark.range(4_000).select(
        F.when(F.col("id") % 10 == 0, F.concat(F.lit("no"), "id")).otherwise("7").alias("video_id"),
        F.when(F.col("id") % 7 > 0, F.col("id") * 1_000).alias("ad_seat_b_time"), F.col("id").alias("detection_id"))
    ids = spark.range(P.MAX_BROADCAST_ROWS + 1).select(F.col("id").cast("string").alias("video_id"))
    conf = {"spark.sql.autoBroadcastJoinThreshold": "-1", "spark.sql.adaptive.coalescePartitions.enabled": "false"}
    before = {k: spark.conf.get(k) for k in conf}
    try:
        for k, v in conf.items():
            spark.conf.set(k, v)
        kept = for_videos(det, ids)
        assert kept.columns == det.columns
        tasks = kept.groupBy(F.spark_partition_id().alias("task")).count().collect()
        assert len(tasks) > 1 and sum(r["count"] for r in tasks) == 3_600  # one hot video, null begins included
        found = sorted(map(tuple, kept.collect()), key=lambda r: r[2])
    finally:
        for k, v in before.items():
            spark.conf.set(k, v)
    assert found == sorted(map(tuple, for_videos(det, ["7"]).collect()), key=lambda r: r[2])
