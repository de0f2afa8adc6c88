"""I6 on a stream: the clusters of the default fold, whatever the micro-batches."""

import random

from framecut.operators.sessions import session_summary
from framecut.streaming.clusters import keyed_state, stream_clusters

ROWS = "video_id string, ad_seat_b_time long, ad_seat_e_time long, detection_id long, source string, class3_name string"
GAP = 10_000
COLS = ("video_id", "cluster_b", "cluster_e", "n_members", "labels")


def _run(spark, root, watermark, name):
    stream = spark.readStream.schema(ROWS).option("maxFilesPerTrigger", 1).parquet(f"{root}/in")
    with keyed_state(spark):
        q = (stream_clusters(stream, GAP, watermark).writeStream.format("parquet").option("path", f"{root}/out")
             .option("checkpointLocation", f"{root}/state").queryName(name).trigger(availableNow=True).start())
    assert q.awaitTermination(400)


def _out(spark, root):
    return sorted(map(tuple, spark.read.parquet(f"{root}/out").select(*COLS).collect()))


def _add(spark, root, rows):
    spark.createDataFrame(rows, ROWS).coalesce(1).write.mode("append").parquet(f"{root}/in")


def _sample(seed, n):
    """Rows of three videos: long heads, equal begins, repeated rows, null labels and sources, begins at 0 and below."""
    rnd = random.Random(seed)
    rows = []
    for k in range(n):
        b = rnd.choice([rnd.randrange(-2_000, 400_000), rnd.randrange(40) * 10_000])
        rows.append((rnd.choice("uvw"), b, b + rnd.choice([0, 500, 9_000, 60_000]), k, rnd.choice(["face", "ocr", None]),
                     rnd.choice(["a", "b", "c", None])))
    return rows + rows[:5]


def test_out_of_order_batches_give_the_clusters_of_the_batch_fold(spark, scratch):
    rows = _sample(3, 300)
    for part in (rows[::3], rows[1::3], rows[2::3]):  # each spans all begins: only the watermark's delay keeps them
        _add(spark, scratch, part)
    _add(spark, scratch, [("u", 1 << 60, 1 << 60, 1_000, "face", "corrupt")])  # moves no watermark
    _run(spark, scratch, "10 minutes", "fc_order")
    before = _out(spark, scratch)
    _add(spark, scratch, [("z", 50_000_000, 50_000_001, 1, "face", "end")])
    _run(spark, scratch, "10 minutes", "fc_order_end")
    want = sorted(map(tuple, session_summary(spark.createDataFrame(rows, ROWS), GAP, "last").select(*COLS).collect()))
    assert before == [] and _out(spark, scratch) == want and len(want) > 10
    # only the sentinel's waiting row is left of the state
    state = spark.read.format("statestore").option("path", f"{scratch}/state")
    assert {r["key"]["video_id"] for r in state.option("stateVarName", "waiting").load().collect()} == {"z"}
    assert state.option("stateVarName", "open").load().count() == 0
    assert state.option("stateVarName", "labels").load().count() == 0


def test_clusters_stay_open_across_batches_and_close_in_time(spark, scratch):
    """In order, one batch after another: members join a cluster of an earlier batch, its head's end reaches over the
    later ones, and a closed cluster comes out before the stream ends."""
    batches = [[("v", 0, 95_000, 1, "face", "a"), ("v", 3_000, 4_000, 2, "face", "b")],
               [("v", 100_000, 101_000, 3, "face", "c")],      # begin - first end = 5 s: joins
               [("v", 112_000, 300_000, 4, "face", "d")],      # 12 s behind the reach: opens; its end is its reach
               [("v", 309_000, 310_000, 5, "face", "e")],
               [("v", 330_000, 331_000, 6, "face", "f")],
               [("v", 100_500, 100_600, 7, "face", "late")]]   # behind the watermark: dropped
    for rows in batches:
        _add(spark, scratch, rows)
    _run(spark, scratch, "1 second", "fc_close")
    assert _out(spark, scratch) == [("v", 0, 101_000, 3, "a|b|c"), ("v", 112_000, 310_000, 2, "d|e")]
    _add(spark, scratch, [("z", 900_000, 900_001, 9, "face", "end")])
    _run(spark, scratch, "1 second", "fc_close_end")
    assert _out(spark, scratch)[-1] == ("v", 330_000, 331_000, 1, "f")
    on_time = [r for rows in batches[:-1] for r in rows]
    want = sorted(map(tuple, session_summary(spark.createDataFrame(on_time, ROWS), GAP, "last").select(*COLS).collect()))
    assert _out(spark, scratch) == want
