"""Pending-work rounds.

A round

1. opens its inputs anew (``open_inputs`` is a callable, so files that landed
   since the last round are read),
2. fixes the ids of its pending videos once, in a table under ``work_dir`` (a
   folder that driver and executors share),
3. computes their documents with ``job`` and makes them the current version of
   those videos (``sinks.replace_videos``), and only then
4. hands exactly these ids to ``mark``, also the videos without a clip
   (``mark`` uses them before it returns; the folder of ids is then deleted).

A task that becomes pending during the round stays pending.  A round that
fails before 4 leaves its videos pending, and the next one replaces whatever
it wrote.  ``job`` is any of ``jobs.clips_all`` (Q8), ``jobs.clips_union`` (Q6)
and ``jobs.multi_v1`` (Q4).  With ``scope='scene'`` the scene ranking spans all
videos, so a new video can change scene clips of videos already done.  With a
``scene_store`` a round keeps those up to date as well (``streaming.scenes``);
its job is then ``jobs.clips_detections``, and ``current_clips`` reads all
kinds.  Without one, rounds leave scene clips of other videos as they are.

``pending_stream`` runs rounds with Structured Streaming: the task table is
a file stream of task rows, each micro-batch is one round (``foreachBatch``),
and the stream's checkpoint records which task files were handled.
"""

from __future__ import annotations

import uuid
from contextlib import contextmanager
from typing import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from framecut import schemas
from framecut.params import Params
from framecut.plans.jobs import clips_all, clips_detections
from framecut.sources.sinks import current_documents, remove, replace_videos
from framecut.sources.tables import Inputs, pending_tasks
from framecut.streaming.scenes import current_scenes, update_scenes

Mark = Callable[[DataFrame], None]


def mark_processed(tasks: DataFrame, processed: DataFrame) -> DataFrame:
    """The task table after a round: status 1 for every
    processed video, the rest unchanged."""
    done = processed.select("video_id").distinct().withColumn("_done", F.lit(True))
    t = tasks.join(done, "video_id", "left")
    return t.select("video_id", F.when(F.col("_done"), F.lit(1)).otherwise(F.col("status"))
                    .cast("int").alias("status"))


def new_task_version(open_tasks: Callable[[], DataFrame], out: str) -> Mark:
    """A ``mark`` for a task table in files: the table as it is after the
    round, with the round's videos done, goes to ``out`` (the caller swaps it
    in).  A database gets a ``mark`` of the caller's that upserts the ids."""
    def mark(ids: DataFrame) -> None:
        mark_processed(open_tasks(), ids).write.mode("overwrite").parquet(out)
    return mark


@contextmanager
def _fixed(pending: DataFrame, work_dir: str):
    """The ids of a round, written once, so that every later use reads the
    same; the folder goes when the round has ended, also by a failure."""
    path = f"{work_dir}/pending-{uuid.uuid4().hex}"
    try:
        pending.select("video_id").distinct().write.parquet(path)
        yield pending.sparkSession.read.parquet(path)
    finally:
        remove(pending.sparkSession, path)


def _round(pending: DataFrame, inp: Inputs, docs_path: str, mark: Mark, work_dir: str,
           job: Callable[..., DataFrame] | None, p: Params, scene_store: str | None) -> int:
    with _fixed(pending, work_dir) as ids:
        if ids.isEmpty():
            return 0
        job = job or (clips_all if scene_store is None else clips_detections)
        written = replace_videos(job(inp, p, video_ids=ids), ids, docs_path)
        if scene_store is not None:
            written += update_scenes(inp, ids, scene_store, p)
        mark(ids)
        return written


def run_round(open_inputs: Callable[[], Inputs], docs_path: str, mark: Mark, work_dir: str,
              job: Callable[..., DataFrame] | None = None, p: Params = Params(), scene_store: str | None = None) -> int:
    """One round over the pending tasks; returns the number of documents written (K6)."""
    inp = open_inputs()
    return _round(pending_tasks(inp.tasks), inp, docs_path, mark, work_dir, job, p, scene_store)


def current_clips(spark: SparkSession, docs_path: str, scene_store: str) -> DataFrame:
    """All kinds of documents of rounds that kept a ``scene_store``."""
    docs, scenes = current_documents(spark, docs_path), current_scenes(spark, scene_store)
    return docs if scenes is None else docs.unionByName(scenes, allowMissingColumns=True)


def pending_stream(spark: SparkSession, open_inputs: Callable[[], Inputs], task_dir: str, docs_path: str,
                   checkpoint: str, mark: Mark, work_dir: str, job: Callable[..., DataFrame] | None = None,
                   p: Params = Params(), scene_store: str | None = None, trigger: dict | None = None,
                   on_round: Callable[[int, int], None] | None = None):
    """A streaming query over new task files in ``task_dir`` (rows
    ``video_id, status``); every micro-batch is a round over its pending
    videos, and ``on_round(epoch, documents)`` receives its count (K6).
    ``trigger`` defaults to ``availableNow`` (process what is there, then
    stop); use ``{"processingTime": "5 seconds"}`` to keep polling like the
    reference loop.  A repeated micro-batch replaces what it wrote before."""
    tasks = spark.readStream.schema(schemas.TASK).parquet(task_dir)

    def round_(batch: DataFrame, epoch: int) -> None:
        n = _round(pending_tasks(batch), open_inputs(), docs_path, mark, work_dir, job, p, scene_store)
        if on_round:
            on_round(epoch, n)

    return (tasks.writeStream.foreachBatch(round_)
            .option("checkpointLocation", checkpoint)
            .trigger(**(trigger or {"availableNow": True}))
            .start())
