"""K1-K6: writing documents and counts.

Documents carry a stable ``clip_id``; ``append_new`` writes only documents
whose id is not in the target yet, so re-running a round adds nothing.  The
anti-join against the existing ids is a distributed join, nothing goes
through the driver.
"""

from __future__ import annotations

import uuid
from contextlib import contextmanager

from pyspark import StorageLevel
from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.utils import AnalysisException

#: Ends the round id of a compaction, a version of all keys.
WHOLE = "all"


def _existing_ids(spark: SparkSession, path: str, fmt: str) -> DataFrame | None:
    try:
        return spark.read.format(fmt).load(path).select("clip_id")
    except AnalysisException as e:  # only a target that does not exist yet is empty
        if e.getCondition() in ("PATH_NOT_FOUND", "UNABLE_TO_INFER_SCHEMA"):
            return None
        raise


def append_new(docs: DataFrame, path: str, fmt: str = "parquet", partition_by: str | None = "kind",
               options: dict | None = None) -> Observation:
    """K1: append the documents not yet in ``path``; returns an
    ``Observation`` with the number written (A12/K6, counted while writing,
    no second pass)."""
    spark = docs.sparkSession
    old = _existing_ids(spark, path, fmt)
    docs = one_per_clip(docs)
    new = docs if old is None else docs.join(old, "clip_id", "left_anti")
    obs = Observation("written")
    new = new.observe(obs, F.count(F.lit(1)).alias("documents"))
    w = new.write.format(fmt).mode("append").options(**(options or {}))
    if partition_by and partition_by in new.columns:
        w = w.partitionBy(partition_by)
    w.save(path)
    return obs


def one_per_clip(docs: DataFrame) -> DataFrame:
    """One document per ``clip_id``: of different ones with the same id the
    least as JSON text, so the choice does not depend on the run."""
    rest = [c for c in docs.columns if c != "clip_id"]
    return (docs.groupBy("clip_id").agg(F.min_by(F.struct(*rest), F.to_json(F.struct(*rest))).alias("_doc"))
            .select("clip_id", "_doc.*").select(*docs.columns))


def _read_or_none(spark: SparkSession, path: str) -> DataFrame | None:
    try:
        return spark.read.parquet(path)
    except AnalysisException as e:  # only a target that does not exist yet is empty
        if e.getCondition() != "PATH_NOT_FOUND":
            raise
        return None


def next_round(spark: SparkSession, path: str) -> str:
    """An id that sorts after those of all rounds published at ``path``."""
    rounds = _read_or_none(spark, f"{path}/rounds")
    last = rounds.agg(F.max("round")).first()[0] if rounds is not None else None
    return f"{int(last.split('-')[0]) + 1 if last else 1:012d}-{uuid.uuid4().hex}"


def write_version(rows: DataFrame, path: str, this: str) -> int:
    """Append rows under the round id ``this``; nobody sees them yet.  Returns their number."""
    obs = Observation("written")
    (rows.observe(obs, F.count(F.lit(1)).alias("rows"))
     .write.mode("append").parquet(f"{path}/documents/round={this}"))
    return int(obs.get.get("rows", 0))


def publish(keys: DataFrame, path: str, this: str) -> None:
    """Make round ``this`` the current version of ``keys`` (one row each)."""
    keys.write.mode("append").parquet(f"{path}/rounds/round={this}")


def replace_keys(docs: DataFrame, keys: DataFrame, path: str) -> int:
    """The documents of ``keys`` become exactly ``docs``; returns the number written.

    Documents are appended under a new round id, then the keys go to the table
    of rounds: only that makes the new version visible, so readers of
    ``current`` see one version of a key, and a round that fails half-way
    shows nothing.  One writer at a time for a path."""
    this = next_round(docs.sparkSession, path)
    written = write_version(one_per_clip(docs), path, this)
    publish(keys, path, this)
    return written


def replace_videos(docs: DataFrame, video_ids: DataFrame, path: str) -> int:
    """K1 for rounds: ``replace_keys`` by video."""
    return replace_keys(docs, video_ids.select(F.col("video_id").alias("string_vid")), path)


def current(spark: SparkSession, path: str) -> DataFrame | None:
    """The rows of every key as its latest round left them (None: nothing published yet)."""
    rounds = _read_or_none(spark, f"{path}/rounds")
    if rounds is None:
        return None
    keys = [c for c in rounds.columns if c != "round"]
    latest = rounds.groupBy(*keys).agg(F.max("round").alias("round"))
    return spark.read.parquet(f"{path}/documents").join(latest, [*keys, "round"], "left_semi").drop("round")


def current_documents(spark: SparkSession, path: str) -> DataFrame:
    """The documents of every video as its latest round left them."""
    docs = current(spark, path)
    if docs is None:
        raise FileNotFoundError(f"no round was published at {path}")
    return docs


def compact(spark: SparkSession, path: str) -> int:
    """Write the current rows of all keys as one new version; returns their number.

    Every key has the same rows in its old and its new version, so a reader
    sees the same before, during and after, also when the run fails half-way.
    Rounds of keys without a row are kept as well.  ``vacuum`` then removes
    what no key needs any more.  One writer at a time for a path."""
    rows = current(spark, path)
    if rows is None:
        return 0
    keys = spark.read.parquet(f"{path}/rounds").drop("round").distinct()
    this = f"{next_round(spark, path)}-{WHOLE}"
    written = write_version(rows, path, this)
    publish(keys, path, this)
    return written


def vacuum(spark: SparkSession, path: str, keep: int = 2) -> int:
    """Remove the files of all rounds before the last ``keep`` compactions;
    returns how many folders went.

    Readers that opened ``path`` after the oldest compaction that is kept read
    no file that goes.  Only a compaction whose publication is complete counts;
    left-overs of failed rounds before it go too.  With fewer compactions
    nothing is removed, and a repeated call goes on where a failed one stopped."""
    if keep < 1:
        raise ValueError("keep must be at least 1")
    names = sorted(_folders(spark, f"{path}/rounds"))
    whole = [n for n in names if n.endswith(f"-{WHOLE}") and _exists(spark, f"{path}/rounds/{n}/_SUCCESS")]
    if len(whole) < keep:
        return 0
    oldest, removed = whole[-keep], 0
    for part in ("rounds", "documents"):  # a round without documents must not stay visible
        for name in _folders(spark, f"{path}/{part}"):
            if name < oldest:
                remove(spark, f"{path}/{part}/{name}")
                removed += 1
    return removed


def _file_system(spark: SparkSession, path: str):
    place = spark._jvm.org.apache.hadoop.fs.Path(path)
    return place.getFileSystem(spark._jsparkSession.sessionState().newHadoopConf()), place


def _folders(spark: SparkSession, path: str) -> list[str]:
    """Names of the round folders in ``path``."""
    fs, place = _file_system(spark, path)
    found = [f.getPath().getName() for f in fs.listStatus(place)] if fs.exists(place) else []
    return [n for n in found if n.startswith("round=")]


def _exists(spark: SparkSession, path: str) -> bool:
    fs, place = _file_system(spark, path)
    return fs.exists(place)


def remove(spark: SparkSession, path: str) -> None:
    """Delete a folder in whatever store it is."""
    fs, place = _file_system(spark, path)
    fs.delete(place, True)


def write_json(docs: DataFrame, path: str, mode: str = "append") -> None:
    """K1 for a plain JSON-lines target."""
    docs.write.mode(mode).json(path)


def counts_by(docs: DataFrame, col: str = "kind") -> DataFrame:
    """Documents per kind as a DataFrame (distributed count)."""
    return docs.groupBy(col).agg(F.count(F.lit(1)).cast("bigint").alias("n_clips"))


@contextmanager
def persisted(df: DataFrame, level: StorageLevel = StorageLevel.MEMORY_AND_DISK):
    """K5: keep ``df`` materialised while several outputs are computed from
    it, release it afterwards."""
    df.persist(level)
    try:
        yield df
    finally:
        df.unpersist()
