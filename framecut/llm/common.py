"""Helpers shared by the operators of this subpackage.

Conventions that hold for all of them:

* only the columns an operator names are read; any other column of the input,
  whatever its name, is ignored (or passed through by the pipeline stages);
* a null text is an empty text; a null ``doc_id`` is an id of its own that
  sorts after every number;
* an empty table gives an empty result with the same columns.
"""

from __future__ import annotations

import uuid
from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

#: A table is broadcast only after a count showed at most this many rows ...
BROADCAST_ROWS = 200_000
#: ... whose size in bytes is at most this.
BROADCAST_BYTES = 32 << 20


def checkpoint_dir(spark: SparkSession) -> str:
    """The shared folder named by ``spark.checkpoint.dir``.

    Where the session names none (tests), a folder in the warehouse, which a
    cluster shares as well.
    """
    sc = spark.sparkContext
    if sc.getCheckpointDir() is None:
        named = spark.conf.get("spark.checkpoint.dir", None)
        sc.setCheckpointDir(named or spark.conf.get("spark.sql.warehouse.dir") + "/framecut-checkpoints")
    return sc.getCheckpointDir()


def cut(df: DataFrame) -> DataFrame:
    """``df`` computed once and kept in the shared checkpoint folder."""
    checkpoint_dir(df.sparkSession)
    return df.checkpoint(eager=True)


def table_path(spark: SparkSession, name: str) -> str:
    """A new path in the shared checkpoint folder."""
    return f"{checkpoint_dir(spark)}/{name}-{uuid.uuid4().hex}"


def small(df: DataFrame, row_bytes: int, held: Column | None = None) -> DataFrame:
    """``df``, with a broadcast hint if it is shown to be small.

    A row counts ``row_bytes`` and, for what has no bound of its own (texts,
    arrays), the bytes that ``held`` gives for it.  At most
    ``BROADCAST_ROWS + 1`` rows are looked at, and of them only their sizes;
    a larger table comes back without a hint, and Spark joins it by a shuffle.
    """
    size = F.lit(row_bytes).cast("long") + (F.lit(0) if held is None else F.coalesce(held, F.lit(0)))
    rows, total = df.select(size.alias("size")).limit(BROADCAST_ROWS + 1).agg(
        F.count("size"), F.coalesce(F.sum("size"), F.lit(0))).first()
    return F.broadcast(df) if rows <= BROADCAST_ROWS and total <= BROADCAST_BYTES else df


def shards(spark: SparkSession) -> int:
    """How many partitions a shuffle of this session has."""
    return int(spark.conf.get("spark.sql.shuffle.partitions"))


def text_of(name: str = "text") -> Column:
    return F.coalesce(F.col(name).cast("string"), F.lit(""))


def id_last(name: str = "doc_id") -> Column:
    """Order key of an id: numbers ascending, null last."""
    return F.struct(F.col(name).isNull().alias("none"), F.col(name).alias("id"))


def fresh(df: DataFrame, *names: str) -> list[str]:
    """Column names like ``names`` that ``df`` does not have, whatever the letters' case."""
    taken = {c.lower() for c in df.columns}
    out = []
    for name in names:
        while name.lower() in taken:
            name = "_" + name
        out.append(name)
    return out


def connected_components(edges: DataFrame, rounds: int = 60) -> DataFrame:
    """(node, component) for the nodes of undirected ``edges`` (a, b: long).

    The component is its smallest node.  Labels spread to neighbours, then
    jump to the label of their label, until nothing changes; every round is
    checkpointed.  Minimums combine map-side before the shuffle, so a node
    with very many neighbours costs one row per task.
    """
    both = cut(edges.select("a", "b").union(edges.select(F.col("b"), F.col("a"))).distinct())
    labels = cut(both.groupBy(F.col("a").alias("node")).agg(F.min("b").alias("m"))
                 .select("node", F.least("node", "m").alias("component")))
    for _ in range(rounds):
        heard = (both.join(labels, both["b"] == labels["node"])
                 .groupBy("a").agg(F.min("component").alias("heard")))
        near = labels.join(heard, labels["node"] == heard["a"], "left").select(
            "node", F.col("component").alias("old"),
            F.least("component", F.coalesce("heard", "component")).alias("component"))
        up = labels.select(F.col("node").alias("__up"), F.col("component").alias("jump"))
        jumped = cut(near.join(up, near["component"] == up["__up"], "left").select(
            "node", "old", F.least("component", F.coalesce("jump", "component")).alias("component")))
        labels = jumped.select("node", "component")
        if jumped.filter(F.col("old") != F.col("component")).limit(1).count() == 0:
            return labels
    raise RuntimeError(f"labels still change after {rounds} rounds")


def per_partition(fn: Callable, *args):
    """``fn(batches, *args)`` as a function for ``mapInArrow``."""
    def run(batches):
        return fn(batches, *args)
    return run
