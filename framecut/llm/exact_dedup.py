"""Exact duplicates, with frequent digests split off before the shuffle.

Method: Misra-Gries summaries of the digests, one per task, add up to a list
that holds every digest with more than ``2 / (counters + 1)`` of all rows and
at most ``counters + 1`` entries.  Exact counts and winners of these few are
broadcast, so their rows are decided in the map task that reads them.  All
other digests are grouped by an ordinary shuffle, in which no digest can have
more rows than that share.

Defined results: a null text equals the empty text; of rows that repeat a
``doc_id`` with equal text one stays; a null ``doc_id`` loses against a number;
an empty table gives an empty result; other columns are ignored.
"""

from __future__ import annotations

import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .common import cut, fresh, id_last, per_partition, text_of

#: Misra-Gries counters of one summary; bounds what is broadcast.
COUNTERS = 1024
WHITE = r"[\x20\x09-\x0D]+"


def _reduced(counts: dict, counters: int) -> dict:
    """Misra-Gries: lower all counts by the (counters + 1)-th largest."""
    if len(counts) <= counters:
        return counts
    cut_off = sorted(counts.values(), reverse=True)[counters]
    return {k: v - cut_off for k, v in counts.items() if v > cut_off}


def _summary(batches, counters: int):
    """One Misra-Gries summary of the digests of a partition."""
    counts: dict = {}
    for batch in batches:
        for item in pc.value_counts(batch.column(0)):
            key = item["values"].as_py()
            counts[key] = counts.get(key, 0) + item["counts"].as_py()
        counts = _reduced(counts, counters)
    yield pa.RecordBatch.from_pydict(
        {"digest": pa.array(list(counts), pa.binary()), "n": pa.array(list(counts.values()), pa.int64())})


def frequent_digests(table: DataFrame, rows: int, counters: int = COUNTERS) -> DataFrame:
    """Digests that may have more than 2 / (counters + 1) of the rows.

    The estimates of one digest add up to at least its count less
    ``rows / (counters + 1)``, and all estimates together to at most ``rows``,
    so nothing frequent is missed and at most ``counters + 1`` digests pass.
    """
    parts = table.select("digest").mapInArrow(per_partition(_summary, counters), "digest binary, n long")
    return (parts.groupBy("digest").agg(F.sum("n").alias("n"))
            .filter(F.col("n") * (counters + 1) >= rows).select("digest"))


def exact_duplicates(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                     counters: int = COUNTERS) -> DataFrame:
    """One row per document: id, keep_id, group_size, kept, digest (binary).

    Texts are equal when they are identical after every run of ASCII white
    space became one space.  The smallest id of a group stays.
    """
    table = cut(docs.select(
        F.col(id_col).alias("doc_id"),
        F.unhex(F.sha2(F.regexp_replace(text_of(text_col), WHITE, " "), 256)).alias("digest"),
        F.monotonically_increasing_id().alias("row")))
    rank = F.struct(id_last().alias("id"), "row")
    frequent = F.broadcast(frequent_digests(table, table.count(), counters))
    winners = F.broadcast(cut(
        table.join(frequent, "digest", "left_semi").groupBy("digest")
        .agg(F.min(rank).alias("first"), F.count("*").alias("group_size"))))
    hot = table.join(winners, "digest")
    group = Window.partitionBy("digest")
    rest = (table.join(winners.select("digest"), "digest", "left_anti")
            .withColumn("first", F.min(rank).over(group))
            .withColumn("group_size", F.count("*").over(group)))
    return hot.unionByName(rest.select(*hot.columns)).select(
        F.col("doc_id").alias(id_col), F.col("first.id.id").alias("keep_id"), "group_size",
        (F.col("row") == F.col("first.row")).alias("kept"), "digest")


def drop_duplicates(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """The documents that stay, with all their columns.

    Rows that repeat an id with equal text are one document: one of them stays.
    """
    digest, n, kept_id, kept_digest = fresh(docs, "__digest", "__n", "__id", "__kept")
    kept = exact_duplicates(docs, id_col, text_col).filter("kept").select(
        F.col(id_col).alias(kept_id), F.col("digest").alias(kept_digest))
    marked = docs.withColumn(digest, F.unhex(F.sha2(F.regexp_replace(text_of(text_col), WHITE, " "), 256)))
    stay = marked.join(kept, (marked[digest] == kept[kept_digest]) & marked[id_col].eqNullSafe(kept[kept_id]),
                       "left_semi")
    same = Window.partitionBy(digest, id_col).orderBy(digest)
    return stay.withColumn(n, F.row_number().over(same)).filter(F.col(n) == 1).select(*docs.columns)
