"""Token counts: exact histogram of encoded lengths and its suffix sums.

Every text is encoded once; documents are added up by length map-side.  Sums
over all longer documents then answer, for every context limit that is a
length of the table, how many tokens fit, how many are cut off and which
quantile the limit is.  Limits between two lengths follow by arithmetic
(``totals_at`` on the histogram).  The suffix sums run in two steps, over ranges of lengths
and inside each range, so no task holds the histogram whole.

Defined results: a null or empty text counts its end id only (length 1); an
empty table gives no rows.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .common import cut, per_partition, text_of
from .tokens import encoder, portions

#: Lengths in one range of the suffix sums.
RANGE = 4096


def _lengths(batches, path: str):
    enc = encoder(path)
    for batch in batches:
        for some in portions(batch, 0):
            _, n = enc.encode(some.column(0))
            length, docs = np.unique(n + 1, return_counts=True)
            yield pa.RecordBatch.from_pydict({"length": pa.array(length, pa.int64()), "docs": pa.array(docs, pa.int64())})


def length_histogram(docs: DataFrame, tokenizer: str, text_col: str = "text") -> DataFrame:
    """(length, docs): documents of each encoded length, end id included."""
    return (docs.select(text_of(text_col)).mapInArrow(per_partition(_lengths, tokenizer), "length long, docs long")
            .groupBy("length").agg(F.sum("docs").alias("docs")))


def suffix_sums(histogram: DataFrame, step: int = RANGE) -> DataFrame:
    """Per length L: docs and tokens of documents with at least L ids, the total
    when every document is cut at L, and the share of documents no longer than L."""
    ranged = cut(histogram.withColumn("band", F.floor(F.col("length") / step)))
    bands = ranged.groupBy("band").agg(F.sum("docs").alias("d"), F.sum(F.col("docs") * F.col("length")).alias("t"))
    above = Window.orderBy(F.desc("band")).rowsBetween(Window.unboundedPreceding, -1)
    everything = Window.orderBy(F.desc("band")).rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    bands = bands.select(
        "band", *(F.coalesce(F.sum(c).over(above), F.lit(0)).alias(f"{c}_above") for c in "dt"),
        *(F.sum(c).over(everything).alias(f"{c}_all") for c in "dt"))
    inside = Window.partitionBy("band").orderBy(F.desc("length")).rowsBetween(Window.unboundedPreceding, 0)
    sums = ranged.join(bands, "band").select(
        "length", "docs", "d_all", "t_all",
        (F.sum("docs").over(inside) + F.col("d_above")).alias("docs_from"),
        (F.sum(F.col("docs") * F.col("length")).over(inside) + F.col("t_above")).alias("tokens_from"))
    shorter = F.col("t_all") - F.col("tokens_from")
    return sums.select(
        F.col("length").alias("context_limit"), F.col("docs").alias("n_docs"),
        F.col("docs_from").alias("docs_at_least"), F.col("tokens_from").alias("tokens_at_least"),
        F.col("d_all").alias("total_docs"), F.col("t_all").alias("total_tokens"),
        (shorter + F.col("length") * F.col("docs_from")).alias("truncated_tokens"),
        ((F.col("d_all") - F.col("docs_from") + F.col("docs")) / F.col("d_all")).alias("share_within"))


def totals_at(histogram: DataFrame, limits: list[int]) -> DataFrame:
    """One row: the tokens that remain when every document is cut at each of ``limits``."""
    return histogram.agg(*(F.sum(F.least("length", F.lit(int(x))) * F.col("docs")).alias(f"at_{x}") for x in limits))


def quantile(sums: DataFrame, share: float) -> DataFrame:
    """The smallest length within which at least ``share`` of the documents lie."""
    return sums.filter(F.col("share_within") >= share).agg(F.min("context_limit").alias("length"))
