"""The corpus pipeline: language ID, exact dedup, SimHash near-dedup, benchmark
decontamination, packing.

Each stage takes (spark, docs, sf_dir), works on all rows its predecessor
kept, and returns a DataFrame; the driver writes it as Parquet and reads it
again as the next stage's ``docs``.  All but the last return the columns of
``documents``, extra columns included.  Rows with null values pass through
the stages as the operators define; an empty table stays empty.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from framecut.llm import decontaminate, exact_dedup, langid, packing, simhash
from framecut.llm.catalog import WORD_BPE, read
from framecut.llm.common import table_path
from framecut.llm.tokens import public_path


def language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents whose language is not rejected."""
    return langid.drop_rejected(docs)


def exact(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of equal texts."""
    return exact_dedup.drop_duplicates(docs)


def near(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group linked by SimHash."""
    return simhash.drop_near_duplicates(docs)


def clean(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without a benchmark window."""
    return decontaminate.drop_contaminated(docs, read(spark, sf_dir, "benchmark"))


def packed(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of the packed sequences."""
    return packing.pack(docs, public_path(WORD_BPE))


STAGES = [("language", language), ("exact_dedup", exact), ("near_dedup", near), ("decontaminate", clean),
          ("pack", packed)]

#: SQL cannot express the language models, XXH64 or the tokenizer.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages on ``documents``, each written to the shared folder and read again."""
    docs = read(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        path = table_path(spark, f"pipeline-{name}")
        stage(spark, docs, sf_dir).write.parquet(path)
        docs = spark.read.parquet(path)
    return STAGES[-1][1](spark, docs, sf_dir)
