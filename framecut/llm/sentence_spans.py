"""Substring duplicates by sliding spans of consecutive sentences.

Texts are cut into sentences (a run up to ``.``, ``!`` or ``?`` before white
space, or up to a line feed), sentences of more than ``WORDS`` words into
pieces of that many.  Every run of ``SPAN`` consecutive sentences is hashed
(two 64-bit hashes of the trimmed sentences).  Spans that occur more than once
anywhere are found by one grouping; every occurrence but the first, by
(doc_id, place), marks its sentences, and marked sentences are removed.

Pieces counted from the start of their sentence keep the step of that start,
so a passage repeated in the middle of another sentence may be missed.  With
``cut=content_sentences`` sentences are cut after words whose hash (with both
neighbours) is the smallest, or equal to it, of the ``REACH`` words to each
side: such cuts depend only on the words around them, so equal stretches come
into step whatever precedes them, with or without sentence marks.  Sentences
of at most ``2 * REACH`` words stay whole.

Defined results: texts of fewer than ``SPAN`` sentences have no span and stay
whole; a null text is empty; rows that repeat a ``doc_id`` with equal text are
the same occurrence, so neither loses anything to the other; repeats inside
one document count; null ids come after all numbers.
"""

from __future__ import annotations

import re
from collections.abc import Callable
from zlib import crc32

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import id_last, per_partition, text_of

SPAN = 3
WORDS = 16
#: Words to each side that a content-defined cut looks at.
REACH = 4
#: One sentence with the white space after it; the pieces of a text add up to it.
SENTENCE = r"(?:[^.!?\n]++|[.!?]++[^.!?\x20\t\r\n])*+[.!?]*+[\x20\t\r\n]*+"
PIECE = r"[\x20\t\r\n]*+(?:[^\x20\t\r\n]++[\x20\t\r\n]*+){1,%d}|[\x20\t\r\n]++"
WHITE = " \t\r\n"
_BLANK = WHITE.encode()
_SENTENCE = re.compile(SENTENCE.encode())
_WORD = re.compile(rb"[\x20\t\r\n]*+[^\x20\t\r\n]++[\x20\t\r\n]*+")
_MIX = (0x9E3779B97F4A7C15, 0xD6E8FEB86659FD93, 0xC2B2AE3D27D4EB4F)


def sentences(text: Column, words: int = WORDS) -> Column:
    """The sentences of a text; together they are the text."""
    cut = F.filter(F.regexp_extract_all(text, F.lit(SENTENCE), F.lit(0)), lambda s: s != "")
    return F.flatten(F.transform(cut, lambda s: F.when(
        F.length(s) < 2 * words, F.array(s)).otherwise(
            F.regexp_extract_all(s, F.lit(PIECE % words), F.lit(0)))))


def content_pieces(texts: pa.Array) -> pa.Array:
    """The sentences of every text, long ones cut at content-defined places; together they are the text."""
    hashes, lengths, sizes, ends, raws = [], [], [], [0], []
    for text in texts.cast(pa.large_binary()).to_pylist():
        raws.append(text or b"")
        for s in filter(None, _SENTENCE.findall(raws[-1])):
            words = _WORD.findall(s) or [s]
            hashes += [crc32(w.strip(_BLANK)) for w in words]
            lengths += map(len, words)
            sizes.append(len(words))
        ends.append(len(lengths))
    n, sizes = len(lengths), np.array(sizes, np.int64)
    h = np.concatenate([[0], np.array(hashes, np.uint64), [0]]).astype(np.uint64)
    start = np.repeat(np.cumsum(sizes) - sizes, sizes)
    place, left = np.arange(n) - start, start + np.repeat(sizes, sizes) - 1 - np.arange(n)
    h = (h[1:-1] * np.uint64(_MIX[0]) + np.where(place > 0, h[:-2], 0) * np.uint64(_MIX[1])
         + np.where(left > 0, h[2:], 0) * np.uint64(_MIX[2]))
    h ^= h >> np.uint64(32)
    h *= np.uint64(_MIX[1])
    least = np.lib.stride_tricks.sliding_window_view(
        np.concatenate([h[:REACH], h, h[:1].repeat(2 * REACH)]), 2 * REACH + 1).min(axis=1)[:n] if n else h
    after = (place >= REACH) & (left >= REACH) & (h == least)
    heads = np.flatnonzero((place == 0) | np.concatenate([[False], after[:-1]])[:n])
    begins = np.concatenate([[0], np.cumsum(np.array(lengths, np.int64))])
    pieces = pa.LargeStringArray.from_buffers(
        len(heads), pa.py_buffer(np.concatenate([begins[heads], begins[-1:]]).astype(np.int64)),
        pa.py_buffer(b"".join(raws)))
    return pa.ListArray.from_arrays(pa.array(np.searchsorted(heads, ends), pa.int32()), pieces.cast(pa.string()))


def content_sentences(text: Column, words: int = WORDS) -> Column:
    """``content_pieces`` of a text (``words`` counts nothing here)."""
    return F.arrow_udf(content_pieces, "array<string>")(text)


def _hashes(sents: Column, seed: int) -> Column:
    return F.transform(sents, lambda s: F.xxhash64(F.lit(seed), F.btrim(s, F.lit(WHITE))))


def _spans(span: int) -> Column:
    """(a, b) hashes of every run of ``span`` entries of ``ha`` and ``hb``, in order."""
    def run(hashes: str, k: Column) -> Column:
        return F.xxhash64(*(F.get(F.col(hashes), k + j) for j in range(span)))

    places = F.when(F.size("ha") >= span, F.sequence(F.lit(0), F.size("ha") - span)).otherwise(
        F.array().cast("array<int>"))
    return F.transform(places, lambda k: F.struct(run("ha", k).alias("a"), run("hb", k).alias("b")))


def repeated_sentences(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", span: int = SPAN,
                       words: int = WORDS, cut: Callable[..., Column] = sentences) -> DataFrame:
    """(doc_id, h, places): the sentences of each document that a non-first
    repeated span covers; ``h`` is the hash of the text."""
    base = docs.select(F.col(id_col).cast("long").alias("doc_id"), text_of(text_col).alias("text"))
    runs = (base.select("doc_id", F.xxhash64("text").alias("h"), cut(F.col("text"), words).alias("s"))
            .select("doc_id", "h", "s", _hashes(F.col("s"), 1).alias("ha"), _hashes(F.col("s"), 2).alias("hb"))
            .select("doc_id", "h", F.posexplode(_spans(span)).alias("at", "x"))
            .select("doc_id", "h", "at", "x.a", "x.b"))
    rank = F.struct(id_last().alias("id"), F.col("h"), F.col("at"))
    many = (runs.groupBy("a", "b").agg(F.min(rank).alias("first"), F.max(rank).alias("last"))
            .filter(F.col("first") != F.col("last")).select(F.col("a").alias("ra"), F.col("b").alias("rb"), "first"))
    later = runs.join(many, (runs["a"] == many["ra"]) & (runs["b"] == many["rb"])).filter(rank != F.col("first"))
    return (later.groupBy("doc_id", "h").agg(F.collect_set("at").alias("starts"))
            .select("doc_id", "h", F.array_distinct(F.flatten(F.transform(
                "starts", lambda k: F.sequence(k, k + span - 1)))).alias("places")))


def _rebuilt(batches):
    """Kept and removed text of every document from its sentences and marked places."""
    for batch in batches:
        kept, removed, total, out = [], [], [], []
        for sents, places in zip(batch.column(1).to_pylist(), batch.column(2).to_pylist()):
            marked = set(places or ())
            kept.append("".join(s for k, s in enumerate(sents) if k not in marked))
            removed.append("".join(s for k, s in enumerate(sents) if k in marked))
            total.append(len(sents))
            out.append(len(marked))
        yield pa.RecordBatch.from_pydict({
            "doc_id": batch.column(0), "n_sentences": pa.array(total, pa.int64()),
            "n_removed": pa.array(out, pa.int64()), "kept_text": pa.array(kept, pa.string()),
            "removed_text": pa.array(removed, pa.string())})


def remove_repeated_spans(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", span: int = SPAN,
                          words: int = WORDS, cut: Callable[..., Column] = sentences) -> DataFrame:
    """One row per document: doc_id, n_sentences, n_removed, kept_text, removed_text."""
    hits = repeated_sentences(docs, id_col, text_col, span, words, cut).select(
        F.col("doc_id").alias("hit_id"), F.col("h").alias("hit_h"), "places")
    base = docs.select(F.col(id_col).cast("long").alias("doc_id"), text_of(text_col).alias("text")).withColumn(
        "h", F.xxhash64("text"))
    both = base.join(hits, base["doc_id"].eqNullSafe(hits["hit_id"]) & (base["h"] == hits["hit_h"]), "left")
    return both.select("doc_id", cut(F.col("text"), words).alias("s"), "places").mapInArrow(
        per_partition(_rebuilt), "doc_id long, n_sentences long, n_removed long, kept_text string, removed_text string")
