"""SimHash near-duplicates by covering locality-sensitive hashing.

Fingerprint: 64 bits; a bit is set if it is set in more than half of the
XXH64 values (seed 42) of the document's word shingles.

Tables: bit i carries the code vector ``i mod (2^(r+1) - 1) + 1`` of r + 1
bits.  Table v (1 .. 2^(r+1) - 1) keeps the bits whose code vector has an odd
product with v.  Any r differing bits have r code vectors, and some v other
than 0 is orthogonal to all of them, so the pair agrees on every bit that
table v keeps: a pair within the radius always collides.  The bits that a
table leaves free are dealt into r + 1 blocks; a pair with at most r
differing bits agrees on one block as well, so the key of a bucket is the
table, a block, and the fingerprint under both masks.

Only different fingerprints enter the tables.  A bucket emits a spanning
forest of its pairs within the radius, never the pairs, and a large bucket
is split again and again by blocks of the bits that still vary in it.

Defined results: no words (null or empty text): fingerprint 0, linked like
any other; fewer words than a shingle: the whole sequence is the shingle; a
component of null ids only has a null id; repeated rows keep one row each.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import connected_components, cut, fresh, id_last, per_partition, text_of

SHINGLE = 3
RADIUS = 2
SEED = 42
_LOWER = bytes(range(65)) + bytes(range(97, 123)) + bytes(range(91, 256))
_ALL = (1 << 64) - 1
#: Buckets up to this size compare all their fingerprints inside the task.
_DIRECT = 256


def fingerprint(text: bytes, size: int = SHINGLE) -> int:
    """SimHash of a UTF-8 text (A-Z lower-cased, words cut at ASCII white space)."""
    from xxhash import xxh64_intdigest
    words = text.translate(_LOWER).split()
    if not words:
        return 0
    joined = b" ".join(words)
    ends, at = [], -1
    for word in words:
        at += len(word) + 1
        ends.append(at)
    if len(words) <= size:
        pairs = [(0, len(joined))]
    else:
        pairs = list(zip([0] + [e + 1 for e in ends[:len(words) - size]], ends[size - 1:]))
    hashes = np.fromiter((xxh64_intdigest(joined[a:b], SEED) for a, b in pairs), np.uint64, len(pairs))
    ones = np.zeros(64, np.int64)
    for k in range(0, len(hashes), 8192):
        some = hashes[k:k + 8192].view(np.uint8)
        ones += np.unpackbits(some, bitorder="little").reshape(-1, 64).sum(axis=0, dtype=np.int64)
    return int(np.packbits(ones * 2 > len(hashes), bitorder="little").view(np.uint64)[0])


def _fingerprints(batches, size: int):
    for batch in batches:
        texts = batch.column(1).cast(pa.binary()).to_pylist()
        prints = np.array([fingerprint(t, size) for t in texts], np.uint64).view(np.int64)
        yield pa.RecordBatch.from_pydict({"doc_id": batch.column(0), "h": batch.column(2), "fp": pa.array(prints, pa.int64())})


def fingerprints(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", size: int = SHINGLE) -> DataFrame:
    """(doc_id, h, fp): the hash of the text and the fingerprint of every document as 64-bit integers."""
    return docs.select(F.col(id_col).cast("long").alias("doc_id"), text_of(text_col).alias("text"),
                       F.xxhash64(text_of(text_col)).alias("h")).mapInArrow(
        per_partition(_fingerprints, size), "doc_id long, h long, fp long")


def bucket_masks(radius: int) -> list[int]:
    """Masks of the bits that a bucket's fingerprints share, table by table."""
    tables = (1 << radius + 1) - 1
    masks = []
    for v in range(1, tables + 1):
        kept = [i for i in range(64) if ((i % tables + 1) & v).bit_count() & 1]
        free = [i for i in range(64) if i not in set(kept)]
        for block in range(radius + 1):
            masks.append(sum(1 << i for i in kept + free[block::radius + 1]))
    return masks


def _signed(x: int) -> int:
    return x - (1 << 64) if x >> 63 else x


def _bucket_keys(radius: int) -> Column:
    return F.array(*(F.xxhash64(F.lit(k), F.col("fp").bitwiseAND(F.lit(_signed(m))))
                     for k, m in enumerate(bucket_masks(radius))))


def close_pairs(prints: np.ndarray, radius: int) -> list[tuple[int, int]]:
    """Pairs (indices) that connect different fingerprints as all pairs within the radius do."""
    if len(prints) <= _DIRECT:
        near = np.bitwise_count(prints[:, None] ^ prints[None, :]) <= radius
        a, b = np.nonzero(np.triu(near, 1))
        return _forest(len(prints), zip(a.tolist(), b.tolist()))
    varying = int(np.bitwise_or.reduce(prints ^ prints[0]))
    bits = [i for i in range(64) if varying >> i & 1]
    links = []
    for block in range(radius + 1):
        key = prints & np.uint64(sum(1 << i for i in bits[block::radius + 1]))
        order = np.argsort(key, kind="stable")
        edges = np.flatnonzero(np.diff(key[order])) + 1
        for group in np.split(order, edges):
            if len(group) > 1:
                links += [(int(group[a]), int(group[b])) for a, b in close_pairs(prints[group], radius)]
    return _forest(len(prints), links)


def _forest(n: int, links) -> list[tuple[int, int]]:
    """The links that join something (union by smaller index)."""
    root = list(range(n))

    def top(x: int) -> int:
        while root[x] != x:
            root[x] = x = root[root[x]]
        return x

    kept = []
    for a, b in links:
        x, y = top(a), top(b)
        if x != y:
            root[max(x, y)] = min(x, y)
            kept.append((a, b))
    return kept


def _bucket_links(batches, radius: int):
    """Links inside the buckets of a partition."""
    held = [(b.column(0).to_numpy(), b.column(1).to_numpy()) for b in batches if b.num_rows]
    if not held:
        return
    key = np.concatenate([h[0] for h in held])
    fp = np.concatenate([h[1] for h in held]).view(np.uint64)
    held.clear()
    order = np.argsort(key)
    key, fp = key[order], fp[order]
    starts = np.concatenate([[0], np.flatnonzero(np.diff(key)) + 1, [len(key)]])
    size = np.diff(starts)
    for at, n in zip(starts[:-1][size > 1].tolist(), size[size > 1].tolist()):
        prints = np.sort(fp[at:at + n])
        links = close_pairs(prints, radius)
        if links:
            pair = prints[np.array(links)].view(np.int64)
            yield pa.RecordBatch.from_pydict({"a": pa.array(pair[:, 0]), "b": pa.array(pair[:, 1])})


def _components(prints: DataFrame, radius: int) -> tuple[DataFrame, DataFrame]:
    """(fp, component) of every fingerprint, and (component, least): the smallest (id, text hash)
    that links lead to."""
    rank = F.struct(id_last().alias("id"), F.col("h"))
    different = cut(prints.groupBy("fp").agg(F.min(rank).alias("first")))
    links = (different.select(F.explode(_bucket_keys(radius)).alias("key"), "fp").repartition("key")
             .mapInArrow(per_partition(_bucket_links, radius), "a long, b long"))
    parts = connected_components(links)
    linked = different.join(parts, different["fp"] == parts["node"], "left").select(
        "fp", "first", F.coalesce("component", "fp").alias("component"))
    return linked.select("fp", "component"), linked.groupBy("component").agg(F.min("first").alias("least"))


def near_duplicates(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", size: int = SHINGLE,
                    radius: int = RADIUS) -> DataFrame:
    """(doc_id, fp, component_id): documents linked within ``radius`` bits.

    ``component_id`` is the smallest id that links lead to.
    """
    prints = cut(fingerprints(docs, id_col, text_col, size))
    linked, smallest = _components(prints, radius)
    named = linked.join(smallest, "component").select(
        F.col("fp").alias("__fp"), F.col("least.id.id").alias("component_id"))
    return prints.join(named, prints["fp"] == named["__fp"]).select("doc_id", "fp", "component_id")


def drop_near_duplicates(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One document of each component, the one with the smallest id, with all its columns.

    Of different texts with that id the one with the smallest hash stays, of
    rows that repeat id and text one.
    """
    h, n, kept_id, kept_h = fresh(docs, "__h", "__n", "__id", "__kept")
    kept = _components(cut(fingerprints(docs, id_col, text_col)), RADIUS)[1].select(
        F.col("least.id.id").alias(kept_id), F.col("least.h").alias(kept_h))
    marked = docs.withColumn(h, F.xxhash64(text_of(text_col)))
    stay = marked.join(kept, (marked[h] == kept[kept_h]) & marked[id_col].cast("long").eqNullSafe(kept[kept_id]),
                       "left_semi")
    same = Window.partitionBy(h, id_col).orderBy(h)
    return stay.withColumn(n, F.row_number().over(same)).filter(F.col(n) == 1).select(*docs.columns)
