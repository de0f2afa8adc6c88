"""Token ids in binary shards: a wavelet matrix for each shard.

Documents are dealt by ranges of their id, sorted, encoded, and written in
shards of about ``SHARD_TOKENS`` ids.  A shard is one record of a Parquet
table (Spark's writer commits it, so a lost executor leaves nothing half
written and any store that Spark reaches will do):

* ``part``, ``seq``: order of the shards (partition, place in it);
* ``n_tokens``; ``doc_ids``, ``doc_tokens``: the documents in it, 64-bit, and
  their numbers of ids;
* ``blob``: the file.  Magic ``WMX2``, number of ids (64-bit), number of levels
  (32-bit), then per level: zeros (64-bit), length of the zstd-compressed
  plane (32-bit; 0: stored as it is), the bits of the plane, most significant
  bit level first, and its rank directory: the set bits before every 4,096th
  place (64-bit each), then those since that place before every 512th one
  (16-bit each).  The directory adds about a twentieth to the raw planes.

``WaveletMatrix`` opens one blob and answers access, rank (count of an id
before a place) and select (place of its k-th occurrence) from the planes and
the stored directories without decoding the ids: a rank counts bits in one
block of 64 bytes per level, a select searches the directory on its way up.
``all`` decodes a whole shard, as the registered query does.

Documents are dealt by ranges of (id, first characters, hash of the text), so
rows that repeat an id or have none are spread over tasks.

Defined results: a null text holds the end id only; null ids come first;
documents that repeat an id keep one row each, in the order of their first
``START_CHARS`` characters, then of the hash of their text.
"""

from __future__ import annotations

import struct
import zlib
from bisect import bisect_right

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from .common import per_partition, shards, table_path, text_of
from .tokens import END_ID, PORTION, encoder, portions, with_end

SHARD_TOKENS = 4_000_000
MAGIC = b"WMX2"
#: Places per count of the rank directory: far ones 64-bit, near ones 16-bit.
FAR, NEAR = 4096, 512
#: Characters of a text that order documents with the same id.
START_CHARS = 64
#: Planes are compressed only where this saves a sixteenth at least.
_WORTH = 16


def planes_of(ids: np.ndarray, levels: int) -> list[tuple[int, np.ndarray]]:
    """(zeros, packed bits) per level, most significant bit first."""
    out = []
    rest = ids.astype(np.uint16 if levels <= 16 else np.uint32)
    for level in range(levels - 1, -1, -1):
        bits = (rest >> level & 1).view(np.uint16 if levels <= 16 else np.uint32).astype(bool)
        low = rest[~bits]
        out.append((len(low), np.packbits(bits, bitorder="little")))
        rest = np.concatenate([low, rest[bits]])
    return out


def directory_of(bits: np.ndarray, n: int) -> tuple[np.ndarray, np.ndarray]:
    """The set bits of a plane before every ``FAR`` places, and those since that
    place before every ``NEAR``; both for places 0 to ``n``."""
    whole = np.zeros((n // FAR + 1) * FAR // 8, np.uint8)
    whole[:len(bits)] = bits
    blocks = np.bitwise_count(whole.view(np.uint64)).reshape(-1, FAR // NEAR, NEAR // 64).sum(axis=2, dtype=np.int64)
    upto = np.cumsum(blocks, axis=1)
    far = np.concatenate([[0], np.cumsum(upto[:-1, -1])])
    return far.astype("<u8"), (upto - blocks).astype("<u2").ravel()[:n // NEAR + 1]


def _squeezed(raw: bytes) -> bytes:
    return pa.compress(raw, codec="zstd", asbytes=True)


def write_blob(ids: np.ndarray) -> bytes:
    """The file of one shard."""
    levels = max(1, int(ids.max()).bit_length()) if len(ids) else 1
    out = [MAGIC, struct.pack("<QI", len(ids), levels)]
    for zeros, bits in planes_of(ids, levels):
        raw = bits.tobytes()
        sample = raw[:65536]
        thin = len(_squeezed(sample)) * (1 + 1 / _WORTH) < len(sample)
        packed = _squeezed(raw) if thin else b""
        far, near = directory_of(bits, len(ids))
        out += [struct.pack("<QI", zeros, len(packed)), packed or raw, far.tobytes(), near.tobytes()]
    return b"".join(out)


class WaveletMatrix:
    """Access, rank and select over the planes of one shard."""

    def __init__(self, blob: bytes):
        if blob[:4] != MAGIC:
            raise ValueError("not a wavelet matrix")
        self.n, self.levels = struct.unpack_from("<QI", blob, 4)
        at, size = 16, (self.n + 7) // 8
        fars, nears = self.n // FAR + 1, self.n // NEAR + 1
        self.zeros, self.planes, self.far, self.near = [], [], [], []
        for _ in range(self.levels):
            zeros, packed = struct.unpack_from("<QI", blob, at)
            at += 12
            raw = pa.decompress(blob[at:at + packed], size, codec="zstd", asbytes=True) if packed else blob[at:at + size]
            at += packed or size
            self.zeros.append(zeros)
            self.planes.append(np.frombuffer(raw, np.uint8))
            self.far.append(np.frombuffer(blob, "<u8", fars, at))
            self.near.append(np.frombuffer(blob, "<u2", nears, at + 8 * fars))
            at += 8 * fars + 2 * nears

    def all(self) -> np.ndarray:
        """Every id, level by level from the lowest bit up."""
        kind = np.uint16 if self.levels <= 16 else np.uint32
        rest = np.zeros(self.n, kind)
        for k in range(self.levels - 1, -1, -1):
            bits = np.unpackbits(self.planes[k], count=self.n, bitorder="little").view(bool)
            up = np.empty(self.n, kind)
            up[~bits] = rest[:self.zeros[k]]
            up[bits] = rest[self.zeros[k]:] | kind(1 << self.levels - 1 - k)
            rest = up
        return rest.astype(np.uint32)

    def _ones(self, level: int, at: int) -> int:
        """Set bits of a level before a place: the directory and part of one block."""
        block = at // NEAR
        part = int.from_bytes(self.planes[level][block * NEAR // 8:(at + 7) // 8].tobytes(), "little")
        part &= (1 << at - block * NEAR) - 1
        return int(self.far[level][at // FAR]) + int(self.near[level][block]) + part.bit_count()

    def _place(self, level: int, bit: int, k: int) -> int:
        """Where the k-th (from 0) bit of that value lies in a level that has it."""
        far, near = self.far[level], self.near[level]

        def before(block: int) -> int:
            ones = int(far[block * NEAR // FAR]) + int(near[block])
            return ones if bit else block * NEAR - ones

        block = bisect_right(range(len(near)), k, key=before) - 1
        bits = np.unpackbits(self.planes[level][block * NEAR // 8:(block + 1) * NEAR // 8], bitorder="little")
        return block * NEAR + int(np.flatnonzero(bits == bit)[k - before(block)])

    def access(self, at: int) -> int:
        """The id at a place."""
        if not 0 <= at < self.n:
            raise IndexError(at)
        value = 0
        for k in range(self.levels):
            bit = int(self.planes[k][at >> 3]) >> (at & 7) & 1
            ones = self._ones(k, at)
            at = self.zeros[k] + ones if bit else at - ones
            value = value << 1 | bit
        return value

    def rank(self, value: int, upto: int) -> int:
        """How often an id occurs before a place."""
        if value >> self.levels:
            return 0
        low, high = 0, min(upto, self.n)
        for k in range(self.levels):
            a, b = self._ones(k, low), self._ones(k, high)
            if value >> self.levels - 1 - k & 1:
                low, high = self.zeros[k] + a, self.zeros[k] + b
            else:
                low, high = low - a, high - b
        return high - low

    def select(self, value: int, k: int) -> int:
        """Place of the k-th (from 0) occurrence of an id, -1 if there is none."""
        if not 0 <= k < self.rank(value, self.n):
            return -1
        at = 0  # where the id's places begin below the last level
        for level in range(self.levels):
            ones = self._ones(level, at)
            at = self.zeros[level] + ones if value >> self.levels - 1 - level & 1 else at - ones
        at += k
        for level in range(self.levels - 1, -1, -1):
            bit = value >> self.levels - 1 - level & 1
            at = self._place(level, bit, at - self.zeros[level] if bit else at)
        return at


def _shard_rows(batches, path: str, end: int, shard_tokens: int, at_once: int):
    """Shards of a partition's documents, in the order they arrive."""
    enc, part, seq = encoder(path), TaskContext.get().partitionId(), 0
    held: list[tuple[np.ndarray, np.ndarray, pa.Array]] = []

    def shard():
        ids = np.concatenate([h[0] for h in held])
        sizes = np.concatenate([h[1] for h in held])
        docs = pa.concat_arrays([h[2] for h in held])
        return pa.RecordBatch.from_pydict({
            "part": pa.array([part], pa.int32()), "seq": pa.array([seq], pa.int32()),
            "n_tokens": pa.array([len(ids)], pa.int64()),
            "doc_ids": pa.array([docs.to_pylist()], pa.list_(pa.int64())),
            "doc_tokens": pa.array([sizes], pa.list_(pa.int64())),
            "blob": pa.array([write_blob(ids)], pa.binary())})

    for batch in batches:
        for some in portions(batch, 1, at_once):
            ids, n = with_end(*enc.encode(some.column(1)), end)
            held.append((ids, n, some.column(0)))
            if sum(len(h[0]) for h in held) >= shard_tokens:
                yield shard()
                held, seq = [], seq + 1
    if held:
        yield shard()


def write_shards(docs: DataFrame, out: str, tokenizer: str, id_col: str = "doc_id", text_col: str = "text",
                 end: int = END_ID, shard_tokens: int = SHARD_TOKENS, at_once: int = PORTION) -> None:
    """Encode ``docs`` and write the shards, ascending by id, to ``out``; a shard
    ends when another ``at_once`` bytes of text have filled it."""
    keys = ["doc_id", "first", "hash"]
    dealt = (docs.select(F.col(id_col).cast("long").alias("doc_id"), text_of(text_col).alias("text"))
             .withColumn("first", F.left("text", F.lit(START_CHARS))).withColumn("hash", F.xxhash64("text"))
             .repartitionByRange(shards(docs.sparkSession), *keys).sortWithinPartitions(*keys))
    dealt.select("doc_id", "text").mapInArrow(
        per_partition(_shard_rows, tokenizer, end, shard_tokens, at_once),
        "part int, seq int, n_tokens long, doc_ids array<long>, doc_tokens array<long>, blob binary",
    ).write.option("compression", "uncompressed").parquet(out)


def _documents(batches):
    """Per document of the shards: its place in the shard, length and checksum."""
    for batch in batches:
        for k in range(batch.num_rows):
            row = batch.slice(k, 1)
            sizes = row.column("doc_tokens").flatten().to_numpy()
            raw = WaveletMatrix(row.column("blob")[0].as_py()).all().astype("<u4")
            upto = np.cumsum(sizes)
            view = memoryview(raw.view(np.uint8))
            crc = [zlib.crc32(view[4 * (e - s):4 * e]) for e, s in zip(upto.tolist(), sizes.tolist())]
            yield pa.RecordBatch.from_pydict({
                "part": pa.repeat(row.column("part")[0], len(sizes)),
                "seq": pa.repeat(row.column("seq")[0], len(sizes)),
                "doc_id": row.column("doc_ids").flatten(), "inside": pa.array(upto - sizes, pa.int64()),
                "n_tokens": pa.array(sizes, pa.int64()), "ids_crc32": pa.array(crc, pa.int64())})


def read_documents(spark: SparkSession, path: str) -> DataFrame:
    """Read the shards back: doc_id, start, n_tokens, ids_crc32 per document.

    ``start`` adds the shards before a shard in two steps (inside its
    partition, then over partitions), so no task sees all shards.
    """
    table = spark.read.parquet(path)
    sizes = table.select("part", "seq", "n_tokens")
    inside = Window.partitionBy("part").orderBy("seq").rowsBetween(Window.unboundedPreceding, -1)
    parts = sizes.groupBy("part").agg(F.sum("n_tokens").alias("all"))
    before = Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    base = (sizes.withColumn("near", F.coalesce(F.sum("n_tokens").over(inside), F.lit(0)))
            .join(parts.withColumn("far", F.coalesce(F.sum("all").over(before), F.lit(0))), "part")
            .select("part", "seq", (F.col("near") + F.col("far")).alias("base")))
    found = table.select("part", "seq", "doc_ids", "doc_tokens", "blob").mapInArrow(
        per_partition(_documents), "part int, seq int, doc_id long, inside long, n_tokens long, ids_crc32 long")
    return found.join(base, ["part", "seq"]).select(
        "doc_id", (F.col("base") + F.col("inside")).alias("start"), "n_tokens", "ids_crc32")


def _postings(batches, value: int):
    for batch in batches:
        for row in batch.to_pylist():
            matrix = WaveletMatrix(row["blob"])
            upto = np.cumsum(row["doc_tokens"])
            places = [matrix.select(value, k) for k in range(matrix.rank(value, matrix.n))]
            owner = np.searchsorted(upto, places, side="right")
            ids = [row["doc_ids"][k] for k in owner]
            first = [int(upto[k]) - row["doc_tokens"][k] for k in owner]
            yield pa.RecordBatch.from_pydict({
                "doc_id": pa.array(ids, pa.int64()),
                "at": pa.array([p - f for p, f in zip(places, first)], pa.int64())})


def occurrences(spark: SparkSession, path: str, value: int) -> DataFrame:
    """Where a token id occurs: (doc_id, place in the document), by rank and select."""
    return spark.read.parquet(path).select("doc_ids", "doc_tokens", "blob").mapInArrow(
        per_partition(_postings, value), "doc_id long, at long")


def token_file_documents(docs: DataFrame, tokenizer: str) -> DataFrame:
    """Write the shards to the shared folder and read every document back."""
    spark = docs.sparkSession
    out = table_path(spark, "token-shards")
    write_shards(docs, out, tokenizer)
    return read_documents(spark, out)
