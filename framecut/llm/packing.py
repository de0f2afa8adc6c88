"""Packing token sequences by cutting-stock column generation.

1. Every document is encoded once.  Its ids are cut into full sequences of
   ``capacity`` ids, half a sequence if as much is left (pieces beyond half
   cannot be combined), a body (the largest multiple of ``GRAIN`` that is
   left) and a tail of under ``GRAIN`` ids, so there are fewer than
   ``capacity / GRAIN / 2 + GRAIN + 2`` different piece lengths.
2. The histogram of piece lengths (that many rows at most) goes to the driver.
   For bodies and for tails a linear program chooses how often each pattern of
   lengths is used; columns are priced by an unbounded knapsack, solved by
   dynamic programming over the capacity with the duals as values.
3. Pattern counts are rounded down; what is left over is packed largest first.
4. Pieces of a length are ranked (number of the task, place in it), and rank k
   takes slot k of that length.  Ranks need counts per task and length only:
   no task sees all pieces of a length, however many share it.

Defined results: a null or empty text is the end id alone; repeated rows are
packed one by one; an empty table gives no pieces.
"""

from __future__ import annotations

import zlib

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .common import cut, per_partition, small, text_of
from .tokens import END_ID, encoder, forget, portions, with_end

CAPACITY = 4096
#: Bodies are multiples of this many ids.
GRAIN = 16
#: Pieces of text that a task remembers the ids of.
REMEMBERED = 300_000


def cut_lengths(n: int, capacity: int = CAPACITY, grain: int = GRAIN) -> list[int]:
    """Lengths of a document's pieces: full sequences, half a sequence, body, tail."""
    half = capacity // 2
    rest = n % half
    return ([capacity] * (n // capacity) + [half] * (n % capacity // half)
            + [x for x in (rest - rest % grain, rest % grain) if x])


def _pieces(batches, path: str, end: int, capacity: int, grain: int, with_ids: bool):
    """Pieces with checksums; ``idx`` numbers the pieces of a length in this task."""
    enc, part, seen = encoder(path, REMEMBERED), TaskContext.get().partitionId(), {}
    for batch in batches:
        for some in portions(batch, 1):
            ids, n = with_end(*enc.encode(some.column(1)), end)
            raw = memoryview(ids.astype("<u4").view(np.uint8))
            owner, start, length, idx, crc, total, blobs, place = [], [], [], [], [], [], [], 0
            for k, tokens in enumerate(n.tolist()):
                inside = 0
                for piece in cut_lengths(tokens, capacity, grain):
                    view = raw[4 * (place + inside):4 * (place + inside + piece)]
                    owner.append(k)
                    start.append(inside)
                    length.append(piece)
                    crc.append(zlib.crc32(view))
                    total.append(tokens)
                    idx.append(seen.get(piece, 0))
                    seen[piece] = idx[-1] + 1
                    if with_ids:
                        blobs.append(bytes(view))
                    inside += piece
                place += tokens
            columns = {
                "doc_id": some.column(0).take(pa.array(owner, pa.int64())), "start": pa.array(start, pa.int64()),
                "length": pa.array(length, pa.int64()), "ids_crc32": pa.array(crc, pa.int64()),
                "doc_tokens": pa.array(total, pa.int64()), "part": pa.array([part] * len(idx), pa.int32()),
                "idx": pa.array(idx, pa.int64())}
            if with_ids:
                columns["ids"] = pa.array(blobs, pa.binary())
            yield pa.RecordBatch.from_pydict(columns)
    forget()


def best_pattern(lengths: np.ndarray, values: np.ndarray, capacity: int) -> tuple[float, np.ndarray]:
    """Unbounded knapsack: (value, copies of each length) of the most valuable pattern."""
    best = np.zeros(capacity + 1)
    took = np.full(capacity + 1, -1)
    for room in range(1, capacity + 1):
        fits = np.searchsorted(lengths, room, side="right")  # lengths ascend
        best[room] = best[room - 1]
        if fits:
            with_item = best[room - lengths[:fits]] + values[:fits]
            k = int(np.argmax(with_item))
            if with_item[k] > best[room] + 1e-12:
                best[room], took[room] = with_item[k], k
    copies, room = np.zeros(len(lengths), np.int64), capacity
    while room > 0:
        if took[room] < 0:
            room -= 1
        else:
            copies[took[room]] += 1
            room -= lengths[took[room]]
    return float(best[capacity]), copies


def column_generation(lengths: np.ndarray, demand: np.ndarray, capacity: int,
                      steps_per_length: int = 12) -> list[tuple[np.ndarray, float]]:
    """(pattern, times used) of the linear program's basis.

    Minimise the number of sequences so that the patterns meet the demand.
    Revised simplex from one single-length pattern per length; every basis on
    the way is feasible, so ``steps_per_length`` bounds time, not correctness.
    """
    m = len(lengths)
    patterns = np.diag(capacity // lengths).astype(float)
    inverse = np.diag(1 / np.diag(patterns))
    used = inverse @ demand
    for _ in range(steps_per_length * m):
        prices = inverse.sum(axis=0)
        value, copies = best_pattern(lengths, prices, capacity)
        if value <= 1 + 1e-7:
            break
        column = inverse @ copies
        ratio = np.where(column > 1e-9, used / np.where(column > 1e-9, column, 1), np.inf)
        out = int(np.argmin(ratio))
        step = ratio[out]
        used = used - step * column
        used[out] = step
        pivot = inverse[out] / column[out]
        inverse = inverse - np.outer(column, pivot)
        inverse[out] = pivot
        patterns[:, out] = copies
    return [(patterns[:, k].round().astype(np.int64), float(used[k])) for k in range(m) if used[k] > 1e-9]


def rounded(lengths: np.ndarray, demand: np.ndarray, basis: list[tuple[np.ndarray, float]]):
    """Patterns used whole numbers of times, and the demand that is left."""
    left, out = demand.copy(), []
    for copies, times in basis:
        whole = int(times + 1e-6)
        needed = copies > 0
        whole = min(whole, int((left[needed] // copies[needed]).min())) if needed.any() else 0
        if whole:
            out.append((dict(zip(lengths[needed].tolist(), copies[needed].tolist())), whole))
            left = left - whole * copies
    return out, left


def largest_first(left: dict[int, int], capacity: int):
    """Patterns for a few left-over pieces, the largest that fits first."""
    left, out = {k: v for k, v in sorted(left.items(), reverse=True) if v}, []
    while left:
        pattern, room = {}, capacity
        for length, n in left.items():
            if take := min(n, room // length):
                pattern[length] = take
                room -= take * length
        times = min(left[k] // v for k, v in pattern.items())
        out.append((pattern, times))
        left = {k: n for k, v in left.items() if (n := v - times * pattern.get(k, 0))}
    return out


def plan(histogram: dict[int, int], capacity: int = CAPACITY, grain: int = GRAIN) -> list[tuple[dict[int, int], int]]:
    """(pattern: copies by length, times used), together exactly the histogram."""
    out = [({capacity: 1}, histogram[capacity])] if histogram.get(capacity) else []
    left: dict[int, int] = {}
    for unit, wanted in ((grain, [k for k in histogram if k % grain == 0 and k < capacity]),
                         (1, [k for k in histogram if k % grain])):
        if not wanted:
            continue
        lengths = np.array(sorted(wanted))
        demand = np.array([histogram[k] for k in lengths.tolist()])
        basis = column_generation(lengths // unit, demand, capacity // unit)
        used, rest = rounded(lengths, demand, basis)
        out += used
        left |= dict(zip(lengths.tolist(), rest.tolist()))
    return out + largest_first(left, capacity)


def slots(patterns: list[tuple[dict[int, int], int]]) -> dict[int, tuple[np.ndarray, ...]]:
    """Per length, arrays by pattern that has it: slots before the pattern, copies
    per sequence, first sequence, offset of the first copy."""
    out: dict[int, list[list[int]]] = {}
    first = 0
    for pattern, times in patterns:
        offset = 0
        for length, copies in sorted(pattern.items(), reverse=True):
            rows = out.setdefault(length, [])
            before = rows[-1][0] + rows[-1][4] if rows else 0
            rows.append([before, copies, first, offset, copies * times])
            offset += length * copies
        first += times
    return {k: tuple(np.array(v, np.int64).T[:4]) for k, v in out.items()}


def _assign(batches, table: dict):
    """sequence_id and offset of every piece, by its rank among the pieces of its length."""
    for batch in batches:
        length = batch.column("length").to_numpy()
        rank = batch.column("rank").to_numpy()
        sequence, offset = np.empty(len(length), np.int64), np.empty(len(length), np.int64)
        for value in np.unique(length).tolist():
            mine = length == value
            before, copies, first, at = table[value]
            k = np.searchsorted(before, rank[mine], side="right") - 1
            inside = rank[mine] - before[k]
            sequence[mine] = first[k] + inside // copies[k]
            offset[mine] = at[k] + inside % copies[k] * value
        yield pa.RecordBatch.from_arrays(
            [*batch.columns[:-1], pa.array(sequence), pa.array(offset)],
            names=[*batch.schema.names[:-1], "sequence_id", "offset"])


def pack(docs: DataFrame, tokenizer: str, id_col: str = "doc_id", text_col: str = "text", end: int = END_ID,
         capacity: int = CAPACITY, grain: int = GRAIN, with_ids: bool = False) -> DataFrame:
    """One row per piece: doc_id, start, length, ids_crc32, doc_tokens, (ids,) sequence_id, offset.

    ``with_ids`` adds the piece's ids (little-endian 32-bit) as a binary column.
    """
    schema = "doc_id long, start long, length long, ids_crc32 long, doc_tokens long, part int, idx long"
    pieces = cut(docs.select(F.col(id_col).cast("long").alias("doc_id"), text_of(text_col).alias("text")).mapInArrow(
        per_partition(_pieces, tokenizer, end, capacity, grain, with_ids), schema + ", ids binary" * with_ids))
    per_task = cut(pieces.groupBy("length", "part").agg(F.count("*").alias("n")))
    histogram = {r["length"]: r["n"] for r in per_task.groupBy("length").agg(F.sum("n").alias("n")).collect()}
    table = slots(plan(histogram, capacity, grain))
    before = Window.partitionBy("length").orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    base = per_task.select("length", "part", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("base"))
    columns = ["doc_id", "start", "length", "ids_crc32", "doc_tokens"] + ["ids"] * with_ids
    ranked = pieces.join(small(base, 64), ["length", "part"]).select(
        *columns, (F.col("base") + F.col("idx")).alias("rank"))
    return ranked.mapInArrow(
        per_partition(_assign, table),
        "doc_id long, start long, length long, ids_crc32 long, doc_tokens long" + ", ids binary" * with_ids
        + ", sequence_id long, offset long")
