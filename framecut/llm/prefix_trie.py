"""Prefix trie of conversations that are rebuilt from another's head and their own rest.

A rebuilt conversation is the first ``h`` stored turns of its base followed by
its own turns after the first ``h``.  It is never materialised.  Fingerprints
are elements (hash, length) of the monoid of polynomial products: every stored
conversation has running products of its turns, a slice of turns is a quotient
of two of them, and a rebuilt prefix is head times slice.  A prefix is a row of
numbers (fingerprint, fingerprint of its parent, reference to its last turn).

Prefix groups are verified: the references of a group's last turns (128 bits
of a SHA-256 that the fingerprints do not use) are all equal, and so are the
parents' fingerprints; by induction all turns are.  Should a group fail, the
products are taken again with another base.

Sums over subtrees need no pass per level.  A node belongs to its smallest
member; running sums of the nodes a conversation owns, from its end to each
depth, add up over a node's members to the sum over its subtree.

Bounded by design: base and members of a block stream past in order; group
sums are combined before the shuffle; the list of ids behind ``ends_sha256``
streams through the hash in sorted order; parents with more than a
``1 / HOT`` of all nodes as children are broadcast (at most HOT rows).

Defined results: rows are ordered by turn (null first), then role, then
SHA-256 of role and text; null role or text is empty; a null conversation id
has no base, comes after all numbers and is left out of ``ends_sha256``;
repeated rows are turns of their own; an empty table gives no node, not even a
root; other columns are ignored.
"""

from __future__ import annotations

import hashlib

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import cut, per_partition

#: Conversations per block; the base is the block's first id.
BLOCK = 20
#: Most turns that come from the base, less one.
HEADS = 4
#: Parents with more than a 1 / HOT of all nodes as children are broadcast.
HOT = 4096
#: Modulus of the products (a Mersenne prime) and the bases, tried in order.
PRIME = (1 << 127) - 1
BASES = tuple(int.from_bytes(hashlib.sha256(f"base {k}".encode()).digest()[:15], "big") for k in range(4))
EMPTY_SHA256 = hashlib.sha256(b"").hexdigest()
WORD = r"[^\x20\x09-\x0D]+"
NODE = ["depth", "f1", "f2"]


class Product:
    """An element of the monoid: the hash of a run of turns, and base ** length."""

    __slots__ = ("hash", "shift")

    def __init__(self, value: int = 0, shift: int = 1):
        self.hash, self.shift = value, shift

    def __mul__(self, other: "Product") -> "Product":
        return Product((self.hash * other.shift + other.hash) % PRIME, self.shift * other.shift % PRIME)

    def since(self, head: "Product", shift: int) -> "Product":
        """What follows ``head`` in this product; ``shift`` is that of the rest."""
        return Product((self.hash - head.hash * shift) % PRIME, shift)


def _halves(value: int) -> tuple[int, int]:
    """A fingerprint as two signed 64-bit numbers."""
    return value >> 64, (value & (1 << 64) - 1) - (1 << 63)


def _refer(digest: bytes) -> tuple[int, int]:
    return int.from_bytes(digest[16:24], "big", signed=True), int.from_bytes(digest[24:], "big", signed=True)


_PREFIX = ["conv_id", "depth", "f1", "f2", "p1", "p2", "words", "r1", "r2", "last"]


class _Rows:
    """Prefix rows gathered into record batches."""

    def __init__(self):
        self.columns = [[] for _ in _PREFIX]

    def add(self, conv, depth: int, value: int, parent: int, words: int, ref: tuple[int, int]) -> None:
        row = (conv, depth, *_halves(value), *_halves(parent), words, *ref, False)
        for column, x in zip(self.columns, row):
            column.append(x)

    def end(self) -> None:
        self.columns[-1][-1] = True

    def batch(self) -> pa.RecordBatch:
        kinds = [pa.int64()] * (len(_PREFIX) - 1) + [pa.bool_()]
        out = pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(self.columns, kinds)], _PREFIX)
        self.columns = [[] for _ in _PREFIX]
        return out


def _prefixes(batches, base: int):
    """Prefixes of the rebuilt conversations; a block's base comes before its other conversations."""
    rows = _Rows()
    block = now = object()  # equal to no id, nor to null
    heads: list[tuple] = []  # of the block's base: (product, words, reference) after 1, 2, .. turns
    own = replaced = before = Product()  # products of the turns so far, of those a head replaces, of the last prefix
    at = depth = 0
    shift = 1
    for batch in batches:
        for in_block, is_base, conv, take, digest, words in zip(*(c.to_pylist() for c in batch.columns)):
            if in_block != block:
                block, now, heads = in_block, object(), []
            if conv != now:
                if rows.columns[0]:
                    rows.end()
                    if len(rows.columns[0]) >= 4096:
                        yield rows.batch()
                now, own, replaced, before, at, depth, shift = conv, Product(), Product(), Product(), 0, 0, 1
                rows.add(conv, 0, 0, 0, 0, (0, 0))
                for product, count, ref in [] if is_base else heads[:take]:
                    depth += 1
                    rows.add(conv, depth, product.hash, before.hash, count, ref)
                    before = product
                head = before
            own, at, ref = own * Product(int.from_bytes(digest[:16], "big") % PRIME, base), at + 1, _refer(digest)
            if is_base:
                value = own
                if at < HEADS:
                    heads.append((own, words, ref))
            elif at <= take:
                replaced = own
                continue
            else:
                shift = shift * base % PRIME
                value = head * own.since(replaced, shift)
            depth += 1
            rows.add(conv, depth, value.hash, before.hash, words, ref)
            before = value
    if rows.columns[0]:
        rows.end()
        yield rows.batch()


def stored_turns(turns: DataFrame) -> DataFrame:
    """block, is_base, conv_id, take, turn, role, digest, words of every stored turn."""
    conv = F.col("conv_id").cast("long")
    role, text = (F.coalesce(F.col(c).cast("string"), F.lit("")) for c in ("role", "text"))
    block = conv - conv % BLOCK
    return turns.select(
        block.alias("block"), F.coalesce(conv == block, F.lit(False)).alias("is_base"), conv.alias("conv_id"),
        F.coalesce(F.crc32(conv.cast("string")) % HEADS, F.lit(0)).cast("int").alias("take"),
        F.col("turn").cast("long").alias("turn"), role.alias("role"),
        F.unhex(F.sha2(F.concat(F.length(role).cast("string"), F.lit(":"), role, text), 256)).alias("digest"),
        F.regexp_count(text, F.lit(WORD)).cast("long").alias("words"))


def prefixes(turns: DataFrame, base: int = BASES[0]) -> DataFrame:
    """A row per conversation and depth: fingerprints of the prefix and of its parent, words and reference of
    its last turn, whether the conversation ends there."""
    return (stored_turns(turns).repartition("block")
            .sortWithinPartitions("block", F.col("is_base").desc(), "conv_id", F.col("turn").asc_nulls_first(), "role",
                                  "digest")
            .select("block", "is_base", "conv_id", "take", "digest", "words")
            .mapInArrow(per_partition(_prefixes, base),
                        ", ".join(f"{c} long" for c in _PREFIX[:-1]) + ", last boolean"))


def _ends(batches):
    """SHA-256 of the ids of each node, which come in order."""
    key, sha, out = None, None, []

    def batch():
        got = pa.RecordBatch.from_arrays(
            [pa.array([x[k] for x in out], pa.int64()) for k in range(3)] + [pa.array([x[3] for x in out], pa.string())],
            NODE + ["ends_sha256"])
        out.clear()
        return got

    for rows in batches:
        for *node, conv in zip(*(c.to_pylist() for c in rows.columns)):
            if node != key:
                if key is not None:
                    out.append((*key, sha.hexdigest()))
                    if len(out) >= 4096:
                        yield batch()
                key, sha = node, hashlib.sha256(str(conv).encode())
            else:
                sha.update(f",{conv}".encode())
    if key is not None:
        out.append((*key, sha.hexdigest()))
    if out:
        yield batch()


def _same(*names: str) -> Column:
    """All rows of a group agree on these columns."""
    agree = F.lit(True)
    for n in names:
        agree = agree & (F.min(n) == F.max(n))
    return agree


def _groups(turns: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(prefixes, verified nodes), both in the checkpoint folder."""
    for base in BASES:
        rows = cut(prefixes(turns, base))
        nodes = cut(rows.groupBy(*NODE).agg(
            F.min("conv_id").alias("conv_id"), F.count("*").alias("n_convs"), F.min("words").alias("words"),
            F.min("p1").alias("p1"), F.min("p2").alias("p2"), _same("r1", "r2", "p1", "p2").alias("verified")))
        if not nodes.filter("not verified").limit(1).count():
            return rows, nodes.drop("verified")
    raise RuntimeError("equal fingerprints of different prefixes for every base")


def prefix_trie(turns: DataFrame) -> DataFrame:
    """conv_id, depth, parent_conv_id, n_convs, n_children, n_leaves, saved_tokens, ends_sha256 of every node."""
    rows, nodes = _groups(turns)
    children = (nodes.filter("depth > 0").groupBy((F.col("depth") - 1).alias("depth"), F.col("p1").alias("f1"),
                                                  F.col("p2").alias("f2")).agg(F.count("*").alias("n_children")))
    nodes = cut(nodes.join(children, NODE, "left").withColumn("n_children", F.coalesce("n_children", F.lit(0))))
    # from each conversation's end to each depth: what the nodes it owns add
    owned = nodes.select("conv_id", *NODE, ((F.col("n_convs") - 1) * F.col("words")).alias("saved"),
                         (F.col("n_children") == 0).cast("long").alias("leaf"), F.lit(True).alias("owned"))
    passed = rows.select("conv_id", *NODE, F.lit(0).cast("long").alias("saved"), F.lit(0).cast("long").alias("leaf"),
                         F.lit(False).alias("owned"))
    deeper = (Window.partitionBy("conv_id").orderBy(F.col("depth").desc())
              .rangeBetween(Window.unboundedPreceding, Window.currentRow))
    sums = (owned.unionByName(passed)
            .select(*NODE, "owned", F.sum("saved").over(deeper).alias("saved"), F.sum("leaf").over(deeper).alias("leaf"))
            .filter("not owned").groupBy(*NODE).agg(F.sum("saved").alias("saved_tokens"),
                                                    F.sum("leaf").alias("n_leaves")))
    ends = (rows.filter("last and conv_id is not null").select(*NODE, "conv_id").repartition(*NODE)
            .sortWithinPartitions(*NODE, "conv_id").mapInArrow(_ends, "depth long, f1 long, f2 long, ends_sha256 string"))
    named = _with_parents(nodes)
    return (named.join(sums, NODE, "left").join(ends, NODE, "left").select(
        "conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens",
        F.coalesce("ends_sha256", F.lit(EMPTY_SHA256)).alias("ends_sha256")))


def _with_parents(nodes: DataFrame) -> DataFrame:
    """``nodes`` with the smallest member of the parent; parents of very many nodes are broadcast."""
    most = nodes.count() // HOT
    parents = nodes.filter("n_children > 0").select(
        (F.col("depth") + 1).alias("depth"), F.col("f1").alias("p1"), F.col("f2").alias("p2"),
        F.col("conv_id").alias("parent_conv_id"), (F.col("n_children") > most).alias("hot"))
    key = ["depth", "p1", "p2"]
    hot = F.broadcast(parents.filter("hot").drop("hot"))  # fewer than HOT rows: each has over a 1 / HOT of the nodes
    below = nodes.filter("depth > 0")
    return (below.join(hot, key)
            .unionByName(below.join(hot.select(*key), key, "left_anti").join(parents.filter("not hot").drop("hot"), key))
            .unionByName(nodes.filter("depth = 0").withColumn("parent_conv_id", F.lit(None).cast("long"))))
