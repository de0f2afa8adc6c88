"""Substring duplicates by sorted suffixes: deep-shallow sorting.

A byte goes if a ``LENGTH``-byte string that covers it also starts in a
document with a smaller id.  Sorting every suffix of the corpus would move
many times the corpus, so suffixes are sampled in a way that loses nothing:

1. Every ``LENGTH``-byte window has an anchor, the smallest hash of the
   ``GRAM``-byte strings inside it.  Equal windows have equal anchors, and
   neighbouring windows mostly share theirs, so a document has few different
   anchors.  Anchors are dealt to buckets (one entry per bucket, task and
   document, packed as bytes; entries that a task finds in several documents
   are answered there and sent once), and those that occur in two documents
   are returned to their documents.
2. Maximal runs of windows with a returned anchor are cut out of the texts
   and dealt to buckets by anchor, so equal windows meet.  Equal runs of a
   group of documents are decided there against the smallest id among them
   and sent once, so a bucket gets a run at most once per group.
3. A bucket sorts its runs deep-shallow: multikey sorting by 8-byte
   characters to depth ``SHALLOW``, then a blind trie for every remaining
   group with a long common prefix.  Equal runs meet in a leaf, which keeps
   the smallest id.  Where different runs share an anchor, the suffixes that
   start at each of their windows are sorted the same way to ``LENGTH``.
4. Removed stretches return to their groups, which drop them from every
   document that holds the run under the id it was sent with.

Defined results: a null text is empty; texts shorter than ``LENGTH`` stay
whole; rows that repeat a ``doc_id`` never remove anything from each other; a
null id counts as larger than every number.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import per_partition, shards, text_of

LENGTH = 50
GRAM = 20
#: Depth of the multikey sort in bytes, a multiple of 8.
SHALLOW = 24
#: Stands for a null id.
NO_ID = (1 << 63) - 1
#: Stands for several rows of one task; no row has this key.
SEVERAL = 0
#: Bytes hashed at a time.
_CHUNK = 1 << 19
#: Windows sorted, and bytes of text cut, at a time.
_PART = 1 << 18
_CUT = 1 << 22
#: Bits of an anchor that an entry carries; its bucket comes from the rest.
_BITS = 40
_TABLE = np.random.default_rng(50).integers(0, 1 << 64, 256, dtype=np.uint64)
_BASE = 0x9E3779B97F4A7C15


def _packed(values: np.ndarray) -> bytes:
    raw = np.ascontiguousarray(values).view(np.uint8).tobytes()
    return len(raw).to_bytes(8, "little") + pa.compress(raw, codec="zstd", asbytes=True)


def _unpacked(blob: bytes, kind) -> np.ndarray:
    size = int.from_bytes(blob[:8], "little")
    return np.frombuffer(pa.decompress(blob[8:], size, codec="zstd", asbytes=True), kind) if size else np.empty(0, kind)


def window_anchors(data: np.ndarray, length: int = LENGTH, gram: int = GRAM) -> np.ndarray:
    """The anchor of every window of ``length`` bytes."""
    if len(data) < length:
        return np.empty(0, np.uint64)
    parts, width, power = [(1, _TABLE[data])], 1, _BASE
    while width * 2 <= gram:  # hashes of 2, 4, 8 ... bytes
        h = parts[-1][1]
        parts.append((width * 2, h[:-width] * np.uint64(power) + h[width:]))
        width, power = width * 2, power * power & (1 << 64) - 1
    h, have = parts[-1][1], width
    for size, piece in reversed(parts[:-1]):
        if have + size <= gram:
            n = len(data) - have - size + 1
            h = h[:n] * np.uint64(pow(_BASE, size, 1 << 64)) + piece[have:have + n]
            have += size
    h = h ^ (h >> np.uint64(31))
    h *= np.uint64(0xD6E8FEB86659FD93)
    h ^= h >> np.uint64(32)
    span, width = length - gram + 1, 1
    while width * 2 <= span:
        h = np.minimum(h[:-width], h[width:])
        width *= 2
    rest = span - width
    return np.minimum(h[:-rest], h[rest:]) if rest else h


def _texts(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """(bytes of all texts, offsets) of a string column."""
    if isinstance(column, pa.ChunkedArray):
        column = pa.concat_arrays(column.chunks) if column.num_chunks else pa.array([], column.type)
    column = column.cast(pa.large_binary())
    if not len(column):
        return np.empty(0, np.uint8), np.zeros(1, np.int64)
    offsets = np.frombuffer(column.buffers()[1], np.int64)[column.offset:column.offset + len(column) + 1]
    data = column.buffers()[2]
    data = np.frombuffer(data, np.uint8) if data else np.empty(0, np.uint8)
    return data[offsets[0]:offsets[-1]], offsets - offsets[0]


def _runs(data: np.ndarray, offsets: np.ndarray, length: int):
    """(text, anchor, first window, last window) of the maximal runs of windows with one anchor,
    in stretches of about _CHUNK bytes; a run that crosses a stretch comes in two parts."""
    at, total = 0, len(data)
    while at < total:
        end = min(at + _CHUNK, total)
        anchors = window_anchors(data[at:min(end + length - 1, total)], length)
        if not len(anchors):
            return
        borders = offsets[(offsets > at) & (offsets < at + len(anchors))] - at
        change = np.flatnonzero(anchors[1:] != anchors[:-1]) + 1
        starts = np.unique(np.concatenate([[0], change, borders]))
        stops = np.concatenate([starts[1:], [len(anchors)]])
        text = np.searchsorted(offsets, starts + at, side="right") - 1
        last = np.minimum(stops - 1, offsets[text + 1] - length - at)
        good = last >= starts
        yield text[good], anchors[starts[good]], starts[good] + at, last[good] + at
        at = end


def _bucket_of(anchors: np.ndarray, buckets: int) -> np.ndarray:
    return ((anchors >> np.uint64(_BITS)) % np.uint64(buckets)).astype(np.int64)


def _sorted_groups(keys: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(order, starts) of the groups of equal keys."""
    order = np.argsort(keys, kind="stable")
    s = keys[order]
    return order, np.flatnonzero(np.concatenate([[True], s[1:] != s[:-1]])) if len(s) else np.empty(0, np.int64)


_ENTRY_SCHEMA = pa.schema([("bucket", pa.int32()), ("reply", pa.bool_()), ("target", pa.int32()),
                           ("rows", pa.binary()), ("anchors", pa.binary())])


def _low(anchors: np.ndarray) -> np.ndarray:
    return anchors & np.uint64((1 << _BITS) - 1)


def _short(low: np.ndarray) -> bytes:
    """The low bits of anchors, 5 bytes each."""
    return low.view(np.uint8).reshape(-1, 8)[:, :_BITS // 8].tobytes()


def _long(short: bytes) -> np.ndarray:
    five = np.frombuffer(short, np.uint8).reshape(-1, _BITS // 8)
    wide = np.zeros((len(five), 8), np.uint8)
    wide[:, :_BITS // 8] = five
    return wide.reshape(-1).view(np.uint64)


def _split(keys: np.ndarray) -> list[np.ndarray]:
    """Places of each group of equal keys."""
    order, starts = _sorted_groups(keys)
    return np.split(order, starts[1:]) if len(order) else []


def _replies(rows: np.ndarray, low: np.ndarray, bucket: np.ndarray, targets: int) -> list[dict]:
    """Records that return anchors to their documents, one per group of documents."""
    full = low | bucket.astype(np.uint64) << np.uint64(_BITS)
    to = rows % targets  # numpy's remainder is not negative
    return [{"bucket": int(to[g[0]]), "reply": True, "target": int(to[g[0]]), "rows": _packed(rows[g]),
             "anchors": _packed(full[g])} for g in _split(to)]


def _once(rows: np.ndarray, anchors: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Different (row, anchor) pairs, by anchor."""
    order = np.lexsort((rows, anchors))
    r, a = rows[order], anchors[order]
    new = np.concatenate([[True], (a[1:] != a[:-1]) | (r[1:] != r[:-1])])[:len(a)]
    return r[new], a[new]


def _entries(batches, length: int, buckets: int, targets: int):
    """Anchors of a partition's documents: entries by bucket, and replies for
    anchors that several documents of the partition have."""
    found = []
    for batch in batches:
        data, offsets = _texts(batch.column(1))
        keys = batch.column(0).to_numpy()
        for text, anchors, _, _ in _runs(data, offsets, length):
            found.append(_once(keys[text], anchors))
    if not found:
        return
    r, a = _once(np.concatenate([f[0] for f in found]), np.concatenate([f[1] for f in found]))
    found.clear()
    if not len(a):
        return
    first = np.concatenate([[True], a[1:] != a[:-1]])
    group = np.cumsum(first) - 1
    several = np.bincount(group)[group] > 1
    low, bucket = _low(a), _bucket_of(a, buckets)
    records = _replies(r[several], low[several], bucket[several], targets)
    r, low, bucket = np.where(several, SEVERAL, r)[first], low[first], bucket[first]
    for g in _split(bucket):
        names, which = np.unique(r[g], return_inverse=True)
        kind = np.uint16 if len(names) < 1 << 16 else np.uint32
        records.append({
            "bucket": int(bucket[g[0]]), "reply": False, "target": len(names), "anchors": _short(low[g]),
            "rows": _packed(np.concatenate([names.view(np.uint8), which.astype(kind).view(np.uint8)]))})
    for at in range(0, len(records), 64):
        yield pa.RecordBatch.from_pylist(records[at:at + 64], _ENTRY_SCHEMA)


def _repeated(targets: int):
    """Of a bucket's entries, those whose anchor two documents have, returned to the documents."""
    def run(table: pa.Table) -> pa.Table:
        records = table.to_pylist()
        out = [x for x in records if x["reply"]]
        rows, lows = [], []
        for x in records:
            if not x["reply"]:
                raw = _unpacked(x["rows"], np.uint8)
                names = raw[:8 * x["target"]].view(np.int64)
                rows.append(names[raw[8 * x["target"]:].view(np.uint16 if x["target"] < 1 << 16 else np.uint32)])
                lows.append(_long(x["anchors"]))
        if rows:
            r, low = np.concatenate(rows), np.concatenate(lows)
            order = np.lexsort((r, low))
            r, low = r[order], low[order]
            first = np.concatenate([[True], low[1:] != low[:-1]])
            many = (np.bincount(np.cumsum(first) - 1) > 1)[np.cumsum(first) - 1] & (r != SEVERAL)
            home = records[0]["bucket"]
            out += _replies(r[many], low[many], np.full(many.sum(), home), targets)
        return pa.Table.from_pylist(out, _ENTRY_SCHEMA)
    return run


_RUN_SCHEMA = pa.schema([("bucket", pa.int32()), ("target", pa.int32()), ("anchors", pa.binary()),
                         ("docs", pa.binary()), ("sizes", pa.binary()), ("data", pa.binary()), ("classes", pa.binary()),
                         ("rows", pa.binary()), ("begins", pa.binary()), ("ends", pa.binary())])
#: Of a group of documents: where a class of equal runs stands (no ends), what of a class is
#: removed (no rows), what of a document is removed (no classes).
_STRETCH_SCHEMA = pa.schema([("target", pa.int32()), ("classes", pa.binary()), ("rows", pa.binary()),
                             ("begins", pa.binary()), ("ends", pa.binary())])


def _portions(places: np.ndarray, size: np.ndarray) -> list[np.ndarray]:
    """``places`` in parts of about _CUT bytes, as their sizes have it."""
    return np.split(places, np.flatnonzero(np.diff(np.cumsum(size) // _CUT)) + 1) if len(places) else []


def _classes(data: np.ndarray, anchor: np.ndarray, begin: np.ndarray, size: np.ndarray
             ) -> tuple[np.ndarray, np.ndarray]:
    """(order, starts) of the classes of runs with equal anchors and equal bytes."""
    n = len(begin)
    order = np.lexsort((size, anchor))
    again = np.zeros(n + 1, bool)
    again[1:-1] = (anchor[order[1:]] == anchor[order[:-1]]) & (size[order[1:]] == size[order[:-1]])
    some = order[again[1:] | again[:-1]]
    powers = np.cumprod(np.full(size[some].max(initial=0), _BASE, np.uint64))
    digest = np.zeros(n, np.uint64)
    for part in _portions(some, size[some]):
        count = size[part]
        terms = _TABLE[data[_expanded(begin[part], count)]] * powers[_expanded(np.zeros(len(part), np.int64), count)]
        digest[part] = np.add.reduceat(terms, np.cumsum(count) - count)
    order = np.lexsort((digest, size, anchor))
    x, y = order[1:], order[:-1]
    same = (anchor[x] == anchor[y]) & (size[x] == size[y]) & (digest[x] == digest[y])
    pairs = np.flatnonzero(same)
    for part in _portions(pairs, size[x[pairs]]):  # equal digests are only a guess
        count = size[x[part]]
        differ = data[_expanded(begin[x[part]], count)] != data[_expanded(begin[y[part]], count)]
        same[part] = ~np.logical_or.reduceat(differ, np.cumsum(count) - count)
    return order, np.flatnonzero(np.concatenate([[True], ~same])[:n])


def _cut_runs(length: int, buckets: int):
    """The runs of windows of a group of documents whose anchors were returned: one of each class of
    equal runs, with the smallest id; documents with larger ids lose theirs at once."""
    def run(docs: pa.Table, replies: pa.Table) -> pa.Table:
        records: list[dict] = []
        if replies.num_rows and docs.num_rows:
            def pairs(rows: np.ndarray, full: np.ndarray) -> np.ndarray:
                return full * np.uint64(3) + rows.view(np.uint64) * np.uint64(_BASE)

            wanted = np.sort(np.concatenate([
                pairs(_unpacked(r, np.int64), _unpacked(a, np.uint64))
                for r, a in zip(replies.column("rows").to_pylist(), replies.column("anchors").to_pylist())]))
            # rows that repeat id and text once, in an order that a repeated task has as well
            keys, once = np.unique(docs.column("row").to_numpy(), return_index=True)
            ids, target = docs.column("doc_id").to_numpy()[once], docs.column("target")[0].as_py()
            data, offsets = _texts(docs.column("text").cast(pa.large_binary()).take(pa.array(once)))
            parts = []
            for text, anchors, first, last in _runs(data, offsets, length):
                low, bucket = _low(anchors), _bucket_of(anchors, buckets)
                probe = pairs(keys[text], low | bucket.astype(np.uint64) << np.uint64(_BITS))
                at = np.minimum(np.searchsorted(wanted, probe), len(wanted) - 1)
                hit = np.flatnonzero(wanted[at] == probe)
                parts.append((bucket[hit], low[hit], text[hit], first[hit], last[hit] + length - first[hit]))
            bucket, low, text, begin, size = (np.concatenate([p[k] for p in parts]) for k in range(5))
            if not len(begin):
                return pa.Table.from_pylist(records, _RUN_SCHEMA)
            order, starts = _classes(data, low | bucket.astype(np.uint64) << np.uint64(_BITS), begin, size)
            kind = np.zeros(len(order), np.int64)
            kind[starts[1:]] = 1
            kind = np.cumsum(kind)
            least = np.minimum.reduceat(ids[text[order]], starts)
            later = ids[text[order]] > least[kind]
            row, first = keys[text[order]], (begin - offsets[text])[order]
            records.append({
                "bucket": target, "target": target, "classes": _packed(kind[~later]), "rows": _packed(row[~later]),
                "begins": _packed(first[~later])})
            records.append({
                "bucket": target, "target": target, "rows": _packed(row[later]), "begins": _packed(first[later]),
                "ends": _packed((first + size[order])[later])})
            head = order[starts]
            for g in _split(bucket[head]):
                one = head[g]
                records.append({
                    "bucket": int(bucket[one[0]]), "target": target, "anchors": _short(low[one]),
                    "docs": _packed(least[g]), "classes": _packed(g), "sizes": _packed(size[one]),
                    "data": _packed(data[_expanded(begin[one], size[one])])})
        return pa.Table.from_pylist(records, _RUN_SCHEMA)
    return run


def _word(data: np.ndarray, at: np.ndarray, end: np.ndarray) -> np.ndarray:
    """The 8 bytes at each place as one character; zero bits beyond the end.
    ``data`` has 8 bytes more than any place needs."""
    word = np.lib.stride_tricks.sliding_window_view(data, 8)[np.minimum(at, len(data) - 8)].view(">u8")[:, 0]
    spare = np.clip(8 - (end - at), 0, 8).astype(np.uint64) * np.uint64(8)
    return np.where(spare < 64, word.astype(np.uint64) >> np.minimum(spare, np.uint64(63)) << np.minimum(
        spare, np.uint64(63)), np.uint64(0))


def multikey(data: np.ndarray, begin: np.ndarray, end: np.ndarray, depth: int) -> tuple[np.ndarray, np.ndarray]:
    """Order of suffixes by their first ``depth`` bytes, and the starts of the groups that are
    equal so far.  Quicksort by one 8-byte character after another; groups of one are done."""
    order = np.arange(len(begin))
    group = np.zeros(len(begin), np.int64)
    for at in range(0, depth, 8):
        size = np.bincount(group, minlength=1)
        open_ = np.flatnonzero(size[group] > 1)
        if not len(open_):
            break
        mine = order[open_]
        char = _word(data, begin[mine] + at, end[mine])
        by = np.lexsort((char, group[open_]))
        order[open_] = mine[by]
        char = char[by]
        new = np.concatenate([[True], group[1:] != group[:-1]])
        split = np.zeros(len(order), bool)
        split[open_[1:]] = char[1:] != char[:-1]
        group = np.cumsum(new | split) - 1
    starts = np.flatnonzero(np.concatenate([[True], group[1:] != group[:-1]])) if len(group) else np.empty(0, np.int64)
    return order, starts


def blind_trie(strings: list[bytes], depth: int) -> list[list[int]]:
    """Classes of equal strings in sorted order, by a blind trie of strings that
    agree in their first ``depth`` bytes.  A node keeps only the place of a
    differing byte; a search goes down blindly, one comparison with the leaf
    finds the true place."""
    if not strings:
        return []
    leaves: list[list[int]] = [[0]]
    root: int | tuple = 0  # a leaf's number, or (place, {byte: child})
    for k in range(1, len(strings)):
        s = strings[k]
        node = root
        while not isinstance(node, int):
            place, children = node
            child = children.get(s[place] if place < len(s) else -1)
            node = next(iter(children.values())) if child is None else child
        t = strings[leaves[node][0]]
        if s == t:
            leaves[node].append(k)
            continue
        d, most = depth if s[:depth] == t[:depth] else 0, min(len(s), len(t))
        while d < most and s[d] == t[d]:
            d += 1
        leaves.append([k])
        mine, theirs = (x[d] if d < len(x) else -1 for x in (s, t))
        above, node = None, root
        while not isinstance(node, int) and node[0] < d:
            above, node = node, node[1][s[node[0]] if node[0] < len(s) else -1]
        if not isinstance(node, int) and node[0] == d:
            node[1][mine] = len(leaves) - 1
            continue
        fresh = (d, {theirs: node, mine: len(leaves) - 1})
        if above is None:
            root = fresh
        else:
            above[1][s[above[0]] if above[0] < len(s) else -1] = fresh
    out, stack = [], [root]
    while stack:
        node = stack.pop()
        if isinstance(node, int):
            out.append(leaves[node])
        else:
            stack += [node[1][b] for b in sorted(node[1], reverse=True)]
    return out


def padded(data: np.ndarray) -> np.ndarray:
    """``data`` with the 8 bytes more that the sort may touch."""
    return np.concatenate([data, np.zeros(8, np.uint8)])


def deep_shallow(data: np.ndarray, begin: np.ndarray, end: np.ndarray, shallow: int = SHALLOW
                 ) -> tuple[np.ndarray, np.ndarray]:
    """(order, class) of suffixes begin .. end of ``data`` (padded): sorted order, and for
    each place in it the number of its class of equal suffixes."""
    order, starts = multikey(data, begin, end, shallow)
    n = len(order)
    fresh = np.zeros(n, bool)
    fresh[starts] = True
    sizes = np.diff(np.concatenate([starts, [n]]))
    deep = np.flatnonzero(sizes > 1)
    if len(deep):  # groups that end equal within one more character have nothing left to order
        size = (end - begin)[order]
        char = _word(data, begin[order] + shallow, end[order])
        short, long = np.minimum.reduceat(size, starts), np.maximum.reduceat(size, starts)
        same = (short == long) & (long <= shallow + 8) & (
            np.minimum.reduceat(char, starts) == np.maximum.reduceat(char, starts))
        deep = deep[~same[deep]]
    if len(deep):
        raw = memoryview(data)
        for at, size in zip(starts[deep].tolist(), sizes[deep].tolist()):
            members = order[at:at + size]
            b, e, members = begin[members].tolist(), end[members].tolist(), members.tolist()
            classes = blind_trie([bytes(raw[x:y]) for x, y in zip(b, e)], shallow)
            if len(classes) > 1:
                order[at:at + size] = [members[k] for c in classes for k in c]
                place = at
                for c in classes:
                    fresh[place] = True
                    place += len(c)
    return order, np.cumsum(fresh) - 1


def _expanded(start: np.ndarray, count: np.ndarray) -> np.ndarray:
    """start, start + 1, ... (count of them) for every entry."""
    return np.repeat(start - (np.cumsum(count) - count), count) + np.arange(count.sum())


def _stretches(length: int, shallow: int):
    """Removed stretches of a bucket's runs: (group of documents, class, first byte, byte after the last);
    what groups decided themselves passes through."""
    def run(table: pa.Table) -> pa.Table:
        own = table.column("data").is_null()
        passed = table.filter(own).select(_STRETCH_SCHEMA.names).cast(_STRETCH_SCHEMA)
        table = table.filter(pc.invert(own))
        if not table.num_rows:
            return passed
        cls, doc, size, data = (
            np.concatenate([_unpacked(b, kind) for b in table.column(c).to_pylist()])
            for c, kind in (("classes", np.int64), ("docs", np.int64), ("sizes", np.int64), ("data", np.uint8)))
        keys = [_long(b) for b in table.column("anchors").to_pylist()]
        key = np.concatenate(keys)
        target = np.repeat(table.column("target").to_numpy(), [len(k) for k in keys])
        end = np.cumsum(size)
        begin = end - size
        data = padded(data)
        order, kind = deep_shallow(data, begin, end, shallow)
        starts = np.flatnonzero(np.concatenate([[True], kind[1:] != kind[:-1]]))
        least = np.minimum.reduceat(doc[order], starts)  # smallest id of each class of equal runs
        later = doc[order] > least[kind]
        whole = order[later]
        out = [(target[whole], cls[whole], np.zeros(len(whole), np.int64), size[whole])]
        # windows of different runs under one anchor
        head = order[starts]
        by, groups = _sorted_groups(key[head])
        count = np.diff(np.concatenate([groups, [len(by)]]))
        mixed = by[np.repeat(count > 1, count)]  # classes, those of an anchor together
        windows = size[head[mixed]] - length + 1
        # the rows of a class with its smallest id; all others lose the run whole
        firsts, of = order[~later], kind[~later]
        border = np.flatnonzero(np.diff(key[head[mixed]])) + 1  # of anchors
        portion = np.cumsum(windows)[border - 1] // _PART
        for part in np.split(mixed, border[np.flatnonzero(np.diff(portion, prepend=0))]) if len(mixed) else []:
            n = size[head[part]] - length + 1
            kinds, inside = np.repeat(part, n), _expanded(np.zeros(len(n), np.int64), n)
            at = begin[head[kinds]] + inside
            wo, wk = deep_shallow(data, at, at + length, length - length % 8)
            ws = np.flatnonzero(np.concatenate([[True], wk[1:] != wk[:-1]]))
            low = np.minimum.reduceat(least[kinds[wo]], ws)
            gone = np.zeros(len(kinds), bool)
            gone[wo] = low[wk] < least[kinds[wo]]
            lost = np.flatnonzero(gone)
            lo, hi = np.searchsorted(of, kinds[lost]), np.searchsorted(of, kinds[lost], side="right")
            mine = firsts[_expanded(lo, hi - lo)]
            start = np.repeat(inside[lost], hi - lo)
            out.append((target[mine], cls[mine], start, start + length))
        to, c, a, b = (np.concatenate([o[k] for o in out]) for k in range(4))
        return pa.concat_tables([passed, pa.Table.from_pylist(
            [{"target": int(to[g[0]]), "classes": _packed(c[g]), "begins": _packed(a[g]), "ends": _packed(b[g])}
             for g in _split(to)], _STRETCH_SCHEMA)])
    return run


_KEPT_SCHEMA = pa.schema([("doc_id", pa.int64()), ("n_bytes", pa.int64()), ("n_removed", pa.int64()),
                          ("n_spans", pa.int64()), ("kept", pa.binary())])


def _kept(docs: pa.Table, stretches: pa.Table) -> pa.Table:
    """What is left of a group of documents, cut _CUT bytes of text at a time."""
    data, offsets = _texts(docs.column("text"))
    ids, keys = docs.column("doc_id").to_numpy(), docs.column("row").to_numpy()
    def parts(absent: str, names: tuple[str, ...]) -> list[np.ndarray]:
        some = stretches.filter(stretches.column(absent).is_null())
        return [np.concatenate([np.empty(0, np.int64)] + [_unpacked(x, np.int64) for x in some.column(c).to_pylist()])
                for c in names]

    classes, rows, firsts = parts("ends", ("classes", "rows", "begins"))
    c, a, b = parts("rows", ("classes", "begins", "ends"))
    by = np.argsort(classes, kind="stable")
    lo, hi = np.searchsorted(classes[by], c), np.searchsorted(classes[by], c, side="right")
    mine, n = by[_expanded(lo, hi - lo)], hi - lo
    own = parts("classes", ("rows", "begins", "ends"))
    r, a, b = (np.concatenate(x) for x in zip(own, (
        rows[mine], firsts[mine] + np.repeat(a, n), firsts[mine] + np.repeat(b, n))))
    by = np.argsort(keys, kind="stable")
    lo, hi = np.searchsorted(keys[by], r), np.searchsorted(keys[by], r, side="right")
    mine = by[_expanded(lo, hi - lo)]  # rows that repeat id and text share a key
    begin, end = offsets[mine] + np.repeat(a, hi - lo), offsets[mine] + np.repeat(b, hi - lo)
    order = np.argsort(mine, kind="stable")
    mine, begin, end = mine[order], begin[order], end[order]
    removed, runs, kept, at = [], [], [], 0
    while at < len(ids):
        upto = max(at + 1, int(np.searchsorted(offsets, offsets[at] + _CUT, side="right")) - 1)
        some = slice(np.searchsorted(mine, at), np.searchsorted(mine, upto))
        base, place = offsets[at], offsets[at:upto + 1] - offsets[at]
        gone = np.zeros(place[-1] + 1, np.int32)
        np.add.at(gone, begin[some] - base, 1)
        np.add.at(gone, end[some] - base, -1)
        out = np.cumsum(gone[:-1], dtype=np.int32) > 0
        head = out.copy()
        head[1:] &= ~out[:-1]
        borders = place[:-1][place[:-1] < len(out)]
        head[borders] = out[borders]
        lost = np.diff(np.concatenate([[0], np.cumsum(out)])[place])
        removed.append(lost)
        runs.append(np.diff(np.concatenate([[0], np.cumsum(head)])[place]))
        rest = data[base:base + place[-1]][~out].tobytes()
        stops = np.cumsum(np.diff(place) - lost).tolist()
        kept += [rest[x:y] for x, y in zip([0, *stops[:-1]], stops)]
        at = upto
    none = [np.empty(0, np.int64)]
    return pa.Table.from_pydict({
        "doc_id": pa.array(ids, pa.int64(), mask=ids == NO_ID), "n_bytes": pa.array(np.diff(offsets), pa.int64()),
        "n_removed": pa.array(np.concatenate(none + removed), pa.int64()),
        "n_spans": pa.array(np.concatenate(none + runs), pa.int64()), "kept": pa.array(kept, pa.binary())},
        schema=_KEPT_SCHEMA)


def remove_repeats(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", length: int = LENGTH,
                   shallow: int = SHALLOW) -> DataFrame:
    """One row per document: doc_id, n_bytes, n_removed, n_spans (removed runs), kept (bytes)."""
    n = shards(docs.sparkSession)
    key = F.xxhash64(F.col(id_col), text_of(text_col))  # of a row; rows that repeat id and text share it
    base = docs.select(
        F.when(key == SEVERAL, F.lit(1)).otherwise(key).alias("row"), text_of(text_col).alias("text"),
        F.coalesce(F.col(id_col).cast("long"), F.lit(NO_ID)).alias("doc_id"))
    grouped = base.withColumn("target", F.pmod("row", F.lit(n)).cast("int"))
    entry = "bucket int, reply boolean, target int, rows binary, anchors binary"
    entries = base.select("row", "text").mapInArrow(per_partition(_entries, length, n, n), entry)
    replies = entries.groupBy("bucket").applyInArrow(_repeated(n), entry).select("target", "rows", "anchors")
    runs = grouped.groupBy("target").cogroup(replies.groupBy("target")).applyInArrow(
        _cut_runs(length, n),
        "bucket int, target int, anchors binary, docs binary, sizes binary, data binary, classes binary, rows binary, "
        "begins binary, ends binary")
    stretches = runs.groupBy("bucket").applyInArrow(
        _stretches(length, shallow), "target int, classes binary, rows binary, begins binary, ends binary")
    return grouped.groupBy("target").cogroup(stretches.groupBy("target")).applyInArrow(
        _kept, "doc_id long, n_bytes long, n_removed long, n_spans long, kept binary")
