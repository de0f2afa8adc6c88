"""Plain Python versions of the operators, for small tables of (doc_id, text)."""

from __future__ import annotations

import hashlib
import re
import zlib
from collections import defaultdict

import xxhash

NONE = float("inf")


def rank(doc_id):
    return NONE if doc_id is None else doc_id


def sha(data) -> str:
    return hashlib.sha256(data if isinstance(data, bytes) else data.encode()).hexdigest()


def luhn(digits: str) -> bool:
    total = 0
    for k, c in enumerate(reversed(digits)):
        d = int(c) * (2 if k % 2 else 1)
        total += d - 9 if d > 9 else d
    return total % 10 == 0


PII = {
    "email": (r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+", lambda m: True),
    "ip": (r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)", lambda m: all(int(p) <= 255 for p in m.split("."))),
    "card": (r"[0-9]([\x20-]?[0-9])+", lambda m: 12 <= len(d := re.sub("[^0-9]", "", m)) <= 19 and luhn(d)),
    "phone": (r"\+[0-9][\x20().0-9-]+[0-9]", lambda m: 9 <= len(re.sub("[^0-9]", "", m)) <= 15),
}


def pii(text):
    spans = []
    for k, (kind, (pattern, valid)) in enumerate(PII.items()):
        spans += [(m.start(), k, f"{kind}:{m.start()}:{m.end()}")
                  for m in re.finditer(pattern, text or "") if valid(m.group())]
    spans.sort()
    counts = [sum(s[1] == k for s in spans) for k in range(4)]
    return counts, ",".join(s[2] for s in spans)


def lower(text: str) -> str:
    return "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text)


def fingerprint(text) -> int:
    words = [w for w in re.split(r"[\x20\x09-\x0D]+", lower(text or "")) if w]
    if not words:
        return 0
    shingles = [" ".join(words[k:k + 3]) for k in range(max(1, len(words) - 2))]
    hashes = [xxhash.xxh64_intdigest(s.encode(), 42) for s in shingles]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def components(docs):
    prints = [fingerprint(t) for _, t in docs]
    group = list(range(len(docs)))

    def top(x):
        while group[x] != x:
            x = group[x]
        return x
    for a in range(len(docs)):
        for b in range(a):
            if (prints[a] ^ prints[b]).bit_count() <= 2:
                group[max(top(a), top(b))] = min(top(a), top(b))
    members = defaultdict(list)
    for k, (d, _) in enumerate(docs):
        members[top(k)].append(rank(d))
    return [(d, f"{prints[k]:016x}", None if (m := min(members[top(k)])) == NONE else m) for k, (d, _) in enumerate(docs)]


def bench_words(text):
    return [w for w in re.split(r"[\x00-\x2F\x3A-\x60\x7B-\x7F]+", lower(text or "")) if w]


def contamination(docs, items):
    windows = defaultdict(set)
    for item, text in items:
        w = bench_words(text)
        for k in range(max(1, len(w) - 9) if w else 0):
            windows[tuple(w[k:k + 10])].add(item)
    sizes = {len(k) for k in windows}
    out = []
    for d, text in docs:
        w, hit, found = bench_words(text), set(), set()
        for n in sizes:
            for k in range(len(w) - n + 1):
                if items_ := windows.get(tuple(w[k:k + n])):
                    hit |= set(range(k, k + n))
                    found |= items_
        out.append((d, len(w), len(hit), len(found), sha(",".join(sorted(found))), bool(hit)))
    return out


def exact(docs):
    groups = defaultdict(list)
    norm = [re.sub(r"[\x20\x09-\x0D]+", " ", t or "") for _, t in docs]
    for k, (d, _) in enumerate(docs):
        groups[norm[k]].append((rank(d), k))
    out = []
    for k, (d, _) in enumerate(docs):
        g = groups[norm[k]]
        keep = min(g)[0]
        out.append((d, None if keep == NONE else keep, len(g), sha(norm[k])))
    return out


def suffixes(docs, length=50):
    first = {}
    for d, t in docs:
        b = (t or "").encode()
        for p in range(len(b) - length + 1):
            s = b[p:p + length]
            first[s] = min(first.get(s, NONE), rank(d))
    out = []
    for d, t in docs:
        b = (t or "").encode()
        gone = bytearray(len(b))
        for p in range(len(b) - length + 1):
            if first[b[p:p + length]] < rank(d):
                gone[p:p + length] = b"\1" * length
        kept = bytes(c for c, g in zip(b, gone) if not g)
        out.append((d, len(b), sum(gone), len([r for r in bytes(gone).split(b"\0") if r]), sha(kept)))
    return out


def crc(ids) -> int:
    return zlib.crc32(b"".join(i.to_bytes(4, "little") for i in ids))


def sentences(text):
    cut = re.findall(r"(?:[^.!?\n]|[.!?]+[^.!? \t\r\n])*[.!?]*[ \t\r\n]*", text or "")
    out = []
    for s in filter(None, cut):
        out += [s] if len(s) < 32 else re.findall(r"[ \t\r\n]*(?:[^ \t\r\n]+[ \t\r\n]*){1,16}|[ \t\r\n]+", s)
    return out


def content_pieces(text):
    """Sentences cut after words whose hash is the least of 4 words to each side."""
    mix = (0x9E3779B97F4A7C15, 0xD6E8FEB86659FD93, 0xC2B2AE3D27D4EB4F)
    out = []
    for s in filter(None, re.findall(r"(?:[^.!?\n]|[.!?]+[^.!? \t\r\n])*[.!?]*[ \t\r\n]*", text or "")):
        w = re.findall(r"[ \t\r\n]*[^ \t\r\n]+[ \t\r\n]*", s) or [s]
        c = [0, *(zlib.crc32(x.strip(" \t\r\n").encode()) for x in w), 0]
        h = []
        for k in range(1, len(c) - 1):
            x = c[k] * mix[0] + c[k - 1] * mix[1] + c[k + 1] * mix[2] & (1 << 64) - 1
            h.append((x ^ x >> 32) * mix[1] & (1 << 64) - 1)
        piece = ""
        for k, x in enumerate(w):
            piece += x
            if k == len(w) - 1 or 4 <= k < len(w) - 4 and h[k] == min(h[k - 4:k + 5]):
                out.append(piece)
                piece = ""
    return out


def spans(docs, size=3, cut=sentences):
    first = {}
    for d, t in docs:
        s = [x.strip(" \t\r\n") for x in cut(t)]
        for k in range(len(s) - size + 1):
            key = tuple(s[k:k + size])
            first[key] = min(first.get(key, (NONE, NONE)), (rank(d), k))
    out = []
    for d, t in docs:
        pieces = cut(t)
        s = [x.strip(" \t\r\n") for x in pieces]
        gone = set()
        for k in range(len(s) - size + 1):
            if first[tuple(s[k:k + size])] != (rank(d), k):
                gone |= set(range(k, k + size))
        out.append((d, len(pieces), len(gone), sha("".join(p for k, p in enumerate(pieces) if k not in gone)),
                    sha("".join(p for k, p in enumerate(pieces) if k in gone))))
    return out
