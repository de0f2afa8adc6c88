"""Pure-Python folds written from the semantics, used
as models for the Spark operators."""

from __future__ import annotations

from collections import defaultdict


def merge_model(rows, gap, pad=0, reach="last"):
    """rows: (video, label, b, e, id) -> set of (video, label, b, e, first_id, n)."""
    groups = defaultdict(list)
    for v, l, b, e, i in rows:
        if pad:
            b, e = max(0, b - pad), e + pad
        groups[(v, l)].append((b, i, e))
    out = set()
    for (v, l), xs in groups.items():
        xs.sort()
        cur = None
        for b, i, e in xs:
            if cur is not None and b - cur["reach"] <= gap:
                cur["e"] = e if reach == "last" else max(cur["e"], e)
                cur["reach"] = cur["e"]
                cur["n"] += 1
            else:
                if cur is not None:
                    out.add((v, l, cur["b"], cur["e"], cur["id"], cur["n"]))
                cur = {"b": b, "e": e, "reach": e, "id": i, "n": 1}
        out.add((v, l, cur["b"], cur["e"], cur["id"], cur["n"]))
    return out


def session_model(rows, gap, reach="last"):
    """rows: (video, label, b, e, id) -> set of (video, begin, end, n, labels)."""
    groups = defaultdict(list)
    for v, l, b, e, i in rows:
        groups[v].append((b, i, e, l))
    out = set()
    for v, xs in groups.items():
        xs.sort()
        clusters, cur, reach_v = [], None, None
        for b, i, e, l in xs:
            if cur is not None and b - reach_v <= gap:
                cur.append((b, i, e, l))
                reach_v = max(b, reach_v) if reach == "last" else max(e, reach_v)
            else:
                cur = [(b, i, e, l)]
                clusters.append(cur)
                reach_v = e
        for c in clusters:
            out.add((v, min(x[0] for x in c), max(x[2] for x in c), len(c), "|".join(x[3] for x in c)))
    return out


def segment_model(rows):
    """rows: (video, label, b, e, id) -> set of (video, fb, fe, id) for every
    fragment between consecutive cut points and interval covering it."""
    groups = defaultdict(list)
    for v, l, b, e, i in rows:
        groups[v].append((b, e, i))
    out = set()
    for v, xs in groups.items():
        pts = sorted({t for b, e, _ in xs for t in (b, e)})
        for fb, fe in zip(pts, pts[1:]):
            for b, e, i in xs:
                if e > b and b <= fb and e >= fe:
                    out.add((v, fb, fe, i))
    return out
