"""Parameters of the clip jobs.

The defaults are fixed values: they must equal the values the reference
jobs use, or the clips come out different.
"""

from __future__ import annotations

from dataclasses import dataclass, replace

# --- fixed values (reference semantics) -------------------------------------
# padding added on each side of a detection before merging touching ones, ms
PAD_MS = 4000
# context added on each side of a merged single-label interval, ms
CONTEXT_MS = 3000
# largest gap that still merges / clusters in the multi-label path, ms
GAP_MS = 10000
# shortest clip that is written, ms
MIN_CLIP_MS = 1000
# labels kept per scene
TOP_K = 10
# label type codes and the document list each one feeds
#   "1" object, "2" scene (spelled "sence" in the documents), "3" action, "4" person ("man")
TYPE_OBJECT = "1"
TYPE_SCENE = "2"
TYPE_ACTION = "3"
TYPE_PERSON = "4"
KNOWN_TYPES = ("1", "2", "3", "4")
TYPED_LIST_NAMES = {
    "4": "man",
    "1": "object",
    "3": "action",
    "2": "sence",
}
# resourceId written into documents: "1" video clips, "2" scene clips
RESOURCE_VIDEO = "1"
RESOURCE_SCENE = "2"
# -----------------------------------------------------------------------------

# Width of the media-time buckets that split one (video, label) or one video
# into several window partitions.  A bucket holds at most BUCKET_MS distinct
# begin times (offsets are whole ms), so a window partition never grows with
# the number of rows of a hot video; only the per-bucket summaries, one row per
# bucket, are scanned per video.
BUCKET_MS = 60_000

# Largest dimension (label vocabulary) broadcast to every task; above it the
# join is left to Spark's planner.
MAX_BROADCAST_ROWS = 100_000


@dataclass(frozen=True)
class Params:
    pad_ms: int = PAD_MS
    context_ms: int = CONTEXT_MS
    gap_ms: int = GAP_MS
    min_clip_ms: int = MIN_CLIP_MS
    top_k: int = TOP_K
    # 'last': the open interval / cluster reach follows the reference fold
    # 'max' : running maximum of the ends (the intent written in its comments)
    reach: str = "last"
    # 'scene': rank labels per scene bounds over all videos (reference)
    # 'video_scene': rank per video and scene
    scope: str = "scene"
    bucket_ms: int = BUCKET_MS

    def with_(self, **kw) -> "Params":
        return replace(self, **kw)
