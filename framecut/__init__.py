"""framecut: interval analytics over video label detections, on Spark.

Detections (a label seen in a video from one millisecond offset to another)
are unified, enriched and turned into three kinds of clip documents:
single-label clips, multi-label clips and scene clips.  Every step is a
``DataFrame -> DataFrame`` function built from Spark built-ins, so one
Catalyst plan runs from the scans to the sink.
"""

from framecut.params import Params

__all__ = ["Params"]
