"""List and map expressions over a clip's member array.

Members are structs ``(b, i, t, n, n2, img)`` sorted by (b, i).
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def field(members: Column, f: str) -> Column:
    """A10: one field of every member, in member order (duplicates and null
    elements kept)."""
    return F.transform(members, lambda x: x[f])


def typed(members: Column, code: str, f: str = "n") -> Column:
    """The field of the members whose label type is ``code``."""
    return F.transform(F.filter(members, lambda x: x["t"] == F.lit(code)), lambda x: x[f])


def label_to_image(members: Column) -> Column:
    """Label -> image, the last member of a label wins.  The members are
    sorted by label and place; the last of each label has another label, or
    nothing, after it.  Members without a label are in no map."""
    named = F.filter(F.transform(members, lambda x, i: F.struct(x["n"].alias("n"), i.alias("i"), x["img"].alias("img"))),
                     lambda x: x["n"].isNotNull())
    ordered = F.array_sort(named)
    pairs = F.arrays_zip(ordered.alias("x"), F.slice(ordered, F.lit(2), F.size(members)).alias("y"))
    last = F.filter(pairs, lambda p: p["y"].isNull() | (p["y"]["n"] != p["x"]["n"]))
    return F.map_from_entries(F.transform(last, lambda p: F.struct(p["x"]["n"], p["x"]["img"])))


def joined(arr: str | Column, sep: str = "|") -> Column:
    """A list as text (null elements skipped)."""
    return F.concat_ws(sep, F.col(arr) if isinstance(arr, str) else arr)
