"""Personal data: regular expressions propose, checksums confirm, context scores.

DataFrame functions only; one projection per document, no shuffle.  Kinds in
order: email, ip, card, phone (the base kinds), then iban and ssn.  Every
expression is linear: runs are taken possessively, and a match may only start
where its run starts.

Positions: ``split`` gives the text between matches, ``regexp_extract_all`` the
matches; their lengths add up to the starts.  The text on either side of a
match is at hand for the context words.

Confirmed: ip parts at most 255; card 12 to 19 digits with a Luhn checksum;
phone 9 to 15 digits; iban by mod 97; ssn only with a context word.  A match
that fails is dropped and its characters are not searched again.

Defined results: a null or empty text has no spans; repeated rows keep one
row each.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import text_of

BASE = ("email", "ip", "card", "phone")
KINDS = (*BASE, "iban", "ssn")
_LOCAL = "A-Za-z0-9._%+-"
#: A run may begin where no character of the run stands before, or after the last match.
PATTERNS = {
    "email": rf"(?:\G|(?<![{_LOCAL}]))[{_LOCAL}]++@[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++",
    "ip": r"(?<![0-9])[0-9]++\.[0-9]++\.[0-9]++\.[0-9]++",
    "card": r"[0-9](?:[\x20-]?[0-9]){11,}+",
    "phone": r"\+[0-9][\x20().0-9-]+[0-9]",
    "iban": r"(?<![A-Za-z0-9])[A-Z]{2}[0-9]{2}(?:\x20?[A-Z0-9]{4}){2,7}(?:\x20?[A-Z0-9]{1,3})?(?![A-Za-z0-9])",
    "ssn": r"(?<![0-9-])[0-9]{3}-[0-9]{2}-[0-9]{4}(?![0-9-])",
}
#: A text without this has no match of the kind.
NEEDS = {"email": "@", "phone": "+", "ssn": "-"}
CONTEXT = {
    "email": "mail|contact|write", "ip": "ip|address|host|server", "card": "card|visa|credit|payment",
    "phone": "phone|tel|call|fax|mobile", "iban": "iban|bank|account|transfer", "ssn": "ssn|social security",
}
SCORES = {"email": 0.8, "ip": 0.5, "card": 0.7, "phone": 0.6, "iban": 0.8, "ssn": 0.4}
CONTEXT_BONUS = 0.2
#: Characters on either side that are searched for context words.
AROUND = 40


def _digits(match: Column) -> Column:
    return F.regexp_replace(match, r"[^0-9]", "")


def luhn(digits: Column) -> Column:
    """Whether a string of digits passes the Luhn checksum."""
    def value(acc: Column, k: Column) -> Column:
        digit = F.substring(digits, F.length(digits) - k, F.lit(1)).cast("int") * (1 + k % 2)
        return acc + F.when(digit > 9, digit - 9).otherwise(digit)
    return F.aggregate(F.sequence(F.lit(0), F.length(digits) - 1), F.lit(0), value) % 10 == 0


def mod97(match: Column) -> Column:
    """Whether an IBAN passes its checksum: four characters moved to the end, letters as 10 to 35."""
    plain = F.regexp_replace(match, r"\x20", "")
    turned = F.concat(F.substring(plain, F.lit(5), F.length(plain)), F.substring(plain, 1, 4))

    def value(acc: Column, k: Column) -> Column:
        code = F.ascii(F.substring(turned, k, F.lit(1)))
        return F.when(code < 58, (acc * 10 + code - 48) % 97).otherwise((acc * 100 + code - 55) % 97)
    return F.aggregate(F.sequence(F.lit(1), F.length(turned)), F.lit(0), value) == 1


def _valid(kind: str, match: Column, context: Column) -> Column:
    if kind == "ip":
        part = r"0*+(?:25[0-5]|2[0-4][0-9]|1[0-9][0-9]|[0-9]?[0-9]?)"
        return match.rlike(rf"^{part}(?:\.{part}){{3}}$")
    if kind == "card":
        digits = _digits(match)
        return F.length(digits).between(12, 19) & luhn(F.substring(digits, 1, 19))
    if kind == "phone":
        return F.length(_digits(match)).between(9, 15)
    if kind == "iban":
        return mod97(match)
    return context if kind == "ssn" else F.lit(True)


_SPANS = "array<struct<start:int,rank:int,end:int,score:double>>"


def _confirmed(kind: str) -> Column:
    """Confirmed matches of one kind from its columns ``hits_*`` and ``parts_*``, ascending."""
    hits, parts = F.col(f"hits_{kind}"), F.col(f"parts_{kind}")

    def step(acc: Column, k: Column) -> Column:
        match, before, after = F.get(hits, k), F.get(parts, k), F.get(parts, k + 1)
        near = F.concat(F.right(before, F.lit(AROUND)), F.lit(" "), F.left(after, F.lit(AROUND)))
        context = F.lower(near).rlike(rf"(?<![a-z])(?:{CONTEXT[kind]})")
        start = acc["at"] + F.length(before)
        end = start + F.length(match)
        score = F.when(context, F.lit(SCORES[kind] + CONTEXT_BONUS)).otherwise(F.lit(SCORES[kind]))
        span = F.struct(start.alias("start"), F.lit(KINDS.index(kind)).alias("rank"), end.alias("end"),
                        score.alias("score"))
        found = F.when(_valid(kind, match, context), F.array_append(acc["found"], span)).otherwise(acc["found"])
        return F.struct(end.alias("at"), found.alias("found"))

    first = F.struct(F.lit(0).alias("at"), F.array().cast(_SPANS).alias("found"))
    spans = F.aggregate(F.sequence(F.lit(0), F.size(hits) - 1), first, step, lambda acc: acc["found"])
    return F.when(F.size(hits) > 0, spans).otherwise(F.array().cast(_SPANS))


def find_pii(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(doc_id, spans): per document the array of (kind, start, end, score), by start, then kind.

    Starts and ends count code points; ends are exclusive.
    """
    def hits(kind: str) -> Column:
        found = F.regexp_extract_all("text", F.lit(PATTERNS[kind]), F.lit(0))
        return F.when(F.col("text").contains(NEEDS[kind]), found) if kind in NEEDS else found

    proposed = docs.select(F.col(id_col).alias("doc_id"), text_of(text_col).alias("text")).select(
        "doc_id", "text", *(hits(k).alias(f"hits_{k}") for k in KINDS))
    placed = proposed.select("doc_id", *(f"hits_{k}" for k in KINDS), *(
        F.when(F.size(f"hits_{k}") > 0, F.split("text", PATTERNS[k], -1)).alias(f"parts_{k}") for k in KINDS))
    spans = reduce(F.concat, [_confirmed(k) for k in KINDS])
    names = F.array(*(F.lit(k) for k in KINDS))
    return placed.select("doc_id", F.transform(F.array_sort(spans), lambda s: F.struct(
        F.get(names, s["rank"]).alias("kind"), s["start"].alias("start"), s["end"].alias("end"),
        s["score"].alias("score"))).alias("spans"))


def joined_spans(spans: Column) -> Column:
    """``kind:start:end`` of every span, comma-joined."""
    return F.array_join(F.transform(spans, lambda s: F.concat_ws(":", s["kind"], s["start"], s["end"])), ",")
