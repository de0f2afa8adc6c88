"""Benchmark decontamination by a distributed positional inverted index.

1. The words of the benchmark items and how often each occurs in the training
   documents give, for every window of ``WINDOW`` consecutive item words, its
   two rarest places.
2. Postings (term, document, position) of those terms are stored.
3. Lists are intersected from the rarest term: a posting of the rarest place
   proposes a start, the offset-adjusted list of the second confirms it.
4. The confirmed (document, item, shift) alignments are compared word by word
   with the document, which gives the exact windows.

DataFrame operations only.  A broadcast (terms, items) happens only behind a
measure of its rows and bytes; beyond it Spark shuffles.  Alignments meet their documents by a shuffle.

Defined results: a null text has no words; an item without words is nowhere;
a null item id counts as the empty string; rows that repeat a ``doc_id`` keep
one row each; with an empty benchmark nothing is hit.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import cut, fresh, small, text_of

WINDOW = 10
#: Characters between words: all but letters, digits and what lies beyond ASCII, the commonest first.
BETWEEN = r"[^a-z0-9A-Z\x{80}-\x{10FFFF}]+"
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def words(text: Column) -> Column:
    """The words of a text: digits, letters a-z and everything beyond ASCII."""
    ascii_only = F.octet_length(text) == F.char_length(text)
    return _cut_words(F.when(ascii_only, F.lower(text)).otherwise(F.translate(text, UPPER, LOWER)))


def _cut_words(text: Column) -> Column:
    """The words of a text in its own letters."""
    return F.array_remove(F.split(text, BETWEEN), "")


def item_words(benchmark: DataFrame, item_col: str = "item_id", text_col: str = "text") -> DataFrame:
    """(item, item_id, w, n): different items with words, numbered by their hash."""
    return (benchmark.select(F.coalesce(F.col(item_col).cast("string"), F.lit("")).alias("item_id"),
                             words(text_of(text_col)).alias("w"))
            .filter(F.size("w") > 0).distinct()
            .select(F.xxhash64("item_id", "w").alias("item"), "item_id", "w", F.size("w").alias("n")))


def _small_items(items: DataFrame) -> DataFrame:
    """The items, broadcast if their words are few enough."""
    letters = F.aggregate("w", F.lit(0).cast("long"), lambda total, word: total + F.octet_length(word) + 24)
    return small(items, 64, letters + F.octet_length("item_id"))


def _key_bytes() -> Column:
    """Bytes of the terms of a window's key."""
    return F.octet_length("t1") + F.coalesce(F.octet_length("t2"), F.lit(0))


def _code() -> Column:
    return F.xxhash64("term").alias("code")


def _words_among(docs: DataFrame, terms: DataFrame) -> DataFrame:
    """(doc_id, h, pos, term, code) of the words whose hash is that of one of ``terms``.

    A number is looked up faster than a text, for every word of the corpus.  A
    word that shares its hash with a term comes along: it adds to a frequency,
    which only orders the places, or is a posting that fits no key, as the
    joins of keys and postings compare the words."""
    codes = small(terms.select(_code()).distinct(), 64)
    return (docs.select("doc_id", "h", F.posexplode("w").alias("pos", "term")).withColumn("code", _code())
            .join(codes, "code", "left_semi"))


def _keyed(docs: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """(doc_id, h, w): documents, the hash of their text, and their words."""
    return docs.select(F.col(id_col).alias("doc_id"), F.xxhash64(text_of(text_col)).alias("h"),
                       words(text_of(text_col)).alias("w"))


def window_keys(items: DataFrame, docs: DataFrame, window: int = WINDOW) -> DataFrame:
    """(item, j1, t1, j2, t2): the two rarest places of every window (j2 null for one word)."""
    places = items.select("item", "n", F.posexplode("w").alias("j", "term"))
    counts = _words_among(docs, places).groupBy("code").agg(F.count("*").alias("freq"))
    rare = (places.withColumn("code", _code()).join(small(cut(counts), 64), "code", "left")
            .withColumn("freq", F.coalesce("freq", F.lit(0))))
    last = F.greatest(F.col("n") - window, F.lit(0))
    in_window = rare.select(
        "item", "j", "term", "freq",
        F.explode(F.sequence(F.greatest(F.col("j") - (window - 1), F.lit(0)), F.least(F.col("j"), last))).alias("first"))
    order = Window.partitionBy("item", "first").orderBy("freq", "term", "j")
    best = in_window.withColumn("k", F.row_number().over(order)).filter("k <= 2")
    return best.groupBy("item", "first").agg(
        F.min(F.when(F.col("k") == 1, F.col("j"))).alias("j1"), F.min(F.when(F.col("k") == 1, F.col("term"))).alias("t1"),
        F.min(F.when(F.col("k") == 2, F.col("j"))).alias("j2"), F.min(F.when(F.col("k") == 2, F.col("term"))).alias("t2"),
        F.min(F.when(F.col("k") == 1, F.col("freq"))).alias("freq")).filter("freq > 0").select(
        "item", "j1", "t1", "j2", "t2").distinct()


def postings(docs: DataFrame, keys: DataFrame) -> DataFrame:
    """The stored index: (term, doc_id, h, pos) of the key terms."""
    terms = keys.select(F.explode(F.array("t1", "t2")).alias("term")).filter("term is not null")
    return cut(_words_among(docs, terms).select("term", "doc_id", "h", "pos"))


def alignments(index: DataFrame, keys: DataFrame) -> DataFrame:
    """(doc_id, h, item, shift): places where both rarest words of a window fit."""
    rarest = index.join(small(keys, 128, _key_bytes()), index["term"] == keys["t1"]).select(
        "doc_id", "h", "item", (F.col("pos") - F.col("j1")).alias("shift"),
        (F.col("pos") - F.col("j1") + F.col("j2")).alias("want_pos"), F.col("t2").alias("want"))
    second = index.select(F.col("term").alias("__t"), F.col("doc_id").alias("__d"), F.col("h").alias("__h"),
                          F.col("pos").alias("__p"))
    fits = ((rarest["want"] == second["__t"]) & (rarest["want_pos"] == second["__p"])
            & (rarest["h"] == second["__h"]) & rarest["doc_id"].eqNullSafe(second["__d"]))
    pairs = rarest.filter("want is not null").distinct().join(second, fits, "left_semi")
    return pairs.unionByName(rarest.filter("want is null")).select("doc_id", "h", "item", "shift").distinct()


def exact_matches(docs: DataFrame, benchmark: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                  item_col: str = "item_id", window: int = WINDOW) -> DataFrame:
    """(doc_id, h, found): per document with matches, the array of (item_id, at, n):
    item, place of the window's first word in the document, words of the window."""
    items = cut(item_words(benchmark, item_col))
    keyed = _keyed(docs, id_col, text_col)
    keys = cut(window_keys(items, keyed, window))
    fitting = alignments(postings(keyed, keys), keys)
    known = _small_items(items)
    per_doc = (fitting.join(known, "item").groupBy("doc_id", "h").agg(
        F.collect_list(F.struct("item_id", "w", "n", "shift")).alias("c"))
        .select(F.col("doc_id").alias("__d"), F.col("h").alias("__h"), "c")).hint("merge")  # grows with the corpus
    base = docs.select(F.col(id_col).alias("doc_id"), text_of(text_col).alias("text")).withColumn("h", F.xxhash64("text"))
    near = base.join(per_doc, base["doc_id"].eqNullSafe(per_doc["__d"]) & (base["h"] == per_doc["__h"]))

    def windows(c: Column) -> Column:
        """Exact windows of one alignment."""
        length = F.least(c["n"], F.lit(window))
        low = F.greatest(-c["shift"], F.lit(0))
        high = F.least(c["n"], F.size("w") - c["shift"]) - length
        starts = F.when(low <= high, F.sequence(low, high)).otherwise(F.array().cast("array<int>"))
        same = F.filter(starts, lambda k: F.slice(F.col("w"), c["shift"] + k + 1, length) == F.slice(c["w"], k + 1, length))
        return F.transform(same, lambda k: F.struct(
            c["item_id"].alias("item_id"), (c["shift"] + k).alias("at"), length.alias("n")))

    return (near.select("doc_id", "h", "c", words(F.col("text")).alias("w"))
            .select("doc_id", "h", F.array_distinct(F.flatten(F.transform("c", windows))).alias("found"))
            .filter(F.size("found") > 0))


def contamination(docs: DataFrame, benchmark: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                  item_col: str = "item_id", window: int = WINDOW) -> DataFrame:
    """One row per document: doc_id, n_words, n_hit, items (sorted item ids), found."""
    matches = exact_matches(docs, benchmark, id_col, text_col, item_col, window).select(
        F.col("doc_id").alias("__d"), F.col("h").alias("__h"), "found",
        F.size(F.array_distinct(F.flatten(F.transform(
            "found", lambda m: F.sequence(m["at"], m["at"] + m["n"] - 1))))).alias("hit"),
        F.array_sort(F.array_distinct(F.transform("found", lambda m: m["item_id"]))).alias("item_ids"))
    once = matches.dropDuplicates(["__d", "__h"])
    text = text_of(text_col)  # as many words whatever their letters
    every = docs.select(F.col(id_col).alias("doc_id"), F.xxhash64(text).alias("h"),
                        F.size(_cut_words(text)).cast("long").alias("n_words"))
    return every.join(once, every["doc_id"].eqNullSafe(once["__d"]) & (every["h"] == once["__h"]), "left").select(
        F.col("doc_id"), "n_words", F.coalesce("hit", F.lit(0)).cast("long").alias("n_hit"),
        F.coalesce("item_ids", F.array().cast("array<string>")).alias("items"), "found")


def proximity_matches(docs: DataFrame, benchmark: DataFrame, within: int = WINDOW, id_col: str = "doc_id",
                      text_col: str = "text", item_col: str = "item_id", window: int = WINDOW) -> DataFrame:
    """(doc_id, item_id, at): the two rarest words of an item window, in any order,
    less than ``within`` words apart; joined by bands of that many words."""
    items = cut(item_words(benchmark, item_col))
    keyed = _keyed(docs, id_col, text_col)
    keys = cut(window_keys(items, keyed, window).filter("t2 is not null"))
    index = postings(keyed, keys)
    wanted = small(keys, 128, _key_bytes())
    left = index.join(wanted, index["term"] == wanted["t1"]).select(
        "doc_id", "h", "item", "pos", "t2", F.explode(F.array(*(
            F.floor(F.col("pos") / within) + d for d in (-1, 0, 1)))).alias("band")).distinct()
    right = index.select(F.col("term").alias("__t"), F.col("doc_id").alias("__d"), F.col("h").alias("__h"),
                         F.col("pos").alias("__p"), F.floor(F.col("pos") / within).alias("__band"))
    close = ((left["t2"] == right["__t"]) & (left["band"] == right["__band"]) & (left["h"] == right["__h"])
             & left["doc_id"].eqNullSafe(right["__d"]) & (F.abs(left["pos"] - right["__p"]) < within)
             & (left["pos"] != right["__p"]))
    return left.join(right, close, "left_semi").join(_small_items(items), "item").select(
        "doc_id", "item_id", F.col("pos").alias("at")).distinct()


def drop_contaminated(docs: DataFrame, benchmark: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """The documents without any exact window, with all their columns."""
    h, found_id, found_h = fresh(docs, "__text_hash", "__d", "__h")
    found = small(cut(exact_matches(docs, benchmark, id_col, text_col).select(
        F.col("doc_id").alias(found_id), F.col("h").alias(found_h)).distinct()), 64)
    marked = docs.withColumn(h, F.xxhash64(text_of(text_col)))
    return marked.join(found, marked[id_col].eqNullSafe(found[found_id]) & (marked[h] == found[found_h]),
                       "left_anti").select(*docs.columns)
