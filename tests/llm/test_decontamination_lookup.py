"""Words of documents are looked up among the benchmark's by number; texts decide afterwards."""

import re

from pyspark.sql import functions as F

from framecut.llm import decontaminate

TEXTS = ["ABC def-GHI.", "", "  ", "ÉCOLE École ÀB", "İstanbul IŞIK", "Kelvin K ΣΑΣ", "a_b`c~d 09:Z", "\x7f\x80x", "𝔄B c", "ABC\x00Z{|}",
         "plain words, PLAIN words"]


def test_words_lower_no_letter_beyond_ascii(spark):
    def plain(text):
        lowered = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text)
        return [w for w in re.split(r"[\x00-\x2F\x3A-\x60\x7B-\x7F]+", lowered) if w]

    rows = spark.createDataFrame(list(enumerate(TEXTS)), "n int, text string").select(
        "n", decontaminate.words(F.col("text")).alias("w"), F.size(decontaminate._cut_words(F.col("text"))).alias("size"))
    for r in rows.collect():
        assert r["w"] == plain(TEXTS[r["n"]]) and r["size"] == len(r["w"])


def test_the_corpus_is_filtered_by_numbers(spark, monkeypatch):
    docs = spark.createDataFrame([(k, f"Before one TWO three école {k} after") for k in range(20)], "doc_id long, text string")
    bench = spark.createDataFrame([("i", "two three école"), ("j", "never seen")], "item_id string, text string")
    plans, cut = [], decontaminate.cut

    def noted(df):
        plans.append(df._jdf.queryExecution().sparkPlan().toString())
        return cut(df)

    monkeypatch.setattr(decontaminate, "cut", noted)
    found = decontaminate.contamination(docs, bench).collect()
    assert len(found) == 20 and {(r["n_words"], r["n_hit"], *r["items"]) for r in found} == {(7, 3, "i")}
    joins = [line for plan in plans for line in plan.splitlines() if "LeftSemi" in line]
    assert len(joins) >= 2 and all(re.search(r"\[code#\d+L\], \[code#\d+L\], LeftSemi", line) for line in joins)
