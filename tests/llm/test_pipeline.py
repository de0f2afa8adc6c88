"""The corpus pipeline: every stage and run() against compositions of plain Python versions, on rows with nulls,
repeated ids, empty and very long texts and columns named like the stages' own."""

from __future__ import annotations

import numpy as np
import pyarrow.parquet as pq
import pytest

import corpus_pipeline
from framecut.llm import catalog, langid, tokens
from tests.llm import brute
from tests.llm.test_operators import _edges, _real

#: Names that the stages use inside, and the row's number.
SCHEMA = ("doc_id long, text string, lang string, source string, n_chars long, __h int, __n int, __digest int, "
          "__text_hash int, __id int, __kept int, __d int, digest int, k long")


def _rows():
    rows = _edges() + [(3000, "x y z " + " ".join(_real()[20][1].split()[35:60]), "en"), (3001, "Привет, как дела?", None),
                       (3002, "съешь же ещё этих мягких французских булок", None), (None, "съешь же ещё этих", "en"),
                       (1, "съешь же ещё этих мягких булок", "en"), (3003, " ".join(_real()[9][1].split() * 200), "en")]
    return [(*r, k) for k, r in enumerate(rows)]


def _table(spark, rows):
    return spark.createDataFrame([(d, t, g, "s", 1, *range(8), k) for d, t, g, k in rows], SCHEMA).repartition(4)


@pytest.fixture(scope="module")
def folder(spark, tmp_path_factory):
    at = str(tmp_path_factory.mktemp("pipeline"))
    _table(spark, _rows()).drop("digest").write.parquet(f"{at}/documents.parquet")
    words = _real()[20][1].split()
    spark.createDataFrame([("b1", " ".join(words[30:60])), (None, None), ("b2", "never seen words " * 5)],
                          "item_id string, text string").write.parquet(f"{at}/benchmark.parquet")
    return at


def _kept(df):
    assert df.columns == [c for c in SCHEMA.replace(" long", "").replace(" int", "").replace(" string", "").split(", ")
                          if c in df.columns]
    return sorted(r["k"] for r in df.collect())


def _exact(rows):
    """Numbers of the rows of which one of each text and smallest id stays, as sets to choose from."""
    found = brute.exact([(d, t) for d, t, _, _ in rows])
    choice = {}
    for (d, _, _, k), (_, keep, _, sha) in zip(rows, found):
        if d == keep:
            choice.setdefault(sha, set()).add(k)
    return list(choice.values())


def _near(rows):
    texts = [(d, t) for d, t, _, _ in rows]
    prints = [brute.fingerprint(t) for _, t in texts]
    part = list(range(len(rows)))
    for a in range(len(rows)):
        for b in range(a):
            if (prints[a] ^ prints[b]).bit_count() <= 2:
                part = [part[b] if p == part[a] else p for p in part]
    groups = {}
    for k, p in enumerate(part):
        groups.setdefault(p, []).append(k)
    return [{rows[k][3] for k in g if brute.rank(rows[k][0]) == min(brute.rank(rows[j][0]) for j in g)}
            for g in groups.values()]


def _one_of_each(got, choices):
    assert len(got) == len(choices) and all(len(c & set(got)) == 1 for c in choices)


def test_stages_against_plain_python(spark, folder):
    rows = _rows()
    docs = spark.read.parquet(f"{folder}/documents.parquet")
    by_text = {}
    found = langid.detect_languages(docs).count()
    assert found == len(rows)
    models, limits = langid.train(langid.training_sample(docs))
    for _, t, _, _ in rows:
        by_text[t] = bool(langid._judged([t or ""], models, limits)[4][0])
    left = _kept(corpus_pipeline.language(spark, docs, folder))
    assert left == [k for _, t, _, k in rows if not by_text[t]]
    assert _kept(corpus_pipeline.language(spark, docs.limit(0), folder)) == []
    for stage, plain in ((corpus_pipeline.exact, _exact), (corpus_pipeline.near, _near)):
        _one_of_each(_kept(stage(spark, docs, folder)), plain(rows))
        assert _kept(stage(spark, docs.limit(0), folder)) == []
    bench = [(r["item_id"] or "", r["text"]) for r in pq.read_table(f"{folder}/benchmark.parquet").to_pylist()]
    dirty = brute.contamination([(k, t) for _, t, _, k in rows], bench)
    assert any(r[5] for r in dirty)
    bad = {rows[r[0]][:2] for r in dirty if r[5]}
    assert _kept(corpus_pipeline.clean(spark, docs, folder)) == [r[3] for r in rows if r[:2] not in bad]
    assert _kept(corpus_pipeline.clean(spark, docs.limit(0), folder)) == []
    assert corpus_pipeline.packed(spark, docs.limit(0), folder).collect() == []


def test_run_is_the_composition(spark, folder):
    rows = _rows()
    docs = spark.read.parquet(f"{folder}/documents.parquet")
    models, limits = langid.train(langid.training_sample(docs))
    rows = [r for r in rows if not langid._judged([r[1] or ""], models, limits)[4][0]]
    first = {min(c) for c in _exact(rows)}
    ids = lambda some: sorted((repr(r[0]), brute.sha((r[1] or ""))) for r in some)
    rows = [r for r in rows if r[3] in first]
    survivors = [r for r in rows if r[3] in {min(c) for c in _near(rows)}]
    bench = [(r["item_id"] or "", r["text"]) for r in pq.read_table(f"{folder}/benchmark.parquet").to_pylist()]
    bad = {r[0] for r in brute.contamination([(k, t) for _, t, _, k in survivors], bench) if r[5]}
    survivors = [r for r in survivors if r[3] not in bad]
    assert len({repr(i) for i, _ in ids(survivors)}) > 60
    path = tokens.public_path(catalog.WORD_BPE)
    enc = tokens.TextEncoder(path).tokenizer
    want = sorted((repr(r[0]), len(enc.encode(r[1] or "", add_special_tokens=False).ids) + 1) for r in survivors)
    pieces = corpus_pipeline.run(spark, folder).collect()
    got = sorted((repr(p["doc_id"]), p["doc_tokens"]) for p in pieces if p["start"] == 0)
    assert got == want
    assert sum(p["length"] for p in pieces) == sum(n for _, n in want)
    used = {}
    for p in pieces:
        used.setdefault(p["sequence_id"], []).append((p["offset"], p["length"]))
    for places in used.values():
        ends = np.cumsum([n for _, n in sorted(places)])
        assert [o for o, _ in sorted(places)] == [0, *ends[:-1]] and ends[-1] <= 4096


def test_unseen_scripts_are_rejected_and_clean_texts_kept(spark):
    rows = pq.read_table("/root/testdata/sf0.01/documents.parquet").to_pylist()
    table = [(r["doc_id"], r["text"], r["lang"]) for r in rows]
    short = [(10_000 + k, " ".join((t or "").split()[:12]), None) for k, (_, t, g) in enumerate(table) if g]
    strange = ["съешь же ещё этих мягких французских булок", "Το γρήγορο αλεπού πηδά πάνω", "北京市朝阳区建国门外大街一号楼",
               "אני רוצה ללכת הביתה עכשיו", "Привет, как твои дела сегодня?"]
    odd = [(20_000 + k, t, None) for k, t in enumerate(strange * 3)]
    docs = spark.createDataFrame(table + short + odd, "doc_id long, text string, lang string").repartition(4)
    rejected = {r["doc_id"] for r in langid.detect_languages(docs).filter("rejected").collect()}
    assert {i for i, _, _ in odd} <= rejected
    assert sum(i in rejected for i, _, g in table if g) <= 0.005 * len(table)
    assert sum(i in rejected for i, _, _ in short) <= 0.02 * len(short)


def test_rows_not_ids_are_rejected(spark):
    words = [r["text"] for r in pq.read_table("/root/testdata/sf0.01/documents.parquet").to_pylist()]
    rows = [(k, t, "en") for k, t in enumerate(words[:60])] + [(None, "12345 67", "en"), (3, "!!!", "en"), (None, words[1], "en")]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string").repartition(3)
    kept = [(r["doc_id"], r["text"]) for r in langid.drop_rejected(docs).collect()]
    assert (None, "12345 67") not in kept and (3, "!!!") not in kept and (None, words[1]) in kept
