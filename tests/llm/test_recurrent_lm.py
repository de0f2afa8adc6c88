"""The recurrent language model: counts and base scores against plain Python, the network against a per-token
version in double precision, its gradients against differences, the whole score against both."""

from __future__ import annotations

import math
import re
import zlib
from collections import Counter

import numpy as np
import pyarrow as pa
import pytest

from framecut.llm import catalog, recurrent_lm as lm
from tests.conftest import SF001
from tests.llm.test_operators import CLASH, SCHEMA, _edges

LOWER = {c: c + 32 for c in range(65, 91)}


def _tokens(text):
    return re.findall(r"[^\x20\x09-\x0D]+", (text or "").translate(LOWER)) + ["\n"]


def _learned(doc_id):
    return doc_id is not None and zlib.crc32(str(doc_id).encode()) % 7 != 2


def _base(rows):
    """doc_id, held_out, n_tokens, n_known, train_tokens, base_score."""
    counts = Counter(w for i, t in rows if _learned(i) for w in _tokens(t))
    n, v = sum(counts.values()), len(counts)
    out = []
    for i, t in rows:
        words = _tokens(t)
        out.append((i, not _learned(i), len(words), sum(counts[w] > 0 for w in words), n,
                    sum(math.log10((counts[w] + 1) / (n + v + 1)) for w in words)))
    return out, counts


def _same(got, want):
    assert len(got) == len(want)
    for a, b in zip(sorted(got, key=repr), sorted(want, key=repr)):
        assert a[:5] == b[:5] and a[5] == pytest.approx(b[5], abs=1e-9 + 1e-12 * abs(b[5]) + 1e-8)


def _sort(rows):
    return sorted(rows, key=lambda r: (repr(r[:5]), r[5]))


@pytest.fixture(scope="module")
def rows():
    long_words = [(2000, "word " + "y" * 70 + " " + "y" * 71 + " " + "é" * 40), (2001, "y" * 70 + " WORD \x0b\x0c word"),
                  (2002, "y" * 70 + "\t" + "é" * 40), (2003, " leading and trailing \n")]
    return [(i, t) for i, t, _ in _edges()] + long_words


def _table(spark, rows):
    return spark.createDataFrame([(d, t, "en", "s", 1, *CLASH) for d, t in rows], SCHEMA).repartition(4)


def _plain(network, vocabulary, counts, text):
    """log10 probability of a text, token by token in double precision."""
    names = vocabulary.words.to_pylist()
    place = {w: int(s) for w, s in zip(names, vocabulary.slot) if s < vocabulary.slots}
    weight = {k: getattr(network, k).astype(np.float64) for k in lm.Network.NAMES}
    h, size, total, before = np.zeros(lm.STATE), lm.STATE, 0.0, vocabulary.end

    def sigmoid(x):
        return 1 / (1 + np.exp(-x))

    def log_softmax(x):
        return x - x.max() - np.log(np.exp(x - x.max()).sum())

    for word in _tokens(text):
        target = vocabulary.end if word == "\n" else place.get(word, vocabulary.slots)
        given = weight["given"][before]
        gate = sigmoid(h @ weight["gates"] + given[:2 * size])
        candidate = np.tanh((gate[size:] * h) @ weight["candidate"] + given[2 * size:])
        h = h + gate[:size] * (candidate - h)
        group = network.groups if target == vocabulary.slots else target // lm.PER_CLASS
        total += log_softmax(h @ weight["classes"] + weight["class_bias"])[group]
        if target < vocabulary.slots:
            mine = slice(group * lm.PER_CLASS, (group + 1) * lm.PER_CLASS)
            total += log_softmax(weight["words"][mine] @ h + weight["word_bias"][mine])[target - mine.start]
        else:
            seen = counts[word]
            total += math.log((seen + 1) / (vocabulary.other_tokens + vocabulary.other_kinds + 1))
        before = target
    return total / math.log(10)


@pytest.mark.parametrize("frequent, slots", [(lm.FREQUENT, lm.SLOTS), (60, 40)])
def test_scores_of_edge_cases(spark, rows, monkeypatch, frequent, slots):
    trained, train = {}, lm.train

    def remember(docs, shared, session):
        trained["vocabulary"], trained["network"] = shared.value, train(docs, shared, session)
        return trained["network"]

    monkeypatch.setattr(lm, "train", remember)
    found = lm.score_documents(_table(spark, rows), frequent=frequent, slots=slots).collect()
    want, counts = _base(rows)
    _same(_sort([tuple(r)[:6] for r in found]), _sort(want))
    network, vocabulary = trained["network"], trained["vocabulary"]
    assert len(vocabulary.words) <= frequent + 1
    scores = _sort((i, not _learned(i), len(_tokens(t)), 0, 0, _plain(network, vocabulary, counts, t)) for i, t in rows
                   if len(t or "") < 20_000)
    short = _sort((r["doc_id"], r["held_out"], r["n_tokens"], 0, 0, r["score"]) for r in found
                  if r["n_tokens"] in {s[2] for s in scores} and (r["doc_id"], r["n_tokens"]) in {
                      (s[0], s[2]) for s in scores})
    assert len(short) == len(scores)
    for a, b in zip(short, scores):
        assert a[:5] == b[:5] and a[5] == pytest.approx(b[5], rel=2e-5, abs=1e-4)


def test_query_learns_more_than_counts(spark):
    rows = [(r["doc_id"], r["text"]) for r in catalog.read(spark, SF001, "documents").collect()]
    found = catalog.op13_recurrent_lm(spark, SF001)
    assert found.columns == ["doc_id", "held_out", "n_tokens", "n_known", "train_tokens", "base_score", "score"]
    found = found.collect()
    _same(_sort([tuple(r)[:6] for r in found]), _sort(_base(rows)[0]))
    held = [r for r in found if r["held_out"]]
    assert sum(r["score"] for r in held) > sum(r["base_score"] for r in held)


def test_words_of_a_slice():
    """Later portions of a batch are slices of its columns."""
    texts = pa.array([f"Élan{k} A\u0085b " * 50 + "é" for k in range(300)], pa.large_string())
    words, index, n = lm._words(texts.slice(120, 100))
    got = [words[int(k)].as_py() for k in index]
    assert got == [w for k in range(120, 220) for w in _tokens(texts[k].as_py())[:-1]] and set(n) == {101}


def _tiny():
    count = np.arange(40, 0, -1)
    words = lm.Vocabulary(None, None, None, 40, 3, np.append(count, 50), 900, 45, 50, 5, 1)
    network = lm.Network.fresh(words)
    for name in network.NAMES:  # double precision for differences
        setattr(network, name, getattr(network, name).astype(np.float64))
    rng = np.random.default_rng(2)
    n = np.array([5, 1, 9, 3])
    codes = rng.integers(0, 41, n.sum()).astype(np.int32)
    codes[codes == 3] = 4
    codes[np.cumsum(n) - 1] = 3
    return network, codes, n


def test_probabilities_add_up_to_one():
    network, _, _ = _tiny()
    state = np.random.default_rng(5).standard_normal((1, lm.STATE))
    every = np.arange(41)
    log_p, _ = network.output(np.repeat(state, 41, axis=0), every)
    assert np.exp(log_p).sum() == pytest.approx(1)


def test_gradients():
    network, codes, n = _tiny()
    inputs = np.array([[3, 3], [7, 3], [40, 2], [3, 12]], np.int32)
    targets = np.array([[7, 3], [40, 2], [3, 12], [1, 40]], np.int32)

    def loss():
        states, _ = network.steps(inputs, np.zeros((2, lm.STATE)))
        return -network.output(states.reshape(-1, lm.STATE).astype(np.float64), targets.ravel())[0].sum()

    grads: dict = {}
    states, kept = network.steps(inputs, np.zeros((2, lm.STATE)), keep=True)
    _, back = network.output(states.reshape(-1, lm.STATE), targets.ravel(), grads)
    network.backward(inputs, kept, back.reshape(states.shape), grads)
    rows, values = grads["given"]
    dense = np.zeros_like(network.given)
    dense[rows] = values
    grads["given"] = dense
    rng = np.random.default_rng(9)
    for name, grad in grads.items():
        weight = getattr(network, name)
        for _ in range(6):
            at = tuple(rng.integers(0, s) for s in weight.shape)
            if name == "given":
                at = (rng.choice([3, 7, 40]), at[1])
            kept_value, step = weight[at], 1e-2
            weight[at] = kept_value + step
            up = loss()
            weight[at] = kept_value - step
            down = loss()
            weight[at] = kept_value
            assert grad[at] == pytest.approx((up - down) / (2 * step), abs=2e-3)


def test_state_is_carried_and_reset():
    """Windows and lanes change nothing: a document's score is that of the document by itself."""
    network, codes, n = _tiny()
    network = lm.Network.unflat(40, 3, network.flat())
    many = np.tile(codes, 60)
    sizes = np.tile(n, 60)
    together = lm.log_likelihoods(network, lm.Lanes(many, sizes, 3))
    alone = np.concatenate([lm.log_likelihoods(network, lm.Lanes(codes[b:b + k], np.array([k]), 3))
                            for b, k in zip(np.cumsum(n) - n, n)])
    assert np.allclose(together, np.tile(alone, 60), atol=1e-4)


def test_empty_tables(spark):
    assert lm.score_documents(_table(spark, [])).collect() == []
    nothing = lm.score_documents(_table(spark, [(None, "a b c"), (None, None)])).collect()
    assert sorted((r["n_tokens"], r["n_known"], r["train_tokens"], r["base_score"], r["score"]) for r in nothing) == [
        (1, 0, 0, 0, 0), (4, 0, 0, 0, 0)]
