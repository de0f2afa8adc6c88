"""Log-likelihood of whole documents under a gated recurrent language model.

Words are counted over all documents; the most frequent of the training
documents and the end of a document make the model's vocabulary, dealt by
rank into classes.  The model predicts a token's class and then the token
within its class (a class-factored softmax); all other words are one more
class, within which a word has its share of the corpus counts.

Training is one pass over every training document, in ROUNDS parts.  In each
round every task starts from the common weights and trains on its documents
by truncated backpropagation in numpy: documents lie one after another in
parallel lanes, the state is carried from window to window and zeroed where a
document begins.  The tasks' weights are averaged in two steps by blocks, so
the driver gets one set of weights, whose size does not depend on the corpus.

Scoring carries the state through the whole document the same way.

Word counts never pass the driver.  Words more frequent than a cut-off (at
most FREQUENT of them, by a histogram of counts) are broadcast and looked up
where the text is read; the others of a document are joined with the counts
by a shuffle and summed per document.

Defined results: null text is empty and has one token, its end; a null id is
held out; repeated rows are scored each, trained on each; without training
documents every score is 0; an empty table gives no row; other columns are
ignored.  Scores are base-10 logarithms.
"""

from __future__ import annotations

import hashlib
import heapq
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import per_partition, table_path, text_of
from .tokens import forget, portions, with_end

#: Words broadcast with their counts, at most.
FREQUENT = 200_000
#: Entries of the model's vocabulary, the end of a document included, and of a class.
SLOTS, PER_CLASS = 1024, 32
#: Size of the state, steps that a gradient goes back, lanes.
STATE, WINDOW, LANES = 16, 32, 256
#: Steps that a lane has at least, on average, where there are tokens enough for more than one.
LANE_STEPS = 256
#: Parts of the training pass, after each of which weights are averaged; rate of Adagrad.
ROUNDS, RATE = 3, 0.1
#: Tokens held at a time.
BUFFER = 3_000_000
#: A longer word is known by its SHA-256.
LONGEST = 64
#: Floats in a block of weights, and parts of the first averaging step.
BLOCK, SALTS = 8192, 64
#: Keys that are no words.
END = " end"
_LOG10 = np.log(10.0)


def training(id_col: str = "doc_id") -> Column:
    """Documents to learn from: crc32 of the id as text, mod 7, is not 2 (and the id is not null)."""
    return F.coalesce(F.crc32(F.col(id_col).cast("string")) % 7 != 2, F.lit(False))


# --- words ---------------------------------------------------------------------


def _words(texts: pa.Array) -> tuple[pa.Array, np.ndarray, np.ndarray]:
    """(different words, index of every word of the texts one after another, words per text)."""
    lists = pc.ascii_split_whitespace(texts.cast(pa.large_string()))
    flat = lists.flatten()
    real = pc.greater(pc.binary_length(flat), 0)
    owner = np.repeat(np.arange(len(texts)), pc.list_value_length(lists).to_numpy(zero_copy_only=False))
    n = np.bincount(owner[real.to_numpy(zero_copy_only=False)], minlength=len(texts))
    # lower-cased only now: ascii_lower of a slice of a column is wrong in Arrow
    coded = pc.ascii_lower(flat.filter(real)).dictionary_encode()
    words, size = coded.dictionary, pc.binary_length(coded.dictionary)
    if len(words) and pc.max(size).as_py() > LONGEST:
        words = pa.array([" " + hashlib.sha256(w.encode()).hexdigest() if len(w.encode()) > LONGEST else w
                          for w in words.to_pylist()], pa.large_string())
    return words, coded.indices.to_numpy(zero_copy_only=False), n


def _counted(batches):
    """(word, n, learned): occurrences in all documents and in those to learn from, portion by portion."""
    for batch in batches:
        for part in portions(batch, 1, 12 << 20):
            words, index, n = _words(part.column(1))
            learn = np.repeat(part.column(0).to_numpy(zero_copy_only=False), n)
            every = np.bincount(index, minlength=len(words))
            learned = np.bincount(index[learn], minlength=len(words))
            yield pa.RecordBatch.from_arrays(
                [words.cast(pa.string()), pa.array(every, pa.int64()), pa.array(learned, pa.int64())],
                ["word", "n", "learned"])
            docs, mine = part.num_rows, pc.sum(part.column(0)).as_py()
            yield pa.RecordBatch.from_pydict({"word": [END], "n": [docs], "learned": [mine]})
    forget()


def word_counts(docs: DataFrame) -> DataFrame:
    """(word, n, learned) of all words and the end, written to the shared folder."""
    spark = docs.sparkSession
    path = table_path(spark, "word-counts")
    (docs.select(training().alias("learn"), text_of().alias("text"))
     .mapInArrow(_counted, "word string, n long, learned long")
     .groupBy("word").agg(F.sum("n").alias("n"), F.sum("learned").alias("learned")).write.parquet(path))
    return spark.read.schema("word string, n long, learned long").parquet(path)


@dataclass
class Vocabulary:
    """The broadcast words with their counts, their place in the model, and the corpus totals."""

    words: pa.Array
    learned: np.ndarray
    slot: np.ndarray  # place in the model, ``slots`` if it has none
    slots: int
    end: int  # place of the end of a document
    unigram: np.ndarray  # count of every place, and of all other words
    tokens: int
    kinds: int
    other_tokens: int
    other_kinds: int
    least: int  # words with at least so many occurrences are broadcast

    def look_up(self, words: pa.Array) -> np.ndarray:
        """Index in ``words`` of this vocabulary, -1 if absent."""
        found = pc.index_in(words, value_set=self.words)
        return pc.fill_null(found, -1).to_numpy(zero_copy_only=False)


def _cut_off(counts: DataFrame, most: int) -> int:
    """The least number of occurrences that at most ``most`` words reach; exact to a sixteenth."""
    rough = F.floor(F.log2("n") * 16)
    seen = counts.groupBy(rough.alias("b")).agg(F.count("*").alias("k"), F.min("n").alias("low")).collect()
    total, least = 0, 1 << 62
    for row in sorted(seen, key=lambda r: -r["b"]):
        total += row["k"]
        if total > most:
            break
        least = row["low"]
    return least


def vocabulary(counts: DataFrame, frequent: int = FREQUENT, slots: int = SLOTS) -> Vocabulary:
    least = _cut_off(counts, frequent)
    top = counts.filter((F.col("n") >= least) | (F.col("word") == END)).orderBy("word").toArrow()
    learned = top.column("learned").to_numpy()
    totals = counts.agg(F.sum("learned").alias("n"), F.count(F.when(F.col("learned") > 0, 1)).alias("kinds")).first()
    tokens, kinds = int(totals["n"] or 0), int(totals["kinds"])
    words = top.column("word").combine_chunks().cast(pa.large_string())
    end = np.flatnonzero(np.array(pc.equal(words, END)))
    rank = np.argsort(-learned, kind="stable")
    rank = rank[learned[rank] > 0][:slots]
    if len(rank) and end[0] not in rank:
        rank[-1] = end[0]
    slot = np.full(len(words), len(rank), np.int32)
    slot[rank] = np.arange(len(rank))
    inside = int(learned[rank].sum())
    return Vocabulary(words, learned, slot, len(rank), int(slot[end[0]]) if len(rank) else 0,
                      np.append(learned[rank], tokens - inside), tokens, kinds, tokens - inside, kinds - len(rank), least)


# --- the network ---------------------------------------------------------------


def _sigmoid(x: np.ndarray) -> np.ndarray:
    np.negative(x, out=x)
    np.exp(x, out=x)
    x += 1
    return np.reciprocal(x, out=x)


class Network:
    """Weights: input rows of the three gates, state to gates, state to candidate, classes, words of a class."""

    NAMES = ("given", "gates", "candidate", "classes", "class_bias", "words", "word_bias")

    def __init__(self, slots: int, end: int, weights: dict[str, np.ndarray]):
        self.slots, self.end = slots, end
        self.groups = -(-slots // PER_CLASS)
        for name in self.NAMES:
            setattr(self, name, weights[name])

    @staticmethod
    def shapes(slots: int) -> dict[str, tuple[int, ...]]:
        groups, h = -(-slots // PER_CLASS), STATE
        return {"given": (slots + 1, 3 * h), "gates": (h, 2 * h), "candidate": (h, h), "classes": (h, groups + 1),
                "class_bias": (groups + 1,), "words": (groups * PER_CLASS, h), "word_bias": (groups * PER_CLASS,)}

    @classmethod
    def fresh(cls, vocabulary: Vocabulary) -> "Network":
        """Small random weights; biases that give the unigram model."""
        rng = np.random.default_rng(11)
        n, shapes = vocabulary.slots, cls.shapes(vocabulary.slots)
        weights = {k: (rng.standard_normal(s) * 0.1).astype(np.float32) for k, s in shapes.items()}
        weights["gates"] *= 2
        weights["candidate"] *= 2
        weights["given"] *= 3
        count = vocabulary.unigram.astype(np.float64)
        inner = np.zeros(shapes["word_bias"][0])
        inner[:n] = count[:n]
        group = np.append(inner.reshape(-1, PER_CLASS).sum(axis=1), count[n] + 1)
        weights["class_bias"] = np.log(np.maximum(group, 1e-9)).astype(np.float32)
        weights["word_bias"] = np.where(inner > 0, np.log(np.maximum(inner, 1e-9)), -1e9).astype(np.float32)
        weights["words"] = weights["words"] * (inner > 0)[:, None].astype(np.float32)
        return cls(n, vocabulary.end, weights)

    def flat(self) -> np.ndarray:
        return np.concatenate([getattr(self, k).ravel() for k in self.NAMES])

    @classmethod
    def unflat(cls, slots: int, end: int, values: np.ndarray) -> "Network":
        weights, at = {}, 0
        for name, shape in cls.shapes(slots).items():
            size = int(np.prod(shape))
            weights[name] = values[at:at + size].reshape(shape).astype(np.float32)
            at += size
        return cls(slots, end, weights)

    def steps(self, codes: np.ndarray, state: np.ndarray, keep: bool = False):
        """States after each row of input ``codes`` (steps x lanes); with ``keep`` also what backpropagation needs."""
        h = STATE
        states = np.empty((len(codes), len(state), h), np.float32)
        given = self.given[codes]
        goes_on = (codes != self.end).astype(np.float32)[:, :, None]
        kept = []
        for t in range(len(codes)):
            state = state * goes_on[t]
            gate = _sigmoid(state @ self.gates + given[t, :, :2 * h])
            update, reset = gate[:, :h], gate[:, h:]
            shown = reset * state
            candidate = np.tanh(shown @ self.candidate + given[t, :, 2 * h:])
            if keep:
                kept.append((state, gate, shown, candidate))
            state = state + update * (candidate - state)
            states[t] = state
        return states, kept

    def output(self, states: np.ndarray, targets: np.ndarray, grads: dict | None = None):
        """Natural log-probability of the targets' places (and the gradient of the states)."""
        n = len(targets)
        group = targets // PER_CLASS
        group[targets == self.slots] = self.groups
        every = np.arange(n)
        logits = states @ self.classes
        logits += self.class_bias
        logits -= logits.max(axis=1, keepdims=True)
        picked = logits[every, group]
        np.exp(logits, out=logits)
        total = logits.sum(axis=1, keepdims=True)
        log_p = picked - np.log(total[:, 0])
        back = None
        if grads is not None:
            logits /= total
            logits[every, group] -= 1
            grads["classes"] = states.T @ logits
            grads["class_bias"] = logits.sum(axis=0)
            grads["words"], grads["word_bias"] = np.zeros_like(self.words), np.zeros_like(self.word_bias)
            back = logits @ self.classes.T
        order = np.argsort(group.astype(np.uint16), kind="stable")
        ends = np.cumsum(np.bincount(group, minlength=self.groups + 1))
        for g in range(self.groups):
            at = order[(ends[g - 1] if g else 0):ends[g]]
            if not len(at):
                continue
            mine = slice(g * PER_CLASS, (g + 1) * PER_CLASS)
            some, inner = states[at], targets[at] - g * PER_CLASS
            rows = every[:len(at)]
            score = some @ self.words[mine].T
            score += self.word_bias[mine]
            score -= score.max(axis=1, keepdims=True)
            chosen = score[rows, inner]
            np.exp(score, out=score)
            sums = score.sum(axis=1, keepdims=True)
            log_p[at] += chosen - np.log(sums[:, 0])
            if grads is not None:
                score /= sums
                score[rows, inner] -= 1
                grads["words"][mine] = score.T @ some
                grads["word_bias"][mine] = score.sum(axis=0)
                back[at] += score @ self.words[mine]
        return log_p, back

    def backward(self, codes: np.ndarray, kept: list, d_states: np.ndarray, grads: dict) -> None:
        """Gradients of the recurrent weights from those of the states, back through the window."""
        h = STATE
        d_given = np.empty(codes.shape + (3 * h,), np.float32)
        d_next = np.zeros_like(d_states[0])
        goes_on = (codes != self.end).astype(np.float32)[:, :, None]
        for t in range(len(codes) - 1, -1, -1):
            state, gate, shown, candidate = kept[t]
            update, reset = gate[:, :h], gate[:, h:]
            d = d_next + d_states[t]
            d_candidate = d * update
            d_candidate *= 1 - candidate * candidate
            d_shown = d_candidate @ self.candidate.T
            d_gate = np.concatenate([d * (candidate - state), d_shown * state], axis=1)
            d_gate *= gate * (1 - gate)
            d_given[t, :, :2 * h], d_given[t, :, 2 * h:] = d_gate, d_candidate
            d_next = d * (1 - update) + d_shown * reset + d_gate @ self.gates.T
            d_next *= goes_on[t]
        flat = d_given.reshape(-1, 3 * h)
        grads["gates"] = np.concatenate([k[0] for k in kept]).T @ flat[:, :2 * h]
        grads["candidate"] = np.concatenate([k[2] for k in kept]).T @ flat[:, 2 * h:]
        code = codes.ravel()
        order = np.argsort(code.astype(np.uint16), kind="stable")
        ordered = code[order]
        starts = np.flatnonzero(np.concatenate([[True], ordered[1:] != ordered[:-1]]))
        grads["given"] = (ordered[starts], np.add.reduceat(flat[order], starts, axis=0))


class Lanes:
    """Documents dealt to parallel lanes, the longest lanes first."""

    def __init__(self, codes: np.ndarray, n: np.ndarray, end: int, most: int = LANES):
        count = int(max(1, min(most, len(n), codes.size // LANE_STEPS)))
        load = [(0, k) for k in range(count)]
        lane, at = np.empty(len(n), np.int64), np.empty(len(n), np.int64)
        for k in np.argsort(-n, kind="stable").tolist():
            used, j = heapq.heappop(load)
            lane[k], at[k] = j, used
            heapq.heappush(load, (used + int(n[k]), j))
        used = np.zeros(count, np.int64)
        for total, j in load:
            used[j] = total
        rank = np.argsort(-used, kind="stable")
        place = np.empty(count, np.int64)
        place[rank] = np.arange(count)
        self.length = used[rank]
        lane = place[lane]
        begin = np.cumsum(n) - n
        # step and lane of every token, in the order of ``codes``
        self.step = np.repeat((at - begin).astype(np.int32), n)
        self.step += np.arange(codes.size, dtype=np.int32)
        self.lane = np.repeat(lane.astype(np.int32), n)
        self.targets = np.full((int(self.length[0]), count), end, np.int32)
        self.targets[self.step, self.lane] = codes
        self.inputs = np.vstack([np.full((1, count), end, np.int32), self.targets[:-1]])

    def windows(self, size: int):
        """(first step, inputs, targets, mask) of the lanes that still go on."""
        steps = len(self.targets)
        for t in range(0, steps, size):
            on = int(np.searchsorted(-self.length, -t, side="left"))
            to = min(t + size, steps, int(self.length[0]))
            valid = np.arange(t, to)[:, None] < self.length[None, :on]
            yield t, self.inputs[t:to, :on], self.targets[t:to, :on], valid


def learn(network: Network, lanes: Lanes, squares: dict[str, np.ndarray]) -> None:
    """Truncated backpropagation over the lanes, updating the network by Adagrad."""
    state = np.zeros((len(lanes.length), STATE), np.float32)
    scale = np.float32(1 / len(lanes.length))  # of all lanes: the last windows of few long lanes weigh less
    for _, inputs, targets, valid in lanes.windows(WINDOW):
        states, kept = network.steps(inputs, state[:inputs.shape[1]], keep=True)
        state = states[-1]
        grads: dict = {}
        _, back = network.output(states[valid], targets[valid], grads)
        d_states = np.zeros_like(states)
        d_states[valid] = back
        network.backward(inputs, kept, d_states, grads)
        for name, grad in grads.items():
            weight, square = getattr(network, name), squares[name]
            if name == "given":
                rows, grad = grad
                grad *= scale
                now = square[rows] + grad * grad
                square[rows] = now
                weight[rows] -= RATE * grad / np.sqrt(now)
            else:
                grad *= scale
                square += grad * grad
                weight -= RATE * grad / np.sqrt(square)


def log_likelihoods(network: Network, lanes: Lanes) -> np.ndarray:
    """Natural log-probability of every token's place, in the order the lanes were given."""
    out = np.zeros(lanes.targets.shape, np.float32)
    state = np.zeros((len(lanes.length), STATE), np.float32)
    for t, inputs, targets, valid in lanes.windows(2 * WINDOW):
        states, _ = network.steps(inputs, state[:inputs.shape[1]])
        state = states[-1]
        out[t:t + len(inputs), :inputs.shape[1]][valid] = network.output(states[valid], targets[valid])[0]
    return out[lanes.step, lanes.lane].astype(np.float64)


# --- training and scoring on Spark ----------------------------------------------


def _coded(batches, column: int, vocabulary: Vocabulary):
    """(batch slice, different words, their index in the vocabulary, index of every word, words per text)."""
    for batch in batches:
        for part in portions(batch, column, 12 << 20):
            words, index, n = _words(part.column(column))
            yield part, words, vocabulary.look_up(words), index, n


def _places(vocabulary: Vocabulary, known: np.ndarray, index: np.ndarray, n: np.ndarray):
    """Places in the model of all tokens, ends included, and tokens per text."""
    slot = np.append(vocabulary.slot, np.int32(vocabulary.slots))[known]
    codes, size = with_end(slot[index], n, vocabulary.end)
    return codes.astype(np.int32), size


def _trained(batches, shared, values):
    """Blocks of the weights after training on the partition, times its tokens."""
    vocabulary = shared.value
    network = Network.unflat(vocabulary.slots, vocabulary.end, values.value.copy())
    squares = {k: np.full(s, 1e-2, np.float32) for k, s in Network.shapes(vocabulary.slots).items()}
    held, size, tokens = [], 0, 0
    for _, _, known, index, n in _coded(batches, 0, vocabulary):
        held.append(_places(vocabulary, known, index, n))
        size += len(held[-1][0])
        if size >= BUFFER:
            tokens += size
            learn(network, Lanes(*map(np.concatenate, zip(*held)), vocabulary.end), squares)
            held, size = [], 0
    if size:
        tokens += size
        learn(network, Lanes(*map(np.concatenate, zip(*held)), vocabulary.end), squares)
    if tokens:
        flat = network.flat().astype(np.float64) * tokens
        part = TaskContext.get().partitionId()
        for k in range(0, len(flat), BLOCK):
            yield pa.RecordBatch.from_pydict({
                "block": [k // BLOCK], "part": [part], "tokens": [tokens], "weights": [flat[k:k + BLOCK].tobytes()]})
    forget()


_BLOCKS = "block long, part long, tokens long, weights binary"


def _added(batches, salts: int):
    """Sums of the weights of rows with equal block and salt, which come one after another."""
    key, total, tokens = None, None, 0

    def row():
        return pa.RecordBatch.from_arrays(
            [pa.array([key[0]], pa.int64()), pa.array([key[1]], pa.int64()), pa.array([tokens], pa.int64()),
             pa.array([total.tobytes()], pa.binary())], ["block", "part", "tokens", "weights"])

    for batch in batches:
        for block, part, n, weights in zip(*(c.to_pylist() for c in batch.columns)):
            if key != (block, part % salts):
                if key is not None:
                    yield row()
                key, total, tokens = (block, part % salts), np.zeros(len(weights) // 8), 0
            total += np.frombuffer(weights)
            tokens += n
    if key is not None:
        yield row()


def _averaged(parts: DataFrame) -> np.ndarray | None:
    """Mean of the tasks' weights, by tokens."""
    for salts in (SALTS, 1):
        parts = (parts.repartition("block", F.col("part") % salts)
                 .sortWithinPartitions("block", F.col("part") % salts, "part")
                 .mapInArrow(per_partition(_added, salts), _BLOCKS))
    rows = sorted(parts.collect(), key=lambda r: r["block"])  # one row per block
    if not rows:
        return None
    return np.concatenate([np.frombuffer(bytes(r["weights"])) / r["tokens"] for r in rows]).astype(np.float32)


def train(docs: DataFrame, vocabulary, spark: SparkSession) -> Network:
    """The network after ROUNDS rounds, each over the training documents that its hash names."""
    words = vocabulary.value
    network = Network.fresh(words)
    if not words.slots:
        return network
    part = F.pmod(F.xxhash64("doc_id", "text"), F.lit(ROUNDS))
    learned = docs.filter(training()).select("doc_id", text_of().alias("text"))
    for k in range(ROUNDS):
        values = spark.sparkContext.broadcast(network.flat())
        parts = learned.filter(part == k).select("text").mapInArrow(per_partition(_trained, vocabulary, values), _BLOCKS)
        mean = _averaged(parts)
        if mean is not None:
            network = Network.unflat(words.slots, words.end, mean)
        values.unpersist()
    return network


_SCORED = ("row long, word string, times long, doc_id long, held_out boolean, n_tokens long, n_known long, "
           "base double, score double")


def _scored(batches, shared, values):
    """A row per document with what the vocabulary decides, and a row per different other word of it."""
    vocabulary = shared.value
    network = Network.unflat(vocabulary.slots, vocabulary.end, values.value)
    learned = np.append(vocabulary.learned, 0)
    base_of = np.log10((learned + 1) / (vocabulary.tokens + vocabulary.kinds + 1))
    other_of = np.log10((learned + 1) / (vocabulary.other_tokens + vocabulary.other_kinds + 1))
    other_of[:-1][vocabulary.slot < vocabulary.slots] = 0  # the network has their whole probability
    base_of[-1] = other_of[-1] = 0  # joined later
    end = vocabulary.look_up(pa.array([END], pa.large_string()))[0]
    row = TaskContext.get().partitionId() << 40
    held, size = [], 0

    def rows():
        """The documents of the buffer."""
        ids, outs, sums, codes, n = (np.concatenate([h[k] for h in held]) for k in range(5))
        score = sums[:, 2]
        if vocabulary.slots:
            token = log_likelihoods(network, Lanes(codes, n, vocabulary.end))
            score = score + np.add.reduceat(token, np.cumsum(n) - n) / _LOG10
        first = row - len(ids)
        return pa.RecordBatch.from_pydict({
            "row": pa.array(first + np.arange(len(ids))), "word": pa.array([f" {first + k}" for k in range(len(ids))]),
            "times": pa.nulls(len(ids), pa.int64()), "doc_id": pa.array(ids.tolist(), pa.int64()),
            "held_out": pa.array(outs.astype(bool)), "n_tokens": pa.array(n, pa.int64()),
            "n_known": pa.array(sums[:, 0].astype(np.int64)), "base": pa.array(sums[:, 1]),
            "score": pa.array(score)})

    for part, words, known, index, n in _coded(batches, 2, vocabulary):
        docs = part.num_rows
        doc = np.repeat(np.arange(docs), n)
        word = known[index]
        sums = np.stack([np.bincount(doc, weights=w, minlength=docs) for w in (
            learned[word] > 0, base_of[word], other_of[word])], axis=1).astype(float)
        sums += [learned[end] > 0, base_of[end], 0] if end >= 0 else 0
        codes, size_of = _places(vocabulary, known, index, n)
        held.append((np.array(part.column(0).to_pylist(), object), part.column(1).to_numpy(zero_copy_only=False), sums,
                     codes, size_of))
        rare = np.flatnonzero(word < 0)
        if len(rare):
            pair, times = np.unique(doc[rare] * len(words) + index[rare], return_counts=True)
            at = pair // len(words)
            blank = pa.nulls(len(pair))
            yield pa.RecordBatch.from_pydict({
                "row": pa.array(row + at), "word": words.take(pa.array(pair % len(words))).cast(pa.string()),
                "times": pa.array(times, pa.int64()), "doc_id": blank.cast(pa.int64()),
                "held_out": blank.cast(pa.bool_()), "n_tokens": blank.cast(pa.int64()),
                "n_known": blank.cast(pa.int64()), "base": blank.cast(pa.float64()), "score": blank.cast(pa.float64())})
        row += docs
        size += len(codes)
        if size >= BUFFER:
            yield rows()
            held, size = [], 0
    if held:
        yield rows()
    forget()


def score_documents(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", frequent: int = FREQUENT,
                    slots: int = SLOTS) -> DataFrame:
    """doc_id, held_out, n_tokens, n_known, train_tokens, base_score, score for every whole text."""
    spark = docs.sparkSession
    docs = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).cast("string").alias("text"))
    counts = word_counts(docs)
    words = vocabulary(counts, frequent, slots)
    shared = spark.sparkContext.broadcast(words)
    values = spark.sparkContext.broadcast(train(docs, shared, spark).flat())
    rows = docs.select("doc_id", (~training()).alias("held_out"), text_of().alias("text")).mapInArrow(
        per_partition(_scored, shared, values), _SCORED)
    # the other words meet their counts; rows of documents pass with a key of their own
    rare = counts.filter((F.col("n") < words.least) & (F.col("learned") > 0) & (F.col("word") != END))
    seen = F.coalesce("learned", F.lit(0))
    base, other = ((F.log10((seen + 1) / F.lit(float(total)))) * F.col("times") for total in (
        words.tokens + words.kinds + 1, words.other_tokens + words.other_kinds + 1))
    return (rows.join(rare.select("word", "learned"), "word", "left")
            .groupBy("row").agg(
                F.max("doc_id").alias("doc_id"), F.max("held_out").alias("held_out"), F.max("n_tokens").alias("n_tokens"),
                F.sum(F.coalesce("n_known", F.when(F.col("learned") > 0, F.col("times")), F.lit(0))).alias("n_known"),
                F.sum(F.coalesce(F.col("base"), base)).alias("base_score"),
                F.sum(F.coalesce(F.col("score"), other)).alias("score"))
            .select("doc_id", "held_out", "n_tokens", "n_known", F.lit(words.tokens).cast("long").alias("train_tokens"),
                    "base_score", "score"))
