"""Language identification with interpolated Kneser-Ney character models.

Texts are lower-cased and every run of characters that are not letters
becomes one space.  For every language a model of order ``ORDER`` is trained:
absolute discounting, continuation counts in the lower orders, interpolation
down to a uniform distribution.  The models lie in sorted arrays of n-gram
hashes with one column of log-probabilities (and one of back-off weights) per
language, so a position costs one search for all languages together.

A text goes to the language with the lowest cross-entropy per character.
Rejection is calibrated on a quarter of the training documents, which the
models do not see.  They are cut into pieces of 8, 16, .. 256 characters; per
language and length class the ``QUANTILE`` of the pieces' cross-entropies,
``SLACK`` times as far from the language's mean, bounds what is accepted.
Longer texts share the last class, whose pieces vary as passages of one text
do: a long text is not rejected for a passage in another language.  Texts of
fewer than 8 scored characters are never rejected for their entropy.

The training sample is bounded: ``PER_LANGUAGE`` documents of each language,
those with the smallest hash of the id.  Everything else covers all rows and
whole texts.

Defined results: null text or no letter: ``und``, score 0, rejected; an empty
training set: ``und`` and score 0 for all, rejected only without a letter, as
nothing was learned that could reject; rows without language train nothing;
very long texts are scored whole.  ``drop_rejected`` decides row by row in one
pass, so null and repeated ids change nothing.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import cut, per_partition, small, text_of
from .tokens import forget, portions

ORDER = 4
#: Documents of each language that train the models (a quarter of them calibrates).
PER_LANGUAGE = 600
#: Bits of the id's hash that make a band.
BAND_BITS = 12
#: Quantile of the calibration pieces' cross-entropies, and the accepted multiple of its distance from the mean.
QUANTILE, SLACK = 0.998, 1.5
#: Length classes are powers of two of these exponents; one needs so many pieces to have a bound of its own.
CLASSES, PIECES = range(3, 9), 100
UNKNOWN = "und"
#: Characters scored at a time (a longer text is scored by itself).
_CHUNK = 1 << 18
_MIX = np.uint64(0x9E3779B97F4A7C15)
_SPACE = 32
_TABLES: dict[str, np.ndarray] = {}


def _letters() -> np.ndarray:
    """For every code point: itself if it is a letter, else a space."""
    table = np.full(0x110000, _SPACE, np.uint32)
    for c in range(0x110000):
        if chr(c).isalpha():
            table[c] = c
    return table


def characters(texts: list[str | None], order: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(code points, scored, letters per text) of texts cleaned one after another.

    A text with letters becomes order - 1 spaces, its letters with one space
    for every gap, and one space; all but the leading spaces are scored.
    """
    if "letters" not in _TABLES:
        _TABLES["letters"] = _letters()
    lowered = [(t or "").lower() for t in texts]
    raw = _TABLES["letters"][np.frombuffer("".join(lowered).encode("utf-32-le", "surrogatepass"), np.uint32)]
    size = np.array([len(t) for t in lowered], np.int64)
    at = np.flatnonzero(raw != _SPACE)
    owner = np.searchsorted(np.cumsum(size), at, side="right")
    letters = np.bincount(owner, minlength=len(texts))
    if not len(at):
        return np.empty(0, np.uint32), np.empty(0, bool), letters
    first = np.concatenate([[True], owner[1:] != owner[:-1]])
    last = np.concatenate([first[1:], [True]])
    gap = np.concatenate([[False], np.diff(at) > 1]) & ~first
    width = 1 + gap + last + np.where(first, order - 1, 0)
    end = np.cumsum(width)
    place = end - 1 - last  # of each letter
    codes = np.full(end[-1], _SPACE, np.uint32)
    codes[place] = raw[at]
    scored = np.zeros(end[-1], bool)
    scored[place] = True
    scored[place[gap] - 1] = True
    scored[place[last] + 1] = True
    return codes, scored, letters


def grams(codes: np.ndarray, order: int) -> np.ndarray:
    """64-bit hash of the ``order`` characters that end at each place from order - 1 on."""
    c = codes.astype(np.uint64) * _MIX
    c ^= c >> np.uint64(29)
    n = max(len(c) - order + 1, 0)
    h = np.full(n, order, np.uint64)
    for k in range(order if n else 0):
        h *= np.uint64(0xD1342543DE82EF95)
        h += c[k:k + n]
    h ^= h >> np.uint64(32)
    h *= _MIX
    return h


def _distinct(h: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Different values ascending, a place of each, and how often it occurs."""
    order = np.argsort(h, kind="stable")
    s = h[order]
    starts = np.flatnonzero(np.concatenate([[True], s[1:] != s[:-1]])) if len(s) else np.empty(0, np.int64)
    return s[starts], order[starts], np.diff(np.concatenate([starts, [len(s)]]))


def _counted(batches, order: int):
    """(lang, gram, n): how often each run of ``order`` characters occurs in a batch."""
    for batch in batches:
        by: dict[str, list] = {}
        for lang, text in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
            by.setdefault(lang, []).append(text)
        for lang, texts in by.items():
            codes, scored, _ = characters(texts, order)
            ends = np.flatnonzero(scored)
            if not len(ends):
                continue
            _, at, n = _distinct(grams(codes, order)[ends - order + 1])
            begin = ends[at] - order + 1
            strings = [codes[b:b + order].tobytes().decode("utf-32-le", "surrogatepass") for b in begin.tolist()]
            yield pa.RecordBatch.from_pydict({
                "lang": pa.array([lang] * len(n), pa.string()), "gram": pa.array(strings, pa.string()),
                "n": pa.array(n, pa.int64())})


class Sorted:
    """A sorted hash array with a directory of its leading bits; a row of floats per hash."""

    def __init__(self, hashes: np.ndarray, rows: np.ndarray):
        order = np.argsort(hashes)
        self.hashes, self.rows = hashes[order], np.ascontiguousarray(rows[order], np.float32)
        bits = max(1, min(22, len(hashes).bit_length()))
        self.shift = np.uint64(64 - bits)
        self.start = np.searchsorted(self.hashes >> self.shift, np.arange((1 << bits) + 1, dtype=np.uint64))

    def find(self, queries: np.ndarray) -> np.ndarray:
        """Row of every query, -1 where it is absent."""
        head = (queries >> self.shift).astype(np.int64)
        at, end = self.start[head], self.start[head + 1]
        found = np.full(len(queries), -1, np.int64)
        left = np.flatnonzero(at < end)
        at, end = at[left], end[left]
        while len(left):
            value = self.hashes[at]
            hit = value == queries[left]
            found[left[hit]] = at[hit]
            on = (value < queries[left]) & (at + 1 < end)
            left, at, end = left[on], at[on] + 1, end[on]
        return found


class Models:
    """Interpolated Kneser-Ney models of several languages over common sorted arrays."""

    def __init__(self, langs: list[str], grams_of: list[str], counts: np.ndarray, lang_of: np.ndarray, order: int):
        self.langs, self.order = langs, order
        many = len(langs)
        chars = np.array([[ord(c) for c in g] for g in grams_of], np.uint32).reshape(-1, order)
        hashes = {k: self._hash(chars[:, order - k:]) for k in range(1, order + 1)}
        before = {k: self._hash(chars[:, order - k:order - 1]) for k in range(2, order + 1)}
        before[1] = np.zeros(len(chars), np.uint64)
        alphabet = len(np.unique(chars[:, -1])) + 1 if len(chars) else 1
        self.unseen = np.full(many, -np.log(alphabet), np.float32)
        self.tables: dict[int, Sorted] = {}
        self.back: dict[int, Sorted] = {}
        lower: Sorted | None = None
        for k in range(1, order + 1):
            types, pick, _ = _distinct(hashes[k])
            ids = np.searchsorted(types, hashes[k])
            count = np.zeros((len(types), many))
            if k == order:
                np.add.at(count, (ids, lang_of), counts)
            else:  # in how many different characters' wake the gram occurs
                both = _distinct(hashes[k + 1] + lang_of.astype(np.uint64) * _MIX)[1]
                np.add.at(count, (ids[both], lang_of[both]), 1)
            heads, head_pick, _ = _distinct(before[k][pick])
            head = np.searchsorted(heads, before[k][pick])
            total, kinds = np.zeros((len(heads), many)), np.zeros((len(heads), many))
            np.add.at(total, head, count)
            np.add.at(kinds, head, count > 0)
            ones, twos = (count == 1).sum(axis=0), (count == 2).sum(axis=0)
            off = np.where(ones > 0, ones / np.maximum(ones + 2 * twos, 1), 0.5)
            back = np.where(total > 0, off * kinds / np.maximum(total, 1), 1.0)
            if lower is None:
                below = np.full((len(types), many), 1 / alphabet)
            else:
                below = np.exp(lower.rows[lower.find(hashes[k - 1][pick])])
            p = np.maximum(count - off, 0) / np.maximum(total, 1)[head] + back[head] * below
            lower = self.tables[k] = Sorted(types, np.log(np.maximum(p, 1e-12)))
            self.back[k] = Sorted(heads, np.log(np.maximum(back, 1e-12)))

    @staticmethod
    def _hash(chars: np.ndarray) -> np.ndarray:
        """``grams`` of every row of characters."""
        n = chars.shape[1]
        return grams(chars.reshape(-1), n)[::n] if chars.size else np.empty(0, np.uint64)

    def entropies(self, codes: np.ndarray, scored: np.ndarray) -> np.ndarray:
        """Minus log-probability of every scored character, a column per language."""
        ends = np.flatnonzero(scored)
        if not self.langs:
            return np.zeros((len(ends), 0))
        table = self.tables[self.order]
        row = table.find(grams(codes, self.order)[ends - self.order + 1])
        out = table.rows[row]
        left = np.flatnonzero(row < 0)  # runs that no language has seen
        if len(left):
            out[left] = 0
            for k in range(self.order - 1, -1, -1):
                at = ends[left]
                head = self.back[k + 1].find(grams(codes, k)[at - k] if k else np.zeros(len(at), np.uint64))
                out[left] += np.where((head >= 0)[:, None], self.back[k + 1].rows[head], 0)
                if not k:
                    out[left] += self.unseen
                    break
                row = self.tables[k].find(grams(codes, k)[at - k + 1])
                out[left[row >= 0]] += self.tables[k].rows[row[row >= 0]]
                left = left[row < 0]
                if not len(left):
                    break
        return -out

    def score(self, texts: list[str | None]) -> tuple[np.ndarray, np.ndarray]:
        """(cross-entropy per character in every language, characters) of the texts."""
        codes, scored, letters = characters(texts, self.order)
        some = np.flatnonzero(letters)
        total, n = np.zeros((len(texts), len(self.langs))), np.zeros(len(texts), np.int64)
        if len(some):
            # a part begins with its order - 1 spaces, which are not scored
            first = np.flatnonzero(scored & ~np.concatenate([[False], scored[:-1]]))
            starts = np.cumsum(scored)[first] - 1
            total[some] = np.add.reduceat(self.entropies(codes, scored), starts, axis=0, dtype=np.float64)
            n[some] = np.diff(np.concatenate([starts, [scored.sum()]]))
            total[some] /= n[some][:, None]
        return total, n


def _groups(texts: list[str | None]):
    """Texts in runs of about _CHUNK characters."""
    held, size = [], 0
    for text in texts:
        held.append(text)
        size += len(text or "")
        if size >= _CHUNK:
            yield held
            held, size = [], 0
    if held:
        yield held


def _length_class(n: np.ndarray) -> np.ndarray:
    """Index of the length class, -1 for shorter texts."""
    return np.clip(np.frexp(np.maximum(n, 1))[1] - 1, CLASSES[0] - 1, CLASSES[-1]) - CLASSES[0]


def _judged(texts: list[str | None], models: Models, limits: dict | None):
    """(best language, score, its cross-entropy, scored characters, rejected) of every text."""
    parts = [models.score(g) for g in _groups(texts)]
    entropy, n = (np.concatenate([p[k] for p in parts]) for k in (0, 1))
    none = (n == 0) | (not models.langs)
    if models.langs:
        best = entropy.argmin(axis=1)
        low = entropy[np.arange(len(n)), best]
        gap = (entropy - low[:, None]) * np.minimum(n, 100)[:, None]
        score = np.where(none, 0.0, 1 / np.exp(-gap).sum(axis=1))
    else:
        best, low, score = np.zeros(len(n), np.int64), np.zeros(len(n)), np.zeros(len(n))
    rejected = n == 0
    if limits is not None and models.langs:
        bounds = np.array([limits.get(lang, [np.inf] * len(CLASSES)) + [np.inf] for lang in models.langs])
        rejected |= low > bounds[best, _length_class(n)]  # the last column is for shorter texts
    return np.where(none, len(models.langs), best), score, np.where(none, 0.0, low), n, rejected


def _predict(batches, models: Models, limits: dict | None):
    names = np.array(models.langs + [UNKNOWN], object)
    for batch in batches:
        for part in portions(batch, 1):
            best, score, low, n, rejected = _judged(part.column(1).to_pylist(), models, limits)
            yield pa.RecordBatch.from_pydict({
                "doc_id": part.column(0), "lang_pred": pa.array(names[best], pa.string()),
                "score": pa.array(score, pa.float64()), "cross_entropy": pa.array(low, pa.float64()),
                "n_scored": pa.array(n, pa.int64()), "rejected": pa.array(rejected, pa.bool_())})
    forget()


def _accepted(batches, models: Models, limits: dict | None, at: int):
    """The rows whose text, the ``at``-th column, is not rejected."""
    for batch in batches:
        text = pa.RecordBatch.from_arrays([batch.column(at).cast(pa.large_string()).fill_null("")], ["text"])
        begin = 0
        for part in portions(text, 0):
            rejected = _judged(part.column(0).to_pylist(), models, limits)[4]
            kept = batch.slice(begin, part.num_rows).filter(pa.array(~rejected))
            begin += part.num_rows
            if kept.num_rows:
                yield kept
    forget()


def _pieces(batches, models: Models):
    """(lang, class, cross_entropy) of the pieces of calibration documents, in each document's best language."""
    for batch in batches:
        for text in batch.column(0).to_pylist():
            codes, scored, letters = characters([text], models.order)
            if not letters[0]:
                continue
            every = models.entropies(codes, scored)
            best = int(every.sum(axis=0).argmin())
            mine = every[:, best].astype(np.float64)
            for k, exponent in enumerate(CLASSES):
                many = len(mine) >> exponent
                if many:
                    mean = mine[:many << exponent].reshape(many, -1).mean(axis=1)
                    yield pa.RecordBatch.from_pydict({
                        "lang": pa.array([models.langs[best]] * many, pa.string()), "k": pa.array([k] * many, pa.int64()),
                        "cross_entropy": pa.array(mean, pa.float64())})


_OUT = "doc_id long, lang_pred string, score double, cross_entropy double, n_scored long, rejected boolean"


def held_out(id_col: str = "doc_id") -> Column:
    """Documents that never train: crc32 of the id as text, mod 4, is 2 (a null id never trains)."""
    return F.coalesce(F.crc32(F.col(id_col).cast("string")) % 4 == 2, F.lit(True))


def training_sample(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", lang_col: str = "lang",
                    per_language: int = PER_LANGUAGE) -> DataFrame:
    """(doc_id, text, lang, calibrates): the bounded sample; ids are chosen before texts are read.

    Counts per band of the hash tell in which bands the smallest hashes of a
    language lie; only ids of those bands are ranked.
    """
    order = Window.partitionBy("lang").orderBy("h", "doc_id")
    lower = Window.partitionBy("lang").orderBy("band").rowsBetween(Window.unboundedPreceding, -1)
    known = (docs.filter(~held_out(id_col) & F.col(lang_col).isNotNull())
             .select(F.col(id_col).alias("doc_id"), F.col(lang_col).alias("lang"), F.xxhash64(id_col).alias("h"))
             .withColumn("band", F.shiftright("h", 64 - BAND_BITS)))
    bands = (known.groupBy("lang", "band").agg(F.count("*").alias("n"))
             .withColumn("before", F.coalesce(F.sum("n").over(lower), F.lit(0)))
             .filter(F.col("before") < per_language).select("lang", "band"))
    ids = (known.join(small(cut(bands), 64), ["lang", "band"], "left_semi")
           .withColumn("k", F.row_number().over(order)).filter(F.col("k") <= per_language))
    chosen = small(cut(ids.select(F.col("doc_id").alias("__id"), F.col("lang").alias("__lang"),
                                  (F.col("k") % 4 == 0).alias("calibrates"))), 64)
    return docs.join(chosen, (docs[id_col] == chosen["__id"]) & (docs[lang_col] == chosen["__lang"])).select(
        F.col(id_col).alias("doc_id"), text_of(text_col).alias("text"), F.col(lang_col).alias("lang"), "calibrates")


def train(sample: DataFrame, order: int = ORDER) -> tuple[Models, dict[str, list[float]]]:
    """Models from the sample, and per language the largest accepted cross-entropy of each length class."""
    sample = cut(sample)
    counted = (sample.filter(~F.col("calibrates")).select("lang", "text")
               .mapInArrow(per_partition(_counted, order), "lang string, gram string, n long")
               .groupBy("lang", "gram").agg(F.sum("n").alias("n")).toArrow())
    langs = sorted(set(counted.column("lang").to_pylist()))
    place = {lang: k for k, lang in enumerate(langs)}
    models = Models(langs, counted.column("gram").to_pylist(), counted.column("n").to_numpy().astype(float),
                    np.array([place[x] for x in counted.column("lang").to_pylist()], np.int64), order)
    pieces = cut(sample.filter("calibrates").select("text").mapInArrow(
        per_partition(_pieces, models), "lang string, k long, cross_entropy double"))
    seen = pieces.groupBy("lang", "k").agg(
        F.count("*").alias("n"), F.avg("cross_entropy").alias("mean"),
        F.percentile_approx("cross_entropy", QUANTILE, 10_000).alias("high")).collect()
    limits = {}
    for lang in langs:
        found = {r["k"]: r for r in seen if r["lang"] == lang}
        bounds: list[float] = []
        for k in range(len(CLASSES)):  # a class of few pieces takes the bound of the class before
            r = found.get(k)
            own = r["mean"] + SLACK * (r["high"] - r["mean"]) if r is not None and r["n"] >= PIECES else np.inf
            bounds.append(own if own < np.inf or not bounds else bounds[-1])
        limits[lang] = bounds
    return models, limits


def identify(docs: DataFrame, models: Models, limits: dict, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """doc_id, lang_pred, score, cross_entropy, n_scored, rejected for every whole text."""
    return docs.select(F.col(id_col).cast("long").alias("doc_id"), text_of(text_col).alias("text")).mapInArrow(
        per_partition(_predict, models, limits), _OUT)


def detect_languages(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                     lang_col: str = "lang") -> DataFrame:
    """Train on the bounded sample of ``docs`` and predict every document."""
    models, limits = train(training_sample(docs, id_col, text_col, lang_col))
    return identify(docs, models, limits, id_col, text_col)


def drop_rejected(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", lang_col: str = "lang") -> DataFrame:
    """The documents whose language is not rejected, with all their columns, in one pass without a shuffle."""
    models, limits = train(training_sample(docs, id_col, text_col, lang_col))
    return docs.mapInArrow(per_partition(_accepted, models, limits, docs.columns.index(text_col)), docs.schema)
