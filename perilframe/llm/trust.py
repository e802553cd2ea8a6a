"""Quality by positive-unlabelled learning with the non-negative unbiased risk.

Only texts that are labelled good are trusted; everything else is unlabelled web text, a mixture of
good and bad. With the share ``prior`` of good texts, the risk of a score f under the logistic loss is
prior * E_good[loss(f)] + max(0, E_unlabelled[loss(-f)] - prior * E_good[loss(-f)]); a step that would
take the second part below zero is undone instead of taken. The prior is the least ratio of the share
of all documents to the share of good ones above a score, under a first model that only tells good from
unlabelled, with good texts that it has not seen. Features are hashed words, shapes of words and bins
of measures.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from perilframe.llm.common import fresh, text_bytes

#: Good texts and unlabelled texts that the model is fitted on, at most.
POSITIVES, UNLABELLED = 3000, 9000
#: Hashed features, and the weight of the words' part against the shapes'.
DIMENSION, WORD_WEIGHT = 1 << 13, 0.25
EPOCHS, PARTS, RATE, DECAY = 30, 6, 0.05, 1e-4
#: Bins of the scores from which the prior is read, and the doubt allowed for in doing so.
BINS, DOUBT = 1000, 0.1
FROM = 0.3

#: Bytes of text whose features are computed together; a longer text is computed alone.
TOGETHER = 1 << 20


def _byte_classes() -> tuple[np.ndarray, np.ndarray]:
    """Per byte: itself in lower case, and its class (small or not ASCII, capital, digit, the sign itself)."""
    byte = np.arange(256, dtype=np.uint8)
    upper, lower = (byte >= 65) & (byte <= 90), (byte >= 97) & (byte <= 122) | (byte >= 128)
    kind = np.select([upper, lower, (byte >= 48) & (byte <= 57)], [np.uint8(65), np.uint8(97), np.uint8(48)], byte)
    return np.where(upper, byte | 32, byte).astype(np.uint8), kind


_LOWER, _KIND = _byte_classes()
_BLANK = np.isin(np.arange(256), [32, *range(9, 14)])
_BASE = 0x9E3779B97F4A7C15


def _mixed(h: np.ndarray) -> np.ndarray:
    h = (h ^ h >> np.uint64(31)) * np.uint64(0xBF58476D1CE4E5B9)
    return h ^ h >> np.uint64(29)


class _Hasher:
    """One number for each piece of a buffer of bytes, as differences of running sums."""

    def __init__(self) -> None:
        self._up = self._down = np.ones(1, np.uint64)

    def _grow(self, n: int) -> None:
        if len(self._up) < n:
            powers = []
            for base in (_BASE, pow(_BASE, -1, 1 << 64)):
                out = np.full(2 * n, np.uint64(base), np.uint64)
                out[0] = 1
                powers.append(np.multiply.accumulate(out))
            self._up, self._down = powers

    def pieces(self, data: np.ndarray, start: np.ndarray, stop: np.ndarray) -> np.ndarray:
        self._grow(len(data) + 1)
        sums = np.zeros(len(data) + 1, np.uint64)
        np.cumsum((data.astype(np.uint64) + np.uint64(1)) * self._up[: len(data)], out=sums[1:])
        return _mixed((sums[stop] - sums[start]) * self._down[start])


def _counted(row: np.ndarray, slot: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Different (row, slot) in order, with how often they come."""
    key, times = np.unique(row * DIMENSION + slot, return_counts=True)
    return key // DIMENSION, key % DIMENSION, times


def _slots(hashes: np.ndarray, salt: int) -> np.ndarray:
    return (_mixed(hashes + np.uint64(salt)) % np.uint64(DIMENSION)).astype(np.int64)


class Features:
    """Sparse feature vectors of texts."""

    def __init__(self) -> None:
        self._hasher = _Hasher()

    def of(self, texts: list[bytes]) -> Iterator[tuple[int, np.ndarray, np.ndarray, np.ndarray]]:
        """(number of texts, row, slot, value) of a bounded number of texts at a time, by row and slot."""
        held, size = [], 0
        for text in texts:
            held.append(text)
            size += len(text) + 1
            if size >= TOGETHER:
                yield len(held), *self._vectors(held)
                held, size = [], 0
        if held:
            yield len(held), *self._vectors(held)

    def _vectors(self, texts: list[bytes]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Words, shapes of words with pairs of shapes, and measures each have a length of their own."""
        n = len(texts)
        data = np.frombuffer(b"\n".join(texts) + b"\n", np.uint8)
        ends = np.cumsum([len(t) + 1 for t in texts])
        blank = _BLANK[data]
        edge = np.diff(np.r_[True, blank].astype(np.int8))
        start, stop = np.flatnonzero(edge == -1), np.flatnonzero(edge == 1)
        row = np.searchsorted(ends, start, side="right")
        words = self._hasher.pieces(_LOWER[data], start, stop)
        # A shape is the word with each run of one class as one character.
        kind = _KIND[data]
        keep = np.r_[True, kind[1:] != kind[:-1]]
        before = np.r_[0, np.cumsum(keep)]
        shapes = self._hasher.pieces(kind[keep], before[start], before[stop])
        together = np.flatnonzero(row[1:] == row[:-1])
        pairs = shapes[together] * np.uint64(3) + shapes[together + 1]
        parts = [
            (WORD_WEIGHT, row, _slots(words, 1)),
            (1.0, np.r_[row, row[together]], np.r_[_slots(shapes, 2), _slots(pairs, 3)]),
            (0.5, *self._measures(data, ends, row, words, stop - start)),
        ]
        rows, slots, values = [], [], []
        for weight, at, slot in parts:
            at, slot, times = _counted(at, slot)
            value = np.log1p(times)
            norm = np.sqrt(np.bincount(at, value**2, n))
            rows.append(at)
            slots.append(slot)
            values.append(weight * value / norm[at])
        key, at = np.unique(np.concatenate(rows) * DIMENSION + np.concatenate(slots), return_inverse=True)
        value = np.bincount(at, np.concatenate(values), len(key))
        return key // DIMENSION, key % DIMENSION, value.astype(np.float32)

    def _measures(self, data: np.ndarray, ends: np.ndarray, row: np.ndarray, words: np.ndarray,
                  sizes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(row, slot) of the bins of the measures: capitals, signs, repeated lines and words, lengths."""
        n = len(ends)
        upper, lower = (data >= 65) & (data <= 90), (data >= 97) & (data <= 122)
        signs = (data > 32) & (data < 127) & ~upper & ~lower
        begin = np.r_[0, ends[:-1]]
        upper, lower, signs = (np.add.reduceat(x, begin, dtype=np.int64) for x in (upper, lower, signs))
        count = np.bincount(row, minlength=n)
        line_stop = np.flatnonzero(data == 10)
        line_start = np.r_[0, line_stop[:-1] + 1]
        filled = np.add.reduceat(~_BLANK[data], line_start, dtype=np.int64) > 0
        line_row = np.searchsorted(ends, line_start[filled], side="right")
        lines = self._hasher.pieces(data, line_start[filled], line_stop[filled])
        shares = (
            upper / np.maximum(1, upper + lower), signs / np.maximum(1, ends - begin - 1),
            _repeated(line_row, lines, n), _repeated(row, words, n),
            np.minimum(1, np.bincount(row, sizes, n) / np.maximum(1, count) / 16), np.minimum(1, np.log2(1 + count) / 16),
        )
        names = [xxhash.xxh3_64_intdigest(b"%d" % k) for k in range(13 * len(shares))]
        slots = [np.array(names, np.uint64)[13 * k + (12 * x).astype(np.int64)] for k, x in enumerate(shares)]
        return np.tile(np.arange(n), len(shares)), _slots(np.concatenate(slots), 4)


def _repeated(row: np.ndarray, pieces: np.ndarray, n: int) -> np.ndarray:
    """Share of each row's pieces that equal an earlier one of the row."""
    order = np.lexsort((pieces, row))
    row, pieces = row[order], pieces[order]
    again = np.zeros(len(row))
    again[1:] = (row[1:] == row[:-1]) & (pieces[1:] == pieces[:-1])
    return np.bincount(row, again, n) / np.maximum(1, np.bincount(row, minlength=n))


class Sparse:
    """Rows of slots and values behind one another."""

    def __init__(self, rows: list[tuple[np.ndarray, np.ndarray]]):
        self.sizes = np.array([len(r[0]) for r in rows], np.int64)
        self.at = np.concatenate([r[0] for r in rows]) if rows else np.zeros(0, np.int32)
        self.value = np.concatenate([r[1] for r in rows]) if rows else np.zeros(0, np.float32)
        self.starts = np.cumsum(self.sizes) - self.sizes

    def times(self, weight: np.ndarray) -> np.ndarray:
        return np.add.reduceat(weight[self.at] * self.value, self.starts) if len(self.sizes) else np.zeros(0)

    def back(self, slope: np.ndarray) -> np.ndarray:
        return np.bincount(self.at, self.value * np.repeat(slope, self.sizes), DIMENSION)


def sigmoid(x: np.ndarray) -> np.ndarray:
    return 0.5 * (1 + np.tanh(0.5 * x))


def step(good: Sparse, rest: Sparse, weight: np.ndarray, bias: float, prior: float) -> tuple[np.ndarray, float, float]:
    """(gradient, its bias, second part of the risk) of the non-negative risk. Where the second part is
    below zero, the gradient is that of its opposite, which takes it up again."""
    f, g = good.times(weight) + bias, rest.times(weight) + bias
    part = float(np.logaddexp(0, g).mean() - prior * np.logaddexp(0, f).mean())
    down, up = -prior * sigmoid(-f) / len(f), prior * sigmoid(f) / len(f)
    side = sigmoid(g) / len(g)
    if part >= 0:
        slope, other = down - up, side
    else:
        slope, other = up, -side
    return good.back(slope) + rest.back(other), float(slope.sum() + other.sum()), part


def _told_apart(good: Sparse, rest: Sparse, weight: np.ndarray, bias: float, _: float) -> tuple[np.ndarray, float, float]:
    """Gradient of the plain logistic risk of good against unlabelled, both of weight one half."""
    slope = -sigmoid(-good.times(weight) - bias) / (2 * len(good.sizes))
    other = sigmoid(rest.times(weight) + bias) / (2 * len(rest.sizes))
    return good.back(slope) + rest.back(other), float(slope.sum() + other.sum()), 0.0


def train(good: list, rest: list, prior: float, gradient=step, seed: int = 7) -> tuple[np.ndarray, float]:
    """Weights and bias by Adam over ``PARTS`` shuffled parts per epoch, averaged over the last half."""
    draw = np.random.default_rng(seed)
    parts = max(1, min(PARTS, len(good), len(rest)))
    weight, total = np.zeros(DIMENSION + 1), np.zeros(DIMENSION + 1)
    first, second = np.zeros(DIMENSION + 1), np.zeros(DIMENSION + 1)
    n = kept = 0
    for epoch in range(EPOCHS):
        chosen = [np.array_split(draw.permutation(len(x)), parts) for x in (good, rest)]
        for a, b in zip(*chosen):
            slope, bias_slope, _ = gradient(Sparse([good[i] for i in a]), Sparse([rest[i] for i in b]),
                                            weight[:-1], weight[-1], prior)
            slope = np.r_[slope + DECAY * weight[:-1], bias_slope]
            n += 1
            first += 0.1 * (slope - first)
            second += 0.001 * (slope**2 - second)
            weight = weight - RATE * (first / (1 - 0.9**n)) / (np.sqrt(second / (1 - 0.999**n)) + 1e-8)
            if 2 * epoch >= EPOCHS:
                total += weight
                kept += 1
    total /= max(1, kept)
    return total[:-1], float(total[-1])


class Model:
    """Weights of the hashed features and calibration; ``prior`` is the estimated share of good texts."""

    def __init__(self, weight: np.ndarray, bias: float, prior: float):
        self.weight, self.bias, self.prior = weight.astype(np.float32), bias, prior
        self.steps: tuple[np.ndarray, np.ndarray] = (np.array([0.0, 1.0]), np.array([0.0, 1.0]))

    def raw(self, texts: list[bytes], features: Features) -> np.ndarray:
        """Scores before calibration."""
        found = [np.bincount(row, self.weight[at] * value, n) for n, row, at, value in features.of(texts)]
        return sigmoid(np.concatenate([np.zeros(0), *found]) + self.bias)

    def score(self, texts: list[bytes], features: Features) -> np.ndarray:
        return np.interp(self.raw(texts, features), *self.steps)


def estimated_prior(bins: np.ndarray, good: np.ndarray) -> float:
    """Least ratio of the share of all texts to that of good ones above a bin, given the number of all
    texts by bin and the good texts' bins; where few good texts are above, the doubt is too large."""
    above = np.cumsum(bins[::-1])[::-1] / max(1, bins.sum())
    good_above = np.cumsum(np.bincount(good, minlength=len(bins))[::-1])[::-1] / max(1, len(good))
    seen = np.flatnonzero(good_above > 0)
    if not len(seen):
        return 1.0
    spread = np.sqrt(np.log(4 / DOUBT) / 2) * (1 / np.sqrt(max(1, bins.sum())) + 1 / np.sqrt(max(1, len(good))))
    best = seen[np.argmin((above[seen] + spread) / good_above[seen])]
    return float(np.clip(above[best] / good_above[best], 0.01, 0.99))


def calibrated(bins: np.ndarray, good: np.ndarray, prior: float) -> tuple[np.ndarray, np.ndarray]:
    """Points of a rising line from a score to the share of good texts at it: prior times the density of
    good texts over that of all, in pools of neighbouring bins (pool adjacent violators)."""
    every = bins / max(1, bins.sum())
    share = prior * np.bincount(good, minlength=len(bins)) / max(1, len(good))
    pools: list[list[float]] = []
    for k in np.flatnonzero((every > 0) | (share > 0)).tolist():
        pools.append([every[k], share[k], k, k])
        while len(pools) > 1 and pools[-2][1] * pools[-1][0] >= pools[-1][1] * pools[-2][0]:
            last = pools.pop()
            pools[-1] = [pools[-1][0] + last[0], pools[-1][1] + last[1], pools[-1][2], last[3]]
    x, y = [], []
    for whole, part, first, last in pools:
        value = min(1.0, part / whole) if whole else 1.0
        x += [first / len(bins), (last + 1) / len(bins) - 1e-9]
        y += [value, value]
    return np.array(x or [0.0]), np.array(y or [0.0])


def _vectors(frame: DataFrame) -> DataFrame:
    """(id, at, value) of a frame (id, text)."""
    kind = frame.schema["id"].dataType.simpleString()

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        features = Features()
        for batch in batches:
            at, value, sizes = [], [], []
            for n, row, slot, x in features.of(text_bytes(batch.column(1))):
                at.append(slot)
                value.append(x)
                sizes.append(np.bincount(row, minlength=n))
            if not sizes:
                continue
            offsets = pa.array(np.r_[0, np.cumsum(np.concatenate(sizes))].astype(np.int32))
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.ListArray.from_arrays(offsets, pa.array(np.concatenate(at).astype(np.int32))),
                 pa.ListArray.from_arrays(offsets, pa.array(np.concatenate(value)))], ["id", "at", "value"])

    return frame.mapInArrow(run, f"id {kind}, at array<int>, value array<float>")


def _rows(frame: DataFrame) -> list[tuple[np.ndarray, np.ndarray]]:
    table = frame.toArrow()
    return [(np.asarray(r["at"], np.int32), np.asarray(r["value"], np.float32)) for r in table.to_pylist()]


def _samples(docs: DataFrame, labels: DataFrame, learnable: Column, doc_id: str, text: str, quality: str,
             positives: int, unlabelled: int) -> tuple[list, list]:
    """Feature vectors of at most so many good texts, and of unlabelled ones, both spread by hash."""
    known = (
        labels.where(F.col(f"`{doc_id}`").isNotNull() & F.col(f"`{quality}`").isNotNull() & learnable)
        .groupBy(F.col(f"`{doc_id}`").alias("id"))
        .agg(F.min(F.col(f"`{quality}`").cast("int")).alias("least"))
        .where("least = 1").select("id").orderBy(F.xxhash64("id"), "id").limit(positives)
    )
    narrow = docs.select(F.col(f"`{doc_id}`").alias("id"), F.col(f"`{text}`").alias("text"))
    # The list of ids is bounded by the parameter; an id that comes twice gives one text.
    good = _vectors(narrow.join(F.broadcast(known), "id").select("id", "text"))
    good = good.groupBy("id").agg(F.min(F.struct("at", "value")).alias("x")).orderBy(F.xxhash64("id")).select("x.*")
    total = narrow.count()
    place = F.xxhash64("id", "text", F.lit(11))
    # About a third more than wanted, so that sorting and the limit see few rows.
    most = int(min(1.0, 1.33 * unlabelled / max(1, total)) * 2**63) - 1
    drawn = _vectors(narrow.select(place.alias("id"), "text").where(F.abs("id") <= most))
    return _rows(good), _rows(drawn.orderBy("id", "at").limit(unlabelled).select("at", "value"))


def fit(docs: DataFrame, labels: DataFrame, learnable: Column, doc_id: str = "doc_id", text: str = "text",
        quality: str = "quality", positives: int = POSITIVES, unlabelled: int = UNLABELLED) -> Model:
    """``learnable`` is a condition on ``labels``. Half of the good texts are fitted, the others tell the
    prior and the calibration, both against all documents. Without a good text or without any document
    the model scores all texts 0."""
    good, rest = _samples(docs, labels, learnable, doc_id, text, quality, positives, unlabelled)
    if not good or not rest:
        return Model(np.zeros(DIMENSION), -np.inf, 0.0)
    half = -(-len(good) // 2)
    fitted, unseen = good[:half], Sparse(good[half:] or good)
    first = Model(*train(fitted, rest, 0.5, _told_apart), 0.5)
    prior = estimated_prior(_histogram(docs, text, first), _bins(first, unseen))
    model = Model(*train(fitted, rest, prior), prior)
    model.steps = calibrated(_histogram(docs, text, model), _bins(model, unseen), prior)
    return model


def _bins(model: Model, rows: Sparse) -> np.ndarray:
    score = sigmoid(rows.times(model.weight) + model.bias)
    return np.minimum((score * BINS).astype(int), BINS - 1)


def _histogram(docs: DataFrame, text: str, model: Model) -> np.ndarray:
    """How many of all documents have a score in each bin."""

    def count(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        features, bins = Features(), np.zeros(BINS, np.int64)
        for batch in batches:
            score = model.raw(text_bytes(batch.column(0)), features)
            bins += np.bincount(np.minimum((score * BINS).astype(int), BINS - 1), minlength=BINS)
        yield pa.RecordBatch.from_arrays([pa.array(range(BINS)), pa.array(bins)], ["bin", "n"])

    counted = docs.select(F.col(f"`{text}`")).mapInArrow(count, "bin long, n long")
    bins = np.zeros(BINS, np.int64)
    for row in counted.groupBy("bin").agg(F.sum("n").alias("n")).collect():  # one row per bin
        bins[row["bin"]] = row["n"]
    return bins


def scored(docs: DataFrame, model: Model, text: str = "text", name: str = "quality") -> DataFrame:
    """``docs`` with the score of each whole text, row by row. Null, empty and blank texts share one
    feature and so one score; equal texts have equal scores."""
    features = Features()

    @F.arrow_udf("double")
    def score(texts: pa.Array) -> pa.Array:
        return pa.array(model.score(text_bytes(texts), features), pa.float64())

    return docs.withColumn(name, score(F.col(f"`{text}`")))


def learnable(doc_id: str = "doc_id") -> Column:
    """Rows whose labels may be learnt from: four of five, by checksum of the id."""
    return F.crc32(F.col(f"`{doc_id}`").cast("string")) % 5 != 0


def assess(docs: DataFrame, labels: DataFrame, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """id, held_out, score and predicted of every document. Rows without id are not held out; repeated
    rows come as often as they occur; other columns are ignored."""
    model = fit(docs, labels, learnable(doc_id), doc_id, text)
    narrow = docs.select(F.col(f"`{doc_id}`"), F.col(f"`{text}`").alias("text_"))
    [found] = fresh(narrow, "score")
    return scored(narrow, model, "text_", found).select(
        f"`{doc_id}`",
        F.coalesce(~learnable(doc_id), F.lit(False)).alias("held_out"),
        F.col(found).alias("score"),
        (F.col(found) >= FROM).cast("int").alias("predicted"),
    )
