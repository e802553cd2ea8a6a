"""Toxicity by nearest labelled examples: exact TF-IDF cosine over a block-max inverted index.

A bounded sample of labelled texts gives the examples, clean ones too, and all their terms enter the
index. A term's weight is its TF-IDF, its document frequency taken from all documents, times how much
its presence goes with the label; no term's weight is nought. The index keeps the postings of a term in
blocks of examples, each with its largest weight; blocks are visited by falling upper bound until none
can hold a nearer example, so the neighbours are exact. Their votes, weighted by similarity, are
calibrated on the examples themselves, each scored without its own vote.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from perilframe.llm.common import fresh, give_back, shingle_hashes, staged, term_hashes, terms

#: Labelled examples of each class at most.
EXAMPLES = 2000
#: Weight of a term without any association with the label, against 1 for one that decides it.
INDIFFERENT = 0.01
NEIGHBOURS, BLOCK = 15, 64
#: Blocks visited at first; all that can then still hold a nearer example come next, at one go.
VISIT = 4
#: Heaviest terms and nearest examples given as evidence.
HEAVIEST, NEAREST = 5, 3
#: Examples that share their least shingle of so many terms count as copies; one of them is used.
SHINGLE = 5


def _vectors(texts: pa.Array, vocabulary: pa.Array) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Term numbers and counts of each text, over the vocabulary."""
    dictionary, index, offsets = terms(texts)
    number = _numbers(dictionary, vocabulary)
    at = number[index] if len(index) else np.zeros(0, np.int64)
    known = np.flatnonzero(at >= 0)
    cut = np.searchsorted(known, offsets)
    for a, b in zip(cut, cut[1:]):
        yield np.unique(at[known[a:b]], return_counts=True)


def _numbers(words: pa.Array, vocabulary: pa.Array) -> np.ndarray:
    """Place of each word in the vocabulary, -1 where it is not there."""
    found = pc.index_in(words.cast(pa.large_string()), value_set=vocabulary)
    return pc.fill_null(found, -1).to_numpy(zero_copy_only=False).astype(np.int64)


def _sample(labels: DataFrame, learnable: Column, doc_id: str, toxic: str) -> tuple[DataFrame, dict]:
    """At most EXAMPLES ids of each class, spread by hash, and how many there are of each. An id with
    several labels counts as toxic if one says so; null ids and labels are left out."""
    known = (
        labels.where(F.col(f"`{doc_id}`").isNotNull() & F.col(f"`{toxic}`").isNotNull() & learnable)
        .groupBy(F.col(f"`{doc_id}`").alias("id"))
        .agg(F.max(F.col(f"`{toxic}`").cast("int")).alias("toxic"))
    )
    counts = {r["toxic"]: r["n"] for r in known.groupBy("toxic").agg(F.count("*").alias("n")).collect()}
    parts = [
        known.where(F.col("toxic") == c).orderBy(F.xxhash64("id"), "id").limit(EXAMPLES)
        for c in (0, 1)
    ]
    rows = parts[0].union(parts[1]).collect()  # bounded by the parameter
    return labels.sparkSession.createDataFrame(rows, known.schema), counts


def _example_rows(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Different terms of each example with their counts, and its least shingle."""
    for batch in batches:
        dictionary, index, offsets = terms(batch.column(2))
        hashes, words = term_hashes(dictionary), dictionary.to_pylist()
        found = [np.unique(index[a:b], return_counts=True) for a, b in zip(offsets, offsets[1:])]
        least = []
        for a, b in zip(offsets, offsets[1:]):
            shingles = shingle_hashes(hashes[index[a:b]], min(SHINGLE, max(1, b - a)))
            least.append(int(shingles.min().view(np.int64)) if len(shingles) else 0)
        yield pa.RecordBatch.from_arrays(
            [batch.column(0), batch.column(1), pa.array(least, pa.int64()),
             pa.array([[words[i] for i in at] for at, _ in found], pa.list_(pa.string())),
             pa.array([count for _, count in found], pa.list_(pa.int64()))],
            ["id", "toxic", "least", "terms", "count"],
        )


def _spread(first: np.ndarray, stop: np.ndarray) -> np.ndarray:
    """All places of the ranges, one after another."""
    length = stop - first
    return np.arange(length.sum()) + np.repeat(first - np.cumsum(length) + length, length)


class Index:
    """Postings of every term by blocks of examples, each with the largest weight in it.

    ``vectors`` holds the terms and weights of each example; all weights are above 0. ``order`` tells
    which example stands at each position.
    """

    def __init__(self, ids: list, labels: np.ndarray, vectors: list[tuple[np.ndarray, np.ndarray]], n_terms: int):
        # Alike examples stand together: by their heaviest term.
        heaviest = [at[weight.argmax()] if len(at) else -1 for at, weight in vectors]
        order = np.argsort(heaviest, kind="stable") if vectors else np.zeros(0, int)
        self.order, self.ids, self.labels = order, [ids[i] for i in order], labels[order]
        self.blocks = -(-len(order) // BLOCK)
        example = np.repeat(np.arange(len(order)), [len(vectors[i][0]) for i in order]).astype(np.int32)
        term = np.concatenate([vectors[i][0] for i in order] or [np.zeros(0, np.int64)])
        weight = np.concatenate([vectors[i][1] for i in order] or [np.zeros(0)])
        by_term = np.argsort(term, kind="stable")
        term, self.example, self.weight = term[by_term], example[by_term], weight[by_term].astype(np.float32)
        block = self.example // BLOCK
        new = np.r_[True, (term[1:] != term[:-1]) | (block[1:] != block[:-1])] if len(term) else np.zeros(0, bool)
        start = np.flatnonzero(new)
        self.block = block[start]
        self.largest = np.maximum.reduceat(self.weight, start) if len(start) else np.zeros(0, np.float32)
        self.start = np.r_[start, len(term)]
        self.of_term = np.searchsorted(term[start], np.arange(n_terms + 1))

    def nearest(self, at: np.ndarray, weight: np.ndarray, k: int, without: int = -1) -> list[tuple[float, int]]:
        """The k nearest examples with a term in common, (similarity, position), ties by position."""
        first, stop = self.of_term[at], self.of_term[at + 1]
        lists = _spread(first, stop)
        factor = np.repeat(weight.astype(np.float64), stop - first)
        block = self.block[lists]
        bound = np.bincount(block, factor * self.largest[lists], self.blocks)
        order = np.argsort(-bound, kind="stable")
        best, similar = np.zeros(0, np.int64), np.zeros(len(self.ids))
        for visit in (order[:VISIT], order[VISIT:]):
            chosen = np.zeros(self.blocks, bool)
            chosen[visit] = True
            if len(best) == k:
                chosen &= bound >= similar[best[-1]] - 1e-6
            here = np.flatnonzero(chosen[block])
            if not len(here):
                break
            a, b = self.start[lists[here]], self.start[lists[here] + 1]
            postings = _spread(a, b)
            similar += np.bincount(self.example[postings], np.repeat(factor[here], b - a) * self.weight[postings],
                                   len(self.ids))  # blocks are visited once, so an example's sum is whole
            found = np.flatnonzero(similar)
            if without >= 0:
                found = found[found != without]
            if len(found) > k:  # those as near as the k-th, ties among them
                found = found[similar[found] >= np.partition(similar[found], -k)[-k]]
            best = found[np.lexsort((found, -similar[found]))][:k]
        return [(float(similar[i]), int(i)) for i in best]


class Model:
    """Vocabulary, weights of its terms, index and calibration; bounded by the sample."""

    def __init__(self, vocabulary: pa.Array, factor: np.ndarray, prior: float):
        self.vocabulary, self.factor, self.prior = vocabulary, factor, prior
        self.index = Index([], np.zeros(0), [], len(vocabulary))
        self.steps: tuple[np.ndarray, np.ndarray] = (np.array([0.0, 1.0]), np.array([0.0, 1.0]))

    def weigh(self, at: np.ndarray, count: np.ndarray) -> np.ndarray:
        weight = (1 + np.log(count)) * self.factor[at]
        return weight / np.linalg.norm(weight)

    def vote(self, best: list[tuple[float, int]]) -> float:
        """Share of toxic votes, weighted by similarity."""
        total = sum(s for s, _ in best)
        return sum(s * self.index.labels[i] for s, i in best) / total

    def score(self, best: list[tuple[float, int]]) -> float:
        """Calibrated; without any example in common it is the share of toxic among such texts."""
        return float(np.interp(self.vote(best), *self.steps)) if best else self.prior


def association(a: np.ndarray, b: np.ndarray, ones: int, zeros: int) -> np.ndarray:
    """How much a term's presence goes with the label, 0 to 1: the phi coefficient with correction for
    continuity, where ``a`` of the ``ones`` and ``b`` of the ``zeros`` have the term."""
    n = ones + zeros
    off = np.maximum(0.0, np.abs(a * zeros - b * ones) - n / 2)
    spread = float(ones) * zeros * (a + b) * (n - a - b)
    return np.sqrt(np.divide(off**2, spread, out=np.zeros(len(a)), where=spread > 0))


def _calibrated(raw: np.ndarray, label: np.ndarray, weight: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Rising steps through the labels (pool adjacent violators), as points to interpolate."""
    pools: list[list[float]] = []
    for x, y, w in sorted(zip(raw, label, weight)):
        pools.append([x * w, y * w, w])
        while len(pools) > 1 and pools[-2][1] / pools[-2][2] >= pools[-1][1] / pools[-1][2]:
            last = pools.pop()
            pools[-1] = [a + b for a, b in zip(pools[-1], last)]
    return np.array([p[0] / p[2] for p in pools]), np.array([p[1] / p[2] for p in pools])


def fit(docs: DataFrame, labels: DataFrame, learnable: Column, doc_id: str = "doc_id",
        text: str = "text", toxic: str = "toxic") -> Model:
    """``learnable`` is a condition on ``labels``. With examples of one class alone, or of none, the
    model scores all texts 1 where that class is the toxic one, otherwise 0."""
    sample, counts = _sample(labels, learnable, doc_id, toxic)
    nothing = pa.array([], pa.large_string())
    if not counts.get(1) or not counts.get(0):
        return Model(nothing, np.zeros(0), float(bool(counts.get(1))))
    rate = counts[1] / (counts[0] + counts[1])
    narrow = docs.select(F.col(f"`{doc_id}`").alias("id"), F.col(f"`{text}`").alias("text"))
    id_type = sample.schema["id"].dataType.simpleString()
    # Two classes of EXAMPLES ids at most, so the broadcast is bounded. Of copies the first stays.
    examples = staged(
        narrow.join(F.broadcast(sample), "id")
        .select("id", "toxic", "text")
        .mapInArrow(_example_rows, f"id {id_type}, toxic int, least long, terms array<string>, count array<long>")
        .groupBy("least").agg(F.min(F.struct("id", "toxic", "terms", "count")).alias("e"))
        .select("e.*")
    )
    sizes = {r["toxic"]: r["n"] for r in examples.groupBy("toxic").agg(F.count("*").alias("n")).collect()}
    if not sizes:
        return Model(nothing, np.zeros(0), rate)
    counted = examples.select("toxic", F.explode("terms").alias("term")).groupBy("term").agg(
        F.count_if(F.col("toxic") == 1).alias("a"), F.count_if(F.col("toxic") == 0).alias("b")
    ).toArrow().sort_by("term")  # the terms of the sample
    vocabulary = counted["term"].combine_chunks().cast(pa.large_string())

    def frequencies(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen, n = np.zeros(len(vocabulary), np.int64), 0
        for batch in batches:
            n += batch.num_rows
            for at, _ in _vectors(batch.column(0), vocabulary):
                seen[at] += 1
        at = np.flatnonzero(seen)
        yield pa.RecordBatch.from_arrays([pa.array(np.r_[-1, at]), pa.array(np.r_[n, seen[at]])], ["term", "n"])
        give_back()

    def vectors(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            words = batch.column(2)
            at = pa.ListArray.from_arrays(
                words.offsets, pa.array(_numbers(words.values, vocabulary)), mask=words.is_null())
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), at, batch.column(3)],
                                             ["id", "toxic", "at", "count"])

    seen = narrow.select("text").mapInArrow(frequencies, "term long, n long").groupBy("term").agg(
        F.sum("n").alias("n")).toArrow()
    in_docs = np.zeros(len(vocabulary) + 1)
    in_docs[seen["term"].to_numpy()] = seen["n"].to_numpy()  # the number of documents comes last
    idf = np.log((1 + in_docs[-1]) / (1 + in_docs[:-1])) + 1
    told = association(counted["a"].to_numpy().astype(float), counted["b"].to_numpy().astype(float),
                       sizes.get(1, 0), sizes.get(0, 0))
    model = Model(vocabulary, idf * (INDIFFERENT + (1 - INDIFFERENT) * told), rate)
    rows = examples.mapInArrow(vectors, f"id {id_type}, toxic int, at array<long>, count array<long>").orderBy(
        "id", "toxic", "at", "count").toArrow()
    at = [np.array(x.values) for x in rows["at"]]
    count = [np.array(x.values) for x in rows["count"]]
    label, ids = rows["toxic"].to_numpy().astype(float), rows["id"].to_pylist()
    real = [i for i in range(len(at)) if len(at[i])]
    weighed = {i: model.weigh(at[i], count[i]) for i in real}
    model.index = Index([ids[i] for i in real], label[real], [(at[i], weighed[i]) for i in real], len(vocabulary))
    # Classes are sampled apart: an example stands for so many labelled texts.
    stands = [counts[c] / max(1, sizes.get(c, 0)) for c in (0, 1)]
    bare = [stands[int(label[i])] * np.array([1, label[i]]) for i in range(len(at)) if not len(at[i])]
    if bare:
        model.prior = float(sum(b[1] for b in bare) / sum(b[0] for b in bare))
    raw, truth, weight = [], [], []
    for place, i in enumerate(model.index.order):
        best = model.index.nearest(at[real[i]], weighed[real[i]], NEIGHBOURS, without=place)
        if best:
            raw.append(model.vote(best))
            truth.append(label[real[i]])
            weight.append(stands[int(label[real[i]])])
    if raw:
        model.steps = _calibrated(np.array(raw), np.array(truth), np.array(weight))
    return model


_RESULT = "score double, terms array<string>, neighbours array<string>"


def scored(docs: DataFrame, model: Model, text: str = "text", name: str = "toxicity") -> DataFrame:
    """``docs`` with a struct: calibrated score, and as evidence the heaviest of the text's terms that
    examples have and the ids of the nearest examples.

    Row by row, without a shuffle. Null and empty texts, and texts without any term of the examples,
    get the share of toxic texts among labelled ones without terms, or among all where there are no
    such; equal texts get equal scores.
    """

    @F.arrow_udf(_RESULT)
    def score(texts: pa.Array) -> pa.Array:
        rows = []
        for at, count in _vectors(texts, model.vocabulary):
            weight = model.weigh(at, count) if len(at) else np.zeros(0)
            best = model.index.nearest(at, weight, NEIGHBOURS) if len(at) else []
            heavy = at[np.argsort(-weight, kind="stable")[:HEAVIEST]]
            rows.append({
                "score": model.score(best), "terms": model.vocabulary.take(pa.array(heavy)).to_pylist(),
                "neighbours": [str(model.index.ids[i]) for _, i in best[:NEAREST]],
            })
        made = pa.array(rows, pa.struct([("score", pa.float64()), ("terms", pa.list_(pa.string())),
                                         ("neighbours", pa.list_(pa.string()))]))
        give_back()
        return made

    return docs.withColumn(name, score(F.col(f"`{text}`")))


def learnable(doc_id: str = "doc_id") -> Column:
    """Rows whose labels may be learnt from: four of five, by checksum of the id."""
    return F.crc32(F.col(f"`{doc_id}`").cast("string")) % 5 != 0


def assess(docs: DataFrame, labels: DataFrame, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """id, held_out, score, predicted and evidence of every document. Rows without id are not held
    out; repeated rows come as often as they occur; other columns are ignored."""
    model = fit(docs, labels, learnable(doc_id), doc_id, text)
    narrow = docs.select(F.col(f"`{doc_id}`"), F.col(f"`{text}`").alias("text_"))
    [found] = fresh(narrow, "found")
    return scored(narrow, model, "text_", found).select(
        f"`{doc_id}`",
        F.coalesce(~learnable(doc_id), F.lit(False)).alias("held_out"),
        F.col(f"{found}.score").alias("score"),
        (F.col(f"{found}.score") >= 0.5).cast("int").alias("predicted"),
        F.col(f"{found}.terms").alias("terms"),
        F.col(f"{found}.neighbours").alias("neighbours"),
    )
