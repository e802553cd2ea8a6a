"""Language identification: averaged hashed subword embeddings under a linear softmax.

A text is the average of the embeddings of its byte trigrams, hashed into buckets; embeddings and
softmax are trained together by stochastic gradient descent in numpy on a bounded sample of labelled
texts, drawn for each language apart so that a rare one is learnt as well. On labelled texts kept apart,
each counted for the rows it stands for, a temperature makes the probabilities honest, and a threshold
for rejection is set so that what is accepted is right as often as wanted.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from perilframe.llm.common import fresh, text_bytes

#: Labelled texts to learn from, dealt evenly to the languages; texts of each language in any case, where
#: it has so many; languages at most, the most common ones.
EXAMPLES, LEAST, LANGUAGES = 4000, 50, 500
#: Hash buckets, embedding size, passes, texts a step, rate.
BUCKETS, SIZE, PASSES, STEP, RATE = 2048, 16, 12, 32, 0.3
#: Wanted share of right answers among accepted ones; the share of examples kept for calibration.
WANTED, APART = 0.98, 0.2
UNKNOWN = "und"
_CHUNK = 1 << 20


def trigrams(text: bytes) -> np.ndarray:
    """How often each bucket's trigrams occur, as shares of all; a blank on either side counts."""
    data = np.frombuffer(b" " + text.lower() + b" ", np.uint8).astype(np.uint32)
    total = np.zeros(BUCKETS, np.int64)
    for a in range(0, len(data), _CHUNK):
        part = data[a : a + _CHUNK + 2]
        if len(part) > 2:
            code = (part[:-2] << 16 | part[1:-1] << 8 | part[2:]) * np.uint32(2654435761)
            total += np.bincount(code >> np.uint32(32 - BUCKETS.bit_length() + 1), minlength=BUCKETS)
    return (total / max(1, total.sum())).astype(np.float32)


def has_letter(text: bytes) -> bool:
    return any(map(str.isalpha, text.decode("utf-8", "replace")))


class Model:
    """Languages, the trained product of embeddings and softmax, temperature and threshold."""

    def __init__(self, languages: list[str], weights: np.ndarray, bias: np.ndarray):
        self.languages, self.weights, self.bias = languages, weights, bias
        self.temperature, self.threshold = 1.0, 0.0

    def probabilities(self, shares: np.ndarray) -> np.ndarray:
        return _softmax((shares @ self.weights + self.bias) / self.temperature)


def _softmax(x: np.ndarray) -> np.ndarray:
    e = np.exp(x - x.max(axis=1, keepdims=True))
    return e / e.sum(axis=1, keepdims=True)


def train(shares: np.ndarray, labels: np.ndarray, languages: list[str], stands: np.ndarray) -> Model:
    """Stochastic gradient descent with a falling rate; fixed seed, so the same model each time.
    ``stands`` is how many rows an example of each language stands for."""
    draw = np.random.default_rng(7)
    embed = draw.normal(0, 0.1, (shares.shape[1], SIZE))
    out, bias = draw.normal(0, 0.1, (SIZE, len(languages))), np.zeros(len(languages))
    # Shares are tiny; without a common scale the gradients would be, too.
    scaled = shares * np.sqrt(shares.shape[1])
    order = draw.permutation(len(labels))
    apart = order[: int(APART * len(labels))]
    used = order[len(apart):]
    steps = max(1, PASSES * -(-len(used) // STEP))
    at = 0
    for _ in range(PASSES):
        draw.shuffle(used)
        for i in range(0, len(used), STEP):
            rows = used[i : i + STEP]
            hidden = scaled[rows] @ embed
            error = _softmax(hidden @ out + bias)
            error[np.arange(len(rows)), labels[rows]] -= 1
            error *= RATE * (1 - at / steps) / len(rows)
            at += 1
            embed, out, bias = (
                embed - scaled[rows].T @ (error @ out.T), out - hidden.T @ error, bias - error.sum(axis=0))
    model = Model(languages, (np.sqrt(shares.shape[1]) * embed @ out).astype(np.float32), bias.astype(np.float32))
    if len(apart):
        _calibrate(model, shares[apart], labels[apart], stands[labels[apart]])
    return model


def _calibrate(model: Model, shares: np.ndarray, labels: np.ndarray, weight: np.ndarray) -> None:
    def loss(temperature: float) -> float:
        model.temperature = temperature
        right = model.probabilities(shares)[np.arange(len(labels)), labels]
        return float(-np.average(np.log(np.maximum(right, 1e-9)), weights=weight))

    model.temperature = min(np.geomspace(0.25, 8, 41), key=loss)
    found = model.probabilities(shares)
    best = found.max(axis=1)
    right = found.argmax(axis=1) == labels
    order = np.argsort(-best, kind="stable")
    share = np.cumsum((right * weight)[order]) / np.cumsum(weight[order])
    enough = np.flatnonzero(share >= WANTED)
    model.threshold = float(best[order][enough[-1]]) if len(enough) else 1.0


def _features(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        shares = [trigrams(t).astype(np.float16).tobytes() for t in text_bytes(batch.column(1))]
        yield pa.RecordBatch.from_arrays(
            [batch.column(0), batch.column(2), pa.array(shares, pa.binary())], ["id", "lang", "shares"])


def _drawn(known: DataFrame) -> tuple[DataFrame, dict[str, int]]:
    """Ids and languages of the sample, and how many ids there are of each language, about."""
    rows = (
        known.groupBy("lang").agg(F.count("*").alias("rows"), F.approx_count_distinct("id").alias("n"))
        .orderBy(F.desc("rows"), "lang").limit(LANGUAGES).collect()
    )
    quota = max(LEAST, EXAMPLES // max(1, len(rows)))
    spark = known.sparkSession
    # Twice the quota by the id's hash, so that what is ranked below stays small whatever a language holds.
    limits = spark.createDataFrame(
        [(r["lang"], (2 * quota + 100) / max(1, r["n"])) for r in rows], "lang string, share double")
    place = F.pmod(F.xxhash64("id"), F.lit(1 << 40)) / float(1 << 40)
    near = (
        known.join(F.broadcast(limits), "lang").withColumn("place", place).where("place < share")
        .select("id", "lang", "place").distinct()
    )
    rank = F.row_number().over(Window.partitionBy("lang").orderBy("place", "id"))
    chosen = near.withColumn("rank", rank).where(F.col("rank") <= quota).select("id", "lang")
    return spark.createDataFrame(chosen.collect(), chosen.schema), {r["lang"]: r["n"] for r in rows}


def fit(docs: DataFrame, learnable: Column, doc_id: str = "doc_id", text: str = "text",
        lang: str = "lang") -> Model:
    """Learn from documents that meet ``learnable`` and have id, text and language: of each language
    EXAMPLES over the number of languages, LEAST at least, spread by hash. Of rows that share id and
    language one is used. Without any, the model knows no language."""
    known = docs.where(learnable).select(
        F.col(f"`{doc_id}`").alias("id"), F.col(f"`{text}`").alias("text"),
        F.col(f"`{lang}`").cast("string").alias("lang"),
    ).where("id is not null and text is not null and lang is not null")
    ids, sizes = _drawn(known.select("id", "lang"))
    rows = (
        known.join(F.broadcast(ids), ["id", "lang"]).select("id", "text", "lang")  # bounded by the parameters
        .mapInArrow(_features, f"id {ids.schema['id'].dataType.simpleString()}, lang string, shares binary")
        .groupBy("id", "lang").agg(F.min("shares").alias("shares")).orderBy("lang", "id").collect()
    )
    languages = sorted({r["lang"] for r in rows})
    if not languages:
        return Model([], np.zeros((BUCKETS, 0), np.float32), np.zeros(0, np.float32))
    shares = np.stack([np.frombuffer(r["shares"], np.float16) for r in rows]).astype(np.float32)
    labels = np.array([languages.index(r["lang"]) for r in rows])
    used = np.bincount(labels, minlength=len(languages))
    return train(shares, labels, languages, np.array([sizes[x] for x in languages]) / used)


def identified(docs: DataFrame, model: Model, text: str = "text", name: str = "language") -> DataFrame:
    """``docs`` with a struct: most probable language, its probability, and whether that reaches the
    calibrated threshold. Null texts and texts without a letter are UNKNOWN with 0, as are all
    where the model knows no language. Row by row; equal texts get equal answers."""

    @F.arrow_udf("lang string, score double, accepted boolean")
    def identify(texts: pa.Array) -> pa.Array:
        rows = []
        for t in text_bytes(texts):
            if not model.languages or not has_letter(t):
                rows.append({"lang": UNKNOWN, "score": 0.0, "accepted": False})
                continue
            found = model.probabilities(trigrams(t)[None, :])[0]
            best = int(found.argmax())
            rows.append({"lang": model.languages[best], "score": min(1.0, float(found[best])),
                         "accepted": bool(found[best] >= model.threshold)})
        return pa.array(rows, pa.struct([("lang", pa.string()), ("score", pa.float64()), ("accepted", pa.bool_())]))

    return docs.withColumn(name, identify(F.col(f"`{text}`")))


def assess(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", lang: str = "lang") -> DataFrame:
    """id, held_out, lang_pred, score and accepted of every document. Three of four ids, by checksum,
    are learnt from; rows without id are neither learnt from nor held out. Other columns are ignored."""
    out = F.crc32(F.col(f"`{doc_id}`").cast("string")) % 4 == 2
    model = fit(docs, ~out, doc_id, text, lang)
    narrow = docs.select(F.col(f"`{doc_id}`"), F.col(f"`{text}`").alias("text_"))
    [found] = fresh(narrow, "found")
    return identified(narrow, model, "text_", found).select(
        f"`{doc_id}`", F.coalesce(out, F.lit(False)).alias("held_out"),
        F.col(f"{found}.lang").alias("lang_pred"), F.col(f"{found}.score").alias("score"),
        F.col(f"{found}.accepted").alias("accepted"),
    )
