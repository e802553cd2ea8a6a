"""Positive-unlabelled quality: risk, prior and calibration by plain loops, held-out accuracy, odd rows."""

from __future__ import annotations

import math

import numpy as np
from pyspark.sql import functions as F

from perilframe.llm import queries, trust


def _sparse(rows):
    return trust.Sparse([(np.array(list(r), np.int32), np.array(list(r.values()), np.float32)) for r in rows])


def _risk(good, rest, weight, bias, prior):
    loss = lambda z: math.log1p(math.exp(-z))
    f = [bias + sum(weight[k] * v for k, v in r.items()) for r in good]
    g = [bias + sum(weight[k] * v for k, v in r.items()) for r in rest]
    first = prior * sum(map(loss, f)) / len(f)
    second = sum(loss(-x) for x in g) / len(g) - prior * sum(loss(-x) for x in f) / len(f)
    return first, second


def test_gradient_of_the_risk():
    draw = np.random.default_rng(3)
    make = lambda n: [{int(k): float(draw.random()) for k in draw.choice(6, 3, False)} for _ in range(n)]
    good, rest = make(5), make(7)
    seen = set()
    for prior in (0.2, 0.5, 3.0):  # the last takes the second part below zero
        weight, bias = np.zeros(trust.DIMENSION), 0.3
        weight[:6] = draw.normal(size=6)
        slope, bias_slope, second = trust.step(_sparse(good), _sparse(rest), weight, bias, prior)
        want_first, want_second = _risk(good, rest, weight, bias, prior)
        assert abs(second - want_second) < 1e-5
        seen.add(second >= 0)
        value = lambda w, b: (sum(_risk(good, rest, w, b, prior)) if second >= 0
                              else -_risk(good, rest, w, b, prior)[1])
        for k in range(6):
            up, down = weight.copy(), weight.copy()
            up[k] += 1e-4
            down[k] -= 1e-4
            assert abs(slope[k] - (value(up, bias) - value(down, bias)) / 2e-4) < 1e-4
        assert abs(bias_slope - (value(weight, bias + 1e-4) - value(weight, bias - 1e-4)) / 2e-4) < 1e-4
    assert seen == {True, False}


def test_prior_of_a_known_mixture():
    draw = np.random.default_rng(5)
    bins = lambda x: np.clip((x * 1000).astype(int), 0, 999)
    for share in (0.3, 0.6, 0.9):
        every = np.r_[draw.beta(8, 2, int(40_000 * share)), draw.beta(2, 8, int(40_000 * (1 - share)))]
        good = bins(draw.beta(8, 2, 3000))
        assert abs(trust.estimated_prior(np.bincount(bins(every), minlength=1000), good) - share) < 0.06


def test_calibration_rises_and_follows_the_mixture():
    draw = np.random.default_rng(6)
    bins = lambda x: np.clip((x * 1000).astype(int), 0, 999)
    every = np.r_[draw.beta(8, 2, 60_000), draw.beta(2, 8, 40_000)]
    x, y = trust.calibrated(np.bincount(bins(every), minlength=1000), bins(draw.beta(8, 2, 20_000)), 0.6)
    assert (np.diff(x) > 0).all() and (np.diff(y) >= 0).all() and y.min() >= 0 and y.max() <= 1
    for s in (0.3, 0.5, 0.7):
        one, zero = 0.6 * s**7 * (1 - s), 0.4 * s * (1 - s) ** 7
        assert abs(np.interp(s, x, y) - one / (one + zero)) < 0.1


def test_features_by_plain_counts():
    features = trust.Features()
    texts = [b"", b"One two, TWO two!!\nOne two\nOne two\n", b" \n ", "déjà 12 vu ***".encode()]
    [(n, row, slot, value)] = list(features.of(texts))
    assert n == 4
    one = [(s, v) for r, s, v in zip(row, slot, value) if r == 1]
    [(_, row2, slot2, value2)] = list(trust.Features().of([texts[1]]))
    assert one == list(zip(slot2, value2)) and (row2 == 0).all()  # whatever texts stand beside
    assert trust._repeated(np.array([0, 0, 0, 1, 1]), np.array([5, 5, 6, 5, 5], np.uint64), 3).tolist() == [1 / 3, 0.5, 0]
    # Case does not matter to words, and letters of one class are one shape.
    same = [list(trust.Features().of([t]))[0][2].tolist() for t in (b"abc def", b"abcd ef")]
    assert len(set(same[0]) & set(same[1])) >= 3


def test_long_texts_are_cut_nowhere():
    text = b"word another. " * 200_000
    found = list(trust.Features().of([b"x", text, b"y"]))
    assert [f[0] for f in found] == [2, 1]


def test_held_out_accuracy(spark, sf_dir):
    where = sf_dir.replace("sf0.001", "sf0.01")
    found = queries.op11_trust(spark, where)
    joined = found.join(spark.read.parquet(f"{where}/labels.parquet"), "doc_id").where("held_out")
    rows = joined.select("score", "predicted", "quality").collect()
    assert len(rows) > 40
    assert np.mean([r["predicted"] == r["quality"] for r in rows]) > 0.93
    assert all(0 <= r["score"] <= 1 and r["predicted"] == (r["score"] >= 0.3) for r in rows)


def test_held_out_labels_change_nothing(spark, small_docs, sf_dir):
    labels = spark.read.parquet(f"{sf_dir}/labels.parquet")
    other = labels.withColumn("quality", F.when(trust.learnable(), F.col("quality")).otherwise(1 - F.col("quality")))
    one, two = (sorted(map(tuple, trust.assess(small_docs, x).collect())) for x in (labels, other))
    assert one == two


def test_odd_rows(spark, odd_docs, no_docs):
    labels = spark.createDataFrame([(1, 1), (4, 1), (4, 1), (5, 0), (6, 1), (7, 1), (7, 0), (None, 1), (2, None)],
                                   "doc_id long, quality int")
    clash = odd_docs.withColumn("score", F.lit(5)).withColumn("quality", F.lit("x"))
    rows = trust.assess(clash, labels).collect()
    assert len(rows) == odd_docs.count() and all(0 <= r["score"] <= 1 for r in rows)
    assert all(r["held_out"] is False for r in rows if r["doc_id"] is None)
    blank = {r["score"] for r in rows if r["doc_id"] in (1, 2)}
    assert len(blank) == 1 and len({r["score"] for r in rows if r["doc_id"] == 4}) == 1
    assert trust.assess(no_docs, labels).count() == 0
    assert {r["score"] for r in trust.assess(odd_docs, labels.limit(0)).collect()} == {0.0}
