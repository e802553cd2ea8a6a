"""Periodic runs against gaps and islands of every period."""

from __future__ import annotations

import hashlib
import re
import zlib

import numpy as np
import pytest

from perilframe.llm import periods, queries


def plain_runs(words: list, least: int = 12) -> list[tuple[int, int, int]]:
    """(start, length, period) by start, then period."""
    found: dict[tuple[int, int], int] = {}
    n = len(words)
    for q in range(1, n // 2 + 1):
        i = 0
        while i + q < n:
            j = i
            while j + q < n and words[j] == words[j + q]:
                j += 1
            length = j - i + q
            if j > i and length >= max(least, 2 * q):
                found.setdefault((i, length), q)
            i = max(j, i + 1)
    return sorted(((s, x, q) for (s, x), q in found.items()), key=lambda r: (r[0], r[2]))


def plain_row(doc_id, text: str | None) -> tuple:
    words = re.findall("[^\x20\x09-\x0d]+", text or "")
    n = len(words)
    h = 1 if doc_id is None else zlib.crc32(str(doc_id).encode())
    if h % 10 == 0 and n:
        g = h // 10
        a = g % n
        p = 1 + (n - a) // (3 + g % 8)
        words = [words[i] if i < a else words[a + (i - a) % p] for i in range(n)]
    runs = plain_runs(words)
    best = max(runs, key=lambda r: (r[1], -r[0], -r[2]), default=(None, None, None))
    gone = {i for s, x, q in runs for i in range(s + q, s + x)}
    lines = "".join(f"{s},{x},{q}\n" for s, x, q in runs)
    kept = " ".join(w for i, w in enumerate(words) if i not in gone)
    milli = None if best[0] is None else 1000 * best[1] // best[2]
    return (doc_id, len(runs), *best, milli, hashlib.sha256(lines.encode()).hexdigest(),
            hashlib.sha256(kept.encode()).hexdigest())


@pytest.mark.parametrize("least", [2, 4, 12])
def test_runs_of_random_words(least):
    draw = np.random.default_rng(least)
    for _ in range(60):
        texts = []
        for _ in range(draw.integers(0, 6)):
            n = int(draw.integers(0, 90))
            words = draw.integers(0, draw.integers(1, 5), n)
            if n and draw.random() < 0.6:
                s, p = int(draw.integers(0, n)), int(draw.integers(1, n + 1))
                words = np.r_[words[:s], words[s:][np.arange(n - s) % p]]
            texts.append(words)
        got = periods.runs_of(texts, least)
        assert [[tuple(r) for r in f.tolist()] for f in got] == [plain_runs(t.tolist(), least) for t in texts]


def test_extensions_of_every_pair():
    draw = np.random.default_rng(0)
    words = np.r_[draw.integers(0, 2, 120), 7]
    asked = periods.Extensions(words)
    a, b = (x.ravel() for x in np.meshgrid(np.arange(121), np.arange(121)))
    a, b = a[a != b], b[a != b]
    got = asked.common(a, b)
    for x, y, n in zip(a.tolist(), b.tolist(), got.tolist()):
        want = 0
        while max(x, y) + want < 121 and words[x + want] == words[y + want]:
            want += 1
        assert n == want


def test_only_the_cover_is_sorted():
    asked = periods.Extensions(np.r_[np.arange(1300) % 7, 9])
    assert len(asked._rank) == 100 * len(periods.COVER) + 1  # place 1300 is on the cover
    spread = {(a - b) % periods.MODULUS for a in periods.COVER for b in periods.COVER}
    assert spread == set(range(periods.MODULUS))


def test_grid_beyond_the_kept_part():
    small, whole = periods._Grid(kept=10), periods._Grid()
    pairs = lambda grid, n: {p for i, j in grid.pairs(n) for p in zip(i.tolist(), j.tolist()) if p[1] - p[0] <= n // 2}
    for n in (0, 1, 9, 10, 11, 300):
        assert pairs(small, n) == pairs(whole, n)


def test_long_text_of_one_word():
    assert periods.runs_of([np.zeros(40_000, np.int64)])[0].tolist() == [[0, 40_000, 1]]


def test_odd_rows(odd_docs, no_docs):
    rows = periods.collapse(odd_docs).collect()
    assert len(rows) == odd_docs.count() and periods.collapse(no_docs).count() == 0
    for r in rows:
        if r["doc_id"] == 4:  # two words, over and over
            assert [tuple(x) for x in r["runs"]] == [(0, 6000, 2)] and r["collapsed"] == "word another."
        elif r["doc_id"] in (1, 2, 3):
            assert (r["n_words"], r["runs"], r["collapsed"]) == (0, [], "")


def test_query_against_plain_rows(spark, sf_dir):
    texts = {r["doc_id"]: r["text"] for r in spark.read.parquet(f"{sf_dir}/documents.parquet").collect()}
    got = {r["doc_id"]: tuple(r) for r in queries.op12_periods(spark, sf_dir).collect()}
    assert got.keys() == texts.keys()
    short = {k: t for k, t in texts.items() if len((t or "").split()) <= 1500}
    assert len(short) > 0.8 * len(texts) and any(got[k][1] for k in short)
    for key, text in short.items():
        assert got[key] == plain_row(key, text)
