"""SimHash, substring and sentence dedup against brute force."""

from __future__ import annotations

import hashlib
import random
from collections import Counter

import numpy as np
import pyarrow as pa
import pytest
import xxhash
from pyspark.sql import functions as F

from perilframe.llm import repeats, simhash, spans
from perilframe.llm.components import connected_components
from perilframe.llm.queries import op1_simhash


def slow_print(text, shingle=4):
    words = (text or "").encode().lower().split()
    runs = [b" ".join(words[i : i + shingle]) for i in range(max(1, len(words) - shingle + 1))] if words else []
    hashes = [xxhash.xxh64_intdigest(r, 42) for r in runs]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def roots(links, nodes):
    parent = {n: n for n in nodes}

    def find(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for a, b in links:
        a, b = find(a), find(b)
        parent[max(a, b)] = min(a, b)
    return {n: find(n) for n in nodes}


def test_fingerprints_and_components_match_brute_force(spark, sf_dir, small_docs):
    prints = {r["doc_id"]: slow_print(r["text"]) for r in small_docs.collect()}
    ids = sorted(prints)
    links = [(a, b) for a in ids for b in ids if a < b and (prints[a] ^ prints[b]).bit_count() <= 4]
    root = roots(links, ids)
    found = {tuple(r) for r in op1_simhash(spark, sf_dir).collect()}
    assert found == {(i, f"{prints[i]:016x}", root[i]) for i in ids}


@pytest.mark.parametrize("cell", [4, 1024])
def test_links_connect_dense_groups_in_cells(spark, cell):
    draw = random.Random(1)
    prints = {draw.getrandbits(64) for _ in range(30)}
    for seed in list(prints)[:3]:
        for _ in range(40):
            seed ^= 1 << draw.randrange(64)
            seed ^= 1 << draw.randrange(64)
            prints.add(seed)
    signed = [p - (1 << 64) if p >> 63 else p for p in prints]
    frame = spark.createDataFrame([(p,) for p in signed], "fp long")
    found = [tuple(r) for r in simhash.near_links(frame, cell=cell).collect()]
    true = [(a, b) for a in signed for b in signed if a < b and ((a ^ b) & (2**64 - 1)).bit_count() <= 4]
    assert {tuple(sorted(f)) for f in found} <= set(true)
    assert roots(found, signed) == roots(true, signed)


@pytest.mark.parametrize("written", [True, False])
def test_keys_of_fingerprints_are_not_broadcast(spark, tmp_path, written):
    """Spark sizes them by the fingerprints, of which each makes 35: as the pipeline reads them and as
    op1_simhash groups them."""
    frame = spark.range(20_000).select(F.xxhash64("id").alias("fp"))
    if written:
        frame.write.parquet(str(tmp_path / "prints"))
        frame = spark.read.parquet(str(tmp_path / "prints"))
    else:
        frame = frame.groupBy("fp").agg(F.count("*").alias("n")).select("fp")
    found = simhash.near_links(frame)
    plan = found._jdf.queryExecution().executedPlan()
    found.collect()  # the plan is that which ran
    assert "SortMergeJoin" in plan.toString() and "Broadcast" not in plan.toString()


def test_components_of_chains_and_stars(spark):
    links = [(i, i + 1) for i in range(40)] + [(100, 100 + i) for i in range(1, 30)] + [(7, 7), (None, 3)]
    found = connected_components(spark.createDataFrame(links, "a long, b long")).collect()
    assert {tuple(r) for r in found} == {(i, 0) for i in range(41)} | {(100 + i, 100) for i in range(30)}


def test_simhash_of_odd_rows(odd_docs, no_docs):
    rows = simhash.near_duplicates(odd_docs).collect()
    assert len(rows) == odd_docs.count()
    component = {r["doc_id"]: r["component_id"] for r in rows if r["doc_id"] is not None}
    assert component == {1: 1, 2: 1, 3: 1, 4: 4, 5: 4, 6: 6, 7: 7}
    assert {r["fingerprint"] for r in rows if r["doc_id"] in (1, 2, 3)} == {0}
    assert simhash.near_duplicates(no_docs).collect() == []


def slow_removals(rows, length=200):
    texts = [(i, (t or "").encode()) for i, t in rows]
    seen = Counter(t[p : p + length] for _, t in texts for p in range(len(t) - length + 1))
    out = []
    for i, t in texts:
        gone = bytearray(len(t))
        for p in range(len(t) - length + 1):
            if seen[t[p : p + length]] > 1:
                gone[p : p + length] = b"\1" * length
        kept = bytes(b for b, g in zip(t, gone) if not g)
        runs = sum(g and not (k and gone[k - 1]) for k, g in enumerate(gone))
        out.append((i, len(t), sum(gone), runs, hashlib.sha256(kept).hexdigest()))
    return sorted(out, key=str)


def removals(frame):
    return sorted(
        ((r["doc_id"], r["n_bytes"], sum(s["stop"] - s["start"] for s in r["removed"]), len(r["removed"]),
          r["kept_sha256"]) for r in repeats.removals(frame).collect()), key=str)


@pytest.mark.parametrize("hot", [2, 50_000])
def test_removed_bytes_match_brute_force(spark, monkeypatch, hot):
    monkeypatch.setattr(repeats, "HOT", hot)
    draw = random.Random(3)
    parts = ["".join(draw.choice("abc é") for _ in range(n)) for n in (150, 199, 200, 201, 260, 400)]
    rows = []
    for i in range(50):
        pieces = [
            draw.choice(parts)[draw.randint(0, 40):] if draw.random() < 0.6
            else "".join(draw.choice("defgh ") for _ in range(draw.randint(0, 300)))
            for _ in range(draw.randint(0, 6))
        ]
        rows.append((i, "".join(pieces)))
    rows += [(100, "a" * 700), (101, "ab" * 300), (102, None), (103, ""), (104, rows[5][1]), (None, "x" * 199)]
    assert removals(spark.createDataFrame(rows, "doc_id long, text string")) == slow_removals(rows)


def test_common_passage_in_many_surroundings(spark, monkeypatch):
    """One passage in every text, longer and shorter than what counts, cut at different places."""
    monkeypatch.setattr(repeats, "HOT", 8)
    draw = random.Random(9)
    passage = "".join(draw.choice("abcdefg ") for _ in range(330))
    noise = lambda n: "".join(draw.choice("klmnop ") for _ in range(n))
    rows = [(i, noise(draw.randint(0, 90)) + passage[draw.randint(0, 80):draw.randint(180, 330)] + noise(80))
            for i in range(60)]
    rows += [(100 + i, noise(150) + passage[:270] + noise(i)) for i in range(40)]
    rows += [(200 + i, passage[60:300] + str(i)) for i in range(20)]
    assert removals(spark.createDataFrame(rows, "doc_id long, text string")) == slow_removals(rows)


def test_equal_rows_meet_across_batches():
    names = ["hash", "lo", "hi", "tid", "place", "left", "right"]
    rows = [(1, 0, 9, t, 50, b"ab", c) for t, c in enumerate([b"x", b"x", b"x", b"y", b"z", b"z"])]
    for size in (1, 2, 3, 6):
        batches = [
            pa.RecordBatch.from_pylist([dict(zip(names, r)) for r in rows[i : i + size]])
            for i in range(0, len(rows), size)
        ]
        found = [r for b in repeats._collapse(batches) for r in b.to_pylist()]
        assert [(r["start"], r["stop"]) for r in found] == [(48, 51)] * 3 + [(None, None)] + [(48, 51)] * 2
        assert [r["left"] is not None for r in found] == [True, False, False, True, True, False]


def test_anchors_do_not_depend_on_chunks(monkeypatch):
    text = bytes(random.Random(5).choice(b"abcd ") for _ in range(5000))
    whole = [a.tolist() for a in repeats.anchors([text, text[:900]])]
    monkeypatch.setattr(repeats, "_CHUNK", 512)
    assert [a.tolist() for a in repeats.anchors([text, text[:900]])] == whole


def test_interval_tree():
    suffixes = sorted(["banana"[i:] for i in range(6)])
    common = [0]
    for a, b in zip(suffixes, suffixes[1:]):
        n = 0
        while n < min(len(a), len(b)) and a[n] == b[n]:
            n += 1
        common.append(n)
    assert {t for t in repeats.lcp_intervals(np.array(common)) if t[0]} == {(3, 1, 2), (1, 0, 2), (2, 4, 5)}


def test_removals_of_odd_rows(odd_docs, no_docs):
    rows = [(r["doc_id"], r["text"]) for r in odd_docs.collect()]
    found = {r[0]: r[1:] for r in removals(odd_docs)}
    assert found[1] == found[2] == (0, 0, 0, hashlib.sha256(b"").hexdigest())
    n = len(dict(rows)[4])
    assert found[4] == found[5] == (n, n, 1, hashlib.sha256(b"").hexdigest())
    assert repeats.removals(no_docs).collect() == []


def test_sentence_runs(spark):
    a, b, c, d = "One here. ", "Two there! ", "Three\n", "Four? "
    rows = [(2, a + b + c + d), (1, "Start. " + a + b + c), (3, a + b), (4, a + b + c + a + b + c), (5, None), (6, "")]
    frame = spark.createDataFrame(rows, "doc_id long, text string")
    found = {r["doc_id"]: r for r in spans.deduplicated(frame, run=3, size=0).collect()}
    assert {i: (r["n_removed"], r["kept_text"]) for i, r in found.items()} == {
        1: (0, rows[1][1]), 2: (3, d), 3: (0, a + b), 4: (6, ""), 5: (0, ""), 6: (0, "")}


def test_rows_that_share_an_id_are_texts_of_their_own(spark):
    rows = [(1, "Aa one. Bb two. Cc three."), (7, "Pp qq. Aa one. Bb two. Cc three."),
            (7, "Xx un. Yy deux. Zz trois. Qq quatre."), (8, "a\x1eb c"),
            (None, "Xx un. Yy deux. Zz trois. "), (None, "Nothing. Like. That.")]
    found = spans.deduplicated(spark.createDataFrame(rows, "doc_id long, text string"), run=3, size=0).collect()
    assert sorted((r["doc_id"] or 0, r["n_removed"], r["kept_text"]) for r in found) == [
        (0, 0, rows[5][1]), (0, 0, rows[4][1]), (1, 0, rows[0][1]), (7, 3, "Pp qq. "),
        (7, 3, "Qq quatre."), (8, 0, "a\x1eb c")]


@pytest.mark.parametrize("ends", [". ", ", "])
def test_a_long_sentence_in_other_text_is_caught(spark, ends):
    draw = random.Random(8)
    words = lambda n: [
        "".join(draw.choice("abcdefgh") for _ in range(draw.randint(2, 10))) for _ in range(n)]
    passage = " ".join(words(60))
    rows = [(i, " ".join(words(30)) + ends.rstrip() + " " + passage + " " + " ".join(words(20)) + ends) for i in range(3)]
    found = spans.deduplicated(spark.createDataFrame(rows, "doc_id long, text string")).collect()
    kept = {r["doc_id"]: r["kept_text"] for r in found}
    assert kept[0] == rows[0][1]
    for i in (1, 2):
        lost = len(rows[i][1]) - len(kept[i])
        assert 0.6 * len(passage) < lost <= len(passage) + 2


def slow_spans_removed(rows, run, size):
    """Removed sentences by comparing every two runs."""
    runs = []
    for row, (key, text) in enumerate(rows):
        keys = [p.strip(spans.BLANKS) for p in spans.sentences(text or "")]
        for a in range(len(keys)):
            b = next((b for b in range(a + run, len(keys) + 1) if sum(map(len, keys[a:b])) >= size), None)
            if b is not None:
                runs.append(((key is not None, key or 0, row, a), row, range(a, b), keys[a:b]))
    gone = [set() for _ in rows]
    for place, row, span, said in runs:
        if any(other[3] == said and other[0] < place for other in runs):
            gone[row] |= set(span)
    return sorted((r[0] is not None, r[0] or 0, len(g)) for r, g in zip(rows, gone))


def test_sentence_runs_match_brute_force(spark):
    draw = random.Random(2)
    said = ["Of. ", "In the end! ", "A line without a mark\n", "So it goes on and on, as ever. ", "Why? "]
    rows = [(draw.choice([None, *range(20)]), "".join(draw.choices(said, k=draw.randint(0, 9)))) for _ in range(40)]
    frame = spark.createDataFrame(rows, "doc_id long, text string").coalesce(1)
    for run, size in ((2, 30), (3, 0), (1, 20)):
        got = spans.deduplicated(frame, run=run, size=size).collect()
        assert sorted((r["doc_id"] is not None, r["doc_id"] or 0, r["n_removed"]) for r in got) == \
            slow_spans_removed(rows, run, size)


def test_sentence_runs_of_odd_rows(odd_docs, no_docs):
    rows = spans.deduplicated(odd_docs).collect()
    assert len(rows) >= odd_docs.count()
    assert {r["doc_id"]: r["n_removed"] for r in rows}[5] == {r["doc_id"]: r["n_sentences"] for r in rows}[5]
    assert spans.deduplicated(no_docs).collect() == []
