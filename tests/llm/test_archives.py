"""WARC round trip, salvage of damaged archives, SQL of the operators and the pipeline."""

from __future__ import annotations

import random

import pyarrow as pa
import pytest

import corpus_pipeline
from perilframe.llm import warc
from perilframe.llm.queries import ORACLE_SQL, QUERIES


@pytest.mark.parametrize("name", sorted(ORACLE_SQL))
def test_matches_sql(spark, sf_dir, name):
    duckdb = pytest.importorskip("duckdb")
    duck = duckdb.connect()
    for table in ("documents", "pages"):
        duck.execute(f"CREATE VIEW {table} AS SELECT * FROM '{sf_dir}/{table}.parquet'")
    result = duck.execute(ORACLE_SQL[name])
    names = sorted(d[0] for d in result.description)
    at = [[d[0] for d in result.description].index(n) for n in names]
    expected = sorted(tuple(str(r[i]) for i in at) for r in result.fetchall())
    frame = QUERIES[name](spark, sf_dir)
    assert sorted(frame.columns) == names
    assert sorted(tuple(str(r[n]) for n in names) for r in frame.collect()) == expected


def test_revisits_nulls_and_repeated_rows(spark):
    rows = [
        (1, "u", "x" * 150, 0), (2, None, "x" * 150, 0), (3, "a b\r\nc", None, 0), (4, "u", "short", 0), (5, "u", "short", 0),
        (None, "q", "x" * 150, 0), (1, "u", "x" * 150, 0), (7, "z", "ü" * 60, 0), (8, "", "", 0),
    ]
    pages = spark.createDataFrame(rows, "page_id long, url string, html string, digest int")
    found = warc.round_trip(spark, pages).collect()
    assert sorted((str(r["page_id"]), r["payload_bytes"], r["record_type"], r["refers_to"]) for r in found) == [
        ("1", 150, "response", None), ("1", 150, "response", None), ("2", 150, "revisit", 1), ("3", 0, "response", None),
        ("4", 5, "response", None), ("5", 5, "response", None), ("7", 120, "response", None), ("8", 0, "response", None),
        ("None", 150, "revisit", 1)]
    assert warc.round_trip(spark, pages.limit(0)).collect() == []


def test_payloads_and_gaps_through_spark(spark, tmp_path):
    data = [warc.member(warc.record(i, f"u{i}", bytes([65 + i]) * 300)) for i in range(5)]
    broken = bytearray(b"".join(data))
    broken[len(data[0]) + 30] ^= 255
    (tmp_path / "a.warc.gz").write_bytes(broken)
    rows = warc.read(spark.createDataFrame([(str(tmp_path / "a.warc.gz"),)], "path string"), payloads=True).collect()
    gap = [r for r in rows if r["kind"] == "gap"]
    assert [(r["start"], r["stop"]) for r in gap] == [(len(data[0]), len(data[0]) + len(data[1]))]
    assert {r["id"]: bytes(r["payload"])[:1] for r in rows if r["kind"] == "response"} == {"0": b"A", "2": b"C", "3": b"D", "4": b"E"}


@pytest.mark.parametrize("packed", [True, False])
def test_salvage_recovers_all_other_records(packed):
    records = [warc.record(i, f"u{i}", bytes([65 + i]) * (50 * i)) for i in range(8)]
    parts = [warc.member(r) if packed else r for r in records]
    edges = [0]
    for part in parts:
        edges.append(edges[-1] + len(part))
    for n in range(120):
        draw, data, k = random.Random(n), bytearray(b"".join(parts)), n % 8
        a, z = edges[k], edges[k + 1]
        kind = draw.randrange(4)
        if kind == 0:
            data[draw.randrange(a, z)] ^= 1 << draw.randrange(8)
        elif kind == 1:
            p = draw.randrange(a, z)
            del data[p : draw.randrange(p, z) + 1]
        elif kind == 2:
            data[a:a] = draw.randbytes(draw.randrange(1, 50))
        else:
            del data[a + (z - a) // 2 :]
        found = list(warc.salvage(warc.Archive(pa.BufferReader(bytes(data)))))
        ids = {warc._key(r.fields["warc-record-id"]) for r in found if not isinstance(r, tuple)}
        assert ids >= {str(i) for i in range(8) if (i != k or kind == 2) and not (kind == 3 and i >= k)}
        spans = sorted((r[0], r[1]) if isinstance(r, tuple) else (r.start, r.stop) for r in found)
        assert spans[0][0] == 0 and spans[-1][1] == len(data)
        assert all(x[1] == y[0] for x, y in zip(spans, spans[1:]))


@pytest.mark.parametrize("packed", [True, False])
def test_salvage_of_files_with_damaged_lengths(spark, tmp_path, packed):
    records = [warc.record(i, f"u{i}", bytes([65 + i]) * 300) for i in range(6)]
    for k, n in ((1, b"999999999999999"), (2, b"1"), (3, b"9" * 30), (4, b"-5"), (5, b"")):
        head, _, rest = records[k].partition(b"\r\n\r\n")
        lines = [b"Content-Length: " + n if x.startswith(b"Content-Length") else x for x in head.split(b"\r\n")]
        records[k] = b"\r\n".join(lines) + b"\r\n\r\n" + rest
    data = b"".join(warc.member(r) if packed else r for r in [*records, warc.record(6, "u6", b"G" * 300)])
    path = str(tmp_path / "damaged.warc")
    (tmp_path / "damaged.warc").write_bytes(data)
    rows = warc.read(spark.createDataFrame([(path,)], "path string")).collect()
    assert {r["id"] for r in rows if r["kind"] == "response"} == {"0", "6"}
    spans = sorted((r["start"], r["stop"]) for r in rows)
    assert spans[0][0] == 0 and spans[-1][1] == len(data) and all(a[1] == b[0] for a, b in zip(spans, spans[1:]))


def test_members_that_inflate_without_end(monkeypatch):
    big = warc.record(1, "u", b"z" * 2_000_000)
    data = warc.member(warc.record(0, "u", b"a" * 200)) + warc.member(big) + warc.member(warc.record(2, "u", b"c"))
    ids = lambda: [warc._key(r.fields["warc-record-id"]) if not isinstance(r, tuple) else r[2]
                   for r in warc.salvage(warc.Archive(pa.BufferReader(data)))]
    assert ids() == ["0", "1", "2"]
    monkeypatch.setattr(warc, "MOST_MEMBER", 1_000_000)
    assert ids() == ["0", "member is too large", "2"]


def test_empty_ids_are_not_null(spark):
    pages = spark.createDataFrame([("", "u", "x" * 150), ("b", "u", "x" * 150), (None, "u", "y")],
                                  "page_id string, url string, html string")
    found = {(r["page_id"], r["record_type"], r["refers_to"]) for r in warc.round_trip(spark, pages).collect()}
    assert found == {("", "response", None), ("b", "revisit", ""), (None, "response", None)}


def test_pipeline_stages(spark, sf_dir):
    from perilframe.llm import decontam, pii, simhash

    sf_dir = sf_dir.replace("sf0.001", "sf0.01")
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    labels = {r["doc_id"]: r["toxic"] for r in spark.read.parquet(f"{sf_dir}/labels.parquet").collect()}
    for name, stage in corpus_pipeline.STAGES:
        before, docs = docs, corpus_pipeline.staged(stage(spark, docs, sf_dir))
        if name != "packing":
            assert docs.dtypes == before.dtypes
        gone = {r["doc_id"] for r in before.collect()} - {r["doc_id"] for r in docs.collect()}
        if name == "toxicity":
            clean = [i for i in labels if labels[i] == 0]
            assert gone and sum(i in gone for i in clean) <= 0.03 * len(clean)
        if name == "near_duplicates":
            found = simhash.near_duplicates(before).collect()
            assert gone == {r["doc_id"] for r in found if r["doc_id"] != r["component_id"]}
        if name == "benchmark":
            items = spark.read.parquet(f"{sf_dir}/benchmark.parquet")
            assert gone == {r["doc_id"] for r in decontam.contaminated(before, items).collect()}
        if name == "personal_data":
            assert not gone and pii.detect(docs).where("n_email + n_ip + n_card + n_phone > 0").isEmpty()
    assert {r["doc_id"] for r in before.collect()} == {r["doc_id"] for r in docs.collect()}


def test_near_duplicate_stage_of_odd_rows(spark, odd_docs, no_docs, sf_dir):
    kept = corpus_pipeline.remove_near_duplicates(spark, odd_docs, sf_dir).collect()
    assert sorted(str(r["doc_id"]) for r in kept) == ["1", "4", "6", "7", "None", "None"]
    assert corpus_pipeline.remove_near_duplicates(spark, no_docs, sf_dir).collect() == []


def test_documents_that_share_an_id(spark, no_docs, sf_dir):
    words = lambda k: " ".join(f"w{k}x{i}" for i in range(60))
    rows = [(1, words(1)), (1, words(2)), (1, words(1)), (2, words(2)), (3, None), (3, words(3)), (None, words(3))]
    docs = spark.createDataFrame([(i, t, "en", "a", 0, "x", 1) for i, t in rows], no_docs.schema)
    kept = corpus_pipeline.remove_near_duplicates(spark, docs, sf_dir).collect()
    assert sorted((r["doc_id"], r["text"] or "") for r in kept) == [(1, words(1)), (1, words(2)), (3, ""), (3, words(3))]


def test_other_stages_of_odd_rows(spark, odd_docs, no_docs, sf_dir):
    for name, stage in corpus_pipeline.STAGES:
        if name not in ("near_duplicates", "packing"):
            assert stage(spark, odd_docs, sf_dir).count() == odd_docs.count()
        assert stage(spark, no_docs, sf_dir).collect() == []
