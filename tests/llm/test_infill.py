"""Fill in the middle against a plain reading of the contract, and the exact round trip."""

from __future__ import annotations

import hashlib
import re

import duckdb
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from perilframe.llm import infill, queries


def plainly(text: str, doc_id) -> tuple:
    tokens = re.findall("[A-Za-z]+|[^A-Za-z]", text)
    digest = hashlib.sha256(f"1:{doc_id}".encode()).hexdigest()
    h = [int(digest[i : i + 8], 16) for i in (0, 8, 16, 24)]
    n = len(tokens)
    a, b = sorted((h[0] % (n + 1), h[1] % (n + 1)))
    prefix, middle, suffix = "".join(tokens[:a]), "".join(tokens[a:b]), "".join(tokens[b:])
    if not text or re.search("<[PSM]>", text) or h[2] % 100 >= 90:
        return n, "plain", None, None, text
    form = "spm" if h[3] % 100 < 20 else "psm"
    out = f"<S>{suffix}<P>{prefix}<M>{middle}" if form == "spm" else f"<P>{prefix}<S>{suffix}<M>{middle}"
    return n, form, len(prefix), len(middle), out


@settings(max_examples=400, deadline=None)
@given(st.text(alphabet="abAZ é<>PSM\n€😀1", max_size=40), st.integers(0, 10**6))
def test_output_and_round_trip(text, doc_id):
    body = text.encode()
    n, form, first, second = infill.choose(body, doc_id, 1, 90, 20)
    want = plainly(text, doc_id)
    assert (n, form) == want[:2]
    if form != "plain":
        out = bytes(infill.arrange(body, first, second, form))
        assert out.decode() == want[4]
        assert infill.restore(out, form) == body


def test_rotation():
    for n in range(8):
        for start in range(n + 1):
            for middle in range(start, n + 1):
                for stop in range(middle, n + 1):
                    data = list(range(n))
                    buffer = bytearray(data)
                    infill.rotate(buffer, start, middle, stop)
                    assert list(buffer) == data[:start] + data[middle:stop] + data[start:middle] + data[stop:]


def test_damaged_output_is_refused():
    with pytest.raises(ValueError):
        infill.restore(b"x<P>a<S>b<M>c", "psm")


def test_odd_rows(odd_docs, no_docs):
    named = odd_docs.withColumn("form", odd_docs.fp)  # a column that clashes
    rows = infill.transform(named).select("doc_id", "text", "n", "form", "prefix_chars", "middle_chars", "output",
                                          infill.restored().alias("back")).collect()
    assert len(rows) == odd_docs.count()
    for r in rows:
        want = plainly(r["text"] or "", "" if r["doc_id"] is None else r["doc_id"])
        assert (r["n"], r["form"], r["prefix_chars"], r["middle_chars"], r["output"]) == want
        assert r["back"] == (r["text"] or "")
    assert infill.transform(no_docs).count() == 0
    assert "source" in infill.transform(no_docs).columns


def test_query_against_sql(spark, sf_dir):
    got = {r["doc_id"]: tuple(r) for r in queries.op13_infill(spark, sf_dir).collect()}
    con = duckdb.connect()
    con.execute(f"CREATE VIEW documents AS SELECT * FROM '{sf_dir}/documents.parquet'")
    want = {r[0]: r for r in con.sql(infill.SQL).fetchall()}
    assert got == want and {r[2] for r in want.values()} == {"plain", "psm", "spm"}
