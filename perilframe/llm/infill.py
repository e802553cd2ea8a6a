"""Fill-in-middle transformation by block rotation inside one buffer.

A text is cut twice at token borders. The sentinels are written into a bytearray at the cuts, which
gives the three segments in reading order; exchanging two neighbours there is a rotation, done by
reversing each of them and then both together. The inverse finds the sentinels, rotates the segments
back and takes the sentinels out, so that a text is restored from its output and form alone.
"""

from __future__ import annotations

import hashlib

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from perilframe.llm.common import free_columns, text_bytes

PREFIX, SUFFIX, MIDDLE = b"<P>", b"<S>", b"<M>"
#: Of a hundred texts so many are rearranged, and of a hundred rearranged ones so many suffix first.
RATE, SUFFIX_FIRST = 90, 20


def token_starts(text: bytes) -> np.ndarray:
    """Where each token starts: a run of the letters A-Z and a-z, or any other code point."""
    data = np.frombuffer(text, np.uint8)
    letter = (data | 0x20) - np.uint8(97) < 26
    start = (data & 0xC0) != 0x80
    start[1:] &= ~(letter[1:] & letter[:-1])
    return np.flatnonzero(start)


def draws(doc_id: object, seed: int) -> list[int]:
    """Four numbers of 32 bits, fixed by the seed and the id; a null id counts as empty."""
    name = "" if doc_id is None else str(doc_id)
    digest = hashlib.sha256(f"{seed}:{name}".encode()).hexdigest()
    return [int(digest[i : i + 8], 16) for i in range(0, 32, 8)]


def _reverse(buffer: bytearray, start: int, stop: int) -> None:
    view = np.frombuffer(buffer, np.uint8)[start:stop]
    half = len(view) // 2
    front = view[:half].copy()
    view[:half] = view[::-1][:half]
    view[::-1][:half] = front


def rotate(buffer: bytearray, start: int, middle: int, stop: int) -> None:
    """Exchange the neighbours [start, middle) and [middle, stop) in place."""
    _reverse(buffer, start, middle)
    _reverse(buffer, middle, stop)
    _reverse(buffer, start, stop)


def arrange(text: bytes, first: int, second: int, form: str) -> bytearray:
    """The output of a text cut at two byte positions, for the forms psm and spm."""
    buffer = bytearray(text)
    for at, sentinel in ((second, SUFFIX), (first, MIDDLE), (0, PREFIX)):
        buffer[at:at] = sentinel
    middle = first + len(PREFIX)
    suffix = second + len(PREFIX) + len(MIDDLE)
    rotate(buffer, middle, suffix, len(buffer))  # prefix, suffix, middle
    if form == "spm":
        rotate(buffer, 0, middle, middle + len(buffer) - suffix)
    return buffer


def restore(output: bytes, form: str) -> bytes:
    """The text that an output was made from."""
    if form == "plain":
        return bytes(output)
    buffer = bytearray(output)
    if form == "spm":
        rotate(buffer, 0, buffer.index(PREFIX), buffer.index(MIDDLE))
    suffix, middle = buffer.index(SUFFIX), buffer.index(MIDDLE)
    rotate(buffer, suffix, middle, len(buffer))  # prefix, middle, suffix
    for sentinel, at in ((SUFFIX, suffix + len(buffer) - middle), (MIDDLE, suffix), (PREFIX, 0)):
        if buffer[at : at + len(sentinel)] != sentinel:
            raise ValueError("not an output of this form")
        del buffer[at : at + len(sentinel)]
    return bytes(buffer)


def choose(text: bytes, doc_id: object, seed: int, rate: int, suffix_first: int) -> tuple[int, str, int, int]:
    """Number of tokens, form, and the two cuts as byte positions."""
    starts = token_starts(text)
    n = len(starts)
    h = draws(doc_id, seed)
    units = sorted((h[0] % (n + 1), h[1] % (n + 1)))
    cuts = [int(starts[u]) if u < n else len(text) for u in units]
    if not text or any(s in text for s in (PREFIX, SUFFIX, MIDDLE)) or h[2] % 100 >= rate:
        return n, "plain", *cuts
    return n, "spm" if h[3] % 100 < suffix_first else "psm", *cuts


def _points(piece: bytes) -> int:
    """Code points of whole UTF-8 characters."""
    return int(np.count_nonzero((np.frombuffer(piece, np.uint8) & 0xC0) != 0x80))


_MADE = [("n", pa.int64()), ("form", pa.string()), ("prefix_chars", pa.int64()), ("middle_chars", pa.int64()),
         ("output", pa.string())]
ADDED = tuple(name for name, _ in _MADE)
_DDL = "struct<n: long, form: string, prefix_chars: long, middle_chars: long, output: string>"


def transform(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", seed: int = 1, rate: int = RATE,
              suffix_first: int = SUFFIX_FIRST) -> DataFrame:
    """``docs`` with n (tokens), form (plain, psm or spm), prefix_chars, middle_chars and output.

    Row by row over whole texts, without a shuffle. Null, empty and wordless texts, and texts that
    hold a sentinel, are plain; null becomes empty. The cuts depend on the seed, the id and the number
    of tokens only, so repeated rows and ties come out alike; a null id draws as an empty one. Columns
    named as the added ones are replaced.
    """

    @F.arrow_udf(_DDL)
    def made(ids: pa.Array, texts: pa.Array) -> pa.Array:
        columns: dict[str, list] = {name: [] for name in ADDED}
        for key, body in zip(ids.to_pylist(), text_bytes(texts)):
            n, form, first, second = choose(body, key, seed, rate, suffix_first)
            plain = form == "plain"
            row = (n, form, None if plain else _points(body[:first]),
                   None if plain else _points(body[first:second]),
                   (body if plain else bytes(arrange(body, first, second, form))).decode())
            for name, value in zip(ADDED, row):
                columns[name].append(value)
        return pa.StructArray.from_arrays([pa.array(columns[c], kind) for c, kind in _MADE], list(ADDED))

    kept = free_columns(docs, *(a for a in ADDED if a.lower() not in (doc_id.lower(), text.lower())), "_made")
    found = kept.withColumn("_made", made(F.col(f"`{doc_id}`"), F.col(f"`{text}`")))
    return found.select(*(F.col(f"`{c}`") for c in kept.columns), "_made.*")


def _restored(output: pa.Array, form: pa.Array) -> pa.Array:
    pairs = zip(output.cast(pa.binary()).to_pylist(), form.to_pylist())
    return pa.array([None if o is None or f is None else restore(o, f).decode() for o, f in pairs], pa.string())


def restored(output: str = "output", form: str = "form") -> Column:
    """The text rebuilt from an output and its form; null where either is null."""
    return F.arrow_udf(_restored, "string")(output, form)


#: The contract's columns in DuckDB's SQL.
SQL = """
WITH h AS (
  SELECT doc_id, coalesce(text, '') AS text, sha256('1:' || coalesce(doc_id::VARCHAR, '')) AS x FROM documents
), t AS (
  SELECT doc_id, text, regexp_extract_all(text, '[A-Za-z]+|[^A-Za-z]') AS token,
    ('0x' || x[1:8])::BIGINT AS h1, ('0x' || x[9:16])::BIGINT AS h2,
    ('0x' || x[17:24])::BIGINT AS h3, ('0x' || x[25:32])::BIGINT AS h4 FROM h
), c AS (
  SELECT *, len(token) AS n, least(h1 % (len(token) + 1), h2 % (len(token) + 1)) AS a,
    greatest(h1 % (len(token) + 1), h2 % (len(token) + 1)) AS b,
    CASE WHEN text = '' OR regexp_matches(text, '<[PSM]>') OR h3 % 100 >= 90 THEN 'plain'
      WHEN h4 % 100 < 20 THEN 'spm' ELSE 'psm' END AS form FROM t
), p AS (
  SELECT *, array_to_string(token[1:a], '') AS prefix, array_to_string(token[a + 1:b], '') AS middle,
    array_to_string(token[b + 1:n], '') AS suffix FROM c
)
SELECT doc_id, n::BIGINT AS n, form,
  CASE WHEN form <> 'plain' THEN length(prefix)::BIGINT END AS prefix_chars,
  CASE WHEN form <> 'plain' THEN length(middle)::BIGINT END AS middle_chars,
  sha256(CASE form WHEN 'plain' THEN text
    WHEN 'psm' THEN '<P>' || prefix || '<S>' || suffix || '<M>' || middle
    ELSE '<S>' || suffix || '<P>' || prefix || '<M>' || middle END) AS output_sha256,
  sha256(text) AS restored_sha256
FROM p
"""
