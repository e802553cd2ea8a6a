"""Substring dedup by sliding sentence spans.

From every sentence on, the shortest run of several consecutive sentences that is long enough is hashed;
runs are joined globally on the hash, and sentences covered by any repeated run other than its first are
removed. A long sentence counts as its clauses, so that a passage of one or two such sentences, or one
glued to other text at its ends, holds whole runs too. Where a run ends depends on what it says alone.
"""

from __future__ import annotations

import re
from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from perilframe.llm.common import give_back, staged

#: Sentences of a run, and its characters without the blanks between them, at least.
RUN, SIZE = 2, 120
#: Characters from which a sentence goes by its clauses.
LONG = 90
#: Runs that a task holds before it passes them on.
ROWS = 1 << 16
BLANKS = " \t\n\x0b\x0c\r"
#: A sentence ends after its mark and the blanks behind it, or after a line; a clause after its mark or a
#: word of nine characters or more.
SENTENCE_END = "[.!?][\\x20\\x09-\\x0D]+|\\n[\\x20\\x09-\\x0D]*"
CLAUSE_END = "[,;:][\\x20\\x09-\\x0D]+|[^\\x20\\x09-\\x0D]{9}[\\x20\\x09-\\x0D]+"
_SENTENCE, _CLAUSE = re.compile(SENTENCE_END), re.compile(CLAUSE_END)


def _parts(text: str, end: re.Pattern) -> list[str]:
    """The text cut behind each match."""
    borders = [0, *(m.end() for m in end.finditer(text)), len(text)]
    return [text[a:b] for a, b in zip(borders, borders[1:]) if a < b]


def sentences(text: str) -> list[str]:
    """Pieces that together are the text: sentences, long ones as clauses."""
    out: list[str] = []
    for sentence in _parts(text, _SENTENCE):
        if len(sentence) > LONG:
            out += _parts(sentence, _CLAUSE)
        else:
            out.append(sentence)
    return out


def runs_of(pieces: list[str], run: int, size: int) -> tuple[list[str], np.ndarray]:
    """The pieces without blanks around them, and where the run that starts at each one ends; runs that
    the text's end cuts short are left out."""
    keys = [p.strip(BLANKS) for p in pieces]
    sums = np.cumsum([0, *map(len, keys)])
    stop = np.maximum(np.searchsorted(sums, sums[:-1] + size), np.arange(len(keys)) + run)
    return keys, stop[stop <= len(keys)]


def _hashed(run: int, size: int):
    def made(batch: pa.RecordBatch, nth: list, places: list, digests: list) -> pa.RecordBatch:
        half = np.frombuffer(b"".join(digests), np.int64).reshape(-1, 2)
        owner = pa.array(np.concatenate(nth))
        return pa.RecordBatch.from_arrays(
            [batch.column(0).take(owner), batch.column(1).take(owner), pa.array(np.concatenate(places)),
             pa.array(half[:, 0]), pa.array(half[:, 1])], ["row", "id", "at", "high", "low"])

    def hashes(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            nth, places, digests = [], [], []
            for row in range(batch.num_rows):
                keys, stop = runs_of(sentences(batch.column(2)[row].as_py() or ""), run, size)
                # No sentence has a line's end inside, so the join is unambiguous.
                digests += (xxhash.xxh3_128_digest("\n".join(keys[a:b])) for a, b in enumerate(stop.tolist()))
                places.append(np.arange(len(stop), dtype=np.int32))
                nth.append(np.full(len(stop), row))
                if len(digests) >= ROWS:
                    yield made(batch, nth, places, digests)
                    nth, places, digests = [], [], []
            if digests:
                yield made(batch, nth, places, digests)
            give_back()

    return hashes


def _cut(run: int, size: int):
    def cut(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            total, removed, kept = [], [], []
            for text, starts in zip(batch.column(1).to_pylist(), batch.column(2).to_pylist()):
                pieces = sentences(text or "")
                keep = np.ones(len(pieces), bool)
                if starts:
                    stop = runs_of(pieces, run, size)[1]
                    for at in starts:
                        keep[at : stop[at]] = False
                total.append(len(pieces))
                removed.append(len(pieces) - int(keep.sum()))
                kept.append("".join(p for p, k in zip(pieces, keep.tolist()) if k) if starts else text or "")
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array(total, pa.int64()), pa.array(removed, pa.int64()), pa.array(kept, pa.string())],
                ["id", "n_sentences", "n_removed", "kept_text"])

    return cut


def deduplicated(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", run: int = RUN,
                 size: int = SIZE) -> DataFrame:
    """id, n_sentences, n_removed and ``kept_text`` of every document.

    Runs are equal if their sentences are, blanks around these aside; they are compared by 128 bits. The
    first of equal runs is the one with the smallest id (null before all), then place; rows that share an
    id are texts of their own, in the order of the table. Null text is empty; a text shorter than a run
    loses nothing. What is kept is the sentences as they were. Other columns are ignored.
    """
    narrow = docs.select(F.col(f"`{doc_id}`").alias("id"), F.col(f"`{text}`").alias("text"))
    texts = staged(narrow.select(F.monotonically_increasing_id().alias("row"), "id", "text"))
    kind = texts.schema["id"].dataType.simpleString()
    found = staged(texts.mapInArrow(_hashed(run, size), f"row long, id {kind}, at int, high long, low long"))
    key = ["high", "low"]
    # Written down, so that both sides of the join below come from plain shuffles, which may be split.
    first = staged(found.groupBy(*key).agg(
        F.count("*").alias("n"), F.min(F.struct("id", "row", "at")).alias("first")).where("n > 1")
        .select(*key, F.col("first.row").alias("first_row"), F.col("first.at").alias("first_at")))
    later = found.drop("id").join(first, key).where("row <> first_row or at <> first_at")
    # Written down as well, so that the shuffle of the runs is gone before that of the texts.
    gone = staged(later.groupBy("row").agg(F.collect_list("at").alias("gone")))
    return (
        texts.join(gone, "row", "left").select("id", "text", "gone")
        .mapInArrow(_cut(run, size), f"id {kind}, n_sentences long, n_removed long, kept_text string")
        .withColumnRenamed("id", doc_id)
    )


#: The same in DuckDB's SQL, with a digest of what is kept.
SQL = f"""
WITH s AS (
  SELECT doc_id, unnest(x) AS sentence, unnest(range(len(x))) AS nth FROM (
    SELECT doc_id, list_filter(regexp_extract_all(coalesce(text, ''), '(?s).*?(?:{SENTENCE_END}|\\z)'),
      lambda x: x <> '') AS x FROM documents)
), c AS (
  SELECT doc_id, nth, CASE WHEN length(sentence) > {LONG} THEN list_filter(
    regexp_extract_all(sentence, '(?s).*?(?:{CLAUSE_END}|\\z)'), lambda x: x <> '')
    ELSE [sentence] END AS x FROM s
), f AS (
  SELECT doc_id, nth, unnest(x) AS piece, unnest(range(len(x))) AS part FROM c
), p AS (
  SELECT doc_id, piece, row_number() OVER w - 1 AS pos,
    trim(piece, ' ' || chr(9) || chr(10) || chr(11) || chr(12) || chr(13)) AS key
  FROM f WINDOW w AS (PARTITION BY doc_id ORDER BY nth, part)
), k AS (
  SELECT *, sum(length(key)) OVER (PARTITION BY doc_id ORDER BY pos) AS up_to FROM p
), e AS (
  SELECT doc_id, up_to, min(pos) AS last FROM k GROUP BY doc_id, up_to
), r AS (
  SELECT k.doc_id, k.pos, greatest(e.last, k.pos + {RUN - 1}) AS last
  FROM k ASOF JOIN e ON k.doc_id = e.doc_id AND k.up_to - length(k.key) + {SIZE} <= e.up_to
), t AS (
  SELECT r.doc_id, r.pos, r.last, string_agg(k.key, chr(10) ORDER BY k.pos) AS run
  FROM r JOIN k ON k.doc_id = r.doc_id AND k.pos BETWEEN r.pos AND r.last
  GROUP BY r.doc_id, r.pos, r.last HAVING count(*) = r.last - r.pos + 1
), d AS (
  SELECT doc_id, pos, last, row_number() OVER (PARTITION BY run ORDER BY doc_id, pos) AS nth FROM t
), g AS (
  SELECT DISTINCT doc_id, unnest(range(pos, last + 1)) AS pos FROM d WHERE nth > 1
)
SELECT s.doc_id, count(k.pos) AS n_sentences, count(g.pos) AS n_removed,
  sha256(coalesce(string_agg(k.piece, '' ORDER BY k.pos) FILTER (WHERE g.pos IS NULL), '')) AS kept_sha256
FROM documents s LEFT JOIN k ON k.doc_id = s.doc_id LEFT JOIN g ON g.doc_id = k.doc_id AND g.pos = k.pos
GROUP BY s.doc_id
"""
