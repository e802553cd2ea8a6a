"""What several text operators share: staging in the cluster's folder and run handling in tasks."""

from __future__ import annotations

import ctypes
import uuid
from collections.abc import Iterable, Iterator
from contextlib import contextmanager

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import xxhash
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

#: Set for the length of one write: shuffle files go once the staged table is complete.
FREE_SHUFFLES = (
    "spark.sql.classic.shuffleDependency.fileCleanup.enabled",
    "spark.sql.shuffleDependency.fileCleanup.enabled",
)
#: A word is a run of anything but these.
BLANKS = "\\x20\\x09-\\x0D"


def shared_dir(spark: SparkSession) -> str:
    """A new folder below the one all executors share; the warehouse where none is set."""
    root = spark.conf.get("spark.checkpoint.dir", None) or spark.conf.get("spark.sql.warehouse.dir")
    return f"{root.rstrip('/')}/llm-{uuid.uuid4().hex}"


@contextmanager
def _freed_shuffles(spark: SparkSession) -> Iterator[None]:
    before = {k: spark.conf.get(k, None) for k in FREE_SHUFFLES}
    for key in FREE_SHUFFLES:
        spark.conf.set(key, "true")
    try:
        yield
    finally:
        for key, value in before.items():
            spark.conf.unset(key) if value is None else spark.conf.set(key, value)


def staged(frame: DataFrame, codec: str | None = None) -> DataFrame:
    """Write a frame once into the shared folder and read it from there: it cuts the lineage, and
    a lost executor costs a read. Folders are left to the retention policy of that place. ``codec``
    is the compression, the session's where it is not given."""
    spark = frame.sparkSession
    path = shared_dir(spark)
    with _freed_shuffles(spark):
        frame.write.parquet(path, compression=codec)
    return spark.read.schema(frame.schema).parquet(path)


def fresh(frame: DataFrame, *names: str) -> list[str]:
    """The wanted column names, changed where the frame has them (in any case) already."""
    taken = {c.lower() for c in frame.columns}
    out = []
    for name in names:
        while name.lower() in taken:
            name = f"_{name}"
        taken.add(name.lower())
        out.append(name)
    return out


def free_columns(frame: DataFrame, *names: str) -> DataFrame:
    """The frame without columns of these names, which an operator is about to add."""
    gone = {n.lower() for n in names}
    return frame.select(*(F.col(f"`{c}`") for c in frame.columns if c.lower() not in gone))


def text_bytes(column: pa.Array) -> list[bytes]:
    """UTF-8 bytes of each text; null counts as empty."""
    return [b"" if x is None else x for x in column.cast(pa.binary()).to_pylist()]


def give_back() -> None:
    """Return freed memory to the system. Python workers serve one stage after another, and what their
    allocators hold back adds up."""
    pa.default_memory_pool().release_unused()
    trim = getattr(ctypes.CDLL(None), "malloc_trim", None)
    if trim:
        trim(0)


def terms(texts: pa.Array) -> tuple[pa.Array, np.ndarray, np.ndarray]:
    """Different terms, the term at each place, and where each text begins (and the last ends).
    A term is a word in lower case without signs around it; words of signs only are left out."""
    filled = pc.fill_null(texts.cast(pa.large_string()), "")
    split = pc.ascii_split_whitespace(filled)
    words = split.flatten().dictionary_encode()
    trimmed = pc.replace_substring_regex(
        pc.utf8_lower(words.dictionary), r"^[^\p{L}\p{N}]+|[^\p{L}\p{N}]+$", ""
    ).dictionary_encode()
    index = trimmed.indices.to_numpy()[words.indices.to_numpy()] if len(words) else np.zeros(0, int)
    empty = pc.index(trimmed.dictionary, "").as_py()
    real = index != empty
    before = np.r_[0, np.cumsum(real)]
    return trimmed.dictionary, index[real], before[split.offsets.to_numpy()]


def term_hashes(dictionary: pa.Array) -> np.ndarray:
    return np.fromiter(map(xxhash.xxh3_64_intdigest, dictionary.to_pylist()), np.uint64, len(dictionary))


def shingle_hashes(hashes: np.ndarray, size: int) -> np.ndarray:
    """One number for each run of ``size`` terms, given the number of each term."""
    out = np.zeros(max(0, len(hashes) - size + 1), np.uint64)
    for i in range(size):
        out *= np.uint64(0x9E3779B97F4A7C15)
        out += hashes[i : i + len(out)]
    out ^= out >> np.uint64(29)
    out *= np.uint64(0xBF58476D1CE4E5B9)
    return out ^ (out >> np.uint64(32))


def runs(batches: Iterable[pa.RecordBatch], keys: list[str]) -> Iterator[tuple[pa.Table, np.ndarray]]:
    """Tables of whole groups with the start of each group and the number of rows at the end.
    The input must be sorted by the keys; only the last, unfinished group is carried over."""
    carry: list[pa.RecordBatch] = []
    for batch in batches:
        if not batch.num_rows:
            continue
        table = pa.Table.from_batches([*carry, batch]).combine_chunks()
        starts = _starts(table, keys)
        last = int(starts[-1])
        if last:
            yield table.slice(0, last), starts
        carry = table.slice(last).combine_chunks().to_batches()
    if carry:
        table = pa.Table.from_batches(carry).combine_chunks()
        yield table, np.array([0, table.num_rows])


def _starts(table: pa.Table, keys: list[str]) -> np.ndarray:
    new = np.zeros(table.num_rows, bool)
    new[0] = True
    for key in keys:
        values = table[key].to_numpy()
        new[1:] |= values[1:] != values[:-1]
    return np.flatnonzero(new)
