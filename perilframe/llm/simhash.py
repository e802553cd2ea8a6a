"""SimHash near-dedup: fingerprints that differ in a few bits share a block of bits.

Fingerprints are 64 bits. They are cut into ``blocks`` parts; two that differ in at most
``distance`` bits agree in ``blocks - distance`` of them, so each fingerprint is keyed by every such
choice of parts, joined on the keys and verified by its Hamming distance. Equal fingerprints are one
before anything is joined. A key with very many fingerprints is dealt into square cells of bounded
size, which together hold all its pairs; a cell returns a spanning forest of its links, not the pairs.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator
from itertools import combinations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from perilframe.llm.common import fresh, give_back, runs, staged, text_bytes
from perilframe.llm.components import connected_components

SEED = 42
_CHUNK = 1 << 16


def fingerprint(text: bytes, shingle: int) -> int:
    """Signed 64 bits: a bit is 1 if more than half of the shingles' hashes have it."""
    words = text.lower().split()  # of bytes: A-Z only, and blanks are 0x20 and 0x09-0x0D
    if not words:
        return 0
    joined = b" ".join(words)
    lengths = np.fromiter(map(len, words), np.int64, len(words))
    ends = np.cumsum(lengths + 1) - 1
    starts = (ends - lengths).tolist()
    ends = ends[min(shingle, len(words)) - 1 :].tolist()
    digest = xxhash.xxh64_intdigest
    total = np.zeros(64, np.int64)
    for at in range(0, len(ends), _CHUNK):
        spans = zip(starts[at : at + _CHUNK], ends[at : at + _CHUNK])
        hashes = np.array([digest(joined[a:b], SEED) for a, b in spans], np.uint64)
        bits = np.unpackbits(hashes.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little")
        total += bits.sum(axis=0, dtype=np.int64)
    return int(np.packbits(2 * total > len(ends), bitorder="little").view(np.int64)[0])


def _fingerprints(shingle: int):
    @F.arrow_udf("long")
    def of_text(text: pa.Array) -> pa.Array:
        made = pa.array([fingerprint(t, shingle) for t in text_bytes(text)], pa.int64())
        give_back()
        return made

    return of_text


def with_fingerprint(docs: DataFrame, text: str = "text", shingle: int = 4,
                     name: str = "fingerprint") -> DataFrame:
    """``docs`` and the fingerprint of each whole text; null and wordless texts have 0."""
    return docs.withColumn(name, _fingerprints(shingle)(F.col(f"`{text}`")))


def block_masks(blocks: int, kept: int) -> list[int]:
    """Signed 64-bit masks of every choice of ``kept`` out of ``blocks`` parts."""
    edges = [64 * i // blocks for i in range(blocks + 1)]
    parts = [(1 << b) - (1 << a) for a, b in zip(edges, edges[1:])]
    masks = (sum(chosen) for chosen in combinations(parts, kept))
    return [m - (1 << 64) if m >> 63 else m for m in masks]


def near_links(prints: DataFrame, distance: int = 4, blocks: int = 7, cell: int = 1024) -> DataFrame:
    """Links (a, b) between the distinct fingerprints ``prints(fp)``: enough of the pairs at
    ``distance`` or fewer bits to connect whatever all of them connect."""
    keys = F.array(*(
        F.struct(F.lit(i).alias("part"), F.col("fp").bitwiseAND(F.lit(m)).alias("bits"))
        for i, m in enumerate(block_masks(blocks, blocks - distance))
    ))
    keyed = prints.select("fp", F.inline(keys))
    shared = keyed.groupBy("part", "bits").agg(F.count("*").alias("n")).where("n > 1")
    # Spark sizes ``keyed`` by its fingerprints, not by the keys made of each, and would broadcast it.
    met = keyed.join(shared.hint("merge"), ["part", "bits"]).select(
        "part", "bits", "fp", F.ceil(F.col("n") / cell).cast("int").alias("slots")
    )
    slot: Column = F.pmod(F.xxhash64("fp"), F.col("slots")).cast("int")
    cells = met.withColumn("slot", slot).select(
        "part", "bits", "fp",
        F.explode(F.transform(
            F.sequence(F.lit(0), F.col("slots") - 1),
            lambda t: F.least("slot", t) * F.col("slots") + F.greatest("slot", t),
        )).alias("cell"),
    )
    group = ["part", "bits", "cell"]
    return (
        cells.repartition(*group)
        .sortWithinPartitions(*group)
        .mapInArrow(_verified(distance, group), "a long, b long")
    )


def _verified(distance: int, group: list[str]):
    def verify(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for table, starts in runs(batches, group):
            prints = table["fp"].to_numpy().view(np.uint64)  # bit counts of signed numbers differ
            size = np.diff(starts)
            two = starts[:-1][size == 2]
            near = two[np.bitwise_count(prints[two] ^ prints[two + 1]) <= distance]
            a, b = [prints[near]], [prints[near + 1]]
            for start, n in zip(starts[:-1][size > 2], size[size > 2]):
                for x, y in _forest(prints[start : start + n], distance):
                    a.append(x)
                    b.append(y)
            pair = [np.concatenate(x).view(np.int64) for x in (a, b)]
            yield pa.RecordBatch.from_arrays([pa.array(x) for x in pair], ["a", "b"])

    return verify


def _forest(prints: np.ndarray, distance: int) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Links that reach every fingerprint from another at the distance, breadth first."""
    left = prints
    while len(left):
        queue, left = [left[0]], left[1:]
        while queue and len(left):
            seen = queue.pop()
            near = np.bitwise_count(left ^ seen) <= distance
            if near.any():
                found = left[near]
                yield np.full(len(found), seen), found
                queue.extend(found)
                left = left[~near]


def near_duplicates(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", shingle: int = 4,
                    distance: int = 4, blocks: int = 7) -> DataFrame:
    """One row (id, fingerprint, component_id, root) per row of ``docs``; root is the component's
    smallest fingerprint.

    Texts whose fingerprints differ in ``distance`` bits or fewer are linked, null, empty and
    wordless texts (fingerprint 0) like any other. component_id is the smallest id reachable. Rows
    without id take part in linking and get the component's smallest id, null if it has none;
    repeated rows are returned as often as they occur; other columns are ignored.
    """
    [fp] = fresh(docs.select(f"`{doc_id}`"), "fp")
    narrow = with_fingerprint(docs.select(f"`{doc_id}`", f"`{text}`"), text, shingle, fp)
    narrow = staged(narrow.select(F.col(f"`{doc_id}`").alias("id"), F.col(f"`{fp}`").alias("fp")))
    prints = narrow.groupBy("fp").agg(F.min("id").alias("least"))
    roots = connected_components(near_links(prints.select("fp"), distance, blocks))
    linked = prints.join(roots, prints["fp"] == roots["node"])
    smallest = linked.groupBy("root").agg(F.min("least").alias("smallest"))
    moved = linked.join(smallest, "root").select("fp", "smallest", "root")
    component = prints.join(moved, "fp", "left").select(
        "fp", F.coalesce("smallest", "least").alias("component_id"), F.coalesce("root", "fp").alias("root")
    )
    return narrow.join(component, "fp").select(
        F.col("id").alias(doc_id), F.col("fp").alias("fingerprint"), "component_id", "root"
    )


def deduplicated(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", shingle: int = 4,
                 distance: int = 4, blocks: int = 7) -> DataFrame:
    """One row of each component of ``docs``, with all its columns: that with the smallest id (null after
    all), the first in the table where ids repeat. Different texts that share an id are rows of their own."""
    row, fp = fresh(docs, "row", "fp")
    marked = staged(with_fingerprint(docs.withColumn(row, F.monotonically_increasing_id()), text, shingle, fp))
    place = F.struct(F.col(f"`{doc_id}`").isNull().alias("unnamed"), F.col(f"`{doc_id}`").alias("id"), F.col(row).alias("row"))
    prints = staged(marked.groupBy(F.col(fp).alias("fp")).agg(F.min(place).alias("least")))
    roots = connected_components(near_links(prints.select("fp"), distance, blocks))
    kept = (
        prints.join(roots, prints["fp"] == roots["node"], "left")
        .groupBy(F.coalesce("root", "fp").alias("component")).agg(F.min("least").alias("least"))
        .select(F.col("least.row").alias(row))
    )
    return marked.join(kept, row, "left_semi").select(*(F.col(f"`{c}`") for c in docs.columns))


def hex_print(column: str = "fingerprint") -> Column:
    """16 lowercase hexadecimal digits of a signed 64-bit number."""
    return F.lower(F.lpad(F.hex(column), 16, "0"))
