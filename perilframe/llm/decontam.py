"""Benchmark decontamination by SimHash of item-sized windows.

A window of an item's number of words is compared with the items: multi-index Hamming blocks find
every item whose fingerprint lies within the radius, and the exact weighted similarity of the word
shingles decides. Every window is looked up that can reach the similarity at all: of a window of b
shingles and an item of a, (a + b) * similarity / (1 + similarity) must be shared, so a window with
fewer shingles of items of its size is passed over without loss. Running sums over the text give the
count of shared shingles and the bits of each window's fingerprint.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import combinations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_type

from perilframe.llm.common import fresh, give_back, shingle_hashes, term_hashes, terms

SHINGLE, SIMILARITY = 5, 0.8
#: Differing bits up to which items are verified. Texts of similarity 0.8 differ in 10 of 64 bits on
#: average, with a deviation of 3; the tests measure what the radius loses.
RADIUS = 18
#: The benchmark is a stated set of queries: it is searched in blocks of so many items, and so many
#: bytes of their texts, about.
ITEMS_A_PASS, BYTES_A_PASS = 20_000, 32 << 20
#: Windows whose fingerprints are made at a time.
_WINDOWS = 4096
_PARTS, _PART_BITS = 4, 16
_SEEN_BITS = 20


def simhash(hashes: np.ndarray) -> int:
    bits = np.unpackbits(hashes.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little")
    votes = 2 * bits.sum(axis=0, dtype=np.int64) > len(hashes)
    return int(np.packbits(votes, bitorder="little").view(np.uint64)[0])


def similarity(a: np.ndarray, b: np.ndarray) -> float:
    """Shingles in common against shingles in either, each with its number of occurrences."""
    both, at = np.unique(np.concatenate([a, b]), return_inverse=True)
    x, y = (np.bincount(i, minlength=len(both)) for i in (at[: len(a)], at[len(a) :]))
    return float(np.minimum(x, y).sum() / np.maximum(x, y).sum())


class Items:
    """Shingles, fingerprints and Hamming blocks of a bounded number of benchmark items."""

    def __init__(self, ids: list, texts: list[str | None]):
        dictionary, index, offsets = terms(pa.array(texts, pa.string()))
        hashes = term_hashes(dictionary)
        self.ids, self.shingles, self.size, self.width = [], [], [], []
        for key, a, b in zip(ids, offsets, offsets[1:]):
            if a == b:
                continue  # nothing to find
            width = min(SHINGLE, int(b - a))
            self.ids.append(key)
            self.shingles.append(shingle_hashes(hashes[index[a:b]], width))
            self.size.append(int(b - a))
            self.width.append(width)
        self.prints = np.array([simhash(s) for s in self.shingles], np.uint64)
        self.widths = sorted(set(self.width))
        self._of_size = {n: np.array([i for i, x in enumerate(self.size) if x == n]) for n in set(self.size)}
        # Shingle -> the sizes of the items that have it.
        known = sorted({(h, n) for s, n in zip(self.shingles, self.size) for h in s.tolist()})
        self.known, self._sizes = (np.array(x, t) for x, t in zip(zip(*known), (np.uint64, np.int64))) if known else (
            np.zeros(0, np.uint64), np.zeros(0, np.int64))
        self.seen = np.zeros(1 << _SEEN_BITS, bool)
        self.seen[self.known >> np.uint64(64 - _SEEN_BITS)] = True
        self._blocks = [Block(self._part(self.prints, part)) for part in range(_PARTS)]

    @staticmethod
    def _part(prints: np.ndarray, part: int) -> np.ndarray:
        return (prints >> np.uint64(part * _PART_BITS) & np.uint64(0xFFFF)).astype(np.int64)

    def within(self, fingerprint: int) -> np.ndarray:
        """All items at RADIUS bits or fewer: in one part at least they differ in a quarter."""
        one = np.array([fingerprint], np.uint64)
        items = np.unique(np.concatenate(
            [block.near(int(self._part(one, part)[0])) for part, block in enumerate(self._blocks)]))
        return items[np.bitwise_count(self.prints[items] ^ one[0]) <= RADIUS]

    def shared(self, hashes: np.ndarray, offsets: np.ndarray) -> Iterator[tuple[int, int, np.ndarray]]:
        """(text, size, places) for every text and size of items with common shingles; the places where
        these start are in order. ``offsets`` are the borders of texts in the stream of words."""
        for width in self.widths:
            shingles = shingle_hashes(hashes, width)
            at = np.flatnonzero(self.seen[shingles >> np.uint64(64 - _SEEN_BITS)])
            first = np.searchsorted(self.known, shingles[at], side="left")
            times = np.searchsorted(self.known, shingles[at], side="right") - first
            text = np.searchsorted(offsets, at, side="right") - 1
            times[at + width > offsets[text + 1]] = 0  # words of two texts
            at, text, first = (np.repeat(x, times) for x in (at, text, first))
            size = self._sizes[first + np.arange(len(at)) - np.repeat(np.cumsum(times) - times, times)]
            own = np.flatnonzero(np.minimum(size, SHINGLE) == width)
            at, text, size = at[own], text[own], size[own]
            order = np.lexsort((at, size, text))
            at, text, size = at[order], text[order], size[order]
            borders = np.flatnonzero(np.r_[True, (text[1:] != text[:-1]) | (size[1:] != size[:-1]), True]) if len(at) else []
            for a, b in zip(borders, borders[1:]):
                yield int(text[a]), int(size[a]), at[a:b] - offsets[text[a]]

    @staticmethod
    def windows(places: np.ndarray, size: int, width: int, words: int) -> tuple[np.ndarray, int]:
        """Starts of the windows with enough shared shingles, and their number of words."""
        length = min(size, words)
        shingles = length - width + 1
        need = max(1, int(np.ceil((size - width + 1 + shingles) * SIMILARITY / (1 + SIMILARITY) - 1e-9)))
        if shingles < 1 or len(places) < need:
            return np.zeros(0, np.int64), length
        first, last = places[: len(places) - need + 1], places[need - 1 :]
        low, high = np.maximum(0, last - shingles + 1), np.minimum(first, words - length)
        fits = low <= high
        marks = np.zeros(words - length + 2, np.int64)
        np.add.at(marks, low[fits], 1)
        np.add.at(marks, high[fits] + 1, -1)
        return np.flatnonzero(np.cumsum(marks) > 0), length

    def matches(self, hashes: np.ndarray, size: int, places: np.ndarray,
                best: dict[int, tuple[float, int, int]]) -> None:
        """Take (similarity, first word, words) of the best window, the first of equal ones, into ``best``
        for every item of the size that the text has."""
        width = min(size, SHINGLE)
        starts, length = self.windows(places, size, width, len(hashes))
        parts = np.split(starts, np.flatnonzero(np.diff(starts) > 1) + 1)
        near: dict[int, np.ndarray] = {}
        for part in (p[i : i + _WINDOWS] for p in parts for i in range(0, len(p), _WINDOWS)):
            shingles = shingle_hashes(hashes[part[0] : part[-1] + length], width)
            bits = np.unpackbits(shingles.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little")
            sums = np.zeros((len(bits) + 1, 64), np.int32)
            np.cumsum(bits, axis=0, out=sums[1:], dtype=np.int32)
            many = length - width + 1
            votes = 2 * (sums[many:] - sums[:-many]) > many
            prints = np.packbits(votes, axis=1, bitorder="little").view(np.uint64).ravel()
            for k, fingerprint in enumerate(prints.tolist()):
                if fingerprint not in near:
                    near[fingerprint] = np.intersect1d(self.within(fingerprint), self._of_size[size])
                for item in near[fingerprint].tolist():
                    like = similarity(self.shingles[item], shingles[k : k + many])
                    if like >= SIMILARITY and like > best.get(item, (0.0,))[0]:
                        best[item] = (like, int(part[k]), length)

    def search(self, texts: pa.Array) -> list[dict[int, tuple[float, int, int]]]:
        """For each text the items it has, with their best windows."""
        dictionary, index, offsets = terms(texts)
        hashes = term_hashes(dictionary)[index] if len(index) else np.zeros(0, np.uint64)
        found: list[dict] = [{} for _ in range(len(texts))]
        for text, size, places in self.shared(hashes, offsets):
            self.matches(hashes[offsets[text] : offsets[text + 1]], size, places, found[text])
        return found


class Block:
    """Fingerprints by the value of one part of their bits."""

    def __init__(self, values: np.ndarray):
        self._order = np.argsort(values, kind="stable")
        self._values, first = np.unique(values[self._order], return_index=True)
        self._start = np.r_[first, len(values)]
        most = RADIUS // _PARTS
        self._near = np.array([sum(1 << b for b in chosen) for n in range(most + 1)
                               for chosen in combinations(range(_PART_BITS), n)], np.int64)
        self._most = most

    def near(self, value: int) -> np.ndarray:
        """Fingerprints whose part differs in a quarter of the radius: by their values, or by all values
        that are so near, whichever are fewer."""
        if len(self._values) <= len(self._near):
            hit = np.flatnonzero(np.bitwise_count(self._values ^ value) <= self._most)
        else:
            wanted = self._near ^ value
            hit = np.searchsorted(self._values, wanted)
            hit = hit[self._values[np.minimum(hit, len(self._values) - 1)] == wanted]
        none = np.zeros(0, np.int64)
        return np.concatenate([none, *(self._order[self._start[i] : self._start[i + 1]] for i in hit)])


def with_matches(docs: DataFrame, benchmark: DataFrame, text: str = "text", item_id: str = "item_id",
                 item_text: str = "text", name: str = "matches") -> DataFrame:
    """``docs`` with an array of (item_id, similarity, first_word, words), one per item found.

    Row by row over whole texts, without a shuffle. Null, empty and wordless texts match nothing, nor
    do such items; repeated items are reported as often as they occur, equal texts alike. An item of
    fewer than SHINGLE words is one shingle. An empty benchmark leaves the array empty.
    """
    kind = benchmark.schema[item_id].dataType
    source = benchmark.select(F.col(f"`{item_id}`").alias("id"), F.col(f"`{item_text}`").alias("text"))
    total = source.agg(F.count("*").alias("n"), F.coalesce(F.sum(F.octet_length("text")), F.lit(0)).alias("bytes")).first()
    passes = max(1, -(-total["n"] // ITEMS_A_PASS), -(-total["bytes"] // BYTES_A_PASS))
    ddl = f"array<struct<item_id: {kind.simpleString()}, similarity: double, first_word: int, words: int>>"
    arrow = pa.list_(pa.struct([("item_id", to_arrow_type(kind)), ("similarity", pa.float64()),
                                ("first_word", pa.int32()), ("words", pa.int32())]))

    def search(rows: list) -> Column:
        items = Items([r["id"] for r in rows], [r["text"] for r in rows])

        @F.arrow_udf(ddl)
        def find(texts: pa.Array) -> pa.Array:
            out = [
                [{"item_id": items.ids[i], "similarity": m[0], "first_word": m[1], "words": m[2]}
                 for i, m in sorted(found.items())]
                for found in items.search(texts)
            ]
            made = pa.array(out, arrow)
            give_back()
            return made

        return find(F.col(f"`{text}`"))

    part = F.pmod(F.xxhash64("id"), F.lit(passes))
    found = [search(source.where(part == i).orderBy("id", "text").collect()) for i in range(passes)]
    return docs.withColumn(name, F.concat(*found))


def contaminated(docs: DataFrame, benchmark: DataFrame, doc_id: str = "doc_id",
                 text: str = "text") -> DataFrame:
    """One row (id, item_id, similarity, first_word, words) per document and item found in it."""
    narrow = docs.select(F.col(f"`{doc_id}`"), F.col(f"`{text}`").alias("text_"))
    [found] = fresh(narrow, "found")
    matched = with_matches(narrow, benchmark, "text_", name=found)
    return matched.select(f"`{doc_id}`", F.inline(found))
