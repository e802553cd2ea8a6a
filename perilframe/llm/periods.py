"""Runs of periodic words, found on a harmonic grid with longest common extensions.

Words are numbers in one array, each text closed by a number of its own. Only the suffixes at a
difference cover are sorted: for any two places there is a shift, smaller than the cover's modulus,
after which both stand on sampled places. A common extension compares at most that many words and then
asks a sparse table for the least common prefix between two ranks. A run of period q covers two
neighbouring multiples of q, so testing i and i + q for every multiple of every q finds all runs with
n log n pairs; pairs whose words differ end at once. Texts are independent: nothing is shuffled.
"""

from __future__ import annotations

import hashlib
import zlib
from collections.abc import Callable, Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_type

from perilframe.llm.common import text_bytes

#: Words that a run has at least.
LEAST = 12
#: Perfect difference set: every number below the modulus is a difference of two of its members.
MODULUS, COVER = 13, (0, 1, 3, 9)
#: Words of short texts that are searched together, and pairs that are tested at a time.
BATCH, PAIRS = 1 << 16, 1 << 18


def _shifts() -> np.ndarray:
    """[i mod m, j mod m] -> the least shift that brings both onto the cover."""
    on = np.isin(np.arange(2 * MODULUS) % MODULUS, COVER)
    out = np.zeros((MODULUS, MODULUS), np.int64)
    for i in range(MODULUS):
        for j in range(MODULUS):
            out[i, j] = next(d for d in range(MODULUS) if on[i + d] and on[j + d])
    return out


_SHIFT = _shifts()


class Extensions:
    """Longest common extension to the right of any two places of an array of numbers.

    Two different places never agree up to the array's end: the caller closes it with numbers that
    occur once.
    """

    def __init__(self, words: np.ndarray):
        n = len(words)
        self._words = np.r_[words, np.full(2 * MODULUS, -1)]
        sampled = np.add.outer(np.arange(0, n, MODULUS), np.array(COVER)).ravel()
        self._places = sampled[sampled < n]
        self._number = np.full(MODULUS, -1)
        self._number[list(COVER)] = np.arange(len(COVER))
        levels = self._sorted(n)
        self._rank = levels[-1]
        order = np.empty(len(self._places), np.int64)
        order[self._rank] = np.arange(len(order))
        self._table = self._minima(self._neighbours(levels, order))

    def _index(self, places: np.ndarray) -> np.ndarray:
        return places // MODULUS * len(COVER) + self._number[places % MODULUS]

    def _sorted(self, n: int) -> list[np.ndarray]:
        """Ranks of the sampled suffixes by their first m, 2m, 4m .. words, until all differ."""
        bits = max(1, int(self._words.max() + 1).bit_length())
        rank = np.zeros(len(self._places), np.int64)
        room = 62 - int(len(self._places)).bit_length()
        per = max(1, room // bits)
        for at in range(0, MODULUS, per):
            key = rank
            for k in range(at, min(at + per, MODULUS)):
                key = key << bits | self._words[self._places + k] + 1
            rank = np.unique(key, return_inverse=True)[1]
        levels, width = [rank], MODULUS
        while len(rank) and rank.max() + 1 < len(rank):
            ahead = self._places + width
            inside = ahead < n
            follow = np.zeros(len(rank), np.int64)
            index = self._index(ahead[inside])
            follow[inside] = rank[index] + 1
            rank = np.unique(rank * (len(rank) + 1) + follow, return_inverse=True)[1]
            levels.append(rank)
            width *= 2
        return levels

    def _neighbours(self, levels: list[np.ndarray], order: np.ndarray) -> np.ndarray:
        """Common prefix of each sampled suffix with the one before it in the order."""
        a, b = self._places[order[:-1]].copy(), self._places[order[1:]].copy()
        common = np.zeros(len(a), np.int64)
        for k in range(len(levels) - 1, -1, -1):
            same = np.flatnonzero(levels[k][self._index(a)] == levels[k][self._index(b)])
            for x in (a, b, common):
                x[same] += MODULUS << k
        left = np.arange(len(a))
        for _ in range(MODULUS):
            left = left[self._words[a[left]] == self._words[b[left]]]
            for x in (a, b, common):
                x[left] += 1
        return np.r_[0, common].astype(np.int32)

    @staticmethod
    def _minima(common: np.ndarray) -> list[np.ndarray]:
        """Level k holds the least of 2**k neighbours from each place on."""
        table = [common]
        while 2 << (len(table) - 1) <= len(common):
            last, half = table[-1], 1 << (len(table) - 1)
            table.append(np.minimum(last[:-half], last[half:]))
        return table

    def _least(self, first: np.ndarray, last: np.ndarray) -> np.ndarray:
        level = np.frexp((last - first + 1).astype(np.float64))[1] - 1
        out = np.empty(len(first), np.int64)
        for k in np.unique(level):
            at = np.flatnonzero(level == k)
            row = self._table[k]
            out[at] = np.minimum(row[first[at]], row[last[at] + 1 - (1 << k)])
        return out

    def common(self, a: np.ndarray, b: np.ndarray) -> np.ndarray:
        """Words that agree from a and b on, for arrays of different places."""
        shift = _SHIFT[a % MODULUS, b % MODULUS]
        out = np.zeros(len(a), np.int64)
        left = np.arange(len(a))
        for _ in range(MODULUS):
            left = left[out[left] < shift[left]]
            left = left[self._words[a[left] + out[left]] == self._words[b[left] + out[left]]]
            out[left] += 1
        met = np.flatnonzero(out == shift)
        x, y = self._rank[self._index(a[met] + shift[met])], self._rank[self._index(b[met] + shift[met])]
        out[met] += self._least(np.minimum(x, y) + 1, np.maximum(x, y))
        return out


class _Grid:
    """Pairs (i, i + q) of neighbouring multiples of every q, by their second place."""

    def __init__(self, kept: int = 1 << 14):
        self._kept = self._between(1, kept)
        self._to = kept

    @staticmethod
    def _between(first: int, stop: int) -> tuple[np.ndarray, np.ndarray]:
        """All (second place, q) with the second place in [first, stop)."""
        q = np.arange(1, stop)
        least = -(-first // q) * q
        times = np.maximum(0, -(-(stop - least) // q))
        period = np.repeat(q, times)
        nth = np.arange(len(period)) - np.repeat(np.cumsum(times) - times, times)
        second = np.repeat(least, times) + nth * period
        order = np.argsort(second, kind="stable")
        return second[order].astype(np.int32), period[order].astype(np.int32)

    def pairs(self, n: int) -> Iterator[tuple[np.ndarray, np.ndarray]]:
        """(i, j) for a text of n words, in parts of a bounded size."""
        second, period = self._kept
        cut = int(np.searchsorted(second, n))
        for at in range(0, cut, PAIRS):
            part = slice(at, min(at + PAIRS, cut))
            yield second[part] - period[part], second[part]
        step = max(1, PAIRS // max(1, n.bit_length()))
        for at in range(self._to, n, step):
            second, period = self._between(at, min(at + step, n))
            wanted = period <= n // 2
            yield second[wanted] - period[wanted], second[wanted]


def _candidates(words: np.ndarray, sizes: list[int], starts: list[int], grid: _Grid) -> Iterator[tuple]:
    """Pairs with equal words, in parts, as places of the whole array."""
    held, size = [], 0
    for n, start in zip(sizes, starts):
        for i, j in grid.pairs(n):
            hit = np.flatnonzero(words[start + i] == words[start + j])
            held.append((start + i[hit].astype(np.int64), start + j[hit].astype(np.int64)))
            size += len(hit)
            if size >= PAIRS:
                yield tuple(np.concatenate(x) for x in zip(*held))
                held, size = [], 0
    if size:
        yield tuple(np.concatenate(x) for x in zip(*held))


def runs_of(texts: list[np.ndarray], least: int = LEAST, grid: _Grid | None = None) -> list[np.ndarray]:
    """Rows (start, length, period) of every text's runs by start, then period; a text is an array of
    word numbers from 0 on. A run is not extended by a neighbour, has its smallest period q and at
    least ``least`` and 2q words."""
    grid = grid or _Grid()
    sizes = [len(t) for t in texts]
    most = max((int(t.max()) for t in texts if len(t)), default=0)
    parts = [x for k, t in enumerate(texts) for x in (t, [most + 1 + k])]
    words = np.concatenate(parts).astype(np.int64) if parts else np.zeros(0, np.int64)
    starts = [0, *np.cumsum([n + 1 for n in sizes]).tolist()]
    total, found = len(words), np.zeros((0, 3), np.int64)
    ahead = behind = None
    for a, b in _candidates(words, sizes, starts, grid):
        if ahead is None:
            # Places before the first text count as a text of their own in the other direction.
            ahead = Extensions(words)
            behind = Extensions(np.r_[words[:-1][::-1], most + 1 + len(sizes)])
        period = b - a
        right = ahead.common(a, b)
        left = behind.common(total - 1 - a, total - 1 - b)  # the words before a and b
        length = period + left + right
        good = length >= np.maximum(least, 2 * period)
        rows = np.stack([a - left, length, period], axis=1)[good]
        found = _smallest(np.concatenate([found, rows]))
    text = np.searchsorted(starts, found[:, 0], side="right") - 1
    cut = np.searchsorted(text, np.arange(len(texts) + 1))
    return [found[x:y] - [start, 0, 0] for x, y, start in zip(cut, cut[1:], starts)]


def _smallest(rows: np.ndarray) -> np.ndarray:
    """Of rows with the same start and length that with the smallest period; by start, then period."""
    rows = rows[np.lexsort((rows[:, 2], rows[:, 1], rows[:, 0]))]
    new = np.ones(len(rows), bool)
    new[1:] = (rows[1:, :2] != rows[:-1, :2]).any(axis=1)
    rows = rows[new]
    return rows[np.lexsort((rows[:, 2], rows[:, 0]))]


def covered(runs: np.ndarray, n: int) -> np.ndarray:
    """Which of n words a run holds after its first period."""
    steps = np.zeros(n + 1, np.int64)
    np.add.at(steps, runs[:, 0] + runs[:, 2], 1)
    np.add.at(steps, runs[:, 0] + runs[:, 1], -1)
    return np.cumsum(steps[:n]) > 0


Order = Callable[[object, int], np.ndarray]


def echoed(doc_id: object, n: int) -> np.ndarray | None:
    """Places of the words of a text, a tenth of which repeat their end with a period, so that a
    corpus without runs exercises the search too. None leaves the words as they are, as does no id."""
    h = 1 if doc_id is None else zlib.crc32(str(doc_id).encode())
    if h % 10 or not n:
        return None
    g = h // 10
    first = g % n
    period = 1 + (n - first) // (3 + g % 8)
    return np.r_[np.arange(first), first + np.arange(n - first) % period]


def _searched(rows: list[tuple[object, list[bytes]]], least: int, grid: _Grid) -> list[tuple]:
    """(id, number of words, runs, kept words) of each row."""
    numbers: dict[bytes, int] = {}
    texts = [np.array([numbers.setdefault(w, len(numbers)) for w in words], np.int64) for _, words in rows]
    out = []
    for (key, words), found in zip(rows, runs_of(texts, least, grid)):
        n = len(words)
        if len(found):
            words = [w for w, gone in zip(words, covered(found, n).tolist()) if not gone]
        out.append((key, n, found, b" ".join(words)))
    return out


def collapse(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", least: int = LEAST,
             order: Order | None = None) -> DataFrame:
    """id, n_words, ``runs`` (start, length, period by start, then period) and ``collapsed``: the words
    that no run holds after its first period, joined by a space.

    Words are parted by ASCII blanks. Null, empty and blank texts have no words and no runs. Rows are
    searched one by one, so repeated rows, ties and null ids come out alike; other columns are ignored.
    ``order`` may rearrange the words of a row first: it is given the id and their number.
    """
    key = docs.select(F.col(f"`{doc_id}`")).schema[0]
    kind = to_arrow_type(key.dataType)
    run = pa.struct([("start", pa.int64()), ("length", pa.int64()), ("period", pa.int64())])
    schema = f"id {key.dataType.simpleString()}, n_words long, " \
             "runs array<struct<start: long, length: long, period: long>>, collapsed string"

    def batch(rows: list[tuple]) -> pa.RecordBatch:
        sizes = [len(r[2]) for r in rows]
        flat = np.concatenate([r[2] for r in rows])
        structs = pa.StructArray.from_arrays([pa.array(flat[:, k]) for k in range(3)], fields=list(run))
        offsets = pa.array(np.r_[0, np.cumsum(sizes)].astype(np.int32))
        return pa.RecordBatch.from_arrays(
            [pa.array([r[0] for r in rows], kind), pa.array([r[1] for r in rows], pa.int64()),
             pa.ListArray.from_arrays(offsets, structs),
             pa.array([r[3] for r in rows], pa.binary()).cast(pa.string())],
            ["id", "n_words", "runs", "collapsed"])

    def search(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        grid = _Grid()
        held, size = [], 0
        for part in batches:
            for row, body in zip(part.column(0).to_pylist(), text_bytes(part.column(1))):
                words = body.split()
                places = order(row, len(words)) if order else None
                if places is not None:
                    words = [words[i] for i in places.tolist()]
                held.append((row, words))
                size += len(words) + 1
                if size >= BATCH:
                    yield batch(_searched(held, least, grid))
                    held, size = [], 0
        if held:
            yield batch(_searched(held, least, grid))

    narrow = docs.select(F.col(f"`{doc_id}`"), F.col(f"`{text}`"))
    return narrow.mapInArrow(search, schema).withColumnRenamed("id", doc_id)


def _digests(runs: pa.Array) -> pa.Array:
    out = []
    for found in runs.to_pylist():
        lines = "".join(f"{r['start']},{r['length']},{r['period']}\n" for r in found or [])
        out.append(hashlib.sha256(lines.encode()).hexdigest())
    return pa.array(out, pa.string())


def runs_digest(runs: str = "runs") -> Column:
    """SHA-256 of a column of runs as lines of start, length and period."""
    return F.arrow_udf(_digests, "string")(runs)
