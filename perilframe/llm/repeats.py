"""Exact substring dedup over a suffix array with a common-prefix interval tree.

A byte is removed if a string of ``LENGTH`` bytes around it starts anywhere else as well. The suffix
array is sampled and partitioned: of the grams in each window of ``LENGTH`` bytes the one with the
smallest hash is the window's anchor, so equal windows have equal anchors at the same place. Suffixes
at anchors that share their gram form one partition of the suffix array, sorted by Spark; a stack
scan over the common prefixes of neighbours yields the tree of intervals, and the bytes before the
anchors, sorted as well, say how far each interval's members agree to the left. All occurrences of a
maximal repeat are found, not only neighbours. Equal texts are collapsed first.

No task holds a group of unbounded size. Occurrences of an anchor with equal surroundings are met
first, a frequent anchor's in several tasks, and one of each task stays. A group that is still large
is halved by where in a window the anchor stands, as the windows of a half share more bytes around
it. Cut to those windows, surroundings become equal again and are met again. The last halves hold one
window, so its occurrences are all equal.
"""

from __future__ import annotations

import hashlib
import struct
from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from perilframe.llm.common import runs, staged, text_bytes

#: Bytes of a repeated string; bytes of a gram, whose windows hold LENGTH - GRAM + 1 of them.
LENGTH, GRAM = 200, 64
#: Members of a group that one task sorts (half a MB with their bytes); larger groups are split first.
HOT = 2000
#: Tasks that occurrences with equal surroundings are dealt to.
SALTS = 16
#: Texts and their pieces are staged several times over, so they are packed tighter than by default.
CODEC = "zstd"
_CHUNK = 1 << 19
_PLACE = (1 << 20) - 1
_BASE = 0x9E3779B97F4A7C15 | 1


def _powers(base: int, n: int) -> np.ndarray:
    out = np.full(n, np.uint64(base), np.uint64)
    out[0] = 1
    return np.multiply.accumulate(out)


class _Grams:
    """Hashes of all grams of a buffer of bytes, as differences of running sums."""

    def __init__(self, n: int):
        self._up = _powers(_BASE, n)
        self._down = _powers(pow(_BASE, -1, 1 << 64), n)

    def hashes(self, data: np.ndarray) -> np.ndarray:
        sums = np.zeros(len(data) + 1, np.uint64)
        np.cumsum((data.astype(np.uint64) + np.uint64(1)) * self._up[: len(data)], out=sums[1:])
        h = (sums[GRAM:] - sums[:-GRAM]) * self._down[: len(data) - GRAM + 1]
        h ^= h >> np.uint64(31)
        h *= np.uint64(0xBF58476D1CE4E5B9)
        return h ^ (h >> np.uint64(29))


def _window_minima(keys: np.ndarray, width: int) -> np.ndarray:
    """Smallest of each run of ``width`` keys, by minima from both ends of blocks."""
    n = len(keys) - width + 1
    padded = np.full(-(-len(keys) // width) * width, np.iinfo(np.uint64).max, np.uint64)
    padded[: len(keys)] = keys
    blocks = padded.reshape(-1, width)
    ahead = np.minimum.accumulate(blocks, axis=1).ravel()
    behind = np.minimum.accumulate(blocks[:, ::-1], axis=1)[:, ::-1].ravel()
    return np.minimum(behind[:n], ahead[width - 1 : width - 1 + n])


def anchors(texts: list[bytes]) -> tuple[np.ndarray, ...]:
    """(text, place, hash, low, high) of every anchor: it is that of the windows which start from
    ``high`` to ``low`` bytes before it."""
    buffer = np.frombuffer(b"".join(texts), np.uint8)
    offsets = np.r_[0, np.cumsum([len(t) for t in texts])]
    grams = _Grams(_CHUNK + LENGTH)
    starts, places, hashes = [], [], []
    for at in range(0, max(0, len(buffer) - LENGTH + 1), _CHUNK):
        data = buffer[at : at + _CHUNK + LENGTH - 1]
        if len(data) < LENGTH:
            break
        h = grams.hashes(data)
        keys = h & ~np.uint64(_PLACE) | np.arange(len(h), dtype=np.uint64)
        place = (_window_minima(keys, LENGTH - GRAM + 1) & np.uint64(_PLACE)).astype(np.int64)
        start = np.arange(len(place))
        text = np.searchsorted(offsets, at + start, side="right") - 1
        inside = at + start + LENGTH <= offsets[text + 1]
        start, place = start[inside], place[inside]
        if len(start):
            new = np.flatnonzero(np.r_[True, (place[1:] != place[:-1]) | (start[1:] != start[:-1] + 1)])
            last = np.r_[new[1:], len(start)] - 1
            starts.append(np.stack([at + start[new], at + start[last]]))
            places.append(at + place[new])
            hashes.append(h[place[new]])
    if not starts:
        none = np.zeros(0, np.int64)
        return none, none, none, none, none
    first, last = np.concatenate(starts, axis=1)
    place, h = np.concatenate(places), np.concatenate(hashes)
    # An anchor may come twice in a row where two chunks of a text meet.
    new = np.flatnonzero(np.r_[True, place[1:] != place[:-1]])
    first, last = first[new], last[np.r_[new[1:], len(place)] - 1]
    place, h = place[new], h[new]
    text = np.searchsorted(offsets, place, side="right") - 1
    return text, place - offsets[text], h.view(np.int64), place - last, place - first


def _anchor_rows(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    names = ["tid", "place", "hash", "low", "high"]
    for batch in batches:
        text, *rest = anchors(text_bytes(batch.column(1)))
        yield pa.RecordBatch.from_arrays([batch.column(0).take(pa.array(text)), *map(pa.array, rest)], names)


def _contexts(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Of each anchor the bytes before it, reversed, and its suffix, as far as its windows go."""
    for batch in batches:
        for tid, text, found in zip(batch.column(0).to_pylist(), text_bytes(batch.column(1)), batch.column(2)):
            rows = found.values.flatten()
            place, h, low, high = (r.to_numpy().tolist() for r in rows[:4])
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array(h, pa.int64()), pa.array([tid] * len(h), pa.int64()), pa.array(place, pa.int64()),
                    pa.array([text[p - x : p][::-1] for p, x in zip(place, high)], pa.binary()),
                    pa.array([text[p : p + LENGTH - x] for p, x in zip(place, low)], pa.binary()),
                    rows[4],
                ],
                ["hash", "tid", "place", "left", "right", "often"],
            )


_MET = ("hash long, lo int, hi int, tid long, place long, left binary, right binary, "
        "start long, stop long")


def _met(rows: pa.Table, same: np.ndarray, many: np.ndarray) -> pa.RecordBatch:
    """Rows with the span that their equals cover; of equal rows the first keeps its surroundings."""
    place = rows["place"].to_numpy()
    start = place - pc.binary_length(rows["left"]).to_numpy()
    stop = place + pc.binary_length(rows["right"]).to_numpy()
    first = pa.array(np.arange(len(same)), mask=same)
    columns = [rows[c] for c in ("hash", "lo", "hi", "tid", "place")]
    columns += [rows[c].take(first) for c in ("left", "right")]
    columns += [pa.array(x, pa.int64(), mask=~many) for x in (start, stop)]
    names = [c.split()[0] for c in _MET.split(", ")]
    return pa.table(columns, names).combine_chunks().to_batches()[0]


def _collapse(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Meets equal rows that stand together, compared byte by byte; only the last row is held back."""
    held: pa.Table | None = None
    held_same = False
    for batch in batches:
        if not batch.num_rows:
            continue
        rows = pa.Table.from_batches([batch])
        if held is not None:
            rows = pa.concat_tables([held, rows]).combine_chunks()
        n = rows.num_rows
        same = np.zeros(n + 1, bool)
        same[0] = held_same
        equal = np.ones(n - 1, bool)
        for name in ("hash", "left", "right"):
            column = rows[name]
            equal &= pc.equal(column.slice(1), column.slice(0, n - 1)).to_numpy(zero_copy_only=False)
        same[1:n] = equal
        if n > 1:
            yield _met(rows.slice(0, n - 1), same[: n - 1], same[: n - 1] | same[1:n])
        held, held_same = rows.take([n - 1]), bool(same[n - 1])
    if held is not None:
        yield _met(held, np.array([held_same]), np.array([held_same]))


def _halves(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Each row once for either half of the places that the anchor may have in a window, with the
    surroundings those windows reach; the new key is what all windows of a half share."""
    names = ["hash", "lo", "hi", "tid", "place", "left", "right"]
    types = [pa.int64(), pa.int32(), pa.int32(), pa.int64(), pa.int64(), pa.binary(), pa.binary()]
    for batch in batches:
        out = []
        for h, lo, hi, tid, place, left, right in zip(*(batch.column(c).to_pylist() for c in names)):
            middle = (lo + hi) // 2
            for a, b in ((lo, middle), (middle + 1, hi)):
                if max(a, LENGTH - len(right)) <= min(b, len(left)):
                    shared = struct.pack("<qii", h, a, b) + left[:a] + right[: LENGTH - b]
                    key = xxhash.xxh3_64_intdigest(shared) - (1 << 63)
                    out.append((key, a, b, tid, place, left[:b], right[: LENGTH - a]))
        columns = list(zip(*out)) or [()] * len(names)
        yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, types)], names)


def _common(rows: pa.Array, width: int) -> tuple[np.ndarray, np.ndarray]:
    """Common prefix of each row with the one before (the first has 0), and all lengths."""
    values = rows.to_pylist()
    lengths = np.fromiter(map(len, values), np.int64, len(values))
    padded = np.frombuffer(b"".join(x.ljust(width, b"\0") for x in values), np.uint8)
    padded = padded.reshape(-1, width)
    differ = padded[1:] != padded[:-1]
    first = np.where(differ.any(axis=1), differ.argmax(axis=1), width)
    return np.r_[0, np.minimum(first, np.minimum(lengths[1:], lengths[:-1]))], lengths


def lcp_intervals(common: np.ndarray) -> Iterator[tuple[int, int, int]]:
    """(value, first, last) of every interval of the tree over a suffix array, innermost first;
    ``common[i]`` is the common prefix of suffixes i - 1 and i."""
    stack = [(0, 0)]
    values = common.tolist()
    for i in range(1, len(values) + 1):
        value = values[i] if i < len(values) else -1
        left = i - 1
        while stack and stack[-1][0] > value:
            top, left = stack.pop()
            if i - 1 > left:
                yield top, left, i - 1
        if value >= 0 and (not stack or stack[-1][0] < value):
            stack.append((value, left))


def _cover(common: np.ndarray, lefts: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
    """How far to the left and right of each anchor of one group the repeated strings around it
    reach; 0 where there is none. The suffixes are in order; ``common`` are their common prefixes."""
    n = len(common)
    to_left, to_right = np.zeros(n, np.int64), np.zeros(n, np.int64)
    order = sorted(range(n), key=lefts.__getitem__)
    rank = np.empty(n, np.int64)
    rank[order] = np.arange(n)
    left_common, _ = _common(pa.array([lefts[i] for i in order], pa.binary()), LENGTH - GRAM + 1)
    shortest = min(map(len, lefts))
    done: tuple[int, int] | None = None
    for value, first, last in lcp_intervals(common):
        here = rank[first : last + 1]
        by_left = np.argsort(here)
        sorted_ranks = here[by_left]
        between = np.minimum.reduceat(left_common[: sorted_ranks[-1] + 1], sorted_ranks[:-1] + 1)
        if between.min() == shortest and done == (first, last):
            continue  # no diversity to the left: an inner interval of the same members said it all
        best = np.empty(len(here), np.int64)
        best[by_left] = np.maximum(np.r_[0, between], np.r_[between, 0])
        long = np.flatnonzero(best + value >= LENGTH)
        at = first + long
        to_left[at] = np.maximum(to_left[at], best[long])
        to_right[at] = np.maximum(to_right[at], value)
        done = (first, last)
    return to_left, to_right


def _repeats(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for table, starts in runs(batches, ["hash"]):
        right = table["right"].combine_chunks()
        left = table["left"].combine_chunks()
        common, _ = _common(right, LENGTH)
        left_common, _ = _common(left, LENGTH - GRAM + 1)
        size = np.diff(starts)
        to_left, to_right = np.zeros(len(common), np.int64), np.zeros(len(common), np.int64)
        two = starts[:-1][size == 2] + 1
        two = two[left_common[two] + common[two] >= LENGTH]
        for at in (two - 1, two):
            to_left[at], to_right[at] = left_common[two], common[two]
        for a, n in zip(starts[:-1][size > 2], size[size > 2]):
            own = common[a : a + n].copy()
            own[0] = 0
            to_left[a : a + n], to_right[a : a + n] = _cover(own, left.slice(a, n).to_pylist())
        found = np.flatnonzero(to_right)
        place = table["place"].to_numpy()[found]
        yield pa.RecordBatch.from_arrays(
            [table["tid"].to_numpy()[found], place - to_left[found], place + to_right[found]], ["tid", "start", "stop"]
        )


def merged(spans: list[tuple[int, int]]) -> list[tuple[int, int]]:
    out: list[list[int]] = []
    for start, stop in sorted(spans):
        if out and start <= out[-1][1]:
            out[-1][1] = max(out[-1][1], stop)
        else:
            out.append([start, stop])
    return [(a, b) for a, b in out]


def _cut(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        rows = zip(batch.column(0).to_pylist(), text_bytes(batch.column(1)), batch.column(2).to_pylist())
        out: dict[str, list] = {"digest": [], "removed": [], "kept_sha256": []}
        for digest, text, found in rows:
            spans = merged([(s["start"], s["stop"]) for s in found])
            kept, at = hashlib.sha256(), 0
            for start, stop in [*spans, (len(text), 0)]:
                kept.update(text[at:start])
                at = stop
            out["digest"].append(digest)
            out["removed"].append([{"start": a, "stop": b} for a, b in spans])
            out["kept_sha256"].append(kept.hexdigest())
        span = pa.struct([("start", pa.int64()), ("stop", pa.int64())])
        yield pa.RecordBatch.from_arrays(
            [pa.array(out["digest"], pa.binary()), pa.array(out["removed"], pa.list_(span)), pa.array(out["kept_sha256"])],
            list(out))


def _gathered(found: DataFrame, columns: str) -> DataFrame:
    """Rows by text; a text's rows are bounded by its length."""
    return found.groupBy("tid").agg(F.collect_list(F.struct(*columns.split())).alias("found"))


def _tree(contexts: DataFrame) -> DataFrame:
    """Spans around anchors whose group fits a task."""
    return (
        contexts.repartition("hash").sortWithinPartitions("hash", "right")
        .select("hash", "tid", "place", "left", "right")
        .mapInArrow(_repeats, "tid long, start long, stop long")
    )


def _covers(contexts: DataFrame) -> DataFrame:
    """Spans around anchors that are part of a repeated string, by at most eight halvings."""
    salt = F.pmod(F.hash("tid", "place"), F.lit(SALTS))
    dealt = F.when(F.col("often"), salt).otherwise(0)
    rows = contexts.withColumns({"lo": F.lit(0), "hi": F.lit(LENGTH - GRAM)})
    covers = None
    while True:
        met = staged(
            rows.withColumns({"same": F.xxhash64("hash", "left", "right"), "salt": dealt})
            .repartition("same", "salt").sortWithinPartitions("same")
            .select("hash", "lo", "hi", "tid", "place", "left", "right")
            .mapInArrow(_collapse, _MET),
            CODEC,
        )
        spans = met.where("start is not null").select("tid", "start", "stop")
        covers = spans if covers is None else covers.union(spans)
        left = met.where("left is not null").drop("start", "stop")
        large = staged(
            left.where("lo < hi").groupBy("hash").agg(F.count("*").alias("members"))
            .where(F.col("members") > HOT).select("hash"))
        if large.isEmpty():
            return covers.union(_tree(left))
        # Large keys are few, and each meets its members in SALTS parts.
        large = large.select("hash", F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1))).alias("salt"),
                             F.lit(True).alias("large"))
        marked = staged(left.withColumn("salt", salt).join(large, ["hash", "salt"], "left"), CODEC)
        covers = covers.union(_tree(marked.where("large is null")))
        rows = marked.where("large").select("hash", "lo", "hi", "tid", "place", "left", "right").mapInArrow(
            _halves, "hash long, lo int, hi int, tid long, place long, left binary, right binary"
        ).withColumn("often", F.lit(True))


def removals(docs: DataFrame, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """id, n_bytes, ``removed`` (spans in bytes, ends exclusive) and ``kept_sha256`` of what is left.

    Null text is empty; texts shorter than LENGTH lose nothing. Equal texts of LENGTH bytes or more
    lose everything, as do repeated rows; null ids get one row each; other columns are ignored.
    """
    body = F.coalesce(F.col(f"`{text}`"), F.lit("")).cast("binary")
    narrow = docs.select(F.col(f"`{doc_id}`").alias("id"), body.alias("text"))
    digest = F.unhex(F.sha2("text", 256))
    keys = staged(narrow.select("id", digest.alias("digest"), F.octet_length("text").cast("long").alias("n_bytes")))
    distinct = (
        narrow.where(F.octet_length("text") >= LENGTH)
        .groupBy(digest.alias("digest"))
        .agg(F.first("text").alias("text"), F.count("*").alias("n"))
    )
    texts = staged(distinct.withColumn("tid", F.monotonically_increasing_id()), CODEC)
    found = staged(texts.select("tid", "text").mapInArrow(
        _anchor_rows, "tid long, place long, hash long, low long, high long"), CODEC)
    counts = found.groupBy("hash").agg(F.count("*").alias("times")).where("times > 1")
    shared = staged(found.join(counts, "hash").withColumn("often", F.col("times") > HOT).drop("times"), CODEC)
    contexts = (
        texts.join(_gathered(shared, "place hash low high often"), "tid").select("tid", "text", "found")
        .mapInArrow(_contexts, "hash long, tid long, place long, left binary, right binary, often boolean")
    )
    covers = staged(_covers(contexts))
    cut = (
        texts.where("n = 1").join(_gathered(covers, "start stop"), "tid").select("digest", "text", "found")
        .mapInArrow(_cut, "digest binary, removed array<struct<start: long, stop: long>>, kept_sha256 string")
    )
    # A text that comes again is covered whole, whatever else is found in it.
    copies = texts.where("n > 1").select(
        "digest",
        F.array(F.struct(F.lit(0).cast("long").alias("start"), F.octet_length("text").cast("long").alias("stop"))
                ).alias("removed"),
        F.sha2(F.lit("").cast("binary"), 256).alias("kept_sha256"))
    return keys.join(cut.union(copies), "digest", "left").select(
        F.col("id").alias(doc_id), "n_bytes",
        F.coalesce("removed", F.array().cast("array<struct<start: bigint, stop: bigint>>")).alias("removed"),
        F.coalesce("kept_sha256", F.lower(F.hex("digest"))).alias("kept_sha256"),
    )
