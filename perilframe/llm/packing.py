"""Packing documents into token sequences by order-preserving dynamic programming.

The documents of an input partition form one stream of tokens in their order. The stream is cut
into windows of at most ``capacity`` tokens at document or sentence ends, and inside long sentences at
every few tokens, minimising padding plus a penalty per cut. A window as long as a power of two needs no
padding. Each task packs its own partition in blocks of bounded size, so nothing is shuffled, and a
task that runs again gives the same sequences.
"""

from __future__ import annotations

import re
import zlib
from array import array
from collections import deque
from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from perilframe.llm.common import fresh, give_back

CAPACITY = 2048
#: The id after the last token of each document.
END_ID = 1
#: Cost of a window that ends inside a document, in padding tokens, and of one inside a sentence.
CUT_PENALTY, SENTENCE_PENALTY = 8, 32
#: A sentence of more than this part of the capacity may be cut inside, at every such token.
LONG_PART, STEP = 8, 16
#: Signs that end a sentence, where the vocabulary has them as one token.
ENDS = ".!?\u3002\uff01\uff1f\u061f\u0964\u06d4"
#: Tokens that are planned together.
BLOCK = 1 << 19
#: Words whose ids a task keeps before it starts anew, and bytes of texts that it tokenizes at a time.
CACHED_WORDS, BATCH = 250_000, 2 << 20

# Words made of these letters and a tail of these signs are split between the two by the
# vocabulary's own pattern, whatever surrounds them.
_PLAIN = re.compile("[a-zà-öø-ÿ]+")
_TAIL = ".,;:!?*%$#&|"


def _byte_letters() -> dict[int, str]:
    """Byte -> letter under which a byte-level vocabulary lists it."""
    shown = [*range(33, 127), *range(161, 173), *range(174, 256)]
    hidden = [b for b in range(256) if b not in shown]
    return {b: chr(b) for b in shown} | {b: chr(256 + i) for i, b in enumerate(hidden)}


class Ids:
    """Token ids of texts, each different word tokenized once."""

    def __init__(self, vocabulary: str):
        from tokenizers import Tokenizer

        self._tokenizer = Tokenizer.from_file(vocabulary)
        self._letters = {ord(chr(b)): c for b, c in _byte_letters().items()}
        self.forget()

    def forget(self) -> None:
        """Start anew, with the empty word in the first slot."""
        self._slot: dict[str, int] = {"": 0}
        self._starts, self._sizes, self._table = array("q", [0]), array("q", [0]), array("I")

    def word(self, word: str) -> list[int]:
        if _PLAIN.fullmatch(word):
            letters = word.encode().decode("latin-1").translate(self._letters)
            return [t.id for t in self._tokenizer.model.tokenize(letters)]
        return self._tokenizer.encode(word, add_special_tokens=False).ids

    def sentence_ends(self) -> np.ndarray:
        found = [self.word(s) for s in ENDS]
        return np.array([ids[0] for ids in found if len(ids) == 1], np.int64)

    def texts(self, texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """All ids, each text's followed by END_ID, and the number of ids per text."""
        texts = pc.fill_null(texts.cast(pa.large_string()), "")
        special = pc.match_substring(texts, "<|").to_numpy(zero_copy_only=False)
        if special.any():  # names of special tokens may hold or touch anything: whole texts
            whole = [
                [*self._tokenizer.encode(t, add_special_tokens=False).ids, END_ID]
                for t in texts.filter(pa.array(special)).to_pylist()
            ]
            flat, counts = self.texts(pc.if_else(pa.array(special), "", texts))
            at = np.r_[0, np.cumsum(counts)]
            parts, rest = [], iter(whole)
            for i, is_whole in enumerate(special):
                parts.append(np.array(next(rest), np.uint32) if is_whole else flat[at[i] : at[i + 1]])
            return np.concatenate(parts), np.array([len(p) for p in parts])
        split = pc.ascii_split_whitespace(texts)
        chunks = split.flatten().dictionary_encode()
        per_text = np.diff(split.offsets.to_numpy())
        if not len(chunks.dictionary):
            return np.full(len(texts), END_ID, np.uint32), np.ones(len(texts), np.int64)
        at = self._parts(chunks.dictionary)[chunks.indices.to_numpy()].ravel()
        starts, sizes, table = (np.array(x) for x in (self._starts, self._sizes, self._table))
        flat = _take_runs(table, starts[at], sizes[at])
        token_at = np.r_[0, np.cumsum(sizes[at])]
        ends = token_at[2 * np.cumsum(per_text)]
        return np.insert(flat, ends, END_ID), np.diff(np.r_[0, ends]) + 1

    def _parts(self, chunks: pa.Array) -> np.ndarray:
        """Two slots for each chunk of a text: a word in small letters and the signs behind it, where
        the vocabulary parts them whatever surrounds them, else the chunk itself and nothing."""
        core = pc.utf8_rtrim(chunks, _TAIL)
        plain = pc.match_substring_regex(core, "^[A-Za-zÀ-ÖØ-öø-ÿ]+$")  # one small letter for each
        lower = pc.utf8_lower(core)
        tail = pc.struct_field(pc.extract_regex(chunks, f"(?P<tail>[{_TAIL}]*)$"), "tail")
        first = pc.if_else(plain, lower, chunks).dictionary_encode()
        second = pc.if_else(plain, tail, "").dictionary_encode()
        if len(self._slot) >= CACHED_WORDS:
            self.forget()
        return np.stack([self._slots(x.dictionary.to_pylist())[x.indices.to_numpy()] for x in (first, second)], axis=1)

    def _slots(self, words: list[str]) -> np.ndarray:
        """Where the ids of each word stand in the table, which grows by new ones."""
        slots = list(map(self._slot.get, words))
        for i, slot in enumerate(slots):
            if slot is None:
                ids = self.word(words[i])
                slots[i] = self._slot[words[i]] = len(self._sizes)
                self._starts.append(len(self._table))
                self._sizes.append(len(ids))
                self._table.extend(ids)
        return np.array(slots, np.int64)


def _take_runs(table: np.ndarray, starts: np.ndarray, sizes: np.ndarray) -> np.ndarray:
    """The runs ``table[start:start + size]`` one after the other."""
    total = int(sizes.sum())
    shift = np.repeat(starts - (np.cumsum(sizes) - sizes), sizes)
    return table[np.arange(total) + shift]


def cut_points(ids: np.ndarray, doc_ends: np.ndarray, sentence_ends: np.ndarray,
               capacity: int = CAPACITY, penalty: float = CUT_PENALTY,
               sentence_penalty: float = SENTENCE_PENALTY) -> np.ndarray:
    """Ends of the windows over ``ids``; ``doc_ends`` are positions after each document.

    With f(j) the least cost of cutting the first j tokens, f(j) = min over allowed i of
    f(i) + padding(j - i) + penalty(j). Padding up to the capacity is capacity - j + i, so the
    smallest f(i) + i of the last ``capacity`` tokens is wanted: a queue kept in rising order.
    Windows of a power of two cost f(i) alone; their starts are looked up for all places at once.
    """
    total = len(ids)
    marks = np.union1d(np.flatnonzero(np.isin(ids, sentence_ends)) + 1, doc_ends)
    marks = np.union1d(marks, np.array([0, total]))
    long = np.flatnonzero(np.diff(marks) > max(1, capacity // LONG_PART))
    points = np.union1d(marks, np.concatenate([marks[:1], *(np.arange(marks[i], marks[i + 1], STEP) for i in long)]))
    price = np.where(np.isin(points, doc_ends), 0.0, np.where(np.isin(points, marks), penalty, sentence_penalty)).tolist()
    powers = [1 << k for k in range(capacity.bit_length()) if 1 << k <= capacity]
    ends, begins = [], []
    for size in powers:
        at = np.searchsorted(points, points - size)
        hit = np.flatnonzero(points[at] == points - size)
        ends.append(hit)
        begins.append(at[hit])
    ends, begins = np.concatenate(ends), np.concatenate(begins)
    order = np.argsort(ends, kind="stable")
    begins = begins[order].tolist()
    first = np.searchsorted(ends[order], np.arange(len(points) + 1)).tolist()
    points = points.tolist()
    cost, back = [0.0] * len(points), [0] * len(points)
    queue: deque[tuple[float, int]] = deque([(0.0, 0)])
    for j in range(1, len(points)):
        at = points[j]
        while points[queue[0][1]] < at - capacity:
            queue.popleft()
        value, i = queue[0]
        best = value + capacity - at
        for k in begins[first[j] : first[j + 1]]:
            if cost[k] < best:
                best, i = cost[k], k
        cost[j] = best + price[j]
        back[j] = i
        value = cost[j] + at
        while queue and queue[-1][0] >= value:
            queue.pop()
        queue.append((value, j))
    ends, j = [], len(points) - 1
    while j:
        ends.append(points[j])
        j = back[j]
    return np.array(ends[::-1], np.int64)


#: Output columns after the document's id.
PIECE = (
    "start long, length long, ids_crc32 long, doc_tokens long, sequence_id long, offset long"
)


class _Packer:
    """Packs the stream of one partition, block by block."""

    def __init__(self, ends: np.ndarray, capacity: int, penalty: float, with_ids: bool, first: int):
        self._ends, self._capacity, self._penalty = ends, capacity, penalty
        self._with_ids, self._sequence = with_ids, first

    def block(self, ids: np.ndarray, owners: np.ndarray, counts: np.ndarray, before: int,
              doc_tokens: np.ndarray) -> dict[str, list]:
        """Pieces of a block whose k-th part has ``counts[k]`` tokens of document ``owners[k]``;
        ``before`` tokens of the first one lie in earlier blocks."""
        doc_ends = np.cumsum(counts)
        doc_starts = doc_ends - counts
        windows = cut_points(ids, doc_ends, self._ends, self._capacity, self._penalty)
        borders = np.union1d(np.r_[0, windows], doc_starts)
        begin, end = borders, np.r_[borders[1:], len(ids)]
        begin, end = begin[begin < end], end[begin < end]
        doc = np.searchsorted(doc_ends, begin, side="right")
        window = np.searchsorted(windows, begin, side="right")
        window_start = np.r_[0, windows][window]
        start = begin - doc_starts[doc] + np.where(doc == 0, before, 0)
        data = ids.astype("<u4").tobytes()
        out = {
            "row": owners[doc], "start": start, "length": end - begin,
            "ids_crc32": [zlib.crc32(data[4 * a : 4 * b]) for a, b in zip(begin, end)],
            "doc_tokens": doc_tokens[doc], "sequence_id": self._sequence + window,
            "offset": begin - window_start,
        }
        if self._with_ids:
            out["ids"] = [ids[a:b] for a, b in zip(begin, end)]
        self._sequence += len(windows)
        return out


def pack(docs: DataFrame, vocabulary: str, doc_id: str = "doc_id", text: str = "text",
         capacity: int = CAPACITY, penalty: float = CUT_PENALTY, with_ids: bool = False) -> DataFrame:
    """One row per piece: id, start, length, ids_crc32, doc_tokens, sequence_id, offset, and the ids
    themselves on request.

    Null and empty texts are one END_ID each. Repeated rows are packed as often as they occur;
    a null id stays null. Sequence ids are unique, not dense: the upper bits are the partition's.
    Other columns are ignored. An empty table gives no piece.
    """
    [key] = fresh(docs.limit(0).select(), "doc")
    narrow = docs.select(F.col(f"`{doc_id}`").alias(key), F.col(f"`{text}`").alias("text"))
    kind = narrow.schema[key].dataType.simpleString()
    schema = f"{key} {kind}, {PIECE}" + (", ids array<long>" if with_ids else "")

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        ids_of = Ids(vocabulary)
        packer = _Packer(ids_of.sentence_ends(), capacity, penalty, with_ids,
                         TaskContext.get().partitionId() << 32)
        yield from _blocks(batches, ids_of, packer)

    return narrow.mapInArrow(run, schema).withColumnRenamed(key, doc_id)


def _blocks(batches: Iterable[pa.RecordBatch], ids_of: Ids, packer: _Packer) -> Iterator[pa.RecordBatch]:
    """Cut the stream into blocks; a document may go on in the next one."""
    keys, flat, counts, totals, before = [], [], [], [], 0
    size = 0

    def flush() -> pa.RecordBatch:
        owners = np.arange(len(counts))
        out = packer.block(np.concatenate(flat), owners, np.array(counts), before, np.array(totals))
        columns = {"doc": pa.concat_arrays(keys).take(pa.array(out.pop("row")))}
        ids = out.pop("ids", None)
        columns |= {k: pa.array(v, pa.int64()) for k, v in out.items()}
        if ids is not None:
            columns["ids"] = pa.array([x.astype(np.int64) for x in ids], pa.list_(pa.int64()))
        return pa.RecordBatch.from_pydict(columns)

    for batch in batches:
        for part in _portions(batch):
            ids, per_text = ids_of.texts(part.column(1))
            at = 0
            for row, n in enumerate(per_text.tolist()):
                done = 0
                while done < n:
                    take = min(n - done, BLOCK - size)
                    keys.append(part.column(0).slice(row, 1))
                    flat.append(ids[at + done : at + done + take])
                    counts.append(take)
                    totals.append(n)
                    size += take
                    done += take
                    if size == BLOCK:
                        yield flush()
                        keys, flat, counts, totals, size = [], [], [], [], 0
                        before = done if done < n else 0
                at += n
    if size:
        yield flush()
    ids_of.forget()
    give_back()


def _portions(batch: pa.RecordBatch) -> Iterator[pa.RecordBatch]:
    """The batch in parts whose texts have BATCH bytes, or one text more."""
    sizes = pc.fill_null(pc.binary_length(batch.column(1)), 0).to_numpy()
    ends = np.cumsum(sizes, dtype=np.int64)
    start = 0
    while start < batch.num_rows:
        before = int(ends[start - 1]) if start else 0
        stop = max(start + 1, int(np.searchsorted(ends, before + BATCH, side="right")))
        yield batch.slice(start, stop - start)
        start = stop
