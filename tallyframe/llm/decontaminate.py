"""Benchmark decontamination by FM-indexes over training shards.

Documents are read in shards of bounded bytes. A shard's words become numbers
of the benchmark's vocabulary; every stretch of other words becomes one
separator, since no benchmark window can reach across it, and stretches shorter
than the shortest window are left out for the same reason. The shard's index is
the Burrows-Wheeler transform of that sequence in a wavelet matrix, with the
positions of every eighth suffix of a stretch. All windows are searched backward
at once; their rows are located by walking to the next kept position; the words
they cover are merged into removal spans. The corpus is never shuffled.

The windows reach the tasks as a broadcast of bounded size: a larger benchmark
is cut into blocks, and the documents pass through one search after another
inside the same tasks.

Defined results: a null or wordless text has no words, is not hit and not
contaminated. Benchmark rows without words are ignored, a null ``item_id``
counts as the item ``null``, rows of equal ``item_id`` are one item. Each
document row is judged by itself, repeated or not. An empty benchmark hits
nothing. Kept input columns named like a result are replaced by it.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from itertools import repeat

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tallyframe.llm.common import add_columns, as_bytes, groups_of, received, ship, word_pieces

WINDOW = 13
SHARD_BYTES = 32 << 20
BLOCK_BYTES = 32 << 20
SAMPLE_STEP = 8

#: ASCII letters in lower case, digits and bytes of other characters; all else separates words.
_WORD_BYTES = bytes(
    b + 32 if 65 <= b <= 90 else b if 48 <= b <= 57 or 97 <= b <= 122 or b > 127 else 32 for b in range(256)
)

RESULT = (
    "n_words bigint, n_hit bigint, n_items bigint, items array<string>, items_sha256 string, "
    "removal_spans array<struct<start:bigint,end:bigint>>, contaminated boolean"
)
_SPANS = pa.list_(pa.struct([("start", pa.int64()), ("end", pa.int64())]))


def pieces_of(text: bytes) -> Iterator[list[bytes]]:
    """The words of a text, about a megabyte at a time."""
    return word_pieces(text, _WORD_BYTES)


class Bits:
    """A bit vector that counts the ones before a position."""

    def __init__(self, bits: np.ndarray):
        padded = np.zeros((len(bits) // 64 + 1) * 64, bool)
        padded[: len(bits)] = bits
        self.words = np.packbits(padded, bitorder="little").view(np.uint64)
        self.before = np.zeros(len(self.words) + 1, np.int64)
        np.cumsum(np.bitwise_count(self.words), out=self.before[1:])
        self.total = int(self.before[-1])

    def ones(self, i: np.ndarray) -> np.ndarray:
        word = i >> 6
        mask = (np.uint64(1) << (i & 63).astype(np.uint64)) - np.uint64(1)
        return self.before[word] + np.bitwise_count(self.words[word] & mask)

    def get(self, i: np.ndarray) -> np.ndarray:
        return ((self.words[i >> 6] >> (i & 63).astype(np.uint64)) & np.uint64(1)).astype(bool)


class WaveletMatrix:
    """Rank and access over numbers below ``symbols``, one bit vector per binary digit."""

    def __init__(self, values: np.ndarray, symbols: int):
        self.digits = max(1, int(symbols - 1).bit_length())
        self.levels: list[tuple[Bits, int]] = []
        for d in reversed(range(self.digits)):
            bit = (values >> d) & 1 == 1
            self.levels.append((Bits(bit), len(values) - int(bit.sum())))
            values = np.concatenate([values[~bit], values[bit]])
        every = np.arange(symbols, dtype=np.int64)
        self.start = self._down(every, np.zeros(symbols, np.int64))

    def _down(self, symbol: np.ndarray, i: np.ndarray) -> np.ndarray:
        for d, (bits, zeros) in zip(reversed(range(self.digits)), self.levels, strict=True):
            ones = bits.ones(i)
            i = np.where((symbol >> d) & 1 == 1, zeros + ones, i - ones)
        return i

    def rank(self, symbol: np.ndarray, i: np.ndarray) -> np.ndarray:
        """How often each symbol stands before its position."""
        return self._down(symbol, i) - self.start[symbol]

    def access(self, i: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """The symbol at each position and its rank there."""
        symbol = np.zeros(len(i), np.int64)
        for bits, zeros in self.levels:
            bit, ones = bits.get(i), bits.ones(i)
            symbol = symbol * 2 + bit
            i = np.where(bit, zeros + ones, i - ones)
        return symbol, i - self.start[symbol]


def suffix_array(values: np.ndarray) -> np.ndarray:
    """Suffixes in order. Zeros are separators: each is less than all words and than later zeros."""
    n, zero = len(values), values == 0
    rank = np.where(zero, np.cumsum(zero) - 1, values.astype(np.int64) + int(zero.sum()))
    step = 1
    while True:
        following = np.zeros(n, np.int64)
        following[: max(0, n - step)] = rank[step:] + 1
        key = rank * (int(rank.max()) + 2) + following
        order = np.argsort(key, kind="stable")
        changes = np.diff(key[order]) != 0
        rank = np.empty(n, np.int64)
        rank[order] = np.concatenate([[0], np.cumsum(changes)])
        if changes.all():
            return order
        step *= 2


class FmIndex:
    """An FM-index over word numbers, in which zeros end stretches; the last value must be 0."""

    def __init__(self, values: np.ndarray, symbols: int, step: int = SAMPLE_STEP):
        self.n, self.step = len(values), step
        order = suffix_array(values)
        self.bwt = WaveletMatrix(values[order - 1].astype(np.int64), symbols)
        counts = np.bincount(values, minlength=symbols)
        self.first = np.concatenate([[0], np.cumsum(counts)])[:symbols]
        begins = np.concatenate([[True], values[:-1] == 0])
        start = np.maximum.accumulate(np.where(begins, np.arange(self.n), 0))
        kept = ((np.arange(self.n) - start) % step == 0)[order]
        self.kept, self.positions = Bits(kept), order[kept]

    def search(self, phrases: np.ndarray, lengths: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """First and last row (exclusive) of each phrase; rows of ``phrases`` end in their words."""
        low, high = np.zeros(len(phrases), np.int64), np.full(len(phrases), self.n, np.int64)
        width = phrases.shape[1]
        for j in reversed(range(width)):
            live = np.flatnonzero((low < high) & (lengths >= width - j))
            symbol = phrases[live, j].astype(np.int64)
            low[live] = self.first[symbol] + self.bwt.rank(symbol, low[live])
            high[live] = self.first[symbol] + self.bwt.rank(symbol, high[live])
        return low, np.maximum(low, high)

    def locate(self, rows: np.ndarray) -> np.ndarray:
        """Positions of rows, walking back to the nearest kept one."""
        found, open_, walked = np.empty(len(rows), np.int64), np.arange(len(rows)), 0
        rows = rows.copy()
        while len(open_):
            done = self.kept.get(rows)
            found[open_[done]] = self.positions[self.kept.ones(rows[done])] + walked
            open_, rows = open_[~done], rows[~done]
            symbol, rank = self.bwt.access(rows)
            rows, walked = self.first[symbol] + rank, walked + 1
        return found


class Phrases:
    """Windows of a block of benchmark items, and the items that hold each window."""

    def __init__(self, items: list[tuple[str, bytes]], window: int = WINDOW):
        self.vocabulary: dict[bytes, int] = {}
        holders: dict[tuple[int, ...], set[str]] = {}
        for name, text in items:
            ids = [self.vocabulary.setdefault(w, len(self.vocabulary) + 1) for piece in pieces_of(text) for w in piece]
            for k in range(max(1, len(ids) - window + 1) if ids else 0):
                holders.setdefault(tuple(ids[k : k + window]), set()).add(name)
        self.holders = [sorted(names) for names in holders.values()]
        self.lengths = np.array([len(p) for p in holders], np.int64)
        self.shortest = int(self.lengths.min()) if holders else 0
        self.matrix = np.zeros((len(holders), window), np.int32)
        for row, phrase in zip(self.matrix, holders, strict=True):
            row[window - len(phrase) :] = phrase

    def ids(self, text: bytes) -> np.ndarray:
        """The number of each word, 0 for words of no item."""
        get = self.vocabulary.get
        parts = [np.fromiter(map(get, words, repeat(0)), np.int32, len(words)) for words in pieces_of(text)]
        return np.concatenate(parts) if parts else np.zeros(0, np.int32)


def stretches(ids: np.ndarray, shortest: int) -> tuple[np.ndarray, np.ndarray]:
    """Stretches of at least ``shortest`` known words, each ended by 0, and where each word stood (-1: separator)."""
    known = np.concatenate([[False], ids != 0, [False]])
    edges = np.flatnonzero(known[1:] != known[:-1])
    start, end = edges[::2], edges[1::2]
    long = end - start >= shortest
    start, sizes = start[long], (end - start)[long] + 1
    first = np.cumsum(sizes) - sizes
    origin = np.arange(int(sizes.sum())) + np.repeat(start - first, sizes)
    last = first + sizes - 1
    values = ids[np.minimum(origin, len(ids) - 1)]
    values[last], origin[last] = 0, -1
    return values, origin


def search_shard(texts: list[bytes], phrases: Phrases) -> tuple[list[int], list[list[tuple[int, int]]], list[set[str]]]:
    """Of each text: number of words, merged spans of hit words, and names of the items found."""
    parts = [phrases.ids(t) for t in texts]
    n_words = [len(p) for p in parts]
    spans: list[list[tuple[int, int]]] = [[] for _ in texts]
    items: list[set[str]] = [set() for _ in texts]
    offsets = np.cumsum([0] + [n + 1 for n in n_words])  # a 0 after each text
    ids = np.zeros(int(offsets[-1]) + 1, np.int32)
    for at, part in zip(offsets, parts, strict=False):
        ids[at : at + len(part)] = part
    values, origin = stretches(ids, phrases.shortest) if phrases.shortest else (ids[:0], ids[:0])
    if not len(values):
        return n_words, spans, items
    index = FmIndex(values, len(phrases.vocabulary) + 1)
    low, high = index.search(phrases.matrix, phrases.lengths)
    change = np.zeros(len(ids) + 1, np.int64)
    for group in groups_of(found := np.flatnonzero(high > low), (high - low)[found].tolist(), 1 << 20):
        phrase = np.repeat(found[group], (high - low)[found[group]])
        begin = np.cumsum(sizes := (high - low)[found[group]]) - sizes
        at = origin[index.locate(np.arange(len(phrase)) - np.repeat(begin - low[found[group]], sizes))]
        np.add.at(change, at, 1)
        np.add.at(change, at + phrases.lengths[phrase], -1)
        text = np.searchsorted(offsets, at, side="right") - 1
        for t, p in np.unique(np.stack([text, phrase], 1), axis=0).tolist():
            items[t].update(phrases.holders[p])
    hit = np.concatenate([[False], np.cumsum(change) > 0])
    edges = np.flatnonzero(hit[1:] != hit[:-1])
    for a, b in zip(edges[::2].tolist(), edges[1::2].tolist(), strict=True):
        t = int(np.searchsorted(offsets, a, side="right")) - 1
        spans[t].append((a - int(offsets[t]), b - int(offsets[t])))
    return n_words, spans, items


def merged(spans: list[tuple[int, int]]) -> list[tuple[int, int]]:
    out: list[tuple[int, int]] = []
    for a, b in sorted(spans):
        if out and a <= out[-1][1]:
            out[-1] = (out[-1][0], max(b, out[-1][1]))
        else:
            out.append((a, b))
    return out


def character_spans(text: bytes, spans: list[tuple[int, int]]) -> list[tuple[int, int]]:
    """Spans of words as spans of characters, from the first letter of a span to its last."""
    word = np.concatenate([[False], np.frombuffer(text.translate(_WORD_BYTES), np.uint8) != 32, [False]])
    edges = np.flatnonzero(word[1:] != word[:-1])
    character = np.concatenate([[0], np.cumsum(np.frombuffer(text, np.uint8) & 0xC0 != 0x80)])
    return [(int(character[edges[2 * a]]), int(character[edges[2 * b - 1]])) for a, b in spans]


def cut(text: str | None, spans: list[tuple[int, int]]) -> str | None:
    """The text without the spans."""
    if text is None:
        return None
    out, at = [], 0
    for a, b in spans:
        out.append(text[at:a])
        at = b
    return "".join([*out, text[at:]])


def blocks(benchmark: DataFrame, item: str, text: str, limit: int) -> Iterator[list[tuple[str, bytes]]]:
    """The items with text, in lists of about ``limit`` bytes."""
    held, size = [], 0
    rows = benchmark.select(F.col(f"`{item}`").cast("string").alias("i"), F.col(f"`{text}`").alias("t")).filter("t IS NOT NULL")
    for row in rows.toLocalIterator():
        data = row.t.encode()
        if held and size + len(data) > limit:
            yield held
            held, size = [], 0
        held.append(("null" if row.i is None else row.i, data))
        size += len(data)
    yield held


def find(
    docs: DataFrame,
    benchmark: DataFrame,
    keep: list[str],
    text: str = "text",
    item: str = "item_id",
    item_text: str = "text",
    window: int = WINDOW,
    part_of: int = 20,
    shard_bytes: int = SHARD_BYTES,
    block_bytes: int = BLOCK_BYTES,
) -> DataFrame:
    """The columns ``keep`` and the results. A document is contaminated if one word in ``part_of`` or more is hit."""
    sc = docs.sparkSession.sparkContext
    searches = [ship(sc, Phrases(b, window)) for b in blocks(benchmark, item, item_text, block_bytes)]
    state = ("__spans", "__items")

    def passing(shared, first: bool, last: bool):
        def work(batch: pa.RecordBatch) -> list[pa.Array]:
            texts = [t or b"" for t in as_bytes(batch.column(text))]
            words, spans, items = search_shard(texts, received(shared))
            if not first:
                spans = [merged(s + [(x["start"], x["end"]) for x in o]) for s, o in zip(spans, batch.column(state[0]).to_pylist(), strict=True)]
                items = [i.union(o) for i, o in zip(items, batch.column(state[1]).to_pylist(), strict=True)]
            lists = [sorted(i) for i in items]
            if not last:
                return [span_column(spans), pa.array(lists, pa.list_(pa.string()))]
            hits = [sum(b - a for a, b in s) for s in spans]
            return [
                pa.array(words, pa.int64()),
                pa.array(hits, pa.int64()),
                pa.array([len(i) for i in lists], pa.int64()),
                pa.array(lists, pa.list_(pa.string())),
                pa.array([hashlib.sha256(",".join(i).encode()).hexdigest() for i in lists], pa.string()),
                span_column([character_spans(t, s) if s else [] for t, s in zip(texts, spans, strict=True)]),
                pa.array([h > 0 and part_of * h >= n for h, n in zip(hits, words, strict=True)], pa.bool_()),
            ]

        return lambda: work

    frame = docs
    for k, shared in enumerate(searches):
        last = k == len(searches) - 1
        schema = RESULT if last else "__spans array<struct<start:bigint,end:bigint>>, __items array<string>"
        frame = add_columns(frame, text, keep if last else list(dict.fromkeys([*keep, text])), schema, passing(shared, k == 0, last), state if k else (), shard_bytes)
    return frame


def span_column(spans: list[list[tuple[int, int]]]) -> pa.Array:
    return pa.array([[{"start": a, "end": b} for a, b in s] for s in spans], _SPANS)
