"""Cross-entropy difference of two matched n-gram models.

A target model learns from the documents marked as targets, a background model
from all documents. Both are bigram models that fall back on words, with the
same vocabulary, keys and smoothing, and the background's counts are scaled to
the target's number of tokens. A document's score is the mean over its tokens of
the target's loss minus the background's: low means like the target. A document
is scored without its own counts, so no target knows its own text.

Words are what stands between white space, with case and signs. The vocabulary
is every word of the corpus, however rare or long, and every pair of neighbours
is counted. Both are known by keys of 64 bits, so two of them could share a count
by chance: with n different pairs about n * n / 2 ** 65 do, less than one below
some 6 * 10 ** 9 pairs.

Nothing of a fixed size is gathered, and the driver gets three sums. Documents are
written in groups of about ``GROUP_BYTES`` of text as numbers of the group's words. Each
group sends its different words and pairs with their counts to their ranges of
keys, where they are added up, and gets back the totals of those that it sent. So
a frequent pair is one entry of a group, and a task holds one group or one range at a
time. Ranges and their tasks grow in number with the tokens, not in size.

Defined results: a null or wordless text has no tokens and null losses and score.
A null mark is no target. Without targets all losses are equal and scores 0.
Repeated rows count as often as they occur and get a row each. Other columns pass unchanged; input
columns named like a result are replaced.
"""

from __future__ import annotations

from collections.abc import Iterator
from hashlib import blake2b
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tallyframe.llm.common import as_bytes, groups_of, sizes_of, word_pieces
from tallyframe.session import materialise

#: Tokens that the fallback counts for beside a context's own.
PRIOR = 500.0
#: Text of a group, and what a row counts beside its text.
GROUP_BYTES = 16 << 20
ROW_BYTES = 64
#: Tokens of the corpus to a range of keys; a range gets at most so many words or pairs on average.
RANGE_TOKENS = 1 << 20
#: Words whose keys a task remembers.
CACHE = 1_000_000
START = 2
RESULT = "n_tokens bigint, target_loss double, background_loss double, score double"
_PACKED = "group bigint, kept binary, lengths binary, marks binary, words binary, tokens binary, n bigint, n_target bigint"
_SENT = "group bigint, bucket int, keys binary, counts binary"
_TOTALS = "group bigint, bucket int, counts binary, different bigint"
_MIX = np.uint64(0x9E3779B97F4A7C15)


class Keys(dict):
    """The key of each word."""

    def __missing__(self, word: bytes) -> int:
        key = self[word] = int.from_bytes(blake2b(word, digest_size=8).digest(), "little")
        return key

    def of(self, text: bytes) -> list[np.ndarray]:
        if len(self) > CACHE:
            self.clear()
        return [np.fromiter(map(self.__getitem__, w), np.uint64, len(w)) for w in word_pieces(text)]


def squeeze(values: np.ndarray) -> bytes:
    """Numbers by planes of their bytes, compressed."""
    planes = np.ascontiguousarray(values).reshape(-1).view(np.uint8).reshape(-1, values.itemsize).T.tobytes()
    return len(planes).to_bytes(8, "little") + pa.compress(planes, "zstd", asbytes=True)


def loosen(blob: bytes, kind: type) -> np.ndarray:
    planes = pa.decompress(blob[8:], int.from_bytes(blob[:8], "little"), "zstd", asbytes=True)
    return np.frombuffer(planes, np.uint8).reshape(np.dtype(kind).itemsize, -1).T.copy().reshape(-1).view(kind)


def joined(arrays: list[np.ndarray], kind: type, axis: int = 0) -> np.ndarray:
    return np.concatenate(arrays, axis) if arrays else np.zeros(0, kind)


def pack(docs: DataFrame, keep: list[str], text: str, target: str) -> DataFrame:
    """The documents in groups: kept columns, tokens of each document, and its words in numbers of the group's words."""

    names = T.StructType.fromDDL(_PACKED).names

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        keys, made, held, size = Keys(), 0, [], 0

        def group() -> pa.RecordBatch:
            rows = pa.Table.from_batches(held)
            ids, lengths = [], []
            for t in as_bytes(rows.column("__text").combine_chunks()):
                found = keys.of(t) if t else []
                ids += found
                lengths.append(sum(map(len, found)))
            marks = np.array([bool(m) for m in rows.column("__target").to_pylist()], bool)
            words, tokens, counts = np.unique(joined(ids, np.uint64), return_inverse=True, return_counts=True)
            order = np.argsort(-counts, kind="stable")  # small numbers for frequent words
            number = np.empty(len(words), np.uint32)
            number[order] = np.arange(len(words), dtype=np.uint32)
            sink = pa.BufferOutputStream()
            kept = rows.select(range(len(keep))).combine_chunks()
            with pa.ipc.new_stream(sink, kept.schema, options=pa.ipc.IpcWriteOptions(compression="zstd")) as out:
                out.write_table(kept)
            lengths = np.array(lengths, np.int64)
            blobs = [sink.getvalue().to_pybytes(), squeeze(lengths), squeeze(marks), squeeze(words[order]), squeeze(number[tokens])]
            values = [(TaskContext.get().partitionId() << 32) + made, *blobs, int(lengths.sum()), int(lengths[marks].sum())]
            return pa.RecordBatch.from_arrays(
                [pa.array([v], pa.binary() if isinstance(v, bytes) else pa.int64()) for v in values], names
            )

        for batch in batches:
            sizes = [s + ROW_BYTES for s in sizes_of(batch.column(len(keep)))]
            for part in groups_of(range(batch.num_rows), sizes, GROUP_BYTES):
                held.append(batch.slice(part.start, part.stop - part.start))
                size += sum(sizes[part])
                if size > GROUP_BYTES // 2:
                    yield group()
                    made, held, size = made + 1, [], 0
        if held:
            yield group()

    columns = [F.col(f"`{c}`").alias(f"__k{k}") for k, c in enumerate(keep)]
    return docs.select(*columns, F.col(text).alias("__text"), F.col(target).alias("__target")).mapInArrow(run, _PACKED)


class Group:
    """A group's documents, and the places of its words, contexts and pairs."""

    def __init__(self, row: dict, pair_bits: int):
        self.lengths, self.marks = loosen(row["lengths"], np.int64), loosen(row["marks"], bool)
        self.words = np.append(loosen(row["words"], np.uint64), np.uint64(START))
        self.tokens = loosen(row["tokens"], np.uint32).astype(np.int64)
        self.starts = np.cumsum(self.lengths) - self.lengths
        self.before = np.append(0, self.tokens)[:-1] if len(self.tokens) else self.tokens
        self.before[self.starts[self.lengths > 0]] = len(self.words) - 1
        keys = (self.words[self.before] * _MIX + self.words[self.tokens]) >> np.uint64(64 - pair_bits)
        self.pair_keys, self.pairs = np.unique(keys, return_inverse=True)
        self.order = np.argsort(self.words)

    def counts(self) -> tuple[np.ndarray, np.ndarray]:
        """Words and contexts of targets and all, in the order of word keys; pairs of targets and all."""
        marked = np.repeat(self.marks, self.lengths)
        both = lambda at, n: [np.bincount(at[marked], minlength=n), np.bincount(at, minlength=n)]
        n = len(self.words)
        return np.array(both(self.tokens, n) + both(self.before, n))[:, self.order], np.array(both(self.pairs, len(self.pair_keys)))


def send(packed: DataFrame, buckets: int, pair_bits: int) -> DataFrame:
    """Different words and pairs of each group with their counts, by range of keys; the ranges of pairs follow those of words."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for k in range(batch.num_rows):
                row = batch.slice(k, 1).to_pylist()[0]
                if not row["n"]:
                    continue
                group = Group(row, pair_bits)
                out: list[list] = [[], [], [], []]
                for first, keys, counts, bits in zip((0, buckets), (group.words[group.order], group.pair_keys), group.counts(), (64, pair_bits), strict=True):
                    high = keys >> np.uint64(bits - 32) if bits > 32 else keys << np.uint64(32 - bits)
                    bucket = ((high * np.uint64(buckets)) >> np.uint64(32)).astype(np.int64)
                    edges = np.append(np.flatnonzero(np.diff(bucket, prepend=-1)), len(keys))
                    for a, b in zip(edges[:-1], edges[1:], strict=True):
                        gaps = np.diff(keys[a:b], prepend=np.uint64(0))
                        for column, value in zip(out, (row["group"], first + int(bucket[a]), squeeze(gaps), squeeze(counts[:, a:b])), strict=True):
                            column.append(value)
                kinds = (pa.int64(), pa.int32(), pa.binary(), pa.binary())
                yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(out, kinds, strict=True)], ["group", "bucket", "keys", "counts"])

    return packed.select("group", "lengths", "marks", "words", "tokens", "n").mapInArrow(run, _SENT)


def add_up(sent: DataFrame, tasks: int) -> DataFrame:
    """To each group the totals of what it sent; the first row of a range also says how many different keys that has."""

    names = T.StructType.fromDDL(_TOTALS).names

    def run(table: pa.Table) -> pa.Table:
        keys = [np.cumsum(loosen(b, np.uint64), dtype=np.uint64) for b in table.column("keys").to_pylist()]
        counts = [loosen(b, np.int64).reshape(-1, len(k)) for b, k in zip(table.column("counts").to_pylist(), keys, strict=True)]
        different, at = np.unique(np.concatenate(keys), return_inverse=True)
        totals = np.zeros((len(counts[0]), len(different)), np.int64)
        ends = np.cumsum([len(k) for k in keys])
        places = [at[e - len(k) : e] for e, k in zip(ends, keys, strict=True)]
        for place, count in zip(places, counts, strict=True):
            totals[:, place] += count  # the keys of a group are different
        blobs = pa.array([squeeze(totals[:, p]) for p in places], pa.binary())
        first = pa.array([len(different)] + [0] * (len(keys) - 1), pa.int64())
        return pa.table([table.column("group"), table.column("bucket"), blobs, first], names)

    return sent.repartition(tasks, "bucket").groupBy("bucket").applyInArrow(run, _TOTALS)


class Models(NamedTuple):
    """Both models: packed documents, totals of each group's words and pairs, and sizes of vocabulary, targets and background."""

    packed: DataFrame
    totals: DataFrame
    keep: list[str]
    words: int
    tokens: tuple[int, int]
    buckets: int
    tasks: int
    pair_bits: int


def losses(group: Group, words: np.ndarray, pairs: np.ndarray, size: int, tokens: tuple[int, int]) -> Iterator[tuple[int, float, float]]:
    """Of each document: tokens, and mean loss under the target and the background, without its own counts."""
    counts = np.empty_like(words)
    counts[:, group.order] = words
    for start, n, marked in zip(group.starts.tolist(), group.lengths.tolist(), group.marks.tolist(), strict=True):
        if not n:
            yield 0, 0.0, 0.0
            continue
        places = [at[start : start + n] for at in (group.tokens, group.before, group.pairs)]
        own = []
        for at in places:
            _, inverse, repeats = np.unique(at, return_inverse=True, return_counts=True)
            own.append(repeats[inverse])
        scale = (tokens[0] - n * marked) / max(1, tokens[1] - n)
        means = []
        for model, without, factor in ((0, marked, 1.0), (1, True, scale)):
            seen = (counts[model], counts[2 + model], pairs[model])
            word, context, pair = ((c[at] - o * without) * factor for c, at, o in zip(seen, places, own, strict=True))
            fallback = (word + 0.5) / ((tokens[model] - n * without) * factor + 0.5 * size)
            means.append(float(-np.log((pair + PRIOR * fallback) / (context + PRIOR)).mean()))
        yield n, means[0], means[1]


def fit(
    docs: DataFrame, text: str = "text", target: str = "target", pair_bits: int = 64, keep: list[str] | None = None, range_tokens: int = RANGE_TOKENS
) -> Models:
    """Both models, from all documents, which are written with the columns ``keep`` (all, if not given)."""
    keep = docs.columns if keep is None else keep
    packed = materialise(pack(docs, keep, text, target), "packed")
    tokens = packed.agg(F.coalesce(F.sum("n_target"), F.lit(0)), F.coalesce(F.sum("n"), F.lit(0))).first()
    buckets = max(1, -(-tokens[1] // range_tokens))
    tasks = max(buckets, int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions")))
    totals = materialise(add_up(send(packed, buckets, pair_bits), tasks), "totals")
    different = totals.filter(F.col("bucket") < buckets).agg(F.coalesce(F.sum("different"), F.lit(0))).first()[0]
    # The start and a word that nobody has seen belong to the vocabulary; ``different`` has the start.
    return Models(packed, totals, keep, different + 1, tuple(tokens), buckets, tasks, pair_bits)


def score(docs: DataFrame, models: Models, keep: list[str]) -> DataFrame:
    """The columns ``keep`` of the fitted documents with number of tokens, both losses and their difference."""
    new = T.StructType.fromDDL(RESULT)
    keep = [c for c in keep if c not in new.names]
    columns, names = [models.keep.index(c) for c in keep], keep + new.names
    size, tokens, buckets, pair_bits = models.words, models.tokens, models.buckets, models.pair_bits

    def run(packed: pa.Table, totals: pa.Table) -> pa.Table:
        row = packed.to_pylist()[0]
        group = Group(row, pair_bits)
        got: tuple[list, list] = ([], [])
        for r in totals.sort_by("bucket").to_pylist():
            pair = r["bucket"] >= buckets
            got[pair].append(loosen(r["counts"], np.int64).reshape(2 if pair else 4, -1))
        empty = [np.zeros((4, len(group.words)), np.int64)], [np.zeros((2, 0), np.int64)]
        words, pairs = (joined(g or e, np.int64, 1) for g, e in zip(got, empty, strict=True))
        found = list(losses(group, words, pairs, size, tokens))
        of = lambda pick: pa.array([pick(f) if f[0] else None for f in found], pa.float64())
        kept = pa.ipc.open_stream(row["kept"]).read_all()
        made = [pa.array([f[0] for f in found], pa.int64()), of(lambda f: f[1]), of(lambda f: f[2]), of(lambda f: f[1] - f[2])]
        return pa.table([kept.column(c) for c in columns] + made, names)

    sent, back = models.packed.drop("n", "n_target"), models.totals.drop("different")
    schema = T.StructType([docs.schema[c] for c in keep] + new.fields)
    sent, back = (side.repartition(models.tasks, "group") for side in (sent, back))
    return sent.groupBy("group").cogroup(back.groupBy("group")).applyInArrow(run, schema)
