"""How quality filters overlap, over a sparse document-term matrix.

Five filters judge each document; this audit applies them in all 120 orders and
says what each removes first, what others had removed before, and what it alone
catches.

1. ``local_shards`` counts the words of every document. A shard of some
   megabytes of text numbers its own words; shards are written once.
2. ``global_codes`` gives every different word one number: the words of a shard
   go once, packed, to ranges of word checksums, and numbers come back. There is
   one range for each ``RANGE_BYTES`` of packed words, so ranges grow in number
   and not in size. A frequent word is one entry of a shard, however often it
   stands there.
3. ``matrix`` puts both together as CSR shards: row starts, word numbers, counts.
4. ``judged`` reads row sums and numbers of nonzeros off the shards, which decide
   filters A and B, and joins equal texts (by SHA-256) and labels.
5. ``audit`` counts documents by part and set of failed filters, at most 32 rows
   for each part, and works out all orders from these counts.

Filters, with words as maximal runs without white space, case-sensitive:
A under 200 words; B 100 * different words < 50 * words; C 100 * letters A-Z > 2 *
code points; D one of ``#$%&*|``; E text equal to that of a smaller id.

Word numbers are unique, not gapless: range << 32 | place in the range.

Defined results: a null text is empty; it fails A only, and E as other empty
texts do. A null id is not smaller than any and no id is smaller than it. Equal
rows are documents of their own, and not copies of each other by E. A null part
is the empty one. A document is good or toxic if any label row of its id says
so; without one it is neither. An empty table gives no rows. Other columns are
ignored, whatever their names.
"""

from __future__ import annotations

import hashlib
import itertools
import zlib
from array import array
from collections import Counter, defaultdict
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tallyframe.llm.common import PIECE, as_bytes, groups_of, sizes_of, word_pieces
from tallyframe.llm.crossentropy import loosen, squeeze
from tallyframe.session import materialise

LEAST_WORDS, DISTINCT_PERCENT, CAPITALS_PERCENT, SYMBOLS = 200, 50, 2, b"#$%&*|"
FILTERS = "ABCDE"
#: Text of a shard, and packed words of a range of the dictionary.
SHARD_BYTES, RANGE_BYTES = 16 << 20, 4 << 20
ROW_BYTES = 64

_CAPITALS = bytes(range(65, 91))
_INNER_BYTES = bytes(range(0x80, 0xC0))  # of a code point, all but its first byte
_LOCAL = "shard bigint, kept binary, starts binary, columns binary, counts binary, words binary, word_bytes bigint"
_PACK = "shard bigint, part bigint, words binary"
_CODES = "shard bigint, part bigint, codes binary"
_MATRIX = "shard bigint, kept binary, starts binary, columns binary, counts binary"
_FACTS = "shouting boolean, symbols boolean, digest binary"


def names_of(schema: str) -> list[str]:
    return [c.split()[0] for c in schema.split(", ")]


def _ipc(table: pa.Table | pa.RecordBatch) -> bytes:
    sink = pa.BufferOutputStream()
    with pa.ipc.new_stream(sink, table.schema, options=pa.ipc.IpcWriteOptions(compression="zstd")) as out:
        out.write(table)
    return sink.getvalue().to_pybytes()


def counted(text: bytes) -> Counter:
    """Each word of a text and how often it stands there."""
    if len(text) <= PIECE:
        return Counter(text.split())
    counts: Counter = Counter()
    for words in word_pieces(text):
        counts.update(words)
    return counts


def facts(text: bytes) -> tuple[bool, bool, bytes]:
    """Whether filters C and D fail, and the text's digest."""
    capitals = len(text) - len(text.translate(None, _CAPITALS))
    points = len(text.translate(None, _INNER_BYTES))
    symbols = len(text.translate(None, SYMBOLS)) < len(text)
    return 100 * capitals > CAPITALS_PERCENT * points, symbols, hashlib.sha256(text).digest()


def in_order(words: list[bytes]) -> np.ndarray:
    """Places of the words in the order of their checksums, which every step uses."""
    return np.argsort(checksums(words), kind="stable")


def checksums(words: list[bytes]) -> np.ndarray:
    return np.fromiter(map(zlib.crc32, words), np.uint64, len(words))


def local_shards(docs: DataFrame, id: str, text: str, part: str) -> DataFrame:
    """Shards with word counts of each document in the shard's own numbers; its words lie in the order of their checksums."""

    def shard(rows: pa.Table, key: int) -> pa.RecordBatch:
        number: defaultdict = defaultdict(itertools.count().__next__)
        starts, columns, counts, found = [0], array("i"), array("q"), []
        for t in as_bytes(rows.column("__text").combine_chunks()):
            row = counted(t or b"")
            columns.extend(map(number.__getitem__, row))
            counts.extend(row.values())
            starts.append(len(columns))
            found.append(facts(t or b""))
        words = list(number)
        order = in_order(words)
        rank = np.empty(len(words), np.int32)
        rank[order] = np.arange(len(words), dtype=np.int32)
        joined = b" ".join(map(words.__getitem__, order.tolist()))
        names = ["shouting", "symbols", "digest"]
        told = [pa.array(c, t) for c, t in zip(zip(*found, strict=True), (pa.bool_(), pa.bool_(), pa.binary()), strict=True)]
        kept = pa.Table.from_arrays([*rows.select(["__id", "__part"]).combine_chunks().columns, *told], ["__id", "__part", *names])
        blobs = [
            _ipc(kept),
            squeeze(np.array(starts, np.int64)),
            squeeze(rank[np.frombuffer(columns, np.int32)]),
            squeeze(np.frombuffer(counts, np.int64)),
            pa.compress(joined, "zstd", asbytes=True) if words else b"",
        ]
        values = [pa.array([key]), *[pa.array([b], pa.binary()) for b in blobs], pa.array([len(joined)])]
        return pa.RecordBatch.from_arrays(values, names_of(_LOCAL))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        first, made, held, size = TaskContext.get().partitionId() << 32, itertools.count(), [], 0
        for batch in batches:
            sizes = [s + ROW_BYTES for s in sizes_of(batch.column("__text"))]
            for piece in groups_of(range(batch.num_rows), sizes, SHARD_BYTES):
                if held and size + sum(sizes[piece]) > SHARD_BYTES:
                    yield shard(pa.Table.from_batches(held), first + next(made))
                    held, size = [], 0
                held.append(batch.slice(piece.start, piece.stop - piece.start))
                size += sum(sizes[piece])
        if held:
            yield shard(pa.Table.from_batches(held), first + next(made))

    named = [(id, "__id"), (part, "__part"), (text, "__text")]
    return docs.select(*[F.col(f"`{c}`").alias(n) for c, n in named]).mapInArrow(run, _LOCAL)


def _words(row: dict) -> list[bytes]:
    return pa.decompress(row["words"], row["word_bytes"], "zstd", asbytes=True).split(b" ") if row["words"] else []


def global_codes(local: DataFrame, parts: int) -> DataFrame:
    """For each shard and range, the numbers of its words in the order in which it has them."""

    def send(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for k in range(batch.num_rows):
                row = batch.slice(k, 1).to_pylist()[0]
                if not (words := _words(row)):
                    continue
                part = ((checksums(words) * np.uint64(parts)) >> np.uint64(32)).astype(np.int64)
                edges = [*np.flatnonzero(np.diff(part, prepend=-1)).tolist(), len(words)]
                spans = list(zip(edges[:-1], edges[1:], strict=True))
                columns = [[row["shard"]] * len(spans), [int(part[a]) for a, _ in spans], [b" ".join(words[a:b]) for a, b in spans]]
                kinds = (pa.int64(), pa.int64(), pa.binary())
                arrays = [pa.array(c, t) for c, t in zip(columns, kinds, strict=True)]
                yield pa.RecordBatch.from_arrays(arrays, ["shard", "part", "words"])

    def number(table: pa.Table) -> pa.Table:
        table = table.sort_by("shard")  # a repeated task gives the same numbers
        place: defaultdict = defaultdict(itertools.count().__next__)
        packs = (words.as_py().split(b" ") for words in table.column("words"))
        codes = [squeeze(np.fromiter(map(place.__getitem__, p), np.uint32, len(p))) for p in packs]
        return pa.table([table.column("shard"), table.column("part"), pa.array(codes, pa.binary())], ["shard", "part", "codes"])

    sent = local.select("shard", "words", "word_bytes").mapInArrow(send, _PACK)
    return sent.groupBy("part").applyInArrow(number, _CODES)


def matrix(local: DataFrame, codes: DataFrame) -> DataFrame:
    """CSR shards: rows' kept columns, and little-endian 64-bit row starts, word numbers and counts, each compressed."""

    def run(shard: pa.Table, codes: pa.Table) -> pa.Table:
        row = shard.to_pylist()[0]
        got = [np.zeros(0, np.int64)]
        for r in codes.sort_by("part").to_pylist():
            got.append(loosen(r["codes"], np.uint32).astype(np.int64) | r["part"] << 32)
        columns = np.concatenate(got)[loosen(row["columns"], np.int32)]
        made = [row["shard"], row["kept"], row["starts"], squeeze(columns), row["counts"]]
        return pa.table([pa.array([v]) for v in made], names_of(_MATRIX))

    return local.drop("words", "word_bytes").groupBy("shard").cogroup(codes.groupBy("shard")).applyInArrow(run, _MATRIX)


def document_term_matrix(docs: DataFrame, id: str = "doc_id", text: str = "text", part: str = "source") -> DataFrame:
    """The CSR shards of all documents over one dictionary."""
    local = materialise(local_shards(docs, id, text, part), "local-shards")
    size = local.agg(F.sum("word_bytes")).first()[0] or 0
    return matrix(local, global_codes(local, max(1, -(-size // RANGE_BYTES))))


def row_facts(csr: DataFrame, id_type: T.DataType, part_type: T.DataType) -> DataFrame:
    """Of each document: id, part, words, different words, filters C and D, digest."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for k in range(batch.num_rows):
                row = batch.slice(k, 1).to_pylist()[0]
                starts, counts = loosen(row["starts"], np.int64), loosen(row["counts"], np.int64)
                nonzeros = np.diff(starts)
                sums = np.diff(np.concatenate([[0], np.cumsum(counts)])[starts])
                kept = pa.ipc.open_stream(row["kept"]).read_all()
                told = [c.combine_chunks() for c in kept.columns]
                names = [*kept.column_names, "n_words", "n_distinct"]
                yield pa.RecordBatch.from_arrays([*told, pa.array(sums), pa.array(nonzeros)], names)

    new = T.StructType.fromDDL(f"{_FACTS}, n_words bigint, n_distinct bigint")
    schema = T.StructType([T.StructField("__id", id_type), T.StructField("__part", part_type), *new.fields])
    return csr.mapInArrow(run, schema)


def judged(docs: DataFrame, labels: DataFrame, id: str = "doc_id", text: str = "text", part: str = "source") -> DataFrame:
    """Of each document: ``id``, ``part``, the set of filters that it fails as bits (A is 1), ``good`` and ``toxic``."""
    csr = document_term_matrix(docs, id, text, part)
    rows = materialise(row_facts(csr, docs.schema[id].dataType, docs.schema[part].dataType), "row-facts")
    # Both sides of the joins below are stored, so that Spark may split a hot text or id.
    first = rows.groupBy("digest").agg(F.min("__id").alias("__first"), F.count(F.lit(1)).alias("__n")).filter("__n > 1")
    first = materialise(first.drop("__n"), "first-copies")
    says = labels.groupBy(F.col(f"`{id}`").alias("__id")).agg(
        F.coalesce(F.max(F.col("quality") == 1), F.lit(False)).alias("good"),
        F.coalesce(F.max(F.col("toxic") == 1), F.lit(False)).alias("toxic"),
    )
    says = materialise(says, "label-marks")
    fails = {
        "A": F.col("n_words") < LEAST_WORDS,
        "B": 100 * F.col("n_distinct") < DISTINCT_PERCENT * F.col("n_words"),
        "C": F.col("shouting"),
        "D": F.col("symbols"),
        "E": F.coalesce(F.col("__id") > F.col("__first"), F.lit(False)),
    }
    bits = sum((F.when(f, F.lit(1 << k)).otherwise(F.lit(0)) for k, f in enumerate(fails.values())), F.lit(0))
    joined = rows.join(first, "digest", "left").select("__id", "__part", bits.alias("failed")).join(says, "__id", "left")
    false = F.lit(False)
    return joined.select(
        F.col("__id").alias("id"),
        F.coalesce(F.col("__part").cast("string"), F.lit("")).alias("part"),
        "failed",
        F.coalesce("good", false).alias("good"),
        F.coalesce("toxic", false).alias("toxic"),
    )


def audit(docs: DataFrame, labels: DataFrame, id: str = "doc_id", text: str = "text", part: str = "source") -> DataFrame:
    """One row per part, order of the filters and step, with the counts of that step."""
    return orders_of(judged(docs, labels, id, text, part))


def orders_of(documents: DataFrame) -> DataFrame:
    """The audit's rows, from ``part``, ``failed``, ``good`` and ``toxic`` of each document."""
    sets = documents.groupBy("part", "failed").agg(
        F.count(F.lit(1)).alias("n"), F.count_if("good").alias("good"), F.count_if("toxic").alias("toxic")
    )
    # At most 32 rows for each part.
    parts = sets.groupBy("part").agg(F.collect_list(F.struct("failed", "n", "good", "toxic")).alias("sets"))
    orders = ["".join(p) for p in itertools.permutations(FILTERS)]
    steps = parts.select("*", F.explode(F.split(F.lit(",".join(orders)), ",")).alias("filter_order"))
    steps = steps.select("*", F.explode(F.sequence(F.lit(1), F.lit(len(FILTERS)))).alias("step"))
    at = [F.locate(letter, F.col("filter_order")) for letter in FILTERS]
    bits = lambda test: sum((F.when(test(p), F.lit(1 << k)).otherwise(F.lit(0)) for k, p in enumerate(at)), F.lit(0))
    steps = steps.select(
        "part", "sets", "filter_order", "step", bits(lambda p: p < F.col("step")).alias("before"), bits(lambda p: p == F.col("step")).alias("own")
    )
    before, own = F.col("before"), F.col("own")
    fails = lambda s, which: s["failed"].bitwiseAND(which) != 0

    def total(test, value="n") -> Column:
        taken = lambda done, s: done + F.when(test(s), value(s) if callable(value) else s[value]).otherwise(F.lit(0))
        return F.aggregate("sets", F.lit(0).cast("bigint"), taken)

    removed = lambda s: fails(s, own) & ~fails(s, before)
    # Of the orders of a document's failed filters, each filter comes first in the same number.
    share = lambda s: s["n"] * F.lit(len(orders)).cast("bigint") / F.bit_count(s["failed"])
    return steps.select(
        "part",
        "filter_order",
        "step",
        total(lambda s: ~fails(s, before) & ~fails(s, own)).alias("kept"),
        total(removed).alias("removed"),
        total(lambda s: fails(s, own) & fails(s, before)).alias("redundant"),
        total(lambda s: s["failed"] == own).alias("unique_fails"),
        total(removed, "good").alias("good_lost"),
        total(removed, "toxic").alias("toxic_lost"),
        total(lambda s: fails(s, own), lambda s: share(s).cast("bigint")).alias("shapley"),
    )
