"""Near-duplicates by 64-bit SimHash, found through deletion-variant signatures.

Fingerprints at distance ``d`` or less are cut into ``d // 2 + 1`` segments, so
few that one of them differs by at most one bit. Each segment is indexed once
per bit with that bit deleted: two segments that differ in one bit share that
variant, equal ones share all. An equality join on the variants yields the
candidates; its condition verifies the whole distance and accepts a pair under
one variant only, so that no pair comes out twice.

Documents of equal fingerprint are one class before anything is joined, however
many they are. Links join classes into components by alternating large-star and
small-star steps over written tables; nothing but counts reaches the driver.

Defined results: null, empty and blank texts have fingerprint 0 and are one
class. A null id counts as larger than all others; a component of only such
rows has a null id. Repeated rows get a row each. Empty input gives no rows.
``deduplicate`` keeps all columns, whatever their names, and one row per
component: that with the smallest id, and one of rows that share id and
fingerprint. Rows that share an id but not a component are judged apart. Of rows
without an id, one per fingerprint stays unless it meets one with an id.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tallyframe.llm.common import as_bytes, word_pieces
from tallyframe.session import materialise

SHINGLE = 4
DISTANCE = 4
SEED = 42
BITS = 64
NO_ID = (1 << 63) - 1

#: ASCII letters in lower case; white space as one kind of space.
_FOLD = bytes(b + 32 if 65 <= b <= 90 else 32 if 9 <= b <= 13 else b for b in range(256))


def shingle_hashes(text: bytes, width: int = SHINGLE) -> Iterator[list[int]]:
    """Hashes of all shingles, repeats included, about a megabyte of text at a time."""
    digest, held, made = xxhash.xxh64_intdigest, [], False
    for piece in word_pieces(text, _FOLD):
        words = held + piece
        if len(words) >= width:
            joined, at, begins, ends = b" ".join(words), 0, [], []
            for w in words:
                begins.append(at)
                at += len(w)
                ends.append(at)
                at += 1
            yield [digest(joined[a:b], SEED) for a, b in zip(begins, ends[width - 1 :], strict=False)]
            held, made = words[len(words) - width + 1 :], True
        else:
            held = words
    if held and not made:
        yield [digest(b" ".join(held), SEED)]


def fingerprint(text: bytes | None) -> int:
    """The SimHash as a signed number: a bit is 1 if it is set in over half the hashes."""
    total, ones = 0, np.zeros(BITS, np.int64)
    for hashes in shingle_hashes(text or b""):
        array = np.array(hashes, np.uint64).view(np.uint8).reshape(-1, 8)
        ones += np.unpackbits(array, axis=1, bitorder="little").sum(axis=0, dtype=np.int64)
        total += len(hashes)
    return int(np.packbits(2 * ones > total, bitorder="little").view(np.int64)[0])


def fingerprints(docs: DataFrame, text: str = "text", keep: list[str] | None = None) -> DataFrame:
    """The columns ``keep`` (default: all) and ``__fp``."""
    keep = docs.columns if keep is None else keep
    frame = docs.select(*[F.col(f"`{c}`") for c in keep if c != text], F.col(f"`{text}`").alias("__text"))
    back = text in keep
    names = [c for c in keep if c != text]

    def add(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            column = batch.column("__text")
            prints = pa.array([fingerprint(t) for t in as_bytes(column)], pa.int64())
            columns = [batch.column(c) for c in names] + [column] * back + [prints]
            yield pa.RecordBatch.from_arrays(columns, names + ["__text"] * back + ["__fp"])

    fields = [f"`{f.name}` {f.dataType.simpleString()}" for f in frame.schema.fields if f.name != "__text" or back]
    return frame.mapInArrow(add, ", ".join([*fields, "__fp bigint"]))


def segments(distance: int = DISTANCE, bits: int = BITS) -> list[tuple[int, int]]:
    """Offset and length of each segment."""
    parts = distance // 2 + 1
    sizes = [bits // parts + (k < bits % parts) for k in range(parts)]
    return [(sum(sizes[:k]), size) for k, size in enumerate(sizes)]


def segment(value: Column, offset: int, size: int) -> Column:
    return F.shiftrightunsigned(value, offset).bitwiseAND(F.lit((1 << size) - 1))


def variants(value: Column, distance: int = DISTANCE) -> Column:
    """A key per bit of the fingerprint: its segment without that bit, and the bit's number."""
    keys = []
    for offset, size in segments(distance):
        part = segment(value, offset, size)
        keys += [part.bitwiseAND(F.lit(~(1 << j))).bitwiseOR(F.lit((offset + j) << 32)) for j in range(size)]
    return F.array(*keys)


def links(classes: DataFrame, distance: int = DISTANCE) -> DataFrame:
    """Pairs ``u < v`` of different fingerprints in column ``fp`` at ``distance`` or less, each once.

    The join must be a merge join: the planner takes the index for as small as
    the fingerprints, though it has a row per bit of each, and might broadcast it.
    """
    index = classes.select("fp", F.explode(variants(F.col("fp"), distance)).alias("key"))
    a, b = index.select(F.col("fp").alias("u"), "key"), index.select(F.col("fp").alias("v"), F.col("key").alias("key_v"))
    differ = F.col("u").bitwiseXOR(F.col("v"))
    first = F.lit(None).cast("long")
    for offset, size in reversed(segments(distance)):
        part = segment(differ, offset, size)
        bit = offset + F.bit_count(F.greatest(part, F.lit(1)) - 1)  # the number of the only differing bit, or the first
        first = F.when(F.bit_count(part) <= 1, bit.cast("long")).otherwise(first)
    found = (F.col("key") == F.col("key_v")) & (F.col("u") < F.col("v"))
    found &= (F.bit_count(differ) <= distance) & (F.shiftright("key", 32) == first)
    return a.join(b.hint("merge"), found).select("u", "v")


def stars(edges: DataFrame) -> DataFrame:
    """Every node of an edge list but the smallest of its component (``v``), with that smallest one (``u``)."""

    def summary(e: DataFrame) -> tuple:
        return tuple(e.agg(F.count(F.lit(1)), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first())

    def least(e: DataFrame, label: str) -> DataFrame:
        grouped = e.groupBy("u").agg(F.min("v").alias("m"))
        return materialise(grouped.select("u", F.least("u", "m").alias("m")), label)

    edges = materialise(edges.distinct(), "links")
    seen = summary(edges)
    while True:
        # Large star: neighbours above a node go to the smallest of its neighbourhood.
        both = edges.unionByName(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
        large = both.join(least(both, "large"), "u").filter("v > u").select(F.col("m").alias("u"), "v").filter("u < v")
        large = materialise(large.distinct(), "large-star")
        # Small star: neighbours below a node, and the node, go to the smallest of them.
        down = large.select(F.col("v").alias("u"), F.col("u").alias("v"))
        mins = least(down, "small")
        moved = down.join(mins, "u").select(F.col("m").alias("u"), "v").unionByName(mins.select(F.col("m").alias("u"), F.col("u").alias("v")))
        edges = materialise(moved.filter("u < v").distinct(), "small-star")
        now = summary(edges)
        if now == seen:
            return edges
        seen = now


def components(prints: DataFrame, distance: int = DISTANCE) -> DataFrame:
    """The smallest id of the component for every ``__fp`` of more than one row or with a link."""
    classes = prints.groupBy(F.col("__fp").alias("fp")).agg(F.min("__id").alias("id"), F.count(F.lit(1)).alias("n"))
    classes = materialise(classes, "classes")
    star = stars(links(classes, distance))
    nodes = star.select(F.col("v").alias("fp"), F.col("u").alias("root")).unionByName(
        star.select(F.col("u").alias("fp"), F.col("u").alias("root")).distinct()
    )
    linked = classes.join(nodes, "fp").select("fp", "root", "id")
    least = materialise(linked.groupBy("root").agg(F.min("id").alias("component")), "roots")
    labels = linked.join(least, "root").select("fp", "component")
    alone = classes.filter("n > 1").join(nodes.select("fp"), "fp", "left_anti").select("fp", F.col("id").alias("component"))
    return materialise(labels.unionByName(alone), "components")


def near_duplicates(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", distance: int = DISTANCE) -> DataFrame:
    """A row per document: its id, its fingerprint in hexadecimal, and its component's smallest id."""
    named = docs.select(F.coalesce(F.col(f"`{doc_id}`").cast("long"), F.lit(NO_ID)).alias("__id"), F.col(f"`{text}`").alias("text"))
    prints = materialise(fingerprints(named, keep=["__id"]), "fingerprints")
    found = prints.join(components(prints, distance).withColumnRenamed("fp", "__fp"), "__fp", "left")
    return found.select(
        F.nullif("__id", F.lit(NO_ID)).alias(doc_id),
        F.lpad(F.lower(F.hex("__fp")), 16, "0").alias("fingerprint"),
        F.nullif(F.coalesce("component", "__id"), F.lit(NO_ID)).alias("component_id"),
    )


def deduplicate(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", distance: int = DISTANCE) -> DataFrame:
    """One document of each component, with all its columns.

    The documents are written once with their fingerprints and shuffled once,
    by id, to meet the list of those that stay.
    """
    packed = docs.select(
        F.coalesce(F.col(f"`{doc_id}`").cast("long"), F.lit(NO_ID)).alias("__id"),
        F.struct(*[F.col(f"`{c}`") for c in docs.columns if c != text]).alias("__rest"),
        F.col(f"`{text}`").alias("text"),
    )
    prints = materialise(fingerprints(packed).withColumnRenamed("__text", "text"), "fingerprints")
    slim = prints.select("__id", "__fp")
    found = slim.join(components(slim, distance).withColumnRenamed("fp", "__fp"), "__fp", "left")
    stay = found.filter(F.coalesce("component", "__id") == F.col("__id")).groupBy("__id", "__fp").agg(F.count(F.lit(1)).alias("__n"))
    # A merge join leaves the rows where the window needs them.
    kept = prints.join(materialise(stay, "kept").hint("merge"), ["__id", "__fp"])
    once = Window.partitionBy("__id", "__fp").orderBy("__id", "__fp")
    kept = kept.withColumn("__k", F.row_number().over(once)).filter("__k = 1")
    return kept.select(*[(F.col("text").alias(c) if c == text else F.col("__rest")[c].alias(c)) for c in docs.columns])
