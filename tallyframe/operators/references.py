"""Keys that must exist in a parent table, tested in one scan of the child.

The keys of a parent are stored once as a key set: if the last key column is a
whole number, one row for each combination of the other columns and block of
32,768 numbers, with a bit for each number that occurs; else the distinct keys.
A set is exact, so a row's test needs no second look. It is some hundred times
smaller than the parent, and all sets are joined to the same scan of the child:
no reference shuffles the child as long as its set is small.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tallyframe.session import materialise

#: Numbers of a block, and in each of its words.
BLOCK_BITS, WORD_BITS = 15, 6
WORDS = 1 << (BLOCK_BITS - WORD_BITS)
#: Sets of at most this size are sent to all tasks; larger ones are joined by shuffling.
BROADCAST_BYTES = 32 << 20
WHOLE = ("byte", "short", "integer", "long")


@dataclass(frozen=True)
class KeySet:
    """The stored keys of a parent; ``bits`` says whether the last key is held as bits."""

    keys: tuple[str, ...]
    rows: DataFrame
    bits: bool
    small: bool


def key_set(parent: DataFrame, keys: Sequence[str]) -> KeySet:
    """The different keys of ``parent`` without nulls, stored."""
    keys = tuple(keys)
    known = parent.select(*keys).dropna()
    *outer, last = keys
    bits = known.schema[last].dataType.typeName() in WHOLE
    if bits:
        number = F.col(last).cast("bigint")
        in_block = number.bitwiseAND(F.lit((1 << BLOCK_BITS) - 1))
        word = F.shiftright(in_block, WORD_BITS).cast("int")
        bit = F.expr(f"shiftleft(1L, CAST(`{last}` & {(1 << WORD_BITS) - 1} AS INT))")
        words = known.groupBy(*outer, F.shiftright(number, BLOCK_BITS).alias("_block"), word.alias("_word")).agg(F.bit_or(bit).alias("_bits"))
        # At most as many entries as a block has words.
        held = words.groupBy(*outer, "_block").agg(F.map_from_entries(F.collect_list(F.struct("_word", "_bits"))).alias("_held"))
        every = F.transform(F.sequence(F.lit(0), F.lit(WORDS - 1)), lambda w: F.coalesce(F.try_element_at("_held", w), F.lit(0).cast("bigint")))
        rows = held.select(*outer, "_block", every.alias("_words"))
    else:
        rows = known.distinct()
    stored = materialise(rows, "keys")
    # The rows' number comes from the files' footers.
    size = stored.count() * (8 * WORDS + 64 if bits else 64 * len(keys))
    return KeySet(keys, stored, bits, size <= BROADCAST_BYTES)


def marked(child: DataFrame, sets: Mapping[str, KeySet]) -> DataFrame:
    """``child`` with a column for each set: whether the row's key is in it; null if a part of the key is null."""
    for name, known in sets.items():
        *outer, last = known.keys
        side = known.rows
        renamed = {c: f"_{c}_{name}" for c in side.columns}
        side = side.select(*[F.col(c).alias(n) for c, n in renamed.items()], F.lit(True).alias(f"_in_{name}"))
        side = F.broadcast(side) if known.small else side.hint("merge")
        same = [F.col(c) == F.col(renamed[c]) for c in (outer if known.bits else known.keys)]
        found = F.col(f"_in_{name}").isNotNull()
        if known.bits:
            number = F.col(last).cast("bigint")
            same.append(F.shiftright(number, BLOCK_BITS) == F.col(renamed["_block"]))
            word = F.shiftright(number.bitwiseAND(F.lit((1 << BLOCK_BITS) - 1)), WORD_BITS).cast("int")
            bit = number.bitwiseAND(F.lit((1 << WORD_BITS) - 1)).cast("int")
            found = found & (F.getbit(F.get(renamed["_words"], word), bit) == 1)
        whole = all_present(known.keys)
        child = child.join(side, same, "left").withColumn(name, F.when(whole, F.coalesce(found, F.lit(False))))
        child = child.drop(*renamed.values(), f"_in_{name}")
    return child


def all_present(keys: Sequence[str]) -> Column:
    present = F.lit(True)
    for k in keys:
        present = present & F.col(k).isNotNull()
    return present
