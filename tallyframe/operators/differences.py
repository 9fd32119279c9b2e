"""Differences between two tables, down to the rows.

Both tables are summed up into checksums per hash group of the key, one scan each and
no shuffle of rows. Only rows of groups whose checksums differ are then compared, so
that two large tables with few differences cost two scans and little more.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tallyframe.operators.joins import union_all
from tallyframe.session import materialise

#: Hash groups; a table of so many numbers is all that the two sides exchange.
GROUPS = 1 << 16
_PART = 22


def _group(keys: Sequence[str], groups: int) -> Column:
    return F.pmod(F.xxhash64(*_told(keys)), F.lit(groups))


def _told(columns: Sequence[str]) -> list[Column]:
    """The columns and whether each is null: a hash passes nulls over, so that shifted values would hash alike."""
    return [c for name in columns for c in (F.col(f"`{name}`"), F.col(f"`{name}`").isNull())]


def checksums(df: DataFrame, keys: Sequence[str], groups: int = GROUPS) -> DataFrame:
    """Rows and checksum of each hash group of ``keys``, whatever the order of the rows.

    The checksum is the sum of the rows' 64-bit hashes, kept in parts of 22 bits so
    that it cannot overflow below some 10^12 rows of a group. Repeated rows count.
    """
    row = F.xxhash64(*_told(df.columns), F.lit(1))
    part = lambda k: F.sum(F.shiftrightunsigned("_row", k * _PART).bitwiseAND(F.lit((1 << _PART) - 1)))
    hashed = df.select(_group(keys, groups).alias("hash_group"), row.alias("_row"))
    return hashed.groupBy("hash_group").agg(
        F.count(F.lit(1)).alias("rows"), F.array(*[part(k) for k in range(3)]).alias("checksum")
    )


def differing_groups(old: DataFrame, new: DataFrame, keys: Sequence[str], groups: int = GROUPS) -> DataFrame:
    """Hash groups that are not the same in both tables; at most ``groups`` rows."""
    side = lambda df, name: checksums(df, keys, groups).select("hash_group", F.struct("rows", "checksum").alias(name))
    both = side(old, "old").join(side(new, "new"), "hash_group", "full")
    return both.where(~F.col("old").eqNullSafe(F.col("new"))).select("hash_group")


def row_difference(old: DataFrame, new: DataFrame, keys: Sequence[str], groups: int = GROUPS) -> DataFrame:
    """One row per key whose rows differ: kind, rows lost and added, and the columns changed.

    ``lost`` and ``added`` keys have rows on one side more only; a key with one row lost
    and one added has ``changed``, and the names of the columns say in what; any
    other is ``several``. Equal rows cancel out, repeated ones as often as they occur on
    both sides. Nulls are equal to each other, in keys too. The tables must have the
    same columns, in any order; those of ``new`` are cast to the types of ``old``.
    """
    if sorted(old.columns) != sorted(new.columns):
        raise ValueError(f"different columns: {sorted(set(old.columns) ^ set(new.columns))}")
    columns, rest = old.columns, [c for c in old.columns if c not in keys]
    new = new.select(*[F.col(f"`{f.name}`").cast(f.dataType).alias(f.name) for f in old.schema])
    hit = materialise(differing_groups(old, new, keys, groups), "differing-groups")

    def suspects(df: DataFrame, sign: int) -> DataFrame:
        placed = df.withColumn("_hash_group", _group(keys, groups)).withColumn("_sign", F.lit(sign))
        return placed.join(F.broadcast(hit), F.col("_hash_group") == F.col("hash_group"), "left_semi").drop("_hash_group")

    counted = union_all([suspects(old, 1), suspects(new, -1)]).groupBy(*columns).agg(F.sum("_sign").alias("_more"))
    lost, added = F.col("_more") > 0, F.col("_more") < 0
    values = F.struct(*[F.col(f"`{c}`") for c in rest], F.lit(0).alias("_"))
    per_key = counted.where("_more <> 0").groupBy(*keys).agg(
        F.sum(F.when(lost, F.col("_more")).otherwise(0)).alias("rows_lost"),
        F.sum(F.when(added, -F.col("_more")).otherwise(0)).alias("rows_added"),
        F.first(F.when(lost, values), ignorenulls=True).alias("_old"),
        F.first(F.when(added, values), ignorenulls=True).alias("_new"),
    )
    one_each = (F.col("rows_lost") == 1) & (F.col("rows_added") == 1)
    kind = (
        F.when(one_each, "changed").when(F.col("rows_added") == 0, "lost").when(F.col("rows_lost") == 0, "added").otherwise("several")
    )
    named = [F.when(~F.col("_old")[c].eqNullSafe(F.col("_new")[c]), F.lit(c)) for c in rest]
    return per_key.select(
        *keys, kind.alias("kind"), "rows_lost", "rows_added",
        F.when(one_each, F.concat_ws(", ", *named)).alias("changed_columns"),
    )
