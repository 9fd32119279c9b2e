"""Reference checks and star-schema joins.

No join here carries a broadcast hint: tables read from Parquet have real sizes,
so Spark broadcasts a side only below ``spark.sql.autoBroadcastJoinThreshold``
and otherwise shuffles it, splitting skewed keys at run time.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def with_keys(df: DataFrame, keys: Mapping[str, Column]) -> DataFrame:
    """Add cleaned key columns, so that joins on them are plain equi-joins."""
    return df.withColumns(dict(keys))


def orphans(child: DataFrame, parent: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Child rows without a parent; a null key has none."""
    return child.join(parent.select(*keys), list(keys), "left_anti")


def orphan_counts(
    child: DataFrame, parent: DataFrame, keys: Sequence[str], groups: Sequence[str] = (), name: str = "unmatched_records"
) -> DataFrame:
    """Number of child rows without a parent, in total or per group.

    Child rows are counted per key before the join, so a hot key is one row of it.
    """
    wanted = list(dict.fromkeys([*keys, *groups]))
    per_key = child.groupBy(*wanted).agg(F.count(F.lit(1)).alias("_rows"))
    counted = orphans(per_key, parent, keys).groupBy(*groups).agg(F.sum("_rows").alias(name))
    return counted if groups else counted.select(F.coalesce(name, F.lit(0)).alias(name))


def has_orphans(child: DataFrame, parent: DataFrame, keys: Sequence[str], name: str = "has_orphans") -> DataFrame:
    """One row: 1 if some child row lacks a parent, else 0. Each task stops at the first one it meets."""
    found = orphans(child.select(*keys), parent, keys).limit(1)
    return found.agg(F.count(F.lit(1)).cast("int").alias(name))


def star_lookup(
    source: DataFrame, dims: Sequence[tuple[DataFrame, Sequence[str], str]], how: str = "inner"
) -> DataFrame:
    """Join each ``(dimension, natural key, surrogate key)`` to fetch its key."""
    for dim, keys, key_column in dims:
        source = source.join(dim.select(*keys, key_column), list(keys), how)
    return source


def star_denormalise(fact: DataFrame, dims: Sequence[tuple[DataFrame, str, Sequence[str]]]) -> DataFrame:
    """Replace each surrogate key by the named columns of its dimension."""
    for dim, key_column, labels in dims:
        fact = fact.join(dim.select(key_column, *labels), key_column).drop(key_column)
    return fact


def star_audit(fact: DataFrame, dims: Sequence[tuple[DataFrame, str, str]]) -> DataFrame:
    """One row with the number of fact rows unmatched in each dimension.

    ``dims`` holds ``(dimension, key column, result column)``. The fact is first
    counted per key, one dimension at a time, so no join sees its full rows.
    """
    parts = [
        orphan_counts(fact, dim, [key], name="unmatched").select(F.lit(name).alias("dimension"), "unmatched")
        for dim, key, name in dims
    ]
    return spread(union_all(parts), "dimension", "unmatched", [name for _, _, name in dims])


def union_all(parts: Sequence[DataFrame]) -> DataFrame:
    """Union by name, joined in pairs so that long unions stay cheap to plan."""
    parts = list(parts)
    while len(parts) > 1:
        pairs = [parts[i : i + 2] for i in range(0, len(parts), 2)]
        parts = [p[0].unionByName(p[1]) if len(p) == 2 else p[0] for p in pairs]
    return parts[0]


def spread(df: DataFrame, label: str, value: str, names: Sequence[str]) -> DataFrame:
    """One row with a column per label: scalar results side by side."""
    return df.agg(*[F.max(F.when(F.col(label) == n, F.col(value))).alias(n) for n in names])
