"""Exact k-means on integer vectors, sharded by dimension.

Vectors become integers once and are cut into column blocks; a chunk of vectors
has one slice for each block. A block's tasks hold only slices of that block
and the matching slice of the centroids:

1. each task computes the exact partial distances of its slices;
2. ``reduceByKey`` adds the blocks of a chunk, and the argmin labels it;
3. labels go back to the blocks, which sum their own columns for each cluster
   and floor-divide: each block makes its own slice of the next centroids.

The driver holds centroids and counts only (clusters times dimensions); it never
sees vectors, labels or distances. Slices are written once, so that every round
and every repeated task sees the same chunks. No round depends on the data of an
earlier one but through the centroids, so lineage does not grow.

Numbers are whole and exact: they are 64-bit as long as no squared distance can
pass that, else Python's integers of any size.

Defined results: vectors that are null, of another length, or hold a null, NaN
or infinite component are left out. Equal rows are vectors of their own. Starting
centroids are distinct rows, not distinct values; where ids repeat, the smaller
vector comes first, and a null id is hashed as empty text. With fewer vectors
than clusters there are fewer centroids; an empty table gives no rows. A
distance or inertia beyond 64 bits is null. Other columns are ignored.
"""

from __future__ import annotations

import hashlib
import math
from collections.abc import Iterator
from fractions import Fraction
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark import RDD, TaskContext
from pyspark.sql import DataFrame, Row
from pyspark.sql import functions as F

from tallyframe.session import materialise

CLUSTERS, ROUNDS, SCALE, SEED = 8, 10, 1024, "3"
#: Vectors of a chunk, columns of a block, and bytes of slices that a task is meant to hold.
CHUNK, BLOCK, TASK_BYTES = 4096, 16, 32 << 20
_SLICES = "chunk bigint, block int, wide boolean, values binary, ids binary"
_ASSIGNED = "id {}, cluster int, distance bigint"


class Clusters(NamedTuple):
    """The vectors with cluster and squared distance, and the final centroids."""

    assigned: DataFrame
    centroids: list[list[int]]


def whole(values: np.ndarray, scale: int) -> np.ndarray:
    """``floor(scale * x)`` of doubles: 64-bit if all are well inside that, else Python's integers."""
    scaled = np.floor(values * float(scale))
    if (np.abs(scaled) < 2.0**52).all() and scale & (scale - 1) == 0:
        return scaled.astype(np.int64)
    exact = [math.floor(Fraction(x) * scale) for x in values.ravel().tolist()]
    return np.array(exact, object).reshape(values.shape)


def packed(values: np.ndarray) -> bytes:
    """Whole numbers in the fewest bytes each; text if they need more than 64 bits."""
    if values.dtype == object:
        return " ".join(map(str, values.ravel())).encode()
    top = int(np.abs(values).max(initial=0))
    kind = next(k for k in ("<i2", "<i4", "<i8") if top < 1 << (8 * int(k[2]) - 1))
    return kind.encode() + values.astype(kind).tobytes()


def unpacked(data: bytes, wide: bool, columns: int) -> np.ndarray:
    if wide:
        return np.array([int(x) for x in data.split()], object).reshape(-1, columns)
    return np.frombuffer(data, data[:3].decode(), offset=3).astype(np.int64).reshape(-1, columns)


def cut(kept: DataFrame, dimensions: int, scale: int) -> DataFrame:
    """A row for each chunk and column block; the first block's row carries the ids."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part, count = TaskContext.get().partitionId(), 0
        for batch in batches:
            for start in range(0, batch.num_rows, CHUNK):
                piece = batch.slice(start, CHUNK)
                vectors = whole(piece.column(1).flatten().to_numpy(zero_copy_only=False).reshape(-1, dimensions), scale)
                ids = pa.BufferOutputStream()
                column = pa.RecordBatch.from_arrays([piece.column(0)], ["id"])
                with pa.ipc.new_stream(ids, column.schema) as out:
                    out.write_batch(column)
                wide, chunk = vectors.dtype == object, (part << 28 | count) ^ part
                slices = [packed(vectors[:, c : c + BLOCK]) for c in range(0, dimensions, BLOCK)]
                n, count = len(slices), count + 1
                columns = [[chunk] * n, list(range(n)), [wide] * n, slices, [ids.getvalue().to_pybytes()] + [None] * (n - 1)]
                kinds = (pa.int64(), pa.int32(), pa.bool_(), pa.binary(), pa.binary())
                arrays = [pa.array(c, t) for c, t in zip(columns, kinds, strict=True)]
                yield pa.RecordBatch.from_arrays(arrays, ["chunk", "block", "wide", "values", "ids"])

    return kept.mapInArrow(run, _SLICES)


def fits(values: np.ndarray, centroids: np.ndarray, dimensions: int) -> bool:
    """Whether no squared distance over all dimensions can pass 64 bits."""
    if values.dtype == object or centroids.dtype == object:
        return False
    top = max(int(np.abs(values).max(initial=0)), int(np.abs(centroids).max(initial=0)))
    return dimensions * (2 * top) ** 2 < 1 << 62


def partial(values: np.ndarray, centroids: np.ndarray, dimensions: int) -> np.ndarray:
    """Squared distances of each vector to each centroid in these columns."""
    if not fits(values, centroids, dimensions):
        values, centroids = values.astype(object), centroids.astype(object)
    out = np.empty((len(values), len(centroids)), values.dtype)
    for k, centre in enumerate(centroids):
        difference = values - centre
        out[:, k] = (difference * difference).sum(axis=1)
    return out


def slim(values: np.ndarray) -> np.ndarray:
    """The same numbers in 32 bits if they fit, for the shuffle."""
    return values.astype(np.int32) if values.dtype != object and values.max(initial=0) < 1 << 31 else values


def roomy(values: np.ndarray) -> np.ndarray:
    return values if values.dtype == object else values.astype(np.int64)


def add(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    return slim(roomy(a) + roomy(b))


def as_matrix(rows: list[list[int]]) -> np.ndarray:
    small = all(abs(x) < 1 << 62 for row in rows for x in row)
    return np.array(rows, np.int64 if small else object)


class _Sharded(NamedTuple):
    """Slices keyed by chunk and block, block by block in the partitions, and how many partitions each has."""

    slices: RDD
    widths: list[int]
    groups: int

    def distances(self, centroids: list[list[int]]) -> RDD:
        """Of each chunk, the distances of its vectors to all centroids: blocks added up."""
        blocks, dimensions = len(self.widths), sum(self.widths)
        parts = self.centroid_slices(centroids)

        def of(item: tuple) -> tuple:
            key, (wide, data) = item
            block = key % blocks
            values = unpacked(data, wide, len(parts[block][0]))
            return key // blocks, slim(partial(values, as_matrix(parts[block]), dimensions))

        return self.slices.map(of).reduceByKey(add, self.groups)

    def centroid_slices(self, centroids: list[list[int]]) -> list[list[list[int]]]:
        starts = np.cumsum([0, *self.widths]).tolist()
        return [[row[a:b] for row in centroids] for a, b in zip(starts, starts[1:], strict=False)]

    def moved(self, centroids: list[list[int]]) -> list[list[int]]:
        """The next centroids; each block makes its own slice of them."""
        blocks, k = len(self.widths), len(centroids)
        parts = self.centroid_slices(centroids)
        label_kind = np.min_scalar_type(k)
        labels = self.distances(centroids).mapValues(lambda d: d.argmin(axis=1).astype(label_kind))
        to_blocks = labels.flatMap(lambda item: [(item[0] * blocks + b, item[1]) for b in range(blocks)])

        def sums(item: tuple) -> tuple:
            key, (slice_, label) = item
            block = key % blocks
            values = unpacked(slice_[1], slice_[0], len(parts[block][0]))
            if values.dtype != object and int(np.abs(values).max(initial=0)) > 1 << 40:
                values = values.astype(object)  # a chunk's sums stay far inside 64 bits
            totals = [[int(x) for x in values[label == c].sum(axis=0)] for c in range(k)]
            return block, (totals, [int((label == c).sum()) for c in range(k)])

        def both(a: tuple, b: tuple) -> tuple:
            return [[x + y for x, y in zip(p, q, strict=True)] for p, q in zip(a[0], b[0], strict=True)], [
                x + y for x, y in zip(a[1], b[1], strict=True)
            ]

        def new_slice(item: tuple) -> tuple:
            block, (totals, counts) = item
            rows = zip(totals, counts, parts[block], strict=True)
            return block, [[t // n for t in total] if n else old for total, n, old in rows]

        joined = self.slices.join(to_blocks, blocks * self.groups)
        made = dict(joined.map(sums).reduceByKey(both, blocks).map(new_slice).collect())
        return [sum((made[b][c] for b in range(blocks)), []) for c in range(k)]


def first_centroids(kept: DataFrame, clusters: int, seed: str, scale: int) -> list[list[int]]:
    """The vectors with the smallest hashes of seed and id."""
    digest = F.sha2(F.concat(F.lit(f"{seed}:"), F.coalesce(F.col("id").cast("string"), F.lit(""))), 256)
    chosen = kept.orderBy(digest, "vector").limit(clusters).collect()
    return [[int(x) for x in whole(np.array(r.vector, np.float64), scale)] for r in chosen]


def cluster(
    vectors: DataFrame,
    dimensions: int,
    id: str = "vec_id",
    vector: str = "embedding",
    clusters: int = CLUSTERS,
    rounds: int = ROUNDS,
    seed: str = SEED,
    scale: int = SCALE,
) -> Clusters:
    """Lloyd's rounds from ``clusters`` starting vectors, and one last assignment."""
    x = F.col(f"`{vector}`").cast("array<double>")
    odd = lambda v: v.isNull() | F.isnan(v) | (F.abs(v) == float("inf"))
    kept = vectors.select(F.col(f"`{id}`").alias("id"), x.alias("vector")).filter(
        F.coalesce(F.size("vector") == dimensions, F.lit(False)) & ~F.coalesce(F.exists("vector", odd), F.lit(True))
    )
    spark, schema = vectors.sparkSession, _ASSIGNED.format(kept.schema["id"].dataType.simpleString())
    centroids = first_centroids(kept, clusters, seed, scale)
    if not centroids:
        return Clusters(spark.createDataFrame([], schema), [])
    stored = materialise(cut(kept, dimensions, scale), "slices")
    widths = [min(BLOCK, dimensions - c) for c in range(0, dimensions, BLOCK)]
    blocks = len(widths)
    size = stored.agg(F.sum(F.octet_length("values"))).first()[0]
    groups = max(-(-spark.sparkContext.defaultParallelism // blocks), -(-size // (TASK_BYTES * blocks)))
    keyed = stored.select((F.col("chunk") * blocks + F.col("block")).alias("key"), "wide", "values").rdd
    slices = keyed.map(lambda r: (r[0], (r[1], bytes(r[2])))).partitionBy(blocks * groups)
    sharded = _Sharded(slices, widths, groups)
    for _ in range(rounds):
        centroids = sharded.moved(centroids)

    def labelled(item: tuple) -> Row:
        chunk, distances = item
        label = distances.argmin(axis=1)
        nearest = distances[np.arange(len(label)), label]
        small = [int(d) if d < 1 << 63 else None for d in nearest]
        return Row(chunk=chunk, clusters=label.astype("<i4").tobytes(), distances=small)

    made = spark.createDataFrame(sharded.distances(centroids).map(labelled), "chunk bigint, clusters binary, distances array<bigint>")
    ids = stored.filter("block = 0").select("chunk", "ids")

    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row in batch.to_pylist():
                column = pa.ipc.open_stream(row["ids"]).read_all().column(0).combine_chunks()
                label = pa.array(np.frombuffer(row["clusters"], "<i4"))
                yield pa.RecordBatch.from_arrays([column, label, pa.array(row["distances"], pa.int64())], ["id", "cluster", "distance"])

    assigned = ids.join(made, "chunk").select("ids", "clusters", "distances").mapInArrow(rows, schema)
    return Clusters(materialise(assigned, "clusters"), centroids)


def with_inertia(found: Clusters) -> DataFrame:
    """Each vector's row with the inertia of its cluster and of all, and its centroid's checksum."""
    sums = found.assigned.groupBy("cluster").agg(
        F.sum(F.col("distance").cast("decimal(38,0)")).alias("sum"), F.count_if(F.col("distance").isNull()).alias("unknown")
    )
    # One row for each cluster.
    totals = {r.cluster: None if r.unknown else int(r.sum) for r in sums.collect()}
    every = None if None in totals.values() else sum(totals.values())
    long = lambda n: n if n is not None and n < 1 << 63 else None
    digest = lambda row: hashlib.sha256(",".join(map(str, row)).encode()).hexdigest()
    facts = [(c, long(totals.get(c, 0)), long(every), digest(row)) for c, row in enumerate(found.centroids)]
    schema = "cluster int, cluster_inertia bigint, inertia bigint, centroid_sha256 string"
    # At most as many rows as clusters.
    return found.assigned.join(F.broadcast(found.assigned.sparkSession.createDataFrame(facts, schema)), "cluster")
