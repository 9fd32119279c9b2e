"""Sharding by fixed virtual slots.

A record's key is hashed into one of some thousands of slots, for good. Bytes
and rows are summed per slot, and a versioned table maps slots to shards.
Rebalancing edits that table: it writes a new version in which as few bytes as
it can have moved. Data are looked up through one version and never rehashed.

A position inside a shard is the rows of the shard's earlier slots plus the
position inside the slot, so no shard is ever gathered in one task.

Defined results: a null key is hashed as empty text, a null text has no bytes.
Rows of equal key share a slot, unless that key alone holds more than
``HEAVY`` of a shard's mean bytes: its rows are spread over all slots by key,
text and place in the input. Equal rows are told apart by their order only.
Empty input gives no rows. Columns other than the key and text are ignored.
"""

from __future__ import annotations

import heapq

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tallyframe.session import materialise, scratch

SLOTS = 8192
SHARDS = 40
ROW_BYTES = 16
#: Part of a shard's mean bytes above which a slot is searched for heavy keys; there are at most ``shards / HEAVY`` of either.
HEAVY = 0.02
MAP_SCHEMA = "version int, vslot int, shard int, bytes bigint, rows bigint"


def slot_of(key: Column, slots: int = SLOTS) -> Column:
    """The slot of a key: the first 32 bits of its MD5, modulo the number of slots."""
    digest = F.md5(F.coalesce(key.cast("string"), F.lit("")).cast("binary"))
    return (F.conv(F.substring(digest, 1, 8), 16, 10).cast("long") % slots).cast("int")


def sized(docs: DataFrame, key: str = "doc_id", text: str = "text", slots: int = SLOTS) -> DataFrame:
    """Key, size, text checksum and slot of each record."""
    utf8 = F.coalesce(F.col(f"`{text}`"), F.lit("")).cast("binary")
    return docs.select(
        F.col(f"`{key}`").alias(key),
        (F.octet_length(utf8) + ROW_BYTES).cast("long").alias("size"),
        F.crc32(utf8).alias("text_crc32"),
        slot_of(F.col(f"`{key}`"), slots).alias("vslot"),
    )


def slot_loads(records: DataFrame) -> DataFrame:
    """Bytes and rows per slot; at most one row per slot."""
    return records.groupBy("vslot").agg(F.sum("size").alias("bytes"), F.count(F.lit(1)).alias("rows"))


def spread(records: DataFrame, loads: dict[int, int], shards: int, key: str = "doc_id", slots: int = SLOTS) -> DataFrame:
    """``records`` with the rows of heavy keys over all slots; ``loads`` are the bytes per slot.

    ``records`` must be stored and have the column ``_at``, a number for each row.
    """
    bound = sum(loads.values()) / shards * HEAVY
    full = [slot for slot, size in loads.items() if size > bound]
    inside = records.filter(F.col("vslot").isin(full)) if full else records.limit(0)
    keys = inside.groupBy(F.col(f"`{key}`").alias("_key")).agg(F.sum("size").alias("_bytes"), F.count(F.lit(1)).alias("_rows"))
    heavy = keys.filter((F.col("_bytes") > bound) & (F.col("_rows") > 1)).select("_key", F.lit(True).alias("_heavy"))
    anew = slot_of(F.concat_ws(" ", F.col(f"`{key}`").cast("string"), "text_crc32", "_at"), slots)
    return records.join(F.broadcast(heavy), F.col(f"`{key}`").eqNullSafe(F.col("_key")), "left").select(
        *[F.col(f"`{c}`") for c in records.columns if c != "vslot"], F.when(F.col("_heavy"), anew).otherwise(F.col("vslot")).alias("vslot")
    )


def bytes_by_slot(loads: DataFrame) -> dict[int, tuple[int, int]]:
    """Bytes and rows of each slot; one row per slot at most comes to the driver."""
    return {r.vslot: (r.bytes, r.rows) for r in loads.collect()}


def assign(loads: dict[int, int], shards: int) -> dict[int, int]:
    """A first map: the heaviest slot goes to the lightest shard, ties to the lower number."""
    heap, placed = [(0, k) for k in range(shards)], {}
    for slot, size in sorted(loads.items(), key=lambda x: (-x[1], x[0])):
        total, shard = heapq.heappop(heap)
        placed[slot] = shard
        heapq.heappush(heap, (total + size, shard))
    return placed


def rebalance(placed: dict[int, int], loads: dict[int, int], shards: int, tolerance: float = 0.02) -> dict[int, int]:
    """An edited map for ``shards`` shards and new loads.

    Slots of removed shards are placed again. After that slots move from the
    heaviest to the lightest shard until it is within ``tolerance`` of the
    mean, or no slot there would make the larger of the two smaller. All else stays.
    """
    totals, members = [0] * shards, [set() for _ in range(shards)]
    homeless = []
    for slot, size in sorted(loads.items(), key=lambda x: (-x[1], x[0])):
        shard = placed.get(slot, shards)
        if shard < shards:
            totals[shard] += size
            members[shard].add(slot)
        else:
            homeless.append(slot)
    for slot in homeless:
        shard = min(range(shards), key=lambda k: (totals[k], k))
        totals[shard] += loads[slot]
        members[shard].add(slot)
    mean = sum(totals) / shards
    for _ in range(len(loads)):
        high = max(range(shards), key=lambda k: (totals[k], -k))
        low = min(range(shards), key=lambda k: (totals[k], k))
        gap = totals[high] - totals[low]
        fits = [s for s in members[high] if 0 < loads[s] < gap]
        if totals[high] <= mean * (1 + tolerance) or not fits:
            break
        slot = min(fits, key=lambda s: (abs(2 * loads[s] - gap), s))
        members[high].remove(slot)
        members[low].add(slot)
        totals[high] -= loads[slot]
        totals[low] += loads[slot]
    return {slot: shard for shard, slots in enumerate(members) for slot in slots}


class SlotMap:
    """Versions of a slot-to-shard map below one folder; a row per used slot and version."""

    def __init__(self, spark: SparkSession, path: str):
        self.spark, self.path = spark, path

    def write(self, version: int, placed: dict[int, int], loads: dict[int, tuple[int, int]]) -> None:
        rows = [(version, s, placed[s], *loads[s]) for s in sorted(placed)]
        self.spark.createDataFrame(rows, MAP_SCHEMA).coalesce(1).write.mode("errorifexists").parquet(f"{self.path}/v{version}")

    def read(self, version: int) -> DataFrame:
        return self.spark.read.schema(MAP_SCHEMA).parquet(f"{self.path}/v{version}")


def grow(spark: SparkSession, slot_map: SlotMap, version: int, loads: DataFrame, shards: int) -> int:
    """Store the next version for ``shards`` shards and the loads given; returns its number."""
    old = {r.vslot: r.shard for r in slot_map.read(version).collect()}
    sizes = bytes_by_slot(loads)
    placed = rebalance(old, {s: b for s, (b, _) in sizes.items()}, shards)
    slot_map.write(version + 1, placed, sizes)
    return version + 1


def shard(docs: DataFrame, key: str = "doc_id", text: str = "text", shards: int = SHARDS, slots: int = SLOTS, path: str | None = None) -> DataFrame:
    """Shard and gapless position of every record, through version 0 of a map stored at ``path``."""
    spark = docs.sparkSession
    records = materialise(sized(docs, key, text, slots).withColumn("_at", F.monotonically_increasing_id()), "slots")
    loads = bytes_by_slot(slot_loads(records))
    records = spread(records, {s: b for s, (b, _) in loads.items()}, shards, key, slots)
    loads = bytes_by_slot(slot_loads(records))
    if path is None:
        path = scratch(spark, "slot-map")
    slot_map = SlotMap(spark, path)
    slot_map.write(0, assign({s: b for s, (b, _) in loads.items()}, shards), loads)
    before = Window.partitionBy("shard").orderBy("vslot").rowsBetween(Window.unboundedPreceding, -1)
    offsets = slot_map.read(0).select("vslot", "shard", F.coalesce(F.sum("rows").over(before), F.lit(0)).alias("offset"))
    within = Window.partitionBy("vslot").orderBy(key, "size", "text_crc32")
    return (
        records.withColumn("place", F.row_number().over(within) - 1)
        .join(F.broadcast(offsets), "vslot")  # at most one row per slot
        .select(key, "size", "text_crc32", "vslot", "shard", (F.col("offset") + F.col("place")).cast("long").alias("slot"))
    )
