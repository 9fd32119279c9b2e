"""Helpers that several operators share."""

from __future__ import annotations

from collections.abc import Callable, Iterator, Sequence

import pyarrow as pa
import pyarrow.compute as pc
from pyspark import Broadcast, SparkContext, cloudpickle
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

#: White space of the word rule `[^\x20\x09-\x0D]+`.
SPACES = " \t\n\x0b\f\r"
SPACE_RUN = r"[\x20\x09-\x0D]+"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def ship(sc: SparkContext, value: object) -> Broadcast:
    """A broadcast of ``value`` by its contents, classes of this package included, for ``received``."""
    return sc.broadcast({"pickled": cloudpickle.dumps(value)})


def received(shared: Broadcast) -> object:
    """The value that was shipped; a worker process makes it once."""
    held = shared.value
    if "value" not in held:
        held["value"] = cloudpickle.loads(held.pop("pickled"))
    return held["value"]


def let(value: Column, body: Callable[[Column], Column]) -> Column:
    """``body`` of ``value``, which is computed once however often ``body`` names it."""
    return F.get(F.transform(F.array(value), body), F.lit(0))


def space_words(text: Column) -> Column:
    """Words between white space; an empty array for null and blank texts."""
    return let(
        F.btrim(F.coalesce(text, F.lit("")), F.lit(SPACES)),
        lambda t: F.when(t == "", F.array().cast("array<string>")).otherwise(F.split(t, SPACE_RUN)),
    )


def as_bytes(column: pa.Array) -> list[bytes | None]:
    """The UTF-8 bytes of a string column, without decoding it."""
    return column.cast(pa.large_binary() if pa.types.is_large_string(column.type) else pa.binary()).to_pylist()


#: Text that is worked on at once, and so bounds what a task holds beside its batch; at least one row.
PIECE_BYTES = 8 << 20


def sizes_of(column: pa.Array) -> list[int]:
    """Bytes of each text, or values of each list; 0 for null."""
    length = pc.list_value_length if pa.types.is_list(column.type) else pc.binary_length
    return pc.fill_null(length(column), 0).to_pylist()


def add_columns(
    docs: DataFrame,
    text: str,
    keep: list[str],
    schema: str,
    start: Callable[[], Callable[[pa.RecordBatch], list[pa.Array]]],
    also: tuple[str, ...] = (),
    piece_bytes: int = PIECE_BYTES,
) -> DataFrame:
    """The columns ``keep`` and those of ``schema``, which a task makes out of Arrow batches.

    ``start`` is called once in each task and returns the function of a batch.
    Batches hold ``keep``, the text and the columns ``also``, and about
    ``piece_bytes`` of text. A kept column named like a new one is replaced by it.
    """
    new = T.StructType.fromDDL(schema)
    keep = [c for c in keep if c not in new.names]
    sent = list(dict.fromkeys([*keep, text, *also]))
    frame = docs.select(*[F.col(f"`{c}`") for c in sent])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        work = start()
        for batch in batches:
            for part in groups_of(range(batch.num_rows), sizes_of(batch.column(text)), piece_bytes):
                piece = batch.slice(part.start, part.stop - part.start)
                yield pa.RecordBatch.from_arrays([piece.column(c) for c in keep] + work(piece), keep + new.names)

    return frame.mapInArrow(run, T.StructType([frame.schema[c] for c in keep] + new.fields))


def groups_of(items: Sequence, sizes: list[int], limit: int) -> Iterator[slice]:
    """Slices of ``items`` whose sizes sum to about ``limit``, at least one item each."""
    start = total = 0
    for k, size in enumerate(sizes):
        if k > start and total + size > limit:
            yield slice(start, k)
            start, total = k, 0
        total += size
    if start < len(items):
        yield slice(start, len(items))


#: Bytes with white space as one kind of space.
_PLAIN = bytes(32 if 9 <= b <= 13 else b for b in range(256))
PIECE = 1 << 20


def word_pieces(text: bytes, signs: bytes = _PLAIN) -> Iterator[list[bytes]]:
    """The words of a text mapped by the table ``signs``, about a megabyte of text at a time."""
    text, start = text.translate(signs), 0
    while start < len(text):
        end = text.find(b" ", start + PIECE)
        end = len(text) if end < 0 else end
        yield text[start:end].split()
        start = end
