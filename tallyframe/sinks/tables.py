"""Table outputs."""

from __future__ import annotations

import json
import uuid
from collections.abc import Sequence
from dataclasses import asdict, dataclass

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from tallyframe.sources import CountMismatch

TIERS = ("aggregates", "restricted")
KEPT_VERSIONS = 2


#: Source bytes for each bucket of a clustered table, and for each while there are fewer buckets than cores.
BUCKET_BYTES, LEAST_BUCKET_BYTES = 128 << 20, 8 << 20
LAYOUT_FILE = "_layout.json"  # Spark does not read files whose name begins so


@dataclass(frozen=True)
class Clustering:
    """Rows with equal ``keys`` in one bucket, sorted by ``sort_by``; one file for each bucket and partition.

    Grouping by the keys, or by more columns than them, needs no shuffle. All
    rows of a key are read by one task, so the keys must not be hotter than a
    task can take: choose keys whose rows are bounded.
    """

    keys: tuple[str, ...]
    buckets: int
    sort_by: tuple[str, ...]


class PublishError(RuntimeError):
    """Another writer published the version that this one meant to."""


def _folder(spark: SparkSession, path: str):
    """A Hadoop path and its file system."""
    sc = spark.sparkContext
    folder = sc._jvm.org.apache.hadoop.fs.Path(path)
    return folder, folder.getFileSystem(sc._jsc.hadoopConfiguration())


def versions(spark: SparkSession, path: str) -> list[str]:
    """Paths of the published versions of a table, oldest first."""
    folder, files = _folder(spark, path)
    if not files.exists(folder):
        return []
    names = [f.getPath().getName() for f in files.listStatus(folder) if f.isDirectory()]
    return [f"{path}/{n}" for n in sorted(names) if n.startswith("version-")]


def current_version(spark: SparkSession, path: str) -> str:
    """The path that readers of a table should use: its newest published version."""
    published = versions(spark, path)
    if not published:
        raise FileNotFoundError(f"no version of a table at {path}")
    return published[-1]


def write_text(spark: SparkSession, path: str, text: str) -> None:
    """Write one small text file, replacing it."""
    file, files = _folder(spark, path)
    out = files.create(file, True)
    out.write(bytearray(text, "utf-8"))
    out.close()


def buckets_for(spark: SparkSession, source: str) -> int:
    """Buckets for a table made from the files below ``source``: as many as follow from its size, and enough for all cores."""
    folder, files = _folder(spark, source)
    size = files.getContentSummary(folder).getLength()
    busy = min(spark.sparkContext.defaultParallelism, -(-size // LEAST_BUCKET_BYTES))
    return max(1, busy, -(-size // BUCKET_BYTES))


def _write_clustered(writer, path: str, partition_by: Sequence[str], cluster: Clustering) -> None:
    """Bucketed files can only be written through the catalogue; its entry goes at once, the files stay."""
    spark, name = writer._spark, f"pending_{uuid.uuid4().hex}"
    writer = writer.format("parquet").option("path", path).bucketBy(cluster.buckets, *cluster.keys).sortBy(*cluster.sort_by)
    (writer.partitionBy(*partition_by) if partition_by else writer).saveAsTable(name)
    spark.sql(f"DROP TABLE {name}")
    write_text(spark, f"{path}/{LAYOUT_FILE}", json.dumps(asdict(cluster) | {"partition_by": list(partition_by)}))


def replace_table(
    df: DataFrame, path: str, partition_by: Sequence[str] = (), expected_rows: int | None = None, cluster: Clustering | None = None
) -> int:
    """Write a new version of the Parquet table at ``path``, check it, publish it; returns its rows.

    The version is written aside, and becomes visible by one rename after its
    rows have been counted. If the write or the count fails, the old version
    stays. The newest ``KEPT_VERSIONS`` remain for readers that still use one.

    The rows are counted by the writing tasks themselves, so there is no second
    pass, and a stage that is run again for a lost executor counts once.
    With ``partition_by``, rows of a partition are brought together first;
    adaptive execution splits a large partition over several files. With
    ``cluster``, rows are shuffled into its buckets; ``read_clustered`` finds them.
    """
    spark = df.sparkSession
    if cluster:
        df = df.repartition(cluster.buckets, *cluster.keys)
    elif partition_by:
        df = df.hint("rebalance", *partition_by)
    seen = Observation()
    pending = f"{path}/.pending-{uuid.uuid4().hex}"
    aside, files = _folder(spark, pending)
    try:
        writer = df.observe(seen, F.count(F.lit(1)).alias("rows")).write
        if cluster:
            _write_clustered(writer, pending, partition_by, cluster)
        else:
            (writer.partitionBy(*partition_by) if partition_by else writer).parquet(pending)
        rows = seen.get["rows"]
        if expected_rows is not None and rows != expected_rows:
            raise CountMismatch(f"wrote {rows:,} rows where {expected_rows:,} were due", rows)
        published = versions(spark, path)
        number = 1 + int(published[-1].rpartition("-")[2]) if published else 1
        target, _ = _folder(spark, f"{path}/version-{number:08d}")
        if files.exists(target) or not files.rename(aside, target):
            raise PublishError(f"version {number} of {path} exists already")
    except Exception:
        files.delete(aside, True)
        raise
    for old in published[: max(0, len(published) + 1 - KEPT_VERSIONS)]:
        files.delete(_folder(spark, old)[0], True)
    return rows


def read_table(spark: SparkSession, path: str, schema: StructType | None = None) -> DataFrame:
    """The newest version of a stored table, with its columns in the order of ``schema`` if that is given."""
    stored = current_version(spark, path)
    return spark.read.parquet(stored) if schema is None else spark.read.schema(schema).parquet(stored).select(*schema.names)


def read_clustered(spark: SparkSession, name: str, path: str, schema: StructType) -> DataFrame:
    """The newest version of a clustered table, as a catalogue table ``name``, which tells Spark the buckets.

    The catalogue only points to the files; the entry of an older version is replaced.
    """
    stored = current_version(spark, path)
    file, files = _folder(spark, f"{stored}/{LAYOUT_FILE}")
    stream = files.open(file)
    layout = json.loads(spark.sparkContext._jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8"))
    stream.close()
    listed = lambda names: ", ".join(f"`{n}`" for n in names)
    columns = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in schema)
    partitions = f"PARTITIONED BY ({listed(layout['partition_by'])})" if layout["partition_by"] else ""
    location = stored.replace("'", "\\'")
    spark.sql(f"DROP TABLE IF EXISTS {name}")
    spark.sql(
        f"CREATE TABLE {name} ({columns}) USING parquet {partitions} CLUSTERED BY ({listed(layout['keys'])})"
        f" SORTED BY ({listed(layout['sort_by'])}) INTO {layout['buckets']} BUCKETS LOCATION '{location}'"
    )
    if partitions:
        spark.sql(f"ALTER TABLE {name} RECOVER PARTITIONS")
    return spark.table(name).select(*schema.names)


def write_csv(df: DataFrame, path: str) -> None:
    df.write.mode("overwrite").option("header", True).csv(path)


def write_tier(df: DataFrame, root: str, tier: str, name: str) -> int:
    """Write a result below its access tier as Parquet and as CSV.

    The two formats have folders of their own. The CSV is made from the Parquet
    files, so the result is computed once.
    """
    if tier not in TIERS:
        raise ValueError(f"tier must be one of {TIERS}")
    base = f"{root}/{tier}/{name}"
    rows = replace_table(df, f"{base}/parquet")
    write_csv(read_table(df.sparkSession, f"{base}/parquet", df.schema), f"{base}/csv")
    return rows


def save_table(df: DataFrame, name: str, bucket_by: Sequence[str] = (), buckets: int = 0) -> None:
    """Replace a catalogue table; bucketed tables join on their keys unshuffled."""
    writer = df.write.mode("overwrite").format("parquet")
    if buckets:
        writer = writer.bucketBy(buckets, *bucket_by).sortBy(*bucket_by)
    writer.saveAsTable(name)


def analysed_table(spark: SparkSession, name: str, path: str, schema: StructType) -> DataFrame:
    """The newest version of a stored table as a table of the catalogue, with statistics for join planning.

    The catalogue only points to the files; the entry of an older version is replaced.
    """
    columns = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in schema)
    spark.sql(f"DROP TABLE IF EXISTS {name}")
    location = current_version(spark, path).replace("'", "\\'")
    spark.sql(f"CREATE TABLE {name} ({columns}) USING parquet LOCATION '{location}'")
    refresh_statistics(spark, name)
    return spark.table(name)


def refresh_statistics(spark: SparkSession, *tables: str) -> None:
    """Row, size and column statistics of saved tables, for join planning."""
    for table in tables:
        spark.sql("ANALYZE TABLE IDENTIFIER(:name) COMPUTE STATISTICS FOR ALL COLUMNS", args={"name": table})
