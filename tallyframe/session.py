"""Session defaults and lineage cutting."""

from __future__ import annotations

import atexit
import shutil
import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession

_local_roots: dict[str, str] = {}


def build_session(app_name: str = "tallyframe", master: str | None = None, **settings: str) -> SparkSession:
    """A session with adaptive execution on; ``settings`` use ``__`` for dots."""
    builder = (
        SparkSession.builder.appName(app_name)
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.adaptive.skewJoin.enabled", "true")
        .config("spark.sql.cbo.enabled", "true")
        .config("spark.sql.cbo.joinReorder.enabled", "true")
        .config("spark.sql.session.timeZone", "UTC")
    )
    if master:
        builder = builder.master(master)
    for name, value in settings.items():
        builder = builder.config(name.replace("__", "."), value)
    return builder.getOrCreate()


def checkpoint_root(spark: SparkSession) -> str:
    """The shared folder named by ``spark.checkpoint.dir``.

    A local session without the setting gets a folder that goes when Python
    ends. A cluster session without it is an error, since executors share no
    local disk.
    """
    configured = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    if configured:
        return configured
    if not spark.sparkContext.master.startswith("local"):
        raise RuntimeError("set spark.checkpoint.dir to a folder that all executors can reach")
    app = spark.sparkContext.applicationId
    if app not in _local_roots:
        _local_roots[app] = tempfile.mkdtemp(prefix="run-")
        atexit.register(shutil.rmtree, _local_roots[app], ignore_errors=True)
    return _local_roots[app]


def release(spark: SparkSession) -> None:
    """Delete this application's intermediate results, once nothing reads them any more."""
    sc = spark.sparkContext
    path = sc._jvm.org.apache.hadoop.fs.Path(f"{checkpoint_root(spark)}/{sc.applicationId}")
    path.getFileSystem(sc._jsc.hadoopConfiguration()).delete(path, True)


def scratch(spark: SparkSession, label: str) -> str:
    """A new path in this application's folder below the shared one."""
    return f"{checkpoint_root(spark)}/{spark.sparkContext.applicationId}/{label}-{uuid.uuid4().hex}"


def materialise(df: DataFrame, label: str) -> DataFrame:
    """Write ``df`` once as Parquet below the checkpoint folder and read it back.

    Used where several passes must see the same rows, or where the next join
    should be planned from real file sizes. The files survive lost executors.
    They lie in one folder per application, which can go once its results are
    stored elsewhere.
    """
    path = scratch(df.sparkSession, label)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)
