"""CSV scans with fixed schemas, header preflight and row-count gates."""

from __future__ import annotations

from collections.abc import Iterable, Mapping, Sequence
from concurrent.futures import ThreadPoolExecutor

from pyspark import inheritable_thread_target
from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StringType, StructField, StructType

from tallyframe.functions import null_markers
from tallyframe.schemas import SOURCES, SourceFile
from tallyframe.sources.generated import literal_rows


class CountMismatch(RuntimeError):
    """A table does not hold the number of rows it should; ``rows`` is what it holds, if one table is meant."""

    def __init__(self, message: str, rows: int | None = None):
        super().__init__(message)
        self.rows = rows


#: Header lines read at the same time.
HEADER_JOBS = 16
#: Column of staging tables with the text of a row that has too many or too few fields, else null.
MALFORMED = "_malformed"


def read_csv(
    spark: SparkSession,
    path: str,
    schema: StructType,
    null_columns: Sequence[str] | None = None,
    malformed: str | None = None,
    multi_line: bool = False,
) -> DataFrame:
    """CSV with a header and a declared schema; no inference pass over the data.

    The header of every file is compared with the schema during the scan, and a
    different one is an error. A doubled quote inside quotes is one quote. So is
    a row with too many or too few fields an error, unless ``malformed`` names a
    column that takes its text. ``multi_line`` allows line ends inside quotes,
    but then each file is read by one task.

    Text columns are returned as they stand. With ``null_columns``, the file is
    read as text, those columns turn markers and blanks into null, and each
    column is then cast to its declared type (null where the text does not fit;
    ``unparsable`` counts those).
    """
    reader = (
        spark.read.option("header", True)
        .option("quote", '"')
        .option("escape", '"')
        .option("encoding", "UTF-8")
        .option("enforceSchema", False)
        .option("columnPruning", False)
        .option("multiLine", multi_line)
        .option("mode", "PERMISSIVE" if malformed else "FAILFAST")
    )
    extra = [StructField(malformed, StringType())] if malformed else []
    if malformed:
        reader = reader.option("columnNameOfCorruptRecord", malformed)
    if null_columns is None:
        return reader.schema(StructType([*schema, *extra])).csv(path)
    text = reader.schema(StructType([*[StructField(f.name, StringType()) for f in schema], *extra])).csv(path)

    def typed(field: StructField) -> Column:
        c = null_markers(field.name) if field.name in null_columns else F.trim(F.col(field.name))
        return c.try_cast(field.dataType).alias(field.name)

    return text.select(*[typed(f) for f in schema], *[f.name for f in extra])


def load_staging(
    spark: SparkSession, data_dir: str, sources: Iterable[SourceFile] = SOURCES, malformed: str | None = MALFORMED
) -> dict[str, DataFrame]:
    """Every raw file as an all-text staging table, by table name.

    Blank fields come back as null, which counts as missing like the markers.
    Malformed rows stay, with their text in the column ``malformed``.
    """
    return {
        s.table: read_csv(spark, f"{data_dir}/{s.filename}", s.text_schema, malformed=malformed) for s in sources
    }


def _listed(spark: SparkSession, data_dir: str, names: Sequence[str]) -> dict[str, list[tuple[str, int]]]:
    """Paths and sizes of the files of each name, a row per file; none for a missing folder."""
    files = (
        spark.read.format("binaryFile")
        .option("recursiveFileLookup", True)
        .load(data_dir)
        .select("path", "length", F.explode(F.array_distinct(F.split("path", "/"))).alias("name"))
        .where(F.col("name").isin(*names))
    )
    found: dict[str, list[tuple[str, int]]] = {}
    for row in files.orderBy("path").collect():
        found.setdefault(row["name"], []).append((row["path"], row["length"]))
    return found


def preflight(spark: SparkSession, data_dir: str, sources: Sequence[SourceFile] = SOURCES) -> DataFrame:
    """One row per expected file: is it there, and is its header as expected?

    A "file" may be a folder of part files, as a large export would be; then the
    header of each part counts, and the first wrong one is shown. Sizes come
    from a listing of the folder. Only header lines are read, those of
    ``HEADER_JOBS`` parts at a time; one scan of all parts would have to read
    their first blocks whole. In a missing folder all files are missing.
    """
    try:
        listed = _listed(spark, data_dir, [s.filename for s in sources])
    except AnalysisException as error:
        if error.getCondition() != "PATH_NOT_FOUND":
            raise
        listed = {}
    wanted = [p for s in sources for p, n in listed.get(s.filename, ()) if n]
    read = inheritable_thread_target(spark)(lambda p: ",".join(spark.read.option("header", True).csv(p).columns))
    with ThreadPoolExecutor(HEADER_JOBS) as pool:
        headers = dict(zip(wanted, pool.map(read, wanted), strict=True))
    rows = []
    for s in sources:
        expected, found, status, size = ",".join(s.columns), None, "MISSING", None
        if parts := listed.get(s.filename):
            size = sum(n for _, n in parts)
            found = next((headers[p] for p, n in parts if n and headers[p] != expected), expected if size else "")
            status = "OK" if found == expected else "INVALID COLUMNS"
        rows.append((s.filename, status, expected, found, size, None if size is None else size / 1048576))
    return literal_rows(
        spark, rows, "file string, status string, expected string, found string, bytes bigint, size_mb double"
    )


def assert_counts(tables: Mapping[str, DataFrame], expected: Mapping[str, int]) -> dict[str, int]:
    """Count the tables and raise if one differs from its expected count."""
    counts = {name: tables[name].count() for name in expected}
    wrong = [f"{n}: {counts[n]:,} rows where {expected[n]:,} were due" for n in expected if counts[n] != expected[n]]
    if wrong:
        raise CountMismatch("; ".join(wrong))
    return counts


def preview(df: DataFrame, n: int = 10, order: Sequence[str | Column] = ()) -> DataFrame:
    """The first ``n`` rows; give an order for a repeatable choice."""
    return (df.orderBy(*order) if order else df).limit(n)
