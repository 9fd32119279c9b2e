"""Sources and sinks on the given tables: written out, read back, and compared."""

from pyspark.sql import functions as F
from pyspark.sql.types import LongType, StringType, StructField, StructType

from tallyframe.functions import to_int
from tallyframe.operators.joins import union_all
from tallyframe.plans import marts, quality
from tallyframe.schemas import SOURCE_BY_TABLE, SOURCES
from tallyframe.session import scratch
from tallyframe.sinks import (
    export_run_log,
    log_run,
    logged_write,
    quality_markdown,
    read_table,
    refresh_statistics,
    replace_table,
    save_table,
    write_quality,
    write_tier,
)
from tallyframe.sources import assert_counts, load_staging, preflight, read_csv
from workload.registry import query
from workload.staging_sql import LAYERS
from workload.tables import SHARED, layers, staging, table

# Text with commas, quotes and both, as a raw file may hold it.
TRICKY_SQL = """SELECT o_orderkey, CASE o_orderkey % 4 WHEN 0 THEN o_orderpriority || ', urgent' WHEN 1 THEN '"' || o_orderpriority || '"'
  WHEN 2 THEN 'a "quoted, word" in ' || o_orderpriority ELSE o_orderpriority END AS label,
  CAST(o_orderkey % 7 AS BIGINT) AS number FROM orders"""


def _tricky(spark, d):
    key, priority = F.col("o_orderkey"), F.col("o_orderpriority")
    label = (
        F.when(key % 4 == 0, F.concat(priority, F.lit(", urgent")))
        .when(key % 4 == 1, F.concat(F.lit('"'), priority, F.lit('"')))
        .when(key % 4 == 2, F.concat(F.lit('a "quoted, word" in '), priority))
        .otherwise(priority)
    )
    return table(spark, d, "orders").select(key, label.alias("label"), (key % 7).cast("bigint").alias("number"))


def _raw(spark, t, tables):
    """Staging tables as CSV folders of several parts."""
    root = scratch(spark, "raw")
    for name in tables:
        source = SOURCE_BY_TABLE[name]
        df = t[name].select(*source.columns)
        df.write.option("header", True).option("escape", '"').csv(f"{root}/{source.filename}")
    return root


@query("csv_round_trip", TRICKY_SQL)
def _(spark, d):
    """Quoted text and numbers through a CSV file and back by its schema."""
    path, df = scratch(spark, "csv"), _tricky(spark, d)
    df.write.option("header", True).option("escape", '"').csv(path)
    return read_csv(spark, path, StructType([StructField(n, LongType() if n != "label" else StringType()) for n in df.columns]))


@query(
    "csv_typed_markers",
    """SELECT o_orderkey, CASE WHEN o_orderkey % 3 > 0 THEN CAST(o_orderkey % 7 AS BIGINT) END AS number FROM orders""",
)
def _(spark, d):
    """Markers, blanks and padding of a number column on the way through a CSV file."""
    path, key = scratch(spark, "csv"), F.col("o_orderkey")
    text = F.when(key % 3 == 0, F.when(key % 2 == 0, "?").otherwise(" ")).otherwise(F.concat(F.lit(" "), (key % 7).cast("string")))
    table(spark, d, "orders").select(key, text.alias("number")).write.option("header", True).csv(path)
    schema = StructType([StructField("o_orderkey", LongType()), StructField("number", LongType())])
    return read_csv(spark, path, schema, null_columns=["number"])


@query(
    "csv_malformed_rows",
    "SELECT CAST(o_orderkey % 3 AS BIGINT) AS kind, count(*) AS malformed_rows FROM orders WHERE o_orderkey % 3 > 0 GROUP BY ALL",
)
def _(spark, d):
    """Rows with a field too many or too few, counted by kind."""
    path, key = scratch(spark, "csv"), F.col("o_orderkey")
    line = F.concat(key.cast("string"), F.lit(",x"), F.element_at(F.array(F.lit(",y"), F.lit(",y,z"), F.lit("")), (key % 3 + 1).cast("int")))
    body = table(spark, d, "orders").select(line.alias("value"))
    body.select(F.concat(F.lit("a,b,c\n"), "value").alias("value")).write.option("lineSep", "\n\n").text(path)
    # Every line has a header line of its own here, so that each part begins with one; they are dropped below.
    schema = StructType([StructField(c, StringType()) for c in "abc"])
    got = read_csv(spark, path, schema, malformed="bad").where("a <> 'a'").where("bad IS NOT NULL")
    return got.groupBy((F.split("bad", ",")[0].cast("bigint") % 3).alias("kind")).agg(F.count(F.lit(1)).alias("malformed_rows"))


@query(
    "staging_from_files",
    LAYERS + " UNION ALL ".join(
        f"\nSELECT '{s.table}' AS table_name, count(*) AS total_rows, count(DISTINCT t) AS distinct_rows FROM {s.table} t" for s in SOURCES
    ),
)
def _(spark, d):
    """Staging tables loaded from files that are made of the derived ones, with their counts."""
    names = [s.table for s in SOURCES]
    stg = load_staging(spark, _raw(spark, staging(spark, d).written(*SHARED), names))
    parts = []
    for name in names:
        columns = SOURCE_BY_TABLE[name].columns
        parts.append(
            stg[name].groupBy(*columns).agg(F.count(F.lit(1)).alias("n"))
            .agg(F.sum("n").alias("total_rows"), F.count(F.lit(1)).alias("distinct_rows"))
            .select(F.lit(name).alias("table_name"), "total_rows", "distinct_rows")
        )
    return union_all(parts)


@query(
    "count_gate",
    LAYERS + " UNION ALL ".join(f"\nSELECT '{s.table}' AS table_name, count(*) AS total_rows FROM {s.table}" for s in SOURCES),
)
def _(spark, d):
    """All seven files through the count gate, held against counts worked out from the given tables."""
    t = staging(spark, d).written(*SHARED)
    orders, lines = t["_orders"], t["_lines"]
    students = (orders, ("id_student", "code_module", "code_presentation"))
    keys = {
        "stg_courses": (orders, ("code_module", "code_presentation")),
        "stg_student_info": students,
        "stg_student_registration": students,
        "stg_assessments": (lines, ("context", "l_returnflag")),
        "stg_vle": (lines, ("context", "l_linenumber")),
        "stg_student_assessment": (lines, ("context", "l_returnflag", "id_student")),
    }
    found = {columns: df.select(*columns).distinct().count() for df, columns in dict.fromkeys(keys.values())}
    expected = {name: found[columns] for name, (_, columns) in keys.items()}
    expected["stg_student_vle"] = table(spark, d, "lineitem").count()
    stg = load_staging(spark, _raw(spark, t, [s.table for s in SOURCES]))
    counts = assert_counts(stg, expected)
    each = {name: df.agg(F.count(F.lit(1)).alias("total_rows")).where(F.col("total_rows") == counts[name]) for name, df in stg.items()}
    return union_all([df.select(F.lit(name).alias("table_name"), "total_rows") for name, df in each.items()])


@query(
    "preflight",
    "SELECT * FROM (VALUES "
    + ", ".join(
        f"('{s.filename}', '{'OK' if k == 0 else 'INVALID COLUMNS' if k == 1 else 'MISSING'}', '{','.join(s.columns)}')"
        for k, s in enumerate(SOURCES)
    )
    + ") t(file, status, expected)",
)
def _(spark, d):
    """One good file, one with a column renamed, and five that are not there."""
    root = _raw(spark, staging(spark, d), ["stg_courses"])
    wrong = staging(spark, d)["stg_assessments"].withColumnRenamed("weight", "heaviness")
    wrong.write.option("header", True).csv(f"{root}/assessments.csv")
    return preflight(spark, root).select("file", "status", "expected")


@query("replaced_table", TRICKY_SQL)
def _(spark, d):
    """The second version of a table, after a first one and a failed one."""
    path, df = scratch(spark, "table"), _tricky(spark, d)
    replace_table(df.where("number = 1"), path)
    replace_table(df, path, expected_rows=df.count())
    try:
        replace_table(df.where("number = 2"), path, expected_rows=-1)
    except RuntimeError:
        pass
    return read_table(spark, path)


@query(
    "partitioned_table",
    "SELECT o_orderkey, o_orderstatus, o_orderpriority FROM orders WHERE o_orderstatus = 'F' AND o_orderpriority = '2-HIGH'",
)
def _(spark, d):
    """Rows of one partition of a table stored by two columns."""
    path = scratch(spark, "table")
    df = table(spark, d, "orders").select("o_orderkey", "o_orderstatus", "o_orderpriority")
    replace_table(df, path, ["o_orderstatus", "o_orderpriority"])
    return read_table(spark, path, df.schema).where("o_orderstatus = 'F' AND o_orderpriority = '2-HIGH'")


@query("tier_csv", "SELECT o_orderpriority, count(*) AS orders FROM orders GROUP BY ALL")
def _(spark, d):
    """A result stored below its tier, as its CSV copy holds it."""
    root = scratch(spark, "tiers")
    totals = table(spark, d, "orders").groupBy("o_orderpriority").agg(F.count(F.lit(1)).alias("orders"))
    write_tier(totals, root, "aggregates", "orders_by_priority")
    schema = StructType([StructField("o_orderpriority", StringType()), StructField("orders", LongType())])
    return read_csv(spark, f"{root}/aggregates/orders_by_priority/csv", schema)


@query(
    "run_log",
    """SELECT 1 AS log_id, 'load' AS pipeline_stage, 'orders' AS target_table, count(*) AS row_count, 'SUCCESS' AS status FROM orders
    UNION ALL SELECT 2, 'load', 'customer', count(*), 'FAILED' FROM customer
    UNION ALL SELECT 3, 'note', NULL, NULL, 'SUCCESS'""",
)
def _(spark, d):
    """The exported log of a load that succeeds, one that fails its count, and a note, without times."""
    root = scratch(spark, "log")
    logged_write(spark, lambda: table(spark, d, "orders"), f"{root}/orders", f"{root}/log", "load", "orders")
    try:
        logged_write(spark, lambda: table(spark, d, "customer"), f"{root}/customer", f"{root}/log", "load", "customer", expected_rows=-1)
    except RuntimeError:
        pass
    log_run(spark, f"{root}/log", "note", None, None, 0.0, "SUCCESS")
    export_run_log(spark, f"{root}/log", f"{root}/csv")
    columns = "log_id bigint, run_id string, pipeline_stage string, source_file string, target_table string, row_count bigint"
    columns += ", duration_seconds string, status string, message string, logged_at string"
    exported = read_csv(spark, f"{root}/csv", StructType.fromDDL(columns))
    return exported.select(F.col("log_id").cast("int"), "pipeline_stage", "target_table", "row_count", "status")


def _small_report(spark, d):
    lines = [
        quality.exact_check("given", "orders", "orders without status", "Every order has one.", value=F.count_if(F.col("o_orderstatus").isNull())),
        quality.exact_check("given", "orders", "open orders", "None is open.", value=F.count_if(F.col("o_orderstatus") == "O")),
        quality.info_check("given", "customer", "customers", "All rows.", value=F.count(F.lit(1))),
    ]
    return quality.quality_report({n: table(spark, d, n) for n in ("orders", "customer")}, lines)


QUALITY_SQL = """SELECT 1 AS check_order, 'orders without status' AS check_name, count(*) FILTER (o_orderstatus IS NULL) AS observed FROM orders
  UNION ALL SELECT 2, 'open orders', count(*) FILTER (o_orderstatus = 'O') FROM orders
  UNION ALL SELECT 3, 'customers', count(*) FROM customer"""


@query("stored_quality_results", f"SELECT check_order AS result_id, check_name, CAST(observed AS VARCHAR) AS observed_value FROM ({QUALITY_SQL})")
def _(spark, d):
    return write_quality(_small_report(spark, d), scratch(spark, "quality")).select("result_id", "check_name", "observed_value")


@query(
    "markdown_totals",
    f"""WITH q AS ({QUALITY_SQL})
    SELECT CASE WHEN max(observed) FILTER (check_order < 3) > 0 THEN 'Overall: **FAIL** (' ELSE 'Overall: **PASS** (' END
      || count(*) FILTER (check_order < 3 AND observed = 0) || ' passed, '
      || count(*) FILTER (check_order < 3 AND observed > 0) || ' failed, 1 informational)' AS line FROM q""",
)
def _(spark, d):
    """The line of totals of the Markdown report."""
    text = quality_markdown(_small_report(spark, d))
    (line,) = [x for x in text.splitlines() if x.startswith("Overall")]
    return table(spark, d, "orders").groupBy().agg(F.lit(line).alias("line"))


@query("table_statistics", "SELECT count(*) AS total_rows, count(DISTINCT o_custkey) AS customers FROM orders")
def _(spark, d):
    """Row count from the catalogue's statistics of a saved table, beside a count by its buckets' key."""
    name = f"orders_{abs(hash(d)) % 10**9}"
    save_table(table(spark, d, "orders").select("o_orderkey", "o_custkey"), name, ["o_custkey"], 4)
    refresh_statistics(spark, name)
    facts = {r.col_name: r.data_type for r in spark.sql(f"DESCRIBE EXTENDED {name}").collect()}
    known = int(facts["Statistics"].split(",")[1].split()[0])
    per_customer = spark.table(name).groupBy("o_custkey").agg(F.count(F.lit(1)).alias("n"))
    return per_customer.agg(F.sum("n").alias("total_rows"), F.count(F.lit(1)).alias("customers")).where(F.col("total_rows") == known)


@query(
    "mart_row_difference",
    LAYERS + """,
known_site AS (SELECT * FROM stg_vle WHERE activity_type <> 'forum'),
kept AS (SELECT count(*) AS n FROM stg_student_vle v WHERE EXISTS (FROM known_site s WHERE s.id_site = v.id_site))
SELECT 'click_mart.fact_student_vle' AS fact, n AS fact_rows, (SELECT count(*) FROM stg_student_vle) AS expected_rows,
  n - (SELECT count(*) FROM stg_student_vle) AS difference FROM kept""",
)
def _(spark, d):
    """A click fact built without the forum resources of the material dimension: their clicks are missing in it."""
    t = layers(spark, d)
    dims = marts.click_dimensions({**{n: t[n] for n in t if n.startswith("stg_")}, "stg_vle": t["stg_vle"].where("activity_type <> 'forum'")})
    fact = "click_mart.fact_student_vle"
    tables = {fact: marts.fact_student_vle(t, dims), "stg_student_vle": t["stg_student_vle"].where(to_int("id_site").isNotNull())}
    return marts.row_differences(tables)
