"""Cleaning, filter, join, profile and correction operators on the given tables."""

from pyspark.sql import functions as F

from tallyframe.functions import (
    bad_format,
    coded,
    composite,
    day_gap,
    is_missing,
    null_markers,
    pct,
    rounded_mean,
    standardise,
    to_decimal,
    to_int,
)
from tallyframe.operators import aggregates as agg
from tallyframe.operators import bitmaps, profile
from tallyframe.operators.corrections import (
    append_valid,
    apply_corrections,
    apply_valid_corrections,
    correction_evidence,
    rejected_corrections,
    rejected_rows,
    rows_corrected,
)
from tallyframe.operators.differences import row_difference
from tallyframe.operators.joins import (
    has_orphans,
    orphan_counts,
    orphans,
    star_audit,
    star_denormalise,
    star_lookup,
    union_all,
    with_keys,
)
from tallyframe.operators.ordering import distinct_rows, first_per_key, surrogate_key, top_k
from tallyframe.operators.quality import Check, ForeignKey, NotNull, Unique, rule_report, surplus_rows, violations
from tallyframe.operators.references import key_set, marked
from tallyframe.session import materialise
from tallyframe.sources import literal_rows, preview
from workload.registry import doubles, query
from workload.staging_sql import rounded_mean as mean_sql
from workload.staging_sql import rounded_pct as pct_sql
from workload.tables import table

# Priority labels of the given orders, most urgent first.
PRIORITIES = {"1-URGENT": 1, "2-HIGH": 2, "3-MEDIUM": 3, "4-NOT SPECIFIED": 4, "5-LOW": 5}
SEGMENTS = ("AUTOMOBILE", "BUILDING", "FURNITURE", "HOUSEHOLD", "MACHINERY")


def raw_orders(spark, d):
    """Orders as untyped text, with padding, markers and blanks put in by value."""
    price = F.col("o_totalprice")
    return table(spark, d, "orders").select(
        F.concat(F.lit(" "), F.col("o_orderkey").cast("string"), F.lit(" ")).alias("orderkey"),
        F.col("o_custkey").cast("string").alias("custkey"),
        F.when(F.col("o_orderstatus") == "P", " ? ")
        .when(F.col("o_orderstatus") == "O", " O ")
        .otherwise(F.col("o_orderstatus"))
        .alias("status"),
        F.when(F.col("o_orderpriority") == "5-LOW", " ").otherwise(F.col("o_orderpriority")).alias("priority"),
        F.when(price > 450000, "?")
        .when(price < 5000, "")
        .otherwise(price.cast("decimal(12,2)").cast("string"))
        .alias("price"),
        F.when(price > 400000, None).otherwise(F.floor(price / 1000).cast("string")).alias("units"),
    )


RAW_SQL = """WITH raw AS (
  SELECT ' ' || CAST(o_orderkey AS VARCHAR) || ' ' AS orderkey, CAST(o_custkey AS VARCHAR) AS custkey,
    CASE o_orderstatus WHEN 'P' THEN ' ? ' WHEN 'O' THEN ' O ' ELSE o_orderstatus END AS status,
    CASE WHEN o_orderpriority = '5-LOW' THEN ' ' ELSE o_orderpriority END AS priority,
    CASE WHEN o_totalprice > 450000 THEN '?' WHEN o_totalprice < 5000 THEN ''
      ELSE CAST(CAST(o_totalprice AS DECIMAL(12,2)) AS VARCHAR) END AS price,
    CASE WHEN o_totalprice > 400000 THEN NULL ELSE CAST(CAST(floor(o_totalprice / 1000) AS BIGINT) AS VARCHAR) END AS units
  FROM orders)
"""


# ------------------------------------------------------------ cleaning and expressions


@query(
    "clean_markers",
    RAW_SQL
    + """SELECT TRY_CAST(trim(orderkey) AS BIGINT) AS orderkey, nullif(nullif(trim(status), '?'), '') AS status,
    nullif(nullif(trim(priority), '?'), '') AS priority,
    TRY_CAST(nullif(nullif(trim(price), '?'), '') AS DECIMAL(12,2)) AS price FROM raw""",
)
def _(spark, d):
    return raw_orders(spark, d).select(
        to_int("orderkey").alias("orderkey"),
        null_markers("status").alias("status"),
        null_markers("priority").alias("priority"),
        to_decimal("price", 12, 2).alias("price"),
    )


@query(
    "standardise_labels",
    RAW_SQL
    + """SELECT TRY_CAST(trim(orderkey) AS BIGINT) AS orderkey,
    CASE WHEN trim(priority) IN ('', '?') THEN NULL WHEN trim(priority) = '4-NOT SPECIFIED' THEN '4-NONE'
      ELSE trim(priority) END AS priority,
    coalesce(nullif(nullif(trim(status), '?'), ''), 'Unknown') AS status FROM raw""",
)
def _(spark, d):
    return raw_orders(spark, d).select(
        to_int("orderkey").alias("orderkey"),
        standardise("priority", {"4-NOT SPECIFIED": "4-NONE"}).alias("priority"),
        F.coalesce(null_markers("status"), F.lit("Unknown")).alias("status"),
    )


@query(
    "substr_parse",
    """SELECT c_custkey, left(c_name, 8) AS prefix, TRY_CAST(right(c_name, 9) AS INTEGER) AS number,
    c_mktsegment || '-' || CAST(c_nationkey AS VARCHAR) AS label FROM customer""",
)
def _(spark, d):
    return table(spark, d, "customer").select(
        "c_custkey",
        F.left("c_name", F.lit(8)).alias("prefix"),
        F.right("c_name", F.lit(9)).try_cast("int").alias("number"),
        composite("c_mktsegment", F.col("c_nationkey").cast("string")).alias("label"),
    )


@query(
    "ordered_category",
    """SELECT o_orderkey, CASE o_orderpriority WHEN '1-URGENT' THEN 1 WHEN '2-HIGH' THEN 2 WHEN '3-MEDIUM' THEN 3
      WHEN '4-NOT SPECIFIED' THEN 4 WHEN '5-LOW' THEN 5 END AS priority_order,
    CASE WHEN o_orderstatus IN ('F', 'O') THEN 'Closed' ELSE 'Pending' END AS category,
    CASE WHEN o_orderstatus IN ('F', 'O') THEN 1 ELSE 0 END AS closed FROM orders""",
)
def _(spark, d):
    return table(spark, d, "orders").select(
        "o_orderkey",
        coded("o_orderpriority", PRIORITIES).alias("priority_order"),
        coded("o_orderstatus", {"F": "Closed", "O": "Closed"}, "Pending").alias("category"),
        F.col("o_orderstatus").isin("F", "O").cast("int").alias("closed"),
    )


@query(
    "rename_reorder",
    "SELECT s_name AS supplier, s_nationkey AS nation, s_suppkey AS id FROM supplier",
)
def _(spark, d):
    return table(spark, d, "supplier").select(
        F.col("s_name").alias("supplier"), F.col("s_nationkey").alias("nation"), F.col("s_suppkey").alias("id")
    )


DELAY_SQL = """SELECT l_orderkey, l_linenumber,
    CAST(date_diff('day', CAST(o_orderdate AS DATE), CAST(l_shipdate AS DATE)) AS INTEGER) AS delay_days"""


def _delays(spark, d):
    orders = table(spark, d, "orders").select(
        F.col("o_orderkey").alias("l_orderkey"), "o_orderpriority", F.unix_date(F.col("o_orderdate").cast("date")).alias("ordered")
    )
    lines = table(spark, d, "lineitem").select(
        "l_orderkey", "l_linenumber", "l_quantity", F.unix_date(F.col("l_shipdate").cast("date")).alias("shipped")
    )
    return lines.join(orders, "l_orderkey").withColumn("delay_days", day_gap("shipped", "ordered"))


@query("day_delay", DELAY_SQL + " FROM lineitem JOIN orders ON l_orderkey = o_orderkey")
def _(spark, d):
    return _delays(spark, d).select("l_orderkey", "l_linenumber", "delay_days")


@query(
    "bool_flags",
    DELAY_SQL
    + """, CAST(l_shipdate AS DATE) < CAST(o_orderdate AS DATE) AS early, l_quantity = 1 AS single
    FROM lineitem JOIN orders ON l_orderkey = o_orderkey""",
)
def _(spark, d):
    return _delays(spark, d).select(
        "l_orderkey", "l_linenumber", "delay_days",
        (F.col("delay_days") < 0).alias("early"), (F.col("l_quantity") == 1).alias("single"),
    )


@query(
    "round_pct",
    f"""SELECT o_orderpriority, {mean_sql('CAST(floor(o_totalprice) AS BIGINT)')} AS mean_price,
    {pct_sql("count(*) FILTER (o_orderstatus = 'F')", "count(*)")} AS finished_pct
    FROM orders GROUP BY o_orderpriority""",
)
def _(spark, d):
    result = table(spark, d, "orders").groupBy("o_orderpriority").agg(
        rounded_mean(F.floor("o_totalprice").cast("bigint")).alias("mean_price"),
        pct(F.count_if(F.col("o_orderstatus") == "F"), F.count(F.lit(1))).alias("finished_pct"),
    )
    return doubles(result, "mean_price", "finished_pct")


# ------------------------------------------------------------ filters


@query(
    "missing_filter",
    RAW_SQL + """SELECT orderkey, priority, price FROM raw
    WHERE trim(priority) IN ('', '?') OR price IS NULL OR trim(price) IN ('', '?')""",
)
def _(spark, d):
    return raw_orders(spark, d).where(is_missing("priority") | is_missing("price")).select("orderkey", "priority", "price")


@query("bad_format", "SELECT p_partkey, p_brand FROM part WHERE NOT regexp_matches(trim(p_brand), '^Brand#[0-9]$')")
def _(spark, d):
    return table(spark, d, "part").where(bad_format("p_brand", "^Brand#[0-9]$")).select("p_partkey", "p_brand")


@query(
    "bad_format_ignoring_case",
    "SELECT p_partkey, p_type FROM part WHERE NOT regexp_matches(trim(p_type), '^(eco|sma)[a-z]+$', 'i')",
)
def _(spark, d):
    return table(spark, d, "part").where(bad_format("p_type", "^(eco|sma)[a-z]+$", ignore_case=True)).select(
        "p_partkey", "p_type"
    )


@query(
    "filter_in",
    """SELECT c_custkey, c_mktsegment, c_nationkey FROM customer
    WHERE c_mktsegment IN ('BUILDING', 'MACHINERY') AND c_nationkey NOT IN (0, 1, 2) OR c_nationkey = 24""",
)
def _(spark, d):
    segment, nation = F.col("c_mktsegment"), F.col("c_nationkey")
    return table(spark, d, "customer").where(
        (segment.isin("BUILDING", "MACHINERY") & ~nation.isin(0, 1, 2)) | (nation == 24)
    ).select("c_custkey", "c_mktsegment", "c_nationkey")


@query(
    "range_filter",
    """SELECT l_orderkey, l_linenumber, l_quantity FROM lineitem
    WHERE l_quantity BETWEEN 10 AND 20 AND l_discount NOT BETWEEN 0.03 AND 0.07""",
)
def _(spark, d):
    return table(spark, d, "lineitem").where(
        F.col("l_quantity").between(10, 20) & ~F.col("l_discount").between(0.03, 0.07)
    ).select("l_orderkey", "l_linenumber", "l_quantity")


@query(
    "compound_null_pair",
    RAW_SQL + """SELECT orderkey, price, units FROM raw
    WHERE (trim(price) IN ('', '?')) <> (units IS NULL)
       OR TRY_CAST(nullif(nullif(trim(price), '?'), '') AS DECIMAL(12,2)) < TRY_CAST(units AS BIGINT)""",
)
def _(spark, d):
    reverse = to_decimal("price", 12, 2) < to_int("units")
    return raw_orders(spark, d).where((is_missing("price") != is_missing("units")) | reverse).select(
        "orderkey", "price", "units"
    )


@query(
    "duplicate_keys",
    """SELECT l_orderkey, l_linenumber, count(*) AS number_of_records FROM lineitem
    GROUP BY ALL HAVING count(*) > 1""",
)
def _(spark, d):
    return agg.duplicate_keys(table(spark, d, "lineitem"), ["l_orderkey", "l_linenumber"])


@query(
    "several_values",
    "SELECT o_custkey FROM orders GROUP BY o_custkey HAVING count(DISTINCT o_orderpriority) > 1",
)
def _(spark, d):
    return profile.varying_entities(table(spark, d, "orders"), "o_custkey", "o_orderpriority")


# ------------------------------------------------------------ joins


@query(
    "inner_join",
    "SELECT c_custkey, c_name, n_name FROM customer JOIN nation ON c_nationkey = n_nationkey",
)
def _(spark, d):
    nation = table(spark, d, "nation").select(F.col("n_nationkey").alias("c_nationkey"), "n_name")
    return table(spark, d, "customer").join(nation, "c_nationkey").select("c_custkey", "c_name", "n_name")


@query(
    "normalised_key_join",
    RAW_SQL + """SELECT TRY_CAST(trim(orderkey) AS BIGINT) AS o_orderkey, c_name
    FROM raw JOIN customer ON TRY_CAST(trim(custkey) AS BIGINT) = c_custkey""",
)
def _(spark, d):
    keyed = with_keys(raw_orders(spark, d), {"o_orderkey": to_int("orderkey"), "c_custkey": to_int("custkey")})
    return keyed.join(table(spark, d, "customer"), "c_custkey").select("o_orderkey", "c_name")


@query(
    "left_join_zero_fill",
    """SELECT d.doc_id, d.lang, coalesce(l.n, 0) AS labels, l.quality FROM documents d
    LEFT JOIN (SELECT doc_id, count(*) AS n, max(quality) AS quality FROM labels GROUP BY doc_id) l USING (doc_id)""",
)
def _(spark, d):
    counted = table(spark, d, "labels").groupBy("doc_id").agg(
        F.count(F.lit(1)).alias("n"), F.max("quality").alias("quality")
    )
    return table(spark, d, "documents").join(counted, "doc_id", "left").select(
        "doc_id", "lang", F.coalesce("n", F.lit(0)).alias("labels"), "quality"
    )


@query("orphans", "SELECT doc_id, lang, source FROM documents d WHERE NOT EXISTS (FROM labels l WHERE l.doc_id = d.doc_id)")
def _(spark, d):
    return orphans(table(spark, d, "documents").select("doc_id", "lang", "source"), table(spark, d, "labels"), ["doc_id"])


@query(
    "orphans_grouped",
    """SELECT lang, count(*) AS unmatched_records FROM documents d LEFT JOIN labels l USING (doc_id)
    WHERE l.quality IS NULL GROUP BY lang""",
)
def _(spark, d):
    return orphan_counts(table(spark, d, "documents"), table(spark, d, "labels"), ["doc_id"], ["lang"])


@query(
    "has_orphans",
    """SELECT 'lineitem' AS child, CAST(EXISTS (SELECT 1 FROM lineitem LEFT JOIN orders ON l_orderkey = o_orderkey
      WHERE o_orderkey IS NULL) AS INTEGER) AS has_orphans
    UNION ALL SELECT 'documents', CAST(EXISTS (SELECT 1 FROM documents d LEFT JOIN labels l ON l.doc_id = d.doc_id
      WHERE l.doc_id IS NULL) AS INTEGER)""",
)
def _(spark, d):
    orders = table(spark, d, "orders").withColumnRenamed("o_orderkey", "l_orderkey")
    lines = has_orphans(table(spark, d, "lineitem"), orders, ["l_orderkey"])
    docs = has_orphans(table(spark, d, "documents"), table(spark, d, "labels"), ["doc_id"])
    return union_all([lines.select(F.lit("lineitem").alias("child"), "*"), docs.select(F.lit("documents").alias("child"), "*")])


@query(
    "late_vs_parent",
    """SELECT o_orderpriority, count(*) AS late_lines,
    CAST(max(date_diff('day', CAST(o_orderdate AS DATE), CAST(l_shipdate AS DATE))) AS INTEGER) AS longest_delay
    FROM lineitem JOIN orders ON l_orderkey = o_orderkey
    WHERE CAST(l_shipdate AS DATE) > CAST(o_orderdate AS DATE) GROUP BY o_orderpriority""",
)
def _(spark, d):
    late = _delays(spark, d).where("delay_days > 0")
    return late.groupBy("o_orderpriority").agg(
        F.count(F.lit(1)).alias("late_lines"), F.max("delay_days").alias("longest_delay")
    )


@query(
    "chained_join",
    """SELECT r_name, n_name, count(*) AS orders, count(DISTINCT c_custkey) AS customers
    FROM orders JOIN customer ON o_custkey = c_custkey JOIN nation ON c_nationkey = n_nationkey
    JOIN region ON n_regionkey = r_regionkey GROUP BY ALL""",
)
def _(spark, d):
    per_customer = table(spark, d, "orders").groupBy(F.col("o_custkey").alias("c_custkey")).agg(F.count(F.lit(1)).alias("n"))
    places = table(spark, d, "nation").join(table(spark, d, "region"), F.col("n_regionkey") == F.col("r_regionkey"))
    return (
        table(spark, d, "customer")
        .join(per_customer, "c_custkey")
        .join(places, F.col("c_nationkey") == F.col("n_nationkey"))
        .groupBy("r_name", "n_name")
        .agg(F.sum("n").alias("orders"), F.count(F.lit(1)).alias("customers"))
    )


def _priority_dim(spark, d):
    labels = table(spark, d, "orders").select("o_orderpriority").distinct()
    return surrogate_key(labels, "priority_key", ["o_orderpriority"])


def _customer_dim(spark, d):
    return surrogate_key(table(spark, d, "customer").select("c_custkey", "c_mktsegment"), "customer_key", ["c_custkey"])


STAR_SQL = """WITH dim_priority AS (
  SELECT o_orderpriority, row_number() OVER (ORDER BY o_orderpriority) AS priority_key
  FROM (SELECT DISTINCT o_orderpriority FROM orders)),
dim_customer AS (
  SELECT c_custkey, c_mktsegment, row_number() OVER (ORDER BY c_custkey) AS customer_key FROM customer),
fact AS (
  SELECT o_orderkey, priority_key, customer_key FROM orders JOIN dim_priority USING (o_orderpriority)
  JOIN dim_customer ON o_custkey = c_custkey)
"""


def _star(spark, d):
    """Dimensions are written out, so that the lookups are planned from their real sizes."""
    priority = materialise(_priority_dim(spark, d), "dim_priority")
    customer = materialise(_customer_dim(spark, d), "dim_customer")
    source = table(spark, d, "orders").withColumnRenamed("o_custkey", "c_custkey")
    fact = star_lookup(
        source, [(priority, ["o_orderpriority"], "priority_key"), (customer, ["c_custkey"], "customer_key")]
    ).select("o_orderkey", "priority_key", "customer_key")
    return fact, priority, customer


@query("star_lookup", STAR_SQL + "SELECT * FROM fact")
def _(spark, d):
    return _star(spark, d)[0]


@query(
    "star_denormalised",
    STAR_SQL
    + """SELECT o_orderkey, o_orderpriority, c_custkey, c_mktsegment FROM fact
    JOIN dim_priority USING (priority_key) JOIN dim_customer USING (customer_key)""",
)
def _(spark, d):
    fact, priority, customer = _star(spark, d)
    return star_denormalise(
        fact,
        [(priority, "priority_key", ["o_orderpriority"]), (customer, "customer_key", ["c_custkey", "c_mktsegment"])],
    )


@query(
    "star_audit",
    STAR_SQL
    + """SELECT count(*) FILTER (p.priority_key IS NULL) AS unmatched_priorities,
    count(*) FILTER (c.customer_key IS NULL) AS unmatched_customers,
    count(*) FILTER (l.doc_id IS NULL) AS unmatched_labels
    FROM fact f LEFT JOIN dim_priority p ON p.priority_key = f.priority_key
    LEFT JOIN dim_customer c ON c.customer_key = f.customer_key LEFT JOIN labels l ON l.doc_id = f.o_orderkey""",
)
def _(spark, d):
    fact, priority, customer = _star(spark, d)
    labels = table(spark, d, "labels").select(F.col("doc_id").alias("o_orderkey"))
    return star_audit(
        fact,
        [
            (priority, "priority_key", "unmatched_priorities"),
            (customer, "customer_key", "unmatched_customers"),
            (labels, "o_orderkey", "unmatched_labels"),
        ],
    )


@query("count_difference", "SELECT (SELECT count(*) FROM documents) - (SELECT count(*) FROM labels) AS difference")
def _(spark, d):
    return agg.count_difference(table(spark, d, "documents"), table(spark, d, "labels"))


# ------------------------------------------------------------ aggregates


@query("row_count", "SELECT count(*) AS total_rows FROM lineitem")
def _(spark, d):
    return agg.row_count(table(spark, d, "lineitem"))


@query(
    "collapse_entity",
    """SELECT o_custkey, max(o_orderpriority) AS o_orderpriority, max(o_orderstatus) AS o_orderstatus
    FROM orders GROUP BY o_custkey""",
)
def _(spark, d):
    return agg.collapse_entity(table(spark, d, "orders"), ["o_custkey"], ["o_orderpriority", "o_orderstatus"])


@query(
    "completion_by_segment",
    f"""SELECT c_mktsegment, count(*) AS registered_students, count(*) FILTER (o_orderstatus = 'F') AS finished,
    count(*) FILTER (o_orderstatus = 'O') AS open, count(*) FILTER (o_orderstatus = 'P') AS pending,
    count(*) FILTER (o_orderstatus IN ('F', 'O')) AS successful_students,
    {pct_sql("count(*) FILTER (o_orderstatus IN ('F', 'O'))", "count(*)")} AS successful_completion_rate_pct
    FROM orders JOIN customer ON o_custkey = c_custkey GROUP BY c_mktsegment""",
)
def _(spark, d):
    joined = table(spark, d, "orders").join(table(spark, d, "customer"), F.col("o_custkey") == F.col("c_custkey"))
    result = agg.completion(
        joined, ["c_mktsegment"], "o_orderstatus", {"finished": "F", "open": "O", "pending": "P"}, ["F", "O"]
    )
    return doubles(result, "successful_completion_rate_pct")


PERFORMANCE_SQL = f"""SELECT source, lang, count(l.doc_id) AS submissions,
    count(*) FILTER (l.doc_id IS NOT NULL AND l.score IS NULL) AS missing_scores,
    {mean_sql("l.score")} AS average_score, {pct_sql("sum(l.toxic)", "count(l.toxic)")} AS banked_result_rate_pct
    FROM documents d {{how}} JOIN (SELECT doc_id, toxic, CASE WHEN toxic = 0 THEN quality END AS score FROM labels) l
      ON l.doc_id = d.doc_id GROUP BY source, lang"""


def _label_performance(spark, d, how):
    labels = table(spark, d, "labels").select(
        "doc_id", "toxic", F.when(F.col("toxic") == 0, F.col("quality")).alias("score")
    )
    result = agg.performance(table(spark, d, "documents"), labels, "doc_id", ["source", "lang"], "score", "toxic", how)
    return doubles(result, "average_score", "banked_result_rate_pct")


@query("performance_left", PERFORMANCE_SQL.format(how="LEFT"))
def _(spark, d):
    return _label_performance(spark, d, "left")


@query("performance_inner", PERFORMANCE_SQL.format(how="INNER"))
def _(spark, d):
    return _label_performance(spark, d, "inner")


@query(
    "availability",
    """SELECT p_brand, p_type, count(*) AS resources,
    count(*) FILTER (nullif(p_size, 1) IS NULL OR nullif(p_size, 50) IS NULL) AS resources_missing_week_information,
    min(nullif(p_size, 1)) AS earliest_week, max(nullif(p_size, 50)) AS latest_week FROM part GROUP BY ALL""",
)
def _(spark, d):
    parts = table(spark, d, "part").withColumns(
        {"start": F.nullif(F.col("p_size"), F.lit(1)), "end": F.nullif(F.col("p_size"), F.lit(50))}
    )
    return agg.availability(parts, ["p_brand", "p_type"], "start", "end")


@query(
    "conditional_counts",
    """SELECT l_returnflag, count(*) FILTER (l_quantity > 25) AS large, count(*) FILTER (l_tax = 0) AS untaxed
    FROM lineitem GROUP BY l_returnflag""",
)
def _(spark, d):
    return agg.conditional_counts(
        table(spark, d, "lineitem"), ["l_returnflag"], {"large": F.col("l_quantity") > 25, "untaxed": F.col("l_tax") == 0}
    )


@query(
    "multi_distinct",
    """SELECT count(*) AS rows, count(DISTINCT o_custkey) AS customers, count(DISTINCT o_orderpriority) AS priorities,
    count(DISTINCT o_orderpriority || '-' || o_orderstatus) AS pairs FROM orders""",
)
def _(spark, d):
    orders = table(spark, d, "orders").withColumn("pair", composite("o_orderpriority", "o_orderstatus"))
    return bitmaps.distinct_counts(orders, [], {"customers": "o_custkey", "priorities": "o_orderpriority", "pairs": "pair"}, "rows")


@query(
    "distinct_by_group",
    """SELECT l_returnflag, count(DISTINCT l_orderkey) AS orders, count(DISTINCT l_partkey) AS parts,
    count(DISTINCT l_suppkey) AS suppliers FROM lineitem GROUP BY l_returnflag""",
)
def _(spark, d):
    """Three distinct counts of few large groups in one pass."""
    return bitmaps.distinct_counts(
        table(spark, d, "lineitem"), ["l_returnflag"], {"orders": "l_orderkey", "parts": "l_partkey", "suppliers": "l_suppkey"}
    )


@query(
    "surplus_by_hash",
    """SELECT 'lineitem' AS table_name, count(*) - (SELECT count(*) FROM (SELECT DISTINCT l_orderkey, l_linenumber FROM lineitem)) AS violations
    FROM lineitem UNION ALL
    SELECT 'events', count(*) - (SELECT count(*) FROM (SELECT DISTINCT user_id, event_type, CAST(ts AS DATE) FROM events)) FROM events""",
)
def _(spark, d):
    """Rows beyond the first of a wide key; only hashes are shuffled, and the keys of those that repeat."""
    events = table(spark, d, "events").withColumn("day", F.col("ts").cast("date"))
    found = {
        "lineitem": surplus_rows(table(spark, d, "lineitem"), ["l_orderkey", "l_linenumber"]),
        "events": surplus_rows(events, ["user_id", "event_type", "day"]),
    }
    return union_all([df.select(F.lit(name).alias("table_name"), "violations") for name, df in found.items()])


@query(
    "references_in_one_scan",
    """SELECT count(*) FILTER (NOT EXISTS (FROM orders o WHERE o_orderkey = l_orderkey AND o_orderstatus <> 'F')) AS no_open_order,
      count(*) FILTER (NOT EXISTS (FROM part WHERE p_partkey = l_partkey AND p_size > 10)) AS no_large_part,
      count(*) FILTER (NOT EXISTS (FROM supplier, nation WHERE s_suppkey = l_suppkey AND s_nationkey = n_nationkey AND n_regionkey < 3))
        AS no_near_supplier,
      count(*) FILTER (l_quantity > 45) AS large FROM lineitem""",
)
def _(spark, d):
    """Three references and a condition, with many rows that break each."""
    near = table(spark, d, "nation").where("n_regionkey < 3").select(F.col("n_nationkey").alias("s_nationkey"))
    sets = {
        "open_order": key_set(table(spark, d, "orders").where("o_orderstatus <> 'F'").withColumnRenamed("o_orderkey", "l_orderkey"), ["l_orderkey"]),
        "large_part": key_set(table(spark, d, "part").where("p_size > 10").withColumnRenamed("p_partkey", "l_partkey"), ["l_partkey"]),
        "near_supplier": key_set(table(spark, d, "supplier").join(near, "s_nationkey").withColumnRenamed("s_suppkey", "l_suppkey"), ["l_suppkey"]),
    }
    counts = [F.count_if(~F.coalesce(F.col(name), F.lit(False))).alias(f"no_{name}") for name in sets]
    return marked(table(spark, d, "lineitem"), sets).agg(*counts, F.count_if(F.col("l_quantity") > 45).alias("large"))


@query(
    "missing_profile",
    RAW_SQL
    + "SELECT "
    + ", ".join(
        f"count(*) FILTER ({c} IS NULL OR trim({c}) IN ('', '?')) AS missing_{c}"
        for c in ("orderkey", "custkey", "status", "priority", "price", "units")
    )
    + " FROM raw",
)
def _(spark, d):
    raw = raw_orders(spark, d)
    return profile.missing_profile(raw, raw.columns)


@query(
    "numeric_profile",
    RAW_SQL
    + f"""SELECT min(u) AS least, max(u) AS greatest, {mean_sql('u')} AS mean, count(*) FILTER (u <= 10) AS small,
    count(u) AS present FROM (SELECT TRY_CAST(nullif(nullif(trim(units), '?'), '') AS BIGINT) AS u FROM raw)""",
)
def _(spark, d):
    units = to_int("units")
    result = profile.numeric_profile(
        raw_orders(spark, d),
        {
            "least": F.min(units),
            "greatest": F.max(units),
            "mean": rounded_mean(units),
            "small": F.count_if(units <= 10),
            "present": F.count(units),
        },
    )
    return doubles(result, "mean")


FREQUENCY_SQL = """SELECT 'o_orderpriority' AS column_name, o_orderpriority AS category, count(*) AS frequency
    FROM orders GROUP BY o_orderpriority
    UNION ALL SELECT 'o_orderstatus', o_orderstatus, count(*) FROM orders GROUP BY o_orderstatus"""


@query("frequencies", FREQUENCY_SQL)
def _(spark, d):
    return profile.frequencies(table(spark, d, "orders"), ["o_orderpriority", "o_orderstatus"])


@query("frequencies_union", FREQUENCY_SQL)
def _(spark, d):
    orders = table(spark, d, "orders")
    return union_all(
        [
            orders.groupBy(F.col(c).alias("category"))
            .agg(F.count(F.lit(1)).alias("frequency"))
            .select(F.lit(c).alias("column_name"), "category", "frequency")
            for c in ("o_orderpriority", "o_orderstatus")
        ]
    )


@query(
    "consistency",
    """SELECT count(*) FILTER (p > 1) AS inconsistent_o_orderpriority, count(*) FILTER (s > 1) AS inconsistent_o_orderstatus
    FROM (SELECT count(DISTINCT trim(o_orderpriority)) AS p, count(DISTINCT trim(o_orderstatus)) AS s
      FROM orders GROUP BY o_custkey)""",
)
def _(spark, d):
    return profile.consistency(table(spark, d, "orders"), "o_custkey", ["o_orderpriority", "o_orderstatus"])


@query(
    "string_list",
    """SELECT o_custkey, string_agg(DISTINCT o_orderpriority || ': ' || o_orderstatus, ' | '
      ORDER BY o_orderpriority || ': ' || o_orderstatus) AS history FROM orders GROUP BY o_custkey""",
)
def _(spark, d):
    entry = composite("o_orderpriority", "o_orderstatus", sep=": ")
    return agg.string_list(table(spark, d, "orders"), ["o_custkey"], entry, "history", " | ")


@query(
    "string_list_all",
    """SELECT o_custkey, string_agg(o_orderpriority || ': ' || o_orderstatus, ' | '
      ORDER BY o_orderdate, o_orderpriority || ': ' || o_orderstatus) AS history FROM orders GROUP BY o_custkey""",
)
def _(spark, d):
    entry = composite("o_orderpriority", "o_orderstatus", sep=": ")
    return agg.string_list(table(spark, d, "orders"), ["o_custkey"], entry, "history", " | ", "o_orderdate", distinct=False)


@query(
    "group_by_expr",
    "SELECT CAST(floor(o_totalprice / 50000) AS BIGINT) AS price_class, count(*) AS orders FROM orders GROUP BY ALL",
)
def _(spark, d):
    return table(spark, d, "orders").groupBy(F.floor(F.col("o_totalprice") / 50000).alias("price_class")).agg(
        F.count(F.lit(1)).alias("orders")
    )


@query(
    "filtered_counts",
    "SELECT event_type, count(*) AS small_events FROM events WHERE value < 1 GROUP BY event_type",
)
def _(spark, d):
    return table(spark, d, "events").where("value < 1").groupBy("event_type").agg(F.count(F.lit(1)).alias("small_events"))


NUMERIC = ("l_quantity", "l_linenumber", "l_partkey")
CATEGORIES = ("l_returnflag", "l_linestatus")


@query(
    "column_stats",
    " UNION ALL ".join(
        [
            f"""SELECT '{c}' AS column_name, 'numeric' AS kind, round(avg({c}), 6) AS mean,
            CAST(median({c}) AS DOUBLE) AS median,
            (SELECT CAST({c} AS DOUBLE) FROM lineitem WHERE {c} IS NOT NULL GROUP BY {c} ORDER BY count(*) DESC, {c} LIMIT 1) AS mode,
            CAST(NULL AS VARCHAR) AS mode_label, round(stddev_pop({c}) / avg({c}), 6) AS dispersion,
            CAST(min({c}) AS DOUBLE) AS min, CAST(max({c}) AS DOUBLE) AS max, count(*) FILTER ({c} IS NULL) AS missing
            FROM lineitem"""
            for c in NUMERIC
        ]
        + [
            f"""SELECT '{c}', 'category', NULL, NULL, NULL,
            (SELECT {c} FROM lineitem WHERE {c} IS NOT NULL GROUP BY {c} ORDER BY count(*) DESC, {c} LIMIT 1),
            round(ln(sum(n)) - sum(n * ln(n)) / sum(n), 6), NULL, NULL,
            CAST((SELECT count(*) FROM lineitem WHERE {c} IS NULL) AS BIGINT)
            FROM (SELECT count(*) AS n FROM lineitem WHERE {c} IS NOT NULL GROUP BY {c})"""
            for c in CATEGORIES
        ]
    ),
)
def _(spark, d):
    stats = profile.column_stats(table(spark, d, "lineitem"), NUMERIC, CATEGORIES)
    return stats.withColumns({c: F.round(c, 6) for c in ("mean", "dispersion")})


# ------------------------------------------------------------ order, distinct, sets


@query(
    "topk",
    "SELECT o_orderkey, o_custkey, o_totalprice FROM orders ORDER BY o_totalprice DESC, o_orderkey LIMIT 10",
)
def _(spark, d):
    rows = table(spark, d, "orders").select("o_orderkey", "o_custkey", "o_totalprice")
    return top_k(rows, 10, F.desc("o_totalprice"), F.asc("o_orderkey"))


@query(
    "sort_cast",
    RAW_SQL + """SELECT orderkey, units FROM raw WHERE units IS NOT NULL
    ORDER BY CAST(units AS BIGINT), CAST(trim(orderkey) AS BIGINT) LIMIT 10""",
)
def _(spark, d):
    rows = raw_orders(spark, d).where("units IS NOT NULL").select("orderkey", "units")
    return top_k(rows, 10, to_int("units").asc(), to_int("orderkey").asc())


@query("distinct_rows", "SELECT DISTINCT l_returnflag, l_linestatus, l_linenumber FROM lineitem")
def _(spark, d):
    return distinct_rows(table(spark, d, "lineitem"), "l_returnflag", "l_linestatus", "l_linenumber")


@query(
    "first_per_key",
    """SELECT DISTINCT ON (o_custkey) o_custkey, o_orderdate, o_orderkey, o_orderpriority FROM orders
    ORDER BY o_custkey, o_orderdate, o_orderkey""",
)
def _(spark, d):
    rows = table(spark, d, "orders").select("o_custkey", "o_orderdate", "o_orderkey", "o_orderpriority")
    return first_per_key(rows, ["o_custkey"], ["o_orderdate", "o_orderkey"])


@query(
    "count_report",
    """SELECT *, total_rows - expected_rows AS difference FROM (
      SELECT 'documents' AS table_name, (SELECT count(*) FROM documents) AS total_rows,
        (SELECT count(*) FROM labels) AS expected_rows
      UNION ALL SELECT 'lineitem', (SELECT count(*) FROM lineitem), (SELECT count(*) FROM orders))""",
)
def _(spark, d):
    pairs = {"documents": "labels", "lineitem": "orders"}
    expected = union_all(
        [
            agg.row_count(table(spark, d, other), "expected_rows").select(F.lit(name).alias("table_name"), "expected_rows")
            for name, other in pairs.items()
        ]
    )
    return agg.count_report({name: table(spark, d, name) for name in pairs}, expected)


@query("preview", "SELECT * FROM supplier ORDER BY s_suppkey LIMIT 10")
def _(spark, d):
    return preview(table(spark, d, "supplier"), 10, ["s_suppkey"])


@query(
    "surrogate_keys",
    """SELECT row_number() OVER (ORDER BY l_orderkey, l_linenumber) AS line_key, l_orderkey, l_linenumber, lines
    FROM (SELECT l_orderkey, l_linenumber, count(*) AS lines FROM lineitem GROUP BY ALL)""",
)
def _(spark, d):
    lines = table(spark, d, "lineitem").groupBy("l_orderkey", "l_linenumber").agg(F.count(F.lit(1)).alias("lines"))
    return surrogate_key(lines, "line_key", ["l_orderkey", "l_linenumber"])


# ------------------------------------------------------------ rules and corrections


RULES = {
    "lineitem": (
        NotNull(("l_orderkey", "l_linenumber")),
        Unique(("l_orderkey", "l_linenumber")),
        ForeignKey(("l_orderkey",), "orders", ("o_orderkey",)),
        Check("quantity up to 45", "l_quantity <= 45"),
    ),
    "documents": (ForeignKey(("doc_id",), "labels"), Check("text length", "n_chars > 300")),
    "customer": (Check("known segment", "c_mktsegment IN ('BUILDING', 'MACHINERY')"), Check("null passes", "c_acctbal < NULL")),
}


@query(
    "unparsable_values",
    """WITH t AS (SELECT CASE WHEN l_linenumber = 7 THEN l_returnflag WHEN l_linenumber = 6 THEN '?'
        WHEN l_linenumber = 5 THEN ' ' || CAST(CAST(l_quantity AS BIGINT) AS VARCHAR) || ' ' ELSE CAST(CAST(l_quantity AS BIGINT) AS VARCHAR) END AS quantity,
      CASE WHEN l_discount > 0.05 THEN CAST(l_linenumber AS VARCHAR) || '.5x' ELSE CAST(l_linenumber AS VARCHAR) || '.5' END AS part
      FROM lineitem)
    SELECT 'quantity' AS column_name, count(*) FILTER (trim(quantity) NOT IN ('', '?')
      AND NOT regexp_matches(trim(quantity), '^[+-]?[0-9]+$')) AS unparsable_values FROM t
    UNION ALL SELECT 'part', count(*) FILTER (part LIKE '%x') FROM t""",
)
def _(spark, d):
    number = F.col("l_quantity").cast("bigint").cast("string")
    line = F.col("l_linenumber")
    quantity = F.when(line == 7, F.col("l_returnflag")).when(line == 6, "?").when(line == 5, F.concat(F.lit(" "), number, F.lit(" ")))
    half = F.concat(line.cast("string"), F.when(F.col("l_discount") > 0.05, ".5x").otherwise(".5"))
    text = table(spark, d, "lineitem").select(quantity.otherwise(number).alias("quantity"), half.alias("part"))
    return profile.unparsable(text, {"quantity": "bigint", "part": "decimal(5,2)"})


@query(
    "rule_report",
    """SELECT 'lineitem' AS table_name, 'not null: l_orderkey, l_linenumber' AS rule,
      (SELECT count(*) FROM lineitem WHERE l_orderkey IS NULL OR l_linenumber IS NULL) AS violations
    UNION ALL SELECT 'lineitem', 'unique: l_orderkey, l_linenumber',
      (SELECT count(*) FROM lineitem) - (SELECT count(*) FROM (SELECT DISTINCT l_orderkey, l_linenumber FROM lineitem))
    UNION ALL SELECT 'lineitem', 'reference: l_orderkey in orders',
      (SELECT count(*) FROM lineitem WHERE NOT EXISTS (FROM orders WHERE o_orderkey = l_orderkey))
    UNION ALL SELECT 'lineitem', 'quantity up to 45', (SELECT count(*) FROM lineitem WHERE l_quantity > 45)
    UNION ALL SELECT 'documents', 'reference: doc_id in labels',
      (SELECT count(*) FROM documents d WHERE NOT EXISTS (FROM labels l WHERE l.doc_id = d.doc_id))
    UNION ALL SELECT 'documents', 'text length', (SELECT count(*) FROM documents WHERE n_chars <= 300)
    UNION ALL SELECT 'customer', 'known segment',
      (SELECT count(*) FROM customer WHERE c_mktsegment NOT IN ('BUILDING', 'MACHINERY'))
    UNION ALL SELECT 'customer', 'null passes', 0""",
)
def _(spark, d):
    names = ("lineitem", "orders", "documents", "labels", "customer")
    return rule_report({name: table(spark, d, name) for name in names}, RULES)


@query("check_violations", "SELECT l_orderkey, l_linenumber, l_quantity FROM lineitem WHERE l_quantity > 45")
def _(spark, d):
    lines = table(spark, d, "lineitem").select("l_orderkey", "l_linenumber", "l_quantity")
    return violations(lines, RULES["lineitem"][3])


SEGMENT_CHECK = Check("known segment", f"c_mktsegment IN {SEGMENTS}")
FIXES_SQL = """WITH fixes(c_custkey, c_mktsegment) AS (
  VALUES (1, 'FURNITURE'), (2, 'NO SUCH SEGMENT'), (3, 'BUILDING'), (-1, 'BUILDING'))
"""


def _fixes(spark):
    """One good fix, one bad value, one more good fix, one unknown key."""
    rows = [(1, "FURNITURE"), (2, "NO SUCH SEGMENT"), (3, "BUILDING"), (-1, "BUILDING")]
    return literal_rows(spark, rows, "c_custkey bigint, c_mktsegment string")


@query(
    "corrections_all",
    FIXES_SQL
    + """SELECT c.c_custkey, c.c_name, coalesce(f.c_mktsegment, c.c_mktsegment) AS c_mktsegment
    FROM customer c LEFT JOIN fixes f ON f.c_custkey = c.c_custkey""",
)
def _(spark, d):
    customers = table(spark, d, "customer").select("c_custkey", "c_name", "c_mktsegment")
    return apply_corrections(customers, _fixes(spark), ["c_custkey"])


@query(
    "corrections_good",
    FIXES_SQL
    + """SELECT c.c_custkey, c.c_name, CASE WHEN f.c_mktsegment IN
      ('AUTOMOBILE', 'BUILDING', 'FURNITURE', 'HOUSEHOLD', 'MACHINERY') THEN f.c_mktsegment
      ELSE c.c_mktsegment END AS c_mktsegment
    FROM customer c LEFT JOIN fixes f ON f.c_custkey = c.c_custkey""",
)
def _(spark, d):
    customers = table(spark, d, "customer").select("c_custkey", "c_name", "c_mktsegment")
    return apply_valid_corrections(customers, _fixes(spark), ["c_custkey"], [SEGMENT_CHECK])


@query(
    "corrections_rejected",
    FIXES_SQL
    + """SELECT c.c_custkey, f.c_mktsegment, 'known segment' AS broken_rule
    FROM customer c JOIN fixes f ON f.c_custkey = c.c_custkey
    WHERE f.c_mktsegment NOT IN ('AUTOMOBILE', 'BUILDING', 'FURNITURE', 'HOUSEHOLD', 'MACHINERY')""",
)
def _(spark, d):
    customers = table(spark, d, "customer").select("c_custkey", "c_mktsegment")
    return rejected_corrections(customers, _fixes(spark), ["c_custkey"], [SEGMENT_CHECK])


@query("rows_corrected", FIXES_SQL + "SELECT count(*) AS rows_corrected FROM customer JOIN fixes USING (c_custkey)")
def _(spark, d):
    return rows_corrected(table(spark, d, "customer"), _fixes(spark), ["c_custkey"])


PROPOSALS_SQL = """WITH proposals AS (
  SELECT o_custkey AS c_custkey, o_orderkey, o_orderdate AS made,
    CASE WHEN o_orderstatus = 'O' THEN 'NO SUCH SEGMENT' WHEN o_orderkey % 2 = 0 THEN 'FURNITURE' ELSE 'BUILDING' END AS c_mktsegment
  FROM orders)
"""


def _proposals(spark, d):
    """A fix per order, so several per customer, some of them invalid; the order's date is their time stamp."""
    even = F.when(F.col("o_orderkey") % 2 == 0, "FURNITURE").otherwise("BUILDING")
    segment = F.when(F.col("o_orderstatus") == "O", "NO SUCH SEGMENT").otherwise(even)
    return table(spark, d, "orders").select(
        F.col("o_custkey").alias("c_custkey"), segment.alias("c_mktsegment"), "o_orderkey", F.col("o_orderdate").alias("made")
    )


@query(
    "corrections_several_per_key",
    PROPOSALS_SQL
    + """, latest AS (
      SELECT c_custkey, max_by(c_mktsegment, (made, o_orderkey)) AS segment FROM proposals WHERE c_mktsegment <> 'NO SUCH SEGMENT'
      GROUP BY c_custkey)
    SELECT c.c_custkey, c_name, coalesce(segment, c_mktsegment) AS c_mktsegment FROM customer c LEFT JOIN latest USING (c_custkey)""",
)
def _(spark, d):
    customers = table(spark, d, "customer").select("c_custkey", "c_name", "c_mktsegment")
    order = [F.desc("made"), F.desc("o_orderkey")]
    return apply_valid_corrections(customers, _proposals(spark, d), ["c_custkey"], [SEGMENT_CHECK], order)


@query(
    "rejected_several_per_key",
    PROPOSALS_SQL
    + """SELECT c_custkey, p.c_mktsegment, o_orderkey, 'known segment' AS broken_rule
    FROM proposals p JOIN customer USING (c_custkey) WHERE p.c_mktsegment = 'NO SUCH SEGMENT'""",
)
def _(spark, d):
    customers = table(spark, d, "customer").select("c_custkey", "c_mktsegment")
    return rejected_corrections(customers, _proposals(spark, d), ["c_custkey"], [SEGMENT_CHECK]).drop("made")


def _new_orders(spark):
    """A good row, an unknown customer, a used key, and a key that occurs twice."""
    rows = [(-1, 1, "O"), (-2, -5, "O"), (0, 1, "F"), (-3, 2, "P"), (-3, 3, "P"), (-4, 2, "X")]
    return literal_rows(spark, rows, "o_orderkey bigint, o_custkey bigint, o_orderstatus string")


ORDER_RULES = (
    Unique(("o_orderkey",)),
    ForeignKey(("o_custkey",), "customer", ("c_custkey",)),
    Check("known status", "o_orderstatus IN ('F', 'O', 'P')"),
)


@query(
    "append_valid",
    "SELECT o_orderkey, o_custkey, o_orderstatus FROM orders UNION ALL SELECT -1, 1, 'O'",
)
def _(spark, d):
    orders = table(spark, d, "orders").select("o_orderkey", "o_custkey", "o_orderstatus")
    return append_valid(orders, _new_orders(spark), ORDER_RULES, {"customer": table(spark, d, "customer")})


PARTLY_SQL = """WITH new_orders AS (
  SELECT -o_orderkey - 1 AS o_orderkey, o_custkey, o_orderstatus FROM orders
  UNION ALL SELECT -o_orderkey - 1, o_custkey, 'X' FROM orders WHERE o_orderkey % 3 = 0
  UNION ALL SELECT -o_orderkey - 1, -o_custkey - 1, 'O' FROM orders WHERE o_orderkey % 5 = 0
  UNION ALL SELECT -o_orderkey - 1, o_custkey, 'P' FROM orders WHERE o_orderkey % 7 = 0
  UNION ALL SELECT o_orderkey, o_custkey, 'F' FROM orders WHERE o_orderkey % 11 = 0),
judged AS (
  SELECT n.*, CASE WHEN c_custkey IS NULL THEN 'reference: o_custkey in customer'
    WHEN o_orderstatus NOT IN ('F', 'O', 'P') THEN 'known status' END AS broken
  FROM new_orders n LEFT JOIN customer ON c_custkey = o_custkey),
counted AS (SELECT *, count(*) FILTER (broken IS NULL) OVER (PARTITION BY o_orderkey) AS n FROM judged),
final AS (
  SELECT o_orderkey, o_custkey, o_orderstatus, CASE WHEN broken IS NOT NULL THEN broken
    WHEN n > 1 OR o_orderkey IN (SELECT o_orderkey FROM orders) THEN 'unique: o_orderkey' END AS broken_rule
  FROM counted)
"""


def _partly_valid(spark, d):
    """For each order a good new row, and for some a bad status, an unknown customer, a second good row or a used key."""
    orders = table(spark, d, "orders").select("o_orderkey", "o_custkey", "o_orderstatus")
    every = lambda n: orders.where(F.col("o_orderkey") % n == 0)
    fresh = -F.col("o_orderkey") - 1
    rows = [
        orders.withColumn("o_orderkey", fresh),
        every(3).withColumns({"o_orderkey": fresh, "o_orderstatus": F.lit("X")}),
        every(5).withColumns({"o_orderkey": fresh, "o_custkey": -F.col("o_custkey") - 1, "o_orderstatus": F.lit("O")}),
        every(7).withColumns({"o_orderkey": fresh, "o_orderstatus": F.lit("P")}),
        every(11).withColumn("o_orderstatus", F.lit("F")),
    ]
    return orders, union_all(rows), {"customer": table(spark, d, "customer")}


@query(
    "append_partly_valid",
    PARTLY_SQL
    + """SELECT o_orderkey, o_custkey, o_orderstatus FROM final WHERE broken_rule IS NULL
    UNION ALL SELECT o_orderkey, o_custkey, o_orderstatus FROM orders""",
)
def _(spark, d):
    orders, new, tables = _partly_valid(spark, d)
    return append_valid(orders, new, ORDER_RULES, tables)


@query("rows_rejected", PARTLY_SQL + "SELECT * FROM final WHERE broken_rule IS NOT NULL")
def _(spark, d):
    orders, new, tables = _partly_valid(spark, d)
    return rejected_rows(orders, new, ORDER_RULES, tables)


@query(
    "correction_evidence",
    """SELECT count(*) AS rows_before, count(*) + 1 AS rows_after, CAST(1 AS BIGINT) AS rows_foreign_to_source
    FROM orders""",
)
def _(spark, d):
    orders = table(spark, d, "orders").select("o_orderkey", "o_custkey", "o_orderstatus")
    after = append_valid(orders, _new_orders(spark), ORDER_RULES, {"customer": table(spark, d, "customer")})
    return correction_evidence(orders, after, orders, ["o_orderkey"])


@query(
    "literal_rows",
    """SELECT f.o_orderkey, f.o_orderstatus, o.o_orderstatus AS stored_status
    FROM (VALUES (CAST(0 AS BIGINT), 'F'), (-1, 'O'), (-2, 'O'), (-3, 'P'), (-4, 'X')) f(o_orderkey, o_orderstatus)
    LEFT JOIN orders o ON o.o_orderkey = f.o_orderkey""",
)
def _(spark, d):
    stored = table(spark, d, "orders").select("o_orderkey", F.col("o_orderstatus").alias("stored_status"))
    return _new_orders(spark).drop("o_custkey").distinct().join(stored, "o_orderkey", "left")


ORDER_COLUMNS = ("o_orderkey", "o_custkey", "o_orderstatus", "o_totalprice")


@query(
    "row_difference",
    """WITH old AS (SELECT o_orderkey, o_custkey, o_orderstatus, o_totalprice FROM orders),
    edited AS (
        SELECT o_orderkey, CASE WHEN o_orderkey % 79 = 0 THEN o_custkey + 1 ELSE o_custkey END AS o_custkey,
               CASE WHEN o_orderkey % 89 = 0 THEN 'X' ELSE o_orderstatus END AS o_orderstatus,
               CASE WHEN o_orderkey % 83 <> 0 THEN o_totalprice END AS o_totalprice
        FROM old WHERE o_orderkey % 97 <> 0),
    new AS (
        FROM edited UNION ALL (SELECT -o_orderkey, o_custkey, o_orderstatus, o_totalprice FROM edited WHERE o_orderkey % 73 = 0)
        UNION ALL (FROM edited WHERE o_orderkey % 71 = 0)),
    d AS (
        SELECT o_orderkey, o_custkey, o_orderstatus, o_totalprice, CAST(sum(sign) AS BIGINT) AS more
        FROM (SELECT *, 1 AS sign FROM old UNION ALL SELECT *, -1 FROM new) GROUP BY ALL HAVING sum(sign) <> 0),
    k AS (
        SELECT o_orderkey, CAST(coalesce(sum(more) FILTER (more > 0), 0) AS BIGINT) AS rows_lost,
               CAST(coalesce(-sum(more) FILTER (more < 0), 0) AS BIGINT) AS rows_added,
               concat_ws(', ',
                   CASE WHEN max(o_custkey) FILTER (more > 0) IS DISTINCT FROM max(o_custkey) FILTER (more < 0) THEN 'o_custkey' END,
                   CASE WHEN max(o_orderstatus) FILTER (more > 0) IS DISTINCT FROM max(o_orderstatus) FILTER (more < 0) THEN 'o_orderstatus' END,
                   CASE WHEN max(o_totalprice) FILTER (more > 0) IS DISTINCT FROM max(o_totalprice) FILTER (more < 0) THEN 'o_totalprice' END) AS names
        FROM d GROUP BY o_orderkey)
    SELECT o_orderkey, CASE WHEN rows_lost = 1 AND rows_added = 1 THEN 'changed' WHEN rows_added = 0 THEN 'lost'
                            WHEN rows_lost = 0 THEN 'added' ELSE 'several' END AS kind,
           rows_lost, rows_added, CASE WHEN rows_lost = 1 AND rows_added = 1 THEN names END AS changed_columns
    FROM k""",
)
def _(spark, d):
    """Orders against an edited copy: rows left out, changed, new and repeated."""
    key = F.col("o_orderkey")
    old = table(spark, d, "orders").select(*ORDER_COLUMNS)
    edited = old.where(key % 97 != 0).withColumns(
        {
            "o_custkey": F.when(key % 79 == 0, F.col("o_custkey") + 1).otherwise(F.col("o_custkey")),
            "o_orderstatus": F.when(key % 89 == 0, "X").otherwise(F.col("o_orderstatus")),
            "o_totalprice": F.when(key % 83 != 0, F.col("o_totalprice")),
        }
    )
    new = union_all([edited, edited.where(key % 73 == 0).withColumn("o_orderkey", -key), edited.where(key % 71 == 0)])
    return row_difference(old, new, ["o_orderkey"])
