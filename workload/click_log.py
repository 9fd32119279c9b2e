"""Click-log consolidation and aggregates over the event stream and order lines."""

from pyspark.sql import functions as F

from tallyframe.functions import week_trunc
from tallyframe.operators import aggregates as agg
from tallyframe.operators.ordering import top_k
from tallyframe.plans.marts import dim_date
from workload.registry import doubles, query
from workload.staging_sql import rounded_mean, rounded_pct
from workload.tables import clicks, table

CLICK_KEY = ["user_id", "event_type", "day"]

CLICKS_SQL = """WITH raw AS (
  SELECT event_id, user_id, event_type, date_diff('day', DATE '2024-01-08', CAST(ts AS DATE)) AS day,
    CAST(round(value * 100) AS BIGINT) AS clicks FROM events),
clean AS (SELECT user_id, event_type, day, CAST(sum(clicks) AS BIGINT) AS clicks FROM raw GROUP BY ALL)
"""


def consolidated(spark, d):
    return agg.consolidate(clicks(spark, d), CLICK_KEY, ["clicks"])


@query("consolidate_events", CLICKS_SQL + "SELECT * FROM clean")
def _(spark, d):
    return consolidated(spark, d)


@query(
    "consolidate_lineitem",
    """SELECT l_orderkey, l_linenumber, CAST(sum(CAST(l_quantity AS BIGINT)) AS BIGINT) AS quantity
    FROM lineitem GROUP BY ALL""",
)
def _(spark, d):
    lines = table(spark, d, "lineitem").withColumn("quantity", F.col("l_quantity").cast("bigint"))
    return agg.consolidate(lines, ["l_orderkey", "l_linenumber"], ["quantity"])


@query(
    "consolidation_report",
    CLICKS_SQL
    + f"""SELECT raw_rows, clean_rows, raw_rows - clean_rows AS collapsed_rows,
    {rounded_pct("(raw_rows - clean_rows)", "raw_rows")} AS collapsed_pct
    FROM (SELECT (SELECT count(*) FROM raw) AS raw_rows, (SELECT count(*) FROM clean) AS clean_rows)""",
)
def _(spark, d):
    return doubles(agg.consolidation_report(clicks(spark, d), consolidated(spark, d)), "collapsed_pct")


@query(
    "engagement_by_user",
    CLICKS_SQL
    + """SELECT user_id, CAST(sum(clicks) AS BIGINT) AS total_clicks, count(DISTINCT day) AS active_days,
    count(DISTINCT event_type) AS distinct_resources, min(day) AS first_active_day, max(day) AS last_active_day
    FROM clean GROUP BY user_id""",
)
def _(spark, d):
    return agg.engagement(consolidated(spark, d), ["user_id"], "clicks", "day", "event_type")


@query(
    "event_popularity",
    CLICKS_SQL
    + """SELECT event_type, CAST(sum(clicks) AS BIGINT) AS total_clicks, count(DISTINCT user_id) AS distinct_students
    FROM clean GROUP BY event_type""",
)
def _(spark, d):
    return agg.popularity(consolidated(spark, d), ["event_type"], "clicks", "user_id")


TREND_SQL = (
    CLICKS_SQL
    + """SELECT event_type, {week} AS presentation_week, CAST(sum(clicks) AS BIGINT) AS total_clicks,
    count(DISTINCT user_id) AS distinct_students FROM clean GROUP BY ALL"""
)


@query("weekly_trend_floor", TREND_SQL.format(week="CAST(floor(day / 7.0) AS BIGINT)"))
def weekly_trend_floor(spark, d):
    return agg.weekly_trend(consolidated(spark, d), ["event_type"], "day", "clicks", "user_id")


@query("weekly_trend_trunc", TREND_SQL.format(week="CAST(trunc(day / 7.0) AS BIGINT)"))
def _(spark, d):
    return agg.weekly_trend(consolidated(spark, d), ["event_type"], "day", "clicks", "user_id", week=week_trunc)


@query(
    "top_resources",
    CLICKS_SQL
    + """SELECT user_id, event_type, CAST(sum(clicks) AS BIGINT) AS total_clicks FROM clean
    GROUP BY ALL ORDER BY total_clicks DESC, user_id, event_type LIMIT 5""",
)
def _(spark, d):
    totals = agg.consolidate(consolidated(spark, d), ["user_id", "event_type"], ["clicks"]).withColumnRenamed(
        "clicks", "total_clicks"
    )
    return top_k(totals, 5, F.desc("total_clicks"), F.asc("user_id"), F.asc("event_type"))


@query(
    "clicks_by_date_dimension",
    CLICKS_SQL
    + """, dim_date AS (
      SELECT CAST(d AS BIGINT) AS date_key, CAST(trunc(d / 7.0) AS BIGINT) AS week_number, d < 0 AS is_before_start
      FROM range(-150, 301) t(d))
    SELECT week_number, is_before_start, CAST(sum(clicks) AS BIGINT) AS total_clicks, count(DISTINCT day) AS days,
      date_key IS NULL AS outside_dimension
    FROM clean LEFT JOIN dim_date ON day = date_key GROUP BY ALL""",
)
def _(spark, d):
    """Days beyond the dimension's range are counted in a group of their own."""
    joined = consolidated(spark, d).join(dim_date(spark), F.col("day") == F.col("date_key"), "left")
    groups = ["week_number", "is_before_start", F.col("date_key").isNull().alias("outside_dimension")]
    return joined.groupBy(*groups).agg(F.sum("clicks").alias("total_clicks"), F.countDistinct("day").alias("days"))


@query(
    "dim_date",
    """SELECT CAST(d AS BIGINT) AS date_key, CAST(CASE WHEN d < 0 THEN -((-d) // 7) ELSE d // 7 END AS BIGINT) AS week_number,
      d < 0 AS is_before_start, (SELECT count(*) FROM events WHERE date_diff('day', DATE '2024-01-08', CAST(ts AS DATE)) = d) AS events
    FROM range(-150, 301) t(d)""",
)
def _(spark, d):
    """The date dimension with the number of events of each day."""
    per_day = clicks(spark, d).groupBy(F.col("day").alias("date_key")).agg(F.count(F.lit(1)).alias("events"))
    return dim_date(spark).join(per_day, "date_key", "left").withColumn("events", F.coalesce("events", F.lit(0)))


MART_SQL = (
    CLICKS_SQL
    + """, used AS (
      SELECT user_id, CAST(sum(clicks) AS BIGINT) AS total_clicks, count(DISTINCT day) AS active_days,
        count(DISTINCT event_type) AS resources_used FROM clean GROUP BY user_id),
    marked AS (
      SELECT o_custkey AS user_id, count(*) AS assessment_submissions,
        (200 * CAST(sum(score) AS HUGEINT) + count(score)) // (2 * nullif(count(score), 0)) AS score_cents
      FROM (SELECT o_custkey, CASE WHEN o_orderstatus <> 'P' THEN CAST(floor(o_totalprice / 5000) AS BIGINT) END AS score
        FROM orders) GROUP BY o_custkey),
    mart AS (
      SELECT c_custkey AS user_id, c_mktsegment, coalesce(total_clicks, 0) AS total_clicks,
        coalesce(active_days, 0) AS active_days, coalesce(resources_used, 0) AS resources_used,
        coalesce(assessment_submissions, 0) AS assessment_submissions, score_cents
      FROM customer LEFT JOIN used ON used.user_id = c_custkey LEFT JOIN marked ON marked.user_id = c_custkey)
    """
)


def _mart(spark, d):
    """Customers with their events and orders; most customers have no events."""
    score = F.when(F.col("o_orderstatus") != "P", F.floor(F.col("o_totalprice") / 5000).cast("bigint"))
    customers = table(spark, d, "customer").select(F.col("c_custkey").alias("user_id"), "c_mktsegment")
    marks = table(spark, d, "orders").select(F.col("o_custkey").alias("user_id"), score.alias("score"))
    clean = consolidated(spark, d)
    return agg.engagement_mart(
        customers, clean, marks, ["user_id"], ["c_mktsegment"], "clicks", "day", "event_type", "score"
    )


@query("engagement_mart", MART_SQL + "SELECT * EXCLUDE score_cents, CAST(score_cents AS DOUBLE) / 100 AS average_score FROM mart")
def _(spark, d):
    return doubles(_mart(spark, d), "average_score")


@query(
    "engagement_by_result",
    MART_SQL
    + f"""SELECT c_mktsegment, count(*) AS registrations, {rounded_mean("total_clicks")} AS average_total_clicks,
    {rounded_mean("active_days")} AS average_active_days, {rounded_mean("resources_used")} AS average_resources_used,
    {rounded_mean("assessment_submissions")} AS average_assessment_submissions,
    CAST((2 * sum(score_cents) + count(score_cents)) // (2 * nullif(count(score_cents), 0)) AS DOUBLE) / 100 AS average_score
    FROM mart GROUP BY c_mktsegment""",
)
def _(spark, d):
    result = agg.engagement_by_result(_mart(spark, d), "c_mktsegment")
    return doubles(result, *[c for c in result.columns if c.startswith("average_")])
