"""The staging -> clean -> analytics -> quality -> mart workflow over derived tables."""

import re

from pyspark.sql import functions as F

from tallyframe.operators import aggregates as agg
from tallyframe.operators import bitmaps
from tallyframe.operators.joins import union_all
from tallyframe.operators.quality import Check, ForeignKey, NotNull, rule_report
from tallyframe.operators.references import all_present
from tallyframe.plans import analytics, clean, marts, profiling, quality
from tallyframe.schemas import PRESENTATION_KEY
from tallyframe.session import materialise, scratch
from tallyframe.sinks import Clustering, read_clustered, replace_table
from workload.registry import doubles, query
from workload.staging_sql import LAYERS, flawed_sql, rounded_mean, rounded_pct
from workload.tables import CONTEXT, SHARED, flawed, layers, staging


def sql(body: str, *ctes: str) -> str:
    return LAYERS + "".join(f",\n{c}" for c in ctes) + "\n" + body


# ------------------------------------------------------------ staging and clean layer


@query(
    "staging_counts",
    sql(" UNION ALL ".join(f"SELECT '{t}' AS table_name, count(*) AS total_rows FROM {t}" for t in quality.STAGING_TABLES)),
)
def _(spark, d):
    return agg.count_report(staging(spark, d))


def _register_clean(name):
    @query(name, sql(f"SELECT * FROM {name}"))
    def _(spark, d):
        return layers(spark, d)[name]


for _name in quality.CLEAN_TABLES:
    _register_clean(_name)


@query(
    "interaction_consolidation",
    sql(
        f"""SELECT raw_rows, clean_rows, raw_rows - clean_rows AS collapsed_rows,
        {rounded_pct("(raw_rows - clean_rows)", "raw_rows")} AS collapsed_pct
        FROM (SELECT (SELECT count(*) FROM stg_student_vle) AS raw_rows,
          (SELECT count(*) FROM clean_student_vle_interaction) AS clean_rows)"""
    ),
)
def _(spark, d):
    t = layers(spark, d)
    return doubles(
        agg.consolidation_report(t["stg_student_vle"], t["clean_student_vle_interaction"]), "collapsed_pct"
    )


@query(
    "interaction_evidence",
    sql(
        """SELECT count(*) AS cleaned_rows, min(interaction_date) AS earliest_interaction_day,
        max(interaction_date) AS latest_interaction_day, min(sum_click) AS minimum_sum_click,
        max(sum_click) AS maximum_sum_click, count(*) FILTER (sum_click <= 0) AS nonpositive_click_rows
        FROM clean_student_vle_interaction"""
    ),
)
def _(spark, d):
    return layers(spark, d)["clean_student_vle_interaction"].agg(
        F.count(F.lit(1)).alias("cleaned_rows"),
        F.min("interaction_date").alias("earliest_interaction_day"),
        F.max("interaction_date").alias("latest_interaction_day"),
        F.min("sum_click").alias("minimum_sum_click"),
        F.max("sum_click").alias("maximum_sum_click"),
        F.count_if(F.col("sum_click") <= 0).alias("nonpositive_click_rows"),
    )


# ------------------------------------------------------------ analytics layer


@query(
    "analytics_student_engagement",
    sql("SELECT * EXCLUDE score_cents, CAST(score_cents AS DOUBLE) / 100 AS average_score FROM analytics_student_engagement"),
)
def _(spark, d):
    return doubles(analytics.student_engagement(layers(spark, d)), "average_score")


@query("analytics_completion_by_presentation", sql("SELECT * FROM analytics_completion_by_presentation"))
def _(spark, d):
    return doubles(analytics.completion_by_presentation(layers(spark, d)), "successful_completion_rate_pct")


@query("analytics_assessment_performance", sql("SELECT * FROM analytics_assessment_performance"))
def _(spark, d):
    return doubles(analytics.assessment_performance(layers(spark, d)), "average_score", "banked_result_rate_pct")


@query(
    "assessment_performance_inner",
    sql(
        f"""SELECT a.code_module, a.code_presentation, a.assessment_type, count(*) AS submissions,
        count(*) FILTER (sa.score IS NULL) AS missing_scores, {rounded_mean("sa.score")} AS average_score,
        {rounded_pct("sum(sa.is_banked)", "count(sa.is_banked)")} AS banked_result_rate_pct
        FROM clean_assessment a JOIN clean_student_assessment sa ON sa.id_assessment = a.id_assessment
        GROUP BY a.code_module, a.code_presentation, a.assessment_type"""
    ),
)
def _(spark, d):
    return doubles(
        analytics.assessment_performance(layers(spark, d), "inner"), "average_score", "banked_result_rate_pct"
    )


RESULT_MEANS = (
    "average_total_clicks", "average_active_days", "average_resources_used", "average_assessment_submissions",
    "average_score",
)


@query("analytics_engagement_by_result", sql("SELECT * FROM analytics_engagement_by_result"))
def _(spark, d):
    mart = analytics.student_engagement(layers(spark, d))
    return doubles(analytics.engagement_by_result(mart), *RESULT_MEANS)


@query(
    "engagement_by_result_unscored",
    sql(
        "SELECT * EXCLUDE (average_assessment_submissions, average_score) FROM analytics_engagement_by_result"
    ),
)
def _(spark, d):
    mart = analytics.student_engagement(layers(spark, d))
    return doubles(analytics.engagement_by_result(mart, with_score=False), *RESULT_MEANS[:3])


@query(
    "resource_availability",
    sql(
        """SELECT code_module, code_presentation, activity_type, count(*) AS resources,
        count(*) FILTER (week_from IS NULL OR week_to IS NULL) AS resources_missing_week_information,
        min(week_from) AS earliest_week, max(week_to) AS latest_week FROM clean_vle_resource GROUP BY ALL"""
    ),
)
def _(spark, d):
    return analytics.resource_availability(layers(spark, d))


@query(
    "student_engagement_summary",
    sql(
        """SELECT code_module, code_presentation, id_student, CAST(sum(sum_click) AS BIGINT) AS total_clicks,
        count(DISTINCT interaction_date) AS active_days, count(DISTINCT id_site) AS distinct_resources,
        min(interaction_date) AS first_active_day, max(interaction_date) AS last_active_day
        FROM clean_student_vle_interaction GROUP BY ALL"""
    ),
)
def _(spark, d):
    clicks = layers(spark, d)["clean_student_vle_interaction"]
    return analytics.click_log_aggregates(clicks)["student_engagement_summary"]


def _clustered_clicks(spark, d):
    """The clean clicks as the workflow stores them: by presentation, and clustered by student."""
    clicks, path = layers(spark, d)["clean_student_vle_interaction"], scratch(spark, "clicks")
    cluster = Clustering(("id_student",), spark.sparkContext.defaultParallelism, ("id_student", "id_site"))
    replace_table(clicks, path, PRESENTATION_KEY, cluster=cluster)
    return read_clustered(spark, f"clicks_{path.rpartition('-')[2]}", path, clicks.schema)


@query(
    "engagement_from_bitmaps",
    sql(
        """SELECT code_module, code_presentation, id_student, CAST(sum(sum_click) AS BIGINT) AS total_clicks,
        count(DISTINCT interaction_date) AS active_days, count(DISTINCT id_site) AS distinct_resources,
        min(interaction_date) AS first_active_day, max(interaction_date) AS last_active_day
        FROM clean_student_vle_interaction GROUP BY ALL"""
    ),
)
def _(spark, d):
    """The engagement summary from stored bitmaps of clustered clicks."""
    stored = materialise(analytics.engagement_bitmaps(_clustered_clicks(spark, d)), "bitmaps")
    return bitmaps.engagement_counts(stored, analytics.SUMMARY_KEY)


@query(
    "presentation_engagement",
    sql(
        """SELECT code_module, code_presentation, CAST(sum(sum_click) AS BIGINT) AS total_clicks,
        count(DISTINCT interaction_date) AS active_days, count(DISTINCT id_site) AS distinct_resources,
        min(interaction_date) AS first_active_day, max(interaction_date) AS last_active_day
        FROM clean_student_vle_interaction GROUP BY ALL"""
    ),
)
def _(spark, d):
    """The students' bitmaps merged by presentation."""
    stored = materialise(analytics.engagement_bitmaps(_clustered_clicks(spark, d)), "bitmaps")
    return analytics.presentation_engagement(stored)


@query(
    "resource_popularity",
    sql(
        """SELECT code_module, code_presentation, id_site, CAST(sum(sum_click) AS BIGINT) AS total_clicks,
        count(DISTINCT id_student) AS distinct_students FROM clean_student_vle_interaction GROUP BY ALL"""
    ),
)
def _(spark, d):
    clicks = layers(spark, d)["clean_student_vle_interaction"]
    return analytics.click_log_aggregates(clicks)["resource_popularity"]


TREND = """trend AS (
  SELECT code_module, code_presentation, CAST(floor(interaction_date / 7.0) AS BIGINT) AS presentation_week,
    CAST(sum(sum_click) AS BIGINT) AS total_clicks, count(DISTINCT id_student) AS distinct_students
  FROM clean_student_vle_interaction GROUP BY ALL)"""


@query("weekly_engagement_trend", sql("SELECT * FROM trend", TREND))
def _(spark, d):
    clicks = layers(spark, d)["clean_student_vle_interaction"]
    return analytics.click_log_aggregates(clicks)["weekly_engagement_trend"]


@query(
    "presentation_trend",
    sql(
        """SELECT * FROM trend WHERE code_module = 'AAA' AND code_presentation = '1996J'
        ORDER BY presentation_week""",
        TREND,
    ),
)
def _(spark, d):
    clicks = layers(spark, d)["clean_student_vle_interaction"]
    trend = analytics.click_log_aggregates(clicks)["weekly_engagement_trend"]
    return analytics.presentation_trend(trend, "AAA", "1996J")


# ------------------------------------------------------------ raw profiles

KNOWN = "nullif(nullif(trim({0}), '?'), '')"


def known(c: str) -> str:
    return KNOWN.format(c)


def number(c: str) -> str:
    return f"TRY_CAST({known(c)} AS BIGINT)"


def _register_profiles(table):
    columns = profiling.SOURCE_BY_TABLE[table].columns
    missing = ", ".join(f"count(*) FILTER ({known(c)} IS NULL) AS missing_{c}" for c in columns)

    @query(f"missing_{table}", sql(f"SELECT {missing} FROM {table}"))
    def _(spark, d):
        return profiling.missing_values(staging(spark, d), table)

    keys = ", ".join(k if k == "date" else f"trim({k}) AS {k}" for k in profiling.RAW_KEYS[table])

    @query(
        f"repeated_{table}",
        flawed_sql(f"SELECT {keys}, count(*) AS number_of_records FROM {table} GROUP BY ALL HAVING count(*) > 1"),
    )
    def _(spark, d):
        return profiling.repeated_keys(flawed(spark, d), table)


for _name in quality.STAGING_TABLES:
    _register_profiles(_name)


def _register_unknown(table):
    @query(
        f"unknown_presentations_{table}",
        flawed_sql(
            f"""SELECT trim(code_module) AS code_module, code_presentation, count(*) AS unmatched_records FROM {table} t
            WHERE NOT EXISTS (FROM stg_courses c WHERE c.code_module = trim(t.code_module)
              AND c.code_presentation = t.code_presentation) GROUP BY ALL"""
        ),
    )
    def _(spark, d):
        return profiling.unknown_presentations(flawed(spark, d), table)


for _name in ("stg_assessments", "stg_vle", "stg_student_info"):
    _register_unknown(_name)


def _profile(name, body, function=None, rounded=(), tables=staging, over=sql):
    @query(name, over(body))
    def _(spark, d):
        return doubles((function or getattr(profiling, name))(tables(spark, d)), *rounded)


FLAWED = {"tables": flawed, "over": flawed_sql}


INFO = """(SELECT * REPLACE (trim(code_module) AS code_module, trim(id_student) AS id_student) FROM stg_student_info)"""
JOIN_INFO = f"JOIN {INFO} si USING (id_student, code_module, code_presentation)"
LENGTH = number("module_presentation_length")

_profile(
    "malformed_courses",
    f"""SELECT * FROM stg_courses WHERE NOT regexp_matches(trim(code_module), '^[A-Z]{{3}}$')
    OR NOT regexp_matches(trim(code_presentation), '^[0-9]{{4}}[BJ]$')
    OR NOT regexp_matches(trim(module_presentation_length), '^[0-9]+$') OR coalesce({LENGTH}, 0) <= 0""",
    **FLAWED,
)
_profile(
    "course_summary",
    f"""SELECT count(DISTINCT code_module) AS unique_modules, count(DISTINCT code_presentation) AS unique_presentations,
    min({LENGTH}) AS shortest_length_days, max({LENGTH}) AS longest_length_days,
    {rounded_mean(LENGTH)} AS average_length_days FROM stg_courses""",
    rounded=["average_length_days"],
)
_profile(
    "undated_assessments",
    f"SELECT assessment_type, count(*) AS missing_date_count FROM stg_assessments WHERE {known('date')} IS NULL GROUP BY ALL",
)
_profile(
    "assessment_ranges",
    f"""SELECT assessment_type, count(*) AS number_of_assessments, min({number('date')}) AS earliest_deadline_day,
    max({number('date')}) AS latest_deadline_day, min(CAST(weight AS DECIMAL(5,2))) AS minimum_weight,
    max(CAST(weight AS DECIMAL(5,2))) AS maximum_weight FROM stg_assessments GROUP BY ALL""",
)
_profile(
    "unweighted_assessments",
    """SELECT assessment_type, count(*) AS zero_weight_assessments FROM stg_assessments
    WHERE CAST(weight AS DECIMAL(5,2)) = 0 GROUP BY ALL""",
)
_profile(
    "deadlines_outside_presentation",
    f"""SELECT code_module, code_presentation, id_assessment, assessment_type, {number('date')} AS deadline_day,
    {LENGTH} AS length_days FROM stg_assessments JOIN stg_courses USING (code_module, code_presentation)
    WHERE {number('date')} < 0 OR {number('date')} > {LENGTH}""",
    **FLAWED,
)
_profile(
    "week_pairs",
    f"""SELECT count(*) FILTER (f IS NULL AND t IS NULL) AS both_weeks_missing,
    count(*) FILTER (f IS NULL AND t IS NOT NULL) AS only_week_from_missing,
    count(*) FILTER (f IS NOT NULL AND t IS NULL) AS only_week_to_missing
    FROM (SELECT {known('week_from')} AS f, {known('week_to')} AS t FROM stg_vle)""",
)
_profile(
    "week_ranges",
    f"""SELECT count(*) AS resources_with_week_information, min(f) AS earliest_week_from, max(t) AS latest_week_to,
    count(*) FILTER (f > t) AS reversed_week_ranges, count(*) FILTER (f < 0 OR t < 0) AS negative_week_records
    FROM (SELECT {number('week_from')} AS f, {number('week_to')} AS t FROM stg_vle) WHERE f IS NOT NULL AND t IS NOT NULL""",
)
_profile("resources_by_activity", "SELECT activity_type, count(*) AS number_of_resources FROM stg_vle GROUP BY ALL")
_profile(
    "missing_bands",
    f"""SELECT code_module, code_presentation, count(*) AS missing_imd_records FROM {INFO} si
    WHERE {known('imd_band')} IS NULL GROUP BY ALL""",
)
CONSISTENT = ("gender", "region", "highest_education", "imd_band", "age_band", "disability")
_profile(
    "student_consistency",
    "SELECT "
    + ", ".join(f"count(*) FILTER ({c} > 1) AS inconsistent_{c}" for c in CONSISTENT)
    + " FROM (SELECT "
    + ", ".join(f"count(DISTINCT trim({c})) AS {c}" for c in CONSISTENT)
    + " FROM stg_student_info GROUP BY id_student)",
)
_profile(
    "age_band_histories",
    f"""SELECT id_student, string_agg(DISTINCT age_band, ', ' ORDER BY age_band) AS recorded_age_bands,
    string_agg(code_module || '-' || code_presentation || ': ' || age_band, ' | '
      ORDER BY code_presentation, code_module) AS enrolment_history
    FROM {INFO} si GROUP BY id_student HAVING count(DISTINCT age_band) > 1""",
)
FREQUENT = ("gender", "age_band", "disability", "final_result", "highest_education", "imd_band", "region")
_profile(
    "student_frequencies",
    " UNION ALL ".join(
        f"SELECT '{c}' AS column_name, {c} AS category, count(*) AS frequency FROM stg_student_info GROUP BY {c}"
        for c in FREQUENT
    ),
)
_profile(
    "student_numbers",
    f"""SELECT count(DISTINCT id_student) AS unique_students, min(a) AS minimum_previous_attempts,
    max(a) AS maximum_previous_attempts, {rounded_mean('a')} AS average_previous_attempts,
    min(c) AS minimum_studied_credits, max(c) AS maximum_studied_credits, {rounded_mean('c')} AS average_studied_credits,
    count(*) FILTER (a < 0) AS negative_previous_attempts, count(*) FILTER (c <= 0) AS nonpositive_studied_credits
    FROM (SELECT id_student, {number('num_of_prev_attempts')} AS a, {number('studied_credits')} AS c FROM stg_student_info)""",
    rounded=["average_previous_attempts", "average_studied_credits"],
)
_profile(
    "largest_credit_loads",
    f"""SELECT {number('studied_credits')} AS studied_credits, count(*) AS number_of_records FROM stg_student_info
    GROUP BY {number('stg_student_info.studied_credits')} ORDER BY 1 DESC LIMIT 15""",
)
_profile(
    "dates_by_outcome",
    f"""SELECT final_result, count(*) AS total_records,
    count(*) FILTER ({known('date_registration')} IS NULL) AS missing_registration_dates,
    count(*) FILTER ({known('date_unregistration')} IS NULL) AS missing_unregistration_dates,
    count(*) FILTER ({known('date_unregistration')} IS NOT NULL) AS recorded_unregistration_dates
    FROM stg_student_registration {JOIN_INFO} GROUP BY final_result""",
)
_profile(
    "registration_mismatches",
    f"""SELECT
    (SELECT count(*) FROM stg_student_registration r WHERE NOT EXISTS (FROM {INFO} s WHERE s.id_student = r.id_student
      AND s.code_module = r.code_module AND s.code_presentation = r.code_presentation)) AS registrations_without_student_info,
    (SELECT count(*) FROM {INFO} s WHERE NOT EXISTS (FROM stg_student_registration r WHERE s.id_student = r.id_student
      AND s.code_module = r.code_module AND s.code_presentation = r.code_presentation)) AS student_info_without_registration""",
)
# The enrolment table is padded, the registration table is not; the operator compares cleaned keys.
PADDED_SIDES = [
    f"{name} AS (SELECT trim(id_student) AS s, trim(code_module) AS m, trim(code_presentation) AS p FROM {table})"
    for name, table in (("r", "stg_student_registration"), ("i", "stg_student_info"))
]
PADDED_COUNTS = """SELECT
    (SELECT count(*) FROM r ANTI JOIN i USING (s, m, p)) AS registrations_without_student_info,
    (SELECT count(*) FROM i ANTI JOIN r USING (s, m, p)) AS student_info_without_registration"""


@query("registration_mismatches_padded", sql(PADDED_COUNTS, *PADDED_SIDES))
def _(spark, d):
    return profiling.registration_mismatches(staging(spark, d))


_profile(
    "registration_ranges",
    f"""SELECT min(s) AS earliest_registration_day, max(s) AS latest_registration_day,
    min(e) AS earliest_unregistration_day, max(e) AS latest_unregistration_day,
    count(*) FILTER (e < s) AS unregistration_before_registration, count(*) FILTER (s > n) AS registration_after_module_end,
    count(*) FILTER (e > n) AS unregistration_after_module_end
    FROM (SELECT {number('date_registration')} AS s, {number('date_unregistration')} AS e, {LENGTH} AS n
      FROM stg_student_registration JOIN stg_courses USING (code_module, code_presentation))""",
)
_profile(
    "late_unregistrations",
    f"""SELECT id_student, code_module, code_presentation, date_registration, date_unregistration, {LENGTH} AS length_days,
    final_result, {number('date_unregistration')} - {LENGTH} AS days_after_module_end
    FROM stg_student_registration JOIN stg_courses USING (code_module, code_presentation) {JOIN_INFO}
    WHERE {number('date_unregistration')} > {LENGTH}""",
)
_profile(
    "earliest_unregistrations",
    f"""SELECT id_student, code_module, code_presentation, date_registration, date_unregistration, final_result
    FROM stg_student_registration {JOIN_INFO} WHERE {known('date_unregistration')} IS NOT NULL
    ORDER BY {number('date_unregistration')}, id_student, code_module, code_presentation LIMIT 10""",
)
_profile(
    "result_ranges",
    f"""SELECT min(s) AS minimum_score, max(s) AS maximum_score,
    count(*) FILTER (s NOT BETWEEN 0 AND 100) AS scores_outside_0_to_100, min(t) AS earliest_submission_day,
    max(t) AS latest_submission_day, count(*) FILTER (t < 0) AS submissions_before_module_start,
    count(*) FILTER (trim(is_banked) NOT IN ('0', '1')) AS invalid_banked_values
    FROM (SELECT {number('score')} AS s, {number('date_submitted')} AS t, is_banked FROM stg_student_assessment)""",
)
_profile(
    "early_submissions",
    f"""SELECT is_banked, count(*) AS early_submissions, min({number('date_submitted')}) AS earliest_submission_day,
    max({number('date_submitted')}) AS latest_early_submission_day FROM stg_student_assessment
    WHERE {number('date_submitted')} < 0 GROUP BY is_banked""",
)
_profile(
    "results_without_registration",
    """SELECT a.code_module, a.code_presentation, count(*) AS assessment_results_without_registration
    FROM stg_student_assessment sa JOIN stg_assessments a ON sa.id_assessment = a.id_assessment
    LEFT JOIN stg_student_registration sr ON sa.id_student = sr.id_student AND a.code_module = sr.code_module
      AND a.code_presentation = sr.code_presentation
    WHERE sr.id_student IS NULL GROUP BY a.code_module, a.code_presentation""",
    **FLAWED,
)
_profile(
    "results_without_assessment",
    """SELECT sa.id_assessment, count(*) AS unmatched_records FROM stg_student_assessment sa
    LEFT JOIN stg_assessments a ON sa.id_assessment = a.id_assessment
    WHERE a.id_assessment IS NULL GROUP BY sa.id_assessment""",
    **FLAWED,
)
LATE = f"""late AS (
  SELECT sa.id_student, sa.id_assessment, a.code_module, a.code_presentation, a.assessment_type, sa.date_submitted,
    {LENGTH} AS length_days, {number('date_submitted')} - {LENGTH} AS days_after_module_end, sa.is_banked, sa.score
  FROM stg_student_assessment sa JOIN stg_assessments a ON sa.id_assessment = a.id_assessment
  JOIN stg_courses c ON a.code_module = c.code_module AND a.code_presentation = c.code_presentation
  WHERE {number('date_submitted')} > {LENGTH})"""


@query(
    "lateness_total",
    sql(
        """SELECT count(*) AS late_submission_records, max(days_after_module_end) AS maximum_days_after_end FROM late""",
        LATE,
    ),
)
def _(spark, d):
    return profiling.lateness(staging(spark, d), by_type=False)


@query(
    "lateness_by_type",
    sql(
        """SELECT code_module, code_presentation, assessment_type, count(*) AS late_submission_records,
        max(days_after_module_end) AS maximum_days_after_end FROM late GROUP BY ALL""",
        LATE,
    ),
)
def _(spark, d):
    return profiling.lateness(staging(spark, d))


@query(
    "latest_results",
    sql("SELECT * FROM late ORDER BY days_after_module_end DESC, id_student, id_assessment LIMIT 10", LATE),
)
def _(spark, d):
    return profiling.latest_results(staging(spark, d))


# ------------------------------------------------------------ quality


def expectations(t):
    """Expected counts worked out from the given tables (orders, and lines with their orders), not from the staging tables.

    Each count of pairs, and of the pairs' students, comes from one list of different rows.
    """
    orders, lines = t["_orders"], t["_lines"]

    def numbers(df, within, *more):
        """Different values of ``within``, and of it with ``more``, both without nulls; ``rows`` counts all."""
        per_row = df.groupBy(*within, *more).agg(F.count(F.lit(1)).alias("_rows"))
        per_group = per_row.groupBy(*within).agg(
            F.sum("_rows").alias("_rows"), F.count_if(all_present([*within, *more])).alias("_whole"))
        return per_group.agg(
            F.coalesce(F.sum("_rows"), F.lit(0)).alias("rows"),
            F.count_if(all_present(within)).alias("groups"),
            F.coalesce(F.sum("_whole"), F.lit(0)).alias("whole"),
        )

    of_students = numbers(orders, ["id_student"], *CONTEXT).select(F.col("groups").alias("students"), F.col("whole").alias("registrations"))
    of_orders = orders.agg(F.countDistinct(*CONTEXT).alias("presentations"))
    of_flags = numbers(lines, ["context", "l_returnflag"], "id_student").select(F.col("groups").alias("assessments"), F.col("whole").alias("results"))
    of_lines = numbers(lines, ["context", "l_linenumber"], "id_student", "day").select(
        F.col("groups").alias("resources"), F.col("whole").alias("interactions"), F.col("rows").alias("clicks")
    )
    outcomes = t["stg_student_info"].agg(F.countDistinct("final_result").alias("outcomes"))
    q = quality
    wanted = [
        (of_orders, [
            ("stg_courses", q.STAGING_ROWS, "presentations"),
            ("clean_module_presentation", q.CLEAN_ROWS, "presentations"),
            ("analytics_completion_by_presentation", q.ANALYTICS_ROWS, "presentations"),
        ]),
        (of_students, [
            ("stg_student_info", q.STAGING_ROWS, "registrations"),
            ("stg_student_registration", q.STAGING_ROWS, "registrations"),
            ("clean_student", q.CLEAN_ROWS, "students"),
            ("clean_registration", q.CLEAN_ROWS, "registrations"),
            ("analytics_student_engagement", q.ANALYTICS_ROWS, "registrations"),
            ("analytics_completion_by_presentation", q.PRESENTATION_TOTAL, "registrations"),
            ("analytics_engagement_by_result", q.OUTCOME_TOTAL, "registrations"),
        ]),
        (of_flags, [
            ("stg_assessments", q.STAGING_ROWS, "assessments"),
            ("stg_student_assessment", q.STAGING_ROWS, "results"),
            ("clean_assessment", q.CLEAN_ROWS, "assessments"),
            ("clean_student_assessment", q.CLEAN_ROWS, "results"),
            ("analytics_assessment_performance", q.ANALYTICS_ROWS, "assessments"),
        ]),
        (of_lines, [
            ("stg_vle", q.STAGING_ROWS, "resources"),
            ("stg_student_vle", q.STAGING_ROWS, "clicks"),
            ("clean_vle_resource", q.CLEAN_ROWS, "resources"),
            ("clean_student_vle_interaction", q.CLEAN_ROWS, "interactions"),
            ("clean_student_vle_interaction", q.CONSOLIDATED_ROWS, "clicks - interactions"),
        ]),
        (outcomes, [("analytics_engagement_by_result", q.ANALYTICS_ROWS, "outcomes")]),
    ]
    return union_all(
        [
            counted.select(
                F.inline(
                    F.array(
                        *[
                            F.struct(
                                F.lit(table).alias("table_name"),
                                F.lit(check).alias("check_name"),
                                F.expr(value).alias("expected_value"),
                            )
                            for table, check, value in lines_wanted
                        ]
                    )
                )
            )
            for counted, lines_wanted in wanted
        ]
    )


EXPECTED = {
    "presentations": "(SELECT count(*) FROM (SELECT DISTINCT code_module, code_presentation FROM enrolments))",
    "registrations": "(SELECT count(*) FROM enrolled)",
    "students": "(SELECT count(DISTINCT o_custkey) FROM orders)",
    "assessments": "(SELECT count(*) FROM (SELECT DISTINCT context, l_returnflag FROM lines))",
    "resources": "(SELECT count(*) FROM (SELECT DISTINCT context, l_linenumber FROM lines))",
    "results": "(SELECT count(*) FROM (SELECT DISTINCT context, l_returnflag, id_student FROM lines))",
    "interactions": "(SELECT count(*) FROM (SELECT DISTINCT context, l_linenumber, id_student, day FROM lines))",
    "clicks": "(SELECT count(*) FROM lines)",
    "outcomes": "(SELECT count(DISTINCT final_result) FROM stg_student_info)",
}


def _count(table, where="true"):
    return f"(SELECT count(*) FROM {table} WHERE {where})"


def _absent(*columns):
    return " OR ".join(f"{known(c)} IS NULL" for c in columns)


def _lone(parent, *keys):
    match = " AND ".join(f"p.{k} = i.{k}" for k in keys)
    return f"(SELECT count(*) FROM clean_student_vle_interaction i WHERE NOT EXISTS (FROM {parent} p WHERE {match}))"


def _report_sql():
    """(layer, table, check, observed value, expected value or None for information)."""
    e, q = EXPECTED, quality
    staging_rows = ("presentations", "assessments", "resources", "registrations", "registrations", "results", "clicks")
    clean_rows = ("presentations", "students", "registrations", "assessments", "resources", "results", "interactions")
    analytics_rows = ("registrations", "presentations", "assessments", "outcomes")
    clicks = "clean_student_vle_interaction"
    lines = [("staging", t, q.STAGING_ROWS, _count(t), e[x]) for t, x in zip(q.STAGING_TABLES, staging_rows, strict=True)]
    lines += [
        ("staging", "stg_courses", "missing required course values",
         _count("stg_courses", _absent("code_module", "code_presentation", "module_presentation_length")), "0"),
        ("staging", "stg_assessments", "duplicate assessment identifiers",
         "(SELECT count(*) FROM (SELECT 1 FROM stg_assessments GROUP BY id_assessment HAVING count(*) > 1))", "0"),
        ("staging", "stg_assessments", "missing assessment dates", _count("stg_assessments", _absent("date")), None),
        ("staging", "stg_vle", "resources with both week fields missing",
         _count("stg_vle", f"{known('week_from')} IS NULL AND {known('week_to')} IS NULL"), None),
        ("staging", "stg_vle", "incomplete or reversed resource-week pairs",
         _count("stg_vle", f"({known('week_from')} IS NULL) <> ({known('week_to')} IS NULL)"
                           f" OR {number('week_to')} < {number('week_from')}"), "0"),
        ("staging", "stg_student_info", "missing IMD-band values", _count("stg_student_info", _absent("imd_band")), None),
        ("staging", "stg_student_info", "nonstandard 10-20 IMD labels",
         _count("stg_student_info", "trim(imd_band) = '10-20'"), None),
        ("staging", "stg_student_registration", "missing registration dates",
         _count("stg_student_registration", _absent("date_registration")), None),
        ("staging", "stg_student_registration", "missing unregistration dates",
         _count("stg_student_registration", _absent("date_unregistration")), None),
        ("staging", "stg_student_assessment", "missing assessment scores",
         _count("stg_student_assessment", _absent("score")), None),
        ("staging", "stg_student_vle", "missing required interaction values",
         _count("stg_student_vle", _absent("code_module", "code_presentation", "id_student", "id_site", "date", "sum_click")),
         "0"),
    ]
    lines += [("clean", t, q.CLEAN_ROWS, _count(t), e[x]) for t, x in zip(q.CLEAN_TABLES, clean_rows, strict=True)]
    lines += [
        ("clean", "clean_student", "unstandardised IMD labels remaining", _count("clean_student", "imd_band = '10-20'"), "0"),
        ("clean", "clean_registration", "unregistration before registration",
         _count("clean_registration", "date_unregistration < date_registration"), "0"),
        ("clean", "clean_student_assessment", "scores outside 0 to 100",
         _count("clean_student_assessment", "score NOT BETWEEN 0 AND 100"), "0"),
        ("clean", clicks, q.CONSOLIDATED_ROWS, f"{_count('stg_student_vle')} - {_count(clicks)}",
         f"{e['clicks']} - {e['interactions']}"),
        ("clean", clicks, "nonpositive click totals", _count(clicks, "sum_click <= 0"), "0"),
        ("clean", clicks, "interactions without registration",
         _lone("clean_registration", "id_student", "code_module", "code_presentation"), "0"),
        ("clean", clicks, "interactions without contextual resource",
         _lone("clean_vle_resource", "id_site", "code_module", "code_presentation"), "0"),
    ]
    lines += [
        ("analytics", t, q.ANALYTICS_ROWS, _count(t), e[x])
        for t, x in zip(q.ANALYTICS_TABLES, analytics_rows, strict=True)
    ]
    lines += [
        ("analytics", "analytics_completion_by_presentation", q.PRESENTATION_TOTAL,
         "(SELECT sum(registered_students) FROM analytics_completion_by_presentation)", e["registrations"]),
        ("analytics", "analytics_engagement_by_result", q.OUTCOME_TOTAL,
         "(SELECT sum(registrations) FROM analytics_engagement_by_result)", e["registrations"]),
    ]
    return " UNION ALL ".join(
        f"""SELECT {i} AS check_order, '{layer}' AS layer, '{table}' AS table_name, '{check}' AS check_name,
        CAST({observed} AS VARCHAR) AS observed_value,
        {"'Documented source characteristic'" if wanted is None else f"'Exactly ' || CAST({wanted} AS VARCHAR)"} AS expectation,
        {"'INFO'" if wanted is None else f"CASE WHEN {observed} = {wanted} THEN 'PASS' ELSE 'FAIL' END"} AS status"""
        for i, (layer, table, check, observed, wanted) in enumerate(lines, start=1)
    )


CLEAN_FACTS = ("clean_registration", "clean_student_assessment", "clean_student_vle_interaction")


# The staging tables that several steps use; clicks are read off the stored lines.
SHARED_STAGING = tuple(t for t in quality.STAGING_TABLES if t != "stg_student_vle")


def _stored(spark, d, stg=None):
    """Layers over stored enrolments and lines, as staging tables would be stored."""
    return layers(spark, d, stg).written(*SHARED)


def _all_layers(spark, d):
    """All layers; the tables that several steps use are written out once."""
    return _stored(spark, d).written(*SHARED_STAGING, *quality.CLEAN_TABLES).also(
        {
            "analytics_student_engagement": lambda t: materialise(analytics.student_engagement(t), "engagement"),
            "analytics_completion_by_presentation": lambda t: analytics.completion_by_presentation(t),
            "analytics_assessment_performance": lambda t: analytics.assessment_performance(t),
            "analytics_engagement_by_result": lambda t: analytics.engagement_by_result(t["analytics_student_engagement"]),
        }
    )


@query("quality_report", sql(_report_sql()))
def _(spark, d):
    t = _all_layers(spark, d)
    return quality.full_report(t, expectations(t)).drop("interpretation")


def _gate_sql(lines):
    return " UNION ALL ".join(
        f"""SELECT '{check}' AS check_name, CAST({observed} AS VARCHAR) AS observed_value,
        CASE WHEN {observed} = {wanted} THEN 'PASS' ELSE 'FAIL' END AS status"""
        for check, observed, wanted in lines
    )


@query(
    "clean_gate",
    flawed_sql(
        _gate_sql(
            [
                ("nonpositive click totals", _count("clean_student_vle_interaction", "sum_click <= 0"), "0"),
                ("interactions without registration",
                 _lone("clean_registration", "id_student", "code_module", "code_presentation"), "0"),
                ("interactions without contextual resource",
                 _lone("clean_vle_resource", "id_site", "code_module", "code_presentation"), "0"),
            ]
        )
    ),
)
def _(spark, d):
    t = _stored(spark, d, flawed(spark, d)).written("stg_student_info", "clean_student_vle_interaction")
    return quality.clean_gate_report(t).select("check_name", "observed_value", "status")


@query(
    "analytics_gate",
    sql(
        _gate_sql(
            [
                (quality.ANALYTICS_ROWS, _count("analytics_student_engagement"), EXPECTED["registrations"]),
                (quality.PRESENTATION_TOTAL,
                 "(SELECT sum(registered_students) FROM analytics_completion_by_presentation)", EXPECTED["registrations"]),
                (quality.OUTCOME_TOTAL,
                 "(SELECT sum(registrations) FROM analytics_engagement_by_result)", EXPECTED["registrations"]),
                ("invalid completion rates",
                 _count("analytics_completion_by_presentation", "successful_completion_rate_pct NOT BETWEEN 0 AND 100"), "0"),
                ("invalid assessment scores",
                 _count("analytics_assessment_performance", "average_score NOT BETWEEN 0 AND 100"), "0"),
            ]
        )
    ),
)
def _(spark, d):
    t = _all_layers(spark, d)
    report = quality.analytics_gate_report(t, expectations(t))
    return report.select("check_name", "observed_value", "status")


# When a row breaks the rule of a name (or of a table and a name), written here anew in SQL.
BROKEN = {
    "length above zero": "module_presentation_length < 1",
    "known gender": "gender <> 'M' AND gender <> 'F'",
    "known disability flag": "disability <> 'Y' AND disability <> 'N'",
    "known deprivation band": "NOT regexp_matches(imd_band, '^([1-8]0|0)-[1-9]0%$|^90-100%$') OR imd_band = '0-20%'",
    "known age band": "age_band <> '0-35' AND age_band <> '35-55' AND age_band <> '55<='",
    ("clean_registration", "attempts not negative"): "num_of_prev_attempts < 0",
    ("fact_learning_engagement", "attempts not negative"): "previous_attempts < 0",
    "credits above zero": "studied_credits < 1",
    "known result": "final_result NOT IN ('Pass', 'Fail', 'Withdrawn', 'Distinction')",
    "unregistered after registering": "date_registration > date_unregistration",
    "known assessment type": "assessment_type NOT IN ('Exam', 'CMA', 'TMA')",
    "weight within 0 to 100": "weight < 0 OR weight > 100",
    "weeks both missing or in order": "(week_from IS NULL) <> (week_to IS NULL) OR week_from < 0 OR week_from > week_to",
    "banked flag 0 or 1": "is_banked < 0 OR is_banked > 1",
    "score within 0 to 100": "score < 0 OR score > 100",
    "clicks above zero": "sum_click < 1",
    "clicks not negative": "total_clicks < 0",
    "days not negative": "active_days < 0",
    "resources not negative": "resources_used < 0",
    "submissions not negative": "assessment_submissions < 0",
    "mean score within 0 to 100": "average_score < 0 OR average_score > 100",
    "rate within 0 to 100": "successful_completion_rate_pct < 0 OR successful_completion_rate_pct > 100",
    "banked rate within 0 to 100": "banked_result_rate_pct < 0 OR banked_result_rate_pct > 100",
    "known term": "presentation_term <> 'B' AND presentation_term <> 'J'",
    "age order 1 to 3": "age_band_order < 1 OR age_band_order > 3",
    "success flag 0 or 1": "successful_completion < 0 OR successful_completion > 1",
}


def _violations_sql(table, rule):
    """The number of rows of ``table`` that break a rule, in SQL."""
    if isinstance(rule, NotNull):
        return _count(table, " OR ".join(f"{c} IS NULL" for c in rule.columns))
    if isinstance(rule, Check):
        return _count(table, BROKEN.get((table, rule.name)) or BROKEN[rule.name])
    keys = ", ".join(rule.keys)
    if isinstance(rule, ForeignKey):
        pairs = zip(rule.parent_keys or rule.keys, rule.keys, strict=True)
        match = " AND ".join(f"p.{parent} = c.{child}" for parent, child in pairs)
        known_keys = " AND ".join(f"c.{k} IS NOT NULL" for k in rule.keys)
        return f"(SELECT count(*) FROM {table} c WHERE {known_keys} AND NOT EXISTS (FROM {rule.parent} p WHERE {match}))"
    return f"{_count(table)} - (SELECT count(*) FROM (SELECT DISTINCT {keys} FROM {table}))"


def _rules_sql(rules):
    return " UNION ALL ".join(
        f"SELECT '{table}' AS table_name, '{rule.name}' AS rule, CAST({_violations_sql(table, rule)} AS BIGINT) AS violations"
        for table, table_rules in rules.items()
        for rule in table_rules
    )


@query("clean_rules", flawed_sql(_rules_sql(clean.CLEAN_RULES)))
def _(spark, d):
    t = _stored(spark, d, flawed(spark, d)).written("stg_student_info", *quality.CLEAN_TABLES)
    return rule_report(t, clean.CLEAN_RULES)


ENGAGEMENT_SCORED = "engagement_scored AS (SELECT *, score_cents / 100 AS average_score FROM analytics_student_engagement)"


@query(
    "analytics_rules",
    sql(
        _rules_sql(analytics.ANALYTICS_RULES).replace("FROM analytics_student_engagement", "FROM engagement_scored"),
        ENGAGEMENT_SCORED,
    ),
)
def _(spark, d):
    return rule_report(_all_layers(spark, d), analytics.ANALYTICS_RULES)


# ------------------------------------------------------------ engagement mart

ENGAGEMENT_MART = """dim_student AS (
  SELECT row_number() OVER (ORDER BY id_student) AS student_key, * FROM clean_student),
dim_module_presentation AS (
  SELECT row_number() OVER (ORDER BY code_module, code_presentation) AS module_presentation_key, code_module,
    code_presentation, CAST(left(code_presentation, 4) AS INTEGER) AS presentation_year,
    right(code_presentation, 1) AS presentation_term, module_presentation_length FROM clean_module_presentation),
age_bands AS (
  SELECT DISTINCT age_band, CASE age_band WHEN '0-35' THEN 1 WHEN '35-55' THEN 2 WHEN '55<=' THEN 3 END AS age_band_order
  FROM clean_registration WHERE age_band IS NOT NULL),
dim_age_band AS (SELECT row_number() OVER (ORDER BY age_band_order) AS age_band_key, * FROM age_bands),
outcomes AS (
  SELECT DISTINCT final_result,
    CASE WHEN final_result IN ('Distinction', 'Pass') THEN 'Successful' WHEN final_result = 'Fail' THEN 'Unsuccessful'
      ELSE final_result END AS outcome_category,
    CASE WHEN final_result IN ('Distinction', 'Pass') THEN 1 ELSE 0 END AS successful_completion,
    CASE final_result WHEN 'Distinction' THEN 1 WHEN 'Pass' THEN 2 WHEN 'Fail' THEN 3 WHEN 'Withdrawn' THEN 4 END
      AS outcome_order
  FROM clean_registration WHERE final_result IS NOT NULL),
dim_outcome AS (SELECT row_number() OVER (ORDER BY outcome_order) AS outcome_key, * FROM outcomes),
fact_learning_engagement AS (
  SELECT row_number() OVER (ORDER BY student_key, module_presentation_key) AS engagement_fact_key, student_key,
    module_presentation_key, age_band_key, outcome_key, studied_credits, num_of_prev_attempts AS previous_attempts,
    total_clicks, active_days, resources_used, assessment_submissions, CAST(score_cents AS DOUBLE) / 100 AS average_score
  FROM clean_registration r JOIN analytics_student_engagement a USING (id_student, code_module, code_presentation)
  JOIN dim_student USING (id_student) JOIN dim_module_presentation USING (code_module, code_presentation)
  JOIN dim_age_band USING (age_band) JOIN dim_outcome d ON d.final_result = r.final_result)"""


def _clean_layer(spark, d):
    """The clean tables a mart starts from, written out once as they would be stored."""
    return _stored(spark, d).written("stg_student_info", "clean_student", "clean_assessment", *CLEAN_FACTS)


@query("dim_student", sql("SELECT * FROM dim_student", ENGAGEMENT_MART))
def _(spark, d):
    return marts.dim_student(layers(spark, d)["clean_student"])


@query("dim_module_presentation", sql("SELECT * FROM dim_module_presentation", ENGAGEMENT_MART))
def _(spark, d):
    return marts.dim_module_presentation(layers(spark, d)["clean_module_presentation"])


@query("dim_age_band", sql("SELECT * FROM dim_age_band", ENGAGEMENT_MART))
def _(spark, d):
    return marts.dim_age_band(layers(spark, d)["clean_registration"])


@query("dim_outcome", sql("SELECT * FROM dim_outcome", ENGAGEMENT_MART))
def _(spark, d):
    return marts.dim_outcome(layers(spark, d)["clean_registration"])


def _engagement_fact(spark, d):
    t = _clean_layer(spark, d)
    dims = marts.engagement_dimensions(t)
    mart = analytics.student_engagement(t)
    return marts.fact_learning_engagement(t["clean_registration"], mart, dims), dims


@query("fact_learning_engagement", sql("SELECT * FROM fact_learning_engagement", ENGAGEMENT_MART))
def _(spark, d):
    return doubles(_engagement_fact(spark, d)[0], "average_score")


@query(
    "labelled_engagement",
    sql(
        """SELECT engagement_fact_key, id_student, code_module, code_presentation, age_band, final_result, studied_credits,
        total_clicks, active_days, resources_used, assessment_submissions, average_score
        FROM fact_learning_engagement JOIN dim_student USING (student_key)
        JOIN dim_module_presentation USING (module_presentation_key) JOIN dim_age_band USING (age_band_key)
        JOIN dim_outcome USING (outcome_key)""",
        ENGAGEMENT_MART,
    ),
)
def _(spark, d):
    fact, dims = _engagement_fact(spark, d)
    return doubles(marts.labelled_engagement(fact, dims), "average_score")


# Mart rows that break rules, made of good ones; the tables keep their names behind ``f_``.
MART_FLAWS = """f_dim_student AS (FROM dim_student UNION ALL SELECT student_key + 1, * EXCLUDE student_key FROM dim_student WHERE student_key % 5 = 0),
f_dim_module_presentation AS (FROM dim_module_presentation UNION ALL
  SELECT module_presentation_key, code_module, 'x', presentation_year, 'X', 0 FROM dim_module_presentation WHERE code_module = 'AAA'),
f_dim_age_band AS (FROM dim_age_band UNION ALL SELECT age_band_key + 10, '20-30', 9 FROM dim_age_band),
f_dim_outcome AS (FROM dim_outcome UNION ALL SELECT outcome_key + 10, 'Left', outcome_category, 5, outcome_order FROM dim_outcome),
f_fact_learning_engagement AS (FROM fact_learning_engagement UNION ALL
  SELECT engagement_fact_key, -student_key, module_presentation_key, NULL, outcome_key + 20, 0, -1, total_clicks, active_days, resources_used,
    assessment_submissions, average_score FROM fact_learning_engagement WHERE engagement_fact_key % 3 = 0
  UNION ALL FROM fact_learning_engagement WHERE engagement_fact_key % 7 = 0)"""
_MART_RULES = re.sub(r"\b(FROM|JOIN) (dim_|fact_)", r"\1 f_\2", _rules_sql(marts.ENGAGEMENT_MART_RULES))


@query("engagement_mart_rules", sql(_MART_RULES, ENGAGEMENT_MART, MART_FLAWS))
def _(spark, d):
    """Mart rules over good rows and many that break one."""
    fact, dims = _engagement_fact(spark, d)
    key = F.col("engagement_fact_key")
    fact = materialise(fact, "fact")
    wrong = {
        "student_key": -F.col("student_key"), "age_band_key": F.lit(None).cast("bigint"), "outcome_key": F.col("outcome_key") + 20,
        "studied_credits": F.lit(0).cast("bigint"), "previous_attempts": F.lit(-1).cast("bigint"),
    }
    more = {
        "dim_student": ("student_key % 5 = 0", {"student_key": F.col("student_key") + 1}),
        "dim_module_presentation": ("code_module = 'AAA'", {
            "code_presentation": F.lit("x"), "presentation_term": F.lit("X"), "module_presentation_length": F.lit(0).cast("bigint")}),
        "dim_age_band": ("true", {"age_band_key": F.col("age_band_key") + 10, "age_band": F.lit("20-30"), "age_band_order": F.lit(9)}),
        "dim_outcome": ("true", {"outcome_key": F.col("outcome_key") + 10, "final_result": F.lit("Left"), "successful_completion": F.lit(5)}),
    }
    tables = {name: dims[name].unionByName(dims[name].where(where).withColumns(changes)) for name, (where, changes) in more.items()}
    tables["fact_learning_engagement"] = fact.unionByName(fact.where(key % 3 == 0).withColumns(wrong)).unionByName(fact.where(key % 7 == 0))
    return rule_report(tables, marts.ENGAGEMENT_MART_RULES)


@query(
    "mart_uniqueness",
    sql(
        """SELECT count(*) AS dimension_rows, count(DISTINCT module_presentation_key) AS unique_warehouse_keys,
        count(DISTINCT code_module || '-' || code_presentation) AS unique_module_presentations FROM dim_module_presentation""",
        ENGAGEMENT_MART,
    ),
)
def _(spark, d):
    dim = marts.dim_module_presentation(layers(spark, d)["clean_module_presentation"])
    return dim.agg(
        F.count(F.lit(1)).alias("dimension_rows"),
        F.countDistinct("module_presentation_key").alias("unique_warehouse_keys"),
        F.countDistinct(*PRESENTATION_KEY).alias("unique_module_presentations"),
    )


# ------------------------------------------------------------ click mart

CLICK_MART = f"""courses AS (
  SELECT DISTINCT code_module, code_presentation, {LENGTH} AS module_presentation_length FROM stg_courses),
dim_course AS (
  SELECT row_number() OVER (ORDER BY code_module, code_presentation) AS course_key, * FROM courses),
picked AS (
  SELECT DISTINCT ON (id_student) id_student, gender, region, highest_education, imd_band, age_band, disability FROM (
    SELECT CAST(trim(id_student) AS BIGINT) AS id_student, code_presentation, trim(gender) AS gender, trim(region) AS region,
      trim(highest_education) AS highest_education, coalesce({known('imd_band')}, 'Unknown') AS imd_band,
      trim(age_band) AS age_band, trim(disability) AS disability FROM stg_student_info)
  ORDER BY id_student, code_presentation, gender, region, highest_education, imd_band, age_band, disability),
dim_picked AS (SELECT row_number() OVER (ORDER BY id_student) AS student_key, * FROM picked),
dim_assessment AS (
  SELECT row_number() OVER (ORDER BY {number('id_assessment')}) AS assessment_key, {number('id_assessment')} AS id_assessment,
    course_key, trim(assessment_type) AS assessment_type, {number('date')} AS assessment_date_days,
    CAST(trim(weight) AS DECIMAL(5,2)) AS weight
  FROM stg_assessments JOIN dim_course USING (code_module, code_presentation)),
dim_vle_material AS (
  SELECT row_number() OVER (ORDER BY {number('id_site')}) AS vle_key, {number('id_site')} AS id_site, course_key,
    trim(activity_type) AS activity_type, {number('week_from')} AS week_from, {number('week_to')} AS week_to
  FROM stg_vle JOIN dim_course USING (code_module, code_presentation))"""


@query("dim_course", sql("SELECT * FROM dim_course", CLICK_MART))
def _(spark, d):
    return marts.dim_course(staging(spark, d)["stg_courses"])


@query("dim_student_picked", sql("SELECT * FROM dim_picked", CLICK_MART))
def _(spark, d):
    return marts.dim_student_picked(staging(spark, d)["stg_student_info"])


@query("dim_assessment", sql("SELECT * FROM dim_assessment", CLICK_MART))
def _(spark, d):
    stg = staging(spark, d)
    return marts.dim_assessment(stg["stg_assessments"], marts.dim_course(stg["stg_courses"]))


@query("dim_vle_material", sql("SELECT * FROM dim_vle_material", CLICK_MART))
def _(spark, d):
    stg = staging(spark, d)
    return marts.dim_vle_material(stg["stg_vle"], marts.dim_course(stg["stg_courses"]))


@query(
    "fact_student_enrollment",
    sql(
        f"""SELECT row_number() OVER (ORDER BY student_key, course_key) AS enrollment_key, student_key, course_key,
        {number('date_registration')} AS date_registration, {number('date_unregistration')} AS date_unregistration,
        {number('num_of_prev_attempts')} AS num_of_prev_attempts, {number('studied_credits')} AS studied_credits,
        trim(final_result) AS final_result
        FROM {INFO} si JOIN dim_picked p ON p.id_student = CAST(si.id_student AS BIGINT)
        JOIN dim_course c ON c.code_module = si.code_module AND c.code_presentation = si.code_presentation
        LEFT JOIN stg_student_registration sr ON sr.id_student = si.id_student AND sr.code_module = si.code_module
          AND sr.code_presentation = si.code_presentation""",
        CLICK_MART,
    ),
)
def _(spark, d):
    stg = staging(spark, d)
    return marts.fact_student_enrollment(stg, marts.click_dimensions(stg))


@query(
    "fact_student_assessment",
    sql(
        f"""SELECT row_number() OVER (ORDER BY student_key, assessment_key) AS submission_key, student_key, assessment_key,
        {number('date_submitted')} AS date_submitted, {number('is_banked')} = 1 AS is_banked,
        CAST({known('score')} AS DECIMAL(5,2)) AS score, {number('date_submitted')} - assessment_date_days
        AS submission_delay_days
        FROM stg_student_assessment sa JOIN dim_picked p ON p.id_student = CAST(sa.id_student AS BIGINT)
        JOIN dim_assessment a ON a.id_assessment = CAST(sa.id_assessment AS BIGINT)""",
        CLICK_MART,
    ),
)
def _(spark, d):
    stg = staging(spark, d)
    return marts.fact_student_assessment(stg, marts.click_dimensions(stg))


FACT_VLE = f"""fact_student_vle AS (
  SELECT student_key, c.course_key, vle_key, {number('date')} AS interaction_date, {number('sum_click')} AS sum_clicks
  FROM stg_student_vle sv JOIN dim_picked p ON p.id_student = CAST(sv.id_student AS BIGINT)
  JOIN dim_course c ON c.code_module = sv.code_module AND c.code_presentation = sv.code_presentation
  JOIN dim_vle_material v ON v.id_site = CAST(sv.id_site AS BIGINT))"""


@query("fact_student_vle", sql("SELECT * FROM fact_student_vle", CLICK_MART, FACT_VLE))
def _(spark, d):
    stg = staging(spark, d)
    return marts.fact_student_vle(stg, marts.click_dimensions(stg)).drop("vle_activity_key")


@query(
    "fact_student_vle_keys",
    sql("SELECT count(*) AS rows, count(*) AS unique_keys FROM fact_student_vle", CLICK_MART, FACT_VLE),
)
def _(spark, d):
    stg = staging(spark, d)
    fact = marts.fact_student_vle(stg, marts.click_dimensions(stg))
    return fact.agg(F.count(F.lit(1)).alias("rows"), F.countDistinct("vle_activity_key").alias("unique_keys"))
