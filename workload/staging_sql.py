"""SQL for the derived staging tables and for the clean layer over them."""

STAGING = """
enrolments AS (
  SELECT o_orderkey, o_custkey AS id_student, o_orderstatus, o_totalprice,
    repeat(translate(substr(o_orderpriority, 1, 1), '12345', 'ABCDE'), 3) AS code_module,
    CAST(year(o_orderdate) AS VARCHAR) || CASE WHEN month(o_orderdate) <= 6 THEN 'B' ELSE 'J' END AS code_presentation,
    CAST((year(o_orderdate) - 1990) * 20 + CASE WHEN month(o_orderdate) <= 6 THEN 0 ELSE 10 END
      + CAST(substr(o_orderpriority, 1, 1) AS INT) AS BIGINT) AS context,
    year(o_orderdate) AS year,
    date_diff('day', make_date(year(o_orderdate), CASE WHEN month(o_orderdate) <= 6 THEN 2 ELSE 9 END, 1),
      CAST(o_orderdate AS DATE)) AS day
  FROM orders),
lines AS (
  SELECT e.*, l_linenumber, l_returnflag, CAST(l_quantity AS BIGINT) AS quantity, l_tax, l_discount
  FROM lineitem JOIN enrolments e ON l_orderkey = o_orderkey),
enrolled AS (
  SELECT id_student, code_module, code_presentation, year, count(*) AS n, max(o_orderstatus) AS status,
    max(o_totalprice) AS price, min(day) AS first_day, max(day) AS last_day
  FROM enrolments GROUP BY ALL),
students AS (
  SELECT *, CAST(floor((c_acctbal + 1000) / 1100) AS BIGINT) AS decile
  FROM customer JOIN nation ON c_nationkey = n_nationkey),
stg_courses AS (
  SELECT DISTINCT code_module, code_presentation,
    CASE WHEN right(code_presentation, 1) = 'B' THEN '241' ELSE '269' END AS module_presentation_length
  FROM enrolments),
stg_assessments AS (
  SELECT DISTINCT code_module, code_presentation,
    CAST(context * 10 + CASE l_returnflag WHEN 'A' THEN 1 WHEN 'N' THEN 2 WHEN 'R' THEN 3 END AS VARCHAR) AS id_assessment,
    CASE l_returnflag WHEN 'A' THEN 'TMA' WHEN 'N' THEN 'CMA' WHEN 'R' THEN 'Exam' END AS assessment_type,
    CASE l_returnflag WHEN 'A' THEN '100' WHEN 'N' THEN ' 200 ' WHEN 'R' THEN '?' END AS date,
    CASE l_returnflag WHEN 'A' THEN '20.5' WHEN 'N' THEN '0' WHEN 'R' THEN '100' END AS weight
  FROM lines),
stg_vle AS (
  SELECT DISTINCT CAST(context * 10 + l_linenumber AS VARCHAR) AS id_site, code_module, code_presentation,
    CASE l_linenumber WHEN 1 THEN 'page' WHEN 2 THEN 'page' WHEN 3 THEN 'quiz' WHEN 4 THEN 'forum'
      WHEN 5 THEN 'video' WHEN 6 THEN 'file' WHEN 7 THEN 'home' END AS activity_type,
    CASE WHEN l_linenumber <= 4 THEN '?' ELSE CAST(l_linenumber - 4 AS VARCHAR) END AS week_from,
    CASE WHEN l_linenumber <= 4 THEN '?' ELSE CAST(l_linenumber * 2 AS VARCHAR) END AS week_to
  FROM lines),
stg_student_info AS (
  SELECT ' ' || code_module || ' ' AS code_module, code_presentation, ' ' || CAST(id_student AS VARCHAR) AS id_student,
    CASE WHEN c_acctbal < 4500 THEN 'F' ELSE 'M' END AS gender, n_name || ' ' AS region,
    c_mktsegment AS highest_education,
    CASE decile WHEN 0 THEN '?' WHEN 1 THEN '10-20' WHEN 9 THEN ''
      ELSE CAST(decile * 10 AS VARCHAR) || '-' || CAST(decile * 10 + 10 AS VARCHAR) || '%' END AS imd_band,
    CASE WHEN year < 1997 THEN '0-35' WHEN year < 2000 THEN '35-55' ELSE '55<=' END AS age_band,
    CAST(n - 1 AS VARCHAR) AS num_of_prev_attempts, CAST(n * 30 AS VARCHAR) AS studied_credits,
    CASE WHEN n_regionkey = 0 THEN 'Y' ELSE 'N' END AS disability,
    CASE WHEN status = 'F' THEN 'Fail' WHEN status = 'P' THEN 'Withdrawn' WHEN price > 250000 THEN 'Distinction'
      ELSE 'Pass' END AS final_result
  FROM enrolled JOIN students ON id_student = c_custkey),
stg_student_registration AS (
  SELECT code_module, code_presentation, CAST(id_student AS VARCHAR) AS id_student,
    CASE WHEN price > 480000 THEN '?' ELSE CAST(first_day - 20 AS VARCHAR) END AS date_registration,
    CASE WHEN status = 'P' THEN CAST(last_day + 130 AS VARCHAR) ELSE '?' END AS date_unregistration
  FROM enrolled),
stg_student_assessment AS (
  SELECT CAST(context * 10 + CASE l_returnflag WHEN 'A' THEN 1 WHEN 'N' THEN 2 WHEN 'R' THEN 3 END AS VARCHAR) AS id_assessment,
    CAST(id_student AS VARCHAR) AS id_student, CAST(max(day) + max(quantity) * 3 AS VARCHAR) AS date_submitted,
    CASE WHEN max(l_tax) > 0.075 THEN '1' ELSE '0' END AS is_banked,
    CASE WHEN max(l_discount) < 0.02 THEN '?' ELSE CAST(max(quantity) * 2 AS VARCHAR) END AS score
  FROM lines GROUP BY lines.id_student, context, l_returnflag),
stg_student_vle AS (
  SELECT code_module, code_presentation, CAST(id_student AS VARCHAR) AS id_student,
    CAST(context * 10 + l_linenumber AS VARCHAR) AS id_site, CAST(day + l_linenumber AS VARCHAR) AS date,
    CAST(quantity AS VARCHAR) AS sum_click
  FROM lines)"""


def _known(c: str) -> str:
    return f"nullif(nullif(trim({c}), '?'), '')"


def _int(c: str, alias: str | None = None) -> str:
    return f"TRY_CAST({_known(c)} AS BIGINT) AS {alias or c.split('.')[-1]}"


CLEAN = f"""
clean_module_presentation AS (
  SELECT trim(code_module) AS code_module, trim(code_presentation) AS code_presentation,
    {_int('module_presentation_length')}
  FROM stg_courses),
clean_student AS (
  SELECT TRY_CAST(trim(id_student) AS BIGINT) AS id_student, max(trim(gender)) AS gender, max(trim(region)) AS region,
    max(trim(highest_education)) AS highest_education,
    max(CASE WHEN trim(imd_band) = '10-20' THEN '10-20%' ELSE {_known('imd_band')} END) AS imd_band,
    max(trim(disability)) AS disability
  FROM stg_student_info GROUP BY TRY_CAST(trim(stg_student_info.id_student) AS BIGINT)),
clean_registration AS (
  SELECT CAST(trim(si.id_student) AS BIGINT) AS id_student, trim(si.code_module) AS code_module,
    trim(si.code_presentation) AS code_presentation, trim(si.age_band) AS age_band,
    {_int('sr.date_registration')}, {_int('sr.date_unregistration')},
    {_int('si.num_of_prev_attempts')}, {_int('si.studied_credits')}, trim(si.final_result) AS final_result
  FROM stg_student_info si JOIN stg_student_registration sr
    ON trim(sr.code_module) = trim(si.code_module) AND trim(sr.code_presentation) = trim(si.code_presentation)
   AND CAST(trim(sr.id_student) AS BIGINT) = CAST(trim(si.id_student) AS BIGINT)),
clean_assessment AS (
  SELECT {_int('id_assessment')}, trim(code_module) AS code_module, trim(code_presentation) AS code_presentation,
    trim(assessment_type) AS assessment_type, {_int('date', 'assessment_date')},
    TRY_CAST(trim(weight) AS DECIMAL(5,2)) AS weight
  FROM stg_assessments),
clean_vle_resource AS (
  SELECT {_int('id_site')}, trim(code_module) AS code_module, trim(code_presentation) AS code_presentation,
    trim(activity_type) AS activity_type, {_int('week_from')}, {_int('week_to')}
  FROM stg_vle),
clean_student_assessment AS (
  SELECT a.id_assessment, {_int('sa.id_student')}, a.code_module, a.code_presentation, {_int('sa.date_submitted')},
    {_int('sa.is_banked')}, {_int('sa.score')}
  FROM stg_student_assessment sa JOIN clean_assessment a ON a.id_assessment = CAST(trim(sa.id_assessment) AS BIGINT)),
clean_student_vle_interaction AS (
  SELECT trim(code_module) AS code_module, trim(code_presentation) AS code_presentation,
    TRY_CAST(trim(id_student) AS BIGINT) AS id_student, TRY_CAST(trim(id_site) AS BIGINT) AS id_site,
    TRY_CAST(trim(date) AS BIGINT) AS interaction_date, CAST(sum(CAST(trim(sum_click) AS BIGINT)) AS BIGINT) AS sum_click
  FROM stg_student_vle
  GROUP BY stg_student_vle.code_module, stg_student_vle.code_presentation, stg_student_vle.id_student,
    stg_student_vle.id_site, stg_student_vle.date)"""


def rounded_ratio(a: str, b: str) -> str:
    """``a / b`` for whole numbers with ``a >= 0``, rounded to two places, halves up."""
    return f"CAST((200 * CAST({a} AS HUGEINT) + {b}) // (2 * nullif({b}, 0)) AS DOUBLE) / 100"


def rounded_mean(c: str) -> str:
    return rounded_ratio(f"sum({c})", f"count({c})")


def rounded_pct(part: str, whole: str) -> str:
    return rounded_ratio(f"(100 * {part})", whole)


ANALYTICS = f"""
click_totals AS (
  SELECT id_student, code_module, code_presentation, CAST(sum(sum_click) AS BIGINT) AS total_clicks,
    count(DISTINCT interaction_date) AS active_days, count(DISTINCT id_site) AS resources_used
  FROM clean_student_vle_interaction GROUP BY ALL),
mark_totals AS (
  SELECT id_student, code_module, code_presentation, count(*) AS assessment_submissions,
    (200 * CAST(sum(score) AS HUGEINT) + count(score)) // (2 * nullif(count(score), 0)) AS score_cents
  FROM clean_student_assessment GROUP BY ALL),
analytics_student_engagement AS (
  SELECT r.id_student, r.code_module, r.code_presentation, r.final_result,
    coalesce(total_clicks, 0) AS total_clicks, coalesce(active_days, 0) AS active_days,
    coalesce(resources_used, 0) AS resources_used, coalesce(assessment_submissions, 0) AS assessment_submissions,
    CAST(score_cents AS BIGINT) AS score_cents
  FROM clean_registration r
  LEFT JOIN click_totals v USING (id_student, code_module, code_presentation)
  LEFT JOIN mark_totals a USING (id_student, code_module, code_presentation)),
analytics_completion_by_presentation AS (
  SELECT code_module, code_presentation, count(*) AS registered_students,
    count(*) FILTER (final_result = 'Distinction') AS distinctions, count(*) FILTER (final_result = 'Pass') AS passes,
    count(*) FILTER (final_result = 'Fail') AS failures, count(*) FILTER (final_result = 'Withdrawn') AS withdrawals,
    count(*) FILTER (final_result IN ('Pass', 'Distinction')) AS successful_students,
    {rounded_pct("count(*) FILTER (final_result IN ('Pass', 'Distinction'))", "count(*)")} AS successful_completion_rate_pct
  FROM clean_registration GROUP BY ALL),
analytics_assessment_performance AS (
  SELECT a.code_module, a.code_presentation, a.assessment_type, count(sa.id_student) AS submissions,
    count(*) FILTER (sa.id_student IS NOT NULL AND sa.score IS NULL) AS missing_scores,
    {rounded_mean("sa.score")} AS average_score, {rounded_pct("sum(sa.is_banked)", "count(sa.is_banked)")} AS banked_result_rate_pct
  FROM clean_assessment a LEFT JOIN clean_student_assessment sa ON sa.id_assessment = a.id_assessment
  GROUP BY a.code_module, a.code_presentation, a.assessment_type),
analytics_engagement_by_result AS (
  SELECT final_result, count(*) AS registrations,
    {rounded_mean("total_clicks")} AS average_total_clicks, {rounded_mean("active_days")} AS average_active_days,
    {rounded_mean("resources_used")} AS average_resources_used,
    {rounded_mean("assessment_submissions")} AS average_assessment_submissions,
    CAST((2 * sum(score_cents) + count(score_cents)) // (2 * nullif(count(score_cents), 0)) AS DOUBLE) / 100 AS average_score
  FROM analytics_student_engagement GROUP BY ALL)"""

LAYERS = "WITH" + STAGING + "," + CLEAN + "," + ANALYTICS

# The staging tables with rows that break their rules.
FLAWS = """
f_stg_courses AS (
  SELECT * FROM stg_courses
  UNION ALL SELECT * FROM stg_courses WHERE code_module = 'AAA'
  UNION ALL SELECT lower(code_module), code_presentation || 'X', 'none' FROM stg_courses WHERE code_module = 'BBB'
  UNION ALL SELECT 'YYY', code_presentation, '0' FROM stg_courses WHERE code_module = 'CCC'),
f_stg_assessments AS (
  SELECT * FROM stg_assessments
  UNION ALL SELECT * FROM stg_assessments WHERE code_module = 'AAA' AND assessment_type = 'Exam'
  UNION ALL SELECT code_module, code_presentation, id_assessment || '7', 'Essay', '900', '150' FROM stg_assessments
    WHERE code_module = 'BBB' AND assessment_type = 'CMA'
  UNION ALL SELECT 'ZZZ', code_presentation, id_assessment || '8', assessment_type, date, NULL FROM stg_assessments
    WHERE code_module = 'CCC' AND assessment_type = 'TMA'),
f_stg_vle AS (
  SELECT * FROM stg_vle
  UNION ALL SELECT * FROM stg_vle WHERE code_module = 'AAA' AND activity_type = 'quiz'
  UNION ALL SELECT id_site || '7', 'ZZZ', code_presentation, NULL, '9', '2' FROM stg_vle
    WHERE code_module = 'BBB' AND activity_type = 'home'),
f_stg_student_info AS (
  SELECT * FROM stg_student_info
  UNION ALL SELECT * FROM stg_student_info WHERE final_result = 'Distinction'
  UNION ALL SELECT 'ZZZ', code_presentation, id_student, 'X', region, highest_education, '5-15%', '20-30', '-1', '0', 'Q', 'Left'
    FROM stg_student_info WHERE final_result = 'Withdrawn'
  UNION ALL SELECT code_module, code_presentation, '-' || trim(id_student), NULL, NULL, highest_education, imd_band, age_band,
    num_of_prev_attempts, studied_credits, disability, final_result FROM stg_student_info WHERE age_band = '55<='),
f_stg_student_registration AS (
  SELECT * FROM stg_student_registration
  UNION ALL SELECT * FROM stg_student_registration WHERE date_unregistration <> '?' AND code_module = 'AAA'
  UNION ALL SELECT 'ZZZ', code_presentation, id_student, '10', '5' FROM stg_student_registration WHERE date_unregistration <> '?'),
f_stg_student_assessment AS (
  SELECT * FROM stg_student_assessment
  UNION ALL SELECT * FROM stg_student_assessment WHERE is_banked = '1'
  UNION ALL SELECT id_assessment, '-' || id_student, date_submitted, '5', '101' FROM stg_student_assessment WHERE score = '100'
  UNION ALL SELECT id_assessment || '99', id_student, date_submitted, is_banked, score FROM stg_student_assessment WHERE score = '98'
  UNION ALL SELECT id_assessment, id_student || '0', NULL, is_banked, score FROM stg_student_assessment WHERE score = '96'),
f_stg_student_vle AS (
  SELECT * FROM stg_student_vle
  UNION ALL SELECT code_module, code_presentation, '-' || id_student, id_site || '9', date, '0' FROM stg_student_vle
    WHERE sum_click = '50'
  UNION ALL SELECT code_module, code_presentation, id_student, id_site, NULL, sum_click FROM stg_student_vle
    WHERE sum_click = '49')"""


def flawed_sql(body: str) -> str:
    """``body`` over the flawed staging tables and the clean tables made from them."""
    return "WITH" + STAGING + "," + FLAWS + "," + (CLEAN + "\n" + body).replace("stg_", "f_stg_")
