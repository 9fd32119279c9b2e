"""The 38-line quality report and the gates between layers."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tallyframe.functions import is_missing, is_present, null_markers, to_int
from tallyframe.operators.aggregates import count_difference, duplicate_keys, row_count
from tallyframe.operators.quality import (
    ForeignKey,
    QualityError,
    ReportLine,
    exact_check,
    gate,
    info_check,
    quality_report,
    rule_report,
)
from tallyframe.schemas import FULL_DATA_ROWS, PRESENTATION_KEY, REGISTRATION_KEY, SITE_KEY, SOURCE_BY_TABLE
from tallyframe.session import materialise
from tallyframe.sources import MALFORMED, literal_rows

# The layers, tables and check names of the report, here and in the lines below.
STAGING_ROWS = "source row-count reconciliation"
CLEAN_ROWS = "cleaned row-count reconciliation"
ANALYTICS_ROWS = "analytics row-count reconciliation"
CONSOLIDATED_ROWS = "repeated daily-grain rows consolidated"
PRESENTATION_TOTAL = "registrations represented in presentation summaries"
OUTCOME_TOTAL = "registrations represented in outcome summaries"

STAGING_TABLES = tuple(t for t in FULL_DATA_ROWS if t.startswith("stg_"))
CLEAN_TABLES = tuple(t for t in FULL_DATA_ROWS if t.startswith("clean_"))
ANALYTICS_TABLES = tuple(t for t in FULL_DATA_ROWS if t.startswith("analytics_"))


def expected_rows(spark: SparkSession, rows: Mapping[str, int] = FULL_DATA_ROWS) -> DataFrame:
    """Expectations of the report lines that depend on the data set's size."""
    check = {**dict.fromkeys(STAGING_TABLES, STAGING_ROWS), **dict.fromkeys(CLEAN_TABLES, CLEAN_ROWS),
             **dict.fromkeys(ANALYTICS_TABLES, ANALYTICS_ROWS)}
    lines = [(table, check[table], n) for table, n in rows.items()]
    clicks = "clean_student_vle_interaction"
    if {clicks, "stg_student_vle"} <= rows.keys():
        lines.append((clicks, CONSOLIDATED_ROWS, rows["stg_student_vle"] - rows[clicks]))
    if "clean_registration" in rows:
        lines.append(("analytics_completion_by_presentation", PRESENTATION_TOTAL, rows["clean_registration"]))
        lines.append(("analytics_engagement_by_result", OUTCOME_TOTAL, rows["clean_registration"]))
    return literal_rows(spark, lines, "table_name string, check_name string, expected_value bigint")


def _any_missing(columns):
    test = F.lit(False)
    for c in columns:
        test = test | is_missing(c)
    return F.count_if(test)


def staging_lines(t: Mapping[str, DataFrame]) -> list[ReportLine]:
    def count(table):
        return exact_check(
            "staging", table, STAGING_ROWS, "The staging table has as many rows as its raw file.",
            expected=None, value=F.count(F.lit(1)),
        )

    def missing(table, check, column, text):
        return info_check("staging", table, check, text, value=F.count_if(is_missing(column)))

    start, end = is_missing("week_from"), is_missing("week_to")
    reversed_weeks = is_present("week_from") & is_present("week_to") & (to_int("week_to") < to_int("week_from"))
    repeated = row_count(duplicate_keys(t["stg_assessments"], ["id_assessment"]))
    return [
        *[count(table) for table in STAGING_TABLES],
        exact_check(
            "staging", "stg_courses", "missing required course values",
            "Course records have both keys and a length.",
            value=_any_missing(SOURCE_BY_TABLE["stg_courses"].columns),
        ),
        exact_check(
            "staging", "stg_assessments", "duplicate assessment identifiers",
            "No assessment identifier occurs twice.", frame=repeated,
        ),
        missing("stg_assessments", "missing assessment dates", "date", "Undated exams become null dates."),
        info_check(
            "staging", "stg_vle", "resources with both week fields missing",
            "Resources without weeks keep a null pair.", value=F.count_if(start & end),
        ),
        exact_check(
            "staging", "stg_vle", "incomplete or reversed resource-week pairs",
            "Week pairs are complete and in order.", value=F.count_if((start != end) | F.coalesce(reversed_weeks, F.lit(False))),
        ),
        missing("stg_student_info", "missing IMD-band values", "imd_band", "Unknown bands become null."),
        info_check(
            "staging", "stg_student_info", "nonstandard 10-20 IMD labels",
            "The label becomes 10-20%.", value=F.count_if(F.trim("imd_band") == "10-20"),
        ),
        missing("stg_student_registration", "missing registration dates", "date_registration", "Kept as null."),
        missing(
            "stg_student_registration", "missing unregistration dates", "date_unregistration",
            "As a rule, the student did not withdraw.",
        ),
        missing("stg_student_assessment", "missing assessment scores", "score", "Kept as null, not as zero."),
        exact_check(
            "staging", "stg_student_vle", "missing required interaction values",
            "Click rows have all keys and a click count.",
            value=_any_missing(SOURCE_BY_TABLE["stg_student_vle"].columns),
        ),
    ]


CLICKS = "clean_student_vle_interaction"
# The checks that must hold before a layer is used. The conditions count click rows; a row
# without a whole key has no parent.
CLICK_COUNTS = {
    "nonpositive click totals": "sum_click <= 0",
    "interactions without registration": "NOT coalesce(in_clean_registration, false)",
    "interactions without contextual resource": "NOT coalesce(in_clean_vle_resource, false)",
}
CLICK_PARENTS = {
    CLICKS: (ForeignKey(REGISTRATION_KEY, "clean_registration"), ForeignKey(SITE_KEY, "clean_vle_resource")),
}


def click_counts(tables: Mapping[str, DataFrame]) -> DataFrame:
    """What the gate and the report say about clicks, counted in one scan; stored."""
    report = rule_report(tables, CLICK_PARENTS, also={CLICKS: CLICK_COUNTS})
    return materialise(report, "click-counts")


def clean_lines(t: Mapping[str, DataFrame], counted: DataFrame | None = None) -> list[ReportLine]:
    """``counted`` is a stored rule report that has the ``CLICK_COUNTS``; without it they are counted now."""
    counted = click_counts(t) if counted is None else counted

    def count(table):
        return exact_check(
            "clean", table, CLEAN_ROWS, "The clean table has the expected grain.",
            expected=None, value=F.count(F.lit(1)),
        )

    def none(table, check, text, condition):
        return exact_check("clean", table, check, text, value=F.count_if(F.expr(condition)))

    def of_clicks(check, text):
        frame = counted.where((F.col("table_name") == CLICKS) & (F.col("rule") == check)).select("violations")
        return exact_check("clean", CLICKS, check, text, frame=frame)

    return [
        *[count(table) for table in CLEAN_TABLES],
        none("clean_student", "unstandardised IMD labels remaining", "All labels carry the percent sign.",
             "imd_band = '10-20'"),
        none("clean_registration", "unregistration before registration", "Students register before they leave.",
             "date_unregistration < date_registration"),
        none("clean_student_assessment", "scores outside 0 to 100", "Scores are percentages.",
             "score NOT BETWEEN 0 AND 100"),
        exact_check(
            "clean", "clean_student_vle_interaction", CONSOLIDATED_ROWS,
            "Rows merged into another row of the same student, resource and day.", expected=None,
            frame=count_difference(t["stg_student_vle"], t[CLICKS]),
        ),
        of_clicks("nonpositive click totals", "Every row stands for clicks."),
        of_clicks("interactions without registration", "Clicks belong to registered students."),
        of_clicks("interactions without contextual resource", "Clicks belong to a resource of the presentation."),
    ]


def analytics_lines() -> list[ReportLine]:
    def count(table):
        return exact_check(
            "analytics", table, ANALYTICS_ROWS, "The reporting table has the expected grain.",
            expected=None, value=F.count(F.lit(1)),
        )

    return [
        *[count(table) for table in ANALYTICS_TABLES],
        exact_check(
            "analytics", "analytics_completion_by_presentation", PRESENTATION_TOTAL,
            "Presentations add up to all registrations.", expected=None, value=F.sum("registered_students"),
        ),
        exact_check(
            "analytics", "analytics_engagement_by_result", OUTCOME_TOTAL,
            "Outcomes add up to all registrations.", expected=None, value=F.sum("registrations"),
        ),
    ]


def full_report(
    tables: Mapping[str, DataFrame], expectations: DataFrame | None = None, counted: DataFrame | None = None
) -> DataFrame:
    """All report lines over staging, clean and analytics tables."""
    lines = [*staging_lines(tables), *clean_lines(tables, counted), *analytics_lines()]
    return quality_report(tables, lines, expectations)


def clean_gate_report(tables: Mapping[str, DataFrame], counted: DataFrame | None = None) -> DataFrame:
    lines = [line for line in clean_lines(tables, counted) if line.check in CLICK_COUNTS]
    return quality_report(tables, lines)


def analytics_gate_report(tables: Mapping[str, DataFrame], expectations: DataFrame) -> DataFrame:
    """Row and registration totals against expectations, and value ranges."""
    totals = {
        ("analytics_student_engagement", ANALYTICS_ROWS),
        ("analytics_completion_by_presentation", PRESENTATION_TOTAL),
        ("analytics_engagement_by_result", OUTCOME_TOTAL),
    }
    lines = [line for line in analytics_lines() if (line.table, line.check) in totals]
    lines += [
        exact_check("analytics", "analytics_completion_by_presentation", "invalid completion rates",
                    "Rates are percentages.",
                    value=F.count_if(F.expr("successful_completion_rate_pct NOT BETWEEN 0 AND 100"))),
        exact_check("analytics", "analytics_assessment_performance", "invalid assessment scores",
                    "Mean scores are percentages.", value=F.count_if(F.expr("average_score NOT BETWEEN 0 AND 100"))),
    ]
    return quality_report(tables, lines, expectations)


# Numeric columns of the raw tables by type.
NUMBERS = {
    "stg_courses": {"module_presentation_length": "bigint"},
    "stg_assessments": {"id_assessment": "bigint", "date": "bigint", "weight": "decimal(5,2)"},
    "stg_vle": {"id_site": "bigint", "week_from": "bigint", "week_to": "bigint"},
    "stg_student_info": {"id_student": "bigint", "num_of_prev_attempts": "bigint", "studied_credits": "bigint"},
    "stg_student_registration": {"id_student": "bigint", "date_registration": "bigint", "date_unregistration": "bigint"},
    "stg_student_assessment": {
        "id_assessment": "bigint", "id_student": "bigint", "date_submitted": "bigint", "is_banked": "bigint", "score": "bigint",
    },
    "stg_student_vle": {"id_student": "bigint", "id_site": "bigint", "date": "bigint", "sum_click": "bigint"},
}


def intake_report(tables: Mapping[str, DataFrame], malformed: str = MALFORMED) -> DataFrame:
    """What must be zero before raw tables are typed, each table in one scan.

    Malformed rows (if the table has that column), missing presentation keys,
    and numbers that are there but cannot be read, which would look missing.
    """
    lines = []
    for table in STAGING_TABLES:
        columns = tables[table].columns
        if malformed in columns:
            lines.append(exact_check("staging", table, "malformed rows", "Rows have as many fields as the header.",
                                     value=F.count_if(F.col(malformed).isNotNull())))
        if keys := [c for c in PRESENTATION_KEY if c in columns]:
            lines.append(exact_check("staging", table, "missing presentation keys", "Rows name a module and a presentation.",
                                     value=_any_missing(keys)))
        for column, kind in NUMBERS[table].items():
            unread = is_present(column) & null_markers(column).try_cast(kind).isNull()
            lines.append(exact_check("staging", table, f"unparsable {column}", "Present values are numbers.",
                                     value=F.count_if(unread)))
    return quality_report(tables, lines)


def rules_gate(report: DataFrame) -> None:
    """Raise if a rule of a rule report is broken, naming the rules; lines of the clean gate are left to it."""
    broken = report.where("violations > 0").where(~F.col("rule").isin(*CLICK_COUNTS)).orderBy("table_name", "rule").collect()  # at most one row per rule
    if broken:
        raise QualityError("; ".join(f"{r.table_name}: {r.rule} is broken by {r.violations:,} rows" for r in broken))


def check_clean_layer(tables: Mapping[str, DataFrame], counted: DataFrame | None = None) -> None:
    gate(clean_gate_report(tables, counted))


def check_analytics_layer(tables: Mapping[str, DataFrame], expectations: DataFrame) -> None:
    gate(analytics_gate_report(tables, expectations))
