"""Reporting tables over the clean layer, and the click-log aggregates."""

from __future__ import annotations

from collections.abc import Callable, Mapping

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tallyframe.operators import aggregates as agg
from tallyframe.operators import bitmaps
from tallyframe.operators.quality import Check, NotNull, Rule, Unique
from tallyframe.schemas import PRESENTATION_KEY, REGISTRATION_KEY, SUCCESS_RESULTS

# Result columns of the completion table by outcome label.
OUTCOME_COLUMNS = {"distinctions": "Distinction", "passes": "Pass", "failures": "Fail", "withdrawals": "Withdrawn"}


def student_engagement(clean: Mapping[str, DataFrame], totals: DataFrame | None = None) -> DataFrame:
    """Engagement of each registration; ``totals`` is the stored summary of the clicks, if there is one."""
    return agg.engagement_mart(
        clean["clean_registration"],
        clean["clean_student_vle_interaction"],
        clean["clean_student_assessment"],
        REGISTRATION_KEY,
        ["final_result"],
        "sum_click",
        "interaction_date",
        "id_site",
        "score",
        totals,
    )


def completion_by_presentation(clean: Mapping[str, DataFrame]) -> DataFrame:
    return agg.completion(
        clean["clean_registration"], PRESENTATION_KEY, "final_result", OUTCOME_COLUMNS, SUCCESS_RESULTS
    )


def assessment_performance(clean: Mapping[str, DataFrame], how: str = "left") -> DataFrame:
    return agg.performance(
        clean["clean_assessment"],
        clean["clean_student_assessment"],
        "id_assessment",
        [*PRESENTATION_KEY, "assessment_type"],
        "score",
        "is_banked",
        how,
    )


def engagement_by_result(student_engagement: DataFrame, with_score: bool = True) -> DataFrame:
    return agg.engagement_by_result(student_engagement, "final_result", with_score)


def resource_availability(clean: Mapping[str, DataFrame]) -> DataFrame:
    return agg.availability(
        clean["clean_vle_resource"], [*PRESENTATION_KEY, "activity_type"], "week_from", "week_to"
    )


def analytics_plans(tables: Mapping[str, DataFrame], totals: DataFrame | None = None) -> dict[str, Callable[[], DataFrame]]:
    """The reporting tables in order, each built when called from what ``tables`` holds then."""
    return {
        "analytics_student_engagement": lambda: student_engagement(tables, totals),
        "analytics_completion_by_presentation": lambda: completion_by_presentation(tables).drop("successful_students"),
        "analytics_assessment_performance": lambda: assessment_performance(tables),
        "analytics_engagement_by_result": lambda: engagement_by_result(tables["analytics_student_engagement"]),
    }


def build_analytics(clean: Mapping[str, DataFrame]) -> dict[str, DataFrame]:
    tables = dict(clean)
    return {name: tables.setdefault(name, plan()) for name, plan in analytics_plans(tables).items()}


SUMMARY_KEY = [*PRESENTATION_KEY, "id_student"]


def engagement_bitmaps(interactions: DataFrame) -> DataFrame:
    """Days and resources of each student and presentation as bitmaps, for clicks stored clustered by student; to be stored."""
    return bitmaps.engagement_bitmaps(interactions, SUMMARY_KEY, "sum_click", "interaction_date", "id_site")


def presentation_engagement(stored: DataFrame) -> DataFrame:
    """Clicks, active days and used resources of each presentation, merged from its students' bitmaps."""
    return bitmaps.coarser_engagement(stored, PRESENTATION_KEY)


def click_log_aggregates(interactions: DataFrame, stored: DataFrame | None = None) -> dict[str, DataFrame]:
    """Three aggregates of consolidated clicks: by student, resource and week.

    With ``stored`` engagement bitmaps, the first is read off them.
    """
    args = {"measure": "sum_click"}
    return {
        "student_engagement_summary": bitmaps.engagement_counts(stored, SUMMARY_KEY) if stored is not None else agg.engagement(
            interactions, SUMMARY_KEY, day="interaction_date", resource="id_site", **args
        ),
        "resource_popularity": agg.popularity(interactions, [*PRESENTATION_KEY, "id_site"], actor="id_student", **args),
        "weekly_engagement_trend": agg.weekly_trend(
            interactions, PRESENTATION_KEY, day="interaction_date", actor="id_student", **args
        ),
    }


def presentation_trend(trend: DataFrame, module: str, presentation: str) -> DataFrame:
    """All weeks of one presentation, in week order."""
    chosen = (F.col("code_module") == module) & (F.col("code_presentation") == presentation)
    return trend.where(chosen).orderBy("presentation_week")


ANALYTICS_RULES: dict[str, tuple[Rule, ...]] = {
    "analytics_student_engagement": (
        NotNull((*REGISTRATION_KEY, "final_result", "total_clicks", "active_days", "resources_used", "assessment_submissions")),
        Unique(REGISTRATION_KEY),
        Check("clicks not negative", "total_clicks >= 0"),
        Check("days not negative", "active_days >= 0"),
        Check("resources not negative", "resources_used >= 0"),
        Check("submissions not negative", "assessment_submissions >= 0"),
        Check("mean score within 0 to 100", "average_score BETWEEN 0 AND 100"),
    ),
    "analytics_completion_by_presentation": (
        NotNull((*PRESENTATION_KEY, "registered_students", "successful_completion_rate_pct")),
        Unique(PRESENTATION_KEY),
        Check("rate within 0 to 100", "successful_completion_rate_pct BETWEEN 0 AND 100"),
    ),
    "analytics_assessment_performance": (
        NotNull((*PRESENTATION_KEY, "assessment_type", "submissions", "missing_scores")),
        Unique((*PRESENTATION_KEY, "assessment_type")),
        Check("mean score within 0 to 100", "average_score BETWEEN 0 AND 100"),
        Check("banked rate within 0 to 100", "banked_result_rate_pct BETWEEN 0 AND 100"),
    ),
    "analytics_engagement_by_result": (
        NotNull(("final_result", "registrations", "average_total_clicks", "average_active_days",
                 "average_resources_used", "average_assessment_submissions")),
        Unique(("final_result",)),
    ),
}
