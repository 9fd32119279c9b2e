"""Typed tables from text staging tables, and the rules they must keep."""

from __future__ import annotations

from collections.abc import Callable, Mapping

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tallyframe.functions import standardise, to_decimal, to_int
from tallyframe.operators.aggregates import collapse_entity, consolidate
from tallyframe.operators.quality import Check, ForeignKey, NotNull, Rule, Unique, one_of
from tallyframe.schemas import (
    AGE_BAND_ORDER,
    ASSESSMENT_TYPES,
    DISABILITIES,
    GENDERS,
    IMD_BANDS,
    IMD_LABEL_FIXES,
    INTERACTION_KEY,
    PRESENTATION_KEY,
    REGISTRATION_KEY,
    RESULT_ORDER,
    SITE_KEY,
)


def _text(name: str) -> Column:
    return F.trim(F.col(name)).alias(name)


def _int(name: str, alias: str | None = None) -> Column:
    return to_int(name).alias(alias or name)


def clean_module_presentation(courses: DataFrame) -> DataFrame:
    return courses.select(_text("code_module"), _text("code_presentation"), _int("module_presentation_length"))


def clean_student(student_info: DataFrame) -> DataFrame:
    """One row per student; an attribute recorded several ways takes its greatest value."""
    attributes = ["gender", "region", "highest_education", "imd_band", "disability"]
    typed = student_info.select(
        _int("id_student"),
        *[
            standardise(a, IMD_LABEL_FIXES).alias(a) if a == "imd_band" else _text(a)
            for a in attributes
        ],
    )
    return collapse_entity(typed, ["id_student"], attributes)


def clean_registration(student_info: DataFrame, student_registration: DataFrame) -> DataFrame:
    """Enrolment facts joined to their dates on cleaned keys."""
    keys = [_int("id_student"), _text("code_module"), _text("code_presentation")]
    info = student_info.select(
        *keys, _text("age_band"), _int("num_of_prev_attempts"), _int("studied_credits"), _text("final_result")
    )
    dates = student_registration.select(*keys, _int("date_registration"), _int("date_unregistration"))
    return info.join(dates, list(REGISTRATION_KEY)).select(
        *REGISTRATION_KEY,
        "age_band",
        "date_registration",
        "date_unregistration",
        "num_of_prev_attempts",
        "studied_credits",
        "final_result",
    )


def clean_assessment(assessments: DataFrame) -> DataFrame:
    return assessments.select(
        _int("id_assessment"),
        _text("code_module"),
        _text("code_presentation"),
        _text("assessment_type"),
        _int("date", "assessment_date"),
        to_decimal("weight").alias("weight"),
    )


def clean_vle_resource(vle: DataFrame) -> DataFrame:
    return vle.select(
        _int("id_site"),
        _text("code_module"),
        _text("code_presentation"),
        _text("activity_type"),
        _int("week_from"),
        _int("week_to"),
    )


def clean_student_assessment(student_assessment: DataFrame, assessment: DataFrame) -> DataFrame:
    """Results with the module and presentation of their assessment."""
    results = student_assessment.select(
        _int("id_assessment"), _int("id_student"), _int("date_submitted"), _int("is_banked"), _int("score")
    )
    context = assessment.select("id_assessment", *PRESENTATION_KEY)
    return results.join(context, "id_assessment").select(
        "id_assessment", "id_student", *PRESENTATION_KEY, "date_submitted", "is_banked", "score"
    )


def typed_interactions(student_vle: DataFrame) -> DataFrame:
    """Click rows at their raw grain with cleaned keys."""
    return student_vle.select(
        _text("code_module"),
        _text("code_presentation"),
        _int("id_student"),
        _int("id_site"),
        _int("date", "interaction_date"),
        _int("sum_click"),
    )


def clean_student_vle_interaction(student_vle: DataFrame) -> DataFrame:
    """One row per student, resource and day, clicks added up.

    Keys are cleaned before grouping, so padded and bare spellings of a key meet.
    """
    return consolidate(typed_interactions(student_vle), INTERACTION_KEY, ["sum_click"])


def clean_plans(tables: Mapping[str, DataFrame]) -> dict[str, Callable[[], DataFrame]]:
    """The clean tables in order, each built when called from what ``tables`` holds then."""
    t = tables
    return {
        "clean_module_presentation": lambda: clean_module_presentation(t["stg_courses"]),
        "clean_student": lambda: clean_student(t["stg_student_info"]),
        "clean_registration": lambda: clean_registration(t["stg_student_info"], t["stg_student_registration"]),
        "clean_assessment": lambda: clean_assessment(t["stg_assessments"]),
        "clean_vle_resource": lambda: clean_vle_resource(t["stg_vle"]),
        "clean_student_assessment": lambda: clean_student_assessment(t["stg_student_assessment"], t["clean_assessment"]),
        "clean_student_vle_interaction": lambda: clean_student_vle_interaction(t["stg_student_vle"]),
    }


def build_clean(stg: Mapping[str, DataFrame]) -> dict[str, DataFrame]:
    tables = dict(stg)
    return {name: tables.setdefault(name, plan()) for name, plan in clean_plans(tables).items()}


CLEAN_RULES: dict[str, tuple[Rule, ...]] = {
    "clean_module_presentation": (
        NotNull((*PRESENTATION_KEY, "module_presentation_length")),
        Unique(PRESENTATION_KEY),
        Check("length above zero", "module_presentation_length > 0"),
    ),
    "clean_student": (
        NotNull(("id_student", "gender", "region", "highest_education", "disability")),
        Unique(("id_student",)),
        Check("known gender", one_of("gender", GENDERS)),
        Check("known disability flag", one_of("disability", DISABILITIES)),
        Check("known deprivation band", one_of("imd_band", IMD_BANDS)),
    ),
    "clean_registration": (
        NotNull((*REGISTRATION_KEY, "age_band", "num_of_prev_attempts", "studied_credits", "final_result")),
        Unique(REGISTRATION_KEY),
        ForeignKey(("id_student",), "clean_student"),
        ForeignKey(PRESENTATION_KEY, "clean_module_presentation"),
        Check("known age band", one_of("age_band", AGE_BAND_ORDER)),
        Check("attempts not negative", "num_of_prev_attempts >= 0"),
        Check("credits above zero", "studied_credits > 0"),
        Check("known result", one_of("final_result", RESULT_ORDER)),
        Check("unregistered after registering", "date_unregistration >= date_registration"),
    ),
    "clean_assessment": (
        NotNull(("id_assessment", *PRESENTATION_KEY, "assessment_type", "weight")),
        Unique(("id_assessment",)),
        ForeignKey(PRESENTATION_KEY, "clean_module_presentation"),
        Check("known assessment type", one_of("assessment_type", ASSESSMENT_TYPES)),
        Check("weight within 0 to 100", "weight BETWEEN 0 AND 100"),
    ),
    "clean_vle_resource": (
        NotNull(("id_site", *PRESENTATION_KEY, "activity_type")),
        Unique(("id_site",)),
        ForeignKey(PRESENTATION_KEY, "clean_module_presentation"),
        Check(
            "weeks both missing or in order",
            "CASE WHEN week_from IS NULL OR week_to IS NULL THEN week_from IS NULL AND week_to IS NULL"
            " ELSE week_from >= 0 AND week_to >= week_from END",
        ),
    ),
    "clean_student_assessment": (
        NotNull(("id_assessment", "id_student", *PRESENTATION_KEY, "date_submitted", "is_banked")),
        Unique(("id_assessment", "id_student")),
        ForeignKey(("id_assessment",), "clean_assessment"),
        ForeignKey(REGISTRATION_KEY, "clean_registration"),
        Check("banked flag 0 or 1", "is_banked IN (0, 1)"),
        Check("score within 0 to 100", "score BETWEEN 0 AND 100"),
    ),
    "clean_student_vle_interaction": (
        NotNull((*INTERACTION_KEY, "sum_click")),
        Unique(INTERACTION_KEY),
        ForeignKey(REGISTRATION_KEY, "clean_registration"),
        ForeignKey(SITE_KEY, "clean_vle_resource"),
        Check("clicks above zero", "sum_click > 0"),
    ),
}
