"""Two star schemas.

The engagement mart has one fact row per registration. The click mart keeps
enrolments, results and clicks at their raw grain. Dimensions get dense keys in
natural-key order and are written out before facts look them up, so that joins
are planned from their real sizes.
"""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tallyframe.functions import (
    coded,
    day_gap,
    null_markers,
    presentation_term,
    presentation_year,
    to_decimal,
    to_int,
    week_trunc,
)
from tallyframe.operators.aggregates import row_count
from tallyframe.operators.joins import spread, star_denormalise, star_lookup, union_all
from tallyframe.operators.ordering import distinct_rows, first_per_key, surrogate_key
from tallyframe.operators.quality import Check, ForeignKey, NotNull, Rule, Unique, one_of
from tallyframe.schemas import (
    AGE_BAND_ORDER,
    DATE_DIMENSION_DAYS,
    PRESENTATION_KEY,
    PRESENTATION_TERMS,
    REGISTRATION_KEY,
    RESULT_CATEGORY,
    RESULT_ORDER,
    SUCCESS_RESULTS,
)
from tallyframe.session import materialise
from tallyframe.sources import day_range

# ---------------------------------------------------------------- engagement mart


def dim_student(clean_student: DataFrame) -> DataFrame:
    return surrogate_key(clean_student, "student_key", ["id_student"])


def dim_module_presentation(clean_module_presentation: DataFrame) -> DataFrame:
    parsed = clean_module_presentation.select(
        *PRESENTATION_KEY,
        presentation_year("code_presentation").alias("presentation_year"),
        presentation_term("code_presentation").alias("presentation_term"),
        "module_presentation_length",
    )
    return surrogate_key(parsed, "module_presentation_key", PRESENTATION_KEY)


def dim_age_band(clean_registration: DataFrame) -> DataFrame:
    bands = (
        distinct_rows(clean_registration, "age_band")
        .where("age_band IS NOT NULL")
        .withColumn("age_band_order", coded("age_band", AGE_BAND_ORDER))
    )
    return surrogate_key(bands, "age_band_key", ["age_band_order"])


def dim_outcome(clean_registration: DataFrame) -> DataFrame:
    outcomes = (
        distinct_rows(clean_registration, "final_result")
        .where("final_result IS NOT NULL")
        .select(
            "final_result",
            coded("final_result", RESULT_CATEGORY).alias("outcome_category"),
            F.col("final_result").isin(*SUCCESS_RESULTS).cast("int").alias("successful_completion"),
            coded("final_result", RESULT_ORDER).alias("outcome_order"),
        )
    )
    return surrogate_key(outcomes, "outcome_key", ["outcome_order"])


def engagement_dimensions(clean: Mapping[str, DataFrame]) -> dict[str, DataFrame]:
    dims = {
        "dim_student": dim_student(clean["clean_student"]),
        "dim_module_presentation": dim_module_presentation(clean["clean_module_presentation"]),
        "dim_age_band": dim_age_band(clean["clean_registration"]),
        "dim_outcome": dim_outcome(clean["clean_registration"]),
    }
    return {name: materialise(df, name) for name, df in dims.items()}


def fact_learning_engagement(
    registration: DataFrame, student_engagement: DataFrame, dims: Mapping[str, DataFrame]
) -> DataFrame:
    """One row per registration: dimension keys, credits, attempts, engagement."""
    measures = ["total_clicks", "active_days", "resources_used", "assessment_submissions", "average_score"]
    source = registration.join(
        student_engagement.select(*REGISTRATION_KEY, *measures), list(REGISTRATION_KEY)
    ).withColumnRenamed("num_of_prev_attempts", "previous_attempts")
    looked_up = star_lookup(
        source,
        [
            (dims["dim_module_presentation"], PRESENTATION_KEY, "module_presentation_key"),
            (dims["dim_age_band"], ["age_band"], "age_band_key"),
            (dims["dim_outcome"], ["final_result"], "outcome_key"),
            (dims["dim_student"], ["id_student"], "student_key"),
        ],
    ).select(
        "student_key", "module_presentation_key", "age_band_key", "outcome_key",
        "studied_credits", "previous_attempts", *measures,
    )
    return surrogate_key(looked_up, "engagement_fact_key", ["student_key", "module_presentation_key"])


def labelled_engagement(fact: DataFrame, dims: Mapping[str, DataFrame]) -> DataFrame:
    """Engagement facts with natural labels in place of keys."""
    return star_denormalise(
        fact,
        [
            (dims["dim_student"], "student_key", ["id_student"]),
            (dims["dim_module_presentation"], "module_presentation_key", PRESENTATION_KEY),
            (dims["dim_age_band"], "age_band_key", ["age_band"]),
            (dims["dim_outcome"], "outcome_key", ["final_result"]),
        ],
    ).select(
        "engagement_fact_key", "id_student", *PRESENTATION_KEY, "age_band", "final_result", "studied_credits",
        "total_clicks", "active_days", "resources_used", "assessment_submissions", "average_score",
    )


ENGAGEMENT_MART_RULES: dict[str, tuple[Rule, ...]] = {
    "dim_student": (Unique(("student_key",)), Unique(("id_student",))),
    "dim_module_presentation": (
        Unique(("module_presentation_key",)),
        Unique(PRESENTATION_KEY),
        Check("known term", one_of("presentation_term", PRESENTATION_TERMS)),
        Check("length above zero", "module_presentation_length > 0"),
    ),
    "dim_age_band": (
        Unique(("age_band_key",)),
        Unique(("age_band",)),
        Check("known age band", one_of("age_band", AGE_BAND_ORDER)),
        Check("age order 1 to 3", "age_band_order BETWEEN 1 AND 3"),
    ),
    "dim_outcome": (
        Unique(("outcome_key",)),
        Unique(("final_result",)),
        Check("known result", one_of("final_result", RESULT_ORDER)),
        Check("success flag 0 or 1", "successful_completion IN (0, 1)"),
    ),
    "fact_learning_engagement": (
        NotNull(("student_key", "module_presentation_key", "age_band_key", "outcome_key")),
        Unique(("student_key", "module_presentation_key")),
        ForeignKey(("student_key",), "dim_student"),
        ForeignKey(("module_presentation_key",), "dim_module_presentation"),
        ForeignKey(("age_band_key",), "dim_age_band"),
        ForeignKey(("outcome_key",), "dim_outcome"),
        Check("credits above zero", "studied_credits > 0"),
        Check("attempts not negative", "previous_attempts >= 0"),
        Check("clicks not negative", "total_clicks >= 0"),
        Check("days not negative", "active_days >= 0"),
        Check("resources not negative", "resources_used >= 0"),
        Check("submissions not negative", "assessment_submissions >= 0"),
        Check("mean score within 0 to 100", "average_score BETWEEN 0 AND 100"),
    ),
}

def row_differences(tables: Mapping[str, DataFrame]) -> DataFrame:
    """One row per fact in ``tables``: its rows, those it should have by its source, and the difference.

    A fact that looks its dimensions up by inner joins loses rows without any
    unmatched key showing in it, so it is held against its source.
    """


    def keys(table: str, *names: str) -> DataFrame:
        return tables[table].select(*[to_int(c) if c.startswith("id_") else F.trim(F.col(c)) for c in names]).distinct()

    sources = {
        "engagement_mart.fact_learning_engagement": lambda: tables["clean_registration"],
        "click_mart.fact_student_enrollment": lambda: keys("stg_student_info", *REGISTRATION_KEY),
        "click_mart.fact_student_assessment": lambda: keys("stg_student_assessment", "id_student", "id_assessment"),
        "click_mart.fact_student_vle": lambda: tables["stg_student_vle"],
    }
    return union_all(
        [
            spread(
                union_all([row_count(tables[fact], "n").withColumn("side", F.lit("fact_rows")),
                           row_count(source(), "n").withColumn("side", F.lit("expected_rows"))]),
                "side", "n", ["fact_rows", "expected_rows"],
            ).select(F.lit(fact).alias("fact"), "*", (F.col("fact_rows") - F.col("expected_rows")).alias("difference"))
            for fact, source in sources.items()
            if fact in tables
        ]
    )


# ---------------------------------------------------------------- click mart


def dim_date(spark: SparkSession, first: int = DATE_DIMENSION_DAYS[0], last: int = DATE_DIMENSION_DAYS[1]) -> DataFrame:
    """Day offsets with their week (rounded toward zero) and a before-start flag."""
    return day_range(spark, first, last, "date_key").select(
        "date_key",
        week_trunc("date_key").alias("week_number"),
        (F.col("date_key") < 0).alias("is_before_start"),
    )


def _presentation(df: DataFrame) -> DataFrame:
    return df.withColumns({c: F.trim(F.col(c)) for c in PRESENTATION_KEY})


def dim_course(courses: DataFrame) -> DataFrame:
    rows = _presentation(courses).select(*PRESENTATION_KEY, to_int("module_presentation_length").alias("module_presentation_length"))
    return surrogate_key(rows.distinct(), "course_key", [*PRESENTATION_KEY, "module_presentation_length"])


def dim_student_picked(student_info: DataFrame) -> DataFrame:
    """One row per student as recorded for the earliest presentation code."""
    rows = student_info.select(
        to_int("id_student").alias("id_student"),
        F.trim("code_presentation").alias("code_presentation"),
        F.trim("gender").alias("gender"),
        F.trim("region").alias("region"),
        F.trim("highest_education").alias("highest_education"),
        F.coalesce(null_markers("imd_band"), F.lit("Unknown")).alias("imd_band"),
        F.trim("age_band").alias("age_band"),
        F.trim("disability").alias("disability"),
    )
    picked = first_per_key(rows, ["id_student"], ["code_presentation"]).drop("code_presentation")
    return surrogate_key(picked, "student_key", ["id_student"])


def dim_assessment(assessments: DataFrame, course: DataFrame) -> DataFrame:
    rows = _presentation(assessments).join(course.select(*PRESENTATION_KEY, "course_key"), list(PRESENTATION_KEY)).select(
        to_int("id_assessment").alias("id_assessment"),
        "course_key",
        F.trim("assessment_type").alias("assessment_type"),
        to_int("date").alias("assessment_date_days"),
        to_decimal("weight").alias("weight"),
    )
    return surrogate_key(first_per_key(rows, ["id_assessment"], ["course_key"]), "assessment_key", ["id_assessment"])


def dim_vle_material(vle: DataFrame, course: DataFrame) -> DataFrame:
    rows = _presentation(vle).join(course.select(*PRESENTATION_KEY, "course_key"), list(PRESENTATION_KEY)).select(
        to_int("id_site").alias("id_site"),
        "course_key",
        F.trim("activity_type").alias("activity_type"),
        to_int("week_from").alias("week_from"),
        to_int("week_to").alias("week_to"),
    )
    return surrogate_key(first_per_key(rows, ["id_site"], ["course_key"]), "vle_key", ["id_site"])


def click_dimensions(stg: Mapping[str, DataFrame]) -> dict[str, DataFrame]:
    course = materialise(dim_course(stg["stg_courses"]), "dim_course")
    rest = {
        "dim_student": dim_student_picked(stg["stg_student_info"]),
        "dim_assessment": dim_assessment(stg["stg_assessments"], course),
        "dim_vle_material": dim_vle_material(stg["stg_vle"], course),
    }
    return {"dim_course": course, **{name: materialise(df, name) for name, df in rest.items()}}


def fact_student_enrollment(stg: Mapping[str, DataFrame], dims: Mapping[str, DataFrame]) -> DataFrame:
    """One row per student and course; dates are null where none is recorded."""
    keys = [to_int("id_student").alias("id_student"), *[F.trim(F.col(c)).alias(c) for c in PRESENTATION_KEY]]
    info = stg["stg_student_info"].select(
        *keys,
        to_int("num_of_prev_attempts").alias("num_of_prev_attempts"),
        to_int("studied_credits").alias("studied_credits"),
        F.trim("final_result").alias("final_result"),
    )
    dates = stg["stg_student_registration"].select(
        *keys,
        to_int("date_registration").alias("date_registration"),
        to_int("date_unregistration").alias("date_unregistration"),
    )
    rows = star_lookup(
        info.join(dates, list(REGISTRATION_KEY), "left"),
        [(dims["dim_course"], PRESENTATION_KEY, "course_key"), (dims["dim_student"], ["id_student"], "student_key")],
    ).select(
        "student_key", "course_key", "date_registration", "date_unregistration",
        "num_of_prev_attempts", "studied_credits", "final_result",
    )
    grain = ["student_key", "course_key"]
    return surrogate_key(first_per_key(rows, grain, ["date_registration"]), "enrollment_key", grain)


def fact_student_assessment(stg: Mapping[str, DataFrame], dims: Mapping[str, DataFrame]) -> DataFrame:
    """One row per student and assessment, with the days from deadline to submission."""
    results = stg["stg_student_assessment"].select(
        to_int("id_student").alias("id_student"),
        to_int("id_assessment").alias("id_assessment"),
        to_int("date_submitted").alias("date_submitted"),
        (to_int("is_banked") == 1).alias("is_banked"),
        to_decimal("score").alias("score"),
    )
    deadlines = dims["dim_assessment"].select("id_assessment", "assessment_key", "assessment_date_days")
    rows = (
        results.join(deadlines, "id_assessment")
        .join(dims["dim_student"].select("id_student", "student_key"), "id_student")
        .select(
            "student_key", "assessment_key", "date_submitted", "is_banked", "score",
            day_gap("date_submitted", "assessment_date_days").alias("submission_delay_days"),
        )
    )
    grain = ["student_key", "assessment_key"]
    return surrogate_key(first_per_key(rows, grain, ["date_submitted"]), "submission_key", grain)


def fact_student_vle(stg: Mapping[str, DataFrame], dims: Mapping[str, DataFrame]) -> DataFrame:
    """Every raw click row with its dimension keys; nothing is consolidated.

    Rows get a unique key in one pass. It is not dense: dense keys would need
    the whole fact to be written a second time.
    """
    clicks = stg["stg_student_vle"].select(
        to_int("id_student").alias("id_student"),
        to_int("id_site").alias("id_site"),
        *[F.trim(F.col(c)).alias(c) for c in PRESENTATION_KEY],
        to_int("date").alias("interaction_date"),
        to_int("sum_click").alias("sum_clicks"),
    )
    return star_lookup(
        clicks,
        [
            (dims["dim_course"], PRESENTATION_KEY, "course_key"),
            (dims["dim_vle_material"], ["id_site"], "vle_key"),
            (dims["dim_student"], ["id_student"], "student_key"),
        ],
    ).select(
        (F.monotonically_increasing_id() + 1).alias("vle_activity_key"),
        "student_key", "course_key", "vle_key", "interaction_date", "sum_clicks",
    )
