"""Profiles of the raw text tables, before anything is cleaned."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tallyframe.functions import bad_format, composite, is_missing, is_present, to_decimal, to_int
from tallyframe.operators import aggregates as agg
from tallyframe.operators import profile
from tallyframe.operators.joins import orphan_counts, spread, union_all, with_keys
from tallyframe.operators.ordering import top_k
from tallyframe.schemas import (
    DIGITS_PATTERN,
    MODULE_PATTERN,
    PRESENTATION_KEY,
    PRESENTATION_PATTERN,
    REGISTRATION_KEY,
    SOURCE_BY_TABLE,
)

Tables = Mapping[str, DataFrame]


def _keyed(stg: Tables, table: str) -> DataFrame:
    """A raw table with its keys trimmed, so that padded and bare spellings meet."""
    df = stg[table]
    keys = {c: F.trim(F.col(c)) for c in (*RAW_KEYS[table], *PRESENTATION_KEY) if c in df.columns and c != "date"}
    return with_keys(df, keys)


# The keys each raw table is expected to be unique on.
RAW_KEYS = {
    "stg_courses": PRESENTATION_KEY,
    "stg_assessments": ("id_assessment",),
    "stg_vle": ("id_site",),
    "stg_student_info": REGISTRATION_KEY,
    "stg_student_registration": REGISTRATION_KEY,
    "stg_student_assessment": ("id_assessment", "id_student"),
    "stg_student_vle": (*PRESENTATION_KEY, "id_student", "id_site", "date"),
}


def missing_values(stg: Tables, table: str) -> DataFrame:
    return profile.missing_profile(stg[table], SOURCE_BY_TABLE[table].columns)


def repeated_keys(stg: Tables, table: str) -> DataFrame:
    return agg.duplicate_keys(_keyed(stg, table), RAW_KEYS[table])


def unknown_presentations(stg: Tables, table: str) -> DataFrame:
    """Rows per presentation that the course table does not list."""
    return orphan_counts(_keyed(stg, table), _keyed(stg, "stg_courses"), PRESENTATION_KEY, PRESENTATION_KEY)


def malformed_courses(stg: Tables) -> DataFrame:
    length = F.coalesce(to_int("module_presentation_length"), F.lit(0))
    return stg["stg_courses"].where(
        bad_format("code_module", MODULE_PATTERN)
        | bad_format("code_presentation", PRESENTATION_PATTERN)
        | bad_format("module_presentation_length", DIGITS_PATTERN)
        | (length <= 0)
    )


def course_summary(stg: Tables) -> DataFrame:
    length = to_int("module_presentation_length")
    return profile.numeric_profile(
        stg["stg_courses"],
        {
            "unique_modules": F.countDistinct("code_module"),
            "unique_presentations": F.countDistinct("code_presentation"),
            "shortest_length_days": F.min(length),
            "longest_length_days": F.max(length),
            "average_length_days": agg.rounded_mean(length),
        },
    )


def undated_assessments(stg: Tables) -> DataFrame:
    undated = stg["stg_assessments"].where(is_missing("date"))
    return undated.groupBy("assessment_type").agg(F.count(F.lit(1)).alias("missing_date_count"))


def assessment_ranges(stg: Tables) -> DataFrame:
    day, weight = to_int("date"), to_decimal("weight")
    return profile.numeric_profile(
        stg["stg_assessments"],
        {
            "number_of_assessments": F.count(F.lit(1)),
            "earliest_deadline_day": F.min(day),
            "latest_deadline_day": F.max(day),
            "minimum_weight": F.min(weight),
            "maximum_weight": F.max(weight),
        },
        ["assessment_type"],
    )


def unweighted_assessments(stg: Tables) -> DataFrame:
    free = stg["stg_assessments"].where(to_decimal("weight") == 0)
    return free.groupBy("assessment_type").agg(F.count(F.lit(1)).alias("zero_weight_assessments"))


def _with_length(df: DataFrame, stg: Tables) -> DataFrame:
    return df.join(_keyed(stg, "stg_courses"), list(PRESENTATION_KEY)).withColumn(
        "length_days", to_int("module_presentation_length")
    )


def deadlines_outside_presentation(stg: Tables) -> DataFrame:
    dated = _with_length(_keyed(stg, "stg_assessments"), stg).withColumn("deadline_day", to_int("date"))
    outside = dated.where((F.col("deadline_day") < 0) | (F.col("deadline_day") > F.col("length_days")))
    return outside.select(*PRESENTATION_KEY, "id_assessment", "assessment_type", "deadline_day", "length_days")


def week_pairs(stg: Tables) -> DataFrame:
    """Resources by which of their two weeks is missing."""
    start, end = is_missing("week_from"), is_missing("week_to")
    return agg.conditional_counts(
        stg["stg_vle"],
        [],
        {
            "both_weeks_missing": start & end,
            "only_week_from_missing": start & ~end,
            "only_week_to_missing": ~start & end,
        },
    )


def week_ranges(stg: Tables) -> DataFrame:
    start, end = to_int("week_from"), to_int("week_to")
    return profile.numeric_profile(
        stg["stg_vle"].where(is_present("week_from") & is_present("week_to")),
        {
            "resources_with_week_information": F.count(F.lit(1)),
            "earliest_week_from": F.min(start),
            "latest_week_to": F.max(end),
            "reversed_week_ranges": F.count_if(start > end),
            "negative_week_records": F.count_if((start < 0) | (end < 0)),
        },
    )


def resources_by_activity(stg: Tables) -> DataFrame:
    return stg["stg_vle"].groupBy("activity_type").agg(F.count(F.lit(1)).alias("number_of_resources"))


def missing_bands(stg: Tables) -> DataFrame:
    unknown = _keyed(stg, "stg_student_info").where(is_missing("imd_band"))
    return unknown.groupBy(*PRESENTATION_KEY).agg(F.count(F.lit(1)).alias("missing_imd_records"))


def student_consistency(stg: Tables) -> DataFrame:
    return profile.consistency(
        _keyed(stg, "stg_student_info"),
        "id_student",
        ["gender", "region", "highest_education", "imd_band", "age_band", "disability"],
    )


def age_band_histories(stg: Tables) -> DataFrame:
    """Students recorded in several age bands, with their bands and enrolments."""
    info = _keyed(stg, "stg_student_info")
    several = info.join(profile.varying_entities(info, "id_student", "age_band"), "id_student")
    bands = agg.string_list(several, ["id_student"], "age_band", "recorded_age_bands")
    enrolment = F.concat(composite(*PRESENTATION_KEY), F.lit(": "), F.col("age_band"))
    history = agg.string_list(several, ["id_student"], enrolment, "enrolment_history", " | ", "code_presentation", distinct=False)
    return bands.join(history, "id_student")


def student_frequencies(stg: Tables) -> DataFrame:
    return profile.frequencies(
        stg["stg_student_info"],
        ["gender", "age_band", "disability", "final_result", "highest_education", "imd_band", "region"],
    )


def student_numbers(stg: Tables) -> DataFrame:
    attempts, credits = to_int("num_of_prev_attempts"), to_int("studied_credits")
    return profile.numeric_profile(
        stg["stg_student_info"],
        {
            "unique_students": F.countDistinct("id_student"),
            "minimum_previous_attempts": F.min(attempts),
            "maximum_previous_attempts": F.max(attempts),
            "average_previous_attempts": agg.rounded_mean(attempts),
            "minimum_studied_credits": F.min(credits),
            "maximum_studied_credits": F.max(credits),
            "average_studied_credits": agg.rounded_mean(credits),
            "negative_previous_attempts": F.count_if(attempts < 0),
            "nonpositive_studied_credits": F.count_if(credits <= 0),
        },
    )


def largest_credit_loads(stg: Tables, k: int = 15) -> DataFrame:
    loads = stg["stg_student_info"].groupBy(to_int("studied_credits").alias("studied_credits")).agg(
        F.count(F.lit(1)).alias("number_of_records")
    )
    return top_k(loads, k, F.desc("studied_credits"))


def dates_by_outcome(stg: Tables) -> DataFrame:
    joined = _keyed(stg, "stg_student_registration").join(
        _keyed(stg, "stg_student_info").select(*REGISTRATION_KEY, "final_result"), list(REGISTRATION_KEY)
    )
    return joined.groupBy("final_result").agg(
        F.count(F.lit(1)).alias("total_records"),
        F.count_if(is_missing("date_registration")).alias("missing_registration_dates"),
        F.count_if(is_missing("date_unregistration")).alias("missing_unregistration_dates"),
        F.count_if(is_present("date_unregistration")).alias("recorded_unregistration_dates"),
    )


def registration_mismatches(stg: Tables) -> DataFrame:
    """Registrations without student record and student records without registration."""
    info, registration = _keyed(stg, "stg_student_info"), _keyed(stg, "stg_student_registration")
    names = ["registrations_without_student_info", "student_info_without_registration"]
    sides = [(registration, info), (info, registration)]
    parts = [
        orphan_counts(child, parent, REGISTRATION_KEY, name="n").withColumn("side", F.lit(name))
        for name, (child, parent) in zip(names, sides, strict=True)
    ]
    return spread(union_all(parts), "side", "n", names)


def registration_ranges(stg: Tables) -> DataFrame:
    start, end, length = to_int("date_registration"), to_int("date_unregistration"), F.col("length_days")
    return profile.numeric_profile(
        _with_length(_keyed(stg, "stg_student_registration"), stg),
        {
            "earliest_registration_day": F.min(start),
            "latest_registration_day": F.max(start),
            "earliest_unregistration_day": F.min(end),
            "latest_unregistration_day": F.max(end),
            "unregistration_before_registration": F.count_if(end < start),
            "registration_after_module_end": F.count_if(start > length),
            "unregistration_after_module_end": F.count_if(end > length),
        },
    )


def late_unregistrations(stg: Tables) -> DataFrame:
    """Students who left after the module had ended, and by how many days."""
    end = to_int("date_unregistration")
    late = _with_length(_keyed(stg, "stg_student_registration"), stg).where(end > F.col("length_days"))
    outcome = _keyed(stg, "stg_student_info").select(*REGISTRATION_KEY, "final_result")
    return late.join(outcome, list(REGISTRATION_KEY)).select(
        *REGISTRATION_KEY, "date_registration", "date_unregistration", "length_days", "final_result",
        (end - F.col("length_days")).alias("days_after_module_end"),
    )


def earliest_unregistrations(stg: Tables, k: int = 10) -> DataFrame:
    """Sorted by the number the text stands for; the key breaks ties."""
    left = _keyed(stg, "stg_student_registration").where(is_present("date_unregistration"))
    outcome = _keyed(stg, "stg_student_info").select(*REGISTRATION_KEY, "final_result")
    rows = left.join(outcome, list(REGISTRATION_KEY)).select(
        *REGISTRATION_KEY, "date_registration", "date_unregistration", "final_result"
    )
    return top_k(rows, k, to_int("date_unregistration").asc(), *[F.col(c).asc() for c in REGISTRATION_KEY])


def result_ranges(stg: Tables) -> DataFrame:
    score, day = to_int("score"), to_int("date_submitted")
    return profile.numeric_profile(
        stg["stg_student_assessment"],
        {
            "minimum_score": F.min(score),
            "maximum_score": F.max(score),
            "scores_outside_0_to_100": F.count_if(~score.between(0, 100)),
            "earliest_submission_day": F.min(day),
            "latest_submission_day": F.max(day),
            "submissions_before_module_start": F.count_if(day < 0),
            "invalid_banked_values": F.count_if(~F.trim("is_banked").isin("0", "1")),
        },
    )


def early_submissions(stg: Tables) -> DataFrame:
    day = to_int("date_submitted")
    return profile.numeric_profile(
        stg["stg_student_assessment"].where(day < 0),
        {
            "early_submissions": F.count(F.lit(1)),
            "earliest_submission_day": F.min(day),
            "latest_early_submission_day": F.max(day),
        },
        ["is_banked"],
    )


def results_without_registration(stg: Tables) -> DataFrame:
    """Results per presentation whose student is not registered there."""
    context = _keyed(stg, "stg_assessments").select("id_assessment", *PRESENTATION_KEY)
    results = _keyed(stg, "stg_student_assessment").join(context, "id_assessment")
    return orphan_counts(
        results, _keyed(stg, "stg_student_registration"), REGISTRATION_KEY, PRESENTATION_KEY,
        "assessment_results_without_registration",
    )


def results_without_assessment(stg: Tables) -> DataFrame:
    return orphan_counts(
        _keyed(stg, "stg_student_assessment"), _keyed(stg, "stg_assessments"), ["id_assessment"], ["id_assessment"]
    )


def late_results(stg: Tables) -> DataFrame:
    """Results handed in after the module had ended."""
    context = _with_length(_keyed(stg, "stg_assessments"), stg).select(
        "id_assessment", *PRESENTATION_KEY, "assessment_type", "length_days"
    )
    gap = to_int("date_submitted") - F.col("length_days")
    return (
        _keyed(stg, "stg_student_assessment")
        .join(context, "id_assessment")
        .withColumn("days_after_module_end", gap)
        .where("days_after_module_end > 0")
    )


def lateness(stg: Tables, by_type: bool = True) -> DataFrame:
    """Late results and the longest delay, per assessment type or in total."""
    groups = [*PRESENTATION_KEY, "assessment_type"] if by_type else []
    return late_results(stg).groupBy(*groups).agg(
        F.count(F.lit(1)).alias("late_submission_records"),
        F.max("days_after_module_end").alias("maximum_days_after_end"),
    )


def latest_results(stg: Tables, k: int = 10) -> DataFrame:
    columns = [
        "id_student", "id_assessment", *PRESENTATION_KEY, "assessment_type", "date_submitted", "length_days",
        "days_after_module_end", "is_banked", "score",
    ]
    order = [F.desc("days_after_module_end"), F.asc("id_student"), F.asc("id_assessment")]
    return top_k(late_results(stg).select(*columns), k, *order)
