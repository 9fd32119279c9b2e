"""Table layouts, value domains and key rules of the learning-activity model.

Identifiers and day offsets are ``bigint`` so that no table size makes them
overflow. Days count from the start of a presentation and may be negative.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql.types import StringType, StructField, StructType


@dataclass(frozen=True)
class SourceFile:
    """A raw CSV file, the staging table it feeds, and its header."""

    filename: str
    table: str
    columns: tuple[str, ...]

    @property
    def text_schema(self) -> StructType:
        return StructType([StructField(c, StringType()) for c in self.columns])


# File names and headers of the raw files.
SOURCES = (
    SourceFile("courses.csv", "stg_courses", ("code_module", "code_presentation", "module_presentation_length")),
    SourceFile(
        "assessments.csv",
        "stg_assessments",
        ("code_module", "code_presentation", "id_assessment", "assessment_type", "date", "weight"),
    ),
    SourceFile(
        "vle.csv",
        "stg_vle",
        ("id_site", "code_module", "code_presentation", "activity_type", "week_from", "week_to"),
    ),
    SourceFile(
        "studentInfo.csv",
        "stg_student_info",
        (
            "code_module", "code_presentation", "id_student", "gender", "region", "highest_education",
            "imd_band", "age_band", "num_of_prev_attempts", "studied_credits", "disability", "final_result",
        ),
    ),
    SourceFile(
        "studentRegistration.csv",
        "stg_student_registration",
        ("code_module", "code_presentation", "id_student", "date_registration", "date_unregistration"),
    ),
    SourceFile(
        "studentAssessment.csv",
        "stg_student_assessment",
        ("id_assessment", "id_student", "date_submitted", "is_banked", "score"),
    ),
    SourceFile(
        "studentVle.csv",
        "stg_student_vle",
        ("code_module", "code_presentation", "id_student", "id_site", "date", "sum_click"),
    ),
)
SOURCE_BY_TABLE = {s.table: s for s in SOURCES}

# Domains, label corrections, category codes and formats.
GENDERS = ("M", "F")
DISABILITIES = ("Y", "N")
IMD_BANDS = (
    "0-10%", "10-20%", "20-30%", "30-40%", "40-50%", "50-60%", "60-70%", "70-80%", "80-90%", "90-100%",
)
IMD_LABEL_FIXES = {"10-20": "10-20%"}
AGE_BAND_ORDER = {"0-35": 1, "35-55": 2, "55<=": 3}
RESULT_ORDER = {"Distinction": 1, "Pass": 2, "Fail": 3, "Withdrawn": 4}
RESULT_CATEGORY = {
    "Distinction": "Successful", "Pass": "Successful", "Fail": "Unsuccessful", "Withdrawn": "Withdrawn",
}
SUCCESS_RESULTS = ("Pass", "Distinction")
ASSESSMENT_TYPES = ("TMA", "CMA", "Exam")
PRESENTATION_TERMS = ("B", "J")
MODULE_PATTERN = "^[A-Z]{3}$"
PRESENTATION_PATTERN = "^[0-9]{4}[BJ]$"
DIGITS_PATTERN = "^[0-9]+$"
DATE_DIMENSION_DAYS = (-150, 300)

# Row counts of the full published data set, by table.
FULL_DATA_ROWS = {
    "stg_courses": 22,
    "stg_assessments": 206,
    "stg_vle": 6_364,
    "stg_student_info": 32_593,
    "stg_student_registration": 32_593,
    "stg_student_assessment": 173_912,
    "stg_student_vle": 10_655_280,
    "clean_module_presentation": 22,
    "clean_student": 28_785,
    "clean_registration": 32_593,
    "clean_assessment": 206,
    "clean_vle_resource": 6_364,
    "clean_student_assessment": 173_912,
    "clean_student_vle_interaction": 8_459_320,
    "analytics_student_engagement": 32_593,
    "analytics_completion_by_presentation": 22,
    "analytics_assessment_performance": 57,
    "analytics_engagement_by_result": 4,
}

# The keys of the tables.
PRESENTATION_KEY = ("code_module", "code_presentation")
REGISTRATION_KEY = ("id_student", "code_module", "code_presentation")
SITE_KEY = ("id_site", "code_module", "code_presentation")
INTERACTION_KEY = ("code_module", "code_presentation", "id_student", "id_site", "interaction_date")
