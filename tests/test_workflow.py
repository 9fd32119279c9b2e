"""The whole workflow on hand-checkable files."""

from decimal import Decimal as D

import pytest
import raw_files
from conftest import one, rows

from tallyframe.operators.quality import QualityError, rule_report
from tallyframe.plans import analytics, clean, marts, profiling, quality, workflow
from tallyframe.sinks import read_table
from tallyframe.sources import CountMismatch, load_staging


@pytest.fixture(scope="module")
def ok(spark, tmp_path_factory):
    stg = load_staging(spark, raw_files.write(tmp_path_factory.mktemp("ok")))
    return {**stg, **clean.build_clean(stg)}


def load(spark, tmp_path, changes):
    stg = load_staging(spark, raw_files.write(tmp_path, changes))
    return {**stg, **clean.build_clean(stg)}


def test_clean_student_standardises_and_collapses(ok):
    assert rows(ok["clean_student"].select("id_student", "gender", "imd_band", "disability"), "id_student") == [
        (1, "M", "20-30%", "N"), (2, "F", None, "Y"), (3, "F", "90-100%", "N"), (4, "M", "50-60%", "N"),
    ]


def test_clean_registration_dates(ok):
    got = rows(ok["clean_registration"].select("id_student", "code_module", "date_registration", "date_unregistration"))
    assert got == [(1, "AAA", -10, None), (1, "BBB", -5, None), (2, "AAA", -20, None), (3, "AAA", None, 100),
                   (3, "BBB", -1, None), (4, "BBB", 0, None)]


def test_clean_assessment_and_resource(ok):
    assert rows(ok["clean_assessment"].select("id_assessment", "assessment_date", "weight"), "id_assessment") == [
        (10, 20, D("30.00")), (11, None, D("100.00")), (12, 30, D("12.50")),
    ]
    assert rows(ok["clean_vle_resource"].select("id_site", "week_from", "week_to"), "id_site") == [
        (100, None, None), (101, 1, 3), (200, None, None),
    ]


def test_interactions_consolidate(ok):
    clicks = ok["clean_student_vle_interaction"]
    assert clicks.count() == 16
    day0 = clicks.where("id_student = 1 AND id_site = 100 AND interaction_date = 0")
    assert [r.sum_click for r in day0.collect()] == [7]


def test_padded_keys_meet(spark, tmp_path):
    t = load(spark, tmp_path, raw_files.DIRTY)
    assert rows(t["clean_student_vle_interaction"]) == [("AAA", "2013J", 1, 100, 0, 8), ("BBB", "2014B", 3, 200, None, 4)]
    assert rows(t["clean_module_presentation"]) == [("AAA", "2013J", 268), ("BBB", "2014B", 240)]
    assert rows(t["clean_vle_resource"].select("code_module", "week_from", "week_to")) == [
        ("AAA", 1, 3), ("AAA", None, None), ("BBB", None, None),
    ]


def test_student_engagement(ok):
    got = rows(
        analytics.student_engagement(ok).select(
            "id_student", "code_module", "total_clicks", "active_days", "resources_used", "assessment_submissions",
            "average_score",
        )
    )
    assert got == [
        (1, "AAA", 23, 5, 2, 2, D("74.00")),
        (1, "BBB", 8, 2, 1, 1, D("40.00")),
        (2, "AAA", 32, 3, 2, 2, D("92.50")),
        (3, "AAA", 11, 2, 1, 1, None),  # a missing score only
        (3, "BBB", 11, 3, 1, 1, D("61.00")),
        (4, "BBB", 0, 0, 0, 1, D("55.00")),  # never clicked
    ]


def test_completion(ok):
    got = rows(analytics.completion_by_presentation(ok).drop("code_presentation"))
    assert got == [("AAA", 3, 1, 1, 0, 1, 2, D("66.67")), ("BBB", 3, 0, 1, 2, 0, 1, D("33.33"))]


def test_performance(ok):
    got = rows(analytics.assessment_performance(ok).drop("code_presentation"))
    assert got == [
        ("AAA", "Exam", 2, 0, D("80.00"), D("0.00")),
        ("AAA", "TMA", 3, 1, D("86.50"), D("0.00")),
        ("BBB", "CMA", 3, 0, D("52.00"), D("33.33")),
    ]


def test_performance_without_submissions(ok):
    none = {**ok, "clean_student_assessment": ok["clean_student_assessment"].where("id_assessment = 10")}
    left = rows(analytics.assessment_performance(none).drop("code_presentation"))
    assert left[0] == ("AAA", "Exam", 0, 0, None, None) and len(left) == 3
    inner = rows(analytics.assessment_performance(none, "inner").drop("code_presentation"))
    assert inner == [("AAA", "TMA", 3, 1, D("86.50"), D("0.00"))]


def test_engagement_by_result_means_of_rounded_means(ok):
    got = {r.final_result: r for r in analytics.engagement_by_result(analytics.student_engagement(ok)).collect()}
    fail = got["Fail"]  # students 1 (BBB) and 4: the one without clicks counts as zero
    assert (fail.registrations, fail.average_total_clicks, fail.average_score) == (2, D("4.00"), D("47.50"))
    assert got["Withdrawn"].average_score is None
    assert got["Pass"].average_score == D("67.50")


def test_click_aggregates(ok):
    out = analytics.click_log_aggregates(ok["clean_student_vle_interaction"])
    student = {(r.code_module, r.id_student): tuple(r)[3:] for r in out["student_engagement_summary"].collect()}
    assert student["AAA", 1] == (23, 5, 2, -10, 14) and ("BBB", 4) not in student
    site = {r.id_site: (r.total_clicks, r.distinct_students) for r in out["resource_popularity"].collect()}
    assert site == {100: (29, 3), 101: (37, 2), 200: (19, 2)}
    trend = rows(analytics.presentation_trend(out["weekly_engagement_trend"], "AAA", "2013J").drop("code_module", "code_presentation"))
    assert trend == [(-1, 2, 1), (-2, 3, 1), (0, 32, 3), (1, 27, 3), (2, 2, 1)]


def test_availability(ok):
    got = rows(analytics.resource_availability(ok).drop("code_presentation"))
    assert got == [("AAA", "page", 1, 1, None, None), ("AAA", "quiz", 1, 0, 1, 3), ("BBB", "page", 1, 1, None, None)]


def test_empty_tables(spark, ok):
    empty = {name: df.limit(0) for name, df in ok.items()}
    for df in analytics.build_analytics(empty).values():
        assert df.count() == 0
    assert all(v == 0 for v in one(profiling.missing_values(empty, "stg_student_info")).values())


def test_rules_hold_on_good_data(ok):
    tables = {**ok, **analytics.build_analytics(ok)}
    report = rule_report(tables, clean.CLEAN_RULES | analytics.ANALYTICS_RULES)
    assert report.where("violations > 0").collect() == []
    assert report.count() == sum(len(r) for r in (clean.CLEAN_RULES | analytics.ANALYTICS_RULES).values())


def test_each_broken_rule_is_counted(spark, tmp_path):
    t = load(spark, tmp_path, raw_files.BAD)
    broken = {(r.table_name, r.rule): r.violations for r in rule_report(t, clean.CLEAN_RULES).where("violations > 0").collect()}
    assert broken == {
        ("clean_module_presentation", "length above zero"): 1,
        ("clean_student", "known gender"): 1,
        ("clean_student", "known disability flag"): 1,
        ("clean_student", "known deprivation band"): 1,
        ("clean_registration", "known age band"): 1,
        ("clean_registration", "attempts not negative"): 1,
        ("clean_registration", "credits above zero"): 1,
        ("clean_registration", "known result"): 1,
        ("clean_registration", "unregistered after registering"): 1,
        ("clean_assessment", "unique: id_assessment"): 1,
        ("clean_assessment", "reference: code_module, code_presentation in clean_module_presentation"): 1,
        ("clean_assessment", "known assessment type"): 1,
        ("clean_assessment", "weight within 0 to 100"): 1,
        ("clean_vle_resource", "weeks both missing or in order"): 2,
        ("clean_student_assessment", "unique: id_assessment, id_student"): 1,
        ("clean_student_assessment", "banked flag 0 or 1"): 2,
        ("clean_student_assessment", "score within 0 to 100"): 1,
        ("clean_student_assessment",
         "reference: id_student, code_module, code_presentation in clean_registration"): 1,
        ("clean_student_vle_interaction",
         "reference: id_student, code_module, code_presentation in clean_registration"): 1,
        ("clean_student_vle_interaction",
         "reference: id_site, code_module, code_presentation in clean_vle_resource"): 1,
        ("clean_student_vle_interaction", "clicks above zero"): 1,
    }


ROWS = {
    "stg_courses": 2, "stg_assessments": 3, "stg_vle": 3, "stg_student_info": 6, "stg_student_registration": 6,
    "stg_student_assessment": 8, "stg_student_vle": 20, "clean_module_presentation": 2, "clean_student": 4,
    "clean_registration": 6, "clean_assessment": 3, "clean_vle_resource": 3, "clean_student_assessment": 8,
    "clean_student_vle_interaction": 16, "analytics_student_engagement": 6, "analytics_completion_by_presentation": 2,
    "analytics_assessment_performance": 3, "analytics_engagement_by_result": 4,
}


def test_quality_report_has_31_exact_and_7_info_lines(spark, ok):
    tables = {**ok, **analytics.build_analytics(ok)}
    report = quality.full_report(tables, quality.expected_rows(spark, ROWS))
    status = [r.status for r in report.orderBy("check_order").collect()]
    assert len(status) == 38 and status.count("PASS") == 31 and status.count("INFO") == 7
    observed = {(r.table_name, r.check_name): r.observed_value for r in report.collect()}
    assert observed["stg_assessments", "missing assessment dates"] == "1"
    assert observed["stg_vle", "resources with both week fields missing"] == "2"
    assert observed["stg_student_info", "nonstandard 10-20 IMD labels"] == "1"
    assert observed["clean_student_vle_interaction", quality.CONSOLIDATED_ROWS] == "4"


def test_quality_report_fails_on_wrong_counts(spark, ok):
    tables = {**ok, **analytics.build_analytics(ok)}
    report = quality.full_report(tables, quality.expected_rows(spark, ROWS | {"clean_student": 5}))
    (failed,) = report.where("status = 'FAIL'").collect()
    assert (failed.table_name, failed.observed_value, failed.expectation) == ("clean_student", "4", "Exactly 5")


def test_gates(spark, ok, tmp_path):
    quality.check_clean_layer(ok)
    tables = {**ok, **analytics.build_analytics(ok)}
    quality.check_analytics_layer(tables, quality.expected_rows(spark, ROWS))
    with pytest.raises(QualityError, match="interactions without registration is 1"):
        quality.check_clean_layer(load(spark, tmp_path, raw_files.BAD))


def test_raw_profiles(ok):
    assert one(profiling.week_pairs(ok)) == {
        "both_weeks_missing": 2, "only_week_from_missing": 0, "only_week_to_missing": 0,
    }
    assert one(profiling.registration_ranges(ok))["latest_unregistration_day"] == 100
    assert rows(profiling.late_results(ok).select("id_student", "days_after_module_end"), "id_student") == [("2", 2), ("4", 10)]
    assert one(profiling.lateness(ok, by_type=False)) == {"late_submission_records": 2, "maximum_days_after_end": 10}
    assert one(profiling.registration_mismatches(ok)) == {
        "registrations_without_student_info": 0, "student_info_without_registration": 0,
    }
    assert rows(profiling.repeated_keys(ok, "stg_student_vle").select("id_student", "date")) == [
        ("1", "0"), ("2", "-3"), ("3", "0"), ("3", "6"),
    ]


def test_consistency_and_histories(spark, tmp_path):
    t = load(spark, tmp_path, raw_files.INCONSISTENT)
    assert one(profiling.student_consistency(t)) == {
        "inconsistent_gender": 0, "inconsistent_region": 0, "inconsistent_highest_education": 0,
        "inconsistent_imd_band": 1, "inconsistent_age_band": 1, "inconsistent_disability": 0,
    }
    assert rows(profiling.age_band_histories(t)) == [("1", "0-35, 35-55", "AAA-2013J: 0-35 | BBB-2013J: 35-55")]
    # the greatest band wins in the clean table, the first record's band in the picked dimension
    assert t["clean_student"].where("id_student = 1").first().imd_band == "30-40%"
    picked = marts.dim_student_picked(t["stg_student_info"]).where("id_student = 1").first()
    assert (picked.age_band, picked.imd_band) == ("0-35", "10-20")


def test_run_writes_all_layers_and_log(spark, tmp_path):
    out = tmp_path / "out"
    job = workflow.run(spark, raw_files.write(tmp_path / "raw"), str(out), ROWS)
    assert one(job.audit_engagement_mart()) == {
        "unmatched_students": 0, "unmatched_module_presentations": 0, "unmatched_age_bands": 0, "unmatched_outcomes": 0,
    }
    fact = job.tables["engagement_mart.fact_learning_engagement"]
    assert [r[0] for r in rows(fact.select("engagement_fact_key"), "engagement_fact_key")] == [1, 2, 3, 4, 5, 6]
    assert job.tables["click_mart.fact_student_vle"].count() == 20
    assert job.tables["click_mart.dim_date"].count() == 451
    delays = job.tables["click_mart.fact_student_assessment"].select("submission_delay_days").collect()
    assert sorted(r[0] for r in delays if r[0] is not None) == [-2, -2, -1, 0, 5, 220]
    clicks = job.tables["clean_student_vle_interaction"]
    trend = analytics.click_log_aggregates(clicks)["weekly_engagement_trend"]
    chosen = analytics.presentation_trend(trend, "BBB", "2014B")
    assert rows(chosen.select("presentation_week", "total_clicks")) == [(-1, 2), (0, 12), (1, 4), (2, 1)]
    plan = chosen._jdf.queryExecution().executedPlan().toString()
    assert "code_presentation#" in plan[plan.index("PartitionFilters"):]  # only that presentation's files are read
    log = spark.read.parquet(job.log)
    assert log.where("pipeline_stage = 'staging_load' AND status = 'SUCCESS'").count() == 7
    assert (out / "aggregates/weekly_engagement_trend/csv").is_dir() and not (out / "restricted").exists()


def test_run_without_given_counts_reconciles_with_its_sources(spark, tmp_path):
    job = workflow.Run(spark, raw_files.write(tmp_path / "raw"), str(tmp_path / "out"))
    job.stage()
    job.clean()
    job.analyse()
    text = job.report()
    # 10 checks for zero, 7 tables as long as their source, 2 registration totals; the other 12 counts inform
    assert "Overall: **PASS** (19 passed, 0 failed, 19 informational)" in text


def test_run_stops_at_wrong_count(spark, tmp_path):
    with pytest.raises(CountMismatch):
        workflow.run(spark, raw_files.write(tmp_path / "raw"), str(tmp_path / "out"), ROWS | {"stg_vle": 99})
    log = spark.read.parquet(str(tmp_path / "out/ops/etl_run_log"))
    assert [r.target_table for r in log.where("status = 'FAILED'").collect()] == ["stg_vle"]


def test_run_stops_at_bad_header(spark, tmp_path):
    with pytest.raises(QualityError, match="vle.csv: MISSING"):
        workflow.run(spark, raw_files.write(tmp_path / "raw", {"vle.csv": None}), str(tmp_path / "out"))


# Changes to the good files that break one rule each, and what the run says about it.
BROKEN = {
    "malformed row": ({"vle.csv": [*raw_files.OK["vle.csv"], "300,AAA,2013J,page"]}, "malformed rows is 1"),
    "unparsable number": ({"studentAssessment.csv": [*raw_files.OK["studentAssessment.csv"][1:], "10,1,18,0,abc"]}, "unparsable score is 1"),
    "blank key": ({"studentVle.csv": [*raw_files.OK["studentVle.csv"], " ,2013J,1,100,0,2"]}, "missing presentation keys is 1"),
    "null": ({"studentInfo.csv": [x.replace("4,M,Wales", "4,,Wales") for x in raw_files.OK["studentInfo.csv"]]}, "not null"),
    "check": ({"studentInfo.csv": ["AAA,2013J,1,X,Wales,A Level,?,0-35,0,60,N,Pass", *raw_files.OK["studentInfo.csv"][1:]]}, "known gender"),
    "unique": ({"studentAssessment.csv": [*raw_files.OK["studentAssessment.csv"], "10,1,19,0,70"]}, "unique: id_assessment, id_student"),
    "reference": ({"studentAssessment.csv": [*raw_files.OK["studentAssessment.csv"], "10,9,19,0,70"]}, "in clean_registration"),
    "unknown resource": ({"studentVle.csv": [*raw_files.OK["studentVle.csv"], "AAA,2013J,1,999,0,2"]}, "interactions without contextual resource is 1"),
}


@pytest.mark.parametrize("case", BROKEN)
def test_a_bad_row_stops_the_run_before_analytics(spark, tmp_path, case):
    changes, message = BROKEN[case]
    with pytest.raises(QualityError, match=message):
        workflow.run(spark, raw_files.write(tmp_path / "raw", changes), str(tmp_path / "out"))
    assert not (tmp_path / "out/analytics").exists() and not (tmp_path / "out/engagement_mart").exists()
    exported = spark.read.option("header", True).csv(str(tmp_path / "out/ops/run_log_csv"))
    assert exported.count() == spark.read.parquet(str(tmp_path / "out/ops/etl_run_log")).count() >= 7


def test_run_leaves_reports_and_the_whole_log(spark, tmp_path):
    out = tmp_path / "out"
    workflow.run(spark, raw_files.write(tmp_path / "raw"), str(out), ROWS)
    text = (out / "ops/data_quality_summary.md").read_text()
    assert "Overall: **PASS** (31 passed, 0 failed, 7 informational)" in text and text.count("\n| ") == 39
    exported = spark.read.option("header", True).csv(str(out / "ops/run_log_csv"))
    assert exported.where("pipeline_stage = 'mart_build'").count() == 13 and exported.count() == 31
    facts = {r.col_name: r.data_type for r in spark.sql("DESCRIBE EXTENDED tallyframe_clean_registration").collect()}
    assert "6 rows" in facts["Statistics"]
    assert spark.sql("DESCRIBE EXTENDED tallyframe_clean_registration id_student").where("info_name = 'distinct_count'").first().info_value == "4"
    differences = read_table(spark, str(out / "ops/mart_rows"))
    assert rows(differences.select("fact_rows", "difference")) == [(20, 0), (6, 0), (6, 0), (8, 0)]


def test_lost_fact_rows_stop_the_run(spark, tmp_path):
    """An assessment that is in two presentations of the raw files, but not of the clean ones."""
    job = workflow.Run(spark, raw_files.write(tmp_path / "raw"), str(tmp_path / "out"))
    job.stage()
    job.clean()
    job.analyse()
    job.build_marts()
    job.check_marts()
    name = "click_mart.fact_student_vle"
    job.tables[name] = job.tables[name].limit(18)
    with pytest.raises(QualityError, match="fact_student_vle: -2 rows"):
        job.check_marts()
