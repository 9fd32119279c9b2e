"""The whole workflow over a folder of raw CSV files.

    python -m tallyframe.plans.workflow DATA_DIR OUT_DIR [--full-data]

Each table is written once and read back, so later steps never recompute it and
their joins are planned from real sizes.
"""

from __future__ import annotations

import argparse
from collections.abc import Callable, Mapping
from dataclasses import dataclass, field

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession

from tallyframe.operators.joins import star_audit
from tallyframe.operators.quality import QualityError, gate, rule_report
from tallyframe.plans import analytics, clean, marts, quality
from tallyframe.schemas import FULL_DATA_ROWS, PRESENTATION_KEY, SOURCES
from tallyframe.session import build_session, release
from tallyframe.sinks import (
    Clustering,
    analysed_table,
    buckets_for,
    export_run_log,
    logged_write,
    quality_markdown,
    read_table,
    replace_table,
    write_quality,
    write_text,
    write_tier,
)
from tallyframe.sinks.runlog import read_run_log
from tallyframe.sources import load_staging, preflight


# The click table is stored by presentation, so that reports on one read only its files, and inside that
# clustered by student, so that no grouping by student, or by student and more, shuffles it. All rows of a
# student lie in one bucket: they are at most one for each resource and day of the student's presentations.
PARTITIONED = {"clean_student_vle_interaction": PRESENTATION_KEY}
CLUSTERED = {"clean_student_vle_interaction": ("id_student",)}
SORTED = {"clean_student_vle_interaction": ("id_student", "id_site")}
SOURCE_OF = {"clean_student_vle_interaction": "stg_student_vle"}


# Tables that have one row for each row of their source.
SAME_ROWS = {
    "clean_module_presentation": "stg_courses",
    "clean_registration": "stg_student_info",
    "clean_assessment": "stg_assessments",
    "clean_vle_resource": "stg_vle",
    "clean_student_assessment": "stg_student_assessment",
    "analytics_student_engagement": "stg_student_info",
    "analytics_completion_by_presentation": "stg_courses",
}


@dataclass
class Run:
    spark: SparkSession
    data_dir: str
    out_dir: str
    expected: Mapping[str, int] = field(default_factory=dict)
    tables: dict[str, DataFrame] = field(default_factory=dict)

    @property
    def log(self) -> str:
        return f"{self.out_dir}/ops/etl_run_log"

    def logged(self) -> bool:
        try:
            return not read_run_log(self.spark, self.log).isEmpty()
        except AnalysisException as error:
            if error.getCondition() != "PATH_NOT_FOUND":
                raise
            return False

    def _write(
        self, layer: str, stage: str, name: str, plan: Callable[[], DataFrame], source: str | None = None
    ) -> None:
        path, cluster = f"{self.out_dir}/{layer}/{name}", None
        if name in CLUSTERED:
            buckets = buckets_for(self.spark, f"{self.out_dir}/staging/{SOURCE_OF[name]}")
            cluster = Clustering(CLUSTERED[name], buckets, SORTED[name])
        self.tables[name] = logged_write(
            self.spark, plan, path, self.log, stage, name, self.expected.get(name), source, PARTITIONED.get(name, ()), cluster
        )

    def stage(self) -> None:
        report = preflight(self.spark, self.data_dir).where("status <> 'OK'").collect()  # one row per file
        if report:
            raise QualityError("; ".join(f"{r.file}: {r.status}" for r in report))
        loaded = load_staging(self.spark, self.data_dir)
        for s in SOURCES:
            self._write("staging", "staging_load", s.table, lambda s=s: loaded[s.table], s.filename)
        path = f"{self.out_dir}/ops/intake"
        replace_table(quality.intake_report(self.tables), path)
        gate(read_table(self.spark, path))

    def clean(self) -> None:
        """Tables written so far are what the next ones are built from."""
        t = self.tables
        for name, plan in clean.clean_plans(t).items():
            self._write("clean", "clean_transform", name, plan)
            if name not in PARTITIONED:  # of the partitioned click table, the files tell the size
                t[name] = analysed_table(self.spark, f"tallyframe_{name}", f"{self.out_dir}/clean/{name}", t[name].schema)
        # One scan of the clicks serves the gate, the rules and the report.
        counted = self._count_rules("clean_rules", t, clean.CLEAN_RULES, {quality.CLICKS: quality.CLICK_COUNTS})
        quality.check_clean_layer(t, counted)
        quality.rules_gate(counted)

    def _count_rules(self, name: str, tables: Mapping[str, DataFrame], rules: Mapping, also: Mapping | None = None) -> DataFrame:
        """Store how often each rule is broken."""
        path = f"{self.out_dir}/ops/{name}"
        replace_table(rule_report(tables, rules, CLUSTERED, also), path)
        return read_table(self.spark, path)

    def _keep_rules(self, name: str, tables: Mapping[str, DataFrame], rules: Mapping) -> None:
        """Store how often each rule is broken, and stop if one is."""
        quality.rules_gate(self._count_rules(name, tables, rules))

    def analyse(self) -> None:
        """The bitmaps and click totals per registration are stored first; the engagement table joins them."""
        t = self.tables
        clicks, path = t["clean_student_vle_interaction"], f"{self.out_dir}/analytics/student_engagement_bitmaps"
        replace_table(analytics.engagement_bitmaps(clicks), path)
        bitmaps = read_table(self.spark, path)
        results = analytics.click_log_aggregates(clicks, bitmaps)
        for name, df in {**results, "presentation_engagement": analytics.presentation_engagement(bitmaps)}.items():
            write_tier(df, self.out_dir, "aggregates", name)
        totals = read_table(self.spark, f"{self.out_dir}/aggregates/student_engagement_summary/parquet")
        for name, plan in analytics.analytics_plans(t, totals).items():
            self._write("analytics", "analytics_build", name, plan)
        quality.check_analytics_layer(t, quality.expected_rows(self.spark, self.known_rows()))
        self._keep_rules("analytics_rules", t, analytics.ANALYTICS_RULES)

    def known_rows(self) -> Mapping[str, int]:
        """Expected counts as given, or else those that follow from the stored source table."""
        if self.expected:
            return self.expected
        return {name: self.tables[source].count() for name, source in SAME_ROWS.items()}

    def report(self) -> str:
        """Write the quality report as table, CSV and Markdown, and return the Markdown."""
        expectations = quality.expected_rows(self.spark, self.known_rows())
        counted = read_table(self.spark, f"{self.out_dir}/ops/clean_rules")
        stored = write_quality(quality.full_report(self.tables, expectations, counted), f"{self.out_dir}/ops")
        text = quality_markdown(stored)
        write_text(self.spark, f"{self.out_dir}/ops/data_quality_summary.md", text)
        gate(stored.withColumnRenamed("result_id", "check_order"))
        return text

    def build_marts(self) -> None:
        """Dimensions first: facts look their keys up in the stored tables."""
        t = self.tables
        mart, add = {}, lambda name, plan: self._mart("engagement_mart", mart, name, plan)
        add("dim_student", lambda: marts.dim_student(t["clean_student"]))
        add("dim_module_presentation", lambda: marts.dim_module_presentation(t["clean_module_presentation"]))
        add("dim_age_band", lambda: marts.dim_age_band(t["clean_registration"]))
        add("dim_outcome", lambda: marts.dim_outcome(t["clean_registration"]))
        engagement = t["analytics_student_engagement"]
        add(
            "fact_learning_engagement",
            lambda: marts.fact_learning_engagement(t["clean_registration"], engagement, mart),
        )

        click, put = {}, lambda name, plan: self._mart("click_mart", click, name, plan)
        put("dim_date", lambda: marts.dim_date(self.spark))
        put("dim_course", lambda: marts.dim_course(t["stg_courses"]))
        put("dim_student", lambda: marts.dim_student_picked(t["stg_student_info"]))
        put("dim_assessment", lambda: marts.dim_assessment(t["stg_assessments"], click["dim_course"]))
        put("dim_vle_material", lambda: marts.dim_vle_material(t["stg_vle"], click["dim_course"]))
        put("fact_student_enrollment", lambda: marts.fact_student_enrollment(t, click))
        put("fact_student_assessment", lambda: marts.fact_student_assessment(t, click))
        put("fact_student_vle", lambda: marts.fact_student_vle(t, click))

    def _mart(self, mart: str, tables: dict[str, DataFrame], name: str, plan: Callable[[], DataFrame]) -> None:
        path, label = f"{self.out_dir}/{mart}/{name}", f"{mart}.{name}"
        tables[name] = self.tables[label] = logged_write(self.spark, plan, path, self.log, "mart_build", label)

    def audit_engagement_mart(self) -> DataFrame:
        of = lambda name: self.tables[f"engagement_mart.{name}"]
        return star_audit(
            of("fact_learning_engagement"),
            [
                (of("dim_student"), "student_key", "unmatched_students"),
                (of("dim_module_presentation"), "module_presentation_key", "unmatched_module_presentations"),
                (of("dim_age_band"), "age_band_key", "unmatched_age_bands"),
                (of("dim_outcome"), "outcome_key", "unmatched_outcomes"),
            ],
        )

    def check_marts(self) -> None:
        """Stop if a fact lost or gained rows, a mart rule is broken, or a fact key meets no dimension."""
        path = f"{self.out_dir}/ops/mart_rows"
        replace_table(marts.row_differences(self.tables), path)
        wrong = read_table(self.spark, path).where("difference <> 0").orderBy("fact").collect()  # a row per fact
        if wrong:
            raise QualityError("; ".join(f"{r.fact}: {r.difference:+,} rows against its source" for r in wrong))
        mart = {n.partition(".")[2]: df for n, df in self.tables.items() if n.startswith("engagement_mart.")}
        self._keep_rules("mart_rules", mart, marts.ENGAGEMENT_MART_RULES)
        unmatched = {k: n for k, n in self.audit_engagement_mart().first().asDict().items() if n}
        if unmatched:
            raise QualityError(f"facts without dimension: {unmatched}")


def run(spark: SparkSession, data_dir: str, out_dir: str, expected: Mapping[str, int] | None = None) -> Run:
    """Run all stages. With ``expected`` (rows by table), each load must match it.

    A failed check stops the run before the next layer is built; the tables
    published so far, the report of the check and the run log remain.
    """
    job = Run(spark, data_dir, out_dir, expected or {})
    try:
        job.stage()
        job.clean()
        job.analyse()
        job.report()
        job.build_marts()
        job.check_marts()
    finally:  # the log is for failures too, once there is one
        if job.logged():
            export_run_log(spark, job.log, f"{out_dir}/ops/run_log_csv")
    return job


def main() -> None:
    parser = argparse.ArgumentParser(description=__doc__)
    parser.add_argument("data_dir")
    parser.add_argument("out_dir")
    parser.add_argument("--full-data", action="store_true", help="require the row counts of the full data set")
    args = parser.parse_args()
    spark = build_session()
    run(spark, args.data_dir, args.out_dir, FULL_DATA_ROWS if args.full_data else None)
    release(spark)


if __name__ == "__main__":
    main()
