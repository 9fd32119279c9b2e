import pytest
import raw_files
from conftest import one, rows
from pyspark.sql import functions as F
from pyspark.sql.types import IntegerType, StringType, StructField, StructType

from tallyframe.schemas import SOURCE_BY_TABLE
from tallyframe.sinks import (
    export_run_log,
    log_run,
    logged_write,
    quality_markdown,
    refresh_statistics,
    replace_table,
    save_table,
    write_quality,
    write_tier,
)
from tallyframe.sinks.runlog import read_run_log
from tallyframe.sinks.tables import read_table
from tallyframe.operators import profile
from tallyframe.sources import (
    MALFORMED,
    CountMismatch,
    assert_counts,
    day_range,
    literal_rows,
    load_staging,
    preflight,
    preview,
    read_csv,
)


@pytest.mark.parametrize("newline,bom", [("\n", ""), ("\r\n", ""), ("\r\n", "﻿"), ("\n", "﻿")])
def test_staging_reads_line_ends_and_bom(spark, tmp_path, newline, bom):
    stg = load_staging(spark, raw_files.write(tmp_path, newline=newline, bom=bom))
    assert {n: df.count() for n, df in stg.items()} == {
        "stg_courses": 2, "stg_assessments": 3, "stg_vle": 3, "stg_student_info": 6,
        "stg_student_registration": 6, "stg_student_assessment": 8, "stg_student_vle": 20,
    }
    assert rows(stg["stg_courses"].drop(MALFORMED)) == [("AAA", "2013J", "268"), ("BBB", "2014B", "240")]
    assert all(f.dataType == StringType() for df in stg.values() for f in df.schema)
    assert all(r[MALFORMED] is None for df in stg.values() for r in df.collect())


def test_quoted_comma(spark, tmp_path):
    stg = load_staging(spark, raw_files.write(tmp_path, raw_files.DIRTY))
    assert stg["stg_vle"].where("id_site = '100'").first().activity_type == "page, long"


def test_typed_csv_turns_markers_into_null(spark, tmp_path):
    path = raw_files.write(tmp_path)
    schema = StructType(
        [StructField(c, IntegerType() if c in ("id_assessment", "date") else StringType())
         for c in SOURCE_BY_TABLE["stg_assessments"].columns]
    )
    df = read_csv(spark, f"{path}/assessments.csv", schema, null_columns=["date"])
    assert rows(df.select("id_assessment", "date")) == [(10, 20), (11, None), (12, 30)]


def test_preflight(spark, tmp_path):
    folder = tmp_path / "raw"
    raw_files.write(folder, {"vle.csv": None})
    (folder / "courses.csv").write_text("code_presentation,code_module,module_presentation_length\n1,2,3\n")
    (folder / "assessments.csv").write_text(raw_files.HEADERS["assessments.csv"] + ",extra\n")
    report = {r.file: r for r in preflight(spark, str(folder)).collect()}
    assert report["vle.csv"].status == "MISSING" and report["vle.csv"].bytes is None
    assert report["courses.csv"].status == "INVALID COLUMNS"
    assert report["assessments.csv"].status == "INVALID COLUMNS"
    assert report["studentVle.csv"].status == "OK"
    assert report["studentVle.csv"].bytes == (folder / "studentVle.csv").stat().st_size


def test_preflight_accepts_folders_of_parts(spark, tmp_path):
    stg = load_staging(spark, raw_files.write(tmp_path / "raw"))
    parts = str(tmp_path / "parts")
    for name, source in SOURCE_BY_TABLE.items():
        stg[name].drop(MALFORMED).repartition(2).write.option("header", True).csv(f"{parts}/{source.filename}")
    assert {r.status for r in preflight(spark, parts).collect()} == {"OK"}


def test_preflight_finds_one_wrong_header_among_many_parts(spark, tmp_path):
    raw_files.write(tmp_path / "raw")
    folder = tmp_path / "raw" / "vle.csv"
    lines = folder.read_text()
    folder.unlink()
    folder.mkdir()
    for k in range(60):
        (folder / f"part-{k:03}.csv").write_text(lines)
    (folder / "part-empty.csv").write_text("")
    status = lambda: {r.file: (r.status, r.found) for r in preflight(spark, str(tmp_path / "raw")).collect()}
    assert status()["vle.csv"][0] == "OK"
    header, *rest = lines.split("\n")
    names = header.split(",")
    swapped = ",".join([names[1], names[0], *names[2:]])
    (folder / "part-041.csv").write_text("\n".join([swapped, *rest]))
    assert status()["vle.csv"] == ("INVALID COLUMNS", swapped)


def test_count_gate(spark, tmp_path):
    stg = load_staging(spark, raw_files.write(tmp_path))
    assert assert_counts(stg, {"stg_courses": 2}) == {"stg_courses": 2}
    with pytest.raises(CountMismatch, match="stg_courses: 2 rows where 22 were due"):
        assert_counts(stg, {"stg_courses": 22, "stg_vle": 3})


def test_generated_rows_and_preview(spark):
    days = day_range(spark, -150, 300)
    assert one(days.agg(F.count("*").alias("n"), F.min("day").alias("a"), F.max("day").alias("b"))) == {
        "n": 451, "a": -150, "b": 300,
    }
    assert rows(preview(literal_rows(spark, [(2, "b"), (1, "a")], "k int, v string"), 1, ["k"])) == [(1, "a")]


def test_replace_table_counts_and_replaces(spark, tmp_path):
    path = str(tmp_path / "t")
    assert replace_table(spark.range(7), path) == 7
    assert replace_table(spark.range(3), path) == 3
    assert read_table(spark, path).count() == 3


def test_partitioned_table_keeps_columns_and_rows(spark, tmp_path):
    path, df = str(tmp_path / "t"), spark.range(10).selectExpr("CAST(id % 2 AS STRING) AS k", "id")
    assert replace_table(df, path, ["k"]) == 10
    back = read_table(spark, path, df.schema)
    assert back.columns == ["k", "id"] and rows(back) == rows(df)
    assert len(list((tmp_path / "t").glob("version-00000001/k=*"))) == 2


def test_failed_replace_leaves_the_published_table(spark, tmp_path):
    path = str(tmp_path / "t")
    assert replace_table(spark.range(3), path, expected_rows=3) == 3
    reader = read_table(spark, path)
    with pytest.raises(CountMismatch, match="wrote 1 rows where 3 were due"):
        replace_table(spark.range(1), path, expected_rows=3)
    with pytest.raises(Exception, match="no such row"):
        replace_table(spark.range(5).select(F.raise_error(F.lit("no such row")).cast("bigint").alias("id")), path)
    assert read_table(spark, path).count() == 3 and not list((tmp_path / "t").glob(".pending-*"))
    replace_table(spark.range(9), path)
    assert reader.count() == 3 and read_table(spark, path).count() == 9  # a reader keeps its version
    replace_table(spark.range(10), path)
    assert [p.name for p in sorted((tmp_path / "t").glob("version-*"))] == ["version-00000002", "version-00000003"]


def test_doubled_quotes_and_malformed_rows(spark, tmp_path):
    lines = ['1,AAA,2013J,"A ""x"", y",,', "2,AAA,2013J,page,,,surplus", "3,AAA,2013J", "4,BBB,2014B,quiz,1,2"]
    folder = raw_files.write(tmp_path, {"vle.csv": lines})
    vle = load_staging(spark, folder)["stg_vle"]
    got = {r.id_site: (r.activity_type, r[MALFORMED]) for r in vle.collect()}
    assert got["1"] == ('A "x", y', None) and got["4"] == ("quiz", None)
    assert got["2"][1] == lines[1] and got["3"][1] == lines[2]
    with pytest.raises(Exception, match="(?i)malformed"):
        read_csv(spark, f"{folder}/vle.csv", SOURCE_BY_TABLE["stg_vle"].text_schema).collect()


def test_line_end_inside_quotes(spark, tmp_path):
    folder = raw_files.write(tmp_path, {"vle.csv": ['1,AAA,2013J,"two\nlines",,']})
    schema = SOURCE_BY_TABLE["stg_vle"].text_schema
    assert [r.activity_type for r in read_csv(spark, f"{folder}/vle.csv", schema, multi_line=True).collect()] == ["two\nlines"]
    assert sum(r[MALFORMED] is not None for r in load_staging(spark, folder)["stg_vle"].collect()) == 2


def test_every_part_needs_the_header(spark, tmp_path):
    folder = tmp_path / "raw"
    raw_files.write(folder, {"courses.csv": None})
    parts = folder / "courses.csv"
    parts.mkdir()
    (parts / "part-0.csv").write_text(raw_files.HEADERS["courses.csv"] + "\nAAA,2013J,268\n")
    (parts / "part-1.csv").write_text("code_presentation,code_module,module_presentation_length\n2014B,BBB,240\n")
    report = {r.file: r for r in preflight(spark, str(folder)).collect()}["courses.csv"]
    assert report.status == "INVALID COLUMNS" and report.found.startswith("code_presentation")
    with pytest.raises(Exception, match="(?i)header"):
        load_staging(spark, str(folder))["stg_courses"].collect()
    assert {r.status for r in preflight(spark, str(tmp_path / "none")).collect()} == {"MISSING"}


def test_unparsable_values_are_counted(spark):
    df = literal_rows(spark, [("abc", "1"), ("78.5", "?"), (" 7 ", None), ("", "2.5")], "score string, weight string")
    assert rows(profile.unparsable(df, {"score": "bigint", "weight": "decimal(5,2)"})) == [("score", 2), ("weight", 0)]


def test_literal_rows_are_small_to_the_planner(spark):
    few = literal_rows(spark, [(1, None), (2, "b")], "id bigint, v string")
    assert rows(few) == [(1, None), (2, "b")]
    joined = spark.range(10).join(few, "id", "left")
    assert "BroadcastHashJoin" in joined._jdf.queryExecution().executedPlan().toString()
    assert literal_rows(spark, [], "id bigint").count() == 0


def test_tiers_keep_both_formats(spark, tmp_path):
    assert write_tier(spark.range(3), str(tmp_path), "aggregates", "x") == 3
    assert read_table(spark, str(tmp_path / "aggregates/x/parquet")).count() == 3
    assert spark.read.option("header", True).csv(str(tmp_path / "aggregates/x/csv")).columns == ["id"]
    with pytest.raises(ValueError):
        write_tier(spark.range(3), str(tmp_path), "public", "x")


def test_run_log(spark, tmp_path):
    log, out = str(tmp_path / "log"), str(tmp_path / "out")
    df = logged_write(spark, lambda: spark.range(4), str(tmp_path / "t"), log, "clean_transform", "t", expected_rows=4)
    assert df.count() == 4
    with pytest.raises(CountMismatch):
        logged_write(spark, lambda: spark.range(4), str(tmp_path / "u"), log, "clean_transform", "u", expected_rows=5)
    log_run(spark, log, "staging_load", "v", 1, 0.5, "SUCCESS", "m" * 600, source="v.csv")
    stored = rows(read_run_log(spark, log).select("log_id", "target_table", "row_count", "status"), "log_id")
    assert stored == [(1, "t", 4, "SUCCESS"), (2, "u", 4, "FAILED"), (3, "v", 1, "SUCCESS")]
    assert read_run_log(spark, log).where("log_id = 3").first().message == "m" * 600
    assert read_run_log(spark, log).select("run_id").distinct().count() == 1
    export_run_log(spark, log, out)
    exported = spark.read.option("header", True).csv(out)
    assert exported.columns[0] == "log_id" and [r.log_id for r in exported.collect()] == ["1", "2", "3"]


def test_quality_outputs(spark, tmp_path):
    report = literal_rows(
        spark,
        [(2, "clean", "t", "b|c", "3", "Exactly 2", "FAIL", "why"), (1, "staging", "t", "a", "0", "Exactly 0", "PASS", "ok")],
        "check_order int, layer string, table_name string, check_name string, observed_value string,"
        " expectation string, status string, interpretation string",
    )
    stored = write_quality(report, str(tmp_path))
    assert rows(stored.select("result_id", "status"), "result_id") == [(1, "PASS"), (2, "FAIL")]
    text = quality_markdown(stored)
    assert "Overall: **FAIL** (1 passed, 1 failed, 0 informational)" in text
    assert "| clean | t | b\\|c | 3 | Exactly 2 | FAIL | why |" in text
    (part,) = (tmp_path / "data_quality_report_csv").glob("*.csv")
    lines = part.read_bytes().decode("utf-8").splitlines()
    assert lines[0].startswith("﻿layer,table_name") and lines[1].startswith("staging,t,a,0")


def test_saved_table_statistics(spark):
    save_table(spark.range(100).withColumn("k", F.col("id") % 3), "stat_demo", bucket_by=["k"], buckets=2)
    refresh_statistics(spark, "stat_demo")
    info = {r.col_name: r.data_type for r in spark.sql("DESCRIBE EXTENDED stat_demo").collect()}
    assert "100 rows" in info["Statistics"]
    joined = spark.table("stat_demo").hint("merge").join(spark.table("stat_demo").select("k").distinct(), "k")
    assert "Exchange hashpartitioning(k" not in joined._jdf.queryExecution().executedPlan().toString()
    spark.sql("DROP TABLE stat_demo")
