from decimal import Decimal

import pytest
from conftest import one, rows
from pyspark.sql import functions as F

from tallyframe import functions as tf


def test_markers_blanks_and_nulls_are_missing(spark):
    df = spark.createDataFrame([(" ? ",), ("",), ("  ",), (None,), (" x ",)], "a string")
    out = rows(df.select(tf.null_markers("a"), tf.is_missing("a"), tf.is_present("a")))
    assert out.count((None, True, False)) == 4
    assert out.count(("x", False, True)) == 1


def test_casts_give_null_for_junk(spark):
    df = spark.createDataFrame([("12",), (" -3 ",), ("1x",), ("?",), ("12.345",)], "a string")
    out = [tuple(r) for r in df.select(tf.to_int("a"), tf.to_decimal("a")).collect()]
    assert out[0] == (12, Decimal("12.00")) and out[1] == (-3, Decimal("-3.00"))
    assert out[2] == (None, None) and out[3] == (None, None)
    assert out[4][1] == Decimal("12.35")


def test_labels(spark):
    df = spark.createDataFrame([("10-20 ",), ("?",), ("20-30%",)], "a string")
    assert [r[0] for r in df.select(tf.standardise("a", {"10-20": "10-20%"})).collect()] == ["10-20%", None, "20-30%"]


def test_format_is_case_sensitive_unless_asked(spark):
    df = spark.createDataFrame([("AAA",), ("aaa",), (" BBB ",)], "a string")
    assert [r[0] for r in df.select(tf.bad_format("a", "^[A-Z]{3}$")).collect()] == [False, True, False]
    assert [r[0] for r in df.select(tf.bad_format("a", "^[A-Z]{3}$", ignore_case=True)).collect()] == [False] * 3


@pytest.mark.parametrize("day,floor,trunc", [(-8, -2, -1), (-7, -1, -1), (-3, -1, 0), (0, 0, 0), (6, 0, 0), (7, 1, 1)])
def test_weeks_differ_before_the_start(spark, day, floor, trunc):
    df = spark.createDataFrame([(day,)], "d bigint")
    assert tuple(df.select(tf.week_floor("d"), tf.week_trunc("d")).first()) == (floor, trunc)


def test_halves_round_away_from_zero(spark):
    df = spark.createDataFrame([(1, 8), (-1, 8), (2675, 1000), (1, 0)], "a bigint, b bigint")
    out = [r[0] for r in df.select(tf.rounded_ratio(F.col("a"), F.col("b"))).collect()]
    assert out == [Decimal("0.13"), Decimal("-0.13"), Decimal("2.68"), None]


def test_mean_skips_nulls(spark):
    df = spark.createDataFrame([(1,), (2,), (None,)], "a bigint")
    assert one(df.agg(tf.rounded_mean("a").alias("m")))["m"] == Decimal("1.50")


def test_codes_and_parts(spark):
    df = spark.createDataFrame([("2013J", "a")], "p string, q string")
    got = df.select(
        tf.presentation_year("p"), tf.presentation_term("p"), tf.composite("q", "p"), tf.coded("q", {"a": 1}),
        tf.coded("p", {"a": 1}, 0), tf.composite("q", F.lit(None).cast("string")),
    ).first()
    assert tuple(got) == (2013, "J", "a-2013J", 1, 0, None)
