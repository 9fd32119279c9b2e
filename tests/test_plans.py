"""Physical plans: what is read, shuffled and broadcast."""

import re

import pytest
from pyspark.sql import functions as F

from tallyframe.operators import aggregates as agg
from tallyframe.operators.joins import orphan_counts, star_lookup
from tallyframe.operators.ordering import first_per_key, surrogate_key, top_k
from tallyframe.plans import analytics
from tallyframe.schemas import REGISTRATION_KEY
from tallyframe.session import materialise
from workload.tables import layers, table

SF = "/root/testdata/sf0.001"


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.fixture(scope="module")
def clean(spark):
    t = layers(spark, SF)
    names = ("clean_registration", "clean_assessment", "clean_student_assessment", "clean_student_vle_interaction")
    return {n: materialise(t[n], n) for n in names}


@pytest.fixture()
def no_broadcast(spark):
    """Plans as for tables too large to broadcast."""
    old = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    yield
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", old)


def test_engagement_mart_joins_reuse_the_partitioning_of_the_totals(clean, no_broadcast):
    text = plan(analytics.student_engagement(clean))
    exchanges = re.findall(r"Exchange (\S+?)\(", text)
    # registrations once; clicks per distinct pair and per key; marks per key
    assert exchanges == ["hashpartitioning"] * 4
    assert text.count("SortMergeJoin") == 2


def test_performance_joins_totals_not_results(clean, no_broadcast):
    text = plan(analytics.assessment_performance(clean))
    join = text[text.index("SortMergeJoin"):]
    assert "HashAggregate(keys=[id_assessment" in join


def test_orphan_count_joins_one_row_per_key(clean, no_broadcast):
    text = plan(orphan_counts(clean["clean_student_vle_interaction"], clean["clean_registration"], REGISTRATION_KEY))
    join = text[text.index("LeftAnti"):]
    assert "partial_count(1)" in join


def test_first_per_key_is_limited_before_the_shuffle(spark):
    text = plan(first_per_key(table(spark, SF, "orders").select("o_custkey", "o_orderdate"), ["o_custkey"], ["o_orderdate"]))
    assert re.search(r"Exchange hashpartitioning\(o_custkey.*\n.*WindowGroupLimit.*Partial", text)


def test_top_k_sorts_no_whole_table(spark):
    assert "TakeOrderedAndProject" in plan(top_k(table(spark, SF, "orders"), 5, F.desc("o_totalprice")))


def test_dense_keys_use_no_global_window_over_the_rows(spark):
    keyed = surrogate_key(table(spark, SF, "customer").select("c_custkey"), "k", ["c_custkey"])
    text = plan(keyed)
    (single,) = re.findall(r"Exchange SinglePartition.*\n(.*\n)", text)  # slice totals only
    assert "_slice" in single and "c_custkey" not in single


def test_filters_and_columns_reach_the_scan(spark):
    lines = table(spark, SF, "lineitem").where("l_quantity > 45")
    text = plan(agg.conditional_counts(lines, ["l_returnflag"], {"n": F.col("l_tax") > 0}))
    assert "PushedFilters: [IsNotNull(l_quantity), GreaterThan(l_quantity,45.0)]" in text
    assert "ReadSchema: struct<l_quantity:double,l_tax:double,l_returnflag:string>" in text


def test_hot_key_of_a_lookup_is_split_at_run_time(spark, no_broadcast):
    """A third of the fact rows share one student; the join splits that partition."""
    settings = {
        "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "32KB",
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": "32KB",
        "spark.sql.adaptive.coalescePartitions.enabled": "false",
        "spark.sql.shuffle.partitions": "64",
    }
    old = {k: spark.conf.get(k) for k in settings}
    for k, v in settings.items():
        spark.conf.set(k, v)
    try:
        clicks = spark.range(0, 300000, 1, 16).select(
            F.when(F.col("id") % 3 == 0, 7).otherwise(F.col("id") % 5000).alias("id_student"), F.col("id").alias("clicks")
        )
        dim = spark.range(5000).select(F.col("id").alias("id_student"), (F.col("id") + 1).alias("student_key"))
        fact = star_lookup(clicks, [(dim, ["id_student"], "student_key")])
        assert fact.count() == 300000
        fact.collect()
        assert "skew=true" in plan(fact)
    finally:
        for k, v in old.items():
            spark.conf.set(k, v)
