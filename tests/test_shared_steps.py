"""Work that several tables share is done once, and tasks hold words of values in place of rows."""

from conftest import one, rows
from pyspark.sql import functions as F

import __spark_entry__ as entry
import workload.tables as derived
from tallyframe.operators import bitmaps
from tallyframe.operators.aggregates import engagement
from tallyframe.operators.ordering import surrogate_key
from workload.learning import expectations


def given(spark, root):
    """A few orders of two students, with lines, as the given tables have them."""
    spark.sql("SELECT 1L AS n_nationkey, 'X' AS n_name, 0L AS n_regionkey").write.parquet(f"{root}/nation.parquet")
    spark.sql("SELECT id AS c_custkey, 1L AS c_nationkey, 100.0D * id AS c_acctbal, 'S' AS c_mktsegment FROM range(1, 3)").write.parquet(f"{root}/customer.parquet")
    spark.sql(
        """SELECT id AS o_orderkey, id % 2 + 1 AS o_custkey, 'F' AS o_orderstatus, 1000.0D * id AS o_totalprice,
        TIMESTAMP '1996-03-01 00:00:00' AS o_orderdate, concat(id % 3 + 1, '-X') AS o_orderpriority FROM range(1, 9)"""
    ).write.parquet(f"{root}/orders.parquet")
    spark.sql(
        """SELECT id % 8 + 1 AS l_orderkey, id % 7 + 1 AS l_linenumber, element_at(array('A', 'N', 'R'), CAST(id % 3 + 1 AS INT)) AS l_returnflag,
        1.0D * (46 + id % 5) AS l_quantity, 0.01D * (id % 9) AS l_tax, 0.01D * (id % 10) AS l_discount FROM range(60)"""
    ).write.parquet(f"{root}/lineitem.parquet")
    return str(root)


def written(monkeypatch):
    labels = []
    store = derived.materialise
    monkeypatch.setattr(derived, "materialise", lambda df, label: labels.append(label) or store(df, label))
    return labels


def test_report_and_gates_join_lines_to_orders_once(spark, tmp_path, monkeypatch):
    labels, d = written(monkeypatch), given(spark, tmp_path)
    for name in ("quality_report", "clean_rules", "engagement_mart_rules", "count_gate"):
        labels.clear()
        entry.queries()[name](spark, d)
        assert labels.count("lines") == 1 and len(set(labels)) == len(labels), name


def test_expected_counts_leave_nulls_out(spark, tmp_path):
    d = given(spark, tmp_path)
    t = derived.layers(spark, d).also(
        {
            "_lines": lambda _: spark.sql(
                """SELECT * FROM VALUES (11L, 'A', 1, 5L, 2L), (11L, 'A', 1, 5L, 2L), (11L, null, 1, 5L, 3L), (11L, 'N', 2, null, 3L),
                (null, 'A', 3, 5L, 2L), (12L, 'A', null, 5L, null) AS v(context, l_returnflag, l_linenumber, id_student, day)"""
            )
        }
    )
    got = {(r.table_name, r.check_name): r.expected_value for r in expectations(t).collect()}
    assert {k: v for (k, check), v in got.items() if check == "source row-count reconciliation" and k[4:] in ("assessments", "vle", "student_assessment", "student_vle")} == {
        "stg_assessments": 3, "stg_vle": 2, "stg_student_assessment": 2, "stg_student_vle": 6,
    }
    assert got["clean_student_vle_interaction", "cleaned row-count reconciliation"] == 2


def test_flawed_tables_read_their_rows_once(spark, tmp_path):
    d = given(spark, tmp_path)
    good, bad = derived.staging(spark, d), derived.flawed(spark, d)
    plan = bad["stg_student_assessment"]._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("l_returnflag#") and plan.count("Relation [") == 2  # lines and orders
    each = good["stg_student_vle"]
    twice = each.where("sum_click = '50'").withColumns(
        {"id_student": F.concat(F.lit("-"), F.trim("id_student")), "id_site": F.concat("id_site", F.lit("9")), "sum_click": F.lit("0")}
    )
    undated = each.where("sum_click = '49'").withColumn("date", F.lit(None).cast("string"))
    assert twice.count() and undated.count()
    assert rows(bad["stg_student_vle"]) == rows(each.unionByName(twice).unionByName(undated))


def test_distinct_counts_keep_words_and_sort_no_rows(spark):
    values = [(g, (a * 7919 - 40_000) if a % 11 else None, a * a % 100_003) for g in (1, 2) for a in range(500)]
    df = spark.createDataFrame([*values, *values], "g bigint, a bigint, b bigint")
    got = bitmaps.distinct_counts(df, ["g"], {"a_values": "a", "b_values": "b"}, "n")
    assert "SortAggregate" not in got._jdf.queryExecution().executedPlan().toString()
    assert rows(got) == [
        (g, len({a for h, a, _ in values if h == g} - {None}), len({b for h, _, b in values if h == g}), 1000) for g in (1, 2)
    ]


def test_engagement_of_numbers_copies_no_rows(spark):
    values = [(s, 10 * ((s or 0) + i) % 700, (i * 37) % 300 - 150 if i % 5 else None, i) for s in (1, 2, None) for i in range(200)]
    df = spark.createDataFrame([*values, *values], "s bigint, site bigint, day bigint, clicks bigint")
    got = engagement(df, ["s"], "clicks", "day", "site")
    assert "Expand" not in got._jdf.queryExecution().optimizedPlan().toString()
    wanted = []
    for s in (1, 2, None):
        mine = [v for v in values if v[0] == s]
        days = {v[2] for v in mine} - {None}
        wanted.append((s, 2 * sum(v[3] for v in mine), len(days), len({v[1] for v in mine}), min(days), max(days)))
    assert rows(got) == sorted(wanted, key=repr)


def test_dense_keys_work_their_rows_out_once(spark):
    seen = spark.sparkContext.accumulator(0)

    def counted(x):
        seen.add(1)
        return x

    df = spark.range(300).repartition(3).select(F.udf(counted, "bigint")("id").alias("id"))
    assert one(surrogate_key(df, "key", ["id"]).agg(F.max("key").alias("n"))) == {"n": 300}
    assert seen.value == 300
