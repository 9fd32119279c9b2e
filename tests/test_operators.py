import math
import random
import statistics
from collections import Counter, defaultdict

import pytest
from conftest import one, rows
from pyspark.sql import functions as F

from tallyframe.operators import aggregates as agg
from tallyframe.operators import profile, selection
from tallyframe.operators.corrections import (
    append_valid,
    apply_corrections,
    apply_valid_corrections,
    correction_evidence,
    rejected_corrections,
    rejected_rows,
    rows_corrected,
)
from tallyframe.operators.differences import checksums, differing_groups, row_difference
from tallyframe.operators.joins import has_orphans, orphan_counts, orphans, star_audit, star_denormalise, star_lookup
from tallyframe.operators.ordering import first_per_key, running_total, surrogate_key, top_k
from tallyframe.operators.quality import Check, ForeignKey, NotNull, Unique, one_of, violations


@pytest.fixture(scope="module")
def skewed(spark):
    """20,000 clicks; one student and one site each hold more than a third."""
    pick = random.Random(7)
    data = [
        (
            1 if i % 3 == 0 else pick.randrange(2, 400),
            1 if i % 5 < 2 else pick.randrange(2, 60),
            pick.randrange(-20, 60),
            pick.randrange(1, 9),
        )
        for i in range(20000)
    ]
    return data, spark.createDataFrame(data, "student bigint, site bigint, day bigint, clicks bigint").repartition(6)


def test_consolidate_against_brute_force(skewed):
    data, df = skewed
    want = defaultdict(int)
    for student, site, day, clicks in data:
        want[student, site, day] += clicks
    clean = agg.consolidate(df, ["student", "site", "day"], ["clicks"])
    assert {tuple(r)[:3]: r.clicks for r in clean.collect()} == want
    report = one(agg.consolidation_report(df, clean))
    assert report["raw_rows"] == 20000 and report["collapsed_rows"] == 20000 - len(want)
    assert float(report["collapsed_pct"]) == round(100 * (20000 - len(want)) / 20000 + 1e-9, 2)


def test_engagement_and_popularity_against_brute_force(skewed):
    data, df = skewed
    by_student, by_site = defaultdict(list), defaultdict(list)
    for row in data:
        by_student[row[0]].append(row)
        by_site[row[1]].append(row)
    want = {
        s: (sum(r[3] for r in v), len({r[2] for r in v}), len({r[1] for r in v}), min(r[2] for r in v), max(r[2] for r in v))
        for s, v in by_student.items()
    }
    got = agg.engagement(df, ["student"], "clicks", "day", "site").collect()
    assert {r.student: tuple(r)[1:] for r in got} == want
    got = agg.popularity(df, ["site"], "clicks", "student").collect()
    assert {r.site: tuple(r)[1:] for r in got} == {
        s: (sum(r[3] for r in v), len({r[0] for r in v})) for s, v in by_site.items()
    }


def test_surrogate_keys_are_dense_and_ordered_despite_a_hot_key(skewed):
    data, df = skewed
    keys = sorted({row[:3] for row in data})
    got = surrogate_key(agg.consolidate(df, ["student", "site", "day"], ["clicks"]), "k", ["student", "site", "day"])
    assert [tuple(r)[1:4] for r in got.orderBy("k").collect()] == keys
    assert [r.k for r in got.orderBy("k").collect()] == list(range(1, len(keys) + 1))


def test_hot_key_is_split_over_slices(skewed):
    """The range slices behind dense keys hold similar row counts."""
    _, df = skewed
    distinct = agg.consolidate(df, ["student", "site", "day"], ["clicks"])
    sizes = distinct.repartitionByRange(8, "student", "site", "day").groupBy(F.spark_partition_id()).count()
    counts = [r["count"] for r in sizes.collect()]
    assert max(counts) < 2 * sum(counts) / len(counts)


def test_surrogate_key_of_nothing(spark):
    assert surrogate_key(spark.range(0), "k", ["id"]).collect() == []


def test_first_per_key_breaks_ties(spark):
    df = spark.createDataFrame([(1, None, "z"), (1, 5, "b"), (1, 5, "a"), (2, None, "q")], "k int, o int, v string")
    assert rows(first_per_key(df, ["k"], ["o"])) == [(1, 5, "a"), (2, None, "q")]


def test_running_total_spans_slices(skewed):
    data, df = skewed
    counts = df.groupBy("site", "day").agg(F.sum("clicks").alias("n"))
    totals = defaultdict(int)
    for _, site, day, clicks in data:
        totals[site, day] += clicks
    want, seen = {}, defaultdict(int)
    for site, day in sorted(totals):
        seen[site] += totals[site, day]
        want[site, day] = seen[site]
    got = running_total(counts, "site", "day", "n")
    assert {(r.site, r.day): r.running for r in got.collect()} == want


@pytest.mark.parametrize("keep", [20000, 19999, 1, 2])
def test_column_stats_against_brute_force(skewed, spark, keep):
    data = skewed[0][:keep]
    df = spark.createDataFrame([(r[2], str(r[1]) if r[1] != 2 else None) for r in data] + [(None, None)], "day bigint, site string")
    got = {r.column_name: r for r in profile.column_stats(df, ["day"], ["site"]).collect()}
    days = [r[2] for r in data]
    top = Counter(days).most_common()[0][1]
    assert got["day"]["median"] == statistics.median(days)
    assert got["day"]["mode"] == min(d for d, n in Counter(days).items() if n == top)
    assert got["day"]["mean"] == pytest.approx(statistics.fmean(days))
    assert (got["day"]["min"], got["day"]["max"], got["day"]["missing"]) == (min(days), max(days), 1)
    if statistics.fmean(days):
        assert got["day"]["dispersion"] == pytest.approx(statistics.pstdev(days) / statistics.fmean(days))
    labels = [str(r[1]) for r in data if r[1] != 2]
    share = [n / len(labels) for n in Counter(labels).values()]
    assert got["site"]["dispersion"] == pytest.approx(-sum(p * math.log(p) for p in share), abs=1e-9)
    assert got["site"]["missing"] == 1 + sum(r[1] == 2 for r in data)


@pytest.mark.parametrize("few,accuracy", [(1, 100), (30, 20), (100_000, 10_000)])
def test_medians_by_narrowing_brackets(spark, few, accuracy):
    r = random.Random(few)
    hot = [7.0] * 900 + [r.uniform(-50, 60) for _ in range(1100)]
    columns = {
        "hot": hot, "same": [3.0] * 2000, "two": [1.0] * 1000 + [2.0] * 1000, "wide": [r.uniform(-1, 1) * 10 ** r.randrange(-200, 200) for _ in range(2000)],
        "gaps": [None if r.random() < 0.4 else float(r.randrange(500)) for _ in range(2000)], "one": [None] * 1999 + [5.0], "none": [None] * 2000,
    }
    for v in columns.values():
        r.shuffle(v)
    df = spark.createDataFrame(list(zip(*columns.values(), strict=True)), ", ".join(f"{c} double" for c in columns)).repartition(4)
    present = {c: [x for x in v if x is not None] for c, v in columns.items()}
    got = selection.exact_medians(df, {c: len(v) for c, v in present.items()}, few, accuracy)
    assert got == {c: statistics.median(v) if v else None for c, v in present.items()}
    ranks = {k: selection.Bracket("hot", k, 2000) for k in (1, 2, 500, 1999, 2000)}
    assert selection.select_ranks(df, ranks, few, accuracy) == {k: sorted(hot)[k - 1] for k in ranks}


def test_column_stats_of_nothing_and_without_writes(spark):
    nothing = spark.createDataFrame([], "n int, label string")
    got = {x.column_name: x for x in profile.column_stats(nothing, ["n"], ["label"]).collect()}
    assert (got["n"]["median"], got["n"]["mode"], got["n"]["missing"], got["label"]["mode_label"], got["label"]["missing"]) == (None, None, 0, None, 0)
    df = spark.range(1000).selectExpr("id % 7 AS n", "CAST(id % 3 AS STRING) AS label")
    plan = profile.column_stats(df, ["n"], ["label"])._jdf.queryExecution().executedPlan().toString()
    assert "Scan parquet" not in plan and "rangepartitioning" not in plan


def test_consistency_ignores_nulls(spark):
    df = spark.createDataFrame([(1, "a"), (1, None), (2, "a"), (2, " a "), (3, "a"), (3, "?")], "k int, v string")
    assert one(profile.consistency(df, "k", ["v"])) == {"inconsistent_v": 1}


def test_string_list_is_distinct_and_ordered(spark):
    df = spark.createDataFrame([(1, "b"), (1, "a"), (1, "b"), (2, "x")], "k int, v string")
    assert rows(agg.string_list(df, ["k"], "v", "s", " | ")) == [(1, "a | b"), (2, "x")]
    placed = df.withColumn("o", F.when(F.col("v") == "a", 2).otherwise(1))
    assert rows(agg.string_list(placed, ["k"], "v", "s", " | ", "o")) == [(1, "b | a"), (2, "x")]
    assert rows(agg.string_list(placed, ["k"], "v", "s", "'", "o", distinct=False)) == [(1, "b'b'a"), (2, "x")]
    nulls = spark.createDataFrame([(1, None), (1, "a"), (2, None)], "k int, v string")
    assert rows(agg.string_list(nulls, ["k"], "v", "s")) == [(1, "a"), (2, None)]


def test_top_k(spark):
    assert [r.id for r in top_k(spark.range(100), 3, F.desc("id")).collect()] == [99, 98, 97]


@pytest.fixture(scope="module")
def family(spark):
    child = spark.createDataFrame([(1, "a"), (1, "a"), (2, "a"), (3, "b"), (None, "b")], "k int, g string")
    return child, spark.createDataFrame([(1,), (1,), (4,)], "k int")


def test_orphans(family):
    child, parent = family
    assert rows(orphans(child, parent, ["k"])) == [(2, "a"), (3, "b"), (None, "b")]
    assert one(orphan_counts(child, parent, ["k"])) == {"unmatched_records": 3}
    assert rows(orphan_counts(child, parent, ["k"], ["g"])) == [("a", 1), ("b", 2)]
    assert one(has_orphans(child, parent, ["k"])) == {"has_orphans": 1}
    assert one(has_orphans(child.where("k = 1"), parent, ["k"])) == {"has_orphans": 0}
    assert one(orphan_counts(child.limit(0), parent, ["k"])) == {"unmatched_records": 0}


def test_star(spark):
    dim_a = spark.createDataFrame([(1, "x"), (2, "y")], "a_key int, a string")
    dim_b = spark.createDataFrame([(7, "p")], "b_key int, b string")
    source = spark.createDataFrame([("x", "p", 1), ("y", "p", 2), ("y", "q", 3)], "a string, b string, m int")
    fact = star_lookup(source, [(dim_a, ["a"], "a_key"), (dim_b, ["b"], "b_key")]).select("a_key", "b_key", "m")
    assert rows(fact) == [(1, 7, 1), (2, 7, 2)]
    back = star_denormalise(fact, [(dim_a, "a_key", ["a"]), (dim_b, "b_key", ["b"])])
    assert rows(back.select("a", "b", "m")) == [("x", "p", 1), ("y", "p", 2)]
    outer = star_lookup(source, [(dim_a, ["a"], "a_key"), (dim_b, ["b"], "b_key")], "left")
    assert one(star_audit(outer, [(dim_a, "a_key", "no_a"), (dim_b, "b_key", "no_b")])) == {"no_a": 0, "no_b": 1}


def test_violations(spark, family):
    child, parent = family
    assert rows(violations(child, NotNull(("k", "g")))) == [(None, "b")]
    assert rows(violations(child, Unique(("k", "g")))) == [(1, "a", 2)]
    assert rows(violations(child, ForeignKey(("k",), "p"), {"p": parent})) == [(2, "a"), (3, "b")]
    assert rows(violations(child, Check("small", "k < 3"))) == [(3, "b")]  # the null passes


# ------------------------------------------------------------ corrections


@pytest.fixture(scope="module")
def marks(spark):
    return spark.createDataFrame([(1752, 11, 78), (1752, 12, 40), (1753, 11, None)], "a int, s int, score int")


VALID = [Check("score within 0 to 100", "score BETWEEN 0 AND 100")]
KEY = ["a", "s"]


def fixes(spark, *rows_):
    return spark.createDataFrame(list(rows_), "a int, s int, score int")


def test_good_fix_changes_its_row_only(spark, marks):
    batch = fixes(spark, (1752, 11, 85), (9, 9, 50))
    assert rows(apply_corrections(marks, batch, KEY)) == [(1752, 11, 85), (1752, 12, 40), (1753, 11, None)]
    assert one(rows_corrected(marks, batch, KEY)) == {"rows_corrected": 1}


def test_bad_fix_is_rejected_and_others_applied(spark, marks):
    batch = fixes(spark, (1752, 11, 120), (1753, 11, 60))
    assert rows(apply_valid_corrections(marks, batch, KEY, VALID)) == [(1752, 11, 78), (1752, 12, 40), (1753, 11, 60)]
    assert rows(rejected_corrections(marks, batch, KEY, VALID)) == [(1752, 11, 120, "score within 0 to 100")]


def test_repeated_fixes_never_multiply_rows(spark, marks):
    batch = fixes(spark, (1752, 11, 85), (1752, 11, 90)).withColumn("at", F.col("score"))
    assert rows(apply_corrections(marks, batch, KEY, [F.desc("at")])) == [(1752, 11, 90), (1752, 12, 40), (1753, 11, None)]
    assert apply_valid_corrections(marks, batch.drop("at"), KEY, VALID).count() == 3


def test_every_fix_is_judged_before_one_is_chosen(spark, marks):
    batch = fixes(spark, (1752, 11, -5), (1752, 11, 85), (1752, 12, 85), (1752, 12, 120))
    assert rows(apply_valid_corrections(marks, batch, KEY, VALID)) == [(1752, 11, 85), (1752, 12, 85), (1753, 11, None)]
    name = "score within 0 to 100"
    assert rows(rejected_corrections(marks, batch, KEY, VALID)) == [(1752, 11, -5, name), (1752, 12, 120, name)]
    stamped = spark.createDataFrame([(1752, 11, 85, 1), (1752, 11, 60, 2), (1752, 11, 101, 3)], "a int, s int, score int, t int")
    assert rows(apply_valid_corrections(marks, stamped, KEY, VALID, [F.desc("t")]))[0] == (1752, 11, 60)
    assert rows(rejected_corrections(marks, stamped, KEY, VALID)) == [(1752, 11, 101, 3, name)]


def test_bad_row_takes_no_good_one_with_it(spark, marks):
    rules = [Unique(("a", "s")), *VALID]
    new = fixes(spark, (7, 10, 10), (7, 10, 500), (8, 1, 1), (8, 1, 2))
    assert rows(append_valid(marks, new, rules).subtract(marks)) == [(7, 10, 10)]
    assert rows(rejected_rows(marks, new, rules)) == [
        (7, 10, 500, "score within 0 to 100"), (8, 1, 1, "unique: a, s"), (8, 1, 2, "unique: a, s"),
    ]


def test_labels_with_quotes(spark):
    df = spark.createDataFrame([("O'Brien",), ('a"b',), ("c\\d",), ("x",)], "v string")
    known = Check("known", one_of("v", ["O'Brien", 'a"b', "c\\d"]))
    assert [r.v for r in violations(df, known).collect()] == ["x"]


def test_evidence(spark, marks):
    after = apply_corrections(marks, fixes(spark, (1752, 11, 85)), KEY)
    assert one(correction_evidence(marks, after, marks, KEY)) == {
        "rows_before": 3, "rows_after": 3, "rows_foreign_to_source": 0,
    }


def test_append_keeps_rules(spark, marks):
    students = spark.createDataFrame([(11,), (12,)], "s int")
    rules = [Unique(("a", "s")), ForeignKey(("s",), "students"), *VALID]
    new = fixes(spark, (1753, 12, 90), (1752, 11, 1), (1754, 99, 1), (1755, 11, 101), (1756, 11, 5), (1756, 11, 6))
    got = append_valid(marks, new, rules, {"students": students})
    assert rows(got.subtract(marks)) == [(1753, 12, 90)] and got.count() == 4


def test_dependent_inserts_in_order(spark):
    """A parent added in one step is there for its child in the next."""
    students = spark.createDataFrame([(1,)], "s int")
    marks_ = spark.createDataFrame([(5, 1)], "a int, s int")
    rules = [ForeignKey(("s",), "students")]
    child = spark.createDataFrame([(5, 2)], "a int, s int")
    assert append_valid(marks_, child, rules, {"students": students}).count() == 1
    students = append_valid(students, spark.createDataFrame([(2,)], "s int"), [Unique(("s",))])
    assert append_valid(marks_, child, rules, {"students": students}).count() == 2


def test_row_difference(spark):
    schema = "k int, a int, b int, c string"
    same = [(i, i, None, "x") for i in range(100, 400)]
    old = spark.createDataFrame([(1, 1, 1, "a"), (2, None, 5, "b"), (3, 3, 3, "c"), (4, 4, 4, "d"), (4, 4, 4, "d"), (None, 1, 1, "n"), (6, 1, 1, "p"), (6, 1, 1, "p"), *same], schema)
    new = spark.createDataFrame([(1, 1, 1, "a"), (2, 5, None, "b"), (4, 4, 4, "d"), (5, 5, 5, None), (None, 1, 1, "m"), (6, 2, 2, "q"), (6, 2, 2, "q"), *reversed(same)], schema)
    got = {x.k: tuple(x)[1:] for x in row_difference(old, new.repartition(5).select("c", "k", "b", "a"), ["k"]).collect()}
    assert got == {
        2: ("changed", 1, 1, "a, b"), 3: ("lost", 1, 0, None), 4: ("lost", 1, 0, None), 5: ("added", 0, 1, None),
        None: ("changed", 1, 1, "c"), 6: ("several", 2, 2, None),
    }
    assert row_difference(old, old.repartition(3), ["k"]).collect() == []
    assert {x.kind for x in row_difference(old, old.limit(0), ["k"]).collect()} == {"lost"}
    assert row_difference(old, new, ["k"], groups=1).count() == len(got)
    assert differing_groups(old, new, ["k"]).count() <= len(got) and checksums(old.limit(0), ["k"]).count() == 0
    with pytest.raises(ValueError, match="different columns"):
        row_difference(old, new.drop("c"), ["k"])


def test_repeated_rows_do_not_cancel_in_checksums(spark):
    pairs = lambda v: spark.createDataFrame([(1, v), (1, v)], "k int, v int")
    assert differing_groups(pairs(1), pairs(2), ["k"]).count() == 1
    swapped = [spark.createDataFrame([(1, *v)], "k int, a int, b int") for v in ((None, 7), (7, None))]
    assert differing_groups(*swapped, ["k"]).count() == 1
