"""Clustered clicks, bitmaps, key sets and hashed uniqueness: results against brute force, and their plans."""

import random
import re
from collections import Counter, defaultdict

import pytest
from conftest import one, rows
from pyspark.sql import functions as F

from tallyframe.operators import aggregates as agg
from tallyframe.operators import bitmaps
from tallyframe.operators.quality import ForeignKey, NotNull, Unique, rule_report, surplus_rows
from tallyframe.operators.references import key_set, marked
from tallyframe.plans import analytics, clean
from tallyframe.schemas import INTERACTION_KEY, PRESENTATION_KEY, REGISTRATION_KEY, SITE_KEY
from tallyframe.session import materialise, scratch
from tallyframe.sinks import Clustering, buckets_for, read_clustered, replace_table
from workload.tables import layers

SF = "/root/testdata/sf0.001"
KEYS = ["code_module", "code_presentation", "id_student"]
CLICKS = "code_module string, code_presentation string, id_student bigint, id_site bigint, interaction_date bigint, sum_click bigint"
EDGES = (-(2**40), -32768, -32767, -16385, -16384, -1, 0, 1, 16383, 16384, 16385, 32768, 32769, 2**40)


def click_rows():
    rng = random.Random(3)
    days = [*range(-20, 40), *EDGES, None]
    sites = [*range(1, 30), 0, -5, 32768, 32769, 70_000, 2**41, None]
    students = [*range(60), 2**33, -7, None]
    key = lambda: (rng.choice(["A", "B", None]), rng.choice(["J", "B"]), rng.choice(students), rng.choice(sites), rng.choice(days))
    found = {key(): rng.randint(1, 9) for _ in range(6000)}
    plain = [("A", "J", 1000 + k % 50, 1 + k % 9, k // 9 - 5, 2) for k in range(900)]
    return [(*k, n) for k, n in found.items()] + plain + [("A", "J", 7, s, d, 1) for s in range(40, 90) for d in range(50, 80)]


@pytest.fixture(scope="module")
def clicks(spark):
    """Rows, and the same stored clustered by student."""
    data, path = click_rows(), scratch(spark, "clustered")
    df = spark.createDataFrame(data, CLICKS).repartition(5)
    replace_table(df, path, PRESENTATION_KEY, cluster=Clustering(("id_student",), 4, ("id_student", "id_site")))
    return data, read_clustered(spark, "test_clicks", path, df.schema)


@pytest.fixture()
def no_broadcast(spark):
    old = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    yield
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", old)


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


def naive_engagement(data, width):
    groups = defaultdict(list)
    for r in data:
        groups[r[:width]].append(r)
    least = lambda values, how: how((v for v in values if v is not None), default=None)
    return sorted(
        (
            (*k, sum(r[5] for r in g), len({r[4] for r in g} - {None}), len({r[3] for r in g} - {None}),
             least([r[4] for r in g], min), least([r[4] for r in g], max))
            for k, g in groups.items()
        ),
        key=repr,
    )


def test_engagement_from_bitmaps_against_brute_force(spark, clicks):
    data, stored = clicks
    assert rows(stored) == sorted(data, key=repr)
    bits = materialise(analytics.engagement_bitmaps(stored), "bits")
    assert bits.where("pieces > 1").count() > 20 and bits.where("pieces = 1").count() > 20
    assert bits.agg(F.max(F.octet_length("days_bits"))).first()[0] <= 4096
    assert rows(bitmaps.engagement_counts(bits, KEYS)) == naive_engagement(data, 3)
    assert rows(bitmaps.coarser_engagement(bits, KEYS)) == naive_engagement(data, 3)
    assert rows(analytics.presentation_engagement(bits)) == naive_engagement(data, 2)
    assert rows(bitmaps.coarser_engagement(bits, KEYS[:1])) == naive_engagement(data, 1)


def test_no_clicks(spark):
    none = materialise(analytics.engagement_bitmaps(spark.createDataFrame([], CLICKS)), "bits")
    assert bitmaps.engagement_counts(none, KEYS).collect() == [] == analytics.presentation_engagement(none).collect()


def test_distinct_counts_of_texts_and_numbers(spark):
    rng = random.Random(1)
    data = [(rng.choice("ab"), rng.choice(["x", "y", None, ""]), rng.choice([*EDGES, None]), rng.randint(0, 50)) for _ in range(500)]
    df = spark.createDataFrame(data, "g string, t string, n bigint, i int").repartition(3)
    want = {g: tuple(len({r[k] for r in data if r[0] == g} - {None}) for k in (1, 2, 3)) + (sum(r[0] == g for r in data),) for g in "ab"}
    got = bitmaps.distinct_counts(df, ["g"], {"texts": "t", "numbers": "n", "ints": "i"}, "rows")
    assert {r.g: (r.texts, r.numbers, r.ints, r.rows) for r in got.collect()} == want
    assert "Expand" not in plan(got)
    assert one(bitmaps.distinct_counts(df.limit(0), [], {"texts": "t", "numbers": "n"}, "rows")) == {"texts": 0, "numbers": 0, "rows": 0}


def test_grouping_clustered_clicks_shuffles_no_clicks(spark, clicks):
    """Engagement, popularity, trend, uniqueness: no exchange below the last count of a few rows for each group."""
    stored = clicks[1]
    bits = plan(analytics.engagement_bitmaps(stored))
    assert "Exchange" not in bits and "Expand" not in bits
    assert "Exchange" not in plan(stored.groupBy(*INTERACTION_KEY).count())
    aggregates = analytics.click_log_aggregates(stored)
    for name in ("resource_popularity", "weekly_engagement_trend"):
        text = plan(aggregates[name])
        below = text[text.index("Exchange") :]
        assert text.count("Exchange") == 1 and "partial_count(distinct id_student" in below
    report = rule_report({"c": stored}, {"c": (Unique(INTERACTION_KEY),)}, {"c": ("id_student",)})
    (single,) = re.findall(r"Exchange (\w+)", plan(report))
    assert single == "SinglePartition"


def test_engagement_mart_joins_totals_from_bitmaps(spark, clicks, no_broadcast):
    bits = materialise(analytics.engagement_bitmaps(clicks[1]), "bits")
    t = {n: materialise(layers(spark, SF)[n], n) for n in ("clean_registration", "clean_student_assessment")}
    text = plan(analytics.student_engagement(t | {"clean_student_vle_interaction": clicks[1]}, bitmaps.engagement_counts(bits, KEYS)))
    assert "sum_click" not in text and "Expand" not in text


def test_clustered_versions_replace_each_other(spark, tmp_path, monkeypatch):
    path, cluster = str(tmp_path / "t"), Clustering(("k",), 3, ("k",))
    first = spark.range(100).select((F.col("id") % 7).alias("k"), "id")
    assert replace_table(first, path, cluster=cluster) == 100
    old = read_clustered(spark, "test_versions", path, first.schema)
    assert "Exchange" not in plan(old.groupBy("k").count())
    assert replace_table(first.limit(10), path, expected_rows=10, cluster=Clustering(("k",), 2, ("k",))) == 10
    assert read_clustered(spark, "test_versions", path, first.schema).count() == 10
    assert not [t.name for t in spark.catalog.listTables() if t.name.startswith("pending_")]
    assert buckets_for(spark, path) == 1
    monkeypatch.setattr("tallyframe.sinks.tables.LEAST_BUCKET_BYTES", 50)
    assert buckets_for(spark, path) == spark.sparkContext.defaultParallelism
    monkeypatch.setattr("tallyframe.sinks.tables.BUCKET_BYTES", 60)
    assert buckets_for(spark, path) > spark.sparkContext.defaultParallelism


# References


def test_key_sets_are_exact(spark):
    numbers = [*EDGES, *range(0, 200_000, 977)]
    parent = [(g, t, n) for g in ("a", "b") for t in ("x", None) for n in [*numbers, None]] + [("a", "x", 5)] * 3
    sets = {
        "by_number": key_set(spark.createDataFrame(parent, "g string, t string, n bigint").select("n"), ["n"]),
        "by_all": key_set(spark.createDataFrame(parent, "g string, t string, n bigint"), ["g", "t", "n"]),
        "by_text": key_set(spark.createDataFrame(parent, "g string, t string, n bigint").where("g = 'a'"), ["t", "g"]),
        "by_nothing": key_set(spark.createDataFrame([], "g string, t string, n bigint"), ["g", "n"]),
    }
    tested = [n + d for n in numbers for d in (-1, 0, 1)]
    child = [(g, t, n, n) for g in ("a", "b", "c", None) for t in ("x", "y", None) for n in [*tested, None]]
    got = marked(spark.createDataFrame(child, "g string, t string, n bigint, other bigint"), sets).collect()
    assert len(got) == len(child)
    known, full = {n for n in numbers} | {5}, {(g, t, n) for g, t, n in parent if None not in (g, t, n)}
    for r in got:
        test = lambda keys, inside: None if None in keys else inside
        assert r.by_number == test([r.n], r.n in known)
        assert r.by_all == test([r.g, r.t, r.n], (r.g, r.t, r.n) in full)
        assert r.by_text == test([r.g, r.t], (r.g, r.t) == ("a", "x"))
        assert r.by_nothing == test([r.g, r.n], False)


@pytest.mark.parametrize("limit", [0, 1 << 30])
def test_all_references_of_clicks_in_one_scan(spark, clicks, monkeypatch, limit):
    """Planted orphans are counted exactly, with sets sent to all tasks or shuffled."""
    monkeypatch.setattr("tallyframe.operators.references.BROADCAST_BYTES", limit)
    data, stored = clicks
    registered = {r[:3] for k, r in enumerate(data) if k % 3 and None not in r[:3]}
    sites = {(*r[:2], r[3]) for k, r in enumerate(data) if k % 5 and None not in (*r[:2], r[3])}
    tables = {
        "clicks": stored,
        "people": spark.createDataFrame(sorted(registered), "code_module string, code_presentation string, id_student bigint"),
        "sites": spark.createDataFrame(sorted(sites), "code_module string, code_presentation string, id_site bigint"),
    }
    of_person, of_site = ForeignKey(REGISTRATION_KEY, "people"), ForeignKey(SITE_KEY, "sites")
    rules = {"clicks": (NotNull(("interaction_date",)), of_person, of_site)}
    report = rule_report(tables, rules, also={"clicks": {"lost": "NOT coalesce(in_sites, false)"}})
    if limit:
        text = plan(report)
        assert text.count("FileScan parquet spark_catalog") == 1
        assert re.findall(r"Exchange (\w+)", text.replace("BroadcastExchange", "")) == ["SinglePartition"]
    got = {r.rule: r.violations for r in report.collect()}
    assert got == {
        "not null: interaction_date": sum(r[4] is None for r in data),
        of_person.name: sum(None not in r[:3] and r[:3] not in registered for r in data),
        of_site.name: sum(None not in (*r[:2], r[3]) and (*r[:2], r[3]) not in sites for r in data),
        "lost": sum((*r[:2], r[3]) not in sites for r in data),
    }


def test_rules_agree_with_a_plain_count(spark):
    t = layers(spark, SF)
    tables = {n: materialise(t[n], n) for n in clean.CLEAN_RULES}
    report = {(r.table_name, r.rule): r.violations for r in rule_report(tables, clean.CLEAN_RULES).collect()}
    assert len(report) == sum(map(len, clean.CLEAN_RULES.values())) and set(report.values()) == {0}


# Uniqueness


@pytest.mark.parametrize("digest", [None, "1L", "hash(a) % 3L"])
def test_surplus_rows_under_collisions(spark, digest):
    digest = digest and F.expr(digest)
    rng = random.Random(5)
    data = [(rng.choice("abcdefg") if k % 2 else f"k{k}", rng.choice([1, 2, None])) for k in range(400)] + [(None, None)] * 3
    df = spark.createDataFrame(data, "a string, b int").repartition(4)
    want = sum(n - 1 for n in Counter(data).values())
    assert surplus_rows(df, ["a", "b"], digest).first().violations == want
    assert surplus_rows(df.where("a LIKE 'k%'"), ["a"], digest).first().violations == 0
    assert surplus_rows(df.limit(0), ["a", "b"], digest).first().violations == 0


def shuffled_bytes(spark, df):
    """Bytes that the plan's exchanges sent."""
    df.collect()
    node = df._jdf.queryExecution().executedPlan().executedPlan()
    total, todo = 0, [node]
    while todo:
        node = todo.pop()
        if node.nodeName() == "Exchange" and node.metrics().contains("dataSize"):
            total += node.metrics().apply("dataSize").value()
        if node.nodeName().endswith("QueryStage"):
            todo.append(node.plan())
        todo += [node.children().apply(k) for k in range(node.children().size())]
    return total


def test_unique_wide_keys_shuffle_hashes_only(spark, monkeypatch):
    wide = spark.range(20_000).select(*[F.sha2(F.concat(F.col("id").cast("string"), F.lit(c)), 256).alias(c) for c in "abc"])
    wide = materialise(wide, "wide")
    sent = []
    kept = materialise

    def watched(df, label):
        sent.append(shuffled_bytes(spark, df))
        return kept(df, label)

    monkeypatch.setattr("tallyframe.operators.quality.materialise", watched)
    by_hash = surplus_rows(wide, ["a", "b", "c"])
    by_hash = sent[0] + shuffled_bytes(spark, by_hash)
    per_key = wide.groupBy("a", "b", "c").agg(F.count(F.lit(1)).alias("n"))
    by_keys = shuffled_bytes(spark, per_key.agg(F.sum(F.col("n") - 1)))
    assert 0 < by_hash < by_keys / 4


def test_popularity_is_the_same_clustered_or_not(spark, clicks):
    data, stored = clicks
    plain = spark.createDataFrame(data, CLICKS).repartition(3)
    args = ([*PRESENTATION_KEY, "id_site"], "sum_click", "id_student")
    assert rows(agg.popularity(stored, *args)) == rows(agg.popularity(plain, *args))
