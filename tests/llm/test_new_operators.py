"""Sharded k-means, filter interaction audit and chat formatting against brute force."""

import hashlib
import itertools
import math
import random
import re
from collections import Counter, defaultdict

import numpy as np
import pytest
from pyspark.sql import functions as F

from tallyframe.llm import chat, interactions, lloyd

# Dimension-sharded k-means

VECTORS = "vec_id bigint, embedding array<double>, label int, cluster string, id string"


def vector_rows(n=300, d=40, seed=4):
    rng = random.Random(seed)
    rows = [(k, [rng.gauss(k % 5, 0.4) for _ in range(d)]) for k in range(n)]
    rows += [(7, rows[7][1]), (7, rows[8][1]), (None, rows[9][1]), (n, [0.0] * d), (n + 1, [0.0] * d)]
    odd = [None, [], [1.0] * (d - 1), [1.0] * (d - 1) + [None], [math.nan] + [1.0] * (d - 1), [1.0] * (d - 1) + [-math.inf]]
    return rows, [(10_000 + k, v) for k, v in enumerate(odd)]


def naive_lloyd(rows, clusters, rounds, scale):
    vectors = [(i, [math.floor(scale * x) for x in v]) for i, v in rows]
    order = sorted(zip(vectors, rows, strict=True), key=lambda x: (hashlib.sha256(f"3:{'' if x[0][0] is None else x[0][0]}".encode()).hexdigest(), x[1][1]))
    centres = [v for (_, v), _ in order[:clusters]]
    nearest = lambda v: min((sum((a - b) ** 2 for a, b in zip(v, c, strict=True)), k) for k, c in enumerate(centres))
    for _ in range(rounds):
        members = defaultdict(list)
        for _, v in vectors:
            members[nearest(v)[1]].append(v)
        centres = [[sum(x) // len(members[k]) for x in zip(*members[k], strict=True)] if k in members else c for k, c in enumerate(centres)]
    return [(i, *nearest(v)[::-1]) for i, v in vectors], centres


@pytest.mark.parametrize("size, scale, clusters", [(1.0, 1024, 8), (3e4, 1000, 3), (1e9, 1024, 4)])
def test_clusters_against_brute_force(spark, monkeypatch, size, scale, clusters):
    monkeypatch.setattr(lloyd, "CHUNK", 32)
    good, odd = vector_rows()
    good = [(i, [size * x for x in v]) for i, v in good]
    df = spark.createDataFrame([(i, v, 1, "x", "y") for i, v in good + odd], VECTORS).repartition(5)
    found = lloyd.cluster(df, dimensions=40, clusters=clusters, rounds=4, scale=scale)
    want, centres = naive_lloyd(good, clusters, 4, scale)
    assert found.centroids == centres
    small = lambda d: d if d < 1 << 63 else None
    key = lambda x: repr(x)
    assert sorted(map(tuple, found.assigned.collect()), key=key) == sorted(((i, c, small(d)) for i, c, d in want), key=key)
    inertia = defaultdict(int)
    for _, c, d in want:
        inertia[c] += d
    for r in lloyd.with_inertia(found).collect():
        assert r.cluster_inertia == small(inertia[r.cluster]) or any(d >= 1 << 63 for _, c, d in want if c == r.cluster)
        assert r.centroid_sha256 == hashlib.sha256(",".join(map(str, centres[r.cluster])).encode()).hexdigest()


def test_distances_beyond_64_bits_are_exact_inside_and_null_outside(spark):
    rows = [(k, [x]) for k, x in enumerate((0.0, 3e300, 3e300 + 1e285, -2.0**40))]
    found = lloyd.cluster(spark.createDataFrame(rows, "vec_id bigint, embedding array<double>"), dimensions=1, clusters=2, rounds=3)
    want, centres = naive_lloyd(rows, 2, 3, 1024)
    assert found.centroids == [[math.floor(x) for x in c] for c in centres]
    assert {r.id: (r.cluster, r.distance) for r in found.assigned.collect()} == {i: (c, d if d < 1 << 63 else None) for i, c, d in want}


def test_empty_and_few_vectors(spark):
    none = lloyd.with_inertia(lloyd.cluster(spark.createDataFrame([(1, None, 1, "x", "y")], VECTORS), dimensions=3))
    assert none.collect() == [] and {"id", "cluster", "distance", "inertia"} <= set(none.columns)
    two = spark.createDataFrame([(1, [1.0, 2.0], 1, "x", "y"), (2, [5.0, 2.0], 1, "x", "y")], VECTORS)
    rows = lloyd.with_inertia(lloyd.cluster(two, dimensions=2)).collect()
    assert len({r.cluster for r in rows}) == 2 and all(r.distance == r.inertia == 0 for r in rows)


def test_block_tasks_see_one_block_and_survive_other_partitionings(spark, monkeypatch):
    good, _ = vector_rows(200, 70)
    df = spark.createDataFrame(good, "vec_id bigint, embedding array<double>").repartition(7)
    stored = lloyd.cut(df.select(F.col("vec_id").alias("id"), F.col("embedding").alias("vector")), 70, 1024)
    assert stored.select("block").distinct().count() == 5  # four blocks of 16 columns and one of 6
    first = lloyd.cluster(df, dimensions=70).centroids
    monkeypatch.setattr(lloyd, "TASK_BYTES", 1000)
    monkeypatch.setattr(lloyd, "BLOCK", 9)
    assert lloyd.cluster(df.repartition(2), dimensions=70).centroids == first


# Filter interaction audit

DOCS = "doc_id bigint, text string, source string, part string, failed string, good string, n_words string"


def doc_rows():
    rng = random.Random(8)
    words = [f"w{k}" for k in range(60)] + ["ÄÖ", "x#", "Go", "AND", " ", "y z"]
    rows = [(k, " ".join(rng.choices(words[: rng.randint(1, 66)], k=rng.randint(0, 400))), rng.choice(["a", "b", "", None])) for k in range(120)]
    copies = [(200 + k, rows[k % 7][1], "hot") for k in range(150)]
    odd = [
        (1, rows[1][1], "a"), (None, rows[2][1], "a"), (None, rows[2][1], None), (400, None, "a"), (401, "", "a"), (402, " \t\n\x0b", "b"),
        (403, "word " * 300_000, "c"), (404, "é" * 2_000_000, "c"), (405, "A" * 70_000, None), (406, "a\u0085b\u001cc", "c"),
    ]
    return rows + copies + odd


def naive_failed(rows):
    first = {}
    for i, text, _ in rows:
        if i is not None:
            first[text or ""] = min(first.get(text or "", i), i)
    for i, text, part in rows:
        text = text or ""
        words = re.findall("[^\x20\x09-\x0d]+", text)
        tests = [
            len(words) < 200,
            100 * len(set(words)) < 50 * len(words),
            100 * sum("A" <= c <= "Z" for c in text) > 2 * len(text),
            any(c in "#$%&*|" for c in text),
            i is not None and i > first[text],
        ]
        yield i, part or "", sum(t << k for k, t in enumerate(tests))


def naive_audit(judged):
    """Each order applied to each document."""
    out = Counter()
    for part, failed, good, toxic in judged:
        for order in itertools.permutations("ABCDE"):
            removed = False
            for step, f in enumerate(order, 1):
                key, fails = (part, "".join(order), step), bool(failed >> "ABCDE".index(f) & 1)
                out[key, "kept"] += not (removed or fails)
                out[key, "removed"] += fails and not removed
                out[key, "redundant"] += fails and removed
                out[key, "unique_fails"] += failed == 1 << "ABCDE".index(f)
                out[key, "good_lost"] += good and fails and not removed
                out[key, "toxic_lost"] += toxic and fails and not removed
                out[part, f] += fails and not removed
                removed |= fails
    return out


@pytest.fixture(scope="module")
def audited(spark):
    rows = doc_rows()
    df = spark.createDataFrame([(i, t, s, "x", "x", "x", "x") for i, t, s in rows], DOCS).repartition(4)
    marks = [(k, k % 3 % 2, None if k % 5 == 0 else k % 2, "x") for k in range(0, 300, 2)] + [(4, 1, 1, "x"), (4, 0, 0, "x"), (None, 1, 1, "x")]
    labels = spark.createDataFrame(marks, "doc_id bigint, quality int, toxic int, part string")
    good = {i for i, q, _, _ in marks if q == 1 and i is not None}
    toxic = {i for i, _, t, _ in marks if t == 1 and i is not None}
    return rows, df, labels, good, toxic


def test_failed_filters_against_brute_force(spark, audited, monkeypatch):
    rows, df, labels, good, toxic = audited
    want = sorted(((i, p, f, i in good, i in toxic) for i, p, f in naive_failed(rows)), key=repr)
    assert sorted((tuple(r) for r in interactions.judged(df, labels).collect()), key=repr) == want
    monkeypatch.setattr(interactions, "SHARD_BYTES", 3000)
    monkeypatch.setattr(interactions, "RANGE_BYTES", 100)
    assert sorted((tuple(r) for r in interactions.judged(df, labels).collect()), key=repr) == want


def test_all_orders_against_brute_force(audited):
    rows, df, labels, good, toxic = audited
    got = interactions.audit(df, labels).collect()
    want = naive_audit([(p, f, i in good, i in toxic) for i, p, f in naive_failed(rows)])
    assert len(got) == 600 * len({s or "" for _, _, s in rows})
    for r in got:
        key = r.part, r.filter_order, r.step
        for name in ("kept", "removed", "redundant", "unique_fails", "good_lost", "toxic_lost"):
            assert r[name] == want[key, name]
        assert r.shapley == want[r.part, r.filter_order[r.step - 1]]


def test_matrix_counts_words_over_one_dictionary(spark, audited, monkeypatch):
    monkeypatch.setattr(interactions, "SHARD_BYTES", 2000)
    monkeypatch.setattr(interactions, "RANGE_BYTES", 50)
    rows = [r for r in doc_rows()[:60]]
    df = spark.createDataFrame(rows, "doc_id bigint, text string, source string").repartition(3)
    shards = interactions.document_term_matrix(df).collect()
    assert len(shards) > 5
    totals, ids = Counter(), []
    for s in shards:
        starts, columns, counts = (interactions.loosen(s[c], np.int64) for c in ("starts", "columns", "counts"))
        ids += interactions.pa.ipc.open_stream(s.kept).read_all().column("__id").to_pylist()
        assert len(starts) - 1 <= 60 and starts[-1] == len(columns) == len(counts)
        for c, n in zip(columns.tolist(), counts.tolist(), strict=True):
            totals[c] += n
    words = Counter(w for _, t, _ in rows for w in (t or "").encode().split())
    assert sorted(ids) == list(range(60))
    assert len(totals) == len(words) and sorted(totals.values()) == sorted(words.values())


def test_audit_of_nothing(spark):
    none = spark.createDataFrame([], DOCS)
    labels = spark.createDataFrame([], "doc_id bigint, quality int, toxic int")
    assert interactions.audit(none, labels).collect() == []
    one = spark.createDataFrame([(None, None, None, None, None, None, None)], DOCS)
    rows = interactions.audit(one, labels).collect()
    assert len(rows) == 600 and {r.removed for r in rows if r.filter_order.startswith("A") and r.step == 1} == {1}


# Chat formatting

CHATS = "conv_id bigint, turn bigint, role string, text string, formatted string, __row string"


def chat_rows():
    rng = random.Random(6)
    bits = ["\\", "\\\\", "</turn>", "</turn>\n", "<next>", "### ", "###", "#", "####", ": ", ":", "user", "<", "</tu", "rn>", "<ne", "é", "𝄞", "\n", "$1", " "]
    text = lambda: "".join(rng.choices(bits, k=rng.randint(0, 9)))
    roles = ["user", "assistant", "system", "a: b", "x:", "### y", "</turn>\n", "assistant ", "\\", ""]
    rows = [(c, t, rng.choice(roles[: rng.choice([2, 10])]), text()) for c in range(80) for t in range(rng.randint(1, 9))]
    rows += [(3, 0, "user", "tie"), (3, 0, "user", "tie"), (3, None, "assistant", "no turn"), (None, 1, "user", "a"), (None, 2, None, None), (200, 0, None, None)]
    rows += [(201, t, "user" if t % 3 else "assistant", f"{t} # " * (t % 7)) for t in range(3000)]
    return rows + [(202, 0, "assistant", "# é </turn>" * 100_000)]


def test_chats_read_back(spark):
    rows = chat_rows()
    df = spark.createDataFrame([(*r, "x", "y") for r in rows], CHATS).repartition(5)
    made = chat.format_chats(df)
    assert made.columns == ["conv_id", "formatted", "loss_spans"]
    read = made.select(
        "*", chat.read_turns(F.col("formatted")).alias("turns"), chat.read_loss_texts(F.col("formatted"), F.col("loss_spans")).alias("loss")
    )
    got = {r.conv_id: r for r in read.collect()}
    chats = defaultdict(list)
    for c, t, role, text in rows:
        chats[c].append((-1 if t is None else t, role or "", text or ""))
    assert got.keys() == chats.keys()
    for c, turns in chats.items():
        back = [(t.role, t.text) for t in got[c].turns]
        if len({t[0] for t in turns}) == len(turns):
            assert back == [t[1:] for t in sorted(turns)]
        else:
            assert sorted(back) == sorted(t[1:] for t in turns) and back[0] == ("assistant", "no turn")
        assert got[c].loss == [text for role, text in back if role == "assistant"]
        # As many turns as runs of one role, and no control string but the template's own.
        runs = len(list(itertools.groupby(role for role, _ in back)))
        assert got[c].formatted.count("</turn>") == got[c].formatted.count("###") == runs
        assert got[c].formatted.count("<next>") == len(back) - runs
        utf8 = got[c].formatted.encode()
        assert all(utf8[: s.start].endswith((b": ", b"<next>")) and utf8[s.start + s.size :].startswith((b"</turn>\n", b"<next>")) for s in got[c].loss_spans)


def test_no_chats(spark):
    assert chat.format_chats(spark.createDataFrame([], CHATS)).collect() == []
