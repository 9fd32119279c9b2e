"""Registered queries of the llm package against SQL, brute force and labels."""

import hashlib
import re
import zlib
from pathlib import Path

import duckdb
import numpy as np
import pyarrow.parquet as pq
import pytest
import sentencepiece
import xxhash

import __spark_entry__ as entry
from tallyframe.llm import pieces
from tallyframe.llm.queries import QUERIES, SQL

SF = "/root/testdata/sf0.001"
MORE = "/root/testdata/sf0.01"


@pytest.fixture(scope="module")
def duck():
    connection = duckdb.connect()
    for file in Path(SF).glob("*.parquet"):
        connection.execute(f"CREATE VIEW {file.stem} AS SELECT * FROM '{file}'")
    return connection


def table(folder, name, *columns):
    return pq.read_table(f"{folder}/{name}.parquet", columns=list(columns) or None).to_pylist()


def by_id(spark, name, folder):
    return {r.doc_id: r for r in QUERIES[name](spark, folder).collect()}


def test_all_are_registered():
    assert QUERIES.keys() <= entry.queries().keys() and SQL.keys() <= entry.oracle_sql().keys()
    assert sorted(int(n[2:].split("_")[0]) for n in QUERIES if n != "pipeline") == list(range(1, 14))


@pytest.mark.parametrize("name", sorted(SQL))
def test_query_matches_sql(spark, duck, name):
    df = QUERIES[name](spark, SF)
    result = duck.execute(SQL[name])
    columns = [c[0] for c in result.description]
    assert sorted(df.columns) == sorted(columns)
    got = sorted(repr(tuple(r[c] for c in columns)) for r in df.collect())
    assert got == sorted(repr(r) for r in result.fetchall())


@pytest.mark.parametrize("name", ["op7_quality_rules", "op8_fixed_slots", "op13_relational_chats"])
def test_native_plans(spark, name):
    plan = QUERIES[name](spark, SF)._jdf.queryExecution().executedPlan().toString()
    for word in ("Python", "Pandas", "Arrow", "CartesianProduct", "NestedLoop"):
        assert word not in plan


def test_tokens_match_sentencepiece_on_whole_texts(spark):
    got = by_id(spark, "op4_sentencepiece_tokenizers", MORE)
    model = sentencepiece.SentencePieceProcessor(model_file=pieces.MODEL_FILE)
    docs = table(MORE, "documents", "doc_id", "text")
    for d, ids in zip(docs, model.encode([d["text"] for d in docs]), strict=True):
        row = got[d["doc_id"]]
        assert row.n_tokens == len(ids) and row.parity
        assert row.ids_sha256 == hashlib.sha256(np.array(ids, "<i4").tobytes()).hexdigest()
        assert row.round_trip == (model.decode(ids) == d["text"])


def test_languages_of_held_out_documents(spark):
    got = by_id(spark, "op9_hierarchical_language", MORE)
    docs = table(MORE, "documents", "doc_id", "lang")
    assert len(got) == len(docs)
    held = [d for d in docs if zlib.crc32(str(d["doc_id"]).encode()) % 4 == 2]
    assert {i for i, r in got.items() if r.held_out} == {d["doc_id"] for d in held}
    assert sum(got[d["doc_id"]].lang_pred == d["lang"] for d in held) / len(held) > 0.97
    assert all(0 <= r.score <= 1 for r in got.values())


def test_weak_labels_agree_with_given_ones(spark):
    got = by_id(spark, "op6_weak_label_quality", MORE)
    labels = table(MORE, "labels")
    kept = {q: [got[x["doc_id"]].kept for x in labels if x["quality"] == q] for q in (0, 1)}
    assert len(got) == 1000 and np.mean(kept[1]) > 0.99 and np.mean(kept[0]) < 0.05


def test_cross_entropy_separates_junk(spark):
    got = by_id(spark, "op5_cross_entropy_difference", MORE)
    labels = table(MORE, "labels")
    good, bad = ([got[x["doc_id"]].score for x in labels if x["quality"] == q] for q in (1, 0))
    assert np.mean([[g < b for b in bad] for g in good]) > 0.85


def prints(texts):
    lower = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
    out = []
    for text in texts:
        words = [w for w in re.findall("[^\x20\x09-\x0d]+", (text or "").translate(lower))]
        shingles = [" ".join(words[k : k + 4]) for k in range(max(1, len(words) - 3))] if words else []
        hashes = [xxhash.xxh64_intdigest(s.encode(), 42) for s in shingles]
        out.append(sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes)))
    return np.array(out, np.uint64)


def reachable(ids, fingerprints, distance=4):
    """Smallest id reachable over all pairs."""
    parent = {i: i for i in ids}

    def find(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for k, i in enumerate(ids):
        near = np.bitwise_count(fingerprints[k + 1 :] ^ fingerprints[k]) <= distance
        for j in np.flatnonzero(near):
            a, b = sorted((find(i), find(ids[k + 1 + j])))
            parent[b] = a
    return {i: find(i) for i in ids}


def test_simhash_against_all_pairs(spark):
    docs = sorted(table(MORE, "documents", "doc_id", "text"), key=lambda d: d["doc_id"])
    got = by_id(spark, "op10_deletion_variant_simhash", MORE)
    ids, found = [d["doc_id"] for d in docs], prints([d["text"] for d in docs])
    components = reachable(ids, found)
    for i, p in zip(ids, found.tolist(), strict=True):
        assert (got[i].fingerprint, got[i].component_id) == (f"{p:016x}", components[i])
    assert len(set(components.values())) < len(ids)


def test_shards_are_near_equal(spark):
    rows = QUERIES["op8_fixed_slots"](spark, "/root/testdata/sf0.1").collect()
    sizes, slots = {}, {}
    for r in rows:
        sizes[r.shard] = sizes.get(r.shard, 0) + r.size
        slots.setdefault(r.shard, []).append(r.slot)
    assert len(rows) == 10000 and sorted(sizes) == list(range(40))
    assert max(sizes.values()) <= 1.001 * min(sizes.values())
    assert all(sorted(s) == list(range(len(s))) for s in slots.values())


def test_pipeline_against_its_parts(spark):
    got = {r.doc_id: r.ids for r in QUERIES["pipeline"](spark, SF).collect()}
    docs = sorted(table(SF, "documents"), key=lambda d: d["doc_id"])
    labels = {x["doc_id"]: x["quality"] for x in table(SF, "labels")}
    # Only junk, copies and contaminated documents may go.
    components = reachable([d["doc_id"] for d in docs], prints([d["text"] for d in docs]))
    dirty = {r.doc_id for r in QUERIES["op1_fm_index_decontamination"](spark, SF).collect() if r.contaminated}
    junk = {i for i, q in labels.items() if q == 0}
    kept = [d for d in docs if d["doc_id"] in got]
    assert not dirty & set(got)
    assert len(junk & set(got)) <= 0.1 * len(junk)
    assert len({components[d["doc_id"]] for d in kept}) == len(kept)
    for d in docs:
        if labels.get(d["doc_id"]) == 1 and components[d["doc_id"]] == d["doc_id"] and d["doc_id"] not in dirty:
            assert d["doc_id"] in got
    model = sentencepiece.SentencePieceProcessor(model_file=pieces.MODEL_FILE)
    assert all(got[d["doc_id"]] == model.encode(d["text"]) for d in kept)
