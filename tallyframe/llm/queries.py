"""The registered queries of this package: thin bindings, and SQL where it can say them."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

import corpus_pipeline
from tallyframe.llm import chat, crossentropy, decontaminate, interactions, language, licences, lloyd, pieces, rules, simhash, slots, warc, weaklabels
from tallyframe.llm.common import table
from tallyframe.session import scratch

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
SQL: dict[str, str] = {}


def query(name: str, sql: str | None = None):
    def register(fn):
        QUERIES[name] = fn
        if sql is not None:
            SQL[name] = sql
        return fn

    return register


_STOPS = ", ".join(f"'{w}'" for w in sorted({w for words in rules.STOP_WORDS.values() for w in words.split()}))


@query(
    "op7_quality_rules",
    rf"""
    WITH d AS (SELECT row_number() OVER () AS r, doc_id, coalesce(text, '') AS text FROM documents),
    t AS (SELECT r, doc_id, text, regexp_extract_all(text, '[^\x20\x09-\x0D]+') AS w,
                 list_filter(string_split(text, chr(10)), lambda x: regexp_matches(x, '[^\x20\x09-\x0D]')) AS l FROM d),
    win AS (SELECT r, i, array_to_string(w[i:i + 4], ' ') AS v FROM (SELECT r, w, unnest(range(1, len(w) - 3)) AS i FROM t)),
    rep AS (SELECT r, i FROM win QUALIFY count(*) OVER (PARTITION BY r, v) > 1),
    cov AS (SELECT r, count(DISTINCT i + k) AS n FROM rep, range(5) AS o(k) GROUP BY r),
    m AS (SELECT doc_id, len(w) AS n_words, length(array_to_string(w, '')) AS word_chars,
                 len(regexp_extract_all(text, '[#*$%&|<>]')) AS n_symbols, len(l) - len(list_distinct(l)) AS n_dup_lines,
                 coalesce(cov.n, 0) AS n_repeat_words, len(list_filter(w, lambda x: lower(x) IN ({_STOPS}))) AS stops, len(l) AS lines,
                 2 * length(regexp_replace(text, '[^\p{{Latin}}]+', '', 'g')) >= length(regexp_replace(text, '[^\p{{L}}]+', '', 'g')) AS latin,
                 len(list_filter(l, lambda x: regexp_matches(x, '^[\x20\x09-\x0D]*[-*' || chr(8226) || ']'))) AS bullets,
                 len(list_filter(l, lambda x: regexp_matches(x, '(\.\.\.|' || chr(8230) || ')[\x20\x09-\x0D]*$'))) AS dots
          FROM t LEFT JOIN cov USING (r)),
    b AS (SELECT *, n_words < 10 OR 100 * n_repeat_words > 20 * n_words AS base_failed FROM m)
    SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed,
           NOT base_failed AND word_chars / n_words BETWEEN 2 AND 14 AND n_symbols / n_words <= 0.3
             AND (n_words < 50 OR stops / n_words >= 0.02 OR NOT latin)
             AND coalesce(n_dup_lines / nullif(lines, 0) <= 0.5 AND bullets / nullif(lines, 0) <= 0.9
                          AND dots / nullif(lines, 0) <= 0.5, TRUE) AS kept
    FROM b
    """,
)
def op7_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    judged = rules.judge(table(spark, sf_dir, "documents").select("doc_id", "text"))
    return judged.drop("broken_rules")


@query(
    "op8_fixed_slots",
    """
    WITH RECURSIVE tbl AS (SELECT list_transform(range(256), lambda n: list_reduce(list_concat([n], range(8)),
                                  lambda c, b: CASE WHEN c & 1 = 1 THEN xor(c >> 1, 3988292384) ELSE c >> 1 END)) AS x),
    b AS (SELECT doc_id, octet_length(encode(coalesce(text, ''))) + 16 AS size,
                 ('0x' || substr(md5(coalesce(doc_id::VARCHAR, '')), 1, 8))::BIGINT % 8192 AS vslot,
                 list_concat([4294967295::BIGINT], list_transform(regexp_extract_all(hex(encode(coalesce(text, ''))), '..'), lambda h: ('0x' || h)::BIGINT)) AS bytes
          FROM documents),
    d AS (SELECT doc_id, size, vslot, xor(list_reduce(bytes, lambda c, v: xor(c >> 8, x[(xor(c, v) & 255) + 1])), 4294967295) AS text_crc32 FROM b, tbl),
    s AS (SELECT vslot, total, row_number() OVER (ORDER BY total DESC, vslot) AS k FROM (SELECT vslot, sum(size)::BIGINT AS total FROM d GROUP BY vslot)),
    g AS (SELECT 0::BIGINT AS k, -1::BIGINT AS vslot, -1::BIGINT AS shard, list_transform(range(40), lambda i: 0::BIGINT) AS loads
          UNION ALL
          SELECT s.k, s.vslot, list_position(loads, list_min(loads)) - 1,
                 list_transform(loads, lambda v, i: v + CASE WHEN i = list_position(loads, list_min(loads)) THEN total ELSE 0 END)
          FROM g JOIN s ON s.k = g.k + 1)
    SELECT doc_id, size, text_crc32, 'bytes' AS law, shard::INTEGER AS shard,
           row_number() OVER (PARTITION BY shard ORDER BY vslot, doc_id, size, text_crc32) - 1 AS slot, NULL::INTEGER AS grown_shard
    FROM d JOIN g USING (vslot)
    """,
)
def op8_fixed_slots(spark: SparkSession, sf_dir: str) -> DataFrame:
    placed = slots.shard(table(spark, sf_dir, "documents").select("doc_id", "text"))
    return placed.select(
        "doc_id", "size", "text_crc32", F.lit("bytes").alias("law"), "shard", "slot", F.lit(None).cast("int").alias("grown_shard")
    )


_WORDS = (
    "regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), "
    r"'[^\x00-\x2F\x3A-\x60\x7B-\x7F]+')"
)


@query(
    "op1_fm_index_decontamination",
    f"""
    WITH b AS (SELECT coalesce(item_id::VARCHAR, 'null') AS item, {_WORDS} AS w FROM benchmark),
    s AS (SELECT DISTINCT item, list_slice(w, i, i + 12) AS v
          FROM (SELECT item, w, unnest(range(1, greatest(len(w) - 11, 2))) AS i FROM b WHERE len(w) > 0)),
    d AS (SELECT row_number() OVER () AS r, doc_id, coalesce({_WORDS}, []) AS w FROM documents),
    lens AS (SELECT DISTINCT len(v) AS n FROM s),
    win AS (SELECT r, i, list_slice(w, i, i + n - 1) AS v, n
            FROM (SELECT r, w, n, unnest(range(1, len(w) - n + 2)) AS i FROM d, lens WHERE len(w) >= n)),
    hit AS (SELECT r, i, n, item FROM win JOIN s USING (v)),
    cov AS (SELECT r, count(DISTINCT i + k) AS n FROM hit, range(13) AS o(k) WHERE k < n GROUP BY r),
    its AS (SELECT r, count(DISTINCT item) AS n, string_agg(DISTINCT item, ',' ORDER BY item) AS l FROM hit GROUP BY r)
    SELECT doc_id, len(w) AS n_words, coalesce(cov.n, 0) AS n_hit, coalesce(its.n, 0) AS n_items,
           sha256(coalesce(its.l, '')) AS items_sha256, coalesce(cov.n, 0) > 0 AND 20 * coalesce(cov.n, 0) >= len(w) AS contaminated
    FROM d LEFT JOIN cov USING (r) LEFT JOIN its USING (r)
    """,
)
def op1_fm_index_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = decontaminate.find(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"), keep=["doc_id"])
    return found.select("doc_id", "n_words", "n_hit", "n_items", "items_sha256", "contaminated")


@query(
    "op2_salvaged_warc",
    """
    WITH p AS (SELECT page_id, octet_length(encode(coalesce(html, ''))) AS payload_bytes, sha256(coalesce(html, '')) AS payload_digest FROM pages),
    g AS (SELECT payload_digest, min(page_id) AS first FROM p WHERE payload_bytes >= 100 GROUP BY 1)
    SELECT page_id, payload_bytes, payload_digest, CASE WHEN page_id <> first THEN 'revisit' ELSE 'response' END AS record_type,
           CASE WHEN page_id <> first THEN first END AS refers_to
    FROM p LEFT JOIN g USING (payload_digest)
    """,
)
def op2_salvaged_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = scratch(spark, "warc")
    warc.write_archives(table(spark, sf_dir, "pages"), path)
    read = warc.read_archives(spark, path, keep_payload=False).filter("kind = 'record'")
    return read.select(
        warc.number("id").alias("page_id"), "payload_bytes", "payload_digest", F.col("type").alias("record_type"), warc.number("refers_to").alias("refers_to")
    )


@query("op10_deletion_variant_simhash")
def op10_deletion_variant_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    return simhash.near_duplicates(table(spark, sf_dir, "documents"))


@query("op9_hierarchical_language")
def op9_hierarchical_language(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text", "lang")
    found = language.identify(docs, language.fit(docs), keep=["doc_id"])
    return found.select("doc_id", language.held_out(F.col("doc_id")).alias("held_out"), "lang_pred", "score")


@query("op6_weak_label_quality")
def op6_weak_label_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    return weaklabels.judge(docs, weaklabels.fit(docs), keep=["doc_id"])


@query("op4_sentencepiece_tokenizers")
def op4_sentencepiece_tokenizers(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    return pieces.encode(docs, pieces.read_model(pieces.MODEL_FILE), keep=["doc_id"], results="digests")


def _licence_words(text: str) -> str:
    """SQL for the normalised words of a line."""
    words = f"regexp_extract_all(translate({text}, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+')"
    spelt = f"list_transform({words}, lambda x: CASE x WHEN 'licence' THEN 'license' WHEN 'licenced' THEN 'licensed' WHEN 'licences' THEN 'licenses' ELSE x END)"
    return f"CASE WHEN ({words})[1] IN ('copyright', chr(169)) THEN [] ELSE {spelt} END"


_PAIRS = "list_distinct(list_transform(range(1, len(w)), lambda i: w[i] || ' ' || w[i + 1]))"
_TEMPLATES = ", ".join("('{}', '{}')".format(n, t.replace("'", "''")) for n, t in licences.TEMPLATES)


@query(
    "op3_dice_licences",
    rf"""
    WITH d AS (SELECT row_number() OVER () AS r, doc_id, string_split(coalesce(text, ''), chr(10)) AS lines FROM documents),
    l AS (SELECT r, i, {_licence_words("x")} AS w, regexp_matches(x, '[^\x20\x09-\x0D]') AS filled
          FROM (SELECT r, unnest(lines) AS x, unnest(range(len(lines))) AS i FROM d)),
    b AS (SELECT *, count(*) FILTER (NOT filled) OVER (PARTITION BY r ORDER BY i) AS k FROM l),
    u AS (SELECT r, w FROM l UNION SELECT r, flatten(list(w ORDER BY i)) FROM b WHERE filled GROUP BY r, k
          UNION SELECT r, flatten(list(w ORDER BY i)) FROM l WHERE filled GROUP BY r),
    n AS (SELECT r, count(*) AS n_units FROM u WHERE len(w) > 0 GROUP BY r),
    p AS (SELECT r, row_number() OVER () AS unit, {_PAIRS} AS s FROM u WHERE len(w) > 1),
    t AS (SELECT name, row_number() OVER () AS tpl, {_PAIRS} AS s FROM (SELECT name, {_licence_words("body")} AS w FROM (VALUES {_TEMPLATES}) AS v(name, body))),
    shared AS (SELECT r, unit, name, tpl, len(any_value(p.s)) AS a, len(any_value(t.s)) AS b, count(*) AS c
               FROM (SELECT *, unnest(s) AS g FROM p) AS p JOIN (SELECT *, unnest(s) AS g FROM t) AS t USING (g) GROUP BY r, unit, name, tpl),
    hit AS (SELECT r, name, max(2 * c / (a + b)) AS dice FROM shared WHERE 2 * c / (a + b) >= 0.8 GROUP BY r, name),
    best AS (SELECT r, first(name ORDER BY dice DESC, name) AS licence, max(dice) AS dice, string_agg(name, ',' ORDER BY name) AS licences FROM hit GROUP BY r)
    SELECT doc_id, licence, coalesce(dice, 0.0::DOUBLE) AS dice, coalesce(licences, '') AS licences, coalesce(n_units, 0) AS n_units
    FROM d LEFT JOIN best USING (r) LEFT JOIN n USING (r)
    """,
)
def op3_dice_licences(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = licences.scan(table(spark, sf_dir, "documents"), keep=["doc_id"])
    return found.withColumn("licences", F.array_join("licences", ","))


@query("op5_cross_entropy_difference")
def op5_cross_entropy_difference(spark: SparkSession, sf_dir: str) -> DataFrame:
    good = table(spark, sf_dir, "labels").groupBy("doc_id").agg(F.min((F.col("quality") == 1) & (F.col("toxic") == 0)).alias("target"))
    docs = table(spark, sf_dir, "documents").select("doc_id", "text").join(good.hint("merge"), "doc_id", "left")
    # Labels grow with the texts: always a merge join.
    docs = docs.withColumn("target", F.coalesce("target", F.lit(False)))
    return crossentropy.score(docs, crossentropy.fit(docs, keep=["doc_id"]), keep=["doc_id"])


def _lloyd_sql() -> str:
    """One assignment and one update for each round, over vectors of integers."""
    parts = [
        f"""i AS MATERIALIZED (
            SELECT row_number() OVER () AS r, vec_id, list_transform(embedding, lambda x: floor({lloyd.SCALE} * x::DOUBLE)::BIGINT) AS v
            FROM embeddings WHERE len(embedding) = 64
              AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0)""",
        f"""c0 AS MATERIALIZED (
            SELECT row_number() OVER (ORDER BY sha256('{lloyd.SEED}:' || coalesce(vec_id::VARCHAR, '')), v) - 1 AS k, v FROM i
            QUALIFY k < {lloyd.CLUSTERS})""",
    ]
    for n in range(lloyd.ROUNDS + 1):
        parts.append(
            f"""a{n} AS MATERIALIZED (
            SELECT r, vec_id, i.v, k, d FROM (
              SELECT i.r, i.vec_id, i.v, c.k, list_sum(list_transform(range(1, 65), lambda j: (i.v[j] - c.v[j]) * (i.v[j] - c.v[j])))::BIGINT AS d
              FROM i, c{n} AS c) AS i QUALIFY row_number() OVER (PARTITION BY r ORDER BY d, k) = 1)"""
        )
        if n < lloyd.ROUNDS:
            parts.append(
                f"""c{n + 1} AS MATERIALIZED (
            SELECT k, coalesce(u.v, c.v) AS v FROM c{n} AS c LEFT JOIN (
              SELECT k, list(m ORDER BY j) AS v FROM (
                SELECT k, j, (s // n - CASE WHEN s % n < 0 THEN 1 ELSE 0 END)::BIGINT AS m FROM (
                  SELECT k, j, sum(x)::BIGINT AS s, count(*) AS n FROM (
                    SELECT k, unnest(v) AS x, unnest(range(64)) AS j FROM a{n}) GROUP BY k, j)) GROUP BY k) AS u USING (k))"""
            )
    last = lloyd.ROUNDS
    return f"""
    WITH {", ".join(parts)}
    SELECT vec_id, k::INTEGER AS cluster, d AS distance, (sum(d) OVER (PARTITION BY k))::BIGINT AS cluster_inertia,
           (sum(d) OVER ())::BIGINT AS inertia, sha256(array_to_string(c.v, ',')) AS centroid_sha256
    FROM a{last} JOIN c{last} AS c USING (k)
    """


@query("op11_dimension_sharded_lloyd", _lloyd_sql())
def op11_dimension_sharded_lloyd(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = lloyd.cluster(table(spark, sf_dir, "embeddings"), dimensions=64)
    return lloyd.with_inertia(found).withColumnRenamed("id", "vec_id")


@query(
    "op12_sparse_matrix_audit",
    r"""
    WITH RECURSIVE t AS (SELECT row_number() OVER () AS r, doc_id, coalesce(source, '') AS part, coalesce(text, '') AS text FROM documents),
    w AS (SELECT *, regexp_extract_all(text, '[^\x20\x09-\x0D]+') AS w, min(doc_id) OVER (PARTITION BY text) AS first FROM t),
    l AS (SELECT doc_id, coalesce(bool_or(quality = 1), FALSE) AS good, coalesce(bool_or(toxic = 1), FALSE) AS toxic FROM labels GROUP BY doc_id),
    d AS (SELECT r, part, coalesce(good, FALSE) AS good, coalesce(toxic, FALSE) AS toxic,
                 concat(CASE WHEN len(w) < 200 THEN 'A' END, CASE WHEN 100 * len(list_distinct(w)) < 50 * len(w) THEN 'B' END,
                        CASE WHEN 100 * len(regexp_extract_all(text, '[A-Z]')) > 2 * length(text) THEN 'C' END,
                        CASE WHEN regexp_matches(text, '[#$%&*|]') THEN 'D' END, CASE WHEN doc_id > first THEN 'E' END) AS failed
          FROM w LEFT JOIN l USING (doc_id)),
    p AS (SELECT '' AS o UNION ALL SELECT o || f FROM p, unnest(['A', 'B', 'C', 'D', 'E']) AS u(f) WHERE NOT contains(o, f)),
    s AS (SELECT o, step::INTEGER AS step, substr(o, step, 1) AS own, substr(o, 1, step - 1) AS before FROM p, range(1, 6) AS u(step) WHERE length(o) = 5),
    g AS (SELECT part, failed, count(*) AS n, count_if(good) AS good, count_if(toxic) AS toxic FROM d GROUP BY part, failed),
    x AS (SELECT part, o, step, own, n, good, toxic, failed, contains(failed, own) AS hit, translate(failed, before, '') <> failed AS gone FROM g, s),
    y AS (SELECT part, o, step, own, sum(n) FILTER (NOT hit AND NOT gone) AS kept, sum(n) FILTER (hit AND NOT gone) AS removed,
                 sum(n) FILTER (hit AND gone) AS redundant, sum(n) FILTER (failed = own) AS unique_fails,
                 sum(good) FILTER (hit AND NOT gone) AS good_lost, sum(toxic) FILTER (hit AND NOT gone) AS toxic_lost
          FROM x GROUP BY part, o, step, own)
    SELECT part, o AS filter_order, step, coalesce(kept, 0)::BIGINT AS kept, coalesce(removed, 0)::BIGINT AS removed,
           coalesce(redundant, 0)::BIGINT AS redundant, coalesce(unique_fails, 0)::BIGINT AS unique_fails,
           coalesce(good_lost, 0)::BIGINT AS good_lost, coalesce(toxic_lost, 0)::BIGINT AS toxic_lost,
           (sum(coalesce(removed, 0)) OVER (PARTITION BY part, own))::BIGINT AS shapley
    FROM y
    """,
)
def op12_sparse_matrix_audit(spark: SparkSession, sf_dir: str) -> DataFrame:
    return interactions.audit(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


def _broken_up(text: str) -> str:
    for plain, safe in chat.BROKEN_UP:
        text = f"replace({text}, '{plain}', '{safe}')"
    return text


@query(
    "op13_relational_chats",
    rf"""
    WITH c AS (SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations
               UNION ALL VALUES (-7, 0, 'user', '\### Assistant: </turn> ok'), (-7, 1, 'assistant', '\### Assistant: </turn> ok')),
    e AS (SELECT *, role IS DISTINCT FROM lag(role) OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, role, text) AS opens,
                 length({_broken_up("text")}) AS n, length(replace({_broken_up("role")}, ': ', ':\ ')) AS r FROM c)
    SELECT conv_id, count(*) AS n_turns,
           sha256(string_agg(role || chr(10) || text || chr(10), '' ORDER BY turn NULLS FIRST, role, text)) AS turns_sha256,
           coalesce(sum(length(text)) FILTER (role = 'assistant'), 0)::BIGINT AS loss_chars,
           sha256(coalesce(string_agg(text, '' ORDER BY turn NULLS FIRST, role, text) FILTER (role = 'assistant'), '')) AS loss_sha256,
           sum(n + CASE WHEN opens THEN r + {len(chat.HEADER + chat.HEADER_END + chat.END)} ELSE {len(chat.NEXT)} END)::BIGINT AS formatted_chars
    FROM e GROUP BY conv_id
    """,
)
def op13_relational_chats(spark: SparkSession, sf_dir: str) -> DataFrame:
    odd = spark.range(2).select(
        F.lit(-7).cast("long").alias("conv_id"),
        F.col("id").alias("turn"),
        F.when(F.col("id") == 0, "user").otherwise("assistant").alias("role"),
        F.lit("\\### Assistant: </turn> ok").alias("text"),
    )
    chats = table(spark, sf_dir, "conversations").select("conv_id", "turn", "role", "text").unionByName(odd)
    made = chat.format_chats(chats)
    turns, texts = chat.read_turns(F.col("formatted")), chat.read_loss_texts(F.col("formatted"), F.col("loss_spans"))
    said = F.array_join(F.transform("turns", lambda t: F.concat(t["role"], F.lit("\n"), t["text"], F.lit("\n"))), "")
    return made.select(
        "conv_id", turns.alias("turns"), F.array_join(texts, "").alias("loss"), F.char_length("formatted").alias("chars")
    ).select(
        "conv_id",
        F.size("turns").cast("long").alias("n_turns"),
        F.sha2(said, 256).alias("turns_sha256"),
        F.char_length("loss").cast("long").alias("loss_chars"),
        F.sha2("loss", 256).alias("loss_sha256"),
        F.col("chars").cast("long").alias("formatted_chars"),
    )


QUERIES["pipeline"] = corpus_pipeline.run
if corpus_pipeline.ORACLE_SQL is not None:
    SQL["pipeline"] = corpus_pipeline.ORACLE_SQL
