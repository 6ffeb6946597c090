"""The registered queries of the operators, and the SQL of those that have one."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from truegrain.llm import (
    chat_format, decontaminate, divergence, exact_dedup, language_id, mixing, packing, pii, quality, simhash, spelling,
    substring_dedup, topk,
)


def _table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def op1_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    groups = exact_dedup.exact_groups(_table(spark, sf_dir, "documents"))
    return groups.select("doc_id", "keep_id", "group_size", "kept", "text_sha256")


def op2_chat_formatting(spark: SparkSession, sf_dir: str) -> DataFrame:
    return chat_format.repair(_table(spark, sf_dir, "conversations"))


def op3_quality_classifier(spark: SparkSession, sf_dir: str) -> DataFrame:
    scores = quality.scored(_table(spark, sf_dir, "documents"), _table(spark, sf_dir, "labels"))
    return scores.select("doc_id", "held_out", "score", "predicted")


def op4_best_fit_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.pack(_table(spark, sf_dir, "documents"))


def op5_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    kept = substring_dedup.remove_repeats(_table(spark, sf_dir, "documents"))
    return kept.select("doc_id", "n_words", "n_removed", "kept_sha256")


def op6_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    mix = mixing.mix(_table(spark, sf_dir, "documents"))
    return mix.select("doc_id", "size", "source_size", "target", "taken")


def op7_exact_topk(spark: SparkSession, sf_dir: str) -> DataFrame:
    asks = F.col("vec_id") % topk.QUERY_EVERY == 0
    return topk.top_k(_table(spark, sf_dir, "embeddings"), asks)


def op8_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    return language_id.identify(_table(spark, sf_dir, "pages"), _table(spark, sf_dir, "documents"))


def op9_simhash_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    groups = simhash.near_groups(_table(spark, sf_dir, "documents"))
    return groups.select("doc_id", "fingerprint", "component_id")


def op10_pii(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = pii.personal_data(_table(spark, sf_dir, "documents"))
    return found.select(
        "doc_id",
        *(f"n_{kind}" for kind in pii.KINDS),
        F.sha2(pii.joined("base"), 256).alias("base_sha256"),
        pii.joined("spans").alias("spans"),
    )


def op11_source_divergence_audit(spark: SparkSession, sf_dir: str) -> DataFrame:
    return divergence.audit(_table(spark, sf_dir, "documents"))


def op12_spelling_variants(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spelling.variants(_table(spark, sf_dir, "documents"))


def op13_benchmark_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = decontaminate.contamination(_table(spark, sf_dir, "documents"), _table(spark, sf_dir, "benchmark"))
    return decontaminate.report(found)


QUERIES = {
    "op1_exact_dedup": op1_exact_dedup,
    "op2_chat_formatting": op2_chat_formatting,
    "op3_quality_classifier": op3_quality_classifier,
    "op4_best_fit_packing": op4_best_fit_packing,
    "op5_substring_dedup": op5_substring_dedup,
    "op6_mixing": op6_mixing,
    "op7_exact_topk": op7_exact_topk,
    "op8_language_id": op8_language_id,
    "op9_simhash_near_dedup": op9_simhash_near_dedup,
    "op10_pii": op10_pii,
    "op11_source_divergence_audit": op11_source_divergence_audit,
    "op12_spelling_variants": op12_spelling_variants,
    "op13_benchmark_decontamination": op13_benchmark_decontamination,
}

#: Unlike Python's or Spark's, DuckDB's ``\s`` class is not used: the white space is named.
ORACLE = {
    "op1_exact_dedup": r"""
        WITH norm AS (
            SELECT doc_id, sha256(regexp_replace(coalesce(text, ''), '[\x20\x09-\x0D]+', ' ', 'g')) AS text_sha256
            FROM documents
        )
        SELECT doc_id,
               min(doc_id) OVER same AS keep_id,
               count(*) OVER same AS group_size,
               doc_id = min(doc_id) OVER same AS kept,
               text_sha256
        FROM norm
        WINDOW same AS (PARTITION BY text_sha256)
    """,
    "op5_substring_dedup": r"""
        WITH words AS (
            SELECT doc_id, regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS w FROM documents
        ),
        windows AS (
            SELECT doc_id, i, array_to_string(w[i:i + 12], ' ') AS k
            FROM words, unnest(range(1, len(w) - 11)) AS t(i)
        ),
        repeated AS (SELECT k, min(doc_id) AS first_id FROM windows GROUP BY k HAVING count(DISTINCT doc_id) > 1),
        gone AS (
            SELECT DISTINCT doc_id, i + j AS place
            FROM windows JOIN repeated USING (k), unnest(range(0, 13)) AS t(j)
            WHERE first_id < doc_id
        ),
        placed AS (SELECT doc_id, i AS place, w[i] AS word FROM words, unnest(range(1, len(w) + 1)) AS t(i)),
        kept AS (
            SELECT doc_id, string_agg(word, ' ' ORDER BY place) AS kept, count(*) AS n
            FROM placed ANTI JOIN gone USING (doc_id, place) GROUP BY doc_id
        )
        SELECT doc_id,
               CAST(len(w) AS BIGINT) AS n_words,
               CAST(len(w) - coalesce(n, 0) AS BIGINT) AS n_removed,
               sha256(coalesce(kept, '')) AS kept_sha256
        FROM words LEFT JOIN kept USING (doc_id)
    """,
    "op7_exact_topk": """
        WITH v AS (
            SELECT vec_id, list_transform(embedding, lambda x: CAST(floor(64 * CAST(x AS DOUBLE)) AS BIGINT)) AS c
            FROM embeddings
        ),
        scores AS (
            SELECT q.vec_id AS query_id, v.vec_id,
                   CAST(list_inner_product(CAST(q.c AS DOUBLE[]), CAST(v.c AS DOUBLE[])) AS BIGINT) AS score
            FROM v AS q, v WHERE q.vec_id % 20 = 0 AND v.vec_id <> q.vec_id
        )
        SELECT query_id, CAST(row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS INTEGER) AS rank,
               vec_id, score
        FROM scores
        QUALIFY row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) <= 20
    """,
    "op11_source_divergence_audit": r"""
        WITH docs AS (
            SELECT row_number() OVER () AS r, coalesce(lang, '') AS lang, coalesce(source, '') AS source,
                   translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS text
            FROM documents
        ),
        found AS (
            SELECT r, lang, source, unnest(regexp_extract_all(text, '[^\x00-\x40\x5B-\x60\x7B-\x7F]+')) AS term FROM docs
        ),
        kept AS (SELECT lang, term, count(*) AS n FROM found GROUP BY ALL HAVING count(DISTINCT r) >= 10),
        used AS (
            SELECT lang, source, term, count(*) AS n FROM found SEMI JOIN kept USING (lang, term) GROUP BY ALL
        ),
        langs AS (SELECT lang, count(*) AS v, sum(n) AS total FROM kept GROUP BY lang),
        grp AS (
            SELECT lang, source, coalesce(sum(n), 0) AS total
            FROM (SELECT DISTINCT lang, source FROM docs) LEFT JOIN used USING (lang, source) GROUP BY ALL
        ),
        p AS (
            SELECT g.lang, g.source, k.term, coalesce(u.n, 0) AS n,
                   1 + 1000000000 * (coalesce(u.n, 0) + 2)::HUGEINT // (g.total + 2 * v)::HUGEINT AS p,
                   1 + 1000000000 * (k.n + 2)::HUGEINT // (l.total + 2 * v)::HUGEINT AS q
            FROM grp AS g JOIN langs AS l USING (lang) JOIN kept AS k USING (lang)
            LEFT JOIN used AS u ON u.lang = g.lang AND u.source = g.source AND u.term = k.term
        ),
        sums AS (
            SELECT a.lang, a.source, b.source AS item, sum((a.p - b.p) * (a.p - b.p) // (a.p + b.p)) AS value
            FROM p AS a JOIN p AS b ON a.lang = b.lang AND a.term = b.term AND a.source <> b.source GROUP BY ALL
        ),
        pairs AS (
            SELECT a.lang, a.source, 'pair' AS part, b.source AS item, coalesce(s.value, 0) AS value
            FROM grp AS a JOIN grp AS b ON a.lang = b.lang AND a.source <> b.source
            LEFT JOIN sums AS s ON s.lang = a.lang AND s.source = a.source AND s.item = b.source
        ),
        terms AS (
            SELECT lang, source, 'term' AS part, term AS item, (p - q) * (p - q) // (p + q) AS value
            FROM p WHERE n > 0 AND p > q
        )
        SELECT lang, source, part, item, CAST(value AS BIGINT) AS value,
               CAST(row_number() OVER (PARTITION BY lang, source, part ORDER BY value DESC, item) AS INTEGER) AS rank
        FROM (SELECT * FROM pairs UNION ALL SELECT * FROM terms)
        QUALIFY part = 'pair' OR rank <= 10
    """,
    "op13_benchmark_decontamination": r"""
        WITH docs AS (
            SELECT row_number() OVER () AS r, doc_id, regexp_extract_all(
                translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w
            FROM documents
        ),
        items AS (
            SELECT coalesce(CAST(item_id AS VARCHAR), '') AS item_id, regexp_extract_all(
                translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w
            FROM benchmark
        ),
        windows AS (
            SELECT DISTINCT item_id, least(len(w), 10) AS n, array_to_string(w[i:i + 9], ' ') AS k
            FROM items, unnest(range(1, greatest(len(w) - 9, 1) + 1)) AS t(i) WHERE len(w) > 0
        ),
        met AS (
            SELECT r, i, n, array_to_string(w[i:i + n - 1], ' ') AS k
            FROM docs, (SELECT DISTINCT n FROM windows), unnest(range(1, len(w) - n + 2)) AS t(i)
        ),
        hit AS (SELECT r, i, n, item_id FROM met JOIN windows USING (n, k)),
        places AS (
            SELECT r, count(DISTINCT i + j) AS n_hit FROM hit, unnest(range(0, n)) AS t(j) GROUP BY r
        ),
        of AS (SELECT r, string_agg(item_id, ',' ORDER BY item_id) AS ids, count(*) AS n FROM (SELECT DISTINCT r, item_id FROM hit) GROUP BY r)
        SELECT doc_id, CAST(len(w) AS BIGINT) AS n_words, CAST(coalesce(n_hit, 0) AS BIGINT) AS n_hit,
               CAST(coalesce(of.n, 0) AS BIGINT) AS n_items, sha256(coalesce(ids, '')) AS items_sha256,
               coalesce(n_hit, 0) > 0 AS contaminated
        FROM docs LEFT JOIN places USING (r) LEFT JOIN of USING (r)
    """,
}
