"""The registered queries of this package on the test tables, and their SQL."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from skylog.llm import (
    alignment, bpe, exact_dedup, licenses, merkle, mixing, pii_crf, probminhash, simple8b, suffix_dedup, toxicity, vector_forest, warc,
)
from skylog.llm.common import scratch_path, table


def op1_simple8b(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = scratch_path(spark, "tokens")
    simple8b.write_tokens(table(spark, sf_dir, "documents"), path, public_tokenizers.path("byte_bpe_50k.json"))
    return simple8b.token_checksums(spark, path)


def op2_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return exact_dedup.exact_dedup(table(spark, sf_dir, "documents"))


def op3_forest(spark: SparkSession, sf_dir: str) -> DataFrame:
    return vector_forest.near_vectors(table(spark, sf_dir, "embeddings"))


def op4_pii_crf(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pii_crf.personal_data_digest(pii_crf.find_personal_data(table(spark, sf_dir, "documents")))


def op5_probminhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    return probminhash.near_duplicates(table(spark, sf_dir, "documents"))


def op6_licenses(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = licenses.recognise(table(spark, sf_dir, "documents"))
    return found.withColumn("licences", F.array_join("licences", ","))


def op7_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    return bpe.round_trip_digests(table(spark, sf_dir, "documents"), public_tokenizers.path("word_bpe_49k.json"))


def op8_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    model = toxicity.train(toxicity.learning_rows(docs, table(spark, sf_dir, "labels")))
    return toxicity.score_documents(docs, model)


def op9_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    lines = mixing.copies(table(spark, sf_dir, "documents"))
    return lines.select("doc_id", "size", "source_size", "target", (F.col("copies") * F.col("size")).alias("taken"))


def op10_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    return warc.archive_round_trip(table(spark, sf_dir, "pages"))


def op11_merkle(spark: SparkSession, sf_dir: str) -> DataFrame:
    return merkle.manifest(table(spark, sf_dir, "documents"))


def op12_alignment(spark: SparkSession, sf_dir: str) -> DataFrame:
    return alignment.alignment(
        table(spark, sf_dir, "documents"), public_tokenizers.path("byte_bpe_50k.json"), public_tokenizers.path("piece_bpe_32k.model")
    )


def op13_suffix_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return suffix_dedup.remove_repeats(table(spark, sf_dir, "documents"))


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    f.__name__: f
    for f in (
        op1_simple8b, op2_exact_dedup, op3_forest, op4_pii_crf, op5_probminhash, op6_licenses, op7_bpe, op8_toxicity, op9_mixing, op10_warc,
        op11_merkle, op12_alignment, op13_suffix_dedup,
    )
}

ORACLES = {
    "op2_exact_dedup": """
        WITH t AS (
            SELECT doc_id, sha256(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')) AS text_sha256
            FROM documents)
        SELECT doc_id, max(doc_id) OVER w AS keep_id, count(*) OVER w AS group_size,
               row_number() OVER (PARTITION BY text_sha256 ORDER BY doc_id DESC NULLS LAST) = 1 AS kept, text_sha256
        FROM t WINDOW w AS (PARTITION BY text_sha256)
    """,
    "op3_forest": """
        WITH RECURSIVE n AS (
            SELECT vec_id, label, embedding::DOUBLE[] AS v FROM embeddings
            WHERE label IS NOT NULL AND vec_id IS NOT NULL AND len(embedding) > 0
              AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
              AND len(list_filter(embedding, lambda x: x <> 0)) > 0),
        l AS (SELECT a.vec_id AS x, b.vec_id AS y FROM n a JOIN n b ON a.label = b.label AND a.vec_id <> b.vec_id AND len(a.v) = len(b.v)
              WHERE list_cosine_similarity(a.v, b.v) >= 0.98::DOUBLE),
        r AS (SELECT x, y FROM l UNION SELECT r.x, l.y FROM r JOIN l ON r.y = l.x),
        c AS (SELECT x, min(least(x, y)) AS component_id FROM r GROUP BY x),
        k AS (SELECT x, count(DISTINCT y) AS n_links FROM l GROUP BY x)
        SELECT e.vec_id, coalesce(k.n_links, 0) AS n_links, coalesce(c.component_id, e.vec_id) AS component_id,
               coalesce(c.component_id, e.vec_id) = e.vec_id AS kept
        FROM embeddings e LEFT JOIN k ON k.x = e.vec_id LEFT JOIN c ON c.x = e.vec_id
    """,
    "op6_licenses": licenses.oracle_sql(),
    "op9_mixing": """
        WITH d AS (
            SELECT doc_id, source, len(regexp_extract_all(coalesce(text, ''), '[^\\x20\\x09-\\x0D]+')) AS size,
                   substr(md5(coalesce(doc_id::VARCHAR, '')), 1, 1) AS salt FROM documents),
        c AS (SELECT *, length(bin(size)) AS bits FROM d),
        k AS (SELECT *, bits * 32 + (size >> greatest(bits - 5, 0)) AS class FROM c),
        s AS (SELECT source, sum(size)::BIGINT AS source_size FROM k GROUP BY source),
        w AS (SELECT *, [5.0::DOUBLE, 2.0::DOUBLE, 1.0::DOUBLE][(row_number() OVER (ORDER BY source ASC NULLS LAST) - 1) % 3 + 1] AS weight,
                     (source_size * 3)::DOUBLE AS lim FROM s),
        l AS (SELECT *, (sum(source_size::DOUBLE) OVER () - coalesce(sum(lim) OVER b, 0)) / (sum(weight) OVER () - coalesce(sum(weight) OVER b, 0)) AS lev
              FROM w WINDOW b AS (ORDER BY lim / weight, source ASC NULLS LAST ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)),
        f AS (SELECT *, weight * lev > lim AS full_up FROM l),
        t AS (SELECT source, source_size, CASE WHEN full_up THEN lim ELSE least(weight * max(lev) FILTER (NOT full_up) OVER (), lim) END AS target FROM f),
        p AS (SELECT k.doc_id, k.source, k.size::BIGINT AS size, t.source_size, t.target,
                     row_number() OVER (PARTITION BY k.source ORDER BY k.class, k.salt, k.size, k.doc_id NULLS FIRST) AS place,
                     CASE WHEN t.source_size > 0 THEN t.target / t.source_size ELSE 0.0::DOUBLE END AS rate,
                     ('0x' || substr(md5('mix:' || coalesce('=' || k.source, '')), 1, 8))::BIGINT / 4294967296.0::DOUBLE AS off
              FROM k JOIN t ON k.source IS NOT DISTINCT FROM t.source)
        SELECT doc_id, size, source_size, target,
               (least(floor(place * rate + off) - floor((place - 1) * rate + off), 3) * size)::BIGINT AS taken
        FROM p
    """,
    "op10_warc": """
        WITH p AS (SELECT page_id, coalesce(html, '') AS html FROM pages),
        r AS (SELECT page_id, strlen(html) AS n, sha1(html) AS digest,
                     max(page_id) OVER (PARTITION BY html) AS keep,
                     row_number() OVER (PARTITION BY html ORDER BY page_id DESC NULLS LAST) AS place FROM p)
        SELECT page_id, n::BIGINT AS payload_bytes, digest AS payload_digest,
               CASE WHEN n >= 1000 AND place > 1 THEN 'revisit' ELSE 'response' END AS record_type,
               CASE WHEN n >= 1000 AND place > 1 THEN keep END AS refers_to
        FROM r
    """,
    "op11_merkle": merkle.oracle_sql(),
}
