"""The queries of this subpackage, each over its whole table, with their SQL where SQL can express them."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from pagecraft.llm import exact_dedup, fingerprints, langid, lm, minhash_dedup, mixing, pii, secrets, spm, toxicity
from pagecraft.llm.common import table


def op1_secrets(spark: SparkSession, sf_dir: str) -> DataFrame:
    return secrets.report(table(spark, sf_dir, "documents"))


def op2_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    return langid.predicted(docs, langid.learn_rule(F.col("doc_id")))


def op3_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return exact_dedup.decisions(table(spark, sf_dir, "documents"))


def op4_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mixing.mixed(table(spark, sf_dir, "documents")).drop("source")


def op5_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs, labels = table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels")
    return toxicity.scored(docs, labels, toxicity.learn_rule(F.col("doc_id")))


def op6_lm(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    return lm.scored(docs, lm.learn_rule(F.col("doc_id")))


def op7_fingerprints(spark: SparkSession, sf_dir: str) -> DataFrame:
    return fingerprints.compared_with_edits(table(spark, sf_dir, "documents"))


def op8_pii(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pii.report(table(spark, sf_dir, "documents"))


def op9_sentencepiece(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spm.round_trip(table(spark, sf_dir, "documents"))


def op10_minhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    return minhash_dedup.near_groups(table(spark, sf_dir, "documents"), width=2, percent=80)


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    f.__name__: f for f in (op1_secrets, op2_language_id, op3_exact_dedup, op4_mixing, op5_toxicity, op6_lm, op7_fingerprints, op8_pii, op9_sentencepiece, op10_minhash)
}

SPACE = r"[\x20\x09-\x0D]"

ORACLE_SQL: dict[str, str] = {
    "op3_exact_dedup": rf"""
        WITH n AS (SELECT doc_id, length(coalesce(text, '')) AS chars,
                          regexp_replace(coalesce(text, ''), '{SPACE}+', '', 'g') AS t FROM documents),
             r AS (SELECT *, row_number() OVER (PARTITION BY t ORDER BY chars DESC, doc_id) AS rn,
                          first_value(doc_id) OVER (PARTITION BY t ORDER BY chars DESC, doc_id) AS keep_id,
                          count(*) OVER (PARTITION BY t) AS group_size FROM n)
        SELECT doc_id, keep_id, group_size, rn = 1 AS kept, sha256(t) AS text_sha256 FROM r""",
    "op10_minhash": rf"""
        WITH RECURSIVE w AS MATERIALIZED (
                 SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x20\x09-\x0D]+') AS w
                 FROM documents),
             s AS MATERIALIZED (
                 SELECT DISTINCT doc_id, unnest(CASE WHEN len(w) = 0 THEN []::VARCHAR[] WHEN len(w) = 1 THEN [w[1]]
                     ELSE list_transform(range(1, len(w)), lambda i: w[i] || ' ' || w[i + 1]) END) AS g FROM w),
             c AS MATERIALIZED (SELECT doc_id, count(*) AS n FROM s GROUP BY doc_id),
             e AS MATERIALIZED (
                 SELECT x.a, x.b FROM (SELECT p.doc_id AS a, q.doc_id AS b, count(*) AS k FROM s p JOIN s q ON p.g = q.g AND p.doc_id < q.doc_id
                     GROUP BY ALL) x JOIN c ca ON ca.doc_id = x.a JOIN c cb ON cb.doc_id = x.b WHERE 100 * k >= 80 * (ca.n + cb.n - k)),
             u AS MATERIALIZED (SELECT a, b FROM e UNION SELECT b, a FROM e),
             r(doc_id, reached) AS (SELECT doc_id, doc_id FROM documents UNION SELECT r.doc_id, u.b FROM r JOIN u ON r.reached = u.a),
             m AS (SELECT doc_id, min(reached) AS component_id FROM r GROUP BY doc_id)
        SELECT d.doc_id, coalesce(c.n, 0) AS n_shingles, m.component_id, d.doc_id = m.component_id AS kept
        FROM documents d JOIN m USING (doc_id) LEFT JOIN c USING (doc_id)""",
}
