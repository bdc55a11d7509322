"""A corpus from raw documents to token ids: toxicity, exact and near dedup, mixing, encoding.

Each stage takes (spark, docs, sf_dir) and works on all rows its predecessor kept; run() writes every stage's rows as
Parquet to the shared folder and reads them again for the next, and deletes what no later stage reads.

Defined results of all stages: an empty table gives an empty table; extra columns travel along; long texts are worked on whole. Null
and repeated ids, null and empty texts and ties are said at each stage.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from pagecraft.llm import exact_dedup, minhash_dedup, mixing, spm, toxicity
from pagecraft.llm.common import discard, materialize, table

#: No SQL: the classifier, the hashes and the segmentation are not expressible; tests compare with brute force.
ORACLE_SQL = None


def without_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Rows that the classifier rejects go. Null and empty texts are scored like all others; repeated rows go or stay together; without
    labels nothing goes."""
    return toxicity.clean(docs, table(spark, sf_dir, "labels"), toxicity.learn_rule(F.col("doc_id")))


def without_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of rows with equal text one stays: the longest original, then the least id, null ids last. Null, empty and blank texts are equal; of
    rows that repeat id and text one stays."""
    return exact_dedup.deduplicated(docs)


def without_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of rows that are linked at 0.8 or more of five-word shingles one stays: that of the least id, null ids last, then by the text's digest.
    Null and empty texts are linked with nothing and stay; shorter texts are one shingle; of rows that repeat id and text one stays."""
    return minhash_dedup.deduplicated(docs)


def mixed(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Rows as often as the sources' target weights take them, whole documents rounded without bias. Null and empty texts are not taken; a
    null source is one of its own; rows that repeat id, source and text share their copies."""
    return mixing.remixed(docs)


def encoded(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """doc_id, the number of pieces, their ids, and the digest of what they decode to, for each row. Null and empty texts have no pieces; ties
    prefer the longer last piece."""
    return spm.round_trip(docs)


STAGES = [
    ("toxicity", without_toxic),
    ("exact_dedup", without_copies),
    ("near_dedup", without_near_copies),
    ("mixing", mixed),
    ("sentencepiece", encoded),
]


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        kept = materialize(stage(spark, docs, sf_dir), f"stage-{name}")
        discard(docs)
        docs = kept
    return STAGES[-1][1](spark, docs, sf_dir)
