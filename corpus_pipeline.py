"""From raw documents to a training mix: five stages, each written and reread.

A stage takes (spark, docs, sf_dir) and works on all rows its predecessor kept. All but the last
return the columns of ``docs``; the last returns the mix in training order.

Edge cases are those of the operators. Rows with equal id and text are copies of each other: the near-duplicate
stage keeps one. Rows with equal ids and different texts are judged apart. Rows with a null id are judged like others, and kept by that stage. No documents
give no rows.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from panelcast.llm import entities, leaks, mixing, neardup, quality
from panelcast.llm.common import parted, quoted, stored, table, unused

#: SQL cannot express the stages' iterations, alignments and hashes; tests hold them against brute force.
ORACLE_SQL = None


def _columns(docs: DataFrame) -> list[Column]:
    return [quoted(c) for c in docs.columns]


def keep_good(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Rows whose posterior quality is good and that pass the base rules."""
    verdict = unused(docs, "verdict")
    judged = quality.judged(docs, "text", verdict)
    return judged.where(F.col(f"{verdict}.kept")).select(_columns(docs))


def keep_one_of_each(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One row of each group of near duplicates: the one with the smallest id. Only rows that may go are moved."""
    found = neardup.near_duplicates(docs, words=5, percent=80)
    own, hashed, n, kept = (unused(docs, c) for c in ("_id", "_print", "_n", "_kept"))
    per = found.where("doc_id is not null").groupBy(F.col("doc_id").alias(own), F.col("print").alias(hashed))
    special = per.agg(F.count("*").alias(n), F.max("kept").alias(kept)).where(f"{n} > 1 or not {kept}")
    special = stored(special.select(own, hashed, kept), "near-duplicates")
    few, others = parted(docs, F.xxhash64("text"), special.select(hashed))
    same = (F.col("doc_id") == F.col(own)) & (F.xxhash64("text") == F.col(hashed))
    left = few.where("doc_id is not null").join(special, same, "left").where(F.coalesce(F.col(kept), F.lit(True)))
    # rows of one id and text are copies; an id may have several texts
    left = left.withColumn(n, F.xxhash64("text")).dropDuplicates(["doc_id", n])
    return left.select(_columns(docs)).unionByName(others).unionByName(few.where("doc_id is null"))


def drop_leaks(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Rows that hold no passage of the benchmark."""
    found = leaks.matches(docs, table(spark, sf_dir, "benchmark"))
    return leaks.without_leaks(docs, found)


def redact(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All rows, personal data replaced by its kind; ``n_chars`` follows the text."""
    out = entities.redacted(docs)
    return out.withColumn("n_chars", F.length("text").cast("bigint")).select(_columns(docs)) if "n_chars" in docs.columns else out


def mix(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """doc_id, source, position, words: one row for each reading of a row, in training order."""
    return mixing.training_order(mixing.mix(docs))


STAGES = [
    ("quality_rules", keep_good),
    ("near_duplicates", keep_one_of_each),
    ("benchmark_leaks", drop_leaks),
    ("personal_data", redact),
    ("source_mix", mix),
]


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        docs = stored(stage(spark, docs, sf_dir), name)
    return docs
