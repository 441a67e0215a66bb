"""The registered queries: thin digests of the operators over the given tables."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from . import alignment, chat, classifier, entities, fingerprints, leaks, mixing, neardup, phrases, quality, repeats, secrets, urls
from .common import table


def _spans(found: str) -> Column:
    """kind:start:end, comma-joined in the array's order."""
    return F.array_join(F.transform(found, lambda s: F.concat_ws(":", s["kind"], s["start"], s["end"])), ",")


def _count(found: str, kind: str) -> Column:
    return F.size(F.filter(found, lambda s: s["kind"] == kind)).cast("bigint")


def op1_secret_scan(spark: SparkSession, folder: str) -> DataFrame:
    found = secrets.scan(table(spark, folder, "documents"))
    base = [r.kind for r in secrets.BASE_RULES]
    kept = found.select("doc_id", "found", F.filter("found", lambda s: s["kind"].isin(base)).alias("base"))
    return kept.select(
        "doc_id",
        *(_count("found", k).alias(f"n_{k}") for k in base),
        F.sha2(_spans("base"), 256).alias("base_sha256"),
        _spans("found").alias("spans"),
    )


def op2_benchmark_leaks(spark: SparkSession, folder: str) -> DataFrame:
    found = leaks.matches(table(spark, folder, "documents"), table(spark, folder, "benchmark"))
    return found.select("doc_id", "item_id", "score", "first_word", "last_word")


def op3_quality_scores(spark: SparkSession, folder: str) -> DataFrame:
    scored = classifier.quality_scores(table(spark, folder, "documents"), table(spark, folder, "labels"))
    return scored.select("*", (F.col("score") >= 0.5).cast("int").alias("predicted"))


def op4_repeated_passages(spark: SparkSession, folder: str) -> DataFrame:
    found = repeats.without_repeats(table(spark, folder, "documents"))
    removed = F.aggregate("removed", F.lit(0).cast("bigint"), lambda n, s: n + s["b"] - s["a"])
    return found.select("doc_id", "n_bytes", removed.alias("n_removed"), F.size("removed").cast("bigint").alias("n_spans"), "kept_sha256")


def op5_source_mix(spark: SparkSession, folder: str) -> DataFrame:
    mixed = mixing.mix(table(spark, folder, "documents"))
    first = F.get("passes", F.lit(0))["position"]
    return mixed.select("doc_id", "size", "source_size", "target", "taken", first.alias("position")).orderBy("position", "doc_id")


def op6_chat_perspectives(spark: SparkSession, folder: str) -> DataFrame:
    rows = chat.perspectives(table(spark, folder, "conversations"))
    mask = F.array_join(F.transform("mask", lambda s: F.concat_ws(":", s["start"], s["end"])), ",")
    return rows.withColumn("mask", mask)


def op8_personal_data(spark: SparkSession, folder: str) -> DataFrame:
    found = entities.annotated(table(spark, folder, "documents").select("doc_id", "text"), "found")
    found = found.select("doc_id", "found", F.filter("found", lambda s: s["base"]).alias("base"))
    return found.select(
        "doc_id",
        *(_count("base", k).alias(f"n_{k}") for k in entities.KINDS),
        F.sha2(_spans("base"), 256).alias("base_sha256"),
        _spans("found").alias("spans"),
    )


def op9_quality_rules(spark: SparkSession, folder: str) -> DataFrame:
    rows = quality.judged(table(spark, folder, "documents").select("doc_id", "text"), "text", "q", carry_text=False)
    names = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept")
    return rows.select("doc_id", *(F.col(f"q.{n}").alias(n) for n in names))


def op7_near_duplicates(spark: SparkSession, folder: str) -> DataFrame:
    found = neardup.near_duplicates(table(spark, folder, "documents"), words=4, percent=80)
    return found.select("doc_id", "n_shingles", "component_id", "kept")


#: The rules, as (host, path, verdict).
URL_RULES = (
    ("org", "/", "allow"),
    ("example.org", "/es/", "block"),
    ("example.org", "/en/1", "block"),
    ("com", "/fr/", "allow"),
    ("com", "/de/", "block"),
)


def op10_url_filter(spark: SparkSession, folder: str) -> DataFrame:
    """The listed URLs are those of the pages that a rule blocks: other forms of them are blocked too."""
    pages = table(spark, folder, "pages").select("page_id", "url")
    rules = spark.createDataFrame(URL_RULES, "host string, path string, verdict string")
    ruled = urls.judge(pages, "page_id", "url", rules, urls.nothing_listed(spark))
    listed = ruled.where("verdict = 'block'").select(urls.canonical(F.col("url")).alias("url"))
    return urls.judge(pages, "page_id", "url", rules, listed).select("page_id", "host", "path", "rule", "verdict")


def op11_phrase_collocations(spark: SparkSession, folder: str) -> DataFrame:
    return phrases.collocations(table(spark, folder, "documents"))


def op12_document_fingerprints(spark: SparkSession, folder: str) -> DataFrame:
    return fingerprints.with_next(table(spark, folder, "documents"))


#: Where the vocabulary files lie.
TOKENIZERS = "/opt/tokenizers"


def op13_token_alignment(spark: SparkSession, folder: str) -> DataFrame:
    return alignment.aligned(table(spark, folder, "documents"), f"{TOKENIZERS}/byte_bpe_50k.json", f"{TOKENIZERS}/piece_bpe_32k.model")


QUERIES = {
    "op1_secret_scan": op1_secret_scan,
    "op2_benchmark_leaks": op2_benchmark_leaks,
    "op3_quality_scores": op3_quality_scores,
    "op4_repeated_passages": op4_repeated_passages,
    "op5_source_mix": op5_source_mix,
    "op6_chat_perspectives": op6_chat_perspectives,
    "op7_near_duplicates": op7_near_duplicates,
    "op8_personal_data": op8_personal_data,
    "op9_quality_rules": op9_quality_rules,
    "op10_url_filter": op10_url_filter,
    "op11_phrase_collocations": op11_phrase_collocations,
    "op12_document_fingerprints": op12_document_fingerprints,
    "op13_token_alignment": op13_token_alignment,
}
