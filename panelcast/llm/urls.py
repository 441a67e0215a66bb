"""URL filters: a blocked Bloom filter lets possible hits through to an exact join.

A list holds entries of two kinds. A *rule* (host, path, verdict) fits its host and every
subdomain when the path starts with the rule's path. A *listed URL* fits the pages that have
the same canonical form. Both become text keys; a page asks for the keys it could have:
every label-aligned end of its host with every start of its path that is as long as some
rule's path, and its canonical form. Keys that the Bloom filter knows go on to a hash join
with the list itself, which removes false positives.

The filter is a table of 256-bit blocks, one row each. It has at most ``MAX_BLOCKS`` rows
(2 MB of bits) however long the list is, so it can always be broadcast: beyond about
1.6 million entries more false positives pass, and the join still removes them.

Edge cases: a null url, or one without ``://``, has empty host and path, fits no rule and
is not listed. Repeated pages get a verdict each. Among fitting rules the longest key wins;
of equal keys, ``block``. Empty lists let every page pass. Other columns are not looked at.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import ascii_lower, buckets, stored

MAX_BLOCKS = 65_536
KEYS_PER_BLOCK = 25
LANES = 4


def host(url: Column) -> Column:
    return ascii_lower(F.regexp_extract(_after_scheme(url), r"^[^/?#]*", 0))


def path(url: Column) -> Column:
    return F.regexp_extract(_after_scheme(url), r"^[^/?#]*([^?#]*)", 1)


def _after_scheme(url: Column) -> Column:
    at = F.locate("://", url)
    return F.when(at > 0, url.substr(at + 3, F.length(url))).otherwise("")


def canonical(url: Column) -> Column:
    """Host without ``www.``, path without end slash, query without ``utm_`` and ``ref``; no fragment."""
    query = F.regexp_extract(url, r"^[^#?]*\?([^#]*)", 1)
    kept = F.filter(F.split(query, "&"), lambda p: ~p.rlike("^(utm_|ref=)") & (p != ""))
    tail = F.array_join(F.sort_array(kept), "&")
    return F.concat(
        F.regexp_replace(host(url), r"^www\.", ""),
        F.regexp_replace(path(url), "/+$", ""),
        F.when(tail != "", F.concat(F.lit("?"), tail)).otherwise(""),
    )


def _block(key: Column, n_blocks: int) -> Column:
    return F.pmod(F.xxhash64(key), F.lit(n_blocks)).cast("int")


def _bits(key: Column) -> list[Column]:
    """One bit for each lane of the key's block, from a second hash."""
    again = F.xxhash64(key, F.lit("bits"))
    return [
        F.call_function("shiftleft", F.lit(1).cast("bigint"), F.shiftright(again, 6 * i).bitwiseAND(F.lit(63)).cast("int"))
        for i in range(LANES)
    ]


def bloom(keys: DataFrame, column: str, n_blocks: int) -> DataFrame:
    """Blocks of the filter: ``block`` and one bitmap per lane."""
    rows = keys.select(_block(F.col(column), n_blocks).alias("block"), *(b.alias(f"b{i}") for i, b in enumerate(_bits(F.col(column)))))
    return rows.groupBy("block").agg(*(F.bit_or(f"b{i}").alias(f"lane{i}") for i in range(LANES)))


def possible(rows: DataFrame, column: str, filter_blocks: DataFrame, n_blocks: int) -> DataFrame:
    """The rows whose key the filter may know; the filter's size is bounded, so it is broadcast."""
    hit = F.lit(True)
    for i, bit in enumerate(_bits(F.col(column))):
        hit = hit & (F.col(f"lane{i}").bitwiseAND(bit) != 0)
    known = rows.join(F.broadcast(filter_blocks), _block(F.col(column), n_blocks) == F.col("block"))
    return known.where(hit).select(rows.columns)


def entries(rules: DataFrame, listed: DataFrame) -> DataFrame:
    """(key, rule, verdict, path_length) of rules (host, path, verdict) and listed canonical URLs (url)."""
    text = F.concat(ascii_lower(F.col("host")), F.col("path"))
    ruled = rules.where(text.isNotNull()).select(
        F.concat(F.lit("r"), text).alias("key"), text.alias("rule"), "verdict", F.length("path").alias("path_length")
    )
    exact = listed.where(F.col("url").isNotNull() & (F.col("url") != "")).select(
        F.concat(F.lit("u"), "url").alias("key"), F.lit(None).cast("string").alias("rule"), F.lit("block").alias("verdict"), F.lit(None).cast("int").alias("path_length")
    )
    both = ruled.unionByName(exact)
    return both.groupBy("key", "rule", "path_length").agg(F.max("verdict").alias("verdict"))


def nothing_listed(spark: SparkSession) -> DataFrame:
    return spark.createDataFrame([], "url string")


def judge(pages: DataFrame, page_id: str, url: str, rules: DataFrame, listed: DataFrame) -> DataFrame:
    """page_id, url, host, path, rule, verdict, listed of every row of ``pages``."""
    known = stored(entries(rules, listed), "url-list")
    facts = known.agg(F.count("*").alias("n"), F.collect_set("path_length").alias("lengths")).first()
    n_blocks = min(MAX_BLOCKS, buckets(facts.n, KEYS_PER_BLOCK))
    blocks = bloom(known, "key", n_blocks)

    rows = pages.select(F.col(page_id).alias("page_id"), F.col(url).alias("url"))
    rows = rows.select("*", host(F.col("url")).alias("host"), path(F.col("url")).alias("path"), canonical(F.col("url")).alias("canon"))
    asked = rows.where("host <> ''").groupBy("host", "path", "canon").count()  # copies of a url ask once
    labels = F.split("host", r"\.")
    ends = F.transform(F.sequence(F.lit(1), F.size(labels)), lambda i: F.array_join(F.slice(labels, i, F.size(labels)), "."))
    starts = F.array_distinct(F.transform(F.array(*(F.lit(n) for n in sorted(facts.lengths))).cast("array<int>"), lambda n: F.substring(F.col("path"), F.lit(1), n)))
    ruled = F.flatten(F.transform(ends, lambda e: F.transform(starts, lambda s: F.concat(F.lit("r"), e, s))))
    keys = asked.select("host", "path", "canon", F.explode(F.concat(F.array_distinct(ruled), F.array(F.concat(F.lit("u"), F.col("canon"))))).alias("key"))
    hits = possible(keys, "key", blocks, n_blocks).join(known, "key")
    found = hits.groupBy("host", "path", "canon").agg(
        F.max(F.when(F.col("rule").isNotNull(), F.struct(F.length("rule").alias("size"), "rule", "verdict"))).alias("best"),
        F.max(F.col("rule").isNull()).alias("listed"),
    )
    joined = rows.join(found, ["host", "path", "canon"], "left")
    listed_here = F.coalesce("listed", F.lit(False))
    return joined.select(
        "page_id", "url", "host", "path", F.col("best.rule").alias("rule"),
        F.coalesce("best.verdict", F.when(listed_here, "block").otherwise("allow")).alias("verdict"),
        listed_here.alias("listed"),
    )
