"""Secret scans through a trigram inverted index.

From each rule's regular expression comes a Boolean trigram query (``trigrams.clauses``). The
index holds, for each of the trigrams that occur in queries and each block of documents, the list
of documents that hold it. A query intersects the lists of each of its clauses and unites the
clauses; only the documents found are verified with the expression. A rule without mandatory
trigrams scans every document.

The positions of matches come from splitting the text at them: what stands between two matches
and the matches themselves add up to offsets. Splitting finds the same matches as searching
does, from left to right without overlaps.

Scale: lists are cut into blocks of documents by hash of the id, each of bounded length, so a
trigram that every document holds makes many short lists. What is shuffled is ids; the texts
move once, to meet their candidate rules.

Edge cases: a null or empty text has no spans. Repeated ids: a row is verified for every rule that
any row of its id is a candidate for; its spans are its own. A null id is an id like others. No
rows give no rows. Other columns are not looked at.
"""

from __future__ import annotations

from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import ascii_lower, buckets, whole
from .trigrams import clauses

DOCS_PER_BLOCK = 4_000


@dataclass(frozen=True)
class Rule:
    """``group`` of a match must have ``least`` characters, else the match is dropped."""

    kind: str
    pattern: str
    group: int = 0
    least: int = 0


def _any_case(word: str) -> str:
    return "".join(f"[{c.upper()}{c}]" if c.isalpha() else c for c in word)


#: The formats of secrets.
KEYWORDS = "|".join(_any_case(w) for w in ("password", "passwd", "secret", "token", "api_?key"))
BASE_RULES = (
    Rule("assign", rf"""({KEYWORDS})["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", 2, 6),
    Rule("access", r"AKIA[A-Z0-9]+", 0, 20),
    # runs shorter than asked for are never matched: a run is matched whole or not at all
    Rule("hex", r"[0-9a-f]{24,}", 0, 24),
)
MORE_RULES = (
    Rule("private_key", r"-----BEGIN [A-Z ]{0,40}PRIVATE KEY-----"),
    Rule("hub_token", r"gh[opsu]_[A-Za-z0-9]{36,}"),
    Rule("chat_token", r"xox[abprs]-[A-Za-z0-9-]{10,}"),
    Rule("web_token", r"eyJ[A-Za-z0-9_-]{10,}\.eyJ[A-Za-z0-9_-]{10,}\.[A-Za-z0-9_-]{10,}"),
)


def queries(rules: tuple[Rule, ...]) -> dict[str, list[frozenset[str]]]:
    return {r.kind: clauses(r.pattern) for r in rules}


def index(docs: DataFrame, doc_id: str, text: str, trigrams: list[str], n_blocks: int) -> DataFrame:
    """trigram, block, ids: the documents of a block that hold the trigram, in lower case."""
    body = ascii_lower(whole(F.col(text)))
    rows = docs.select(F.col(doc_id).alias("doc_id"), body.alias("body"))
    rows = rows.select("doc_id", F.explode(_held(F.col("body"), trigrams)).alias("trigram"))
    block = F.pmod(F.xxhash64("doc_id"), F.lit(n_blocks)).alias("block")
    return rows.groupBy("trigram", block).agg(F.collect_set(F.struct("doc_id")).alias("ids"))


def _held(body: Column, trigrams: list[str]) -> Column:
    return F.array_compact(F.array(*(F.when(F.contains(body, F.lit(t)), F.lit(t)) for t in trigrams)))


def candidates(postings: DataFrame, asked: dict[str, list[frozenset[str]]]) -> DataFrame:
    """doc_id, kinds: the documents that meet a query, by intersecting posting lists."""
    spark = postings.sparkSession
    terms = [(kind, i, t) for kind, query in asked.items() for i, c in enumerate(query) for t in sorted(c)]
    sizes = {(kind, i): len(c) for kind, query in asked.items() for i, c in enumerate(query)}
    wanted = spark.createDataFrame([(*x, sizes[x[:2]]) for x in terms], "kind string, clause int, trigram string, size int")
    lists = postings.join(wanted, "trigram").groupBy("block", "kind", "clause", "size").agg(F.collect_list("ids").alias("lists"))
    met = lists.where(F.size("lists") == F.col("size")).select(
        "kind", F.aggregate(F.slice("lists", 2, F.size("lists")), F.get("lists", F.lit(0)), F.array_intersect).alias("ids")
    )
    rows = met.select("kind", F.explode("ids").alias("d")).select("kind", "d.doc_id")
    return rows.groupBy("doc_id").agg(F.collect_set("kind").alias("kinds"))


def spans(text: Column, rule: Rule) -> Column:
    """The rule's matches as an array of (start, end, value) in code points."""
    at = F.split(text, rule.pattern, -1)
    found = F.regexp_extract_all(text, F.lit(rule.pattern), F.lit(0))
    value = F.regexp_extract_all(text, F.lit(rule.pattern), F.lit(rule.group))
    pairs = F.zip_with(F.arrays_zip(found.alias("m"), value.alias("v")), at, lambda x, gap: F.struct(F.length(gap).alias("gap"), F.length(x["m"]).alias("n"), x["v"].alias("v")))
    empty = F.array().cast("array<struct<start:int,end:int,value:string>>")
    walked = F.aggregate(
        F.filter(pairs, lambda x: x["n"].isNotNull()),
        F.struct(F.lit(0).alias("at"), empty.alias("out")),
        lambda a, x: F.struct(
            (a["at"] + x["gap"] + x["n"]).alias("at"),
            F.concat(a["out"], F.array(F.struct((a["at"] + x["gap"]).alias("start"), (a["at"] + x["gap"] + x["n"]).alias("end"), x["v"].alias("value")))).alias("out"),
        ),
    )["out"]
    return F.filter(walked, lambda s: F.length(s["value"]) >= rule.least) if rule.least else walked


def scan(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", rules: tuple[Rule, ...] = BASE_RULES + MORE_RULES) -> DataFrame:
    """doc_id and ``found``: an array of (start, place, kind, end, value) of every row, sorted.

    ``place`` is the rule's number: spans are sorted by start, then rule.
    """
    asked = {k: q for k, q in queries(rules).items() if frozenset() not in q}
    trigrams = sorted(set().union(*(c for q in asked.values() for c in q)))
    rows = docs.select(F.col(doc_id).alias("doc_id"), whole(F.col(text)).alias("text"))
    if trigrams:
        n_blocks = buckets(docs.count(), DOCS_PER_BLOCK)
        found = candidates(index(docs, doc_id, text, trigrams, n_blocks), asked).withColumnRenamed("doc_id", "found_id")
        rows = rows.join(found, F.col("doc_id").eqNullSafe(F.col("found_id")), "left").drop("found_id")
    else:
        rows = rows.withColumn("kinds", F.lit(None).cast("array<string>"))
    none = F.array().cast("array<struct<start:int,place:int,kind:string,end:int,value:string>>")

    def verified(place: int, rule: Rule) -> Column:
        every = F.transform(spans(F.col("text"), rule), lambda s: F.struct(s["start"].alias("start"), F.lit(place).alias("place"), F.lit(rule.kind).alias("kind"), s["end"].alias("end"), s["value"].alias("value")))
        if rule.kind in asked:
            return F.when(F.array_contains("kinds", rule.kind), every).otherwise(none)
        return F.when(F.col("text").rlike(rule.pattern), every).otherwise(none)

    return rows.select("doc_id", F.sort_array(reduce(lambda a, b: F.concat(a, b), (verified(i, r) for i, r in enumerate(rules)))).alias("found"))
