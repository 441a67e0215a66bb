"""Mixing sources to target weights along a curriculum that changes over time.

Each source has a weight. Together the sources share ``share`` times all words; a source's
target is its weighted part, at most ``most`` times its own size, and what is cut off goes to
the others by weight until none is above. Since target = min(most * size, level * weight),
the level is found from the sources in order of size by weight, without rounds.

Over training time t from 0 to 1 a source is asked for words at the rate
target * (a + 2 (1 - a) t), where a is its ``early`` factor: above 1 it is asked for more at
the beginning, below 1 more at the end. The integral is the source's cumulative demand. The
documents of a source stand in a fixed order, that of the MD5 of their id. A pass over them
covers the words [start, start + size) of the demand, a second pass the same shifted by the
source's size, so a document is taken for as many words as its passes lie below the target;
the last one is cut at the target. The time at which the demand reaches a pass's start, found
by inverting the integral, is its training position, and the mix is range-sorted by it.

Scale: the running sum inside a source is made in two steps, over buckets of the MD5 and inside
a bucket, so a source with a third of all rows is spread over as many tasks as it needs. What is
computed without partitions is a table with one row per source.

Edge cases: a null or empty text has size 0, takes nothing and has no position. A null source is a
source of its own, the last. Rows with equal id stand next to each other, by size, then text hash;
fully equal rows are interchangeable. No rows give no rows. Other columns are not looked at.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import WORD, buckets, stored, whole

WEIGHTS = (5, 2, 1)
EARLY = (0.5, 1.0, 1.5)
SHARE = 1.5
MOST = 2
ROWS_PER_BUCKET = 20_000


def sizes(docs: DataFrame, doc_id: str, text: str, source: str) -> DataFrame:
    order = F.md5(whole(F.col(doc_id).cast("string")))
    return docs.select(
        F.col(doc_id).alias("doc_id"), F.col(source).alias("source"),
        F.regexp_count(whole(F.col(text)), F.lit(WORD)).cast("bigint").alias("size"),
        order.alias("rank"), F.xxhash64(text).alias("tie"),
    )


def _pick(values: tuple, at: Column) -> Column:
    return F.element_at(F.array(*(F.lit(v) for v in values)), (F.pmod(at, F.lit(len(values))) + 1).cast("int"))


def targets(sized: DataFrame, weights: tuple = WEIGHTS, early: tuple = EARLY, share: float = SHARE, most: int = MOST) -> DataFrame:
    """source, source_size, target, early: one row per source."""
    per = sized.groupBy("source").agg(F.sum("size").alias("source_size"))
    place = F.row_number().over(Window.orderBy(F.col("source").asc_nulls_last())) - 1
    per = per.select("*", place.alias("place"))
    place = F.col("place")
    per = per.select("*", _pick(tuple(float(w) for w in weights), place).alias("weight"), _pick(early, place).alias("early"))
    per = per.select("*", (F.lit(float(most)) * F.col("source_size")).alias("cap"))
    filled = Window.orderBy(F.col("cap") / F.col("weight"), F.col("source").asc_nulls_last())
    before = filled.rowsBetween(Window.unboundedPreceding, -1)
    everything = Window.partitionBy(F.lit(0))
    per = per.select(
        "*", F.sum("source_size").over(everything).alias("all_size"), F.sum("weight").over(everything).alias("all_weight"),
        F.coalesce(F.sum("cap").over(before), F.lit(0.0)).alias("cut"), F.coalesce(F.sum("weight").over(before), F.lit(0.0)).alias("gone"),
    )
    level = (F.lit(share) * F.col("all_size") - F.col("cut")) / (F.col("all_weight") - F.col("gone"))
    per = per.select("*", level.alias("level"))
    # the first source, in order of size by weight, that the level leaves below its cap
    below = F.when(F.col("level") * F.col("weight") <= F.col("cap"), F.struct(F.col("cap") / F.col("weight"), "place", "level"))
    per = per.select("*", F.min(below).over(everything)["level"].alias("found"))
    return per.select("source", "source_size", F.least("cap", F.coalesce(F.col("found") * F.col("weight"), F.col("cap"))).alias("target"), "early")


def running(sized: DataFrame) -> DataFrame:
    """``start``: words of the source's documents that stand before this one."""
    n = buckets(sized.count(), ROWS_PER_BUCKET)
    part = F.shiftright(F.conv(F.substring("rank", 1, 8), 16, 10).cast("bigint") * n, 32)
    sized = sized.withColumn("part", part)
    cells = sized.groupBy("source", "part").agg(F.sum("size").alias("cell"))
    up_to = Window.partitionBy("source").orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    cells = cells.select(F.col("source").alias("cell_source"), F.col("part").alias("cell_part"), F.coalesce(F.sum("cell").over(up_to), F.lit(0)).alias("base"))
    inside = Window.partitionBy("source", "part").orderBy("rank", "doc_id", "size", "tie").rowsBetween(Window.unboundedPreceding, -1)
    own = sized.withColumn("inner", F.coalesce(F.sum("size").over(inside), F.lit(0)))
    joined = own.join(cells, F.col("source").eqNullSafe(F.col("cell_source")) & (F.col("part") == F.col("cell_part")))
    return joined.select("doc_id", "source", "size", (F.col("base") + F.col("inner")).alias("start"))


def mix(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", source: str = "source", **plan) -> DataFrame:
    """doc_id, source, size, source_size, target, taken, passes of every row.

    ``passes`` has (position, words) of each time the document is read.
    """
    sized = stored(sizes(docs, doc_id, text, source), "mix-sizes")
    goal = targets(sized, **plan).withColumnRenamed("source", "goal_source")
    rows = running(sized).join(goal, F.col("source").eqNullSafe(F.col("goal_source"))).drop("goal_source")
    most = plan.get("most", MOST)
    cut = F.round("target").cast("bigint")
    # the passes of a document: the k-th starts at start + k * source_size
    words = lambda k: F.greatest(F.lit(0), F.least(F.col("size"), cut - F.col("start") - F.lit(k) * F.col("source_size")))
    share = lambda k: (F.col("start") + F.lit(k) * F.col("source_size")) / F.col("target")
    a = F.col("early")

    def position(k: int) -> Column:
        bend = (F.lit(1.0) - a) * 2
        return F.when(a == 1.0, share(k)).otherwise((F.sqrt(a * a + bend * 2 * share(k)) - a) / bend)

    passes = F.filter(F.array(*(F.struct(F.when(words(k) > 0, position(k)).alias("position"), words(k).alias("words")) for k in range(most))), lambda p: p["words"] > 0)
    return rows.select("doc_id", "source", "size", "source_size", "target", sum((words(k) for k in range(1, most)), words(0)).alias("taken"), passes.alias("passes"))


def training_order(mixed: DataFrame) -> DataFrame:
    """One row for each pass, range-sorted by training position."""
    rows = mixed.select("doc_id", "source", F.explode("passes").alias("p")).select("doc_id", "source", "p.position", "p.words")
    return rows.orderBy("position", "doc_id")
