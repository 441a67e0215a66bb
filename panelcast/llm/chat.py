"""Chat formatting: each participant of a dialogue in turn becomes the assistant.

For a speaker, the dialogue is rendered with the speaker's turns as assistant, the others' as named
users and system turns as system; the mask marks the assistant's words, which are to be learned.
Turns are ordered by (turn, role, text). A dialogue is rendered in pieces of at most ``most`` turns, numbered from 0, each of
them for every participant of the whole dialogue; the pieces of a speaker join to the whole dialogue.
A piece that doesn't begin with a system turn is headed by the last one before it, so no piece is without its
instructions; the heading's ``carried`` characters are cut off before pieces are joined (by line feeds).

Scale: a dialogue may hold a third of all rows. The turns are range-sorted, and a turn's place in its
dialogue is that of its sorted segment plus its place inside the segment, so no task needs a whole
dialogue. A row is bounded by ``most`` turns; a dialogue gives its number of pieces times its number of participants.

Edge cases: a null text is empty; a null role is the speaker ``unknown``; a null turn comes first; a null
conversation is a conversation of its own. Repeated turns stay, side by side. A ``<|`` in a text or
role is written ``<\\|``, so texts can't open a marker. A dialogue with system turns only renders
nothing. A piece in which the speaker says nothing has an empty mask. No rows give no rows. Other columns are not looked at.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import stored, whole

TURNS = 64
SYSTEM = "system"


def _safe(text: Column) -> Column:
    return F.replace(text, F.lit("<|"), F.lit("<\\|"))


def numbered(turns: DataFrame, conv: str, turn: str, role: str, text: str) -> DataFrame:
    """conv_id, role, text, ``seq``, which no other turn has, ``place``, the turn's number in its dialogue, from 0, and ``told``,
    the ``seq`` of the last system turn before it."""
    rows = turns.select(
        F.col(conv).alias("conv_id"), F.col(turn).alias("turn"),
        _safe(F.coalesce(F.col(role), F.lit("unknown"))).alias("role"), _safe(whole(F.col(text))).alias("text"),
    )
    rows = rows.orderBy("conv_id", "turn", "role", "text")
    rows = stored(rows.drop("turn").withColumn("seq", F.monotonically_increasing_id()), "turns")
    rows = rows.withColumn("segment", F.shiftright("seq", 33))
    said = F.when(F.col("role") == SYSTEM, F.col("seq"))
    parts = rows.groupBy(F.col("conv_id").alias("c"), F.col("segment").alias("s")).agg(F.count("*").alias("n"), F.min("seq").alias("first"), F.max(said).alias("said"))
    before = Window.partitionBy("c").orderBy("s").rowsBetween(Window.unboundedPreceding, -1)
    parts = parts.select("c", "s", "first", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("base"), F.max("said").over(before).alias("told"))
    joined = rows.join(parts, F.col("conv_id").eqNullSafe(F.col("c")) & (F.col("segment") == F.col("s")))
    return joined.select("conv_id", "role", "text", "seq", "segment", (F.col("base") + F.col("seq") - F.col("first")).alias("place"), "told")


def _headings(rows: DataFrame, most: int) -> DataFrame:
    """conv_id, example, heading: the system turn that heads a piece."""
    inside = Window.partitionBy("conv_id", "segment").orderBy("seq").rowsBetween(Window.unboundedPreceding, -1)
    near = F.max(F.when(F.col("role") == SYSTEM, F.col("seq"))).over(inside)
    told = rows.select("conv_id", "role", "place", F.coalesce(near, F.col("told")).alias("told"))
    begins = told.where((F.col("place") % most == 0) & (F.col("role") != SYSTEM) & F.col("told").isNotNull())
    headed = begins.select("conv_id", F.floor(F.col("place") / most).alias("example"), "told")
    return headed.join(rows.select(F.col("seq").alias("told"), F.col("text").alias("heading")), "told").drop("told")


def perspectives(
    turns: DataFrame, conv: str = "conv_id", turn: str = "turn", role: str = "role", text: str = "text", most: int = TURNS
) -> DataFrame:
    """conv_id, example, speaker, n_turns, carried, rendered, mask: one row per piece and participant of the dialogue.

    ``mask`` is an array of (start, end) in code points of the rendered text.
    """
    rows = numbered(turns, conv, turn, role, text)
    example = F.floor(F.col("place") / most).alias("example")
    said = F.sort_array(F.collect_list(F.struct("place", "role", "text")))
    pieces = rows.groupBy("conv_id", example).agg(said.alias("said"))
    heads = _headings(rows, most).withColumnRenamed("conv_id", "c").withColumnRenamed("example", "e")
    same = lambda a, b: F.col(a).eqNullSafe(F.col(b))
    pieces = pieces.join(heads, same("conv_id", "c") & (F.col("example") == F.col("e")), "left").drop("c", "e")
    speakers = rows.where(F.col("role") != SYSTEM).select(F.col("conv_id").alias("c"), F.col("role").alias("speaker")).distinct()
    seen = pieces.join(speakers, same("conv_id", "c")).drop("c")
    n_turns = F.size("said")
    heading = F.struct(F.lit(-1).cast("bigint").alias("place"), F.lit(SYSTEM).alias("role"), F.col("heading").alias("text"))
    carried = F.when(F.col("heading").isNull(), 0).otherwise(F.length(F.concat(F.lit("<|system|>\n"), F.col("heading"), F.lit("<|end|>\n"))))
    every = F.when(F.col("heading").isNull(), F.col("said")).otherwise(F.concat(F.array(heading), F.col("said")))
    seen = seen.select("conv_id", "example", "speaker", n_turns.alias("n_turns"), carried.alias("carried"), every.alias("said"))
    own = lambda t: t["role"] == F.col("speaker")
    head = lambda t: (
        F.when(own(t), "<|assistant|>\n").when(t["role"] == SYSTEM, "<|system|>\n")
        .otherwise(F.concat(F.lit("<|user name="), t["role"], F.lit("|>\n")))
    )
    pieces = F.transform("said", lambda t: F.struct(head(t).alias("head"), F.concat(t["text"], F.lit("<|end|>")).alias("body"), own(t).alias("own")))
    seen = seen.select("conv_id", "example", "speaker", "n_turns", "carried", pieces.alias("pieces"))
    rendered = F.array_join(F.transform("pieces", lambda p: F.concat(p["head"], p["body"])), "\n")
    none = F.array().cast("array<struct<start:int,end:int>>")
    walked = F.aggregate(
        F.col("pieces"),
        F.struct(F.lit(0).alias("at"), none.alias("out")),
        lambda a, p: F.struct(
            (a["at"] + F.length(p["head"]) + F.length(p["body"]) + 1).alias("at"),
            F.when(
                p["own"],
                F.concat(a["out"], F.array(F.struct(
                    (a["at"] + F.length(p["head"])).alias("start"),
                    (a["at"] + F.length(p["head"]) + F.length(p["body"])).alias("end"),
                ))),
            ).otherwise(a["out"]).alias("out"),
        ),
    )["out"]
    return seen.select("conv_id", "example", "speaker", "n_turns", "carried", rendered.alias("rendered"), walked.alias("mask"))
