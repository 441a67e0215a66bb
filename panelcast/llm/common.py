"""What several text operators share: names, stored tables, words."""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from panelcast.session import saved as stored

#: The blanks that part words: space, tab, line feed, vertical tab, form feed, carriage return.
BLANKS = " \t\n\x0b\x0c\r"
WORD = r"[^\x20\x09-\x0D]+"
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{name}.parquet")


def unused(df: DataFrame, name: str) -> str:
    """``name``, with underscores added until no column of ``df`` has it (in any case)."""
    taken = {c.lower() for c in df.columns}
    while name.lower() in taken:
        name += "_"
    return name


def ascii_lower(text: Column) -> Column:
    return F.translate(text, UPPER, LOWER)


def whole(text: Column) -> Column:
    """The text, or the empty text where it is missing."""
    return F.coalesce(text, F.lit(""))


def quoted(name: str) -> Column:
    return F.col("`" + name.replace("`", "``") + "`")


def buckets(rows: int, per_bucket: int) -> int:
    return max(1, math.ceil(rows / per_bucket))


#: Cells of 64 bits in the sieve that parts rows; it has 16 million bits however many keys there are.
CELLS = 1 << 18


def parted(rows: DataFrame, key: Column, keys: DataFrame) -> tuple[DataFrame, DataFrame]:
    """``rows`` whose 64-bit ``key`` may be in ``keys`` (one such column), and those whose key surely isn't.

    Keys set bits of at most ``CELLS`` cells, which are broadcast, so rows part where they are read and only the first
    need to move."""
    cell = lambda c: F.pmod(c, F.lit(CELLS)).cast("int")
    bit = lambda c: F.call_function("shiftleft", F.lit(1).cast("bigint"), F.shiftright(c, 40).bitwiseAND(F.lit(63)).cast("int"))
    known, own, bits = F.col(keys.columns[0]), unused(rows, "cell"), unused(rows, "bits")
    cells = stored(keys.groupBy(cell(known).alias(own)).agg(F.bit_or(bit(known)).alias(bits)), "cells")
    hit = F.coalesce(F.col(bits).bitwiseAND(bit(key)) != 0, F.lit(False))
    both = rows.withColumn(own, cell(key)).join(F.broadcast(cells), own, "left")
    names = [quoted(c) for c in rows.columns]
    return both.where(hit).select(names), both.where(~hit).select(names)


def same_text(left: DataFrame, right: DataFrame, how: str) -> DataFrame:
    """Join on ``doc_id`` and text hash ``print``; the id may be null."""
    right = right.withColumnRenamed("doc_id", "_id").withColumnRenamed("print", "_print")
    same: Column = F.col("doc_id").eqNullSafe(F.col("_id")) & (F.col("print") == F.col("_print"))
    return left.join(right, same, how).drop("_id", "_print")
