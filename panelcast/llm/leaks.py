"""Benchmark decontamination: rare word runs are seeds, Smith-Waterman alignment scores the candidates.

Test items are cut into pieces of at most ``PIECE`` words that overlap by ``PASSAGE``, so any ``PASSAGE``
words in a row lie within one piece, wherever they begin. A piece's seeds are its runs of ``SEED`` words that at most ``SHARED``
different pieces have, and its ``OWN`` rarest in any case, so a phrase that many items share makes no candidates of all of them.
Seeds are looked for in every position of every text. A seed's position in a text minus its place in the
piece says where the piece would begin. A piece is a candidate for a text that holds a seed found at most ``RARE`` times in
the corpus, or two different seeds of it (or its only one); copies of an item in any number of texts still have many seeds each. A candidate with fewer words of the
piece nearby than ``LEAST`` asks for can't score it and is left. The surroundings of the others are aligned with the piece word by
word, so copies with words changed, left out or added still score. The score is the part of the best
possible one of the item, or of ``PASSAGE`` words of it if it is longer, and at most 1; from ``LEAST`` on the text holds a copy. Words are runs of letters and digits, in lower case, so punctuation doesn't matter.
A copy that keeps no seed, or in a corpus full of its only seed just that one, isn't found.

Scale: a bitmap of at most ``BITS`` bits lets positions through that may hold a seed; it
has a fixed size, and what it lets through by chance falls out of the join with the seeds
themselves. A hit meets at most ``SHARED`` pieces, but for pieces made of shared runs only. Texts are read twice and
move once, if they have a candidate; a sieve of fixed size tells (``common.parted``). A run in a third of all texts is a hot key of a
join only, which Spark splits.

Edge cases: null or empty texts and items match nothing; an item of fewer words than a seed is
looked for as a whole run. Repeated rows are matched each. Repeated items are matched each, found once; a null
item id is an item. An empty benchmark finds nothing. Other columns are not looked at.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .bytescan import LOWERED, Chunk, chunks, grams, mixed, prefix_hashes, span_hashes
from .common import parted, quoted, same_text, stored, unused, whole

SEED = 3
#: A run in this many pieces is still a seed; the ``OWN`` rarest of a piece always are.
SHARED, OWN = 32, 4
#: A seed found so often in the corpus is rare: one is enough for a candidate.
RARE = 1_000
PASSAGE = 64
PIECE = 2 * PASSAGE
MARGIN = 24
BITS = 1 << 24
LEAST = 0.5
MATCH, MISMATCH, GAP = 2, -1, -1

_IN_WORD = np.zeros(256, bool)
_IN_WORD[48:58] = _IN_WORD[65:91] = _IN_WORD[97:123] = _IN_WORD[128:] = True


def plain_words(chunk: Chunk) -> tuple[np.ndarray, np.ndarray]:
    """Hash and text number of every run of letters and digits, in lower case."""
    n = len(chunk.data)
    if n == 0:
        return np.zeros(0, np.uint64), np.zeros(0, np.int64)
    data = LOWERED[chunk.data]
    inside = np.zeros(n + 2, bool)
    inside[1:-1] = _IN_WORD[data]
    cut = np.zeros(n + 1, bool)
    cut[chunk.starts] = True
    begin = np.flatnonzero(inside[1:-1] & (~inside[:-2] | cut[:-1]))
    end = np.flatnonzero(inside[1:-1] & (~inside[2:] | cut[1:])) + 1
    hashes = mixed(span_hashes(prefix_hashes(data), begin, end) + (end - begin).astype(np.uint64))
    return hashes, np.searchsorted(chunk.starts, begin, "right") - 1


PIECES = "item_id bigint, words array<bigint>"


def _pieces(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The words of each piece of each item."""
    for chunk in chunks(batches):
        hashes, doc = plain_words(chunk)
        ids, out = chunk.column("item_id").to_pylist(), []
        for i in range(len(chunk)):
            own = hashes[np.searchsorted(doc, i) : np.searchsorted(doc, i + 1)].view(np.int64)
            for a in range(0, max(len(own) - PASSAGE, min(1, len(own))), PASSAGE):
                # the last is as long as the others
                out.append((ids[i], own[max(0, min(a, len(own) - PIECE)) : a + PIECE].tolist()))
        columns = list(zip(*out)) if out else [[]] * 2
        yield pa.RecordBatch.from_arrays([pa.array(list(columns[0]), pa.int64()), pa.array(list(columns[1]), pa.list_(pa.int64()))], names=["item_id", "words"])


RUNS = "piece bigint, size int, gram bigint, place int"


def _runs(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The runs of words of each piece; ``size`` words each."""
    for batch in batches:
        out = []
        for piece, words in zip(batch.column("piece").to_pylist(), batch.column("words")):
            part = words.values.to_numpy().view(np.uint64)
            n = min(SEED, len(part))
            found, first = grams(part, np.zeros(len(part), np.int64), n)
            out += [(piece, n, g, p) for g, p in zip((found + np.uint64(SEED - n)).view(np.int64).tolist(), first.tolist())]
        columns = list(zip(*out)) if out else [[]] * 4
        kinds = [pa.int64(), pa.int32(), pa.int64(), pa.int32()]
        yield pa.RecordBatch.from_arrays([pa.array(list(c), t) for c, t in zip(columns, kinds)], names=["piece", "size", "gram", "place"])


def seeds(pieces: DataFrame) -> DataFrame:
    """The runs that stand for their pieces: those that few pieces share, and the ``OWN`` rarest of every piece."""
    runs = stored(pieces.select("piece", "words").mapInArrow(_runs, RUNS), "runs")
    shared = runs.groupBy("gram").agg(F.count_distinct("piece").alias("sharers"))
    order = Window.partitionBy("piece").orderBy("sharers", "gram", "place")
    ranked = runs.join(shared, "gram").withColumn("rank", F.row_number().over(order))
    return stored(ranked.where((F.col("sharers") <= SHARED) | (F.col("rank") <= OWN)).drop("rank"), "seeds")


def bitmap(runs: DataFrame) -> np.ndarray:
    """Bits of the grams' low bits; never more than ``BITS`` of them."""
    bit = F.col("gram").bitwiseAND(F.lit(BITS - 1))
    rows = runs.select(F.shiftright(bit, 6).alias("cell"), F.call_function("shiftleft", F.lit(1).cast("bigint"), bit.bitwiseAND(F.lit(63)).cast("int")).alias("b"))
    cells = rows.groupBy("cell").agg(F.bit_or("b").alias("b")).toPandas()
    out = np.zeros(BITS // 64, np.int64)
    out[cells["cell"].to_numpy(np.int64)] = cells["b"].to_numpy(np.int64)
    return out


HITS = "doc_id bigint, print bigint, gram bigint, at bigint"


def _finder(shared, lengths: list[int]):
    def find(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        cells = shared.value
        for chunk in chunks(batches):
            hashes, doc = plain_words(chunk)
            begin = np.searchsorted(doc, np.arange(len(chunk)))
            for n in lengths:
                found, first = grams(hashes, doc, n)
                found = found + np.uint64(SEED - n)
                bit = (found & np.uint64(BITS - 1)).astype(np.int64)
                hit = np.flatnonzero((cells[bit >> 6] >> (bit & 63)) & 1)
                gram, text = found[hit].view(np.int64), doc[first[hit]]
                take = pa.array(text)
                yield pa.RecordBatch.from_arrays(
                    [chunk.column("doc_id").take(take), chunk.column("print").take(take), pa.array(gram), pa.array(first[hit] - begin[text])],
                    names=["doc_id", "print", "gram", "at"],
                )

    return find


def align(items: np.ndarray, sizes: np.ndarray, windows: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Best local alignment score of each item (a row, ``sizes`` words of it) with its window, and the column after its end."""
    n, width = windows.shape
    row = np.zeros((n, width + 1), np.int32)
    step = -GAP * np.arange(width + 1, dtype=np.int32)
    best, end = np.zeros(n, np.int32), np.zeros(n, np.int64)
    for i in range(items.shape[1]):
        same = np.where(windows == items[:, i : i + 1], MATCH, MISMATCH).astype(np.int32)
        new = np.maximum(row + GAP, 0)
        new[:, 1:] = np.maximum(new[:, 1:], row[:, :-1] + same)
        # a gap in the passage costs GAP per window word: a running maximum with the cost added back
        new = np.maximum(np.maximum.accumulate(new + step, axis=1) - step, 0)
        row = np.where((i < sizes)[:, None], new, 0).astype(np.int32)
        top = row.max(axis=1)
        better = top > best
        end = np.where(better, row.argmax(axis=1), end)
        best = np.maximum(best, top)
    return best, end


MATCHES = "doc_id bigint, print bigint, piece bigint, score double, first_word bigint, last_word bigint"
ROWS = 2_000


def _candidates(todo: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Of each list of beginnings, the first in every stretch of ``MARGIN`` words: the list's number and the beginning."""
    own = np.repeat(np.arange(len(todo)), todo.value_lengths().to_numpy())
    at = todo.flatten().to_numpy()
    order = np.lexsort((at, own))
    own, at = own[order], at[order]
    new = np.ones(len(at), bool)
    new[1:] = (np.diff(own) != 0) | (np.diff(at // MARGIN) != 0)
    return own[new], at[new]


def _aligner(least: float):
    def score(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for chunk in chunks(batches):
            hashes, doc = plain_words(chunk)
            begin = np.searchsorted(doc, np.arange(len(chunk) + 1))
            todo = chunk.column("todo")
            holder = np.repeat(np.arange(len(chunk)), todo.value_lengths().to_numpy())
            rows = todo.flatten()
            which, ats = _candidates(rows.field("ats"))
            for a in range(0, len(which), ROWS):
                row, at = which[a : a + ROWS], ats[a : a + ROWS]
                own, words = holder[row], rows.field("words").take(pa.array(row))
                sizes = words.value_lengths().to_numpy().astype(np.int64)
                width = max(PASSAGE, int(sizes.max()))
                items = np.full((len(own), width), 2, np.uint64)
                filled = np.arange(width) < sizes[:, None]
                items[filled] = words.flatten().to_numpy().view(np.uint64)
                low = begin[own] + np.maximum(0, at - MARGIN)
                place = low[:, None] + np.arange(width + 2 * MARGIN)
                known = place < np.minimum(begin[own + 1], low + np.maximum(sizes, PASSAGE) + 2 * MARGIN)[:, None]
                windows = np.where(known, hashes[np.minimum(place, max(0, len(hashes) - 1))], np.uint64(1))
                # no alignment matches more words than are there
                shared = sum((windows == items[:, i : i + 1]).any(axis=1) & filled[:, i] for i in range(width))
                able = np.flatnonzero(shared / np.minimum(sizes, PASSAGE) >= least)
                row, own, sizes, items, filled, low, windows = (x[able] for x in (row, own, sizes, items, filled, low, windows))
                best, end = align(items, sizes, windows)
                # the same backwards gives the beginning
                back = np.take_along_axis(items, np.where(filled, sizes[:, None] - 1 - np.arange(width), np.arange(width)), axis=1)
                _, rest = align(back, sizes, windows[:, ::-1])
                first = low - begin[own] + windows.shape[1] - rest
                last = low - begin[own] + end - 1
                text, item = pa.array(own), pa.array(row)
                yield pa.RecordBatch.from_arrays(
                    [
                        chunk.column("doc_id").take(text), chunk.column("print").take(text), rows.field("piece").take(item),
                        pa.array(np.minimum(1, best / (MATCH * np.minimum(sizes, PASSAGE)))), pa.array(first), pa.array(last),
                    ],
                    names=["doc_id", "print", "piece", "score", "first_word", "last_word"],
                )

    return score


def matches(docs: DataFrame, items: DataFrame, doc_id: str = "doc_id", text: str = "text", item_id: str = "item_id", item_text: str = "text", least: float = LEAST) -> DataFrame:
    """doc_id, print, item_id, score, first_word, last_word: texts that hold (a part of) an item, at its best."""
    spark = docs.sparkSession
    rows = docs.select(F.col(doc_id).cast("bigint").alias("doc_id"), whole(F.col(text)).alias("text"))
    rows = rows.select("doc_id", F.xxhash64("text").alias("print"), F.lower("text").alias("text"))
    tests = items.select(F.col(item_id).cast("bigint").alias("item_id"), F.lower(whole(F.col(item_text))).alias("text"))
    cut = stored(tests.mapInArrow(_pieces, PIECES).withColumn("piece", F.xxhash64("words")), "pieces")
    pieces = cut.groupBy("piece").agg(F.first("words").alias("words"))
    runs = seeds(pieces)
    lengths = [r["size"] for r in runs.select("size").distinct().collect()]  # at most SEED rows
    shared = spark.sparkContext.broadcast(bitmap(runs))
    hits = stored(rows.mapInArrow(_finder(shared, lengths), HITS), "hits")

    seen = hits.groupBy("gram").agg(F.count("*").alias("seen"))
    known = stored(runs.join(seen, "gram").select("gram", "piece", "place", (F.col("seen") <= RARE).alias("rare")), "known")
    found = hits.join(known, "gram").groupBy("doc_id", "print", "piece")
    found = found.agg(F.max("rare").alias("rare"), F.min("place").alias("first"), F.max("place").alias("last"), F.collect_set(F.col("at") - F.col("place")).alias("ats"))
    alone = runs.groupBy("piece").agg(F.count_distinct("place").alias("places")).where("places = 1").select("piece", F.lit(True).alias("single"))
    found = found.join(alone, "piece", "left").where("rare or first < last or single")
    todo = found.join(pieces, "piece").groupBy("doc_id", "print").agg(F.collect_list(F.struct("piece", "words", "ats")).alias("todo"))
    todo = stored(todo, "todo")
    # only texts with candidates move; copies of a text under one id are matched once
    few, _ = parted(rows, F.col("print"), todo.select("print"))
    texts = same_text(few, todo, "inner").dropDuplicates(["doc_id", "print"])
    scored = texts.select("doc_id", "print", "text", "todo").mapInArrow(_aligner(least), MATCHES).where(F.col("score") >= least)
    best = F.max(F.struct("score", (-F.col("first_word")).alias("minus"), "last_word")).alias("best")
    scored = scored.join(cut.select("piece", "item_id"), "piece").groupBy("doc_id", "print", "item_id").agg(best)
    return scored.select("doc_id", "print", "item_id", "best.score", (-F.col("best.minus")).alias("first_word"), "best.last_word")


def without_leaks(docs: DataFrame, found: DataFrame, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """The rows of ``docs`` that hold no match."""
    own, hashed = unused(docs, "_id"), unused(docs, "_print")
    leaked = stored(found.select(F.col("doc_id").alias(own), F.col("print").alias(hashed)).distinct(), "leaked")
    key = F.xxhash64(whole(quoted(text)))
    few, others = parted(docs, key, leaked.select(hashed))
    same = quoted(doc_id).cast("bigint").eqNullSafe(F.col(own)) & (key == F.col(hashed))
    return few.join(leaked, same, "left_anti").unionByName(others)
