"""Phrase collocations: Misra-Gries summaries find every frequent phrase, a second pass counts exactly.

Texts, with A-Z in lower case, are split into pieces at marks and line ends and these into words at blanks. A
phrase is 1 to ``longest`` neighbouring words of a piece; everything is counted per language. A phrase is no
more frequent than any phrase inside it, so lengths are surveyed in rising order, and a phrase is looked
at only where the two phrases one word shorter have survived.

1. Survey of a length: a task counts the hashes of the phrases it reads. The counts are dealt into hash
   partitions, each of which keeps a Misra-Gries summary: at most ``capacity`` counters; where more are needed, all are lowered by the
   largest that has to go. What was taken off, ``lost``, is at most the partition's mass / (capacity + 1). The
   capacity exceeds the mass expected of a partition / ``least``, and doubles before ``lost`` would reach
   ``least``, so a frequent phrase always has a counter. A counter plus ``lost`` is no less than the true count;
   those that reach ``least`` survive. Summaries of parts of a partition add up to one of the whole (``Summary.add``).
   Within a partition, 32 bits of the hash name a phrase: phrases with one name are counted together, which only lets more survive.
2. Survivors set bits of a sieve of at most ``MOST_BITS`` bits. What a sieve lets through by chance is
   counted exactly and dropped.
3. Exact counts: the texts are read again; phrases that pass the sieves are counted under their own
   words, not their hashes. Scores, containment and ranks are joins of these counts.

Scale: a task holds some megabytes of text, a bounded table of hashes or one summary, whose size is set by
``MASS_PER_PART``. The driver gets a sum and a sieve of bounded size. Texts are never shuffled, only counts that are summed
first; a phrase in every text is one row a task, and the join on a common first word is one of written tables,
which Spark splits. Ranks are cut to ``top`` per language and slice before they meet.

Edge cases: a null text is empty, a null language is ``und``. Empty texts and pieces hold no words. Repeated rows
count each. Ties in score go by count, then phrase, so ranks are unique. No rows give no rows. Other
columns are not looked at.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .bytescan import LOWERED, Chunk, chunks, mixed, prefix_hashes, span_hashes
from .common import buckets, stored, whole

MARKS = ".,;:!?\n\x0b\x0c\r"
LONGEST = 5
LEAST = 100
TOP = 2_000
#: Hashes a task holds before it hands its counts on.
TABLE = 4_000_000
#: Bytes of text for each word, by which the mass is expected; and the occurrences meant for a hash partition: at
#: most, and as long as there are more tasks to use.
WORD_BYTES = 6
MASS_PER_PART, SMALL_PART = 64_000_000, 1_000_000
#: Counters for each one that the expected mass needs.
SLACK = 4
MOST_BITS = 1 << 28
BITS_PER_SURVIVOR = 32
#: Slices of a language whose best rows are taken before they meet.
SLICES = 64

_IS_MARK = np.zeros(256, bool)
_IS_MARK[list(MARKS.encode())] = True
_PARTS = _IS_MARK.copy()
_PARTS[[32, 9]] = True


@dataclass
class Words:
    """The words of a chunk, one blank between them: where each begins, its size, its piece and its text."""

    joined: np.ndarray
    begin: np.ndarray
    size: np.ndarray
    piece: np.ndarray
    doc: np.ndarray
    prefix: np.ndarray
    salt: np.ndarray

    def hashes(self, first: np.ndarray, n: int) -> np.ndarray:
        """Of the phrases of ``n`` words that begin with word ``first``; another language gives another hash."""
        end = self.begin[first + n - 1] + self.size[first + n - 1]
        return mixed(span_hashes(self.prefix, self.begin[first], end) ^ self.salt[self.doc[first]])

    def phrases(self, first: np.ndarray, n: int) -> pa.Array:
        begin = self.begin[first]
        size = self.begin[first + n - 1] + self.size[first + n - 1] - begin
        offsets = np.r_[0, np.cumsum(size)]
        data = self.joined[np.arange(offsets[-1]) + np.repeat(begin - offsets[:-1], size)]
        return pa.StringArray.from_buffers(len(first), pa.py_buffer(offsets.astype(np.int32)), pa.py_buffer(data))


def words_of(chunk: Chunk) -> Words:
    data = LOWERED[chunk.data]
    n = len(data)
    inside = np.zeros(n + 2, bool)
    inside[1:-1] = ~_PARTS[data]
    cut = np.zeros(n + 1, bool)
    cut[chunk.starts] = True
    begin = np.flatnonzero(inside[1:-1] & (~inside[:-2] | cut[:-1]))
    end = np.flatnonzero(inside[1:-1] & (~inside[2:] | cut[1:])) + 1
    doc = np.searchsorted(chunk.starts, begin, "right") - 1
    piece = np.cumsum(_IS_MARK[data])[begin] + doc  # both rise, so equal sums are equal pieces
    size = end - begin
    to = np.cumsum(size + 1) - (size + 1)
    joined = np.append(data, np.uint8(32))[np.arange(int((size + 1).sum())) + np.repeat(begin - to, size + 1)]
    joined[to + size] = 32
    salt = chunk.column("salt").to_numpy(zero_copy_only=False).astype(np.int64).view(np.uint64)
    return Words(joined, to, size, piece, doc, prefix_hashes(joined), salt)


def passes(sieve: np.ndarray, hashes: np.ndarray) -> np.ndarray:
    bit = hashes & np.uint64(len(sieve) * 64 - 1)
    return (sieve[(bit >> np.uint64(6)).astype(np.int64)] >> (bit & np.uint64(63))) & np.uint64(1) == 1


def candidates(words: Words, sieves: list[np.ndarray], longest: int) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
    """Length, first words and hashes of the phrases whose parts have survived, as far as sieves are known.

    The sieve of a length is the one with its number, or the last. Lengths without a sieve are
    given as far as the lengths before leave them open."""
    alive = np.arange(len(words.begin))
    for n in range(1, longest + 1):
        if n > 1:
            # the phrase without its last word and the phrase without its first word
            whole_ones = np.flatnonzero(np.diff(alive) == 1)
            alive = alive[whole_ones]
            alive = alive[words.piece[alive] == words.piece[alive + n - 1]]
        hashes = words.hashes(alive, n)
        if n <= len(sieves):
            hit = passes(sieves[n - 1], hashes)
            alive, hashes = alive[hit], hashes[hit]
        yield n, alive, hashes


TALLY = "part int, once binary, many binary, n binary"


def _planes(keys: np.ndarray) -> bytes:
    """Rising 32-bit keys, all their first bytes, all second bytes and so on: the high ones repeat, so they pack well."""
    return keys.astype("<u4").view(np.uint8).reshape(-1, 4).T.tobytes()


def _from_planes(data: bytes) -> np.ndarray:
    return np.ascontiguousarray(np.frombuffer(data, np.uint8).reshape(4, -1).T).view("<u4").ravel()


def _tally(hashes: list[np.ndarray], parts: int) -> pa.RecordBatch:
    """The counts of each hash partition: keys counted once, and others with their counts."""
    every = np.concatenate(hashes)
    low, high = every & np.uint64(0xFFFFFFFF), every >> np.uint64(32)
    found, n = np.unique(((high * np.uint64(parts)) & ~np.uint64(0xFFFFFFFF)) | low, return_counts=True)
    edges = np.searchsorted(found, np.arange(parts + 1, dtype=np.uint64) << np.uint64(32))
    rows = []
    for p in range(parts):
        keys, many = found[edges[p] : edges[p + 1]] & np.uint64(0xFFFFFFFF), n[edges[p] : edges[p + 1]]
        more = many > 1
        rows.append((p, _planes(keys[~more]), _planes(keys[more]), many[more].astype("<u4").tobytes()))
    columns = list(zip(*(r for r in rows if r[1] or r[2]))) or [[]] * 4
    kinds = [pa.int32(), pa.binary(), pa.binary(), pa.binary()]
    return pa.RecordBatch.from_arrays([pa.array(list(c), t) for c, t in zip(columns, kinds)], names=["part", "once", "many", "n"])


def _surveyor(shared: list, shortest: int, longest: int, parts: int):
    def survey(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sieves, held, size = [s.value for s in shared], [], 0
        for chunk in chunks(batches):
            for n, _, hashes in candidates(words_of(chunk), sieves, longest):
                if n >= shortest:
                    held.append(hashes)
                    size += len(hashes)
            if size >= TABLE:
                yield _tally(held, parts)
                held, size = [], 0
        if size:
            yield _tally(held, parts)

    return survey


@dataclass
class Summary:
    """Misra-Gries counters: a key's true count lies between its counter (or 0) and that plus ``lost``, which stays below ``least``."""

    capacity: int
    least: int
    keys: np.ndarray = field(default_factory=lambda: np.zeros(0, np.int64))
    counts: np.ndarray = field(default_factory=lambda: np.zeros(0, np.int64))
    lost: int = 0

    def add(self, keys: np.ndarray, counts: np.ndarray, lost: int = 0) -> None:
        """Counted rows, or the counters of another summary with what it has lost."""
        keys, counts = np.concatenate([self.keys, keys]), np.concatenate([self.counts, counts])
        order = np.argsort(keys, kind="stable")
        keys, counts = keys[order], counts[order]
        new = np.flatnonzero(np.r_[True, keys[1:] != keys[:-1]]) if len(keys) else np.zeros(0, np.int64)
        self.keys, self.counts, self.lost = keys[new], np.add.reduceat(counts, new) if len(new) else counts, self.lost + lost
        while len(self.keys) > self.capacity:
            over = len(self.keys) - self.capacity - 1  # of the counters in rising order, the last that has to go
            off = int(np.partition(self.counts, over)[over])
            if self.lost + off >= self.least:
                self.capacity *= 2
                continue
            left = self.counts > off
            self.keys, self.counts, self.lost = self.keys[left], self.counts[left] - off, self.lost + off

    def reach(self) -> np.ndarray:
        return self.keys[self.counts + self.lost >= self.least]


def _summariser(capacity: int, least: int):
    def summarise(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        parts: dict[int, Summary] = {}
        held: dict[int, list] = {}

        def flush(p: int) -> None:
            keys, counts = (np.concatenate(c) for c in zip(*held.pop(p)))
            parts.setdefault(p, Summary(capacity, least)).add(keys, counts)

        for batch in batches:
            for p, once, many, n in zip(*(batch.column(c).to_pylist() for c in ("part", "once", "many", "n"))):
                keys = np.concatenate([_from_planes(once), _from_planes(many)]).astype(np.int64)
                counts = np.r_[np.ones(len(once) // 4, np.int64), np.frombuffer(n, "<u4").astype(np.int64)]
                held.setdefault(p, []).append((keys, counts))
                if sum(len(k) for k, _ in held[p]) >= max(500_000, capacity):
                    flush(p)
        for p in list(held):
            flush(p)
        for summary in parts.values():
            yield pa.RecordBatch.from_arrays([pa.array(summary.reach())], names=["gram"])

    return summarise


def survivors(rows: DataFrame, shared: list, shortest: int, longest: int, least: int, words: int) -> DataFrame:
    """gram: hashes (their last 32 bits) of all phrases of these lengths counted ``least`` times, and of some others."""
    spark = rows.sparkSession
    mass = words * (longest - shortest + 1)
    tasks = int(spark.conf.get("spark.sql.shuffle.partitions"))
    parts = max(buckets(mass, MASS_PER_PART), min(tasks, buckets(mass, SMALL_PART)))
    capacity = SLACK * (mass // parts // least + 1)
    tally = rows.mapInArrow(_surveyor(shared, shortest, longest, parts), TALLY)
    found = tally.repartition(parts, "part").mapInArrow(_summariser(capacity, least), "gram bigint")
    return stored(found, "phrase-survivors")


def sieve(grams: DataFrame) -> np.ndarray:
    """Bits of the hashes: a power of two of them, 2^16 to ``MOST_BITS``."""
    wanted = grams.count() * BITS_PER_SURVIVOR
    bits = min(MOST_BITS, max(1 << 16, 1 << (wanted - 1).bit_length() if wanted else 0))
    bit = F.col("gram").bitwiseAND(F.lit(bits - 1))
    one = F.call_function("shiftleft", F.lit(1).cast("bigint"), bit.bitwiseAND(F.lit(63)).cast("int"))
    cells = grams.select(F.shiftright(bit, 6).alias("cell"), one.alias("b")).groupBy("cell").agg(F.bit_or("b").alias("b")).toArrow()
    out = np.zeros(bits // 64, np.int64)
    out[cells["cell"].to_numpy()] = cells["b"].to_numpy()
    return out.view(np.uint64)


COUNTED = "lang string, phrase string, n bigint"


def _counter(shared: list, longest: int):
    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sieves = [s.value for s in shared]
        sieves += sieves[-1:] * (longest - len(sieves))
        for chunk in chunks(batches):
            words, lang = words_of(chunk), chunk.column("lang")
            all_words = np.bincount(words.doc, minlength=len(chunk))
            held = [(lang, pa.array([""] * len(chunk)), pa.array(all_words.astype(np.int64)))]
            for n, first, hashes in candidates(words, sieves, longest):
                _, one, many = np.unique(hashes, return_index=True, return_counts=True)
                first = first[one]
                held.append((lang.take(pa.array(words.doc[first])), words.phrases(first, n), pa.array(many.astype(np.int64))))
            for columns in held:
                yield pa.RecordBatch.from_arrays([columns[0].cast(pa.string()), *columns[1:]], names=["lang", "phrase", "n"])

    return count


def phrase_counts(docs: DataFrame, text: str = "text", lang: str = "lang", longest: int = LONGEST, least: int = LEAST) -> DataFrame:
    """lang, phrase, n: every phrase (words too) counted ``least`` times or more; the phrase '' has the number of all words."""
    rows = docs.select(F.coalesce(F.col(lang), F.lit("und")).alias("lang"), whole(F.col(text)).alias("text"))
    rows = rows.select("lang", F.xxhash64("lang").alias("salt"), "text")
    context, shared = docs.sparkSession.sparkContext, []
    words = (rows.agg(F.sum(F.octet_length("text"))).head()[0] or 0) // WORD_BYTES
    # words, pairs, then all longer lengths at once
    for shortest, last in [(1, 1), (2, 2), (3, longest)][: min(3, longest)]:
        shared.append(context.broadcast(sieve(survivors(rows, shared, shortest, last, least, words))))
    counts = rows.mapInArrow(_counter(shared, longest), COUNTED).groupBy("lang", "phrase").agg(F.sum("n").alias("n"))
    return counts.where((F.col("n") >= least) | (F.col("phrase") == ""))


def _lowest_cuts(phrases: DataFrame, counts: DataFrame) -> DataFrame:
    """lang, phrase, a, l, r, n, score of the cut with the lowest score, the first such."""
    words = F.split("phrase", " ")
    cuts = phrases.select("lang", "phrase", F.col("n").alias("a"), words.alias("w"), F.explode(F.sequence(F.lit(1), F.size(words) - 1)).alias("k"))
    # a cut's two parts
    first, rest = F.array_join(F.slice("w", 1, F.col("k")), " "), F.array_join(F.expr("slice(w, k + 1, size(w))"), " ")
    cuts = cuts.select("lang", "phrase", "a", "k", first.alias("first"), rest.alias("rest"))
    cuts = cuts.join(counts.select("lang", F.col("phrase").alias("first"), F.col("n").alias("l")), ["lang", "first"])
    cuts = cuts.join(counts.select("lang", F.col("phrase").alias("rest"), F.col("n").alias("r")), ["lang", "rest"])
    cuts = cuts.join(counts.where("phrase = ''").select("lang", "n"), "lang")
    # 1000 * a * n and l * r may pass 64 bits; 38 digits hold counts up to 10^16
    wide = "(cast(1000 as decimal(5)) * cast(a as decimal(16)) * cast(n as decimal(16)))"
    score = F.expr(f"{wide} div (cast(l as decimal(18)) * cast(r as decimal(18)))")
    best = F.min(F.struct(score.alias("score"), "k", "l", "r")).alias("cut")
    return cuts.groupBy("lang", "phrase", "a", "n").agg(best).select("lang", "phrase", "a", "cut.l", "cut.r", "n", "cut.score")


def _covered(phrases: DataFrame, percent: int) -> DataFrame:
    """lang, phrase of the phrases inside a longer one that is counted ``percent`` in 100 as often, or more."""
    words = F.split("phrase", " ")
    longer = phrases.select("lang", F.col("n").alias("m"), words.alias("w"), F.size(words).alias("size")).where("size > 2")
    slices = "transform(sequence(2, size - 1), s -> transform(sequence(1, size - s + 1), i -> array_join(slice(w, i, s), ' ')))"
    inside = longer.select("lang", "m", F.explode(F.flatten(F.expr(slices))).alias("phrase"))
    most = inside.groupBy("lang", "phrase").agg(F.max("m").alias("m"))
    return phrases.join(most, ["lang", "phrase"]).where(F.lit(100) * F.col("m") >= F.lit(percent) * F.col("n")).select("lang", "phrase")


def collocations(docs: DataFrame, text: str = "text", lang: str = "lang", longest: int = LONGEST, least: int = LEAST, top: int = TOP, percent: int = 100) -> DataFrame:
    """lang, rank, phrase, a, l, r, n, score: each language's ``top`` phrases whose words are found together beyond chance."""
    counts = stored(phrase_counts(docs, text, lang, longest, least), "phrase-counts")
    phrases = counts.where("phrase like '% %'")
    scored = _lowest_cuts(phrases, counts).join(_covered(phrases, percent), ["lang", "phrase"], "left_anti")
    order = [F.col("score").desc(), F.col("a").desc(), F.col("phrase")]
    part = F.pmod(F.xxhash64("phrase"), F.lit(SLICES))
    few = scored.withColumn("slice", part).withColumn("rank", F.row_number().over(Window.partitionBy("lang", "slice").orderBy(*order))).where(F.col("rank") <= top)
    ranked = few.withColumn("rank", F.row_number().over(Window.partitionBy("lang").orderBy(*order)).cast("bigint")).where(F.col("rank") <= top)
    return ranked.select("lang", "rank", "phrase", "a", "l", "r", "n", "score")
