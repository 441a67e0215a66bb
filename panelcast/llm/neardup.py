"""Near duplicates: a multi-index Hamming join of b-bit MinHash signatures.

A text's set holds the hashes of its word shingles. Its signature has 24 symbols of 16 bits, each
from one minimum over the set; two sets agree in a symbol with about the probability of their
similarity. The signature is split into 8 chunks of 3 symbols. If two signatures differ in at most
15 symbols, some chunk differs in at most one (8 chunks with two errors each need 16). So a row
is filed, for each chunk, under the chunk with each of its symbols left out: 24 keys, one for every
allowed error. All pairs within distance 15 share a key. A pair of similarity 0.8 differs in 4.8
symbols on average and in more than 15 with probability 1e-6. ``MORE`` further symbols are not filed; together with
them, a pair of similarity 0.8 differs in more than ``MOST_OF_ALL`` symbols with probability 1e-6, one of similarity 0.4 in nine of ten cases,
so few unlike texts under one key are compared on their sets.

Pairs are never listed key by key:

1. Texts with equal sets are one class; the smallest id of a component's classes names it.
2. Under each key, the member that shares most keys with others (of equals, the one with the smallest id) is the pivot, and every member is
   compared with it, on full sets. Linked members are joined into components.
3. Where a key still holds members outside its pivot's component, these are compared with every
   member of the key, in blocks of bounded size, and only links come out. Members
   of the pivot's component need not be compared with each other: they are linked already.

So every pair under the signature distance is compared or already connected, whatever the size
of a group, and no task holds a group.

Edge cases: a null or empty text, or one without words, has an empty set, is linked with nothing
and kept. A text with fewer words than a shingle has its whole sequence as its only one. Rows
with a null id are linked with nothing and kept. Rows with equal ids are one node if their sets
are equal, and apart if not. No rows give no rows. Other columns are not looked at.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .bytescan import Chunk, chunks, grams, mixed, word_hashes
from .common import buckets, stored
from .graph import components

SYMBOLS, CHUNKS = 24, 8
PER_CHUNK = SYMBOLS // CHUNKS
MOST_ERRORS = 2 * CHUNKS - 1
MORE, MOST_OF_ALL = 24, 24
ALL_CHUNKS = (SYMBOLS + MORE) // PER_CHUNK
#: Members of sets that are compared at once.
AT_ONCE = 1 << 22
BLOCK = 1_024
ROWS_PER_TASK = 2_000

_rng = np.random.default_rng(7)
_draws = [_rng.integers(low, 2**63, n, dtype=np.uint64) for n in (SYMBOLS, MORE) for low in (1, 0)]
_FACTORS = np.concatenate(_draws[::2]) * np.uint64(2) + np.uint64(1)
_SHIFTS = np.concatenate(_draws[1::2])

SIGNED = "doc_id bigint, print bigint, n bigint, f1 bigint, f2 bigint, " + ", ".join(f"c{i} bigint" for i in range(ALL_CHUNKS))


def shingle_sets(chunk: Chunk, n: int) -> tuple[np.ndarray, np.ndarray]:
    """The distinct shingles of each text, sorted, one text after another, and where each begins."""
    hashes, _, _, doc = word_hashes(chunk, lower=True)
    runs, first = grams(hashes, doc, n)
    word_at = np.searchsorted(doc, np.arange(len(chunk) + 1))
    run_at = np.searchsorted(doc[first] if len(first) else first, np.arange(len(chunk) + 1))
    sets, at = [], [0]
    for i in range(len(chunk)):
        a, b = word_at[i], word_at[i + 1]
        if b - a >= n:
            found = np.unique(runs[run_at[i] : run_at[i + 1]])
        elif b > a:
            own, _ = grams(hashes[a:b], doc[a:b], b - a)
            found = mixed(own + np.uint64(b - a))
        else:
            found = np.zeros(0, np.uint64)
        sets.append(found)
        at.append(at[-1] + len(found))
    return np.concatenate(sets) if sets else np.zeros(0, np.uint64), np.array(at)


def _prints(sets: np.ndarray, at: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Two sums over each set that name it; 0 for the empty set."""
    out = []
    for salt in (0x5851F42D4C957F2D, 0x14057B7EF767814F):
        total = np.concatenate([np.zeros(1, np.uint64), np.cumsum(mixed(sets ^ np.uint64(salt)), dtype=np.uint64)])
        out.append((total[at[1:]] - total[at[:-1]]).view(np.int64))
    return out[0], out[1]


def _signer(n: int):
    def sign(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for chunk in chunks(batches):
            sets, at = shingle_sets(chunk, n)
            sizes = np.diff(at)
            full = np.flatnonzero(sizes)
            parts = np.zeros((ALL_CHUNKS, len(chunk)), np.int64)
            if len(full):
                for s in range(SYMBOLS + MORE):
                    least = np.minimum.reduceat(mixed(sets * _FACTORS[s] + _SHIFTS[s]), at[:-1][full])
                    symbol = (mixed(least) & np.uint64(0xFFFF)).astype(np.int64)
                    parts[s // PER_CHUNK, full] |= symbol << (16 * (s % PER_CHUNK))
            f1, f2 = _prints(sets, at)
            yield pa.RecordBatch.from_arrays(
                [chunk.column("doc_id").cast(pa.int64()), chunk.column("print"), *(pa.array(x) for x in (sizes.astype(np.int64), f1, f2, *parts))],
                names=["doc_id", "print", "n", "f1", "f2", *(f"c{i}" for i in range(ALL_CHUNKS))],
            )

    return sign


def _setter(n: int):
    def build(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for chunk in chunks(batches):
            sets, at = shingle_sets(chunk, n)
            f1, f2 = _prints(sets, at)
            own = (f1 == chunk.column("f1").to_numpy()) & (f2 == chunk.column("f2").to_numpy())
            body = pa.array([sets[a:b].tobytes() for a, b in zip(at[:-1], at[1:])], pa.binary())
            kept = ["id", *(f"c{i}" for i in range(ALL_CHUNKS))]
            rows = pa.RecordBatch.from_arrays([*(chunk.column(c) for c in kept), body], names=[*kept, "items"])
            yield rows.filter(pa.array(own))

    return build


def _common(a: np.ndarray, b: np.ndarray) -> int:
    """Shared members of two sorted sets."""
    if len(a) > len(b):
        a, b = b, a
    at = np.searchsorted(b, a)
    at[at == len(b)] = 0
    return int(np.count_nonzero(b[at] == a)) if len(b) else 0


def _linked(a: np.ndarray, b: np.ndarray, percent: int) -> bool:
    if 100 * min(len(a), len(b)) < percent * max(len(a), len(b)):
        return False
    both = _common(a, b)
    return 100 * both >= percent * (len(a) + len(b) - both)


def _linked_with(a: np.ndarray, others: list[np.ndarray], percent: int) -> np.ndarray:
    """Which of the sorted sets are linked with ``a``, many at a time."""
    sizes = np.array([len(b) for b in others], np.int64)
    ends = np.cumsum(sizes)
    both = np.zeros(len(others), np.int64)
    i = 0
    while i < len(others):
        j = max(i + 1, int(np.searchsorted(ends, ends[i] - sizes[i] + AT_ONCE, "right")))
        held = np.concatenate(others[i:j])
        at = np.minimum(np.searchsorted(a, held), len(a) - 1)
        both[i:j] = np.add.reduceat((a[at] == held).astype(np.int64), np.r_[0, np.cumsum(sizes[i:j])[:-1]])
        i = j
    return 100 * both >= percent * (len(a) + sizes - both)


def _verifier(percent: int):
    def verify(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            left, right = batch.column("left"), batch.column("right")
            keep = [_linked(np.frombuffer(x.as_py(), np.uint64), np.frombuffer(y.as_py(), np.uint64), percent) for x, y in zip(left, right)]
            yield batch.select(["a", "b"]).filter(pa.array(keep, pa.bool_()))

    return verify


def _blocks(percent: int):
    masks = [((1 << 48) - 1) & ~(0xFFFF << (16 * s)) for s in range(PER_CHUNK)]

    def compare(rows: pd.DataFrame) -> pd.DataFrame:
        """Links between the rest (side 0) and the members (side 1) of each block.

        A pair is compared under the first key it shares, and a row stops at its first link to a component.
        """
        rows = rows.sort_values(["key", "rb", "mb"], ignore_index=True)
        blocks = rows[["key", "rb", "mb"]].to_numpy()
        begins = np.flatnonzero(np.r_[True, (blocks[1:] != blocks[:-1]).any(axis=1)])
        ids, roots, side = (rows[c].to_numpy() for c in ("id", "root", "side"))
        signs = rows[[c for c in (f"c{i}" for i in range(ALL_CHUNKS)) if c in rows]].to_numpy()
        sets = [np.frombuffer(x, np.uint64) for x in rows["items"]]
        sizes = np.array([len(x) for x in sets])
        out = []
        for a, b in zip(begins, np.r_[begins[1:], len(rows)]):
            number = int(blocks[a, 0]) >> 48
            members = a + np.flatnonzero(side[a:b] == 1)
            for x in a + np.flatnonzero(side[a:b] == 0):
                other = members[roots[members] != roots[x]]
                differ = signs[other] ^ signs[x]
                new = np.ones(len(other), bool)
                for k in range(number):
                    new &= (differ[:, k // PER_CHUNK] & masks[k % PER_CHUNK]) != 0
                low, high = np.minimum(sizes[other], sizes[x]), np.maximum(sizes[other], sizes[x])
                new &= 100 * low >= percent * high
                errors = sum(((differ >> (16 * s)) & 0xFFFF != 0).astype(np.int64) for s in range(PER_CHUNK))
                near = (errors[:, :CHUNKS].sum(axis=1) <= MOST_ERRORS) & (errors.sum(axis=1) <= MOST_OF_ALL)
                near = other[new & near]
                linked = near[_linked_with(sets[x], [sets[y] for y in near], percent)]
                # one link to each component is enough
                _, first = np.unique(roots[linked], return_index=True)
                out += [(ids[x], ids[y]) for y in linked[np.sort(first)]]
        return pd.DataFrame(out, columns=["a", "b"]).astype("int64")

    return compare


def _keys(chunk_columns: list[Column]) -> Column:
    """Each chunk with each symbol left out; chunk and symbol number above the symbols' 48 bits."""
    keys = []
    for c, column in enumerate(chunk_columns):
        for s in range(PER_CHUNK):
            mask = ((1 << 48) - 1) & ~(0xFFFF << (16 * s))
            keys.append(column.bitwiseAND(F.lit(mask)).bitwiseOR(F.lit((c * PER_CHUNK + s) << 48)))
    return F.array(*keys)


def near_duplicates(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", words: int = 5, percent: int = 80) -> DataFrame:
    """doc_id, print (the text's hash), n_shingles, component_id, kept of every row of ``docs``."""
    rows = docs.select(F.col(doc_id).cast("bigint").alias("doc_id"), F.col(text).alias("text"))
    signed = stored(rows.select("doc_id", "text", F.xxhash64("text").alias("print")).mapInArrow(_signer(words), SIGNED), "signatures")
    own = [f"c{i}" for i in range(ALL_CHUNKS)]
    classes = signed.where("n > 0 and doc_id is not null").groupBy("n", "f1", "f2").agg(F.min("doc_id").alias("least"), *(F.first(c).alias(c) for c in own))
    # a class goes by its set, as one id may have several
    classes = stored(classes.withColumn("id", F.xxhash64("n", "f1", "f2")), "classes")
    filed = classes.select("id", "least", F.explode(_keys([F.col(c) for c in own[:CHUNKS]])).alias("key"))
    # written, so that the join can split a hot key
    shared = stored(filed.groupBy("key").agg(F.count("*").alias("members")).where("members > 1"), "shared")
    filed = stored(filed.join(shared, "key"), "filed")

    weight = filed.groupBy("id").agg(F.sum("members").alias("weight"))
    pivots = filed.join(weight, "id").groupBy("key").agg(F.max(F.struct("weight", F.bitwise_not("least").alias("first"), "id")).alias("top"))
    pivots = stored(pivots.select("key", F.col("top.id").alias("pivot")), "pivots")
    pairs = stored(filed.join(pivots, "key").where("id <> pivot").select(F.least("id", "pivot").alias("a"), F.greatest("id", "pivot").alias("b")).distinct(), "pairs")

    met = filed.select("id").distinct().join(classes.drop("n"), "id")
    texts = met.join(rows, F.col("least") == F.col("doc_id")).select("id", "text", "f1", "f2", *own)
    sets = texts.mapInArrow(_setter(words), "id bigint, " + ", ".join(f"{c} bigint" for c in own) + ", items binary")
    sets = stored(sets, "sets")
    links = stored(_verify(pairs, sets, percent), "links")
    found = components(links)

    labelled = filed.join(found, F.col("id") == F.col("node"), "left").select("key", "id", "members", F.coalesce("root", "id").alias("root"))
    labelled = stored(labelled, "labelled")
    lead = pivots.join(found, F.col("pivot") == F.col("node"), "left").select("key", F.coalesce("root", "pivot").alias("lead"))
    outside = stored(labelled.join(lead, "key").where("root <> lead").select("key", "id", "root", "members"), "outside")
    if not outside.isEmpty():
        more = _rest(labelled, outside, sets, percent)
        found = components(links.unionByName(more))

    told = classes.select("n", "f1", "f2", "id", "least").join(found, F.col("id") == F.col("node"), "left")
    told = stored(told.select("n", "f1", "f2", "least", F.coalesce("root", "id").alias("root")), "roots")
    smallest = told.groupBy("root").agg(F.min("least").alias("smallest"))
    named = signed.join(told.join(smallest, "root").select("n", "f1", "f2", "smallest"), ["n", "f1", "f2"], "left")
    component = F.when(F.col("n") == 0, F.col("doc_id")).otherwise(F.col("smallest"))
    return named.select(
        "doc_id", "print", F.col("n").alias("n_shingles"), F.when(F.col("doc_id").isNotNull(), component).alias("component_id")
    ).select("*", F.coalesce(F.col("doc_id") == F.col("component_id"), F.lit(True)).alias("kept"))


def _verify(pairs: DataFrame, sets: DataFrame, percent: int) -> DataFrame:
    left = sets.select(F.col("id").alias("a"), F.col("items").alias("left"))
    right = sets.select(F.col("id").alias("b"), F.col("items").alias("right"))
    return pairs.join(left, "a").join(right, "b").select("a", "b", "left", "right").mapInArrow(_verifier(percent), "a bigint, b bigint")


def _rest(labelled: DataFrame, outside: DataFrame, sets: DataFrame, percent: int) -> DataFrame:
    """Links of the members outside their key's leading component, found block by block."""
    counts = stored(outside.groupBy("key").agg(F.count("*").alias("rest")), "rest")
    # keys with the same members are one: the smallest stands for all
    prints = (F.bit_xor(F.xxhash64("id")).alias("p1"), F.bit_xor(F.xxhash64("id", F.lit(1))).alias("p2"), F.min("id").alias("p3"), F.count("*").alias("p4"))
    alike = labelled.join(counts, "key").groupBy("key", "rest").agg(*prints)
    counts = stored(alike.groupBy("p1", "p2", "p3", "p4").agg(F.min(F.struct("key", "rest")).alias("k")).select("k.key", "k.rest"), "rest")
    rest_blocks = F.ceil(F.col("rest") / BLOCK).cast("int")
    member_blocks = F.ceil(F.col("members") / BLOCK).cast("int")
    place = lambda n: F.pmod(F.xxhash64("id"), n).cast("int")
    every = lambda n: F.explode(F.sequence(F.lit(0), n - 1))
    members = labelled.join(counts, "key").select("*", F.lit(1).alias("side"), place(member_blocks).alias("mb"), every(rest_blocks).alias("rb"))
    rest = outside.join(counts, "key").select("*", F.lit(0).alias("side"), place(rest_blocks).alias("rb"), every(member_blocks).alias("mb"))
    names = ["key", "id", "root", "side", "rb", "mb"]
    dealt = stored(members.select(names).unionByName(rest.select(names)), "dealt")
    tasks = buckets(dealt.count(), ROWS_PER_TASK)
    dealt = dealt.join(sets, "id").withColumn("task", F.pmod(F.xxhash64("key", "rb", "mb"), F.lit(tasks)))
    return stored(dealt.groupBy("task").applyInPandas(_blocks(percent), "a bigint, b bigint").distinct(), "links")
