"""Removal of repeated passages: a suffix sort with hash-compared suffixes.

A byte is removed if a string of ``LENGTH`` bytes that covers it also starts anywhere else in the
corpus. A suffix is sorted for every start, but only those that can be equal meet:

1. Anchors. A position is an anchor if, among the hashes of the next ``WINDOW`` short substrings,
   the least is the first or the last. This depends on the following bytes only, and every run of
   ``WINDOW`` starts holds an anchor, so equal strings have their first anchor at the same distance. An
   anchor owns the starts after the anchor before it. Strings it owns share its *core*, the bytes that
   all of them cover; its *context* is all that they cover together.
2. Cores that occur once own no repeated string. Equal contexts are one weighted context; one that
   occurs twice has repeated strings only.
3. What is left, contexts that occur once beside others with the same core, is where repeated
   passages begin and end. Their texts are cut out and dealt by core; each task
   sorts the suffixes of its contexts by merge sort, where a comparison takes binary search over
   prefix hashes (``suffixsort``). Neighbours with ``LENGTH`` bytes in common are repeated, which is
   verified byte by byte.
4. A core with more than ``MOST_CONTEXTS`` different contexts (the edge of a passage in very many documents) is split
   before it is sorted: the distances of its strings are halved, and a half has a longer core of its own, what all its strings
   cover. Contexts that are equal, byte by byte, in a half are one there, and repeated; those alone with their core are done. So a
   half keeps what differs near the passage's edge only, and a single distance nothing but equal strings: eight
   halvings at most.

A context's name, by which whole contexts are counted in step 2, has 128 bits (its core's hash and its own).

Scale: the first steps shuffle one short row per 96 bytes of text, summed before the shuffle where
copies abound. Only texts that hold a context to cut out, or a span to remove, move, once each; a sieve of fixed size
tells (``common.parted``).

Edge cases: a null text has no bytes. Texts shorter than ``LENGTH`` lose nothing. Repeated rows are copies
of each other, with equal or null ids too. No rows give no rows. Removal may cut a character in
two, as the strings are bytes. Other columns are not looked at.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .bytescan import Chunk, chunks, mixed, prefix_hashes, span_hashes
from .common import buckets, parted, same_text, stored, whole
from .suffixsort import Suffixes, merge_sort

LENGTH = 400
GRAM = 16
#: 2 * WINDOW - 2 + GRAM <= LENGTH: the choice of a string's first anchor is seen inside the string.
WINDOW = 192
CORE = LENGTH - WINDOW + 1
MOST_CONTEXTS = 4_096
CONTEXTS_PER_TASK = 2_000

ANCHORS = "doc_id bigint, print bigint, core bigint, context bigint, place bigint"


def _sliding_least(h: np.ndarray, width: int) -> np.ndarray:
    """Minimum of each ``width`` neighbours."""
    out, reach = h, 1
    while reach * 2 <= width:
        out = np.minimum(out[:-reach], out[reach:])
        reach *= 2
    rest = width - reach
    return np.minimum(out[: len(out) - rest], out[rest:]) if rest else out


def find_anchors(chunk: Chunk) -> tuple[np.ndarray, ...]:
    """Text number, position in the chunk, least and most distance of the owned starts, core hash."""
    n, none = len(chunk.data), np.zeros(0, np.int64)
    if n < LENGTH:
        return none, none, none, none, none.astype(np.uint64)
    prefix = prefix_hashes(chunk.data)
    at = np.arange(n - GRAM + 1)
    grams = mixed(span_hashes(prefix, at, at + GRAM))
    least = _sliding_least(grams, WINDOW)
    p = np.flatnonzero((grams[: len(least)] == least) | (grams[WINDOW - 1 :] == least))
    doc = np.searchsorted(chunk.starts, p, "right") - 1
    begin, end = chunk.starts[doc], chunk.starts[doc + 1]
    inside = p + WINDOW - 1 + GRAM <= end
    p, doc, begin, end = p[inside], doc[inside], begin[inside], end[inside]
    before = np.r_[-1, p[:-1]] if len(p) else p
    before = np.maximum(before, begin - 1)
    most = p - before - 1
    nearest = np.maximum(0, p - (end - LENGTH))
    own = nearest <= most
    p, doc, nearest, most = p[own], doc[own], nearest[own], most[own]
    return doc, p, nearest, most, mixed(span_hashes(prefix, p, p + CORE))


def _pack(place: np.ndarray, nearest: np.ndarray, most: np.ndarray) -> np.ndarray:
    return (place << 16) | (nearest << 8) | most


def _anchors(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for chunk in chunks(batches):
        doc, p, nearest, most, core = find_anchors(chunk)
        body = memoryview(chunk.data)
        place = _pack(p - chunk.starts[doc], nearest, most)
        named = [
            xxhash.xxh3_64_intdigest(body[a:b], s)
            for a, b, s in zip((p - most).tolist(), (p + LENGTH - nearest).tolist(), (place & 0xFFFF).tolist())
        ]
        yield pa.RecordBatch.from_arrays(
            [
                chunk.column("doc_id").take(pa.array(doc)), chunk.column("print").take(pa.array(doc)),
                pa.array(core.view(np.int64)), pa.array(np.array(named, np.uint64).view(np.int64)), pa.array(place),
            ],
            names=["doc_id", "print", "core", "context", "place"],
        )


CUT = "core bigint, context bigint, n bigint, kinds bigint, doc_id bigint, print bigint, place bigint, body binary"


def _cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The text of each wanted context."""
    for chunk in chunks(batches):
        todo = chunk.column("todo")
        doc = np.repeat(np.arange(len(chunk)), todo.value_lengths().fill_null(0).to_numpy())
        rows = todo.flatten()
        place = rows.field("place").to_numpy()
        p = chunk.starts[doc] + (place >> 16)
        body = [chunk.data[a:b].tobytes() for a, b in zip(p - (place & 255), p + LENGTH - ((place >> 8) & 255))]
        ids = [chunk.column(c).take(pa.array(doc)) for c in ("doc_id", "print")]
        fields = {"core": rows.field("core"), "context": rows.field("context"), "n": rows.field("n"), "kinds": rows.field("kinds")}
        yield pa.RecordBatch.from_arrays([*fields.values(), *ids, rows.field("place"), pa.array(body, pa.binary())], names=[*fields, "doc_id", "print", "place", "body"])


def _starts(nearest: np.ndarray, most: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Context number and distance of every owned start."""
    many = most - nearest + 1
    owner = np.repeat(np.arange(len(many)), many)
    return owner, np.arange(len(owner)) - np.repeat(np.cumsum(many) - many, many) + nearest[owner]


def repeated_starts(cores: np.ndarray, bodies: list[bytes], nearest: np.ndarray, most: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Context number and distance of the owned starts whose string is found in another context."""
    data = np.frombuffer(b"".join(bodies), np.uint8)
    base = np.cumsum([0, *(len(b) for b in bodies)])[:-1]
    owner, distance = _starts(nearest, most)
    at = base[owner] + most[owner] - distance
    _, core = np.unique(cores, return_inverse=True)
    group = core[owner] * WINDOW + distance
    suffixes = Suffixes(data, LENGTH)
    order = merge_sort(suffixes, at, group)
    a, b = order[:-1], order[1:]
    near = np.flatnonzero(group[a] == group[b])
    near = near[suffixes.common(at[a[near]], at[b[near]]) >= LENGTH]
    near = near[suffixes.equal_bytes(at[a[near]], at[b[near]])]
    hit = np.zeros(len(at), bool)
    hit[a[near]] = hit[b[near]] = True
    return owner[hit], distance[hit]


def _sorted(rows: pd.DataFrame) -> pd.DataFrame:
    """Removed spans of the contexts that occur once, from the sorted suffixes of a group's cores."""
    place = rows["place"].to_numpy()
    owner, distance = repeated_starts(rows["core"].to_numpy(), list(rows["body"]), (place >> 8) & 255, place & 255)
    lone = rows["n"].to_numpy()[owner] == 1
    start = (place >> 16)[owner[lone]] - distance[lone]
    found = rows.iloc[owner[lone]]
    out = pd.DataFrame({"doc_id": found["doc_id"].to_numpy(), "print": found["print"].to_numpy(), "a": start})
    out = out.sort_values(["print", "doc_id", "a"], ignore_index=True)
    # neighbouring starts make one span
    step = (out["a"].diff() != 1) | (out["print"].diff() != 0) | (out["doc_id"].ne(out["doc_id"].shift()) & ~(out["doc_id"].isna() & out["doc_id"].shift().isna()))
    spans = out.groupby(step.cumsum()).agg(doc_id=("doc_id", "first"), print=("print", "first"), a=("a", "min"), b=("a", "max"))
    return spans.assign(b=spans["b"] + LENGTH, doc_id=spans["doc_id"].astype("Int64"))


UNIT = "core bigint, lo int, hi int, n bigint, doc_id bigint, print bigint, place bigint, body binary"
_NAMED = ["core", "lo", "hi", "near", "h1", "h2"]


def _halves(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Both halves of each unit's distances, with the core that all strings of a half cover, and a name of 128 bits."""
    for batch in batches:
        ids = {c: batch.column(c) for c in ("n", "doc_id", "print")}
        out: list[tuple] = []
        for i, (lo, hi, place, body) in enumerate(zip(*(batch.column(c).to_pylist() for c in ("lo", "hi", "place", "body")))):
            p, least, most, middle = place >> 16, (place >> 8) & 255, place & 255, (lo + hi) // 2
            for low, high in ((lo, middle), (middle + 1, hi)):
                a, b = max(low, least), min(high, most)
                if a <= b:
                    own = body[most - b : most - a + LENGTH]
                    core = xxhash.xxh3_64_intdigest(own[b - low : b - high + LENGTH], low << 8 | high)
                    h1, h2 = np.frombuffer(xxhash.xxh3_128_digest(own, a << 8 | b), np.int64).tolist()
                    out.append((i, core, low, high, p << 16 | a << 8 | b, own, h1, h2))
        take, core, low, high, place, body, h1, h2 = zip(*out) if out else [()] * 8
        at = pa.array(take, pa.int64())
        yield pa.RecordBatch.from_arrays(
            [
                pa.array(np.array(core, np.uint64).view(np.int64)), pa.array(low, pa.int32()), pa.array(high, pa.int32()), *(c.take(at) for c in ids.values()),
                pa.array(place, pa.int64()), pa.array(body, pa.binary()), pa.array(h1, pa.int64()), pa.array(h2, pa.int64()),
            ],
            names=["core", "lo", "hi", *ids, "place", "body", "h1", "h2"],
        )


def _whole_span() -> tuple:
    """Begin and end of what a unit's strings cover together."""
    nearest, most = F.shiftright("place", 8).bitwiseAND(F.lit(255)), F.col("place").bitwiseAND(F.lit(255))
    start = F.shiftright("place", 16)
    return (start - most).alias("a"), (start - nearest + LENGTH).alias("b")


def _halved(hot: DataFrame) -> tuple[DataFrame, DataFrame]:
    """The halves of ``hot`` units, equal ones as one, and the spans (doc_id, print, a, b) of those that are equal."""
    near = F.col("place").bitwiseAND(F.lit(0xFFFF)).alias("near")
    halves = stored(hot.mapInArrow(_halves, f"{UNIT}, h1 bigint, h2 bigint").select("*", near), "halves")
    named = halves.groupBy(*_NAMED).agg(
        F.count("*").alias("c"), F.sum("n").alias("sum"), F.min(F.struct("doc_id", "print", "place")).alias("one"), F.min("body").alias("body"), F.max("body").alias("other"),
    )
    named = stored(named.select(*_NAMED, "c", "sum", "one", "body", (F.col("body") == F.col("other")).alias("equal")), "named")
    twice = named.where("c > 1 and equal").select(*_NAMED)
    resolved = halves.where("n = 1").join(twice, _NAMED).select("doc_id", "print", *_whole_span())
    one = named.where("equal").select("core", "lo", "hi", F.col("sum").alias("n"), "one.*", "body")
    # a name of two bodies names nothing
    apart = halves.join(named.where("not equal").select(*_NAMED), _NAMED).select(one.columns)
    return stored(one.unionByName(apart), "units"), resolved


STRIPPED = "doc_id bigint, n_bytes bigint, removed array<struct<a:bigint,b:bigint>>, kept_sha256 string"


def _strip(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The union of each text's spans, and the hash of what is outside them."""
    for chunk in chunks(batches):
        out = []
        for i, (doc_id, spans) in enumerate(zip(chunk.column("doc_id").to_pylist(), chunk.column("spans"))):
            body = chunk.data[chunk.starts[i] : chunk.starts[i + 1]]
            union, kept, at = [], hashlib.sha256(), 0
            if spans.is_valid and len(spans):
                a, b = (np.asarray(spans.values.field(k)) for k in ("a", "b"))
                by = np.argsort(a, kind="stable")
                a, reach = a[by], np.maximum.accumulate(b[by])
                new = np.r_[True, a[1:] > reach[:-1]]
                union = [{"a": int(x), "b": int(y)} for x, y in zip(a[new], reach[np.r_[new[1:], True]])]
            for s in union:
                kept.update(body[at : s["a"]].tobytes())
                at = s["b"]
            kept.update(body[at:].tobytes())
            out.append((doc_id, len(body), union, kept.hexdigest()))
        columns = list(zip(*out))
        kinds = [pa.int64(), pa.int64(), pa.list_(pa.struct([("a", pa.int64()), ("b", pa.int64())])), pa.string()]
        yield pa.RecordBatch.from_arrays([pa.array(list(c), t) for c, t in zip(columns, kinds)], names=["doc_id", "n_bytes", "removed", "kept_sha256"])


def spans(rows: DataFrame) -> DataFrame:
    """doc_id, print, a, b: removed spans of ``rows`` (doc_id, print, text); they may overlap."""
    anchors = stored(rows.mapInArrow(_anchors, ANCHORS), "anchors")
    # written, so that the join can split a hot core
    again = stored(anchors.groupBy("core").agg(F.count("*").alias("c")).where("c > 1").select("core"), "cores")
    shared = stored(anchors.join(again, "core"), "shared")
    contexts = shared.groupBy("core", "context").agg(F.count("*").alias("n"), F.min(F.struct("doc_id", "print", "place")).alias("one"))
    contexts = stored(contexts, "contexts")

    whole_ones = contexts.where("n > 1").select("core", "context")
    resolved = shared.join(whole_ones, ["core", "context"]).select("doc_id", "print", *_whole_span())

    mixed_cores = contexts.groupBy("core").agg(F.count("*").alias("kinds"), F.min("n").alias("rarest"))
    mixed_cores = stored(mixed_cores.where("kinds > 1 and rarest = 1").select("core", "kinds"), "cores")
    wanted = contexts.join(mixed_cores, "core").select("one.doc_id", "one.print", F.struct("one.place", "core", "context", "n", "kinds").alias("w"))
    todo = stored(wanted.groupBy("doc_id", "print").agg(F.collect_list("w").alias("todo")), "todo")
    holders, _ = parted(rows, F.col("print"), todo.select("print"))
    cut = stored(same_text(holders, todo, "inner").dropDuplicates(["doc_id", "print"]).mapInArrow(_cut, CUT), "contexts-cut")

    names = ["core", "n", "doc_id", "print", "place", "body"]
    few = cut.where(F.col("kinds") <= MOST_CONTEXTS).select(names)
    whole_range = (F.lit(0).alias("lo"), F.lit(WINDOW - 1).alias("hi"))
    hot = cut.where(F.col("kinds") > MOST_CONTEXTS).select("core", *whole_range, *names[1:])
    while not hot.isEmpty():
        units, equal = _halved(hot)
        sizes = units.groupBy("core").agg(F.count("*").alias("c"), F.min("n").alias("rarest")).where("c > 1 and rarest = 1").select("core", "c")
        units = units.join(stored(sizes, "cores"), "core")
        splits = (F.col("c") > MOST_CONTEXTS) & (F.col("lo") < F.col("hi"))
        few, resolved = few.unionByName(units.where(~splits).select(names)), resolved.unionByName(equal)
        hot = units.where(splits).select("core", "lo", "hi", *names[1:])
    tasks = buckets(few.count(), CONTEXTS_PER_TASK)
    by_sort = few.groupBy(F.pmod(F.xxhash64("core"), F.lit(tasks)).alias("task")).applyInPandas(_sorted, "doc_id bigint, print bigint, a bigint, b bigint")
    return resolved.unionByName(by_sort)


def without_repeats(docs: DataFrame, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """doc_id, n_bytes, removed (the maximal spans), kept_sha256 of every row of ``docs``."""
    rows = docs.select(F.col(doc_id).cast("bigint").alias("doc_id"), whole(F.col(text)).alias("text"))
    rows = rows.select("doc_id", F.xxhash64("text").alias("print"), "text")
    found = stored(spans(rows).groupBy("doc_id", "print").agg(F.collect_set(F.struct("a", "b")).alias("spans")), "removed")
    holders, others = parted(rows, F.col("print"), found.select("print"))
    nothing = F.lit(None).cast("array<struct<a:bigint,b:bigint>>").alias("spans")
    return same_text(holders, found, "left").unionByName(others.select("*", nothing)).mapInArrow(_strip, STRIPPED)
