"""Document fingerprints: a homomorphic multiset hash, the sum of wide vectors hashed from paragraphs.

A text's paragraphs are what line feeds part; an empty text has none. A paragraph becomes a vector of ``LANES``
numbers modulo 2^32, and a text's fingerprint is the sum of its paragraphs' vectors. So the order of paragraphs
doesn't matter, and a paragraph put in or taken out is added or subtracted without reading the rest.

- The first ``EXACT`` lanes are the paragraph's BLAKE2b hash. Equal multisets of paragraphs have equal sums;
  others differ but for a chance of about 2^-512. It is no defence against texts made to collide.
- The other lanes are a sketch: every run of ``RUN`` words of the paragraph (every word, if there are fewer than
  ``FEW``) adds 1 or -1 to a lane that its hash names. The squared length of a difference of two sketches estimates how many
  runs only one text has, so ``likeness`` is 1 - that / (squared lengths of both), from 0 to 1, with a standard
  error of about 1 / sqrt(SKETCH). Equal fingerprints have likeness 1. A lane is right up to 2^31 runs.

``with_next`` meets each text with the next one in the order of ids: the ids' quantiles part them into
ranges, a range's first row is also sent to the range before it, and each task walks through its sorted
ranges. Texts move once.

Edge cases: a null text is empty. Ids rise, null ids come last, equal ids go by text; after the last row comes the
first, so a single row is its own next. Repeated rows are each other's next. Texts of fewer than four
characters keep all of them. No rows give no rows. Other columns are not looked at. The rows of one id lie in one
range, so an id on very many rows makes a long task (not a large one: rows are walked through).
"""

from __future__ import annotations

import base64
import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .bytescan import grams, mixed, prefix_hashes, span_hashes, words
from .common import buckets, whole

EXACT, SKETCH = 16, 256
LANES = EXACT + SKETCH
RUN = 3
FEW = 2 * RUN
RANGE_BYTES = 32 << 20
MOST_RANGES = 20_000
STEP_BYTES = 1 << 20


def _paragraphs(data: np.ndarray, starts: np.ndarray, inner: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Begin, end and text number of every paragraph; an empty text has one only if ``inner`` says so."""
    breaks = np.flatnonzero(data == 10)
    filled = np.flatnonzero((np.diff(starts) > 0) | inner)
    doc = np.r_[filled, np.searchsorted(starts, breaks, "right") - 1]
    begin = np.r_[starts[filled], breaks + 1]
    order = np.lexsort((begin, doc))
    doc, begin = doc[order], begin[order]
    end = starts[doc + 1]
    same = np.flatnonzero(doc[1:] == doc[:-1])
    end[same] = begin[same + 1] - 1
    return begin, end, doc


def _runs(data: np.ndarray, starts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Hash and text number of every run of words that a sketch counts."""
    begin, end, doc = words(data, starts)
    hashes = mixed(span_hashes(prefix_hashes(data), begin, end) + (end - begin).astype(np.uint64))
    paragraph = np.cumsum(data == 10)[begin] + doc if len(data) else doc
    _, which, many = np.unique(paragraph, return_inverse=True, return_counts=True)
    few = many[which] < FEW
    found, first = grams(hashes, paragraph, RUN)
    long = ~few[first]
    held = [(found[long], doc[first[long]]), (hashes[few], doc[few])]
    return tuple(np.concatenate(c) for c in zip(*held))


def vectors(texts: list[str], inner: np.ndarray | None = None) -> np.ndarray:
    """The fingerprints of the texts, one a row. Where ``inner`` is set, an empty text is one empty paragraph."""
    bodies = [t.encode() for t in texts]
    starts = np.cumsum([0, *map(len, bodies)])
    joined = b"".join(bodies)
    data = np.frombuffer(joined, np.uint8)
    inner = np.zeros(len(texts), bool) if inner is None else inner
    out = np.zeros((len(texts), LANES), np.uint32)
    begin, end, doc = _paragraphs(data, starts, inner)
    if len(doc):
        digests = b"".join(hashlib.blake2b(joined[a:b]).digest() for a, b in zip(begin.tolist(), end.tolist()))
        new = np.flatnonzero(np.r_[True, doc[1:] != doc[:-1]])
        out[doc[new], :EXACT] = np.add.reduceat(np.frombuffer(digests, "<u4").reshape(-1, EXACT), new, axis=0, dtype=np.uint32)
    run, owner = _runs(data, starts)
    lane = (run % np.uint64(SKETCH)).astype(np.int64)
    sign = np.where((run >> np.uint64(32)) & np.uint64(1), 1.0, -1.0)
    counts = np.bincount(owner * SKETCH + lane, weights=sign, minlength=len(texts) * SKETCH)
    out[:, EXACT:] = counts.astype(np.int64).reshape(-1, SKETCH).astype(np.uint32)
    return out


def encoded(vector: np.ndarray) -> str:
    return base64.b64encode(vector.astype("<u4").tobytes()).decode()


def decoded(fingerprint: str) -> np.ndarray:
    return np.frombuffer(base64.b64decode(fingerprint), "<u4")


def likeness(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Of each row of ``a`` with the same row of ``b``: 1 for equal ones, about 0 for texts without a common run of words."""
    square = [(x[:, EXACT:].view(np.int32).astype(float) ** 2).sum(axis=1) for x in (a, b, a - b)]
    both = square[0] + square[1]
    like = np.clip(1 - square[2] / np.maximum(both, 1), 0, 1)
    return np.where((a == b).all(axis=1), 1.0, np.where(both > 0, like, 0.0))


def _rank(bounds: list[int], value: Column) -> Column:
    """How many of the rising ``bounds`` are below the value, by binary search; all of them for null."""
    if not bounds:
        return F.lit(0)
    steps = [1 << i for i in reversed(range(len(bounds).bit_length()))]
    held = F.lit(bounds)
    found = F.aggregate(F.lit(steps), F.lit(0), lambda at, step: F.when(F.get(held, at + step - 1) < value, at + step).otherwise(at))
    return F.when(value.isNull(), F.lit(len(bounds))).otherwise(found)


def in_ranges(rows: DataFrame) -> DataFrame:
    """``rows`` (doc_id, print, text) with ``part`` and ``guest``, dealt by part and sorted; each part ends with
    the row that follows its last one, as a guest."""
    size = rows.agg(F.sum(F.octet_length("text"))).head()[0] or 0
    parts = min(MOST_RANGES, buckets(size, RANGE_BYTES))
    cuts = [i / parts for i in range(1, parts)]
    bounds = rows.agg(F.percentile_approx("doc_id", cuts, F.lit(100 * parts)).alias("b")).head()[0] if cuts else []
    bounds = sorted(set(bounds or []))
    rows = rows.select("doc_id", "print", "text", _rank(bounds, F.col("doc_id")).alias("part"))
    key = F.struct(F.col("doc_id").isNull().alias("none"), F.col("doc_id"), F.col("print"))
    firsts = {r.part: r.least for r in rows.groupBy("part").agg(F.min(key).alias("least")).collect()}  # a row for each range
    filled = sorted(firsts)
    before = {p: filled[i - 1] for i, p in enumerate(filled)}
    of = [(firsts[p].doc_id, firsts[p]["print"], before[p]) if p in firsts else (None, None, None) for p in range(len(bounds) + 1)]
    ids, prints, to = (F.lit(list(c)).cast(t) for c, t in zip(zip(*of), ("array<bigint>", "array<bigint>", "array<int>")))
    leads = F.col("doc_id").eqNullSafe(F.get(ids, F.col("part"))) & (F.col("print") == F.get(prints, F.col("part")))
    own = F.array(F.struct("part", F.lit(False).alias("guest")))
    copy = F.array(F.struct(F.get(to, F.col("part")).alias("part"), F.lit(True).alias("guest")))
    dealt = rows.select("doc_id", "print", "text", F.inline(F.when(leads, F.concat(own, copy)).otherwise(own)))
    order = ["part", "guest", F.col("doc_id").asc_nulls_last(), "print", "text"]
    return dealt.repartitionById(len(bounds) + 1, "part").sortWithinPartitions(*order)  # a task for each range


PAIRED = "doc_id bigint, n_chars bigint, edited_sha256 string, fingerprint string, edited_fingerprint string, near_edited double, near_next double"


def _edited(text: str, following: str) -> tuple[str, str, str, bool]:
    """The text with its last quarter replaced, the changed paragraphs before and after, and whether others precede them."""
    kept = len(text) - len(text) // 4
    new = following[: len(text) // 4]
    tail = text.rfind("\n", 0, kept) + 1
    return text[:kept] + new, text[tail:], text[tail:kept] + new, tail > 0


def _compare(rows: pa.Table) -> pa.RecordBatch:
    """Each row but the last with the row after it, in the same part."""
    texts = rows.column("text").to_pylist()
    part, guest = rows.column("part").to_numpy(), rows.column("guest").to_numpy()
    own = np.flatnonzero((part[:-1] == part[1:]) & ~guest[:-1])
    every = vectors(texts)
    edits = [_edited(texts[i], texts[i + 1]) for i in own.tolist()]
    whole_texts, old, new, inner = ([e[k] for e in edits] for k in range(4))
    inner = np.array(inner, bool)
    before = every[own]
    after = before - vectors(old, inner) + vectors(new, inner)
    return pa.RecordBatch.from_arrays(
        [
            rows.column("doc_id").combine_chunks().take(pa.array(own)), pa.array([len(texts[i]) for i in own.tolist()], pa.int64()),
            pa.array([hashlib.sha256(t.encode()).hexdigest() for t in whole_texts], pa.string()),
            pa.array(map(encoded, before), pa.string()), pa.array(map(encoded, after), pa.string()),
            pa.array(likeness(before, after), pa.float64()), pa.array(likeness(before, every[own + 1]), pa.float64()),
        ],
        names=["doc_id", "n_chars", "edited_sha256", "fingerprint", "edited_fingerprint", "near_edited", "near_next"],
    )


def _walk(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Sorted rows, some at a time; the last of a batch waits for the next batch."""
    held: list[pa.RecordBatch] = []
    for batch in batches:
        if not len(batch):
            continue
        rows = pa.Table.from_batches([*held, batch])
        ends = np.cumsum(pc.binary_length(rows.column("text")).to_numpy())
        i = 0
        while i + 1 < len(rows):
            j = max(i + 1, int(np.searchsorted(ends, ends[i] + STEP_BYTES, "right")) - 1)
            yield _compare(rows.slice(i, j - i + 1))
            i = j
        held = [batch.slice(len(batch) - 1, 1)]


def with_next(docs: DataFrame, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """The fingerprint of each text, of the text with its last quarter replaced by the next text's beginning, and how alike they are."""
    rows = docs.select(F.col(doc_id).cast("bigint").alias("doc_id"), whole(F.col(text)).alias("text"))
    rows = rows.select("doc_id", F.xxhash64("text").alias("print"), "text")
    return in_ranges(rows).mapInArrow(_walk, PAIRED)


def _totals(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        key = batch.column("key").dictionary_encode()
        code = key.indices.fill_null(len(key.dictionary)).to_numpy()
        out = np.zeros((len(key.dictionary) + 1, LANES), np.uint32)
        np.add.at(out, code, vectors(batch.column("text").to_pylist()))
        used = np.unique(code)
        keys = pa.array([*key.dictionary.to_pylist(), None], pa.string()).take(pa.array(used))
        lanes = pa.array(out[used].astype(np.int64).tolist(), pa.list_(pa.int64()))
        yield pa.RecordBatch.from_arrays([keys, lanes], names=["key", "lanes"])


def totals(docs: DataFrame, by: str, text: str = "text") -> DataFrame:
    """key, lanes: the fingerprint of all paragraphs of each value of ``by``, as numbers; sums of it take in or leave out documents."""
    rows = docs.select(F.col(by).cast("string").alias("key"), whole(F.col(text)).alias("text"))
    lanes = rows.mapInArrow(_totals, "key string, lanes array<bigint>").select("key", F.posexplode("lanes").alias("lane", "n"))
    lanes = lanes.groupBy("key", "lane").agg(F.pmod(F.sum("n"), F.lit(1 << 32)).alias("n"))
    ordered = F.transform(F.array_sort(F.collect_list(F.struct("lane", "n"))), lambda s: s["n"])
    return lanes.groupBy("key").agg(ordered.alias("lanes"))
