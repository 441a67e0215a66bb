"""Quality scores: random-indexing word vectors, pooled per text, and a two-layer network.

A word's vector is the sum of the index vectors of the words around it, over the whole corpus; an
index vector is sparse and random, made from the word's hash. Words and word shapes (ending,
length, capitals) fall into ``BUCKETS`` rows by hash, so the table has a fixed size however many words there are:
tasks add it up as they read, Spark sums the parts by row, and it is
sent to all tasks (4 MB). A text is the mean of its words' vectors with a few plain counts. The
network is fitted on the driver on at most ``MAX_TRAIN`` labelled texts, the first by hash of the id, and its
logits are divided by a temperature that fits held-back labelled texts best.

Edge cases: a null or empty text has zero vectors and gets the score of those. A null id is never held out
and never learnt from. Repeated rows get equal scores. Labels of unknown ids, and null labels, are
not used; without labels of both kinds every score is their smoothed mean. No rows give no rows.
Other columns are not looked at.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .bytescan import Chunk, chunks, mixed, prefix_hashes, span_hashes
from .common import stored, whole

BUCKETS, SHAPES, DIMS = 1 << 15, 1 << 11, 32
REACH = 2
MAX_TRAIN = 20_000
HIDDEN = 32
PLAIN = 6

# blank, letter (also every byte of other alphabets), digit, anything else
_KIND = np.full(256, 3, np.uint8)
_KIND[[32, 9, 10, 11, 12, 13]] = 0
_KIND[65:91] = _KIND[97:123] = _KIND[128:] = 1
_KIND[48:58] = 2


@dataclass
class Tokens:
    """Runs of one kind of byte: text number, kind, bounds, bucket of the word and of its shape."""

    doc: np.ndarray
    kind: np.ndarray
    begin: np.ndarray
    end: np.ndarray
    word: np.ndarray
    shape: np.ndarray
    capitals: np.ndarray


def tokens(chunk: Chunk) -> Tokens:
    data, n = chunk.data, len(chunk.data)
    kind = _KIND[data]
    opens = np.ones(n + 1, bool)
    opens[1:n] = kind[1:] != kind[:-1]
    opens[chunk.starts] = True
    edges = np.flatnonzero(opens)
    begin, end = edges[:-1], edges[1:]
    seen = kind[begin] > 0 if n else np.zeros(0, bool)
    begin, end = begin[seen], end[seen]
    prefix = prefix_hashes(data)
    size = end - begin
    upper = np.r_[0, np.cumsum((data >= 65) & (data <= 90))]
    capitals = upper[end] - upper[begin]
    word = mixed(span_hashes(prefix, begin, end) + size.astype(np.uint64))
    tail = span_hashes(prefix, np.maximum(begin, end - 2), end)
    style = np.where(capitals == 0, 0, np.where(capitals == size, 2, 1)) * 16 + np.minimum(size, 15)
    shape = mixed(tail + mixed(style.astype(np.uint64) + np.uint64(1)))
    return Tokens(
        np.searchsorted(chunk.starts, begin, "right") - 1, kind[begin] if n else kind, begin, end,
        (word % np.uint64(BUCKETS - SHAPES)).astype(np.int64),
        (shape % np.uint64(SHAPES)).astype(np.int64) + BUCKETS - SHAPES, capitals,
    )


def index_vectors() -> tuple[np.ndarray, np.ndarray]:
    """Two places and signs of each bucket's index vector."""
    h = mixed(np.arange(1, BUCKETS + 1, dtype=np.uint64))
    places = np.stack([h % np.uint64(DIMS), (h >> np.uint64(20)) % np.uint64(DIMS)]).astype(np.int64)
    signs = np.stack([(h >> np.uint64(40)) & np.uint64(1), (h >> np.uint64(41)) & np.uint64(1)]).astype(np.int64) * 2 - 1
    return places, signs


def _indexer(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The part of the word vectors that this task's texts add."""
    table = np.zeros(BUCKETS * DIMS, np.int64)  # exact, so the sums don't depend on how texts are dealt
    places, signs = index_vectors()
    for chunk in chunks(batches):
        t = tokens(chunk)
        for step in range(1, REACH + 1):
            same = np.flatnonzero(t.doc[:-step] == t.doc[step:])
            for here, there in ((same, same + step), (same + step, same)):
                near = t.word[there]
                for k in (0, 1):
                    for own in (t.word, t.shape):
                        np.add.at(table, own[here] * DIMS + places[k][near], signs[k][near])
    rows = table.reshape(BUCKETS, DIMS)
    used = np.flatnonzero(np.abs(rows).sum(axis=1))
    columns = [pa.array(used, pa.int64()), *(pa.array(rows[used, d].astype(np.float64)) for d in range(DIMS))]
    yield pa.RecordBatch.from_arrays(columns, names=["bucket", *(f"v{d}" for d in range(DIMS))])


def word_vectors(rows: DataFrame) -> np.ndarray:
    """BUCKETS x DIMS: summed over all texts, each of length 1."""
    names = [f"v{d}" for d in range(DIMS)]
    parts = rows.select("text").mapInArrow(_indexer, "bucket bigint, " + ", ".join(f"{n} double" for n in names))
    sums = parts.groupBy("bucket").agg(*(F.sum(n).alias(n) for n in names)).toPandas()
    table = np.zeros((BUCKETS, DIMS), np.float32)
    table[sums["bucket"].to_numpy(np.int64)] = sums[names].to_numpy(np.float32)
    length = np.linalg.norm(table, axis=1, keepdims=True)
    return table / np.maximum(length, 1e-6)


def _pooler(shared):
    def pool(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        vectors = shared.value
        for chunk in chunks(batches):
            t, n = tokens(chunk), len(chunk)
            many = np.bincount(t.doc, minlength=n).astype(np.float32)
            out = np.zeros((n, DIMS + PLAIN), np.float32)
            full = np.flatnonzero(many)
            if len(full):
                first = np.searchsorted(t.doc, full)
                both = vectors[t.word] + vectors[t.shape]
                out[full, :DIMS] = np.add.reduceat(both, first, axis=0) / (2 * many[full, None])
                weight = lambda x: np.bincount(t.doc, x, n) / np.maximum(many, 1)
                pairs = np.unique(t.doc * BUCKETS + t.word)
                distinct = np.bincount(pairs // BUCKETS, minlength=n) / np.maximum(many, 1)
                size = t.end - t.begin
                letters = np.maximum(np.bincount(t.doc, np.where(t.kind == 1, size, 0), n), 1)
                plain = (np.log1p(many) / 10, weight(t.kind == 3), weight(t.kind == 2), np.bincount(t.doc, t.capitals, n) / letters, weight(size) / 10, distinct)
                out[:, DIMS:] = np.stack(plain, axis=1)
            flat = pa.ListArray.from_arrays(np.arange(n + 1, dtype=np.int32) * (DIMS + PLAIN), pa.array(out.ravel()))
            yield pa.RecordBatch.from_arrays([chunk.column("doc_id"), flat], names=["doc_id", "features"])

    return pool


@dataclass
class Network:
    """Standardised inputs, a tanh layer, a logit divided by a temperature."""

    mean: np.ndarray
    scale: np.ndarray
    w1: np.ndarray
    b1: np.ndarray
    w2: np.ndarray
    b2: float
    temperature: float = 1.0

    def logits(self, x: np.ndarray) -> np.ndarray:
        return np.tanh((x - self.mean) / self.scale @ self.w1 + self.b1) @ self.w2 + self.b2

    def scores(self, x: np.ndarray) -> np.ndarray:
        return 1 / (1 + np.exp(-np.clip(self.logits(x) / self.temperature, -500, 500)))


def constant(score: float, width: int = DIMS + PLAIN) -> Network:
    logit = float(np.log(score / (1 - score)))
    return Network(np.zeros(width), np.ones(width), np.zeros((width, 1)), np.zeros(1), np.zeros(1), logit)


def train(x: np.ndarray, y: np.ndarray, held: np.ndarray, epochs: int = 60, rate: float = 0.01, batch: int = 256, decay: float = 1e-4, seed: int = 5) -> Network:
    """Fit by Adam on the rows that aren't ``held`` back, then the temperature on those that are."""
    if len(y) < 10 or len(np.unique(y[~held])) < 2:
        return constant((y.sum() + 1) / (len(y) + 2), x.shape[1] if x.ndim == 2 and x.shape[1] else DIMS + PLAIN)
    rng = np.random.default_rng(seed)
    fit_x, fit_y = x[~held].astype(np.float64), y[~held]
    mean, scale = fit_x.mean(axis=0), fit_x.std(axis=0) + 1e-6
    z = (fit_x - mean) / scale
    p = [rng.normal(0, z.shape[1] ** -0.5, (z.shape[1], HIDDEN)), np.zeros(HIDDEN), rng.normal(0, HIDDEN**-0.5, HIDDEN), np.zeros(1)]
    m, v, step = [np.zeros_like(a) for a in p], [np.zeros_like(a) for a in p], 0
    for _ in range(epochs):
        order = rng.permutation(len(z))
        for i in range(0, len(order), batch):
            rows = order[i : i + batch]
            a = z[rows]
            h = np.tanh(a @ p[0] + p[1])
            d = (1 / (1 + np.exp(-np.clip(h @ p[2] + p[3], -500, 500))) - fit_y[rows]) / len(rows)
            back = np.outer(d, p[2]) * (1 - h * h)
            grads = [a.T @ back + decay * p[0], back.sum(axis=0), h.T @ d + decay * p[2], np.array([d.sum()])]
            step += 1
            for k, g in enumerate(grads):
                m[k] = 0.9 * m[k] + 0.1 * g
                v[k] = 0.999 * v[k] + 0.001 * g * g
                p[k] = p[k] - rate * (m[k] / (1 - 0.9**step)) / (np.sqrt(v[k] / (1 - 0.999**step)) + 1e-8)
    net = Network(mean, scale, p[0], p[1], p[2], float(p[3][0]))
    if held.any():
        logits, truth = net.logits(x[held]), y[held]
        loss = lambda t: np.mean(np.logaddexp(0, logits / t) - truth * logits / t)
        net.temperature = float(min(np.exp(np.linspace(-2, 3, 101)), key=loss))
    return net


def _scorer(shared):
    def score(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        net = Network(*shared.value)
        for batch in batches:
            x = batch.column("features").flatten().to_numpy().reshape(-1, DIMS + PLAIN)
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), pa.array(net.scores(x), pa.float64())], names=["doc_id", "score"])

    return score


def remainder(doc_id: Column, n: int = 3) -> Column:
    """crc32 of the id as text, modulo ``n``."""
    return F.pmod(F.crc32(doc_id.cast("string").cast("binary")), F.lit(n))


def quality_scores(docs: DataFrame, labels: DataFrame, doc_id: str = "doc_id", text: str = "text", label: str = "quality") -> DataFrame:
    """doc_id, held_out, score of every row of ``docs``; learnt from ``labels`` (doc_id, label) not held out."""
    spark = docs.sparkSession
    rows = docs.select(F.col(doc_id).cast("bigint").alias("doc_id"), whole(F.col(text)).alias("text"))
    vectors = spark.sparkContext.broadcast(word_vectors(rows))
    pooled = stored(rows.mapInArrow(_pooler(vectors), "doc_id bigint, features array<float>"), "pooled")
    known = labels.select(F.col(doc_id).cast("bigint").alias("doc_id"), F.col(label).cast("double").alias("label")).where(F.col("label").isNotNull() & (remainder(F.col("doc_id")) != 1))
    sample = pooled.join(known, "doc_id").orderBy(F.xxhash64("doc_id"), "doc_id").limit(MAX_TRAIN)
    sample = sample.withColumn("held", F.pmod(F.xxhash64("doc_id"), F.lit(5)) == 0).toPandas()
    x = np.array(sample["features"].tolist(), np.float32).reshape(len(sample), DIMS + PLAIN)
    net = train(x, sample["label"].to_numpy(float), sample["held"].to_numpy(bool))
    scored = pooled.mapInArrow(_scorer(spark.sparkContext.broadcast(tuple(vars(net).values()))), "doc_id bigint, score double")
    return scored.select("doc_id", F.coalesce(remainder(F.col("doc_id")) == 1, F.lit(False)).alias("held_out"), "score")
