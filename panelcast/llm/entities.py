"""Personal data: base patterns, and a skip-chain conditional random field that makes labels consistent.

The base patterns find emails, network addresses, card and phone numbers. They also label the
corpus for the field: over all texts it is counted how often words of each look bear each label,
which labels follow each other, and which labels successive mentions of the same number or address
have. The logarithms of these counts are the potentials of the field. In it, each word that holds a
digit, ``@`` or ``+`` is linked with its neighbour in the text, and with the next mention of the same
thing anywhere in the same text: equal but for case and punctuation, or numbers with the same last
seven digits. Words found by a pattern are observed; each other mention is also linked with the first
observed mention of its thing in the text, so that the pattern reaches every repeat at once. Loopy message passing, until the
messages stop changing, gives the others their posteriors. Words that no pattern finds count as other text only if no equal mention is found: such
mentions are what the field is asked about. A prior says that equal mentions have equal labels. A mention is added if a label has at least ``SURE`` and an equal mention bears it too.

A mention has at most two links to others before it, so their number grows with the text, not its square.
All messages of a batch of texts are passed at once; those of texts that are done wait for the others.

Edge cases: a null or empty text has no spans. Repeated rows are annotated each. Added spans never
overlap base spans. Without any base span in the corpus nothing is added. No rows give no
rows. Other columns are kept.
"""

from __future__ import annotations

import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .bytescan import Chunk, chunks, words
from .common import quoted, unused

KINDS = ("email", "ip", "card", "phone")
LABELS = len(KINDS) + 1
LOOKS = 7 * 32 * 2
#: A message is done when a round changes it by less than ``STILL``. If messages go round in circles, the
#: step is halved every ``ROUNDS`` rounds, and rounds for the longest chain of mentions, until they settle.
STILL, ROUNDS = 1e-4, 64
#: Weight of the prior that equal mentions agree, and the least probability of a label given a look.
AGREE, FLOOR = 1e4, 1e-3
SURE = 0.9
LAST_DIGITS = 7

_LOCAL = frozenset("abcdefghijklmnopqrstuvwxyzABCDEFGHIJKLMNOPQRSTUVWXYZ0123456789._%+-")
_DOMAIN = re.compile(r"[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)+")
# a match ends with a whole run of digits, so the next one begins with one
_ADDRESS = re.compile(r"(?<![0-9])[0-9]+(?:\.[0-9]+){3}")
_CARD = re.compile(r"[0-9](?:[\x20-]?[0-9])+")
_PHONE = re.compile(r"\+[0-9][\x20().0-9-]+[0-9]")
_NOT_DIGIT = re.compile(r"[^0-9]+")


def _emails(text: str) -> list[tuple[int, int]]:
    out, free, at = [], 0, text.find("@")
    while at >= 0:
        start = at
        while start > free and text[start - 1] in _LOCAL:
            start -= 1
        rest = _DOMAIN.match(text, at + 1) if start < at else None
        if rest:
            out.append((start, rest.end()))
            free = rest.end()
        at = text.find("@", max(at + 1, free))
    return out


def _luhn(digits: str) -> bool:
    total = 0
    for i, c in enumerate(reversed(digits)):
        d = int(c) * (1 + i % 2)
        total += d - 9 * (d > 9)
    return total % 10 == 0


def _small(part: str) -> bool:
    part = part.lstrip("0")
    return len(part) <= 3 and int(part or "0") <= 255


def base_spans(text: str) -> list[tuple[int, int, int]]:
    """(kind, start, end) of the base patterns, by kind, then start."""
    out = [(0, a, b) for a, b in _emails(text)]
    out += [(1, *m.span()) for m in _ADDRESS.finditer(text) if all(map(_small, m.group().split(".")))]
    for m in _CARD.finditer(text):
        digits = _NOT_DIGIT.sub("", m.group())
        if 13 <= len(digits) <= 19 and _luhn(digits):
            out.append((2, *m.span()))
    out += [(3, *m.span()) for m in _PHONE.finditer(text) if 9 <= len(_NOT_DIGIT.sub("", m.group())) <= 15]
    return out


class Graph:
    """The words of a chunk that may be personal data, their links and their base labels."""

    def __init__(self, chunk: Chunk):
        data = chunk.data
        begin, end, doc = words(data, chunk.starts)
        running = lambda mask: np.r_[0, np.cumsum(mask)]
        count = lambda mask: (r := running(mask))[end] - r[begin]
        digits, ats, pluses = count((data >= 48) & (data <= 57)), count(data == 64), count(data == 43)
        seen = np.flatnonzero(digits + ats + pluses > 0)
        self.doc = doc[seen]
        self.begin, self.end = begin[seen], end[seen]
        marks = np.stack([ats, count(data == 46), count(data == 45), pluses, count(data == 40)])[:, seen] > 0
        size = np.searchsorted([1, 3, 7, 9, 13, 20], digits[seen], "right")
        letters = count(((data | 32) >= 97) & ((data | 32) <= 122))[seen] > 0
        self.look = (size * 32 + (marks * (1 << np.arange(5))[:, None]).sum(axis=0)) * 2 + letters
        # code points before each byte
        self.points = running((data & 0xC0) != 0x80)
        self.label = np.zeros(len(seen), np.int64)
        self.spans: dict[int, list[tuple[int, int, int]]] = {}
        names: dict[tuple[int, str], int] = {}
        firsts: dict[tuple[int, str], int] = {}
        back = np.full(len(seen), -1, np.int64)
        self.first = np.arange(len(seen))
        for i in np.unique(self.doc).tolist():
            a, b = np.searchsorted(self.doc, [i, i + 1])
            first = self.points[chunk.starts[i]]
            text = data[chunk.starts[i] : chunk.starts[i + 1]].tobytes().decode()
            found = base_spans(text)
            self.spans[i] = found
            low, high = self.points[self.begin[a:b]] - first, self.points[self.end[a:b]] - first
            for kind, x, y in reversed(found):
                # the words that a span touches
                self.label[a + np.searchsorted(high, x, "right") : a + np.searchsorted(low, y)] = kind + 1
            for k, x, y in zip(range(a, b), low.tolist(), high.tolist()):
                if name := _name(text[x:y]):
                    back[k] = names.get((i, name), -1)
                    self.first[k] = firsts.setdefault((i, name), k)
                    names[i, name] = k
        self.beside = np.flatnonzero((np.diff(seen) == 1) & (np.diff(self.doc) == 0))
        self.later = np.flatnonzero(back >= 0)
        self.earlier = back[self.later]
        found = np.flatnonzero(self.label > 0)
        shown = np.full(len(seen), -1, np.int64)
        shown[self.first[found[::-1]]] = found[::-1]
        # the first observed mention of the same thing, where no other link leads there
        source = shown[self.first]
        ahead = np.full(len(seen), -1, np.int64)
        ahead[self.earlier] = self.later
        self.told = np.flatnonzero((self.label == 0) & (source >= 0) & (source != back) & (source != ahead))
        self.teller = source[self.told]
        self.rounds = ROUNDS + 2 * int(np.bincount(self.first, minlength=1).max())

    def counts(self) -> np.ndarray:
        """Words by look and label, neighbours' labels, mentions' labels, one after the other."""
        found = np.zeros(len(self.label), np.int64)
        np.maximum.at(found, self.first, self.label)
        sure = (self.label > 0) | (found[self.first] == 0)
        pair = lambda a, b: self.label[a[sure[a] & sure[b]]] * LABELS + self.label[b[sure[a] & sure[b]]]
        look = np.bincount((self.look * LABELS + self.label)[sure], minlength=LOOKS * LABELS)
        steps = np.bincount(pair(self.beside, self.beside + 1), minlength=LABELS**2)
        skips = np.bincount(pair(self.earlier, self.later), minlength=LABELS**2)
        return np.r_[look, steps, skips]


def _name(word: str) -> str | None:
    """What equal mentions share; None for words too short to tell."""
    digits = _NOT_DIGIT.sub("", word)
    if "@" in word:
        return word.strip(".,;:!?()[]<>\"'").lower()
    return digits[-LAST_DIGITS:] if len(digits) >= LAST_DIGITS else None


def _counter(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    total = np.zeros(LOOKS * LABELS + 2 * LABELS**2, np.int64)
    for chunk in chunks(batches):
        total += Graph(chunk).counts()
    used = np.flatnonzero(total)
    yield pa.RecordBatch.from_arrays([pa.array(used, pa.int64()), pa.array(total[used])], names=["cell", "n"])


def potentials(docs: DataFrame, text: str = "text") -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Log potentials of looks, neighbours and mentions, from counts over all texts."""
    parts = docs.select(quoted(text).alias("text")).mapInArrow(_counter, "cell bigint, n bigint")
    cells = parts.groupBy("cell").agg(F.sum("n").alias("n")).toPandas()  # at most one row per cell
    total = np.zeros(LOOKS * LABELS + 2 * LABELS**2)
    total[cells["cell"].to_numpy(np.int64)] = cells["n"].to_numpy(float)
    look = total[: LOOKS * LABELS].reshape(LOOKS, LABELS) + 0.5
    pairs = total[LOOKS * LABELS :].reshape(2, LABELS, LABELS) + 0.5
    pairs[1] += AGREE * np.eye(LABELS)
    joint = pairs / pairs.sum(axis=(1, 2), keepdims=True)
    ratio = np.log(joint) - np.log(joint.sum(axis=2, keepdims=True)) - np.log(joint.sum(axis=1, keepdims=True))
    return np.log(np.maximum(look / look.sum(axis=1, keepdims=True), FLOOR)), ratio[0], ratio[1]


def beliefs(graph: Graph, field: tuple[np.ndarray, np.ndarray, np.ndarray]) -> np.ndarray:
    """Posterior of each label of each word, by loopy message passing; base labels are observed."""
    look, step, skip = field
    n = len(graph.label)
    node = look[graph.look].copy()
    known = graph.label > 0
    node[known] = -np.inf  # however many repeats speak against it
    node[known, graph.label[known]] = 0.0
    one, other = np.r_[graph.beside, graph.earlier, graph.teller], np.r_[graph.beside + 1, graph.later, graph.told]
    source, target = np.r_[one, other], np.r_[other, one]
    half = len(one)
    chain = np.arange(half) < len(graph.beside)
    forward = np.where(chain[:, None, None], step, skip)
    weight = np.concatenate([forward, forward.transpose(0, 2, 1)])
    message = np.zeros((2 * half, LABELS))
    reverse = np.r_[np.arange(half, 2 * half), np.arange(half)]
    live, rounds, share = np.arange(2 * half), 0, 0.5
    text = graph.doc[source]
    while len(live):
        # links of a text are live together, so a live node has all its messages here
        total = node.copy()
        np.add.at(total, target[live], message[live])
        out = (total[source[live]] - message[reverse[live]])[:, :, None] + weight[live]
        top = out.max(axis=1, keepdims=True)
        new = (top + np.log(np.exp(out - top).sum(axis=1, keepdims=True)))[:, 0, :]
        change = share * (new - new.max(axis=1, keepdims=True) - message[live])
        message[live] += change
        moving = np.unique(text[live][np.abs(change).max(axis=1) >= STILL])
        live = live[np.isin(text[live], moving)]
        rounds += 1
        if rounds % graph.rounds == 0:
            share /= 2
    total = node.copy()
    np.add.at(total, target, message)
    p = np.exp(total - total.max(axis=1, keepdims=True)) if n else total
    return p / p.sum(axis=1, keepdims=True) if n else p


def added_spans(graph: Graph, chunk: Chunk, field) -> dict[int, list[tuple[int, int, int]]]:
    """(kind, start, end) of mentions that only the field finds, by text number."""
    p = beliefs(graph, field)
    label = p.argmax(axis=1) if len(p) else np.zeros(0, np.int64)
    agreed = np.zeros(len(label), bool)
    for one, other in ((graph.earlier, graph.later), (graph.teller, graph.told)):
        equal = label[one] == label[other]
        agreed[one[equal]] = agreed[other[equal]] = True
    new = np.flatnonzero((graph.label == 0) & (label > 0) & agreed & (p.max(axis=1, initial=0) >= SURE))
    out: dict[int, list[tuple[int, int, int]]] = {}
    for k in new.tolist():
        i = int(graph.doc[k])
        first = graph.points[chunk.starts[i]]
        a, b = int(graph.points[graph.begin[k]] - first), int(graph.points[graph.end[k]] - first)
        if not any(x < b and a < y for _, x, y in graph.spans[i]):
            out.setdefault(i, []).append((int(label[k]) - 1, a, b))
    return out


SPAN = "array<struct<kind:string,start:int,end:int,base:boolean>>"
_ARROW_SPAN = pa.list_(pa.struct([("kind", pa.string()), ("start", pa.int32()), ("end", pa.int32()), ("base", pa.bool_())]))


def _annotator(text: str, into: str, field):
    def annotate(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for chunk in chunks(batches, text):
            graph = Graph(chunk)
            more = added_spans(graph, chunk, field)
            rows = []
            for i in range(len(chunk)):
                every = [(k, a, b, True) for k, a, b in graph.spans.get(i, ())] + [(k, a, b, False) for k, a, b in more.get(i, ())]
                rows.append([{"kind": KINDS[k], "start": a, "end": b, "base": base} for k, a, b, base in sorted(every)])
            part = chunk.batch.slice(chunk.first, len(chunk))
            yield pa.RecordBatch.from_arrays([*part.columns, pa.array(rows, _ARROW_SPAN)], names=[*part.schema.names, into])

    return annotate


def annotated(docs: DataFrame, into: str, text: str = "text") -> DataFrame:
    """The rows of ``docs`` and ``into``: an array of (kind, start, end, base), by kind, then start."""
    field = potentials(docs, text)
    # numbers for names on the way, as names may hold dots
    plain = docs.toDF(*(f"_{i}" for i in range(len(docs.columns))))
    schema = T.StructType([*plain.schema.fields, T.StructField("_spans", T._parse_datatype_string(SPAN))])
    found = plain.mapInArrow(_annotator(f"_{docs.columns.index(text)}", "_spans", field), schema)
    return found.toDF(*docs.columns, into)


def redacted(docs: DataFrame, text: str = "text") -> DataFrame:
    """The rows of ``docs`` with personal data in ``text`` replaced by its kind, as in ``<EMAIL>``."""
    spans = unused(docs, "spans")
    found = annotated(docs, spans, text)
    body = quoted(text)
    ordered = F.sort_array(F.transform(spans, lambda s: F.struct(s["start"].alias("start"), s["end"].alias("end"), s["kind"].alias("kind"))))
    walked = F.aggregate(
        ordered,
        F.struct(F.lit(0).alias("at"), F.lit("").alias("out")),
        lambda a, s: F.when(
            s["start"] >= a["at"],
            F.struct(
                s["end"].alias("at"),
                F.concat(a["out"], F.substring(body, a["at"] + 1, s["start"] - a["at"]), F.lit("<"), F.upper(s["kind"]), F.lit(">")).alias("out"),
            ),
        ).otherwise(F.struct(F.greatest(a["at"], s["end"]).alias("at"), a["out"].alias("out"))),
        lambda a: F.concat(a["out"], F.substring(body, a["at"] + 1, F.length(body))),
    )
    return found.withColumn(text, F.when(F.size(spans) > 0, walked).otherwise(body)).drop(spans)
