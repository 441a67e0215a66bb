"""Cross-tokenizer alignment: fragments of byte ranges, an associative product, and corpus-wide links.

A blank and the text are encoded by a byte-level BPE (A) and by a piece model (B). Offsets where tokens of both
end cut a document into groups; tokens whose bytes overlap are linked, and a pair of ids counts as
often as the corpus links it.

- ``Fragment``: what is known of the tokens that end in a byte range: the tokens up to the first common end
  (the open prefix), the closed groups after it, and the tokens after the last common end (the open suffix). Without a
  common end all of them are prefix. ``then`` joins neighbours: the left suffix and the right
  prefix become a group. It is associative, so fragments of a document may be joined in any tree.
- Texts over ``PIECE`` bytes are cut into pieces, which are dealt over the tasks and encoded apart; their fragments
  are joined ``FAN`` at a time, in as many rounds as the longest text needs, the last of which makes the digest. Cuts lie before a blank
  between two characters that are none. There neither tokenizer can have a token across (A parts words before it
  merges, and no piece of B has a blank after another character), which is checked when they are loaded;
  others encode whole texts.
- For the same reason a task encodes each stretch between such blanks once and looks it up afterwards.
- Each text's digest and its distinct pairs with their numbers of links are written. From these the corpus' counts
  are summed, in each task first. The most frequent pairs, ``KNOWN`` of them at
  most, are sent to the tasks; links of other pairs are joined with their counts. Both happen at any size.

Scale: texts are encoded once; those over ``PIECE`` bytes move twice. A task holds some megabytes of text and ``STRETCHES``
stretches. What is sent to all tasks is bounded by ``KNOWN`` and by the vocabularies.

Edge cases: null and empty texts, and texts that a tokenizer doesn't spell byte for byte, have no tokens: zeros and an
empty hash, and they add to no count. Repeated rows count each. Ties for a B id's highest count are all best. No rows
give no rows. Other columns are not looked at.
"""

from __future__ import annotations

import hashlib
import json
import os
from collections.abc import Iterator, Sequence
from dataclasses import dataclass
from itertools import chain

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .bytescan import Chunk, chunks
from .common import stored, whole

PIECE = 1 << 15
FAN = 16
KNOWN = 1 << 20
STRETCHES = 300_000
#: Links a task holds before it hands its counts on.
HELD = 4_000_000
#: Bytes of stretches that are encoded as one text, about.
ONE_TEXT = 1 << 14

BLANK = "▁"


@dataclass
class Ragged:
    """Lists of numbers in a row: list ``i`` is ``flat[at[i]:at[i + 1]]``."""

    flat: np.ndarray
    at: np.ndarray

    @classmethod
    def of(cls, lists: list) -> Ragged:
        at = np.cumsum([0, *map(len, lists)])
        return cls(np.fromiter(chain.from_iterable(lists), np.int64, at[-1]), at)

    def __len__(self) -> int:
        return len(self.at) - 1

    def take(self, which: np.ndarray) -> Ragged:
        size = self.at[which + 1] - self.at[which]
        at = np.r_[0, np.cumsum(size)]
        return Ragged(self.flat[np.arange(at[-1]) + np.repeat(self.at[which] - at[:-1], size)], at)

    def owner(self) -> np.ndarray:
        return np.repeat(np.arange(len(self)), np.diff(self.at))


class Growing:
    """An array that grows at its end, in place as long as there is room."""

    def __init__(self, kind: type = np.int64, first: Sequence[int] = ()):
        self.room, self.size = np.zeros(1024, kind), 0
        self.add(np.asarray(first, kind))

    def add(self, values: np.ndarray) -> None:
        if self.size + len(values) > len(self.room):
            more = np.zeros(max(2 * len(self.room), self.size + len(values)), self.room.dtype)
            more[: self.size] = self.room[: self.size]
            self.room = more
        self.room[self.size : self.size + len(values)] = values
        self.size += len(values)

    @property
    def now(self) -> np.ndarray:
        return self.room[: self.size]


class GrowingRagged:
    def __init__(self, kind: type = np.int64):
        self.flat, self.at = Growing(kind), Growing(np.int64, [0])

    def add(self, more: Ragged) -> None:
        self.at.add(more.at[1:] + self.flat.size)
        self.flat.add(more.flat)

    @property
    def now(self) -> Ragged:
        return Ragged(self.flat.now, self.at.now)


def sums(values: np.ndarray, at: np.ndarray) -> np.ndarray:
    """Of each list of a ragged array with these offsets."""
    total = np.r_[0, np.cumsum(values)]
    return total[at[1:]] - total[at[:-1]]


def _byte_alphabet() -> dict[str, int]:
    """Which byte a character of a byte-level vocabulary stands for: visible Latin-1 for itself, the other bytes in order from 256 on."""
    visible = [b for b in range(256) if 33 <= b <= 126 or 161 <= b <= 172 or b >= 174]
    hidden = [b for b in range(256) if b not in visible]
    return {chr(b): b for b in visible} | {chr(256 + i): b for i, b in enumerate(hidden)}


@dataclass
class Spelling:
    """The bytes of both vocabularies' tokens, and whether texts may be cut at blanks."""

    spell_a: Ragged
    spell_b: Ragged
    cuts: bool

    @classmethod
    def sent(cls, content: tuple) -> Spelling:
        (a, b), cuts = content[2][:2], content[2][2]
        return cls(Ragged(*a), Ragged(*b), cuts)

    @property
    def n_b(self) -> int:
        return len(self.spell_b)

    @property
    def n_codes(self) -> int:
        return len(self.spell_a) * len(self.spell_b)


class Tokenizers(Spelling):
    """Both tokenizers and the bytes of their tokens."""

    def __init__(self, a_json: str, b_model: bytes, known: tuple | None = None):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"  # Spark's tasks share the cores
        import sentencepiece
        from tokenizers import Tokenizer

        self.content = a_json, b_model
        self.a = Tokenizer.from_str(a_json)
        self.a.encode_special_tokens = True
        self.b = sentencepiece.SentencePieceProcessor(model_proto=b_model)
        if known is None:
            self._read()
        else:
            self.spell_a, self.spell_b, self.cuts = Ragged(*known[0]), Ragged(*known[1]), known[2]

    def _read(self) -> None:
        alphabet = _byte_alphabet()
        names = {i: t for t, i in self.a.get_vocab().items()}
        a = [bytes(alphabet.get(c, 63) for c in names.get(i, "")) for i in range(max(names) + 1)]
        pieces = [self.b.id_to_piece(i) for i in range(self.b.get_piece_size())]
        b = [bytes([int(p[3:5], 16)]) if self.b.is_byte(i) else p.replace(BLANK, " ").encode() for i, p in enumerate(pieces)]
        self.spell_a, self.spell_b = Ragged.of(a), Ragged.of(b)
        parts = json.loads(self.content[0])
        words = parts.get("pre_tokenizer") or {}
        plain = parts.get("normalizer") is None and words.get("type") == "ByteLevel" and words.get("use_regex") and not words.get("add_prefix_space")
        self.cuts = bool(plain) and not any(BLANK in p.lstrip(BLANK) for p in pieces)

    def sent(self) -> tuple:
        """What a task needs to have the same, as plain values."""
        return *self.content, ((self.spell_a.flat, self.spell_a.at), (self.spell_b.flat, self.spell_b.at), self.cuts)

    def encode(self, bodies: list[bytes]) -> tuple[np.ndarray, Ragged, Ragged]:
        """Whether each body (that begins with a blank) is spelled byte for byte, and its tokens, none if it isn't."""
        texts = [b.decode() for b in bodies]
        a = Ragged.of([e.ids for e in self.a.encode_batch(texts, add_special_tokens=False)])
        b = Ragged.of(self.b.encode([t[1:] for t in texts], num_threads=1) if texts else [])
        ok = self._spelled(a, self.spell_a, bodies) & self._spelled(b, self.spell_b, bodies)
        for tokens in (a, b):
            tokens.flat = tokens.flat[np.repeat(ok, np.diff(tokens.at))]
            tokens.at = np.r_[0, np.cumsum(np.where(ok, np.diff(tokens.at), 0))]
        return ok, a, b

    def encode_stretches(self, bodies: list[bytes]) -> tuple[np.ndarray, Ragged, Ragged]:
        """The same of many short stretches: those that may stand beside each other are encoded as one text, and
        parted where they meet. If such a text isn't spelled, its stretches are encoded one by one."""
        if not self.cuts:
            return self.encode(bodies)
        data, at = np.frombuffer(b"".join(bodies), np.uint8), np.cumsum([0, *map(len, bodies)])
        meets = np.isin(at[:-1], safe_cuts(data, at[[0, -1]]))
        begins = np.flatnonzero(~meets | (np.diff(at // ONE_TEXT, prepend=-1) > 0)[:-1])
        runs = np.r_[begins, len(bodies)].tolist()
        texts = [data[at[i] : at[j]].tobytes() for i, j in zip(runs, runs[1:])]
        ok, a, b = self.encode(texts)
        out = []
        for tokens, spell in ((a, self.spell_a), (b, self.spell_b)):
            # where the stretches of the spelled texts end, in tokens
            ends = np.cumsum(np.diff(spell.at)[tokens.flat])
            size = np.diff(at) * np.repeat(ok, np.diff(runs))
            out.append(Ragged(tokens.flat, np.r_[0, np.searchsorted(ends, np.cumsum(size), "right")]))
        every = np.repeat(ok, np.diff(runs))
        if ok.all():
            return every, *out
        again = np.flatnonzero(~every)
        ok_again, *more = self.encode([bodies[i] for i in again.tolist()])
        every[again] = ok_again
        order = np.arange(len(bodies))
        order[again] = len(bodies) + np.arange(len(again))
        return every, *(Ragged(np.concatenate([x.flat, y.flat]), np.r_[x.at, y.at[1:] + x.at[-1]]).take(order) for x, y in zip(out, more))

    @staticmethod
    def _spelled(tokens: Ragged, spell: Ragged, bodies: list[bytes]) -> np.ndarray:
        said = spell.take(tokens.flat)
        size = said.at[tokens.at[1:]] - said.at[tokens.at[:-1]]
        ok = (size == np.array([len(b) for b in bodies], np.int64)) & (size > 0)
        mine = said.flat[np.repeat(ok, size)]
        real = np.frombuffer(b"".join(b for b, k in zip(bodies, ok.tolist()) if k), np.uint8)
        wrong = np.searchsorted(np.cumsum(size[ok]), np.flatnonzero(mine != real), "right")
        ok[np.flatnonzero(ok)[wrong]] = False
        return ok


@dataclass
class Aligned:
    """Links and groups of encoded bodies, in a row: id pairs (A's times the size of B's vocabulary plus B's), tokens of A and B in each group, and how many each body has."""

    pairs: Ragged
    group_a: Ragged
    group_b: Ragged


def _shared(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Members of both rising arrays."""
    if not len(b):
        return b
    return a[b[np.minimum(np.searchsorted(b, a), len(b) - 1)] == a]


def align(a: Ragged, b: Ragged, tokenizers: Spelling) -> Aligned:
    end_a, end_b = (np.cumsum(np.diff(s.at)[t.flat]) for t, s in ((a, tokenizers.spell_a), (b, tokenizers.spell_b)))
    stop = np.r_[0, end_a][a.at]  # the bodies' ends; both spell the same bytes
    ends = np.sort(np.concatenate([end_a, end_b]), kind="stable")
    ends = ends[np.r_[True, ends[1:] != ends[:-1]]] if len(ends) else ends
    # between two neighbouring ends lie bytes of one token of each
    pairs = a.flat[np.searchsorted(end_a, ends)].astype(np.int64) * tokenizers.n_b + b.flat[np.searchsorted(end_b, ends)]
    common = _shared(end_a, end_b)
    sizes = [np.diff(np.searchsorted(e, common, "right"), prepend=0) for e in (end_a, end_b)]
    groups = np.searchsorted(common, stop, "right")
    return Aligned(Ragged(pairs, np.searchsorted(ends, stop, "right")), *(Ragged(s, groups) for s in sizes))


def render(a: np.ndarray, b: np.ndarray, size_a: np.ndarray, size_b: np.ndarray) -> tuple[bytes, np.ndarray]:
    """a1,a2|b1; of each group, in a row, and where each group begins (and the end)."""
    upto_a, upto_b = np.cumsum(size_a), np.cumsum(size_b)
    groups = np.arange(len(size_a))
    # a token's place: its own number and that of the other side's tokens before it
    place_a = np.arange(len(a)) + np.repeat(upto_b - size_b, size_a)
    place_b = np.arange(len(b)) + np.repeat(upto_a, size_b)
    ids, ending = np.zeros(len(a) + len(b), np.int64), np.full(len(a) + len(b), ord(","), np.uint8)
    ids[place_a], ids[place_b] = a, b
    ending[place_a[upto_a[groups] - 1]] = ord("|")
    ending[place_b[upto_b[groups] - 1]] = ord(";")
    digits = 1 + sum((ids >= 10**k).astype(np.int64) for k in range(1, 10))
    end = np.cumsum(digits + 1)
    out = np.empty(int(end[-1]) if len(end) else 0, np.uint8)
    out[end - 1] = ending
    for k in range(int(digits.max(initial=0))):
        with_digit = digits > k
        out[end[with_digit] - 2 - k] = ord("0") + (ids[with_digit] // 10**k) % 10
    return out.tobytes(), np.r_[0, end][np.r_[0, upto_a + upto_b]]


@dataclass
class Fragment:
    """Tokens that end in a byte range; see the module. ``size_a``, ``size_b``: tokens of each closed group; the prefix has
    the first ``pre_a`` and ``pre_b`` tokens, the suffix those after the closed groups."""

    ok: bool
    cut: bool
    a: np.ndarray
    b: np.ndarray
    pre_a: int
    pre_b: int
    size_a: np.ndarray
    size_b: np.ndarray

    @classmethod
    def of(cls, a: np.ndarray, end_a: np.ndarray, b: np.ndarray, end_b: np.ndarray) -> Fragment:
        """From token ids and the offsets at which they end in the document."""
        common = _shared(end_a, end_b)
        if not len(common):
            return cls(True, False, a, b, len(a), len(b), *np.zeros((2, 0), np.int64))
        size_a, size_b = (np.diff(np.searchsorted(e, common, "right"), prepend=0) for e in (end_a, end_b))
        return cls(True, True, a, b, int(size_a[0]), int(size_b[0]), size_a[1:], size_b[1:])

    @classmethod
    def failed(cls) -> Fragment:
        none = np.zeros(0, np.int64)
        return cls(False, False, none, none, 0, 0, none, none)

    def _suffix(self) -> tuple[int, int]:
        return len(self.a) - self.pre_a - int(self.size_a.sum()), len(self.b) - self.pre_b - int(self.size_b.sum())

    def then(self, right: Fragment) -> Fragment:
        if not (self.ok and right.ok):
            return Fragment.failed()
        a, b = np.concatenate([self.a, right.a]), np.concatenate([self.b, right.b])
        if not self.cut:
            return Fragment(True, right.cut, a, b, self.pre_a + right.pre_a, self.pre_b + right.pre_b, right.size_a, right.size_b)
        if not right.cut:
            return Fragment(True, True, a, b, self.pre_a, self.pre_b, self.size_a, self.size_b)
        end_a, end_b = self._suffix()
        size_a = np.concatenate([self.size_a, [end_a + right.pre_a], right.size_a])
        size_b = np.concatenate([self.size_b, [end_b + right.pre_b], right.size_b])
        return Fragment(True, True, a, b, self.pre_a, self.pre_b, size_a, size_b)

    def closed(self) -> tuple[np.ndarray, np.ndarray]:
        """Group sizes, if the fragment is a whole document: its prefix is a group, and its last end is common."""
        return np.r_[self.pre_a, self.size_a][: int(self.cut) + len(self.size_a)], np.r_[self.pre_b, self.size_b][: int(self.cut) + len(self.size_b)]


# ---- stretches between blanks -------------------------------------------------------------------------------------

_VISIBLE = np.zeros(256, bool)
_VISIBLE[33:127] = True
#: First bytes of characters that are no blanks in any alphabet: most of two bytes, Chinese to Korean, those of four bytes.
_HEAD = _VISIBLE.copy()
_HEAD[0xC3:0xE0] = _HEAD[0xE4:0xEE] = _HEAD[0xF0:0xF5] = True


def safe_cuts(data: np.ndarray, starts: np.ndarray) -> np.ndarray:
    """Positions of blanks between two characters that are surely none; neither tokenizer has a token across such a place."""
    p = np.flatnonzero(data == 32)
    edge = np.zeros(len(data) + 1, bool)
    edge[starts] = True
    p = p[~edge[p] & ~edge[p + 1]]
    p = p[_HEAD[data[p + 1]]]
    one, two, three = data[p - 1], data[np.maximum(p - 2, 0)], data[np.maximum(p - 3, 0)]
    more = (one >= 0x80) & (one < 0xC0)
    wide = more & (two >= 0xC3) & (two < 0xE0)
    wider = more & (two >= 0x80) & (two < 0xC0) & (three >= 0xE4) & (three < 0xEE)
    return p[_VISIBLE[one] | wide | wider]


class Stretches:
    """The distinct stretches a task has met, whether they are spelled, and either their tokens or their part of a digest."""

    def __init__(self, tokenizers: Tokenizers, tokens: bool = False):
        self.tokenizers, self.tokens = tokenizers, tokens
        self.clear()

    def clear(self) -> None:
        self.number: dict[bytes, int] = {}
        self.ok = Growing(bool)
        few = self.tokenizers.n_codes < 1 << 31
        self.pairs, self.a, self.b = GrowingRagged(np.int32 if few else np.int64), GrowingRagged(np.int32), GrowingRagged(np.int32)
        self.sizes = [Growing() for _ in range(4)]
        self.said: list[bytes] = []

    def __len__(self) -> int:
        return self.ok.size

    def look_up(self, chunk: Chunk) -> tuple[np.ndarray, np.ndarray]:
        """The number of every stretch of the chunk, and where each text's stretches begin (and the end)."""
        begin = safe_cuts(chunk.data, chunk.starts) if self.tokenizers.cuts else np.zeros(0, np.int64)
        filled = chunk.starts[:-1][np.diff(chunk.starts) > 0]
        begin = np.sort(np.concatenate([begin, filled]), kind="stable")  # a safe cut is no text's begin
        offsets = np.r_[begin, len(chunk.data)].astype(np.int32)
        bodies = pa.BinaryArray.from_buffers(pa.binary(), len(begin), [None, pa.py_buffer(offsets), pa.py_buffer(np.ascontiguousarray(chunk.data))])
        named = bodies.dictionary_encode()
        distinct = named.dictionary.to_pylist()
        new = [d for d in distinct if d not in self.number]
        if new:
            self._learn(new)
        number = np.fromiter(map(self.number.__getitem__, distinct), np.int64, len(distinct))
        return number[named.indices.to_numpy()], np.searchsorted(begin, chunk.starts)

    def _learn(self, bodies: list[bytes]) -> None:
        self.number.update(zip(bodies, range(len(self), len(self) + len(bodies))))
        ok, a, b = self.tokenizers.encode_stretches(bodies)
        self.ok.add(ok)
        if self.tokens:
            self.a.add(a)
            self.b.add(b)
            return
        aligned = align(a, b, self.tokenizers)
        self.pairs.add(aligned.pairs)
        at = aligned.group_a.at
        for size, values in zip(self.sizes, (a.at, b.at, at, aligned.pairs.at)):
            size.add(np.diff(values))
        said, begins = render(a.flat, b.flat, aligned.group_a.flat, aligned.group_b.flat)
        cuts = begins[at].tolist()
        self.said += [said[i:j] for i, j in zip(cuts, cuts[1:])]


# ---- tasks --------------------------------------------------------------------------------------------------------


def _loaded(files) -> Tokenizers:
    return Tokenizers(*files.value)


DIGEST = "doc_id bigint, n_a bigint, n_b bigint, n_groups bigint, n_links bigint, groups_sha256 string, times bigint, pairs array<bigint>, links array<int>"
_NAMES = ["n_a", "n_b", "n_groups", "n_links"]


def _digests(doc_id: pa.Array, times: pa.Array, ok: np.ndarray, sizes: list[np.ndarray], said: list[bytes], pairs: Ragged, n_codes: int) -> pa.RecordBatch:
    """``pairs`` are all links of each text; the row has each pair once."""
    every, n = np.unique(pairs.owner() * n_codes + pairs.flat, return_counts=True)
    at = pa.array(np.searchsorted(every, np.arange(len(ok) + 1) * n_codes).astype(np.int32))
    lists = [pa.ListArray.from_arrays(at, pa.array(v)) for v in (every % n_codes, n.astype(np.int32))]
    sha = pa.array([hashlib.sha256(memoryview(s)[:-1]).hexdigest() if k else "" for s, k in zip(said, ok.tolist())], pa.string())
    columns = [pa.array(np.where(ok, s, 0).astype(np.int64)) for s in sizes]
    return pa.RecordBatch.from_arrays([doc_id.cast(pa.int64()), *columns, sha, times, *lists], names=["doc_id", *_NAMES, "groups_sha256", "times", "pairs", "links"])


def _digester(files):
    def digest(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known = Stretches(_loaded(files))
        n_codes = known.tokenizers.n_codes
        for chunk in chunks(batches):
            if len(known) >= STRETCHES:
                known.clear()
            number, at = known.look_up(chunk)
            # a text without bytes has no stretch, and no tokens
            ok = (sums(known.ok.now[number], at) == np.diff(at)) & (np.diff(at) > 0)
            said = list(map(known.said.__getitem__, number.tolist()))
            texts = [b"".join(said[i:j]) if k else b"" for i, j, k in zip(at[:-1].tolist(), at[1:].tolist(), ok.tolist())]
            held = np.repeat(ok, np.diff(at))
            lists = known.pairs.now.take(number[held])
            per_text = Ragged(lists.flat, lists.at[np.r_[0, np.cumsum(np.where(ok, np.diff(at), 0))]])
            sizes = [sums(size.now[number], at) for size in known.sizes]
            yield _digests(chunk.column("doc_id"), pa.array(np.ones(len(chunk), np.int64)), ok, sizes, texts, per_text, n_codes)

    return digest


def _pair_counter(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Sums of ``times`` times the links of each pair, some rows at a time."""
    held: list[tuple[np.ndarray, np.ndarray]] = []

    def tally() -> pa.RecordBatch:
        pairs, n = (np.concatenate(c) for c in zip(*held))
        held.clear()
        found, which = np.unique(pairs, return_inverse=True)
        return pa.RecordBatch.from_arrays([pa.array(found), pa.array(np.bincount(which, weights=n, minlength=len(found)).astype(np.int64))], names=["pair", "n"])

    for batch in batches:
        links = _tokens(batch, "links")
        held.append((batch.column("pairs").flatten().to_numpy(), links.flat * batch.column("times").to_numpy()[links.owner()]))
        if sum(len(p) for p, _ in held) >= HELD:
            yield tally()
    if held:
        yield tally()


WEIGHED = "row bigint, doc_id bigint, n_a bigint, n_b bigint, n_groups bigint, n_links bigint, n_best bigint, count_sum bigint, groups_sha256 string, times bigint, rare array<struct<pair:bigint,m:bigint>>"
_RARE = pa.list_(pa.struct([("pair", pa.int64()), ("m", pa.int64())]))


def _weigher(counted, n_b: int):
    """Sums of the known pairs' counts over each text's links, how many of these links are best, and the pairs that aren't known."""

    def weigh(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        pair, n, most = counted.value
        for batch in batches:
            links, own = _tokens(batch, "links"), batch.column("pairs").flatten().to_numpy()
            where = np.minimum(np.searchsorted(pair, own), max(0, len(pair) - 1))
            hit = pair[where] == own if len(pair) else np.zeros(len(own), bool)
            count = np.where(hit, n[where] if len(pair) else 0, 0)
            total, best = sums(count * links.flat, links.at), sums(links.flat * (hit & (count == most[own % n_b])), links.at)
            if hit.all():
                rare = pa.nulls(len(batch), _RARE)
            else:
                at = np.r_[0, np.cumsum(~hit)][links.at]
                fields = pa.StructArray.from_arrays([pa.array(own[~hit]), pa.array(links.flat[~hit])], ["pair", "m"])
                rare = pa.ListArray.from_arrays(pa.array(at.astype(np.int32)), fields)
            kept = batch.select(["row", "doc_id", *_NAMES])
            yield pa.RecordBatch.from_arrays(
                [*kept.columns, pa.array(best), pa.array(total), batch.column("groups_sha256"), batch.column("times"), rare],
                names=["row", "doc_id", *_NAMES, "n_best", "count_sum", "groups_sha256", "times", "rare"],
            )

    return weigh


PIECES = "doc_id bigint, print string, times bigint, no bigint, body string"


def _cutter(files):
    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        whole_texts = not _loaded(files).cuts
        for chunk in chunks(batches, "body"):
            places = safe_cuts(chunk.data, chunk.starts)
            owner, bodies, no = [], [], []
            for i in range(len(chunk)):
                a, b = int(chunk.starts[i]), int(chunk.starts[i + 1])
                # the first safe place after each multiple of PIECE
                next_place = np.searchsorted(places, np.arange(a + PIECE, b, PIECE))
                cuts = [] if whole_texts else np.unique(places[next_place[next_place < len(places)]])
                edges = [a, *(int(c) for c in cuts if c < b), b]
                for k, (x, y) in enumerate(zip(edges, edges[1:])):
                    owner.append(i)
                    no.append(k)
                    bodies.append(chunk.data[x:y].tobytes())
            ids = [chunk.column(c).take(pa.array(owner, pa.int64())) for c in ("doc_id", "print", "times")]
            yield pa.RecordBatch.from_arrays([*ids, pa.array(no, pa.int64()), pa.array(bodies, pa.binary()).cast(pa.string())], names=["doc_id", "print", "times", "no", "body"])

    return cut


FRAGMENT = "doc_id bigint, print string, times bigint, no bigint, ok boolean, cut boolean, a array<int>, b array<int>, pre_a int, pre_b int, size_a array<int>, size_b array<int>"
_PARTS = ("ok", "cut", "a", "b", "pre_a", "pre_b", "size_a", "size_b")


def _fragmenter(files):
    def fragments(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known = Stretches(_loaded(files), tokens=True)
        size_a, size_b = (np.diff(s.at) for s in (known.tokenizers.spell_a, known.tokenizers.spell_b))
        ints = pa.list_(pa.int32())
        kinds = [pa.bool_(), pa.bool_(), ints, ints, pa.int32(), pa.int32(), ints, ints]
        for chunk in chunks(batches, "body"):
            if len(known) >= STRETCHES:
                known.clear()
            number, at = known.look_up(chunk)
            found = []
            for i in range(len(chunk)):
                own = number[at[i] : at[i + 1]]
                a, b = known.a.now.take(own).flat, known.b.now.take(own).flat
                found.append(Fragment.of(a, np.cumsum(size_a[a]), b, np.cumsum(size_b[b])) if known.ok.now[own].all() else Fragment.failed())
            columns = [pa.array([getattr(f, p) for f in found], t) for p, t in zip(_PARTS, kinds)]
            yield pa.RecordBatch.from_arrays([*(chunk.column(c) for c in ("doc_id", "print", "times", "no")), *columns], names=["doc_id", "print", "times", "no", *_PARTS])

    return fragments


def _product(rows: pa.Table) -> Fragment:
    """Neighbouring fragments of a text as one, joined in pairs."""
    rows = rows.sort_by("no").combine_chunks()
    lists = {c: _tokens(rows, c) for c in ("a", "b", "size_a", "size_b")}
    others = {c: rows.column(c).to_pylist() for c in ("ok", "cut", "pre_a", "pre_b")}
    parts = [
        Fragment(**{c: v.flat[v.at[i] : v.at[i + 1]] for c, v in lists.items()}, **{c: v[i] for c, v in others.items()}) for i in range(len(rows))
    ]
    while len(parts) > 1:
        parts = [x.then(y) for x, y in zip(parts[::2], parts[1::2])] + parts[len(parts) // 2 * 2 :]
    return parts[0]


_FRAGMENT_KINDS = [pa.int64(), pa.string(), pa.int64(), pa.int64(), pa.bool_(), pa.bool_(), *[pa.list_(pa.int32())] * 2, pa.int32(), pa.int32(), *[pa.list_(pa.int32())] * 2]


def _joined(key: tuple, rows: pa.Table) -> pa.Table:
    one = _product(rows)
    head = [rows.column("doc_id")[0], rows.column("print")[0], rows.column("times")[0], key[2]]
    values = [*(h.as_py() for h in head), *(getattr(one, p) for p in _PARTS)]
    return pa.Table.from_arrays([pa.array([v], t) for v, t in zip(values, _FRAGMENT_KINDS)], names=["doc_id", "print", "times", "no", *_PARTS])


def joined(fragments: DataFrame, pieces: int) -> DataFrame:
    """At most ``FAN`` fragments for each text, by rounds that join ``FAN`` neighbours."""
    while pieces > FAN:
        groups = fragments.withColumn("next", F.expr(f"no div {FAN}")).groupBy("doc_id", "print", "next")
        fragments = groups.applyInArrow(_joined, FRAGMENT)
        pieces = -(-pieces // FAN)
    return fragments


def _tokens(batch: pa.RecordBatch | pa.Table, name: str) -> Ragged:
    column = batch.column(name)
    column = column.combine_chunks() if isinstance(column, pa.ChunkedArray) else column
    return Ragged(column.flatten().to_numpy().astype(np.int64), np.r_[0, np.cumsum(column.value_lengths().to_numpy())].astype(np.int64))


def _finisher(files):
    """The digest of a text from its fragments."""
    held: list[Spelling] = []

    def finish(rows: pa.Table) -> pa.Table:
        if not held:
            held.append(Spelling.sent(files.value))
        spelling, text = held[0], _product(rows)
        a, b = (Ragged(t.astype(np.int64), np.array([0, len(t)])) for t in (text.a, text.b))
        pairs, groups = align(a, b, spelling).pairs, text.closed()
        sizes = [np.array([n]) for n in (len(a.flat), len(b.flat), len(groups[0]), len(pairs.flat))]
        said = [render(text.a, text.b, *groups)[0]]
        one = rows.slice(0, 1).combine_chunks()
        doc_id, times = (one.column(c).chunk(0) for c in ("doc_id", "times"))
        return pa.Table.from_batches([_digests(doc_id, times, np.array([text.ok]), sizes, said, pairs, spelling.n_codes)])

    return finish


# ---- the corpus ---------------------------------------------------------------------------------------------------


def _known(pairs: DataFrame, most: int) -> DataFrame:
    """The most frequent pairs, at most ``most`` of them: those whose counts reach a certain level."""
    level = F.floor(F.log2("n") * 16).cast("int")
    per = pairs.groupBy(level.alias("level")).agg(F.count("*").alias("many")).orderBy(F.col("level").desc()).collect()  # some hundred rows
    least, held = None, 0
    for r in per:
        held += r.many
        if held > most:
            break
        least = r.level
    return pairs.where(level >= least) if least is not None else pairs.limit(0)


def link_counts(pairs: DataFrame, n_b: int, most: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """The most frequent pairs, rising, with their counts, and the highest count of every B id."""
    best = pairs.groupBy(F.pmod("pair", F.lit(n_b)).alias("b")).agg(F.max("n").alias("n")).toArrow()  # one row for each id of B
    highest = np.zeros(n_b, np.int64)
    highest[best["b"].to_numpy()] = best["n"].to_numpy()
    known = _known(pairs, most).toArrow()
    pair, n = known["pair"].to_numpy(), known["n"].to_numpy()
    order = np.argsort(pair)
    return pair[order], n[order], highest


def aligned(docs: DataFrame, a_path: str, b_path: str, doc_id: str = "doc_id", text: str = "text", known: int = KNOWN) -> DataFrame:
    """doc_id, n_a, n_b, n_groups, n_links, n_best, count_sum, groups_sha256 of every row of ``docs``."""
    spark: SparkSession = docs.sparkSession
    with open(a_path, encoding="utf-8") as a_file, open(b_path, "rb") as b_file:  # vocabularies lie beside the driver
        tokenizers = Tokenizers(a_file.read(), b_file.read())
    files = spark.sparkContext.broadcast(tokenizers.sent())
    body = whole(F.col(text))
    rows = docs.select(F.col(doc_id).cast("bigint").alias("doc_id"), F.when(body == "", "").otherwise(F.concat(F.lit(" "), body)).alias("text"))
    short = rows.where(F.octet_length("text") <= PIECE)

    long = rows.where(F.octet_length("text") > PIECE).groupBy("doc_id", F.col("text").alias("body")).agg(F.count("*").alias("times"))
    long = long.select("doc_id", F.sha2("body", 256).alias("print"), "times", "body").mapInArrow(_cutter(files), PIECES)
    tasks = int(spark.conf.get("spark.sql.shuffle.partitions"))
    fragments = long.repartition(tasks, "doc_id", "print", "no").mapInArrow(_fragmenter(files), FRAGMENT)
    longest = rows.agg(F.max(F.octet_length("text"))).head()[0] or 0
    pieces = -(-longest // PIECE)  # all but the last have that many bytes
    digests = short.mapInArrow(_digester(files), DIGEST).unionByName(joined(fragments, pieces).groupBy("doc_id", "print").applyInArrow(_finisher(files), DIGEST))
    digests = stored(digests.withColumn("row", F.monotonically_increasing_id()), "alignments")
    pairs = stored(digests.select("times", "pairs", "links").mapInArrow(_pair_counter, "pair bigint, n bigint").groupBy("pair").agg(F.sum("n").alias("n")), "pairs")
    counted = spark.sparkContext.broadcast(link_counts(pairs, tokenizers.n_b, known))
    weighed = digests.mapInArrow(_weigher(counted, tokenizers.n_b), WEIGHED)

    # links of the other pairs; the written rows have fixed numbers
    b = F.pmod("pair", F.lit(tokenizers.n_b))
    highest = pairs.groupBy(b.alias("b")).agg(F.max("n").alias("most"))
    rare = stored(weighed.where("rare is not null").select("row", F.inline("rare")), "rare-links").join(pairs, "pair").withColumn("b", b).join(highest, "b")
    more = rare.groupBy("row").agg(F.sum(F.when(F.col("n") == F.col("most"), F.col("m")).otherwise(0)).alias("more_best"), F.sum(F.col("m") * F.col("n")).alias("more_sum"))
    both = weighed.join(more, "row", "left")
    both = both.withColumns({"n_best": F.col("n_best") + F.coalesce("more_best", F.lit(0)), "count_sum": F.col("count_sum") + F.coalesce("more_sum", F.lit(0))})
    both = both.withColumn("copy", F.explode(F.sequence(F.lit(1).cast("bigint"), "times")))
    return both.select("doc_id", *_NAMES, "n_best", "count_sum", "groups_sha256")
