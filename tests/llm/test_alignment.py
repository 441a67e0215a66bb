"""Fragments and links against a plain walk through both tokenizers' tokens."""

import collections
import hashlib
import random

import numpy as np
import pytest

from panelcast.llm import alignment as al
from panelcast.llm.queries import TOKENIZERS

A, B = f"{TOKENIZERS}/byte_bpe_50k.json", f"{TOKENIZERS}/piece_bpe_32k.model"


@pytest.fixture(scope="module")
def pair():
    with open(A, encoding="utf-8") as a, open(B, "rb") as b:
        return al.Tokenizers(a.read(), b.read())


def spelled(pair):
    return [[bytes(s.flat[s.at[i] : s.at[i + 1]].astype(np.uint8)) for i in range(len(s))] for s in (pair.spell_a, pair.spell_b)]


def plain(pair, texts):
    """Per text: tokens of both, groups and links, or None; whole texts are encoded."""
    a_bytes, b_bytes = spelled(pair)
    out = []
    for text in texts:
        body = (" " + (text or "")).encode()
        a, b = pair.a.encode(body.decode(), add_special_tokens=False).ids, pair.b.encode(text or "")
        if not text or b"".join(a_bytes[x] for x in a) != body or b"".join(b_bytes[x] for x in b) != body:
            out.append(None)
            continue
        ends = [list(np.cumsum([len(t[x]) for x in ids])) for t, ids in ((a_bytes, a), (b_bytes, b))]
        common = sorted(set(ends[0]) & set(ends[1]))
        groups = [[[], []] for _ in common]
        for side, ids in enumerate((a, b)):
            for x, e in zip(ids, ends[side]):
                groups[int(np.searchsorted(common, e))][side].append(x)
        links, i, j = [], 0, 0
        while i < len(a) and j < len(b):
            links.append((a[i], b[j]))
            x, y = ends[0][i], ends[1][j]
            i, j = i + (x <= y), j + (y <= x)
        out.append((a, b, groups, links))
    return out


def digests(pair, texts):
    found = plain(pair, texts)
    counts = collections.Counter(link for one in found if one for link in one[3])
    best = collections.Counter()
    for (_, b), n in counts.items():
        best[b] = max(best[b], n)
    rows = []
    for one in found:
        if one is None:
            rows.append((0, 0, 0, 0, 0, 0, ""))
            continue
        a, b, groups, links = one
        said = ";".join(",".join(map(str, x)) + "|" + ",".join(map(str, y)) for x, y in groups)
        sums = sum(counts[x] == best[x[1]] for x in links), sum(counts[x] for x in links)
        rows.append((len(a), len(b), len(groups), len(links), *sums, hashlib.sha256(said.encode()).hexdigest()))
    return rows


def made(n, seed=1):
    rng = random.Random(seed)
    words = ["the", "Über", "naïve", "東京都", "a1b2", "###", "don't", "x" * 40, "🎉🎉", "...", "́", "½", "मानक", "<s>", "<|endoftext|>", "<0x41>", " ", " ", "　"]
    gaps = [" "] * 12 + ["  ", "\n", " \n", "\t", ", ", " ", ""]
    return ["".join(rng.choice(words) + rng.choice(gaps) for _ in range(rng.randint(0, 120))) for _ in range(n)]


ODD = [None, "", " ", "a ▁ b", " lead", "trail ", "  two  blanks  ", "\n", "日本 語 é è " * 300, "y" * 3000, "​ zero", "\x00 nul", "﻿ bom"]


@pytest.mark.parametrize(("piece", "known"), [(al.PIECE, al.KNOWN), (300, 50), (150, 0)])
def test_corpus_by_plain_walk(spark, pair, monkeypatch, piece, known):
    monkeypatch.setattr(al, "PIECE", piece)
    monkeypatch.setattr(al, "FAN", 3)
    monkeypatch.setattr(al, "STRETCHES", 400)
    texts = made(60, piece) + ODD + ["broken ▁ piece " + "word " * 200, "same long text " * 40, "same long text " * 40]
    ids = [*range(len(texts) - 2), None, None]
    docs = spark.createDataFrame(list(zip(ids, texts)), "doc_id bigint, text string").repartition(3)
    found = al.aligned(docs, A, B, known=known).collect()
    wanted = [(-1 if i is None else i, *row) for i, row in zip(ids, digests(pair, texts))]
    assert sorted((-1 if r.doc_id is None else r.doc_id, *r[1:]) for r in found) == sorted(wanted)


def equal(x, y):
    return all(np.array_equal(getattr(x, f), getattr(y, f)) for f in al._PARTS)


def test_fragments_are_associative(pair):
    size_a, size_b = (np.diff(s.at) for s in (pair.spell_a, pair.spell_b))
    rng = random.Random(4)
    for text in made(30, 8):
        _, a, b = pair.encode([(" " + text).encode()])
        ends = np.cumsum(size_a[a.flat]), np.cumsum(size_b[b.flat])
        if not len(a.flat):
            continue
        whole = al.Fragment.of(a.flat, ends[0], b.flat, ends[1])
        # ranges that cut tokens and characters anywhere, empty ones too
        cuts = sorted(rng.choices(range(ends[0][-1] + 1), k=rng.randint(1, 20)))
        edges = [0, *cuts, int(ends[0][-1])]
        parts = []
        for x, y in zip(edges, edges[1:]):
            held = [(t.flat[(e > x) & (e <= y)], e[(e > x) & (e <= y)]) for t, e in ((a, ends[0]), (b, ends[1]))]
            parts.append(al.Fragment.of(*held[0], *held[1]))
        while len(parts) > 1:
            i = rng.randrange(len(parts) - 1)
            parts[i : i + 2] = [parts[i].then(parts[i + 1])]
        assert equal(parts[0], whole)
        (one,) = plain(pair, [text])
        if one:
            said, at = al.render(whole.a, whole.b, *whole.closed())
            groups = [said[i:j].decode() for i, j in zip(at.tolist(), at[1:].tolist())]
            assert groups == [",".join(map(str, x)) + "|" + ",".join(map(str, y)) + ";" for x, y in one[2]]
    assert not whole.then(al.Fragment.failed()).ok and not al.Fragment.failed().then(whole).ok


def test_stretches_as_one_text(pair, monkeypatch):
    monkeypatch.setattr(al, "ONE_TEXT", 100)
    bodies = [b" a", b" bc,\nd", "  two".encode(), " trail ".encode(), " é".encode(), " ▁x".encode(), b" a", " 東京 都".encode()] * 9
    for found, wanted in zip(pair.encode_stretches(bodies), pair.encode(bodies)):
        if isinstance(found, al.Ragged):
            assert found.flat.tolist() == wanted.flat.tolist() and found.at.tolist() == wanted.at.tolist()
        else:
            assert found.tolist() == wanted.tolist() and not found.all()


def test_safe_cuts_are_safe(pair):
    assert pair.cuts
    for text in made(80, 3) + [t for t in ODD if t]:
        body = (" " + text).encode()
        data = np.frombuffer(body, np.uint8)
        cuts = [0, *al.safe_cuts(data, np.array([0, len(data)])).tolist(), len(data)]
        parts = [body[x:y].decode() for x, y in zip(cuts, cuts[1:])]
        assert [x for p in parts for x in pair.a.encode(p, add_special_tokens=False).ids] == pair.a.encode(body.decode(), add_special_tokens=False).ids
        assert [x for p in parts for x in pair.b.encode(p[1:])] == pair.b.encode(text)


def test_odd_rows(odd, none):
    rows = al.aligned(odd, A, B).collect()
    assert sorted(r.doc_id or 0 for r in rows) == [0, 0, 1, 2, 3, 5, 5, 6, 7, 8]
    found = {r.doc_id: r for r in rows}
    assert found[1][1:] == found[2][1:] == (0, 0, 0, 0, 0, 0, "")
    assert found[5][1:] == found[6][1:] and found[7].n_a > 30_000
    assert al.aligned(none, A, B).collect() == []
