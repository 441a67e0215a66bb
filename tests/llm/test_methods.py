"""Parts of the operators against plain computations."""

import random
import re

import numpy as np
import pandas as pd
import pyarrow as pa
import pytest

from panelcast.llm import classifier, leaks, neardup, repeats, secrets, suffixsort, trigrams
from panelcast.llm.bytescan import chunks
from panelcast.llm.entities import base_spans
from panelcast.llm.quality import fit


def test_trigram_queries():
    assert trigrams.clauses("abcd|xyz[0-9]+") == [frozenset({"abc", "bcd"}), frozenset({"xyz"})]
    assert trigrams.clauses("[0-9a-f]{24,}") == [frozenset()]
    assert trigrams.clauses("ab?cde") == [frozenset({"abc", "bcd", "cde"}), frozenset({"acd", "cde"})]
    assert trigrams.clauses("(foo)*bar") == [frozenset({"bar"})]
    assert trigrams.clauses("x{2,}y") == [frozenset()]


def test_every_match_meets_its_query():
    texts = ['my API_KEY="abc123xyz"', "passwd: longenough", "AKIA" + "Q" * 20, "ghp_" + "a" * 40, "xoxb-1234567890-abc", "-----BEGIN RSA PRIVATE KEY-----"]
    for rule in secrets.BASE_RULES + secrets.MORE_RULES:
        for text in texts:
            for m in re.finditer(rule.pattern, text):
                held = {m.group().lower()[i : i + 3] for i in range(len(m.group()) - 2)}
                assert any(c <= held for c in trigrams.clauses(rule.pattern))


def test_merge_sort_is_a_suffix_sort():
    rng = random.Random(3)
    data = np.frombuffer(("".join(rng.choice("ab") for _ in range(300)) * 2 + "c" * 50).encode(), np.uint8)
    limit = 40
    at = np.arange(len(data) - limit)
    group = at % 3
    s = suffixsort.Suffixes(data, limit)
    order = suffixsort.merge_sort(s, at, group)
    raw = data.tobytes()
    keys = [(group[i], raw[at[i] : at[i] + limit]) for i in order]
    assert keys == sorted(keys)
    a, b = at[:-1], at[1:]
    plain = [next((k for k in range(limit) if raw[x + k] != raw[y + k]), limit) for x, y in zip(a, b)]
    assert s.common(a, b).tolist() == plain


def _chunk(texts, **more):
    batch = pa.RecordBatch.from_pydict({"text": pa.array(texts, pa.string()), **more})
    return next(chunks(iter([batch])))


def test_equal_strings_have_equal_anchors():
    rng = random.Random(5)
    word = lambda: "".join(rng.choice("abcdefgh ") for _ in range(rng.randint(1, 900)))
    passage = "".join(rng.choice("abc") for _ in range(repeats.LENGTH))
    texts = [word() + passage + word() for _ in range(20)] + ["z" * 1000, passage * 4, ""]
    chunk = _chunk(texts)
    doc, p, nearest, most, _ = repeats.find_anchors(chunk)
    owned = {}
    for d, at, low, high in zip(doc, p, nearest, most):
        for k in range(low, high + 1):
            owned[d, at - k] = owned.get((d, at - k), ()) + (k,)
    for i in range(len(texts)):
        a, b = chunk.starts[i], chunk.starts[i + 1]
        assert [owned.get((i, s)) is not None for s in range(a, b)] == [s <= b - repeats.LENGTH for s in range(a, b)]
    assert all(len(v) == 1 for v in owned.values())
    raw = chunk.data.tobytes()
    distance = {}
    for (i, s), (k,) in owned.items():
        distance.setdefault(raw[s : s + repeats.LENGTH], set()).add(k)
    assert all(len(v) == 1 for v in distance.values())


@pytest.mark.parametrize("most", [repeats.MOST_CONTEXTS, 1])
def test_repeats_by_brute_force(spark, monkeypatch, most):
    monkeypatch.setattr(repeats, "MOST_CONTEXTS", most)
    rng = random.Random(most)
    fresh = lambda n: "".join(rng.choice("abcdé \n") for _ in range(n))
    passages = [fresh(n) for n in (398, 430, 700)]
    texts = [fresh(rng.randint(0, 500)) + rng.choice(passages) + fresh(rng.randint(0, 300)) for _ in range(40)]
    texts += [texts[0], texts[0], passages[2] * 2, "x" * 900, None]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id bigint, text string")
    raw = [(t or "").encode() for t in texts]
    seen = {}
    for i, t in enumerate(raw):
        for s in range(len(t) - 399):
            seen.setdefault(t[s : s + 400], []).append((i, s))
    gone = [np.zeros(len(t), bool) for t in raw]
    for found in seen.values():
        for i, s in found if len(found) > 1 else ():
            gone[i][s : s + 400] = True
    for r in repeats.without_repeats(docs).collect():
        mask = np.zeros(r.n_bytes, bool)
        for s in r.removed:
            mask[s.a : s.b] = True
        assert (mask == gone[r.doc_id]).all()


def _brute_components(texts, n, percent):
    sets = []
    for t in texts:
        w = t.lower().split()
        sets.append({tuple(w[i : i + n]) for i in range(len(w) - n + 1)} or ({tuple(w)} if w else set()))
    root = list(range(len(texts)))

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    for i in range(len(texts)):
        for j in range(i):
            both = len(sets[i] & sets[j])
            if sets[i] and 100 * both >= percent * (len(sets[i]) + len(sets[j]) - both):
                a, b = find(i), find(j)
                root[max(a, b)] = min(a, b)
    return [find(i) for i in range(len(texts))]


def test_near_duplicates_by_brute_force(spark, monkeypatch):
    monkeypatch.setattr(neardup, "BLOCK", 16)
    monkeypatch.setattr(neardup, "ROWS_PER_TASK", 100)
    rng = random.Random(11)
    fresh = lambda n: [f"w{rng.randint(0, 10**6)}" for _ in range(n)]
    texts = []
    for size, copies in ((150, 160), (40, 30), (3, 4)):
        base = fresh(size)
        for _ in range(copies):
            own = list(base)
            for _ in range(rng.randint(0, 6)):
                own[rng.randrange(size)] = f"e{rng.randint(0, 40)}"
            texts.append(" ".join(own))
    texts += [" ".join(fresh(60)) for _ in range(30)] + ["one", "one", "ONE two"]
    rng.shuffle(texts)
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id bigint, text string")
    found = {r.doc_id: r.component_id for r in neardup.near_duplicates(docs, words=4).collect()}
    assert [found[i] for i in range(len(texts))] == _brute_components(texts, 4, 80)


def test_block_comparison_finds_every_component():
    rng = np.random.default_rng(2)
    base = rng.integers(0, 2**60, 100, dtype=np.uint64)
    rows = []
    for i in range(40):
        own = np.unique(np.r_[base[: 100 - i % 30], rng.integers(0, 2**60, i % 30, dtype=np.uint64)])
        rows.append({"key": 0, "rb": 0, "mb": 0, "id": i, "root": i, "items": own.tobytes(), **{f"c{k}": 0 for k in range(neardup.CHUNKS)}})
    frame = pd.DataFrame([{**r, "side": s} for r in rows for s in (0, 1)])
    links = neardup._blocks(80)(frame)
    sets = [set(np.frombuffer(r["items"], np.uint64).tolist()) for r in rows]
    plain = {(i, j) for i in range(40) for j in range(40) if i != j and 100 * len(sets[i] & sets[j]) >= 80 * len(sets[i] | sets[j])}
    assert set(zip(links["a"], links["b"])) == plain


def _plain_score(a, b):
    best, row = 0, [0] * (len(b) + 1)
    for x in a:
        new = [0]
        for j, y in enumerate(b):
            new.append(max(0, row[j] + (leaks.MATCH if x == y else leaks.MISMATCH), row[j + 1] + leaks.GAP, new[j] + leaks.GAP))
        row = new
        best = max(best, *row)
    return best


def test_alignment_by_plain_table():
    rng = np.random.default_rng(4)
    items, windows = rng.integers(0, 5, (30, 12), dtype=np.uint64), rng.integers(0, 5, (30, 20), dtype=np.uint64)
    sizes = rng.integers(1, 13, 30)
    best, _ = leaks.align(items, sizes, windows)
    assert best.tolist() == [_plain_score(a[:n].tolist(), b.tolist()) for a, n, b in zip(items, sizes, windows)]


def test_base_spans():
    text = "a.b@c.d@e.f x@y 1.2.3.4.5.6.7.8 999.1.1.1 4111 1111 1111 1111 4111111111111112 +1 (2) +49 30 1234567"
    found = [(k, text[a:b]) for k, a, b in base_spans(text)]
    assert found == [(0, "a.b@c.d"), (1, "1.2.3.4"), (1, "5.6.7.8"), (3, "+49 30 1234567")]
    assert base_spans("4111 1111 1111 1111") == [(2, 0, 19)]
    assert base_spans("a" * 50_000 + "@" + "1" * 50_000) == []


def test_votes_without_labels():
    p = fit([((1, 0), 900), ((-1, 0), 50), ((-1, -1), 30), ((0, 0), 5)])
    assert p[(1, 0)] > 0.9 and p[(-1, -1)] < 0.1 and fit([]) == {}


def test_classifier_learns_and_calibrates():
    rng = np.random.default_rng(1)
    x = rng.normal(size=(2000, 6))
    y = (x[:, 0] * x[:, 1] + 0.3 * rng.normal(size=2000) > 0).astype(float)
    held = np.arange(2000) % 5 == 0
    net = classifier.train(x, y, held)
    assert ((net.scores(x[held]) >= 0.5) == y[held]).mean() > 0.8
    assert classifier.train(x[:4], y[:4], held[:4]).scores(x[:4]).tolist() == pytest.approx([(y[:4].sum() + 1) / 6] * 4)


def test_held_out_accuracy(spark):
    folder = "/root/testdata/sf0.01"
    docs, labels = (spark.read.parquet(f"{folder}/{t}.parquet") for t in ("documents", "labels"))
    rows = classifier.quality_scores(docs, labels).where("held_out").join(labels, "doc_id").collect()
    assert np.mean([(r.score >= 0.5) == (r.quality == 1) for r in rows]) > 0.95
