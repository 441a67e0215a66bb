"""Phrase collocations against a plain count of everything."""

import itertools
import math
import random
import re
from collections import Counter

import numpy as np
import pytest

from panelcast.llm import phrases

SCHEMA = "doc_id bigint, text string, lang string"


def plain(rows, longest, least, top, percent=100):
    counts, words = {}, Counter()
    for text, lang in rows:
        lang = lang or "und"
        own = counts.setdefault(lang, Counter())
        lowered = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")
        for piece in re.split(r"[.,;:!?\x0A-\x0D]", lowered):
            w = re.findall(r"[^\x20\x09]+", piece)
            words[lang] += len(w)
            for n in range(1, longest + 1):
                own.update(tuple(w[i : i + n]) for i in range(len(w) - n + 1))
    out = []
    for lang, f in counts.items():
        found = {p: a for p, a in f.items() if a >= least and len(p) > 1}
        ranked = []
        for p, a in found.items():
            cuts = [(1000 * a * words[lang] // (f[p[:k]] * f[p[k:]]), k) for k in range(1, len(p))]
            score, k = min(cuts)
            longer = [b for q, b in found.items() if len(q) > len(p) and any(q[i : i + len(p)] == p for i in range(len(q) - len(p) + 1))]
            if not any(100 * b >= percent * a for b in longer):
                ranked.append((-score, -a, " ".join(p).encode(), f[p[:k]], f[p[k:]]))
        ranked.sort()
        out += [(lang, i + 1, p.decode(), -a, l, r, words[lang], -s) for i, (s, a, p, l, r) in enumerate(ranked[:top])]
    return sorted(out)


def corpus(seed, n=120):
    rng = random.Random(seed)
    vocabulary = ["a", "the", "The", "über", "x-y", "new", "york", "times", "of", "東京"]
    gaps = [" ", " ", " ", "  ", "\t", ", ", ".\n", " \r\n", "; ", "\x0b"]
    rows = []
    for _ in range(n):
        w = rng.choices(vocabulary, k=rng.randint(0, 60))
        text = "".join(x + rng.choice(gaps) for x in w) + rng.choice(["", "new york times", "NEW YORK"])
        rows.append((text, rng.choice(["en", "en", "en", "de", None])))
    return rows + [(None, "en"), ("", None), (" ,.\n", "de"), (rows[0][0], "en"), (rows[0][0], "en")]


@pytest.mark.parametrize(("least", "top", "percent"), [(3, 1000, 100), (10, 7, 100), (3, 50, 60)])
def test_collocations_by_plain_count(spark, monkeypatch, least, top, percent):
    monkeypatch.setattr(phrases, "TABLE", 500)
    monkeypatch.setattr(phrases, "SMALL_PART", 400)
    monkeypatch.setattr(phrases, "SLACK", 1)
    rows = corpus(least)
    docs = spark.createDataFrame([(i, *r) for i, r in enumerate(rows)], SCHEMA).repartition(5)
    found = phrases.collocations(docs, least=least, top=top, percent=percent).collect()
    assert sorted(tuple(r) for r in found) == plain(rows, 5, least, top, percent)


def test_other_columns_and_no_rows(odd, none):
    assert phrases.collocations(none).collect() == []
    found = {r.phrase: r.a for r in phrases.collocations(odd, least=20).where("lang = 'en'").collect()}
    # one row has five of these and two rows are repeated
    assert found["same words again and again"] == 90 and "again and" not in found


def test_long_words_and_texts(spark):
    rows = [("y" * 300_000 + " z " + "a b " * 40_000, "en"), ("a" + " a" * 50_000, "de")]
    docs = spark.createDataFrame([(i, *r) for i, r in enumerate(rows)], SCHEMA)
    found = {(r.lang, r.phrase): r.a for r in phrases.collocations(docs, longest=3).collect()}
    assert found == {("en", "a b a"): 39_999, ("en", "b a b"): 39_999, ("en", "a b"): 40_000, ("de", "a a a"): 49_999, ("de", "a a"): 50_000}


def test_exact_beyond_64_bits(spark):
    counts = spark.createDataFrame(
        [("en", "", 10**15), ("en", "p q", 7 * 10**12), ("en", "p", 9 * 10**12 + 1), ("en", "q", 8 * 10**12 + 3)], "lang string, phrase string, n bigint"
    )
    (row,) = phrases._lowest_cuts(counts.where("phrase = 'p q'"), counts).collect()
    assert row.score == 1000 * 7 * 10**12 * 10**15 // ((9 * 10**12 + 1) * (8 * 10**12 + 3))


def test_summaries_keep_every_frequent_key():
    rng = np.random.default_rng(3)
    for least, capacity in ((20, 40), (50, 10), (7, 3)):
        stream = np.r_[rng.integers(0, 2000, 4000), np.repeat(np.arange(5000, 5020), least), np.zeros(3000, np.int64)]
        rng.shuffle(stream)
        true = Counter(stream.tolist())
        whole, halves = phrases.Summary(capacity, least), [phrases.Summary(capacity, 10**9) for _ in range(4)]
        for part, half in zip(np.array_split(stream, 40), itertools.cycle(halves)):
            keys, n = np.unique(part, return_counts=True)
            whole.add(keys, n)
            half.add(keys, n)
        assert whole.lost < least
        assert {k for k, n in true.items() if n >= least} <= set(whole.reach().tolist())
        merged = halves[0]
        for other in halves[1:]:
            merged.add(other.keys, other.counts, other.lost)
        assert len(merged.keys) <= capacity and merged.lost <= len(stream) / (capacity + 1)
        for summary in (whole, merged):
            held = dict(zip(summary.keys.tolist(), summary.counts.tolist()))
            assert all(held.get(k, 0) <= n <= held.get(k, 0) + summary.lost for k, n in true.items())


def test_packed_keys():
    keys = np.sort(np.random.default_rng(1).integers(0, 2**32, 1000)).astype(np.uint64)
    assert phrases._from_planes(phrases._planes(keys)).tolist() == keys.tolist()
    batch = phrases._tally([keys << np.uint64(32) | keys, keys[:10] << np.uint64(32) | keys[:10]], 7)
    rows = batch.to_pylist()
    assert sum(len(r["once"]) for r in rows) // 4 == 990 and sum(len(r["many"]) for r in rows) // 4 == 10
    assert all(math.floor(k * 7 / 2**32) == r["part"] for r in rows for k in phrases._from_planes(r["once"]).tolist())
