"""Fingerprints against the definition: order, insertion, the next text, likeness."""

import hashlib
import random

import numpy as np
import pytest

from panelcast.llm import fingerprints as fp


def plain_exact(text):
    """Sum of the paragraphs' hashes, lane by lane."""
    total = np.zeros(fp.EXACT, np.uint32)
    for paragraph in text.split("\n") if text else []:
        total += np.frombuffer(hashlib.blake2b(paragraph.encode()).digest(), "<u4")
    return total


def made(seed, n):
    rng = random.Random(seed)
    words = [f"w{i}" for i in range(400)] + ["é", "東京", "🎉"]
    text = lambda: "\n".join(" ".join(rng.choices(words, k=rng.choice([0, 1, 2, 5, 30]))) for _ in range(rng.randint(0, 12)))
    return [text() for _ in range(n)] + ["", "\n", "\n\n", "abc", "abcd", "x" * 50, "one line only " * 20]


def test_sum_of_paragraphs():
    texts = made(1, 60)
    found = fp.vectors(texts)
    assert (found[:, : fp.EXACT] == np.array([plain_exact(t) for t in texts])).all()
    rng = random.Random(2)
    for t, v in zip(texts, found):
        parts = t.split("\n")
        rng.shuffle(parts)
        assert (fp.vectors(["\n".join(parts)])[0] == v).all()
        # a paragraph taken out and put in again
        if len(parts) > 1:
            less = fp.vectors(["\n".join(parts[1:])])[0] if any(parts[1:]) else fp.vectors([""] * 1)[0] + fp.vectors(["\n".join(parts[1:])], np.array([True]))[0]
            assert (less + fp.vectors([parts[0]], np.array([True]))[0] == v).all()
        assert (fp.decoded(fp.encoded(v)) == v).all()
    assert len({fp.encoded(v) for v in found}) == len(set(tuple(sorted(t.split("\n"))) if t else () for t in texts))


def plain_pairs(rows):
    """(doc_id, text, edited text, next text) in the order of ids, null last, then text's hash."""
    out = []
    for i, (d, t) in enumerate(rows):
        following = rows[(i + 1) % len(rows)][1]
        out.append((d, t, t[: len(t) - len(t) // 4] + following[: len(t) // 4], following))
    return out


@pytest.mark.parametrize("size", [1, 2_000, 1 << 25])
def test_with_next_by_definition(spark, monkeypatch, size):
    monkeypatch.setattr(fp, "RANGE_BYTES", size)
    monkeypatch.setattr(fp, "STEP_BYTES", min(size, 3_000))
    texts = made(size, 80)
    ids = random.Random(size).sample(range(-10**12, 10**12), len(texts))
    docs = spark.createDataFrame(list(zip(ids, texts)), "doc_id bigint, text string").repartition(4)
    found = {r.doc_id: r for r in fp.with_next(docs).collect()}
    assert len(found) == len(texts)
    for d, text, edited, following in plain_pairs(sorted(zip(ids, texts))):
        r = found[d]
        assert (r.n_chars, r.edited_sha256) == (len(text), hashlib.sha256(edited.encode()).hexdigest())
        one, two, three = fp.vectors([text, edited, following])
        assert (r.fingerprint, r.edited_fingerprint) == (fp.encoded(one), fp.encoded(two))
        assert r.near_edited == fp.likeness(one[None], two[None])[0] and r.near_next == fp.likeness(one[None], three[None])[0]
        assert (r.near_edited == 1) or text != edited
        assert 0 <= r.near_edited <= 1 and 0 <= r.near_next <= 1


def test_likeness_follows_what_is_shared():
    rng = random.Random(5)
    fresh = lambda n: "\n".join(" ".join(f"v{rng.randint(0, 10**6)}" for _ in range(12)) for _ in range(n))
    base = fresh(40)
    for share in (0.0, 0.25, 0.5, 0.75, 0.9, 1.0):
        kept = base.split("\n")[: int(40 * share)]
        other = "\n".join([*kept, *(fresh(40 - len(kept)).split("\n") if len(kept) < 40 else [])])
        a, b = fp.vectors([base, other])
        assert fp.likeness(a[None], b[None])[0] == pytest.approx(share, abs=0.15)


def test_odd_rows(spark, odd, none):
    rows = fp.with_next(odd).collect()
    assert sorted(r.doc_id or 0 for r in rows) == [0, 0, 1, 2, 3, 5, 5, 6, 7, 8]
    found = {r.doc_id: r for r in rows}
    assert (found[1].n_chars, found[1].near_edited) == (0, 1.0)
    # equal texts, whatever their ids
    assert found[5].fingerprint == found[6].fingerprint != found[7].fingerprint
    assert fp.with_next(none).collect() == []
    (alone,) = fp.with_next(odd.where("doc_id = 8")).collect()
    assert alone.near_next == 1.0
    assert len(fp.with_next(odd.where("doc_id is null")).collect()) == 2


def test_totals_take_documents_in_and_out(spark):
    texts = made(9, 30)
    rows = [(i, t, "ab"[i % 2] if i % 5 else None) for i, t in enumerate(texts)]
    schema = "doc_id bigint, text string, source string"
    total = lambda some: {r.key: np.array(r.lanes, np.uint32) for r in fp.totals(spark.createDataFrame(some, schema), "source").collect()}
    every, gone, left = total(rows), total(rows[:10]), total(rows[10:])
    assert set(every) == {"a", "b", None}
    for key in every:
        own = fp.vectors([t for _, t, s in rows if s == key]).sum(axis=0, dtype=np.uint32)
        assert (every[key] == own).all() and (every[key] - gone[key] == left[key]).all()
