"""Odd rows and empty tables through every operator and stage."""

import corpus_pipeline
import pytest
from pyspark.sql import functions as F

from panelcast.llm import chat, classifier, entities, leaks, mixing, neardup, quality, repeats, secrets, urls

ITEMS = "item_id bigint, text string"


@pytest.fixture(scope="module")
def items(spark):
    words = " ".join(f"word{i % 997}x{i}" for i in range(500, 540))
    return spark.createDataFrame([(1, None), (2, ""), (3, words), (3, words), (None, "tiny test")], ITEMS)


@pytest.fixture(scope="module")
def labels(spark):
    return spark.createDataFrame([(2, 0, None), (5, 1, 0), (None, 1, 1), (77, None, 0)], "doc_id bigint, quality int, toxic int")


def every(docs, items, labels):
    return {
        "secrets": lambda: secrets.scan(docs),
        "classifier": lambda: classifier.quality_scores(docs, labels),
        "repeats": lambda: repeats.without_repeats(docs),
        "mixing": lambda: mixing.mix(docs),
        "neardup": lambda: neardup.near_duplicates(docs),
        "entities": lambda: entities.annotated(docs, "new_spans"),
        "quality": lambda: quality.judged(docs, "text", "new_verdict"),
    }


@pytest.mark.parametrize("name", ["secrets", "classifier", "repeats", "mixing", "neardup", "entities", "quality"])
def test_one_row_per_row(odd, none, items, labels, name):
    rows = every(odd, items, labels)[name]().collect()
    assert sorted(r.doc_id or 0 for r in rows) == [0, 0, 1, 2, 3, 5, 5, 6, 7, 8]
    assert every(none, items, labels)[name]().collect() == []


def test_texts_without_bytes(odd, labels):
    gone = {r.doc_id: r for r in repeats.without_repeats(odd).collect()}
    assert (gone[1].n_bytes, gone[1].removed) == (0, [])
    # a text repeated inside itself and in other rows goes as a whole
    assert [(s.a, s.b) for s in gone[5].removed] == [(0, gone[5].n_bytes)]
    assert gone[7].removed == []
    same = {r.doc_id: r for r in neardup.near_duplicates(odd).collect()}
    assert (same[1].n_shingles, same[1].component_id, same[1].kept) == (0, 1, True)
    assert (same[6].component_id, same[6].kept) == (5, False)
    assert (same[None].component_id, same[None].kept) == (None, True)
    score = {r.doc_id: r.score for r in classifier.quality_scores(odd, labels).collect()}
    assert score[1] == score[2] and all(0 <= s <= 1 for s in score.values())


def test_added_mention(spark, odd):
    text = "call +1 (505) 555-0351 now, or 505-555-0351 later; not 123-456-9999 "
    many = spark.createDataFrame([(i, text) for i in range(40)] + [(99, "plain words only")], "doc_id bigint, text string")
    found = {r.doc_id: r.spans for r in entities.annotated(many, "spans").collect()}
    assert [(s.kind, s.base) for s in found[0]] == [("phone", True), ("phone", False)]
    assert text[found[0][1].start : found[0][1].end] == "505-555-0351"
    assert found[99] == []
    assert entities.redacted(many).where("doc_id = 0").first().text == "call <PHONE> now, or <PHONE> later; not 123-456-9999 "


@pytest.mark.parametrize("lookalikes", [0, 300])
def test_added_mentions_however_many(spark, lookalikes):
    bare = [1, 2, 10, 50]
    far = " and then some plain words "
    rows = [(k, "call +1 (505) 555-0351" + (far + "505-555-0351") * k) for k in bare] + [(100 + k, ("505-555-0351" + far) * k + "is +1 (505) 555-0351") for k in bare]
    rows += [(1000 + i, f"part {200 + i}-555-{1000 + i} of the list") for i in range(lookalikes)]
    found = {r.doc_id: r.spans for r in entities.annotated(spark.createDataFrame(rows, "doc_id bigint, text string"), "spans").collect()}
    assert {i: sum(not s.base for s in spans) for i, spans in found.items() if i < 1000} == {**{k: k for k in bare}, **{100 + k: k for k in bare}}
    assert all(found[1000 + i] == [] for i in range(lookalikes))


def test_leaks(odd, none, items):
    found = leaks.matches(odd, items)
    assert [(r.doc_id, r.item_id, r.score, r.first_word, r.last_word) for r in found.collect()] == [(7, 3, 1.0, 500, 539)]
    kept = leaks.without_leaks(odd, found)
    assert kept.columns == odd.columns and kept.count() == 9
    assert leaks.matches(none, items).collect() == []
    assert leaks.matches(odd, items.limit(0)).collect() == []


def test_edited_leak(spark, items):
    words = [f"word{i % 997}x{i}" for i in range(500, 540)]
    edited = [w for i, w in enumerate(words) if i % 9] + ["and", "more"]
    edited[10] = "changed"
    docs = spark.createDataFrame([(1, "before it, " + " ".join(edited).upper()), (2, " ".join(reversed(words)))], "doc_id bigint, text string")
    (row,) = leaks.matches(docs, items).collect()
    assert (row.doc_id, row.item_id) == (1, 3) and 0.5 <= row.score < 1


def test_edited_leak_beside_other_copies(spark):
    words = [f"w{i}" for i in range(50)]
    tests = spark.createDataFrame([(1, " ".join(words))], ITEMS)
    edited = {k: " ".join(f"new{k}x{i}" if i % k == 0 else w for i, w in enumerate(words)) for k in (4, 5, 6)}
    rows = [(0, " ".join(words)), *edited.items()]
    found = {r.doc_id: r.score for r in leaks.matches(spark.createDataFrame(rows, "doc_id bigint, text string"), tests).collect()}
    assert set(found) == {0, 4, 5, 6} and found[0] == 1 and 0.5 < found[4] < found[5] < found[6] < 1
    rows += [(10 + i, f"{edited[5]} tail{i}") for i in range(1000)]
    assert leaks.matches(spark.createDataFrame(rows, "doc_id bigint, text string"), tests).count() == 1004


def test_leak_across_a_cut_of_a_long_item(spark):
    words = [f"w{i}" for i in range(200)]
    tests = spark.createDataFrame([(1, " ".join(words)), (2, " ".join(f"v{i}" for i in range(128)))], ITEMS)
    begins = [0, 16, 34, 64, 98, 130, 140]
    rows = [(a, "before it " + " ".join(words[a : a + 60]) + " and after") for a in begins]
    edited = [f"new{i}" if i % 5 == 0 else w for i, w in enumerate(words)]
    rows += [(1000 + a, " ".join(edited[a : a + 64])) for a in begins[:-1]]
    rows += [(3000, " ".join(f"v{i}" for i in range(33, 95))), (4000, " ".join(words)), (5000, " ".join(words[90:120]))]
    found = {r.doc_id: r for r in leaks.matches(spark.createDataFrame(rows, "doc_id bigint, text string"), tests).collect()}
    assert set(found) == {*begins, *(1000 + a for a in begins[:-1]), 3000, 4000}
    assert [(found[a].score, found[a].first_word, found[a].last_word) for a in begins] == [(60 / 64, 2, 61)] * len(begins)
    assert (found[3000].item_id, found[3000].score, found[4000].score) == (2, 62 / 64, 1)


def test_leak_in_capitals_of_any_alphabet(spark):
    words = " ".join(f"é{chr(0x430 + i)}ñ{i}" for i in range(20))
    tests = spark.createDataFrame([(1, words)], ITEMS)
    docs = spark.createDataFrame([(1, "X! " + words.upper() + " Y"), (2, "é")], "doc_id bigint, text string")
    assert [(r.doc_id, r.score) for r in leaks.matches(docs, tests).collect()] == [(1, 1.0)]


def test_chat(spark):
    kind = "conv_id bigint, turn bigint, role string, text string, speaker string"
    rows = [(1, 0, "system", "be kind", "x"), (1, 1, "ann", "hi <|end|>", "x"), (1, 1, "ann", "hi <|end|>", "x"), (1, 2, "bob", None, "x"), (1, None, None, "?", "x"), (None, 0, "eve", "é", "x"), (3, 0, "system", "only", "x")]
    found = {(r.conv_id, r.speaker): r for r in chat.perspectives(spark.createDataFrame(rows, kind)).collect()}
    assert set(found) == {(1, "ann"), (1, "bob"), (1, "unknown"), (None, "eve")}
    ann = found[1, "ann"]
    assert [ann.rendered[s.start : s.end] for s in ann.mask] == ["hi <\\|end|><|end|>"] * 2
    assert ann.rendered.startswith("<|user name=unknown|>\n?<|end|>\n<|system|>\nbe kind<|end|>\n<|assistant|>\n")
    many = spark.createDataFrame([(1, i, "ab"[i % 2], str(i), "x") for i in range(1000)], kind)
    assert chat.perspectives(many).count() == 2 * 16
    assert chat.perspectives(many.limit(0)).collect() == []


def test_urls(spark):
    pages = spark.createDataFrame([(1, None), (1, "no scheme"), (2, "HTTP://A.B.Org"), (2, "http://a.b.org/x?utm_a=1&z=2#f"), (3, "http://www.bad.net/p/?ref=1"), (3, "http://bad.net/p"), (4, "://"), (None, "http://x.org/")], "page_id bigint, url string")
    rules = spark.createDataFrame([("org", "/", "allow"), ("b.org", "/x", "block")], "host string, path string, verdict string")
    listed = pages.where("url = 'http://bad.net/p'").select(urls.canonical(F.col("url")).alias("url"))
    found = sorted((r.page_id or 0, r.host, r.path, r.rule or "", r.verdict) for r in urls.judge(pages, "page_id", "url", rules, listed).collect())
    assert found == [
        (0, "x.org", "/", "org/", "allow"), (1, "", "", "", "allow"), (1, "", "", "", "allow"), (2, "a.b.org", "", "", "allow"),
        (2, "a.b.org", "/x", "b.org/x", "block"), (3, "bad.net", "/p", "", "block"), (3, "www.bad.net", "/p/", "", "block"), (4, "", "", "", "allow"),
    ]
    assert {r.verdict for r in urls.judge(pages, "page_id", "url", rules.limit(0), listed.limit(0)).collect()} == {"allow"}
    assert urls.judge(pages.limit(0), "page_id", "url", rules, listed).collect() == []


def test_stages(spark, odd, none, tmp_path, items):
    items.write.parquet(f"{tmp_path}/benchmark.parquet")
    for docs in (odd, none):
        rows = docs
        for name, stage in corpus_pipeline.STAGES:
            # each stage on all the odd rows as well as on what is left
            stage(spark, docs, str(tmp_path)).collect()
            rows = stage(spark, rows, str(tmp_path))
            if name != "source_mix":
                assert rows.columns == docs.columns
            rows = corpus_pipeline.stored(rows, name)
    one = corpus_pipeline.keep_one_of_each(spark, odd, "").select("doc_id").collect()
    assert sorted(r.doc_id or 0 for r in one) == [0, 0, 1, 2, 3, 5, 7, 8]
