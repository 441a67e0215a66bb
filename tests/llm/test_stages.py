"""Which rows the pipeline's stages keep, and long dialogues."""

import random

import corpus_pipeline
import duckdb
import pytest
from oracle import differences
from pyspark.sql import functions as F

from panelcast.llm import chat, common, entities, leaks, quality
from panelcast.llm.oracles import CHAT
from panelcast.llm.queries import op6_chat_perspectives

DOCS = "doc_id bigint, text string, lang string, source string, n_chars bigint"
ODD_NAMES = ("_spans", "spans", "a.b", "_id", "_print", "cell", "bits", "`q`", "verdict.kept", "_n", "_kept")


def words(rng, n, of=5000):
    return " ".join(f"w{rng.randint(0, of)}" for _ in range(n))


def documents(spark, rows):
    return spark.createDataFrame([(i, t, "en", "s", None if t is None else len(t)) for i, t in rows], DOCS)


def odd_columns(df):
    return df.select("*", *(F.lit(f"x{i}").alias(n) for i, n in enumerate(ODD_NAMES)))


# --- near duplicates --------------------------------------------------------------


def test_equal_ids_with_different_texts_lose_nothing(spark):
    a, b = words(random.Random(1), 80), words(random.Random(2), 80)
    docs = documents(spark, [(1, a), (1, b), (3, b)])
    assert {(r.doc_id, r.text) for r in corpus_pipeline.keep_one_of_each(spark, docs, "").collect()} == {(1, a), (1, b)}


def test_one_row_of_each_group_stays(spark):
    rng = random.Random(7)
    base = [words(rng, 60).split() for _ in range(8)]
    rows = []
    for i in range(120):
        own = list(rng.choice(base))
        for _ in range(rng.choice([0, 0, 1, 2, 40])):
            own[rng.randrange(60)] = f"e{rng.randint(0, 9999)}"
        rows.append((rng.randint(0, 90), " ".join(own)))
    rows += [(None, rows[0][1]), (None, rows[0][1]), (None, None), (200, None), (201, ""), (200, None)]
    found = corpus_pipeline.keep_one_of_each(spark, odd_columns(documents(spark, rows)), "")
    assert found.columns[5:] == list(ODD_NAMES)

    def shingles(t):
        w = (t or "").lower().split()
        return frozenset(tuple(w[i : i + 5]) for i in range(len(w) - 4))

    # components of (id, set) nodes: equal ids are no link, equal sets and similar ones are
    nodes = sorted({(i, t) for i, t in rows if i is not None}, key=str)
    root = {n: n for n in nodes}

    def find(n):
        while root[n] != n:
            n = root[n]
        return n

    for x in nodes:
        for y in nodes:
            s, t = shingles(x[1]), shingles(y[1])
            if s and t and 100 * len(s & t) >= 80 * len(s | t):
                root[find(x)] = find(y)
    least = {}
    for n in nodes:
        least[find(n)] = min(least.get(find(n), n[0]), n[0])
    wanted = [n for n in nodes if not shingles(n[1]) or n[0] == least[find(n)]]
    wanted += [(i, t) for i, t in rows if i is None]
    assert sorted(((r.doc_id, r.text) for r in found.collect()), key=str) == sorted(wanted, key=str)


# --- the other stages -------------------------------------------------------------


def test_good_rows_stay(spark):
    rng = random.Random(3)
    rows = [(i, words(rng, 200, 50_000) + ".") for i in range(30)] + [(100 + i, "buy now " * 60) for i in range(10)] + [(200, "short"), (201, None)]
    docs = odd_columns(documents(spark, rows))
    kept = corpus_pipeline.keep_good(spark, docs, "")
    judged = {r.doc_id for r in quality.judged(docs, "text", "new_verdict").where("new_verdict.kept").collect()}
    assert kept.columns == docs.columns and {r.doc_id for r in kept.collect()} == judged == set(range(30))


def test_redaction_keeps_all_rows_and_columns(spark):
    text = "mail a.b@c.de or call +1 (505) 555-0351"
    docs = odd_columns(documents(spark, [(1, text), (1, text), (2, None), (None, "plain")]))
    out = corpus_pipeline.redact(spark, docs, "")
    assert out.columns == docs.columns
    rows = sorted(out.collect(), key=lambda r: (r.doc_id or 0, r.text or ""))
    assert [r.text for r in rows] == ["plain", "mail <EMAIL> or call <PHONE>", "mail <EMAIL> or call <PHONE>", None]
    assert [r.n_chars for r in rows] == [5, 28, 28, None] and {r["_spans"] for r in rows} == {"x0"} and {r["a.b"] for r in rows} == {"x2"}
    assert entities.annotated(docs, "_spans_").columns[-1] == "_spans_"


def test_leaks_go_and_odd_columns_stay(spark, tmp_path):
    rng = random.Random(5)
    item = words(rng, 40)
    spark.createDataFrame([(1, item)], "item_id bigint, text string").write.parquet(f"{tmp_path}/benchmark.parquet")
    clean = [(i, words(rng, 100, 10**6)) for i in range(20)]
    docs = odd_columns(documents(spark, [*clean, (50, f"so {item} it"), (51, None), (None, item), (50, "another text of this id")]))
    kept = corpus_pipeline.drop_leaks(spark, docs, str(tmp_path))
    assert kept.columns == docs.columns
    assert sorted((r.doc_id, r.text or "") for r in kept.collect()) == sorted([*clean, (51, ""), (50, "another text of this id")])


@pytest.mark.parametrize("cells", [1, 1 << 18])
def test_parted_rows_are_all_there(spark, monkeypatch, cells):
    monkeypatch.setattr(common, "CELLS", cells)
    rows = spark.range(3000).select("id", F.xxhash64("id").alias("key"))
    few, others = common.parted(rows, F.col("key"), rows.where("id % 100 = 0").select("key"))
    first, rest = ({r.id for r in part.collect()} for part in (few, others))
    assert first | rest == set(range(3000)) and not first & rest and set(range(0, 3000, 100)) <= first
    assert cells == 1 or len(first) < 60
    none, every = common.parted(rows, F.col("key"), rows.limit(0).select("key"))
    assert none.count() == 0 and every.count() == 3000


# --- leaks against alignment of everything ---------------------------------------


def plain_score(a, b):
    best, row = 0, [0] * (len(b) + 1)
    for x in a:
        new = [0]
        for j, y in enumerate(b):
            new.append(max(0, row[j] + (leaks.MATCH if x == y else leaks.MISMATCH), row[j + 1] + leaks.GAP, new[j] + leaks.GAP))
        row = new
        best = max(best, *row)
    return best


@pytest.mark.parametrize("rare", [leaks.RARE, 0])
def test_matches_by_alignment_of_everything(spark, monkeypatch, rare):
    monkeypatch.setattr(leaks, "RARE", rare)
    rng = random.Random(rare)
    shared = words(rng, 4).split()
    items = [shared + words(rng, rng.randint(0, 46)).split() for _ in range(12)] + [["one"], ["two", "words"], words(rng, 3).split()]
    texts = []
    for _ in range(180):
        body = words(rng, rng.randint(0, 60)).split()
        if rng.random() < 0.7:
            own = list(rng.choice(items))
            for _ in range(rng.randint(0, len(own) // 2)):
                k = rng.randrange(len(own)) if own else 0
                own[k : k + 1] = rng.choice([[], ["new"], [own[k], "more"]]) if own else []
            at = rng.randint(0, len(body))
            body[at:at] = own
        texts.append(body)
    tests = spark.createDataFrame([(i, " ".join(w)) for i, w in enumerate(items)], "item_id bigint, text string")
    docs = spark.createDataFrame([(i, ", ".join(w)) for i, w in enumerate(texts)], "doc_id bigint, text string")
    found = {(r.doc_id, r.item_id): r.score for r in leaks.matches(docs, tests).collect()}
    pieces = [tuple(w) for w in items]
    runs = [{w[i : i + min(3, len(w))] for i in range(len(w) - min(3, len(w)) + 1)} for w in pieces]
    wanted = {}
    for d, text in enumerate(texts):
        for i, item in enumerate(pieces):
            n = min(3, len(item))
            own = {tuple(text[k : k + n]) for k in range(len(text) - n + 1)} & runs[i]
            score = plain_score(item, text) / (leaks.MATCH * len(item))
            if score >= leaks.LEAST and (len(own) > 1 or own and (rare or len(runs[i]) == 1)):
                wanted[d, i] = min(1.0, score)
    assert found == pytest.approx(wanted) and len(found) > 60


def test_common_runs_pair_no_texts_with_all_items(spark):
    """500 items and 2,000 texts that share a phrase: no candidate has to be looked at."""
    rng = random.Random(1)
    tests = spark.createDataFrame([(i, f"one of the {words(rng, 30, 10**6)}") for i in range(500)], "item_id bigint, text string")
    docs = spark.createDataFrame([(i, " ".join(f"one of the {words(rng, 9, 10**6)}" for _ in range(10))) for i in range(2000)], "doc_id bigint, text string")
    pieces = tests.select(F.lower("text").alias("text"), "item_id").mapInArrow(leaks._pieces, leaks.PIECES).withColumn("piece", F.xxhash64("words"))
    assert leaks.seeds(pieces.select("piece", "words")).where("sharers > 32").count() == 0
    assert leaks.matches(docs, tests).collect() == []


# --- dialogues --------------------------------------------------------------------


def dialogue(n, conv=1, system=(0,)):
    return [(conv, i, "system" if i in system else ("ann", "bob")[i % 2], f"turn {i} é") for i in range(n)]


@pytest.mark.parametrize("system", [(0,), (), (0, 1, 70), (64,), (129,)])
def test_every_participant_gets_every_piece(spark, system):
    kind = "conv_id bigint, turn bigint, role string, text string"
    rows = dialogue(130, 1, system) + dialogue(3, 2) + [(3, i, "eve" if i == 100 else "ann", str(i)) for i in range(101)]
    turns = spark.createDataFrame(rows, kind).repartition(5)
    found = chat.perspectives(turns)
    pieces = {}
    for r in found.collect():
        pieces.setdefault((r.conv_id, r.speaker), {})[r.example] = r
        assert r.n_turns <= chat.TURNS
    assert {k: sorted(v) for k, v in pieces.items()} == {(1, "ann"): [0, 1, 2], (1, "bob"): [0, 1, 2], (2, "bob"): [0], (2, "ann"): [0], (3, "ann"): [0, 1], (3, "eve"): [0, 1]}
    for (conv, speaker), own in pieces.items():
        whole = "\n".join(own[k].rendered[own[k].carried :] for k in sorted(own))
        said = [(r, t) for c, _, r, t in sorted(rows) if c == conv]
        heads = {"system": "<|system|>", speaker: "<|assistant|>"}
        assert whole == "\n".join(f"{heads.get(r, f'<|user name={r}|>')}\n{t}<|end|>" for r, t in said)
        learned = [own[k].rendered[s.start : s.end] for k in sorted(own) for s in own[k].mask]
        assert learned == [f"{t}<|end|>" for r, t in said if r == speaker]
        for k in own:
            before = [t for i, (r, t) in enumerate(said) if r == "system" and i < k * chat.TURNS]
            begins = said[k * chat.TURNS][0] == "system"
            assert own[k].rendered[: own[k].carried] == (f"<|system|>\n{before[-1]}<|end|>\n" if before and not begins else "")


def test_long_dialogues_equal_their_sql(spark, tmp_path):
    kind = "conv_id bigint, turn bigint, role string, text string"
    rows = dialogue(200, 1, (0, 90, 128)) + dialogue(64, None, (3,)) + dialogue(65, 4, ()) + [(5, i, None, None) for i in range(70)]
    spark.createDataFrame(rows, kind).write.parquet(f"{tmp_path}/conversations.parquet")
    con = duckdb.connect()
    con.execute(f"CREATE VIEW conversations AS SELECT * FROM '{tmp_path}/conversations.parquet/*.parquet'")
    assert differences(op6_chat_perspectives(spark, str(tmp_path)), con, CHAT) == []
