"""Quality rules by weak supervision: rules vote or abstain, and their accuracies are estimated.

Each rule looks at counts of a text and votes good (1), bad (-1) or abstains (0); most know one kind
of bad text and abstain on the rest. A model with
two classes says how often each rule votes which way on good and on bad texts. Expectation
maximisation fits it without labels, on the number of texts with each combination of votes: at
most 3^rules rows, whatever the corpus, so the iterations run on the driver over that table. The
posterior probability of the good class replaces the demand that every rule be passed.

All counts come from built-in functions of the text's own row; nothing is shuffled but one
partial count per combination of votes.

Edge cases: a null or empty text has no words; all its counts are 0, and it fails the base rules
(fewer than 50 words). Equal texts get equal votes. No rows give no rows. Other columns stay.
"""

from __future__ import annotations

import math
from collections.abc import Mapping

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import BLANKS, LOWER, UPPER, WORD, stored, unused, whole

SYMBOLS = "#*$%&|<>"
MIN_WORDS = 50
ROUNDS = 25
COUNTS = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "n_lines", "n_capitals", "n_marks", "n_shorts")


def _without(text: Column, letters: str) -> Column:
    return F.length(F.translate(text, letters, ""))


def counts(df: DataFrame, text: str, into: str) -> DataFrame:
    """``df`` with a struct column ``into`` of the counts named in ``COUNTS``."""
    names = {n: unused(df, n) for n in ("w_", "l_", "t_", "s_")}
    w, lines, hashes, s = (F.col(n) for n in names.values())
    body = whole(F.col(text))
    df = df.select(
        "*", F.regexp_extract_all(body, F.lit(WORD), F.lit(0)).alias(names["w_"]),
        F.filter(F.split(body, "\n", -1), lambda x: _without(x, BLANKS) > 0).alias(names["l_"]),
    )
    three = F.when(F.size(w) < 3, F.array().cast("array<struct<h:bigint,i:int>>")).otherwise(
        F.transform(
            F.sequence(F.lit(0), F.size(w) - 3),
            lambda i: F.struct(F.xxhash64(F.get(w, i), F.get(w, i + 1), F.get(w, i + 2)).alias("h"), i.alias("i")),
        )
    )
    df = df.select("*", three.alias(names["t_"]))
    df = df.select(
        "*",
        F.when(F.size(F.array_distinct(hashes["h"])) == F.size(hashes), F.slice(hashes, 1, 0)).otherwise(F.sort_array(hashes)).alias(names["s_"]),
    )  # windows found twice stand side by side
    twice = F.filter(s, lambda x, j: (F.get(s, j - 1)["h"] == x["h"]) | (F.get(s, j + 1)["h"] == x["h"]))
    starts = F.sort_array(F.transform(twice, lambda x: x["i"]))
    covered = F.aggregate(
        starts,
        F.struct(F.lit(0).alias("n"), F.lit(0).alias("end")),
        lambda a, i: F.struct((a["n"] + i + 3 - F.greatest(a["end"], i)).alias("n"), (i + 3).alias("end")),
    )["n"]
    n = F.length(body)
    found = {
        "n_words": F.size(w),
        "word_chars": _without(body, BLANKS),
        "n_symbols": n - _without(body, SYMBOLS),
        "n_dup_lines": F.size(lines) - F.size(F.array_distinct(lines)),
        "n_repeat_words": covered,
        "n_lines": F.size(lines),
        "n_capitals": n - _without(body, UPPER),
        "n_marks": n - _without(body, "!"),
        "n_shorts": n - _without(body, LOWER),
    }
    struct = F.struct(*(found[k].cast("bigint").alias(k) for k in COUNTS))
    return df.select("*", struct.alias(into)).drop(*names.values())


def votes(c: Column) -> dict[str, Column]:
    """Each rule's vote, from the counts."""
    n = c["n_words"]

    def bad(found: Column) -> Column:
        return F.when(found, -1).otherwise(0)

    return {
        "length": bad(n < 20),
        "word_length": bad((c["word_chars"] < 2 * n) | (c["word_chars"] > 12 * n)),
        "symbols": F.when(5 * c["n_symbols"] > n, -1).when(50 * c["n_symbols"] <= n, 1).otherwise(0),
        "lines": bad(10 * c["n_dup_lines"] > 3 * c["n_lines"]),
        "repeats": bad(10 * c["n_repeat_words"] > 3 * n),
        "capitals": bad(c["n_capitals"] > c["n_shorts"]),
        "marks": bad(10 * c["n_marks"] > n),
        "prose": F.when(
            (n >= MIN_WORDS) & (50 * c["n_symbols"] <= n) & (5 * c["n_repeat_words"] <= n) & (5 * c["n_dup_lines"] <= c["n_lines"])
            & (5 * c["n_capitals"] <= c["n_shorts"]) & (50 * c["n_marks"] <= n), 1,
        ).otherwise(0),
    }


def fit(patterns: list[tuple[tuple[int, ...], int]], rounds: int = ROUNDS) -> dict[tuple[int, ...], float]:
    """Posterior of the good class for each combination of votes, from (votes, texts)."""
    if not patterns:
        return {}
    patterns = sorted(patterns)
    rules = range(len(patterns[0][0]))
    good = [1.0 if sum(v) > 0 else 0.5 if sum(v) == 0 else 0.0 for v, _ in patterns]
    for _ in range(rounds):
        log_odds = []
        mass = [sum(n * (1 - p) for (_, n), p in zip(patterns, good)), sum(n * p for (_, n), p in zip(patterns, good))]
        rate = {}
        for r in rules:
            for y in (0, 1):
                for value in (-1, 0, 1):
                    hit = sum(n * (p if y else 1 - p) for (v, n), p in zip(patterns, good) if v[r] == value)
                    rate[r, y, value] = (hit + 1) / (mass[y] + 3)
        prior = math.log((mass[1] + 1) / (mass[0] + 1))
        for v, _ in patterns:
            # an abstention says nothing about the text
            log_odds.append(prior + sum(math.log(rate[r, 1, v[r]] / rate[r, 0, v[r]]) for r in rules if v[r]))
        good = [1 / (1 + math.exp(-min(500.0, max(-500.0, x)))) for x in log_odds]
    return {v: p for (v, _), p in zip(patterns, good)}


def base_failed(c: Column) -> Column:
    return (c["n_words"] < MIN_WORDS) | (100 * c["n_repeat_words"] > 50 * c["n_words"])


def judged(df: DataFrame, text: str, into: str, rounds: int = ROUNDS, carry_text: bool = True) -> DataFrame:
    """The rows of ``df`` (without the text unless ``carry_text``), with a struct ``into``: the counts, ``base_failed``, ``posterior``, ``kept``.

    The rows are written once, with their counts, and the verdict is a look-up of their votes.
    """
    c, code = unused(df, into), unused(df, f"{into}_votes")
    rows = counts(df, text, c)
    every = votes(F.col(c))
    ballot = F.concat_ws(",", *(v.cast("string") for v in every.values()))
    rows = rows.withColumn(code, ballot)
    rows = stored(rows if carry_text else rows.drop(text), "quality")
    tally = rows.groupBy(code).agg(F.count("*").alias("n")).collect()  # at most 3^rules rows
    found = fit([(tuple(map(int, r[code].split(","))), r["n"]) for r in tally], rounds)
    return rows.withColumn(c, _verdict(F.col(c), F.col(code), found)).drop(code)


def _verdict(c: Column, code: Column, found: Mapping[tuple[int, ...], float]) -> Column:
    pairs = [F.lit(x) for v, p in found.items() for x in (",".join(map(str, v)), p)]
    posterior = F.element_at(F.create_map(*pairs), code) if pairs else F.lit(0.0)
    failed = base_failed(c)
    return F.struct(
        *(c[k].alias(k) for k in COUNTS), failed.alias("base_failed"), posterior.alias("posterior"),
        (~failed & (posterior >= 0.5)).alias("kept"),
    )
