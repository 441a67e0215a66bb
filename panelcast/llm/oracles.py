"""DuckDB SQL for the queries that SQL can express."""

from __future__ import annotations

from .phrases import LEAST, LONGEST, TOP
from .quality import COUNTS, ROUNDS
from .queries import URL_RULES
from .secrets import BASE_RULES, MORE_RULES

WORD = r"[^\x20\x09-\x0D]+"
BLANKS = "chr(32) || chr(9) || chr(10) || chr(11) || chr(12) || chr(13)"


def _quote(text: str) -> str:
    return "'" + text.replace("'", "''") + "'"


def _secrets() -> str:
    """Matches, and the texts between them, numbered alike; a running sum of lengths gives offsets."""
    parts = []
    for i, r in enumerate(BASE_RULES + MORE_RULES):
        pattern = _quote(r.pattern)
        parts.append(f"""
            SELECT doc_id, {i} AS place, '{r.kind}' AS kind,
                unnest(regexp_extract_all(body, {pattern})) AS m,
                unnest(regexp_extract_all(body, {pattern}, {r.group})) AS v,
                unnest(list_slice(string_split_regex(body, {pattern}), 1, len(regexp_extract_all(body, {pattern})))) AS gap,
                unnest(range(len(regexp_extract_all(body, {pattern})))) AS k
            FROM docs""")
    least = " ".join(f"WHEN '{r.kind}' THEN {r.least}" for r in BASE_RULES + MORE_RULES)
    kinds = ", ".join(f"'{r.kind}'" for r in BASE_RULES)
    counts = ", ".join(f"count(*) FILTER (kind = '{r.kind}') AS n_{r.kind}" for r in BASE_RULES)
    return f"""
        WITH docs AS (SELECT doc_id, coalesce(text, '') AS body FROM documents),
        found AS ({" UNION ALL ".join(parts)}),
        placed AS (
            SELECT *, sum(length(gap) + length(m)) OVER (PARTITION BY doc_id, place ORDER BY k) AS stop FROM found
        ),
        spans AS (
            SELECT doc_id, kind, place, stop - length(m) AS start,
                kind || ':' || CAST(stop - length(m) AS BIGINT) || ':' || CAST(stop AS BIGINT) AS span
            FROM placed WHERE length(v) >= CASE kind {least} END
        ),
        per AS (
            SELECT doc_id, {counts},
                string_agg(span, ',' ORDER BY start, place) FILTER (kind IN ({kinds})) AS base,
                string_agg(span, ',' ORDER BY start, place) AS spans
            FROM spans GROUP BY doc_id
        )
        SELECT doc_id, {", ".join(f"coalesce(n_{r.kind}, 0) AS n_{r.kind}" for r in BASE_RULES)},
            sha256(coalesce(base, '')) AS base_sha256, coalesce(spans, '') AS spans
        FROM docs LEFT JOIN per USING (doc_id)"""


MIX = rf"""
    WITH sized AS (
        SELECT doc_id, source, len(regexp_extract_all(coalesce(text, ''), '{WORD}')) AS size,
            md5(coalesce(CAST(doc_id AS VARCHAR), '')) AS rank
        FROM documents
    ),
    per AS (
        SELECT source, CAST(sum(size) AS BIGINT) AS source_size,
            row_number() OVER (ORDER BY source ASC NULLS LAST) - 1 AS place
        FROM sized GROUP BY source
    ),
    weighed AS (
        SELECT *, CAST([5, 2, 1][place % 3 + 1] AS DOUBLE) AS weight, CAST([0.5, 1.0, 1.5][place % 3 + 1] AS DOUBLE) AS early,
            CAST(2 AS DOUBLE) * source_size AS cap
        FROM per
    ),
    filled AS (
        SELECT *, (CAST(1.5 AS DOUBLE) * sum(source_size) OVER () - coalesce(sum(cap) OVER before, 0))
                / (sum(weight) OVER () - coalesce(sum(weight) OVER before, 0)) AS level
        FROM weighed
        WINDOW before AS (ORDER BY cap / weight, source ASC NULLS LAST ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)
    ),
    level AS (SELECT level FROM filled WHERE level * weight <= cap ORDER BY cap / weight, place LIMIT 1),
    goal AS (
        SELECT source, source_size, early, least(cap, coalesce((SELECT level FROM level) * weight, cap)) AS target FROM filled
    ),
    placed AS (
        SELECT doc_id, source, size, coalesce(sum(size) OVER (
            PARTITION BY source ORDER BY rank, doc_id, size ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS start
        FROM sized
    ),
    taken AS (
        SELECT doc_id, size, source_size, target, early, start,
            greatest(0, least(size, CAST(round_even(target, 0) AS BIGINT) - start)) AS once,
            greatest(0, least(size, CAST(round_even(target, 0) AS BIGINT) - start - source_size)) AS again
        FROM placed JOIN goal ON placed.source IS NOT DISTINCT FROM goal.source
    )
    SELECT doc_id, CAST(size AS BIGINT) AS size, source_size, target, CAST(once + again AS BIGINT) AS taken,
        CASE WHEN once > 0 THEN
            CASE WHEN early = 1 THEN start / target
            ELSE (sqrt(early * early + (CAST(1 AS DOUBLE) - early) * 2 * 2 * (start / target)) - early) / ((CAST(1 AS DOUBLE) - early) * 2) END
        END AS position
    FROM taken"""


CHAT = r"""
    WITH safe AS (
        SELECT conv_id, turn, replace(coalesce(role, 'unknown'), '<|', '<\|') AS role, replace(coalesce(text, ''), '<|', '<\|') AS text
        FROM conversations
    ),
    placed AS (
        SELECT conv_id, role, text, row_number() OVER (
            PARTITION BY conv_id ORDER BY turn NULLS FIRST, role, text) - 1 AS place FROM safe
    ),
    cut AS (SELECT *, CAST(place // 64 AS BIGINT) AS example FROM placed),
    headings AS (
        SELECT b.conv_id, 'system' AS role, arg_max(c.text, c.place) AS text, b.place - 1 AS place, b.example, TRUE AS headed
        FROM cut b JOIN cut c ON b.conv_id IS NOT DISTINCT FROM c.conv_id AND c.place < b.place AND c.role = 'system'
        WHERE b.place % 64 = 0 AND b.role <> 'system' GROUP BY b.conv_id, b.place, b.example
    ),
    every AS (SELECT conv_id, role, text, place, example, FALSE AS headed FROM cut UNION ALL SELECT * FROM headings),
    speakers AS (SELECT DISTINCT conv_id, role AS speaker FROM cut WHERE role <> 'system'),
    pieces AS (
        SELECT s.conv_id, c.example, s.speaker, c.place, c.headed, c.role = s.speaker AS own,
            CASE WHEN c.role = s.speaker THEN '<|assistant|>' WHEN c.role = 'system' THEN '<|system|>'
                ELSE '<|user name=' || c.role || '|>' END || chr(10) AS head,
            c.text || '<|end|>' AS body
        FROM speakers s JOIN every c ON s.conv_id IS NOT DISTINCT FROM c.conv_id
    ),
    walked AS (
        SELECT *, CAST(sum(length(head) + length(body) + 1) OVER (PARTITION BY conv_id, example, speaker ORDER BY place) AS BIGINT) - 1 AS stop
        FROM pieces
    )
    SELECT conv_id, example, speaker, CAST(count(*) FILTER (NOT headed) AS INTEGER) AS n_turns,
        CAST(coalesce(max(stop + 1) FILTER (headed), 0) AS INTEGER) AS carried,
        string_agg(head || body, chr(10) ORDER BY place) AS rendered,
        coalesce(string_agg(CAST(stop - length(body) AS VARCHAR) || ':' || CAST(stop AS VARCHAR), ',' ORDER BY place) FILTER (own), '') AS mask
    FROM walked GROUP BY conv_id, example, speaker"""


def _quality() -> str:
    """Counts, votes, and the iterations, one materialised step after the other."""
    n_of = {
        "word_chars": f"length(translate(body, {BLANKS}, ''))",
        "n_symbols": "length(body) - length(translate(body, '#*$%&|<>', ''))",
        "n_capitals": "length(body) - length(translate(body, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', ''))",
        "n_marks": "length(body) - length(translate(body, '!', ''))",
        "n_shorts": "length(body) - length(translate(body, 'abcdefghijklmnopqrstuvwxyz', ''))",
    }
    rules = {
        "length": "CASE WHEN n_words < 20 THEN -1 ELSE 0 END",
        "word_length": "CASE WHEN word_chars < 2 * n_words OR word_chars > 12 * n_words THEN -1 ELSE 0 END",
        "symbols": "CASE WHEN 5 * n_symbols > n_words THEN -1 WHEN 50 * n_symbols <= n_words THEN 1 ELSE 0 END",
        "lines": "CASE WHEN 10 * n_dup_lines > 3 * n_lines THEN -1 ELSE 0 END",
        "repeats": "CASE WHEN 10 * n_repeat_words > 3 * n_words THEN -1 ELSE 0 END",
        "capitals": "CASE WHEN n_capitals > n_shorts THEN -1 ELSE 0 END",
        "marks": "CASE WHEN 10 * n_marks > n_words THEN -1 ELSE 0 END",
        "prose": """CASE WHEN n_words >= 50 AND 50 * n_symbols <= n_words AND 5 * n_repeat_words <= n_words
            AND 5 * n_dup_lines <= n_lines AND 5 * n_capitals <= n_shorts AND 50 * n_marks <= n_words THEN 1 ELSE 0 END""",
    }
    names = list(rules)
    steps = [f"""p0 AS MATERIALIZED (SELECT *, CASE WHEN {" + ".join(names)} > 0 THEN 1.0 WHEN {" + ".join(names)} = 0 THEN 0.5 ELSE 0.0 END::DOUBLE AS good FROM tally)"""]
    for k in range(1, ROUNDS + 1):
        odds = " + ".join(
            f"CASE WHEN {r} = 0 THEN 0 ELSE ln(((SELECT sum(n * good) FROM p{k - 1} q WHERE q.{r} = p.{r}) + 1) / (bright + 3)"
            f" / (((SELECT sum(n * (1 - good)) FROM p{k - 1} q WHERE q.{r} = p.{r}) + 1) / (dark + 3))) END"
            for r in names
        )
        steps.append(f"m{k} AS MATERIALIZED (SELECT sum(n * good) AS bright, sum(n * (1 - good)) AS dark FROM p{k - 1})")
        steps.append(f"""p{k} AS MATERIALIZED (SELECT {", ".join(names)}, n,
            1 / (1 + exp(-greatest(-500, least(500, ln((bright + 1) / (dark + 1)) + {odds})))) AS good FROM p{k - 1} p, m{k})""")
    counts = [c for c in COUNTS if c in n_of]
    return rf"""
    WITH docs AS (
        SELECT row_number() OVER () AS r, doc_id, coalesce(text, '') AS body FROM documents
    ),
    split AS (
        SELECT *, regexp_extract_all(body, '{WORD}') AS w,
            list_filter(string_split(body, chr(10)), lambda x: regexp_matches(x, '[^\x20\x09-\x0D]')) AS l
        FROM docs
    ),
    three AS (
        SELECT r, i, md5(w[i] || ' ' || w[i + 1] || ' ' || w[i + 2]) AS h
        FROM (SELECT r, w, unnest(range(1, len(w) - 1)) AS i FROM split)
    ),
    twice AS (
        SELECT DISTINCT r, i + k AS at
        FROM (SELECT r, i, count(*) OVER (PARTITION BY r, h) AS c FROM three), (SELECT unnest([0, 1, 2]) AS k) WHERE c > 1
    ),
    repeats AS (SELECT r, count(*) AS n_repeat_words FROM twice GROUP BY r),
    counted AS MATERIALIZED (
        SELECT doc_id, CAST(len(w) AS BIGINT) AS n_words, CAST(len(l) AS BIGINT) AS n_lines,
            CAST(len(l) - len(list_distinct(l)) AS BIGINT) AS n_dup_lines,
            coalesce(n_repeat_words, 0) AS n_repeat_words, {", ".join(f"CAST({n_of[c]} AS BIGINT) AS {c}" for c in counts)}
        FROM split LEFT JOIN repeats USING (r)
    ),
    voted AS MATERIALIZED (SELECT *, {", ".join(f"{v} AS {n}" for n, v in rules.items())} FROM counted),
    tally AS MATERIALIZED (SELECT {", ".join(names)}, CAST(count(*) AS DOUBLE) AS n FROM voted GROUP BY ALL),
    {", ".join(steps)}
    SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words,
        n_words < 50 OR 100 * n_repeat_words > 50 * n_words AS base_failed,
        NOT (n_words < 50 OR 100 * n_repeat_words > 50 * n_words) AND good >= 0.5 AS kept
    FROM voted JOIN p{ROUNDS} USING ({", ".join(names)})"""


def _urls() -> str:
    after = "CASE WHEN position('://' IN url) > 0 THEN substr(url, position('://' IN url) + 3) ELSE '' END"
    cases = []
    for h, p, verdict in sorted(URL_RULES, key=lambda r: (-len(r[0] + r[1]), r)):
        fits = f"(host = '{h}' OR ends_with(host, '.{h}')) AND starts_with(path, '{p}')"
        cases.append((fits, h + p, verdict))
    rule = " ".join(f"WHEN {f} THEN '{r}'" for f, r, _ in cases)
    verdict = " ".join(f"WHEN {f} THEN '{v}'" for f, _, v in cases)
    return rf"""
    WITH cut AS (SELECT page_id, url, coalesce({after}, '') AS rest FROM pages),
    parts AS (
        SELECT page_id, url, translate(regexp_extract(rest, '^[^/?#]*'), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS host,
            regexp_extract(rest, '^[^/?#]*([^?#]*)', 1) AS path,
            list_sort(list_filter(string_split(regexp_extract(coalesce(url, ''), '^[^#?]*\?([^#]*)', 1), '&'),
                lambda x: x <> '' AND NOT regexp_matches(x, '^(utm_|ref=)'))) AS query
        FROM cut
    ),
    named AS (
        SELECT *, regexp_replace(host, '^www\.', '') || regexp_replace(path, '/+$', '')
            || CASE WHEN len(query) > 0 THEN '?' || array_to_string(query, '&') ELSE '' END AS canon
        FROM parts
    ),
    listed AS (SELECT DISTINCT canon FROM named WHERE CASE {verdict} END = 'block' AND canon <> '')
    SELECT page_id, host, path, CASE {rule} END AS rule,
        CASE {verdict} WHEN host <> '' AND canon IN (SELECT canon FROM listed) THEN 'block' ELSE 'allow' END AS verdict
    FROM named"""


def _collocations() -> str:
    """Every phrase counted under its words; a cut's score and the phrases inside others by joins."""
    lengths = range(1, LONGEST + 1)
    runs = " UNION ALL ".join(
        f"SELECT lang, {n} AS size, unnest(list_transform(range(1, len(w) - {n} + 2), lambda i: array_to_string(list_slice(w, i, i + {n} - 1), ' '))) AS phrase "
        f"FROM pieces WHERE len(w) >= {n}"
        for n in lengths
    )
    cuts = " UNION ALL ".join(
        f"SELECT lang, phrase, a, {k} AS k, array_to_string(list_slice(w, 1, {k}), ' ') AS first, array_to_string(list_slice(w, {k} + 1, size), ' ') AS rest "
        f"FROM candidates WHERE size > {k}"
        for k in lengths[:-1]
    )
    inside = " UNION ALL ".join(
        f"SELECT lang, a AS m, array_to_string(list_slice(w, {i}, {i + n - 1}), ' ') AS phrase FROM candidates WHERE size > {n} AND size >= {i + n - 1}"
        for n in lengths[1:-1]
        for i in range(1, LONGEST - n + 2)
    )
    return rf"""
        WITH docs AS (
            SELECT coalesce(lang, 'und') AS lang, translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS body FROM documents
        ),
        cut AS (SELECT lang, unnest(string_split_regex(body, '[.,;:!?
-
]')) AS piece FROM docs),
        pieces AS (SELECT lang, regexp_extract_all(piece, '[^ 	]+') AS w FROM cut),
        totals AS (SELECT lang, CAST(sum(len(w)) AS BIGINT) AS n FROM pieces GROUP BY lang),
        counts AS (SELECT lang, size, phrase, count(*) AS a FROM ({runs}) GROUP BY lang, size, phrase HAVING count(*) >= {LEAST}),
        candidates AS (SELECT *, string_split(phrase, ' ') AS w FROM counts WHERE size > 1),
        scored AS (
            SELECT c.lang, c.phrase, c.a, c.k, x.a AS l, y.a AS r, n,
                CAST((CAST(1000 AS HUGEINT) * c.a * n) // (CAST(x.a AS HUGEINT) * y.a) AS BIGINT) AS score
            FROM ({cuts}) c JOIN counts x ON x.lang = c.lang AND x.phrase = c.first
            JOIN counts y ON y.lang = c.lang AND y.phrase = c.rest JOIN totals t ON t.lang = c.lang
        ),
        lowest AS (SELECT *, row_number() OVER (PARTITION BY lang, phrase ORDER BY score, k) AS place FROM scored),
        covered AS (SELECT lang, phrase, max(m) AS m FROM ({inside}) GROUP BY lang, phrase),
        kept AS (
            SELECT s.* FROM lowest s LEFT JOIN covered c ON c.lang = s.lang AND c.phrase = s.phrase
            WHERE s.place = 1 AND NOT coalesce(100 * m >= 100 * a, FALSE)
        ),
        ranked AS (SELECT *, row_number() OVER (PARTITION BY lang ORDER BY score DESC, a DESC, encode(phrase)) AS rank FROM kept)
        SELECT lang, rank, phrase, a, l, r, n, score FROM ranked WHERE rank <= {TOP}"""


ORACLES = {
    "op1_secret_scan": _secrets(),
    "op5_source_mix": MIX,
    "op6_chat_perspectives": CHAT,
    "op9_quality_rules": _quality(),
    "op10_url_filter": _urls(),
    "op11_phrase_collocations": _collocations(),
}
