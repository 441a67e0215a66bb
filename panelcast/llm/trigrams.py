"""Boolean trigram queries from regular expressions.

A query is a list of clauses; a text can match only if it holds, in lower case, every trigram of
at least one clause. The empty clause is always met: the expression has no trigram that every
match must hold, and its rule scans every text.
"""

from __future__ import annotations

from re import _constants as kind
from re import _parser

MOST_TEXTS = 64

Strings = frozenset[str]
#: What can stand at a place: known texts; alternative sets of trigrams; or anything.
Piece = Strings | list[set[str]] | None


def clauses(pattern: str) -> list[frozenset[str]]:
    """The trigram query of a regular expression, its clauses without those that others imply."""
    parsed = _parser.parse(pattern)
    found = {frozenset(t) for t in _needs(_pieces(parsed))}
    return sorted((c for c in found if not any(o < c for o in found)), key=sorted)


def _pieces(parsed) -> list[Piece]:
    """The expression as a sequence."""
    out: list[Piece] = []
    for op, arg in parsed:
        if op is kind.LITERAL:
            out.append(frozenset({chr(arg).lower()}))
        elif op is kind.IN:
            out.append(_letters(arg))
        elif op is kind.SUBPATTERN:
            out += _pieces(arg[-1])
        elif op is kind.BRANCH:
            options = [_pieces(p) for p in arg[1]]
            out.append(_either(options) or [n for o in options for n in _needs(o)])
        elif op in (kind.MAX_REPEAT, kind.MIN_REPEAT):
            least, most, inner = arg
            once = _pieces(inner)
            if (least, most) == (0, 1):
                out.append(_either([[frozenset({""})], once]))
            else:
                out += once * min(least, 3) + [None] * (most != least or least > 3)
        elif op is kind.AT:
            continue
        else:
            out.append(None)
    return out


def _letters(items) -> Strings | None:
    chars: set[str] = set()
    for op, arg in items:
        if op is kind.LITERAL:
            chars.add(chr(arg).lower())
        else:
            return None
    return frozenset(chars)


def _either(options: list[list[Piece]]) -> Strings | None:
    texts: set[str] = set()
    for option in options:
        if not all(isinstance(p, frozenset) for p in option):
            return None
        whole = _joined(option)
        if whole is None:
            return None
        texts |= whole
    return frozenset(texts) if len(texts) <= MOST_TEXTS else None


def _joined(pieces: list[Strings]) -> Strings | None:
    texts = frozenset({""})
    for p in pieces:
        texts = frozenset(a + b for a in texts for b in p)
        if len(texts) > MOST_TEXTS:
            return None
    return texts


def _needs(pieces: list[Piece]) -> list[set[str]]:
    """Alternative sets of trigrams: the product over the runs of known texts."""
    needs: list[set[str]] = [set()]
    run: list[Strings] = []
    for p in [*pieces, None]:
        known = isinstance(p, frozenset)
        if known and _joined([*run, p]) is not None:
            run.append(p)
            continue
        texts = _joined(run) or frozenset({""})
        if len(needs) * len(texts) <= MOST_TEXTS and texts != frozenset({""}):
            needs = [n | {t[i : i + 3] for i in range(len(t) - 2)} for n in needs for t in texts]
        if isinstance(p, list) and len(needs) * len(p) <= MOST_TEXTS:
            needs = [n | more for n in needs for more in p]
        run = [p] if known else []
    return needs
