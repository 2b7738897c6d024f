"""Boolean trigram queries that every match of a regular expression satisfies."""

from __future__ import annotations

from itertools import product
from re import _constants as kinds
from re import _parser as parser

#: Strings that one alternative set may hold before its trigrams are taken.
MOST_STRINGS = 48

#: A query is a list of alternatives; each is the set of trigrams it needs. An empty
#: set needs nothing, so a query that holds one is no restriction.
Query = frozenset[frozenset[str]]
ANYTHING: Query = frozenset({frozenset()})


def _grams(text: str) -> frozenset[str]:
    return frozenset(text[i : i + 3] for i in range(len(text) - 2))


def _least(query: Query) -> Query:
    """Without alternatives that need more than another one."""
    return frozenset(a for a in query if not any(b < a for b in query))


def _both(a: Query, b: Query) -> Query:
    joined = _least(frozenset(x | y for x, y in product(a, b)))
    return joined if len(joined) <= MOST_STRINGS else min(a, b, key=len)


def _of_strings(strings: set[str]) -> Query:
    return _least(frozenset(_grams(s) for s in strings))


def _letters(items: list) -> set[str] | None:
    """The lower-cased characters of a class, if they are few."""
    found: set[str] = set()
    for kind, value in items:
        if kind is kinds.LITERAL:
            found.add(chr(value).lower())
        elif kind is kinds.RANGE and value[1] - value[0] < 6:
            found |= {chr(c).lower() for c in range(value[0], value[1] + 1)}
        else:
            return None
    return found if len(found) <= 6 else None


def _walk(tokens) -> tuple[set[str] | None, Query]:
    """All strings a pattern matches, lower-cased, if they are few; and its query."""
    query, run, whole = ANYTHING, {""}, True
    for kind, value in tokens:
        strings, inner = None, ANYTHING
        if kind is kinds.LITERAL:
            strings = {chr(value).lower()}
        elif kind is kinds.IN:
            strings = _letters(value)
        elif kind is kinds.SUBPATTERN:
            strings, inner = _walk(value[3])
        elif kind is kinds.BRANCH:
            parts = [_walk(x) for x in value[1]]
            inner = _least(frozenset().union(*(q for _, q in parts)))
            if all(s is not None for s, _ in parts):
                strings = set().union(*(s for s, _ in parts))
        elif kind in (kinds.MAX_REPEAT, kinds.MIN_REPEAT, kinds.POSSESSIVE_REPEAT):
            least, most, body = value
            part, part_query = _walk(body)
            inner = part_query if least else ANYTHING
            if part is not None and most == 1:
                strings = part | {""} if least == 0 else part
            elif part is not None and least == most and len(part) ** least <= MOST_STRINGS:
                strings = {"".join(x) for x in product(part, repeat=least)}
        elif kind is kinds.AT or kind in (kinds.ASSERT, kinds.ASSERT_NOT):
            strings = {""}
        grown = None if strings is None else {a + b for a, b in product(run, strings)}
        if grown is not None and len(grown) <= MOST_STRINGS:
            run = grown
            continue
        whole = False
        query = _both(_both(query, _of_strings(run)), inner)
        run = strings if strings is not None else {""}
    if whole:
        return run, _of_strings(run)
    return None, _both(query, _of_strings(run))


def trigram_query(pattern: str) -> list[list[str]]:
    """Alternatives of sorted trigrams of the lower-cased text; [] if the text must be scanned fully.

    Trigrams with characters outside ASCII are left out, as their lower case may differ.
    """
    strings, query = _walk(parser.parse(pattern))
    plain = _least(frozenset(frozenset(g for g in alternative if g.isascii()) for alternative in query))
    return [] if frozenset() in plain else sorted(sorted(x) for x in plain)
