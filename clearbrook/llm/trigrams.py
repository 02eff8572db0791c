"""Boolean trigram queries from regular expressions.

A text that matches an expression contains certain trigrams. The query is a conjunction of clauses, a clause a choice
of trigram sets, one of which must be there in full. Letters are folded to lower case, as the index is.
"""

from __future__ import annotations

from itertools import product
from re import _constants as op
from re import _parser as parser

#: Strings a part of an expression may stand for before they are given up as "anything".
MOST = 64

Clause = frozenset[frozenset[str]]


def _strings(node) -> set[str] | None:
    """All strings that a parsed part can match, or None if there are too many."""
    kind, value = node
    if kind is op.LITERAL:
        return {chr(value).lower()}
    if kind is op.IN:
        if value[0][0] is op.NEGATE:
            return None
        found = set()
        for what, of in value:
            if what is op.LITERAL:
                found.add(chr(of).lower())
            elif what is op.RANGE and of[1] - of[0] < MOST:
                found |= {chr(c).lower() for c in range(of[0], of[1] + 1)}
            else:
                return None
        return found if len(found) <= 12 else None
    if kind is op.SUBPATTERN:
        return _sequence(value[-1])
    if kind is op.BRANCH:
        parts = [_sequence(branch) for branch in value[1]]
        return None if None in parts else set().union(*parts)
    if kind in (op.MAX_REPEAT, op.MIN_REPEAT) and value[1] == 1:
        inner = _sequence(value[2])
        return inner if inner is None or value[0] else inner | {""}
    if kind is op.AT:
        return {""}
    return None


def _sequence(nodes) -> set[str] | None:
    found = {""}
    for node in nodes:
        more = _strings(node)
        if more is None or len(found) * len(more) > MOST:
            return None
        found = {a + b for a, b in product(found, more)}
    return found


def _clause(strings: set[str]) -> Clause | None:
    sets = {frozenset(s[i : i + 3] for i in range(len(s) - 2)) for s in strings}
    if frozenset() in sets:
        return None
    return frozenset(s for s in sets if not any(other < s for other in sets))


def trigram_query(pattern: str) -> list[Clause]:
    """The clauses that every match of ``pattern`` fulfils; none if it has no mandatory trigram."""
    clauses: list[Clause] = []

    def walk(nodes) -> None:
        current = {""}
        for node in nodes:
            more = _strings(node)
            if more is not None and len(current) * len(more) <= MOST:
                current = {a + b for a, b in product(current, more)}
                continue
            clauses.append(_clause(current))
            current = more if more is not None and len(more) <= MOST else {""}
            kind, value = node
            if more is None and kind is op.SUBPATTERN:
                walk(value[-1])
            elif more is None and kind in (op.MAX_REPEAT, op.MIN_REPEAT) and value[0] > 0:
                walk(value[2])
        clauses.append(_clause(current))

    walk(parser.parse(pattern))
    return list(dict.fromkeys(c for c in clauses if c))
