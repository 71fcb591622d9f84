"""Boolean trigram queries from regular expressions.

A pattern is read into its literals, classes, groups, alternatives and repeats. Of every part four
things are known: the strings it matches, if they are few (``exact``), else what its matches begin and
end with, and a query that every text with a match satisfies. A query is a list of alternatives, each
a set of trigrams that all occur. Parts are joined from left to right; where two parts meet, the ends of
one and the beginnings of the other give trigrams too. Dropping a condition only lets more texts
through, so long queries are shortened that way.
"""

from __future__ import annotations

import re
from dataclasses import dataclass
from itertools import product

# The parser of the standard library; its tree names the parts as the constants below.
from re import _constants as op
from re import _parser as parser

#: Strings in a set, characters of a class that count as strings, alternatives of a query, copies of a repeated part.
STRINGS, CLASS, ALTERNATIVES, COPIES = 64, 16, 64, 4

Query = frozenset[frozenset[str]]
#: Satisfied by every text.
ANY: Query = frozenset([frozenset()])


@dataclass(frozen=True)
class Part:
    exact: frozenset[str] | None
    begins: frozenset[str]
    ends: frozenset[str]
    query: Query


_EMPTY = Part(frozenset([""]), frozenset([""]), frozenset([""]), ANY)
_UNKNOWN = Part(None, frozenset([""]), frozenset([""]), ANY)


def _either(queries: list[Query]) -> Query:
    """At least one of the queries; an alternative that includes another one says nothing more."""
    every = set().union(*queries)
    least = frozenset(a for a in every if not any(b < a for b in every))
    return least if len(least) <= ALTERNATIVES else ANY


def _both(x: Query, y: Query) -> Query:
    if len(x) * len(y) > ALTERNATIVES:
        return min((x, y), key=lambda q: (q == ANY, len(q)))
    return _either([frozenset(a | b for a, b in product(x, y))])


def _contains(strings: frozenset[str]) -> Query:
    """One of the strings occurs."""
    return _either([frozenset(frozenset(s[i : i + 3] for i in range(len(s) - 2)) for s in strings)])


def _strings(strings: frozenset[str]) -> Part:
    return Part(strings, strings, strings, ANY)


def _loose(part: Part) -> Part:
    """The same part, with what its exact strings say put into the other fields."""
    query = part.query if part.exact is None else _both(part.query, _contains(part.exact))
    return Part(None, frozenset(s[:2] for s in part.begins), frozenset(s[-2:] for s in part.ends), query)


def _then(x: Part, y: Part) -> Part:
    if x.exact is not None and y.exact is not None and len(x.exact) * len(y.exact) <= STRINGS:
        return _strings(frozenset(a + b for a, b in product(x.exact, y.exact)))
    begins, ends = x.begins, y.ends
    if x.exact is not None and len(x.exact) * len(y.begins) <= STRINGS:
        begins = frozenset(a + b for a, b in product(x.exact, y.begins))
    if y.exact is not None and len(x.ends) * len(y.exact) <= STRINGS:
        ends = frozenset(a + b for a, b in product(x.ends, y.exact))
    query = _both(_loose(x).query, _loose(y).query)
    if len(x.ends) * len(y.begins) <= STRINGS:
        query = _both(query, _contains(frozenset(a + b for a, b in product(x.ends, y.begins))))
    # An exact side that the other side follows or precedes stays visible at its own end only.
    return _loose(Part(None, begins, ends, query))


def _or(parts: list[Part]) -> Part:
    if all(p.exact is not None for p in parts):
        strings = frozenset().union(*(p.exact for p in parts))
        if len(strings) <= STRINGS:
            return _strings(strings)
    parts = [_loose(p) for p in parts]
    begins, ends = (frozenset().union(*(getattr(p, side) for p in parts)) for side in ("begins", "ends"))
    query = _either([p.query for p in parts])
    unknown = frozenset([""])
    return Part(None, begins if len(begins) <= STRINGS else unknown, ends if len(ends) <= STRINGS else unknown, query)


def _class(items: list, fold: bool) -> Part:
    chars: set[str] = set()
    for kind, value in items:
        if kind is op.LITERAL:
            chars.add(chr(value))
        elif kind is op.RANGE and value[1] - value[0] < CLASS:
            chars.update(map(chr, range(value[0], value[1] + 1)))
        else:
            return _UNKNOWN
    chars = {c.lower() for c in chars} if fold else chars
    return _strings(frozenset(chars)) if 0 < len(chars) <= CLASS else _UNKNOWN


def _repeat(low: int, high, part: Part) -> Part:
    if low == 0:
        return _or([_EMPTY, part]) if high == 1 else _UNKNOWN
    whole = part
    for _ in range(min(low, COPIES) - 1):
        whole = _then(whole, part)
    if low == high and low <= COPIES:
        return whole
    # More copies may stand between the first and the last.
    return _loose(whole)


def _sequence(items, fold: bool) -> Part:
    out = _EMPTY
    for kind, value in items:
        if kind is op.LITERAL:
            part = _strings(frozenset([chr(value).lower() if fold else chr(value)]))
        elif kind is op.IN:
            part = _class(value, fold)
        elif kind is op.BRANCH:
            part = _or([_sequence(v, fold) for v in value[1]])
        elif kind is op.SUBPATTERN:
            part = _sequence(value[3], fold)
        elif kind is op.ATOMIC_GROUP:
            part = _sequence(value, fold)
        elif kind in (op.MAX_REPEAT, op.MIN_REPEAT, op.POSSESSIVE_REPEAT):
            part = _repeat(value[0], value[1], _sequence(value[2], fold))
        elif kind in (op.AT, op.ASSERT, op.ASSERT_NOT):
            continue
        else:
            part = _UNKNOWN
        out = _then(out, part)
    return out


def _folds(items) -> bool:
    """Whether some part ignores case."""
    for kind, value in items:
        if kind is op.SUBPATTERN and (value[1] & re.IGNORECASE or _folds(value[3])):
            return True
        if kind is op.BRANCH and any(_folds(v) for v in value[1]):
            return True
        if kind in (op.MAX_REPEAT, op.MIN_REPEAT, op.POSSESSIVE_REPEAT) and _folds(value[2]):
            return True
        if kind is op.ATOMIC_GROUP and _folds(value):
            return True
    return False


def derive(pattern: str) -> tuple[bool, list[frozenset[str]]]:
    """Whether the trigrams are those of the lower-case text, and the alternatives of the query.

    Without alternatives every text may match: the pattern has no mandatory trigram, or is written in
    a way that this reader does not know.
    """
    try:
        tree = parser.parse(pattern)
    except (re.error, OverflowError, RecursionError):
        return False, []
    fold = bool(tree.state.flags & re.IGNORECASE) or _folds(tree)
    query = _loose(_sequence(tree, fold)).query
    return fold, [] if frozenset() in query else sorted(query, key=sorted)
