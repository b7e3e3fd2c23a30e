"""Boolean trigram queries of regular expressions.

What a pattern can match is followed as a set of exact strings as long as that
set stays small; trigrams that every match must hold become an AND/OR tree.
Everything is in lower case, as the index is.
"""

from __future__ import annotations

import re._parser as parser
from dataclasses import dataclass

_MOST_STRINGS = 64
_MOST_CHARACTERS = 8

# A query is True (no condition), a trigram, or ("and" | "or", parts).
Query = bool | str | tuple


def both(a: Query, b: Query) -> Query:
    if a is True or b is True or a == b:
        return b if a is True else a
    parts = [p for q in (a, b) for p in (q[1] if isinstance(q, tuple) and q[0] == "and" else (q,))]
    return "and", tuple(dict.fromkeys(parts))


def _parts(query: Query) -> set:
    return set(query[1]) if isinstance(query, tuple) and query[0] == "and" else {query}


def either(options: list[Query]) -> Query:
    options = list(dict.fromkeys(options))
    if not options or True in options:
        return True
    # an option that asks for all that another one asks for, and more, adds nothing
    options = [q for q in options if not any(_parts(o) < _parts(q) for o in options)]
    return options[0] if len(options) == 1 else ("or", tuple(options))


@dataclass(frozen=True)
class _Part:
    """What a part of a pattern matches: exactly these strings, or (None) unknown ones."""

    exact: frozenset[str] | None
    query: Query


def _of_string(text: str) -> Query:
    query: Query = True
    for i in range(len(text) - 2):
        query = both(query, text[i : i + 3])
    return query


def _give_up(part: _Part) -> Query:
    """A part's condition, once its exact strings are no longer followed."""
    if part.exact is None:
        return part.query
    return both(part.query, either([_of_string(s) for s in sorted(part.exact)]))


def _join(a: _Part, b: _Part) -> _Part:
    if a.exact is not None and b.exact is not None:
        if len(a.exact) * len(b.exact) <= _MOST_STRINGS:
            return _Part(
                frozenset(x + y for x in a.exact for y in b.exact), both(a.query, b.query)
            )
    return _Part(None, both(_give_up(a), _give_up(b)))


def _set(items: list) -> frozenset[str] | None:
    """The characters of a class, if they are few."""
    found: set[str] = set()
    for kind, value in items:
        if kind is parser.LITERAL:
            found.add(chr(value).lower())
        elif kind is parser.RANGE and value[1] - value[0] < 26:
            found.update(chr(c).lower() for c in range(value[0], value[1] + 1))
        else:
            return None
    return frozenset(found) if len(found) <= _MOST_CHARACTERS else None


def _follow(items) -> _Part:
    whole = _Part(frozenset([""]), True)
    for kind, value in items:
        part = _Part(None, True)
        if kind is parser.LITERAL:
            part = _Part(frozenset([chr(value).lower()]), True)
        elif kind is parser.IN and (characters := _set(value)):
            part = _Part(characters, True)
        elif kind is parser.SUBPATTERN:
            part = _follow(value[-1])
        elif kind is parser.BRANCH:
            options = [_follow(o) for o in value[1]]
            if all(o.exact is not None and o.query is True for o in options):
                part = _Part(frozenset().union(*(o.exact for o in options)), True)
            else:
                part = _Part(None, either([_give_up(o) for o in options]))
        elif kind in (parser.MAX_REPEAT, parser.MIN_REPEAT):
            least, most, inner = value
            inside = _follow(inner)
            if (least, most) == (0, 1) and inside.exact is not None and inside.query is True:
                part = _Part(inside.exact | {""}, True)
            elif least == most == 1:
                part = inside
            elif least:
                whole = _join(whole, inside)  # the first time round; the rest is unknown
        elif kind is parser.AT:
            continue
        whole = _join(whole, part)
    return whole


def trigram_query(pattern: str) -> Query:
    """The condition on a lower-cased text's trigrams; True if the pattern has none.

    Strings that are shorter than a trigram give no condition, so a part of the
    pattern with one of them gives none.
    """
    return _give_up(_follow(parser.parse(pattern)))


def trigrams(query: Query) -> set[str]:
    """All trigrams of a query."""
    if query is True:
        return set()
    if isinstance(query, str):
        return {query}
    return set().union(*map(trigrams, query[1]))
