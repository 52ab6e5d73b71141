"""Which trigrams a text must contain for a regular expression to match anywhere in it.

A query is a list of alternatives, each a set of trigrams that must all occur; it is None
where some match needs no trigram at all. Trigrams are of the text in lower case, so that
a query never asks for more than the expression does.
"""

from __future__ import annotations

from re import _constants as kinds
from re import _parser as parser

Query = list[frozenset[str]] | None

# Beyond these, a part counts as unknown: the query gets weaker, never wrong.
_CLASS_LETTERS = 8
_STRINGS = 64
_ALTERNATIVES = 64


def trigram_query(pattern: str) -> Query:
    exact, query = _walk(list(parser.parse(pattern)))
    return _both(query, _of_strings(exact))


def _of_strings(strings: set[str]) -> Query:
    """The query of a place where one of ``strings`` stands."""
    if any(len(s) < 3 for s in strings):
        return None
    return _tidy([frozenset(s[i : i + 3] for i in range(len(s) - 2)) for s in strings])


def _tidy(alternatives: list[frozenset[str]]) -> Query:
    """Without alternatives that another one is weaker than."""
    kept = {a for a in alternatives if not any(b < a for b in alternatives)}
    return sorted(kept, key=sorted) if len(kept) <= _ALTERNATIVES else None


def _both(a: Query, b: Query) -> Query:
    if a is None or b is None:
        return a if b is None else b
    return _tidy([x | y for x in a for y in b]) or a


def _either(queries: list[Query]) -> Query:
    if any(q is None for q in queries):
        return None
    return _tidy([a for q in queries for a in q])


def _walk(nodes: list) -> tuple[set[str], Query]:
    """The strings that can stand at the end of the part, as far as they are known from some
    place on, and the query of all before that place."""
    known, query = {""}, None
    for node in nodes:
        strings, own = _strings(node)
        query = _both(query, own)
        joined = {a + b for a in known for b in strings} if strings is not None else set()
        if strings is None or len(joined) > _STRINGS:
            query = _both(query, _of_strings(known))
            known = {""}
            if strings is not None:
                known = strings
        else:
            known = joined
    return known, query


def _strings(node) -> tuple[set[str] | None, Query]:
    """All strings that the node can match, or None if they are many, and its query."""
    kind, value = node
    if kind is kinds.LITERAL:
        return {chr(value).lower()}, None
    if kind is kinds.IN:
        letters: set[str] = set()
        for part, range_ in value:
            if part is kinds.LITERAL:
                letters.add(chr(range_).lower())
            elif part is kinds.RANGE and range_[1] - range_[0] < _CLASS_LETTERS:
                letters |= {chr(c).lower() for c in range(range_[0], range_[1] + 1)}
            else:
                return None, None
        return (letters, None) if len(letters) <= _CLASS_LETTERS else (None, None)
    if kind is kinds.AT:
        return {""}, None
    if kind is kinds.SUBPATTERN:
        return _whole(value[-1])
    if kind is kinds.BRANCH:
        parts = [_whole(p) for p in value[1]]
        if all(s is not None for s, _ in parts):
            return set().union(*(s for s, _ in parts)), None
        return None, _either([_both(q, _of_strings(s) if s is not None else None) for s, q in parts])
    if kind in (kinds.MAX_REPEAT, kinds.MIN_REPEAT, kinds.POSSESSIVE_REPEAT):
        least, most, item = value
        strings, query = _whole(item)
        if strings is not None and most == 1:
            return (strings | {""}, None) if least == 0 else (strings, None)
        if least == 0:
            return None, None
        return None, _both(query, _of_strings(strings) if strings is not None else None)
    return None, None


def _whole(nodes) -> tuple[set[str] | None, Query]:
    """Like ``_strings``, of a sequence of nodes."""
    strings: set[str] | None = {""}
    for node in nodes:
        one, _ = _strings(node)
        if one is None or len(strings) * len(one) > _STRINGS:
            known, query = _walk(list(nodes))
            return None, _both(query, _of_strings(known))
        strings = {a + b for a in strings for b in one}
    return strings, None
