"""Ordered pattern cascades: the first pattern with an accepted match decides.

Patterns are evaluated once each and only as far as needed. A pattern is left out where the
text lacks words that its every match holds: looking for a word is many times cheaper than
trying a pattern at every place of the text.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence
from functools import lru_cache, reduce

try:
    from re import _parser as sre
except ImportError:  # before Python 3.11
    import sre_parse as sre

from pyspark.sql import Column
from pyspark.sql import functions as F

from ..functions.text import strip
from ..schemas import let

#: Ignore case, lines end at line feeds, ^ and $ match at lines; "dot" lets . cross lines.
LINES, DOT = "(?imd)", "(?imsd)"


@lru_cache(maxsize=None)
def needed(pattern: str) -> tuple[tuple[str, ...], ...]:
    """Words in upper case that every match holds, ignoring case: one at least of each tuple."""
    found = set(_needed(sre.parse(pattern)))
    # a word within another one says no more, and single letters too little
    found = [x for x in found if min(map(len, x)) > 1 or not any(w.isalnum() for w in x)]
    return tuple(sorted((x for x in found if not any(y != x and all(any(a in b for b in y) for a in x) for y in found)), key=lambda x: (len(x), -min(map(len, x)), x)))


def _needed(parts) -> list[tuple[str, ...]]:
    found, word = [], ""
    for kind, value in parts:
        name = str(kind)
        if name == "LITERAL" and value < 128:
            word += chr(value).upper()
            continue
        found, word = [*found, (word,)] if word else found, ""
        if name == "SUBPATTERN":
            found += _needed(value[-1])
        elif name == "ASSERT":
            found += _needed(value[1])
        elif name in ("MAX_REPEAT", "MIN_REPEAT") and value[0] > 0:
            found += _needed(value[2])
        elif name == "BRANCH":
            ways = [_needed(way) for way in value[1]]
            if all(ways):
                words = {w for way in ways for w in max(way, key=lambda x: min(map(len, x)))}
                found.append(tuple(sorted(w for w in words if not any(v != w and v in w for v in words))))
    return [*found, (word,)] if word else found


def may_match(upper: Column, pattern: str) -> Column | None:
    """Whether a text, given in upper case, has what the pattern needs; None if that is nothing."""
    each = [reduce(Column.__or__, (F.contains(upper, F.lit(w)) for w in words)) for words in needed(pattern)]
    return reduce(Column.__and__, each) if each else None


def where_possible(upper: Column, pattern: str, value: Column) -> Column:
    """A value made from a pattern's match; null where the text cannot match it."""
    possible = may_match(upper, pattern)
    return value if possible is None else F.when(possible, value)


def capture(text: Column, pattern: str, group: int = 1, flags: str = LINES) -> Column:
    """A group of the first match without outer white space; null without a match or when empty."""
    return let(strip(F.regexp_extract(text, flags + pattern, group)), lambda x: F.when(x != "", x))


def first_match(text: Column, patterns: Sequence[str], flags: str = LINES, valid: Callable[[Column], Column] | None = None, post: Callable[[Column], Column] | None = None) -> Column:
    """First group of the first pattern that matches and whose match is valid; else empty.

    A match that is not valid passes the turn to the next pattern, never to the next match
    of the same one. ``post`` changes a match before it is judged.
    """

    def judged(x: Column) -> Column:
        return x if valid is None else let(x, lambda y: F.when(valid(y), y))

    def found(p: str) -> Column:
        match = let(F.regexp_extract(text, flags + p, 1), lambda x: F.when(x != "", strip(x)))
        return let(match, lambda x: F.when(x != "", judged(x if post is None else post(x))))

    return let(F.upper(text), lambda upper: F.coalesce(*(where_possible(upper, p, found(p)) for p in patterns), F.lit("")))


def first_pair(text: Column, patterns: Sequence[str], flags: str = LINES) -> Column:
    """Struct of both groups of the first pattern that matches; null without a match."""

    def first(upper: Column) -> Column:
        pair = lambda p: F.struct(F.regexp_extract(text, flags + p, 1).alias("first"), F.regexp_extract(text, flags + p, 2).alias("second"))
        return F.coalesce(*(where_possible(upper, p, F.when(F.rlike(text, F.lit(flags + p)), pair(p))) for p in patterns))

    return let(F.upper(text), first)
