"""Boolean trigram queries of regular expressions.

:func:`trigram_query` derives, from a pattern alone, trigrams that the lower-cased
text of every match must hold: an OR of ANDs, as a list of sorted trigram lists. An
empty list means that nothing is mandatory, so the pattern must be run everywhere.

Every part of a pattern is known by either all lower-cased strings that it matches
(``exact``, while they are few) or by what its matches begin and end with and a
query that they satisfy. Parts in a row join their ends, alternatives unite, and
a set that would grow beyond ``MOST`` strings or ANDs becomes weaker instead ("any"
at worst), which adds candidates and loses none. Of characters outside ASCII nothing
is assumed, since lower-casing may change their number.
"""

from __future__ import annotations

import re
from dataclasses import dataclass

#: strings of a set, ANDs of a query, and characters of a class that is spelt out
MOST, CLASS = 64, 8

ANY = frozenset([frozenset()])  # one AND without a condition
EMPTY = frozenset([""])


def least(query: frozenset) -> frozenset:
    """Without the ANDs that another one follows from."""
    return frozenset(a for a in query if not any(b < a for b in query))


def either(a: frozenset, b: frozenset) -> frozenset:
    both = least(a | b)
    return both if len(both) <= MOST else ANY


def both_of(a: frozenset, b: frozenset) -> frozenset:
    """AND of two queries; the stronger of them alone if that is too large."""
    met = least(frozenset(x | y for x in a for y in b)) if len(a) * len(b) <= MOST * MOST else None
    if met is not None and len(met) <= MOST:
        return met
    return max(a, b, key=lambda q: min(map(len, q)))


def of_strings(strings: frozenset) -> frozenset:
    query = least(frozenset(frozenset(s[i:i + 3] for i in range(len(s) - 2)) for s in strings))
    return query if len(query) <= MOST else ANY


@dataclass(frozen=True)
class Known:
    """What is known of the lower-cased matches of a part of a pattern."""

    exact: frozenset | None
    first: frozenset = EMPTY
    last: frozenset = EMPTY
    query: frozenset = ANY

    def open(self) -> Known:
        """The same without ``exact``: two characters at each end suffice for trigrams
        across a border."""
        if self.exact is None:
            return self
        return Known(None, frozenset(s[:2] for s in self.exact), frozenset(s[-2:] for s in self.exact), of_strings(self.exact))


NOTHING, SOMETHING = Known(EMPTY), Known(None)


def then(a: Known, b: Known) -> Known:
    """``a`` followed by ``b``."""
    if a.exact is not None and b.exact is not None and len(a.exact) * len(b.exact) <= MOST:
        return Known(frozenset(x + y for x in a.exact for y in b.exact))
    x, y = a.open(), b.open()
    ends, starts = a.exact or x.last, b.exact or y.first
    across = ANY
    if len(ends) * len(starts) <= MOST:
        across = of_strings(frozenset(e + s for e in ends for s in starts))
    first = frozenset((e + s)[:2] for e in a.exact for s in y.first) if a.exact is not None else x.first
    last = frozenset((e + s)[-2:] for e in x.last for s in b.exact) if b.exact is not None else y.last
    return Known(None, first, last, both_of(both_of(x.query, y.query), across))


def union(a: Known, b: Known) -> Known:
    """``a`` or ``b``."""
    if a.exact is not None and b.exact is not None and len(a.exact | b.exact) <= MOST:
        return Known(a.exact | b.exact)
    x, y = a.open(), b.open()
    return Known(None, x.first | y.first, x.last | y.last, either(x.query, y.query))


def repeated(a: Known, low: int, high: int) -> Known:
    """``a`` from ``low`` to ``high`` times."""
    out, sure = NOTHING, min(low, 4)
    for _ in range(sure):
        out = then(out, a)
    if high == sure:
        return out
    if (low, high) == (0, 1):
        return union(NOTHING, a)
    # more may follow; the end is known if there was at least one
    tail = a.open()
    return then(out, SOMETHING) if not low else Known(None, then(out, SOMETHING).first, tail.last, out.open().query)


def character(codes) -> Known:
    letters = frozenset(chr(c).lower() for c in codes)
    if len(letters) > CLASS or any(c > 127 for c in codes):
        return SOMETHING
    return Known(letters)


def members(items) -> list | None:
    """The characters of a class, or None if they are many or stand for a category."""
    out = []
    for op, arg in items:
        if str(op) == "LITERAL":
            out.append(arg)
        elif str(op) == "RANGE" and arg[1] - arg[0] < 128:
            out.extend(range(arg[0], arg[1] + 1))
        else:
            return None
    return out


def known(parts) -> Known:
    out = NOTHING
    for op, arg in parts:
        kind = str(op)
        if kind == "LITERAL":
            one = character([arg])
        elif kind == "IN":
            codes = members(arg)
            one = SOMETHING if codes is None else character(codes)
        elif kind == "SUBPATTERN":
            one = known(arg[3])
        elif kind == "ATOMIC_GROUP":
            one = known(arg)
        elif kind == "BRANCH":
            one = known(arg[1][0])
            for branch in arg[1][1:]:
                one = union(one, known(branch))
        elif kind in ("MAX_REPEAT", "MIN_REPEAT", "POSSESSIVE_REPEAT"):
            one = repeated(known(arg[2]), int(arg[0]), int(arg[1]))
        elif kind in ("AT", "ASSERT", "ASSERT_NOT"):
            continue  # takes no character; its condition is left to the verification
        else:
            one = SOMETHING
        out = then(out, one)
    return out


def trigram_query(pattern: str) -> list[list[str]]:
    """OR of ANDs of trigrams that the lower-cased text of a match must hold; empty
    if the pattern has no mandatory trigram. Letter case never matters, so flags
    for it need not be read."""
    query = known(re._parser.parse(pattern)).open().query
    return [] if frozenset() in query else sorted(sorted(ts) for ts in query)
