"""Boolean trigram queries from regular expressions.

A pattern is read as alternatives of literal runs: what every match of that alternative must
contain, in ASCII lower case. Each run gives its trigrams; an alternative asks for all of its
trigrams, the query for any of its alternatives. An alternative without a run of three characters
has no mandatory trigram, so its whole pattern must scan every text.
"""

from __future__ import annotations

import string
from re import _constants as K
from re import _parser as P

#: Alternatives that a pattern may grow to, and members of a character class that count as alternatives.
MOST_ALTERNATIVES, MOST_MEMBERS = 64, 6
#: Stands for any text inside an alternative; no pattern of ours has this character.
GAP = "\0"
_LOWER = str.maketrans(string.ascii_uppercase, string.ascii_lowercase)


def _joined(left: list[str], right: list[str]) -> list[str]:
    """Every left alternative with every right one; too many, and any text stands for the right ones."""
    both = list(dict.fromkeys(a + b for a in left for b in right))
    return both if len(both) <= MOST_ALTERNATIVES else list(dict.fromkeys(a + GAP for a in left))


def _members(items) -> list[str]:
    out = []
    for op, value in items:
        if op is K.LITERAL:
            out.append(chr(value))
        elif op is K.RANGE and value[1] - value[0] < MOST_MEMBERS:
            out += [chr(c) for c in range(value[0], value[1] + 1)]
        else:
            return []
    return out if len(out) <= MOST_MEMBERS else []


def _runs(parsed) -> list[str]:
    out = [""]
    for op, value in parsed:
        if op is K.LITERAL:
            step = [chr(value)]
        elif op is K.IN:
            step = _members(value) or [GAP]
        elif op is K.SUBPATTERN:
            step = _runs(value[-1])
        elif op is K.BRANCH:
            step = [x for branch in value[1] for x in _runs(branch)]
            step = step if len(step) <= MOST_ALTERNATIVES else [GAP]
        elif op in (K.MAX_REPEAT, K.MIN_REPEAT):
            low, high, body = value
            once = _runs(body)
            if (low, high) == (0, 1):
                step = ["", *once]
            elif low == 0:
                step = [GAP]
            else:
                step = [""]
                for _ in range(min(low, 4)):
                    step = _joined(step, once)
                if high != low or low > 4:
                    step = _joined(step, [GAP])
        elif op is K.AT:
            step = [""]
        else:
            step = [GAP]
        out = _joined(out, step)
    return out


def trigram_query(pattern: str) -> list[frozenset[str]] | None:
    """Alternatives, each a set of trigrams that must all be there; None: the rule scans fully."""
    out = set()
    for run in _runs(P.parse(pattern)):
        pieces = run.translate(_LOWER).split(GAP)
        grams = frozenset(p[i : i + 3] for p in pieces for i in range(len(p) - 2))
        if not grams or not all(g.isascii() for g in grams):
            return None
        out.add(grams)
    # An alternative that asks for more than another one is implied by it.
    return sorted((a for a in out if not any(b < a for b in out)), key=sorted)
