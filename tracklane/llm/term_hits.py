"""Terms of a vocabulary in a url: what tasks run of the URL filter. It reads no file, since executors may have modules only."""

from __future__ import annotations

import string
from functools import lru_cache

_ALNUM = frozenset(string.ascii_lowercase + string.digits)


@lru_cache(maxsize=4)
def automaton(strict: tuple[str, ...], soft: tuple[str, ...]):
    import ahocorasick

    out = ahocorasick.Automaton()
    for kind, terms in ((1, soft), (0, strict)):  # a term in both lists is strict
        for t in terms:
            out.add_word(t, (kind, t))
    out.make_automaton()
    return out


def hits(own, url: str | None) -> tuple[set[str], set[str]]:
    """The distinct strict and distinct soft terms of a url."""
    found: tuple[set[str], set[str]] = (set(), set())
    url = (url or "").lower()
    for end, (kind, t) in own.iter(url) if len(own) else ():
        start = end - len(t)
        if (start < 0 or url[start] not in _ALNUM) and (end + 1 == len(url) or url[end + 1] not in _ALNUM):
            found[kind].add(t)
    return found
