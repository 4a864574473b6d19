"""Token ids of whole texts by a memo of their space-separated parts.

In the byte-level pattern of these vocabularies a match never spans a space that
stands between visible characters, other than as its own first character. A text
cut before every space that a visible character follows can therefore be encoded
part by part with the same ids. Parts repeat a lot, so each worker keeps a
bounded memo of their ids; texts with other runs of white space are cut with a
regular expression, which merges such runs into one part."""

from __future__ import annotations

import re
from collections.abc import Callable

_CUT = re.compile(r" (?=\S)")
#: entries a worker keeps, and the longest part it keeps
MEMO_ENTRIES, MEMO_CHARS = 300_000, 64


class WordMemo:
    """encode: strings to a list of id strings (little-endian unsigned 32-bit ids)."""

    def __init__(self, encode: Callable[[list[str]], list[bytes]]):
        self.encode, self.memo, self.odd = encode, {}, set()

    def ids(self, texts: list[str]) -> list[bytes]:
        if len(self.memo) > MEMO_ENTRIES:
            self.memo.clear()
        cut = [t.split(" ") for t in texts]
        firsts = [parts[0] for parts in cut]
        seen = set()
        for parts in cut:
            seen.update(parts[1:])
        self.odd = {p for p in seen if not p or p[0].isspace()}
        if self.odd:
            for i, parts in enumerate(cut):
                if not self.odd.isdisjoint(parts[1:]):
                    cut[i] = _CUT.split(texts[i])
                    firsts[i] = cut[i][0]
                    seen.update(cut[i][1:])
            seen -= self.odd
        get = self.memo
        new = [p for p in seen if p not in get]
        made = self.encode([" " + p for p in new] + firsts)
        extra = {}
        for p, b in zip(new, made):
            (get if len(p) <= MEMO_CHARS else extra)[p] = b
        if extra:
            get = {**get, **extra} if len(extra) > 1000 else _Both(get, extra)
        out = []
        for first, parts in zip(made[len(new):], cut):
            parts[0] = first
            out.append(first + b"".join([get[p] for p in parts[1:]]))
        return out


class _Both(dict):
    """The memo, and long parts that it does not keep."""

    def __init__(self, memo: dict, extra: dict):
        super().__init__(extra)
        self.memo = memo

    def __missing__(self, key):
        return self.memo[key]
