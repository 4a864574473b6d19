"""Quotient filters and collocations against plain counting."""

import re
from collections import Counter, defaultdict

import numpy as np
import pytest

from strata.llm import quotient
from strata.llm.collocations import collocations

from llm_helpers import docs_of

COLS = ("lang", "rank", "phrase", "a", "l", "r", "n", "score")


@pytest.mark.parametrize("width", [1, 2])
def test_permutation_is_inverted(width):
    rng = np.random.default_rng(width)
    keys = [rng.integers(0, 1 << 64, 5000, np.uint64, endpoint=False) for _ in range(width)]
    keys = [np.append(k, [np.uint64(0), np.uint64(2 ** 64 - 1)]) for k in keys]
    there = quotient.permute(keys)
    assert all((a == b).all() for a, b in zip(quotient.restore(there), keys))
    assert any((a != b).any() for a, b in zip(there, keys))


@pytest.mark.parametrize("width", [1, 2])
@pytest.mark.parametrize("shard_bits", [0, 3, 8, 13])
def test_filters_lose_nothing(width, shard_bits):
    rng = np.random.default_rng(7)
    want, filters = Counter(), defaultdict(list)
    for size in (1, 3, 700, 5000):
        raw = [rng.integers(0, 900, size).astype(np.uint64) for _ in range(width)]
        times = rng.choice([1, 2, 254, 255, 256, 10 ** 12], size)
        for *k, n in zip(*raw, times):
            want[tuple(map(int, k))] += int(n)
        keys, counts = quotient.combine(quotient.permute(raw), times)
        for shard, blob in quotient.shards(keys, counts, shard_bits):
            filters[shard].append(quotient.unpack(blob, shard))
    got = {}
    for parts in filters.values():
        keys, counts = quotient.merge(parts)
        assert (np.diff(keys[0].astype(object)) >= 0).all()
        got |= dict(zip(zip(*(k.tolist() for k in quotient.restore(keys))), counts.tolist()))
    assert got == want


def brute(docs, least, longest=4, top=2000):
    f, n = defaultdict(Counter), Counter()
    for _, text, lang, *_ in docs:
        lang = "und" if lang is None else lang
        low = re.sub("[A-Z]", lambda m: m.group().lower(), text or "")
        for piece in re.split(r"[.,;:!?\x0A-\x0D]", low):
            w = re.findall(r"[^\x20\x09]+", piece)
            n[lang] += len(w)
            for m in range(1, longest + 1):
                f[lang].update(tuple(w[i:i + m]) for i in range(len(w) - m + 1))
    out = []
    for lang, c in f.items():
        cand = {p: a for p, a in c.items() if len(p) > 1 and a >= least}
        rows = []
        for p, a in cand.items():
            score, k = min((2000000 * a // (c[p[:k]] + c[p[k:]]), k) for k in range(1, len(p)))
            longer = (b for q, b in cand.items() if len(q) > len(p)
                      and any(q[i:i + len(p)] == p for i in range(len(q) - len(p) + 1)))
            if not any(100 * b >= 80 * a for b in longer):
                rows.append((-score, -a, " ".join(p).encode(), p, a, c[p[:k]], c[p[k:]], score))
        out += [(lang, i, " ".join(p), a, left, right, n[lang], score)
                for i, (*_, p, a, left, right, score) in enumerate(sorted(rows)[:top], 1)]
    return sorted(out)


@pytest.mark.parametrize("least,longest,top", [(2, 4, 2000), (3, 3, 5), (1, 4, 50)])
def test_against_plain_counts(spark, least, longest, top):
    rng = np.random.default_rng(least)
    words = ["a", "B", "b", "Ä", "ä", "wörd", "\x01", "x y", "1", "long" * 90, "𝒳"]
    text = lambda n: "".join(rng.choice(words) + rng.choice([" ", "  ", "\t", ". ", ",", "\n", "\r\n", " "])
                             for _ in range(n))
    docs = [(i, text(int(rng.integers(0, 60))), ["en", "de", None, "und"][i % 4], "s", 0) for i in range(60)]
    docs += [(None, None, "en", None, 1), (60, "", "xx", "s", 2), (61, " \t. ", "xx", "s", 2), docs[0], docs[0],
             (62, "the end " * 3000, "en", "s", 3), (63, "z " * 4000, None, "s", 1)]
    df = spark.createDataFrame(docs, "doc_id long, text string, lang string, source string, words int")
    df = df.withColumnRenamed("words", "id").selectExpr("*", "1 AS f", "2 AS block", "3 AS rank", "4 AS n")
    got = sorted(tuple(r[c] for c in COLS) for r in collocations(df, least, longest, top).collect())
    assert got == brute(docs, least, longest, top)


def test_empty(spark):
    rows, schema = docs_of(["one two", None, ""])
    assert collocations(spark.createDataFrame(rows, schema)).collect() == []
    empty = collocations(spark.createDataFrame([], schema))
    assert empty.columns == list(COLS) and empty.collect() == []
