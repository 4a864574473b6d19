"""SimHash: fingerprints and groups against a plain all-pairs version."""

import random

import pyarrow.parquet as pq
import pytest
import xxhash

from strata.llm.queries import QUERIES
from strata.llm.simhash import compare, fingerprints, keep_one, links, simhash_groups

from llm_helpers import SF_SMALL


def brute_fp(text, k=4):
    words = (text or "").encode().lower().split()
    if not words:
        return 0
    grams = [b" ".join(words[i:i + k]) for i in range(max(1, len(words) - k + 1))]
    hashes = [xxhash.xxh64_intdigest(g, seed=42) for g in grams]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def brute_components(ids, fps, radius=4):
    parent = dict.fromkeys(ids)

    def find(x):
        while parent[x] is not None:
            x = parent[x]
        return x
    for i, a in enumerate(ids):
        for j in range(i):
            if bin(fps[i] ^ fps[j]).count("1") <= radius:
                x, y = sorted((find(a), find(ids[j])))
                if x != y:
                    parent[y] = x
    return {i: find(i) for i in ids}


def test_query_matches_all_pairs(spark):
    rows = pq.read_table(f"{SF_SMALL}/documents.parquet").to_pylist()
    ids, fps = [r["doc_id"] for r in rows], [brute_fp(r["text"]) for r in rows]
    comp = brute_components(ids, fps)
    got = QUERIES["op1_simhash_dedup"](spark, SF_SMALL).collect()
    assert sorted(tuple(r)[:3] for r in got) == sorted((i, f"{f:016x}", comp[i]) for i, f in zip(ids, fps))
    assert any(comp[i] != i for i in ids)


def test_tiles_lose_no_link(spark):
    rnd = random.Random(1)
    fps = []
    for _ in range(150):
        f = rnd.getrandbits(64)
        fps += [f, f ^ 1 << rnd.randrange(64)]
    for _ in range(60):  # a chain of near fingerprints and a dense group
        f ^= 1 << rnd.randrange(64)
        fps.append(f)
    fps = sorted(set(fps))
    df = spark.createDataFrame([(i, f - (1 << 64) if f >> 63 else f) for i, f in enumerate(fps)], "node long, fp long")
    from strata.llm.common import Scratch
    from strata.llm.components import components
    s = Scratch(spark)
    got = {r["node"]: r["component"] for r in components(s, links(s, df, 4, tile=16)).collect()}
    want = brute_components(list(range(len(fps))), fps)
    assert {i: got.get(i, i) for i in want} == want
    assert len(compare(__import__("numpy").array(fps, "uint64"), None, 4)) < len(fps)


@pytest.mark.parametrize("schema", ["doc_id long, text string", "doc_id long, text string, fp string, node string, a int"])
def test_odd_rows(spark, schema):
    extra = (None,) * (schema.count(",") - 1)
    rows = [(1, None), (2, ""), (3, "  \t\n"), (4, "One two"), (4, "One two"), (5, "one TWO "), (None, "one two"),
            (6, "x " * 50_000)]
    got = [tuple(r) for r in simhash_groups(spark.createDataFrame([r + extra for r in rows], schema)).collect()]
    comp = {}
    for i, fp, c in got:
        comp.setdefault(i, []).append((fp, c))
    assert comp[1] == comp[2] == comp[3] == [(0, 1)]
    assert len(comp[4]) == 2 and comp[4][0] == comp[4][1] == comp[5][0] == comp[None][0]
    assert simhash_groups(spark.createDataFrame([], schema)).collect() == []
    assert fingerprints(spark.createDataFrame([], schema)).collect() == []


def test_keep_one_loses_no_unlike_text(spark):
    schema = "doc_id long, text string, n_chars long, fp int, mark int, node int"
    unlike = ["red apples fall in the garden at dawn", "ships sail north under a heavy sky tonight",
              "the council voted against the new bridge plan"]
    rows = [(None, t) for t in unlike] + [(None, unlike[0])] + [(7, t) for t in unlike[:2]]
    rows += [(9, "one more text that nobody else has written"), (7, "a second text under seven, of its own words")] * 2
    rows += [(4, None), (3, ""), (None, None)]
    kept = keep_one(spark.createDataFrame([(i, t, 5, 1, 2, 3) for i, t in rows], schema))
    got = sorted(((r["doc_id"], r["text"]) for r in kept.collect()), key=str)
    want = [(None, t) for t in unlike] + [(9, rows[6][1]), (7, rows[7][1]), (None, None)]
    assert got == sorted(want, key=str) and len(kept.columns) == 6
    assert keep_one(spark.createDataFrame([], schema)).collect() == []
