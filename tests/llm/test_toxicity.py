"""Toxicity: neighbours against brute force, held-out accuracy, calibration."""

import math
import zlib
from collections import Counter

import numpy as np
import pyarrow.parquet as pq
import pytest
from pyspark.sql import functions as F

from strata.llm.queries import QUERIES
from strata.llm.toxicity import BLOCK, PRIOR_WEIGHT, BlockMax, isotonic, toxicity

SF = "/root/testdata/sf0.1"


def test_held_out_accuracy(spark):
    toxic = {r["doc_id"]: r["toxic"] for r in pq.read_table(f"{SF}/labels.parquet").to_pylist()}
    rows = QUERIES["op9_knn_toxicity"](spark, SF).collect()
    assert len(rows) == pq.read_table(f"{SF}/documents.parquet").num_rows
    for r in rows:
        assert r["held_out"] == (zlib.crc32(str(r["doc_id"]).encode()) % 3 == 1)
        assert 0 <= r["score"] <= 1 and r["predicted"] == int(r["score"] >= 0.7)
    test = [(toxic[r["doc_id"]], r["predicted"]) for r in rows if r["held_out"] and r["doc_id"] in toxic]
    hit = sum(y and p for y, p in test)
    print("held out", hit, sum(y for y, _ in test), sum(p for _, p in test))
    assert hit >= 0.8 * sum(y for y, _ in test) and hit >= 0.97 * sum(p for _, p in test)


def test_nearest_is_exact_and_skips():
    rng = np.random.default_rng(1)
    rows, terms = 40 * BLOCK + 7, 400
    dense = np.zeros((rows, terms))
    for i in range(rows):  # neighbours in number share rare terms, all share the common ones
        t = np.concatenate((rng.choice(20, 3, False), 20 + (i // BLOCK * 60 + rng.choice(60, 4, False)) % 380))
        dense[i, t] = rng.random(7) * np.where(t < 20, 0.3, 3)
    dense[BLOCK - 1] = dense[3 * BLOCK]  # a tie across blocks
    dense /= np.linalg.norm(dense, axis=1, keepdims=True)
    term, row = np.nonzero(dense.T)
    index = BlockMax(np.bincount(term, minlength=terms), row, dense[row, term], rows)
    size = rng.integers(1, 4, rows)
    for q in range(0, rows, 97):
        t = np.flatnonzero(dense[q])
        own = size.copy()
        own[q] -= q % 2
        for k in (10_000, 1, 10):
            if k == 1:
                index.seen = index.scored = 0
            near, cosine = index.nearest(t, dense[q, t], k, own)
            want = dense @ dense[q]
            assert np.allclose(want[near], cosine, atol=1e-14) and (np.diff(cosine) <= 0).all()
            reach = np.cumsum(own[np.lexsort((np.arange(rows), -want))])
            last = np.sort(want)[::-1][min(np.searchsorted(reach, k), rows - 1)]
            assert set(near) == set(np.flatnonzero((want >= last - 1e-12) & (want > 0)))
    assert index.scored < 0.6 * index.seen


@pytest.mark.parametrize("by_label", [True, False])
def test_query_against_all_cosines(spark, by_label):
    """Votes, calibration, scores and evidence from a plain matrix of all vectors."""
    rng = np.random.default_rng(4)
    words = [f"w{chr(97 + i // 26)}{chr(97 + i % 26)}" for i in range(200)]
    docs = []
    for i in range(260):
        n = int(rng.integers(1, 40))
        text = [words[int(x)] for x in rng.zipf(1.3, n) % 200] + (["fool", "rotten"] if i % 4 == 0 and rng.random() < 0.9 else [])
        docs.append((i, " ".join(text)))
    docs += [(300 + i, docs[i][1]) for i in range(0, 40, 3)] + [(400, ""), (401, "unheard"), (402, None)]
    toxic = {i: int(i % 4 == 0) for i, _ in docs if i % 3 and i < 401}
    labels = spark.createDataFrame(list(toxic.items()), "doc_id long, toxic int")
    held = F.col("doc_id") % 3 == 0
    k = 7
    got = {r["doc_id"]: r for r in toxicity(spark.createDataFrame(docs, "doc_id long, text string"), labels, held, k=k,
                                            by_label=by_label).collect()}
    train = [(i, toxic[i], (t or "").split()) for i, t in docs if i in toxic]
    groups = {}
    for i, y, t in train:
        groups.setdefault(tuple(sorted(Counter(t).items())), []).append((i, y))
    empty = groups.pop((), [])
    n1, n0 = (sum(y == v for _, y, _ in train) for v in (1, 0))
    df1, df0 = Counter(), Counter()
    for _, y, t in train:
        (df1 if y else df0).update(set(t))
    idf = {}
    for t in set(df1) | set(df0):
        share = (df1[t] + df0[t]) / (n1 + n0)
        z = abs(df1[t] / n1 - df0[t] / n0) / math.sqrt(max(share * (1 - share), 1e-12) * (1 / n1 + 1 / n0))
        idf[t] = (math.log((n1 + n0 + 1) / (df1[t] + df0[t] + 1)) + 1) * (max(z, 1) if by_label else 1)

    def unit(items):
        v = {t: (1 + math.log(n)) * idf[t] for t, n in items if t in idf}
        norm = math.sqrt(sum(x * x for x in v.values()))
        return {t: x / norm for t, x in v.items()}

    vectors = [(unit(g), m) for g, m in groups.items()]
    prior = n1 / (n1 + n0)

    def vote(q, without=None):
        cosines = sorted(((sum(x * q.get(t, 0) for t, x in v.items()), min(m), [y for i, y in m if i != without], m)
                          for v, m in vectors), key=lambda c: (-c[0], c[1]))
        held_so_far, last = 0, 0.0
        for c, _, ys, _ in cosines:
            held_so_far += len(ys)
            if held_so_far >= k:
                last = c
                break
        near = [c for c in cosines if c[0] > 0 and c[0] >= last - 1e-12]
        most = max((c ** 4 for c, _, ys, _ in near if ys), default=1.0)
        up = sum(c ** 4 / most * sum(ys) for c, _, ys, _ in near)
        total = sum(c ** 4 / most * len(ys) for c, _, ys, _ in near)
        return (up + PRIOR_WEIGHT * prior) / (total + PRIOR_WEIGHT), near

    told = [(vote(v, i)[0], float(y), 1.0) for v, m in vectors for i, y in m]
    curve = isotonic(*map(np.array, zip(*sorted(told))))
    for i, text in docs:
        q = unit(Counter((text or "").split()).items()) if set((text or "").split()) & set(idf) else None
        if q is None:
            want = (sum(y for _, y in empty) + PRIOR_WEIGHT * prior) / (len(empty) + PRIOR_WEIGHT)
        else:
            want, near = vote(q)
            want = float(np.interp(want, *curve))
            assert got[i]["evidence"][0] in [j for c in near if c[0] >= near[0][0] - 1e-9 for j, _ in c[3]]
        assert abs(got[i]["score"] - want) < 1e-6, i
        assert got[i]["predicted"] == int(got[i]["score"] >= 0.7)


def test_isotonic():
    x, y = isotonic(np.array([0.1, 0.2, 0.3, 0.4]), np.array([0.0, 1.0, 0.0, 1.0]), np.ones(4))
    assert np.interp([0.1, 0.25, 0.4], x, y).tolist() == [0.0, 0.5, 1.0]


def test_odd_rows(spark):
    schema = "doc_id long, text string, score string, held_out int, toxic string, term int"
    make = lambda rows: spark.createDataFrame([r + ("x", 1, "y", 2) for r in rows], schema)
    bad, good = "you are a scoundrel today", "what a pleasant day it is"
    rows = [(i, bad if i % 2 else good + f" {i}") for i in range(60)]
    rows += [(100, None), (101, ""), (102, "Scoundrel!"), (102, "Scoundrel!"), (None, "a scoundrel"), (103, "x " * 90_000)]
    labels = spark.createDataFrame([(i, i % 2, 0) for i in range(40)] + [(0, 0, 1), (1, None, 0), (None, 1, 0), (999, 1, 1)],
                                   "doc_id long, toxic int, quality int")
    no = F.lit(False)
    got = toxicity(make(rows), labels, no).collect()
    assert len(got) == len(rows)
    for r in got:
        want = r["doc_id"] in (None, 102) or r["doc_id"] < 60 and r["doc_id"] % 2
        assert r["predicted"] == int(bool(want)), r
    assert all(len(r["evidence"]) for r in got if r["predicted"])
    assert toxicity(make([]), labels, no).collect() == []
    assert {r["score"] for r in toxicity(make(rows), labels.limit(0), no).collect()} == {0.0}


def test_all_terms_find_neighbours(spark):
    # no term here tells the labels apart: each text still has neighbours by the words that it shares
    trees, birds = ("elm", "oak", "ash", "fir", "yew", "bay", "box"), ("owl", "jay", "emu", "tit", "hen")
    rows = [(i, f"{trees[i % 7]} {birds[i % 5]}") for i in range(210)] + [(500, "fir lark")]
    labels = spark.createDataFrame([(i, int(i % 2 == 0), 0) for i in range(210)], "doc_id long, toxic int, quality int")
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    got = {r["doc_id"]: r["evidence"] for r in toxicity(docs, labels, F.col("doc_id") >= 200).collect()}
    assert all(got.values())
    assert all(j % 7 == 3 for j in got[500])
    assert all(j % 35 == 204 % 35 for j in got[204][:3])
