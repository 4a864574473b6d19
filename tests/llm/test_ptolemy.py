"""Ptolemaic clustering against plain rounds."""

import hashlib
import math

import numpy as np
import pytest

from strata.llm.ptolemy import Assigner, cluster_digest, integers

SCHEMA = "vec_id long, embedding array<float>, label string, cluster int, v int, d int, distance int"


def brute(rows, k, rounds, dim, scale, seed=3):
    kept = []
    for i, e in rows:
        if e is None or len(e) != dim or any(x is None or not math.isfinite(x) for x in e):
            continue
        kept.append((i, [math.floor(scale * float(np.float32(x))) for x in e]))
    key = lambda r: (hashlib.sha256(f"{seed}:{'' if r[0] is None else r[0]}".encode()).hexdigest(), r[0] is None,
                     r[0] or 0, np.array(r[1], "<i4").tobytes())
    cents = [v for _, v in sorted(kept, key=key)[:k]]
    dist = lambda a, b: sum((x - y) ** 2 for x, y in zip(a, b))
    near = lambda v: min((dist(v, c), n) for n, c in enumerate(cents))
    for _ in range(rounds):
        groups = {}
        for _, v in kept:
            groups.setdefault(near(v)[1], []).append(v)
        cents = [[sum(x) // len(groups[n]) for x in zip(*groups[n])] if n in groups else c for n, c in enumerate(cents)]
    out = [(i, *near(v)[::-1]) for i, v in kept]
    own = {c: sum(d for _, x, d in out if x == c) for c in range(k)}
    name = [hashlib.sha256(",".join(map(str, c)).encode()).hexdigest() for c in cents]
    return sorted(((i, c, d, own[c], sum(own.values()), name[c]) for i, c, d in out), key=str)


def rows_of(rng, n, dim):
    rows = [(i, rng.standard_normal(dim).astype(float).tolist()) for i in range(n)]
    rows += [(n + i, [0.001 * (i % 3)] * dim) for i in range(40)]            # ties and equal vectors
    rows += [(900, None), (901, []), (902, [1.0] * (dim + 1)), (903, [None] + [1.0] * (dim - 1)),
             (904, [float("nan")] * dim), (905, [float("inf")] + [0.0] * (dim - 1)), (906, [-0.0005] * dim)]
    return rows + [rows[0], rows[0], (None, [0.5] * dim), (None, [0.25] * dim)]


@pytest.mark.parametrize("n,k,rounds,dim", [(120, 8, 10, 64), (60, 5, 4, 3), (3, 60, 2, 2)])
def test_against_plain_rounds(spark, n, k, rounds, dim):
    rows = rows_of(np.random.default_rng(n), n, dim)
    df = spark.createDataFrame([(i, e, "x", 1, 2, 3, 4) for i, e in rows], SCHEMA)
    got = cluster_digest(df, k=k, rounds=rounds, dim=dim)
    assert sorted(map(tuple, got.collect()), key=str) == brute(rows, k, rounds, dim, 1024)


def test_empty_and_too_large(spark):
    assert cluster_digest(spark.createDataFrame([], SCHEMA)).collect() == []
    one = spark.createDataFrame([(7, [1.0] * 64)], "vec_id long, embedding array<double>")
    assert [r["distance"] for r in cluster_digest(one).collect()] == [0]
    big = spark.createDataFrame([(7, [1e9] * 64)], "vec_id long, embedding array<double>")
    with pytest.raises(Exception, match="too large"):
        integers(big, 64, 1024).collect()


def test_bounds_hold_and_skip():
    rng = np.random.default_rng(5)
    centre = rng.integers(-4000, 4000, (8, 16))
    x = (centre[rng.integers(0, 8, 4000)] + rng.integers(-300, 300, (4000, 16))).astype(np.int32)
    pivots = x[:6].astype(np.int64)
    told = Assigner(pivots, centre.astype(np.int64))
    d = np.stack([np.sqrt(((x.astype(np.int64) - p) ** 2).sum(axis=1)) for p in pivots], axis=1)
    full = ((x[:, None].astype(np.int64) - centre) ** 2).sum(axis=2)
    assert (told.bounds(d) ** 2 <= full).all()
    at, best = told.nearest(x, d)
    assert (at == full.argmin(axis=1)).all() and (best == full.min(axis=1)).all()
    assert told.checked < 0.5 * full.size  # most centroids are ruled out without a distance
