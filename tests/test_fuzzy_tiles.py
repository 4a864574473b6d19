"""Fuzzy links by pairs of chunks: every chunk size finds the same pairs, and no token is shuffled."""

import random
import tempfile

import numpy as np

from strata.operators import dedup as D
from strata.plans.registry import QUERIES


def sets(text):
    return {text[i:i + 2] for i in range(len(text) - 1)} or {text}


def alike(a, b):
    return len(sets(a) & sets(b)) / len(sets(a) | sets(b))


def rows(n=160):
    rnd = random.Random(5)
    out = [(0, "", "x"), (1, "b", "x"), (2, "b", ""), (3, "large 😀😀", "y")]
    for i in range(4, n):
        out.append((i, "large" + "".join(rnd.choice("abc😀é ") for _ in range(rnd.randrange(12))).rstrip(), rnd.choice(["ring", "rings", ""])))
    return out


def test_chunks_of_any_size_find_the_same_pairs(spark):
    data = rows()
    df = spark.createDataFrame(data, "id long, name string, kind string")
    reps = D.fuzzy_reps(df, ["name"], "id", collapse=False)
    for t in (0.4, 0.85):
        want = {(a, b) for a, x, _ in data for b, y, _ in data if a < b and x[:5] == y[:5] and alike(x, y) >= t}
        for chunk in (3, 1000):
            got = [(r["_a"], r["_b"]) for r in D.fuzzy_candidates(reps, ["name"], t, chunk).collect()]
            assert len(got) == len(set(got)) and set(got) == want and want


def test_two_key_columns_take_the_mean(spark):
    data = rows(60)
    df = spark.createDataFrame(data, "id long, name string, kind string")
    reps = D.fuzzy_reps(df, ["name", "kind"], "id", collapse=False)
    blk = lambda r: (r[1][:5], r[2][:5])
    want = {(a[0], b[0]) for a in data for b in data if a[0] < b[0] and blk(a) == blk(b)
            and (alike(a[1], b[1]) + alike(a[2], b[2])) / 2 >= 0.6}
    got = {(r["_a"], r["_b"]) for r in D.fuzzy_candidates(reps, ["name", "kind"], 0.6, 5).collect()}
    assert got == want and want


def test_tokens_are_packed_and_stay_where_they_are(spark):
    for text in ("", "b", "large 😀😀", "a" * 50):
        assert (D._unpack(D._pack(D._tokens(text))) == D._tokens(text)).all()
    assert D._overlaps([np.array([1, 2, 9])], [np.array([2, 9, 11]), np.array([3])], columns=1).tolist() == [[2, 0]]
    df = spark.createDataFrame(rows(), "id long, name string, kind string")
    plan = D.fuzzy_candidates(D.fuzzy_reps(df, ["name"], "id"), ["name"], 0.85)._jdf.queryExecution().optimizedPlan().toString()
    assert "explode" not in plan.lower() and "_tk_name" not in plan


def test_query_lists_every_pair_of_rows_with_copies(spark):
    names = ["large ring", " Large RING", "large rings", "large bolt", "small bolt", None, "", "b"]
    data = [(i % 90 if i % 30 else None, names[i % len(names)]) for i in range(120)]  # ids repeat or are null
    where = tempfile.mkdtemp(prefix="strata-parts-", dir="/tmp")
    spark.createDataFrame(data, "p_partkey long, p_name string").write.parquet(f"{where}/part.parquet")
    plain = [(i, (x or "").strip().lower()) for i, x in data if i is not None]
    want = sorted((a, b, alike(x, y)) for a, x in plain for b, y in plain
                  if a < b and x[:5] == y[:5] and alike(x, y) >= 0.5)
    df = QUERIES["fuzzy_pairs"](spark, where)
    assert df.columns == ["a_partkey", "b_partkey", "similarity"]
    assert sorted(tuple(r) for r in df.collect()) == want and len(want) > 1000


def test_pairs_leave_a_group_some_at_a_time(spark, monkeypatch):
    data = [(i, f"large {'ab'[i % 2]}") for i in range(60)]
    reps = D.fuzzy_reps(spark.createDataFrame(data, "id long, name string"), ["name"], "id", collapse=False)
    found = lambda: sorted(tuple(r) for r in D.fuzzy_candidates(reps, ["name"], 0.6, 16).collect())
    whole = found()
    monkeypatch.setattr(D, "_CELLS", 50)
    assert found() == whole == [(a, b, 1.0 if (b - a) % 2 == 0 else 5 / 7) for a in range(60) for b in range(a + 1, 60)]
