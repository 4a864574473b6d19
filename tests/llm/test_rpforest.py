"""Random-projection forest: links and components against all pairs."""

import numpy as np
import pyarrow.parquet as pq

from strata.llm.queries import QUERIES
from strata.llm.rpforest import near_duplicates

from llm_helpers import SF_SMALL


def brute(ids, vecs, threshold=0.9):
    v = np.array(vecs, np.float64)
    v /= np.linalg.norm(v, axis=1, keepdims=True)
    hit = v @ v.T >= threshold
    np.fill_diagonal(hit, False)
    comp = np.array(ids)
    while True:
        new = np.array([min([c, *comp[h]]) for c, h in zip(comp, hit)])
        if (new == comp).all():
            return {i: (int(h.sum()), int(c), bool(i == c)) for i, h, c in zip(ids, hit, comp)}
        comp = new


def got(df):
    return {r["vec_id"]: (r["n_links"], r["component_id"], r["kept"]) for r in df.collect()}


def test_query(spark):
    rows = pq.read_table(f"{SF_SMALL}/embeddings.parquet").to_pylist()
    want = brute([r["vec_id"] for r in rows], [r["embedding"] for r in rows])
    assert got(QUERIES["op10_rp_forest_dedup"](spark, SF_SMALL)) == want


def test_recall_with_small_leaves(spark):
    rng = np.random.default_rng(3)
    base = rng.standard_normal((1500, 32))
    near = base[:500] + rng.standard_normal((500, 32)) * 0.38  # cosines around 0.9
    dense = base[:1] + rng.standard_normal((400, 32)) * 0.05
    v = np.concatenate((base, near, dense, dense[:50])).astype(np.float32)
    df = spark.createDataFrame([(i, x.tolist()) for i, x in enumerate(v)], "vec_id long, embedding array<float>")
    res = got(near_duplicates(df, leaf=128, tile=100, sample=1000))
    want = brute(list(range(len(v))), v)
    links, found = sum(w[0] for w in want.values()), sum(r[0] for r in res.values())
    assert found >= 0.98 * links and all(res[i][0] <= want[i][0] for i in want)
    assert sum(res[i] == want[i] for i in want) >= 0.95 * len(want)


def test_odd_rows(spark):
    schema = "vec_id long, embedding array<double>, label int, node string, raw string, component int"
    make = lambda rows: spark.createDataFrame([r + (1, "x", "y", 2) for r in rows], schema)
    nan, inf = float("nan"), float("inf")
    rows = [(1, [1.0, 0.0]), (2, [2.0, 0.0]), (2, [2.0, 0.0]), (3, None), (4, []), (5, [0.0, 0.0]), (6, [nan, 1.0]),
            (7, [inf, 1.0]), (8, [None, 1.0]), (9, [1.0, 0.0, 0.0]), (10, [1e300, 1e290]), (None, [0.0, 1.0])]
    res = near_duplicates(make(rows)).collect()
    assert len(res) == len(rows)
    by = {r["vec_id"]: (r["n_links"], r["component_id"], r["kept"]) for r in res}
    assert by[1] == (3, 1, True) and by[2] == (3, 1, False) and by[10] == (3, 1, False)
    assert all(by[i] == (0, i, True) for i in (3, 4, 5, 6, 7, 8, 9))
    assert by[None][0] == 0 and by[None][2]
    assert near_duplicates(make([])).collect() == []
