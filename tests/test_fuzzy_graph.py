"""The greedy settlement of fuzzy links: chains, random graphs and the positional bound."""

import random

from pyspark.sql import functions as F

from strata.operators import dedup as D
from strata.plans.registry import QUERIES

from conftest import SF_SMALL


def greedy(edges):
    gone = set()
    for b, a in sorted((b, a) for a, b in edges):
        if a not in gone:
            gone.add(b)
    return gone


def test_long_chain_takes_few_rounds(spark, monkeypatch):
    n, writes = 20_000, []
    edges = spark.range(n).select(F.col("id").alias("_a"), (F.col("id") + 1).alias("_b"))
    cut = D.cut_lineage
    monkeypatch.setattr(D, "cut_lineage", lambda df, *a: writes.append(1) or cut(df, *a))
    gone = D.settle_greedily(cut(edges), alone=0)
    assert len(writes) < 40
    assert gone.agg(F.count("_b"), F.min("_b"), F.max("_b"), F.sum(F.col("_b") % 2)).first() == (n // 2, 1, n - 1, n // 2)


def test_graphs_equal_the_greedy_pass(spark):
    rnd = random.Random(7)
    for case in range(2):
        nodes = 120
        edges = {(i, i + 1) for i in range(0, 60)}  # a chain, then branches and merges at random
        while len(edges) < 60 + 50 * (case + 1):
            a, b = sorted(rnd.sample(range(nodes), 2))
            edges.add((a, b))
        df = spark.createDataFrame(sorted(edges), "_a long, _b long")
        got = [r["_b"] for r in D.settle_greedily(D.cut_lineage(df), alone=0).collect()]
        assert len(got) == len(set(got)) and set(got) == greedy(edges)
    empty = spark.createDataFrame([], "_a long, _b long")
    assert D.settle_greedily(D.cut_lineage(empty), alone=0).count() == 0


def test_positional_bound_loses_no_pair(spark):
    rnd = random.Random(9)
    names = sorted({"block" + "".join(rnd.choice("ab c") for _ in range(rnd.randrange(0, 9))) for _ in range(150)})
    df = spark.createDataFrame(list(enumerate(names)), "id long, name string")
    for t in (0.5, 0.8):
        reps = D.fuzzy_reps(df, ["name"], "id")
        got = {(r["_a"], r["_b"]) for r in D.fuzzy_candidates(reps, ["name"], t).collect()}
        sets = {r["_pos"]: (r["_blk"], set(r["_tk_name"])) for r in reps.collect()}
        want = {(a, b) for a, (p, x) in sets.items() for b, (q, y) in sets.items()
                if a < b and p == q and len(x & y) / len(x | y) >= t}
        assert got == want and want


def test_copies_are_members_and_not_pairs(spark):
    """Two classes of 300 copies each and a third name: 601 members and 1 link, not the 179,700 pairs of rows."""
    names = ["large ring", " Large RING", "large rings", "small bolt"]
    rows = [(i, names[i % 2]) for i in range(300)] + [(300 + i, names[2]) for i in range(300)] + [(600, names[3])]
    got = D.fuzzy_links(spark.createDataFrame(rows, "id long, name string"), "name", "id", 0.5).collect()
    assert sorted((r["a_id"], r["b_id"]) for r in got if r["kind"] == "member") == sorted(
        (0 if i < 300 else 300 if i < 600 else 600, i) for i, _ in rows)
    assert [(r["a_id"], r["b_id"], round(r["similarity"], 4)) for r in got if r["kind"] == "link"] == [(0, 300, 0.9)]


def test_daily_fact_expands_no_rows(spark):
    plan = QUERIES["fct_daily_metrics"](spark, SF_SMALL)._jdf.queryExecution().executedPlan().toString()
    assert "Expand" not in plan
