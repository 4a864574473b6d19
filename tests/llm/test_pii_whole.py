"""Personal data: the trees learn from every candidate of every document, and no candidate is left out for its length."""

import random
from collections import Counter
from functools import partial

import numpy as np
import pyarrow as pa

from strata.llm import boosting, pii


def alike(a, b):
    return all((x == y).all() for s, t in zip(a.trees, b.trees, strict=True) for x, y in zip(s, t, strict=True))


def test_every_candidate_of_a_text_is_an_example():
    text = "1 2 3 4 5 6 7, " * 3000  # 20,000 was the most
    assert sum(y == 0 for y, _ in pii.examples(text, 0)) == len(pii.candidates(text)) > 60_000
    held = list(pii.counted([text, None, "x@y.z"], [1, 2, None], most=1))
    assert len(held) > 1 and sum(sum(c.values()) for c in held) == sum(
        1 for t in (text, "", "x@y.z") for _ in pii.examples(t, 0))


def test_every_document_gives_examples(spark):
    n = 45_000  # of more than 40,000 every other one was read
    docs = spark.range(n).selectExpr("id AS doc_id", "concat('call 555-123-', 1000 + id % 9000, ' now') AS text")
    got = pii._found(docs).selectExpr("sum(n) AS n", "sum(n0) AS a", "sum(n1) AS b", "sum(n2) AS c").first()
    assert got["n"] == n * len(list(pii.examples("call 555-123-4567 now", 0))) == got["a"] + got["b"] + got["c"]
    assert max(got[1:]) < 1.2 * min(got[1:])


def test_examples_are_counted_as_the_texts_have_them(spark):
    rnd = random.Random(4)
    texts = [rnd.choice(["x@y.example", "10.0.0.1", "+1 (389) 555-5010", "ref 12 34 56 78", "4111 1111 1111 1111", None])
             for _ in range(60)]
    want = Counter((y, *map(float, x)) for i, t in enumerate(texts) for y, x in pii.examples(t or "", i))
    rows = pii._found(spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")).collect()
    got = {(r["y"], *np.frombuffer(r["x"])): r["n"] for r in rows}
    assert got == want and len(got) == len(rows)
    assert all(r["kind"] == int(np.frombuffer(r["x"])[0]) and r["n"] == r["n0"] + r["n1"] + r["n2"]
               and max(r["n0"], r["n1"], r["n2"]) - min(r["n0"], r["n1"], r["n2"]) <= 1 for r in rows)


def test_cuts_are_the_quantiles_of_all_examples(spark):
    rng = np.random.default_rng(3)
    x = np.stack([rng.integers(0, 200, 900), rng.integers(0, 3, 900), np.full(900, 5)], axis=1).astype(np.float64)
    n = rng.integers(1, 6, 900)
    rows = [(0, int(i % 2), bytearray(x[i].tobytes()), int(n[i])) for i in range(900)]
    got = pii._cuts(spark.createDataFrame(rows, "kind int, y int, x binary, n long"), np.ones((4, 2)))
    whole, last = np.sort(np.repeat(x, n, axis=0), axis=0), int(n.sum()) * 10 ** 9 - 1  # an example weighs 10**9
    assert len(got) == 3
    for f, cuts in enumerate(got):
        assert cuts.tolist() == sorted({whole[k * last // 32 // 10 ** 9, f] for k in range(32)})


def test_tasks_grow_the_trees_that_arrays_give(spark):
    rng = np.random.default_rng(1)
    x = rng.integers(0, 9, (3000, 3)).astype(np.float64)
    y = ((x[:, 0] > 4) ^ (x[:, 2] > 2)).astype(np.int64)
    cuts = [np.arange(9.0)] * 3
    code, w, base = boosting.binned(x, cuts), rng.random((2, 3000)), np.array([0.0, 0.3])
    rows = [(bytearray(code[i].tobytes()), int(y[i]), float(w[0, i]), float(w[1, i])) for i in range(3000)]

    def read(t: pa.Table) -> boosting.Examples:
        return boosting.Examples(np.frombuffer(b"".join(t["code"].to_pylist()), np.uint8).reshape(-1, 3),
                                 t["y"].to_numpy(), np.stack([t["a"].to_numpy(), t["b"].to_numpy()]), base)

    table = spark.createDataFrame(rows, "code binary, y long, a double, b double").repartition(5)
    there, _ = boosting.grow(boosting.spread(table, read), cuts, base, rounds=4)
    here, _ = boosting.grow(boosting.Examples(code, y, w, base).sums, cuts, base, rounds=4)
    assert all(map(alike, here, there)) and not alike(here[0], here[1])
    # a row that stands for five weighs as five rows
    five = boosting.fit(np.repeat(x, 5, axis=0), np.repeat(y, 5), np.ones(15_000), rounds=4)
    once = boosting.fit(x, y, np.full(3000, 5.0), rounds=4)
    assert np.abs(five.probability(x) - once.probability(x)).max() < 1e-6


def test_many_distinct_examples_are_learnt_from_by_tasks(spark, monkeypatch):
    rnd = random.Random(6)
    make = lambda i: rnd.choice([f"mail ab{i}@mail{i % 9}.example.com", f"host 10.{i % 200}.3.{i % 90}",
                                 f"+1 (389) 555-{1000 + i}", f"ref {i} {i * 7} 2019 12"])
    docs = spark.createDataFrame([(i, make(i)) for i in range(400)], "doc_id long, text string")
    monkeypatch.setattr(boosting, "grow", partial(boosting.grow, rounds=6))
    here, there = pii.fit(docs), pii.fit(docs, alone=0)
    assert here.thresholds == there.thresholds and here.thresholds and alike(here.trees, there.trees)


def test_long_stretches_and_names_are_proposed_whole():
    for text, kind, wanted in [
            ("card 4 - 1 - 1 - 1 - 1 - 1 - 1 - 1 - 1 - 1 - 1 - 1 - 1 - 1 - 1 - 1 now", "card",
             "4 - 1 - 1 - 1 - 1 - 1 - 1 - 1 - 1 - 1 - 1 - 1 - 1 - 1 - 1 - 1"),
            ("10...0...0...1 (((((((((((((((((((((((((((((((((((( 5", "ip", "10...0...0...1"),
            ("1___2___3___4___5___6___7___8___9___0___1___2 ", "phone", "1___2___3___4___5___6___7___8___9___0___1___2"),
            ("x at a dot b dot c dot d dot e dot f dot example", "email", "x at a dot b dot c dot d dot e dot f dot example")]:
        assert wanted in [text[a:b] for a, k, b in pii.candidates(text) if k == kind], text
    assert len(pii.candidates("1 " + "( " * 20_000 + "1")) < 20_000
    long = "12" + "0" * 6000  # more digits than int() takes from a string
    assert pii.features(f"a{long}@b.c", (0, "email", 6007))[21] is False
