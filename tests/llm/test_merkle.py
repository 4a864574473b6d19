"""Merkle fingerprints: next documents, edited texts and likeness against plain Python."""

import hashlib
import random
import re

import pyarrow.parquet as pq
from pyspark.sql import functions as F

from strata.llm.merkle import compare_edits, differences, fingerprints, paragraphs, root
from strata.llm.queries import QUERIES

from llm_helpers import SF_SMALL


def leaves(fp):
    return set(re.findall(r"[0-9A-F]{8}", fp.split(":")[1]))


def like(a, b):
    x, y = leaves(a), leaves(b)
    if a.split(":")[0] == b.split(":")[0]:
        return 1.0
    return 2 * len(x & y) / (len(x) + len(y)) if x or y else 0.0


def places(a, b):
    """(section, paragraph, first unequal leaf) by comparing every paragraph of two fingerprints."""
    if a.split(":")[0] == b.split(":")[0]:
        return []
    x, y = ([re.findall("[0-9A-F]{8}", p) for p in re.split("[,;]", f.split(":")[1])[:-1]] for f in (a, b))
    out = []
    for i in range(max(len(x), len(y))):
        if i >= min(len(x), len(y)):
            out.append((i // 8, i, 0))
        elif x[i] != y[i]:
            same = [p == q for p, q in zip(x[i], y[i])]
            out.append((i // 8, i, same.index(False) if False in same else len(same)))
    return out


def check(rows, docs):
    """docs: (doc_id, text) with unique ids."""
    docs = sorted(docs, key=lambda d: (d[0] is not None, d[0] or 0))
    got = {r["doc_id"]: r for r in rows}
    assert len(got) == len(rows) == len(docs)
    for (i, t), (j, nxt) in zip(docs, docs[1:] + docs[:1]):
        t, nxt, r = t or "", nxt or "", got[i]
        k = len(t) // 4
        edited = t[:len(t) - k] + nxt[:k]
        assert r["n_chars"] == len(t) and r["edited_sha256"] == hashlib.sha256(edited.encode()).hexdigest(), i
        assert r["near_next"] == like(r["fingerprint"], got[j]["fingerprint"])
        assert r["near_edited"] == like(r["fingerprint"], r["edited_fingerprint"])
        assert (r["fingerprint"] == r["edited_fingerprint"]) == (t == edited)
        assert [tuple(x) for x in r["edited_at"]] == places(r["fingerprint"], r["edited_fingerprint"])
    by = {}
    for i, t in docs:
        assert by.setdefault(got[i]["fingerprint"], t or "") == (t or "")
    assert len(by) == len({t or "" for _, t in docs})
    return got


def test_query(spark):
    rows = pq.read_table(f"{SF_SMALL}/documents.parquet").to_pylist()
    got = check(QUERIES["op5_merkle_fingerprints"](spark, SF_SMALL).collect(), [(r["doc_id"], r["text"]) for r in rows])
    near = sum(r["near_edited"] for r in got.values()) / len(got)
    far = sum(r["near_next"] for r in got.values()) / len(got)
    assert near > 0.6 and far < 0.1


def test_many_buckets(spark):
    from strata.llm import merkle
    rnd = random.Random(4)
    ids = rnd.sample(range(-10**12, 10**12), 500) + [None]
    docs = [(i, "".join(rnd.choice("ab. \né🎉") for _ in range(rnd.randrange(0, 300)))) for i in ids]
    df = spark.createDataFrame(docs, "doc_id long, text string")
    keep, merkle.with_next.__defaults__ = merkle.with_next.__defaults__, (1000,)
    try:
        check(compare_edits(df).collect(), docs)
    finally:
        merkle.with_next.__defaults__ = keep


def test_odd_rows(spark):
    schema = "doc_id long, text string, n_chars string, paras int, next_text int, tags string"
    more = ("x", 1, 2, "y")
    make = lambda rows: spark.createDataFrame([r + more for r in rows], schema)
    docs = [(1, None), (2, ""), (3, "no end " * 40_000), (4, "a\n\nb."), (5, "a\n\nb.")]
    check(compare_edits(make(docs)).collect(), docs)
    twice = compare_edits(make([(1, "same text here. And more."), (1, "same text here. And more."), (2, None)])).collect()
    assert [r["near_next"] for r in twice if r["doc_id"] == 1].count(1.0) == 1
    assert compare_edits(make([])).collect() == []
    assert compare_edits(make([(None, "abc"), (None, None)])).count() == 2
    assert fingerprints(make([(1, None)])).columns == [c.split()[0] for c in schema.split(", ")] + ["fingerprint"]


def test_differences_locate_edits(spark):
    lines = [f"line {i} holds some words. And another sentence." for i in range(40_000)]
    edited = list(lines)
    edited[3] = "line 3 holds some words. But another sentence."
    edited[20_001] = "gone"
    short = lines[:17]
    texts = [("\n".join(lines), "\n".join(edited)), ("\n".join(lines[:20]), "\n".join(short)),
             ("a. b. ", "a. b. c."), ("", ""), ("", "x"), ("x\n", "x")]
    df = spark.createDataFrame(texts, "a string, b string")
    for c in "ab":
        df = df.withColumn(c + "p", paragraphs(F.col(c))).withColumn(c + "r", root(F.col(c), F.col(c + "p")))
    got = [[tuple(x) for x in r[0]] for r in df.select(
        differences(F.col("ar"), F.col("ap"), F.col("br"), F.col("bp"))).collect()]
    assert got[0] == [(0, 3, 1), (2500, 20_001, 0)]
    assert got[1] == [(2, 17, 0), (2, 18, 0), (2, 19, 0)]
    assert got[2:] == [[(0, 0, 2)], [], [(0, 0, 0)], [(0, 1, 0)]]
