"""Recompression: removed words against a dictionary of all windows."""

import hashlib
import random
from collections import Counter

import numpy as np
import pytest
import pyarrow.parquet as pq

from strata.llm import recompress
from strata.llm.queries import QUERIES
from strata.llm.recompress import anchors, remove_repeats, repeats, rounds

from llm_helpers import SF_SMALL


def brute(docs, w=20, keep=False):
    """docs: (doc_id, text) in order; {doc_id: (n_words, n_removed, kept)}; keep: the new text, None if unchanged."""
    seen, out = {}, {}
    for i, t in docs:
        words = (t or "").encode().split()
        cut = set()
        for s in range(len(words) - w + 1):
            if seen.setdefault(tuple(words[s:s + w]), (i, s)) != (i, s):
                cut.update(range(s, s + w))
        kept = b" ".join(x for k, x in enumerate(words) if k not in cut)
        out[i] = (len(words), len(cut), hashlib.sha256(kept).hexdigest())
        if keep:
            out[i] = kept.decode() if cut else None
    return out


def got(rows):
    return {r["doc_id"]: (r["n_words"], r["n_removed"], r["kept_sha256"]) for r in rows}


def test_query(spark):
    docs = sorted((r["doc_id"], r["text"]) for r in pq.read_table(f"{SF_SMALL}/documents.parquet").to_pylist())
    want = brute(docs)
    assert got(QUERIES["op6_recompression_dedup"](spark, SF_SMALL).collect()) == want
    assert sum(v[1] for v in want.values()) > 1000


def test_planted(spark):
    rnd = random.Random(8)
    vocab = [f"w{i}" for i in range(40)]
    text = lambda n: [rnd.choice(vocab) for _ in range(n)]
    passage, docs = text(70), []
    for i in range(120):
        t = text(rnd.randrange(0, 90))
        a = rnd.randrange(0, 60)
        t += passage[a:a + rnd.randrange(10, 60)] + text(rnd.randrange(0, 40))
        if i % 5 == 0:  # runs and periods
            t += ["a"] * rnd.randrange(15, 60) + ["b", "c"] * rnd.randrange(8, 30) + text(3)
        docs.append((i * 7 - 300, rnd.choice([" ", "\n", " \t "]).join(t)))
    docs += [(1000 + i, docs[i][1]) for i in range(20)]
    df = spark.createDataFrame(docs, "doc_id long, text string").repartition(7)
    assert got(repeats(df).collect()) == brute(docs)
    assert got(repeats(df, window=5).collect()) == brute(docs, 5)


def test_equal_windows_share_anchors():
    rnd = np.random.default_rng(1)
    h = rnd.integers(0, 4, 3000).astype(np.uint64)
    h[500:800] = h[2000:2300]
    doc, first, end = np.repeat([0, 1], 1500), np.array([0, 1500]), np.array([1500, 3000])
    starts = np.concatenate((np.arange(0, 1481), np.arange(1500, 2981)))
    names, _ = anchors(rounds(h, doc, first, end), starts, 20, 3000)
    by = {}
    for s, n in zip(starts, names):
        assert by.setdefault(h[s:s + 20].tobytes(), n) == n


def test_odd_rows(spark):
    schema = "doc_id long, text string, lang string, places string, n_chars long, tag int, bucket int"
    line = " ".join(f"x{i}" for i in range(25))
    rows = [(1, None), (2, ""), (3, line), (3, line), (4, line + " tail"), (None, "a " * 30), (5, "   ".join("ab")),
            (6, "é " * 60_000), (7, line), (7, line + " other")]
    make = lambda r: spark.createDataFrame([(i, t, "en", "p", 5, 1, 2) for i, t in r], schema)
    res = [(r["doc_id"], r["n_words"], r["n_removed"]) for r in repeats(make(rows)).collect()]
    assert Counter(res) == Counter([(1, 0, 0), (2, 0, 0), (3, 25, 0), (3, 25, 0), (4, 26, 25), (None, 30, 29),
                                    (5, 3, 0), (6, 60_000, 59_999), (7, 25, 25), (7, 26, 25)])
    kept = remove_repeats(make(rows))
    assert kept.columns == make(rows).columns and kept.count() == len(rows)
    texts = {r["doc_id"]: (r["text"], r["n_chars"]) for r in kept.collect()}
    assert texts[4] == ("tail", 4) and texts[3] == (line, 5) and texts[1] == (None, 5) and texts[6] == ("é", 1)
    assert repeats(make([])).collect() == [] and remove_repeats(make([])).collect() == []


def test_hot_anchor_is_split(spark, monkeypatch):
    rnd = random.Random(4)
    docs = []
    for i in range(60):  # one word everywhere: distinct windows around few names
        t = [w for _ in range(40) for w in ("der", f"w{rnd.randrange(300)}")]
        docs.append((i, " ".join(t + (docs[i - 7][1].split()[5:40] if i % 3 == 2 and i > 7 else []))))
    df = spark.createDataFrame(docs, "doc_id long, text string").repartition(5)
    want = brute(docs)
    assert got(repeats(df).collect()) == want
    monkeypatch.setattr(recompress, "HOT_WINDOWS", 20)
    monkeypatch.setattr(recompress, "LEAST_COUNT", 2)
    size = sum(len(t) for _, t in docs)
    hot = recompress.hot_anchors(recompress.keyed(df), size, 20)
    assert len(hot[0]) and hot[1].max() > 2
    assert got(repeats(df).collect()) == want

    def windows(hot_):  # of the hottest anchor, by bucket
        rows = recompress._batch([i for i, _ in docs], [0] * len(docs), [t for _, t in docs], 20, 1000, hot_)
        name, out = hot[0][hot[1].argmax()] >> np.uint64(32), Counter()
        for r in rows:
            if r["group"] >= 0:
                f = recompress._fields([r["blob"]], (8, 8, 4, 4, 4, 0))
                n, k = (recompress._unpacked(f[j], t) for j, t in ((3, "i4"), (4, "u4")))
                out[r["group"]] += int(n[k == name].sum())
        return +out

    whole, split = windows((hot[0][:0], hot[1][:0])), windows(hot)
    assert len(whole) == 1 and len(split) > 2 and max(split.values()) < max(whole.values())
    assert sum(split.values()) == sum(whole.values())


def test_texts_of_one_id_are_told_apart(spark):
    import xxhash

    line = " ".join(f"w{i}" for i in range(25))
    seen, pair = {}, None
    for i in range(400_000):  # two texts whose hashes share their low 31 bits
        text = f"{i} {line}"
        if (other := seen.setdefault(xxhash.xxh64_intdigest(text, 42) & 0x7FFFFFFF, text)) != text:
            pair = other, text
            break
    for ident in (None, 5):
        df = spark.createDataFrame([(ident, t) for t in pair], "doc_id long, text string")
        assert sorted(r["n_removed"] for r in repeats(df).collect()) == [0, 25]


@pytest.mark.parametrize("window", [300, 1000])
def test_long_windows(spark, window):
    rnd = random.Random(window)
    own = lambda n: [f"v{rnd.randrange(50)}" for _ in range(n)]
    shared = own(window + 7)
    docs = [(i, " ".join(own(rnd.randrange(500)) + shared[:window - 1 + 4 * (i % 3)] + own(100))) for i in range(5)]
    docs += [(8, " ".join(["a"] * 1500)), (9, " ".join(["a"] * 1500))]
    df = spark.createDataFrame(docs, "doc_id long, text string")
    assert got(repeats(df, window).collect()) == brute(docs, window)


def test_one_passage_in_a_third_of_the_documents(spark):
    passage = " ".join(f"p{i}" for i in range(30))
    docs = spark.range(30_000).selectExpr("id AS doc_id", f"CASE WHEN id % 3 = 0 THEN concat('a', id, ' {passage} b', id) "
                                          "ELSE concat('c', id, ' d', id) END AS text").repartition(8)
    removed = {r["doc_id"]: r["n_removed"] for r in repeats(docs).collect()}
    assert removed[0] == 0 and all(removed[i] == (30 if i and i % 3 == 0 else 0) for i in range(30_000))


def test_texts_reach_the_workers_by_the_operators_own_batches(spark, capsys):
    docs = spark.createDataFrame([(1, " ".join(f"w{i}" for i in range(40))), (2, None)], "doc_id long, text string")
    out = recompress.repeats(docs)
    out.explain()
    assert "MapInArrow" not in capsys.readouterr().out  # done before the caller's settings matter
    assert sorted((r.doc_id, r.n_words, r.n_removed) for r in out.collect()) == [(1, 40, 0), (2, 0, 0)]
