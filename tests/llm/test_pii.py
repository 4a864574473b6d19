"""Personal data: the base against the plain patterns, added spans, redaction."""

import hashlib
import random
import re
from collections import Counter

import numpy as np
import pyarrow.parquet as pq

from strata.llm import boosting
from strata.llm.pii import _Taken, KINDS, base_spans, candidates, fit, find, redact, redacted
from strata.llm.queries import QUERIES

from llm_helpers import SF_SMALL

PATTERNS = {"email": r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+",
            "ip": r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)", "card": r"[0-9]([\x20-]?[0-9])+",
            "phone": r"\+[0-9][\x20().0-9-]+[0-9]"}


def plain(text):
    out = []
    for k, (kind, pattern) in enumerate(PATTERNS.items()):
        for m in re.finditer(pattern, text):
            d = re.sub("[^0-9]", "", m.group())
            luhn = sum(sum(map(int, str(int(c) * (1 + i % 2)))) for i, c in enumerate(reversed(d))) % 10 == 0
            if (kind == "email" or kind == "ip" and all(int(p) <= 255 for p in m.group().split("."))
                    or kind == "card" and 14 <= len(d) <= 19 and luhn or kind == "phone" and 10 <= len(d) <= 15):
                out.append((m.start(), k, m.end()))
    return [(a, KINDS[k], b) for a, k, b in sorted(out)]


def test_base_is_the_plain_patterns():
    rnd = random.Random(7)
    bits = ["a", "b.c", "@", "@@", ".", "..", "-", "+", "+1", " ", "(", ")", "9", "255", "256", "10.0.0.1", "x@y.z",
            "4111111111111111", "4111 1111-1111 1111", "+1 (389) 555-5010", "é", "\n", "00", "1.2.3.4.5.6.7.8", "0001"]
    for _ in range(4000):
        t = "".join(rnd.choice(bits) for _ in range(rnd.randrange(14)))
        assert base_spans(t) == plain(t), t


def test_query(spark):
    texts = {r["doc_id"]: r["text"] for r in pq.read_table(f"{SF_SMALL}/documents.parquet").to_pylist()}
    rows = QUERIES["op8_boosted_pii"](spark, SF_SMALL).collect()
    assert len(rows) == len(texts)
    for r in rows:
        base = plain(texts[r["doc_id"]] or "")
        told = [f"{k}:{a}:{b}" for a, k, b in base]
        assert r["base_sha256"] == hashlib.sha256(",".join(told).encode()).hexdigest()
        assert [r[f"n_{k}"] for k in KINDS] == [sum(c[1] == k for c in base) for k in KINDS]
        spans = [s.split(":") for s in r["spans"].split(",") if s]
        assert Counter(told) - Counter(":".join(s) for s in spans) == Counter()
        assert spans == sorted(spans, key=lambda s: (int(s[1]), KINDS.index(s[0])))


def make_text(rnd, form):
    words = ["lorem", "ipsum", "dolor", "sit", "version 3.0", "page 12", "in 2019", "cost 1,200.50", "ref 88-1203"]
    some = lambda: " ".join(rnd.choice(words) for _ in range(rnd.randrange(3, 9)))
    return f"{some()} {form} {some()}"


def test_added_spans(spark):
    rnd = random.Random(3)
    base = lambda: rnd.choice([
        f"{rnd.choice('abcd')}x{rnd.randrange(99)}@mail{rnd.randrange(9)}.example.com",
        ".".join(str(rnd.randrange(1, 255)) for _ in range(4)),
        f"+1 ({rnd.randrange(200, 999)}) 555-{rnd.randrange(1000, 9999)}"])
    rows = [(i, make_text(rnd, base()) if i % 3 else make_text(rnd, "plain")) for i in range(3000)]
    model = fit(spark.createDataFrame(rows, "doc_id long, text string"))
    assert "email" in model.thresholds and "phone" in model.thresholds
    hits = sum(any(k == "email" for _, k, _ in model.spans(make_text(rnd, f"bx{i} at mail{i % 9} dot example dot com"))[1])
               for i in range(50))
    hits += sum(any(k == "phone" for _, k, _ in model.spans(make_text(rnd, f"({300 + i}) 555-{4000 + i}"))[1])
                for i in range(50))
    wrong = sum(bool(model.spans(make_text(rnd, "plain"))[1]) for _ in range(200))
    assert hits >= 80 and wrong <= 2


def test_trees_learn_a_rule():
    rng = np.random.default_rng(0)
    x = rng.random((2000, 4))
    y = ((x[:, 0] > 0.5) ^ (x[:, 2] > 0.3)).astype(float)
    model = boosting.fit(x[:1500], y[:1500], np.ones(1500))
    assert ((model.probability(x[1500:]) > 0.5) == y[1500:]).mean() > 0.95


def test_odd_rows(spark):
    schema = "doc_id long, text string, n_chars long, spans string, y int, x int"
    long = "a" * 300_000 + " 1" * 50_000 + "@" + "b." * 30_000 + " x@y.example"
    rows = [(1, None), (2, ""), (3, "x@y.z é 10.0.0.1"), (3, "x@y.z é 10.0.0.1"), (None, "+1 (389) 555-5010"), (4, long)]
    make = lambda r: spark.createDataFrame([(i, t, 7, "s", 1, 2) for i, t in r], schema)
    got = find(make(rows)).collect()
    assert len(got) == len(rows)
    assert [r["spans"] for r in got if r["doc_id"] == 3] == ["email:0:5,ip:8:16"] * 2
    assert [r["n_email"] for r in got if r["doc_id"] == 4] == [len(plain(" x@y.example")) + len(base_spans(long)) - 1]
    red = {r["doc_id"]: (r["text"], r["n_chars"]) for r in redact(make(rows)).collect()}
    assert red[3] == ("[EMAIL] é [IP]", 14) and red[1] == (None, 7) and red[2] == ("", 7)
    assert red[None] == ("[PHONE]", 7) and redact(make(rows)).columns == make(rows).columns
    assert find(make([])).collect() == [] and redact(make([])).collect() == []
    assert redacted("abcdef", [(0, "ip", 3), (2, "card", 4)]) == "[IP]ef"
    assert candidates("") == []


def test_numbers_followed_by_numbers():
    for text, kind, wanted in [
            ("call (555) 123-4567, (555) 987-6543 now", "phone", ["(555) 123-4567", "(555) 987-6543"]),
            ("555 123 4567, 555 987 6543, 555 222 3333", "phone", ["555 123 4567", "555 987 6543", "555 222 3333"]),
            ("4111 1111 1111 1112, 12/25", "card", ["4111 1111 1111 1112"]),
            ("12 555-123-4567 2024/01/02", "phone", ["555-123-4567"]),
            ("10 . 0 . 0 . 1, 10 . 0 . 0 . 2", "ip", ["10 . 0 . 0 . 1", "10 . 0 . 0 . 2"])]:
        got = candidates(text)
        assert len(got) == len(set(got))
        assert set(wanted) <= {text[a:b] for a, k, b in got if k == kind}, text
    assert len(candidates("1 " * 50_000)) < 50_000 * 40


def test_small_table_adds_spans(spark):
    import pyarrow.parquet as pq

    model = fit(spark.read.parquet("/root/testdata/sf0.01/documents.parquet"))
    assert len(model.thresholds) >= 2, model.thresholds
    assert pq.read_table("/root/testdata/sf0.01/documents.parquet").num_rows == 1000


def test_many_spans_in_one_text():
    import time

    spans = [(i * 10, "ip", i * 10 + 7) for i in range(40_000)]
    t = time.perf_counter()
    taken = _Taken(spans[::2])
    free = [c for c in spans if not taken.overlaps(c)]
    for c in free:
        assert not taken.overlaps(c)
        taken.add(c)
    assert free == spans[1::2] and all(taken.overlaps(c) for c in spans)
    assert time.perf_counter() - t < 2


def test_look_up_against_all_spans():
    rnd = random.Random(2)
    for _ in range(300):
        spans = [(a, "x", a + rnd.randrange(1, 9)) for a in (rnd.randrange(60) for _ in range(rnd.randrange(6)))]
        taken = _Taken(spans)
        for a in range(62):
            for b in (a + 1, a + 4):
                assert taken.overlaps((a, "y", b)) == any(a < e and s < b for s, _, e in spans)
