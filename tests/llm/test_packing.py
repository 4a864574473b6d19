"""Packing: fillings against brute force, and whole coverage of every document's ids."""

import itertools
import random
import zlib
from collections import defaultdict

import numpy as np
import public_tokenizers as P
import pyarrow.parquet as pq
from tokenizers import Tokenizer

from strata.llm.packing import fullest, pack_documents, plan
from strata.llm.queries import QUERIES

from llm_helpers import SF_SMALL

PATH = P.path("byte_bpe_50k.json")


def test_fullest_is_optimal():
    rnd = random.Random(5)
    for _ in range(200):
        counts = {rnd.randrange(1, 20): rnd.randrange(1, 4) for _ in range(rnd.randrange(1, 5))}
        room = rnd.randrange(0, 40)
        got = fullest(counts, room)
        best = max(s for c in itertools.product(*(range(n + 1) for n in counts.values()))
                   if (s := sum(a * b for a, b in zip(c, counts))) <= room)
        assert sum(k * v for k, v in got.items()) == best
        assert all(v <= counts[k] for k, v in got.items())


def test_plan_uses_every_piece_once():
    rnd = random.Random(6)
    counts = {rnd.randrange(1, 2049): rnd.randrange(1, 1000) for _ in range(300)} | {2048: 10}
    used = defaultdict(int)
    total = padding = 0
    for filling, times in plan(counts):
        size = sum(k * v for k, v in filling.items())
        assert 0 < size <= 2048
        total, padding = total + size * times, padding + (2048 - size) * times
        for k, v in filling.items():
            used[k] += v * times
    assert dict(used) == counts and padding < 0.03 * total
    assert plan({}) == []


def test_ids_are_those_of_the_tokenizers_library():
    from test_bpe import ODD

    from strata.llm.packing import _encoder
    t, encode, rnd = Tokenizer.from_file(PATH), _encoder(PATH), random.Random(9)
    texts = ODD + ["<|endoftext|>", "a <|endoftext|>b", "<|endoftext| >"]
    texts += ["".join(rnd.choice(" \n\tabthe 'sé1.日  ") for _ in range(rnd.randrange(80))) for _ in range(500)]
    for x in texts:
        assert encode(x).tolist() == t.encode(x, add_special_tokens=False).ids, x


def check_cover(rows, texts):
    t = Tokenizer.from_file(PATH)
    by_doc, by_seq = defaultdict(list), defaultdict(list)
    for r in rows:
        by_doc[r["doc_id"]].append(r)
        by_seq[r["sequence_id"]].append(r)
    assert set(by_doc) == set(texts)
    for doc, own in by_doc.items():
        ids = t.encode(texts[doc] or "", add_special_tokens=False).ids + [1]
        at = 0
        for r in sorted(own, key=lambda r: r["start"]):
            assert r["start"] == at and r["doc_tokens"] == len(ids) and r["length"] > 0
            at += r["length"]
            assert zlib.crc32(np.array(ids[r["start"]:at], "<u4").tobytes()) == r["ids_crc32"]
        assert at == len(ids)
    slack = 0
    for own in by_seq.values():
        at = 0
        for r in sorted(own, key=lambda r: r["offset"]):
            assert r["offset"] == at
            at += r["length"]
        assert at <= 2048
        slack += 0 if at & at - 1 == 0 else 2048 - at
    return slack, sum(r["length"] for r in rows)


def test_query(spark):
    texts = {r["doc_id"]: r["text"] for r in pq.read_table(f"{SF_SMALL}/documents.parquet").to_pylist()}
    slack, total = check_cover(QUERIES["op2_slack_packing"](spark, SF_SMALL).collect(), texts)
    assert slack < 0.02 * total


def test_odd_rows(spark):
    schema = "doc_id long, text string, start string, length int, number int, offset string"
    more = (None, 1, 2, "x")
    texts = {1: None, 2: "", 3: "word " * 30_000, 4: "a b"}
    df = spark.createDataFrame([(k, v) + more for k, v in texts.items()], schema)
    check_cover(pack_documents(df, PATH).collect(), texts)
    same = spark.createDataFrame([(7, "same text") + more] * 50 + [(None, "x") + more], schema)
    got = pack_documents(same, PATH).collect()
    assert len(got) == 51 and len({(r["sequence_id"], r["offset"]) for r in got}) == 51
    assert pack_documents(spark.createDataFrame([], schema), PATH).collect() == []
