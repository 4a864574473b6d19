"""Byte-level BPE against the tiktoken library, and the round trip."""

import hashlib
import random

import numpy as np
import public_tokenizers as P
import pyarrow.parquet as pq
import pytest
import tiktoken
from hypothesis import given, settings, strategies as st

from strata.llm.bpe import codec, encode_decode, read_ranks
from strata.llm.queries import QUERIES

from llm_helpers import SF_SMALL

PATH = P.path("byte_bpe_50k.tiktoken")
ODD = ["", " ", "  ", "   a", "a  b", "a \n b", "a\n\n b ", " \t x", "x  y", "  z", "it's we'll 'S", "12 345a",
       "<|endoftext|> <unk> ▁x <s>", "é́ 日本 語 🎉🎉 \U0001F469‍\U0001F4BB", "a" * 5000, " " * 300 + "b",
       "\x00\x01\x1c \x1d", "a \x1c b", "a\u0085 b", "ſ ﬁ", "\r\n \r\n"]


@pytest.fixture(scope="module")
def tik():
    ranks = {t: i for i, t in enumerate(read_ranks(PATH))}
    return tiktoken.Encoding("own", pat_str=P.PATTERN, mergeable_ranks=ranks, special_tokens={})


def ids(text):
    return np.frombuffer(codec(PATH, P.PATTERN).encode([text])[0], "<u4").tolist()


def test_odd_texts(tik):
    for t in ODD:
        assert ids(t) == tik.encode_ordinary(t), t


def test_random_strings(tik):
    rnd = random.Random(3)
    for _ in range(400):
        t = "".join(rnd.choice(" \n\tab 'sé1.日  ") for _ in range(rnd.randrange(60)))
        assert ids(t) == tik.encode_ordinary(t), t


@settings(max_examples=150, deadline=None)
@given(st.text(max_size=80).filter(lambda s: s.isprintable() or "\n" in s))
def test_any_text(t):
    t = t.encode("utf-8", "ignore").decode()
    bpe = codec(PATH, P.PATTERN)
    assert bpe.decode(bpe.encode([t])[0]).decode() == t


def test_query(spark, tik):
    rows = pq.read_table(f"{SF_SMALL}/documents.parquet").to_pylist()
    got = {r["doc_id"]: r for r in QUERIES["op3_byte_bpe"](spark, SF_SMALL).collect()}
    assert len(got) == len(rows)
    for r in rows:
        want = np.array(tik.encode_ordinary(r["text"]), "<u4")
        g = got[r["doc_id"]]
        assert g["n_tokens"] == len(want) and g["ids_sha256"] == hashlib.sha256(want.tobytes()).hexdigest()
        assert g["decoded_sha256"] == hashlib.sha256(r["text"].encode()).hexdigest()


def test_odd_rows(spark):
    schema = "doc_id long, text string, ids string, n_tokens int"
    rows = [(1, None, "x", 1), (1, None, "x", 1), (None, "", None, None), (2, "a b " * 100_000, "", 0)]
    got = encode_decode(spark.createDataFrame(rows, schema), PATH, P.PATTERN, keep_ids=True).collect()
    assert sorted((r["doc_id"] or 0, r["n_tokens"]) for r in got)[:3] == [(0, 0), (1, 0), (1, 0)]
    assert max(got, key=lambda r: r["n_tokens"])["decoded"] == "a b " * 100_000
    assert encode_decode(spark.createDataFrame([], schema), PATH, P.PATTERN).collect() == []
