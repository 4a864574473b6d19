"""K-d tree sharding: near equal bytes, gapless slots, whole groups of copies where possible."""

import random
import zlib
from collections import Counter, defaultdict

import pyarrow.parquet as pq

from strata.llm.queries import QUERIES
from strata.llm.sharding import shard_documents

from llm_helpers import SF_SMALL


def shards_of(rows):
    out = defaultdict(list)
    for r in rows:
        out[r["shard"]].append(r)
    return out


def test_query(spark):
    docs = {r["doc_id"]: r["text"] for r in pq.read_table(f"{SF_SMALL}/documents.parquet").to_pylist()}
    rows = QUERIES["op4_kd_sharding"](spark, SF_SMALL).collect()
    assert Counter(r["doc_id"] for r in rows) == Counter(list(docs))
    for r in rows:
        raw = (docs[r["doc_id"]] or "").encode()
        assert r["size"] == len(raw) + 1 and r["text_crc32"] == zlib.crc32(raw)
        assert r["law"] == "bytes" and r["grown_shard"] is None and 0 <= r["shard"] < 16
    sizes = [sum(r["size"] for r in v) for v in shards_of(rows).values()]
    largest = max(r["size"] for r in rows)
    assert len(sizes) == 16 and max(sizes) - min(sizes) <= 4 * largest
    for v in shards_of(rows).values():
        assert sorted(r["slot"] for r in v) == list(range(len(v)))


def test_balance_and_groups(spark):
    rnd = random.Random(2)
    texts = ["".join(rnd.choice("abcé \n") for _ in range(rnd.randrange(1, 400))) for _ in range(3000)]
    texts += ["a group of copies " * 10] * 1500 + [t for t in texts[:200] for _ in range(3)]
    df = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    rows = shard_documents(df).collect()
    sizes = [sum(r["size"] for r in v) for v in shards_of(rows).values()]
    assert len(sizes) == 16 and max(sizes) / min(sizes) < 1.05
    split = defaultdict(set)
    for r in rows:
        split[texts[r["doc_id"]]].add(r["shard"])
    assert len(split["a group of copies " * 10]) > 1  # larger than a shard
    assert sum(len(v) > 1 for v in split.values()) <= 16  # others only at a cut


def test_odd_rows(spark):
    schema = "doc_id long, text string, size string, shard int, tail long, node int, d0 int"
    more = ("x", 1, 2, 3, None)
    rows = [(1, None), (2, ""), (None, "x"), (3, "long " * 100_000)] + [(4, "same")] * 20
    got = shard_documents(spark.createDataFrame([r + more for r in rows], schema)).collect()
    assert Counter(r["doc_id"] for r in got) == Counter(r[0] for r in rows)
    for v in shards_of(got).values():
        assert sorted(r["slot"] for r in v) == list(range(len(v)))
    assert shard_documents(spark.createDataFrame([], schema)).collect() == []
    by_size = shard_documents(spark.createDataFrame([(i, "x" * 99) for i in range(400)], "doc_id long, text string"),
                              target_bytes=5000).collect()
    assert len(shards_of(by_size)) == 8
