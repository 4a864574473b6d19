"""Language profiles: held-out accuracy, and bound vectors against plain sums."""

import zlib

import numpy as np
import pyarrow.parquet as pq
from pyspark.sql import functions as F

from strata.llm.langid import CLASSES, DIM, identify, letter_classes, letter_vectors, trigram_vectors, trigrams
from strata.llm.queries import QUERIES

SF = "/root/testdata/sf0.01"


def test_held_out_accuracy(spark):
    lang = {r["doc_id"]: r["lang"] for r in pq.read_table(f"{SF}/documents.parquet").to_pylist()}
    rows = QUERIES["op7_hyperdimensional_langid"](spark, SF).collect()
    assert len(rows) == len(lang)
    for r in rows:
        assert r["held_out"] == (zlib.crc32(str(r["doc_id"]).encode()) % 4 == 2) and 0 <= r["score"] <= 1
    test = [r for r in rows if r["held_out"] and lang[r["doc_id"]]]
    assert sum(r["lang_pred"] == lang[r["doc_id"]] for r in test) / len(test) > 0.97


def test_binding():
    code = trigrams("Abc")
    k = [0, *(letter_classes()[ord(c)] for c in "abc"), 0]
    assert code.tolist() == [(int(k[i]) * CLASSES + int(k[i + 1])) * CLASSES + int(k[i + 2]) for i in range(3)]
    v = letter_vectors()
    want = np.roll(v[k[1]], 2) * np.roll(v[k[2]], 1) * v[k[3]]
    assert (trigram_vectors(code)[1] == want).all() and want.shape == (DIM,)
    assert trigrams("a  1-2 b").tolist() == trigrams("A b").tolist()
    assert not len(trigrams("12 !?")) and not len(trigrams(None))


def test_odd_rows(spark):
    schema = "doc_id long, text string, lang string, held_out string, score string"
    make = lambda rows: spark.createDataFrame([r + ("x", "y") for r in rows], schema)
    rows = [(1, "the cat and the dog", "en"), (2, "der hund und die katze", "de"), (2, "der hund und die katze", "de"),
            (3, None, "en"), (4, "123 !!", "de"), (5, "", None), (None, "und die", None), (6, "the and " * 60_000, None)]
    got = identify(make(rows), F.lit(False)).collect()
    by = {r["doc_id"]: r["lang_pred"] for r in got}
    assert len(got) == len(rows)
    assert by == {1: "en", 2: "de", 3: "und", 4: "und", 5: "und", None: "de", 6: "en"}
    assert identify(make([]), F.lit(False)).collect() == []
    assert {r["lang_pred"] for r in identify(make(rows), F.lit(True)).collect()} == {"und"}
