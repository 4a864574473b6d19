"""The pipeline's rows against plain versions of its stages."""

import pyarrow.parquet as pq
from pyspark.sql import functions as F

import corpus_pipeline as C
from strata.llm.pii import fit, redacted
from strata.llm.queries import QUERIES
from strata.llm.toxicity import toxicity

from llm_helpers import DOCS, SF_SMALL, write_tables
from test_packing import check_cover
from test_recompress import brute
from test_simhash import brute_components, brute_fp


def test_stages_against_plain_versions(spark):
    docs = spark.read.parquet(f"{SF_SMALL}/documents.parquet")
    rows = {r["doc_id"]: r["text"] for r in pq.read_table(f"{SF_SMALL}/documents.parquet").to_pylist()}
    labels = spark.read.parquet(f"{SF_SMALL}/labels.parquet")
    held = F.pmod(F.crc32(F.col("doc_id").cast("string").cast("binary")), F.lit(3)) == 1
    clean = {r["doc_id"] for r in toxicity(docs, labels, held).filter("predicted = 0").collect()}
    text = {i: rows[i] for i in sorted(clean)}
    comp = brute_components(list(text), [brute_fp(t) for t in text.values()])
    text = {i: t for i, t in text.items() if comp[i] == i}
    cut = brute(list(text.items()), keep=True)
    text = {i: cut[i] if cut[i] is not None else t for i, t in text.items()}
    frame = spark.createDataFrame(sorted(text.items()), "doc_id long, text string")
    model = fit(frame)
    text = {i: redacted(t, model.spans(t)[1]) for i, t in text.items()}
    check_cover(QUERIES["pipeline"](spark, SF_SMALL).collect(), text)


def test_columns_and_planted_cases(spark):
    long = " ".join(f"word{i}" for i in range(70))
    texts = ["an ordinary first document about trees or rivers", "An ordinary  first document about trees or rivers",
             f"one start {long} one end", f"another beginning {long} another end x@y.example",
             "you utter scoundrel and knave", None, ""]
    texts += [f"calm neighbour number {i} says {i * 7} kind words" for i in range(40)]
    texts += [f"you scoundrel and knave of sort {i}" for i in range(40)]
    rows = [(i, t, "en", "s", len(t or "")) for i, t in enumerate(texts)]
    labels = [(i, 1, int("scoundrel" in (texts[i] or ""))) for i in range(7, len(texts))]
    d = write_tables(spark, documents=(rows, DOCS), labels=(labels, "doc_id long, quality int, toxic int"))
    docs, seen = spark.read.parquet(f"{d}/documents.parquet"), []
    for name, stage in C.STAGES[:-1]:
        docs = stage(spark, docs, d)
        assert docs.columns == [c.split()[0] for c in DOCS.split(", ")], name
        seen.append({r["doc_id"]: r["text"] for r in docs.collect()})
    assert set(seen[0]) == {0, 1, 2, 3, 5, 6, *range(7, 47)}
    assert 1 not in seen[1] and {0, 2, 3, 5}.issubset(seen[1]) and 6 not in seen[1]
    assert seen[2][3] == "another beginning another end x@y.example" and seen[2][2] == texts[2]
    assert seen[3][3] == "another beginning another end [EMAIL]"


def test_empty_tables(spark):
    d = write_tables(spark, documents=([], DOCS), labels=([], "doc_id long, quality int, toxic int"))
    assert QUERIES["pipeline"](spark, d).collect() == []


def test_repeated_rows(spark):
    rows = [(1, "some text here to keep", "en", "s", 1)] * 5 + [(None, "another text of some kind", "en", "s", 2)] * 3
    d = write_tables(spark, documents=(rows, DOCS), labels=([], "doc_id long, quality int, toxic int"))
    kept = C.simhash_stage(spark, spark.read.parquet(f"{d}/documents.parquet"), d).collect()
    assert sorted(r["text"] for r in kept) == ["another text of some kind", "some text here to keep"]
