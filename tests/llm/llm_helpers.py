"""Small tables for the tests of this folder."""

import tempfile

SF_SMALL = "/root/testdata/sf0.001"
DOCS = "doc_id long, text string, lang string, source string, n_chars long"


def write_tables(spark, **tables):
    """Write {table: (rows, schema)} as a data folder and return its path."""
    d = tempfile.mkdtemp(prefix="strata-llm-", dir="/tmp")
    for name, (rows, schema) in tables.items():
        spark.createDataFrame(rows, schema).write.parquet(f"{d}/{name}.parquet")
    return d


def docs_of(texts, lang="en", source="s"):
    return [(i, t, lang, source, None if t is None else len(t)) for i, t in enumerate(texts)], DOCS
