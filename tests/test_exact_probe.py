"""Exact dedup by a first pass over key hashes, and the strategies' metrics one after the other."""

import contextlib
import datetime as dt
import io

import pytest
from pyspark.sql import functions as F

from strata.functions.columns import py_strip
from strata.operators import dedup as D
from strata.plans import jobs as JB
from strata.plans import medallion as M
from strata.plans.registry import LINE_KEYS, LINE_ORDER, QUERIES

AS_OF = dt.datetime(2024, 1, 31)


def _plan(df):
    text = io.StringIO()
    with contextlib.redirect_stdout(text):
        df.explain()
    return text.getvalue()


def test_rows_with_keys_of_their_own_are_not_shuffled(spark):
    df = spark.range(1000).select(F.when(F.col("id") > 0, F.col("id")).alias("k"), F.lit("wide").alias("v"))
    out = D.dedup_exact(df, ["k"], ["v"])
    assert "Window" not in _plan(out) and "Exchange" not in _plan(out)
    assert sorted(out.collect(), key=str) == sorted(df.collect(), key=str)


def test_silver_of_a_table_without_repeats_is_not_shuffled(spark):
    rows = [tuple(f"{c}-{i}" for c in M.RAW_COLUMNS) for i in range(50)]
    s = JB.silver(spark.createDataFrame(rows, M.RAW_COLUMNS), "erp", AS_OF, M.RAW_COLUMNS)
    assert "Window" not in _plan(s) and "Exchange" not in _plan(s)
    assert s.count() == 50


@pytest.mark.parametrize("keep", ["first", "last", "most_complete"])
def test_probe_changes_no_row(spark, keep):
    rows = [(k, i % 7, None if i % 3 else f"v{i}") for i, k in enumerate(
        ["a", None, "b", "a", "", None, "c", "a", "d", ""] * 3 + ["e", "f"])] + [(None, None, None)] * 2
    df = spark.createDataFrame(rows, "k string, n int, v string")
    want = sorted(D.dedup_exact(df, ["k"], ["n", "v"], keep, probe=False).collect(), key=str)
    assert [r.k for r in want].count(None) == 1 and len(want) == 8
    for few in (0, 1, 1000):
        assert sorted(D.dedup_exact(df, ["k"], ["n", "v"], keep, few=few).collect(), key=str) == want


def test_strip_is_that_of_python(spark):
    texts = ["", " ", "a", " a", "a\t", "\na b\r", "\x0ba\x0c", "!a", "\x01a\x01", "ä ", " a", "a ", None]
    df = spark.createDataFrame([(t,) for t in texts], "t string").select("t", py_strip(F.col("t")).alias("s"))
    assert all(r.s == (r.t if r.t is None else r.t.strip(" \t\n\x0b\f\r")) for r in df.collect())


def test_dispatch_stores_the_metrics_of_each_strategy(spark, tmp_path):
    line = [(k, n, *range(6), "A", "F", AS_OF) for k, n in ((1, 1), (1, 2), (1, 2), (2, 1), (2, 1), (2, 1))]
    spark.createDataFrame(line, [*LINE_KEYS, *LINE_ORDER]).write.parquet(f"{tmp_path}/lineitem.parquet")
    hours = lambda h: AS_OF + dt.timedelta(hours=h)
    spark.createDataFrame([(1, hours(0), 7, "x"), (2, hours(23), 7, "x"), (3, hours(25), 7, "x")],
                          "event_id long, ts timestamp, user_id long, event_type string") \
        .write.parquet(f"{tmp_path}/events.parquet")
    spark.createDataFrame([(1, "a long enough text"), (2, "A long enough text "), (3, "another")],
                          "doc_id long, text string").write.parquet(f"{tmp_path}/documents.parquet")
    out = QUERIES["dedup_dispatch"](spark, str(tmp_path))
    assert "Exchange" not in _plan(out)  # a strategy's shuffles are gone before the next one runs
    got = {r.strategy: (r.total_input, r.total_output, r.duplicates_found, r.duplicates_removed) for r in out.collect()}
    assert got == {"exact": (6, 3, 5, 3), "window->exact": (6, 3, 5, 3), "window": (3, 2, 1, 1), "fuzzy": (3, 2, 1, 1)}


def test_methods_that_the_jvm_only_interprets_are_not_made(spark):
    import __spark_entry__

    __spark_entry__._prepare(spark)
    assert spark.conf.get("spark.sql.codegen.hugeMethodLimit") == "8000"
