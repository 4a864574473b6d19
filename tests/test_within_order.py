"""Ranks of a transaction's rows where they lie by order: same flags and rows, and no shuffle of their own."""

import random

from pyspark.sql import functions as F

from strata.operators import rules as V
from strata.plans import bindings as B
from strata.plans import medallion as M

from conftest import SF_SMALL


def test_flags_within_an_order_are_the_same(spark):
    rnd = random.Random(3)
    rows = [(o, rnd.choice([f"{o}-1", f"{o}-2", None, ""]), rnd.choice([1, 2, None]), rnd.choice("xy"), rnd.choice("pq"))
            for o in (rnd.randrange(60) for _ in range(600))]
    df = spark.createDataFrame(rows, "o long, k string, a int, b string, c string").repartition(5, "o")
    there = V.with_duplicate_flag(df, "k", ["k", "a"], within=["o"])
    assert there._jdf.queryExecution().executedPlan().toString().count("Exchange ") == 1  # the test's own
    want = V.with_duplicate_flag(df, "k", ["k", "a"])
    key = lambda d: sorted(map(repr, map(tuple, d.collect())))
    assert key(there) == key(want) and there.where("_dup").count() > 100


def test_rows_are_ranked_where_the_join_left_them(spark):
    raw, within = B.raw_erp_by_order(spark, SF_SMALL)
    assert within == [B.ORDER]
    # without broadcasts, as on large tables: the rows lie by order key after the join
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", -1)
    try:
        joined = raw._jdf.queryExecution().executedPlan().toString().count("Exchange hashpartitioning")
        for df in (V.validate_transactions(raw, list(M.RAW_COLUMNS), within),
                   M.int_cleaned(M.stg_transactions(raw, within=within), within)):
            assert df._jdf.queryExecution().executedPlan().toString().count("Exchange hashpartitioning") == joined
            assert B.ORDER not in df.columns
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")


def test_hot_join_keys_keep_the_way_for_hot_keys(spark):
    raw, within = B.raw_erp_by_order(spark, SF_SMALL, hot_rows=200)
    assert within == [B.ORDER]  # no key in more than 200 rows of the whole tables
    import tempfile
    to = tempfile.mkdtemp(prefix="run-", dir="/tmp")
    for t in ("orders", "part", "customer", "nation", "region"):
        spark.read.parquet(f"{SF_SMALL}/{t}.parquet").write.parquet(f"{to}/{t}.parquet")
    li = spark.read.parquet(f"{SF_SMALL}/lineitem.parquet").limit(300)
    li.withColumn("l_orderkey", F.lit(1).cast("bigint")).write.parquet(f"{to}/lineitem.parquet")
    raw, within = B.raw_erp_by_order(spark, to, hot_rows=200)
    assert within == [] and B.ORDER not in raw.columns


def test_dead_letters_of_one_date_are_written_where_they_are(spark, monkeypatch):
    import datetime as dt

    from pyspark.sql import DataFrame

    from strata.session import scratch_path
    from strata.sources import sinks as SK
    monkeypatch.setattr(DataFrame, "hint", lambda *a: (_ for _ in ()).throw(AssertionError("rows are shuffled")))
    rows = spark.createDataFrame([(str(i), "bad") for i in range(50)], "transaction_id string, _error string").repartition(3)
    path = scratch_path(spark, "rejected")
    SK.write_dead_letter(rows, path, dt.datetime(2024, 1, 31, 12))
    back = spark.read.parquet(path)
    assert back.count() == 50 and [str(r[0]) for r in back.select("reject_date").distinct().collect()] == ["2024-01-31"]
