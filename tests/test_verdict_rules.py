"""Faults found in review: duplicate flags, fuzzy chains, quality gates, strip, scratch folders."""

import datetime as dt
import random

import pytest
from pyspark.sql import functions as F

from strata.functions.columns import bigram_jaccard, blank, snake_case
from strata.operators import dedup as D
from strata.operators import quality as Q
from strata.operators import silver as S
from strata.operators.rules import blank_str, with_duplicate_flag


def test_duplicate_flag_does_not_depend_on_the_plan(spark):
    n = 20_000
    keep = {k: spark.conf.get(k) for k in ("spark.sql.autoBroadcastJoinThreshold",
                                           "spark.sql.adaptive.advisoryPartitionSizeInBytes")}
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    spark.conf.set("spark.sql.adaptive.advisoryPartitionSizeInBytes", "20k")
    spark.conf.set("spark.sql.adaptive.coalescePartitions.parallelismFirst", "false")
    try:
        left = spark.range(n).withColumn("payload", F.repeat(F.lit("x"), 200)).repartition(8)
        right = spark.range(n).select(F.col("id"), (F.col("id") * 7 % 13).alias("v")).repartition(5)
        df = left.join(right, "id").withColumn("k", F.col("id").cast("string"))
        df = df.unionByName(df.where("id % 100 = 0")).unionByName(df.where("id % 200 = 0"))
        flagged = with_duplicate_flag(df, "k", ["v"]).where("_dup")
        assert flagged.count() == n // 100 + n // 200
        assert flagged.groupBy("k").count().where("count > 2").count() == 0
    finally:
        spark.conf.unset("spark.sql.adaptive.coalescePartitions.parallelismFirst")
        for k, v in keep.items():
            spark.conf.set(k, v)


def brute_fuzzy(rows, sim, t):
    kept = []
    for i, x in rows:
        if not any(y[:5] == x[:5] and sim(x, y) >= t for _, y in kept):
            kept.append((i, x))
    return [i for i, _ in kept]


def jaccard(a, b):
    x, y = ({s[i:i + 2] for i in range(len(s) - 1)} for s in (a, b))
    return len(x & y) / len(x | y)


def test_fuzzy_chain_is_decided_to_its_end(spark):
    rnd = random.Random(4)
    alphabet = [chr(0x4E00 + i) for i in range(4000)]
    rnd.shuffle(alphabet)
    rows = [(i, "chain" + "".join(alphabet[i * 2:i * 2 + 30])) for i in range(300)]  # neighbours alike, others less
    df = spark.createDataFrame(rows, "id long, name string")
    want = brute_fuzzy(rows, jaccard, 0.75)
    assert 50 < len(want) < 250
    for alone in (100_000, 560):
        got = sorted(r["id"] for r in D.dedup_fuzzy(df, ["name"], "id", 0.75, alone=alone).collect())
        assert got == want


@pytest.mark.parametrize("hot_rows", [200_000, 1])
def test_duplicate_flag_shuffles_no_whole_rows(spark, hot_rows):
    """Ties on the first columns, copies, null and blank keys, and (hot_rows=1) keys as hot ones."""
    rnd = random.Random(3)
    pick = lambda *v: rnd.choice(v)
    rows = [(pick("k1", "k2", "k3", None, "", f"u{i}"), pick(1, 2, None), pick("x", None), pick("y", "z"),
             pick(0.5, 1.5), pick("p", "q", None), i % 7) for i in range(1500)]
    if hot_rows == 1:
        rows += [("k1", 1, "x", "y", 0.5, "p", 1)] * 300
    df = spark.createDataFrame(rows, "k string, a int, b string, c string, d double, e string, f int").repartition(5)
    got = with_duplicate_flag(df, "k", ["k", "a", "b", "c", "d"], hot_rows=hot_rows)
    least = lambda r: tuple((v is not None, v) for v in r[1:])
    want, seen = [], set()
    for r in sorted(rows, key=lambda r: (r[0] or "", least(r))):
        want.append((*r, bool(r[0]) and r[0] in seen))
        seen.add(r[0])
    assert sorted(map(repr, map(tuple, got.collect()))) == sorted(map(repr, want))
    wide = [line for line in got._jdf.queryExecution().executedPlan().toString().splitlines() if " Exchange " in line]
    assert not wide


def test_white_space_only_strings_are_blank(spark):
    df = spark.createDataFrame([("\t\n",), ("N/A\t",), (" x\t",)], "a string")
    assert [tuple(r) for r in df.select(blank(F.col("a")), blank_str(F.col("a"))).collect()] == [
        (True, True), (False, False), (False, False)]
    assert [r[0] for r in S.clean_strings(df).collect()] == [None, None, "x"]


def test_gate_fails_on_old_rows_and_empty_input(spark):
    now = dt.datetime(2024, 1, 2, 12)
    df = spark.createDataFrame([(dt.datetime(2024, 1, 1), "a"), (dt.datetime(2024, 1, 2, 6), "b")], "t timestamp, k string")
    chk = Q.QualityChecker().add_timeliness_rule("t", 48).add_uniqueness_rule(["k"]).add_completeness_rule("nowhere")
    by = {t: {r["dimension"]: (r["score"], r["gate_passed"]) for r in Q.gate(
        chk.check(df, "d", as_of=now, transition=t), t).collect()} for t in ("bronze_to_silver", "silver_to_gold")}
    assert by["bronze_to_silver"]["timeliness"] == (0.5, False) and by["silver_to_gold"]["timeliness"] == (0.0, False)
    assert by["bronze_to_silver"]["uniqueness"] == (1.0, True)
    assert by["bronze_to_silver"]["completeness"] == (0.0, False)
    empty = {r["rule_name"]: (r["score"], r["passed"]) for r in chk.check(df.limit(0), "d", as_of=now).collect()}
    assert empty["completeness_nowhere"] == (0.0, False) and empty["uniqueness_k"] == (1.0, True)
    broken = Q.QualityChecker().add_accuracy_rule("k", pattern="(")
    assert [(r["score"], r["passed"]) for r in broken.check(df, "d").collect()] == [(0.0, False)]
    assert [r["_dq_passed"] for r in broken.row_failures(df, now).collect()] == [False, False]


def test_samples_of_repeated_keys(spark):
    df = spark.createDataFrame([(i % 7,) for i in range(20)], "k int")
    got = Q.QualityChecker().add_uniqueness_rule(["k"]).sample_failures(df, 5).collect()
    assert [(r["key"], r["rows"]) for r in got] == [(f'{{"k":{i}}}', 3) for i in range(5)]


@pytest.mark.parametrize("name,want", [("customerId", "customer_id"), ("HTTPServerName", "http_server_name"),
                                       ("Total Amount", "total_amount"), ("_RunID", "_run_id"), ("a--b  c", "a_b_c"),
                                       ("x (USD)", "x_usd"), ("line2Total", "line2_total"), ("ID", "id")])
def test_snake_case(name, want):
    assert snake_case(name) == want


def test_cluster_session_needs_a_shared_folder():
    from strata import session

    class Conf:
        def get(self, *_):
            return None

    class Context:
        master = "spark://host:7077"

    class Session:
        conf, sparkContext = Conf(), Context()

    with pytest.raises(RuntimeError, match="spark.checkpoint.dir"):
        session.ensure_checkpoint_dir(Session())


def test_scope_removes_its_tables(spark):
    import os

    from strata.session import cut_lineage, drop_table, scratch_scope
    with scratch_scope(spark):
        t = cut_lineage(spark.range(5))
        path = t._strata_path
        assert t.count() == 5 and os.path.isdir(path)
    assert not os.path.exists(path)
    t = cut_lineage(spark.range(5))
    path = t._strata_path
    drop_table(t)
    assert not os.path.exists(path)


def test_bigram_similarity_of_short_strings(spark):
    df = spark.createDataFrame([("", ""), ("", "a"), ("a", "a"), ("ab", "ab")], "a string, b string")
    assert [r[0] for r in df.select(bigram_jaccard(F.col("a"), F.col("b"))).collect()] == [1.0, 0.0, 1.0, 1.0]
