"""Order statistics: exact against Python, ties and pairs of ranks included."""

import random
import statistics
from decimal import Decimal

import numpy as np
import pytest
from pyspark.sql import functions as F

from strata.operators import profile as P
from strata.operators.stats import GRID, medians, one_row, quantiles, ranked


@pytest.fixture(scope="module")
def frame(spark):
    rnd = random.Random(1)
    rows = [(rnd.gauss(0, 100), 7.0, rnd.choice([1.0, 2.0, 2.0, 3.0]), None) for _ in range(5000)]
    return rows, spark.createDataFrame(rows, "a double, tied double, few double, none double")


def test_medians_and_quantiles(frame):
    rows, df = frame
    med = {r["column"]: r["median"] for r in medians(df, ["a", "tied", "few", "none"]).collect()}
    assert med == {c: statistics.median(r[i] for r in rows) for i, c in enumerate(["a", "tied", "few"])}
    got = quantiles(df, ["a", "few"], {"q25": 0.25, "q75": 0.75, "q0": 0.0, "q1": 1.0}).collect()
    for r in got:
        x = [row[0 if r["column"] == "a" else 2] for row in rows]
        assert np.allclose([r["q25"], r["q75"], r["q0"], r["q1"]], np.quantile(x, [0.25, 0.75, 0, 1]))


@pytest.mark.parametrize("rounds", [1, 2, 3])
def test_every_rank(spark, rounds):
    rnd = random.Random(rounds)
    xs = [rnd.choice([rnd.randrange(60), rnd.randrange(10 ** 6), 7]) for _ in range(3000)]
    df = spark.createDataFrame([(x,) for x in xs] + [(None,)] * 50, "x int").repartition(5)
    ks = sorted({*rnd.sample(range(1, 3001), 40), 1, 2, 2999, 3000})
    found = ranked(df, ["x"], {f"g{k}": {str(k): (lambda n, k=k: F.lit(k))} for k in ks}, rounds=rounds)
    assert [(r["rank"], r["value"], r["total"]) for r in found.orderBy("rank").collect()] == \
        [(k, sorted(xs)[k - 1], 3000) for k in ks]


@pytest.mark.parametrize("rounds", [1, 2])
def test_large_column_against_numpy(spark, rounds):
    df = spark.range(400_000).select((F.xxhash64("id") % 1_000_003).cast("double").alias("v"),
                                     F.when(F.col("id") % 3 == 0, F.lit(5.0)).otherwise(F.col("id") * 1.0).alias("w"))
    got = {r["column"]: r for r in quantiles(df, ["v", "w"], {"a": 0.01, "b": 0.5, "c": 0.999}).collect()}
    pdf = df.toPandas()
    for c in ("v", "w"):
        assert np.allclose([got[c]["a"], got[c]["b"], got[c]["c"]], np.quantile(pdf[c], [0.01, 0.5, 0.999]))


def test_brackets_hold_under_a_hundredth(spark, tmp_path):
    """What pass 2 groups by value is below 1 % of the rows."""
    from strata.operators import stats

    df = spark.range(200_000).select((F.xxhash64("id") % 10 ** 9).alias("x"))
    seen = []
    real = stats.materialize
    stats.materialize = lambda d, name: seen.append(real(d, name)) or seen[-1]
    try:
        ranked(df, ["x"], stats.MEDIAN, rounds=1).collect()
        ranked(df, ["x"], stats.MEDIAN, rounds=2).collect()
    finally:
        stats.materialize = real
    held = []
    for b in (seen[0], seen[2]):
        r = b.first()["b0"]
        held.append(df.where((F.col("x") >= r["low"]) & (F.col("x") <= r["high"])).count())
    assert held[0] < 200_000 / 100 and held[1] < held[0] / 20 + 50 and GRID == 256


def test_odd_columns(spark):
    none = spark.createDataFrame([], "x int")
    assert one_row(ranked(none, ["x"], {"g": {"m": lambda n: n}}), ["m"]).collect() == [(None,)]
    big = spark.createDataFrame([(Decimal(x),) for x in (10 ** 30, 10 ** 30 + 1, 10 ** 30 + 1, -1)],
                                "x decimal(38,0)")
    found = ranked(big, ["x"], {"g": {str(k): (lambda n, k=k: F.lit(k)) for k in (1, 2, 3)}})
    assert [int(r["value"]) for r in found.orderBy("rank").collect()] == [-1, 10 ** 30, 10 ** 30 + 1]
    days = spark.sql("SELECT date_add(DATE'2020-01-01', CAST(id AS INT)) AS d, timestamp_seconds(id) AS t FROM range(999)")
    assert str(ranked(days, ["d"], {"g": {"m": lambda n: F.lit(500)}}).first()["value"]) == "2021-05-14"
    assert ranked(days, ["t"], {"g": {"m": lambda n: F.lit(500)}}).first()["value"].second == 499 % 60


def test_statistics_read_nothing_on_the_driver():
    import inspect

    from strata.operators import kpi, stats
    for module in (stats, kpi, P):
        assert ".collect(" not in inspect.getsource(module) and ".first(" not in inspect.getsource(module)


def test_more_than_ten_columns(spark):
    df = spark.createDataFrame([tuple(range(14)), tuple(range(1, 15))], [f"c{i}" for i in range(14)])
    rows = P.column_quartiles(df).collect()
    assert len(rows) == 14 and all(r["q25"] is not None for r in rows)


def test_money_sums_beyond_bigint(spark):
    from strata.functions.numeric import money_avg, money_sum
    df = spark.range(4).select(F.lit(9e16).alias("v"))
    assert tuple(df.agg(money_sum(F.col("v")), money_avg(F.col("v"))).first()) == (3.6e17, 9e16)


def test_outliers_of_a_planted_column(spark):
    df = spark.createDataFrame([(float(i % 10),) for i in range(100)] + [(1000.0,), (-1000.0,)], "v double")
    got = {(r["v"], r["outlier_side"]) for r in P.iqr_outliers(df, "v").collect()}
    assert got == {(1000.0, "high"), (-1000.0, "low")}
