"""Exact order statistics by rank brackets: nothing is collected, next to nothing is stored.

Pass 1 is one aggregate over all wanted columns: row counts and approximate quantiles on
a grid of GRID steps.  The sketch's error bound tells which two grid values surely
enclose a wanted rank; these bracket under 1 % of a column's rows.  Pass 2 counts the
rows below each bracket and, by distinct value, those inside it; a running sum over the
values inside finds the rank.  Ties collapse before the shuffle.  Where the plan's
statistics let a bracket hold more than BRACKET_ROWS rows, pass 1 is repeated inside the
brackets, which makes them a hundredth of the size each time, so no task sorts more than
about that many rows.  A rank outside its bracket raises; no value is ever guessed.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from strata.functions.columns import with_scalars
from strata.session import materialize
from strata.sources.tables import source_bytes

#: steps of the quantile grid, and the sketch's accuracy: ranks are off by rows / ACCURACY at most
GRID, ACCURACY = 256, 2048
#: values of a bracket that one task may sort, and bytes that a row of the source has at least
BRACKET_ROWS, ROW_BYTES = 50_000_000, 8

Ranks = dict[str, dict[str, Callable[[Column], Column]]]
#: group of ranks that share a bracket: label -> 1-based ascending rank, from the number of rows
MEDIAN: Ranks = {"median": {"low": lambda n: F.floor((n + 1) / 2), "high": lambda n: F.floor(n / 2) + 1}}


def _number(c: Column, kind: T.DataType) -> Column:
    """A double in the order of the value; equal values stay equal."""
    return (F.unix_date(c) if isinstance(kind, T.DateType) else c).cast("double")


def _grid(c: Column) -> Column:
    """Count, least, largest and quantiles of a double column (aggregate)."""
    return F.struct(F.count(c).alias("n"), F.min(c).alias("low"), F.max(c).alias("high"), F.percentile_approx(
        c, [i / GRID for i in range(1, GRID)], F.lit(ACCURACY)).alias("grid"))


def _bracket(s: Column, low: Column, high: Column) -> Column:
    """Values of a grid that surely enclose the ranks low to high among its rows."""
    n, slack = s["n"], 2.0 / ACCURACY
    i = F.floor((low / F.nullif(n, F.lit(0)) - slack) * GRID).cast("int")
    j = F.ceil((high / F.nullif(n, F.lit(0)) + slack) * GRID).cast("int")
    return F.struct(F.when(i < 1, s["low"]).otherwise(F.get(s["grid"], i - 1)).alias("low"),
                    F.when(j > GRID - 1, s["high"]).otherwise(F.get(s["grid"], j - 1)).alias("high"))


def rounds_for(df: DataFrame) -> int:
    """Passes of narrowing so that, by the plan's size, a bracket holds at most BRACKET_ROWS rows."""
    rows, k = source_bytes(df) // ROW_BYTES, 1
    while rows * (3 / GRID) ** k > BRACKET_ROWS and k < 4:
        k += 1
    return k


def ranked(df: DataFrame, cols: list[str], ranks: Ranks, as_type: str | None = None,
           rounds: int | None = None) -> DataFrame:
    """(column, label, rank, total, value): for each column and label the value at the
    label's rank among the column's non-null rows; columns without rows are absent.

    ``as_type`` casts the values; columns must then, or anyway, be of one type.  A label
    must be unique over all groups.  ``rounds``: passes of narrowing (None: by size)."""
    rounds = rounds or rounds_for(df)
    kind = df.schema[cols[0]].dataType
    x = df.select(*[(F.col(c).cast(as_type) if as_type else F.col(c)).alias(f"x{i}") for i, c in enumerate(cols)])
    kind = x.schema["x0"].dataType
    number = [_number(F.col(f"x{i}"), kind) for i in range(len(cols))]
    keys = [(i, g) for i in range(len(cols)) for g in ranks]
    ends = lambda i, g, n: [f(n).cast("bigint") for f in ranks[g].values()]
    first = x.agg(*[_grid(v).alias(f"s{i}") for i, v in enumerate(number)])
    edge = lambda f, r: f(*r) if len(r) > 1 else r[0]
    found = first.select(*[F.col(f"s{i}")["n"].alias(f"n{i}") for i in range(len(cols))], *[
        _bracket(F.col(f"s{i}"), edge(F.least, ends(i, g, F.col(f"s{i}")["n"])), edge(F.greatest, ends(i, g, F.col(f"s{i}")["n"])))
        .alias(f"b{k}") for k, (i, g) in enumerate(keys)])
    found = materialize(found, "brackets")  # one row

    def marked(brackets: DataFrame) -> DataFrame:
        """(key, x): the values inside each bracket, and a null for each row below it."""
        rows = F.array(*[F.struct(F.lit(k).alias("key"), F.when(number[i] >= F.col(f"b{k}.low"), F.col(f"x{i}")).alias("x"),
                                  (number[i] <= F.col(f"b{k}.high")).alias("use")) for k, (i, _) in enumerate(keys)])
        return with_scalars(x, brackets).select(F.inline(F.filter(rows, lambda r: r["use"]))).select("key", "x")

    for _ in range(rounds - 1):
        inner = marked(found).groupBy("key").agg(
            F.count_if(F.col("x").isNull()).alias("below"), _grid(_number(F.col("x"), kind)).alias("s"))
        wide = inner.agg(*[F.max(F.when(F.col("key") == k, F.struct("below", "s"))).alias(f"t{k}") for k in range(len(keys))])
        both = with_scalars(found, wide)
        found = both.select(*[f"n{i}" for i in range(len(cols))], *[
            _bracket(F.col(f"t{k}.s"), edge(F.least, ends(i, g, F.col(f"n{i}"))) - F.col(f"t{k}.below"),
                     edge(F.greatest, ends(i, g, F.col(f"n{i}"))) - F.col(f"t{k}.below")).alias(f"b{k}")
            for k, (i, g) in enumerate(keys)])
        found = materialize(found, "brackets")

    wanted = found.select(F.inline(F.array(*[
        F.struct(F.lit(k).alias("key"), F.lit(cols[i]).alias("column"), F.lit(label).alias("label"),
                 f(F.col(f"n{i}")).cast("bigint").alias("rank"), F.col(f"n{i}").alias("total"))
        for k, (i, g) in enumerate(keys) for label, f in ranks[g].items()]))).where("total > 0")
    counts = marked(found).groupBy("key", "x").agg(F.count(F.lit(1)).alias("n"))
    run = Window.partitionBy("key").orderBy(F.col("x").asc_nulls_first()).rowsBetween(
        Window.unboundedPreceding, Window.currentRow)
    counts = counts.withColumn("upto", F.sum("n").over(run))
    hit = (F.col("rank") <= F.col("upto")) & (F.col("rank") > F.col("upto") - F.col("n"))
    at = wanted.join(counts.withColumnRenamed("key", "_key"), (F.col("key") == F.col("_key")) & hit, "left")
    sure = F.when(F.col("x").isNull(), F.raise_error(F.lit("a rank fell outside its bracket")).cast(kind)).otherwise(F.col("x"))
    return at.select("column", "label", "rank", "total", sure.alias("value"))


def one_row(found: DataFrame, labels: list[str]) -> DataFrame:
    """The values of one column as a row with a field for each label (null if the column is empty)."""
    return found.agg(*[F.max(F.when(F.col("label") == k, F.col("value"))).alias(k) for k in labels])


def median_row(df: DataFrame, col: str) -> DataFrame:
    """One row with the two middle values (low, high) of a column."""
    return one_row(ranked(df, [col], MEDIAN), ["low", "high"])


def medians(df: DataFrame, cols: list[str]) -> DataFrame:
    """(column, median): the mean of the two middle values; columns without values are absent."""
    found = ranked(df, cols, MEDIAN, "double")
    pick = lambda k: F.max(F.when(F.col("label") == k, F.col("value")))
    return found.groupBy("column").agg(((pick("low") + pick("high")) / 2).alias("median"))


def quantiles(df: DataFrame, cols: list[str], probs: dict[str, float]) -> DataFrame:
    """One row per column with a field for each named probability, interpolated
    linearly between neighbouring ranks; columns without values are absent."""
    ranks: Ranks = {name: {f"{name}|low": lambda n, p=p: F.floor((n - 1) * p) + 1,
                           f"{name}|high": lambda n, p=p: F.least(F.floor((n - 1) * p) + 2, n)}
                    for name, p in probs.items()}
    found = ranked(df, cols, ranks, "double")
    pick = lambda k: F.max(F.when(F.col("label") == k, F.col("value")))
    total = F.max("total")
    out = []
    for name, p in probs.items():
        low, high = pick(f"{name}|low"), pick(f"{name}|high")
        h = (total - 1) * F.lit(p)
        out.append((low + (high - low) * (h - F.floor(h))).alias(name))
    return found.groupBy("column").agg(*out)
