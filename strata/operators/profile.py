"""Dataset profiles, quartiles, outliers, numeric summaries and reports.

Per-column statistics are computed long-format: the frame is unpivoted to
(column, value) and aggregated twice (per value, then per column) with
partial aggregation, so distinct counts and top values never need a
per-column in-memory set and a hot value is combined map-side.  Exact
medians/quartiles use the rank brackets of ``stats``.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from strata.functions.columns import with_scalars
from strata.functions.numeric import cents, money_avg, money_sum, ratio_round
from strata.operators.stats import median_row, medians, one_row, quantiles, ranked


def _numeric(df: DataFrame, cols: list[str]) -> list[str]:
    return [c for c in cols if isinstance(df.schema[c].dataType, T.NumericType)]


def _long(df: DataFrame, cols: list[str]) -> DataFrame:
    pairs = F.array(*[F.struct(F.lit(c).alias("column"), F.col(c).cast("string").alias("v")) for c in cols])
    return df.select(F.inline(pairs))


def profile_columns(df: DataFrame, include_medians: bool = True) -> DataFrame:
    """Per non-metadata column: dtype, null count/%, distinct count and, for
    numeric columns, mean/std (2 dp), min, max, median."""
    cols = [c for c in df.columns if not c.startswith("_")]
    spark = df.sparkSession
    per_value = _long(df, cols).groupBy("column", "v").agg(F.count(F.lit(1)).alias("n"))
    counts = per_value.groupBy("column").agg(
        F.coalesce(F.sum(F.when(F.col("v").isNull(), F.col("n"))), F.lit(0)).alias("null_count"),
        F.count("v").alias("unique_count"), F.sum("n").alias("_rows"))
    meta = spark.createDataFrame([(c, df.schema[c].dataType.simpleString()) for c in cols],
                                 "column string, dtype string")
    out = meta.join(counts, "column").withColumn(
        "null_pct", ratio_round(F.col("null_count") * 100, F.col("_rows"), 2)).drop("_rows")
    nums = _numeric(df, cols)
    if nums:
        wide = df.agg(*[x for c in nums for x in (
            F.round(F.avg(c), 2).alias(f"{c}__mean"), F.round(F.stddev_samp(c), 2).alias(f"{c}__std"),
            F.min(c).cast("double").alias(f"{c}__min"), F.max(c).cast("double").alias(f"{c}__max"))])
        stats = wide.select(F.inline(F.array(*[F.struct(
            F.lit(c).alias("column"), F.col(f"{c}__mean").alias("mean"), F.col(f"{c}__std").alias("std"),
            F.col(f"{c}__min").alias("min"), F.col(f"{c}__max").alias("max")) for c in nums])))
        if include_medians:
            stats = stats.join(medians(df, nums), "column", "left")
        out = out.join(stats, "column", "left")
    return out


def top_values(df: DataFrame, k: int = 5) -> DataFrame:
    """Top-k most frequent values of every string column (ties → smaller value)."""
    cols = [c for c in df.columns if not c.startswith("_") and isinstance(df.schema[c].dataType, T.StringType)]
    g = _long(df, cols).where(F.col("v").isNotNull()).groupBy("column", "v").agg(F.count(F.lit(1)).alias("count"))
    w = Window.partitionBy("column").orderBy(F.col("count").desc(), F.col("v"))
    return (g.withColumn("rank", F.row_number().over(w)).where(F.col("rank") <= k)
            .select("column", F.col("v").alias("value"), "count", "rank"))


def column_quartiles(df: DataFrame, columns: list[str] | None = None) -> DataFrame:
    """Anomaly context for all (or the named) columns: nulls, distinct, mean/std
    (2 dp), min/max and exact linear-interpolation q25/q75 for numeric ones."""
    cols = columns or [c for c in df.columns if not c.startswith("_")]
    prof = profile_columns(df.select(*cols), include_medians=False).drop("null_pct")
    nums = _numeric(df, cols)
    if not nums:
        return prof.withColumns({"q25": F.lit(None).cast("double"), "q75": F.lit(None).cast("double")})
    return prof.join(quantiles(df, nums, {"q25": 0.25, "q75": 0.75}), "column", "left")


def iqr_outliers(df: DataFrame, column: str, k: float = 1.5) -> DataFrame:
    """Rows outside [q1 - k·IQR, q3 + k·IQR] of ``column``, with the fences."""
    q = quantiles(df, [column], {"_q1": 0.25, "_q3": 0.75}).select("_q1", "_q3")
    d = with_scalars(df, q.agg(F.max("_q1").alias("_q1"), F.max("_q3").alias("_q3")))
    iqr = F.col("_q3") - F.col("_q1")
    d = d.withColumns({"lower_fence": F.col("_q1") - k * iqr, "upper_fence": F.col("_q3") + k * iqr})
    c = F.col(column).cast("double")
    low, high = c < F.col("lower_fence"), c > F.col("upper_fence")
    return (d.where(low | high).drop("_q1", "_q3")
            .withColumn("outlier_side", F.when(low, F.lit("low")).otherwise(F.lit("high"))))


def numeric_summary(df: DataFrame) -> DataFrame:
    nums = _numeric(df, [c for c in df.columns if not c.startswith("_")])
    wide = df.agg(*[x for c in nums for x in (
        F.round(F.sum(c).cast("double"), 2).alias(f"{c}__sum"), F.round(F.avg(c), 2).alias(f"{c}__mean"),
        F.min(c).cast("double").alias(f"{c}__min"), F.max(c).cast("double").alias(f"{c}__max"))])
    return wide.select(F.inline(F.array(*[F.struct(
        F.lit(c).alias("column"), F.col(f"{c}__sum").alias("sum"), F.col(f"{c}__mean").alias("mean"),
        F.col(f"{c}__min").alias("min"), F.col(f"{c}__max").alias("max")) for c in nums])))


def completeness_report(df: DataFrame) -> DataFrame:
    """overall completeness % (all columns) and null % of non-metadata columns with nulls."""
    cols = df.columns
    wide = df.agg(F.count(F.lit(1)).alias("_n"), *[F.count_if(F.col(c).isNull()).alias(f"_z{i}")
                                                   for i, c in enumerate(cols)])
    total_nulls = sum((F.col(f"_z{i}") for i in range(len(cols))), F.lit(0))
    cells = F.col("_n") * len(cols)
    rows = [F.struct(F.lit("overall_completeness_pct").alias("metric"), F.lit(None).cast("string").alias("column"),
                     ratio_round((cells - total_nulls) * 100, cells, 2).alias("value"))]
    for i, c in enumerate(cols):
        if not c.startswith("_"):
            rows.append(F.struct(F.lit("null_pct").alias("metric"), F.lit(c).alias("column"),
                                 ratio_round(F.col(f"_z{i}") * 100, F.col("_n"), 2).alias("value")))
    return (wide.select(F.inline(F.array(*rows)))
            .where((F.col("metric") == "overall_completeness_pct") | (F.col("value") > 0)))


def trend(df: DataFrame, value_col: str, order_col: str) -> DataFrame:
    """Mean of the second half vs the first half of rows in ``order_col`` order
    (unique); > +5 % increasing, < -5 % decreasing, else stable; < 2 rows →
    insufficient_data.  The split point is an exact order statistic, so no
    global sort or single-partition window is needed."""
    x = df.where(F.col(value_col).isNotNull()).select(F.col(value_col).alias("_v"), F.col(order_col).alias("_o"))
    half = {"split": {"_split": lambda n: F.greatest(F.floor(n / 2), F.lit(1))}}
    split = one_row(ranked(x, ["_o"], half), ["_split"])
    first = F.col("_o") <= F.col("_split")
    a = with_scalars(x, split).agg(F.count(F.lit(1)).alias("n"), F.avg(F.when(first, F.col("_v"))).alias("f"),
                                   F.avg(F.when(~first, F.col("_v"))).alias("s"))
    pct = F.when(F.col("n") > 1, (F.col("s") - F.col("f")) / F.greatest(F.col("f"), F.lit(1.0)) * 100)
    return a.select(F.when(F.col("n") < 2, "insufficient_data").when(pct > 5, "increasing")
                    .when(pct < -5, "decreasing").otherwise("stable").alias("trend"),
                    F.round(pct, 4).alias("change_pct"))


def business_report(df: DataFrame, amount_col: str, order_col: str, date_col: str,
                    category_col: str | None = "category", top: int = 5) -> DataFrame:
    """Long-format daily-business report: (section, metric, num_value, text_value)
    plus the template narrative.  One aggregation, the order statistics and the
    trend are one-row frames; nothing is read on the driver."""
    amount = F.col(amount_col)
    s = df.agg(money_sum(amount).alias("total"), money_avg(amount).alias("average"),
               F.count(F.lit(1)).alias("records"), F.min(date_col).cast("string").alias("from_"),
               F.max(date_col).cast("string").alias("to_"))
    middle = median_row(df.select(cents(amount).alias("c")), "c")
    s = with_scalars(with_scalars(s, middle), trend(df, amount_col, order_col).select("trend"))
    twice = F.col("low") + F.col("high")
    median = (F.signum(twice) * F.floor((F.abs(twice) + 1) / 2)).cast("double") / 100.0
    money = lambda c: F.format_number(F.coalesce(F.col(c), F.lit(0.0)), 2)
    narrative = F.concat(
        F.lit("Total revenue for the period: $"), money("total"), F.lit(" (average: $"), money("average"),
        F.lit("). Trend: "), F.col("trend"), F.lit(". Total records processed: "), F.format_number("records", 0),
        F.lit("."))
    none, text = F.lit(None).cast("double"), F.lit(None).cast("string")

    def row(section: str, metric: str, num: Column, txt: Column) -> Column:
        return F.struct(F.lit(section).alias("section"), F.lit(metric).alias("metric"), num.alias("num_value"),
                        txt.alias("text_value"))
    head = s.select(F.inline(F.array(
        row("revenue_summary", "total", F.col("total"), text),
        row("revenue_summary", "average", F.col("average"), text),
        row("revenue_summary", "median", median, text),
        row("revenue_summary", "trend", none, F.col("trend")),
        row("volume_metrics", "total_records", F.col("records").cast("double"), text),
        row("volume_metrics", "date_range_start", none, F.col("from_")),
        row("volume_metrics", "date_range_end", none, F.col("to_")),
        row("narrative", "summary", none, narrative))))
    if category_col and category_col in df.columns:
        cats = (df.groupBy(category_col).agg(money_sum(amount).alias("num_value"))
                .orderBy(F.col("num_value").desc(), F.col(category_col)).limit(top)
                .select(F.lit("top_categories").alias("section"), F.col(category_col).alias("metric"),
                        "num_value", F.lit(None).cast("string").alias("text_value")))
        head = head.unionByName(cats)
    return head


def schema_info(df: DataFrame, samples: int = 3) -> DataFrame:
    """Per column: dtype, non-null and null counts, distinct count and the
    first ``samples`` distinct non-null values in ascending order."""
    cols = list(df.columns)
    spark = df.sparkSession
    per_value = _long(df, cols).groupBy("column", "v").agg(F.count(F.lit(1)).alias("n"))
    counts = per_value.groupBy("column").agg(
        F.coalesce(F.sum(F.when(F.col("v").isNotNull(), F.col("n"))), F.lit(0)).alias("non_null"),
        F.coalesce(F.sum(F.when(F.col("v").isNull(), F.col("n"))), F.lit(0)).alias("null_count"),
        F.count("v").alias("unique_count"))
    w = Window.partitionBy("column").orderBy(F.col("v"))
    firsts = (per_value.where(F.col("v").isNotNull()).withColumn("_r", F.row_number().over(w))
              .where(F.col("_r") <= samples)
              .groupBy("column").agg(F.array_join(F.sort_array(F.collect_list("v")), " | ").alias("sample_values")))
    meta = spark.createDataFrame([(c, i + 1, df.schema[c].dataType.simpleString()) for i, c in enumerate(cols)],
                                 "column string, position int, dtype string")
    return meta.join(counts, "column").join(firsts, "column", "left")
