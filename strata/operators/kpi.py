"""Business KPIs over a transactions frame.

Scalar KPI groups are single global aggregations (partial aggregation on
every map task, one tiny merge).  Order statistics (median, the Pareto
head) come from rank brackets (``strata.operators.stats``); nothing
is read on the driver.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from strata.functions.columns import AMOUNT_CANDIDATES, CUSTOMER_CANDIDATES, first_present, with_scalars
from strata.functions.numeric import CENTS, cents, money_avg, money_sum, ratio_round
from strata.operators.stats import median_row, ranked
from strata.session import materialize


def amount_column(df: DataFrame, amount_col: str | None = None) -> str:
    col = amount_col or first_present(df, AMOUNT_CANDIDATES)
    if col is None:
        raise ValueError("no amount column found")
    return col


def revenue_kpis(df: DataFrame, amount_col: str | None = None) -> DataFrame:
    """total/avg/median/max/min/std (0 when n ≤ 1)/count of non-null amounts."""
    a = amount_column(df, amount_col)
    x = df.select(cents(F.col(a).try_cast("double")).alias("c"), F.col(a).try_cast("double").alias("v")) \
        .where(F.col("v").isNotNull())
    return revenue_figures(x.agg(*revenue_aggregates(F.col("v"))), x)


def revenue_aggregates(v: Column) -> list[Column]:
    """The revenue figures of a double column but for its median (aggregates)."""
    n = F.count(v)
    return [money_sum(v).alias("total_revenue"), money_avg(v).alias("avg_order_value"),
            F.round(F.max(v), 2).alias("max_order_value"), F.round(F.min(v), 2).alias("min_order_value"),
            F.when(n > 1, F.round(F.stddev_samp(v), 2)).otherwise(F.lit(0.0)).alias("std_dev"),
            n.alias("total_transactions")]


def revenue_figures(agg: DataFrame, amounts: DataFrame) -> DataFrame:
    """The one row of ``revenue_aggregates`` with the median of the cents ``c`` of ``amounts``."""
    twice = F.col("low") + F.col("high")                     # twice the median, in cents
    half = F.signum(twice) * F.floor((F.abs(twice) + 1) / 2)  # half away from zero
    return with_scalars(agg, median_row(amounts, "c")).select(
        "total_revenue", "avg_order_value", (half.cast("double") / 100.0).alias("median_order_value"),
        "max_order_value", "min_order_value", "std_dev", "total_transactions")


def revenue_by(df: DataFrame, dim: str, amount_col: str | None = None, top: int | None = None) -> DataFrame:
    """Revenue per ``dim`` sorted descending (ties by name); ``top`` keeps the head."""
    a = amount_column(df, amount_col)
    out = (df.groupBy(dim).agg(money_sum(F.col(a).try_cast("double")).alias("revenue"))
           .orderBy(F.col("revenue").desc_nulls_last(), F.col(dim).asc_nulls_first()))
    return out.limit(top) if top else out


def customer_kpis(df: DataFrame, customer_col: str | None = None, amount_col: str | None = None) -> DataFrame:
    """Distinct customers, mean / max revenue per customer and the share of
    revenue held by the top max(1, ⌊n/10⌋) customers (denominator max(total, 1)).

    The customers' revenues are stored once; the head's least revenue is a rank of them."""
    cc = customer_col or first_present(df, CUSTOMER_CANDIDATES)
    a = amount_column(df, amount_col)
    per = (df.where(F.col(cc).isNotNull()).groupBy(cc)
           .agg(F.coalesce(F.sum(cents(F.col(a).try_cast("double"))), F.lit(0)).cast(CENTS).alias("c")))
    return customer_figures(materialize(per.select("c"), "customer_revenue"))


def customer_figures(per: DataFrame) -> DataFrame:
    """The customer KPIs from one row per customer with its revenue ``c`` in cents."""
    top = lambda n: F.greatest(F.lit(1), F.floor(n * 0.1))
    head = ranked(per, ["c"], {"head": {"least": lambda n: n - top(n) + 1}}).agg(
        F.max("value").alias("least"), F.max(top(F.col("total"))).alias("k"))
    rows = with_scalars(per, head)
    x, above = F.col("c"), F.col("c") > F.col("least")
    s = rows.agg(F.count(F.lit(1)).alias("n"), F.coalesce(F.sum(x), F.lit(0)).alias("total"), F.max(x).alias("most"),
                 F.coalesce(F.sum(F.when(above, x)), F.lit(0)).alias("above"), F.count_if(above).alias("m"),
                 F.max("least").alias("least"), F.max("k").alias("k"))
    share = F.coalesce(F.col("above") + (F.col("k") - F.col("m")) * F.col("least"), F.lit(0))
    return s.select(
        F.col("n").cast("bigint").alias("total_unique_customers"),
        ratio_round(F.col("total"), F.col("n") * 100, 2).alias("avg_revenue_per_customer"),
        (F.col("most").cast("double") / 100.0).alias("max_revenue_customer"),
        ratio_round(share * 100, F.greatest(F.col("total"), F.lit(100)), 2).alias("top_10pct_revenue_share"))


def customers_by(df: DataFrame, dim: str = "country", customer_col: str | None = None) -> DataFrame:
    cc = customer_col or first_present(df, CUSTOMER_CANDIDATES)
    return (df.groupBy(dim).agg(F.count_distinct(cc).alias("customers"))
            .orderBy(F.col("customers").desc(), F.col(dim)))


def operational_kpis(df: DataFrame, quantity_col: str = "quantity") -> DataFrame:
    q = F.col(quantity_col).try_cast("double")
    return df.agg(ratio_round(F.sum(cents(q)), F.count(q) * 100, 2).alias("avg_quantity_per_order"),
                  F.sum(q).cast("bigint").alias("total_units_sold"))


def top_products(df: DataFrame, sku_col: str = "product_sku", k: int = 5) -> DataFrame:
    return (df.where(F.col(sku_col).isNotNull()).groupBy(sku_col).agg(F.count(F.lit(1)).alias("count"))
            .orderBy(F.col("count").desc(), F.col(sku_col)).limit(k))


def distribution(df: DataFrame, col: str, pct: bool = False) -> DataFrame:
    """Value counts (nulls excluded); ``pct`` → share of non-null rows (2 dp)."""
    g = df.where(F.col(col).isNotNull()).groupBy(col).agg(F.count(F.lit(1)).alias("count"))
    if pct:
        g = with_scalars(g, g.agg(F.sum("count").alias("_total")))
        g = g.withColumn("pct", ratio_round(F.col("count") * 100, F.col("_total"), 2)).drop("_total")
    return g.orderBy(F.col("count").desc(), F.col(col))


def growth(current: DataFrame, previous: DataFrame, amount_col: str | None = None) -> DataFrame:
    """Revenue and transaction-count growth between two periods (one pass each)."""
    a = amount_column(current, amount_col)

    def side(df: DataFrame, tag: str) -> DataFrame:
        return df.agg(F.coalesce(F.sum(cents(F.col(a).try_cast("double"))), F.lit(0)).alias(f"{tag}_c"),
                      F.count(F.lit(1)).alias(f"{tag}_n"))
    j = with_scalars(side(current, "cur"), side(previous, "prev"))
    cur_c, prev_c, cur_n, prev_n = F.col("cur_c"), F.col("prev_c"), F.col("cur_n"), F.col("prev_n")
    return j.select(
        (cur_c.cast("double") / 100.0).alias("current_period_revenue"),
        (prev_c.cast("double") / 100.0).alias("previous_period_revenue"),
        F.when(prev_c > 0, ratio_round((cur_c - prev_c) * 100, F.greatest(prev_c, F.lit(100)), 2))
         .otherwise(F.lit(0.0)).alias("revenue_growth_pct"),
        cur_n.alias("current_transactions"), prev_n.alias("previous_transactions"),
        ratio_round((cur_n - prev_n) * 100, F.greatest(prev_n, F.lit(1)), 2).alias("transaction_growth_pct"))


def compare_periods(current: DataFrame, previous: DataFrame, metric_columns: list[str]) -> DataFrame:
    """Per metric: current sum, previous sum, change, change % (0 when previous is 0).

    Both periods are read once; metrics become rows through ``unpivot``."""
    def sums(df: DataFrame, tag: str) -> DataFrame:
        return df.agg(*[F.round(F.sum(F.col(m).try_cast("double")), 2).alias(m) for m in metric_columns]) \
            .unpivot([], metric_columns, "metric", tag)
    j = sums(current, "current").join(sums(previous, "previous"), "metric")
    ch = F.round(F.col("current") - F.col("previous"), 2)
    return j.select("metric", "current", "previous", ch.alias("change"),
                    F.when(F.col("previous") != 0,
                           F.round((F.col("current") - F.col("previous")) / F.col("previous") * 100, 2))
                    .otherwise(F.lit(0.0)).alias("change_pct"))
