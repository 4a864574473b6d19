"""Time and dimension rollups of a transactions frame (gold layer).

Every rollup is one hash aggregation with map-side partial aggregation; the
"most frequent value" columns are two-level (count per (group, value), then a
top-1 per group), so neither a hot day nor a high-cardinality value column is
ever gathered into a single in-memory map.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from strata.functions.columns import as_date, with_scalars
from strata.functions.numeric import cents, money_avg, money_sum, ratio_round
from strata.session import materialize


def top_value(df: DataFrame, keys: list[str], value: str, out: str, rows: str | None = None) -> DataFrame:
    """Most frequent non-null ``value`` per ``keys`` (weighted by ``rows``); ties → smallest value."""
    n = F.sum(rows) if rows else F.count(F.lit(1))
    counts = df.where(F.col(value).isNotNull()).groupBy(*keys, value).agg(n.alias("_n"))
    w = Window.partitionBy(*keys).orderBy(F.col("_n").desc(), F.col(value).asc())
    return (counts.withColumn("_rk", F.row_number().over(w)).where("_rk = 1")
            .select(*keys, F.col(value).alias(out)))


def _amount_aggs(amount: Column) -> list[Column]:
    return [F.coalesce(money_sum(amount), F.lit(0.0)).alias("total_revenue"),
            F.count(amount).alias("transaction_count"),
            money_avg(amount).alias("avg_order_value")]


def aggregate_daily(df: DataFrame, date_col: str = "order_date", amount_col: str = "total_amount",
                    group_cols: list[str] | None = None) -> DataFrame:
    """Per day (and optional group columns): revenue sum/mean/min/max/count,
    distinct customers / SKUs, most frequent category and country.  Rows
    whose date does not parse are dropped.

    The source runs once: rows are first aggregated per day and dimension values into
    a stored table, which all figures read."""
    keys = ["date", *(group_cols or [])]
    amount = F.col(amount_col).try_cast("double")
    dims = [c for c in ("customer_id", "product_sku", "category", "country") if c in df.columns and c not in keys]
    d = df.withColumn("date", as_date(df, date_col)).where(F.col("date").isNotNull())
    part = materialize(d.groupBy(*keys, *dims).agg(
        F.sum(cents(amount)).alias("_c"), F.count(amount).alias("_n"), F.min(amount).alias("_min"),
        F.max(amount).alias("_max"), F.count(F.lit(1)).alias("_rows")), "daily")
    total = F.sum("_c")
    aggs = [F.coalesce(total.cast("double") / 100.0, F.lit(0.0)).alias("total_revenue"),
            ratio_round(total, F.sum("_n") * 100, 2).alias("avg_order_value"),
            F.min("_min").alias("min_order_value"), F.max("_max").alias("max_order_value"),
            F.sum("_n").alias("transaction_count")]
    for src, name in (("customer_id", "unique_customer_ids"), ("product_sku", "unique_product_skus")):
        if src in dims:
            aggs.append(F.count_distinct(src).alias(name))
    out = part.groupBy(*keys).agg(*aggs)
    for src, name in (("category", "top_category"), ("country", "top_country")):
        if src in dims:
            out = out.join(top_value(part, keys, src, name, "_rows"), keys, "left")
    return out.withColumns({"_aggregation_type": F.lit("daily"), "_layer": F.lit("gold")})


def aggregate_weekly(df: DataFrame, date_col: str = "order_date", amount_col: str = "total_amount",
                     iso_year: bool = False) -> DataFrame:
    """ISO week number with the calendar year (reference behaviour) or the ISO
    week-numbering year (``iso_year=True``)."""
    d = as_date(df, date_col)
    year = F.extract(F.lit("YEAROFWEEK"), d) if iso_year else F.year(d)
    return (df.where(d.isNotNull())
            .groupBy(year.alias("year"), F.weekofyear(d).alias("week"))
            .agg(*_amount_aggs(F.col(amount_col).try_cast("double")))
            .withColumns({"_aggregation_type": F.lit("weekly"), "_layer": F.lit("gold")}))


def aggregate_monthly(df: DataFrame, date_col: str = "order_date", amount_col: str = "total_amount") -> DataFrame:
    d = as_date(df, date_col)
    return (df.where(d.isNotNull())
            .groupBy(F.year(d).alias("year"), F.month(d).alias("month"))
            .agg(*_amount_aggs(F.col(amount_col).try_cast("double")))
            .withColumns({"_aggregation_type": F.lit("monthly"), "_layer": F.lit("gold")}))


def aggregate_by_dimension(df: DataFrame, dimension_col: str, amount_col: str = "total_amount") -> DataFrame:
    """Revenue per dimension value with its share of the grand total (2 dp).

    The source runs once, into a stored row per value; the share's denominator is a
    one-row total of that table (no single-partition window)."""
    amount = F.col(amount_col).try_cast("double")
    g = (df.where(F.col(dimension_col).isNotNull()).groupBy(dimension_col)
         .agg(*_amount_aggs(amount), F.sum(cents(amount)).alias("_c")))
    g = materialize(g, "dimension")
    g = with_scalars(g, g.agg(F.sum("_c").alias("_total")))
    share = ratio_round(F.col("_c") * 100, F.col("_total"), 2)
    return (g.withColumn("revenue_pct", share).drop("_c", "_total")
            .withColumn("_aggregation_type", F.lit(f"by_{dimension_col}"))
            .orderBy(F.col("total_revenue").desc(), F.col(dimension_col)))


def interaction_daily(events: DataFrame, ts_col: str = "ts", customer_col: str = "user_id",
                      type_col: str = "event_type", response_col: str = "value",
                      conversion_type: str = "purchase", contacts: DataFrame | None = None,
                      created_col: str = "created_at", stage_col: str = "lifecycle_stage") -> DataFrame:
    """Per day: interactions, active customers, new customers (first touch that
    day), conversions and conversion rate (%), mean response time in minutes, and
    with ``contacts`` the leads created that day (days without interactions too).

    First touch is a per-customer minimum (partial aggregation), joined back on
    the day — no per-customer sort."""
    d = events.withColumn("date", F.to_date(F.col(ts_col)))
    first = (d.groupBy(customer_col).agg(F.min("date").alias("date"))
             .groupBy("date").agg(F.count(F.lit(1)).alias("new_customers")))
    conv = F.count_if(F.col(type_col) == conversion_type)
    daily = d.groupBy("date").agg(
        F.count(F.lit(1)).alias("customer_interactions"),
        F.count_distinct(customer_col).alias("active_customers"),
        conv.alias("conversions"),
        ratio_round(conv * 100, F.count(F.lit(1)), 2).alias("conversion_rate"),
        (money_avg(F.col(response_col), 4) / 60.0).alias("_resp"))
    out = (daily.join(first, "date", "left")
           .select("date", "customer_interactions", "active_customers",
                   F.coalesce("new_customers", F.lit(0)).alias("new_customers"), "conversions",
                   "conversion_rate", F.round("_resp", 2).alias("avg_response_time_minutes")))
    if contacts is None:
        return out
    leads = contacts.where(F.lower(stage_col) == "lead").groupBy(F.to_date(F.col(created_col)).alias("date")).agg(
        F.count(F.lit(1)).alias("new_leads"))
    counts = ["customer_interactions", "active_customers", "new_customers", "conversions", "new_leads"]
    return out.join(leads.where("date IS NOT NULL"), "date", "full_outer").select(
        "date", *[F.coalesce(c, F.lit(0)).alias(c) for c in counts], "conversion_rate", "avg_response_time_minutes")
