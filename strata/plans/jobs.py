"""Pipeline jobs: Bronze (ingest + validate + split + metrics per source),
Silver (schema, standardise, dedup, quality), Gold (daily rollup, KPIs, report).

``Lake`` keeps the layers as tables under one folder, and ``run_layer`` runs a single
layer from the tables of the one before it.  A source that fails, while its plan is
built or when it runs, is isolated: its metrics row says ``failed`` and the other
sources continue.
"""

from __future__ import annotations

import datetime as _dt
from collections.abc import Callable
from dataclasses import dataclass, field

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from strata.functions.columns import CUSTOMER_CANDIDATES, first_present
from strata.functions.numeric import CENTS, cents, ratio_round
from strata.operators import kpi as K
from strata.operators import rules as V
from strata.operators import silver as SV
from strata.operators.dedup import dedup_exact
from strata.operators.profile import business_report
from strata.operators.quality import QualityChecker
from strata.operators.rollups import aggregate_daily
from strata.operators.schema import TableSchema, enforce
from strata.session import materialize, small_tasks, swept_shuffles


@dataclass
class SourceSpec:
    name: str
    source_type: str                                  # crm | erp | api | csv | lake
    read: Callable[[SparkSession], DataFrame]
    validate: Callable[[DataFrame], DataFrame]
    flatten: Callable[[DataFrame], DataFrame] | None = None
    key: str | None = None
    order: list[str] = field(default_factory=list)


DEDUP_KEYS = ["transaction_id", "contact_id"]


def silver(df: DataFrame, source_type: str, as_of: _dt.datetime, order: list[str]) -> DataFrame:
    s = SV.transform(df, source_type, as_of)
    keys = [k for k in DEDUP_KEYS if k in s.columns]
    return dedup_exact(s, keys or None, order, "first")


def silver_quality(df: DataFrame, dataset: str, as_of: _dt.datetime) -> DataFrame:
    chk = (QualityChecker().add_completeness_rule("customer_id", 0.95)
           .add_accuracy_rule("quantity", min_value=0, max_value=10000)
           .add_uniqueness_rule(["transaction_id"]))
    return chk.check(df, dataset, "silver", as_of)


def calculate_all(df: DataFrame) -> DataFrame:
    """Every KPI group as one long table (kpi_group, kpi, value); grouped figures
    (revenue and customers by dimension, products, status) name the member in kpi.

    One pass over ``df`` takes the aggregates of all groups as grouping sets, which are
    combined before the shuffle and stored (a row per member, customer, and customer of a
    country); every group is read from there.  The median alone reads the amounts again."""
    cols = df.columns
    customer = first_present(df, CUSTOMER_CANDIDATES)
    amount = K.amount_column(df)
    dims = [c for c in ("category", "country", "product_sku", "status") if c in cols]
    v, q = F.col(amount).try_cast("double"), F.col("quantity").try_cast("double") if "quantity" in cols else F.lit(None).cast("double")
    d = df.select(v.alias("v"), q.alias("q"), F.col(customer).cast("string").alias("customer"), *[
        F.col(c).cast("string").alias(c) for c in dims])
    sets = [[], ["customer"], *[[c] for c in dims]] + ([["country", "customer"]] if "country" in dims else [])
    keys = ["customer", *dims]
    found = d.groupingSets([[F.col(c) for c in s] for s in sets], *keys).agg(
        F.grouping_id(*keys).alias("id"), *K.revenue_aggregates(F.col("v")), F.count(F.lit(1)).alias("rows"),
        F.sum(cents(F.col("v"))).cast(CENTS).alias("c"), F.sum(cents(F.col("q"))).cast(CENTS).alias("qc"),
        F.count("q").alias("qn"), F.sum("q").alias("qs"))
    found = materialize(found, "kpi_sets")

    def of(*used: str) -> DataFrame:  # the bit of a key is set where the key is not in the set
        return found.where(F.col("id") == sum(1 << (len(keys) - 1 - i) for i, c in enumerate(keys) if c not in used))

    def long(group: str, wide: DataFrame) -> DataFrame:
        names = list(wide.columns)
        return wide.select(*[F.col(c).cast("double").alias(c) for c in names]) \
            .unpivot([], names, "kpi", "value").select(F.lit(group).alias("kpi_group"), "kpi", "value")

    def by_member(group: str, frame: DataFrame, member: str, value: str) -> DataFrame:
        return frame.select(F.lit(group).alias("kpi_group"), F.col(member).alias("kpi"),
                            F.col(value).cast("double").alias("value"))

    amounts = d.select(cents(F.col("v")).alias("c")).where("c IS NOT NULL")
    per = of("customer").where("customer IS NOT NULL").select(F.coalesce("c", F.lit(0).cast(CENTS)).alias("c"))
    parts = [long("revenue", K.revenue_figures(of(), amounts)), long("customer", K.customer_figures(per))]
    if "quantity" in cols:
        parts.append(long("operational", of().select(
            ratio_round(F.col("qc"), F.col("qn") * 100, 2).alias("avg_quantity_per_order"),
            F.col("qs").cast("bigint").alias("total_units_sold"))))
    for dim in ("category", "country"):
        if dim in dims:
            parts.append(by_member(f"revenue_by_{dim}", of(dim), dim, "total_revenue"))
    if "country" in dims:
        parts.append(by_member("customers_by_country", of("country", "customer").groupBy("country").agg(
            F.count("customer").alias("customers")), "country", "customers"))
    if "product_sku" in dims:
        parts.append(by_member("top_products", of("product_sku").where("product_sku IS NOT NULL").orderBy(
            F.col("rows").desc(), "product_sku").limit(5), "product_sku", "rows"))
    if "status" in dims:
        parts.append(by_member("status_distribution", of("status").where("status IS NOT NULL"), "status", "rows"))
    parts.append(of().select(F.lit("summary").alias("kpi_group"), F.lit("record_count").alias("kpi"),
                             F.col("rows").cast("double").alias("value")))
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out


@dataclass
class Lake:
    """Layer tables as Parquet under one folder that all executors share."""
    spark: SparkSession
    root: str

    def write(self, layer: str, name: str, df: DataFrame) -> DataFrame:
        with swept_shuffles(self.spark), small_tasks(self.spark):
            df.write.mode("overwrite").option("compression", "zstd").parquet(f"{self.root}/{layer}/{name}")
        return self.read(layer, name)

    def read(self, layer: str, name: str) -> DataFrame:
        return self.spark.read.parquet(f"{self.root}/{layer}/{name}")


def run_bronze(lake: Lake, spec: SourceSpec, run_id: str, as_of: _dt.datetime) -> DataFrame:
    """Validate one source once; store the accepted and rejected rows; metrics.
    An error anywhere in the source's plan gives a ``failed`` row."""
    try:
        raw = spec.read(lake.spark)
        v = lake.write("bronze", f"{spec.name}_validated", spec.validate(spec.flatten(raw) if spec.flatten else raw))
        accepted, rejected = V.split(v)
        lake.write("bronze", spec.name, SV.add_ingestion_metadata(accepted, spec.name, spec.source_type, run_id, as_of))
        lake.write("bronze", f"{spec.name}_rejected", rejected)
        return V.ingest_metrics(v, spec.name, spec.source_type)
    except Exception as e:  # noqa: BLE001 — per-source isolation
        print(f"bronze source {spec.name} failed: {e}")
        return lake.spark.createDataFrame(
            [(spec.name, spec.source_type, 0, 0, 0, 0.0, "failed")],
            "source_name string, source_type string, records_read bigint, records_accepted bigint, "
            "records_rejected bigint, rejection_rate_pct double, status string")


def run_silver(lake: Lake, name: str, source_type: str, as_of: _dt.datetime, order: list[str],
               schema: TableSchema | None = None) -> DataFrame:
    """Bronze table → silver table and its quality report; the rows after each step
    as (step, rows)."""
    b = lake.read("bronze", name)
    kept = enforce(b, schema, "permissive") if schema else b
    s = lake.write("silver", name, silver(kept, source_type, as_of, order))
    report = lake.write("silver", f"{name}_quality", silver_quality(s, name, as_of).drop("_raw_score"))
    count = lambda step, df: df.agg(F.count(F.lit(1)).alias("rows")).select(F.lit(step).alias("step"), "rows")
    return (count("bronze", b).unionByName(count("silver", s))
            .unionByName(count("quality_rules", report)).unionByName(count("quality_failed", report.where("NOT passed"))))


def run_gold(lake: Lake, name: str, date_col: str, amount_col: str, order_col: str) -> dict[str, DataFrame]:
    """Silver table → daily rollup, KPIs and report tables."""
    s = lake.read("silver", name)
    return {"daily": lake.write("gold", f"{name}_daily", aggregate_daily(s, date_col, amount_col)),
            "kpis": lake.write("gold", f"{name}_kpis", calculate_all(s)),
            "report": lake.write("gold", f"{name}_report", business_report(s, amount_col, order_col, date_col))}


def run_layer(lake: Lake, layer: str, **args) -> DataFrame | dict[str, DataFrame]:
    """One layer alone, from the stored tables of the one before it."""
    return {"bronze": run_bronze, "silver": run_silver, "gold": run_gold}[layer](lake, **args)


def pipeline_report(metrics: DataFrame, report: DataFrame) -> DataFrame:
    """The run as (section, metric, value): ingestion per source, quality per rule."""
    ingest = metrics.unpivot(["source_name"], ["records_read", "records_accepted", "records_rejected"],
                             "metric", "value").select(
        F.concat(F.lit("ingest:"), F.col("source_name")).alias("section"), "metric", F.col("value").cast("double"))
    quality = report.select(F.concat(F.lit("quality:"), F.col("dataset_name")).alias("section"),
                            F.col("rule_name").alias("metric"), F.col("score").alias("value"))
    return ingest.unionByName(quality)


def union_sources(frames: dict[str, DataFrame]) -> DataFrame:
    """All sources in one frame (missing columns → null), tagged by source, distinct."""
    out = None
    for name, df in frames.items():
        d = df.withColumn("_source_system", F.lit(name))
        out = d if out is None else out.unionByName(d, allowMissingColumns=True)
    return out.distinct()
