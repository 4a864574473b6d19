"""Sinks: partitioned layer writes, dead-letter table, quality-report history,
run-metrics documents and table registration.

Partitioned writes use the ``REBALANCE`` hint on the partition columns: rows of
one partition value land in few tasks (few files per directory), and AQE
splits a skewed value (a day holding a third of the data) over several tasks
instead of one.  Re-runs replace only the partitions they touch (dynamic
partition overwrite); ``maxRecordsPerFile`` bounds file sizes.
"""

from __future__ import annotations

import datetime as _dt

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from strata.operators.rules import dead_letter


def write_partitioned(df: DataFrame, path: str, partition_cols: list[str], mode: str = "overwrite",
                      max_records_per_file: int = 5_000_000, fmt: str = "parquet", gather: bool = True) -> None:
    """``gather=False`` for rows of one partition value: each task's rows are in one folder already."""
    ((df.hint("rebalance", *partition_cols) if gather else df).write.mode(mode).option("partitionOverwriteMode", "dynamic")
     .option("maxRecordsPerFile", max_records_per_file).option("compression", "snappy")
     .partitionBy(*partition_cols).format(fmt).save(path))


def write_dead_letter(rejected: DataFrame, path: str, as_of: _dt.datetime) -> None:
    """Append rejected rows (record JSON, error, timestamp) under reject_date=…"""
    write_partitioned(dead_letter(rejected, as_of), path, ["reject_date"], mode="append", gather=False)


def append_quality_report(report: DataFrame, path: str, run_ts: _dt.datetime) -> None:
    write_partitioned(report.withColumn("run_ts", F.lit(run_ts).cast("timestamp")), path,
                      ["dataset_name"], mode="append")


def latest_quality(spark: SparkSession, path: str) -> DataFrame:
    """Most recent report rows per dataset (rules of the latest run)."""
    h = spark.read.parquet(path)
    last = h.groupBy("dataset_name").agg(F.max("run_ts").alias("run_ts"))
    return h.join(last, ["dataset_name", "run_ts"])


def quality_reports(spark: SparkSession, path: str, datasets: list[str] | None = None, since: _dt.datetime | None = None,
                    until: _dt.datetime | None = None) -> DataFrame:
    """The stored report rows of the named datasets (all if none) with since <= run_ts <= until.

    Datasets are partitions, so only their folders are read."""
    h = spark.read.parquet(path)
    if datasets is not None:
        h = h.where(F.col("dataset_name").isin(datasets))
    if since is not None:
        h = h.where(F.col("run_ts") >= F.lit(since))
    if until is not None:
        h = h.where(F.col("run_ts") <= F.lit(until))
    return h


def write_run_metrics(metrics: DataFrame, path: str) -> None:
    metrics.write.mode("append").json(path)


def register_table(spark: SparkSession, path: str, name: str) -> DataFrame:
    """A Parquet folder (compatible schemas merged) as an external table of the
    session catalog, its partitions included; an older table of the name is replaced."""
    spark.sql(f"DROP TABLE IF EXISTS {name}")
    schema = spark.read.option("mergeSchema", True).parquet(path).schema
    spark.catalog.createTable(name, path=path, source="parquet", schema=schema, mergeSchema="true")
    return spark.table(name)


def bronze_view(df: DataFrame, name: str) -> DataFrame:
    """A layer as a view: nothing is stored, each query reads the source."""
    df.createOrReplaceTempView(name)
    return df.sparkSession.table(name)
