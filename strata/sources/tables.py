"""Parquet table access and size-checked broadcast of dimensions."""

from __future__ import annotations

import os

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

TABLES = ("region nation customer supplier part orders lineitem events documents "
          "embeddings pages benchmark labels conversations").split()


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    path = os.path.join(sf_dir, f"{name}.parquet")
    return spark.read.parquet(path)


def broadcast_if_small(df: DataFrame, max_bytes: int = 8 << 20) -> DataFrame:
    """Broadcast ``df`` only when its plan's statistics (file sizes) bound it by
    ``max_bytes``; otherwise the planner and AQE choose.  No job is run."""
    size = int(str(df._jdf.queryExecution().optimizedPlan().stats().sizeInBytes()))
    return F.broadcast(df) if size <= max_bytes else df


def source_bytes(df: DataFrame) -> int:
    """Bytes of the files that the plan of ``df`` reads, by its leaves' statistics (unknown
    sizes count as none).  No job is run."""
    leaves = df._jdf.queryExecution().optimizedPlan().collectLeaves()
    sizes = [int(str(leaves.apply(i).stats().sizeInBytes())) for i in range(leaves.length())]
    return sum(s for s in sizes if s < 1 << 62)
