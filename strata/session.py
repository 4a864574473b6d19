"""Spark session and cluster-safe scratch locations.

Library code never invents machine-local paths: lineage cuts and
intermediate tables go to ``spark.checkpoint.dir`` (a shared folder on a
cluster).  Only when that setting is unset — local runs and tests — do we
fall back to a fresh folder under /tmp.
"""

from __future__ import annotations

import atexit
import os
import re
import shutil
import tempfile
import uuid
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession

DEFAULT_CONF = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.session.timeZone": "UTC",
    "spark.ui.enabled": "false",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
    # parquet scans: ~128 MB splits keep tasks spill-free on a cluster
    "spark.sql.files.maxPartitionBytes": str(128 * 1024 * 1024),
    "spark.sql.codegen.hugeMethodLimit": "8000",
}


# cluster defaults (no master given): wide shuffles that AQE coalesces down —
# 200 partitions would mean ~500 GB per shuffle partition at 100 TB
CLUSTER_CONF = {
    "spark.sql.shuffle.partitions": "8192",
    "spark.sql.adaptive.advisoryPartitionSizeInBytes": str(256 * 1024 * 1024),
}


def get_spark(master: str | None = None, shuffle_partitions: int | None = None,
              app_name: str = "strata") -> SparkSession:
    builder = SparkSession.builder.appName(app_name)
    if master:
        builder = builder.master(master)
    for k, v in DEFAULT_CONF.items():
        builder = builder.config(k, v)
    if master is None:
        for k, v in CLUSTER_CONF.items():
            builder = builder.config(k, v)
    if shuffle_partitions:
        builder = builder.config("spark.sql.shuffle.partitions", str(shuffle_partitions))
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    ensure_checkpoint_dir(spark)
    return spark


def ensure_checkpoint_dir(spark: SparkSession) -> str:
    """Return the shared checkpoint folder.

    Only a local session may do without ``spark.checkpoint.dir``: a folder under
    /tmp then serves, and is removed when the process ends.  On a cluster the
    executors could not see such a folder, so that raises."""
    conf_dir = spark.conf.get("spark.checkpoint.dir", None)
    sc = spark.sparkContext
    if not conf_dir:
        if not re.fullmatch(r"local(\[[^\]]*\])?", sc.master):
            raise RuntimeError(f"set spark.checkpoint.dir to a folder that all executors share (master {sc.master})")
        conf_dir = tempfile.mkdtemp(prefix="strata-ckpt-", dir="/tmp")
        atexit.register(shutil.rmtree, conf_dir, ignore_errors=True)
        spark.conf.set("spark.checkpoint.dir", conf_dir)
    if sc.getCheckpointDir() is None:
        sc.setCheckpointDir(conf_dir)
    return conf_dir


def scratch_path(spark: SparkSession, name: str) -> str:
    """A fresh, unique path inside the shared checkpoint folder; an open scope removes it."""
    base = ensure_checkpoint_dir(spark)
    path = os.path.join(base, f"{name}-{uuid.uuid4().hex[:12]}")
    for scope in _SCOPES:
        scope.append(path)
    return path


_SCOPES: list[list[str]] = []


@contextmanager
def scratch_scope(spark: SparkSession):
    """Remove the scratch tables made inside when the block ends.

    Results are lazy frames over such tables: write or collect them inside.  Calls
    of ``scratch_path`` between the block's start and end count, in this process."""
    made: list[str] = []
    _SCOPES.append(made)
    try:
        yield
    finally:
        _SCOPES.remove(made)
        for path in made:
            remove_path(spark, path)


def remove_path(spark: SparkSession, path: str) -> None:
    p = spark._jvm.org.apache.hadoop.fs.Path(path)
    p.getFileSystem(spark._jsc.hadoopConfiguration()).delete(p, True)


def drop_table(table: DataFrame) -> None:
    """Delete a table of ``materialize`` or ``cut_lineage`` that nothing reads any more."""
    path = _PATHS.pop(id(table), (None, None))[1]
    if path:
        remove_path(table.sparkSession, path)


#: path of each live frame that reads a scratch table, by identity
_PATHS: dict[int, tuple[DataFrame, str]] = {}


def cut_lineage(df: DataFrame, name: str = "lineage") -> DataFrame:
    """Cut lineage through a table written in the shared checkpoint folder.

    Reliable like ``checkpoint()`` (survives executor loss), but the plan runs
    once — an eager ``checkpoint()`` of an unpersisted frame computes it twice —
    and the result is columnar.  Iterative operators drop the table of a round
    with ``drop_table`` once the next is written."""
    out = materialize(df, name)
    _PATHS[id(out)] = (out, out._strata_path)
    return out


@contextmanager
def swept_shuffles(spark: SparkSession):
    """Inside, the shuffle files of a written table go as soon as it is written."""
    name = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"
    before = spark.conf.get(name)
    spark.conf.set(name, "true")
    try:
        yield
    finally:
        spark.conf.set(name, before)


#: shuffled bytes that a task of ``small_tasks`` reads; sorts of wide rows hold ten times as much and more
_TASK_BYTES = 16 << 20


@contextmanager
def small_tasks(spark: SparkSession):
    """Inside, adaptive execution joins shuffle partitions up to 16 MB (or the session's size, if that
    is smaller), so that sorts of rows which grow after their shuffle stay in a task's memory."""
    name = "spark.sql.adaptive.advisoryPartitionSizeInBytes"
    before = spark.conf.get(name)
    size = int(spark._jvm.org.apache.spark.network.util.JavaUtils.byteStringAsBytes(before))
    spark.conf.set(name, str(min(size, _TASK_BYTES)))
    try:
        yield
    finally:
        spark.conf.set(name, before)


def materialize(df: DataFrame, name: str = "stage") -> DataFrame:
    """Write ``df`` as Parquet under the shared checkpoint folder and read it back.

    Used where a layer is a table by design (silver feeding several gold
    aggregates) and to cut lineage in iterative operators: columnar, compressed,
    readable with column pruning, and it survives executor loss."""
    spark = df.sparkSession
    path = scratch_path(spark, name)
    with swept_shuffles(spark):
        df.write.mode("overwrite").parquet(path)
    out = spark.read.schema(df.schema).parquet(path)
    out._strata_path = path
    return out
