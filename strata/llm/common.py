"""Helpers shared by the operators of this subpackage."""

from __future__ import annotations

import os
from collections.abc import Callable, Iterable, Iterator
from contextlib import contextmanager

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_schema
from pyspark.sql.types import StructType

from strata.session import scratch_path

ROOT = os.path.dirname(os.path.dirname(os.path.dirname(os.path.abspath(__file__))))
CLEANUP = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"
BATCH = "spark.sql.execution.arrow.maxBytesPerBatch"
#: bytes of text that a Python task turns into arrays at a time
CHUNK_BYTES = 4 << 20


def ship(spark: SparkSession) -> None:
    """Let Python workers import this package also when the driver found it by sys.path only."""
    env = spark.sparkContext.environment
    have = env.get("PYTHONPATH", os.environ.get("PYTHONPATH", ""))
    if ROOT not in have.split(os.pathsep):
        env["PYTHONPATH"] = os.pathsep.join(x for x in (have, ROOT) if x)


@contextmanager
def lean_write(spark: SparkSession):
    """Inside, the shuffle files of a written table go as soon as it is written, and
    Python workers get their rows in small batches."""
    wanted = {CLEANUP: "true", BATCH: str(8 << 20)}
    before = {k: spark.conf.get(k) for k in wanted}
    for k, v in wanted.items():
        spark.conf.set(k, v)
    try:
        yield
    finally:
        for k, v in before.items():
            spark.conf.set(k, v)


class Scratch:
    """Tables under spark.checkpoint.dir that cut lineage; they survive lost executors."""

    def __init__(self, spark: SparkSession):
        self.spark, self.paths = spark, {}
        ship(spark)

    def write(self, df: DataFrame, name: str) -> DataFrame:
        path = scratch_path(self.spark, f"llm-{name}")
        with lean_write(self.spark):
            df.write.parquet(path)
        out = self.spark.read.schema(df.schema).parquet(path)
        self.paths[id(out)] = (out, path)
        return out

    def drop(self, *tables: DataFrame) -> None:
        """Delete tables that no later step reads."""
        jvm = self.spark._jvm
        for t in tables:
            _, path = self.paths.pop(id(t), (None, None))
            if path:
                p = jvm.org.apache.hadoop.fs.Path(path)
                p.getFileSystem(self.spark._jsc.hadoopConfiguration()).delete(p, True)


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def text_or_empty(c: str | Column = "text") -> Column:
    return F.coalesce(F.col(c) if isinstance(c, str) else c, F.lit(""))


def map_columns(df: DataFrame, fn: Callable[[dict], Iterable[dict] | dict], schema: str, text: str = "text",
                chunk_bytes: int = CHUNK_BYTES) -> DataFrame:
    """mapInArrow over chunks of about `chunk_bytes` of the column `text`: fn gets a
    dict of Python lists and gives a dict of lists or arrays (or several of them)."""
    target = to_arrow_schema(StructType.fromDDL(schema))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in chunks(batch, text, chunk_bytes):
                got = fn({k: part.column(i).to_pylist() for i, k in enumerate(part.schema.names)})
                for out in ([got] if isinstance(got, dict) else got):
                    yield pa.RecordBatch.from_arrays(
                        [pa.array(out[f.name], type=f.type) for f in target], schema=target)

    return df.mapInArrow(run, schema)


def chunks(batch: pa.RecordBatch, text: str, chunk_bytes: int) -> Iterator[pa.RecordBatch]:
    n = batch.num_rows
    if not n:
        return
    sizes = np.asarray(pc.fill_null(pc.binary_length(batch.column(text)), 0)).astype(np.int64) + 64
    ends = np.cumsum(sizes)
    start = 0
    while start < n:
        base = ends[start] - sizes[start]
        stop = max(start + 1, int(np.searchsorted(ends, base + chunk_bytes, side="right")))
        yield batch.slice(start, stop - start)
        start = stop


def mix64(x: np.ndarray) -> np.ndarray:
    """splitmix64 finaliser over uint64 (wraps)."""
    x = x ^ (x >> np.uint64(30))
    x = x * np.uint64(0xBF58476D1CE4E5B9)
    x = x ^ (x >> np.uint64(27))
    x = x * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def forest(n: int, u: np.ndarray, v: np.ndarray, parent: np.ndarray | None = None) -> np.ndarray:
    """Roots (smallest member) of 0..n-1 after joining u[i] with v[i]; vectorised hooking and pointer jumping."""
    p = np.arange(n) if parent is None else parent
    while len(u):
        a, b = p[u], p[v]
        diff = a != b
        if not diff.any():
            break
        u, v, a, b = u[diff], v[diff], a[diff], b[diff]
        np.minimum.at(p, np.maximum(a, b), np.minimum(a, b))
        while True:
            q = p[p]
            if (q == p).all():
                break
            p = q
    return p


def numbered(df: DataFrame, group: list[str], order: list[Column], salt: Column, out: str) -> DataFrame:
    """Add `out`: 0, 1, ... within each group, whatever the group's size.

    Rows of a group are dealt into salted chunks, four for each shuffle
    partition, so that no task holds a whole group: a row's number is the count
    of the chunks before its own plus its place in its chunk. `order` must tell
    rows of a chunk apart, or they must be alike."""
    from pyspark.sql import Window as W

    k = 4 * int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    d = df.withColumn("_chunk", F.pmod(F.xxhash64(salt), F.lit(k)).cast("int"))
    counts = d.groupBy(*group, "_chunk").agg(F.count(F.lit(1)).alias("_n"))
    before = counts.withColumn(
        "_before", F.coalesce(F.sum("_n").over(W.partitionBy(*group).orderBy("_chunk").rowsBetween(
            W.unboundedPreceding, -1)), F.lit(0))).drop("_n")
    place = F.row_number().over(W.partitionBy(*group, "_chunk").orderBy(*order)) - 1
    return (d.withColumn("_place", place).join(before, [*group, "_chunk"])
            .withColumn(out, (F.col("_before") + F.col("_place")).cast("long"))
            .drop("_chunk", "_before", "_place"))
