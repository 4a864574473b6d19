"""Snapshot-partitioned datasets: folders ``snapshot=…`` (or ``dt=…``) that hold Parquet or
JSON files at any depth, an index of their files, and files that cannot be read.

A snapshot is chosen by folder names, and only the chosen folder is listed and read; its
format is that of the files found at any depth below it.  Folders without data files are
no snapshots to read; a dataset without any raises.
"""

from __future__ import annotations

from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.pandas.types import to_arrow_schema

from strata.session import materialize

PARTS = ("snapshot", "dt")
#: file name endings by format
ENDINGS = {"parquet": r"\.parquet$", "json": r"\.(json|jsonl|ndjson)(\.gz)?$"}
GLOBS = {"parquet": "*.parquet", "json": "*.{json,jsonl,ndjson,json.gz,jsonl.gz,ndjson.gz}"}


def _fs(spark: SparkSession, path: str):
    p = spark._jvm.org.apache.hadoop.fs.Path(path)
    return p.getFileSystem(spark._jsc.hadoopConfiguration()), p


def snapshot_names(spark: SparkSession, base: str) -> tuple[str | None, list[str]]:
    """The snapshot partition column (``snapshot`` first, ``dt`` otherwise) and its values, from the folder names."""
    fs, root = _fs(spark, base)
    folders = [s.getPath().getName() for s in fs.listStatus(root) if s.isDirectory()]
    for part in PARTS:
        values = sorted(f.split("=", 1)[1] for f in folders if f.startswith(f"{part}="))
        if values:
            return part, values
    return None, []


def data_files(spark: SparkSession, *folders: str) -> DataFrame:
    """(file, format, bytes, modified) of the data files at any depth; listed by Spark, contents unread."""
    files = spark.read.format("binaryFile").option("recursiveFileLookup", True).load(list(folders))
    kind = F.lit(None).cast("string")
    for name, ending in ENDINGS.items():
        kind = F.when(F.col("path").rlike(ending), F.lit(name)).otherwise(kind)
    return files.select(F.col("path").alias("file"), kind.alias("format"), F.col("length").alias("bytes"),
                        F.col("modificationTime").alias("modified")).where("format IS NOT NULL")


def _has_data(spark: SparkSession, folder: str) -> bool:
    import re

    fs, p = _fs(spark, folder)
    it = fs.listFiles(p, True)
    while it.hasNext():  # stops at the first data file
        name = it.next().getPath().getName()
        if any(re.search(e, name) for e in ENDINGS.values()) and not name.startswith(("_", ".")):
            return True
    return False


def read_snapshot(spark: SparkSession, base: str, snapshot: str | None = None, fmt: str | None = None,
                  skip_corrupt: bool = False) -> DataFrame:
    """Snapshot-partitioned dataset; ``snapshot=None`` selects the latest one that has data files.

    Partition folders below the snapshot become columns.  Files of both formats are read
    together by column name, unless ``fmt`` is given.  With ``skip_corrupt`` unreadable
    files are left out (``read_quarantined`` also names them)."""
    part, values = snapshot_names(spark, base)
    if part is None:
        folder = base
    else:
        wanted = [snapshot] if snapshot else reversed(values)
        folder = next((f for f in (f"{base}/{part}={v}" for v in wanted) if _has_data(spark, f)), None)
    if folder is None or not _has_data(spark, folder):
        raise FileNotFoundError(f"no Parquet or JSON files under {base}" + (f", snapshot {snapshot}" if snapshot else ""))
    formats = [fmt] if fmt else sorted(r[0] for r in data_files(spark, folder).select("format").distinct().collect())
    out = None
    for f in formats:
        r = spark.read.option("ignoreCorruptFiles", skip_corrupt).option("basePath", base).option("pathGlobFilter", GLOBS[f])
        df = r.option("mergeSchema", True).parquet(folder) if f == "parquet" else r.json(folder)
        out = df if out is None else out.unionByName(df, allowMissingColumns=True)
    return out.withColumnRenamed(part, f"_{part}") if part else out


def list_snapshots(spark: SparkSession, base: str) -> DataFrame:
    """The snapshots of a dataset, from its folder names."""
    return spark.createDataFrame([(v,) for v in snapshot_names(spark, base)[1]], "snapshot string").orderBy("snapshot")


def snapshot_index(spark: SparkSession, base: str, store: str) -> DataFrame:
    """The index table of a dataset's files under ``store``: file, snapshot, the values of all
    partition folders, format, bytes, modification time and rows.

    Only snapshots that the table lacks are listed and counted, and are then added to it.
    Rows come from Parquet footers and JSON lines; no column is read."""
    part, values = snapshot_names(spark, base)
    fs, p = _fs(spark, store)
    known = {r[0] for r in spark.read.parquet(store).select("snapshot").distinct().collect()} if fs.exists(p) else set()
    new = [v for v in values if v not in known]
    for v in new:
        folder = f"{base}/{part}={v}"
        if not _has_data(spark, folder):
            continue
        files = data_files(spark, folder)
        counts = None
        for f in [r[0] for r in files.select("format").distinct().collect()]:
            r = spark.read.option("recursiveFileLookup", True).option("pathGlobFilter", GLOBS[f])
            rows = r.parquet(folder) if f == "parquet" else r.text(folder)
            rows = rows.groupBy(F.col("_metadata.file_path").alias("file")).agg(F.count(F.lit(1)).alias("rows"))
            counts = rows if counts is None else counts.unionByName(rows)
        plain = lambda c: F.regexp_replace(c, "^file:/+", "file:/")
        found = files.withColumn("file", plain("file")).join(counts.withColumn("file", plain("file")), "file", "left")
        pairs = F.transform(F.regexp_extract_all("file", F.lit("/([^/=]+=[^/]+)(?=/)")), lambda x: F.split(x, "=", 2))
        found = found.withColumn("partitions", F.map_from_entries(F.transform(pairs, lambda x: F.struct(x[0], x[1]))))
        (found.select("file", "partitions", "format", "bytes", "modified", F.coalesce("rows", F.lit(0)).alias("rows"),
                      F.lit(v).alias("snapshot")).write.mode("append").parquet(store))
    if not fs.exists(p):
        raise FileNotFoundError(f"no snapshot with data files under {base}")
    return spark.read.parquet(store)


def read_quarantined(spark: SparkSession, base: str, schema: T.StructType) -> tuple[DataFrame, DataFrame]:
    """The rows of all readable Parquet files under ``base``, and (file, status, error) of the others.

    Each file is opened once, by one task: its rows go out as they are read, and a file
    that fails or has none leaves a line that says so (``unreadable``, ``empty``).  What
    came of it is stored, and both results are read from there.  Columns that a file lacks
    are null.  A file is held in memory while it is read (2 GB at most)."""
    schema = T.StructType([T.StructField(f.name, f.dataType) for f in schema.fields])  # lines of files hold nulls
    target = to_arrow_schema(schema)
    extra = [pa.field("_file", pa.string()), pa.field("_status", pa.string()), pa.field("_error", pa.string())]
    whole = pa.schema([*target, *extra])

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        import pyarrow.parquet as pq

        def line(columns: list[pa.Array], n: int, file: str, status: str, error: str | None) -> pa.RecordBatch:
            told = [pa.array([x] * n, pa.string()) for x in (file, status, error)]
            return pa.RecordBatch.from_arrays([*columns, *told], schema=whole)

        none = [pa.nulls(1, f.type) for f in target]
        for batch in batches:
            for file, content in zip(batch["path"].to_pylist(), batch["content"]):
                seen = 0
                try:
                    for rows in pq.ParquetFile(pa.BufferReader(content.as_buffer())).iter_batches(64 << 10):
                        columns = [rows[f.name].cast(f.type) if f.name in rows.schema.names else pa.nulls(rows.num_rows, f.type)
                                   for f in target]
                        seen += rows.num_rows
                        yield line(columns, rows.num_rows, file, "row", None)
                    if not seen:
                        yield line(none, 1, file, "empty", None)
                except Exception as e:  # noqa: BLE001 - whatever is wrong with a file is told of that file
                    yield line(none, 1, file, "unreadable", f"{type(e).__name__}: {e}")

    ddl = T.StructType([*schema.fields, *(T.StructField(f.name, T.StringType()) for f in extra)])
    files = (spark.read.format("binaryFile").option("recursiveFileLookup", True).option("pathGlobFilter", "*.parquet")
             .load(base).select("path", "content"))
    told = materialize(files.mapInArrow(read, ddl), "quarantine")
    name = F.element_at(F.split("_file", "/"), -1)
    # the scan passes over files of no bytes at all; the listing has them
    fs, p = _fs(spark, base)
    it, void = fs.listFiles(p, True), []
    while it.hasNext():
        s = it.next()
        if s.getLen() == 0 and s.getPath().getName().endswith(".parquet") and s.getPath().getName()[0] not in "_.":
            void.append((s.getPath().getName(), "empty", None))
    void = spark.createDataFrame(void, "file string, status string, error string")
    return (told.where("_status = 'row'").drop("_status", "_error"),
            told.where("_status <> 'row'").select(name.alias("file"), F.col("_status").alias("status"),
                                                  F.col("_error").alias("error")).unionByName(void))
