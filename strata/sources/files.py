"""File sources: CSV exports, JSON array documents, API envelopes,
snapshot-partitioned Parquet lake datasets — plus delimiter, encoding and
column-type detection.

Everything is a distributed read: detection aggregates all lines of every file,
never a prefix and never on the driver; lines are numbered across the splits of a
file.  Snapshot folders are in ``strata.sources.snapshots``.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from strata.functions.columns import py_strip
from strata.session import materialize

# fixed values
DELIMITERS = [",", ";", "\t", "|"]
BOOL_TOKENS_TRUE = ["true", "yes"]
BOOL_TOKENS_FALSE = ["false", "no"]
CSV_NULL = "\\N"          # null marker used by our own CSV writers (keeps '' distinct from null)

# microsecond timestamps in text formats (the default writes milliseconds)
TS_OPTS = {"timestampFormat": "yyyy-MM-dd'T'HH:mm:ss.SSSSSSXXX",
           "timestampNTZFormat": "yyyy-MM-dd'T'HH:mm:ss.SSSSSS"}

CSV_OPTS = {"ignoreLeadingWhiteSpace": "false", "ignoreTrailingWhiteSpace": "false", "nullValue": CSV_NULL}


def write_csv(df: DataFrame, path: str, sep: str = ",", encoding: str = "utf-8", header: bool = True) -> None:
    (df.write.mode("overwrite").options(**CSV_OPTS).option("sep", sep).option("encoding", encoding)
     .option("header", header).csv(path))


def read_csv_raw(spark: SparkSession, path: str | list[str], columns: list[str], sep: str = ",", encoding: str = "utf-8",
                 header: bool = True) -> DataFrame:
    """Every column as a string; rows with the wrong number of fields keep their
    raw text in ``_corrupt_record`` (route them to rejects)."""
    schema = T.StructType([T.StructField(c, T.StringType()) for c in columns]
                          + [T.StructField("_corrupt_record", T.StringType())])
    return (spark.read.schema(schema).options(**CSV_OPTS).option("sep", sep).option("encoding", encoding)
            .option("header", header).option("mode", "PERMISSIVE")
            .option("columnNameOfCorruptRecord", "_corrupt_record").csv(path))


def numbered_lines(spark: SparkSession, path: str, encoding: str | None = None) -> DataFrame:
    """Lines of every file with file path and line number (from 0, across all splits).

    The lines are stored once with a row id; a split's first number is the number of
    lines in the file's splits before it, so no window holds more than a file's splits."""
    r = spark.read.option("encoding", encoding) if encoding else spark.read
    lines = materialize(r.text(path).select(
        "value", F.col("_metadata.file_path").alias("file"), F.col("_metadata.file_block_start").alias("_blk"),
        F.monotonically_increasing_id().alias("_id")), "lines")
    splits = lines.groupBy("file", "_blk").agg(F.min("_id").alias("_first"), F.count(F.lit(1)).alias("_n"))
    before = F.sum("_n").over(Window.partitionBy("file").orderBy("_blk").rowsBetween(Window.unboundedPreceding, -1))
    splits = splits.withColumn("_before", F.coalesce(before, F.lit(0))).drop("_n")
    return lines.join(splits, ["file", "_blk"]).select(
        "value", "file", (F.col("_before") + F.col("_id") - F.col("_first")).alias("line_no"))


def skip_rows(spark: SparkSession, path: str, n: int) -> DataFrame:
    """Text lines of every file without its first ``n`` lines (feed to from_csv)."""
    return numbered_lines(spark, path).where(F.col("line_no") >= n).select("value", "file")


def detect_delimiter(spark: SparkSession, path: str) -> DataFrame:
    """Per file: the delimiter (of , ; tab |) whose per-line field count is the
    most stable non-trivial value over all lines; comma by default."""
    lines = spark.read.text(path).select("value", F.col("_metadata.file_path").alias("file"))
    per = lines.select("file", F.inline(F.array(*[
        F.struct(F.lit(i).alias("pref"), F.lit(d).alias("delimiter"),
                 (F.size(F.split(F.col("value"), _re(d))) - 1).alias("n")) for i, d in enumerate(DELIMITERS)])))
    # a row (n = 0) per line and delimiter also tells the files without any
    counts = per.groupBy("file", "pref", "delimiter", "n").agg(F.count(F.lit(1)).alias("freq"))
    w = Window.partitionBy("file").orderBy((F.col("n") > 0).desc(), F.col("freq").desc(), F.col("n").desc(),
                                           F.col("pref"))
    return (counts.withColumn("_r", F.row_number().over(w)).where("_r = 1")
            .select("file", F.when(F.col("n") > 0, F.col("delimiter")).otherwise(F.lit(",")).alias("delimiter")))


def read_csv_folder(spark: SparkSession, path: str, columns: list[str], encoding: str = "utf-8",
                    header: bool = True) -> DataFrame:
    """A folder whose CSV files may have different delimiters: each file is read with its own.

    Files of one delimiter are read together (the driver learns the delimiters, at most
    four, and the names of their files); ``_source_file`` is the scan's file name."""
    found = detect_delimiter(spark, path).groupBy("delimiter").agg(F.collect_list("file").alias("files")).collect()
    out = None
    for r in found:
        part = read_csv_raw(spark, sorted(r["files"]), columns, sep=r["delimiter"], encoding=encoding, header=header)
        part = part.withColumn("_source_file", F.col("_metadata.file_name"))
        out = part if out is None else out.unionByName(part)
    if out is None:
        raise FileNotFoundError(f"no CSV file under {path}")
    return out


def _re(d: str) -> str:
    return {"|": r"\|", "\t": "\t"}.get(d, d)


def detect_encoding(spark: SparkSession, path: str) -> DataFrame:
    """Per file: utf-8 when every line is valid UTF-8, otherwise latin-1 (which
    decodes any byte string)."""
    lines = spark.read.text(path).select("value", F.col("_metadata.file_path").alias("file"))
    return lines.groupBy("file").agg(F.count_if(~F.is_valid_utf8(F.col("value"))).alias("_bad")).select(
        "file", F.when(F.col("_bad") > 0, F.lit("latin-1")).otherwise(F.lit("utf-8")).alias("encoding"))


def infer_types(df: DataFrame) -> DataFrame:
    """Per string column: bigint / double / boolean / string chosen from *all*
    non-blank values (one aggregation pass)."""
    cols = [c for c in df.columns if not c.startswith("_")]
    aggs = []
    for i, c in enumerate(cols):
        v = F.nullif(py_strip(F.col(c)), F.lit(""))
        aggs += [F.count(v).alias(f"n{i}"), F.count(v.try_cast("bigint")).alias(f"i{i}"),
                 F.count(v.try_cast("double")).alias(f"d{i}"),
                 F.count_if(F.lower(v).isin(BOOL_TOKENS_TRUE + BOOL_TOKENS_FALSE)).alias(f"b{i}")]
    wide = df.agg(*aggs)
    rows = []
    for i, c in enumerate(cols):
        n, ii, dd, bb = (F.col(f"{x}{i}") for x in "nidb")
        t = (F.when(n == 0, F.lit("string")).when(bb == n, F.lit("boolean")).when(ii == n, F.lit("bigint"))
             .when(dd == n, F.lit("double")).otherwise(F.lit("string")))
        rows.append(F.struct(F.lit(c).alias("column"), t.alias("inferred_type"), n.alias("non_null"),
                             ii.alias("int_values"), dd.alias("numeric_values"), bb.alias("bool_values")))
    return wide.select(F.inline(F.array(*rows)))


def apply_types(df: DataFrame, types: dict[str, str]) -> DataFrame:
    out: list[Column] = []
    for c in df.columns:
        v = F.nullif(py_strip(F.col(c)), F.lit(""))
        t = types.get(c, "string")
        if t == "boolean":
            v = F.when(F.lower(v).isin(BOOL_TOKENS_TRUE), F.lit(True)).when(F.lower(v).isin(BOOL_TOKENS_FALSE),
                                                                          F.lit(False))
        elif t != "string":
            v = v.try_cast(t)
        out.append(v.alias(c))
    return df.select(*out)


def read_json_array(spark: SparkSession, path: str, schema: T.StructType | str) -> DataFrame:
    """JSON documents whose top level is an array of records (one per line, or
    a whole file with ``multiLine``) → one row per record."""
    return spark.read.schema(schema).json(path)


def read_envelope(spark: SparkSession, path: str, data_key: str = "data",
                  schema: T.StructType | str | None = None) -> DataFrame:
    """API envelopes: the records under ``data_key`` (an array) become rows; the
    other envelope keys are kept as ``api_metadata``.  A document without the
    key is itself one record."""
    r = spark.read.options(**TS_OPTS)
    if schema is not None:
        r = r.schema(schema)
    env = r.json(path)
    if data_key not in env.columns:
        return env
    others = [c for c in env.columns if c != data_key]
    meta = F.struct(*[F.col(c) for c in others]) if others else F.lit(None)
    return env.select(meta.alias("api_metadata"), F.explode(F.col(data_key)).alias("_r")).select("_r.*", "api_metadata")
