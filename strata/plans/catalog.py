"""Catalog and ad-hoc query surface: datasets by layer with row counts and
latest quality score, table schemas, SQL against a layer with a row limit,
and registration of a DataFrame as a queryable table."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

SQL_TYPE_NAMES = {T.LongType: "BIGINT", T.IntegerType: "INTEGER", T.ShortType: "SMALLINT",
                  T.StringType: "VARCHAR", T.DoubleType: "DOUBLE", T.FloatType: "FLOAT",
                  T.BooleanType: "BOOLEAN", T.DateType: "DATE", T.TimestampNTZType: "TIMESTAMP",
                  T.TimestampType: "TIMESTAMP WITH TIME ZONE"}


def sql_type(dt: T.DataType) -> str:
    if isinstance(dt, T.ArrayType):
        return sql_type(dt.elementType) + "[]"
    if isinstance(dt, T.DecimalType):
        return f"DECIMAL({dt.precision},{dt.scale})"
    return SQL_TYPE_NAMES.get(type(dt), dt.simpleString().upper())


@dataclass
class Entry:
    layer: str
    name: str
    description: str
    df: DataFrame


class Catalog:
    def __init__(self, spark: SparkSession) -> None:
        self.spark = spark
        self.entries: dict[tuple[str, str], Entry] = {}

    def register(self, layer: str, name: str, df: DataFrame, description: str = "") -> None:
        """Register a DataFrame under a layer (also as a temp view ``name``)."""
        self.entries[(layer, name)] = Entry(layer, name, description, df)
        df.createOrReplaceTempView(name)

    def list_datasets(self, layer: str | None = None, names: list[str] | None = None,
                      quality: DataFrame | None = None) -> DataFrame:
        """layer, name, description, row_count, column_count, last_updated, quality_score.

        Counts come from Parquet footers and times from the file listing: no column is
        scanned.  ``quality`` has (dataset_name, overall_score, run_ts)."""
        parts = []
        for (ly, nm), e in sorted(self.entries.items()):
            if (layer and ly != layer) or (names and nm not in names):
                continue
            last = F.max("_metadata.file_modification_time") if e.df.inputFiles() else F.lit(None).cast("timestamp")
            parts.append(e.df.agg(F.count(F.lit(1)).alias("row_count"), last.alias("last_updated")).select(
                F.lit(ly).alias("layer"), F.lit(nm).alias("name"), F.lit(e.description).alias("description"),
                "row_count", F.lit(len(e.df.columns)).alias("column_count"), "last_updated"))
        if not parts:
            return self.spark.createDataFrame([], "layer string, name string, description string, "
                                                  "row_count bigint, column_count int, last_updated timestamp, "
                                                  "quality_score double")
        out = parts[0]
        for p in parts[1:]:
            out = out.unionByName(p)
        if quality is None:
            return out.withColumn("quality_score", F.lit(None).cast("double"))
        latest = quality.groupBy(F.col("dataset_name").alias("name")).agg(
            F.max_by("overall_score", "run_ts").cast("double").alias("quality_score"))
        return out.join(latest, "name", "left").select(*out.columns, "quality_score")

    def get_schema(self, name: str, layer: str | None = None) -> DataFrame:
        match = [e for (ly, nm), e in self.entries.items() if nm == name and (layer is None or ly == layer)]
        if not match:
            raise KeyError(f"unknown table {name!r}")
        fields = match[0].df.schema.fields
        rows = [(f.name, i + 1, sql_type(f.dataType), f.nullable) for i, f in enumerate(fields)]
        return self.spark.createDataFrame(rows, "column_name string, ordinal_position int, data_type string, "
                                                "is_nullable boolean")

    def query(self, sql: str, limit: int | None = None, layer: str | None = None) -> DataFrame:
        """Ad-hoc SQL over the registered views, all rows unless ``limit`` is given.
        ``layer`` lets the names stand for that layer's datasets, also where another
        layer has one of the same name."""
        for (ly, name), e in self.entries.items():
            if layer is None or ly == layer:
                e.df.createOrReplaceTempView(name)
        out = self.spark.sql(sql)
        return out.limit(limit) if limit else out
