"""Table schemas, enforcement (STRICT / PERMISSIVE / DROP) and evolution.

Schema comparison happens at plan time on ``df.schema``; the row-level
checks (null in non-nullable columns, values that do not parse as the
declared type) are counted in one aggregation pass and reported as one row
per violation.
"""

from __future__ import annotations

from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

SPARK_TYPES = {"string": T.StringType(), "integer": T.LongType(), "float": T.DoubleType(),
               "boolean": T.BooleanType(), "timestamp": T.TimestampType(), "date": T.DateType(),
               "array": T.ArrayType(T.StringType()), "object": T.MapType(T.StringType(), T.StringType())}


@dataclass
class ColumnSchema:
    name: str
    type: str = "string"
    required: bool = False
    nullable: bool = True
    description: str = ""
    default: object = None


@dataclass
class TableSchema:
    name: str
    version: str = "1.0.0"
    description: str = ""
    columns: list[ColumnSchema] = field(default_factory=list)
    partition_columns: list[str] = field(default_factory=list)
    primary_key: list[str] = field(default_factory=list)

    @property
    def column_names(self) -> list[str]:
        return [c.name for c in self.columns]

    @property
    def required_columns(self) -> list[str]:
        return [c.name for c in self.columns if c.required]

    def get_column(self, name: str) -> ColumnSchema | None:
        return next((c for c in self.columns if c.name == name), None)

    def to_struct(self) -> T.StructType:
        return T.StructType([T.StructField(c.name, SPARK_TYPES[c.type], c.nullable,
                                           {"description": c.description, "required": c.required})
                             for c in self.columns])

    def to_dict(self) -> dict:
        return {"name": self.name, "version": self.version, "description": self.description,
                "columns": [c.__dict__ for c in self.columns], "primary_key": self.primary_key,
                "partition_columns": self.partition_columns}


def _c(name, typ, required=False, nullable=True, description=""):
    return ColumnSchema(name, typ, required, nullable, description)


# fixed values: the two predefined silver schemas
CRM_SCHEMA = TableSchema("crm_contacts", "1.0.0", "CRM contact records", [
    _c("contact_id", "string", True, False), _c("first_name", "string"), _c("last_name", "string"),
    _c("email", "string", True, False), _c("company", "string", True), _c("industry", "string"),
    _c("country", "string"), _c("city", "string"), _c("lifecycle_stage", "string"),
    _c("deal_value_usd", "float"), _c("created_at", "timestamp"), _c("last_interaction", "timestamp"),
    _c("tags", "string")], ["_partition_year", "_partition_month", "_partition_day"], ["contact_id"])

ERP_SCHEMA = TableSchema("erp_transactions", "1.0.0", "ERP transaction records", [
    _c("transaction_id", "string", True, False), _c("order_date", "date", True),
    _c("customer_id", "string", True), _c("product_sku", "string", True), _c("product_name", "string"),
    _c("category", "string"), _c("quantity", "integer", True), _c("unit_price", "float"),
    _c("total_amount", "float", True), _c("currency", "string"), _c("status", "string"),
    _c("country", "string"), _c("region", "string")],
    ["_partition_year", "_partition_month", "_partition_day"], ["transaction_id"])


class SchemaRegistry:
    def __init__(self) -> None:
        self.schemas: dict[str, TableSchema] = {}
        self.register(CRM_SCHEMA)
        self.register(ERP_SCHEMA)

    def register(self, schema: TableSchema) -> None:
        self.schemas[schema.name] = schema

    def get(self, name: str) -> TableSchema | None:
        return self.schemas.get(name)

    def list_schemas(self, spark: SparkSession) -> DataFrame:
        rows = [(s.name, s.version, len(s.columns), s.description) for s in self.schemas.values()]
        return spark.createDataFrame(rows, "name string, version string, columns int, description string")


def type_mismatch(df: DataFrame, col: ColumnSchema) -> Column | None:
    """Predicate: value present but not parseable as the declared type."""
    c = F.col(col.name)
    s = F.trim(c.cast("string"))
    if col.type in ("integer", "float"):
        if isinstance(df.schema[col.name].dataType, T.NumericType):
            return None
        return c.isNotNull() & s.try_cast("double").isNull()
    if col.type in ("timestamp", "date"):
        if isinstance(df.schema[col.name].dataType, (T.DateType, T.TimestampType, T.TimestampNTZType)):
            return None
        return c.isNotNull() & F.try_to_timestamp(s).isNull()
    return None


def violations(df: DataFrame, schema: TableSchema, mode: str = "permissive") -> DataFrame:
    """One row per violation: type, column, expected_type, count, message."""
    spark = df.sparkSession
    cols = set(df.columns)
    static = []
    for c in schema.columns:
        if c.required and c.name not in cols:
            static.append(("missing_required_column", c.name, None, None,
                           f"Required column '{c.name}' is missing"))
    extra = [c for c in df.columns if c not in schema.column_names and not c.startswith("_")]
    if extra and mode in ("drop", "permissive"):
        kind = "extra_columns_dropped" if mode == "drop" else "extra_columns_kept"
        msg = (f"Dropped {len(extra)} extra columns: {extra}" if mode == "drop"
               else f"{len(extra)} extra columns found and kept: {extra}")
        static.append((kind, ",".join(extra), None, None, msg))
    checks = []
    for c in schema.columns:
        if c.name not in cols:
            continue
        if not c.nullable:
            checks.append(("null_violation", c.name, None, F.col(c.name).isNull(),
                           f"Non-nullable column '{c.name}' has {{}} null values"))
        tm = type_mismatch(df, c)
        if tm is not None:
            what = {"integer": "non-integer values", "float": "non-numeric values"}.get(c.type, "invalid date values")
            checks.append(("type_mismatch", c.name, c.type, tm, f"Column '{c.name}': {{}} {what}"))
    schema_row = "type string, column string, expected_type string, count bigint, message string"
    out = spark.createDataFrame(static, schema_row)
    if checks:
        wide = df.agg(*[F.count_if(p).alias(f"_v{i}") for i, (_, _, _, p, _) in enumerate(checks)])
        rows = F.array(*[F.struct(F.lit(k).alias("type"), F.lit(col).alias("column"),
                                  F.lit(et).cast("string").alias("expected_type"),
                                  F.col(f"_v{i}").alias("count"),
                                  F.replace(F.lit(msg), F.lit("{}"), F.col(f"_v{i}").cast("string")).alias("message"))
                         for i, (k, col, et, _, msg) in enumerate(checks)])
        counted = wide.select(F.inline(rows)).where("count > 0")
        out = out.unionByName(counted)
    return out


def enforce(df: DataFrame, schema: TableSchema, mode: str = "permissive", strict_types: bool = True) -> DataFrame:
    """STRICT: empty result when a required column is missing, rows with nulls in
    non-nullable columns (and, with ``strict_types``, unparseable values) removed.
    DROP: extra non-metadata columns removed.  PERMISSIVE: rows kept, tagged with
    ``_schema_violations``."""
    cols = set(df.columns)
    if mode == "strict" and any(c.required and c.name not in cols for c in schema.columns):
        return df.limit(0)
    bad: list[tuple[Column, str]] = []
    for c in schema.columns:
        if c.name not in cols:
            continue
        if not c.nullable:
            bad.append((F.col(c.name).isNull(), f"null:{c.name}"))
        tm = type_mismatch(df, c)
        if tm is not None and (mode != "strict" or strict_types):
            bad.append((tm, f"type:{c.name}"))
    if mode == "strict":
        cond = F.lit(False)
        for p, _ in bad:
            cond = cond | F.coalesce(p, F.lit(False))
        return df.where(~cond)
    if mode == "drop":
        extra = [c for c in df.columns if c not in schema.column_names and not c.startswith("_")]
        return df.drop(*extra)
    tags = F.filter(F.array(*[F.when(p, F.lit(m)) for p, m in bad]), lambda x: x.isNotNull()) if bad \
        else F.array().cast("array<string>")
    return df.withColumn("_schema_violations", tags)


def evolve(df: DataFrame, schema: TableSchema) -> DataFrame:
    """Backward-compatible evolution: add missing columns with their defaults,
    cast declared columns to the schema type (unparseable → null), keep extras."""
    out = []
    for c in schema.columns:
        t = SPARK_TYPES[c.type]
        if c.name in df.columns:
            v = F.col(c.name) if df.schema[c.name].dataType == t else F.col(c.name).try_cast(t)
            if c.default is not None:
                v = F.coalesce(v, F.lit(c.default).cast(t))
        else:
            v = F.lit(c.default).cast(t)
        out.append(v.alias(c.name))
    extras = [F.col(c) for c in df.columns if c not in schema.column_names]
    return df.select(*out, *extras)


def union_versions(frames: list[DataFrame]) -> DataFrame:
    """Concatenate batches whose columns differ (missing → null)."""
    out = frames[0]
    for f in frames[1:]:
        out = out.unionByName(f, allowMissingColumns=True)
    return out
