"""Silver standardisation: names, null tokens, strings, dates, source-specific
rules, partition columns and processing metadata.

Every step is a single ``select`` computed from the schema at plan time, so
the whole chain collapses into one projection inside whole-stage codegen —
no shuffle, no UDF.
"""

from __future__ import annotations

import datetime as _dt

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from strata.functions.columns import NULL_TOKENS, py_strip, snake_case

# fixed values
DATE_NAME_TOKENS = {"date", "time", "created", "updated", "timestamp"}
LIFECYCLE_STAGES = {"lead": "Lead", "opportunity": "Opportunity", "customer": "Customer", "churned": "Churned"}
PARTITION_SOURCES = ["timestamp", "order_date", "created_at", "event_time"]
TRANSFORMATION_VERSION = "1.0.0"


def standardize_columns(df: DataFrame) -> DataFrame:
    names = [snake_case(c) for c in df.columns]
    dup = {n for n in names if names.count(n) > 1}
    if dup:
        raise ValueError(f"column names collide after snake_case: {sorted(dup)}")
    return df.toDF(*names)


def _is_str(df: DataFrame, c: str) -> bool:
    return isinstance(df.schema[c].dataType, T.StringType)


def clean_strings(df: DataFrame, tokens: list[str] = NULL_TOKENS) -> DataFrame:
    """Trim non-metadata strings, then map null tokens to null (trim first, so
    ' N/A ' is also caught); lower-case columns whose name mentions email."""
    out = []
    for c in df.columns:
        col = F.col(c)
        if _is_str(df, c):
            v = col if c.startswith("_") else py_strip(col)
            v = F.when(v.isin(tokens), F.lit(None).cast("string")).otherwise(v)
            if "email" in c.lower() and not c.startswith("_"):
                v = F.lower(v)
            col = v
        out.append(col.alias(c))
    return df.select(*out)


def is_date_name(name: str, extra: list[str] | None = None) -> bool:
    toks = set(name.lower().split("_"))
    return bool(toks & DATE_NAME_TOKENS) or name.lower().endswith("_at") or name in (extra or [])


def standardize_dates(df: DataFrame, extra: list[str] | None = None) -> DataFrame:
    """String columns named like dates (whole ``_`` tokens) → timestamps (UTC);
    unparseable → null.  Non-string columns are left alone."""
    return df.select(*[(F.try_to_timestamp(F.col(c)) if _is_str(df, c) and not c.startswith("_")
                        and is_date_name(c, extra) else F.col(c)).alias(c) for c in df.columns])


def transform_crm(df: DataFrame) -> DataFrame:
    cols = {}
    if "lifecycle_stage" in df.columns:
        m = F.create_map(*[x for k, v in LIFECYCLE_STAGES.items() for x in (F.lit(k), F.lit(v))])
        s = F.col("lifecycle_stage")
        cols["lifecycle_stage"] = F.coalesce(F.element_at(m, F.lower(s)), s)
    if "deal_value_usd" in df.columns:
        cols["has_deal"] = F.coalesce(F.col("deal_value_usd") > 0, F.lit(False))
    return df.withColumns(cols) if cols else df


def transform_erp(df: DataFrame) -> DataFrame:
    cols = {c: F.col(c).try_cast("double") for c in ("quantity", "unit_price", "total_amount") if c in df.columns}
    out = df.withColumns(cols) if cols else df
    if "currency" in df.columns:
        out = out.withColumn("currency", F.upper(py_strip(F.col("currency"))))
    if all(c in df.columns for c in ("quantity", "unit_price", "total_amount")):
        out = out.withColumn("_amount_validated", F.coalesce(
            F.abs(F.col("quantity") * F.col("unit_price") - F.col("total_amount")) < 0.01, F.lit(False)))
    return out


def transform_api(df: DataFrame) -> DataFrame:
    cols = {}
    if "event_type" in df.columns:
        cols["event_type"] = F.replace(F.lower("event_type"), F.lit(" "), F.lit("_"))
    if "channel" in df.columns:
        cols["channel"] = F.initcap("channel")
    return df.withColumns(cols) if cols else df


def add_partition_columns(df: DataFrame, as_of: _dt.datetime, clock_for_null: bool = False) -> DataFrame:
    """Year, month and day of the first present source column.  The processing
    clock stands in when there is no such column, and with ``clock_for_null`` also
    for rows whose value is missing or does not parse (null partitions otherwise)."""
    src = next((c for c in PARTITION_SOURCES if c in df.columns), None)
    now = F.lit(as_of).cast("timestamp")
    if src is None:
        ts = now
    else:
        t = F.try_to_timestamp(F.col(src)) if _is_str(df, src) else F.col(src).cast("timestamp")
        ts = F.coalesce(t, now) if clock_for_null else t
    return df.withColumns({
        "_partition_year": F.year(ts),
        "_partition_month": F.lpad(F.month(ts).cast("string"), 2, "0"),
        "_partition_day": F.lpad(F.dayofmonth(ts).cast("string"), 2, "0")})


def add_processing_metadata(df: DataFrame, as_of: _dt.datetime) -> DataFrame:
    return df.withColumns({"_processed_at": F.lit(as_of).cast("timestamp"), "_layer": F.lit("silver"),
                           "_transformation_version": F.lit(TRANSFORMATION_VERSION)})


def add_ingestion_metadata(df: DataFrame, source_system: str, source_type: str, run_id: str,
                           as_of: _dt.datetime, pipeline_version: str = "1.0.0", add_metadata: bool = True) -> DataFrame:
    """When, from where and by which run a row came; ``add_metadata=False`` leaves rows as they are."""
    if not add_metadata:
        return df
    return df.withColumns({"_ingested_at": F.lit(as_of).cast("timestamp"),
                           "_source_system": F.lit(source_system), "_source_type": F.lit(source_type),
                           "_run_id": F.lit(run_id), "_pipeline_version": F.lit(pipeline_version)})


def transform(df: DataFrame, source_type: str, as_of: _dt.datetime, date_columns: list[str] | None = None) -> DataFrame:
    """Full silver chain: names → strings/null tokens → dates → source rules →
    partition columns → processing metadata."""
    out = standardize_columns(df)
    out = clean_strings(out)
    out = standardize_dates(out, date_columns)
    out = {"crm": transform_crm, "erp": transform_erp, "api": transform_api}.get(source_type, lambda d: d)(out)
    out = add_partition_columns(out, as_of)
    return add_processing_metadata(out, as_of)


# --------------------------------------------------------------------------
# flattening
# --------------------------------------------------------------------------

def flatten_struct(df: DataFrame, sep: str = "_") -> DataFrame:
    """Recursively flatten struct columns into ``parent_child`` columns (plan
    time; arrays untouched).  Collisions raise."""
    out: list[Column] = []

    def walk(path: list[str], dt: T.DataType):
        if isinstance(dt, T.StructType):
            for f in dt.fields:
                walk(path + [f.name], f.dataType)
        else:
            ref = F.col(path[0])
            for p in path[1:]:
                ref = ref.getField(p)
            out.append(ref.alias(sep.join(path)))
    for f in df.schema.fields:
        walk([f.name], f.dataType)
    res = df.select(*out)
    if len(set(res.columns)) != len(res.columns):
        raise ValueError(f"flattened names collide: {res.columns}")
    return res


def flatten_contact(df: DataFrame, custom: str = "custom_fields", tags: str = "tags") -> DataFrame:
    """``custom_fields.*`` → ``cf_*``; ``tags`` array → sorted comma string ('' if empty)."""
    cols: list[Column] = []
    for f in df.schema.fields:
        if f.name == custom and isinstance(f.dataType, T.StructType):
            cols += [F.col(custom).getField(x.name).alias(f"cf_{x.name}") for x in f.dataType.fields]
        elif f.name == tags and isinstance(f.dataType, T.ArrayType):
            cols.append(F.when(F.col(tags).isNull(), F.lit(None).cast("string"))
                        .otherwise(F.concat_ws(",", F.array_sort(F.col(tags)))).alias(tags))
        else:
            cols.append(F.col(f.name))
    return df.select(*cols)
