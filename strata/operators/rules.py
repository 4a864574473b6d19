"""Row validation: rule sets compiled into one array-of-messages column.

A source's rules become ``_errors array<string>`` (messages of the rules that
fail, in a fixed rule order), so accept/reject is a single projection: no
per-row Python, one pass, and the rejected side keeps its reasons for the
dead-letter table.  The only shuffle is the duplicate-id rule, which ranks the ids with
a few columns and brings the flags back as bitmaps of row numbers.
"""

from __future__ import annotations

import datetime as _dt
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from strata.functions.columns import error_list, py_strip
from strata.session import materialize

# fixed values: rule vocabularies of the connectors; the rules' messages below are fixed values too
ERP_REQUIRED = ["transaction_id", "order_date", "product_sku", "quantity", "total_amount"]
ERP_STATUSES = ["Completed", "Pending", "Shipped", "Processing", "Cancelled", "Returned"]
ERP_CURRENCIES = ["USD", "MXN", "EUR", "CAD"]
CRM_REQUIRED = ["contact_id", "email", "company"]
EMAIL_PATTERN = r"^[a-zA-Z0-9._%+-]+@[a-zA-Z0-9.-]+\.[a-zA-Z]{2,}$"
EVENT_ID_FIELDS = ["event_id", "id", "record_id", "transaction_id"]
EVENT_TIME_FIELDS = ["timestamp", "created_at", "event_time", "date"]
LAKE_AMOUNT_FIELDS = ["gross_amount", "precio_unit", "costo_unit", "qty"]


def _s(c: Column) -> Column:
    return c.cast("string")


def blank_str(c: Column) -> Column:
    return c.isNull() | (py_strip(_s(c)) == "")


def truthy(df: DataFrame, name: str) -> Column:
    """Python truthiness of a field: non-null and not '', 0 or False."""
    if name not in df.columns:
        return F.lit(False)
    t = df.schema[name].dataType
    c = F.col(name)
    if isinstance(t, T.StringType):
        return c.isNotNull() & (c != "")
    if isinstance(t, T.BooleanType):
        return F.coalesce(c, F.lit(False))
    if isinstance(t, T.NumericType):
        return c.isNotNull() & (c != 0)
    return c.isNotNull()


def _arrival(df: DataFrame, key: str, order: list[str], within: list[str] | None = None) -> list[str]:
    """The order columns, then all others that can be ordered; a key's rows have the key in common."""
    rest = [f.name for f in df.schema.fields if f.name not in order
            and not isinstance(f.dataType, (T.MapType, T.VariantType))]
    return [c for c in [*order, *rest] if c != key and c not in (within or [])]


#: rows that a bitmap of ``with_duplicate_flag`` stands for (4 KB), and bitmaps that may be broadcast (64 MB)
_BITS, _BROADCAST_BITMAPS = 32768, 16384


def with_duplicate_flag(df: DataFrame, key: str, order: list[str], out: str = "_dup", hot_rows: int = 200_000,
                        within: list[str] | None = None) -> DataFrame:
    """``out`` is true for every arrival of a non-empty key after its first one
    — also when the first arrival is itself rejected for other reasons.

    The rows are written once with a row number, and all branches read that
    table, so the source plan runs once and the flag depends on no later plan.
    The first arrival per key is the least by the order columns, then all other
    columns, then the row number, which so only tells identical rows apart: of n
    copies exactly n - 1 are flagged.

    Only the key, the first columns of that order and the row number are shuffled; rows
    that tie there are told apart by the others in a second, small pass.  Keys that a sample
    finds in more than about ``hot_rows`` rows take a partially aggregated ``min`` instead, so
    no window holds them; that changes the plan, not the flags.  The numbers of the
    flagged rows come back as bitmaps, so the rows themselves stay where they are.

    ``within`` names columns that the key determines and by which the rows already lie
    together, with no hot key among them.  Then one window ranks the rows where they are, and
    nothing is written or shuffled."""
    tag = "_row_tag"
    if within:
        by = _arrival(df, key, order, within)
        nth = F.row_number().over(Window.partitionBy(*within, key).orderBy(*(by or [key])))
        return df.withColumn(out, F.coalesce(_s(F.col(key)) != "", F.lit(False)) & (nth > 1))
    d = materialize(df.withColumn(tag, F.monotonically_increasing_id()), "arrivals")
    by = _arrival(df, key, order)
    named = d.where(F.col(key).isNotNull() & (_s(F.col(key)) != ""))
    hot = [r[0] for r in named.select(key).sample(min(1.0, 200 / hot_rows), 1).groupBy(key).count()
           .where("count > 200").orderBy(F.col("count").desc()).limit(1000).collect()]
    is_hot = F.col(key).isin(hot) if hot else F.lit(False)

    first = Window.partitionBy(key).orderBy(*(by[:3] or [key]))
    nth = Window.partitionBy(key).orderBy(*by[:3], tag)
    marks = named.where(~is_hot).select(key, *by[:3], tag) \
        .withColumn("_n", F.row_number().over(nth)).withColumn("_rank", F.rank().over(first)) \
        .withColumn("_next", F.lead("_rank").over(nth))
    later, tied = F.col("_rank") > 1, (F.col("_n") > 1) | (F.col("_next") == 1)
    marks = materialize(marks.where(later | tied).select(tag, later.alias("_later")), "later_arrivals")
    flagged = marks.where("_later").select(tag)
    ties = marks.where("NOT _later")
    if not ties.isEmpty():
        nth = Window.partitionBy(key, *by[:3]).orderBy(*by[3:], tag)
        flagged = flagged.unionByName(d.join(ties, tag, "left_semi").withColumn("_n", F.row_number().over(nth))
                                      .where("_n > 1").select(tag))
    if hot:
        heads = named.where(is_hot).groupBy(F.col(key).alias("_key")).agg(
            F.min(F.struct(*[F.col(c) for c in by], F.col(tag))).getField(tag).alias("_first"))
        flagged = flagged.unionByName(named.where(is_hot).join(F.broadcast(heads), F.col(key) == F.col("_key"))
                                      .where(F.col(tag) != F.col("_first")).select(tag))
    bitmaps = materialize(flagged.select(F.floor(F.col(tag) / _BITS).alias("_at"), (F.col(tag) % _BITS).alias("_bit"))
                          .repartition("_at").groupBy("_at").agg(F.bitmap_construct_agg("_bit").alias("_bits")), "flags")
    few = bitmaps.limit(_BROADCAST_BITMAPS + 1).count() <= _BROADCAST_BITMAPS
    bit = (F.col(tag) % _BITS).cast("int")
    byte = F.conv(F.hex(F.col("_bits").substr(F.floor(bit / 8).cast("int") + 1, F.lit(1))), 16, 10).cast("int")
    return (d.withColumn("_at", F.floor(F.col(tag) / _BITS))
            .join(F.broadcast(bitmaps) if few else bitmaps, "_at", "left")
            .withColumn(out, F.coalesce(F.getbit(byte, bit % 8) == 1, F.lit(False)))
            .select(*df.columns, out))


def with_errors(df: DataFrame, checks: list[tuple[Column, Column]]) -> DataFrame:
    # the list is built only for the rows that fail a rule
    errs = F.when(reduce(Column.__or__, [F.coalesce(c, F.lit(False)) for c, _ in checks]), error_list(checks)) \
        .otherwise(F.array().cast("array<string>"))
    # a step of its own, so the rules are not run again for each column made of the list
    errors = F.col("_errors")
    return df.withColumn("_errors", errs).withColumns({
        "_error": F.when(F.size(errors) > 0, F.array_join(errors, "; ")), "_is_valid": F.size(errors) == 0})


def normalize_erp(raw: DataFrame) -> DataFrame:
    """Trim strings and turn blanks into null (quantity/amount typed beside the raw text)."""
    return raw.select(*[F.nullif(py_strip(F.col(c)), F.lit("")).alias(c) if t == "string" else F.col(c)
                        for c, t in raw.dtypes])


def validate_transactions(raw: DataFrame, arrival: list[str], within: list[str] | None = None) -> DataFrame:
    """The transaction rules; ``within`` as in ``with_duplicate_flag`` (these columns are dropped)."""
    d = normalize_erp(raw)
    q_int = F.col("quantity").try_cast("int")
    amt = F.col("total_amount").try_cast("double")
    checks = [(blank_str(F.col(f)), F.lit(f"Missing required field: {f}")) for f in ERP_REQUIRED]
    checks += [
        (F.col("_dup"), F.concat(F.lit("Duplicate transaction_id: "), F.col("transaction_id"))),
        (F.col("quantity").isNotNull() & q_int.isNull(), F.concat(F.lit("Invalid quantity: "), F.col("quantity"))),
        (q_int <= 0, F.concat(F.lit("Non-positive quantity: "), _s(q_int))),
        (F.col("total_amount").isNotNull() & amt.isNull(),
         F.concat(F.lit("Invalid total_amount: "), F.col("total_amount"))),
        (amt < 0, F.concat(F.lit("Negative total amount: "), _s(amt))),
        (F.col("currency").isNotNull() & ~F.col("currency").isin(ERP_CURRENCIES),
         F.concat(F.lit("Invalid currency: "), F.col("currency"))),
        (F.col("status").isNotNull() & ~F.col("status").isin(ERP_STATUSES),
         F.concat(F.lit("Invalid status: "), F.col("status"))),
        (blank_str(F.col("customer_id")), F.lit("Missing customer_id")),
        (F.col("product_sku").startswith("INVALID"), F.concat(F.lit("Invalid SKU format: "), F.col("product_sku"))),
    ]
    d = with_duplicate_flag(d, "transaction_id", arrival, within=within)
    return with_errors(d, checks).drop("_dup", *(within or []))


def validate_contacts(df: DataFrame, arrival: list[str]) -> DataFrame:
    checks = [(blank_str(F.col(f)), F.lit(f"Missing or empty required field: {f}")) for f in CRM_REQUIRED]
    email = F.col("email")
    checks += [
        ((email.isNotNull() & (email != "")) & ~email.rlike(EMAIL_PATTERN),
         F.concat(F.lit("Invalid email format: "), email)),
        (F.col("deal_value_usd") < 0, F.concat(F.lit("Negative deal value: "), _s(F.col("deal_value_usd")))),
        (F.col("_dup"), F.concat(F.lit("Duplicate contact_id: "), F.col("contact_id"))),
    ]
    d = with_duplicate_flag(df, "contact_id", arrival)
    return with_errors(d, checks).drop("_dup")


def _present_nonblank(df: DataFrame, name: str) -> Column:
    t = df.schema[name].dataType
    c = F.col(name)
    if isinstance(t, T.StringType):
        return c.isNotNull() & (py_strip(c) != "")
    return c.isNotNull()


def validate_events(df: DataFrame) -> DataFrame:
    has_id = F.lit(False)
    for f in EVENT_ID_FIELDS:
        has_id = has_id | truthy(df, f)
    has_time = F.lit(False)
    for f in EVENT_TIME_FIELDS:
        has_time = has_time | truthy(df, f)
    fields = [c for c in df.columns if not c.startswith("_")]
    n_present = sum((_present_nonblank(df, c).cast("int") for c in fields), F.lit(0))
    checks = [(~has_id, F.lit("No identifier field found (event_id, id, record_id)")),
              (~has_time, F.lit("No timestamp field found")),
              (n_present < 2, F.lit("Record has too few non-null fields"))]
    return with_errors(df, checks)


def validate_csv(df: DataFrame, required: list[str]) -> DataFrame:
    checks = [(blank_str(F.col(c)) if c in df.columns else F.lit(True),
               F.lit(f"Missing required column: {c}")) for c in required]
    any_value = F.lit(False)
    for c in df.columns:
        any_value = any_value | _present_nonblank(df, c)
    checks.append((~any_value, F.lit("Empty row — all values are null or empty")))
    return with_errors(df, checks)


def validate_lake(df: DataFrame, dataset: str, company_ids: list[str]) -> DataFrame:
    """Lake dataset rules; quantities may be negative (returns), other amounts not,
    and a company must be one of ``company_ids``."""
    def nullish(c: str) -> Column:
        s = _s(F.col(c))
        return F.col(c).isNull() | (py_strip(s) == "") | (s == "nan") | (s == "NaN")
    all_null = F.lit(True)
    for c in df.columns:
        all_null = all_null & nullish(c)
    checks = [(all_null, F.lit("All fields are null/empty"))]
    cid = F.col("company_id") if "company_id" in df.columns else F.lit(None).cast("string")
    bad_company = (cid.isNotNull() & (cid != "") & ~cid.isin(company_ids),
                   F.concat(F.lit("Unknown company_id: "), cid))
    if dataset == "dim_company":
        checks.append(bad_company)
    elif dataset in ("g_factura_line", "fct_sell_in"):
        for f in LAKE_AMOUNT_FIELDS:
            if f not in df.columns:
                continue
            v = F.col(f).try_cast("double")
            checks.append((F.col(f).isNotNull() & v.isNull(), F.concat(F.lit(f"Invalid {f}: "), _s(F.col(f)))))
            if f != "qty":
                checks.append((v < 0, F.concat(F.lit(f"Negative {f}: "), _s(v))))
        checks.append(bad_company)
    return with_errors(df, checks)


def split(validated: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(accepted, rejected) views of one validated frame."""
    acc = validated.where("_is_valid").drop("_errors", "_error", "_is_valid")
    rej = validated.where(~F.col("_is_valid"))
    return acc, rej


def ingest_metrics(validated: DataFrame, source_name: str, source_type: str) -> DataFrame:
    """read / accepted / rejected, rejection %, status (success when nothing was
    rejected — also for an empty input — partial, or failed)."""
    m = validated.agg(F.count(F.lit(1)).alias("records_read"),
                      F.count_if(F.col("_is_valid")).alias("records_accepted"),
                      F.count_if(~F.col("_is_valid")).alias("records_rejected"))
    read, acc, rej = F.col("records_read"), F.col("records_accepted"), F.col("records_rejected")
    from strata.functions.numeric import ratio_round
    return m.select(F.lit(source_name).alias("source_name"), F.lit(source_type).alias("source_type"),
                    read, acc, rej,
                    F.when(read == 0, F.lit(0.0)).otherwise(ratio_round(rej * 100, read, 2)).alias("rejection_rate_pct"),
                    F.when(rej == 0, F.lit("success")).when(acc > 0, F.lit("partial"))
                    .otherwise(F.lit("failed")).alias("status"))


def dead_letter(rejected: DataFrame, as_of: _dt.datetime) -> DataFrame:
    """Rejected rows as (record JSON, error text, reject timestamp, reject_date)."""
    payload = [c for c in rejected.columns if c not in ("_errors", "_error", "_is_valid")]
    ts = F.lit(as_of).cast("timestamp")
    return rejected.select(F.to_json(F.struct(*payload)).alias("record"), F.col("_error").alias("error"),
                           ts.alias("timestamp"), F.to_date(ts).alias("reject_date"))
