"""Join-shaped operators: change detection / SCD2 between loads, dimension
membership checks, the unified customer view and same-key time-window
neighbour counts.

Sizes: both sides of a change detection are full loads, so it is one
sort-merge (or AQE-chosen) full outer join on the business key.  The
customer view pre-aggregates transactions and interactions to one row per
customer *before* joining, so every join is 1:1 and a hot customer is
reduced map-side.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from strata.functions.numeric import cents


def row_hash(cols: list[Column]) -> Column:
    return F.md5(F.concat_ws("\u0001", *[F.coalesce(c.cast("string"), F.lit("")) for c in cols]))


def change_detection(previous: DataFrame, current: DataFrame, key: str, tracked: list[str]) -> DataFrame:
    """key, change_type ∈ {new, deleted, changed, unchanged}, old/new hashes."""
    p = previous.select(F.col(key).alias("_k"), row_hash([F.col(c) for c in tracked]).alias("old_hash"))
    c = current.select(F.col(key).alias("_k"), row_hash([F.col(c) for c in tracked]).alias("new_hash"))
    j = p.join(c, "_k", "full_outer")
    kind = (F.when(F.col("old_hash").isNull(), F.lit("new")).when(F.col("new_hash").isNull(), F.lit("deleted"))
            .when(F.col("old_hash") != F.col("new_hash"), F.lit("changed")).otherwise(F.lit("unchanged")))
    return j.select(F.col("_k").alias(key), kind.alias("change_type"), "old_hash", "new_hash")


def scd2(history: DataFrame, key: str, tracked: list[str], load_col: str) -> DataFrame:
    """Type-2 history from stacked loads: consecutive identical versions collapse;
    valid_to = next version's valid_from; a key missing from a later load is
    closed at that load."""
    h = history.withColumn("_h", row_hash([F.col(c) for c in tracked]))
    w = Window.partitionBy(key).orderBy(load_col)
    versions = (h.withColumn("_prev", F.lag("_h").over(w))
                .where(F.col("_prev").isNull() | (F.col("_prev") != F.col("_h"))))
    loads = history.select(load_col).distinct()
    last_seen = history.groupBy(key).agg(F.max(load_col).alias("_last"))
    next_load = loads.select(F.col(load_col).alias("_l"),
                             F.lead(load_col).over(Window.orderBy(load_col)).alias("_after"))
    close = last_seen.join(next_load, last_seen["_last"] == next_load["_l"], "left").select(key, "_after")
    v = versions.withColumn("_next", F.lead(load_col).over(w)).join(close, key, "left")
    return v.select(key, *tracked, F.col(load_col).alias("valid_from"),
                    F.coalesce(F.col("_next"), F.col("_after")).alias("valid_to"),
                    (F.col("_next").isNull() & F.col("_after").isNull()).alias("is_current"))


def not_in_dimension(facts: DataFrame, dim: DataFrame, fact_key: str, dim_key: str) -> DataFrame:
    """Fact rows whose key has no dimension row (left anti join)."""
    return facts.join(dim.select(F.col(dim_key).alias(fact_key)).distinct(), fact_key, "left_anti")


def customer_360(contacts: DataFrame, txns: DataFrame, events: DataFrame, cust: str = "customer_id") -> DataFrame:
    t = txns.groupBy(cust).agg(
        F.count(F.lit(1)).alias("order_count"),
        (F.sum(cents(F.col("total_amount"))) / 100.0).alias("lifetime_revenue"),
        F.min("order_date").alias("first_order_date"), F.max("order_date").alias("last_order_date"))
    e = events.groupBy(cust).agg(
        F.count(F.lit(1)).alias("interaction_count"),
        F.count_distinct("event_type").alias("interaction_types"),
        F.max("ts").alias("last_interaction"))
    return (contacts.join(t, cust, "left").join(e, cust, "left")
            .withColumns({"order_count": F.coalesce("order_count", F.lit(0)),
                          "interaction_count": F.coalesce("interaction_count", F.lit(0)),
                          "lifetime_revenue": F.coalesce("lifetime_revenue", F.lit(0.0))}))


def window_neighbors(df: DataFrame, keys: list[str], ts_col: str, id_col: str, hours: float,
                     chunk_seconds: float | None = None) -> DataFrame:
    """Per event: how many events of the same key fall in [ts - N, ts).

    count_lt(x) = events of the key in earlier time chunks + events of x's
    chunk before x; the result is count_lt(ts) - count_lt(ts - N).  Running
    counts are windows over (key, chunk), so a hot key is split by time, and no
    pair of events is ever materialised."""
    win = int(float(hours) * 3600 * 1_000_000)
    ch = int(float(chunk_seconds or max(hours * 3600 / 16.0, 1.0)) * 1_000_000)
    base = df.select(F.to_json(F.struct(*[F.col(k) for k in keys])).alias("_key"),
                     F.col(id_col).alias("_id"), F.unix_micros(F.col(ts_col).cast("timestamp")).alias("_t")) \
        .where(F.col("_t").isNotNull())
    ev = base.select("_key", F.col("_t").alias("_pos"), F.lit(1).alias("_e"), F.lit(None).cast("bigint").alias("_id"),
                     F.lit(None).cast("string").alias("_side"))
    probes = (base.select("_key", F.col("_t").alias("_pos"), F.lit(0).alias("_e"), "_id", F.lit("hi").alias("_side"))
              .unionByName(base.select("_key", (F.col("_t") - win).alias("_pos"), F.lit(0).alias("_e"), "_id",
                                       F.lit("lo").alias("_side"))))
    u = ev.unionByName(probes).withColumn("_c", F.floor(F.col("_pos") / ch))
    # probes sort before events at an equal position → strictly-before counts
    w = (Window.partitionBy("_key", "_c").orderBy("_pos", "_e")
         .rowsBetween(Window.unboundedPreceding, Window.currentRow))
    within = u.withColumn("_in", F.sum("_e").over(w)).where(F.col("_e") == 0)
    totals = base.groupBy("_key", F.floor(F.col("_t") / ch).alias("_c")).agg(F.count(F.lit(1)).alias("_n"))
    pc = within.select("_key", "_c").distinct()
    cu = (totals.select("_key", "_c", "_n", F.lit(1).alias("_k"))
          .unionByName(pc.select("_key", "_c", F.lit(0).cast("bigint").alias("_n"), F.lit(0).alias("_k"))))
    wc = (Window.partitionBy("_key").orderBy("_c", "_k").rowsBetween(Window.unboundedPreceding, Window.currentRow))
    before = cu.withColumn("_b", F.sum("_n").over(wc)).where(F.col("_k") == 0).select("_key", "_c", "_b")
    lt = (within.join(before, ["_key", "_c"]).select("_id", "_side", (F.col("_in") + F.col("_b")).alias("_lt"))
          .groupBy("_id").pivot("_side", ["hi", "lo"]).agg(F.first("_lt")))
    res = lt.select(F.col("_id").alias(id_col), (F.col("hi") - F.col("lo")).alias("neighbors_within"))
    return df.join(res, id_col, "left").withColumn("neighbors_within", F.coalesce("neighbors_within", F.lit(0)))
