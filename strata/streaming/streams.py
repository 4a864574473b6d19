"""Structured Streaming versions of ingest, dedup, rollups, alarms and layer hops.

All queries use a file source with an explicit schema, ``trigger(availableNow)``
(process what has arrived, then stop — restartable from the checkpoint),
checkpoints under the shared ``spark.checkpoint.dir`` and distributed sinks.  A
``foreachBatch`` sink writes the partition ``batch_id=<id>`` and replaces it when a
batch is run again, so a replay leaves the tables as they were.  Windowed results
run in update mode: a batch writes the windows it changed, state older than the
watermark goes, and a reader takes each window's latest version (``current``).

* ingest_split        validation inside foreachBatch → accepted / rejected sinks
* dedup_within        exact anchored N-hour dedup per key, whatever the order of arrival
                      inside the watermark (keyed lists and event-time timers)
* windowed_counts     tumbling / sliding windows with a watermark
* session_counts      session windows per key, each written once
* reject_alarm        reject counts per period and, chained to it, the periods that
                      follow one another
* quality_stream      rule counts per micro-batch, one report over the whole stream
* layer hops          raw → silver → gold as chained availableNow queries
"""

from __future__ import annotations

import datetime as _dt
from collections.abc import Callable

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from strata.operators import silver as SV
from strata.session import scratch_path


def file_stream(spark: SparkSession, path: str, schema: T.StructType, fmt: str = "parquet",
                max_files: int | None = None) -> DataFrame:
    r = spark.readStream.schema(schema).format(fmt)
    if max_files:
        r = r.option("maxFilesPerTrigger", max_files)
    return r.load(path)


def run_available_now(stream: DataFrame, sink: Callable | str, checkpoint: str,
                      mode: str = "append", fmt: str = "parquet"):
    """Run a query until everything available is processed, then stop; the ended query."""
    w = stream.writeStream.outputMode(mode).option("checkpointLocation", checkpoint).trigger(availableNow=True)
    if callable(sink):
        q = w.foreachBatch(sink).start()
    else:
        q = w.format(fmt).option("path", sink).start()
    q.awaitTermination()
    if q.exception():
        raise q.exception()
    return q


def by_batch(path: str) -> Callable[[DataFrame, int], None]:
    """A sink that writes the partition of the batch, replacing it on a replay."""
    def sink(batch: DataFrame, epoch: int) -> None:
        write_batch(batch, path, epoch)
    return sink


def write_batch(batch: DataFrame, path: str, epoch: int) -> None:
    (batch.withColumn("batch_id", F.lit(epoch).cast("bigint")).write.mode("overwrite")
     .option("partitionOverwriteMode", "dynamic").partitionBy("batch_id").parquet(path))


def current(updates: DataFrame, keys: list[str]) -> DataFrame:
    """Latest version of each key from a table of updates (``batch_id`` tells them apart)."""
    values = [c for c in updates.columns if c not in (*keys, "batch_id")]
    return (updates.groupBy(*keys).agg(F.max_by(F.struct(*values), "batch_id").alias("_v"))
            .select(*keys, "_v.*"))


# --------------------------------------------------------------------------
def ingest_split(spark: SparkSession, src: str, schema: T.StructType,
                 validate: Callable[[DataFrame], DataFrame], accepted: str, rejected: str,
                 checkpoint: str | None = None) -> None:
    """Validate every micro-batch once; write both sides by batch.  Re-running with
    the same ``checkpoint`` processes only files that arrived since."""
    def sink(batch: DataFrame, epoch: int) -> None:
        v = validate(batch).persist()
        write_batch(v.where("_is_valid").drop("_errors", "_error", "_is_valid"), accepted, epoch)
        write_batch(v.where(~F.col("_is_valid")).select(F.to_json(F.struct(*batch.columns)).alias("record"),
                                                        F.col("_error").alias("error")), rejected, epoch)
        v.unpersist()
    run_available_now(file_stream(spark, src, schema), sink, checkpoint or scratch_path(spark, "ckpt-ingest"))


#: state store of the operators that keep lists and timers per key
ROCKSDB = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"
PROVIDER = "spark.sql.streaming.stateStore.providerClass"


def dedup_within(spark: SparkSession, src: str, schema: T.StructType, keys: list[str], ts_col: str,
                 id_col: str, hours: float, out: str, delay: str, max_files: int | None = 1,
                 checkpoint: str | None = None, buckets: int = 1024) -> None:
    """Exact anchored window dedup over a stream whose rows may come up to ``delay`` late.

    A key's rows wait in the state until the watermark passes them; nothing earlier can
    come then, so they are decided in (time, id) order: a row is kept iff it is later
    than the last kept one + N.  Rows inside the window of a decided row are dropped as
    they come.  The state is kept by ``buckets`` of keys, so a batch costs calls per bucket
    and not per key or row: what a batch brings waits as one Arrow block, the anchors of a
    bucket are another.  A timer wakes a bucket when its earliest waiting row is due or its
    earliest anchor reaches nothing any more; its state goes with the last of them.  The
    result does not depend on the order of files or rows.  Rows without an id only move the
    clock.  A restart from a checkpoint needs the same ``buckets``."""
    win = int(hours * 3600 * 1_000_000)
    names = schema.names
    plain = T.StructType([T.StructField(f.name, T.TimestampNTZType() if isinstance(f.dataType, T.TimestampType) else f.dataType)
                          for f in schema])
    block = T.StructType([T.StructField("_key", T.StringType()), T.StructField("_us", T.LongType()), *plain.fields])
    stored = T.StructType([T.StructField("block", T.BinaryType())])

    import pyarrow as pa
    from pyspark.sql.pandas.types import to_arrow_schema
    from pyspark.sql.streaming import StatefulProcessor

    block_schema = to_arrow_schema(block)

    class Anchored(StatefulProcessor):  # made here, so that workers need not import this package
        def init(self, handle):
            self.handle = handle
            self.anchor = handle.getValueState("anchor", stored)    # key, time of its last kept row
            self.waiting = handle.getListState("waiting", stored)   # blocks of undecided rows
            self.due = handle.getValueState("due", T.StructType([T.StructField("us", T.LongType())]))

        def pack(self, table):
            to = pa.BufferOutputStream()
            with pa.ipc.new_stream(to, table.schema) as w:
                w.write_table(table)
            return (to.getvalue().to_pybytes(),)

        def unpack(self, blob):
            return pa.ipc.open_stream(blob).read_all()

        def anchors(self):
            if not self.anchor.exists():
                return {}
            t = self.unpack(self.anchor.get()[0])
            return dict(zip(t["key"].to_pylist(), t["last"].to_pylist()))

        def wake(self, us):
            self.due.update((us,))
            self.handle.registerTimer(-(-us // 1000))

        def handleInputRows(self, key, rows, timerValues):
            last, least = self.anchors(), None
            for pdf in rows:
                pdf = pdf.set_axis(sent, axis=1)  # names with an underscore in front come changed
                pdf = pdf[pdf[id_col].notna() & pdf[ts_col].notna()]
                us = pdf[ts_col].to_numpy(dtype="datetime64[us]").astype(np.int64)
                if last:
                    open_ = us > pdf["_key"].map(last).fillna(us.min() - win - 1 if len(us) else 0).to_numpy(np.int64) + win
                    pdf, us = pdf[open_], us[open_]
                if len(us):
                    rows_ = pdf[["_key", *names]].assign(_us=us)
                    self.waiting.appendValue(self.pack(pa.Table.from_pandas(rows_, schema=block_schema, preserve_index=False)))
                    least = int(us.min()) if least is None else min(least, int(us.min()))
            if least is not None and not (self.due.exists() and self.due.get()[0] <= least):
                self.wake(least)
            return iter(())

        def handleExpiredTimer(self, key, timerValues, expiredTimerInfo):
            now = timerValues.getCurrentWatermarkInMs() * 1000
            if not self.due.exists() or self.due.get()[0] > now:  # an earlier timer did its work
                return
            last = self.anchors()
            blocks = [self.unpack(r[0]) for r in self.waiting.get()]
            kept, rest, table = [], [], None
            if blocks:
                table = pa.concat_tables(blocks)
                table = table.sort_by([("_key", "ascending"), ("_us", "ascending"), (id_col, "ascending")])
                for i, (k, t) in enumerate(zip(table["_key"].to_pylist(), table["_us"].to_pylist())):
                    if k in last and t <= last[k] + win:
                        continue
                    if t <= now:
                        kept.append(i)
                        last[k] = t
                    else:
                        rest.append(i)
                if rest:
                    self.waiting.put([self.pack(table.take(rest))])
                else:
                    self.waiting.clear()
            last = {k: t for k, t in last.items() if t + win > now}
            if last:
                self.anchor.update(self.pack(pa.table({"key": pa.array(last.keys(), pa.string()),
                                                       "last": pa.array(last.values(), pa.int64())})))
            else:
                self.anchor.clear()
            ends = [t + win for t in last.values()] + [table["_us"][i].as_py() for i in rest]
            if ends:
                self.wake(min(ends))
            else:
                self.due.clear()
            if kept:
                yield table.select(names).take(kept).to_pandas()

        def close(self):
            pass

    s = file_stream(spark, src, schema, max_files=max_files)
    s = s.withColumn("_event_time", F.col(ts_col).cast("timestamp")).withWatermark("_event_time", delay)
    s = s.withColumn("_key", F.to_json(F.struct(*[F.col(k).cast("string").alias(k) for k in keys])))
    s = s.withColumn("_bucket", F.pmod(F.xxhash64("_key"), F.lit(buckets)))
    sent = s.columns
    before = spark.conf.get(PROVIDER, None)
    spark.conf.set(PROVIDER, ROCKSDB)
    try:
        kept = s.groupBy("_bucket").transformWithStateInPandas(
            Anchored(), schema, "append", "eventTime")
        return run_available_now(kept, out, checkpoint or scratch_path(spark, "ckpt-dedup"))
    finally:
        spark.conf.unset(PROVIDER) if before is None else spark.conf.set(PROVIDER, before)


def windowed_counts(spark: SparkSession, src: str, schema: T.StructType, ts_col: str, duration: str,
                    slide: str | None, group_cols: list[str], value_col: str | None, out: str,
                    watermark: str = "1 day") -> DataFrame:
    """Counts (and sums) per tumbling or sliding window, the latest version of each."""
    s = file_stream(spark, src, schema).withColumn("_ts", F.col(ts_col).cast("timestamp"))
    w = F.window("_ts", duration, slide) if slide else F.window("_ts", duration)
    aggs = [F.count(F.lit(1)).alias("events")]
    if value_col:
        aggs.append(F.sum(F.round(F.col(value_col) * 100).cast("bigint")).alias("_cents"))
    agg = s.withWatermark("_ts", watermark).groupBy(w.alias("w"), *group_cols).agg(*aggs)
    sel = [F.col("w.start").cast("timestamp_ntz").alias("window_start"),
           F.col("w.end").cast("timestamp_ntz").alias("window_end"), *group_cols, "events"]
    if value_col:
        sel.append((F.col("_cents") / 100.0).alias("value_sum"))
    run_available_now(agg.select(*sel), by_batch(out), scratch_path(spark, "ckpt-window"), "update")
    return current(spark.read.parquet(out), ["window_start", "window_end", *group_cols])


def session_counts(spark: SparkSession, src: str, schema: T.StructType, ts_col: str, gap: str,
                   keys: list[str], out: str, delay: str = "1 day", max_files: int | None = None) -> DataFrame:
    """Sessions of each key, each written once: when the watermark has passed its end."""
    s = file_stream(spark, src, schema, max_files=max_files).withColumn("_ts", F.col(ts_col).cast("timestamp"))
    agg = (s.withWatermark("_ts", delay).groupBy(F.session_window("_ts", gap).alias("s"), *keys)
           .agg(F.count(F.lit(1)).alias("events")))
    sel = agg.select(*keys, F.col("s.start").cast("timestamp_ntz").alias("session_start"),
                     F.col("s.end").cast("timestamp_ntz").alias("session_end"), "events")
    run_available_now(sel, out, scratch_path(spark, "ckpt-session"))
    return spark.read.schema(sel.schema).parquet(out)


def reject_alarm(spark: SparkSession, rejected: str, ts_field: str, out: str, threshold: int = 100,
                 period_seconds: int = 300, delay: str = "1 day") -> DataFrame:
    """Periods with more than ``threshold`` rejects whose previous period had as many too.

    One query with two stateful operators in a row: rejects (the ``rejected`` side of
    ``ingest_split``) are counted per period, periods over the threshold are paired with
    their neighbour by a window of two periods.  A period is judged once, when the
    watermark has passed it; a gap between periods is no alarm."""
    r = file_stream(spark, rejected, T.StructType.fromDDL("record string, error string, batch_id bigint"))
    r = r.withColumn("_ts", F.get_json_object("record", f"$.{ts_field}").try_cast("timestamp"))
    period = f"{period_seconds} seconds"
    over = (r.withWatermark("_ts", delay).groupBy(F.window("_ts", period).alias("w")).agg(F.count(F.lit(1)).alias("n"))
            .where(F.col("n") > threshold).select(F.window_time("w").alias("t"), "n"))
    two = over.groupBy(F.window("t", f"{2 * period_seconds} seconds", period).alias("p")).agg(
        F.count(F.lit(1)).alias("k"), F.max_by("n", "t").alias("events"), F.min_by("n", "t").alias("prev_events"))
    alarm = two.where("k = 2").select((F.col("p.start") + F.expr(f"INTERVAL '{period_seconds}' SECOND")).cast("timestamp_ntz")
                                      .alias("window_start"), "events", "prev_events")
    run_available_now(alarm, out, scratch_path(spark, "ckpt-alarm"))
    return spark.read.schema(alarm.schema).parquet(out)


def quality_stream(spark: SparkSession, src: str, schema: T.StructType, checker, dataset: str, out: str,
                   as_of: _dt.datetime | None = None, max_files: int | None = None) -> DataFrame:
    """The quality report of everything that the stream has brought so far.

    A batch stores its rule counts and, for uniqueness rules, its counts per key; the
    report sums them over all batches, so it does not depend on how rows fell into
    batches.  Row ages are taken at ``as_of`` (default: now, once per run)."""
    as_of = as_of or _dt.datetime.now(_dt.timezone.utc).replace(tzinfo=None)

    def sink(batch: DataFrame, epoch: int) -> None:
        write_batch(checker.partial_counts(batch, as_of), out, epoch)
    run_available_now(file_stream(spark, src, schema, max_files=max_files), sink, scratch_path(spark, "ckpt-dq"))
    return checker.report_of(spark.read.parquet(out).drop("batch_id"), schema.names, dataset, "stream")


def silver_hop(spark: SparkSession, src: str, schema: T.StructType, source_type: str, as_of: _dt.datetime,
               key: str, ts_col: str, out: str, delay: str = "1 day") -> T.StructType:
    """Raw → silver on a stream: the whole silver chain, and of rows that come again within
    ``delay`` the first.  Gives the silver table's schema."""
    s = SV.transform(file_stream(spark, src, schema), source_type, as_of)
    s = s.withColumn("_event_time", F.col(ts_col).cast("timestamp")).withWatermark("_event_time", delay)
    once = s.dropDuplicatesWithinWatermark([key]).drop("_event_time")
    run_available_now(once, out, scratch_path(spark, "ckpt-silver"))
    return once.schema


def layer_hop(spark: SparkSession, src: str, schema: T.StructType, transform: Callable[[DataFrame], DataFrame],
              out: str) -> None:
    """One raw→silver style hop: stateless transform, appended to the next layer."""
    run_available_now(transform(file_stream(spark, src, schema)), out, scratch_path(spark, "ckpt-hop"))
