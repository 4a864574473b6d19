"""Stateful streams: any order of arrival inside the watermark, state that ends, chained operators."""

import datetime as dt
import json
import os
import random

import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from strata.operators import rules as V
from strata.plans import registry
from strata.streaming import streams as ST

EVENTS = T.StructType([T.StructField("event_id", T.LongType()), T.StructField("user_id", T.LongType()),
                       T.StructField("ts", T.TimestampNTZType()), T.StructField("value", T.DoubleType())])
START = dt.datetime(2024, 3, 1)


def land(spark, path, batches, schema=EVENTS):
    """One file for each batch; the source reads them in this order."""
    os.makedirs(path)
    for i, rows in enumerate(batches):
        stage = f"{path}-stage{i}"
        spark.createDataFrame(rows, schema).coalesce(1).write.parquet(stage)
        name = next(f for f in os.listdir(stage) if f.endswith(".parquet"))
        os.rename(f"{stage}/{name}", f"{path}/{i:03d}.parquet")
        os.utime(f"{path}/{i:03d}.parquet", (1_700_000_000 + i, 1_700_000_000 + i))


def greedy(rows, hours):
    kept, last = set(), {}
    for e, u, t, _ in sorted((r for r in rows if r[2] is not None), key=lambda r: (r[2], r[0])):
        if u not in last or t > last[u] + dt.timedelta(hours=hours):
            last[u] = t
            kept.add(e)
    return kept


@pytest.mark.parametrize("seed", [1, 2])
def test_dedup_does_not_depend_on_the_order_of_files(spark, tmp_path, seed):
    rnd = random.Random(seed)
    rows = [(i, rnd.choice([1, 2, 3, None]), START + dt.timedelta(minutes=rnd.randrange(10 * 1440), microseconds=rnd.randrange(3)),
             rnd.choice([None, 1.5])) for i in range(400)]
    rows += [(1000 + i, r[1], r[2], 2.0) for i, r in enumerate(rows[:20])]  # equal times
    rnd.shuffle(rows)
    clock = [(None, None, START + dt.timedelta(days=60), None)]
    land(spark, str(tmp_path / "in"), [rows[i::5] for i in range(5)] + [clock])
    out, ckpt = str(tmp_path / "out"), str(tmp_path / "ckpt")
    q = ST.dedup_within(spark, str(tmp_path / "in"), EVENTS, ["user_id"], "ts", "event_id", 24, out, "30 days", 1, ckpt)
    got = spark.read.schema(EVENTS).parquet(out).collect()
    assert {r["event_id"] for r in got} == greedy(rows, 24) and len(got) == len({r["event_id"] for r in got})
    by_id = {r[0]: r for r in rows}
    assert all(tuple(r) == by_id[r["event_id"]] for r in got)
    rows_left = [o["numRowsTotal"] for p in q.recentProgress for o in json.loads(p.json)["stateOperators"]]
    assert max(rows_left) > 0
    # the last run's state holds no list, no anchor and no timer
    state = spark.read.format("statestore").option("stateVarName", "waiting").load(ckpt)
    assert state.count() == 0
    assert spark.read.format("statestore").option("stateVarName", "anchor").load(ckpt).count() == 0


def test_state_is_called_by_bucket_and_not_by_key(spark, tmp_path):
    """3,000 keys (one null) in 4 buckets: at most 4 entries of each kind of state, the greedy result."""
    rows = [(i, i % 3000 or None, START + dt.timedelta(hours=7 * (i // 3000), seconds=i % 11), None) for i in range(12_000)]
    rows += [(20_000 + i, *r[1:]) for i, r in enumerate(rows[:50])]
    land(spark, str(tmp_path / "in"), [rows[i::3] for i in range(3)] + [[(None, None, START + dt.timedelta(days=60), None)]])
    out, ckpt = str(tmp_path / "out"), str(tmp_path / "ckpt")
    q = ST.dedup_within(spark, str(tmp_path / "in"), EVENTS, ["user_id"], "ts", "event_id", 10, out, "30 days", 1, ckpt, buckets=4)
    got = [r["event_id"] for r in spark.read.schema(EVENTS).parquet(out).collect()]
    assert len(got) == len(set(got)) and set(got) == greedy(rows, 10)
    assert max(o["numRowsTotal"] for p in q.recentProgress for o in json.loads(p.json)["stateOperators"]) < 100


def test_a_micro_batch_takes_all_files_of_its_days(spark, tmp_path):
    for name in ("00000-a.parquet", "00000-b.parquet", "00000-c.parquet", "00001-a.parquet", "00002-clock.parquet"):
        (tmp_path / name).touch()
    assert registry._files_per_batch(spark, str(tmp_path)) == 3


def test_rows_behind_the_watermark_are_late(spark, tmp_path):
    at = lambda h: START + dt.timedelta(hours=h)
    # the second batch runs under the first one's watermark, the third drops what that had passed
    batches = [[(1, 7, at(100), 0.0)], [(2, 7, at(70), 0.0)], [(3, 7, at(60), 0.0)], [(4, 7, at(130), 0.0)],
               [(None, None, at(1000), None)]]
    land(spark, str(tmp_path / "in"), batches)
    out = str(tmp_path / "out")
    ST.dedup_within(spark, str(tmp_path / "in"), EVENTS, ["user_id"], "ts", "event_id", 24, out, "1 hour")
    assert sorted(r["event_id"] for r in spark.read.schema(EVENTS).parquet(out).collect()) == [1, 2, 4]


def test_sessions_are_written_once(spark, tmp_path):
    rnd = random.Random(5)
    rows = [(i, rnd.randrange(3), START + dt.timedelta(minutes=rnd.randrange(3 * 1440)), 1.0) for i in range(300)]
    clock = [(None, None, START + dt.timedelta(days=60), None)]
    land(spark, str(tmp_path / "in"), [rows[i::4] for i in range(4)] + [clock])
    got = ST.session_counts(spark, str(tmp_path / "in"), EVENTS, "ts", "30 minutes", ["user_id"], str(tmp_path / "out"),
                            delay="10 days", max_files=1)
    want, gap = [], dt.timedelta(minutes=30)
    for u in range(3):
        own = sorted(r[2] for r in rows if r[1] == u)
        start = last = own[0]
        n = 0
        for t in [*own, None]:
            if t is None or t > last + gap:
                want.append((u, start, last + gap, n))
                start, n = t, 0
            last, n = t, n + 1
    assert sorted(map(tuple, got.collect())) == sorted(want)


def test_reject_alarm(spark, tmp_path):
    """More than 100 rejects in each of two periods that follow one another."""
    at = lambda m, s=0: START + dt.timedelta(minutes=m, seconds=s)
    counts = {0: 101, 5: 150, 10: 100, 15: 300, 25: 300, 60: 101, 65: 101, 70: 102, 200: 500}
    rows = [(i, 1, at(m, rnd), -1.0) for m, n in counts.items() for i in range(n) for rnd in [(i * 7) % 300]]
    rows += [(i, 2, at(m, i % 300), 5.0) for m in (20, 200, 205) for i in range(400)]  # accepted
    random.Random(1).shuffle(rows)
    land(spark, str(tmp_path / "in"), [rows[::2], rows[1::2], [(None, None, START + dt.timedelta(days=60), None)]])
    acc, rej = str(tmp_path / "acc"), str(tmp_path / "rej")

    def rules(df):
        return V.with_errors(df, [(F.col("value") < 0, F.lit("negative")), (F.col("event_id").isNull(), F.lit("no id"))])
    ST.ingest_split(spark, str(tmp_path / "in"), EVENTS, rules, acc, rej)
    got = ST.reject_alarm(spark, rej, "ts", str(tmp_path / "alarms"))
    assert sorted(map(tuple, got.collect())) == [(at(5), 150, 101), (at(65), 101, 101), (at(70), 102, 101)]
    low = ST.reject_alarm(spark, rej, "ts", str(tmp_path / "alarms2"), threshold=99)
    assert len(low.collect()) == 5
