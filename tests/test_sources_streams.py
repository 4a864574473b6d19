"""Files beyond their first split or lines, listed snapshots, replayed stream batches."""

import os

import pytest
from pyspark.sql import functions as F

from strata.operators import quality as Q
from strata.sources import files as FS
from strata.sources import snapshots as SN
from strata.streaming import streams as ST


def test_encoding_and_delimiter_read_whole_files(spark, tmp_path):
    late = "a;b;c\n" * 50_000
    (tmp_path / "late.csv").write_bytes(late.encode() + "ñandú;x;y\n".encode("latin-1"))
    (tmp_path / "utf.csv").write_bytes(late.encode() + "ñandú;x;y\n".encode())
    (tmp_path / "none.csv").write_bytes(b"word\n" * 10)
    (tmp_path / "turn.csv").write_bytes(b"a,b\n" * 300 + b"a|b|c\n" * 5_000)
    keep = spark.conf.get("spark.sql.files.maxPartitionBytes")
    spark.conf.set("spark.sql.files.maxPartitionBytes", "20k")
    try:
        enc = {os.path.basename(r["file"]): r["encoding"] for r in FS.detect_encoding(spark, str(tmp_path)).collect()}
        sep = {os.path.basename(r["file"]): r["delimiter"] for r in FS.detect_delimiter(spark, str(tmp_path)).collect()}
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", keep)
    assert enc["late.csv"] == "latin-1" and enc["utf.csv"] == "utf-8"
    assert sep == {"late.csv": ";", "utf.csv": ";", "none.csv": ",", "turn.csv": "|"}


def test_lines_are_numbered_across_splits(spark, tmp_path):
    for name in ("one", "two"):
        (tmp_path / f"{name}.txt").write_text("".join(f"{name} {i}\n" for i in range(5_000)))
    keep = spark.conf.get("spark.sql.files.maxPartitionBytes")
    spark.conf.set("spark.sql.files.maxPartitionBytes", "4k")
    try:
        lines = FS.numbered_lines(spark, str(tmp_path)).collect()
        rest = FS.skip_rows(spark, str(tmp_path), 3_000).count()
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", keep)
    assert all(r["value"].split()[1] == str(r["line_no"]) for r in lines) and rest == 4_000


def test_snapshots_are_listed_not_scanned(spark, tmp_path):
    base = str(tmp_path / "set")
    for d in ("2024-01-02", "2024-01-10"):
        spark.range(3).coalesce(1).write.parquet(f"{base}/snapshot={d}")
    assert SN.snapshot_names(spark, base) == ("snapshot", ["2024-01-02", "2024-01-10"])
    assert [r[0] for r in SN.list_snapshots(spark, base).collect()] == ["2024-01-02", "2024-01-10"]
    assert {str(r["_snapshot"]) for r in SN.read_snapshot(spark, base).collect()} == {"2024-01-10"}
    with open(f"{base}/snapshot=2024-01-10/part-bad.parquet", "wb") as f:
        f.write(b"not a table")
    assert SN.read_snapshot(spark, base, skip_corrupt=True).count() == 3
    rows, others = SN.read_quarantined(spark, f"{base}/snapshot=2024-01-10", spark.range(1).schema)
    assert rows.count() == 3 and [(r["file"], r["status"]) for r in others.collect()] == [("part-bad.parquet", "unreadable")]


def test_nested_mixed_and_empty_snapshots(spark, tmp_path):
    base, store = str(tmp_path / "set"), str(tmp_path / "index")
    for region, n in (("eu", 4), ("us", 6)):
        spark.range(n).write.parquet(f"{base}/snapshot=2024-01-01/region={region}")
    spark.range(2).write.json(f"{base}/snapshot=2024-01-02/region=eu/part=a")
    os.makedirs(f"{base}/snapshot=2024-01-03/region=eu")
    df = SN.read_snapshot(spark, base, "2024-01-01")
    assert sorted((r["id"], r["region"]) for r in df.collect()) == sorted([(i, "eu") for i in range(4)] + [(i, "us") for i in range(6)])
    assert "2024-01-02" not in "".join(df.inputFiles()) and len(df.inputFiles()) > 0
    latest = SN.read_snapshot(spark, base).collect()
    assert {(r["id"], r["region"], r["part"], str(r["_snapshot"])) for r in latest} == {(0, "eu", "a", "2024-01-02"), (1, "eu", "a", "2024-01-02")}
    index = SN.snapshot_index(spark, base, store)
    count = lambda: {(r["snapshot"], r["format"]): r["n"] for r in
                     SN.snapshot_index(spark, base, store).groupBy("snapshot", "format").agg(F.sum("rows").alias("n")).collect()}
    assert count() == {("2024-01-01", "parquet"): 10, ("2024-01-02", "json"): 2}
    assert {tuple(sorted(r["partitions"].items())) for r in index.collect()} >= {(("region", "eu"), ("snapshot", "2024-01-01"))}
    spark.range(5).write.parquet(f"{base}/snapshot=2024-01-04")
    assert count()[("2024-01-04", "parquet")] == 5 and len(count()) == 3
    with pytest.raises(FileNotFoundError):
        SN.read_snapshot(spark, base, "2024-01-03")


def test_each_file_has_its_own_delimiter(spark, tmp_path):
    (tmp_path / "a.csv").write_text("x;y\n1;2,5\n3;4,5\n")
    (tmp_path / "b.csv").write_text("x,y\n5,6\n")
    got = {(r["x"], r["y"], r["_source_file"]) for r in FS.read_csv_folder(spark, str(tmp_path), ["x", "y"]).collect()}
    assert got == {("1", "2,5", "a.csv"), ("3", "4,5", "a.csv"), ("5", "6", "b.csv")}


def test_replayed_batch_changes_nothing(spark, tmp_path):
    out = str(tmp_path / "out")
    first, second = spark.range(5), spark.range(5, 8)
    for epoch, batch in ((0, first), (1, second), (1, second), (0, first)):
        ST.write_batch(batch, out, epoch)
    assert sorted(r["id"] for r in spark.read.parquet(out).collect()) == list(range(8))
    updates = spark.createDataFrame([("w", 1, 0), ("w", 4, 2), ("x", 2, 1)], "k string, n int, batch_id long")
    assert {tuple(r) for r in ST.current(updates, ["k"]).collect()} == {("w", 4), ("x", 2)}


def test_stream_quality_does_not_depend_on_batches(spark):
    df = spark.createDataFrame([(i % 4, None if i == 3 else "a") for i in range(12)], "k int, v string")
    chk = Q.QualityChecker().add_uniqueness_rule(["k"]).add_completeness_rule("v", 0.5)
    import datetime as dt
    now = dt.datetime(2024, 1, 1)
    whole = chk.check(df, "d", "stream", as_of=now)
    parts = chk.partial_counts(df.where("k < 2"), now).unionByName(chk.partial_counts(df.where("k >= 2"), now))
    again = chk.report_of(parts, df.columns, "d", "stream")
    key = lambda r: r["rule_name"]
    assert sorted(map(tuple, whole.collect()), key=str) == sorted(map(tuple, again.collect()), key=str)
    assert whole.where(F.col("rule_name") == "uniqueness_k").first()["failed_records"] == 8 and key
