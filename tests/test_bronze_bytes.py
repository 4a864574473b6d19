"""The bronze run's bytes: a source that is down shuffles nothing, the lake's tables are written by small tasks."""

import glob

import pytest
from pyspark.sql import functions as F

from strata.plans import jobs as JB
from strata.plans import registry as R
from strata.session import scratch_path, small_tasks

from conftest import SF_SMALL

ADVISORY = "spark.sql.adaptive.advisoryPartitionSizeInBytes"


def test_a_source_that_is_down_fails_before_its_joins(spark, monkeypatch):
    specs = {}
    run = JB.run_layer
    monkeypatch.setattr(JB, "run_layer", lambda lake, layer, **a: specs.update({a["spec"].name: a["spec"]}) or (
        run(lake, layer, **a) if a["spec"].name == "lake_invoices" else spark.createDataFrame([], rows.schema)))
    rows = spark.createDataFrame([("", "", 0, 0, 0, 0.0, "")], "source_name string, source_type string, "
                                 "records_read bigint, records_accepted bigint, records_rejected bigint, "
                                 "rejection_rate_pct double, status string")
    out = R.QUERIES["bronze_metrics"](spark, SF_SMALL).collect()
    assert [tuple(r) for r in out] == [("lake_invoices", "lake", 0, 0, 0, 0.0, "failed")]
    plan = specs["lake_invoices"].read(spark)._jdf.queryExecution().optimizedPlan().toString()
    assert "raise_error" in plan and "Join" not in plan[plan.index("raise_error"):].split("Relation")[0]
    assert sorted(specs) == ["api_events", "crm_contacts", "erp_transactions", "lake_invoices"]


def test_tables_of_the_lake_are_written_by_small_tasks(spark):
    rows = spark.range(0, 900_000, 1, 4).select(F.sha2(F.col("id").cast("string"), 256).alias("h"))
    name = "spark.sql.adaptive.coalescePartitions.parallelismFirst"
    before = spark.conf.get(name)
    spark.conf.set(name, "false")
    try:  # about 60 MB are shuffled, which the session's 64 MB would give to one task
        lake = JB.Lake(spark, scratch_path(spark, "lake"))
        back = lake.write("bronze", "hashes", rows.repartition("h"))
    finally:
        spark.conf.set(name, before)
    files = glob.glob(f"{lake.root}/bronze/hashes/*.zstd.parquet")
    assert len(files) >= 3 and back.count() == 900_000 and back.distinct().count() == 900_000


def test_the_session_gets_its_size_back(spark):
    before = spark.conf.get(ADVISORY)
    with pytest.raises(ValueError), small_tasks(spark):
        assert spark.conf.get(ADVISORY) == str(16 << 20)
        raise ValueError
    assert spark.conf.get(ADVISORY) == before
    spark.conf.set(ADVISORY, "1m")
    try:
        with small_tasks(spark):
            assert spark.conf.get(ADVISORY) == str(1 << 20)
    finally:
        spark.conf.set(ADVISORY, before)
