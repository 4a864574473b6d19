"""Operator semantics on small literal fixtures (FIXTURES.md F4-F6 and the
semantic decisions), plus brute-force checks of the greedy dedups."""

import datetime as dt

import pandas as pd
from pyspark.sql import functions as F

from strata.functions.columns import snake_case
from strata.operators import dedup as D
from strata.operators import quality as Q
from strata.operators import rules as V
from strata.operators import schema as S
from strata.operators import silver as SV
from strata.sources import files as FS
from strata.sources import snapshots as SN
from strata.session import scratch_path


def test_snake_case():
    assert snake_case("ProductSKU") == "product_sku"
    assert snake_case("Order Date") == "order_date"
    assert snake_case("customer-ID") == "customer_id"
    assert snake_case("_run_id") == "_run_id"          # metadata marker kept


def test_null_tokens_and_email(spark):
    df = spark.createDataFrame([("Carlos", "Carlos@Test.COM"), ("N/A", None), ("", None), ("NULL", None),
                                (" N/A ", None), ("Maria", None)], "name string, email string")
    out = SV.clean_strings(df).collect()
    assert [r.name for r in out] == ["Carlos", None, None, None, None, "Maria"]
    assert out[0].email == "carlos@test.com"


def test_keep_first_last(spark):
    df = spark.createDataFrame([("A", 1), ("A", 2), ("B", 3)], "id string, value int")
    first = {r.id: r.value for r in D.dedup_exact(df, ["id"], ["value"], "first").collect()}
    last = {r.id: r.value for r in D.dedup_exact(df, ["id"], ["value"], "last").collect()}
    assert first == {"A": 1, "B": 3} and last == {"A": 2, "B": 3}


def _dirty(spark):
    rows = [("TXN-001", "C1", 5, 100.0, "USD"), ("TXN-001", "C1", 5, 100.0, "USD"),
            ("TXN-002", None, -2, -500.0, "INVALID"), ("TXN-003", "", 5, 50.0, "USD"),
            ("TXN-004", "C4", 1, 10.0, "MXN")]
    return spark.createDataFrame(rows, "transaction_id string, customer_id string, quantity int, "
                                       "total_amount double, currency string")


def test_quality_scores_f5(spark):
    chk = (Q.QualityChecker().add_completeness_rule("customer_id")
           .add_uniqueness_rule(["transaction_id"]).add_accuracy_rule("quantity", min_value=0))
    rep = {r.rule_name: r for r in chk.check(_dirty(spark), "erp", as_of=dt.datetime(2024, 1, 1)).collect()}
    assert rep["completeness_customer_id"].score == 0.6
    assert rep["uniqueness_transaction_id"].score == 0.8
    assert rep["accuracy_quantity"].score == 0.8
    d = D.dedup_exact(_dirty(spark), None, ["transaction_id"], "first")
    assert d.count() == 4


def test_quality_empty_input(spark):
    chk = Q.QualityChecker().add_completeness_rule("customer_id")
    rep = chk.check(_dirty(spark).limit(0), "erp", as_of=dt.datetime(2024, 1, 1))
    r = rep.first()
    assert r.score == 1.0 and r.passed
    s = Q.summary(rep).first()
    assert s.all_passed


def test_duplicate_contact_rejected(spark):
    df = spark.createDataFrame([("CRM-001", "a@b.com", "Acme", 10.0, 0), ("CRM-001", "a@b.com", "Acme", 10.0, 1)],
                               "contact_id string, email string, company string, deal_value_usd double, _seq int")
    v = V.validate_contacts(df, ["_seq"]).orderBy("_seq").collect()
    assert v[0]._is_valid and not v[1]._is_valid
    assert v[1]._error == "Duplicate contact_id: CRM-001"


def test_negative_quantity_and_missing_customer(spark):
    raw = spark.createDataFrame([("T1", "2024-01-01", "", "SKU-1", "-2", "10.0", "USD", "Completed")],
                                "transaction_id string, order_date string, customer_id string, product_sku string, "
                                "quantity string, total_amount string, currency string, status string")
    r = V.validate_transactions(raw, ["transaction_id"]).first()
    assert r._error == "Non-positive quantity: -2; Missing customer_id"


def test_custom_fields_flatten(spark):
    df = spark.createDataFrame([("CRM-1", (1000000, "gold"), ["vip", "b2b"]), ("CRM-2", (5, None), [])],
                               "contact_id string, custom_fields struct<annual_revenue:bigint, tier:string>, "
                               "tags array<string>")
    out = SV.flatten_contact(df).orderBy("contact_id").collect()
    assert out[0].cf_annual_revenue == 1000000 and out[0].cf_tier == "gold" and out[0].tags == "b2b,vip"
    assert out[1].tags == ""


def test_nested_flatten(spark):
    df = spark.createDataFrame([("E1", ("AG-1", ("MX", "CDMX")))],
                               "event_id string, metadata struct<agent_id:string, geo:struct<country:string, city:string>>")
    assert SV.flatten_struct(df).columns == ["event_id", "metadata_agent_id", "metadata_geo_country",
                                             "metadata_geo_city"]


def test_delimiter_types_and_ragged_rows(spark):
    path = scratch_path(spark, "csv-fixture")
    import os
    os.makedirs(path)
    with open(os.path.join(path, "a.csv"), "w") as f:
        f.write("name;age;active;score\nAna;31;true;4.5\nBo;40;no;3\nCy;22;yes;1.25\n")
    assert FS.detect_delimiter(spark, path).first().delimiter == ";"
    raw = FS.read_csv_raw(spark, path, ["name", "age", "active", "score"], sep=";").drop("_corrupt_record")
    types = {r.column: r.inferred_type for r in FS.infer_types(raw).collect()}
    assert types == {"name": "string", "age": "bigint", "active": "boolean", "score": "double"}
    rag = scratch_path(spark, "csv-ragged")
    os.makedirs(rag)
    with open(os.path.join(rag, "b.csv"), "w") as f:
        f.write("a,b\n1,2\n3,4,5\n")
    rows = FS.read_csv_raw(spark, rag, ["a", "b"]).collect()
    assert sum(r._corrupt_record is not None for r in rows) == 1


def test_window_dedup_anchor(spark):
    base = dt.datetime(2024, 1, 1)
    rows = [(i, "k", base + dt.timedelta(hours=h)) for i, h in enumerate([0, 20, 30, 50])]
    df = spark.createDataFrame(rows, "id int, key string, ts timestamp")
    kept = sorted(r.id for r in D.dedup_window(df, ["key"], "ts", "id", 24).collect())
    assert kept == [0, 2]                                 # anchored at kept rows: 0h and 30h


def _greedy_window(pdf, hours):
    kept = []
    for _, g in pdf.sort_values(["ts", "event_id"]).groupby(["user_id", "event_type"]):
        last = None
        for _, r in g.iterrows():
            if last is None or r.ts > last + pd.Timedelta(hours=hours):
                kept.append(r.event_id)
                last = r.ts
    return sorted(kept)


def test_window_dedup_brute_force(spark):
    ev = spark.read.parquet("/root/testdata/sf0.001/events.parquet")
    got = sorted(r.event_id for r in D.dedup_window(ev, ["user_id", "event_type"], "ts", "event_id", 6).collect())
    assert got == _greedy_window(ev.toPandas(), 6)


def _sim(a, b):
    a, b = a.lower().strip(), b.lower().strip()
    if not a and not b:
        return 1.0
    if not a or not b:
        return 0.0
    ga = {a[i:i + 2] for i in range(len(a) - 1)}
    gb = {b[i:i + 2] for i in range(len(b) - 1)}
    if not ga and not gb:
        return 1.0 if a == b else 0.0
    return len(ga & gb) / max(len(ga | gb), 1)


def _greedy_fuzzy(rows, t):
    blocks = {}
    for doc_id, text in sorted(rows):
        blocks.setdefault(text.lower().strip()[:5], []).append((doc_id, text))
    kept = []
    for items in blocks.values():
        removed = set()
        for i, (ia, ta) in enumerate(items):
            if ia in removed:
                continue
            kept.append(ia)
            for ib, tb in items[i + 1:]:
                if ib not in removed and _sim(ta, tb) >= t:
                    removed.add(ib)
    return sorted(kept)


def test_fuzzy_dedup_brute_force(spark):
    docs = spark.read.parquet("/root/testdata/sf0.001/documents.parquet").select("doc_id", "text")
    got = sorted(r.doc_id for r in D.dedup_fuzzy(docs, ["text"], "doc_id", 0.85).collect())
    assert got == _greedy_fuzzy([(r.doc_id, r.text) for r in docs.collect()], 0.85)


def test_similarity_edges(spark):
    from strata.functions.columns import bigram_jaccard
    df = spark.createDataFrame([("", ""), ("a", ""), ("a", "a"), ("a", "b"), ("abc", "abd")], "a string, b string")
    got = [r.s for r in df.select(bigram_jaccard(F.col("a"), F.col("b")).alias("s")).collect()]
    assert got == [1.0, 0.0, 1.0, 0.0, 1 / 3]


def test_schema_strict_and_drop(spark):
    raw = spark.createDataFrame([("T1", "2024-01-01", "C", "S", "5", "1.0", "x"), (None, "bad", "C", "S", "x", "2", "y")],
                                "transaction_id string, order_date string, customer_id string, product_sku string, "
                                "quantity string, total_amount string, extra string")
    assert S.enforce(raw, S.ERP_SCHEMA, "strict").count() == 1
    assert "extra" not in S.enforce(raw, S.ERP_SCHEMA, "drop").columns
    assert S.enforce(raw.drop("quantity"), S.ERP_SCHEMA, "strict").count() == 0


def test_accept_plus_reject_equals_read(spark):
    from strata.plans import bindings as B
    from strata.plans import medallion as M
    v = V.validate_transactions(B.raw_erp(spark, "/root/testdata/sf0.001"), list(M.RAW_COLUMNS))
    a, r = V.split(v)
    assert a.count() + r.count() == v.count()


def test_daily_sum_equals_monthly_sum(spark):
    from strata.operators import rollups as R
    from strata.plans import bindings as B
    t = B.txn(spark, "/root/testdata/sf0.001")
    d = R.aggregate_daily(t).agg(F.sum("total_revenue")).first()[0]
    m = R.aggregate_monthly(t).agg(F.sum("total_revenue")).first()[0]
    assert abs(d - m) < 0.05


def test_dedup_idempotent(spark):
    li = spark.read.parquet("/root/testdata/sf0.001/lineitem.parquet")
    keys, order = ["l_orderkey", "l_linenumber"], ["l_partkey", "l_suppkey", "l_quantity", "l_extendedprice"]
    once = D.dedup_exact(li, keys, order)
    assert D.dedup_exact(once, keys, order).count() == once.count()


def test_snapshot_json_fallback_and_gzip_csv(spark):
    import gzip
    import os
    base = scratch_path(spark, "lake-json")
    spark.createDataFrame([(1, "a"), (2, "b")], "id int, v string").write.json(base)
    assert SN.read_snapshot(spark, base).count() == 2          # no parquet → JSON lines
    gz = scratch_path(spark, "csv-gz")
    os.makedirs(gz)
    with gzip.open(os.path.join(gz, "x.csv.gz"), "wt") as f:
        f.write("a,b\n1,2\n3,4\n")
    assert FS.read_csv_raw(spark, gz, ["a", "b"]).count() == 2  # .gz read natively


def test_skip_rows_headerless(spark):
    import os
    path = scratch_path(spark, "skip")
    os.makedirs(path)
    with open(os.path.join(path, "f.csv"), "w") as f:
        f.write("# meta\n# meta2\n1,x\n2,y\n")
    lines = FS.skip_rows(spark, path, 2)
    assert sorted(r.value for r in lines.collect()) == ["1,x", "2,y"]


def test_stream_ingest_restarts_from_checkpoint(spark):
    from strata.streaming import streams as ST
    ev = spark.read.parquet("/root/testdata/sf0.001/events.parquet")
    src, acc, rej = (scratch_path(spark, n) for n in ("st-src", "st-acc", "st-rej"))
    ckpt = scratch_path(spark, "st-ckpt")
    first, second = ev.where(F.col("event_id") % 2 == 0), ev.where(F.col("event_id") % 2 == 1)

    def validate(df):
        return V.validate_events(df.withColumnRenamed("ts", "timestamp")).withColumnRenamed("timestamp", "ts")
    first.write.parquet(src, mode="append")
    ST.ingest_split(spark, src, ev.schema, validate, acc, rej, checkpoint=ckpt)
    n1 = spark.read.parquet(acc).count()
    second.write.parquet(src, mode="append")          # new files land; the query restarts
    ST.ingest_split(spark, src, ev.schema, validate, acc, rej, checkpoint=ckpt)
    got = spark.read.parquet(acc)
    expected = ev.where((F.col("event_id") != 0) & F.col("ts").isNotNull()).count()
    assert n1 < got.count() == expected                # nothing reprocessed, nothing lost
    assert got.select("event_id").distinct().count() == expected


def test_broken_rule_is_isolated(spark):
    chk = (Q.QualityChecker().add_accuracy_rule("transaction_id", pattern="([unclosed")
           .add_completeness_rule("customer_id"))
    rep = {r.rule_name: r for r in chk.check(_dirty(spark), "erp", as_of=dt.datetime(2024, 1, 1)).collect()}
    assert rep["accuracy_transaction_id"].score == 0.0 and not rep["accuracy_transaction_id"].passed
    assert rep["completeness_customer_id"].score == 0.6


def test_deduplicate_dispatch_fallbacks(spark):
    df = spark.createDataFrame([(1, "A", 5), (2, "A", 5), (3, "B", 1)], "id int, k string, v int")
    out, m = D.deduplicate(df, "window", ["k"], order=["id"], id_col="id")   # no timestamp column
    r = m.first()
    assert r.strategy == "exact" and out.count() == 2 and r.duplicates_found == 2 and r.duplicates_removed == 1
    out, m = D.deduplicate(df, "fuzzy", [], order=["id"], id_col="id")      # no key columns
    assert m.first().strategy == "exact" and out.count() == 3
