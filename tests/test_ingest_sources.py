"""Ingestion control (I1-I9) and Bronze readers/writers."""

import datetime as dt
import os

import pytest
from pyspark.sql import functions as F

from conftest import FIXTURE_LANDING
from strata.operators import ingest as I
from strata.sources import files, sinks

D = dt.datetime


@pytest.fixture()
def source(spark):
    return spark.createDataFrame(
        [(1, D(2024, 1, 1)), (2, D(2024, 1, 2)), (3, D(2024, 1, 3)), (4, None)],
        "id int, wm timestamp_ntz",
    )


def test_incremental_slice_bounds(source):
    first = I.incremental_slice(source, "wm", None, D(2024, 1, 2))
    assert sorted(r.id for r in first.collect()) == [1, 2]           # closed above, NULL wm never
    nxt = I.incremental_slice(source, "wm", "2024-01-02 00:00:00", D(2024, 1, 3))
    assert [r.id for r in nxt.collect()] == [3]                      # open below
    repeat = I.incremental_slice(source, "wm", "2024-01-03 00:00:00", D(2024, 1, 3))
    assert repeat.count() == 0                                       # repeat run: nothing new
    empty = I.incremental_slice(source.where("false"), "wm", None, None)
    assert empty.count() == 0


def test_high_watermark_and_route(spark, source):
    assert I.high_watermark(source, "wm").first().high_watermark == D(2024, 1, 3)
    rows, advance = I.route_by_load_type({"load_type": "incremental", "watermark_column": "wm",
                                          "last_watermark_value": "2024-01-01 00:00:00"}, source)
    assert advance and sorted(r.id for r in rows.collect()) == [2, 3]
    rows, advance = I.route_by_load_type({"load_type": "full"}, source)
    assert not advance and rows.count() == 4


def test_advance_watermark_rules(spark):
    control = I.seed_frame(spark)
    highs = spark.createDataFrame([
        ("orders", D(2024, 5, 1), True),
        ("order_items", None, True),               # empty source keeps the old mark
        ("inventory_events", D(2024, 5, 2), False),  # failed copy keeps the old mark
    ], "entity_name string, high_watermark timestamp_ntz, copy_succeeded boolean")
    out = {r.entity_name: r for r in I.advance_watermark(control, highs, "2024-05-03 00:00:00").collect()}
    assert out["orders"].last_watermark_value == D(2024, 5, 1)
    assert out["orders"].last_successful_load == D(2024, 5, 3)
    assert out["order_items"].last_watermark_value is None
    assert out["inventory_events"].last_watermark_value is None
    assert out["customers"].last_successful_load is None


def test_upsert_control_keeps_progress(spark):
    control = I.seed_frame(spark)
    highs = spark.createDataFrame([("orders", D(2024, 5, 1), True)],
                                  "entity_name string, high_watermark timestamp_ntz, copy_succeeded boolean")
    advanced = I.advance_watermark(control, highs, "2024-05-03 00:00:00")
    reseed = I.seed_frame(spark, [
        ("orders", "tpch", "orders", "incremental", "o_orderdate", "lake/orders", "parquet", False),
        ("regions", "tpch", "region", "full", None, "lake/regions", "parquet", True),
    ])
    out = {r.entity_name: r for r in I.upsert_control(advanced, reseed).collect()}
    assert len(out) == 7
    assert out["orders"].target_path == "lake/orders" and out["orders"].is_active is False
    assert out["orders"].last_watermark_value == D(2024, 5, 1)       # progress kept
    assert out["regions"].last_watermark_value is None                # inserted
    assert out["products"].target_path == "retail/products"           # untouched
    active = {r.entity_name for r in I.active_entities(I.upsert_control(advanced, reseed)).collect()}
    assert "orders" not in active and "regions" in active


def test_validate_control(spark):
    src = {"orders": spark.createDataFrame([], "o_orderkey long, o_orderdate timestamp_ntz"),
           "part": spark.createDataFrame([], "p_partkey long, p_name string"),
           "events": spark.createDataFrame([], "event_id long, created_at string")}
    control = I.seed_frame(spark, [
        ("orders", "s", "orders", "incremental", "o_orderdate", "p", "parquet", True),
        ("orders", "s", "orders", "incremental", "o_orderdate", "p", "parquet", True),
        ("products", "s", "part", "full", None, "p", "parquet", True),
        ("events", "s", "events", "full", None, "p", "parquet", True),
        ("bad_type", "s", "part", "delta", None, "p", "parquet", True),
        ("no_wm", "s", "part", "incremental", None, "p", "parquet", True),
        ("missing_wm", "s", "part", "incremental", "changed_at", "p", "parquet", True),
    ])
    v = sorted((r.entity_name, r.violation) for r in I.validate_control(control, I.source_columns(spark, src)).collect())
    assert v == [
        ("bad_type", "unknown load_type delta"),
        ("events", "full load but source has time column(s): created_at"),
        ("missing_wm", "watermark_column not in source: changed_at"),
        ("no_wm", "incremental load without watermark_column"),
        ("orders", "duplicate entity_name"),
    ]
    assert I.validate_control(I.seed_frame(spark, I.DEFAULT_SEED[3:4]), I.source_columns(spark, src)).count() == 0


def test_read_csv_batches_with_audit(spark):
    cols = ["order_item_id", "order_id", "product_id", "quantity", "unit_price"]
    df = files.read_csv_batches(spark, FIXTURE_LANDING, ["batch_1", "batch_2"], "order_items", cols)
    got = {r.batch_id: r.n for r in df.groupBy("batch_id").agg(F.count("*").alias("n")).collect()}
    assert got == {"batch_1": 6, "batch_2": 5}
    assert df.first().source_file.endswith(".csv")
    empty = files.read_csv_batches(spark, FIXTURE_LANDING, ["batch_2"], "products",
                                   ["product_id", "product_name", "category", "unit_price", "updated_at"])
    assert empty.count() == 0                                         # header-only batch
    audited = files.add_bronze_audit(df, "demo", ingestion_ts=F.lit(D(2024, 1, 1)))
    assert {"ingestion_timestamp", "source_system", "batch_id", "source_file"} <= set(audited.columns)


def test_reordered_csv_header_is_set_aside_instead_of_swapping(spark, tmp_path):
    d = tmp_path / "b1"
    d.mkdir()
    (d / "warehouses.csv").write_text("warehouse_name,warehouse_id,city,region\nAmsterdam DC,W01,A,NH\n")
    rows, rejected = files.split_csv_batches(spark, str(tmp_path), ["b1"], "warehouses",
                                             ["warehouse_id", "warehouse_name", "city", "region"])
    assert rows.count() == 0
    assert {(r.batch_id, r.raw_line, r.rejected_reason) for r in rejected.collect()} == {
        ("b1", "warehouse_name,warehouse_id,city,region", "header"), ("b1", "Amsterdam DC,W01,A,NH", "header")}


def test_bad_csv_lines_are_set_aside_and_the_rest_loads(spark, tmp_path):
    text = {
        "b 1": 'id,name,n\n1,a,2\n2,b\n3,c,4,5\n4,"x, y",6\n5,"bad,7\n6,"q"z,8\n\n7,"say ""hi""",9\n8,"esc \\"q\\" e",10\n9,,\n10,a"b,3\n11,"",é\n',
        "b+2": "name,id,n\na,1,2\n", "b3": "id,name,n\r\n12,x,y\r\n", "b4": "", "b5": '\ufeff"id","name","n"\n13,p,q\nid,name,n\n14,r,s\n',
    }
    for batch, content in text.items():
        (tmp_path / batch).mkdir()
        (tmp_path / batch / "e.csv").write_bytes(content.encode())
    rows, rejected = files.split_csv_batches(spark, str(tmp_path), list(text), "e", ["id", "name", "n"])
    got = {(r.batch_id, r.id, r.name, r.n) for r in rows.collect()}
    assert got == {("b 1", "1", "a", "2"), ("b 1", "4", "x, y", "6"), ("b 1", "7", 'say "hi"', "9"), ("b 1", "8", 'esc "q" e', "10"), ("b 1", "9", None, None),
                   ("b 1", "11", None, "é"), ("b3", "12", "x", "y"), ("b5", "13", "p", "q"), ("b5", "14", "r", "s")}
    bad = {(r.batch_id, r.raw_line, r.rejected_reason) for r in rejected.collect()}
    assert bad == {("b 1", "2,b", "column count"), ("b 1", "3,c,4,5", "column count"), ("b 1", '5,"bad,7', "quotes"), ("b 1", '6,"q"z,8', "quotes"),
                   ("b 1", '10,a"b,3', "quotes"), ("b+2", "name,id,n", "header"), ("b+2", "a,1,2", "header")}
    assert all(r.source_file.endswith("/e.csv") for r in rejected.collect())
    with pytest.raises(Exception, match="(?i)not_found|does not exist"):
        files.read_csv_batches(spark, str(tmp_path), ["none"], "e", ["id"]).count()


def test_partitioned_csv_sets_bad_lines_aside(spark, tmp_path):
    rows = [("1", "a", "2024-01-01 10:00:00"), ("2", "b, c", "x+y %z"), ("3", None, None)]
    root = str(tmp_path / "p")
    spark.createDataFrame(rows, "id string, name string, b string").write.partitionBy("b").option("header", True).csv(root)
    (tmp_path / "p" / "b=late").mkdir()
    (tmp_path / "p" / "b=late" / "x.csv").write_text("id,name\n4\n5,e\n")
    good, bad = files.split_csv_partitioned(spark, root, ["id", "name"], "b")
    assert {(r.id, r.name, r.b) for r in good.collect()} == {*rows, ("5", "e", "late")}
    assert [(r.b, r.raw_line, r.rejected_reason) for r in bad.collect()] == [("late", "4", "column count")]


def test_land_and_read_partitions(spark, tmp_path):
    root = str(tmp_path / "orders")
    a = spark.createDataFrame([(1, "x")], "id int, v string")
    b = spark.createDataFrame([(2, "y", "extra")], "id int, v string, w string")
    I.land_partitioned(a, root, "2024-01-01")
    I.land_partitioned(b, root, "2024-01-02")
    I.land_partitioned(b, root, "2024-01-02")                    # re-landing is idempotent
    assert files.list_batches(spark, root) == ["2024-01-01", "2024-01-02"]
    merged = files.read_partitions(spark, root)
    rows = {r.id: r for r in merged.collect()}
    assert len(rows) == 2 and rows[1].w is None and rows[2].w == "extra"
    assert rows[1].batch_id == "load_date=2024-01-01"
    latest = files.read_latest_snapshot(spark, root).collect()
    assert [r.id for r in latest] == [2]
    with pytest.raises(FileNotFoundError):
        files.list_batches(spark, str(tmp_path / "nothing"))


def test_sinks_count_without_reread(spark, tmp_path):
    df = spark.range(10).withColumn("k", F.col("id") % 3)
    assert sinks.write_bronze(df, str(tmp_path / "t")) == 10
    assert sinks.append_run_log(df.limit(2), str(tmp_path / "log")) == 2
    assert sinks.append_run_log(df.limit(3), str(tmp_path / "log")) == 3
    assert spark.read.parquet(str(tmp_path / "log")).count() == 5
    with pytest.raises(ValueError):
        sinks.drop_and_rebuild(df, str(tmp_path / "h"), spark.range(1).schema)
    assert sinks.drop_and_rebuild(df.select("id"), str(tmp_path / "h"), spark.range(1).schema) == 10


def test_write_split_writes_once(spark, tmp_path):
    from strata.operators.clean import Rule

    df = spark.range(10).withColumn("v", F.when(F.col("id") < 7, F.lit(1)))
    split = sinks.write_split(df, [Rule("v_not_null", F.col("v").isNotNull())], "null v", str(tmp_path / "split"))
    assert (split.valid_rows, split.quarantined_rows) == (7, 3)
    valid, bad = split.valid(spark), split.quarantined(spark)
    assert valid.count() == 7 and bad.count() == 3
    assert valid.columns == ["id", "v", "silver_processed_timestamp"]
    assert {r.failed_rules for r in bad.collect()} == {"v_not_null"}
    assert {r.quarantine_reason for r in bad.collect()} == {"null v"}
    assert os.path.isdir(str(tmp_path / "split" / "_is_valid=true"))
    # nothing quarantined: the false partition is absent and the read is still empty, not an error
    clean = sinks.write_split(spark.range(3), [Rule("ok", F.lit(True))], "r", str(tmp_path / "s2"))
    assert clean.quarantined(spark).count() == 0 and clean.valid(spark).count() == 3
    empty = sinks.write_split(spark.range(0), [Rule("ok", F.lit(True))], "r", str(tmp_path / "s3"))
    assert empty.valid(spark).count() == 0 and empty.quarantined(spark).count() == 0


def test_create_namespaces_is_idempotent(spark):
    assert sinks.create_namespaces(spark, "strata_test_") == sinks.create_namespaces(spark, "strata_test_")
    names = {r.namespace for r in spark.sql("SHOW SCHEMAS").collect()}
    assert {"strata_test_bronze", "strata_test_gold"} <= names


def test_replace_table_as_and_read_table(spark):
    df = spark.range(5).withColumn("v", F.col("id") * 2)
    assert sinks.replace_table_as(df, "strata_test_gold_t") == 5
    assert sinks.replace_table_as(df.limit(3), "strata_test_gold_t") == 3   # replaced, not appended
    assert files.read_table(spark, "strata_test_gold_t").count() == 3
    spark.sql("DROP TABLE IF EXISTS strata_test_gold_t")


def test_run_ingestion_first_repeat_new_and_failed(spark, tmp_path):
    landing = str(tmp_path / "landing")
    orders = spark.createDataFrame([(1, D(2024, 1, 1)), (2, D(2024, 1, 2))], "id int, ts timestamp_ntz")
    items = spark.createDataFrame([(1, 1)], "order_id int, line int")
    control = I.seed_frame(spark, [
        ("orders", "s", "orders", "incremental", "ts", "orders", "parquet", True),
        ("items", "s", "items", "full", None, "items", "parquet", True),
    ])
    c1, rep = I.run_ingestion(spark, control, {"orders": orders, "items": items}, landing, "2024-01-03", "2024-01-03 01:00:00")
    marks = {r.entity_name: r.last_watermark_value for r in c1.collect()}
    assert marks == {"orders": D(2024, 1, 2), "items": None} and all(r["succeeded"] for r in rep)
    # repeat run, nothing new: an empty slice is landed and the mark stays
    c2, _ = I.run_ingestion(spark, c1, {"orders": orders, "items": items}, landing, "2024-01-04", "2024-01-04 01:00:00")
    assert {r.entity_name: r.last_watermark_value for r in c2.collect()}["orders"] == D(2024, 1, 2)
    # new rows: only they are copied
    more = orders.unionByName(spark.createDataFrame([(3, D(2024, 1, 5))], "id int, ts timestamp_ntz"))
    c3, _ = I.run_ingestion(spark, c2, {"orders": more, "items": items}, landing, "2024-01-05", "2024-01-05 01:00:00")
    landed = files.read_partitions(spark, f"{landing}/orders")
    got = {r.batch_id: r.n for r in landed.groupBy("batch_id").agg(F.count("*").alias("n")).collect()}
    assert got == {"load_date=2024-01-03/run_id=r20240103010000": 2, "load_date=2024-01-05/run_id=r20240105010000": 1}
    # a failed copy keeps its mark and does not stop the other entity
    broken = spark.createDataFrame([("x", D(2024, 1, 9))], "id string, ts timestamp_ntz").select(
        F.col("id").cast("int").alias("id"), "ts")  # ANSI cast error at run time
    c4, rep4 = I.run_ingestion(spark, c3, {"orders": broken, "items": items}, landing, "2024-01-09", "2024-01-09 01:00:00")
    out = {r["entity_name"]: r for r in rep4}
    assert not out["orders"]["succeeded"] and out["items"]["succeeded"]
    assert {r.entity_name: r.last_watermark_value for r in c4.collect()}["orders"] == D(2024, 1, 5)
