"""Path B end to end: control table -> copy -> load-date landing -> lake -> gate.

Two ingestion runs against a source that changes in between (rows updated in
place, rows added) must produce the same lake as loading both CSV batches.
"""

import datetime as dt

from pyspark.sql import functions as F

from conftest import FIXTURE_LANDING
from strata.operators import ingest as I
from strata.operators.clean import dedup_latest
from strata.plans.pipeline import ENTITY_COLUMNS, Tables, run_pipeline
from strata.sources import files
from test_pipeline_fixture import EDGE

# the six retail entities as a source system would expose them
SEED = [
    ("customers", "retail", "customers", "incremental", "updated_at", "customers", "parquet", True),
    ("products", "retail", "products", "incremental", "updated_at", "products", "parquet", True),
    ("warehouses", "retail", "warehouses", "full", None, "warehouses", "parquet", True),
    ("orders", "retail", "orders", "incremental", "order_timestamp", "orders", "parquet", True),
    ("order_items", "retail", "order_items", "full", None, "order_items", "parquet", True),
    ("inventory_events", "retail", "inventory_events", "incremental", "event_timestamp", "inventory_events", "parquet", True),
]
TIME_COLS = {"customers": "updated_at", "products": "updated_at", "orders": "order_timestamp",
             "inventory_events": "event_timestamp"}


def source_tables(spark, batches):
    """The source tables after the given batches were applied to them."""
    out = {}
    for entity, cols in ENTITY_COLUMNS.items():
        df = files.read_csv_batches(spark, FIXTURE_LANDING, batches, entity, cols).select(*cols, "batch_id")
        if entity in TIME_COLS:
            df = df.withColumn(TIME_COLS[entity], F.col(TIME_COLS[entity]).cast("timestamp_ntz"))
        if entity == "customers":  # updated in place: one row per customer, the latest
            df = dedup_latest(df, ["customer_id"], "updated_at")
        out[entity] = df.drop("batch_id")
    return out


def test_two_ingestion_runs_build_the_same_lake(spark, tmp_path):
    landing, lake = str(tmp_path / "landing"), str(tmp_path / "lake")
    control = I.seed_frame(spark, SEED)
    c1, r1 = I.run_ingestion(spark, control, source_tables(spark, ["batch_1"]), landing, "2024-01-15", "2024-01-15 02:00:00")
    c2, r2 = I.run_ingestion(spark, c1, source_tables(spark, ["batch_1", "batch_2"]), landing, "2024-02-15", "2024-02-15 02:00:00")
    assert all(r["succeeded"] for r in r1 + r2)
    marks = {r.entity_name: r.last_watermark_value for r in c2.collect()}
    assert marks["customers"] == dt.datetime(2024, 2, 1, 9)
    assert marks["orders"] == dt.datetime(2024, 2, 14, 15, 40)
    assert marks["warehouses"] is None

    res = run_pipeline(spark, landing, None, lake, dt.datetime(2024, 3, 1), "ingestion", EDGE, landing_format="parquet")
    assert res.passed and len(res.checks) == 50
    t = Tables(spark, lake)
    assert t.customer_history.count() == 8 and t.fct_sales.count() == 9
    assert round(t.fct_sales.agg(F.sum("line_amount")).first()[0], 2) == 643.86
    assert [r.order_item_id for r in t.quarantine("order_items").collect()] == ["OI2002"]
    # the second run copied only what changed
    orders_landed = files.read_partitions(spark, f"{landing}/orders").groupBy("batch_id").count().collect()
    assert {r.batch_id: r["count"] for r in orders_landed} == {
        "load_date=2024-01-15/run_id=r20240115020000": 5, "load_date=2024-02-15/run_id=r20240215020000": 3}
