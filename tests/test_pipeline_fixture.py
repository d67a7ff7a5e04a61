"""End-to-end run on the planted demo batches (expected values from FIXTURES.md)."""

import datetime as dt
import os

import pytest
from pyspark.sql import functions as F

from conftest import FIXTURE_LANDING
from strata.operators.quality import ValidationFailed
from strata.plans.pipeline import EdgeCases, Tables, run_pipeline

EDGE = EdgeCases(
    versions={"C001": 2, "C002": 2, "C006": 1},
    null_to_value_customer="C002",
    order_before_change="O1001",
    order_after_change="O2001",
    illegal_order_item="OI2002",
    duplicate_order_item="OI2001",
)


@pytest.fixture(scope="module")
def run(spark, tmp_path_factory):
    out = str(tmp_path_factory.mktemp("lake"))
    first = run_pipeline(spark, FIXTURE_LANDING, ["batch_1", "batch_2"], out,
                         dt.datetime(2024, 3, 1), "demo_generator", EDGE)
    second = run_pipeline(spark, FIXTURE_LANDING, ["batch_1", "batch_2"], out,
                          dt.datetime(2024, 3, 2), "demo_generator", EDGE)
    return out, first, second


def test_first_run_and_rerun_pass(run):
    _, first, second = run
    assert first.passed and second.passed
    assert len(first.checks) == 50
    # the rerun adds the four row-count stability checks
    assert len(second.checks) == 54
    assert sum("as the last run" in r["check_name"] for r in second.checks) == 4


def test_bronze_counts(run):
    _, first, _ = run
    c = first.counts
    assert (c["bronze.customers"], c["bronze.products"], c["bronze.warehouses"]) == (8, 6, 3)
    assert (c["bronze.orders"], c["bronze.order_items"], c["bronze.inventory_events"]) == (8, 11, 8)


def test_history(spark, run):
    out, *_ = run
    h = Tables(spark, out).customer_history
    rows = h.collect()
    assert len(rows) == 8
    assert sum(r.is_current for r in rows) == 6
    closed = [r for r in rows if not r.is_current]
    assert {r.customer_id for r in closed} == {"C001", "C002"}
    assert all(r.effective_end_timestamp == dt.datetime(2024, 2, 1, 9) for r in closed)
    assert all(r.effective_end_timestamp == dt.datetime(9999, 12, 31, 23, 59, 59) for r in rows if r.is_current)
    c002_old = [r for r in closed if r.customer_id == "C002"][0]
    assert c002_old.region is None
    sk = {(r.customer_id, r.effective_start_timestamp): r.customer_sk for r in rows}
    assert sk[("C001", dt.datetime(2024, 1, 1, 8))] == "58e16f7a34c8b51eb9190ba897d6d3c0"
    assert sk[("C001", dt.datetime(2024, 2, 1, 9))] == "618fd835536ab050047da611bd8bf1e5"


def test_dimensions(spark, run):
    out, *_ = run
    t = Tables(spark, out)
    assert t.dim_product.count() == 6
    assert t.dim_warehouse.count() == 3
    keys = {r.product_id: r.product_sk for r in t.dim_product.collect()}
    assert keys["P001"] == "33efbb16ece8550ff8eff9fd435442fc"
    wkeys = {r.warehouse_id: r.warehouse_sk for r in t.dim_warehouse.collect()}
    assert wkeys["W01"] == "914365a86081702076acb38d247ac930"
    d = t.dim_date.orderBy("date").collect()
    assert len(d) == 44
    assert d[0].date == dt.date(2024, 1, 2) and d[-1].date == dt.date(2024, 2, 14)
    assert sum(r.is_weekend for r in d) == 12
    assert d[0].date_key == 20240102 and d[0].day_name == "Tuesday"


def test_sales_fact(spark, run):
    out, *_ = run
    t = Tables(spark, out)
    f = t.fct_sales
    assert f.count() == 9
    assert round(f.agg(F.sum("line_amount")).first()[0], 2) == 643.86
    by_order = {r.order_item_id: r for r in f.collect()}
    assert "OI2002" not in by_order
    cur = {r.customer_sk: r.is_current for r in t.dim_customer.collect()}
    assert cur[by_order["OI1001"].customer_sk] is False
    assert cur[by_order["OI2001"].customer_sk] is True


def test_inventory_and_net_stock(spark, run):
    from strata.operators.star import net_stock_movement

    out, *_ = run
    t = Tables(spark, out)
    assert t.fct_inventory_movements.count() == 8
    net = net_stock_movement(t.fct_inventory_movements, t.dim_warehouse, t.dim_product).collect()
    got = {(r.warehouse_name, r.product_name): r.net_movement for r in net}
    wid = {r.warehouse_id: r.warehouse_name for r in t.dim_warehouse.collect()}
    pid = {r.product_id: r.product_name for r in t.dim_product.collect()}
    expected = {("W01", "P001"): 498, ("W01", "P002"): -1, ("W01", "P003"): 120,
                ("W02", "P001"): -4, ("W02", "P004"): 65, ("W03", "P005"): 80}
    assert got == {(wid[w], pid[p]): v for (w, p), v in expected.items()}


def test_quarantine(spark, run):
    out, *_ = run
    q = Tables(spark, out).quarantine("order_items").collect()
    assert [r.order_item_id for r in q] == ["OI2002"]
    assert q[0].quarantine_reason == "null keys / non-positive quantity / negative price"
    assert q[0].failed_rules == "quantity_positive"
    assert q[0].quarantine_timestamp is not None


def test_run_log_only_after_pass(spark, run):
    out, *_ = run
    log = Tables(spark, out).read("gold", "validation_run_log")
    assert log.count() == 8  # 4 tables x 2 passing runs
    assert log.select("run_timestamp").distinct().count() == 2


def test_failing_gate_does_not_append_run_log(spark, tmp_path):
    out = str(tmp_path / "lake")
    bad = EdgeCases(versions={"C001": 3})
    with pytest.raises(ValidationFailed) as err:
        run_pipeline(spark, FIXTURE_LANDING, ["batch_1", "batch_2"], out, dt.datetime(2024, 3, 1), "demo", bad)
    assert "versions of C001 = 2 instead of 3" in str(err.value)
    assert not Tables(spark, out).exists("gold", "validation_run_log")
    kept = run_pipeline(spark, FIXTURE_LANDING, ["batch_1", "batch_2"], out, dt.datetime(2024, 3, 1), "demo", bad, raise_on_failure=False)
    # nothing is published, yet what failed can be looked at
    assert not kept.passed and kept.tables.fct_sales.count() == 9 and Tables(spark, out).versions.number == 0


def test_parquet_landing_gives_the_same_lake(spark, tmp_path, run):
    """Incremental entities accumulate load dates; full entities use only the
    latest snapshot (an older, partial snapshot is ignored)."""
    from strata.operators.ingest import land_partitioned
    from strata.plans.pipeline import ENTITY_COLUMNS, LOAD_TYPES
    from strata.sources import files

    landing = str(tmp_path / "landing")
    dates = {"batch_1": "2024-01-01", "batch_2": "2024-02-01"}
    for entity, cols in ENTITY_COLUMNS.items():
        read = lambda bs: files.read_csv_batches(spark, FIXTURE_LANDING, bs, entity, cols).select(*cols)
        if LOAD_TYPES[entity] == "incremental":
            for b, d in dates.items():
                land_partitioned(read([b]), f"{landing}/{entity}", d)
        else:
            land_partitioned(read(["batch_1"]), f"{landing}/{entity}", dates["batch_1"])
            land_partitioned(read(["batch_1", "batch_2"]), f"{landing}/{entity}", dates["batch_2"])
    out = str(tmp_path / "lake")
    res = run_pipeline(spark, landing, None, out, dt.datetime(2024, 3, 1), "landing", EDGE, landing_format="parquet")
    assert res.passed and len(res.checks) == 50
    _, first, _ = run
    same = [k for k in first.counts if not k.startswith("bronze.warehouses") and not k.endswith("_lines")]
    assert {k: res.counts[k] for k in same} == {k: first.counts[k] for k in same}
    t = Tables(spark, out)
    assert round(t.fct_sales.agg(F.sum("line_amount")).first()[0], 2) == 643.86
    assert {r.batch_id for r in t.raw("orders").collect()} == {"load_date=2024-01-01", "load_date=2024-02-01"}
    assert {r.batch_id for r in t.raw("order_items").collect()} == {"load_date=2024-02-01"}


def test_facts_partitioned_by_month(spark, tmp_path, run):
    out = str(tmp_path / "lake")
    res = run_pipeline(spark, FIXTURE_LANDING, ["batch_1", "batch_2"], out, dt.datetime(2024, 3, 1), "demo", EDGE,
                       facts_by_month=True)
    assert res.passed
    t = Tables(spark, out)
    months = sorted(d for d in os.listdir(t.path("gold", "fct_sales")) if d.startswith("date_month="))
    assert months == ["date_month=202401", "date_month=202402"]
    assert "date_month" not in t.fct_sales.columns and t.fct_sales.count() == 9
    # a month filter reads one partition only
    jan = spark.read.parquet(t.path("gold", "fct_sales")).where("date_month = 202401")
    assert jan.count() == 6


def test_register_layers_answers_reference_style_sql(spark, run):
    from strata.plans.pipeline import register_layers

    out, *_ = run
    names = register_layers(spark, out, prefix="demo_")
    assert register_layers(spark, out, prefix="demo_") == names  # re-registering replaces
    assert "demo_gold.fct_sales" in names and "demo_silver.order_items_clean" in names
    rows = spark.sql("""
        SELECT f.order_item_id, f.order_timestamp, c.customer_id, c.email, f.line_amount
        FROM demo_gold.fct_sales f
        JOIN demo_gold.dim_customer c ON f.customer_sk = c.customer_sk
        WHERE c.customer_id IN (
            SELECT customer_id FROM demo_gold.dim_customer GROUP BY customer_id HAVING COUNT(*) > 1)
        ORDER BY c.customer_id, f.order_timestamp, f.order_item_id
    """).collect()
    assert [(r.order_item_id, r.email) for r in rows] == [
        ("OI1001", "c001@old.example"), ("OI1002", "c001@old.example"),
        ("OI2001", "c001@new.example"), ("OI1003", "c002@example.com")]
    q = spark.sql("SELECT order_item_id FROM demo_quarantine.order_items").collect()
    assert [r.order_item_id for r in q] == ["OI2002"]
    assert spark.sql("SELECT count(*) AS n FROM demo_silver.order_items_clean").first().n == 9
