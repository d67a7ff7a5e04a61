"""Every check of the suite fails on a seeded defect (and only the intended ones fail)."""

import datetime as dt

import pytest
from pyspark.sql import functions as F

from conftest import FIXTURE_LANDING
from strata.operators.history import CURRENT, END
from strata.plans import suite
from strata.plans.pipeline import Tables, run_pipeline


class Seeded(Tables):
    """Written tables with some of them replaced by defective versions."""

    def __init__(self, spark, root, **overrides):
        super().__init__(spark, root)
        self._over = overrides

    def __getattribute__(self, name):
        over = object.__getattribute__(self, "__dict__").get("_over", {})
        if name in over:
            return over[name]
        return super().__getattribute__(name)


@pytest.fixture(scope="module")
def lake(spark, tmp_path_factory):
    out = str(tmp_path_factory.mktemp("lake"))
    run_pipeline(spark, FIXTURE_LANDING, ["batch_1", "batch_2"], out, dt.datetime(2024, 3, 1), "demo")
    return out


def failing(spark, lake, **overrides):
    rows = suite.full_suite(Seeded(spark, lake, **overrides)).collect()
    return {r.check_name for r in rows if not r.passed}


def test_clean_lake_passes(spark, lake):
    assert failing(spark, lake) == set()


def test_a_gate_after_a_run_reads_each_fact_once(spark, lake, tmp_path):
    run = run_pipeline(spark, FIXTURE_LANDING, ["batch_1", "batch_2"], str(tmp_path / "lake"), dt.datetime(2024, 3, 1), "demo")
    t = run.tables
    assert t.observed["fct_sales.rows"] == 9 and t.observed["fct_sales.bad_quantity"] == 0 and t.observed["fct_inventory_movements.sign_violations"] == 0
    plan = suite.full_suite(t)._jdf.queryExecution().optimizedPlan().toString()
    scans = [line for line in plan.splitlines() if "Relation [" in line]
    assert sum("order_item_id" in x and "line_amount" in x for x in scans) <= 1 and sum("quantity_change" in x and "warehouse_sk" in x for x in scans) <= 1
    # what was observed equals what a reading finds
    afresh = {r.check_name: r.observed for r in suite.full_suite(Tables(spark, t.root)).collect()}
    assert {r["check_name"]: r["observed"] for r in run.checks if r["check_name"] in afresh} == afresh


def test_sales_fact_reads_orders_three_times(spark):
    from strata.plans.layers import Layers

    def relations(df, column):
        return sum(column in x for x in df._jdf.queryExecution().optimizedPlan().toString().splitlines() if "Relation [" in x)

    lay = Layers(spark, "/root/testdata/sf0.001")
    assert relations(lay.fct_sales, "o_orderkey") <= 3 and relations(lay.fct_sales, "l_orderkey") == 1
    full = suite.full_suite(lay)
    # lines: the fact once, Silver, the quarantine, and the raw ones of the check before dedup
    assert relations(full, "l_orderkey") <= 5, relations(full, "l_orderkey")


def test_fact_defects(spark, lake):
    t = Tables(spark, lake)
    f = t.fct_sales
    bad = (
        f.unionByName(f.limit(1))                                                  # duplicate line
        .withColumn("product_sk", F.when(F.col("order_item_id") == "OI1002", F.lit("nope")).otherwise(F.col("product_sk")))
        .withColumn("line_amount", F.when(F.col("order_item_id") == "OI1003", F.lit(1.0)).otherwise(F.col("line_amount")))
        .withColumn("customer_sk", F.when(F.col("order_item_id") == "OI1004", F.lit(None)).otherwise(F.col("customer_sk")))
    )
    assert failing(spark, lake, fct_sales=bad) == {
        "row count: fct_sales = silver.order_items_clean",
        "repeated keys: fct_sales.order_item_id",
        "orphans: fct_sales.product_sk -> dim_product",
        "amount differs from quantity times price: fct_sales",
        "missing customer version: fct_sales",
    }


def test_inventory_defects(spark, lake):
    inv = Tables(spark, lake).fct_inventory_movements
    bad = inv.withColumn(
        "quantity_change", F.when(F.col("event_id") == "IE1001", F.lit(-5)).otherwise(F.col("quantity_change"))
    ).withColumn("date_key", F.when(F.col("event_id") == "IE1002", F.lit(19990101)).otherwise(F.col("date_key")))
    assert failing(spark, lake, fct_inventory_movements=bad) == {
        "sign against event type: fct_inventory_movements",
        "orphans: fct_inventory_movements.date_key -> dim_date",
    }


def test_history_defects(spark, lake):
    h = Tables(spark, lake).customer_history
    bad = (
        h.withColumn(CURRENT, F.when(F.col("customer_id") == "C003", F.lit(False)).otherwise(F.col(CURRENT)))
        .withColumn(END, F.when((F.col("customer_id") == "C001") & ~F.col(CURRENT),
                                F.lit(dt.datetime(2024, 3, 1))).otherwise(F.col(END)))
    )
    got = failing(spark, lake, customer_history=bad, dim_customer=bad)
    assert "no current version: customers_history" in got
    assert "overlapping windows: customers_history" in got
    assert "gaps between windows: customers_history" in got


def test_dimension_defects(spark, lake):
    p = Tables(spark, lake).dim_product
    assert failing(spark, lake, dim_product=p.unionByName(p.limit(1))) == {"distinct = rows: dim_product.product_sk"}
