"""The suite and the run counts read each table no oftener than they need, and what is saved changes no figure."""

import datetime as dt

from pyspark.sql import functions as F

from strata.operators import history as H
from strata.operators.clean import EntitySpec, standardise
from strata.plans import standins, suite
from strata.plans.layers import DefectiveLayers, Layers

SF = "/root/testdata/sf0.001"


def lines(df, *words):
    plan = df._jdf.queryExecution().optimizedPlan().toString()
    return [x for x in plan.splitlines() if all(w in x for w in words)]


def test_a_time_that_is_typed_is_not_searched_for_a_zone(spark):
    spec = EntitySpec("e", ["k"], [], "bad", casts={c: "timestamp" for c in ("d", "t", "n", "s")})
    day = dt.datetime(2024, 2, 29, 23, 59, 59, 123456)
    rows = [("a", day.date(), day, day, "2024-02-29 23:59:59+02:00"), ("b", None, None, None, "nothing")]
    typed = standardise(spark.createDataFrame(rows, "k string, d date, t timestamp, n timestamp_ntz, s string"), spec)
    assert [tuple(r)[1:] for r in typed.orderBy("k").collect()] == [
        (dt.datetime(2024, 2, 29), day, day, dt.datetime(2024, 2, 29, 21, 59, 59)), (None, None, None, None)]
    assert lines(typed.select("s"), "RLIKE") and not lines(typed.select("d", "t", "n"), "RLIKE")


def test_order_items_are_deduplicated_once_for_all_their_checks(spark):
    lay = DefectiveLayers(spark, SF)
    full = suite.full_suite(lay)
    # one for the fact, one for the keys of Silver and the quarantine
    assert len(lines(full, "Window [", "order_item_id")) == 2
    silver, bad = lay.silver("order_items"), lay.quarantine("order_items").select("order_item_id").distinct()
    want = silver.agg(F.count("*"), F.count("*") - F.count_distinct("order_item_id")).first()
    leaked = silver.join(bad, "order_item_id", "left_semi").count()
    got = {r.metric.split(".")[-1]: r.value for r in suite.items_pass(lay, {"rows", "extra_rows", "leaked"}).collect()}
    assert got == {"rows": want[0], "extra_rows": want[1], "leaked": leaked} and min(got.values()) > 0


class TwoTables:
    def __init__(self, silver, quarantine):
        self.frames = silver, quarantine

    def silver(self, entity):
        return self.frames[0]

    def quarantine(self, entity):
        return self.frames[1]


def test_item_checks_with_null_and_repeated_keys(spark):
    kept, bad, none = (spark.createDataFrame([(k,) for k in x], "order_item_id string") for x in (["a", "a", "b", "c", None, None], ["a", "c", "c", "d", None], []))
    got = lambda lay, *want: {r.metric.split(".")[-1]: r.value for r in suite.items_pass(lay, set(want)).collect()}
    assert got(TwoTables(kept, bad), "rows", "extra_rows", "leaked") == {"rows": 6, "extra_rows": 3, "leaked": 3}
    assert got(TwoTables(kept, bad), "rows", "extra_rows") == {"rows": 6, "extra_rows": 3}
    assert got(TwoTables(none, none), "rows", "extra_rows", "leaked") == {"rows": 0, "extra_rows": 0, "leaked": 0}


def test_own_keys_of_a_fact_do_not_meet_its_dimensions(spark):
    fact = spark.range(4000).select(
        F.when(F.col("id") % 40 != 0, F.col("id") - F.col("id") % 4 % 2).alias("item"), F.when(F.col("id") % 5 > 0, F.col("id") % 5).alias("fk"))
    dim = spark.createDataFrame([(1,), (2,), (2,)], "k long")
    passed = suite.fact_pass(fact, "f", "item", {"rows", "extra_rows", "orphan", "odd"}, {"odd": F.col("item") % 2 == 1}, {"orphan": ("fk", dim, "k")})
    rows = fact.collect()
    known = [r.item for r in rows if r.item is not None]
    assert {r.metric: r.value for r in passed.collect()} == {
        "f.rows": 4000, "f.extra_rows": 4000 - len(set(known)), "f.orphan": sum(r.fk not in (1, 2) for r in rows), "f.odd": sum(k % 2 for k in known)}
    joined = lines(passed, "Join LeftOuter")
    assert joined and not any("own" in x for x in joined)
    assert lines(passed, "count(distinct own")


def test_a_count_of_the_facts_carries_only_keys(spark):
    lay = Layers(spark, SF)
    for fact in (lay.fct_sales, lay.fct_inventory_movements):
        salts = lines(fact.agg(F.count(F.lit(1))), "xxhash64(")
        assert salts and not any("product_sk" in x or "warehouse_sk" in x or "quantity" in x for x in salts)


def test_the_order_of_batches_reads_no_customers(spark):
    feed = H.prepare_feed(standins.raw_customers(spark, SF))[0]
    assert not lines(H.order_batches(feed, "batch_id", "updated_at"), "Relation", "c_custkey")
