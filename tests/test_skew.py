"""A key holding a third of the fact rows is split by AQE in the point-in-time join."""

import contextlib
import datetime as dt
import io

from pyspark.sql import functions as F

from strata.operators import star
from strata.operators.history import CURRENT, END, START


def test_hot_customer_is_split_in_point_in_time_join(spark, tmp_path):
    conf = {
        "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "64k",
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": "32k",
        "spark.sql.autoBroadcastJoinThreshold": "-1",
        "spark.sql.shuffle.partitions": "16",
    }
    old = {k: spark.conf.get(k, None) for k in conf}
    for k, v in conf.items():
        spark.conf.set(k, v)
    try:
        n = 60000
        spark.range(n).select(
            F.col("id").cast("string").alias("order_id"),
            F.when(F.col("id") % 3 == 0, F.lit("HOT")).otherwise((F.col("id") % 2000).cast("string")).alias("customer_id"),
            (F.lit(dt.datetime(2024, 6, 1)).cast("timestamp_ntz")
             + F.make_interval(mins=(F.col("id") % 1000).cast("int"))).alias("order_timestamp"),
        ).write.parquet(str(tmp_path / "orders"))
        keys = spark.range(2000).select(F.col("id").cast("string").alias("customer_id")).union(
            spark.createDataFrame([("HOT",)], "customer_id string"))
        keys.select(
            F.md5("customer_id").alias("customer_sk"), "customer_id",
            F.lit(dt.datetime(2024, 1, 1)).cast("timestamp_ntz").alias(START),
            F.lit(dt.datetime(9999, 12, 31, 23, 59, 59)).cast("timestamp_ntz").alias(END),
            F.lit(True).alias(CURRENT),
        ).write.parquet(str(tmp_path / "dim_customer"))
        # AQE path (salting off): both inputs are plain shuffles, so the hot partition is split
        res = star.resolve_customer_version(
            spark.read.parquet(str(tmp_path / "orders")), spark.read.parquet(str(tmp_path / "dim_customer")),
            skew_fraction=None)
        rows = res.collect()
        assert len(rows) == n and all(r.customer_sk for r in rows)  # whole result, nothing dropped
        buf = io.StringIO()
        with contextlib.redirect_stdout(buf):
            res.explain()
        assert "SortMergeJoin(skew=true)" in buf.getvalue()
    finally:
        for k, v in old.items():
            if v is None:
                spark.conf.unset(k)
            else:
                spark.conf.set(k, v)


def test_salted_point_in_time_join_equals_plain_join(spark):
    from strata.operators import joins as J

    n = 20000
    facts = spark.range(n).select(
        F.col("id").alias("fid"),
        F.when(F.col("id") % 3 == 0, F.lit("HOT")).otherwise((F.col("id") % 500).cast("string")).alias("k"),
        (F.lit(dt.datetime(2024, 1, 1)).cast("timestamp_ntz") + F.make_interval(days=(F.col("id") % 60).cast("int"))).alias("ts"),
    )
    keys = [str(i) for i in range(500)] + ["HOT"]
    rows = []
    for k in keys:  # two versions per key, changing on day 30
        rows.append((k, f"{k}-a", dt.datetime(2024, 1, 5), dt.datetime(2024, 1, 31)))
        rows.append((k, f"{k}-b", dt.datetime(2024, 1, 31), dt.datetime(9999, 12, 31, 23, 59, 59)))
    versions = spark.createDataFrame(rows, f"vk string, sk string, {START} timestamp_ntz, {END} timestamp_ntz")
    plain = J.point_in_time_join(facts, versions, "k", "vk", "ts")
    salted = J.point_in_time_join(facts, versions, "k", "vk", "ts", skew_fraction=0.05, salt_buckets=8)
    assert salted.columns == plain.columns
    a = sorted((r.fid, r.sk) for r in plain.select("fid", "sk").collect())
    b = sorted((r.fid, r.sk) for r in salted.select("fid", "sk").collect())
    assert a == b and len(b) == n                     # whole result, one version per row at most
    assert J.hot_keys(facts, "k", 0.05).collect()[0]["_hot_key"] == "HOT"
    buf = io.StringIO()
    with contextlib.redirect_stdout(buf):
        salted.explain()
    assert "_salt" in buf.getvalue()


def test_salted_lookups_equal_plain_lookups(spark):
    from strata.operators import star
    from strata.plans.layers import Layers

    lay = Layers.shared(spark, "/root/testdata/sf0.001")
    args = (lay.silver("order_items"), lay.silver("orders"), lay.dim_customer, lay.dim_product, lay.dim_warehouse)
    plain = star.fct_sales(*args, warehouse_from="items")
    salted = star.fct_sales(*args, warehouse_from="items", lookup_skew_fraction=0.001)
    key = lambda r: tuple("" if v is None else str(v) for v in r)
    assert sorted(map(key, plain.collect())) == sorted(map(key, salted.collect()))
    inv = (lay.silver("inventory_events"), lay.dim_warehouse, lay.dim_product)
    assert sorted(map(key, star.fct_inventory_movements(*inv).collect())) == sorted(
        map(key, star.fct_inventory_movements(*inv, lookup_skew_fraction=0.001).collect()))


def test_null_keys_are_spread_in_one_plan(spark):
    from strata.operators import joins as J

    facts = spark.range(30000).select(
        F.col("id").alias("fid"),
        F.when(F.col("id") % 3 == 0, F.lit(None)).otherwise((F.col("id") % 50).cast("string")).alias("k"),
        F.lit(dt.datetime(2024, 2, 1)).cast("timestamp_ntz").alias("ts"),
    )
    versions = spark.createDataFrame(
        [(str(i), f"v{i}", dt.datetime(2024, 1, 1), dt.datetime(9999, 12, 31)) for i in range(50)],
        f"vk string, sk string, {START} timestamp_ntz, {END} timestamp_ntz")
    dims = spark.createDataFrame([(str(i), f"d{i}") for i in range(50)], "dk string, name string")
    settings = {"spark.sql.adaptive.enabled": "false", "spark.sql.autoBroadcastJoinThreshold": "-1", "spark.sql.shuffle.partitions": "8"}
    before = {k: spark.conf.get(k) for k in settings}
    for k, v in settings.items():
        spark.conf.set(k, v)
    try:
        for got, columns, value in ((J.point_in_time_join(facts, versions, "k", "vk", "ts"), versions.columns, "sk"),
                                    (J.point_in_time_join(facts, versions, "k", "vk", "ts", skew_fraction=0.01, salt_buckets=4), versions.columns, "sk"),
                                    (J.lookup_join(facts, dims, "k", "dk"), dims.columns, "name")):
            assert got.columns == facts.columns + columns
            rows = got.withColumn("task", F.spark_partition_id()).collect()
            assert len(rows) == 30000 and sum(r[value] is None for r in rows) == 10000
            assert all(r[value][1:] == r.k for r in rows if r.k is not None)
            # 10,000 rows without a key, 400 for each other: the former are as even as can be
            loads = sorted(sum(r.task == t for r in rows if r.k is None) for t in range(8))
            assert loads[-1] <= 2 * loads[4] and loads[0] > 0
            plan = got._jdf.queryExecution().optimizedPlan()
            assert "Union" not in plan.toString()
    finally:
        for k, v in before.items():
            spark.conf.set(k, v)
