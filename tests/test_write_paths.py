"""Reruns, second runs and late batches lose nothing and keep nothing stale."""

import datetime as dt
import random

import pytest
from pyspark.sql import functions as F

from strata.functions import scalar as S
from strata.operators import history as H
from strata.operators.clean import Rule, dedup_latest
from strata.operators.ingest import CONTROL_SCHEMA, run_ingestion
from strata.sources import files, sinks

D = dt.datetime


def frame(spark, rows, schema="id int, v int, month int"):
    return spark.createDataFrame(rows, schema)


@pytest.mark.parametrize("second", [[(1, 1, 1), (2, 2, 1)], [(1, -1, 1), (2, -2, 1)]])
def test_rerun_of_a_split_equals_a_fresh_one(spark, tmp_path, second):
    rules = [Rule("positive", F.col("v") > 0)]
    sinks.write_split(frame(spark, [(1, 1, 1), (2, -2, 1)]), rules, "bad", str(tmp_path / "t"))
    again = sinks.write_split(frame(spark, second), rules, "bad", str(tmp_path / "t"))
    good = [r.id for r in again.valid(spark).orderBy("id").collect()]
    bad = [r.id for r in again.quarantined(spark).orderBy("id").collect()]
    assert (good, bad) == (([1, 2], []) if second[0][1] > 0 else ([], [1, 2]))
    assert (again.valid_rows, again.quarantined_rows) == (len(good), len(bad))


def test_a_month_that_disappears_is_gone(spark, tmp_path):
    target = str(tmp_path / "fact")
    sinks.write_counted(frame(spark, [(1, 1, 1), (2, 2, 2)]), target, partition_by=["month"])
    spark.conf.set("spark.sql.sources.partitionOverwriteMode", "dynamic")  # whatever the session says
    try:
        assert sinks.write_counted(frame(spark, [(3, 3, 2)]), target, partition_by=["month"]) == 1
    finally:
        spark.conf.set("spark.sql.sources.partitionOverwriteMode", "static")
    assert [r.id for r in spark.read.parquet(target).collect()] == [3]


def test_two_runs_on_one_date_keep_both_slices(spark, tmp_path):
    source = lambda n: frame(spark, [(k, D(2024, 1, k)) for k in range(1, n + 1)], "id int, wm timestamp_ntz")
    control = spark.createDataFrame([("e", "s", "t", "incremental", "wm", "t", "parquet", True, None, None)], CONTROL_SCHEMA)
    root = str(tmp_path)
    control, _ = run_ingestion(spark, control, {"t": source(2)}, root, "2024-02-01", "2024-02-01 01:00:00")
    before = control
    for _ in range(2):  # the second run, and a retry of it
        control, report = run_ingestion(spark, before, {"t": source(3)}, root, "2024-02-01", "2024-02-01 02:00:00")
        assert report[0]["succeeded"]
        landed = files.read_partitions(spark, f"{root}/t")
        assert sorted(r.id for r in landed.collect()) == [1, 2, 3]
        assert {r.batch_id for r in landed.collect()} == {f"load_date=2024-02-01/run_id=r20240201{h}0000" for h in ("01", "02")} and files.RUN_ID not in landed.columns


def test_latest_snapshot_opens_one_folder(spark, tmp_path):
    root = str(tmp_path)
    frame(spark, [(1, 1, 1)]).write.parquet(f"{root}/load_date=2024-01-01")
    frame(spark, [(2, 2)], "id int, v int").write.parquet(f"{root}/load_date=2024-01-02")
    snapshot = files.read_latest_snapshot(spark, root)
    assert "month" not in snapshot.columns and [r.id for r in snapshot.collect()] == [2]
    assert files.list_batches(spark, root) == ["2024-01-01", "2024-01-02"]
    with pytest.raises(FileNotFoundError):
        files.list_batches(spark, f"{root}/none")


def test_batch_ten_is_later_than_batch_nine(spark):
    rows = [("k", f"batch_{n}", "t", n) for n in range(1, 13)]
    df = spark.createDataFrame(rows, "key string, batch_id string, ts string, n int")
    assert [r.n for r in dedup_latest(df, ["key"], "ts").collect()] == [12]
    dates = spark.createDataFrame([("load_date=2024-02-01",), ("load_date=2024-01-15",)], "b string")
    assert dates.orderBy(S.natural_order("b").desc()).first().b == "load_date=2024-02-01"


def test_runs_of_many_digits_compare_as_numbers(spark):
    names = ["b1" + "0" * 30, "b9" + "0" * 29, "b" + "7" * 25, "b" + "7" * 24 + "8", "b2", "b010", "b9"]
    df = spark.createDataFrame([(n,) for n in names], "b string")
    assert [r.b for r in df.orderBy(S.natural_order("b")).collect()] == ["b2", "b9", "b010", names[2], names[3], names[1], names[0]]


@pytest.mark.parametrize("zone", ["UTC", "America/Los_Angeles", "Europe/Paris"])
def test_zones_by_name_move_to_utc(spark, zone):
    old = spark.conf.get("spark.sql.session.timeZone")
    spark.conf.set("spark.sql.session.timeZone", zone)
    want = {
        "2024-01-01 08:00:00 Europe/Paris": D(2024, 1, 1, 7), "2024-01-01 08:00:00 PST": D(2024, 1, 1, 16), "2024-07-01T08:00:00Europe/Paris": D(2024, 7, 1, 6),
        "2024-01-01 08:00:00 UTC": D(2024, 1, 1, 8), "2024-01-01 08:00:00.25 GMT+2": D(2024, 1, 1, 6, 0, 0, 250000), "2024-01-01 08:00:00 +05:30": D(2024, 1, 1, 2, 30),
        "2024-01-01 08:00:00 Nowhere/City": None, "2024-01-01 08:00:00 PM": None,
        # hours that a zone has twice or not at all
        "2024-11-03T09:30:00Z": D(2024, 11, 3, 9, 30), "2024-11-03T08:30:00Z": D(2024, 11, 3, 8, 30), "2024-03-31T02:30:00": D(2024, 3, 31, 2, 30), "1969-12-31 23:59:59.5Z": D(1969, 12, 31, 23, 59, 59, 500000),
    }
    try:
        got = spark.createDataFrame([(t,) for t in want], "t string").select("t", S.to_timestamp("t").alias("x")).collect()
    finally:
        spark.conf.set("spark.sql.session.timeZone", old)
    assert {r.t: r.x for r in got} == want


@pytest.mark.parametrize("zone", ["UTC", "America/Los_Angeles"])
def test_offsets_move_to_utc(spark, zone):
    old = spark.conf.get("spark.sql.session.timeZone")
    spark.conf.set("spark.sql.session.timeZone", zone)
    try:
        texts = ["2024-01-01T08:00:00+05:00", "2024-01-01 08:00:00Z", "2024-07-01 08:00:00", "2024-01-01", "n/a", None, "2024-01-01 08:00:00.5-0330"]
        got = spark.createDataFrame([(t,) for t in texts], "t string").select(S.to_timestamp("t").alias("x")).collect()
    finally:
        spark.conf.set("spark.sql.session.timeZone", old)
    assert [r.x for r in got][:6] == [D(2024, 1, 1, 3), D(2024, 1, 1, 8), D(2024, 7, 1, 8), D(2024, 1, 1), None, None]


def test_amounts_that_do_not_fit_are_null_and_quarantined(spark):
    from strata.operators import clean as C

    df = spark.createDataFrame([("a", "o", "p", "2", "1e20"), ("b", "o", "p", "2", "NaN"), ("c", "o", "p", "2", "Infinity"), ("d", "o", "p", "3", "1.005")],
                               "order_item_id string, order_id string, product_id string, quantity string, unit_price string")
    good, bad = C.clean(df, C.with_order_col(C.order_items_spec(), None))
    assert [r.order_item_id for r in good.collect()] == ["d"]
    assert {r.failed_rules for r in bad.collect()} == {"unit_price_in_range"}
    typed = df.select(S.line_amount(S.to_int("quantity"), S.to_double("unit_price")).alias("x"))
    assert [r.x for r in typed.collect()] == [None, None, None, 3.02]


def feed(spark, seed):
    rng = random.Random(seed)
    rows = []
    for b in range(6):
        for _ in range(rng.randint(1, 12)):
            rows.append((f"c{rng.randint(0, 4)}", rng.choice(["x", "y", None]), "n", "s", "c", "r", D(2024, 1 + b, rng.randint(1, 28)), f"b{b}"))
    return spark.createDataFrame(rows, "customer_id string, email string, customer_name string, segment string, city string, region string, updated_at timestamp_ntz, batch_id string")


def history_rows(df):
    return sorted((tuple(r[c] for c in sorted(df.columns)) for r in df.collect()), key=repr)


@pytest.mark.parametrize("seed", range(4))
def test_late_and_new_batches_equal_a_rebuild(spark, seed):
    df = feed(spark, seed)
    new = F.col("batch_id").isin("b1", "b4", "b5")
    applied = H.apply_batches(H.build_history(df.where(~new)), df.where(new), df.where(~new))
    assert history_rows(applied) == history_rows(H.build_history(df))


def test_the_plan_does_not_grow_with_the_batches(spark, tmp_path):
    H.build_history(feed(spark, 1)).write.parquet(str(tmp_path / "h"))
    sizes = []
    for n in (1, 5):
        rows = [("c1", "z", "n", "s", "c", "r", D(2025, k, 1), f"n{k}") for k in range(1, n + 1)]
        new = spark.createDataFrame(rows, feed(spark, 1).schema)
        plan = H.apply_batches(spark.read.parquet(str(tmp_path / "h")), new)._jdf.queryExecution().optimizedPlan()
        sizes.append(plan.collectLeaves().size())
    assert sizes[0] == sizes[1] <= 4
