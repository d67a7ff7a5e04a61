"""Point-in-time join, overlap/gap checks against brute force, and the gate."""

import datetime as dt
import types
import random

import pytest
from pyspark.sql import functions as F

from strata.operators import joins as J
from strata.plans import suite
from strata.operators import quality as Q
from strata.operators.history import CURRENT, END, START

D = dt.datetime
HIST_SCHEMA = f"customer_sk string, customer_id string, email string, {START} timestamp_ntz, {END} timestamp_ntz, {CURRENT} boolean"
EOT = D(9999, 12, 31, 23, 59, 59)


@pytest.fixture(scope="module")
def versions(spark):
    return spark.createDataFrame([
        ("v1", "C1", "old", D(2024, 1, 1), D(2024, 2, 1), False),
        ("v2", "C1", "new", D(2024, 2, 1), EOT, True),
        ("v3", "C2", "only", D(2024, 1, 5), EOT, True),
    ], HIST_SCHEMA)


def test_point_in_time_join_picks_the_version_in_effect(spark, versions):
    orders = spark.createDataFrame([
        ("O1", "C1", D(2024, 1, 10)),   # before the change
        ("O2", "C1", D(2024, 2, 1)),    # exactly on the boundary -> new version
        ("O3", "C1", D(2024, 3, 1)),    # after
        ("O4", "C2", D(2024, 1, 1)),    # before the first version -> unresolved
        ("O5", "C9", D(2024, 1, 1)),    # unknown customer -> unresolved
    ], "order_id string, customer_id string, ts timestamp_ntz")
    v = versions.select(F.col("customer_id").alias("vid"), "customer_sk", START, END)
    got = {r.order_id: r.customer_sk for r in J.point_in_time_join(orders, v, "customer_id", "vid", "ts").collect()}
    assert got == {"O1": "v1", "O2": "v2", "O3": "v2", "O4": None, "O5": None}


def test_naive_join_fans_out(spark, versions):
    orders = spark.createDataFrame([("O1", "C1"), ("O2", "C2")], "order_id string, customer_id string")
    v = versions.select(F.col("customer_id").alias("vid"), "customer_sk")
    assert J.naive_key_join(orders, v, "customer_id", "vid").count() == 3  # negative control


def brute_overlaps(rows):
    """The self-join form: pairs (a, b) of one key, different version key, intersecting."""
    later = set()
    for a in rows:
        for b in rows:
            if a[1] == b[1] and a[0] != b[0] and a[3] < b[4] and b[3] < a[4]:
                later.add(max(a, b, key=lambda r: (r[3], r[4], r[0])))
    return later


def test_overlap_scale_form_matches_self_join(spark):
    rng = random.Random(5)
    rows = []
    for k in range(60):
        for i in range(rng.randint(1, 5)):
            s = D(2024, 1, 1) + dt.timedelta(days=rng.randint(0, 20))
            e = s + dt.timedelta(days=rng.randint(1, 10))
            rows.append((f"k{k}_v{i}", f"k{k}", "x", s, e, False))
    df = spark.createDataFrame(rows, HIST_SCHEMA)
    flagged = {tuple(r) for r in J.overlapping_versions(df, "customer_id", "customer_sk").collect()}
    brute = brute_overlaps(rows)
    # every clash is reported on its later window, and keys agree exactly
    assert {r[1] for r in flagged} == {r[1] for r in brute}
    assert brute <= flagged


def test_gaps_and_missing_current(spark):
    df = spark.createDataFrame([
        ("a1", "A", "x", D(2024, 1, 1), D(2024, 1, 5), False),
        ("a2", "A", "y", D(2024, 1, 6), EOT, True),       # gap of one day
        ("b1", "B", "x", D(2024, 1, 1), D(2024, 1, 5), False),  # no current version
    ], HIST_SCHEMA)
    assert [r.customer_id for r in J.version_gaps(df, "customer_id").collect()] == ["A"]
    assert [r.customer_id for r in J.keys_without_current(df, "customer_id").collect()] == ["B"]


def test_every_structural_check_fails_on_its_defect(spark):
    df = spark.createDataFrame([
        ("a1", "A", "x", D(2024, 1, 1), D(2024, 1, 10), True),
        ("a2", "A", "y", D(2024, 1, 5), EOT, True),       # overlap + two current
        ("b1", "B", "x", D(2024, 1, 1), D(2024, 1, 5), False),  # no current
        ("c1", "C", "x", D(2024, 1, 5), D(2024, 1, 1), True),   # inverted window (T7)
    ], HIST_SCHEMA)
    lay = types.SimpleNamespace(customer_history=df)
    checks = suite.run_checks(lay, suite.SINGLE_CURRENT + suite.OVERLAPS + suite.GAPS)
    res = {r.check_name.split(":")[0]: r.observed for r in checks.collect()}
    assert res == {"several current versions": 1, "no current version": 1, "overlapping windows": 1,
                   "gaps between windows": 1, "empty windows": 1}


def test_an_empty_window_overlaps_nothing(spark):
    df = spark.createDataFrame([
        ("a1", "A", "x", D(2024, 1, 10), D(2024, 1, 5), False),
        ("a2", "A", "y", D(2024, 1, 5), EOT, True),
    ], HIST_SCHEMA)
    assert J.overlapping_versions(df, "customer_id", "customer_sk").count() == 0


def test_gate_reports_every_failure(spark):
    rows = F.count(F.lit(1))
    frame = Q.union_all([
        Q.table_checks(spark.range(0), [Q.Check("holds", rows), Q.Check("no evidence", rows, None)]),
        Q.table_checks(spark.range(3), [Q.Check("three too many", rows), Q.Check("one short", rows, 4)]),
    ])
    with pytest.raises(Q.ValidationFailed) as err:
        Q.gate(frame)
    assert str(err.value).splitlines()[1:] == ["no evidence = 0 instead of at least 1", "three too many = 3 instead of 0", "one short = 3 instead of 4"]
    assert "3 of 4" in str(err.value) and len(err.value.rows) == 4 and len(err.value.failing) == 3


def test_gate_passes_and_returns_rows(spark):
    rows = Q.gate(Q.table_checks(spark.range(0), [Q.Check("ok", F.count(F.lit(1)))]))
    assert rows[0].passed and rows[0].observed == 0


def test_run_stability_compares_latest_previous_run(spark):
    log = spark.createDataFrame([
        (D(2024, 1, 1), "t1", 5), (D(2024, 1, 2), "t1", 7), (D(2024, 1, 2), "t2", 3),
    ], Q.RUN_LOG_SCHEMA)
    now = spark.createDataFrame([(D(2024, 1, 3), "t1", 7), (D(2024, 1, 3), "t2", 4), (D(2024, 1, 3), "t3", 1)],
                                Q.RUN_LOG_SCHEMA)
    res = {r.check_name.split(" ")[-1]: r.passed for r in Q.run_stability(log, now).collect()}
    assert res == {"t1": True, "t2": False}  # t3 has no previous count: skipped


def test_item_without_order_breaks_grain(spark):
    from strata.operators import star

    items = spark.createDataFrame([("OI1", "O1", "P1", 1, 2.0), ("OI2", "O404", "P1", 1, 2.0)],
                                  "order_item_id string, order_id string, product_id string, quantity int, unit_price double")
    orders = spark.createDataFrame([("O1", "C1", "W1", D(2024, 1, 10), "COMPLETED")],
                                   "order_id string, customer_id string, warehouse_id string, order_timestamp timestamp_ntz, status string")
    dim_c = spark.createDataFrame([("v1", "C1", "e", "n", "s", "c", "r", D(2024, 1, 1), EOT, True)],
                                  f"customer_sk string, customer_id string, email string, customer_name string, segment string, city string, region string, {START} timestamp_ntz, {END} timestamp_ntz, {CURRENT} boolean")
    dim_p = spark.createDataFrame([("p", "P1", "x", "c", 2.0)], "product_sk string, product_id string, product_name string, category string, list_unit_price double")
    dim_w = spark.createDataFrame([("w", "W1", "x", "c", "r")], "warehouse_sk string, warehouse_id string, warehouse_name string, city string, region string")
    fct = star.fct_sales(items, orders, dim_c, dim_p, dim_w)
    assert [r.order_item_id for r in fct.collect()] == ["OI1"]  # inner join drops the orphan line
    assert not Q.table_checks(fct, [Q.Check("rows", F.count(F.lit(1)), items.count())]).first().passed


def test_incremental_slice_lookback(spark):
    from strata.operators.ingest import incremental_slice

    src = spark.createDataFrame([(1, D(2024, 1, 1)), (2, D(2024, 1, 2)), (3, D(2024, 1, 3))], "id int, wm timestamp_ntz")
    got = incremental_slice(src, "wm", "2024-01-02 12:00:00", D(2024, 1, 3), lookback="1 day")
    assert sorted(r.id for r in got.collect()) == [2, 3]


def test_trim_keys_is_opt_in(spark):
    from strata.operators import clean as C

    df = spark.createDataFrame([(" W1 ", "Amsterdam DC", "A", "NH", "t", "b1")],
                               "warehouse_id string, warehouse_name string, city string, region string, ingestion_timestamp string, batch_id string")
    spec = C.warehouses_spec()
    assert C.clean(df, spec)[0].first().warehouse_id == " W1 "
    spec.trim_keys = True
    assert C.clean(df, spec)[0].first().warehouse_id == "W1"
