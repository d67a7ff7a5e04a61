"""Type-2 history: the window plan equals the sequential batch-by-batch model."""

import datetime as dt
import hashlib
import random
import types

import pytest
from pyspark.sql import functions as F

from strata.operators import history as H

TRACKED = H.CUSTOMER_TRACKED
EOT = dt.datetime(9999, 12, 31, 23, 59, 59)
SCHEMA = (
    "customer_id string, email string, customer_name string, segment string, city string, "
    "region string, updated_at timestamp_ntz, batch_id string"
)


def _key(row):
    # latest updated_at, then later batch, then the other columns, all "desc nulls last"
    parts = [row["updated_at"], row["batch_id"]] + [row[c] for c in TRACKED]
    return tuple((v is not None, v if v is not None else "") for v in parts)


def sequential_history(rows):
    """The reference algorithm: batches in (min ts, id) order; per batch the
    latest row per key; compare null-safely with the current version; expire
    it and insert the new one."""
    by_batch = {}
    for r in rows:
        by_batch.setdefault(r["batch_id"], []).append(r)
    order = sorted(by_batch, key=lambda b: (min(r["updated_at"] for r in by_batch[b]), b))
    versions, current = [], {}
    for b in order:
        latest = {}
        for r in by_batch[b]:
            k = r["customer_id"]
            if k not in latest or _key(r) > _key(latest[k]):
                latest[k] = r
        for k, r in latest.items():
            cur = current.get(k)
            if cur is not None and all(cur[c] == r[c] for c in TRACKED):
                continue
            if cur is not None:
                cur["effective_end_timestamp"] = r["updated_at"]
                cur["is_current"] = False
            v = {c: r[c] for c in ["customer_id", *TRACKED]}
            v.update(
                customer_sk=hashlib.md5(f"{k}|{r['updated_at']:%Y-%m-%d %H:%M:%S}".encode()).hexdigest(),
                effective_start_timestamp=r["updated_at"],
                effective_end_timestamp=EOT,
                is_current=True,
            )
            versions.append(v)
            current[k] = v
    return versions


def random_feed(rng, feed):
    rows = []
    n_batches = rng.randint(1, 4)
    for b in range(n_batches):
        for k in range(rng.randint(1, 4)):
            for _ in range(rng.randint(0, 3)):
                rows.append({
                    "customer_id": f"f{feed}_k{k}",
                    "email": rng.choice(["a", "b", None]),
                    "customer_name": rng.choice(["n1", "n2"]),
                    "segment": rng.choice(["s", None]),
                    "city": "c",
                    "region": rng.choice(["r1", "r2", None]),
                    # few distinct times -> ties, late data and equal timestamps
                    "updated_at": dt.datetime(2024, 1, 1) + dt.timedelta(hours=rng.randint(0, 5)),
                    "batch_id": f"f{feed}_b{b}",
                })
    return rows


def _as_set(rows):
    cols = ["customer_sk", "customer_id", *TRACKED, H.START, H.END, H.CURRENT]
    return sorted((tuple(r[c] for c in cols) for r in rows), key=repr)


@pytest.fixture(scope="module")
def feeds():
    rng = random.Random(7)
    rows = []
    for f in range(300):
        rows += random_feed(rng, f)
    return rows


def test_window_plan_equals_sequential_model(spark, feeds):
    df = spark.createDataFrame(feeds, SCHEMA)
    got = [r.asDict() for r in H.build_history(df).collect()]
    expected = []
    by_feed = {}
    for r in feeds:
        by_feed.setdefault(r["batch_id"].split("_")[0], []).append(r)
    for rows in by_feed.values():
        expected += sequential_history(rows)
    assert _as_set(got) == _as_set(expected)


def test_partitioning_and_input_order_do_not_matter(spark, feeds):
    rows = list(feeds)
    random.Random(3).shuffle(rows)
    a = H.build_history(spark.createDataFrame(feeds, SCHEMA).repartition(1)).collect()
    b = H.build_history(spark.createDataFrame(rows, SCHEMA).repartition(13)).collect()
    assert _as_set([r.asDict() for r in a]) == _as_set([r.asDict() for r in b])


def _feed(spark, rows):
    return spark.createDataFrame(
        [dict(zip(["customer_id", *TRACKED, "updated_at", "batch_id"], r)) for r in rows], SCHEMA
    )


def test_null_to_value_is_a_change(spark):
    t1, t2 = dt.datetime(2024, 1, 1, 8), dt.datetime(2024, 2, 1, 9)
    df = _feed(spark, [
        ("C002", "e", "n", "s", "c", None, t1, "batch_1"),
        ("C002", "e", "n", "s", "c", "South", t2, "batch_2"),
    ])
    h = H.build_history(df).orderBy(H.START).collect()
    assert [r.region for r in h] == [None, "South"]
    assert [r.is_current for r in h] == [False, True]
    assert h[0][H.END] == t2


def test_a_b_a_gives_three_versions_and_unchanged_replay_none(spark):
    t = [dt.datetime(2024, 1, d) for d in (1, 2, 3, 4)]
    df = _feed(spark, [
        ("K", "A", "n", "s", "c", "r", t[0], "b1"),
        ("K", "B", "n", "s", "c", "r", t[1], "b2"),
        ("K", "A", "n", "s", "c", "r", t[2], "b3"),
        ("K", "A", "n", "s", "c", "r", t[3], "b4"),
    ])
    h = H.build_history(df).orderBy(H.START).collect()
    assert [r.email for r in h] == ["A", "B", "A"]


def test_apply_batch_equals_rebuild_and_replay_adds_nothing(spark, feeds):
    df = spark.createDataFrame(feeds, SCHEMA)
    order = H.order_batches(df, "batch_id", "updated_at")
    # the last batch of every feed
    last = order.withColumn("feed", F.split("batch_id", "_")[0])
    last = last.groupBy("feed").agg(F.max_by("batch_id", F.struct(H.BATCH_TS, "batch_id")).alias("batch_id"))
    last_rows = df.join(last.select("batch_id"), "batch_id", "left_semi")
    before = H.build_history(df.join(last.select("batch_id"), "batch_id", "left_anti"))
    applied = H.apply_batch(before, last_rows)
    full = H.build_history(df)
    assert _as_set([r.asDict() for r in applied.collect()]) == _as_set([r.asDict() for r in full.collect()])
    replay = H.apply_batch(full, last_rows)
    assert _as_set([r.asDict() for r in replay.collect()]) == _as_set([r.asDict() for r in full.collect()])


def test_prepare_feed_quarantines_before_dedup(spark):
    rows = [
        {"customer_id": None, "email": " x ", "customer_name": "n", "segment": "", "city": "c",
         "region": "r", "updated_at": "2024-01-01 08:00:00", "batch_id": "b1"},
        {"customer_id": "C1", "email": " x ", "customer_name": "n", "segment": "  ", "city": "c",
         "region": "r", "updated_at": "not a time", "batch_id": "b1"},
        {"customer_id": "C1", "email": " y ", "customer_name": "n", "segment": "s", "city": "c",
         "region": "r", "updated_at": "2024-01-01 08:00:00", "batch_id": "b1"},
    ]
    df = spark.createDataFrame(rows, "customer_id string, email string, customer_name string, segment string, "
                                     "city string, region string, updated_at string, batch_id string")
    valid, bad = H.prepare_feed(df)
    assert valid.count() == 1 and valid.first().email == "y"
    reasons = sorted(r.failed_rules for r in bad.collect())
    assert reasons == ["customer_id_not_null", "updated_at_not_null"]
    assert [r.segment for r in bad.orderBy("failed_rules").collect()] == [None, None]


def test_late_batch_inverts_a_window_unless_ordered_by_event_time(spark):
    from strata.plans import suite

    d = lambda day: dt.datetime(2024, 1, day)
    # b1 sorts first (its earliest row is Z's), but K's row in b1 is newer than
    # K's row in b2: in batch order, K's first version ends before it starts
    df = _feed(spark, [
        ("Z", "x", "n", "s", "c", "r", d(1), "b1"),
        ("K", "A", "n", "s", "c", "r", d(10), "b1"),
        ("K", "B", "n", "s", "c", "r", d(5), "b2"),
    ])
    by_batch = H.build_history(df).where("customer_id = 'K'").orderBy(H.START).collect()
    inverted = [r for r in by_batch if not r[H.START] < r[H.END]]
    assert [r.email for r in inverted] == ["A"]  # as the source system does (T7)
    lay = types.SimpleNamespace(customer_history=H.build_history(df))
    assert [r.observed for r in suite.run_checks(lay, suite.GAPS).collect() if r.check_name.startswith("empty")] == [1]
    by_time = H.build_history(df, order_by="event_time").where("customer_id = 'K'").orderBy(H.START).collect()
    assert [r.email for r in by_time] == ["B", "A"]
    assert all(r[H.START] < r[H.END] for r in by_time)


def test_equal_timestamps_in_two_batches(spark):
    t = dt.datetime(2024, 1, 1)
    df = _feed(spark, [
        ("K", "A", "n", "s", "c", "r", t, "b1"),
        ("K", "B", "n", "s", "c", "r", t, "b2"),
    ])
    h = H.build_history(df).collect()
    # two versions with the same start: an empty window and a repeated version key
    assert len(h) == 2 and len({r.customer_sk for r in h}) == 1
    assert sum(r.is_current for r in h) == 1
