"""The history stream over a landing's runs: equal to a rebuild, and only where something changed is written."""

import datetime as dt
import os
import random

import pytest

from conftest import FIXTURE_LANDING
from strata.operators import history as H
from strata.operators.ingest import land_partitioned
from strata.sources import files
from strata.sources.ledger import Ledger
from strata.streaming import latest_history, start_history_stream
from strata.streaming.store import HistoryStore

COLS = ["customer_id", "email", "customer_name", "segment", "city", "region", "updated_at"]


def rows_of(df):
    return sorted((tuple(r[c] for c in sorted(df.columns)) for r in df.collect()), key=repr)


class Lake:
    """A landing, its history, and the rebuild to hold it against."""

    def __init__(self, spark, tmp_path, **kw):
        self.spark, self.kw = spark, kw
        self.landing, self.history, self.checkpoint = (str(tmp_path / x) for x in ("landing", "history", "checkpoint"))

    def land(self, date, run, rows):
        df = self.spark.createDataFrame([(k, m, "n", "s", "c", "r", at) for k, m, at in rows], ", ".join(f"{c} string" for c in COLS))
        land_partitioned(df, self.landing, date, run)

    def stream(self):
        start_history_stream(self.spark, self.landing, self.history, self.checkpoint, **self.kw).awaitTermination()

    def current(self):
        return latest_history(self.spark, self.history, **self.kw)

    def holds(self):
        valid, _ = H.prepare_feed(files.read_partitions(self.spark, self.landing))
        assert rows_of(self.current()) == rows_of(H.build_history(valid))


def test_stream_applies_each_landing_once(spark, tmp_path):
    lake = Lake(spark, tmp_path)
    for k, (batch, date) in enumerate((("batch_1", "2024-01-01"), ("batch_2", "2024-02-01"))):
        df = files.read_csv_batches(spark, FIXTURE_LANDING, [batch], "customers", COLS).select(*COLS)
        land_partitioned(df, lake.landing, date)
        lake.stream()
        lake.holds()
        assert HistoryStore(spark, lake.history).epoch == k
    got = lake.current().collect()
    assert len(got) == 8 and sum(r.is_current for r in got) == 6
    c1 = sorted((r for r in got if r.customer_id == "C001"), key=lambda r: r[H.START])
    assert c1[0][H.END] == dt.datetime(2024, 2, 1, 9)
    lake.stream()  # nothing new has landed
    assert HistoryStore(spark, lake.history).epoch == 1


def test_a_late_run_on_a_date_that_was_applied(spark, tmp_path):
    lake = Lake(spark, tmp_path)
    for date, run, rows in (
        ("2024-01-01", "r1", [("k", "a", "2024-01-01 10:00:00")]),
        ("2024-01-02", "r1", [("k", "c", "2024-01-02 10:00:00")]),
        ("2024-01-01", "r2", [("k", "b", "2024-01-01 09:00:00")]),
    ):
        lake.land(date, run, rows)
        lake.stream()
        lake.holds()
    assert sorted(r.email for r in lake.current().collect()) == ["a", "b", "c"]


def test_two_runs_on_one_date_in_one_epoch(spark, tmp_path):
    lake = Lake(spark, tmp_path)
    lake.land("2024-01-01", "r1", [("k", "a", "2024-01-01 10:00:00"), (None, "x", "2024-01-01 10:00:00")])
    lake.land("2024-01-01", "r2", [("k", "b", "2024-01-01 11:00:00")])
    lake.stream()
    lake.holds()
    assert lake.current().count() == 2 and spark.read.parquet(f"{lake.history}-quarantine").count() == 1


@pytest.mark.parametrize("seed", range(3))
def test_random_runs_equal_a_rebuild(spark, tmp_path, seed):
    rng, lake = random.Random(seed), Lake(spark, tmp_path, buckets=4)
    for step in range(5):
        for _ in range(rng.randint(1, 2)):
            day, run = rng.randint(1, 4), rng.choice([None, "a", "b"])  # now and then a run that was landed before
            lake.land(f"2024-01-{day:02d}", run, [(f"k{rng.randint(0, 5)}", rng.choice("xyz"), f"2024-01-{day:02d} {rng.randint(0, 23):02d}:00:00") for _ in range(rng.randint(0, 5))])
        lake.stream()
        if Ledger(spark, lake.landing).parts():
            lake.holds()


def folders(root, kind):
    return {os.path.relpath(d, root) for d, _, names in os.walk(f"{root}/{kind}") if any(n.endswith(".parquet") for n in names)}


def test_one_changed_customer_rewrites_one_bucket(spark, tmp_path):
    lake = Lake(spark, tmp_path, buckets=16)
    lake.land("2024-01-01", "r1", [(f"k{n}", "a", "2024-01-01 10:00:00") for n in range(200)])
    lake.stream()
    first = HistoryStore(spark, lake.history, buckets=16)
    assert len(first.paths("current")) == 16 and not first.paths("closed")
    # no data of the landing or of another bucket is read from now on: both may be unreadable
    bucket = spark.createDataFrame([("k7",)], "customer_id string").select(first._bucket()).first()[0]
    spoiled = {}
    for top in (lake.landing, lake.history):
        for d, _, names in os.walk(top):
            for n in names:
                if n.endswith(".parquet") and "/batches/" not in d and not d.endswith(f"bucket={bucket}"):
                    spoiled[f"{d}/{n}"] = open(f"{d}/{n}", "rb").read()
                    open(f"{d}/{n}", "wb").write(b"not to be read")
    kept = os.path.join(tmp_path, "crc")
    os.mkdir(kept)
    for f in spoiled:
        crc = os.path.join(os.path.dirname(f), f".{os.path.basename(f)}.crc")
        if os.path.exists(crc):
            os.remove(crc)
    before = folders(lake.history, "versions"), folders(lake.history, "feed")
    lake.land("2024-01-03", "r1", [("k7", "b", "2024-01-03 10:00:00")])
    lake.stream()
    wrote = folders(lake.history, "versions") - before[0], folders(lake.history, "feed") - before[1]
    assert [len(x) for x in wrote] == [2, 1] and all(x.endswith(f"bucket={bucket}") for w in wrote for x in w)  # current and closed; feed
    lake.land("2024-01-02", "r1", [("k7", "late", "2024-01-02 10:00:00")])  # late: its bucket is built anew
    lake.stream()
    now = HistoryStore(spark, lake.history, buckets=16)
    same = [b for b in range(16) if b != bucket]
    assert now.paths("current", same) == first.paths("current", same) and len(now.paths("closed")) == 1
    for f, data in spoiled.items():
        if os.path.exists(f):
            open(f, "wb").write(data)
    lake.holds()
    assert [r.email for r in lake.current().where("customer_id = 'k7'").orderBy(H.START).collect()] == ["a", "late", "b"]


def test_folders_are_merged_and_old_epochs_pruned(spark, tmp_path):
    root, schema = str(tmp_path / "h"), f"customer_id string, email string, customer_name string, segment string, city string, region string, updated_at timestamp_ntz, batch_id string"
    every = None
    for k in range(7):
        df = spark.createDataFrame([("k", f"m{k}", "n", "s", "c", "r", dt.datetime(2024, 1, 1 + k), f"b{k}")], schema)
        every = df if every is None else every.unionByName(df)
        store = HistoryStore(spark, root, buckets=2, folders=3)
        store.apply(df, k)
        store.apply(df, k)  # a replay of the epoch
        assert rows_of(HistoryStore(spark, root, buckets=2).history()) == rows_of(H.build_history(every))
        assert max(map(len, [*store.state["feed"].values(), *store.state["closed"].values()])) <= 3
    assert len(store.files.numbers("_versions")) == 2 and len(folders(root, "versions")) <= 10
    with pytest.raises(RuntimeError, match="later than this stream"):
        store.apply(df, 2)
    with pytest.raises(ValueError, match="buckets"):
        HistoryStore(spark, root, buckets=5)


def test_an_epoch_that_dies_is_not_seen(spark, tmp_path, monkeypatch):
    lake = Lake(spark, tmp_path)
    lake.land("2024-01-01", "r1", [("k", "a", "2024-01-01 10:00:00")])
    lake.stream()
    before = rows_of(lake.current())
    lake.land("2024-01-02", "r1", [("k", "b", "2024-01-02 10:00:00")])
    with monkeypatch.context() as m:
        m.setattr("strata.streaming.store.Store.publish", lambda *a: 1 / 0)
        with pytest.raises(Exception):
            lake.stream()
    assert rows_of(lake.current()) == before
    lake.stream()  # the same epoch again
    lake.holds()
    assert HistoryStore(spark, lake.history).epoch == 1
