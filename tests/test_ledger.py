"""The landing's ledger: runs are told apart, retried alone, and read without opening a footer."""

import os

import pytest
from pyspark.sql import functions as F

from strata.operators.ingest import land_partitioned
from strata.sources import files
from strata.sources.ledger import FOLDER, Ledger, SchemaConflict, read_parts
from strata.sources.store import Overtaken


def frame(spark, ids, schema="id int", **more):
    df = spark.createDataFrame([(k,) for k in ids], schema)
    return df.withColumns({k: F.lit(v) for k, v in more.items()}) if more else df


def landed(spark, root):
    return sorted((r.id, r.batch_id) for r in files.read_partitions(spark, root).collect())


def test_runs_of_a_date_and_retries(spark, tmp_path):
    root = str(tmp_path)
    land_partitioned(frame(spark, [1]), root, "2024-01-01")
    land_partitioned(frame(spark, [2]), root, "2024-01-01", "r1")
    land_partitioned(frame(spark, [3]), root, "2024-01-01", "r2")
    land_partitioned(frame(spark, [4]), root, "2024-01-02", "007")  # digits stay a name
    every = [(1, "load_date=2024-01-01"), (2, "load_date=2024-01-01/run_id=r1"), (3, "load_date=2024-01-01/run_id=r2"), (4, "load_date=2024-01-02/run_id=007")]
    assert landed(spark, root) == every
    for ids in ([20, 21], [2]):  # a retry replaces its run alone
        land_partitioned(frame(spark, ids), root, "2024-01-01", "r1")
        assert landed(spark, root) == sorted([*every[:1], *every[2:], *((k, every[1][1]) for k in ids)])
    land_partitioned(frame(spark, []), root, "2024-01-01", "r2")  # tried again, and there was nothing
    assert landed(spark, root) == [*every[:2], every[3]]
    land_partitioned(frame(spark, [9]), root, "2024-01-01")
    assert landed(spark, root) == [*every[1:2], every[3], (9, "load_date=2024-01-01")]
    assert [p.batch for p in Ledger(spark, root).parts()] == ["load_date=2024-01-02/run_id=007", "load_date=2024-01-01/run_id=r1", "load_date=2024-01-01"]
    with pytest.raises(ValueError, match="run id"):
        land_partitioned(frame(spark, [1]), root, "2024-01-01", "a/b")
    with pytest.raises(Overtaken):
        Ledger(spark, root).enter(1, [])


def test_several_dates_in_one_run(spark, tmp_path):
    root, date = str(tmp_path), F.make_date(F.lit(2024), F.lit(1), F.col("id"))
    land_partitioned(frame(spark, [1, 2]), root, date, "a")
    land_partitioned(frame(spark, [2, 3]), root, date, "b")
    land_partitioned(frame(spark, [2]), root, date, "a")  # the retry has one date less
    assert landed(spark, root) == [(2, "load_date=2024-01-02/run_id=a"), (2, "load_date=2024-01-02/run_id=b"), (3, "load_date=2024-01-03/run_id=b")]
    land_partitioned(frame(spark, [5]), root, date)
    land_partitioned(frame(spark, [6]), root, date)  # runs without a name have a date each
    assert landed(spark, root)[3:] == [(5, "load_date=2024-01-05"), (6, "load_date=2024-01-06")]


@pytest.mark.parametrize("adopted", [False, True])
def test_landings_from_before_the_ledger(spark, tmp_path, adopted):
    root = str(tmp_path)
    frame(spark, [1]).write.parquet(f"{root}/load_date=2024-01-01")
    frame(spark, [2], x="new").write.parquet(f"{root}/load_date=2024-01-01/run_id=r1")
    frame(spark, [3]).write.parquet(f"{root}/load_date=2024-01-02/run_id=r2")
    if adopted:
        Ledger(spark, root).adopt()
    assert landed(spark, root) == [(1, "load_date=2024-01-01"), (2, "load_date=2024-01-01/run_id=r1"), (3, "load_date=2024-01-02/run_id=r2")]
    assert {r.id: r.x for r in files.read_partitions(spark, root).collect()} == {1: None, 2: "new", 3: None}
    land_partitioned(frame(spark, [4]), root, "2024-01-02", "r2")
    land_partitioned(frame(spark, [5]), root, "2024-01-01")  # takes the place of the files without a run
    assert landed(spark, root) == [(2, "load_date=2024-01-01/run_id=r1"), (4, "load_date=2024-01-02/run_id=r2"), (5, "load_date=2024-01-01")]


def test_a_run_that_died_is_not_seen(spark, tmp_path, monkeypatch):
    root = str(tmp_path)
    land_partitioned(frame(spark, [1]), root, "2024-01-01", "r1")
    with monkeypatch.context() as m:
        m.setattr(Ledger, "enter", lambda *a: 1 / 0)
        for run in ("r1", "r2"):
            with pytest.raises(ZeroDivisionError):
                land_partitioned(frame(spark, [7, 8]), root, "2024-01-01", run)
    assert landed(spark, root) == [(1, "load_date=2024-01-01/run_id=r1")]
    land_partitioned(frame(spark, [2]), root, "2024-01-01", "r2")
    assert [x[0] for x in landed(spark, root)] == [1, 2]


def test_schema_comes_from_the_ledger(spark, tmp_path):
    root = str(tmp_path)
    land_partitioned(frame(spark, [1]), root, "2024-01-01")
    land_partitioned(frame(spark, [2], x="a", y=2.5), root, "2024-01-02")
    land_partitioned(frame(spark, [3], y=3.5), root, "2024-01-03", "late")
    # no footer is opened to plan the read: the files may even be unreadable
    data = [os.path.join(d, f) for d, _, names in os.walk(root) for f in names if f.endswith(".parquet")]
    kept = {f: open(f, "rb").read() for f in data}
    for f in data:
        open(f, "wb").write(b"")
        os.remove(os.path.join(os.path.dirname(f), f".{os.path.basename(f)}.crc"))
    df = files.read_partitions(spark, root)
    assert df.columns == ["id", "x", "y", "load_date", "batch_id", "source_file"] and df.schema["y"].dataType.simpleString() == "double"
    for f, content in kept.items():
        open(f, "wb").write(content)
    assert sorted((r.id, r.x, r.y) for r in files.read_partitions(spark, root).collect()) == [(1, None, None), (2, "a", 2.5), (3, None, 3.5)]
    # a filter on the date reads its folder alone
    plan = files.read_partitions(spark, root).where("load_date = DATE'2024-01-02'")
    assert len(plan.inputFiles()) >= 1 and [r.id for r in plan.collect()] == [2]
    assert "PartitionFilters: [isnotnull(load_date" in plan._jdf.queryExecution().executedPlan().toString()
    land_partitioned(frame(spark, [4], x=1), root, "2024-01-04")
    with pytest.raises(SchemaConflict, match="column x is string in load_date=2024-01-02 and int in load_date=2024-01-04"):
        files.read_partitions(spark, root)
    parts = [p for p in Ledger(spark, root).parts() if p.load_date < "2024-01-04"]
    assert read_parts(spark, root, parts).count() == 3


def test_snapshots_take_the_last_run_of_the_last_date(spark, tmp_path):
    root = str(tmp_path)
    land_partitioned(frame(spark, [1], old=1), root, "2024-01-01")
    land_partitioned(frame(spark, [2]), root, "2024-01-02", "z")
    land_partitioned(frame(spark, [3]), root, "2024-01-02", "a")
    land_partitioned(frame(spark, [4], old=1), root, "2024-01-01", "again")
    snapshot = files.read_latest_snapshot(spark, root)
    assert "old" not in snapshot.columns and [(r.id, r.batch_id) for r in snapshot.collect()] == [(3, "load_date=2024-01-02/run_id=a")]
    assert os.path.isdir(f"{root}/{FOLDER}")
    with pytest.raises(FileNotFoundError):
        files.read_partitions(spark, f"{root}/none")
