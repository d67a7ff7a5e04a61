"""Ordered reports: the same ranks and files however the rows are dealt."""

import datetime as dt
import glob

import pytest
from pyspark.sql import functions as F

from strata.operators import report


def table(spark):
    rows = [((k * 37) % 11 or None, f"n{k % 5}" if k % 7 else None, dt.date(2024, 1, 1 + k % 28), k) for k in range(200)]
    return spark.createDataFrame(rows * 2, "a long, b string, d date, k long")


def key(r):
    return tuple((x is not None, x if x is not None else 0) for x in (r[0], r[1], r[2], r[3]))


@pytest.mark.parametrize("ranges", [None, 1, 3, 16])
def test_ranks_do_not_depend_on_the_ranges(spark, ranges):
    got = sorted(report.ranked(table(spark).repartition(5), ["a", "b"], ranges=ranges).collect(), key=lambda r: r["rank"])
    want = sorted((tuple(r) for r in table(spark).collect()), key=key)
    assert [tuple(r)[:4] for r in got] == want and [r["rank"] for r in got] == list(range(1, 401))


def test_descending_columns_and_empty_tables(spark):
    got = sorted(report.ranked(table(spark), ["a", "k"], ["a"]).collect(), key=lambda r: r["rank"])
    assert [r["a"] for r in got] == sorted((r["a"] for r in got), key=lambda x: (x is None, -(x or 0)))
    assert report.ranked(table(spark).limit(0), ["a"]).count() == 0 and report.top(table(spark).limit(0), ["a"], 3).count() == 0


def test_top_equals_the_head_of_the_whole_order(spark):
    whole = sorted(report.ranked(table(spark), ["b", "a"], ["a"]).collect(), key=lambda r: r["rank"])[:25]
    first = report.top(table(spark), ["b", "a"], 25, ["a"])
    assert sorted(map(tuple, first.collect()), key=lambda r: r[-1]) == [tuple(r) for r in whole]
    plan = first._jdf.queryExecution().executedPlan().toString()
    assert "TakeOrderedAndProject" in plan


def test_files_follow_the_order(spark, tmp_path):
    out = str(tmp_path / "r")
    report.write_report(table(spark).repartition(7), out, ["d", "k"], ranges=4)
    lines = [line for f in sorted(glob.glob(f"{out}/part-*.csv")) for line in open(f).read().splitlines()[1:]]
    found = [(x.split(",")[2], int(x.split(",")[3])) for x in lines]
    assert len(found) == 400 and found == sorted(found) and len(glob.glob(f"{out}/part-*.csv")) == 4


def test_no_task_sorts_a_whole_report(spark):
    df = report.in_ranges(spark.range(100_000).select((F.col("id") * 7919 % 100_003).alias("x")), ["x"], ranges=8)
    held = [r["count"] for r in df.groupBy(F.spark_partition_id()).count().collect()]
    assert len(held) == 8 and max(held) < 2 * 100_000 / 8
