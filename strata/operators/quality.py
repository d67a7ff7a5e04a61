"""Data-quality checks (Q1-Q19, D5, D7, D10) evaluated by Spark, then gated.

A check is a row ``(check_name, observed, expected, passed)``:

* ``expected`` NULL  -> passes when ``observed > 0`` (evidence / not empty);
* otherwise          -> passes when ``observed == expected``.

Several checks on one table are computed by a single aggregate over that
table and turned into rows with ``stack``; a whole suite is one union of such
frames, so it runs as one Spark action and only the tiny result (one row per
check) reaches the driver, in :func:`gate`.
"""

from __future__ import annotations

from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

CHECK_COLUMNS = ["check_name", "observed", "expected", "passed"]


class ValidationFailed(AssertionError):
    """Some checks did not hold: ``rows`` are the rows of all checks, ``failing`` those of these."""

    def __init__(self, rows: list):
        self.rows = rows
        self.failing = [r for r in rows if not r["passed"]]
        super().__init__(str(self))

    def __str__(self) -> str:
        return "\n".join([f"the run is not published, {len(self.failing)} of {len(self.rows)} rules do not hold", *map(told, self.failing)])


def told(row) -> str:
    """One check row as a line of text."""
    wanted = "at least 1" if row["expected"] is None else f"{row['expected']}"
    return f"{row['check_name']} = {row['observed']} instead of {wanted}"


@dataclass
class Check:
    """A named aggregate over one table and what it should equal."""

    name: str
    observed: Column
    expected: int | None = 0


def _passed(observed: Column, expected: Column) -> Column:
    return F.when(expected.isNull(), observed > 0).otherwise(
        F.coalesce(observed == expected, F.lit(False))
    )


def finish(df: DataFrame) -> DataFrame:
    """Add ``passed`` to a (check_name, observed, expected) frame."""
    return df.select(
        F.col("check_name"),
        F.col("observed").cast("bigint").alias("observed"),
        F.col("expected").cast("bigint").alias("expected"),
    ).withColumn("passed", _passed(F.col("observed"), F.col("expected")))


def table_checks(df: DataFrame, checks: list[Check]) -> DataFrame:
    """Evaluate several checks over ``df`` in one aggregate pass."""
    agg = df.agg(*[c.observed.cast("bigint").alias(f"_m{i}") for i, c in enumerate(checks)])
    parts = []
    for i, c in enumerate(checks):
        parts += [F.lit(c.name), F.col(f"_m{i}"), F.lit(c.expected).cast("bigint")]
    return finish(agg.select(F.stack(F.lit(len(checks)), *parts)).toDF("check_name", "observed", "expected"))


def union_all(frames: list[DataFrame]) -> DataFrame:
    return reduce(lambda a, b: a.unionByName(b), frames)


# --------------------------------------------------------------------------
# Q6: the other rules are metrics of the suite (strata.plans.suite)
def expect_versions(history: DataFrame, key: str, expected: dict[str, int]) -> DataFrame:
    """Q6: number of versions of named keys (one filtered pass)."""
    return table_checks(
        history,
        [Check(f"versions of {k}", F.count_if(F.col(key) == k), n) for k, n in expected.items()],
    )


# --------------------------------------------------------------------------
# Run log
RUN_LOG_SCHEMA = "run_timestamp timestamp, table_name string, row_count bigint"


def current_counts(spark: SparkSession, tables: dict[str, DataFrame], run_ts: Column | None = None) -> DataFrame:
    """One row per tracked table: (run_timestamp, table_name, row_count)."""
    run_ts = run_ts if run_ts is not None else F.current_timestamp()
    return union_all(
        [df.agg(F.count(F.lit(1)).alias("row_count")).select(F.lit(n).alias("table_name"), "row_count")
         for n, df in tables.items()]
    ).select(run_ts.cast("timestamp").alias("run_timestamp"), "table_name", "row_count")


def known_counts(spark: SparkSession, counts: dict[str, int], run_ts: Column) -> DataFrame:
    """The same rows from counts that the writes have reported."""
    frame = spark.createDataFrame(list(counts.items()), "table_name string, row_count bigint")
    return frame.select(run_ts.cast("timestamp").alias("run_timestamp"), "table_name", "row_count")


def latest_run(log: DataFrame) -> DataFrame:
    """A10: rows of the most recent run (scalar subquery on max(run_timestamp))."""
    return log.where(F.col("run_timestamp") == log.select(F.max("run_timestamp")).scalar())


def run_stability(log: DataFrame, counts: DataFrame) -> DataFrame:
    """Q17: current counts equal the previous run's; no previous run -> no rows
    (the check is skipped, not failed)."""
    prev = latest_run(log).select("table_name", F.col("row_count").alias("expected"))
    return finish(
        counts.join(prev, "table_name").select(
            F.concat(F.lit("same row count as the last run: "), F.col("table_name")).alias("check_name"),
            F.col("row_count").alias("observed"),
            "expected",
        )
    )


# --------------------------------------------------------------------------
# Q19: gate
def summary(results: DataFrame) -> DataFrame:
    """Passed / total over a result frame."""
    return results.agg(
        F.count(F.lit(1)).alias("total"),
        F.count_if(F.col("passed")).alias("passed"),
        F.count_if(~F.col("passed")).alias("failed"),
    )


def gate(results: DataFrame) -> list:
    """Q19: the rows of all checks (one each, whatever the size of the data), or :class:`ValidationFailed`."""
    rows = results.collect()
    if all(r["passed"] for r in rows):
        return rows
    raise ValidationFailed(rows)


# --------------------------------------------------------------------------
# One pass per table: named metrics -> checks
def metrics(df: DataFrame, prefix: str, named: dict[str, Column]) -> DataFrame:
    """One aggregate over ``df`` -> rows ``(metric, value)`` named ``prefix.name``."""
    agg = df.agg(*[c.cast("bigint").alias(f"_m{i}") for i, c in enumerate(named.values())])
    parts = []
    for i, name in enumerate(named):
        parts += [F.lit(f"{prefix}.{name}"), F.col(f"_m{i}")]
    return agg.select(F.stack(F.lit(len(named)), *parts)).toDF("metric", "value")


@dataclass
class MetricCheck:
    """``observed`` is a metric name; ``expected`` an int, None (> 0) or a metric name."""

    name: str
    observed: str
    expected: int | str | None = 0


def checks_from_metrics(metric_rows: DataFrame, checks: list[MetricCheck]) -> DataFrame:
    """Pivot the metric rows into one row (a single tiny aggregate) and stack
    the checks out of it."""
    needed = sorted({c.observed for c in checks} | {c.expected for c in checks if isinstance(c.expected, str)})
    alias = {m: f"_v{i}" for i, m in enumerate(needed)}
    wide = metric_rows.agg(*[F.max(F.when(F.col("metric") == m, F.col("value"))).alias(a) for m, a in alias.items()])
    parts = []
    for c in checks:
        exp = F.col(alias[c.expected]) if isinstance(c.expected, str) else F.lit(c.expected).cast("bigint")
        parts += [F.lit(c.name), F.col(alias[c.observed]), exp]
    return finish(wide.select(F.stack(F.lit(len(checks)), *parts)).toDF("check_name", "observed", "expected"))
