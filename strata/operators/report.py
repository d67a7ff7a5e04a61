"""O1: ordered reports that no single task sorts.

A table is in order when its rows are dealt by ranges of the sorting columns and each range is sorted. What comes
before a range is known from the counts of the ranges, one small number each; so a row's rank is its place in its
range and that sum, and nothing is shuffled again. Files written from the ranges follow the order by their names.
Ties are broken by the other columns, so that a report does not depend on how the rows were dealt.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from strata.session import ensure_checkpoint_dir

_RANGE_BITS = 33  # rows of a range that Spark's row numbers hold


def _order(df: DataFrame, order: list[str], descending: list[str]) -> list:
    rest = [c for c in df.columns if c not in order]
    return [F.desc_nulls_last(c) if c in descending else F.asc_nulls_first(c) for c in [*order, *rest]]


def in_ranges(df: DataFrame, order: list[str], descending: list[str] = (), ranges: int | None = None) -> DataFrame:
    """``df`` in global order: ranges of the sorting columns, each sorted."""
    keys = _order(df, order, list(descending))
    dealt = df.repartitionByRange(ranges, *keys) if ranges else df.repartitionByRange(*keys)
    return dealt.sortWithinPartitions(*keys)


def ranked(df: DataFrame, order: list[str], descending: list[str] = (), rank: str = "rank", ranges: int | None = None) -> DataFrame:
    """``df`` with the place of each row (from 1) in the global order.

    The sorted rows are kept once in the shared checkpoint folder; the counts
    of the ranges and the result are read from there.
    """
    ensure_checkpoint_dir(df.sparkSession)
    numbered = in_ranges(df, order, descending, ranges).withColumn("_at", F.monotonically_increasing_id()).checkpoint()
    numbered = numbered.withColumn("_range", F.shiftright("_at", _RANGE_BITS))
    counts = numbered.groupBy("_range").agg(F.count(F.lit(1)).alias("_held"))
    # one row per range
    earlier = Window.orderBy("_range").rowsBetween(Window.unboundedPreceding, -1)
    before = counts.select("_range", F.coalesce(F.sum("_held").over(earlier), F.lit(0)).alias("_before"))
    place = F.col("_before") + F.col("_at").bitwiseAND(F.lit((1 << _RANGE_BITS) - 1)) + 1
    return numbered.join(before, "_range").select(*df.columns, place.alias(rank))


def top(df: DataFrame, order: list[str], n: int, descending: list[str] = (), rank: str = "rank") -> DataFrame:
    """The first ``n`` rows of the order with their places: each task sends its first ``n``, nothing is sorted whole."""
    keys = _order(df, order, list(descending))
    return df.orderBy(*keys).limit(n).withColumn(rank, F.row_number().over(Window.orderBy(*keys)).cast("long"))


def write_report(df: DataFrame, path: str, order: list[str], descending: list[str] = (), ranges: int | None = None, header: bool = True) -> None:
    """A report as CSV files whose names follow the order of their rows."""
    in_ranges(df, order, descending, ranges).write.mode("overwrite").option("header", header).csv(path)
