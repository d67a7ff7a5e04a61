"""Metadata-driven ingestion (I1-I9) as DataFrame operators.

The control table has one row per source entity.  Incremental entities copy
the half-open watermark range ``(last, high]``; full entities copy a snapshot.
The mark advances only after the copy has landed and only when the source had
a (non-NULL) high watermark, so an empty source or a failed copy never loses
progress.  MERGE is replaced by a full outer join that keeps progress.
"""

from __future__ import annotations

import datetime as dt
import re

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import (
    BooleanType,
    DataType,
    DateType,
    StringType,
    StructField,
    StructType,
    TimestampNTZType,
    TimestampType,
)

from strata.sources.ledger import Ledger

CONTROL_SCHEMA = StructType(
    [
        StructField("entity_name", StringType(), False),
        StructField("source_schema", StringType(), False),
        StructField("source_table", StringType(), False),
        StructField("load_type", StringType(), False),
        StructField("watermark_column", StringType(), True),
        StructField("target_path", StringType(), False),
        StructField("file_format", StringType(), False),
        StructField("is_active", BooleanType(), False),
        StructField("last_watermark_value", TimestampNTZType(), True),
        StructField("last_successful_load", TimestampNTZType(), True),
    ]
)
METADATA_COLUMNS = [
    "source_schema", "source_table", "load_type", "watermark_column",
    "target_path", "file_format", "is_active",
]
PROGRESS_COLUMNS = ["last_watermark_value", "last_successful_load"]
ACTIVE_COLUMNS = [
    "entity_name", "source_schema", "source_table", "load_type",
    "watermark_column", "target_path", "last_watermark_value",
]

# Accepted load types, the default lower bound of a first
# incremental copy, and the name pattern of a time-like column.
LOAD_TYPES = ["full", "incremental"]
FIRST_WATERMARK = "1900-01-01 00:00:00"
TIME_LIKE = re.compile(r"(_at|_timestamp)$")

# The six retail entities mapped onto the benchmark source tables.
DEFAULT_SEED = [
    ("customers", "tpch", "customer", "full", None, "retail/customers", "parquet", True),
    ("products", "tpch", "part", "full", None, "retail/products", "parquet", True),
    ("warehouses", "tpch", "supplier", "full", None, "retail/warehouses", "parquet", True),
    ("orders", "tpch", "orders", "incremental", "o_orderdate", "retail/orders", "parquet", True),
    ("order_items", "tpch", "lineitem", "incremental", "l_shipdate", "retail/order_items", "parquet", True),
    ("inventory_events", "tpch", "events", "incremental", "ts", "retail/inventory_events", "parquet", True),
]


def seed_frame(spark: SparkSession, rows: list[tuple] = DEFAULT_SEED) -> DataFrame:
    """Seed rows (8 metadata columns) as a DataFrame with NULL progress."""
    return spark.createDataFrame([(*r, None, None) for r in rows], CONTROL_SCHEMA)


def active_entities(control: DataFrame) -> DataFrame:
    """Active rows, the seven columns the copy needs."""
    return control.where(F.col("is_active")).select(*ACTIVE_COLUMNS)


def high_watermark(source: DataFrame, column: str) -> DataFrame:
    """One row with ``MAX(column)`` at microsecond precision (NULL if empty)."""
    return source.agg(F.max(F.col(column)).cast("timestamp_ntz").alias("high_watermark"))


def incremental_slice(
    source: DataFrame,
    column: str,
    last: str | dt.datetime | Column | None,
    high: str | dt.datetime | Column | None,
    lookback: str | None = None,
) -> DataFrame:
    """Rows with ``last < wm <= high``; NULL ``last`` means the first run.

    With literal bounds the predicate is pushed into the Parquet scan.  A NULL
    watermark value never qualifies; a NULL ``high`` (empty source) selects
    nothing.  ``lookback`` (e.g. ``'2 days'``) re-reads a margin below the
    mark to pick up rows committed late with an older watermark value (trap
    T9); the copy is then at-least-once and Silver dedup removes the repeats.
    """
    lo = last if isinstance(last, Column) else F.lit(last)
    hi = high if isinstance(high, Column) else F.lit(high)
    lo = F.coalesce(lo.cast("timestamp_ntz"), F.lit(FIRST_WATERMARK).cast("timestamp_ntz"))
    if lookback:
        lo = lo - F.expr(f"INTERVAL {lookback}")
    wm = F.col(column)
    return source.where((wm > lo) & (wm <= hi.cast("timestamp_ntz")))


def full_snapshot(source: DataFrame) -> DataFrame:
    """I4: the whole table; no watermark is read or changed."""
    return source


def route_by_load_type(
    entity: dict, source: DataFrame, high: str | Column | None = None
) -> tuple[DataFrame, bool]:
    """Incremental -> slice (I2+I3), anything else -> snapshot (I4).

    Returns the rows to land and whether the watermark should be advanced.
    """
    if entity["load_type"] == "incremental":
        column = entity["watermark_column"]
        if high is None:
            high = high_watermark(source, column).scalar()
        return incremental_slice(source, column, entity.get("last_watermark_value"), high), True
    return full_snapshot(source), False


def land_partitioned(df: DataFrame, target: str, load_date: str | Column, run_id: str | None = None) -> None:
    """Snappy Parquet under ``<target>/load_date=<d>/run_id=<r>/``, entered in the landing's ledger.

    Re-landing a run replaces only itself: a date landed without ``run_id`` is
    idempotent, other dates and other runs of the date are untouched.  A second
    run on one date gets a folder and a batch of its own: its slice begins
    where the first ended.
    """
    Ledger(df.sparkSession, target).land(df, load_date, run_id)


def advance_watermark(control: DataFrame, highs: DataFrame, run_ts: str | Column) -> DataFrame:
    """New control rows after a run.

    ``highs`` has ``(entity_name, high_watermark, copy_succeeded)`` for the
    incremental entities that were copied.  The mark moves to ``high`` and
    ``last_successful_load`` to ``run_ts`` only when the copy succeeded and
    ``high`` is not NULL; every other row is unchanged.
    """
    ts = run_ts if isinstance(run_ts, Column) else F.lit(run_ts)
    h = highs.select(
        F.col("entity_name").alias("_e"),
        F.col("high_watermark").cast("timestamp_ntz").alias("_high"),
        F.col("copy_succeeded").alias("_ok"),
    )
    advance = F.coalesce(F.col("_ok"), F.lit(False)) & F.col("_high").isNotNull()
    return control.join(h, F.col("entity_name") == F.col("_e"), "left").select(
        *[c for c in control.columns if c not in PROGRESS_COLUMNS],
        F.when(advance, F.col("_high")).otherwise(F.col("last_watermark_value")).alias("last_watermark_value"),
        F.when(advance, ts.cast("timestamp_ntz")).otherwise(F.col("last_successful_load")).alias("last_successful_load"),
    )


def upsert_control(existing: DataFrame, seed: DataFrame) -> DataFrame:
    """I8: seed MERGE without a MERGE-capable table.

    matched -> metadata from the seed, progress kept; seed-only -> inserted
    with NULL progress; existing-only -> unchanged.  Re-seeding never rewinds.
    """
    e = existing.alias("e")
    s = seed.alias("s")
    joined = e.join(s, F.col("e.entity_name") == F.col("s.entity_name"), "full_outer")
    in_seed = F.col("s.entity_name").isNotNull()
    return joined.select(
        F.coalesce(F.col("s.entity_name"), F.col("e.entity_name")).alias("entity_name"),
        *[F.when(in_seed, F.col(f"s.{c}")).otherwise(F.col(f"e.{c}")).alias(c) for c in METADATA_COLUMNS],
        *[F.col(f"e.{c}").alias(c) for c in PROGRESS_COLUMNS],
    )


def _time_like(name: str, dtype: DataType) -> bool:
    return bool(TIME_LIKE.search(name)) or isinstance(dtype, (TimestampType, TimestampNTZType, DateType))


def source_columns(spark: SparkSession, tables: dict[str, DataFrame]) -> DataFrame:
    """Schema catalogue ``(source_table, column_name, is_time_like)`` of sources.

    Built from the DataFrame schemas (metadata only, nothing is scanned).
    """
    rows = [
        (t, f.name, _time_like(f.name, f.dataType))
        for t, df in tables.items()
        for f in df.schema.fields
    ]
    return spark.createDataFrame(rows, "source_table string, column_name string, is_time_like boolean")


def validate_control(control: DataFrame, columns: DataFrame) -> DataFrame:
    """One row per violation ``(entity_name, violation)``.

    unique entity; load_type accepted; incremental -> watermark column set
    and present in the source; full -> no watermark column and no time-like
    column in the source that could serve as one.
    """
    dup = (
        control.groupBy("entity_name").agg(F.count(F.lit(1)).alias("n")).where(F.col("n") > 1)
        .select("entity_name", F.lit("duplicate entity_name").alias("violation"))
    )
    bad_type = control.where(~F.coalesce(F.col("load_type").isin(LOAD_TYPES), F.lit(False))).select(
        "entity_name", F.concat(F.lit("unknown load_type "), F.coalesce(F.col("load_type"), F.lit("NULL"))).alias("violation")
    )
    inc = control.where(F.col("load_type") == "incremental")
    no_wm = inc.where(F.col("watermark_column").isNull()).select(
        "entity_name", F.lit("incremental load without watermark_column").alias("violation")
    )
    cols = columns.select(
        F.col("source_table").alias("_t"), F.col("column_name").alias("_c"), F.col("is_time_like")
    )
    missing = (
        inc.where(F.col("watermark_column").isNotNull())
        .join(cols, (F.col("source_table") == F.col("_t")) & (F.col("watermark_column") == F.col("_c")), "left_anti")
        .select("entity_name", F.concat(F.lit("watermark_column not in source: "), F.col("watermark_column")).alias("violation"))
    )
    full = control.where(F.col("load_type") == "full")
    full_wm = full.where(F.col("watermark_column").isNotNull()).select(
        "entity_name", F.lit("full load declares a watermark_column").alias("violation")
    )
    full_time = (
        full.join(cols.where(F.col("is_time_like")), F.col("source_table") == F.col("_t"), "inner")
        .groupBy("entity_name")
        .agg(F.concat_ws(",", F.array_sort(F.collect_set("_c"))).alias("_cols"))
        .select("entity_name", F.concat(F.lit("full load but source has time column(s): "), F.col("_cols")).alias("violation"))
    )
    return dup.unionByName(bad_type).unionByName(no_wm).unionByName(missing).unionByName(full_wm).unionByName(full_time)


def run_ingestion(
    spark: SparkSession,
    control: DataFrame,
    sources: dict[str, DataFrame],
    landing_root: str,
    load_date: str,
    run_ts: str | dt.datetime,
) -> tuple[DataFrame, list[dict]]:
    """I1-I7 as one run: copy every active entity, then advance the marks.

    The loop is over control rows (one per entity, collected from the tiny
    control table); each copy is a distributed Spark job.  For an incremental
    entity the high watermark is read first (one tiny aggregate), so the slice
    has literal bounds that are pushed into the source scan.  A copy that
    fails is reported and keeps its mark; the others still run.  Returns the
    new control table and one report row per entity.
    """
    report = []
    highs = []
    run_id = "r" + re.sub(r"\D", "", str(run_ts))
    for row in active_entities(control).collect():
        entity = row.asDict()
        source = sources[entity["source_table"]]
        target = f"{landing_root.rstrip('/')}/{entity['target_path']}"
        high = None
        try:
            if entity["load_type"] == "incremental":
                high = high_watermark(source, entity["watermark_column"]).first()["high_watermark"]
            rows, advance = route_by_load_type(entity, source, high)
            # a snapshot replaces its date; a slice is kept beside earlier slices of the date
            land_partitioned(rows, target, load_date, run_id=run_id if advance else None)
            ok, error = True, None
        except Exception as exc:  # noqa: BLE001 - one failed copy must not stop the others
            advance, ok, error = entity["load_type"] == "incremental", False, f"{type(exc).__name__}: {exc}"
        if advance:
            highs.append((entity["entity_name"], high, ok))
        report.append({"entity_name": entity["entity_name"], "succeeded": ok, "high_watermark": high, "error": error})
    highs_df = spark.createDataFrame(
        highs, "entity_name string, high_watermark timestamp_ntz, copy_succeeded boolean"
    )
    ts = run_ts if isinstance(run_ts, str) else F.lit(run_ts)
    return advance_watermark(control, highs_df, ts), report
