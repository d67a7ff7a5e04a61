"""Landing the stand-in sources as files (CSV batches, Parquet load dates).

Written under the shared checkpoint folder (``spark.checkpoint.dir``), one
fresh folder per call, then read back by the Bronze readers.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from strata.operators.ingest import land_partitioned
from strata.plans import standins
from strata.session import scratch_path

# Batch of each raw entity when it is landed as CSV.
CSV_BATCH = {
    "customers": F.col("batch_id"),
    "orders": F.year("order_timestamp").cast("string"),
    "order_items": F.year("updated_at").cast("string"),
    "inventory_events": F.to_date("event_timestamp").cast("string"),
    "products": F.lit("snapshot"),
    "warehouses": F.lit("snapshot"),
}


def land_csv_entities(spark: SparkSession, sf_dir: str) -> tuple[str, dict[str, list[str]]]:
    """Write every raw entity as header CSV under ``<root>/<entity>/batch_id=<b>/``.

    Returns the root and the data columns of each entity.
    """
    root = scratch_path(spark, "landing-csv")
    columns = {}
    for entity, build in standins.RAW_BUILDERS.items():
        raw = build(spark, sf_dir)
        data_cols = [c for c in raw.columns if c != "batch_id"]
        columns[entity] = data_cols
        (
            raw.select(*data_cols, CSV_BATCH[entity].alias("batch_id"))
            .write.mode("overwrite")
            .option("header", True)
            .partitionBy("batch_id")
            .csv(f"{root}/{entity}")
        )
    return root, columns


# A landing as a source system may send it: order headers per year in <root>/<batch>/orders.csv, some lines of
# which are short, long or badly quoted, and one year whose columns come in another order.
FAULTY_COLUMNS = ["order_id", "customer_id", "status", "note"]
SWAPPED_COLUMNS = ["customer_id", "order_id", "status", "note"]
SWAPPED_YEAR = "1997"
SHORT, LONG, QUOTED = (97, 0), (89, 1), (83, 2)  # divisor and remainder of the order's key


def land_faulty_csv(spark: SparkSession, sf_dir: str) -> tuple[str, list[str]]:
    """The root and the batches of that landing; every order is in one line of it."""
    root = scratch_path(spark, "landing-faulty")
    orders = standins.table(spark, sf_dir, "orders")
    batch = F.coalesce(F.year("o_orderdate").cast("string"), F.lit("undated"))
    fault = {k: F.col("o_orderkey") % d == r for k, (d, r) in {"short": SHORT, "long": LONG, "quoted": QUOTED}.items()}
    first = F.when(batch == SWAPPED_YEAR, F.concat_ws(",", "o_custkey", "o_orderkey")).otherwise(F.concat_ws(",", "o_orderkey", "o_custkey"))
    note = F.when(fault["quoted"], F.concat(F.lit('"'), "o_orderpriority", F.lit('" order, as sent'))).otherwise(
        F.concat(F.lit('"'), "o_orderpriority", F.lit(' order, ""as sent"""')))
    line = F.when(fault["short"], F.concat_ws(",", first, "o_orderstatus")).otherwise(
        F.concat(F.concat_ws(",", first, "o_orderstatus", note), F.when(fault["long"], ",more").otherwise("")))
    lines = orders.select(batch.alias("batch"), line.alias("line"))
    batches = sorted(r["batch"] for r in lines.select("batch").distinct().collect())  # one per year
    for b in batches:
        header = ",".join(SWAPPED_COLUMNS if b == SWAPPED_YEAR else FAULTY_COLUMNS)
        writer = lines.where(F.col("batch") == b).select(F.col("line").alias(header)).write.option("header", True)
        # one field a line, written as it stands
        writer.options(sep="\u0001", quote="", escapeQuotes=False, ignoreLeadingWhiteSpace=False, ignoreTrailingWhiteSpace=False).csv(f"{root}/{b}/orders.csv")
    return root, batches


# Orders landed per year; files of years before this one predate the
# priority column, so the partitions have two different schemas.
PRIORITY_SINCE_YEAR = 1998


def land_orders_by_year(spark: SparkSession, sf_dir: str) -> str:
    """I6 twice: early load dates without ``o_orderpriority``, later ones with it."""
    root = scratch_path(spark, "landing-orders")
    orders = standins.table(spark, sf_dir, "orders")
    load_date = F.make_date(F.year("o_orderdate"), F.lit(1), F.lit(1))
    early = orders.where(F.year("o_orderdate") < PRIORITY_SINCE_YEAR).drop("o_orderpriority")
    late = orders.where((F.year("o_orderdate") >= PRIORITY_SINCE_YEAR) | F.col("o_orderdate").isNull())
    land_partitioned(early, root, load_date)
    land_partitioned(late, root, load_date)
    return root


def bronze_frames(spark: SparkSession, root: str, columns: dict[str, list[str]]) -> dict[str, DataFrame]:
    from strata.sources.files import add_bronze_audit, read_csv_partitioned

    return {
        e: add_bronze_audit(
            read_csv_partitioned(spark, f"{root}/{e}", cols), "stand_in", ingestion_ts=F.lit(None).cast("timestamp")
        )
        for e, cols in columns.items()
    }
