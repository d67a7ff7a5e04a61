"""Registry of named queries: ``name -> fn(spark, sf_dir) -> DataFrame``.

Every query reads the driver's tables (through the stand-in mapping) in full.
Audit columns that carry run time (ingestion / quarantine timestamps) are left
out so that results are reproducible; the pipeline adds them on write.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from strata.operators import star
from strata.plans.layers import Layers

Query = Callable[[SparkSession, str], DataFrame]
REGISTRY: dict[str, Query] = {}


def fresh(df: DataFrame) -> DataFrame:
    """A new Dataset over the same plan (its own physical plan and shuffles)."""
    return df.select(*[F.col(f"`{c}`") for c in df.columns])


def query(name: str):
    def deco(fn: Query) -> Query:
        REGISTRY[name] = lambda spark, sf: fresh(fn(spark, sf))
        REGISTRY[name].__doc__ = fn.__doc__
        return fn

    return deco


def _silver(entity: str) -> Query:
    return lambda spark, sf: fresh(Layers.shared(spark, sf).silver(entity))


def _quarantine(entity: str) -> Query:
    return lambda spark, sf: fresh(Layers.shared(spark, sf).quarantine(entity))


@query("trim_to_null")
def q_trim_to_null(spark, sf):
    """P2 on the raw customer feed (blank priorities become NULL)."""
    from strata.operators.clean import trim_to_null
    from strata.operators.history import CUSTOMER_TRACKED

    return trim_to_null(Layers.shared(spark, sf).raw("customers"), CUSTOMER_TRACKED)


@query("dedup_latest")
def q_dedup_latest(spark, sf):
    """W1 on order lines: latest ship date per order line, total order."""
    from strata.operators.clean import dedup_latest, standardise
    from strata.plans.layers import items_spec

    spec = items_spec()
    typed = standardise(Layers.shared(spark, sf).raw("order_items"), spec)
    return dedup_latest(typed, spec.keys, spec.order_col)


@query("dedup_latest_batches")
def q_dedup_latest_batches(spark, sf):
    """W1 over twelve batches loaded at one time: per customer the latest batch
    (order month, batch_10 after batch_9), then the largest order key, wins."""
    from strata.operators.clean import dedup_latest
    from strata.plans.standins import table

    orders = table(spark, sf, "orders").select(
        "o_custkey",
        F.concat(F.lit("batch_"), F.month("o_orderdate")).alias("batch_id"),
        F.lit("2024-01-01 00:00:00").cast("timestamp_ntz").alias("ingestion_timestamp"),
        "o_orderkey",
    )
    return dedup_latest(orders, ["o_custkey"], "ingestion_timestamp")


REGISTRY["clean_products"] = _silver("products")
REGISTRY["clean_warehouses"] = _silver("warehouses")
REGISTRY["clean_orders"] = _silver("orders")
REGISTRY["clean_order_items"] = _silver("order_items")
REGISTRY["clean_inventory_events"] = _silver("inventory_events")
REGISTRY["quarantine_products"] = _quarantine("products")
REGISTRY["quarantine_orders"] = _quarantine("orders")
REGISTRY["quarantine_order_items"] = _quarantine("order_items")
REGISTRY["quarantine_inventory_events"] = _quarantine("inventory_events")
REGISTRY["quarantine_customers"] = _quarantine("customers")
REGISTRY["quarantine_warehouses"] = _quarantine("warehouses")


@query("customer_changes")
def q_customer_changes(spark, sf):
    """H1-H4: feed rows that open a new version."""
    return Layers.shared(spark, sf).customer_changes


@query("customer_history")
def q_customer_history(spark, sf):
    """H5-H6: full Type-2 history."""
    return Layers.shared(spark, sf).customer_history


@query("history_version_counts")
def q_history_version_counts(spark, sf):
    """Versions per customer."""
    return (
        Layers.shared(spark, sf)
        .customer_history.groupBy("customer_id")
        .agg(F.count(F.lit(1)).alias("version_count"))
    )


@query("dim_customer")
def q_dim_customer(spark, sf):
    return Layers.shared(spark, sf).dim_customer


@query("dim_product")
def q_dim_product(spark, sf):
    return Layers.shared(spark, sf).dim_product


@query("dim_warehouse")
def q_dim_warehouse(spark, sf):
    return Layers.shared(spark, sf).dim_warehouse


@query("dim_date")
def q_dim_date(spark, sf):
    return Layers.shared(spark, sf).dim_date


@query("fct_sales")
def q_fct_sales(spark, sf):
    """D6 (flagship): order-line sales fact with the point-in-time customer."""
    return Layers.shared(spark, sf).fct_sales


@query("fct_inventory_movements")
def q_fct_inventory(spark, sf):
    return Layers.shared(spark, sf).fct_inventory_movements


@query("sales_unresolved")
def q_sales_unresolved(spark, sf):
    """Lines placed before their customer's first version."""
    return star.unresolved_sales(Layers.shared(spark, sf).fct_sales)


@query("sales_by_customer_version")
def q_sales_by_customer_version(spark, sf):
    lay = Layers.shared(spark, sf)
    return star.sales_by_customer_version(lay.fct_sales, lay.dim_customer)


@query("net_stock_movement")
def q_net_stock_movement(spark, sf):
    lay = Layers.shared(spark, sf)
    return star.net_stock_movement(lay.fct_inventory_movements, lay.dim_warehouse, lay.dim_product)


@query("naive_fanout")
def q_naive_fanout(spark, sf):
    """J10 negative control: what a key-only customer join would do.

    The fan-out is measured without materialising line x version pairs: each
    line is joined to its customer's version count (one row per customer).
    """
    lay = Layers.shared(spark, sf)
    lines = lay.silver("order_items").select("order_item_id", "order_id").join(
        lay.silver("orders").select("order_id", "customer_id"), "order_id"
    )
    counts = lay.dim_customer.groupBy("customer_id").agg(F.count(F.lit(1)).alias("_versions"))
    return lines.join(counts, "customer_id", "left").agg(
        F.count(F.lit(1)).alias("grain_rows"),
        F.sum(F.coalesce(F.col("_versions"), F.lit(1))).alias("naive_rows"),
        F.count_if(F.col("_versions") > 1).alias("fanned_out_lines"),
    )


def _suite(part: str) -> Query:
    def run(spark, sf):
        from strata.plans import suite

        return fresh(getattr(suite, part)(Layers.shared(spark, sf)))

    return run


REGISTRY["check_key_uniqueness"] = _suite("key_uniqueness")
REGISTRY["check_single_current"] = _suite("single_current")
REGISTRY["check_overlaps"] = _suite("overlaps")
REGISTRY["check_gaps"] = _suite("gaps")
REGISTRY["check_foreign_keys"] = _suite("foreign_keys")
REGISTRY["check_business_rules"] = _suite("business_rules")
REGISTRY["check_grain"] = _suite("grain")
REGISTRY["check_expectations"] = _suite("expectations")


@query("check_defects")
def q_check_defects(spark, sf):
    """The whole suite over layers with a share of every defect planted: no check can hold by chance."""
    from strata.plans import suite
    from strata.plans.layers import DefectiveLayers

    return suite.full_suite(DefectiveLayers(spark, sf))


@query("check_expected_versions")
def q_check_expected_versions(spark, sf):
    """Q6: versions of every customer of the first hundred keys, each expected to have one (those that changed fail)."""
    from strata.operators.quality import expect_versions

    return expect_versions(Layers.shared(spark, sf).customer_history, "customer_id", {str(k): 1 for k in range(1, 101)})


@query("check_suite_summary")
def q_check_suite_summary(spark, sf):
    """Q19: passed / failed over the whole suite (the gate's input)."""
    from strata.operators import quality as Q
    from strata.plans import suite

    return Q.summary(suite.full_suite(Layers.shared(spark, sf)))


@query("check_run_stability")
def q_check_run_stability(spark, sf):
    """Two runs append their counts to a run log in the shared
    checkpoint folder; the second run is compared with the first."""
    from strata.operators import quality as Q
    from strata.plans import suite
    from strata.session import scratch_path
    from strata.sources import sinks

    lay = Layers.shared(spark, sf)
    log_path = scratch_path(spark, "run_log")
    tables = suite.stability_tables(lay)
    first = Q.current_counts(spark, tables, F.lit("2024-01-01 00:00:00").cast("timestamp"))
    sinks.append_run_log(first, log_path)
    second = Q.current_counts(spark, tables, F.lit("2024-01-02 00:00:00").cast("timestamp"))
    return Q.run_stability(spark.read.parquet(log_path), second)


# --------------------------------------------------------------------------
# Ordered reports
@query("report_customer_history")
def q_report_customer_history(spark, sf):
    """O1: all customer versions in order of customer and start."""
    from strata.operators.report import ranked

    lay = Layers.shared(spark, sf)
    return ranked(lay.customer_history.drop("customer_sk"), ["customer_id", "effective_start_timestamp"])


@query("report_sales_by_version")
def q_report_sales_by_version(spark, sf):
    """O1: the lines of customers with several versions, in order of customer, order time and line."""
    from strata.operators.report import ranked

    lay = Layers.shared(spark, sf)
    return ranked(star.sales_by_customer_version(lay.fct_sales, lay.dim_customer), ["customer_id", "order_timestamp", "order_item_id"])


@query("report_batch_counts")
def q_report_batch_counts(spark, sf):
    """O1: rows of the customer feed per batch, in order of the batch."""
    from strata.operators.report import ranked

    return ranked(Layers.shared(spark, sf).raw("customers").groupBy("batch_id").agg(F.count(F.lit(1)).alias("n")), ["batch_id"])


@query("report_top_stock")
def q_report_top_stock(spark, sf):
    """O1: the hundred largest net movements, largest first, then by names."""
    from strata.operators.report import top

    lay = Layers.shared(spark, sf)
    net = star.net_stock_movement(lay.fct_inventory_movements, lay.dim_warehouse, lay.dim_product)
    return top(net, ["net_movement", "warehouse_name", "product_name"], 100, ["net_movement"])


# --------------------------------------------------------------------------
# Bronze and ingestion
@query("bronze_batches")
def q_bronze_batches(spark, sf):
    """Land every raw entity as CSV batches, read each entity
    back in one scan with audit columns, and count rows per entity and batch."""
    from strata.operators.quality import union_all
    from strata.plans.landing import bronze_frames, land_csv_entities

    root, columns = land_csv_entities(spark, sf)
    frames = bronze_frames(spark, root, columns)
    return union_all(
        [df.select(F.lit(e).alias("entity"), "batch_id") for e, df in frames.items()]
    ).groupBy("entity", "batch_id").agg(F.count(F.lit(1)).alias("n"))


@query("bronze_csv_batches")
def q_bronze_csv_batches(spark, sf):
    """S1/S6 on a landing with planted faults: the rows that load and the lines set aside, with batch, file,
    reason and source system.  (The header line that each part of a swapped file repeats is left out.)"""
    from strata.plans import landing
    from strata.sources.files import add_bronze_audit, split_csv_batches

    root, batches = landing.land_faulty_csv(spark, sf)
    rows, rejected = split_csv_batches(spark, root, batches, "orders", landing.FAULTY_COLUMNS)
    rejected = rejected.where(F.col("raw_line") != ",".join(landing.SWAPPED_COLUMNS))
    audited = add_bronze_audit(rows.unionByName(rejected, allowMissingColumns=True), "order_desk", ingestion_ts=F.lit(RUN_TS).cast("timestamp"))
    file = F.regexp_extract("source_file", r"/([^/]+/orders\.csv)(/[^/]*)?$", 1)
    return audited.select("batch_id", file.alias("file"), *landing.FAULTY_COLUMNS, "raw_line", "rejected_reason", "source_system",
                          F.date_format("ingestion_timestamp", "yyyy-MM-dd").alias("ingested_on"))


@query("bronze_merged_schema")
def q_bronze_merged_schema(spark, sf):
    """All load-date partitions of orders, merged by column name."""
    from strata.plans.landing import land_orders_by_year
    from strata.sources.files import read_partitions

    root = land_orders_by_year(spark, sf)
    return read_partitions(spark, root).drop("source_file")


@query("bronze_latest_snapshot")
def q_bronze_latest_snapshot(spark, sf):
    """Only the greatest load-date partition."""
    from strata.plans.landing import land_orders_by_year
    from strata.sources.files import read_latest_snapshot

    root = land_orders_by_year(spark, sf)
    return read_latest_snapshot(spark, root).drop("source_file")


# The previous run's mark for the incremental slice (a run parameter).
SLICE_LAST_WATERMARK = "1998-06-30 00:00:00"
RUN_TS = "2024-03-01 00:00:00"


@query("ingest_slice")
def q_ingest_slice(spark, sf):
    """Orders in (previous mark, current high]."""
    from strata.operators.ingest import high_watermark, incremental_slice
    from strata.plans.standins import table

    orders = table(spark, sf, "orders")
    high = high_watermark(orders, "o_orderdate").scalar()
    return incremental_slice(orders, "o_orderdate", SLICE_LAST_WATERMARK, high)


def advanced_control(spark, sf, failed: tuple[str, ...] = ("inventory_events",)) -> DataFrame:
    """Seed -> highs of the incremental sources -> advance (one copy failed)."""
    from strata.operators.ingest import DEFAULT_SEED, advance_watermark, high_watermark, seed_frame
    from strata.operators.quality import union_all
    from strata.plans.standins import table

    highs = union_all(
        [
            high_watermark(table(spark, sf, src), wm).select(
                F.lit(entity).alias("entity_name"),
                "high_watermark",
                F.lit(entity not in failed).alias("copy_succeeded"),
            )
            for entity, _, src, load, wm, *_ in DEFAULT_SEED
            if load == "incremental"
        ]
    )
    return advance_watermark(seed_frame(spark), highs, RUN_TS)


@query("ingest_advance_watermark")
def q_ingest_advance_watermark(spark, sf):
    """Marks move only for successful incremental copies."""
    return advanced_control(spark, sf)


# A re-seed: new target paths, one entity switched off, one entity added.
RESEED = [
    ("customers", "tpch", "customer", "full", None, "lake/customers", "parquet", True),
    ("products", "tpch", "part", "full", None, "lake/products", "parquet", True),
    ("warehouses", "tpch", "supplier", "full", None, "lake/warehouses", "parquet", False),
    ("orders", "tpch", "orders", "incremental", "o_orderdate", "lake/orders", "parquet", True),
    ("order_items", "tpch", "lineitem", "incremental", "l_shipdate", "lake/order_items", "parquet", True),
    ("inventory_events", "tpch", "events", "incremental", "ts", "lake/inventory_events", "parquet", True),
    ("regions", "tpch", "region", "full", None, "lake/regions", "parquet", True),
]


@query("ingest_upsert_control")
def q_ingest_upsert_control(spark, sf):
    """I8 then I1: re-seeding keeps progress; the copy reads active rows."""
    from strata.operators.ingest import active_entities, seed_frame, upsert_control

    return active_entities(upsert_control(advanced_control(spark, sf), seed_frame(spark, RESEED)))


@query("history_apply_batch")
def q_history_apply_batch(spark, sf):
    """H7: the last three batches and a late one (the second) applied in one
    plan to the history of the others; equals the full rebuild."""
    from strata.operators import history as H

    feed = Layers.shared(spark, sf).silver("customers")
    order = H.order_batches(feed, "batch_id", "updated_at").orderBy(H.BATCH_TS, "batch_id")
    names = [r["batch_id"] for r in order.collect()]  # one row per batch
    new = F.col("batch_id").isin([*names[1:2], *names[-3:]])
    before = feed.where(~new)
    return H.apply_batches(H.build_history(before), feed.where(new), before)


@query("history_stream_runs")
def q_history_stream_runs(spark, sf):
    """H7 as a stream over the landing's ledger: a first run, then two runs (one on the same load date), then a
    late one on that date again; a batch is a date and its run. Equals the rebuild over these batches."""
    from strata.plans.standins import raw_customers
    from strata.operators.ingest import land_partitioned
    from strata.session import scratch_path
    from strata.streaming import latest_history, start_history_stream

    feed, year = raw_customers(spark, sf), F.coalesce(F.col("batch_id").cast("int"), F.lit(0))
    landing, history, checkpoint = (scratch_path(spark, f"runs-{x}") for x in ("landing", "history", "checkpoint"))
    for runs in STREAM_RUNS:
        for date, run, first, last in runs:
            land_partitioned(feed.where(year.between(first, last)).drop("batch_id"), landing, date, run)
        start_history_stream(spark, landing, history, checkpoint, buckets=16).awaitTermination()
    return latest_history(spark, history, buckets=16)


# Load date, run and the order years of each landing, by run of the stream.
STREAM_RUNS = [
    [("1998-12-31", "first", 0, 1997)],
    [("1998-12-31", "second", 1999, 1999), ("2001-12-31", "third", 2000, 9999)],
    [("1998-12-31", "late", 1998, 1998)],
]


@query("ingest_run")
def q_ingest_run(spark, sf):
    """I1-I7 end to end: a first run copies every active source table into
    load-date partitions (incremental ones up to their high watermark) and
    advances the marks; returns rows landed and the new mark per entity."""
    from strata.operators.ingest import seed_frame, run_ingestion
    from strata.operators.quality import union_all
    from strata.plans.standins import table
    from strata.session import scratch_path
    from strata.sources.files import read_partitions

    from strata.operators.ingest import DEFAULT_SEED

    control = seed_frame(spark)
    names = sorted({r[2] for r in DEFAULT_SEED})
    sources = {n: table(spark, sf, n) for n in names}
    landing = scratch_path(spark, "ingest-landing")
    new_control, _ = run_ingestion(spark, control, sources, landing, RUN_TS[:10], RUN_TS)
    landed = union_all([
        read_partitions(spark, f"{landing}/{path}").agg(F.count(F.lit(1)).alias("landed_rows"))
        .select(F.lit(entity).alias("entity_name"), "landed_rows")
        for entity, _, _, _, _, path, *_ in DEFAULT_SEED
    ])
    return landed.join(new_control.select("entity_name", "last_watermark_value"), "entity_name")


# The first of two runs on one load date copies up to this mark.
FIRST_RUN_UNTIL = "1995-06-30 00:00:00"


@query("ingest_two_runs")
def q_ingest_two_runs(spark, sf):
    """I3/I6 twice on one load date: orders up to a mark, then the rest; both
    slices stay, so what has landed equals the source (rows without an order
    date have no place in any slice)."""
    from strata.operators.ingest import high_watermark, incremental_slice, land_partitioned
    from strata.plans.standins import table
    from strata.session import scratch_path
    from strata.sources.files import read_partitions

    orders = table(spark, sf, "orders")
    landing = scratch_path(spark, "two-runs")
    high = high_watermark(orders, "o_orderdate").scalar()
    land_partitioned(incremental_slice(orders, "o_orderdate", None, FIRST_RUN_UNTIL), landing, RUN_TS[:10], run_id="r1")
    land_partitioned(incremental_slice(orders, "o_orderdate", FIRST_RUN_UNTIL, high), landing, RUN_TS[:10], run_id="r2")
    return read_partitions(spark, landing).drop("source_file")
