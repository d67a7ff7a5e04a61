"""The full layered run: Bronze -> Silver -> Gold -> quality gate.

``run_pipeline`` writes every table under ``out_root`` (a shared folder on a
cluster) and returns a :class:`RunResult`.  The build order includes both
inputs of ``dim_date`` (trap T8); the run log is appended only when the gate
passes (trap T11), so a failing run never becomes the next baseline.

Each layer is written once and the next layer reads the written files, which
cuts lineage between layers (an executor lost late in the run recomputes only
from the last written layer).

A run writes every table to a fresh version folder and switches all of them by
one rename when the gate has passed.  Until then, and if it dies anywhere, the
lake of the last good run is read in full.
"""

from __future__ import annotations

import datetime as dt
from concurrent.futures import ThreadPoolExecutor
from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import BooleanType, StringType, StructField, StructType, TimestampNTZType

from strata.operators import clean as C
from strata.operators import history as H
from strata.operators import quality as Q
from strata.operators import star
from strata.plans import suite
from strata.sources import files, sinks
from strata.sources.store import Versions

# Bronze column order of the six retail entities.
ENTITY_COLUMNS = {
    "customers": ["customer_id", "email", "customer_name", "segment", "city", "region", "updated_at"],
    "products": ["product_id", "product_name", "category", "unit_price", "updated_at"],
    "warehouses": ["warehouse_id", "warehouse_name", "city", "region"],
    "orders": ["order_id", "customer_id", "warehouse_id", "order_timestamp", "status"],
    "order_items": ["order_item_id", "order_id", "product_id", "quantity", "unit_price"],
    "inventory_events": ["event_id", "warehouse_id", "product_id", "event_type", "quantity_change", "event_timestamp"],
}
# Load type of each entity (incremental entities accumulate
# load dates; full entities land a complete snapshot each run).
LOAD_TYPES = {
    "customers": "incremental",
    "products": "incremental",
    "warehouses": "full",
    "orders": "incremental",
    "order_items": "full",
    "inventory_events": "incremental",
}
SILVER_NAME = {
    "products": "products_clean",
    "warehouses": "warehouses_clean",
    "orders": "orders_clean",
    "order_items": "order_items_clean",
    "inventory_events": "inventory_events_clean",
}

HISTORY_SCHEMA = StructType(
    [StructField("customer_sk", StringType()), StructField("customer_id", StringType())]
    + [StructField(c, StringType()) for c in H.CUSTOMER_TRACKED]
    + [
        StructField(H.START, TimestampNTZType()),
        StructField(H.END, TimestampNTZType()),
        StructField(H.CURRENT, BooleanType()),
    ]
)


def entity_specs() -> dict[str, C.EntitySpec]:
    return {
        "products": C.products_spec(),
        "warehouses": C.warehouses_spec(),
        "orders": C.orders_spec(),
        "order_items": C.order_items_spec(),
        "inventory_events": C.inventory_events_spec(),
    }


class Tables:
    """Written layer tables, read back by path (same attributes as Layers).

    The version of the lake is resolved once; a run's own tables are read where it has staged them.
    """

    def __init__(self, spark: SparkSession, root: str, null_attribute: str = "region"):
        self.spark, self.root = spark, root.rstrip("/")
        self.null_attribute = null_attribute
        self.splits: dict[str, sinks.SplitTable] = {}
        self.versions = Versions(spark, root)
        self.observed: dict[str, int] = {}  # metrics of the suite known from writing the tables

    def path(self, layer: str, name: str) -> str:
        return self.versions.path(f"{layer}/{name}")

    def target(self, layer: str, name: str) -> str:
        """A fresh folder for a table of this run."""
        return self.versions.stage(f"{layer}/{name}")

    def exists(self, layer: str, name: str) -> bool:
        table = f"{layer}/{name}"
        return table in self.versions.tables or table in self.versions.staged or self.versions.store.exists(table)

    def read(self, layer: str, name: str) -> DataFrame:
        return self.spark.read.parquet(self.path(layer, name))

    def raw(self, entity: str) -> DataFrame:
        return self.read("bronze", entity)

    def raw_items_typed(self) -> DataFrame:
        return C.standardise(self.raw("order_items"), C.order_items_spec())

    def _split(self, entity: str) -> sinks.SplitTable:
        if entity not in self.splits:  # a lake written by an earlier run
            cols = [c for c in self.spark.read.parquet(self.path("silver", SILVER_NAME[entity])).columns
                    if c not in sinks.SPLIT_AUDIT and c != C.VALID_FLAG]
            self.splits[entity] = sinks.SplitTable(self.path("silver", SILVER_NAME[entity]), cols, -1, -1)
        return self.splits[entity]

    def silver(self, entity: str) -> DataFrame:
        return self._split(entity).valid(self.spark)

    def quarantine(self, entity: str) -> DataFrame:
        if entity == "customers":
            return self.read("quarantine", entity)
        return self._split(entity).quarantined(self.spark)

    @property
    def customer_history(self) -> DataFrame:
        return self.read("silver", "customers_history")

    dim_customer = property(lambda self: self.read("gold", "dim_customer"))
    dim_product = property(lambda self: self.read("gold", "dim_product"))
    dim_warehouse = property(lambda self: self.read("gold", "dim_warehouse"))
    dim_date = property(lambda self: self.read("gold", "dim_date"))
    fct_sales = property(lambda self: self.read("gold", "fct_sales").drop(FACT_MONTH))
    fct_inventory_movements = property(
        lambda self: self.read("gold", "fct_inventory_movements").drop(FACT_MONTH)
    )


@dataclass
class EdgeCases:
    """Named records whose outcome is known in advance (the planted cases)."""

    versions: dict[str, int] = field(default_factory=dict)
    null_to_value_customer: str | None = None
    null_attribute: str = "region"
    order_before_change: str | None = None
    order_after_change: str | None = None
    illegal_order_item: str | None = None
    duplicate_order_item: str | None = None


def specific_checks(t: Tables, edge: EdgeCases) -> list[DataFrame]:
    """Q6, Q7, Q10, Q18 for named records."""
    frames = []
    hist = t.customer_history
    if edge.versions:
        frames.append(Q.expect_versions(hist, "customer_id", edge.versions))
    if edge.null_to_value_customer:
        k, a = edge.null_to_value_customer, edge.null_attribute
        frames.append(Q.table_checks(hist, [Q.Check(
            "closed version keeps its NULL attribute",
            F.count_if((F.col("customer_id") == k) & ~F.col(H.CURRENT) & F.col(a).isNull()), 1)]))
    resolved = t.fct_sales.join(t.dim_customer.select("customer_sk", H.CURRENT), "customer_sk")
    checks = []
    if edge.order_before_change:
        checks.append(Q.Check("lines of the earlier order on a closed version",
                              F.count_if((F.col("order_id") == edge.order_before_change) & ~F.col(H.CURRENT)), None))
    if edge.order_after_change:
        checks.append(Q.Check("lines of the later order on the open version",
                              F.count_if((F.col("order_id") == edge.order_after_change) & F.col(H.CURRENT)), None))
    if checks:
        frames.append(Q.table_checks(resolved, checks))
    if edge.illegal_order_item:
        k = edge.illegal_order_item
        frames.append(Q.table_checks(t.quarantine("order_items"), [
            Q.Check("invalid line in quarantine", F.count_if(F.col("order_item_id") == k), 1)]))
        frames.append(Q.table_checks(t.silver("order_items"), [
            Q.Check("invalid line in Silver", F.count_if(F.col("order_item_id") == k), 0)]))
    if edge.duplicate_order_item:
        frames.append(Q.table_checks(t.silver("order_items"), [
            Q.Check("rows of the repeated line in Silver",
                    F.count_if(F.col("order_item_id") == edge.duplicate_order_item), 1)]))
    return frames


@dataclass
class RunResult:
    root: str
    counts: dict[str, int]
    checks: list
    passed: bool
    tables: Tables  # as this run wrote them, also where the gate kept them from being published


def _write_layer(df: DataFrame, t: Tables, layer: str, name: str) -> int:
    rows = sinks.write_counted(df, t.target(layer, name))
    t.observed[f"{name}.rows"] = rows
    return rows


FACT_MONTH = "date_month"
RUN_LOG = "validation_run_log"


def _write_fact(df: DataFrame, t: Tables, name: str, by_month: bool) -> int:
    """A fact table, optionally partitioned by month of ``date_key``.

    The ``REBALANCE`` hint lets AQE cut the write into evenly sized tasks per
    month (a hot month is split, small months are merged), so neither one
    task writes a third of the table nor every task writes a file into every
    month.  Readers drop the partition column again (see :class:`Tables`).
    """
    rules = suite.measured(suite.sales_rules() if name == "fct_sales" else suite.inventory_rules())
    metrics = {f"{name}.{k}": c for k, c in rules.items()}
    if not by_month:
        return sinks.write_counted(df, t.target("gold", name), metrics=metrics, observed=t.observed)
    monthly = df.withColumn(FACT_MONTH, F.expr("date_key div 100").cast("int")).hint("rebalance", FACT_MONTH)
    return sinks.write_counted(monthly, t.target("gold", name), partition_by=[FACT_MONTH], metrics=metrics, observed=t.observed)


def bronze_source(
    spark: SparkSession,
    landing_root: str,
    entity: str,
    batches: list[str] | None,
    landing_format: str = "csv",
    load_type: str | None = None,
) -> tuple[DataFrame, DataFrame | None]:
    """Raw rows of one entity with ``batch_id`` and ``source_file``, and the lines that are no rows.

    csv:     ``<root>/<batch>/<entity>.csv`` for the given batches (S1).
    parquet: ``<root>/<entity>/load_date=<d>/`` -- every load date of an
             incremental entity (S2), only the latest of a full one (S3).
    """
    if landing_format == "csv":
        return files.split_csv_batches(spark, landing_root, batches or [], entity, ENTITY_COLUMNS[entity])
    if landing_format != "parquet":
        raise ValueError(f"unknown landing format {landing_format!r}")
    root = f"{landing_root.rstrip('/')}/{entity}"
    kind = load_type or LOAD_TYPES[entity]
    df = files.read_partitions(spark, root) if kind == "incremental" else files.read_latest_snapshot(spark, root)
    return df.drop("load_date"), None


def run_pipeline(
    spark: SparkSession,
    landing_root: str,
    batches: list[str],
    out_root: str,
    run_ts: dt.datetime | None = None,
    source_system: str = "landing",
    edge_cases: EdgeCases | None = None,
    raise_on_failure: bool = True,
    landing_format: str = "csv",
    facts_by_month: bool = False,
    keep_versions: int = 2,
) -> RunResult:
    """One full run.  The lake under ``out_root`` switches to it only if the gate passes; the last
    ``keep_versions`` versions stay readable for whoever has resolved them."""
    run_ts = run_ts or dt.datetime.now(dt.timezone.utc).replace(tzinfo=None)
    ts: Column = F.lit(run_ts).cast("timestamp")
    t = Tables(spark, out_root)
    counts: dict[str, int] = {}

    # Bronze: one scan per entity over all batches, audit columns; entities side by side.
    def bronze(entity: str) -> dict[str, int]:
        raw, rejected = bronze_source(spark, landing_root, entity, batches, landing_format)
        rows = files.add_bronze_audit(raw, source_system, ingestion_ts=ts)
        done = {f"bronze.{entity}": sinks.write_bronze(rows, t.target("bronze", entity))}
        if rejected is not None:
            lines = files.add_bronze_audit(rejected, source_system, ingestion_ts=ts)
            done[f"quarantine.{entity}_lines"] = sinks.write_quarantine(lines, t.target("quarantine", f"{entity}_lines"))
        return done

    # Silver: typed + deduplicated, evaluated and written once per entity;
    # the clean table and the quarantine are the two partitions of that write.
    def silver(entity: str) -> dict[str, int]:
        spec, name = entity_specs()[entity], SILVER_NAME[entity]
        typed = C.standardise(t.raw(entity), spec)
        deduped = C.dedup_latest(typed, spec.keys, spec.order_col, spec.tie_break)
        split = t.splits[entity] = sinks.write_split(deduped, spec.rules, spec.reason, t.target("silver", name), ts)
        t.observed[f"silver.{name}.rows"] = split.valid_rows
        return {f"silver.{name}": split.valid_rows, f"quarantine.{entity}": split.quarantined_rows}

    for step, entities in ((bronze, ENTITY_COLUMNS), (silver, SILVER_NAME)):
        with ThreadPoolExecutor(len(entities)) as pool:  # a write of one table leaves most of a cluster idle
            for done in pool.map(step, entities):
                counts.update(done)

    # Customer history: quarantine before dedup, then the window rebuild.
    feed, bad_feed = H.prepare_feed(t.raw("customers"), quarantine_ts=ts)
    counts["quarantine.customers"] = sinks.write_quarantine(bad_feed, t.target("quarantine", "customers"))
    history = H.build_history(feed)
    counts["silver.customers_history"] = sinks.drop_and_rebuild(
        history, t.target("silver", "customers_history"), HISTORY_SCHEMA
    )

    t.observed["history.rows"] = counts["silver.customers_history"]

    # Gold: dimensions first (dim_date needs both transactional inputs), then facts.
    counts["gold.dim_customer"] = _write_layer(star.dim_customer(t.customer_history), t, "gold", "dim_customer")
    counts["gold.dim_product"] = _write_layer(star.dim_product(t.silver("products")), t, "gold", "dim_product")
    counts["gold.dim_warehouse"] = _write_layer(star.dim_warehouse(t.silver("warehouses")), t, "gold", "dim_warehouse")
    counts["gold.dim_date"] = _write_layer(
        star.dim_date(t.silver("orders"), t.silver("inventory_events")), t, "gold", "dim_date"
    )
    fct = star.fct_sales(t.silver("order_items"), t.silver("orders"), t.dim_customer, t.dim_product, t.dim_warehouse)
    counts["gold.fct_sales"] = _write_fact(fct, t, "fct_sales", facts_by_month)
    inv = star.fct_inventory_movements(t.silver("inventory_events"), t.dim_warehouse, t.dim_product)
    counts["gold.fct_inventory_movements"] = _write_fact(inv, t, "fct_inventory_movements", facts_by_month)

    # Quality: the whole suite is one frame; run log compared, then gated.
    frames = [suite.full_suite(t)] + specific_checks(t, edge_cases or EdgeCases())
    current = Q.known_counts(spark, {name: counts[name] for name in suite.STABLE}, ts)
    log = t.read("gold", RUN_LOG) if t.exists("gold", RUN_LOG) else None
    if log is not None:
        frames.append(Q.run_stability(log, current))
    results = Q.union_all(frames)
    try:
        rows = Q.gate(results)
        passed = True
    except Q.ValidationFailed as failed:
        if raise_on_failure:
            raise
        rows, passed = failed.rows, False
    if passed:
        # the log is a table of this version too: it never names a run that cannot be read
        _write_layer(current if log is None else log.unionByName(current), t, "gold", RUN_LOG)
        t.versions.publish(keep_versions)
    return RunResult(out_root, counts, rows, passed, t)


def register_layers(spark: SparkSession, out_root: str, prefix: str = "") -> list[str]:
    """Expose a written lake in the catalog as ``{prefix}bronze|silver|quarantine|gold``.

    Bronze and Gold folders become tables over their location; each Silver
    table and its quarantine become views over their partition of the split
    folder.  Names point at the version current now and are replaced by the
    next call.  Returns the qualified names.
    """
    t = Tables(spark, out_root)
    ns = {layer: f"{prefix}{layer}" for layer in sinks.LAYERS}
    sinks.create_namespaces(spark, prefix)
    names = []

    def drop(schema: str, name: str) -> None:
        full = f"{schema}.{name}"
        if spark.catalog.tableExists(full):
            kind = "VIEW" if spark.catalog.getTable(full).tableType == "VIEW" else "TABLE"
            spark.sql(f"DROP {kind} `{schema}`.`{name}`")  # external tables keep their files

    def table(schema: str, name: str, path: str) -> None:
        drop(schema, name)
        spark.sql(f"CREATE TABLE `{schema}`.`{name}` USING parquet LOCATION '{path}'")
        names.append(f"{schema}.{name}")

    def view(schema: str, name: str, path: str, cols: list[str], valid: bool) -> None:
        select = ", ".join(f"`{c}`" for c in cols)
        cond = f"CAST(`{C.VALID_FLAG}` AS BOOLEAN)" if valid else f"NOT CAST(`{C.VALID_FLAG}` AS BOOLEAN)"
        drop(schema, name)
        spark.sql(
            f"CREATE VIEW `{schema}`.`{name}` AS "
            f"SELECT {select} FROM parquet.`{path}` WHERE {cond}"
        )
        names.append(f"{schema}.{name}")

    for entity in ENTITY_COLUMNS:
        table(ns["bronze"], entity, t.path("bronze", entity))
        if t.exists("quarantine", f"{entity}_lines"):
            table(ns["quarantine"], f"{entity}_lines", t.path("quarantine", f"{entity}_lines"))
    table(ns["silver"], "customers_history", t.path("silver", "customers_history"))
    table(ns["quarantine"], "customers", t.path("quarantine", "customers"))
    for entity, name in SILVER_NAME.items():
        split = t._split(entity)
        view(ns["silver"], name, split.path, split.columns + ["silver_processed_timestamp"], True)
        view(ns["quarantine"], entity, split.path,
             split.columns + ["quarantine_reason", "failed_rules", "quarantine_timestamp"], False)
    for name in ["dim_customer", "dim_product", "dim_warehouse", "dim_date", "fct_sales",
                 "fct_inventory_movements", RUN_LOG]:
        if t.exists("gold", name):
            table(ns["gold"], name, t.path("gold", name))
    return names
