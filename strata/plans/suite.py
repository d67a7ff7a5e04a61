"""The validation suite (Q1-Q19, D5, D7, D10) as one pass per table.

A pass computes only the metrics that the checks at hand ask for, and not those
observed while the table was written (``lay.observed``).  A fact is read once:
its rows are counted per own and foreign key (partial aggregates, so a NULL or
hot key is one row per task) and only the key lists meet the dimensions; every
history-structure check comes out of one window pass.  The metric rows are
pivoted into check rows by a single tiny aggregate, so the whole suite is one
Spark action with one row per check.

``lay`` is any object exposing the layer tables: :class:`Layers` (lazy plans
over the stand-ins) or :class:`strata.plans.pipeline.Tables` (written files).
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from strata.operators import quality as Q
from strata.operators.history import CURRENT, END, START

MC = Q.MetricCheck

SILVER_TABLES = {
    "silver.products_clean": "products",
    "silver.warehouses_clean": "warehouses",
    "silver.orders_clean": "orders",
    "silver.order_items_clean": "order_items",
    "silver.inventory_events_clean": "inventory_events",
}


STABLE = ["silver.customers_history", "silver.order_items_clean", "gold.fct_sales", "gold.fct_inventory_movements"]


def stability_tables(lay) -> dict[str, DataFrame]:
    frames = (lay.customer_history, lay.silver("order_items"), lay.fct_sales, lay.fct_inventory_movements)
    return dict(zip(STABLE, frames, strict=True))


# --------------------------------------------------------------------------
# metric passes (one per table)
def history_pass(lay, want: set[str]) -> DataFrame:
    """Rows, key uniqueness and every Type-2 structure metric in one window pass."""
    h = lay.customer_history
    attr = getattr(lay, "null_attribute", "email")
    by_key = Window.partitionBy("customer_id")
    ordered = by_key.orderBy(F.col(START), F.col(END), F.col("customer_sk"))
    before = ordered.rowsBetween(Window.unboundedPreceding, -1)
    x = h.select(
        "customer_sk",
        F.col(START).alias("s"),
        F.col(END).alias("e"),
        F.col(CURRENT).alias("cur"),
        F.col(attr).alias("attr"),
        F.count_if(F.col(CURRENT)).over(by_key).alias("cur_per_key"),
        (F.row_number().over(ordered) == 1).alias("first_of_key"),
        F.max(F.when(F.col(START) < F.col(END), F.col(END))).over(before).alias("prev_max_end"),
        F.lead(START).over(ordered).alias("next_start"),
        F.lead(attr).over(ordered).alias("next_attr"),
    )
    return chosen(x, "history", want, {
        "rows": F.count(F.lit(1)),
        "distinct_sk": F.count_distinct("customer_sk"),
        "multi_current_keys": F.count_if(F.col("first_of_key") & (F.col("cur_per_key") > 1)),
        "no_current_keys": F.count_if(F.col("first_of_key") & (F.col("cur_per_key") == 0)),
        "overlaps": F.count_if((F.col("s") < F.col("e")) & (F.col("prev_max_end") > F.col("s"))),
        "gaps": F.count_if(F.col("next_start").isNotNull() & (F.col("next_start") != F.col("e"))),
        "inverted": F.count_if(~(F.col("s") < F.col("e"))),
        "null_retained": F.count_if(~F.col("cur") & F.col("attr").isNull() & F.col("next_attr").isNotNull()),
    })


def chosen(df: DataFrame, prefix: str, want: set[str], named: dict) -> DataFrame:
    return Q.metrics(df, prefix, {k: v for k, v in named.items() if k in want})


def fact_pass(
    fact: DataFrame, prefix: str, item: str, want: set[str], rules: dict[str, Column],
    keys: dict[str, tuple[str, DataFrame, str]], versions: DataFrame | None = None,
) -> DataFrame:
    """All metrics of a fact from one reading of it.

    Each row is counted with its own key and the rules that it breaks, under each foreign key, and under its customer
    version with its time. Keys are counted before they meet the dimensions, so no fact row is shuffled but for its own
    key, and a NULL or hot key is one row per task. Own keys are only told apart: one row per task goes on from them.
    ``versions``: customer_sk, _cur, _cur_start.
    """
    asked = {k: v for k, v in keys.items() if k in want}
    broken = {k: v for k, v in rules.items() if k in want}
    none = [F.lit(0).cast("bigint")] * len(broken)

    def counted(metric: str, key: Column, at: Column, own: Column, flags: list[Column]) -> Column:
        named = [x.alias(f"_r{i}") for i, x in enumerate(flags)]
        return F.struct(F.lit(metric).alias("metric"), key.cast("string").alias("key"), at.cast("timestamp_ntz").alias("at"), own.cast("string").alias("own"), *named)

    no = F.lit(None)
    kinds = [counted(m, F.col(fk), no, no, none) for m, (fk, _, _) in asked.items()]
    if broken or want & {"rows", "extra_rows"}:
        kinds.append(counted("_item", no, no, F.col(item), [F.coalesce(c, F.lit(False)).cast("bigint") for c in broken.values()]))
    known = [dim.select(F.lit(m).alias("metric"), F.col(key).cast("string").alias("key")).distinct() for m, (_, dim, key) in asked.items()]
    known = [k.withColumns({"_cur": F.lit(None).cast("int"), "_cur_start": F.lit(None).cast("timestamp_ntz")}) for k in known]
    if "version_mismatch" in want:
        kinds.append(counted("_version", F.col("customer_sk"), F.col("order_timestamp"), no, none))
        known.append(versions.select(F.lit("_version").alias("metric"), F.col("customer_sk").alias("key"), "_cur", F.col("_cur_start").cast("timestamp_ntz").alias("_cur_start")))
    counts = fact.select(F.inline(F.array(*kinds))).groupBy("metric", "key", "at").agg(
        F.count(F.lit(1)).alias("n"), F.count_distinct("own").alias("_own"), *(F.sum(f"_r{i}").alias(f"_r{i}") for i in range(len(broken)))
    )
    if known:
        met = counts.join(Q.union_all(known).withColumn("_known", F.lit(True)), ["metric", "key"], "left")
    else:
        met = counts.withColumns({"_known": F.lit(None).cast("boolean"), "_cur": F.lit(None).cast("int"), "_cur_start": F.lit(None).cast("timestamp_ntz")})
    of, n = F.col("metric"), F.col("n")
    total = lambda which: F.coalesce(F.sum(F.when(which, n)), F.lit(0))
    named = {m: total((of == m) & F.col("_known").isNull()) for m in asked}
    named |= {m: F.coalesce(F.sum(F.when(of == "_item", F.col(f"_r{i}"))), F.lit(0)) for i, m in enumerate(broken)}
    named |= {"rows": total(of == "_item"), "extra_rows": total(of == "_item") - F.coalesce(F.sum(F.when(of == "_item", F.col("_own"))), F.lit(0))}
    named |= {"version_mismatch": total((of == "_version") & ((F.col("_cur") == 1) != (F.col("at") >= F.col("_cur_start"))))}
    return chosen(met, prefix, want, named)


def sales_rules() -> dict[str, Column]:
    """What a sales line may break by itself."""
    expected = F.round(F.col("quantity").try_cast("decimal(12,0)") * F.col("unit_price").try_cast("decimal(20,6)"), 2)
    return {
        "unresolved_customer": F.col("customer_sk").isNull(),
        "bad_quantity": F.col("quantity") <= 0,
        "negative_amounts": (F.col("unit_price") < 0) | (F.col("line_amount") < 0),
        "amount_mismatch": F.col("line_amount").isNull() | expected.isNull() | (F.abs(F.col("line_amount").cast("decimal(38,6)") - expected) > 0.01),
    }


def inventory_rules() -> dict[str, Column]:
    """What a movement may break by itself."""
    et, q = F.col("event_type"), F.col("quantity_change")
    return {"sign_violations": ((et == "INBOUND") & (q <= 0)) | ((et == "OUTBOUND") & (q >= 0))}


def measured(rules: dict[str, Column] | None = None) -> dict[str, Column]:
    """Metrics that a write of the table can observe: its rows, and those that break a rule."""
    return {"rows": F.count(F.lit(1)), **{k: F.count_if(c) for k, c in (rules or {}).items()}}


def sales_pass(lay, want: set[str]) -> DataFrame:
    # each version with its key's current start, one row per version key so the lookup cannot fan out
    per_key = Window.partitionBy("customer_id")
    versions = (
        lay.dim_customer.select(
            "customer_sk",
            F.col(CURRENT).cast("int").alias("_cur"),
            F.max(F.when(F.col(CURRENT), F.col(START))).over(per_key).alias("_cur_start"),
        )
        .groupBy("customer_sk")
        .agg(F.max("_cur").alias("_cur"), F.max("_cur_start").alias("_cur_start"))
    ) if "version_mismatch" in want else None
    return fact_pass(lay.fct_sales, "fct_sales", "order_item_id", want, sales_rules(), {
        "orphan_product": ("product_sk", lay.dim_product, "product_sk"),
        "orphan_warehouse": ("warehouse_sk", lay.dim_warehouse, "warehouse_sk"),
        "orphan_date": ("date_key", lay.dim_date, "date_key"),
    }, versions)


def inventory_pass(lay, want: set[str]) -> DataFrame:
    return fact_pass(lay.fct_inventory_movements, "fct_inventory_movements", "event_id", want, inventory_rules(), {
        "orphan_warehouse": ("warehouse_sk", lay.dim_warehouse, "warehouse_sk"),
        "orphan_product": ("product_sk", lay.dim_product, "product_sk"),
        "orphan_date": ("date_key", lay.dim_date, "date_key"),
    })


def dimension_pass(df: DataFrame, name: str, key: str, want: set[str]) -> DataFrame:
    return chosen(df, name, want, {"rows": F.count(F.lit(1)), "distinct_key": F.count_distinct(key)})


def items_pass(lay, want: set[str]) -> DataFrame:
    """Silver order items: rows, repeated keys, and keys that are also quarantined, from one reading of both sides."""
    items = lay.silver("order_items")
    if want == {"rows"}:
        return chosen(items, "silver.order_items_clean", want, {"rows": F.count(F.lit(1))})
    if "leaked" not in want:
        keys = items.select("order_item_id", F.lit(1).alias("kept"), F.lit(False).alias("bad"))
    elif hasattr(lay, "item_keys"):
        keys = lay.item_keys()
    else:  # two tables
        keys = items.select("order_item_id", F.lit(1).alias("kept"), F.lit(False).alias("bad")).unionByName(
            lay.quarantine("order_items").select("order_item_id", F.lit(0).alias("kept"), F.lit(True).alias("bad")))
    per_key = keys.groupBy("order_item_id").agg(F.sum("kept").alias("n"), F.bool_or("bad").alias("bad"))
    n, known = F.col("n"), F.col("order_item_id").isNotNull()
    rows = F.coalesce(F.sum(n), F.lit(0))
    return chosen(per_key, "silver.order_items_clean", want, {
        "rows": rows,
        "extra_rows": rows - F.count_if(known & (n > 0)),
        "leaked": F.coalesce(F.sum(F.when(known & F.col("bad"), n)), F.lit(0)),
    })


def raw_items_pass(lay, want: set[str]) -> DataFrame:
    raw = lay.raw_items_typed()
    return chosen(raw, "raw.order_items", want, {"extra_rows": F.count(F.lit(1)) - F.count_distinct("order_item_id")})


def silver_pass(lay, table: str, want: set[str]) -> DataFrame:
    return chosen(lay.silver(SILVER_TABLES[table]), table, want, {"rows": F.count(F.lit(1))})


PASSES = {
    "history": history_pass,
    "fct_sales": sales_pass,
    "fct_inventory_movements": inventory_pass,
    "dim_product": lambda lay, want: dimension_pass(lay.dim_product, "dim_product", "product_sk", want),
    "dim_warehouse": lambda lay, want: dimension_pass(lay.dim_warehouse, "dim_warehouse", "warehouse_sk", want),
    "dim_date": lambda lay, want: dimension_pass(lay.dim_date, "dim_date", "date_key", want),
    "silver.order_items_clean": items_pass,
    "raw.order_items": raw_items_pass,
    **{t: (lambda lay, want, t=t: silver_pass(lay, t, want)) for t in SILVER_TABLES if t != "silver.order_items_clean"},
}


# --------------------------------------------------------------------------
# check groups: (check name, observed metric, expected)
NOT_EMPTY = [
    MC("rows present: silver.customers_history", "history.rows", None),
    MC("rows present: silver.products_clean", "silver.products_clean.rows", None),
    MC("rows present: silver.warehouses_clean", "silver.warehouses_clean.rows", None),
    MC("rows present: silver.orders_clean", "silver.orders_clean.rows", None),
    MC("rows present: silver.order_items_clean", "silver.order_items_clean.rows", None),
    MC("rows present: silver.inventory_events_clean", "silver.inventory_events_clean.rows", None),
    MC("rows present: gold.dim_customer", "history.rows", None),
    MC("rows present: gold.dim_product", "dim_product.rows", None),
    MC("rows present: gold.dim_warehouse", "dim_warehouse.rows", None),
    MC("rows present: gold.dim_date", "dim_date.rows", None),
    MC("rows present: gold.fct_sales", "fct_sales.rows", None),
    MC("rows present: gold.fct_inventory_movements", "fct_inventory_movements.rows", None),
]
GRAIN = NOT_EMPTY + [
    MC("row count: fct_sales = silver.order_items_clean", "fct_sales.rows", "silver.order_items_clean.rows"),
    MC("repeated keys: fct_sales.order_item_id", "fct_sales.extra_rows"),
    MC("row count: fct_inventory_movements = silver.inventory_events_clean", "fct_inventory_movements.rows",
       "silver.inventory_events_clean.rows"),
    MC("repeated keys: fct_inventory_movements.event_id", "fct_inventory_movements.extra_rows"),
    MC("missing customer version: fct_sales", "fct_sales.unresolved_customer"),
]
KEYS = [
    MC("distinct = rows: dim_customer.customer_sk", "history.distinct_sk", "history.rows"),
    MC("distinct = rows: dim_product.product_sk", "dim_product.distinct_key", "dim_product.rows"),
    MC("distinct = rows: dim_warehouse.warehouse_sk", "dim_warehouse.distinct_key", "dim_warehouse.rows"),
    MC("distinct = rows: dim_date.date_key", "dim_date.distinct_key", "dim_date.rows"),
]
SINGLE_CURRENT = [
    MC("several current versions: customers_history", "history.multi_current_keys"),
    MC("no current version: customers_history", "history.no_current_keys"),
]
OVERLAPS = [MC("overlapping windows: customers_history", "history.overlaps")]
GAPS = [
    MC("gaps between windows: customers_history", "history.gaps"),
    MC("empty windows: customers_history", "history.inverted"),
]
FOREIGN_KEYS = [
    MC("orphans: fct_sales.product_sk -> dim_product", "fct_sales.orphan_product"),
    MC("orphans: fct_sales.warehouse_sk -> dim_warehouse", "fct_sales.orphan_warehouse"),
    MC("orphans: fct_sales.date_key -> dim_date", "fct_sales.orphan_date"),
    MC("orphans: fct_inventory_movements.warehouse_sk -> dim_warehouse", "fct_inventory_movements.orphan_warehouse"),
    MC("orphans: fct_inventory_movements.product_sk -> dim_product", "fct_inventory_movements.orphan_product"),
    MC("orphans: fct_inventory_movements.date_key -> dim_date", "fct_inventory_movements.orphan_date"),
]
BUSINESS_RULES = [
    MC("quantity not above 0: fct_sales", "fct_sales.bad_quantity"),
    MC("price or amount below 0: fct_sales", "fct_sales.negative_amounts"),
    MC("amount differs from quantity times price: fct_sales", "fct_sales.amount_mismatch"),
    MC("sign against event type: fct_inventory_movements", "fct_inventory_movements.sign_violations"),
]


def expectation_checks(lay) -> list[Q.MetricCheck]:
    attr = getattr(lay, "null_attribute", "email")
    return [
        MC(f"closed versions with NULL {attr} before a value", "history.null_retained", None),
        MC("version not in effect at order time: fct_sales", "fct_sales.version_mismatch"),
        MC("quarantined keys in silver.order_items_clean", "silver.order_items_clean.leaked"),
        MC("repeated keys: silver.order_items_clean.order_item_id", "silver.order_items_clean.extra_rows"),
        MC("repeated keys before dedup: order_items", "raw.order_items.extra_rows", None),
    ]


def table_pass(lay, name: str, want: frozenset[str]) -> DataFrame:
    """The metrics ``want`` of one table, built once per layer object (a plan, not
    data: every query still executes it afresh)."""
    cache = lay.__dict__.setdefault("_suite_passes", {})
    if (name, want) not in cache:
        cache[name, want] = PASSES[name](lay, set(want))
    return cache[name, want]


def run_checks(lay, checks: list[Q.MetricCheck]) -> DataFrame:
    """Compute only the metrics the checks need, then the check rows.

    ``lay.observed`` has metrics that are known from the writing of the tables; they are not computed again.
    """
    observed = getattr(lay, "observed", {})
    wanted: dict[str, set[str]] = {}
    known: dict[str, int] = {}
    for c in checks:
        for metric in (c.observed, c.expected):
            if isinstance(metric, str) and metric in observed:
                known[metric] = observed[metric]
            elif isinstance(metric, str):
                table, _, name = metric.rpartition(".")
                wanted.setdefault(table, set()).add(name)
    frames = [table_pass(lay, t, frozenset(names)) for t, names in sorted(wanted.items())]
    if known:
        rows = F.array(*(F.struct(F.lit(m).alias("metric"), F.lit(v).cast("bigint").alias("value")) for m, v in known.items()))
        frames.append(lay.spark.range(1).select(F.inline(rows)))
    return Q.checks_from_metrics(Q.union_all(frames), checks)


def all_checks(lay) -> list[Q.MetricCheck]:
    return GRAIN + KEYS + SINGLE_CURRENT + OVERLAPS + GAPS + FOREIGN_KEYS + BUSINESS_RULES + expectation_checks(lay)


def grain(lay) -> DataFrame:
    return run_checks(lay, GRAIN)


def key_uniqueness(lay) -> DataFrame:
    return run_checks(lay, KEYS)


def single_current(lay) -> DataFrame:
    return run_checks(lay, SINGLE_CURRENT)


def overlaps(lay) -> DataFrame:
    return run_checks(lay, OVERLAPS)


def gaps(lay) -> DataFrame:
    return run_checks(lay, GAPS)


def foreign_keys(lay) -> DataFrame:
    return run_checks(lay, FOREIGN_KEYS)


def business_rules(lay) -> DataFrame:
    return run_checks(lay, BUSINESS_RULES)


def expectations(lay) -> DataFrame:
    return run_checks(lay, expectation_checks(lay))


def full_suite(lay) -> DataFrame:
    """Every structural check as one frame (one action, one pass per table)."""
    return run_checks(lay, all_checks(lay))
