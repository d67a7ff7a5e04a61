"""Gold star schema: dimensions and facts.

Hash surrogate keys (md5 of the business key, or of key|start for versions)
are stable across rebuilds, so a fact built at another time points at the same
rows.  Type-1 dimension joins are plain left joins: AQE broadcasts a dimension
when its measured size is under ``spark.sql.autoBroadcastJoinThreshold`` and
keeps a shuffle join otherwise, so no dimension is broadcast unchecked.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from strata.functions import scalar as S
from strata.operators.history import CURRENT, END, START, CUSTOMER_TRACKED
from strata.operators.joins import hot_keys, lookup_join, multi_version_keys, point_in_time_join

DIM_CUSTOMER_COLUMNS = ["customer_sk", "customer_id", *CUSTOMER_TRACKED, START, END, CURRENT]


def dim_customer(history: DataFrame) -> DataFrame:
    """Type-2 customer dimension, every version."""
    return history.select(*DIM_CUSTOMER_COLUMNS)


def dim_product(products: DataFrame) -> DataFrame:
    """Type-1 product dimension."""
    return products.select(
        S.surrogate_key("product_id").alias("product_sk"),
        "product_id",
        "product_name",
        "category",
        F.col("unit_price").alias("list_unit_price"),
    )


def dim_warehouse(warehouses: DataFrame) -> DataFrame:
    """D3: Type-1 warehouse dimension."""
    return warehouses.select(
        S.surrogate_key("warehouse_id").alias("warehouse_sk"),
        "warehouse_id",
        "warehouse_name",
        "city",
        "region",
    )


def date_bounds(*sources: tuple[DataFrame, str]) -> DataFrame:
    """Overall (min_date, max_date) over several timestamp columns.

    One aggregate per source table, then a union of the one-row results: each
    table is scanned once and only its pruned column is read.
    """
    parts = [
        df.select(F.min(F.to_date(c)).alias("min_date"), F.max(F.to_date(c)).alias("max_date"))
        for df, c in sources
    ]
    unioned = parts[0]
    for p in parts[1:]:
        unioned = unioned.unionByName(p)
    return unioned.agg(F.min("min_date").alias("min_date"), F.max("max_date").alias("max_date"))


def calendar(bounds: DataFrame) -> DataFrame:
    """One row per day between the bounds with calendar attributes.

    The days come from one bounds row, so one task generates them; their
    number is the span of the dates in days (bounded by time, not by data).
    """
    days = bounds.select(
        F.explode(F.sequence("min_date", "max_date", F.expr("INTERVAL 1 DAY"))).alias("date")
    )
    d = F.col("date")
    return days.select(
        S.date_key(d).alias("date_key"),
        d.alias("date"),
        F.year(d).alias("year"),
        F.quarter(d).alias("quarter"),
        F.month(d).alias("month"),
        F.dayofmonth(d).alias("day_of_month"),
        F.date_format(d, "EEEE").alias("day_name"),
        F.dayofweek(d).isin(1, 7).alias("is_weekend"),
    )


def dim_date(
    orders: DataFrame,
    events: DataFrame,
    order_ts: str = "order_timestamp",
    event_ts: str = "event_timestamp",
) -> DataFrame:
    """Calendar spanning every order and inventory-event date."""
    return calendar(date_bounds((orders, order_ts), (events, event_ts)))


# Customers holding at least this share of all orders are salted in the
# point-in-time join (at most 1 / SKEW_FRACTION = 100 such customers).
SKEW_FRACTION = 0.01


def resolve_customer_version(
    orders: DataFrame, dim_cust: DataFrame, skew_fraction: float | None = SKEW_FRACTION, hot: DataFrame | None = None,
    spread: list[str] | None = None,
) -> DataFrame:
    """J3 applied to order headers: the customer version in effect at order time.

    Resolving on the headers (before the line-item join) shuffles the smaller
    table by customer; the items then join on the order key.  Customers with
    at least ``skew_fraction`` of the orders are salted (``None`` turns it off).
    """
    versions = dim_cust.select(
        F.col("customer_id").alias("_c_id"),
        "customer_sk",
        F.col(START).alias("_c_start"),
        F.col(END).alias("_c_end"),
    )
    return point_in_time_join(
        orders, versions, "customer_id", "_c_id", "order_timestamp", "_c_start", "_c_end",
        skew_fraction=skew_fraction, hot=hot, spread=spread,
    ).drop("_c_id", "_c_start", "_c_end")


def fct_sales(
    order_items: DataFrame,
    orders: DataFrame,
    dim_cust: DataFrame,
    dim_prod: DataFrame,
    dim_wh: DataFrame,
    warehouse_from: str = "orders",
    lookup_skew_fraction: float | None = None,
    hot_customers: DataFrame | None = None,
) -> DataFrame:
    """Order-line grain sales fact (J1 + J3 + 2 x J2).

    ``warehouse_from`` names the side that carries ``warehouse_id``
    ('orders' in the retail model, 'items' when lines ship from a supplier).
    Customers are always salted when hot.  Product and warehouse lookups are
    broadcast by AQE when the dimension is small and split by AQE's skew join
    when it is read from its table; ``lookup_skew_fraction`` additionally
    salts hot products/warehouses (for large dimensions inside one plan).
    ``hot_customers`` (column ``_hot_key``) spares counting them on ``orders``.
    Lines without a product or warehouse are spread over the shuffles.
    """
    o_cols = ["order_id", "customer_id", "order_timestamp", "status"]
    i_cols = ["order_item_id", "order_id", "product_id", "quantity", "unit_price"]
    if warehouse_from == "orders":
        o_cols.append("warehouse_id")
    else:
        i_cols.append("warehouse_id")
    headers = resolve_customer_version(
        orders.select(*o_cols).withColumnRenamed("order_id", "_o_id"), dim_cust, hot=hot_customers, spread=["_o_id"]
    )
    items = order_items.select(*i_cols)
    lines = items.join(headers, F.col("order_id") == F.col("_o_id"), "inner")
    prod = dim_prod.select(F.col("product_id").alias("_p_id"), "product_sk")
    wh = dim_wh.select(F.col("warehouse_id").alias("_w_id"), "warehouse_sk")
    # hot products / warehouses are counted on the item input (same key
    # distribution as the joined lines, one cheap aggregate) and salted
    f = lookup_skew_fraction
    joined = lookup_join(
        lines, prod, "product_id", "_p_id", skew_fraction=f,
        hot=hot_keys(items, "product_id", f) if f else None, spread=["order_item_id"],
    )
    wh_source = headers if warehouse_from == "orders" else items
    joined = lookup_join(
        joined, wh, "warehouse_id", "_w_id", skew_fraction=f,
        hot=hot_keys(wh_source, "warehouse_id", f) if f else None, spread=["order_item_id"],
    )
    return joined.select(
        "order_item_id",
        "order_id",
        "customer_sk",
        "product_sk",
        "warehouse_sk",
        S.date_key("order_timestamp").alias("date_key"),
        "order_timestamp",
        F.col("status").alias("order_status"),
        "quantity",
        "unit_price",
        S.line_amount("quantity", "unit_price").alias("line_amount"),
    )


def fct_inventory_movements(
    events: DataFrame,
    dim_wh: DataFrame,
    dim_prod: DataFrame,
    lookup_skew_fraction: float | None = None,
) -> DataFrame:
    """Event-grain inventory fact (2 x J2); lookups as in :func:`fct_sales`."""
    wh = dim_wh.select(F.col("warehouse_id").alias("_w_id"), "warehouse_sk")
    prod = dim_prod.select(F.col("product_id").alias("_p_id"), "product_sk")
    f = lookup_skew_fraction
    joined = lookup_join(events, wh, "warehouse_id", "_w_id", skew_fraction=f, spread=["event_id"])
    joined = lookup_join(
        joined, prod, "product_id", "_p_id", skew_fraction=f,
        hot=hot_keys(events, "product_id", f) if f else None, spread=["event_id"],
    )
    return joined.select(
        "event_id",
        "warehouse_sk",
        "product_sk",
        S.date_key("event_timestamp").alias("date_key"),
        "event_timestamp",
        "event_type",
        "quantity_change",
    )


def unresolved_sales(fct: DataFrame) -> DataFrame:
    """Order lines that resolved no customer version."""
    return fct.where(F.col("customer_sk").isNull()).select(
        "order_item_id", "order_id", "order_timestamp"
    )


def sales_by_customer_version(fct: DataFrame, dim_cust: DataFrame) -> DataFrame:
    """D8 (J8 + J9): lines of customers with more than one version, with the
    attributes of the version each line resolved to."""
    multi = multi_version_keys(dim_cust, "customer_id")
    cust = dim_cust.join(multi, "customer_id", "left_semi").select(
        "customer_sk", "customer_id", "email"
    )
    return fct.join(cust, "customer_sk", "inner").select(
        "order_item_id", "order_timestamp", "customer_id", "email", "line_amount"
    )


def net_stock_movement(fct_inv: DataFrame, dim_wh: DataFrame, dim_prod: DataFrame) -> DataFrame:
    """D11 (J9 + A6): net signed movement per warehouse name and product name.

    The fact is pre-aggregated on its surrogate keys first, so the name joins
    touch one row per (warehouse, product) pair instead of one per event.
    """
    per_key = fct_inv.groupBy("warehouse_sk", "product_sk").agg(
        F.sum("quantity_change").alias("_net")
    )
    return (
        per_key.join(dim_wh.select("warehouse_sk", "warehouse_name"), "warehouse_sk")
        .join(dim_prod.select("product_sk", "product_name"), "product_sk")
        .groupBy("warehouse_name", "product_name")
        .agg(F.sum("_net").alias("net_movement"))
    )
