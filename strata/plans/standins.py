"""Raw (Bronze-shaped) retail entities derived from the driver's TPC-H-like tables.

The retail model has six source entities.  The benchmark data has other
tables, so each entity is derived from them by a fixed mapping.  Business keys
are strings (as in the model); numbers and timestamps keep their Parquet types,
which is the shape of a typed Parquet landing (the CSV landing is all strings
and is exercised through the Bronze readers).  Every mapping reads its whole
source table; nothing is sampled.

| entity           | derived from                                   |
|------------------|------------------------------------------------|
| customers (feed) | orders x customer x nation x region: one change row per order; the order
|                  | priority is the changing contact attribute ('4-NOT SPECIFIED' arrives
|                  | blank); batch = order year; times are texts      |
| products         | part                                           |
| warehouses       | supplier x nation x region                     |
| orders           | orders (status F/O map to completed/pending; P is not an accepted status) |
| order_items      | lineitem; key order-line; returned open lines carry a negative quantity;
|                  | unit price = extended price / quantity, to the cent; ships from the supplier |
| inventory_events | events: signup -> inbound, purchase -> outbound (negated), error ->
|                  | adjustment, other types unaccepted; warehouse/product = user_id modulo
|                  | the number of suppliers/parts                   |
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

# Bad values as sources send them, by divisor and remainder of the row's key: change rows without a customer or with
# a time that is none, products priced in words or below zero, warehouses without a name.
NO_CUSTOMER, NO_TIME = (149, 0), (151, 0)
PRICE_IN_WORDS, PRICE_BELOW_ZERO = (97, 5), (89, 1)
NO_NAME = (9, 4)

TABLES = [
    "region", "nation", "customer", "supplier", "part", "orders", "lineitem", "events",
    "documents", "embeddings", "pages", "benchmark", "labels", "conversations",
]


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def _s(c) -> F.Column:
    return (F.col(c) if isinstance(c, str) else c).cast("string")


def planted(key: str, rule: tuple[int, int]) -> F.Column:
    return F.col(key) % rule[0] == rule[1]


def geography(spark: SparkSession, sf_dir: str) -> DataFrame:
    """nation x region (25 rows): (n_nationkey, n_name, r_name)."""
    nation = table(spark, sf_dir, "nation")
    region = table(spark, sf_dir, "region")
    return nation.join(region, nation.n_regionkey == region.r_regionkey).select(
        "n_nationkey", "n_name", "r_name"
    )


def raw_customers(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Customer change feed: one row per order, batch = order year."""
    orders = table(spark, sf_dir, "orders").select("o_orderkey", "o_custkey", "o_orderdate", "o_orderpriority")
    cust = table(spark, sf_dir, "customer").select("c_custkey", "c_name", "c_nationkey", "c_mktsegment")
    geo = geography(spark, sf_dir)
    cust_geo = cust.join(geo, cust.c_nationkey == geo.n_nationkey, "left")
    # the order's own columns before the join: an aggregate of them alone is planned without the customers
    changes = orders.select(
        "o_custkey",
        F.when(~planted("o_orderkey", NO_CUSTOMER), _s("o_custkey")).alias("customer_id"),
        F.when(F.col("o_orderpriority") == "4-NOT SPECIFIED", F.lit("  "))
        .otherwise(F.col("o_orderpriority"))
        .alias("email"),
        F.when(planted("o_orderkey", NO_TIME), "not known").otherwise(F.date_format("o_orderdate", "yyyy-MM-dd HH:mm:ss")).alias("updated_at"),
        _s(F.year("o_orderdate")).alias("batch_id"),
    )
    feed = changes.join(cust_geo, changes.o_custkey == cust_geo.c_custkey, "left")
    return feed.select(
        "customer_id",
        "email",
        F.col("c_name").alias("customer_name"),
        F.col("c_mktsegment").alias("segment"),
        F.col("n_name").alias("city"),
        F.col("r_name").alias("region"),
        "updated_at",
        "batch_id",
    )


def raw_products(spark: SparkSession, sf_dir: str) -> DataFrame:
    part = table(spark, sf_dir, "part")
    return part.select(
        _s("p_partkey").alias("product_id"),
        F.col("p_name").alias("product_name"),
        F.col("p_type").alias("category"),
        F.when(planted("p_partkey", PRICE_IN_WORDS), "on request")
        .when(planted("p_partkey", PRICE_BELOW_ZERO), _s(-F.col("p_retailprice")))
        .otherwise(_s("p_retailprice"))
        .alias("unit_price"),
        F.lit(None).cast("timestamp_ntz").alias("updated_at"),
    )


def raw_warehouses(spark: SparkSession, sf_dir: str) -> DataFrame:
    supp = table(spark, sf_dir, "supplier").select("s_suppkey", "s_name", "s_nationkey")
    geo = geography(spark, sf_dir)
    return supp.join(geo, supp.s_nationkey == geo.n_nationkey, "left").select(
        _s("s_suppkey").alias("warehouse_id"),
        F.when(planted("s_suppkey", NO_NAME), "  ").otherwise(F.col("s_name")).alias("warehouse_name"),
        F.col("n_name").alias("city"),
        F.col("r_name").alias("region"),
    )


def raw_orders(spark: SparkSession, sf_dir: str) -> DataFrame:
    orders = table(spark, sf_dir, "orders")
    status = (
        F.when(F.col("o_orderstatus") == "F", F.lit(" completed"))
        .when(F.col("o_orderstatus") == "O", F.lit("Pending "))
        .otherwise(F.col("o_orderstatus"))
    )
    return orders.select(
        _s("o_orderkey").alias("order_id"),
        _s("o_custkey").alias("customer_id"),
        F.col("o_orderdate").alias("order_timestamp"),
        status.alias("status"),
    )


def unit_price_cents(extended_price: str, quantity: str) -> F.Column:
    """Extended price / quantity rounded half-up to the cent, in integer cents.

    Integer arithmetic keeps the value exact on every engine.
    """
    cents = f"CAST(ROUND({extended_price} * 100) AS BIGINT)"
    q = f"CAST({quantity} AS BIGINT)"
    return F.expr(f"({cents} * 2 + {q}) div ({q} * 2)")


def raw_order_items(spark: SparkSession, sf_dir: str) -> DataFrame:
    li = table(spark, sf_dir, "lineitem")
    qty = F.col("l_quantity").cast("int")
    signed_qty = F.when(
        (F.col("l_returnflag") == "R") & (F.col("l_linestatus") == "O"), -qty
    ).otherwise(qty)
    unit_price = unit_price_cents("l_extendedprice", "l_quantity") / 100.0
    return li.select(
        F.concat_ws("-", _s("l_orderkey"), _s("l_linenumber")).alias("order_item_id"),
        _s("l_orderkey").alias("order_id"),
        _s("l_partkey").alias("product_id"),
        _s("l_suppkey").alias("warehouse_id"),
        signed_qty.alias("quantity"),
        unit_price.alias("unit_price"),
        F.col("l_shipdate").alias("updated_at"),
    )


def raw_inventory_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    ev = table(spark, sf_dir, "events")
    n_supp = table(spark, sf_dir, "supplier").select(F.count(F.lit(1))).scalar()
    n_part = table(spark, sf_dir, "part").select(F.count(F.lit(1))).scalar()
    et = F.col("event_type")
    mapped = (
        F.when(et == "signup", F.lit("inbound"))
        .when(et == "purchase", F.lit("OUTBOUND"))
        .when(et == "error", F.lit(" adjustment"))
        .otherwise(et)
    )
    q = F.floor(F.col("value")).cast("int")
    qty = F.when(et == "purchase", -q).otherwise(q)
    return ev.select(
        _s("event_id").alias("event_id"),
        _s(F.col("user_id") % n_supp).alias("warehouse_id"),
        _s(F.col("user_id") % n_part).alias("product_id"),
        mapped.alias("event_type"),
        qty.alias("quantity_change"),
        F.col("ts").alias("event_timestamp"),
    )


RAW_BUILDERS = {
    "customers": raw_customers,
    "products": raw_products,
    "warehouses": raw_warehouses,
    "orders": raw_orders,
    "order_items": raw_order_items,
    "inventory_events": raw_inventory_events,
}
