"""Independent DuckDB SQL for every registered query (the correctness oracle).

Each query is plain ANSI-ish SQL over the driver's tables.  Shared steps are
named CTEs; ``sql(final, *ctes)`` prepends the CTEs a query needs (with their
dependencies, in order).
"""

from __future__ import annotations

import re

EOT = "TIMESTAMP '9999-12-31 23:59:59'"

_CTES: dict[str, tuple[str, list[str]]] = {}


def cte(name: str, body: str, deps: list[str] | None = None) -> None:
    _CTES[name] = (body, deps or [])


def _resolve(names: list[str], out: list[str]) -> None:
    for n in names:
        if n in out:
            continue
        _resolve(_CTES[n][1], out)
        if n not in out:
            out.append(n)


def sql(final: str, *needs: str) -> str:
    order: list[str] = []
    _resolve(list(needs), order)
    if not order:
        return final
    parts = [f"{n} AS (\n{_CTES[n][0]}\n)" for n in order]
    return "WITH " + ",\n".join(parts) + "\n" + final


def nt(expr: str) -> str:
    """trim_to_null"""
    return f"NULLIF(TRIM({expr}), '')"


def dedup(src: str, keys: str, order: str) -> str:
    return (
        f"SELECT * EXCLUDE (_rn) FROM (SELECT *, row_number() OVER "
        f"(PARTITION BY {keys} ORDER BY {order}) AS _rn FROM {src}) WHERE _rn = 1"
    )


def dn(*cols: str) -> str:
    return ", ".join(f"{c} DESC NULLS LAST" for c in cols)


# --------------------------------------------------------------------------
# customers feed -> history
cte("geo", "SELECT n.n_nationkey, n.n_name, r.r_name FROM nation n JOIN region r ON n.n_regionkey = r.r_regionkey")
cte(
    "cust_raw",
    """SELECT CASE WHEN o.o_orderkey % 149 <> 0 THEN CAST(o.o_custkey AS VARCHAR) END AS customer_id,
       CASE WHEN o.o_orderpriority = '4-NOT SPECIFIED' THEN '  ' ELSE o.o_orderpriority END AS email,
       c.c_name AS customer_name, c.c_mktsegment AS segment, g.n_name AS city, g.r_name AS region,
       CASE WHEN o.o_orderkey % 151 = 0 THEN 'not known' ELSE strftime(o.o_orderdate, '%Y-%m-%d %H:%M:%S') END AS updated_at,
       CAST(year(o.o_orderdate) AS VARCHAR) AS batch_id
FROM orders o
LEFT JOIN (customer c LEFT JOIN geo g ON c.c_nationkey = g.n_nationkey) ON o.o_custkey = c.c_custkey""",
    ["geo"],
)
cte(
    "cust_typed",
    f"""SELECT customer_id, {nt('email')} AS email, {nt('customer_name')} AS customer_name,
       {nt('segment')} AS segment, {nt('city')} AS city, {nt('region')} AS region,
       TRY_CAST(updated_at AS TIMESTAMP) AS updated_at, batch_id
FROM cust_raw""",
    ["cust_raw"],
)
cte(
    "feed",
    "SELECT * FROM cust_typed WHERE customer_id IS NOT NULL AND updated_at IS NOT NULL AND batch_id IS NOT NULL",
    ["cust_typed"],
)
cte(
    "feed_bad",
    """SELECT *, 'null customer_id, updated_at, or batch_id' AS quarantine_reason,
       concat_ws(',', CASE WHEN customer_id IS NULL THEN 'customer_id_not_null' END,
                      CASE WHEN updated_at IS NULL THEN 'updated_at_not_null' END,
                      CASE WHEN batch_id IS NULL THEN 'batch_id_not_null' END) AS failed_rules
FROM cust_typed WHERE NOT (customer_id IS NOT NULL AND updated_at IS NOT NULL AND batch_id IS NOT NULL)""",
    ["cust_typed"],
)
cte(
    "feed_latest",
    dedup("feed", "batch_id, customer_id", dn("updated_at", "email", "customer_name", "segment", "city", "region")),
    ["feed"],
)
cte("batch_order", "SELECT batch_id, min(updated_at) AS bts FROM feed GROUP BY batch_id", ["feed"])
cte(
    "changes",
    """SELECT * EXCLUDE (_k, p_email, p_name, p_segment, p_city, p_region) FROM (
  SELECT l.*, b.bts,
         row_number() OVER w AS _k,
         lag(email) OVER w AS p_email, lag(customer_name) OVER w AS p_name,
         lag(segment) OVER w AS p_segment, lag(city) OVER w AS p_city, lag(region) OVER w AS p_region
  FROM feed_latest l JOIN batch_order b ON l.batch_id = b.batch_id
  WINDOW w AS (PARTITION BY l.customer_id ORDER BY b.bts, l.batch_id)
) WHERE _k = 1 OR email IS DISTINCT FROM p_email OR customer_name IS DISTINCT FROM p_name
   OR segment IS DISTINCT FROM p_segment OR city IS DISTINCT FROM p_city OR region IS DISTINCT FROM p_region""",
    ["feed_latest", "batch_order"],
)
cte(
    "history",
    f"""SELECT md5(concat_ws('|', customer_id, CAST(updated_at AS VARCHAR))) AS customer_sk,
       customer_id, email, customer_name, segment, city, region,
       updated_at AS effective_start_timestamp,
       coalesce(lead(updated_at) OVER w, {EOT}) AS effective_end_timestamp,
       lead(updated_at) OVER w IS NULL AS is_current
FROM changes
WINDOW w AS (PARTITION BY customer_id ORDER BY bts, batch_id)""",
    ["changes"],
)

# --------------------------------------------------------------------------
# products / warehouses / orders / items / inventory events
cte(
    "products_typed",
    f"""SELECT CAST(p_partkey AS VARCHAR) AS product_id, {nt('p_name')} AS product_name,
       {nt('p_type')} AS category, CASE WHEN p_partkey % 97 = 5 THEN NULL WHEN p_partkey % 89 = 1 THEN -p_retailprice ELSE p_retailprice END AS unit_price,
       CAST(NULL AS TIMESTAMP) AS updated_at
FROM part""",
)
cte("products_dedup", dedup("products_typed", "product_id", dn("updated_at", "product_name", "category", "unit_price")), ["products_typed"])
PRODUCTS_OK = "(product_id IS NOT NULL AND unit_price IS NOT NULL AND unit_price >= 0)"
cte("products_clean", f"SELECT * FROM products_dedup WHERE coalesce({PRODUCTS_OK}, false)", ["products_dedup"])
cte(
    "products_bad",
    f"""SELECT *, 'null product_id / missing or negative unit_price' AS quarantine_reason,
       concat_ws(',', CASE WHEN product_id IS NULL THEN 'product_id_not_null' END,
                      CASE WHEN unit_price IS NULL THEN 'unit_price_not_null' END,
                      CASE WHEN NOT coalesce(unit_price >= 0, false) THEN 'unit_price_non_negative' END) AS failed_rules
FROM products_dedup WHERE NOT coalesce({PRODUCTS_OK}, false)""",
    ["products_dedup"],
)
cte(
    "dim_product",
    "SELECT md5(product_id) AS product_sk, product_id, product_name, category, unit_price AS list_unit_price FROM products_clean",
    ["products_clean"],
)

cte(
    "warehouses_typed",
    f"""SELECT CAST(s.s_suppkey AS VARCHAR) AS warehouse_id, CASE WHEN s.s_suppkey % 9 <> 4 THEN {nt('s.s_name')} END AS warehouse_name,
       {nt('g.n_name')} AS city, {nt('g.r_name')} AS region
FROM supplier s LEFT JOIN geo g ON s.s_nationkey = g.n_nationkey""",
    ["geo"],
)
cte("warehouses_dedup", dedup("warehouses_typed", "warehouse_id", dn("warehouse_name", "city", "region")), ["warehouses_typed"])
WAREHOUSES_OK = "(warehouse_id IS NOT NULL AND warehouse_name IS NOT NULL)"
cte("warehouses_clean", f"SELECT * FROM warehouses_dedup WHERE coalesce({WAREHOUSES_OK}, false)", ["warehouses_dedup"])
cte(
    "warehouses_bad",
    f"""SELECT *, 'null warehouse_id or warehouse_name' AS quarantine_reason,
       concat_ws(',', CASE WHEN warehouse_id IS NULL THEN 'warehouse_id_not_null' END,
                      CASE WHEN warehouse_name IS NULL THEN 'warehouse_name_not_null' END) AS failed_rules
FROM warehouses_dedup WHERE NOT coalesce({WAREHOUSES_OK}, false)""",
    ["warehouses_dedup"],
)
cte(
    "dim_warehouse",
    "SELECT md5(warehouse_id) AS warehouse_sk, warehouse_id, warehouse_name, city, region FROM warehouses_clean",
    ["warehouses_clean"],
)

cte(
    "orders_typed",
    """SELECT CAST(o_orderkey AS VARCHAR) AS order_id, CAST(o_custkey AS VARCHAR) AS customer_id,
       o_orderdate AS order_timestamp,
       upper(trim(CASE o_orderstatus WHEN 'F' THEN ' completed' WHEN 'O' THEN 'Pending ' ELSE o_orderstatus END)) AS status
FROM orders""",
)
cte("orders_dedup", dedup("orders_typed", "order_id", dn("customer_id", "order_timestamp", "status")), ["orders_typed"])
ORDERS_OK = (
    "(order_id IS NOT NULL AND customer_id IS NOT NULL AND order_timestamp IS NOT NULL "
    "AND status IN ('COMPLETED', 'PENDING', 'CANCELLED'))"
)
cte("orders_clean", f"SELECT * FROM orders_dedup WHERE coalesce({ORDERS_OK}, false)", ["orders_dedup"])
cte(
    "orders_bad",
    f"""SELECT *, 'null keys / invalid timestamp / unaccepted status' AS quarantine_reason,
       concat_ws(',', CASE WHEN order_id IS NULL THEN 'order_id_not_null' END,
                      CASE WHEN customer_id IS NULL THEN 'customer_id_not_null' END,
                      CASE WHEN order_timestamp IS NULL THEN 'order_timestamp_not_null' END,
                      CASE WHEN NOT coalesce(status IN ('COMPLETED', 'PENDING', 'CANCELLED'), false)
                           THEN 'status_accepted' END) AS failed_rules
FROM orders_dedup WHERE NOT coalesce({ORDERS_OK}, false)""",
    ["orders_dedup"],
)

cte(
    "items_typed",
    """SELECT concat_ws('-', CAST(l_orderkey AS VARCHAR), CAST(l_linenumber AS VARCHAR)) AS order_item_id,
       CAST(l_orderkey AS VARCHAR) AS order_id, CAST(l_partkey AS VARCHAR) AS product_id,
       CAST(l_suppkey AS VARCHAR) AS warehouse_id,
       CASE WHEN l_returnflag = 'R' AND l_linestatus = 'O' THEN -CAST(l_quantity AS INTEGER)
            ELSE CAST(l_quantity AS INTEGER) END AS quantity,
       CAST((CAST(ROUND(l_extendedprice * 100) AS BIGINT) * 2 + CAST(l_quantity AS BIGINT))
            // (CAST(l_quantity AS BIGINT) * 2) AS DOUBLE) / CAST(100 AS DOUBLE) AS unit_price,
       l_shipdate AS updated_at
FROM lineitem""",
)
cte(
    "items_dedup",
    dedup("items_typed", "order_item_id", dn("updated_at", "order_id", "product_id", "warehouse_id", "quantity", "unit_price")),
    ["items_typed"],
)
ITEMS_OK = (
    "(order_item_id IS NOT NULL AND order_id IS NOT NULL AND product_id IS NOT NULL "
    "AND quantity IS NOT NULL AND quantity > 0 AND unit_price >= 0)"
)
cte("items_clean", f"SELECT * FROM items_dedup WHERE coalesce({ITEMS_OK}, false)", ["items_dedup"])
cte(
    "items_bad",
    f"""SELECT *, 'null keys / non-positive quantity / negative price' AS quarantine_reason,
       concat_ws(',', CASE WHEN order_item_id IS NULL THEN 'order_item_id_not_null' END,
                      CASE WHEN order_id IS NULL THEN 'order_id_not_null' END,
                      CASE WHEN product_id IS NULL THEN 'product_id_not_null' END,
                      CASE WHEN quantity IS NULL THEN 'quantity_not_null' END,
                      CASE WHEN NOT coalesce(quantity > 0, false) THEN 'quantity_positive' END,
                      CASE WHEN NOT coalesce(unit_price >= 0, false) THEN 'unit_price_non_negative' END) AS failed_rules
FROM items_dedup WHERE NOT coalesce({ITEMS_OK}, false)""",
    ["items_dedup"],
)

cte(
    "events_typed",
    """SELECT CAST(event_id AS VARCHAR) AS event_id,
       CAST(user_id % (SELECT count(*) FROM supplier) AS VARCHAR) AS warehouse_id,
       CAST(user_id % (SELECT count(*) FROM part) AS VARCHAR) AS product_id,
       upper(trim(CASE event_type WHEN 'signup' THEN 'inbound' WHEN 'purchase' THEN 'OUTBOUND'
                                  WHEN 'error' THEN ' adjustment' ELSE event_type END)) AS event_type,
       CASE WHEN event_type = 'purchase' THEN -CAST(floor(value) AS INTEGER)
            ELSE CAST(floor(value) AS INTEGER) END AS quantity_change,
       ts AS event_timestamp
FROM events""",
)
cte(
    "events_dedup",
    dedup("events_typed", "event_id", dn("event_timestamp", "warehouse_id", "product_id", "event_type", "quantity_change")),
    ["events_typed"],
)
SIGN_OK = (
    "((event_type = 'INBOUND' AND quantity_change > 0) OR (event_type = 'OUTBOUND' AND quantity_change < 0) "
    "OR event_type = 'ADJUSTMENT')"
)
EVENTS_OK = (
    "(event_id IS NOT NULL AND event_timestamp IS NOT NULL AND event_type IN ('INBOUND', 'OUTBOUND', 'ADJUSTMENT') "
    f"AND quantity_change IS NOT NULL AND {SIGN_OK})"
)
cte("events_clean", f"SELECT * FROM events_dedup WHERE coalesce({EVENTS_OK}, false)", ["events_dedup"])
cte(
    "events_bad",
    f"""SELECT *, 'null keys / invalid type / sign rule violation' AS quarantine_reason,
       concat_ws(',', CASE WHEN event_id IS NULL THEN 'event_id_not_null' END,
                      CASE WHEN event_timestamp IS NULL THEN 'event_timestamp_not_null' END,
                      CASE WHEN NOT coalesce(event_type IN ('INBOUND', 'OUTBOUND', 'ADJUSTMENT'), false)
                           THEN 'event_type_accepted' END,
                      CASE WHEN quantity_change IS NULL THEN 'quantity_change_not_null' END,
                      CASE WHEN NOT coalesce({SIGN_OK}, false) THEN 'sign_rule' END) AS failed_rules
FROM events_dedup WHERE NOT coalesce({EVENTS_OK}, false)""",
    ["events_dedup"],
)

# --------------------------------------------------------------------------
# Gold
cte(
    "dim_date",
    """SELECT CAST(strftime(d, '%Y%m%d') AS INTEGER) AS date_key, d AS date, CAST(year(d) AS INTEGER) AS year,
       CAST(quarter(d) AS INTEGER) AS quarter, CAST(month(d) AS INTEGER) AS month,
       CAST(day(d) AS INTEGER) AS day_of_month,
       strftime(d, '%A') AS day_name, dayofweek(d) IN (0, 6) AS is_weekend
FROM (
  SELECT CAST(unnest(generate_series(CAST(min_date AS TIMESTAMP), CAST(max_date AS TIMESTAMP), INTERVAL 1 DAY)) AS DATE) AS d
  FROM (
    SELECT min(d0) AS min_date, max(d1) AS max_date FROM (
      SELECT min(CAST(order_timestamp AS DATE)) AS d0, max(CAST(order_timestamp AS DATE)) AS d1 FROM orders_clean
      UNION ALL
      SELECT min(CAST(event_timestamp AS DATE)), max(CAST(event_timestamp AS DATE)) FROM events_clean
    )
  )
)""",
    ["orders_clean", "events_clean"],
)
cte(
    "fct_sales",
    """SELECT oi.order_item_id, oi.order_id, c.customer_sk, p.product_sk, w.warehouse_sk,
       CAST(strftime(o.order_timestamp, '%Y%m%d') AS INTEGER) AS date_key,
       o.order_timestamp, o.status AS order_status, oi.quantity, oi.unit_price,
       CAST(ROUND(CAST(oi.quantity AS DECIMAL(12,0)) * CAST(oi.unit_price AS DECIMAL(20,6)), 2) AS DOUBLE) AS line_amount
FROM items_clean oi
JOIN orders_clean o ON oi.order_id = o.order_id
LEFT JOIN history c ON o.customer_id = c.customer_id
       AND o.order_timestamp >= c.effective_start_timestamp
       AND o.order_timestamp < c.effective_end_timestamp
LEFT JOIN dim_product p ON oi.product_id = p.product_id
LEFT JOIN dim_warehouse w ON oi.warehouse_id = w.warehouse_id""",
    ["items_clean", "orders_clean", "history", "dim_product", "dim_warehouse"],
)
cte(
    "fct_inv",
    """SELECT e.event_id, w.warehouse_sk, p.product_sk,
       CAST(strftime(e.event_timestamp, '%Y%m%d') AS INTEGER) AS date_key,
       e.event_timestamp, e.event_type, e.quantity_change
FROM events_clean e
LEFT JOIN dim_warehouse w ON e.warehouse_id = w.warehouse_id
LEFT JOIN dim_product p ON e.product_id = p.product_id""",
    ["events_clean", "dim_warehouse", "dim_product"],
)


ORACLE: dict[str, str] = {
    "trim_to_null": sql(
        f"SELECT customer_id, {', '.join(f'{nt(c)} AS {c}' for c in ('email', 'customer_name', 'segment', 'city', 'region'))}, updated_at, batch_id FROM cust_raw",
        "cust_raw",
    ),
    "dedup_latest": sql("SELECT * FROM items_dedup", "items_dedup"),
    "clean_products": sql("SELECT * FROM products_clean", "products_clean"),
    "clean_warehouses": sql("SELECT * FROM warehouses_clean", "warehouses_clean"),
    "clean_orders": sql("SELECT * FROM orders_clean", "orders_clean"),
    "clean_order_items": sql("SELECT * FROM items_clean", "items_clean"),
    "clean_inventory_events": sql("SELECT * FROM events_clean", "events_clean"),
    "quarantine_products": sql("SELECT * FROM products_bad", "products_bad"),
    "quarantine_orders": sql("SELECT * FROM orders_bad", "orders_bad"),
    "quarantine_warehouses": sql("SELECT * FROM warehouses_bad", "warehouses_bad"),
    "quarantine_order_items": sql("SELECT * FROM items_bad", "items_bad"),
    "quarantine_inventory_events": sql("SELECT * FROM events_bad", "events_bad"),
    "quarantine_customers": sql("SELECT * FROM feed_bad", "feed_bad"),
    "customer_changes": sql(
        "SELECT customer_id, email, customer_name, segment, city, region, updated_at, batch_id FROM changes",
        "changes",
    ),
    "customer_history": sql("SELECT * FROM history", "history"),
    "history_version_counts": sql(
        "SELECT customer_id, count(*) AS version_count FROM history GROUP BY customer_id", "history"
    ),
    "dim_customer": sql("SELECT * FROM history", "history"),
    "dim_product": sql("SELECT * FROM dim_product", "dim_product"),
    "dim_warehouse": sql("SELECT * FROM dim_warehouse", "dim_warehouse"),
    "dim_date": sql("SELECT * FROM dim_date", "dim_date"),
    "fct_sales": sql("SELECT * FROM fct_sales", "fct_sales"),
    "fct_inventory_movements": sql("SELECT * FROM fct_inv", "fct_inv"),
    "sales_unresolved": sql(
        "SELECT order_item_id, order_id, order_timestamp FROM fct_sales WHERE customer_sk IS NULL", "fct_sales"
    ),
    "sales_by_customer_version": sql(
        """SELECT f.order_item_id, f.order_timestamp, c.customer_id, c.email, f.line_amount
FROM fct_sales f JOIN history c ON f.customer_sk = c.customer_sk
WHERE c.customer_id IN (SELECT customer_id FROM history GROUP BY customer_id HAVING count(*) > 1)""",
        "fct_sales",
        "history",
    ),
    "report_customer_history": sql(
        """SELECT * EXCLUDE (customer_sk), row_number() OVER (ORDER BY customer_id, effective_start_timestamp, email NULLS FIRST, customer_name NULLS FIRST,
       segment NULLS FIRST, city NULLS FIRST, region NULLS FIRST, effective_end_timestamp, is_current) AS rank FROM history""",
        "history",
    ),
    "report_sales_by_version": sql(
        """SELECT f.order_item_id, f.order_timestamp, c.customer_id, c.email, f.line_amount,
       row_number() OVER (ORDER BY c.customer_id, f.order_timestamp NULLS FIRST, f.order_item_id) AS rank
FROM fct_sales f JOIN history c ON f.customer_sk = c.customer_sk
WHERE c.customer_id IN (SELECT customer_id FROM history GROUP BY customer_id HAVING count(*) > 1)""",
        "fct_sales",
        "history",
    ),
    "report_batch_counts": sql(
        "SELECT batch_id, count(*) AS n, row_number() OVER (ORDER BY batch_id NULLS FIRST) AS rank FROM cust_raw GROUP BY batch_id", "cust_raw"
    ),
    "report_top_stock": sql(
        """SELECT w.warehouse_name, p.product_name, CAST(sum(f.quantity_change) AS BIGINT) AS net_movement,
       row_number() OVER (ORDER BY sum(f.quantity_change) DESC, w.warehouse_name NULLS FIRST, p.product_name NULLS FIRST) AS rank
FROM fct_inv f JOIN dim_warehouse w ON f.warehouse_sk = w.warehouse_sk
JOIN dim_product p ON f.product_sk = p.product_sk
GROUP BY w.warehouse_name, p.product_name ORDER BY rank LIMIT 100""",
        "fct_inv",
        "dim_warehouse",
        "dim_product",
    ),
    "net_stock_movement": sql(
        """SELECT w.warehouse_name, p.product_name, CAST(sum(f.quantity_change) AS BIGINT) AS net_movement
FROM fct_inv f JOIN dim_warehouse w ON f.warehouse_sk = w.warehouse_sk
JOIN dim_product p ON f.product_sk = p.product_sk
GROUP BY w.warehouse_name, p.product_name""",
        "fct_inv",
        "dim_warehouse",
        "dim_product",
    ),
}


# --------------------------------------------------------------------------
# checks: (check_name, observed, expected) -> + passed
def chk(body: str) -> str:
    return (
        "SELECT check_name, CAST(observed AS BIGINT) AS observed, CAST(expected AS BIGINT) AS expected,\n"
        "       CASE WHEN expected IS NULL THEN observed > 0 ELSE coalesce(observed = expected, false) END AS passed\n"
        f"FROM (\n{body}\n)"
    )


def row(name: str, observed: str, expected: str = "0") -> str:
    return f"SELECT '{name}' AS check_name, ({observed}) AS observed, {expected} AS expected"


def union(*rows: str) -> str:
    return "\nUNION ALL\n".join(rows)


def dup_keys(table: str, key: str) -> str:
    """Rows beyond one per key (0 when the key is unique)."""
    return f"SELECT count(*) - count(DISTINCT {key}) FROM {table}"


def orphans(fact: str, fk: str, dim: str, dk: str) -> str:
    return f"SELECT count(*) FROM {fact} f WHERE NOT EXISTS (SELECT 1 FROM {dim} d WHERE d.{dk} = f.{fk})"


CORE = [
    ("silver.customers_history", "history"),
    ("silver.products_clean", "products_clean"),
    ("silver.warehouses_clean", "warehouses_clean"),
    ("silver.orders_clean", "orders_clean"),
    ("silver.order_items_clean", "items_clean"),
    ("silver.inventory_events_clean", "events_clean"),
    ("gold.dim_customer", "history"),
    ("gold.dim_product", "dim_product"),
    ("gold.dim_warehouse", "dim_warehouse"),
    ("gold.dim_date", "dim_date"),
    ("gold.fct_sales", "fct_sales"),
    ("gold.fct_inventory_movements", "fct_inv"),
]

cte(
    "chk_grain",
    chk(union(
        *[row(f"rows present: {n}", f"SELECT count(*) FROM {t}", "NULL") for n, t in CORE],
        row("row count: fct_sales = silver.order_items_clean", "SELECT count(*) FROM fct_sales", "(SELECT count(*) FROM items_clean)"),
        row("repeated keys: fct_sales.order_item_id", dup_keys("fct_sales", "order_item_id")),
        row("row count: fct_inventory_movements = silver.inventory_events_clean", "SELECT count(*) FROM fct_inv", "(SELECT count(*) FROM events_clean)"),
        row("repeated keys: fct_inventory_movements.event_id", dup_keys("fct_inv", "event_id")),
        row("missing customer version: fct_sales", "SELECT count(*) FROM fct_sales WHERE customer_sk IS NULL"),
    )),
    ["history", "products_clean", "warehouses_clean", "orders_clean", "items_clean", "events_clean",
     "dim_product", "dim_warehouse", "dim_date", "fct_sales", "fct_inv"],
)
cte(
    "chk_keys",
    chk(union(
        row("distinct = rows: dim_customer.customer_sk", "SELECT count(DISTINCT customer_sk) FROM history", "(SELECT count(*) FROM history)"),
        row("distinct = rows: dim_product.product_sk", "SELECT count(DISTINCT product_sk) FROM dim_product", "(SELECT count(*) FROM dim_product)"),
        row("distinct = rows: dim_warehouse.warehouse_sk", "SELECT count(DISTINCT warehouse_sk) FROM dim_warehouse", "(SELECT count(*) FROM dim_warehouse)"),
        row("distinct = rows: dim_date.date_key", "SELECT count(DISTINCT date_key) FROM dim_date", "(SELECT count(*) FROM dim_date)"),
    )),
    ["history", "dim_product", "dim_warehouse", "dim_date"],
)
_PER_KEY = "SELECT customer_id, count(*) FILTER (WHERE is_current) AS c FROM history GROUP BY customer_id"
cte(
    "chk_history",
    chk(union(
        row("several current versions: customers_history", f"SELECT count(*) FROM ({_PER_KEY}) WHERE c <> 1 AND c > 0"),
        row("no current version: customers_history", f"SELECT count(*) FROM ({_PER_KEY}) WHERE c = 0"),
        row(
            "overlapping windows: customers_history",
            """SELECT count(*) FROM history b
  WHERE b.effective_start_timestamp < b.effective_end_timestamp AND EXISTS (
    SELECT 1 FROM history a
    WHERE a.customer_id = b.customer_id AND a.effective_start_timestamp < a.effective_end_timestamp
      AND (a.effective_start_timestamp, a.effective_end_timestamp, a.customer_sk)
        < (b.effective_start_timestamp, b.effective_end_timestamp, b.customer_sk)
      AND a.effective_start_timestamp < b.effective_end_timestamp
      AND b.effective_start_timestamp < a.effective_end_timestamp)""",
        ),
        row(
            "gaps between windows: customers_history",
            """SELECT count(*) FROM (
  SELECT effective_end_timestamp AS e,
         lead(effective_start_timestamp) OVER (PARTITION BY customer_id
             ORDER BY effective_start_timestamp, effective_end_timestamp, customer_sk) AS ns
  FROM history) WHERE ns IS NOT NULL AND ns <> e""",
        ),
        row("empty windows: customers_history",
            "SELECT count(*) FROM history WHERE NOT (effective_start_timestamp < effective_end_timestamp)"),
    )),
    ["history"],
)
cte(
    "chk_fk",
    chk(union(
        row("orphans: fct_sales.product_sk -> dim_product", orphans("fct_sales", "product_sk", "dim_product", "product_sk")),
        row("orphans: fct_sales.warehouse_sk -> dim_warehouse", orphans("fct_sales", "warehouse_sk", "dim_warehouse", "warehouse_sk")),
        row("orphans: fct_sales.date_key -> dim_date", orphans("fct_sales", "date_key", "dim_date", "date_key")),
        row("orphans: fct_inventory_movements.warehouse_sk -> dim_warehouse", orphans("fct_inv", "warehouse_sk", "dim_warehouse", "warehouse_sk")),
        row("orphans: fct_inventory_movements.product_sk -> dim_product", orphans("fct_inv", "product_sk", "dim_product", "product_sk")),
        row("orphans: fct_inventory_movements.date_key -> dim_date", orphans("fct_inv", "date_key", "dim_date", "date_key")),
    )),
    ["fct_sales", "fct_inv", "dim_product", "dim_warehouse", "dim_date"],
)
cte(
    "chk_rules",
    chk(union(
        row("quantity not above 0: fct_sales", "SELECT count(*) FROM fct_sales WHERE quantity <= 0"),
        row("price or amount below 0: fct_sales",
            "SELECT count(*) FROM fct_sales WHERE unit_price < 0 OR line_amount < 0"),
        row("amount differs from quantity times price: fct_sales",
            "SELECT count(*) FROM fct_sales WHERE line_amount IS NULL OR abs(CAST(line_amount AS DECIMAL(38,6)) - "
            "round(CAST(quantity AS DECIMAL(12,0)) * CAST(unit_price AS DECIMAL(20,6)), 2)) > 0.01"),
        row("sign against event type: fct_inventory_movements",
            "SELECT count(*) FROM fct_inv WHERE (event_type = 'INBOUND' AND quantity_change <= 0) "
            "OR (event_type = 'OUTBOUND' AND quantity_change >= 0)"),
    )),
    ["fct_sales", "fct_inv"],
)
cte(
    "chk_expect",
    chk(union(
        row(
            "closed versions with NULL email before a value",
            """SELECT count(*) FROM (
  SELECT is_current, email, lead(email) OVER (PARTITION BY customer_id
         ORDER BY effective_start_timestamp, effective_end_timestamp, customer_sk) AS ne
  FROM history) WHERE NOT is_current AND email IS NULL AND ne IS NOT NULL""",
            "NULL",
        ),
        row(
            "version not in effect at order time: fct_sales",
            """SELECT count(*) FROM fct_sales f
  JOIN history c ON f.customer_sk = c.customer_sk
  JOIN (SELECT customer_id AS ck, max(effective_start_timestamp) AS cur_start FROM history WHERE is_current GROUP BY customer_id) cur
    ON c.customer_id = cur.ck
  WHERE c.is_current <> (f.order_timestamp >= cur.cur_start)""",
        ),
        row(
            "quarantined keys in silver.order_items_clean",
            "SELECT count(*) FROM items_clean WHERE order_item_id IN (SELECT order_item_id FROM items_bad)",
        ),
        row("repeated keys: silver.order_items_clean.order_item_id", dup_keys("items_clean", "order_item_id")),
        row("repeated keys before dedup: order_items", dup_keys("items_typed", "order_item_id"), "NULL"),
    )),
    ["history", "fct_sales", "items_clean", "items_bad", "items_typed"],
)
cte(
    "chk_all",
    "SELECT * FROM chk_grain UNION ALL SELECT * FROM chk_keys UNION ALL SELECT * FROM chk_history "
    "UNION ALL SELECT * FROM chk_fk UNION ALL SELECT * FROM chk_rules UNION ALL SELECT * FROM chk_expect",
    ["chk_grain", "chk_keys", "chk_history", "chk_fk", "chk_rules", "chk_expect"],
)

STABLE = [
    ("silver.customers_history", "history"),
    ("silver.order_items_clean", "items_clean"),
    ("gold.fct_sales", "fct_sales"),
    ("gold.fct_inventory_movements", "fct_inv"),
]

ORACLE.update(
    {
        "check_grain": sql("SELECT * FROM chk_grain", "chk_grain"),
        "check_key_uniqueness": sql("SELECT * FROM chk_keys", "chk_keys"),
        "check_single_current": sql("SELECT * FROM chk_history WHERE check_name LIKE '%current version%'", "chk_history"),
        "check_overlaps": sql("SELECT * FROM chk_history WHERE check_name LIKE '%overlapping%'", "chk_history"),
        "check_gaps": sql(
            "SELECT * FROM chk_history WHERE check_name LIKE '%gaps between%' OR check_name LIKE '%empty windows%'",
            "chk_history",
        ),
        "check_foreign_keys": sql("SELECT * FROM chk_fk", "chk_fk"),
        "check_business_rules": sql("SELECT * FROM chk_rules", "chk_rules"),
        "check_expectations": sql("SELECT * FROM chk_expect", "chk_expect"),
        "check_suite_summary": sql(
            "SELECT count(*) AS total, count(*) FILTER (WHERE passed) AS passed, "
            "count(*) FILTER (WHERE NOT passed) AS failed FROM chk_all",
            "chk_all",
        ),
        "check_run_stability": sql(
            chk(union(*[row(f"same row count as the last run: {n}", f"SELECT count(*) FROM {t}",
                            f"(SELECT count(*) FROM {t})") for n, t in STABLE])),
            *[t for _, t in STABLE],
        ),
        "naive_fanout": sql(
            """SELECT count(DISTINCT l.order_item_id) AS grain_rows, count(*) AS naive_rows,
       (SELECT count(*) FROM (
          SELECT l2.order_item_id FROM items_clean l2 JOIN orders_clean o2 ON l2.order_id = o2.order_id
          JOIN history h2 ON o2.customer_id = h2.customer_id
          GROUP BY l2.order_item_id HAVING count(*) > 1)) AS fanned_out_lines
FROM items_clean l JOIN orders_clean o ON l.order_id = o.order_id
LEFT JOIN history h ON o.customer_id = h.customer_id""",
            "items_clean",
            "orders_clean",
            "history",
        ),
    }
)


# --------------------------------------------------------------------------
# the same checks over tables with planted defects
_DEFECTS = {
    "history": """SELECT customer_sk, customer_id, email, customer_name, segment, city, region, effective_start_timestamp,
       CASE WHEN NOT is_current AND k = 1 THEN effective_end_timestamp + INTERVAL 1 DAY WHEN NOT is_current AND k = 2 THEN effective_end_timestamp - INTERVAL 1 HOUR
            WHEN NOT is_current AND k = 3 THEN effective_start_timestamp ELSE effective_end_timestamp END AS effective_end_timestamp,
       CASE k WHEN 4 THEN true WHEN 5 THEN false ELSE is_current END AS is_current
FROM (SELECT *, CAST(customer_id AS BIGINT) % 13 AS k FROM history_sound)""",
    "dim_product": "SELECT * FROM dim_product_sound UNION ALL SELECT * FROM dim_product_sound WHERE CAST(product_id AS BIGINT) % 17 = 1",
    "dim_warehouse": "SELECT * FROM dim_warehouse_sound UNION ALL SELECT * FROM dim_warehouse_sound WHERE CAST(warehouse_id AS BIGINT) % 7 = 1",
    "dim_date": "SELECT * FROM dim_date_sound UNION ALL SELECT * FROM dim_date_sound WHERE day_of_month = 1",
    "items_clean": """SELECT * FROM items_clean_sound UNION ALL SELECT * FROM items_clean_sound WHERE CAST(order_id AS BIGINT) % 17 = 9
UNION ALL SELECT * EXCLUDE (quarantine_reason, failed_rules) FROM items_bad WHERE CAST(order_id AS BIGINT) % 17 = 10""",
    "fct_sales": """SELECT order_item_id, order_id, CASE WHEN k <> 5 THEN customer_sk END AS customer_sk, CASE WHEN k = 6 THEN 'gone' ELSE product_sk END AS product_sk,
       CASE WHEN k = 7 THEN 'gone' ELSE warehouse_sk END AS warehouse_sk, CASE WHEN k = 8 THEN 19000101 ELSE date_key END AS date_key, order_timestamp, order_status,
       CASE WHEN k = 2 THEN 0 ELSE quantity END AS quantity, unit_price, CASE k WHEN 3 THEN -5 WHEN 4 THEN line_amount + 1 ELSE line_amount END AS line_amount
FROM (SELECT *, CAST(order_id AS BIGINT) % 17 AS k, unnest(CASE WHEN CAST(order_id AS BIGINT) % 17 = 1 THEN [1, 2] ELSE [1] END) FROM fct_sales_sound)""",
    "fct_inv": """SELECT event_id, CASE WHEN k = 3 THEN 'gone' ELSE warehouse_sk END AS warehouse_sk, CASE WHEN k = 4 THEN 'gone' ELSE product_sk END AS product_sk,
       CASE WHEN k = 5 THEN 19000101 ELSE date_key END AS date_key, event_timestamp, event_type,
       CASE WHEN k = 2 AND event_type <> 'ADJUSTMENT' THEN -quantity_change ELSE quantity_change END AS quantity_change
FROM (SELECT *, CAST(event_id AS BIGINT) % 17 AS k, unnest(CASE WHEN CAST(event_id AS BIGINT) % 17 = 1 THEN [1, 2] ELSE [1] END) FROM fct_inv_sound)""",
}


def _defective(final: str, *needs: str) -> str:
    """Like ``sql``, with the defective forms in the place of the sound tables wherever a check reads them."""
    order: list[str] = []
    _resolve(list(needs), order)
    sound = re.compile(rf"\b({'|'.join(_DEFECTS)})\b")
    parts = [(sound.sub(r"\1_sound", n), sound.sub(r"\1_sound", _CTES[n][0])) for n in order if not n.startswith("chk_")]
    parts += list(_DEFECTS.items()) + [(n, _CTES[n][0]) for n in order if n.startswith("chk_")]
    return "WITH " + ",\n".join(f"{n} AS (\n{body}\n)" for n, body in parts) + "\n" + final


ORACLE["check_expected_versions"] = sql(
    chk("""SELECT 'versions of ' || k AS check_name, count(h.customer_id) AS observed, 1 AS expected
FROM range(1, 101) t(k) LEFT JOIN history h ON h.customer_id = CAST(k AS VARCHAR) GROUP BY k"""),
    "history",
)
ORACLE["check_defects"] = _defective("SELECT * FROM chk_all", "chk_all")


# --------------------------------------------------------------------------
# Bronze and ingestion
def _values(rows) -> str:
    def lit(v):
        if v is None:
            return "NULL"
        if isinstance(v, bool):
            return "true" if v else "false"
        return "'" + str(v).replace("'", "''") + "'"

    return ",\n".join("(" + ", ".join(lit(v) for v in r) + ")" for r in rows)


def _seed_cte(name: str, rows) -> None:
    cte(
        name,
        "SELECT entity_name, source_schema, source_table, load_type, CAST(watermark_column AS VARCHAR) AS watermark_column, "
        "target_path, file_format, is_active FROM (VALUES\n" + _values(rows) + "\n) AS t(entity_name, source_schema, "
        "source_table, load_type, watermark_column, target_path, file_format, is_active)",
    )


def _register_ingest():
    from strata.operators.ingest import DEFAULT_SEED
    from strata.plans.queries import FIRST_RUN_UNTIL, RESEED, RUN_TS, SLICE_LAST_WATERMARK

    _seed_cte("seed", DEFAULT_SEED)
    _seed_cte("reseed", RESEED)
    cte(
        "highs",
        """SELECT 'orders' AS e, CAST(max(o_orderdate) AS TIMESTAMP) AS h, true AS ok FROM orders
UNION ALL SELECT 'order_items', CAST(max(l_shipdate) AS TIMESTAMP), true FROM lineitem
UNION ALL SELECT 'inventory_events', CAST(max(ts) AS TIMESTAMP), false FROM events""",
    )
    cte(
        "advanced",
        f"""SELECT s.*,
       CASE WHEN coalesce(h.ok, false) AND h.h IS NOT NULL THEN h.h ELSE CAST(NULL AS TIMESTAMP) END AS last_watermark_value,
       CASE WHEN coalesce(h.ok, false) AND h.h IS NOT NULL THEN TIMESTAMP '{RUN_TS}' ELSE CAST(NULL AS TIMESTAMP) END AS last_successful_load
FROM seed s LEFT JOIN highs h ON s.entity_name = h.e""",
        ["seed", "highs"],
    )
    ORACLE.update(
        {
            "bronze_batches": """SELECT 'customers' AS entity, CAST(year(o_orderdate) AS VARCHAR) AS batch_id, count(*) AS n FROM orders GROUP BY 2
UNION ALL SELECT 'orders', CAST(year(o_orderdate) AS VARCHAR), count(*) FROM orders GROUP BY 2
UNION ALL SELECT 'order_items', CAST(year(l_shipdate) AS VARCHAR), count(*) FROM lineitem GROUP BY 2
UNION ALL SELECT 'inventory_events', strftime(ts, '%Y-%m-%d'), count(*) FROM events GROUP BY 2
UNION ALL SELECT 'products', 'snapshot', count(*) FROM part
UNION ALL SELECT 'warehouses', 'snapshot', count(*) FROM supplier""",
            "bronze_csv_batches": f"""WITH sent AS (
  SELECT coalesce(CAST(year(o_orderdate) AS VARCHAR), 'undated') AS batch_id, o_orderkey AS k, CAST(o_orderkey AS VARCHAR) AS order_id,
         CAST(o_custkey AS VARCHAR) AS customer_id, o_orderstatus AS status, o_orderpriority AS p,
         o_orderkey % 97 = 0 AS short, o_orderkey % 89 = 1 AS long, o_orderkey % 83 = 2 AS quoted FROM orders
), judged AS (
  SELECT *, CASE WHEN batch_id = '1997' THEN 'header' WHEN quoted AND NOT short THEN 'quotes' WHEN short OR long THEN 'column count' END AS reason,
         CASE WHEN batch_id = '1997' THEN customer_id || ',' || order_id ELSE order_id || ',' || customer_id END || ',' || status ||
         CASE WHEN short THEN '' ELSE CASE WHEN quoted THEN ',"' || p || '" order, as sent' ELSE ',"' || p || ' order, ""as sent""' || chr(34) END || CASE WHEN long THEN ',more' ELSE '' END END AS line
  FROM sent
)
SELECT batch_id, batch_id || '/orders.csv' AS file, CASE WHEN reason IS NULL THEN order_id END AS order_id, CASE WHEN reason IS NULL THEN customer_id END AS customer_id,
       CASE WHEN reason IS NULL THEN status END AS status, CASE WHEN reason IS NULL THEN p || ' order, "as sent"' END AS note,
       CASE WHEN reason IS NOT NULL THEN line END AS raw_line, reason AS rejected_reason, 'order_desk' AS source_system, '{RUN_TS[:10]}' AS ingested_on
FROM judged""",
            "bronze_merged_schema": """SELECT o_orderkey, o_custkey, o_orderstatus, o_totalprice, o_orderdate,
       CASE WHEN year(o_orderdate) >= 1998 THEN o_orderpriority END AS o_orderpriority,
       make_date(year(o_orderdate), 1, 1) AS load_date,
       'load_date=' || strftime(make_date(year(o_orderdate), 1, 1), '%Y-%m-%d') AS batch_id
FROM orders""",
            "bronze_latest_snapshot": """SELECT o_orderkey, o_custkey, o_orderstatus, o_totalprice, o_orderdate,
       CASE WHEN year(o_orderdate) >= 1998 THEN o_orderpriority END AS o_orderpriority,
       make_date(year(o_orderdate), 1, 1) AS load_date,
       'load_date=' || strftime(make_date(year(o_orderdate), 1, 1), '%Y-%m-%d') AS batch_id
FROM orders WHERE year(o_orderdate) = (SELECT max(year(o_orderdate)) FROM orders)""",
            "ingest_slice": f"""SELECT * FROM orders
WHERE o_orderdate > TIMESTAMP '{SLICE_LAST_WATERMARK}' AND o_orderdate <= (SELECT max(o_orderdate) FROM orders)""",
            "ingest_advance_watermark": sql("SELECT * FROM advanced", "advanced"),
            "ingest_upsert_control": sql(
                """SELECT coalesce(s.entity_name, e.entity_name) AS entity_name,
       CASE WHEN s.entity_name IS NOT NULL THEN s.source_schema ELSE e.source_schema END AS source_schema,
       CASE WHEN s.entity_name IS NOT NULL THEN s.source_table ELSE e.source_table END AS source_table,
       CASE WHEN s.entity_name IS NOT NULL THEN s.load_type ELSE e.load_type END AS load_type,
       CASE WHEN s.entity_name IS NOT NULL THEN s.watermark_column ELSE e.watermark_column END AS watermark_column,
       CASE WHEN s.entity_name IS NOT NULL THEN s.target_path ELSE e.target_path END AS target_path,
       e.last_watermark_value
FROM advanced e FULL OUTER JOIN reseed s ON e.entity_name = s.entity_name
WHERE CASE WHEN s.entity_name IS NOT NULL THEN s.is_active ELSE e.is_active END""",
                "advanced",
                "reseed",
            ),
            "history_apply_batch": sql("SELECT * FROM history", "history"),
            "dedup_latest_batches": """SELECT o_custkey, batch_id, ingestion_timestamp, o_orderkey FROM (
  SELECT o_custkey, 'batch_' || month(o_orderdate) AS batch_id, TIMESTAMP '2024-01-01 00:00:00' AS ingestion_timestamp, o_orderkey,
         row_number() OVER (PARTITION BY o_custkey ORDER BY month(o_orderdate) DESC NULLS LAST, o_orderkey DESC) AS rn
  FROM orders) WHERE rn = 1""",
            "ingest_two_runs": f"""SELECT *, DATE '{RUN_TS[:10]}' AS load_date,
       'load_date={RUN_TS[:10]}/run_id=' || CASE WHEN o_orderdate <= TIMESTAMP '{FIRST_RUN_UNTIL}' THEN 'r1' ELSE 'r2' END AS batch_id
FROM orders WHERE o_orderdate IS NOT NULL""",
            "history_stream_runs": sql("SELECT * FROM history", "history").replace(
                "CAST(year(o.o_orderdate) AS VARCHAR) AS batch_id",
                """CASE WHEN coalesce(year(o.o_orderdate), 0) <= 1997 THEN 'load_date=1998-12-31/run_id=first' WHEN year(o.o_orderdate) = 1998 THEN 'load_date=1998-12-31/run_id=late'
            WHEN year(o.o_orderdate) = 1999 THEN 'load_date=1998-12-31/run_id=second' ELSE 'load_date=2001-12-31/run_id=third' END AS batch_id""",
            ),
            "ingest_run": """SELECT 'customers' AS entity_name, (SELECT count(*) FROM customer) AS landed_rows,
       CAST(NULL AS TIMESTAMP) AS last_watermark_value
UNION ALL SELECT 'products', (SELECT count(*) FROM part), CAST(NULL AS TIMESTAMP)
UNION ALL SELECT 'warehouses', (SELECT count(*) FROM supplier), CAST(NULL AS TIMESTAMP)
UNION ALL SELECT 'orders', (SELECT count(*) FROM orders WHERE o_orderdate IS NOT NULL), (SELECT max(o_orderdate) FROM orders)
UNION ALL SELECT 'order_items', (SELECT count(*) FROM lineitem WHERE l_shipdate IS NOT NULL), (SELECT max(l_shipdate) FROM lineitem)
UNION ALL SELECT 'inventory_events', (SELECT count(*) FROM events WHERE ts IS NOT NULL), (SELECT max(ts) FROM events)""",
        }
    )


_register_ingest()
