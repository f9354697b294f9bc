"""The same results in SQL, for an independent engine over the same tables."""

from __future__ import annotations


def initcap(text: str) -> str:
    """Upper-case the first letter of each space-separated word of trimmed text."""
    words = f"string_split(lower(trim({text})), ' ')"
    return (
        f"list_aggregate(list_transform({words}, lambda w: upper(w[1]) || w[2:]), "
        "'string_agg', ' ')"
    )


def hot_or_other(row_id: str, values: list[str], hot_value: str, percent: int) -> str:
    others = [value for value in values if value != hot_value]
    listed = ", ".join(f"'{value}'" for value in others)
    return (
        f"CASE WHEN ({row_id} * 7919) % 100 < {percent} THEN '{hot_value}' "
        f"ELSE ([{listed}])[CAST(({row_id} * 104729) % {len(others)} AS INTEGER) + 1] END"
    )


PRODUCTS = """
products AS (
  SELECT p_partkey AS product_id, p_name AS product_name, lower(p_type) AS category,
         p_brand AS brand, CAST(p_retailprice AS DECIMAL(18,4)) AS unit_price,
         p_size % 4 <> 0 AS is_active
  FROM part
)"""

CUSTOMERS = f"""
customers AS (
  SELECT c_custkey AS customer_id,
         upper(c_mktsegment[1]) || lower(c_mktsegment[2:]) || ' O''' || lower(n_name)
           AS first_name,
         c_name AS last_name, lower(c_name || '@example.com') AS email,
         upper(n_name[1]) || lower(n_name[2:]) AS city,
         {initcap("r_name")} AS province,
         DATE '2020-01-01' + CAST(c_custkey % 1826 AS INTEGER) AS signup_date,
         CASE WHEN c_acctbal < 0 THEN 'bronze' WHEN c_acctbal < 5000 THEN 'silver'
              ELSE 'gold' END AS loyalty_tier,
         c_acctbal > 0 AS is_active
  FROM customer
  JOIN nation ON c_nationkey = n_nationkey
  JOIN region ON n_regionkey = r_regionkey
)"""

ORDERS = """
sales_orders AS (
  SELECT o_orderkey AS order_id, o_custkey AS customer_id,
         o_orderdate AS order_timestamp, o_orderkey % 500 + 1 AS store_id,
         lower(o_orderstatus) AS order_status, lower(o_orderpriority) AS payment_method,
         CAST(o_totalprice AS DECIMAL(18,2)) AS total_amount,
         CAST(o_orderkey % 5 + 1 AS INTEGER) AS item_count
  FROM orders
)"""

PRICED_LINES = """
priced_lines AS (
  SELECT *, CAST(CAST(l_extendedprice AS DECIMAL(18,2))
                 * (1 - CAST(l_discount AS DECIMAL(4,2))) AS DECIMAL(18,4)) AS price
  FROM lineitem
)"""

ORDER_ITEMS = (
    PRICED_LINES
    + """,
order_items AS (
  SELECT l_orderkey * 10 + l_linenumber AS order_item_id, l_orderkey AS order_id,
         l_partkey AS product_id, CAST(l_quantity AS INTEGER) AS quantity,
         price AS unit_price,
         CAST(round(CAST(l_quantity AS INTEGER) * price, 2) AS DECIMAL(18,2)) AS line_total
  FROM priced_lines
)"""
)

HOT_ORDER_ITEMS = (
    ORDER_ITEMS
    + """,
hot_order_items AS (
  SELECT * REPLACE (CASE WHEN order_item_id % 3 = 0 THEN 1 ELSE order_id END AS order_id)
  FROM order_items
)"""
)

HOT_CATEGORY = hot_or_other(
    "p_partkey",
    ["electronics", "clothing", "home", "grocery", "beauty", "sports", "toys", "automotive"],
    "electronics",
    40,
)
HOT_PROVINCE = hot_or_other(
    "c_custkey",
    ["Ontario", "Quebec", "British Columbia", "Alberta", "Manitoba"],
    "Ontario",
    35,
)

SKEWED_ITEMS = (
    ORDER_ITEMS
    + f""",
skewed_items AS (
  SELECT i.*, {HOT_CATEGORY} AS category
  FROM order_items i JOIN part ON i.product_id = p_partkey
),
hot_share AS (
  SELECT count(*) FILTER (category = 'electronics') / count(*) AS share FROM skewed_items
)"""
)
# The tests and the queries place rows in eight partitions, with 32 pieces to each.
HOT_SALTS = "CAST(greatest(1, ceil((SELECT share FROM hot_share) * 8 * {finer})) AS BIGINT)"

RAW_PRODUCTS = f"""
copies AS (
  SELECT * FROM part
  UNION ALL
  SELECT * REPLACE (p_retailprice - 900 AS p_retailprice) FROM part
),
raw_products AS (
  SELECT CASE WHEN p_size <> 50 THEN p_partkey END AS product_id,
         '  ' || {initcap("p_name")} || ' ' AS product_name,
         ' ' || {initcap("p_type")} || '  ' AS category,
         p_brand || ' ' AS brand, CAST(p_retailprice AS DECIMAL(18,4)) AS unit_price,
         p_size % 4 <> 0 AS is_active
  FROM copies
)"""

RAW_CUSTOMERS = (
    CUSTOMERS
    + """,
padded_customers AS (
  SELECT CASE WHEN is_active THEN customer_id END AS customer_id,
         '  ' || upper(first_name) || ' ' AS first_name,
         ' ' || upper(last_name) AS last_name, upper(email) || ' ' AS email,
         lower(city) || '  ' AS city, ' ' || upper(province) AS province,
         signup_date, loyalty_tier, is_active
  FROM customers
),
raw_customers AS (
  SELECT * FROM padded_customers
  UNION ALL
  SELECT * REPLACE ('  ' AS email) FROM padded_customers
  WHERE starts_with(first_name, '  FURNITURE')
  UNION ALL
  SELECT * REPLACE (CAST(NULL AS VARCHAR) AS email) FROM padded_customers
  WHERE starts_with(first_name, '  BUILDING')
)"""
)

RAW_ORDERS = (
    ORDERS
    + """,
padded_orders AS (
  SELECT CASE WHEN NOT (order_status = 'f' AND payment_method = '5-low')
              THEN order_id END AS order_id,
         CASE WHEN total_amount >= 5000 THEN customer_id END AS customer_id,
         order_timestamp,
         CASE WHEN store_id <> 500 THEN store_id END AS store_id,
         '  ' || upper(order_status) || ' ' AS order_status,
         ' ' || upper(payment_method) AS payment_method,
         CASE WHEN order_status = 'o' AND payment_method = '2-high'
              THEN -total_amount ELSE total_amount END AS total_amount,
         item_count - 1 AS item_count
  FROM sales_orders
),
raw_orders AS (
  SELECT * FROM padded_orders
  UNION ALL
  SELECT * REPLACE (' COMPLETED ' AS order_status,
                    CAST(0 AS DECIMAL(18,2)) AS total_amount)
  FROM padded_orders WHERE order_status = '  P '
)"""
)

RAW_ORDER_ITEMS = (
    PRICED_LINES
    + """,
raw_order_items AS (
  SELECT l_orderkey * 10 + l_linenumber AS order_item_id,
         CASE WHEN NOT (l_tax = 0 AND l_discount = 0) THEN l_orderkey END AS order_id,
         CASE WHEN NOT (l_tax = 0.01 AND l_discount = 0.01) THEN l_partkey END AS product_id,
         CASE WHEN l_tax = 0.08 THEN -CAST(l_quantity AS INTEGER)
              WHEN l_tax = 0.07 THEN NULL
              ELSE CAST(l_quantity AS INTEGER) END AS quantity,
         CASE WHEN l_discount = 0.1 THEN CAST(0 AS DECIMAL(18,4)) ELSE price END AS unit_price,
         CAST(0 AS DECIMAL(18,2)) AS line_total
  FROM priced_lines
)"""
)


def smallest(source: str, keys: list[str], others: list[str]) -> str:
    """One row per key: the smallest by the other columns, nulls first."""
    order = ", ".join(f"{name} NULLS FIRST" for name in others)
    return (
        f"SELECT * EXCLUDE (place) FROM (SELECT *, row_number() OVER "
        f"(PARTITION BY {', '.join(keys)} ORDER BY {order}) AS place FROM {source}) "
        "WHERE place = 1"
    )


SILVER_PRODUCTS = (
    RAW_PRODUCTS
    + f""",
single_products AS (
  {smallest("raw_products", ["product_id"],
            ["product_name", "category", "brand", "unit_price", "is_active"])}
),
silver_products AS (
  SELECT product_id, trim(product_name) AS product_name,
         lower(trim(category)) AS category, trim(brand) AS brand, unit_price, is_active
  FROM single_products WHERE unit_price > 0
)"""
)

SILVER_CUSTOMERS = (
    RAW_CUSTOMERS
    + f""",
single_customers AS (
  {smallest("raw_customers", ["customer_id"],
            ["first_name", "last_name", "email", "city", "province", "signup_date",
             "loyalty_tier", "is_active"])}
),
silver_customers AS (
  SELECT customer_id, {initcap("first_name")} AS first_name,
         {initcap("last_name")} AS last_name, lower(trim(email)) AS email,
         {initcap("city")} AS city, {initcap("province")} AS province,
         signup_date, loyalty_tier, is_active
  FROM single_customers WHERE customer_id IS NOT NULL AND email IS NOT NULL
)"""
)

SILVER_ORDERS = (
    RAW_ORDERS
    + f""",
single_orders AS (
  {smallest("raw_orders", ["order_id"],
            ["customer_id", "order_timestamp", "store_id", "order_status",
             "payment_method", "total_amount", "item_count"])}
),
silver_orders AS (
  SELECT order_id, customer_id, order_timestamp, store_id,
         lower(trim(order_status)) AS order_status,
         lower(trim(payment_method)) AS payment_method, total_amount, item_count
  FROM single_orders
  WHERE order_id IS NOT NULL AND customer_id IS NOT NULL AND store_id IS NOT NULL
    AND total_amount > 0 AND item_count > 0
)"""
)

SILVER_ORDER_ITEMS = (
    RAW_ORDER_ITEMS
    + f""",
single_order_items AS (
  {smallest("raw_order_items", ["order_item_id"],
            ["order_id", "product_id", "quantity", "unit_price", "line_total"])}
),
totalled_order_items AS (
  SELECT * REPLACE (CAST(round(quantity * unit_price, 2) AS DECIMAL(18,2)) AS line_total)
  FROM single_order_items
),
silver_order_items AS (
  SELECT * FROM totalled_order_items
  WHERE order_item_id IS NOT NULL AND order_id IS NOT NULL AND product_id IS NOT NULL
    AND quantity > 0 AND unit_price > 0 AND line_total > 0
)"""
)


def or_missing(name: str) -> str:
    """An integer column as text, so that a missing value stays missing."""
    return f"CAST({name} AS VARCHAR) AS {name}"


def with_ctes(ctes: str | list[str], select: str) -> str:
    listed = [ctes] if isinstance(ctes, str) else ctes
    return f"WITH {','.join(listed)}\n{select}"


def daily(orders: str, items: str, products: str) -> str:
    return f"""
daily AS (
  SELECT CAST(order_timestamp AS DATE) AS order_date, category,
         CAST(sum(line_total) AS DOUBLE) AS total_sales,
         CAST(sum(quantity) AS BIGINT) AS total_items_sold,
         count(DISTINCT order_id) AS total_orders
  FROM {orders} JOIN {items} USING (order_id) JOIN {products} USING (product_id)
  GROUP BY ALL
)"""


SALES = [PRODUCTS, ORDERS, ORDER_ITEMS]
DAILY = [*SALES, daily("sales_orders", "order_items", "products")]
DAILY_SALES = with_ctes(DAILY, "SELECT * FROM daily")
CATEGORY_SALES = with_ctes(
    DAILY,
    "SELECT category, CAST(sum(CAST(total_sales AS DECIMAL(18,2))) AS DOUBLE) "
    "AS category_total_sales FROM daily GROUP BY category",
)
DOUBLE_PRICES = (
    "CAST(unit_price AS DOUBLE) AS unit_price, CAST(line_total AS DOUBLE) AS line_total"
)

RAW_CTES = {
    "products": RAW_PRODUCTS,
    "customers": RAW_CUSTOMERS,
    "orders": RAW_ORDERS,
    "order_items": RAW_ORDER_ITEMS,
}

# The columns of the raw datasets with their declared types.
COLUMN_TYPES = {
    "products": [
        ("product_id", "bigint"),
        ("product_name", "string"),
        ("category", "string"),
        ("brand", "string"),
        ("unit_price", "decimal(18,4)"),
        ("is_active", "boolean"),
    ],
    "customers": [
        ("customer_id", "bigint"),
        ("first_name", "string"),
        ("last_name", "string"),
        ("email", "string"),
        ("city", "string"),
        ("province", "string"),
        ("signup_date", "date"),
        ("loyalty_tier", "string"),
        ("is_active", "boolean"),
    ],
    "orders": [
        ("order_id", "bigint"),
        ("customer_id", "bigint"),
        ("order_timestamp", "timestamp_ntz"),
        ("store_id", "bigint"),
        ("order_status", "string"),
        ("payment_method", "string"),
        ("total_amount", "decimal(18,2)"),
        ("item_count", "int"),
    ],
    "order_items": [
        ("order_item_id", "bigint"),
        ("order_id", "bigint"),
        ("product_id", "bigint"),
        ("quantity", "int"),
        ("unit_price", "decimal(18,4)"),
        ("line_total", "decimal(18,2)"),
    ],
}


def per_dataset(select: str) -> str:
    """One part per dataset, put together; `{name}` stands for the dataset."""
    parts = [select.format(name=name) for name in RAW_CTES]
    return with_ctes(list(RAW_CTES.values()), "\nUNION ALL\n".join(parts))


def schema_rows() -> str:
    parts = [
        f"SELECT '{dataset}' AS dataset, count(*) AS row_count, "
        f"{place} AS column_position, '{column}' AS column_name, "
        f"'{kind}' AS column_type, count({column}) AS value_count FROM raw_{dataset}"
        for dataset, columns in COLUMN_TYPES.items()
        for place, (column, kind) in enumerate(columns, start=1)
    ]
    return with_ctes(list(RAW_CTES.values()), "\nUNION ALL\n".join(parts))


def heavy(ctes: str | list[str], source: str, key: str) -> str:
    """Keys with more than a thousandth of all rows."""
    return with_ctes(
        ctes,
        f"SELECT {key}, count(*) AS row_count, "
        f"count(*) / (SELECT count(*) FROM {source}) AS share FROM {source} GROUP BY {key} "
        f"HAVING count(*) > (SELECT count(*) FROM {source}) / 1000",
    )


LEVELS = {
    "day and category": ("order_date", "category"),
    "day": ("order_date", "NULL::VARCHAR"),
    "month and category": ("date_trunc('month', order_date)::DATE", "category"),
    "month": ("date_trunc('month', order_date)::DATE", "NULL::VARCHAR"),
    "all": ("NULL::DATE", "NULL::VARCHAR"),
}


def orders_by_level() -> str:
    parts = [
        f"SELECT '{level}' AS level, {period} AS period, {category} AS category, "
        "count(DISTINCT order_id) AS total_orders FROM sold GROUP BY ALL"
        for level, (period, category) in LEVELS.items()
    ]
    sold = (
        "sold AS (SELECT CAST(order_timestamp AS DATE) AS order_date, category, order_id "
        "FROM sales_orders JOIN order_items USING (order_id) JOIN products USING (product_id))"
    )
    return with_ctes([*SALES, sold], "\nUNION ALL\n".join(parts))


def sizes(ctes: list[str] | str, source: str, partitions: int) -> str:
    return with_ctes(
        ctes,
        f"SELECT CAST({partitions} AS BIGINT) AS partitions, count(*) AS row_count, "
        f"true AS even FROM {source}",
    )


FANOUT = """
wanted AS (
  SELECT order_id, CASE WHEN order_id % 100 = 0 THEN 12 ELSE item_count - 1 END AS n
  FROM sales_orders
),
lines AS (
  SELECT order_id, unnest(range(1, n + 1)) AS line_number FROM wanted WHERE n >= 1
),
drawn AS (
  SELECT order_id, line_number, md5(order_id || ':' || line_number) AS digest FROM lines
),
numbered AS (
  SELECT p_partkey AS product_id, row_number() OVER (ORDER BY p_partkey) - 1 AS number FROM part
),
fanout AS (
  SELECT order_id * ((SELECT max(n) FROM wanted) + 1) + line_number AS order_item_id, order_id,
         product_id, CAST(('0x' || substr(digest, 9, 8))::BIGINT % 5 + 1 AS INTEGER) AS quantity
  FROM drawn JOIN numbered
    ON number = ('0x' || substr(digest, 1, 8))::BIGINT % (SELECT count(*) FROM part)
)"""

ORACLES: dict[str, str] = {
    "daily_sales_by_category": DAILY_SALES,
    "dedupe_by_key": smallest(
        "lineitem",
        ["l_orderkey", "l_linenumber"],
        [
            "l_partkey",
            "l_suppkey",
            "l_quantity",
            "l_extendedprice",
            "l_discount",
            "l_tax",
            "l_returnflag",
            "l_linestatus",
            "l_shipdate",
        ],
    ),
    "filter_not_null": with_ctes(
        RAW_ORDER_ITEMS,
        f"SELECT order_item_id, order_id, product_id, {or_missing('quantity')}, {DOUBLE_PRICES} "
        "FROM raw_order_items WHERE order_item_id IS NOT NULL AND order_id IS NOT NULL "
        "AND product_id IS NOT NULL",
    ),
    "filter_positive": with_ctes(
        RAW_ORDER_ITEMS,
        f"SELECT order_item_id, {or_missing('order_id')}, {or_missing('product_id')}, "
        f"quantity, {DOUBLE_PRICES} FROM raw_order_items WHERE quantity > 0 AND unit_price > 0",
    ),
    "standardize_strings": with_ctes(
        RAW_CUSTOMERS,
        f"SELECT {or_missing('customer_id')}, {initcap('first_name')} AS first_name, "
        f"{initcap('last_name')} AS last_name, lower(trim(email)) AS email, "
        f"{initcap('city')} AS city, {initcap('province')} AS province, "
        "signup_date, loyalty_tier, is_active FROM raw_customers",
    ),
    "recompute_line_total": with_ctes(
        RAW_ORDER_ITEMS,
        f"SELECT order_item_id, {or_missing('order_id')}, {or_missing('product_id')}, "
        f"{or_missing('quantity')}, CAST(unit_price AS DOUBLE) AS unit_price, "
        "CAST(CAST(round(quantity * unit_price, 2) AS DECIMAL(18,2)) AS DOUBLE) "
        "AS line_total FROM raw_order_items",
    ),
    "silver_products": with_ctes(
        SILVER_PRODUCTS,
        f"SELECT * REPLACE (CAST(unit_price AS DOUBLE) AS unit_price, {or_missing('product_id')}), "
        "true AS stamped FROM silver_products",
    ),
    "silver_customers": with_ctes(
        SILVER_CUSTOMERS, "SELECT *, true AS stamped FROM silver_customers"
    ),
    "silver_orders": with_ctes(
        SILVER_ORDERS,
        "SELECT * REPLACE (CAST(total_amount AS DOUBLE) AS total_amount), "
        "true AS stamped FROM silver_orders",
    ),
    "silver_order_items": with_ctes(
        SILVER_ORDER_ITEMS,
        f"SELECT order_item_id, order_id, product_id, quantity, {DOUBLE_PRICES}, "
        "true AS stamped FROM silver_order_items",
    ),
    "bronze_audit": with_ctes(
        ORDERS,
        "SELECT * REPLACE (CAST(total_amount AS DOUBLE) AS total_amount), "
        "'orders' AS source_system, 'manual_batch_001' AS batch_id, "
        "'orders.parquet' AS source_file, true AS stamped FROM sales_orders",
    ),
    "bronze_ingest": per_dataset(
        "SELECT '{name}' AS source_system, 'manual_batch_001' AS batch_id, "
        "count(*) AS row_count, count(*) AS stamped_rows, count(*) AS traced_rows "
        "FROM raw_{name}"
    ),
    "validate_bronze": per_dataset(
        "SELECT 'bronze' AS layer, '{name}' AS dataset, count(*) AS row_count, "
        "'' AS missing_columns, true AS passed FROM raw_{name} "
        "UNION ALL SELECT 'raw', '{name}', count(*), "
        "'source_system, batch_id, ingestion_timestamp, source_file', false FROM raw_{name}"
    ),
    "schema_report": schema_rows(),
    "csv_roundtrip": with_ctes(
        RAW_ORDERS,
        "SELECT * REPLACE (CAST(total_amount AS DOUBLE) AS total_amount, "
        f"{or_missing('order_id')}, {or_missing('customer_id')}, {or_missing('store_id')}) "
        "FROM raw_orders",
    ),
    "csv_inferred": with_ctes(
        RAW_ORDER_ITEMS,
        f"SELECT order_item_id, {or_missing('order_id')}, {or_missing('product_id')}, "
        f"{or_missing('quantity')}, {DOUBLE_PRICES}, 'int' AS order_item_id_type, "
        "'int' AS order_id_type, 'int' AS product_id_type, 'int' AS quantity_type, "
        "'double' AS unit_price_type, 'double' AS line_total_type FROM raw_order_items",
    ),
    "bronze_rejects": with_ctes(
        list(RAW_CTES.values()),
        "SELECT 'products' AS dataset, count(*) AS row_count, CAST(0 AS BIGINT) AS "
        "unreadable_rows FROM raw_products "
        "UNION ALL SELECT 'customers', count(*), count(*) FILTER (is_active AND "
        "signup_date >= DATE '2023-01-01') FROM raw_customers "
        "UNION ALL SELECT 'orders', count(*), 0 FROM raw_orders "
        "UNION ALL SELECT 'order_items', count(*), count(*) FILTER (order_item_id % 10 = 3) "
        "FROM raw_order_items",
    ),
    "inferred_to_silver": with_ctes(
        SILVER_ORDER_ITEMS.replace(
            "CASE WHEN l_tax = 0.08 THEN",
            "CASE WHEN l_linenumber = 3 THEN NULL WHEN l_tax = 0.08 THEN",
        ),
        f"SELECT order_item_id, order_id, product_id, quantity, {DOUBLE_PRICES}, "
        "'int' AS quantity_type, 'decimal(18,4)' AS unit_price_type, "
        "'decimal(18,2)' AS line_total_type FROM silver_order_items",
    ),
    "products_profile": with_ctes(
        PRODUCTS,
        "SELECT 'size' AS part, 'rows' AS label, CAST(count(*) AS DOUBLE) AS value FROM products "
        "UNION ALL SELECT 'size', 'partitions', 8 "
        "UNION ALL SELECT 'category', category, count(*) FROM products GROUP BY category",
    ),
    "gold_profile": with_ctes(
        DAILY,
        "SELECT 'size' AS part, 'rows' AS label, CAST(count(*) AS DOUBLE) AS value FROM daily "
        "UNION ALL SELECT 'size', 'partitions', 8 "
        "UNION ALL SELECT 'category', category, "
        "CAST(sum(CAST(total_sales AS DECIMAL(18,2))) AS DOUBLE) FROM daily GROUP BY category "
        "UNION ALL (SELECT 'day', order_date || ' ' || category, total_sales FROM daily "
        "ORDER BY total_sales DESC, order_date, category LIMIT 20)",
    ),
    "overwrite_roundtrip": with_ctes(CUSTOMERS, "SELECT * FROM customers"),
    "raw_to_gold": with_ctes(
        [
            SILVER_PRODUCTS,
            SILVER_ORDERS,
            SILVER_ORDER_ITEMS,
            daily("silver_orders", "silver_order_items", "silver_products"),
        ],
        "SELECT * FROM daily",
    ),
    "join_orders_items_products": with_ctes(
        SALES,
        "SELECT i.order_item_id, o.order_id, p.product_id, o.customer_id, "
        "CAST(o.order_timestamp AS DATE) AS order_date, o.order_status, p.category, "
        "i.quantity, CAST(i.unit_price AS DOUBLE) AS unit_price, "
        "CAST(i.line_total AS DOUBLE) AS line_total "
        "FROM sales_orders o JOIN order_items i ON o.order_id = i.order_id "
        "JOIN products p ON i.product_id = p.product_id",
    ),
    "join_items_products": with_ctes(
        [PRODUCTS, ORDER_ITEMS],
        "SELECT i.order_item_id, p.product_id, p.product_name, p.category, p.brand, "
        "i.quantity, CAST(i.line_total AS DOUBLE) AS line_total "
        "FROM order_items i JOIN products p ON i.product_id = p.product_id",
    ),
    "category_total_sales": CATEGORY_SALES,
    "product_count_by_category": with_ctes(
        PRODUCTS, "SELECT category, count(*) AS row_count FROM products GROUP BY category"
    ),
    "row_counts": with_ctes(
        DAILY,
        "SELECT 'products' AS dataset, count(*) AS row_count FROM part "
        "UNION ALL SELECT 'customers', count(*) FROM customer "
        "UNION ALL SELECT 'orders', count(*) FROM orders "
        "UNION ALL SELECT 'order_items', count(*) FROM lineitem "
        "UNION ALL SELECT 'daily_sales_by_category', count(*) FROM daily",
    ),
    "orders_per_day": (
        "SELECT CAST(o_orderdate AS DATE) AS order_date, count(*) AS row_count "
        "FROM orders GROUP BY ALL"
    ),
    "filter_equals_count": with_ctes(
        SALES,
        "SELECT count(*) AS row_count FROM sales_orders JOIN order_items USING (order_id) "
        "JOIN products USING (product_id) WHERE category = 'economy'",
    ),
    "category_distribution": with_ctes(
        SKEWED_ITEMS,
        "SELECT category, count(*) AS row_count FROM skewed_items GROUP BY category "
        "ORDER BY row_count DESC, category",
    ),
    "top20_daily_sales": with_ctes(
        DAILY,
        "SELECT * FROM daily ORDER BY total_sales DESC, order_date, category LIMIT 20",
    ),
    "daily_sales_sort_merge": DAILY_SALES,
    "daily_sales_auto_broadcast": DAILY_SALES,
    "daily_sales_broadcast_hint": DAILY_SALES,
    "daily_sales_aqe_off": DAILY_SALES,
    "daily_sales_aqe_on": DAILY_SALES,
    "category_sales_shuffle_8": CATEGORY_SALES,
    "category_sales_shuffle_200": CATEGORY_SALES,
    "cached_reuse": with_ctes(
        [
            *DAILY,
            " joined AS (SELECT category FROM sales_orders JOIN order_items USING (order_id) "
            "JOIN products USING (product_id))",
        ],
        "SELECT *, (SELECT count(*) FROM joined) AS joined_rows, "
        "(SELECT count(*) FROM joined WHERE category = 'economy') AS category_rows FROM daily",
    ),
    "plan_report": with_ctes(
        DAILY,
        "SELECT variant, CAST(broadcast_joins AS BIGINT) AS broadcast_joins, "
        "CAST(sort_merge_joins AS BIGINT) AS sort_merge_joins, "
        "count(*) AS row_count, CAST(sum(total_items_sold) AS BIGINT) AS items_sold "
        "FROM daily, (VALUES ('sort_merge', 0, 2), ('broadcast_hint', 1, 1)) "
        "variants(variant, broadcast_joins, sort_merge_joins) GROUP BY ALL",
    ),
    "hot_key_assignment": (
        f"SELECT p_partkey AS product_id, {HOT_CATEGORY} AS category, p_brand AS brand FROM part"
    ),
    "hot_region_assignment": (
        f"SELECT c_custkey AS customer_id, c_name AS last_name, {HOT_PROVINCE} AS province "
        "FROM customer"
    ),
    "skew_report": with_ctes(
        [
            SKEWED_ITEMS,
            " counts AS (SELECT category, count(*) AS row_count FROM skewed_items "
            "GROUP BY category), totals AS (SELECT CAST(sum(row_count) AS BIGINT) AS all_rows, "
            "count(*) AS keys FROM counts)",
        ],
        "SELECT category, row_count, row_count / all_rows AS share, "
        "row_count * keys / all_rows AS ratio_to_mean FROM counts, totals",
    ),
    "salted_distribution": with_ctes(
        SKEWED_ITEMS,
        "SELECT category, count(*) AS row_count, CASE WHEN category = 'electronics' THEN "
        f"{HOT_SALTS.format(finer=32)} ELSE 1 END AS salted_keys, true AS even "
        "FROM skewed_items GROUP BY category",
    ),
    "salted_placement": with_ctes(
        SKEWED_ITEMS,
        "SELECT placed_by, CAST(8 AS BIGINT) AS partitions, count(*) AS row_count, "
        "hot_key_in_one, bound, true AS within_bound FROM skewed_items, "
        "(VALUES ('category', true, 8.0::DOUBLE), ('salted_category', false, 2.5::DOUBLE), "
        "('category_and_piece', false, 1.5::DOUBLE)) "
        "placements(placed_by, hot_key_in_one, bound) GROUP BY ALL",
    ),
    "random_salt_spread": with_ctes(
        SKEWED_ITEMS,
        "SELECT category, count(*) AS row_count, CASE WHEN category = 'electronics' THEN "
        f"{HOT_SALTS.format(finer=1)} ELSE 1 END AS salted_keys "
        "FROM skewed_items GROUP BY category",
    ),
    "salted_two_stage_agg": with_ctes(
        SKEWED_ITEMS,
        "SELECT category, count(*) AS row_count, "
        "CAST(sum(line_total) AS DOUBLE) AS total_sales, "
        "CAST(sum(quantity) AS BIGINT) AS total_items_sold, "
        "count(DISTINCT order_id) AS total_orders FROM skewed_items GROUP BY category",
    ),
    "split_hot_keys": with_ctes(
        SKEWED_ITEMS,
        "SELECT category, count(*) AS row_count, true AS pieces_are_small "
        "FROM skewed_items GROUP BY category",
    ),
    "key_colocation": with_ctes(
        SKEWED_ITEMS,
        "SELECT category, count(*) AS row_count, CAST(1 AS BIGINT) AS partitions_per_piece "
        "FROM skewed_items GROUP BY category",
    ),
    "partition_stats": with_ctes(
        SKEWED_ITEMS,
        "SELECT count(*) AS row_count, true AS as_asked, true AS none_empty FROM skewed_items",
    ),
    "repartition_sizes": sizes(DAILY, "daily", 5),
    "coalesce_sizes": sizes(DAILY, "daily", 5),
    "orders_by_level": orders_by_level(),
    "hot_orders": heavy(HOT_ORDER_ITEMS, "hot_order_items", "order_id"),
    "hot_customers": heavy(ORDERS, "sales_orders", "customer_id"),
    "replacement_history": """
        SELECT number, row_count, number = 3 AS is_current,
               (SELECT count(*) FROM part) AS first_reader_rows
        FROM (SELECT 1::BIGINT AS number, count(*) AS row_count FROM part
              UNION ALL SELECT 2, count(*) FROM orders
              UNION ALL SELECT 3, count(*) FROM lineitem)
    """,
    "batch_replay": with_ctes(
        RAW_ORDER_ITEMS,
        "SELECT CASE WHEN order_item_id % 2 = 1 THEN '2024-05-02' ELSE '2024-05-01' END "
        "AS batch_id, count(*) AS row_count, CAST(sum(order_item_id) AS BIGINT) AS sum_of_ids, "
        "count(*) FILTER (unit_price > 0) AS priced_rows FROM raw_order_items "
        "WHERE order_item_id % 2 = 0 OR unit_price > 0 GROUP BY ALL",
    ),
    "bucketed_daily_sales": with_ctes(
        [PRODUCTS, ORDERS, HOT_ORDER_ITEMS, daily("sales_orders", "hot_order_items", "products")],
        "SELECT * FROM daily",
    ),
    "clustered_days": with_ctes(
        SALES,
        "SELECT CAST(order_timestamp AS DATE) AS order_date, "
        "CAST(sum(line_total) AS DOUBLE) AS total_sales, count(*) AS row_count, "
        "true AS most_rows_skipped "
        "FROM sales_orders JOIN order_items USING (order_id) JOIN products USING (product_id) "
        "WHERE category = 'economy' AND CAST(order_timestamp AS DATE) "
        "BETWEEN DATE '1997-01-01' AND DATE '1997-03-31' GROUP BY ALL",
    ),
    "executed_plan_report": with_ctes(
        DAILY,
        "SELECT variant, phase, CAST(b AS BIGINT) AS broadcast_joins, "
        "CAST(m AS BIGINT) AS sort_merge_joins, phase = 'executed' AS final, "
        "CASE WHEN phase = 'executed' THEN CAST((SELECT count(*) FROM daily) AS VARCHAR) "
        "ELSE 'None' END AS row_count "
        "FROM (VALUES ('sort_merge', 0, 2), ('automatic', 2, 0), ('broadcast_hint', 1, 1)) "
        "variants(variant, b, m), (VALUES ('planned'), ('executed')) phases(phase)",
    ),
    "sales_in_one_pass": with_ctes(
        [
            *SALES,
            "sold AS (SELECT *, CAST(order_timestamp AS DATE) AS order_date FROM sales_orders "
            "JOIN order_items USING (order_id) JOIN products USING (product_id))",
        ],
        "SELECT order_date, category, "
        "CAST(GROUPING(order_date, category) AS INTEGER) AS level, "
        "CAST(sum(line_total) AS DOUBLE) AS total_sales, "
        "CAST(sum(quantity) AS BIGINT) AS total_items_sold, "
        "count(DISTINCT (order_id, category)) AS order_categories, "
        "(SELECT count(*) FROM sold) AS joined_rows, "
        "(SELECT count(*) FROM sold WHERE category = 'economy') AS category_rows "
        "FROM sold GROUP BY GROUPING SETS ((order_date, category), (category), ())",
    ),
    "sketched_profile": with_ctes(
        ORDER_ITEMS,
        "\nUNION ALL\n".join(
            f"SELECT '{name}' AS column_name, count(*) AS row_count, count({name}) AS value_count, "
            "true AS distinct_within, true AS median_within FROM order_items"
            for name in ("order_id", "product_id", "quantity", "line_total")
        ),
    ),
    "schema_drift": """
        SELECT * FROM (VALUES
            ('renamed', 'quantity', 'missing', 'int', 'none'),
            ('renamed', 'qty', 'extra', 'none', 'int'),
            ('retyped', 'unit_price', 'retyped', 'decimal(18,4)', 'double'),
            ('extended', 'currency', 'extra', 'none', 'string')
        ) found(delivery, column_name, finding, declared_type, found_type)
    """,
    "observed_sizes": with_ctes(
        SKEWED_ITEMS,
        "SELECT count(*) AS row_count, true AS same_as_counted FROM skewed_items",
    ),
    "order_fanout": with_ctes([ORDERS, FANOUT], "SELECT * FROM fanout"),
    "price_lookup": with_ctes(
        [ORDERS, FANOUT, PRODUCTS],
        "SELECT order_item_id, order_id, product_id, quantity, "
        "CAST(unit_price AS DOUBLE) AS unit_price, "
        "CAST(CAST(round(quantity * unit_price, 2) AS DECIMAL(18,2)) AS DOUBLE) AS line_total "
        "FROM fanout JOIN products USING (product_id)",
    ),
}
