"""SQL that DuckDB runs on the same tables, one text per registered query."""

from __future__ import annotations

# Building blocks, in order of dependence; a query names the last one it needs.
BLOCKS = {
    "products": """
        SELECT CAST(p_partkey AS VARCHAR) AS product_id, p_name AS product_name, p_type AS category,
               CAST(p_retailprice AS DECIMAL(10,2)) AS unit_price, p_size AS stock_quantity
        FROM part""",
    "stores": """
        SELECT CAST(s_suppkey AS VARCHAR) AS store_id, s_name AS store_name, n_name AS city, r_name AS region
        FROM supplier LEFT JOIN nation ON s_nationkey = n_nationkey
        LEFT JOIN region ON n_regionkey = r_regionkey""",
    "arrivals": """
        SELECT 'BATCH-' || l_orderkey || '-' || l_linenumber AS sale_id,
               CAST(l_partkey AS VARCHAR) AS product_id, CAST(l_suppkey AS VARCHAR) AS store_id,
               CAST(o_custkey AS VARCHAR) AS customer_id, CAST(l_quantity AS INTEGER) AS quantity,
               price AS unit_price, CAST(CAST(l_quantity AS INTEGER) * price AS DECIMAL(10,2)) AS total_amount,
               CASE l_returnflag WHEN 'A' THEN 'card' WHEN 'N' THEN 'cash' WHEN 'R' THEN 'mobile_money' END
                   AS payment_method,
               o_orderdate + to_hours(CAST(l_orderkey % 24 AS INTEGER)) AS sale_timestamp,
               l_shipdate AS arrival_timestamp, CAST(l_extendedprice AS DECIMAL(10,2)) AS recorded_amount
        FROM (SELECT *, CAST(coalesce(p_retailprice, l_extendedprice / l_quantity) AS DECIMAL(10,2)) AS price
              FROM lineitem LEFT JOIN orders ON l_orderkey = o_orderkey LEFT JOIN part ON l_partkey = p_partkey)""",
    "raw_sales": """
        SELECT * EXCLUDE (rn) FROM (
            SELECT *, row_number() OVER (
                PARTITION BY sale_id
                ORDER BY arrival_timestamp DESC, product_id DESC, store_id DESC, customer_id DESC, quantity DESC,
                         unit_price DESC, total_amount DESC, payment_method DESC, sale_timestamp DESC) AS rn,
                min(arrival_timestamp) OVER (PARTITION BY sale_id) AS ingestion_timestamp
            FROM arrivals)
        WHERE rn = 1""",
    "sales_clean": """
        SELECT r.*, CAST(sale_timestamp AS DATE) AS sale_date
        FROM raw_sales r WHERE sale_id IS NOT NULL AND quantity > 0 AND total_amount >= 0""",
    "daily": """
        SELECT sale_date, store_id, store_name, city, region, SUM(total_amount) AS total_revenue,
               COUNT(DISTINCT sale_id) AS total_orders, SUM(quantity) AS total_items_sold,
               COUNT(total_amount) AS priced
        FROM sales_clean LEFT JOIN stores USING (store_id)
        GROUP BY sale_date, store_id, store_name, city, region""",
    "performance": """
        SELECT product_id, product_name, category, SUM(total_amount) AS total_revenue,
               SUM(quantity) AS total_quantity_sold, COUNT(DISTINCT sale_id) AS number_of_orders
        FROM sales_clean LEFT JOIN products USING (product_id)
        GROUP BY product_id, product_name, category""",
    "stream_events": """
        SELECT printf('STREAM-%012X', event_id) AS sale_id, CAST(event_id % 2500 AS VARCHAR) AS product_id,
               json_extract_string(props, '$.k') AS store_id, CAST(user_id AS VARCHAR) AS customer_id,
               1 AS quantity, CAST(value AS DECIMAL(10,2)) AS unit_price,
               CAST(value AS DECIMAL(10,2)) AS total_amount, event_type AS payment_method,
               ts AS sale_timestamp, ts AS ingestion_timestamp
        FROM events""",
    "deliveries": """
        SELECT * EXCLUDE (n, delay) REPLACE (
            CAST(total_amount + n AS DECIMAL(10,2)) AS total_amount,
            ingestion_timestamp + to_seconds(delay) AS ingestion_timestamp)
        FROM stream_events JOIN (VALUES (0, 0), (1, 120), (2, 600)) AS d(n, delay)
          ON n = 0 OR payment_method = 'purchase'""",
    "messages": """
        SELECT sale_id AS key, ingestion_timestamp AS timestamp, payment_method,
               '{"sale_id":"' || sale_id || '","product_id":"' || product_id || '","store_id":"' || store_id
               || '","customer_id":"' || customer_id || '","quantity":' || quantity || ',"unit_price":'
               || CAST(unit_price AS VARCHAR) || ',"total_amount":' || CAST(total_amount AS VARCHAR)
               || ',"payment_method":"' || payment_method || '","sale_timestamp":"'
               || strftime(sale_timestamp, '%Y-%m-%d %H:%M:%S') || '"}' AS value
        FROM stream_events""",
    "damaged": """
        SELECT key, timestamp, payment_method,
               CASE payment_method WHEN 'error' THEN left(value, length(value) - 1)
                                   WHEN 'signup' THEN replace(value, '"quantity":1', '"quantity":"x"')
                                   ELSE value END AS value
        FROM messages""",
}

NEEDS = {
    "raw_sales": ["arrivals"],
    "sales_clean": ["raw_sales"],
    "daily": ["sales_clean", "stores"],
    "performance": ["sales_clean", "products"],
    "deliveries": ["stream_events"],
    "messages": ["stream_events"],
    "damaged": ["messages"],
}


def _closure(names: list[str]) -> set[str]:
    found: set[str] = set()
    todo = list(names)
    while todo:
        name = todo.pop()
        if name not in found:
            found.add(name)
            todo.extend(NEEDS.get(name, []))
    return found


def _sql(names: str, select: str, **extra: str) -> str:
    needed = _closure(names.split())
    parts = [f"{n} AS ({BLOCKS[n]})" for n in BLOCKS if n in needed]
    parts += [f"{n} AS ({text})" for n, text in extra.items()]
    return ("WITH " + ",\n".join(parts) + "\n" if parts else "") + select


def _average(total: str, n: str) -> str:
    """``total / n`` to cents, half up, in whole numbers; totals here are never negative."""
    cents = f"CAST(({total}) * 100 AS HUGEINT)"
    return f"CAST((2 * {cents} + ({n})) // NULLIF(2 * ({n}), 0) AS DOUBLE) / 100"


def _d(expr: str, name: str | None = None) -> str:
    return f"CAST({expr} AS DOUBLE) AS {name or expr}"


def _i(expr: str, name: str | None = None) -> str:
    return f"CAST({expr} AS BIGINT) AS {name or expr}"


def _day(expr: str = "sale_date") -> str:
    return f"strftime({expr}, '%Y-%m-%d') AS sale_date"


SALE = f"""sale_id, product_id, store_id, customer_id, quantity, {_d('unit_price')}, {_d('total_amount')},
    payment_method, sale_timestamp"""
CLEAN = f"""sale_id, product_id, product_name, category, store_id, store_name, city, region, customer_id, quantity,
    {_d('s.unit_price', 'unit_price')}, {_d('total_amount')}, payment_method, sale_timestamp,
    strftime(sale_timestamp, '%Y-%m-%d') AS sale_date, CAST(extract(hour FROM sale_timestamp) AS INTEGER) AS sale_hour"""
DAILY = f"""{_day()}, store_id, store_name, city, region, {_d('total_revenue')}, {_i('total_orders')},
    {_i('total_items_sold')}, {_average('total_revenue', 'priced')} AS average_basket"""
PERFORMANCE = f"""product_id, product_name, category, {_d('total_revenue')}, {_i('total_quantity_sold')},
    {_i('number_of_orders')}"""
KPIS = f"""{_d('COALESCE(SUM(total_revenue), 0)', 'total_revenue')},
    {_i('COALESCE(SUM(total_orders), 0)', 'total_orders')},
    {_i('COALESCE(SUM(total_items_sold), 0)', 'total_items_sold')},
    COALESCE({_average('SUM(total_revenue)', 'SUM(total_orders)')}, 0) AS average_basket"""
METRIC = f"""metric_timestamp, metric_key, {_d('COALESCE(revenue, 0)', 'total_revenue')}, {_i('orders', 'total_orders')},
    COALESCE({_average('revenue', 'orders')}, 0) AS average_basket"""

# Trailing window over events that are delivered once.
ONCE = """
    SELECT ingestion_timestamp AS metric_timestamp, sale_id AS metric_key,
           SUM(total_amount) OVER w AS revenue, COUNT(*) OVER w AS orders
    FROM stream_events
    WINDOW w AS (ORDER BY ingestion_timestamp RANGE BETWEEN INTERVAL 5 MINUTES PRECEDING AND CURRENT ROW)"""
# Every version of a sale, while it is the newest one.
VERSIONS = """
    SELECT sale_id, total_amount, ingestion_timestamp AS since,
           lead(ingestion_timestamp) OVER (PARTITION BY sale_id ORDER BY ingestion_timestamp) AS until,
           min(ingestion_timestamp) OVER (PARTITION BY sale_id) AS first
    FROM deliveries"""
REDELIVERED = """
    SELECT a.ingestion_timestamp AS metric_timestamp, a.sale_id AS metric_key,
           SUM(v.total_amount) AS revenue, COUNT(v.sale_id) AS orders
    FROM deliveries a LEFT JOIN versions v
      ON v.first >= a.ingestion_timestamp - INTERVAL 5 MINUTES
     AND v.first <= a.ingestion_timestamp
     AND v.since <= a.ingestion_timestamp
     AND (v.until IS NULL OR v.until > a.ingestion_timestamp)
    GROUP BY a.ingestion_timestamp, a.sale_id"""
NEWEST_DELIVERY = """
    SELECT * EXCLUDE (rn, ingestion_timestamp), first AS ingestion_timestamp FROM (
        SELECT *, row_number() OVER (PARTITION BY sale_id ORDER BY ingestion_timestamp DESC) AS rn,
               min(ingestion_timestamp) OVER (PARTITION BY sale_id) AS first
        FROM deliveries)
    WHERE rn = 1"""
COUNTS = " UNION ALL ".join(
    f"SELECT '{name}' AS table_name, COUNT(*) AS row_count FROM {block}" for name, block in (
        ("raw.products", "products"), ("raw.stores", "stores"), ("raw.sales_batch", "raw_sales"),
        ("staging.sales_clean", "sales_clean"), ("analytics.daily_sales_summary", "daily"),
        ("analytics.product_performance", "performance"),
    )
)
ARRIVED_DAILY = """
    SELECT CAST(sale_timestamp AS DATE) AS sale_date, store_id, store_name, city, region,
           SUM(total_amount) AS total_revenue, {orders} AS total_orders, SUM(quantity) AS total_items_sold,
           COUNT(total_amount) AS priced
    FROM arrivals LEFT JOIN stores USING (store_id) {where}
    GROUP BY ALL"""
ARRIVED_PERFORMANCE = """
    SELECT product_id, product_name, category, SUM(total_amount) AS total_revenue,
           SUM(quantity) AS total_quantity_sold, {orders} AS number_of_orders
    FROM arrivals LEFT JOIN products USING (product_id) {where}
    GROUP BY ALL"""
KEPT = "WHERE sale_id IS NOT NULL AND quantity > 0 AND total_amount >= 0"
FACTS = "LEFT JOIN products USING (product_id) LEFT JOIN stores USING (store_id)"
FEED = """
    SELECT sale_id, product_id, repeat(store_id, CASE WHEN quantity > 49 THEN 60 ELSE 1 END) AS store_id,
           customer_id, quantity, CAST(unit_price AS VARCHAR) AS unit_price,
           CAST(CASE WHEN quantity > 45 THEN total_amount * 10000 ELSE total_amount END AS DECIMAL(18,2)) AS total_amount,
           CASE WHEN quantity > 40 THEN NULL ELSE payment_method END AS payment_method, sale_timestamp,
           arrival_timestamp
    FROM arrivals"""
VIOLATIONS = """
    SELECT sale_id AS row_key, 'store_id' AS column_name, 'max_length' AS rule, store_id AS value
    FROM feed WHERE length(store_id) > 50
    UNION ALL
    SELECT sale_id, 'total_amount', 'type_range', CAST(total_amount AS VARCHAR)
    FROM feed WHERE total_amount > 99999999.99
    UNION ALL
    SELECT sale_id, 'payment_method', 'not_null', NULL FROM feed WHERE payment_method IS NULL
    UNION ALL
    SELECT sale_id, 'sale_id', 'primary_key', CAST(COUNT(*) AS VARCHAR) FROM feed GROUP BY sale_id HAVING COUNT(*) > 1"""
# One metric row for each quarter of the days, as of its newest event.
REJECTS = """
    SELECT sale_id AS row_key, '' AS column_name, 'accepted' AS rule, CAST(CAST(total_amount AS DECIMAL(10,2)) AS VARCHAR) AS value
    FROM (SELECT *, row_number() OVER (
              PARTITION BY sale_id
              ORDER BY arrival_timestamp DESC, product_id DESC, store_id DESC, customer_id DESC, quantity DESC,
                       CAST(unit_price AS DECIMAL(10,2)) DESC, total_amount DESC, payment_method DESC, sale_timestamp DESC) AS rn
          FROM feed WHERE length(store_id) <= 50 AND total_amount <= 99999999.99 AND payment_method IS NOT NULL)
    WHERE rn = 1
    UNION ALL
    SELECT sale_id, 'store_id', 'max_length', store_id FROM feed WHERE length(store_id) > 50
    UNION ALL
    SELECT sale_id, 'total_amount', 'type_range', CAST(total_amount AS VARCHAR) FROM feed WHERE total_amount > 99999999.99
    UNION ALL
    SELECT sale_id, 'payment_method', 'not_null', NULL FROM feed WHERE payment_method IS NULL"""
SCHEMA = """
    SELECT 'analytics.daily_sales_summary' AS table_name,
           CAST(row_number() OVER () AS INTEGER) AS ordinal_position, column_name,
           CASE WHEN column_type LIKE 'DECIMAL%' THEN 'numeric' WHEN column_type = 'VARCHAR' THEN 'character varying'
                ELSE lower(column_type) END AS data_type
    FROM (DESCRIBE SELECT sale_date, store_id, store_name, city, region, total_revenue, total_orders,
                          CAST(total_items_sold AS BIGINT) AS total_items_sold,
                          CAST(total_revenue AS DECIMAL(10,2)) AS average_basket FROM (
        SELECT CAST(o_orderdate AS DATE) AS sale_date, CAST(s_suppkey AS VARCHAR) AS store_id, s_name AS store_name,
               n_name AS city, r_name AS region, SUM(CAST(l_extendedprice AS DECIMAL(10,2))) AS total_revenue,
               COUNT(*) AS total_orders, SUM(CAST(l_quantity AS INTEGER)) AS total_items_sold
        FROM lineitem JOIN orders ON l_orderkey = o_orderkey JOIN supplier ON l_suppkey = s_suppkey
        JOIN nation ON s_nationkey = n_nationkey JOIN region ON n_regionkey = r_regionkey GROUP BY ALL))"""


def texts() -> dict[str, str]:
    stream_columns = f"{SALE}, ingestion_timestamp"
    to_second = "date_trunc('second', sale_timestamp) AS sale_timestamp"
    rowcount = {"orders": "COUNT(sale_id)", "where": ""}
    distinct = {"orders": "COUNT(DISTINCT sale_id)", "where": KEPT}
    recent = "ORDER BY metric_timestamp DESC, metric_key DESC LIMIT"
    return {
        # sources, sinks and tables
        "csv_roundtrip": _sql("raw_sales", f"SELECT {SALE} FROM awkward", awkward="""
            SELECT * REPLACE (CASE quantity % 3 WHEN 0 THEN '  "a", ' || customer_id || '\\" ' WHEN 1 THEN ''
                                                ELSE customer_id END AS customer_id) FROM raw_sales"""),
        "append_rows": _sql("deliveries", f"SELECT {stream_columns} FROM deliveries"),
        "upsert_products": _sql("products", f"""
            SELECT product_id, product_name, category,
                   CAST(CASE WHEN stock_quantity > 30 THEN unit_price + 1 ELSE unit_price END AS DOUBLE) AS unit_price,
                   stock_quantity, CASE WHEN stock_quantity <= 40 THEN TIMESTAMP '2024-01-01 00:00:00'
                                        ELSE TIMESTAMP '2024-01-02 00:00:00' END AS created_at
            FROM products"""),
        "upsert_stores": _sql("stores", """
            SELECT store_id, CASE WHEN region IN ('ASIA', 'EUROPE') THEN city || ' Store' ELSE store_name END
                   AS store_name, city, region,
                   CASE WHEN region <> 'ASIA' THEN TIMESTAMP '2024-01-01 00:00:00'
                        ELSE TIMESTAMP '2024-01-02 00:00:00' END AS created_at
            FROM stores"""),
        "upsert_sales_batch": _sql("raw_sales", f"""
            SELECT {SALE}, CASE WHEN ingestion_timestamp < TIMESTAMP '1998-01-01' THEN TIMESTAMP '1998-01-01 00:00:00'
                                ELSE TIMESTAMP '2002-01-01 00:00:00' END AS ingestion_timestamp
            FROM raw_sales"""),
        "stream_upsert": _sql("deliveries", f"SELECT {stream_columns} FROM newest", newest=NEWEST_DELIVERY),
        "stream_file_ingest": _sql(
            "deliveries", f"SELECT {stream_columns.replace('sale_timestamp', to_second)} FROM newest",
            newest=NEWEST_DELIVERY),
        "reload_overwrite": _sql("performance", f"SELECT {PERFORMANCE} FROM performance"),
        "batch_load": _sql("products stores daily performance", COUNTS),
        "stream_quarantine": _sql("damaged", """
            SELECT key, value, timestamp FROM damaged WHERE payment_method IN ('error', 'signup')"""),
        "stream_metric_log": _sql("stream_events", f"SELECT {METRIC} FROM m", m=ONCE),
        "load_rejects": _sql("arrivals", REJECTS, feed=FEED),
        "table_counts": _sql("products stores daily performance", COUNTS),
        "table_schema": SCHEMA,
        "constraint_violations": _sql("arrivals", VIOLATIONS, feed=FEED),
        # cleaning and enrichment
        "enrich_sales": _sql("arrivals products stores", f"SELECT {CLEAN} FROM arrivals s {FACTS}"),
        "clean_sales": _sql("raw_sales products stores", f"SELECT {CLEAN} FROM dirty s {FACTS} {KEPT}", dirty="""
            SELECT * REPLACE (quantity - 5 AS quantity,
                              CAST((quantity - 5) * unit_price AS DECIMAL(10,2)) AS total_amount) FROM raw_sales"""),
        "enrich_orphans": _sql("raw_sales products stores", f"""
            SELECT {CLEAN} FROM raw_sales s LEFT JOIN few_products USING (product_id)
            LEFT JOIN few_stores USING (store_id)""",
            few_products="SELECT * FROM products WHERE stock_quantity < 50",
            few_stores="SELECT * FROM stores WHERE region <> 'ASIA'"),
        "orphan_city_sales": _sql("sales_clean stores", f"""
            SELECT city, {_d('SUM(total_amount)', 'total_revenue')}, {_i('COUNT(*)', 'total_orders')}
            FROM sales_clean LEFT JOIN few_stores USING (store_id) GROUP BY city""",
            few_stores="SELECT * FROM stores WHERE region <> 'ASIA'"),
        "derive_line_total": _sql("arrivals", f"""
            SELECT sale_id, quantity, {_d('unit_price')}, {_d('recorded_amount')}, {_d('total_amount')},
                   recorded_amount <> total_amount AS differs FROM arrivals"""),
        # aggregates
        "daily_sales_summary": _sql("daily", f"SELECT {DAILY} FROM daily"),
        "daily_sales_summary_distinct": _sql("arrivals stores", f"SELECT {DAILY} FROM d",
                                             d=ARRIVED_DAILY.format(**distinct)),
        "daily_sales_summary_rowcount": _sql("arrivals stores", f"SELECT {DAILY} FROM d",
                                             d=ARRIVED_DAILY.format(**rowcount)),
        "product_performance": _sql("performance", f"SELECT {PERFORMANCE} FROM performance"),
        "product_performance_distinct": _sql("arrivals products", f"SELECT {PERFORMANCE} FROM p",
                                             p=ARRIVED_PERFORMANCE.format(**distinct)),
        "product_performance_rowcount": _sql("arrivals products", f"SELECT {PERFORMANCE} FROM p",
                                             p=ARRIVED_PERFORMANCE.format(**rowcount)),
        # reports
        "batch_kpis": _sql("daily", f"SELECT {KPIS} FROM daily"),
        "batch_kpis_empty": _sql("daily", f"SELECT {KPIS} FROM daily WHERE total_revenue < 0"),
        "kpi_display": _sql("daily", f"""
            SELECT format('{{:,.2f}} €', total_revenue) AS total_revenue, format('{{:,}}', total_orders) AS total_orders,
                   format('{{:,}}', total_items_sold) AS total_items_sold,
                   format('{{:,.2f}} €', average_basket) AS average_basket
            FROM (SELECT {KPIS} FROM daily)"""),
        "daily_sales": _sql("daily", f"""
            SELECT {_day()}, {_d('revenue', 'total_revenue')}, {_i('orders', 'total_orders')},
                   {_i('items', 'total_items_sold')}, {_average('revenue', 'orders')} AS average_basket
            FROM (SELECT sale_date, SUM(total_revenue) AS revenue, SUM(total_orders) AS orders,
                         SUM(total_items_sold) AS items FROM daily GROUP BY sale_date)
            ORDER BY sale_date"""),
        "city_sales": _sql("daily", f"""
            SELECT city, {_d('SUM(total_revenue)', 'total_revenue')}, {_i('SUM(total_orders)', 'total_orders')}
            FROM daily GROUP BY city ORDER BY 2 DESC"""),
        "sql_report": _sql("raw_sales stores", f"""
            SELECT region, CAST(isodow(sale_timestamp) - 1 AS INTEGER) AS weekday, COUNT(*) AS sales,
                   {_d('SUM(total_amount)', 'revenue')}
            FROM raw_sales JOIN stores USING (store_id) GROUP BY ALL"""),
        "category_sales": _sql("performance", f"""
            SELECT category, {_d('SUM(total_revenue)', 'total_revenue')},
                   {_i('SUM(total_quantity_sold)', 'total_quantity_sold')}
            FROM performance GROUP BY category ORDER BY 2 DESC"""),
        "category_revenue_share": _sql("performance", f"""
            SELECT category, {_d('revenue', 'total_revenue')},
                   round(CAST(revenue AS DOUBLE) / CAST(SUM(revenue) OVER () AS DOUBLE), 8) AS revenue_share
            FROM (SELECT category, SUM(total_revenue) AS revenue FROM performance GROUP BY category)"""),
        "top_products": _sql("performance", f"""
            SELECT product_name, category, {_d('total_revenue')}, {_i('total_quantity_sold')}, {_i('number_of_orders')}
            FROM (SELECT * FROM performance p ORDER BY p.total_revenue DESC, p.product_id LIMIT 10)"""),
        # realtime
        "realtime_snapshots": _sql("stream_events", f"SELECT {METRIC} FROM m", m=ONCE),
        "realtime_snapshots_redelivered": _sql("deliveries", f"SELECT {METRIC} FROM m",
                                               versions=VERSIONS, m=REDELIVERED),
        "realtime_metrics_recent": _sql("stream_events", f"SELECT {METRIC} FROM m {recent} 50", m=ONCE),
        "realtime_metrics_series": _sql("stream_events", f"""
            SELECT * FROM (SELECT {METRIC} FROM m {recent} 50) ORDER BY metric_timestamp, metric_key""", m=ONCE),
        "realtime_kpi_latest": _sql("stream_events", f"""
            SELECT format('{{:,.2f}} €', total_revenue) AS total_revenue, format('{{:,}}', total_orders) AS total_orders,
                   format('{{:,.2f}} €', average_basket) AS average_basket
            FROM (SELECT {METRIC} FROM m {recent} 1)""", m=ONCE),
        "recent_stream_sales": _sql("products stores deliveries", f"""
            SELECT sale_id, {to_second}, product_name, category, store_name, city, quantity, {_d('total_amount')},
                   payment_method
            FROM newest n LEFT JOIN products p USING (product_id) LEFT JOIN stores s USING (store_id)
            ORDER BY ingestion_timestamp DESC, sale_id DESC LIMIT 20""", newest=NEWEST_DELIVERY),
        "recent_by_sale_time": _sql("deliveries", f"""
            SELECT {stream_columns} FROM newest n ORDER BY n.sale_timestamp DESC, n.sale_id DESC LIMIT 5""",
            newest=NEWEST_DELIVERY),
        # messages
        "json_events_encode": _sql("messages", "SELECT key, value, timestamp FROM messages"),
        "json_events_parse": _sql("stream_events", f"""
            SELECT {stream_columns.replace('sale_timestamp', to_second)} FROM stream_events
            WHERE payment_method NOT IN ('error', 'signup')"""),
        "json_events_rejected": _sql("damaged", """
            SELECT key, value, timestamp FROM damaged WHERE payment_method IN ('error', 'signup')"""),
        # scalar functions
        "format_ids": """
            SELECT printf('P%03d', l_partkey) AS product_id, printf('S%03d', l_suppkey) AS store_id,
                   printf('BATCH-%06d', l_orderkey) AS sale_id, printf('CUST-%06d', o_custkey) AS customer_id
            FROM lineitem JOIN orders ON l_orderkey = o_orderkey""",
        "parse_times": _sql("arrivals", """
            SELECT sale_id, strftime(sale_timestamp, '%Y-%m-%d %H:%M:%S') AS time_text,
                   sale_timestamp AS parsed, strftime(sale_timestamp, '%Y-%m-%d') AS sale_date,
                   CAST(extract(hour FROM sale_timestamp) AS INTEGER) AS sale_hour
            FROM arrivals"""),
    }
