"""The queries in DuckDB SQL, over the same tables."""

from __future__ import annotations

# tables of the venue, as in views.py
VIEWS = {
    "orders_v": """
        SELECT o_orderkey AS id,
               CASE WHEN o_orderpriority <> '5-LOW' THEN o_custkey END AS customer_id,
               o_orderstatus AS status_id, o_orderpriority AS payment_type_id,
               CAST(o_totalprice AS DECIMAL(18,2)) AS total_cost,
               CAST(o_totalprice AS DECIMAL(18,2)) AS to_pay,
               o_orderpriority AS comment, o_orderdate AS created_at
        FROM orders""",
    "lines_v": """
        SELECT l_orderkey * 1000 + l_linenumber AS id, l_orderkey AS order_id, l_partkey AS menu_item_id,
               CAST(l_extendedprice AS DECIMAL(18,2)) AS item_cost,
               CAST(l_quantity AS INTEGER) AS quantity,
               CASE WHEN l_linestatus = 'F' THEN l_shipdate END AS cooked_at
        FROM lineitem""",
    "items_v": """
        SELECT p_partkey AS id, p_name AS name, CAST(p_retailprice AS DECIMAL(18,2)) AS price,
               p_type <> 'ECONOMY' AS is_available
        FROM part""",
    "recipes_v": """
        SELECT 2 * p_partkey AS id, p_partkey AS menu_item_id, 'part ' || p_partkey AS ingredient_id,
               'pc' AS unit_id, CAST(1 AS DECIMAL(10,3)) AS quantity
        FROM part WHERE p_type <> 'SMALL'
        UNION ALL
        SELECT 2 * p_partkey + 1, p_partkey, p_brand, 'kg',
               CAST(p_size * CAST(0.010 AS DECIMAL(4,3)) AS DECIMAL(10,3))
        FROM part WHERE p_type <> 'SMALL'""",
    "ingredients_v": """
        SELECT 'part ' || p_partkey AS id, p_name AS name FROM part
        UNION ALL SELECT DISTINCT p_brand, p_brand FROM part""",
    "stock_v": """
        SELECT 'part ' || p_partkey AS ingredient_id,
               CASE WHEN p_type = 'PROMO' THEN 'g' ELSE 'pc' END AS unit_id,
               CAST(p_size * 10 AS DECIMAL(18,3)) AS quantity
        FROM part
        UNION ALL
        SELECT p_brand, 'kg', CAST(SUM(p_size)::BIGINT * CAST(0.500 AS DECIMAL(4,3)) AS DECIMAL(18,3))
        FROM part GROUP BY p_brand""",
    "customers_v": """
        SELECT c_custkey AS id, c_name AS phone, c_name || ' ' || c_mktsegment AS full_name,
               CAST(c_acctbal AS DECIMAL(18,2)) AS total_spent, CAST(0 AS BIGINT) AS total_orders,
               CASE WHEN c_acctbal >= 7500 THEN 4 WHEN c_acctbal >= 5000 THEN 3
                    WHEN c_acctbal >= 2500 THEN 2 WHEN c_acctbal >= 0 THEN 1 END AS tier_id
        FROM customer""",
    "employees_v": """
        SELECT s_suppkey AS id, s_name || ' ' || n_name AS full_name, s_name AS phone,
               CASE WHEN n_name <> 'NATION_0' THEN n_regionkey END AS company_id
        FROM supplier JOIN nation ON s_nationkey = n_nationkey""",
    "deliveries_v": """
        SELECT l_orderkey AS order_id, MIN(l_suppkey) AS courier_id, MIN(l_linestatus) AS delivery_status_id,
               'ул. ' || l_orderkey AS address
        FROM lineitem WHERE l_returnflag = 'R' GROUP BY l_orderkey""",
    "dine_ins_v": """
        SELECT l_orderkey AS order_id, MIN(l_suppkey) AS employee_id, MIN(l_partkey) AS table_id,
               MAX(l_linestatus) AS status_id
        FROM lineitem WHERE l_returnflag = 'A' GROUP BY l_orderkey""",
    "seats_v": "SELECT p_partkey AS id, p_partkey AS number, p_brand AS location FROM part",
    "bookings_v": """
        SELECT event_id AS id, user_id AS table_id, ts AS start_at,
               ts + to_seconds(CAST(round(value * 60) AS BIGINT)) AS end_at,
               'user ' || user_id AS customer_phone,
               CAST(json_extract_string(props, '$.k') AS BIGINT) AS employee_id, event_type, -value AS arrival
        FROM events""",
    "order_status": "SELECT * FROM (VALUES ('F','Завершён'),('O','Готовится'),('P','В ожидании')) t(id, name)",
    "payment_type": """SELECT * FROM (VALUES ('1-URGENT','Наличные'),('2-HIGH','Банковская карта'),
        ('3-MEDIUM','QR код'),('4-NOT SPECIFIED','Счёт'),('5-LOW','Купон')) t(id, name)""",
    "delivery_status": "SELECT * FROM (VALUES ('F','Доставлен'),('O','Собирается')) t(id, name)",
    "dine_in_status": "SELECT * FROM (VALUES ('F','Подано'),('O','Ожидание')) t(id, name)",
    "unit": "SELECT * FROM (VALUES ('pc','шт'),('kg','кг'),('g','г')) t(id, name)",
    "discount_tier": """SELECT id, name, CAST(lo AS DECIMAL(10,2)) AS min_spent,
        CAST(d AS DECIMAL(5,2)) AS discount_percent, CAST(c AS DECIMAL(5,2)) AS cashback_percent
        FROM (VALUES (1,'one',0,0,5),(2,'two',2500,5,5),(3,'three',5000,10,10),
                     (4,'four',7500,15,15)) t(id, name, lo, d, c)""",
    "spending_tier": """SELECT id, name, CAST(lo AS DECIMAL(10,2)) AS min_spent,
        CAST(c AS DECIMAL(5,2)) AS cashback_percent
        FROM (VALUES (1,'one',0,5),(2,'two',1000000,5),(3,'three',2500000,10),
                     (4,'four',4000000,15)) t(id, name, lo, c)""",
    "waiting": "SELECT * FROM orders_v WHERE status_id = 'P'",
    "closed": "SELECT * FROM orders_v WHERE status_id = 'F'",
    "consumption": """
        SELECT l.order_id, r.ingredient_id, r.unit_id,
               CAST(SUM(r.quantity * l.quantity) AS DECIMAL(18,3)) AS amount
        FROM lines_v l JOIN waiting w ON w.id = l.order_id JOIN recipes_v r ON r.menu_item_id = l.menu_item_id
        GROUP BY ALL""",
    "rolled": """
        SELECT c.id, CAST(c.total_spent + COALESCE(SUM(o.total_cost), 0) AS DECIMAL(18,2)) AS total_spent,
               COUNT(o.id) AS total_orders, c.tier_id
        FROM customers_v c LEFT JOIN closed o ON o.customer_id = c.id
        GROUP BY c.id, c.total_spent, c.tier_id""",
    # a day: every order is asked for again, all that wait are cooked, completed and closed
    "asked": """
        SELECT o.id AS request_id, c.id AS customer_id, o.payment_type_id, d.address, h.table_id,
               CASE WHEN o.payment_type_id IN ('1-URGENT', '3-MEDIUM') AND COALESCE(d.courier_id, 0) <> 0
                        THEN 'delivery'
                    WHEN o.payment_type_id IN ('2-HIGH', '4-NOT SPECIFIED')
                        AND COALESCE(h.table_id, 0) <> 0 AND COALESCE(h.employee_id, 0) <> 0 THEN 'hall' END AS route
        FROM orders_v o LEFT JOIN customers_v c ON c.id = o.customer_id
        LEFT JOIN deliveries_v d ON d.order_id = o.id LEFT JOIN dine_ins_v h ON h.order_id = o.id""",
    "placed": """
        SELECT (SELECT MAX(o_orderkey) FROM orders) + ROW_NUMBER() OVER (ORDER BY request_id) AS id, *
        FROM asked WHERE route IS NOT NULL""",
    "new_lines": """
        SELECT (SELECT MAX(l_orderkey * 1000 + l_linenumber) FROM lineitem)
                 + ROW_NUMBER() OVER (ORDER BY p.id, l.menu_item_id, l.quantity) AS id,
               p.id AS order_id, l.menu_item_id, l.quantity, i.price
        FROM placed p JOIN lines_v l ON l.order_id = p.request_id JOIN items_v i ON i.id = l.menu_item_id""",
    "new_orders": """
        SELECT p.*, CAST(COALESCE(b.total, 0) AS DECIMAL(18,2)) AS total_cost,
               CAST(round(COALESCE(b.total, 0) * (100 - COALESCE(t.discount_percent, 0))
                          * CAST(0.01 AS DECIMAL(3,2)), 2) AS DECIMAL(18,2)) AS to_pay
        FROM placed p
        LEFT JOIN (SELECT order_id, CAST(SUM(price * quantity) AS DECIMAL(18,2)) AS total
                   FROM new_lines GROUP BY order_id) b ON b.order_id = p.id
        LEFT JOIN customers_v c ON c.id = p.customer_id LEFT JOIN discount_tier t ON t.id = c.tier_id""",
    "day_orders": """
        SELECT id, customer_id, status_id, total_cost, to_pay, created_at FROM orders_v WHERE status_id <> 'F'
        UNION ALL
        SELECT id, customer_id, 'P', total_cost, to_pay, TIMESTAMP '2002-01-02 09:00:00' FROM new_orders""",
    "day_lines": """
        SELECT order_id, menu_item_id, quantity FROM lines_v
        UNION ALL SELECT order_id, menu_item_id, quantity FROM new_lines""",
    "day_service": """
        SELECT order_id, 'delivery' AS route FROM deliveries_v
        UNION ALL SELECT order_id, 'hall' FROM dine_ins_v
        UNION ALL SELECT id, route FROM placed""",
    "cities_v": """
        SELECT 'depot' AS id, 'Depot' AS name, 15 AS rubies, 25 AS emeralds, 43 AS sapphires
        UNION ALL SELECT 'gate', 'Gate', 20, 30, 25
        UNION ALL SELECT 'region ' || r_regionkey, r_name, 10 + 7 * r_regionkey, 40 - 5 * r_regionkey,
                         20 + 3 * r_regionkey FROM region
        UNION ALL SELECT 'nation ' || n_nationkey, n_name, 60 + 17 * n_nationkey % 41,
                         55 + 29 * n_nationkey % 37, 37 * n_nationkey % 50 FROM nation
        UNION ALL SELECT 'customer ' || c_custkey, c_name, CAST(floor(abs(c_acctbal)) AS BIGINT) % 97,
                         (CAST(floor(abs(c_acctbal)) AS BIGINT) // 10) % 89, 31 * c_custkey % 83 FROM customer
        UNION ALL SELECT DISTINCT 'queue ' || o_orderpriority, o_orderpriority, length(o_orderpriority) * 5,
                         length(o_orderpriority) * 4, length(o_orderpriority) * 3 FROM orders""",
    "roads_v": """
        SELECT 'depot' AS a, 'region ' || r_regionkey AS b FROM region
        UNION ALL SELECT 'region ' || r_regionkey, 'region ' || (r_regionkey + 1) % 5 FROM region
        UNION ALL SELECT 'region ' || n_regionkey, 'nation ' || n_nationkey FROM nation
        UNION ALL SELECT 'nation ' || n_nationkey, 'region ' || n_regionkey FROM nation
        UNION ALL SELECT 'nation ' || c_nationkey, 'customer ' || c_custkey FROM customer
        UNION ALL SELECT 'customer ' || c_custkey, 'nation ' || c_nationkey FROM customer
        UNION ALL SELECT DISTINCT 'customer ' || o_custkey, 'queue ' || o_orderpriority FROM orders
        UNION ALL SELECT DISTINCT 'queue ' || o_orderpriority, 'gate' FROM orders""",
    "walks": """
        SELECT 'depot' AS here, ['depot'] AS path
        UNION ALL
        SELECT r.b, list_append(w.path, r.b)
        FROM walks w JOIN roads_v r ON r.a = w.here
        WHERE NOT list_contains(w.path, r.b)""",
    "routes": "SELECT path, array_to_string(path, ' -> ') AS route FROM walks WHERE here = 'gate'",
    "steps": """
        SELECT p.route, p.step, c.name AS city, p.city_id,
               greatest(0, c.rubies - p.step) AS ruby, greatest(0, c.emeralds - p.step) AS emerald,
               greatest(0, c.sapphires - p.step) AS sapphire
        FROM (SELECT route, unnest(path) AS city_id, generate_subscripts(path, 1) - 1 AS step FROM routes) p
        JOIN cities_v c ON c.id = p.city_id""",
}

# what a view is built on, in the order to declare it
_NEEDS = {
    "waiting": ["orders_v"],
    "closed": ["orders_v"],
    "consumption": ["lines_v", "recipes_v", "waiting"],
    "rolled": ["customers_v", "closed"],
    "asked": ["orders_v", "customers_v", "deliveries_v", "dine_ins_v"],
    "placed": ["asked"],
    "new_lines": ["placed", "lines_v", "items_v"],
    "new_orders": ["new_lines", "customers_v", "discount_tier"],
    "day_orders": ["orders_v", "new_orders"],
    "day_lines": ["lines_v", "new_lines"],
    "day_service": ["deliveries_v", "dine_ins_v", "placed"],
    "walks": ["roads_v"],
    "routes": ["walks"],
    "steps": ["cities_v", "routes"],
}


def _with(names: str, body: str) -> str:
    declared: list[str] = []

    def declare(name: str) -> None:
        for need in _NEEDS.get(name, []):
            declare(need)
        if name not in declared:
            declared.append(name)

    for name in names.split():
        declare(name)
    if not declared:
        return body
    ctes = ",\n".join(f"{name} AS ({VIEWS[name]})" for name in declared)
    return f"WITH RECURSIVE {ctes}\n{body}"


_STAMP = "'%Y-%m-%d %H:%M:%S'"
_APRIL = ">= TIMESTAMP '1996-04-01' AND {0} < TIMESTAMP '1996-04-30'"
_AS_OF = "TIMESTAMP '2002-01-01 00:00:30'"


def _april(column: str) -> str:
    return f"{column} " + _APRIL.format(column)


def _minutes(start: str, end: str) -> str:
    return f"CAST(round(date_diff('microsecond', {start}, {end}) / 60000000.0) AS BIGINT)"


def _service_joins(orders: str) -> str:
    return f"""
        FROM {orders} o JOIN order_status s ON s.id = o.status_id
        LEFT JOIN deliveries_v d ON d.order_id = o.id
        LEFT JOIN dine_ins_v di ON di.order_id = o.id
        LEFT JOIN seats_v t ON t.id = di.table_id
        LEFT JOIN customers_v c ON c.id = o.customer_id"""


def _admission(turn: str) -> str:
    return f"""
            , held AS (SELECT * FROM bookings_v WHERE event_type = 'purchase')
            , possible AS (
                SELECT b.*, ROW_NUMBER() OVER (PARTITION BY b.table_id ORDER BY {turn}) AS turn
                FROM bookings_v b JOIN customer ON c_custkey = b.table_id
                WHERE b.event_type <> 'purchase' AND c_mktsegment <> 'HOUSEHOLD'
                  AND NOT EXISTS (SELECT 1 FROM held h WHERE h.table_id = b.table_id
                                  AND h.start_at < b.end_at AND b.start_at < h.end_at))
            , one_by_one AS (
                SELECT table_id, CAST(0 AS BIGINT) AS turn,
                       CAST([] AS STRUCT(id BIGINT, s TIMESTAMP, e TIMESTAMP)[]) AS taken
                FROM (SELECT DISTINCT table_id FROM possible)
                UNION ALL
                SELECT t.table_id, p.turn,
                       CASE WHEN len(list_filter(t.taken, lambda x: x.s < p.end_at AND p.start_at < x.e)) > 0
                            THEN t.taken
                            ELSE list_append(t.taken, {{'id': p.id, 's': p.start_at, 'e': p.end_at}}) END
                FROM one_by_one t JOIN possible p ON p.table_id = t.table_id AND p.turn = t.turn + 1)
            , accepted AS (
                SELECT unnest(taken).id AS id
                FROM (SELECT arg_max(taken, turn) AS taken FROM one_by_one GROUP BY table_id))"""


def _audit() -> str:
    unique = {
        "region": ["r_regionkey", "r_name"],
        "nation": ["n_nationkey", "n_name"],
        "customer": ["c_custkey", "c_name"],
        "supplier": ["s_suppkey", "s_name"],
        "part": ["p_partkey", "p_name"],
        "orders": ["o_orderkey", "o_custkey,o_orderdate"],
        "lineitem": ["l_orderkey,l_linenumber"],
        "events": ["event_id", "user_id,ts"],
        "documents": ["doc_id"],
        "embeddings": ["vec_id"],
        "pages": ["page_id", "url"],
        "benchmark": ["item_id"],
        "labels": ["doc_id"],
        "conversations": ["conv_id,turn"],
    }
    mandatory = {
        "region": "r_regionkey r_name",
        "nation": "n_nationkey n_name n_regionkey",
        "customer": "c_custkey c_name c_nationkey c_acctbal",
        "supplier": "s_suppkey s_name s_nationkey",
        "part": "p_partkey p_name p_retailprice",
        "orders": "o_orderkey o_custkey o_orderdate",
        "lineitem": "l_orderkey l_linenumber l_shipdate",
        "events": "event_id ts user_id value",
        "documents": "doc_id text source",
        "embeddings": "vec_id embedding",
        "pages": "page_id url html",
        "benchmark": "item_id text",
        "labels": "doc_id quality toxic",
        "conversations": "conv_id turn role",
    }
    references = [
        ("nation", "n_regionkey", "region", "r_regionkey"),
        ("customer", "c_nationkey", "nation", "n_nationkey"),
        ("supplier", "s_nationkey", "nation", "n_nationkey"),
        ("orders", "o_custkey", "customer", "c_custkey"),
        ("lineitem", "l_orderkey", "orders", "o_orderkey"),
        ("lineitem", "l_partkey", "part", "p_partkey"),
        ("lineitem", "l_suppkey", "supplier", "s_suppkey"),
        ("events", "user_id", "supplier", "s_suppkey"),
        ("labels", "doc_id", "documents", "doc_id"),
    ]
    checks = [
        f"""SELECT '{t}' AS table_name, 'unique' AS rule, '{key}' AS columns,
            CAST(COUNT(*) - COUNT(DISTINCT ({key})) AS BIGINT) AS violations FROM {t}"""
        for t, keys in unique.items()
        for key in keys
    ]
    checks += [
        f"SELECT '{t}', 'one_to_one', '{c}', COUNT({c}) - COUNT(DISTINCT {c}) FROM {t}"
        for t, c in (("orders", "o_custkey"), ("labels", "doc_id"))
    ]
    checks += [
        f"SELECT '{t}', 'not_null', '{c}', COUNT(*) FILTER ({c} IS NULL) FROM {t}"
        for t, columns in mandatory.items()
        for c in columns.split()
    ]
    checks += [
        f"""SELECT '{t}', 'foreign', '{c}', COUNT(*) FROM {t}
            WHERE {c} IS NOT NULL AND NOT EXISTS (SELECT 1 FROM {p} WHERE {p}.{k} = {t}.{c})"""
        for t, c, p, k in references
    ]
    return "\nUNION ALL\n".join(checks)


def oracle_sql() -> dict[str, str]:
    return {
        "pnl_by_day": _with(
            "orders_v",
            f"""
            , daily AS (
                SELECT CAST(CAST(created_at AS DATE) AS VARCHAR) AS day,
                       SUM(CASE WHEN status_id = 'F' THEN to_pay ELSE 0 END) AS revenue,
                       SUM(CASE WHEN status_id = 'O' THEN to_pay ELSE 0 END) AS expense
                FROM orders_v WHERE {_april('created_at')} GROUP BY 1)
            SELECT day, CAST(revenue AS DOUBLE) AS revenue, CAST(expense AS DOUBLE) AS expense,
                   CAST(revenue - expense AS DOUBLE) AS profit FROM daily
            UNION ALL
            SELECT 'Всего за период', CAST(SUM(revenue) AS DOUBLE), CAST(SUM(expense) AS DOUBLE),
                   CAST(SUM(revenue) - SUM(expense) AS DOUBLE) FROM daily""",
        ),
        "popular_items": _with(
            "orders_v lines_v items_v",
            f"""
            SELECT i.id AS menu_item_id, i.name AS dish_name, CAST(SUM(l.quantity) AS BIGINT) AS total_quantity,
                   COUNT(DISTINCT l.order_id) AS orders_count,
                   CAST(SUM(l.item_cost * l.quantity) AS DOUBLE) AS total_revenue
            FROM lines_v l JOIN items_v i ON i.id = l.menu_item_id JOIN orders_v o ON o.id = l.order_id
            WHERE {_april('o.created_at')} AND o.status_id <> 'P'
            GROUP BY i.id, i.name""",
        ),
        "producible_portions": _with(
            "recipes_v items_v stock_v",
            """
            SELECT i.id AS menu_item_id, i.name AS dish,
                   MIN(CAST(s.quantity * 1000 AS BIGINT) // CAST(r.quantity * 1000 AS BIGINT)) AS count_of_portions
            FROM recipes_v r JOIN items_v i ON i.id = r.menu_item_id
            JOIN stock_v s ON s.ingredient_id = r.ingredient_id
            WHERE i.is_available GROUP BY i.id, i.name""",
        ),
        "copurchase_pairs": _with(
            "lines_v items_v",
            """
            SELECT i.id AS item_1, j.id AS item_2, i.name AS dish_1, j.name AS dish_2,
                   COUNT(DISTINCT a.order_id) AS count_of_joint_orders
            FROM lines_v a JOIN lines_v b ON a.order_id = b.order_id AND a.menu_item_id < b.menu_item_id
            JOIN items_v i ON i.id = a.menu_item_id JOIN items_v j ON j.id = b.menu_item_id
            GROUP BY ALL HAVING COUNT(DISTINCT a.order_id) >= 2""",
        ),
        "free_resources_at": _with(
            "bookings_v",
            """
            SELECT c_custkey AS number, c_nationkey AS capacity, c_mktsegment AS location
            FROM customer
            WHERE c_mktsegment <> 'HOUSEHOLD'
              AND c_custkey NOT IN (
                SELECT table_id FROM bookings_v
                WHERE CAST(start_at AS DATE) = DATE '2024-01-15'
                  AND start_at <= TIMESTAMP '2024-01-15 12:00:00' AND end_at > TIMESTAMP '2024-01-15 12:00:00')
              AND c_custkey NOT IN (
                SELECT user_id FROM events
                WHERE event_type NOT IN ('signup', 'view') AND CAST(ts AS DATE) = DATE '2024-01-15'
                  AND ts <= TIMESTAMP '2024-01-15 12:00:00')""",
        ),
        "weekday_profile": _with(
            "orders_v",
            """
            , daily AS (SELECT CAST(created_at AS DATE) AS d, COUNT(*) AS n, SUM(to_pay) AS revenue,
                               SUM(to_pay) / COUNT(*) AS bill
                        FROM orders_v GROUP BY 1)
            SELECT CAST(dayofweek(d) AS INTEGER) AS day_number,
                   ['Воскресенье', 'Понедельник', 'Вторник', 'Среда', 'Четверг', 'Пятница',
                    'Суббота'][dayofweek(d) + 1] AS week_day,
                   round(AVG(n), 0) AS average_orders, round(AVG(revenue), 2) AS average_revenue,
                   round(AVG(bill), 2) AS average_check
            FROM daily GROUP BY ALL""",
        ),
        "delivered_materials": f"""
            SELECT l_partkey AS ingredient_id, p_name AS ingredient,
                   CAST(SUM(l_quantity) AS DOUBLE) AS quantity_of_delivered,
                   CASE l_returnflag WHEN 'A' THEN 'кг' WHEN 'N' THEN 'г' ELSE 'шт' END AS unit,
                   COUNT(DISTINCT l_orderkey) AS count_of_supplies,
                   CAST(SUM(CAST(l_extendedprice AS DECIMAL(18,2))) AS DOUBLE) AS money_spent
            FROM lineitem JOIN orders ON o_orderkey = l_orderkey JOIN part ON p_partkey = l_partkey
            WHERE {_april('o_orderdate')} AND o_orderstatus = 'F'
            GROUP BY l_partkey, p_name, l_returnflag""",
        "snapshot_prices": _with(
            "lines_v items_v",
            """
            SELECT l.order_id, l.menu_item_id, CAST(i.price AS DOUBLE) AS item_cost, l.quantity
            FROM lines_v l JOIN items_v i ON i.id = l.menu_item_id""",
        ),
        "rejected_lines": _with(
            "lines_v items_v",
            """
            SELECT order_id, menu_item_id, quantity FROM lines_v
            WHERE menu_item_id NOT IN (SELECT id FROM items_v WHERE is_available)""",
        ),
        "price_baskets": _with(
            "orders_v lines_v items_v customers_v discount_tier",
            """
            , basket AS (SELECT l.order_id, CAST(SUM(i.price * l.quantity) AS DECIMAL(18,2)) AS total
                         FROM lines_v l JOIN items_v i ON i.id = l.menu_item_id GROUP BY l.order_id)
            SELECT o.id AS order_id, o.customer_id, CAST(COALESCE(b.total, 0) AS DOUBLE) AS total_cost,
                   CAST(round(COALESCE(b.total, 0) * (100 - COALESCE(t.discount_percent, 0))
                              * CAST(0.01 AS DECIMAL(3,2)), 2) AS DOUBLE) AS to_pay
            FROM orders_v o LEFT JOIN basket b ON b.order_id = o.id
            LEFT JOIN customers_v c ON c.id = o.customer_id LEFT JOIN discount_tier t ON t.id = c.tier_id""",
        ),
        "resolve_customers": """
            SELECT o_orderkey AS request_id,
                   CASE WHEN o_orderpriority = '5-LOW' THEN 'Guest#' ELSE 'Customer#' END
                     || lpad(CAST(o_custkey AS VARCHAR), 9, '0') AS customer_phone,
                   CASE WHEN o_orderpriority <> '5-LOW' THEN c_custkey END AS customer_id
            FROM orders LEFT JOIN customer ON c_custkey = o_custkey""",
        "split_service_type": _with(
            "orders_v deliveries_v dine_ins_v",
            """
            , asked AS (
                SELECT o.id AS order_id,
                       CASE WHEN payment_type_id IN ('1-URGENT', '3-MEDIUM') THEN 'delivery'
                            WHEN payment_type_id IN ('2-HIGH', '4-NOT SPECIFIED') THEN 'dine_in'
                            ELSE 'takeaway' END AS order_type,
                       d.address, d.courier_id, h.table_id, h.employee_id
                FROM orders_v o LEFT JOIN deliveries_v d ON d.order_id = o.id
                LEFT JOIN dine_ins_v h ON h.order_id = o.id)
            , judged AS (
                SELECT *, CASE
                    WHEN order_type = 'dine_in' AND COALESCE(table_id, 0) <> 0 AND COALESCE(employee_id, 0) <> 0
                        THEN 'hall'
                    WHEN order_type = 'delivery' AND COALESCE(address, '') <> '' AND COALESCE(courier_id, 0) <> 0
                        THEN 'delivery'
                    ELSE 'rejected' END AS route
                FROM asked)
            SELECT *, CASE WHEN route <> 'rejected' THEN NULL
                           WHEN order_type = 'dine_in' THEN 'table or waiter missing'
                           WHEN order_type = 'delivery' THEN 'address or courier missing'
                           ELSE 'unknown order type' END AS reason
            FROM judged""",
        ),
        "surrogate_keys": f"""
            SELECT o_orderkey AS order_id, strftime(o_orderdate, {_STAMP}) AS created_at,
                   (SELECT MAX(p_partkey) FROM part)
                     + ROW_NUMBER() OVER (ORDER BY o_orderdate, o_orderkey) AS id
            FROM orders""",
        "pick_orders": _with(
            "waiting",
            f"""
            SELECT id, customer_id, status_id, CAST(total_cost AS DOUBLE) AS total_cost,
                   strftime(created_at, {_STAMP}) AS created_at
            FROM (SELECT * FROM waiting w ORDER BY w.created_at, w.id LIMIT 20)""",
        ),
        "advance_status": f"""
            SELECT o_orderkey AS id, CASE o_orderstatus WHEN 'P' THEN 'O' ELSE o_orderstatus END AS status_id,
                   strftime(o_orderdate, {_STAMP}) AS created_at
            FROM orders""",
        "material_consumption": _with(
            "consumption",
            "SELECT order_id, ingredient_id, unit_id, CAST(amount AS DOUBLE) AS amount FROM consumption",
        ),
        "stock_after_consumption": _with(
            "consumption stock_v",
            """
            SELECT s.ingredient_id, s.unit_id,
                   CAST(s.quantity - COALESCE((SELECT SUM(c.amount) FROM consumption c
                        WHERE c.ingredient_id = s.ingredient_id AND c.unit_id = s.unit_id), 0) AS DOUBLE) AS quantity
            FROM stock_v s""",
        ),
        "post_sales": _with(
            "closed",
            """
            SELECT (SELECT MAX(p_partkey) FROM part) + ROW_NUMBER() OVER (ORDER BY o.created_at, o.id) AS id,
                   1 AS transaction_type_id, CAST(o.to_pay AS DOUBLE) AS amount,
                   '2002-01-01 00:00:30' AS transaction_date, 'Оплата заказа ' || o.id AS description,
                   1 AS category_id, o.id AS order_id
            FROM closed o""",
        ),
        "customer_rollup": _with(
            "rolled", "SELECT id, CAST(total_spent AS DOUBLE) AS total_spent, total_orders FROM rolled"
        ),
        "tier_assignment": _with(
            "rolled spending_tier",
            """
            SELECT r.id, CAST(r.total_spent AS DOUBLE) AS total_spent, r.total_orders,
                   COALESCE((SELECT MAX(t.id) FROM spending_tier t WHERE t.min_spent <= r.total_spent),
                            r.tier_id) AS last_achieved_tier_id
            FROM rolled r""",
        ),
        "cashback_accrual": _with(
            "closed customers_v spending_tier",
            """
            , running AS (
                SELECT o.customer_id, o.id, o.total_cost, c.tier_id AS old_tier,
                       c.total_spent + SUM(o.total_cost) OVER (PARTITION BY o.customer_id
                           ORDER BY o.created_at, o.id ROWS UNBOUNDED PRECEDING) AS spent
                FROM closed o JOIN customers_v c ON c.id = o.customer_id)
            , tiered AS (
                SELECT r.*, COALESCE((SELECT MAX(t.id) FROM spending_tier t WHERE t.min_spent <= r.spent),
                                     r.old_tier) AS tier_id
                FROM running r)
            SELECT r.customer_id, r.id AS order_id,
                   CAST(round(r.total_cost * t.cashback_percent * CAST(0.01 AS DECIMAL(3,2)), 2) AS DOUBLE)
                     AS points_amount,
                   t.cashback_percent || '% кешбэк с заказа на ' || r.total_cost || ' рублей (уровень '
                     || t.name || ')' AS description,
                   r.tier_id
            FROM tiered r JOIN spending_tier t ON t.id = r.tier_id""",
        ),
        "order_report_hall": _with(
            "orders_v order_status payment_type dine_ins_v seats_v employees_v customers_v",
            f"""
            SELECT o.id AS order_id, strftime(o.created_at, {_STAMP}) AS created_at, s.name AS status,
                   p.name AS payment_type, t.number AS table_number, e.full_name AS waiter, o.comment,
                   CAST(o.total_cost AS DOUBLE) AS total_cost, CAST(o.to_pay AS DOUBLE) AS to_pay,
                   c.full_name AS customer, c.phone AS customer_phone
            FROM orders_v o JOIN order_status s ON s.id = o.status_id
            JOIN payment_type p ON p.id = o.payment_type_id JOIN dine_ins_v di ON di.order_id = o.id
            JOIN seats_v t ON t.id = di.table_id JOIN employees_v e ON e.id = di.employee_id
            LEFT JOIN customers_v c ON c.id = o.customer_id""",
        ),
        "order_report_delivery": _with(
            "orders_v order_status payment_type deliveries_v delivery_status employees_v customers_v",
            f"""
            SELECT o.id AS order_id, strftime(o.created_at, {_STAMP}) AS created_at, s.name AS status,
                   p.name AS payment_type, d.address AS delivery_address, ds.name AS delivery_status,
                   e.full_name AS courier, r.r_name AS courier_company, o.comment,
                   CAST(o.total_cost AS DOUBLE) AS total_cost, CAST(o.to_pay AS DOUBLE) AS to_pay,
                   c.full_name AS customer, c.phone AS customer_phone
            FROM orders_v o JOIN order_status s ON s.id = o.status_id
            JOIN payment_type p ON p.id = o.payment_type_id JOIN deliveries_v d ON d.order_id = o.id
            JOIN delivery_status ds ON ds.id = d.delivery_status_id JOIN employees_v e ON e.id = d.courier_id
            LEFT JOIN region r ON r.r_regionkey = e.company_id
            LEFT JOIN customers_v c ON c.id = o.customer_id""",
        ),
        "order_lines": _with(
            "items_v",
            f"""
            SELECT l_orderkey * 1000 + l_linenumber AS line_id, l_orderkey AS order_id, l_partkey AS menu_item_id,
                   i.name AS item, CAST(l_quantity AS INTEGER) AS quantity,
                   CAST(CAST(l_extendedprice AS DECIMAL(18,2)) AS DOUBLE) AS price_per_item,
                   CAST(CAST(l_quantity AS INTEGER) * CAST(l_extendedprice AS DECIMAL(18,2)) AS DOUBLE) AS total_price,
                   strftime(l_shipdate, {_STAMP}) AS created_at
            FROM lineitem JOIN items_v i ON i.id = l_partkey""",
        ),
        "kitchen_report": _with(
            "waiting order_status deliveries_v dine_ins_v seats_v customers_v",
            f"""
            SELECT o.id AS order_id, s.name AS order_status, strftime(o.created_at, {_STAMP}) AS order_created,
                   '2002-01-01 00:00:30' AS cooking_started,
                   CASE WHEN d.order_id IS NOT NULL THEN 'Доставка: ' || d.address
                        WHEN di.order_id IS NOT NULL THEN 'В зале: стол ' || t.number END AS order_type,
                   c.full_name AS customer, c.phone AS customer_phone
            {_service_joins('waiting')}""",
        ),
        "line_materials_text": _with(
            "lines_v items_v recipes_v ingredients_v unit",
            """
            SELECT l.id AS line_id, l.order_id, l.menu_item_id, i.name AS dish, l.quantity,
                   CAST(l.item_cost AS DOUBLE) AS price, CAST(l.quantity * l.item_cost AS DOUBLE) AS total_price,
                   string_agg(g.name || ': ' || CAST(r.quantity * l.quantity AS DECIMAL(10,3)) || ' ' || u.name,
                              ', ' ORDER BY r.id) AS ingredients_used
            FROM lines_v l JOIN items_v i ON i.id = l.menu_item_id
            LEFT JOIN recipes_v r ON r.menu_item_id = l.menu_item_id
            LEFT JOIN ingredients_v g ON g.id = r.ingredient_id LEFT JOIN unit u ON u.id = r.unit_id
            GROUP BY l.id, l.order_id, l.menu_item_id, i.name, l.quantity, l.item_cost""",
        ),
        "affected_stock": _with(
            "waiting lines_v recipes_v stock_v ingredients_v unit",
            """
            SELECT s.ingredient_id, g.name AS ingredient, CAST(s.quantity AS DOUBLE) AS current_stock,
                   u.name AS unit
            FROM stock_v s JOIN ingredients_v g ON g.id = s.ingredient_id JOIN unit u ON u.id = s.unit_id
            WHERE s.ingredient_id IN (
                SELECT r.ingredient_id FROM waiting w JOIN lines_v l ON l.order_id = w.id
                JOIN recipes_v r ON r.menu_item_id = l.menu_item_id)""",
        ),
        "fulfilment_report": _with(
            "orders_v order_status payment_type lines_v deliveries_v dine_ins_v seats_v customers_v",
            f"""
            , done AS (SELECT order_id, MAX(cooked_at) AS cooked_at FROM lines_v GROUP BY order_id)
            SELECT o.id AS order_id, s.name AS order_status, strftime(o.created_at, {_STAMP}) AS order_created,
                   strftime((SELECT cooked_at FROM done WHERE done.order_id = o.id), {_STAMP}) AS cooking_finished,
                   {_minutes('o.created_at', _AS_OF)} AS total_minutes,
                   CASE WHEN d.order_id IS NOT NULL THEN 'Доставка'
                        WHEN di.order_id IS NOT NULL THEN 'В зале' END AS order_type,
                   CASE WHEN d.order_id IS NOT NULL THEN d.address
                        WHEN di.order_id IS NOT NULL THEN 'Стол ' || t.number || ' (' || t.location || ')'
                   END AS destination,
                   c.full_name AS customer, c.phone AS customer_phone,
                   CAST(o.total_cost AS DOUBLE) AS total_cost, CAST(o.to_pay AS DOUBLE) AS to_pay,
                   (SELECT name FROM payment_type p WHERE p.id = o.payment_type_id) AS payment_type
            {_service_joins('orders_v')}""",
        ),
        "prep_minutes": _with(
            "orders_v lines_v items_v",
            f"""
            SELECT l.id AS line_id, l.order_id, l.menu_item_id, i.name AS dish, l.quantity,
                   CAST(l.item_cost AS DOUBLE) AS price, CAST(l.quantity * l.item_cost AS DOUBLE) AS total_price,
                   strftime(o.created_at, {_STAMP}) AS ordered_at, strftime(l.cooked_at, {_STAMP}) AS cooked_at,
                   {_minutes('o.created_at', 'l.cooked_at')} AS cooking_minutes
            FROM lines_v l JOIN orders_v o ON o.id = l.order_id JOIN items_v i ON i.id = l.menu_item_id""",
        ),
        "carrier_report": _with(
            "deliveries_v delivery_status employees_v",
            """
            SELECT d.order_id, e.full_name AS courier, e.phone AS courier_phone, r.r_name AS courier_company,
                   d.address AS delivery_address, s.name AS delivery_status
            FROM deliveries_v d JOIN employees_v e ON e.id = d.courier_id
            JOIN region r ON r.r_regionkey = e.company_id JOIN delivery_status s ON s.id = d.delivery_status_id""",
        ),
        "delivery_report": _with(
            "deliveries_v delivery_status employees_v",
            """
            SELECT d.order_id, s.name AS delivery_status, d.address AS delivery_address, e.full_name AS courier
            FROM deliveries_v d JOIN employees_v e ON e.id = d.courier_id
            JOIN delivery_status s ON s.id = d.delivery_status_id""",
        ),
        "waiter_report": _with(
            "dine_ins_v dine_in_status employees_v seats_v",
            """
            SELECT d.order_id, e.full_name AS waiter, t.number AS table_number, t.location AS table_location,
                   s.name AS dine_in_status
            FROM dine_ins_v d JOIN employees_v e ON e.id = d.employee_id JOIN seats_v t ON t.id = d.table_id
            JOIN dine_in_status s ON s.id = d.status_id""",
        ),
        "payment_report": _with(
            "orders_v order_status payment_type",
            f"""
            , shipped AS (SELECT l_orderkey AS id, MAX(l_shipdate) AS closed_at FROM lineitem GROUP BY 1)
            SELECT o.id AS order_id, s.name AS order_status, strftime(o.created_at, {_STAMP}) AS order_created,
                   strftime(h.closed_at, {_STAMP}) AS closed_at,
                   {_minutes('o.created_at', 'h.closed_at')} AS total_minutes,
                   CAST(o.total_cost AS DOUBLE) AS total_cost, CAST(o.to_pay AS DOUBLE) AS paid_amount,
                   p.name AS payment_type, CAST(o.to_pay AS DOUBLE) AS financial_amount,
                   CASE o.status_id WHEN 'F' THEN 'Доход' ELSE 'Расход' END AS financial_type,
                   CASE o.status_id WHEN 'F' THEN 'Продажи' ELSE 'Прочее' END AS financial_category,
                   o.id AS financial_transaction_id
            FROM orders_v o JOIN order_status s ON s.id = o.status_id
            JOIN payment_type p ON p.id = o.payment_type_id LEFT JOIN shipped h ON h.id = o.id
            WHERE o.status_id <> 'P'""",
        ),
        "loyalty_report": _with(
            "closed customers_v discount_tier",
            """
            SELECT o.id AS order_id, c.full_name AS customer, c.phone AS customer_phone,
                   CAST(c.total_spent AS DOUBLE) AS total_spent_all_time, c.total_orders AS total_orders_all_time,
                   t.name AS current_loyalty_tier, CAST(t.discount_percent AS DOUBLE) AS discount_percent,
                   CAST(t.cashback_percent AS DOUBLE) AS cashback_percent,
                   CAST(round(o.total_cost * CAST(0.05 AS DECIMAL(3,2)), 2) AS DOUBLE) AS earned_cashback,
                   'order ' || o.id AS cashback_description
            FROM closed o JOIN customers_v c ON c.id = o.customer_id JOIN discount_tier t ON t.id = c.tier_id""",
        ),
        "reservation_conflicts": _with(
            "bookings_v",
            f"""
            SELECT r.id AS request_id, r.table_id, strftime(r.start_at, {_STAMP}) AS start_at,
                   strftime(r.end_at, {_STAMP}) AS end_at, COUNT(e.id) AS conflicts
            FROM bookings_v r LEFT JOIN (SELECT * FROM bookings_v WHERE event_type = 'purchase') e
              ON e.table_id = r.table_id AND e.start_at < r.end_at AND r.start_at < e.end_at
            WHERE r.event_type <> 'purchase'
            GROUP BY r.id, r.table_id, r.start_at, r.end_at""",
        ),
        "conflict_rows": _with(
            "bookings_v",
            f"""
            SELECT r.id AS request_id, e.id AS reservation_id, e.table_id, strftime(e.start_at, {_STAMP}) AS start_at,
                   strftime(e.end_at, {_STAMP}) AS end_at
            FROM bookings_v r JOIN bookings_v e
              ON e.table_id = r.table_id AND e.start_at < r.end_at AND r.start_at < e.end_at
            WHERE r.event_type <> 'purchase' AND e.event_type = 'purchase'""",
        ),
        "admit_reservations": _with(
            "bookings_v",
            f"""
            {_admission("b.arrival, b.id")}
            SELECT id AS request_id, table_id, id IN (SELECT id FROM accepted) AS accepted
            FROM bookings_v WHERE event_type <> 'purchase'""",
        ),
        "reservation_confirmations": _with(
            "bookings_v employees_v",
            """
            SELECT b.id AS reservation_id, c.c_custkey AS table_number, c.c_nationkey AS table_capacity,
                   c.c_mktsegment AS table_location, CAST(CAST(b.start_at AS DATE) AS VARCHAR) AS reservation_date,
                   strftime(b.start_at, '%H:%M:%S') AS reservation_time_start,
                   strftime(b.end_at, '%H:%M:%S') AS reservation_time_end, b.customer_phone,
                   e.full_name AS created_by
            FROM bookings_v b JOIN customer c ON c.c_custkey = b.table_id
            JOIN employees_v e ON e.id = b.employee_id""",
        ),
        "enumerate_routes": _with(
            "routes", "SELECT route AS path, CAST(len(path) - 1 AS INTEGER) AS steps FROM routes"
        ),
        "route_steps": _with(
            "steps", "SELECT route AS path, CAST(step AS INTEGER) AS step, city_id, city FROM steps"
        ),
        "text_route_steps": _with(
            "steps",
            """
            SELECT string_agg(city, ' -> ' ORDER BY step)
                       OVER (PARTITION BY route ROWS BETWEEN UNBOUNDED PRECEDING AND UNBOUNDED FOLLOWING) AS text,
                   route AS path, CAST(step AS INTEGER) AS step, city_id, city
            FROM steps""",
        ),
        "route_step_values": _with(
            "steps",
            """
            SELECT route AS path, CAST(step AS INTEGER) AS step, city_id, city,
                   CAST(ruby AS INTEGER) AS ruby_value, CAST(emerald AS INTEGER) AS emerald_value,
                   CAST(sapphire AS INTEGER) AS sapphire_value
            FROM steps""",
        ),
        "best_routes": _with(
            "steps",
            """
            , hauls AS (
                SELECT route, string_agg(city, ' -> ' ORDER BY step) AS names, COUNT(*) AS n,
                       MAX(ruby) AS r, MAX(emerald) AS e, MAX(sapphire) AS s
                FROM steps GROUP BY route)
            , best AS (SELECT * FROM hauls WHERE r + e + s = (SELECT MAX(r + e + s) FROM hauls))
            , shortest AS (SELECT * FROM best WHERE n = (SELECT MIN(n) FROM best))
            SELECT b.names AS path, CAST(b.r + b.e + b.s AS INTEGER) AS total_jewelry, x.city AS ruby_city,
                   y.city AS emerald_city, z.city AS sapphire_city
            FROM shortest b JOIN steps x ON x.route = b.route AND x.ruby = b.r
            JOIN steps y ON y.route = b.route AND y.emerald = b.e
            JOIN steps z ON z.route = b.route AND z.sapphire = b.s""",
        ),
        "typed_scan": f"""
            SELECT o_orderkey, o_custkey, o_totalprice, strftime(o_orderdate, {_STAMP}) AS o_orderdate,
                   o_orderpriority, CAST(0 AS DOUBLE) AS to_pay, TRUE AS is_open,
                   '2002-01-01 00:00:30' AS loaded_at, CAST(NULL AS VARCHAR) AS note
            FROM orders""",
        "constraint_audit": _audit(),
        "stored_update": _with(
            "orders_v",
            f"""
            SELECT id, customer_id, CAST(to_pay AS DOUBLE) AS to_pay, strftime(created_at, {_STAMP}) AS created_at,
                   CASE WHEN status_id = 'P' AND {_april('created_at')} THEN 'O' ELSE status_id END AS status_id
            FROM orders_v
            WHERE created_at >= TIMESTAMP '1996-03-10' AND created_at < TIMESTAMP '1996-06-20 12:00:00'""",
        ),
        "place_orders": _with(
            "new_orders deliveries_v dine_ins_v",
            """
            , lines AS (SELECT order_id, COUNT(*) AS n_lines, MIN(id) AS first_line_id FROM new_lines GROUP BY order_id)
            , served AS (SELECT id, ROW_NUMBER() OVER (PARTITION BY route ORDER BY id) AS k FROM placed)
            SELECT o.id AS order_id, o.customer_id, 'P' AS status_id, o.payment_type_id,
                   CAST(o.total_cost AS DOUBLE) AS total_cost, CAST(o.to_pay AS DOUBLE) AS to_pay,
                   '2002-01-02 09:00:00' AS created_at, l.n_lines, l.first_line_id,
                   CASE WHEN route = 'delivery' THEN (SELECT MAX(order_id) FROM deliveries_v) + k END AS delivery_id,
                   CASE WHEN route = 'delivery' THEN o.address END AS address,
                   CASE WHEN route = 'delivery' THEN 'O' END AS delivery_status_id,
                   CASE WHEN route = 'hall' THEN (SELECT MAX(order_id) FROM dine_ins_v) + k END AS dine_in_id,
                   CASE WHEN route = 'hall' THEN o.table_id END AS table_id,
                   CASE WHEN route = 'hall' THEN 'O' END AS dine_in_status_id
            FROM new_orders o JOIN served s ON s.id = o.id LEFT JOIN lines l ON l.order_id = o.id""",
        ),
        "cook_orders": _with(
            "day_orders day_lines recipes_v stock_v",
            """
            , operations AS (
                SELECT id AS order_id, (SELECT MAX(o_orderkey) FROM orders WHERE o_orderstatus = 'F')
                         + ROW_NUMBER() OVER (ORDER BY created_at, id) AS operation_id
                FROM day_orders WHERE status_id = 'P')
            , used AS (
                SELECT o.operation_id, r.ingredient_id, r.unit_id,
                       CAST(SUM(r.quantity * l.quantity) AS DECIMAL(18,3)) AS amount
                FROM operations o JOIN day_lines l ON l.order_id = o.order_id
                JOIN recipes_v r ON r.menu_item_id = l.menu_item_id GROUP BY ALL)
            , taken AS (SELECT ingredient_id, unit_id, SUM(amount) AS amount FROM used GROUP BY ALL)
            SELECT (SELECT MAX(l_orderkey * 1000 + l_linenumber) FROM lineitem)
                     + ROW_NUMBER() OVER (ORDER BY u.operation_id, u.ingredient_id, u.unit_id) AS id,
                   u.operation_id, u.ingredient_id, 2 AS operation_type_id, u.unit_id,
                   CAST(u.amount AS DOUBLE) AS amount, CAST(s.quantity - t.amount AS DOUBLE) AS left_in_stock
            FROM used u JOIN taken t ON t.ingredient_id = u.ingredient_id AND t.unit_id = u.unit_id
            LEFT JOIN stock_v s ON s.ingredient_id = u.ingredient_id AND s.unit_id = u.unit_id""",
        ),
        "complete_orders": _with(
            "day_orders day_lines day_service",
            """
            , lines AS (SELECT order_id, COUNT(*) AS n_lines FROM day_lines GROUP BY order_id)
            SELECT o.id AS order_id, 'R' AS status_id, l.n_lines,
                   CASE WHEN l.n_lines > 0 THEN '2002-01-02 11:00:00' END AS first_cooked,
                   CASE WHEN l.n_lines > 0 THEN '2002-01-02 11:00:00' END AS last_cooked,
                   CASE WHEN o.id IN (SELECT order_id FROM day_service WHERE route = 'delivery') THEN 'P' END
                     AS delivery_status_id,
                   CASE WHEN o.id IN (SELECT order_id FROM day_service WHERE route = 'hall') THEN 'F' END
                     AS dine_in_status_id
            FROM day_orders o LEFT JOIN lines l ON l.order_id = o.id""",
        ),
        "close_orders": _with(
            "day_orders day_service customers_v spending_tier",
            """
            , running AS (
                SELECT o.id, o.total_cost, c.tier_id AS old_tier,
                       c.total_spent + SUM(o.total_cost) OVER (PARTITION BY c.id
                           ORDER BY o.created_at, o.id ROWS UNBOUNDED PRECEDING) AS spent
                FROM day_orders o JOIN customers_v c ON c.id = o.customer_id)
            , earned AS (
                SELECT r.id, (SELECT MAX(id) FROM orders_v WHERE customer_id IS NOT NULL)
                         + ROW_NUMBER() OVER (ORDER BY r.id) AS loyalty_id,
                       round(r.total_cost * t.cashback_percent * CAST(0.01 AS DECIMAL(3,2)), 2) AS points
                FROM running r JOIN spending_tier t ON t.id = COALESCE(
                    (SELECT MAX(x.id) FROM spending_tier x WHERE x.min_spent <= r.spent), r.old_tier))
            , grown AS (
                SELECT c.id, c.tier_id, CAST(c.total_spent + COALESCE(SUM(o.total_cost), 0) AS DECIMAL(18,2)) AS spent,
                       COUNT(o.id) AS n
                FROM customers_v c LEFT JOIN day_orders o ON o.customer_id = c.id GROUP BY c.id, c.tier_id, c.total_spent)
            SELECT o.id AS order_id, o.customer_id, 'F' AS status_id, '2002-01-02 12:00:00' AS closed_at,
                   (SELECT MAX(id) FROM orders_v WHERE status_id <> 'P')
                     + ROW_NUMBER() OVER (ORDER BY o.created_at, o.id) AS financial_transaction_id,
                   CAST(o.to_pay AS DOUBLE) AS amount, e.loyalty_id, CAST(e.points AS DOUBLE) AS points_amount,
                   CASE WHEN o.id IN (SELECT order_id FROM day_service WHERE route = 'delivery') THEN 'F' END
                     AS delivery_status_id,
                   CAST(g.spent AS DOUBLE) AS total_spent, g.n AS total_orders,
                   COALESCE((SELECT MAX(x.id) FROM spending_tier x WHERE x.min_spent <= g.spent), g.tier_id)
                     AS last_achieved_tier_id
            FROM day_orders o LEFT JOIN earned e ON e.id = o.id LEFT JOIN grown g ON g.id = o.customer_id""",
        ),
        "book_tables": _with(
            "bookings_v",
            f"""
            {_admission("b.id")}
            SELECT (SELECT MAX(id) FROM held) + ROW_NUMBER() OVER (ORDER BY e.event_id) AS id, e.user_id AS table_id,
                   'user ' || e.user_id AS customer_phone, strftime(e.ts, '%Y-%m-%d') AS reservation_date,
                   strftime(e.ts, '%H:%M:%S.%f') AS reservation_time, e.value AS duration_minutes
            FROM events e WHERE e.event_id IN (SELECT id FROM accepted)""",
        ),
    }
