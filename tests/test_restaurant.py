"""Golden results on the restaurant's rows."""

from __future__ import annotations

from decimal import Decimal as D

import pytest
from pyspark.sql import functions as F

from tests.restaurant import LOADED, network, tables
from venueops.functions.columns import id_of
from venueops.operators import audit, baskets, bookings, lifecycle, receipts, reports, routes
from venueops.plans import workflows
from venueops.sources.schema import RESTAURANT, Reference, Table
from venueops.sources.tables import typed

APRIL = ("2026-04-01", "2026-04-30")


@pytest.fixture(scope="module")
def t(spark):
    return {name: df.cache() for name, df in tables(spark).items()}


def got(df, *columns):
    return [tuple(row) for row in (df.select(*columns) if columns else df).collect()]


def test_39_tables_are_declared(spark):
    assert len(RESTAURANT) == 39
    for table in RESTAURANT.values():
        assert table.schema["id"].nullable is False
        assert set(table.defaults) | set(table.foreign) <= set(table.schema.names)
        assert {ref.name for ref in table.foreign.values()} <= set(RESTAURANT)


def test_pnl_by_day(t):
    df = reports.pnl_by_day(t["FinancialTransactions"], t["FinancialTransactionTypes"], *APRIL)
    assert sorted(got(df)) == [
        ("2026-04-01", 0, 50000, -50000),
        ("2026-04-03", 0, 15000, -15000),
        ("2026-04-05", 2140, 0, 2140),
        ("2026-04-10", 0, 8000, -8000),
        ("2026-04-12", 1870, 0, 1870),
        ("Всего за период", 4010, 73000, -68990),
    ]


def test_pnl_of_an_empty_period_has_a_total_without_sums(t):
    df = reports.pnl_by_day(
        t["FinancialTransactions"], t["FinancialTransactionTypes"], "2020-01-01", "2020-02-01"
    )
    assert got(df) == [("Всего за период", None, None, None)]


def test_the_end_of_a_period_is_not_part_of_it(t):
    ledger, types = t["FinancialTransactions"], t["FinancialTransactionTypes"]
    assert len(got(reports.pnl_by_day(ledger, types, "2026-04-01", "2026-04-01 10:00:00"))) == 1
    assert len(got(reports.pnl_by_day(ledger, types, "2026-04-01 10:00:00", "2026-04-02"))) == 2


def test_popular_items(t):
    df = reports.popular_items(t["OrderItems"], t["Orders"], t["MenuItems"], t["OrderStatuses"], *APRIL)
    assert got(df, "dish_name", "total_quantity", "orders_count", "total_revenue") == [
        ("Пятиэтажный бургер", 3, 2, 1350),
        ("Вино", 1, 1, 350),
        ("Картофель три", 1, 1, 250),
        ("Сырный торт", 1, 1, 320),
    ]


def test_producible_portions(t):
    df = reports.producible_portions(t["RecipeItems"], t["MenuItems"], t["IngredientInventory"])
    assert got(df, "dish", "count_of_portions") == [
        ("Вино", 45), ("Пятиэтажный бургер", 50), ("Сырный торт", 62), ("Кофе", 66), ("Кола", 80),
        ("Картофель три", 125), ("Крутой суп", 250),
    ]


def test_stock_at_zero_makes_no_portion_and_need_of_zero_limits_nothing(t):
    stock = t["IngredientInventory"].withColumn(
        "quantity", F.when(F.col("ingredient_id") == 9, 0).otherwise(F.col("quantity"))
    )
    needs = t["RecipeItems"].withColumn(
        "quantity", F.when(F.col("ingredient_id") == 7, 0).otherwise(F.col("quantity"))
    )
    portions = dict(got(reports.producible_portions(needs, t["MenuItems"], stock), "dish", "count_of_portions"))
    assert portions["Сырный торт"] == 0 and portions["Пятиэтажный бургер"] == 0
    assert portions["Вино"] is None


def test_copurchase_pairs(t):
    df = reports.copurchase_pairs(t["OrderItems"], t["MenuItems"])
    pairs = {frozenset((a, b)): n for a, b, n in got(df, "dish_1", "dish_2", "count_of_joint_orders")}
    often = {("Картофель три", "Пятиэтажный бургер"): 2, ("Картофель три", "Сырный торт"): 2}
    once = [
        ("Кола", "Картофель три"), ("Кола", "Пятиэтажный бургер"), ("Кола", "Сырный торт"),
        ("Пятиэтажный бургер", "Сырный торт"), ("Кофе", "Картофель три"), ("Кофе", "Сырный торт"),
        ("Вино", "Картофель три"), ("Вино", "Пятиэтажный бургер"),
    ]
    assert pairs == {frozenset(k): v for k, v in {**often, **{p: 1 for p in once}}.items()}


def test_weekday_profile(t):
    assert got(
        reports.weekday_profile(t["Orders"]), "week_day", "average_orders", "average_revenue", "average_check"
    ) == [("Воскресенье", 2, D("2005.00"), D("1002.50")), ("Среда", 1, D("450.00"), D("450.00"))]


def test_delivered_materials(t):
    df = reports.delivered_materials(
        t["SupplierOrderItems"], t["SupplierOrders"], t["Ingredients"], t["Units"], t["SupplyStatuses"], *APRIL
    )
    assert got(df, "ingredient", "quantity_of_delivered", "unit", "count_of_supplies", "money_spent") == [
        ("Картофель", 50000, "г", 1, 2500),
        ("Молоко", 40000, "мл", 1, 3200),
        ("Мука", 30000, "г", 1, 1350),
        ("Говядина", 10000, "г", 1, 6000),
        ("Сыр", 8000, "г", 1, 4400),
        ("Булка", 26, "шт", 1, 650),
    ]


@pytest.mark.parametrize(
    "as_of, taken", [("2026-04-20 20:00", 5), ("2026-04-20 21:00", None), ("2026-04-12 21:30", 6)]
)
def test_free_tables(t, as_of, taken):
    df = bookings.free_resources_at(
        t["Tables"], bookings.with_span(t["TableReservations"]), t["DineIns"], t["Orders"],
        t["OrderStatuses"], as_of,
    )
    rows = got(df, "capacity", "number")
    assert rows == sorted(rows)
    assert {number for _, number in rows} == set(range(1, 12)) - {taken}


def _requests(spark):
    return spark.createDataFrame(
        [
            (1, "+79161234567", "dine_in", 1, 3, 7, None, None, "быстро быстро, супер срочно"),
            (2, "+79163456789", "delivery", 2, None, None, "г. Новобобёрск, ул. Баробенко 42, кв 17", 3, None),
            (3, "+70000000000", "dine_in", 1, 4, 7, None, None, None),
            (4, None, "delivery", 1, None, None, "", 3, None),
            (5, None, "dine_in", 1, 4, None, None, None, None),
            (6, None, "takeaway", 1, 4, 7, "x", 3, None),
        ],
        "request_id int, customer_phone string, order_type string, payment_type_id int, table_id int, "
        "employee_id int, address string, courier_id int, comment string",
    )


def test_place_orders(spark, t):
    basket = spark.createDataFrame(
        [(1, 6, 1), (1, 4, 1), (1, 1, 2), (1, 7, 1), (2, 6, 2), (2, 4, 1), (2, 1, 3), (2, 2, 2), (3, 1, 1),
         (3, 99, 1), (4, 1, 1)],
        "request_id int, menu_item_id int, quantity int",
    )
    new = workflows.place_orders(t, _requests(spark), basket, LOADED)
    orders = got(new["new Orders"].orderBy("id"), "id", "customer_id", "status_id", "total_cost", "to_pay")
    assert orders == [
        (6, 1, 1, D("1320.00"), D("1122.00")),
        (7, 3, 1, D("1960.00"), D("1862.00")),
        (8, None, 1, D("150.00"), D("150.00")),
    ]
    lines = got(new["new OrderItems"].orderBy("id"), "id", "order_id", "menu_item_id", "item_cost", "quantity")
    assert [line[0] for line in lines] == list(range(13, 22))
    assert lines[0] == (13, 6, 1, D("150.00"), 2)
    hall = got(new["new DineIns"].orderBy("id"), "id", "order_id", "table_id", "employee_id", "status_id")
    assert hall == [(4, 6, 3, 7, 1), (5, 8, 4, 7, 1)]
    delivery = got(new["new Deliveries"], "id", "order_id", "courier_id", "delivery_status_id")
    assert delivery == [(3, 7, 3, 1)]
    rejected = got(new["rejected requests"].orderBy("request_id"), "request_id", "reason")
    assert rejected == [
        (4, "address or courier missing"), (5, "table or waiter missing"), (6, "unknown order type"),
    ]
    assert got(new["rejected lines"], "order_id", "menu_item_id") == [(8, 99)]

    tables_now = {**t, **{name: t[name].select(df.columns).unionByName(df) for name, df in (
        ("Orders", new["new Orders"].select(t["Orders"].columns)),
        ("DineIns", new["new DineIns"].select(t["DineIns"].columns)),
        ("Deliveries", new["new Deliveries"].select(t["Deliveries"].columns)),
    )}}
    hall_report = receipts.order_report_hall(
        tables_now["Orders"], t["OrderStatuses"], t["PaymentTypes"], tables_now["DineIns"], t["Tables"],
        t["Employees"], t["Customers"],
    )
    assert got(hall_report.filter("order_id = 6"), "status", "payment_type", "table_number", "waiter", "customer") == [
        ("В ожидании", "Наличные", 3, "Плюсовик Горошич", "Наташа Дифференциал")
    ]
    delivery_report = receipts.order_report_delivery(
        tables_now["Orders"], t["OrderStatuses"], t["PaymentTypes"], tables_now["Deliveries"],
        t["DeliveryStatuses"], t["Couriers"], t["CourierCompanies"], t["Customers"],
    )
    assert got(delivery_report.filter("order_id = 7"), "delivery_status", "courier", "courier_company", "to_pay") == [
        ("Собирается", "Олег Бородатый", "Развоз", D("1862.00"))
    ]


def test_half_cents_round_up(spark, t):
    lines = spark.createDataFrame([(1, D("0.50"), 1)], "order_id int, item_cost decimal(10,2), quantity int")
    order = spark.createDataFrame([(1, 1), (2, 1)], "id int, customer_id int")
    tier = t["LoyaltyTiers"].withColumn("discount_percent", F.lit("-5").cast("decimal(5,2)"))
    priced = baskets.price_baskets(order, lines, t["Customers"], tier).orderBy("order_id")
    assert got(priced, "total_cost", "to_pay") == [(D("0.50"), D("0.53")), (D("0.00"), D("0.00"))]


def test_one_order_from_kitchen_to_till(t):
    now = {**t}
    cooked = workflows.cook_orders(now, 4, "2026-04-15 14:35:00")
    assert got(cooked["picked"], "id") == [(5,)]
    items = got(
        cooked["new IngredientOperationItems"].orderBy("id"),
        "id", "operation_id", "ingredient_id", "operation_type_id", "unit_id", "amount",
    )
    assert items == [
        (14, 6, 1, 2, 2, D("150.000")), (15, 6, 8, 2, 5, D("1.000")),
        (16, 6, 9, 2, 2, D("30.000")), (17, 6, 10, 2, 2, D("20.000")),
    ]
    stock = dict(got(cooked["IngredientInventory"], "ingredient_id", "quantity"))
    assert (stock[1], stock[8], stock[9], stock[10], stock[2]) == (14850, 49, 4970, 2980, 25000)

    now["Orders"], now["IngredientInventory"] = cooked["Orders"], cooked["IngredientInventory"]
    lines = receipts.of_orders(t["OrderItems"], cooked["picked"])
    text = receipts.line_materials_text(lines, t["MenuItems"], t["RecipeItems"], t["Ingredients"], t["Units"])
    assert got(text, "dish", "quantity", "price", "total_price", "ingredients_used") == [
        ("Пятиэтажный бургер", 1, 450, 450,
         "Говядина: 150.000 г, Булка: 1.000 шт, Сыр: 30.000 г, Салат: 20.000 г")
    ]
    left = receipts.affected_stock(
        lines, t["RecipeItems"], now["IngredientInventory"], t["Ingredients"], t["Units"]
    )
    assert got(left, "ingredient", "current_stock", "unit") == [
        ("Булка", 49, "шт"), ("Салат", 2980, "г"), ("Сыр", 4970, "г"), ("Говядина", 14850, "г"),
    ]
    head = receipts.kitchen_report(
        now["Orders"].filter("id = 5"), t["OrderStatuses"], t["Deliveries"], t["DineIns"], t["Tables"],
        t["Customers"], "2026-04-15 14:35:00",
    )
    assert got(head, "order_status", "order_type", "customer") == [
        ("Готовится", "Доставка: г. Новобобёрск, ул. Васянская 8, кв 10", None)
    ]

    done = workflows.complete_orders(now, "2026-04-15 14:50:00")
    assert got(done["picked"], "id") == [(5,)]
    now.update({name: done[name] for name in ("Orders", "OrderItems", "Deliveries", "DineIns")})
    assert got(now["Orders"].filter("id = 5"), "status_id") == [(3,)]
    assert got(now["Deliveries"].orderBy("id"), "delivery_status_id") == [(5,), (3,)]
    assert got(now["DineIns"].orderBy("id"), "status_id") == [(2,), (2,), (1,)]
    minutes = receipts.prep_minutes(now["OrderItems"], t["MenuItems"])
    assert got(minutes.filter("order_id = 5"), "cooking_minutes") == [(20,)]
    fulfilled = receipts.fulfilment_report(
        now["Orders"], now["OrderItems"], t["OrderStatuses"], t["PaymentTypes"], now["Deliveries"],
        now["DineIns"], t["Tables"], t["Customers"], "2026-04-15 15:00:29",
    )
    assert got(fulfilled.filter("order_id = 5"), "order_status", "total_minutes", "order_type", "destination") == [
        ("Готов", 30, "Доставка", "г. Новобобёрск, ул. Васянская 8, кв 10")
    ]
    assert got(fulfilled.filter("order_id = 1"), "order_type", "destination", "customer") == [
        ("В зале", "Стол 3 (Зал)", "Наташа Дифференциал")
    ]

    closed = workflows.close_orders(now, "2026-04-15 15:30:00")
    sale = got(
        closed["new FinancialTransactions"],
        "id", "transaction_type_id", "amount", "description", "category_id",
    )
    assert sale == [(8, 1, 450, "Оплата заказа 5", 1)]
    order = got(closed["Orders"].filter("id = 5"), "status_id", "financial_transaction_id")
    assert order == [(5, 8)]
    assert got(closed["Deliveries"].filter("order_id = 5"), "delivery_status_id") == [(5,)]
    assert got(closed["new LoyaltyTransactions"]) == []
    assert sorted(got(closed["Customers"])) == sorted(got(t["Customers"]))
    paid = receipts.payment_report(
        closed["Orders"].filter("id = 5"), t["OrderStatuses"], t["PaymentTypes"],
        closed["new FinancialTransactions"], t["FinancialTransactionTypes"],
        t["FinancialTransactionsCategories"],
    )
    assert got(paid, "order_status", "total_minutes", "financial_amount", "financial_category") == [
        ("Завершён", 60, 450, "Продажи")
    ]


def test_closing_all_ready_orders_raises_tiers_and_credits_points(t):
    # both orders of customer 1 and the one of customer 3 are ready; the first is Каша's
    ready = id_of(t["OrderStatuses"], "Готов")
    orders = t["Orders"].filter("customer_id in (1, 3)").withColumn("status_id", ready)
    customers = t["Customers"].withColumn(
        "total_spent",
        F.when(F.col("id") == 1, F.lit("4000")).otherwise(F.col("total_spent")).cast("decimal(10,2)"),
    )
    closed = workflows.close_orders({**t, "Orders": orders, "Customers": customers}, LOADED, n=None)
    after = got(closed["Customers"].orderBy("id"), "id", "total_spent", "total_orders", "last_achieved_tier_id")
    assert after == [(1, 5570, 14, 3), (2, 8700, 8, 3), (3, 4750, 6, 2)]
    credited = got(
        closed["new LoyaltyTransactions"].orderBy("id"), "id", "customer_id", "order_id", "points_amount", "description"
    )
    assert credited == [
        (5, 1, 1, D("125.00"), "10.00% кешбэк с заказа на 1250.00 рублей (уровень Типок)"),
        (6, 3, 3, D("77.50"), "5.00% кешбэк с заказа на 1550.00 рублей (уровень Челик)"),
        (7, 1, 4, D("32.00"), "10.00% кешбэк с заказа на 320.00 рублей (уровень Типок)"),
    ]


def test_pick_orders(t):
    def ids(**how):
        return got(lifecycle.pick_orders(t["Orders"], t["OrderStatuses"], "Отменён", **how), "id")

    assert ids(n=1) == [(1,)] and ids(n=1, newest=True) == [(2,)] and sorted(ids()) == [(1,), (2,)]


def test_a_unit_that_differs_leaves_the_stock_alone(t):
    used = t["RecipeItems"].select(
        F.lit(1).alias("order_id"), "ingredient_id", F.lit(1).alias("unit_id"), F.col("quantity").alias("amount")
    )
    after = lifecycle.stock_after_consumption(t["IngredientInventory"], used)
    assert got(after.orderBy("id"), "quantity") == got(t["IngredientInventory"].orderBy("id"), "quantity")


def test_loyalty_carrier_and_waiter_reports(t):
    loyal = receipts.loyalty_report(
        t["Orders"], t["Customers"], t["LoyaltyTiers"], t["LoyaltyTransactions"], t["LoyaltyTransactionTypes"]
    )
    assert got(loyal.orderBy("order_id"), "order_id", "customer", "current_loyalty_tier", "earned_cashback") == [
        (1, "Наташа Дифференциал", "Типсон", D("62.50")),
        (2, "Маша Интеграл", "Типок", D("44.50")),
        (3, "Каша Производная", "Челик", D("232.50")),
    ]
    carriers = receipts.carrier_report(
        t["Deliveries"], t["Couriers"], t["CourierCompanies"], t["DeliveryStatuses"]
    )
    assert got(carriers.orderBy("order_id"), "courier", "courier_company", "delivery_status") == [
        ("Олег Усатый", "Страусиные курьеры", "Доставлен"),
        ("Олег Горбатый", "Быстро и некачественно", "Собирается"),
    ]
    brief = receipts.delivery_report(t["Deliveries"], t["Couriers"], t["DeliveryStatuses"])
    assert got(brief.orderBy("order_id"), "delivery_status", "courier") == [
        ("Доставлен", "Олег Усатый"), ("Собирается", "Олег Горбатый"),
    ]
    waiters = receipts.waiter_report(t["DineIns"], t["Employees"], t["Tables"], t["DineInStatuses"])
    assert got(waiters.orderBy("order_id"), "waiter", "table_number", "table_location", "dine_in_status") == [
        ("Плюсовик Горошич", 3, "Зал", "Подано"),
        ("Коробок Спичечный", 1, "Зал", "Подано"),
        ("Коробок Спичечный", 6, "Барная стойка", "Ожидание"),
    ]
    lines = receipts.order_lines(t["OrderItems"].filter("order_id = 3"), t["MenuItems"])
    of_table = t["OrderItems"].filter("order_id = 3").select("id", "created_at")
    assert sorted(got(lines, "line_id", "created_at")) == sorted(got(of_table))
    assert got(lines.orderBy("item"), "item", "quantity", "price_per_item", "total_price") == [
        ("Вино", 1, 350, 350), ("Картофель три", 1, 250, 250), ("Пятиэтажный бургер", 2, 450, 900),
    ]


def test_book_tables(spark, t):
    requests = spark.createDataFrame(
        [
            (1, 5, "+79161234567", "2026-04-20", "19:00:00", 120, 6),
            (2, 5, "+79161234567", "2026-04-21", "19:00:00", 120, 6),
            (3, 5, "+79161234567", "2026-04-20", "21:00:00", 180, 6),
            (4, 5, "+79161234567", "2026-04-26", "19:00:00", 120, 2),
            (5, 5, "+79162345678", "2026-04-26", "20:59:00", 10, 2),
            (6, 5, "+79162345678", "2026-04-20", "23:30:00", 60, 2),
            (7, 5, "+79162345678", "2026-04-21", "00:15:00", 60, 2),
            (8, 99, "+79162345678", "2026-04-21", "00:15:00", 60, 2),
        ],
        "request_id int, table_id int, customer_phone string, reservation_date string, reservation_time string, "
        "duration_minutes int, created_by_employee_id int",
    ).withColumn("reservation_date", F.col("reservation_date").cast("date"))
    booked = workflows.book_tables(t, requests)
    decided = got(booked["decided"].orderBy("request_id"), "request_id", "accepted")
    assert [r for r, accepted in decided if accepted] == [2, 3, 4, 7]
    new = booked["new TableReservations"]
    assert [i for (i,) in got(new.orderBy("id"), "id")] == [4, 5, 6, 7]
    told = bookings.reservation_confirmations(bookings.with_span(new), t["Tables"], t["Employees"])
    first = got(
        told.orderBy("reservation_id"),
        "table_number", "table_capacity", "reservation_time_start", "reservation_time_end", "created_by",
    )[0]
    assert first == (5, 10, "19:00:00", "21:00:00", "Коробок Спичечный")


BEST = {
    1: (2, [
        ("Таратайка -> Буханково -> Карапулька -> Агаповка", 125, "Карапулька", "Буханково", "Карапулька"),
        ("Таратайка -> Буханково -> Карапулька -> Агаповка", 125, "Карапулька", "Буханково", "Таратайка"),
    ]),
    2: (17, [
        ("Таратайка -> Барбариск -> Елыпаловск -> Сосновск -> Агаповка", 264, "Сосновск", "Елыпаловск", "Барбариск"),
        ("Таратайка -> Бобровск -> Елыпаловск -> Сосновск -> Агаповка", 264, "Сосновск", "Бобровск", "Елыпаловск"),
    ]),
    3: (97, [
        ("Таратайка -> Рубинск -> Бананск -> Пластырево -> Перекрестково -> Агаповка", 174,
         "Рубинск", "Бананск", "Пластырево"),
        ("Таратайка -> Рубинск -> Бананск -> Пластырево -> Хардкорново -> Агаповка", 174,
         "Рубинск", "Бананск", "Пластырево"),
    ]),
}


@pytest.mark.parametrize("example", [1, 2, 3])
def test_best_routes(spark, example):
    cities, roads, end = network(spark, example)
    count, best = BEST[example]
    assert got(routes.best_routes(cities, roads, 1, end)) == best
    assert routes.enumerate_routes(cities, roads, 1, end).count() == count


def test_defaults_stand_in_for_absent_columns_only(spark):
    rows = spark.createDataFrame([(1, 1, 1, None)], "id int, status_id int, payment_type_id int, to_pay string")
    order = typed(rows, RESTAURANT["Orders"], LOADED).first()
    assert order.total_cost == 0 and order.to_pay is None and order.closed_at is None
    assert str(order.created_at) == LOADED
    with pytest.raises(ValueError):
        typed(rows, RESTAURANT["Orders"])


def test_audit_finds_injected_faults(spark, t):
    names = ["OrderStatuses", "PaymentTypes", "LoyaltyTiers", "Customers", "FinancialTransactions",
             "FinancialTransactionTypes", "FinancialTransactionsCategories", "Orders"]
    declared = [RESTAURANT[name] for name in names]
    clean = audit.constraint_audit(t, declared)
    assert clean.filter("violations > 0").count() == 0
    orders = t["Orders"]
    broken = {
        **t,
        "Orders": orders.unionByName(orders.filter("id = 1").withColumn("customer_id", F.lit(77)))
        .withColumn("status_id", F.when(F.col("id") == 2, None).otherwise(F.col("status_id"))),
        "Customers": t["Customers"].withColumn("phone", F.lit("the same")),
    }
    faults = audit.constraint_audit(broken, declared).filter("violations > 0")
    assert sorted(got(faults)) == [
        ("Customers", "unique", "phone", 2),
        ("Orders", "foreign", "customer_id", 1),
        ("Orders", "not_null", "status_id", 1),
        ("Orders", "unique", "id", 1),
    ]


def test_audit_reads_references_of_a_table_together(spark):
    parents = spark.createDataFrame([(1,), (2,)], "id int")
    children = spark.createDataFrame([(1, 1, 9), (2, 9, 9), (3, None, 2)], "id int, a int, b bigint")
    tables = [
        Table("P", "id int!"),
        Table("C", "id int!; a int; b bigint", foreign={"a": Reference("P"), "b": Reference("P")}),
    ]
    found = audit.constraint_audit({"P": parents, "C": children}, tables).filter("rule = 'foreign'")
    assert sorted(got(found)) == [("C", "foreign", "a", 1), ("C", "foreign", "b", 2)]


def test_audit_finds_a_second_delivery_of_an_order(spark, t):
    declared = [RESTAURANT["Deliveries"], RESTAURANT["DineIns"]]
    rule = "rule = 'one_to_one'"
    clean = audit.constraint_audit(t, declared).filter(rule)
    assert sorted(got(clean)) == [("Deliveries", "one_to_one", "order_id", 0), ("DineIns", "one_to_one", "order_id", 0)]
    again = t["Deliveries"].limit(1).withColumn("id", F.lit(991))
    broken = {**t, "Deliveries": t["Deliveries"].unionByName(again).unionByName(again.withColumn("id", F.lit(992)))}
    faults = audit.constraint_audit(broken, declared).filter("violations > 0")
    assert got(faults) == [("Deliveries", "one_to_one", "order_id", 2)]


def test_audit_of_empty_tables_nulls_and_parents_that_are_not_audited(spark):
    parents = spark.createDataFrame([(1, "x"), (2, "x"), (2, None)], "id int, name string")
    children = spark.createDataFrame(
        [(1, 1, 0.0), (2, 3, -0.0), (2, None, None), (None, 3, float("nan"))], "id bigint, parent bigint, weight double"
    )
    child = Table("C", "id bigint!; parent bigint; weight double", (("weight",),), {"parent": Reference("P")})
    found = audit.constraint_audit({"P": parents, "C": children}, [child])
    assert sorted(got(found)) == [
        ("C", "foreign", "parent", 2),
        ("C", "not_null", "id", 1),
        ("C", "unique", "id", 1),
        ("C", "unique", "weight", 1),
    ]
    empty = audit.constraint_audit({"P": parents, "C": children.limit(0)}, [child])
    assert [n for *_, n in got(empty)] == [0, 0, 0, 0]


def test_advance_status_can_give_only_the_changed_rows(spark, t):
    picked = t["Orders"].filter("id = 2").select("id")
    new = {"status_id": F.lit(3)}
    changed = lifecycle.advance_status(t["Orders"], picked, new, only_changed=True)
    whole = lifecycle.advance_status(t["Orders"], picked, new)
    assert changed.columns == t["Orders"].columns
    assert changed.collect() == whole.filter("id = 2").collect() and whole.count() == t["Orders"].count()
