"""The restaurant's rows the golden results are about.

Fixed values: these rows have to be exactly these for the expected results to hold. Columns no
operator reads are left to their defaults or to a placeholder.
"""

from __future__ import annotations

from venueops.sources.schema import NETWORK, RESTAURANT
from venueops.sources.tables import literal_rows

LOADED = "2026-04-16 12:00:00"

NAMES = {
    "OrderStatuses": ["В ожидании", "Готовится", "Готов", "Подан", "Завершён", "Отменён"],
    "DineInStatuses": ["Ожидание", "Подано"],
    "SupplyStatuses": ["Заказано", "В пути", "Доставлено", "Отменено"],
    "DeliveryStatuses": ["Собирается", "Назначен курьер", "Забран", "В пути", "Доставлен", "Отменён"],
    "PaymentTypes": ["Наличные", "Банковская карта", "QR код"],
    "LoyaltyTransactionTypes": ["Начисление", "Списание", "Сгорание"],
    "Units": ["кг", "г", "л", "мл", "шт", "уп", "бутылка", "стакан"],
    "IngredientOperationTypes": ["Закупка", "Использование", "Возврат"],
    "FinancialTransactionTypes": ["Доход", "Расход"],
    "FinancialTransactionsCategories": [
        "Продажи", "Заработная плата", "Закупка ингредиентов", "Аренда",
        "Маркетинг", "Обслуживание", "Налоги", "Прочее",
    ],
    "CourierCompanies": ["Быстро и некачественно", "Страусиные курьеры", "Развоз"],
    "Ingredients": [
        "Говядина", "Картофель", "Молоко", "Мука", "Кола", "Кофе в зернах", "Вино", "Булка", "Сыр", "Салат",
    ],
}

ROWS = {
    "LoyaltyTiers": (
        "name min_spent discount_percent cashback_percent",
        [
            ("Микрочелик", "0", "0", "5"),
            ("Челик", "2500", "5", "5"),
            ("Типок", "5000", "10", "10"),
            ("Типсон", "10000", "15", "15"),
        ],
    ),
    "FinancialTransactions": (
        "transaction_type_id amount transaction_date category_id",
        [
            (2, "50000", "2026-04-01 10:00:00", 4),
            (2, "15000", "2026-04-03 14:30:00", 3),
            (1, "1250", "2026-04-05 20:00:00", 1),
            (1, "890", "2026-04-05 20:45:00", 1),
            (2, "8000", "2026-04-10 11:00:00", 5),
            (1, "1550", "2026-04-12 21:30:00", 1),
            (1, "320", "2026-04-12 21:30:00", 1),
        ],
    ),
    "Employees": (
        "first_name last_name role_id hire_date",
        [
            ("Алексей", "Бизнесменович", 1, "2026-03-01"),
            ("Максим", "Рыбинский", 2, "2026-03-01"),
            ("Дроп", "Датабейсович", 3, "2026-03-01"),
            ("Алиса", "Кий", 4, "2026-03-01"),
            ("Бобёр", "Платинов", 4, "2026-03-01"),
            ("Коробок", "Спичечный", 5, "2026-03-01"),
            ("Плюсовик", "Горошич", 5, "2026-03-01"),
            ("Ватрун", "Максимов", 6, "2026-03-01"),
        ],
    ),
    "Couriers": (
        "first_name last_name phone company_id",
        [
            ("Олег", "Горбатый", "+7(916)111-22-33", 1),
            ("Олег", "Усатый", "+7(916)222-33-44", 2),
            ("Олег", "Бородатый", "+7(916)333-44-55", 3),
        ],
    ),
    "Tables": (
        "number capacity location",
        [
            (1, 4, "Зал"), (2, 4, "Зал"), (3, 6, "Зал"), (4, 6, "Зал"), (5, 10, "VIP зона"),
            (6, 2, "Барная стойка"), (7, 2, "Барная стойка"), (8, 4, "Терраса"), (9, 4, "Терраса"),
            (10, 6, "Подвал"), (11, 6, "Подвал"),
        ],
    ),
    "Customers": (
        "phone first_name last_name total_spent total_orders last_achieved_tier_id",
        [
            ("+79161234567", "Наташа", "Дифференциал", "12500", 12, 4),
            ("+79162345678", "Маша", "Интеграл", "8700", 8, 3),
            ("+79163456789", "Каша", "Производная", "3200", 5, 2),
        ],
    ),
    "IngredientInventory": (
        "ingredient_id unit_id quantity",
        [
            (1, 2, "15000"), (2, 2, "25000"), (3, 4, "10000"), (4, 2, "8000"), (5, 4, "20000"),
            (6, 2, "2500"), (7, 4, "22500"), (8, 5, "50"), (9, 2, "5000"), (10, 2, "3000"),
        ],
    ),
    "MenuItems": (
        "category_id name price",
        [
            (1, "Кола", "150"), (2, "Кофе", "180"), (3, "Вино", "350"), (4, "Картофель три", "250"),
            (5, "Крутой суп", "280"), (6, "Пятиэтажный бургер", "450"), (7, "Сырный торт", "320"),
        ],
    ),
    "RecipeItems": (
        "menu_item_id ingredient_id unit_id quantity",
        [
            (6, 1, 2, "150"), (6, 8, 5, "1"), (6, 9, 2, "30"), (6, 10, 2, "20"), (4, 2, 2, "200"),
            (2, 6, 2, "10"), (2, 3, 4, "150"), (1, 5, 4, "250"), (3, 7, 4, "500"), (5, 2, 2, "100"),
            (5, 4, 2, "30"), (7, 4, 2, "50"), (7, 9, 2, "80"), (7, 3, 4, "100"),
        ],
    ),
    "SupplierOrders": (
        "supplier_id employee_id delivery_date status_id",
        [
            (1, 2, "2026-04-03 14:00:00", 3),
            (2, 2, "2026-04-09 12:00:00", 3),
            (3, 2, "2026-04-16 16:00:00", 2),
        ],
    ),
    "SupplierOrderItems": (
        "supplier_order_id ingredient_id unit_id quantity price_per_unit total_cost",
        [
            (1, 1, 2, "10000", "0.60", "6000"),
            (1, 2, 2, "50000", "0.05", "2500"),
            (1, 9, 2, "8000", "0.55", "4400"),
            (2, 3, 4, "40000", "0.08", "3200"),
            (2, 4, 2, "30000", "0.045", "1350"),
            (2, 8, 5, "26", "25.00", "650"),
            (3, 5, 4, "50000", "0.12", "6000"),
            (3, 7, 4, "10000", "0.27", "2700"),
            (3, 6, 2, "600", "1.50", "900"),
        ],
    ),
    "Orders": (
        "customer_id status_id payment_type_id total_cost to_pay comment created_at closed_at "
        "financial_transaction_id",
        [
            (1, 6, 2, "1250", "1250", "Помедленнее", "2026-04-05 18:30:00", "2026-04-05 20:00:00", 3),
            (2, 6, 1, "890", "890", None, "2026-04-05 19:15:00", "2026-04-05 20:45:00", 4),
            (3, 5, 2, "1550", "1550", "Побыстрее", "2026-04-12 20:00:00", "2026-04-12 21:30:00", 6),
            (1, 4, 3, "320", "320", None, "2026-04-12 21:00:00", "2026-04-12 23:00:00", 7),
            (None, 1, 2, "450", "450", None, "2026-04-15 14:30:00", None, None),
        ],
    ),
    "OrderItems": (
        "order_id menu_item_id item_cost quantity created_at cooked_at",
        [
            (1, 6, "450", 1, "2026-04-05 18:30:00", "2026-04-05 19:00:00"),
            (1, 4, "250", 1, "2026-04-05 18:30:00", "2026-04-05 19:10:00"),
            (1, 1, "150", 2, "2026-04-05 18:30:00", "2026-04-05 18:45:00"),
            (1, 7, "320", 1, "2026-04-05 19:30:00", "2026-04-05 19:50:00"),
            (2, 4, "250", 1, "2026-04-05 19:15:00", "2026-04-05 19:45:00"),
            (2, 2, "180", 2, "2026-04-05 19:15:00", "2026-04-05 19:30:00"),
            (2, 7, "320", 1, "2026-04-05 20:00:00", "2026-04-05 20:20:00"),
            (3, 6, "450", 2, "2026-04-12 20:00:00", "2026-04-12 20:30:00"),
            (3, 4, "250", 1, "2026-04-12 20:00:00", "2026-04-12 20:25:00"),
            (3, 3, "350", 1, "2026-04-12 20:00:00", "2026-04-12 20:15:00"),
            (4, 7, "320", 1, "2026-04-12 21:00:00", "2026-04-12 21:20:00"),
            (5, 6, "450", 1, "2026-04-15 14:30:00", None),
        ],
    ),
    "Deliveries": (
        "order_id address courier_id delivery_status_id",
        [
            (3, "г. Новобобёрск, ул. Рыбинская 15, кв 42", 2, 5),
            (5, "г. Новобобёрск, ул. Васянская 8, кв 10", 1, 1),
        ],
    ),
    "DineIns": ("order_id table_id employee_id status_id", [(1, 3, 7, 2), (2, 1, 6, 2), (4, 6, 6, 1)]),
    "TableReservations": (
        "table_id customer_phone reservation_date reservation_time duration_minutes created_by_employee_id",
        [
            (5, "+79161234567", "2026-04-20", "19:00:00", 120, 6),
            (10, "+79162345678", "2026-04-25", "18:30:00", 90, 7),
            (3, "+79163456789", "2026-04-18", "14:00:00", 120, 6),
        ],
    ),
    "IngredientOperations": (
        "employee_id created_at",
        [
            (4, "2026-04-03 15:00:00"), (4, "2026-04-09 10:30:00"), (5, "2026-04-05 22:00:00"),
            (5, "2026-04-12 23:00:00"), (4, "2026-04-16 11:00:00"),
        ],
    ),
    "IngredientOperationItems": (
        "operation_id ingredient_id operation_type_id unit_id amount",
        [
            (1, 1, 1, 2, "10000"), (1, 2, 1, 2, "50000"), (1, 9, 1, 2, "8000"), (2, 3, 1, 4, "40000"),
            (2, 4, 1, 2, "30000"), (2, 8, 1, 5, "26"), (3, 1, 2, 2, "1500"), (3, 2, 2, 2, "3200"),
            (3, 8, 2, 5, "4"), (4, 1, 2, 2, "3000"), (4, 9, 2, 2, "1200"), (5, 5, 1, 4, "50000"),
            (5, 7, 1, 4, "10000"),
        ],
    ),
    "LoyaltyTransactions": (
        "customer_id order_id points_amount transaction_type_id description",
        [
            (1, 1, "62.50", 1, "5% кешбэк с заказа 1250 рублей"),
            (2, 2, "44.50", 1, "5% кешбэк с заказа 890 рублей"),
            (1, 3, "232.50", 1, "15% кешбэк с заказа 1550 рублей"),
            (1, None, "100", 2, "Списание за бонусную позицию"),
        ],
    ),
}

# The three road networks, cities as (name, rubies, emeralds, sapphires).
NETWORKS = {
    1: (
        [
            ("Таратайка", 15, 25, 43), ("Угаралитевск", 10, 5, 30), ("Буханково", 10, 50, 20),
            ("Карапулька", 35, 15, 45), ("Агаповка", 20, 30, 25),
        ],
        [
            (1, 2), (1, 3), (2, 4), (3, 4), (4, 5),
        ],
    ),
    2: (
        [
            ("Таратайка", 5, 5, 5), ("Карманск", 100, 5, 5), ("Бобровск", 5, 100, 5), ("Барбариск", 5, 5, 100),
            ("Турбонадувск", 80, 80, 5), ("Тессерактово", 80, 5, 80), ("Елыпаловск", 5, 80, 80),
            ("Датабейсово", 70, 70, 70), ("Сосновск", 90, 40, 40), ("Агаповка", 10, 10, 10),
        ],
        [
            (1, 2), (1, 3), (1, 4), (1, 5), (1, 6), (1, 7), (2, 9), (2, 5), (3, 5), (3, 7),
            (4, 6), (4, 7), (5, 8), (5, 9), (6, 8), (6, 9), (7, 8), (7, 9), (8, 10), (9, 10),
        ],
    ),
    3: (
        [
            ("Таратайка", 10, 10, 10), ("Рубинск", 80, 10, 10), ("Изумрудск", 10, 75, 10),
            ("Сапфирск", 10, 10, 70), ("Крополевск", 40, 40, 40), ("Бананск", 30, 50, 20),
            ("Ярмолаевск", 55, 15, 30), ("Коробаск", 25, 25, 50), ("Рандомноград", 45, 20, 35),
            ("Жеребецк", 15, 45, 40), ("Пластырево", 35, 15, 50), ("Перекрестково", 35, 35, 30),
            ("Крутовск", 25, 35, 40), ("Хардкорново", 40, 25, 35), ("Агаповка", 20, 20, 20),
        ],
        [
            (1, 2), (1, 3), (1, 4), (1, 5), (2, 6), (2, 7), (2, 5), (3, 6), (3, 5), (3, 8),
            (4, 7), (4, 8), (5, 6), (5, 7), (5, 8), (6, 9), (6, 10), (6, 11), (7, 9), (7, 11),
            (8, 10), (8, 11), (9, 12), (9, 13), (10, 13), (10, 14), (11, 12), (11, 14), (12, 15), (13, 15),
            (14, 15), (5, 9), (5, 10), (6, 12), (7, 14), (8, 13),
        ],
    ),
}


def tables(spark):
    found = {
        name: literal_rows(spark, RESTAURANT[name], [(value,) for value in names], "name", LOADED)
        for name, names in NAMES.items()
    }
    for name, (columns, rows) in ROWS.items():
        found[name] = literal_rows(spark, RESTAURANT[name], rows, columns, LOADED)
    return found


def network(spark, example):
    cities, roads = NETWORKS[example]
    return (
        literal_rows(spark, NETWORK["Cities"], cities, "name rubies emeralds sapphires"),
        literal_rows(spark, NETWORK["Roads"], roads, "from_city_id to_city_id"),
        len(cities),
    )
