"""Reports about orders: one row per order, line, delivery or table service given.

The frames decide what is reported: restrict ``orders``, ``lines``, ``deliveries`` or ``dine_ins``
to the orders of a step with :func:`of_orders`. Nothing is sorted here; a report over many orders
is sorted by who reads it.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from venueops.functions.columns import Moment, full_name, keyed, minutes_between, moment

# Texts of the reports and the accrual type's name.
DELIVERY = "Доставка"
HALL = "В зале"
TABLE = "Стол "
DELIVERY_TO = "Доставка: "
HALL_TABLE = "В зале: стол "
ACCRUAL = "Начисление"


def of_orders(rows: DataFrame, picked: DataFrame, key: str = "order_id") -> DataFrame:
    """The rows belonging to the picked orders."""
    return rows.join(picked.select(F.col("id").alias(key)), key, "left_semi")


def _heads(orders: DataFrame, statuses: DataFrame) -> DataFrame:
    return orders.withColumnRenamed("id", "order_id").join(
        keyed(statuses, "status_id", order_status="name"), "status_id"
    )


def _payments(payment_types: DataFrame) -> DataFrame:
    return keyed(payment_types, "payment_type_id", payment_type="name")


def _guests(customers: DataFrame) -> DataFrame:
    return keyed(customers, "customer_id", customer=full_name(), customer_phone="phone")


def order_report_hall(
    orders: DataFrame,
    statuses: DataFrame,
    payment_types: DataFrame,
    dine_ins: DataFrame,
    tables: DataFrame,
    employees: DataFrame,
    customers: DataFrame,
) -> DataFrame:
    """Header of hall orders: status, payment, table, waiter, customer if known."""
    return (
        _heads(orders, statuses)
        .join(_payments(payment_types), "payment_type_id")
        .join(dine_ins.select("order_id", "table_id", "employee_id"), "order_id")
        .join(keyed(tables, "table_id", table_number="number"), "table_id")
        .join(keyed(employees, "employee_id", waiter=full_name()), "employee_id")
        .join(_guests(customers), "customer_id", "left")
        .select(
            "order_id",
            "created_at",
            F.col("order_status").alias("status"),
            "payment_type",
            "table_number",
            "waiter",
            "comment",
            "total_cost",
            "to_pay",
            "customer",
            "customer_phone",
        )
    )


def order_report_delivery(
    orders: DataFrame,
    statuses: DataFrame,
    payment_types: DataFrame,
    deliveries: DataFrame,
    delivery_statuses: DataFrame,
    couriers: DataFrame,
    companies: DataFrame,
    customers: DataFrame,
) -> DataFrame:
    """Header of delivery orders: status, payment, address, courier and, if any, the company."""
    riders = keyed(couriers, "courier_id", courier=full_name(), company_id="company_id")
    return (
        _heads(orders, statuses)
        .join(_payments(payment_types), "payment_type_id")
        .join(deliveries.select("order_id", "address", "courier_id", "delivery_status_id"), "order_id")
        .join(keyed(delivery_statuses, "delivery_status_id", delivery_status="name"), "delivery_status_id")
        .join(riders, "courier_id")
        .join(keyed(companies, "company_id", courier_company="name"), "company_id", "left")
        .join(_guests(customers), "customer_id", "left")
        .select(
            "order_id",
            "created_at",
            F.col("order_status").alias("status"),
            "payment_type",
            F.col("address").alias("delivery_address"),
            "delivery_status",
            "courier",
            "courier_company",
            "comment",
            "total_cost",
            "to_pay",
            "customer",
            "customer_phone",
        )
    )


def order_lines(lines: DataFrame, items: DataFrame) -> DataFrame:
    """Item, quantity, unit price and price of each line, with its id and the time it was ordered."""
    return lines.join(keyed(items, "menu_item_id", item="name"), "menu_item_id").select(
        F.col("id").alias("line_id"),
        "order_id",
        "menu_item_id",
        "item",
        "quantity",
        F.col("item_cost").alias("price_per_item"),
        (F.col("quantity") * F.col("item_cost")).cast("decimal(18,2)").alias("total_price"),
        "created_at",
    )


def kitchen_report(
    orders: DataFrame,
    statuses: DataFrame,
    deliveries: DataFrame,
    dine_ins: DataFrame,
    tables: DataFrame,
    customers: DataFrame,
    as_of: Moment,
) -> DataFrame:
    """Header of orders in the kitchen: where they go, for whom, since when they are cooked."""
    goes_to = F.when(
        F.col("delivery_id").isNotNull(), F.concat(F.lit(DELIVERY_TO), F.col("address"))
    ).when(
        F.col("dine_in_id").isNotNull(),
        F.concat(F.lit(HALL_TABLE), F.col("table_number").cast("string")),
    )
    return _with_service(_heads(orders, statuses), deliveries, dine_ins, tables, customers).select(
        "order_id",
        "order_status",
        F.col("created_at").alias("order_created"),
        moment(as_of).alias("cooking_started"),
        goes_to.alias("order_type"),
        "customer",
        "customer_phone",
    )


def _with_service(
    heads: DataFrame, deliveries: DataFrame, dine_ins: DataFrame, tables: DataFrame, customers: DataFrame
) -> DataFrame:
    seats = keyed(tables, "table_id", table_number="number", table_location="location")
    return (
        heads.join(deliveries.select("order_id", F.col("id").alias("delivery_id"), "address"), "order_id", "left")
        .join(dine_ins.select("order_id", F.col("id").alias("dine_in_id"), "table_id"), "order_id", "left")
        .join(seats, "table_id", "left")
        .join(_guests(customers), "customer_id", "left")
    )


def line_materials_text(
    lines: DataFrame, items: DataFrame, recipes: DataFrame, ingredients: DataFrame, units: DataFrame
) -> DataFrame:
    """Each line, with its id and the list of materials it takes, in the order of the recipe's rows.

    A dish's recipe is gathered once, as an array (it has a row per ingredient at most); the lines
    then only look it up and multiply. A line without a recipe stays, with NULL.
    """
    needs = (
        recipes.withColumnRenamed("quantity", "need")
        .join(keyed(ingredients, "ingredient_id", ingredient="name"), "ingredient_id", "left")
        .join(keyed(units, "unit_id", unit="name"), "unit_id", "left")
        .groupBy("menu_item_id")
        .agg(F.sort_array(F.collect_list(F.struct("id", "ingredient", "need", "unit"))).alias("recipe"))
    )

    def part(row):
        amount = (row["need"] * F.col("quantity")).cast("decimal(38,3)").cast("string")
        return F.concat(row["ingredient"], F.lit(": "), amount, F.lit(" "), row["unit"])

    parts = F.array_compact(F.transform("recipe", part))
    return (
        lines.join(needs, "menu_item_id", "left")
        .join(keyed(items, "menu_item_id", dish="name"), "menu_item_id")
        .select(
            F.col("id").alias("line_id"),
            "order_id",
            "menu_item_id",
            "dish",
            "quantity",
            F.col("item_cost").alias("price"),
            (F.col("quantity") * F.col("item_cost")).cast("decimal(18,2)").alias("total_price"),
            F.when(F.size(parts) > 0, F.array_join(parts, ", ")).alias("ingredients_used"),
        )
    )


def affected_stock(
    lines: DataFrame, recipes: DataFrame, stock: DataFrame, ingredients: DataFrame, units: DataFrame
) -> DataFrame:
    """Stock rows of every ingredient the lines need, lowest stock first."""
    dishes = lines.select("menu_item_id").distinct()
    used = recipes.join(dishes, "menu_item_id", "left_semi").select("ingredient_id").distinct()
    return (
        stock.join(used, "ingredient_id", "left_semi")
        .join(keyed(ingredients, "ingredient_id", ingredient="name"), "ingredient_id")
        .join(keyed(units, "unit_id", unit="name"), "unit_id")
        .select("ingredient_id", "ingredient", F.col("quantity").alias("current_stock"), "unit")
        .orderBy("current_stock", "ingredient_id")
    )


def fulfilment_report(
    orders: DataFrame,
    lines: DataFrame,
    statuses: DataFrame,
    payment_types: DataFrame,
    deliveries: DataFrame,
    dine_ins: DataFrame,
    tables: DataFrame,
    customers: DataFrame,
    as_of: Moment,
) -> DataFrame:
    """How orders were fulfilled: finish of cooking, minutes since the order, destination, payment.

    Delivery goes before hall; an order with neither has no type and no destination.
    """
    finished = lines.groupBy("order_id").agg(F.max("cooked_at").alias("cooking_finished"))
    delivered, served = F.col("delivery_id").isNotNull(), F.col("dine_in_id").isNotNull()
    seat = F.concat(
        F.lit(TABLE), F.col("table_number").cast("string"), F.lit(" ("), F.col("table_location"), F.lit(")")
    )
    heads = _heads(orders, statuses).join(_payments(payment_types), "payment_type_id")
    return (
        _with_service(heads, deliveries, dine_ins, tables, customers)
        .join(finished, "order_id", "left")
        .select(
            "order_id",
            "order_status",
            F.col("created_at").alias("order_created"),
            "cooking_finished",
            minutes_between(F.col("created_at"), moment(as_of)).alias("total_minutes"),
            F.when(delivered, DELIVERY).when(served, HALL).alias("order_type"),
            F.when(delivered, F.col("address")).when(served, seat).alias("destination"),
            "customer",
            "customer_phone",
            "total_cost",
            "to_pay",
            "payment_type",
        )
    )


def prep_minutes(lines: DataFrame, items: DataFrame) -> DataFrame:
    """Minutes from order to plate per line, with the line's id; NULL while the line is not cooked."""
    return lines.join(keyed(items, "menu_item_id", dish="name"), "menu_item_id").select(
        F.col("id").alias("line_id"),
        "order_id",
        "menu_item_id",
        "dish",
        "quantity",
        F.col("item_cost").alias("price"),
        (F.col("quantity") * F.col("item_cost")).cast("decimal(18,2)").alias("total_price"),
        F.col("created_at").alias("ordered_at"),
        "cooked_at",
        minutes_between(F.col("created_at"), F.col("cooked_at")).alias("cooking_minutes"),
    )


def carrier_report(
    deliveries: DataFrame, couriers: DataFrame, companies: DataFrame, delivery_statuses: DataFrame
) -> DataFrame:
    """Courier, company, address and status of deliveries; couriers without a company are left out."""
    riders = keyed(
        couriers, "courier_id", courier=full_name(), courier_phone="phone", company_id="company_id"
    )
    return (
        deliveries.join(riders, "courier_id")
        .join(keyed(companies, "company_id", courier_company="name"), "company_id")
        .join(keyed(delivery_statuses, "delivery_status_id", delivery_status="name"), "delivery_status_id")
        .select(
            "order_id",
            "courier",
            "courier_phone",
            "courier_company",
            F.col("address").alias("delivery_address"),
            "delivery_status",
        )
    )


def delivery_report(deliveries: DataFrame, couriers: DataFrame, delivery_statuses: DataFrame) -> DataFrame:
    """Status, address and courier of deliveries, whether or not the courier has a company."""
    return (
        deliveries.join(keyed(couriers, "courier_id", courier=full_name()), "courier_id")
        .join(keyed(delivery_statuses, "delivery_status_id", delivery_status="name"), "delivery_status_id")
        .select("order_id", "delivery_status", F.col("address").alias("delivery_address"), "courier")
    )


def waiter_report(
    dine_ins: DataFrame, employees: DataFrame, tables: DataFrame, dine_in_statuses: DataFrame
) -> DataFrame:
    """Waiter, table and status of table services."""
    return (
        dine_ins.join(keyed(employees, "employee_id", waiter=full_name()), "employee_id")
        .join(keyed(tables, "table_id", table_number="number", table_location="location"), "table_id")
        .join(keyed(dine_in_statuses, "status_id", dine_in_status="name"), "status_id")
        .select("order_id", "waiter", "table_number", "table_location", "dine_in_status")
    )


def payment_report(
    orders: DataFrame,
    statuses: DataFrame,
    payment_types: DataFrame,
    transactions: DataFrame,
    transaction_types: DataFrame,
    categories: DataFrame,
) -> DataFrame:
    """Closed orders with the transaction they were paid by."""
    ledger = (
        transactions.select(
            F.col("id").alias("financial_transaction_id"),
            F.col("amount").alias("financial_amount"),
            "transaction_type_id",
            "category_id",
        )
        .join(keyed(transaction_types, "transaction_type_id", financial_type="name"), "transaction_type_id")
        .join(keyed(categories, "category_id", financial_category="name"), "category_id")
    )
    return (
        _heads(orders, statuses)
        .join(_payments(payment_types), "payment_type_id")
        .join(ledger, "financial_transaction_id")
        .select(
            "order_id",
            "order_status",
            F.col("created_at").alias("order_created"),
            "closed_at",
            minutes_between(F.col("created_at"), F.col("closed_at")).alias("total_minutes"),
            "total_cost",
            F.col("to_pay").alias("paid_amount"),
            "payment_type",
            "financial_amount",
            "financial_type",
            "financial_category",
            "financial_transaction_id",
        )
    )


def loyalty_report(
    orders: DataFrame,
    customers: DataFrame,
    tiers: DataFrame,
    loyalty_transactions: DataFrame,
    loyalty_types: DataFrame,
    accrual: str = ACCRUAL,
) -> DataFrame:
    """Customer, tier and the points earned by each order; guests and orders without points drop out."""
    accruals = loyalty_types.filter(F.col("name") == accrual).select(F.col("id").alias("transaction_type_id"))
    earned = loyalty_transactions.join(accruals, "transaction_type_id", "left_semi").select(
        "order_id",
        F.col("points_amount").alias("earned_cashback"),
        F.col("description").alias("cashback_description"),
    )
    people = customers.select(
        F.col("id").alias("customer_id"),
        full_name().alias("customer"),
        F.col("phone").alias("customer_phone"),
        F.col("total_spent").alias("total_spent_all_time"),
        F.col("total_orders").alias("total_orders_all_time"),
        F.col("last_achieved_tier_id").alias("tier_id"),
    ).join(
        keyed(
            tiers,
            "tier_id",
            current_loyalty_tier="name",
            discount_percent="discount_percent",
            cashback_percent="cashback_percent",
        ),
        "tier_id",
    )
    return (
        orders.select(F.col("id").alias("order_id"), "customer_id")
        .join(earned, "order_id")
        .join(people, "customer_id")
        .select(
            "order_id",
            "customer",
            "customer_phone",
            "total_spent_all_time",
            "total_orders_all_time",
            "current_loyalty_tier",
            "discount_percent",
            "cashback_percent",
            "earned_cashback",
            "cashback_description",
        )
    )
