"""A day of the venue: the workflows one after the other, each over the tables that the step before wrote."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from bindings.views import Venue
from venueops.plans import workflows
from venueops.plans.session import checkpointed
from venueops.plans.workflows import Tables

PLACED_AT = "2002-01-02 09:00:00"
COOKED_AT = "2002-01-02 10:00:00"
COMPLETED_AT = "2002-01-02 11:00:00"
CLOSED_AT = "2002-01-02 12:00:00"
COOK = 7


def opening(v: Venue) -> Tables:
    """The tables in the morning; of those that only number their new rows, the ids."""
    cooked = F.when(F.col("l_linestatus") == "F", F.col("l_shipdate"))
    line_id = F.col("l_orderkey") * 1000 + F.col("l_linenumber")
    return {
        "Orders": v.orders.withColumns(
            {
                "closed_at": F.lit(None).cast("timestamp_ntz"),
                "financial_transaction_id": F.lit(None).cast("bigint"),
            }
        ),
        "OrderItems": v.read("lineitem").select(
            line_id.alias("id"),
            F.col("l_orderkey").alias("order_id"),
            F.col("l_partkey").alias("menu_item_id"),
            F.col("l_extendedprice").cast("decimal(18,2)").alias("item_cost"),
            F.col("l_quantity").cast("int").alias("quantity"),
            F.col("l_shipdate").alias("created_at"),
            cooked.alias("cooked_at"),
        ),
        "Deliveries": v.deliveries,
        "DineIns": v.dine_ins,
        "Customers": v.customers,
        "MenuItems": v.items,
        "RecipeItems": v.recipes,
        "IngredientInventory": v.stock,
        "LoyaltyTiers": v.spending_tiers,
        "OrderStatuses": v.lookup("('F','Завершён'),('R','Готов'),('O','Готовится'),('P','В ожидании')"),
        "DeliveryStatuses": v.lookup("('F','Доставлен'),('P','Забран'),('O','Собирается')"),
        "DineInStatuses": v.dine_in_statuses,
        "IngredientOperationTypes": v.lookup("(1,'Поставка'),(2,'Использование')"),
        "FinancialTransactionTypes": v.sales_types,
        "FinancialTransactionsCategories": v.sales_categories,
        "LoyaltyTransactionTypes": v.loyalty_types,
        "IngredientOperations": v.orders.filter("status_id = 'F'").select("id"),
        "IngredientOperationItems": v.read("lineitem").select(line_id.alias("id")),
        "FinancialTransactions": v.ledger.select("id"),
        "LoyaltyTransactions": v.loyalty_transactions.select(F.col("order_id").alias("id")),
    }


def _after(tables: Tables, step: Tables) -> Tables:
    """The tables once a step is stored: its new versions and its new rows, each read back from what was written."""
    now = dict(tables)
    for name, frame in step.items():
        table = name.removeprefix("new ")
        if table not in tables:
            now[name] = frame
        elif table == name:
            now[name] = checkpointed(frame)
        else:
            now[name] = checkpointed(frame)
            now[table] = tables[table].unionByName(now[name], allowMissingColumns=True)
    return now


def after_placing(v: Venue) -> Tables:
    """Every order of the table is asked for once more, by the phone of its customer."""
    kind = (
        F.when(F.col("payment_type_id").isin("1-URGENT", "3-MEDIUM"), "delivery")
        .when(F.col("payment_type_id").isin("2-HIGH", "4-NOT SPECIFIED"), "dine_in")
        .otherwise("takeaway")
    )
    phone = F.concat(F.lit("Customer#"), F.lpad(F.col("customer_id").cast("string"), 9, "0"))
    requests = (
        v.orders.select(
            F.col("id").alias("order_id"), kind.alias("order_type"), phone.alias("customer_phone"),
            "payment_type_id", "comment",
        )
        .join(v.deliveries.select("order_id", "address", "courier_id"), "order_id", "left")
        .join(v.dine_ins.select("order_id", "table_id", "employee_id"), "order_id", "left")
        .withColumnRenamed("order_id", "request_id")
    )
    basket = v.lines.select(F.col("order_id").alias("request_id"), "menu_item_id", "quantity")
    tables = opening(v)
    return _after(tables, workflows.place_orders(tables, requests, basket, PLACED_AT))


def after_cooking(v: Venue) -> Tables:
    tables = after_placing(v)
    return _after(tables, workflows.cook_orders(tables, COOK, COOKED_AT, None))


def after_completing(v: Venue) -> Tables:
    tables = after_cooking(v)
    return _after(tables, workflows.complete_orders(tables, COMPLETED_AT, None))


def after_closing(v: Venue) -> Tables:
    tables = after_completing(v)
    return _after(tables, workflows.close_orders(tables, CLOSED_AT, None))


def place_orders(v: Venue) -> DataFrame:
    """The orders placed, with the number and the first id of their lines and the id of their service."""
    t = after_placing(v)
    lines = t["new OrderItems"].groupBy("order_id").agg(
        F.count("*").alias("n_lines"), F.min("id").alias("first_line_id")
    )
    deliveries = t["new Deliveries"].select(
        "order_id", F.col("id").alias("delivery_id"), "address", "delivery_status_id"
    )
    halls = t["new DineIns"].select(
        "order_id", F.col("id").alias("dine_in_id"), "table_id", F.col("status_id").alias("dine_in_status_id")
    )
    return (
        t["new Orders"]
        .select(
            F.col("id").alias("order_id"), "customer_id", "status_id", "payment_type_id", "total_cost", "to_pay",
            "created_at",
        )
        .join(lines, "order_id", "left")
        .join(deliveries, "order_id", "left")
        .join(halls, "order_id", "left")
    )


def cook_orders(v: Venue) -> DataFrame:
    """What was taken from the stock for each order, and the stock that is left of it."""
    t = after_cooking(v)
    left = t["IngredientInventory"].withColumnRenamed("quantity", "left_in_stock")
    return t["new IngredientOperationItems"].join(left, ["ingredient_id", "unit_id"], "left")


def complete_orders(v: Venue) -> DataFrame:
    """The orders completed, as the stored tables have them: status, lines, time, service."""
    t = after_completing(v)
    lines = t["OrderItems"].groupBy("order_id").agg(
        F.count("*").alias("n_lines"), F.min("cooked_at").alias("first_cooked"), F.max("cooked_at").alias("last_cooked")
    )
    return (
        t["Orders"]
        .filter("status_id <> 'F'")
        .select(F.col("id").alias("order_id"), "status_id")
        .join(lines, "order_id", "left")
        .join(t["Deliveries"].select("order_id", "delivery_status_id"), "order_id", "left")
        .join(t["DineIns"].select("order_id", F.col("status_id").alias("dine_in_status_id")), "order_id", "left")
    )


def close_orders(v: Venue) -> DataFrame:
    """The orders closed, with their payment, points and delivery, and what their customers then have."""
    t = after_closing(v)
    paid = t["new FinancialTransactions"].select(F.col("id").alias("financial_transaction_id"), "amount")
    points = t["new LoyaltyTransactions"].select("order_id", F.col("id").alias("loyalty_id"), "points_amount")
    people = t["Customers"].select(
        F.col("id").alias("customer_id"), "total_spent", "total_orders", "last_achieved_tier_id"
    )
    return (
        t["Orders"]
        .filter("closed_at is not null")
        .select(F.col("id").alias("order_id"), "customer_id", "status_id", "closed_at", "financial_transaction_id")
        .join(paid, "financial_transaction_id")
        .join(points, "order_id", "left")
        .join(t["Deliveries"].select("order_id", "delivery_status_id"), "order_id", "left")
        .join(people, "customer_id", "left")
    )


def book_tables(v: Venue) -> DataFrame:
    """Events as reservations by date, time of day and minutes; those that are no purchases ask, in order of id."""
    events = v.read("events").select(
        F.col("event_id").alias("id"),
        F.col("user_id").alias("table_id"),
        F.concat(F.lit("user "), F.col("user_id").cast("string")).alias("customer_phone"),
        F.date_format("ts", "yyyy-MM-dd").alias("reservation_date"),
        F.date_format("ts", "HH:mm:ss.SSSSSS").alias("reservation_time"),
        F.col("value").alias("duration_minutes"),
        "event_type",
    )
    tables = {
        "TableReservations": events.filter("event_type = 'purchase'").drop("event_type"),
        "Tables": v.rooms,
    }
    requests = events.filter("event_type <> 'purchase'").drop("event_type").withColumnRenamed("id", "request_id")
    return _after(tables, workflows.book_tables(tables, requests))["new TableReservations"]
