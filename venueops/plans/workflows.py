"""The restaurant's workflows over whole batches: tables in, changed tables and new rows out.

Each takes a dict of tables by name and returns the tables it changes, as new versions, and the
rows to append under ``new <table>``. What is read afterwards is in ``operators.receipts``.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from venueops.functions.columns import Moment, id_of, moment
from venueops.operators.baskets import (
    price_baskets,
    rejected_lines,
    resolve_customers,
    snapshot_prices,
    split_service_type,
)
from venueops.operators.bookings import admit_reservations, with_span
from venueops.operators.keys import overlay, surrogate_keys
from venueops.operators.lifecycle import (
    advance_status,
    material_consumption,
    pick_orders,
    post_sales,
    stock_after_consumption,
)
from venueops.operators.loyalty import cashback_accrual, customer_rollup, tier_assignment
from venueops.plans.session import checkpointed

Tables = dict[str, DataFrame]

# Names in the lookup tables.
WAITING = "В ожидании"
COOKING = "Готовится"
READY = "Готов"
DONE = "Завершён"
PICKED_UP = "Забран"
DELIVERED = "Доставлен"
SERVED = "Подано"
ASSEMBLING = "Собирается"
EXPECTED = "Ожидание"
USE = "Использование"
ACCRUAL = "Начисление"


def place_orders(tables: Tables, requests: DataFrame, basket: DataFrame, at: Moment) -> Tables:
    """New orders with lines, prices and service. ``requests`` and ``basket`` share ``request_id``."""
    routed = resolve_customers(split_service_type(requests), tables["Customers"])
    accepted = routed.filter("route <> 'rejected'")
    numbered = surrogate_keys(accepted, ["request_id"], tables["Orders"])
    ids = numbered.select("request_id", F.col("id").alias("order_id"))
    wanted = basket.join(ids, "request_id").select("order_id", "menu_item_id", "quantity")
    new_lines = snapshot_prices(wanted, tables["MenuItems"]).withColumns(
        {"created_at": moment(at), "cooked_at": F.lit(None).cast("timestamp_ntz")}
    )
    # written in order of the orders: their totals are summed where the lines are, and the baskets are joined once
    lines = surrogate_keys(new_lines, ["order_id", "menu_item_id", "quantity"], tables["OrderItems"])
    prices = price_baskets(numbered, lines, tables["Customers"], tables["LoyaltyTiers"])
    orders = numbered.join(prices.drop("customer_id").withColumnRenamed("order_id", "id"), "id").select(
        "id",
        "customer_id",
        id_of(tables["OrderStatuses"], WAITING).alias("status_id"),
        "payment_type_id",
        "total_cost",
        "to_pay",
        "comment",
        moment(at).alias("created_at"),
        F.lit(None).cast("timestamp_ntz").alias("closed_at"),
        F.lit(None).cast("int").alias("financial_transaction_id"),
    )
    hall = numbered.filter("route = 'hall'").select(
        F.col("id").alias("order_id"), "table_id", "employee_id"
    )
    delivery = numbered.filter("route = 'delivery'").select(
        F.col("id").alias("order_id"), "address", "courier_id"
    )
    return {
        "new Orders": orders,
        "new OrderItems": lines,
        "new DineIns": surrogate_keys(hall, ["order_id"], tables["DineIns"]).withColumn(
            "status_id", id_of(tables["DineInStatuses"], EXPECTED)
        ),
        "new Deliveries": surrogate_keys(delivery, ["order_id"], tables["Deliveries"]).withColumn(
            "delivery_status_id", id_of(tables["DeliveryStatuses"], ASSEMBLING)
        ),
        "rejected requests": routed.filter("route = 'rejected'"),
        "rejected lines": rejected_lines(wanted, tables["MenuItems"]),
    }


def cook_orders(
    tables: Tables, employee_id: int, at: Moment, n: int | None = 1, newest: bool = False
) -> Tables:
    """Waiting orders go to the kitchen: status, one stock operation per order, stock."""
    picked = checkpointed(pick_orders(tables["Orders"], tables["OrderStatuses"], WAITING, n, newest))
    operations = surrogate_keys(
        picked.select(F.col("id").alias("order_id"), "created_at"),
        ["created_at", "order_id"],
        tables["IngredientOperations"],
    )
    # the operation comes to the materials while they still lie by order; an order that is there twice has two
    numbers = operations.groupBy("order_id").agg(F.collect_list("id").alias("operations"))
    used = checkpointed(
        material_consumption(picked, tables["OrderItems"], tables["RecipeItems"]).join(numbers, "order_id", "left")
    )
    operation_items = used.withColumn("operation_id", F.explode("operations")).select(
        "operation_id",
        "ingredient_id",
        id_of(tables["IngredientOperationTypes"], USE).alias("operation_type_id"),
        "unit_id",
        "amount",
    )
    return {
        "picked": picked,
        "Orders": advance_status(
            tables["Orders"], picked, {"status_id": id_of(tables["OrderStatuses"], COOKING)}
        ),
        "new IngredientOperations": operations.select(
            "id", F.lit(employee_id).alias("employee_id"), moment(at).alias("created_at")
        ),
        "new IngredientOperationItems": surrogate_keys(
            operation_items,
            ["operation_id", "ingredient_id", "unit_id"],
            tables["IngredientOperationItems"],
        ),
        "IngredientInventory": stock_after_consumption(tables["IngredientInventory"], used),
    }


def complete_orders(tables: Tables, at: Moment, n: int | None = 1) -> Tables:
    """Cooked orders are ready: lines stamped, deliveries picked up, tables served."""
    picked = checkpointed(pick_orders(tables["Orders"], tables["OrderStatuses"], COOKING, n))
    return {
        "picked": picked,
        "Orders": advance_status(
            tables["Orders"], picked, {"status_id": id_of(tables["OrderStatuses"], READY)}
        ),
        "OrderItems": advance_status(tables["OrderItems"], picked, {"cooked_at": moment(at)}, "order_id"),
        "Deliveries": advance_status(
            tables["Deliveries"],
            picked,
            {"delivery_status_id": id_of(tables["DeliveryStatuses"], PICKED_UP)},
            "order_id",
        ),
        "DineIns": advance_status(
            tables["DineIns"], picked, {"status_id": id_of(tables["DineInStatuses"], SERVED)}, "order_id"
        ),
    }


def close_orders(tables: Tables, at: Moment, n: int | None = 1) -> Tables:
    """Ready orders are paid: transaction, closing time, delivery, customer totals, tier, points."""
    picked = checkpointed(pick_orders(tables["Orders"], tables["OrderStatuses"], READY, n))
    sales = post_sales(
        picked,
        tables["FinancialTransactionTypes"],
        tables["FinancialTransactionsCategories"],
        tables["FinancialTransactions"],
        at,
    )
    closing = sales.select(
        F.col("order_id").alias("id"),
        id_of(tables["OrderStatuses"], DONE).alias("status_id"),
        moment(at).alias("closed_at"),
        F.col("id").alias("financial_transaction_id"),
    )
    grown = customer_rollup(tables["Customers"], picked, only_changed=True)
    retiered = tier_assignment(grown, tables["LoyaltyTiers"])
    points = cashback_accrual(picked, tables["Customers"], tables["LoyaltyTiers"])
    return {
        "picked": picked,
        "Orders": overlay(
            tables["Orders"], closing, "id", ["status_id", "closed_at", "financial_transaction_id"]
        ),
        "Deliveries": advance_status(
            tables["Deliveries"],
            picked,
            {"delivery_status_id": id_of(tables["DeliveryStatuses"], DELIVERED)},
            "order_id",
        ),
        "new FinancialTransactions": sales.drop("order_id"),
        "Customers": overlay(
            tables["Customers"], retiered, "id", ["total_spent", "total_orders", "last_achieved_tier_id"]
        ),
        "new LoyaltyTransactions": surrogate_keys(
            points, ["order_id"], tables["LoyaltyTransactions"]
        ).select(
            "id",
            "customer_id",
            "order_id",
            "points_amount",
            id_of(tables["LoyaltyTransactionTypes"], ACCRUAL).alias("transaction_type_id"),
            "description",
            moment(at).alias("created_at"),
        ),
    }


def book_tables(tables: Tables, requests: DataFrame) -> Tables:
    """Reservation requests (columns of TableReservations, with ``request_id`` for ``id``), in that order."""
    asked = with_span(requests).withColumn("arrival", F.col("request_id"))
    decided = admit_reservations(asked, with_span(tables["TableReservations"]), tables["Tables"])
    decided = checkpointed(decided)
    columns = [c for c in tables["TableReservations"].columns if c != "id"]
    accepted = decided.filter("accepted").select("request_id", *columns)
    return {
        "decided": decided,
        "new TableReservations": surrogate_keys(
            accepted, ["request_id"], tables["TableReservations"]
        ).select("id", *columns),
    }
