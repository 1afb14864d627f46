"""Order intake for a batch of requested orders: customer, prices, totals, hall or delivery."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from venueops.functions.columns import keyed


def resolve_customers(requests: DataFrame, customers: DataFrame) -> DataFrame:
    """Adds ``customer_id`` by ``customer_phone``; an unknown or missing phone is a guest (NULL)."""
    known = customers.select(F.col("phone").alias("customer_phone"), F.col("id").alias("customer_id"))
    return requests.join(known, "customer_phone", "left").select(*requests.columns, "customer_id")


def snapshot_prices(requested: DataFrame, items: DataFrame) -> DataFrame:
    """Order lines with the item's current price copied in; unknown items are dropped."""
    return requested.join(keyed(items, "menu_item_id", item_cost="price"), "menu_item_id").select(
        "order_id", "menu_item_id", "item_cost", "quantity"
    )


def rejected_lines(requested: DataFrame, items: DataFrame) -> DataFrame:
    """The requested lines :func:`snapshot_prices` drops."""
    unknown = requested.join(keyed(items, "menu_item_id"), "menu_item_id", "left_anti")
    return unknown.select(*requested.columns)


def price_baskets(orders: DataFrame, lines: DataFrame, customers: DataFrame, tiers: DataFrame) -> DataFrame:
    """``total_cost`` and ``to_pay`` of each order; the discount is that of the customer's tier.

    Guests and customers without a tier pay the full price, an order without lines costs 0.
    """
    totals = lines.groupBy("order_id").agg(F.sum(F.col("item_cost") * F.col("quantity")).alias("total"))
    discounts = customers.join(
        keyed(tiers, "last_achieved_tier_id", discount_percent="discount_percent"), "last_achieved_tier_id"
    ).select(F.col("id").alias("customer_id"), "discount_percent")

    total_cost = F.coalesce("total", F.lit(0)).cast("decimal(18,2)")
    share = 1 - F.coalesce("discount_percent", F.lit(0)).cast("decimal(5,2)") * F.lit("0.01").cast("decimal(3,2)")
    return (
        orders.select(F.col("id").alias("order_id"), "customer_id")
        .join(totals, "order_id", "left")
        .join(discounts, "customer_id", "left")
        .select(
            "order_id",
            "customer_id",
            total_cost.alias("total_cost"),
            F.round(total_cost * share, 2).cast("decimal(18,2)").alias("to_pay"),
        )
    )


def split_service_type(requests: DataFrame) -> DataFrame:
    """Adds ``route`` ('hall', 'delivery' or 'rejected') and, for a rejected request, the ``reason``.

    A hall order needs table and waiter, a delivery needs address and courier. A number of zero counts as missing, as
    does an empty text; the text "0" does not.
    """
    def given(column):
        text = isinstance(requests.schema[column].dataType, T.StringType)
        return F.coalesce(F.col(column) != ("" if text else 0), F.lit(False))

    kind = F.col("order_type")
    hall = (kind == "dine_in") & given("table_id") & given("employee_id")
    delivery = (kind == "delivery") & given("address") & given("courier_id")
    route = F.when(hall, "hall").when(delivery, "delivery").otherwise("rejected")
    reason = (
        F.when(hall | delivery, F.lit(None))
        .when(kind == "dine_in", "table or waiter missing")
        .when(kind == "delivery", "address or courier missing")
        .otherwise("unknown order type")
    )
    return requests.withColumns({"route": route, "reason": reason})
