"""State changes of all selected orders at once; n single steps equal one batch."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from venueops.functions.columns import Moment, id_of, moment
from venueops.operators.keys import overlay, surrogate_keys

# Names in the lookup tables and the text of a payment.
SALES = "Продажи"
INCOME = "Доход"
PAYMENT_TEXT = "Оплата заказа "


def pick_orders(
    orders: DataFrame, statuses: DataFrame, status: str, n: int | None = None, newest: bool = False
) -> DataFrame:
    """The orders in a status: all of them, or the ``n`` oldest or newest by (created_at, id)."""
    waiting = orders.filter(F.col("status_id") == id_of(statuses, status))
    if n is None:
        return waiting
    way = F.desc if newest else F.asc
    return waiting.orderBy(way("created_at"), way("id")).limit(n)


def advance_status(
    table: DataFrame, picked: DataFrame, new: dict[str, Column], key: str = "id", only_changed: bool = False
) -> DataFrame:
    """New version of ``table``: rows of the picked orders get the ``new`` values.

    ``key`` is the column of ``table`` holding the order id ("id" for the orders themselves). With
    ``only_changed`` just those rows come back, so that an update of a few orders writes a few rows.
    """
    patch = picked.select(F.col("id").alias(key)).withColumns(new)
    return overlay(table, patch, key, list(new), only_changed)


def material_consumption(picked: DataFrame, lines: DataFrame, recipes: DataFrame) -> DataFrame:
    """What the picked orders use: amount per (order, ingredient, unit of the recipe)."""
    portions = lines.join(picked.select(F.col("id").alias("order_id")), "order_id", "left_semi").select(
        "order_id", "menu_item_id", F.col("quantity").alias("portions")
    )
    needs = recipes.select("menu_item_id", "ingredient_id", "unit_id", "quantity")
    return (
        portions.join(needs, "menu_item_id")
        .groupBy("order_id", "ingredient_id", "unit_id")
        .agg(F.sum(F.col("quantity") * F.col("portions")).cast("decimal(18,3)").alias("amount"))
    )


def stock_after_consumption(stock: DataFrame, consumption: DataFrame) -> DataFrame:
    """Stock less what was used in the same unit; other rows are unchanged. It may go below zero."""
    used = consumption.groupBy("ingredient_id", "unit_id").agg(F.sum("amount").alias("_used"))
    left = F.col("quantity") - F.coalesce("_used", F.lit(0))
    return (
        stock.join(used, ["ingredient_id", "unit_id"], "left")
        .withColumn("quantity", left.cast("decimal(18,3)"))
        .select(*stock.columns)
    )


def post_sales(
    closed: DataFrame, types: DataFrame, categories: DataFrame, existing: DataFrame, at: Moment
) -> DataFrame:
    """One income transaction per closed order, numbered after ``existing`` by (created_at, order id).

    ``order_id`` is there to link the order to its transaction.
    """
    sales = closed.select(F.col("id").alias("order_id"), "created_at", F.col("to_pay").alias("amount"))
    return surrogate_keys(sales, ["created_at", "order_id"], existing).select(
        "id",
        id_of(types, INCOME).alias("transaction_type_id"),
        "amount",
        moment(at).alias("transaction_date"),
        F.concat(F.lit(PAYMENT_TEXT), F.col("order_id").cast("string")).alias("description"),
        id_of(categories, SALES).alias("category_id"),
        "order_id",
    )
