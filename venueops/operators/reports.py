"""Analytic reports: money per day, popular and jointly bought items, stock, weekdays, supplies."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from venueops.functions.columns import Moment, in_period, keyed
from venueops.plans.session import checkpointed

# Names in the lookup tables and labels in the results.
INCOME = "Доход"
EXPENSE = "Расход"
CANCELLED = "Отменён"
DELIVERED = "Доставлено"
PERIOD_TOTAL = "Всего за период"
WEEKDAYS = ["Воскресенье", "Понедельник", "Вторник", "Среда", "Четверг", "Пятница", "Суббота"]


def pnl_by_day(
    transactions: DataFrame, types: DataFrame, start: Moment, end: Moment, total_label: str = PERIOD_TOTAL
) -> DataFrame:
    """Income, expense and profit per day in [start, end), and one row for the whole period.

    An empty period still has its total row, with NULL sums. The days are few, so the total is
    taken from them; the shuffle of the scan is shared by both halves of the union.
    """
    by_type = (
        transactions.filter(in_period("transaction_date", start, end))
        .groupBy(F.to_date("transaction_date").alias("day"), "transaction_type_id")
        .agg(F.sum("amount").alias("amount"))
    )

    def total_of(kind):
        amount = F.when(F.col("type") == kind, F.col("amount")).otherwise(0)
        return F.sum(amount).cast("decimal(28,2)")

    daily = (
        by_type.join(keyed(types, "transaction_type_id", type="name"), "transaction_type_id")
        .groupBy("day")
        .agg(total_of(INCOME).alias("revenue"), total_of(EXPENSE).alias("expense"))
    )
    period = daily.agg(
        F.sum("revenue").cast("decimal(28,2)").alias("revenue"),
        F.sum("expense").cast("decimal(28,2)").alias("expense"),
    )
    return (
        daily.select(F.col("day").cast("string").alias("day"), "revenue", "expense")
        .unionByName(period.select(F.lit(total_label).alias("day"), "revenue", "expense"))
        .withColumn("profit", (F.col("revenue") - F.col("expense")).cast("decimal(28,2)"))
    )


def popular_items(
    lines: DataFrame,
    orders: DataFrame,
    items: DataFrame,
    statuses: DataFrame,
    start: Moment,
    end: Moment,
    excluded: tuple[str, ...] = (CANCELLED,),
) -> DataFrame:
    """Quantity, number of orders and revenue per item over the orders of [start, end).

    Lines are first summed per (item, order): the distinct count becomes a plain count, and a
    popular item reaches the last shuffle as one partial row per task.
    """
    dropped = statuses.filter(F.col("name").isin(*excluded)).select(F.col("id").alias("status_id"))
    counted = (
        orders.filter(in_period("created_at", start, end))
        .join(dropped, "status_id", "left_anti")
        .select(F.col("id").alias("order_id"))
    )
    per_order = (
        lines.join(counted, "order_id", "left_semi")
        .groupBy("menu_item_id", "order_id")
        .agg(
            F.sum("quantity").alias("quantity"),
            F.sum(F.col("item_cost") * F.col("quantity")).alias("revenue"),
        )
    )
    per_item = per_order.groupBy("menu_item_id").agg(
        F.sum("quantity").cast("bigint").alias("total_quantity"),
        F.count(F.lit(1)).alias("orders_count"),
        F.sum("revenue").cast("decimal(28,2)").alias("total_revenue"),
    )
    return (
        per_item.join(keyed(items, "menu_item_id", dish_name="name"), "menu_item_id")
        .select("menu_item_id", "dish_name", "total_quantity", "orders_count", "total_revenue")
        .orderBy(F.desc("total_quantity"), "menu_item_id")
    )


def producible_portions(recipes: DataFrame, items: DataFrame, stock: DataFrame) -> DataFrame:
    """How many portions of each available item the stock allows; units are not compared.

    A need of zero limits nothing, an ingredient at zero stock makes it zero.
    """
    possible = F.try_divide(F.col("on_hand"), F.col("quantity"))
    portions = (
        recipes.select("menu_item_id", "ingredient_id", "quantity")
        .join(stock.select("ingredient_id", F.col("quantity").alias("on_hand")), "ingredient_id")
        .groupBy("menu_item_id")
        .agg(F.floor(F.min(possible)).cast("bigint").alias("count_of_portions"))
    )
    available = keyed(items.filter("is_available"), "menu_item_id", dish="name")
    return (
        portions.join(available, "menu_item_id")
        .select("menu_item_id", "dish", "count_of_portions")
        .orderBy("count_of_portions", "menu_item_id")
    )


def copurchase_pairs(
    lines: DataFrame, items: DataFrame, min_support: int = 1, order_limit: int = 512
) -> DataFrame:
    """Item pairs bought in the same order, with the number of such orders, from ``min_support`` up.

    Pairs are formed only inside orders of at most ``order_limit`` distinct items. Larger orders,
    if there are any, are treated apart and exactly; see :func:`_pairs_of_large_orders`.
    """
    # read several times below, and narrow: two columns, repeats gone
    bought = lines.select("order_id", "menu_item_id").distinct()
    if min_support > 1:  # an item in fewer orders is in no pair that counts
        bought = checkpointed(bought)
        often = bought.groupBy("menu_item_id").count().filter(F.col("count") >= min_support)
        bought = bought.join(often, "menu_item_id", "left_semi")
    bought = checkpointed(bought)
    large = bought.groupBy("order_id").agg(F.count(F.lit(1)).alias("distinct_items")).filter(
        F.col("distinct_items") > order_limit
    )
    if large.isEmpty():
        pairs = _pairs_within(bought)
    else:
        small_pairs = checkpointed(_pairs_within(bought.join(large, "order_id", "left_anti")))
        large_pairs = _pairs_of_large_orders(
            bought.join(large, "order_id"), small_pairs, min_support, order_limit
        )
        pairs = (
            small_pairs.unionByName(large_pairs)
            .groupBy("item_1", "item_2")
            .agg(F.sum("orders").alias("orders"))
        )

    return (
        pairs.filter(F.col("orders") >= min_support)
        .join(keyed(items, "item_1", dish_1="name"), "item_1")
        .join(keyed(items, "item_2", dish_2="name"), "item_2")
        .select("item_1", "item_2", "dish_1", "dish_2", F.col("orders").alias("count_of_joint_orders"))
        .orderBy(F.desc("count_of_joint_orders"), "item_1", "item_2")
    )


def _pairs_within(bought: DataFrame) -> DataFrame:
    left = bought.withColumnRenamed("menu_item_id", "item_1")
    right = bought.withColumnRenamed("menu_item_id", "item_2")
    return (
        left.join(right, "order_id")
        .filter(F.col("item_1") < F.col("item_2"))
        .groupBy("item_1", "item_2")
        .agg(F.count(F.lit(1)).alias("orders"))
    )


def _pairs_of_large_orders(
    large_orders: DataFrame, small_pairs: DataFrame, min_support: int, order_limit: int
) -> DataFrame:
    """How often pairs occur in the large orders, for every pair that can still reach the support.

    With a support of one every pair is part of the answer. Otherwise a pair either occurs in a
    small order too, and is looked up in the large ones, or it lives in large orders alone, and then
    both items must be in at least ``min_support`` of them. One giant order so forms no pairs at all.
    """
    if min_support == 1:
        return _pairs_by_blocks(large_orders, order_limit)

    members = large_orders.select("order_id", "menu_item_id")
    candidates = small_pairs.select("item_1", "item_2")
    looked_up = (
        candidates.join(members.withColumnRenamed("menu_item_id", "item_1"), "item_1")
        .join(members.withColumnRenamed("menu_item_id", "item_2"), ["order_id", "item_2"], "left_semi")
        .groupBy("item_1", "item_2")
        .agg(F.count(F.lit(1)).alias("orders"))
    )
    often = members.groupBy("menu_item_id").count().filter(F.col("count") >= min_support)
    only_large = _pairs_by_blocks(
        large_orders.join(often.select("menu_item_id"), "menu_item_id", "left_semi"), order_limit
    ).join(candidates, ["item_1", "item_2"], "left_anti")
    return looked_up.unionByName(only_large)


def _pairs_by_blocks(large_orders: DataFrame, order_limit: int) -> DataFrame:
    """Pairs of large orders, each order cut into a grid of cells so that many tasks share it."""
    blocks = F.ceil(F.col("distinct_items") / order_limit)
    block = F.pmod(F.xxhash64("menu_item_id"), F.col("blocks"))
    cells = (
        large_orders.withColumn("blocks", blocks)
        .withColumn("block", block)
        .withColumn("other", F.explode(F.sequence(F.lit(0).cast("bigint"), F.col("blocks") - 1)))
        .select(
            "order_id",
            F.least("block", "other").alias("low"),
            F.greatest("block", "other").alias("high"),
            "block",
            "menu_item_id",
        )
    )
    left = cells.withColumnRenamed("menu_item_id", "item_1").withColumnRenamed("block", "block_1")
    right = cells.withColumnRenamed("menu_item_id", "item_2").withColumnRenamed("block", "block_2")
    across = (F.col("low") == F.col("high")) | (F.col("block_1") != F.col("block_2"))
    return (
        left.join(right, ["order_id", "low", "high"])
        .filter((F.col("item_1") < F.col("item_2")) & across)
        .groupBy("item_1", "item_2")
        .agg(F.count(F.lit(1)).alias("orders"))
    )


def weekday_profile(orders: DataFrame) -> DataFrame:
    """Average number of orders, revenue and bill of a day, per weekday; Sunday is day 0."""
    daily = orders.groupBy(F.to_date("created_at").alias("day")).agg(
        F.count(F.lit(1)).alias("orders"),
        F.sum("to_pay").alias("revenue"),
        F.avg("to_pay").alias("bill"),
    )
    number = F.dayofweek("day") - 1
    names = F.array(*[F.lit(name) for name in WEEKDAYS])
    return (
        daily.groupBy(number.alias("day_number"))
        .agg(
            F.round(F.avg("orders"), 0).cast("decimal(18,0)").alias("average_orders"),
            F.round(F.avg("revenue"), 2).cast("decimal(28,2)").alias("average_revenue"),
            F.round(F.avg("bill"), 2).cast("decimal(28,2)").alias("average_check"),
        )
        .withColumn("week_day", F.get(names, F.col("day_number")))
        .select("day_number", "week_day", "average_orders", "average_revenue", "average_check")
        .orderBy("day_number")
    )


def delivered_materials(
    supply_lines: DataFrame,
    supplies: DataFrame,
    ingredients: DataFrame,
    units: DataFrame,
    statuses: DataFrame,
    start: Moment,
    end: Moment,
    delivered: str = DELIVERED,
) -> DataFrame:
    """Quantity, number of supplies and cost per material and unit, delivered in [start, end)."""
    wanted = statuses.filter(F.col("name") == delivered).select(F.col("id").alias("status_id"))
    arrived = (
        supplies.filter(in_period("delivery_date", start, end))
        .join(wanted, "status_id", "left_semi")
        .select(F.col("id").alias("supplier_order_id"))
    )
    per_supply = (
        supply_lines.join(arrived, "supplier_order_id", "left_semi")
        .groupBy("ingredient_id", "unit_id", "supplier_order_id")
        .agg(F.sum("quantity").alias("quantity"), F.sum("total_cost").alias("cost"))
    )
    return (
        per_supply.groupBy("ingredient_id", "unit_id")
        .agg(
            F.sum("quantity").cast("decimal(28,3)").alias("quantity_of_delivered"),
            F.count(F.lit(1)).alias("count_of_supplies"),
            F.round(F.sum("cost"), 2).cast("decimal(28,2)").alias("money_spent"),
        )
        .join(keyed(ingredients, "ingredient_id", ingredient="name"), "ingredient_id")
        .join(keyed(units, "unit_id", unit="name"), "unit_id")
        .select(
            "ingredient_id", "ingredient", "quantity_of_delivered", "unit", "count_of_supplies", "money_spent"
        )
        .orderBy(F.desc("quantity_of_delivered"), "ingredient_id", "unit")
    )
