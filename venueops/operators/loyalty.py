"""Loyalty tiers: threshold lookup, spending totals and cashback of a batch of closed orders."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from venueops.functions.columns import keyed
from venueops.functions.ordered import running

TIERS_IN_ARRAY = 4096  # thresholds that a row searches in one array


def tier_reached(df: DataFrame, spent: str, tiers: DataFrame, key: str) -> DataFrame:
    """Adds ``reached_tier_id``: the tier with the greatest ``min_spent`` not above ``spent``.

    NULL where no threshold is reached; of equal thresholds the greatest id counts, and a NULL threshold is never
    reached. Amounts are compared as they are, in the wider of both types. ``key`` is unique in ``df``.

    Up to ``TIERS_IN_ARRAY`` thresholds are one sorted array, the value of a scalar subquery, that each row searches
    by halving, so that ``df`` is neither moved nor written. More of them are merged with the rows in order of amount.
    """
    thresholds = tiers.filter("min_spent is not null").select(F.struct(F.col("min_spent").alias("at"), F.col("id").alias("tier")).alias("_tier"))
    count = thresholds.limit(TIERS_IN_ARRAY + 1).count()
    if count > TIERS_IN_ARRAY:
        return _tier_by_merge(df, spent, thresholds, key)
    ladder = thresholds.agg(F.sort_array(F.collect_list("_tier")).alias("ladder"))
    # how many thresholds are reached: from halves to single steps, each taken if the threshold it leads to is reached
    steps = [1 << k for k in reversed(range(count.bit_length()))]

    def step(reached: Column, width: Column) -> Column:
        there = F.get("_ladder", reached + width - 1)["at"] <= F.col(spent)
        return F.when((reached + width <= count) & there, reached + width).otherwise(reached)

    reached = F.aggregate(F.array(*map(F.lit, steps)), F.lit(0), step) if steps else F.lit(0)
    return df.withColumn("_ladder", ladder.scalar()).select(
        *df.columns, F.get("_ladder", reached - 1)["tier"].alias("reached_tier_id")
    )


def _tier_by_merge(df: DataFrame, spent: str, thresholds: DataFrame, key: str) -> DataFrame:
    steps = thresholds.select(
        F.col("_tier.at").alias("_amount"), F.lit(0).alias("_kind"), F.col("_tier.tier").cast("string").alias("_tie"), "_tier"
    )
    asked = df.select(
        F.col(spent).alias("_amount"),
        F.lit(1).alias("_kind"),
        F.col(key).cast("string").alias("_tie"),
        F.struct(*df.columns).alias("_row"),
    )
    merged = steps.unionByName(asked, allowMissingColumns=True)
    met = running(merged, [], ["_amount", "_kind", "_tie"], {"_best": ("max", "_tier")})
    reached = F.when(F.col("_amount").isNotNull(), F.col("_best.tier"))
    return met.filter("_kind = 1").select("_row.*", reached.alias("reached_tier_id"))


def customer_rollup(customers: DataFrame, closed: DataFrame, only_changed: bool = False) -> DataFrame:
    """Adds the closed orders to ``total_spent`` (full cost, not the price paid) and ``total_orders``."""
    added = (
        closed.filter(F.col("customer_id").isNotNull())
        .groupBy(F.col("customer_id").alias("id"))
        .agg(F.sum("total_cost").alias("_spent"), F.count(F.lit(1)).alias("_orders"))
    )
    grown = customers.join(added, "id", "inner" if only_changed else "left").withColumns(
        {
            "total_spent": (F.col("total_spent") + F.coalesce("_spent", F.lit(0))).cast("decimal(18,2)"),
            "total_orders": (F.col("total_orders") + F.coalesce("_orders", F.lit(0))).cast("bigint"),
        }
    )
    return grown.select(*customers.columns)


def tier_assignment(customers: DataFrame, tiers: DataFrame) -> DataFrame:
    """Sets ``last_achieved_tier_id`` by ``total_spent``; below every threshold the old tier stays."""
    kept = F.coalesce("reached_tier_id", "last_achieved_tier_id")
    return (
        tier_reached(customers, "total_spent", tiers, "id")
        .withColumn("last_achieved_tier_id", kept)
        .select(*customers.columns)
    )


def cashback_accrual(closed: DataFrame, customers: DataFrame, tiers: DataFrame) -> DataFrame:
    """Points per closed order of a known customer, at the tier the customer has *after* that order.

    ``customers`` are as before the batch. Orders count by (created_at, id), as if they were closed
    one after the other; costs are not negative. A customer with a large share of the orders is
    cut into pieces, see :mod:`venueops.functions.ordered`.
    """
    opening = customers.select(
        F.col("id").alias("customer_id"),
        F.col("total_spent").alias("opening"),
        F.col("last_achieved_tier_id").alias("old_tier_id"),
    )
    orders = closed.filter(F.col("customer_id").isNotNull()).select(
        F.col("id").alias("order_id"), "customer_id", "created_at", "total_cost"
    )
    spent = running(orders, ["customer_id"], ["created_at", "order_id"], {"spent": ("sum", "total_cost")})
    spent = spent.join(opening, "customer_id").withColumn(
        "spent", (F.col("spent") + F.col("opening")).cast("decimal(18,2)")
    )
    tiered = (
        tier_reached(spent, "spent", tiers, "order_id")
        .withColumn("tier_id", F.coalesce("reached_tier_id", "old_tier_id"))
        .join(keyed(tiers, "tier_id", tier="name", cashback_percent="cashback_percent"), "tier_id")
    )
    return tiered.select(
        "customer_id",
        "order_id",
        points(F.col("total_cost"), F.col("cashback_percent")).alias("points_amount"),
        _accrual_text().alias("description"),
        "tier_id",
    )


def points(cost: Column, percent: Column) -> Column:
    exact = cost * percent.cast("decimal(5,2)") * F.lit("0.01").cast("decimal(3,2)")
    return F.round(exact, 2).cast("decimal(18,2)")


def _accrual_text() -> Column:
    # Fixed value: the wording of the description.
    return F.concat(
        F.col("cashback_percent").cast("decimal(5,2)").cast("string"),
        F.lit("% кешбэк с заказа на "),
        F.col("total_cost").cast("string"),
        F.lit(" рублей (уровень "),
        F.col("tier"),
        F.lit(")"),
    )
