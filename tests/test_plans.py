"""Physical plans: pushed filters, shared scans, hot keys split, no Python, no products."""

from __future__ import annotations

import pytest
from pyspark.sql import functions as F

import bindings.queries as bound
from bindings import day
from bindings.views import Venue
from venueops.operators import baskets, reports
from venueops.plans import workflows
from venueops.plans.session import tuned

FOLDER = "/root/testdata/sf0.001"


def plan_of(df, run=True):
    if run:
        df.collect()
    text = df._jdf.queryExecution().executedPlan().toString()
    return text.split("== Initial Plan ==")[0]


@pytest.fixture
def small_skew(spark):
    """No broadcasts, and partitions count as skewed from a few kilobytes on."""
    confs = {
        "spark.sql.autoBroadcastJoinThreshold": "-1",
        "spark.sql.adaptive.autoBroadcastJoinThreshold": "-1",
        "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "200KB",
        "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "2",
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": "100KB",
        "spark.sql.adaptive.coalescePartitions.minPartitionSize": "10KB",
        "spark.sql.shuffle.partitions": "16",
    }
    before = {key: spark.conf.get(key, None) for key in confs}
    tuned(spark)
    for key, value in confs.items():
        spark.conf.set(key, value)
    yield
    for key, value in before.items():
        if value is None:
            spark.conf.unset(key)
        else:
            spark.conf.set(key, value)


def test_the_period_reaches_the_scan_and_the_days_are_scanned_once(spark):
    plan = plan_of(bound.pnl_by_day(Venue(spark, FOLDER)))
    assert "GreaterThanOrEqual(o_orderdate" in plan and "LessThan(o_orderdate" in plan
    assert plan.count("FileScan") == 1 and "ReusedExchange" in plan


def test_scans_read_only_the_columns_needed(spark):
    plan = plan_of(bound.copurchase_pairs(Venue(spark, FOLDER)), run=False)
    assert "l_extendedprice" not in plan
    plan = plan_of(bound.weekday_profile(Venue(spark, FOLDER)), run=False)
    assert "ReadSchema: struct<o_totalprice:double,o_orderdate:timestamp_ntz>" in plan


@pytest.mark.parametrize("name", [n for n in bound._ALL if "route" not in n])
def test_no_python_and_no_products(spark, name):
    plan = plan_of(bound._ALL[name](Venue(spark, FOLDER)), run=False)
    assert "Python" not in plan and "Pandas" not in plan and "CartesianProduct" not in plan


def test_a_hot_order_is_split(spark, small_skew):
    n = 400_000
    rows = spark.range(n)
    order = F.when(F.col("id") % 3 == 0, 1).otherwise(F.pmod(F.xxhash64("id"), F.lit(n)))
    lines = rows.select(
        order.alias("order_id"),
        F.pmod(F.xxhash64("id", F.lit(1)), F.lit(n)).alias("menu_item_id"),
        F.lit("2.00").cast("decimal(18,2)").alias("item_cost"),
        F.lit(1).alias("quantity"),
    )
    orders = rows.select(
        "id", F.lit(1).alias("status_id"), F.lit("2026-04-02").cast("timestamp_ntz").alias("created_at")
    )
    items = rows.select("id", F.col("id").cast("string").alias("name"))
    statuses = spark.sql("SELECT * FROM VALUES (2, 'Отменён') AS t(id, name)")
    popular = reports.popular_items(lines, orders, items, statuses, "2026-04-01", "2026-05-01")
    total = popular.agg(F.sum("total_quantity"), F.sum("orders_count"))
    assert total.collect()[0][0] == n
    assert "skew=true" in plan_of(total, run=False)


def test_guests_do_not_share_a_task(spark, small_skew):
    n = 400_000
    rows = spark.range(n)
    orders = rows.select("id", F.when(F.col("id") % 3 != 0, F.col("id")).alias("customer_id"))
    lines = rows.select(
        F.col("id").alias("order_id"), F.lit("2.00").cast("decimal(18,2)").alias("item_cost"),
        F.lit(1).alias("quantity"),
    )
    customers = rows.select("id", (F.col("id") % 2).alias("last_achieved_tier_id"))
    tiers = spark.sql("SELECT * FROM VALUES (0, 10.0), (1, 10.0) AS t(id, discount_percent)")
    # order ids keep the rows apart, else those of guests would be compressed to nothing
    priced = baskets.price_baskets(orders, lines, customers, tiers).agg(F.sum("to_pay"), F.max("order_id"))
    assert float(priced.collect()[0][0]) == pytest.approx(2.0 * (n - n // 3 - 1) * 0.9 + 2.0 * (n // 3 + 1))
    assert "skew=true" in plan_of(priced, run=False)


@pytest.mark.parametrize("name", ["tier_assignment", "cashback_accrual"])
def test_tiers_are_met_without_a_product(spark, name):
    plan = plan_of(getattr(bound, name)(Venue(spark, FOLDER)), run=False)
    assert "NestedLoop" not in plan and "CartesianProduct" not in plan


def test_the_audit_scans_each_table_once_and_shuffles_the_rows_once(spark):
    plan = plan_of(bound.constraint_audit(Venue(spark, FOLDER)), run=False)
    assert plan.count("FileScan") == len(bound._audited())
    # by key, by space; what else moves is a row for each rule
    assert plan.count("Exchange hashpartitioning") <= 4 and plan.count("BroadcastExchange") <= 1


def test_a_task_gets_a_small_piece_of_a_large_shuffle(spark):
    key = "spark.sql.adaptive.coalescePartitions.parallelismFirst"
    tuned(spark)
    spark.conf.set(key, "false")  # as with more rows than the cores could share in small pieces
    try:
        rows = spark.range(3_000_000).select("id", F.xxhash64("id").alias("a"), F.xxhash64("id", F.lit(1)).alias("b"))
        dealt = rows.repartition("id").select(F.spark_partition_id().alias("task"), "a", "b")
        assert len(dealt.groupBy("task").agg(F.max("a"), F.max("b")).collect()) > 2
    finally:
        spark.conf.unset(key)


def test_baskets_are_joined_once_and_materials_where_they_lie(spark, monkeypatch):
    numbered = {}
    keys = workflows.surrogate_keys

    def watched(df, order, *more):
        numbered[tuple(order)] = df._jdf.queryExecution().optimizedPlan().toString()
        return keys(df, order, *more)

    monkeypatch.setattr(workflows, "surrogate_keys", watched)
    placed = []
    place = workflows.place_orders
    monkeypatch.setattr(workflows, "place_orders", lambda *given: placed.append(place(*given)) or placed[0])
    day.after_cooking(Venue(spark, FOLDER))
    assert "l_partkey" not in plan_of(placed[0]["new Orders"], run=False)
    assert "Join" not in numbered["operation_id", "ingredient_id", "unit_id"]
