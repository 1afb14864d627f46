"""One query per operator over the whole test tables."""

from __future__ import annotations

import uuid
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from bindings import day
from bindings.views import Venue
from venueops.functions.columns import id_of, money
from venueops.operators import audit, baskets, bookings, keys, lifecycle, loyalty, receipts, reports, routes
from venueops.plans.session import checkpoint_folder
from venueops.sources.schema import Reference, Table
from venueops.sources.tables import scan_by_period, typed_scan, update_by_period, write_by_period

APRIL = ("1996-04-01", "1996-04-30")
NOON = "2024-01-15 12:00:00"
AS_OF = "2002-01-01 00:00:30"
WAITING, COOKING, DONE = "В ожидании", "Готовится", "Завершён"

Query = Callable[[SparkSession, str], DataFrame]


def plain(df: DataFrame) -> DataFrame:
    """Results in types both engines hand over alike: decimals as double, times and paths as text."""
    def column(field):
        c = F.col(field.name)
        if isinstance(field.dataType, T.DecimalType):
            c = c.cast("double")
        elif isinstance(field.dataType, (T.TimestampNTZType, T.TimestampType)):
            c = F.date_format(c, "yyyy-MM-dd HH:mm:ss")
        elif isinstance(field.dataType, T.DateType):
            c = c.cast("string")
        elif isinstance(field.dataType, T.ArrayType):
            c = F.array_join(c, routes.ARROW)
        return c.alias(field.name)

    return df.select(*[column(f) for f in df.schema.fields])


# 2.1 reports
def pnl_by_day(v: Venue) -> DataFrame:
    ledger = v.orders.select(
        F.col("created_at").alias("transaction_date"),
        F.col("status_id").alias("transaction_type_id"),
        F.col("to_pay").alias("amount"),
    )
    return reports.pnl_by_day(ledger, v.money_types, *APRIL)


def popular_items(v: Venue) -> DataFrame:
    return reports.popular_items(v.lines, v.orders, v.items, v.order_statuses, *APRIL, excluded=(WAITING,))


def producible_portions(v: Venue) -> DataFrame:
    return reports.producible_portions(v.recipes, v.items, v.stock)


def copurchase_pairs(v: Venue) -> DataFrame:
    return reports.copurchase_pairs(v.lines, v.items, min_support=2)


def free_resources_at(v: Venue) -> DataFrame:
    held = v.bookings.select(F.col("id").alias("order_id"), "table_id")
    opened = v.bookings.select(
        "id", F.col("event_type").alias("status_id"), F.col("start_at").alias("created_at")
    )
    return bookings.free_resources_at(v.rooms, v.bookings, held, opened, v.event_statuses, NOON)


def weekday_profile(v: Venue) -> DataFrame:
    return reports.weekday_profile(v.orders)


def delivered_materials(v: Venue) -> DataFrame:
    supplies = v.orders.select("id", "status_id", F.col("created_at").alias("delivery_date"))
    supply_lines = v.read("lineitem").select(
        F.col("l_orderkey").alias("supplier_order_id"),
        F.col("l_partkey").alias("ingredient_id"),
        F.col("l_returnflag").alias("unit_id"),
        F.col("l_quantity").cast("decimal(10,3)").alias("quantity"),
        money("l_extendedprice").alias("total_cost"),
    )
    return reports.delivered_materials(
        supply_lines, supplies, v.items, v.supply_units, v.supply_statuses, *APRIL
    )


# 2.2 intake and pricing
def _requested(v: Venue) -> DataFrame:
    return v.lines.select("order_id", "menu_item_id", "quantity")


def snapshot_prices(v: Venue) -> DataFrame:
    return baskets.snapshot_prices(_requested(v), v.items)


def rejected_lines(v: Venue) -> DataFrame:
    return baskets.rejected_lines(_requested(v), v.items.filter("is_available"))


def price_baskets(v: Venue) -> DataFrame:
    lines = baskets.snapshot_prices(_requested(v), v.items)
    return baskets.price_baskets(v.orders, lines, v.customers, v.discount_tiers)


def resolve_customers(v: Venue) -> DataFrame:
    key = F.lpad(F.col("o_custkey").cast("string"), 9, "0")
    kind = F.when(F.col("o_orderpriority") == "5-LOW", "Guest#").otherwise("Customer#")
    requests = v.read("orders").select(
        F.col("o_orderkey").alias("request_id"), F.concat(kind, key).alias("customer_phone")
    )
    return baskets.resolve_customers(requests, v.customers)


def split_service_type(v: Venue) -> DataFrame:
    kind = (
        F.when(F.col("payment_type_id").isin("1-URGENT", "3-MEDIUM"), "delivery")
        .when(F.col("payment_type_id").isin("2-HIGH", "4-NOT SPECIFIED"), "dine_in")
        .otherwise("takeaway")
    )
    requests = (
        v.orders.select(F.col("id").alias("order_id"), kind.alias("order_type"))
        .join(v.deliveries.select("order_id", "address", "courier_id"), "order_id", "left")
        .join(v.dine_ins.select("order_id", "table_id", "employee_id"), "order_id", "left")
    )
    return baskets.split_service_type(requests)


def surrogate_keys(v: Venue) -> DataFrame:
    orders = v.orders.select(F.col("id").alias("order_id"), "created_at")
    return keys.surrogate_keys(orders, ["created_at", "order_id"], v.items.select("id"))


# 2.3 life-cycle
def _waiting(v: Venue) -> DataFrame:
    return lifecycle.pick_orders(v.orders, v.order_statuses, WAITING)


def _closed(v: Venue) -> DataFrame:
    return lifecycle.pick_orders(v.orders, v.order_statuses, DONE)


def _waiting_lines(v: Venue) -> DataFrame:
    return receipts.of_orders(v.lines, _waiting(v))


def pick_orders(v: Venue) -> DataFrame:
    picked = lifecycle.pick_orders(v.orders, v.order_statuses, WAITING, 20)
    return picked.select("id", "customer_id", "status_id", "total_cost", "created_at")


def advance_status(v: Venue) -> DataFrame:
    orders = v.orders.select("id", "status_id", "created_at")
    return lifecycle.advance_status(orders, _waiting(v), {"status_id": id_of(v.order_statuses, COOKING)})


def material_consumption(v: Venue) -> DataFrame:
    return lifecycle.material_consumption(_waiting(v), v.lines, v.recipes)


def stock_after_consumption(v: Venue) -> DataFrame:
    return lifecycle.stock_after_consumption(v.stock, material_consumption(v))


def post_sales(v: Venue) -> DataFrame:
    existing = v.items.select("id")
    return lifecycle.post_sales(_closed(v), v.sales_types, v.sales_categories, existing, AS_OF)


def customer_rollup(v: Venue) -> DataFrame:
    rolled = loyalty.customer_rollup(v.customers, _closed(v))
    return rolled.select("id", "total_spent", "total_orders")


def tier_assignment(v: Venue) -> DataFrame:
    rolled = loyalty.customer_rollup(v.customers, _closed(v))
    return loyalty.tier_assignment(rolled, v.spending_tiers).select(
        "id", "total_spent", "total_orders", "last_achieved_tier_id"
    )


def cashback_accrual(v: Venue) -> DataFrame:
    return loyalty.cashback_accrual(_closed(v), v.customers, v.spending_tiers)


# 2.4 reports after a step
def order_report_hall(v: Venue) -> DataFrame:
    return receipts.order_report_hall(
        v.orders, v.order_statuses, v.payment_types, v.dine_ins, v.seats, v.employees, v.customers
    )


def order_report_delivery(v: Venue) -> DataFrame:
    return receipts.order_report_delivery(
        v.orders, v.order_statuses, v.payment_types, v.deliveries, v.delivery_statuses, v.couriers,
        v.companies, v.customers,
    )


def order_lines(v: Venue) -> DataFrame:
    return receipts.order_lines(v.numbered_lines, v.items)


def kitchen_report(v: Venue) -> DataFrame:
    return receipts.kitchen_report(
        _waiting(v), v.order_statuses, v.deliveries, v.dine_ins, v.seats, v.customers, AS_OF
    )


def line_materials_text(v: Venue) -> DataFrame:
    return receipts.line_materials_text(v.lines, v.items, v.recipes, v.ingredients, v.units)


def affected_stock(v: Venue) -> DataFrame:
    return receipts.affected_stock(_waiting_lines(v), v.recipes, v.stock, v.ingredients, v.units)


def fulfilment_report(v: Venue) -> DataFrame:
    return receipts.fulfilment_report(
        v.orders, v.lines, v.order_statuses, v.payment_types, v.deliveries, v.dine_ins, v.seats,
        v.customers, AS_OF,
    )


def prep_minutes(v: Venue) -> DataFrame:
    return receipts.prep_minutes(v.timed_lines, v.items)


def carrier_report(v: Venue) -> DataFrame:
    return receipts.carrier_report(v.deliveries, v.couriers, v.companies, v.delivery_statuses)


def delivery_report(v: Venue) -> DataFrame:
    return receipts.delivery_report(v.deliveries, v.couriers, v.delivery_statuses)


def waiter_report(v: Venue) -> DataFrame:
    return receipts.waiter_report(v.dine_ins, v.employees, v.seats, v.dine_in_statuses)


def payment_report(v: Venue) -> DataFrame:
    return receipts.payment_report(
        v.closed_orders, v.order_statuses, v.payment_types, v.ledger, v.money_types, v.money_categories
    )


def loyalty_report(v: Venue) -> DataFrame:
    return receipts.loyalty_report(
        v.orders, v.customers, v.discount_tiers, v.loyalty_transactions, v.loyalty_types
    )


# 2.5 reservations
def reservation_conflicts(v: Venue) -> DataFrame:
    requests = v.booking_requests.drop("arrival")
    return bookings.reservation_conflicts(requests, v.held_bookings)


def conflict_rows(v: Venue) -> DataFrame:
    requests = v.booking_requests.select("request_id", "table_id", "start_at", "end_at")
    held = v.held_bookings.select("id", "table_id", "start_at", "end_at")
    return bookings.conflict_rows(requests, held).select(
        "request_id", F.col("id").alias("reservation_id"), "table_id", "start_at", "end_at"
    )


def admit_reservations(v: Venue) -> DataFrame:
    decided = bookings.admit_reservations(v.booking_requests, v.held_bookings, v.rooms)
    return decided.select("request_id", "table_id", "accepted")


def reservation_confirmations(v: Venue) -> DataFrame:
    return bookings.reservation_confirmations(v.bookings, v.rooms, v.employees)


# 2.6 routes
def enumerate_routes(v: Venue) -> DataFrame:
    return routes.enumerate_routes(v.cities, v.roads, "depot", "gate")


def route_steps(v: Venue) -> DataFrame:
    return routes.route_steps(enumerate_routes(v), v.cities)


def text_route_steps(v: Venue) -> DataFrame:
    """The texts of all routes, read back."""
    texts = routes.route_texts(enumerate_routes(v), v.cities)
    return routes.text_route_steps(texts, v.cities, v.roads)


def route_step_values(v: Venue) -> DataFrame:
    return routes.route_step_values(enumerate_routes(v), v.cities)


def best_routes(v: Venue) -> DataFrame:
    return routes.best_routes(v.cities, v.roads, "depot", "gate")


# 2.9 load, 2.10 audit
SALES = Table(
    "orders",
    "o_orderkey bigint!; o_custkey bigint; o_totalprice decimal(10,2); o_orderdate timestamp_ntz; "
    "o_orderpriority string; to_pay decimal(10,2); is_open boolean; loaded_at timestamp_ntz; note string",
    defaults={"to_pay": 0, "is_open": True, "loaded_at": "now"},
    primary=("o_orderkey",),
)


def typed_orders(v: Venue) -> DataFrame:
    return typed_scan(v.spark, f"{v.folder}/orders.parquet", SALES, AS_OF)


STORED_ORDERS = Table(
    "orders", "id bigint!; customer_id bigint; status_id string; to_pay decimal(18,2); created_at timestamp_ntz",
    primary=("id",),
)
SPRING = ("1996-03-10", "1996-06-20 12:00:00")


def stored_update(v: Venue) -> DataFrame:
    """Orders stored by month; those that waited in April are cooked, then a spring's orders are read back."""
    path = f"{checkpoint_folder(v.spark)}/{uuid.uuid4().hex}"
    write_by_period(v.orders, path, STORED_ORDERS, "created_at")
    waiting = scan_by_period(v.spark, path, STORED_ORDERS, "created_at", *APRIL).filter("status_id = 'P'")
    patch = waiting.select("id", "created_at", id_of(v.order_statuses, COOKING).alias("status_id"))
    update_by_period(patch, path, STORED_ORDERS, "id", ["status_id"], "created_at")
    return scan_by_period(v.spark, path, STORED_ORDERS, "created_at", *SPRING)


def _audited() -> list[Table]:
    def ref(name, key):
        return Reference(name, key)

    return [
        Table("region", "r_regionkey int!; r_name string!", (("r_name",),), primary=("r_regionkey",)),
        Table(
            "nation", "n_nationkey int!; n_name string!; n_regionkey int!", (("n_name",),),
            {"n_regionkey": ref("region", "r_regionkey")}, primary=("n_nationkey",),
        ),
        Table(
            "customer", "c_custkey bigint!; c_name string!; c_nationkey int!; c_acctbal double!", (("c_name",),),
            {"c_nationkey": ref("nation", "n_nationkey")}, primary=("c_custkey",),
        ),
        Table(
            "supplier", "s_suppkey bigint!; s_name string!; s_nationkey int!", (("s_name",),),
            {"s_nationkey": ref("nation", "n_nationkey")}, primary=("s_suppkey",),
        ),
        Table(
            "part", "p_partkey bigint!; p_name string!; p_retailprice double!", (("p_name",),),
            primary=("p_partkey",),
        ),
        Table(
            "orders", "o_orderkey bigint!; o_custkey bigint!; o_orderdate timestamp_ntz!",
            (("o_custkey", "o_orderdate"),), {"o_custkey": ref("customer", "c_custkey")},
            primary=("o_orderkey",), one_to_one=("o_custkey",),
        ),
        Table(
            "lineitem", "l_orderkey bigint!; l_linenumber int!; l_shipdate timestamp_ntz!", (),
            {
                "l_orderkey": ref("orders", "o_orderkey"),
                "l_partkey": ref("part", "p_partkey"),
                "l_suppkey": ref("supplier", "s_suppkey"),
            },
            primary=("l_orderkey", "l_linenumber"),
        ),
        Table(
            "events", "event_id bigint!; ts timestamp_ntz!; user_id bigint!; value double!", (("user_id", "ts"),),
            {"user_id": ref("supplier", "s_suppkey")}, primary=("event_id",),
        ),
        Table("documents", "doc_id bigint!; text string!; source string!", primary=("doc_id",)),
        Table("embeddings", "vec_id bigint!; embedding array<float>!", primary=("vec_id",)),
        Table("pages", "page_id bigint!; url string!; html string!", (("url",),), primary=("page_id",)),
        Table("benchmark", "item_id bigint!; text string!", primary=("item_id",)),
        Table(
            "labels", "doc_id bigint!; quality int!; toxic int!", (), {"doc_id": ref("documents", "doc_id")},
            primary=("doc_id",), one_to_one=("doc_id",),
        ),
        Table("conversations", "conv_id bigint!; turn bigint!; role string!", primary=("conv_id", "turn")),
    ]


def constraint_audit(v: Venue) -> DataFrame:
    tables = _audited()
    return audit.constraint_audit({t.name: v.read(t.name) for t in tables}, tables)


_ALL = {
    "pnl_by_day": pnl_by_day,
    "popular_items": popular_items,
    "producible_portions": producible_portions,
    "copurchase_pairs": copurchase_pairs,
    "free_resources_at": free_resources_at,
    "weekday_profile": weekday_profile,
    "delivered_materials": delivered_materials,
    "snapshot_prices": snapshot_prices,
    "rejected_lines": rejected_lines,
    "price_baskets": price_baskets,
    "resolve_customers": resolve_customers,
    "split_service_type": split_service_type,
    "surrogate_keys": surrogate_keys,
    "pick_orders": pick_orders,
    "advance_status": advance_status,
    "material_consumption": material_consumption,
    "stock_after_consumption": stock_after_consumption,
    "post_sales": post_sales,
    "customer_rollup": customer_rollup,
    "tier_assignment": tier_assignment,
    "cashback_accrual": cashback_accrual,
    "order_report_hall": order_report_hall,
    "order_report_delivery": order_report_delivery,
    "order_lines": order_lines,
    "kitchen_report": kitchen_report,
    "line_materials_text": line_materials_text,
    "affected_stock": affected_stock,
    "fulfilment_report": fulfilment_report,
    "prep_minutes": prep_minutes,
    "carrier_report": carrier_report,
    "delivery_report": delivery_report,
    "waiter_report": waiter_report,
    "payment_report": payment_report,
    "loyalty_report": loyalty_report,
    "reservation_conflicts": reservation_conflicts,
    "conflict_rows": conflict_rows,
    "admit_reservations": admit_reservations,
    "reservation_confirmations": reservation_confirmations,
    "enumerate_routes": enumerate_routes,
    "route_steps": route_steps,
    "text_route_steps": text_route_steps,
    "route_step_values": route_step_values,
    "best_routes": best_routes,
    "typed_scan": typed_orders,
    "constraint_audit": constraint_audit,
    "stored_update": stored_update,
    "place_orders": day.place_orders,
    "cook_orders": day.cook_orders,
    "complete_orders": day.complete_orders,
    "close_orders": day.close_orders,
    "book_tables": day.book_tables,
}


def _bound(query: Callable[[Venue], DataFrame]) -> Query:
    return lambda spark, sf_dir: plain(query(Venue(spark, sf_dir)))


def queries() -> dict[str, Query]:
    return {name: _bound(query) for name, query in _ALL.items()}
