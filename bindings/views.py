"""The test tables seen as a venue's tables: column names and types the operators expect."""

from __future__ import annotations

from functools import cached_property

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from venueops.functions.columns import money, span_end
from venueops.plans.session import tuned


class Venue:
    def __init__(self, spark: SparkSession, folder: str):
        self.spark = tuned(spark)
        self.folder = folder

    def read(self, name: str) -> DataFrame:
        return self.spark.read.parquet(f"{self.folder}/{name}.parquet")

    def lookup(self, values: str, columns: str = "id, name") -> DataFrame:
        """A small fixed table; written in SQL, Spark knows its size and broadcasts it by itself."""
        return self.spark.sql(f"SELECT * FROM VALUES {values} AS t({columns})")

    # lookups
    @cached_property
    def order_statuses(self):
        return self.lookup("('F','Завершён'),('O','Готовится'),('P','В ожидании')")

    @cached_property
    def money_types(self):
        return self.lookup("('F','Доход'),('O','Расход'),('P','Прочее')")

    @cached_property
    def supply_statuses(self):
        return self.lookup("('F','Доставлено'),('O','В пути'),('P','Заказано')")

    @cached_property
    def payment_types(self):
        return self.lookup(
            "('1-URGENT','Наличные'),('2-HIGH','Банковская карта'),('3-MEDIUM','QR код'),"
            "('4-NOT SPECIFIED','Счёт'),('5-LOW','Купон')"
        )

    @cached_property
    def delivery_statuses(self):
        return self.lookup("('F','Доставлен'),('O','Собирается')")

    @cached_property
    def dine_in_statuses(self):
        return self.lookup("('F','Подано'),('O','Ожидание')")

    @cached_property
    def units(self):
        return self.lookup("('pc','шт'),('kg','кг'),('g','г')")

    @cached_property
    def supply_units(self):
        return self.lookup("('A','кг'),('N','г'),('R','шт')")

    @cached_property
    def event_statuses(self):
        return self.lookup(
            "('error','Готовится'),('click','Подан'),('purchase','В ожидании'),"
            "('signup','Завершён'),('view','Отменён')"
        )

    @cached_property
    def sales_types(self):
        return self.lookup("(1,'Доход'),(2,'Расход')")

    @cached_property
    def sales_categories(self):
        return self.lookup("(1,'Продажи'),(2,'Прочее')")

    @cached_property
    def money_categories(self):
        return self.lookup("('F','Продажи'),('O','Прочее')")

    @cached_property
    def loyalty_types(self):
        return self.lookup("(1,'Начисление'),(2,'Списание')")

    @cached_property
    def discount_tiers(self):
        return self.lookup(
            "(1,'one',0.00,0.00,5.00),(2,'two',2500.00,5.00,5.00),"
            "(3,'three',5000.00,10.00,10.00),(4,'four',7500.00,15.00,15.00)",
            "id, name, min_spent, discount_percent, cashback_percent",
        )

    @cached_property
    def spending_tiers(self):
        return self.lookup(
            "(1,'one',0.00,0.00,5.00),(2,'two',1000000.00,5.00,5.00),"
            "(3,'three',2500000.00,10.00,10.00),(4,'four',4000000.00,15.00,15.00)",
            "id, name, min_spent, discount_percent, cashback_percent",
        )

    # orders and what belongs to them
    @cached_property
    def orders(self):
        """Orders; those of the lowest priority are placed by guests."""
        return self.read("orders").select(
            F.col("o_orderkey").alias("id"),
            F.when(F.col("o_orderpriority") != "5-LOW", F.col("o_custkey")).alias("customer_id"),
            F.col("o_orderstatus").alias("status_id"),
            F.col("o_orderpriority").alias("payment_type_id"),
            money("o_totalprice").alias("total_cost"),
            money("o_totalprice").alias("to_pay"),
            F.col("o_orderpriority").alias("comment"),
            F.col("o_orderdate").alias("created_at"),
        )

    @cached_property
    def lines(self):
        return self.read("lineitem").select(
            (F.col("l_orderkey") * 1000 + F.col("l_linenumber")).alias("id"),
            F.col("l_orderkey").alias("order_id"),
            F.col("l_partkey").alias("menu_item_id"),
            money("l_extendedprice").alias("item_cost"),
            F.col("l_quantity").cast("int").alias("quantity"),
            F.when(F.col("l_linestatus") == "F", F.col("l_shipdate")).alias("cooked_at"),
        )

    @cached_property
    def numbered_lines(self):
        return self.read("lineitem").select(
            (F.col("l_orderkey") * 1000 + F.col("l_linenumber")).alias("id"),
            F.col("l_orderkey").alias("order_id"),
            F.col("l_partkey").alias("menu_item_id"),
            money("l_extendedprice").alias("item_cost"),
            F.col("l_quantity").cast("int").alias("quantity"),
            F.col("l_shipdate").alias("created_at"),
        )

    @cached_property
    def timed_lines(self):
        ordered = self.orders.select(F.col("id").alias("order_id"), "created_at")
        return self.lines.join(ordered, "order_id")

    @cached_property
    def closed_orders(self):
        last = self.read("lineitem").groupBy(F.col("l_orderkey").alias("id")).agg(
            F.max("l_shipdate").alias("closed_at")
        )
        paid = F.when(F.col("status_id") != "P", F.col("id")).alias("financial_transaction_id")
        return self.orders.join(last, "id", "left").select("*", paid)

    @cached_property
    def ledger(self):
        return self.orders.filter("status_id <> 'P'").select(
            "id",
            F.col("status_id").alias("transaction_type_id"),
            F.col("to_pay").alias("amount"),
            F.col("status_id").alias("category_id"),
        )

    @cached_property
    def loyalty_transactions(self):
        kind = F.when(F.col("status_id") == "F", 1).when(F.col("status_id") == "O", 2)
        share = F.col("total_cost") * F.lit("0.05").cast("decimal(3,2)")
        return self.orders.filter("customer_id IS NOT NULL").select(
            F.col("id").alias("order_id"),
            kind.alias("transaction_type_id"),
            F.round(share, 2).alias("points_amount"),
            F.concat(F.lit("order "), F.col("id").cast("string")).alias("description"),
        )

    def _service(self, flag: str, *columns: Column) -> DataFrame:
        return (
            self.read("lineitem")
            .filter(F.col("l_returnflag") == flag)
            .groupBy(F.col("l_orderkey").alias("order_id"))
            .agg(*columns)
            .withColumn("id", F.col("order_id"))
        )

    @cached_property
    def deliveries(self):
        return self._service(
            "R",
            F.min("l_suppkey").alias("courier_id"),
            F.min("l_linestatus").alias("delivery_status_id"),
        ).withColumn("address", F.concat(F.lit("ул. "), F.col("order_id").cast("string")))

    @cached_property
    def dine_ins(self):
        return self._service(
            "A",
            F.min("l_suppkey").alias("employee_id"),
            F.min("l_partkey").alias("table_id"),
            F.max("l_linestatus").alias("status_id"),
        )

    # menu, recipes, stock
    @cached_property
    def items(self):
        return self.read("part").select(
            F.col("p_partkey").alias("id"),
            F.col("p_name").alias("name"),
            money("p_retailprice").alias("price"),
            (F.col("p_type") != "ECONOMY").alias("is_available"),
        )

    @cached_property
    def recipes(self):
        """Two rows per dish: the part itself and some of its brand; SMALL dishes have no recipe."""
        def row(offset, ingredient, unit, quantity):
            return F.struct(
                (F.col("p_partkey") * 2 + offset).alias("id"),
                ingredient.alias("ingredient_id"),
                F.lit(unit).alias("unit_id"),
                quantity.cast("decimal(10,3)").alias("quantity"),
            )

        both = F.array(
            row(0, _part_id(), "pc", F.lit(1)),
            row(1, F.col("p_brand"), "kg", F.col("p_size") * F.lit("0.010").cast("decimal(4,3)")),
        )
        return (
            self.read("part")
            .filter("p_type <> 'SMALL'")
            .select(F.col("p_partkey").alias("menu_item_id"), F.explode(both).alias("r"))
            .select("menu_item_id", "r.*")
        )

    @cached_property
    def ingredients(self):
        part = self.read("part")
        brands = part.select(F.col("p_brand").alias("id"), F.col("p_brand").alias("name")).distinct()
        return part.select(_part_id().alias("id"), F.col("p_name").alias("name")).unionByName(brands)

    @cached_property
    def stock(self):
        """Parts by piece (PROMO parts by gram, so that their unit misses the recipe's), brands by kilo."""
        part = self.read("part")
        brands = part.groupBy(F.col("p_brand").alias("ingredient_id")).agg(
            F.lit("kg").alias("unit_id"),
            (F.sum("p_size") * F.lit("0.500").cast("decimal(4,3)")).cast("decimal(18,3)").alias("quantity"),
        )
        return part.select(
            _part_id().alias("ingredient_id"),
            F.when(F.col("p_type") == "PROMO", "g").otherwise("pc").alias("unit_id"),
            (F.col("p_size") * 10).cast("decimal(18,3)").alias("quantity"),
        ).unionByName(brands)

    # people and places
    @cached_property
    def customers(self):
        tier = F.expr(
            "CASE WHEN c_acctbal >= 7500 THEN 4 WHEN c_acctbal >= 5000 THEN 3 "
            "WHEN c_acctbal >= 2500 THEN 2 WHEN c_acctbal >= 0 THEN 1 END"
        )
        return self.read("customer").select(
            F.col("c_custkey").alias("id"),
            F.col("c_name").alias("phone"),
            F.col("c_name").alias("first_name"),
            F.col("c_mktsegment").alias("last_name"),
            money("c_acctbal").alias("total_spent"),
            F.lit(0).cast("bigint").alias("total_orders"),
            tier.alias("last_achieved_tier_id"),
        )

    @cached_property
    def employees(self):
        nation = self.read("nation").select(F.col("n_nationkey").alias("s_nationkey"), "n_name", "n_regionkey")
        return (
            self.read("supplier")
            .join(nation, "s_nationkey")
            .select(
                F.col("s_suppkey").alias("id"),
                F.col("s_name").alias("first_name"),
                F.col("n_name").alias("last_name"),
                F.col("s_name").alias("phone"),
                F.when(F.col("n_name") != "NATION_0", F.col("n_regionkey")).alias("company_id"),
            )
        )

    @property
    def couriers(self):
        return self.employees

    @cached_property
    def companies(self):
        return self.read("region").select(F.col("r_regionkey").alias("id"), F.col("r_name").alias("name"))

    @cached_property
    def seats(self):
        """Parts as the tables of the hall."""
        return self.read("part").select(
            F.col("p_partkey").alias("id"),
            F.col("p_partkey").alias("number"),
            F.col("p_size").alias("capacity"),
            F.col("p_brand").alias("location"),
            (F.col("p_type") != "ECONOMY").alias("is_available"),
        )

    @cached_property
    def rooms(self):
        """Customers as bookable tables; events book them by user id."""
        return self.read("customer").select(
            F.col("c_custkey").alias("id"),
            F.col("c_custkey").alias("number"),
            F.col("c_nationkey").alias("capacity"),
            F.col("c_mktsegment").alias("location"),
            (F.col("c_mktsegment") != "HOUSEHOLD").alias("is_available"),
        )

    @cached_property
    def bookings(self):
        """Events as reservations of ``value`` minutes."""
        return self.read("events").select(
            F.col("event_id").alias("id"),
            F.col("user_id").alias("table_id"),
            F.col("ts").alias("start_at"),
            span_end(F.col("ts"), F.col("value")).alias("end_at"),
            F.concat(F.lit("user "), F.col("user_id").cast("string")).alias("customer_phone"),
            F.get_json_object("props", "$.k").cast("bigint").alias("created_by_employee_id"),
            "event_type",
            (-F.col("value")).alias("arrival"),
        )

    @property
    def held_bookings(self):
        return self.bookings.filter("event_type = 'purchase'").select("id", "table_id", "start_at", "end_at")

    @property
    def booking_requests(self):
        return self.bookings.filter("event_type <> 'purchase'").select(
            F.col("id").alias("request_id"), "table_id", "start_at", "end_at", "arrival"
        )

    # road network: depot -> ring of regions -> nations -> customers -> order queues -> gate
    @cached_property
    def cities(self):
        def city(df, key, name, rubies, emeralds, sapphires):
            return df.select(
                key.alias("id"),
                name.alias("name"),
                rubies.cast("int").alias("rubies"),
                emeralds.cast("int").alias("emeralds"),
                sapphires.cast("int").alias("sapphires"),
            )

        r, n, c = F.col("r_regionkey"), F.col("n_nationkey"), F.col("c_custkey")
        worth = F.floor(F.abs(money("c_acctbal")))
        queue = self.read("orders").select("o_orderpriority").distinct()
        size = F.length("o_orderpriority")
        parts = [
            city(
                self.read("region"), F.concat(F.lit("region "), r.cast("string")), F.col("r_name"),
                10 + 7 * r, 40 - 5 * r, 20 + 3 * r,
            ),
            city(
                self.read("nation"), F.concat(F.lit("nation "), n.cast("string")), F.col("n_name"),
                60 + 17 * n % 41, 55 + 29 * n % 37, 37 * n % 50,
            ),
            city(
                self.read("customer"), F.concat(F.lit("customer "), c.cast("string")), F.col("c_name"),
                worth % 97, F.floor(worth / 10) % 89, 31 * c % 83,
            ),
            city(
                queue, F.concat(F.lit("queue "), F.col("o_orderpriority")), F.col("o_orderpriority"),
                size * 5, size * 4, size * 3,
            ),
        ]
        cities = self.lookup(
            "('depot','Depot',15,25,43),('gate','Gate',20,30,25)", "id, name, rubies, emeralds, sapphires"
        )
        for part in parts:
            cities = cities.unionByName(part)
        return cities

    @cached_property
    def roads(self):
        def key(kind, column):
            return F.concat(F.lit(f"{kind} "), F.col(column).cast("string"))

        def road(df, source, target):
            return df.select(source.alias("from_city_id"), target.alias("to_city_id"))

        region, nation, customer = self.read("region"), self.read("nation"), self.read("customer")
        served = self.read("orders").select("o_custkey", "o_orderpriority").distinct()
        queues = served.select("o_orderpriority").distinct()
        ring = F.concat(F.lit("region "), ((F.col("r_regionkey") + 1) % 5).cast("string"))
        of_region, of_nation = key("region", "n_regionkey"), key("nation", "c_nationkey")
        parts = [
            road(region, F.lit("depot"), key("region", "r_regionkey")),
            road(region, key("region", "r_regionkey"), ring),
            road(nation, of_region, key("nation", "n_nationkey")),
            road(nation, key("nation", "n_nationkey"), of_region),
            road(customer, of_nation, key("customer", "c_custkey")),
            road(customer, key("customer", "c_custkey"), of_nation),
            road(served, key("customer", "o_custkey"), key("queue", "o_orderpriority")),
            road(queues, key("queue", "o_orderpriority"), F.lit("gate")),
        ]
        roads = parts[0]
        for part in parts[1:]:
            roads = roads.unionByName(part)
        return roads


def _part_id() -> Column:
    return F.concat(F.lit("part "), F.col("p_partkey").cast("string"))
