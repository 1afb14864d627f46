"""Declared tables: the restaurant's 39 and the two of the road network.

Fixed values: table and column names, types, defaults, keys and references have to be these.
Columns are written ``name type``; a ``!`` after the type means NOT NULL. Every restaurant table
starts with ``id int!``. Times of day are ``HH:mm:ss`` strings. ``price_per_unit`` has four digits
because prices below a hundredth occur.
"""

from __future__ import annotations

from dataclasses import dataclass, field

from pyspark.sql import types as T

NOW = "now"  # a default that is the time of loading


@dataclass(frozen=True)
class Reference:
    name: str
    key: str = "id"


@dataclass(frozen=True)
class Table:
    name: str
    columns: str
    unique: tuple[tuple[str, ...], ...] = ()
    foreign: dict[str, Reference] = field(default_factory=dict)
    defaults: dict[str, object] = field(default_factory=dict)
    primary: tuple[str, ...] = ("id",)
    one_to_one: tuple[str, ...] = ()  # references that at most one row may hold, though no key says so

    @property
    def fields(self) -> list[tuple[str, str, bool]]:
        """(name, Spark type, mandatory) of each column."""
        parts = [c.strip().split(" ", 1) for c in self.columns.split(";") if c.strip()]
        return [(name, kind.rstrip("!"), kind.endswith("!")) for name, kind in parts]

    @property
    def schema(self) -> T.StructType:
        return T.StructType([T.StructField(n, T.DataType.fromDDL(k), not m) for n, k, m in self.fields])

    @property
    def not_null(self) -> list[str]:
        return [name for name, _, mandatory in self.fields if mandatory]

    @property
    def unique_keys(self) -> list[tuple[str, ...]]:
        return [self.primary, *self.unique]


def _table(name, columns, unique="", foreign=None, defaults=None, one_to_one=()) -> Table:
    return Table(
        name,
        "id int!; " + columns,
        tuple(tuple(key.split("+")) for key in unique.split()),
        {column: Reference(parent) for column, parent in (foreign or {}).items()},
        defaults or {},
        one_to_one=one_to_one,
    )


_NAMED = [
    "OrderStatuses",
    "DineInStatuses",
    "SupplyStatuses",
    "DeliveryStatuses",
    "LoyaltyTransactionTypes",
    "Units",
    "IngredientOperationTypes",
    "FinancialTransactionTypes",
    "FinancialTransactionsCategories",
]

RESTAURANT: dict[str, Table] = {
    table.name: table
    for table in [
        *[_table(name, "name string!", "name") for name in _NAMED],
        _table("Roles", "name string!; hourly_rate decimal(10,2)", "name"),
        _table("MenuCategories", "name string!; is_active boolean", "name", defaults={"is_active": True}),
        _table("Shifts", "name string!; start_time string!; end_time string!", "name"),
        _table("PaymentTypes", "name string!; is_active boolean", "name", defaults={"is_active": True}),
        _table(
            "LoyaltyTiers",
            "name string!; min_spent decimal(10,2)!; discount_percent decimal(5,2); "
            "cashback_percent decimal(5,2)",
            "name",
            defaults={"discount_percent": 0, "cashback_percent": 0},
        ),
        _table(
            "FinancialTransactions",
            "transaction_type_id int!; amount decimal(10,2)!; transaction_date timestamp_ntz; "
            "description string; category_id int",
            foreign={
                "transaction_type_id": "FinancialTransactionTypes",
                "category_id": "FinancialTransactionsCategories",
            },
            defaults={"transaction_date": NOW},
        ),
        _table(
            "Employees",
            "role_id int!; first_name string!; last_name string!; phone string; email string; "
            "hire_date date!; is_active boolean",
            "phone email",
            {"role_id": "Roles"},
            {"is_active": True},
        ),
        _table(
            "MenuItems",
            "category_id int!; name string!; description string; price decimal(10,2)!; calories int; "
            "is_available boolean",
            "name",
            {"category_id": "MenuCategories"},
            {"is_available": True},
        ),
        _table("Ingredients", "name string!", "name"),
        _table(
            "IngredientInventory",
            "ingredient_id int!; unit_id int!; quantity decimal(10,3)",
            "ingredient_id",
            {"ingredient_id": "Ingredients", "unit_id": "Units"},
            {"quantity": 0},
        ),
        _table(
            "RecipeItems",
            "menu_item_id int!; ingredient_id int!; unit_id int!; quantity decimal(10,3)!",
            "menu_item_id+ingredient_id",
            {"menu_item_id": "MenuItems", "ingredient_id": "Ingredients", "unit_id": "Units"},
        ),
        _table(
            "Tables",
            "number int!; capacity int!; location string; is_available boolean",
            "number",
            defaults={"is_available": True},
        ),
        _table(
            "TableReservations",
            "table_id int!; customer_phone string; reservation_date date!; reservation_time string!; "
            "duration_minutes int; created_by_employee_id int!",
            foreign={"table_id": "Tables", "created_by_employee_id": "Employees"},
            defaults={"duration_minutes": 120},
        ),
        _table(
            "Customers",
            "phone string!; first_name string; last_name string; email string; birth_date date; "
            "registration_date timestamp_ntz; is_active boolean; total_spent decimal(10,2); "
            "total_orders int; last_achieved_tier_id int",
            "phone",
            {"last_achieved_tier_id": "LoyaltyTiers"},
            {"registration_date": NOW, "is_active": True, "total_spent": 0, "total_orders": 0},
        ),
        _table(
            "Orders",
            "customer_id int; status_id int!; payment_type_id int!; total_cost decimal(10,2); "
            "to_pay decimal(10,2); comment string; created_at timestamp_ntz; closed_at timestamp_ntz; "
            "financial_transaction_id int",
            foreign={
                "status_id": "OrderStatuses",
                "payment_type_id": "PaymentTypes",
                "customer_id": "Customers",
                "financial_transaction_id": "FinancialTransactions",
            },
            defaults={"total_cost": 0, "to_pay": 0, "created_at": NOW},
        ),
        _table("CourierCompanies", "name string!"),
        _table(
            "Couriers",
            "first_name string!; last_name string!; phone string; is_free boolean; company_id int",
            "phone",
            {"company_id": "CourierCompanies"},
            {"is_free": True},
        ),
        _table(
            "Deliveries",
            "order_id int!; address string!; courier_id int!; delivery_status_id int!",
            foreign={
                "order_id": "Orders",
                "courier_id": "Couriers",
                "delivery_status_id": "DeliveryStatuses",
            },
            one_to_one=("order_id",),
        ),
        _table(
            "DineIns",
            "order_id int!; table_id int!; employee_id int!; status_id int!",
            foreign={
                "order_id": "Orders",
                "table_id": "Tables",
                "employee_id": "Employees",
                "status_id": "DineInStatuses",
            },
            one_to_one=("order_id",),
        ),
        _table(
            "OrderItems",
            "order_id int!; menu_item_id int!; item_cost decimal(10,2); quantity int!; "
            "created_at timestamp_ntz; cooked_at timestamp_ntz",
            foreign={"order_id": "Orders", "menu_item_id": "MenuItems"},
            defaults={"item_cost": 0, "created_at": NOW},
        ),
        _table(
            "Suppliers",
            "name string!; phone string; email string; address string; is_active boolean",
            "name",
            defaults={"is_active": True},
        ),
        _table(
            "SupplierPrices",
            "supplier_id int!; ingredient_id int!; unit_id int!; price_per_unit decimal(12,4)!",
            "supplier_id+ingredient_id",
            {"supplier_id": "Suppliers", "ingredient_id": "Ingredients", "unit_id": "Units"},
        ),
        _table(
            "SupplierOrders",
            "supplier_id int!; employee_id int!; order_date timestamp_ntz; delivery_date timestamp_ntz; "
            "status_id int!; total_cost decimal(10,2); financial_transaction_id int",
            foreign={
                "supplier_id": "Suppliers",
                "employee_id": "Employees",
                "status_id": "SupplyStatuses",
                "financial_transaction_id": "FinancialTransactions",
            },
            defaults={"order_date": NOW, "total_cost": 0},
        ),
        _table(
            "SupplierOrderItems",
            "supplier_order_id int!; ingredient_id int!; unit_id int!; quantity decimal(10,3)!; "
            "price_per_unit decimal(12,4)!; total_cost decimal(10,2)!",
            foreign={
                "supplier_order_id": "SupplierOrders",
                "ingredient_id": "Ingredients",
                "unit_id": "Units",
            },
        ),
        _table(
            "IngredientOperations",
            "employee_id int!; created_at timestamp_ntz",
            foreign={"employee_id": "Employees"},
            defaults={"created_at": NOW},
        ),
        _table(
            "IngredientOperationItems",
            "operation_id int!; ingredient_id int!; operation_type_id int!; unit_id int!; "
            "amount decimal(10,3)",
            foreign={
                "operation_id": "IngredientOperations",
                "ingredient_id": "Ingredients",
                "operation_type_id": "IngredientOperationTypes",
                "unit_id": "Units",
            },
            defaults={"amount": 0},
        ),
        _table(
            "EmployeeSchedules",
            "employee_id int!; shift_id int!; work_date date!; is_working boolean",
            "employee_id+work_date",
            {"employee_id": "Employees", "shift_id": "Shifts"},
            {"is_working": True},
        ),
        _table(
            "TimeTrackers",
            "employee_id int!; check_in timestamp_ntz!; check_out timestamp_ntz",
            foreign={"employee_id": "Employees"},
        ),
        _table(
            "LoyaltyTransactions",
            "customer_id int!; order_id int; points_amount decimal(10,2)!; transaction_type_id int!; "
            "description string; created_at timestamp_ntz",
            foreign={
                "customer_id": "Customers",
                "order_id": "Orders",
                "transaction_type_id": "LoyaltyTransactionTypes",
            },
            defaults={"created_at": NOW},
        ),
        _table(
            "Salaries",
            "employee_id int!; period_start date!; period_end date!; base_salary decimal(10,2)!; "
            "bonuses decimal(10,2); deductions decimal(10,2); total_paid decimal(10,2)!; "
            "total_hours int!; payment_date date; is_paid boolean; financial_transaction_id int",
            foreign={"employee_id": "Employees", "financial_transaction_id": "FinancialTransactions"},
            defaults={"bonuses": 0, "deductions": 0, "is_paid": False},
        ),
    ]
}

NETWORK: dict[str, Table] = {
    "Cities": _table("Cities", "name string!; rubies int!; emeralds int!; sapphires int!"),
    "Roads": Table(
        "Roads",
        "from_city_id int; to_city_id int",
        foreign={"from_city_id": Reference("Cities"), "to_city_id": Reference("Cities")},
        primary=("from_city_id", "to_city_id"),
    ),
}
