"""Checks Spark does not make on write: keys, mandatory columns, references, relations of one to one."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from venueops.sources.schema import Table

RESULT = ["table_name", "rule", "columns", "violations"]


def constraint_audit(frames: dict[str, DataFrame], tables: list[Table]) -> DataFrame:
    """One row per rule of the tables given, with the number of rows that break it.

    unique, one_to_one: rows beyond the first of their key, keys with a NULL aside. not_null: rows with a NULL.
    foreign: rows whose reference is not NULL and leads nowhere.

    Every table is scanned once and everything is shuffled once. A row becomes one (space, key) for each rule, a
    reference in the space of the key it leads to, so that the rows of a key and those that refer to it meet in one
    group. They are counted before the shuffle, so a much used key is one row of each task.
    """
    spaces: dict[tuple, int] = {}
    keys: dict[str, dict[int, dict[int, Column]]] = {}  # table -> space -> slot -> key
    slots: dict[int, int] = {}  # references into a space so far; slot 0 is for the key's own rows
    checks: list[tuple[str, str, str, int, int]] = []

    def space_of(name: str, columns: tuple[str, ...]) -> int:
        space = spaces.setdefault((name, columns), len(spaces))
        keys.setdefault(name, {}).setdefault(space, {}).setdefault(0, _key(frames[name], columns))
        return space

    for table in tables:
        for rule, many in (("unique", table.unique_keys), ("one_to_one", [(c,) for c in table.one_to_one])):
            checks += [(table.name, rule, ",".join(key), space_of(table.name, key), 0) for key in many]
        for column in table.not_null:
            space = spaces.setdefault((table.name, column, "null"), len(spaces))
            missing = F.when(F.col(column).isNull(), F.array().cast("array<string>"))
            keys.setdefault(table.name, {})[space] = {0: missing}
            checks.append((table.name, "not_null", column, space, 0))
        for column, parent in table.foreign.items():
            space = space_of(parent.name, (parent.key,))
            slot = slots[space] = slots.get(space, 0) + 1
            keys.setdefault(table.name, {}).setdefault(space, {})[slot] = _key(frames[table.name], (column,))
            checks.append((table.name, "foreign", column, space, slot))

    found = reduce(DataFrame.unionByName, [_expanded(frames[name], held) for name, held in keys.items()])
    width = max(slots.values(), default=0)
    counts = found.groupBy("space", "key").agg(*[F.count_if(F.col("slot") == i).alias(f"n{i}") for i in range(width + 1)])
    lost = [F.sum(F.when(F.col("n0") == 0, F.col(f"n{i}"))) for i in range(1, width + 1)]
    sums = counts.groupBy("space").agg(
        F.sum("n0").alias("rows"), F.sum(F.greatest(F.col("n0") - 1, F.lit(0))).alias("more"), F.array(F.lit(None), *lost).alias("lost")
    )
    rules = found.sparkSession.range(1).select(F.inline(F.array(*[_literal(check) for check in checks])))
    violations = (
        F.when(F.col("rule") == "not_null", F.col("rows"))
        .when(F.col("rule") == "foreign", F.col("lost")[F.col("slot")])
        .otherwise(F.col("more"))
    )
    return rules.join(sums, "space", "left").select(
        "table_name", "rule", "columns", F.coalesce(violations, F.lit(0)).cast("bigint").alias("violations")
    )


def _literal(check: tuple[str, str, str, int, int]) -> Column:
    names = ["table_name", "rule", "columns", "space", "slot"]
    return F.struct(*[F.lit(value).alias(name) for name, value in zip(names, check, strict=True)])


def _expanded(frame: DataFrame, held: dict[int, dict[int, Column]]) -> DataFrame:
    """``space, slot, key``: a row for each rule that a row of the table takes part in."""
    parts = [
        F.struct(F.lit(space).alias("space"), F.lit(slot).alias("slot"), key.alias("key"))
        for space, of_slot in held.items()
        for slot, key in of_slot.items()
    ]
    return frame.select(F.inline(F.array(*parts))).filter("key is not null")


def _key(frame: DataFrame, columns: tuple[str, ...]) -> Column:
    """The values of a key as text, NULL if one of them is."""
    whole = reduce(Column.__and__, [F.col(c).isNotNull() for c in columns])
    return F.when(whole, F.array(*[_text(frame.schema[c]) for c in columns]))


def _text(field: T.StructField) -> Column:
    """Equal values give equal texts, and only those; whole numbers of any type agree."""
    value = F.col(field.name)
    if isinstance(field.dataType, T.FractionalType) and not isinstance(field.dataType, T.DecimalType):
        value = value + F.lit(0.0)  # the two zeros are equal
    if isinstance(field.dataType, (T.ArrayType, T.MapType, T.StructType)):
        return F.to_json(F.struct(value))
    return value.cast("string")
