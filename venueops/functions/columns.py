"""Column expressions shared by the operators."""

from __future__ import annotations

from datetime import date, datetime

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

Moment = str | date | datetime


def moment(value: Moment) -> Column:
    """A timestamp literal without time zone."""
    return F.lit(str(value)).cast("timestamp_ntz")


def in_period(column: str, start: Moment, end: Moment) -> Column:
    """``start <= column < end``; half-open, so the end is not part of the period.

    The column is left bare so that both bounds reach the scan as pushed filters.
    """
    return (F.col(column) >= moment(start)) & (F.col(column) < moment(end))


def money(column: str | Column, digits: int = 18) -> Column:
    column = F.col(column) if isinstance(column, str) else column
    return column.cast(f"decimal({digits},2)")


def span_end(start: Column, minutes: Column) -> Column:
    """``start`` plus a number of minutes; fractions count to the whole second."""
    seconds = F.round(minutes.cast("double") * 60)
    zero = F.lit(0)
    return start + F.make_dt_interval(zero, zero, zero, seconds)


def minutes_between(start: Column, end: Column) -> Column:
    """Whole minutes from start to end, half a minute rounded away from zero; NULL if either is."""
    gap = end - start
    unit_seconds = {"DAY": 86400, "HOUR": 3600, "MINUTE": 60, "SECOND": 1}
    seconds = sum(
        (F.extract(F.lit(unit), gap).cast("decimal(18,6)") * width for unit, width in unit_seconds.items()),
        F.lit(0),
    )
    return F.round(seconds / 60).cast("bigint")


def full_name(first: str = "first_name", last: str = "last_name") -> Column:
    return F.concat(F.col(first), F.lit(" "), F.col(last))


def id_of(lookup: DataFrame, name: str) -> Column:
    """The id a lookup table gives to a name, as an uncorrelated scalar subquery (NULL if unknown)."""
    return lookup.filter(F.col("name") == name).select("id").scalar()


def keyed(dim: DataFrame, key: str, **columns: str | Column) -> DataFrame:
    """A dimension reduced to ``key`` (its id) and the named columns, ready to be joined on ``key``."""
    picked = [(F.col(c) if isinstance(c, str) else c).alias(n) for n, c in columns.items()]
    return dim.select(F.col("id").alias(key), *picked)
