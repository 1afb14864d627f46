"""Reading tables with their declared schema, and writing new versions of them."""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from venueops.functions.columns import Moment, in_period, moment
from venueops.operators.keys import overlay
from venueops.sources.schema import NOW, Table

PERIOD = "_period"  # the partition column of tables stored by period: first day of the row's day, month or year


def typed(df: DataFrame, table: Table, as_of: Moment | None = None) -> DataFrame:
    """``df`` with exactly the declared columns: cast if there, else the declared default or NULL.

    ``as_of`` stands for the time of loading in defaults. A NULL that is there stays NULL.
    """
    present = set(df.columns)

    def column(name: str, kind: str) -> Column:
        if name in present:
            return F.col(name).cast(kind).alias(name)
        default = table.defaults.get(name)
        if default == NOW:
            if as_of is None:
                raise ValueError(f"{table.name}.{name} defaults to the time of loading: give as_of")
            return moment(as_of).alias(name)
        return F.lit(default).cast(kind).alias(name)

    return df.select(*[column(name, kind) for name, kind, _ in table.fields])


def typed_scan(spark: SparkSession, path: str, table: Table, as_of: Moment | None = None) -> DataFrame:
    """A Parquet table as declared; the casts leave column pruning to the scan."""
    return typed(spark.read.parquet(path), table, as_of)


def literal_rows(spark: SparkSession, table: Table, rows: Iterable[tuple], columns: str, as_of=None) -> DataFrame:
    """Rows written out by hand, numbered 1..n in the order given; ``columns`` names their values."""
    given = columns.split()
    kinds = {name: kind for name, kind, _ in table.fields}
    numbered = "id" not in given and "id" in kinds
    values = [(*((i,) if numbered else ()), *(None if v is None else str(v) for v in row))
              for i, row in enumerate(rows, 1)]
    names = (["id"] if numbered else []) + given
    ddl = ", ".join(f"{n} {'int' if numbered and n == 'id' else 'string'}" for n in names)
    return typed(spark.createDataFrame(values, ddl), table, as_of)


def stored_scan(spark: SparkSession, path: str, table: Table) -> DataFrame:
    """A table that the writers below wrote: its schema is declared, never inferred."""
    columns = ", ".join(f"`{name}` {kind}" for name, kind, _ in table.fields)
    return spark.read.schema(columns).parquet(path).select(*[name for name, _, _ in table.fields])


def append_rows(df: DataFrame, path: str, table: Table, as_of: Moment | None = None) -> None:
    """Appends ``df`` in the declared types, so that all files of the table agree."""
    typed(df, table, as_of).write.mode("append").parquet(path)


def write_version(
    df: DataFrame, root: str, version: str, table: Table, partition_by: tuple[str, ...] = (), as_of: Moment | None = None
) -> str:
    """Writes ``df`` in the declared types as a new version beside the older ones and returns its path.

    A version that exists is never written over, so a failed run leaves the older ones as they are.
    """
    path = f"{root}/{version}"
    typed(df, table, as_of).write.mode("errorifexists").partitionBy(*partition_by).parquet(path)
    return path


def write_by_period(
    df: DataFrame, path: str, table: Table, column: str, grain: str = "month", as_of: Moment | None = None
) -> None:
    """Writes ``df`` in the declared types, partitioned by the day, month or year of its timestamp ``column``.

    Rows without a timestamp have a partition of their own. Rows are dealt by period first, so that a period has few
    files; a period with a large share of the rows is cut into several.
    """
    dealt = typed(df, table, as_of).withColumn(PERIOD, _period(column, grain)).hint("rebalance", PERIOD)
    dealt.write.mode("errorifexists").partitionBy(PERIOD).parquet(path)


def scan_by_period(
    spark: SparkSession, path: str, table: Table, column: str, start: Moment, end: Moment, grain: str = "month"
) -> DataFrame:
    """Rows of :func:`write_by_period` with ``start <= column < end``; other periods' files are not read."""
    first, last = (F.trunc(moment(x), grain) if grain != "day" else moment(x).cast("date") for x in (start, end))
    stored = _with_period(spark, path, table).filter((F.col(PERIOD) >= first) & (F.col(PERIOD) <= last))
    return stored.filter(in_period(column, start, end)).drop(PERIOD)


def update_by_period(
    patch: DataFrame, path: str, table: Table, key: str, columns: list[str], column: str, grain: str = "month"
) -> None:
    """UPDATE of a table of :func:`write_by_period`: rows with a key of ``patch`` get its ``columns``.

    ``patch`` has one row per key and carries ``column`` as stored, which is not among the ``columns``; so the periods
    to rewrite are known without a look at the table, and all other files stay as they are. A key that is not in the
    period of its timestamp changes nothing. The old files of a period go when all new ones are there; frames that
    were read before have to be read again. The list of periods, one value per partition, passes through the driver.
    """
    spark = patch.sparkSession
    touched = [row[0] for row in patch.select(_period(column, grain)).distinct().collect()]
    if not touched:
        return
    inside = F.col(PERIOD).isin([p for p in touched if p is not None])
    if None in touched:
        inside = inside | F.col(PERIOD).isNull()
    held = _with_period(spark, path, table).filter(inside)
    # by period too, as a key may be stored under another one
    placed = patch.select(F.struct(key, _period(column, grain).alias("p")).alias("_at"), *columns)
    marked = held.withColumn("_at", F.struct(key, F.col(PERIOD).alias("p")))
    fresh = _typed_with(overlay(marked, placed, "_at", columns).drop("_at"), table)
    writer = fresh.hint("rebalance", PERIOD).write.mode("overwrite").option("partitionOverwriteMode", "dynamic")
    writer.partitionBy(PERIOD).parquet(path)


def _typed_with(df: DataFrame, table: Table) -> DataFrame:
    """As :func:`typed`, with the partition column kept."""
    return df.select(*[F.col(name).cast(kind).alias(name) for name, kind, _ in table.fields], PERIOD)


def _period(column: str, grain: str) -> Column:
    return F.col(column).cast("date") if grain == "day" else F.trunc(column, grain)


def _with_period(spark: SparkSession, path: str, table: Table) -> DataFrame:
    declared = ", ".join(f"`{name}` {kind}" for name, kind, _ in table.fields)
    return spark.read.schema(f"{declared}, `{PERIOD}` date").parquet(path)
