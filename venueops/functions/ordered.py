"""Ordered work (running totals, as-of lookups, numbering) that no single task has to hold.

A plain window sends every row of a key to one task. Here rows are range-partitioned on
(key, order), so a hot key is cut into as many pieces as its size asks for; each piece is
scanned on its own and picks up the total of the pieces before it. The order columns must
end in something unique, else equal rows cannot be cut.

The piece number comes from the partitioning, so the partitioned rows are written to the
checkpoint folder: a task that is run again after a lost executor then sees the same pieces.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from venueops.plans.session import checkpointed

PIECE = "_piece"

# how a piece's rows are reduced, and how the results of earlier pieces are reduced again
_FOLD = {"sum": (F.sum, F.sum), "count": (F.count, F.sum), "max": (F.max, F.max)}


def pieces(df: DataFrame, by: list[str], order: list[str]) -> DataFrame:
    """``df`` cut into ranges of (by, order), with the range number in ``_piece``."""
    ranged = df.repartitionByRange(*by, *order)
    return checkpointed(ranged.withColumn(PIECE, F.spark_partition_id()))


def running_in(
    cut: DataFrame,
    by: list[str],
    order: list[str],
    aggregates: dict[str, tuple[str, str]],
    inclusive: bool = True,
) -> DataFrame:
    """Running aggregates ``{name: (sum|count|max, column)}`` per ``by`` over rows already cut."""
    last = Window.currentRow if inclusive else -1
    within = Window.partitionBy(*by, PIECE).orderBy(*order).rowsBetween(Window.unboundedPreceding, last)
    earlier = (
        Window.partitionBy(*(by or [F.lit(0)])).orderBy(PIECE).rowsBetween(Window.unboundedPreceding, -1)
    )

    totals = cut.groupBy(*by, PIECE).agg(
        *[_FOLD[kind][0](F.col(column)).alias(name) for name, (kind, column) in aggregates.items()]
    )
    # Only a key that straddles a range boundary carries anything over, and every boundary lies
    # inside at most one key: this frame has fewer rows than there are ranges.
    carried = (
        totals.withColumn("_seen", F.count(F.lit(1)).over(earlier))
        .select(
            *by,
            PIECE,
            "_seen",
            *[_FOLD[kind][1](F.col(name)).over(earlier).alias(f"_before_{name}")
              for name, (kind, _) in aggregates.items()],
        )
        .filter("_seen > 0")
        .drop("_seen")
    )

    scanned = cut
    for name, (kind, column) in aggregates.items():
        scanned = scanned.withColumn(name, _FOLD[kind][0](F.col(column)).over(within))
    scanned = scanned.join(F.broadcast(carried), [*by, PIECE], "left")
    for name, (kind, _) in aggregates.items():
        scanned = scanned.withColumn(name, _joined(kind, F.col(f"_before_{name}"), F.col(name)))
    return scanned.drop(*[f"_before_{name}" for name in aggregates])


def running(
    df: DataFrame,
    by: list[str],
    order: list[str],
    aggregates: dict[str, tuple[str, str]],
    inclusive: bool = True,
) -> DataFrame:
    """Running aggregates per ``by`` along ``order``; see :func:`running_in`."""
    return running_in(pieces(df, by, order), by, order, aggregates, inclusive).drop(PIECE)


def _joined(kind: str, before: Column, here: Column) -> Column:
    if kind == "max":
        return F.when(before.isNull() | (here > before), here).otherwise(before)
    return F.coalesce(before + here, before, here)


def numbered(df: DataFrame, order: list[str], name: str) -> DataFrame:
    """Adds 1..n along ``order``: a range sort, then each range's offset (one row per range)."""
    in_range = "_at"
    ranked = checkpointed(df.orderBy(*order).withColumn(in_range, F.monotonically_increasing_id()))
    # monotonically_increasing_id keeps the partition in the bits above 33 and the row below
    ranked = ranked.withColumn(PIECE, F.shiftright(in_range, 33)).withColumn(
        in_range, F.col(in_range).bitwiseAND(F.lit((1 << 33) - 1))
    )
    earlier = Window.partitionBy(F.lit(0)).orderBy(PIECE).rowsBetween(Window.unboundedPreceding, -1)
    offsets = (
        ranked.groupBy(PIECE)
        .agg(F.count(F.lit(1)).alias("_rows"))
        .select(PIECE, F.coalesce(F.sum("_rows").over(earlier), F.lit(0)).alias("_offset"))
    )
    return (
        ranked.join(F.broadcast(offsets), PIECE)
        .withColumn(name, F.col("_offset") + F.col(in_range) + 1)
        .drop(PIECE, in_range, "_offset")
    )
