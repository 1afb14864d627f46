"""Updates and new ids on immutable tables."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from venueops.functions.ordered import numbered


def overlay(
    base: DataFrame, patch: DataFrame, key: str, columns: list[str], only_changed: bool = False
) -> DataFrame:
    """UPDATE as a new version of ``base``: where ``patch`` has the key, its ``columns`` replace the old.

    ``patch`` has one row per key. A NULL in the patch is written as NULL. With ``only_changed``
    the untouched rows are left out, for tables whose partitions are rewritten one by one.
    """
    marked = patch.select(
        key, *[F.col(c).alias(f"_new_{c}") for c in columns], F.lit(True).alias("_hit")
    )
    joined = base.join(marked, key, "inner" if only_changed else "left")
    return joined.select(
        *[
            F.when(F.col("_hit"), F.col(f"_new_{c}")).otherwise(F.col(c)).alias(c) if c in columns else F.col(c)
            for c in base.columns
        ]
    )


def surrogate_keys(
    df: DataFrame, order: list[str], existing: DataFrame | None = None, name: str = "id"
) -> DataFrame:
    """New ids in ``order`` after the largest id of ``existing``.

    ``order`` must be total. No single task numbers the whole frame.
    """
    fresh = numbered(df, order, name)
    if existing is None:
        return fresh
    last = existing.agg(F.coalesce(F.max("id").cast("bigint"), F.lit(0).cast("bigint"))).scalar()
    return fresh.withColumn(name, F.col(name) + last)
