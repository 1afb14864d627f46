"""Keys of rows, selections by key, and connected components."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from venueops.plans import session
from venueops.plans.session import removed

# Of the writes of intermediate tables: their shuffle files go once the table is complete, as nothing reads them
# again, and whole texts go to Python in small batches, by rows and, as some are very long, by bytes.
WRITING = {
    "spark.sql.classic.shuffleDependency.fileCleanup.enabled": "true",
    "spark.sql.execution.arrow.maxRecordsPerBatch": "3000",
    "spark.sql.execution.arrow.maxBytesPerBatch": str(4 << 20),
}

KEY = "__row_key"


def written(df: DataFrame, options: dict[str, str] | None = None) -> tuple[DataFrame, str]:
    """As the session's ``written``, under ``WRITING``; the caller's settings are put back."""
    conf = df.sparkSession.conf
    before = {key: conf.get(key, None) for key in WRITING}
    for key, value in WRITING.items():
        conf.set(key, value)
    try:
        return session.written(df, options)
    finally:
        for key, value in before.items():
            conf.unset(key) if value is None else conf.set(key, value)


def checkpointed(df: DataFrame) -> DataFrame:
    return written(df)[0]


def row_key(*columns: str) -> Column:
    """128 bits of the columns' values: the same for the same row wherever and whenever it is read, unlike
    generated ids, which change with the splits of the input when executors come or go."""
    parts = [F.coalesce(F.concat(F.lit("="), F.col(c).cast("string")), F.lit("null")) for c in columns]
    return F.unhex(F.md5(F.concat_ws("\x1f", *parts)))


def without(docs: DataFrame, dropped: DataFrame, *columns: str) -> DataFrame:
    """The rows of ``docs`` whose key over ``columns`` is not among ``dropped``'s ``KEY``."""
    return docs.withColumn(KEY, row_key(*columns)).join(dropped.select(KEY), KEY, "left_anti").drop(KEY)


def components(links: DataFrame) -> DataFrame:
    """(node, label): the smallest node that links (a, b) reach from each node that has one.

    Large star and small star in turn: every node first hands its larger neighbours to its smallest one, then all
    its neighbours below it, until the links are stars. Each step is a grouped minimum and a join, so a node
    with very many neighbours is summed before it is shuffled and split by the skew join.
    """
    spark = links.sparkSession
    down = links.filter("a <> b").select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v"))
    edges, path = written(down.distinct())
    before = _fingerprint(edges)
    while True:
        both = edges.unionByName(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
        least = both.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m"))
        large = both.filter("v > u").join(least, "u").select(F.col("v").alias("u"), F.col("m").alias("v"))
        large = large.filter("u <> v").distinct()
        lowest = large.groupBy("u").agg(F.min("v").alias("m"))
        pulled = large.join(lowest, "u").select(F.col("v").alias("u"), F.col("m").alias("v")).filter("u <> v")
        small = pulled.unionByName(lowest.withColumnRenamed("m", "v")).distinct()
        edges, fresh = written(small)
        removed(spark, path)
        path, after = fresh, _fingerprint(edges)
        if after == before:
            return edges.select(F.col("u").alias("node"), F.col("v").alias("label")).unionByName(
                edges.select(F.col("v").alias("node"), F.col("v").alias("label")).distinct()
            )
        before = after


def _fingerprint(edges: DataFrame):
    row = edges.agg(
        F.count(F.lit(1)).alias("n"), F.bit_xor(F.xxhash64("u", "v")).alias("x"), F.bit_xor(F.hash("v", "u")).alias("y")
    ).first()
    return tuple(row)


__all__ = ["KEY", "checkpointed", "components", "removed", "row_key", "without", "written"]
