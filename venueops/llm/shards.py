"""Sharding by a weighted hash tree: regions, racks in a region, shards in a rack.

At each level a row draws an exponential number for every child, -ln(u) / weight with u hashed from the row's key and
the child's name, and goes to the least. A child is chosen in proportion to its weight. When weights change, a row
leaves a node only for one whose weight grew, or because its own shrank, so movement stays in the subtrees whose
weights changed. A shard that opens a region of its own takes rows only into itself.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from venueops.functions.ordered import running


@dataclass(frozen=True)
class Tree:
    """Leaves as (region, rack, shard, weight)."""

    leaves: tuple[tuple[int, int, int, float], ...]

    @staticmethod
    def even(shards: int, rack: int = 4, racks: int = 2) -> Tree:
        """Shards of weight 1 in racks of ``rack``, regions of ``racks`` racks."""
        return Tree(tuple((s // (rack * racks), s // rack % racks, s, 1.0) for s in range(shards)))

    def with_shard(self, shard: int, weight: float = 1.0) -> Tree:
        """One more shard, as a region of its own."""
        region = 1 + max((leaf[0] for leaf in self.leaves), default=-1)
        return Tree((*self.leaves, (region, 0, shard, weight)))

    def level(self, depth: int) -> dict[str, list[tuple[str, int, float]]]:
        """Children (name, number, weight) by the name of their parent."""
        out: dict[str, dict[str, list]] = {}
        for leaf in self.leaves:
            parent = "/".join(map(str, leaf[:depth]))
            name = "/".join(map(str, leaf[: depth + 1]))
            node = out.setdefault(parent, {}).setdefault(name, [leaf[depth], 0.0])
            node[1] += leaf[3]
        return {parent: [(n, *x) for n, x in nodes.items() if x[1] > 0] for parent, nodes in out.items()}


def _drawn(key: Column, tree: Tree, depth: int, parent: Column | None) -> Column:
    """(draw, name, number) of the child that wins."""

    def children(nodes) -> Column:
        return F.array(
            *[F.struct(F.lit(n).alias("name"), F.lit(i).alias("number"), F.lit(float(w)).alias("weight")) for n, i, w in nodes]
        )

    level = tree.level(depth)
    if parent is None:
        options = children(level[""])
    else:
        pairs = [x for name, nodes in level.items() for x in (F.lit(name), children(nodes))]
        options = F.element_at(F.create_map(*pairs), parent)

    def draw(child: Column) -> Column:
        u = (F.shiftrightunsigned(F.xxhash64(key, child["name"]), 11) + F.lit(0.5)) / F.lit(float(1 << 53))
        return F.struct((-F.log(u) / child["weight"]).alias("draw"), child["name"].alias("name"), child["number"].alias("number"))

    return F.array_min(F.transform(options, draw))


def placed(df: DataFrame, key: str, tree: Tree, name: str) -> DataFrame:
    """``df`` with the shard of each row; null keys are one key."""
    names = df.columns
    out = df.withColumn("__region", _drawn(F.col(key), tree, 0, None))
    out = out.withColumn("__rack", _drawn(F.col(key), tree, 1, F.col("__region.name")))
    out = out.withColumn("__shard", _drawn(F.col(key), tree, 2, F.col("__rack.name")))
    return out.select(*names, F.col("__shard.number").alias(name))


def sharded(docs: DataFrame, shards: int) -> DataFrame:
    """One row per document: doc_id, size, text_crc32, law, shard, slot, grown_shard.

    Law ``key``: doc_id and the number of shards decide; with one more shard rows move only into it. size is the
    text's UTF-8 bytes plus 16, a null text has none and the checksum 0. slot numbers the rows of a shard without a
    gap, by doc_id, then checksum; rows equal in both in any order. Rows of one doc_id share a shard. The numbering
    cuts shards into ranges, so that no task has to hold one.
    """
    tree = Tree.even(shards)
    text = F.coalesce("text", F.lit(""))
    rows = docs.select(
        "doc_id",
        (F.octet_length(text) + 16).cast("long").alias("size"),
        F.crc32(F.encode(text, "UTF-8")).alias("text_crc32"),
        F.lit("key").alias("law"),
    )
    rows = placed(rows, "doc_id", tree, "shard")
    rows = placed(rows, "doc_id", tree.with_shard(shards), "grown_shard")
    rows = rows.withColumn("__row", F.monotonically_increasing_id())
    numbered = running(rows, ["shard"], ["doc_id", "text_crc32", "__row"], {"slot": ("count", "__row")}, inclusive=False)
    return numbered.select(
        "doc_id", "size", "text_crc32", "law", "shard", F.coalesce("slot", F.lit(0)).cast("long").alias("slot"), "grown_shard"
    )
