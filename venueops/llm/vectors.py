"""Near-duplicate vectors by counting collisions of one-dimensional projections.

Unit vectors at a cosine of c differ, along a random direction scaled to unit variance, by a normal number of variance
2 - 2c. So near pairs fall into each other's window on almost every sorted projection and others on few.

* Some projections, cut into steps, form cells; a pair that shares a cell in one of several tables is counted. How many
  projections make a cell follows from the number of vectors (cells of about ``MATES`` unrelated ones), and the
  number of tables from that and the recall wanted at the threshold.
* In a cell ``COUNTED`` further projections are sorted, each vector's window (centred on it) is looked up in every
  order, and pairs with enough collisions are verified by their cosine in double precision. The count required is the
  highest that loses at most half a percent of the pairs at the threshold.
* Equal vectors are one class with a count before any cell is made.
* Cells beyond ``TILE`` vectors are cut into blocks, and pairs of blocks are tasks of their own. Tasks return
  counts of links and spanning forests, no pairs; a pair counts in the first table that it shares.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from venueops.llm import kernel as K
from venueops.llm.common import checkpointed, components
from venueops.llm.setjoin import spanning

MATES, COUNTED, TILE = 32, 24, 512
PRODUCTS = 1 << 22  # components of vector pairs that are multiplied at a time
STEP = 1.5  # a cell's width, in standard deviations of a projection


def plan(vectors: int, cosine: float, recall: float) -> tuple[int, int, float, int]:
    """(projections in a cell, tables, half window, collisions required)."""
    spread = math.sqrt(2 - 2 * cosine)
    near = 1 - spread * math.sqrt(2 / math.pi) / STEP  # at least: two points in one step
    chance = 0.36  # two unrelated unit vectors in one step of 1.5
    made = max(1, math.ceil(math.log(max(vectors, 2 * MATES) / MATES) / -math.log(chance)))
    tables = max(1, math.ceil(math.log(1 - recall) / math.log(1 - near**made)))
    half = 2 * spread
    hit = math.erf(half / spread / math.sqrt(2))
    lost, required = 0.0, 0
    for k in range(COUNTED + 1):
        lost += math.comb(COUNTED, k) * hit**k * (1 - hit) ** (COUNTED - k)
        if lost > 0.005:
            break
        required = k + 1
    return made, tables, half, required


def _directions(dim: int, count: int) -> np.ndarray:
    return np.random.default_rng(7).standard_normal((dim, count))


def _units(packed: pa.Array, kind: str) -> np.ndarray:
    """Unit vectors; components are first brought near 1 by a power of two, which is exact, so that no square is lost."""
    x = np.frombuffer(b"".join(packed.to_pylist()), dtype=kind).reshape(len(packed), -1).astype(np.float64)
    x = np.ldexp(x, -np.frexp(np.abs(x).max(axis=1, keepdims=True))[1])
    return x / np.linalg.norm(x, axis=1, keepdims=True)


def _rows(vectors: DataFrame) -> DataFrame:
    """Every row with ``__row`` and, where it can link, its components' bytes and the key of its class: equal label
    and components."""
    kind = {"float": "<f4", "double": "<f8"}[vectors.schema["embedding"].dataType.elementType.simpleString()]

    def each(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            n, label, lists = batch.num_rows, batch.column(2), batch.column(3)
            sizes = pc.fill_null(pc.list_value_length(lists), 0).to_numpy().astype(np.int64)
            flat = lists.flatten()
            values = pc.fill_null(flat, 0).to_numpy(zero_copy_only=False).astype(kind)
            owner = np.repeat(np.arange(n), sizes)
            odd = flat.is_null().to_numpy(zero_copy_only=False) | ~np.isfinite(values)
            able = label.is_valid().to_numpy(zero_copy_only=False) & (np.bincount(owner, odd, n) == 0)
            able &= np.bincount(owner, values != 0, n) > 0
            ends = (np.r_[0, np.cumsum(sizes)] * values.itemsize).astype(np.int32)
            packed = pa.Array.from_buffers(
                pa.binary(), n, [pa.py_buffer(np.packbits(able, bitorder="little")), pa.py_buffer(ends), pa.py_buffer(values.tobytes())]
            )
            yield pa.RecordBatch.from_arrays([*batch.columns[:3], packed], ["__row", "vec_id", "label", "packed"])

    picked = vectors.select(F.monotonically_increasing_id().alias("__row"), "vec_id", "label", "embedding")
    kinds = [f"{n} {vectors.schema[n].dataType.simpleString()}" for n in ("vec_id", "label")]
    found = picked.mapInArrow(each, f"__row long, {kinds[0]}, {kinds[1]}, packed binary")
    same = F.unhex(F.sha2(F.concat(F.col("label").cast("string").cast("binary"), F.lit(b":"), F.col("packed")), 256))
    return found.withColumn("same", same), kind


def linked_vectors(vectors: DataFrame, cosine: float = 0.93, recall: float = 0.98) -> DataFrame:
    """One row per row of ``vectors``: vec_id, n_links, component_id, kept.

    Rows link when their labels are equal and not null and their cosine is at least ``cosine``; vectors that are null,
    empty, zero or hold null or non-finite components link with nothing, nor do vectors of different lengths. n_links
    counts other rows, component_id is the smallest vec_id that links reach. ``recall`` is the least share of
    pairs found at the threshold itself; pairs above it are found more surely, equal vectors always. Pairs
    below the threshold are never linked. Rows of one vec_id are vectors of their own but one node of components.

    Rows of equal label and components are one class from the start and are compared once, whatever their number.
    """
    found, kind = _rows(vectors)
    rows = checkpointed(found)
    able = checkpointed(
        rows.filter("packed is not null")
        .groupBy("same")
        .agg(
            F.min("__row").alias("__row"),
            F.first("label").alias("label"),
            F.first("packed").alias("packed"),
            F.count(F.lit(1)).alias("copies"),
            F.min("vec_id").alias("least_id"),
        )
        .withColumn("dim", F.length("packed"))
    )
    largest = able.groupBy("label", "dim").agg(F.count(F.lit(1)).alias("n")).agg(F.max("n")).first()[0] or 0
    made, tables, half, required = plan(largest, cosine, recall)

    def cells(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            sizes = np.array([len(x) for x in batch.column(2).to_pylist()])
            out = np.zeros((batch.num_rows, tables), dtype=K.U)
            for size in np.unique(sizes):
                at = np.flatnonzero(sizes == size)
                x = _units(batch.column(2).take(pa.array(at)), kind)
                axes = _directions(x.shape[1], COUNTED + made * tables)[:, COUNTED:]
                shift = np.random.default_rng(11).random(made * tables) * STEP
                steps = np.floor((x @ axes + shift) / STEP).astype(np.int64).astype(K.U)
                steps = steps.reshape(len(x), tables, made)
                factor = K.constants(made, 5)
                out[at] = K.mixed((K.mixed(steps * factor) * factor).sum(axis=2) + np.arange(tables, dtype=K.U))
            longs = pa.ListArray.from_arrays(
                pa.array(np.arange(0, out.size + 1, tables), pa.int32()), pa.array(K.signed(out).ravel())
            )
            yield pa.RecordBatch.from_arrays([*batch.columns, longs], ["__row", "label", "packed", "copies", "cells"])

    label = vectors.schema["label"].dataType.simpleString()
    celled = able.select("__row", "label", "packed", "copies").mapInArrow(
        cells, f"__row long, label {label}, packed binary, copies long, cells array<long>"
    )
    celled = checkpointed(celled)
    spread = celled.select("__row", "label", F.length("packed").alias("dim"), F.posexplode("cells").alias("t", "cell"))
    key = ["label", "dim", "t", "cell"]
    sizes = spread.groupBy(*key).agg(F.count(F.lit(1)).alias("n")).filter("n > 1")
    blocks = F.ceil(F.col("n") / TILE).cast("int")
    dealt = (
        spread.join(checkpointed(sizes), key)
        .withColumn("blocks", blocks)
        .withColumn("own", F.pmod(F.xxhash64("__row"), F.col("blocks")).cast("int"))
        .withColumn("other", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)))
        .select(
            "__row",
            F.xxhash64(*key, F.least("own", "other"), F.greatest("own", "other")).alias("tile"),
            "t",
            (F.col("own") <= F.col("other")).alias("left"),
            (F.col("own") >= F.col("other")).alias("right"),
        )
        .join(celled.select("__row", "packed", "copies", "cells"), "__row")
    )

    def links(tile: pa.Table) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """(row, links, root) of a tile."""
        ids = tile.column("__row").to_numpy()
        x = _units(tile.column("packed").combine_chunks(), kind)
        values = x @ _directions(x.shape[1], COUNTED)
        collisions = np.zeros((len(x), len(x)), dtype=np.int16)
        for p in values.T:
            order = np.argsort(p, kind="stable")
            rank = np.argsort(order, kind="stable")
            lo = np.searchsorted(p[order], p - half, "left")
            hi = np.searchsorted(p[order], p + half, "right")
            collisions += (rank[None, :] >= lo[:, None]) & (rank[None, :] < hi[:, None])
        left, right = (tile.column(n).to_numpy() for n in ("left", "right"))
        good = (collisions >= required) & ((left[:, None] & right[None, :]) | (right[:, None] & left[None, :]))
        np.fill_diagonal(good, False)
        a, b = np.nonzero(np.triu(good))
        step = max(1, PRODUCTS // x.shape[1])  # pairs whose components are multiplied at a time
        parts = [np.einsum("ij,ij->i", x[a[k : k + step]], x[b[k : k + step]]) for k in range(0, len(a), step)]
        near = np.concatenate(parts) >= cosine if parts else np.empty(0, bool)
        a, b = a[near], b[near]
        cells = np.array(tile.column("cells").combine_chunks().flatten().to_numpy()).reshape(len(x), -1)
        t = int(tile.column("t")[0].as_py())
        first = ~(cells[a, :t] == cells[b, :t]).any(axis=1)
        copies = tile.column("copies").to_numpy()
        counts = np.zeros(len(x), dtype=np.int64)
        np.add.at(counts, a[first], copies[b[first]])
        np.add.at(counts, b[first], copies[a[first]])
        joined = np.zeros((len(x), len(x)), dtype=bool)
        joined[a, b] = joined[b, a] = True
        u, v = spanning(joined)
        return ids, counts, np.c_[ids[u], ids[v]].reshape(-1, 2)

    def each(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[pa.RecordBatch] = []
        last = None

        def flush() -> pa.RecordBatch:
            ids, counts, edges = links(pa.Table.from_batches(held))
            has = counts > 0
            return pa.RecordBatch.from_arrays(
                [
                    pa.array(np.r_[ids[has], edges[:, 0]]),
                    pa.array(np.r_[counts[has], np.zeros(len(edges), dtype=np.int64)].astype(np.int64)),
                    pa.array([None] * int(has.sum()) + edges[:, 1].tolist(), pa.int64()),
                ],
                ["__row", "n", "other"],
            )

        for batch in batches:
            tiles = batch.column(batch.schema.get_field_index("tile")).to_numpy()
            edges = np.r_[0, np.flatnonzero(tiles[1:] != tiles[:-1]) + 1, len(tiles)] if len(tiles) else []
            for lo, hi in zip(edges[:-1], edges[1:], strict=True):
                if held and tiles[lo] != last:
                    yield flush()
                    held = []
                held.append(batch.slice(lo, hi - lo))
                last = tiles[lo]
        if held:
            yield flush()

    dealt = dealt.repartition("tile").sortWithinPartitions("tile", "__row")
    partial = checkpointed(dealt.mapInArrow(each, "__row long, n long, other long"))
    counts = checkpointed(partial.groupBy("__row").agg(F.sum("n").alias("others")))
    labels = checkpointed(components(partial.filter("other is not null").select(F.col("__row").alias("a"), F.col("other").alias("b"))))
    named = labels.join(able.select(F.col("__row").alias("node"), "least_id"), "node")
    least = named.groupBy("label").agg(F.min("least_id").alias("reached"))
    placed = checkpointed(named.join(least, "label").select(F.col("node").alias("__row"), "reached"))
    known = (
        able.select("same", "__row", "copies", "least_id")
        .join(counts, "__row", "left")
        .join(placed, "__row", "left")
        .filter("copies > 1 or others is not null or reached is not null")
        .select(
            "same",
            (F.col("copies") - 1 + F.coalesce("others", F.lit(0))).alias("links"),
            F.coalesce("reached", "least_id").alias("component"),
        )
    )
    out = rows.select("vec_id", "same").join(checkpointed(known), "same", "left")
    component = F.coalesce("component", "vec_id")
    return out.select(
        "vec_id",
        F.coalesce("links", F.lit(0)).cast("long").alias("n_links"),
        component.alias("component_id"),
        F.coalesce(F.col("vec_id") == component, F.lit(False)).alias("kept"),
    )
