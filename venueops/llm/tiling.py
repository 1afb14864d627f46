"""Benchmark decontamination by greedy string tiling.

Tokens are runs of letters and digits, A-Z in lower case. Runs of ``least`` tokens are hashed (Karp-Rabin) in the
benchmark's items and in the documents; equal ones are seeds, found by a join. Per document and item, seeds in a row
along both texts are a match, the longest match is marked, what it overlaps is cut back, and so on down to ``least``
tokens. The share of an item's tokens that are marked is its coverage, whatever the order of the passages.
"""

from __future__ import annotations

import heapq
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from venueops.llm import kernel as K
from venueops.llm.common import KEY, checkpointed, row_key, without

FILTER_BITS = 1 << 22  # half a megabyte, whatever the benchmark's size


def _seeds(rows: DataFrame, key, id_column: str, least: int, kept: np.ndarray | None) -> DataFrame:
    """(seed, id, row key, at, tokens) for every run of ``least`` tokens; with ``kept`` only those whose bit is set."""
    shipped = rows.sparkSession.sparkContext.broadcast(kept) if kept is not None else None

    def each(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bits = shipped.value if shipped is not None else None
        for batch in batches:
            for lo, hi, offsets, data in K.slices(batch.column(2)):
                hashes, rows, _, _ = K.words(data, offsets, "punctuation")
                seeds, at = K.grams(hashes, rows, least, short=False)
                if bits is not None:
                    place = seeds & K.U(FILTER_BITS - 1)
                    hit = (bits[(place >> K.U(3)).astype(np.int64)] >> (place & K.U(7)).astype(np.uint8)) & 1 == 1
                    seeds, at = seeds[hit], at[hit]
                counts = np.bincount(rows, minlength=hi - lo)
                begins = np.cumsum(counts) - counts
                owner = rows[at]
                where = pa.array(owner + lo)
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array(K.signed(seeds)),
                        batch.column(0).take(where),
                        batch.column(1).take(where),
                        pa.array((at - begins[owner]).astype(np.int64)),
                        pa.array(counts[owner].astype(np.int64)),
                    ],
                    ["seed", KEY, "id", "at", "tokens"],
                )

    kind = rows.schema[id_column].dataType.simpleString()
    picked = rows.select(key.alias(KEY), F.col(id_column).alias("id"), "text")
    return picked.mapInArrow(each, f"seed long, {KEY} binary, id {kind}, at long, tokens long")


def _filter(seeds: DataFrame) -> np.ndarray:
    """A bit for each value that a seed's low bits take: a summary of fixed size of the benchmark."""
    low = f"(seed & {FILTER_BITS - 1})"
    words = (
        seeds.selectExpr(f"shiftright({low}, 5) as word", f"shiftleft(1L, cast({low} & 31 as int)) as bit")
        .groupBy("word")
        .agg(F.bit_or("bit").alias("bits"))
        .collect()
    )
    out = np.zeros(FILTER_BITS // 32, dtype="<u4")
    for row in words:
        out[row["word"]] = row["bits"]
    return out.view(np.uint8)


def tiles(item_at: np.ndarray, doc_at: np.ndarray, least: int) -> list[tuple[int, int, int]]:
    """(start in the item, start in the document, tokens) of the greedy tiling, from places of seeds of ``least`` tokens.

    Of matches of equal length the one that comes first in the item, then in the document, is marked.
    """
    order = np.lexsort((item_at, doc_at - item_at))
    i, j = item_at[order], doc_at[order]
    head = np.flatnonzero(np.r_[True, (i[1:] != i[:-1] + 1) | (j[1:] != j[:-1] + 1)])
    size = np.diff(np.r_[head, len(i)]) + least - 1
    heap = [(-int(n), int(a), int(b)) for n, a, b in zip(size, i[head], j[head], strict=True)]
    heapq.heapify(heap)
    in_item, in_doc, out = set(), set(), []
    while heap:
        n, a, b = heapq.heappop(heap)
        free = [a + k not in in_item and b + k not in in_doc for k in range(-n)]
        if all(free):
            in_item.update(range(a, a - n))
            in_doc.update(range(b, b - n))
            out.append((a, b, -n))
            continue
        begin = None
        for k, is_free in enumerate([*free, False]):
            if is_free and begin is None:
                begin = k
            elif not is_free and begin is not None:
                if k - begin >= least:
                    heapq.heappush(heap, (begin - k, a + begin, b + begin))
                begin = None
    return out


def contaminated(docs: DataFrame, benchmark: DataFrame, least: int = 5, coverage: float = 0.6) -> DataFrame:
    """One row per document and benchmark item that it covers: row key, doc_id, item_id, item_tokens, covered,
    coverage, tiles.

    ``coverage`` is the least share of the item's tokens. Null or empty texts and items of fewer than ``least``
    tokens match nothing. Items that repeat under one id and text count once; rows of one doc_id with
    several texts are apart, rows equal in both give one row each item. Empty tables give no rows.
    """
    bench = checkpointed(
        _seeds(benchmark, row_key("item_id", "text"), "item_id", least, None)
        .dropDuplicates([KEY, "at"])
        .select("seed", F.col(KEY).alias("item"), F.col("id").alias("item_id"), F.col("at").alias("item_at"), F.col("tokens").alias("item_tokens"))
    )
    hits = _seeds(docs, row_key("doc_id", "text"), "doc_id", least, _filter(bench)).select(
        "seed", KEY, F.col("id").alias("doc_id"), F.col("at").alias("doc_at")
    )
    pairs = (
        hits.join(bench, "seed")
        .groupBy(KEY, "doc_id", "item", "item_id", "item_tokens")
        .agg(F.collect_set(F.struct("item_at", "doc_at")).alias("seeds"))
        # seeds of n places cover at most n + least - 1 tokens a run; too few cannot reach the share
        .filter(F.size(F.array_distinct("seeds.item_at")) * F.lit(least) >= F.lit(coverage) * F.col("item_tokens"))
    )

    def each(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found, covered = [], []
            for seeds in batch.column(batch.num_columns - 1):
                flat = seeds.values
                a, b = (flat.field(k).to_numpy() for k in (0, 1))
                marked = tiles(a, b, least)
                found.append([{"item_start": x, "doc_start": y, "tokens": n} for x, y, n in marked])
                covered.append(sum(n for _, _, n in marked))
            tokens = batch.column(4).to_numpy()
            share = np.array(covered, dtype=float) / np.maximum(tokens, 1)
            kind = pa.list_(pa.struct([("item_start", pa.int64()), ("doc_start", pa.int64()), ("tokens", pa.int64())]))
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), batch.column(1), batch.column(3), batch.column(4), pa.array(covered, pa.int64()), pa.array(share), pa.array(found, kind)],
                [KEY, "doc_id", "item_id", "item_tokens", "covered", "coverage", "tiles"],
            ).filter(pa.array(share >= coverage))

    ids = [f"{name} {pairs.schema[name].dataType.simpleString()}" for name in ("doc_id", "item_id")]
    return pairs.mapInArrow(
        each,
        f"{KEY} binary, {ids[0]}, {ids[1]}, item_tokens long, covered long, coverage double, "
        "tiles array<struct<item_start:long,doc_start:long,tokens:long>>",
    )


def decontaminated(docs: DataFrame, benchmark: DataFrame, least: int = 5, coverage: float = 0.6) -> DataFrame:
    """``docs`` without the documents that cover an item of the benchmark."""
    found = checkpointed(contaminated(docs, benchmark, least, coverage).select(KEY).distinct())
    return without(docs, found, "doc_id", "text")
