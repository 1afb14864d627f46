"""Token-id output: whole texts as ids, packed best-fit decreasing into the rows of id matrices.

Texts longer than a row are cut into full rows and a rest, without loss. Rests are placed longest first, each in the
row with the least room that still holds it, which a segment tree over the possible room finds. A window of rests
is packed at a time inside the task that read them; loosely filled rows go back into the next window.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame

from venueops.llm.tokens import shipped

WINDOW = 4096
LOOSE = 0.97
ROWS = 64


class Room:
    """Rows by the room they have left: a segment tree of counts over 0..capacity."""

    def __init__(self, capacity: int):
        self.leaves = 1 << capacity.bit_length()
        self.count = [0] * (2 * self.leaves)
        self.rows: list[list[int]] = [[] for _ in range(capacity + 1)]

    def _change(self, room: int, by: int) -> None:
        node = room + self.leaves
        while node:
            self.count[node] += by
            node >>= 1

    def add(self, room: int, row: int) -> None:
        self.rows[room].append(row)
        self._change(room, 1)

    def take(self, need: int) -> tuple[int, int] | None:
        """(room, row) with the least room of at least ``need``; the row is taken out."""
        node = need + self.leaves
        while not self.count[node]:
            while node & 1:  # a right child: nothing larger below this parent
                node >>= 1
                if node <= 1:
                    return None
            node += 1
        while node < self.leaves:
            node = 2 * node if self.count[2 * node] else 2 * node + 1
        room = node - self.leaves
        self._change(room, -1)
        return room, self.rows[room].pop()


def best_fit(sizes: list[int], capacity: int) -> list[list[int]]:
    """Rows of indices into ``sizes``, best-fit decreasing; sizes are 1..capacity."""
    room = Room(capacity)
    rows: list[list[int]] = []
    for k in sorted(range(len(sizes)), key=lambda k: (-sizes[k], k)):
        if (found := room.take(sizes[k])) is None:
            rows.append([])
            found = capacity, len(rows) - 1
        rows[found[1]].append(k)
        room.add(found[0] - sizes[k], found[1])
    return rows


def packed_ids(docs: DataFrame, length: int = 1024, tokenizer: str | None = None) -> DataFrame:
    """Blocks of up to 64 packed rows: block_id, n_rows, row_length, dtype, ids, cu_seqlens, resets, doc_ids, starts.

    ``ids`` is the matrix's bytes, row by row, little-endian in ``dtype``, padded with the separator. ``cu_seqlens``
    holds the ends of all segments, padding included, counted over the block from 0; ``resets`` where position ids
    start again from 0, which is each segment's first place. ``doc_ids`` and ``starts`` give each segment's document
    and its first id there, null for padding. Every id of every row is in exactly one segment: null and empty texts
    are one separator, and an empty table gives no rows.
    """
    vocabulary = shipped(docs.sparkSession, tokenizer)
    id_kind = docs.schema["doc_id"].dataType
    names = ["block_id", "n_rows", "row_length", "dtype", "ids", "cu_seqlens", "resets", "doc_ids", "starts"]

    def each(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tool = vocabulary()
        kind = np.dtype("<u2" if tool.size <= 1 << 16 else "<u4")
        block = TaskContext.get().partitionId() << 33
        pool: list[tuple] = []
        ready: list[list[tuple]] = []

        def matrix(rows: list[list[tuple]], id_type: pa.DataType) -> pa.RecordBatch:
            nonlocal block
            ids = np.zeros((len(rows), length), dtype=kind)
            ends, resets, owners, starts = [0], [], [], []
            for r, row in enumerate(rows):
                at = 0
                for doc_id, start, piece in row:
                    ids[r, at : at + len(piece)] = piece
                    resets.append(r * length + at)
                    at += len(piece)
                    ends.append(r * length + at)
                    owners.append(doc_id)
                    starts.append(start)
                if at < length:
                    resets.append(r * length + at)
                    ends.append((r + 1) * length)
                    owners.append(None)
                    starts.append(None)
            block += 1
            longs = pa.list_(pa.int64())
            return pa.RecordBatch.from_arrays(
                [
                    pa.array([block - 1], pa.int64()),
                    pa.array([len(rows)], pa.int32()),
                    pa.array([length], pa.int32()),
                    pa.array([kind.name]),
                    pa.array([ids.tobytes()], pa.binary()),
                    pa.array([ends], longs),
                    pa.array([resets], longs),
                    pa.array([owners], pa.list_(id_type)),
                    pa.array([starts], longs),
                ],
                names,
            )

        def settle(last: bool) -> None:
            nonlocal pool
            held, pool = pool, []
            for row in best_fit([len(x[2]) for x in held], length):
                used = sum(len(held[k][2]) for k in row)
                if not last and used < LOOSE * length and len(pool) < WINDOW // 2:
                    pool.extend(held[k] for k in row)
                else:
                    ready.append([held[k] for k in row])

        id_type = None
        for batch in batches:
            id_type = batch.column(0).type
            for doc_id, text in zip(batch.column(0).to_pylist(), batch.column(1), strict=True):
                ids = tool.ids(text.as_py() or "").astype(kind)
                for start in range(0, len(ids), length):
                    piece = ids[start : start + length]
                    if len(piece) == length:
                        ready.append([(doc_id, start, piece)])
                    else:
                        pool.append((doc_id, start, piece))
                if len(pool) >= WINDOW:
                    settle(last=False)
                while len(ready) >= ROWS:
                    yield matrix(ready[:ROWS], id_type)
                    del ready[:ROWS]
        if id_type is not None:
            settle(last=True)
            for k in range(0, len(ready), ROWS):
                yield matrix(ready[k : k + ROWS], id_type)

    schema = (
        "block_id long, n_rows int, row_length int, dtype string, ids binary, cu_seqlens array<long>, "
        f"resets array<long>, doc_ids array<{id_kind.simpleString()}>, starts array<long>"
    )
    return docs.select("doc_id", "text").mapInArrow(each, schema)
