"""Vector bin packing of examples into sequences, under limits on tokens, segments and loss-bearing tokens at once.

Bins are filled one after the other. Of the examples that fit in every dimension the next is the one with the
largest dot product of its demand with what the bin has left, each dimension weighted by how scarce it is overall
(total demand over capacity). A window of examples is packed at a time, inside the task that read them; examples of
bins that came out loosely filled go back into the next window, so that memory is bounded and nothing is left out.
"""

from __future__ import annotations

import zlib
from collections import defaultdict
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from venueops.llm.tokens import shipped

WINDOW = 4096
LOOSE = 0.97


def filled(demands: np.ndarray, limits: np.ndarray) -> list[list[int]]:
    """Bins of row numbers of ``demands`` (one column a dimension); every row must fit into an empty bin."""
    if not len(demands):
        return []
    kinds, inverse = np.unique(demands, axis=0, return_inverse=True)
    inverse = inverse.ravel()
    waiting = defaultdict(list)
    for row in range(len(demands) - 1, -1, -1):
        waiting[int(inverse[row])].append(row)
    left = np.bincount(inverse, minlength=len(kinds))
    share = kinds / limits
    weight = demands.sum(axis=0) / limits
    weighted = share * (weight / weight.max())
    bins = []
    remaining = len(demands)
    while remaining:
        rest = limits.astype(np.int64).copy()
        rows = []
        alive = np.flatnonzero(left)
        fits = alive
        while len(fits):
            pick = int(fits[np.argmax(weighted[fits] @ (rest / limits))])
            rows.append(waiting[pick].pop())
            left[pick] -= 1
            rest -= kinds[pick]
            fits = fits[(left[fits] > 0) & (kinds[fits] <= rest).all(axis=1)]
        if not rows:
            raise ValueError("an example exceeds the limits")
        remaining -= len(rows)
        bins.append(rows)
    return bins


class Packer:
    """Sequences of one task. ``put`` and ``end`` yield (sequence id, examples in order)."""

    def __init__(self, limits: tuple[int, int, int], part: int):
        self.limits = np.array(limits)
        self.next = part << 33
        self.pool: list[tuple] = []

    def put(self, example: tuple, demand: tuple[int, int, int]) -> Iterator[tuple[int, list]]:
        self.pool.append((example, demand))
        if len(self.pool) >= WINDOW:
            yield from self._pack(last=False)

    def end(self) -> Iterator[tuple[int, list]]:
        yield from self._pack(last=True)

    def _pack(self, last: bool) -> Iterator[tuple[int, list]]:
        pool = self.pool
        demands = np.array([d for _, d in pool], dtype=np.int64).reshape(len(pool), len(self.limits))
        self.pool = []
        for rows in filled(demands, self.limits):
            use = demands[rows].sum(axis=0) / self.limits
            if not last and use.max() < LOOSE and len(pool) - len(self.pool) > WINDOW // 2:
                self.pool.extend(pool[r] for r in rows)
                continue
            yield self._numbered([pool[r][0] for r in rows])

    def _numbered(self, examples: list) -> tuple[int, list]:
        self.next += 1
        return self.next - 1, examples


def pack_documents(
    docs: DataFrame, length: int = 1024, segments: int = 64, loss: int | None = None, tokenizer: str | None = None
) -> DataFrame:
    """One row per piece of a document: doc_id, start, length, ids_crc32, doc_tokens, sequence_id, offset, loss_tokens.

    A document's ids (null text: empty) end in the separator; ids beyond ``length`` are cut into full pieces and a
    rest, every id in exactly one piece. A sequence holds at most ``length`` ids, ``segments`` pieces, and
    ``loss`` loss-bearing ids (``length`` by default): ids that have a predecessor in their piece. sequence_id is
    unique, without meaning; offset counts ids from the sequence's start. Every row is packed, equal ones too; an
    empty table gives no rows.
    """
    loss = length if loss is None else loss
    most = min(length, loss + 1)
    vocabulary = shipped(docs.sparkSession, tokenizer)
    names = ["doc_id", "start", "length", "ids_crc32", "doc_tokens", "sequence_id", "offset", "loss_tokens"]
    id_kind = docs.schema["doc_id"].dataType

    def rows_of(sequences) -> list[tuple]:
        out = []
        for sequence, pieces in sequences:
            offset = 0
            for doc_id, start, size, crc, total in pieces:
                out.append((doc_id, start, size, crc, total, sequence, offset, size - 1))
                offset += size
        return out

    def each(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encode = vocabulary().ids
        packer = Packer((length, segments, loss), TaskContext.get().partitionId())

        def arrow(rows: list[tuple], kind: pa.DataType) -> pa.RecordBatch:
            columns = list(zip(*rows, strict=True)) or [[]] * len(names)
            kinds = [kind] + [pa.int64()] * 7
            return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(columns, kinds, strict=True)], names)

        kind = None
        for batch in batches:
            kind = batch.column(0).type
            rows: list[tuple] = []
            for doc_id, text in zip(batch.column(0).to_pylist(), batch.column(1), strict=True):
                ids = encode(text.as_py() or "")
                for start in range(0, len(ids), most):
                    piece = ids[start : start + most]
                    example = (doc_id, start, len(piece), zlib.crc32(piece.tobytes()), len(ids))
                    rows += rows_of(packer.put(example, (len(piece), 1, len(piece) - 1)))
                if len(rows) > 20_000:
                    yield arrow(rows, kind)
                    rows = []
            yield arrow(rows, kind)
        if kind is not None:
            yield arrow(rows_of(packer.end()), kind)

    schema = f"doc_id {id_kind.simpleString()}, " + ", ".join(f"{n} long" for n in names[1:])
    return docs.select("doc_id", "text").mapInArrow(each, schema)


def pack_examples(examples: DataFrame, limits: tuple[int, int, int], tokens: str, loss: str) -> DataFrame:
    """``examples`` with a sequence_id and its offset: whole examples, none cut, under ``limits`` on tokens, segments
    and loss-bearing tokens. Null counts are 0; an example beyond a limit fails the job. Columns that are already named
    sequence_id or offset are replaced; repeated rows are examples of their own."""
    names = [c for c in examples.columns if c.lower() not in ("sequence_id", "offset")]
    examples = examples.select(*names, F.col(tokens).alias("__tokens"), F.col(loss).alias("__loss"))

    def each(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        packer = Packer(limits, TaskContext.get().partitionId())

        def arrow(sequences, schema: pa.Schema) -> Iterator[pa.RecordBatch]:
            parts = []
            for sequence, rows in sequences:
                offset = 0
                for row, size in rows:
                    parts.append((row, sequence, offset))
                    offset += size
            if parts:
                table = pa.Table.from_batches([p[0] for p in parts], schema).combine_chunks()
                yield from table.append_column("sequence_id", pa.array([p[1] for p in parts], pa.int64())).append_column(
                    "offset", pa.array([p[2] for p in parts], pa.int64())
                ).to_batches()

        schema = None
        for batch in batches:
            n, m = (batch.column(k).to_pylist() for k in (-2, -1))
            batch = pa.RecordBatch.from_arrays(batch.columns[:-2], batch.schema.names[:-2])
            schema = batch.schema
            for k in range(batch.num_rows):
                size = int(n[k] or 0)
                yield from arrow(packer.put((batch.slice(k, 1), size), (size, 1, int(m[k] or 0))), schema)
        if schema is not None:
            yield from arrow(packer.end(), schema)

    out = T.StructType([*examples.schema[:-2], T.StructField("sequence_id", T.LongType()), T.StructField("offset", T.LongType())])
    return examples.mapInArrow(each, out)
