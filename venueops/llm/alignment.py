"""Alignment of two tokenizers' tokens by the bytes they cover.

For a set of documents, a tokenizer's tokens form a token-byte incidence matrix in compressed rows. The product of one
tokenizer's matrix with the other's transposed, row by row, gives the overlap links: which tokens share bytes, and how
many. Bytes after which tokens of both end cut the tokens into groups; the product of the two group incidences (token
ids x groups) gives the shared-group links with their multiplicities.

Documents are worked on in chunks of bounded size. A chunk keeps its documents' links as (document, id pair) rows
of a matrix, and only the chunk's distinct pairs are shuffled to learn the pairs' counts over the whole corpus; they
come back to the chunk, and each document's sums are one more matrix product.
"""

from __future__ import annotations

import hashlib
import json
import uuid
import zlib
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from venueops.llm import kernel as K
from venueops.llm.common import written
from venueops.llm.tokens import byte_letters

CHUNK = 2 << 20  # bytes of text in a chunk, or one text
PART = 256 << 10  # bytes of text that are worked on at a time, or one text
PRODUCT = 1 << 22  # most entries that a product expands at a time

# of a chunk, only its distinct pairs are lists; the rest is packed, as nothing but Python looks into it
CHUNKS = "chunk binary, docs binary, links binary, pair array<long>, holders array<int>"
# rows of chunks that a writer or reader holds at a time
CHUNK_ROWS = {"parquet.block.row.count.limit": "8"}
RESULT = (
    "doc_id long, n_a long, n_b long, n_groups long, n_links long, n_overlaps long, n_best long, count_sum long, "
    "groups_sha256 string"
)


@dataclass
class Rows:
    """A sparse matrix in compressed rows: row r has ``values[k]`` in ``columns[k]`` for edges[r] <= k < edges[r+1]."""

    edges: np.ndarray
    columns: np.ndarray
    values: np.ndarray

    @staticmethod
    def of(rows: np.ndarray, columns: np.ndarray, n: int) -> Rows:
        """From entries of value 1; equal entries are added. Columns are below 2^32."""
        keys, times = np.unique((rows.astype(np.int64) << 32) | columns, return_counts=True)
        return Rows(np.searchsorted(keys, np.arange(n + 1, dtype=np.int64) << 32), keys & 0xFFFFFFFF, times)


def product(a: Rows, b: Rows) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray]]:
    """a·b by Gustavson's rule, as (row, column, value) sorted by row and column, some whole rows of ``a`` at a time.

    A row of the product is the sum of the rows of ``b`` that the row of ``a`` names, scaled by its values.
    """
    width = np.diff(b.edges)
    work = np.r_[0, np.cumsum(width[a.columns])]  # entries that each entry of a expands to
    row, n = 0, len(a.edges) - 1
    while row < n:
        after = int(np.searchsorted(work[a.edges], work[a.edges[row]] + PRODUCT, "right")) - 1
        after = min(n, max(row + 1, after))
        lo, hi = a.edges[row], a.edges[after]
        count = width[a.columns[lo:hi]]
        owner = np.repeat(np.arange(hi - lo), count)
        k = np.arange(len(owner)) - np.repeat(np.cumsum(count) - count, count) + b.edges[a.columns[lo:hi]][owner]
        rows = np.repeat(np.arange(row, after), np.diff(a.edges[row : after + 1]))[owner]
        keys = (rows << 32) | b.columns[k]
        values = a.values[lo:hi][owner] * b.values[k]
        order = np.argsort(keys, kind="stable")
        keys, values = keys[order], values[order]
        first = np.flatnonzero(np.r_[True, keys[1:] != keys[:-1]]) if len(keys) else np.empty(0, np.int64)
        if len(first):
            yield keys[first] >> 32, keys[first] & 0xFFFFFFFF, np.add.reduceat(values, first)
        row = after


def overlaps(a_sizes: np.ndarray, b_sizes: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(a token, b token, bytes both cover) of two tokenizations of the same bytes, given by the tokens' sizes.

    Row t of the first token-byte matrix is 1 in the bytes of token t; row k of the other, transposed, is 1 in
    the one token that covers byte k. The entries of the product's rows come out in order, so equal ones are neighbours.
    """
    a_bytes = np.repeat(np.arange(len(a_sizes)), a_sizes)  # the row of each entry; its column is its place
    b_of_byte = np.repeat(np.arange(len(b_sizes)), b_sizes)
    if not len(a_bytes):
        return (np.empty(0, np.int64),) * 3
    fresh = np.r_[True, (a_bytes[1:] != a_bytes[:-1]) | (b_of_byte[1:] != b_of_byte[:-1])]
    first = np.flatnonzero(fresh)
    return a_bytes[first], b_of_byte[first], np.diff(np.r_[first, len(a_bytes)])


def groups_of(a_sizes: np.ndarray, b_sizes: np.ndarray) -> tuple[np.ndarray, np.ndarray, int]:
    """(group of each a token, of each b token, number of groups): cut where tokens of both end."""
    a_ends, b_ends = np.cumsum(a_sizes), np.cumsum(b_sizes)
    both = np.intersect1d(a_ends, b_ends, assume_unique=True)
    return np.searchsorted(both, a_ends), np.searchsorted(both, b_ends), len(both)


class Tokens:
    """The bytes of every id of a vocabulary, end to end."""

    def __init__(self, entries: list[bytes]):
        self.sizes = np.array([len(x) for x in entries], dtype=np.int64)
        self.starts = np.cumsum(self.sizes) - self.sizes
        self.bytes = np.frombuffer(b"".join(entries), dtype=np.uint8)

    def joined(self, ids: np.ndarray) -> np.ndarray:
        sizes = self.sizes[ids]
        begin = np.cumsum(sizes) - sizes
        return self.bytes[np.arange(sizes.sum()) + np.repeat(self.starts[ids] - begin, sizes)]


class Tokenizers:
    """Both tokenizers, with the bytes of their tokens and the digits of their ids."""

    def __init__(self, byte_level: str, pieces: bytes):
        import sentencepiece
        import tiktoken

        letters = byte_letters()
        found = json.loads(byte_level)
        added = {x["content"]: x["id"] for x in found.get("added_tokens", [])}
        entries = {i: bytes(letters[c] for c in t) for t, i in found["model"]["vocab"].items() if t not in added}
        a = [entries.get(i, b"") for i in range(max(*entries, *added.values()) + 1)]
        self.first = tiktoken.Encoding(
            "first", pat_str=public_tokenizers.PATTERN, mergeable_ranks={x: i for i, x in entries.items()}, special_tokens={}
        )
        self.second = sentencepiece.SentencePieceProcessor(model_proto=pieces)
        b = []
        for i in range(self.second.get_piece_size()):
            piece = self.second.id_to_piece(i)
            whole = piece.replace("▁", " ").encode()
            b.append(bytes([int(piece[3:5], 16)]) if self.second.is_byte(i) else whole)
        self.a, self.b = Tokens(a), Tokens(b)
        size = max(len(a), len(b))
        # an id's digits with what follows it: another of its side, the other side, the next group
        self.digits = np.array([f"{i}{mark}".encode() for mark in ",|;" for i in range(size)], dtype="S8")
        self.size = size

    def encoded(self, text: str) -> tuple[np.ndarray, np.ndarray]:
        """Ids of both; none if the bytes of either are not those of a space and the text."""
        none = np.empty(0, np.int64)
        if not text:
            return none, none
        a = np.array(self.first.encode_ordinary(" " + text), dtype=np.int64)
        b = np.array(self.second.encode(text), dtype=np.int64)
        whole = np.frombuffer(b" " + text.encode(), dtype=np.uint8)
        for tokens, ids in ((self.a, a), (self.b, b)):
            if tokens.sizes[ids].sum() != len(whole) or not np.array_equal(tokens.joined(ids), whole):
                return none, none
        return a, b


def _linked(tool: Tokenizers, texts: list[str]) -> tuple[dict[str, np.ndarray | pa.Array], np.ndarray, np.ndarray]:
    """Of some whole documents: their columns, with the ``ends`` of their links; the links' id pairs; their multiplicities."""
    n = len(texts)
    found = [tool.encoded(x) for x in texts]
    n_a, n_b = (np.array([len(x[side]) for x in found], dtype=np.int64) for side in (0, 1))
    a, b = (np.concatenate([x[side] for x in found]) for side in (0, 1))
    del found
    a_doc, b_doc = np.repeat(np.arange(n), n_a), np.repeat(np.arange(n), n_b)
    a_size, b_size = tool.a.sizes[a], tool.b.sizes[b]
    # all documents on one line of bytes: every document's end is an end of both
    a_group, b_group, n_all = groups_of(a_size, b_size)
    group_doc = np.zeros(n_all, dtype=np.int64)
    group_doc[a_group] = a_doc
    n_groups = np.bincount(group_doc, minlength=n) if n_all else np.zeros(n, np.int64)
    in_a, in_b = np.bincount(a_group, minlength=n_all), np.bincount(b_group, minlength=n_all)
    n_links = np.zeros(n, dtype=np.int64)
    np.add.at(n_links, group_doc, in_a * in_b)
    n_overlaps = np.bincount(a_doc[overlaps(a_size, b_size)[0]], minlength=n)

    # every id with its mark, in the order of groups, first side before second
    place_a = np.arange(len(a)) + (np.cumsum(in_b) - in_b)[a_group]
    place_b = np.arange(len(b)) + np.cumsum(in_a)[b_group]
    ends_a = np.r_[a_group[1:] != a_group[:-1], True] if len(a) else np.empty(0, bool)
    ends_b = np.r_[b_group[1:] != b_group[:-1], True] if len(b) else np.empty(0, bool)
    line = np.empty(len(a) + len(b), dtype=np.int64)
    line[place_a] = a + tool.size * ends_a
    line[place_b] = b + 2 * tool.size * ends_b
    until = np.cumsum(n_a + n_b)
    digests = []
    for k in range(n):
        if not n_a[k]:
            digests.append("")
            continue
        text = tool.digits[line[until[k] - n_a[k] - n_b[k] : until[k]]].tobytes().translate(None, b"\0")
        digests.append(hashlib.sha256(text[:-1]).hexdigest())

    # (document, a id) x groups times groups x b id: a document's id pairs with multiplicities
    owners = (a_doc << 32) | a
    distinct, row = np.unique(owners, return_inverse=True)
    parts = list(product(Rows.of(row, a_group, len(distinct)), Rows.of(b_group, b, n_all)))
    rows, b_ids, times = (np.concatenate([x[k] for x in parts]) if parts else np.empty(0, np.int64) for k in range(3))
    del parts
    pairs = ((distinct[rows] & 0xFFFFFFFF) << 32) | b_ids if len(rows) else np.empty(0, np.int64)
    ends = np.searchsorted(distinct[rows] >> 32 if len(rows) else rows, np.arange(n), "right")
    columns = {
        "n_a": n_a,
        "n_b": n_b,
        "n_groups": n_groups.astype(np.int64),
        "n_links": n_links,
        "n_overlaps": n_overlaps.astype(np.int64),
        "groups_sha256": pa.array(digests, pa.string()),
        "ends": ends.astype(np.int64),
    }
    return columns, pairs, times.astype(np.int64)


def _chunk(tool: Tokenizers, ids: pa.Array, texts: pa.Array) -> pa.RecordBatch:
    """One row of ``CHUNKS`` for some whole documents."""
    docs, pairs, times, links = [], [], [], 0
    for lo, hi, _, _ in K.slices(texts, PART):
        columns, some, multiplicities = _linked(tool, texts.slice(lo, hi - lo).to_pylist())
        columns["ends"] += links
        links += len(some)
        docs.append(pa.RecordBatch.from_pydict({"doc_id": ids.slice(lo, hi - lo), **columns}))
        pairs.append(some)
        times.append(multiplicities)
    pair, at, holders = np.unique(np.concatenate(pairs), return_inverse=True, return_counts=True)
    lists = {"at": at.astype(np.int32), "times": np.concatenate(times)}
    columns = [uuid.uuid4().bytes, _packed(pa.Table.from_batches(docs)), _packed(pa.table(lists))]
    return pa.RecordBatch.from_arrays(
        [pa.array([x], pa.binary()) for x in columns] + [_list(pair), _list(holders.astype(np.int32))],
        ["chunk", "docs", "links", "pair", "holders"],
    )


def _list(values: np.ndarray) -> pa.Array:
    return pa.ListArray.from_arrays(pa.array([0, len(values)], pa.int32()), pa.array(values))


def _packed(table: pa.Table) -> bytes:
    sink = pa.BufferOutputStream()
    with pa.ipc.new_stream(sink, table.schema, options=pa.ipc.IpcWriteOptions(compression="zstd")) as stream:
        stream.write_table(table.combine_chunks())
    return sink.getvalue().to_pybytes()


def _unpacked(value: pa.Scalar) -> pa.Table:
    with pa.ipc.open_stream(value.as_buffer()) as stream:
        return stream.read_all()


def shipped(spark: SparkSession, byte_level: str | None, pieces: str | None):
    """A function for tasks that returns the tokenizers, read by the driver and kept by each Python worker."""
    with open(byte_level or public_tokenizers.path("byte_bpe_50k.json"), encoding="utf-8") as file:
        first = file.read()
    with open(pieces or public_tokenizers.path("piece_bpe_32k.model"), "rb") as file:
        second = file.read()
    name = f"tokenizers{zlib.crc32(first.encode())}-{zlib.crc32(second)}"
    sent = spark.sparkContext.broadcast((first, second))
    return lambda: K.per_process(name, lambda: Tokenizers(*sent.value))


def aligned(docs: DataFrame, byte_level: str | None = None, pieces: str | None = None) -> DataFrame:
    """Rows of ``RESULT``, one for each of ``docs`` (doc_id, text).

    ``byte_level`` and ``pieces`` are paths of the vocabularies, the public ones if not given. Null and empty texts, and
    texts that either tokenizer does not give back byte for byte, have zeros and the digest ''. Repeated rows are
    documents of their own and count each; a null doc_id stays null. ``n_overlaps`` are the token pairs that share
    a byte. A pair's count is the number of documents of the whole corpus that link it.
    """
    tools = shipped(docs.sparkSession, byte_level, pieces)

    def each(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tool = tools()
        for batch in batches:
            texts = K.strings(batch.column(1))
            for lo, hi, _, _ in K.slices(texts, CHUNK):
                yield _chunk(tool, batch.column(0).slice(lo, hi - lo), texts.slice(lo, hi - lo))

    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    chunks, _ = written(rows.mapInArrow(each, CHUNKS), CHUNK_ROWS)
    held = chunks.select("chunk", F.explode(F.arrays_zip("pair", "holders")).alias("x")).select("chunk", "x.*")
    counts, _ = written(held.groupBy("pair").agg(F.sum("holders").alias("count")))
    a_id = F.shiftright("pair", 32)
    top = counts.groupBy(a_id.alias("a")).agg(F.max("count").alias("top"))
    best = (F.col("count") == F.col("top")).cast("long")
    known = counts.withColumn("a", a_id).join(top, "a").select("pair", (F.col("count") * 2 + best).alias("count_best"))
    back = held.select(F.col("chunk").alias("of"), "pair").join(known, "pair")

    def summed(left: pa.Table, right: pa.Table) -> pa.Table:
        pair, count = right["pair"].to_numpy(), right["count_best"].to_numpy()
        count = count[np.argsort(pair)]  # a chunk's pairs are numbered in order
        out = []
        for docs, links in zip(left["docs"], left["links"], strict=True):
            docs, links = _unpacked(docs), _unpacked(links)
            at, times, ends = links["at"].to_numpy(), links["times"].to_numpy(), docs["ends"].to_numpy()
            sums = []
            for values in (count & 1, count >> 1):
                total = np.r_[0, np.cumsum(times * values[at])]
                sums.append(pa.array(total[ends] - total[np.r_[0, ends[:-1]]]))
            same = ["doc_id", "n_a", "n_b", "n_groups", "n_links", "n_overlaps"]
            columns = [docs[x] for x in same] + sums + [docs["groups_sha256"]]
            out.append(pa.table(columns, [*same, "n_best", "count_sum", "groups_sha256"]))
        return pa.concat_tables(out)  # pairs come only with their chunk

    rows = chunks.select("chunk", "docs", "links")
    return rows.groupBy("chunk").cogroup(back.groupBy("of")).applyInArrow(summed, RESULT)
