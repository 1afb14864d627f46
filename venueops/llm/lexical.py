"""Ranked lexical search over an index stratified by document length.

All documents of one length normaliser ``m`` form a stratum, kept in blocks of bounded size. A block holds its
documents and, for each term, the postings in runs of equal term frequency (largest first), so that within a block a
frequency has one impact, computed once. The impacts of a term's largest frequency bound what any document of the
block can score. A search first visits each item's blocks of largest bound, which gives a score that its k best
documents reach at least, and then, in order of their bounds, only blocks that can reach it.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from venueops.llm import kernel as K
from venueops.llm.common import removed, written

BLOCK_POSTINGS, BLOCK_DOCUMENTS = 1 << 18, 1 << 13  # a block ends after the document that reaches one of them
VOCABULARY = 1 << 17  # most terms that are sent to the tasks; an index for more holds every term
ITEM_TERMS = 1 << 18  # about so many (item, term) are searched at a time
SEEDS = 4  # blocks of largest bound that are visited first

INDEX = (
    "block long, m long, docs array<long>, term array<string>, most array<int>, holders array<int>, "
    "runs array<int>, tf array<int>, ends array<int>, at array<int>"
)


@dataclass
class Index:
    """``blocks`` as in ``INDEX``: per term the largest frequency, the documents that hold it and the end of its
    runs; per run the frequency and the end of its postings; per posting the place in ``docs``. ``n_docs`` counts
    the documents with at least one term."""

    blocks: DataFrame
    n_docs: int


def _counted(docs: DataFrame, only: list[str] | None) -> DataFrame:
    """(doc_id, n, terms, tfs): a document's number of terms, and its distinct ones (of ``only``) with counts."""
    sent = docs.sparkSession.sparkContext.broadcast(only)

    def each(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        wanted = None if sent.value is None else pa.array(sent.value, pa.large_string())
        for batch in batches:
            for lo, hi, offsets, data in K.slices(batch.column(1)):
                distinct, codes, rows = K.tokens(data, offsets, "punctuation")
                n = np.bincount(rows, minlength=hi - lo)
                if wanted is not None:
                    asked = pc.is_in(distinct, value_set=wanted).to_numpy(zero_copy_only=False)[codes]
                    codes, rows = codes[asked], rows[asked]
                width = max(1, len(distinct))
                pairs, tf = np.unique(rows * width + codes, return_counts=True)
                at = pa.array(np.searchsorted(pairs, np.arange(hi - lo + 1) * width).astype(np.int32))
                terms = pa.ListArray.from_arrays(at, distinct.take(pa.array(pairs % width)).cast(pa.string()))
                tfs = pa.ListArray.from_arrays(at, pa.array(tf.astype(np.int32)))
                ids = batch.column(0).slice(lo, hi - lo)
                yield pa.RecordBatch.from_arrays([ids, pa.array(n.astype(np.int64)), terms, tfs], ["doc_id", "n", "terms", "tfs"])

    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    return rows.mapInArrow(each, "doc_id long, n long, terms array<string>, tfs array<int>")


def _blocks(ranged: DataFrame) -> DataFrame:
    """Rows (m, doc_id, terms, tfs), sorted by m in each partition, as blocks of one m."""

    def block(number: int, m: int, parts: list[pa.RecordBatch]) -> pa.RecordBatch:
        rows = pa.Table.from_batches(parts).combine_chunks().to_batches()[0]
        ids, terms, tfs = rows.column(1), rows.column(2), rows.column(3)
        sizes = np.diff(terms.offsets.to_numpy())
        place = np.repeat(np.arange(len(ids)), sizes)
        coded = terms.flatten().dictionary_encode()
        codes, tf = coded.indices.to_numpy(), tfs.flatten().to_numpy()
        order = np.lexsort((place, -tf, codes))
        codes, tf, place = codes[order], tf[order], place[order]
        last = np.r_[codes[1:] != codes[:-1], True] if len(codes) else np.empty(0, bool)
        run_last = last | np.r_[tf[1:] != tf[:-1], True] if len(codes) else last
        first = np.r_[True, last[:-1]] if len(codes) else last
        values = {
            "block": number,
            "m": m,
            "docs": ids,
            "term": coded.dictionary,
            "most": tf[first],
            "holders": np.diff(np.r_[np.flatnonzero(first), len(codes)]),
            "runs": np.cumsum(run_last)[last],
            "tf": tf[run_last],
            "ends": np.flatnonzero(run_last) + 1,
            "at": place,
        }
        columns = []
        for name, value in values.items():
            if name in ("block", "m"):
                columns.append(pa.array([value], pa.int64()))
                continue
            flat = value if isinstance(value, pa.Array) else pa.array(value.astype(np.int32))
            columns.append(pa.ListArray.from_arrays(pa.array([0, len(flat)], pa.int32()), flat))
        return pa.RecordBatch.from_arrays(columns, list(values))

    def each(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        number = TaskContext.get().partitionId() << 32
        parts, held, docs, of = [], 0, 0, None
        for batch in batches:
            ms = batch.column(0).to_numpy()
            sizes = pc.list_value_length(batch.column(2)).to_numpy()
            lo = 0
            for k in range(len(ms)):
                if of is not None and (ms[k] != of or held >= BLOCK_POSTINGS or docs >= BLOCK_DOCUMENTS):
                    parts.append(batch.slice(lo, k - lo))
                    yield block(number, of, [x for x in parts if x.num_rows])
                    number, parts, held, docs, lo = number + 1, [], 0, 0, k
                of, held, docs = int(ms[k]), held + int(sizes[k]), docs + 1
            parts.append(batch.slice(lo))
        if of is not None:
            yield block(number, of, [x for x in parts if x.num_rows])

    return ranged.mapInArrow(each, INDEX)


def build(docs: DataFrame, only: list[str] | None = None) -> Index:
    """The index of all of ``docs`` (doc_id, text), for every term or for those of ``only``.

    Terms are runs of ASCII letters, digits and all characters beyond ASCII, A-Z lower-cased. Null and empty texts
    have none and are in no block, as is a document without asked terms. Repeated rows are documents of their own; a
    null doc_id stays null. A stratum with a large share of all documents is cut by hash into many blocks.
    """
    spark = docs.sparkSession
    counted, path = written(_counted(docs, only))
    total = counted.agg(F.count_if(F.col("n") > 0).alias("docs"), F.sum("n").alias("terms")).first()
    n_docs, n_terms = total["docs"], total["terms"] or 0
    m = F.expr(f"10 + (90L * n * {n_docs}L) div {max(1, n_terms)}L")
    held = counted.filter("size(terms) > 0").select(m.alias("m"), "doc_id", "terms", "tfs")
    spread = F.xxhash64("doc_id", "terms")
    ranged = held.repartitionByRange("m", spread).sortWithinPartitions("m", spread)
    blocks, _ = written(_blocks(ranged))
    removed(spark, path)
    return Index(blocks, n_docs)


def item_terms(items: DataFrame) -> DataFrame:
    """(item_id, term): each item's distinct terms; rows of one item_id are one item."""

    def each(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for lo, _, offsets, data in K.slices(batch.column(1)):
                distinct, codes, rows = K.tokens(data, offsets, "punctuation")
                width = max(1, len(distinct))
                pairs = np.unique(rows * width + codes)
                ids = batch.column(0).take(pa.array(pairs // width + lo))
                yield pa.RecordBatch.from_arrays([ids, distinct.take(pa.array(pairs % width)).cast(pa.string())], ["item_id", "term"])

    kind = items.schema["item_id"].dataType.simpleString()
    return items.select("item_id", "text").mapInArrow(each, f"item_id {kind}, term string").distinct()


class Asked:
    """A set of items as a sparse matrix: the weights of its terms in compressed rows."""

    def __init__(self, rows: list, k: int):
        self.k = k
        self.ids = list(dict.fromkeys(r["item_id"] for r in rows))
        number = {x: i for i, x in enumerate(self.ids)}
        self.terms = list(dict.fromkeys(r["term"] for r in rows))
        column = {x: i for i, x in enumerate(self.terms)}
        owner = np.array([number[r["item_id"]] for r in rows], dtype=np.int64)
        order = np.argsort(owner, kind="stable")
        self.columns = np.array([column[r["term"]] for r in rows], dtype=np.int64)[order]
        self.weights = np.array([r["w"] for r in rows], dtype=np.int64)[order]
        self.edges = np.searchsorted(owner[order], np.arange(len(self.ids) + 1))
        self.least = np.ones(len(self.ids), dtype=np.int64)  # scores below cannot be among the best k

    def present(self, terms: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """(asked terms among ``terms``, their places there)."""
        found = pc.index_in(terms, value_set=pa.array(self.terms, terms.type)).fill_null(-1).to_numpy()
        at = np.flatnonzero(found >= 0)
        return found[at], at

    def bounds(self, m: int, terms: pa.Array, most: np.ndarray) -> np.ndarray:
        """What no document of the block can exceed, for each item."""
        best = np.zeros(len(self.terms), dtype=np.int64)
        mine, at = self.present(terms)
        best[mine] = impacts(most[at].astype(np.int64), m)
        sums = np.r_[0, np.cumsum(self.weights * best[self.columns])]
        return sums[self.edges[1:]] - sums[self.edges[:-1]]


def impacts(tf: np.ndarray, m: int) -> np.ndarray:
    return (1_000_000_000 * tf) // (1000 * tf + 8 * m)


class Block:
    """One row of the index, opened for scoring."""

    def __init__(self, row: dict, asked: Asked):
        mine, at = asked.present(row["term"])
        runs, tf, ends = (row[x].to_numpy().astype(np.int64) for x in ("runs", "tf", "ends"))
        self.impact = np.repeat(impacts(tf, row["m"]), np.diff(np.r_[0, ends]))  # once per term frequency
        self.at = row["at"].to_numpy()
        closes = ends[runs - 1]
        opens = np.r_[0, closes[:-1]]
        self.where = {int(t): (int(opens[k]), int(closes[k])) for t, k in zip(mine, at, strict=True)}
        self.docs = row["docs"]

    def scores(self, asked: Asked, item: int) -> np.ndarray:
        total = np.zeros(len(self.docs), dtype=np.int64)
        for k in range(asked.edges[item], asked.edges[item + 1]):
            if span := self.where.get(int(asked.columns[k])):
                total[self.at[span[0] : span[1]]] += asked.weights[k] * self.impact[span[0] : span[1]]
        return total


class Best:
    """The k best documents of each item so far."""

    def __init__(self, asked: Asked):
        self.asked, self.least = asked, asked.least.copy()
        self.found: list[list[tuple[int, int | None]]] = [[] for _ in asked.ids]

    def visit(self, block: Block, item: int) -> None:
        scores = block.scores(self.asked, item)
        at = np.flatnonzero(scores >= self.least[item])
        if not len(at):
            return
        ids = block.docs.take(pa.array(at)).to_pylist()
        best = self.found[item] + list(zip(scores[at].tolist(), ids, strict=True))
        best.sort(key=lambda x: (-x[0], x[1] is None, x[1]))
        self.found[item] = best[: self.asked.k]
        if len(best) >= self.asked.k:
            self.least[item] = max(self.least[item], self.found[item][-1][0])

    def rows(self) -> pa.RecordBatch:
        flat = [(i, *x) for i, found in enumerate(self.found) for x in found]
        columns = list(zip(*flat, strict=True)) or [[], [], []]
        kinds = (pa.int32(), pa.int64(), pa.int64())
        return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, kinds, strict=True)], ["item", "score", "doc_id"])


def _opened(batch: pa.RecordBatch) -> list[dict]:
    """The rows of a batch: numbers as Python's, lists as Arrow arrays."""
    names = batch.schema.names
    return [
        {
            name: column[k].values if pa.types.is_list(column.type) or pa.types.is_large_list(column.type) else column[k].as_py()
            for name, column in zip(names, batch.columns, strict=True)
        }
        for k in range(batch.num_rows)
    ]


def _largest_bounds(blocks: DataFrame, sent) -> DataFrame:
    """(item, bound, block): of each task, the ``SEEDS`` blocks of largest bound for each item."""

    def each(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        asked = sent.value
        bounds, numbers = [], []
        for batch in batches:
            for row in _opened(batch):
                bounds.append(asked.bounds(row["m"], row["term"], row["most"].to_numpy()))
                numbers.append(row["block"])
            if len(bounds) > 256:
                bounds, numbers = _top(bounds, numbers)
        if not bounds:
            return
        bounds, numbers = _top(bounds, numbers)
        table, names = np.stack(bounds), np.array(numbers, dtype=np.int64)
        for item in range(table.shape[1]):
            at = np.argsort(-table[:, item], kind="stable")[:SEEDS]
            at = at[table[at, item] > 0]
            yield pa.RecordBatch.from_arrays(
                [pa.array(np.full(len(at), item, np.int32)), pa.array(table[at, item]), pa.array(names[at])],
                ["item", "bound", "block"],
            )

    def _top(bounds: list, numbers: list) -> tuple[list, list]:
        table = np.stack(bounds)
        kept = np.unique(np.argsort(-table, axis=0, kind="stable")[:SEEDS])
        return [bounds[k] for k in kept], [numbers[k] for k in kept]

    return blocks.select("block", "m", "term", "most").mapInArrow(each, "item int, bound long, block long")


def _visited(blocks: DataFrame, sent) -> DataFrame:
    """(item, score, doc_id): of each task, each item's k best documents in blocks whose bound can reach them."""

    def each(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        asked = sent.value
        best = Best(asked)
        for batch in batches:
            rows = _opened(batch)
            bounds = np.stack([asked.bounds(r["m"], r["term"], r["most"].to_numpy()) for r in rows])
            opened: dict[int, Block] = {}
            for item in range(len(asked.ids)):
                for k in np.argsort(-bounds[:, item], kind="stable").tolist():
                    if bounds[k, item] < best.least[item]:
                        break
                    if k not in opened:
                        opened[k] = Block(rows[k], asked)
                    best.visit(opened[k], item)
        yield best.rows()

    return blocks.mapInArrow(each, "item int, score long, doc_id long")


def _ranked(found: DataFrame, k: int) -> DataFrame:
    order = Window.partitionBy("item").orderBy(F.desc("score"), F.asc_nulls_last("doc_id"))
    return found.withColumn("rank", F.row_number().over(order)).filter(F.col("rank") <= k)


def search(index: Index, terms: DataFrame, k: int = 10) -> DataFrame:
    """(item_id, rank, doc_id, score): each item's ``k`` documents of largest score above 0, ties by doc_id.

    ``terms`` are as from :func:`item_terms`. A term's weight is floor(1000 ln((2N+2)/(2df+1))); the score sums
    weight x impact, in integers. Items without terms, or whose terms no document holds, have no rows. Equal
    documents with equal doc_id take a rank each, in any order; null ids come last among ties. The items are
    searched in sets of about ``ITEM_TERMS`` terms, so what tasks receive is bounded.
    """
    spark = index.blocks.sparkSession
    holders = index.blocks.select(F.explode(F.arrays_zip("term", "holders")).alias("x")).select("x.*")
    df = holders.groupBy("term").agg(F.sum("holders").alias("df"))
    w = F.floor(1000 * F.log((2.0 * F.lit(index.n_docs) + 2) / (2.0 * F.col("df") + 1))).cast("long")
    weighted, _ = written(terms.join(df, "term").select("item_id", "term", w.alias("w")).filter("w > 0"))
    sets = max(1, -(-weighted.count() // ITEM_TERMS))
    kind = terms.schema["item_id"].dataType.simpleString()
    answers = []
    for number in range(sets):
        mine = F.pmod(F.xxhash64("item_id"), F.lit(sets)) == number
        asked = Asked(weighted.filter(mine).collect(), k)
        if not asked.ids:
            continue
        sent = spark.sparkContext.broadcast(asked)
        by_bound = Window.partitionBy("item").orderBy(F.desc("bound"), "block")
        first = _largest_bounds(index.blocks, sent).withColumn("turn", F.row_number().over(by_bound))
        seeds = first.filter(F.col("turn") <= SEEDS).select("block").distinct()  # at most SEEDS blocks an item
        reached = _ranked(_visited(index.blocks.join(F.broadcast(seeds), "block", "left_semi"), sent), k)
        for row in reached.filter(F.col("rank") == k).collect():
            asked.least[row["item"]] = row["score"]
        sent = spark.sparkContext.broadcast(asked)
        names = spark.createDataFrame(list(enumerate(asked.ids)), f"item int, item_id {kind}")
        answers.append(_ranked(_visited(index.blocks, sent), k).join(F.broadcast(names), "item"))
    if not answers:
        return spark.createDataFrame([], f"item_id {kind}, rank int, doc_id long, score long")
    found = answers[0]
    for more in answers[1:]:
        found = found.unionByName(more)
    return found.select("item_id", F.col("rank").cast("int").alias("rank"), "doc_id", "score")


def vocabulary(terms: DataFrame) -> list[str] | None:
    """The distinct terms if they are at most ``VOCABULARY``, else None: an index of every term."""
    distinct = terms.select("term").distinct().limit(VOCABULARY + 1).collect()
    return None if len(distinct) > VOCABULARY else [r["term"] for r in distinct]


def ranked(docs: DataFrame, items: DataFrame, k: int = 10) -> DataFrame:
    """Each item's ``k`` best documents; see :func:`build` and :func:`search` for rows with nulls, repeats and ties."""
    terms, _ = written(item_terms(items))
    return search(build(docs, vocabulary(terms)), terms, k)
