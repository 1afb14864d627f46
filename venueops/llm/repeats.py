"""Exact removal of long strings that occur more than once, by a logarithmic family of fingerprint tables.

Strings are of ``length`` units, bytes or words. All suffixes of a corpus are far too many to sort. Only suffixes at
anchors are kept: of every window of ``length`` units the start of its least string of ``length // 2`` (by hash, the
leftmost of equals). Which string that is depends on the window alone, so equal windows have anchors at equal
places, and a small share of the positions is enough. In place of a suffix array a batch has the table of its anchors,
each by the fingerprint of its first ``length // 2`` units (``key``) and of its reach (``hull``: all windows that chose
the anchor, as one string); as only matches of a fixed length are asked for, neither suffix order nor common prefixes
are kept.

* **Index family.** A new batch of documents gets its table, which is met with the levels that exist by a semi join:
  keys that both have are long matches. Then the table becomes a level, and levels of equal size are merged, so
  that n batches leave log n levels, and every anchor is merged log n times.
* **Windows.** A reach that occurs twice makes all its windows repeats. For an anchor whose key is shared and whose
  reach is not (the ends of a match) the windows themselves are compared, within the key: small groups as
  sorted runs of contexts, groups beyond ``GROUP`` contexts as rows of a grouped count, so that no task has to
  hold a hot key. Both are the same comparison.
* **Bytes.** The union of all repeated windows of a document is taken out.

Keys and reaches are 64-bit fingerprints, compared within equal keys. Words are runs without white space, A-Z in
lower case.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from venueops.llm import kernel as K
from venueops.llm.common import KEY, checkpointed, removed, row_key, written

GROUP = 2000


class Line:
    """A slice's texts as units: ``values`` (bytes, or hashes of words), ``offsets`` of the texts among them, and where
    each unit starts and ends in the slice's bytes."""

    def __init__(self, data: np.ndarray, offsets: np.ndarray, unit: str):
        self.data, self.unit = data, unit
        if unit == "bytes":
            self.values, self.offsets = data, offsets
        else:
            self.values, rows, self.starts, self.ends = K.words(data, offsets)
            self.offsets = np.searchsorted(rows, np.arange(len(offsets)))

    def bytes_of(self, a: int, b: int) -> tuple[int, int]:
        """The bytes from unit ``a`` to unit ``b``, which is not among them; a < b."""
        return (a, b) if self.unit == "bytes" else (int(self.starts[a]), int(self.ends[b - 1]))


def anchors_of(data: np.ndarray, offsets: np.ndarray, length: int):
    """(key, hull, row, anchor, first window, last window) of a slice's anchors; positions count units from the
    text's first."""
    seed = length // 2
    width = length - seed + 1
    n = len(data)
    sizes = np.diff(offsets)
    if n < length or not (sizes >= length).any():
        return tuple(np.empty(0, t) for t in (K.U, K.U, np.int64, np.int64, np.int64, np.int64))
    sums = K.prefix_sums(data)
    count = n - seed + 1
    up, down = K.powers(len(sums))
    value = K.mixed((sums[seed:] - sums[:count]) * down[:count])
    bits = K.U(int(n).bit_length())
    ranked = (value >> bits << bits) | np.arange(count, dtype=K.U)  # leftmost of equals
    blocks = -(-count // width)
    padded = np.full(blocks * width, np.iinfo(K.U).max, dtype=K.U)
    padded[:count] = ranked
    grid = padded.reshape(blocks, width)
    ahead = np.minimum.accumulate(grid, axis=1).ravel()
    behind = np.minimum.accumulate(grid[:, ::-1], axis=1)[:, ::-1].ravel()
    windows = n - length + 1
    least = np.minimum(behind[:windows], ahead[width - 1 : width - 1 + windows])
    chosen = (least & ((K.U(1) << bits) - K.U(1))).astype(np.int64)
    row = np.searchsorted(offsets, np.arange(windows), "right") - 1
    whole = np.arange(windows) + length <= offsets[row + 1]
    at = np.flatnonzero(whole)
    picked, row = chosen[at], row[at]
    fresh = np.r_[True, (picked[1:] != picked[:-1]) | (row[1:] != row[:-1])]
    head = np.flatnonzero(fresh)
    tail = np.r_[head[1:], len(at)] - 1
    first, last, anchor, row = at[head], at[tail], picked[head], row[head]
    hull = K.substring_hashes(sums, first, last + length)
    hull = K.mixed(hull + (anchor - first).astype(K.U) * K.U(0x9FB21C651E98DF25))
    start = offsets[row]
    return value[anchor], hull, row, anchor - start, first - start, last - start


def _array(docs: DataFrame, length: int, unit: str) -> DataFrame:
    """(key, hull, n) of a batch's anchors."""

    def each(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for _, _, offsets, data in K.slices(batch.column(0)):
                line = Line(data, offsets, unit)
                key, hull, *_ = anchors_of(line.values, line.offsets, length)
                both, n = np.unique(np.stack([key, hull], axis=1), axis=0, return_counts=True)
                yield pa.RecordBatch.from_arrays(
                    [pa.array(K.signed(both[:, 0])), pa.array(K.signed(both[:, 1])), pa.array(n.astype(np.int64))],
                    ["key", "hull", "n"],
                )

    return docs.select("text").mapInArrow(each, "key long, hull long, n long")


class IndexFamily:
    """Levels of sorted arrays in the shared folder, sizes in powers of two of a batch."""

    def __init__(self, length: int = 400, unit: str = "bytes"):
        self.length, self.unit = length, unit
        self.levels: list[tuple[int, DataFrame, str]] = []

    def add(self, docs: DataFrame) -> DataFrame:
        """Indexes a batch; returns the keys (written) of its long matches, inside itself and with earlier batches."""
        fresh, path = _level(_array(docs, self.length, self.unit))
        within = fresh.groupBy("key").agg(F.sum("n").alias("n")).filter("n > 1").select("key")
        keys = fresh.select("key").distinct()
        for _, level, _ in self.levels:
            within = within.unionByName(keys.join(level.select("key"), "key", "left_semi"))
        matches = checkpointed(within.distinct())
        rank = 0
        while any(r == rank for r, _, _ in self.levels):
            other = next(x for x in self.levels if x[0] == rank)
            self.levels.remove(other)
            merged, place = _level(fresh.unionByName(other[1]))
            removed(docs.sparkSession, path, other[2])
            fresh, path, rank = merged, place, rank + 1
        self.levels.append((rank, fresh, path))
        return matches

    def entries(self) -> DataFrame:
        """(key, hull, n) over all levels."""
        out = self.levels[0][1]
        for _, level, _ in self.levels[1:]:
            out = out.unionByName(level)
        return out.groupBy("key", "hull").agg(F.sum("n").alias("n"))


def _level(rows: DataFrame) -> tuple[DataFrame, str]:
    return written(rows.groupBy("key", "hull").agg(F.sum("n").alias("n")).sortWithinPartitions("key", "hull"))


def _occurrences(docs: DataFrame, length: int, unit: str) -> DataFrame:
    """One row per anchor of every row with text."""

    def each(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for lo, _, offsets, data in K.slices(batch.column(1)):
                line = Line(data, offsets, unit)
                key, hull, row, anchor, first, last = anchors_of(line.values, line.offsets, length)
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array(K.signed(key)),
                        pa.array(K.signed(hull)),
                        batch.column(0).take(pa.array(row + lo)),
                        pa.array(anchor),
                        pa.array(first),
                        pa.array(last),
                    ],
                    ["key", "hull", KEY, "m", "a", "b"],
                )

    keyed = docs.select(row_key("doc_id", "text").alias(KEY), "text")
    return keyed.mapInArrow(each, f"key long, hull long, {KEY} binary, m long, a long, b long")


def _packed(docs: DataFrame, length: int) -> DataFrame:
    """(row key, z): compressed texts that are long enough to hold a repeat."""

    def each(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        pack = zstandard.ZstdCompressor(level=3)
        for batch in batches:
            for lo, _, offsets, data in K.slices(batch.column(1)):
                rows = np.flatnonzero(np.diff(offsets) >= length)
                texts = [pack.compress(data[offsets[i] : offsets[i + 1]].tobytes()) for i in rows]
                yield pa.RecordBatch.from_arrays(
                    [batch.column(0).take(pa.array(rows + lo)), pa.array(texts, pa.binary())], [KEY, "z"]
                )

    return docs.select(row_key("doc_id", "text").alias(KEY), "text").mapInArrow(each, f"{KEY} binary, z binary")


def _pieces(batch: pa.RecordBatch, column: str):
    """(row of the batch, struct's fields as arrays) of a list<struct> column, flattened."""
    lists = batch.column(batch.schema.get_field_index(column))
    flat = lists.flatten()
    rows = np.repeat(np.arange(len(lists)), np.asarray(lists.value_lengths()))
    return rows, {f.name: flat.field(i).to_numpy(zero_copy_only=False) for i, f in enumerate(flat.type)}


def _contexts(places: DataFrame, length: int, unit: str, windows: bool) -> DataFrame:
    """Of anchors to compare, with their texts: contexts (the reach's units), or the windows' fingerprints."""

    def each(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        texts = zstandard.ZstdDecompressor()
        for whole in batches:
            for start in range(0, whole.num_rows, 200):
                batch = whole.slice(start, 200)
                owner, at = _pieces(batch, "anchors")
                packed = batch.column(1)
                held, row = np.empty(0, np.uint8), -1
                parts = []
                for i in range(len(owner)):
                    if owner[i] != row:
                        row = owner[i]
                        text = np.frombuffer(texts.decompress(packed[int(row)].as_py()), dtype=np.uint8)
                        held = Line(text, np.array([0, len(text)]), unit).values
                    parts.append(held[at["a"][i] : at["b"][i] + length].tobytes())
                out = pa.RecordBatch.from_arrays(
                    [
                        pa.array(at["key"]),
                        batch.column(0).take(pa.array(owner)),
                        pa.array(at["m"]),
                        pa.array(at["a"]),
                        pa.array(parts, pa.binary()),
                    ],
                    ["key", KEY, "m", "a", "context"],
                )
                if not windows:
                    yield out
                    continue
                for some in range(0, out.num_rows, 1000):
                    part = out.slice(some, 1000)
                    i, p, mark = _window_marks(part, length, unit)
                    yield pa.RecordBatch.from_arrays(
                        [pa.array(K.signed(mark)), part.column(0).take(pa.array(i)), part.column(1).take(pa.array(i)), pa.array(p)],
                        ["mark", "key", KEY, "p"],
                    )

    kind = f"mark long, key long, {KEY} binary, p long" if windows else f"key long, {KEY} binary, m long, a long, context binary"
    return places.select(KEY, "z", "anchors").mapInArrow(each, kind)


def _window_marks(batch: pa.RecordBatch, length: int, unit: str):
    """(row, position, fingerprint with the place relative to the anchor) of every window of the contexts."""
    contexts = batch.column(4).to_pylist()
    units = np.frombuffer(b"".join(contexts), dtype=np.uint8 if unit == "bytes" else K.U)
    sizes = np.array([len(x) for x in contexts], dtype=np.int64) // units.itemsize
    begins = np.r_[0, np.cumsum(sizes)]
    sums = K.prefix_sums(units)
    counts = sizes - length + 1
    i = np.repeat(np.arange(len(sizes)), counts)
    t = np.arange(len(i)) - np.repeat(np.cumsum(counts) - counts, counts)
    starts = begins[i] + t
    m, a = batch.column(2).to_numpy(), batch.column(3).to_numpy()
    p = a[i] + t
    marks = K.substring_hashes(sums, starts, starts + length)
    return i, p, K.mixed(marks + (m[i] - p).astype(K.U) * K.U(0x9FB21C651E98DF25))


def _runs(contexts: DataFrame, length: int, unit: str) -> DataFrame:
    """(row key, a, b) of window starts that are repeats, from contexts sorted by key in each partition."""

    def settled(batch: pa.RecordBatch) -> pa.RecordBatch:
        i, p, mark = _window_marks(batch, length, unit)
        key = batch.column(0).to_numpy().view(K.U)
        mark = K.mixed(mark ^ K.mixed(key)[i])
        _, inverse, counts = np.unique(mark, return_inverse=True, return_counts=True)
        hit = counts[inverse] > 1
        i, p = i[hit], p[hit]
        fresh = np.r_[True, (i[1:] != i[:-1]) | (p[1:] != p[:-1] + 1)] if len(i) else np.empty(0, bool)
        head = np.flatnonzero(fresh)
        tail = np.r_[head[1:], len(i)] - 1 if len(head) else head
        return pa.RecordBatch.from_arrays(
            [batch.column(1).take(pa.array(i[head])), pa.array(p[head]), pa.array(p[tail])], [KEY, "a", "b"]
        )

    def each(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[pa.RecordBatch] = []
        for batch in batches:
            for start in range(0, batch.num_rows, 1000):
                part = batch.slice(start, 1000)
                keys = part.column(0).to_numpy()
                last = int(np.searchsorted(keys, keys[-1], "left"))  # the last key may go on
                if last or (held and held[-1].column(0)[-1].as_py() != keys[0]):
                    held.append(part.slice(0, last))
                    full = pa.Table.from_batches(held).combine_chunks().to_batches()
                    if full:
                        yield settled(full[0])
                    held = []
                held.append(part.slice(last))
        if full := pa.Table.from_batches(held).combine_chunks().to_batches() if held else None:
            yield settled(full[0])

    return contexts.repartition("key").sortWithinPartitions("key").mapInArrow(each, f"{KEY} binary, a long, b long")


def _unpacked(packed: list[bytes]) -> Iterator[tuple[int, int, np.ndarray, np.ndarray]]:
    texts = zstandard.ZstdDecompressor()
    lo = 0
    while lo < len(packed):
        hi, size, parts = lo, 0, []
        while hi < len(packed) and (size < K.SLICE or hi == lo):
            parts.append(texts.decompress(packed[hi]))
            size += len(parts[-1])
            hi += 1
        offsets = np.r_[0, np.cumsum([len(x) for x in parts])]
        yield lo, hi, offsets, np.frombuffer(b"".join(parts), dtype=np.uint8)
        lo = hi


def _covered(spans: DataFrame, length: int, unit: str) -> DataFrame:
    """(row key, spans, n_removed, kept, kept_text): the union of the windows of each text taken out of it, in bytes."""

    def each(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            for start in range(0, whole.num_rows, 200):
                batch = whole.slice(start, 200)
                owner, at = _pieces(batch, "starts")
                out = {"spans": [], "n": [], "sha": [], "text": []}
                edges = np.searchsorted(owner, np.arange(batch.num_rows + 1))
                for lo, _, offsets, data in _unpacked(batch.column(1).to_pylist()):
                    line = Line(data, offsets, unit)
                    for k in range(len(offsets) - 1):
                        text = data[offsets[k] : offsets[k + 1]]
                        mine = slice(edges[lo + k], edges[lo + k + 1])
                        units = merged(at["a"][mine], at["b"][mine] + length)
                        first = line.offsets[k]
                        found = [tuple(int(x - offsets[k]) for x in line.bytes_of(first + a, first + b)) for a, b in units]
                        out["spans"].append([{"start": int(a), "end": int(b)} for a, b in found])
                        out["n"].append(int(sum(b - a for a, b in found)))
                        out["sha"].append(hashlib.sha256(_rest(text, found)).hexdigest())
                        out["text"].append(_rest(text, [_characters(text, a, b) for a, b in found]).decode("utf-8", "replace"))
                yield pa.RecordBatch.from_arrays(
                    [
                        batch.column(0),
                        pa.array(out["spans"], pa.list_(pa.struct([("start", pa.int64()), ("end", pa.int64())]))),
                        pa.array(out["n"], pa.int64()),
                        pa.array(out["sha"], pa.string()),
                        pa.array(out["text"], pa.string()),
                    ],
                    [KEY, "spans", "n_removed", "kept_sha256", "kept_text"],
                )

    kind = f"{KEY} binary, spans array<struct<start:long,end:long>>, n_removed long, kept_sha256 string, kept_text string"
    return spans.select(KEY, "z", "starts").mapInArrow(each, kind)


def merged(starts: np.ndarray, ends: np.ndarray) -> list[tuple[int, int]]:
    """The union of [start, end) as maximal runs."""
    order = np.argsort(starts, kind="stable")
    starts, ends = starts[order], np.maximum.accumulate(ends[order])
    head = np.flatnonzero(np.r_[True, starts[1:] > ends[:-1]])
    tail = np.r_[head[1:], len(starts)] - 1
    return list(zip(starts[head].tolist(), ends[tail].tolist(), strict=True))


def _characters(text: np.ndarray, a: int, b: int) -> tuple[int, int]:
    """[a, b) without characters of which it holds only a part."""
    while a < b and text[a] & 0xC0 == 0x80:
        a += 1
    while b > a and b < len(text) and text[b] & 0xC0 == 0x80:
        b -= 1
    return a, b


def _rest(text: np.ndarray, spans: list[tuple[int, int]]) -> bytes:
    keep = np.ones(len(text), dtype=bool)
    for a, b in spans:
        keep[a:b] = False
    return text[keep].tobytes()


def repeated_spans(
    docs: DataFrame, length: int = 400, batches: int = 4, group: int = GROUP, unit: str = "bytes"
) -> DataFrame:
    """(row key, spans, n_removed, kept_sha256, kept_text) of each row that holds a repeated string; spans in bytes.

    Texts are UTF-8 bytes. A byte is removed when some string of ``length`` bytes that covers it also starts at any
    other place of any row, overlapping ones included; strings are judged on the input, never across rows. With words
    as ``unit``, strings are of ``length`` words, and go from the first word's first byte to the last one's last. Null and
    short texts have none. Rows that agree in doc_id and text have one result. ``kept_text`` keeps characters that are
    only partly covered, ``kept_sha256`` is over the exact bytes. ``batches`` is how many batches go through the
    index; it does not change the result.
    """
    if length < 2:
        raise ValueError("length must be at least 2")
    texts = docs.select("doc_id", "text")
    family = IndexFamily(length, unit)
    keys = None
    part = F.pmod(F.xxhash64("text"), F.lit(batches))
    for k in range(batches):
        found = family.add(texts.filter(part == k))
        keys = found if keys is None else keys.unionByName(found)
    known = family.entries().join(keys.distinct(), "key", "left_semi")
    hulls = known.groupBy("key").agg(F.count(F.lit(1)).alias("hulls"))
    known = checkpointed(known.join(hulls, "key"))
    removed(docs.sparkSession, *[path for _, _, path in family.levels])

    at = checkpointed(_occurrences(texts, length, unit).join(known, ["key", "hull"]))
    touched = at.filter("n > 1 or hulls > 1").select(KEY).distinct()
    held = checkpointed(_packed(texts, length).join(touched, KEY, "left_semi").dropDuplicates([KEY]))

    anchor = F.struct("key", "m", "a", "b")
    one = at.filter("n > 1 and hulls > 1").groupBy("key", "hull", "hulls").agg(
        F.min(F.struct(KEY, "m", "a", "b")).alias("x")
    )
    to_compare = at.filter("n = 1 and hulls > 1").select(KEY, anchor.alias("anchor"), "hulls").unionByName(
        one.select(f"x.{KEY}", F.struct("key", "x.m", "x.a", "x.b").alias("anchor"), "hulls")
    )

    def places(which: str) -> DataFrame:
        grouped = to_compare.filter(which).groupBy(KEY).agg(F.collect_list("anchor").alias("anchors"))
        return held.join(grouped, KEY)

    small = _runs(_contexts(places(f"hulls <= {group}"), length, unit, windows=False), length, unit)
    rows = checkpointed(_contexts(places(f"hulls > {group}"), length, unit, windows=True))
    often = rows.groupBy("key", "mark").agg(F.count(F.lit(1)).alias("n")).filter("n > 1")
    large = rows.join(often, ["key", "mark"], "left_semi").select(KEY, F.col("p").alias("a"), F.col("p").alias("b"))
    starts = at.filter("n > 1").select(KEY, "a", "b").unionByName(small).unionByName(large)
    starts = starts.groupBy(KEY).agg(F.collect_list(F.struct("a", "b")).alias("starts"))
    return _covered(held.join(starts, KEY), length, unit)


def repeats_report(docs: DataFrame, length: int = 400, batches: int = 4, group: int = GROUP) -> DataFrame:
    """One row per document: doc_id, n_bytes, n_removed, n_spans, kept_sha256, kept_text; see :func:`repeated_spans`."""
    spans = checkpointed(repeated_spans(docs, length, batches, group))
    rows = docs.select(
        row_key("doc_id", "text").alias(KEY),
        "doc_id",
        F.octet_length(F.coalesce("text", F.lit(""))).cast("long").alias("n_bytes"),
        F.sha2(F.coalesce("text", F.lit("")), 256).alias("whole"),
        F.coalesce("text", F.lit("")).alias("text"),
    )
    return rows.join(spans, KEY, "left").select(
        "doc_id",
        "n_bytes",
        F.coalesce("n_removed", F.lit(0)).cast("long").alias("n_removed"),
        F.when(F.col("spans").isNull(), 0).otherwise(F.size("spans")).cast("long").alias("n_spans"),
        F.coalesce("kept_sha256", "whole").alias("kept_sha256"),
        F.coalesce("kept_text", "text").alias("kept_text"),
    )


def without_repeats(
    docs: DataFrame, length: int = 400, batches: int = 4, group: int = GROUP, unit: str = "bytes"
) -> DataFrame:
    """``docs`` with the repeated strings taken out of ``text`` (whole characters) and ``n_chars`` counted anew.

    All rows stay, also those left with an empty text. Null texts stay null; repeated rows lose the same.
    """
    spans = checkpointed(repeated_spans(docs, length, batches, group, unit).select(KEY, "kept_text"))
    names = docs.columns
    out = docs.withColumn(KEY, row_key("doc_id", "text")).join(spans, KEY, "left")
    out = out.withColumn("text", F.coalesce("kept_text", "text"))
    if "n_chars" in names:
        kind = docs.schema["n_chars"].dataType
        changed = F.when(F.col("kept_text").isNotNull(), F.length("kept_text").cast(kind))
        out = out.withColumn("n_chars", F.coalesce(changed, "n_chars"))
    return out.select(*names)
