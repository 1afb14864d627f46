"""Exact Jaccard join of word-shingle sets by partitioning the universe (pigeonhole).

Two sets of sizes a and b with Jaccard >= num/den differ in at most D = (den-num)(a+b)/(den+num) shingles. Every
shingle is hashed into one of M segments; a segment that both sets fill alike costs them no difference. So, of any
segments that carry D + 1 credits (one for an exact segment, two for one that also meets at one difference, by its
one-deletion neighbourhood), at least one must meet.

* Sizes fall into bands; a band fixes M and which segments get deletion neighbourhoods. A set is indexed under its
  own band, and under the next one if it can reach a set there.
* A set needs credits for its own D only, so it gives its first segments up to that (segment subsets). Segments of
  no or one shingle, which many sets share by chance, carry no credit, in both sets alike if they meet. A set that
  runs out of credits gives all segments that carry one, and then its segments of one shingle too, up to
  its need; only a set that runs out of those as well gives all its segments.
* Allocation is by cost: per band the number of segments with deletion neighbourhoods is the one with the least
  rows plus expected chance meetings, from the number and sizes of the band's sets. Sets with no or one shingle in
  such a segment all meet there.

Texts of equal words are one class from the start (``sid``, 128 bits of a cryptographic digest). Hashes of shingles only
propose pairs; links are decided on the words themselves. Inside a batch of rows only the first class
with a signature goes to the shuffle, so that a hot group is reduced before it. Signature groups are not expanded
into pairs: members are compared with a pivot (first by sizes and parities of their
shingles, which bound the difference from below, then by whole texts), links are closed to components, and only groups that still hold
several components are compared further, across components. No link that could join two components goes untested.
"""

from __future__ import annotations

import hashlib
import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import zstandard
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from venueops.llm import kernel as K
from venueops.llm.common import KEY, checkpointed, components, removed, row_key, written

TILE = 512  # sets of a block; groups of an eighth of it are compared pair by pair
CHANCE = 2e-4  # how likely two sets share a segment of one shingle, for the cost model


class Threshold:
    """Integer arithmetic of 'Jaccard of at least num/den' over sizes."""

    def __init__(self, num: int, den: int, ratio: float):
        self.num, self.den = num, den
        edges = [1]
        while edges[-1] < 1 << 40:
            edges.append(max(edges[-1] + 1, math.ceil(edges[-1] * max(ratio, den / num))))
        self.edges = np.array(edges, dtype=np.int64)

    def differences(self, size):
        """The most by which a set of this size can differ from any set it is similar to."""
        size = np.asarray(size, dtype=np.int64)
        return (self.den - self.num) * (size + size * self.den // self.num) // (self.den + self.num)

    def band(self, size):
        return np.searchsorted(self.edges, size, "right") - 1

    def reaches_next(self, size, band):
        return size * self.den >= self.edges[band + 1] * self.num


def allocation(threshold: Threshold, band: int, sets: int) -> tuple[int, int]:
    """(segments, how many of them with deletion neighbourhoods) of least cost for a band."""
    top = int(threshold.edges[band + 1]) - 1
    size = (int(threshold.edges[band]) + top) / 2
    need = int(threshold.differences(top)) + 1
    best = None
    for deep in sorted({0, 1, 2, need // 4, need // 2, (need + 1) // 2}):
        if 2 * deep > need + 1:
            continue
        exact = max(0, need - 2 * deep)
        spare = math.ceil(exact / 5) if exact > 1 else 0
        segments = deep + exact + spare
        load = size / segments
        rows = deep * (1 + load) + exact
        thin = math.exp(-load) * load  # one shingle in the segment
        bare = math.exp(-load) * (1 + load)  # at most one, so that the neighbourhood holds the empty segment
        cost = rows + sets * CHANCE * thin * (exact + 2 * deep) + sets * bare * bare * deep
        if best is None or cost < best[0]:
            best = (cost, segments, deep)
    return best[1], best[2]


def sets_of(data, offsets, n_words):
    """(shingles, their rows, size per row, 128-bit id per row) of the texts in a slice. The id is a cryptographic
    digest of the text's words, so that rows of one id have equal sets; equal sets of other words are found as links."""
    values, rows = K.distinct_grams(data, offsets, n_words)
    sizes = np.bincount(rows, minlength=len(offsets) - 1)
    digests = [hashlib.blake2b(x, digest_size=16).digest() for x in K.sequences(data, offsets)]
    return values, rows, sizes, np.frombuffer(b"".join(digests), dtype=K.U).reshape(-1, 2)


def parities(values: np.ndarray, rows: np.ndarray, sizes: np.ndarray) -> list[bytes]:
    """For each set, the parity of the number of its shingles in each of as many buckets as its size, rounded up to a
    power of two. Sets that differ in d shingles differ in at most d parities."""
    n = len(sizes)
    bits = 1 << np.maximum(6, np.ceil(np.log2(np.maximum(sizes, 1))).astype(np.int64))
    base = np.r_[0, np.cumsum(bits)]
    place = (K.mixed(values + K.U(0x2545F4914F6CDD1D)) & (bits[rows] - 1).astype(K.U)).astype(np.int64)
    odd = (np.bincount(base[rows] + place, minlength=base[-1]) & 1).astype(np.uint8)
    packed = np.packbits(odd, bitorder="little").tobytes()
    edges = base // 8
    return [packed[edges[i] : edges[i + 1]] for i in range(n)]


def _parity_distance(a: bytes, b: bytes) -> int:
    x, y = int.from_bytes(a, "little"), int.from_bytes(b, "little")
    m, n = 8 * len(a), 8 * len(b)
    while m > n:  # the larger one folds onto the smaller one's buckets
        m //= 2
        x = (x >> m) ^ (x & ((1 << m) - 1))
    while n > m:
        n //= 2
        y = (y >> n) ^ (y & ((1 << n) - 1))
    return (x ^ y).bit_count()


def _plausible(pairs: DataFrame, rows: DataFrame, threshold: Threshold) -> DataFrame:
    """``pairs`` (a, b) without those that sizes or parities prove to be too far apart."""
    num, den = threshold.num, threshold.den

    def each(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            n, m = batch.column(2).to_numpy(), batch.column(3).to_numpy()
            most = (den - num) * (n + m) // (den + num)
            left, right = batch.column(4).to_pylist(), batch.column(5).to_pylist()
            good = [
                most[i] >= abs(n[i] - m[i]) and _parity_distance(left[i], right[i]) <= most[i] for i in range(len(n))
            ]
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1)], ["a", "b"]).filter(pa.array(good, pa.bool_()))

    one = rows.filter("n > 0").select("sid", "n", "parity").dropDuplicates(["sid"])
    left = one.select(F.col("sid").alias("a"), F.col("n").alias("na"), F.col("parity").alias("pa"))
    right = one.select(F.col("sid").alias("b"), F.col("n").alias("nb"), F.col("parity").alias("pb"))
    joined = pairs.join(left, "a").join(right, "b").select("a", "b", "na", "nb", "pa", "pb")
    return joined.mapInArrow(each, "a binary, b binary")


def _binary(ids: np.ndarray) -> pa.Array:
    return pa.array([x.tobytes() for x in ids], type=pa.binary())


def classes(docs: DataFrame, n_words: int) -> DataFrame:
    """(row key, doc_id, sid, n, parity) of every row; no words: n is 0."""

    def each(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for lo, hi, offsets, data in K.slices(batch.column(2)):
                values, owners, sizes, ids = sets_of(data, offsets, n_words)
                part = batch.slice(lo, hi - lo)
                parity = pa.array(parities(values, owners, sizes), pa.binary())
                yield pa.RecordBatch.from_arrays(
                    [part.column(0), part.column(1), _binary(ids), pa.array(sizes, pa.int64()), parity],
                    [KEY, "doc_id", "sid", "n", "parity"],
                )

    rows = docs.select(row_key("doc_id", "text").alias(KEY), "doc_id", "text")
    kind = docs.schema["doc_id"].dataType.simpleString()
    return rows.mapInArrow(each, f"{KEY} binary, doc_id {kind}, sid binary, n long, parity binary")


def signatures_of(threshold, plan, values, rows, sizes):
    """(signature, row) of a slice's sets. plan: {scheme: (segments, deep)}."""
    signatures, owners = [], []
    bands = threshold.band(np.maximum(sizes, 1))
    for step in (0, 1):
        chosen = sizes > 0
        if step:
            chosen &= threshold.reaches_next(sizes, bands)
        docs = np.flatnonzero(chosen)
        if not len(docs):
            continue
        schemes = bands[docs] + step
        segments, deep = np.array([plan(int(s)) for s in schemes], dtype=np.int64).T
        need = threshold.differences(sizes[docs]) + 1
        base = np.r_[0, np.cumsum(segments)]
        local = np.full(len(sizes), -1, dtype=np.int64)
        local[docs] = np.arange(len(docs))
        inside = local[rows] >= 0
        v, d = values[inside], local[rows[inside]]
        place = (K.mixed(v ^ K.U(0x8CB92BA72F3D8DD7)) % segments[d].astype(K.U)).astype(np.int64)
        at = base[d] + place
        weight = K.mixed(v)
        sums = np.zeros(base[-1], dtype=K.U)
        np.add.at(sums, at, weight)
        filled = np.bincount(at, minlength=base[-1])
        owner = np.repeat(np.arange(len(docs)), segments)
        index = np.arange(base[-1]) - base[owner]
        far, kinds = index < deep[owner], []
        for least in (2, 1):
            credit = np.where(far, 2, (filled >= least).astype(np.int64))
            run = np.cumsum(credit)
            before = run - credit - np.r_[0, run][base[owner]]
            total = run[base[1:] - 1] - np.r_[0, run][base[:-1]]
            kinds.append((credit > 0, before < need[owner], (total < need)[owner]))
        (full, first, poor), (some, early, out_of_all) = kinds
        given = np.where(poor, full | (some & early) | out_of_all, full & first)
        salt = K.mixed(schemes[owner].astype(K.U) * K.U(0x9FB21C651E98DF25) + index.astype(K.U))
        out = np.flatnonzero(given)
        signatures.append(K.mixed(sums[out] + salt[out]))
        owners.append(docs[owner[out]])
        less = np.flatnonzero(given[at] & (place < deep[d]))
        if len(less):
            signatures.append(K.mixed(sums[at[less]] - weight[less] + salt[at[less]]))
            owners.append(docs[d[less]])
    if not signatures:
        return np.empty(0, K.U), np.empty(0, np.int64)
    return np.concatenate(signatures), np.concatenate(owners)


def _signatures(docs: DataFrame, n_words: int, threshold: Threshold, counts: dict[int, int]) -> DataFrame:
    """(sig, occ, pivot, sid). ``occ`` is a class in a batch, a small number, of which one row with the ``sid`` and no
    signature tells the class. Of each batch, the first class with a signature has no pivot, the others have that
    first one as theirs. Another scan may cut other batches, so all kinds have to come from one."""
    plans: dict[int, tuple[int, int]] = {}

    def plan(scheme: int) -> tuple[int, int]:
        if scheme not in plans:
            plans[scheme] = allocation(threshold, scheme, counts.get(scheme, 0) + counts.get(scheme - 1, 0))
        return plans[scheme]

    def each(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        number = TaskContext.get().partitionId() << 40
        names = ["sig", "occ", "pivot", "sid"]
        for batch in batches:
            ids, found, owners, rows_before = [], [], [], 0
            for _, _, offsets, data in K.slices(batch.column(0)):
                values, rows, sizes, own = sets_of(data, offsets, n_words)
                _, first = np.unique(own, axis=0, return_index=True)  # one row of each class is enough
                once = np.zeros(len(sizes), dtype=bool)
                once[first] = True
                kept = once[rows]
                signature, owner = signatures_of(threshold, plan, values[kept], rows[kept], np.where(once, sizes, 0))
                ids.append(own)
                found.append(signature)
                owners.append(owner + rows_before)
                rows_before += len(own)
            if not rows_before:
                continue
            ids, found, owners = np.concatenate(ids), np.concatenate(found), np.concatenate(owners)
            used, owners = np.unique(owners, return_inverse=True)
            sids, place = np.unique(ids[used], axis=0, return_inverse=True)
            occ = number + place.reshape(-1)[owners]
            order = np.lexsort((occ, found))
            found, occ = found[order], occ[order]
            head = np.r_[True, found[1:] != found[:-1]] if len(found) else np.empty(0, bool)
            pivot = occ[np.maximum.accumulate(np.where(head, np.arange(len(head)), 0))]
            out = np.flatnonzero(head | (occ != pivot))
            none = pa.nulls(len(sids), pa.int64())
            yield pa.RecordBatch.from_arrays([none, pa.array(np.arange(number, number + len(sids))), none, _binary(sids)], names)
            number += len(sids)
            for some in np.array_split(out, max(1, len(out) // 200_000)):
                pivots = pa.array(pivot[some], mask=head[some])
                no_names = pa.nulls(len(some), pa.binary())
                yield pa.RecordBatch.from_arrays([pa.array(K.signed(found[some])), pa.array(occ[some]), pivots, no_names], names)

    return docs.select("text").mapInArrow(each, "sig long, occ long, pivot long, sid binary")


def _texts(docs: DataFrame, n_words: int) -> DataFrame:
    """(sid, z): the compressed text of each class, once a batch."""

    def each(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        pack = zstandard.ZstdCompressor(level=1)
        for batch in batches:
            seen = set()
            for _, _, offsets, data in K.slices(batch.column(0)):
                _, _, sizes, ids = sets_of(data, offsets, n_words)
                names, packed = [], []
                for i in np.flatnonzero(sizes):
                    if (name := ids[i].tobytes()) not in seen:
                        seen.add(name)
                        names.append(name)
                        packed.append(pack.compress(data[offsets[i] : offsets[i + 1]].tobytes()))
                yield pa.RecordBatch.from_arrays(
                    [pa.array(names, pa.binary()), pa.array(packed, pa.binary())], ["sid", "z"]
                )

    return docs.select("text").mapInArrow(each, "sid binary, z binary")


def _joined(packed: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
    texts = zstandard.ZstdDecompressor()
    parts = [texts.decompress(x) for x in packed]
    return np.r_[0, np.cumsum([len(x) for x in parts])], np.frombuffer(b"".join(parts), dtype=np.uint8)


def overlaps(left: tuple, right: tuple, n: int) -> np.ndarray:
    """Size of the intersection of each row's two sets, given as (shingles, rows)."""
    values = np.concatenate([left[0], right[0]])
    rows = np.concatenate([left[1], right[1]])
    order = np.lexsort((values, rows))
    values, rows = values[order], rows[order]
    same = (values[1:] == values[:-1]) & (rows[1:] == rows[:-1])
    return np.bincount(rows[1:][same], minlength=n)


def _verified(pairs: DataFrame, texts: DataFrame, n_words: int, threshold: Threshold) -> DataFrame:
    """The pairs (a, b) whose sets are similar, by their whole texts."""
    num, den = threshold.num, threshold.den

    def each(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            packed = [batch.column(2).to_pylist(), batch.column(3).to_pylist()]
            lengths = [zstandard.frame_content_size(a) + zstandard.frame_content_size(b) for a, b in zip(*packed, strict=True)]
            done = np.r_[0, np.cumsum(lengths)]
            start = 0
            while start < batch.num_rows:
                end = max(start + 1, int(np.searchsorted(done, done[start] + 4 * K.SLICE, "right")) - 1)
                part = batch.slice(start, end - start)
                n = part.num_rows
                offsets, data = _joined([*packed[0][start:end], *packed[1][start:end]])
                values, rows = K.exact_grams(data, offsets, n_words)
                first = rows < n
                sides = [(values[first], rows[first]), (values[~first], rows[~first] - n)]
                both = overlaps(*sides, n)
                sizes = [np.bincount(rows, minlength=n) for _, rows in sides]
                good = den * both >= num * (sizes[0] + sizes[1] - both)
                yield pa.RecordBatch.from_arrays(
                    [part.column(0), part.column(1)], ["a", "b"]
                ).filter(pa.array(good))
                start = end

    left = texts.select(F.col("sid").alias("a"), F.col("z").alias("za"))
    right = texts.select(F.col("sid").alias("b"), F.col("z").alias("zb"))
    joined = pairs.join(left, "a").join(right, "b").select("a", "b", "za", "zb")
    return joined.mapInArrow(each, "a binary, b binary")


def linked(docs: DataFrame, n_words: int, num: int, den: int, ratio: float) -> tuple[DataFrame, DataFrame]:
    """(classes, labels): every row's class (see :func:`classes`), and (sid, label, the component's smallest sid)
    of the classes that have a link to a different set."""
    spark = docs.sparkSession
    threshold = Threshold(num, den, ratio)
    rows = checkpointed(classes(docs, n_words))
    edges = F.array(*[F.lit(int(x)) for x in threshold.edges])
    band = F.size(F.filter(edges, lambda x: x <= F.col("n"))) - 1
    counts = {  # a row for each band, of which there are as many as the sizes have digits
        r["band"]: r["sets"]
        for r in rows.filter("n > 0").groupBy(band.alias("band")).agg(F.count(F.lit(1)).alias("sets")).collect()
    }

    # A signature has at most a row of each batch here. Numbers of classes in batches keep these rows narrow.
    same = Window.partitionBy("sig")
    signatures, path = written(_signatures(docs, n_words, threshold, counts))
    met = (
        signatures.filter("sig is not null and pivot is null")
        .select("sig", "occ", F.min("occ").over(same).alias("pivot"), F.max("occ").over(same).alias("other"))
        .filter("pivot <> other")
        .select("sig", "occ", "pivot")
    )
    members = checkpointed(met.unionByName(signatures.filter("pivot is not null").select("sig", "occ", "pivot")))
    names = checkpointed(signatures.filter("sid is not null").select("occ", "sid"))
    removed(spark, path)

    occurrences = checkpointed(members.filter("occ <> pivot").select("occ", "pivot").distinct())
    left, right = names.select("occ", F.col("sid").alias("x")), names.select(F.col("occ").alias("pivot"), F.col("sid").alias("y"))
    met_pairs = checkpointed(
        occurrences.join(left, "occ")
        .join(right, "pivot")
        .filter("x <> y")
        .select(F.least("x", "y").alias("a"), F.greatest("x", "y").alias("b"))
        .distinct()
    )
    pairs = checkpointed(_plausible(met_pairs, rows, threshold))
    needed = members.select("occ").unionByName(members.select(F.col("pivot").alias("occ"))).distinct()
    needed = needed.join(names, "occ").select("sid").distinct()
    texts = checkpointed(_texts(docs, n_words).join(needed, "sid", "left_semi").dropDuplicates(["sid"]))
    links = checkpointed(_verified(pairs, texts, n_words, threshold))
    labels = checkpointed(components(links))

    # Signature groups that still hold several components: some member's differs from its pivot's. Only those groups'
    # members are named and moved; components go by a small number meanwhile.
    placed = names.join(labels.withColumnRenamed("node", "sid"), "sid", "left").select(
        "occ", "sid", F.coalesce("label", "sid").alias("label")
    )
    placed = checkpointed(placed)
    numbers = placed.groupBy("label").agg(F.min("occ").alias("component"))
    numbered = checkpointed(placed.join(numbers, "label").select("occ", "component"))
    of_pivot = numbered.select(F.col("occ").alias("pivot"), F.col("component").alias("pivot_component"))
    strangers = occurrences.join(numbered, "occ").join(of_pivot, "pivot").filter("component <> pivot_component")
    strangers = checkpointed(strangers.select("occ", "pivot"))
    apart = checkpointed(members.join(strangers, ["occ", "pivot"], "left_semi").select("sig").distinct())
    inside = checkpointed(members.join(apart, "sig", "left_semi"))
    everyone = inside.select("sig", "occ").unionByName(inside.select("sig", F.col("pivot").alias("occ"))).distinct()
    placed, path = written(everyone.join(placed, "occ").select("sig", "sid", "label").distinct())
    mixed = (
        placed.groupBy("sig")
        .agg(F.min("label").alias("x"), F.max("label").alias("y"), F.count(F.lit(1)).alias("sids"), F.min("sid").alias("first"))
        .filter("x <> y")
    )
    mixed = checkpointed(mixed.select("sig", "sids", "first"))
    few = placed.join(mixed.filter(f"sids <= {TILE // 8}").select("sig"), "sig", "left_semi")
    across = (
        few.alias("p")
        .join(few.alias("q"), F.expr("p.sig = q.sig and p.label < q.label"))
        .select(F.least("p.sid", "q.sid").alias("a"), F.greatest("p.sid", "q.sid").alias("b"))
        .distinct()
        .join(met_pairs, ["a", "b"], "left_anti")
    )
    across = checkpointed(_plausible(across, rows, threshold))
    many = placed.join(mixed.filter(f"sids > {TILE // 8}"), "sig").select(F.col("first").alias("a"), F.col("sid").alias("b"))
    more = checkpointed(
        _verified(across, texts, n_words, threshold).unionByName(
            _verified_in_tiles(checkpointed(many.distinct()), texts, n_words, threshold)
        )
    )
    if not more.isEmpty():
        labels = checkpointed(components(links.unionByName(more)))
    removed(spark, path)
    return rows, labels.select(F.col("node").alias("sid"), "label")


def _verified_in_tiles(many: DataFrame, texts: DataFrame, n_words: int, threshold: Threshold) -> DataFrame:
    """Links enough to connect what is connected among the sets of large signature groups, given as (a, b) with one
    a for each group.

    Groups that overlap are one cluster; a cluster is cut into blocks of about ``TILE`` sets, and each pair of
    blocks is one task, which compares its sets by counting products and returns a spanning forest, no pairs.
    """
    num, den = threshold.num, threshold.den
    inside = components(many)  # a group's first set is in it, and a group has more than one
    sizes = inside.groupBy("label").agg(F.count(F.lit(1)).alias("sets"))
    blocks = F.ceil(F.col("sets") / TILE).cast("int")
    dealt = (
        inside.join(checkpointed(sizes), "label")
        .withColumn("blocks", blocks)
        .withColumn("own", F.pmod(F.xxhash64("node"), F.col("blocks")).cast("int"))
        .withColumn("other", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)))
        .select(
            "label",
            F.least("own", "other").alias("i"),
            F.greatest("own", "other").alias("j"),
            (F.col("own") <= F.col("other")).alias("left"),
            (F.col("own") >= F.col("other")).alias("right"),
            F.col("node").alias("sid"),
        )
        .join(texts, "sid")
    )

    def each(tile: pa.Table) -> pa.Table:
        tile = tile.combine_chunks()
        n = tile.num_rows
        offsets, data = _joined(tile.column("z").to_pylist())
        values, rows = K.exact_grams(data, offsets, n_words)
        sizes = np.bincount(rows, minlength=n)
        _, column, spread = np.unique(values, return_inverse=True, return_counts=True)
        shared = spread[column] > 1
        column, rows = column[shared], rows[shared]
        order = np.argsort(column, kind="stable")
        column, rows = column[order], rows[order]
        both = np.zeros((n, n), dtype=np.float32)
        edges = np.r_[0, np.cumsum(spread[spread > 1])]
        step = 2048
        for k in range(0, len(edges) - 1, step):
            lo, hi = edges[k], edges[min(k + step, len(edges) - 1)]
            has = np.zeros((n, min(step, len(edges) - 1 - k)), dtype=np.float32)
            has[rows[lo:hi], np.searchsorted(edges, np.arange(lo, hi), "right") - 1 - k] = 1
            both += has @ has.T
        count = both.astype(np.int64)
        good = den * count >= num * (sizes[:, None] + sizes[None, :] - count)
        left = tile.column("left").to_numpy(zero_copy_only=False)
        right = tile.column("right").to_numpy(zero_copy_only=False)
        good &= (left[:, None] & right[None, :]) | (right[:, None] & left[None, :])
        a, b = spanning(good)
        sid = tile.column("sid").combine_chunks()
        return pa.table({"a": sid.take(pa.array(a)), "b": sid.take(pa.array(b))})

    return dealt.groupBy("label", "i", "j").applyInArrow(each, "a binary, b binary")


def spanning(good: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Edges of a spanning forest of a symmetric matrix of links."""
    n = len(good)
    waiting = np.ones(n, dtype=bool)
    a, b = [], []
    for root in range(n):
        if not waiting[root]:
            continue
        waiting[root] = False
        front = [root]
        while front:
            x = front.pop()
            fresh = np.flatnonzero(good[x] & waiting)
            waiting[fresh] = False
            a.extend([x] * len(fresh))
            b.extend(fresh.tolist())
            front.extend(fresh.tolist())
    return np.array(a, dtype=np.int64), np.array(b, dtype=np.int64)


def component_ids(rows: DataFrame, labels: DataFrame) -> DataFrame:
    """(sid, component_id): the smallest doc_id of the component, for the classes of more than one row or a link."""
    by_class = rows.filter("n > 0").groupBy("sid").agg(F.min("doc_id").alias("doc_id"), F.count(F.lit(1)).alias("rows"))
    placed = by_class.join(labels, "sid", "left").filter("rows > 1 or label is not null")
    placed = checkpointed(placed.select("sid", "doc_id", F.coalesce("label", "sid").alias("label")))
    smallest = placed.groupBy("label").agg(F.min("doc_id").alias("component_id"))
    return checkpointed(placed.join(smallest, "label").select("sid", "component_id"))


def jaccard_components(docs: DataFrame, n_words: int = 5, num: int = 80, den: int = 100, ratio: float = 2.0) -> DataFrame:
    """One row per document: (row key, doc_id, n_shingles, component_id, sid).

    Words are runs without white space, A-Z in lower case. Two documents link when den * intersection is at
    least num * union of their sets of ``n_words``-word shingles; a text with fewer words has its whole sequence as
    its one shingle. Texts that are null or have no words link with nothing, not even each other. Components
    close the links; component_id is the smallest doc_id in it (nulls last; null if there is none but null). Rows
    with equal texts are separate rows of one component, also under the same doc_id. An empty table gives no rows.
    """
    rows, labels = linked(docs, n_words, num, den, ratio)
    ids = component_ids(rows, labels)
    return rows.join(ids, "sid", "left").select(
        KEY, "doc_id", F.col("n").alias("n_shingles"), F.coalesce("component_id", "doc_id").alias("component_id"), "sid"
    )


def one_of_each(docs: DataFrame, n_words: int = 5, num: int = 80, den: int = 100, ratio: float = 2.0) -> DataFrame:
    """``docs`` without the rows that have a similar document of smaller doc_id in their component.

    Of rows that agree in doc_id and text one stays, and of one doc_id with several texts in a component one text.
    Null texts and those without words all stay. A null doc_id comes last; an empty table stays empty.
    """
    found = checkpointed(jaccard_components(docs, n_words, num, den, ratio).filter("n_shingles > 0"))
    first = found.filter("doc_id <=> component_id").groupBy("component_id").agg(F.min(KEY).alias("first"))
    dropped = (
        found.join(first, found["component_id"].eqNullSafe(first["component_id"]), "left")
        .filter(f"first is not null and {KEY} <> first")
        .select(KEY)
        .distinct()
    )
    kept = docs.withColumn(KEY, row_key("doc_id", "text")).join(checkpointed(dropped), KEY, "left_anti")
    twice = found.groupBy(KEY).agg(F.count(F.lit(1)).alias("rows")).filter("rows > 1").select(KEY)
    twice = checkpointed(twice)
    repeated = kept.join(twice, KEY, "left_semi").dropDuplicates([KEY])
    return kept.join(twice, KEY, "left_anti").unionByName(repeated).drop(KEY)
