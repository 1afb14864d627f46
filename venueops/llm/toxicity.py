"""Toxicity by compression distance: zstandard dictionaries, one trained on ordinary text, two on toxic text.

Windows are single words and runs of ``SPAN`` words. Each is compressed after a fixed carrier (a stretch of the
ordinary dictionary that costs one match) with the ordinary dictionary alone and with the ordinary and each toxic one;
the difference of the lengths says how much the toxic text explains of it. All compressors see the ordinary
dictionary at the same distances, so that the difference comes from toxic text alone.

One toxic dictionary is trained on the whole toxic samples. The other is trained on those words and phrases of two
or three words in them that are more frequent, by documents, than chance lets any be that is as frequent in
ordinary samples. A document's largest differences and its counts of windows beyond several thresholds are calibrated
to a probability by a logistic fit on samples that the dictionaries have not seen.
"""

from __future__ import annotations

import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import zstandard
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from venueops.llm import kernel as K
from venueops.llm.common import KEY, row_key

TOXIC_SAMPLE, ORDINARY_SAMPLE, SAMPLE_BYTES = 2000, 5000, 16_000  # most texts per class, and bytes of a text
THRESHOLDS = (3, 4, 5, 6)
SPAN = 8  # words of a wide window, one starting every half of it
PHRASES = (2, 3)
SURPRISE = 12  # nats: exp(12) is about the number of words and phrases that are looked at
LEVEL = 3
PIECE = 256  # bytes of an ordinary sample that the dictionary is trained on; chosen on a split of the rows not held out
MODEL = "ordinary binary, toxic array<binary>, center binary, scale binary, weights binary"
WORD = re.compile(rb"[0-9a-z\x80-\xff]+")
LOWER = bytes(i + 32 if 65 <= i <= 90 else i for i in range(256))


def held_out(doc_id):
    return F.coalesce(F.crc32(doc_id.cast("string")) % 4 == 2, F.lit(False))


class Model:
    """Dictionaries and calibration; small enough to be shipped with a task."""

    def __init__(self, prior: float, ordinary: bytes = b"", toxic: tuple[bytes, ...] = ()):
        self.prior, self.ordinary, self.toxic = prior, ordinary, toxic
        self.center = self.scale = self.weights = None

    def row(self) -> pa.RecordBatch:
        """One row of the columns ``MODEL``; without a fit, all but the dictionaries are null."""
        numbers = [None if x is None else x.tobytes() for x in (self.center, self.scale, self.weights)]
        columns = [pa.array([self.ordinary], pa.binary()), pa.array([list(self.toxic)], pa.list_(pa.binary()))]
        columns += [pa.array([x], pa.binary()) for x in numbers]
        return pa.RecordBatch.from_arrays(columns, ["ordinary", "toxic", "center", "scale", "weights"])

    @classmethod
    def of(cls, prior: float, row) -> Model:
        model = cls(prior, bytes(row["ordinary"]), tuple(bytes(x) for x in row["toxic"]))
        if row["weights"] is not None:
            model.center, model.scale, model.weights = (np.frombuffer(row[x]) for x in ("center", "scale", "weights"))
        return model

    def compressors(self):
        """The ordinary one and one for each toxic dictionary."""

        def one(content: bytes):
            held = zstandard.ZstdCompressionDict(content, dict_type=zstandard.DICT_TYPE_RAWCONTENT)
            held.precompute_compress(level=LEVEL)
            return zstandard.ZstdCompressor(
                dict_data=held, level=LEVEL, write_content_size=False, write_checksum=False, write_dict_id=False
            )

        most = max(map(len, self.toxic))
        return [one(self.ordinary + bytes(most - len(x)) + x) for x in (bytes(most), *self.toxic)]

    def features(self, data: np.ndarray, offsets: np.ndarray, tools: list, memo: dict[str, list[int]]) -> np.ndarray:
        """A row for each text of the slice."""
        n = len(offsets) - 1
        distinct, codes, rows = K.tokens(data, offsets, "punctuation")
        each = 4 + len(THRESHOLDS)
        out = np.zeros((n, 2 * len(self.toxic) * each + 1))
        if not len(codes):
            return out
        names = distinct.to_pylist()
        spelled = [x.encode() for x in names]
        carrier = self.ordinary[-40:]
        unseen = [k for k, x in enumerate(names) if x not in memo]
        fresh = _gains([carrier + b" " + spelled[k] + b" " for k in unseen], tools)
        memo.update(zip([names[k] for k in unseen], fresh.tolist(), strict=True))
        single = np.array([memo[x] for x in names], dtype=np.float64)[codes]
        if len(memo) > 150_000:  # values can be computed again
            memo.clear()
        count = np.bincount(rows, minlength=n)
        begin = np.cumsum(count) - count
        # wide windows begin at every half of a span as long as they reach words that the one before does not
        place = np.arange(len(rows)) - begin[rows]
        heads = np.flatnonzero((place % (SPAN // 2) == 0) & ((place == 0) | (place + SPAN // 2 < count[rows])))
        tails = np.minimum(heads + SPAN, (begin + count)[rows[heads]])
        joined = b" " + b" ".join([spelled[k] for k in codes.tolist()]) + b" "
        at = np.r_[0, np.cumsum(np.array([len(x) for x in spelled])[codes] + 1)]
        spans = zip(at[heads].tolist(), at[tails].tolist(), strict=True)
        wide = _gains([carrier + joined[a : b + 1] for a, b in spans], tools)
        column = 0
        for owners, values in ((rows, single), (rows[heads], wide.astype(np.float64))):
            for gain in values.T:
                out[:, column : column + each] = _summary(gain, owners, n)
                column += each
        out[:, -1] = np.log1p(count)
        return out

    def scores(self, features: np.ndarray) -> np.ndarray:
        if self.weights is None:
            return np.full(len(features), self.prior)
        x = np.c_[(features - self.center) / self.scale, np.ones(len(features))]
        return 1 / (1 + np.exp(-np.clip(x @ self.weights, -30, 30)))

    def calibrate(self, features: np.ndarray, labels: np.ndarray) -> None:
        self.center, self.scale = features.mean(axis=0), features.std(axis=0) + 1e-9
        x = np.c_[(features - self.center) / self.scale, np.ones(len(features))]
        share = np.where(labels == 1, self.prior / max(1, labels.sum()), (1 - self.prior) / max(1, (1 - labels).sum()))
        w = np.zeros(x.shape[1])
        for _ in range(3000):
            p = 1 / (1 + np.exp(-np.clip(x @ w, -30, 30)))
            w -= 0.5 * (x.T @ (share * (p - labels)) + 1e-4 * w)
        self.weights = w


def _gains(windows: list[bytes], tools: list) -> np.ndarray:
    """For each window and each toxic dictionary, by how much it shortens the window beyond the ordinary one."""
    if not windows:
        return np.empty((0, len(tools) - 1), dtype=np.int64)
    sizes = np.array([len(x) for x in windows], dtype="<u8")
    segments = np.stack([np.cumsum(sizes, dtype="<u8") - sizes, sizes], axis=1).tobytes()
    flat = zstandard.BufferWithSegments(b"".join(windows), segments)
    lengths = [np.array([len(x) for x in tool.multi_compress_to_buffer(flat, threads=1)]) for tool in tools]
    return np.stack([lengths[0] - x for x in lengths[1:]], axis=1)


def _summary(gain: np.ndarray, rows: np.ndarray, n: int) -> np.ndarray:
    """For each row the mean of its largest one, two and four gains and of all, and how many reach each threshold."""
    out = np.zeros((n, 4 + len(THRESHOLDS)))
    order = np.lexsort((-gain, rows))
    count = np.bincount(rows, minlength=n)
    begin = np.cumsum(count) - count
    for column, most in enumerate((1, 2, 4)):
        total = np.zeros(n)
        for k in range(most):
            has = count > k
            total[has] += gain[order[begin[has] + k]]
        out[:, column] = total / most
    out[:, 3] = np.bincount(rows, weights=gain, minlength=n) / np.maximum(count, 1)
    for k, least in enumerate(THRESHOLDS):
        out[:, 4 + k] = np.log1p(np.bincount(rows, weights=gain >= least, minlength=n))
    return out


def _dictionary(samples: list[bytes], size: int) -> bytes:
    try:
        return zstandard.train_dictionary(size, samples).as_bytes()
    except zstandard.ZstdError:  # too little to train on: the samples themselves
        return b"".join(samples)[-size:]


def _surprise(count, expected):
    """How far ``count`` is beyond what is expected, in nats of a Poisson law; 0 where it is not."""
    count = np.asarray(count, dtype=np.float64)
    return np.where(count > expected, count * np.log(np.maximum(count, 1) / expected) - (count - expected), 0)


def _in_texts(rows: np.ndarray, parts: np.ndarray, m: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(distinct parts, in how many of the first ``m`` texts each is, in how many of the others)."""
    distinct, code = np.unique(parts, return_inverse=True)
    pairs = np.unique(rows * max(1, len(distinct)) + code)
    toxic = pairs < m * max(1, len(distinct))
    counts = (np.bincount(pairs[side] % max(1, len(distinct)), minlength=len(distinct)) for side in (toxic, ~toxic))
    return distinct, *counts


def _telling(toxic: list[bytes], ordinary: list[bytes]) -> list[bytes]:
    """Each toxic text's words and phrases whose frequency among toxic texts is a surprise of ``SURPRISE``.

    Words are judged as a whole and by their beginnings of 4 to 9 bytes.
    """
    m, n = len(toxic), len(ordinary)
    data = np.frombuffer(b"".join([*toxic, *ordinary]), dtype=np.uint8)
    distinct, codes, rows = K.tokens(data, np.r_[0, np.cumsum([len(x) for x in (*toxic, *ordinary)])], "punctuation")

    def surprising(owners: np.ndarray, parts: np.ndarray) -> np.ndarray:
        values, in_toxic, in_ordinary = _in_texts(owners, parts, m)
        return values[_surprise(in_toxic, m * (in_ordinary + 0.5) / n) >= SURPRISE]

    spelled = distinct.cast(pa.large_binary())
    sizes = pc.binary_length(spelled).to_numpy()
    good = np.zeros(len(distinct), dtype=bool)
    good[surprising(rows, codes)] = True
    for size in range(4, 10):
        long = np.flatnonzero(sizes >= size)
        beginning = np.full(len(distinct), -1, dtype=np.int64)
        cut = pc.binary_slice(spelled.take(pa.array(long)).cast(pa.binary()), 0, size)
        beginning[long] = cut.dictionary_encode().indices.to_numpy()
        part = beginning[codes]
        here = part >= 0
        good |= np.isin(beginning, surprising(rows[here], part[here])) & (beginning >= 0)
    kept = good[codes]
    phrase = codes
    for size in range(2, max(PHRASES) + 1):  # a phrase is the one before and the next word, in one text
        phrase = np.unique(phrase, return_inverse=True)[1][: len(codes) - size + 1] * max(1, len(distinct)) + codes[size - 1 :]
        whole = rows[size - 1 :] == rows[: len(phrase)]
        if size in PHRASES:
            for first in np.flatnonzero(whole & np.isin(phrase, surprising(rows[: len(phrase)][whole], phrase[whole]))).tolist():
                kept[first : first + size] = True
    out = [b""] * m
    last = -2
    for k in np.flatnonzero(kept & (rows < m)).tolist():
        apart = k != last + 1 or rows[k] != rows[last]
        out[rows[k]] += (b"  " if apart else b" ") + spelled[codes[k]].as_py()
        last = k
    return [x[1:] + b" " for x in out if x]


def train(toxic: list[str], ordinary: list[str], prior: float) -> Model:
    """Two thirds of the samples make the dictionaries, a third the calibration."""
    toxic, ordinary = ([x.encode().translate(LOWER) for x in side] for side in (toxic, ordinary))
    if len(toxic) < 3 or len(ordinary) < 3:
        return Model(prior)
    learn = [[x for i, x in enumerate(side) if i % 3] for side in (ordinary, toxic)]
    telling = _dictionary(_telling(learn[1], learn[0]), 16 << 10)
    normal = [[b" " + b" ".join(WORD.findall(x)) + b" " for x in side] for side in learn]
    del learn
    pieces = [x[i : i + PIECE] for x in normal[0] for i in range(0, len(x), PIECE)]
    model = Model(prior, _dictionary(pieces, 24 << 10), (_dictionary(normal[1], 16 << 10), telling))
    del normal, pieces
    rest = toxic[::3] + ordinary[::3]
    labels = np.r_[np.ones(len(toxic[::3])), np.zeros(len(ordinary[::3]))]
    offsets = np.r_[0, np.cumsum([len(x) for x in rest])]
    data = np.frombuffer(b"".join(rest), dtype=np.uint8)
    memo, parts = {}, []
    tools = model.compressors()
    for k in range(0, len(rest), 500):
        edges = offsets[k : k + 501]
        parts.append(model.features(data[edges[0] : edges[-1]], edges - edges[0], tools, memo))
    model.calibrate(np.concatenate(parts), labels)
    return model


def fitted(docs: DataFrame, labels: DataFrame) -> Model:
    """A model from at most ``TOXIC_SAMPLE`` and ``ORDINARY_SAMPLE`` labelled texts of up to ``SAMPLE_BYTES`` bytes that
    are not held out, those of least hash; the prior comes from all labels that are not held out."""
    known = labels.filter(~held_out(F.col("doc_id")) & F.col("toxic").isin(0, 1)).select("doc_id", "toxic").distinct()
    counts = {r["toxic"]: r["rows"] for r in known.groupBy("toxic").agg(F.count(F.lit(1)).alias("rows")).collect()}
    prior = counts.get(1, 0) / max(1, sum(counts.values()))
    samples = None
    for label, most in ((1, TOXIC_SAMPLE), (0, ORDINARY_SAMPLE)):
        some = known.filter(F.col("toxic") == label).orderBy(F.md5(F.col("doc_id").cast("string")), "doc_id").limit(most)
        rows = (
            docs.join(F.broadcast(some.select("doc_id")), "doc_id")  # at most ``most`` ids
            .filter(F.octet_length("text").between(1, SAMPLE_BYTES))
            .select(F.md5(F.col("doc_id").cast("string")).alias("at"), "text")
            .dropDuplicates(["text"])
            .orderBy("at", "text")
            .limit(most)
            .select(F.lit(label).alias("label"), "at", "text")
        )
        samples = rows if samples is None else samples.unionByName(rows)

    def fit(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        texts: dict[int, list[str]] = {1: [], 0: []}
        for batch in batches:
            for label, text in zip(batch.column(0).to_pylist(), batch.column(2).to_pylist(), strict=True):
                texts[label].append(text)
        yield train(texts[1], texts[0], prior).row()

    # bounded samples, fitted by a task, so that the driver gets dictionaries and weights only
    sorted_samples = samples.coalesce(1).sortWithinPartitions("label", "at", "text")
    found = sorted_samples.mapInArrow(fit, MODEL).collect()
    return Model.of(prior, found[0]) if found else Model(prior)


def _scores(tool: Model, tools: list, memo: dict, texts: pa.Array) -> Iterator[tuple[int, int, np.ndarray]]:
    """(from, to, scores) of runs of the texts."""
    for lo, hi, offsets, data in K.slices(texts):
        found = np.zeros((hi - lo, 1)) if tool.weights is None else tool.features(data, offsets, tools, memo)
        yield lo, hi, tool.scores(found)


def scored(docs: DataFrame, labels: DataFrame, threshold: float = 0.3) -> DataFrame:
    """One row per document: doc_id, held_out, score (0 to 1), predicted (1 from ``threshold`` on), and the row key.

    Whole texts are scored, by their text alone; null and empty texts get the score of a text without words. Rows
    whose crc32(doc_id) mod 4 is 2 are held out from training; a null doc_id is not held out. Without samples of
    both classes every score is the share of toxic labels (0 without labels). Equal texts have equal scores.
    """
    model = docs.sparkSession.sparkContext.broadcast(fitted(docs, labels))

    def each(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tool = model.value
        tools = tool.compressors() if tool.weights is not None else []
        memo: dict[int, list[int]] = {}
        for batch in batches:
            for lo, hi, scores in _scores(tool, tools, memo, batch.column(3)):
                part = batch.slice(lo, hi - lo)
                yield pa.RecordBatch.from_arrays(
                    [part.column(0), part.column(1), part.column(2), pa.array(scores), pa.array((scores >= threshold).astype(np.int32))],
                    [KEY, "doc_id", "held_out", "score", "predicted"],
                )

    kind = docs.schema["doc_id"].dataType.simpleString()
    rows = docs.select(row_key("doc_id", "text").alias(KEY), "doc_id", held_out(F.col("doc_id")).alias("held_out"), "text")
    return rows.mapInArrow(each, f"{KEY} binary, doc_id {kind}, held_out boolean, score double, predicted int")


def without_toxic(docs: DataFrame, labels: DataFrame, threshold: float = 0.3) -> DataFrame:
    """``docs`` without the documents predicted toxic.

    Rows are dropped where they are scored, so no text is shuffled. Null and empty texts are judged as in
    :func:`scored`, equal texts stay or go together, an empty table stays empty, other columns go through untouched.
    """
    model = docs.sparkSession.sparkContext.broadcast(fitted(docs, labels))
    place = docs.columns.index("text")

    def each(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tool = model.value
        tools = tool.compressors() if tool.weights is not None else []
        memo: dict[int, list[int]] = {}
        for batch in batches:
            for lo, hi, scores in _scores(tool, tools, memo, batch.column(place)):
                yield batch.slice(lo, hi - lo).filter(pa.array(scores < threshold))

    return docs.mapInArrow(each, docs.schema)
