"""Words that linear hashes confuse, repeated rows, passages by words, copies of vectors, and the pipeline by loops."""

from __future__ import annotations

import hashlib
import random
import re
import time
import zlib
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from venueops.llm import kernel, packing, repeats, setjoin, toxicity, vectors
from venueops.llm.common import checkpointed

FOLDER = "/root/testdata/sf0.01"
DOCS = "doc_id long, text string, lang string, source string, n_chars long"


def confusing():
    """Two words of 1,024 letters that sums of letters times powers of any odd base, mod 2^64, do not tell apart."""
    bits = [bin(i).count("1") & 1 for i in range(1024)]
    return "".join("ab"[b] for b in bits), "".join("ba"[b] for b in bits)


def words(text):
    return re.findall(r"[^\x20\x09-\x0D]+", re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))


def shingles(text, n):
    w = words(text)
    return {tuple(w[i : i + n]) for i in range(len(w) - n + 1)} if len(w) >= n else {tuple(w)} if w else set()


def rows_of(texts):
    return [(i, t, "en", "s", None if t is None else len(t)) for i, t in enumerate(texts)]


def test_words_of_equal_linear_hashes_stay_apart(spark):
    one, other = confusing()
    frame = spark.createDataFrame(rows_of([one, other, one + " x y", other + " x y", one]), DOCS)
    found = {r.doc_id: r.component_id for r in setjoin.jaccard_components(frame, 3, 90, 100).collect()}
    assert found == {0: 0, 1: 1, 2: 2, 3: 3, 4: 0}
    assert sorted(r.doc_id for r in setjoin.one_of_each(frame).collect()) == [0, 1, 2, 3]


def test_links_of_small_texts(spark):
    texts = ["a b c d e f g h", "a b c d e f g h i", "q r s t u v w", "a b c d e f g H", "z", "Z", "", None]
    frame = spark.createDataFrame(rows_of(texts), DOCS)
    want = [[len(shingles(x, 3) & shingles(y, 3)) * 100 >= 80 * len(shingles(x, 3) | shingles(y, 3)) for y in texts] for x in texts]
    found = {r.doc_id: r.component_id for r in setjoin.jaccard_components(frame, 3, 80, 100).collect()}
    assert found == {i: min([j for j in range(8) if texts[i] and texts[j] and want[i][j]] or [i]) for i in range(8)}


def test_grams_and_sequences_equal_plain_python():
    rng = random.Random(1)
    for _ in range(100):
        texts = ["".join(rng.choices(["a", "B", "b", " ", "\t", "é"], k=rng.randint(0, 14))) for _ in range(rng.randint(1, 6))]
        raw = [t.encode() for t in texts]
        data, offsets = np.frombuffer(b"".join(raw), dtype=np.uint8), np.r_[0, np.cumsum([len(x) for x in raw])]
        assert kernel.sequences(data, offsets) == [" ".join(words(t)).encode() for t in texts]
        n = rng.randint(1, 4)
        for grams in (kernel.exact_grams, kernel.distinct_grams):
            values, rows = grams(data, offsets, n)
            sets = [set(values[rows == i].tolist()) for i in range(len(texts))]
            for x, mine in zip(texts, sets, strict=True):
                assert [len(mine & s) for s in sets] == [len(shingles(x, n) & shingles(y, n)) for y in texts]


def test_one_of_equal_rows_stays(spark):
    long = "one two three four five six seven"
    rows = [(1, long, "x", "s", 1), (1, long, "x", "s", 1), (2, long, "x", "s", 1), (3, None, "x", "s", 1), (3, None, "x", "s", 1)]
    rows += [(4, "alone", "x", "s", 1), (4, "alone", "y", "s", 1), (None, long, "x", "s", 1)]
    kept = setjoin.one_of_each(spark.createDataFrame(rows, DOCS))
    assert kept.columns == ["doc_id", "text", "lang", "source", "n_chars"]
    assert sorted(((r.doc_id, r.text) for r in kept.collect()), key=repr) == [(1, long), (3, None), (3, None), (4, "alone")]
    assert setjoin.one_of_each(kept.limit(0)).count() == 0


def without_passages(texts, length):
    """Each text without the words of any ``length`` of them in a row that stand anywhere else too."""
    spots = [[(m.start(), m.end()) for m in re.finditer(r"[^\x20\x09-\x0D]+", t or "")] for t in texts]
    seen = Counter(tuple(words(t)[i : i + length]) for t in texts for i in range(len(words(t)) - length + 1))
    out = []
    for text, at in zip(texts, spots, strict=True):
        w, covered = words(text), set()
        for i in range(len(w) - length + 1):
            if seen[tuple(w[i : i + length])] > 1:
                covered.update(range(at[i][0], at[i + length - 1][1]))
        out.append(None if text is None else "".join(c for k, c in enumerate(text) if k not in covered))
    return out


@pytest.mark.parametrize("length, group", [(4, 2000), (51, 2000), (6, 0)])
def test_passages_of_words(spark, length, group):
    rng = random.Random(length)
    vocabulary = ["the", "of", "I", "a", "é", "naïve", "x,", "The"]
    passage = " ".join(rng.choices(vocabulary, k=length + 5))
    texts = [None, "", " ", "a", passage, "  start " + passage.replace(" ", "\t") + " end", passage[: len(passage) // 2]]
    texts += [" ".join(rng.choices(vocabulary, k=rng.randint(0, 3 * length))) for _ in range(40)]
    texts += ["a " * (3 * length), " ".join(rng.choices(vocabulary + [str(i) for i in range(900)], k=3000)), passage.upper()]
    found = repeats.without_repeats(spark.createDataFrame(rows_of(texts), DOCS), length, group=group, unit="words").collect()
    want = without_passages(texts, length)
    assert {r.doc_id: r.text for r in found} == dict(enumerate(want))


def test_a_later_batch_meets_the_levels_that_are_there(spark):
    """An index that is kept: a batch's matches are those with all batches before it."""
    line = "the same forty bytes of text in two batches, "
    family = repeats.IndexFamily(20)
    frames = [spark.createDataFrame(rows_of([t]), DOCS) for t in (line * 2, "nothing in common here at all, is there", line, "x" * 50)]
    matches = [family.add(f).count() > 0 for f in frames[:2]]
    assert matches == [True, False] and [r for r, _, _ in family.levels] == [1]
    assert family.add(frames[2]).count() > 0 and [r for r, _, _ in family.levels] == [1, 0]
    assert family.add(frames[3].limit(0)).count() == 0 and [r for r, _, _ in family.levels] == [2]


def test_examples_with_columns_of_the_same_names(spark):
    rows = [(i, 10 + i, 3, "mine", 7) for i in range(50)]
    frame = spark.createDataFrame(rows, "id long, offset int, m int, sequence_id string, n int")
    out = packing.pack_examples(frame, (100, 4, 20), "offset", "m")
    assert out.columns == ["id", "m", "n", "sequence_id", "offset"]
    found = out.collect()
    assert sorted(r.id for r in found) == list(range(50))
    by = {}
    for r in found:
        by.setdefault(r.sequence_id, []).append(r)
    for own in by.values():
        assert sum(10 + r.id for r in own) <= 100 and len(own) <= 4 and sum(r.m for r in own) <= 20
        places = sorted((r.offset, 10 + r.id) for r in own)
        assert [p for p, _ in places] == [sum(n for _, n in places[:k]) for k in range(len(places))]


def test_vectors_of_extreme_size_link(spark):
    rows = [(1, [1e200, 1e200]), (2, [1e-200, 1e-200]), (3, [3.0, 3.1]), (4, [1e308, -1e308]), (5, [5e-324, 5e-324])]
    rows = [(i, v, 0) for i, v in rows] + [(6, None, 0), (7, [0.0, 0.0], 0), (8, [1.0, None], 0), (9, [float("inf"), 1.0], 0), (10, [1.0, 1.0], None)]
    frame = spark.createDataFrame(rows, "vec_id long, embedding array<double>, label int")
    got = {r.vec_id: (r.n_links, r.component_id) for r in vectors.linked_vectors(frame).collect()}
    assert got == {1: (3, 1), 2: (3, 1), 3: (3, 1), 5: (3, 1)} | {i: (0, i) for i in (4, 6, 7, 8, 9, 10)}


def test_a_hundred_thousand_copies_are_one_class(spark):
    n = 100_000
    base = spark.range(n).select(
        F.col("id").alias("vec_id"),
        F.when(F.col("id") % 1000 == 0, F.array(F.lit(1.0), F.lit(0.01), F.lit(0.0))).otherwise(F.array(F.lit(1.0), F.lit(0.0), F.lit(0.0))).alias("embedding"),
        F.lit(3).alias("label"),
    )
    began = time.monotonic()
    found = vectors.linked_vectors(base.withColumn("embedding", F.col("embedding").cast("array<float>")))
    totals = found.agg(F.min("n_links"), F.max("n_links"), F.max("component_id"), F.count_if("kept")).first()
    assert tuple(totals) == (n - 1, n - 1, 0, 1)
    assert time.monotonic() - began < 90


# the pipeline


@pytest.fixture(scope="module")
def corpus(spark):
    """Documents with copies, near copies, shared passages, benchmark passages, repeated and odd rows."""
    rng = random.Random(8)
    vocabulary = ["".join(rng.choices("abcdefgh", k=rng.randint(2, 7))) for _ in range(400)]
    benchmark = [(k, " ".join(rng.choices(vocabulary, k=30))) for k in range(5)]
    texts = [" ".join(rng.choices(vocabulary, k=rng.choice([1, 3, 20, 80, 200]))) for _ in range(60)]
    passage = " ".join(rng.choices(vocabulary, k=60))
    texts += [texts[7], texts[8].upper(), texts[10] + " extra", texts[12]]
    texts += [f"{rng.choice(vocabulary)} {passage} {' '.join(rng.choices(vocabulary, k=100))}" for _ in range(3)]
    texts += [f"{' '.join(rng.choices(vocabulary, k=20))} {benchmark[2][1]} {' '.join(rng.choices(vocabulary, k=9))}", None, "", " "]
    rows = rows_of(texts)
    docs = spark.createDataFrame([*rows, rows[3], rows[20]], DOCS)
    return docs, spark.createDataFrame(benchmark, "item_id long, text string"), benchmark


def plain(frame):
    return sorted(((r.doc_id, r.text) for r in frame.collect()), key=repr)


def test_stages_equal_loops(spark, corpus, tmp_path):
    """Each stage's rows against loops over the rows that the stage before left, and run() against all of them."""
    docs, bench, items = corpus
    folder = str(tmp_path)
    docs.write.parquet(f"{folder}/documents.parquet")
    bench.write.parquet(f"{folder}/benchmark.parquet")
    spark.createDataFrame([], "doc_id long, quality int, toxic int").write.parquet(f"{folder}/labels.parquet")
    stages = dict(corpus_pipeline.STAGES)
    docs = spark.read.parquet(f"{folder}/documents.parquet")

    after = checkpointed(stages["toxicity"](spark, docs, folder))
    bad = {r.doc_id for r in toxicity.scored(docs, spark.read.parquet(f"{folder}/labels.parquet")).collect() if r.predicted}
    assert plain(after) == [r for r in plain(docs) if r[0] not in bad]

    before, after = plain(after), checkpointed(stages["near_duplicates"](spark, after, folder))
    sets = [shingles(t, 5) for _, t in before]
    parent = list(range(len(before)))

    def top(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for i, a in enumerate(sets):
        for j in range(i):
            if a and sets[j] and 100 * len(a & sets[j]) >= 80 * len(a | sets[j]):
                parent[top(i)] = top(j)
    first = {}
    for i, (doc, _) in enumerate(before):
        if sets[i]:
            first[top(i)] = min(first.get(top(i), doc), doc)
    seen, want = set(), []
    for i, row in enumerate(before):
        if not sets[i]:
            want.append(row)
        elif row[0] == first[top(i)] and row not in seen:
            seen.add(row)
            want.append(row)
    assert plain(after) == sorted(want, key=repr) and len(want) < len(before) - 4

    before, after = plain(after), checkpointed(stages["repeats"](spark, after, folder))
    want = list(zip([d for d, _ in before], without_passages([t for _, t in before], 51), strict=True))
    assert plain(after) == sorted(want, key=repr) and sum(a != b for a, b in zip(before, want, strict=True)) == 3

    before, after = plain(after), checkpointed(stages["decontamination"](spark, after, folder))
    leaked = {d for d, t in before if t and any(x in t for _, x in items)}
    assert plain(after) == [r for r in before if r[0] not in leaked] and len(leaked) == 1

    last = stages["packing"](spark, after, folder).collect()
    pieces = {}
    for r in last:
        pieces.setdefault(r.doc_id, []).append(r)
    assert set(pieces) == {d for d, _ in plain(after)}
    for own in pieces.values():
        starts = sorted((r.start, r.length) for r in own)
        assert [s for s, _ in starts] == [sum(n for _, n in starts[:k]) for k in range(len(starts))]
        assert sum(n for _, n in starts) == own[0].doc_tokens
    room = Counter()
    for r in last:
        room[r.sequence_id] += r.length
    assert max(room.values()) <= 1024

    digest = lambda rows: sorted((r.doc_id, r.start, r.length, r.ids_crc32) for r in rows)
    assert sum(r.length for r in corpus_pipeline.run(spark, folder).collect()) == sum(r.length for r in last)
    assert {x[0] for x in digest(corpus_pipeline.run(spark, folder).collect())} == set(pieces)


def test_stages_of_nothing(spark, corpus, tmp_path):
    docs, bench, _ = corpus
    folder = str(tmp_path)
    bench.limit(0).write.parquet(f"{folder}/benchmark.parquet")
    docs.limit(0).write.parquet(f"{folder}/documents.parquet")
    spark.createDataFrame([], "doc_id long, quality int, toxic int").write.parquet(f"{folder}/labels.parquet")
    assert corpus_pipeline.run(spark, folder).count() == 0


def _unrelated(rng, n, size):
    values = rng.integers(0, 1 << 63, size=(n, size), dtype=np.int64).astype(np.uint64)
    return np.sort(values, axis=1).ravel(), np.repeat(np.arange(n), size), np.full(n, size)


def test_unrelated_sets_do_not_meet():
    # sets met in segments that are empty in all of them, by thousands
    rng = np.random.default_rng(5)
    threshold = setjoin.Threshold(80, 100, 2.0)
    for size in (40, 140, 210, 250, 410, 500):
        n = 3000
        plan = lambda scheme: setjoin.allocation(threshold, scheme, n)
        signatures, _ = setjoin.signatures_of(threshold, plan, *_unrelated(rng, n, size))
        assert np.unique(signatures, return_counts=True)[1].max() <= n // 100


def test_similar_sets_meet():
    # pairs at the threshold itself, of few and many shingles in a segment, so that credits run out in some
    rng = np.random.default_rng(6)
    for num, segments in ((80, None), (90, None), (80, "deep"), (80, "spare")):
        threshold = setjoin.Threshold(num, 100, 2.0)

        def plan(scheme):
            exact, deep = setjoin.allocation(threshold, scheme, 3000)
            need = int(threshold.differences(int(threshold.edges[scheme + 1]) - 1)) + 1
            if segments == "deep" and need > 4:
                return need - 2, 2
            return (3 * exact, deep) if segments == "spare" else (exact, deep)

        for size in rng.integers(1, 300, size=150):
            both = rng.integers(0, 1 << 62, size=size).astype(np.uint64)
            own = int(size * (100 - num) / num)  # shingles in one set only: size / (size + own) is num / 100 at least
            cut = rng.integers(0, own + 1)
            extra = rng.integers(0, 1 << 62, size=own).astype(np.uint64)
            left, right = np.r_[both, extra[:cut]], np.r_[both, extra[cut:]]
            values, rows = np.r_[left, right], np.repeat([0, 1], [len(left), len(right)])
            sizes = np.array([len(left), len(right)])
            signatures, owners = setjoin.signatures_of(threshold, plan, values, rows, sizes)
            assert np.intersect1d(signatures[owners == 0], signatures[owners == 1]).size


def test_samples_are_fitted_by_a_task(spark, monkeypatch):
    # the driver held all samples, and its memory stayed with it for the stages that follow
    rng = random.Random(9)
    letters = ["".join(rng.choices("abcdefgh", k=5)) for _ in range(300)]
    texts = [" ".join(rng.choices(letters, k=30)) + (" vilest scum" if i % 4 == 0 else "") for i in range(200)]
    docs = spark.createDataFrame(rows_of(texts), DOCS)
    labels = spark.createDataFrame([(i, int(i % 4 == 0)) for i in range(200)], "doc_id long, toxic int")
    learnt = [i for i in range(200) if zlib.crc32(str(i).encode()) % 4 != 2]
    learnt.sort(key=lambda i: (hashlib.md5(str(i).encode()).hexdigest(), texts[i]))
    sides = [[texts[i] for i in learnt if (i % 4 == 0) == toxic] for toxic in (True, False)]
    want = toxicity.train(*sides, len(sides[0]) / len(learnt))

    def refuse(*_):
        raise AssertionError("fitted in the driver")

    with monkeypatch.context() as patch:
        patch.setattr(type(docs), "toArrow", refuse)
        got = toxicity.fitted(docs, labels)
    assert (got.prior, got.ordinary, got.toxic) == (want.prior, want.ordinary, want.toxic)
    for name in ("center", "scale", "weights"):
        assert np.allclose(getattr(got, name), getattr(want, name), rtol=1e-9, atol=1e-12)
    none = toxicity.fitted(docs.limit(0), labels)
    assert none.weights is None and none.prior == want.prior
