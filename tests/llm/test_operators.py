"""The language-model operators against brute force, exact round trips and held-out accuracy, and on odd tables."""

from __future__ import annotations

import hashlib
import os
import random
import re
import textwrap
import zlib
from collections import Counter, defaultdict

import numpy as np
import pyarrow as pa
import public_tokenizers
import pytest
from pyspark.sql import functions as F
from tokenizers import Tokenizer

import __spark_entry__ as entry
import corpus_pipeline
from tests.parity import connect, difference
from venueops.llm import (
    chat,
    common,
    kernel,
    licences,
    packing,
    queries,
    repeats,
    setjoin,
    shards,
    tiling,
    token_bins,
    toxicity,
    vectors,
)

FOLDER = "/root/testdata/sf0.01"
DOCS = "doc_id long, text string, lang string, source string, n_chars long, sid string, `key` string, label int"


@pytest.fixture(scope="module")
def odd(spark):
    """Nulls everywhere, empty and very long texts, repeated rows, clashing column names."""
    rng = random.Random(3)
    long = " ".join(rng.choice(["alpha", "beta", "gämma", "δ", "x", "Yes,"]) + str(rng.randint(0, 999)) for _ in range(40_000))
    texts = [None, "", " \t\n", "one", "two words", "two words", "TWO words", long, long, long[:-9] + "different", "a" * 3000, "a" * 3001]
    texts += ["Released under the MIT License.\n", "\\ & < [ | 😀 é " * 40]
    rows = [(i, t, None, None, None, "s", None, None) for i, t in enumerate(texts)]
    rows += [rows[4], rows[7], (None, None, None, None, None, None, None, None), (None, "one", "en", "s", 3, "s", "k", 1)]
    return spark.createDataFrame(rows, DOCS)


@pytest.fixture(scope="module")
def labels(spark):
    return spark.read.parquet(f"{FOLDER}/labels.parquet")


@pytest.fixture(scope="module")
def docs(spark):
    return spark.read.parquet(f"{FOLDER}/documents.parquet")


def words(text):
    return re.findall(r"[^\x20\x09-\x0D]+", re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))


def linked(sets, similar):
    """Smallest key of each component, by comparing all pairs that share something."""
    parent = {k: k for k in sets}

    def top(x):
        while parent[x] != x:
            x = parent[x]
        return x

    where = defaultdict(list)
    for k, s in sets.items():
        for g in s:
            where[g].append(k)
    for k, s in sets.items():
        for other in {o for g in s for o in where[g] if o < k}:
            if similar(s, sets[other]):
                a, b = top(k), top(other)
                parent[max(a, b)] = min(a, b)
    return {k: top(k) for k in sets}


@pytest.mark.parametrize("name", list(queries.oracle_sql()))
def test_query_equals_sql(spark, name):
    assert difference(entry.queries()[name](spark, FOLDER), connect(FOLDER), queries.oracle_sql()[name]) is None


def test_words_and_hashes_agree_with_plain_python():
    texts = ["", "A b\tA", "ünï Code", "b\x0bc", "  x  "]
    data = "".join(texts).encode()
    offsets = np.r_[0, np.cumsum([len(t.encode()) for t in texts])]
    hashes, rows, starts, ends = kernel.words(np.frombuffer(data, np.uint8), offsets)
    got = [(int(r), data[s:e].decode()) for r, s, e in zip(rows, starts, ends, strict=True)]
    assert [(r, w.lower()) for r, w in got] == [(i, w) for i, t in enumerate(texts) for w in words(t)]
    same = defaultdict(set)
    for h, (_, w) in zip(hashes.tolist(), got, strict=True):
        same[w.lower()].add(h)
    assert all(len(x) == 1 for x in same.values()) and len({*map(min, same.values())}) == len(same)


# 1


def test_shards(spark, docs, odd):
    for frame in (docs, odd):
        rows = shards.sharded(frame, 40).collect()
        assert len(rows) == frame.count()
        assert all(r.grown_shard in (r.shard, 40) for r in rows)
        for shard, own in _by(rows, lambda r: r.shard).items():
            assert 0 <= shard < 40
            assert sorted(r.slot for r in own) == list(range(len(own)))
        texts = Counter((r.doc_id, len((r.text or "").encode()) + 16, zlib.crc32((r.text or "").encode())) for r in frame.collect())
        assert Counter((r.doc_id, r["size"], r.text_crc32) for r in rows) == texts
    assert shards.sharded(odd.limit(0), 40).count() == 0


def test_movement_stays_in_changed_subtrees(spark):
    ids = spark.range(20_000).withColumnRenamed("id", "doc_id")
    tree = shards.Tree.even(16)
    heavier = shards.Tree(tuple((a, b, s, 3.0 if s == 5 else w) for a, b, s, w in tree.leaves))
    both = shards.placed(shards.placed(ids, "doc_id", tree, "x"), "doc_id", heavier, "y").collect()
    place = {s: (a, b) for a, b, s, _ in tree.leaves}
    moved = [r for r in both if r.x != r.y]
    assert moved
    for r in moved:  # into the region, the rack or the shard that grew, whichever level first differs
        depth = next((k for k in (0, 1) if place[r.x][k] != place[r.y][k]), 2)
        assert place[r.y][0] == place[5][0] and (depth == 0 or place[r.y][1] == place[5][1]) and (depth < 2 or r.y == 5)
    share = Counter(r.y for r in both)
    assert abs(share[5] / 20_000 - 3 / 18) < 0.02


def _by(rows, key):
    out = defaultdict(list)
    for r in rows:
        out[key(r)].append(r)
    return out


# 2 and 3


def _ids(frame):
    tool = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
    tool.encode_special_tokens = True
    rows = [(r.doc_id, r.text or "") for r in frame.select("doc_id", "text").collect()]
    return [(d, [*e.ids, 0]) for (d, _), e in zip(rows, tool.encode_batch([t for _, t in rows], add_special_tokens=False), strict=True)]


def test_token_matrices_round_trip(docs, odd):
    for frame in (docs, odd):
        pieces, used, places = defaultdict(list), 0, 0
        for block in token_bins.packed_ids(frame).collect():
            matrix = np.frombuffer(block.ids, dtype=block.dtype)
            assert len(matrix) == block.n_rows * 1024 == block.cu_seqlens[-1]
            assert list(block.resets) == list(block.cu_seqlens[:-1])
            places += len(matrix)
            for a, b, doc_id, start in zip(block.cu_seqlens, block.cu_seqlens[1:], block.doc_ids, block.starts, strict=False):
                assert a // 1024 == (b - 1) // 1024
                if start is not None:
                    pieces[doc_id].append((start, matrix[a:b].tolist()))
                    used += b - a
        want = Counter(x for d, ids in _ids(frame) for s in range(0, len(ids), 1024) for x in [(d, s, tuple(ids[s : s + 1024]))])
        assert Counter((d, s, tuple(p)) for d, own in pieces.items() for s, p in own) == want
    assert used / places > 0.9
    assert token_bins.packed_ids(odd.limit(0)).count() == 0


def test_best_fit_is_best_fit_decreasing():
    rng = random.Random(5)
    sizes = [rng.randint(1, 64) for _ in range(500)]
    room, plain = [], []
    for k in sorted(range(len(sizes)), key=lambda k: (-sizes[k], k)):
        fit = [r for r in range(len(room)) if room[r] >= sizes[k]]
        if not fit:
            room.append(64)
            plain.append([])
            fit = [len(room) - 1]
        best = min(fit, key=lambda r: room[r])
        room[best] -= sizes[k]
        plain[best].append(k)
    rows = token_bins.best_fit(sizes, 64)
    assert sorted(k for row in rows for k in row) == list(range(500))
    assert sorted(sum(sizes[k] for k in row) for row in rows) == sorted(64 - r for r in room)


def test_packed_documents(docs, odd):
    for frame in (docs, odd):
        rows = packing.pack_documents(frame).collect()
        want = Counter((d, zlib.crc32(np.array(ids, "<u4")[s : s + 1024].tobytes()), s, len(ids)) for d, ids in _ids(frame) for s in range(0, len(ids), 1024))
        assert Counter((r.doc_id, r.ids_crc32, r.start, r.doc_tokens) for r in rows) == want
        sequences = _by(rows, lambda r: r.sequence_id)
        for own in sequences.values():
            at = 0
            for r in sorted(own, key=lambda r: r.offset):
                assert r.offset == at
                at += r.length
            assert at <= 1024 and len(own) <= 64
    assert packing.pack_documents(odd.limit(0)).count() == 0


def test_ids_are_those_of_the_library_with_added_tokens_in_texts(spark):
    texts = ["a <|endoftext|> b", "<|endoftext|>", "x<|endoftext|><|endoftext|>  y\n", "<|ENDOFTEXT|>", "<|endoftext", "é <|endoftext|> " * 600, "plain", "", None]
    frame = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    tool = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
    want = {i: [*tool.encode(t or "", add_special_tokens=False).ids, 0] for i, t in enumerate(texts)}
    assert 50256 in want[0]
    got = packing.pack_documents(frame).collect()
    cut = Counter((d, s, zlib.crc32(np.array(ids[s : s + 1024], "<u4").tobytes()), len(ids)) for d, ids in want.items() for s in range(0, len(ids), 1024))
    assert Counter((r.doc_id, r.start, r.ids_crc32, r.doc_tokens) for r in got) == cut
    pieces = {}
    for block in token_bins.packed_ids(frame).collect():
        matrix = np.frombuffer(block.ids, dtype=block.dtype)
        for a, b, doc_id, start in zip(block.cu_seqlens, block.cu_seqlens[1:], block.doc_ids, block.starts, strict=False):
            if start is not None:
                pieces[doc_id, start] = matrix[a:b].tolist()
    assert pieces == {(d, s): ids[s : s + 1024] for d, ids in want.items() for s in range(0, len(ids), 1024)}


def test_little_padding(spark, docs):
    total = packing.pack_documents(docs).agg(F.sum("length"), F.countDistinct("sequence_id")).first()
    assert total[0] / (1024 * total[1]) > 0.98


def test_vector_limits_hold_at_once(spark):
    rng = random.Random(9)
    rows = [(i, n := rng.randint(1, 500), rng.randint(0, n)) for i in range(6000)]
    frame = spark.createDataFrame([*rows, (6000, None, None)], "example long, n int, m int")
    out = packing.pack_examples(frame, (1024, 6, 600), "n", "m").collect()
    assert Counter(r.example for r in out) == Counter(range(6001))
    bins = _by(out, lambda r: r.sequence_id)
    for own in bins.values():
        assert sum(r.n or 0 for r in own) <= 1024 and len(own) <= 6 and sum(r.m or 0 for r in own) <= 600
    bound = max(sum(r[1] for r in rows) / 1024, 6001 / 6, sum(r[2] for r in rows) / 600)
    assert len(bins) < 1.1 * bound + 8


# 4


def test_toxicity_on_held_out_labels(spark):
    folder = "/root/testdata/sf0.1"
    docs, labels = (spark.read.parquet(f"{folder}/{n}.parquet") for n in ("documents", "labels"))
    rows = toxicity.scored(docs, labels).join(labels, "doc_id").filter("held_out").collect()
    hit = sum(r.predicted and r.toxic for r in rows)
    assert hit > 0.6 * sum(r.toxic for r in rows) and hit > 0.6 * sum(r.predicted for r in rows)
    bad, good = ([r.score for r in rows if r.toxic == y] for y in (1, 0))
    assert np.mean([x > y for x in bad for y in good]) > 0.85


def test_toxic_phrases_of_ordinary_words_have_gains():
    rng = random.Random(6)
    plain = ["".join(rng.choice("abcdefghij") for _ in range(rng.randint(4, 8))) for _ in range(600)]

    def some(together):  # the same three words in every text, side by side or scattered
        text = [rng.choice(plain[3:]) for _ in range(60)]
        places = [30, 30, 30] if together else [50, 30, 10]
        for word, at in zip(plain[2::-1], places, strict=True):
            text.insert(at, word)
        return " ".join(text)

    model = toxicity.train([some(True) for _ in range(600)], [some(False) for _ in range(900)], 0.3)
    scores = []
    for together in (False, True):
        texts = [some(together) for _ in range(300)]
        offsets = np.r_[0, np.cumsum([len(x) for x in texts])]
        data = np.frombuffer("".join(texts).encode(), np.uint8)
        scores.append(model.scores(model.features(data, offsets, model.compressors(), {})))
    assert np.mean(scores[1][:, None] > scores[0][None, :]) > 0.8


def test_held_out_labels_do_not_matter(spark, docs, labels, odd):
    changed = labels.withColumn("toxic", F.when(toxicity.held_out(F.col("doc_id")), 1 - F.col("toxic")).otherwise(F.col("toxic")))
    a, b = (dict(toxicity.scored(docs, x).select("doc_id", "score").collect()) for x in (labels, changed))
    assert a == b
    rows = toxicity.scored(odd, labels).collect()
    assert len(rows) == odd.count() and all(0 <= r.score <= 1 and r.predicted == (r.score >= 0.3) for r in rows)
    assert {r.score for r in toxicity.scored(odd, labels.limit(0)).collect()} == {0.0}
    assert toxicity.scored(odd.limit(0), labels).count() == 0


# 5


def test_licence_texts_in_other_dress(spark, odd):
    mit = licences.KNOWN["MIT"][0]
    dressed = "Copyright (c) 2020 Some One\n\n" + mit.upper().replace(", ", " ;\n * ").replace("SUBLICENSE", "SUB-LICENSE")
    rows = spark.createDataFrame([(1, mit), (2, dressed), (3, mit + " more"), (4, "x\nReleased under the MIT Licence\ny"), (5, None)], "doc_id long, text string")
    out = {r.doc_id: (r.license, r.notices) for r in licences.scanned(rows).collect()}
    assert out == {1: ("MIT", "MIT"), 2: ("MIT", ""), 3: (None, ""), 4: (None, "MIT"), 5: (None, None)}
    assert licences.scanned(odd).count() == odd.count()


def test_usual_licence_files(spark):
    mit, bsd = licences.KNOWN["MIT"][0], licences.KNOWN["BSD-3-Clause"][0]
    rows = [(k, f"{title}\n\nCopyright (c) 2021 Some One\n\n" + textwrap.fill(mit, 79)) for k, title in enumerate(("MIT License", "The MIT License (MIT)", "The MIT License"))]
    rows += [(10, "BSD 3-Clause License\n\nCopyright (c) 2021, Some One\nAll rights reserved.\n\n" + "\n\n".join(textwrap.fill(p, 79) for p in bsd.split("\n\n")))]
    rows += [(11, "Copyright 2021 Some One\n\n" + licences.KNOWN["BSD-2-Clause"][0]), (12, licences.KNOWN["Unlicense"][0]), (13, "Some title\n\n" + mit)]
    out = {r.doc_id: r.license for r in licences.scanned(spark.createDataFrame(rows, "doc_id long, text string")).collect()}
    assert out == {0: "MIT", 1: "MIT", 2: "MIT", 10: "BSD-3-Clause", 11: "BSD-2-Clause", 12: "Unlicense", 13: None}
    assert {"Apache-2.0", "GPL-2.0-only", "GPL-3.0-only", "LGPL-2.1-only", "LGPL-3.0-only", "MPL-2.0"} <= set(licences.WHOLE.values())


# 6


def _without_repeats(texts, length):
    seen = Counter(t[p : p + length] for t in texts for p in range(len(t) - length + 1))
    out = []
    for t in texts:
        keep = bytearray(b"\1" * len(t))
        for p in range(len(t) - length + 1):
            if seen[t[p : p + length]] > 1:
                keep[p : p + length] = bytes(length)
        spans = sum(1 for i, k in enumerate(keep) if not k and (i == 0 or keep[i - 1]))
        out.append((len(t) - sum(keep), spans, hashlib.sha256(bytes(x for x, k in zip(t, keep, strict=True) if k)).hexdigest()))
    return out


@pytest.mark.parametrize(("length", "batches", "group"), [(10, 4, 2000), (21, 3, 2), (34, 1, 5)])
def test_repeats(spark, length, batches, group):
    rng = random.Random(length)

    def some(n, letters="abé "):
        return "".join(rng.choice(letters) for _ in range(n))

    texts = [some(rng.randint(0, 120)) for _ in range(50)] + ["a" * 90, "ab" * 50, None, "", "a" * 30, "aab" * 30, "aab" * 30]
    passage = some(70, "abcdefghij")
    for _ in range(40):
        k = rng.randint(0, 40)
        texts.append(some(rng.randint(0, 30), "klmnop") + passage[k : k + rng.randint(10, 60)] + some(rng.randint(0, 30), "qrstu"))
    frame = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    got = {r.doc_id: (r.n_removed, r.n_spans, r.kept_sha256) for r in repeats.repeats_report(frame, length, batches, group).collect()}
    assert got == dict(enumerate(_without_repeats([(t or "").encode() for t in texts], length)))


def test_repeats_on_odd_rows(odd):
    out = repeats.repeats_report(odd, 400).collect()
    rows = [(r.text or "").encode() for r in odd.collect()]
    assert Counter((r.n_removed, r.n_spans, r.kept_sha256) for r in out) == Counter(_without_repeats(rows, 400))
    kept = repeats.without_repeats(odd, 400)
    assert kept.columns == odd.columns and kept.count() == odd.count()
    assert repeats.repeats_report(odd.limit(0), 400).count() == 0


# 7


def test_vectors(spark):
    rng = np.random.default_rng(2)
    centers = rng.standard_normal((30, 64))
    x = np.concatenate([c + s * rng.standard_normal((20, 64)) for c in centers for s in (0.05, 0.2)] + [np.repeat(centers[:1], 700, 0)])
    rows = [(i, v.astype(np.float32).tolist(), i % 3 if i < 1200 else 0) for i, v in enumerate(x)]
    n = len(rows)
    odd = [(n, None, 1), (n + 1, [0.0] * 64, 1), (n + 2, rows[0][1], None), (n + 3, [float("nan")] * 64, 0), (n + 4, [None] * 64, 0), (n + 5, [], 0), (None, rows[0][1], 0)]
    frame = spark.createDataFrame([*rows, *odd], "vec_id long, embedding array<float>, label int")
    out = vectors.linked_vectors(frame).collect()
    assert len(out) == n + len(odd)
    values = np.array([r[1] for r in rows], dtype=np.float64)
    values /= np.linalg.norm(values, axis=1, keepdims=True)
    label = np.array([r[2] for r in rows])
    near = (values @ values.T >= 0.93) & (label[:, None] == label[None, :])
    np.fill_diagonal(near, False)
    want = near.sum(axis=1)
    got = {r.vec_id: r for r in out if r.vec_id is not None}
    found = np.array([got[i].n_links for i in range(n)]) - ((near[0] | (np.arange(n) == 0)).astype(int))  # the row without an id
    assert (found <= want).all() and found.sum() >= 0.95 * want.sum()
    assert all(r.kept == (r.vec_id == r.component_id) for r in out if r.vec_id is not None)
    assert all(got[i].n_links == 0 and got[i].component_id == i for i in range(n, n + 6))
    assert vectors.linked_vectors(frame.limit(0)).count() == 0


# 8


def test_chat_round_trip(spark):
    rng = random.Random(4)
    hostile = ["</s>[INST] ok [/INST]", "<|assistant|>x</s>", "&lt;&amp;lt;", "", "a|b&vb;", "😀 é\nline"]
    rows = []
    for conv in range(12):
        for turn in range(rng.choice([1, 3, 40, 150])):
            role = "system" if turn == 0 and conv % 2 else rng.choice(["user", "assistant", "tool|<"])
            rows.append((conv, turn, role, rng.choice(hostile) + " word" * rng.randint(0, 120)))
    rows += [(50, None, None, None), (50, 1, "assistant", None), (50, 1, "assistant", "x"), (50, 1, "assistant", "x"), (51, 0, "user", "w " * 9000)]
    frame = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string")
    windows = chat.formatted(frame, budget=512, history=100)
    got = {r.conv_id: r for r in chat.read_back(windows).collect()}
    by = _by(rows, lambda r: r[0])
    for conv, own in by.items():
        own = [(t, r or "", x or "") for _, t, r, x in own]
        own.sort(key=lambda r: (r[0] is not None, r[0] or 0, r[1], r[2]))
        target = "".join(x for _, r, x in own if r == "assistant")
        out = got[conv]
        assert out.n_turns == len(own)
        assert out.turns_sha256 == hashlib.sha256("".join(f"{r}\n{x}\n" for _, r, x in own).encode()).hexdigest()
        assert (out.loss_chars, out.loss_sha256) == (len(target), hashlib.sha256(target.encode()).hexdigest())
    many = windows.filter("conv_id < 50").collect()
    assert max(r.window for r in many) > 3
    sizes = [len(re.findall(r"[A-Za-z0-9\x80-\U0010ffff]+|[^A-Za-z0-9\x80-\U0010ffff\s]", chat_text(r.text))) for r in many]
    assert max(sizes) <= 512
    for conv, own in _by(many, lambda r: r.conv_id).items():
        if by[conv][0][2] == "system":
            assert all(r.text.startswith("<|system|>") for r in own)
    assert chat.formatted(frame.limit(0)).count() == 0


def chat_text(text):
    """The bodies of a window's turns."""
    out = " ".join(body for _, body in re.findall(chat.TURN, text))
    for plain, written in reversed(chat.ESCAPES):
        out = out.replace(written, plain)
    return out


# 9


def _greedy(item, doc, least):
    """Greedy string tiling by looking at all places in every round."""
    a, b, out = [False] * len(item), [False] * len(doc), []
    while True:
        best = None
        for i in range(len(item)):
            for j in range(len(doc)):
                n = 0
                while i + n < len(item) and j + n < len(doc) and item[i + n] == doc[j + n] and not a[i + n] and not b[j + n]:
                    n += 1
                if n >= least and (best is None or n > best[2]):
                    best = (i, j, n)
        if best is None:
            return out
        out.append(best)
        for k in range(best[2]):
            a[best[0] + k] = b[best[1] + k] = True


def test_tilings_equal_plain_greedy():
    rng = random.Random(8)
    for _ in range(60):
        item = [rng.choice("abc") for _ in range(rng.randint(0, 25))]
        doc = [rng.choice("abc") for _ in range(rng.randint(0, 40))]
        pairs = [(i, j) for i in range(len(item) - 2) for j in range(len(doc) - 2) if item[i : i + 3] == doc[j : j + 3]]
        got = tiling.tiles(*np.array(pairs, dtype=np.int64).reshape(-1, 2).T, 3) if pairs else []
        assert sorted(got) == sorted(_greedy(item, doc, 3))


def test_contamination(spark, docs, odd):
    bench = spark.read.parquet(f"{FOLDER}/benchmark.parquet")
    item = bench.orderBy(F.length("text").desc()).first()
    w = item.text.split()
    half = len(w) // 2
    rows = [
        (1, "before " + item.text.upper() + " after"),
        (2, " ".join(w[half:]) + " between these " + " ".join(w[:half])),
        (3, " ".join(w[:half])[: len(item.text) // 3]),
        (4, None),
        (5, " ".join(reversed(w))),
    ]
    found = tiling.contaminated(spark.createDataFrame(rows, "doc_id long, text string"), bench)
    assert {(r.doc_id, r.item_id) for r in found.collect()} == {(1, item.item_id), (2, item.item_id)}
    plain = {r.item_id: " ".join(re.findall(r"\w+", r.text.lower())) for r in bench.collect()}
    want = {(r.doc_id, k) for r in docs.collect() for k, t in plain.items() if t in " ".join(re.findall(r"\w+", r.text.lower()))}
    assert want and want <= {(r.doc_id, r.item_id) for r in tiling.contaminated(docs, bench).collect()}
    assert tiling.contaminated(odd, bench).count() == 0
    empty = bench.limit(0)
    assert tiling.contaminated(docs, empty).count() == 0 and tiling.contaminated(odd.limit(0), bench).count() == 0


# 10


@pytest.mark.parametrize(("n", "num"), [(3, 90), (5, 80), (1, 60)])
def test_set_join(spark, monkeypatch, n, num):
    monkeypatch.setattr(setjoin, "TILE", 16)
    rng = random.Random(num)
    letters = [str(i) for i in range(400)]
    texts = []
    for _ in range(12):
        base = [rng.choice(letters) for _ in range(rng.randint(1, 120))]
        for _ in range(rng.randint(1, 14)):
            copy = [x if rng.random() > rng.choice([0, 0.01, 0.03, 0.1]) else rng.choice(letters) for x in base]
            texts.append(" ".join(copy))
    texts += [None, "", " ", "a b", "A  B", "a", "a"]
    rng.shuffle(texts)
    frame = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    sets = {}
    for i, t in enumerate(texts):
        w = words(t)
        sets[i] = {tuple(w[k : k + n]) for k in range(len(w) - n + 1)} if len(w) >= n else ({tuple(w)} if w else set())
    want = linked(sets, lambda a, b: 100 * len(a & b) >= num * len(a | b))
    got = setjoin.jaccard_components(frame, n, num, 100).collect()
    assert {r.doc_id: (r.n_shingles, r.component_id) for r in got} == {i: (len(sets[i]), want[i]) for i in sets}
    kept = [r.doc_id for r in setjoin.one_of_each(frame, n, num, 100).collect()]
    assert sorted(kept) == sorted(i for i in sets if want[i] == i)


def test_set_join_when_every_scan_cuts_other_batches(spark, monkeypatch):
    monkeypatch.setitem(common.WRITING, "spark.sql.execution.arrow.maxRecordsPerBatch", "20")
    bases = [" ".join(f"w{pair}x{k}" for k in range(100)) for pair in range(40)]
    frame = spark.createDataFrame([(i, f"{bases[i // 2]} end{i}") for i in range(80)], "doc_id long, text string").coalesce(1)

    def in_new_order(batches):
        rows = pa.Table.from_batches(batches)
        yield from rows.take(sorted(range(len(rows)), key=lambda _: os.urandom(8))).combine_chunks().to_batches()

    got = setjoin.jaccard_components(frame.mapInArrow(in_new_order, frame.schema)).collect()
    assert {r.doc_id: r.component_id for r in got} == {i: i // 2 * 2 for i in range(80)}


def test_set_join_on_odd_rows(odd):
    assert setjoin.jaccard_components(odd).count() == odd.count()
    assert setjoin.one_of_each(odd).columns == odd.columns
    assert setjoin.jaccard_components(odd.limit(0)).count() == 0


# pipeline


def test_pipeline_stages(spark, docs, odd, tmp_path):
    steps = [name for name, _ in corpus_pipeline.STAGES]
    assert len(steps) == 5
    for frame in (docs, odd, odd.limit(0)):
        at = frame
        for k, (name, stage) in enumerate(corpus_pipeline.STAGES):
            out = stage(spark, at, FOLDER)
            path = str(tmp_path / f"{id(frame)}-{name}")
            out.write.parquet(path)
            out = spark.read.parquet(path)
            if k < 4:
                assert sorted(out.columns) == sorted(frame.columns)
                assert out.count() <= at.count()
            else:
                assert out.select("doc_id").distinct().count() == at.select("doc_id").distinct().count()
            at = out
