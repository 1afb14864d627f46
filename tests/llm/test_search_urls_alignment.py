"""Stratified search, url verdicts and token alignment against brute force and on odd tables."""

from __future__ import annotations

import hashlib
import json
import math
import random
import re
import tracemalloc
from collections import Counter
from pathlib import Path

import numpy as np
import pandas as pd
import public_tokenizers
import pyarrow as pa
import pyarrow.parquet as pq
import pytest
import sentencepiece
from tokenizers import Tokenizer

import __spark_entry__ as entry
from venueops.llm import alignment, lexical, queries, urls
from venueops.llm.tokens import byte_letters

FOLDER = "/root/testdata/sf0.01"
DOCS = "doc_id long, text string, lang string, item_id string, term string, m int, pair string"
ODD_TEXTS = [
    None, "", " \t\n", "one", "One, ONE! two", "one", "naïve ÉTÉ 7x7", "<s> </s> <unk> [INST] <|endoftext|>", "▁low▁line", "a" * 700,
    "🙂🙃 \U0001d54f x", "tab\tand  two spaces\r\n", " lead", "trail ", "é combining", "日本語のテキスト", "\x01\x02 control",
]


@pytest.fixture(scope="module")
def odd(spark):
    rng = random.Random(5)
    vocabulary = ["one", "two", "naïve", "x", "Yes", "later,", "the", "of", "ÉTÉ", "7x7"]
    texts = ODD_TEXTS + [" ".join(rng.choices(vocabulary, k=n)) for n in [3, 3, 3, 8, 8, 40, 41, 500, 20_000]]
    rows = [(i, t, "l", "i", "t", 1, "p") for i, t in enumerate(texts)]
    rows += [rows[3], rows[-3], (None, "one two", None, None, None, None, None), (None, None, None, None, None, None, None)]
    return spark.createDataFrame(rows, DOCS)


def terms(text):
    return re.findall(r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+", re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))


def ranked_by_loops(docs, items, k):
    counted = [(i, Counter(terms(t))) for i, t in docs]
    n_docs = sum(1 for _, c in counted if c)
    n_terms = sum(sum(c.values()) for _, c in counted)
    df = Counter(t for _, c in counted for t in c)
    out = []
    asked = {}
    for item, text in items:
        asked.setdefault(item, set()).update(terms(text))
    for item, wanted in asked.items():
        found = []
        for doc, c in counted:
            m = 10 + (90 * sum(c.values()) * n_docs) // n_terms
            score = 0
            for t in wanted & c.keys():
                w = math.floor(1000 * math.log((2 * n_docs + 2) / (2 * df[t] + 1)))
                score += w * ((1_000_000_000 * c[t]) // (1000 * c[t] + 8 * m))
            if score > 0:
                found.append((-score, doc is None, doc))
        for rank, (score, _, doc) in enumerate(sorted(found)[:k], 1):
            out.append((item, rank, doc, -score))
    return sorted(out, key=repr)


ITEMS = [(0, "one two"), (1, "Naïve, 7x7 été; ÉTÉ"), (2, None), (3, ""), (4, "nowhere"), (5, "the the of of x yes later"), (5, "one"), (5, "one")]


@pytest.mark.parametrize("limits", [{}, {"BLOCK_DOCUMENTS": 2, "SEEDS": 1, "ITEM_TERMS": 3}, {"VOCABULARY": 2}])
def test_search_equals_loops(spark, odd, monkeypatch, limits):
    for name, value in limits.items():
        monkeypatch.setattr(lexical, name, value)
    items = spark.createDataFrame([(i, t, 1, 2) for i, t in ITEMS], "item_id int, text string, doc_id int, rank int")
    got = sorted((tuple(r) for r in lexical.ranked(odd, items, 4).select("item_id", "rank", "doc_id", "score").collect()), key=repr)
    want = ranked_by_loops([(r["doc_id"], r["text"]) for r in odd.collect()], ITEMS, 4)
    assert got == want


def test_search_of_one_length(spark):
    """All documents in one stratum, which is cut into blocks; most of them tie."""
    rng = random.Random(9)
    docs = [(i, " ".join(rng.choices("abcdefgh", k=12)) if i % 3 else "a b c d a b c d a b c d") for i in range(3000)]
    items = [(0, "a b"), (1, "h g f"), (2, "e")]
    got = lexical.ranked(spark.createDataFrame(docs, "doc_id long, text string"), spark.createDataFrame(items, "item_id int, text string"), 10)
    assert sorted((tuple(r) for r in got.select("item_id", "rank", "doc_id", "score").collect()), key=repr) == ranked_by_loops(docs, items, 10)


def test_search_of_nothing(spark):
    docs = spark.createDataFrame([(1, "one")], "doc_id long, text string")
    items = spark.createDataFrame([(1, "one")], "item_id long, text string")
    assert lexical.ranked(docs.limit(0), items).count() == 0
    assert lexical.ranked(docs, items.limit(0)).count() == 0
    assert lexical.ranked(docs, items).columns == ["item_id", "rank", "doc_id", "score"]


def test_bounds_hold_and_prune(spark, monkeypatch):
    """No score is above its block's bound, and blocks are left out."""
    docs = spark.read.parquet(f"{FOLDER}/documents.parquet")
    items = spark.read.parquet(f"{FOLDER}/benchmark.parquet")
    asked_terms = lexical.item_terms(items)
    index = lexical.build(docs, lexical.vocabulary(asked_terms))
    rows = [(r["item_id"], r["term"], 7) for r in asked_terms.collect()]
    asked = lexical.Asked([{"item_id": a, "term": b, "w": w} for a, b, w in rows], 10)
    blocks = lexical._opened(index.blocks.toArrow().combine_chunks().to_batches()[0])
    for row in blocks:
        bounds = asked.bounds(row["m"], row["term"], row["most"].to_numpy())
        block = lexical.Block(row, asked)
        for item in range(0, len(asked.ids), 7):
            assert block.scores(asked, item).max() <= bounds[item]
    best, visits = lexical.Best(asked), 0
    bounds = np.stack([asked.bounds(r["m"], r["term"], r["most"].to_numpy()) for r in blocks])
    for item in range(len(asked.ids)):
        for k in np.argsort(-bounds[:, item], kind="stable"):
            if bounds[k, item] < best.least[item]:
                break
            visits += 1
            best.visit(lexical.Block(blocks[k], asked), item)
    assert visits < 0.8 * bounds.size


# --- urls


def split_by_all_ways(name, counts, total):
    """The best split by trying every one."""
    def weight(word):
        if len(word) > urls.LONGEST:
            return -math.inf
        return math.log(counts[word] / total) if word in counts else math.log(10 / (total * 10 ** len(word)))

    best = None
    for mask in range(1 << (len(name) - 1)):
        words, begin = [], 0
        for k in range(1, len(name) + 1):
            if k == len(name) or mask >> (k - 1) & 1:
                words.append(name[begin:k])
                begin = k
        score = sum(map(weight, words))
        if best is None or score > best[0] + 1e-12:
            best = (score, words)
    return best


def test_split_is_the_most_probable():
    rng = random.Random(1)
    counts = {"a": 5, "ab": 9, "aba": 2, "b": 3, "ba": 8, "bab": 1, "cab": 4, "free": 50, "bets": 7}
    total = sum(counts.values())
    for _ in range(150):
        name = "".join(rng.choices("abc", k=rng.randint(1, 10)))
        words = urls.best_split(name, counts, total)
        score, _ = split_by_all_ways(name, counts, total)
        mine = sum(math.log(counts[w] / total) if w in counts else math.log(10 / (total * 10 ** len(w))) for w in words)
        assert "".join(words) == name and abs(mine - score) < 1e-9
    assert urls.best_split("freebets", counts, total) == ["free", "bets"]
    assert urls.best_split("zzzzz", counts, total) == ["zzzzz"]
    assert urls.best_split("", counts, total) == []


def test_names_of_any_length_are_whole(spark):
    names = spark.createDataFrame([("freebets",), ("freebets",), ("x" * 500,), ("",), (None,)], "name string")
    counts = spark.createDataFrame([("free", 5), ("bets", 3)], "word string, count long")
    got = {r["name"]: r["words"] for r in urls.segmented(names, counts).collect()}
    assert got["freebets"] == ["free", "bets"]
    assert set(got) == {"freebets", "x" * 500} and "".join(got["x" * 500]) == "x" * 500


ODD_URLS = [
    None, "", "no scheme", "://", "http://", "HTTP://WWW.Example.NET", "http://x.net/", "http://x.net?a/b", "http://x.net#/en/",
    "https://A.example.net/en/7?q=http://b.org/fr/", "https://example.net/en", "https://example.net/en/", "http://badexample.net/en/1",
    "http://deep.er.example.com/de/x#y", "http://example.com/DE/x", "http://fr.org/fr/", "http://org/fr/a", "http://net/", "http://u:p@h.net:80/",
    "http://ÀB.org/fr/ü", "a://b://c.net/d", "http://x.net/en/\n2", "http://" + "a." * 300 + "net/" + "b" * 3000,
]


def rule_by_loops(url):
    host = path = ""
    if url is not None and "://" in url:
        rest = url[url.index("://") + 3 :]
        host = re.match(r"[^/?#]*", rest)[0]
        path = re.match(r"[^?#]*", rest[len(host) :])[0]
        host = re.sub("[A-Z]", lambda m: m[0].lower(), host)
    fits = []
    for rule, verdict in queries.URL_RULES.items():
        of, begin = rule[: rule.index("/")], rule[rule.index("/") :]
        if (host == of or host.endswith("." + of)) and path.startswith(begin):
            fits.append((len(rule), rule, verdict))
    return host, path, *(max(fits)[1:] if fits else (None, None))


def test_hosts_paths_and_rules(spark):
    rows = [(i, u, "h", "p", 1.0) for i, u in enumerate(ODD_URLS)] + [(0, None, None, None, None), (None, ODD_URLS[9], None, None, None)]
    pages = spark.createDataFrame(rows, "page_id long, url string, host string, path string, score double")
    rules = spark.createDataFrame(list(queries.URL_RULES.items()), "rule string, verdict string")
    none = spark.createDataFrame([], "host string, path string, label string")
    counts = spark.createDataFrame([], "word string, count long")
    got = urls.judged(pages, rules, none, counts).select("page_id", "host", "path", "rule", "verdict").collect()
    want = [(r[0], *rule_by_loops(r[1])) for r in rows]
    want = [(a, b, c, d, v or "allow") for a, b, c, d, v in want]  # without labels the method allows
    assert sorted(map(tuple, got), key=repr) == sorted(want, key=repr)
    assert urls.judged(pages, rules.limit(0), none, counts).filter("rule is not null").count() == 0
    assert urls.judged(pages.limit(0), rules, none, counts).count() == 0


def test_longest_rule_wins(spark):
    rules = spark.createDataFrame([("com/", "block"), ("a.com/x/", "allow"), ("a.com/x/y", "block"), ("b.a.com/", "allow")], "rule string, verdict string")
    asked = ["a.com /x/z", "a.com /x/yy", "b.a.com /x/y", "b.a.com /q", "c.com /", "com /", "b.a.com /x/"]
    found = spark.createDataFrame([tuple(x.split()) for x in asked], "host string, path string")
    got = {f"{r['host']} {r['path']}": r["rule"] for r in urls.ruled(found, rules).collect()}
    assert got == dict(zip(asked, ["a.com/x/", "a.com/x/y", "a.com/x/y", "b.a.com/", "com/", "com/", "b.a.com/"], strict=True)) | {
        "b.a.com /x/": "b.a.com/"  # as long as a.com/x/, longer host
    }


def test_verdicts_equal_naive_bayes_by_loops(spark):
    """The whole query on sf0.01: words counted, names split, evidence added up in plain Python."""
    pages = pd.read_parquet(f"{FOLDER}/pages.parquet")
    counts = Counter()
    for html in pages.html.dropna():
        words = re.findall(r"[^\W\d_]+", re.sub(r"<[^>]*>", " ", html).lower())
        counts.update(w for w in words if len(w) <= urls.LONGEST)
    total = sum(counts.values())
    found = [(p, *rule_by_loops(u)) for p, u in zip(pages.page_id, pages.url, strict=True)]

    def tokens(host, path):
        out = []
        for name in re.findall(r"[^\W\d_]+", host.lower()):
            out += [f"host {w}" for w in urls.best_split(name, counts, total)]
        return out + [f"path {w}" for w in re.findall(r"[^\W\d_]+|0", re.sub(r"\d+", " 0 ", path.lower()))]

    seen = {"block": Counter(), "allow": Counter()}
    labels = {}
    for _, host, path, _, _ in found:
        if host:
            bad = set(re.findall(r"[^\W\d_]+", host)) & set(queries.SUSPECTS)
            labels[host, path] = "block" if bad else "allow"
    for (host, path), label in labels.items():
        seen[label].update(tokens(host, path))
    vocabulary = set(seen["block"]) | set(seen["allow"])
    share = Counter(labels.values())
    score = {}
    for _, host, path, _, _ in found:
        s = math.log(share["block"] / share["allow"])
        for t in tokens(host, path):
            if t in vocabulary:
                odds = [(seen[x][t] + 1) / (sum(seen[x].values()) + len(vocabulary)) for x in ("block", "allow")]
                s += math.log(odds[0] / odds[1])
        score[host, path] = s
    want = {(p, h, q, r, v or ("block" if score[h, q] > 0 else "allow")): score[h, q] for p, h, q, r, v in found}
    got = queries.op12_url_words(spark, FOLDER).collect()
    mine = {(r["page_id"], r["host"], r["path"], r["rule"], r["verdict"]): r["score"] for r in got}
    assert mine.keys() == want.keys()
    assert all(abs(mine[k] - want[k]) < 1e-5 for k in want)
    assert {"block", "allow"} == {v for _, _, _, r, v in want if r is None}


# --- alignment


def aligned_by_loops(rows):
    tool = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
    tool.encode_special_tokens = True
    letters = byte_letters()
    with open(public_tokenizers.path("byte_bpe_50k.json"), encoding="utf-8") as file:
        entry_of = {i: t for t, i in json.load(file)["model"]["vocab"].items()}
    other = sentencepiece.SentencePieceProcessor(model_file=public_tokenizers.path("piece_bpe_32k.model"))

    def piece(i):
        text = other.id_to_piece(i)
        return bytes([int(text[3:5], 16)]) if re.fullmatch("<0x[0-9A-F]{2}>", text) else text.replace("▁", " ").encode()

    per, count = [], Counter()
    for doc, text in rows:
        a = b = []
        if text:
            a, b = tool.encode(" " + text, add_special_tokens=False).ids, other.encode(text)
            a_bytes = [bytes(letters[c] for c in entry_of[i]) for i in a]
            b_bytes = [piece(i) for i in b]
            if not b"".join(a_bytes) == b"".join(b_bytes) == (" " + text).encode():
                a = b = []
        groups, mine, theirs, i, j, x, y = [], [], [], 0, 0, 0, 0
        while i < len(a) or j < len(b):
            if i < len(a) and (x <= y or j == len(b)):
                mine.append(a[i])
                x += len(a_bytes[i])
                i += 1
            else:
                theirs.append(b[j])
                y += len(b_bytes[j])
                j += 1
            if x == y:
                groups.append((mine, theirs))
                mine, theirs = [], []
        links = Counter((p, q) for g, h in groups for p in g for q in h)
        count.update(links.keys())
        per.append((doc, a, b, groups, links))
    top = Counter()
    for (p, _), n in count.items():
        top[p] = max(top[p], n)
    out = []
    for doc, a, b, groups, links in per:
        line = ";".join(",".join(map(str, g)) + "|" + ",".join(map(str, h)) for g, h in groups)
        best = sum(n for (p, q), n in links.items() if count[p, q] == top[p])
        total = sum(n * count[x] for x, n in links.items())
        digest = hashlib.sha256(line.encode()).hexdigest() if a else ""
        out.append((doc, len(a), len(b), len(groups), sum(links.values()), best, total, digest))
    return sorted(out, key=repr)


ALIGNED = ["doc_id", "n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum", "groups_sha256"]


@pytest.mark.parametrize("limits", [{}, {"CHUNK": 50, "PRODUCT": 7}])
def test_alignment_equals_loops(odd, monkeypatch, limits):
    for name, value in limits.items():
        monkeypatch.setattr(alignment, name, value)
    got = sorted((tuple(r) for r in alignment.aligned(odd).select(*ALIGNED).collect()), key=repr)
    assert got == aligned_by_loops([(r["doc_id"], r["text"]) for r in odd.collect()])


def test_alignment_query_equals_loops(spark):
    some = spark.read.parquet(f"{FOLDER}/documents.parquet")
    got = sorted((tuple(r) for r in queries.op13_token_alignment(spark, FOLDER).select(*ALIGNED).collect()), key=repr)
    assert got == aligned_by_loops([(r["doc_id"], r["text"]) for r in some.collect()])


def test_alignment_of_nothing(spark):
    assert alignment.aligned(spark.createDataFrame([], DOCS)).count() == 0


def test_alignment_in_parts_equals_loops(odd, monkeypatch):
    for name, value in {"CHUNK": 400, "PART": 60}.items():
        monkeypatch.setattr(alignment, name, value, raising=False)
    got = sorted((tuple(r) for r in alignment.aligned(odd).select(*ALIGNED).collect()), key=repr)
    assert got == aligned_by_loops([(r["doc_id"], r["text"]) for r in odd.collect()])


def test_alignment_chunks_are_read_and_written_a_few_at_a_time(odd, monkeypatch):
    paths, written = [], alignment.written

    def watched(*args):
        frame, path = written(*args)
        paths.append(path.removeprefix("file:"))
        return frame, path

    monkeypatch.setattr(alignment, "written", watched)
    monkeypatch.setattr(alignment, "CHUNK", 20)
    alignment.aligned(odd.coalesce(1)).count()
    groups = [m.row_group(k).num_rows for f in Path(paths[0]).glob("*.parquet") for m in [pq.read_metadata(f)] for k in range(m.num_row_groups)]
    assert sum(groups) > 8 and max(groups) <= 8


def test_alignment_of_a_chunk_takes_little_memory():
    pieces = Path(public_tokenizers.path("piece_bpe_32k.model")).read_bytes()
    tool = alignment.Tokenizers(Path(public_tokenizers.path("byte_bpe_50k.json")).read_text("utf-8"), pieces)
    some = pq.read_table(f"{FOLDER}/documents.parquet", columns=["text"])["text"].drop_null().to_pylist()
    texts = []
    while sum(len(x) for x in texts) < 2_000_000:
        texts += some
    one = pa.array(texts, pa.large_string()), pa.array(range(len(texts)), pa.int64())
    tracemalloc.start()
    try:
        alignment._chunk(tool, one[1], one[0])
        peak = tracemalloc.get_traced_memory()[1]
    finally:
        tracemalloc.stop()
    assert peak < 60e6


def test_products_equal_dense_ones():
    rng = np.random.default_rng(2)
    for n in (0, 1, 30):
        a, b = rng.integers(0, 9, n), rng.integers(0, 7, n)
        left = alignment.Rows.of(rng.integers(0, 5, n), a, 5)
        right = alignment.Rows.of(b, rng.integers(0, 6, n), 9)
        dense = [np.zeros((5, 9), int), np.zeros((9, 6), int)]
        for part, full in zip((left, right), dense, strict=True):
            for r in range(len(part.edges) - 1):
                for k in range(part.edges[r], part.edges[r + 1]):
                    full[r, part.columns[k]] += part.values[k]
        mine = np.zeros((5, 6), int)
        for rows, columns, values in alignment.product(left, right):
            mine[rows, columns] += values
        assert (mine == dense[0] @ dense[1]).all()


def test_overlaps_are_the_product_of_token_byte_matrices():
    rng = np.random.default_rng(3)
    for _ in range(20):
        a = rng.integers(1, 5, rng.integers(1, 9))
        b = []
        while sum(b) < a.sum():
            b.append(min(int(rng.integers(1, 6)), int(a.sum()) - sum(b)))
        a_bytes, b_bytes = (np.repeat(np.eye(len(x), dtype=int), x, axis=1) for x in (a, b))
        dense = a_bytes @ b_bytes.T
        rows, columns, shared = alignment.overlaps(a, np.array(b))
        mine = np.zeros_like(dense)
        mine[rows, columns] = shared
        assert (mine == dense).all() and (shared > 0).all()


def test_new_queries_are_registered():
    assert {"op11_stratified_search", "op12_url_words", "op13_token_alignment"} <= set(entry.queries())
    assert "op11_stratified_search" in entry.oracle_sql()
