"""The operators of this folder bound to the test tables, each over its whole table with production parameters."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from venueops.llm import (
    alignment,
    chat,
    lexical,
    licences,
    packing,
    repeats,
    setjoin,
    shards,
    tiling,
    token_bins,
    toxicity,
    urls,
    vectors,
)
from venueops.llm.common import checkpointed


def _table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def op1_hash_tree(spark: SparkSession, sf_dir: str) -> DataFrame:
    return shards.sharded(_table(spark, sf_dir, "documents"), shards=40)


def op2_token_bins(spark: SparkSession, sf_dir: str) -> DataFrame:
    return token_bins.packed_ids(_table(spark, sf_dir, "documents"), length=1024)


def op3_vector_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.pack_documents(_table(spark, sf_dir, "documents"), length=1024)


def op4_compression_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = toxicity.scored(_table(spark, sf_dir, "documents"), _table(spark, sf_dir, "labels"))
    return found.select("doc_id", "held_out", "score", "predicted")


def op5_licence_digests(spark: SparkSession, sf_dir: str) -> DataFrame:
    return licences.scanned(_table(spark, sf_dir, "documents"))


def op6_suffix_repeats(spark: SparkSession, sf_dir: str) -> DataFrame:
    return repeats.repeats_report(_table(spark, sf_dir, "documents"), length=400)


def op7_collision_counting(spark: SparkSession, sf_dir: str) -> DataFrame:
    return vectors.linked_vectors(_table(spark, sf_dir, "embeddings"), cosine=0.93)


def op8_chat_windows(spark: SparkSession, sf_dir: str) -> DataFrame:
    turns = _table(spark, sf_dir, "conversations").select("conv_id", "turn", "role", "text")
    said = "</s>[INST] ok [/INST]"
    role = F.when(F.col("id") == 0, "user").otherwise("assistant")
    values = {"conv_id": F.lit(-7), "turn": F.col("id"), "role": role, "text": F.lit(said)}
    probe = spark.range(2).select(*[values[f.name].cast(f.dataType).alias(f.name) for f in turns.schema])
    return chat.read_back(chat.formatted(turns.unionByName(probe)))


def op9_string_tiling(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = tiling.contaminated(_table(spark, sf_dir, "documents"), _table(spark, sf_dir, "benchmark"))
    return found.select("doc_id", "item_id", "item_tokens", "covered", "coverage", "tiles")


def op10_jaccard_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = setjoin.jaccard_components(_table(spark, sf_dir, "documents"), n_words=3, num=90, den=100)
    return found.select("doc_id", "n_shingles", "component_id")


def op11_stratified_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    return lexical.ranked(_table(spark, sf_dir, "documents"), _table(spark, sf_dir, "benchmark"), k=10)


# Rules with their verdicts, and words that name kinds of sites to block.
URL_RULES = {"net/": "block", "example.net/en/": "allow", "example.com/de/": "block", "org/fr/": "allow"}
SUSPECTS = "ads adult betting bets casino escort gambling lottery pills poker porn spam viagra warez xxx".split()


def op12_url_words(spark: SparkSession, sf_dir: str) -> DataFrame:
    pages = _table(spark, sf_dir, "pages")
    rules = spark.createDataFrame(list(URL_RULES.items()), "rule string, verdict string")
    counts = checkpointed(urls.word_counts(pages.select(F.col("html").alias("text"))))
    return urls.judged(pages, rules, urls.labelled_by(pages, tuple(SUSPECTS)), counts)


def op13_token_alignment(spark: SparkSession, sf_dir: str) -> DataFrame:
    return alignment.aligned(_table(spark, sf_dir, "documents"))


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return {
        "op1_hash_tree": op1_hash_tree,
        "op2_token_bins": op2_token_bins,
        "op3_vector_packing": op3_vector_packing,
        "op4_compression_toxicity": op4_compression_toxicity,
        "op5_licence_digests": op5_licence_digests,
        "op6_suffix_repeats": op6_suffix_repeats,
        "op7_collision_counting": op7_collision_counting,
        "op8_chat_windows": op8_chat_windows,
        "op9_string_tiling": op9_string_tiling,
        "op10_jaccard_join": op10_jaccard_join,
        "op11_stratified_search": op11_stratified_search,
        "op12_url_words": op12_url_words,
        "op13_token_alignment": op13_token_alignment,
    }


# Links by cosine, closed to components.
_OP7 = """
WITH RECURSIVE able AS (
    SELECT vec_id, label, embedding::DOUBLE[] AS v FROM embeddings WHERE label IS NOT NULL),
links AS (
    SELECT a.vec_id AS a, b.vec_id AS b FROM able a JOIN able b ON a.label = b.label AND a.vec_id <> b.vec_id
    WHERE list_cosine_similarity(a.v, b.v) >= 0.93),
reach(node, other) AS (
    SELECT a, b FROM links UNION SELECT reach.node, links.b FROM reach JOIN links ON reach.other = links.a),
least AS (SELECT node, min(other) AS other FROM reach GROUP BY node),
counts AS (SELECT a, count(*) AS n FROM links GROUP BY a)
SELECT vec_id, coalesce(n, 0) AS n_links, least(vec_id, coalesce(other, vec_id)) AS component_id,
    vec_id = least(vec_id, coalesce(other, vec_id)) AS kept
FROM embeddings LEFT JOIN counts ON a = vec_id LEFT JOIN least ON node = vec_id
"""

# Distinct shingles as strings; candidate pairs share one.
_OP10 = """
WITH RECURSIVE words AS (
    SELECT doc_id, regexp_extract_all(
        translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
        '[^\\x20\\x09-\\x0D]+') AS w
    FROM documents),
shingles AS (
    SELECT DISTINCT doc_id, s FROM (
        SELECT doc_id, unnest(CASE WHEN len(w) >= 3
            THEN list_transform(range(1, len(w) - 1), lambda i: w[i] || ' ' || w[i + 1] || ' ' || w[i + 2])
            WHEN len(w) > 0 THEN [array_to_string(w, ' ')] ELSE [] END) AS s
        FROM words)),
sizes AS (SELECT doc_id, count(*) AS n FROM shingles GROUP BY doc_id),
shared AS (
    SELECT a.doc_id AS a, b.doc_id AS b, count(*) AS n FROM shingles a JOIN shingles b ON a.s = b.s AND a.doc_id <> b.doc_id
    GROUP BY ALL),
links AS (
    SELECT a, b FROM shared JOIN sizes x ON x.doc_id = a JOIN sizes y ON y.doc_id = b
    WHERE 100 * shared.n >= 90 * (x.n + y.n - shared.n)),
reach(node, other) AS (
    SELECT a, b FROM links UNION SELECT reach.node, links.b FROM reach JOIN links ON reach.other = links.a),
least AS (SELECT node, min(other) AS other FROM reach GROUP BY node)
SELECT d.doc_id, coalesce(n, 0) AS n_shingles, least(d.doc_id, coalesce(other, d.doc_id)) AS component_id
FROM documents d LEFT JOIN sizes ON sizes.doc_id = d.doc_id LEFT JOIN least ON node = d.doc_id
"""

# Every document's score for every item that shares a term with it.
_OP11 = """
WITH terms AS (
    SELECT kind, id, unnest(regexp_extract_all(
        translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
        '[^\\x00-\\x2F\\x3A-\\x40\\x5B-\\x60\\x7B-\\x7F]+')) AS term
    FROM (SELECT 'd' AS kind, doc_id AS id, text FROM documents UNION ALL SELECT 'i', item_id, text FROM benchmark)),
lengths AS (SELECT id AS doc_id, count(*) AS n FROM terms WHERE kind = 'd' GROUP BY id),
totals AS (SELECT count(*) AS docs, sum(n)::BIGINT AS terms FROM lengths),
strata AS (SELECT doc_id, 10 + (90 * n * docs) // terms AS m FROM lengths, totals),
asked AS (SELECT DISTINCT id AS item_id, term FROM terms WHERE kind = 'i'),
postings AS (
    SELECT id AS doc_id, term, count(*) AS tf FROM terms WHERE kind = 'd' AND term IN (SELECT term FROM asked) GROUP BY ALL),
weights AS (
    SELECT term, floor(1000 * ln((2.0::DOUBLE * any_value(docs) + 2) / (2.0::DOUBLE * count(*) + 1)))::BIGINT AS w
    FROM postings, totals GROUP BY term),
scores AS (
    SELECT item_id, doc_id, sum(w * ((1000000000 * tf) // (1000 * tf + 8 * m)))::BIGINT AS score
    FROM asked JOIN postings USING (term) JOIN weights USING (term) JOIN strata USING (doc_id) GROUP BY ALL)
SELECT item_id, (row_number() OVER (PARTITION BY item_id ORDER BY score DESC, doc_id))::INTEGER AS rank, doc_id, score
FROM scores WHERE score > 0 QUALIFY rank <= 10
"""


def oracle_sql() -> dict[str, str]:
    """Sharding hashes, tokens, compression, byte spans, windows and tilings are beyond SQL; see the tests."""
    return {"op5_licence_digests": licences.sql(), "op7_collision_counting": _OP7, "op10_jaccard_join": _OP10, "op11_stratified_search": _OP11}
