"""URL verdicts: rules by host and path, else naive Bayes over the words of host and path.

The rule whose host is the url's host or a parent domain and whose path begins the url's path decides, the longest one
first. Urls without a rule are scored: concatenated names in hosts are cut into words by the most probable path
under a unigram model (word counts over the pages' whole texts), and multinomial naive Bayes adds up the evidence
of the host's words and the path's tokens.

Hosts and paths are decided once each, not once per page: the score of a url is the sum of its host's and its path's.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from venueops.llm.common import checkpointed

LONGEST = 24  # characters of the longest word a name is cut into
SAMPLE = 50_000  # most labelled urls per class that the classifier learns from
SMOOTHING = 1.0
CAPITALS, SMALL = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def host_and_path(url: Column) -> tuple[Column, Column]:
    """After the first ``://`` up to ``/``, ``?``, ``#`` or the end, A-Z lower-cased; then up to ``?``, ``#`` or the end.
    Both are empty for a null url and one without ``://``."""
    rest = F.when(F.instr(url, "://") > 0, F.substring(url, F.instr(url, "://") + 3, F.length(url))).otherwise("")
    host = F.regexp_extract(rest, "^[^/?#]*", 0)
    path = F.regexp_extract(F.substring(rest, F.length(host) + 1, F.length(rest)), "^[^?#]*", 0)
    return F.translate(host, CAPITALS, SMALL), path


def names_of(host: Column) -> Column:
    """A host's runs of letters, in order."""
    return F.filter(F.split(F.lower(host), r"\P{L}+"), lambda x: x != "")


def path_tokens(path: Column) -> Column:
    """A path's runs of letters, and one token for each run of digits whatever they are."""
    plain = F.regexp_replace(F.lower(path), r"\p{N}+", " 0 ")
    return F.filter(F.split(plain, r"[^\p{L}0]+"), lambda x: x != "")


def word_counts(texts: DataFrame) -> DataFrame:
    """(word, count) over the column ``text`` of all rows; markup between < and > is not text."""
    plain = F.regexp_replace(F.col("text"), "<[^>]*>", " ")
    words = texts.select(F.explode(F.split(F.lower(plain), r"\P{L}+")).alias("word"))
    return words.filter(F.length("word").between(1, LONGEST)).groupBy("word").agg(F.count(F.lit(1)).alias("count"))


def best_split(name: str, known: dict[str, int], total: int) -> list[str]:
    """The most probable words that make up ``name``. A piece that is no known word has the weight of a word seen
    10 / 10^length times, so that one unknown word beats several. Of equal splits, the one with the shortest last word."""
    log_total = math.log(max(total, 1))
    unknown = [math.log(10) * (1 - k) - log_total for k in range(len(name) + 1)]
    best, cut = [0.0], [0]
    for end in range(1, len(name) + 1):
        top, at = -math.inf, end - 1
        for start in range(end - 1, max(-1, end - LONGEST - 1), -1):
            count = known.get(name[start:end])
            weight = math.log(count) - log_total if count else unknown[end - start]
            if best[start] + weight > top:
                top, at = best[start] + weight, start
        best.append(top)
        cut.append(at)
    words, end = [], len(name)
    while end:
        words.append(name[cut[end] : end])
        end = cut[end]
    return words[::-1]


def segmented(names: DataFrame, counts: DataFrame) -> DataFrame:
    """(name, words): each distinct name cut into its most probable words.

    A name meets only its own substrings among ``counts`` (word, count), which stays a table of any size. Nulls and
    empty names are left out.
    """
    names = names.select("name").filter("name <> ''").distinct()
    pieces = F.expr(
        f"array_distinct(flatten(transform(sequence(1, length(name)), i -> "
        f"transform(sequence(1, least({LONGEST}, length(name) - i + 1)), n -> substring(name, i, n)))))"
    )
    met = names.select("name", F.explode(pieces).alias("word")).join(counts, "word")
    known = met.groupBy("name").agg(F.collect_list(F.struct("word", "count")).alias("known"))  # substrings of one name
    total = counts.agg(F.sum("count").alias("n")).first()["n"] or 0

    def each(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            names, found = batch.column(0).to_pylist(), batch.column(1).to_pylist()
            words = [
                best_split(name, {x["word"]: x["count"] for x in mine or []}, total)
                for name, mine in zip(names, found, strict=True)
            ]
            yield pa.RecordBatch.from_arrays([pa.array(names), pa.array(words, pa.list_(pa.string()))], ["name", "words"])

    return names.join(known, "name", "left").select("name", "known").mapInArrow(each, "name string, words array<string>")


def ruled(urls: DataFrame, rules: DataFrame) -> DataFrame:
    """``urls`` (host, path; distinct) that a rule fits, with that ``rule`` and its ``verdict``.

    ``rules`` have rule (host/path) and verdict. A url looks up the rules by its host's suffixes and by beginnings of its
    path of the lengths that rules have, so that no rule is compared with every url. Longest rule first, then longest
    host.
    """
    parts = rules.select(
        F.substring_index("rule", "/", 1).alias("rule_host"),
        F.col("rule").substr(F.instr("rule", "/"), F.length("rule")).alias("rule_path"),
        "rule",
        "verdict",
    ).distinct()
    lengths = sorted(r["n"] for r in parts.select(F.length("rule_path").alias("n")).distinct().collect())
    depth = parts.agg(F.max(F.size(F.split("rule_host", r"\."))).alias("n")).first()["n"]
    if not lengths:
        return urls.select("host", "path", F.lit(None).cast("string").alias("rule"), F.lit(None).cast("string").alias("verdict")).limit(0)
    suffixes = F.expr(
        f"transform(sequence(1, least({depth}, size(split(host, '[.]')))), k -> substring_index(host, '.', -k))"
    )
    begins = F.array_distinct(F.array(*[F.substring("path", 1, n) for n in lengths]))
    asked = urls.select("host", "path", F.explode(suffixes).alias("rule_host"), begins.alias("begins")).select(
        "host", "path", "rule_host", F.explode("begins").alias("rule_path")
    )
    order = F.struct(F.length("rule"), F.length("rule_host"), "verdict")
    return (
        asked.join(parts, ["rule_host", "rule_path"])
        .groupBy("host", "path")
        .agg(F.max_by("rule", order).alias("rule"), F.max_by("verdict", order).alias("verdict"))
    )


def evidence(labelled: DataFrame, host_words: DataFrame) -> tuple[DataFrame, float]:
    """((token, weight), prior): log odds of block over allow for each token, and for any url.

    ``labelled`` (host, path, label: block or allow) gives at most ``SAMPLE`` urls of each label, those of least
    hash, for the tokens; the prior is over all. Without both labels there is no evidence and a prior that allows.
    """
    urls = labelled.filter(F.col("label").isin("block", "allow")).select("host", "path", "label").distinct()
    shares = {r["label"]: r["n"] for r in urls.groupBy("label").agg(F.count(F.lit(1)).alias("n")).collect()}
    if len(shares) < 2:
        prior = 1.0 if "block" in shares else -1.0
        return labelled.sparkSession.createDataFrame([], "token string, weight double"), prior
    by_hash = [F.xxhash64("host", "path"), F.col("host"), F.col("path")]
    parts = [urls.filter(F.col("label") == x).orderBy(*by_hash).limit(SAMPLE) for x in ("block", "allow")]
    some = parts[0].unionByName(parts[1])
    tokens = tokens_of_hosts(some, host_words).unionByName(tokens_of_paths(some))
    seen = tokens.groupBy("token").agg(
        F.count_if(F.col("label") == "block").alias("bad"), F.count_if(F.col("label") == "allow").alias("good")
    )
    seen = checkpointed(seen)
    total = seen.agg(F.sum("bad").alias("bad"), F.sum("good").alias("good"), F.count(F.lit(1)).alias("n")).first()
    room = SMOOTHING * total["n"]
    weight = F.log((F.col("bad") + SMOOTHING) / ((total["bad"] or 0) + room)) - F.log(
        (F.col("good") + SMOOTHING) / ((total["good"] or 0) + room)
    )
    return seen.select("token", weight.alias("weight")), math.log(shares["block"] / shares["allow"])


def tokens_of_hosts(urls: DataFrame, host_words: DataFrame) -> DataFrame:
    """``urls`` once for each word of their host."""
    named = urls.withColumn("name", F.explode(names_of(F.col("host"))))
    words = named.join(host_words, "name").withColumn("word", F.explode("words"))
    return words.withColumn("token", F.concat(F.lit("host "), F.col("word"))).drop("name", "words", "word")


def tokens_of_paths(urls: DataFrame) -> DataFrame:
    """``urls`` once for each token of their path."""
    found = urls.withColumn("word", F.explode(path_tokens(F.col("path"))))
    return found.withColumn("token", F.concat(F.lit("path "), F.col("word"))).drop("word")


def judged(pages: DataFrame, rules: DataFrame, labelled: DataFrame, counts: DataFrame) -> DataFrame:
    """One row per page: page_id, host, path, rule, verdict, score.

    ``pages`` have page_id and url; ``rules`` rule and verdict; ``labelled`` host, path and label, which teach the
    classifier; ``counts`` word and count. A page under a rule has its verdict; another is blocked if its log odds
    (``score``) are above 0, else allowed, also where host and path are empty. Repeated pages have a row each; a
    null page_id stays null. A host with a large share of the pages is decided once and joined back, a join that Spark
    broadcasts or splits.
    """
    host, path = host_and_path(F.col("url"))
    found = checkpointed(pages.select("page_id", host.alias("host"), path.alias("path")))
    urls = found.select("host", "path").distinct()
    hosts, paths = urls.select("host").distinct(), urls.select("path").distinct()
    names = hosts.unionByName(labelled.select("host")).select(F.explode(names_of(F.col("host"))).alias("name"))
    host_words = checkpointed(segmented(names, counts))
    weights, prior = evidence(labelled, host_words)
    weights = checkpointed(weights)

    def scores(tokens: DataFrame, key: str) -> DataFrame:
        return tokens.join(weights, "token").groupBy(key).agg(F.sum("weight").alias(f"{key}_score"))

    by_rule = ruled(urls, rules)
    score = F.lit(prior) + F.coalesce("host_score", F.lit(0.0)) + F.coalesce("path_score", F.lit(0.0))
    guess = F.when(F.col("score") > 0, "block").otherwise("allow")
    return (
        found.join(scores(tokens_of_hosts(hosts, host_words), "host"), "host", "left")
        .join(scores(tokens_of_paths(paths), "path"), "path", "left")
        .join(by_rule, ["host", "path"], "left")
        .withColumn("score", score)
        .select("page_id", "host", "path", "rule", F.coalesce("verdict", guess).alias("verdict"), F.round("score", 6).alias("score"))
    )


def labelled_by(urls: DataFrame, suspects: tuple[str, ...]) -> DataFrame:
    """(host, path, label): ``block`` for hosts that have one of ``suspects`` as a whole run of letters, else ``allow``."""
    host, path = host_and_path(F.col("url"))
    named = urls.select(host.alias("host"), path.alias("path")).filter("host <> ''").distinct()
    bad = F.arrays_overlap(names_of(F.col("host")), F.array(*map(F.lit, suspects)))
    return named.select("host", "path", F.when(bad, "block").otherwise("allow").alias("label"))
