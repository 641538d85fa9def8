"""URL filter: rules first, then words of host and path judged by naive Bayes.

A rule is host/path; it fits its host and all subdomains if the url's path starts with the
rule's, and the longest rule that fits decides. For the rest:

1. Unigram counts of words, over the text of all pages.
2. Word segmentation: the labels of every host (each distinct label once) are split into
   the most probable sequence of words by the Viterbi algorithm over their substrings. A
   word of n letters that was never seen has a probability falling with n, so that unknown
   names stay whole. Words may have any length. Only substrings of labels are looked up, by a join: those of
   up to SEED letters, and longer words by their first SEED letters, so that a label of n letters makes
   at most n * SEED rows; the word counts are never gathered.
3. Multinomial naive Bayes over the words of host and path, each as often as it occurs, learnt from the pages that the
   rules decide; the words that rules themselves name are left out. Words are hashed into
   BUCKETS buckets, which bounds the model.

A url that no rule fits is blocked if its log odds are above 0; if the rules decide no page of
one class there is nothing to learn, and it is allowed. Null urls and urls without "://"
have empty host and path, which no rule fits and no word speaks against: they are allowed.
Repeated rows and ids are judged each. Other columns are not read.
"""

from __future__ import annotations

import math
import re

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from kiln.llm.common import pick, ship, written

#: (verdict, rule), fixed by the contract of the query.
RULES = (("block", "net/"), ("allow", "example.net/en/"), ("block", "example.com/de/"), ("allow", "org/fr/"))

BUCKETS = 1 << 16
SEED = 20
CHUNK = 256


def url_parts(url: Column) -> tuple[Column, Column]:
    """(host, path): after the first "://" up to /, ? or #, lower-cased; then up to ? or #."""
    rest = F.when(F.instr(url, "://") > 0, F.regexp_extract(url, r"(?s)^.*?://(.*)$", 1)).otherwise(F.lit(""))
    rest = F.coalesce(rest, F.lit(""))
    host = F.regexp_extract(rest, r"(?s)^([^/?#]*)", 1)
    path = F.regexp_extract(rest, r"(?s)^[^/?#]*([^?#]*)", 1)
    lower = F.translate(host, "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
    return lower, path


def rule_column(host: Column, path: Column, rules=RULES) -> tuple[Column, Column]:
    """(rule, verdict) of the longest rule that fits, null if none does. Of equally long ones the
    first listed counts."""
    rule, verdict = F.lit(None).cast("string"), F.lit(None).cast("string")
    for how, text in sorted(reversed(rules), key=lambda r: len(r[1])):
        of_host, _, of_path = text.partition("/")
        fits = ((host == of_host) | host.endswith("." + of_host)) & path.startswith("/" + of_path)
        rule = F.when(fits, F.lit(text)).otherwise(rule)
        verdict = F.when(fits, F.lit(how)).otherwise(verdict)
    return rule, verdict


def rule_words(rules=RULES) -> list[str]:
    """The words of the rules' hosts and, after a slash, of their paths."""
    out = set()
    for _, text in rules:
        host, _, path = text.lower().partition("/")
        out |= set(re.findall("[a-z]+", host)) | {f"/{w}" for w in re.findall("[a-z]+", path)}
    return sorted(out)


def word_counts(texts: DataFrame, text_col: str, mark_up: bool = True) -> DataFrame:
    """(word, n): ASCII words of any length, lower-cased, over all rows."""
    text = F.coalesce(F.col(text_col), F.lit(""))
    if mark_up:
        text = F.regexp_replace(text, r"<[^>]*>", " ")
    return (texts.select(F.explode(F.split(F.lower(text), r"[^a-z]+", -1)).alias("word"))
            .where(F.col("word") != "").groupBy("word").agg(F.count(F.lit(1)).alias("n")))


def segment(label: str, cost: dict[str, float], base: float, letter: float) -> list[str]:
    """The cheapest split of ``label``; on ties the one with the longer last word. Words that are not in ``cost`` cost
    ``base`` and ``letter`` for each letter, and more than any that is."""
    best, back = [0.0] * (len(label) + 1), [0] * (len(label) + 1)
    lengths = sorted({len(w) for w in cost}, reverse=True)
    start = 0  # where the cheapest unknown last word begins: its cost grows alike from every start
    for j in range(1, len(label) + 1):
        best[j], back[j] = best[start] + base + letter * (j - start), start
        for length in lengths:
            total = best[j - length] + cost.get(label[j - length:j], math.inf) if length <= j else math.inf
            if total < best[j] or total == best[j] and j - length < back[j]:
                best[j], back[j] = total, j - length
        if best[j] - letter * j < best[start] - letter * start:
            start = j
    out, j = [], len(label)
    while j:
        out.append(label[back[j]:j])
        j = back[j]
    return out[::-1]


def segmented(labels: DataFrame, counts: DataFrame) -> DataFrame:
    """(label, words) of the distinct labels. Each label meets the counts of its own substrings."""
    ship(labels.sparkSession)
    total = counts.agg(F.sum("n")).first()[0] or 1
    # Cut into chunks first and known by a hash, so that no row of a piece carries a whole long label.
    keyed = labels.withColumn("key", F.md5(F.col("label").cast("binary")))
    chunks = keyed.select("key", F.explode(F.transform(
        F.sequence(F.lit(0), F.floor((F.length("label") - 1) / F.lit(CHUNK)).cast("int")),
        lambda c: F.substr("label", c * F.lit(CHUNK) + 1, F.lit(CHUNK + SEED - 1)))).alias("chunk"))
    n = F.length("chunk")
    pieces = chunks.select("key", F.explode(F.array_distinct(F.flatten(F.transform(
        F.sequence(F.lit(1), n), lambda i: F.transform(
            F.sequence(F.lit(1), F.least(n - i + 1, F.lit(SEED))), lambda k: F.substr("chunk", i, k)))))).alias("piece"))
    words = counts.select("word", "n", F.substring("word", 1, SEED).alias("piece"))
    # Long words that only begin like a part of the label match nothing in it later.
    seen = pieces.join(words, "piece").groupBy("key").agg(F.collect_list(F.struct("word", "n")).alias("seen"))
    base, letter = math.log(total), math.log(10)  # 1 / (total * 10^length)

    def run(batches):
        for batch in batches:
            out = []
            for label, known in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                cost = {x["word"]: math.log(total / x["n"]) for x in known or ()}
                out.append(segment(label, cost, base, letter))
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(out, pa.list_(pa.string()))], names=["label", "words"])

    return keyed.join(seen, "key", "left").select("label", "seen").mapInArrow(run, "label string, words array<string>")


def host_words(hosts: DataFrame, counts: DataFrame) -> DataFrame:
    """(host, words): words of every distinct host, of its labels split at all but letters; those of
    a label that the host repeats as often."""
    parts = hosts.select("host").distinct().select("host", F.explode(F.array_remove(
        F.split("host", r"[^a-z]+", -1), "")).alias("label"))
    words = segmented(parts.select("label").distinct(), counts)
    return parts.join(words, "label").groupBy("host").agg(F.flatten(F.collect_list("words")).alias("words"))


def train(pages: DataFrame) -> list[float]:
    """Log odds for "block" of each bucket, the log odds of the classes last, from the rows (words,
    verdict) that rules decided; empty if one of the classes is. Counted over all rows."""
    decided = pages.where(F.col("verdict").isNotNull())
    docs = {r.verdict: r.n for r in decided.groupBy("verdict").agg(F.count(F.lit(1)).alias("n")).collect()}
    if len(docs) < 2:
        return []
    counts = (decided.select("verdict", F.explode("words").alias("w"))
              .groupBy(F.pmod(F.xxhash64("w"), F.lit(BUCKETS)).cast("int").alias("bucket"))
              .agg(F.sum((F.col("verdict") == "block").cast("long")).alias("block"),
                   F.sum((F.col("verdict") == "allow").cast("long")).alias("allow")).collect())  # BUCKETS rows at most
    block, allow, n = sum(r.block for r in counts), sum(r.allow for r in counts), len(counts)
    odds = [0.0] * BUCKETS  # a word never seen says nothing
    for r in counts:
        odds[r.bucket] = math.log((r.block + 1) / (block + n)) - math.log((r.allow + 1) / (allow + n))
    return [*odds, math.log(docs["block"] / docs["allow"])]


def judge(pages: DataFrame, id_col: str = "page_id", url_col: str = "url", html_col: str = "html",
          rules=RULES) -> DataFrame:
    """(page_id, host, path, rule, verdict, log_odds, words) of every row."""
    rows = pick(pages, page_id=id_col, url=url_col)
    host, path = url_parts(F.col("url"))
    rows = rows.select("page_id", host.alias("host"), path.alias("path"))
    counts = written(word_counts(pages, html_col))
    rule, verdict = rule_column(F.col("host"), F.col("path"), rules)
    path_words = F.array_remove(F.split(F.lower("path"), r"[^a-z]+", -1), "")
    named = F.array(*[F.lit(w) for w in rule_words(rules)]).cast("array<string>")
    split = (rows.join(written(host_words(rows, counts)), "host", "left")
             .select("page_id", "host", "path", rule.alias("rule"), verdict.alias("verdict"),
                     F.filter(F.concat(F.coalesce("words", F.array().cast("array<string>")), F.transform(
                         path_words, lambda w: F.concat(F.lit("/"), w))),
                              lambda w: ~F.array_contains(named, w)).alias("words")))
    model = train(split)
    if not model:
        odds = F.lit(0.0)
    else:
        # The model is a literal of fixed size.
        table = F.from_json(F.lit(str([round(x, 6) for x in model[:BUCKETS]])), "array<double>")
        odds = F.aggregate("words", F.lit(model[-1]), lambda a, w: a + F.get(
            table, F.pmod(F.xxhash64(w), F.lit(BUCKETS)).cast("int")))
        odds = F.when(F.size("words") > 0, odds).otherwise(0.0)
    method = F.when(F.col("log_odds") > 0, "block").otherwise("allow")
    return split.withColumn("log_odds", odds).withColumn("verdict", F.coalesce("verdict", method))
