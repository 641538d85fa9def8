"""Quality rules as weak supervision, with DataFrame functions only.

Each rule reads figures of one text and votes "good" or "junk", or abstains. How far a
vote is to be trusted is not set by hand: expectation-maximisation estimates, from the
agreements between rules over all documents, how often each rule votes on good and on junk
documents, and from these the probability that a document is good. (While the rates are
estimated, abstaining where others vote counts too; a verdict rests on votes alone, an
abstention is no evidence.) The EM runs on the histogram of vote patterns, of which there are 2^rules at most
whatever the number of documents; the documents themselves never leave the executors.

Bounds that keep the estimate sane on any table: a rule's vote never counts against its own
direction, and the prior share of good documents is 0.5 or more, so that a text on which
every rule abstains is kept.

Null text is read as empty (no words: ``base_failed``). Repeated rows count as often as they
occur; ties cannot arise, as each row is judged by itself. Other columns are not read. On an
empty table the starting values of the EM hold and the result is empty.
"""

from __future__ import annotations

import math
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from kiln.llm.common import WHITE, WHITE_RUN, pick, written

#: Base rules, fixed by the contract of the query.
MIN_WORDS = 50
MAX_REPEAT_PERCENT = 50

FIGURES = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "n_lines", "n_upper",
           "n_shouts", "n_stops")


def _bind(value: Column, body) -> Column:
    """``body(value)`` with ``value`` computed once per row, however often ``body`` uses it."""
    return F.element_at(F.transform(F.array(value), body), 1)


def _count(text: Column, characters: str) -> Column:
    """Number of characters of ``text`` that are among ``characters``."""
    return (F.length(text) - F.length(F.translate(text, characters, ""))).cast("long")


def _repeat_words(words: Column) -> Column:
    """Words in 3-word windows that occur twice or more, the first occurrence included.

    The windows, each with its place, are sorted by hash and text; equal ones are then
    neighbours. The places they cover are counted once."""
    def windows(w):
        return F.transform(F.sequence(F.lit(1), F.size(w) - 2), lambda i: F.struct(
            F.xxhash64(F.element_at(w, i), F.element_at(w, i + 1), F.element_at(w, i + 2)).alias("h"),
            F.concat_ws(" ", F.element_at(w, i), F.element_at(w, i + 1), F.element_at(w, i + 2)).alias("t"),
            i.alias("i")))

    def covered(s):
        n = F.size(s)

        def same(a, b):
            return (a["h"] == b["h"]) & (a["t"] == b["t"])

        twice = F.filter(s, lambda x, k: ((k > 0) & same(x, F.get(s, k - 1))) | ((k < n - 1) & same(x, F.get(s, k + 1))))
        places = F.transform(twice, lambda x: F.array(x["i"], x["i"] + 1, x["i"] + 2))
        return F.size(F.array_distinct(F.flatten(places)))

    return F.when(F.size(words) >= 4, _bind(F.sort_array(windows(words)), covered)).otherwise(0).cast("long")


def figures(docs: DataFrame, text_col: str = "text", keep: tuple[str, ...] = ("doc_id",)) -> DataFrame:
    """The ``keep`` columns of every row and the FIGURES of its whole text."""
    text = F.coalesce(F.col(text_col), F.lit(""))
    words = F.array_remove(F.split(text, WHITE_RUN, -1), "")
    full = F.filter(F.split(text, "\n", -1), lambda x: F.length(F.translate(x, WHITE, "")) > 0)
    of_words = _bind(words, lambda w: F.struct(F.size(w).cast("long").alias("n_words"),
                                               _repeat_words(w).alias("n_repeat_words")))
    of_lines = _bind(full, lambda x: F.struct(
        F.size(x).cast("long").alias("n_lines"),
        (F.size(x) - F.size(F.array_distinct(x))).cast("long").alias("n_dup_lines")))
    return (docs.select(*keep, of_words.alias("_w"), of_lines.alias("_l"),
                        F.length(F.translate(text, WHITE, "")).cast("long").alias("word_chars"),
                        _count(text, "#*$%&|<>").alias("n_symbols"),
                        F.length(F.regexp_replace(text, r"\P{Lu}+", "")).cast("long").alias("n_upper"),
                        _count(text, "!").alias("n_shouts"), _count(text, ".,").alias("n_stops"))
            .select(*keep, "_w.n_words", "word_chars", "n_symbols", "_l.n_dup_lines", "_w.n_repeat_words",
                    "_l.n_lines", "n_upper", "n_shouts", "n_stops"))


@dataclass(frozen=True)
class Rule:
    """A rule that votes ``good`` (else junk) where ``fires`` holds, and abstains elsewhere."""
    name: str
    good: bool
    fires: Column


def default_rules() -> list[Rule]:
    """Rules over FIGURES. Shares are of words, but for upper-case letters (of characters)."""
    n, chars = F.col("n_words"), F.col("word_chars")
    return [
        Rule("symbols", False, F.col("n_symbols") * 100 > 25 * n),
        Rule("shouts", False, F.col("n_shouts") * 100 > 25 * n),
        Rule("capitals", False, F.col("n_upper") * 100 > 40 * chars),
        Rule("repeats", False, F.col("n_repeat_words") * 100 > 30 * n),
        Rule("lines_again", False, (F.col("n_lines") >= 4) & (F.col("n_dup_lines") * 100 > 50 * F.col("n_lines"))),
        Rule("odd_words", False, (n > 0) & ((chars < 2 * n) | (chars > 15 * n))),
        Rule("no_stops", False, (n >= 20) & (F.col("n_stops") * 100 < n)),
        Rule("prose", True, (F.col("n_stops") * 100 >= 3 * n) & (F.col("n_upper") * 100 <= 15 * chars)
             & (F.col("n_symbols") * 100 <= 10 * n) & (F.col("n_shouts") * 100 <= 10 * n)),
        Rule("varied", True, (F.col("n_repeat_words") * 100 <= 10 * n) & (F.col("n_symbols") * 100 <= 10 * n)
             & (F.col("n_upper") * 100 <= 15 * chars)),
    ]


@dataclass(frozen=True)
class VoteModel:
    """prior: share of good documents. weights: log(P(vote | good) / P(vote | junk)) by rule.
    accuracies: share of a rule's votes that are right."""
    prior: float
    weights: tuple[float, ...]
    accuracies: tuple[float, ...]


def fit_votes(patterns: list[tuple[tuple[bool, ...], int]], good: list[bool], rounds: int = 50) -> VoteModel:
    """EM over (pattern of votes, number of documents)."""
    k, total = len(good), sum(c for _, c in patterns) or 1
    silence = [0.0] * k  # log(P(abstains | good) / P(abstains | junk))
    # Start: a junk vote speaks for junk, whoever casts it.
    p_good = [0.1 if any(v and not g for v, g in zip(p, good)) else 0.9 for p, _ in patterns]
    prior, weights, accuracies = 0.8, [math.log(5) * (1 if g else -1) for g in good], [0.8] * k
    for _ in range(rounds if patterns else 0):
        n_good = sum(c * q for (_, c), q in zip(patterns, p_good))
        n_junk = total - n_good
        prior = min(0.99, max(0.5, n_good / total))
        for j in range(k):
            on_good = sum(c * q for (p, c), q in zip(patterns, p_good) if p[j])
            on_junk = sum(c * (1 - q) for (p, c), q in zip(patterns, p_good) if p[j])
            rate_good, rate_junk = (on_good + 0.1) / (n_good + 1), (on_junk + 0.1) / (n_junk + 1)
            ratio = math.log(rate_good / rate_junk)
            silence[j] = math.log((1 - min(rate_good, 0.99)) / (1 - min(rate_junk, 0.99)))
            weights[j] = min(6.0, max(0.0, ratio)) if good[j] else max(-6.0, min(0.0, ratio))
            right = on_good if good[j] else on_junk
            accuracies[j] = (right + 0.5) / (on_good + on_junk + 1)
        logit = math.log(prior / (1 - prior))
        p_good = [1 / (1 + math.exp(-(logit + sum(w if v else u for w, u, v in zip(weights, silence, p)))))
                  for p, _ in patterns]
    return VoteModel(prior, tuple(weights), tuple(accuracies))


def vote_patterns(rows: DataFrame, rules: list[Rule]) -> list[tuple[tuple[bool, ...], int]]:
    """Number of documents of each pattern of votes; 2^len(rules) rows at most reach the driver."""
    code = sum(F.when(r.fires, F.lit(1 << j)).otherwise(F.lit(0)) for j, r in enumerate(rules))
    counts = rows.groupBy(code.alias("code")).agg(F.count(F.lit(1)).alias("n")).orderBy("code").collect()
    return [(tuple(bool(x.code >> j & 1) for j in range(len(rules))), x.n) for x in counts]


def judged(rows: DataFrame, rules: list[Rule], model: VoteModel, least: float = 0.5) -> DataFrame:
    """``rows`` with p_good, base_failed and kept (base passed and p_good of ``least`` or more)."""
    logit = F.lit(math.log(model.prior / (1 - model.prior)))
    for r, w in zip(rules, model.weights):
        logit = logit + F.when(r.fires, F.lit(w)).otherwise(F.lit(0.0))
    failed = (F.col("n_words") < MIN_WORDS) | (F.col("n_repeat_words") * 100 > MAX_REPEAT_PERCENT * F.col("n_words"))
    return (rows.withColumn("p_good", 1 / (1 + F.exp(-logit))).withColumn("base_failed", failed)
            .withColumn("kept", ~F.col("base_failed") & (F.col("p_good") >= F.lit(least))))


def quality(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(doc_id, FIGURES, p_good, base_failed, kept) of every row. One pass over the texts: the
    figures, a few numbers a row, are written to the scratch folder, counted and judged there."""
    rules = default_rules()
    rows = written(figures(pick(docs, doc_id=id_col, text=text_col)))
    model = fit_votes(vote_patterns(rows, rules), [r.good for r in rules])
    return judged(rows, rules, model)


def keep_good(docs: DataFrame, text_col: str = "text") -> DataFrame:
    """The rows of ``docs`` that are kept, all their columns as they were. Rows and figures are
    written to the scratch folder, counted and judged there: the texts are measured once and
    not shuffled."""
    rules = default_rules()
    whole = docs.select(F.struct(*docs.columns).alias("_row"), F.col(text_col).alias("_text"))
    rows = written(figures(whole, "_text", keep=("_row",)))
    model = fit_votes(vote_patterns(rows, rules), [r.good for r in rules])
    return judged(rows, rules, model).where("kept").select("_row.*")
