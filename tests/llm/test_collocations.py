"""Collocations against brute force: small groups, extended prefixes, colliding hashes, awkward cases."""

import random
import re
from collections import Counter

import numpy as np
import pytest

from kiln.llm import collocations

LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
SCHEMA = "doc_id long, text string, lang string, w1 string, f long, h long, phrase string"


def expected(rows, least, limit, cover=80):
    f, n = Counter(), Counter()
    for text, lang in rows:
        lang = "und" if lang is None else lang
        for piece in re.split(r"[.,;:!?\x0A-\x0D]", (text or "").translate(LOWER)):
            words = re.findall(r"[^\x20\x09]+", piece)
            n[lang] += len(words)
            for i in range(len(words)):
                for k in range(1, min(4, len(words) - i) + 1):
                    f[lang, tuple(words[i:i + k])] += 1
    often = {key: a for key, a in f.items() if len(key[1]) > 1 and a >= least}
    longest = Counter()  # phrase -> the largest count of a longer one around it
    for (lang, p), a in often.items():
        for k in range(2, len(p)):
            for i in range(len(p) - k + 1):
                longest[lang, p[i:i + k]] = max(longest[lang, p[i:i + k]], a)
    found = {}
    for (lang, p), a in often.items():
        if 100 * longest[lang, p] < cover * a:
            score, k = min(((2000000 * a) // (f[lang, p[:k]] + f[lang, p[k:]]), k) for k in range(1, len(p)))
            found.setdefault(lang, []).append((-score, -a, " ".join(p).encode(), f[lang, p[:k]], f[lang, p[k:]]))
    return sorted((lang, rank, p.decode(), -a, left, right, n[lang], -score) for lang, of in found.items()
                  for rank, (score, a, p, left, right) in enumerate(sorted(of)[:limit], 1))


def got(spark, rows, least, limit, **more):
    df = spark.createDataFrame([(k, t, g, "x", 1, 2, "y") for k, (t, g) in enumerate(rows)], SCHEMA)
    out = collocations.collocations(df, least=least, limit=limit, **more)
    assert out.columns == ["lang", "rank", "phrase", "a", "l", "r", "n", "score"]
    return sorted(tuple(r) for r in out.collect())


@pytest.fixture(scope="module")
def rows():
    rng = random.Random(2)
    words = [f"w{int(rng.expovariate(0.15))}" for _ in range(300)] + ["Été", "日本", "a b", "it's"]
    out = []
    for k in range(250):
        text = " ".join(rng.choice(words) + rng.choice(["", "", "", "", ".", ",", "\n", "\t", "  ", " ?"]) for _ in range(rng.randint(0, 60)))
        out.append((text, rng.choice(["en", "en", "en", "de", None, "und"])))
    out += [("the very same passage of eight words here", "en")] * 40  # copies: phrases inside longer ones
    out += [("on and on and on and on", "en")] * 20 + [(None, "en"), ("", None), (" . ,", "xx"), ("a a a a a a " * 4000, "de")]
    return out


@pytest.mark.parametrize("least, limit, budget", [(5, 2000, 500_000), (3, 25, 50), (30, 2000, 3)])
def test_collocations_equal_brute_force(spark, rows, least, limit, budget):
    """A budget of few suffixes extends the prefixes to two and three words."""
    want = expected(rows, least, limit)
    assert len(want) > 20 and got(spark, rows, least, limit, budget=budget) == want


def test_words_with_one_hash_change_the_seed(spark, rows, monkeypatch):
    """Under the first seed all words have one hash; the next tells them apart."""
    few = [("a b c a b c d a b", "en")] * 6 + [("a b x", "de")] * 6
    seen = []
    monkeypatch.setattr(collocations, "word_counts", lambda texts, seed, run=collocations.word_counts: (
        seen.append(seed), run(texts, seed) if seed else run(texts, 0).withColumn("h", collocations.F.lit(7).cast("long")))[1])
    assert got(spark, few, 3, 100) == expected(few, 3, 100) and seen == [0, 1]


def test_empty_tables(spark):
    assert got(spark, [], 1, 10) == [] and got(spark, [(None, None), ("", "en"), ("one", "en")], 1, 10) == []


def test_large_counts_are_exact(spark):
    """2000000 * a passes 64 bits."""
    big = 6 * 10 ** 12 + 1
    zero = (0, 0)
    counts = spark.createDataFrame([("en", 1, 0, *zero, 3 * big), ("en", 2, 0, *zero, 2 * big), ("en", 1, 2, *zero, big)],
                                   "lang string, w1 long, w2 long, w3 long, w4 long, f long")
    (row,) = collocations.scored(counts, 30, 80).collect()
    assert (row.a, row.l, row.r, row.score) == (big, 3 * big, 2 * big, 2000000 * big // (5 * big))


def test_leaf_totals_give_the_counts():
    leaves = np.array([[0, 1, 2, 0, 0], [0, 1, 2, 3, 0], [0, 1, 2, 3, 4], [1, 1, 2, 3, 4]], np.uint64)
    rows, counts = collocations.subtree(leaves, np.array([5, 2, 4, 9]), 4)
    assert dict(zip(map(tuple, rows.tolist()), counts.tolist())) == {
        (0, 1, 2, 0, 0): 11, (1, 1, 2, 0, 0): 9, (0, 1, 2, 3, 0): 6, (1, 1, 2, 3, 0): 9, (0, 1, 2, 3, 4): 4, (1, 1, 2, 3, 4): 9}
