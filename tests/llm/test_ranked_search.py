"""Ranked search against brute force, with small blocks, hot lengths and the awkward cases."""

import math
import random
import re
from collections import Counter

import pytest

from kiln.llm import ranked_search

TERM = re.compile(r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+")
LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
SCHEMA = "doc_id long, text string, score long, m long, item string, rank string"


def terms(text):
    return TERM.findall((text or "").translate(LOWER))


def brute(docs, items, k):
    counts = [(i, Counter(terms(t))) for i, t in docs]
    counts = [(i, c, c.total()) for i, c in counts if c]
    n_docs, n_terms = len(counts), sum(n for _, _, n in counts)
    df = Counter(t for _, c, _ in counts for t in c)
    out = []
    for item, text in items:
        want = set(terms(text))
        scores = []
        for i, c, n in counts:
            m = 50 + (50 * n * n_docs) // n_terms
            s = sum(math.floor(1000 * math.log((2 * n_docs + 2) / (2 * df[t] + 1)))
                    * ((1000000000 * c[t]) // (1000 * c[t] + 20 * m)) for t in want if c[t])
            if s > 0:
                scores.append((-s, i is not None, i))
        out += [(item, rank, i, -s) for rank, (s, _, i) in enumerate(sorted(scores)[:k], 1)]
    return sorted(out, key=repr)


def got(spark, docs, items, k):
    df = spark.createDataFrame([(i, t, 1, 2, "x", "y") for i, t in docs], SCHEMA)
    asked = spark.createDataFrame([(i, t, 5) for i, t in items], "item_id long, text string, doc_id int")
    out = ranked_search.search(df, asked, k)
    assert out.columns == ["item_id", "rank", "doc_id", "score"]
    return sorted((tuple(r) for r in out.collect()), key=repr)


@pytest.fixture(scope="module")
def corpus():
    rng = random.Random(8)
    vocabulary = [f"w{int(rng.expovariate(0.05))}" for _ in range(400)] + ["Ünï", "日本", "A-b", "x.y"]
    docs = [(k, " ".join(rng.choices(vocabulary, k=rng.choice([1, 3, 20, 20, 20, 20, 90])))) for k in range(600)]
    docs += [(700 + k, docs[5][1]) for k in range(40)]  # ties
    docs += [(None, docs[5][1]), (5, docs[6][1]), (900, None), (901, ""), (902, " .,- \n"), (903, "w1 " * 30_000 + "w2")]
    items = [(k, " ".join(rng.choices(vocabulary, k=rng.choice([1, 5, 12])))) for k in range(25)]
    items += [(50, docs[5][1]), (51, None), (52, "--"), (53, "nowhere"), (3, "W1 w1 日本")]
    return docs, items


@pytest.mark.parametrize("block, terms_at_once", [(4096, 200_000), (7, 200_000), (50, 20)])
def test_search_equals_brute_force(spark, corpus, monkeypatch, block, terms_at_once):
    monkeypatch.setattr(ranked_search, "BLOCK_DOCS", block)
    monkeypatch.setattr(ranked_search, "TERMS", terms_at_once)
    assert got(spark, *corpus, 10) == brute(*corpus, 10)


def test_all_documents_if_fewer(spark, corpus):
    docs, items = corpus
    assert got(spark, docs[:30], items, 50) == brute(docs[:30], items, 50)


def test_empty_tables(spark, corpus):
    docs, items = corpus
    assert got(spark, [], items, 5) == [] and got(spark, docs, [], 5) == []
    assert got(spark, [(1, None), (2, "")], items, 5) == [] and got(spark, docs, [(1, None)], 5) == []


def test_bounds_hold_and_leave_blocks_out(spark, corpus, monkeypatch):
    """No document scores above its block's bound; some blocks are below the floor of an item."""
    docs, items = corpus
    monkeypatch.setattr(ranked_search, "BLOCK_DOCS", 5)
    rows = ranked_search.item_terms(spark.createDataFrame(items, "item_id long, text string")).collect()
    query = ranked_search.Query(rows)
    query.weights[:] = 1000
    named = spark.sparkContext.broadcast(query)
    table = ranked_search.counted(spark.createDataFrame(docs, "doc_id long, text string"), named)
    n_docs, n_terms = table.count(), table.agg({"n": "sum"}).first()[0]
    left_out = 0
    blocks = ranked_search.stratified(table, n_docs, n_terms).collect()
    assert max(len(b.doc_ids) for b in blocks) < 25
    for b in blocks:
        block = ranked_search.Block(b.m, b.terms, b.tfs, b.first, len(query.number))
        bounds = query.bounds(block.best)
        members = ranked_search.np.frombuffer(b.members, "<u4")
        for i in range(len(rows)):
            of = query.term[query.first[i]:query.first[i + 1]]
            top = block.scores(members, len(b.doc_ids), of, query.weights[of]).max()
            assert top <= bounds[i]
            left_out += bounds[i] < 2 * 10 ** 6
    assert left_out
