"""Phrase collocations by vertically partitioned, depth-truncated suffix trees.

Words of a piece of text (a run between sentence marks) are read as the suffixes that begin at
each of them, cut after DEPTH words; everything is per language. A phrase of k words occurs as often
as suffixes have it as their prefix, so its count is the sum of the leaves below its node in the
tree of the suffixes. The trees are built in parts:

1. Words are counted, which gives n and the counts of phrases of one word. Words are from now on
   their 64-bit hashes. That no two words of a language have one hash is checked on all of them; if
   two had, the next seed is taken.
2. Only suffixes are kept whose words occur LEAST times or more and stand in pairs of words that do:
   all others lie below nodes that are counted out. Both tests are bitmaps of a size set by the
   count of what they hold, BITS at most; a word or pair they let through by mistake costs work,
   not correctness.
3. Vertical partitioning: prefixes are grouped so that a group has about ``budget`` suffixes. A prefix of
   one word goes whole to a group drawn by its hash; a word with more suffixes than the budget is
   extended, its pairs are spread; a pair above the budget is extended again, to three words. At most
   HEAVY words and pairs can be above the budget, which grows with the corpus for that.
   Equal suffixes are added up in each task before they move.
4. Every group builds its subtree by itself: its suffixes are sorted, equal ones become a leaf, and
   the nodes' counts are read off the leaf totals. Where a pair was extended, its node's parts are
   added up over the groups.
5. Scores: l and r of every cut are counts of other nodes, looked up by joins; phrases inside a
   longer one of four fifths of their count are dropped; the best LIMIT of a language are
   taken by score and count first, so that words are spelled out for these and their ties only.

Null and empty texts have no words; a null language is ``und``. Repeated rows and ids count each time
(ids are not read). A very long text is counted whole, in parts of one batch. Ties are ordered by
count, then by the phrase. An empty table gives no rows. Other columns are not read.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from kiln.llm.common import combine, mix, pick, ranges, ship, written
from kiln.llm.word_ids import text_bytes, words_between

#: Longest phrase, least count of a candidate, share of a longer phrase that covers a shorter one, rows of a language.
DEPTH, LEAST, COVER, LIMIT = 4, 30, 80, 2000
#: Suffixes of a group (the memory budget of a subtree), and the most words or pairs above it.
BUDGET, HEAVY = 500_000, 200_000
#: Bits of a bitmap, at most, and for each value that it holds.
BITS, PER_VALUE = 1 << 26, 16
#: Bytes of text taken at once, and ranks kept for each salt of a language.
SLICE, SALTS = 4 << 20, 64

_LOWER = np.array([b + 32 if 65 <= b <= 90 else b for b in range(256)], np.uint8)
_MARK = np.zeros(256, bool)
_MARK[[ord(c) for c in ".,;:!?\n\x0b\x0c\r"]] = True
_WORD = ~_MARK
_WORD[[0x20, 0x09]] = False


def _words(texts: pa.Array):
    """(words, text of each, whether the next word follows in the same piece)."""
    data, bounds = text_bytes(texts)
    data = _LOWER[data]
    words, start, text = words_between(data, bounds, _WORD)
    piece = np.cumsum(_MARK[data])[start] if len(start) else start
    follows = np.zeros(len(start), bool)
    follows[:-1] = (piece[1:] == piece[:-1]) & (text[1:] == text[:-1])
    return words, text, follows


def _hash(words: pa.Array, seed: int) -> np.ndarray:
    """64-bit hashes of the words, distinct ones computed once; never 0, which stands for no word."""
    coded = words.dictionary_encode()
    if not len(words):
        return np.zeros(0, np.uint64)
    own = pd.util.hash_array(np.array(coded.dictionary.to_pylist(), dtype=object), categorize=False)
    own = mix(own + mix(np.full(1, seed, np.uint64)))
    return np.maximum(own, np.uint64(1))[coded.indices.to_numpy()]


def _slices(batches):
    """(texts, languages) of a batch, about SLICE bytes at a time; a language is its number in ``names``."""
    for batch in batches:
        for lo, hi in ranges(np.diff(text_bytes(batch.column(0))[1]), SLICE):
            lang = batch.column(1).slice(lo, hi - lo).dictionary_encode()
            yield batch.column(0).slice(lo, hi - lo), lang.indices.to_numpy().astype(np.int64), lang.dictionary


def word_counts(texts: DataFrame, seed: int) -> DataFrame:
    """(lang, word, h, key, f): every word of a language, its hash, that of both, and its count."""
    def run(batches):
        for text, lang, names in _slices(batches):
            words, of, _ = _words(text)
            if not len(words):
                continue
            coded = words.dictionary_encode()
            size = len(coded.dictionary)
            count = np.bincount(lang[of] * size + coded.indices.to_numpy(), minlength=size * len(names))
            seen = np.flatnonzero(count)
            word = coded.dictionary.take(pa.array(seen % size))
            h = _hash(word, seed)
            key = _word_key(_lang_hash(names)[seen // size], h)
            yield pa.RecordBatch.from_arrays(
                [names.take(pa.array(seen // size)).cast(pa.string()), word.cast(pa.string()),
                 pa.array(h.view(np.int64)), pa.array(key.view(np.int64)), pa.array(count[seen], pa.int64())],
                names=["lang", "word", "h", "key", "f"])

    return (texts.mapInArrow(run, "lang string, word string, h long, key long, f long")
            .groupBy("lang", "word", "h", "key").agg(F.sum("f").alias("f")))


def _heavy(counts: DataFrame, budget: int) -> np.ndarray:
    """The hashes of more than ``budget`` suffixes; HEAVY of them at most."""
    rows = counts.where(F.col("f") > budget).select("h").toArrow()
    return rows.column(0).to_numpy().view(np.uint64)


def _bits(n: int) -> int:
    bits = 1 << 12
    while bits < min(BITS, PER_VALUE * n):
        bits <<= 1
    return bits


def bitmap(hashes: DataFrame, n: int) -> np.ndarray:
    """The lowest bits of ``h`` (n values) as a bitmap of 64-bit words: BITS / 64 of them reach the driver at most."""
    bits = _bits(n)
    words = (hashes.select(F.expr(f"cast(h & {bits - 1} as int)").alias("bit"))
             .groupBy(F.expr("bit div 64").cast("int").alias("at")).agg(F.expr("bit_or(shiftleft(1L, bit % 64))").alias("bits")))
    out = np.zeros(bits // 64, np.uint64)
    for batch in words.toArrow().to_batches():
        out[batch.column(0).to_numpy()] = batch.column(1).to_numpy().view(np.uint64)
    return out


def marked(bits: np.ndarray, h: np.ndarray) -> np.ndarray:
    at = h & np.uint64(len(bits) * 64 - 1)
    return (bits[(at >> np.uint64(6)).astype(np.int64)] >> (at & np.uint64(63))) & np.uint64(1) > 0


def _lang_hash(names: pa.Array) -> np.ndarray:
    return mix(pd.util.hash_array(np.array(names.to_pylist(), dtype=object), categorize=False))


def _sums(keys: np.ndarray, n: np.ndarray | None = None) -> tuple[np.ndarray, np.ndarray]:
    """(rows, totals) of the distinct rows of ``keys`` (rows x columns), sorted, and the sums of n (or counts)."""
    order = np.lexsort(keys.T[::-1])
    keys = keys[order]
    first = np.flatnonzero(np.concatenate([[True], (keys[1:] != keys[:-1]).any(axis=1)])[:len(keys)])
    if n is None:
        return keys[first], np.diff(np.append(first, len(keys)))
    return keys[first], np.add.reduceat(n[order], first) if len(first) else n[:0]


class _Reader:
    """What the tasks of passes 2 and 3 know: seed and bitmap of the words, as one broadcast."""

    def __init__(self, seed: int, words: np.ndarray):
        self.seed, self.words, self.pairs, self.groups = seed, words, None, 1
        self.heavy = self.heavy_pairs = np.zeros(0, np.uint64)

    def read(self, text: pa.Array, lang: np.ndarray, names: pa.Array):
        """(hash, language, hash of the pair with the next word or 0) of every word."""
        words, of, follows = _words(text)
        h = _hash(words, self.seed)
        lang = lang[of]
        salt = _lang_hash(names)[lang] if len(names) else h
        good = marked(self.words, _word_key(salt, h)) if len(h) else np.zeros(0, bool)
        pair = np.zeros(len(h), np.uint64)
        ok = np.flatnonzero(follows[:-1] & good[:-1] & good[1:])
        pair[ok] = _pair_key(salt[ok], h[ok], h[ok + 1])
        return h, lang, salt, pair


def _word_key(lang: np.ndarray, h: np.ndarray) -> np.ndarray:
    return mix(h ^ lang)


def _pair_key(lang: np.ndarray, h: np.ndarray, after: np.ndarray) -> np.ndarray:
    """Hash of a language and two words, never 0."""
    return np.maximum(combine(h ^ lang, after), np.uint64(1))


def pair_counts(texts: DataFrame, reader) -> DataFrame:
    """(h, f): hashes of a language and two neighbouring frequent words, with their count."""
    def run(batches):
        r = reader.value
        for text, lang, names in _slices(batches):
            pair = r.read(text, lang, names)[3]
            pair, n = np.unique(pair[pair > 0], return_counts=True)
            yield pa.RecordBatch.from_arrays([pa.array(pair.view(np.int64)), pa.array(n, pa.int64())], names=["h", "f"])

    return texts.mapInArrow(run, "h long, f long").groupBy("h").agg(F.sum("f").alias("f"))


def suffixes(texts: DataFrame, reader) -> DataFrame:
    """(grp, lang, w1 .. w4, f): the kept suffixes of two words or more, equal ones of a slice added up,
    and the group of their prefix. A place beyond the suffix's end has no word, 0."""
    def run(batches):
        r = reader.value
        for text, lang, names in _slices(batches):
            h, lang, salt, pair = r.read(text, lang, names)
            good = (pair > 0) & marked(r.pairs, pair) if len(h) else np.zeros(0, bool)
            at = np.flatnonzero(good)
            keys = np.zeros((len(at), DEPTH + 1), np.uint64)
            keys[:, 0], keys[:, 1] = lang[at].astype(np.uint64), h[at]
            alive = np.ones(len(at), bool)
            for k in range(1, DEPTH):  # word k + 1 follows if the pair before it was kept
                alive = alive & good[np.minimum(at + k - 1, len(good) - 1)]
                keys[alive, k + 1] = h[at[alive] + k]
            keys, n = _sums(keys)
            own = _lang_hash(names)[keys[:, 0].astype(np.int64)] if len(names) else keys[:, 0]
            pairs = _pair_key(own, keys[:, 1], keys[:, 2])
            prefix = _word_key(own, keys[:, 1])
            heavy = np.isin(prefix, r.heavy)
            prefix[heavy] = pairs[heavy]
            heavy &= np.isin(pairs, r.heavy_pairs)
            prefix[heavy] = combine(pairs[heavy], keys[heavy, 3])
            group = (mix(prefix) % np.uint64(r.groups)).astype(np.int64)
            yield pa.RecordBatch.from_arrays(
                [pa.array(group), names.take(pa.array(keys[:, 0].astype(np.int64))).cast(pa.string()),
                 *[pa.array(keys[:, k].view(np.int64)) for k in range(1, DEPTH + 1)], pa.array(n, pa.int64())],
                names=["grp", "lang", *WORDS, "f"])

    return texts.mapInArrow(run, f"grp long, lang string, {_COLUMNS}, f long")


WORDS = [f"w{k}" for k in range(1, DEPTH + 1)]
_COLUMNS = ", ".join(f"{w} long" for w in WORDS)


def subtree(leaves: np.ndarray, totals: np.ndarray, least: int, parts: np.ndarray | None = None):
    """Nodes of two words and more of the tree over the distinct, sorted suffixes ``leaves`` (language, words):
    (rows, counts), read off the leaf totals. Nodes below ``least`` are left out, but for pairs that
    ``parts`` marks (by leaf), whose other leaves are elsewhere."""
    below = np.concatenate([[0], np.cumsum(totals)])
    out, counts = [], []
    new = np.zeros(len(leaves), bool)
    new[:1] = True
    new[1:] = (leaves[1:, :2] != leaves[:-1, :2]).any(axis=1)
    for depth in range(2, DEPTH + 1):
        new[1:] |= leaves[1:, depth] != leaves[:-1, depth]  # a node begins where a word down to it changes
        first = np.flatnonzero(new)
        count = below[np.append(first[1:], len(leaves))] - below[first]
        held = leaves[first, depth] != 0
        keep = held & (count >= least)
        if depth == 2 and parts is not None:
            keep |= held & parts[first]
        rows = np.zeros((int(keep.sum()), DEPTH + 1), np.uint64)
        rows[:, :depth + 1] = leaves[first[keep], :depth + 1]
        out.append(rows)
        counts.append(count[keep])
    return np.concatenate(out), np.concatenate(counts)


def phrase_counts(grouped: DataFrame, reader, least: int) -> DataFrame:
    """(lang, w1 .. w4, f): all phrases of two words and more that occur ``least`` times."""
    def run(batches):
        heavy = reader.value.heavy_pairs
        now, held = None, []

        def nodes():
            table = pa.Table.from_batches(held).combine_chunks()
            lang = pa.concat_arrays(table.column("lang").chunks).dictionary_encode()
            keys = np.stack([lang.indices.to_numpy().astype(np.uint64),
                             *[table.column(w).to_numpy().view(np.uint64) for w in WORDS]], axis=1)
            leaves, totals = _sums(keys, table.column("f").to_numpy())  # equal suffixes become a leaf
            parts = None
            if len(heavy):
                own = _lang_hash(lang.dictionary)[leaves[:, 0].astype(np.int64)]
                parts = np.isin(_pair_key(own, leaves[:, 1], leaves[:, 2]), heavy)
            rows, counts = subtree(leaves, totals, least, parts)
            return pa.RecordBatch.from_arrays(
                [lang.dictionary.take(pa.array(rows[:, 0].astype(np.int64))).cast(pa.string()),
                 *[pa.array(rows[:, k].view(np.int64)) for k in range(1, DEPTH + 1)], pa.array(counts, pa.int64())],
                names=["lang", *WORDS, "f"])

        for batch in batches:
            group = batch.column(0).to_numpy()
            cuts = [0, *(np.flatnonzero(group[1:] != group[:-1]) + 1).tolist(), len(group)]
            for lo, hi in zip(cuts[:-1], cuts[1:]):
                if lo < hi:
                    if held and group[lo] != now:
                        yield nodes()
                        held = []
                    now = group[lo]
                    held.append(batch.slice(lo, hi - lo))
        if held:
            yield nodes()

    found = grouped.mapInArrow(run, f"lang string, {_COLUMNS}, f long")
    # Only nodes of extended pairs come from several groups.
    return found.groupBy("lang", *WORDS).agg(F.sum("f").alias("f")).where(F.col("f") >= least)


def _decimal(c):
    return c.cast("decimal(19,0)")


def scored(counts: DataFrame, least: int, cover: int) -> DataFrame:
    """(lang, w1 .. w4, a, l, r, score) of the candidates that no longer phrase covers. ``counts``: all phrases of
    one word and more that occur ``least`` times."""
    w, none = [F.col(x) for x in WORDS], F.lit(0).cast("long")
    nodes = counts.withColumn("size", sum((F.when(x != 0, 1).otherwise(0) for x in w[1:]), F.lit(1)))

    def part(since, upto, **more):
        """The phrase of the words since .. upto (those beyond the end are 0) and some values."""
        words = [w[since + k] if since + k < upto else none for k in range(DEPTH)]
        return F.struct(*[x.alias(n) for x, n in zip(words, WORDS)], *[F.lit(v).alias(k) for k, v in more.items()])

    sides = F.array(*[part(*span, cut=cut, side=side) for cut in range(1, DEPTH)
                      for side, span in (("l", (0, cut)), ("r", (cut, DEPTH)))])
    parts = (nodes.where("size > 1")
             .select("lang", *[x.alias(f"c{i}") for i, x in enumerate(w)], F.col("f").alias("a"),
                     F.explode(F.filter(sides, lambda x: x["cut"] < F.col("size"))).alias("x"))
             .select("lang", *[f"c{i}" for i in range(DEPTH)], "a", "x.*"))
    found = parts.join(counts, ["lang", *WORDS])
    candidate = ["lang", *[f"c{i}" for i in range(DEPTH)]]
    side = lambda s: F.max(F.when(F.col("side") == s, F.col("f"))).alias(s)
    cuts = found.groupBy(*candidate, "cut").agg(F.max("a").alias("a"), side("l"), side("r"))
    cuts = cuts.withColumn("score", F.expr(f"(cast(a as decimal(19,0)) * cast(2000000 as decimal(7,0))) div "
                                           f"(cast(l as decimal(19,0)) + cast(r as decimal(19,0)))"))
    lowest = F.min_by(F.struct("l", "r"), F.struct("score", "cut"))
    best = (cuts.groupBy(*candidate).agg(F.max("a").alias("a"), F.min("score").alias("score"), lowest.alias("at"))
            .select("lang", *[F.col(f"c{i}").alias(x) for i, x in enumerate(WORDS)], "a", "at.l", "at.r", "score"))
    inside = F.array(*[part(at, at + n, n=n, last=at + n) for n in range(2, DEPTH) for at in range(DEPTH - n + 1)])
    covers = (nodes.where("size > 2")
              .select("lang", F.col("f").alias("longer"), F.explode(F.filter(
                  inside, lambda x: (x["n"] < F.col("size")) & (x["last"] <= F.col("size")))).alias("x"))
              .groupBy("lang", *[F.col(f"x.{x}").alias(x) for x in WORDS]).agg(F.max("longer").alias("longer")))
    covered = (_decimal(F.col("longer")) * 100) >= (_decimal(F.col("a")) * cover)
    return (best.join(covers, ["lang", *WORDS], "left")
            .where(~F.coalesce(covered, F.lit(False))).drop("longer"))


def _first(rows: DataFrame, order, limit: int, rank=F.rank) -> DataFrame:
    """The first ``limit`` rows of each language; ranked within salts first, so that no task sorts a whole language."""
    salted = rows.withColumn("_salt", F.pmod(F.xxhash64(*WORDS), F.lit(SALTS)))
    few = (salted.withColumn("_r", rank().over(Window.partitionBy("lang", "_salt").orderBy(*order)))
           .where(F.col("_r") <= limit))
    return (few.withColumn("_r", rank().over(Window.partitionBy("lang").orderBy(*order)))
            .where(F.col("_r") <= limit).drop("_salt"))


def collocations(docs: DataFrame, text_col: str = "text", lang_col: str = "lang", least: int = LEAST,
                 limit: int = LIMIT, cover: int = COVER, budget: int = BUDGET) -> DataFrame:
    """(lang, rank, phrase, a, l, r, n, score): the ``limit`` best phrases of each language."""
    spark = docs.sparkSession
    sc = spark.sparkContext
    ship(spark)
    texts = pick(docs, text=text_col, lang=lang_col).select("text", F.coalesce(F.col("lang").cast("string"), F.lit("und")).alias("lang"))
    seed = 0
    while True:
        words = written(word_counts(texts, seed))
        if not words.groupBy("lang", "h").agg(F.count(F.lit(1)).alias("m")).where("m > 1").limit(1).count():
            break
        seed += 1
    total = words.agg(F.sum("f").alias("n"), F.count(F.when(F.col("f") >= least, 1)).alias("often")).first()
    often = words.where(F.col("f") >= least)
    budget = max(budget, -(-(total.n or 0) // HEAVY))
    keyed = often.select(F.col("key").alias("h"), "f")
    reader = _Reader(seed, bitmap(keyed, total.often))
    reader.heavy = _heavy(keyed, budget)
    reader.groups = max(1, -(-(total.n or 0) // budget))
    pairs = written(pair_counts(texts, sc.broadcast(reader)).where(F.col("f") >= least))
    reader.pairs = bitmap(pairs, pairs.count())
    reader.heavy_pairs = _heavy(pairs, budget)
    known = sc.broadcast(reader)
    grouped = suffixes(texts, known).repartition("grp").sortWithinPartitions("grp")
    phrases = phrase_counts(grouped, known, least)
    zero = F.lit(0).cast("long")
    single = often.select("lang", F.col("h").alias("w1"), *[zero.alias(w) for w in WORDS[1:]], "f")
    counts = written(single.unionByName(phrases))
    by_score = [F.desc("score"), F.desc("a")]
    top = written(_first(scored(counts, least, cover), by_score, limit).drop("_r"))
    spelled = top
    for k, w in enumerate(WORDS):
        names = often.select("lang", F.col("h").alias(w), F.col("word").alias(f"s{k}"))
        spelled = spelled.join(names, ["lang", w], "left")
    spelled = spelled.withColumn("phrase", F.concat_ws(" ", *[f"s{k}" for k in range(DEPTH)]))
    ranked = _first(spelled, [*by_score, F.asc("phrase")], limit, F.row_number)
    n = words.groupBy("lang").agg(F.sum("f").alias("n"))
    return ranked.join(n, "lang").select("lang", F.col("_r").cast("long").alias("rank"), "phrase", "a", "l", "r", "n", "score")
