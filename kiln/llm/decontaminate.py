"""Benchmark decontamination, with DataFrame functions only.

Texts are lower-cased and cut into words at everything but letters and digits. An item's and
a window's features are their shingles of five words, weighted by how often they occur (a
text of fewer words is one shingle).

1. Windows: of the item-sized windows of a document at every start (the whole document, if it
   is shorter), those are taken that hold so many places with a shingle of the item that the
   similarity can be 0.8; their order does not matter. This is a filter that spares the
   fingerprints of windows without a chance, nothing is matched by it. The shingles are looked up in a bitmap
   of fixed size first (no false negatives) and then by a join, so that no text is shuffled
   and only the hits move on, every ANCHOR-th place with the words around it.
2. SimHash: a 64-bit fingerprint of each window and item, each bit the sign of the weighted
   sum over the shingles' hash bits.
3. Multi-index Hamming search: the fingerprint is cut into BLOCKS blocks. Two fingerprints
   within RADIUS bits differ in some block by RADIUS // BLOCKS bits at most, so an item's
   block with all such changes, joined with the windows' blocks, finds every fingerprint
   within the radius. Only these are candidates: of pairs at similarity 0.8 about one in a
   thousand lies beyond RADIUS by the model; more similar ones practically never do.
4. The exact weighted similarity (sum of the smaller over sum of the larger weights)
   verifies what is left: 0.8 or more is a leak.

Null and empty texts have no words and no leaks. Rows with one id, repeated or not, are one
document, null ids too. Of several windows of one item the most similar counts, the first
one on ties. Other columns are not read. Without documents or items the result is empty.
"""

from __future__ import annotations

from itertools import combinations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from kiln.llm.common import pick

SHINGLE = 5
MIN_SIMILARITY = 0.8
#: 64 bits in five blocks; three changed bits in a block at most. Two texts of similarity 0.8
#: differ by 10 bits on average, with a standard deviation of 3.
BLOCKS = (13, 13, 13, 13, 12)
RADIUS = 19
#: Places that carry their words. A window that is taken has a shingle of the item at eight of nine
#: of its places or more, and so at a multiple of ANCHOR (or of its number of places, if smaller).
ANCHOR = 4
#: The bitmap has 2^14 words of 64 bits.
BITMAP_WORDS = 1 << 14
#: Rows of an item table that are broadcast (20 bytes each); larger ones are left to a shuffled join.
MAX_BROADCAST_ROWS = 500_000


def _words(text: Column) -> Column:
    plain = F.regexp_replace(F.lower(F.coalesce(text, F.lit(""))), r"[^\p{L}\p{N}]+", " ")
    return F.array_remove(F.split(plain, " ", -1), "")


def _bind(value: Column, body) -> Column:
    """``body(value)`` with ``value`` computed once per row."""
    return F.element_at(F.transform(F.array(value), body), 1)


def _hash_at(words: Column, p: Column, k: int) -> Column:
    """Hash of the k words from place ``p`` (from 0) on."""
    return F.xxhash64(*[F.get(words, p + i) for i in range(k)])


def _shingles(words: Column) -> Column:
    """Hashes of the shingles of a short list of words; one of all words if they are fewer than five."""
    def five(w):
        return F.transform(F.sequence(F.lit(0), F.size(w) - SHINGLE), lambda p: _hash_at(w, p, SHINGLE))

    def one(w):
        hashes = F.xxhash64(F.get(w, F.lit(0)))
        for k in range(2, SHINGLE):
            hashes = F.when(F.size(w) >= k, _hash_at(w, F.lit(0), k)).otherwise(hashes)
        return F.when(F.size(w) > 0, F.array(hashes)).otherwise(F.array().cast("array<bigint>"))

    return _bind(words, lambda w: F.when(F.size(w) >= SHINGLE, five(w)).otherwise(one(w)))


def _simhash(shingles: Column) -> Column:
    def bit(s, b):
        ones = F.size(F.filter(s, lambda h: F.call_function("shiftright", h, b).bitwiseAND(F.lit(1)) == 1))
        return F.when(ones * 2 > F.size(s), F.call_function("shiftleft", F.lit(1).cast("long"), b)).otherwise(F.lit(0).cast("long"))

    return _bind(shingles, lambda s: F.aggregate(F.sequence(F.lit(0), F.lit(63)), F.lit(0).cast("long"),
                                                 lambda acc, b: acc.bitwiseOR(bit(s, b))))


def _similarity(a: Column, b: Column) -> Column:
    """Weighted Jaccard similarity of two lists of shingles, a repeated one weighing as often."""
    def times(of, d):
        return F.size(F.filter(of, lambda x: x == d))

    both = F.aggregate(F.array_distinct(a), F.lit(0), lambda acc, d: acc + F.least(times(a, d), times(b, d)))
    return both / (F.size(a) + F.size(b) - both)


def _block_keys(fingerprint: Column) -> list[Column]:
    out, at = [], 0
    for bits in BLOCKS:
        out.append(F.shiftright(fingerprint, at).bitwiseAND(F.lit((1 << bits) - 1)).cast("int"))
        at += bits
    return out


def _changed(i: int, bits: int, key: Column) -> Column:
    """Block ``i`` with each change of RADIUS // len(BLOCKS) of its bits or fewer."""
    changes = [sum(1 << b for b in c) for n in range(RADIUS // len(BLOCKS) + 1) for c in combinations(range(bits), n)]
    return F.transform(F.from_json(F.lit(str(changes)), "array<int>"),
                       lambda c: F.struct(F.lit(i).alias("block"), key.bitwiseXOR(c).alias("key")))


def _bounded(df: DataFrame, rows: int) -> DataFrame:
    return F.broadcast(df) if rows <= MAX_BROADCAST_ROWS else df


def items_of(benchmark: DataFrame, item_col: str = "item_id", text_col: str = "text") -> DataFrame:
    """(item_id, words, size, k, shingles, fingerprint) of the items that have a word."""
    words = pick(benchmark, item_id=item_col, text=text_col).select("item_id", _words(F.col("text")).alias("words"))
    shingled = words.where(F.size("words") > 0).withColumn("shingles", _shingles(F.col("words")))
    return shingled.select("item_id", "words", F.size("words").alias("size"),
                           F.least(F.size("words"), F.lit(SHINGLE)).alias("k"), "shingles",
                           _simhash(F.col("shingles")).alias("fingerprint"))


def _places(items: DataFrame) -> DataFrame:
    """(k, h, size, key): shingles of items, the size of the item, and a hash of all its shingles."""
    return items.select("size", "k", F.xxhash64("shingles").alias("key"), F.explode("shingles").alias("h")).distinct()


def _word_of(h: Column) -> Column:
    """The bitmap's word of a hash: its 14 upper bits."""
    return F.shiftrightunsigned(h, 50).cast("int")


def _bit_of(h: Column) -> Column:
    return h.bitwiseAND(F.lit(63)).cast("int")


def _hits(words: Column, k: int, bitmap: list[int], longest: int, anchor: int) -> Column:
    """Places whose k-word shingle is in the bitmap: hash, place, number of words, and at every
    ``anchor``-th place the words near it."""
    table = F.from_json(F.lit(str(bitmap)), "array<bigint>")

    def known(h):
        return F.call_function("shiftright", F.get(table, _word_of(h)), _bit_of(h)).bitwiseAND(F.lit(1)) == 1

    def context(w, p):
        lo = F.greatest(p - longest, F.lit(0))
        return F.struct(_hash_at(w, p, k).alias("h"), p.alias("p"), lo.alias("lo"), F.size(w).alias("n"),
                        F.when(p % anchor == 0, F.slice(w, lo + 1, F.lit(2 * longest))).alias("near"))

    def hits(w):
        found = F.filter(F.sequence(F.lit(0), F.size(w) - k), lambda p: _bind(_hash_at(w, p, k), known))
        return F.when(F.size(w) >= k, F.transform(found, lambda p: context(w, p)))

    return _bind(words, hits)


def _taken(hits: Column, n: Column, size: Column, k: int) -> Column:
    """(start, words) of the windows whose hits can make 0.8. ``hits``: (p, lo, near) of all
    places of one document that have a shingle of one item, in order."""
    width = F.least(size, n)
    places = width - k + 1
    need = F.ceil((places + size - k + 1) * MIN_SIMILARITY / (1 + MIN_SIMILARITY) - 1e-9).cast("int")

    def p(h, i):
        return F.get(h, i)["p"]

    def of(h, i):
        """The starts of windows that hold ``need`` hits from the i-th on, and not the one before."""
        lo = F.greatest(p(h, i + need - 1) - places + 1, F.coalesce(p(h, i - 1) + 1, F.lit(0)), F.lit(0))
        hi = F.least(p(h, i), n - width)
        anchor = F.get(F.filter(F.slice(h, i + 1, need), lambda x: x["near"].isNotNull()), F.lit(0))
        starts = F.when(lo <= hi, F.sequence(lo, hi)).otherwise(F.array().cast("array<int>"))
        return _bind(anchor, lambda a: F.transform(starts, lambda t: F.struct(
            t.alias("start"), F.slice(a["near"], t - a["lo"] + 1, width).alias("words"))))

    def all_of(h):
        first = F.when(F.size(h) >= need, F.sequence(F.lit(0), F.size(h) - need)).otherwise(F.array().cast("array<int>"))
        return F.flatten(F.transform(F.filter(first, lambda i: p(h, i + need - 1) - p(h, i) < places), lambda i: of(h, i)))

    return _bind(hits, all_of)


def _windows(docs: DataFrame, places: DataFrame, known: list, n_places: int) -> DataFrame:
    """(doc_id, size, key, start, words): the item-sized windows that share enough with an item.
    ``known``: (k, longest, shortest), the sizes of the items by k."""
    parts = []
    for k, longest, shortest in known:
        of_k = places.where(F.col("k") == k)
        bits = (of_k.groupBy(_word_of(F.col("h")).alias("w"))
                .agg(F.bit_or(F.call_function("shiftleft", F.lit(1).cast("long"), _bit_of(F.col("h")))).alias("b"))
                .collect())  # BITMAP_WORDS rows at most
        bitmap = [0] * BITMAP_WORDS
        for row in bits:
            bitmap[row.w] = row.b
        hits = _hits(_words(F.col("text")), k, bitmap, longest, min(ANCHOR, shortest - k + 1))
        near = (docs.select("doc_id", F.xxhash64("text").alias("row"), F.explode(hits).alias("x"))
                .select("doc_id", "row", "x.*"))
        joined = near.join(_bounded(of_k.select("h", "size", "key"), n_places), "h")
        # The hits of one text and one item meet in one task; repeated rows are the same ones.
        met = (joined.groupBy("doc_id", "row", "n", "size", "key")
               .agg(F.sort_array(F.collect_set(F.struct("p", "lo", "near"))).alias("hits")))
        parts.append(met.select("doc_id", "size", "key", F.explode(_taken(F.col("hits"), F.col("n"), F.col("size"), k)).alias("x"))
                     .select("doc_id", "size", "key", "x.*"))
    out = parts[0]
    for part in parts[1:]:
        out = out.union(part)
    return out


def leaks(docs: DataFrame, benchmark: DataFrame, id_col: str = "doc_id", text_col: str = "text",
          item_col: str = "item_id", item_text_col: str = "text") -> DataFrame:
    """(doc_id, item_id, similarity, start): the documents that hold an item, and the place of
    the most similar window, in words."""
    rows = pick(docs, doc_id=id_col, text=text_col)
    items = items_of(benchmark, item_col, item_text_col)
    places = _places(items)
    known = places.groupBy("k").agg(F.count(F.lit(1)).alias("n"), F.max("size").alias("longest"), F.min("size").alias("shortest")
                                     ).collect()  # 5 rows at most
    windows = _windows(rows, places, sorted((r.k, r.longest, r.shortest) for r in known) or [(SHINGLE, SHINGLE, SHINGLE)],
                       sum(r.n for r in known))
    windows = windows.withColumn("shingles", _shingles(F.col("words")))
    windows = windows.select("doc_id", "size", "start", "shingles", _simhash(F.col("shingles")).alias("fingerprint"))

    own = F.array(*[F.struct(F.lit(i).alias("block"), key.alias("key"))
                    for i, key in enumerate(_block_keys(F.col("fingerprint")))])
    near = F.concat(*[_changed(i, bits, key)
                      for i, (bits, key) in enumerate(zip(BLOCKS, _block_keys(F.col("fingerprint"))))])
    of_windows = (windows.withColumn("x", F.explode(own))
                  .select("doc_id", "size", "start", "shingles", "fingerprint", "x.block", "x.key"))
    of_items = (items.select("item_id", "size", F.col("shingles").alias("item_shingles"),
                             F.col("fingerprint").alias("item_fingerprint"), F.explode(near).alias("x"))
                .select("*", "x.block", "x.key").drop("x"))
    close = (of_windows.join(of_items, ["size", "block", "key"])
             .where(F.bit_count(F.col("fingerprint").bitwiseXOR(F.col("item_fingerprint"))) <= RADIUS)
             .withColumn("similarity", _similarity(F.col("shingles"), F.col("item_shingles")))
             .where(F.col("similarity") >= MIN_SIMILARITY))
    best = F.max_by("start", F.struct("similarity", -F.col("start")))
    return close.groupBy("doc_id", "item_id").agg(F.max("similarity").alias("similarity"), best.alias("start"))


def keep_clean(docs: DataFrame, benchmark: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """The rows of ``docs`` without a leak, all columns as they were; rows without an id stay."""
    gone = leaks(docs, benchmark, id_col, text_col).select(F.col("doc_id").alias("_gone")).distinct()
    return docs.join(gone, docs[id_col] == F.col("_gone"), "left_anti")
