"""Ranked lexical search by a length-stratified index.

A document's score for an item sums, over the item's distinct terms, w * impact, where w depends on
the term alone and impact on (tf, m) alone; m is the document's length normaliser:

    w       floor(1000 * ln((2N + 2) / (2df + 1)))
    m       50 + (50 * n * N) div L
    impact  (1000000000 * tf) div (1000 * tf + 20 * m)

N counts the documents with a term, L all their terms, n one document's. Terms are maximal runs of
letters and digits of ASCII (A-Z in lower case) and of all other characters beyond ASCII.

1. Counting: one pass over the texts gives every document's n and its tf of the terms searched for.
2. Index: documents of one m form a stratum; a stratum of more than BLOCK_DOCS documents is split by
   hash, so that a length which a third of all documents share is no single task. A block of a
   stratum is one row: its documents, and its postings ordered by term and tf. In a block the
   impact of a tf is computed once, for all its postings.
3. Bounds: with the largest tf of each term in a block, the weights give the most that a document of
   the block can score for an item.
4. First visits: for every item the blocks of highest bound, as many as surely hold k documents of a
   score above 0, are scored. The k-th score is the item's floor.
5. All blocks are passed once, and scored for those items whose bound there reaches the floor; the
   floor rises with what a task has found. Each task keeps k documents an item, ties at the
   k-th place by the smallest ids; the k best of these are the result.

Nothing is lost: a block is left out for an item only if its bound is below the score of k documents.

The items are the stated query set. They are taken in blocks of about TERMS terms (one item at
least), whose terms, weights and floors are known to the driver and every task. Null and empty
texts have no terms: such a document is not counted in N, such an item has no result. Rows that
repeat a doc_id are documents of their own, rows that repeat an item_id are ranked each by itself.
A null doc_id comes before all others at equal scores. A very long text is counted whole, in one
task. Empty tables give no rows. Other columns are not read.
"""

from __future__ import annotations

import math

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from kiln.llm.common import pick, ranges, ship, written
from kiln.llm.word_ids import gather, text_bytes, words_between

#: Documents in a block of the index, about; terms of the items searched for at once, about.
BLOCK_DOCS = 1024
TERMS = 200_000
#: Bytes of text counted at once.
SLICE = 8 << 20

_LOWER = np.array([b + 32 if 65 <= b <= 90 else b for b in range(256)], np.uint8)
_TERM = np.array([b >= 128 or chr(b).isalnum() for b in range(256)])


def cut_terms(texts: pa.Array) -> tuple[pa.Array, np.ndarray]:
    """The terms of all texts and the index of each one's text."""
    data, bounds = text_bytes(texts)
    terms, _, text = words_between(_LOWER[data], bounds, _TERM)
    return terms, text


def impact(tf: np.ndarray, m) -> np.ndarray:
    return (1_000_000_000 * tf) // (1000 * tf + 20 * m)


def weight(n_docs: int, df: int) -> int:
    return math.floor(1000 * math.log((2 * n_docs + 2) / (2 * df + 1)))


class Query:
    """The items of one block: item i has the terms term[first[i]:first[i + 1]], numbers in ``number``."""

    def __init__(self, rows):
        self.item_ids = [r.item_id for r in rows]
        self.number: dict[bytes, int] = {}
        lists = [[self.number.setdefault(bytes(t), len(self.number)) for t in r.terms] for r in rows]
        self.first = np.concatenate([[0], np.cumsum([len(x) for x in lists])]).astype(np.int64)
        self.term = np.array([t for x in lists for t in x], np.int64)
        self.weights = np.zeros(len(self.number), np.int64)

    def bounds(self, best: np.ndarray) -> np.ndarray:
        """Per item the sum of w * ``best`` (by term number) over its terms."""
        sums = np.concatenate([[0], np.cumsum(self.weights[self.term] * best[self.term])])
        return sums[self.first[1:]] - sums[self.first[:-1]]

    def most(self, count: np.ndarray) -> np.ndarray:
        """Per item the largest ``count`` (by term number) over its terms of a weight above 0."""
        return np.maximum.reduceat(np.where(self.weights[self.term] > 0, count[self.term], 0), self.first[:-1])


def item_terms(items: DataFrame) -> DataFrame:
    """(item_id, terms): the distinct terms of every item that has one, sorted."""
    kind = items.schema["item_id"].dataType.simpleString()

    def run(batches):
        for batch in batches:
            terms, text = cut_terms(batch.column(1))
            held: list[set] = [set() for _ in range(len(batch))]
            for t, i in zip(terms.to_pylist(), text.tolist()):
                held[i].add(t)
            keep = pa.array([bool(x) for x in held])
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array([sorted(x) for x in held], pa.list_(pa.binary()))],
                                             names=["item_id", "terms"]).filter(keep)

    return items.mapInArrow(run, f"item_id {kind}, terms array<binary>")


def counted(docs: DataFrame, query) -> DataFrame:
    """(doc_id, n, terms, tfs) of every document with a term: n of all its terms; numbers and frequencies of
    those searched for, as little-endian unsigned 32-bit integers."""
    kind = docs.schema["doc_id"].dataType.simpleString()

    def run(batches):
        number = query.value.number
        for batch in batches:
            for lo, hi in ranges(np.diff(text_bytes(batch.column(1))[1]), SLICE):
                part = batch.slice(lo, hi - lo)
                terms, text = cut_terms(part.column(1))
                coded = terms.dictionary_encode()
                of = np.array([number.get(t, -1) for t in coded.dictionary.to_pylist()] or [0], np.int64)
                code = of[coded.indices.to_numpy()] if len(terms) else np.zeros(0, np.int64)
                n = np.bincount(text, minlength=len(part))
                key, tf = np.unique((text * (len(number) + 1) + code)[code >= 0], return_counts=True)
                at = np.searchsorted(key // (len(number) + 1), np.arange(len(part) + 1)) * 4
                rows = [np.ascontiguousarray(x, "<u4").tobytes() for x in (key % (len(number) + 1), tf)]
                cut = [pa.array([x[a:b] for a, b in zip(at[:-1], at[1:])], pa.binary()) for x in rows]
                yield pa.RecordBatch.from_arrays([part.column(0), pa.array(n, pa.int64()), *cut],
                                                 names=["doc_id", "n", "terms", "tfs"]).filter(pa.array(n > 0))

    return docs.mapInArrow(run, f"doc_id {kind}, n long, terms binary, tfs binary")


def document_frequencies(rows: DataFrame, n_terms: int) -> DataFrame:
    """(term, df): summed in each task before the shuffle."""
    def run(batches):
        total = np.zeros(n_terms, np.int64)
        for batch in batches:
            for data in batch.column(0).to_pylist():
                total[np.frombuffer(data, "<u4")] += 1
        seen = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(seen, pa.int32()), pa.array(total[seen], pa.int64())], names=["term", "df"])

    return rows.select("terms").mapInArrow(run, "term int, df long").groupBy("term").agg(F.sum("df").alias("df"))


_BLOCK = "m long, block int, doc_ids array<{}>, terms binary, tfs binary, first binary, members binary"


def stratified(rows: DataFrame, n_docs: int, n_terms: int) -> DataFrame:
    """The index: one row for each block of a stratum. A group of postings is one (term, tf): ``terms`` and
    ``tfs`` name the groups, ordered by term and falling tf; group g has the documents
    members[first[g]:first[g + 1]], places in ``doc_ids``."""
    kind = rows.schema["doc_id"].dataType
    # 50 * n * N may pass 64 bits.
    m = F.lit(50) + F.expr(f"cast((cast(50 as decimal(2,0)) * cast(n as decimal(18,0)) * cast({n_docs} as decimal(18,0))) div "
                           f"cast({max(1, n_terms)} as decimal(20,0)) as bigint)")
    placed = rows.withColumn("m", m)
    sizes = placed.groupBy("m").agg(F.ceil(F.count(F.lit(1)) / F.lit(BLOCK_DOCS)).cast("int").alias("blocks"))
    placed = (placed.join(sizes, "m").withColumn("block", F.pmod(F.xxhash64("doc_id", "terms"), F.col("blocks")).cast("int"))
              .select("m", "block", "doc_id", "n", "terms", "tfs"))

    def row(m, block, doc_ids, terms, tfs, type_):
        size = np.array([len(t) // 4 for t in terms], np.int64)
        term = np.frombuffer(b"".join(terms), "<u4").astype(np.int64)
        tf = np.frombuffer(b"".join(tfs), "<u4").astype(np.int64)
        doc = np.repeat(np.arange(len(size)), size)
        order = np.lexsort((doc, -tf, term))
        term, tf, doc = term[order], tf[order], doc[order]
        new = np.flatnonzero(np.concatenate([[True], (term[1:] != term[:-1]) | (tf[1:] != tf[:-1])])[:len(term)])
        first = np.append(new, len(term))
        pack = lambda x: pa.array([x.astype("<u4").tobytes()], pa.binary())
        return pa.RecordBatch.from_arrays(
            [pa.array([m], pa.int64()), pa.array([block], pa.int32()), pa.array([doc_ids], pa.list_(type_)),
             pack(term[new]), pack(tf[new]), pack(first), pack(doc)],
            names=["m", "block", "doc_ids", "terms", "tfs", "first", "members"])

    def run(batches):
        now, held, type_ = None, [], None
        for batch in batches:
            type_ = batch.schema.field("doc_id").type
            for m, block, doc, _, terms, tfs in zip(*[c.to_pylist() for c in batch.columns]):
                if held and (m, block) != now:
                    yield row(*now, *map(list, zip(*held)), type_)
                    held = []
                now = (m, block)
                held.append((doc, terms, tfs))
        if held:
            yield row(*now, *map(list, zip(*held)), type_)

    return (placed.repartition("m", "block").sortWithinPartitions("m", "block")
            .mapInArrow(run, _BLOCK.format(kind.simpleString())))


class Block:
    """One row of the index, read for one query."""

    def __init__(self, m: int, terms: bytes, tfs: bytes, first: bytes, n_terms: int):
        of = lambda b: np.frombuffer(b, "<u4").astype(np.int64)
        self.m, self.group_term, self.first = m, of(terms), of(first)
        tf = of(tfs)
        self.impact = impact(tf, m)  # once for each tf of a term
        lead = np.flatnonzero(np.concatenate([[True], self.group_term[1:] != self.group_term[:-1]])[:len(tf)])
        self.start, self.end = np.zeros(n_terms, np.int64), np.zeros(n_terms, np.int64)  # term -> its groups
        held = self.group_term[lead]
        self.start[held], self.end[held] = lead, np.append(lead[1:], len(tf))
        self.best = np.zeros(n_terms, np.int64)
        self.best[held] = self.impact[lead]

    def sure(self) -> np.ndarray:
        """By term the number of documents that hold it, if even tf 1 has an impact."""
        return (self.first[self.end] - self.first[self.start]) * int(impact(np.array(1), self.m) > 0)

    def scores(self, members: np.ndarray, n_docs: int, terms: np.ndarray, weights: np.ndarray) -> np.ndarray:
        """Every document's score for one item. Sums are far below 2^53, so that doubles hold them exactly."""
        lo, hi = self.first[self.start[terms]], self.first[self.end[terms]]
        docs, _ = gather(members, lo, hi - lo)
        groups, ends = gather(np.arange(len(self.impact)), self.start[terms], self.end[terms] - self.start[terms])
        value = np.repeat(weights, np.diff(ends)) * self.impact[groups]
        value = np.repeat(value, self.first[groups + 1] - self.first[groups])
        return np.bincount(docs, value.astype(np.float64), n_docs).astype(np.int64)


def _first_visits(index: DataFrame, query, k: int) -> DataFrame:
    """(item, m, block): for every item the blocks of highest bound that surely hold k documents of a score
    above 0 (or all blocks). Each task leaves at most k blocks an item."""
    def run(batches):
        q = query.value
        held: list[list] = [[] for _ in q.item_ids]

        def enough(found):
            """The best blocks until k documents are sure: no block beyond can be needed."""
            found.sort(key=lambda x: (-x[0], x[1], x[2]))
            total = 0
            for i, x in enumerate(found):
                total += x[3]
                if total >= k:
                    return found[:i + 1]
            return found

        for batch in batches:
            for m, block, terms, tfs, first in zip(*[c.to_pylist() for c in batch.columns]):
                b = Block(m, terms, tfs, first, len(q.number))
                bounds, sure = q.bounds(b.best), q.most(b.sure())
                for i in np.flatnonzero((bounds > 0) & (sure > 0)).tolist():
                    held[i].append((int(bounds[i]), m, block, int(sure[i])))
                    if len(held[i]) >= 4 * k:
                        held[i] = enough(held[i])
        out = [(i, *x) for i, found in enumerate(held) for x in enough(found)]
        if out:
            kinds = (pa.int32(), pa.int64(), pa.int64(), pa.int32(), pa.int64())
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*out), kinds)],
                                             names=["item", "bound", "m", "block", "sure"])

    near = (index.select("m", "block", "terms", "tfs", "first")
            .mapInArrow(run, "item int, bound long, m long, block int, sure long"))
    before = (Window.partitionBy("item").orderBy(F.desc("bound"), "m", "block")
              .rowsBetween(Window.unboundedPreceding, -1))
    return (near.withColumn("before", F.coalesce(F.sum("sure").over(before), F.lit(0)))
            .where(F.col("before") < k).select("item", "m", "block"))


class _Best:
    """The k best documents of an item that a task has found, and more until ``trim``."""

    def __init__(self, k: int, floor: int):
        self.k, self.floor, self.scores, self.docs, self.n = k, max(1, floor), [], [], 0

    def add(self, scores: np.ndarray, doc_ids: pa.Array) -> None:
        at = np.flatnonzero(scores >= self.floor)
        if len(at):
            self.scores.append(scores[at])
            self.docs.append(doc_ids.take(pa.array(at)))
            self.n += len(at)
            if self.n >= 8 * self.k:
                self.trim()

    def trim(self):
        scores, docs = np.concatenate(self.scores), pa.concat_arrays(self.docs)
        table = pa.table({"score": pa.array(-scores), "doc": docs})
        order = pc.sort_indices(table, [("score", "ascending"), ("doc", "ascending")], null_placement="at_start")[:self.k]
        scores, docs = scores[order.to_numpy()], docs.take(order)
        self.scores, self.docs, self.n = [scores], [docs], len(scores)
        if self.n == self.k:
            self.floor = max(self.floor, int(scores[-1]))
        return scores, docs


def _scored(index: DataFrame, query, k: int, kind: str, wanted=None, floors=None) -> DataFrame:
    """(item, doc_id, score): of each task the k best documents for every item, out of the blocks ``wanted``
    ((m, block) -> items) or else of those whose bound reaches the item's floor."""
    def run(batches):
        q = query.value
        best = [_Best(k, 0 if floors is None else floors.value[i]) for i in range(len(q.item_ids))]
        type_ = None
        for batch in batches:
            type_ = batch.schema.field("doc_ids").type.value_type
            for j, (m, block, terms, tfs, first, members) in enumerate(zip(*[
                    batch.column(c).to_pylist() for c in ("m", "block", "terms", "tfs", "first", "members")])):
                items = None if wanted is None else wanted.value.get((m, block), ())
                if items is not None and not len(items):
                    continue
                b = Block(m, terms, tfs, first, len(q.number))
                if items is None:
                    bounds = q.bounds(b.best)
                    items = np.flatnonzero(bounds >= np.array([x.floor for x in best])).tolist()
                if not len(items):
                    continue
                doc_ids = batch.column("doc_ids").slice(j, 1).flatten()
                members = np.frombuffer(members, "<u4")
                for i in items:
                    of = q.term[q.first[i]:q.first[i + 1]]
                    best[i].add(b.scores(members, len(doc_ids), of, q.weights[of]), doc_ids)
        for i, found in enumerate(best):
            if found.n:
                scores, docs = found.trim()
                yield pa.RecordBatch.from_arrays([pa.array([i] * len(scores), pa.int32()), docs.cast(type_),
                                                  pa.array(scores, pa.int64())], names=["item", "doc_id", "score"])

    return index.mapInArrow(run, f"item int, doc_id {kind}, score long")


def _rank(scored: DataFrame, k: int) -> DataFrame:
    order = Window.partitionBy("item").orderBy(F.desc("score"), F.asc_nulls_first("doc_id"))
    return scored.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k)


def _search_block(docs: DataFrame, rows: list, k: int) -> DataFrame:
    """(item, rank, doc_id, score) for the items ``rows``, their numbers as ``item``."""
    spark = docs.sparkSession
    sc = spark.sparkContext
    kind = docs.schema["doc_id"].dataType.simpleString()
    query = Query(rows)
    named = sc.broadcast(query)
    table = written(counted(docs, named))
    total = table.agg(F.count(F.lit(1)).alias("N"), F.coalesce(F.sum("n"), F.lit(0)).alias("L")).first()
    # One number for each term searched for reaches the driver.
    for r in document_frequencies(table, len(query.number)).toLocalIterator():
        query.weights[r.term] = weight(total.N, r.df)
    weighted = sc.broadcast(query)
    index = written(stratified(table, total.N, total.L))
    visits: dict[tuple, list] = {}  # at most k blocks an item
    for r in _first_visits(index, weighted, k).collect():
        visits.setdefault((r.m, r.block), []).append(r.item)
    floors = [0] * len(query.item_ids)
    first = _rank(_scored(index, weighted, k, kind, wanted=sc.broadcast(visits)), k)
    for r in first.where(F.col("rank") == k).select("item", "score").collect():
        floors[r.item] = r.score
    return _rank(_scored(index, weighted, k, kind, floors=sc.broadcast(floors)), k)


def search(docs: DataFrame, items: DataFrame, k: int = 50, id_col: str = "doc_id", text_col: str = "text",
           item_id_col: str = "item_id", item_text_col: str = "text") -> DataFrame:
    """(item_id, rank, doc_id, score): the ``k`` highest-scoring documents of every item, score above 0."""
    spark = docs.sparkSession
    ship(spark)
    docs = pick(docs, doc_id=id_col, text=text_col)
    listed = item_terms(pick(items, item_id=item_id_col, text=item_text_col))
    listed = written(listed.withColumn("row", F.monotonically_increasing_id()))
    # The query set in blocks: one number for each item is summed in order.
    sums = Window.orderBy("row").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    blocks = listed.select("row", F.floor(F.sum(F.size("terms")).over(sums) / TERMS).cast("long").alias("part"))
    listed = listed.join(blocks, "row")
    out = None
    for part in [r.part for r in listed.select("part").distinct().orderBy("part").collect()]:
        rows = listed.where(F.col("part") == part).select("item_id", "terms").collect()
        names = spark.createDataFrame([(i, r.item_id) for i, r in enumerate(rows)],
                                      f"item int, item_id {items.schema[item_id_col].dataType.simpleString()}")
        found = (_search_block(docs, rows, k).join(F.broadcast(names), "item").select("item_id", "rank", "doc_id", "score"))
        out = found if out is None else out.unionByName(found)
    if out is None:
        kind = items.schema[item_id_col].dataType.simpleString()
        return spark.createDataFrame([], f"item_id {kind}, rank int, doc_id {docs.schema['doc_id'].dataType.simpleString()}, score long")
    return out
