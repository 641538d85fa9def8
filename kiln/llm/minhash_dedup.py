"""Near-duplicate removal by bottom-k sketches of one hash function.

1. A text's set is its distinct 2-word shingles as 64-bit hashes. Texts with one set form a
   class; from here on only classes count, so exact copies cost nothing.
2. The sketch of a class is the k smallest hashes of its set. Inverted lists: a list holds
   the classes that retain three values next to each other in their sketches (two, for sets
   so small that three need not agree). Two sets of similarity 0.8 differ in a fifth of
   their union's values, which leaves runs of agreeing values: for sets of up to k values
   some run of three is certain, for larger ones it is missing with a chance below 1e-9 at
   k = 64. Single values would be shared by any two texts with a common phrase.
3. Overlaps from the lists, first as stars: in each list every class is paired with a hub, the
   class with the smallest id. The union-sketch estimate drops pairs far below the threshold,
   the full sets confirm the rest, and connected components are formed. Then the same with
   two more hubs, the first and the last class by hash, for pairs not in one component yet.
4. What a star cannot see are links between two classes of one list that are no hubs of it.
   Where these are still in several components, they are compared in full, in blocks of
   BLOCK classes, pairs of different components only (blocks of a list's largest component do not
   meet each other): the estimate first, then the full sets, within the list with the smallest key
   that the pair shares. Only confirmed links leave a task. Every pair of one list is thus in one component or has been compared.
5. Components are merged along the new links after each step (nothing is computed where a step
   finds none), and every row gets the component of its class.

Lists with the same classes are one list: the pairs are the same. No list is capped. Null and empty texts have an empty set and are linked with nothing.
Rows that repeat a doc_id are separate members of their classes: each is answered by its own
text. Null ids are ignored when the smallest id is sought; a class of null ids only is linked
with nothing and has a null component (``kept`` null). Other columns are not read. A very long
text is one set, held by one task. An empty table gives no rows.
"""

from __future__ import annotations

import hashlib

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from kiln.llm.common import combine, mix, pick, ship, word_hashes, written

#: Values a sketch retains, and the threshold as a percentage.
SKETCH = 64
PERCENT = 80
SHINGLE = 2
#: The estimate of a pair may fall short of the threshold by so much and still be confirmed
#: in full: more than 4.5 standard deviations of a 64-value union sketch at 0.8.
SLACK = 0.23
#: Classes compared at once in a long list; longer lists are cut into pairs of such blocks.
BLOCK = 2048
#: Rows of a block that meet the other block at once: a bound on a task's memory.
STRIP = 256

LOWER = bytes.maketrans(b"ABCDEFGHIJKLMNOPQRSTUVWXYZ", b"abcdefghijklmnopqrstuvwxyz")


def shingle_set(text: str | None, size: int = SHINGLE) -> np.ndarray:
    """Sorted distinct 64-bit hashes of the text's shingles of ``size`` words. The words are
    separated by ASCII white space, A-Z lower-cased."""
    words = word_hashes([w.decode() for w in (text or "").encode().translate(LOWER).split()])
    if not len(words):
        return words
    n = min(size, len(words))
    h = mix(words[:len(words) - n + 1])
    for i in range(1, n):
        h = combine(h, words[i:len(words) - n + 1 + i])
    return np.unique(h)


def list_keys(sketch: np.ndarray, run: int) -> np.ndarray:
    h = mix(sketch[:len(sketch) - run + 1] + np.uint64(run))
    for i in range(1, run):
        h = combine(h, sketch[i:len(sketch) - run + 1 + i])
    return h


def sketch_keys(sketch: np.ndarray) -> np.ndarray:
    """Keys of the inverted lists a sketch is in: runs of three retained values, and of two
    for sets of five values or fewer (with a union of five, only a run of two is certain)."""
    keys = [list_keys(sketch, 3)] if len(sketch) >= 5 else []
    if 4 <= len(sketch) <= 5:
        keys.append(list_keys(sketch, 2))
    return np.unique(np.concatenate(keys)) if keys else np.zeros(0, np.uint64)


def estimate(a: np.ndarray, b: np.ndarray) -> float:
    """Similarity of two sets by their sketches: the share of the smallest values of the
    union (as many as both sketches vouch for) that both retain. Exact for sets that fit."""
    if len(a) < SKETCH and len(b) < SKETCH:
        both = len(np.intersect1d(a, b, assume_unique=True))
        return both / max(1, len(a) + len(b) - both)
    union = np.union1d(a, b)[:SKETCH]
    both = np.intersect1d(a, b, assume_unique=True)
    return float((both <= union[-1]).sum()) / len(union)


def linked(a: np.ndarray, b: np.ndarray, percent: int = PERCENT) -> bool:
    """The exact test on full sets."""
    small, large = sorted((len(a), len(b)))
    if 100 * small < percent * large:
        return False
    both = len(np.intersect1d(a, b, assume_unique=True))
    return 100 * both >= percent * (len(a) + len(b) - both)


def _values(data: bytes) -> np.ndarray:
    return np.frombuffer(data, np.uint64)


def _features(rows: DataFrame) -> DataFrame:
    """(doc_id, n, digest, c, sketch) of every row; c, the first 64 bits of the digest, names the class."""
    kind = rows.schema["doc_id"].dataType.simpleString()

    def run(batches):
        for batch in batches:
            sets = [shingle_set(t) for t in batch.column(1).to_pylist()]
            digests = [_digest(s) for s in sets]
            yield pa.RecordBatch.from_arrays([
                batch.column(0), pa.array([len(s) for s in sets], pa.int64()), pa.array(digests, pa.binary()),
                pa.array([_name(d) for d in digests], pa.int64()),
                pa.array([s[:SKETCH].tobytes() for s in sets], pa.binary())],
                names=["doc_id", "n", "digest", "c", "sketch"])

    return rows.mapInArrow(run, f"doc_id {kind}, n long, digest binary, c long, sketch binary")


def _digest(values: np.ndarray) -> bytes:
    return hashlib.blake2b(values.tobytes(), digest_size=16).digest()


def _name(digest: bytes) -> int:
    return int.from_bytes(digest[:8], "little", signed=True)


def _lists(classes: DataFrame) -> DataFrame:
    """(key, c, id): the inverted lists of the classes."""
    def run(batches):
        for batch in batches:
            keys = [sketch_keys(_values(s)) for s in batch.column(2).to_pylist()]
            sizes = np.array([len(k) for k in keys], np.int64)
            if sizes.sum():
                at = pa.array(np.repeat(np.arange(len(sizes)), sizes))
                yield pa.RecordBatch.from_arrays(
                    [pa.array(np.concatenate(keys).view(np.int64)), batch.column(0).take(at), batch.column(1).take(at)],
                    names=["key", "c", "id"])

    kind = classes.schema["id"].dataType.simpleString()
    return classes.select("c", "id", "sketch").mapInArrow(run, f"key long, c long, id {kind}")


def _shared(lists: DataFrame) -> DataFrame:
    """(key, c, id, h1, h2, h3): the lists of two classes and more with three hubs each, the class of the smallest
    id, the first and the last. Of lists with the same classes only the one with the smallest key is
    left: copies share dozens of them. They are told by number, ends and two sums of 64-bit hashes."""
    several = lists.groupBy("key").agg(F.count(F.lit(1)).alias("m")).where("m > 1").select("key")
    shared = written(lists.join(several, "key"))
    low = F.expr("key ^ shiftleft(1L, 63)")  # keys compare as unsigned numbers in _pairs, so here
    total = lambda seed: F.sum(F.xxhash64("c", F.lit(seed)).cast("decimal(20,0)"))
    hubs = shared.groupBy("key").agg(F.min_by("c", "id").alias("h1"), F.min("c").alias("h2"), F.max("c").alias("h3"),
                                     F.count(F.lit(1)).alias("m"), total(1).alias("s1"), total(2).alias("s2"))
    one = (hubs.groupBy("m", "h2", "h3", "s1", "s2").agg(F.min(F.struct(low.alias("low"), "key", "h1")).alias("one"))
           .select("one.key", "one.h1", "h2", "h3"))
    return shared.join(one, "key").select("key", "c", "id", "h1", "h2", "h3")


def _texts(source: DataFrame, members: DataFrame) -> DataFrame:
    """(c, n, sketch, blob) of the classes in ``members`` (c, id): the compressed text of one row each.
    Rows that have the id but another text are told by their digest."""
    kind = source.schema["doc_id"].dataType.simpleString()

    def pack(batches):
        press = zstandard.ZstdCompressor(level=3).compress
        for batch in batches:
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array([press((t or "").encode()) for t in batch.column(1).to_pylist()], pa.binary())],
                names=["id", "blob"])

    def own(batches):
        unpack = zstandard.ZstdDecompressor().decompress
        for batch in batches:
            sets = [shingle_set(unpack(b).decode()) for b in batch.column(1).to_pylist()]
            ok = pa.array([_name(_digest(s)) == c for s, c in zip(sets, batch.column(0).to_pylist())], pa.bool_())
            yield pa.RecordBatch.from_arrays([
                batch.column(0), pa.array([len(s) for s in sets], pa.int64()),
                pa.array([s[:SKETCH].tobytes() for s in sets], pa.binary()), batch.column(1)],
                names=["c", "n", "sketch", "blob"]).filter(ok)

    packed = source.mapInArrow(pack, f"id {kind}, blob binary")
    found = packed.join(members, "id").select("c", "blob").mapInArrow(own, "c long, n long, sketch binary, blob binary")
    return found.dropDuplicates(["c"])


def _alike(pairs: DataFrame, texts: DataFrame) -> DataFrame:
    """The (a, b) of ``pairs`` whose sizes and sketches do not rule a link out."""
    side = lambda x: texts.select(F.col("c").alias(x), F.col("n").alias(f"n_{x}"), F.col("sketch").alias(f"s_{x}"))

    def run(batches):
        for batch in batches:
            ok = pa.array([estimate(_values(x), _values(y)) >= PERCENT / 100 - SLACK
                           for x, y in zip(batch.column(2).to_pylist(), batch.column(3).to_pylist())], pa.bool_())
            yield pa.RecordBatch.from_arrays([batch.column(0).filter(ok), batch.column(1).filter(ok)], names=["a", "b"])

    sized = (pairs.join(side("a"), "a").join(side("b"), "b")
             .where(100 * F.least("n_a", "n_b") >= PERCENT * F.greatest("n_a", "n_b")))
    return sized.select("a", "b", "s_a", "s_b").mapInArrow(run, "a long, b long")


def _confirmed(pairs: DataFrame, texts: DataFrame) -> DataFrame:
    """The (a, b) of ``pairs`` that are linked: first by sketch, so that few texts move, then the full sets."""
    side = lambda x: texts.select(F.col("c").alias(x), F.col("blob").alias(f"blob_{x}"))

    def run(batches):
        unpack = zstandard.ZstdDecompressor().decompress
        kept: dict[bytes, np.ndarray] = {}

        def full(blob):
            if blob not in kept:
                if len(kept) >= 2000:
                    kept.clear()
                kept[blob] = shingle_set(unpack(blob).decode())
            return kept[blob]

        for batch in batches:
            ok = pa.array([linked(full(x), full(y)) for x, y in zip(batch.column(2).to_pylist(), batch.column(3).to_pylist())],
                          pa.bool_())
            yield pa.RecordBatch.from_arrays([batch.column(0).filter(ok), batch.column(1).filter(ok)], names=["a", "b"])

    near = written(_alike(pairs, texts))
    joined = near.join(side("a"), "a").join(side("b"), "b").select("a", "b", "blob_a", "blob_b")
    return joined.mapInArrow(run, "a long, b long")


def components(edges: DataFrame) -> DataFrame:
    """(v, component): the smallest vertex that each vertex of ``edges`` (a, b) can reach. Labels
    spread along edges and then jump to the label of their label, until none changes: about
    log(diameter) rounds. Edges and labels stay distributed; each round is one written table,
    whose known size lets Catalyst choose the joins of the next one."""
    both = written(edges.select(F.col("a").alias("v"), F.col("b").alias("w"))
                   .union(edges.select("b", "a")).distinct())
    labels = written(both.groupBy("v").agg(F.min("w").alias("w"))
                     .select("v", F.least("w", "v").alias("component")))
    while True:
        near = (both.join(labels.select(F.col("v").alias("w"), "component"), "w")
                .groupBy("v").agg(F.min("component").alias("near")))
        spread = labels.join(near, "v").select("v", F.col("component").alias("old"),
                                               F.least("component", "near").alias("mid"))
        jump = labels.select(F.col("v").alias("mid"), F.col("component").alias("far"))
        moved = written(spread.join(jump, "mid").select("v", "old", F.least("mid", "far").alias("component")))
        labels = moved.select("v", "component")
        if moved.where("old != component").isEmpty():
            return labels


def merged(label: DataFrame, edges: DataFrame) -> DataFrame:
    """The labels (v, component) of a graph after the written ``edges`` (a, b) are added: the components
    of the graph whose vertices are the old components. Without edges nothing is computed."""
    if edges.isEmpty():
        return label
    root = components(_of(edges, label).select(F.col("of_a").alias("a"), F.col("of_b").alias("b")))
    root = root.select(F.col("v").alias("component"), F.col("component").alias("root"))
    moved = label.join(root, "component", "left").select("v", F.coalesce("root", "component").alias("component"))
    # Vertices that had no edge before are their own old component.
    new = root.join(label.select(F.col("v").alias("component")), "component", "left_anti")
    return written(moved.union(new))


def _of(pairs: DataFrame, label: DataFrame) -> DataFrame:
    """``pairs`` (a, b) with the components of_a and of_b of their ends."""
    of = lambda x: label.select(F.col("v").alias(x), F.col("component").alias(f"_{x}"))
    return (pairs.join(of("a"), "a", "left").join(of("b"), "b", "left")
            .select("a", "b", F.coalesce("_a", "a").alias("of_a"), F.coalesce("_b", "b").alias("of_b")))


def _apart(pairs: DataFrame, label: DataFrame) -> DataFrame:
    """The pairs (a, b) whose ends are not in one component yet."""
    return _of(pairs, label).where("of_a != of_b").select("a", "b")


def shared_counts(a: list[np.ndarray], b: list[np.ndarray], chunk: int = 1024) -> np.ndarray:
    """Matrix of the number of values that each array of ``a`` shares with each of ``b``, by
    products of 0/1 matrices over the values both sides have, ``chunk`` values at a time."""
    va, vb = np.concatenate(a), np.concatenate(b)
    ra, rb = np.repeat(np.arange(len(a)), [len(x) for x in a]), np.repeat(np.arange(len(b)), [len(x) for x in b])
    common = np.intersect1d(va, vb)
    ia, ib = np.searchsorted(common, va), np.searchsorted(common, vb)
    out = np.zeros((len(a), len(b)), np.float32)
    if not len(common):
        return out
    oka = common[np.minimum(ia, len(common) - 1)] == va
    okb = common[np.minimum(ib, len(common) - 1)] == vb
    ia, ra, ib, rb = ia[oka], ra[oka], ib[okb], rb[okb]
    for lo in range(0, len(common), chunk):
        x, y = np.zeros((len(a), chunk), np.float32), np.zeros((len(b), chunk), np.float32)
        m = (ia >= lo) & (ia < lo + chunk)
        x[ra[m], ia[m] - lo] = 1
        m = (ib >= lo) & (ib < lo + chunk)
        y[rb[m], ib[m] - lo] = 1
        out += x @ y.T
    return out


def _groups(batches):
    """(key, i, j) and its rows, one group after another, from a partition sorted by them."""
    now, rows = None, []
    for batch in batches:
        for row in zip(*[c.to_pylist() for c in batch.columns]):
            if row[:3] != now:
                if rows:
                    yield now, rows
                now, rows = row[:3], []
            rows.append(row[3:])
    if rows:
        yield now, rows


def _pairs(key: int, i: int, j: int, rows: list[tuple], sketches: list[np.ndarray]):
    """Index pairs of the rows (at, c, component, n, ...) of one group that are still to be
    confirmed: in different components, alike in size, alike by the union-sketch estimate,
    and with this list as the smallest that they share. STRIP rows at a time meet all others."""
    first = [k for k, r in enumerate(rows) if r[0] == i]
    second = first if i == j else [k for k, r in enumerate(rows) if r[0] == j]
    own = np.array([key]).view(np.uint64)[0]
    part = lambda of, k: np.array([rows[x][k] for x in of], np.int64)
    smaller: dict[int, np.ndarray] = {}  # the smaller lists of the rows that come so far

    def below(of):
        for x in of:
            if x not in smaller:
                keys = sketch_keys(sketches[x])
                smaller[x] = keys[keys < own]
        return [smaller[x] for x in of]

    n2, c2, s2 = part(second, 3), part(second, 2), [sketches[x] for x in second]
    for lo in range(0, len(first) if second else 0, STRIP):
        strip = first[lo:lo + STRIP]
        n1 = part(strip, 3)[:, None]
        able = (part(strip, 2)[:, None] != c2) & (100 * np.minimum(n1, n2) >= PERCENT * np.maximum(n1, n2))
        if i == j:
            able &= np.arange(lo, lo + len(strip))[:, None] > np.arange(len(second))
        if not able.any():
            continue
        s1 = [sketches[x] for x in strip]
        # The estimate is at most the number of retained values shared over the sketch's size.
        able &= shared_counts(s1, s2) >= (PERCENT / 100 - SLACK) * np.minimum(SKETCH, np.maximum(n1, n2))
        if not able.any():
            continue
        at, to = np.flatnonzero(able.any(1)), np.flatnonzero(able.any(0))
        able[np.ix_(at, to)] &= shared_counts(below([strip[x] for x in at]), below([second[y] for y in to])) == 0
        for x, y in zip(*np.nonzero(able)):
            if estimate(s1[x], s2[y]) >= PERCENT / 100 - SLACK:
                yield strip[x], second[y]


def _placed(member: DataFrame) -> DataFrame:
    """(key, i, j, at, c, component): the groups in which the members (key, c, component) of lists of several components
    meet. A list of up to BLOCK members is one group (0, 0). A longer one is cut into blocks, by hash: first those of the
    members outside its largest component, then those of that component. Two blocks meet in one group, but for two
    of the largest component, whose pairs have their answer. So one large component is not copied for every block of its
    own, however long the list."""
    counts = member.groupBy("key", "component").agg(F.count(F.lit(1)).alias("n"))
    mixed = (counts.groupBy("key").agg(F.max(F.struct("n", "component")).alias("most"), F.sum("n").alias("m"))
             .where("m > most.n").select("key", "m", F.col("most.component").alias("big"),
                                         F.when(F.col("m") > BLOCK, F.col("most.n")).otherwise(0).alias("n_big")))
    blocks = lambda n: F.ceil(n / BLOCK).cast("int")
    rows = (member.join(mixed, "key").withColumn("is_big", (F.col("component") == F.col("big")) & (F.col("n_big") > 0))
            .withColumn("small", blocks(F.col("m") - F.col("n_big"))).withColumn("large", blocks(F.col("n_big"))))
    at = F.pmod(F.xxhash64("c", "key"), F.when(F.col("is_big"), F.col("large")).otherwise(F.col("small"))).cast("int")
    return (rows.withColumn("at", at + F.when(F.col("is_big"), F.col("small")).otherwise(0))
            .withColumn("other", F.explode(F.sequence(F.lit(0), F.col("small") + F.when(F.col("is_big"), 0).otherwise(F.col("large")) - 1)))
            .select("key", F.least("at", "other").alias("i"), F.greatest("at", "other").alias("j"), "at", "c", "component"))


def _residual(lists: DataFrame, label: DataFrame, texts: DataFrame) -> DataFrame:
    """Links between classes of different components that share a list."""
    spread = _placed(lists.join(label, F.col("c") == F.col("v"), "left").select(
        "key", "c", F.coalesce("component", "c").alias("component")))

    def wanted(batches):
        """The classes of each group that have a pair to confirm in full."""
        for (key, i, j), rows in _groups(batches):
            need = sorted({x for p in _pairs(key, i, j, rows, [_values(r[4]) for r in rows]) for x in p})
            if need:
                yield pa.RecordBatch.from_arrays([
                    pa.array([key] * len(need), pa.int64()), pa.array([i] * len(need), pa.int32()),
                    pa.array([j] * len(need), pa.int32()), pa.array([rows[x][0] for x in need], pa.int32()),
                    pa.array([rows[x][1] for x in need], pa.int64()), pa.array([rows[x][2] for x in need], pa.int64())],
                    names=["key", "i", "j", "at", "c", "component"])

    def confirm(batches):
        unpack = zstandard.ZstdDecompressor().decompress
        for (key, i, j), rows in _groups(batches):
            full = [shingle_set(unpack(r[4]).decode()) for r in rows]
            found, joined = [], {r[2]: r[2] for r in rows}  # component -> one that it is linked with here

            def root(x):
                while joined[x] != x:
                    x = joined[x]
                return x

            for x, y in _pairs(key, i, j, rows, [f[:SKETCH] for f in full]):
                p, q = root(rows[x][2]), root(rows[y][2])
                if p != q and linked(full[x], full[y]):
                    joined[p] = q
                    found.append((rows[x][1], rows[y][1]))
            if found:
                yield pa.RecordBatch.from_arrays([pa.array([x for x, _ in found], pa.int64()),
                                                  pa.array([y for _, y in found], pa.int64())], names=["a", "b"])

    kinds = "key long, i int, j int, at int, c long, component long"
    # A class meets its sketch or text once and takes it to all of its groups then.
    grouped = lambda df, last: (df.groupBy("c", "component").agg(F.collect_list(F.struct("key", "i", "j", "at")).alias("places"))
                                .join(texts.select("c", "n", last), "c")
                                .select(F.inline("places"), "c", "component", "n", last)
                                .repartition("key", "i", "j").sortWithinPartitions("key", "i", "j"))
    need = written(grouped(spread, "sketch").mapInArrow(wanted, kinds))
    return grouped(need, "blob").mapInArrow(confirm, "a long, b long")


def near_duplicates(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(doc_id, n_shingles, component_id, kept) of every row. ``component_id``: the smallest id
    reachable over links (the row's own included); ``kept``: it is the row's own id."""
    ship(docs.sparkSession)
    source = pick(docs, doc_id=id_col, text=text_col)
    rows = written(_features(source))
    # The rows of a class are never gathered, only counted in: their smallest id is its own.
    classes = written(rows.where("n > 0").groupBy("digest", "c")
                      .agg(F.min("doc_id").alias("id"), F.first("sketch").alias("sketch")))
    starred = written(_shared(_lists(classes)))
    texts = written(_texts(source, starred.select("c", "id").distinct()))
    pair = [F.least("c", "h").alias("a"), F.greatest("c", "h").alias("b")]
    stars = starred.select("c", F.col("h1").alias("h")).where("c != h").select(*pair).distinct()
    label = components(written(_confirmed(stars, texts)))
    stars = starred.select("c", F.explode(F.array("h2", "h3")).alias("h")).where("c != h").select(*pair).distinct()
    label = merged(label, written(_confirmed(_apart(stars, label), texts)))
    others = starred.where("c not in (h1, h2, h3)").select("key", "c")
    label = merged(label, written(_residual(others, label, texts)))
    ids = (classes.select("digest", "c", "id").join(label, F.col("c") == F.col("v"), "left")
           .select("digest", "id", F.coalesce("component", "c").alias("component")))
    least = ids.groupBy("component").agg(F.min("id").alias("component_id"))
    out = rows.select("doc_id", "n", "digest").join(
        ids.join(least, "component").select("digest", "component_id"), "digest", "left")
    component = F.when(F.col("n") > 0, F.col("component_id")).otherwise(F.col("doc_id"))
    return out.select("doc_id", F.col("n").alias("n_shingles"), component.alias("component_id"),
                      (F.col("doc_id") == component).alias("kept"))


def keep_one(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """The rows of ``docs`` that are kept, one document (its smallest id) of each component;
    rows without an id stay. All columns as they were."""
    gone = near_duplicates(docs, id_col, text_col).where("not kept").select(F.col("doc_id").alias("_gone")).distinct()
    return docs.join(gone, docs[id_col] == F.col("_gone"), "left_anti")
