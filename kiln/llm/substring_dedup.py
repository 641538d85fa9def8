"""Removal of passages that occur elsewhere, by difference-cover anchors.

A window is WINDOW consecutive words of one document. COVER is a difference cover modulo
PERIOD: for any two offsets some shift below PERIOD takes both to places in COVER. If only
the ANCHOR-word sequences at places in COVER (modulo PERIOD) are hashed, two equal windows,
wherever they lie, share an anchor at the same distance from their starts, since
ANCHOR + PERIOD - 1 <= WINDOW. So a quarter of the places need hashing.

1. Documents with the same words form a class; one text of it stands for all. If it has
   several documents, all its windows occur elsewhere.
2. Anchors: equal hashes meet by a shuffle on the hash, sorted and read as a stream.
3. Extension: around every anchor that occurs twice, the windows that contain it are hashed
   whole (96 bits) and meet in the same way. A window is repeated if its hash occurs twice.
4. The words that repeated windows cover are removed.

Hashes that occur twice within one batch of a task are known to be repeated there: one row
carries the hash on, the others are dealt out at random. A passage that a third of all
documents hold thus sends one row per batch to its partition, and no group is gathered.

Null and empty texts have no words. Rows that repeat a doc_id are separate documents, so
that their windows occur elsewhere. Windows are judged on the input. Other columns are not read.
"""

from __future__ import annotations

import hashlib

import numpy as np
import pandas as pd
import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from kiln.llm.common import mix, pick, ranges, ship

WINDOW = 35
ANCHOR = 15
PERIOD = 21
COVER = (0, 1, 4, 14, 16)

#: Bytes of text handled at once in a task.
CHUNK = 8 << 20

_A, _B = np.uint64(0xD1342543DE82EF95), np.uint64(0xAF251AF3B0F025B5)


def sequence_hash(words: np.ndarray, at: np.ndarray, n: int, base: np.uint64) -> np.ndarray:
    """Hash of the n words from each place of ``at`` on."""
    h = np.zeros(len(at), np.uint64)
    for i in range(n):
        h = h * base + words[at + i]
    return mix(h)


class _Texts:
    """The words of several documents, one after another."""

    def __init__(self, blobs: list[bytes]):
        unpack = zstandard.ZstdDecompressor().decompress
        self.words = [unpack(b).split() for b in blobs]
        self.n = np.array([len(w) for w in self.words], np.int64)
        self.start = np.concatenate([[0], np.cumsum(self.n)[:-1]])
        flat = np.array([x for w in self.words for x in w], dtype=object)
        self.hashes = pd.util.hash_array(flat, categorize=False) if len(flat) else np.zeros(0, np.uint64)


def _routed(h: np.ndarray, check: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(route, known): where each hash goes. Of equal ones the first goes by the hash, the others
    anywhere; known: it occurs more than once here."""
    order = np.lexsort((check, h))
    hs, cs = h[order], check[order]
    same = np.zeros(len(h), bool)  # equal to the one before
    same[1:] = (hs[1:] == hs[:-1]) & (cs[1:] == cs[:-1])
    known = same.copy()
    known[:-1] |= same[1:]
    route = hs.copy()
    route[same] = mix(hs[same] + np.arange(1, same.sum() + 1, dtype=np.uint64) * _A)
    out, flag = np.empty_like(h), np.empty(len(h), bool)
    out[order], flag[order] = route, known
    return out, flag


def _met(df: DataFrame) -> DataFrame:
    """(c, pos) of the rows (route, check, c, pos, known) that are known or have an equal in (route, check)."""
    def run(batches):
        last = None  # the row before, and whether it is out already
        for batch in batches:
            route, check = batch.column(0).to_numpy(), batch.column(1).to_numpy()
            c, pos = batch.column(2).to_numpy(), batch.column(3).to_numpy()
            hit = batch.column(4).to_numpy(zero_copy_only=False).copy()
            if not len(route):
                continue
            same = (route[1:] == route[:-1]) & (check[1:] == check[:-1])
            hit[1:] |= same
            hit[:-1] |= same
            if last is not None and last[:2] == (route[0], check[0]):
                hit[0] = True
                if not last[4]:
                    yield pa.RecordBatch.from_arrays([pa.array([last[2]], pa.int64()), pa.array([last[3]], pa.int32())],
                                                     names=["c", "pos"])
            yield pa.RecordBatch.from_arrays([pa.array(c[hit]), pa.array(pos[hit])], names=["c", "pos"])
            last = (route[-1], check[-1], c[-1], pos[-1], bool(hit[-1]))

    sorted_rows = df.repartition("route").sortWithinPartitions("route", "check")
    return sorted_rows.mapInArrow(run, "c long, pos int")


def _hash_rows(route, check, known, c, pos):
    return pa.RecordBatch.from_arrays(
        [pa.array(route.view(np.int64)), pa.array(check), pa.array(c), pa.array(pos.astype(np.int32)), pa.array(known)],
        names=["route", "check", "c", "pos", "known"])


_HASHES = "route long, check int, c long, pos int, known boolean"


def _anchors(classes: DataFrame) -> DataFrame:
    cover = np.array(sorted(COVER), np.int64)

    def run(batches):
        for batch in batches:
            names, blobs = batch.column(0).to_numpy(), batch.column(2).to_pylist()
            for lo, hi in ranges([len(b) * 4 for b in blobs], CHUNK):
                texts = _Texts(blobs[lo:hi])
                at, of = [], []
                for k, n in enumerate(texts.n):
                    if n >= WINDOW:
                        pos = (np.arange(0, n, PERIOD)[:, None] + cover).ravel()
                        pos = pos[pos <= n - ANCHOR]
                        at.append(pos)
                        of.append(np.full(len(pos), k))
                if at:
                    at, of = np.concatenate(at), np.concatenate(of)
                    h = sequence_hash(texts.hashes, texts.start[of] + at, ANCHOR, _A)
                    check = np.zeros(len(h), np.int32)
                    route, known = _routed(h, check)
                    yield _hash_rows(route, check, known, names[lo:hi][of], at)

    return classes.select("c", "m", "blob").mapInArrow(run, _HASHES)


def _windows(classes: DataFrame, anchors: DataFrame) -> DataFrame:
    def run(batches):
        for batch in batches:
            names, blobs, hits = batch.column(0).to_numpy(), batch.column(2).to_pylist(), batch.column(3).to_pylist()
            for lo, hi in ranges([len(b) * 4 for b in blobs], CHUNK):
                texts = _Texts(blobs[lo:hi])
                at, of = [], []
                for k, n in enumerate(texts.n):
                    step = np.zeros(n + 2, np.int32)  # +1 where windows that hold an anchor begin, -1 after
                    a = np.array(hits[lo + k], np.int64)
                    np.add.at(step, np.maximum(0, a - (WINDOW - ANCHOR)), 1)
                    np.add.at(step, np.minimum(a + 1, n + 1), -1)
                    pos = np.flatnonzero(np.cumsum(step)[:max(0, n - WINDOW + 1)])
                    at.append(pos)
                    of.append(np.full(len(pos), k))
                at, of = np.concatenate(at), np.concatenate(of)
                if len(at):
                    place = texts.start[of] + at
                    h = sequence_hash(texts.hashes, place, WINDOW, _A)
                    check = (sequence_hash(texts.hashes, place, WINDOW, _B) >> np.uint64(33)).astype(np.int32)
                    route, known = _routed(h, check)
                    yield _hash_rows(route, check, known, names[lo:hi][of], at)

    places = anchors.groupBy("c").agg(F.collect_list("pos").alias("hits"))  # the places of one document
    return classes.join(places, "c").select("c", "m", "blob", "hits").mapInArrow(run, _HASHES)


def _remains(classes: DataFrame, windows: DataFrame) -> DataFrame:
    """(c, n_removed, kept) of the classes that lose words; kept: the words left, joined by a space."""
    def run(batches):
        unpack = zstandard.ZstdDecompressor().decompress
        for batch in batches:
            out = []
            for c, m, blob, starts in zip(*[x.to_pylist() for x in batch.columns]):
                if m == 1 and not starts:
                    continue
                words = unpack(blob).split()
                n = len(words)
                if n < WINDOW:
                    continue
                step = np.zeros(n + 1, np.int64)
                if m > 1:
                    step[0] = 1
                else:
                    np.add.at(step, np.array(starts), 1)
                    np.add.at(step, np.array(starts) + WINDOW, -1)
                gone = np.cumsum(step)[:n] > 0
                out.append((c, int(gone.sum()), b" ".join(w for w, g in zip(words, gone.tolist()) if not g).decode()))
            if out:
                c, removed, kept = zip(*out)
                yield pa.RecordBatch.from_arrays([pa.array(c, pa.int64()), pa.array(removed, pa.int64()),
                                                  pa.array(kept, pa.string())], names=["c", "n_removed", "kept"])

    starts = windows.groupBy("c").agg(F.collect_list("pos").alias("starts"))  # the places of one document
    return (classes.join(starts, "c", "left").select("c", "m", "blob", "starts")
            .mapInArrow(run, "c long, n_removed long, kept string"))


def _name(joined: bytes) -> int:
    return int.from_bytes(hashlib.blake2b(joined, digest_size=8).digest(), "little", signed=True)


def remove_repeats(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(doc_id, n_words, n_removed, digest, kept) of every row. ``kept``: the words left, joined by a
    space, null where none is removed; ``digest``: SHA-256 of all words joined by a space."""
    ship(docs.sparkSession)
    source = pick(docs, doc_id=id_col, text=text_col)
    kind = source.schema["doc_id"].dataType.simpleString()

    def packed(batches):
        press = zstandard.ZstdCompressor(level=3).compress
        for batch in batches:
            joined = [b" ".join((t or "").encode().split()) for t in batch.column(0).to_pylist()]
            joined = [j for j in joined if j.count(b" ") + 1 >= WINDOW]
            yield pa.RecordBatch.from_arrays([pa.array([_name(j) for j in joined], pa.int64()),
                                              pa.array([press(j) for j in joined], pa.binary())], names=["c", "blob"])

    def counted(batches):
        for batch in batches:
            words = [(t or "").encode().split() for t in batch.column(1).to_pylist()]
            joined = [b" ".join(w) for w in words]
            yield pa.RecordBatch.from_arrays([
                batch.column(0), pa.array([len(w) for w in words], pa.int64()),
                pa.array([hashlib.sha256(j).hexdigest() for j in joined], pa.string()),
                pa.array([_name(j) for j in joined], pa.int64())], names=["doc_id", "n_words", "digest", "c"])

    # The classes' texts are shuffled once: the three uses below share the exchange. (A nullable c
    # would get a filter in the one use that joins it inside, and a second exchange.)
    classes = (source.select("text").mapInArrow(packed, "c long not null, blob binary")
               .groupBy("c").agg(F.count(F.lit(1)).alias("m"), F.first("blob").alias("blob")))
    windows = _met(_windows(classes, _met(_anchors(classes))))
    remains = _remains(classes, windows)
    rows = source.mapInArrow(counted, f"doc_id {kind}, n_words long, digest string, c long")
    return rows.join(remains, "c", "left").select(
        "doc_id", "n_words", F.coalesce("n_removed", F.lit(0)).cast("long").alias("n_removed"), "digest", "kept")
