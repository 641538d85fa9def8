"""Byte-level BPE by a rank file, texts taken in overlapping chunks.

A text of up to CHUNK bytes is one chunk. A longer one is cut into chunks that become rows of
their own, so that the chunks of one text are spread over tasks:

1. Chunks begin at every CHUNK-th byte (moved on to where a character begins). A chunk
   reaches OVERLAP bytes and more into the next: as far as a letter or digit of plain ASCII
   that a blank or line end follows, or else to the end of the text. Every split has a
   boundary there, so that a chunk and the next must agree on one.
2. Every chunk is pre-tokenised by itself. Where it breaks into words depends on where it
   began, and its last words on where it was cut: words that could change with more text
   (PATTERN looks three characters ahead at most) do not count.
3. Stitching: the first boundary that two neighbours share in their overlap is the cut between
   them. The pattern never looks back, so from there on both see the same words; the
   first chunk begins with the text, so all its boundaries hold, and by the cuts so do those
   of all others. The cut of a chunk is never before that of the chunk to its left.
4. The words between two cuts are encoded, each by itself, by the tiktoken library; distinct
   words of a batch once. The ids of a text's pieces, in order, are its ids.

Decoding gathers the bytes of all ids, one after another.

Null and empty texts have no ids. A text of any length passes; a task holds one text's ids at a
time. Rows that repeat an id or a whole row are encoded each by itself; other columns are not
read; an empty table gives no rows.
"""

from __future__ import annotations

import base64
import re

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from kiln.llm.common import pick, ranges, ship, written
from kiln.llm.word_ids import IdPool, Labels, binary_rows, pretoken_bounds, slices, text_bytes

#: Bytes of a chunk, and of the next that it covers at least.
CHUNK = 1 << 16
OVERLAP = 1 << 8
#: Bytes encoded at once, and words a task remembers.
SLICE = 4 << 20
WORDS = 500_000

#: A place where every split has a boundary: after the first byte of it.
_AGREED = re.compile(rb"[A-Za-z0-9][ \n]")
#: Bytes after the end of a word that the pattern may look at: three characters.
_AHEAD = 12


class Ranks:
    """Encoder and decoder of one rank file's content."""

    def __init__(self, content: bytes, pattern: str):
        import tiktoken
        ranks = {base64.b64decode(token): int(rank) for token, rank in map(bytes.split, content.splitlines())}
        core = tiktoken.Encoding("ranks", pat_str=pattern, mergeable_ranks=ranks, special_tokens={})._core_bpe
        self.pool = IdPool(lambda words: [core.encode_single_piece(w) for w in words], WORDS)
        label = [b""] * (max(ranks.values(), default=-1) + 1)
        for token, rank in ranks.items():
            label[rank] = token
        self.labels = Labels(label)


_RANKS: dict[tuple, Ranks] = {}


def _of(content: bytes, pattern: str) -> Ranks:
    key = (content, pattern)
    if key not in _RANKS:
        _RANKS.clear()
        _RANKS[key] = Ranks(content, pattern)
    return _RANKS[key]


def _next_start(data: bytes, at: int) -> int:
    while at < len(data) and data[at] & 0xC0 == 0x80:
        at += 1
    return at


def chunks(data: bytes, size: int = CHUNK, overlap: int = OVERLAP) -> list[tuple[int, int]]:
    """(from, to) of the overlapping chunks of a text, in bytes."""
    out, at = [], 0
    while True:
        nxt = _next_start(data, at + size)
        if nxt >= len(data):
            return out + [(at, len(data))]
        agreed = _AGREED.search(data, nxt + overlap)
        end = min(agreed.end() + _AHEAD, len(data)) if agreed else len(data)
        out.append((at, _next_start(data, end)))
        at = nxt


def boundaries(data: bytes, whole: bool) -> np.ndarray:
    """Where the words of a chunk begin and end; without those that more text could move, unless the
    chunk ends with the text (``whole``)."""
    at = pretoken_bounds(np.frombuffer(data, np.uint8), np.array([0, len(data)]))
    if whole:
        return at
    # A word that begins and ends this far before the end has seen all that it may look at.
    return at[:max(1, int(np.searchsorted(at, len(data) - _AHEAD, "right")))]


def _encode(ranks: Ranks, data: np.ndarray, begins: np.ndarray, bounds: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Ids of the words that begin at ``begins``, and where the texts' ids meet (``bounds``: the texts)."""
    ids, ends = ranks.pool.ids(slices(data, begins))
    return ids, ends[np.searchsorted(begins, bounds)]


def _short(rows: DataFrame, content, pattern: str, kind: str) -> DataFrame:
    def run(batches):
        ranks = _of(content.value, pattern)
        for batch in batches:
            _, at = text_bytes(batch.column(1))
            for lo, hi in ranges(np.diff(at), SLICE):
                part = batch.slice(lo, hi - lo)
                data, bounds = text_bytes(part.column(1))
                ids, ends = _encode(ranks, data, pretoken_bounds(data, bounds), bounds)
                decoded, meet = ranks.labels.decode(ids)
                yield pa.RecordBatch.from_arrays(
                    [part.column(0), binary_rows(ids, ends), binary_rows(decoded, meet[ends])],
                    names=["doc_id", "ids", "decoded"])

    return rows.mapInArrow(run, f"doc_id {kind}, ids binary, decoded binary")


def _long(rows: DataFrame, content, pattern: str, kind: str, size: int, overlap: int) -> DataFrame:
    def cut(batches):
        for batch in batches:
            for doc, text, row in zip(*[c.to_pylist() for c in batch.columns]):
                data = text.encode()
                spans = chunks(data, size, overlap)
                for lo in range(0, len(spans), 64):
                    part = spans[lo:lo + 64]
                    n = len(part)
                    yield pa.RecordBatch.from_arrays([
                        pa.array([row] * n, pa.int64()), pa.array([doc] * n, batch.schema.field(0).type),
                        pa.array(range(lo, lo + n), pa.int32()), pa.array([a for a, _ in part], pa.int64()),
                        pa.array([b == len(data) for _, b in part], pa.bool_()),
                        pa.array([data[a:b] for a, b in part], pa.binary())],
                        names=["row", "doc_id", "k", "at", "whole", "data"])

    def split(batches):
        """With each chunk the places of its words, and those in the overlap with either neighbour."""
        for batch in batches:
            at, whole = batch.column("at").to_pylist(), batch.column("whole").to_pylist()
            found = [boundaries(d, w) for d, w in zip(batch.column("data").to_pylist(), whole)]
            # The overlap with the chunk before begins where this chunk does; how far it reaches
            # that chunk knows. The overlap with the next begins where that one does: size bytes on, at least.
            head = pa.array([(a + f).tolist() for a, f in zip(at, found)], pa.list_(pa.int64()))
            tail = pa.array([(a + f[f >= size]).tolist() for a, f in zip(at, found)], pa.list_(pa.int64()))
            yield pa.RecordBatch.from_arrays([*batch.columns, head, tail], names=[*batch.schema.names, "head", "tail"])

    fields = f"row long, doc_id {kind}, k int, at long, whole boolean, data binary"
    # The row numbers are given once, with the write, and read from there.
    parts = written(rows.withColumn("row", F.monotonically_increasing_id()).mapInArrow(cut, fields)
                    .repartition("row", "k"))
    parts = written(parts.mapInArrow(split, f"{fields}, head array<long>, tail array<long>"))
    in_text = Window.partitionBy("row").orderBy("k")
    agreed = (parts.select("row", "k", (F.col("at") + F.octet_length("data")).alias("end"), "whole", "head", "tail")
              .withColumn("shared", F.array_min(F.array_intersect("tail", F.lead("head").over(in_text))))
              .withColumn("cut", F.coalesce("shared", F.when(F.col("whole"), F.col("end")),
                                            F.raise_error(F.lit("chunks that share no boundary")).cast("long"))))
    cuts = agreed.select("row", "k", F.max("cut").over(in_text.rowsBetween(Window.unboundedPreceding, 0)).alias("upto"))
    cuts = cuts.withColumn("since", F.coalesce(F.lag("upto").over(in_text), F.lit(0)))
    pieces = parts.select("row", "doc_id", "k", "at", "data", "head").join(cuts, ["row", "k"])

    def encode(batches):
        ranks = _of(content.value, pattern)
        for batch in batches:
            out = []
            for at, data, head, since, upto in zip(*[batch.column(c).to_pylist() for c in ("at", "data", "head", "since", "upto")]):
                places = np.array(head, np.int64)
                places = places[(places >= since) & (places <= upto)] - at
                ids = ranks.pool.ids(slices(np.frombuffer(data, np.uint8), places))[0] if len(places) > 1 else places[:0]
                out.append(ids.astype("<u4").tobytes())
            yield pa.RecordBatch.from_arrays([batch.column("row"), batch.column("doc_id"), batch.column("k"),
                                              pa.array(out, pa.binary())], names=["row", "doc_id", "k", "ids"])

    def joined(batches):
        """One text after another: its ids, and the bytes that they stand for."""
        labels = _of(content.value, pattern).labels
        now, doc, held, type_ = None, None, [], None

        def row():
            ids = np.frombuffer(b"".join(held), "<u4")
            return pa.RecordBatch.from_arrays(
                [pa.array([doc], type_), pa.array([ids.tobytes()], pa.binary()),
                 pa.array([labels.decode(ids)[0].tobytes()], pa.binary())], names=["doc_id", "ids", "decoded"])

        for batch in batches:
            type_ = batch.schema.field("doc_id").type
            for number, d, ids in zip(*[batch.column(c).to_pylist() for c in ("row", "doc_id", "ids")]):
                if held and number != now:
                    yield row()
                    held = []
                now, doc = number, d
                held.append(ids)
        if held:
            yield row()

    ids = pieces.mapInArrow(encode, f"row long, doc_id {kind}, k int, ids binary")
    return (ids.repartition("row").sortWithinPartitions("row", "k")
            .mapInArrow(joined, f"doc_id {kind}, ids binary, decoded binary"))


def encode_decode(docs: DataFrame, rank_file: str, pattern: str, id_col: str = "doc_id", text_col: str = "text",
                  chunk: int = CHUNK, overlap: int = OVERLAP) -> DataFrame:
    """(doc_id, ids, decoded) of every row: ids as little-endian unsigned 32-bit integers, and the
    bytes that they decode to.

    ``rank_file``: path of a file of base64 tokens and ranks; the driver reads it, and its content (a fixed
    size, about 1 MB) goes to the executors. ``pattern``: the splitting pattern that belongs to it;
    only the published byte-level one is known here. ``chunk``, ``overlap``: bytes."""
    _check(pattern)
    spark = docs.sparkSession
    ship(spark)
    with open(rank_file, "rb") as f:
        content = spark.sparkContext.broadcast(f.read())
    rows = pick(docs, doc_id=id_col, text=text_col)
    kind = rows.schema["doc_id"].dataType.simpleString()
    is_long = F.coalesce(F.octet_length("text") > chunk, F.lit(False))
    return _short(rows.where(~is_long), content, pattern, kind).unionByName(
        _long(rows.where(is_long), content, pattern, kind, chunk, overlap))


#: The splitting pattern that ``pretoken_bounds`` stands for, a fixed value.
KNOWN = r"""'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"""


def _check(pattern: str) -> None:
    if pattern != KNOWN:
        raise ValueError("another splitting pattern than the published byte-level one")
