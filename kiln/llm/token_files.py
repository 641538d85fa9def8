"""Token-id files: frequency-ranked ids in a byte-aligned variable-length code.

A table of ranks gives the most frequent id rank 0. A rank is written in 1 to 4 bytes,
little-endian; how many is kept in 2 bits of a separate control byte for four ids. A file
is Parquet, so that any store Spark reaches can hold it, and each of its rows is a block:

    part, block             place of the block: files and blocks ascend with doc_id
    before                  number of ids of the file before it
    doc_ids, lengths        the block's documents and their numbers of ids
    control, data           control bytes and rank bytes of all their ids

Blocks hold whole documents, about BLOCK_IDS ids or else one document. The ranks are a small
table beside the blocks. Decoding is by table lookup in numpy: a control byte gives four
widths; their running sum gives where each rank starts.

Ids come from the tokenizers library, a white-space-separated chunk at a time: the tokenizer
splits at white space anyway, so chunks can be remembered. ``end_id`` closes each
document. Null and empty texts have the end id only. Rows are written in ascending order of
doc_id, null ids first; rows that repeat an id follow each other in the order of their ids'
bytes. Other columns are not read. An empty table gives no blocks and no ranks.
"""

from __future__ import annotations

import json
import os

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from kiln.llm.common import pick, ranges, scratch_folder, ship, written
from kiln.llm.word_ids import IdPool, slices, text_bytes, words_between

#: Ids in a block, about; and chunks a task remembers (emptied when full: a memory bound only).
BLOCK_IDS = 1 << 16
CACHE = 1_000_000
#: Words of plain letters given to the tokenizer in one text.
JOINED = 256

#: Bytes of text encoded at once.
SLICE = 8 << 20

#: control byte -> the widths of its four ids.
WIDTHS = (((np.arange(256)[:, None] >> np.array([0, 2, 4, 6])) & 3) + 1).astype(np.uint8)


def pack_ranks(ranks: np.ndarray) -> tuple[bytes, bytes]:
    """(control, data) of an array of ranks below 2^32."""
    n, widest = len(ranks), max(1, (int(ranks.max(initial=0)).bit_length() + 7) // 8)
    used = np.empty((n, widest), bool)  # which bytes of each rank are written
    used[:, 0] = True
    codes = np.zeros(-(-n // 4) * 4, np.uint8)
    for k in range(1, widest):
        used[:, k] = ranks >= 1 << 8 * k
        codes[:n] += used[:, k]
    codes = codes.reshape(-1, 4)
    control = codes[:, 0] | codes[:, 1] << 2 | codes[:, 2] << 4 | codes[:, 3] << 6
    octets = ranks.astype("<u4", copy=False).view(np.uint8).reshape(n, 4)
    return control.tobytes(), octets[:, :widest][used].tobytes()


def unpack_ranks(control: bytes, data: bytes, n: int) -> np.ndarray:
    width = WIDTHS[np.frombuffer(control, np.uint8)].ravel()[:n]
    start = np.cumsum(width, dtype=np.int64) - width
    octets = np.frombuffer(data, np.uint8)
    out = octets[start].astype(np.uint32)
    for k in range(1, int(width.max(initial=1))):
        at = np.flatnonzero(width > k)
        out[at] |= octets[start[at] + k].astype(np.uint32) << np.uint32(8 * k)
    return out


#: Bytes that separate chunks; lower-case form of each byte; punctuation but for the apostrophe, which may
#: begin a suffix; letters and digits.
_SOLID = np.ones(256, bool)
_SOLID[[9, 10, 11, 12, 13, 32]] = False
_LOWER = np.array([b + 32 if 65 <= b <= 90 else b for b in range(256)], np.uint8)
_PUNCTUATION = np.array([33 <= b < 127 and not chr(b).isalnum() and b != 39 for b in range(256)])
_PLAIN = np.array([b < 128 and chr(b).isalnum() for b in range(256)])


class ChunkEncoder:
    """Ids of texts by one vocabulary file, remembering the chunks between white space."""

    def __init__(self, spec: str):
        # One thread: Spark runs a task on each core already.
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer
        self.tokenizer = Tokenizer.from_str(spec)
        self.tokenizer.no_truncation()
        self.tokenizer.no_padding()
        self.pool = IdPool(self._new, CACHE)
        model = json.loads(spec)["model"]
        suffix = model.get("end_of_word_suffix") or None
        # Ids that end a word, where the vocabulary marks them.
        self.ends_word = np.zeros(max(model["vocab"].values(), default=0) + 1, bool)
        if suffix:
            self.ends_word[[i for token, i in model["vocab"].items() if token.endswith(suffix)]] = True

    def _new(self, chunks: list[bytes]) -> list:
        """Ids of distinct chunks. Those of plain letters are one word each for the tokenizer, so that
        many go in one text, whose ids are cut after each that ends a word."""
        out: list = [None] * len(chunks)
        letters = [k for k, c in enumerate(chunks) if c.isalpha()] if self.ends_word.any() else []
        for lo in range(0, len(letters), JOINED):
            part = letters[lo:lo + JOINED]
            ids = np.array(self._encode([b" ".join([chunks[k] for k in part])])[0], np.uint32)
            ends = np.flatnonzero(self.ends_word[np.minimum(ids, len(self.ends_word) - 1)]) + 1
            if len(ends) == len(part) and ends[-1] == len(ids):
                for k, a, b in zip(part, [0, *ends[:-1].tolist()], ends.tolist()):
                    out[k] = ids[a:b]
        rest = [k for k, ids in enumerate(out) if ids is None]
        for lo in range(0, len(rest), 4096):
            part = rest[lo:lo + 4096]
            for k, ids in zip(part, self._encode([chunks[k] for k in part])):
                out[k] = ids
        return out

    def _encode(self, texts: list[bytes]) -> list[list[int]]:
        return [e.ids for e in self.tokenizer.encode_batch_fast([t.decode() for t in texts], add_special_tokens=False)]

    def encode(self, texts: pa.Array) -> list[np.ndarray]:
        """Ids of each text. The chunks between ASCII white space are cut by numpy, numbered in Arrow,
        encoded once each, and their ids laid out by gathering."""
        data, bounds = text_bytes(texts)
        chunks, meet = _chunks(data, bounds)
        ids, ends = self.pool.ids(chunks)
        at = ends[meet]
        return [ids[a:b] for a, b in zip(at[:-1], at[1:])]


def _chunks(data: np.ndarray, bounds: np.ndarray) -> tuple[pa.Array, np.ndarray]:
    """The chunks of all texts, and where in their list the texts meet. They are cut further where the
    tokenizer does: between a letter or digit and the punctuation at a chunk's end; and in lower case,
    as the tokenizer reads them. Both only in chunks that cannot hold a special token."""
    chunks, start, text = words_between(data, bounds, _SOLID)
    n = len(chunks)
    ends = np.frombuffer(chunks.buffers()[1], np.int32)[:n + 1].astype(np.int64)
    solid = np.frombuffer(chunks.buffers()[2], np.uint8) if n else data[:0]
    special = np.flatnonzero((solid[:-1] == ord("<")) & (solid[1:] == ord("|")))
    plain = np.ones(n, bool)
    plain[np.searchsorted(ends, special, "right") - 1] = False
    # First byte of the punctuation that ends each chunk.
    other = np.maximum.accumulate(np.where(_PUNCTUATION[solid], -1, np.arange(len(solid))))
    tail = other[ends[1:] - 1] + 1
    cut = plain & (tail > ends[:-1]) & (tail < ends[1:])
    cut[cut] = _PLAIN[solid[tail[cut] - 1]]
    lower = _LOWER[solid]
    if not plain.all():
        keep = np.repeat(~plain, np.diff(ends))
        lower[keep] = solid[keep]
    begins = np.sort(np.concatenate([ends, tail[cut]]))
    # Chunks before each text, and the pieces that were cut off them.
    meet = np.searchsorted(start, bounds)
    return slices(lower, begins), meet + np.concatenate([[0], np.cumsum(cut)])[meet]


_ENCODERS: dict[str, ChunkEncoder] = {}


def _encoder(spec: str) -> ChunkEncoder:
    if spec not in _ENCODERS:
        _ENCODERS[spec] = ChunkEncoder(spec)
    return _ENCODERS[spec]


def tokenized(docs: DataFrame, vocabulary: str, end_id: int, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(doc_id, ids, wide): the ids of every row, ``end_id`` last, in 2 bytes each or, ``wide``, 4."""
    ship(docs.sparkSession)
    with open(vocabulary, encoding="utf-8") as f:
        spec = docs.sparkSession.sparkContext.broadcast(f.read())
    rows = pick(docs, doc_id=id_col, text=text_col)
    kind = rows.schema["doc_id"].dataType.simpleString()

    def run(batches):
        encoder = _encoder(spec.value)
        for batch in batches:
            sizes = pc.fill_null(pc.binary_length(batch.column(1)), 0).to_numpy()
            for lo, hi in ranges(sizes, SLICE):
                part = batch.slice(lo, hi - lo)
                texts = [np.append(x, np.uint32(end_id)) for x in encoder.encode(part.column(1))]
                wide = [bool(x.max() > 0xFFFF) for x in texts]
                ids = [x.astype("<u4" if w else "<u2").tobytes() for x, w in zip(texts, wide)]
                yield pa.RecordBatch.from_arrays([part.column(0), pa.array(ids, pa.binary()), pa.array(wide)],
                                                 names=["doc_id", "ids", "wide"])

    return rows.mapInArrow(run, f"doc_id {kind}, ids binary, wide boolean")


def _ids(data: bytes, wide: bool) -> np.ndarray:
    return np.frombuffer(data, "<u4" if wide else "<u2")


def id_counts(tokens: DataFrame) -> DataFrame:
    """(id, n): how often each id occurs; counted in each task before the shuffle."""
    def run(batches):
        total = np.zeros(0, np.int64)
        for batch in batches:
            for data, wide in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                counts = np.bincount(_ids(data, wide))
                if len(counts) > len(total):
                    counts[:len(total)] += total
                    total = counts
                else:
                    total[:len(counts)] += counts
        seen = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(seen, pa.int64()), pa.array(total[seen], pa.int64())], names=["id", "n"])

    return tokens.select("ids", "wide").mapInArrow(run, "id long, n long").groupBy("id").agg(F.sum("n").alias("n"))


def write_files(tokens: DataFrame, path: str) -> None:
    """The blocks of all rows below ``path``/blocks and the ranks in ``path``/ranks."""
    spark = tokens.sparkSession
    # The vocabulary bounds the counts (one number for each of its ids).
    by_rank = [r.id for r in id_counts(tokens).orderBy(F.desc("n"), "id").collect()]
    spark.createDataFrame(list(enumerate(by_rank)), "rank long, id long").coalesce(1).write.parquet(f"{path}/ranks")
    rank_of = np.zeros(max(by_rank, default=0) + 1, np.uint32)
    rank_of[by_rank] = np.arange(len(by_rank), dtype=np.uint32)
    ranks = spark.sparkContext.broadcast(rank_of)

    def block(part, number, before, held):
        all_ranks = np.concatenate([ranks.value[_ids(d, w)] for _, d, w in held])
        control, data = pack_ranks(all_ranks)
        lengths = [len(d) // (4 if w else 2) for _, d, w in held]
        return {"part": part, "block": number, "before": before, "doc_ids": [i for i, _, _ in held], "lengths": lengths,
                "control": control, "data": data}

    kind = tokens.schema["doc_id"].dataType
    schema = (f"part int, block int, before long, doc_ids array<{kind.simpleString()}>, lengths array<bigint>, "
              "control binary, data binary")

    def run(batches):
        part, number, before, held, size = None, 0, 0, [], 0
        for batch in batches:
            out = []
            for doc, data, wide, at in zip(*[c.to_pylist() for c in batch.columns]):
                part = at
                held.append((doc, data, wide))
                size += len(data) // (4 if wide else 2)
                if size >= BLOCK_IDS:
                    out.append(block(part, number, before, held))
                    number, before, held, size = number + 1, before + size, [], 0
            if out:
                yield from pa.Table.from_pylist(out, arrow_schema).to_batches()
        if held:
            yield from pa.Table.from_pylist([block(part, number, before, held)], arrow_schema).to_batches()

    from pyspark.sql.pandas.types import to_arrow_schema
    from pyspark.sql.types import _parse_datatype_string
    arrow_schema = to_arrow_schema(_parse_datatype_string(schema))
    in_order = tokens.repartitionByRange("doc_id", F.xxhash64("ids")).sortWithinPartitions("doc_id", "ids")
    (in_order.withColumn("part", F.spark_partition_id()).mapInArrow(run, schema)
     .write.option("compression", "none").parquet(f"{path}/blocks"))


def read_files(spark: SparkSession, path: str) -> DataFrame:
    """(doc_id, start, ids) of every document of the files: ``ids`` as little-endian unsigned 32-bit
    integers, ``start`` the number of ids of all documents before it."""
    blocks = spark.read.parquet(f"{path}/blocks")
    by_rank = np.array([r.id for r in spark.read.parquet(f"{path}/ranks").orderBy("rank").collect()], np.uint32)
    table = spark.sparkContext.broadcast(by_rank)  # bounded by the vocabulary
    # One number for each file reaches the driver and, summed, every executor.
    n = F.col("before") + F.aggregate("lengths", F.lit(0).cast("long"), lambda a, x: a + x)
    parts = blocks.groupBy("part").agg(F.max(n).alias("n")).orderBy("part").collect()
    offsets = dict(zip([p.part for p in parts], np.cumsum([0, *[p.n for p in parts]]).tolist()))
    kind = blocks.schema["doc_ids"].dataType.elementType.simpleString()

    def run(batches):
        for batch in batches:
            for row in batch.to_pylist():
                ids = table.value[unpack_ranks(row["control"], row["data"], sum(row["lengths"]))]
                ends = np.cumsum(row["lengths"])
                begins = ends - row["lengths"]
                yield pa.RecordBatch.from_arrays([
                    pa.array(row["doc_ids"], batch.schema.field("doc_ids").type.value_type),
                    pa.array(offsets[row["part"]] + row["before"] + begins, pa.int64()),
                    pa.array([ids[a:b].astype("<u4").tobytes() for a, b in zip(begins, ends)], pa.binary())],
                    names=["doc_id", "start", "ids"])

    return blocks.mapInArrow(run, f"doc_id {kind}, start long, ids binary")


def encode_files(docs: DataFrame, vocabulary: str, end_id: int, path: str | None = None,
                 id_col: str = "doc_id", text_col: str = "text") -> str:
    """Write the files of ``docs`` below ``path`` (a fresh scratch folder if none is given); its name."""
    path = path or scratch_folder(docs.sparkSession)
    write_files(written(tokenized(docs, vocabulary, end_id, id_col, text_col)), path)
    return path


def with_crc32(tokens: DataFrame) -> DataFrame:
    """``tokens`` (doc_id, start, ids) as (doc_id, start, n_tokens, ids_crc32)."""
    return tokens.select("doc_id", "start", F.expr("cast(octet_length(ids) div 4 as long)").alias("n_tokens"),
                         F.crc32("ids").alias("ids_crc32"))
