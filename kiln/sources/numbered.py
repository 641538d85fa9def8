"""Text lines with their place: file, line number, byte offset, and number over all files.

A table has no order, a file has. Spark reads a file in splits; the lines of a split come in the
file's order, and the source names the split that a line came from (file and first byte).
So a line's place is known without sorting anything:

1. One pass counts the lines and bytes of every split: a partial aggregate, one row for a split.
2. A prefix sum over the splits of a file, and over the files by name, says what comes before each.
3. The lines are read again; the place of a line is what comes before its split, plus its own
   position in it. The split rows, counted to be MAX_SPLITS at most, are broadcast (beyond
   that Catalyst picks the join); the lines themselves are neither shuffled nor sorted.

Both passes plan the same splits, as these depend on the files and the session alone. Lines
end at ``\\n``; a ``\\r`` before it is taken off, but counts as a byte. An empty file has no lines.
Compressed files are one split, their offsets those of the plain text.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from kiln.session import reliable_checkpoint

# monotonically_increasing_id keeps the record position in its lower 33 bits.
_POSITION_MASK = (1 << 33) - 1

#: Split rows (file name, numbers) broadcast to the lines, at most.
MAX_SPLITS = 200_000


def _split_lines(spark: SparkSession, path) -> DataFrame:
    """(value, file, split): the lines as the source gives them, with the split they came from."""
    lines = spark.read.option("lineSep", "\n").text(path)
    return lines.select("value", F.col("_metadata.file_path").alias("file"),
                        F.col("_metadata.file_block_start").alias("split"))


def _before(splits: DataFrame) -> DataFrame:
    """Per split: lines and bytes before it in its file, lines before its file, first position in its task."""
    in_file = Window.partitionBy("file").orderBy("split").rowsBetween(Window.unboundedPreceding, -1)
    files = splits.groupBy("file").agg(F.sum("lines").alias("of_file"))
    # One row for a file: a window without partitions is fine at this size.
    all_files = Window.orderBy("file").rowsBetween(Window.unboundedPreceding, -1)
    files = files.select("file", F.coalesce(F.sum("of_file").over(all_files), F.lit(0)).alias("files_before"))
    zero = lambda c: F.coalesce(F.sum(c).over(in_file), F.lit(0))
    return (splits.select("file", "split", "first", zero("lines").alias("lines_before"), zero("bytes").alias("bytes_before"))
            .join(files, "file"))


def _position() -> Column:
    return F.monotonically_increasing_id().bitwiseAND(F.lit(_POSITION_MASK))


def read_numbered_lines(spark: SparkSession, path, encoding: str = "UTF-8", byte_offset: bool = False) -> DataFrame:
    """(file, line, row, value): every line with its file, its 1-based number there and over all files (in
    the order of their names). ``byte_offset`` adds ``offset``, the line's first byte in its file; the
    lines then pass Arrow tasks that add up lengths. ``value`` is decoded with ``encoding``."""
    lines = _split_lines(spark, path)
    size = F.octet_length("value") + F.lit(1)
    counted = lines.withColumn("at", _position()).groupBy("file", "split").agg(
        F.count(F.lit(1)).alias("lines"), F.sum(size).alias("bytes"), F.min("at").alias("first"))
    # One row for a split, computed once; a million of them would be 128 TB of text in whole splits.
    counted = reliable_checkpoint(counted)
    before = _before(counted)
    if counted.count() <= MAX_SPLITS:
        before = F.broadcast(before)
    placed = lines.withColumn("at", _position())
    if byte_offset:
        placed = placed.mapInArrow(_offsets, "value string, file string, split long, at long, within long")
    line = F.col("lines_before") + F.col("at") - F.col("first") + F.lit(1)
    text = F.col("value") if encoding.upper() in ("UTF-8", "UTF8") else F.decode(F.col("value").cast("binary"), encoding)
    value = F.when(text.endswith("\r"), F.substring(text, F.lit(1), F.char_length(text) - 1)).otherwise(text)
    return placed.join(before, ["file", "split"]).select(
        "file", line.alias("line"), (F.col("files_before") + line).alias("row"),
        *([(F.col("bytes_before") + F.col("within")).alias("offset")] if byte_offset else []),
        value.alias("value"))


def _offsets(batches):
    """Bytes before each line in its split, from the lines' lengths."""
    now, total = None, 0
    for batch in batches:
        size = pc.binary_length(batch.column(0).cast(pa.binary())).to_numpy(zero_copy_only=False).astype(np.int64) + 1
        ends = np.cumsum(size)
        file, split = batch.column(1).dictionary_encode(), batch.column(2).to_numpy()
        code = file.indices.to_numpy()
        names = file.dictionary.to_pylist()
        new = np.flatnonzero(np.concatenate([[True], (code[1:] != code[:-1]) | (split[1:] != split[:-1])])[:len(split)])
        base = np.zeros(len(split), np.int64)
        for lo, hi in zip(new, np.append(new[1:], len(split))):
            key = (names[code[lo]], int(split[lo]))
            start = total if key == now else 0
            base[lo:hi] = start - (ends[lo] - size[lo])
            now, total = key, start + int(ends[hi - 1] - (ends[lo] - size[lo]))
        yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(base + ends - size)],
                                         names=[*batch.schema.names, "within"])


def first_lines(spark: SparkSession, path, n: int, encoding: str = "UTF-8") -> DataFrame:
    """The first ``n`` lines over all files, in order of file name and line."""
    return read_numbered_lines(spark, path, encoding).where(F.col("row") <= F.lit(n))


def read_numbered(spark: SparkSession, path, schema: str, sep: str, encoding: str = "UTF-8") -> DataFrame:
    """Fields of literally split lines by ``schema`` (``"id INT, name STRING"``: the first fields; a value that
    does not parse is NULL), with ``row``, the line's number over all files. Blank lines are left out."""
    from pyspark.sql.types import StructType
    lines = read_numbered_lines(spark, path, encoding).where(F.col("value") != "")
    fields = F.split(F.col("value"), F.lit(_literal(sep)))
    types = StructType.fromDDL(schema)
    return lines.select("row", *[F.get(fields, i).try_cast(f.dataType).alias(f.name) for i, f in enumerate(types)])


def _literal(sep: str) -> str:
    return "".join(c if c.isalnum() or c in " \t" else "\\" + c for c in sep)
