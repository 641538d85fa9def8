"""Helpers shared by the operators: input columns, shared scratch tables, word hashing."""

from __future__ import annotations

import os
import tempfile
import uuid
import zipfile

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from kiln.session import ensure_checkpoint_dir

#: ASCII white space, the separator of words in every operator of this package.
WHITE = " \t\n\x0b\x0c\r"
WHITE_RUN = r"[\x20\x09-\x0D]+"

_GOLDEN = np.uint64(0x9E3779B97F4A7C15)


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def pick(df: DataFrame, **columns: str) -> DataFrame:
    """Only the named columns, under the operator's own names: ``pick(df, doc_id="id", text="body")``.
    Any other column of ``df``, whatever its name, stays out of the operator."""
    return df.select(*[df[source].alias(name) for name, source in columns.items()])


_SHIPPED: set[str] = set()


def ship(spark: SparkSession) -> None:
    """Send this package's sources to the executors, once for each application, so that the
    Python tasks can import them wherever the driver was started."""
    sc = spark.sparkContext
    if sc.applicationId in _SHIPPED:
        return
    package = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
    archive = os.path.join(tempfile.mkdtemp(prefix="kiln-src-"), "kiln_src.zip")
    with zipfile.ZipFile(archive, "w") as z:
        for folder, _, names in os.walk(package):
            for name in sorted(names):
                if name.endswith(".py"):
                    path = os.path.join(folder, name)
                    z.write(path, os.path.join("kiln", os.path.relpath(path, package)))
    sc.addPyFile(archive)
    _SHIPPED.add(sc.applicationId)


def scratch_folder(spark: SparkSession) -> str:
    """A fresh folder below the shared folder that ``spark.checkpoint.dir`` names."""
    return f"{ensure_checkpoint_dir(spark).rstrip('/')}/kiln-llm-{uuid.uuid4().hex}"


def written(df: DataFrame, compression: str = "zstd") -> DataFrame:
    """``df`` written once as Parquet in the shared scratch folder and read back: cuts the
    lineage, and the files outlive any executor."""
    spark = df.sparkSession
    path = scratch_folder(spark)
    df.write.option("compression", compression).parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def mix(x: np.ndarray) -> np.ndarray:
    """64-bit finaliser (splitmix64 constants): spreads every input bit over the output."""
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def combine(h: np.ndarray, nxt: np.ndarray) -> np.ndarray:
    """Order-dependent hash of a sequence hash and the hash of its next element."""
    return mix(h * _GOLDEN + nxt)


def word_hashes(words: list[str]) -> np.ndarray:
    """64-bit hash of each word; the same in every process."""
    if not words:
        return np.zeros(0, np.uint64)
    return pd.util.hash_array(np.array(words, dtype=object), categorize=False)


def ranges(sizes, limit: int):
    """Ranges (from, to) of rows whose sizes add up to about ``limit``, one row at least."""
    start, total = 0, 0
    for k, size in enumerate(sizes):
        total += size
        if total >= limit:
            yield start, k + 1
            start, total = k + 1, 0
    if start < len(sizes):
        yield start, len(sizes)
