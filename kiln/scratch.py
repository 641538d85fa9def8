"""Derived tables in the shared folder, with an owner and an end of life.

A table that a job derives and reads several times (BFS levels, an edge layout) is written once as
Parquet below ``spark.checkpoint.dir``: the files outlive any executor, and reading them cuts
the lineage. Whoever opens a ``Scratch`` owns its tables: they are deleted when the ``with`` block ends
or ``release`` is called, and at the latest when the driver ends.
"""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, Observation, SparkSession

from kiln.session import ensure_checkpoint_dir


class Scratch:
    """A folder of derived tables. Frames that read them are valid until it is released."""

    def __init__(self, spark: SparkSession, name: str = "kiln-scratch"):
        self.spark, self.tables, self.names = spark, 0, []
        self.path = f"{ensure_checkpoint_dir(spark).rstrip('/')}/{name}-{uuid.uuid4().hex}"
        self._files().deleteOnExit(self._path())

    def _path(self):
        return self.spark._jvm.org.apache.hadoop.fs.Path(self.path)

    def _files(self):
        return self._path().getFileSystem(self.spark._jsc.hadoopConfiguration())

    def write(self, df: DataFrame, partition_by: str | None = None, compression: str = "zstd", **observed) -> DataFrame:
        """``df`` written once and read back. ``observed``: aggregates by name that the write itself computes; they
        are counted on its last stage, where a task that runs twice counts once. Their values are in ``values``."""
        self.tables += 1
        path = f"{self.path}/{self.tables}"
        seen = Observation() if observed else None
        if seen is not None:
            df = df.observe(seen, *[column.alias(name) for name, column in observed.items()])
        writer = df.write.option("compression", compression)
        (writer.partitionBy(partition_by) if partition_by else writer).parquet(path)
        self.values = seen.get if seen is not None else {}
        return self.spark.read.schema(df.schema).parquet(path)

    def bucketed(self, df: DataFrame, keys, buckets: int | None = None, compression: str = "zstd") -> DataFrame:
        """``df`` written in hash buckets of ``keys``, sorted by them, and read back. Joins and aggregates on the keys read
        the buckets as they lie: their rows are not shuffled again, however many operators use them.

        ``buckets``: default as many as a shuffle has partitions (one per core at least), so that the other
        side of a join is dealt to these. A key is in one bucket; give hot keys a salt as one of ``keys``."""
        conf = int(self.spark.conf.get("spark.sql.shuffle.partitions"))
        buckets = buckets or max(conf, self.spark.sparkContext.defaultParallelism)
        keys = [keys] if isinstance(keys, str) else list(keys)
        self.tables += 1
        name = f"kiln_{uuid.uuid4().hex}"
        # Dealt as the buckets are, so that a task writes one file for a bucket.
        (df.repartition(buckets, *keys).write.option("compression", compression).option("path", f"{self.path}/{self.tables}")
         .bucketBy(buckets, *keys).sortBy(*keys).saveAsTable(name))
        self.names.append(name)
        return self.spark.table(name)

    def release(self) -> None:
        """Delete the tables."""
        while self.names:
            self.spark.sql(f"DROP TABLE IF EXISTS {self.names.pop()}")
        self._files().delete(self._path(), True)

    def __enter__(self) -> "Scratch":
        return self

    def __exit__(self, *_) -> None:
        self.release()
