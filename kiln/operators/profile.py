"""Physical-layout and schema views of a table."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def partition_profile(df: DataFrame, pid: str = "partition_id", count: str = "rows") -> DataFrame:
    """Rows per physical partition (number of partitions = number of rows here)."""
    return df.groupBy(F.spark_partition_id().alias(pid)).agg(F.count(F.lit(1)).alias(count))


def partition_rows(df: DataFrame, partition: int, pid: str = "pid") -> DataFrame:
    """The rows of one physical partition, with the partition id as a column."""
    return df.select("*", F.spark_partition_id().alias(pid)).where(F.col(pid) == F.lit(partition))


def schema_table(df: DataFrame) -> DataFrame:
    """Names, types and nullability of the columns (``DESCRIBE`` as a DataFrame)."""
    rows = [(f.name, f.dataType.simpleString(), f.nullable) for f in df.schema.fields]
    return df.sparkSession.createDataFrame(rows, "col_name STRING, data_type STRING, nullable BOOLEAN")
