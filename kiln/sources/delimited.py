"""Delimited-text sources with explicit schemas, separators and encodings."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from kiln.functions.text import collapse_whitespace, split_tokens, strip_ends
from kiln.sources.numbered import read_numbered
from kiln.sources.text import read_latin1_lines


def read_delimited(spark: SparkSession, path: str, schema: StructType | str | None = None,
                   sep: str = ",", header: bool = False, infer_schema: bool = False,
                   encoding: str = "UTF-8", quote: str | None = '"',
                   mode: str = "PERMISSIVE") -> DataFrame:
    """Read comma/tab/space/pipe or multi-character (``::``) separated text.

    * ``schema`` given: types are applied while parsing (no inference pass).
    * ``header``/``infer_schema``: names from the first line, types by a pass over all rows.
    * ``quote=None`` turns quoting off, for files that are split literally.
    * ``mode="FAILFAST"`` raises on a field that does not parse, ``"PERMISSIVE"``
      gives NULL for it.
    """
    reader = (spark.read.option("sep", sep).option("header", str(header).lower())
              .option("encoding", encoding).option("mode", mode))
    reader = reader.option("quote", "" if quote is None else quote)
    if schema is not None:
        reader = reader.schema(schema)
    elif infer_schema:
        reader = reader.option("inferSchema", "true")
    return reader.csv(path)


def read_dimension(spark: SparkSession, path: str, sep: str = "|", key: str = "id",
                   name: str = "name", key_type: str = "int", encoding: str = "ISO-8859-1",
                   repeated: str = "last", max_lines: int | None = None) -> DataFrame:
    """Id/name dimension from a delimited file: fields 0 and 1 only, quotes off, one row per id.

    Filling a dictionary line by line leaves the last line of a repeated id, and so does
    this: the lines carry their number in the file, and the largest wins (combined before the
    shuffle). ``repeated="all"`` keeps every line. ``max_lines``: only the first lines of the file(s)."""
    if repeated not in ("last", "all"):
        raise ValueError("repeated must be 'last' or 'all'")
    df = read_numbered(spark, path, f"{key} {key_type}, {name} STRING", sep, encoding)
    if max_lines is not None:
        df = df.where(F.col("row") <= F.lit(max_lines))
    if repeated == "all":
        return df.select(key, name)
    return df.groupBy(key).agg(F.max_by(name, "row").alias(name))


def read_quoted_names(spark: SparkSession, path: str, key: str = "id", name: str = "name",
                      key_type: str = "int", encoding: str = "ISO-8859-1") -> DataFrame:
    """Lines ``id "NAME WITH SPACES"`` decoded from Latin-1.

    The name is the rest of the line after the id, with runs of white space
    collapsed to one blank and the first and last character (the quotes) dropped."""
    lines = read_latin1_lines(spark, path, encoding)
    toks = split_tokens(F.col("value"), "whitespace")
    rest = F.slice(toks, 2, F.greatest(F.size(toks) - 1, F.lit(0)))
    return lines.select(F.get(toks, 0).try_cast(key_type).alias(key),
                        strip_ends(F.array_join(rest, " ")).alias(name))


def quoted_csv_names(spark: SparkSession, path: str, key: str = "id", name: str = "name",
                     encoding: str = "ISO-8859-1") -> DataFrame:
    """The CSV-reader form of the same file: space separator, default ``"`` quoting,
    then white-space runs inside the name collapsed."""
    df = read_delimited(spark, path, schema=f"{key} INT, {name} STRING", sep=" ", encoding=encoding)
    return df.select(key, collapse_whitespace(F.col(name)).alias(name))


def limit_rows(df: DataFrame, n: int, order_by) -> DataFrame:
    """The first ``n`` rows in the given order."""
    return df.orderBy(*([order_by] if isinstance(order_by, str) else order_by)).limit(n)
