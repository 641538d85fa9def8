"""Sorting and top-k with deterministic tie-breaking.

``orderBy(...).limit(k)`` plans as ``TakeOrderedAndProject``: each partition
keeps its own k best rows and only those are merged, so no full sort or single
partition holds the data. The tie-break columns make the result repeatable.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def _order(spec) -> list[Column]:
    out = []
    for s in ([spec] if isinstance(spec, (str, Column)) else spec):
        if isinstance(s, Column):
            out.append(s)
        elif s.startswith("-"):
            out.append(F.col(s[1:]).desc())
        else:
            out.append(F.col(s).asc())
    return out


def ranked(df: DataFrame, order, tiebreak=()) -> DataFrame:
    """Whole table sorted by ``order`` then ``tiebreak``. A name prefixed with ``-``
    sorts descending."""
    return df.orderBy(*_order(order), *_order(list(tiebreak)))


def top_k(df: DataFrame, k: int, order, tiebreak=()) -> DataFrame:
    """The k first rows of ``ranked(df, order, tiebreak)``."""
    return ranked(df, order, tiebreak).limit(k)


def first_row(df: DataFrame, order, tiebreak=()) -> DataFrame:
    """The first row of the sorted table, as a one-row DataFrame."""
    return top_k(df, 1, order, tiebreak)


def preview(df: DataFrame, n: int = 20) -> DataFrame:
    """A bounded preview of n arbitrary rows (``show``/``take`` as a DataFrame)."""
    return df.limit(n)


def row_hash(columns, seed: int = 0) -> Column:
    """32 hex digits (MD5) of the columns' values as text, joined by ``|`` after the seed; NULL counts as ``\\N``."""
    values = [F.coalesce(F.col(c).cast("string"), F.lit("\\N")) for c in columns]
    return F.md5(F.concat_ws("|", F.lit(str(int(seed))), *values).cast("binary"))


def sample_rows(df: DataFrame, k: int, key=None, seed: int = 0) -> DataFrame:
    """A sample of ``k`` rows (all rows of a smaller table), the same under any partitioning and on every run:
    those with the smallest ``row_hash`` of the ``key`` columns, which should identify a row (default: all
    columns; rows alike in all of them are then drawn like any others).

    Two passes: the rows are counted, and one bound on the hash leaves the k smallest and few more, so that
    what is sorted and merged grows with k and not with the table. Should it leave fewer, which is next to
    impossible unless many rows share a key, it is doubled until it does not."""
    if k < 1:
        return df.limit(0)
    cols = [key] if isinstance(key, str) else list(key or df.columns)
    hashed = df.withColumn("_hash", row_hash(cols, seed))
    rows = df.count()
    few, wanted = hashed, k + 8 * math.isqrt(k) + 64
    while wanted < rows:
        bound = f"{(wanted << 60) // rows:015x}"
        few = hashed.where(F.col("_hash") < F.lit(bound))
        if few.limit(k).count() == k:
            break
        few, wanted = hashed, 2 * wanted
    return few.orderBy("_hash").limit(k).drop("_hash")
