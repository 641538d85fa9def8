"""Group statistics: counts, sums, means, extremes, distinct keys, global totals.

All are hash aggregates with a partial (map-side) and a final step, so a key
holding a large share of the rows is combined before the shuffle.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from kiln.functions.numeric import decimal_parts, exact_square_sum, sum_of_parts


def _keys(keys) -> list:
    return [keys] if isinstance(keys, (str, Column)) else list(keys)


def _col(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


def group_count(df: DataFrame, keys, alias: str = "count") -> DataFrame:
    """Rows per group (count by key / count by value)."""
    return df.groupBy(*_keys(keys)).agg(F.count(F.lit(1)).alias(alias))


def _exact_sums(df: DataFrame, keys, value, scale: int) -> DataFrame:
    """The keys, ``_s`` (the sum as double, the same in any order of the rows) and ``_n`` (non-NULL values).

    Values of ``scale`` places or fewer are added in one DECIMAL; others as integers per power of ten.
    Both are partial/final aggregates; the second one merges a group's powers (a few hundred at most)."""
    keys = _keys(keys)
    fixed, power, digits, special = decimal_parts(value, scale)
    names = [f"_k{i}" for i in range(len(keys))]
    rows = df.select(*[_col(k).alias(n) for k, n in zip(keys, names)], power.alias("_p"), fixed.alias("_f"),
                     digits.alias("_d"), special.alias("_x"), _col(value).alias("_v"))
    parts = rows.groupBy(*names, "_p").agg(F.sum("_f").alias("_f"), F.sum("_d").alias("_d"), F.sum("_x").alias("_x"),
                                           F.count("_v").alias("_n"))
    term = F.when(F.col("_p").isNotNull(), F.struct(F.col("_p").alias("power"), F.col("_d").alias("digits")))
    whole = parts.groupBy(*names).agg(F.max("_f").alias("_f"), F.collect_list(term).alias("_t"), F.max("_x").alias("_x"),
                                      F.sum("_n").alias("_n"))
    columns = df.select(*[_col(k) for k in keys]).columns
    return whole.select(*[F.col(n).alias(c) for n, c in zip(names, columns)],
                        sum_of_parts("_f", F.col("_t"), "_x").alias("_s"), "_n")


def group_sum(df: DataFrame, keys, value, alias: str = "total", exact_scale: int | None = None) -> DataFrame:
    """Sum per group. With ``exact_scale`` doubles are added as the decimals that they print as, so that
    the double result does not depend on the order of the rows; values of up to ``exact_scale`` places
    are the fast case, all others are added too."""
    if exact_scale is None:
        return df.groupBy(*_keys(keys)).agg(F.sum(_col(value)).alias(alias))
    sums = _exact_sums(df, keys, value, exact_scale)
    return sums.select(*[c for c in sums.columns if c not in ("_s", "_n")], F.col("_s").alias(alias))


def group_mean(df: DataFrame, keys, value, alias: str = "mean", exact_scale: int | None = None) -> DataFrame:
    """Mean per group with Spark's two-phase average (in-partition, then merge).

    With ``exact_scale`` the sum is that of ``group_sum`` and is divided by the count once, so the
    double result is repeatable."""
    if exact_scale is not None:
        return group_mean_by_parts(df, keys, value, alias, exact_scale)
    return df.groupBy(*_keys(keys)).agg(F.avg(_col(value)).alias(alias))


def group_mean_by_parts(df: DataFrame, keys, value, alias: str = "mean",
                        exact_scale: int | None = None) -> DataFrame:
    """Mean per group written as (sum, count) merged and then divided; equals
    ``group_mean`` and is kept as its paired check."""
    v = _col(value)
    parts = (_exact_sums(df, keys, v, exact_scale) if exact_scale is not None
             else df.groupBy(*_keys(keys)).agg(F.sum(v).alias("_s"), F.count(v).alias("_n")))
    return parts.select(*[c for c in parts.columns if c not in ("_s", "_n")],
                        F.try_divide(F.col("_s"), F.col("_n")).alias(alias))


def group_extreme(df: DataFrame, keys, value, how: str = "max", alias: str | None = None) -> DataFrame:
    """Max or min per group."""
    fn = {"max": F.max, "min": F.min}[how]
    return df.groupBy(*_keys(keys)).agg(fn(_col(value)).alias(alias or f"{how}_value"))


def distinct_keys(df: DataFrame, keys) -> DataFrame:
    """The distinct values of the key columns."""
    return df.select(*_keys(keys)).distinct()


def total_count(df: DataFrame, alias: str = "total") -> DataFrame:
    """One row with the number of rows."""
    return df.agg(F.count(F.lit(1)).alias(alias))


def global_extreme(df: DataFrame, value, how: str = "min", alias: str | None = None) -> DataFrame:
    """One row with the global min or max of a column (empty grouping)."""
    fn = {"max": F.max, "min": F.min}[how]
    return df.agg(fn(_col(value)).alias(alias or f"{how}_value"))


def sum_of_squares(df: DataFrame, value, alias: str = "sum_of_squares") -> DataFrame:
    """One row with the exact sum of squares of an integral column."""
    return df.agg(exact_square_sum(value).alias(alias), F.count(F.lit(1)).alias("n"))


def closed_form_square_sum(n) -> Column:
    """n(n+1)(2n+1)/6: the sum of squares of 1..n (so 0..n-1 differs by n^2)."""
    n = _col(n).cast("decimal(38,0)")
    return (n * (n + F.lit(1)) * (F.lit(2) * n + F.lit(1)) / F.lit(6)).cast("decimal(38,0)")
