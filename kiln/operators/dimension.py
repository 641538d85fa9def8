"""Dimension lookups: key -> name by join. Catalyst and AQE choose between a broadcast and a
shuffled join by the dimension's measured bytes; nothing is counted or hinted here."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from kiln.operators.topk import ranked

#: Bound on keys shipped to every executor where a caller counts them first.
DEFAULT_MAX_BROADCAST_ROWS = 1_000_000


def last_per_key(dim: DataFrame, on: str, by: str) -> DataFrame:
    """One row per key, the one with the largest ``by``: what filling a dictionary in that order
    leaves. Combined before the shuffle."""
    row = F.struct(*[c for c in dim.columns if c != on])
    return dim.groupBy(on).agg(F.max_by(row, F.col(by)).alias("_row")).select(on, "_row.*")


def _joined(left: DataFrame, right: DataFrame, on: str, how: str, strict_column: str | None) -> DataFrame:
    out = left.join(right.withColumn("_found", F.lit(True)), on, how)
    if strict_column is not None:
        missing = F.col(on).isNotNull() & F.col("_found").isNull()
        out = out.withColumn(strict_column, F.when(
            missing, F.raise_error(F.concat(F.lit("no dimension row for key "), F.col(on).cast("string"))))
            .otherwise(F.col(strict_column)))
    return out.drop("_found")


def lookup(df: DataFrame, dim: DataFrame, on: str, how: str = "left", strict_column: str | None = None,
           last_by: str | None = None) -> DataFrame:
    """Attach dimension columns to ``df`` by key.

    ``strict_column``: fail the job when a non-NULL key has no dimension row (a row whose
    name is NULL is one), the way a dictionary lookup with a missing key does. ``last_by``:
    of several dimension rows with one key only the last in this order counts; without
    it each gives a row."""
    return _joined(df, last_per_key(dim, on, last_by) if last_by else dim, on, how, strict_column)


def lookup_few(rows: DataFrame, dim: DataFrame, on: str, columns, order=(), ties=(),
               strict_column: str | None = None, last_by: str | None = None) -> DataFrame:
    """Names for a result of bounded size (a top-k), however large the dimension.

    The few keys are broadcast (their count is bounded by construction) and the
    dimension is filtered by them where it is stored; only the matching dimension
    rows move. Then the bounded rows are left-joined to those matches and, a join having
    no order, sorted by ``order`` and ``ties`` again. ``last_by`` as in ``lookup``."""
    cols = [columns] if isinstance(columns, str) else list(columns)
    keys = rows.select(on).distinct()
    matches = dim.join(F.broadcast(keys), on, "left_semi")
    matches = (last_per_key(matches, on, last_by) if last_by else matches).select(on, *cols)
    out = _joined(rows, matches, on, "left", strict_column)
    return ranked(out, list(order), list(ties)) if order else out


def other_of_pair(first: str, second: str, ref) -> "F.Column":
    """Whichever item of a pair is not the reference item."""
    return F.when(F.col(first) == F.lit(ref), F.col(second)).otherwise(F.col(first))
