"""Holdout and k-fold splits of rating tables, built on a scalable global row number.

A table has no file order, so every split takes explicit order columns, which
must be unique within their scope.

Global numbering never uses a window over the whole table (that would move all
rows into one task). Instead the rows are range-partitioned and sorted by the
order columns and written once to the shared checkpoint folder, so the range
bounds are fixed. Per-partition row counts (one row per partition) give each
partition its offset, and a row's number is its partition's offset plus its
position in the partition.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from kiln.scratch import Scratch
from kiln.session import reliable_checkpoint

# monotonically_increasing_id keeps the record position in its lower 33 bits.
_POSITION_MASK = (1 << 33) - 1


def _cols(order) -> list[str]:
    return [order] if isinstance(order, str) else list(order)


def _join_keys_null_safe(left: DataFrame, right: DataFrame, keys: list[str], how: str) -> DataFrame:
    """Join on ``keys`` treating NULL as a value (``<=>``), keeping one copy of each key,
    so rows with a NULL key are neither dropped nor duplicated."""
    renamed = right.select(*[F.col(c).alias(f"_rk_{c}") if c in keys else F.col(c) for c in right.columns])
    cond = None
    for k in keys:
        c = left[k].eqNullSafe(renamed[f"_rk_{k}"])
        cond = c if cond is None else cond & c
    return left.join(renamed, cond, how).drop(*[f"_rk_{k}" for k in keys])


def global_row_number(df: DataFrame, order, alias: str = "row_num", partitions: int | None = None,
                      total: str | None = None, part: str | None = None, stored: bool = False) -> DataFrame:
    """``df`` plus a 1-based row number in ``order``; optionally the row count as ``total`` and the
    range partition as ``part``. ``stored``: ``df`` reads a table as it lies, so that the sampling of the range
    bounds may read it a second time; any other input is computed once and written first."""
    cols = _cols(order)
    if not stored:
        df = Scratch(df.sparkSession, "kiln-rows").write(df)
    # Without an explicit count AQE sizes the range partitions to the data, merging only
    # adjacent ranges, so partition order remains the global order.
    ranged = df.repartitionByRange(partitions, *cols) if partitions else df.repartitionByRange(*cols)
    ranged = reliable_checkpoint(ranged.sortWithinPartitions(*cols))
    tagged = ranged.select("*", F.spark_partition_id().alias("_pid"),
                           F.monotonically_increasing_id().alias("_pos"))
    counts = tagged.groupBy("_pid").agg(F.count(F.lit(1)).alias("_cnt"))
    # One row per partition: a window without partitioning is fine at this size.
    before = Window.orderBy("_pid").rowsBetween(Window.unboundedPreceding, -1)
    offsets = counts.select("_pid", F.coalesce(F.sum("_cnt").over(before), F.lit(0)).alias("_off"),
                            F.sum("_cnt").over(Window.partitionBy()).alias("_total"))
    out = tagged.join(F.broadcast(offsets), "_pid").withColumn(
        alias, F.col("_off") + F.col("_pos").bitwiseAND(F.lit(_POSITION_MASK)) + F.lit(1))
    keep = ranged.columns + [alias] + ([total] if total else []) + ([part] if part else [])
    if part:
        out = out.withColumn(part, F.col("_pid"))
    if total:
        out = out.withColumn(total, F.col("_total"))
    return out.select(*keep)


def running_number(df: DataFrame, key, order, alias: str = "rank_in_key", number: str | None = None) -> DataFrame:
    """1-based position of each row within its key, in ``order``.

    Derived from the global number over (key, order) minus the first global number of
    the key. That first number is attached per (range partition, key), so a key with a large
    share of the rows stays spread over its range partitions; only one row per range partition
    and key is ever grouped by key alone. ``number``: also keep the global number, under this
    name."""
    keys = _cols(key)
    numbered = global_row_number(df, keys + _cols(order), alias="_g", part="_p")
    first = (numbered.groupBy("_p", *keys).agg(F.min("_g").alias("_g0"))
             .withColumn("_g0", F.min("_g0").over(Window.partitionBy(*keys))))
    return (_join_keys_null_safe(numbered, first, ["_p", *keys], "inner")
            .withColumn(alias, F.col("_g") - F.col("_g0") + F.lit(1))
            .withColumn(number or "_g", F.col("_g")).drop("_g0", "_p", *([] if number == "_g" else ["_g"])))


def holdout_split(df: DataFrame, user: str, order, start: int, stop: int, max_test: int = 0,
                  part: str = "part", unique: bool = False, cap_order=None) -> DataFrame:
    """Leave-n-out per user: a row whose running number within its user lies in
    [start, stop] goes to ``test``, every other row to ``base``.

    ``max_test > 0`` caps the test size: only the first ``max_test`` such rows in the order of ``cap_order``
    (default: user, then ``order``) go to test, later ones go to base. ``unique``: no user has two
    rows alike in ``order`` (saves a shuffle); otherwise such rows are numbered first.

    No row is numbered that cannot be in the test part: each task passes on only the first ``stop`` rows
    of a user, and from these come the first and last key of a user's test part. Every row is then
    compared with the two keys of its user, so that a user of any size is spread over tasks."""
    order_cols = _cols(order)
    keys = list(order_cols)
    rows = df
    if not unique:
        alike = Window.partitionBy(user, *order_cols).orderBy(*order_cols)
        rows = df.withColumn("_dup", F.row_number().over(alike))
        keys.append("_dup")
    cap_cols = (_cols(cap_order) if cap_order else [user, *order_cols]) + keys[len(order_cols):]
    in_user = Window.partitionBy("_user").orderBy("_key")
    test = (rows.select(F.col(user).alias("_user"), F.struct(*keys).alias("_key"), F.struct(*cap_cols).alias("_cap"))
            .withColumn("_k", F.row_number().over(in_user)).where(F.col("_k") <= F.lit(stop))
            .where(F.col("_k") >= F.lit(start)))
    is_test = F.col("_lo").isNotNull() & (F.struct(*keys) >= F.col("_lo")) & (F.struct(*keys) <= F.col("_hi"))
    if max_test and max_test > 0:
        # The last key within the cap: one row.
        last = test.orderBy("_cap").limit(max_test).agg(F.max("_cap").alias("_cap"), F.count(F.lit(1)).alias("n")).first()
        if last["n"] == max_test:
            at = F.struct(*[F.lit(last["_cap"][c]).cast(rows.schema[c].dataType).alias(c) for c in cap_cols])
            is_test = is_test & (F.struct(*cap_cols) <= at)
    ends = test.groupBy("_user").agg(F.min("_key").alias("_lo"), F.max("_key").alias("_hi"))
    tagged = rows.join(ends, F.col(user).eqNullSafe(F.col("_user")), "left")
    return tagged.select(*df.columns, F.when(is_test, F.lit("test")).otherwise(F.lit("base")).alias(part))


def contiguous_folds(df: DataFrame, order, k: int = 5, fold: str = "fold") -> DataFrame:
    """k contiguous folds by position in ``order``, 1-based, whose sizes differ by one at most."""
    numbered = global_row_number(df, order, alias="_g", total="_n")
    return numbered.select(*[c for c in numbered.columns if c not in ("_g", "_n")],
                           F.expr(f"cast((_g - 1) * {int(k)} div _n + 1 as int)").alias(fold))


def fold_parts(folded: DataFrame, i: int, fold: str = "fold", order=None):
    """(test, base) of fold ``i``: the fold itself and the concatenation of the
    others, each sorted by ``order`` when given."""
    test = folded.where(F.col(fold) == F.lit(i))
    base = folded.where(F.col(fold) != F.lit(i))
    if order is not None:
        test, base = test.orderBy(*_cols(order)), base.orderBy(*_cols(order))
    return test, base
