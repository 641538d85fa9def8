"""Item-to-item cosine similarity over (user, item, rating) rows.

score(i, j) = sum_u r_ui r_uj / (sqrt(sum_u r_ui^2) * sqrt(sum_u r_uj^2)), where u
runs over the users who rated both items, and support = number of such users.

Two shapes:

* ``similar_to_item`` (one reference item): only the reference item's raters are
  joined to the ratings, so the work is linear in the ratings of those users and
  no pair table is built.
* ``rating_pairs``: the pair table itself. Each user's items are paired once (theta condition in
  the join) on a grid: with s = ceil(n / split_rows) slices for a user of n ratings (one for
  most), each row is hashed to a slice on its own side and copied to every slice of the other
  side, and the join key is (user, a, b). Task (a, b) pairs about split_rows x split_rows rows,
  however large the user, and every pair is produced exactly once. The plan is the
  same whether there is such a user or not.
* ``all_pairs_similarity``: the sums over that table, by ``_co_rated_sums``. No pair row is shuffled:
  the lists of a user's items go, as codes of a few bytes, to the tasks of each of their items, which pair and add up
  at once, and the number of tasks follows the number of pair rows. Nor are the sums, but those of items dealt to several tasks.
* ``pairs_above_support`` (a support threshold): an exact prefix filter over the items' rater
  lists, see there. ``top_pairs_by_support`` takes its threshold from the most rated items.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, DecimalType, IntegralType

from kiln.functions.numeric import cosine
from kiln.operators.dimension import DEFAULT_MAX_BROADCAST_ROWS
from kiln.operators.topk import top_k
from kiln.scratch import Scratch

# Users with more ratings than this are split into ceil(n / split_rows) slices.
DEFAULT_SPLIT_ROWS = 5_000
# The same for the lists of ``_co_rated_sums``, which a row carries whole.
CELL_ROWS = 1_000
# Pair rows that a task of ``_co_rated_sums`` makes: a bound on its memory, whatever the size of the table.
TASK_PAIRS = 2_000_000
# Tasks that add up for each task that copies lists: copies are a few bytes a pair row, sums a hundred a pair.
COPIED_TASKS = 8
# Share of the rating rows that a prefix filter must hold back to be worth its passes.
HELD_BACK_SHARE = 0.1


def _normalise(ratings: DataFrame, user: str, item: str, rating: str) -> DataFrame:
    dtype = ratings.schema[rating].dataType
    r = F.col(rating).cast("bigint") if isinstance(dtype, IntegralType) else (
        F.col(rating).cast("double") if not isinstance(dtype, DecimalType) else F.col(rating))
    return ratings.select(F.col(user).alias("_u"), F.col(item).alias("_i"), r.alias("_r"))


def rating_pairs(ratings: DataFrame, user: str = "user_id", item: str = "item_id",
                 rating: str = "rating", orientation: str = "desc",
                 split_rows: int | None = DEFAULT_SPLIT_ROWS, partitions: int | None = None) -> DataFrame:
    """Each unordered pair of items rated by the same user, once per user.

    ``orientation="desc"`` keeps ``item_1 > item_2``, ``"asc"`` keeps ``item_1 < item_2``;
    self pairs are dropped. ``partitions`` hash-partitions both sides by the join key, the user
    and the grid cell. ``split_rows=None`` leaves the grid out. Output columns: user_id, item_1,
    item_2, rating_1, rating_2."""
    r = _normalise(ratings, user, item, rating)
    keys = ["_u"]
    left = right = r
    if split_rows:
        keys = ["_u", "_a", "_b"]
        # Only users with several slices have a row here; the others get slice 0 by the left join.
        hot = (r.groupBy("_u").agg(F.count(F.lit(1)).alias("_n"))
               .where(F.col("_n") > F.lit(split_rows))
               .select("_u", F.ceil(F.col("_n") / F.lit(split_rows)).cast("int").alias("_slices")))
        tagged = (r.join(hot, "_u", "left")
                  .withColumn("_slices", F.coalesce("_slices", F.lit(1)))
                  .withColumn("_own", F.pmod(F.xxhash64("_i"), F.col("_slices")).cast("int"))
                  .withColumn("_all", F.explode(F.sequence(F.lit(0), F.col("_slices") - F.lit(1)))))
        left = tagged.select("_u", "_i", "_r", F.col("_own").alias("_a"), F.col("_all").alias("_b"))
        right = tagged.select("_u", "_i", "_r", F.col("_all").alias("_a"), F.col("_own").alias("_b"))
    if partitions:
        left, right = left.repartition(partitions, *keys), right.repartition(partitions, *keys)
    a, b = left.alias("a"), right.alias("b")
    cond = (F.col("a._i") > F.col("b._i")) if orientation == "desc" else (F.col("a._i") < F.col("b._i"))
    for k in keys:
        cond = cond & (F.col(f"a.{k}") == F.col(f"b.{k}"))
    return a.join(b, cond).select(
        F.col("a._u").alias("user_id"), F.col("a._i").alias("item_1"), F.col("b._i").alias("item_2"),
        F.col("a._r").alias("rating_1"), F.col("b._r").alias("rating_2"))


def _pair_sums(pairs: DataFrame, *keys: str) -> DataFrame:
    """The sums of a score per (item_1, item_2) or ``keys``, and ``num_rows``, the rows they come from."""
    r1, r2 = F.col("rating_1"), F.col("rating_2")
    return pairs.groupBy(*(keys or ("item_1", "item_2"))).agg(
        F.sum(r1 * r2).alias("numerator"), F.sum(r1 * r1).alias("sum_xx"),
        F.sum(r2 * r2).alias("sum_yy"), F.count(r1 * r2).alias("num_pairs"), F.count(F.lit(1)).alias("num_rows"))


class _Codes:
    """How the lists of ``_co_rated_sums`` hold a row's (_i, _r): the column ``code`` of it and the columns ``item`` and
    ``rating`` of a code.

    Integers are one number, the item's distance from the least item and behind it that of the rating from the least
    rating (0: NULL), as wide as the table's least and greatest values ask for; anything else is a struct. Codes sort by item.
    Numbers of 16 to 24 bits are sent as two arrays, of 16 and of 8 bits: ``names`` are the columns of a
    list, made by ``sent`` and taken apart by ``received``."""

    def __init__(self, r: DataFrame):
        self.types = [r.schema[c].dataType for c in ("_i", "_r")]
        self.code, self.dtype, self.names = F.struct("_i", "_r"), None, ["_other"]
        if not all(isinstance(t, IntegralType) for t in self.types):
            return
        ends = r.agg(F.min("_i"), F.max("_i"), F.min("_r"), F.max("_r")).first()
        self.item_0, item_n, self.rating_0, rating_n = (v or 0 for v in ends)
        self.bits = (rating_n - self.rating_0 + 1).bit_length()
        width = (item_n - self.item_0).bit_length() + self.bits
        self.dtype = next((t for t, most in (("smallint", 15), ("int", 31), ("bigint", 63)) if width <= most), None)
        if self.dtype == "int" and width <= 24:
            self.names = ["_low", "_high"]
        if self.dtype:
            item = F.col("_i").cast("bigint") - F.lit(self.item_0)
            rating = F.col("_r").cast("bigint") - F.lit(self.rating_0) + F.lit(1)
            self.code = F.shiftleft(item, self.bits).bitwiseOR(F.coalesce(rating, F.lit(0).cast("bigint"))).cast(self.dtype)

    def sent(self, listed: Column) -> list[Column]:
        if len(self.names) == 1:
            return [listed.alias(*self.names)]
        return [F.transform(listed, lambda x: (x.bitwiseAND(F.lit(0xFFFF)) - F.lit(0x8000)).cast("smallint")).alias("_low"),
                F.transform(listed, lambda x: (F.shiftright(x, 16) - F.lit(0x80)).cast("tinyint")).alias("_high")]

    def received(self, dealt: DataFrame, *keep: str) -> DataFrame:
        """The columns ``keep`` and ``_c``, a row for each code of the list."""
        if len(self.names) == 1:
            return dealt.select(*keep, F.explode(*self.names).alias("_c"))
        high, low = F.get("_high", F.col("_at")).cast("int") + F.lit(0x80), F.col("_lo").cast("int") + F.lit(0x8000)
        return (dealt.select(*keep, "_high", F.posexplode("_low").alias("_at", "_lo"))
                .select(*keep, F.shiftleft(high, 16).bitwiseOR(low).alias("_c")))

    def item(self, code: Column) -> Column:
        if not self.dtype:
            return code["_i"]
        return (F.shiftright(code.cast("bigint"), self.bits) + F.lit(self.item_0)).cast(self.types[0])

    def rating(self, code: Column) -> Column:
        if not self.dtype:
            return code["_r"]
        held = code.cast("bigint").bitwiseAND(F.lit((1 << self.bits) - 1))
        return F.when(held > F.lit(0), held - F.lit(1) + F.lit(self.rating_0)).cast(self.types[1])


def _hinted(frame: DataFrame, rows: int) -> DataFrame:
    """For a join: ``frame`` of ``rows`` rows, broadcast if these are few, so that the other side stays where it is."""
    return F.broadcast(frame) if rows <= DEFAULT_MAX_BROADCAST_ROWS else frame


def _item_lists(scratch: Scratch, r: DataFrame, codes: _Codes, orientation: str, split_rows: int | None) -> DataFrame:
    """(_u, _a, _b, _left, _right): the sorted codes of slice a of a user and, where b is another slice, those of slice b, for
    all a and b; most users have one slice. Slices as in ``rating_pairs``."""
    r = r.select("_u", "_i", codes.code.alias("_c"))
    listed = F.sort_array(F.collect_list("_c"), orientation != "desc").alias("_left")
    users = 0
    if split_rows:
        size = min(split_rows, CELL_ROWS)
        hot = (r.groupBy("_u").agg(F.count(F.lit(1)).alias("_n")).where(F.col("_n") > F.lit(size))
               .select("_u", F.ceil(F.col("_n") / F.lit(size)).cast("int").alias("_slices")))
        hot = scratch.write(hot, users=F.count(F.lit(1)))
        users = scratch.values["users"]
    single = r.join(_hinted(hot, users), "_u", "left_anti") if users else r
    lists = (single.select("_u", "_c").repartition("_u").groupBy("_u").agg(listed)
             .select("_u", F.lit(0).alias("_a"), F.lit(0).alias("_b"), "_left", F.lit(None).cast(ArrayType(r.schema["_c"].dataType)).alias("_right")))
    if not users:
        return lists
    k, n, own = F.col("_k"), F.col("_slices"), F.col("_own")
    # A row is in the n cells (own, b) on the left and in the n - 1 other cells (a, own) on the right.
    tagged = (r.join(_hinted(hot, users), "_u").withColumn("_own", F.pmod(F.xxhash64("_i"), n).cast("int"))
              .withColumn("_k", F.explode(F.sequence(F.lit(0), F.lit(2) * n - F.lit(2)))))
    other = F.when(k - n < own, k - n).otherwise(k - n + F.lit(1))
    cells = tagged.select("_u", F.when(k < n, own).otherwise(other).alias("_a"), F.when(k < n, k).otherwise(own).alias("_b"),
                          F.when(k < n, F.col("_c")).alias("_l"), F.when(k >= n, F.col("_c")).alias("_r"))
    cells = (cells.repartition("_u", "_a", "_b").groupBy("_u", "_a", "_b")
             .agg(F.sort_array(F.collect_list("_l"), orientation != "desc").alias("_left"), F.collect_list("_r").alias("_right"))
             .withColumn("_right", F.when(F.col("_a") != F.col("_b"), F.col("_right")))
             .where((F.size("_left") > 0) & (F.col("_right").isNull() | (F.size("_right") > 0))))
    return lists.unionByName(cells)


def _copies(lists: DataFrame, codes: _Codes, orientation: str, cells: bool) -> DataFrame:
    """(item_1, rating_1, _u, and the list): each code of a left list with the codes of the other side behind its item."""
    start = [codes.item(F.col("_c")).alias("item_1"), codes.rating(F.col("_c")).alias("rating_1"), "_u"]
    # A sorted list against itself: what follows, which may begin with the same item again.
    out = (lists.where(F.col("_right").isNull()).select("_u", "_left", *codes.sent(F.col("_left")))
           .select("_u", "_left", *codes.names, F.posexplode("_left").alias("_at", "_c"))
           .where(F.col("_at") < F.size("_left") - F.lit(1))
           .select(*start, *[F.slice(name, F.col("_at") + F.lit(2), F.size("_left")).alias(name) for name in codes.names]))
    if not cells:
        return out
    behind = F.filter("_right", lambda x: codes.item(x) < codes.item(F.col("_c")) if orientation == "desc"
                      else codes.item(x) > codes.item(F.col("_c")))
    return out.unionByName(lists.where(F.col("_right").isNotNull()).select("_u", "_right", F.explode("_left").alias("_c"))
                           .withColumn("_behind", behind).where(F.size("_behind") > 0).select(*start, *codes.sent(F.col("_behind"))))


def _co_rated_sums(scratch: Scratch, r: DataFrame, orientation: str, split_rows: int | None,
                   partitions: int | None = None) -> DataFrame:
    """``_pair_sums(rating_pairs(r))`` of stored rows (_u, _i, _r) without nulls in _u and _i, by item.

    Every item is sent, once for each of its raters, the list of the rater's items on the other side, as codes of a few
    bytes; the tasks of an item write out the pairs and add them up. There are as many tasks as TASK_PAIRS asks for (or
    ``partitions``) and an eighth as many that copy the lists. An item's sums are whole in its task and are not shuffled;
    an item of more than TASK_PAIRS pair rows is dealt to several tasks by rater, and only its sums are added up again."""
    codes = _Codes(r)
    n_left = F.size("_left").cast("bigint")
    rows = F.when(F.col("_right").isNull(), n_left * (n_left - F.lit(1))).otherwise(n_left * F.size("_right"))
    lists = scratch.write(_item_lists(scratch, r, codes, orientation, split_rows), pair_rows=F.sum(rows), cells=F.count("_right"))
    made, cells = (scratch.values["pair_rows"] or 0) // 2, scratch.values["cells"] > 0
    cores = r.sparkSession.sparkContext.defaultParallelism
    tasks = lambda rows, each=TASK_PAIRS: partitions or max(cores, -(-rows // each))
    copies = _copies(lists.repartition(tasks(made, COPIED_TASKS * TASK_PAIRS), "_u", "_a", "_b"), codes, orientation, cells)
    # Copied from the lists as they lie: counted only.
    salts = (_copies(lists, codes, orientation, cells).groupBy("item_1").agg(F.sum(F.size(codes.names[0])).alias("_n"))
             .where(F.col("_n") > F.lit(TASK_PAIRS))
             .select(F.col("item_1"), F.col("_n"), F.ceil(F.col("_n") / F.lit(TASK_PAIRS)).cast("int").alias("_salts")))
    salts = scratch.write(salts, items=F.count(F.lit(1)), pair_rows=F.sum("_n"))
    items, often = scratch.values["items"], scratch.values["pair_rows"] or 0

    def added_up(dealt: DataFrame, *keys: str) -> DataFrame:
        pairs = codes.received(dealt, "item_1", *keys, "rating_1").select(
            "item_1", *keys, "rating_1", codes.item(F.col("_c")).alias("item_2"), codes.rating(F.col("_c")).alias("rating_2"))
        return _pair_sums(pairs.where(F.col("item_1") != F.col("item_2")), "item_1", *keys, "item_2")

    whole = copies.join(_hinted(salts.select("item_1"), items), "item_1", "left_anti") if items else copies
    sums = added_up(whole.select("item_1", "rating_1", *codes.names).repartition(tasks(made - often), "item_1"))
    if not items:
        return sums
    n = tasks(often)
    parts = (copies.join(_hinted(salts.select("item_1", "_salts"), items), "item_1")
             .select("item_1", "rating_1", *codes.names, F.pmod(F.xxhash64("_u"), F.col("_salts")).cast("int").alias("_salt")))
    parts = (added_up(parts.repartition(n, "item_1", "_salt"), "_salt").repartition(n, "item_1", "item_2").groupBy("item_1", "item_2")
             .agg(*[F.sum(c).alias(c) for c in ("numerator", "sum_xx", "sum_yy", "num_pairs", "num_rows")]))
    return sums.unionByName(parts)


def _scored(sums: DataFrame, zero_denominator: str, with_sums: bool = False) -> DataFrame:
    out = sums.withColumn("score", cosine("numerator", "sum_xx", "sum_yy", zero_denominator))
    cols = ["item_1", "item_2", "score", "num_pairs"] + (["numerator", "sum_xx", "sum_yy"] if with_sums else [])
    return out.select(*cols)


def pair_similarity(pairs: DataFrame, zero_denominator: str = "null", with_sums: bool = False) -> DataFrame:
    """Cosine score and support per (item_1, item_2) from a pair table."""
    return _scored(_pair_sums(pairs), zero_denominator, with_sums)


def all_pairs_similarity(ratings: DataFrame, user: str = "user_id", item: str = "item_id",
                         rating: str = "rating", orientation: str = "asc",
                         zero_denominator: str = "zero", split_rows: int | None = DEFAULT_SPLIT_ROWS,
                         partitions: int | None = None, min_score: float | None = None,
                         min_support: int | None = None, unique: bool = False) -> DataFrame:
    """Similarity of every co-rated item pair: item_1, item_2, score, num_pairs; strict
    ``> min_score`` and ``> min_support`` where given. ``unique``: no user has rated an item twice, so that
    a pair's support is the number of their common raters; ``min_support`` then goes by ``pairs_above_support``.
    ``partitions``: tasks that copy lists and that add up, instead of the number that follows from the pair rows. The ratings
    and the lists are written once, in the shared folder, until the driver ends."""
    if unique and min_support is not None and min_support > 0:
        sims = pairs_above_support(ratings, min_support, user, item, rating, orientation, zero_denominator,
                                   split_rows, partitions)
    else:
        scratch = Scratch(ratings.sparkSession, "kiln-pairs")
        stored = scratch.write(_known(ratings, user, item, rating))
        sims = _scored(_co_rated_sums(scratch, stored, orientation, split_rows, partitions), zero_denominator)
        if min_support is not None:
            sims = sims.where(F.col("num_pairs") > F.lit(min_support))
    return sims if min_score is None else sims.where(F.col("score") > F.lit(min_score))


def _rater_lists(r: DataFrame, min_support: int, held_back: int) -> DataFrame:
    """The rows (_u, _i, _r, _key, _cut) of items with more than ``min_support`` raters. ``_key`` orders all raters alike,
    those of few ratings first; ``_cut`` is the key of the first of an item's last ``held_back`` raters.

    The tables of items, a row each, are written and sent to the rows where they are small; the rows go by user once."""
    scratch = Scratch(r.sparkSession, "kiln-raters")
    enough = F.col("_n") > F.lit(min_support)
    counts = scratch.write(r.groupBy("_i").agg(F.count(F.lit(1)).alias("_n")),
                           often=F.count(F.when(enough, True)), seldom=F.count(F.when(~enough, True)))
    if scratch.values["seldom"]:
        r = r.join(_hinted(counts.where(enough).select("_i"), scratch.values["often"]), "_i", "left_semi")
    degree = r.groupBy("_u").agg(F.count(F.lit(1)).alias("_d"))
    r = scratch.write(r.join(degree, "_u"))
    # Each task passes on the last raters of an item only, so an item of any size is spread over tasks.
    last = Window.partitionBy("_i").orderBy(F.col("_d").desc(), F.col("_u").desc())
    cuts = (r.select("_i", "_d", "_u").withColumn("_k", F.row_number().over(last)).where(F.col("_k") <= F.lit(held_back))
            .groupBy("_i").agg(F.min(F.struct("_d", "_u")).alias("_cut")))
    cuts = scratch.write(cuts, items=F.count(F.lit(1)))
    return r.join(_hinted(cuts, scratch.values["items"]), "_i").select("_u", "_i", "_r", F.struct("_d", "_u").alias("_key"), "_cut")


def pairs_above_support(ratings: DataFrame, min_support: int, user: str = "user_id", item: str = "item_id",
                        rating: str = "rating", orientation: str = "asc", zero_denominator: str = "zero",
                        split_rows: int | None = DEFAULT_SPLIT_ROWS, partitions: int | None = None,
                        held_back: int | None = None) -> DataFrame:
    """item_1, item_2, score, num_pairs of the pairs with more than ``min_support`` (1 or more) common raters; no user
    may have rated an item twice.

    All raters have one order, those with few ratings first, and an item's last ``held_back`` raters (h, 1 to
    ``min_support``, default half of it) stay out of the pairing. Where two items' lists
    are cut, at most h raters of the item cut first remain for both, so a pair of more than ``min_support`` shares more
    than ``min_support - h`` raters before the cuts. The pairs with as many are the candidates: their sums so
    far are kept, and the h raters behind the earlier cut are looked up in the other item. The result is exact.

    Users of many ratings, who make the most pairs, are those held back. Looking up takes h rows a candidate and a
    candidate has more than ``min_support - h`` pair rows, so that with the default the lookups are fewer than the pair
    rows. The ratings, the lists and the candidates are written once, in the shared folder, until the driver ends."""
    if min_support < 1:
        raise ValueError("min_support must be 1 or more")
    h = max(1, min_support // 2) if held_back is None else held_back
    if not 1 <= h <= min_support:
        raise ValueError("held_back must lie between 1 and min_support")
    scratch = Scratch(ratings.sparkSession, "kiln-pairs")
    stored = scratch.write(_known(ratings, user, item, rating))
    return _prefix_filtered(scratch, stored, min_support, h, orientation, zero_denominator, split_rows, partitions)


def _known(ratings: DataFrame, user: str, item: str, rating: str) -> DataFrame:
    return _normalise(ratings, user, item, rating).where(F.col("_u").isNotNull() & F.col("_i").isNotNull())


def _prefix_filtered(scratch: Scratch, stored: DataFrame, min_support: int, h: int, orientation: str,
                     zero_denominator: str, split_rows: int | None, partitions: int | None = None) -> DataFrame:
    # The key of a row is needed no more: whether it lies before its item's cut, and in the item's first row behind it the cut.
    key, cut = F.col("_key"), F.col("_cut")
    lists = scratch.write(_rater_lists(stored, min_support, h)
                          .select("_u", "_i", "_r", (key < cut).alias("_front"), F.when(key == cut, cut).alias("_cut")))
    sums = _co_rated_sums(scratch, lists.where("_front").select("_u", "_i", "_r"), orientation, split_rows, partitions)
    candidates = scratch.write(sums.where(F.col("num_rows") > F.lit(min_support - h)), found=F.count(F.lit(1)))
    if not scratch.values["found"]:
        return _scored(candidates, zero_denominator)
    # Looked up are rows of the candidates' items only.
    items = candidates.select(F.explode(F.array("item_1", "item_2")).alias("_i")).distinct()
    items = scratch.write(items, items=F.count(F.lit(1)))
    few = scratch.values["items"]
    lists = lists.join(_hinted(items, few), "_i", "left_semi")
    # Behind the cuts: the item cut first (its later raters are those held back) against the other one.
    back = lists.where(~F.col("_front"))
    cuts = _hinted(back.where(F.col("_cut").isNotNull()).select("_i", "_cut"), few)
    sides = (candidates.select("item_1", "item_2")
             .join(cuts.select(F.col("_i").alias("item_1"), F.col("_cut").alias("_cut_1")), "item_1")
             .join(cuts.select(F.col("_i").alias("item_2"), F.col("_cut").alias("_cut_2")), "item_2")
             .select("item_1", "item_2", (F.col("_cut_1") <= F.col("_cut_2")).alias("_first")))
    wanted = (sides.withColumn("_i", F.when(F.col("_first"), F.col("item_1")).otherwise(F.col("item_2")))
              .join(back.select("_i", "_u", F.col("_r").alias("_held")), "_i")
              .select("item_1", "item_2", "_first", "_u", "_held",
                      F.when(F.col("_first"), F.col("item_2")).otherwise(F.col("item_1")).alias("_i")))
    found = wanted.join(lists.select("_u", "_i", "_r"), ["_u", "_i"]).select(
        "item_1", "item_2", F.when(F.col("_first"), F.col("_held")).otherwise(F.col("_r")).alias("rating_1"),
        F.when(F.col("_first"), F.col("_r")).otherwise(F.col("_held")).alias("rating_2"))
    sums = candidates.unionByName(_pair_sums(found)).groupBy("item_1", "item_2").agg(
        *[F.sum(c).alias(c) for c in ("numerator", "sum_xx", "sum_yy", "num_pairs")])
    return _scored(sums.where(F.col("num_pairs") > F.lit(min_support)), zero_denominator)


def top_pairs_by_support(ratings: DataFrame, k: int, user: str = "user_id", item: str = "item_id",
                         rating: str = "rating", orientation: str = "asc", zero_denominator: str = "zero",
                         split_rows: int | None = DEFAULT_SPLIT_ROWS, unique: bool = False) -> DataFrame:
    """The ``k`` pairs of most support (ties by item_1, item_2): item_1, item_2, score, num_pairs.

    The k-th best support among the pairs of the most rated items is a lower bound of the k-th
    best of all. Items of fewer raters are left out, and where the raters held back are HELD_BACK_SHARE of the rest
    or more, the prefix filter of ``pairs_above_support`` goes before the scores (if all items have many more
    raters than the bound, it would prune nothing). Either way gives the same rows. ``unique`` as in
    ``all_pairs_similarity``; without it every pair is scored."""
    if not unique:
        return top_k(all_pairs_similarity(ratings, user, item, rating, orientation, zero_denominator, split_rows),
                     k, ["-num_pairs"], ["item_1", "item_2"])
    scratch = Scratch(ratings.sparkSession, "kiln-pairs")
    stored = scratch.write(_known(ratings, user, item, rating))
    seeds = 2 * math.isqrt(2 * k) + 2  # four times as many pairs as wanted, and more
    counts = scratch.write(stored.groupBy("_i").agg(F.count("_r").alias("_n"), F.count(F.lit(1)).alias("_rows")), rows=F.sum("_rows"))
    rows = scratch.values["rows"] or 0
    most = top_k(counts, seeds, ["-_n"], ["_i"]).select("_i")
    pairs = rating_pairs(stored.join(F.broadcast(most), "_i", "left_semi"), "_u", "_i", "_r", orientation, split_rows)
    best = top_k(_pair_sums(pairs), k, ["-num_pairs"]).agg(F.count(F.lit(1)).alias("n"), F.min("num_pairs").alias("least")).first()
    floor = best["least"] if best["n"] == k else 0
    # Only items of that many raters can be in such a pair.
    often = counts.where(F.col("_rows") >= F.lit(floor))
    size = often.agg(F.count(F.lit(1)).alias("items"), F.coalesce(F.sum("_rows"), F.lit(0)).alias("rows")).first()
    # A quarter held back: few pairs of less support have three quarters of it before the cuts.
    held_back = max(1, (floor - 1) // 4)
    if floor > 1 and held_back * size["items"] >= HELD_BACK_SHARE * size["rows"]:
        sims = _prefix_filtered(scratch, stored, floor - 1, held_back, orientation, zero_denominator, split_rows)
    else:
        rest = stored
        if size["rows"] < rows:
            rest = scratch.write(stored.join(_hinted(often.select("_i"), size["items"]), "_i", "left_semi"))
        sims = _scored(_co_rated_sums(scratch, rest, orientation, split_rows), zero_denominator)
    return top_k(sims, k, ["-num_pairs"], ["item_1", "item_2"])


def similar_to_item(ratings: DataFrame, ref, user: str = "user_id", item: str = "item_id",
                    rating: str = "rating", min_score: float | None = None,
                    min_support: int | None = None, k: int | None = 10, orientation: str = "desc",
                    zero_denominator: str = "null") -> DataFrame:
    """Items similar to ``ref``: item_1, item_2 (pair in the chosen orientation),
    other_item, score, num_pairs; strict ``> min_score`` and ``> min_support``;
    the ``k`` best by score (ties by other_item) or all when ``k`` is None."""
    r = _normalise(ratings, user, item, rating)
    raters = r.where(F.col("_i") == F.lit(ref)).select("_u", F.col("_r").alias("_rr"))
    others = r.where(F.col("_i") != F.lit(ref))
    joined = others.join(raters, "_u")
    sums = joined.groupBy(F.col("_i").alias("other_item")).agg(
        F.sum(F.col("_r") * F.col("_rr")).alias("numerator"),
        F.sum(F.col("_rr") * F.col("_rr")).alias("sum_ref"),
        F.sum(F.col("_r") * F.col("_r")).alias("sum_other"),
        F.count(F.col("_r") * F.col("_rr")).alias("num_pairs"))
    ref_lit = F.lit(ref).cast(r.schema["_i"].dataType)
    first_is_ref = (ref_lit > F.col("other_item")) if orientation == "desc" else (ref_lit < F.col("other_item"))
    # The pair orientation decides which sum is sum_xx; the score is the same either way.
    scored = sums.select(
        F.when(first_is_ref, ref_lit).otherwise(F.col("other_item")).alias("item_1"),
        F.when(first_is_ref, F.col("other_item")).otherwise(ref_lit).alias("item_2"),
        "other_item",
        F.when(first_is_ref, cosine("numerator", "sum_ref", "sum_other", zero_denominator))
         .otherwise(cosine("numerator", "sum_other", "sum_ref", zero_denominator)).alias("score"),
        "num_pairs")
    if min_score is not None:
        scored = scored.where(F.col("score") > F.lit(min_score))
    if min_support is not None:
        scored = scored.where(F.col("num_pairs") > F.lit(min_support))
    if k is None:
        return scored
    return top_k(scored, k, ["-score"], ["other_item"])
