"""Numeric column helpers: unit conversion, decimal sums in parts, cosine from sums."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def _col(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


def tenths_celsius_to_fahrenheit(value) -> Column:
    """Tenths of a degree Celsius to Fahrenheit, evaluated left to right as
    ``t * 0.1 * 9.0 / 5 + 32`` so the double result is bit-for-bit repeatable."""
    # Scale 0.1, ratio 9.0 / 5, offset 32.
    return _col(value) * F.lit(0.1) * F.lit(9.0) / F.lit(5) + F.lit(32)


#: Below this a value with few enough places is summed as it is, in DECIMAL(38, scale).
_PLAIN_BELOW = 1e15


def decimal_parts(value, scale: int = 12) -> tuple[Column, Column, Column, Column]:
    """A double as the decimal that it prints as, in parts that can be added in any order: (fixed, power,
    digits, special). ``fixed``: the value in ``scale`` places, where that is exact. Otherwise the value is
    ``digits`` (an integer of 17 digits at most) times ten to the ``power``. ``special``: NaN and infinities."""
    v = _col(value).cast("double")
    finite = ~F.isnan(v) & (F.abs(v) < F.lit(float("inf")))
    fixed = F.when(F.abs(v) < F.lit(_PLAIN_BELOW), v).try_cast(f"decimal(38,{scale})")
    plain = F.coalesce(fixed.cast("double") == v, F.lit(False))
    text = F.split(v.cast("string"), "E")
    mantissa = F.get(text, 0)
    places = F.char_length(F.substring_index(mantissa, ".", -1))
    power = F.coalesce(F.get(text, 1).try_cast("int"), F.lit(0)) - places
    digits = F.replace(mantissa, F.lit("."), F.lit("")).try_cast("decimal(20,0)")
    odd = v.isNotNull() & finite & ~plain
    return (F.when(plain, fixed), F.when(odd, power), F.when(odd, digits), F.when(v.isNotNull() & ~finite, v))


def sum_of_parts(fixed, terms, special) -> Column:
    """The double that a sum in parts stands for: ``terms`` is an array of (power, digits), powers distinct.
    With fixed parts only it is the exact sum, rounded once; otherwise every term is rounded once and they are
    added by ascending power with their rounding errors carried, the same for any order of the rows."""
    start = F.struct(F.lit(0.0).alias("hi"), F.lit(0.0).alias("lo"))
    rounded = F.transform(F.array_sort(terms), lambda t: F.concat(
        t["digits"].cast("string"), F.lit("E"), t["power"].cast("string")).cast("double"))

    def add(acc, x):
        total = acc["hi"] + x
        back = total - acc["hi"]
        lost = (acc["hi"] - (total - back)) + (x - back)
        return F.struct(total.alias("hi"), (acc["lo"] + lost).alias("lo"))

    plain = _col(fixed).cast("double")
    mixed = F.aggregate(F.concat(rounded, F.array(F.coalesce(plain, F.lit(0.0)))), start, add,
                        lambda acc: F.when(F.abs(acc["hi"]) == F.lit(float("inf")), acc["hi"])
                        .otherwise(acc["hi"] + acc["lo"]))
    return F.when(_col(special).isNotNull(), _col(special)).when(F.size(terms) > 0, mixed).otherwise(plain)


def exact_square_sum(value) -> Column:
    """Sum of squares of an integral column without overflow (DECIMAL(38,0))."""
    v = _col(value).cast("decimal(38,0)")
    return F.sum(v * v).cast("decimal(38,0)")


def cosine(numerator, sum_xx, sum_yy, zero_denominator: str = "null") -> Column:
    """``numerator / (sqrt(sum_xx) * sqrt(sum_yy))``.

    ``zero_denominator`` picks what a zero vector gives: ``"null"`` (division is
    guarded, the pair keeps a NULL score) or ``"zero"`` (score 0, as the
    list-based scorer does)."""
    den = F.sqrt(_col(sum_xx)) * F.sqrt(_col(sum_yy))
    if zero_denominator == "zero":
        return F.when(den == F.lit(0.0), F.lit(0.0)).otherwise(_col(numerator) / den)
    if zero_denominator == "null":
        return F.try_divide(_col(numerator), den)
    raise ValueError("zero_denominator must be 'null' or 'zero'")


def round_half_up(value, places: int = 2) -> Column:
    """Spark's ``round`` (HALF_UP on the decimal form of the double)."""
    return F.round(_col(value), places)
