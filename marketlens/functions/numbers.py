"""Numeric column helpers."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

_NUMBER = r"^[+-]?([0-9]+\.?[0-9]*|\.[0-9]+)([eE][+-]?[0-9]+)?$"


def _col(c: Column | str) -> Column:
    return F.col(c) if isinstance(c, str) else c


def round_out(c: Column | str, digits: int) -> Column:
    """Half-up rounding of a double on its binary value, away from zero.

    Built from floor so that it agrees with engines that round by scaling;
    Spark's own ``round`` goes through the decimal text of the number and
    differs on ties. A value whose scaled size has no fraction left in a double
    stays as it is.
    """
    x = _col(c).cast("double")
    scale = float(10**digits)
    size = F.abs(x) * F.lit(scale)
    return F.when(size >= F.lit(2.0**53), x).otherwise(F.signum(x) * F.floor(size + F.lit(0.5)) / F.lit(scale))


def ratio(a: Column | str, b: Column | str) -> Column:
    """a / b as double, NULL where b is zero or NULL."""
    return F.try_divide(_col(a).cast("double"), _col(b).cast("double"))


def strip_currency(c: Column | str) -> Column:
    """Drop currency glyphs, both comma forms and white space."""
    return F.regexp_replace(_col(c), r"(?U)[￥¥元,，\s]", "")


def to_number(c: Column | str) -> Column:
    """Text to double; anything that is not a plain number becomes NULL."""
    return F.regexp_extract(_col(c), _NUMBER, 0).try_cast("double")


def _plain(c: Column | str) -> Column:
    """Whether a text is digits with a point at most: its cast is then what ``to_number`` gives."""
    return _col(c).rlike(r"^[0-9]+\.?[0-9]*\z")


def price_number(c: Column | str) -> Column:
    """``to_number`` of a price text without its currency marks."""
    return F.when(_plain(c), _col(c).try_cast("double")).otherwise(to_number(strip_currency(c)))


def click_count(c: Column | str) -> Column:
    """Text to a whole count of 64 bits: '12' and '12.0' give 12, bad or missing gives 0."""
    number = F.when(_plain(c), _col(c).try_cast("double")).otherwise(to_number(F.trim(_col(c))))
    return F.coalesce(number.try_cast("bigint"), F.lit(0).cast("bigint"))
