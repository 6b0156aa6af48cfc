"""Column expressions used across the reports. All are built-in Spark functions underneath."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column
from pyspark.sql import functions as F


def safe_div(num: Column, den: Column) -> Column:
    """``num / den``, NULL where the denominator is zero (ANSI mode would raise)."""
    return num / F.nullif(den, F.lit(0))


def rate_per(num: Column, den: Column, scale: int) -> Column:
    """Occurrences of ``num`` per ``scale`` units of ``den``."""
    return safe_div(num, den) * F.lit(scale)


def or_zero(col: Column) -> Column:
    return F.coalesce(col, F.lit(0))


def concat0(*cols: Column) -> Column:
    """String concatenation in which a NULL part counts as the empty string."""
    return F.concat(*[F.coalesce(c.cast("string"), F.lit("")) for c in cols])


def mask_phone(country: Column, number: Column, digits: int = 7) -> Column:
    """``+CC(***)`` and the last ``digits`` digits; NULL without a number."""
    number = number.cast("string")
    masked = concat0(F.lit("+"), country, F.lit("(***)"), F.right(number, F.lit(digits)))
    return F.when(number.isNotNull(), masked)


def flag_from_presence(col: Column, present, absent) -> Column:
    """``present`` where the column holds a value, else ``absent``."""
    return F.nvl2(col, F.lit(present), F.lit(absent))


def hour_shift_day(ts: Column, hours: int) -> Column:
    """Calendar day of a timestamp moved by some hours."""
    return F.to_date(ts + F.make_dt_interval(hours=F.lit(hours)))


def brand_prefix(col: Column, sep: str = "-", part: int = 1) -> Column:
    return F.split_part(col, F.lit(sep), F.lit(part))


def has_value(col: Column, sentinel) -> Column:
    """Presence test by sentinel: NULL and the sentinel itself both count as absent."""
    return F.coalesce(col, F.lit(sentinel)) != F.lit(sentinel)


def lacks_value(col: Column, sentinel) -> Column:
    return F.coalesce(col, F.lit(sentinel)) == F.lit(sentinel)


def month_index(year: Column, month: Column) -> Column:
    """Months counted through, so that a range may cross a year boundary."""
    return year * F.lit(12) + month


def same_key(pairs: list[tuple[Column, Column]]) -> Column:
    """NULL-safe equality over several column pairs; still a hash-joinable condition."""
    return reduce(lambda a, b: a & b, [left.eqNullSafe(right) for left, right in pairs])
