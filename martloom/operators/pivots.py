"""Long to wide. One conditional aggregate per output column needs a single exchange;
``groupBy().pivot()`` would aggregate and shuffle twice."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.money import restore_units, whole_units


def transpose_sum(
    df: DataFrame,
    keys: Sequence[str],
    type_col: str,
    amount_col: str,
    types: Mapping[str, str] | Sequence[str],
) -> DataFrame:
    """One row per key, one amount column per type; NULL where a key has none of a type.

    Each input row updates the sums of all types, so these run on whole money units where the type of
    the amounts leaves room for that.
    """
    names = types if isinstance(types, Mapping) else {t: t for t in types}
    slim, money = whole_units(df.select(*keys, type_col, amount_col), [amount_col])
    wide = slim.groupBy(*keys).agg(
        *[
            F.sum(F.when(F.col(type_col) == value, F.col(amount_col))).alias(out)
            for out, value in names.items()
        ]
    )
    return restore_units(wide, {out: money[amount_col] for out in names} if money else {})


def pivot_count_distinct(
    df: DataFrame,
    keys: Sequence[str],
    pivot_col: str,
    values: Mapping[str, object],
    id_col: str,
) -> DataFrame:
    """Distinct ids per key and pivot value, one column each; 0 where there are none.

    Duplicates go first, over the full (key, value, id) grain, so that no group of ids is
    ever held in memory; the wide step then only counts.
    """
    slim = df.select(*keys, F.col(pivot_col).alias("__at"), F.col(id_col).alias("__id")).distinct()
    known = F.col("__id").isNotNull()
    return slim.groupBy(*keys).agg(
        *[
            F.count(F.when(known & (F.col("__at") == F.lit(value)), 1)).alias(out)
            for out, value in values.items()
        ]
    )
