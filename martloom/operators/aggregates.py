"""Grouped measures. Every one is a plain aggregate, combined in the map tasks first."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions import or_zero, safe_div, same_key


def total0(columns: Sequence[str]) -> Column:
    """Row-wise sum of several columns, NULL as zero."""
    return reduce(lambda a, b: a + b, [or_zero(F.col(c)) for c in columns])


def sum_groups(
    df: DataFrame, keys: Sequence[str], groups: Mapping[str, Sequence[str]]
) -> DataFrame:
    """One pass, one output per named set of columns: the total over the set, NULL as zero."""
    return df.groupBy(*keys).agg(*[F.sum(total0(cols)).alias(out) for out, cols in groups.items()])


def avg_of_ratio(
    df: DataFrame, keys: Sequence[str], num: str, den: str, name: str
) -> DataFrame:
    """Mean of the row ratios; rows without a usable denominator are left out."""
    return df.groupBy(*keys).agg(F.avg(safe_div(F.col(num), F.col(den))).alias(name))


def approx_distinct(
    df: DataFrame, keys: Sequence[str], col: str, name: str, rsd: float = 0.01
) -> DataFrame:
    """Approximate distinct count. Spark's default error of 5 % is too coarse for rates."""
    return df.groupBy(*keys).agg(F.approx_count_distinct(col, rsd).alias(name))


def partition_total(df: DataFrame, keys: Sequence[str], value: str, name: str) -> DataFrame:
    """Stamp the total over each key on its rows.

    Written as aggregate and join: a window would bring all rows of a key into one task,
    whereas a skewed join side is split.
    """
    totals = df.groupBy(*[F.col(k).alias(f"__k{i}") for i, k in enumerate(keys)]).agg(
        F.sum(value).alias(name)
    )
    match = same_key([(df[k], totals[f"__k{i}"]) for i, k in enumerate(keys)])
    return df.join(totals, match).select(*[df[c] for c in df.columns], name)


def aging_value(df: DataFrame, buckets: Mapping[str, str], cost: str) -> DataFrame:
    """Value of each age bucket: units times unit cost, zero where either is unknown."""
    return df.withColumns(
        {out: or_zero(F.col(units) * F.col(cost)) for out, units in buckets.items()}
    )


def ad_profit(sales: Column, spend: Column, fee: Column, cost: Column, units: Column) -> Column:
    """Attributed sales less spend, (negatively stored) unit fees and unit cost."""
    return sales - spend - ((-fee) * units) - (cost * units)
