"""Newest row, newest value and row numbers per key."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from .ordered import number_and_lag


def latest_per_key(
    df: DataFrame, keys: Sequence[str], order: Sequence[str], tie_break: Sequence[str]
) -> DataFrame:
    """The row with the greatest ``order`` values per key; ties go to the least ``tie_break``.

    Filtering ``row_number() = 1`` lets Spark keep one row per key in every map task before
    the shuffle, so a key with very many rows ships at most one row per task.
    """
    if not tie_break:
        raise ValueError("latest_per_key needs a tie_break to be deterministic")
    ranks = [F.col(c).desc_nulls_last() for c in order]
    ranks += [F.col(c).asc_nulls_last() for c in tie_break]
    rank = F.row_number().over(W.partitionBy(*keys).orderBy(*ranks))
    return df.withColumn("__rank", rank).filter(F.col("__rank") == 1).drop("__rank")


def argmax_latest(
    df: DataFrame,
    keys: Sequence[str],
    values: Mapping[str, str] | Sequence[str],
    ts: str,
    tie_break: Sequence[str],
    skip_nulls: bool = True,
) -> DataFrame:
    """Per key, each value at its own greatest ``ts`` (ties: greatest ``tie_break``).

    With ``skip_nulls`` a NULL value never wins over an older known one. An aggregate
    rather than a window: partial results are combined before the shuffle.
    """
    if not tie_break:
        raise ValueError("argmax_latest needs a tie_break to be deterministic")
    names = values if isinstance(values, Mapping) else {v: v for v in values}
    at = F.struct(ts, *tie_break)

    def newest(source: str) -> Column:
        known = F.col(ts).isNotNull()
        if skip_nulls:
            known = known & F.col(source).isNotNull()
        return F.max_by(F.col(source), F.when(known, at))

    return df.groupBy(*keys).agg(*[newest(src).alias(out) for out, src in names.items()])


def row_sequence(
    df: DataFrame,
    keys: Sequence[str],
    order: Sequence[str],
    name: str = "row_num",
    chunk: Column | None = None,
) -> DataFrame:
    """Number the rows of each key along ``order``, from 1."""
    return number_and_lag(df, keys, order, seq=name, chunk=chunk)
