"""Stacking results of several markets or systems."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions import hour_shift_day


def union_all(frames: Sequence[DataFrame]) -> DataFrame:
    """By name; a column missing from one frame is NULL there."""
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), frames)


def union_labelled(frames: Mapping[str, DataFrame], label_col: str) -> DataFrame:
    """Stack frames and mark every row with the label of its frame."""
    return union_all([df.withColumn(label_col, F.lit(label)) for label, df in frames.items()])


def union_sources(
    sources: Sequence[tuple[DataFrame, Mapping[str, str], int]], day_col: str
) -> DataFrame:
    """Bring several systems to one shape: ``(frame, {target: source}, hour shift)`` each.

    The target ``day_col`` becomes the calendar day of the shifted source timestamp.
    """
    shaped = []
    for df, names, shift in sources:
        shaped.append(
            df.select(
                *[
                    (
                        hour_shift_day(F.col(source), shift)
                        if target == day_col
                        else F.col(source)
                    ).alias(target)
                    for target, source in names.items()
                ]
            )
        )
    return union_all(shaped)
