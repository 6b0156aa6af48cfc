"""The standard event row."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def event_row(df: DataFrame, spec: Mapping[str, object]) -> DataFrame:
    """Project to the columns of ``spec``: expressions as they are, plain values as constants."""
    return df.select(
        *[(v if isinstance(v, Column) else F.lit(v)).alias(name) for name, v in spec.items()]
    )
