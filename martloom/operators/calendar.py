"""Complete calendars. Built by exploding a constant array in place, never by a cross join."""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def calendar_spine(
    df: DataFrame,
    key: str,
    years: Iterable[int],
    months: Iterable[int] = range(1, 13),
    year_name: str = "year_",
    month_name: str = "month_",
) -> DataFrame:
    """Every distinct key in every month of every year.

    Distinct keys are few bytes, so adaptive execution would merge them into few partitions
    just before each key becomes many rows. A fixed number of partitions (twice the default,
    or the planner would drop the step as redundant) keeps the exploded spine spread out;
    hash partitioning by key also serves later windows over the key.
    """
    years, months = list(years), list(months)
    slots = F.array(
        *[
            F.struct(F.lit(y).alias(year_name), F.lit(m).alias(month_name))
            for y in years
            for m in months
        ]
    )
    partitions = 2 * int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    return (
        df.select(key)
        .distinct()
        .repartition(partitions, key)
        .withColumn("__slot", F.explode(slots))
        .select(key, f"__slot.{year_name}", f"__slot.{month_name}")
    )


def date_spine(df: DataFrame, date_col: str, extend_days: int = 0) -> DataFrame:
    """Every day from the first to the last one in the table, plus ``extend_days``."""
    span = df.agg(F.to_date(F.min(date_col)).alias("lo"), F.to_date(F.max(date_col)).alias("hi"))
    days = F.sequence(F.col("lo"), F.date_add("hi", extend_days))
    return span.filter(F.col("lo").isNotNull()).select(F.explode(days).alias(date_col))
