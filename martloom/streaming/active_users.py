"""Daily distinct-user sketches from an event stream.

The trailing count is a union of daily sketches, so the stream only has to finish days: its
state is one sketch per open day whatever the number of users. The written days feed
:func:`martloom.operators.rolling.roll_sketches`.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery


def daily_sketches(
    events: DataFrame, ts: str, id_col: str, late: str = "1 hour", lg_k: int = 14
) -> DataFrame:
    """One row per day, emitted once no event of the day can arrive within ``late`` any more."""
    return (
        events.select(F.col(ts).cast("timestamp").alias("__ts"), F.col(id_col).alias("__id"))
        .withWatermark("__ts", late)
        .groupBy(F.window("__ts", "1 day"))
        .agg(F.hll_sketch_agg("__id", lg_k).alias("sketch"))
        .select(F.to_date("window.start").alias("day"), "sketch")
    )


def sliding_users(
    events: DataFrame, ts: str, id_col: str, days: int = 7, late: str = "1 hour", lg_k: int = 14, name: str = "users"
) -> DataFrame:
    """Distinct ids of the trailing ``days`` days, one row per day, straight from the stream.

    A first window finishes each day's sketch, a second, sliding by a day, unites those of the days it holds. A window comes out
    when no event within ``late`` can change it any more; events that come later than that are dropped. The state is a sketch per
    open day and per open window, whatever the number of events and ids.
    """
    daily = (
        events.select(F.col(ts).cast("timestamp").alias("__ts"), F.col(id_col).alias("__id"))
        .withWatermark("__ts", late)
        .groupBy(F.window("__ts", "1 day"))
        .agg(F.hll_sketch_agg("__id", lg_k).alias("sketch"))
    )
    sliding = F.window(F.window_time("window"), f"{days} days", "1 day")
    weekly = daily.groupBy(sliding.alias("week")).agg(F.hll_union_agg("sketch").alias("sketch"))
    last = F.date_sub(F.to_date("week.end"), 1).alias("day")
    return weekly.select(last, F.hll_sketch_estimate("sketch").alias(name))


def write_daily(daily: DataFrame, path: str, checkpoint: str) -> StreamingQuery:
    """Append finished days to a folder; ``checkpoint`` must be shared storage as well."""
    return (
        daily.writeStream.outputMode("append")
        .format("parquet")
        .option("path", path)
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start()
    )
