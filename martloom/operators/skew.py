"""Keeping skewed joins splittable, and tasks of a bounded size.

Adaptive execution splits a skewed join partition only if both join sides come straight from
a shuffle made for the join. A side that was aggregated by the join keys is already
partitioned by them and gets no such shuffle, so a hot key on the other side would stay in
one task. Joining on a hash of the keys as well gives the aggregated side, which is small, a
shuffle of its own.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

TASK_ROWS = 500_000


def key_hash(*keys: Column) -> Column:
    return F.xxhash64(*keys)


def tasks_for(spark: SparkSession, rows: int, task_rows: int = TASK_ROWS) -> int | None:
    """Partitions that hold ``rows`` at about ``task_rows`` each; None if the session's number is enough.

    Adaptive execution merges small partitions but never makes more of them, so a sort of rows that grow while the
    session's number stays needs ever more memory per task.
    """
    wanted = -(-rows // task_rows)
    return wanted if wanted > int(spark.conf.get("spark.sql.shuffle.partitions")) else None


def spread(df: DataFrame, partitions: int | None, *keys: str) -> DataFrame:
    """``df`` dealt by ``keys`` to so many partitions; as it is for None."""
    return df if partitions is None else df.repartition(partitions, *keys)
