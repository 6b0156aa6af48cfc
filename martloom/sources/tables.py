"""Scans, time slices and sinks.

Slices compare the stored column itself with constant bounds (never a function of the
column), so that they reach the Parquet scan and prune partitions.
"""

from __future__ import annotations

import datetime as dt
from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions import month_index

MONEY = "decimal(18,2)"


def load(spark: SparkSession, base: str, name: str, money: Sequence[str] = ()) -> DataFrame:
    """One Parquet table, its money columns as exact decimals."""
    df = spark.read.parquet(f"{base}/{name}.parquet")
    return df.withColumns({c: F.col(c).cast(MONEY) for c in money}) if money else df


def read_remote(
    spark: SparkSession,
    url: str,
    table: str,
    column: str,
    lower,
    upper,
    partitions: int = 4,
    properties: dict[str, str] | None = None,
) -> DataFrame:
    """A table of another database, read by ``partitions`` parallel range queries."""
    return spark.read.jdbc(
        url,
        table,
        column=column,
        lowerBound=lower,
        upperBound=upper,
        numPartitions=partitions,
        properties=properties or {},
    )


def latest_snapshot(df: DataFrame, date_col: str) -> DataFrame:
    """Rows of the newest snapshot; apply before any other filter, the maximum is over all rows."""
    newest = df.select(F.max(date_col)).scalar()
    return df.filter(F.col(date_col) == newest)


def footer_max(spark: SparkSession, path: str, column: str) -> DataFrame:
    """One row, the greatest value of a column of a Parquet folder, planned from the file footers alone.

    For numbers and dates, whose statistics are exact; of a timestamp or text column the values themselves are read. The
    plan is made with the reader that can push the aggregate down; the session's own settings come back after.
    """
    conf, session = spark.conf, {"spark.sql.parquet.aggregatePushdown": "true"}
    listed = conf.get("spark.sql.sources.useV1SourceList")
    session["spark.sql.sources.useV1SourceList"] = ",".join(x for x in listed.split(",") if x.strip() != "parquet")
    before = {k: conf.get(k) for k in session}
    for k, v in session.items():
        conf.set(k, v)
    try:
        newest = spark.read.parquet(path).agg(F.max(column).alias("newest"))
        newest._jdf.queryExecution().executedPlan()  # planned while the settings hold
        return newest
    finally:
        for k, v in before.items():
            conf.set(k, v)


def read_newest(spark: SparkSession, path: str, date_col: str) -> DataFrame:
    """Rows of the newest snapshot of a Parquet folder, found without a scan of its own.

    The footers give the newest date; as a constant it then prunes folders, files and row groups. An empty folder, and one whose
    dates are all NULL, gives no rows.
    """
    newest = footer_max(spark, path, date_col).first()["newest"]
    rows = spark.read.parquet(path)
    return rows.filter(F.col(date_col) == F.lit(newest).cast(rows.schema[date_col].dataType))


def window_to_max(
    df: DataFrame, date_col: str, days: int, inclusive_start: bool = False
) -> DataFrame:
    """The last ``days`` days up to the newest date found in the table itself.

    ``inclusive_start`` also keeps the day ``max - days``, i.e. ``days + 1`` dates.
    """
    back = days if inclusive_start else days - 1
    first = F.date_sub(F.to_date(F.max(date_col)), back).cast(df.schema[date_col].dataType)
    return df.filter(F.col(date_col) >= df.select(first).scalar())


def trailing_days(df: DataFrame, date_col: str, as_of: dt.date, lo: int, hi: int) -> DataFrame:
    """Days in ``(as_of - lo, as_of - hi]``."""
    first = as_of - dt.timedelta(days=lo - 1)
    after = as_of - dt.timedelta(days=hi - 1)
    return df.filter((F.col(date_col) >= F.lit(first)) & (F.col(date_col) < F.lit(after)))


def event_day(df: DataFrame, date_col: str, day: dt.date) -> DataFrame:
    """One calendar day, for incremental runs."""
    return trailing_days(df, date_col, day, 1, 0)


def months_slice(
    df: DataFrame, date_col: str, first: tuple[int, int], last: tuple[int, int]
) -> DataFrame:
    """Rows dated from month ``first`` to month ``last`` (year, month), both included.

    Half-open bounds on the stored column, which a scan can use; ``year()`` and ``month()`` of it
    would read everything.
    """
    after = divmod(last[0] * 12 + last[1], 12)
    start, end = dt.date(*first, 1), dt.date(after[0], after[1] + 1, 1)
    return df.filter((F.col(date_col) >= F.lit(start)) & (F.col(date_col) < F.lit(end)))


def month_range(
    df: DataFrame, year_col: str, month_col: str, start: tuple[int, int], end: tuple[int, int]
) -> DataFrame:
    """Rows from month ``start`` to month ``end``, both included, across year boundaries.

    The plain year bounds repeat part of the condition so that the scan can use them.
    """
    year, month = F.col(year_col), F.col(month_col)
    return df.filter(
        year.between(start[0], end[0])
        & month_index(year, month).between(start[0] * 12 + start[1], end[0] * 12 + end[1])
    )


def write_table(
    df: DataFrame,
    target: str,
    partition_by: Sequence[str] = (),
    touched_only: bool = False,
    as_path: bool = False,
) -> None:
    """Rebuild a result table (or, with ``as_path``, a folder of Parquet files).

    ``touched_only`` replaces just the partitions present in ``df``: a rerun of one day
    leaves the other days alone. The rebalance hint merges small output files and splits
    a partition value that holds very many rows.
    """
    out = df.hint("rebalance", *partition_by) if partition_by else df
    writer = out.write.mode("overwrite").format("parquet")
    if partition_by:
        writer = writer.partitionBy(*partition_by)
    if as_path:
        mode = "dynamic" if touched_only else "static"
        writer.option("partitionOverwriteMode", mode).save(target)
    elif touched_only and df.sparkSession.catalog.tableExists(target):
        _replace_partitions(out, target)
    else:
        writer.saveAsTable(target)


def _replace_partitions(df: DataFrame, table: str) -> None:
    """``insertInto`` takes its overwrite mode from the session alone."""
    conf, key = df.sparkSession.conf, "spark.sql.sources.partitionOverwriteMode"
    before = conf.get(key)
    conf.set(key, "dynamic")
    try:
        columns = df.sparkSession.table(table).columns
        df.select(*columns).write.mode("overwrite").insertInto(table)
    finally:
        conf.set(key, before)
