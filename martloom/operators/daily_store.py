"""A trailing-window count kept as two published folders: daily counts, and the windows made of them.

Late events of a day change its own count and the windows of the days that look back on it. A refresh reads the events of
the changed days, replaces their counts, and remakes just the windows that hold them from the counts of the days around.
"""

from __future__ import annotations

import datetime as dt
from collections.abc import Iterable, Mapping, Sequence
from dataclasses import dataclass, field

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..sources import publish, read_published
from .rolling import daily_distinct, spread_days


@dataclass(frozen=True)
class DailyStore:
    """Distinct ids per day, and summed over the trailing ``days`` days, overall and per category."""

    target: str
    date: str
    id_cols: Sequence[str]
    days: int
    name: str = "pairs"
    categories: Mapping[str, object] = field(default_factory=dict)
    category_col: str | None = None

    @property
    def counts(self) -> list[str]:
        return [self.name, *self.categories]

    @property
    def schema(self) -> T.StructType:
        columns = [T.StructField(self.date, T.DateType()), *[T.StructField(c, T.LongType()) for c in self.counts]]
        return T.StructType(columns)

    def daily(self, spark: SparkSession, only: Iterable[dt.date] | None = None) -> DataFrame:
        return read_published(spark, f"{self.target}/daily", self.schema, only)

    def windows(self, spark: SparkSession, only: Iterable[dt.date] | None = None) -> DataFrame:
        """The counts of each window, by its last day; days whose window is empty do not appear."""
        return read_published(spark, f"{self.target}/windows", self.schema, only)

    def _reach(self, changed: Iterable[dt.date], before: int) -> list[dt.date]:
        """The days from ``before`` days before any changed day to the last window that holds it."""
        reach = range(-before, self.days)
        return sorted({d + dt.timedelta(days=n) for d in changed for n in reach})

    def refresh(self, events: DataFrame, changed: Sequence[dt.date]) -> None:
        """Take the changed days' events as they are now; all others of ``events`` are left out of the scan.

        A changed day without events any more loses its count. Run again after a failure between the two steps, it gives
        the same result.
        """
        if not changed:
            return
        spark, date = events.sparkSession, F.col(self.date)
        now = events.filter(date.isin(*changed))
        counts = daily_distinct(now, self.date, self.id_cols, self.name, self.categories, self.category_col)
        publish(counts.select(*self._typed()), f"{self.target}/daily", date, changed)
        touched = self._reach(changed, 0)
        around = self.daily(spark, self._reach(changed, self.days - 1))
        sums = spread_days(around, self.date, self.days).groupBy(self.date).agg(*[F.sum(c).alias(c) for c in self.counts])
        windows = sums.filter(date.isin(*touched)).select(*self._typed())
        publish(windows, f"{self.target}/windows", date, touched)

    def _typed(self):
        return [F.col(f.name).cast(f.dataType).alias(f.name) for f in self.schema]
