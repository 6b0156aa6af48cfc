"""Steps of a long job written down one by one, so that only one step's shuffle files are on disk at a time.

Spark keeps the shuffle files of a query until all of it has ended; a report of many components would hold those of all of
them at once. A written step is compressed by columns, a fraction of its shuffled rows.
"""

from __future__ import annotations

import uuid
from collections.abc import Iterator, Sequence
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession

from ..session import fresh_path
from .bucketed import write_bucketed

CODEC = "zstd"
_CLEANUP = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


@contextmanager
def shuffles_released(spark: SparkSession) -> Iterator[None]:
    """Each query that runs inside leaves no shuffle files behind; otherwise they stay until the driver collects garbage."""
    before = spark.conf.get(_CLEANUP, None)
    spark.conf.set(_CLEANUP, "true")
    try:
        yield
    finally:
        if before is None:
            spark.conf.unset(_CLEANUP)
        else:
            spark.conf.set(_CLEANUP, before)


class Steps:
    """Written steps of one job, below the shared folder.

    They stay for the caller's lazy result, unless dropped by name or all together.
    """

    def __init__(self, spark: SparkSession, name: str):
        self.spark, self.name = spark, f"{name}_{uuid.uuid4().hex}"
        self.root = fresh_path(spark, name)
        self.tables: set[str] = set()

    def write(self, name: str, df: DataFrame) -> DataFrame:
        with shuffles_released(self.spark):
            df.write.option("compression", CODEC).parquet(f"{self.root}/{name}")
        return self.spark.read.schema(df.schema).parquet(f"{self.root}/{name}")

    def write_by(self, name: str, df: DataFrame, keys: Sequence[str], order: Sequence[str]) -> DataFrame:
        """Dealt by ``keys`` to as many buckets as there are shuffle partitions: a join on them needs no shuffle then."""
        self.tables.add(name)
        buckets = int(self.spark.conf.get("spark.sql.shuffle.partitions"))
        with shuffles_released(self.spark):
            return write_bucketed(df, f"{self.name}_{name}", keys, buckets, f"{self.root}/{name}", order, CODEC)

    def drop(self, *names: str) -> None:
        """Remove steps that no later one reads."""
        hadoop = self.spark._jvm.org.apache.hadoop.fs
        for name in names:
            if name in self.tables:
                self.spark.sql(f"DROP TABLE IF EXISTS {self.name}_{name}")
                self.tables.remove(name)
            path = hadoop.Path(f"{self.root}/{name}")
            path.getFileSystem(self.spark._jsc.hadoopConfiguration()).delete(path, True)

    def clear(self) -> None:
        self.drop(*self.tables)
        path = self.spark._jvm.org.apache.hadoop.fs.Path(self.root)
        path.getFileSystem(self.spark._jsc.hadoopConfiguration()).delete(path, True)
