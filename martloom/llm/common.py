"""Small helpers shared by the training-data operators."""

from __future__ import annotations

import uuid
from collections.abc import Callable
from itertools import chain, islice

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from martloom.session import shared_folder

# Java pattern of a run of the six ASCII white-space characters that separate words.
SPACES = r"[\x20\x09-\x0D]+"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


class Scratch:
    """Intermediate tables, written as Parquet below ``spark.checkpoint.dir``.

    The folder is shared by all executors, so what is written there outlives any of them.
    Where the setting is unset on one machine (tests), the warehouse folder is used. ``drop`` removes a table
    that no later plan reads; the rest stays for the caller's lazy result.
    """

    def __init__(self, spark: SparkSession, name: str):
        self.spark = spark
        self.root = f"{shared_folder(spark)}/martloom-{name}-{uuid.uuid4().hex}"
        self.count = 0

    def write(self, df: DataFrame) -> DataFrame:
        path = f"{self.root}/{self.count}"
        self.count += 1
        df.write.parquet(path)
        out = self.spark.read.schema(df.schema).parquet(path)
        out.scratch_path = path
        return out

    def drop(self, df: DataFrame) -> None:
        jvm = self.spark._jvm
        path = jvm.org.apache.hadoop.fs.Path(df.scratch_path)
        path.getFileSystem(self.spark._jsc.hadoopConfiguration()).delete(path, True)


def partitions(spark: SparkSession) -> int:
    return int(spark.conf.get("spark.sql.shuffle.partitions"))


def crc_mod(key: Column, n: int) -> Column:
    """crc32 of the key's decimal text, modulo n; null for a null key."""
    return F.crc32(key.cast("string").cast("binary")) % n


def words(text: Column) -> Column:
    """Words between ASCII white space; an empty array for null."""
    return F.array_remove(F.split(F.coalesce(text, F.lit("")), SPACES), "")


class Numbers(dict):
    """Numbers for hashable things, in order of first sight: ``numbers[thing]``."""

    def __missing__(self, thing) -> int:
        self[thing] = number = len(self)
        return number


def flat_slices(values: np.ndarray, starts: np.ndarray, lengths: np.ndarray) -> np.ndarray:
    """``values[starts[i] : starts[i] + lengths[i]]`` for all i, end to end."""
    ends = np.cumsum(lengths)
    total = int(ends[-1]) if len(ends) else 0
    return values[np.repeat(starts - (ends - lengths), lengths) + np.arange(total)]


class WordTable:
    """Ids of words, each word encoded once per task; the table is emptied when it has grown large.

    ``encode`` takes a list of words and returns their ids end to end and the number of ids of each.
    """

    def __init__(self, encode: Callable[[list], tuple[np.ndarray, np.ndarray]], most_ids: int = 4_000_000):
        self.encode, self.most_ids = encode, most_ids
        self._empty()

    def _empty(self) -> None:
        self.numbers = Numbers()
        self.start, self.length, self.flat = (np.zeros(0, dtype=np.int64) for _ in range(3))

    def lookup(self, lists: pa.ListArray) -> tuple[np.ndarray, np.ndarray]:
        """Ids of all lists of words end to end, and the number of ids of each list; no list may be null."""
        if len(self.flat) + len(self.numbers) > self.most_ids:
            self._empty()
        known = len(self.numbers)
        words = lists.flatten().dictionary_encode()
        number = map(self.numbers.__getitem__, words.dictionary.to_pylist())
        at = np.fromiter(number, dtype=np.int64, count=len(words.dictionary))[words.indices.to_numpy()]
        if len(self.numbers) > known:
            flat, length = self.encode(list(islice(self.numbers, known, None)))
            start = len(self.flat) + np.cumsum(length) - length
            self.flat = np.concatenate((self.flat, flat))
            self.start, self.length = np.concatenate((self.start, start)), np.concatenate((self.length, length))
        lengths = self.length[at]
        upto = np.concatenate(([0], np.cumsum(lengths)))
        ends = lists.offsets.to_numpy()
        return flat_slices(self.flat, self.start[at], lengths), np.diff(upto[ends - ends[0]])


def end_to_end(lists: list[list[int]]) -> tuple[np.ndarray, np.ndarray]:
    """All numbers of the lists in one array, and the length of each list."""
    lengths = np.array([len(x) for x in lists], dtype=np.int64)
    return np.fromiter(chain.from_iterable(lists), dtype=np.int64, count=int(lengths.sum())), lengths
