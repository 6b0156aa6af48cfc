"""Removal of lines that spread over many sites, by mergeable distinct-count sketches."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from martloom.llm.common import Scratch
from martloom.operators.skew import key_hash

# The blank characters that may surround a line.
BLANK = " \t\r\f\x0b"


def _split(text: Column) -> Column:
    return F.split(F.coalesce(text, F.lit("")), "\n", -1)


def _key() -> Column:
    """Joins on it as well can split a very common line between tasks, see :mod:`martloom.operators.skew`."""
    return key_hash(F.col("a"), F.col("b")).alias("key")


def line_places(
    docs: DataFrame, id_col: str, text_col: str, site_col: str, min_words: int
) -> DataFrame:
    """(a, b, id, h, at, site) per line of ``min_words`` words or more: 128-bit key, row, place."""
    # the hash of a text is taken once, before its lines become rows
    rows = docs.where(F.col(id_col).isNotNull()).select(
        F.col(id_col).alias("id"),
        F.xxhash64(F.col(text_col)).alias("h"),
        F.col(site_col).cast("string").alias("site"),
        _split(F.col(text_col)).alias("lines"),
    )
    lines = rows.select("id", "h", "site", F.posexplode("lines").alias("at", "raw"))
    lines = lines.select("id", "h", "site", "at", F.btrim("raw", F.lit(BLANK)).alias("line"))
    lines = lines.where(F.size(F.split("line", r"[\x20\x09-\x0D]+")) >= min_words)
    return lines.where("line <> ''").select(
        F.xxhash64("line").alias("a"), F.xxhash64("line", F.lit(1)).alias("b"),
        "id", "h", "at", "site",
    )


def spread_lines(
    places: DataFrame, min_sites: int, *, lg_k: int = 12, band: float = 0.15
) -> DataFrame:
    """(a, b, first) of the lines found on at least ``min_sites`` sites; first: lowest (id, at).

    One HyperLogLog sketch of sites per line, merged by aggregation. An estimate further
    than ``band`` from the threshold decides (about nine standard errors for lg_k = 12); a line
    nearer to it gets an exact distinct count. A null site counts as no site.
    """
    spread = places.groupBy("a", "b").agg(
        F.count("*").alias("n"),
        F.hll_sketch_agg("site", lg_k).alias("sketch"),
        F.min(F.struct("id", "h", "at")).alias("first"),
    )
    spread = spread.where(F.col("n") >= min_sites).select(
        "a", "b", "first", F.hll_sketch_estimate("sketch").alias("sites")
    )
    spread = spread.where(F.col("sites") >= min_sites * (1 - band))
    sure = F.col("sites") > min_sites * (1 + band)
    near = spread.where(~sure).select("a", "b", _key())
    exact = (
        places.where("site is not null")
        .withColumn("key", _key())
        .join(near, ["a", "b", "key"])
        .groupBy("a", "b", "site")
        .agg(F.lit(1).alias("one"))
        .groupBy("a", "b")
        .agg(F.count("*").alias("exact"))
    )
    decided = spread.join(exact, ["a", "b"], "left")
    return decided.where(sure | (F.col("exact") >= min_sites)).select("a", "b", "first")


def drop_spread_lines(
    docs: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    site_col: str = "source",
    *,
    min_sites: int = 10,
    min_words: int = 1,
    removed_col: str = "n_removed",
) -> DataFrame:
    """``docs`` without cross-site boilerplate lines, and how many lines each row lost.

    Every line with a word counts (``min_words`` can leave shorter ones out). A line, trimmed of blanks, on ``min_sites`` sites or more
    stays only at its first place, by id and position, so its content is not lost to the corpus.
    Nothing is lowered or folded: lines are equal if their characters are. No row is dropped; a
    text may become empty. Null and empty texts are unchanged, as are rows with a null id.
    Rows that repeat an id and text are treated alike; the first place is then in each of them.
    All columns of ``docs`` are kept; an existing ``removed_col`` is replaced.
    """
    places = Scratch(docs.sparkSession, "lines").write(
        line_places(docs, id_col, text_col, site_col, min_words)
    )
    lines = spread_lines(places, min_sites)
    here = F.struct("id", "h", "at")
    gone = (
        places.withColumn("key", _key())
        .join(lines.withColumn("key", _key()), ["a", "b", "key"])
        .where(here != F.col("first"))
        .groupBy(F.col("id").alias("__id"), F.col("h").alias("__h"))
        .agg(F.collect_set("at").alias("__gone"))
    )
    text = F.col(text_col)
    # the short side is hashed, so that texts need not be sorted
    joined = docs.join(
        gone.hint("shuffle_hash"), (docs[id_col] == F.col("__id")) & (F.xxhash64(text) == F.col("__h")), "left"
    )
    every = F.sequence(F.lit(0), F.size(_split(text)) - 1)
    left = F.transform(
        F.array_except(every, F.col("__gone")), lambda i: F.element_at(F.col("__lines"), i + 1)
    )
    joined = joined.withColumn("__lines", F.when(F.col("__gone").isNotNull(), _split(text)))
    return (
        joined.withColumn(removed_col, F.coalesce(F.size("__gone"), F.lit(0)).cast("long"))
        .withColumn(text_col, F.when(F.col("__gone").isNull(), text).otherwise(F.array_join(left, "\n")))
        .drop("__id", "__h", "__gone", "__lines")
    )
