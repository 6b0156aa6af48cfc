"""Quality rules with limits learned per language and source from mergeable quantile sketches."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import Window

from martloom.llm.common import Scratch, words

# Measures judged, as whole numbers: (name, expression over the base columns, whether a lower limit
# holds too). Shares are in units of 1 / 10000.
MEASURES = (
    ("symbols", "10000 * n_symbols div word_chars", False),
    ("dup_lines", "10000 * n_dup_lines div n_lines", False),
    ("repeats", "10000 * n_repeat_words div n_words", False),
    ("word_length", "100 * word_chars div n_words", True),
)
SUB_BITS = 8  # a sketch bin is narrower than 1/128 of its values; values below 256 have their own
TAIL = 20  # an upper limit on a share rejects at most one row in so many of the group it was learned from


def _window_hashes(w: Column) -> Column:
    """64-bit hashes of all 3-word windows of the array ``w``; null if it has none."""
    n = F.size(w)
    zipped = F.arrays_zip(
        w.alias("p"), F.slice(w, F.lit(2), n).alias("q"), F.slice(w, F.lit(3), n).alias("r")
    )
    hashes = F.transform(F.slice(zipped, F.lit(1), n - 2), lambda x: F.xxhash64(x["p"], x["q"], x["r"]))
    return F.when(n >= 3, hashes)


def _with_repeats(rows: DataFrame) -> DataFrame:
    """n_repeat_words from ``h``, the hashes of all windows: positions under repeated windows.

    Step by step, so that each array is made once; all steps are null for texts without repeats.
    """
    repeated = F.size("h") > F.size(F.array_distinct("h"))
    rows = rows.withColumn("h", F.when(repeated, F.col("h")))
    order = F.arrays_zip(F.col("h").alias("h"), F.sequence(F.lit(0), F.size("h") - 1).alias("at"))
    rows = rows.withColumn("order", F.array_sort(order)).drop("h")
    rows = rows.withColumn("h", F.col("order.h")).withColumn("at", F.col("order.at")).drop("order")
    n, edge = F.size("h"), F.array(F.lit(None).cast("long"))
    near = F.arrays_zip(
        F.col("h").alias("h"),
        F.concat(edge, F.slice("h", F.lit(1), n - 1)).alias("before"),
        F.concat(F.slice("h", F.lit(2), n - 1), edge).alias("after"),
        F.col("at").alias("at"),
    )
    again = F.filter(
        near, lambda x: x["h"].eqNullSafe(x["before"]) | x["h"].eqNullSafe(x["after"])
    )
    rows = rows.withColumn("at", F.array_sort(again["at"])).drop("h")
    steps = F.zip_with(
        F.slice("at", F.lit(2), F.size("at")), F.slice("at", F.lit(1), F.size("at") - 1),
        lambda b, a: F.least(b - a, F.lit(3)),
    )
    covered = F.aggregate(steps, F.lit(3), lambda total, x: total + x)
    return rows.withColumn("n_repeat_words", F.coalesce(covered, F.lit(0)).cast("long")).drop("at")


def base_measures(docs: DataFrame, id_col: str, text_col: str, keys: list[str]) -> DataFrame:
    """(id, keys, n_words, word_chars, n_symbols, n_lines, n_dup_lines, n_repeat_words)."""
    text = F.coalesce(F.col(text_col).cast("string"), F.lit(""))
    full_lines = F.filter(F.split(text, "\n", -1), lambda x: x.rlike(r"[^\x20\x09-\x0D]"))
    first = docs.select(
        F.col(id_col).alias("__id"),
        *[F.col(k).cast("string").alias(f"__{i}") for i, k in enumerate(keys)],
        words(text).alias("w"),
        full_lines.alias("l"),
        F.regexp_count(text, F.lit(r"[#*$%&|<>]")).cast("long").alias("n_symbols"),
    )
    second = first.select(
        "*",
        F.size("w").cast("long").alias("n_words"),
        F.length(F.array_join("w", "")).cast("long").alias("word_chars"),
        F.size("l").cast("long").alias("n_lines"),
        (F.size("l") - F.size(F.array_distinct("l"))).cast("long").alias("n_dup_lines"),
        _window_hashes(F.col("w")).alias("h"),
    ).drop("w", "l")
    return _with_repeats(second)


def _bin(v: Column) -> Column:
    """Lower end of the value's bin: its highest bits, the rest zero."""
    return F.expr(
        f"case when v < {1 << SUB_BITS} then v else shiftleft(shiftright(v, cast(length(bin(v)) - {SUB_BITS} as int)),"
        f" cast(length(bin(v)) - {SUB_BITS} as int)) end"
    )


def _bin_end(low: str) -> Column:
    """Last value of the bin that begins at ``low``."""
    return F.expr(
        f"case when {low} < {1 << SUB_BITS} then {low}"
        f" else {low} + shiftleft(1L, cast(length(bin({low})) - {SUB_BITS} as int)) - 1 end"
    )


def quantile_sketch(values: DataFrame, keys: list[str]) -> DataFrame:
    """(keys, measure, bin, n): a histogram with bins of bounded relative width.

    Sketches of parts of the data merge by adding the counts of equal bins, and so do
    those of sources into one of their language.
    """
    return values.withColumn("bin", _bin(F.col("v"))).groupBy(*keys, "measure", "bin").agg(
        F.count("*").alias("n")
    )


def sketch_quantiles(sketch: DataFrame, keys: list[str]) -> DataFrame:
    """(keys, measure, rows, filled, q1, q3, tail, low) from a sketch; a group has at most some thousand bins.

    ``q1`` and ``q3`` are the ends of the middle half, ``tail`` the value that one row in ``TAIL`` may exceed. ``filled``
    rows are not 0, and ``low`` is their lower quartile (null if there are none).
    """
    group = Window.partitionBy(*keys, "measure")
    counted = sketch.select(
        "*",
        F.sum("n").over(group.orderBy("bin")).alias("upto"),
        F.sum("n").over(group).alias("rows"),
        F.sum(F.when(F.col("bin") > 0, F.col("n")).otherwise(0)).over(group).alias("filled"),
    )
    upto, rows, filled = F.col("upto"), F.col("rows"), F.col("filled")
    some = (F.col("bin") > 0) & (4 * (upto - rows + filled) >= filled)
    return counted.groupBy(*keys, "measure").agg(
        F.max("rows").alias("rows"),
        F.max("filled").alias("filled"),
        F.min(F.when(4 * upto >= rows, F.col("bin"))).alias("q1"),
        F.min(F.when(4 * upto >= 3 * rows, _bin_end("bin"))).alias("q3"),
        F.min(F.when(TAIL * upto >= (TAIL - 1) * rows, _bin_end("bin"))).alias("tail"),
        F.min(F.when(some, F.col("bin"))).alias("low"),
    )


def quality_limits(sketch: DataFrame, keys: list[str], reach: int) -> DataFrame:
    """One row per group: (keys, rows, <measure>_lo, <measure>_hi), see :func:`judge_quality`."""
    out = [F.max("rows").alias("rows")]
    middle = F.col("q3") - F.col("q1")
    common = F.least(F.col("low"), F.expr(f"{TAIL} * low * filled div rows"))
    spread = F.greatest(middle, common)  # null without filled rows: the middle half decides
    for name, _, both in MEASURES:
        mine = F.col("measure") == name
        if both:
            hi = F.col("q3") + reach * middle
            lo = F.greatest(F.col("q1") - reach * middle, F.lit(0))
            out.append(F.max(F.when(mine, lo)).alias(f"{name}_lo"))
        else:
            hi = F.greatest(F.col("q3") + reach * spread, F.col("tail"))
        out.append(F.max(F.when(mine, hi)).alias(f"{name}_hi"))
    return sketch_quantiles(sketch, keys).groupBy(*keys).agg(*out)


def shrunk_limits(sketch: DataFrame, wider: list[str], keys: list[str], reach: int, prior_rows: int) -> DataFrame:
    """Limits of each group of ``keys``, drawn towards those of its wider group by ``prior_rows`` against its own rows.

    ``wider`` are the first of ``keys``; the wider group's sketch is the sum of its groups' sketches.
    """
    merged = sketch.groupBy(*wider, "measure", "bin").agg(F.sum("n").alias("n"))
    a = quality_limits(sketch, keys, reach).alias("a")
    b = quality_limits(merged, wider, reach).alias("b")
    marks = [c for c in a.columns if c not in (*keys, "rows")]
    same = F.lit(True)
    for k in wider:
        same = same & F.col(f"a.{k}").eqNullSafe(F.col(f"b.{k}"))
    drawn = [F.expr(f"(a.rows * a.{m} + {prior_rows} * b.{m}) div (a.rows + {prior_rows})").alias(m) for m in marks]
    return a.join(b, same).select(*[F.col(f"a.{k}") for k in keys], *drawn)


def judge_quality(
    docs: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    lang_col: str = "lang",
    source_col: str = "source",
    *,
    reach: int = 3,
    prior_rows: int = 100,
) -> DataFrame:
    """Base counts, the base rules' verdict and the adaptive verdict, one row per document.

    Base rules fail a text of under 50 words or with over half of its words in repeated 3-word
    windows. Texts that pass them feed one quantile sketch per measure, language and source, and all limits
    come from these sketches; none is a fixed value.

    * The mean word length is held between the group's quartiles, widened by ``reach`` interquartile ranges.
    * A share (symbols, repeated lines, words in repeated windows) may exceed the upper quartile by ``reach`` spreads.
      The spread is the interquartile range or, as most texts have a share of 0, the lower quartile of the shares
      above 0 if that is larger; where under one text in ``TAIL`` is above 0 it shrinks in proportion,
      so that what is rare in a group is judged strictly. No more than one in ``TAIL`` of a group lies beyond its own limit.
    * A source's limits are the mean of its own and its language's, weighted by its rows and ``prior_rows``, so
      small sources follow their language and large ones themselves.

    Null languages and
    sources are groups of their own; null or blank texts have no words and fail. Repeated rows are
    judged alike; other columns are ignored.
    """
    spark_keys = ["__0", "__1"]
    base = base_measures(docs, id_col, text_col, [lang_col, source_col])
    failed = (F.col("n_words") < 50) | (100 * F.col("n_repeat_words") > 50 * F.col("n_words"))
    base = base.withColumn("base_failed", failed)
    for name, how, _ in MEASURES:
        base = base.withColumn(name, F.when(~F.col("base_failed"), F.expr(how)))
    # numbers only, read by the sketches and again by the final filter
    base = Scratch(docs.sparkSession, "quality").write(base)
    stacked = F.inline(
        F.array(*[F.struct(F.lit(m[0]).alias("measure"), F.col(m[0]).alias("v")) for m in MEASURES])
    )
    values = base.where(~F.col("base_failed")).select(*spark_keys, stacked)
    sketch = quantile_sketch(values, spark_keys)
    limits = shrunk_limits(sketch, spark_keys[:1], spark_keys, reach, prior_rows)
    limits = limits.withColumnsRenamed({"__0": "k0", "__1": "k1"})
    same = base["__0"].eqNullSafe(limits["k0"]) & base["__1"].eqNullSafe(limits["k1"])
    fine = ~F.col("base_failed")
    for name, _, both in MEASURES:
        fine = fine & (F.col(name) <= F.col(f"{name}_hi"))
        if both:
            fine = fine & (F.col(name) >= F.col(f"{name}_lo"))
    return base.join(limits, same, "left").select(
        F.col("__id").alias(id_col), "n_words", "word_chars", "n_symbols", "n_dup_lines",
        "n_repeat_words", "base_failed", F.coalesce(fine, F.lit(False)).alias("kept"),
    )
