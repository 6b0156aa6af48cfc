"""Row order within a key: running numbers and the value of the preceding row.

A plain window puts every row of one key into one task. That is right while a key holds
a bounded number of rows (one per day or month). For keys without such a bound the
``chunk`` argument names a column that never decreases along the order (its day, say): the
window then runs per (key, chunk). An aggregate, combined in the map tasks, finds the size
and last row of every chunk; what came before a chunk is put in front of it as one extra
row. The rows themselves are shuffled once, and a key with a third of all rows is spread
over as many groups as it has chunks.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

_CHUNK, _SIZE, _LAST, _HEAD, _SKIP, _OWN = (
    "__chunk", "__size", "__last", "__head", "__skip", "__own",
)


def sort_ascending(names: Sequence[str]) -> list[Column]:
    """Ascending with NULLs last, the order all series operators use."""
    return [F.col(n).asc_nulls_last() for n in names]


def number_and_lag(
    df: DataFrame,
    keys: Sequence[str],
    order: Sequence[str],
    seq: str | None = None,
    lags: Mapping[str, Column] | None = None,
    chunk: Column | None = None,
) -> DataFrame:
    """Add a running number ``seq`` and, per entry of ``lags``, the preceding row's value."""
    lags = dict(lags or {})
    ranks = sort_ascending(order)
    if chunk is None:
        w = W.partitionBy(*keys).orderBy(*ranks)
        added = {name: F.lag(col).over(w) for name, col in lags.items()}
        if seq:
            added[seq] = F.row_number().over(w)
        return df.withColumns(added)

    own = F.struct(F.lit(1).alias("any"), *[col.alias(name) for name, col in lags.items()])
    body = df.withColumns({_CHUNK: chunk, _OWN: own})
    # NULLs sort last, so they are the greatest
    place = F.struct(
        *[x for i, c in enumerate(order) for x in (F.col(c).isNull().alias(f"n{i}"), F.col(c))]
    )
    before = W.partitionBy(*keys).orderBy(F.col(_CHUNK).asc_nulls_last())
    heads = (
        body.groupBy(*keys, _CHUNK)
        .agg(F.count(F.lit(1)).alias(_SIZE), F.max_by(_OWN, place).alias(_LAST))
        .select(
            *keys,
            _CHUNK,
            F.sum(_SIZE).over(before.rowsBetween(W.unboundedPreceding, -1)).alias(_SKIP),
            F.lag(_LAST).over(before).alias(_OWN),
            F.lit(True).alias(_HEAD),
        )
    )
    both = body.withColumn(_HEAD, F.lit(False)).unionByName(heads, allowMissingColumns=True)
    w = W.partitionBy(*keys, _CHUNK).orderBy(F.col(_HEAD).desc(), *ranks)
    added = {name: F.lag(_OWN).over(w)[name] for name in lags}
    if seq:
        skipped = F.coalesce(F.first(_SKIP).over(w), F.lit(0))
        added[seq] = F.row_number().over(w) - F.lit(1) + skipped
    out = both.withColumns(added).filter(~F.col(_HEAD))
    return out.select(*df.columns, *[name for name in added if name not in df.columns])


def sort_by_known(
    df: DataFrame, order: Sequence[str], known: DataFrame, partitions: int | None = None, sample: int = 20_000
) -> DataFrame:
    """``df`` sorted by ``order``, ascending, with the ranges taken from ``known`` values of the first column.

    A global sort runs everything below it once more to sample its ranges. Where the values of the leading column are
    known beforehand (the articles of a calendar), a hash sample of about ``sample`` of them gives the bounds instead, and
    the rows are dealt to the ranges in one shuffle. Bounds only balance the work: values that are not known are sorted
    like the others, and NULLs come last. Rows of one leading value stay together.
    """
    lead = order[0]
    partitions = partitions or int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    values = known.select(F.col(lead).alias("v")).filter(F.col("v").isNotNull()).distinct()
    every = max(1, values.count() // sample)
    some = sorted(r["v"] for r in values.filter(F.pmod(F.xxhash64("v"), F.lit(every)) == 0).collect())
    bounds = sorted({some[len(some) * i // partitions] for i in range(1, partitions)}) if some else []
    if bounds:
        below = F.size(F.filter(F.array(*[F.lit(b) for b in bounds]), lambda b: b <= F.col(lead)))
        place = F.when(F.col(lead).isNull(), len(bounds)).otherwise(below)
    else:
        place = F.lit(0)
    return df.repartitionById(len(bounds) + 1, place.cast("int")).sortWithinPartitions(*sort_ascending(order))
