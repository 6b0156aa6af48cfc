"""Matching by date ranges.

Each join here has equality keys besides the range. For a key that holds a large share of
all rows that is not enough: comparing every event of the key with every record of the key
grows with the square of the group. Dates are therefore cut into buckets that become part of
the join key, and where only existence matters each bucket is reduced to its first and last
date beforehand.
"""

from __future__ import annotations

import datetime as dt
from collections.abc import Mapping, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from .joins import DimJoin, enrich, semi_by_hash
from .ordered import number_and_lag
from .skew import key_hash

_EPOCH = dt.date(1970, 1, 1)


def _bucket(day: Column, width: int) -> Column:
    return F.floor(F.datediff(day, F.lit(_EPOCH)) / F.lit(width)).cast("int")


def _equal(left: DataFrame, right: DataFrame, on: Sequence[str], *more: Column) -> Column:
    return reduce(lambda a, b: a & b, [*[left[k] == right[f"__{k}"] for k in on], *more])


def within_days_flag(
    events: DataFrame,
    records: DataFrame,
    on: Sequence[str],
    event_date: str,
    record_date: str,
    days: int,
    name: str = "matched",
) -> DataFrame:
    """Mark events that have a record of the same keys in ``[event, event + days]``.

    With buckets of ``days + 1`` days the range always ends in the bucket after the event's
    own. Hence a record lies in it exactly if the last record of the own bucket is not
    before the event, or the first of the next bucket is not past the end. The join meets at
    most one row per event and never pairs events with records.
    """
    width = days + 1
    day, slot = F.to_date(record_date), F.col("__slot")
    by_bucket = records.select(*[F.col(k).alias(f"__{k}") for k in on], day.alias("__day")).filter(
        F.col("__day").isNotNull()
    )
    none = F.lit(None).cast("date")
    own = _bucket(F.col("__day"), width)
    reach = (
        by_bucket.withColumn(
            "__slot",
            F.explode(
                F.array(
                    F.struct(
                        own.alias("b"), F.col("__day").alias("last"), none.alias("first")
                    ),
                    F.struct((own - 1).alias("b"), none.alias("last"), F.col("__day").alias("first")),
                )
            ),
        )
        .groupBy(*[f"__{k}" for k in on], slot["b"].alias("__bucket"))
        .agg(F.max(slot["last"]).alias("__last"), F.min(slot["first"]).alias("__first"))
    )
    start = F.to_date(event_date)
    placed = events.withColumn("__at", start).withColumn("__own", _bucket(start, width))
    found = F.coalesce(F.col("__last") >= F.col("__at"), F.lit(False)) | F.coalesce(
        F.col("__first") <= F.date_add("__at", days), F.lit(False)
    )
    placed = placed.withColumn("__h", key_hash(*[placed[k] for k in on], placed["__own"]))
    reach = reach.withColumn("__rh", key_hash(*[reach[f"__{k}"] for k in on], reach["__bucket"]))
    match = _equal(
        placed,
        reach,
        on,
        placed["__own"] == reach["__bucket"],
        placed["__h"] == reach["__rh"],
    )
    return placed.join(reach, match, "left").select(
        *[placed[c] for c in events.columns], found.alias(name)
    )


def _splits(records: DataFrame, keys: Sequence[str], most_rows: int) -> DataFrame:
    """(keys, __n): into how many parts the records of a key are cut, for those with over ``most_rows`` of them.

    Counted in the map tasks first, so a hot key costs a row per task. There are at most as many rows as
    all records divided by ``most_rows``.
    """
    counted = records.groupBy(*keys).agg(F.count(F.lit(1)).alias("__rows"))
    parts = F.ceil(F.col("__rows") / F.lit(most_rows)).cast("int")
    return counted.filter(F.col("__rows") > most_rows).select(*keys, parts.alias("__n"))


def _with_splits(df: DataFrame, splits: DataFrame, keys: Sequence[str]) -> DataFrame:
    """``df`` with ``__n`` parts of its key; the hash lets a hot key be split in this join too."""
    names = [f"__k{i}" for i in range(len(keys))]
    side = splits.select(*[F.col(k).alias(n) for k, n in zip(keys, names)], "__n")
    side = side.withColumn("__h", key_hash(*[F.col(n) for n in names]))
    # by name: the splits were counted on one of the tables that they are joined to
    same = [F.col(k).eqNullSafe(F.col(n)) for k, n in zip(keys, names)]
    match = reduce(lambda x, y: x & y, [key_hash(*[F.col(k) for k in keys]) == F.col("__h"), *same])
    return df.join(side, match, "left").select(*df.columns, F.coalesce("__n", F.lit(1)).alias("__n"))


def within_days_join(
    left: DataFrame,
    right: DataFrame,
    on: Sequence[str],
    left_date: str,
    right_date: str,
    days: int,
    how: str = "inner",
    most_rows: int | None = None,
) -> DataFrame:
    """Pair rows of equal keys whose right date lies in ``[left, left + days]``.

    "semi" and "anti" return left rows only and emit no pairs. For pairs, collapse the right
    side to one row per key and day where its single rows are not needed: each left row then
    meets at most ``days + 1`` rows however often the key occurs. Right columns must not
    share names with the left ones, apart from ``on``.

    ``most_rows`` is for keys that hold a large share of all rows on both sides: the right rows of a (key, bucket) with more
    rows than that are cut into parts by a hash of the row, left rows of that bucket are copied to just these
    parts, and the part joins the key. Buckets are counted first; all others stay in one part and are
    not copied. Without it, adaptive execution splits a hot key on either side.
    """
    if how in ("semi", "anti"):
        flagged = within_days_flag(left, right, on, left_date, right_date, days, "__matched")
        return flagged.filter(F.col("__matched") == (how == "semi")).drop("__matched")
    if how not in ("inner", "left"):
        raise ValueError(f"unknown how: {how}")
    width = days + 1
    extra = [c for c in right.columns if c not in on]
    own = _bucket(F.to_date(right_date), width)
    spread = right.withColumn("__bucket", F.explode(F.array(own, own - 1))).select(
        *[F.col(k).alias(f"__{k}") for k in on], *extra, "__bucket"
    )
    start = F.to_date(left_date)
    placed = left.withColumn("__own", _bucket(start, width))
    cut = []
    if most_rows is not None:
        if how == "left":
            # copies of a left row without a match would all stay, so these rows are found apart
            paired = within_days_join(left, right, on, left_date, right_date, days, "inner", most_rows)
            alone = within_days_join(left, right, on, left_date, right_date, days, "anti")
            return paired.unionByName(alone, allowMissingColumns=True)
        places = [*[f"__{k}" for k in on], "__bucket"]
        splits = _splits(spread, places, most_rows)
        spread = _with_splits(spread, splits, places)
        part = F.pmod(F.xxhash64(*extra), F.col("__n"))
        spread = spread.withColumn("__part", part).drop("__n")
        renamed = splits.select(*[F.col(p).alias(k) for p, k in zip(places, [*on, "__own"])], "__n")
        placed = _with_splits(placed, renamed, [*on, "__own"])
        placed = placed.withColumn("__copy", F.explode(F.sequence(F.lit(0), F.col("__n") - 1))).drop("__n")
        cut = [F.col("__copy") == F.col("__part")]
    spread = spread.withColumnRenamed(right_date, "__date")
    at, other = F.to_date(left_date), F.to_date("__date")
    theirs = [F.col(f"__{k}") for k in on]
    # the right side may come aggregated by its keys
    same = key_hash(*[F.col(k) for k in on], F.col("__own")) == key_hash(*theirs, F.col("__bucket"))
    match = [F.col(k) == t for k, t in zip(on, theirs)]
    match += [F.col("__own") == F.col("__bucket"), same, *cut, other.between(at, F.date_add(at, days))]
    joined = placed.join(spread, reduce(lambda x, y: x & y, match), how)
    return joined.select(
        *left.columns, *[F.col("__date" if c == right_date else c).alias(c) for c in extra]
    )


def anti_within_days(
    reported: DataFrame,
    events: DataFrame,
    records: DataFrame,
    on: Sequence[str],
    event_date: str,
    record_date: str,
    days: int,
    id_col: str,
    null_aware: bool = False,
) -> DataFrame:
    """Reported events whose id is not among the events matched by a record within ``days``.

    ``events`` is the whole history: an id counts as matched through any of its events. Only
    the history of reported ids is matched. ``null_aware`` follows SQL ``NOT IN``: one
    matched NULL id leaves nothing, and a reported NULL id stays only if nothing matched;
    whether a reported row has no id is looked up once, while the plan is made.
    """
    ids = reported.select(F.col(id_col).alias("__id")).distinct()
    relevant = semi_by_hash(events, ids, {id_col: "__id"}, "left_semi")
    matched = within_days_join(relevant, records, on, event_date, record_date, days, "semi").select(
        F.col(id_col).alias("__id")
    )
    kept = semi_by_hash(reported, matched.distinct(), {id_col: "__id"}, "left_anti")
    if not null_aware or not events.schema[id_col].nullable:
        return kept

    def any_matched(some: DataFrame) -> Column:
        # keys and days suffice, so the history shrinks to these before it is matched
        seen = some.select(*on, F.to_date(event_date).alias("__day")).distinct()
        flagged = within_days_flag(seen, records, on, "__day", record_date, days, "__m")
        return flagged.select(F.coalesce(F.bool_or("__m"), F.lit(False))).scalar()

    # Only events without an id can make the set hold a NULL; that test reaches their scan.
    kept = kept.filter(~any_matched(events.filter(F.col(id_col).isNull())))
    # The whole history matters only to a reported row without an id, which is looked for first.
    if reported.filter(F.col(id_col).isNull()).isEmpty():
        return kept
    return kept.filter(F.col(id_col).isNotNull() | ~any_matched(events))


def date_span(df: DataFrame, date_col: str) -> tuple[Column, Column]:
    """First and last date of a table, as scalar subqueries for a ``date_range``."""
    day = F.to_date(F.col(date_col))
    ends = df.select(F.struct(F.min(day).alias("lo"), F.max(day).alias("hi"))).scalar()
    return ends["lo"], ends["hi"]


def valid_at_join(
    facts: DataFrame,
    dim: DataFrame,
    on: Mapping[str, str],
    at: str,
    valid_from: str,
    valid_to: str,
    take: Mapping[str, str | Column],
    how: str = "left",
    bucket_days: int | None = None,
    date_range: tuple[dt.date | Column, dt.date | Column] | None = None,
    chunk_rows: int | None = None,
    merge: bool = False,
) -> DataFrame:
    """Attach the lookup row valid on the fact's date, both ends included.

    ``date_range``, the span of the facts' dates where known (dates, or columns such as
    :func:`date_span` gives; a wider span is harmless), drops lookup rows not valid in it; without
    it, buckets need a pass over the facts. ``bucket_days`` is for keys with very many validity rows: the rows are repeated for
    each bucket they cover within the facts' span, and the bucket joins the key, so a fact
    only meets the rows of its own bucket. ``chunk_rows`` does so by measure: only a key with more facts than that
    is cut, at dates that give it about as many in each chunk, and a lookup row is carried into the chunks it
    is open in. Rows are then repeated by the number of facts, never by the length of their validity.
    ``merge`` is for a lookup that grows with the facts, see :class:`~martloom.operators.joins.DimJoin`.
    """
    if chunk_rows is not None:
        return _chunked_valid_at(facts, dim, on, at, valid_from, valid_to, take, how, date_range, chunk_rows, merge)
    starts, ends = F.col(valid_from), F.col(valid_to)
    if date_range:
        date_range = tuple(d if isinstance(d, Column) else F.lit(d) for d in date_range)
        dim = dim.filter((starts <= date_range[1]) & (ends >= date_range[0]))
    if bucket_days is None:
        return enrich(facts, [DimJoin(dim, on, take, how, valid=(at, valid_from, valid_to), merge=merge)])
    if date_range:
        lo, hi = (_bucket(d, bucket_days) for d in date_range)
    else:
        span = facts.select(F.to_date(at).alias("d")).agg(F.min("d").alias("lo"), F.max("d").alias("hi"))
        ends_of = span.select(
            F.struct(
                _bucket(F.col("lo"), bucket_days).alias("lo"),
                _bucket(F.col("hi"), bucket_days).alias("hi"),
            )
        ).scalar()
        lo, hi = ends_of["lo"], ends_of["hi"]
    first = F.greatest(_bucket(F.to_date(starts), bucket_days), lo)
    last = F.least(_bucket(F.to_date(ends), bucket_days), hi)
    known = starts.isNotNull() & ends.isNotNull()
    spread = (
        dim.filter(known)
        .withColumns({"__first": first, "__last": last})
        .filter(F.col("__first") <= F.col("__last"))
        .withColumn("__bucket", F.explode(F.sequence("__first", "__last")))
    )
    placed = facts.withColumn("__own", _bucket(F.to_date(at), bucket_days))
    lookup = DimJoin(
        spread, {**on, "__own": "__bucket"}, take, how, valid=(at, valid_from, valid_to), merge=merge
    )
    return enrich(placed, [lookup]).drop("__own")


def chunk_starts(facts: DataFrame, keys: Sequence[str], at: str, chunk_rows: int) -> DataFrame:
    """(keys, __starts): the first dates of a key's second and later chunks, for keys with over ``chunk_rows`` facts.

    A chunk holds about ``chunk_rows`` facts, more where a single day does. Facts are counted per key and day in the map
    tasks, so the running sum meets at most a row per key and day.
    """
    days = facts.groupBy(*keys, F.to_date(at).alias("__day")).agg(F.count(F.lit(1)).alias("__facts"))
    order = W.partitionBy(*keys).orderBy("__day")
    before = F.sum("__facts").over(order) - F.col("__facts")
    days = days.filter(F.col("__day").isNotNull()).withColumn("__chunk", F.floor(before / F.lit(chunk_rows)))
    starts = days.groupBy(*keys, "__chunk").agg(F.min("__day").alias("__start"))
    later = starts.filter(F.col("__chunk") > 0).groupBy(*keys)
    return later.agg(F.array_sort(F.collect_list("__start")).alias("__starts"))


def _chunked_valid_at(facts, dim, on, at, valid_from, valid_to, take, how, date_range, chunk_rows, merge) -> DataFrame:
    starts, ends = F.to_date(valid_from), F.to_date(valid_to)
    dim = dim.filter(starts.isNotNull() & ends.isNotNull() & (starts <= ends))
    if date_range:
        lo, hi = (d if isinstance(d, Column) else F.lit(d) for d in date_range)
        dim = dim.filter((F.col(valid_from) <= hi) & (F.col(valid_to) >= lo))
    cuts = chunk_starts(facts, list(on), at, chunk_rows)

    def chunk(day: Column) -> Column:
        """How many later chunks have begun by the day; 0 for keys that are not cut."""
        return F.coalesce(F.size(F.filter("__starts", lambda s: s <= day)), F.lit(0))

    placed = enrich(facts, [DimJoin(cuts, {k: k for k in on}, {"__starts": "__starts"}, split=True)])
    placed = placed.withColumn("__own", F.when(F.col("__starts").isNull(), 0).otherwise(chunk(F.to_date(at))))
    known = enrich(dim, [DimJoin(cuts, dict(zip(on.values(), on)), {"__starts": "__starts"}, split=True)])
    cut = F.col("__starts").isNotNull()
    first, last = (F.when(cut, chunk(d)).otherwise(0) for d in (starts, ends))
    known = known.withColumn("__chunk", F.explode(F.sequence(first, last)))
    lookup = DimJoin(known, {**on, "__own": "__chunk"}, take, how, valid=(at, valid_from, valid_to), merge=merge)
    return enrich(placed, [lookup]).drop("__own", "__starts")


def open_interval_join(
    facts: DataFrame,
    dim: DataFrame,
    on: Mapping[str, str],
    at: str,
    start: str,
    start_default: str,
    end: str,
    end_default: str,
    take: Mapping[str, str | Column],
    how: str = "left",
    bucket_days: int | None = None,
    date_range: tuple[dt.date | Column, dt.date | Column] | None = None,
    chunk_rows: int | None = None,
    merge: bool = False,
) -> DataFrame:
    """``valid_at_join`` over intervals whose open ends fall back to other columns."""
    closed = dim.withColumns(
        {
            "__from": F.coalesce(F.col(start), F.col(start_default)),
            "__until": F.coalesce(F.col(end), F.col(end_default)),
        }
    )
    return valid_at_join(
        facts, closed, on, at, "__from", "__until", take, how, bucket_days, date_range, chunk_rows, merge
    )


def change_intervals(
    df: DataFrame,
    key: str,
    change_date: str,
    tie_break: Sequence[str] = (),
    name: str = "start_dt",
    chunk: Column | None = None,
) -> DataFrame:
    """Start of the interval each change ends: the day after the key's previous change.

    The row without a change date is the open last interval, so it sorts last. ``chunk``
    splits keys with very many changes, see :mod:`martloom.operators.ordered`.
    """
    return number_and_lag(
        df,
        [key],
        [change_date, *tie_break],
        lags={name: F.date_add(F.to_date(change_date), 1)},
        chunk=chunk,
    )
