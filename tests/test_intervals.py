"""Hot keys in range joins: measured replication and measured chunks, against brute force and task by task."""

import datetime as dt
import random

import pytest
from pyspark.sql import functions as F

from martloom.operators import intervals
from martloom.operators.intervals import chunk_starts, valid_at_join, within_days_join

START = dt.date(2024, 1, 1)


def day(n):
    return START + dt.timedelta(days=n)


def rows(df):
    return sorted((tuple(r) for r in df.collect()), key=repr)


@pytest.fixture(scope="module")
def sides(spark):
    """A third of either side on one key; null keys and null dates among them."""
    rng = random.Random(6)

    def side(n):
        keys = [1 if i % 3 == 0 else rng.choice([*range(2, 40), None]) for i in range(n)]
        return [(k, rng.choice([None, *[day(d) for d in range(60)]]), i) for i, k in enumerate(keys)]

    left, right = side(500), side(400)
    return left, right, spark.createDataFrame(left, "k int, d date, a int"), spark.createDataFrame(right, "k int, e date, b int")


@pytest.mark.parametrize("how", ["inner", "left", "semi", "anti"])
@pytest.mark.parametrize("most_rows", [None, 5, 100_000])
def test_pairs_equal_brute_force(sides, how, most_rows):
    left, right, a, b = sides
    found = {}
    for k, d, x in left:
        found[k, d, x] = [
            (e, y) for k2, e, y in right if None not in (k, d, e) and k == k2 and 0 <= (e - d).days <= 9
        ]
    want = []
    for row, pairs in found.items():
        if how == "inner" or how == "left" and pairs:
            want += [(*row, *p) for p in pairs]
        elif how == "left":
            want.append((*row, None, None))
        elif (how == "semi") == bool(pairs):
            want.append(row)
    assert rows(within_days_join(a, b, ["k"], "d", "e", 9, how, most_rows)) == sorted(want, key=repr)


def _rows_per_task(joined):
    counts = joined.groupBy(F.spark_partition_id().alias("p")).count().collect()
    return sorted(r["count"] for r in counts)


def test_no_task_joins_the_whole_hot_key(spark):
    """A third of all rows on one key and day: cut, every task gets its share without adaptive execution."""
    names = ("spark.sql.adaptive.enabled", "spark.sql.autoBroadcastJoinThreshold", "spark.sql.shuffle.partitions")
    before = {n: spark.conf.get(n) for n in names}
    for n, v in zip(names, ("false", "-1", "32")):
        spark.conf.set(n, v)
    try:
        hot = F.when(F.col("id") % 3 == 0, F.lit(7)).otherwise(F.xxhash64("id") % 3000)
        left = spark.range(6_000).select(hot.alias("k"), F.lit(day(0)).alias("d"), "id")
        right = spark.range(900).select(hot.alias("k"), F.lit(day(1)).alias("e"), F.col("id").alias("other"))
        whole = within_days_join(left, right, ["k"], "d", "e", 9)
        split = within_days_join(left, right, ["k"], "d", "e", 9, most_rows=2)
        total = whole.count()
        assert total >= 2000 * 300 and split.count() == total
        assert _rows_per_task(whole)[-1] >= 0.9 * total
        tasks = _rows_per_task(split)
        assert len(tasks) >= 24 and tasks[-1] <= 5 * tasks[len(tasks) // 2]
    finally:
        for n, v in before.items():
            spark.conf.set(n, v)


@pytest.fixture(scope="module")
def validity(spark):
    rng = random.Random(7)
    facts = [(1 if i % 3 == 0 else rng.randint(2, 30), rng.choice([None, *[day(d) for d in range(90)]]), i) for i in range(600)]
    spans = []
    for i in range(300):
        k, a = (1 if i % 3 == 0 else rng.randint(2, 30)), rng.randint(-5000, 100)
        spans.append((k, day(a), rng.choice([None, day(a + rng.randint(-3, 40)), dt.date(2099, 12, 31)]), i))
    return facts, spans, spark.createDataFrame(facts, "k int, d date, a int"), spark.createDataFrame(spans, "k int, f date, t date, b int")


@pytest.mark.parametrize("how", ["inner", "left"])
@pytest.mark.parametrize("chunk_rows", [1, 20, 100_000])
def test_validity_equals_brute_force(validity, how, chunk_rows):
    facts, spans, a, b = validity
    want = []
    for k, d, x in facts:
        hits = [y for k2, f, t, y in spans if k == k2 and None not in (d, t) and f <= d <= t]
        want += [(k, d, x, y) for y in hits] or ([(k, d, x, None)] if how == "left" else [])
    out = valid_at_join(a, b, {"k": "k"}, "d", "f", "t", {"b": "b"}, how, chunk_rows=chunk_rows)
    assert rows(out) == sorted(want, key=repr)
    limited = valid_at_join(
        a, b, {"k": "k"}, "d", "f", "t", {"b": "b"}, how, chunk_rows=chunk_rows, date_range=(day(0), day(89))
    )
    assert rows(limited) == sorted(want, key=repr)


def test_long_validity_does_not_multiply_rows(spark, validity, monkeypatch):
    """Rows of the lookup after its explode: as many for spans of a century as for spans of a month."""
    facts = validity[2]
    seen = []
    real = intervals.enrich

    def watch(df, dims):
        seen.append(dims[0].dim)
        return real(df, dims)

    monkeypatch.setattr(intervals, "enrich", watch)
    counts = []
    for years in (1, 100):
        dim = spark.range(200).select(
            (F.col("id") % 30).cast("int").alias("k"), F.lit(day(-400)).alias("f"),
            F.lit(day(100 + 365 * years)).alias("t"), F.col("id").alias("b"),
        )
        valid_at_join(facts, dim, {"k": "k"}, "d", "f", "t", {"b": "b"}, chunk_rows=50).count()
        counts.append(seen[-1].count())
    assert counts[0] == counts[1] <= 200 + 7 * (200 // 30 + 1)  # only key 1 is cut, into some four chunks
    assert chunk_starts(facts, ["k"], "d", 50).count() == 1
