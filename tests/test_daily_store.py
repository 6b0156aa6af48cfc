"""Daily counts and their windows: late days, emptied days, what a refresh reads and replaces; mergeable sketches."""

import datetime as dt
import random

import pytest
from pyspark.sql import functions as F

from martloom.operators.daily_store import DailyStore
from martloom.operators.rolling import category_sketches, roll_categories, rolling_distinct
from martloom.sources import published_parts

KINDS = {"clicks": "click", "errors": "error"}


def day(n):
    return dt.date(2024, 1, 1) + dt.timedelta(days=n)


def rows(df):
    return sorted((tuple(r) for r in df.collect()), key=repr)


@pytest.fixture
def store(tmp_path):
    return DailyStore(str(tmp_path / "store"), "day", ["u"], 7, "pairs", KINDS, "kind")


def made(spark, seed, n=400, spread=30):
    rng = random.Random(seed)
    data = [(day(rng.randrange(spread)), rng.choice([None, *range(25)]), rng.choice(["click", "error", "view"])) for _ in range(n)]
    return spark.createDataFrame(data, "day date, u int, kind string")


def full(events):
    return rolling_distinct(events, "day", ["u"], 7, name="pairs", categories=KINDS, category_col="kind")


def test_a_late_day_remakes_its_week_alone(spark, store):
    old, late = made(spark, 1), made(spark, 2, 60).filter(F.col("day") == day(12))
    store.refresh(old, [day(i) for i in range(30)])
    assert rows(store.windows(spark)) == rows(full(old))
    before = published_parts(spark, f"{store.target}/windows"), published_parts(spark, f"{store.target}/daily")
    both = old.union(late)
    store.refresh(both, [day(12)])
    assert rows(store.windows(spark)) == rows(full(both)) != rows(full(old))
    after = published_parts(spark, f"{store.target}/windows"), published_parts(spark, f"{store.target}/daily")
    moved = [{k for k in b if a.get(k) != b[k]} for a, b in zip(before, after)]
    assert moved == [{f"part={day(i)}" for i in range(12, 19)}, {f"part={day(12)}"}]


def test_only_the_changed_days_are_read(spark, store, tmp_path, monkeypatch):
    path = str(tmp_path / "events")
    made(spark, 3).write.partitionBy("day").parquet(path)
    events = spark.read.parquet(path)
    store.refresh(events, [day(i) for i in range(30)])
    read = []
    daily = DailyStore.daily
    monkeypatch.setattr(DailyStore, "daily", lambda self, s, only=None: read.extend(only) or daily(self, s, only))
    store.refresh(events, [day(12)])
    assert sorted(read) == [day(i) for i in range(6, 19)]
    plan = events.filter(F.col("day").isin(day(12)))._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(day" in plan


def test_days_without_events_are_emptied(spark, store):
    one = made(spark, 4, 5, 1)
    store.refresh(one, [day(0), day(1)])
    assert store.daily(spark).count() == 1 and store.windows(spark).count() == 7
    store.refresh(one.limit(0), [day(0)])
    assert store.daily(spark).count() == store.windows(spark).count() == 0
    store.refresh(one, [])
    assert store.windows(spark, [day(0)]).count() == 0


def test_sketches_of_parts_unite_to_the_sketch_of_all(spark):
    events = made(spark, 5, 4000, 10).withColumn("u", F.col("u") + 25 * F.pmod(F.hash("u", "kind"), F.lit(1000)))
    whole = roll_categories(category_sketches(events, "day", "u", KINDS, "kind"), "day", list(KINDS), 7)
    halves = [events.filter(F.pmod(F.hash("u"), F.lit(2)) == i) for i in (0, 1)]
    parts = [category_sketches(h, "day", "u", KINDS, "kind") for h in halves]
    merged = roll_categories(parts[0].union(parts[1]), "day", list(KINDS), 7)

    def counts(df):
        return rows(df.select("day", *[F.theta_sketch_estimate(k) for k in KINDS]))

    assert counts(whole) == counts(merged)
