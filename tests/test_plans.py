"""Physical plans, with broadcasting off as it would be for large tables."""

import datetime as dt
import re
import uuid

import pytest
from pyspark.sql import functions as F

from martloom.operators.aggregates import partition_total
from martloom.operators.calendar import calendar_spine
from martloom.operators.dedup import latest_per_key
from martloom.operators.intervals import anti_within_days, valid_at_join, within_days_flag
from martloom.operators.joins import DimJoin, enrich, exists_in
from martloom.operators.pivots import transpose_sum
from martloom.plans import cost_gap_fill, monthly_pnl
from martloom.plans.pnl import payment_lines, refund_lines
from martloom.queries import QUERIES
from martloom.queries.commerce_reports import pnl_tables
from martloom.sources import (
    bucket_together,
    event_day,
    footer_max,
    latest_snapshot,
    load,
    read_newest,
    trailing_days,
    window_to_max,
)

# One row per calendar day: an unpartitioned window over these stays tiny.
DAILY_WINDOWS = {"approx_distinct_daily", "rolling_spine", "rolling_users_exact"}


@pytest.fixture(scope="module")
def no_broadcast(spark):
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    yield spark
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


def formatted(df):
    mode = df.sparkSession._jvm.org.apache.spark.sql.execution.ExplainMode.fromString("formatted")
    return df._jdf.queryExecution().explainString(mode)


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_no_cross_join_and_no_python(no_broadcast, sf_dir, name):
    text = plan(QUERIES[name](no_broadcast, sf_dir))
    for bad in ("CartesianProduct", "BroadcastNestedLoopJoin", "Broadcast", "Python", "ExistingRDD"):
        assert bad not in text, bad
    unpartitioned = re.search(r"windowspecdefinition\(\S+ (ASC|DESC)", text) is not None
    assert unpartitioned == (name in DAILY_WINDOWS)


def test_latest_per_key_limits_before_the_shuffle(spark, sf_dir):
    df = latest_per_key(load(spark, sf_dir, "orders"), ["o_custkey"], ["o_orderdate"], ["o_orderkey"])
    text = plan(df)
    partial, exchange = text.index("Partial"), text.index("Exchange hashpartitioning")
    assert "WindowGroupLimit" in text and exchange < partial  # printed top down


def test_slices_reach_the_scan(spark, sf_dir):
    lines = load(spark, sf_dir, "lineitem")
    day = dt.date(1998, 6, 10)
    for df in (trailing_days(lines, "l_shipdate", day, 6, 5), event_day(lines, "l_shipdate", day)):
        assert re.search(r"PushedFilters: \[[^\]]*GreaterThanOrEqual\(l_shipdate", plan(df))
    assert "EqualTo(l_shipdate,ScalarSubquery" in formatted(latest_snapshot(lines, "l_shipdate"))
    newest = window_to_max(lines, "l_shipdate", 7)
    assert "GreaterThanOrEqual(l_shipdate,ScalarSubquery" in formatted(newest)


@pytest.mark.parametrize(
    "name, column",
    [
        ("current_month_filter", "o_orderdate"),
        ("calendar_member_filter", "o_orderdate"),
        ("union_periods", "o_orderdate"),
        ("comparison_filter", "l_quantity"),
    ],
)
def test_bounds_are_pushed(spark, sf_dir, name, column):
    pushed = re.search(r"PushedFilters: \[(.*)\]", formatted(QUERIES[name](spark, sf_dir)))[1]
    assert re.search(rf"(GreaterThan|LessThan)\w*\({column},", pushed)


def test_newest_date_comes_from_the_footers(spark, frame, tmp_path):
    path, kept = str(tmp_path / "t"), spark.conf.get("spark.sql.sources.useV1SourceList")
    days = [dt.date(2024, 1, 1 + i % 9) for i in range(90)] + [None]
    frame("d date, v int", *[(d, i) for i, d in enumerate(days)]).repartition(4).write.parquet(path)
    newest = footer_max(spark, path, "d")
    assert re.search(r"PushedAggregation: \[MAX\(d\)\]", formatted(newest)), formatted(newest)
    assert newest.first()["newest"] == dt.date(2024, 1, 9)
    assert spark.conf.get("spark.sql.sources.useV1SourceList") == kept
    rows = read_newest(spark, path, "d")
    assert rows.count() == 10 and "EqualTo(d,2024-01-09)" in plan(rows)
    frame("d date, v int", (None, 1)).write.parquet(f"{path}-empty")
    assert read_newest(spark, f"{path}-empty", "d").count() == 0


def test_columns_are_pruned(spark, sf_dir):
    text = formatted(QUERIES["distinct_rows"](spark, sf_dir))
    assert "ReadSchema: struct<l_partkey:bigint,l_suppkey:bigint>" in text


def test_transpose_shuffles_once(spark, sf_dir):
    lines = load(spark, sf_dir, "lineitem")
    wide = transpose_sum(lines, ["l_orderkey"], "l_returnflag", "l_quantity", ["A", "N", "R"])
    assert plan(wide).count("Exchange") == 1


def test_bucketed_order_facts_join_without_a_shuffle(no_broadcast, sf_dir):
    text = plan(QUERIES["three_way_bucketed"](no_broadcast, sf_dir))
    assert text.count("SortMergeJoin") == 2 and "Exchange" not in text
    assert plan(QUERIES["three_way_inner"](no_broadcast, sf_dir)).count("Exchange") >= 3


def test_bucketed_orders_reach_the_profit_and_loss(no_broadcast, sf_dir, tmp_path):
    """Payments and refunds of the report join their order inputs without a shuffle below the sums per sku."""
    t = pnl_tables(no_broadcast, sf_dir)
    names = ("order_dates", "order_quantities", "order_fees", "refund_dates", "refund_fees")
    laid = bucket_together({n: t[n] for n in names}, f"pnl_{uuid.uuid4().hex}", ["order_id", "sku"], 8, str(tmp_path))
    lines = payment_lines(laid["order_dates"], laid["order_quantities"], laid["order_fees"])
    back = refund_lines(laid["refund_dates"], laid["refund_fees"])
    assert "Exchange" not in plan(lines) and "Exchange" not in plan(back)
    whole = monthly_pnl(**(t | laid), years=range(1996, 1998))
    assert plan(whole).count("Exchange") < plan(monthly_pnl(**t, years=range(1996, 1998))).count("Exchange")
    old = payment_lines(t["order_dates"], t["order_quantities"], t["order_fees"])
    assert lines.exceptAll(old).count() == old.exceptAll(lines).count() == 0 < lines.count()


def test_ordered_report_does_not_sample_its_joins(no_broadcast, sf_dir):
    t = pnl_tables(no_broadcast, sf_dir)
    plain = monthly_pnl(**t, years=range(1996, 1998))
    report = monthly_pnl(**t, years=range(1996, 1998), ordered=True)
    assert "rangepartitioning" not in plan(report) and plan(report).count("FileScan") == plan(plain).count("FileScan")
    got = [tuple(r) for r in report.collect()]
    assert [r[:3] for r in got] == sorted(r[:3] for r in got)
    assert sorted(got) == sorted(tuple(r) for r in plain.collect())
    assert report.rdd.getNumPartitions() > 1


def test_existence_in_range_never_pairs(no_broadcast, sf_dir):
    lines = load(no_broadcast, sf_dir, "lineitem")
    flagged = within_days_flag(lines, lines, ["l_partkey"], "l_shipdate", "l_shipdate", 30)
    text = plan(flagged)
    assert text.count("Join") == 1
    assert re.search(r"SortMergeJoin \[l_partkey#\d+L, __own#\d+, __h#\d+L\]", text)


@pytest.fixture(scope="module")
def skewed(no_broadcast):
    """Settings under which this small data counts as skewed, and a third of it on one key."""
    spark = no_broadcast
    small = {
        "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "20k",
        "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "1.5",
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": "20k",
        "spark.sql.files.maxPartitionBytes": "64k",
    }
    before = {k: spark.conf.get(k) for k in small}
    for k, v in small.items():
        spark.conf.set(k, v)
    rows = spark.range(0, 90_000, 1, 12).select(
        F.col("id"),
        F.when(F.col("id") % 3 == 0, F.lit(7)).otherwise(F.xxhash64("id") % 5000).alias("k"),
        F.date_add(F.lit(dt.date(2024, 1, 1)), (F.col("id") % 5).cast("int")).alias("d"),
        F.sha2(F.col("id").cast("string"), 256).alias("payload"),
    )
    yield rows
    for k, v in before.items():
        spark.conf.set(k, v)


def ran(df):
    df.collect()
    return plan(df)


def test_hot_keys_are_split(skewed):
    on = {"k": "k"}
    assert "skew=true" in ran(exists_in(skewed, skewed.filter("k < 100"), on))
    assert "skew=true" in ran(partition_total(skewed, ["k"], "id", "s"))
    assert "skew=true" in ran(within_days_flag(skewed, skewed, ["k"], "d", "d", 30))
    ids = skewed.withColumnRenamed("k", "ref").withColumn("k", F.col("id") % 50)
    claims = ids.filter("k < 25")
    assert "skew=true" in ran(anti_within_days(ids, ids, claims, ["k"], "d", "d", 30, "ref"))
    names = skewed.select("k").distinct().withColumn("v", F.lit(1))
    assert "skew=true" in ran(enrich(skewed, [DimJoin(names, on, {"v": "v"}, split=True)]))
    spans = names.withColumns({"f": F.lit(dt.date(2023, 1, 1)), "t": F.lit(dt.date(2025, 1, 1))})
    joined = valid_at_join(skewed, spans, on, "d", "f", "t", {"v": "v"}, bucket_days=31)
    assert "skew=true" in ran(joined)


def test_gap_fill_shuffles_its_series_once(spark, sf_dir):
    parts = load(spark, sf_dir, "part").withColumnRenamed("p_partkey", "sku")
    series = calendar_spine(parts, "sku", [2000]).withColumn(
        "avg_cost_per_item_month", F.when(F.col("month_") == 5, F.col("sku"))
    )
    after_scan = plan(cost_gap_fill(series)).split("REPARTITION_BY_COL")[0]
    assert after_scan.count("Exchange") == 1  # the range exchange itself
    assert after_scan.count("Window") >= 3
