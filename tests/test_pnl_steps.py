"""The profit and loss written step by step: same rows, and the disk of one step at a time."""

import os

import pytest
from pyspark.sql import functions as F

from martloom.plans import monthly_pnl, pnl_store, read_pnl, refresh_pnl
from martloom.plans.pnl import ORDER_FEES, PAYMENT_MEASURES, _fee_totals, _measured
from martloom.queries import QUERIES
from martloom.queries.commerce_reports import pnl_tables
from martloom.session import shared_folder
from martloom.sources import Steps, publish, published_parts, read_published

YEARS = range(1996, 1998)


def rows(df):
    return sorted(map(tuple, df.collect()), key=str)


def shuffle_files(spark):
    manager = spark._jvm.org.apache.spark.SparkEnv.get().blockManager().diskBlockManager()
    return sum(name.startswith("shuffle_") for name in str(manager.getAllBlocks().mkString("\n")).split("\n"))


@pytest.fixture
def no_broadcast(spark):
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    yield spark
    spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")


def test_a_written_step_leaves_no_shuffle_files(spark, frame, tmp_path):
    df = frame("k int, v long", *[(i % 7, i) for i in range(100)]).groupBy("k").agg(F.sum("v").alias("v"))
    steps, before = Steps(spark, "steps_test"), shuffle_files(spark)
    first = steps.write("first", df)
    second = steps.write_by("second", df, ["k"], ["v", "k"])
    assert shuffle_files(spark) <= before
    assert rows(first) == rows(second) == rows(df)
    steps.clear()
    assert not os.path.exists(steps.root.removeprefix("file:"))


@pytest.mark.parametrize("name", ["monthly_pnl", "monthly_pnl_all_years"])
def test_only_the_calendar_is_shuffled_at_the_end(no_broadcast, sf_dir, name):
    text = QUERIES[name](no_broadcast, sf_dir)._jdf.queryExecution().executedPlan().toString()
    assert text.count("SortMergeJoin") == 13
    assert text.count("Exchange") <= 3  # the articles, and their months


def test_steps_change_no_rows(spark, frame, sf_dir):
    t = pnl_tables(spark, sf_dir)
    # cells without an article or a month, and one beyond the calendar
    odd = frame("asin string, year_pdt int, month int, amount decimal(18,2), v long", (None, 1996, 5, None, 1), ("B1", None, 5, None, 2), ("B1", 2050, 1, None, 3))
    t["discrepancies"] = t["discrepancies"].unionByName(
        odd.select("asin", "year_pdt", "month", F.col("v").alias("qty_adjustment"), F.col("amount").alias("supplier_reimbursement"), F.col("amount").alias("amount_adjustment"))
    )
    t = {name: df.limit(40) if name == "sku_asin" else df for name, df in t.items()}
    whole, steps = monthly_pnl(**t, years=YEARS), Steps(spark, "pnl_test")
    written = monthly_pnl(**t, years=YEARS, steps=steps)
    assert written.dtypes == whole.dtypes
    assert rows(written) == rows(whole) != []
    steps.clear()


def test_every_fee_goes_into_one_total(frame):
    fees = frame("order_id long, sku string, kind string, units long", *[(1, "a", k, 2**i) for i, k in enumerate(ORDER_FEES)], (1, "a", "other", 5))
    totals, money, parts = _fee_totals(fees.withColumnRenamed("units", "amount"), PAYMENT_MEASURES)
    assert money == {} and len(totals.columns) == 2 + len({c for cs in parts.values() for c in cs})
    single = totals.first().asDict()
    assert sum(v for c, v in single.items() if c.startswith("__")) == 2 ** len(ORDER_FEES) - 1
    row = _measured(totals, parts).first().asDict()
    assert {m: row[m] for m in PAYMENT_MEASURES} == {m: sum(2 ** ORDER_FEES.index(k) for k in kinds) for m, kinds in PAYMENT_MEASURES.items()}


def test_a_load_in_several_frames_is_one_load(spark, frame, tmp_path):
    target, schema = str(tmp_path / "parts"), "p int, v long"
    publish(frame(schema, (1, 1), (2, 2), (3, 3)), target, F.col("p"))
    publish([frame(schema, (1, 10)), frame(schema), frame(schema, (2, 20), (1, 11))], target, F.col("p"), [1, 2, 3], "zstd")
    assert rows(read_published(spark, target, frame(schema).schema)) == [(1, 10), (1, 11), (2, 20)]
    assert len(os.listdir(f"{target}/_manifests")) - sum(n.endswith(".crc") for n in os.listdir(f"{target}/_manifests")) == 2
    assert sorted(published_parts(spark, target)) == ["part=1", "part=2"]


def test_a_refresh_in_several_loads_leaves_the_report_alone(spark, sf_dir, tmp_path, monkeypatch):
    t, months = pnl_tables(spark, sf_dir), [(1996, 11), (1996, 12), (1997, 1)]
    monkeypatch.setattr(pnl_store, "LOAD_CELLS", 1)
    assert pnl_store._loads(months, 100) == [[m] for m in months]
    assert pnl_store._loads(months, 0) == [[(1996, 11)], [(1996, 12)], [(1997, 1)]]
    refresh_pnl(t, str(tmp_path / "pnl"), months)
    report = monthly_pnl(**t, years=YEARS)
    number = F.col("year_") * 100 + F.col("month_")
    want = report.filter(number.isin(*[y * 100 + m for y, m in months]))
    assert rows(read_pnl(spark, str(tmp_path / "pnl"), report.schema)) == rows(want)
    folder = shared_folder(spark).removeprefix("file:")
    assert not [n for n in os.listdir(folder) if n.startswith("pnl_refresh")]
