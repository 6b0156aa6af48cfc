"""Long series are cut into parts of a bounded size."""

import re

import pytest

from martloom.operators.calendar import calendar_spine
from martloom.operators.skew import tasks_for
from martloom.plans.inventory import cost_gap_fill
from martloom.queries import windows


@pytest.fixture
def whole_plans(spark):
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    yield spark
    spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.adaptive.enabled", "true")


def test_tasks_follow_the_rows(spark):
    assert tasks_for(spark, 0) is None and tasks_for(spark, 1000) is None
    assert tasks_for(spark, 605_000_000) == 1210


def test_the_join_of_a_long_cost_series_has_its_parts(whole_plans, sf_dir, monkeypatch):
    monkeypatch.setattr(windows, "cost_tasks", lambda spark, sf: 11)
    text = windows.cost_series(whole_plans, sf_dir)._jdf.queryExecution().executedPlan().toString()
    assert len(re.findall(r"hashpartitioning\(sku\S*, year_\S*, month_\S*, 11\)", text)) == 2


def test_a_long_cost_series_is_cut_into_the_given_parts(spark, frame):
    skus = frame("sku string", *[(f"s{i}",) for i in range(20)])
    series = calendar_spine(skus, "sku", [1997]).selectExpr(
        "*", "IF(month_ % 5 = 0, CAST(month_ AS DECIMAL(18,2)), NULL) AS avg_cost_per_item_month"
    )
    plain = cost_gap_fill(series)
    for ordered, part in ((True, r"rangepartitioning\(sku\S* ASC NULLS FIRST, 11\)"), (False, r"hashpartitioning\(sku\S*, 11\)")):
        cut = cost_gap_fill(series, ordered=ordered, partitions=11)
        assert re.search(part, cut._jdf.queryExecution().executedPlan().toString())
        assert sorted(map(str, cut.collect())) == sorted(map(str, plain.collect()))
